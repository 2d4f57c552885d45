"""The training-data operators against brute force, on small tables with nulls, empties, ties and repeats."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute
import pytest
from pyspark.sql import functions as F

from orogen.llm import common, embedding_lsh, hilbert, lcp, mixing, packing, quality_crf, simhash, suffix_dedup, toxicity, url_filter, winnow

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi".split()


def prose(rnd, n):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(50)) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    base = [prose(rnd, rnd.randrange(1, 120)) for _ in range(40)]
    shared = prose(rnd, 30)
    texts = [*base, base[3], base[3], base[7][:-4] + "zzzz", shared + " " + base[1], base[2] + "\n" + shared, "x" * 300, "x" * 120, None, "", " ", "ß é ñ 日本 " * 20, prose(rnd, 4000)]
    docs = [(i * 3, t, "en" if i % 3 else None, f"s{min(i % 5, 2)}", len(t or "")) for i, t in enumerate(texts)]
    return [*docs, docs[5], docs[45]]  # repeated rows


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def test_empty_tables(spark, none):
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.similar_documents(none).count() == 0
    assert suffix_dedup.remove_repeats(none, kept=True).count() == 0
    assert mixing.schedule(none).count() == 0
    assert mixing.mix(none).count() == 0
    assert winnow.edit_report(none).count() == 0
    assert winnow.fingerprints(none).count() == 0
    assert hilbert.shards(none, ["n_chars", "source"], 8, ["doc_id"]).count() == 0
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality_crf.score(none, quality_crf.fit(none, empty)).count() == 0
    assert toxicity.score(none, toxicity.fit(none, empty)).count() == 0
    vectors = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embedding_lsh.near_duplicates(vectors).count() == 0
    assert url_filter.listed(spark.createDataFrame([], "url string, fetched_at date"), spark.createDataFrame([], "pattern string, at date, action string")).count() == 0


def test_simhash_components(docs, rows):
    def plain(text):
        import xxhash

        t = (text or "").encode().lower().split()
        grams = [b" ".join(t[i : i + 3]) for i in range(len(t) - 2)] or ([b" ".join(t)] if t else [])
        bits = [sum(xxhash.xxh64_intdigest(g, 42) >> b & 1 for g in grams) for b in range(64)]
        return sum(1 << b for b in range(64) if 2 * bits[b] > len(grams)) if grams else 0

    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs.withColumn("fp", F.lit("clash"))).collect()}
    fps = {r[0]: plain(r[1]) for r in rows}
    assert all(got[i]["fp"] & (2**64 - 1) == f for i, f in fps.items())
    label = {i: i for i in fps}
    for _ in fps:
        for i in fps:
            label[i] = min(label[j] for j in fps if (fps[i] ^ fps[j]).bit_count() <= 2)
    assert {i: got[i]["component_id"] for i in fps} == label


def test_simhash_links_agree_when_crowded(spark, monkeypatch):
    rnd = random.Random(1)
    centre = rnd.getrandbits(64)
    fps = {centre}
    for _ in range(120):
        x = rnd.choice(sorted(fps))
        for _ in range(rnd.randrange(1, 4)):
            x ^= 1 << rnd.randrange(64)
        fps.add(x)
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp long")
    results = []
    for crowded in (1000, 1):
        monkeypatch.setattr(simhash, "CROWDED", crowded)
        linked = simhash.links(df)
        assert all(((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 2 for r in linked.collect())
        results.append({(r["node"], r["component"]) for r in common.components(linked).collect()})
    assert results[0] == results[1]


def test_similar_documents(spark):
    rnd = random.Random(2)
    originals = [prose(rnd, 200) for _ in range(12)]
    near = [" ".join("edited" if k == 50 else w for k, w in enumerate(t.split())) for t in originals]
    far = [" ".join("edited" + str(k) if k % 3 == 0 else w for k, w in enumerate(t.split())) for t in originals]
    table = spark.createDataFrame(list(enumerate(originals + near + far)), "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(table).collect()}
    assert got == {i: (i if i < 12 or i >= 24 else i - 12) for i in range(36)}


EDITS = {
    "appended": lambda rnd, t: t + prose(rnd, len(t) // 5).split(),
    "truncated": lambda rnd, t: t[: len(t) * 85 // 100],
    "block": lambda rnd, t: t[: len(t) // 2] + prose(rnd, len(t) * 8 // 100).split() + t[len(t) // 2 + len(t) * 8 // 100 :],
}


def jaccard(a, b):
    x, y = (simhash.shingles(t.encode(), 5) for t in (a, b))
    return len(x & y) / len(x | y)


def test_similar_documents_finds_contiguous_edits(spark):
    rnd = random.Random(11)
    pairs = [(t, " ".join(edit(rnd, t.split()))) for edit in EDITS.values() for t in (prose(rnd, rnd.randrange(60, 600)) for _ in range(30))]
    pairs = [(a, b) for a, b in pairs if jaccard(a, b) >= 0.8]
    assert len(pairs) > 70
    table = spark.createDataFrame([(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(table).collect()}
    assert got == {i: i - i % 2 for i in range(2 * len(pairs))}


def test_similar_documents_screens_by_counts_only(spark):
    rnd = random.Random(26685)  # a pair that agrees in less than 18 of 32 least hashes
    words = [f"w{i}" for i in range(4000)]
    text = rnd.choices(words, k=150)
    pair = [" ".join(text), " ".join(text[:135] + rnd.choices(words, k=15))]
    assert jaccard(*pair) >= 0.8
    table = spark.createDataFrame(list(enumerate(pair)), "doc_id long, text string")
    assert {r["component_id"] for r in simhash.similar_documents(table).collect()} == {0}


def test_near_copies_keeps_null_ids_and_texts_of_one_id(spark):
    import corpus_pipeline

    rnd = random.Random(13)
    a, b, c, d = (prose(rnd, 80) for _ in range(4))
    rows = [(None, a), (None, a), (None, b), (1, c), (1, d), (1, c), (2, c + " end"), (None, c), (3, d + " end"), (5, b + " end"), (4, None), (None, "")]
    table = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
    got = corpus_pipeline.near_copies(spark, table, "").select("doc_id", "text").collect()
    assert Counter(map(tuple, got)) == Counter([(None, a), (5, b + " end"), (1, c), (1, d), (4, None)])


@pytest.mark.parametrize("block", [16, simhash.BLOCK])
def test_similar_documents_compares_crowded_bands(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rnd = random.Random(12)
    rows = [" | ".join(prose(rnd, 60).split()) for _ in range(90)]
    rows += [" | ".join("edited" if k == 30 else w for k, w in enumerate(t.split(" | "))) for t in rows[5:85]]
    common = prose(rnd, 60)
    rows += [f"{common} {prose(rnd, 14)}" for _ in range(120)]  # similar to each other, less than 0.8
    rows += [f"{t} end" for t in rows[200:230]] + [prose(rnd, 80)]
    table = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    label = list(range(len(rows)))
    near = [(i, j) for j in range(len(rows)) for i in range(j) if jaccard(rows[i], rows[j]) >= 0.8]
    for _ in range(4):
        for i, j in near:
            label[i] = label[j] = min(label[i], label[j])
    got = {r["doc_id"]: r["component_id"] for r in simhash.similar_documents(table).collect()}
    assert len(near) >= 110 and got == dict(enumerate(label))


def brute_removal(rows):
    first = {}
    for i, t in rows:
        for s in range(len(t) - 49):
            w = t[s : s + 50]
            first[w] = min(first.get(w, i), i)
    out = {}
    for i, t in rows:
        gone = bytearray(len(t))
        for s in range(len(t) - 49):
            if first[t[s : s + 50]] < i:
                gone[s : s + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(t, gone, strict=True) if not g)
        out[i, t] = (len(t), len(t) - len(kept), len([r for r in bytes(gone).split(b"\0") if r]), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("crowded", [1, suffix_dedup.CROWDED])
def test_suffix_dedup(spark, docs, rows, crowded):
    got = suffix_dedup.remove_repeats(docs.withColumn("n_bytes", F.lit("clash")), crowded=crowded).collect()
    want = brute_removal([(r[0], (r[1] or "").encode()) for r in rows])
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == want[r["doc_id"], (r["text"] or "").encode()]
    ids = spark.createDataFrame([(None, "y" * 90), (1, "y" * 90), (1, "y" * 80), (2, "y" * 90)], "doc_id long, text string")
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in suffix_dedup.remove_repeats(ids).collect()) == [(0, 0), (1, 0), (1, 0), (2, 90)]


def test_lcp_merge():
    rnd = random.Random(3)
    runs = [sorted(bytes(rnd.choice(b"ab") for _ in range(rnd.randrange(9))) for _ in range(rnd.randrange(30))) for _ in range(7)]
    coded = [lcp.front_code(r) for r in runs]
    out = list(lcp.merge([((h, s, i) for h, s in lcp.front_decode(*c)) for i, c in enumerate(coded)]))
    assert [s for _, s, _ in out] == sorted(s for r in runs for s in r)
    last = b""
    for h, s, _ in out:
        assert h == lcp.shared_prefix(last, s)
        last = s


def test_winnowing(docs, rows):
    table = {}
    for r in rows:
        table.setdefault((r[0], r[1] or ""), 0)
        table[r[0], r[1] or ""] += 1
    order = sorted(((i, t) for (i, t), n in table.items() for _ in range(n)), key=lambda r: -r[0])
    got = Counter((r["doc_id"], r["edited_sha256"], r["n_chars"]) for r in winnow.edit_report(docs).collect())
    want = Counter()
    for k, (i, t) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        edited = t[: len(t) - len(t) // 2] + following[: len(t) // 2]
        want[i, hashlib.sha256(edited.encode()).hexdigest(), len(t)] += 1
    assert got == want
    # the guarantee: a shared run of GRAM + WINDOW - 1 characters shares a selected gram
    rnd = random.Random(4)
    common_ = prose(rnd, 20)[: winnow.GRAM + winnow.WINDOW - 1]
    a, b = winnow.winnow("q" * 40 + common_ + prose(rnd, 30)), winnow.winnow(prose(rnd, 9) + common_ + "w" * 33)
    assert set(a[1].tolist()) & set(b[1].tolist())
    assert winnow.winnow("aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa")[0].tolist()[0] == winnow.WINDOW - 1  # rightmost tie
    assert winnow.winnow("")[0].tolist() == [] and len(winnow.winnow("short")[0]) == 1
    assert winnow.likeness(*[winnow.winnow("")[1]] * 2) == 1.0


def test_packing(docs, rows):
    public_tokenizers = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    got = packing.pack_sequences(docs.withColumn("start", F.lit("clash")), path, 256, 16).collect()
    want = Counter()
    for r in rows:
        ids = [*tok.encode(r[1] or "", add_special_tokens=False).ids, 1]
        for s in range(0, len(ids), 256):
            part = np.array(ids[s : s + 256], "<u4").tobytes()
            want[r[0], s, len(part) // 4, zlib.crc32(part), len(ids)] += 1
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in got) == want
    bins = {}
    for r in got:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    for odd in ["İstanbul’s ΣΑΣ naïve 12345", "don't <|endoftext|> stop", "tab\tnew\nline\x1cx", "ﬁ Å é"]:
        assert packing.Encoder(path).encode([odd])[0].tolist() == tok.encode(odd, add_special_tokens=False).ids


def test_first_fit_decreasing():
    rnd = random.Random(6)
    lengths = sorted((rnd.randrange(1, 101) for _ in range(300)), reverse=True)
    where, offsets = packing.first_fit_decreasing(lengths, 100)
    room = []
    for n, b, o in zip(lengths, where, offsets, strict=True):
        k = next((i for i, r in enumerate(room) if r >= n), len(room))
        if k == len(room):
            room.append(100)
        assert (b, o) == (k, 100 - room[k])
        room[k] -= n


def test_pfair():
    rnd = random.Random(7)
    for _ in range(60):
        weights = {f"s{i}": rnd.random() + 0.01 for i in range(rnd.randrange(1, 9))}
        blocks = {s: rnd.randrange(120) for s in weights}
        seq = {}
        rows = mixing.phases(blocks, weights, 40)
        for s, phase, b0, b1, t0, share, period, slots in rows:
            for b in range(b0, b1):
                j = b - b0
                seq[t0 + j // share * period + slots[j % share]] = (s, phase)
        assert sorted(seq) == list(range(sum(blocks.values())))
        assert Counter(s for s, _ in seq.values()) == Counter({s: n for s, n in blocks.items() if n})
        count, at = Counter(), None
        for t in sorted(seq):
            s, phase = seq[t]
            if phase != at:
                count, at = Counter(), phase
                share = {r[0]: (r[5] / r[6], r[4]) for r in rows if r[1] == phase}
            count[s] += 1
            assert all(abs(count[q] - w * (t + 1 - t0)) < 1 for q, (w, t0) in share.items())


def test_pfair_holds_given_weights_over_many_periods():
    weights = {"third": 1 / 3} | {f"s{i}": 2 / 57 for i in range(19)} | {"rare": 0.0004}
    blocks = {s: 20_000 if s == "third" else 5_000 for s in weights}
    total = sum(weights.values())
    rows = [r for r in mixing.placements(mixing.phases(blocks, weights)) if r[2] == 0]
    seq = sorted((slot, r[0], release, due) for r in rows for slot, release, due in zip(*r[5:], strict=True))
    assert [q[0] for q in seq] == list(range(len(seq))) and len(seq) > 50 * mixing.PERIOD
    assert all(release <= slot < due for slot, _, release, due in seq)
    count = Counter()
    for slot, s, _, _ in seq:
        count[s] += 1
        if slot % 97 == 0 or slot == len(seq) - 1:
            assert all(abs(count[q] - w / total * (slot + 1)) < 1 for q, w in weights.items())


def test_mixing_keeps_every_row(docs, rows):
    out = mixing.schedule(docs, block=4, period=20).collect()
    assert Counter(r["doc_id"] for r in out) == Counter(r[0] for r in rows)
    assert len({(r["slot"], r["rank"]) for r in out}) == len(rows)
    assert all(r["release"] <= r["slot"] < r["deadline"] for r in out)
    mixed = mixing.mix(docs, block=4, period=20)
    assert mixed.columns == docs.columns and Counter(map(tuple, mixed.collect())) == Counter(map(tuple, rows))
    with pytest.raises(ValueError):
        mixing.schedule(docs, {"s0": 1.0})


def test_hilbert(spark, docs, rows):
    cells = np.array([(i, j, k) for i in range(4) for j in range(4) for k in range(4)])
    index = hilbert.hilbert_index(cells, 2)
    assert sorted(index.tolist()) == list(range(64))
    assert (np.abs(np.diff(cells[np.argsort(index)], axis=0)).sum(axis=1) == 1).all()
    out = hilbert.shards(docs.withColumn("hilbert", F.lit("clash")), ["lang", "source", "n_chars"], 8, ["doc_id"]).collect()
    sizes = Counter(r["shard"] for r in out)
    assert len(out) == len(rows) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in sizes:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sizes[s]))
    last = {s: max(r["hilbert"] for r in out if r["shard"] == s) for s in sizes}
    assert all(last[s] <= min(r["hilbert"] for r in out if r["shard"] == s + 1) for s in range(7))


def test_embeddings(spark):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((30, 16))
    vectors = np.concatenate([centres, centres[:15] + 0.02 * rng.standard_normal((15, 16)), centres[:3], centres[:2] * 2])
    rows = [(i, v.astype(np.float32).tolist(), i % 2 if i < 30 else (i - 30) % 2) for i, v in enumerate(vectors)]
    rows += [(100, None, 0), (101, [0.0] * 16, 0), (102, [float("nan")] * 16, 0), (103, [], 1), (104, rows[0][1], None), (105, [1e300] * 16, 0), (106, [None] * 16, 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("links", F.lit("clash"))
    for block in (4, embedding_lsh.BLOCK):
        got = {r["vec_id"]: r for r in embedding_lsh.near_duplicates(table, block=block).collect()}
        links = Counter()
        label = {i: i for i, _, _ in rows}
        good = [(i, np.array(v) / np.abs(v).max(), k) for i, v, k in rows if i < 100 or i == 105]
        pairs = [(i, j) for i, x, a in good for j, y, b in good if i != j and a == b and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.98]
        for i, _ in pairs:
            links[i] += 1
        for _ in range(5):
            for i, j in pairs:
                label[i] = min(label[i], label[j])
        assert {i: r["component_id"] for i, r in got.items()} == label
        assert {i: r["n_links"] for i, r in got.items()} == {i: links[i] for i, _, _ in rows}
        assert all(r["kept"] == (r["component_id"] == i) for i, r in got.items())


def test_url_filter(spark):
    entries = spark.sql("""select * from values ('Bad.example', date'2024-01-05', 'add'), ('bad.example', date'2024-01-05', 'add'), ('bad.example', date'2024-01-10', 'remove'),
        ('bad.example', date'2024-01-20', 'add'), ('a.bad.example', date'2024-01-07', 'add'), (null, date'2024-01-01', 'add'), ('x.example', null, 'add'), ('y.example', date'2024-01-01', 'maybe') as t(pattern, at, action)""")
    captures = spark.sql("""select *, 'clash' as listed from values (1, 'http://bad.example/x', date'2024-01-04'), (2, 'http://u@A.Bad.example:80/', date'2024-01-08'), (3, 'https://bad.example', date'2024-01-10'),
        (4, 'https://b.bad.example./', date'2024-01-25'), (5, 'https://notbad.example/', date'2024-01-25'), (6, null, date'2024-01-25'), (7, 'http://bad.example', null), (8, 'junk', date'2024-01-25'),
        (4, 'https://b.bad.example./', date'2024-01-25') as t(id, url, fetched_at)""")
    got = sorted((r["id"], r["listed"], r["list_pattern"], str(r["listed_since"])) for r in url_filter.listed(captures, entries).collect())
    hit = (4, True, "bad.example", "2024-01-20")
    assert got == [(1, False, None, "None"), (2, True, "a.bad.example", "2024-01-07"), (3, False, None, "None"), hit, hit, *((i, False, None, "None") for i in (5, 6, 7, 8))]


def test_classifiers_hold_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = common.read(spark, sf, "labels").toPandas().set_index("doc_id")
    for query, label, bound in ((quality_crf.op7_quality_crf, "quality", 0.9), (toxicity.op2_toxicity, "toxic", 0.7)):
        got = query(spark, sf).toPandas().set_index("doc_id")
        assert got["score"].between(0, 1).all() and len(got) == 1000
        assert (got["predicted"] == (got["score"] >= 0.3)).all()
        both = got[got["held_out"]].join(labels, how="inner")
        good, bad = both[both[label] == 1]["score"].to_numpy(), both[both[label] == 0]["score"].to_numpy()
        auc = ((good[:, None] > bad[None]).mean() + 0.5 * (good[:, None] == bad[None]).mean())
        assert auc > bound


def test_crf_marginals():
    rng = np.random.default_rng(9)
    odds, link, sizes = rng.standard_normal(9), rng.standard_normal((2, 2)), np.array([4, 1, 4])
    p, pairs, _ = quality_crf.marginals(odds, sizes, link)
    at, total = 0, np.zeros((2, 2))
    for n in sizes:
        weight, mass = np.zeros(n), 0.0
        for code in range(1 << n):
            y = [code >> i & 1 for i in range(n)]
            w = np.exp(sum(odds[at + i] * y[i] for i in range(n)) + sum(link[y[i - 1], y[i]] for i in range(1, n)))
            mass += w
            weight += w * np.array(y)
        assert np.allclose(weight / mass, p[at : at + n])
        at += n
        total[0, 0] += n - 1
    assert np.isclose(pairs.sum(), total.sum())


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = common.read(spark, sf, "documents")
    held = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = common.written(stage(spark, held, sf), name)
        assert out.columns == docs.columns
        assert out.select("doc_id").exceptAll(held.select("doc_id")).count() == 0
        if name == "mixture":
            assert out.exceptAll(held).count() == 0 and out.count() == held.count()
        held = out
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() == held.count()


def test_suffix_dedup_decides_by_bytes_when_every_hash_collides(monkeypatch):
    class Colliding(suffix_dedup.Stretches):
        def __init__(self, *args):
            super().__init__(*args)
            self.gram, self.content = self.gram >> np.uint64(60) << np.uint64(60), self.content * np.uint64(0)

    monkeypatch.setattr(suffix_dedup, "Stretches", Colliding)
    monkeypatch.setattr(suffix_dedup, "_RUN", 50)
    rnd = random.Random(9)
    parts = [prose(rnd, 25) for _ in range(12)]
    data = [(i, " ".join(t if rnd.random() < 0.8 else prose(rnd, 9) for t in rnd.sample(parts, 4))[rnd.randrange(40) :]) for i in range(60)]
    data += [(60 + i, parts[0][i : i + 70]) for i in range(12)]  # many different stretches of one gram
    data += [(72, "ab" * 40), (73, "q" + "ab" * 700 + "r"), (74, "abc" * 30 + "ab" * 60), (75, "abc" * 300), (76, ("line of thirty-nine characters, 39 ok.\n") * 30), (77, "e 39 ok.\n" + ("line of thirty-nine characters, 39 ok.\n") * 3)]  # periods
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in data], "text": [t for _, t in data]})

    def step(run, *inputs):
        rows = sorted(((k, b) for x in inputs for r in x for k, b in zip(r.column("kind").to_pylist(), r.column("blob").to_pylist(), strict=True)), key=lambda r: r[0])
        return list(run(iter([suffix_dedup._rows([0] * len(rows), 0, [b for _, b in rows]).set_column(1, "kind", pa.array([k for k, _ in rows], pa.int32()))])))

    def only(kinds, rows):
        return [r.filter(pa.compute.is_in(r.column("kind"), pa.array(kinds, pa.int32()))) for r in rows]

    for crowded in (1, suffix_dedup.CROWDED):
        home = list(suffix_dedup._texts_home(1)(iter([batch])))
        first = step(suffix_dedup._match(1, crowded), suffix_dedup._scan(1)(iter([batch])))
        runs = step(suffix_dedup._extract(1), only([suffix_dedup.CANDIDATE], first), home)
        second = step(suffix_dedup._merge(1), runs)
        out = step(suffix_dedup._apply(["doc_id", "text"], False), only([suffix_dedup.REMOVED], first), second, home)
        got = {(d, t.encode()): row for r in out for d, t, *row in zip(*(r.column(c).to_pylist() for c in ("doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept_sha256")), strict=True)}
        want = brute_removal([(i, t.encode()) for i, t in data])
        assert {k: tuple(v) for k, v in got.items()} == want and any(v[1] for v in want.values())


def test_classifiers_with_nulls_ties_repeats_long_texts_and_clashes(spark):
    rnd = random.Random(21)
    words = [prose(rnd, 60) for _ in range(60)]
    rows = [(i, words[i] + (" nastyword" * 3 if i % 3 == 0 else "") + ("\n!!!! BUY $$$ 99 | NOW" * 8 if i % 4 == 0 else "")) for i in range(60)]
    rows += [(60, None), (61, ""), (62, " \n \n"), (63, prose(rnd, 60_000)), (None, rows[3][1]), rows[5], rows[5], (5, rows[7][1])]
    table = spark.createDataFrame([(i, t, 9.0, 9.0, "x") for i, t in rows], "doc_id long, text string, toxic_score double, quality_score double, y string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), int(i % 3 == 0)) for i in range(60)] + [(5, 0, 0), (None, 1, 1), (7, None, None)], "doc_id long, quality int, toxic int")
    for module, name in ((toxicity, "toxic_score"), (quality_crf, "quality_score")):
        got = module.score(table, module.fit(table, labels)).collect()
        again = {(r["doc_id"], r["text"]): r[name] for r in module.score(table.repartition(5), module.fit(table.repartition(5), labels)).collect()}
        assert len(got) == len(rows) and all(0 <= r[name] <= 1 and again[r["doc_id"], r["text"]] == pytest.approx(r[name]) for r in got)
        by_text = {}
        for r in got:
            assert by_text.setdefault(r["text"] or "", r[name]) == pytest.approx(r[name])
    for n in (2, 3, 8):  # very few labels
        few = spark.createDataFrame([(i, i % 2, i % 2) for i in range(n)], "doc_id long, quality int, toxic int")
        assert all(0 <= r["toxic_score"] <= 1 for r in toxicity.score(table, toxicity.fit(table, few)).collect())


def test_packing_spreads_copies_of_a_row(spark):
    import public_tokenizers

    table = spark.createDataFrame([(1, "one two three")] * 300 + [(i, "four") for i in range(2, 50)] + [(None, None)], "doc_id long, text string").coalesce(1)
    got = packing.pack_sequences(table, public_tokenizers.path("word_bpe_49k.json"), group_docs=20).collect()
    assert len(got) == 349
    groups = Counter(r["sequence_id"] >> 32 for r in got if r["doc_id"] == 1)
    assert len(groups) >= 15 and max(groups.values()) < 60


def test_embeddings_with_repeated_ids(spark):
    v, u = [1.0, 0.0, 0.0, 0.1], [0.0, 1.0, 0.0, 0.0]
    table = spark.createDataFrame([(5, v, 1), (5, u, 1), (7, v, 1), (8, u, 2)], "vec_id long, embedding array<double>, label int")
    got = Counter((r["vec_id"], r["n_links"], r["component_id"]) for r in embedding_lsh.near_duplicates(table).collect())
    assert got == Counter([(5, 1, 5), (5, 0, 5), (7, 1, 5), (8, 0, 8)])


def test_embedding_plan_keeps_recall_as_it_grows():
    rng = np.random.default_rng(3)
    x = rng.standard_normal((4000, 24))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal(x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    y = 0.981 * x + np.sqrt(1 - 0.981**2) * side / np.linalg.norm(side, axis=1, keepdims=True)
    for n in (10, 1 << 16, 1 << 22, 1 << 30):
        tables, projections = embedding_lsh.plan(n)
        a, b = (embedding_lsh._keys(z, 7, tables, projections) for z in (x, y))
        assert (a == b).any(axis=1).mean() >= 0.9
    assert embedding_lsh.plan(10) == (embedding_lsh.TABLES, embedding_lsh.PROJECTIONS)


def plain_winnow(text):
    """Positions of the selected grams, window by window."""
    n = len(text)
    if n < winnow.GRAM:
        return [0] if n else []
    place, hashes = winnow.winnow(text)  # the hash of a gram depends on its characters only
    known = {}
    for at in range(0, n - winnow.GRAM + 1):
        gram = text[at : at + winnow.GRAM]
        if gram not in known:
            known[gram] = int(winnow.winnow(gram)[1][0])
    value = [known[text[at : at + winnow.GRAM]] >> 20 for at in range(n - winnow.GRAM + 1)]
    out = []
    for w in range(max(1, len(value) - winnow.WINDOW + 1)):
        part = value[w : w + winnow.WINDOW]
        at = w + len(part) - 1 - part[::-1].index(min(part))
        if not out or out[-1] != at:
            out.append(at)
    assert [known[text[at : at + winnow.GRAM]] for at in out] == hashes.tolist()
    return out


def test_winnowing_selects_by_windows(monkeypatch):
    rnd = random.Random(6)
    data = [prose(rnd, rnd.randrange(1, 90)) for _ in range(25)] + ["", "a", "x" * 11, "x" * 12, "x" * 80, "ab" * 40, "日本ßé" * 30, prose(rnd, 60) * 3]
    for step in (winnow._SLICE, 37):
        monkeypatch.setattr(winnow, "_SLICE", step)
        for text in data:
            assert winnow.winnow(text)[0].tolist() == plain_winnow(text)


def test_winnowing_report(docs, rows):
    got = {(r["doc_id"], r["n_chars"], r["fingerprint"]): r for r in winnow.edit_report(docs).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    for i, (doc, text, *_) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        if i + 1 < len(order) and order[i + 1][0] == doc or i and order[i - 1][0] == doc:
            continue  # rows of one id follow each other by text hash
        own, near = winnow.winnow(text), winnow.winnow(following)
        changed = winnow.winnow(winnow.edited(text, following))
        r = got[doc, len(text), winnow.digest(*own)]
        share = lambda a, b: len(set(a) & set(b)) / len(set(a) | set(b)) if len(a) or len(b) else 1.0
        assert r["edited_fingerprint"] == winnow.digest(*changed)
        assert r["near_edited"] == pytest.approx(share(own[1].tolist(), changed[1].tolist())) and r["near_next"] == pytest.approx(share(own[1].tolist(), near[1].tolist()))


def test_winnowing_blocks(spark):
    for n in (0, 1, 2, 5, 16, 17):
        cuts = [3 * i for i in range(n)]
        df = spark.createDataFrame([(k,) for k in range(-2, 3 * n + 3)], "k long").withColumn("above", winnow._cuts_above(F.col("k"), cuts))
        assert all(r["above"] == sum(c > r["k"] for c in cuts) for r in df.collect())


def test_hilbert_query_columns(docs, rows):
    got = Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in hilbert.digest(docs).collect())
    assert got == Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)

