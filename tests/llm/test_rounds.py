"""Findings of round 2: components in few rounds, and nothing that the driver must hold."""

import random

import pytest

from orogen.llm import common, simhash


@pytest.mark.parametrize("edges", [1 << 18, 50])
def test_components_of_chains_settle_in_few_rounds(spark, monkeypatch, edges):
    rnd = random.Random(3)
    names = rnd.sample(range(-(10**6), 10**6), 3000)
    chain = [(a, b) for at in range(0, 3000, 1000) for a, b in zip(names[at : at + 999], names[at + 1 : at + 1000])]
    rnd.shuffle(chain)
    tables = []
    init = common.Table.__init__
    monkeypatch.setattr(common, "_EDGES", edges)
    monkeypatch.setattr(common.Table, "__init__", lambda self, df, name: tables.append(name) or init(self, df, name))
    found = common.components(spark.createDataFrame(chain, "a long, b long").repartition(1)).collect()
    least = {v: min(names[at : at + 1000]) for at in range(0, 3000, 1000) for v in names[at : at + 1000]}
    assert dict(map(tuple, found)) == least and len(found) == 3000
    if edges > len(chain):
        assert len(tables) <= 4


def test_simhash_broadcasts_nothing(spark, monkeypatch):
    plans = []
    init = common.Table.__init__

    def planned(self, df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        init(self, df, name)

    monkeypatch.setattr(common.Table, "__init__", planned)
    docs = spark.createDataFrame([(i, f"word{i % 7} and some more text of its own {i % 5}") for i in range(200)], "doc_id long, text string")
    out = simhash.near_duplicates(docs)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert out.count() == 200
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_similar_documents_searches_by_fingerprints(spark, monkeypatch):
    made = simhash._band_prints

    def without(words):
        inner = made(words)

        def run(batches):
            import pyarrow as pa

            for batch in inner(batches):
                at = batch.schema.get_field_index("bands")
                yield batch.set_column(at, "bands", pa.array([[]] * batch.num_rows, pa.list_(pa.int64())))

        return run

    monkeypatch.setattr(simhash, "_band_prints", without)  # no text shares a band
    rnd = random.Random(11)
    rows, near = [], set()
    for i in range(0, 120, 2):
        text = [f"w{rnd.randrange(3000)}" for _ in range(400)]
        edited = [*text]
        edited[200] = "changed"
        rows += [(i, " ".join(text)), (i + 1, " ".join(edited))]
        if (simhash.simhash(rows[-1][1].encode()) ^ simhash.simhash(rows[-2][1].encode())).bit_count() <= 2:
            near.add(i)
    assert len(near) > 20
    for crowded in (simhash.CROWDED, 1):
        monkeypatch.setattr(simhash, "CROWDED", crowded)
        found = simhash.similar_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        assert {r["doc_id"] - 1 for r in found if r["component_id"] != r["doc_id"]} == near


def test_wanted_texts_are_shuffled_once(spark):
    rows = [(3, b"a", "x"), (3, b"a", "x"), (None, b"b", "y"), (4, b"b", "y"), (None, b"c", "z"), (0, b"c", "z"), (5, b"d", "w")]
    rows = spark.createDataFrame(rows, "doc_id long, same binary, text string")
    classes = spark.createDataFrame([(b"a", 0, 3), (b"b", 1, 4), (b"c", 2, None), (b"d", 3, 5)], "same binary, node long, rep long")
    usual = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = simhash._wanted(rows, classes, spark.createDataFrame([(0,), (1,), (2,)], "node long"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(tuple, found.collect())) == [(0, "x"), (1, "y"), (2, "z")]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", usual)
    assert plan.count("Exchange hashpartitioning") == 4  # both tables of nodes, the wanted classes, the texts


def test_text_batches_are_bounded(spark):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    usual = spark.conf.get(common._BATCH)
    df = spark.range(0, 1000, 1, 2).mapInArrow(common.task(sizes), "n long")
    assert max(r["n"] for r in common.written(df, "sizes", 100).collect()) <= 100
    assert spark.conf.get(common._BATCH) == usual


def test_workers_keep_nothing_for_other_operators():
    import public_tokenizers

    from orogen.llm import packing

    path = public_tokenizers.path("word_bpe_49k.json")
    made = packing.encoder(path)
    list(common.task(iter, "encoders")([]))
    assert packing.encoder(path) is made
    list(common.task(iter)([]))
    assert packing.encoder(path) is not made


def test_suffix_dedup_compares_only_grams_with_equal_surroundings():
    import numpy as np
    import pyarrow as pa

    from orogen.llm import suffix_dedup

    def candidates(data):
        batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(data))), "text": data})
        rows = [r for r in suffix_dedup._scan(1)(iter([batch]))]
        made = [b for r in suffix_dedup._match(1, suffix_dedup.CROWDED)(iter(rows)) for b in r.to_pylist()]
        cols = [suffix_dedup.unpack(b["blob"]) for b in made if b["kind"] == suffix_dedup.CANDIDATE]
        return np.concatenate([c[0] for c in cols]) if cols else np.zeros(0)

    rnd = random.Random(17)
    own = [" ".join(f"{rnd.randrange(10**9):09d}" for _ in range(4)) for _ in range(400)]
    phrase = "a few words in common"
    assert not len(candidates([f"{a} {phrase} {b}" for a, b in zip(own[::2], own[1::2], strict=True)]))  # no 50 bytes are the same
    passage = f"{phrase} that go on here for a good deal more than fifty bytes"
    assert set(candidates([f"{a} {passage} {b}" for a, b in zip(own[:20:2], own[1:20:2], strict=True)])) == set(range(10))
