"""Every registered query against its SQL, and the operators' edge cases."""

import duckdb
import pytest

from orogen import catalog
from orogen.functions import ids, text
from orogen.operators import graph, joins, ranking, stats

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{data}/{t}.parquet'")
    return con


def plain(rows, columns):
    def value(v):
        if v is None or v != v:
            return None
        return round(float(v), 8) if isinstance(v, float) else str(v)

    return sorted((tuple(value(v) for v in r) for r in rows[columns].astype(object).itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query(spark, data, duck, name):
    ours = catalog.queries()[name](spark, data).toPandas()
    theirs = duck.sql(catalog.oracle_sql()[name]).df()
    columns = sorted(ours.columns)
    assert columns == sorted(theirs.columns)
    assert plain(ours, columns) == plain(theirs, columns)


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_rows_only(spark, data, name):
    assert catalog.queries()[name](spark, data).count() > 0


def test_entry_without_llm():
    import __spark_entry__

    assert set(catalog.queries()) <= set(__spark_entry__.queries())


def test_running_stats_reference_values(spark):
    from pyspark.sql import functions as F

    values = [12.5, 7.25, -3.0, 88.125, 0.0, 41.75, 1e3, -640.5, 2.0, 19.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    r = df.agg(*stats.running_stats(F.col("x"))).first()
    mean = sum(values) / 10
    assert r["n"] == 10 and abs(r["mean"] - mean) < 1e-9
    assert abs(r["variance"] - sum((v - mean) ** 2 for v in values) / 9) < 1e-6
    empty = df.where("x > 1e9").agg(*stats.running_stats(F.col("x"))).first()
    assert tuple(empty) == (0, 0.0, 0.0, 0.0, 0.0, 0.0)
    one = df.limit(1).agg(*stats.running_stats(F.col("x"))).first()
    assert one["variance"] == 0.0


def test_upper_median(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 5.0), ("b", None)], "k string, v double")
    assert {r["k"]: r["median"] for r in stats.upper_median(df, ["k"], "v").collect()} == {"a": 3.0, "b": 5.0}


def test_greedy_budget_skips_and_goes_on(spark):
    df = spark.createDataFrame([(1, 5), (2, 9), (3, 4), (4, 1)], "id int, size int")
    kept = ranking.greedy_budget(df, [], ["id"], "size", 10, ["id"])
    assert [r["id"] for r in kept.orderBy("pos").collect()] == [1, 3, 4]


def test_score_classes_compare_with_the_head(spark):
    df = spark.createDataFrame([(1, 10, 10.0), (1, 11, 9.4), (1, 12, 8.9), (1, 13, 8.6)], "g int, id bigint, s double")
    got = {r["id"]: r["score_class"] for r in ranking.score_classes(df, ["g"], "s", "id", 1.0).collect()}
    assert got == {10: 0, 11: 0, 12: 1, 13: 1}


def test_range_join_bounds(spark):
    from pyspark.sql import functions as F

    points = spark.createDataFrame([(float(i),) for i in range(-3, 30)], "p double")
    spans = spark.createDataFrame([(1, 0.0, 10.0), (2, 9.5, 9.5), (3, -2.0, -1.0)], "id int, lo double, hi double")
    got = joins.range_join(points, spans, F.col("p"), F.col("lo"), F.col("hi"), 4.0)
    assert sorted((r["id"], r["p"]) for r in got.collect()) == [(1, float(i)) for i in range(11)] + [(3, -2.0), (3, -1.0)]


def test_versions_and_site_drives(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([("_", "0311472"), ("1A", "0003100112"), ("09", "bad"), ("0", "A000012"), ("0", "xxx0012"), ("0", "001####"), ("0", "?????00007"), ("0", "___0001"), ("0", "0-10001")], "v string, s string")
    got = [(r["n"], tuple(r["d"]) if r["d"] else None) for r in df.select(text.version_number(F.col("v")).alias("n"), ids.site_drive(F.col("s")).alias("d")).collect()]
    assert got == [(36, (31, 1472)), (20, (31, 112)), (9, None), (0, (1000, 12)), (0, (-1, 12)), (0, (1, -1)), (0, (-1, 7)), (0, (32768, 1)), (0, None)]


def test_globs():
    import re

    match = lambda glob, name, **options: bool(re.search(text.glob_to_regex(glob, **options), name))
    assert match("a/*.txt", "a/b/c.txt") and not match("a/*.txt", "a/b/c.txt", slashes=False) and match("a/*.txt", "a/b.txt", slashes=False)
    assert match("?.[x]", "q.[x]") and not match("b", "abc") and match("b", "abc", full=False)
    assert match("(a|b)c", "bc", alternation=True) and not match("(a|b)c", "bc") and match("(a|b)c", "(a|b)c")


def test_asof_is_strict_at_equal_times(spark):
    from pyspark.sql import functions as F

    rows = [(1, 5, "a"), (1, 10, "b"), (1, 10, "c"), (1, 12, None), (1, 15, "d")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    got = {(r["t"], r["v"]): r["previous"] for r in joins.asof_previous(df, ["k"], "t", F.col("v")).collect()}
    assert got[(5, "a")] is None and got[(10, "b")] == got[(10, "c")] == "a" and got[(12, None)] in ("b", "c") and got[(15, "d")] in ("b", "c")


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(400)] + [(500, 501), (7, 7), (600, 600)], "a int, b int")
    got = {r["node"]: r["component"] for r in graph.components(edges, "a", "b").collect()}
    assert got == {i: 0 for i in range(401)} | {500: 500, 501: 500, 600: 600}


def test_hierarchy_refuses_chains_that_are_too_long(spark):
    rows = [(i, i - 1 if i else None) for i in range(12)]
    nodes = spark.createDataFrame(rows, "id int, parent int")
    got = {r["node"]: (r["depth"], r["root"]) for r in graph.hierarchy(nodes, "id", "parent", 16).collect()}
    assert got == {i: (i, 0) for i in range(12)}
    with pytest.raises(Exception, match="longer than 4 nodes"):
        graph.hierarchy(nodes, "id", "parent", 4).collect()


def test_greedy_walk_over_partitions(spark):
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(4)
    for budget in (0, 37, 400, 10_000):
        costs = [rnd.choice([0, 1, 5, 30, 90]) for _ in range(300)]
        left, want = budget, []
        for i, c in enumerate(costs):
            if c <= left:
                left -= c
                want.append((len(want), i))
        df = spark.createDataFrame(list(enumerate(costs)), "id int, c int").orderBy(F.rand(1))
        got = sorted((r["pos"], r["id"]) for r in ranking.greedy_budget(df, [], ["id"], "c", budget, ["id"]).collect())
        assert got == want

