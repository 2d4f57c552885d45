import pytest

from orogen.sources.catalog import Catalog


def test_catalog(spark, tmp_path):
    c = Catalog(spark, str(tmp_path))
    assert not c.exists("t")
    with pytest.raises(KeyError):
        c.load("t")
    c.upsert("t", spark.createDataFrame([("a", 1, "x1"), ("b", 2, "x2"), ("c", 3, "y")], "k string, n int, s string"), ["k"])
    c.upsert("t", spark.createDataFrame([("b", 20, None), ("d", 4, "x4")], "k string, n int, s string"), ["k"])
    assert {r["k"]: (r["n"], r["s"]) for r in c.load("t").collect()} == {"a": (1, "x1"), "b": (20, None), "c": (3, "y"), "d": (4, "x4")}
    assert sorted(r["k"] for r in c.scan("t", s="^x").collect()) == ["a", "d"]
    assert c.lookup("t", k="b", s=None)["n"] == 20 and c.lookup("t", k="z") is None
    c.delete("t", spark.createDataFrame([("a",)], "k string"), ["k"])
    c.keep_referenced("t", spark.createDataFrame([("b",), ("b",), ("q",)], "k string"), ["k"])
    assert [r["k"] for r in c.load("t").collect()] == ["b"]
