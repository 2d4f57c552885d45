"""Products, tile trees, queues, task graphs, registries and configuration."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from orogen.operators import products, tiling
from orogen.registry import Registry, Remembered, load_config
from orogen.streaming import tasks

PRODUCT = "id string, frame string, type string, color string, eye string, geometry string, special string, version int"


def ids(df, column="id"):
    return sorted(r[column] for r in df.collect())


def test_product_filters(spark):
    rows = [
        ("p1", "f", "Points", None, "Left", "Linearized", "_", 1), ("p2", "f", "Points", None, "Left", "Linearized", "_", 2), ("r1", "f", "Range", None, "Left", "Raw", "_", 1), ("n1", "f", "Normals", None, "Right", "Linearized", "_", 1),
        ("i1", "f", "Image", "FullColor", "Left", "Raw", "A", 1), ("i2", "f", "Image", "Green", "Left", "Raw", "_", 1), ("i3", "f", "Image", "FullColor", "Left", "Linearized", "_", 1), ("m1", "f", "RoverMask", None, "Left", "Raw", "_", 1), ("m2", "f", "RoverMask", None, "Left", "Linearized", "_", 1),
        ("r2", "g", "Range", None, "Right", "Raw", "_", 1), ("i4", "g", "Image", "Unknown", "Left", "Raw", "_", 1),
    ]
    df = spark.createDataFrame(rows, PRODUCT)
    assert ids(products.without_range(df, ["frame"])) == ["i1", "i2", "i3", "i4", "m1", "m2", "n1", "p1", "p2", "r2"]
    assert ids(products.preferred_eye(df, "Left")) == ["i1", "i2", "i3", "i4", "m1", "m2", "p1", "p2", "r1"]  # the other eye goes although g has no left one
    images = df.where("type = 'Image'")
    assert ids(products.preferred_colour(images, ["frame"], True)) == ["i1", "i3"] and ids(products.preferred_colour(images, ["frame"], False)) == ["i2"]
    assert ids(products.best_special(images, ["frame"], ["A", "_"])) == ["i2", "i3", "i4"] and ids(products.best_special(images, ["frame"], ["_", "A"])) == ["i1", "i4"]
    lin = products.preferred_geometry(df.where("frame = 'f' and type <> 'Range'"), ["frame"], True, False)
    assert ids(lin) == ["i1", "i2", "m1", "m2", "n1", "p1", "p2"]
    masks = products.preferred_geometry(df.where("id in ('p1', 'r1', 'm1', 'm2')"), ["frame"], False, True)
    assert ids(masks) == ["m1", "r1"]
    assert ids(products.filter_groups(df, ["frame"], allowed=["_", "A"])) == ["i1", "m1", "m2", "p2"]


def test_wedge_limits_and_orders(spark):
    rows = [(f"n{i}", "a", "Navcam", i) for i in range(5)] + [(f"m{i}", "a", "Mastcam", 10 + i) for i in range(5)] + [("h", "a", None, 20)]
    df = spark.createDataFrame(rows, "id string, sd string, cam string, sol int")
    kept = lambda most, nav, mast: ids(products.wedge_limits(df, ["sd"], [F.col("sol").desc()], F.col("cam"), most, nav, mast))
    assert kept(99, 2, 2) == ["h", "m2", "m3", "m4", "n3", "n4"] and kept(5, 2, 2) == ["h", "m2", "m3", "m4", "n4"]
    meshes = spark.createDataFrame([("a", "s", "c", "Raw", 9, 9), ("b", "s", "c", "Linearized", 1, 1), ("d", "s", "c", "Linearized", 1, 2), ("e", "t", "c", "Raw", 1, 1)], "id string, sd string, cam string, geometry string, sol int, version int")
    assert ids(products.latest_meshes(meshes, ["sd", "cam"])) == ["d", "e"] and ids(products.latest_meshes(meshes, ["sd", "cam"], False)) == ["a", "e"]
    assert ids(products.in_sols(meshes, [(5, 10), (40, 50)])) == ["a"] and len(ids(products.in_sols(meshes, []))) == 4
    drives = spark.createDataFrame([("001", 3.0), ("002", 9.0), ("003", 1.0)], "site_drive string, area double")
    order = lambda *a: [r["site_drive"] for r in drives.orderBy(*products.site_drive_order(*a)).collect()]
    assert order("Newest")[0] == "003" and order("Biggest")[0] == "002" and order("Smallest")[0] == "003" and order("ProjectThenBiggest", "003") == ["003", "002", "001"]
    lines = spark.createDataFrame([("# no",), ("",), (" a ",), ("b",)], "value string")
    assert ids(products.listed(lines, "s3://x/"), "url") == ["s3://x/a", "s3://x/b"]
    frames = spark.createDataFrame([("1", "f", "Image", "Raw"), ("2", "f", "Image", "Linearized"), ("3", "f", "Points", "Raw")], "id string, frame string, type string, geometry string")
    r = products.by_frame(frames, True, [F.col("id")]).first()
    assert (r["Image"], r["Points"], r["Range"]) == ("2", "3", None)
    used = spark.createDataFrame([("c", "a", 1), ("c", "b", 2), ("c", "a", 3), ("c", "d", 4)], "cache string, entry string, at int")
    assert ids(products.least_recently_used(used, ["cache"], "at", 2), "entry") == ["b"]


def test_tile_trees(spark):
    corners = [(i, (i % 4) * 1.0, (i // 4) * 1.0) for i in range(16)]
    point = lambda x, y: {"x": x, "y": y, "z": 0.1 * (x > 2)}
    schema = "fid int, " + ", ".join(f"{p} struct<x: double, y: double, z: double>" for p in "abc")
    faces = spark.createDataFrame([(i, point(x, y), point(x + 1, y), point(x, y + 1)) for i, x, y in corners], schema)
    for scheme, first in (("Bin", 2), ("QuadZ", 4), ("QuadAuto", 4), ("Oct", 4)):
        tree = tiling.build(faces, scheme, tiling.CRITERIA["faces"](3), 0.0, 6).collect()
        leaves = [r for r in tree if r["is_leaf"]]
        names = {r["tile"] for r in tree}
        assert sum(r["n"] for r in leaves) == 16 and max(r["n"] for r in leaves) <= 3 and sum(r["level"] == 1 for r in tree) >= first
        assert all(r["parent"] in names for r in tree if r["parent"]) and {r["parent"] for r in tree} - {None} == {r["tile"] for r in tree if not r["is_leaf"]}
    assert [r["is_leaf"] for r in tiling.build(faces, "QuadZ", tiling.CRITERIA["faces"](3), 2.5).collect()] == [True]  # one box back: no split
    assert [r["is_leaf"] for r in tiling.build(faces, "Bin", tiling.CRITERIA["faces"](3), 2.5).collect()] == [True]
    assert len(tiling.build(faces, "QuadAutoWithFallback", tiling.CRITERIA["area"](0.1), 1.5).collect()) > 1
    assert tiling.build(faces.limit(0), "Oct", tiling.CRITERIA["faces"](3)).count() == 0
    tree = tiling.build(faces, "QuadZ", tiling.CRITERIA["faces"](4), 0.0, 6)
    errors = {r["tile"]: (r["is_leaf"], r["error"], r["area"]) for r in tiling.geometric_errors(tree, 64.0).collect()}
    assert all((e == 0) == leaf for leaf, e, _ in errors.values()) and errors["0"][1] == pytest.approx(4 * (8.0 / 64) ** 0.5, rel=0.05)
    deep = tiling.geometric_errors(tree, 1e12, spark.createDataFrame([("0", 2.5)], "tile string, distance double")).where("tile = '0'").first()
    assert deep["error"] == 2.5
    with pytest.raises(KeyError, match="known: Bin"):
        tiling.SCHEMES["Hex"]


def test_queue(spark):
    empty = spark.createDataFrame([], tasks.QUEUE)
    queue = tasks.enqueue(empty, spark.createDataFrame([(f"m{i}", '{"n": %d}' % i if i else "{broken") for i in range(4)], "id string, body string"), 100)
    taken, queue = tasks.dequeue(queue, 100, 2, 30)
    assert ids(taken) == ["m0", "m1"] and all(r["receives"] == 1 for r in taken.collect())
    again, _ = tasks.dequeue(queue, 110, 9, 30)
    assert ids(again) == ["m2", "m3"]
    late, queue = tasks.dequeue(tasks.extend_leases(queue, spark.createDataFrame([("m1",)], "id string"), 110, 60), 131, 9, 30)
    assert ids(late) == ["m0", "m2", "m3"]
    good, bad = tasks.decoded(late, "n int")
    assert ids(good) == ["m2", "m3"] and ids(bad) == ["m0"] and sorted(r["message"]["n"] for r in good.collect()) == [2, 3]
    assert ids(tasks.acknowledge(queue, good)) == ["m0", "m1"]
    judged = spark.createDataFrame([("a", 100, 1), ("b", 0, 1), ("c", 100, 4), ("d", 0, 9)], "id string, sent long, receives int")
    got = {r["id"]: r["verdict"] for r in tasks.verdicts(judged, 100, F.col("id") == "d", max_age=50).collect()}
    assert got == {"a": "handle", "b": "expire", "c": "fail", "d": "reject"}
    workers = spark.createDataFrame([("a", 0, 5), ("b", 90, 5), ("c", 90, 50)], "id string, started long, bytes long")
    assert {r["id"]: r["reason"] for r in tasks.overdue(workers, 100, 60, 20).collect()} == {"a": "time", "c": "memory"}
    record = '{"Records":[{"eventName":"Put","s3":{"bucket":{"name":"b"},"object":{"key":"a%20c.IV"}}}]}'
    events = spark.createDataFrame([("1", record), ("2", '{"Message":%s}' % __import__("json").dumps(record)), ("3", "{}")], "id string, body string")
    assert [(r["id"], r["url"]) for r in tasks.event_urls(events).orderBy("id").collect()] == [("1", "s3://b/a c.IV"), ("2", "s3://b/a c.IV")]


def test_marks_and_passes(spark, tmp_path):
    marks = spark.createDataFrame([("a", 100), ("b", 100), ("c", 100)], "k string, at long")
    changes = spark.createDataFrame([("a", 90), ("b", 110), ("c", 130)], "k string, at long")
    assert sorted((r["k"], r["fires"]) for r in tasks.latent_marks(marks, changes, ["k"], 20).collect()) == [("a", 120), ("c", 120)]
    base = dt.datetime(2020, 1, 1)
    at = lambda s: base + dt.timedelta(seconds=s)
    schema = "key string, at timestamp, kind string"
    for i, rows in enumerate([[("a", at(0), "change"), ("a", at(10), "mark"), ("b", at(10), "mark"), ("b", at(15), "change")], [("c", at(500), "mark")], [("z", at(5000), "change")]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"p{i}"))
    stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    out = tasks.latent_marks_stream(stream, 20_000, "0 seconds")
    out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
    assert sorted((r["key"], r["at"], r["fires"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [("a", at(10), at(30)), ("c", at(500), at(520))]
    passes = spark.createDataFrame([("s", 0, "1"), ("s", 1, "2"), ("s", 2, "3"), ("s", 3, "4"), ("s", 200, "5")], "service string, at long, id string")
    got = {r["id"]: r["started"] for r in tasks.bounded_passes(passes, ["service"], 2, 50).collect()}
    assert got == {"1": 0, "2": 50, "3": 100, "4": None, "5": 200}
    sets = spark.createDataFrame([("a", True, True, None), ("b", True, False, 0), ("c", False, False, 90_000), ("d", True, False, None), ("e", False, False, None)], "id string, has_files boolean, is_done boolean, pid_at long")
    assert {r["id"]: r["state"] for r in tasks.tileset_state(sets, 100_000).collect()} == {"a": "done", "b": "zombie", "c": "processing", "d": "found", "e": "absent"}
    versions = tasks.next_versions(spark.createDataFrame([("p", "x"), ("p", "y"), ("q", "z")], "k string, id string"), spark.createDataFrame([("p", 3)], "k string, version int"), ["k"])
    assert {r["id"]: r["version"] for r in versions.collect()} == {"x": 4, "y": 5, "z": 1}


def test_task_graphs(spark):
    all_ = spark.createDataFrame([(t,) for t in "abcd"], "task string")
    needs = spark.createDataFrame([("c", "a"), ("c", "b"), ("d", "c")], "task string, needs string")
    none = all_.limit(0)
    assert ids(tasks.ready(all_, needs, none), "task") == ["a", "b"]
    a, b = (all_.where(F.col("task") == t) for t in "ab")
    assert ids(tasks.newly_ready(needs, none, a), "task") == [] and ids(tasks.newly_ready(needs, a, b), "task") == ["c"]
    rounds = tasks.run_in_order(all_, needs, lambda now: now.withColumn("out", F.upper("task")))
    assert {r["task"]: r["round"] for r in rounds.collect()} == {"a": 0, "b": 0, "c": 1, "d": 2}
    with pytest.raises(ValueError, match="wait for each other"):
        tasks.run_in_order(all_, needs.union(spark.createDataFrame([("a", "d")], needs.schema)), lambda now: now)
    log = spark.createDataFrame([("p", "t1", "run", 1, None), ("p", "t1", "done", 2, None), ("p", "t2", "run", 3, None), ("q", "t", "error", 4, "bad"), ("r", "", "done", 5, None)], "project string, task string, status string, at long, message string")
    assert [(r["task"], r["since"]) for r in tasks.current_status(log, ["project"]).collect()] == [("t2", 3)]
    assert {r["project"]: (r["state"], r["error"]) for r in tasks.project_status(log, ["project"]).collect()} == {"p": ("running", None), "q": ("failed", "bad"), "r": ("done", None)}
    assert ids(tasks.long_running(log, ["project"], 100, 50), "task") == ["t2"]
    inputs = spark.createDataFrame([("p", "1"), ("p", "2"), ("q", "1")], "project string, input string")
    chunked = spark.createDataFrame([("p", "1"), ("q", "1")], "project string, input string")
    assert ids(tasks.to_chunk(inputs, chunked), "input") == ["2"] and ids(tasks.chunking_done(inputs, chunked), "project") == ["q"]
    parts = tasks.dispatch({"x": lambda m: m.withColumn("done", F.lit(1))}, spark.createDataFrame([("x", 1), ("y", 2), (None, 3)], "kind string, n int"))
    assert parts["x"].count() == 1 and parts[""].count() == 2


def test_registry_and_config(tmp_path):
    things = Registry("thing")
    things.register("a")(1)
    with pytest.raises(ValueError):
        things.register("a")(2)
    things.register("a", replace=True)(3)
    assert things["a"] == 3 and list(things) == ["a"] and "b" not in things

    @dataclasses.dataclass
    class Settings:
        name: str = "x"
        faces: int = 10
        fast: bool = False

    path = tmp_path / "c.json"
    path.write_text('{"faces": 20}')
    assert load_config(Settings, str(path), environment={"OROGEN_FAST": "True", "OROGEN_NAME": "7"}) == Settings("7", 20, True)
    path.write_text('{"face": 20}')
    with pytest.raises(ValueError, match="face"):
        load_config(Settings, str(path), environment={})
    calls = []
    known = Remembered(lambda k: calls.append(k) or k * 2, 2)
    assert [known(k) for k in (1, 2, 1, 3, 2)] == [2, 4, 2, 6, 4] and calls == [1, 2, 3, 2]
