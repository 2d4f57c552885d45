"""Commands: ``python -m orogen.cli COMMAND ...``. Each is a function of a session and its arguments, and prints one JSON object."""

from __future__ import annotations

import argparse
import dataclasses
import json
import os
import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import last_part, like_glob, strip_extension
from .operators import products, tiling
from .operators.ranking import greedy_budget
from .registry import Registry, load_config
from .sources import containers, formats
from .sources.catalog import Catalog

COMMANDS: Registry[Callable[[SparkSession, argparse.Namespace], dict]] = Registry("command")
OPTIONS: dict[str, Callable[[argparse.ArgumentParser], None]] = {}

for _kind, _parse, _print in (("glb", containers.parse_glb, containers.format_glb), ("b3dm", containers.parse_b3dm, containers.format_b3dm), ("bob", containers.parse_bob, containers.format_bob), ("iv", containers.parse_iv, None)):
    formats.register_mesh_format(_kind, _parse, _print)

#: Readers of image files by ending: bytes to rows x columns x bands.
IMAGES: dict[str, Callable[[bytes], np.ndarray]] = {
    "img": lambda data: containers.parse_pds(data)[1], "fits": lambda data: containers.parse_fits(data)[1], "png": containers.parse_png, "tif": containers.parse_tiff,
    "rgb": containers.parse_sgi, "pgm": formats.parse_ppm, "ppm": formats.parse_ppm,
}


@dataclasses.dataclass
class Settings:
    storage: str = "catalog"
    faces_per_tile: int = 10_000
    least_extent: float = 0.0
    scheme: str = "QuadAuto"
    texture_pixels: int = 256


def command(name: str, options: Callable[[argparse.ArgumentParser], None]) -> Callable:
    def put(function: Callable) -> Callable:
        OPTIONS[name] = options
        return COMMANDS.register(name)(function)

    return put


def write_files(rows: DataFrame, target: str) -> int:
    """Write rows (name, content) as files under ``target``, where they are computed; a file appears whole. Returns their number."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        system, root = fs.FileSystem.from_uri(target) if "://" in target else (fs.LocalFileSystem(), target)
        for pdf in batches:
            for name, content in zip(pdf["name"], pdf["content"], strict=True):
                path = f"{root.rstrip('/')}/{name}"
                system.create_dir(os.path.dirname(path), recursive=True)
                with system.open_output_stream(f"{path}.part-{os.getpid()}") as out:
                    out.write(content)
                system.move(f"{path}.part-{os.getpid()}", path)
                yield pd.DataFrame({"bytes": [len(content)]})

    return rows.select("name", "content").mapInPandas(run, "bytes long").count()


def _paths(*names: str) -> Callable[[argparse.ArgumentParser], None]:
    def add(parser: argparse.ArgumentParser) -> None:
        for name in names:
            parser.add_argument(name)

    return add


def _name(kind: str):
    return F.concat(strip_extension(last_part(F.col("path"))), F.lit(f".{kind}"))


@command("configure", lambda p: (p.add_argument("path"), p.add_argument("--set", nargs="*", default=[])))
def configure(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Write the settings, those given as NAME=VALUE changed, to a file."""
    values = dataclasses.asdict(load_config(Settings, args.path if os.path.exists(args.path) else None))
    for text in args.set:
        name, _, value = text.partition("=")
        if name not in values:
            raise ValueError(f"unknown setting {name}")
        values[name] = type(values[name])(value)
    with open(args.path, "w", encoding="utf-8") as file:
        json.dump(values, file, indent=1, sort_keys=True)
    return values


def _fetch_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("source"), p.add_argument("target")
    p.add_argument("--glob", default="*"), p.add_argument("--budget", type=float, default=float("inf")), p.add_argument("--dry", action="store_true")


@command("fetch", _fetch_options)
def fetch(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Copy files that match a glob and are not there yet, newest first while they fit the budget of bytes."""
    found = formats.files(spark, args.source).select(last_part(F.col("path")).alias("name"), "path", "length", "modificationTime").where(like_glob(F.col("name"), args.glob))
    if os.path.isdir(args.target):
        there = formats.files(spark, args.target).select(last_part(F.col("path")).alias("name"), F.col("length"))
        found = found.join(there, ["name", "length"], "left_anti")
    dated = found.withColumn("age", -F.unix_millis("modificationTime"))
    chosen = greedy_budget(dated, [], ["age", "name"], "length", args.budget, ["name", "path", "length"]) if args.budget < float("inf") else dated
    total = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    if not args.dry and total[0]:
        content = formats.files(spark, args.source).select(F.col("path").alias("__p"), "content")
        write_files(chosen.select("path", "name").join(content, F.col("path") == F.col("__p")), args.target)
    return {"files": total[0], "bytes": int(total[1])}


@command("ingest", lambda p: (p.add_argument("source"), p.add_argument("catalog"), p.add_argument("--table", default="observations")))
def ingest(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Labels of all images under a path into a catalog table, one row a product, the best of each group marked."""
    labels = formats.read_labels(spark, args.source).groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("label"))
    get = lambda key: F.element_at("label", key)
    rows = labels.select(
        strip_extension(last_part(F.col("path"))).alias("id"), "path", F.coalesce(get("FRAME_ID"), F.lit("")).alias("frame"), F.coalesce(get("PRODUCT_TYPE"), F.lit("Image")).alias("type"),
        F.coalesce(get("COLOR"), F.lit("FullColor")).alias("color"), F.coalesce(get("EYE"), F.lit("Left")).alias("eye"), F.coalesce(get("GEOMETRY"), F.lit("Raw")).alias("geometry"),
        F.coalesce(get("SPECIAL"), F.lit("_")).alias("special"), F.coalesce(get("VERSION").try_cast("int"), F.lit(0)).alias("version"),
    )
    best = products.filter_groups(rows, ["frame"]).select("id").withColumn("best", F.lit(True))
    out = rows.join(best, "id", "left").withColumn("best", F.coalesce("best", F.lit(False)))
    Catalog(spark, args.catalog).upsert(args.table, out, ["id"])
    n = Catalog(spark, args.catalog).load(args.table).agg(F.count(F.lit(1)), F.count_if("best")).first()
    return {"rows": n[0], "best": n[1]}


@command("convert-image", lambda p: (p.add_argument("source"), p.add_argument("target"), p.add_argument("--to", default="png", choices=["png", "tif", "ppm", "img"]), p.add_argument("--glob", default="*")))
def convert_image(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Images of any known kind as PNG or PPM (stretched to 0 to 255 if they reach beyond), TIFF or PDS (values kept)."""
    kind = args.to

    def printed(px: np.ndarray) -> bytes:
        if kind in ("tif", "img"):
            return containers.format_tiff(px) if kind == "tif" else containers.format_pds(px)
        low, high = float(np.nanmin(px)), float(np.nanmax(px))
        if low < 0 or high > 255 or high <= 1:
            px = (px - low) * (255 / (high - low) if high > low else 0.0)
        return containers.format_png(px) if kind == "png" else formats.format_ppm(px)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, name, data in zip(pdf["path"], pdf["name"], pdf["content"], strict=True):
                read = IMAGES.get(path.rsplit(".", 1)[-1].lower())
                if read:
                    yield pd.DataFrame({"name": [name], "content": [printed(read(bytes(data)))]})

    rows = formats.files(spark, args.source, args.glob).select("path", _name(kind).alias("name"), "content")
    return {"files": write_files(rows.mapInPandas(run, "name string, content binary"), args.target)}


def _convert(spark: SparkSession, source: str, target: str, kinds: list[str], to: str) -> int:
    n = 0
    for kind in kinds:
        parse, printer = formats.PARSERS[kind], formats.PRINTERS[to]

        def run(batches: Iterator[pd.DataFrame], parse=parse, printer=printer) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for name, data in zip(pdf["name"], pdf["content"], strict=True):
                    yield pd.DataFrame({"name": [name], "content": [printer(*parse(bytes(data)))]})

        rows = formats.files(spark, source, f"*.{kind}").select("path", _name(to).alias("name"), "content")
        n += write_files(rows.mapInPandas(run, "name string, content binary"), target)
    return n


@command("convert-iv", lambda p: (p.add_argument("source"), p.add_argument("target"), p.add_argument("--to", default="obj", choices=["obj", "ply", "stl", "glb", "b3dm"])))
def convert_iv(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Inventor meshes as another kind."""
    return {"files": _convert(spark, args.source, args.target, ["iv"], args.to)}


@command("convert-gltf", lambda p: (p.add_argument("source"), p.add_argument("target"), p.add_argument("--to", default="glb", choices=["glb", "b3dm", "obj", "ply", "stl"])))
def convert_gltf(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Meshes of all known kinds as glTF or a 3D tile, or back."""
    return {"files": _convert(spark, args.source, args.target, [k for k in formats.PARSERS if k != args.to], args.to)}


def height_mesh(heights: np.ndarray, cell: float, missing: float | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, triangles) of a raster of heights, its centre at the origin, rows running down y; no triangle at a missing height."""
    z = heights.astype(float)
    valid = np.isfinite(z) & (True if missing is None else z != missing)
    rows, cols = z.shape
    r, c = np.indices(z.shape)
    normal = np.stack([-np.gradient(np.where(valid, z, 0), axis=1) / cell, np.gradient(np.where(valid, z, 0), axis=0) / cell, np.ones_like(z)], axis=-1) if min(z.shape) > 1 else np.broadcast_to([0.0, 0.0, 1.0], (*z.shape, 3))
    normal = normal / np.linalg.norm(normal, axis=-1, keepdims=True)
    place = np.stack([(c - (cols - 1) / 2) * cell, ((rows - 1) / 2 - r) * cell, z], axis=-1)
    uv = np.stack([c / max(cols - 1, 1), 1 - r / max(rows - 1, 1)], axis=-1)
    faces = containers.grid_triangles(valid)
    all_ = np.concatenate([place, normal, uv], axis=-1).reshape(-1, 8)
    used = np.unique(faces)
    to = np.full(len(all_), -1)
    to[used] = np.arange(len(used))
    return all_[used], to[faces].astype(np.int32).reshape(-1, 3)


@command("dem2mesh", lambda p: (p.add_argument("source"), p.add_argument("target"), p.add_argument("--cell", type=float, default=1.0), p.add_argument("--missing", type=float), p.add_argument("--to", default="ply", choices=["ply", "obj", "stl", "glb", "b3dm"])))
def dem2mesh(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Rasters of heights as meshes."""
    cell, missing, printer = args.cell, args.missing, formats.PRINTERS[args.to]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, name, data in zip(pdf["path"], pdf["name"], pdf["content"], strict=True):
                read = IMAGES.get(path.rsplit(".", 1)[-1].lower())
                if read:
                    yield pd.DataFrame({"name": [name], "content": [printer(*height_mesh(read(bytes(data))[..., 0], cell, missing))]})

    rows = formats.files(spark, args.source).select("path", _name(args.to).alias("name"), "content")
    return {"files": write_files(rows.mapInPandas(run, "name string, content binary"), args.target)}


def _tileset_options(p: argparse.ArgumentParser) -> None:
    p.add_argument("source"), p.add_argument("target")
    p.add_argument("--kind", default="ply"), p.add_argument("--scheme"), p.add_argument("--faces", type=int), p.add_argument("--least", type=float), p.add_argument("--config")


@command("build-tileset", _tileset_options)
def build_tileset(spark: SparkSession, args: argparse.Namespace) -> dict:
    """A tree of 3D tiles over all meshes under a path: one b3dm for each leaf and tileset.json."""
    own = load_config(Settings, args.config)
    vertices, faces = formats.read_meshes(spark, args.source, args.kind)
    at = vertices.select("mesh", "vid", F.struct("x", "y", "z").alias("p"))
    for p, name in (("p0", "a"), ("p1", "b"), ("p2", "c")):
        faces = faces.join(at.withColumnsRenamed({"vid": p, "p": name}), ["mesh", p])
    triangles = faces.select(F.xxhash64("mesh", "fid").alias("fid"), "a", "b", "c")
    least = own.least_extent if args.least is None else args.least
    tiles, members = tiling.build_with_members(triangles, args.scheme or own.scheme, tiling.CRITERIA["faces"](args.faces or own.faces_per_tile), least)
    tiles = tiling.geometric_errors(tiles, float(own.texture_pixels**2))
    dealt = triangles.join(members, "fid")

    def leaf(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        corners = np.array([[p["x"], p["y"], p["z"]] for c in "abc" for p in pdf[c]]).reshape(3, -1, 3).transpose(1, 0, 2)
        unique, index = np.unique(corners.reshape(-1, 3), axis=0, return_inverse=True)
        rows = np.concatenate([unique, np.full((len(unique), 5), np.nan)], axis=1)
        return pd.DataFrame({"name": [f"{key[0]}.b3dm"], "content": [containers.format_b3dm(rows, index.reshape(-1, 3))]})

    n = write_files(dealt.groupBy("tile").applyInPandas(leaf, "name string, content binary"), args.target)
    listed = [
        {"id": r["tile"], "parent": r["parent"], "lo": list(r["box"]["lo"]), "hi": list(r["box"]["hi"]), "error": r["error"], "url": f"{r['tile']}.b3dm" if r["is_leaf"] else None}
        for r in tiles.collect()  # the index that the file holds whole
    ]
    text = formats.tileset(listed).encode() if listed else b"{}"
    write_files(spark.createDataFrame([("tileset.json", text)], "name string, content binary"), args.target)
    return {"tiles": len(listed), "leaves": n}


@command("update-manifest", _paths("source", "manifest"))
def update_manifest(spark: SparkSession, args: argparse.Namespace) -> dict:
    """The files under a path as entries of a JSON lines manifest: new ones added, changed ones renewed, vanished ones dropped."""
    now = formats.files(spark, args.source).select("path", "length", F.unix_millis("modificationTime").alias("modified"), F.lower(F.regexp_extract("path", "[.]([^./]+)$", 1)).alias("kind"))
    manifest = Catalog(spark, args.manifest)
    before = manifest.load("files") if manifest.exists("files") else now.limit(0)
    both = now.join(before.select("path", F.struct("length", "modified").alias("was")), "path", "left")
    counts = both.agg(F.count(F.lit(1)), F.count_if(F.col("was").isNull()), F.count_if(F.col("was.modified") != F.col("modified"))).first()
    dropped = before.join(now, "path", "left_anti").count()
    manifest.save("files", now)
    return {"files": counts[0], "added": counts[1], "changed": counts[2], "dropped": dropped}


@command("benchmark", lambda p: (p.add_argument("source"), p.add_argument("--files", type=int, default=50), p.add_argument("--head", type=int, default=4096)))
def benchmark(spark: SparkSession, args: argparse.Namespace) -> dict:
    """Time to list files, to read the beginnings of the first ``--files``, and to read them whole."""
    out, chosen = {}, None

    def timed(name: str, work: Callable[[], float]) -> None:
        began = time.perf_counter()
        out[name] = work()
        out[f"{name}_seconds"] = round(time.perf_counter() - began, 3)

    listing = formats.files(spark, args.source).select("path", "length")
    timed("listed", listing.count)
    chosen = [r["path"] for r in listing.orderBy("path").limit(args.files).collect()]  # a bounded sample
    if chosen:
        rows = spark.read.format("binaryFile").load(chosen)
        timed("head_bytes", lambda: rows.agg(F.sum(F.length(F.substring("content", 1, args.head)))).first()[0])
        timed("full_bytes", lambda: rows.agg(F.sum(F.length("content"))).first()[0])
    return out


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    parser = argparse.ArgumentParser(prog="orogen")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in COMMANDS:
        OPTIONS[name](commands.add_parser(name, help=COMMANDS[name].__doc__))
    args = parser.parse_args(argv)
    out = COMMANDS[args.command](spark or SparkSession.builder.getOrCreate(), args)
    print(json.dumps(out))
    return out


if __name__ == "__main__":
    main()
