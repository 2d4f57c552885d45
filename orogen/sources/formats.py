"""Readers and writers of mesh, image and point formats over Spark's binary and text sources.

Files are decoded where they are read, one Arrow batch at a time; every reader returns a
relation, so that filters, joins and aggregations go on in Spark. Parsers are plain functions
of bytes, usable and tested without a session.
"""

from __future__ import annotations

import json
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERTEX = "mesh string, vid int, x double, y double, z double, nx double, ny double, nz double, u double, v double"
FACE = "mesh string, fid int, p0 int, p1 int, p2 int"
PIXEL = "img string, row int, col int, band int, val double"


# --- parsers and printers -------------------------------------------------------------------------------------------


def parse_obj(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(vertices with position, normal and texture coordinates, triangles) of a Wavefront OBJ.

    Every distinct corner (position, texture, normal) becomes a vertex; polygons are fanned;
    negative references count from the end.
    """
    pos, tex, nor, corners, faces = [], [], [], {}, []
    for line in data.decode("utf-8", "replace").splitlines():
        parts = line.split("#")[0].split()
        if not parts:
            continue
        if parts[0] == "v":
            pos.append([float(x) for x in parts[1:4]])
        elif parts[0] == "vt":
            tex.append([float(x) for x in parts[1:3]])
        elif parts[0] == "vn":
            nor.append([float(x) for x in parts[1:4]])
        elif parts[0] == "f":
            ring = []
            for corner in parts[1:]:
                ref = [int(x) if x else 0 for x in corner.split("/")] + [0, 0]
                key = tuple(r - 1 if r > 0 else n + r if r < 0 else -1 for r, n in zip(ref[:3], (len(pos), len(tex), len(nor)), strict=True))
                ring.append(corners.setdefault(key, len(corners)))
            faces += [(ring[0], ring[i], ring[i + 1]) for i in range(1, len(ring) - 1)]
    if not faces:
        corners = {(i, -1, -1): i for i in range(len(pos))}
    nan3, nan2 = [np.nan] * 3, [np.nan] * 2
    rows = [pos[p] + (nor[n] if n >= 0 else nan3) + (tex[t] if t >= 0 else nan2) for p, t, n in corners]
    return np.array(rows, float).reshape(-1, 8), np.array(faces, np.int32).reshape(-1, 3)


def format_obj(vertices: np.ndarray, faces: np.ndarray) -> bytes:
    has_n, has_t = not np.isnan(vertices[:, 3:6]).any(), not np.isnan(vertices[:, 6:8]).any()
    out = [f"v {x:.9g} {y:.9g} {z:.9g}" for x, y, z in vertices[:, :3]]
    out += [f"vt {u:.9g} {v:.9g}" for u, v in vertices[:, 6:8]] if has_t else []
    out += [f"vn {x:.9g} {y:.9g} {z:.9g}" for x, y, z in vertices[:, 3:6]] if has_n else []
    ref = {(0, 0): "{0}", (1, 0): "{0}/{0}", (0, 1): "{0}//{0}", (1, 1): "{0}/{0}/{0}"}[int(has_t), int(has_n)]
    out += ["f " + " ".join(ref.format(i + 1) for i in f) for f in faces.tolist()]
    return ("\n".join(out) + "\n").encode()


_PLY = {"char": "i1", "uchar": "u1", "short": "i2", "ushort": "u2", "int": "i4", "uint": "u4", "float": "f4", "double": "f8", "int8": "i1", "uint8": "u1", "int16": "i2", "uint16": "u2", "int32": "i4", "uint32": "u4", "float32": "f4", "float64": "f8"}


def parse_ply(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """As ``parse_obj``, of an ASCII or binary PLY; polygons are fanned, unknown properties skipped."""
    end = data.index(b"end_header")
    body = data[data.index(b"\n", end) + 1 :]
    elements, form = [], "ascii"
    for line in data[:end].decode("ascii").splitlines():
        parts = line.split()
        if parts[:1] == ["format"]:
            form = parts[1]
        elif parts[:1] == ["element"]:
            elements.append((parts[1], int(parts[2]), []))
        elif parts[:1] == ["property"]:
            elements[-1][2].append((parts[-1], parts[1:-1]))
    order = ">" if form == "binary_big_endian" else "<"
    tokens, at = iter(body.split()) if form == "ascii" else iter(()), 0

    def take(kind: str) -> float:
        nonlocal at
        if form == "ascii":
            return float(next(tokens))
        dtype = np.dtype(order + _PLY[kind])
        value = np.frombuffer(body, dtype, 1, at)[0]
        at += dtype.itemsize
        return float(value)

    vertices, faces = np.zeros((0, 8)), []
    names = {"x": 0, "y": 1, "z": 2, "nx": 3, "ny": 4, "nz": 5, "u": 6, "s": 6, "texture_u": 6, "v": 7, "t": 7, "texture_v": 7}
    for element, count, props in elements:
        if form != "ascii" and all(k[0] != "list" for _, k in props):
            block = np.frombuffer(body, np.dtype([(n, order + _PLY[k[0]]) for n, k in props]), count, at)
            at += block.nbytes
            if element == "vertex":
                vertices = np.full((count, 8), np.nan)
                for n, _ in props:
                    if n in names:
                        vertices[:, names[n]] = block[n]
            continue
        if element == "vertex":
            vertices = np.full((count, 8), np.nan)
        for i in range(count):
            for n, k in props:
                if k[0] == "list":
                    ring = [int(take(k[2])) for _ in range(int(take(k[1])))]
                    if element == "face" and n in ("vertex_indices", "vertex_index"):
                        faces += [(ring[0], ring[j], ring[j + 1]) for j in range(1, len(ring) - 1)]
                else:
                    value = take(k[0])
                    if element == "vertex" and n in names:
                        vertices[i, names[n]] = value
    return vertices, np.array(faces, np.int32).reshape(-1, 3)


def format_ply(vertices: np.ndarray, faces: np.ndarray) -> bytes:
    """Binary little-endian PLY with the vertex attributes that are present."""
    cols = [i for i in range(8) if not np.isnan(vertices[:, i]).any()] if len(vertices) else [0, 1, 2]
    names = ["x", "y", "z", "nx", "ny", "nz", "u", "v"]
    head = ["ply", "format binary_little_endian 1.0", f"element vertex {len(vertices)}", *(f"property double {names[i]}" for i in cols)]
    head += [f"element face {len(faces)}", "property list uchar int vertex_indices", "end_header", ""]
    rows = np.zeros(len(faces), np.dtype([("n", "u1"), ("p", "<i4", 3)]))
    rows["n"], rows["p"] = 3, faces
    return "\n".join(head).encode() + vertices[:, cols].astype("<f8").tobytes() + rows.tobytes()


_STL = np.dtype([("normal", "<f4", 3), ("corners", "<f4", (3, 3)), ("extra", "<u2")])


def parse_stl(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """As ``parse_obj``, of a binary or ASCII STL; corners equal in position and in their face's normal are one vertex."""
    text = re.match(rb"\s*solid\b[^\0]*?\bfacet\b", data[:4096])
    if text:
        rows = [p for p in (x.split() for x in data.decode("ascii", "replace").splitlines()) if p]
        normals = np.array([p[2:5] for p in rows if p[:2] == ["facet", "normal"]], float).reshape(-1, 3)
        corners = np.array([p[1:4] for p in rows if p[0] == "vertex"], float).reshape(-1, 3, 3)
    else:
        count = struct.unpack_from("<I", data, 80)[0] if len(data) >= 84 else -1
        if count < 0 or len(data) < 84 + 50 * count:
            raise ValueError("a binary STL is cut short")
        found = np.frombuffer(data, _STL, count, 84)
        normals, corners = found["normal"].astype(float), found["corners"].astype(float)
    each = np.concatenate([corners.reshape(-1, 3), np.repeat(normals, 3, axis=0)], axis=1)
    unique, index = np.unique(each, axis=0, return_inverse=True)
    return np.concatenate([unique, np.full((len(unique), 2), np.nan)], axis=1), index.reshape(-1, 3).astype(np.int32)


def format_stl(vertices: np.ndarray, faces: np.ndarray) -> bytes:
    rows = np.zeros(len(faces), _STL)
    corners = vertices[:, :3][faces]
    normal = np.cross(corners[:, 1] - corners[:, 0], corners[:, 2] - corners[:, 0])
    size = np.linalg.norm(normal, axis=1, keepdims=True)
    rows["normal"], rows["corners"] = np.divide(normal, size, out=np.zeros_like(normal), where=size > 0), corners
    return b"\0" * 80 + struct.pack("<I", len(faces)) + rows.tobytes()


def parse_ppm(data: bytes) -> np.ndarray:
    """Rows x columns x bands of a P2, P3, P5 or P6 image, values as stored."""
    fields, at = [], 2
    while len(fields) < 3:
        while data[at : at + 1].isspace():
            at += 1
        if data[at : at + 1] == b"#":
            at = data.index(b"\n", at)
            continue
        stop = at
        while stop < len(data) and not data[stop : stop + 1].isspace():
            stop += 1
        fields.append(int(data[at:stop]))
        at = stop
    width, height, top = fields
    bands = 3 if data[:2] in (b"P3", b"P6") else 1
    if data[:2] in (b"P2", b"P3"):
        values = np.array(data[at:].split(), float)
    else:
        values = np.frombuffer(data, ">u2" if top > 255 else "u1", width * height * bands, at + 1).astype(float)
    return values.reshape(height, width, bands)


def format_ppm(pixels: np.ndarray, top: int = 255) -> bytes:
    rows, cols, bands = pixels.shape
    kind = ">u2" if top > 255 else "u1"
    body = np.clip(np.rint(pixels), 0, top).astype(kind).tobytes()
    return f"{'P6' if bands == 3 else 'P5'}\n{cols} {rows}\n{top}\n".encode() + body


def parse_pds_label(data: bytes) -> dict[str, str]:
    """KEY = VALUE lines of an image label up to END, keys prefixed by their open groups; units are kept."""
    out, groups = {}, []
    for line in data.split(b"\0")[0].decode("ascii", "replace").splitlines():
        key, sep, value = (p.strip() for p in line.partition("="))
        if key == "END" and not sep:
            break
        if key in ("GROUP", "OBJECT"):
            groups.append(value)
        elif key in ("END_GROUP", "END_OBJECT"):
            groups = groups[:-1]
        elif sep:
            out[".".join([*groups, key])] = value.strip('"')
    return out


def tileset(tiles: list[dict]) -> str:
    """3D Tiles JSON of rows (id, parent, lo, hi, error, url): nested children with box volumes."""
    nodes = {t["id"]: t for t in tiles}
    children: dict = {}
    for t in tiles:
        children.setdefault(t["parent"], []).append(t["id"])

    def node(ident: str) -> dict:
        t = nodes[ident]
        mid, half = [(a + b) / 2 for a, b in zip(t["lo"], t["hi"], strict=True)], [(b - a) / 2 for a, b in zip(t["lo"], t["hi"], strict=True)]
        out = {"boundingVolume": {"box": [*mid, half[0], 0, 0, 0, half[1], 0, 0, 0, half[2]]}, "geometricError": t["error"], "refine": "REPLACE"}
        if t.get("url"):
            out["content"] = {"uri": t["url"]}
        if ident in children:
            out["children"] = [node(c) for c in sorted(children[ident])]
        return out

    root = node(sorted(children[None])[0])
    return json.dumps({"asset": {"version": "1.0"}, "geometricError": root["geometricError"], "root": root})


# --- Spark sources and sinks ------------------------------------------------------------------------------------------

PARSERS: dict[str, Callable] = {"obj": parse_obj, "ply": parse_ply, "stl": parse_stl}
PRINTERS: dict[str, Callable] = {"obj": format_obj, "ply": format_ply, "stl": format_stl}


def register_mesh_format(kind: str, parse: Callable, printer: Callable | None = None) -> None:
    """Make ``read_meshes`` and ``encode_meshes`` know files that end in ``kind``."""
    PARSERS[kind] = parse
    if printer:
        PRINTERS[kind] = printer


def files(spark: SparkSession, path: str, pattern: str = "*", recursive: bool = True) -> DataFrame:
    """Rows (path, modificationTime, length, content); leave content out of a selection and it is not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", recursive).load(path)


def read_meshes(spark: SparkSession, path: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """(vertices, faces) of all files of one kind under ``path``; the file's path is the mesh."""
    parse = PARSERS[kind]
    found = files(spark, path, f"*.{kind}").select("path", "content")

    def vertices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for mesh, data in zip(pdf["path"], pdf["content"], strict=True):
                rows = parse(data)[0]
                yield pd.DataFrame(rows, columns=["x", "y", "z", "nx", "ny", "nz", "u", "v"]).assign(mesh=mesh, vid=np.arange(len(rows), dtype=np.int32))[[f.split()[0] for f in VERTEX.split(", ")]]

    def faces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for mesh, data in zip(pdf["path"], pdf["content"], strict=True):
                rows = parse(data)[1]
                yield pd.DataFrame(rows, columns=["p0", "p1", "p2"]).assign(mesh=mesh, fid=np.arange(len(rows), dtype=np.int32))[["mesh", "fid", "p0", "p1", "p2"]]

    return found.mapInPandas(vertices, VERTEX), found.mapInPandas(faces, FACE)


def encode_meshes(vertices: DataFrame, faces: DataFrame, kind: str) -> DataFrame:
    """Rows (mesh, content): each mesh as one file's bytes. Meshes are assumed to fit a task, as a file must."""
    printer = PRINTERS[kind]

    def run(key: tuple, v: pd.DataFrame, f: pd.DataFrame) -> pd.DataFrame:
        v, f = v.sort_values("vid"), f.sort_values("fid")
        place = pd.Series(np.arange(len(v)), index=v["vid"])
        rows = np.stack([v[c].to_numpy(float) if c in v else np.full(len(v), np.nan) for c in ("x", "y", "z", "nx", "ny", "nz", "u", "v")], axis=1)
        tri = np.stack([place.loc[f[p]].to_numpy() for p in ("p0", "p1", "p2")], axis=1) if len(f) else np.zeros((0, 3), int)
        return pd.DataFrame({"mesh": [key[0]], "content": [printer(rows, tri)]})

    return vertices.groupBy("mesh").cogroup(faces.groupBy("mesh")).applyInPandas(run, "mesh string, content binary")


def read_images(spark: SparkSession, path: str, pattern: str = "*.p?m") -> DataFrame:
    """Pixels of all PGM and PPM files under ``path``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for img, data in zip(pdf["path"], pdf["content"], strict=True):
                px = parse_ppm(data)
                r, c, b = np.indices(px.shape).astype(np.int32)
                yield pd.DataFrame({"img": img, "row": r.ravel(), "col": c.ravel(), "band": b.ravel(), "val": px.ravel()})

    return files(spark, path, pattern).select("path", "content").mapInPandas(run, PIXEL)


def read_labels(spark: SparkSession, path: str, pattern: str = "*.IMG") -> DataFrame:
    """Rows (path, key, value) of image labels; a label ends at END, however long it is."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["path"], pdf["content"], strict=True):
                label = parse_pds_label(bytes(data))
                yield pd.DataFrame({"path": name, "key": list(label), "value": list(label.values())})

    return files(spark, path, pattern).select("path", "content").mapInPandas(run, "path string, key string, value string")


def read_archives(spark: SparkSession, path: str, pattern: str = "*.tar*") -> DataFrame:
    """Rows (path, name, content): the files in all archives under ``path``."""
    from .containers import untar

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for archive, data in zip(pdf["path"], pdf["content"], strict=True):
                for name, content in untar(bytes(data)):
                    yield pd.DataFrame({"path": [archive], "name": [name], "content": [content]})

    return files(spark, path, pattern).select("path", "content").mapInPandas(run, "path string, name string, content binary")


def write_catalog(df: DataFrame, path: str, keys: list[str]) -> None:
    """A catalog table as JSON lines, partitioned by its keys."""
    df.write.mode("overwrite").partitionBy(*keys).json(path)
