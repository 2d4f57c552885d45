"""glTF / GLB, 3D Tiles (b3dm, pnts), BOB, PTX, Inventor and MTL meshes; FITS, PDS, SGI, PNG and TIFF images; tar and gzip.

Plain functions of bytes. Meshes are (vertices: rows of position, normal, texture; triangles),
as in ``formats``, NaN standing for what a file lacks; images are rows x columns x bands.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import struct
import tarfile
import zlib

import numpy as np

from .formats import parse_pds_label

# Fixed values of the glTF 2.0 specification: component types, and numbers of each kind of element.
COMPONENTS = {5120: "i1", 5121: "u1", 5122: "<i2", 5123: "<u2", 5125: "<u4", 5126: "<f4"}
ELEMENTS = {"SCALAR": 1, "VEC2": 2, "VEC3": 3, "VEC4": 4, "MAT4": 16}


def _mesh(position: np.ndarray, normal: np.ndarray | None = None, place: np.ndarray | None = None) -> np.ndarray:
    n = len(position)
    return np.concatenate([np.asarray(position, float).reshape(n, 3), np.full((n, 3), np.nan) if normal is None else normal, np.full((n, 2), np.nan) if place is None else place], axis=1)


# --- glTF and 3D Tiles --------------------------------------------------------------------------------------------------


def glb_chunks(data: bytes) -> tuple[dict, bytes]:
    """(JSON, binary) of a GLB file of version 2."""
    if data[:4] != b"glTF" or struct.unpack_from("<I", data, 4)[0] != 2:
        raise ValueError("not a GLB file of version 2")
    scene, blob, at, end = {}, b"", 12, struct.unpack_from("<I", data, 8)[0]
    if end > len(data):
        raise ValueError("a GLB file is cut short")
    while at + 8 <= end:
        size, kind = struct.unpack_from("<I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if kind == b"JSON":
            scene = json.loads(part)
        elif kind == b"BIN\0":
            blob = part
        at += 8 + size
    return scene, blob


def accessor(scene: dict, blob: bytes, index: int) -> np.ndarray:
    """The values of an accessor, one row each; strided views and normalised integers are resolved."""
    a = scene["accessors"][index]
    view = scene["bufferViews"][a["bufferView"]]
    kind, width = np.dtype(COMPONENTS[a["componentType"]]), ELEMENTS[a["type"]]
    start, step = view.get("byteOffset", 0) + a.get("byteOffset", 0), view.get("byteStride", kind.itemsize * width)
    raw = np.frombuffer(blob, "u1")
    rows = np.lib.stride_tricks.as_strided(raw[start:], (a["count"], kind.itemsize * width), (step, 1))
    if a["count"] and start + step * (a["count"] - 1) + kind.itemsize * width > len(raw):
        raise ValueError("an accessor reaches past its buffer")
    out = np.ascontiguousarray(rows).view(kind).reshape(a["count"], width)
    if a.get("normalized") and kind.kind in "iu":
        return np.maximum(out / np.iinfo(kind).max, -1.0)
    return out


def parse_glb(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """All triangle primitives of a GLB's meshes, one after another, without the nodes' transforms."""
    scene, blob = glb_chunks(data)
    vertices, faces, base = [], [], 0
    for primitive in (p for m in scene.get("meshes", []) for p in m["primitives"]):
        own = primitive["attributes"]
        part = {k: accessor(scene, blob, own[k]) for k in ("POSITION", "NORMAL", "TEXCOORD_0") if k in own}
        place = part.get("TEXCOORD_0")
        if place is not None:  # texture rows run downwards in glTF
            place = np.column_stack([place[:, 0], 1 - place[:, 1]])
        vertices.append(_mesh(part["POSITION"], part.get("NORMAL"), place))
        corner = accessor(scene, blob, primitive["indices"]).ravel() if "indices" in primitive else np.arange(len(vertices[-1]))
        if primitive.get("mode", 4) == 4:
            faces.append(corner.astype(np.int64).reshape(-1, 3) + base)
        base += len(vertices[-1])
    return np.concatenate(vertices) if vertices else np.zeros((0, 8)), np.concatenate(faces).astype(np.int32) if faces else np.zeros((0, 3), np.int32)


def _padded(data: bytes, fill: bytes) -> bytes:
    return data + fill * (-len(data) % 4)


def format_glb(vertices: np.ndarray, faces: np.ndarray, image: bytes | None = None, mime: str = "image/png") -> bytes:
    """A GLB of one mesh with its texture, if given, in the binary chunk; 32-bit indices only where they are needed."""
    views, accessors, blob = [], [], b""

    def put(values: bytes, target: int | None = None) -> int:
        nonlocal blob
        views.append({"buffer": 0, "byteOffset": len(blob), "byteLength": len(values)} | ({"target": target} if target else {}))
        blob += _padded(values, b"\0")
        return len(views) - 1

    def add(values: np.ndarray, kind: str, code: int, target: int, limits: bool = False) -> int:
        entry = {"bufferView": put(np.ascontiguousarray(values).tobytes(), target), "componentType": code, "count": len(values), "type": kind}
        if limits and len(values):
            entry |= {"min": values.min(axis=0).tolist(), "max": values.max(axis=0).tolist()}
        accessors.append(entry)
        return len(accessors) - 1

    attributes = {"POSITION": add(vertices[:, :3].astype("<f4"), "VEC3", 5126, 34962, True)}
    if len(vertices) and not np.isnan(vertices[:, 3:6]).any():
        attributes["NORMAL"] = add(vertices[:, 3:6].astype("<f4"), "VEC3", 5126, 34962)
    if len(vertices) and not np.isnan(vertices[:, 6:8]).any():
        attributes["TEXCOORD_0"] = add(np.column_stack([vertices[:, 6], 1 - vertices[:, 7]]).astype("<f4"), "VEC2", 5126, 34962)
    small = len(vertices) < 65535
    primitive = {"attributes": attributes, "indices": add(faces.reshape(-1).astype("<u2" if small else "<u4"), "SCALAR", 5123 if small else 5125, 34963), "mode": 4}
    scene = {"asset": {"version": "2.0"}, "scene": 0, "scenes": [{"nodes": [0]}], "nodes": [{"mesh": 0}], "meshes": [{"primitives": [primitive]}]}
    if image is not None:
        scene |= {"images": [{"bufferView": put(image), "mimeType": mime}], "textures": [{"source": 0}], "materials": [{"pbrMetallicRoughness": {"baseColorTexture": {"index": 0}, "metallicFactor": 0}}]}
        primitive["material"] = 0
    scene |= {"bufferViews": views, "accessors": accessors, "buffers": [{"byteLength": len(blob)}]}
    text = _padded(json.dumps(scene, separators=(",", ":")).encode(), b" ")
    size = 12 + 8 + len(text) + 8 + len(blob)
    return struct.pack("<4sII", b"glTF", 2, size) + struct.pack("<I4s", len(text), b"JSON") + text + struct.pack("<I4s", len(blob), b"BIN\0") + blob


def glb_image(data: bytes) -> bytes | None:
    """The first image in a GLB's binary chunk."""
    scene, blob = glb_chunks(data)
    for image in scene.get("images", []):
        if "bufferView" in image:
            view = scene["bufferViews"][image["bufferView"]]
            return blob[view.get("byteOffset", 0) :][: view["byteLength"]]
    return None


def _tile(magic: bytes, table: dict, body: bytes, payload: bytes = b"") -> bytes:
    head = _padded(json.dumps(table, separators=(",", ":")).encode(), b" ")
    head += b" " * (-(28 + len(head)) % 8)  # the parts begin at multiples of eight
    body = body + b"\0" * (-len(body) % 8)
    size = 28 + len(head) + len(body) + len(payload)
    return struct.pack("<4s6I", magic, 1, size, len(head), len(body), 0, 0) + head + body + payload


def _untile(data: bytes, magic: bytes) -> tuple[dict, bytes, bytes]:
    if data[:4] != magic:
        raise ValueError(f"not a {magic.decode()} tile")
    _, size, n_head, n_body, n_batch, n_more = struct.unpack_from("<6I", data, 4)
    at = 28 + n_head
    return json.loads(data[28:at] or b"{}"), data[at : at + n_body], data[at + n_body + n_batch + n_more : size]


def format_b3dm(vertices: np.ndarray, faces: np.ndarray, image: bytes | None = None) -> bytes:
    return _tile(b"b3dm", {"BATCH_LENGTH": 0}, b"", format_glb(vertices, faces, image))


def parse_b3dm(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    return parse_glb(_untile(data, b"b3dm")[2])


def format_pnts(points: np.ndarray, colours: np.ndarray | None = None) -> bytes:
    """A point tile; colours as whole numbers up to 255."""
    place = points.astype("<f4").tobytes()
    table = {"POINTS_LENGTH": len(points), "POSITION": {"byteOffset": 0}} | ({"RGB": {"byteOffset": len(place)}} if colours is not None else {})
    return _tile(b"pnts", table, place + (colours.astype("u1").tobytes() if colours is not None else b""))


def parse_pnts(data: bytes) -> tuple[np.ndarray, np.ndarray | None]:
    table, body, _ = _untile(data, b"pnts")
    n = table["POINTS_LENGTH"]
    points = np.frombuffer(body, "<f4", 3 * n, table["POSITION"]["byteOffset"]).reshape(n, 3).astype(float)
    return points, np.frombuffer(body, "u1", 3 * n, table["RGB"]["byteOffset"]).reshape(n, 3) if "RGB" in table else None


# --- other meshes --------------------------------------------------------------------------------------------------------


def format_bob(vertices: np.ndarray, faces: np.ndarray) -> bytes:
    """Binary OBJ, version 5: 16-bit counts and indices, no buckets. Raises beyond 65535 vertices or faces."""
    if max(len(vertices), len(faces)) > 65535:
        raise ValueError("a BOB mesh has at most 65535 vertices and faces")
    has = [bool(len(vertices)) and not np.isnan(vertices[:, a:b]).any() for a, b in ((6, 8), (3, 6))]
    counts = struct.pack("<5H", 5, len(vertices), len(vertices) * has[0], len(vertices) * has[1], len(faces))
    parts = [vertices[:, :3], *([vertices[:, 6:8]] if has[0] else []), *([vertices[:, 3:6]] if has[1] else [])]
    low, high = (f(vertices[:, :3], axis=0) if len(vertices) else np.zeros(3) for f in (np.min, np.max))
    tail = struct.pack("<H6fH", 0, *low, *high, 0)
    return counts + b"".join(p.astype("<f4").tobytes() for p in parts) + faces.astype("<u2").tobytes() + tail


def parse_bob(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    version, n, n_place, n_normal, n_face = struct.unpack_from("<5H", data)
    if version != 5:
        raise ValueError(f"BOB version {version}, not 5")
    at, parts = 10, []
    for count, width in ((n, 3), (n_place, 2), (n_normal, 3)):
        parts.append(np.frombuffer(data, "<f4", count * width, at).reshape(count, width).astype(float))
        at += 4 * count * width
    place, normal = (p if len(p) == n else None for p in parts[1:])
    return _mesh(parts[0], normal, place), np.frombuffer(data, "<u2", 3 * n_face, at).reshape(-1, 3).astype(np.int32)


def parse_ptx(data: bytes) -> dict:
    """A scan: sensor (4 x 3), matrix (16), points and colours (rows x columns x 3, colours 0 to 1), intensity (rows x columns)."""
    lines = io.StringIO(data.decode("ascii", "replace"))
    cols, rows = int(next(lines)), int(next(lines))
    head = [[float(v) for v in next(lines).split()] for _ in range(8)]
    values = np.array([line.split() for line in lines if line.strip()], float)
    if values.shape != (rows * cols, 7):
        raise ValueError("a PTX scan has seven numbers for each of its points")
    grid = values.reshape(cols, rows, 7).transpose(1, 0, 2)  # stored a column at a time
    return {"sensor": np.array(head[:4]), "matrix": np.array(head[4:]).ravel(), "points": grid[..., :3], "intensity": grid[..., 3], "colours": grid[..., 4:] / 255}


def grid_triangles(valid: np.ndarray) -> np.ndarray:
    """Two triangles for each square of four valid grid points, indices row by row; none where a corner is missing."""
    rows, cols = valid.shape
    at = np.arange(rows * cols).reshape(rows, cols)
    a, b, c, d = at[:-1, :-1], at[:-1, 1:], at[1:, :-1], at[1:, 1:]
    good = valid[:-1, :-1] & valid[:-1, 1:] & valid[1:, :-1] & valid[1:, 1:]
    return np.stack([np.stack([a, c, b], axis=-1)[good], np.stack([b, c, d], axis=-1)[good]], axis=1).reshape(-1, 3).astype(np.int32)


def parse_iv(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """An ASCII Inventor scene's Coordinate3 / IndexedFaceSet parts; polygons are fanned, separators are -1."""
    if not data.startswith(b"#Inventor V2.") or b"ascii" not in data[:40]:
        raise ValueError("not an ASCII Inventor 2 file")
    text = re.sub(r"#[^\n]*", " ", data.decode("ascii", "replace"))
    points, faces = [], []
    for key, body in re.findall(r"\b(point|coordIndex)\s*\[([^\]]*)\]", text):
        if key == "point":
            points.append(np.array(re.split(r"[\s,]+", body.strip(" \n\t\r,")), float).reshape(-1, 3))
        else:
            base, ring = sum(map(len, points[:-1])), []
            for i in [int(v) for v in re.split(r"[\s,]+", body.strip(" \n\t\r,"))] + [-1]:
                if i >= 0:
                    ring.append(base + i)
                    continue
                faces += [(ring[0], ring[k], ring[k + 1]) for k in range(1, len(ring) - 1)]
                ring = []
    return _mesh(np.concatenate(points) if points else np.zeros((0, 3))), np.array(faces, np.int32).reshape(-1, 3)


def parse_mtl(data: bytes) -> dict[str, dict[str, str]]:
    """Materials by name: their statements as text, such as map_Kd, the texture's file."""
    out: dict[str, dict[str, str]] = {}
    own: dict[str, str] = {}
    for line in data.decode("utf-8", "replace").splitlines():
        key, _, value = line.split("#")[0].strip().partition(" ")
        if key == "newmtl":
            own = out.setdefault(value.strip(), {})
        elif key:
            own[key] = value.strip()
    return out


def format_mtl(materials: dict[str, dict[str, str]]) -> bytes:
    return "".join(f"newmtl {name}\n" + "".join(f"{k} {v}\n" for k, v in own.items()) for name, own in materials.items()).encode()


# --- images --------------------------------------------------------------------------------------------------------------


def parse_fits(data: bytes) -> tuple[dict[str, str], np.ndarray]:
    """(header, rows x columns x bands) of the primary part of a FITS file; scale and zero are applied, the first row is the lowest."""
    header, at = {}, 0
    while True:
        card = data[at : at + 80].decode("ascii", "replace")
        if len(card) < 80:
            raise ValueError("a FITS header without END")
        at += 80
        if card.startswith("END "):
            break
        if card[8:10] == "= ":
            value = card[10:]
            quoted = re.match(r"\s*'((?:[^']|'')*)'", value)
            header[card[:8].strip()] = quoted[1].replace("''", "'").rstrip() if quoted else value.split("/")[0].strip()
    at = -(-at // 2880) * 2880
    kind = {8: "u1", 16: ">i2", 32: ">i4", 64: ">i8", -32: ">f4", -64: ">f8"}[int(header["BITPIX"])]
    sizes = [int(header[f"NAXIS{i}"]) for i in range(int(header["NAXIS"]), 0, -1)]
    px = np.frombuffer(data, kind, int(np.prod(sizes)), at).astype(float).reshape([1] * (3 - len(sizes)) + sizes)
    px = px * float(header.get("BSCALE", 1)) + float(header.get("BZERO", 0))
    return header, px.transpose(1, 2, 0)[::-1]


def parse_pds(data: bytes) -> tuple[dict[str, str], np.ndarray]:
    """(label, rows x columns x bands) of a PDS image with an attached label."""
    label = parse_pds_label(data)
    own = {k.rsplit(".", 1)[-1]: v for k, v in label.items() if k.startswith("IMAGE.")}
    rows, cols, bands, bits = int(own["LINES"]), int(own["LINE_SAMPLES"]), int(own.get("BANDS", 1)), int(own["SAMPLE_BITS"])
    sample = own["SAMPLE_TYPE"].upper()
    letter = "f" if "REAL" in sample else "u" if "UNSIGNED" in sample else "i"
    order = "<" if re.search("LSB|PC|VAX", sample) else ">"
    where = label["^IMAGE"]
    record = int(label.get("RECORD_BYTES", 1))
    start = int(re.sub(r"\D", "", where)) - 1 if "BYTES" in where.upper() else (int(where) - 1) * record
    px = np.frombuffer(data, f"{order}{letter}{bits // 8}", rows * cols * bands, start).astype(float)
    if own.get("BAND_STORAGE_TYPE", "BAND_SEQUENTIAL") == "SAMPLE_INTERLEAVED":
        return label, px.reshape(rows, cols, bands)
    if own.get("BAND_STORAGE_TYPE") == "LINE_INTERLEAVED":
        return label, px.reshape(rows, bands, cols).transpose(0, 2, 1)
    return label, px.reshape(bands, rows, cols).transpose(1, 2, 0)


def format_pds(pixels: np.ndarray, more: dict[str, str] | None = None) -> bytes:
    """A PDS image of 32-bit floats, most significant byte first, bands in sequence."""
    rows, cols, bands = pixels.shape
    record = cols * 4

    def label(records: int) -> str:
        lines = ["PDS_VERSION_ID = PDS3", "RECORD_TYPE = FIXED_LENGTH", f"RECORD_BYTES = {record}", f"LABEL_RECORDS = {records}", f"^IMAGE = {records + 1}", *(f"{k} = {v}" for k, v in (more or {}).items())]
        lines += ["OBJECT = IMAGE", f"LINES = {rows}", f"LINE_SAMPLES = {cols}", f"BANDS = {bands}", "BAND_STORAGE_TYPE = BAND_SEQUENTIAL", "SAMPLE_TYPE = IEEE_REAL", "SAMPLE_BITS = 32", "END_OBJECT = IMAGE", "END", ""]
        return "\r\n".join(lines)

    records = 1
    while len(label(records)) > records * record:
        records += 1
    return label(records).encode().ljust(records * record) + pixels.transpose(2, 0, 1).astype(">f4").tobytes()


def parse_sgi(data: bytes) -> np.ndarray:
    """Rows x columns x bands, 0 to 1, of an SGI image without run lengths and one byte a channel; the lowest row is stored first."""
    magic, storage, width, _, cols, rows, bands = struct.unpack_from(">hbbHHHH", data)
    if magic != 474 or storage or width > 1:
        raise ValueError("not a plain SGI image of one byte a channel")
    return np.frombuffer(data, "u1", rows * cols * bands, 512).reshape(bands, rows, cols).transpose(1, 2, 0)[::-1] / 255


def format_png(pixels: np.ndarray) -> bytes:
    """A PNG of whole numbers up to 255: one band grey, two grey and alpha, three colours, four with alpha."""
    rows, cols, bands = pixels.shape
    body = np.concatenate([np.zeros((rows, 1), np.uint8), np.clip(np.rint(pixels), 0, 255).astype(np.uint8).reshape(rows, -1)], axis=1)
    chunk = lambda name, part: struct.pack(">I", len(part)) + name + part + struct.pack(">I", zlib.crc32(name + part))
    head = struct.pack(">IIBBBBB", cols, rows, 8, {1: 0, 2: 4, 3: 2, 4: 6}[bands], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(body.tobytes(), 6)) + chunk(b"IEND", b"")


def parse_png(data: bytes) -> np.ndarray:
    """Rows x columns x bands of a PNG of 8 or 16 bits a channel, without palette or interlacing."""
    if data[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG file")
    at, packed, head = 8, b"", ()
    while at < len(data):
        size, name = struct.unpack_from(">I4s", data, at)
        part = data[at + 8 : at + 8 + size]
        if name == b"IHDR":
            head = struct.unpack(">IIBBBBB", part)
        elif name == b"IDAT":
            packed += part
        at += 12 + size
    cols, rows, bits, colour, _, _, interlaced = head
    if bits not in (8, 16) or colour == 3 or interlaced:
        raise ValueError("a PNG with a palette, interlacing or small samples")
    bands, wide = {0: 1, 4: 2, 2: 3, 6: 4}[colour], bits // 8
    step, line = bands * wide, cols * bands * wide
    raw = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(rows, line + 1)
    out = np.zeros((rows, line), np.uint8)
    above = np.zeros(line, np.int64)
    for r in range(rows):
        kind, own = int(raw[r, 0]), raw[r, 1:].astype(np.int64)
        if kind == 2:
            own = (own + above) & 255
        elif kind == 1:
            own = (np.cumsum(own.reshape(-1, step), axis=0) & 255).ravel()
        elif kind > 2:
            for i in range(line):
                left, up, corner = (own[i - step] if i >= step else 0), above[i], (above[i - step] if i >= step else 0)
                if kind == 3:
                    guess = (left + up) // 2
                else:
                    guess = min((left, up, corner), key=lambda v: abs(left + up - corner - v))
                own[i] = (own[i] + guess) & 255
        out[r], above = own, own
    return out.view(">u2" if wide == 2 else np.uint8).astype(float).reshape(rows, cols, bands)


# Fixed values of the TIFF 6 specification: tags, and field types 3 (16 bits) and 4 (32 bits).
TIFF_TAGS = {"width": 256, "height": 257, "bits": 258, "compression": 259, "photometric": 262, "offsets": 273, "samples": 277, "rows": 278, "sizes": 279, "planar": 284, "format": 339}


def format_tiff(pixels: np.ndarray) -> bytes:
    """An uncompressed TIFF of 32-bit floats in one strip, samples side by side."""
    rows, cols, bands = pixels.shape
    body = pixels.astype("<f4").tobytes()
    fields = [("width", 4, [cols]), ("height", 4, [rows]), ("bits", 3, [32] * bands), ("compression", 3, [1]), ("photometric", 3, [2 if bands >= 3 else 1]), ("offsets", 4, [8]), ("samples", 3, [bands]), ("rows", 4, [rows]), ("sizes", 4, [len(body)]), ("planar", 3, [1]), ("format", 3, [3] * bands)]
    at = 8 + len(body) + (len(body) & 1)
    after = at + 2 + 12 * len(fields) + 4
    entries, extra = b"", b""
    for name, kind, values in fields:
        packed = struct.pack(f"<{len(values)}{'H' if kind == 3 else 'I'}", *values)
        if len(packed) > 4:
            place, extra = struct.pack("<I", after + len(extra)), extra + packed + b"\0" * (len(packed) & 1)
        else:
            place = packed.ljust(4, b"\0")
        entries += struct.pack("<HHI", TIFF_TAGS[name], kind, len(values)) + place
    return struct.pack("<2sHI", b"II", 42, at) + body + b"\0" * (len(body) & 1) + struct.pack("<H", len(fields)) + entries + b"\0" * 4 + extra


def parse_tiff(data: bytes) -> np.ndarray:
    """Rows x columns x bands of an uncompressed TIFF in strips, either byte order, whole numbers or floats."""
    order = {b"II": "<", b"MM": ">"}[data[:2]]
    at = struct.unpack_from(order + "I", data, 4)[0]
    names, found = {v: k for k, v in TIFF_TAGS.items()}, {}
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if tag in names and kind in (3, 4):
            letter, place = ("H", 2) if kind == 3 else ("I", 4), at + 10 + 12 * i
            if count * letter[1] > 4:
                place = struct.unpack_from(order + "I", data, place)[0]
            found[names[tag]] = struct.unpack_from(f"{order}{count}{letter[0]}", data, place)
    if found.get("compression", (1,))[0] != 1:
        raise ValueError("a compressed TIFF")
    bands = found.get("samples", (1,))[0]
    letter = {1: "u", 2: "i", 3: "f"}[found.get("format", (1,))[0]]
    body = b"".join(data[a : a + n] for a, n in zip(found["offsets"], found["sizes"], strict=True))
    px = np.frombuffer(body, f"{order}{letter}{found['bits'][0] // 8}").astype(float)
    rows, cols = found["height"][0], found["width"][0]
    return px.reshape(bands, rows, cols).transpose(1, 2, 0) if found.get("planar", (1,))[0] == 2 else px.reshape(rows, cols, bands)


# --- archives and products ---------------------------------------------------------------------------------------------


def untar(data: bytes, gathered: bool = False) -> list[tuple[str, bytes]]:
    """(name, content) of the plain files of a tar archive, gzipped or not; names that leave the archive are refused."""
    out = []
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as archive:
        for member in archive:
            if member.isfile():
                if member.name.startswith("/") or ".." in member.name.split("/"):
                    raise ValueError(f"{member.name} leaves the archive")
                out.append((member.name, archive.extractfile(member).read()))
    return sorted(out) if gathered else out


def compress(data: bytes) -> bytes:
    return gzip.compress(data, 6, mtime=0)


def decompress(data: bytes) -> bytes:
    return gzip.decompress(data)


def format_json(value: object) -> bytes:
    """JSON without entries that are null, keys in order."""

    def clean(v: object) -> object:
        if isinstance(v, dict):
            return {k: clean(x) for k, x in v.items() if x is not None}
        return [clean(x) for x in v] if isinstance(v, (list, tuple)) else v

    return json.dumps(clean(value), sort_keys=True, separators=(",", ":")).encode()


# The first bytes that tell kinds of files.
MAGIC = {"glb": b"glTF", "b3dm": b"b3dm", "pnts": b"pnts", "ply": b"ply", "png": b"\x89PNG", "fits": b"SIMPLE  =", "pds": b"PDS_VERSION_ID", "vicar": b"LBLSIZE", "gz": b"\x1f\x8b", "iv": b"#Inventor", "sgi": b"\x01\xda", "pgm": b"P5", "ppm": b"P6", "jpg": b"\xff\xd8\xff"}


def sniff(data: bytes) -> str | None:
    """The kind of a file by its first bytes."""
    if data[:4] in (b"II*\0", b"MM\0*"):
        return "tiff"
    return next((kind for kind, magic in MAGIC.items() if data.startswith(magic)), None)


def parse_vicar_label(data: bytes) -> dict[str, str]:
    """KEY=VALUE pairs of a VICAR label; values in quotes or parentheses may hold blanks."""
    size = int(re.match(rb"LBLSIZE\s*=\s*(\d+)", data)[1])
    text = data[:size].split(b"\0")[0].decode("ascii", "replace")
    return {k: v.strip("'") for k, v in re.findall(r"(\w+)\s*=\s*('(?:[^']|'')*'|\([^)]*\)|\S+)", text)}
