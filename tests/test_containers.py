"""Files by round trip, and by bytes put together here."""

import io
import struct
import tarfile

import numpy as np
import pytest

from orogen.sources import containers as c
from orogen.sources import formats


def mesh(rng, n=30, m=20):
    v = rng.uniform(-1, 1, (n, 8))
    return v, rng.integers(0, n, (m, 3)).astype(np.int32)


def test_meshes():
    rng = np.random.default_rng(1)
    v, f = mesh(rng)
    for read, write in ((c.parse_glb, c.format_glb), (c.parse_b3dm, c.format_b3dm), (c.parse_bob, c.format_bob)):
        v2, f2 = read(write(v, f))
        assert np.allclose(v2, v, atol=1e-6) and (f2 == f).all()
        bare = v.copy()
        bare[:, 3:] = np.nan
        v2, f2 = read(write(bare, f))
        assert np.allclose(v2[:, :3], v[:, :3], atol=1e-6) and np.isnan(v2[:, 3:]).all()
        v2, f2 = read(write(np.zeros((0, 8)), np.zeros((0, 3), int)))
        assert v2.shape == (0, 8) and f2.shape == (0, 3)
    assert c.glb_image(c.format_glb(v, f, b"picture")) == b"picture" and c.glb_image(c.format_glb(v, f)) is None
    big = np.zeros((70000, 8))
    assert (c.parse_glb(c.format_glb(big, np.array([[0, 1, 69999]])))[1] == [[0, 1, 69999]]).all()
    with pytest.raises(ValueError):
        c.format_bob(big, f)
    with pytest.raises(ValueError):
        c.parse_glb(c.format_glb(v, f)[:-20])
    points, colours = rng.uniform(-1, 1, (7, 3)), rng.integers(0, 256, (7, 3))
    p2, c2 = c.parse_pnts(c.format_pnts(points, colours))
    assert np.allclose(p2, points, atol=1e-6) and (c2 == colours).all() and c.parse_pnts(c.format_pnts(points))[1] is None
    tile = c.format_b3dm(v, f)
    assert struct.unpack_from("<I", tile, 8)[0] == len(tile) and tile.index(b"glTF") % 8 == 0


def test_strided_and_normalised_accessors():
    blob = struct.pack("<4H", 0, 7, 65535, 7)
    scene = {"bufferViews": [{"byteStride": 4}], "accessors": [{"bufferView": 0, "componentType": 5123, "count": 2, "type": "SCALAR", "normalized": True}]}
    assert c.accessor(scene, blob, 0).ravel().tolist() == [0.0, 1.0]
    scene["accessors"][0]["count"] = 3
    with pytest.raises(ValueError):
        c.accessor(scene, blob, 0)


def test_text_meshes():
    iv = b"#Inventor V2.1 ascii\n# a square\nSeparator { Coordinate3 { point [ 0 0 0, 1 0 0, 1 1 0, 0 1 0 ] } IndexedFaceSet { coordIndex [ 0, 1, 2, 3, -1, ] } }"
    v, f = c.parse_iv(iv)
    assert v[2, :3].tolist() == [1, 1, 0] and f.tolist() == [[0, 1, 2], [0, 2, 3]]
    mtl = {"one": {"Kd": "1 0 0", "map_Kd": "a b.png"}, "two": {}}
    assert c.parse_mtl(b"# x\n" + c.format_mtl(mtl)) == mtl
    head = "2\n3\n1 2 3\n1 0 0\n0 1 0\n0 0 1\n" + "".join(" ".join(str(int(i == j)) for j in range(4)) + "\n" for i in range(4))
    scan = c.parse_ptx((head + "".join(f"{i} {i + 0.5} 0 0.25 255 0 51\n" for i in range(6))).encode())
    assert scan["points"].shape == (3, 2, 3) and scan["points"][2, 1, 0] == 5 and scan["points"][1, 0, 0] == 1 and scan["colours"][0, 0].tolist() == [1, 0, 0.2]
    assert c.grid_triangles(np.array([[True, True, False], [True, True, True]])).tolist() == [[0, 3, 1], [1, 3, 4]]
    with pytest.raises(ValueError):
        c.parse_ptx((head + "1 2 3 4 5 6 7\n").encode())


def test_stl_keeps_normals():
    text = b"solid x\n facet normal 0 0 1\n  outer loop\n   vertex 0 0 0\n   vertex 1 0 0\n   vertex 0 1 0\n  endloop\n endfacet\nendsolid x\n"
    v, f = formats.parse_stl(text)
    assert v.shape == (3, 8) and (v[:, 3:6] == [0, 0, 1]).all() and len(f) == 1
    again, _ = formats.parse_stl(formats.format_stl(v, f))
    assert np.allclose(again[:, :6], v[:, :6])
    with pytest.raises(ValueError):
        formats.parse_stl(formats.format_stl(v, f)[:-10])


def test_images():
    rng = np.random.default_rng(2)
    for bands in (1, 2, 3, 4):
        px = rng.integers(0, 256, (5, 7, bands)).astype(float)
        assert (c.parse_png(c.format_png(px)) == px).all()
    for bands in (1, 3):
        px = rng.standard_normal((5, 7, bands)).astype("f4").astype(float)
        assert (c.parse_tiff(c.format_tiff(px)) == px).all()
        label, back = c.parse_pds(c.format_pds(px, {"TARGET_NAME": '"X"'}))
        assert (back == px).all() and label["TARGET_NAME"] == "X"
    cards = ["SIMPLE  =                    T", "BITPIX  =                   16", "NAXIS   =                    2", "NAXIS1  =                    3", "NAXIS2  =                    2", "BZERO   =                 10.0 / shift", "OBJECT  = 'it''s a / b'", "END"]
    fits = "".join(x.ljust(80) for x in cards).encode().ljust(2880) + np.arange(6, dtype=">i2").tobytes()
    head, px = c.parse_fits(fits)
    assert head["OBJECT"] == "it's a / b" and px[..., 0].tolist() == [[13, 14, 15], [10, 11, 12]]
    sgi = struct.pack(">hbbHHHH", 474, 0, 1, 3, 2, 2, 1).ljust(512, b"\0") + bytes([0, 51, 102, 255])
    assert c.parse_sgi(sgi)[..., 0].tolist() == [[0.4, 1.0], [0.0, 0.2]]
    label = b"LBLSIZE=80  FORMAT='REAL' NL=2 NAMES=('a b','c') "
    assert c.parse_vicar_label(label.ljust(80, b"\0"))["NAMES"] == "('a b','c')"


def test_png_filters():
    """Each line filter, made by hand for one grey row pair."""
    import zlib

    rows = np.array([[10, 20, 40, 80], [15, 27, 44, 90], [200, 3, 9, 255]], np.int64)
    chunk = lambda name, part: struct.pack(">I", len(part)) + name + part + struct.pack(">I", zlib.crc32(name + part))

    def paeth(a, b, d):
        return min((a, b, d), key=lambda v: abs(a + b - d - v))

    for kind in range(5):
        body = b""
        for r in range(3):
            up = rows[r - 1] if r else np.zeros(4, np.int64)
            line = []
            for i in range(4):
                left, corner = (rows[r, i - 1], up[i - 1]) if i else (0, 0)
                guess = (0, left, up[i], (left + up[i]) // 2, paeth(left, up[i], corner))[kind]
                line.append(int(rows[r, i] - guess) & 255)
            body += bytes([kind, *line])
        png = b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", 4, 3, 8, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(body)) + chunk(b"IEND", b"")
        assert (c.parse_png(png)[..., 0] == rows).all()


def test_archives(spark, tmp_path):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as archive:
        for name in ("a.txt", "d/b.txt"):
            info = tarfile.TarInfo(name)
            info.size = 3
            archive.addfile(info, io.BytesIO(b"xyz"))
    (tmp_path / "one.tar.gz").write_bytes(out.getvalue())
    assert sorted((r["name"], bytes(r["content"])) for r in formats.read_archives(spark, str(tmp_path)).collect()) == [("a.txt", b"xyz"), ("d/b.txt", b"xyz")]
    bad = io.BytesIO()
    with tarfile.open(fileobj=bad, mode="w") as archive:
        archive.addfile(tarfile.TarInfo("../x"))
    with pytest.raises(ValueError):
        c.untar(bad.getvalue())
    assert c.decompress(c.compress(b"abc" * 9)) == b"abc" * 9 and c.compress(b"abc") == c.compress(b"abc")
    assert c.format_json({"b": None, "a": [{"x": None, "y": 1}]}) == b'{"a":[{"y":1}]}'
    assert [c.sniff(x) for x in (c.format_png(np.zeros((1, 1, 1))), c.format_tiff(np.zeros((1, 1, 1))), b"glTF..", b"\x1f\x8b", b"?")] == ["png", "tiff", "glb", "gz", None]


def test_registered_format(spark, tmp_path):
    rng = np.random.default_rng(5)
    v, f = mesh(rng)
    formats.register_mesh_format("glb", c.parse_glb, c.format_glb)
    (tmp_path / "m.glb").write_bytes(c.format_glb(v, f))
    vertices, faces = formats.read_meshes(spark, str(tmp_path), "glb")
    assert vertices.count() == 30 and faces.count() == 20
    assert np.allclose(c.parse_glb(bytes(formats.encode_meshes(vertices, faces, "glb").first()["content"]))[0], v, atol=1e-6)
