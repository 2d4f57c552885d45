"""Commands over small folders."""

import json

import numpy as np
import pytest

from orogen import cli
from orogen.sources import containers, formats


def square(n, shift=0.0):
    z = np.fromfunction(lambda r, c: np.sin(r / 3) + np.cos(c / 4), (n, n))
    v, f = cli.height_mesh(z, 1.0)
    v[:, 0] += shift
    return v, f


def test_meshes_and_tiles(spark, tmp_path):
    source, tiles, glb = tmp_path / "in", tmp_path / "tiles", tmp_path / "glb"
    source.mkdir()
    (source / "a.ply").write_bytes(formats.format_ply(*square(12)))
    (source / "b.ply").write_bytes(formats.format_ply(*square(12, 11.0)))
    out = cli.main(["build-tileset", str(source), str(tiles), "--faces", "60", "--scheme", "QuadZ"], spark)
    tree = json.loads((tiles / "tileset.json").read_text())
    leaves, todo = [], [tree["root"]]
    while todo:
        node = todo.pop()
        todo += node.get("children", [])
        assert all(c["geometricError"] <= node["geometricError"] for c in node.get("children", []))
        if "content" in node:
            leaves.append(containers.parse_b3dm((tiles / node["content"]["uri"]).read_bytes()))
    assert len(leaves) == out["leaves"] and sum(len(f) for _, f in leaves) == 2 * 2 * 11 * 11 and max(len(f) for _, f in leaves) <= 60
    assert cli.main(["convert-gltf", str(source), str(glb)], spark) == {"files": 2}
    v, f = containers.parse_glb((glb / "a.glb").read_bytes())
    assert np.allclose(v, square(12)[0], atol=1e-5) and len(f) == 242
    (source / "c.iv").write_bytes(b"#Inventor V2.1 ascii\nCoordinate3 { point [ 0 0 0, 1 0 0, 1 1 0 ] } IndexedFaceSet { coordIndex [ 0, 1, 2, -1 ] }")
    assert cli.main(["convert-iv", str(source), str(glb), "--to", "stl"], spark) == {"files": 1}
    assert len(formats.parse_stl((glb / "c.stl").read_bytes())[1]) == 1


def test_images(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    px = np.random.default_rng(1).uniform(-5, 900, (6, 8, 1)).astype("f4").astype(float)
    (source / "a.IMG").write_bytes(containers.format_pds(px))
    assert cli.main(["convert-image", str(source), str(out), "--to", "tif"], spark) == {"files": 1}
    assert (containers.parse_tiff((out / "a.tif").read_bytes()) == px).all()
    assert cli.main(["convert-image", str(source), str(out), "--glob", "*.IMG"], spark) == {"files": 1}
    png = containers.parse_png((out / "a.png").read_bytes())
    assert png.min() == 0 and png.max() == 255
    assert cli.main(["dem2mesh", str(out), str(tmp_path / "m"), "--cell", "2"], spark)["files"] == 2
    px[2, 3] = np.nan
    v, f = cli.height_mesh(px[..., 0], 2.0)
    assert len(f) == 2 * (5 * 7 - 4) and np.isfinite(v).all() and f.max() == len(v) - 1


def test_fetch_ingest_and_manifest(spark, tmp_path):
    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for i in range(4):
        px = np.full((2, 2 + i, 1), float(i))
        (source / f"f{i}.IMG").write_bytes(containers.format_pds(px, {"FRAME_ID": "A" if i < 3 else "B", "VERSION": str(i), "GEOMETRY": "Linearized" if i == 1 else "Raw"}))
    (source / "x.txt").write_text("no")
    assert cli.main(["fetch", str(source), str(target), "--glob", "*.IMG", "--dry"], spark)["files"] == 4 and not target.exists()
    sizes = sorted(p.stat().st_size for p in source.glob("*.IMG"))
    some = cli.main(["fetch", str(source), str(target), "--glob", "*.IMG", "--budget", str(sizes[0] + sizes[1])], spark)
    assert 1 <= some["files"] <= 2 and some["bytes"] <= sizes[0] + sizes[1]
    assert cli.main(["fetch", str(source), str(target), "--glob", "*.IMG"], spark)["files"] == 4 - some["files"]
    assert all((target / p.name).read_bytes() == p.read_bytes() for p in source.glob("*.IMG"))
    assert cli.main(["ingest", str(target), str(tmp_path / "cat")], spark) == {"rows": 4, "best": 2}
    assert cli.main(["ingest", str(target), str(tmp_path / "cat")], spark)["rows"] == 4
    manifest = ["update-manifest", str(target), str(tmp_path / "man")]
    assert cli.main(manifest, spark) == {"files": 4, "added": 4, "changed": 0, "dropped": 0}
    (target / "f0.IMG").unlink()
    (target / "new.png").write_bytes(b"x")
    assert cli.main(manifest, spark) == {"files": 4, "added": 1, "changed": 0, "dropped": 1}
    assert cli.main(["benchmark", str(target), "--head", "10"], spark)["head_bytes"] == 31


def test_configure(spark, tmp_path):
    path = tmp_path / "c.json"
    assert cli.main(["configure", str(path), "--set", "faces_per_tile=7", "scheme=Oct"], spark)["faces_per_tile"] == 7
    assert cli.main(["configure", str(path)], spark)["scheme"] == "Oct"
    with pytest.raises(ValueError, match="unknown setting"):
        cli.main(["configure", str(path), "--set", "x=1"], spark)
