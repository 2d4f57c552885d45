"""Queries of identifiers, fits, frames and masks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import ids, text
from ..operators import fitting, frames, masks, mesh
from ..tables import read
from .terrain import _image


def site_drive_codes(spark, sf_dir):
    site, drive = F.col("p_partkey") * 37 % 32768, F.col("p_partkey") * 91 % 65536
    code = F.concat(ids.site_code(site), ids.drive_code(drive))
    found = ids.site_drive(F.col("code"))
    return read(spark, sf_dir, "part").select("p_partkey", code.alias("code")).select("p_partkey", "code", found["site"].alias("site"), found["drive"].alias("drive"))


def version_chain(spark, sf_dir):
    own = F.concat(F.repeat(F.lit("X"), 35), (F.col("p_partkey") % 6).cast("string"))
    return read(spark, sf_dir, "part").select("p_partkey", F.explode(ids.descending_versions(own, "short", 1)).alias("id"))


def camera_kinds(spark, sf_dir):
    color = F.array(*map(F.lit, ("FullColor", "Grayscale", "Green", "Red", "Blue", "Other")))[F.col("p_size") % 6]
    camera = F.array(*map(F.lit, ("FrontHazcamLeft", "RearHazcam", "NavcamLeft", "MastcamZ", "Hazcam")))[F.col("p_partkey") % 5]
    kind = F.array(*map(F.lit, ("Hazcam", "FrontHazcam", "Navcam", "Mastcam")))[F.col("p_size") % 4]
    return read(spark, sf_dir, "part").select("p_partkey", ids.band_preference(color).alias("rank"), ids.is_camera(kind, camera).alias("of_kind"))


def readable_numbers(spark, sf_dir):
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", ids.duration_text(F.col("o_orderkey") * 977).alias("duration"), ids.magnitude_text(F.col("o_totalprice").cast("double") * F.col("o_orderkey") % 3e7 + 0.003).alias("size")
    )


def url_canonical(spark, sf_dir):
    url = F.concat(F.upper("url"), F.lit("\\x//"))
    return read(spark, sf_dir, "pages").select("page_id", text.normalize_url(url).alias("url"), text.normalize_url(text.strip_protocol(url), "ftp").alias("ftp"))


def glob_match(spark, sf_dir):
    url = F.col("url")
    return read(spark, sf_dir, "pages").select(
        "page_id", text.like_glob(url, "http*/*1*").alias("any"), text.like_glob(url, "http*//*/*1?", slashes=False).alias("part"), text.like_glob(url, "(page|post)?", alternation=True, full=False).alias("either")
    )


def hash_fold(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", ids.combine_hashes(F.col("l_orderkey"), F.col("l_partkey"), F.col("l_linenumber")).alias("hash"))


def truncated_histogram(spark, sf_dir):
    return fitting.truncated_histogram(read(spark, sf_dir, "events"), F.col("value").cast("double") - 50, 7.0, "event_type")


def name_prefix(spark, sf_dir):
    return text.common_prefix(read(spark, sf_dir, "part"), "p_name", "p_size")


def sol_times(spark, sf_dir):
    when = ids.sol_to_utc(F.col("p_partkey"))
    return read(spark, sf_dir, "part").select("p_partkey", ids.millis_since_epoch(when).alias("ms"))


def _vec(i):
    return g.vec(*[F.col("embedding")[i + k].cast("double") for k in range(3)])


def box_splits(spark, sf_dir):
    lo = _vec(0)
    whole = g.box(lo, g.add(lo, g.vec(*[F.abs(F.col("embedding")[3 + k].cast("double")) + 0.01 for k in range(3)])))
    rows = read(spark, sf_dir, "embeddings")
    pick = lambda name, arr: rows.select("vec_id", F.lit(name).alias("cut"), F.posexplode(arr).alias("part", "b"), g.box_longest_axis(whole).alias("longest"), g.box_shortest_axis(whole).alias("shortest"))
    out = pick("half", g.box_halves(whole, "y", 0.25)).union(pick("quarter", g.box_quarters(whole, "x")))
    return out.select("vec_id", "cut", "part", "longest", "shortest", *[F.round(F.col(f"b.{e}.{c}"), 6).alias(f"{e}_{c}") for e in ("lo", "hi") for c in "yz"])


def _points(spark, sf_dir):
    return read(spark, sf_dir, "embeddings").select("vec_id", "label", *[F.col("embedding")[i].cast("double").alias(f"e{i + 1}") for i in range(6)])


def rms_by_type(spark, sf_dir):
    return read(spark, sf_dir, "events").groupBy("event_type").agg(F.round(fitting.rms(F.col("value").cast("double")), 6).alias("rms"))


def covariance(spark, sf_dir):
    out = fitting.mean_and_covariance(_points(spark, sf_dir), ["label"], ["e1", "e2"])
    return out.select("label", "n", *[F.round(F.col("mean")[i], 6).alias(f"m{i + 1}") for i in range(2)], *[F.round(F.col("covariance")[i], 6).alias(c) for i, c in ((0, "xx"), (1, "xy"), (3, "yy"))])


def plane_fit(spark, sf_dir):
    points = _points(spark, sf_dir).select("label", F.col("e1").alias("x"), F.col("e2").alias("y"), (F.col("e3") * 0.1 + F.col("e1") * 0.5).alias("z"))
    return fitting.fit_planes(points, ["label"]).select("label", "n", *[F.round(c, 5).alias(c) for c in ("cx", "cy", "cz", "nx", "ny", "nz")])


def rigid_fit(spark, sf_dir):
    pairs = _points(spark, sf_dir).select("label", F.col("e1").alias("mx"), F.col("e2").alias("my"), (F.col("e1") * 0.8 - F.col("e2") * 0.6 + 3 + F.col("e3") * 0.1).alias("fx"), (F.col("e1") * 0.6 + F.col("e2") * 0.8 - 1 + F.col("e4") * 0.1).alias("fy"))
    return fitting.rigid_2d(pairs, ["label"]).select("label", "n", *[F.round(c, 5).alias(c) for c in ("tx", "ty", "angle", "residual")])


def similarity_fit(spark, sf_dir):
    """A turn about z; the oracle has the closed form for points in a plane."""
    pairs = _points(spark, sf_dir).select(
        "label", F.col("e1").alias("mx"), F.col("e2").alias("my"), F.lit(0.0).alias("mz"), (F.col("e1") * 0.8 - F.col("e2") * 0.6 + 3 + F.col("e3") * 0.1).alias("fx"), (F.col("e1") * 0.6 + F.col("e2") * 0.8 - 1 + F.col("e4") * 0.1).alias("fy"), F.lit(0.0).alias("fz")
    )
    out = fitting.similarity_3d(pairs, ["label"])
    return out.select("label", "n", F.round(F.atan2(F.col("rotation")[3], F.col("rotation")[0]), 5).alias("angle"), F.round("residual", 5).alias("residual"))


def file_ages(spark, sf_dir):
    lines = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("path"), F.col("o_orderkey").alias("size"), F.col("o_orderdate").alias("seen"))
    return fitting.summed_files(lines, "path", "size", "seen")


def _frames(spark, sf_dir):
    """Regions, nations and customers as frames: turned about z and shifted by their keys."""

    def rows(table, ident, key, parent):
        cos, sin = F.cos(F.col(key).cast("double")), F.sin(F.col(key).cast("double"))
        zero, one = F.lit(0.0), F.lit(1.0)
        matrix = F.array(cos, sin, zero, zero, -sin, cos, zero, zero, zero, zero, one, zero, F.col(key).cast("double") % 7, F.col(key).cast("double") % 5, zero, one)
        return read(spark, sf_dir, table).select(F.concat(F.lit(ident), key).alias("frame"), parent.alias("parent"), matrix.alias("matrix"))

    regions = rows("region", "r", "r_regionkey", F.lit(None).cast("string"))
    return regions.union(rows("nation", "n", "n_nationkey", F.concat(F.lit("r"), "n_regionkey"))).union(rows("customer", "c", "c_custkey", F.concat(F.lit("n"), "c_nationkey")))


def frame_to_root(spark, sf_dir):
    out = frames.to_root(_frames(spark, sf_dir), 4)
    return out.select("frame", "root", "steps", F.round(F.col("matrix")[0], 6).alias("m0"), F.round(F.col("matrix")[12], 6).alias("tx"), F.round(F.col("matrix")[13], 6).alias("ty"))


def frame_relative(spark, sf_dir):
    """From every customer's frame to that of its region's first nation."""
    roots = frames.to_root(_frames(spark, sf_dir), 4)
    first = read(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.min("n_nationkey").alias("b"))
    own = read(spark, sf_dir, "customer").join(read(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(first, "n_regionkey")
    out = frames.relative(own.select(F.concat(F.lit("c"), "c_custkey").alias("a"), F.concat(F.lit("n"), "b").alias("b")), roots)
    return out.select("a", "b", F.round(F.col("matrix")[0], 6).alias("m0"), F.round(F.col("matrix")[12], 5).alias("tx"), F.round(F.col("matrix")[13], 5).alias("ty"))


def best_transform(spark, sf_dir):
    rows = read(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("frame"), F.col("l_returnflag").alias("source")).agg(F.max("l_quantity").cast("double").alias("matrix"))
    return frames.best_transforms(rows, ["R", "A"])


def _mask(spark, sf_dir):
    px = _image(spark, sf_dir)
    mean = px.agg(F.avg("val").alias("m"))
    return px.crossJoin(F.broadcast(mean)).select("img", "row", "col", (F.col("val") > F.col("m")).alias("valid"))  # one row


def mask_sparse(spark, sf_dir):
    return masks.mask_sparse_blocks(_mask(spark, sf_dir), 4, 0.5).select("row", "col", "valid")


def mask_regions(spark, sf_dir):
    return masks.keep_largest_regions(_mask(spark, sf_dir), 0.5).select("row", "col", "valid")


def mask_outer(spark, sf_dir):
    return masks.outer_regions(_mask(spark, sf_dir)).select("row", "col")


def mask_dilate(spark, sf_dir):
    px = _mask(spark, sf_dir).withColumn("val", F.col("valid").cast("double"))
    return masks.dilate(px, 1).select("row", "col", F.col("val").alias("grown")).join(masks.dilate(px, 1, erode=True).select("row", "col", F.col("val").alias("shrunk")), ["row", "col"])


def _surface(spark, sf_dir):
    """Vertices from the vectors, faces of three successive ones."""
    points = read(spark, sf_dir, "embeddings").select(F.lit("m").alias("mesh"), F.col("vec_id").alias("vid"), *[F.col("embedding")[i].cast("double").alias(c) for i, c in enumerate(("x", "y", "z", "u", "v"))])
    faces = points.select("mesh", F.col("vid").alias("fid"), F.col("vid").alias("p0"), (F.col("vid") + 1).alias("p1"), (F.col("vid") + 2).alias("p2")).where("vid % 3 = 0")
    return points, faces


def mesh_ranges(spark, sf_dir):
    return mesh.ranges(_surface(spark, sf_dir)[0], ["u", "v"]).select(*[F.round(c, 6).alias(c) for c in ("min_u", "max_u", "min_v", "max_v")])


def texture_area(spark, sf_dir):
    points, faces = _surface(spark, sf_dir)
    return mesh.texture_area(points, faces, 10.0, 20.0).select(F.round("area", 4).alias("area"))


def mesh_corners(spark, sf_dir):
    return mesh.extreme_corners(_surface(spark, sf_dir)[0]).select("quadrant", "vid")


def surface_heights(spark, sf_dir):
    points, faces = _surface(spark, sf_dir)
    return mesh.height_map(points, faces, 0.1).select("row", "col", F.round("height", 5).alias("height"), "n")


def plane_split(spark, sf_dir):
    points, faces = _surface(spark, sf_dir)
    parts = mesh.split_by_plane(points, faces, (0.0, 0.0, 1.0), 0.0)
    area = g.triangle_area(*[g.vec(F.col(f"{c}x"), F.col(f"{c}y"), F.col(f"{c}z")) for c in "abc"])
    return parts.groupBy("fid").agg(F.round(F.sum(area), 5).alias("area"), F.sum((F.col("az") + F.col("bz") + F.col("cz") > 0).cast("int")).alias("above"), F.count(F.lit(1)).alias("parts"))


def mesh_islands(spark, sf_dir):
    points, faces = _surface(spark, sf_dir)
    return mesh.islands(points, faces).select("vid", "island", F.round("size", 5).alias("size"))


_NAMES = [
    site_drive_codes, version_chain, camera_kinds, readable_numbers, url_canonical, glob_match, hash_fold, truncated_histogram, name_prefix, sol_times, box_splits, rms_by_type, covariance,
    plane_fit, rigid_fit, similarity_fit, file_ages, frame_to_root, frame_relative, best_transform, mask_sparse, mask_regions, mask_outer, mask_dilate, mesh_ranges, texture_area, mesh_corners,
    surface_heights, plane_split, mesh_islands,
]
QUERIES = {q.__name__: q for q in _NAMES}


def _letters(value: str, *bases: int) -> str:
    """SQL for the symbols of a number, most significant first."""
    out, below = [], 1
    for base in reversed(bases):
        out.insert(0, f"chr(CAST({value} // {below} % {base} + {48 if base == 10 else 65} AS INTEGER))")
        below *= base
    return " || ".join(out)


_SITE = f"""CASE WHEN s <= 999 THEN {_letters('s', 10, 10, 10)} WHEN s <= 3599 THEN {_letters('(s - 1000)', 26, 10, 10)} WHEN s <= 10359 THEN {_letters('(s - 3600)', 26, 26, 10)}
    WHEN s <= 27935 THEN {_letters('(s - 10360)', 26, 26, 26)} ELSE {_letters('(s - 27936)', 10, 26, 26)} END"""
_DRIVE = f"CASE WHEN d <= 9999 THEN {_letters('d', 10, 10, 10, 10)} WHEN d <= 35999 THEN {_letters('(d - 10000)', 26, 10, 10, 10)} ELSE {_letters('(d - 36000)', 26, 26, 10, 10)} END"


def _signed(value: str) -> str:
    return f"((CAST({value} AS HUGEINT) + 2147483648) % 4294967296 + 4294967296) % 4294967296 - 2147483648"


_P = "p AS (SELECT vec_id, label, {} FROM embeddings)".format(", ".join(f"CAST(embedding[{i}] AS DOUBLE) AS e{i}" for i in range(1, 7)))
_MASK = """i AS (SELECT CAST(extract(day FROM ts) AS INTEGER) - 1 AS row, CAST(extract(hour FROM ts) AS INTEGER) AS col, avg(value) AS val FROM events GROUP BY 1, 2),
    m AS (SELECT row, col, val > (SELECT avg(val) FROM i) AS valid FROM i)"""
_REGIONS = """RECURSIVE {mask}, v AS (SELECT row, col, row * 100 + col AS id FROM m WHERE {which}), r(id, root) AS (SELECT id, id FROM v UNION
    SELECT b.id, r.root FROM r JOIN v a ON a.id = r.id JOIN v b ON abs(a.row - b.row) + abs(a.col - b.col) = 1), k AS (SELECT id, min(root) AS region FROM r GROUP BY 1)"""
_PAIRS = "q AS (SELECT label, e1 AS mx, e2 AS my, e1 * 0.8 - e2 * 0.6 + 3 + e3 * 0.1 AS fx, e1 * 0.6 + e2 * 0.8 - 1 + e4 * 0.1 AS fy FROM p)"
_SUMS = f"""{_P}, {_PAIRS}, a AS (SELECT label, avg(mx) AS ax, avg(my) AS ay, avg(fx) AS bx, avg(fy) AS by_ FROM q GROUP BY 1),
    s AS (SELECT label, count(*) AS n, avg(fx) - avg(mx) AS tx, avg(fy) - avg(my) AS ty, sum((mx - ax) * (fx - bx) + (my - ay) * (fy - by_)) AS c, sum((mx - ax) * (fy - by_) - (my - ay) * (fx - bx)) AS s,
    sum(pow(mx - ax, 2) + pow(my - ay, 2) + pow(fx - bx, 2) + pow(fy - by_, 2)) AS w FROM q JOIN a USING (label) GROUP BY label)"""
_CHAIN = """f AS (SELECT 'r' || r_regionkey AS frame, 'r' || r_regionkey AS root, 0 AS steps, 0.0 AS t, 0.0 AS x, 0.0 AS y FROM region
    UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey, 1, n_nationkey, n_nationkey % 7, n_nationkey % 5 FROM nation
    UNION ALL SELECT 'c' || c_custkey, 'r' || n_regionkey, 2, c_custkey + n_nationkey, (c_custkey % 7) * cos(n_nationkey) - (c_custkey % 5) * sin(n_nationkey) + n_nationkey % 7,
    (c_custkey % 7) * sin(n_nationkey) + (c_custkey % 5) * cos(n_nationkey) + n_nationkey % 5 FROM customer JOIN nation ON c_nationkey = n_nationkey)"""
_T = """t AS (SELECT vec_id AS vid, CAST(embedding[1] AS DOUBLE) AS x, CAST(embedding[2] AS DOUBLE) AS y, CAST(embedding[3] AS DOUBLE) AS z, CAST(embedding[4] AS DOUBLE) AS u, CAST(embedding[5] AS DOUBLE) AS v FROM embeddings),
    f AS (SELECT a.vid AS fid, a.x AS ax, a.y AS ay, a.z AS az, b.x AS bx, b.y AS by_, b.z AS bz, c.x AS cx, c.y AS cy, c.z AS cz, a.u AS au, a.v AS av, b.u AS bu, b.v AS bv, c.u AS cu, c.v AS cv
    FROM t a JOIN t b ON b.vid = a.vid + 1 JOIN t c ON c.vid = a.vid + 2 WHERE a.vid % 3 = 0)"""

ORACLES = {
    "site_drive_codes": f"WITH n AS (SELECT p_partkey, p_partkey * 37 % 32768 AS s, p_partkey * 91 % 65536 AS d FROM part) SELECT p_partkey, ({_SITE}) || ({_DRIVE}) AS code, CASE WHEN s = 26529 THEN -1 ELSE s END AS site, d AS drive FROM n",
    "version_chain": "SELECT p_partkey, repeat('X', 35) || unnest(range(p_partkey % 6 + 1, -1, -1)) AS id FROM part",
    "camera_kinds": """SELECT p_partkey, p_size % 6 AS rank, CASE p_size % 4 WHEN 0 THEN p_partkey % 5 IN (0, 1, 4) WHEN 1 THEN p_partkey % 5 = 0 WHEN 2 THEN p_partkey % 5 = 2 ELSE p_partkey % 5 = 3 END AS of_kind FROM part""",
    "readable_numbers": """WITH n AS (SELECT o_orderkey, o_orderkey * 977 AS ms, fmod(CAST(o_totalprice AS DOUBLE) * o_orderkey, 3e7) + 0.003 AS b FROM orders), s AS (SELECT *, ms // 1000 AS s FROM n)
        SELECT o_orderkey, CASE WHEN ms < 1000 THEN ms || 'ms' WHEN ms < 60000 THEN printf('%.3fs', ms / 1000) WHEN ms < 3600000 THEN (s // 60) || 'm' || (s % 60) || 's'
        ELSE (s // 3600) || 'h' || (s // 60 % 60) || 'm' || (s % 60) || 's' END AS duration,
        CASE WHEN b < 1e3 THEN printf('%.0f', b) WHEN b < 1e6 THEN printf('%.1fk', b / 1e3) WHEN b < 1e9 THEN printf('%.1fM', b / 1e6) ELSE printf('%.1fG', b / 1e9) END AS size FROM s""",
    "url_canonical": r"""WITH u AS (SELECT page_id, regexp_replace(upper(url) || '/x', '/+$', '') AS u FROM pages)
        SELECT page_id, lower(regexp_extract(u, '^(.*?://[^/]*)', 1)) || substr(u, length(regexp_extract(u, '^(.*?://[^/]*)', 1)) + 1) AS url, 'ftp://' || regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS ftp FROM u""",
    "glob_match": r"""SELECT page_id, regexp_matches(url, '^http.*/.*1.*$', 's') AS "any", regexp_matches(url, '^http[^/\\]*//[^/\\]*/[^/\\]*1[^/\\]$', 's') AS part, regexp_matches(url, '(page|post).', 's') AS either FROM pages""",
    "hash_fold": f"""WITH h AS (SELECT l_orderkey, l_linenumber, {_signed('(l_orderkey + 527) * 31 + l_partkey')} AS h FROM lineitem)
        SELECT l_orderkey, l_linenumber, CAST({_signed('(h + 527) * 31 + l_linenumber')} AS INTEGER) AS hash FROM h""",
    "truncated_histogram": """SELECT event_type, CAST(trunc((CAST(value AS DOUBLE) - 50) / 7) AS BIGINT) AS bucket, count(*) AS n, CAST(trunc((CAST(value AS DOUBLE) - 50) / 7) AS BIGINT) * 7.0 AS low,
        (CAST(trunc((CAST(value AS DOUBLE) - 50) / 7) AS BIGINT) + 1) * 7.0 AS high FROM events GROUP BY ALL""",
    "name_prefix": """WITH e AS (SELECT p_size, min(p_name) AS lo, max(p_name) AS hi FROM part GROUP BY 1)
        SELECT p_size, lo[1:list_max(list_filter(range(0, least(length(lo), length(hi)) + 1), lambda n: lo[1:n] = hi[1:n]))] AS prefix FROM e""",
    "sol_times": "SELECT p_partkey, epoch_ms(TIMESTAMP '2012-08-05 13:50:00') + p_partkey * 88775244 AS ms FROM part",
    "box_splits": f"""WITH {_P}, b AS (SELECT vec_id, e2 AS ly, e3 AS lz, abs(e4) + 0.01 AS x, abs(e5) + 0.01 AS y, abs(e6) + 0.01 AS z FROM p),
        c AS (SELECT *, 'half' AS cut, unnest([0, 1]) AS part FROM b UNION ALL SELECT *, 'quarter', unnest([0, 1, 2, 3]) FROM b)
        SELECT vec_id, cut, part, CASE WHEN x >= y AND x >= z THEN 'x' WHEN y >= z THEN 'y' ELSE 'z' END AS longest, CASE WHEN x <= y AND x <= z THEN 'x' WHEN y <= z THEN 'y' ELSE 'z' END AS shortest,
        round(CASE WHEN cut = 'half' THEN ly + part * y * 0.25 ELSE ly + part // 2 * y / 2 END, 6) AS lo_y, round(CASE WHEN cut = 'half' THEN lz ELSE lz + part % 2 * z / 2 END, 6) AS lo_z,
        round(CASE WHEN cut = 'half' THEN ly + (CASE part WHEN 0 THEN 0.25 ELSE 1 END) * y ELSE ly + (part // 2 + 1) * y / 2 END, 6) AS hi_y, round(CASE WHEN cut = 'half' THEN lz + z ELSE lz + (part % 2 + 1) * z / 2 END, 6) AS hi_z FROM c""",
    "rms_by_type": "SELECT event_type, round(sqrt(avg(CAST(value AS DOUBLE) * CAST(value AS DOUBLE))), 6) AS rms FROM events GROUP BY 1",
    "covariance": f"WITH {_P} SELECT label, count(*) AS n, round(avg(e1), 6) AS m1, round(avg(e2), 6) AS m2, round(var_samp(e1), 6) AS xx, round(covar_samp(e1, e2), 6) AS xy, round(var_samp(e2), 6) AS yy FROM p GROUP BY 1",
    "plane_fit": f"""WITH {_P}, q AS (SELECT label, e1 AS x, e2 AS y, e3 * 0.1 + e1 * 0.5 AS z FROM p), s AS (SELECT label, count(*) AS n, avg(x) AS cx, avg(y) AS cy, avg(z) AS cz, var_pop(x) AS xx, covar_pop(x, y) AS xy, covar_pop(x, z) AS xz, var_pop(y) AS yy, covar_pop(y, z) AS yz, var_pop(z) AS zz FROM q GROUP BY 1),
        d AS (SELECT *, yy * zz - yz * yz AS dx, xx * zz - xz * xz AS dy, xx * yy - xy * xy AS dz, xz * yz - xy * zz AS a, xy * yz - xz * yy AS b, xy * xz - yz * xx AS c FROM s),
        v AS (SELECT *, CASE greatest(dx, dy, dz) WHEN dx THEN [dx, a, b] WHEN dy THEN [a, dy, c] ELSE [b, c, dz] END AS v FROM d), u AS (SELECT *, sqrt(v[1] * v[1] + v[2] * v[2] + v[3] * v[3]) AS l FROM v)
        SELECT label, n, round(cx, 5) AS cx, round(cy, 5) AS cy, round(cz, 5) AS cz, round(v[1] / l, 5) AS nx, round(v[2] / l, 5) AS ny, round(v[3] / l, 5) AS nz FROM u""",
    "rigid_fit": f"WITH {_SUMS} SELECT label, n, round(tx, 5) AS tx, round(ty, 5) AS ty, round(atan2(s, c), 5) AS angle, round(sqrt(greatest(w - 2 * sqrt(s * s + c * c), 0) / n), 5) AS residual FROM s",
    "similarity_fit": f"WITH {_SUMS} SELECT label, n, round(atan2(s, c), 5) AS angle, round(sqrt(greatest(w - 2 * sqrt(s * s + c * c), 0) / n), 5) AS residual FROM s",
    "file_ages": """WITH l AS (SELECT o_custkey AS path, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS size, max(o_orderdate) AS seen FROM orders GROUP BY 1)
        SELECT path, size, seen, row_number() OVER w AS rank, CAST(sum(size) OVER w AS BIGINT) AS upto, CAST(sum(size) OVER () AS BIGINT) AS total FROM l WINDOW w AS (ORDER BY seen, path ROWS UNBOUNDED PRECEDING)""",
    "frame_to_root": f"WITH {_CHAIN} SELECT frame, root, steps, round(cos(t), 6) AS m0, round(x, 6) AS tx, round(y, 6) AS ty FROM f",
    "frame_relative": f"""WITH {_CHAIN}, b AS (SELECT 'r' || n_regionkey AS root, 'n' || min(n_nationkey) AS b FROM nation GROUP BY 1)
        SELECT f.frame AS a, b.b, round(cos(f.t - g.t), 6) AS m0, round((f.x - g.x) * cos(g.t) + (f.y - g.y) * sin(g.t), 5) AS tx, round((f.y - g.y) * cos(g.t) - (f.x - g.x) * sin(g.t), 5) AS ty
        FROM f JOIN b USING (root) JOIN f g ON g.frame = b.b WHERE f.frame LIKE 'c%'""",
    "best_transform": """WITH s AS (SELECT l_partkey AS frame, l_returnflag AS source, CAST(max(l_quantity) AS DOUBLE) AS matrix FROM lineitem GROUP BY 1, 2)
        SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY frame ORDER BY CASE source WHEN 'R' THEN 1 WHEN 'A' THEN 2 ELSE 3 END, source) = 1""",
    "mask_sparse": f"WITH {_MASK} SELECT row, col, valid AND (count(*) FILTER (valid) OVER w) / (count(*) OVER w) >= 0.5 AS valid FROM m WINDOW w AS (PARTITION BY row // 4, col // 4)",
    "mask_regions": f"""WITH {_REGIONS.format(mask=_MASK, which='valid')}, n AS (SELECT region, count(*) AS n FROM k GROUP BY 1), g AS (SELECT region FROM n WHERE n >= 0.5 * (SELECT max(n) FROM n))
        SELECT row, col, row * 100 + col IN (SELECT id FROM k JOIN g USING (region)) AS valid FROM m""",
    "mask_outer": f"""WITH {_REGIONS.format(mask=_MASK, which='NOT valid')}, e AS (SELECT max(row) AS rr, max(col) AS cc FROM m), o AS (SELECT DISTINCT region FROM k JOIN v USING (id), e WHERE row = 0 OR col = 0 OR row = rr OR col = cc)
        SELECT row, col FROM v JOIN k USING (id) JOIN o USING (region)""",
    "mask_dilate": f"""WITH {_MASK}, h AS (SELECT row, col, max(CAST(valid AS DOUBLE)) OVER w AS g, min(CAST(valid AS DOUBLE)) OVER w AS s FROM m WINDOW w AS (PARTITION BY row ORDER BY col RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING))
        SELECT row, col, max(g) OVER w AS grown, min(s) OVER w AS shrunk FROM h WINDOW w AS (PARTITION BY col ORDER BY row RANGE BETWEEN 1 PRECEDING AND 1 FOLLOWING)""",
    "mesh_ranges": f"WITH {_T} SELECT round(min(u), 6) AS min_u, round(max(u), 6) AS max_u, round(min(v), 6) AS min_v, round(max(v), 6) AS max_v FROM t",
    "texture_area": f"WITH {_T} SELECT round(sum(abs((bu - au) * (cv - av) - (cu - au) * (bv - av))) * 100, 4) AS area FROM f",
    "mesh_corners": f"""WITH {_T}, c AS (SELECT (min(x) + max(x)) / 2 AS mx, (min(y) + max(y)) / 2 AS my FROM t), q AS (SELECT vid, CASE WHEN x >= mx THEN 1 ELSE 0 END + CASE WHEN y >= my THEN 2 ELSE 0 END AS quadrant, abs(x - mx) + abs(y - my) AS d FROM t, c)
        SELECT quadrant, vid FROM q QUALIFY row_number() OVER (PARTITION BY quadrant ORDER BY d DESC, vid) = 1""",
    "surface_heights": f"""WITH {_T}, c AS (SELECT f.*, unnest(range(CAST(ceil(least(ax, bx, cx) / 0.1 - 0.5) AS BIGINT), CAST(floor(greatest(ax, bx, cx) / 0.1 - 0.5) AS BIGINT) + 1)) AS col FROM f),
        r AS (SELECT *, unnest(range(CAST(ceil(least(ay, by_, cy) / 0.1 - 0.5) AS BIGINT), CAST(floor(greatest(ay, by_, cy) / 0.1 - 0.5) AS BIGINT) + 1)) AS row FROM c),
        s AS (SELECT *, (col + 0.5) * 0.1 AS x, (row + 0.5) * 0.1 AS y, (bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax) AS w FROM r),
        b AS (SELECT *, ((cx - bx) * (y - by_) - (cy - by_) * (x - bx)) / w AS s1, ((ax - cx) * (y - cy) - (ay - cy) * (x - cx)) / w AS s2, ((bx - ax) * (y - ay) - (by_ - ay) * (x - ax)) / w AS s3 FROM s WHERE w <> 0)
        SELECT row, col, round(-min(s1 * az + s2 * bz + s3 * cz), 5) AS height, count(*) AS n FROM b WHERE s1 >= 0 AND s2 >= 0 AND s3 >= 0 GROUP BY 1, 2""",
    "plane_split": f"""WITH {_T}, n AS (SELECT *, CAST(az > 0 AS INTEGER) + CAST(bz > 0 AS INTEGER) + CAST(cz > 0 AS INTEGER) AS up FROM f)
        SELECT fid, round(sqrt(pow((by_ - ay) * (cz - az) - (bz - az) * (cy - ay), 2) + pow((bz - az) * (cx - ax) - (bx - ax) * (cz - az), 2) + pow((bx - ax) * (cy - ay) - (by_ - ay) * (cx - ax), 2)) / 2, 5) AS area,
        CASE up WHEN 3 THEN 1 ELSE up END AS above, CASE WHEN up IN (0, 3) THEN 1 ELSE 3 END AS parts FROM n""",
    "mesh_islands": f"""WITH {_T}, p AS (SELECT *, vid - vid % 3 AS island FROM t)
        SELECT vid, island, round(sqrt(pow(max(x) OVER w - min(x) OVER w, 2) + pow(max(y) OVER w - min(y) OVER w, 2) + pow(max(z) OVER w - min(z) OVER w, 2)), 5) AS size FROM p WINDOW w AS (PARTITION BY island)""",
}
