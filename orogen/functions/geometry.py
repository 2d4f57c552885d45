"""Vectors, boxes, triangles, quaternions and camera models as Columns.

A vector is a struct<x, y, z> of doubles; a box a struct<lo, hi> of vectors; a quaternion a
struct<x, y, z, w>. Everything stays in JVM code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _struct(**parts: Column) -> Column:
    """A struct that remembers its parts, so that a chain of functions does not nest whole structs."""
    out = F.struct(*[p.alias(n) for n, p in parts.items()])
    out.__dict__["parts"] = parts
    return out


def part(a: Column, name: str) -> Column:
    """A field of a struct, without the struct where the parts are known."""
    known = a.__dict__.get("parts", {})
    return known[name] if name in known else a[name]


def vec(x: Column | float, y: Column | float, z: Column | float) -> Column:
    return _struct(**{n: (v if isinstance(v, Column) else F.lit(float(v))).cast("double") for n, v in (("x", x), ("y", y), ("z", z))})


def dot(a: Column, b: Column) -> Column:
    return part(a, "x") * part(b, "x") + part(a, "y") * part(b, "y") + part(a, "z") * part(b, "z")


def cross(a: Column, b: Column) -> Column:
    return vec(part(a, "y") * part(b, "z") - part(a, "z") * part(b, "y"), part(a, "z") * part(b, "x") - part(a, "x") * part(b, "z"), part(a, "x") * part(b, "y") - part(a, "y") * part(b, "x"))


def add(a: Column, b: Column) -> Column:
    return vec(part(a, "x") + part(b, "x"), part(a, "y") + part(b, "y"), part(a, "z") + part(b, "z"))


def sub(a: Column, b: Column) -> Column:
    return vec(part(a, "x") - part(b, "x"), part(a, "y") - part(b, "y"), part(a, "z") - part(b, "z"))


def scale(a: Column, k: Column | float) -> Column:
    return vec(part(a, "x") * k, part(a, "y") * k, part(a, "z") * k)


def length(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def distance(a: Column, b: Column) -> Column:
    return length(sub(a, b))


def normalize(a: Column) -> Column:
    """Unit vector; null for the zero vector."""
    n = length(a)
    return F.when(n > 0, scale(a, 1 / F.nullif(n, F.lit(0.0))))


def clamp(v: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), v))


def lerp(a: Column, b: Column, t: Column | float) -> Column:
    return a + (b - a) * t


def floor_power_of_2(v: Column) -> Column:
    """The greatest power of two not above an integer; null below 1."""
    return F.when(v >= 1, F.pow(F.lit(2.0), F.length(F.bin(v.cast("long"))) - 1).cast("long"))


def ceil_power_of_2(v: Column) -> Column:
    low = floor_power_of_2(v)
    return F.when(low == v, low).otherwise(low * 2)


def normalize_angle(radians: Column) -> Column:
    """The equal angle in [-pi, pi)."""
    return F.pmod(radians + F.pi(), 2 * F.pi()) - F.pi()


def box(lo: Column, hi: Column) -> Column:
    return _struct(lo=lo, hi=hi)


def _all(test, *cols: Column) -> Column:
    out = F.lit(True)
    for axis in "xyz":
        out = out & test(*[part(c, axis) for c in cols])
    return out


def box_contains(b: Column, p: Column) -> Column:
    return _all(lambda lo, hi, v: (v >= lo) & (v <= hi), part(b, "lo"), part(b, "hi"), p)


def box_intersects(a: Column, b: Column) -> Column:
    return _all(lambda alo, ahi, blo, bhi: (alo <= bhi) & (blo <= ahi), part(a, "lo"), part(a, "hi"), part(b, "lo"), part(b, "hi"))


def box_distance_squared(b: Column, p: Column) -> Column:
    """Squared distance from a point to the nearest point of a box."""
    out = F.lit(0.0)
    for axis in "xyz":
        gap = F.greatest(part(part(b, "lo"), axis) - part(p, axis), part(p, axis) - part(part(b, "hi"), axis), F.lit(0.0))
        out = out + gap * gap
    return out


def box_octants(b: Column) -> Column:
    """The eight boxes about the centre, x fastest."""
    low, high = part(b, "lo"), part(b, "hi")
    mid = scale(add(low, high), 0.5)
    parts = []
    for k in range(8):
        lo = vec(*[part(mid, a) if k >> i & 1 else part(low, a) for i, a in enumerate("xyz")])
        hi = vec(*[part(high, a) if k >> i & 1 else part(mid, a) for i, a in enumerate("xyz")])
        parts.append(box(lo, hi))
    return F.array(*parts)


def box_halves(b: Column, axis: str, at: float = 0.5) -> Column:
    """The two boxes on either side of the plane that cuts ``axis`` at the share ``at``, the lower first."""
    low, high = part(b, "lo"), part(b, "hi")
    cut = lerp(part(low, axis), part(high, axis), at)
    moved = lambda v: vec(*[cut if a == axis else part(v, a) for a in "xyz"])
    return F.array(box(low, moved(high)), box(moved(low), high))


def box_quarters(b: Column, axis: str, at: Column | None = None) -> Column:
    """The four boxes about ``at`` (the centre) in the plane across ``axis``, the other axes' first varying slower for x, faster else."""
    low, high = part(b, "lo"), part(b, "hi")
    mid = scale(add(low, high), 0.5) if at is None else at
    one, two = [a for a in "xyz" if a != axis]
    if axis == "x":
        one, two = two, one  # z varies faster than y
    out = []
    for k in range(4):
        upper = {one: k & 1, two: k >> 1}
        out.append(box(vec(*[part(mid, a) if upper.get(a) else part(low, a) for a in "xyz"]), vec(*[part(mid, a) if a in upper and not upper[a] else part(high, a) for a in "xyz"])))
    return F.array(*out)


def _extents(b: Column) -> Column:
    return sub(part(b, "hi"), part(b, "lo"))


def box_longest_axis(b: Column) -> Column:
    """x, y or z: the axis of greatest extent, the first on ties."""
    d = _extents(b)
    x, y, z = (part(d, a) for a in "xyz")
    return F.when((x >= y) & (x >= z), "x").when(y >= z, "y").otherwise("z")


def box_shortest_axis(b: Column) -> Column:
    d = _extents(b)
    x, y, z = (part(d, a) for a in "xyz")
    return F.when((x <= y) & (x <= z), "x").when(y <= z, "y").otherwise("z")


def box_union(a: Column, b: Column) -> Column:
    lo = vec(*[F.least(part(part(a, "lo"), c), part(part(b, "lo"), c)) for c in "xyz"])
    return box(lo, vec(*[F.greatest(part(part(a, "hi"), c), part(part(b, "hi"), c)) for c in "xyz"]))


def box_contains_nearly(b: Column, p: Column, slack: float = 1e-6) -> Column:
    """Whether a point lies in a box or at most ``slack`` beyond a side."""
    return _all(lambda lo, hi, v: (v >= lo - slack) & (v <= hi + slack), part(b, "lo"), part(b, "hi"), p)


def box_holds_nearly(outer: Column, inner: Column, slack: float = 1e-6) -> Column:
    return _all(lambda lo, hi, a, z: (a >= lo - slack) & (z <= hi + slack), part(outer, "lo"), part(outer, "hi"), part(inner, "lo"), part(inner, "hi"))


def is_finite(v: Column) -> Column:
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def curvature(p1: Column, p2: Column, n1: Column, n2: Column) -> Column:
    """Change of the normal along the way from one point to the other, per unit of way; null for equal points."""
    d = sub(p2, p1)
    return dot(sub(n2, n1), d) / F.nullif(dot(d, d), F.lit(0.0))


def yaw_pitch_roll(q: Column) -> Column:
    """struct<yaw, pitch, roll> in radians of a unit quaternion: turns about y, x and z; pitch at most a quarter turn."""
    x, y, z, w = (part(q, c) for c in "xyzw")
    lift = 2 * (w * x - y * z)
    pitch = F.when(F.abs(lift) >= 1, F.signum(lift) * F.pi() / 2).otherwise(F.asin(lift))
    return F.struct(F.atan2(2 * (w * y + x * z), 1 - 2 * (x * x + y * y)).alias("yaw"), pitch.alias("pitch"), F.atan2(2 * (w * z + x * y), 1 - 2 * (x * x + z * z)).alias("roll"))


def closest_on_segment(p: Column, a: Column, b: Column) -> Column:
    along = sub(b, a)
    t = F.coalesce(dot(sub(p, a), along) / F.nullif(dot(along, along), F.lit(0.0)), F.lit(0.0))
    return add(a, scale(along, F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))))


def closest_on_triangle(p: Column, a: Column, b: Column, c: Column) -> Column:
    """The point of a triangle nearest to ``p``: its foot on the plane if that lies inside, else the nearest of the sides' points."""
    n = cross(sub(b, a), sub(c, a))
    size = F.nullif(dot(n, n), F.lit(0.0))
    foot = sub(p, scale(n, dot(sub(p, a), n) / size))
    inside = F.lit(True)
    for s, t in ((a, b), (b, c), (c, a)):
        inside = inside & (dot(cross(sub(t, s), sub(foot, s)), n) >= 0)
    sides = [closest_on_segment(p, s, t) for s, t in ((a, b), (b, c), (c, a))]
    ranked = [F.struct(dot(sub(p, q), sub(p, q)).alias("d"), F.lit(i).alias("i"), F.struct(*[part(q, x).alias(x) for x in "xyz"]).alias("q")) for i, q in enumerate(sides)]
    return F.when(F.coalesce(inside, F.lit(False)), F.struct(*[part(foot, x).alias(x) for x in "xyz"])).otherwise(F.array_min(F.array(*ranked))["q"])


def triangle_area(a: Column, b: Column, c: Column) -> Column:
    return length(cross(sub(b, a), sub(c, a))) / 2


def triangle_normal(a: Column, b: Column, c: Column) -> Column:
    """Unit normal by the right-hand rule; null for a degenerate triangle."""
    return normalize(cross(sub(b, a), sub(c, a)))


def barycentric(a: Column, b: Column, c: Column, p: Column) -> Column:
    """struct<u, v, w> with p = u a + v b + w c in the triangle's plane; null if degenerate."""
    e0, e1, e2 = sub(b, a), sub(c, a), sub(p, a)
    d00, d01, d11, d20, d21 = dot(e0, e0), dot(e0, e1), dot(e1, e1), dot(e2, e0), dot(e2, e1)
    den = F.nullif(d00 * d11 - d01 * d01, F.lit(0.0))
    v, w = (d11 * d20 - d01 * d21) / den, (d00 * d21 - d01 * d20) / den
    return F.when(den.isNotNull(), F.struct((1 - v - w).alias("u"), v.alias("v"), w.alias("w")))


def ray_triangle(origin: Column, direction: Column, a: Column, b: Column, c: Column) -> Column:
    """Distance along a ray at which it meets a triangle (in units of ``direction``); null if it misses."""
    e1, e2 = sub(b, a), sub(c, a)
    p = cross(direction, e2)
    det = dot(e1, p)
    inv = 1 / F.when(F.abs(det) > 1e-12, det)
    t0 = sub(origin, a)
    u, q = dot(t0, p) * inv, cross(t0, e1)
    v, t = dot(direction, q) * inv, dot(e2, q) * inv
    return F.when((u >= 0) & (v >= 0) & (u + v <= 1) & (t >= 0), t)


def rotate(q: Column, v: Column) -> Column:
    """``v`` turned by a unit quaternion."""
    u = vec(part(q, "x"), part(q, "y"), part(q, "z"))
    t = scale(cross(u, v), 2.0)
    return add(add(v, scale(t, part(q, "w"))), cross(u, t))


def quaternion_product(a: Column, b: Column) -> Column:
    """The rotation ``b`` followed by ``a``."""
    ax, ay, az, aw, bx, by, bz, bw = (part(q, c) for q in (a, b) for c in "xyzw")
    return F.struct(
        (aw * bx + ax * bw + ay * bz - az * by).alias("x"), (aw * by - ax * bz + ay * bw + az * bx).alias("y"),
        (aw * bz + ax * by - ay * bx + az * bw).alias("z"), (aw * bw - ax * bx - ay * by - az * bz).alias("w"),
    )


def slerp(a: Column, b: Column, t: Column | float) -> Column:
    """Spherical interpolation along the shorter arc; linear for nearly equal rotations."""
    d = sum((part(a, c) * part(b, c) for c in "yzw"), part(a, "x") * part(b, "x"))
    sign, d = F.when(d < 0, -1.0).otherwise(1.0), F.least(F.abs(d), F.lit(1.0))
    theta = F.acos(d)
    s = F.when(d < 0.9995, F.sin(theta))
    t = t if isinstance(t, Column) else F.lit(t)
    wa, wb = F.coalesce(F.sin((1 - t) * theta) / s, 1 - t), F.coalesce(F.sin(t * theta) / s, t) * sign
    raw = {c: wa * part(a, c) + wb * part(b, c) for c in "xyzw"}
    n = F.sqrt(sum((raw[c] * raw[c] for c in "yzw"), raw["x"] * raw["x"]))
    return F.struct(*[(raw[c] / n).alias(c) for c in "xyzw"])


def cahv_project(p: Column, c: Column, a: Column, h: Column, v: Column) -> Column:
    """struct<col, row, depth>: pixel of a point in a linear camera; null behind the camera."""
    ray = sub(p, c)
    depth = dot(ray, a)
    ok = F.when(depth > 0, depth)
    return F.when(ok.isNotNull(), F.struct((dot(ray, h) / ok).alias("col"), (dot(ray, v) / ok).alias("row"), depth.alias("depth")))


def cahv_ray(col: Column, row: Column, a: Column, h: Column, v: Column) -> Column:
    """Unit direction of a pixel's ray: the common normal of the planes h - col a and v - row a, on the side of a."""
    direction = cross(sub(v, scale(a, row)), sub(h, scale(a, col)))
    unit = normalize(direction)
    return scale(unit, F.when(dot(unit, a) < 0, -1.0).otherwise(1.0))


def easting_northing(lon: Column, lat: Column, radius: float, lon0: float = 0.0, lat1: float = 0.0) -> Column:
    """struct<easting, northing> of an equirectangular projection, degrees to metres."""
    return F.struct(
        (F.radians(lon - lon0) * radius * F.cos(F.radians(F.lit(lat1)))).alias("easting"), (F.radians(lat) * radius).alias("northing")
    )


def rgb_to_hsv(r: Column, g: Column, b: Column) -> Column:
    """struct<h (degrees), s, v> of channels in 0 to 1."""
    top, low = F.greatest(r, g, b), F.least(r, g, b)
    span = F.nullif(top - low, F.lit(0.0))
    hue = F.when(top == r, F.pmod((g - b) / span, F.lit(6.0))).when(top == g, (b - r) / span + 2).otherwise((r - g) / span + 4) * 60
    return F.struct(F.coalesce(hue, F.lit(0.0)).alias("h"), F.coalesce(span / F.nullif(top, F.lit(0.0)), F.lit(0.0)).alias("s"), top.alias("v"))


def srgb_to_linear(v: Column) -> Column:
    return F.when(v <= 0.04045, v / 12.92).otherwise(F.pow((v + 0.055) / 1.055, F.lit(2.4)))


def linear_to_srgb(v: Column) -> Column:
    return F.when(v <= 0.0031308, v * 12.92).otherwise(1.055 * F.pow(v, F.lit(1 / 2.4)) - 0.055)


def luminance(r: Column, g: Column, b: Column) -> Column:
    """Rec. 709 luminance of linear channels."""
    return 0.2126 * r + 0.7152 * g + 0.0722 * b


def rgb_to_lab(r: Column, g: Column, b: Column) -> Column:
    """struct<l, a, b> (CIE, D65) of sRGB channels in 0 to 1."""
    lin = [srgb_to_linear(c) for c in (r, g, b)]
    # fixed values: sRGB primaries to XYZ, and the D65 white
    rows = ((0.4124564, 0.3575761, 0.1804375, 0.95047), (0.2126729, 0.7151522, 0.0721750, 1.0), (0.0193339, 0.1191920, 0.9503041, 1.08883))
    f = []
    for kr, kg, kb, white in rows:
        t = (lin[0] * kr + lin[1] * kg + lin[2] * kb) / white
        f.append(F.when(t > 216 / 24389, F.cbrt(t)).otherwise((t * 24389 / 27 + 16) / 116))
    return F.struct((116 * f[1] - 16).alias("l"), (500 * (f[0] - f[1])).alias("a"), (200 * (f[1] - f[2])).alias("b"))


def hsv_to_rgb(h: Column, s: Column, v: Column) -> Column:
    """struct<r, g, b> in 0 to 1 of a hue in degrees, a saturation and a value."""

    def channel(n: int) -> Column:
        k = F.pmod(F.lit(float(n)) + h / 60, F.lit(6.0))
        return v - v * s * F.greatest(F.lit(0.0), F.least(k, 4 - k, F.lit(1.0)))

    return F.struct(channel(5).alias("r"), channel(3).alias("g"), channel(1).alias("b"))


def lab_to_rgb(l: Column, a: Column, b: Column) -> Column:
    """struct<r, g, b> (sRGB, 0 to 1, clamped) of CIE values under D65."""
    fy = (l + 16) / 116
    # fixed values: the D65 white, and XYZ to sRGB primaries
    xyz = []
    for f, white in ((fy + a / 500, 0.95047), (fy, 1.0), (fy - b / 200, 1.08883)):
        cube = f * f * f
        xyz.append(F.when(cube > 216 / 24389, cube).otherwise((116 * f - 16) * 27 / 24389) * white)
    rows = ((3.2404542, -1.5371385, -0.4985314), (-0.9692660, 1.8760108, 0.0415560), (0.0556434, -0.2040259, 1.0572252))
    linear = [sum((k * v for k, v in zip(row[1:], xyz[1:], strict=True)), row[0] * xyz[0]) for row in rows]
    return F.struct(*[linear_to_srgb(clamp(v, 0.0, 1.0)).alias(n) for v, n in zip(linear, "rgb", strict=True)])
