"""Fixed-width product ids, site and drive codes, hashes and units as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import version_number

# Fixed values: (field, first character, characters) of the public fixed-width id layouts.
ID_LAYOUTS = {
    "short": (36, (("instrument", 1, 2), ("config", 3, 1), ("special", 4, 1), ("sclk", 5, 9), ("product", 14, 3), ("geometry", 17, 1), ("sample", 18, 1),
        ("site", 19, 3), ("drive", 22, 4), ("sequence", 26, 9), ("producer", 35, 1), ("version", 36, 1))),
    "long": (54, (("instrument", 1, 2), ("color", 3, 1), ("special", 4, 1), ("sol", 5, 4), ("venue", 9, 1), ("sclk", 10, 10), ("millis", 21, 3), ("product", 24, 3),
        ("geometry", 27, 1), ("thumbnail", 28, 1), ("site", 29, 3), ("drive", 32, 4), ("sequence", 36, 9), ("camera", 45, 4), ("downsample", 49, 1), ("compression", 50, 2),
        ("producer", 52, 1), ("version", 53, 2))),
}

# Fixed values: (pattern, first value, last value) of site and drive codes; letters count in 26s, digits in tens.
# Underscores alone, and spellings past the last value, stand for numbers beyond the range.
SITE_CODES = (("DDD", 0, 999), ("LDD", 1000, 3599), ("LLD", 3600, 10359), ("LLL", 10360, 27935), ("DLL", 27936, 32767))
DRIVE_CODES = (("DDDD", 0, 9999), ("LDDD", 10000, 35999), ("LLDD", 36000, 65535))


def parse_id(text: Column, layout: str) -> Column:
    """struct of the fields of an id of a layout; null if its length differs."""
    size, fields = ID_LAYOUTS[layout]
    return F.when(F.length(text) == size, F.struct(*[F.substring(text, at, n).alias(name) for name, at, n in fields]))


def partial_id(text: Column, layout: str, without: list[str]) -> Column:
    """An id without some fields: the key that groups its variants."""
    _, fields = ID_LAYOUTS[layout]
    size = ID_LAYOUTS[layout][0]
    gone = {i for name, at, n in fields if name in without for i in range(at, at + n)}
    runs, at = [], 1
    while at <= size:
        stop = at
        while stop <= size and stop not in gone:
            stop += 1
        if stop > at:
            runs.append(F.substring(text, at, stop - at))
        at = stop + 1
    return F.concat(*runs) if runs else F.lit("")


def _code(text: Column, codes: tuple) -> Column:
    size = len(codes[0][0])
    out = F.when(text == "_" * size, codes[-1][2] + 1)
    for pattern, first, _ in codes:
        value = F.lit(0)
        for i, kind in enumerate(pattern):
            symbol = F.ascii(F.substring(F.upper(text), i + 1, 1)) - (48 if kind == "D" else 65)
            value = value * (10 if kind == "D" else 26) + symbol
        out = out.when(text.rlike("^" + "".join("[0-9]" if k == "D" else "[A-Za-z]" for k in pattern) + "$"), value + first)
    return out.otherwise(F.lit(-1))


def site_number(text: Column) -> Column:
    """Value of a three-character site code; -1 if malformed, 32768 for underscores; spellings past 32767 keep their value."""
    return _code(text, SITE_CODES)


def drive_number(text: Column) -> Column:
    """Value of a four-character drive code; -1 if malformed, 65536 for underscores."""
    return _code(text, DRIVE_CODES)


def site_drive(text: Column) -> Column:
    """struct<site, drive> of a site-drive id: codes of 3 + 4 characters or numbers of 5 + 5; null if malformed.

    A part of x, # or ? alone is a wildcard, -1. The struct orders by site, then drive.
    """

    def field(at: int, n: int, value) -> Column:
        own = F.substring(text, at, n)
        return F.when(own.rlike("^([xX]+|#+|[?]+)$"), F.lit(-1)).otherwise(F.nullif(value(own), F.lit(-1)))

    number = lambda own: F.when(own.rlike(r"^ *[-+]?[0-9]+ *$"), F.trim(own).try_cast("int"))
    short = F.struct(field(1, 3, site_number).alias("site"), field(4, 4, drive_number).alias("drive"))
    long_ = F.struct(field(1, 5, number).alias("site"), field(6, 5, number).alias("drive"))
    found = F.when(F.length(text) == 7, short).when(F.length(text) == 10, long_)
    return F.when(found["site"].isNotNull() & found["drive"].isNotNull(), found)


def descending_versions(text: Column, layout: str, offset: int = 0) -> Column:
    """Array of the ids of all versions from the id's own plus ``offset`` down to 0; the id alone if its version is no number."""
    at, n = next((at, n) for name, at, n in ID_LAYOUTS[layout][1] if name == "version")
    own = F.substring(text, at, n).try_cast("int") + offset
    spelt = F.transform(F.sequence(own, F.lit(0), F.lit(-1)), lambda v: F.concat(F.substring(text, 1, at - 1), F.lpad(v.cast("string"), n, "0"), F.substring(text, at + n, 1 << 20)))
    return F.when(own >= 0, spelt).when(own < 0, F.array().cast("array<string>")).otherwise(F.array(text))


# Order of preference of an image's colour; any other comes last.
BAND_ORDER = ("FullColor", "Grayscale", "Green", "Red", "Blue")

# Cameras that count as a kind of camera, besides the kind itself.
CAMERA_KINDS = {
    "Hazcam": "FrontHazcam FrontHazcamLeft FrontHazcamRight RearHazcam RearHazcamLeft RearHazcamRight FrontHazcamB FrontHazcamLeftB FrontHazcamRightB",
    "FrontHazcam": "FrontHazcamB FrontHazcamLeft FrontHazcamRight FrontHazcamLeftB FrontHazcamRightB",
    "RearHazcam": "RearHazcamLeft RearHazcamRight",
    "Mastcam": "MastcamLeft MastcamRight MastcamZ MastcamZLeft MastcamZRight",
    "Navcam": "NavcamLeft NavcamRight",
}


def band_preference(color: Column) -> Column:
    """Rank of a colour, 0 the best."""
    place = F.array_position(F.array(*map(F.lit, BAND_ORDER)), color)
    return F.when(place > 0, place - 1).otherwise(F.lit(len(BAND_ORDER))).cast("int")


def is_camera(kind: Column, camera: Column) -> Column:
    """Whether a camera is of a kind: equal, or one of the kind's cameras."""
    out = kind == camera
    for name, cameras in CAMERA_KINDS.items():
        out = out | ((kind == name) & camera.isin(cameras.split()))
    return out


def millis_since_epoch(ts: Column) -> Column:
    return F.unix_millis(ts)


def timestamp_of_millis(ms: Column) -> Column:
    return F.timestamp_millis(ms)


# Begin of sol 0 and the length of a sol second in seconds.
SOL_ZERO, SOL_SECOND = "2012-08-05 13:50:00", 1.02749125


def sol_to_utc(sol: Column) -> Column:
    """The moment at which a sol begins (local mean solar midnight), in UTC."""
    return F.timestamp_millis(F.unix_millis(F.to_timestamp(F.lit(SOL_ZERO + "+00:00"))) + F.round(sol * (86400 * SOL_SECOND * 1e3)).cast("long"))


def _spell(number: Column, codes: tuple) -> Column:
    out = None
    for pattern, first, last in codes:
        rest, symbols = number - first, []
        for kind in reversed(pattern):
            base = 10 if kind == "D" else 26
            symbols.insert(0, F.char((rest % base + (48 if kind == "D" else 65)).cast("long")))
            rest = F.floor(rest / base)
        here = number.between(first, last)
        out = F.when(here, F.concat(*symbols)) if out is None else out.when(here, F.concat(*symbols))
    return out.otherwise(F.lit("_" * len(codes[0][0])))


def site_code(number: Column) -> Column:
    """The code of a site number; underscores if out of range."""
    return _spell(number, SITE_CODES)


def drive_code(number: Column) -> Column:
    return _spell(number, DRIVE_CODES)


def latest_version(text: Column, layout: str) -> Column:
    """The version's order value, for choosing the newest of equal partial ids."""
    return version_number(parse_id(text, layout)["version"])


def other_eye(instrument: Column) -> Column:
    """Left for right and right for left in the second letter of an instrument."""
    return F.concat(F.substring(instrument, 1, 1), F.translate(F.substring(instrument, 2, 1), "LR", "RL"), F.substring(instrument, 3, 8))


def pair_key(a: Column, b: Column) -> Column:
    """One key for an unordered pair."""
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def combine_hashes(*values: Column) -> Column:
    """Fold of 32-bit values from the left, two by two: (17 * 31 + a) * 31 + b, wrapping like a signed int; 0 of none."""
    out = values[0].cast("long") if values else F.lit(0).cast("long")
    for v in values[1:]:
        out = F.pmod((out + 17 * 31) * 31 + v.cast("long"), F.lit(1 << 32))
        out = F.when(out >= 1 << 31, out - (1 << 32)).otherwise(out)
    return out.cast("int")


def angle_radians(text: Column) -> Column:
    """'90 <deg>' or '1.5 <rad>' in radians; without a unit radians; null if no number."""
    value = F.regexp_extract(text, r"^\s*([-+]?[0-9.]+(?:[eE][-+]?[0-9]+)?)", 1)
    number = F.when(value != "", value.cast("double"))
    return F.when(F.lower(text).contains("<deg"), F.radians(number)).otherwise(number)


def strip_units(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "<[^>]*>", ""))


def number_list(text: Column) -> Column:
    """'(a, b, c)' as an array of doubles; null where an item is no number."""
    items = F.split(F.regexp_replace(strip_units(text), "[()\\s]", ""), ",")
    return F.transform(F.filter(items, lambda x: x != ""), lambda x: x.try_cast("double"))


def duration_text(millis: Column) -> Column:
    """Milliseconds as '5ms', '1.500s', '2m3s' or '1h2m3s'."""
    whole = F.floor(millis / 1000)
    text = lambda v: F.floor(v).cast("long").cast("string")
    return (
        F.when(millis < 1000, F.concat(millis.cast("long").cast("string"), F.lit("ms")))
        .when(millis < 60_000, F.format_string("%.3fs", millis.cast("double") / 1000))
        .when(millis < 3_600_000, F.concat(text(whole / 60), F.lit("m"), text(whole % 60), F.lit("s")))
        .otherwise(F.concat(text(whole / 3600), F.lit("h"), text(whole / 60 % 60), F.lit("m"), text(whole % 60), F.lit("s")))
    )


def magnitude_text(value: Column, k: float = 1000.0) -> Column:
    """A number as '512', '1.5k', '2.0M' or '3.1G' in powers of ``k``."""
    size, v = F.abs(value), value.cast("double")
    return (
        F.when(size < k, F.format_string("%.0f", v)).when(size < k * k, F.format_string("%.1fk", v / k))
        .when(size < k**3, F.format_string("%.1fM", v / (k * k))).otherwise(F.format_string("%.1fG", v / k**3))
    )
