"""String, URL and identifier functions as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def glob_to_regex(pattern: str, full: bool = True, slashes: bool = True, alternation: bool = False) -> str:
    """A regular expression for a glob: * and ? also match slashes unless ``slashes`` is off; (a|b) only with ``alternation``."""
    some = "." if slashes else r"[^/\\]"
    plain = "()|" if alternation else ""
    out = "".join(some if c == "?" else some + "*" if c == "*" else c if c.isalnum() or c in "_" + plain else "\\" + c for c in pattern)
    return f"^{out}$" if full else out


def like_glob(col: Column, pattern: str, ignore_case: bool = False, **options: bool) -> Column:
    return col.rlike(("(?is)" if ignore_case else "(?s)") + glob_to_regex(pattern, **options))


def url_scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^([A-Za-z][A-Za-z0-9+.-]*)://", 1))


def url_host(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """The path without query and fragment; '' if there is none."""
    return F.regexp_extract(url, "^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def last_part(path: Column) -> Column:
    """What follows the last slash."""
    return F.regexp_extract(path, "([^/]*)$", 1)


def extension(path: Column) -> Column:
    """The last extension of a path with its dot, lower case; ''."""
    return F.lower(F.regexp_extract(path, "([.][^./]+)$", 1))


def strip_extension(path: Column) -> Column:
    return F.regexp_replace(path, "[.][^./]+$", "")


def join_url(base: Column, part: Column) -> Column:
    """One slash between two parts."""
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(part, "^/+", ""))


def sha_prefix(col: Column, chars: int = 40) -> Column:
    """The first hex digits of the SHA-256 of a string."""
    return F.substring(F.sha2(col, 256), 1, chars)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def symbol_value(ch: Column) -> Column:
    """0-9, A-Z as 10-35, _ as 36; null for anything else."""
    code = F.ascii(ch)
    return (
        F.when((code >= 48) & (code <= 57), code - 48).when((code >= 65) & (code <= 90), code - 55).when(code == 95, F.lit(36))
    )


def version_number(text: Column) -> Column:
    """A version's value: symbols up to 36 in places worth ten each (so 'A' is 10 and '_' alone is 36)."""
    symbols = F.filter(F.split(F.upper(text), ""), lambda c: c != "")
    return F.aggregate(symbols, F.lit(0).cast("long"), lambda acc, c: acc * 10 + symbol_value(c).cast("long"))


def geocell(code: Column, bits: int) -> Column:
    """struct<west, south, east, north> of the cell of a ``geocode`` of that many bits."""
    x = y = F.lit(0).cast("long")
    for i in range(bits):
        x = x + F.shiftleft(F.shiftright(code, 2 * i + 1).bitwiseAND(F.lit(1)), i)
        y = y + F.shiftleft(F.shiftright(code, 2 * i).bitwiseAND(F.lit(1)), i)
    n = float(1 << bits)
    return F.struct((x * (360 / n) - 180).alias("west"), (y * (180 / n) - 90).alias("south"), ((x + 1) * (360 / n) - 180).alias("east"), ((y + 1) * (180 / n) - 90).alias("north"))


def containing_prefix(a: Column, b: Column, bits: int) -> Column:
    """The codes' common leading pairs of bits as a string of digits 0 to 3: the least cell that holds both."""
    def digits(code: Column) -> list[Column]:
        return [F.shiftright(code, 2 * i).bitwiseAND(F.lit(3)) for i in range(bits - 1, -1, -1)]

    out, same = F.lit(""), F.lit(True)
    for x, y in zip(digits(a), digits(b), strict=True):
        same = same & (x == y)
        out = F.concat(out, F.when(same, x.cast("string")).otherwise(""))
    return out


def overlapping_cells(west: Column, south: Column, east: Column, north: Column, bits: int) -> Column:
    """Array of the ``geocode`` cells of a level that meet a box."""
    n = 1 << bits

    def at(value: Column, low: float, size: float) -> Column:
        return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((value - low) / size * n))).cast("long")

    spread = lambda v: sum((F.shiftleft(F.shiftright(v, i).bitwiseAND(F.lit(1)), 2 * i) for i in range(1, bits)), v.bitwiseAND(F.lit(1)))
    xs, ys = F.sequence(at(west, -180.0, 360.0), at(east, -180.0, 360.0)), F.sequence(at(south, -90.0, 180.0), at(north, -90.0, 180.0))
    return F.array_sort(F.flatten(F.transform(xs, lambda x: F.transform(ys, lambda y: F.shiftleft(spread(x), 1) + spread(y)))))


def geocode(lon: Column, lat: Column, bits: int) -> Column:
    """Interleaved bits of longitude and latitude, longitude first: ``bits`` of each."""
    out = F.lit(0).cast("long")
    for i in range(bits):
        for value, low, high, place in ((lon, -180.0, 180.0, 1), (lat, -90.0, 90.0, 0)):
            cell = F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), F.floor((value - low) / (high - low) * (1 << bits))))
            out = out + F.shiftright(cell, i).bitwiseAND(F.lit(1)) * (1 << (2 * i + place))
    return out.cast("long")


def normalize_slashes(path: Column, keep_last: bool = False) -> Column:
    """Backslashes as slashes and, unless kept, no slashes at the end; runs inside stay."""
    flat = F.translate(path, "\\", "/")
    return flat if keep_last else F.regexp_replace(flat, "/+$", "")


def normalize_url(url: Column, scheme: str | None = None, keep_last: bool = False) -> Column:
    """``normalize_slashes`` with scheme and host in lower case; with ``scheme``, that scheme is ensured instead."""
    flat = normalize_slashes(url, keep_last)
    if scheme:
        return ensure_protocol(flat, scheme)
    head = F.regexp_extract(flat, "^(.*?://[^/]*)", 1)
    return F.concat(F.lower(head), F.substring(flat, F.length(head) + 1, F.length(flat)))


def parse_int(text: Column) -> Column:
    """A 32-bit integer, blanks around it allowed; null if it is none."""
    return F.when(text.rlike(r"^\s*[-+]?[0-9]+\s*$"), F.trim(text).try_cast("int"))


def parse_float(text: Column) -> Column:
    """A decimal number as float, with sign, fraction and exponent; null if it is none."""
    return F.when(text.rlike(r"^\s*[-+]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][-+]?[0-9]+)?\s*$"), F.trim(text).try_cast("float"))


def remove_spans(text: Column, spans: list[tuple[int, int]]) -> Column:
    """Without the (start from 0, length) spans, which refer to the whole text and may overlap."""
    gone = sorted({i for start, n in spans for i in range(start, start + n)})
    kept, at = [], 0
    for i in gone:
        if i > at:
            kept.append(F.substring(text, at + 1, i - at))
        at = i + 1
    return F.concat(*kept, F.substring(text, at + 1, 1 << 30))


def common_prefix(df, column: str, *keys: str):
    """Rows (keys, prefix): the longest common beginning of a group's strings, that of its least and greatest."""
    ends = df.where(F.col(column).isNotNull()).groupBy(*keys).agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    same = F.expr("filter(sequence(0, least(length(lo), length(hi))), n -> substring(lo, 1, n) = substring(hi, 1, n))")
    return ends.select(*keys, F.substring("lo", F.lit(1), F.array_max(same)).alias("prefix"))


def strip_protocol(url: Column) -> Column:
    return F.regexp_replace(url, "^[A-Za-z][A-Za-z0-9+.-]*://", "")


def ensure_protocol(url: Column, scheme: str) -> Column:
    return F.when(url.rlike("^[A-Za-z][A-Za-z0-9+.-]*://"), url).otherwise(F.concat(F.lit(f"{scheme}://"), url))


def parent_path(url: Column) -> Column:
    """Everything before the last slash; '' without one."""
    return F.regexp_extract(url, "^(.*)/[^/]*$", 1)


def change_extension(path: Column, ext: str) -> Column:
    return F.concat(strip_extension(path), F.lit(ext if ext.startswith(".") else "." + ext))


def strip_non_printable(text: Column) -> Column:
    return F.regexp_replace(text, "[\\x00-\\x1f\\x7f]", "")


def strip_suffix(text: Column, suffix: str) -> Column:
    return F.when(text.endswith(suffix), F.substring(text, 1, F.length(text) - len(suffix))).otherwise(text)


def parse_list(text: Column, separator: str = ",") -> Column:
    """Trimmed items, empty ones dropped."""
    return F.filter(F.transform(F.split(text, f"[{separator}]"), lambda x: F.trim(x)), lambda x: x != "")


def parse_percent(text: Column, total: Column) -> Column:
    """'N%' of a total, or an absolute number; null if neither."""
    number = F.regexp_extract(text, "^\\s*([0-9.]+)\\s*%?\\s*$", 1).try_cast("double")
    return F.when(F.trim(text).endswith("%"), number / 100 * total).otherwise(number)


def parse_bool(text: Column) -> Column:
    low = F.lower(F.trim(text))
    return F.when(low == "true", True).when(low == "false", False)


def collapse_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, "\\s+", " "))


def uppercase_first(text: Column) -> Column:
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, 2, 1 << 30))


def abbreviate(text: Column, most: int) -> Column:
    """At most ``most`` characters, the last three dots if it was cut."""
    return F.when(F.length(text) <= most, text).otherwise(F.concat(F.substring(text, 1, most - 3), F.lit("...")))


def snake_case(text: Column) -> Column:
    """Dashes, dots and white space as underscores, and one at each change from small to capital; case is kept."""
    return F.regexp_replace(F.regexp_replace(text, "[-.\\s]+", "_"), "([a-z0-9])([A-Z])", "$1_$2")


def int_wildcards(text: Column, number: Column) -> Column:
    """A run of # replaced by a zero-padded number."""
    run = F.regexp_extract(text, "(#+)", 1)
    return F.when(run == "", text).otherwise(F.concat(F.regexp_extract(text, "^([^#]*)", 1), F.lpad(number.cast("string"), F.length(run), F.lit("0")), F.regexp_extract(text, "^[^#]*#+(.*)$", 1)))
