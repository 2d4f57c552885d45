from pyspark.sql import functions as F

from orogen.functions import ids, text


def test_strings(spark):
    df = spark.createDataFrame([("http://h//a\\b/c.TXT/", 7)], "s string, n int")
    s, n = F.col("s"), F.col("n")
    lit = F.lit
    row = df.select(
        text.normalize_slashes(s), text.strip_protocol(s), text.ensure_protocol(lit("h/x"), "http"), text.parent_path(lit("a/b/c")), text.change_extension(lit("a/b.c"), "png"),
        text.strip_non_printable(lit("a\x01b")), text.strip_suffix(lit("abc.x"), ".x"), text.parse_list(lit(" a, ,b ,")), text.parse_percent(lit("25%"), lit(200.0)), text.parse_percent(lit("30"), lit(200.0)),
        text.parse_bool(lit(" TRUE ")), text.collapse_whitespace(lit(" a \n b ")), text.uppercase_first(lit("abc")), text.abbreviate(lit("abcdefgh"), 6), text.snake_case(lit("aB-c.d Ef")),
        text.int_wildcards(lit("f###.x"), n), text.extension(lit("a.b/c")), text.last_part(lit("a/b")), text.parse_percent(lit("x"), lit(1.0)),
    ).first()
    assert tuple(row) == ("http://h//a/b/c.TXT", "h//a\\b/c.TXT/", "http://h/x", "a/b", "a/b.png", "ab", "abc", ["a", "b"], 50.0, 30.0, True, "a b", "Abc", "abc...", "a_B_c_d_Ef", "f007.x", "", "b", None)


def test_product_ids(spark):
    one = spark.range(1)
    short, long_ = "NLB_436643735RASLF0220000NCAM00323M_", "NLF_0001_0667035412_613ECM_N0030828NCAM00000_01_295J01"
    p = one.select(ids.parse_id(F.lit(short), "short").alias("p"), ids.latest_version(F.lit(short), "short").alias("v"), ids.parse_id(F.lit(long_), "long").alias("q"), ids.parse_id(F.lit("x"), "long").alias("r")).first()
    assert (p["p"]["instrument"], p["p"]["product"], p["p"]["geometry"], p["p"]["site"], p["p"]["producer"], p["v"]) == ("NL", "RAS", "L", "022", "M", 36)
    assert (p["q"]["sol"], p["q"]["product"], p["q"]["site"], p["q"]["drive"], p["q"]["version"], p["r"]) == ("0001", "ECM", "003", "0828", "01", None)
    keys = one.select(ids.partial_id(F.lit(short), "short", ["version", "product"]), ids.other_eye(F.lit("NL")), ids.pair_key(F.lit("b"), F.lit("a"))).first()
    assert tuple(keys) == (short[:13] + short[16:35], "NR", "a|b")


def test_site_and_drive_codes(spark):
    sites = {"000": 0, "999": 999, "A00": 1000, "Z99": 3599, "AA0": 3600, "ZZ9": 10359, "AAA": 10360, "ZZZ": 27935, "0AA": 27936, "9LJ": 34315, "9ZZ": 34695, "___": 32768, "__A": -1}
    drives = {"0000": 0, "9999": 9999, "A000": 10000, "Z999": 35999, "AA00": 36000, "LJ35": 65535, "ZZ99": 103599, "____": 65536, "x": -1}
    for codes, read, spell, top in ((sites, ids.site_number, ids.site_code, 32767), (drives, ids.drive_number, ids.drive_code, 65535)):
        df = spark.createDataFrame(list(codes.items()), "c string, n int").select("c", "n", read(F.col("c")).alias("got"), spell(F.col("n")).alias("back"))
        for r in df.collect():
            assert r["got"] == r["n"]
            assert r["back"] == (r["c"] if 0 <= r["n"] <= top else "_" * len(r["back"]))


def test_units(spark):
    row = spark.range(1).select(
        ids.angle_radians(F.lit("180.0 <deg>")), ids.strip_units(F.lit("5 <m>")), ids.number_list(F.lit("(1, 2.5,x)")), ids.duration_text(F.lit(3723004)), ids.combine_hashes(F.lit(1), F.lit(2))
    ).first()
    assert abs(row[0] - 3.141592653589793) < 1e-12 and row[1] == "5" and row[2] == [1.0, 2.5, None] and row[3] == "1h2m3s" and row[4] == (17 * 31 + 1) * 31 + 2
