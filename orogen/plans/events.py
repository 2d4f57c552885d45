"""Event processing."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming.events import debounce, debounce_with_flush, triage
from ..tables import read


def _sessions(gap):
    def query(spark, sf_dir):
        out = debounce(read(spark, sf_dir, "events"), ["user_id"], "ts", gap)
        return out.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.max("n").alias("longest"))

    return query


def punctuation_flush(spark, sf_dir):
    out = debounce_with_flush(read(spark, sf_dir, "events"), ["user_id"], "ts", 6 * 3600, F.col("event_type") == "purchase")
    return out.groupBy("user_id", "flushed").agg(F.count(F.lit(1)).alias("sessions"), F.max("n").alias("longest"))


def dead_letter(spark, sf_dir):
    age = F.expr("unix_seconds(timestamp'2024-02-01') - unix_seconds(cast(ts as timestamp))")
    out = triage(read(spark, sf_dir, "events"), age, F.col("event_id") % 6, 20 * 86400, 3)
    return out.groupBy("verdict").agg(F.count(F.lit(1)).alias("n"))


def tumbling(spark, sf_dir):
    window = F.window(F.col("ts").cast("timestamp"), "6 hours")
    out = read(spark, sf_dir, "events").groupBy(window.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return out.select(F.unix_seconds("w.start").alias("start_s"), "event_type", "n", "total")


def props_parse(spark, sf_dir):
    k = F.get_json_object("props", "$.k").cast("long")
    return read(spark, sf_dir, "events").groupBy((k % 10).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), F.max(k).alias("most"))


QUERIES = {"debounce": _sessions("30 minutes"), "debounce_wide": _sessions("6 hours"), "punctuation_flush": punctuation_flush, "dead_letter": dead_letter, "tumbling": tumbling, "props_parse": props_parse}


def _session_sql(seconds, flush="false"):
    return f"""SELECT user_id, min(ts) AS first, count(*) AS n, bool_or({flush}) AS flushed FROM (
        SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM (SELECT *, CASE WHEN coalesce(epoch_us(ts) - epoch_us(lag(ts) OVER w) >= {seconds}000000, true)
            OR coalesce(lag({flush}) OVER w, false) THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts))) GROUP BY user_id, s"""


ORACLES = {
    "debounce": f"SELECT user_id, count(*) AS sessions, max(n) AS longest FROM ({_session_sql(1800)}) GROUP BY 1",
    "debounce_wide": f"SELECT user_id, count(*) AS sessions, max(n) AS longest FROM ({_session_sql(21600)}) GROUP BY 1",
    "punctuation_flush": f"""SELECT user_id, flushed, count(*) AS sessions, max(n) AS longest FROM ({_session_sql(21600, "(event_type = 'purchase')")}) GROUP BY 1, 2""",
    "dead_letter": """SELECT CASE WHEN epoch(TIMESTAMP '2024-02-01') - floor(epoch(ts)) > 20 * 86400 THEN 'expired' WHEN event_id % 6 > 3 THEN 'dead' ELSE 'live' END AS verdict, count(*) AS n FROM events GROUP BY 1""",
    "tumbling": "SELECT CAST(epoch(time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '1970-01-01')) AS BIGINT) AS start_s, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2",
    "props_parse": "SELECT CAST(props ->> '$.k' AS BIGINT) % 10 AS bucket, count(*) AS n, max(CAST(props ->> '$.k' AS BIGINT)) AS most FROM events GROUP BY 1",
}
