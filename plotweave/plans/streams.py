"""Streaming queries: each drains what is there and returns the sink's table."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import catalog
from ..session import scratch
from ..streaming import flights as S
from .flights import _FLIGHTS, flight_files
from .registering import query
from .views import COLUMNS, read

_GOOD = "count(*) >= 60"


def _place(spark, name: str) -> str:
    return f"{scratch(spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT DISTINCT crop, flight, 'ok' AS status FROM frames", "frames")
def stream_new_flights(spark, d):
    p = _place(spark, "flights")
    src = S.stream_of(spark, d, glob="events.parquet").selectExpr(*COLUMNS["frames"][1]).select("crop", "flight")
    S.process_new(src, ["crop", "flight"], f"{p}/done", f"{p}/checkpoint", lambda b: b.withColumn("status", F.lit("ok")))
    return spark.read.parquet(f"{p}/done").select("crop", "flight", "status")


@query(f"""SELECT crop AS field, flight, last_value(CASE WHEN n >= 60 THEN off END IGNORE NULLS) OVER (PARTITION BY crop ORDER BY flight) AS off FROM
(SELECT crop, flight, count(*) AS n, round(avg(alt), 6) AS off FROM frames GROUP BY 1, 2)""", "frames")
def stream_datum(spark, d):
    p = _place(spark, "datum")
    g = read(spark, d, "events").selectExpr(*COLUMNS["frames"][1]).groupBy(F.col("crop").alias("field"), "flight").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg("alt"), 6).alias("offset"))
    g.coalesce(1).write.parquet(f"{p}/in")
    S.to_table(S.carry_forward(S.stream_of(spark, f"{p}/in"), 60), ["field", "flight"], f"{p}/out", f"{p}/checkpoint")
    return S.current(spark, f"{p}/out")


@query(f"""SELECT crop, flight, CASE WHEN reason IS NULL THEN 'ok' ELSE 'incomplete' END AS status, reason FROM (SELECT crop, flight, CASE WHEN first % 5 = 0 THEN 'no ortho inputs' WHEN first % 7 * 400 < 1024 THEN 'ortho inputs truncated'
WHEN first % 4 + 2 < 3 THEN 'model incomplete' WHEN n * 40 < 1000 THEN 'dense cloud too small' END AS reason FROM {_FLIGHTS})""")
def stream_recheck(spark, d):
    """Runs' results come in two batches, the first with every flight failed; the second replaces them by key."""
    p = _place(spark, "recheck")
    files = flight_files(spark, d).drop("status")
    files.withColumn("has_npz", F.lit(False)).coalesce(1).write.parquet(f"{p}/in/first")
    files.coalesce(1).write.parquet(f"{p}/in/second")
    for k, part in enumerate(("first", "second")):
        S.recheck(S.stream_of(spark, f"{p}/in/{part}"), ["crop", "flight"], f"{p}/status-{k}", f"{p}/checkpoint-{k}", catalog.completeness)
    both = S.current(spark, f"{p}/status-1")
    S.replace_by_key(both, ["crop", "flight"], f"{p}/status-0", 1)
    return S.current(spark, f"{p}/status-0")


@query("SELECT event_type AS kind, time_bucket(INTERVAL 1 DAY, ts) AS start, count(*) AS n FROM events GROUP BY 1, 2")
def event_windows(spark, d):
    w = S.windowed_counts(read(spark, d, "events").withColumnRenamed("event_type", "kind"), "ts", ["kind"], "1 day")
    return w.select("kind", F.col("window.start").alias("start"), "n")


@query("""SELECT user_id, min(ts) AS start, count(*) AS n FROM (SELECT *, sum(CASE WHEN p IS NULL OR ts - p >= INTERVAL 6 HOUR THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS s FROM
(SELECT user_id, ts, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events)) GROUP BY user_id, s""")
def event_sessions(spark, d):
    return S.sessions(read(spark, d, "events"), "ts", ["user_id"], "6 hours").select("user_id", F.col("session_window.start").alias("start"), "n")
