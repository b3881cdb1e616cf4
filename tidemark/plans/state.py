"""Queries over windows, state and streams."""

import uuid
from functools import partial

from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import state, window
from tidemark.operators.dedupe import shared_dir, written
from tidemark.plans import base
from tidemark.streaming import flows

QUERIES: dict = {}
SQL: dict = {}
query = partial(base.register, QUERIES, SQL)

NOW = "2024-01-29 12:00:00"  # a Monday


def at_now():
    return F.lit(NOW).cast("timestamp")

NOW_SQL = f"TIMESTAMP '{NOW}'"


def events(spark, sf_dir):
    return base.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query("freshness_window", f"SELECT event_id, round((epoch_us({NOW_SQL}) - epoch_us(ts)) / 3600000000.0::DOUBLE, 6) AS age_h FROM events WHERE ts >= {NOW_SQL} - INTERVAL 1 HOUR * greatest(84, CASE event_type WHEN 'signup' THEN 168 WHEN 'error' THEN 24 ELSE 0 END)")
def freshness_window(spark, sf_dir):
    """FLT-01, DAT-03 (unrounded to a tenth: engines differ on halves)."""
    own = F.when(F.col("event_type") == "signup", 168).when(F.col("event_type") == "error", 24)
    now = at_now()
    kept = window.fresh(events(spark, sf_dir), "ts", now, own)
    return kept.select("event_id", F.round((F.unix_micros(now) - F.unix_micros("ts")) / F.lit(3.6e9), 6).alias("age_h"))


@query("future_clamp", "SELECT event_id, epoch_us(least(ts, TIMESTAMP '2024-01-15')) AS micros FROM events WHERE ts <= TIMESTAMP '2024-01-15' + INTERVAL 10 DAY")
def future_clamp(spark, sf_dir):
    """FLT-02 with a horizon of ten days, which the table reaches past."""
    then = F.lit("2024-01-15").cast("timestamp")
    return window.clamped(events(spark, sf_dir), "ts", then, 10).select("event_id", F.unix_micros("ts").alias("micros"))


@query("earliest_sighting", "SELECT user_id, epoch_us(min(ts)) AS micros FROM events GROUP BY user_id")
def earliest_sighting(spark, sf_dir):
    """AGG-10."""
    return window.first_sightings(events(spark, sf_dir), "user_id", "ts").select("user_id", F.unix_micros("first_seen").alias("micros"))


@query("undated_first_seen", "WITH s AS (SELECT user_id, min(ts) AS f FROM events WHERE event_type = 'signup' GROUP BY user_id) SELECT event_id, (f IS NULL OR f >= TIMESTAMP '2024-01-03') AS is_new FROM events LEFT JOIN s USING (user_id) WHERE event_type = 'click'")
def undated_first_seen(spark, sf_dir):
    """FLT-03, JON-03: clicks as undated items, signups as sightings."""
    e = events(spark, sf_dir)
    seen = window.first_sightings(e.where("event_type = 'signup'"), "user_id", "ts")
    return window.undated_new(e.where("event_type = 'click'"), seen, "user_id", F.lit("2024-01-03").cast("timestamp")).select("event_id", "is_new")


@query("feed_limit_overflow", "WITH r AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events) SELECT user_id, count(*) FILTER (n <= 40) AS kept, count(*) FILTER (n > 40) AS overflow FROM r GROUP BY user_id")
def feed_limit_overflow(spark, sf_dir):
    """FLT-04, WIN-07, AGG-09."""
    rows = window.limited(events(spark, sf_dir), "user_id", ["event_id"], F.lit(40))
    return rows.groupBy("user_id").agg(F.count(F.when(~F.col("over"), 1)).alias("kept"), F.count(F.when(F.col("over"), 1)).alias("overflow"))


@query("seen_flag_left", "SELECT o_orderkey, CAST(CAST(s.d AS DATE) AS VARCHAR) AS seen_on FROM orders LEFT JOIN (SELECT l_orderkey AS k, min(l_shipdate) AS d FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) s ON o_orderkey = k")
def seen_flag_left(spark, sf_dir):
    """JON-01: orders flagged with the day a returned line was first seen."""
    seen = base.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.min("l_shipdate").alias("d"))
    return base.table(spark, sf_dir, "orders").join(seen, "o_orderkey", "left").select("o_orderkey", F.col("d").cast("date").cast("string").alias("seen_on"))


@query("cut_anti", "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')")
def cut_anti(spark, sf_dir):
    """JON-02."""
    cut = base.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return base.table(spark, sf_dir, "orders").join(cut, "o_orderkey", "left_anti").select("o_orderkey", "o_orderstatus")


@query("stale_judgements", "WITH d AS (SELECT doc_id, substr(sha1(substr(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), 1, 2000)), 1, 12) AS t FROM documents), j AS (SELECT doc_id, CASE WHEN quality = 1 THEN t ELSE 'old' END AS was FROM d JOIN labels USING (doc_id)) SELECT d.doc_id FROM d LEFT JOIN j USING (doc_id) WHERE t IS DISTINCT FROM was")
def stale_judgements(spark, sf_dir):
    """JON-15, FLT-21: documents unjudged, or judged on another text."""
    from tidemark.functions import text as T

    leads = base.table(spark, sf_dir, "documents").select("doc_id", T.text_id(F.col("text")).alias("text_id"))
    judged = leads.join(base.table(spark, sf_dir, "labels"), "doc_id").select("doc_id", F.when(F.col("quality") == 1, F.col("text_id")).otherwise("old").alias("text_id"))
    return state.stale(leads, judged, "doc_id").select("doc_id")


@query("coverage_missing", "SELECT n_name, count(*) AS unpicked, arg_min(c_name, c_custkey) AS first_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') GROUP BY n_name")
def coverage_missing(spark, sf_dir):
    """JON-16, AGG-19: by outlet, what was not picked and its first headline."""
    picked = base.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    rest = base.table(spark, sf_dir, "customer").join(picked, "c_custkey", "left_anti")
    nations = base.table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    return rest.join(nations, "c_nationkey").groupBy("n_name").agg(F.count("*").alias("unpicked"), F.min_by("c_name", "c_custkey").alias("first_name"))


@query("failure_streaks", """WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, bool_or(event_type = 'error') AS failed FROM events GROUP BY 1, 2),
g AS (SELECT user_id, max(day) FILTER (NOT failed) AS ok FROM d GROUP BY user_id)
SELECT user_id, count(*) AS fails, CAST(min(day) AS VARCHAR) AS since FROM d JOIN g USING (user_id) WHERE failed AND (ok IS NULL OR day > ok) GROUP BY user_id""")
def failure_streaks(spark, sf_dir):
    """AGG-11: users' last unbroken run of days with an error."""
    days = events(spark, sf_dir).groupBy("user_id", F.col("ts").cast("date").alias("day")).agg(F.bool_or(F.col("event_type") == "error").alias("failed"))
    return state.failure_streaks(days, "user_id", "day", "failed").select("user_id", "fails", F.col("since").cast("string").alias("since"))


@query("guarded_measures", """WITH o AS (SELECT user_id, sum(value) AS v FROM events WHERE ts < TIMESTAMP '2024-01-15' GROUP BY 1), n AS (SELECT user_id, sum(value) AS v FROM events WHERE ts >= TIMESTAMP '2024-01-15' GROUP BY 1)
SELECT user_id, coalesce(n.v < o.v * 0.95::DOUBLE, false) AS refused FROM o FULL JOIN n USING (user_id)""")
def guarded_measures(spark, sf_dir):
    """AGG-18, SNK-12's guard: a measure that drops too far is refused."""
    e, half = events(spark, sf_dir), F.lit("2024-01-15").cast("timestamp")
    total = lambda c: e.where(c).groupBy("user_id").agg(F.sum("value").alias("v"))
    return state.guarded_measure(total(F.col("ts") < half), total(F.col("ts") >= half), "user_id", "v").select("user_id", "refused")


@query("daily_editions", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS edition, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def daily_editions(spark, sf_dir):
    """STM-08 over the whole table."""
    days = events(spark, sf_dir).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return days.select(F.date_format("w.start", "yyyy-MM-dd").alias("edition"), "event_type", "n")


@query("london_days", "SELECT event_id, CAST(CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London' AS DATE) AS VARCHAR) AS day FROM events")
def london_days(spark, sf_dir):
    """DAT-05."""
    return events(spark, sf_dir).select("event_id", dates.london_date(F.col("ts")).cast("string").alias("day"))


@query("health_counters", """WITH p AS (SELECT user_id, bool_and(event_type <> 'error') AS ok FROM events WHERE ts >= TIMESTAMP '2024-01-28' GROUP BY 1), o AS (SELECT user_id, count(*) FILTER (event_type = 'error') AS fails FROM events WHERE ts < TIMESTAMP '2024-01-28' GROUP BY 1)
SELECT user_id, CAST(CASE WHEN ok THEN 0 ELSE coalesce(fails, 0) + 1 END AS BIGINT) AS fails FROM p LEFT JOIN o USING (user_id)""")
def health_counters(spark, sf_dir):
    """JON-20."""
    e, day = events(spark, sf_dir), F.lit("2024-01-28").cast("timestamp")
    probes = e.where(F.col("ts") >= day).groupBy("user_id").agg(F.bool_and(F.col("event_type") != "error").alias("ok")).select("user_id", "ok", F.lit("2024-01-28").alias("day"), F.lit("error").alias("error"))
    old = e.where(F.col("ts") < day).groupBy("user_id").agg(F.count(F.when(F.col("event_type") == "error", 1)).alias("fails")).select("user_id", "fails", F.lit("2024-01-01").alias("since"), F.lit("2024-01-01").alias("last_ok"), F.lit("2024-01-27").alias("last_checked"))
    return state.health(old, probes, "user_id").select("user_id", F.col("fails").cast("long").alias("fails"))


def streamed(spark, sf_dir):
    """The events as a file stream: written in a few files, read in one go."""
    rows = written(events(spark, sf_dir).repartition(4), "stream-input")
    return spark.readStream.schema(rows.schema).parquet(rows.inputFiles()[0].rsplit("/", 1)[0])


def streamed_rows(spark, stream, mode):
    return flows.run_once(stream, f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}", mode)


@query("stream_dedupe", "SELECT DISTINCT user_id FROM events")
def stream_dedupe(spark, sf_dir):
    """STM-01: each key once, however often it comes inside the watermark."""
    once = flows.seen_once(streamed(spark, sf_dir).select("user_id", "ts"), "user_id", "ts", "60 days")
    return streamed_rows(spark, once, "append").select("user_id")


@query("stream_daily", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS edition, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def stream_daily(spark, sf_dir):
    """STM-08: complete mode gives the whole table's counts."""
    days = streamed_rows(spark, flows.daily(streamed(spark, sf_dir), "ts"), "complete")
    return days.select(F.date_format("edition.start", "yyyy-MM-dd").alias("edition"), "event_type", "n")


@query("stream_first_seen", "SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(min(ts)) AS micros FROM events GROUP BY user_id")
def stream_first_seen(spark, sf_dir):
    """STM-03: complete mode gives each key's first sighting."""
    return streamed_rows(spark, flows.first_sightings(streamed(spark, sf_dir), "user_id", "ts"), "complete")


@query("stream_first_seen_kept", "SELECT CAST(user_id AS VARCHAR) AS key, epoch_us(min(ts)) AS micros FROM events GROUP BY user_id")
def stream_first_seen_kept(spark, sf_dir):
    """STM-03 with a time to live: state holds the periods that the watermark covers, the merge takes the earliest."""
    seen = streamed_rows(spark, flows.first_sightings(streamed(spark, sf_dir), "user_id", "ts", "21 days"), "update")
    return seen.groupBy("key").agg(F.min("micros").alias("micros"))
