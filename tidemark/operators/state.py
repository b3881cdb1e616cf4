"""Keyed state over runs: merges, retention, judgements and failure streaks."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RETENTION_DAYS = 21


def merged(old: DataFrame, new: DataFrame, key: str, time: str, now: Column, days: int = RETENTION_DAYS) -> DataFrame:
    """The earliest time of each key in either table, without keys older than the retention."""
    both = old.select(key, time).unionByName(new.select(key, time))
    return both.groupBy(key).agg(F.min(time).alias(time)).where(F.unix_micros(time) >= F.unix_micros(now) - F.lit(days * 86_400_000_000))


def stale(leads: DataFrame, judged: DataFrame, key: str) -> DataFrame:
    """Leads without a judgement, or whose text has changed since."""
    old = judged.select(F.col(key), F.col("text_id").alias("was"))
    return leads.join(old, key, "left").where(~F.col("text_id").eqNullSafe(F.col("was"))).drop("was")


def failure_streaks(log: DataFrame, source: str, day: str, failed: str) -> DataFrame:
    """(source, fails, since): the length and first day of each source's last unbroken run of failing days."""
    last_ok = F.max(F.when(~F.col(failed), F.col(day)))
    good = log.groupBy(source).agg(last_ok.alias("last_ok"))
    run = log.where(F.col(failed)).join(good, source).where(F.col("last_ok").isNull() | (F.col(day) > F.col("last_ok")))
    return run.groupBy(source).agg(F.count("*").alias("fails"), F.min(day).alias("since"))


def guarded_measure(old: DataFrame, new: DataFrame, key: str, value: str, drop: float = 0.05) -> DataFrame:
    """New values replace old ones, unless they fall by more than a share: then the old one stays."""
    joined = old.select(key, F.col(value).alias("__old")).join(new.select(key, F.col(value).alias("__new")), key, "full")
    refuse = F.col("__new").isNull() | (F.col("__old").isNotNull() & (F.col("__new") < F.col("__old") * F.lit(1 - drop)))
    return joined.select(key, F.when(refuse, F.col("__old")).otherwise(F.col("__new")).alias(value), (refuse & F.col("__new").isNotNull()).alias("refused"))


def shrunk(before: DataFrame, after: DataFrame, share: float = 0.10) -> bool:
    """Whether a store lost more than a share of its rows; a save is refused then."""
    a, b = before.count(), after.count()
    return b < a * (1 - share)


def overlay_newer(base: DataFrame, fresh: DataFrame, key: str, value: str, logged: str, as_of: str) -> DataFrame:
    """A fresher count replaces the logged one."""
    joined = base.join(fresh.select(key, F.col(value).alias("__v"), F.col(as_of).alias("__at")), key, "left")
    newer = F.col("__at").isNotNull() & (F.col("__at") >= F.col(logged))
    return joined.withColumn(value, F.when(newer, F.col("__v")).otherwise(F.col(value))).drop("__v", "__at")


def health(old: DataFrame, probes: DataFrame, source: str) -> DataFrame:
    """Counters after today's probes (source, ok, day, error); sources that are no longer probed vanish."""
    joined = probes.join(old.select(source, "fails", "since", "last_ok", "last_checked"), source, "left")
    again = F.col("last_checked").eqNullSafe(F.col("day"))
    fails = F.when(F.col("ok"), 0).when(again, F.coalesce("fails", F.lit(1))).otherwise(F.coalesce("fails", F.lit(0)) + 1)
    since = F.when(F.col("ok"), F.lit(None)).otherwise(F.coalesce(F.when(F.coalesce("fails", F.lit(0)) > 0, F.col("since")), F.col("day")))
    return joined.select(source, fails.alias("fails"), since.alias("since"), F.when(F.col("ok"), F.col("day")).otherwise(F.col("last_ok")).alias("last_ok"), F.col("day").alias("last_checked"), F.when(~F.col("ok"), F.col("error")).alias("last_error"))


