"""Event-time windows, clamps, first sightings and limits by source."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def sweep_hours(now: Column) -> Column:
    """36 hours back, 84 on Mondays (over the weekend)."""
    return F.when(F.dayofweek(now) == 2, 84).otherwise(36)


def fresh(items: DataFrame, time: str, now: Column, own_hours: Column) -> DataFrame:
    """Rows inside the longer of the sweep's window and the source's own."""
    hours = F.greatest(sweep_hours(now), F.coalesce(own_hours, F.lit(0)))
    return items.where(F.unix_micros(F.col(time)) >= F.unix_micros(now) - hours * F.lit(3_600_000_000))


def clamped(items: DataFrame, time: str, now: Column, days: int = 120) -> DataFrame:
    """Times after now become now; rows more than so many days ahead go."""
    limit = F.unix_micros(now) + F.lit(days * 86_400_000_000)
    return items.where(F.col(time).isNull() | (F.unix_micros(F.col(time)) <= limit)).withColumn(time, F.when(F.col(time) > now, now).otherwise(F.col(time)))


def first_sightings(seen: DataFrame, key: str, time: str) -> DataFrame:
    """The earliest time of each key; applying it twice changes nothing."""
    return seen.groupBy(key).agg(F.min(time).alias("first_seen"))


def undated_new(items: DataFrame, sightings: DataFrame, key: str, cutoff: Column) -> DataFrame:
    """Undated rows count as new while their key was never seen, or not before the cutoff."""
    joined = items.join(sightings, key, "left")
    return joined.withColumn("is_new", F.col("first_seen").isNull() | (F.col("first_seen") >= cutoff))


def limited(items: DataFrame, source: str, order: list, most: Column) -> DataFrame:
    """Number rows of each source in feed order; rows past the source's limit are marked over."""
    rank = F.row_number().over(Window.partitionBy(source).orderBy(*order))
    return items.withColumn("place", rank).withColumn("over", F.col("place") > most)
