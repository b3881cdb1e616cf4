"""Quotas and orders of a selection, which equal the running counts they stand for.

Ranks inside a group go through ranked(), so that no window gathers a group, however large, in one task.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedupe import written


def ranked(rows: DataFrame, group: list, order: list, name: str) -> DataFrame:
    """Add a row's place in its group, from 1. Order must end in a unique column.

    Rows are dealt into ranges of (group, order) and counted by range and group; a row's place is its
    place in its range and the rows of its group in the ranges before. The ranges are written, as they
    are read twice and must not be drawn anew.
    """
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    keys = [F.col(g) for g in group]
    dealt = written(rows.repartitionByRange(parts, *keys, *order).withColumn("__range", F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy("__range", *group).agg(F.count("*").alias("__rows"))
    before = F.coalesce(F.sum("__rows").over(Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # a row for each range and group that meet: at most as many as both together, and one range of a group at a time
    offsets = sizes.select(F.col("__range").alias("__r"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], before.alias("__before"))
    inside = F.row_number().over(Window.partitionBy("__range", *group).orderBy(*order))
    same = F.col("__range") == F.col("__r")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    placed = dealt.withColumn("__inside", inside).join(offsets, same)
    return placed.select(*rows.columns, (F.col("__before") + F.col("__inside")).cast("int").alias(name))


def diversified(rows: DataFrame, section: str, outlet: str, order: list, most: int, exempt: Column) -> DataFrame:
    """head: the first so many of an outlet in a section, and exempt rows; the rest is the tail."""
    place = F.row_number().over(Window.partitionBy(section, F.lower(outlet)).orderBy(*order))
    return rows.withColumn("head", (place <= most) | exempt)


def share_capped(rows: DataFrame, section: str, inside: Column, order: list, limit: Column, exempt: Column) -> DataFrame:
    """Of the rows inside the quota group the first `limit` of a section stay, and exempt ones, which use quota up."""
    own = ranked(rows.where(inside), [section], order, "__place")
    kept = own.withColumn("kept", (F.col("__place") <= limit) | exempt).drop("__place")
    return kept.unionByName(rows.where(~F.coalesce(inside, F.lit(False))).withColumn("kept", F.lit(True)))


def allowance(others: Column, share: float = 0.30) -> Column:
    """How many of the group a section may hold so that its share lands on `share`."""
    return F.greatest(F.lit(1), F.floor(others * F.lit(share) / F.lit(1.0 - share)).cast("int"))


def section_capped(rows: DataFrame, section: str, order: list, cap: Column) -> DataFrame:
    return ranked(rows, [section], order, "__place").withColumn("cut", F.col("__place") > cap).drop("__place")


def round_robin(rows: DataFrame, section: str, tier: str, outlet: str, place: str) -> DataFrame:
    """Blocks of tiers in order of first appearance; inside a block outlets take turns."""
    first = rows.groupBy(section, tier, outlet).agg(F.min(place).alias("__first"))
    block = first.groupBy(section, tier).agg(F.min("__first").alias("__block"))
    turns = ranked(rows, [section, tier, outlet], [place], "__turn")
    marked = turns.join(first, [section, tier, outlet]).join(block, [section, tier])
    return ranked(marked, [section], ["__block", "__turn", "__first"], "final").drop("__block", "__turn", "__first")


def by_region(rows: DataFrame, section: str, tier: str, sure: str, country: str, place: str) -> DataFrame:
    """Tier, then rows sure of their place, then countries grouped by their first row, then the row's place."""
    first = rows.groupBy(section, tier, sure, country).agg(F.min(place).alias("__first"))
    marked = rows.join(first, [section, tier, sure, country])
    return ranked(marked, [section], [tier, F.desc(sure), "__first", place], "final").drop("__first")


def first_by(rows: DataFrame, keys: list, order: list) -> DataFrame:
    """One row of each key: the first in order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("__place", place).where("__place = 1").drop("__place")


def sliced(rows: DataFrame, section: str, order: list, slices: int, least: int = 60) -> DataFrame:
    """Number the slice of every row: a section is cut into pieces of max(least, ceil(rows / slices))."""
    sizes = rows.groupBy(section).agg(F.greatest(F.lit(least), F.ceil(F.count("*") / slices).cast("int")).alias("__each"))
    placed = ranked(rows, [section], order, "__place").join(sizes, section)
    return placed.withColumn("slice", F.floor((F.col("__place") - 1) / F.col("__each")).cast("int")).drop("__place", "__each")


def last_editions(rows: DataFrame, edition: str, n: int) -> DataFrame:
    """Rows of the n newest editions (not days). Ranks the distinct editions, not the rows."""
    newest = rows.select(edition).distinct().orderBy(F.desc(edition)).limit(n)
    return rows.join(newest, edition, "left_semi")
