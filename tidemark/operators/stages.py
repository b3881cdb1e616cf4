"""Whether two headlines report different stages of one story.

The vocabulary is the caller's: patterns for what looks ahead, what grants and what withholds, what goes
to law, and classes of outcome words. Each headline's facts are made once, as columns; a pair is a
comparison of facts, in a fixed order of axes.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def facts(rows: DataFrame, headline: str, ahead: str, granted: str, withheld: str, legal: str, outcomes: dict[str, str]) -> DataFrame:
    """Add `stage`: looks ahead, permission (true, false or null), goes to law, outcome classes."""
    has = lambda p: F.rlike(headline, F.lit(f"(?iu){p}"))
    given, denied = has(granted), has(withheld)
    permission = F.when(given & ~denied, True).when(denied & ~given, False)
    classes = F.array(*[F.when(has(p), name) for name, p in outcomes.items()]) if outcomes else F.array().cast("array<string>")
    stage = F.struct(has(ahead).alias("ahead"), permission.alias("permission"), has(legal).alias("legal"), F.filter(classes, lambda c: c.isNotNull()).alias("outcomes"))
    return rows.withColumn("stage", stage)


def is_development(a: Column, b: Column) -> Column:
    """Looking ahead on one side only; else, with permission on both, whether it differs; else law on one side
    only; else outcomes that share no class (one side may have none, not both)."""
    x, y = a["outcomes"], b["outcomes"]
    return (
        F.when(a["ahead"] != b["ahead"], True)
        .when(a["permission"].isNotNull() & b["permission"].isNotNull(), a["permission"] != b["permission"])
        .when(a["legal"] != b["legal"], True)
        .when((F.size(x) == 0) & (F.size(y) == 0), False)
        .otherwise(~F.arrays_overlap(x, y))
    )


def same_story(shared: Column, small: Column, uncommon: Column, named: Column, a_section: Column, b_section: Column, development: Column) -> Column:
    """Never across two known sections, never two stages; then enough words, or a rare shared name and three words."""
    words = ((shared >= F.lit(0.55) * small) | (shared >= 5)) & (uncommon >= 1)
    crossed = a_section.isNotNull() & b_section.isNotNull() & (a_section != b_section)
    return ~crossed & ~development & (words | (named & (shared >= 3)))
