"""Placing rows in region tiers from their headline, text, outlet: ordered pattern tables of the caller."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_tier(text: Column, table: list) -> Column:
    """The tier of the first pattern that matches, in the table's order."""
    out = None
    for tier, pattern in table:
        hit = F.rlike(text, F.lit(f"(?iu){pattern}"))
        out = F.when(hit, tier) if out is None else out.when(hit, tier)
    return out if out is not None else F.lit(None).cast("string")


def placed(rows: DataFrame, headline: str, text: str, outlet_tier: Column, table: list, label: str, twice: str, actors: list) -> DataFrame:
    """Add tier and how (headline, text, outlet, none).

    label: a nationality on a person or thing, which is no place of its own; a headline that has nothing else
    yields to another place in the text. twice: names of cities in two countries; alone they yield to the outlet.
    actors: patterns that place a headline without a place.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    bare = F.regexp_replace(headline, f"(?iu){label}", " ")
    bare_body = F.regexp_replace(body, f"(?iu){label}", " ")
    no_city = F.regexp_replace(bare, f"(?iu){twice}", " ")
    rows = rows.withColumns({"__h": first_tier(F.col(headline), table), "__b": first_tier(bare, table), "__t": first_tier(bare_body, table), "__c": first_tier(no_city, table), "__a": first_tier(F.col(headline), actors), "__ab": first_tier(bare, actors), "__o": outlet_tier})
    borrowed = F.col("__b").isNull() & F.col("__t").isNotNull() & (F.col("__t") != F.col("__h"))
    doubtful = F.rlike(headline, F.lit(f"(?iu){twice}")) & F.col("__c").isNull() & F.col("__o").isNotNull() & (F.col("__o") != F.col("__h"))
    acted = F.col("__ab").isNull() & F.col("__t").isNotNull() & (F.col("__t") != F.col("__a"))
    pair = lambda tier, how: F.struct(tier.alias("tier"), F.lit(how).alias("how"))
    found = (
        F.when(F.col("__h").isNotNull() & borrowed, pair(F.col("__t"), "text"))
        .when(F.col("__h").isNotNull() & doubtful, pair(F.col("__o"), "outlet"))
        .when(F.col("__h").isNotNull(), pair(F.col("__h"), "headline"))
        .when(F.col("__a").isNotNull() & acted, pair(F.col("__t"), "text"))
        .when(F.col("__a").isNotNull(), pair(F.col("__a"), "headline"))
        .when(F.col("__o").isNotNull(), pair(F.col("__o"), "outlet"))
        .otherwise(pair(F.lit("Unplaced"), "none"))
    )
    return rows.withColumn("__p", found).withColumns({"tier": F.col("__p.tier"), "how": F.col("__p.how")}).drop("__h", "__b", "__t", "__c", "__a", "__ab", "__o", "__p")


def longest(rows: DataFrame, key: str, text: str, names: DataFrame, name: str, value: str) -> DataFrame:
    """(key, value) of the longest of a bounded list of names that a text holds."""
    hit = rows.join(F.broadcast(names), F.contains(F.lower(text), F.lower(name)))
    return hit.groupBy(key).agg(F.max_by(value, F.struct(F.char_length(name), name)).alias(value))
