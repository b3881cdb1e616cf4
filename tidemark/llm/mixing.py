"""Mixing sources to target weights by Poisson replication (operator 2), in DataFrame functions only.

A source's target weight is a power of its characters (or the caller's own weight). Its rate, the
mean number of times that a document of it is repeated, is its share of the total characters by
weight, divided by its characters. A document's copies are the inverse of the Poisson distribution
with that mean at a number in (0, 1) hashed from seed and id. A rate over PART is a sum: one Poisson
number for each whole PART of it and one for the rest, each inverted at a number of its own, so that
no distribution has more than some 200 steps. Copies are exploded and dealt out in the order of
another hash, which shuffles the whole corpus.

A null source is a source of its own; sources without any character keep each document once on
average; a source that the caller gives no weight goes. Rows with the same id get the same number of
copies, repeated rows too. Null texts count as empty, an empty table gives an empty table, and texts of
any length count by their characters. Equal hashes of two copies leave them in any order. Columns of
any name are kept; where the caller has one named copy, the copy's number takes a longer name.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

SEED = 17
#: Weight of a source: its characters to this power.
POWER = 0.7
#: The largest rate that is inverted at once.
PART = 64.0
#: Sources whose rates are broadcast at most: a source has some 200 steps of 8 bytes, 8 MB for all; beyond that the join is salted.
BROADCAST_SOURCES = 5_000
SALTS = 32


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of MD5."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(2.0**52)


def distribution(rate: Column) -> Column:
    """cdf[k]: the chance of at most k, up to where it rounds to 1; for rates up to PART."""
    # ln p(k) = ln p(k - 1) + ln rate - ln k, summed as it goes
    steps = F.sequence(F.lit(1), F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int"))
    start = F.struct((-rate).alias("lp"), F.exp(-rate).alias("sum"), F.array(F.exp(-rate)).alias("cdf"))

    def step(acc: Column, k: Column) -> Column:
        lp = acc["lp"] + F.log(rate) - F.log(k.cast("double"))
        return F.struct(lp.alias("lp"), (acc["sum"] + F.exp(lp)).alias("sum"), F.concat(acc["cdf"], F.array(acc["sum"] + F.exp(lp))).alias("cdf"))

    return F.when(rate > 0, F.aggregate(steps, start, step, lambda acc: acc["cdf"])).otherwise(F.array(F.lit(1.0)))


def rates(docs: DataFrame, power: float = POWER, weights: dict | None = None) -> DataFrame:
    """(source, rate, parts, cdf): the whole PARTs of the rate and the distribution of its rest."""
    sizes = docs.groupBy("source").agg(F.sum(F.char_length(common.text_or_empty())).cast("double").alias("size"))
    if weights is None:
        weight = F.pow("size", F.lit(power))
    else:
        pairs = [F.lit(x) for k, v in weights.items() for x in (k, float(v))]
        weight = F.coalesce(F.create_map(*pairs)[F.col("source")], F.lit(0.0)) if pairs else F.lit(1.0)
    sizes = sizes.withColumn("weight", F.when(F.col("size") > 0, weight).otherwise(0.0))
    total = sizes.agg(F.sum("size").alias("all"), F.sum("weight").alias("weights"))
    rated = sizes.crossJoin(F.broadcast(total))  # one row
    rate = F.when((F.col("size") > 0) & (F.col("weights") > 0), F.col("all") * F.col("weight") / F.col("weights") / F.col("size")).otherwise(F.when(F.col("size") > 0, 0.0).otherwise(1.0))
    rated = rated.select("source", rate.alias("rate")).withColumn("parts", F.greatest(F.ceil(F.col("rate") / PART) - 1, F.lit(0)).cast("int"))
    rated = rated.withColumn("rest", F.col("rate") - F.col("parts") * PART)
    return rated.select("source", "rate", "parts", distribution(F.col("rest")).alias("cdf"))


def mixed(docs: DataFrame, seed: int = SEED, power: float = POWER, weights: dict | None = None) -> DataFrame:
    """The documents' columns and copy (from 0), a row for each copy, in a shuffled order."""
    source, cdf, parts, salt, u, copies, order, whole = common.free(docs, "source", "cdf", "parts", "salt", "u", "copies", "order", "whole")
    (copy,) = common.named(docs, "copy")
    with common.workspace():
        table = common.staged(rates(docs, power, weights), "mix-rates")
    table = table.select(F.col("source").alias(source), F.col("cdf").alias(cdf), F.col("parts").alias(parts))
    few = table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    own = [F.col(common.quoted(c)) for c in docs.columns]
    same = F.col("source").eqNullSafe(F.col(source))
    if few:
        joined = docs.join(F.broadcast(table), same)
    else:
        at = salt + "_at"
        salted = table.withColumn(salt, F.explode(F.expr(f"sequence(0, {SALTS - 1})")))
        joined = docs.withColumn(at, F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, same & (F.col(at) == F.col(salt)))
    # a part's distribution is the same for all sources
    joined = joined.withColumn(whole, F.when(F.col(parts) > 0, distribution(F.lit(PART))))
    inverted = lambda steps, x: F.size(F.filter(steps, lambda c: c <= x))
    more = F.aggregate(F.sequence(F.lit(1), F.col(parts)), F.lit(0), lambda n, k: n + inverted(F.col(whole), uniform(seed, F.col("doc_id"), k)))
    # named twice, so that the optimiser keeps it a column: in the lambda alone it would be hashed anew for every step
    number = F.when(F.col(u) > 0, inverted(F.col(cdf), F.col(u))) + F.when(F.col(parts) > 0, more).otherwise(0)
    rows = joined.withColumn(u, uniform(seed, F.col("doc_id"))).withColumn(copies, number).where(F.col(copies) > 0)
    rows = rows.select(*own, F.explode(F.expr(f"sequence(0, {copies} - 1)")).alias(copy))
    key = F.xxhash64(F.lit(seed), "doc_id", copy)
    return rows.withColumn(order, key).repartition(order).sortWithinPartitions(order).drop(order)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every copy of every document, shuffled."""
    return mixed(common.table(spark, sf_dir, "documents")).select("doc_id", "source", "copy", "text")


def sql(seed: int = SEED, power: float = POWER) -> str:
    number = lambda part: f"(CAST('0x' || substr(md5('{seed}:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || {part}), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {2**52}::DOUBLE"
    return f"""WITH sizes AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS size FROM documents GROUP BY source),
rated AS (SELECT source, CASE WHEN size > 0 THEN (SELECT sum(size) FROM sizes) * pow(size, {power}) / (SELECT sum(pow(size, {power})) FROM sizes WHERE size > 0) / size ELSE 1.0 END AS rate FROM sizes),
parted AS (SELECT source, greatest(CAST(ceil(rate / {PART}) AS BIGINT) - 1, 0) AS parts, rate - greatest(ceil(rate / {PART}) - 1, 0) * {PART} AS rest FROM rated),
steps AS (SELECT source, rest, unnest(range(0, CAST(ceil(rest + 12 * sqrt(rest) + 30) AS BIGINT) + 1)) AS k FROM parted),
sums AS (SELECT source, k, sum(exp(k * ln(rest) - rest - lgamma(k + 1.0))) OVER (PARTITION BY source ORDER BY k) AS c FROM steps),
whole AS (SELECT k, sum(exp(k * ln({PART}) - {PART} - lgamma(k + 1.0))) OVER (ORDER BY k) AS c FROM (SELECT unnest(range(0, {int(PART + 12 * PART**0.5 + 30) + 1})) AS k)),
docs AS (SELECT d.*, parts, {number("''")} AS u FROM documents d JOIN parted p ON p.source IS NOT DISTINCT FROM d.source),
firsts AS (SELECT *, (SELECT count(*) FROM sums WHERE sums.source IS NOT DISTINCT FROM docs.source AND c <= u) AS rest_copies FROM docs),
further AS (SELECT doc_id, source, j, {number("':' || j")} AS v FROM (SELECT DISTINCT doc_id, source, unnest(range(1, parts + 1)) AS j FROM docs)),
more AS (SELECT doc_id, source, sum((SELECT count(*) FROM whole WHERE c <= v)) AS n FROM further GROUP BY doc_id, source),
counted AS (SELECT f.doc_id, f.source, f.text, rest_copies + coalesce(n, 0) AS copies FROM firsts f LEFT JOIN more m ON m.doc_id IS NOT DISTINCT FROM f.doc_id AND m.source IS NOT DISTINCT FROM f.source)
SELECT doc_id, source, CAST(unnest(range(0, CAST(copies AS BIGINT))) AS INTEGER) AS copy, text FROM counted WHERE copies > 0"""
