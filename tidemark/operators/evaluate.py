"""Measures of rankings and matchers against judgements."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.select import ranked


def concordance(rows: DataFrame, edition: str, label: str, score: str) -> DataFrame:
    """Share of pairs with different labels that the score orders the same way, ties half, by edition.

    No pairs are made: rows are counted by (label, score), and for each count the rows of higher labels
    above, level and below are running sums over distinct scores.
    """
    counts = rows.groupBy(edition, label, score).agg(F.count("*").alias("n"))
    levels = [r[0] for r in counts.select(label).distinct().collect()]  # labels are a handful of grades
    by_score = counts.groupBy(edition, score).pivot(label, sorted(levels)).agg(F.first("n")).na.fill(0)
    below = Window.partitionBy(edition).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    good, pairs = F.lit(0.0), F.lit(0.0)
    for high in sorted(levels):
        for low in [x for x in levels if x < high]:
            good = good + F.col(str(high)) * (F.coalesce(F.sum(str(low)).over(below), F.lit(0)) + F.col(str(low)) / 2)
            pairs = pairs + F.col(str(high)) * F.sum(str(low)).over(Window.partitionBy(edition))
    each = by_score.select(edition, good.alias("good"), pairs.alias("pairs"))
    return each.groupBy(edition).agg((F.sum("good") / F.sum("pairs")).alias("concordance"), F.sum("pairs").cast("long").alias("pairs"))


def precision_at(rows: DataFrame, edition: str, order: list, hit: str, k: int = 40) -> DataFrame:
    """Share of hits among the first k of an edition; every task keeps its first k before the shuffle."""
    place = F.row_number().over(Window.partitionBy(edition).orderBy(*order))
    return rows.withColumn("__n", place).where(F.col("__n") <= k).groupBy(edition).agg(F.avg(F.col(hit).cast("double")).alias("precision"))


def recall_in_top(rows: DataFrame, edition: str, order: list, hit: str, parts: int = 10) -> DataFrame:
    """Share of the hits that stand in the first tenth of an edition."""
    sizes = rows.groupBy(edition).agg(F.count("*").alias("__all"))
    marked = ranked(rows, [edition], order, "__n").join(sizes, edition)
    top = (F.col("__n") <= F.floor(F.col("__all") / parts)) & F.col(hit)
    return marked.groupBy(edition).agg((F.count(F.when(top, 1)) / F.count(F.when(F.col(hit), 1))).alias("recall"))


def matcher(pairs: DataFrame, said: str, true: str) -> DataFrame:
    """Counts, recall, false positive rate, precision and F1 of one matcher."""
    n = lambda c: F.count(F.when(c, 1))
    tp, fp, fn, tn = (n(F.col(said) & F.col(true)), n(F.col(said) & ~F.col(true)), n(~F.col(said) & F.col(true)), n(~F.col(said) & ~F.col(true)))
    c = pairs.agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"), tn.alias("tn"))
    return c.select("*", (F.col("tp") / (F.col("tp") + F.col("fn"))).alias("recall"), (F.col("fp") / (F.col("fp") + F.col("tn"))).alias("fpr"), (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"), (2 * F.col("tp") / (2 * F.col("tp") + F.col("fp") + F.col("fn"))).alias("f1"))


def sampled(rows: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """The n rows with the least hash: a repeatable sample of fixed size."""
    return rows.orderBy(F.xxhash64(F.lit(seed), *keys), *keys).limit(n)
