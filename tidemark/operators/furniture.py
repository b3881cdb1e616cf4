"""Recurring page furniture: n-grams that many documents of a host share, and cutting runs of them."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRAM, LEAST_RUN, BRIDGE = 6, 10, 3


def words(c: Column) -> Column:
    return F.filter(F.split(c, r"\s+"), lambda w: w != "")


def grams(w: Column, n: int = GRAM) -> Column:
    """Every n consecutive words of an array column, in order. The array must be a column: a lambda would make it anew for each gram."""
    return F.when(F.size(w) >= n, F.transform(F.slice(w, 1, F.size(w) - (n - 1)), lambda x, i: F.array_join(F.slice(w, i + 1, F.lit(n)), " "))).otherwise(F.array().cast("array<string>"))


def learned(rows: DataFrame, host: str, text: str, least: int, share: float, n: int = GRAM) -> DataFrame:
    """(host, gram, df): n-grams in at least max(least, share of the host's documents)."""
    split = rows.select(F.col(host).alias("host"), words(F.col(text)).alias("w"))
    each = split.select("host", F.explode(F.array_distinct(grams(F.col("w"), n))).alias("gram")).groupBy("host", "gram").agg(F.count("*").alias("df"))
    sizes = rows.groupBy(F.col(host).alias("host")).agg(F.count("*").alias("docs")).where(F.col("docs") >= least)
    return each.join(sizes, "host").where(F.col("df") >= F.greatest(F.lit(float(least)), F.lit(share) * F.col("docs"))).select("host", "gram", "df")


def keyed(rows: DataFrame, *columns: str) -> DataFrame:
    """(columns, k1, k2): 128 bits for the host and gram of each row; they stand for the words, which take several times as much of a shuffle."""
    return rows.select(*columns, F.xxhash64("host", "gram").alias("k1"), F.xxhash64(F.lit(1), "gram", "host").alias("k2"))


def learned_keys(rows: DataFrame, host: str, text: str, least: int, n: int = GRAM) -> DataFrame:
    """(k1, k2) of the n-grams in at least so many of a host's documents: learned() without a share, and without words in the shuffle."""
    split = rows.select(F.col(host).alias("host"), words(F.col(text)).alias("w")).where(F.col("host").isNotNull())
    each = keyed(split.select("host", F.explode(F.array_distinct(grams(F.col("w"), n))).alias("gram")))
    return each.groupBy("k1", "k2").agg(F.count("*").alias("df")).where(F.col("df") >= least).select("k1", "k2")


def furniture_runs(rows: DataFrame, id_column: str, host: str, text: str, known: DataFrame, n: int = GRAM, least_run: int = LEAST_RUN) -> DataFrame:
    """(id, begin, length) of every run of at least `least_run` words that known grams (host, gram) or their keys cover: gaps and islands."""
    split = rows.select(F.col(id_column).alias("id"), F.col(host).alias("host"), words(F.col(text)).alias("w")).where(F.col("host").isNotNull())
    spread = keyed(split.select("id", "host", F.posexplode(grams(F.col("w"), n)).alias("at", "gram")), "id", "at")
    keys = keyed(known) if "gram" in known.columns else known
    hits = spread.join(keys, ["k1", "k2"], "left_semi").select("id", F.explode(F.sequence(F.col("at"), F.col("at") + (n - 1))).alias("word")).distinct()
    island = F.col("word") - F.row_number().over(Window.partitionBy("id").orderBy("word"))
    return hits.withColumn("island", island).groupBy("id", "island").agg(F.min("word").alias("begin"), F.count("*").alias("length")).where(F.col("length") >= least_run).drop("island")


def bridged(runs: DataFrame, most: int = BRIDGE) -> DataFrame:
    """(id, begin, length): runs with at most `most` words between them are one cut, those words included."""
    each = Window.partitionBy("id").orderBy("begin")
    gap = F.col("begin") - F.lag(F.col("begin") + F.col("length")).over(each)
    marked = runs.withColumn("new", F.when(gap <= most, 0).otherwise(1)).withColumn("cut", F.sum("new").over(each))
    ends = marked.groupBy("id", "cut").agg(F.min("begin").alias("begin"), F.max(F.col("begin") + F.col("length")).alias("end"))
    return ends.select("id", "begin", (F.col("end") - F.col("begin")).alias("length"))
