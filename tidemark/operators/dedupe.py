"""Exact greedy dedupe on two keys, and the smaller dedupes around it."""

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Lets Spark drop a query's shuffle files as soon as it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark) -> str:
    """The folder that spark.checkpoint.dir names; a temporary one only on a local master without the setting, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.tidemark.shared.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        import tempfile

        folder = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.tidemark.shared.dir", folder)
    return folder


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a round to the shared folder and read it back: a lost executor costs one round, and the round's shuffle files go with it."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(at)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(at)
    out._written = at
    return out


def discarded(table: DataFrame) -> None:
    """Delete a round's table that no later round and no result reads."""
    session = table.sparkSession
    path = session._jvm.org.apache.hadoop.fs.Path(table._written)
    path.getFileSystem(session._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def greedy(rows: DataFrame, id_column: str, order: list, keys: tuple[str, str]) -> DataFrame:
    """(id, kept): rows in order are kept unless a kept row before them has the same first or second key.

    A dropped row's other key is not registered. Rounds: an undecided row that is first among the
    undecided of both its keys is kept, and rows after it that share a key with it are dropped. Empty or
    null keys match nothing. Order must end in a unique column.
    """
    rank = F.struct(*[F.col(c) for c in order])
    blank = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) == "", F.concat(F.lit("\x00"), F.col(id_column).cast("string"))).otherwise(F.col(c))
    undecided = written(rows.select(F.col(id_column).alias("id"), rank.alias("rank"), blank(keys[0]).alias("k1"), blank(keys[1]).alias("k2")), "greedy-rows")
    kept = None
    while True:
        # least rank by key, combined before the shuffle; a window would gather a hot key in one task
        m1 = undecided.groupBy("k1").agg(F.min("rank").alias("m1"))
        m2 = undecided.groupBy("k2").agg(F.min("rank").alias("m2"))
        won = written(undecided.join(m1, "k1").join(m2, "k2").where("rank = m1 AND rank = m2").select("id", "k1", "k2"), "greedy-kept")
        kept = won if kept is None else kept.unionByName(won)
        left = undecided.join(won.select("k1"), "k1", "left_anti").join(won.select("k2"), "k2", "left_anti")
        before, undecided = undecided, written(left, "greedy-left")
        discarded(before)
        if undecided.isEmpty():
            break
    discarded(undecided)
    return rows.select(F.col(id_column).alias("id")).join(kept.select("id", F.lit(True).alias("kept")), "id", "left").select("id", F.coalesce("kept", F.lit(False)).alias("kept"))


def borrowed_summary(kept: DataFrame, dropped: DataFrame, key: str, summary: str, gain: int = 40) -> DataFrame:
    """A kept row takes the longest summary of its dropped copies that is over `gain` characters longer."""
    size = F.char_length(summary)
    best = dropped.groupBy(key).agg(F.max_by(summary, F.struct(size, F.col(summary))).alias("offer"))
    joined = kept.join(best, key, "left")
    better = F.coalesce(F.char_length("offer"), F.lit(0)) > F.coalesce(F.char_length(summary), F.lit(0)) + gain
    return joined.withColumn("borrowed", better).withColumn(summary, F.when(F.col("borrowed"), F.col("offer")).otherwise(F.col(summary))).drop("offer")


def direct_links(items: DataFrame, index: DataFrame, key: str, url: str, is_redirect: Column, order: list) -> DataFrame:
    """Redirects take the first direct link with the same title key."""
    first = index.groupBy(key).agg(F.min_by(url, F.struct(*order)).alias("direct"))
    return items.join(first, key, "left").withColumn(url, F.when(is_redirect & F.col("direct").isNotNull(), F.col("direct")).otherwise(F.col(url))).drop("direct")


def ranked_once(rows: DataFrame, key: str, order: list) -> DataFrame:
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rows.withColumn("__n", place).where("__n = 1").drop("__n")
