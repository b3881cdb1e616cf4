"""Streams driven into files: what every output mode leaves."""

from pyspark.sql import functions as F

from tidemark.operators.dedupe import shared_dir
from tidemark.streaming import flows


def test_update_results_of_all_batches_stand(spark, tmp_path):
    rows = [("a", "2024-01-01 10:00:00"), ("b", "2024-01-02 10:00:00"), ("a", "2024-01-01 09:00:00"), ("c", "2024-02-20 10:00:00")]
    for i in range(2):  # two batches, and the one that moves the watermark on
        spark.createDataFrame(rows[2 * i : 2 * i + 2], "k string, ts string").withColumn("ts", F.col("ts").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    seen = flows.run_once(flows.first_sightings(stream, "k", "ts", "21 days"), f"{shared_dir(spark)}/{tmp_path.name}", "update")
    got = {r.key: r.micros for r in seen.groupBy("key").agg(F.min("micros").alias("micros")).collect()}
    assert got == {"a": 1704099600000000, "b": 1704189600000000, "c": 1708423200000000}


def test_complete_results_replace(spark, tmp_path):
    for i in range(2):
        spark.createDataFrame([("a", i)], "k string, n int").write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("k string, n int").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counts = flows.run_once(stream.groupBy("k").count(), f"{shared_dir(spark)}/{tmp_path.name}", "complete")
    assert [tuple(r) for r in counts.collect()] == [("a", 2)]
