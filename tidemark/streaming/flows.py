"""Structured Streaming forms of the run-to-run behaviour: seen once, first sightings, daily editions."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def seen_once(stream: DataFrame, key: str, time: str, window: str = "168 hours") -> DataFrame:
    """Each key once while the watermark covers it: overlapping sweeps publish an item once."""
    return stream.withWatermark(time, window).dropDuplicatesWithinWatermark([key])


def first_sightings(stream: DataFrame, key: str, time: str, kept: str | None = None) -> DataFrame:
    """(key, micros): the earliest time of each key, updated as earlier ones arrive.

    kept: how long a sighting stays in the stream's state (such as "21 days"). A key's sightings are then
    grouped by periods of that length, so that the watermark can drop the past ones; the earliest of them
    is taken when the result is merged into the stored table (operators.state.merged), which applies its
    own retention. Without it state holds every key.
    """
    keyed = stream.select(F.col(key).cast("string").alias("key"), F.col(time).alias("at"))
    if kept is None:
        return keyed.groupBy("key").agg(F.min(F.unix_micros("at")).alias("micros"))
    return keyed.withWatermark("at", kept).groupBy("key", F.window("at", kept)).agg(F.min(F.unix_micros("at")).alias("micros")).select("key", "micros")


def daily(stream: DataFrame, time: str, late: str = "36 hours") -> DataFrame:
    """Items by edition: a tumbling day with a watermark."""
    return stream.withWatermark(time, late).groupBy(F.window(time, "1 day").alias("edition"), "event_type").agg(F.count("*").alias("n"))


def run_once(stream: DataFrame, target: str, mode: str = "append") -> DataFrame:
    """Drive what is there now through a stream into files in the shared folder, wait, and read them.

    A complete result replaces the one before. An update result holds only what its batch changed (none, in the
    batch that moves the watermark on alone), so those of all batches stand: a key may come several times.
    """

    def replace(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/rows" if mode == "complete" else f"{target}/rows/{number}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True)
    query = writer.format("parquet").start(f"{target}/rows") if mode == "append" else writer.foreachBatch(replace).start()
    query.awaitTermination()
    reader = stream.sparkSession.read.schema(stream.schema)
    return (reader.option("recursiveFileLookup", "true") if mode == "update" else reader).parquet(f"{target}/rows")


def publish_batches(stream: DataFrame, target: str, checkpoint: str):
    """Idempotent editions: a batch overwrites its own folder, so a repeated batch changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
