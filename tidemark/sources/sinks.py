"""Sinks: editions, slices, sheets and keyed stores."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def archive(tables: dict[str, DataFrame], folder: str, edition: str) -> None:
    """One folder for each table and edition; an edition that is there already is refused."""
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{folder}/{name}/edition={edition}")


def sheet(rows: DataFrame, pattern: str, columns: list, order: list, at: str, mode: str = "errorifexists") -> None:
    """Formatted lines in order, range-partitioned: the files read in name order are the sheet."""
    rows.orderBy(*order).select(F.format_string(pattern, *columns).alias("value")).write.mode(mode).text(at)


def slices(rows: DataFrame, section: str, at: str) -> None:
    """A folder for each section and slice."""
    rows.write.mode("overwrite").partitionBy(section, "slice").json(at)


def manifest(items: DataFrame, picks: DataFrame, judged: DataFrame, edition: str) -> DataFrame:
    """One row of an edition's counts."""
    one = items.agg(F.count("*").alias("items"))
    two = picks.agg(F.count("*").alias("picked"), F.count("tier").alias("tiered"))
    three = judged.agg(F.count("*").alias("leads_judged"), F.count("reason").alias("reasons_given"))
    return one.join(two, how="cross").join(three, how="cross").withColumn("date", F.lit(edition))  # one row each


def save_store(df: DataFrame, at: str, version: str) -> str:
    """A keyed store as a new snapshot; readers move to it once it is complete."""
    path = f"{at}/version={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def append_log(df: DataFrame, at: str) -> None:
    df.write.mode("append").json(at)
