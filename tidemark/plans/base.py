"""What the query modules share."""

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def register(queries: dict, sqls: dict, name: str, sql: str | None = None):
    """Put a function (spark, sf_dir) -> DataFrame into a module's tables, with its SQL where there is one."""

    def keep(function):
        queries[name] = function
        if sql:
            sqls[name] = sql
        return function

    return keep


def quoted(items) -> str:
    return ", ".join("'" + x.replace("'", "''") + "'" for x in items)
