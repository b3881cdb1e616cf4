"""Session helpers shared by the benchmarks and the tests."""

from pyspark.sql import SparkSession


def local_session(cores: int = 8, shuffle: int = 8, memory: str = "8g") -> SparkSession:
    """A UTC local session with adaptive execution; used by bench.py and tests."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
