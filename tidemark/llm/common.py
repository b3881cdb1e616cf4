"""What the operators share: reading tables, stage tables in the shared folder, shipping code."""

import sys
import uuid
from contextlib import contextmanager

import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__.rpartition(".")[0]])

#: Five-word shingles at a similarity of 0.8, unless an operator's contract says otherwise.
SHINGLE_WORDS = 5
SIMILARITY = 0.8
#: Where a session without spark.checkpoint.dir keeps the folder it was given.
OWN_DIR = "spark.tidemark.shared.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares; a local one only where none is named (tests)."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(OWN_DIR, None)
    if not where:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the cluster shares")
        import tempfile

        where = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set(OWN_DIR, where)
    return where


#: The step tables of the workspaces that are open now, innermost last.
OPEN: list = []


@contextmanager
def workspace(keep_last: bool = True):
    """Delete the step tables that are written inside, but for the last one, the result."""
    made: list = []
    OPEN.append(made)
    try:
        yield
    except BaseException:
        keep_last = False
        raise
    finally:
        OPEN.pop()
        kept = made[-1:] if keep_last else []
        for table in made[: len(made) - len(kept)]:
            release(table)
        if OPEN:
            OPEN[-1].extend(kept)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Hold a setting of the session while a step is written."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def cleaning(spark: SparkSession):
    """Let Spark drop a query's shuffle files as soon as it has ended."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def staged(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write a step's table to the shared folder and read it back.

    This cuts lineage so that a lost executor costs one step, and lets Spark drop the step's
    shuffle files as soon as it has ended.
    """
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/tidemark-{label}-{uuid.uuid4().hex}"
    with cleaning(spark):
        df.write.option("compression", compression).parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    return kept(out, at)


def bucketed(df: DataFrame, label: str, key: str, compression: str = "snappy", dictionary: bool = True) -> DataFrame:
    """As staged(), but dealt by the hash of a key into as many buckets as a shuffle has partitions: joins on it don't shuffle the table.

    The files stand in the shared folder; the session's catalogue holds the layout until release(). Values that
    hardly repeat need no dictionary, which is built and given up at a cost.
    """
    spark = df.sparkSession
    name = f"tidemark_{label.replace('-', '_')}_{uuid.uuid4().hex}"
    at = f"{shared_dir(spark)}/{name}"
    buckets = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    with cleaning(spark):
        df.write.option("compression", compression).option("parquet.enable.dictionary", str(dictionary).lower()).option("path", at).bucketBy(buckets, key).format("parquet").saveAsTable(name)
    out = spark.table(name)
    out._table = name
    return kept(out, at)


def kept(table: DataFrame, at: str) -> DataFrame:
    table._stage = at
    if OPEN:
        OPEN[-1].append(table)
    return table


def release(table: DataFrame) -> None:
    """Delete a step's table that no later step reads."""
    spark = table.sparkSession
    if hasattr(table, "_table"):
        spark.sql(f"DROP TABLE IF EXISTS {table._table}")
    path = spark._jvm.org.apache.hadoop.fs.Path(table._stage)
    path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def slices(batch, columns: str | tuple, rows: int = 256, size: int = 4_000_000):
    """A record batch in parts of so many rows and of so many bytes in its text columns at most (or of one row)."""
    columns = (columns,) if isinstance(columns, str) else columns
    lengths = sum(pc.binary_length(batch.column(c)).to_numpy(zero_copy_only=False).astype("int64") for c in columns)
    total, begin = 0, 0
    for at, n in enumerate(lengths.tolist()):
        if at > begin and (at - begin == rows or total + n > size):
            yield batch.slice(begin, at - begin)
            total, begin = 0, at
        total += n
    if begin < batch.num_rows:
        yield batch.slice(begin)


def trimmed() -> None:
    """Give memory that a Python process has freed back to the system, where its allocators can."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def quoted(name: str) -> str:
    """A column's name as an expression that also holds for names with dots."""
    return "`" + name.replace("`", "``") + "`"


def named(df: DataFrame, *names: str) -> list:
    """The names, each with as many underscores behind it as no column of the caller's has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def free(df: DataFrame, *names: str) -> list:
    """Names for helper columns: no column of the caller's has or begins with one."""
    stem = "__"
    while any(c.lower().startswith(stem) for c in df.columns):
        stem += "_"
    return [stem + n for n in names]
