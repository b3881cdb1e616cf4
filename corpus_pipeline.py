"""From documents to token ids: five stages, each written as Parquet and read back as the next one's input.

Toxic documents go, then lines like an earlier line, then all but one document of each group of
near-duplicates; what is left is repeated to the sources' target weights and encoded. Every stage
but the last returns the columns of documents, extra ones too, under any name.

In every stage a null text counts as empty and a null id, source or label as a value of its own; texts
are taken whole, whatever their length; an empty table gives an empty table.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, lines, mixing, near, pieces, toxicity


def own_columns(out: DataFrame, docs: DataFrame) -> DataFrame:
    return out.select(*[F.col(common.quoted(c)) for c in docs.columns])


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5.

    Texts without words score as such texts among the examples do; repeated rows score alike; without
    labels every document stays.
    """
    return toxicity.accepted(docs, common.table(spark, sf_dir, "labels"))


def repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without lines that an earlier line is like; n_chars counts what is left.

    Every document stays, if only with an empty text; lines without words stay. A null id stands last,
    rows of one id in the order of their texts' hashes, and repeated rows lose the same lines.
    """
    return own_columns(lines.deduped(docs), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the least id.

    Empty texts are alike; rows of one id are one document, of which one row stays; rows without an id
    are told apart by their texts.
    """
    return near.keep_first(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's weight asks, in a shuffled order.

    A draw of 0 leaves a document out, as the distribution says; rows of one id are drawn alike.
    """
    return own_columns(mixing.mixed(docs), docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every row, with the end id, which alone stands for an empty text; copies give equal rows."""
    return pieces.encode(docs, outputs=("n_tokens", "ids"))


STAGES = [("toxicity", toxic), ("line dedup", repeated_lines), ("MinHash near-dedup", near_duplicates), ("mixing to target weights", mix), ("SentencePiece encoding", tokens)]

#: SQL cannot say the first, third and last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder; a stage's table goes when the next one stands."""
    docs, at = common.table(spark, sf_dir, "documents"), f"{common.shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{at}/{k}")
        docs = spark.read.schema(out.schema).parquet(f"{at}/{k}")
        docs._stage = f"{at}/{k}"
        if before is not None:
            common.release(before)
        before = docs
    return docs
