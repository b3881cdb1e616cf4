"""A tier model: hashed uni- and bigrams, multinomial logistic regression with class weights."""

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, Normalizer, RegexTokenizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS = 1 << 14


def pipeline(text: str = "headline", label: str = "label", weight: str = "weight") -> Pipeline:
    """Stable hashes, so that saved weights mean the same to every later process."""
    return Pipeline(stages=[
        RegexTokenizer(inputCol=text, outputCol="__u", pattern="[^\\p{L}0-9]+", toLowercase=True),
        NGram(n=2, inputCol="__u", outputCol="__b"),
        HashingTF(numFeatures=BUCKETS, inputCol="__u", outputCol="__fu"),
        HashingTF(numFeatures=BUCKETS, inputCol="__b", outputCol="__fb"),
        VectorAssembler(inputCols=["__fu", "__fb"], outputCol="__f"),
        Normalizer(inputCol="__f", outputCol="features"),
        LogisticRegression(family="multinomial", labelCol=label, weightCol=weight, regParam=1e-4, maxIter=20),
    ])


def weighted(rows: DataFrame, label: str = "label") -> DataFrame:
    """Each class weighs the same in all."""
    counts = rows.groupBy(label).agg(F.count("*").alias("__n"))
    total = rows.count()
    return rows.join(F.broadcast(counts), label).withColumn("weight", F.lit(float(total)) / F.col("__n")).drop("__n")  # a row for each class


def left_out(rows: DataFrame, fold: str, folds: list, text: str = "headline", label: str = "label") -> DataFrame:
    """Predictions for every fold by a model of the others."""
    out = None
    for k in folds:
        model = pipeline(text, label).fit(weighted(rows.where(F.col(fold) != k), label))
        said = model.transform(rows.where(F.col(fold) == k)).select(fold, label, "prediction")
        out = said if out is None else out.unionByName(said)
    return out
