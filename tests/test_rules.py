"""Stages, places, filters and sinks."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators import filters, places, stages
from tidemark.sources import sinks


@pytest.mark.parametrize(("a", "b", "want"), [
    ("MPs to vote on the Bill", "MPs vote down the Bill", True),
    ("UK drops travel ban", "UK bars MP", True),
    ("UK drops travel ban", "Visa granted to MP", False),
    ("Group cancelled the event", "Group sues over event", True),
    ("Man charged", "Man sentenced to jail", True),
    ("Man sentenced", "Man jailed after sentence", False),
    ("Bishop speaks", "Bishop speaks again", False),
])
def test_development(spark, a, b, want):
    rows = stages.facts(spark.createDataFrame([(a, b)], "a string, b string"), "a", r"\bto (vote|rule)\b", r"\bgranted\b|drops .*ban", r"\bbars?\b", r"\bsues?\b", {"charge": "charged", "sentence": "sentenc|jailed"}).withColumnRenamed("stage", "sa")
    rows = stages.facts(rows, "b", r"\bto (vote|rule)\b", r"\bgranted\b|drops .*ban", r"\bbars?\b", r"\bsues?\b", {"charge": "charged", "sentence": "sentenc|jailed"})
    assert rows.select(stages.is_development(F.col("sa"), F.col("stage")).alias("r")).first().r is want


def test_places(spark):
    table = [("UK", r"\b(british|birmingham|england)\b"), ("India", r"\bindia\b"), ("United States", r"\balabama\b")]
    rows = spark.createDataFrame([(1, "British pastor booked", "held in India", "x"), (2, "Birmingham council votes", "", "al.com"), (3, "Birmingham, England votes", "", "al.com"), (4, "Senate votes", "", "x"), (5, "Nothing here", "", "al.com"), (6, "Nothing here", None, "x")], "id long, h string, t string, o string")
    tier = F.when(F.col("o") == "al.com", "United States")
    got = {r.id: (r.tier, r.how) for r in places.placed(rows, "h", "t", tier, table, r"\bbritish (?=pastor)", r"\bbirmingham\b", [("United States", r"\bsenate\b")]).collect()}
    assert got == {1: ("India", "text"), 2: ("United States", "outlet"), 3: ("UK", "headline"), 4: ("United States", "headline"), 5: ("United States", "outlet"), 6: ("Unplaced", "none")}


def test_filters(spark):
    rows = spark.createDataFrame([(1, "The Daily Example of the Week", "The Daily Example of the Week"), (2, "A headline that is long enough to stay", "X"), (3, "short", "X"), (4, None, None)], "id long, t string, o string")
    assert [r.id for r in rows.where(~filters.junk_title(F.col("t"), F.col("o"))).collect()] == [2]
    hosts = spark.createDataFrame([("a.org",), ("x.a.org",), ("ba.org",), ("",)], "h string")
    assert [r.r for r in hosts.select(filters.on_domain(F.col("h"), ["a.org"]).alias("r")).collect()] == [True, True, False, False]
    pieces = spark.createDataFrame([("Opinion: x", "", "Times"), ("Man jailed", "", "Weekly View"), ("On walking", "", "Weekly View"), ("Man jailed", "", "Pure Argument")], "h string, t string, o string")
    assert [r.r for r in pieces.select(filters.comment_piece(F.col("h"), F.col("t"), F.col("o"), "^opinion", ["pure argument"], ["weekly view"], "jailed").alias("r")).collect()] == [True, False, True, True]
    relay = spark.createDataFrame([("Law Fund", "as reported by the Daily Paper today"), ("Law Fund", "according to the High Court"), ("Law Fund", "told Law Fund"), ("Daily Paper", "reported by the Other Paper")], "o string, s string")
    assert [r.r for r in relay.select(filters.relays(F.col("o"), F.col("s"), ["law fund"], "court").alias("r")).collect()] == [True, False, False, False]
    tags = spark.createDataFrame([(["video", "law"],), (["video", "podcast", "x"],), (["x", "y"],)], "t array<string>")
    assert [r.r for r in tags.select(filters.filler_tags(F.col("t"), "^law$", "video|podcast").alias("r")).collect()] == [False, True, False]


def test_sinks(spark, tmp_path):
    df = spark.range(3).withColumn("tier", F.when(F.col("id") > 0, 1)).withColumn("reason", F.lit(None).cast("string"))
    sinks.archive({"items": df}, str(tmp_path), "20240101")
    assert spark.read.parquet(f"{tmp_path}/items").where("edition = 20240101").count() == 3
    with pytest.raises(AnalysisException):
        sinks.archive({"items": df}, str(tmp_path), "20240101")
    row = sinks.manifest(df, df, df, "20240101").first()
    assert (row["items"], row["picked"], row["tiered"], row["leads_judged"], row["reasons_given"]) == (3, 3, 2, 3, 0)
    sinks.sheet(df, "%d", ["id"], ["id"], f"{tmp_path}/sheet")
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/sheet").collect()) == ["0", "1", "2"]
