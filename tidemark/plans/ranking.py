"""Queries over classification, scores, quotas, orders and evaluation."""

from functools import partial

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import classify, evaluate, learn, select
from tidemark.plans import base
from tidemark.plans.texts import HEADLINE_SQL

QUERIES: dict = {}
SQL: dict = {}
query = partial(base.register, QUERIES, SQL)

#: A vocabulary of words that stand in the corpus; a caller brings their own.
#: Word edges are spelt out: engines differ on what a boundary is next to an accent.
EDGE = "[^a-zA-ZÀ-ÖØ-öø-ÿ]"


def whole(words: str) -> str:
    return f"(^|{EDGE})({words})($|{EDGE})"


def opening(words: str) -> str:
    return f"(^|{EDGE})({words})"


VOCABULARY = {
    "Law": [(3, whole("thing|thly")), (2, opening("erth|reth")), (1, opening("nder"))],
    "Life": [(3, whole("leaux|ment")), (2, opening("aux|eux")), (1, opening("que"))],
    "Work": [(3, opening("schen|unge")), (2, opening("ver|ich")), (1, whole("der"))],
    "Church": [(1, whole("that")), (1, whole("with"))],
}
WEAKEST = "Church"
HARD = [("^licensed", "Law")]
RESIDUAL = [(whole("el|los"), "Other")]


def score_sql(section: str, text: str = "headline") -> str:
    return " + ".join(f"CASE WHEN regexp_matches({text}, '(?i){p}') THEN {w} ELSE 0 END" for w, p in VOCABULARY[section])


HINT_SQL = "CASE WHEN source IN ('src1', 'src2') THEN 'Law' WHEN source = 'src3' THEN 'Life' END"
SECTIONS = list(VOCABULARY)
SCORED_SQL = f"r AS (SELECT doc_id, source, n_chars, text, {HEADLINE_SQL} AS headline, {HINT_SQL} AS hinted FROM documents), raw AS (SELECT *, {', '.join(f'{score_sql(s)} AS p_{s}' for s in SECTIONS)} FROM r), sc AS (SELECT *, {', '.join(f'p_{s} + CASE WHEN p_{s} > 0 AND hinted = {chr(39)}{s}{chr(39)} THEN 4 ELSE 0 END AS s_{s}' for s in SECTIONS)} FROM raw)"
STRONG = [s for s in SECTIONS if s != WEAKEST]
BEST_SQL = f"greatest({', '.join(f's_{s}' for s in STRONG)})"
TOP_SQL = "CASE " + " ".join(f"WHEN s_{s} = {BEST_SQL} THEN '{s}'" for s in STRONG) + " END"
HARD_SQL = " ".join(f"WHEN regexp_matches(headline, '(?i){p}') THEN {{}}" for p, _ in HARD)
CLASSED_SQL = f"""{SCORED_SQL}, cl AS (SELECT *, CASE WHEN length(headline) < 25 THEN NULL {HARD_SQL.format("'Law'")} WHEN {BEST_SQL} >= 3 THEN {TOP_SQL} WHEN s_{WEAKEST} > 0 THEN '{WEAKEST}' WHEN {BEST_SQL} > 0 THEN {TOP_SQL} WHEN hinted IS NOT NULL THEN hinted WHEN regexp_matches(headline, '(?i){RESIDUAL[0][0]}') THEN '{RESIDUAL[0][1]}' END AS section,
coalesce(CASE WHEN length(headline) < 25 THEN 0 {HARD_SQL.format("6")} WHEN {BEST_SQL} >= 3 THEN {BEST_SQL} WHEN s_{WEAKEST} > 0 THEN s_{WEAKEST} WHEN {BEST_SQL} > 0 THEN {BEST_SQL} WHEN hinted IS NOT NULL THEN 1 ELSE 0 END, 0) AS score FROM sc)"""


def classed(spark, sf_dir):
    docs = base.table(spark, sf_dir, "documents").withColumn("headline", T.headline(F.col("text")))
    hinted = F.when(F.col("source").isin("src1", "src2"), "Law").when(F.col("source") == "src3", "Life")
    docs = docs.withColumn("hinted", hinted)
    return classify.classified(docs, F.col("headline"), VOCABULARY, WEAKEST, F.col("hinted"), vetoed=F.char_length("headline") < 25, hard=HARD, residual=RESIDUAL)


@query("section_scores", f"WITH {SCORED_SQL} SELECT doc_id, {', '.join(f's_{s} AS {s.lower()}' for s in SECTIONS)} FROM sc")
def section_scores(spark, sf_dir):
    """CLS-01."""
    return classed(spark, sf_dir).select("doc_id", *[F.col(f"s_{s}").alias(s.lower()) for s in SECTIONS])


@query("classify_documents", f"WITH {CLASSED_SQL} SELECT doc_id, section, score FROM cl")
def classify_documents(spark, sf_dir):
    """CLS-05."""
    return classed(spark, sf_dir).select("doc_id", "section", "score")


#: Importance from what the corpus offers: length as outcome, marks as process, a remainder as age, beyond four thirds of the window.
IMPORTANCE_SQL = f"""{CLASSED_SQL}, n AS (SELECT headline AS h, count(*) AS n FROM r GROUP BY 1),
im AS (SELECT cl.*, n, CAST(CASE WHEN n > 1 THEN least(7, CAST(round(3 * log2(n)) AS INTEGER)) ELSE 0 END + least(9, 3 * (doc_id % 4)) + CASE WHEN n_chars > 4000 THEN 8 WHEN contains(headline, ',') THEN 3 ELSE 0 END - CASE WHEN contains(headline, '|') THEN 2 ELSE 0 END + CASE WHEN n_chars > 10000 THEN 3 ELSE 0 END + CASE WHEN source IN ('src0', 'src5') THEN 4 ELSE 0 END + CASE WHEN source = 'src7' THEN 5 ELSE 0 END + least(6, score) + CASE WHEN doc_id % 60 <= 12 THEN 2 WHEN doc_id % 60 > 48 THEN -2 ELSE 0 END AS INTEGER) AS importance FROM cl JOIN n ON h = headline)"""


def important(spark, sf_dir):
    rows = classed(spark, sf_dir)
    same = rows.groupBy("headline").agg(F.count("*").alias("n"))
    rows = rows.join(same, "headline")
    no = F.lit(False)
    value = classify.importance(
        F.col("n"), F.col("doc_id") % 4, F.col("n_chars") > 4000, no, F.contains("headline", F.lit(",")), F.contains("headline", F.lit("|")), F.col("n_chars") > 10000,
        F.col("source").isin("src0", "src5"), F.col("source") == "src7", F.col("score"), F.col("doc_id") % 60, F.lit(36), no, no, no,
    )
    return rows.withColumn("importance", value.cast("int"))


@query("importance_rank", f"WITH {IMPORTANCE_SQL} SELECT doc_id, importance FROM im")
def importance_rank(spark, sf_dir):
    """CLS-09."""
    return important(spark, sf_dir).select("doc_id", "importance")


@query("sheet_top_k", f"WITH {IMPORTANCE_SQL} SELECT doc_id, section, importance FROM im WHERE section IS NOT NULL ORDER BY importance DESC, doc_id LIMIT 40")
def sheet_top_k(spark, sf_dir):
    """SRT-01, SRT-05: the head of the sheet."""
    return important(spark, sf_dir).where("section IS NOT NULL").orderBy(F.desc("importance"), "doc_id").limit(40).select("doc_id", "section", "importance")


@query("per_outlet_diversify", f"WITH {IMPORTANCE_SQL}, d AS (SELECT doc_id, importance, row_number() OVER (PARTITION BY section, lower(source) ORDER BY importance DESC, doc_id) AS k FROM im) SELECT doc_id, k <= 3 OR importance >= 20 AS head FROM d")
def per_outlet_diversify(spark, sf_dir):
    """WIN-01."""
    rows = important(spark, sf_dir)
    return select.diversified(rows, "section", "source", [F.desc("importance"), "doc_id"], 3, F.col("importance") >= 20).select("doc_id", "head")


REGION_SQL = "o AS (SELECT o_orderkey, o_orderstatus AS section, r_name AS tier, n_name AS country, c_mktsegment AS outlet, o_orderpriority AS prio, o_totalprice AS price FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def picked(spark, sf_dir):
    """Orders as picks: status as section, region as tier, nation as country, segment as outlet."""
    t = partial(base.table, spark, sf_dir)
    nations = t("nation").join(F.broadcast(t("region")), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("tier"), F.col("n_name").alias("country"))
    buyers = t("customer").join(F.broadcast(nations), "c_nationkey").select(F.col("c_custkey").alias("o_custkey"), "tier", "country", F.col("c_mktsegment").alias("outlet"))
    return t("orders").join(buyers, "o_custkey").select("o_orderkey", F.col("o_orderstatus").alias("section"), "tier", "country", "outlet", F.col("o_orderpriority").alias("prio"), F.col("o_totalprice").alias("price"))


@query("quota_share_cap", f"WITH {REGION_SQL}, s AS (SELECT section, greatest(1, floor(count(*) FILTER (tier <> 'AMERICA') * 0.1::DOUBLE / 0.9::DOUBLE)) AS lim FROM o GROUP BY 1), q AS (SELECT o.*, lim, sum(CASE WHEN tier = 'AMERICA' THEN 1 ELSE 0 END) OVER (PARTITION BY o.section ORDER BY price DESC, o_orderkey ROWS UNBOUNDED PRECEDING) AS used FROM o JOIN s ON s.section = o.section) SELECT o_orderkey, tier <> 'AMERICA' OR used <= lim OR prio = '1-URGENT' AS kept FROM q")
def quota_share_cap(spark, sf_dir):
    """WIN-02, MTH-02: a tenth for one region, so that the quota binds."""
    rows = picked(spark, sf_dir)
    inside = F.col("tier") == "AMERICA"
    limits = rows.groupBy("section").agg(select.allowance(F.count(F.when(~inside, 1)), 0.1).alias("lim"))
    rows = rows.join(F.broadcast(limits), "section")  # a row for each section
    return select.share_capped(rows, "section", inside, [F.desc("price"), "o_orderkey"], F.col("lim"), F.col("prio") == "1-URGENT").select("o_orderkey", "kept")


@query("section_cap", f"WITH {REGION_SQL}, d AS (SELECT o_orderkey, section, row_number() OVER (PARTITION BY section ORDER BY prio, o_orderkey) AS k FROM o) SELECT o_orderkey, k > CASE section WHEN 'F' THEN 400 ELSE 300 END AS cut FROM d")
def section_cap(spark, sf_dir):
    """WIN-03, WIN-04."""
    cap = F.when(F.col("section") == "F", 400).otherwise(300)
    return select.section_capped(picked(spark, sf_dir), "section", ["prio", "o_orderkey"], cap).select("o_orderkey", "cut")


@query("tier_order", "SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderpriority, o_orderkey) AS INTEGER) AS place FROM orders")
def tier_order(spark, sf_dir):
    """WIN-04, WIN-11."""
    rows = base.table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderpriority", "o_orderkey")
    return select.ranked(rows, ["o_orderstatus"], ["o_orderpriority", "o_orderkey"], "place").select("o_orderkey", "place")


PLACED_SQL = f"{REGION_SQL}, pl AS (SELECT *, row_number() OVER (PARTITION BY section ORDER BY price DESC, o_orderkey) AS pos FROM o)"


def positioned(spark, sf_dir):
    return select.ranked(picked(spark, sf_dir), ["section"], [F.desc("price"), "o_orderkey"], "pos")


@query("outlet_round_robin", f"WITH {PLACED_SQL}, m AS (SELECT *, min(pos) OVER (PARTITION BY section, tier) AS bl, row_number() OVER (PARTITION BY section, tier, outlet ORDER BY pos) AS tn, min(pos) OVER (PARTITION BY section, tier, outlet) AS fi FROM pl) SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY section ORDER BY bl, tn, fi) AS INTEGER) AS final FROM m")
def outlet_round_robin(spark, sf_dir):
    """WIN-05."""
    return select.round_robin(positioned(spark, sf_dir), "section", "tier", "outlet", "pos").select("o_orderkey", "final")


@query("region_order", f"WITH {PLACED_SQL}, m AS (SELECT *, min(pos) OVER (PARTITION BY section, tier, prio = '1-URGENT', country) AS fi FROM pl) SELECT o_orderkey, CAST(row_number() OVER (PARTITION BY section ORDER BY tier, (prio = '1-URGENT') DESC, fi, pos) AS INTEGER) AS final FROM m")
def region_order(spark, sf_dir):
    """WIN-06, CLS-07: urgent rows stand for those sure of their place."""
    rows = positioned(spark, sf_dir).withColumn("sure", F.col("prio") == "1-URGENT")
    return select.by_region(rows, "section", "tier", "sure", "country", "pos").select("o_orderkey", "final")


@query("country_grouping", f"WITH {REGION_SQL} SELECT section, tier, country, count(*) AS n, min(o_orderkey) AS first_order FROM o GROUP BY 1, 2, 3")
def country_grouping(spark, sf_dir):
    """CLS-07's groups."""
    return picked(spark, sf_dir).groupBy("section", "tier", "country").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_order"))


@query("review_slices", "WITH d AS (SELECT o_orderkey, o_orderstatus AS s, row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_orderkey) AS k, count(*) OVER (PARTITION BY o_orderstatus) AS n FROM orders) SELECT o_orderkey, CAST(floor((k - 1) / greatest(60, ceil(n / 6.0))) AS INTEGER) AS slice FROM d")
def review_slices(spark, sf_dir):
    """SNK-05, WIN-08."""
    return select.sliced(base.table(spark, sf_dir, "orders"), "o_orderstatus", ["o_orderkey"], 6).select("o_orderkey", "slice")


@query("last_editions", "SELECT event_id FROM events WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 7)")
def last_editions(spark, sf_dir):
    """WIN-12."""
    rows = base.table(spark, sf_dir, "events").withColumn("edition", F.col("ts").cast("date"))
    return select.last_editions(rows, "edition", 7).select("event_id")


@query("array_overlap_lookup", """WITH a AS (SELECT c_custkey, list(DISTINCT o_orderpriority) AS areas FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY 1), b AS (SELECT r_regionkey, CASE r_regionkey WHEN 0 THEN ['1-URGENT', '2-HIGH'] WHEN 1 THEN ['3-MEDIUM'] ELSE ['5-LOW'] END AS areas FROM region)
SELECT c_custkey, r_regionkey, CAST(len(list_intersect(a.areas, b.areas)) AS INTEGER) AS shared FROM a JOIN b ON list_has_any(a.areas, b.areas)""")
def array_overlap_lookup(spark, sf_dir):
    """JON-13: rows that share areas, as an equi-join on exploded areas."""
    orders = base.table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), F.col("o_orderpriority").alias("area")).distinct()
    buyers = base.table(spark, sf_dir, "customer").select("c_custkey")
    areas = F.when(F.col("r_regionkey") == 0, F.array(F.lit("1-URGENT"), F.lit("2-HIGH"))).when(F.col("r_regionkey") == 1, F.array(F.lit("3-MEDIUM"))).otherwise(F.array(F.lit("5-LOW")))
    desks = base.table(spark, sf_dir, "region").select("r_regionkey", F.explode(areas).alias("area"))
    return orders.join(buyers, "c_custkey").join(F.broadcast(desks), "area").groupBy("c_custkey", "r_regionkey").agg(F.count("*").cast("int").alias("shared"))


@query("top_candidates", "SELECT o_custkey, o_orderkey, CAST(k AS INTEGER) AS k FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderdate, o_orderkey) AS k FROM orders) WHERE k <= 8")
def top_candidates(spark, sf_dir):
    """SRT-06."""
    rank = F.row_number().over(select.Window.partitionBy("o_custkey").orderBy(F.desc("o_totalprice"), "o_orderdate", "o_orderkey"))
    return base.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", rank.alias("k")).where("k <= 8")


JUDGED_SQL = "j AS (SELECT doc_id, doc_id % 5 AS edition, quality * 2 + toxic AS label, CAST(n_chars // 200 AS INTEGER) AS score FROM documents JOIN labels USING (doc_id))"


def judged(spark, sf_dir):
    docs = base.table(spark, sf_dir, "documents").join(base.table(spark, sf_dir, "labels"), "doc_id")
    return docs.select("doc_id", (F.col("doc_id") % 5).alias("edition"), (F.col("quality") * 2 + F.col("toxic")).alias("label"), F.floor(F.col("n_chars") / 200).cast("int").alias("score"))


@query("concordance", f"WITH {JUDGED_SQL} SELECT a.edition, round(sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END)::DOUBLE / count(*), 9) AS concordance, count(*) AS pairs FROM j a JOIN j b ON a.edition = b.edition AND a.label > b.label GROUP BY 1")
def concordance(spark, sf_dir):
    """AGG-14, JON-19, EVL-01: without making the pairs."""
    return evaluate.concordance(judged(spark, sf_dir), "edition", "label", "score").select("edition", F.round("concordance", 9).alias("concordance"), "pairs")


@query("precision_at_k", f"WITH {JUDGED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY edition ORDER BY score DESC, doc_id) AS k FROM j) SELECT edition, round(avg(CAST(label >= 2 AS INTEGER))::DOUBLE, 9) AS precision FROM r WHERE k <= 40 GROUP BY 1")
def precision_at_k(spark, sf_dir):
    """AGG-14."""
    rows = judged(spark, sf_dir).withColumn("hit", F.col("label") >= 2)
    return evaluate.precision_at(rows, "edition", [F.desc("score"), "doc_id"], "hit").select("edition", F.round("precision", 9).alias("precision"))


@query("tier1_recall", f"WITH {JUDGED_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY edition ORDER BY score DESC, doc_id) AS k, count(*) OVER (PARTITION BY edition) AS n FROM j) SELECT edition, round(CAST(count(*) FILTER (label >= 2 AND k <= floor(n / 10)) AS DOUBLE) / count(*) FILTER (label >= 2), 9) AS recall FROM r GROUP BY 1")
def tier1_recall(spark, sf_dir):
    """AGG-14."""
    rows = judged(spark, sf_dir).withColumn("hit", F.col("label") >= 2)
    return evaluate.recall_in_top(rows, "edition", [F.desc("score"), "doc_id"], "hit").select("edition", F.round("recall", 9).alias("recall"))


@query("matcher_pr", "WITH p AS (SELECT n_chars > 1500 AS said, quality = 1 AS t FROM documents JOIN labels USING (doc_id)), c AS (SELECT count(*) FILTER (said AND t) AS tp, count(*) FILTER (said AND NOT t) AS fp, count(*) FILTER (NOT said AND t) AS fn, count(*) FILTER (NOT said AND NOT t) AS tn FROM p) SELECT *, round(tp / (tp + fn), 9) AS recall, round(fp / (fp + tn), 9) AS fpr, round(tp / (tp + fp), 9) AS precision, round(2 * tp / (2 * tp + fp + fn), 9) AS f1 FROM c")
def matcher_pr(spark, sf_dir):
    """AGG-15, AGG-17, EVL-02."""
    docs = base.table(spark, sf_dir, "documents").join(base.table(spark, sf_dir, "labels"), "doc_id")
    out = evaluate.matcher(docs.select((F.col("n_chars") > 1500).alias("said"), (F.col("quality") == 1).alias("t")), "said", "t")
    return out.select("tp", "fp", "fn", "tn", *[F.round(c, 9).alias(c) for c in ("recall", "fpr", "precision", "f1")])


@query("collision_counts", "SELECT a.event_type AS x, b.event_type AS y, count(*) AS n FROM (SELECT DISTINCT user_id, event_type FROM events) a JOIN (SELECT DISTINCT user_id, event_type FROM events) b ON a.user_id = b.user_id AND a.event_type < b.event_type GROUP BY 1, 2 ORDER BY n DESC, x, y LIMIT 20")
def collision_counts(spark, sf_dir):
    """AGG-16."""
    kinds = base.table(spark, sf_dir, "events").select("user_id", "event_type").distinct()
    a, b = kinds.select("user_id", F.col("event_type").alias("x")), kinds.select("user_id", F.col("event_type").alias("y"))
    return a.join(b, "user_id").where("x < y").groupBy("x", "y").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "x", "y").limit(20)


@query("route_coverage", "SELECT role, count(*) AS n, round(CAST(100.0 * count(*) / (SELECT count(*) FROM conversations) AS DOUBLE), 6) AS share FROM conversations GROUP BY role")
def route_coverage(spark, sf_dir):
    """AGG-07, AGG-12, AGG-13."""
    rows = base.table(spark, sf_dir, "conversations")
    n = rows.groupBy().agg(F.count("*").alias("n")).scalar()
    return rows.groupBy("role").agg(F.count("*").alias("n")).select("role", "n", F.round(F.lit(100.0) * F.col("n") / n, 6).alias("share"))


@query("sibling_texts", "SELECT conv_id, arg_min(text, turn) AS text FROM conversations WHERE length(text) >= 80 GROUP BY conv_id")
def sibling_texts(spark, sf_dir):
    """JON-14: the first readable member of each cluster."""
    return base.table(spark, sf_dir, "conversations").where(F.char_length("text") >= 80).groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))


@query("suppression_list", f"""SELECT doc_id, CASE WHEN contains(lower(text), 'all rights reserved') THEN 'furniture' WHEN n_chars < 60 THEN 'short' WHEN regexp_matches({HEADLINE_SQL}, '(?i){opening('erth|reth')}') AND NOT regexp_matches({HEADLINE_SQL}, '(?i){whole('that')}') THEN 'filler' END AS reason FROM documents""")
def suppression_list(spark, sf_dir):
    """FLT-09: an ordered list of rules, a rescue inside one; desk.chaff_reasons has FLT-10 and FLT-11 whole."""
    docs = base.table(spark, sf_dir, "documents").withColumn("headline", T.headline(F.col("text")))
    rules = [("furniture", F.contains(F.lower("text"), F.lit("all rights reserved"))), ("short", F.col("n_chars") < 60), ("filler", classify.matches(F.col("headline"), opening("erth|reth")) & ~classify.matches(F.col("headline"), whole("that")))]
    return docs.select("doc_id", classify.suppressed(rules).alias("reason"))


@query("text_signals", f"""SELECT doc_id, CASE WHEN length(text) < 80 THEN NULL WHEN len(regexp_extract_all(text, '(?i){whole('that')}')) > len(regexp_extract_all(text, '(?i){whole('with')}')) THEN 'comment' ELSE 'report' END AS kind FROM documents""")
def text_signals(spark, sf_dir):
    """CLS-08: unknown where the text is short."""
    docs = base.table(spark, sf_dir, "documents").withColumn("headline", T.headline(F.col("text")))
    found = classify.signals(F.col("headline"), F.col("text"), whole("that"), whole("with"), "licen[cs]e")
    return docs.select("doc_id", found["kind"].alias("kind"))


@query("tier_model_lr")
def tier_model_lr(spark, sf_dir):
    """ML-01 to ML-03: no SQL; a model trained without each of two folds, counted by label and prediction."""
    docs = base.table(spark, sf_dir, "documents").join(base.table(spark, sf_dir, "labels"), "doc_id")
    rows = docs.select(T.headline(F.col("text"), 400).alias("headline"), F.col("quality").cast("double").alias("label"), (F.col("doc_id") % 2).alias("edition"))
    said = learn.left_out(rows, "edition", [0, 1])
    return said.groupBy("edition", "label", "prediction").agg(F.count("*").alias("n"))
