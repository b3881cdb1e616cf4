"""Queries over leads, suppression, credit, links and the small rules around them.

A headline is the first 150 characters of a document, as in the other query modules.
"""

from functools import partial

from pyspark.sql import functions as F

from tidemark.functions import mastheads
from tidemark.functions import text as T
from tidemark.operators import desk
from tidemark.plans import base
from tidemark.plans.ranking import CLASSED_SQL, classed, opening, whole
from tidemark.plans.texts import HEADLINE_SQL

QUERIES: dict = {}
SQL: dict = {}
query = partial(base.register, QUERIES, SQL)


def headlines(spark, sf_dir):
    return base.table(spark, sf_dir, "documents").withColumn("headline", T.headline(F.col("text")))


TITLE_SQL = f"""substr({HEADLINE_SQL}, 1, 60) || CASE doc_id % 6 WHEN 0 THEN ' - Src Daily' WHEN 1 THEN ' | the old news' WHEN 2 THEN ' – Press One · ' || source WHEN 3 THEN ' - ' || source WHEN 4 THEN ' - live updates - BBC' ELSE '' END"""


@query("masthead_titles", f"WITH titles AS (SELECT doc_id AS id, {TITLE_SQL} AS title, CASE WHEN doc_id % 2 = 0 THEN source END AS source FROM documents), {', '.join(mastheads.stripped_sql('title', 'source'))} SELECT id AS doc_id, title, name FROM cut3")
def masthead_titles(spark, sf_dir):
    """STR-05: titles with names behind them, some stacked."""
    behind = F.when(F.col("doc_id") % 6 == 0, " - Src Daily").when(F.col("doc_id") % 6 == 1, " | the old news").when(F.col("doc_id") % 6 == 2, F.concat(F.lit(" – Press One · "), F.col("source")))
    behind = behind.when(F.col("doc_id") % 6 == 3, F.concat(F.lit(" - "), F.col("source"))).when(F.col("doc_id") % 6 == 4, " - live updates - BBC").otherwise("")
    rows = headlines(spark, sf_dir).select("doc_id", F.concat(F.substring("headline", 1, 60), behind).alias("title"), F.when(F.col("doc_id") % 2 == 0, F.col("source")).alias("source"))
    return mastheads.stripped(rows, "title", "source").select("doc_id", "title", "name")


ALIASES = {"src daily": "Source Daily", "Source Daily": "Daily", "a | b": "Ab", "round": "about", "about": "round"}
HOSTS = {"example.net": "src daily", "example.org": "Org"}
RAW = ("src daily", " a|b ", "https://www.example.net", "Wire - RSS", "Other –", "news.example.org", "Example.ORG", "round")


@query("outlet_names", f"""WITH raw AS (SELECT page_id, ([{base.quoted(RAW)}])[page_id % 8 + 1] AS name FROM pages),
spaced AS (SELECT page_id, regexp_replace(trim(name), '\\s*\\|\\s*', ' | ', 'g') AS name FROM raw),
known AS (SELECT page_id, CASE name WHEN 'src daily' THEN 'Daily' WHEN 'Source Daily' THEN 'Daily' WHEN 'a | b' THEN 'Ab' WHEN 'round' THEN 'round' WHEN 'about' THEN 'about' ELSE name END AS name FROM spaced),
plain AS (SELECT page_id, trim(regexp_replace(name, '\\s*[|:-]\\s*(RSS|News Feed|Feed)\\s*$', '')) AS name FROM known),
hosted AS (SELECT page_id, CASE regexp_replace(lower(name), '^(https?://)?(www\\.)?', '') WHEN 'example.net' THEN 'Daily' WHEN 'example.org' THEN 'Org' ELSE name END AS name FROM plain)
SELECT page_id, trim(regexp_replace(name, '\\s*[|–—:-]\\s*$', '')) AS outlet FROM hosted""")
def outlet_names(spark, sf_dir):
    """STR-19: aliases to their end, hosts by name."""
    raw = F.get(F.array(*[F.lit(x) for x in RAW]), (F.col("page_id") % 8).cast("int"))
    return base.table(spark, sf_dir, "pages").select("page_id", desk.tidy_outlet(raw, ALIASES, HOSTS).alias("outlet"))


@query("credit_lines", """SELECT doc_id, '- ' || CASE WHEN doc_id % 10 = 0 THEN 'Mirror' ELSE source END || CASE WHEN n_chars > 2000 AND doc_id % 10 <> 0 THEN ' (£)' ELSE '' END
|| CASE WHEN doc_id % 3 = 0 AND doc_id % 5 IN (0, 3) AND NOT (doc_id % 5 = 0 AND CASE WHEN doc_id % 10 = 0 THEN 'Mirror' ELSE source END = 'src1') THEN ' | ' || CASE doc_id % 5 WHEN 0 THEN 'SRC1' ELSE 'Ann Bee' END ELSE '' END AS credit FROM documents""")
def credit_lines(spark, sf_dir):
    """STR-20: publisher before feed, paywall mark, authors of comment."""
    by = F.when(F.col("doc_id") % 5 == 0, "SRC1").when(F.col("doc_id") % 5 == 1, "desk@example.org").when(F.col("doc_id") % 5 == 2, "Staff").when(F.col("doc_id") % 5 == 3, " Ann Bee ")
    line = desk.credit(F.col("source"), F.when(F.col("doc_id") % 10 == 0, "Mirror"), F.col("n_chars") > 2000, by, F.col("doc_id") % 3 == 0, ("staff",))
    return base.table(spark, sf_dir, "documents").select("doc_id", line.alias("credit"))


@query("byline_overrides", f"SELECT doc_id, CASE WHEN contains(lower({HEADLINE_SQL}), 'tion the') THEN 'First' WHEN contains(lower({HEADLINE_SQL}), 'aux') THEN 'Second' WHEN contains(lower({HEADLINE_SQL}), 'tion') THEN 'Third' END AS author FROM documents")
def byline_overrides(spark, sf_dir):
    """JON-11, SRC-20: the first override whose part stands in the text."""
    return desk.overridden(headlines(spark, sf_dir), F.col("headline"), [("tion the", "First"), ("AUX", "Second"), ("tion", "Third")], "author").select("doc_id", "author")


@query("override_lines", "SELECT lower(n_name) AS part, CAST(n_regionkey AS VARCHAR) AS value FROM nation WHERE n_nationkey % 4 <> 0")
def override_lines(spark, sf_dir):
    """SRC-20: "part | value" lines; notes and blank lines fall out."""
    lines = base.table(spark, sf_dir, "nation").select(F.when(F.col("n_nationkey") % 8 == 0, "# note | none").when(F.col("n_nationkey") % 4 == 0, "  ").otherwise(F.concat(F.lit(" "), "n_name", F.lit(" |  "), F.col("n_regionkey").cast("string"))).alias("value"))
    cut = F.split("value", r"\|", 2)
    return lines.where(~F.rlike("value", F.lit(r"^\s*(#|$)"))).select(F.lower(F.trim(F.get(cut, F.lit(0)))).alias("part"), F.trim(F.get(cut, F.lit(1))).alias("value"))


@query("rank_scores", "SELECT event_id, CAST(floor(value) AS INTEGER) + CASE WHEN user_id % 7 = 0 THEN 6 ELSE 0 END + CASE WHEN event_type = 'purchase' THEN 3 ELSE 0 END AS rank FROM events")
def rank_scores(spark, sf_dir):
    """CLS-10."""
    return base.table(spark, sf_dir, "events").select("event_id", desk.rank_score(F.floor("value").cast("int"), F.col("user_id") % 7 == 0, F.col("event_type") == "purchase").alias("rank"))


@query("cluster_leads", """WITH e AS (SELECT user_id * 1000 + day(ts) AS cluster, event_id AS id, event_type = 'error' AS relay, event_type = 'view' AS unreadable, value, event_type = 'signup' AS own, CASE WHEN event_id % 11 <> 0 THEN ts END AS issued FROM events),
best AS (SELECT cluster, id FROM e QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY relay, unreadable, value DESC, id) = 1),
firsts AS (SELECT * FROM e x WHERE own AND issued IS NOT NULL AND EXISTS (SELECT 1 FROM e o WHERE o.cluster = x.cluster AND NOT o.own) AND NOT EXISTS (SELECT 1 FROM e o WHERE o.cluster = x.cluster AND NOT o.own AND (o.issued IS NULL OR o.issued < x.issued))),
early AS (SELECT cluster, id FROM firsts QUALIFY row_number() OVER (PARTITION BY cluster ORDER BY issued, value DESC, id) = 1)
SELECT best.cluster, coalesce(early.id, best.id) AS lead, early.id IS NOT NULL AS issuing FROM best LEFT JOIN early ON early.cluster = best.cluster""")
def cluster_leads(spark, sf_dir):
    """CLS-11, SRT-07: a user's day as the cluster, sign-ups as primary sources, errors as relays."""
    rows = base.table(spark, sf_dir, "events").withColumn("cluster", F.col("user_id") * 1000 + F.dayofmonth("ts"))
    kind = F.col("event_type")
    return desk.cluster_leads(rows, "cluster", "event_id", kind == "error", kind == "view", F.col("value"), F.when(F.col("event_id") % 11 != 0, F.col("ts")), kind == "signup")


@query("cluster_marks", """WITH m AS (SELECT conv_id AS cluster, conv_id * 1000 + turn AS id, length(text) AS size, role = 'user' AS comment, turn % 4 = 0 AS followed FROM conversations),
r AS (SELECT *, count(*) OVER (PARTITION BY cluster) AS n, first_value(id) OVER (PARTITION BY cluster ORDER BY comment, size DESC, id) AS lead FROM m)
SELECT id, lead, CASE WHEN id = lead THEN 'lead' WHEN comment AND followed THEN 'also' ELSE 'duplicate' END AS mark FROM r WHERE n > 1""")
def cluster_marks(spark, sf_dir):
    """CLU-04's marks on given clusters: questions as comment, length as importance."""
    rows = base.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("cluster"), (F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.char_length("text").alias("size"), (F.col("role") == "user").alias("comment"), (F.col("turn") % 4 == 0).alias("followed"))
    return desk.cluster_marks(rows, "size", "comment", "followed")


#: Words of the test corpus stand for a desk's own; outlets are sources.
WORDS = {
    "excluded": opening("licensed"), "index": "^the and", "blocked": "^src9$", "spam": whole("xxx|schen"), "sports outlets": "^src8$", "gossip": whole("aux|eux"), "civic": whole("que|de"),
    "entertainment desks": "^src7$", "organisation": whole("ment"), "brand": whole("thly"), "rescue": whole("the"), "collision": opening("er"), "person": opening("on"), "school sport": opening("ver"),
    "regional marriage": opening("ich"), "roundup": r"\|", "celebrity outlets": "^src6$", "celebrity kept": whole("la|der"), "hard": whole("los"), "filler": opening("re"), "filler rescue": whole("that|with"),
    "issue": whole("and"), "road": opening("ther"), "incident": opening("in"), "education": whole("of"), "routine": opening("th"), "school": opening("an"), "school crime": opening("at"),
}


def has(name: str, column: str = "headline") -> str:
    return f"regexp_matches({column}, '(?i){WORDS[name]}')"


CHAFF_SQL = f"""CASE WHEN {has('excluded')} THEN 'excluded' WHEN {has('index')} THEN 'index' WHEN {has('blocked', 'source')} THEN 'blocked' WHEN {has('spam')} THEN 'spam' WHEN {has('sports outlets', 'source')} THEN 'sport outlet'
WHEN {has('gossip')} AND NOT {has('civic')} THEN 'gossip' WHEN {has('entertainment desks', 'source')} AND NOT {has('civic')} THEN 'entertainment'
WHEN NOT {has('organisation')} AND ({has('brand')} OR (NOT {has('rescue')} AND {has('collision')} AND {has('person')})) THEN 'collision'
WHEN {has('school sport')} AND NOT {has('rescue')} THEN 'school sport' WHEN {has('regional marriage')} AND NOT {has('civic')} THEN 'regional marriage' WHEN lang = 'xx' OR doc_id % 50 = 7 THEN 'filler tag' WHEN {has('roundup')} THEN 'roundup'
WHEN {has('celebrity outlets', 'source')} THEN CASE WHEN NOT {has('celebrity kept')} THEN 'celebrity outlet' END WHEN {has('hard')} THEN 'hard' WHEN {has('filler')} AND NOT {has('filler rescue')} THEN 'filler' END"""


def judged(spark, sf_dir):
    rows = classed(spark, sf_dir)
    return rows.withColumn("reason", desk.suppression(F.col("headline"), F.col("source"), (F.col("lang") == "xx") | (F.col("doc_id") % 50 == 7), WORDS))


@query("chaff_reasons", f"SELECT doc_id, {CHAFF_SQL} AS reason FROM (SELECT doc_id, lang, source, {HEADLINE_SQL} AS headline FROM documents)")
def chaff_reasons(spark, sf_dir):
    """FLT-10, FLT-11: fifteen steps in order."""
    rows = headlines(spark, sf_dir)
    return rows.select("doc_id", desk.suppression(F.col("headline"), F.col("source"), (F.col("lang") == "xx") | (F.col("doc_id") % 50 == 7), WORDS).alias("reason"))


@query("incident_rules", f"""WITH {CLASSED_SQL} SELECT doc_id, NOT (coalesce(section IN ('Other'), false) OR {has('issue')}) AND ({has('road')} OR (score <= 2 AND {has('incident')})) AS incident,
CASE WHEN {has('education')} THEN NULL WHEN score <= 4 AND {has('routine')} THEN 'routine' WHEN score <= 3 AND {has('school')} AND {has('school crime')} THEN 'crime' END AS school FROM cl""")
def incident_rules(spark, sf_dir):
    """FLT-12, FLT-13."""
    rows = classed(spark, sf_dir)
    return rows.select("doc_id", desk.local_incident(F.col("headline"), F.col("section"), F.col("score"), WORDS, ("Other",)).alias("incident"), desk.school_matter(F.col("headline"), F.col("score"), WORDS).alias("school"))


@query("section_reach", f"WITH {CLASSED_SQL}, l AS (SELECT doc_id, lang FROM documents) SELECT cl.doc_id, source <> 'src5' AND ({CHAFF_SQL.replace('doc_id', 'cl.doc_id')}) IS NULL AND section IS NOT NULL AS reaches FROM cl JOIN l ON l.doc_id = cl.doc_id")
def section_reach(spark, sf_dir):
    """FLT-15."""
    return judged(spark, sf_dir).select("doc_id", desk.reaches(F.col("source") == "src5", F.col("reason"), F.col("section")).alias("reaches"))


@query("outlet_flags", f"""SELECT doc_id, regexp_matches(source, '(?i)^src[12]$') OR contains({HEADLINE_SQL}, '|') OR lang = 'fr' AS commentary, regexp_matches({HEADLINE_SQL}, '(?i){whole('die|der')}') OR source IN ('src3', 'src4') AS small_market FROM documents""")
def outlet_flags(spark, sf_dir):
    """FLT-18, FLT-20: link, outlet or page section; headline or outlet."""
    rows = headlines(spark, sf_dir)
    comment = F.contains("headline", F.lit("|")) | desk.matches(F.col("source"), "^src[12]$") | (F.col("lang") == "fr")
    return rows.select("doc_id", comment.alias("commentary"), (desk.matches(F.col("headline"), whole("die|der")) | F.col("source").isin("src3", "src4")).alias("small_market"))


LINK_SQL = "CASE page_id % 8 WHEN 0 THEN url || '?' WHEN 1 THEN regexp_replace(url, '[?#].*$', '') || '?id' WHEN 2 THEN 'https://' || page_id || '/a' WHEN 3 THEN regexp_replace(url, '^([a-z]+://[^/?#]*).*$', '\\1') WHEN 4 THEN regexp_replace(url, '[?#].*$', '') || '/tags/x' WHEN 5 THEN regexp_replace(url, '[?#].*$', '') || '?a=b&Page=3' ELSE url END"


@query("link_shapes", f"""WITH l AS (SELECT page_id, {LINK_SQL} AS u FROM pages), p AS (SELECT *, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1) AS host, regexp_extract(u, '\\?([^#]*)', 1) AS q, regexp_extract(regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*', ''), '^[^?#]*') AS path FROM l)
SELECT page_id, NOT contains(host, '.') OR regexp_matches(u, '[?&=]$') OR len(list_filter(string_split(q, '&'), lambda kv: kv <> '' AND NOT contains(kv, '='))) > 0 AS truncated,
path IN ('', '/') OR regexp_matches(path, '{desk.INDEX_PATH}') OR regexp_matches(q, '{desk.PAGE_PARAMETER}') AS listing FROM p""")
def link_shapes(spark, sf_dir):
    """STR-28: links that lost their end, and links to listings."""
    n, bare = F.col("page_id") % 8, F.regexp_replace("url", "[?#].*$", "")
    link = F.when(n == 0, F.concat("url", F.lit("?"))).when(n == 1, F.concat(bare, F.lit("?id"))).when(n == 2, F.concat(F.lit("https://"), F.col("page_id").cast("string"), F.lit("/a"))).when(n == 3, F.regexp_replace("url", "^([a-z]+://[^/?#]*).*$", "$1"))
    link = link.when(n == 4, F.concat(bare, F.lit("/tags/x"))).when(n == 5, F.concat(bare, F.lit("?a=b&Page=3"))).otherwise(F.col("url"))
    rows = base.table(spark, sf_dir, "pages").select("page_id", link.alias("u"))
    return rows.select("page_id", desk.truncated(F.col("u")).alias("truncated"), desk.lists_others(F.col("u")).alias("listing"))


@query("text_flags", """SELECT doc_id, CASE WHEN n_chars < 80 THEN '' ELSE CASE WHEN doc_id % 3 = 0 THEN 'comment' ELSE 'report' END || CASE WHEN doc_id % 4 = 0 THEN ' doc' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN ' update' ELSE '' END || ' ' || CASE WHEN lang = 'en' THEN 'en/' || source WHEN lang = 'de' THEN lang ELSE 'unplaced' END END AS flags FROM documents""")
def text_flags(spark, sf_dir):
    """STR-31."""
    kind = F.when(F.col("n_chars") >= 80, F.when(F.col("doc_id") % 3 == 0, "comment").otherwise("report"))
    places = F.when(F.col("lang") == "en", F.array("lang", "source", F.lit("third"))).when(F.col("lang") == "de", F.array("lang")).otherwise(F.array().cast("array<string>"))
    return base.table(spark, sf_dir, "documents").select("doc_id", desk.display(kind, F.col("doc_id") % 4 == 0, F.col("doc_id") % 5 == 0, places).alias("flags"))


@query("text_routes", """WITH t AS (SELECT conv_id, max(CASE WHEN turn = 2 THEN text END) AS opening, max(CASE WHEN turn = 1 THEN text END) AS summary, max(CASE WHEN turn = 0 THEN text END) AS lede, count(*) AS n FROM conversations GROUP BY conv_id)
SELECT conv_id, substr(coalesce(nullif(opening, ''), nullif(summary, ''), nullif(lede, ''), ''), 1, 600) AS text, CASE WHEN coalesce(opening, '') <> '' THEN 'text' WHEN coalesce(summary, '') <> '' THEN 'feed' WHEN coalesce(lede, '') <> '' THEN 'page' END AS route, CASE WHEN conv_id % 4 = 0 OR n >= 3 THEN 600 ELSE 200 END AS depth FROM t""")
def text_routes(spark, sf_dir):
    """STR-17, CLS-15: the first text there is, its route, and how much of it is shown."""
    turn = lambda k: F.max(F.when(F.col("turn") == k, F.col("text")))
    rows = base.table(spark, sf_dir, "conversations").groupBy("conv_id").agg(turn(2).alias("opening"), turn(1).alias("summary"), turn(0).alias("lede"), F.count("*").alias("n"))
    first = F.coalesce(*[F.when(F.col(c) != "", F.col(c)) for c in ("opening", "summary", "lede")], F.lit(""))
    region = F.when(F.col("conv_id") % 4 == 0, "UK").otherwise("World")
    return rows.select("conv_id", F.substring(first, 1, 600).alias("text"), desk.text_route({"text": F.col("opening"), "feed": F.col("summary"), "page": F.col("lede")}).alias("route"), desk.text_depth(region, F.lit(1), F.col("n"), F.lit(False), 600, 200).alias("depth"))


@query("bill_names", """SELECT p_partkey, lower(trim(regexp_replace(p_name, '\\s+', ' ', 'g'))) AS core, contains(lower(trim(p_name)), ' ') AS named FROM part""")
def bill_names(spark, sf_dir):
    """STR-32, FLT-24: parts as bills; what is added to their names comes off again."""
    k = F.col("p_partkey") % 4
    name = F.concat("p_name", F.when(k == 0, " Bill [HL]").when(k == 1, " Act 2024").when(k == 2, " Regulations (draft) - New Clause 1").otherwise(""))
    core = desk.bill_core(name)
    return base.table(spark, sf_dir, "part").select("p_partkey", core.alias("core"), desk.named(core, F.concat(F.lit("the "), "p_name", F.lit(" act"))).alias("named"))


@query("release_topics", f"""WITH d AS (SELECT doc_id, trim(regexp_replace({HEADLINE_SQL}, '\\s+', ' ', 'g')) AS t FROM documents)
SELECT doc_id, CASE WHEN t = '' OR regexp_matches(t, '(?i)^licensed') THEN '' ELSE array_to_string(list_distinct(list_filter([CASE WHEN regexp_matches(t, '(?i)the') AND NOT regexp_matches(t, '(?i)aux') THEN 'a' END, CASE WHEN regexp_matches(t, '(?i)que') THEN 'b' END, CASE WHEN regexp_matches(t, 'The') THEN 'c' END], lambda x: x IS NOT NULL)).list_sort(), ',') END AS topics,
CASE WHEN regexp_matches(t, '(?i){whole('der|die')}') THEN 'First' WHEN regexp_matches(t, '(?i){whole('la|de')}') THEN 'Second' ELSE 'Other' END AS split FROM d""")
def release_topics(spark, sf_dir):
    """CLS-14 and CLS-04: labels of a title, and the ordered split of a residual section."""
    rows = headlines(spark, sf_dir).withColumn("t", F.trim(F.regexp_replace("headline", r"\s+", " ")))
    labels = desk.topics(F.col("t"), "^licensed", [("a", "the", "aux"), ("b", "que", None)], [("c", "The")])
    split = F.when(desk.matches(F.col("t"), whole("der|die")), "First").when(desk.matches(F.col("t"), whole("la|de")), "Second").otherwise("Other")
    return rows.select("doc_id", F.array_join(F.array_sort(labels), ",").alias("topics"), split.alias("split"))


@query("outside_own_window", "SELECT event_id FROM events WHERE date_diff('second', ts, TIMESTAMP '2024-01-31 00:00:00') / 3600.0 > greatest(CASE WHEN event_type = 'error' THEN 600 ELSE 36 END, 500) + 1")
def outside_own_window(spark, sf_dir):
    """FLT-22, STM-02: rows older than their own source's window and the sweep's."""
    age = (F.unix_timestamp(F.lit("2024-01-31 00:00:00").cast("timestamp")) - F.unix_timestamp("ts")) / 3600.0
    rows = base.table(spark, sf_dir, "events").select("event_id", age.alias("age"), F.when(F.col("event_type") == "error", 600.0).otherwise(36.0).alias("own"))
    return desk.outside_window(rows, "age", "own", 500).select("event_id")


@query("sweep_health", "SELECT CAST(ts AS DATE) AS day, CASE WHEN count(*) FILTER (event_type <> 'error') < 60 THEN 'too few candidates' WHEN count(*) FILTER (event_type = 'error') > 40 THEN 'too many failed feeds' ELSE 'ok' END AS verdict FROM events GROUP BY 1")
def sweep_health(spark, sf_dir):
    """FLT-26."""
    failed = F.col("event_type") == "error"
    days = base.table(spark, sf_dir, "events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.when(~failed, 1)).alias("n"), F.count(F.when(failed, 1)).alias("bad"))
    return days.select("day", desk.healthy(F.col("n"), F.col("bad")).alias("verdict"))


@query("edition_rows", "SELECT o.o_orderkey, o.o_custkey, l.l_partkey FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey JOIN part p ON p.p_partkey = l.l_partkey WHERE l.l_linenumber = 1 AND p.p_size < 10")
def edition_rows(spark, sf_dir):
    """JON-09: picks with their items and what was composed of them."""
    t = partial(base.table, spark, sf_dir)
    composed = t("part").where("p_size < 10").select(F.col("p_partkey").alias("l_partkey"))
    items = t("lineitem").where("l_linenumber = 1").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    return t("orders").select("o_orderkey", "o_custkey").join(items, "o_orderkey").join(composed, "l_partkey").select("o_orderkey", "o_custkey", "l_partkey")


@query("unpublished_picks", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')")
def unpublished_picks(spark, sf_dir):
    """JON-10: picks that no edition has."""
    t = partial(base.table, spark, sf_dir)
    out = t("lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
    return t("orders").select("o_orderkey").join(out, "o_orderkey", "left_anti")


@query("cut_keys", "WITH done AS (SELECT l_partkey AS k FROM lineitem WHERE l_quantity > 45 UNION SELECT p_partkey FROM part WHERE p_size > 40) SELECT l_partkey AS k FROM lineitem WHERE l_quantity < 3 EXCEPT SELECT k FROM done")
def cut_keys(spark, sf_dir):
    """SET-01, SET-02: what was cut, without the union of what was published."""
    t = partial(base.table, spark, sf_dir)
    done = t("lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("k")).union(t("part").where("p_size > 40").select("p_partkey"))
    return t("lineitem").where("l_quantity < 3").select(F.col("l_partkey").alias("k")).distinct().join(done.distinct(), "k", "left_anti")


@query("section_listing", "SELECT event_type AS section, event_id, CAST(floor(value) AS INTEGER) AS importance FROM events ORDER BY section, importance DESC, ts, event_id")
def section_listing(spark, sf_dir):
    """SRT-02, SRT-04: by section, importance and age."""
    rows = base.table(spark, sf_dir, "events").select(F.col("event_type").alias("section"), "event_id", F.floor("value").cast("int").alias("importance"), "ts")
    return rows.orderBy("section", F.desc("importance"), "ts", "event_id").drop("ts")


@query("soft_caps", "SELECT o_orderstatus AS section, count(*) AS n, count(*) > CASE o_orderstatus WHEN 'P' THEN 20 ELSE 5000 END AS over FROM orders GROUP BY 1")
def soft_caps(spark, sf_dir):
    """WIN-10: sections over a cap that only warns."""
    counts = base.table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("section")).agg(F.count("*").alias("n"))
    return counts.select("section", "n", (F.col("n") > F.when(F.col("section") == "P", 20).otherwise(5000)).alias("over"))


@query("edition_stamps", "SELECT event_id, strftime(ts, '%Y%m%d') AS edition, strftime(ts, '%d.%m.%Y') AS shown FROM events")
def edition_stamps(spark, sf_dir):
    """DAT-04: the edition's day, from the sweep's stamp."""
    return base.table(spark, sf_dir, "events").select("event_id", F.date_format("ts", "yyyyMMdd").alias("edition"), F.date_format("ts", "dd.MM.yyyy").alias("shown"))


@query("search_links", "SELECT c_custkey, 'https://search.example/rss?q=' || CASE WHEN c_custkey % 2 = 0 THEN replace(lower(c_mktsegment), ' ', '%20') ELSE 'site%3A' || lower(c_mktsegment) || '.org' END || '%20when%3A2d&gl=' || CASE WHEN c_custkey % 3 = 0 THEN 'US' ELSE 'GB' END AS link FROM customer")
def search_links(spark, sf_dir):
    """SRC-14: "kw:words", a domain, and an edition behind "@"."""
    target = F.concat(F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("kw: "), F.lower("c_mktsegment"))).otherwise(F.concat(F.lower("c_mktsegment"), F.lit(".org"))), F.when(F.col("c_custkey") % 3 == 0, "@us").otherwise(""))
    plain, at = F.substring_index(F.col("target"), "@", 1), F.contains("target", F.lit("@"))
    words = F.when(F.startswith(plain, F.lit("kw:")), F.trim(F.substr(plain, F.lit(4)))).otherwise(F.concat(F.lit("site:"), plain))
    country = F.when(at, F.upper(F.trim(F.substring_index("target", "@", -1)))).otherwise("GB")
    coded = F.replace(F.url_encode(F.concat(words, F.lit(" when:2d"))), F.lit("+"), F.lit("%20"))
    rows = base.table(spark, sf_dir, "customer").withColumn("target", target)
    return rows.select("c_custkey", F.concat(F.lit("https://search.example/rss?q="), coded, F.lit("&gl="), country).alias("link"))


@query("answers_by_request", "SELECT user_id, CAST(event_id AS VARCHAR) AS request, 'https://a.org/' || event_id AS url FROM events WHERE event_id % 3 <> 0")
def answers_by_request(spark, sf_dir):
    """STR-29: a batch's answers by their request, never by place; a failed one has no answer."""
    inner = F.concat(F.lit('["ok",'), F.to_json(F.array(F.concat(F.lit("https://a.org/"), F.col("event_id").cast("string"), F.lit("/")))), F.lit("]"))
    one = F.concat(F.lit('["row",null,'), F.when(F.col("event_id") % 3 == 0, "null").otherwise(F.regexp_replace(F.to_json(F.array(inner)), r"^\[|\]$", "")), F.lit(',null,null,null,"'), F.col("event_id").cast("string"), F.lit('"]'))
    bodies = base.table(spark, sf_dir, "events").groupBy("user_id").agg(F.concat(F.lit(")]}'\n["), F.array_join(F.collect_list(one), ","), F.lit("]")).alias("body"))
    rows = bodies.select("user_id", F.explode(F.from_json(F.regexp_replace("body", r"^\)\]\}'\s*", ""), "array<array<string>>")).alias("r"))
    found = rows.where(F.get("r", F.lit(0)) == "row").select("user_id", F.get("r", F.lit(6)).alias("request"), F.from_json(F.get("r", F.lit(2)), "array<string>").alias("said"))
    return found.where("said[0] = 'ok'").select("user_id", "request", F.regexp_replace(F.get(F.from_json(F.get("said", F.lit(1)), "array<string>"), F.lit(0)), "/+$", "").alias("url"))


@query("sweep_items", "SELECT user_id, event_id FROM events")
def sweep_items(spark, sf_dir):
    """SRC-17: sweeps as an object with items or as a bare list."""
    each = F.to_json(F.collect_list(F.struct("event_id")))
    bodies = base.table(spark, sf_dir, "events").groupBy("user_id").agg(each.alias("list")).withColumn("body", F.when(F.col("user_id") % 2 == 0, F.col("list")).otherwise(F.concat(F.lit('{"generated": "x", "items": '), "list", F.lit("}"))))
    kind = "array<struct<event_id: long>>"
    items = F.when(F.startswith(F.ltrim("body"), F.lit("[")), F.from_json("body", kind)).otherwise(F.from_json("body", f"struct<items: {kind}>")["items"])
    return bodies.select("user_id", F.explode(items).alias("i")).select("user_id", "i.event_id")


@query("joined_objects", "SELECT user_id, event_id FROM events")
def joined_objects(spark, sf_dir):
    """SRC-18: objects written one behind the other, or in lists; braces in strings are no ends."""
    one = F.to_json(F.struct("event_id", F.lit('a }{ "b').alias("note")))
    bodies = base.table(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.collect_list(one), "\n").alias("body"))
    from tidemark.sources.objects import objects

    return objects(bodies, "user_id", "body", "event_id long").select("user_id", "event_id")


@query("live_lookups", "SELECT 'bill' AS kind, s_suppkey AS id, s_name AS name FROM supplier WHERE s_acctbal > 0 UNION ALL SELECT 'petition', p_partkey, p_name FROM part WHERE p_size > 25")
def live_lookups(spark, sf_dir):
    """SRC-19: live bills, and petitions that somebody signed, in one lookup table."""
    t = partial(base.table, spark, sf_dir)
    bills = t("supplier").where("s_acctbal > 0").select(F.lit("bill").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return bills.unionByName(t("part").where("p_size > 25").select(F.lit("petition").alias("kind"), F.col("p_partkey").alias("id"), F.col("p_name").alias("name")))


PROBES = ("/feed", "/rss", "/rss.xml", "/feed.xml", "/atom.xml")


@query("feed_candidates", f"WITH h AS (SELECT DISTINCT regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host FROM pages) SELECT host, 'https://' || host || path AS candidate, CAST(k AS INTEGER) AS k FROM h, (SELECT unnest([{base.quoted(PROBES)}]) AS path, unnest(range({len(PROBES)})) AS k)")
def feed_candidates(spark, sf_dir):
    """SRC-22's candidates, in the order in which they are tried; trying them needs a network."""
    hosts = base.table(spark, sf_dir, "pages").select(F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1).alias("host")).distinct()
    rows = hosts.select("host", F.posexplode(F.array(*[F.lit(p) for p in PROBES])).alias("k", "path"))
    return rows.select("host", F.concat(F.lit("https://"), "host", "path").alias("candidate"), "k")


@query("leads_manifest", """SELECT '{"i":' || doc_id || ',"section":"' || lang || '","outlet":"' || source || '","text":"' || CASE WHEN n_chars > 0 THEN 'yes' ELSE 'no' END || '"}' AS line FROM documents""")
def leads_manifest(spark, sf_dir):
    """SNK-04, SNK-01: a JSON object for each lead."""
    return base.table(spark, sf_dir, "documents").select(F.to_json(F.struct(F.col("doc_id").alias("i"), F.col("lang").alias("section"), F.col("source").alias("outlet"), F.when(F.col("n_chars") > 0, "yes").otherwise("no").alias("text"))).alias("line"))


@query("edition_lines", """SELECT o_orderkey, '- [' || replace(replace(o_orderpriority, '[', '('), ']', ')') || '](https://a.org/' || o_orderkey || ') · ' || o_orderstatus AS markdown, '<li><a href="https://a.org/' || o_orderkey || '">' || replace(o_orderpriority, '&', '&amp;') || '</a></li>' AS html, '• <https://a.org/' || o_orderkey || '|' || o_orderpriority || '>' AS chat FROM orders""")
def edition_lines(spark, sf_dir):
    """SNK-06, SNK-10: the line of a row in each format."""
    link, text = F.concat(F.lit("https://a.org/"), F.col("o_orderkey").cast("string")), F.col("o_orderpriority")
    plain = F.replace(F.replace(text, F.lit("["), F.lit("(")), F.lit("]"), F.lit(")"))
    escaped = F.replace(F.replace(F.replace(text, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return base.table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("- ["), plain, F.lit("]("), link, F.lit(") · "), "o_orderstatus").alias("markdown"), F.concat(F.lit('<li><a href="'), link, F.lit('">'), escaped, F.lit("</a></li>")).alias("html"), F.concat(F.lit("• <"), link, F.lit("|"), text, F.lit(">")).alias("chat"))


@query("missed_stories", f"""WITH {CLASSED_SQL}, l AS (SELECT doc_id, lang FROM documents), w AS (SELECT doc_id FROM labels WHERE quality = 1), s AS (SELECT cl.doc_id, section, {CHAFF_SQL.replace('doc_id', 'cl.doc_id')} AS reason, score FROM cl JOIN l ON l.doc_id = cl.doc_id WHERE cl.doc_id % 9 <> 4)
SELECT w.doc_id, CASE WHEN s.doc_id IS NULL THEN 'not swept' WHEN reason IS NOT NULL THEN 'suppressed: ' || reason WHEN section IS NULL THEN 'no section' WHEN score < 3 THEN 'ranked low' ELSE 'on the sheet' END AS diagnosis FROM w LEFT JOIN s ON s.doc_id = w.doc_id""")
def missed_stories(spark, sf_dir):
    """EVL-03: why a wanted row is not in the edition."""
    wanted = base.table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    swept = judged(spark, sf_dir).where("doc_id % 9 <> 4").select("doc_id", "section", "reason", "score", F.lit(True).alias("swept"))
    why = F.when(F.col("swept").isNull(), "not swept").when(F.col("reason").isNotNull(), F.concat(F.lit("suppressed: "), "reason")).when(F.col("section").isNull(), "no section").when(F.col("score") < 3, "ranked low").otherwise("on the sheet")
    return wanted.join(swept, "doc_id", "left").select("doc_id", why.alias("diagnosis"))


@query("fixture_verdicts", "SELECT doc_id, CASE WHEN quality = 1 AND doc_id % 7 = 0 THEN 'stale waiver' WHEN quality = 1 THEN 'pass' WHEN doc_id % 7 = 0 THEN 'waived' ELSE 'fail' END AS verdict FROM labels")
def fixture_verdicts(spark, sf_dir):
    """EVL-04: a waiver excuses a failing case, and fails where the case passes."""
    passed, waived = F.col("quality") == 1, F.col("doc_id") % 7 == 0
    return base.table(spark, sf_dir, "labels").select("doc_id", F.when(passed & waived, "stale waiver").when(passed, "pass").when(waived, "waived").otherwise("fail").alias("verdict"))


@query("prefetch_cache", "WITH new AS (SELECT user_id AS k, max_by(value, ts) AS v FROM events WHERE event_type <> 'error' AND day(ts) > 15 GROUP BY 1), old AS (SELECT user_id AS k, max_by(value, ts) AS v FROM events WHERE day(ts) <= 15 AND user_id % 5 <> 0 GROUP BY 1) SELECT coalesce(new.k, old.k) AS k, coalesce(new.v, old.v) AS v FROM new FULL JOIN old ON new.k = old.k")
def prefetch_cache(spark, sf_dir):
    """STM-06: entries of an older schema go, failures are not kept, newer successes replace."""
    rows = base.table(spark, sf_dir, "events")
    last = F.max_by("value", "ts").alias("v")
    new = rows.where("event_type <> 'error' AND day(ts) > 15").groupBy(F.col("user_id").alias("k")).agg(last)
    old = rows.where("day(ts) <= 15").groupBy(F.col("user_id").alias("k")).agg(last).withColumn("version", F.when(F.col("k") % 5 == 0, 1).otherwise(2))
    kept = old.where("version = 2").select("k", F.col("v").alias("was"))
    return new.join(kept, "k", "full").select("k", F.coalesce("v", "was").alias("v"))


@query("release_calendar", "SELECT c_custkey, c_name AS title, CASE c_custkey % 3 WHEN 0 THEN '2024-01-31' ELSE '2024-02-0' || (c_custkey % 9 + 1) END AS day, CASE c_custkey % 3 WHEN 0 THEN 'due' WHEN 1 THEN 'announced' ELSE 'published' END AS kind FROM customer")
def release_calendar(spark, sf_dir):
    """SRC-09: releases from JSON, from JSON inside a script, and from a table's rows; what is due is dated now."""
    day = F.concat(F.lit("2024-02-0"), (F.col("c_custkey") % 9 + 1).cast("string"))
    n = F.col("c_custkey") % 3
    page = F.when(n == 0, F.to_json(F.struct(F.col("c_name").alias("title")))).when(n == 1, F.concat(F.lit("<script>var releases = "), F.to_json(F.struct(F.col("c_name").alias("title"), day.alias("day"))), F.lit(";</script>")))
    page = page.otherwise(F.concat(F.lit("<table><tr><th>Title</th><th>Day</th></tr><tr><td class='t'> "), "c_name", F.lit(" </td><td>"), day, F.lit("</td></tr></table>")))
    rows = base.table(spark, sf_dir, "customer").select("c_custkey", page.alias("body"))
    said = F.from_json(F.when(F.startswith("body", F.lit("{")), F.col("body")).otherwise(F.regexp_extract("body", r"(?s)var releases = (\{.*?\});", 1)), "struct<title: string, day: string>")
    cells = F.regexp_extract_all("body", F.lit(r"(?s)<td[^>]*>\s*(.*?)\s*</td>"), F.lit(1))
    table = F.size(cells) >= 2
    title, when = F.when(table, F.get(cells, F.lit(0))).otherwise(said["title"]), F.when(table, F.get(cells, F.lit(1))).otherwise(said["day"])
    kind = F.when(table, "published").when(when.isNull(), "due").otherwise("announced")
    return rows.select("c_custkey", title.alias("title"), F.coalesce(when, F.lit("2024-01-31")).alias("day"), kind.alias("kind"))


@query("credited_descriptions", "SELECT doc_id, CASE WHEN doc_id % 3 = 1 THEN source || ' says ' || doc_id END AS description FROM documents")
def credited_descriptions(spark, sf_dir):
    """STR-26: the description of the page's article whose provider is the outlet."""
    block = lambda kind, name, text: F.concat(F.lit('<script type="application/ld+json">'), F.to_json(F.struct(F.lit(kind).alias("@type"), F.struct(name.alias("name")).alias("provider"), text.alias("description"))), F.lit("</script>"))
    text = F.concat("source", F.lit(" says "), F.col("doc_id").cast("string"))
    provider = F.when(F.col("doc_id") % 3 == 1, F.upper("source")).otherwise(F.lit("wire"))
    page = F.concat(block("WebSite", F.col("source"), F.lit("no")), block("NewsArticle", provider, text))
    rows = base.table(spark, sf_dir, "documents").select("doc_id", "source", page.alias("html"))
    blocks = F.transform(F.regexp_extract_all("html", F.lit(r"(?s)<script type=\"application/ld\+json\">(.*?)</script>"), F.lit(1)), lambda b: F.from_json(b, "struct<`@type`: string, provider: struct<name: string>, description: string>"))
    mine = F.filter(blocks, lambda b: F.endswith(b["@type"], F.lit("Article")) & (F.lower(b["provider"]["name"]) == F.lower("source")))
    return rows.select("doc_id", F.get(mine, F.lit(0))["description"].alias("description"))
