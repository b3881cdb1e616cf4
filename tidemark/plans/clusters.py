"""Queries over dedupe, pairs, clusters, furniture and past editions."""

from functools import partial

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import cluster, dedupe, desk, furniture, history, pairs, stages
from tidemark.operators.dedupe import written
from tidemark.plans import base
from tidemark.plans.texts import ROWS_SQL, proper_tokens, rows

QUERIES: dict = {}
SQL: dict = {}
query = partial(base.register, QUERIES, SQL)

#: Format labels as they stand in stemmed words: each without a last s, where it has one.
LABELS = tuple(sorted({x.removesuffix("s") for x in T.FORMAT_LABELS}))
PAIR_SQL = f"""WITH {ROWS_SQL}, df AS (SELECT word, count(*) AS df FROM (SELECT unnest(w) AS word FROM sig) GROUP BY word),
unc AS (SELECT word FROM df WHERE df < greatest(15.0, {pairs.COMMON_SHARE} * (SELECT count(*) FROM documents))),
ex AS (SELECT doc_id, unnest(w) AS word FROM sig WHERE len(w) >= 3), bl AS (SELECT * FROM ex WHERE word IN (SELECT word FROM unc) AND word NOT IN ({base.quoted(LABELS)})),
cand AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM bl x JOIN bl y ON x.word = y.word AND x.doc_id < y.doc_id),
sized AS (SELECT a, b, len(list_filter(list_intersect(p.w, q.w), lambda z: z NOT IN ({base.quoted(LABELS)}))) AS shared, least(len(p.w), len(q.w)) AS small FROM cand JOIN sig p ON p.doc_id = a JOIN sig q ON q.doc_id = b),
prs AS (SELECT a, b, CAST(shared AS INTEGER) AS shared FROM sized WHERE shared >= CAST(0.55 AS DOUBLE) * small OR shared >= 5)"""


def uncommon_words(items):
    counts = pairs.word_counts(items, "w")
    n = items.groupBy().agg(F.count("*").alias("n")).scalar()
    return counts.where(F.col("df") < F.greatest(F.lit(float(pairs.COMMON_ROWS)), F.lit(pairs.COMMON_SHARE) * n))


def linked(spark, sf_dir):
    items = written(rows(spark, sf_dir).select("doc_id", "source", "headline", "w", "n_chars"), "items")
    return items, pairs.overlapping(items, "doc_id", "w", LABELS, uncommon_words(items), 3)


@query("overlap_pairs", PAIR_SQL + " SELECT a, b, shared FROM prs")
def overlap_pairs(spark, sf_dir):
    """CLU-02, JON-05."""
    return linked(spark, sf_dir)[1]


@query("star_clusters")
def star_clusters(spark, sf_dir):
    """CLU-01: no SQL, the greedy order needs a loop; held against brute force in the tests."""
    items, found = linked(spark, sf_dir)
    return cluster.stars(items.where(F.size("w") >= 3).select(F.col("doc_id").alias("id")), found)


@query("corroboration_counts")
def corroboration_counts(spark, sf_dir):
    """AGG-03, CLU-05: size and outlets of every cluster."""
    items, found = linked(spark, sf_dir)
    leads = cluster.stars(items.where(F.size("w") >= 3).select(F.col("doc_id").alias("id")), found)
    return leads.join(items.select(F.col("doc_id").alias("id"), "source"), "id").groupBy("lead").agg(F.count("*").alias("n"), F.count_distinct("source").alias("outlets"))


COMPONENT_SQL = PAIR_SQL.replace("WITH ", "WITH RECURSIVE ", 1) + """, pairs2 AS (SELECT a, b FROM prs UNION SELECT b, a FROM prs),
walk(id, label) AS (SELECT doc_id, doc_id FROM documents UNION SELECT pairs2.b, walk.label FROM walk JOIN pairs2 ON pairs2.a = walk.id WHERE walk.label < pairs2.b)
SELECT id, min(label) AS component FROM walk GROUP BY id"""


@query("event_components", COMPONENT_SQL)
def event_components(spark, sf_dir):
    """Connected components over the overlap pairs of CLU-02, as its SQL says; CLU-06 is event_sizes."""
    items, found = linked(spark, sf_dir)
    return cluster.components(items.select(F.col("doc_id").alias("id")), found)


#: What event words begin with; a parameter of the caller's.
EVENTS = "^(attack|kill|death|vote|elect|protest|visit|court|charg|strike|deal|war|law|report|launch|clos|order)"


@query("event_sizes")
def event_sizes(spark, sf_dir, events=EVENTS, stop=()):
    """CLU-06, JON-07, AGG-04: no SQL; rows that share a proper name and an event word, held against a loop in the tests."""
    items = written(rows(spark, sf_dir).select(F.col("doc_id").alias("id"), "headline", "w"), "items")
    proper = written(proper_tokens(spark, sf_dir).select("word"), "proper")
    names = items.select("id", F.explode(F.regexp_extract_all("headline", F.lit("([A-Z][A-Za-z'’-]+)"), F.lit(1))).alias("n")).select("id", F.lower("n").alias("word"))
    names = names.where(~F.col("word").rlike(events) & ~F.col("word").isin(*stop)).join(proper, "word", "left_semi").groupBy("id").agg(F.collect_set("word").alias("names"))
    told = items.join(names, "id", "left").select("id", F.coalesce("names", F.array().cast("array<string>")).alias("names"), F.filter("w", lambda x: x.rlike(events)).alias("events"))
    return cluster.event_sizes(told)


FOLD_SQL = f"""WITH RECURSIVE {ROWS_SQL}, toks AS (SELECT doc_id, list_filter(string_split(regexp_replace(lower(headline), '[^a-z ]', ' ', 'g'), ' '), lambda x: length(x) > 3) AS t FROM rows),
grams AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) AS g FROM toks),
post AS (SELECT g FROM grams GROUP BY g HAVING count(*) BETWEEN 3 AND 25), hit AS (SELECT doc_id, g FROM grams WHERE g IN (SELECT g FROM post)),
prs AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM hit x JOIN hit y ON x.g = y.g AND x.doc_id < y.doc_id JOIN sig p ON p.doc_id = x.doc_id JOIN sig q ON q.doc_id = y.doc_id WHERE len(list_intersect(p.w, q.w)) >= 4),
pairs2 AS (SELECT a, b FROM prs UNION SELECT b, a FROM prs),
walk(id, label) AS (SELECT doc_id, doc_id FROM documents UNION SELECT pairs2.b, walk.label FROM walk JOIN pairs2 ON pairs2.a = walk.id WHERE walk.label < pairs2.b),
comp AS (SELECT id, min(label) AS component FROM walk GROUP BY id),
kept AS (SELECT component, id FROM comp JOIN sig m ON m.doc_id = id JOIN sig h ON h.doc_id = component WHERE id = component OR len(list_intersect(m.w, h.w)) >= 2)
SELECT component, id, count(*) OVER (PARTITION BY component) AS size FROM kept QUALIFY size > 1"""


@query("fold_groups", FOLD_SQL)
def fold_groups(spark, sf_dir):
    """CLU-07, JON-08: rows under a rare bigram that share more words, joined up, with a head check."""
    items = written(rows(spark, sf_dir).select("doc_id", "headline", "w"), "items")
    plain = F.filter(F.split(F.regexp_replace(F.lower("headline"), "[^a-z ]", " "), " "), lambda x: F.char_length(x) > 3)
    toks = items.select("doc_id", plain.alias("t")).where("size(t) > 1")
    grams = toks.select("doc_id", F.explode(F.array_distinct(F.transform(F.slice("t", F.lit(1), F.size("t") - 1), lambda x, i: F.concat(x, F.lit(" "), F.get("t", i + 1))))).alias("g"))
    rare = grams.groupBy("g").agg(F.count("*").alias("n")).where("n BETWEEN 3 AND 25").select("g")
    hit = grams.join(rare, "g", "left_semi")
    close = hit.select("g", F.col("doc_id").alias("a")).join(hit.select("g", F.col("doc_id").alias("b")), "g").where("a < b").select("a", "b").distinct()
    sets = items.select(F.col("doc_id").alias("id"), "w")
    x, y = sets.select(F.col("id").alias("a"), F.col("w").alias("wa")), sets.select(F.col("id").alias("b"), F.col("w").alias("wb"))
    found = close.join(x, "a").join(y, "b").where(F.size(F.array_intersect("wa", "wb")) >= 4).select("a", "b")
    return cluster.headed(cluster.components(sets.select("id"), found), sets, 2)


@query("greedy_dedupe")
def greedy_dedupe(spark, sf_dir):
    """DDP-01 on text id and title key: no SQL, the order decides; held against brute force in the tests."""
    items = rows(spark, sf_dir).select("doc_id", "source", T.text_id(F.col("text")).alias("k1"), T.title_key(F.col("headline")).alias("k2"))
    return dedupe.greedy(items, "doc_id", ["source", "doc_id"], ("k1", "k2"))


@query("borrowed_summaries", """WITH r AS (SELECT doc_id, translate(substr(text, 1, 20), chr(10), ' ') AS k, substr(text, 21, 300) AS s FROM documents), f AS (SELECT k, min(doc_id) AS m FROM r GROUP BY k),
b AS (SELECT r.k, max((length(s), s)) AS best FROM r JOIN f ON r.k = f.k WHERE doc_id > m GROUP BY r.k)
SELECT doc_id, length(CASE WHEN coalesce(struct_extract_at(best, 1), 0) > length(s) + 40 THEN struct_extract_at(best, 2) ELSE s END) AS chars, coalesce(struct_extract_at(best, 1), 0) > length(s) + 40 AS borrowed FROM r JOIN f ON r.k = f.k AND doc_id = m LEFT JOIN b ON b.k = r.k""")
def borrowed_summaries(spark, sf_dir):
    """DDP-02: the longest offer of a keeper's copies."""
    items = base.table(spark, sf_dir, "documents").select("doc_id", F.translate(F.substring("text", 1, 20), "\n", " ").alias("k"), F.substring("text", 21, 300).alias("s"))
    first = items.groupBy("k").agg(F.min("doc_id").alias("m"))
    joined = items.join(first, "k")
    out = dedupe.borrowed_summary(joined.where("doc_id = m"), joined.where("doc_id > m"), "k", "s")
    return out.select("doc_id", F.char_length("s").cast("long").alias("chars"), "borrowed")


@query("link_index_swap", """WITH t AS (SELECT page_id, url, regexp_extract(html, '<title>([^<]{0,12})', 1) AS k FROM pages), i AS (SELECT k, arg_min(url, page_id) AS direct FROM t WHERE starts_with(url, 'https') GROUP BY k)
SELECT page_id, CASE WHEN starts_with(url, 'http:') AND direct IS NOT NULL THEN direct ELSE url END AS url FROM t LEFT JOIN i USING (k)""")
def link_index_swap(spark, sf_dir):
    """DDP-03, JON-04: plain http pages stand for redirects."""
    pages = base.table(spark, sf_dir, "pages").select("page_id", "url", F.regexp_extract("html", "<title>([^<]{0,12})", 1).alias("k"))
    index = pages.where(F.startswith("url", F.lit("https")))
    return dedupe.direct_links(pages, index, "k", "url", F.startswith("url", F.lit("http:")), ["page_id"]).select("page_id", "url")


@query("distinct_urls", "SELECT url, min(page_id) AS page_id FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages) GROUP BY url")
def distinct_urls(spark, sf_dir):
    """DDP-04, DDP-05, DDP-06: the first row of each key."""
    pages = base.table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("url", "[?#].*$", "").alias("url"))
    return dedupe.ranked_once(pages, "url", ["page_id"]).select("url", "page_id")


NAME_SQL = "list_distinct(list_transform(regexp_extract_all(headline, '([A-Z][a-z]{4,})', 1), lambda x: lower(x)))"
HISTORY_SQL = f"""WITH {ROWS_SQL}, td AS (SELECT doc_id, w, {NAME_SQL} AS n FROM sig WHERE doc_id % 2 = 0), pt AS (SELECT doc_id AS past_id, doc_id // 100 AS edition, w, {NAME_SQL} AS n FROM sig WHERE doc_id % 2 = 1),
ents AS (SELECT e FROM (SELECT unnest(n) AS e FROM td UNION ALL SELECT unnest(n) FROM pt) GROUP BY e HAVING count(*) BETWEEN 2 AND 12),
cand AS (SELECT x.doc_id, y.past_id, count(*) AS shared FROM (SELECT doc_id, unnest(w) AS word FROM td) x JOIN (SELECT past_id, unnest(w) AS word FROM pt) y USING (word) GROUP BY ALL HAVING count(*) >= 3),
hit AS (SELECT cand.*, edition FROM cand JOIN td USING (doc_id) JOIN pt USING (past_id) WHERE (least(len(td.w), len(pt.w)) >= 4 AND shared >= CAST(0.55 AS DOUBLE) * least(len(td.w), len(pt.w))) OR shared >= 5 OR list_has_any(list_intersect(td.n, pt.n), (SELECT list(e) FROM ents)))
SELECT doc_id, past_id, edition, CAST(shared AS INTEGER) AS shared FROM hit QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY edition DESC, past_id) = 1"""


@query("repeat_match_latest", HISTORY_SQL)
def repeat_match_latest(spark, sf_dir):
    """CLU-08, CLU-09, JON-06: even documents are today's, odd ones past editions of a hundred ids."""
    names = F.array_distinct(F.transform(F.regexp_extract_all("headline", F.lit("([A-Z][a-z]{4,})"), F.lit(1)), F.lower))
    items = written(rows(spark, sf_dir).select("doc_id", "w", names.alias("n")), "items")
    today = items.where("doc_id % 2 = 0")
    past = items.where("doc_id % 2 = 1").select(F.col("doc_id").alias("past_id"), F.floor(F.col("doc_id") / 100).alias("edition"), "w", "n")
    return history.ran_before(today, past, "doc_id", "w", "n", "edition", history.distinctive(today, past, "n"))


GRAM_SQL = """WITH t AS (SELECT doc_id, source, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT doc_id, source, unnest(range(0, len(ws) - 5)) AS pos, unnest(list_transform(range(1, len(ws) - 4), lambda i: array_to_string(ws[i:i + 5], ' '))) AS gram FROM t WHERE len(ws) >= 6),
df AS (SELECT source AS host, gram, count(DISTINCT doc_id) AS df FROM g GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3)"""


@query("host_ngram_furniture", GRAM_SQL + " SELECT host, gram, df FROM df")
def host_ngram_furniture(spark, sf_dir):
    """AGG-06, with a floor of three documents."""
    return furniture.learned(base.table(spark, sf_dir, "documents"), "source", "text", 3, 0.0)


@query("furniture_runs", GRAM_SQL + """, hits AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 6)) AS word FROM g JOIN df ON df.host = g.source AND df.gram = g.gram),
isl AS (SELECT doc_id, word, word - row_number() OVER (PARTITION BY doc_id ORDER BY word) AS i FROM hits)
SELECT doc_id AS id, CAST(min(word) AS INTEGER) AS "begin", count(*) AS length FROM isl GROUP BY doc_id, i HAVING count(*) >= 10""")
def furniture_runs(spark, sf_dir):
    """WIN-09's runs of learned furniture, ten words at least; furniture_cuts joins them."""
    docs = base.table(spark, sf_dir, "documents")
    known = written(furniture.learned_keys(docs, "source", "text", 3), "furniture")
    return furniture.furniture_runs(docs, "doc_id", "source", "text", known)


@query("furniture_cuts", GRAM_SQL + """, hits AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 6)) AS word FROM g JOIN df ON df.host = g.source AND df.gram = g.gram),
isl AS (SELECT doc_id, word, word - row_number() OVER (PARTITION BY doc_id ORDER BY word) AS i FROM hits),
r AS (SELECT doc_id, min(word) AS b, max(word) + 1 AS e FROM isl GROUP BY doc_id, i HAVING count(*) >= 10),
m AS (SELECT *, sum(CASE WHEN b - p <= 3 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY b) AS c FROM (SELECT *, lag(e) OVER (PARTITION BY doc_id ORDER BY b) AS p FROM r))
SELECT doc_id AS id, CAST(min(b) AS INTEGER) AS "begin", max(e) - min(b) AS length FROM m GROUP BY doc_id, c""")
def furniture_cuts(spark, sf_dir):
    """WIN-09: runs with up to three words between them are one cut."""
    return furniture.bridged(furniture_runs(spark, sf_dir))

#: Words that stand for stages of a story, and a vocabulary for their facts; parameters of the caller's.
CLASSES = {"rise": "tion", "fall": "aux", "vote": "ung", "law": "ment"}
FEW = 60
#: Near copies of the corpus have one headline, so their classes come from their ids here.
CLASS_SQL = "CASE WHEN doc_id % 2 = 0 THEN ['fall', 'rise'] WHEN doc_id % 3 = 0 THEN ['vote'] WHEN doc_id % 5 = 0 THEN ['fall'] ELSE [] END"


@query("stage_collisions", f"""WITH {ROWS_SQL}, ex AS (SELECT doc_id, unnest(w) AS word FROM sig), few AS (SELECT word FROM ex GROUP BY word HAVING count(*) BETWEEN 2 AND {FEW}),
b AS (SELECT * FROM ex WHERE word IN (SELECT word FROM few)), c AS (SELECT DISTINCT x.doc_id AS a, y.doc_id AS b FROM b x JOIN b y ON x.word = y.word AND x.doc_id < y.doc_id),
cl AS (SELECT doc_id, source, w, {CLASS_SQL} AS k FROM sig),
m AS (SELECT p.k AS ka, q.k AS kb FROM c JOIN cl p ON p.doc_id = c.a JOIN cl q ON q.doc_id = c.b WHERE length(p.source) = length(q.source) AND (len(list_intersect(p.w, q.w)) >= 5 OR (least(len(p.w), len(q.w)) >= 4 AND len(list_intersect(p.w, q.w)) >= CAST(0.55 AS DOUBLE) * least(len(p.w), len(q.w)))) AND len(p.k) > 0 AND len(q.k) > 0 AND len(list_intersect(p.k, q.k)) = 0)
SELECT least(array_to_string(ka, '/'), array_to_string(kb, '/')) AS first, greatest(array_to_string(ka, '/'), array_to_string(kb, '/')) AS second, count(*) AS n FROM m GROUP BY 1, 2""")
def stage_collisions(spark, sf_dir):
    """CLU-11: pairs that words would join and stages keep apart, counted by the classes that do.

    The length of a source's name stands for the section, as near copies lie in several sources.
    """
    kinds = lambda *names: F.array(*[F.lit(n) for n in names])
    classes = F.when(F.col("doc_id") % 2 == 0, kinds("fall", "rise")).when(F.col("doc_id") % 3 == 0, kinds("vote")).when(F.col("doc_id") % 5 == 0, kinds("fall")).otherwise(F.array().cast("array<string>"))
    items = written(rows(spark, sf_dir).select("doc_id", F.char_length("source").alias("section"), "w", classes.alias("k")).where("size(k) > 0"), "items")
    # words are counted over all rows, pairs are sought among those with a class
    few = pairs.word_counts(rows(spark, sf_dir), "w").where(F.col("df").between(2, FEW)).select("word")
    spread = items.select("doc_id", "section", F.explode("w").alias("word")).join(few, "word", "left_semi")
    met = spread.select("word", "section", F.col("doc_id").alias("a")).join(spread.select("word", "section", F.col("doc_id").alias("b")), ["word", "section"]).where("a < b").select("a", "b").distinct()
    x, y = (items.select(F.col("doc_id").alias(n), F.col("w").alias(f"w{n}"), F.col("k").alias(f"k{n}")) for n in "ab")
    found = met.join(x, "a").join(y, "b").withColumn("shared", F.size(F.array_intersect("wa", "wb"))).withColumn("small", F.least(F.size("wa"), F.size("wb")))
    found = found.where(((F.col("shared") >= history.ENOUGH) | ((F.col("small") >= history.LEAST_WORDS) & (F.col("shared") >= F.lit(history.RATIO) * F.col("small")))) & ~F.arrays_overlap("ka", "kb"))
    first, second = F.array_join("ka", "/"), F.array_join("kb", "/")
    return found.groupBy(F.least(first, second).alias("first"), F.greatest(first, second).alias("second")).agg(F.count("*").alias("n"))


def same_stories(spark, sf_dir):
    """Pairs (a, b) of CLU-03 among rows of a source: words, or a rare shared name and three words; never two stages."""
    items = written(rows(spark, sf_dir).select("doc_id", "source", "headline", "w", "n_chars"), "items")
    told = stages.facts(items, "headline", "ung", "tion", "aux", "ment", CLASSES)
    names = F.array_distinct(F.transform(F.regexp_extract_all("headline", F.lit("([A-Z][a-z]{4,})"), F.lit(1)), F.lower))
    told = written(told.select("doc_id", "source", "w", "stage", names.alias("names")), "told")
    # pairs that words join have enough of them and an uncommon one already
    one_story = lambda x, y: stages.same_story(F.lit(pairs.ENOUGH), F.lit(pairs.ENOUGH), F.lit(1), F.lit(False), x("source"), y("source"), stages.is_development(x("stage"), y("stage")))
    found = pairs.overlapping(told, "doc_id", "w", LABELS, uncommon_words(items), 3, ("source", "stage"), one_story)
    rare = pairs.banded(pairs.word_counts(told, "names"))
    spread = told.select("doc_id", "source", F.explode("names").alias("word")).join(rare, "word", "left_semi")
    named = spread.select("word", "source", F.col("doc_id").alias("a")).join(spread.select("word", "source", F.col("doc_id").alias("b")), ["word", "source"]).where("a < b").select("a", "b").distinct()
    x, y = (told.select(F.col("doc_id").alias(n), F.col("source").alias(f"s{n}"), F.col("w").alias(f"w{n}"), F.col("stage").alias(f"t{n}")) for n in "ab")
    both = named.join(x, "a").join(y, "b")
    fits = stages.same_story(F.size(F.array_intersect("wa", "wb")), F.least(F.size("wa"), F.size("wb")), F.lit(0), F.lit(True), F.col("sa"), F.col("sb"), stages.is_development(F.col("ta"), F.col("tb")))
    return items, found.select("a", "b").union(both.where(fits).select("a", "b"))


@query("story_marks")
def story_marks(spark, sf_dir):
    """CLU-03, CLU-04: greedy clusters of one story and the mark of each member; no SQL, the order decides."""
    items, found = same_stories(spark, sf_dir)
    members = cluster.stars(items.select(F.col("doc_id").alias("id")), found).withColumnRenamed("lead", "cluster")
    facts = items.select(F.col("doc_id").alias("id"), "n_chars", F.contains("headline", F.lit("|")).alias("comment"), F.col("source").isin("src0", "src5").alias("followed"))
    return desk.cluster_marks(members.join(facts, "id"), "n_chars", "comment", "followed")
