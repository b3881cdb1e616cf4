"""Queries over text and url functions."""

from functools import partial

from pyspark.sql import functions as F

from tidemark.functions import text as T
from tidemark.operators import filters, pairs
from tidemark.plans import base

QUERIES: dict = {}
SQL: dict = {}
query = partial(base.register, QUERIES, SQL)

NETLOC, PATH, QUERY = (p.replace("'", "''") for p in (T.NETLOC, T.PATH, T.QUERY))
HOST_SQL = f"regexp_extract(url, '{NETLOC}', 1)"
PATH_SQL = f"regexp_extract(url, '{PATH}', 1)"
PAIRS_SQL = f"string_split(regexp_extract(url, '{QUERY}', 1), '&')"
#: A document's headline, and its significant words, as SQL.
HEADLINE_SQL = "translate(substr(coalesce(text, ''), 1, 150), chr(10), ' ')"
DEACCENT_SQL = "regexp_replace(replace(strip_accents({}), 'ß', ''), '[^\\x00-\\x7F]', '', 'g')"


def stem_sql(w: str) -> str:
    arms = []
    for s in T.SUFFIXES:
        arms.append(f"WHEN ends_with({w}, '{s}') AND length({w}) - {len(s)} >= 4 THEN substr({w}, 1, length({w}) - {len(s)})" + (" || 'y'" if s == "ies" else ""))
    return "CASE " + " ".join(arms) + f" ELSE {w} END"


def words_sql(text: str) -> str:
    plain = f"regexp_replace(lower({DEACCENT_SQL.format(text)}), '[^a-z0-9 ]', ' ', 'g')"
    return f"list_distinct(list_transform(list_filter(string_split({plain}, ' '), lambda w: length(w) > 3 AND w NOT IN ({base.quoted(T.WORD_STOP)})), lambda w: {stem_sql('w')}))"


ROWS_SQL = f"rows AS (SELECT doc_id, source, {HEADLINE_SQL} AS headline FROM documents), sig AS (SELECT doc_id, source, headline, {words_sql('headline')} AS w FROM rows)"


def rows(spark, sf_dir):
    """Documents as items: headline and its significant words."""
    docs = base.table(spark, sf_dir, "documents")
    items = docs.select("doc_id", "source", "lang", "n_chars", "text", T.headline(F.col("text")).alias("headline"))
    return items.withColumn("w", T.significant(F.col("headline")))


@query("url_key_pages", f"""SELECT page_id, replace(lower({HOST_SQL}), 'www.', '') || lower(regexp_replace({PATH_SQL}, '/+$', '')) || CASE WHEN len(k) > 0 THEN '?' || array_to_string(k, '&') ELSE '' END AS url_key
FROM (SELECT page_id, url, list_sort(list_transform(list_filter({PAIRS_SQL}, lambda kv: instr(kv, '=') > 1 AND instr(kv, '=') < length(kv) AND regexp_matches(split_part(kv, '=', 1), '{T.ID_PARAMETER}')), lambda kv: lower(split_part(kv, '=', 1)) || substr(kv, instr(kv, '=')))) AS k FROM pages)""")
def url_key_pages(spark, sf_dir):
    """STR-02."""
    return base.table(spark, sf_dir, "pages").select("page_id", T.url_key(F.col("url")).alias("url_key"))


@query("history_key_pages", f"SELECT page_id, regexp_replace(regexp_replace(lower({HOST_SQL}), '^www\\.', '') || lower({PATH_SQL}), '/+$', '') AS history_key FROM pages")
def history_key_pages(spark, sf_dir):
    """STR-03."""
    return base.table(spark, sf_dir, "pages").select("page_id", T.history_key(F.col("url")).alias("history_key"))


@query("url_tracking_params", f"""SELECT page_id, lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) || '://' || {HOST_SQL} || CASE WHEN regexp_replace({PATH_SQL}, '/+$', '') = '' THEN '/' ELSE regexp_replace({PATH_SQL}, '/+$', '') END || CASE WHEN len(k) > 0 THEN '?' || array_to_string(k, '&') ELSE '' END AS clean
FROM (SELECT page_id, url, list_filter({PAIRS_SQL}, lambda kv: kv <> '' AND split_part(kv, '=', 1) NOT IN ({base.quoted(T.TRACKING)})) AS k FROM pages)""")
def url_tracking_params(spark, sf_dir):
    """STR-01."""
    return base.table(spark, sf_dir, "pages").select("page_id", T.clean_url(F.col("url")).alias("clean"))


@query("clean_host_pages", f"SELECT regexp_replace(lower({HOST_SQL}), '^(www|rss|feeds|amp|wp)\\.', '') AS host, count(*) AS n FROM pages GROUP BY 1")
def clean_host_pages(spark, sf_dir):
    """STR-06."""
    return base.table(spark, sf_dir, "pages").groupBy(T.outlet_host(F.col("url")).alias("host")).agg(F.count("*").alias("n"))


@query("title_key_documents", f"""SELECT doc_id, coalesce(array_to_string(list_sort(list_filter(string_split(regexp_replace(lower({HEADLINE_SQL}), '[^a-z0-9 ]', ' ', 'g'), ' '), lambda w: length(w) > 3 AND w NOT IN ({base.quoted(T.TITLE_STOP)}))[1:8]), ' '), '') AS title_key FROM documents""")
def title_key_documents(spark, sf_dir):
    """STR-04."""
    return rows(spark, sf_dir).select("doc_id", T.title_key(F.col("headline")).alias("title_key"))


@query("sig_words_documents", f"WITH {ROWS_SQL} SELECT doc_id, coalesce(array_to_string(list_sort(w), ' '), '') AS words, CAST(len(w) AS INTEGER) AS n FROM sig")
def sig_words_documents(spark, sf_dir):
    """STR-11, STR-12."""
    return rows(spark, sf_dir).select("doc_id", F.array_join(F.array_sort("w"), " ").alias("words"), F.size("w").alias("n"))


@query("stem_words", f"WITH t AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS w FROM documents) SELECT w, {stem_sql('w')} AS stem FROM t WHERE regexp_matches(w, '^[a-z]+$')")
def stem_words(spark, sf_dir):
    """STR-10."""
    words = base.table(spark, sf_dir, "documents").select(F.explode(F.split(F.lower("text"), " ")).alias("w")).distinct().where(F.col("w").rlike("^[a-z]+$"))
    return words.select("w", T.stem(F.col("w")).alias("stem"))


@query("text_id_documents", "SELECT doc_id, CASE WHEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') = '' THEN 'none' ELSE substr(sha1(substr(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), 1, 2000)), 1, 12) END AS text_id FROM documents")
def text_id_documents(spark, sf_dir):
    """STR-21."""
    return base.table(spark, sf_dir, "documents").select("doc_id", T.text_id(F.col("text")).alias("text_id"))


@query("slug_documents", f"SELECT doc_id, array_to_string(string_split(regexp_replace(regexp_replace(regexp_replace(lower({HEADLINE_SQL}), '[''’‘\"“”]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g'), '-')[1:6], '-') AS slug FROM documents")
def slug_documents(spark, sf_dir):
    """STR-09."""
    return rows(spark, sf_dir).select("doc_id", T.slug(F.col("headline"), 6).alias("slug"))


@query("echo_documents", """WITH a AS (SELECT doc_id, text, list_filter(string_split(text, ' '), lambda w: w <> '') AS ws FROM documents), b AS (SELECT *, array_to_string(ws[1:3], ' ') AS head FROM a),
c AS (SELECT *, CASE WHEN strpos(substr(substr(text, 1, 700), length(head) + 1), head) > 0 THEN strpos(substr(substr(text, 1, 700), length(head) + 1), head) + length(head) ELSE 0 END AS place FROM b)
SELECT doc_id, length(CASE WHEN len(ws) > 3 AND place > 0 THEN substr(text, place) ELSE text END) AS left_chars FROM c""")
def echo_documents(spark, sf_dir):
    """STR-30, with a head of three words: eight do not come again in this corpus."""
    return base.table(spark, sf_dir, "documents").select("doc_id", F.char_length(T.without_echo(F.col("text"), 3)).cast("long").alias("left_chars"))


@query("real_summaries", f"""WITH r AS (SELECT doc_id, {HEADLINE_SQL} AS headline, substr(text, 151, 300) AS summary FROM documents)
SELECT doc_id, CASE WHEN len(list_filter(list_distinct(regexp_extract_all(lower(summary), '([a-z]{{4,}})', 1)), lambda x: NOT list_contains(regexp_extract_all(lower(headline), '([a-z]{{4,}})', 1), x))) >= 3 THEN summary ELSE '' END AS summary FROM r""")
def real_summaries(spark, sf_dir):
    """STR-16."""
    docs = rows(spark, sf_dir).withColumn("rest", F.substring("text", 151, 300))
    return docs.select("doc_id", T.real_summary(F.col("rest"), F.col("headline")).alias("summary"))


@query("word_df", f"WITH {ROWS_SQL} SELECT word, count(*) AS df FROM (SELECT unnest(w) AS word FROM sig) GROUP BY word")
def word_df(spark, sf_dir):
    """AGG-01."""
    return pairs.word_counts(rows(spark, sf_dir), "w")


@query("common_words", f"WITH {ROWS_SQL} SELECT word, count(*) AS df FROM (SELECT unnest(w) AS word FROM sig) GROUP BY word HAVING count(*) >= greatest(15.0, {pairs.COMMON_SHARE} * (SELECT count(*) FROM documents))")
def common_words(spark, sf_dir):
    """AGG-01's floor."""
    items = rows(spark, sf_dir)
    return pairs.common(pairs.word_counts(items, "w"), items.groupBy().agg(F.count("*").alias("n")).scalar())


@query("entity_band", "WITH t AS (SELECT DISTINCT doc_id, lower(unnest(regexp_extract_all(text, '([A-Z][a-z]{4,})', 1))) AS e FROM documents) SELECT e AS word, count(*) AS df FROM t GROUP BY e HAVING count(*) BETWEEN 2 AND 12")
def entity_band(spark, sf_dir):
    """AGG-02: capitalised words of a band of frequencies."""
    docs = base.table(spark, sf_dir, "documents")
    names = docs.select(F.array_distinct(F.transform(F.regexp_extract_all("text", F.lit("([A-Z][a-z]{4,})"), F.lit(1)), F.lower)).alias("e"))
    return pairs.banded(pairs.word_counts(names, "e"))


@query("proper_tokens", """WITH t AS (SELECT unnest(regexp_extract_all(translate(substr(text, 1, 150), chr(10), ' '), '([A-Za-z][A-Za-z''’-]+)', 1)) AS t, unnest(range(0, len(regexp_extract_all(translate(substr(text, 1, 150), chr(10), ' '), '([A-Za-z][A-Za-z''’-]+)', 1)))) AS i FROM documents),
c AS (SELECT lower(t) AS word, sum(CASE WHEN regexp_matches(t, '^[A-Z]') AND i > 0 THEN 1 ELSE 0 END) AS cap, sum(CASE WHEN regexp_matches(t, '^[a-z]') THEN 1 ELSE 0 END) AS low FROM t GROUP BY 1)
SELECT word, CAST(cap AS BIGINT) AS cap, CAST(low AS BIGINT) AS low FROM c WHERE cap >= 2 AND CAST(low AS DOUBLE) / (cap + low) < 0.3""")
def proper_tokens(spark, sf_dir):
    """AGG-05: words written with a capital inside headlines and rarely without."""
    tokens = rows(spark, sf_dir).select(F.posexplode(F.regexp_extract_all("headline", F.lit("([A-Za-z][A-Za-z'’-]+)"), F.lit(1))).alias("i", "t"))
    cap = F.sum(F.when(F.col("t").rlike("^[A-Z]") & (F.col("i") > 0), 1).otherwise(0))
    low = F.sum(F.when(F.col("t").rlike("^[a-z]"), 1).otherwise(0))
    counts = tokens.groupBy(F.lower("t").alias("word")).agg(cap.alias("cap"), low.alias("low"))
    return counts.where("cap >= 2 AND low / (cap + low) < 0.3")


@query("longest_outlet_match", """WITH m AS (SELECT p.page_id, n.n_name, length(n.n_name) AS l FROM pages p JOIN nation n ON contains(lower(p.html), lower(n.n_name)))
SELECT p.page_id, (SELECT n_name FROM m WHERE m.page_id = p.page_id ORDER BY l DESC, n_name LIMIT 1) AS place FROM pages p""")
def longest_outlet_match(spark, sf_dir):
    """JON-12: of the names a text holds the longest; the dimension is a fixed list of 25 names."""
    pages, names = base.table(spark, sf_dir, "pages"), base.table(spark, sf_dir, "nation").select("n_name")
    hit = pages.join(F.broadcast(names), F.contains(F.lower("html"), F.lower("n_name")), "left")
    return hit.groupBy("page_id").agg(F.min_by("n_name", F.struct(-F.char_length("n_name"), "n_name")).alias("place"))


@query("junk_titles", f"SELECT doc_id, length(trim({HEADLINE_SQL}, ' ')) < 25 OR regexp_matches(trim({HEADLINE_SQL}, ' '), '(?i)^(archive|subscribe|sign in|log in)\\b') AS junk FROM documents")
def junk_titles(spark, sf_dir):
    """FLT-06."""
    return rows(spark, sf_dir).select("doc_id", filters.junk_title(F.col("headline"), F.lit("")).alias("junk"))


@query("paywalled_pages", f"SELECT page_id, list_has_any(list_transform(range(1, len(string_split(lower({HOST_SQL}), '.')) + 1), lambda i: array_to_string(string_split(lower({HOST_SQL}), '.')[i:], '.')), ['example.net', 'ththed.example.org']) AS paywalled FROM pages")
def paywalled_pages(spark, sf_dir):
    """FLT-08: the host is a listed domain or under one."""
    return base.table(spark, sf_dir, "pages").select("page_id", filters.on_domain(T.netloc(F.col("url")), ["example.net", "ththed.example.org"]).alias("paywalled"))
