"""Queries over semi-structured scans: HTML, XML and JSON."""

from functools import partial

from pyspark.sql import functions as F

from tidemark.plans import base
from tidemark.sources import feeds, html

QUERIES: dict = {}
SQL: dict = {}
query = partial(base.register, QUERIES, SQL)

CHROME_SQL = "html"
for _tag in html.CHROME_TAGS:
    CHROME_SQL = f"regexp_replace({CHROME_SQL}, '(?is)<{_tag}[^>]*>.*?</{_tag}>', ' ', 'g')"
CHROME_SQL = f"regexp_replace({CHROME_SQL}, '(?s)<!--.*?-->', ' ', 'g')"


@query("html_links_pages", """WITH a AS (SELECT page_id, regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 1) AS h, regexp_extract_all(html, '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>', 2) AS t FROM pages),
b AS (SELECT page_id, unnest(range(0, len(h))) AS pos, unnest(h) AS href, unnest(t) AS title FROM a)
SELECT page_id, title, arg_min(href, pos) AS href, CAST(min(pos) AS INTEGER) AS pos FROM b GROUP BY page_id, title""")
def html_links_pages(spark, sf_dir):
    """SRC-10: anchors of a page; the first link of a title wins."""
    links = html.links(base.table(spark, sf_dir, "pages"), "page_id", "html")
    return links.groupBy("page_id", "title").agg(F.min_by("href", "pos").alias("href"), F.min("pos").alias("pos"))


@query("strip_chrome_pages", f"SELECT page_id, length(regexp_replace({CHROME_SQL}, '<[^>]*>', ' ', 'g')) AS chars FROM pages")
def strip_chrome_pages(spark, sf_dir):
    """STR-25's first step."""
    pages = base.table(spark, sf_dir, "pages")
    return pages.select("page_id", F.char_length(F.regexp_replace(html.without_chrome(F.col("html")), "<[^>]*>", " ")).cast("long").alias("chars"))


@query("html_paragraphs_pages", f"""WITH p AS (SELECT page_id, unnest(string_split(regexp_replace({CHROME_SQL}, '(?i)</?(p|div|br|h[1-6]|li|tr)[^>]*>', chr(1), 'g'), chr(1))) AS raw FROM pages),
t AS (SELECT page_id, trim(regexp_replace(regexp_replace(raw, '<[^>]*>', ' ', 'g'), '[ \\t\\r\\n]+', ' ', 'g'), ' ') AS para FROM p)
SELECT page_id, count(*) AS n, sum(length(para)) AS chars FROM t WHERE length(para) >= 80 AND length(regexp_replace(para, '[^A-Za-zÀ-ÿ ]', '', 'g')) >= CAST(0.8 AS DOUBLE) * length(para) GROUP BY page_id""")
def html_paragraphs_pages(spark, sf_dir):
    """SRC-08 and FLT-16: the prose paragraphs of a page."""
    paragraphs = html.paragraphs(base.table(spark, sf_dir, "pages"), "page_id", "html").where(html.is_prose(F.col("para")))
    return paragraphs.groupBy("page_id").agg(F.count("*").alias("n"), F.sum(F.char_length("para")).alias("chars"))


@query("rss_scan_documents", "SELECT doc_id, trim(substr(regexp_replace(text, '[^A-Za-z ]', '', 'g'), 1, 40)) AS title, 'https://' || source || '.example.org/' || doc_id AS link, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL 1 MINUTE * doc_id AS published FROM documents")
def rss_scan_documents(spark, sf_dir):
    """SRC-01: documents written as RSS and read back by the scan."""
    docs = base.table(spark, sf_dir, "documents")
    stamp = F.date_format(F.timestamp_micros(F.unix_micros(F.lit("2024-01-01 00:00:00").cast("timestamp")) + F.col("doc_id") * 60_000_000), "dd MMM yyyy HH:mm:ss")
    title = F.substring(F.regexp_replace("text", "[^A-Za-z ]", ""), 1, 40)
    item = F.concat(F.lit("<item><title><![CDATA["), title, F.lit("]]></title><link>https://"), "source", F.lit(".example.org/"), "doc_id", F.lit("</link><pubDate>Mon, "), stamp, F.lit(" +0000</pubDate></item>"))
    parsed = feeds.rss_items(docs.select("doc_id", item.alias("xml")), "xml")
    return parsed.select("doc_id", "title", "link", F.to_timestamp_ntz(F.date_format("published", "yyyy-MM-dd HH:mm:ss")).alias("published"))


@query("event_props_json", "SELECT event_type, count(*) AS n, sum(CAST(json_extract(props, '$.k') AS BIGINT))::BIGINT AS k FROM events GROUP BY event_type")
def event_props_json(spark, sf_dir):
    """SRC-05's parse step."""
    events = base.table(spark, sf_dir, "events").select("event_type", F.from_json("props", "k long").alias("p"))
    return events.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("p.k").alias("k"))


@query("feed_funnel", """SELECT coalesce(CAST(user_id AS VARCHAR), 'all') AS feed, count(*) AS entries, count(*) FILTER (value IS NOT NULL) AS dated, count(*) FILTER (ts >= TIMESTAMP '2024-01-20') AS in_window, count(*) FILTER (ts >= TIMESTAMP '2024-01-20' AND event_type <> 'error') AS passed FROM events GROUP BY ROLLUP (user_id)""")
def feed_funnel(spark, sf_dir):
    """AGG-08: a funnel by feed, and in total."""
    events = base.table(spark, sf_dir, "events")
    late = F.col("ts") >= F.lit("2024-01-20").cast("timestamp")
    count = lambda c: F.count(F.when(c, 1))
    out = events.rollup("user_id").agg(F.count("*").alias("entries"), count(F.col("value").isNotNull()).alias("dated"), count(late).alias("in_window"), count(late & (F.col("event_type") != "error")).alias("passed"))
    return out.select(F.coalesce(F.col("user_id").cast("string"), F.lit("all")).alias("feed"), "entries", "dated", "in_window", "passed")


@query("search_gate", """WITH p AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS para, unnest(range(0, len(string_split(text, chr(10))))) AS pos FROM documents),
s AS (SELECT *, 2 * CAST(contains(lower(para), 'than') AS INTEGER) + 3 * CAST(contains(lower(para), 'thing') AS INTEGER) AS score FROM p),
b AS (SELECT doc_id, text, max(score) AS score, arg_min(para, (-score, pos)) AS best FROM s GROUP BY doc_id, text)
SELECT doc_id, CASE WHEN contains(lower(substr(text, 1, 60)), 'thing') THEN 'headline' ELSE 'paragraph' END AS rule, CASE WHEN contains(lower(substr(text, 1, 60)), 'thing') THEN '' ELSE substr(best, 1, 300) END AS summary FROM b WHERE contains(lower(substr(text, 1, 60)), 'thing') OR score >= 3""")
def search_gate(spark, sf_dir):
    """SRC-07: a headline passes by itself, else by its best paragraph. The cheap rule is a branch of its own."""
    docs = base.table(spark, sf_dir, "documents")
    head = F.contains(F.lower(F.substring("text", 1, 60)), F.lit("thing"))
    first = docs.where(head).select("doc_id", F.lit("headline").alias("rule"), F.lit("").alias("summary"))
    score = lambda p: 2 * F.contains(F.lower(p), F.lit("than")).cast("int") + 3 * F.contains(F.lower(p), F.lit("thing")).cast("int")
    best = F.array_sort(F.transform(F.split("text", "\n"), lambda p, i: F.struct((-score(p)).alias("s"), i.alias("i"), p.alias("p"))))[0]
    second = docs.where(~head).select("doc_id", best.alias("b")).where("b.s <= -3").select("doc_id", F.lit("paragraph").alias("rule"), F.substring("b.p", 1, 300).alias("summary"))
    return first.unionByName(second)


@query("host_masthead", """SELECT regexp_replace(regexp_extract(url, '://([^/?#]*)', 1), '^(www|m|blog)\\.', '') AS host, min(regexp_extract(html, '<html lang="([a-z]+)"', 1)) AS name FROM pages GROUP BY 1 HAVING count(DISTINCT regexp_extract(html, '<html lang="([a-z]+)"', 1)) = 1""")
def host_masthead(spark, sf_dir):
    """SRC-21, AGG-20: hosts seen under exactly one name; least and greatest name instead of a distinct count."""
    pages = base.table(spark, sf_dir, "pages").select(F.regexp_replace(F.regexp_extract("url", "://([^/?#]*)", 1), r"^(www|m|blog)\.", "").alias("host"), F.regexp_extract("html", '<html lang="([a-z]+)"', 1).alias("name"))
    return pages.groupBy("host").agg(F.min("name").alias("name"), F.max("name").alias("last")).where("name = last").select("host", "name")


@query("link_verification", """SELECT p.url AS missing FROM pages p WHERE p.url NOT IN (SELECT url FROM pages WHERE page_id % 7 <> 0)""")
def link_verification(spark, sf_dir):
    """SNK-13, JON-17: wanted links that an export lacks."""
    pages = base.table(spark, sf_dir, "pages")
    exported = pages.where("page_id % 7 <> 0").select("url")
    return pages.select("url").join(exported, "url", "left_anti").select(F.col("url").alias("missing"))


@query("reader_stream_scan", "SELECT conv_id, turn, role, text AS title, length(text) AS chars FROM conversations")
def reader_stream_scan(spark, sf_dir):
    """SRC-05, SRC-06: conversations written as JSON streams and read back item by item."""
    talk = base.table(spark, sf_dir, "conversations")
    streams = talk.groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct("turn", "role", "text")).alias("items"))).alias("body"))
    items = feeds.stream_items(streams, "body", "turn long, role string, text string")
    return items.select("conv_id", "turn", "role", F.col("text").alias("title"), F.char_length("text").cast("long").alias("chars"))


