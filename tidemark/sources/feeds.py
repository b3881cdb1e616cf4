"""Feed scans: XML and JSON bodies that are string columns, one typed row for each entry."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates

RSS = "title string, link string, guid string, pubDate string, date string, author string, creator string, source string, description string, category array<string>"
ATOM = "title string, id string, published string, updated string, summary string, link array<struct<_href string, _rel string>>, author struct<name string>, category array<struct<_term string>>"
#: Summaries are cut when parsed.
SUMMARY = 400


def repaired(body: Column) -> Column:
    """XML that a strict parser takes: no control bytes, bare ampersands escaped, junk before the first element dropped; null for HTML."""
    plain = F.regexp_replace(body, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F\\uFFFD]", "")
    plain = F.regexp_replace(plain, "&(?!#?[A-Za-z0-9]{1,8};)", "&amp;")
    plain = F.regexp_replace(plain, "^[^<]+", "")
    return F.when(~F.rlike(plain, F.lit("(?i)^<(!doctype html|html)")), plain)


def plain_text(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.regexp_replace(c, "<[^>]*>", " "), "\\s+", " "))


def items_of(bodies: DataFrame, column: str, tag: str) -> DataFrame:
    """A row for each element of a body, with the body's other columns; xml holds the element."""
    found = F.regexp_extract_all(column, F.lit(f"(?is)(<{tag}[\\s>].*?</{tag}>)"), F.lit(1))
    return bodies.select("*", F.explode(found).alias("xml")).drop(column)


def rss_items(rows: DataFrame, column: str) -> DataFrame:
    """Entries of RSS items: link falls back to guid, date to dc:date, author to dc:creator."""
    body = F.regexp_replace(F.col(column), "<(/?)dc:", "<$1")
    parsed = rows.withColumn("__x", F.from_xml(body, RSS))
    blank = lambda c: F.nullif(F.trim(F.col(c)), F.lit(""))
    return parsed.select(
        *[c for c in rows.columns if c != column],
        F.col("__x.title").alias("title"),
        F.coalesce(blank("__x.link"), blank("__x.guid")).alias("link"),
        dates.parse_date(F.coalesce(blank("__x.pubDate"), blank("__x.date"))).alias("published"),
        F.coalesce(blank("__x.author"), blank("__x.creator"), F.lit("")).alias("author"),
        F.coalesce(F.col("__x.source"), F.lit("")).alias("source"),
        F.substring(plain_text(F.coalesce(F.col("__x.description"), F.lit(""))), 1, SUMMARY).alias("summary"),
        F.coalesce(F.col("__x.category"), F.array().cast("array<string>")).alias("categories"),
    )


def atom_items(rows: DataFrame, column: str) -> DataFrame:
    """Entries of Atom: the alternate link, published before updated, terms as categories."""
    parsed = rows.withColumn("__x", F.from_xml(F.col(column), ATOM))
    alternate = F.filter("__x.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    return parsed.select(
        *[c for c in rows.columns if c != column],
        F.col("__x.title").alias("title"),
        F.get(alternate, F.lit(0))["_href"].alias("link"),
        dates.parse_date(F.coalesce("__x.published", "__x.updated")).alias("published"),
        F.coalesce("__x.author.name", F.lit("")).alias("author"),
        F.substring(plain_text(F.coalesce(F.col("__x.summary"), F.lit(""))), 1, SUMMARY).alias("summary"),
        F.transform("__x.category", lambda x: x["_term"]).alias("categories"),
    )


def sitemap_items(rows: DataFrame, column: str) -> DataFrame:
    """News sitemap entries: only those with a news block; publication_date, not lastmod."""
    field = lambda tag: F.nullif(F.trim(F.regexp_extract(column, f"(?is)<{tag}>\\s*(?:<!\\[CDATA\\[)?(.*?)(?:\\]\\]>)?\\s*</{tag}>", 1)), F.lit(""))
    return rows.where(F.contains(F.col(column), F.lit("<news:news"))).select(
        *[c for c in rows.columns if c != column],
        field("news:title").alias("title"),
        field("loc").alias("link"),
        dates.parse_date(field("news:publication_date")).alias("published"),
        F.transform(F.split(F.coalesce(field("news:keywords"), F.lit("")), ","), lambda x: F.trim(x)).alias("categories"),
    )


def stream_items(rows: DataFrame, column: str, item: str) -> DataFrame:
    """Items of JSON bodies {items: [...]}; a body without items gives none (see broken_bodies)."""
    parsed = rows.withColumn("__x", F.from_json(F.col(column), f"items array<struct<{', '.join(f.strip().replace(' ', ': ', 1) for f in item.split(','))}>>"))
    return parsed.select(*[c for c in rows.columns if c != column], F.inline("__x.items"))


def broken_bodies(rows: DataFrame, column: str) -> DataFrame:
    """Bodies that are no item stream: the scan's errors, to be checked for being empty."""
    return rows.where(F.get_json_object(column, "$.items").isNull())


def catalogue(lines: DataFrame) -> DataFrame:
    """Source lines `mode | category | title | target [| window=NNNh] [| max=NNN]` as rows; comments go."""
    plain = lines.select(F.trim(F.regexp_replace("value", "\\s+#.*$", "")).alias("v")).where("v <> '' AND NOT startswith(v, '#')")
    parts = F.transform(F.split("v", "\\|"), lambda x: F.trim(x))
    out = plain.select(parts.alias("p")).where("size(p) >= 2")
    option = lambda name: F.nullif(F.regexp_extract(F.array_join("p", "|"), f"\\|{name}=([0-9]+)h?", 1), F.lit("")).cast("int")
    return out.select(F.lower(F.get("p", F.lit(0))).alias("mode"), F.get("p", F.lit(1)).alias("category"), F.get("p", F.lit(2)).alias("title"), F.get("p", F.lit(3)).alias("target"), option("window").alias("window_hours"), option("max").alias("most"))


def opml(bodies: DataFrame, column: str) -> DataFrame:
    """(category, title, url) of the feeds in OPML outlines."""
    groups = F.regexp_extract_all(column, F.lit('(?is)(<outline(?![^>]*xmlUrl)[^>]*>.*?</outline>)'), F.lit(1))
    each = bodies.select(F.explode(groups).alias("g")).select(F.regexp_extract("g", '(?:title|text)="([^"]*)"', 1).alias("category"), F.regexp_extract_all("g", F.lit("(<outline[^>]*xmlUrl[^>]*>)"), F.lit(1)).alias("o"))
    return each.select("category", F.explode("o").alias("o")).select("category", F.regexp_extract("o", '(?:title|text)="([^"]*)"', 1).alias("title"), F.regexp_extract("o", 'xmlUrl="([^"]*)"', 1).alias("url"))


def united_sources(extras: DataFrame, listed: DataFrame, disabled: list, key: str = "url") -> DataFrame:
    """Extras before the list, one row for each url whatever its scheme, without disabled ones."""
    both = extras.withColumn("__p", F.lit(0)).unionByName(listed.withColumn("__p", F.lit(1)))
    for part in disabled:
        both = both.where(~F.contains(F.col(key), F.lit(part)))
    same = F.regexp_replace(key, "^http://", "https://")
    best = both.groupBy(same.alias("__key")).agg(F.min_by(F.struct(*listed.columns), F.struct("__p", key)).alias("r"))
    return best.select("r.*")
