"""Text, url, date and title functions, and the scans."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates, mastheads
from tidemark.functions import text as T
from tidemark.sources import feeds, html


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "v string").select(function(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize(("url", "key"), [
    ("https://www.Example.org/A/b/", "example.org/a/b"),
    ("http://example.org/a?utm_source=x&id=7", "example.org/a?id=7"),
    ("https://example.org/p?b=1&nid=Z&ID=3#f", "example.org/p?id=3&nid=Z"),
    ("https://example.org/p?id=", "example.org/p"),
    ("", ""),
    (None, ""),
])
def test_url_key(spark, url, key):
    assert one(spark, url, T.url_key) == key


def test_urls(spark):
    assert one(spark, "https://a.org/x/?utm_id=1&q=2#z", T.clean_url) == "https://a.org/x?q=2"
    assert one(spark, "//a.org", T.clean_url) == "https://a.org/"
    assert one(spark, "https://WWW.a.org/X?q=1", T.history_key) == "a.org/x"
    assert one(spark, "https://rss.a.org/x", T.outlet_host) == "a.org"
    assert one(spark, "http://www.bing.com/news/apiclick.aspx?ref=x&url=https%3a%2f%2fa.org%2fp&c=1", T.unwrapped) == "https://a.org/p"
    assert one(spark, "The Post (bing: church)", T.feed_label) == "The Post"
    assert one(spark, "The Post (New Zealand)", T.feed_label) == "The Post (New Zealand)"


def test_words(spark):
    assert one(spark, "The new Bill will have its second reading today after a vote and a march by many", T.title_key) == "bill many march reading second today vote"
    assert [one(spark, w, T.stem) for w in ("stories", "national", "voting", "allowedly", "banned", "cases", "laws", "was")] == ["story", "national", "voting", "allow", "bann", "case", "laws", "was"]
    assert set(one(spark, "Päivi Räsänen’s visa granted", T.significant)) == {"paivi", "rasanen", "visa", "grant"}
    assert one(spark, "Łódź ﬁnds straße", T.deaccented) == "odz finds strae"
    assert one(spark, "   text ", T.text_id) == one(spark, "text", T.text_id)
    assert one(spark, " \n", T.text_id) == "none"
    assert one(spark, "It's \"New\" & Old -- Day!", lambda c: T.slug(c, 3)) == "its-new-old"
    head = "one two three four five six seven eight"
    assert one(spark, f"{head} menu {head} and then prose", T.without_echo) == f"{head} and then prose"
    assert one(spark, "He said “this is a long quotation” today", T.unquoted) == "He said   today"
    assert one(spark, "The New York Times", T.outlet_key) == "new york"


@pytest.mark.parametrize(("value", "want"), [
    ("Mon, 01 Jan 2024 10:00:00 +0100", dt.datetime(2024, 1, 1, 9)),
    ("1 Jan 2024 10:00:00 GMT", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00Z", dt.datetime(2024, 1, 1, 10)),
    ("2024-01-01T10:00:00+0200", dt.datetime(2024, 1, 1, 8)),
    ("2024-01-01T10:00:00.250+00:00", dt.datetime(2024, 1, 1, 10, 0, 0, 250000)),
    ("2024-01-01", dt.datetime(2024, 1, 1)),
    ("yesterday", None),
    (None, None),
])
def test_dates(spark, value, want):
    got = spark.createDataFrame([(value,)], "v string").select(F.date_format(dates.parse_date(F.col("v")), "yyyy-MM-dd HH:mm:ss.SSS").alias("r")).first().r
    assert got == (want and want.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3])


@pytest.mark.parametrize(("title", "source", "want"), [
    ("Bill passes second reading - The Guardian", "", ("Bill passes second reading", "The Guardian")),
    ("Pope Leo XIV - the first year", "", ("Pope Leo XIV - the first year", "")),
    ("Opinion | Trump and Iran", "", ("Opinion | Trump and Iran", "")),
    ("Persecution of believers – EWTN Great Britain - EWTN UK", "EWTN UK", ("Persecution of believers", "EWTN UK")),
    ("Israel-Gaza war - live updates - BBC", "", ("Israel-Gaza war - live updates", "BBC")),
    (None, None, ("", "")),
])
def test_titles(spark, title, source, want):
    got = mastheads.stripped(spark.createDataFrame([(title, source)], "title string, source string"), "title", "source").first()
    assert (got.title, got.name) == want


def test_titles_count_separators_from_the_left(spark):
    got = mastheads.stripped(spark.createDataFrame([("Of it | | the old news", None)], "title string, source string"), "title", "source").first()
    assert (got.title, got.name) == ("Of it | | the old news", "")
    got = mastheads.stripped(spark.createDataFrame([("One long headline of it | | the old news", None)], "title string, source string"), "title", "source").first()
    assert (got.title, got.name) == ("One long headline of it", "| the old news")


def test_feeds(spark):
    rss = "<rss><channel><item><title>A &amp; B</title><guid>https://a.org/1</guid><dc:date>2024-01-01T10:00:00Z</dc:date><dc:creator>Ann</dc:creator><category>x</category><category>y</category><description>&lt;p&gt;Hi&lt;/p&gt;</description></item></channel></rss>"
    items = feeds.rss_items(feeds.items_of(spark.createDataFrame([(1, rss)], "f long, body string"), "body", "item"), "xml").collect()
    assert [(r.title, r.link, r.author, r.categories, r.summary) for r in items] == [("A & B", "https://a.org/1", "Ann", ["x", "y"], "Hi")]
    atom = '<feed><entry><title>T</title><link rel="self" href="s"/><link rel="alternate" href="https://a.org/2"/><updated>2024-01-02T00:00:00Z</updated><category term="c"/></entry></feed>'
    got = feeds.atom_items(feeds.items_of(spark.createDataFrame([(1, atom)], "f long, body string"), "body", "entry"), "xml").first()
    assert (got.title, got.link, got.categories) == ("T", "https://a.org/2", ["c"]) and got.published is not None
    site = "<urlset><url><loc>https://a.org/3</loc><lastmod>2020-01-01</lastmod><news:news><news:publication_date>2024-01-03</news:publication_date><news:title>N</news:title><news:keywords>k, l</news:keywords></news:news></url><url><loc>https://a.org/4</loc></url></urlset>"
    got = feeds.sitemap_items(feeds.items_of(spark.createDataFrame([(1, site)], "f long, body string"), "body", "url"), "xml").collect()
    assert [(r.title, r.link, r.categories, str(r.published)[:10]) for r in got] == [("N", "https://a.org/3", ["k", "l"], "2024-01-03")]
    assert one(spark, "junk\x01<a>x & y &amp; z</a>", feeds.repaired) == "<a>x &amp; y &amp; z</a>"
    assert one(spark, "<!DOCTYPE html><html></html>", feeds.repaired) is None
    assert feeds.broken_bodies(spark.createDataFrame([('{"items": []}',), ('{"error": 1}',)], "b string"), "b").count() == 1


def test_catalogue(spark):
    lines = spark.createDataFrame([("# note",), ("pass | Law | Court | https://a.org/rss | window=72h | max=9",), ("disable | b.org",), ("",)], "value string")
    rows = feeds.catalogue(lines).collect()
    assert [(r.mode, r.category, r.title, r.target, r.window_hours, r.most) for r in rows] == [("pass", "Law", "Court", "https://a.org/rss", 72, 9), ("disable", "b.org", None, None, None, None)]
    outline = '<opml><outline title="Law"><outline text="Court" xmlUrl="https://a.org/f"/><outline text="Bar" xmlUrl="http://b.org/f"/></outline></opml>'
    listed = feeds.opml(spark.createDataFrame([(outline,)], "b string"), "b")
    extra = spark.createDataFrame([("Law", "Own", "http://a.org/f")], "category string, title string, url string")
    got = {(r.title, r.url) for r in feeds.united_sources(extra, listed, ["b.org"]).collect()}
    assert got == {("Own", "http://a.org/f")}


def test_pages(spark):
    page = '<html><head><meta name="author" content="By Ann Bee"><meta property="article:section" content="Law"><link rel="canonical" href="https://a.org/c"></head><body><nav><a href="/n">Nav</a></nav><p>Short.</p><p>' + "word " * 30 + "</p></body></html>"
    df = spark.createDataFrame([(1, page)], "id long, html string")
    assert df.select(html.byline(F.col("html")).alias("a"), html.page_section(F.col("html")).alias("s"), html.canonical(F.col("html")).alias("c")).first() == ("Ann Bee", "Law", "https://a.org/c")
    prose = html.paragraphs(df, "id", "html").where(html.is_prose(F.col("para"))).collect()
    assert len(prose) == 1 and prose[0].para.startswith("word word")
