"""HTML scans with regular expressions, for pages that are one string column."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Elements whose content is never prose.
CHROME_TAGS = ("script", "style", "nav", "header", "footer", "aside", "form", "noscript", "svg")
ANCHOR = '(?is)<a\\s[^>]*href="([^"]*)"[^>]*>([^<]*)</a>'


def without_chrome(html: Column) -> Column:
    """One pattern for each element: a back-reference would not run in every engine."""
    for tag in CHROME_TAGS:
        html = F.regexp_replace(html, f"(?is)<{tag}[^>]*>.*?</{tag}>", " ")
    return F.regexp_replace(html, "(?s)<!--.*?-->", " ")


def links(pages: DataFrame, id_column: str, html_column: str) -> DataFrame:
    """(id, pos, href, title) of every anchor."""
    found = lambda group: F.regexp_extract_all(html_column, F.lit(ANCHOR), F.lit(group))
    both = pages.select(id_column, F.arrays_zip(found(1).alias("href"), found(2).alias("title")).alias("a"))
    return both.select(id_column, F.posexplode("a").alias("pos", "x")).select(id_column, "pos", "x.href", "x.title")


def paragraphs(pages: DataFrame, id_column: str, html_column: str) -> DataFrame:
    """(id, para): text between block elements."""
    blocks = F.split(F.regexp_replace(without_chrome(F.col(html_column)), "(?i)</?(p|div|br|h[1-6]|li|tr)[^>]*>", "\u0001"), "\u0001")
    each = pages.select(id_column, F.explode(blocks).alias("raw"))
    return each.select(id_column, F.trim(F.regexp_replace(F.regexp_replace("raw", "<[^>]*>", " "), "[ \\t\\r\\n]+", " ")).alias("para"))


def is_prose(para: Column, least: int = 80, share: float = 0.8) -> Column:
    letters = F.char_length(F.regexp_replace(para, "[^A-Za-zÀ-ÿ ]", ""))
    return (F.char_length(para) >= least) & (letters >= F.lit(share) * F.char_length(para))


def byline(html: Column, most: int = 40) -> Column:
    """The first plausible author among the places pages name one."""
    patterns = ('(?is)<meta[^>]*name="author"[^>]*content="([^"]+)"', '(?is)<meta[^>]*property="article:author"[^>]*content="([^"]+)"', '(?is)"author"\\s*:\\s*\\{[^}]*"name"\\s*:\\s*"([^"]+)"', '(?is)rel="author"[^>]*>([^<]+)<', '(?is)class="[^"]*byline[^"]*"[^>]*>\\s*(?:By\\s+)?([^<]+)<')
    out = []
    for p in patterns:
        name = F.trim(F.regexp_replace(F.regexp_extract(html, p, 1), "(?i)^by ", ""))
        out.append(F.when((name != "") & ~F.contains(name, F.lit("http")) & (F.char_length(name) <= most) & (F.size(F.split(name, " ")) <= 6), name))
    return F.coalesce(*out)


def page_section(html: Column) -> Column:
    """The page's section: a meta element, then linked data, then a class of the body."""
    patterns = ('(?is)<meta[^>]*property="article:section"[^>]*content="([^"]+)"', '(?is)"articleSection"\\s*:\\s*\\[?\\s*"([^"]+)"', '(?is)<body[^>]*class="[^"]*\\bsection-([a-z-]+)')
    return F.coalesce(*[F.nullif(F.regexp_extract(html, p, 1), F.lit("")) for p in patterns])


def canonical(html: Column) -> Column:
    return F.nullif(F.regexp_extract(html, '(?is)<link[^>]*rel="canonical"[^>]*href="([^"]+)"', 1), F.lit(""))
