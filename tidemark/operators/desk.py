"""Leads, suppression and credit: what a desk decides about rows, with vocabularies that are the caller's.

A vocabulary here is {name: pattern}; a pattern that is absent never matches.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.classify import matches

TIER_BUMP, ACTION_BUMP = 6, 3
FULL_REGIONS, OWN_SLACK = ("UK", "Ireland"), 1.0


def found(text: Column, vocabulary: dict, name: str) -> Column:
    pattern = vocabulary.get(name)
    return F.lit(False) if pattern is None else matches(F.coalesce(text, F.lit("")), pattern)


def rank_score(score: Column, source_tier: Column, action: Column) -> Column:
    """The score, six for a followed outlet and three for an action."""
    return score + F.when(source_tier, TIER_BUMP).otherwise(0) + F.when(action, ACTION_BUMP).otherwise(0)


def cluster_leads(rows: DataFrame, cluster: str, id_column: str, relay: Column, unreadable: Column, rank: Column, issued: Column, primary: Column) -> DataFrame:
    """(cluster, lead, issuing): of every cluster the row that speaks for it.

    Relays come last, then unreadable links, then the higher rank leads, ties by id. But the earliest
    primary source leads that is no relay, can be read, has a date, and that no other outlet of the
    cluster precedes; an outlet without a date may have preceded it, and a cluster of primary sources
    alone has nobody to precede. One aggregation by cluster, combined before the shuffle.
    """
    usable = primary & ~relay & ~unreadable & issued.isNotNull()
    marked = rows.select(F.col(cluster).alias("cluster"), F.col(id_column).alias("id"), F.struct(relay, unreadable, -rank, F.col(id_column)).alias("key"), issued.alias("at"), primary.alias("own"), usable.alias("usable"))
    facts = marked.groupBy("cluster").agg(
        F.min_by("id", "key").alias("best"),
        F.min_by("id", F.when(F.col("usable"), F.struct("at", "key"))).alias("early"),
        F.min(F.when(F.col("usable"), F.col("at"))).alias("early_at"),
        F.min(F.when(~F.col("own"), F.col("at"))).alias("others_at"),
        F.count(F.when(~F.col("own"), 1)).alias("others"),
        F.count(F.when(~F.col("own") & F.col("at").isNull(), 1)).alias("undated"),
    )
    issuing = F.coalesce((F.col("others") > 0) & (F.col("undated") == 0) & (F.col("early_at") <= F.col("others_at")), F.lit(False))
    return facts.select("cluster", F.when(issuing, F.col("early")).otherwise(F.col("best")).alias("lead"), issuing.alias("issuing"))


def cluster_marks(members: DataFrame, importance: str, comment: str, followed: str) -> DataFrame:
    """(id, lead, mark) of rows (cluster, id, ...): lead, also, or duplicate; clusters of one have no mark.

    The report of the greatest importance leads, or, where all are comment, the greatest comment; ties by
    id. Comment of a followed outlet stands beside it.
    """
    key = F.struct(F.col(comment), -F.col(importance), F.col("id"))
    leads = members.groupBy("cluster").agg(F.min_by("id", key).alias("lead"), F.count("*").alias("n")).where("n > 1").drop("n")
    mark = F.when(F.col("id") == F.col("lead"), "lead").when(F.col(comment) & F.col(followed), "also").otherwise("duplicate")
    return members.join(leads, "cluster").select("id", "lead", mark.alias("mark"))


def name_collision(headline: Column, words: dict) -> Column:
    """A subject's word as a person's name: organisations clear it, brands prove it, context rescues it, and a person's company decides."""
    return F.when(found(headline, words, "organisation"), False).when(found(headline, words, "brand"), True).when(found(headline, words, "rescue"), False).otherwise(found(headline, words, "collision") & found(headline, words, "person"))


#: The order of suppression; a rescue inside a step belongs to that step alone.
STEPS = ("excluded", "index", "blocked", "spam", "sport outlet", "gossip", "entertainment", "collision", "school sport", "regional marriage", "filler tag", "roundup", "celebrity outlet", "hard", "filler")


def suppression(headline: Column, outlet: Column, tagged: Column, words: dict) -> Column:
    """Why a row is filler, null where it is not: the first of fifteen steps that holds.

    The celebrity outlet's step decides: a row of such an outlet with a kept subject passes the rest.
    """
    on = lambda name: found(headline, words, name)
    by = lambda name: found(outlet, words, name)
    steps = {
        "excluded": on("excluded"),
        "index": on("index"),
        "blocked": by("blocked"),
        "spam": on("spam"),
        "sport outlet": by("sports outlets"),
        "gossip": on("gossip") & ~on("civic"),
        "entertainment": by("entertainment desks") & ~on("civic"),
        "collision": name_collision(headline, words),
        "school sport": on("school sport") & ~on("rescue"),
        "regional marriage": on("regional marriage") & ~on("civic"),
        "filler tag": F.coalesce(tagged, F.lit(False)),
        "roundup": on("roundup"),
    }
    out = None
    for name, holds in steps.items():
        out = F.when(holds, name) if out is None else out.when(holds, name)
    out = out.when(by("celebrity outlets"), F.when(~on("celebrity kept"), "celebrity outlet"))
    return out.when(on("hard"), "hard").when(on("filler") & ~on("filler rescue"), "filler")


def local_incident(headline: Column, section: Column, score: Column, words: dict, residual: tuple) -> Column:
    """An incident without an issue: never in a residual section or with an anchor; road traffic at any score, others at two or less."""
    outside = F.coalesce(section.isin(*residual), F.lit(False)) | found(headline, words, "issue")
    return ~outside & (found(headline, words, "road") | ((score <= 2) & found(headline, words, "incident")))


def school_matter(headline: Column, score: Column, words: dict) -> Column:
    """`routine` at a score of four or less, `crime` at three or less, null with an anchor of policy."""
    anchored = found(headline, words, "education")
    crime = (score <= 3) & found(headline, words, "school") & found(headline, words, "school crime")
    return F.when(anchored, None).when((score <= 4) & found(headline, words, "routine"), "routine").when(crime, "crime")


def reaches(blocked: Column, reason: Column, section: Column) -> Column:
    """A row that is neither blocked nor filler and that a section takes."""
    return ~F.coalesce(blocked, F.lit(False)) & reason.isNull() & section.isNotNull()


def closed(aliases: dict) -> dict:
    """Aliases followed to their end; a circle ends where it was entered."""
    out = {}
    for name in aliases:
        seen, last = {name}, aliases[name]
        while last in aliases and last not in seen:
            seen.add(last)
            last = aliases[last]
        out[name] = last
    return out


def looked_up(name: Column, table: dict) -> Column:
    """A value of a table that is code or configuration, null where it has none."""
    return F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[name] if table else F.lit(None).cast("string")


def tidy_outlet(name: Column, aliases: dict, hosts: dict) -> Column:
    """An outlet's name: bars spaced, aliases to their end, feed labels off, a bare host by its name, loose separators off."""
    table = closed(aliases)
    spaced = F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), r"\s*\|\s*", " | ")
    plain = F.trim(F.regexp_replace(F.coalesce(looked_up(spaced, table), spaced), r"\s*[|:-]\s*(RSS|News Feed|Feed)\s*$", ""))
    host = F.regexp_replace(F.lower(plain), r"^(https?://)?(www\.)?", "")
    canon = looked_up(host, {h: table.get(n, n) for h, n in hosts.items()})
    shaped = F.rlike(plain, F.lit(r"(?i)^(https?://)?(www\.)?[a-z0-9-]+(\.[a-z0-9-]+)+$"))
    return F.trim(F.regexp_replace(F.when(shaped, F.coalesce(canon, plain)).otherwise(plain), r"\s*[|\-–—:]\s*$", ""))


def overridden(rows: DataFrame, text: Column, overrides: list, out: str) -> DataFrame:
    """Add the value of the first override (part, value) whose part stands in the lower-cased text.

    The list is configuration and stays an expression; a list that is a table belongs into places.longest.
    """
    hay = F.lower(text)
    options = [F.when(F.contains(hay, F.lit(part.lower())), F.lit(value)) for part, value in overrides]
    return rows.withColumn(out, F.coalesce(*options) if options else F.lit(None).cast("string"))


def credit(outlet: Column, republisher: Column, paywalled: Column, author: Column, commentary: Column, skipped: tuple) -> Column:
    """"- Outlet (£) | Author": the page's own publisher before the feed's name, whose paywall mark it drops; authors of comment alone."""
    name = F.coalesce(republisher, outlet)
    marked = paywalled & (name == outlet)
    line = F.concat(F.lit("- "), name, F.when(marked, " (£)").otherwise(""))
    by = F.trim(F.coalesce(author, F.lit("")))
    by = F.when(F.contains(by, F.lit("@")) | F.startswith(by, F.lit("http")), "").otherwise(by)
    shown = (by != "") & commentary & ~F.lower(by).isin(*skipped) & (F.lower(by) != F.lower(name))
    return F.concat(line, F.when(shown, F.concat(F.lit(" | "), by)).otherwise(""))


def truncated(url: Column) -> Column:
    """A link that lost its end: no host with a dot, a dangling mark, or a parameter without a value."""
    u = F.rtrim(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(u, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)
    query = F.regexp_extract(u, r"\?([^#]*)", 1)
    return ~F.contains(host, F.lit(".")) | F.rlike(u, F.lit(r"[?&=]$")) | F.exists(F.split(query, "&"), lambda kv: (kv != "") & ~F.contains(kv, F.lit("=")))


# Parts of a path, and parameters, of a page that lists others.
INDEX_PATH = r"(?i)/(category|categories|tag|tags|topic|topics|author|authors|archive|archives|section|sections|feed|rss|search|page)(/|$)|/(all|latest|index)(\.\w+)?$"
PAGE_PARAMETER = r"(?i)(^|&)(page|paged|pg|p)=[0-9]+(&|$)"


def lists_others(url: Column) -> Column:
    """A link to a listing and not to a single page."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    path, query = F.regexp_extract(rest, r"^[^?#]*", 0), F.regexp_extract(rest, r"\?([^#]*)", 1)
    return path.isin("", "/") | F.rlike(path, F.lit(INDEX_PATH)) | F.rlike(query, F.lit(PAGE_PARAMETER))


def display(kind: Column, document: Column, update: Column, places: Column) -> Column:
    """What is known of a text in a few words; empty where nothing is."""
    parts = F.array(kind, F.when(document, "doc"), F.when(update, "update"), F.when(F.size(places) > 0, F.array_join(F.slice(places, 1, 2), "/")).otherwise("unplaced"))
    return F.when(kind.isNull(), "").otherwise(F.array_join(F.filter(parts, lambda x: x.isNotNull()), " "))


def text_route(routes: dict) -> Column:
    """The name of the first route (in order) that has a text."""
    return F.coalesce(*[F.when(F.coalesce(text, F.lit("")) != "", name) for name, text in routes.items()])


def text_depth(region: Column, outlets: Column, event: Column, primary: Column, full: int, short: int) -> Column:
    """How much of a text is shown: all of it for home regions, two outlets, an event of three, or a primary source."""
    return F.when(region.isin(*FULL_REGIONS) | (outlets >= 2) | (event >= 3) | primary, full).otherwise(short)


def bill_core(name: Column) -> Column:
    """The subject of a bill's name: no clause, house, brackets, nor the kind of act."""
    part = F.substring_index(F.coalesce(name, F.lit("")), " - ", 1)
    part = F.regexp_replace(part, r"\[HL\]|\(.*?\)", "")
    part = F.regexp_replace(part, r"(^|[^A-Za-z0-9_])(Bill|Act|Regulations?)(\s+[0-9]{4})?($|[^A-Za-z0-9_])", "$1 $4")
    return F.trim(F.regexp_replace(F.lower(part), r"\s+", " "))


def named(core: Column, text: Column) -> Column:
    """A bill of two words or more is named where its subject stands in the text."""
    return F.contains(core, F.lit(" ")) & F.contains(F.lower(text), core)


def topics(title: Column, excluded: str, table: list, capitals: list) -> Column:
    """Labels of a title: (label, pattern, pattern that forbids it or none), then (label, case-sensitive pattern)."""
    t = F.trim(F.regexp_replace(F.coalesce(title, F.lit("")), r"\s+", " "))
    labels = [F.when(matches(t, on) & (~matches(t, off) if off else F.lit(True)), label) for label, on, off in table]
    labels += [F.when(F.rlike(t, F.lit(p)), label) for label, p in capitals]
    known = F.array_distinct(F.filter(F.array(*labels), lambda x: x.isNotNull()))
    return F.when((t == "") | matches(t, excluded), F.array().cast("array<string>")).otherwise(known)


def outside_window(rows: DataFrame, age: str, own: Column, window: float) -> DataFrame:
    """Rows older than their own source allows, or the sweep where that is more, and an hour: none, if windows are kept."""
    return rows.where(F.col(age) > F.greatest(own, F.lit(float(window))) + OWN_SLACK)


def healthy(candidates: Column, failed: Column, least: int = 60, most: int = 40) -> Column:
    """Whether a sweep may be published: enough candidates and not too many failed feeds."""
    return F.when(candidates < least, "too few candidates").when(failed > most, "too many failed feeds").otherwise("ok")
