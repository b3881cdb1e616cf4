"""Row filters of the intake."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def junk_title(title: Column, outlet: Column) -> Column:
    """Too short, without a letter or digit, the outlet's own name, or a navigation word."""
    t = F.trim(F.coalesce(title, F.lit("")))
    name = F.regexp_replace(F.lower(F.coalesce(outlet, F.lit(""))), "[ .|-]+$", "")
    return (F.char_length(t) < 25) | ~F.rlike(t, F.lit("[\\p{L}\\p{N}]")) | ((name != "") & (F.regexp_replace(F.lower(t), "[ .|-]+$", "") == name)) | F.rlike(t, F.lit("(?i)^(archive|subscribe|sign in|log in)\\b"))


def on_domain(host: Column, domains: list) -> Column:
    """The host is one of the domains or under one: an equality of suffixes, one for each dot of the host."""
    labels = F.split(F.lower(host), "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return F.arrays_overlap(suffixes, F.array(*[F.lit(d) for d in domains]))


def blocked(outlet: Column, link: Column, parts: list) -> Column:
    both = F.lower(F.concat_ws(" ", outlet, link))
    out = F.lit(False)
    for p in parts:
        out = out | F.contains(both, F.lit(p.lower()))
    return out


def comment_piece(headline: Column, text: Column, outlet: Column, mark: str, always: list, sometimes: list, outcome: str) -> Column:
    """A mark in the headline or the text's start; an outlet of argument alone; an outlet of argument without an outcome."""
    has = lambda c, p: F.rlike(F.coalesce(c, F.lit("")), F.lit(f"(?iu){p}"))
    among = lambda names: F.exists(F.array(*[F.lit(n) for n in names]), lambda n: F.contains(F.lower(outlet), n)) if names else F.lit(False)
    return has(headline, mark) | has(F.substring(text, 1, 400), mark) | among(always) | (~has(headline, outcome) & among(sometimes))


def relays(outlet: Column, summary: Column, primary: list, institution: str) -> Column:
    """A primary source whose summary credits another newsroom, not an institution and not itself."""
    is_primary = F.exists(F.array(*[F.lit(p) for p in primary]), lambda p: F.contains(F.lower(outlet), p))
    credits = F.regexp_extract_all(F.coalesce(summary, F.lit("")), F.lit("(?:according to|reported by|told) (?:the )?([A-Z][A-Za-z]+(?: [A-Z][A-Za-z]+)*)"), F.lit(1))
    other = F.filter(credits, lambda n: ~F.rlike(n, F.lit(f"(?iu){institution}")) & ~F.contains(F.lower(outlet), F.lower(n)) & ~F.contains(F.lower(n), F.substring_index(F.lower(outlet), " ", 1)))
    return is_primary & (F.size(other) > 0)


def filler_tags(tags: Column, substantive: str, filler: str) -> Column:
    """No tag of substance, and at least half of the tags (one at least) are filler."""
    hits = F.size(F.filter(tags, lambda t: F.rlike(t, F.lit(f"(?iu){filler}"))))
    return ~F.exists(tags, lambda t: F.rlike(t, F.lit(f"(?iu){substantive}"))) & (hits >= F.greatest(F.lit(1), F.floor(F.size(tags) / 2)))


def confirms(page_words: Column, headline_words: Column) -> Column:
    """A page is the headline's if they share max(3, 0.6 of the headline's) of its words."""
    n = F.size(headline_words)
    return (n >= 3) & (F.size(F.array_intersect(page_words, headline_words)) >= F.greatest(F.lit(3), F.round(F.lit(0.6) * n)))
