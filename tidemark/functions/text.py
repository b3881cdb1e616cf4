"""Text and url functions as column expressions; all of them stay inside the JVM."""

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words, parameters and suffixes that results depend on.
TRACKING = ("utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content", "ns_mchannel", "ns_campaign", "ito", "ICID", "fbclid", "gclid", "at_medium", "at_campaign", "CMP", "cmp", "utm_id", "ref", "sh", "oc", "guccounter")
ID_PARAMETER = r"(?i)^(article_?id|story_?id|news_?id|item_?id|post_?id|page_?id|thread_?id|show_?id|video_?id|a?id|nid|sid|pid|p)$"
TITLE_STOP = ("the", "and", "for", "with", "that", "from", "have", "has", "was", "are", "will", "says", "said", "over", "after", "into", "amid", "his", "her", "their", "its", "new", "not", "but", "who", "what", "how", "why")
WORD_STOP = ("the", "and", "for", "over", "with", "that", "from", "have", "has", "was", "are", "will", "says", "said", "into", "amid", "his", "her", "their", "its", "new", "not", "but", "who", "what", "how", "why", "after", "before", "they")
SUFFIXES = ("ational", "ing", "edly", "ies", "ed", "es", "s")
FORMAT_LABELS = ("opinion", "opinions", "comment", "commentary", "analysis", "editorial", "column", "podcast", "listen")

NETLOC = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"
PATH = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)"
QUERY = r"^[^?#]*\?([^#]*)"


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def words(c: Column) -> Column:
    """The non-empty pieces between spaces."""
    return F.filter(F.split(c, " +"), lambda w: w != "")


def netloc(url: Column) -> Column:
    return F.regexp_extract(text_or_empty(url), NETLOC, 1)


def path(url: Column) -> Column:
    return F.regexp_extract(text_or_empty(url), PATH, 1)


def query_of(url: Column) -> Column:
    return F.regexp_extract(text_or_empty(url), QUERY, 1)


def url_key(url: Column) -> Column:
    """Host without www., path, both lowered, and the sorted parameters that name an article."""
    base = F.concat(F.replace(F.lower(netloc(url)), F.lit("www."), F.lit("")), F.lower(F.regexp_replace(path(url), "/+$", "")))
    pairs = F.filter(F.split(query_of(url), "&"), lambda kv: (F.instr(kv, "=") > 0) & (F.substring_index(kv, "=", 1) != kv) & (F.char_length(kv) > F.instr(kv, "=")) & F.rlike(F.substring_index(kv, "=", 1), F.lit(ID_PARAMETER)))
    kept = F.array_sort(F.transform(pairs, lambda kv: F.concat(F.lower(F.substring_index(kv, "=", 1)), F.substr(kv, F.instr(kv, "=")))))
    return F.concat(base, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))


def history_key(url: Column) -> Column:
    """The older key of past editions: no query at all, only a leading www. dropped."""
    return F.regexp_replace(F.concat(F.regexp_replace(F.lower(netloc(url)), r"^www\.", ""), F.lower(path(url))), "/+$", "")


def clean_url(url: Column) -> Column:
    """Without fragment, tracking parameters and trailing slashes; https where no scheme is given."""
    scheme = F.regexp_extract(text_or_empty(url), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    kept = F.filter(F.split(query_of(url), "&"), lambda kv: (kv != "") & ~F.substring_index(kv, "=", 1).isin(*TRACKING))
    kept = F.transform(kept, lambda kv: F.when(F.instr(kv, "=") > 0, kv).otherwise(F.concat(kv, F.lit("="))))
    place = F.regexp_replace(path(url), "/+$", "")
    out = F.concat(F.when(scheme == "", "https").otherwise(F.lower(scheme)), F.lit("://"), netloc(url), F.when(place == "", "/").otherwise(place), F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""))
    return F.when(text_or_empty(url) == "", "").otherwise(out)


def outlet_host(url: Column) -> Column:
    return F.regexp_replace(F.lower(netloc(url)), r"^(www|rss|feeds|amp|wp)\.", "")


def unwrapped(url: Column, wrapper: str = "bing.com/news/apiclick") -> Column:
    """The url parameter of a click wrapper, decoded; other urls as they are."""
    inner = F.regexp_extract(url, r"[?&]url=([^&#]+)", 1)
    return F.when(F.contains(url, F.lit(wrapper)) & (inner != ""), F.try_url_decode(inner)).otherwise(url)


def feed_label(title: Column) -> Column:
    return F.regexp_replace(text_or_empty(title), r"\s*\(bing:[^)]*\)\s*$", "")


def slug(text: Column, most: int) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(text_or_empty(text)), "['’‘\"“”]", ""), "[^a-z0-9]+", "-")
    return F.substring_index(F.regexp_replace(plain, "^-+|-+$", ""), "-", most)


def title_key(title: Column, most: int = 8) -> Column:
    """The first eight telling words, sorted."""
    plain = F.regexp_replace(F.lower(text_or_empty(title)), "[^a-z0-9 ]", " ")
    telling = F.filter(words(plain), lambda w: (F.char_length(w) > 3) & ~w.isin(*TITLE_STOP))
    return F.array_join(F.array_sort(F.slice(telling, 1, most)), " ")


def _accents() -> tuple[str, str, list]:
    """Letters of the Latin blocks that decompose into one ASCII letter, and those into several."""
    single, plain, several = [], [], []
    for code in [*range(0xA0, 0x250), *range(0x1E00, 0x1F00), *range(0xFB00, 0xFB07)]:
        folded = unicodedata.normalize("NFKD", chr(code)).encode("ascii", "ignore").decode()
        if len(folded) == 1:
            single.append(chr(code))
            plain.append(folded)
        elif folded:
            several.append((chr(code), folded))
    return "".join(single), "".join(plain), several


ACCENTED, PLAIN, SEVERAL = _accents()


def deaccented(c: Column) -> Column:
    """Accents folded to ASCII, what has no ASCII form dropped."""
    out = F.translate(text_or_empty(c), ACCENTED, PLAIN)
    for letter, folded in SEVERAL:
        if unicodedata.category(letter).startswith("L"):
            out = F.replace(out, F.lit(letter), F.lit(folded))
    return F.regexp_replace(out, r"[^\x00-\x7F]", "")


def stem(w: Column) -> Column:
    """The first suffix that leaves four letters goes; ies becomes y."""
    out = None
    for s in SUFFIXES:
        fits = F.endswith(w, F.lit(s)) & (F.char_length(w) - len(s) >= 4)
        short = F.substr(w, F.lit(1), F.char_length(w) - F.lit(len(s)))
        value = F.concat(short, F.lit("y")) if s == "ies" else short
        out = F.when(fits, value) if out is None else out.when(fits, value)
    return out.otherwise(w)


def significant(headline: Column) -> Column:
    """The set of stems of words over three letters."""
    plain = F.regexp_replace(F.lower(deaccented(headline)), "[^a-z0-9 ]", " ")
    return F.array_distinct(F.transform(F.filter(words(plain), lambda w: (F.char_length(w) > 3) & ~w.isin(*WORD_STOP)), stem))


def straight_quotes(c: Column) -> Column:
    return F.translate(text_or_empty(c), "‘’ʼ“”", "'''\"\"")


def unquoted(c: Column) -> Column:
    return F.regexp_replace(text_or_empty(c), "[\"“][^\"”]{15,}[\"”]", " ")


def text_id(c: Column) -> Column:
    """Twelve hex digits that change with the text."""
    plain = F.regexp_replace(text_or_empty(c), r"(?U)^\s+|\s+$", "")
    return F.when(plain == "", "none").otherwise(F.substring(F.sha1(F.encode(F.substring(plain, 1, 2000), "UTF-8")), 1, 12))


def real_summary(summary: Column, headline: Column, most: int = 300) -> Column:
    """The summary, where it has three words of four letters that the headline lacks."""
    four = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(text_or_empty(c)), F.lit("([a-z]{4,})"), F.lit(1)))
    return F.when(F.size(F.array_except(four(summary), four(headline))) >= 3, F.substring(summary, 1, most)).otherwise("")


def without_echo(c: Column, n: int = 8, within: int = 700) -> Column:
    """If the first words come again near the start, the text from there on."""
    head = F.array_join(F.slice(words(c), 1, n), " ")
    place = F.call_function("locate", head, F.substr(c, F.lit(1), F.lit(within)), F.char_length(head) + 1)
    return F.when((F.size(words(c)) > n) & (place > 0), F.substr(c, place)).otherwise(c)


def outlet_key(name: Column) -> Column:
    plain = F.regexp_replace(F.regexp_replace(F.lower(text_or_empty(name)), "^the ", ""), "[^a-z0-9]+", " ")
    return F.array_join(F.slice(words(plain), 1, 2), " ")


def headline(text: Column, most: int = 150) -> Column:
    """A document's headline: the start of its text on one line."""
    return F.translate(F.substring(text_or_empty(text), 1, most), "\n", " ")
