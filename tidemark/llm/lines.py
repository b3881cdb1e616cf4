"""Line dedup by an exact set-similarity join (operator 7), in DataFrame functions only.

A line's tokens are its distinct words, cut at ASCII white space. A line is removed if an earlier
line (by doc_id, then place) has a Jaccard of the threshold or more with it; lines without words stay.

1. Equal lines are one; the first is the only one that can stay. They are aggregated in each task
   before the shuffle, so a hot line costs one row a task.
2. Rarity. The words of all these lines are counted in a sketch of fixed size (words share counters),
   which orders all tokens, rarest first, ties by hash. Any one order gives exact results; this one
   makes the rare ones come first.
3. Witnesses. Lines with the same least token hash (as near copies mostly have) are compared with the first
   of them alone, and those that stay once more by their greatest token hash. Those that a witness removes
   need no other, so that a group of near copies costs one pair a copy and not one for every two.
4. Index. A line is indexed under the tokens of its prefix: two lines at or over the threshold share one
   (the smaller by the shorter prefix that suffices for it). They meet by that token and the size class of
   the larger, so that lines of other sizes cost nothing; a class is as wide as the threshold lets sizes
   differ, so the smaller line stands in two or three at most. The rows of a token are joined in one task,
   which holds those of the larger lines (about 70 bytes each), both sides sorted by token, so that rows that
   meet are near each other in memory. Pairs from this join must also pass the
   length filter, the positional filter, which bounds the overlap by what is left after the shared
   token's places, and a parity map, which bounds the difference; two lines that are both removed
   already are no pair, nor is a removed line with an earlier one that stays.
5. Surviving pairs are verified by the exact Jaccard of their words, whose lines are read once; the later line
   of a pair goes. A line is held against the first of its pairs, and if it stays, against the others.

The tables of lines are bucketed by the hash of the line, so that the joins on it shuffle pairs alone.

Tokens travel as 63-bit numbers: 7 bits of rarity over 56 bits of hash; two lines are taken for equal
if 128 bits of hash agree. The threshold counts in thousandths.

Nulls count as empty texts and a null id stands last; rows with the same id are ordered by their
texts' hashes, and rows with the same id and text lose and keep the same lines. An empty table gives
an empty table. Texts of any length are cut into lines; memory is bounded by the longest text. Columns
of any other name are kept; where the caller has one named like a count, the count takes a longer name.
"""

import json
import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

#: Counters of the rarity sketch (a power of two) and how many of them travel in a row.
COUNTERS, CHUNK = 1 << 16, 1 << 12
#: Lines of more tokens have a parity map of two words, as the bits of one would be used up.
WIDE = 100
#: Steps of rarity for each doubling of a count; 127 of them in all.
STEPS = 3
LAST = 2**63 - 1
BLANKS = " \t\x0b\f\r"
BLANK = "[ \\t\\u000B\\f\\r]+"
#: Blanks that a split at single spaces does not cut.
UNUSUAL = ("  ", "\t", "\x0b", "\f", "\r")


def rows_of(docs: DataFrame) -> DataFrame:
    text = common.text_or_empty()
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("h"), text.alias("text"))


def words_in(line: Column) -> Column:
    """The words of a line of equal_lines: its blanks are single spaces already."""
    return F.split(line, " ")


def lines_of(rows: DataFrame) -> DataFrame:
    """(doc, h, line, string) of every line that is not empty, its blanks made single spaces; those of blanks alone become empty."""
    marked = rows.withColumn("odd", reduce(or_, [F.contains("text", F.lit(x)) for x in UNUSUAL]))
    lines = marked.select("doc", "h", "odd", F.posexplode(F.split("text", "\n")).alias("line", "string")).where(F.col("string") != "")
    plain = F.when(F.col("odd"), F.trim(F.regexp_replace("string", BLANK, " "))).otherwise(F.trim("string"))
    return lines.select("doc", "h", "line", plain.alias("string"))


def equal_lines(rows: DataFrame) -> DataFrame:
    """(sid, sid2, doc, h, line, string, mixed): the first of all lines that are equal but for blanks.

    Aggregated by 64 bits alone, by which the table is bucketed; mixed: lines of several second hashes met. Lines
    without words are left out at the end, as a test before the shuffle would trim every line twice.
    """
    lines = lines_of(rows)
    lines = lines.select(F.xxhash64("string").alias("sid"), F.xxhash64(F.lit(1), "string").alias("sid2"), F.struct("doc", "h", "line", "string").alias("place"))
    firsts = lines.groupBy("sid").agg(F.min("place").alias("first"), F.min("sid2").alias("sid2"), F.max("sid2").alias("other"))
    return firsts.select("sid", "sid2", "first.*", (F.col("sid2") != F.col("other")).alias("mixed")).where(F.col("string") != "")


def apart(firsts: DataFrame, rows: DataFrame) -> DataFrame:
    """The first lines with those put right whose 64-bit hash other lines share (about one in some 1e10 lines has such a twin)."""
    if firsts.where("mixed").isEmpty():
        return firsts.drop("mixed")
    twins = firsts.where("mixed").select("sid")
    lines = lines_of(rows).select(F.xxhash64("string").alias("sid"), F.xxhash64(F.lit(1), "string").alias("sid2"), F.struct("doc", "h", "line", "string").alias("place"))
    split = lines.join(twins, "sid", "left_semi").groupBy("sid", "sid2").agg(F.min("place").alias("first")).select("sid", "sid2", "first.*")
    return firsts.where("NOT mixed").drop("mixed").unionByName(split.where(F.col("string") != ""))


def rarity(lines: DataFrame) -> Column:
    """For each counter a long of seven bits that grows with the log of its occurrences, as a constant array (of small numbers, which the JVM keeps once)."""
    at = F.xxhash64("w").bitwiseAND(F.lit(COUNTERS - 1)).cast("int")
    counts = lines.select(F.explode(words_in(F.col("string"))).alias("w")).groupBy(at.alias("at")).agg(F.count("*").alias("n"))
    rank = F.least(F.floor(F.log2(F.col("n") + 1) * STEPS), F.lit(127)).cast("int")
    rows = counts.groupBy(F.floor(F.col("at") / CHUNK)).agg(F.collect_list("at").alias("at"), F.collect_list(rank).alias("rank"))
    ranks = [0] * COUNTERS
    for part in rows.select("at", "rank").toArrow().to_pylist():  # COUNTERS entries at most, whatever the input
        for place, r in zip(part["at"], part["rank"], strict=True):
            ranks[place] = r
    return F.from_json(F.lit(json.dumps(ranks, separators=(",", ":"))), "array<bigint>")


def tokenised(lines: DataFrame, ranks: Column, share: int) -> DataFrame:
    """(sid, sid2, doc, h, line, n, bits, bits2, ends, prefix): of every line what the join needs; bits: parity maps of its tokens."""
    hashes = F.transform(words_in(F.col("string")), lambda w: F.xxhash64(w))
    rank = lambda x: F.coalesce(F.get(ranks, x.bitwiseAND(F.lit(COUNTERS - 1)).cast("int")), F.lit(0).cast("long"))  # noqa: E731  never null, so that plain longs are sorted
    keys = F.transform("hashes", lambda x: F.shiftleft(rank(x), 56).bitwiseOR(F.shiftrightunsigned(x, 8)))
    place = ["sid", "sid2", "doc", "h", "line"]
    sets = lines.select(*place, hashes.alias("hashes")).select(*place, F.array(F.array_min("hashes"), F.array_max("hashes")).alias("ends"), F.sort_array(F.array_distinct(keys)).alias("keys"))
    size = F.size("keys")
    sets = sets.select("*", F.when(size > WIDE, F.filter("keys", lambda k: k.bitwiseAND(F.lit(64)) != 0)).otherwise(F.array().cast("array<bigint>")).alias("odd"))
    # the map of the other half is what the two halves' map and this one differ in
    sets = sets.select("*", parity("odd").alias("bits2"))
    return sets.select(*place, size.alias("n"), parity("keys").bitwiseXOR(F.col("bits2")).alias("bits"), "bits2", "ends", F.slice("keys", F.lit(1), begun(size, share)).alias("prefix"))


def parity(keys: str) -> Column:
    """64 bits, each set if an odd number of tokens hashes to it."""
    return F.aggregate(keys, F.lit(0).cast("long"), lambda bits, k: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), k.bitwiseAND(F.lit(63)).cast("int"))))


def begun(n: Column, share: int) -> Column:
    """The tokens in the prefix of a line of n."""
    return (n - F.call_function("div", n * share + 999, F.lit(1000)) + 1).cast("int")


def close(na: Column, nb: Column, share: int) -> Column:
    """Length and parity: a bit that differs stands for a token that one line lacks; only so many may.

    A map of two words folds into the map of one, for pairs of which one line has one word alone.
    """
    length = F.least(na, nb) * 1000 >= F.greatest(na, nb) * share
    first, second = F.col("ba").bitwiseXOR(F.col("bb")), F.col("ca").bitwiseXOR(F.col("cb"))
    differ = F.when(F.least(na, nb) > WIDE, F.bit_count(first) + F.bit_count(second)).otherwise(F.bit_count(first.bitwiseXOR(second)))
    return length & (differ * (1000 + share) <= (na + nb) * (1000 - share))


def renamed(df: DataFrame, **names: str) -> DataFrame:
    return df.select(*[F.col(c).alias(n) for c, n in names.items()])


def texts(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """(sid, sid2, doc, h, line, string) of the lines in pairs (a, b), each once; a table, so that the lines are read once."""
    wanted = pairs.select(F.col("a").alias("sid")).union(pairs.select("b")).distinct().hint("shuffle_hash")
    return common.staged(lines.join(wanted, "sid").select("sid", "sid2", "doc", "h", "line", "string"), "line-texts")


def beaten(pairs: DataFrame, lines: DataFrame, share: int) -> DataFrame:
    """(sid, sid2) of the later line of every pair (a, b) whose exact Jaccard reaches the threshold."""
    found = texts(pairs, lines)
    places = found.select("sid", "sid2", F.struct("doc", "h", "line").alias("place"))
    told = pairs.join(renamed(places, sid="a", sid2="a2", place="pa").hint("shuffle_hash"), "a").join(renamed(places, sid="b", sid2="b2", place="pb").hint("shuffle_hash"), "b")
    one, two = (F.struct(F.col(f"p{x}").alias("place"), F.col(x).alias("sid"), F.col(f"{x}2").alias("sid2")) for x in "ab")
    first = F.col("pa") < F.col("pb")
    told = told.select(F.when(first, one).otherwise(two).alias("early"), F.when(first, two).otherwise(one).alias("late"))
    told = common.staged(told.select("early.place", F.col("early.sid").alias("a"), F.col("early.sid2").alias("a2"), F.col("late.sid").alias("b"), F.col("late.sid2").alias("b2")), "line-ordered")
    leads = common.staged(told.groupBy("b", "b2").agg(F.min(F.struct("place", "a", "a2")).alias("e")).select("e.a", "e.a2", "b", "b2"), "line-leads")
    lost = alike(leads, found, share)
    rest = told.join(renamed(lost, sid="b", sid2="b2"), ["b", "b2"], "left_anti").join(leads, ["a", "a2", "b", "b2"], "left_anti")
    lost = lost.union(alike(common.staged(rest.select("a", "a2", "b", "b2"), "line-rest"), found, share))
    common.release(found)
    return lost


def alike(pairs: DataFrame, found: DataFrame, share: int) -> DataFrame:
    """(sid, sid2) of b of the pairs (a, a2, b, b2) whose words have the Jaccard, each once; found: their texts."""
    found = found.select("sid", "sid2", "string")
    cut = pairs.join(renamed(found, sid="a", sid2="a2", string="x"), ["a", "a2"]).join(renamed(found, sid="b", sid2="b2", string="y"), ["b", "b2"])
    x, y = (F.array_distinct(words_in(F.col(c))) for c in "xy")
    enough = F.size(F.array_intersect(x, y)) * (1000 + share) >= (F.size(x) + F.size(y)) * share
    # told of all pairs of a line and not in a filter, which would cut every text twice
    told = cut.select("b", "b2", enough.alias("enough")).groupBy("b", "b2").agg(F.bool_or("enough").alias("enough"))
    return common.staged(told.where("enough").select(F.col("b").alias("sid"), F.col("b2").alias("sid2")), "line-beaten")


def lost_to(pairs: DataFrame, lines: DataFrame, share: int) -> DataFrame:
    """As alike(), with the texts read for these pairs alone."""
    found = texts(pairs, lines)
    lost = alike(pairs, found, share)
    common.release(found)
    return lost


def witnessed(sets: DataFrame, lost: DataFrame | None, which: int, share: int) -> DataFrame:
    """Pairs (a, a2, b, b2) of the first line with a token hash (which: least, greatest) and the others not lost, where they can be alike."""
    slim = sets.select(F.get("ends", F.lit(which)).alias("end"), "doc", "h", placed(sets).alias("place"), "sid", "sid2", "n", "bits", "bits2")
    # numbers alone, which are aggregated by hash and not by sorting; places differ but for such rows
    lead = {"a": "sid", "a2": "sid2", "da": "doc", "ha": "h", "na": "n", "ba": "bits", "ca": "bits2"}
    leads = slim.groupBy("end").agg(F.min("place").alias("pa"), F.count("*").alias("many"), *[F.min_by(c, "place").alias(k) for k, c in lead.items()]).where("many > 1").drop("many")
    asked = slim if lost is None else slim.join(lost, ["sid", "sid2"], "left_anti")
    met = renamed(asked, end="end", doc="db", h="hb", place="pb", sid="b", sid2="b2", n="nb", bits="bb", bits2="cb").join(leads.hint("shuffle_hash"), "end")
    earlier = (F.col("da") < F.col("db")) | ((F.col("da") == F.col("db")) & (F.col("ha") == F.col("hb")) & (F.col("pa") < F.col("pb")))
    return common.staged(met.where(earlier & close(F.col("na"), F.col("nb"), share)).select("a", "a2", "b", "b2"), "line-pairs")


def placed(sets: DataFrame) -> Column:
    """The place as one number, but for the text's hash: rows of one id and several texts are left to the index. A long where ids and lines leave room."""
    ids = F.when(F.col("doc") != LAST, F.col("doc"))
    low, high, line = sets.agg(F.min(ids), F.max(ids), F.max("line")).first()
    low, high, bits = low or 0, high or 0, (line or 0).bit_length()
    if (high - low + 2) << bits < 2**63:
        doc = F.when(F.col("doc") == LAST, F.lit(high - low + 1)).otherwise(F.col("doc") - F.lit(low))
        return F.shiftleft(doc.cast("long"), bits).bitwiseOR(F.col("line").cast("long"))
    return F.col("doc").cast("decimal(20,0)") * F.lit(2**32).cast("decimal(10,0)") + F.col("line").cast("decimal(10,0)")


def aged(docs: DataFrame) -> Column:
    """0 to 255: a number that never falls as doc grows, in even steps over the ids."""
    low, high = docs.where(F.col("doc") != LAST).agg(F.min("doc"), F.max("doc")).first()
    step = F.lit(0) if low is None or low == high else F.width_bucket(F.col("doc").cast("double"), F.lit(float(low)), F.lit(float(high)), F.lit(253))
    return F.when(F.col("doc") == LAST, 255).otherwise(F.coalesce(step, F.lit(0))).cast("long")


def met(sets: DataFrame, lost: DataFrame, share: int) -> tuple[DataFrame, DataFrame]:
    """The index as the smaller and as the larger line of a pair: (token, class, sid, shape, bits, bits2) of a and of b.

    A pair meets under a token of both prefixes and the size class of the larger line, for which the smaller
    one stands in each class that it can be like a line of. Told after the shuffle: both sides read one exchange.
    """
    # joined by the bucket's hash alone; should twins of one hash double a line here, pairs are made distinct below
    marked = sets.withColumn("age", aged(sets)).join(lost.select("sid", F.col("sid2").alias("lost2")).hint("shuffle_hash"), "sid", "left")
    gone = F.when(F.col("lost2") == F.col("sid2"), 1).otherwise(0)
    index = marked.select("sid", F.col("n").cast("long").alias("n"), "bits", "bits2", "age", gone.alias("gone"), F.posexplode("prefix").alias("at", "token"))
    n, at = F.col("n"), F.col("at").cast("long")
    # a, the smaller line, is found by a shorter prefix: up to what the least overlap with a line of its own size leaves
    short = at < n - F.call_function("div", n * (2 * share) + (999 + share), F.lit(1000 + share)) + 1
    # one number holds a line's tokens (27 bits), the token's place (26), the line's age (8), whether that place is in the shorter prefix and whether the line is removed
    shape = F.shiftleft(n, 36).bitwiseOR(F.shiftleft(at, 10)).bitwiseOR(F.shiftleft("age", 2)).bitwiseOR((F.when(short, 2).otherwise(0) + F.col("gone")).cast("long"))
    # 32 bits of a token and the class are one long for the join; neither is ever null, as a test for it would stand below one side's shuffle alone
    token = F.coalesce(F.shiftright(F.shiftleft("token", 32), 32).cast("int"), F.lit(0))
    index = index.select(token.alias("token"), "sid", F.coalesce(shape, F.lit(0).cast("long")).alias("shape"), "bits", "bits2").repartition("token").sortWithinPartitions("token")
    n, at = told("shape")
    most = F.call_function("div", (n - at) * (1000 + share), F.lit(share)) - n
    classes = F.when(F.col("shape").bitwiseAND(F.lit(2)) > 0, F.sequence(sized(n, share), sized(most, share))).otherwise(F.array().cast("array<int>"))
    rest = ["sid", "shape", "bits", "bits2"]
    # rows of a token stand together, so that the join finds them in the cache; exploded on both sides, as the optimiser drops a sort right below a join
    return index.select("token", F.explode(classes).alias("class"), *rest), index.select("token", F.explode(F.array(sized(n, share))).alias("class"), *rest)


def told(shape: str) -> tuple[Column, Column]:
    """A line's tokens and the token's place."""
    return F.shiftright(shape, 36), F.shiftright(shape, 10).bitwiseAND(F.lit(2**26 - 1))


def sized(n: Column, share: int) -> Column:
    """The class of lines of n tokens: it never falls as n grows; the sizes a line can be like are of two or three classes."""
    return F.coalesce(F.floor(F.log(n.cast("double")) / F.lit(max(math.log(1000 / share), 0.05))).cast("int"), F.lit(0))


def indexed(sets: DataFrame, lost: DataFrame, share: int) -> DataFrame:
    """Pairs (a, b) of lines that share a token of their prefixes, one of them not in lost, where they can be alike."""
    a, b = met(sets, lost, share)
    a, b = renamed(a, **{"token": "token", "class": "class", "sid": "a", "shape": "va", "bits": "ba", "bits2": "ca"}), renamed(b, **{"token": "token", "class": "class", "sid": "b", "shape": "vb", "bits": "bb", "bits2": "cb"})
    flag = lambda v, bit: F.col(v).bitwiseAND(F.lit(bit))
    (na, ia), (nb, ib) = told("va"), told("vb")
    ea, eb = flag("va", 255 << 2), flag("vb", 255 << 2)
    near = ((na < nb) | ((na == nb) & (F.col("a") < F.col("b")))) & (F.least(na - ia, nb - ib) * (1000 + share) >= (na + nb) * share)
    near = near & close(na, nb, share) & (flag("va", 1) + flag("vb", 1) < 2)
    # the later line of a pair goes: where that is removed already, nothing is left to find
    near = near & ((flag("va", 1) == 0) | (ea <= eb)) & ((flag("vb", 1) == 0) | (eb <= ea))
    with common.setting(sets.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false"):  # else both sides were shuffled again, by token and class
        return common.staged(a.join(b.hint("shuffle_hash"), ["token", "class"]).where(near).select("a", "b").distinct(), "line-pairs")


def kept_lines(docs: DataFrame, threshold: float = common.SIMILARITY) -> DataFrame:
    """(doc, h, kept): the places of the lines with words that stay, of every document that has some."""
    with common.workspace():
        share = round(threshold * 1000)
        rows = rows_of(docs)
        lines = apart(common.bucketed(equal_lines(rows), "line-firsts", "sid", "zstd", dictionary=False), rows)
        sets = common.bucketed(tokenised(lines, rarity(lines), share), "line-sets", "sid", dictionary=False)
        lost = lost_to(witnessed(sets, None, 0, share), lines, share)
        lost = lost.union(lost_to(witnessed(sets, lost, 1, share), lines, share))
        more = beaten(indexed(sets, lost, share), lines, share)
        gone = lost.union(more).repartition("sid").hint("shuffle_hash")
        kept = sets.select("sid", "sid2", "doc", "h", "line").join(gone, ["sid", "sid2"], "left_anti")
        with common.setting(docs.sparkSession, "spark.sql.requireAllClusterKeysForCoPartition", "false"):  # else the buckets of lines were shuffled
            return common.staged(kept.groupBy("doc", "h").agg(F.collect_list("line").alias("kept")), "line-kept")


def deduped(docs: DataFrame, threshold: float = common.SIMILARITY) -> DataFrame:
    """The documents' columns with text and n_chars of what is left, and n_lines and n_removed."""
    doc, h, whole, cut, left = common.free(docs, "doc", "h", "whole", "cut", "left")
    kept = kept_lines(docs, threshold).select(F.col("doc").alias(doc), F.col("h").alias(h), F.col("kept").alias(left + "_kept"))
    text = common.text_or_empty()
    keyed = docs.withColumns({doc: F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)), h: F.xxhash64(text), whole: text})
    joined = keyed.join(kept.hint("shuffle_hash"), [doc, h], "left")
    joined = joined.withColumn(cut, F.split(whole, "\n")).withColumn(left + "_set", F.coalesce(left + "_kept", F.array().cast("array<int>")))
    stays = lambda s, i: F.array_contains(F.col(left + "_set"), i) | (F.trim(s, F.lit(BLANKS)) == "")
    joined = joined.withColumn(left, F.filter(F.col(cut), stays))
    joined_text = F.array_join(left, "\n")
    own = {"text": joined_text, "n_chars": F.char_length(joined_text).cast("long")}
    columns = [own[c].alias(c) if c in own else F.col(common.quoted(c)) for c in docs.columns]
    n_lines, n_removed = common.named(docs, "n_lines", "n_removed")
    return joined.select(*columns, F.size(cut).alias(n_lines), (F.size(cut) - F.size(left)).alias(n_removed))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that an earlier line is like."""
    return deduped(common.table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def sql(threshold: float = common.SIMILARITY) -> str:
    """The same in DuckDB's SQL, with a prefix by exact counts (sets of words as they stand)."""
    share = round(threshold * 1000)
    return f"""WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS s, unnest(range(0, len(ls))) AS line FROM docs),
sets AS (SELECT doc_id, line, list_sort(list_distinct(list_filter(regexp_split_to_array(s, '[ \\t\\x0B\\f\\r]+'), lambda w: w <> ''))) AS words FROM lines),
firsts AS (SELECT words, min((doc_id, line)) AS place FROM sets WHERE len(words) > 0 GROUP BY words),
named AS (SELECT row_number() OVER (ORDER BY place) AS sid, words, place FROM firsts),
toks AS (SELECT sid, len(words) AS n, unnest(words) AS w FROM named),
df AS (SELECT w, count(*) AS c FROM toks GROUP BY w),
ranked AS (SELECT sid, n, toks.w, row_number() OVER (PARTITION BY sid ORDER BY c, toks.w) AS i FROM toks JOIN df ON toks.w = df.w),
prefixes AS (SELECT * FROM ranked WHERE i <= n - (({share} * n + 999) // 1000) + 1),
pairs AS (SELECT DISTINCT a.sid AS a, b.sid AS b FROM prefixes a JOIN prefixes b ON a.w = b.w AND a.sid < b.sid AND least(a.n, b.n) * 1000 >= greatest(a.n, b.n) * {share}),
alike AS (SELECT b FROM pairs JOIN named x ON x.sid = a JOIN named y ON y.sid = b WHERE len(list_intersect(x.words, y.words)) * {1000 + share} >= (len(x.words) + len(y.words)) * {share}),
good AS (SELECT place FROM named WHERE sid NOT IN (SELECT b FROM alike)),
kept AS (SELECT l.doc_id, l.line, l.s FROM lines l JOIN sets USING (doc_id, line) LEFT JOIN good ON good.place = (l.doc_id, l.line) WHERE len(sets.words) = 0 OR good.place IS NOT NULL),
texts AS (SELECT doc_id, string_agg(s, chr(10) ORDER BY line) AS text, count(*) AS n FROM kept GROUP BY doc_id)
SELECT docs.doc_id, coalesce(texts.text, '') AS text, CAST(len(ls) AS INTEGER) AS n_lines, CAST(len(ls) - coalesce(n, 0) AS INTEGER) AS n_removed FROM docs LEFT JOIN texts ON docs.doc_id = texts.doc_id"""
