"""Matching today's rows against past editions: the latest edition that had the same story."""

from math import ceil

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedupe import written
from tidemark.operators.pairs import mapped, may_share, numbered
from tidemark.operators.select import ranked

RATIO, LEAST_WORDS, ENOUGH, WITH_NAME = 0.55, 4, 5, 3
#: A word of more rows is frequent: rows meet under two such words at once, not under one.
FREQUENT = 200
#: So many past rows of a key, the latest, are met by all rows of the key; the others only by rows that may still gain by them.
FIRST = 64
#: Kinds of keys: two wide rows; a row of today's that is narrow, or a past one, with any other row; a name.
WIDE, NOW, THEN, NAME = range(4)


def distinctive(today: DataFrame, past: DataFrame, names: str, low: int = 2, high: int = 12) -> DataFrame:
    """Names of a band of frequencies over today and the past as one corpus."""
    both = today.select(F.explode(names).alias("word")).unionByName(past.select(F.explode(names).alias("word")))
    return both.groupBy("word").agg(F.count("*").alias("df")).where(F.col("df").between(low, high)).select("word")


def keys(need, limit: int, kind: int) -> Column:
    """What a row meets rows under with which it shares `need` (two or more) of its numbers `all`, which ascend from the rarest.

    The first shared number stands before the last need - 1, the second before the last need - 2. A first
    one up to limit is a key, a greater one is with each that may be the second. (Unlike up to 2^30 words.)
    """
    heads = F.size("all") - need + 1
    key = lambda x, y: F.shiftleft(x.cast("long"), 33) + F.shiftleft(y.cast("long"), 2) + F.lit(kind)
    seconds = lambda x, i: F.transform(F.slice("all", i + 2, heads - i), lambda y: key(x, y))
    return F.flatten(F.transform(F.slice("all", F.lit(1), F.greatest(heads, F.lit(0))), lambda x, i: F.when(x <= limit, F.array(key(F.lit(0), x))).otherwise(seconds(x, i))))


def alike(words: str, names: str) -> list[Column]:
    """w and names as they are equal for rows of equal sets."""
    return [F.sort_array(F.coalesce(F.col(c), F.array().cast("array<string>"))).alias(name) for c, name in ((words, "w"), (names, "names"))]


def ran_before(today: DataFrame, past: DataFrame, key: str, words: str, names: str, edition: str, known: DataFrame | None = None, veto: Column | None = None) -> DataFrame:
    """(key, past_id, edition, shared): each row's latest match.

    Two headlines match if they share 0.55 of the smaller set, when that has four words, or five words,
    or a distinctive name and three words. So rows meet under a distinctive name, or under what the need of
    the smaller set leaves necessary of their words: its rarest shared word, if that is rare, else its two
    rarest. Wide sets, which need five words, meet each other; narrow ones meet all under longer prefixes,
    where words are rare up to a limit that grows as narrow rows get fewer.

    Pairs are judged where they meet. Past rows are numbered by edition, so that of a row's matches only the
    greatest number is kept, in each task: no pairs are shuffled. Under a key all rows meet its latest past
    rows; those before meet only rows that have found nothing later yet, so that near copies do not
    all meet each other; exact ones are one row. A veto may read wa, na, wb, nb and edition.
    """
    spark = today.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    least = min(WITH_NAME, ENOUGH)
    old = written(ranked(past.withColumn("back", -F.col("past_id")), [], [edition, "back"], "place"), "past").drop("back")
    both = today.select(F.lit(True).alias("now"), F.col(key).alias("id"), F.col(words).alias("w"), F.col(names).alias("names"))
    rows = both.unionByName(old.select(F.lit(False).alias("now"), F.col("place").alias("id"), F.col(words).alias("w"), F.col(names).alias("names")), allowMissingColumns=True)
    if veto is None:
        # copies are one row: of past ones the latest, of today's any
        rows = written(rows.groupBy("now", *alike("w", "names")).agg(F.max("id").alias("id")), "unlike")
        copies = today.select(key, *alike(words, names)).join(rows.where("now").select("w", "names", F.col("id").alias("row")), ["w", "names"]).select(key, "row")
    rows = rows.withColumn("id", F.struct("now", F.col("id")))
    # words of both sides; no other can be shared
    counts = rows.select("now", F.explode("w").alias("word")).groupBy("word").agg(F.count("*").alias("df"), F.count_if("now").alias("own"))
    counts = written(counts.where("own > 0 AND own < df").select("word", "df", F.lit(True).alias("rare")), "words")
    need = F.when(F.col("n") >= LEAST_WORDS, F.least(F.lit(ENOUGH), F.ceil(F.col("n") * F.lit(RATIO) - F.lit(1e-9)).cast("int")))
    told = numbered(rows.select("id", "w"), counts).join(rows.select("id", F.size("w").alias("n")), "id").withColumn("need", need)
    if known is not None:
        told_names = ranked(known.select("word").distinct(), [], ["word"], "number")
        own = rows.select("id", F.explode("names").alias("word")).join(told_names, "word").groupBy("id").agg(F.collect_set("number").alias("known"))
        told = told.join(own, "id", "left")
    told = written(mapped(told.where(F.size("all") >= least)).repartition(parts), "headlines")
    narrow = F.col("need") < ENOUGH
    n, few = told.agg(F.count("*"), F.count_if(narrow)).first()
    limit, longer = counts.agg(F.count_if(F.col("df") <= FREQUENT), F.count_if(F.col("df") <= FREQUENT * n // max(1, few))).first()
    narrowest = min(ENOUGH, ceil(LEAST_WORDS * RATIO - 1e-9))
    mine, other = {True: NOW, False: THEN}, {True: THEN, False: NOW}

    def spread(rows: DataFrame, *lists: Column) -> DataFrame:
        """The rows once under each of their keys."""
        none = F.array().cast("array<long>")
        rows = rows.withColumn("keys", F.concat(*[F.coalesce(x, none) for x in lists]))
        return rows.select(F.explode("keys").alias("number"), *[c for c in rows.columns if c not in ("keys", "known")])

    own_narrow = {now: F.when(narrow, keys(F.col("need"), longer, kind)) for now, kind in mine.items()}
    at = {now: told.where(F.col("id.now") == now).withColumn("id", F.col("id.id")) for now in (True, False)}
    # the keys of a side's narrow rows: the other side's rows go under these alone to meet them
    sought = {now: written(spread(at[now].where(narrow), own_narrow[now]).select("number").distinct(), "narrow-keys") for now in (True, False)} if few else {}

    def side(now: bool, rows: DataFrame) -> DataFrame:
        out = [F.when(F.col("need") == ENOUGH, keys(F.lit(ENOUGH), limit, WIDE)), own_narrow[now]]
        if known is not None:
            out.append(F.transform("known", lambda x: F.shiftleft(x.cast("long"), 2) + F.lit(NAME)))
        index = spread(rows, *out)
        if few:
            index = index.unionByName(spread(rows.where("need IS NOT NULL"), keys(F.lit(narrowest), longer, other[now])).join(sought[not now], "number", "left_semi"))
        return index

    def judged(a: DataFrame, b: DataFrame, later: Column) -> DataFrame:
        # a given number of partitions: rows are of few bytes, but many meet
        a, b = [rows.select("number", *[F.col(c).alias(letter + c) for c in rows.columns if c != "number"]).repartition(parts, "number") for rows, letter in ((a, "a_"), (b, "b_"))]
        if veto is not None:
            a = a.join(today.select(F.col(key).alias("a_id"), F.col(words).alias("wa"), F.col(names).alias("na")), "a_id")
            b = b.join(old.select(F.col("place").alias("b_id"), F.col(edition).alias("edition"), F.col(words).alias("wb"), F.col(names).alias("nb")), "b_id")
        shared, small, named = F.size(F.array_intersect("a_all", "b_all")), F.least("a_n", "b_n"), F.col("number").bitwiseAND(F.lit(3)) == NAME
        enough = named | ((small >= LEAST_WORDS) & (shared >= F.lit(RATIO) * small)) | (shared >= ENOUGH)
        hopeful = may_share("a_", "b_", F.when(named, least).otherwise(F.least("a_need", "b_need")))
        met = a.join(b, "number").where(later & hopeful & (shared >= least) & enough)
        return (met if veto is None else met.where(~veto)).select(F.col("a_id").alias("row"), F.col("b_id").alias("place"))

    nth = F.row_number().over(Window.partitionBy("number").orderBy(F.desc("id")))
    tops = side(False, at[False]).select("number", "id").withColumn("nth", nth).where(F.col("nth") == FIRST + 1)
    tops = written(tops.select("number", F.col("id").alias("top")), "tops")
    b = side(False, at[False]).join(tops, "number", "left")
    first = judged(side(True, at[True]), b.where("top IS NULL OR id > top").drop("top"), F.lit(True))
    first = written(first.groupBy("row").agg(F.max("place").alias("place")), "first-matches")
    left = side(True, at[True].join(first.select(F.col("row").alias("id"), F.col("place").alias("found")), "id", "left"))
    left = left.join(tops, "number").where("found IS NULL OR found < top").drop("top")
    second = judged(left, b.where("id <= top").drop("top"), F.col("a_found").isNull() | (F.col("b_id") > F.col("a_found")))
    best = first.unionByName(second).groupBy("row").agg(F.max("place").cast("int").alias("place"))
    best = best.withColumnRenamed("row", key) if veto is not None else best.join(copies, "row").drop("row")
    found = best.join(old.select("place", "past_id", F.col(edition).alias("edition"), F.col(words).alias("wb")), "place").join(today.select(key, F.col(words).alias("wa")), key)
    return found.select(key, "past_id", "edition", F.size(F.array_intersect("wa", "wb")).alias("shared"))
