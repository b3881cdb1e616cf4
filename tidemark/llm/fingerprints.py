"""Document fingerprints by one-permutation MinHash (operator 3), in DataFrame functions only.

Every five-word shingle is hashed once; its low bits name a bin and the rest is its value, and
each bin keeps its least value. An empty bin takes the value of the first filled bin in an order of
all bins that is drawn for it alone (optimal densification): PROBES bins are tried, then the order
goes on by hashes of both bins. The lowest BITS bits of
each bin's value, hashed with the bin so that copies of one value do not all collide at once, are
packed into hex digits. Two fingerprints that agree in a share p of their bins have
an estimated Jaccard of (p - c) / (1 - c), where c = 2 ** -BITS is the share that agrees by chance.

Least values are found without exploding a text: hashes are sorted as numbers whose high bits are
the bin, and the first of each bin stays. Nulls count as empty texts; a text of fewer than five
words has one shingle, all its words. Equal texts have equal fingerprints; two texts without words
are alike to 1. Texts of any length are hashed whole; an empty table gives an empty table. Rows with
one id stand in the order of their texts' hashes, and a null id before all others. Columns of any other
name are not read.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common

#: Bins (a power of two), bits kept of each (a hex digit holds them), and probes before the sweep.
BINS, BITS = 256, 4
PROBES = 24


def probes() -> list:
    """For each probe a list: bin -> bin to look into; drawn from a linear congruential stream."""
    state, rounds = 0x2545F491, []
    for _ in range(PROBES):
        line = []
        for _ in range(BINS):
            state = (state * 6364136223846793005 + 1442695040888963407) % 2**64
            line.append((state >> 33) % BINS)
        rounds.append(line)
    return rounds


def fingerprinted(df: DataFrame, text: str, out: str) -> DataFrame:
    """Add the fingerprint of a text column. Helper columns are made in steps, so that each is made once."""
    words, hashes, full, filled = f"__{out}_w", f"__{out}_h", f"__{out}_f", f"__{out}_b"
    n = common.SHINGLE_WORDS
    shift = 63 - (BINS.bit_length() - 1)
    low = (1 << shift) - 1
    df = df.withColumn(words, F.transform(F.filter(F.split(F.col(text), "[ \\t\\n\\u000B\\f\\r]+"), lambda w: w != ""), lambda w: F.xxhash64(w)))
    w = F.col(words)
    # numbers of 63 bits: the bin on top, the value below; every bin has a largest value that stands for an empty bin
    many = F.transform(F.slice(w, 1, F.size(w) - (n - 1)), lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, n)]).bitwiseAND(F.lit(2**63 - 1)))
    one = F.array(F.xxhash64(w).bitwiseAND(F.lit(2**63 - 1)))
    empty = F.array(*[F.lit((b << shift) + low) for b in range(BINS)])
    df = df.withColumn(hashes, F.sort_array(F.concat(F.when(F.size(w) >= n, many).otherwise(one), empty)))
    h = F.col(hashes)
    firsts = F.filter(h, lambda x, i: (i == 0) | (F.shiftright(x, shift) != F.shiftright(F.get(h, i - 1), shift)))
    df = df.withColumn(full, F.transform(firsts, lambda x: F.nullif(x.bitwiseAND(F.lit(low)), F.lit(low))))
    df = df.withColumn(filled, F.filter(F.sequence(F.lit(0), F.lit(BINS - 1)), lambda b: F.get(F.col(full), b).isNotNull()))
    return df.withColumn(out, packed(F.col(full), F.col(filled))).drop(words, hashes, full, filled)


def packed(full: Column, filled: Column) -> Column:
    """Densify and pack an array of values by bin, nulls where a bin is empty; filled: the bins that are not."""
    tables = [F.array(*[F.lit(b) for b in line]) for line in probes()]
    # the order of all bins for one bin: by the hash of both, the bin itself in the lowest bits
    rest = lambda i: F.get(full, F.array_min(F.transform(filled, lambda b: F.xxhash64(i, b).bitwiseAND(F.lit(-BINS)).bitwiseOR(b.cast("long")))).bitwiseAND(F.lit(BINS - 1)).cast("int"))
    dense = F.transform(full, lambda v, i: F.coalesce(v, *[F.get(full, F.get(t, i)) for t in tables], rest(i)))
    return F.lower(F.array_join(F.transform(dense, lambda v, i: F.hex(F.xxhash64(v, i).bitwiseAND(F.lit(2**BITS - 1)))), ""))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard of two fingerprints, 0 to 1, without the agreement of chance."""
    same = F.size(F.filter(F.expr(f"sequence(1, {BINS})"), lambda i: F.substr(a, i, F.lit(1)) == F.substr(b, i, F.lit(1)))) / F.lit(float(BINS))
    chance = 2.0**-BITS
    return F.greatest(F.lit(0.0), (same - chance) / (1 - chance))


def own_tasks(spark: SparkSession, parts: int) -> list:
    """For each of so many ranges a number that hash partitioning sends to a task of its own."""
    task = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts))
    found = spark.range(parts * 40).groupBy(task.alias("task")).agg(F.min("id").alias("id")).orderBy("task").collect()
    return [r["id"] for r in found] + list(range(parts * 40, parts * 41 - len(found)))


def with_next(rows: DataFrame, order: str, carried: list[str]) -> DataFrame:
    """Add next_<column> of the row that follows in ascending order of a long column (last: the first).

    Rows are dealt to ranges of the order; the first row of each range is also sent to the range
    before it, so each range finds its last row's follower. One shuffle, and a task for each range.
    A value that fills several ranges, such as that of rows without an id, is dealt on by the hash of the
    first carried column, which orders its rows; rows alike in both stand in any order, as they are equal.
    """
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("__tie", F.xxhash64(carried[0]))
    cuts = sorted(rows.select(F.col(order).cast("double").alias("o")).stat.approxQuantile("o", [k / parts for k in range(1, parts)], 0.2 / parts)) if parts > 1 else []
    bounds = F.array(*[F.lit(int(c)) for c in cuts]) if cuts else F.array().cast("array<bigint>")
    below, at = F.size(F.filter(bounds, lambda x: x < F.col(order))), F.size(F.filter(bounds, lambda x: x == F.col(order)))
    share = (F.shiftrightunsigned(F.col("__tie").bitwiseXOR(F.lit(-(2**63))), 11) / F.lit(2.0**53)).cast("double")
    bucket = below + F.when(at > 0, F.least(at, 1 + F.floor(share * at).cast("int"))).otherwise(0)
    heads = sorted((r["b"], r["o"]["o"], r["o"]["t"]) for r in rows.groupBy(bucket.alias("b")).agg(F.min(F.struct(F.col(order).alias("o"), F.col("__tie").alias("t"))).alias("o")).collect())  # a row for each range at most
    before = {f"{o} {t}": heads[i - 1][0] for i, (_, o, t) in enumerate(heads)}
    own = rows.withColumn("__bucket", bucket).withColumn("__late", F.lit(False))
    if not heads:
        return own.select("*", *[F.col(c).alias(f"next_{c}") for c in carried]).drop("__bucket", "__late", "__tie")
    place = F.concat_ws(" ", F.col(order).cast("string"), F.col("__tie").cast("string"))
    ends = F.create_map(*[F.lit(x) for pair in before.items() for x in pair])
    sent = F.array(F.struct(F.col("__bucket").alias("b"), F.lit(False).alias("late")))
    extra = F.struct(ends[place].cast("int").alias("b"), F.lit(True).alias("late"))
    first = F.col(order).isin([o for _, o, _ in heads]) & place.isin(list(before))
    dealt = own.withColumn("__sent", F.explode(F.when(first, F.concat(sent, F.array(extra))).otherwise(sent)))
    dealt = dealt.withColumn("__task", F.get(F.array(*[F.lit(x).cast("int") for x in own_tasks(spark, parts)]), F.col("__sent.b")))
    window = f"OVER (PARTITION BY __task ORDER BY __sent.late, {order}, __tie, {', '.join(carried)})"
    out = dealt.select("*", *[F.expr(f"lead({c}) {window}").alias(f"next_{c}") for c in carried])
    return out.where("NOT __sent.late").drop("__bucket", "__late", "__sent", "__tie", "__task")


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness. A null id stands before all others."""
    docs = common.table(spark, sf_dir, "documents")
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("place"), common.text_or_empty().alias("text"))
    rows = with_next(fingerprinted(rows, "text", "fingerprint"), "place", ["text", "fingerprint"])
    size = F.char_length("text").cast("long")
    half = F.floor(size / 2).cast("int")
    rows = rows.withColumn("n_chars", size).withColumn("edited", F.concat(F.substr("text", F.lit(1), (size - half).cast("int")), F.substr("next_text", F.lit(1), half)))
    rows = fingerprinted(rows, "edited", "edited_fingerprint")
    return rows.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"), likeness(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"))
