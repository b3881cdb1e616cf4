"""Near-duplicate documents by ProbMinHash (operator 6).

A text's elements are its five-word shingles, each weighing 1 + ln(times it occurs). Elements
arrive at registers as Poisson processes whose rate is their weight; a register keeps the first
to arrive. Two texts agree in a register with the probability of their probability Jaccard, which
for texts without repeated shingles is the plain Jaccard. An element stops arriving once its time
is past that of the latest register (early termination). Arrivals of a whole batch are drawn
together, round by round.

Signatures (128 registers of 16 bits) are cut into 32 bands of four: a pair at 0.8 shares no band
with a probability of 5e-8. Equal texts are one node from the start. In each bucket every member
is compared with the bucket's least member; exact similarity from the words decides. Members of
a bucket that are then still in different classes are compared with one another in bounded blocks,
which give out only links: first the closest of each member and class, then any that are left.
Pairs within a class add nothing to it. Classes are the connected components of the links.

Nulls count as empty texts. A text of fewer than five words has one shingle, all its words. Rows
with one id are one document. A row without an id takes a negative number made from its text. An empty
table has no classes. Texts of any length are compared whole, in batches of bounded bytes. Members that
are equally close are taken by their least id. Columns of any other name are kept by keep_first().
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import slices
from tidemark.llm.phrases import Words, mixed, rolled

REGISTERS = 128
BAND = 4
#: Members of a bucket compared at once.
ROWS, COLUMNS = 256, 1024


def shingles(texts: list, words: int = common.SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of texts: owner, hash and count of every distinct shingle, ordered by owner and hash."""
    found = Words(texts)
    low, lengths, first = found.hashes(0), found.lengths, found.first
    n = np.maximum(lengths - words + 1, 0)
    owner = np.repeat(np.arange(len(texts)), n)
    place = first[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    values = rolled(low, words, 0x9E3779B97F4A7C15)[place] if len(place) else np.zeros(0, dtype=np.uint64)
    short = np.flatnonzero(n == 0)
    if len(short):
        extra = np.zeros(len(short), dtype=np.uint64)
        for k, i in enumerate(short.tolist()):
            h = np.uint64(0x5851F42D4C957F2D)
            for x in low[first[i] : first[i] + lengths[i]]:
                h = mixed(np.array([h ^ x], dtype=np.uint64))[0]
            extra[k] = h
        owner, values = np.concatenate([owner, short]), np.concatenate([values, extra])
    order = np.lexsort((values, owner))
    owner, values = owner[order], values[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (values[1:] != values[:-1])
    at = np.flatnonzero(new)
    return owner[at], values[at], np.diff(np.append(at, len(owner)))


def signatures(owner: np.ndarray, elements: np.ndarray, weights: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash of n weighted sets: in each register the low 16 bits of the first element to arrive."""
    times = np.full(n * registers, np.inf)
    winners = np.zeros(n * registers, dtype=np.uint16)
    clock, turn = np.zeros(len(owner)), 0
    while len(owner):
        turn += 1
        x = mixed(elements + np.uint64(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        clock = clock - np.log(((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52) / weights
        at = owner * registers + (mixed(x ^ np.uint64(0xD6E8FEB86659FD93)) % np.uint64(registers)).astype(np.int64)
        ahead = np.flatnonzero(clock < times[at])
        if len(ahead):
            np.minimum.at(times, at[ahead], clock[ahead])
            won = ahead[clock[ahead] == times[at[ahead]]]
            winners[at[won]] = (mixed(elements[won] ^ np.uint64(0xA0761D6478BD642F)) & np.uint64(0xFFFF)).astype(np.uint16)
        alive = clock < times.reshape(n, registers).max(axis=1)[owner]
        owner, elements, weights, clock = owner[alive], elements[alive], weights[alive], clock[alive]
    return winners.reshape(n, registers)


def similarity(a: tuple, b: tuple) -> float:
    """Exact probability Jaccard of two (sorted hashes, weights)."""
    keys = np.union1d(a[0], b[0])
    x, y = np.zeros(len(keys)), np.zeros(len(keys))
    x[np.searchsorted(keys, a[0])] = a[1]
    y[np.searchsorted(keys, b[0])] = b[1]
    both = np.flatnonzero((x > 0) & (y > 0))
    ratios, counts = np.unique(np.round(x[both] / y[both], 12), return_counts=True)
    # an element of ratio r adds x / sum(max(x', y' r)); its own x is summed over the ratio's elements
    total = 0.0
    which = np.searchsorted(ratios, np.round(x[both] / y[both], 12))
    for k, r in enumerate(ratios.tolist()):
        total += x[both][which == k].sum() / np.maximum(x, y * r).sum()
    return total


def weigh(counts: np.ndarray) -> np.ndarray:
    return 1.0 + np.log(counts)


def nodes(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = common.text_or_empty(text_column)
    return docs.select(F.coalesce(F.col(id_column).cast("long"), -1 - F.abs(F.xxhash64(text) % (1 << 62))).alias("node"), text.alias("text"))


def signed(rows: DataFrame) -> DataFrame:
    """node, the text's 128-bit hash and its signature."""

    def run(batches):
        import xxhash

        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                owner, values, counts = shingles(texts)
                marks = signatures(owner, values, weigh(counts), len(texts))
                keys = [xxhash.xxh3_128_intdigest(t.encode("utf-8", "replace")) for t in texts]
                t1 = np.array([k & 0xFFFFFFFFFFFFFFFF for k in keys], dtype=np.uint64).view(np.int64)
                t2 = np.array([k >> 64 for k in keys], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(t1), pa.array(t2), pa.array([m.tobytes() for m in marks], pa.binary())], ["node", "t1", "t2", "mark"])

    return rows.mapInArrow(run, "node long, t1 long, t2 long, mark binary")


def verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Of pairs (a, b) those whose texts are similar, by exact probability Jaccard."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, ("x", "y"), 64):
                both = part.column("x").to_pylist() + part.column("y").to_pylist()
                owner, values, counts = shingles(both)
                edges = np.searchsorted(owner, np.arange(len(both) + 1))
                sets = [(values[i:j], weigh(counts[i:j])) for i, j in zip(edges[:-1], edges[1:], strict=True)]
                n = part.num_rows
                good = [similarity(sets[i], sets[n + i]) >= threshold - 1e-9 for i in range(n)]
                yield part.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, class): the least node of each node's connected component; shuffles only links."""
    both = common.staged(links.union(links.select("b", "a")).distinct(), "near-links")
    labels = common.staged(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")), "near-labels")
    while True:
        near = both.join(labels, both["b"] == labels["node"]).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("seen"))
        step = labels.join(near, "node").select("node", F.col("label").alias("was"), F.least("label", "seen").alias("label"))
        up = labels.select(F.col("node").alias("label"), F.col("label").alias("above"))
        new = common.staged(step.join(up, "label", "left").select("node", "was", F.least("label", F.coalesce("above", "label")).alias("label")), "near-labels")
        if new.where("label <> was").isEmpty():
            return new.select("node", F.col("label").alias("class"))
        labels = new.select("node", "label")


def shingle_sets(texts: DataFrame) -> DataFrame:
    """node, the sorted 32-bit hashes of its shingles, and their weights where one of them is not 1."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                owner, values, counts = shingles(part.column("text").to_pylist())
                edges = np.searchsorted(owner, np.arange(part.num_rows + 1)).tolist()
                sets, weights = [], []
                for i, j in zip(edges[:-1], edges[1:], strict=True):
                    short = (values[i:j] >> np.uint64(32)).astype(np.uint32)
                    order = np.argsort(short, kind="stable")
                    sets.append(short[order].tobytes())
                    weights.append(weigh(counts[i:j][order]).tobytes() if counts[i:j].max(initial=1) > 1 else None)
                yield pa.RecordBatch.from_arrays([part.column("node"), pa.array(sets, pa.binary()), pa.array(weights, pa.binary())], ["node", "elements", "weights"])

    return texts.mapInArrow(run, "node long, elements binary, weights binary")


def apart(members: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float, best: bool) -> DataFrame:
    """Links between members of a bucket that are in different classes: (a, b).

    The members outside a bucket's largest class are dealt into blocks, each of which meets the whole
    bucket in blocks. Pairs are compared in place, by their sets of 32-bit hashes; only those that pass
    leave the block. best: of each member and other class in a block only the closest one.
    """
    mine = members.join(classes, "node", "left").select("bucket", "node", F.coalesce("class", "node").alias("class"))
    sizes = mine.groupBy("bucket", "class").agg(F.count("*").alias("n"))
    split = sizes.groupBy("bucket").agg(F.max(F.struct("n", "class")).alias("big"), F.sum("n").alias("all"), F.count("*").alias("kinds")).where("kinds > 1")
    split = split.select("bucket", F.col("big.class").alias("largest"), F.ceil((F.col("all") - F.col("big.n")) / ROWS).alias("rows"), F.ceil(F.col("all") / COLUMNS).alias("columns"))
    placed = mine.join(split, "bucket").join(sets, "node")
    key = F.abs(F.xxhash64("node") % (1 << 40))
    outside = placed.where("class <> largest").withColumn("row", key % F.col("rows")).withColumn("column", F.explode(F.expr("sequence(0L, columns - 1)")))
    against = placed.withColumn("column", key % F.col("columns")).withColumn("row", F.explode(F.expr("sequence(0L, rows - 1)")))
    columns = ["bucket", "row", "column", "node", "class", "elements", "weights"]
    dealt = outside.select(*columns, F.lit(True).alias("asks")).unionByName(against.select(*columns, F.lit(False).alias("asks")))

    def weight(raw, n: int) -> np.ndarray:
        return np.ones(n) if raw is None else np.frombuffer(raw, dtype=np.float64)

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        asks = rows["asks"].to_numpy(dtype=bool)
        node, group = rows["node"].to_numpy(), rows["class"].to_numpy()
        sets = [np.frombuffer(e, dtype=np.uint32) for e in rows["elements"]]
        heavy = [w if isinstance(w, bytes | bytearray) else None for w in rows["weights"]]
        at = np.flatnonzero(~asks)
        if not len(at):
            return pd.DataFrame({"a": [], "b": []}, dtype="int64")
        sizes = np.array([len(sets[i]) for i in at])
        values, holder = np.concatenate([sets[i] for i in at]), np.repeat(np.arange(len(at)), sizes)
        order = np.argsort(values, kind="stable")
        values, holder = values[order], holder[order]
        plain = np.array([heavy[i] is None for i in at])
        found = []
        for i in np.flatnonzero(asks):
            low, high = np.searchsorted(values, sets[i]), np.searchsorted(values, sets[i], side="right")
            n = high - low
            places = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(holder[places], minlength=len(at))
            alike = both / (len(sets[i]) + sizes - both)
            odd = np.flatnonzero((both > 0) & ~plain) if heavy[i] is None else np.flatnonzero(both > 0)
            for j in odd.tolist():  # some shingle weighs more than 1
                k = at[j]
                alike[j] = similarity((sets[i], weight(heavy[i], len(sets[i]))), (sets[k], weight(heavy[k], len(sets[k]))))
            near = np.flatnonzero((alike >= threshold - 1e-9) & (group[at] != group[i]))
            if best and len(near):
                near = near[np.lexsort((node[at[near]], -alike[near], group[at[near]]))]
                near = near[np.unique(group[at[near]], return_index=True)[1]]
            found += [(min(node[i], x), max(node[i], x)) for x in node[at[near]]]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("bucket", "row", "column").applyInPandas(compare, "a long, b long").distinct()


def classes(docs: DataFrame, threshold: float = common.SIMILARITY, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(node, class) of every document, copies and documents without a like included."""
    with common.workspace():
        rows = nodes(docs, id_column, text_column)
        sigs = common.staged(signed(rows), "near-signatures")
        texts_of = common.staged(sigs.groupBy("t1", "t2").agg(F.min("node").alias("rep"), F.any_value("mark").alias("mark")), "near-distinct")
        marks = texts_of.select(F.col("rep").alias("node"), "mark")
        width = 2 * BAND
        keyed = marks.select("node", F.explode(F.array(*[F.xxhash64(F.lit(i), F.substring("mark", 1 + i * width, width)) for i in range(REGISTERS // BAND)])).alias("bucket"))
        leads = keyed.groupBy("bucket").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead < last").select("bucket", "lead")
        members = common.staged(keyed.join(leads, "bucket").select("bucket", "node", "lead"), "near-buckets")
        needed = members.select("node").distinct()
        texts = common.staged(rows.join(needed, "node").distinct(), "near-texts")
        tested = common.staged(members.where("node <> lead").select(F.col("lead").alias("a"), F.col("node").alias("b")).distinct(), "near-pairs")
        links = common.staged(verified(tested, texts, threshold), "near-verified")
        groups = components(links)
        sets, best = common.staged(shingle_sets(texts), "near-sets"), True
        while True:
            more = common.staged(apart(members.select("bucket", "node"), groups, sets, threshold, best).join(tested, ["a", "b"], "left_anti"), "near-pairs")
            if more.isEmpty() and not best:
                break
            best = False
            found = common.staged(verified(more, texts, threshold), "near-verified")
            tested = tested.union(more)
            if not found.isEmpty():
                links = links.union(found)
                groups = components(links)
        copies = sigs.join(texts_of.select("t1", "t2", "rep"), ["t1", "t2"]).select("node", "rep").distinct()
        grouped = copies.join(groups.select(F.col("node").alias("rep"), "class"), "rep", "left").select("node", F.coalesce("class", "rep").alias("class"))
        return common.staged(grouped.groupBy("node").agg(F.min("class").alias("class")), "near-classes")


def op6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document: its least id."""
    found = classes(common.table(spark, sf_dir, "documents"))
    return found.select(F.col("node").alias("doc_id"), F.col("class").alias("class_id"), (F.col("node") == F.col("class")).alias("kept"))


def keep_first(docs: DataFrame, threshold: float = common.SIMILARITY) -> DataFrame:
    """The rows of one document of each class: the one with the least id; of repeated rows one."""
    (node,) = common.free(docs, "node")
    found = classes(docs, threshold).where("node = class").select(F.col("node").alias(node))
    text = common.text_or_empty("text")
    own = F.coalesce(F.col("doc_id").cast("long"), -1 - F.abs(F.xxhash64(text) % (1 << 62)))
    return docs.withColumn(node, own).join(found, node).dropDuplicates([node]).select(*[F.col(common.quoted(c)) for c in docs.columns])
