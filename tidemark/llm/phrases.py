"""Substring dedup by repeated-phrase automata (operator 4).

A window is 13 consecutive words. A word is removed if a window over it also starts in a document
with a smaller id, judged on the input.

1. Anchors. Each window is stood for by the least hash of its 7-word runs. That depends on the
   window's words alone, so equal windows have equal anchors, and neighbouring windows mostly
   share one: about a quarter as many anchors as words. One aggregation finds the anchors that two
   documents have; it combines in each task before the shuffle, so a hot passage costs one row a task.
2. Confirmation. Windows under such anchors are hashed whole (96 bits) and aggregated the same
   way: those that two documents have are confirmed, each with its first document.
3. Automata. The confirmed windows' words, taken from their first documents, are dealt to shards
   by anchor and compiled with pyahocorasick, words as letters. Every document's text under shared
   anchors streams through the automaton of its shard; a match is exact, word for word, and counts
   where the first document's id is smaller. Text under unshared anchors cannot match and is not
   sent. Shards hold a bounded, small number of runs; an anchor with many occurrences has its stream
   dealt over several copies of its patterns.

Nulls count as empty texts, which have no words; a null id stands after all others. Rows with the
same id never cover each other; repeated rows get equal results, as all rows without an id are of one
such id. An empty table gives an empty table. Texts are taken whole, in batches of bounded bytes, and
columns of any other name are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import slices, trimmed

WINDOW = 13
ANCHOR = 7
#: Occurrences of an anchor that one copy of its patterns serves.
SHARD_RUNS = 20_000
#: Runs of windows under one anchor that a shard holds or streams, about. An automaton looks through all first words of its patterns, one after the other, at each step from its root, so it must be small.
PATTERN_RUNS = 1_000
LAST = 2**63 - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(h: np.ndarray, n: int, base: int) -> np.ndarray:
    """A hash of every n consecutive entries, dependent on their order."""
    size = max(0, len(h) - n + 1)
    out = np.zeros(size, dtype=np.uint64)
    for j in range(n):
        out = out * np.uint64(base) + h[j : j + size]
    return mixed(out)


def least(g: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every n consecutive entries."""
    have = 1
    while have * 2 <= n:
        g = np.minimum(g[:-have], g[have:]) if len(g) > have else g[:0]
        have *= 2
    if have < n:
        g = np.minimum(g[: len(g) - (n - have)], g[n - have :]) if len(g) > n - have else g[:0]
    return g


SPACES = np.zeros(256, dtype=bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True


class Words:
    """The words of a batch of texts, found and hashed in one sweep over their bytes.

    A word's hash is a polynomial over a random value for each byte, taken as a difference of running
    sums; everything wraps at 64 bits. start and end are places in data, doc the owner of each word.
    """

    def __init__(self, texts: list):
        parts = [t.encode("utf-8", "replace") for t in texts]
        self.data = b"\n".join(parts)
        self.bytes = np.frombuffer(self.data, dtype=np.uint8)
        inside = np.zeros(len(self.bytes) + 2, dtype=np.int8)
        inside[1:-1] = ~SPACES[self.bytes]
        edges = np.diff(inside)
        self.start, self.end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
        sizes = np.array([len(p) + 1 for p in parts], dtype=np.int64)
        self.doc = np.searchsorted(np.cumsum(sizes) - sizes, self.start, side="right") - 1
        self.lengths = np.bincount(self.doc, minlength=len(parts))
        self.first = np.cumsum(self.lengths) - self.lengths

    def hashes(self, salt: int) -> np.ndarray:
        values = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15 * (2 * salt + 1) % 2**64))
        base = (0xD1342543DE82EF95 + 0x632BE59BD9B4E01A * salt) % 2**64 | 1
        n = len(self.bytes)
        power = powers(base, n)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values[self.bytes] * power, out=sums[1:])
        back = powers(pow(base, -1, 2**64), n)
        return mixed((sums[self.end] - sums[self.start]) * back[self.start] + (self.end - self.start).astype(np.uint64))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.cumprod(out, out=out) if n else out


class Windows(Words):
    """Words with the anchors and hashes of their windows."""

    def __init__(self, texts: list):
        super().__init__(texts)
        self.low = self.hashes(0)
        runs = np.maximum(self.lengths - WINDOW + 1, 0)
        self.owner = np.repeat(np.arange(len(texts)), runs)
        self.at = np.arange(len(self.owner)) - np.repeat(np.cumsum(runs) - runs, runs)
        self.place = self.first[self.owner] + self.at
        anchors = least(rolled(self.low, ANCHOR, 0x9E3779B97F4A7C15), WINDOW - ANCHOR + 1)
        self.anchor = anchors[self.place].view(np.int64) if len(self.place) else np.zeros(0, dtype=np.int64)

    def changes(self) -> np.ndarray:
        """True where a window's anchor differs from that of the window before it in its document."""
        new = np.ones(len(self.owner), dtype=bool)
        new[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.owner[1:] != self.owner[:-1])
        return new

    def windows(self, chosen: np.ndarray, salt: int) -> np.ndarray:
        """Hashes of whole windows."""
        h = self.low if salt == 0 else self.hashes(salt)
        return rolled(h, WINDOW, 0xAF251AF3B0F025B5 + 2 * salt)[self.place[chosen]].view(np.int64)


def anchors_of(docs: DataFrame) -> DataFrame:
    """(doc, anchors): each document's distinct anchors."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", 512):
                w = Windows(part.column("text").to_pylist())
                new = w.changes()
                counts = np.bincount(w.owner[new], minlength=part.num_rows)
                offsets = pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32())
                yield pa.RecordBatch.from_arrays([part.column("doc"), pa.ListArray.from_arrays(offsets, pa.array(w.anchor[new]))], ["doc", "anchors"])

    return common.staged(docs.select("doc", "text").mapInArrow(run, "doc long, anchors array<long>"), "phrases-anchors")


def candidates(docs: DataFrame) -> DataFrame:
    """Documents with windows under shared anchors: doc, h, text, and the shared anchors with the copies their patterns need."""
    anchors = anchors_of(docs)
    spread = anchors.select("doc", F.explode("anchors").alias("anchor"))
    shared = spread.groupBy("anchor").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("n")).where("lo < hi")
    shared = shared.select("anchor", F.ceil(F.col("n") / SHARD_RUNS).cast("int").alias("copies"))
    mine = common.staged(spread.join(shared, "anchor").groupBy("doc").agg(F.collect_set(F.struct("anchor", "copies")).alias("shared")), "phrases-shared")
    common.release(anchors)
    found = common.staged(docs.join(mine, "doc").select("doc", "h", "text", F.col("shared.anchor").alias("anchors"), F.col("shared.copies").alias("copies")), "phrases-candidates")
    common.release(mine)
    return found


def among(owner: np.ndarray, value: np.ndarray, lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which (owner, value) stand in their owner's list, and the place of each found one in the flattened lists."""
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    holder = np.repeat(np.arange(len(lists)), sizes)
    keys = lists.flatten().to_numpy()
    if not len(keys) or not len(value):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    names, ranks = np.unique(keys, return_inverse=True)
    have = holder * len(names) + ranks
    order = np.argsort(have, kind="stable")
    have = have[order]
    rank = np.minimum(np.searchsorted(names, value), len(names) - 1)
    want = owner * len(names) + rank
    at = np.minimum(np.searchsorted(have, want), len(have) - 1)
    found = np.flatnonzero((have[at] == want) & (names[rank] == value))
    return found, order[at[found]]


def confirmed(hot: DataFrame) -> DataFrame:
    """(doc, marks): for each first document, the hashes of the windows that later documents share."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Windows(part.column("text").to_pylist())
                keep, _ = among(w.owner, w.anchor, part.column("anchors"))
                ids = part.column("doc").to_numpy(zero_copy_only=False)
                yield pa.RecordBatch.from_arrays([pa.array(w.windows(keep, 0)), pa.array(w.windows(keep, 1).astype(np.int32)), pa.array(ids[w.owner[keep]])], ["low", "high", "doc"])

    windows = hot.select("doc", "text", "anchors").mapInArrow(run, "low long, high int, doc long")
    twice = windows.groupBy("low", "high").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).where("first < last")
    return twice.groupBy(F.col("first").alias("doc")).agg(F.collect_set("low").alias("marks"))


RUN = {"shard": pa.int32(), "kind": pa.int32(), "doc": pa.int64(), "h": pa.int64(), "start": pa.int32(), "words": pa.binary()}


def runs(hot: DataFrame, shards: int) -> DataFrame:
    """One row for each run of consecutive candidate windows under one anchor, with its words and shard.

    Windows among their document's marks are patterns (kind 0), in every copy of the shard that streams
    need; no smaller id has them, so only the other windows are streamed (kind 1).
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                w = Windows(part.column("text").to_pylist())
                keep, where = among(w.owner, w.anchor, part.column("anchors"))
                copies = part.column("copies").flatten().to_numpy()[where].astype(np.int64)
                stream = np.ones(len(keep), dtype=bool)
                if len(keep):
                    stream[among(w.owner[keep], w.windows(keep, 0), part.column("marks"))[0]] = False
                owner, anchor, at = w.owner[keep], w.anchor[keep], w.at[keep]
                cut = np.ones(len(keep), dtype=bool)
                cut[1:] = (owner[1:] != owner[:-1]) | (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1) | (stream[1:] != stream[:-1])
                begins = np.flatnonzero(cut)
                last = np.append(begins[1:], len(keep)) - 1 if len(begins) else begins
                ids, hs = (part.column(c).to_numpy(zero_copy_only=False) for c in ("doc", "h"))
                n, streamed = copies[begins], stream[begins]
                # by id and text, so that the copies of one text go to different shards
                dealt = (mixed(ids.view(np.uint64) + mixed(hs.view(np.uint64))) >> np.uint64(2)).astype(np.int64)
                many = np.where(streamed, 1, n)
                row = np.repeat(np.arange(len(begins)), many)
                copy = np.where(streamed[row], dealt[owner[begins]][row] % np.maximum(n[row], 1), np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many))
                key = mixed(anchor[begins][row].view(np.uint64) + mixed(copy.astype(np.uint64) + np.uint64(1)))
                texts = [w.data[b:e] for b, e in zip(w.start[w.place[keep[begins]]].tolist(), w.end[w.place[keep[last]] + WINDOW - 1].tolist(), strict=True)]
                columns = [(key % np.uint64(shards)).astype(np.int32), streamed[row].astype(np.int32), ids[owner[begins]][row], hs[owner[begins]][row], at[begins][row].astype(np.int32), pa.array(texts, pa.binary()).take(pa.array(row, pa.int64()))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) if isinstance(c, np.ndarray) else c for c, k in zip(columns, RUN.values(), strict=True)], list(RUN))

    return hot.mapInArrow(run, "shard int, kind int, doc long, h long, start int, words binary")


def shards_for(total: int) -> int:
    """Shards for so many occurrences of anchors in documents."""
    return 1 + total // min(PATTERN_RUNS, SHARD_RUNS)


def letter(n: int) -> str:
    """The n-th character that is not a surrogate; character 0 stands for words that no pattern has."""
    return chr(n if n < 0xD800 else n + 0x800)


def matches(rows: DataFrame) -> DataFrame:
    """Compile each shard's patterns and stream its texts: (doc, h, starts) of windows that a smaller id has.

    A shard's words are numbered and written as one character each, so that a window is a string of 13
    characters. Rows come by shard, patterns first and greater ids first: of equal patterns the least id stays.
    """

    def run(batches):
        import ahocorasick

        shard = automaton = None
        letters: dict = {}
        ready = False
        for batch in batches:
            out = []
            for at, kind, doc, h, start, text in zip(*[c.to_numpy().tolist() for c in batch.columns[:-1]], batch.column("words").to_pylist(), strict=True):
                if at != shard:
                    shard, letters, ready, automaton = at, {}, False, ahocorasick.Automaton(ahocorasick.STORE_ANY)
                words = text.split()
                if kind == 0:
                    for x in words:
                        if x not in letters:
                            letters[x] = letter(len(letters) + 1)
                    line = "".join(map(letters.__getitem__, words))
                    for c in range(len(line) - WINDOW + 1):
                        automaton.add_word(line[c : c + WINDOW], doc)
                    continue
                if not ready:
                    if len(automaton):
                        automaton.make_automaton()
                    ready = True
                if len(automaton):
                    found = [start + end - WINDOW + 1 for end, first in automaton.iter("".join([letters.get(x, "\0") for x in words])) if first < doc]
                    if found:
                        out.append((doc, h, found))
            columns = zip(*out, strict=True) if out else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.list_(pa.int32())], strict=True)], ["doc", "h", "starts"])
        del automaton, letters
        trimmed()

    return rows.mapInArrow(run, "doc long, h long, starts array<int>")


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = common.text_or_empty(text_column)
    return docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(LAST)).alias("doc"), F.xxhash64(text).alias("h"), text.alias("text"))


def located(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> tuple[DataFrame, DataFrame]:
    """The repeated windows of every document that has some: (doc, h, starts), and the texts they refer to.

    h is the hash of the row's text, so that rows with the same id stay apart.
    """
    rows = keyed(docs, id_column, text_column)
    hot = candidates(rows)
    marks = common.staged(confirmed(hot), "phrases-marks")
    tagged = hot.join(marks, "doc", "left").select("doc", "h", "text", "anchors", "copies", F.coalesce("marks", F.array().cast("array<bigint>")).alias("marks"))
    texts = common.staged(tagged, "phrases-tagged")
    common.release(hot)
    total = texts.agg(F.sum(F.size("anchors"))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = runs(texts, shards_for(total)).repartition(n, "shard").sortWithinPartitions("shard", "kind", F.desc("doc"))
    found = matches(dealt).groupBy("doc", "h").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return common.staged(found, "phrases-found"), texts


def covered(n: int, starts: list) -> np.ndarray:
    """Which of n words a window from one of the starts covers."""
    edge = np.zeros(n + 1, dtype=np.int64)
    starts = np.unique(np.asarray(starts, dtype=np.int64))
    edge[starts] += 1
    np.subtract.at(edge, np.minimum(starts + WINDOW, n), 1)
    return np.cumsum(edge[:-1]) > 0


def stripped(found: DataFrame, texts: DataFrame) -> DataFrame:
    """doc, h, n_words, n_removed and the text that is left of every document with repeats."""

    def run(batches):
        for part in (part for batch in batches for part in slices(batch, "text")):
            rows = []
            for doc, h, starts, text in zip(*[part.column(c).to_pylist() for c in ("doc", "h", "starts", "text")], strict=True):
                words = text.encode("utf-8", "replace").split()
                gone = covered(len(words), starts)
                rows.append((doc, h, len(words), int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g]).decode()))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()], strict=True)], ["doc", "h", "n_words", "n_removed", "kept"])

    return found.join(texts.select("doc", "h", "text"), ["doc", "h"]).mapInArrow(run, "doc long, h long, n_words long, n_removed long, kept string")


def whole(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Of every row: doc, h, its number of words and the digest of all its words."""

    def run(batches):
        for part in (part for batch in batches for part in slices(batch, "text")):
            words = [t.encode("utf-8", "replace").split() for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc"), part.column("h"), pa.array([len(w) for w in words], pa.int64()), pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string())], ["doc", "h", "n_words", "all_sha256"])

    return keyed(docs, id_column, text_column).mapInArrow(run, "doc long, h long, n_words long, all_sha256 string")


def digests(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every row."""
    with common.workspace():
        left = stripped(*located(docs, id_column, text_column)).select("doc", "h", "n_removed", F.sha2(F.col("kept"), 256).alias("left_sha256"))
        left = common.staged(left.dropDuplicates(["doc", "h"]), "phrases-left")
    return (
        whole(docs, id_column, text_column)
        .join(left, ["doc", "h"], "left")
        .select(F.when(F.col("doc") != LAST, F.col("doc")).alias("doc_id"), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"), F.coalesce("left_sha256", "all_sha256").alias("kept_sha256"))
    )


def op4_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages that an earlier one has."""
    return digests(common.table(spark, sf_dir, "documents"))
