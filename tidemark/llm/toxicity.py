"""Toxicity by nearest labelled examples (operator 9).

The labelled sample is bounded (EXAMPLES, by hash of the id). All examples, clean ones too, and all
documents are TF-IDF vectors over all words of the sample; document frequencies are counted over all
documents. No word is left out: a word that stands in toxic examples oftener than twice its share
weighs more, by one and the strength (in nats) of the binomial bound that this is chance.

The nearest examples by cosine are found exactly by an inverted index with block maxima. Examples are
put into blocks of alike ones. The lists of the rarer words are summed for every example; for the COMMON
most frequent words a block's largest weights bound what its examples can gain. Blocks are opened in
the order of their bounds until no unopened one can hold a nearer example.

Neighbours vote with their cosine; a logistic curve, fitted on leave-one-out votes of the sample, turns
the vote into a calibrated score, and the neighbours are the evidence. A text with no word of the
sample has the sample's smoothed rate among texts without words. As an id is no input of a score, a row
of the sample finds itself among its neighbours; rows that are held out never do.

Nulls count as empty texts and score as texts without words. Labels that are null are passed over; of
several labels of one document the largest counts, and of several rows with one id the least text is
learnt from. Equal cosines are ordered by id. Without any labelled example, as in an empty table, every
score is 0. Batches are cut by bytes, so that long texts do not meet in memory. Columns of other names
are ignored, and kept by accepted().
"""

import math
import pickle
import re
import sys
import threading
import uuid
import zlib
from collections import Counter
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.common import slices, trimmed

#: Labelled documents that are learnt from, at most.
EXAMPLES = 10_000
NEIGHBOURS = 15
#: Examples in a block, and frequent words that are bounded by block before they are summed.
BLOCK, COMMON = 128, 256
#: Votes that a neighbourhood starts with, at the sample's toxic rate.
PRIOR = 0.5
#: Seconds that a Python worker keeps the model after a task.
IDLE = 3.0
WORD = re.compile(r"\w+")


def held_out(id_column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def words_of(text: str) -> list:
    return WORD.findall(text.lower())


def tail(k: int, n: int, p: float) -> float:
    """Log of the chance of k or more successes in n (an upper bound by Chernoff)."""
    q = k / n
    if q <= p:
        return 0.0
    return -n * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0.0))


def blocks_of(vectors: np.ndarray, size: int) -> np.ndarray:
    """An order of the rows in which alike ones are neighbours: halves by the coordinate that varies most, until they fit a block."""
    flat = vectors - vectors.mean(axis=0)
    _, axes = np.linalg.eigh(flat.T @ flat)
    points, out, todo = flat @ axes[:, -8:], [], [np.arange(len(vectors))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            out.append(rows)
            continue
        widest = points[rows].var(axis=0).argmax()
        rows = rows[np.argsort(points[rows, widest], kind="stable")]
        middle = (len(rows) // 2 + size - 1) // size * size
        todo += [rows[middle:], rows[:middle]]
    return np.concatenate(out)


class Index:
    """Unit vectors of examples as lists by term, in blocks. Weights are 32-bit numbers; sums are of 64 bits."""

    def __init__(self, places: np.ndarray, terms: np.ndarray, counts: np.ndarray, labels: np.ndarray, ids: np.ndarray, idf: np.ndarray):
        n, self.idf = len(ids), np.asarray(idf, dtype=np.float64)
        weights = (1 + np.log(counts)) * self.idf[terms]
        weights = (weights / np.sqrt(np.bincount(places, weights * weights, n))[places]).astype(np.float32)
        lengths = np.bincount(terms, minlength=len(self.idf))
        common_terms = np.argsort(-lengths, kind="stable")[:COMMON]
        self.column = np.full(len(self.idf), -1, dtype=np.int32)
        self.column[common_terms] = np.arange(len(common_terms))
        often = self.column[terms] >= 0
        dense = np.zeros((n, len(common_terms)), dtype=np.float32)
        dense[places[often], self.column[terms[often]]] = weights[often]
        order = blocks_of(dense[:, :64].astype(np.float64), BLOCK)
        count = -(-n // BLOCK)
        self.home = np.empty(n, dtype=np.int32)
        self.home[order] = np.arange(n)
        self.ids, self.labels = np.full(count * BLOCK, -1, dtype=np.int64), np.zeros(count * BLOCK)
        self.ids[:n], self.labels[:n] = np.asarray(ids)[order], np.asarray(labels)[order]
        self.dense = np.zeros((count, BLOCK, dense.shape[1]), dtype=np.float32)
        self.dense.reshape(count * BLOCK, -1)[:n] = dense[order]
        self.most = self.dense.max(axis=1)
        seldom = np.flatnonzero(~often)
        seldom = seldom[np.argsort(terms[seldom], kind="stable")]
        self.places, self.weights = self.home[places[seldom]].astype(np.intp), weights[seldom]
        self.starts = np.searchsorted(terms[seldom], np.arange(len(self.idf) + 1))

    def nearest(self, terms: np.ndarray, weights: np.ndarray, skip: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Places and cosines of the nearest examples, nearest first, ties by id; skip: the number of an example left out."""
        count = len(self.dense)
        column = self.column[terms]
        often = column >= 0
        query = np.zeros(self.dense.shape[2])
        query[column[often]] = weights[often]
        rare = terms[~often]
        low = self.starts[rare]
        size = self.starts[rare + 1] - low
        at = np.repeat(low - (np.cumsum(size) - size), size) + np.arange(size.sum())
        sums = np.bincount(self.places[at], self.weights[at] * np.repeat(weights[~often], size), count * BLOCK)
        if skip >= 0:
            sums[self.home[skip]] = -2.0 * count
        sums = sums.reshape(count, BLOCK)
        short = query.astype(np.float32)
        bounds = sums.max(axis=1) + self.most @ short + 1e-5
        scores, least, tops = np.full((count, BLOCK), -1.0), 0.0, np.zeros(0)
        for b in np.argsort(-bounds).tolist():
            if bounds[b] < least or bounds[b] <= 1e-5:
                break
            scores[b] = gained = sums[b] + self.dense[b] @ short
            better = gained[gained > least]
            if len(better):
                tops = np.concatenate([tops, better])
                if len(tops) >= NEIGHBOURS:
                    tops = np.partition(tops, -NEIGHBOURS)[-NEIGHBOURS:]
                    least = tops[0]
        found = np.flatnonzero(scores.ravel() >= max(least - 2e-5, 1e-12))
        cosines = np.round(sums.ravel()[found] + self.dense.reshape(count * BLOCK, -1)[found].astype(np.float64) @ query, 12)
        best = np.lexsort((self.ids[found], -cosines))[:NEIGHBOURS]
        best = best[cosines[best] > 0]
        return found[best], cosines[best]


def unit(terms: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    weights = (1 + np.log(counts)) * idf[terms]
    return weights / math.sqrt(float(weights @ weights))


class Model:
    """Everything a task needs: words, index, calibration. Its size is bounded by the words of EXAMPLES texts.

    It travels packed and is unpacked by each Python worker, which keeps the latest model only, and that for a short while.
    """

    def __init__(self, words: list, counted: "tuple | None", rate: float, none: float):
        self.rate, self.none = rate, none
        self.terms = {w: i for i, w in enumerate(words)}
        self.ids = None if counted is None else counted[4]
        self.index = None if counted is None else Index(*counted)

    @staticmethod
    def packed(words: list, counted: "tuple | None", rate: float, none: float) -> tuple[str, bytes]:
        """A key and the model as bytes: words, term numbers as steps within an example, counts; numbers byte by byte, which packs well."""
        if counted is not None:
            places, terms, counts, labels, ids, idf = counted
            terms = np.asarray(terms, dtype="<i4")
            steps = np.diff(terms, prepend=np.int32(0))
            first = np.flatnonzero(np.diff(places, prepend=-1))
            steps[first] = terms[first]
            counted = (np.bincount(places, minlength=len(ids)).astype("<i4"), *[x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in (steps.astype("<i4"), counts.astype("<i4"))], labels, ids, idf.astype(np.float64))
        return uuid.uuid4().hex, zlib.compress(pickle.dumps(("\n".join(words).encode("utf-8", "surrogatepass"), counted, rate, none)), 6)

    @staticmethod
    def unpacked(key: str, data: bytes) -> "Model":
        words, counted, rate, none = pickle.loads(zlib.decompress(data))
        words = words.decode("utf-8", "surrogatepass").split("\n") if words else []
        if counted is not None:
            sizes, steps, counts, *rest = counted
            steps, counts = (np.frombuffer(x, np.uint8).reshape(4, -1).T.copy().view("<i4").ravel() for x in (steps, counts))
            sums = np.cumsum(steps, dtype=np.int64)
            first = np.cumsum(sizes) - sizes
            some = sizes > 0
            before = np.zeros(len(sizes), dtype=np.int64)
            before[some] = sums[first[some]] - steps[first[some]]
            counted = (np.repeat(np.arange(len(sizes)), sizes), sums - np.repeat(before, sizes), counts, *rest)
        return Model(words, counted, rate, none)

    @staticmethod
    @contextmanager
    def borrowed(key: str, data: bytes):
        """The model for one task. The worker keeps it for the next task, and drops it where none comes for IDLE seconds."""
        held = vars(sys).setdefault("tidemark_models", {})
        timer = held.pop("timer", None)
        if timer:
            timer.cancel()
        model = held.get(key)
        if model is None:
            held.clear()
            model = held[key] = Model.unpacked(key, data)
            trimmed()
        try:
            yield model
        finally:
            del model

            def drop() -> None:
                held.clear()
                trimmed()

            held["timer"] = timer = threading.Timer(IDLE, drop)
            timer.daemon = True
            timer.start()

    def vote(self, places: np.ndarray, cosines: np.ndarray) -> float:
        return float((cosines @ self.index.labels[places] + PRIOR * self.rate) / (cosines.sum() + PRIOR))

    def score(self, text: str, curve: tuple) -> tuple[float, list]:
        terms = self.terms
        counts = Counter([terms[w] for w in words_of(text) if w in terms])
        if not counts or self.index is None:
            return self.none, []
        at, n = np.fromiter(counts, np.int64, len(counts)), np.fromiter(counts.values(), np.float64, len(counts))
        places, cosines = self.index.nearest(at, unit(at, n, self.index.idf))
        return curved(self.vote(places, cosines), curve), self.index.ids[places].tolist()


def curved(vote: float, curve: tuple) -> float:
    x = math.log(max(vote, 1e-6) / max(1 - vote, 1e-6))
    return 1 / (1 + math.exp(-max(min(curve[0] * x + curve[1], 30), -30)))


def fitted(votes: list, labels: list) -> tuple:
    """Slope (not negative) and offset of a logistic curve over the votes' log odds, lightly held to (1, 0)."""
    if not votes:
        return 1.0, 0.0
    x = np.array([math.log(max(v, 1e-6) / max(1 - v, 1e-6)) for v in votes])
    y, (a, b) = np.array(labels, dtype=np.float64), (1.0, 0.0)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p)
        g = np.array([((p - y) * x).sum() + (a - 1), (p - y).sum() + b])
        h = np.array([[(w * x * x).sum() + 1, (w * x).sum()], [(w * x).sum(), w.sum() + 1]])
        step = np.linalg.solve(h, g)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return max(float(a), 0.0), float(b)


def sample(docs: DataFrame, labels: DataFrame, limit: int) -> DataFrame:
    """doc_id, toxic and text of the bounded sample, a row for each id; the ids are at most `limit`, so they are broadcast."""
    known = labels.where(~held_out()).where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(limit)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), common.text_or_empty().alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))


def counted(rows: DataFrame) -> DataFrame:
    """doc_id, toxic, and the words of every example with their counts."""

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                found = [Counter(words_of(t)) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("toxic"), pa.array([list(c) for c in found], pa.list_(pa.string())), pa.array([list(c.values()) for c in found], pa.list_(pa.int64()))], ["doc_id", "toxic", "words", "counts"])

    return rows.select("doc_id", "toxic", "text").mapInArrow(run, "doc_id long, toxic int, words array<string>, counts array<long>")


def frequencies(docs: DataFrame, words: list) -> np.ndarray:
    """Documents of the whole table that hold each word; the tasks send at most one row a word."""
    data = zlib.compress("\n".join(words).encode("utf-8", "surrogatepass"), 6)

    def run(batches):
        terms = {w: i for i, w in enumerate(zlib.decompress(data).decode("utf-8", "surrogatepass").split("\n"))}
        total = np.zeros(len(terms), dtype=np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                found = [terms[w] for text in part.column("text").to_pylist() for w in set(words_of(text)) if w in terms]
                total += np.bincount(np.array(found, dtype=np.int64), minlength=len(terms))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["term", "n"])

    rows = docs.select(common.text_or_empty().alias("text")).mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(words), dtype=np.int64)
    df[rows["term"].to_numpy()] = rows["n"].to_numpy()
    return df


def telling(bad: np.ndarray, n: np.ndarray, rate: float) -> np.ndarray:
    """What each word's weight is multiplied with: 1, and more for words of toxic examples."""
    return np.array([1 - tail(b, k, rate) if b > 2 * rate * k else 1.0 for b, k in zip(bad.tolist(), n.tolist(), strict=True)])


def votes(rows: DataFrame, key: str, data: bytes) -> list:
    """(doc_id, vote, label) of every example with words, left out of its own neighbourhood, by id."""

    def run(batches):
        with Model.borrowed(key, data) as model:
            for batch in batches:
                found = []
                for i, words, counts in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "words", "counts")], strict=True):
                    at = np.array([model.terms[w] for w in words], dtype=np.int64)
                    places, cosines = model.index.nearest(at, unit(at, np.array(counts, dtype=np.float64), model.index.idf), int(np.searchsorted(model.ids, i)))
                    found.append(model.vote(places, cosines))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.float64())], ["doc_id", "toxic", "vote"])

    out = rows.where(F.size("words") > 0).mapInArrow(run, "doc_id long, toxic int, vote double").toArrow()
    return sorted(zip(*[out[c].to_pylist() for c in ("doc_id", "vote", "toxic")], strict=True))


def learn(docs: DataFrame, labels: DataFrame, limit: int = EXAMPLES) -> tuple[str, bytes, tuple]:
    """Count the sample's words over all documents, weigh them, index and calibrate the sample: the packed model and its curve."""
    with common.workspace(keep_last=False):
        rows = common.staged(counted(sample(docs, labels, limit)), "toxic-sample")
        sizes = F.size("words")
        n, toxic, silent, silent_toxic = rows.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0)), F.count(F.when(sizes == 0, 1)), F.coalesce(F.sum(F.when(sizes == 0, F.col("toxic"))), F.lit(0))).first()
        if not n:
            return *Model.packed([], None, 0.0, 0.0), (1.0, 0.0)
        rate = (toxic + 0.5) / (n + 1)
        none = float((silent_toxic + rate) / (silent + 1))
        # frequent words get the small numbers: this packs well
        words = rows.select(F.explode("words").alias("word"), "toxic").groupBy("word").agg(F.count("*").alias("held"), F.sum("toxic").alias("bad")).toArrow().sort_by([("held", "descending"), ("word", "ascending")])
        if not words.num_rows:
            return *Model.packed([], None, rate, none), (1.0, 0.0)
        held, bad, names = words["held"].to_numpy(), words["bad"].to_numpy(), words["word"].to_pylist()
        del words
        weight = (np.log((1 + docs.count()) / (1 + frequencies(docs, names))) + 1) * telling(bad, held, rate)
        key, data = Model.packed(names, (*postings(rows, names), weight), rate, none)
        del names, weight
        trimmed()
        found = votes(rows, key, data)
        trimmed()
        return key, data, fitted([v for _, v, _ in found], [y for _, _, y in found])


def postings(rows: DataFrame, names: list) -> tuple:
    """places, terms, counts, labels and ids of the examples by id, terms in order within each; numbers alone reach the driver."""
    data = zlib.compress("\n".join(names).encode("utf-8", "surrogatepass"), 6)

    def run(batches):
        terms = {w: i for i, w in enumerate(zlib.decompress(data).decode("utf-8", "surrogatepass").split("\n"))}
        for batch in batches:
            found = [sorted(zip([terms[w] for w in words], counts, strict=True)) for words, counts in zip(batch.column("words").to_pylist(), batch.column("counts").to_pylist(), strict=True)]
            lists = [pa.array([[x[k] for x in f] for f in found], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("toxic"), *lists], ["doc_id", "toxic", "terms", "counts"])

    small = rows.select("doc_id", "toxic", "words", "counts").mapInArrow(run, "doc_id long, toxic int, terms array<int>, counts array<int>").toArrow().sort_by("doc_id").combine_chunks()
    terms = small["terms"].combine_chunks()
    sizes = terms.value_lengths().to_numpy()
    places = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    return places, terms.flatten().to_numpy(), small["counts"].combine_chunks().flatten().to_numpy(), small["toxic"].to_numpy(), small["doc_id"].to_numpy()


def scored(docs: DataFrame, learnt: tuple[str, bytes, tuple]) -> DataFrame:
    """doc_id, score, predicted and the ids of the nearest examples of every row."""
    rows = docs.select("doc_id", common.text_or_empty().alias("text"))
    key, data, curve = learnt

    def run(batches):
        with Model.borrowed(key, data) as model:
            for part in (part for batch in batches for part in slices(batch, "text")):
                found = [model.score(t, curve) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array([f[0] for f in found], pa.float64()), pa.array([int(f[0] >= 0.5) for f in found], pa.int32()), pa.array([f[1] for f in found], pa.list_(pa.int64()))], ["doc_id", "score", "predicted", "evidence"])

    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int, evidence array<long>")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document."""
    docs = common.table(spark, sf_dir, "documents")
    found = scored(docs, learn(docs, common.table(spark, sf_dir, "labels")))
    return found.select("doc_id", held_out().alias("held_out"), "score", "predicted", "evidence")


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted toxic, with their own columns."""
    key, data, curve = learn(docs, labels)
    # by place, as Arrow functions take no names with dots
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])
    columns, text = plain.columns, f"c{[c.lower() for c in docs.columns].index('text')}"

    def run(batches):
        with Model.borrowed(key, data) as model:
            for part in (part for batch in batches for part in slices(batch, "text")):
                keep = pa.array([model.score(t, curve)[0] < 0.5 for t in part.column("text").to_pylist()], pa.bool_())
                yield part.filter(keep).select(columns)

    return plain.withColumn("text", common.text_or_empty(text)).mapInArrow(run, plain.schema).toDF(*docs.columns)
