"""The training-data operators against brute force on small tables, and their edge cases."""

import collections
import hashlib
import math
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, fingerprints, licenses, lines, media, mixing, near, phrases, pieces, queries, toxicity, urls

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, sources=None):
    ids = list(range(len(texts))) if ids is None else ids
    sources = [f"s{i % 2}" for i in range(len(texts))] if sources is None else sources
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t)) for i, t, s in zip(ids, texts, sources, strict=True)], DOCS)


def written(df, folder, name="documents"):
    df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
    return str(folder)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, nulls, empty and long texts, repeated lines."""
    rng = random.Random(11)
    base = [prose(rng, rng.randrange(20, 120), 5000) for _ in range(25)]
    passage = prose(rng, 60, 5000)
    texts = list(base)
    texts += [base[0], base[0], base[1]]
    for k in range(6):
        words = base[2].split()
        for _ in range(k // 2):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(1000)}"
        texts.append(" ".join(words))
    texts += [f"{prose(rng, 15, 5000)} {passage} {prose(rng, 9, 5000)}" for _ in range(4)]
    texts += [None, "", " \n\t ", "one", "one two three", "Of.\nOf.\nThe line here is long enough.\nOf.", prose(rng, 6000, 5000), "x" * 5000, "▁ a  b c \U0001f600", "a\nb\na"]
    return texts


def split(text):
    return (text or "").encode().split()


# 1


def test_urls(spark, tmp_path):
    page = lambda i, url, *links: (i, url, "<p>" + "".join(f'<a HREF = "{x}">z</a>' for x in links) + "</p>")
    rows = [
        page(1, "http://Bad.net/a?x", "http://far.org/", "/same"),
        page(2, "http://hub.com/en/1", "https://bad.net/p", "//BAD.net/q"),
        page(3, "http://hub2.com/", "http://hub.com/"),
        page(4, "https://www.example.net/en/9#t"),
        page(5, "https://www.example.net/de/9"),
        page(6, "http://a.example.com/de/1"),
        page(7, "http://a.example.com/fr/1"),
        page(8, "http://good.org/fr/x", "http://friend.com/"),
        page(9, "http://friend.com/x"),
        page(10, "nothing"),
        page(11, "http://notnet/x"),
        page(12, "http://bad.net"),
        page(13, "http://good.org/fr/x", "http://friend.com/"),
        (14, None, None),
    ]
    sf = written(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash")), tmp_path, "pages")
    got = {r.page_id: r for r in urls.op1_urls(spark, sf).collect()}
    assert len(got) == 14
    assert (got[1].host, got[1].path, got[1].rule, got[1].verdict) == ("bad.net", "/a", "net/", "block")
    assert (got[4].rule, got[4].verdict) == ("example.net/en/", "allow") and got[5].rule == "net/"
    assert got[6].verdict == "block" and (got[7].rule, got[7].verdict) == (None, "block")  # half of the host's pages are blocked
    assert (got[2].rule, got[2].verdict) == (None, "block") and got[3].verdict == "block"  # they link to the blocked host
    assert got[9].verdict == "allow" and got[11].rule is None
    assert (got[12].host, got[12].path, got[12].rule, got[12].verdict) == ("bad.net", "", None, "block")
    assert (got[10].host, got[10].path, got[10].verdict) == ("", "", "allow") and got[14].host == ""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * EXCLUDE (host) FROM '{sf}/pages.parquet/*.parquet'")
    want = {r[0]: r[1:] for r in con.execute(urls.sql()).fetchall()}
    assert want == {i: (r.host, r.path, r.rule, r.verdict) for i, r in got.items()}
    empty = written(spark.createDataFrame([], "page_id long, url string, html string"), tmp_path / "e", "pages")
    assert urls.op1_urls(spark, empty).count() == 0


def test_urls_of_farms_and_chains(spark):
    links = {f"farm{k}.com": "bad.net" for k in range(50)} | {"far0.com": "worse.net"} | {f"far{k}.com": f"far{k - 1}.com" for k in range(1, 12)}
    rows = [(src, f'<a href="http://{dst}/">z</a>') for src, dst in links.items()] + [("bad.net", ""), ("worse.net", ""), ("lone.com", '<a href="http://other.com/">z</a>')]
    pages = spark.createDataFrame([(i, f"http://{host}/", html) for i, (host, html) in enumerate(rows)], "page_id long, url string, html string")
    got = {r.host: r for r in urls.judged(pages).collect()}
    assert {h for h, r in got.items() if r.verdict == "allow"} == {"lone.com"}
    assert all(abs(got[f"far{k}.com"].distrust - 0.15 * 0.85 ** (k + 1)) < 1e-5 for k in range(12))


# 2


def test_mixing(spark):
    rng = random.Random(3)
    texts = [prose(rng, 30) for _ in range(3000)]
    sources = ["hot" if i % 3 else f"s{i % 7}" for i in range(3000)]
    docs = documents(spark, texts, sources=sources)
    weights = {"hot": 1.0, **{f"s{i}": 1.0 for i in range(7)}}
    out = mixing.mixed(docs, weights=weights).groupBy("source").agg(F.sum(F.char_length("text")).alias("n")).collect()
    total = sum(len(t) for t in texts)
    assert sum(r.n for r in out) == pytest.approx(total, rel=0.1)
    assert {r.source: r.n for r in out}["hot"] == pytest.approx(total / 8, rel=0.15)
    first, second = (mixing.mixed(docs, weights=weights).select("doc_id", "copy").collect() for _ in range(2))
    assert sorted(map(tuple, first)) == sorted(map(tuple, second))
    ids = [r.doc_id for r in first]
    assert abs(np.corrcoef(ids[:-1], ids[1:])[0, 1]) < 0.1
    cdf = mixing.rates(docs, weights=weights).where("source = 's1'").first()
    for k, c in enumerate(cdf.cdf[:20]):
        assert c == pytest.approx(sum(math.exp(-cdf.rate) * cdf.rate**j / math.factorial(j) for j in range(k + 1)), abs=1e-9)


def test_mixing_edges(spark, monkeypatch):
    docs = documents(spark, [None, "", "text", "text", "more"], ids=[1, 2, 3, 3, None], sources=[None, "e", "s", "s", None]).withColumn("copy_of", F.lit(1)).withColumn("rate", F.lit(1))
    out = mixing.mixed(docs).collect()
    counts = collections.Counter(r.doc_id for r in out)
    assert counts[3] % 2 == 0
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)  # the salted join gives the same rows
    assert sorted(map(str, mixing.mixed(docs).collect())) == sorted(map(str, out))
    assert mixing.mixed(documents(spark, [])).count() == 0


def test_mixing_rare_source_of_great_weight(spark, tmp_path):
    """One character at a third of the weight: a rate of hundreds, summed from parts; the SQL agrees."""
    texts = ["x"] + ["y" * 300] * 4 + ["z" * 250] * 3
    docs = documents(spark, texts, sources=["rare"] + ["s"] * 4 + ["t"] * 3)
    weights = {"rare": 1, "s": 1, "t": 1}
    rates = {r.source: r for r in mixing.rates(docs, weights=weights).collect()}
    assert rates["rare"].rate == pytest.approx(1951 / 3) and rates["rare"].parts == 10 and all(len(r.cdf) < 230 for r in rates.values())
    n = mixing.mixed(docs, weights=weights).where("source = 'rare'").count()
    assert abs(n - 650) < 6 * 650**0.5

    def inverse(rate, *parts):
        u = (int(hashlib.md5(":".join(map(str, (mixing.SEED, 0, *parts))).encode()).hexdigest()[:13], 16) + 0.5) / 2.0**52
        p = total = math.exp(-rate)
        k = 0
        while total <= u:
            k += 1
            p *= rate / k
            total += p
        return k

    assert n == inverse(1951 / 3 - 640) + sum(inverse(64, j) for j in range(1, 11))
    steep = documents(spark, ["a"] + ["b" * 30000] * 200, sources=["one"] + ["many"] * 200)
    folder = written(steep, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert mixing.rates(steep).where("parts > 0").count() == 1
    assert sorted(map(str, con.execute(mixing.sql()).fetchall())) == sorted(str((r.doc_id, r.source, r.copy, r.text)) for r in mixing.op2_mixing(spark, folder).collect())


def test_mixing_keeps_columns_of_clashing_names(spark):
    names = ["copy", "cdf", "rate", "parts", "__source", "__u", "__copies", "__order", "size", "weight", "a.b"]
    docs = documents(spark, ["text", "more text", None], sources=["s", "t", None])
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(k))
    out = mixing.mixed(docs)
    assert out.columns == docs.columns + ["copy_"]
    assert all(r.copy == 0 and r["a.b"] == 10 and r["__u"] == 5 for r in out.collect())
    plain = mixing.mixed(documents(spark, ["text", "more text", None], sources=["s", "t", None])).collect()
    assert sorted((r.doc_id, r.copy_) for r in out.collect()) == sorted((r.doc_id, r.copy) for r in plain)


# 3


def jaccard(a, b):
    def shingles(t):
        w = split(t)
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y)


def test_fingerprints(spark, corpus, tmp_path):
    sf = written(documents(spark, corpus, ids=[3 * i for i in range(len(corpus))]).withColumn("place", F.lit("clash")), tmp_path)
    got = {r.doc_id: r for r in fingerprints.op3_fingerprints(spark, sf).collect()}
    assert len(got) == len(corpus)
    errors = []
    for i, t in enumerate(corpus):
        r, t, after = got[3 * i], t or "", corpus[(i + 1) % len(corpus)] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        errors += [r.near_edited - jaccard(t, edited), r.near_next - jaccard(t, after)]
    assert abs(np.mean(errors)) < 0.03 and np.abs(errors).max() < 0.3
    assert got[0].fingerprint == got[75].fingerprint == got[78].fingerprint
    assert len(got[0].fingerprint) == fingerprints.BINS


def slow_fingerprint(text):
    """Bins, densification and packed bits by plain loops; hashes chain as the engine's do, from 42."""
    import struct

    import xxhash

    def h(form, *parts):
        seed = 42
        for kind, x in zip(form, parts, strict=True):
            seed = xxhash.xxh64(x if kind == "b" else struct.pack(f"<{kind}", x), seed=seed).intdigest()
        return seed - 2**64 if seed >= 2**63 else seed

    words = [h("b", w) for w in (text or "").encode().split()]
    found = [h("qqqqq", *words[i : i + 5]) for i in range(len(words) - 4)] if len(words) >= 5 else [h("q" * len(words), *words)]
    least = {}
    for x in found:
        b, value = (x & (2**63 - 1)) >> 55, x & (2**55 - 1)
        least[b] = min(value, least.get(b, value))
    tables = fingerprints.probes()
    out = []
    for i in range(256):
        order = [i, *[t[i] for t in tables], *sorted(range(256), key=lambda b: h("ii", i, b) & ~255 | b)]
        out.append(f"{h('qi', next(least[b] for b in order if b in least), i) & 15:x}")
    return "".join(out)


def test_fingerprints_equal_plain_loops(spark):
    rng = random.Random(12)
    texts = [None, "", "one", "one two three four", "one two three four five", "a b c d e f", prose(rng, 12), prose(rng, 40), prose(rng, 300), prose(rng, 3000), "tab\tnew\nline and five words  more"]
    got = {r.doc_id: r.fp for r in fingerprints.fingerprinted(documents(spark, [t or "" for t in texts]), "text", "fp").collect()}
    assert [got[i] for i in range(len(texts))] == [slow_fingerprint(t) for t in texts]


@pytest.mark.parametrize("parts", ["1", "7", "40"])
def test_followers_of_ties_and_missing_ids(spark, parts):
    """Many rows without an id and many with one id: every row but one has the next in order."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        rng = random.Random(13)
        rows = [(-(2**63), f"t{rng.randrange(40)}") for _ in range(150)] + [(5, f"u{i}") for i in range(100)] + [(i, f"v{i}") for i in range(6, 200)]
        df = spark.createDataFrame(rows, "place long, text string")
        ties = {r.text: r.t for r in df.select("text", F.xxhash64("text").alias("t")).distinct().collect()}
        order = sorted(rows, key=lambda r: (r[0], ties[r[1]], r[1]))
        want = sorted((a[0], a[1], b[1]) for a, b in zip(order, order[1:] + order[:1], strict=True))
        assert sorted((r.place, r.text, r.next_text) for r in fingerprints.with_next(df, "place", ["text"]).collect()) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_fingerprints_of_one_and_none(spark, tmp_path):
    r = fingerprints.op3_fingerprints(spark, written(documents(spark, ["only one text here is"]), tmp_path)).first()
    assert r.near_next == 1.0
    assert fingerprints.op3_fingerprints(spark, written(documents(spark, []), tmp_path / "e")).count() == 0


# 4


def brute_phrases(texts, ids):
    first = {}
    rows = [(i, split(t)) for i, t in zip(ids, texts, strict=True)]
    for i, w in rows:
        for j in range(len(w) - 12):
            key = tuple(w[j : j + 13])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, w in rows:
        gone = set()
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < i:
                gone.update(range(j, j + 13))
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("runs", [20_000, 3])
def test_phrases(spark, corpus, tmp_path, monkeypatch, runs):
    monkeypatch.setattr(phrases, "SHARD_RUNS", runs)  # 3: many shards, and copies of patterns for hot anchors
    rng = random.Random(2)
    texts = corpus + ["a b " * 40, "b a " * 40, " ".join(["of"] * 60), " ".join(["of"] * 30)] + [f"{prose(rng, 3)} {corpus[5]} {prose(rng, 3)}" for _ in range(8)]
    ids = rng.sample(range(1000), len(texts))
    docs = documents(spark, texts, ids=ids).withColumn("anchors", F.lit("clash"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in phrases.op4_phrases(spark, written(docs, tmp_path)).collect()}
    assert got == brute_phrases(texts, ids)


def test_phrases_small_automata(spark, monkeypatch):
    """An automaton's root is searched word by word, so that a shard may not hold much of the table."""
    words = random.Random(4)
    texts = [" ".join(f"w{words.randrange(5000)}" for _ in range(40)) for _ in range(1500)]
    dealt, matches = [], phrases.matches
    monkeypatch.setattr(phrases, "matches", lambda rows: dealt.append(rows.groupBy("shard").count().agg({"count": "max"}).first()[0]) or matches(rows))
    found, _ = phrases.located(documents(spark, texts + texts))
    assert found.count() == len(texts)
    assert dealt[0] < 4 * 1000


def test_phrases_edges(spark):
    long = " ".join(f"w{i}" for i in range(20))
    rows = phrases.digests(documents(spark, [long, long, long, None], ids=[5, 5, None, 6])).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_removed) for r in rows) == [("5", 20, 0), ("5", 20, 0), ("6", 0, 0), ("None", 20, 20)]
    assert phrases.digests(documents(spark, [])).count() == 0


# 5


def test_media(spark, corpus, tmp_path):
    got = {r.doc_id: r for r in media.op5_media(spark, written(documents(spark, corpus), tmp_path)).collect()}
    for i, t in enumerate(corpus):
        data = (t or "").encode()
        padded = data + b"\xff" * (-len(data) % 576 or (0 if data else 576))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))
        assert r.feature == slow_feature(padded)
    assert got[0].feature == got[25].feature and got[0].media_sha256 == got[25].media_sha256
    assert media.media(documents(spark, [])).count() == 0
    odd = documents(spark, ["one", "one"], ids=[None, None]).withColumn("payload", F.lit("clash")).withColumn("feature", F.lit(0))
    assert [(r.doc_id, r.n_bytes, len(r.payload)) for r in media.media(odd).collect()] == [(None, 3, 576)] * 2


def slow_feature(padded):
    """The hash from plain loops: means on a grid, cosine sums, bits against the median."""
    rows = [padded[i : i + 576] for i in range(0, len(padded), 576)]
    cuts = [k * len(rows) // 32 for k in range(32)] + [len(rows)]
    grid = []
    for k in range(32):
        some = rows[cuts[k] : max(cuts[k + 1], cuts[k] + 1)] if len(rows) >= 32 else [rows[cuts[k]]]
        grid.append([sum(sum(r[18 * c : 18 * c + 18]) for r in some) / (18 * len(some)) for c in range(32)])
    wave = [[math.cos(math.pi * k * (2 * x + 1) / 64) * math.sqrt((1 if k == 0 else 2) / 32) for x in range(32)] for k in range(8)]
    half = [[sum(wave[k][y] * grid[y][x] for y in range(32)) for x in range(32)] for k in range(8)]
    low = [round(sum(half[k][x] * wave[m][x] for x in range(32)), 6) for k in range(8) for m in range(8)]
    middle = sorted(low[1:])[31]
    return f"{int(''.join(str(int(i > 0 and v > middle)) for i, v in enumerate(low)), 2):016x}"


def test_png_rows_are_filtered_and_undone_together():
    rng = np.random.default_rng(4)
    smooth = (np.add.outer(np.arange(30) * 3, np.arange(64) * 2) + rng.integers(0, 4, (30, 64))).astype(np.uint8)
    images = [smooth, rng.integers(0, 256, (5, 64), dtype=np.uint8), np.zeros((3, 64), dtype=np.uint8), smooth[:1], smooth.T.copy().reshape(30, 64)]
    stored = [media.filtered_rows(media.write_png(x)) for x in images]
    assert {k for kinds, _ in stored for k in kinds.tolist()} >= {0, 1, 2, 4}
    for x, back in zip(images, media.unfilter(stored), strict=True):
        assert (x == back).all()


def test_png_filters_and_damage():
    rng = np.random.default_rng(1)
    samples = rng.integers(0, 256, (12, 40), dtype=np.uint8)
    raw, above = bytearray(), np.zeros(40, dtype=np.int64)
    for i, row in enumerate(samples.astype(np.int64)):
        kind = i % 5
        left, corner = np.concatenate([[0], row[:-1]]), np.concatenate([[0], above[:-1]])
        p = left + above - corner
        a, b, c = abs(p - left), abs(p - above), abs(p - corner)
        guess = [0, left, above, (left + above) // 2, np.where((a <= b) & (a <= c), left, np.where(b <= c, above, corner))][kind]
        raw += bytes([kind]) + bytes(((row - guess) % 256).astype(np.uint8))
        above = row
    head = media.chunk(b"IHDR", b"\0\0\0\x28\0\0\0\x0c\x08\0\0\0\0")
    body = zlib.compress(bytes(raw))
    png = media.SIGNATURE + head + media.chunk(b"tEXt", b"k\0v") + media.chunk(b"IDAT", body[:20]) + media.chunk(b"IDAT", body[20:]) + media.chunk(b"IEND", b"")
    assert (media.read_png(png) == samples).all()
    assert (media.read_png(media.write_png(samples)) == samples).all()
    for broken in (png[:-20], png[:60] + bytes([png[60] ^ 1]) + png[61:], b"no" + png):
        with pytest.raises(ValueError, match=".+"):
            media.read_png(broken)


# 6


def brute_classes(texts, ids):
    sets = []
    for t in texts:
        w = split(t)
        c = collections.Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else collections.Counter([tuple(w)])
        sets.append({k: 1 + math.log(n) for k, n in c.items()})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            total = sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in a.keys() | b.keys()) for d in a.keys() & b.keys())
            if total >= 0.8 - 1e-9:
                x, y = find(ids[i]), find(ids[j])
                parent[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_near(spark, corpus, tmp_path):
    rng = random.Random(4)
    base = prose(rng, 60, 5000).split()
    chain = []
    for _ in range(12):  # a chain: neighbours are alike, the ends are not
        base[rng.randrange(60)] = f"c{rng.randrange(10**6)}"
        chain.append(" ".join(base))
    texts = [t for t in corpus if t is None or len(t) < 20000] + chain + ["ha ha ha ha ha ha ha " * 5, "ha ha ha ha ha ha ha " * 6]
    ids = rng.sample(range(10_000), len(texts))
    docs = documents(spark, texts, ids=ids).withColumn("class", F.lit("clash")).withColumn("bucket", F.lit(0))
    got = {r.doc_id: r.class_id for r in near.op6_near(spark, written(docs, tmp_path)).collect()}
    assert got == brute_classes(texts, ids)
    kept = near.keep_first(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == set(got.values())


def test_near_recall_on_a_whole_table(spark):
    """All pairs of a table at 0.8 or more, found through an index of all shingles: none may be missed."""
    rows = sorted((r.doc_id, r.text or "") for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect())
    owner, values, counts = near.shingles([t for _, t in rows])
    edges = np.searchsorted(owner, np.arange(len(rows) + 1))
    sets = [(values[i:j], near.weigh(counts[i:j])) for i, j in zip(edges[:-1], edges[1:], strict=True)]
    posts = collections.defaultdict(list)
    for i, v in zip(owner.tolist(), values.tolist(), strict=True):
        posts[v].append(i)
    shared = collections.Counter((a, b) for ids in posts.values() for k, a in enumerate(ids) for b in ids[k + 1 :])
    wanted = [(a, b) for (a, b), n in shared.items() if n * 2 >= min(len(sets[a][0]), len(sets[b][0])) and near.similarity(sets[a], sets[b]) >= 0.8]
    got = {r.doc_id: r.class_id for r in near.op6_near(spark, "/root/testdata/sf0.01").collect()}
    assert len(wanted) > 50 and all(got[rows[a][0]] == got[rows[b][0]] for a, b in wanted)


def test_near_blocks_find_links_across_classes(spark, monkeypatch):
    monkeypatch.setattr(near, "ROWS", 2)
    monkeypatch.setattr(near, "COLUMNS", 3)
    rng = random.Random(9)
    texts, ids = [], []
    for g in range(3):
        base = prose(rng, 100, 5000).split()
        for k in range(8):
            words = list(base)
            for _ in range(k):
                words[rng.randrange(100)] = f"e{g}{rng.randrange(10**6)}"
            texts.append(" ".join(words))
            ids.append(len(ids))
    got = {r.node: r["class"] for r in near.classes(documents(spark, texts)).collect()}
    assert got == brute_classes(texts, ids)


def test_near_edges(spark):
    got = sorted((r.node, r["class"]) for r in near.classes(documents(spark, [None, "", "a", "a", "b"], ids=[4, 3, 2, 2, 1])).collect())
    assert got == [(1, 1), (2, 2), (3, 3), (4, 3)]
    rows = near.classes(documents(spark, ["same words in five again", "other words in five here"], ids=[None, None])).collect()
    assert len({r["class"] for r in rows}) == 2 and all(r.node < 0 for r in rows)
    assert near.classes(documents(spark, [])).count() == 0


def test_signatures_estimate_probability_jaccard():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 60).astype(np.uint64)
    b = np.concatenate([a[:45], rng.integers(0, 2**63, 15).astype(np.uint64)])
    wa, wb = 1.0 + rng.integers(0, 3, 60), 1.0 + rng.integers(0, 3, 60)
    want = near.similarity(tuple(x[np.argsort(a)] for x in (a, wa)), tuple(x[np.argsort(b)] for x in (b, wb)))
    marks = near.signatures(np.repeat([0, 1], 60), np.concatenate([a, b]), np.concatenate([wa, wb]), 2, 4096)
    assert (marks[0] == marks[1]).mean() == pytest.approx(want, abs=0.03)


# 7


def brute_lines(texts, ids, share=800):
    rows = sorted((i, t or "") for i, t in zip(ids, texts, strict=True))
    seen, out = [], {}
    for i, t in rows:
        left = []
        for s in t.split("\n"):
            words = frozenset(w.encode() for w in s.replace("\t", " ").replace("\r", " ").replace("\x0b", " ").replace("\f", " ").split(" ") if w)
            if words and any(1000 * len(words & x) >= share * len(words | x) for x in seen):
                seen.append(words)
                continue
            if words:
                seen.append(words)
            left.append(s)
        out[i] = ("\n".join(left), len(t.split("\n")) - len(left))
    return out


def test_lines(spark, corpus, tmp_path):
    rng = random.Random(6)
    pool = [prose(rng, rng.randrange(1, 14), 60) for _ in range(60)]
    texts = ["\n".join(rng.choice(pool) + rng.choice(["", "", " extra"]) for _ in range(rng.randrange(1, 8))) for _ in range(80)] + [t for t in corpus if t is None or len(t) < 20000]
    ids = rng.sample(range(5000), len(texts))
    docs = documents(spark, texts, ids=ids).withColumn("kept", F.lit("clash")).withColumn("h", F.lit(0))
    out = lines.deduped(docs)
    got = {r.doc_id: (r.text, r.n_removed) for r in out.collect()}
    assert got == brute_lines(texts, ids)
    assert all(r.n_chars == len(r.text) for r in out.collect())
    folder = written(docs, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert {r[0]: (r[1], r[3]) for r in con.execute(lines.sql()).fetchall()} == got


@pytest.mark.parametrize("threshold", [0.5, 0.6, 0.95])
def test_lines_at_other_thresholds(spark, threshold):
    rng = random.Random(7)
    texts = ["aa bb cc\naa bb", "aa\naa bb"] + ["\n".join(prose(rng, rng.randrange(1, 9), 12) for _ in range(5)) for _ in range(60)]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.deduped(documents(spark, texts), threshold).collect()}
    assert got == brute_lines(texts, range(len(texts)), round(threshold * 1000))


def test_lines_of_near_copies(spark):
    """A group of near copies, one line that very many texts have, long lines and long texts."""
    rng = random.Random(8)
    base = prose(rng, 40, 5000).split()
    copies = []
    for _ in range(150):
        words = list(base)
        for _ in range(rng.randrange(7)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(200)}"
        copies.append(" ".join(words))
    long = [prose(rng, 3000, 900) for _ in range(3)]
    texts = copies + ["the very common line of all\n" + prose(rng, 12, 5000) for _ in range(100)] + long + [long[0] + " more", "\n".join(prose(rng, 9, 40) for _ in range(2000))]
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.deduped(documents(spark, texts)).collect()}
    assert got == brute_lines(texts, range(len(texts)))


def test_lines_removed_later_are_no_pairs(spark):
    """A removed line meets the later lines that stay, not the earlier ones: it can remove those only."""
    words = [f"w{i}" for i in range(30)]
    rows = lines.rows_of(documents(spark, [" ".join(words[:k] + ["other"] + words[k + 1 :]) for k in range(12)]))
    firsts = lines.apart(lines.equal_lines(rows), rows)
    sets = common.staged(lines.tokenised(firsts, lines.rarity(firsts), 800), "test-sets")
    ids = [r.doc for r in sets.select("doc").orderBy("doc").collect()]
    late = sets.where(F.col("doc") > ids[0]).select("sid", "sid2")
    assert lines.indexed(sets, late, 800).isEmpty()
    early = sets.where(F.col("doc") < ids[-1]).select("sid", "sid2")
    assert lines.indexed(sets, early, 800).count() == 11


@pytest.mark.parametrize("share", [500, 800, 950, 1000])
def test_lines_meet_in_their_size_class(spark, share):
    """Lines that share a token meet if their sizes can be alike, whatever the class, and hardly else; the index is shuffled once."""
    sizes = range(1, 301)
    texts = [" ".join(["rare"] + [f"w{n}x{k}" for k in range(n - 1)]) for n in sizes]
    rows = lines.rows_of(documents(spark, texts, ids=sizes))
    firsts = common.staged(lines.equal_lines(rows).drop("mixed"), "test-firsts")
    token = (F.xxhash64(F.lit("rare")).bitwiseAND(F.lit(2**56 - 1))).alias("token")
    sets = firsts.select("sid", "sid2", "doc", F.size(F.split("string", " ")).alias("n"), F.lit(0).cast("long").alias("bits"), F.lit(0).cast("long").alias("bits2"), F.array(token).alias("prefix"))
    sets = common.staged(sets, "test-sets")
    with common.setting(spark, "spark.sql.requireAllClusterKeysForCoPartition", "false"):
        a, b = lines.met(sets, sets.select("sid", "sid2").limit(0), share)
        joined = a.select("token", "class", F.shiftright("shape", 36).alias("na")).join(b.select("token", "class", F.shiftright("shape", 36).alias("nb")).hint("shuffle_hash"), ["token", "class"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        found = [(r.na, r.nb) for r in joined.select("na", "nb").collect()]
    assert "class" not in "".join(x for x in plan.splitlines() if "Exchange hashpartitioning" in x)
    assert len(found) == len(set(found))
    assert set(found) >= {(x, y) for x in sizes for y in sizes if x <= y and 1000 * x >= share * y}
    assert len(found) < (0.62 if share == 500 else 0.35) * len(sizes) ** 2


def test_lines_by_pairs_of_all_sizes(spark):
    """Lines at the threshold and one word below it, for every size up to 130 words: each size class and both parity maps."""
    texts = []
    for n in range(4, 131):
        words = [f"w{n}x{k}" for k in range(n)]
        more = n // 4
        texts += [" ".join(words), " ".join(words + [f"m{n}x{k}" for k in range(more)]), " ".join([f"o{n}x{k}" for k in range(more + 1)] + words)]
    ids = random.Random(4).sample(range(10_000), len(texts))
    got = {r.doc_id: (r.text, r.n_removed) for r in lines.deduped(documents(spark, texts, ids=ids)).collect()}
    assert got == brute_lines(texts, ids)


def test_lines_of_a_token_stand_together(spark):
    """Each task of the index holds its rows in the order of their tokens, on both sides of the join."""
    rows = lines.rows_of(documents(spark, [" ".join(f"w{k * j % 97}" for j in range(20)) for k in range(60)]))
    firsts = common.staged(lines.equal_lines(rows).drop("mixed"), "test-firsts")
    sets = common.staged(lines.tokenised(firsts, lines.rarity(firsts), 800), "test-sets")
    a, b = lines.met(sets, sets.select("sid", "sid2").limit(0), 800)
    for side in (a, b):
        tasks = {}
        for r in side.select(F.spark_partition_id().alias("task"), "token").collect():
            tasks.setdefault(r.task, []).append(r.token)
        assert tasks and all(t == sorted(t) for t in tasks.values())
    joined = a.join(b.withColumnsRenamed({c: f"{c}_b" for c in b.columns[2:]}).hint("shuffle_hash"), ["token", "class"])
    assert joined._jdf.queryExecution().optimizedPlan().toString().count("Sort [token") == 2


def test_lines_texts_are_read_once(spark):
    """The lines of all pairs stand once in the table that pairs are judged by, blank lines nowhere."""
    rows = lines.rows_of(documents(spark, ["a b c d e\n \t \nx", "a b  c d e\na b c d f", " \n\na b c d g"]))
    firsts = common.staged(lines.equal_lines(rows).drop("mixed"), "test-firsts")
    ids = {r.string: r.sid for r in firsts.collect()}
    assert set(ids) == {"a b c d e", "x", "a b c d f", "a b c d g"}
    pairs = spark.createDataFrame([(ids["a b c d e"], ids["a b c d f"]), (ids["a b c d g"], ids["a b c d e"])], "a bigint, b bigint")
    found = lines.texts(pairs, firsts)
    assert sorted(r.string for r in found.collect()) == ["a b c d e", "a b c d f", "a b c d g"]
    # a share of 4 in 6 words: both later lines go at 0.6, none at 0.8
    assert {r.sid for r in lines.beaten(pairs, firsts, 600).collect()} == {ids["a b c d f"], ids["a b c d g"]}
    assert lines.beaten(pairs, firsts, 800).isEmpty()


@pytest.mark.parametrize("ids", [[5, 3, None, 4, -2], [2**62, -(2**62), None, 2**61, 7]])
def test_lines_places_in_order(spark, ids):
    """Places are one number, a long where ids and lines leave room: by id, then line, null ids last."""
    rows = common.staged(lines.equal_lines(lines.rows_of(documents(spark, [f"a{k}\nb{k}\nc{k}" for k in range(5)], ids=ids))), "test-firsts")
    got = [(r.doc, r.line) for r in rows.select("doc", "line", lines.placed(rows).alias("place")).orderBy("place").collect()]
    assert got == sorted(got) and len(got) == 15


def test_lines_keep_columns_of_clashing_names(spark):
    names = ["n_lines", "n_removed", "__doc", "__h", "doc", "h", "kept", "line", "sid", "first", "text_hash", "a.b"]
    docs = documents(spark, ["a b\na b", None, "c"])
    for k, name in enumerate(names):
        docs = docs.withColumn(name, F.lit(k))
    out = lines.deduped(docs)
    assert out.columns == docs.columns + ["n_lines_", "n_removed_"]
    assert sorted((r.doc_id, r.text, r.n_lines_, r.n_removed_, r.n_lines, r["a.b"]) for r in out.collect()) == [(0, "a b", 2, 1, 0, 11), (1, "", 1, 0, 0, 11), (2, "c", 1, 0, 0, 11)]


def test_lines_edges(spark):
    out = sorted((str(r.doc_id), r.text, r.n_removed) for r in lines.deduped(documents(spark, ["a b\na b", "a b", "a b", None, "\n \n"], ids=[1, 2, None, 3, 4])).collect())
    assert out == [("1", "a b", 1), ("2", "", 1), ("3", "", 0), ("4", "\n \n", 0), ("None", "", 1)]
    assert lines.deduped(documents(spark, [])).count() == 0


# 8


def test_licenses(spark):
    grant = [s for s, i in licenses.SENTENCES.items() if i in ("mit-grant", "mit-condition", "mit-warranty")]
    texts = ["Prose here. Released under the MIT License.\nMore.", ". ".join(s.capitalize() for s in grant) + ".", "Licensed under CC BY-NC 4.0.\nAll rights reserved.", None, "", "the mit license is nice", "Licensed under the Apache License, Version 2.0. Thanks", "Released  under the\tMIT license!\nReleased under the MIT License."]
    got = [r.licences for r in licenses.scanned(documents(spark, texts)).orderBy("doc_id").collect()]
    assert got == [["MIT (notice)"], ["MIT"], ["CC-BY-NC-4.0", "LicenseRef-All-Rights-Reserved"], [], [], [], ["Apache-2.0 (notice)"], ["MIT (notice)"]]
    assert licenses.scanned(documents(spark, [])).count() == 0


MIT = """MIT License

Copyright (c) 2020 Jane Roe

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS BE LIABLE."""
BSD2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.
"""
BSD3 = BSD2 + """
3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.
"""
APACHE = """   Licensed under the Apache License, Version 2.0 (the "License");
   you may not use this file except in compliance with the License.
   You may obtain a copy of the License at

       http://www.apache.org/licenses/LICENSE-2.0

   Unless required by applicable law or agreed to in writing, software
   distributed under the License is distributed on an "AS IS" BASIS,
   WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
   See the License for the specific language governing permissions and
   limitations under the License."""
GPL3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details."""
GPL2 = GPL3.replace("software:", "software;").replace("version 3", "version 2")


def test_licenses_of_standard_notices(spark):
    notices = {MIT: "MIT", BSD2: "BSD-2-Clause", BSD3: "BSD-3-Clause", APACHE: "Apache-2.0", GPL3: "GPL-3.0-or-later", GPL2: "GPL-2.0-or-later"}
    forms = [lambda t: t, lambda t: "\n\n".join(" ".join(x.split()) for x in t.split("\n\n")), lambda t: "\n".join("# " + x for x in t.split("\n")), lambda t: t.replace("\n", "\r\n")]
    cases = [(form(t), [name]) for t, name in notices.items() for form in forms]
    cases += [(" ".join(t.split()), [name]) for t, name in notices.items() if t != MIT]  # its title has no stop
    # lines of their own without a stop are found as before, parts of other sentences are not
    cases += [("Some title\nLicensed under the MIT license\nmore prose", ["MIT (notice)"]), ("not licensed under the MIT license", []), ("Licensed under the MIT license or so", [])]
    got = [r.licences for r in licenses.scanned(documents(spark, [t for t, _ in cases])).orderBy("doc_id").collect()]
    assert got == [want for _, want in cases]


def test_more_notices_and_places(spark):
    mpl = "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.\n"
    isc = 'Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\ncopyright notice and this permission notice appear in all copies.\n\nTHE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH\nREGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY\nAND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE.\n'
    lgpl = "This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) any later version.\n\nThis library is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU\nLesser General Public License for more details.\n"
    bsd2 = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.\n"
    bsd3 = bsd2 + "\n3. Neither the name of the copyright holder nor the names of its\n   contributors may be used to endorse or promote products derived from\n   this software without specific prior written permission.\n"
    texts = [mpl, isc, lgpl, "# SPDX-License-Identifier: Apache-2.0\nimport os", bsd2, bsd3, bsd3 + "\nAnother part.\n\n" + bsd2, None]
    got = {r.doc_id: r.licences for r in licenses.scanned(documents(spark, texts)).collect()}
    assert [got[i] for i in range(8)] == [["MPL-2.0"], ["ISC"], ["LGPL-2.1-or-later"], ["SPDX Apache-2.0"], ["BSD-2-Clause"], ["BSD-3-Clause"], ["BSD-3-Clause", "BSD-2-Clause"], []]


def test_every_licence_sentence_is_reachable(spark):
    got = [r.found for r in licenses.scanned(documents(spark, [s.upper().replace(" ", "\n", 3) for s in licenses.SENTENCES])).orderBy("doc_id").collect()]
    assert got == [[i] for i in licenses.SENTENCES.values()]


# 9


@pytest.mark.parametrize("common_words", [256, 8, 1])
def test_nearest_is_exact(monkeypatch, common_words):
    """Against all cosines, with words in every share of dense and sparse lists; ties by id."""
    monkeypatch.setattr(toxicity, "COMMON", common_words)
    monkeypatch.setattr(toxicity, "BLOCK", 16)
    rng = random.Random(1)
    idf = np.array([1 + rng.random() for _ in range(40)])
    found = [{t: 1 + rng.randrange(3) for t in sorted(rng.sample(range(40), rng.randrange(1, 6)))} for _ in range(500)]
    arrays = [np.array(x) for x in ([i for i, v in enumerate(found) for _ in v], [t for v in found for t in v], [n for v in found for n in v.values()])]
    words, ids = [f"w{t}" for t in range(40)], np.arange(500) * 7
    key, data = toxicity.Model.packed(words, (*arrays, np.array([rng.randrange(2) for _ in found]), ids, idf), 0.1, 0.1)
    index = toxicity.Model.unpacked(key, data).index
    unit = lambda v: dict(zip(v, toxicity.unit(np.array(list(v)), np.array(list(v.values()), dtype=float), idf), strict=True))
    units = [unit(v) for v in found]
    for k in range(80):
        q = unit({t: 1 + rng.randrange(2) for t in rng.sample(range(40), rng.randrange(1, 6))})
        skip = k if k % 2 else -1
        places, cosines = index.nearest(np.array(list(q)), np.array(list(q.values())), skip)
        exact = np.array([0.0 if p == skip else sum(w * q.get(t, 0) for t, w in units[p].items()) for p in range(500)])
        want = np.sort(exact[exact > 0])[::-1][: toxicity.NEIGHBOURS]
        assert len(places) == len(want) and np.allclose(cosines, want, atol=1e-6)
        assert np.allclose(exact[index.ids[places] // 7], cosines, atol=1e-6)


def test_scores_against_all_cosines(spark):
    """The whole operator against a plain loop: every word, every example, the same votes and curve."""
    rng = random.Random(15)
    texts = [prose(rng, rng.randrange(0, 30), 60) + (" vile" if i % 5 == 0 else "") for i in range(150)] + [None]
    docs, known = documents(spark, texts), spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(120)], "doc_id long, toxic int")
    learnt = toxicity.learn(docs.union(docs.limit(5)), known)
    model, curve = toxicity.Model.unpacked(*learnt[:2]), learnt[2]
    ids = [i for i in range(120) if zlib.crc32(str(i).encode()) % 5]
    assert model.ids.tolist() == ids
    counts = {i: collections.Counter(toxicity.words_of(texts[i])) for i in ids}
    vocabulary = sorted(set().union(*counts.values()))
    rows = [t or "" for t in texts + texts[:5]]
    bad = {w: sum(i % 5 == 0 for i in ids if w in counts[i]) for w in vocabulary}
    held = {w: sum(w in counts[i] for i in ids) for w in vocabulary}
    rate = (sum(i % 5 == 0 for i in ids) + 0.5) / (len(ids) + 1)
    weight = {w: (math.log((1 + len(rows)) / (1 + sum(w in set(toxicity.words_of(t)) for t in rows))) + 1) * (1 - toxicity.tail(bad[w], held[w], rate) if bad[w] > 2 * rate * held[w] else 1.0) for w in vocabulary}

    def unit(c):
        v = {w: (1 + math.log(n)) * weight[w] for w, n in c.items() if w in weight}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return {w: x / norm for w, x in v.items()}

    units = {i: unit(c) for i, c in counts.items() if c}

    def vote(v, skip=None):
        near = sorted(((-round(sum(x * v.get(w, 0) for w, x in u.items()), 6), i) for i, u in units.items() if i != skip))
        near = [(-c, i) for c, i in near if c < 0][: toxicity.NEIGHBOURS]
        return (sum(c * (i % 5 == 0) for c, i in near) + toxicity.PRIOR * rate) / (sum(c for c, _ in near) + toxicity.PRIOR)

    want = toxicity.fitted([vote(units[i], i) for i in sorted(units)], [int(i % 5 == 0) for i in sorted(units)])
    assert np.allclose(curve, want, rtol=1e-3)
    for r in toxicity.scored(docs, learnt).collect():
        mine = unit(collections.Counter(toxicity.words_of(texts[r.doc_id] or "")))
        assert abs(r.score - (toxicity.curved(vote(mine), curve) if mine else model.none)) < 1e-3


def test_driver_gives_memory_back():
    """Memory freed after learning must leave the driver: Arrow's pool too, which keeps it otherwise."""
    import pyarrow as pa

    asked = []
    pool = type("Pool", (), {"release_unused": lambda self: asked.append(1)})()
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pa, "default_memory_pool", lambda: pool)
        common.trimmed()
    assert asked


def test_toxicity(spark, tmp_path):
    rng = random.Random(2)
    bad = ["vile", "scummy", "awful"]
    texts, labels = [], []
    for i in range(600):
        y = int(rng.random() < 0.2)
        words = prose(rng, 40, 800).split()
        for _ in range(3 * y):
            words.insert(rng.randrange(40), rng.choice(bad))
        texts.append(" ".join(words))
        labels.append((i, 1, y))
    texts[5], texts[6] = None, ""
    sf = written(documents(spark, texts).withColumn("score", F.lit("clash")), tmp_path)
    known = spark.createDataFrame([(i, q, (0 if i in (5, 6) else y)) for i, q, y in labels] + [(5, 1, None)], "doc_id long, quality int, toxic int")
    written(known, tmp_path, "labels")
    rows = toxicity.op9_toxicity(spark, sf).collect()
    assert len(rows) == 600 and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    truth = {i: y for i, _, y in labels}
    held = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = toxicity.accepted(docs, known)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {r.doc_id for r in rows if not r.predicted}
    none = toxicity.scored(docs.limit(3), toxicity.learn(docs, known.limit(0))).collect()
    assert [r.score for r in none] == [0.0, 0.0, 0.0]


def test_toxicity_searches_every_example(spark):
    rng = random.Random(5)
    rare = [f"rare{k}" for k in range(12)]  # each in seven toxic examples and no clean one
    texts = [prose(rng, 30, 300) + (" " + rare[i % 12] if i < 84 else "") for i in range(600)]
    known = spark.createDataFrame([(i, int(i < 84)) for i in range(600)], "doc_id long, toxic int")
    learnt = toxicity.learn(documents(spark, texts), known)
    model = toxicity.Model.unpacked(*learnt[:2])
    examples = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5]
    assert model.ids.tolist() == examples and sorted(model.index.ids.tolist())[-len(examples) :] == examples  # clean ones, too
    new = [prose(rng, 30, 300) + " " + w for w in rare] + [prose(rng, 30, 300) for _ in range(40)] + ["unheard", None]
    got = [r for r in toxicity.scored(documents(spark, new), learnt).orderBy("doc_id").collect()]
    assert [r.predicted for r in got] == [1] * 12 + [0] * 42
    assert [len(r.evidence) for r in got] == [toxicity.NEIGHBOURS] * 52 + [0, 0]
    assert {y for r in got[12:52] for y in r.evidence} - set(range(84))


# 10


def test_pieces(spark, corpus, tmp_path):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = corpus + ["\x00 nul", "  two  spaces ", "tab\tnew\r\nline", "日本語 text", "▁", "▁▁ x"]
    got = {r.doc_id: r for r in pieces.op10_sentencepiece(spark, written(documents(spark, texts), tmp_path)).collect()}
    for i, t in enumerate(texts):
        ids = library.encode(t or "", add_eos=True)
        r = got[i]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest() and r.n_uncovered == 0
    for r in pieces.encode(documents(spark, texts)).collect():
        data = (texts[r.doc_id] or "").encode()
        assert r.begins[0] == 0 and r.ends[-1] == len(data)
        assert b"".join(data[b:e] for b, e in zip(r.begins, r.ends, strict=True)) == data or any(x == y for x, y in zip(r.begins[:-1], r.begins[1:], strict=True))


def test_pieces_edges(spark):
    odd = documents(spark, ["one two", "one two", None], ids=[None, None, 3]).withColumn("ids", F.lit("clash")).withColumn("begins", F.lit(0))
    rows = pieces.encode(odd).collect()
    assert [(r.doc_id, r.decoded) for r in rows] == [(None, "one two"), (None, "one two"), (3, "")] and rows[0].ids == rows[1].ids
    assert pieces.encode(documents(spark, [])).count() == 0 and pieces.digests(documents(spark, [])).count() == 0
    long = "many words of a long text " * 40000
    assert pieces.encode(documents(spark, [long])).first().decoded == long


def test_characters_map():
    """A compiled map by hand: a double array for "ab" -> "x" and "a" -> "y"."""
    import struct

    base = lambda offset, has=0: (offset << 10) | (has << 8)
    units = [0] * 512
    units[0] = base(256)
    a = 256 ^ ord("a")
    units[a] = base(a ^ 160, 1) | ord("a")
    units[160] = 0x80000000 | 2
    b = 160 ^ ord("b")
    units[b] = base(b ^ 170, 1) | ord("b")
    units[170] = 0x80000000 | 0
    blob = struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + b"x\0y\0"
    chars = pieces.CharsMap(blob)
    assert chars.longest(b"abc", 0) == (2, b"x") and chars.longest(b"acc", 0) == (1, b"y") and chars.longest(b"bcc", 0) is None


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
    assert set(queries.SQL) <= set(queries.QUERIES)
