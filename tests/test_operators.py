"""Order-dependent operators against plain loops on random rows."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import classify, cluster, dedupe, evaluate, furniture, select, state, window


def random_pairs(rng, n, m):
    return sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(m)})


@pytest.mark.parametrize("seed", [1, 2])
def test_greedy_dedupe_equals_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(30), rng.choice(["", "a", "b", "c", "d", "e", "f"]), rng.choice([None, "x", "y", "z", "v"])) for i in range(60)]
    kept, k1, k2 = set(), set(), set()
    for i, _, a, b in sorted(rows, key=lambda r: (r[1], r[0])):
        if (a and a in k1) or (b and b in k2):
            continue
        kept.add(i)
        k1.add(a)
        k2.add(b)
    df = spark.createDataFrame(rows, "id long, ord long, k1 string, k2 string")
    got = {r.id for r in dedupe.greedy(df, "id", ["ord", "id"], ("k1", "k2")).collect() if r.kept}
    assert got == kept


def test_greedy_does_not_register_dropped_keys(spark):
    df = spark.createDataFrame([(1, "u1", "t1"), (2, "u2", "t1"), (3, "u2", "t3")], "id long, k1 string, k2 string")
    assert {r.id for r in dedupe.greedy(df, "id", ["id"], ("k1", "k2")).collect() if r.kept} == {1, 3}


@pytest.mark.parametrize("seed", [3, 4])
def test_stars_equal_loop(spark, seed):
    rng = random.Random(seed)
    pairs = random_pairs(rng, 40, 45)
    near = {i: set() for i in range(40)}
    for a, b in pairs:
        near[a].add(b)
        near[b].add(a)
    lead = {}
    for i in range(40):
        if i not in lead:
            lead[i] = i
            for j in range(i + 1, 40):
                if j in near[i] and j not in lead:
                    lead[j] = i
    nodes = spark.range(40)
    got = {r.id: r.lead for r in cluster.stars(nodes, spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == lead


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    pairs = random_pairs(rng, 60, 40) + [(i, i + 1) for i in range(40, 59)]
    parent = list(range(60))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.id: r.component for r in cluster.components(spark.range(60), spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {i: find(i) for i in range(60)}


def test_quota_equals_loop(spark):
    rng = random.Random(6)
    rows = [(i, rng.choice("AB"), rng.random() < 0.5, rng.random() < 0.1) for i in range(80)]
    want = {}
    used = {"A": 0, "B": 0}
    for i, s, inside, exempt in rows:
        if not inside:
            want[i] = True
            continue
        if exempt or used[s] < 5:
            used[s] += 1
            want[i] = True
        else:
            want[i] = False
    df = spark.createDataFrame(rows, "id long, s string, inside boolean, ex boolean")
    got = {r.id: r.kept for r in select.share_capped(df, "s", F.col("inside"), ["id"], F.lit(5), F.col("ex")).collect()}
    # rows that the loop dropped do not use quota up, and neither can they make room: both stay or go alike
    assert got == want


def test_round_robin_equals_loop(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice("xyz"), rng.choice("pqr")) for i in range(50)]
    tiers = list(dict.fromkeys(t for _, t, _ in rows))
    want = []
    for t in tiers:
        queues = {}
        for i, tier, o in rows:
            if tier == t:
                queues.setdefault(o, []).append(i)
        while any(queues.values()):
            for q in queues.values():
                if q:
                    want.append(q.pop(0))
    df = spark.createDataFrame(rows, "pos long, tier string, outlet string").withColumn("s", F.lit(1))
    got = [r.pos for r in select.round_robin(df, "s", "tier", "outlet", "pos").orderBy("final").collect()]
    assert got == want


def test_last_editions_are_editions_not_days(spark):
    df = spark.createDataFrame([(1, "20240101"), (2, "20240301"), (3, "20240302")], "id long, e string")
    assert {r.id for r in select.last_editions(df, "e", 2).collect()} == {2, 3}


def test_concordance_equals_pairs(spark):
    rng = random.Random(8)
    rows = [(1, rng.randrange(4), rng.randrange(10)) for _ in range(80)]
    pairs = [(a, b) for a in rows for b in rows if a[1] > b[1]]
    want = sum(1.0 if a[2] > b[2] else 0.5 if a[2] == b[2] else 0 for a, b in pairs) / len(pairs)
    got = evaluate.concordance(spark.createDataFrame(rows, "e long, l long, s long"), "e", "l", "s").first()
    assert got.pairs == len(pairs) and abs(got.concordance - want) < 1e-9


def test_furniture_runs(spark):
    bar = " ".join(f"menu{i}" for i in range(12))
    docs = [(i, "h", f"start{i} {bar} end{i} body{i}") for i in range(4)]
    df = spark.createDataFrame(docs, "id long, host string, text string")
    known = furniture.learned(df, "host", "text", 3, 0.2)
    assert known.count() == 7
    runs = furniture.furniture_runs(df, "id", "host", "text", known).collect()
    assert {(r.id, r.begin, r.length) for r in runs} == {(i, 1, 12) for i in range(4)}


def test_furniture_keys_stand_for_grams(spark):
    rng = random.Random(12)
    docs = [(i, rng.choice(["h", "g", None]), " ".join(rng.choice([f"bar{k}" for k in range(30)]) if rng.random() < 0.1 else f"m{(i + k) % 9}" for k in range(40))) for i in range(30)]
    df = spark.createDataFrame(docs, "id long, host string, text string")
    spelt, keys = furniture.learned(df, "host", "text", 3, 0.0), furniture.learned_keys(df, "host", "text", 3)
    assert keys.count() == spelt.count() > 0 and keys.dtypes == [("k1", "bigint"), ("k2", "bigint")]
    one, two = (sorted(tuple(r) for r in furniture.furniture_runs(df, "id", "host", "text", k).collect()) for k in (spelt, keys))
    assert one == two and one
    plan = furniture.furniture_runs(df, "id", "host", "text", keys)._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in plan.split("\n") if "Exchange" in x and "gram" in x]  # no words are shuffled


def test_window_and_limits(spark):
    now = F.lit("2024-01-29 12:00:00").cast("timestamp")  # a Monday
    df = spark.createDataFrame([(1, "2024-01-26 12:00:00", None), (2, "2024-01-25 12:00:00", None), (3, "2024-01-23 12:00:00", 168)], "id long, t string, own int").withColumn("t", F.col("t").cast("timestamp"))
    assert {r.id for r in window.fresh(df, "t", now, F.col("own")).collect()} == {1, 3}
    rows = window.limited(df.withColumn("s", F.lit(1)), "s", ["id"], F.lit(2)).collect()
    assert [r.id for r in rows if r.over] == [3]


def test_state(spark):
    old = spark.createDataFrame([("a", 100.0), ("b", 100.0)], "k string, v double")
    new = spark.createDataFrame([("a", 94.0), ("b", 96.0), ("c", 1.0)], "k string, v double")
    got = {r.k: (r.v, r.refused) for r in state.guarded_measure(old, new, "k", "v").collect()}
    assert got == {"a": (100.0, True), "b": (96.0, False), "c": (1.0, False)}
    log = spark.createDataFrame([("s", 1, True), ("s", 2, False), ("s", 3, True), ("s", 4, True), ("t", 1, False)], "s string, d int, f boolean")
    assert [(r.s, r.fails, r.since) for r in state.failure_streaks(log, "s", "d", "f").collect()] == [("s", 2, 3)]
    assert state.shrunk(spark.range(100), spark.range(89)) and not state.shrunk(spark.range(100), spark.range(91))


def test_classifier_precedence(spark):
    words = {"Law": [(3, "court")], "Church": [(1, "bishop")]}
    rows = spark.createDataFrame([(1, "court rules"), (2, "bishop speaks"), (3, "nothing"), (4, "licensed court"), (5, "MÉXICO court")], "id long, h string")
    got = {r.id: (r.section, r.score) for r in classify.classified(rows, F.col("h"), words, "Church", hard=[("^licensed", "Church")], residual=[("nothing", "Other")]).collect()}
    assert got == {1: ("Law", 3), 2: ("Church", 1), 3: ("Other", 0), 4: ("Church", 6), 5: ("Law", 3)}
    assert [r.r for r in spark.range(1, 6).select(classify.reach(F.col("id")).alias("r")).collect()] == [0, 3, 5, 6, 7]


def test_event_sizes(spark):
    rng = random.Random(11)
    told = [(i, [f"n{rng.randrange(60)}" for _ in range(2)] + ["everywhere"], [f"e{rng.randrange(4)}" for _ in range(rng.randrange(3))]) for i in range(160)]
    df = Counter(n for _, names, _ in told for n in set(names))
    label = {i: i for i, _, _ in told}
    for i, a, x in told:
        for j, b, y in told:
            if set(x) & set(y) and any(2 <= df[n] <= 150 for n in set(a) & set(b)):
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = {k: new if v == old else v for k, v in label.items()}
    size = Counter(label.values())
    got = cluster.event_sizes(spark.createDataFrame(told, "id long, names array<string>, events array<string>")).collect()
    assert {r.id: (r.component, r.size) for r in got} == {i: (c, size[c]) for i, c in label.items()}
    assert len(size) > 2 and max(size.values()) > 1
