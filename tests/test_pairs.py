"""Pairs by shared words against plain loops; no step holds as many rows as there are pairs."""

import glob
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import cluster, history, pairs
from tidemark.operators.dedupe import shared_dir


def headlines(rng, n):
    usual, rare = [f"u{i}" for i in range(12)], [f"r{i}" for i in range(150)]
    rows = [rng.sample(usual, rng.randrange(0, 5)) + rng.sample(rare, rng.randrange(0, 9)) + rng.sample(["opinion", "podcast"], rng.randrange(0, 3)) for _ in range(n)]
    near = [[w for w in rng.choice(rows) if rng.random() < 0.8] for _ in range(n)]
    return [rng.sample(w, len(w)) for w in rows + near + rows[:20]]


@pytest.mark.parametrize("seed", [1, 2])
def test_overlapping_equals_loop(spark, seed):
    rng = random.Random(seed)
    sets, labels, limit = headlines(rng, 120), {"opinion", "podcast"}, 15
    df = Counter(w for s in sets for w in s)
    want = set()
    for i, x in enumerate(sets):
        for j in range(i + 1, len(sets)):
            both, small = set(x) & set(sets[j]) - labels, min(len(x), len(sets[j]))
            if small >= 3 and any(df[w] < limit for w in both) and (len(both) >= 5 or len(both) >= 0.55 * small):
                want.add((i, j, len(both)))
    rows = spark.createDataFrame([(i, w) for i, w in enumerate(sets)], "id long, w array<string>")
    found = pairs.overlapping(rows, "id", "w", tuple(labels), pairs.word_counts(rows, "w").where(f"df < {limit}"), 3)
    assert sorted(tuple(r) for r in found.select("a", "b", "shared").collect()) == sorted(want)
    # pairs come once from the join: nothing makes them distinct or joins their words
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and plan.count("Join") == 2
    odd = pairs.overlapping(rows, "id", "w", tuple(labels), pairs.word_counts(rows, "w").where(f"df < {limit}"), 3, ("id",), lambda x, y: (x("id") + y("id")) % 2 == 1)
    assert {(r.a, r.b) for r in odd.collect()} == {(a, b) for a, b, _ in want if (a + b) % 2}


def test_ran_before_equals_loop(spark):
    rng = random.Random(3)
    sets = [(i, w, [f"n{rng.randrange(40)}"] * rng.randrange(2)) for i, w in enumerate(headlines(rng, 80))]
    today, past = [r for r in sets if r[0] % 2 == 0], [(i, i // 30, w, n) for i, w, n in sets if i % 2]
    df = Counter(n for _, _, names in sets for n in names)
    want = {}
    for i, w, n in today:
        for j, edition, v, m in past:
            shared, small = len(set(w) & set(v)), min(len(w), len(v))
            named = any(2 <= df[x] <= 12 for x in set(n) & set(m)) and shared >= 3
            if shared >= 3 and ((small >= 4 and shared >= 0.55 * small) or shared >= 5 or named):
                want[i] = max(want.get(i, (-math.inf,)), (edition, -j, shared))
    a = spark.createDataFrame(today, "id long, w array<string>, n array<string>")
    b = spark.createDataFrame(past, "past_id long, edition long, w array<string>, n array<string>")
    found = history.ran_before(a, b, "id", "w", "n", "edition", history.distinctive(a, b, "n"))
    assert {r.id: (r.edition, -r.past_id, r.shared) for r in found.collect()} == want
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1  # the latest of each row, not distinct pairs
    vetoed = history.ran_before(a, b, "id", "w", "n", "edition", history.distinctive(a, b, "n"), veto=F.col("edition") >= 0)
    assert vetoed.count() == 0


def latest_by_loop(today, past):
    """id: (edition, -past_id, shared) of the latest match."""
    df, want = Counter(n for r in today for n in r[2]) + Counter(n for r in past for n in r[3]), {}
    for i, w, n in today:
        for j, edition, v, m in past:
            shared, small = len(set(w) & set(v)), min(len(w), len(v))
            named = any(2 <= df[x] <= 12 for x in set(n) & set(m)) and shared >= 3
            if (small >= 4 and shared >= 0.55 * small) or shared >= 5 or named:
                want[i] = max(want.get(i, (-math.inf,)), (edition, -j, shared))
    return want


@pytest.mark.parametrize("seed, frequent, first", [(5, 3, 1), (6, 25, 2), (7, 200, 64)])
def test_ran_before_under_pairs_of_words(spark, monkeypatch, seed, frequent, first):
    """Small limits: words are frequent and keys hold more past rows than are met at first."""
    monkeypatch.setattr(history, "FREQUENT", frequent)
    monkeypatch.setattr(history, "FIRST", first)
    rng = random.Random(seed)
    sets = [(i, w + [f"x{rng.randrange(25)}"] * (rng.random() < 0.5), [f"n{rng.randrange(30)}"] * rng.randrange(2)) for i, w in enumerate(headlines(rng, 70))]
    sets += [(len(sets) + i, list(reversed(w)), n) for i, (_, w, n) in enumerate(rng.sample(sets, 40))]
    today, past = [r for r in sets if r[0] % 2 == 0], [(i, i // 30, w, n) for i, w, n in sets if i % 2]
    a = spark.createDataFrame(today, "id long, w array<string>, n array<string>")
    b = spark.createDataFrame(past, "past_id long, edition long, w array<string>, n array<string>")
    known = history.distinctive(a, b, "n")
    for veto in (None, F.size("wa") < 0):
        found = history.ran_before(a, b, "id", "w", "n", "edition", known, veto)
        assert {r.id: (r.edition, -r.past_id, r.shared) for r in found.collect()} == latest_by_loop(today, past)


def test_near_copies_do_not_all_meet(spark, monkeypatch):
    monkeypatch.setattr(history, "FREQUENT", 100, raising=False)
    monkeypatch.setattr(history, "FIRST", 4, raising=False)
    n, met = 200, spark.sparkContext.accumulator(0)
    a = spark.createDataFrame([(i, [f"u{k}" for k in range(8)] + [f"a{i}"], []) for i in range(n)], "id long, w array<string>, n array<string>")
    b = spark.createDataFrame([(i, i // 10, [f"u{k}" for k in range(8)] + [f"b{i}"], []) for i in range(n)], "past_id long, edition long, w array<string>, n array<string>")

    @F.udf("boolean")
    def counted(words, edition):
        met.add(1)
        return False

    found = history.ran_before(a, b, "id", "w", "n", "edition", veto=counted("wa", "edition"))
    assert {(r.past_id, r.edition, r.shared) for r in found.collect()} == {(n - 10, n // 10 - 1, 8)}
    assert 0 < met.value <= n * 4 * 10  # ten pairs of words; n * n pairs of rows


def test_rounds_leave_no_edges(spark):
    rng = random.Random(4)
    edges = spark.createDataFrame(sorted({tuple(sorted(rng.sample(range(40), 2))) for _ in range(30)}), "a long, b long")
    folder = shared_dir(spark).removeprefix("file://")
    before = set(glob.glob(f"{folder}/star-edges*") + glob.glob(f"{folder}/component-*"))
    assert cluster.stars(spark.range(40), edges).count() + cluster.components(spark.range(40), edges).count() == 80
    left = set(glob.glob(f"{folder}/star-edges*") + glob.glob(f"{folder}/component-*")) - before
    assert [x for x in left if "component-labels" not in x] == [] and len(left) == 1
