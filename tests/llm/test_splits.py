import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from slidemill.llm.splits import Balance, balanced_splits, connected_components, differencing, related_groups, share_bound, share_report
from tests.conftest import rows


def brute(links):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("hot", [100_000, 20])
@pytest.mark.parametrize("kind", ["random", "chain", "star"])
def test_components(spark, kind, hot):
    rng = random.Random(1)
    links = {
        "random": [(f"n{rng.randrange(150):03d}", f"n{rng.randrange(150):03d}") for _ in range(110)],
        "chain": [(f"n{k:03d}", f"n{k + 1:03d}") for k in range(60)],
        "star": [("m", f"n{k:03d}") for k in range(200)] * 2,
    }[kind]
    df = spark.createDataFrame([*links, (None, "x"), ("y", None)], "a string, b string").withColumn("u", F.lit(1))
    assert dict(rows(connected_components(df, hot_links=hot))) == brute(links)


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "a string, b string")).count() == 0
    pairs = spark.createDataFrame([("a", None), ("b", "g"), ("c", "g"), (None, "g"), ("a", None)], "o string, p string")
    out = dict(rows(related_groups(pairs, F.col("o"), F.col("p"))))
    assert set(out) == {"a", "b", "c"} and out["b"] == out["c"] != out["a"]


def test_differencing_makes_equal_bins():
    rng = random.Random(4)
    weights = [rng.randrange(1, 100) for _ in range(500)]
    bins = differencing(weights, 10)
    sums = Counter()
    for w, b in zip(weights, bins):
        sums[b] += w
    assert len(sums) == 10 and max(sums.values()) - min(sums.values()) <= 2
    assert differencing([], 3) == [] and sorted(differencing([5, 4], 3)) == [1, 2]


def test_bins_follow_shares():
    shares, items = np.array([0.7, 0.1, 0.2]), np.arange(100)
    b = Balance(items, np.zeros(100, int), np.ones(100), shares[None, :] * 100, np.array([100.0]), shares * 100, 100.0)
    b.fill(shares)
    assert Counter(b.split.tolist()) == {0: 70, 1: 10, 2: 20}


def test_refining_keeps_its_sums_and_never_gets_worse():
    rng = np.random.default_rng(5)
    n, strata, shares = 300, 12, np.array([0.7, 0.1, 0.2])
    item, stratum = np.repeat(np.arange(n), 2), rng.integers(0, strata, 2 * n)
    weight = rng.integers(1, 9, 2 * n).astype(float)
    whole = np.bincount(stratum, weight, strata)
    b = Balance(item, stratum, weight, whole[:, None] * shares, whole, shares * whole.sum(), whole.sum())
    b.fill(shares)
    before = b.total_cost()
    b.refine()
    assert b.total_cost() <= before
    for s in range(strata):
        got = np.array([weight[(stratum == s) & (b.split[item] == k)].sum() for k in range(3)])
        assert np.allclose(got / whole[s] - shares, b.off[s])
        assert np.abs(got / whole[s] - shares).max() < 0.01


@pytest.mark.parametrize("shares", [(0.7, 0.1, 0.2), (0.5, 0.5)])
def test_bound_is_below_every_allocation(shares):
    rng = random.Random(3)
    for _ in range(40):
        sizes = [rng.randrange(1, 12) for _ in range(rng.randrange(1, 7))]
        least = min(
            max(abs(sum(w for w, k in zip(sizes, given) if k == s) / sum(sizes) - f) for s, f in enumerate(shares))
            for given in itertools.product(range(len(shares)), repeat=len(sizes))
        )
        bound = share_bound(list(Counter(sizes).items()), shares)
        assert bound <= least + 1e-12
        if len(shares) == 2:
            assert bound == pytest.approx(least)
    assert share_bound([], shares) == 0 and share_bound([(0.5, 3)], shares) == 0


def test_report(spark):
    data = [("a", "s", 7), ("b", "s", 1), ("c", "s", 2), ("a", None, 1), ("d", "u", 0)]
    w = spark.createDataFrame(data, "component string, stratum string, weight long")
    splits = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z"), ("d", "x")], "component string, split string")
    out = {r.stratum: r for r in share_report(w, splits, {"x": 0.7, "y": 0.1, "z": 0.2}).collect()}
    assert set(out) == {"s", None} and out["s"].deviation < 1e-9 and out["s"].bound < 1e-9
    assert out[None].deviation == pytest.approx(0.3) and out[None].bound == pytest.approx(0.3)
    assert share_report(w.limit(0), splits, {"x": 1.0}).count() == 0


def weights(spark, heavy=False):
    rng = random.Random(2)
    data = [(f"c{k}", f"t{rng.randrange(4)}", rng.randrange(1, 9)) for k in range(1500) for _ in range(2)]
    if heavy:
        data += [("big", "t0", 5000)]
    return spark.createDataFrame([*data, (None, "t", 1), ("none", None, None)], "component string, stratum string, weight long").withColumn("split", F.lit("clash"))


@pytest.mark.parametrize("heavy", [False, True])
def test_shares_overall_and_per_stratum(spark, heavy):
    w, goal = weights(spark, heavy), {"train": 0.7, "val": 0.1, "test": 0.2}
    out = balanced_splits(w, goal, shard=400)
    split = {r.component: r.split for r in out.collect()}
    assert len(split) == out.count() == w.where("component IS NOT NULL").select("component").distinct().count()
    total, per = Counter(), Counter()
    for r in w.where("component IS NOT NULL").collect():
        total[split[r.component]] += r.weight or 0
        per[r.stratum, split[r.component]] += r.weight or 0
    everything = sum(total.values())
    for s, f in goal.items():
        assert abs(total[s] / everything - f) < 0.02
        for t in ("t0", "t1", "t2", "t3"):
            whole = sum(per[t, x] for x in goal)
            # the big component is a good half of t0, which train takes
            assert abs(per[t, s] / whole - f) < 0.02
    assert rows(out) == rows(balanced_splits(w.repartition(5).orderBy(F.rand(1)), goal, shard=400))


def test_edges(spark):
    empty = weights(spark).limit(0)
    assert balanced_splits(empty, {"a": 0.5, "b": 0.5}).count() == 0
    one = spark.createDataFrame([("c", "s", 3), ("c", "s", 3)], "component string, stratum string, weight long")
    assert rows(balanced_splits(one, {"a": 0.7, "b": 0.3})) == [("c", "a")]
    with pytest.raises(ValueError):
        balanced_splits(one, {"a": 0.7})


@pytest.mark.parametrize("shard", [20_000, 60])
def test_big_components_keep_the_shares_per_stratum(spark, shard):
    rng = random.Random(8)
    # 100 components above 1/1000 of all weight, each in one of four strata, and small ones in another
    data = [(f"b{k:03d}", f"t{k * 4 // 100}", 90 + rng.randrange(20)) for k in range(100)]
    data += [(f"c{k:03d}", "t4", rng.randrange(1, 9)) for k in range(300)]
    goal = {"train": 0.7, "val": 0.1, "test": 0.2}
    w = spark.createDataFrame(data, "component string, stratum string, weight long")
    out = balanced_splits(w, goal, shard=shard)
    split = dict(out.select("component", "split").collect())
    assert len(split) == out.count() == 400
    per = Counter()
    for c, t, n in data:
        per[t, split[c]] += n
    for t in ("t0", "t1", "t2", "t3", "t4"):
        whole = sum(per[t, s] for s in goal)
        assert all(abs(per[t, s] / whole - f) < 0.05 for s, f in goal.items()), (t, per)


def test_small_components_make_up_for_big_ones_per_stratum(spark):
    # the big component takes all that train should get of t0; the small ones of t0 must go elsewhere
    data = [("big", "t0", 700)] + [(f"c{k:03d}", f"t{k % 2}", 1) for k in range(600)]
    goal = {"train": 0.7, "val": 0.1, "test": 0.2}
    out = balanced_splits(spark.createDataFrame(data, "component string, stratum string, weight long"), goal, shard=150)
    split = dict(out.collect())
    assert len(split) == 601 and split["big"] == "train"
    per = Counter()
    for c, t, n in data:
        per[t, split[c]] += n
    for t, whole in (("t0", 1000), ("t1", 300)):
        assert all(abs(per[t, s] / whole - f) < 0.04 for s, f in goal.items()), per
