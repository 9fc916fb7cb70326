"""Splits that keep related records together: components, then largest-differencing balance."""

from __future__ import annotations

import heapq
import itertools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slidemill.operators.relational import join_skewed
from slidemill.session import cut_lineage

#: Where there are several shards, a component with more than 1/HEAVY of all weight is allocated before them; there are fewer than HEAVY of them.
HEAVY = 1000
#: A node with more than 1/HOT of all links, and no fewer than HOT_LINKS, is joined by broadcast.
HOT, HOT_LINKS = 1000, 100_000
#: Components that one task balances, and the equal bins it makes of them.
SHARD, BINS = 5_000, 100
#: Deviations of a stratum's share and of the overall share up to which there is little to gain.
TOLERANCE, OVERALL_TOLERANCE = 0.006, 0.002
#: How much more the overall shares count than those of all strata together.
OVERALL = 100
#: What a deviation within the tolerance counts, and the part of the cost that a pass over all items must save to be followed by another.
WITHIN, LEAST_GAIN = 0.01, 0.0001
#: Weight of a stratum up to which all sums of its components are tried for the bound of its shares.
BOUND_WEIGHT = 200_000


def connected_components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60, hot_links: int = HOT_LINKS) -> DataFrame:
    """``(node, component)`` of every node with a link, by large-star and small-star rounds.

    A component is named by its smallest node. ``a`` and ``b`` are columns of one type; null
    ends link nothing, a link of a node with itself keeps the node. Each round halves paths
    and is checkpointed; links stay distributed throughout. A round is one shuffle per star
    and one that removes repeated links; nodes that may be hot are looked for only where there
    are enough links for one.
    """
    base = cut_lineage(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where(F.col("u").isNotNull() & F.col("v").isNotNull()).distinct())
    nodes = base.select(F.explode(F.array("u", "v")).alias("node")).distinct()
    edges, before = base.where(F.col("u") != F.col("v")), None
    n_links = base.count()
    for _ in range(rounds):
        edges = cut_lineage(_small_star(_large_star(edges, n_links, hot_links), n_links, hot_links))
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before, n_links = now, now[0]
    else:
        raise RuntimeError(f"no fixed point after {rounds} rounds")
    roots = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
    return nodes.join(roots, "node", "left").select("node", F.coalesce("root", "node").alias("component"))


def _with_least(edges: DataFrame, n_links: int, hot_links: int) -> DataFrame:
    """Adds to every link the smallest other end ``m`` at its ``u``; links of few hot nodes stay where they are.

    ``edges`` are read several times where there are enough of them for a hot node.
    """
    least = F.min("v").over(Window.partitionBy("u"))
    if n_links <= hot_links:
        return edges.withColumn("m", least)
    degrees = edges.groupBy("u").agg(F.count("*").alias("degree"))
    hot = cut_lineage(degrees.where(F.col("degree") > max(hot_links, n_links // HOT)).select("u"))
    if not hot.limit(1).count():
        return edges.withColumn("m", least)
    of_hot = edges.join(F.broadcast(hot), "u").groupBy("u").agg(F.min("v").alias("m"))
    rest = edges.join(F.broadcast(hot), "u", "left_anti").withColumn("m", least)
    return edges.join(F.broadcast(of_hot), "u").select("u", "v", "m").unionByName(rest.select("u", "v", "m"))


def _large_star(edges: DataFrame, n_links: int, hot_links: int) -> DataFrame:
    both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.u", "e.v")
    found = _with_least(both, 2 * n_links, hot_links)
    return found.where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()


def _small_star(edges: DataFrame, n_links: int, hot_links: int) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _with_least(cut_lineage(down) if n_links > hot_links else down, n_links, hot_links)
    moved = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v"))))
    return found.select(moved.alias("e")).select("e.u", "e.v").where("u <> v").distinct()


def differencing(weights: Sequence[float], bins: int) -> list[int]:
    """The bin of every weight by largest differencing: the two most uneven partial partitions are combined, largest with smallest.

    Ties go by the order of the weights.
    """
    tick = itertools.count()
    heap: list[tuple] = []
    for i, w in enumerate(weights):
        sums = [0.0] * (bins - 1) + [float(w)]
        heapq.heappush(heap, (-float(w), next(tick), sums, [None] * (bins - 1) + [i]))
    while len(heap) > 1:
        _, _, sa, ma = heapq.heappop(heap)
        _, _, sb, mb = heapq.heappop(heap)
        joined = []
        for x, y, p, q in zip(sa, reversed(sb), ma, reversed(mb)):
            joined.append((x + y, p if q is None else q if p is None else (p, q)))
        joined.sort(key=lambda t: t[0])
        sums, members = [t[0] for t in joined], [t[1] for t in joined]
        heapq.heappush(heap, (sums[0] - sums[-1], next(tick), sums, members))
    out = [0] * len(weights)
    if heap:
        for k, tree in enumerate(heap[0][3]):
            stack = [tree]
            while stack:
                t = stack.pop()
                if isinstance(t, tuple):
                    stack += t
                elif t is not None:
                    out[t] = k
    return out


class Balance:
    """How far the strata of items are from their goals, while the items are allocated to splits.

    Items are given as entries (item, stratum, weight), so an item costs what it holds and their
    number of strata is not bounded; ``goals`` has the weight that each split should get of a
    stratum, ``whole`` the weight that a deviation counts against, ``tolerance`` what it may be.
    The sum over all strata is one more stratum with the goals ``overall``.
    """

    def __init__(self, item: np.ndarray, stratum: np.ndarray, weight: np.ndarray, goals: np.ndarray, whole: np.ndarray, overall: np.ndarray, everything: float, part: int = 1):
        item, stratum, weight = _merged(item, stratum, weight)
        n, last = int(item.max()) + 1, len(goals)
        self.total = np.bincount(item, weight, n)
        item, stratum, weight = np.append(item, np.arange(n)), np.append(stratum, np.full(n, last)), np.append(weight, self.total)
        order = np.argsort(item, kind="stable")
        self.item, self.stratum = item[order], stratum[order]
        # of ``part`` shards each may use its part of the tolerance
        scale = np.maximum(np.append(whole, everything), 1e-9) / part
        self.weight = weight[order] / scale[self.stratum]
        self.ends = np.searchsorted(self.item, np.arange(n + 1))
        self.off = -np.vstack([goals, overall]) / scale[:, None]
        self.tolerance = np.full(last + 1, TOLERANCE)
        self.tolerance[last] = OVERALL_TOLERANCE
        self.worth = np.ones(last + 1)
        self.worth[last] = max(last, 1)
        self.split = np.full(n, -1)

    def cost(self, off: np.ndarray, tolerance: np.ndarray, worth: np.ndarray) -> np.ndarray:
        return worth * (WITHIN * off * off + np.maximum(np.abs(off) - tolerance, 0.0) ** 2)

    def change(self, entries: slice | np.ndarray, split: int, sign: int) -> np.ndarray:
        """What it costs, entry by entry, to put them into a split (or take them out)."""
        s, w = self.stratum[entries], self.weight[entries]
        off, tolerance, worth = self.off[s, split], self.tolerance[s], self.worth[s]
        return self.cost(off + sign * w, tolerance, worth) - self.cost(off, tolerance, worth)

    def put(self, i: int, split: int) -> None:
        e = slice(self.ends[i], self.ends[i + 1])
        if self.split[i] >= 0:
            self.off[self.stratum[e], self.split[i]] -= self.weight[e]
        self.off[self.stratum[e], split] += self.weight[e]
        self.split[i] = split

    def move(self, i: int, split: int) -> float:
        e = slice(self.ends[i], self.ends[i + 1])
        return float(self.change(e, self.split[i], -1).sum() + self.change(e, split, 1).sum())

    def fill(self, shares: np.ndarray) -> None:
        """Heaviest item first, into the split with room that keeps the shares best.

        A split has room while its weight with half the item stays below its goal; if none has,
        the one furthest below takes it.
        """
        for i in np.argsort(-self.total, kind="stable"):
            e = slice(self.ends[i], self.ends[i + 1])
            s, w = self.stratum[e], self.weight[e]
            last = int(np.argmax(s))
            open_to = -self.off[s[last]] - w[last] / 2
            room = np.flatnonzero(open_to > 0)
            if len(room):
                # squares, by the goal of the split: early items are far from every goal
                grown = ((self.off[s][:, room] * 2 + w[:, None]) * w[:, None]).sum(axis=0) / np.maximum(shares[room], 1e-9)
                self.put(i, int(room[np.argmin(grown)]))
            else:
                self.put(i, int(np.argmax(open_to)))

    def refine(self) -> None:
        """Moves items between splits, or swaps two, while the shares get better by it."""
        splits = self.off.shape[1]
        while True:
            before = self.total_cost()
            gains: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
            listed: list[tuple[float, int, int]] = []
            for k, m in itertools.permutations(range(splits), 2):
                entries = np.flatnonzero((self.split == k)[self.item])
                if not len(entries):
                    continue
                owner = self.item[entries]
                gain = np.bincount(owner, self.change(entries, k, -1) + self.change(entries, m, 1), len(self.split))
                ids = np.unique(owner)
                best = ids[np.argsort(gain[ids], kind="stable")[:200]]
                gains[k, m] = best, gain[best]
                listed += [(g, int(i), m) for i, g in zip(best, gain[best].tolist()) if g < 0]
            for _, i, m in sorted(listed):
                if self.split[i] != m and self.move(i, m) < 0:
                    self.put(i, m)
            after = self.total_cost()
            if before - after <= LEAST_GAIN * before:
                after = self._swap(gains, after)
            if before - after <= LEAST_GAIN * before:
                return

    def total_cost(self) -> float:
        return float(self.cost(self.off, self.tolerance[:, None], self.worth[:, None]).sum())

    def _swap(self, gains: dict, now: float) -> float:
        """Swaps of the items that cost least to move each way, each taken if it helps."""
        for (k, m), (there, cost_there) in gains.items():
            if k > m or (m, k) not in gains:
                continue
            back, cost_back = gains[m, k]
            sums = cost_there[:60, None] + cost_back[None, :60]
            for flat in np.argsort(sums, axis=None, kind="stable")[:600]:
                i, j = int(there[flat // sums.shape[1]]), int(back[flat % sums.shape[1]])
                if self.split[i] != k or self.split[j] != m:
                    continue
                first = self.move(i, m)
                self.put(i, m)
                second = self.move(j, k)
                if first + second < 0:
                    self.put(j, k)
                    now += first + second
                else:
                    self.put(i, k)
        return now


def balanced_splits(weights: DataFrame, shares: dict[str, float], shard: int = SHARD, bins: int = BINS, heavy: int = HEAVY) -> DataFrame:
    """``(component, split)``: whole components allocated to splits in the given shares, overall and per stratum.

    ``weights`` has ``component, stratum, weight``. Components are spread by hash over shards of
    about ``shard`` components; each shard is turned into ``bins`` equal bins by largest
    differencing, and whole bins go to the splits; then single components move or are swapped
    while that brings strata nearer to their shares. A component too big for an equal bin is an
    item of its own beside the bins. If there are several shards, components above 1/``heavy``
    of all weight, fewer than ``heavy``, are allocated before, by the same rules; what they leave
    of every stratum's share is then the goal of the others. Every stratum keeps its own shares,
    however many there are; ``share_report`` tells how near whole components can come to them.

    Deterministic for given rows, whatever their order. Null strata count as one stratum; null
    components are left out; components without weight get a split too; repeated rows add up;
    an empty table gives an empty result; other columns are not read.
    """
    if abs(sum(shares.values()) - 1) > 1e-9 or min(shares.values()) < 0:
        raise ValueError("shares must be positive and sum to 1")
    names, goal = list(shares), np.array(list(shares.values()), float)
    w = cut_lineage(
        weights.where(F.col("component").isNotNull())
        .groupBy(F.col("component").cast("string").alias("component"), F.coalesce(F.col("stratum").cast("string"), F.lit("")).alias("stratum"))
        .agg(F.coalesce(F.sum("weight"), F.lit(0)).cast("double").alias("weight"))
    )
    sums = w.groupBy("component").agg(F.sum("weight").alias("total"))
    count, everything = sums.agg(F.count("*"), F.coalesce(F.sum("total"), F.lit(0.0))).first()
    shards = max(1, -(-int(count) // shard))

    def place(pdf: pd.DataFrame, n_bins: int, overall: np.ndarray, part: float, parts: int) -> pd.DataFrame:
        """The splits of components: too big ones by themselves, the others in ``n_bins`` equal bins, then one by one."""
        if not len(pdf):
            return pd.DataFrame({"component": [], "split": []}, dtype=str)
        pdf = pdf.sort_values(["component", "stratum"], kind="stable")
        at, component = pd.factorize(pdf["component"])
        column, strata = pd.factorize(pdf["stratum"])
        weight = pdf["weight"].to_numpy(float)
        total = np.bincount(at, weight, len(component))
        alone = total > (total.sum() / n_bins if n_bins else -1.0)
        order = np.argsort(-total, kind="stable")
        small = order[~alone[order]]
        group = np.zeros(len(component), int)
        group[small] = differencing(total[small], n_bins)
        group[alone] = np.arange(alone.sum()) + n_bins
        _, group = np.unique(group, return_inverse=True)
        # a row has the goals and the whole weight per unit of its stratum's weight here
        sums = np.zeros((len(strata), len(names) + 1))
        np.add.at(sums, column, np.column_stack([np.stack(pdf["goals"].to_numpy()), pdf["up"]]) * weight[:, None])
        given = (sums[:, :-1], sums[:, -1], overall * (total.sum() / part if part else 1.0), everything, parts)
        bins_first = Balance(group[at], column, weight, *given)
        bins_first.fill(goal)
        single = Balance(at, column, weight, *given)
        for i, k in enumerate(bins_first.split[group]):
            single.put(i, int(k))
        single.refine()
        # the overall shares have the last word: small strata may be far from theirs by no fault
        single.worth[-1] *= OVERALL
        single.refine()
        return pd.DataFrame({"component": component, "split": [names[k] for k in single.split]})

    equal, whole = F.array(*map(F.lit, goal.tolist())), goal * everything
    if shards == 1:
        return w.withColumns({"goals": equal, "up": F.lit(1.0)}).groupBy(F.lit(0).alias("shard")).applyInPandas(
            lambda pdf: place(pdf, bins, whole, everything, 1), "component string, split string"
        )
    top = sums.where(F.col("total") > everything / heavy)
    big = w.join(F.broadcast(top.select("component")), "component")
    per_heavy = (
        big.groupBy("stratum").agg(F.sum("weight").alias("here"))
        .join(w.groupBy("stratum").agg(F.sum("weight").alias("whole")), "stratum")
        .select("stratum", F.when(F.col("here") > 0, F.col("whole") / F.col("here")).otherwise(1.0).alias("up"), equal.alias("goals"))
    )
    placed = (
        big.join(per_heavy, "stratum")
        .groupBy(F.lit(0).alias("shard"))
        .applyInPandas(lambda pdf: place(pdf, 0, whole, everything, 1), "component string, split string")
        .collect()
    )  # fewer than ``heavy`` rows
    if not placed:
        light = w.withColumns({"goals": equal, "up": F.lit(1.0)})
        return light.groupBy(F.pmod(F.xxhash64("component"), F.lit(shards)).alias("shard")).applyInPandas(
            lambda pdf: place(pdf, bins, whole, everything, shards), "component string, split string"
        )
    fixed = w.sparkSession.createDataFrame(sorted((r.component, r.split) for r in placed), "component string, split string")
    marked = w.join(F.broadcast(fixed), "component", "left")
    given = [F.coalesce(F.sum(F.when(F.col("split") == n, F.col("weight"))), F.lit(0.0)).alias(f"given_{k}") for k, n in enumerate(names)]
    taken = np.array(marked.agg(*given).first(), float)
    left = everything - taken.sum()
    here = F.col("whole") - sum((F.col(f"given_{k}") for k in range(len(names))), F.lit(0.0))
    per_stratum = (
        marked.groupBy("stratum").agg(F.sum("weight").alias("whole"), F.count("*").alias("n"), *given)
        .withColumn("here", here)
        .select(
            "stratum", "n",
            F.when(F.col("here") > 0, F.col("whole") / F.col("here")).otherwise(1.0).alias("up"),
            F.when(F.col("here") > 0, F.array(*((g * F.col("whole") - F.col(f"given_{k}")) / F.col("here") for k, g in enumerate(goal.tolist()))))
            .otherwise(equal).alias("goals"),
        )
    )
    all_rows = w.count()
    light = (
        join_skewed(marked.where("split IS NULL").select("component", "stratum", "weight"), per_stratum, "stratum", F.col("n") > all_rows / heavy)
        .select("component", "stratum", "weight", "up", "goals")
        .groupBy(F.pmod(F.xxhash64("component"), F.lit(shards)).alias("shard"))
        .applyInPandas(lambda pdf: place(pdf, bins, whole - taken, left, shards), "component string, split string")
    )
    return light.unionByName(fixed)


def _merged(item: np.ndarray, stratum: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One entry per item and stratum."""
    key, at = np.unique(item.astype(np.int64) * (int(stratum.max()) + 1) + stratum, return_inverse=True)
    return key // (int(stratum.max()) + 1), key % (int(stratum.max()) + 1), np.bincount(at, weight, len(key))


def share_bound(histogram: Sequence[tuple[float, int]], shares: Sequence[float]) -> float:
    """The least largest deviation from ``shares`` that whole components of these (weight, number) can reach, or less.

    For whole weights of at most BOUND_WEIGHT in all, every sum of components is tried for each
    split alone; beyond, only whether the largest component fits.
    """
    histogram = [(w, n) for w, n in histogram if w > 0]
    whole = sum(w * n for w, n in histogram)
    if not whole:
        return 0.0
    bound = max(0.0, max(w for w, _ in histogram) / whole - max(shares))
    if whole > BOUND_WEIGHT or any(w != int(w) for w, _ in histogram):
        return bound
    reach, whole = 1, int(whole)
    for weight, n in histogram:
        power = 1
        while n > 0:
            take = min(power, n)
            reach |= reach << (int(weight) * take)
            n, power = n - take, power * 2
    for share in shares:
        want = share * whole
        above = reach >> ((low := int(want)) + 1)
        up = (above & -above).bit_length() + low if above else whole
        down = (reach & ((1 << (low + 1)) - 1)).bit_length() - 1
        bound = max(bound, min(abs(up - want), abs(want - down)) / whole)
    return bound


def share_report(weights: DataFrame, splits: DataFrame, shares: dict[str, float]) -> DataFrame:
    """``(stratum, weight, deviation, bound)``: the largest deviation of a stratum's shares from the wanted ones, and the least that whole components allow.

    ``weights`` and ``splits`` are as in and from ``balanced_splits``. A stratum's components are
    counted by their weight, so no stratum is brought together. Null strata are one; strata
    without weight have no row; empty tables give none.
    """
    per = weights.where(F.col("component").isNotNull()).groupBy(F.col("component").cast("string").alias("component"), "stratum").agg(F.sum("weight").cast("double").alias("weight"))
    placed = per.where("weight > 0").join(splits, "component")
    off = F.greatest(*(F.abs(F.coalesce(F.sum(F.when(F.col("split") == n, F.col("weight"))), F.lit(0.0)) / F.sum("weight") - F.lit(float(f))) for n, f in shares.items()), F.lit(0.0))
    wanted = list(shares.values())

    @F.pandas_udf("double")
    def bound(groups: pd.Series) -> pd.Series:
        return pd.Series([share_bound([(r["weight"], r["n"]) for r in g], wanted) for g in groups], dtype=float)

    got = placed.groupBy("stratum").agg(F.sum("weight").alias("weight"), off.alias("deviation"))
    counted = placed.groupBy("stratum", "weight").agg(F.count("*").alias("n")).groupBy("stratum").agg(bound(F.collect_list(F.struct("weight", "n"))).alias("bound"))
    return got.join(counted, got["stratum"].eqNullSafe(counted["stratum"])).select(got["stratum"], got["weight"], "deviation", "bound")


def related_groups(records: DataFrame, owner: Column, partner: Column) -> DataFrame:
    """``(owner, component)``: owners linked by a shared partner, directly or through others; without partner alone."""
    pairs = records.select(owner.alias("owner"), partner.alias("partner")).where(F.col("owner").isNotNull()).distinct()
    a, b = F.concat(F.lit("a:"), F.col("owner")), F.concat(F.lit("b:"), F.col("partner"))
    links = pairs.select(a.alias("a"), F.coalesce(b, a).alias("b"))
    found = connected_components(links).where(F.col("node").startswith("a:"))
    return found.select(F.expr("substring(node, 3)").alias("owner"), "component")
