"""Best representative of each duplicate group: consistent bundles chosen by branch and bound."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slidemill.operators.relational import BROADCAST_ROWS, join_skewed, small_enough
from slidemill.session import cut_lineage

#: A group with more than 1/HOT_GROUPS of all repeated rows, and no fewer than HOT_ROWS, is hot.
HOT_GROUPS, HOT_ROWS = 1000, 100_000
#: Most distinct candidates of a group that go into one search; larger groups are solved by joins, to the same result.
SEARCH_LIMIT = 512
#: Rows of a group that one task pairs with all others of the group.
PAIRED_ROWS = 1000


@dataclass(frozen=True)
class Bundle:
    """Fields that depend on each other and are only taken together, with the trust in a row's values (0 to 9)."""

    name: str
    fields: tuple[str, ...]
    trust: Column | None = field(default=None, compare=False)


@dataclass(frozen=True)
class Dependency:
    """A functional dependency: within a group, ``of_fields`` of the bundle ``of`` determine ``on_fields`` of ``on``.

    What a value determines is what the most trusted row that holds it says; where either side
    is missing there, nothing is determined.
    """

    of: str
    of_fields: tuple[str, ...]
    on: str
    on_fields: tuple[str, ...]


@dataclass(frozen=True)
class Representatives:
    """``survivors``: one row per group with ``n_rows`` and a struct of every bundle; ``merged``: those of
    several rows, stored; ``members``: ``group_key, row_key`` of every row with a group; ``duplicates``:
    those of groups with several rows; ``any_hot``: whether one of these groups is hot."""

    survivors: DataFrame
    merged: DataFrame
    members: DataFrame
    duplicates: DataFrame
    any_hot: bool


def filled(column: str) -> Column:
    value = F.col(f"`{column}`").cast("string")
    return value.isNotNull() & (F.trim(value) != "")


def _score(bundle: Bundle, recency: Column | None) -> Column:
    """Completeness (steps of 1000) and trust (0 to 9), then recency in microseconds: whole numbers, compared in this order."""
    full = sum((filled(f).cast("long") for f in bundle.fields), F.lit(0)) * 1000 / F.lit(len(bundle.fields))
    quality = F.round(full).cast("long") * 1000
    if bundle.trust is not None:
        quality = quality + F.least(F.greatest(F.coalesce(bundle.trust.cast("long"), F.lit(0)), F.lit(0)), F.lit(9))
    moment = F.lit(0).cast("long") if recency is None else F.coalesce(F.unix_micros(recency.cast("timestamp")), F.lit(0))
    return F.struct(quality.alias("q"), moment.alias("r"))


def _sum(scores: Sequence[Column]) -> Column:
    """Scores add up part by part, so a sum is compared as its parts are."""
    return F.struct(sum((s["q"] for s in scores[1:]), scores[0]["q"]).alias("q"), sum((s["r"] for s in scores[1:]), scores[0]["r"]).alias("r"))


def _stars(bundles: Sequence[Bundle], dependencies: Sequence[Dependency]) -> dict[str, list[Dependency]]:
    """The dependencies by their determining bundle."""
    names = [b.name for b in bundles]
    out: dict[str, list[Dependency]] = {}
    for d in dependencies:
        out.setdefault(d.of, []).append(d)
    determined = [d.on for d in dependencies]
    if len(set(names)) != len(names) or not {*out, *determined} <= set(names):
        raise ValueError("bundles need different names, and dependencies name bundles")
    if len(set(determined)) != len(determined) or set(determined) & set(out):
        raise ValueError("a bundle is determined by one other at most, and determines others or is determined")
    return out


def _order(value: Sequence[str | None]) -> tuple:
    """Values in the order of the engine: field by field, missing first, by bytes."""
    return tuple((v is not None, (v or "").encode()) for v in value)


def choose(determining: Sequence[tuple], determined: Sequence[Sequence[tuple]], meant: Sequence[dict]) -> tuple:
    """The most trusted consistent combination by branch and bound.

    ``determining`` and each of ``determined`` hold ``(score, order, value, link)`` of distinct
    values in falling order; ``meant`` has for every determined bundle what a link of the
    determining one means there. Branches follow the falling scores; one is cut as soon as what
    it has, with the best that the open bundles could add, stays below what is reached. Between
    equal sums the greatest values win, the determining bundle's first.
    """
    most = [side[0][0] for side in determined]
    best: tuple | None = None
    for score, order, value, link in determining:
        total, orders, values = score, [order], [value]
        for k, side in enumerate(determined):
            bound = (total[0] + sum(q for q, _ in most[k:]), total[1] + sum(r for _, r in most[k:]))
            if best is not None and bound < best[0]:
                break
            want = meant[k].get(link)
            found = side[0] if want is None else next(c for c in side if c[3] == want)
            total = (total[0] + found[0][0], total[1] + found[0][1])
            orders.append(found[1])
            values.append(found[2])
        else:
            if best is None or (total, orders) > best[:2]:
                best = (total, orders, values)
            continue
        if k == 0:
            break  # all that follow have no higher score
    return tuple(best[2])


def _search(rows: Sequence[dict], n: int) -> tuple:
    """The chosen values of a determining bundle and ``n`` determined ones, out of a group's distinct candidates."""

    def side(name: str, rows_of: Sequence[dict]) -> list[tuple]:
        top: dict[tuple, tuple] = {}
        for r in rows_of:
            value = tuple(r[f"{name}_val"])
            link = None if r[f"{name}_link"] is None else tuple(r[f"{name}_link"])
            top[value, link] = max(top.get((value, link), (-1, 0)), (r[f"{name}_q"], r[f"{name}_r"]))
        return sorted(((s, _order(v), v, x) for (v, x), s in top.items()), key=lambda t: t[:2], reverse=True)

    meant: list[dict] = []
    for k in range(n):
        of: dict[tuple, tuple] = {}
        for r in rows:
            if r["a_link"] is not None and r[f"b{k}_link"] is not None:
                says = ((r[f"b{k}_q"], r[f"b{k}_r"]), _order(r[f"b{k}_val"]), tuple(r[f"b{k}_link"]))
                at = tuple(r["a_link"])
                of[at] = max(of.get(at, ((-1, 0),)), says, key=lambda t: t[:2])
        meant.append({x: says[2] for x, says in of.items()})
    return choose(side("a", rows), [side(f"b{k}", rows) for k in range(n)], meant)


def best_representatives(
    rows: DataFrame,
    group: Column,
    row_key: str,
    bundles: Sequence[Bundle],
    dependencies: Sequence[Dependency] = (),
    recency: Column | None = None,
    search_limit: int = SEARCH_LIMIT,
    hot_rows: int = HOT_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> Representatives:
    """The survivors of duplicate groups, with the rows that they stand for.

    A bundle's fields always come from one row. A bundle in no dependency takes the value with
    the highest score: completeness, then trust, then recency, all as whole numbers, ties by the
    greatest value. Bundles linked by dependencies take the combination with the highest sum of
    scores among those that keep every dependency, ties by the greatest values in the order
    of the dependencies. A bundle may determine several others or be determined by one.

    Group sizes are counted first, from the keys alone. Rows that are alone in their group are
    their own survivors and never shuffled whole; only rows of groups with several are brought
    together (the list of such groups is broadcast where it is counted to be short, and joined
    otherwise) and stored once (checkpointed). Where the best values of all linked bundles
    stand in one row they are the answer; the distinct candidates of the other groups go into a
    branch and bound search. Groups of more than ``search_limit`` candidates, and hot ones, are
    solved by joins on their links instead, to the same result, so no group is ever collected
    whole.

    Rows with null group are left out; null and empty fields count as missing and an
    all-missing bundle survives as nulls; repeated rows change only ``n_rows``; empty input
    gives empty results; fields in no bundle are dropped, so extra columns cannot clash.
    """
    stars = _stars(bundles, dependencies)
    by_name = {b.name: b for b in bundles}
    linked = {n for of, ds in stars.items() for n in (of, *(d.on for d in ds))}

    def value(b: Bundle) -> Column:
        return F.array(*(F.when(filled(f), F.col(f"`{f}`").cast("string")) for f in b.fields))

    base = rows.select(
        group.cast("string").alias("group_key"),
        F.col(f"`{row_key}`").alias("row_key"),
        *(value(b).alias(f"v_{b.name}") for b in bundles),
        *(_score(b, recency).alias(f"s_{b.name}") for b in bundles),
    ).where(F.col("group_key").isNotNull())
    sizes = cut_lineage(base.groupBy("group_key").agg(F.count("*").alias("n_rows")).where("n_rows > 1"))
    most, repeated_rows = sizes.agg(F.coalesce(F.max("n_rows"), F.lit(0)), F.coalesce(F.sum("n_rows"), F.lit(0))).first()
    any_hot = most > hot_rows and most * HOT_GROUPS > repeated_rows
    hot = (F.col("n_rows") > hot_rows) & (F.col("n_rows") * HOT_GROUPS > F.lit(repeated_rows))
    if small_enough(sizes, broadcast_rows):
        repeated = base.join(F.broadcast(sizes), "group_key")
        single = base.join(F.broadcast(sizes.select("group_key")), "group_key", "left_anti")
    else:
        repeated = join_skewed(base, sizes, "group_key", hot).drop("is_hot") if any_hot else base.join(sizes, "group_key")
        single = base.join(sizes.select("group_key"), "group_key", "left_anti")
    repeated = cut_lineage(repeated)

    per_group = repeated.groupBy("group_key", "n_rows").agg(
        *(F.max(F.struct(F.col(f"s_{b.name}").alias("s"), F.col(f"v_{b.name}").alias("v"))).alias(f"m_{b.name}") for b in bundles),
        *(_best_row(by_name, of, ds) for of, ds in stars.items()),
    )
    if stars:
        per_group = cut_lineage(per_group)
    chosen = {b.name: F.col(f"m_{b.name}.v") for b in bundles}
    out = per_group
    for of, ds in stars.items():
        picked = _solve(repeated, per_group, by_name, of, ds, hot if any_hot else None, search_limit)
        out = out.join(picked, "group_key", "left")
        for n in (of, *(d.on for d in ds)):
            chosen[n] = F.coalesce(f"p_{n}", f"m_{n}.v")

    def bundle_struct(b: Bundle, v: Column) -> Column:
        return F.struct(*(v[i].alias(f) for i, f in enumerate(b.fields))).alias(b.name)

    merged = out.select("group_key", "n_rows", *(bundle_struct(b, chosen[b.name]) for b in bundles))
    if linked:
        merged = cut_lineage(merged)
    alone = single.select("group_key", F.lit(1).cast("long").alias("n_rows"), *(bundle_struct(b, F.col(f"v_{b.name}")) for b in bundles))
    return Representatives(alone.unionByName(merged), merged, base.select("group_key", "row_key"), repeated.select("group_key", "row_key"), any_hot)


def _link(b: Bundle, fields: Sequence[str], v: Column) -> Column:
    """The values of some fields of a bundle; null if all are missing."""
    parts = [v[b.fields.index(f)] for f in fields]
    return F.when(F.coalesce(*parts).isNotNull(), F.array(*parts))


def _best_row(by_name: dict, of: str, ds: Sequence[Dependency]) -> Column:
    """The highest sum of the linked bundles' scores in one row that keeps the dependencies, with a hash of its values."""
    names = [of, *(d.on for d in ds)]
    keeps = F.lit(True)
    for d in ds:
        x, y = _link(by_name[of], d.of_fields, F.col(f"v_{of}")), _link(by_name[d.on], d.on_fields, F.col(f"v_{d.on}"))
        keeps = keeps & (x.isNull() | y.isNotNull())
    return F.max(F.when(keeps, F.struct(_sum([F.col(f"s_{n}") for n in names]).alias("s"), _hash([F.col(f"v_{n}") for n in names]).alias("h")))).alias(f"r_{of}")


def _hash(values: Sequence[Column]) -> Column:
    return F.xxhash64(*(F.transform(v, lambda x: F.coalesce(x, F.lit("\0"))) for v in values))


def _solve(repeated: DataFrame, per_group: DataFrame, by_name: dict, of: str, ds: Sequence[Dependency], hot: Column | None, limit: int) -> DataFrame:
    """``group_key, p_<bundle>...`` of the groups whose best linked values do not stand in one row; ``hot`` is None if no group is."""
    names = [of, *(d.on for d in ds)]
    best = F.col(f"r_{of}")
    closed = (best["s"] == _sum([F.col(f"m_{n}.s") for n in names])) & (best["h"] == _hash([F.col(f"m_{n}.v") for n in names]))
    open_groups = per_group.where(~F.coalesce(closed, F.lit(False))).select("group_key", (F.lit(False) if hot is None else hot).alias("hot"), *(F.col(f"m_{d.on}").alias(f"most{k}") for k, d in enumerate(ds)))
    sides = [("a", of, [f for d in ds for f in d.of_fields]), *((f"b{k}", d.on, d.on_fields) for k, d in enumerate(ds))]
    if len({d.of_fields for d in ds}) > 1:
        raise ValueError("the dependencies of a bundle start from the same fields")
    sides[0] = ("a", of, list(ds[0].of_fields))
    columns = []
    for short, name, fields in sides:
        v, s = F.col(f"v_{name}"), F.col(f"s_{name}")
        columns += [v.alias(f"{short}_val"), _link(by_name[name], fields, v).alias(f"{short}_link"), s["q"].alias(f"{short}_q"), s["r"].alias(f"{short}_r")]
    wide = repeated.drop("n_rows")
    joined = wide.join(open_groups, "group_key").withColumn("is_hot", F.lit(False)) if hot is None else join_skewed(wide, open_groups, "group_key", F.col("hot"))
    joint = cut_lineage(joined.select("group_key", "is_hot", *columns).distinct())
    largest = joint.groupBy("group_key").agg(F.count("*").alias("size")).agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]
    rest = joint.where("NOT is_hot")
    counts = rest.groupBy("group_key").agg(F.count("*").alias("size"))
    small = rest.join(counts.where(F.col("size") <= limit).select("group_key"), "group_key", "left_semi")
    large = rest.join(counts.where(F.col("size") > limit).select("group_key"), "group_key", "left_semi").unionByName(joint.where("is_hot"))
    plain = hot is None and largest <= limit
    shorts = [short for short, *_ in sides]
    shape = ", ".join(f"{x} array<string>" for x in shorts)

    @F.pandas_udf(shape)
    def search(groups: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([[list(v) for v in _search(rows, len(shorts) - 1)] for rows in groups], columns=shorts)

    fields = [c for c in joint.columns if c not in ("group_key", "is_hot")]
    searched = (joint if plain else small).groupBy("group_key").agg(F.collect_list(F.struct(*fields)).alias("rows")).select("group_key", search("rows").alias("p")).select("group_key", *(f"p.{x}" for x in shorts))
    found = searched if plain else searched.unionByName(_by_joins(large, open_groups, shorts))
    return found.select("group_key", *(F.col(x).alias(f"p_{n}") for x, n in zip(shorts, names)))


def _by_joins(large: DataFrame, open_groups: DataFrame, shorts: Sequence[str]) -> DataFrame:
    """What the search finds, for groups of any size: best values per link, what links mean, and the best sum per group."""

    def best(short: str) -> Column:
        return F.max(F.struct(F.struct(F.col(f"{short}_q").alias("q"), F.col(f"{short}_r").alias("r")).alias("s"), F.col(f"{short}_val").alias("v")))

    out = large.groupBy("group_key", "a_link").agg(best("a").alias("a")).join(open_groups.drop("hot"), "group_key")
    for k, b in enumerate(shorts[1:]):
        says = F.max(F.struct(F.struct(F.col(f"{b}_q").alias("q"), F.col(f"{b}_r").alias("r")).alias("s"), F.col(f"{b}_val").alias("v"), F.col(f"{b}_link").alias("l")))
        meant = large.where(F.col("a_link").isNotNull() & F.col(f"{b}_link").isNotNull()).groupBy("group_key", "a_link").agg(says.alias("m")).select("group_key", "a_link", F.col("m.l").alias(f"{b}_link"))
        per_link = large.where(F.col(f"{b}_link").isNotNull()).groupBy("group_key", f"{b}_link").agg(best(b).alias(b))
        known = meant.join(per_link, ["group_key", f"{b}_link"]).drop(f"{b}_link")
        out = out.join(known, ["group_key", "a_link"], "left").withColumn(b, F.coalesce(b, f"most{k}"))
    total = _sum([F.col(f"{x}.s") for x in shorts])
    won = F.max(F.struct(total.alias("total"), *(F.col(f"{x}.v").alias(x) for x in shorts)))
    return out.groupBy("group_key").agg(won.alias("w")).select("group_key", *(f"w.{x}" for x in shorts))


def flat_survivors(survivors: DataFrame, bundles: Sequence[Bundle], key: str = "group_key") -> DataFrame:
    """One plain row per group: ``key, n_rows`` and the fields of all bundles."""
    fields = [F.col(f"{b.name}.`{f}`").alias(f) for b in bundles for f in b.fields]
    return survivors.select(F.col("group_key").alias(key), "n_rows", *fields)


def duplicate_classes(found: Representatives) -> DataFrame:
    """One row ``(row_key, class_id, n_links)`` per row of a group of several: the group's smallest row and the number of its other rows."""
    rows = found.duplicates.distinct()
    per_group = rows.groupBy("group_key").agg(F.min("row_key").alias("class_id"), F.count("*").alias("n"))
    classes = per_group.where("n > 1").join(found.merged.select("group_key"), "group_key")
    joined = join_skewed(rows, classes, "group_key", F.col("n") > HOT_ROWS) if found.any_hot else rows.join(classes, "group_key")
    return joined.select("row_key", "class_id", (F.col("n") - 1).alias("n_links"))


def duplicate_pairs(found: Representatives) -> DataFrame:
    """All pairs ``row_a < row_b`` of the rows that one survivor stands for.

    A group of many rows is cut into parts of about PAIRED_ROWS, each of which meets all rows of
    its group in a task of its own.
    """
    parts = F.ceil(F.col("n_links") / F.lit(float(PAIRED_ROWS))).cast("int")
    classes = cut_lineage(duplicate_classes(found))
    a = classes.select("class_id", F.pmod(F.xxhash64("row_key"), parts).cast("int").alias("part"), F.col("row_key").alias("row_a"))
    b = classes.select("class_id", F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), F.col("row_key").alias("row_b"))
    return a.join(b, ["class_id", "part"]).where(F.col("row_a") < F.col("row_b")).select("row_a", "row_b")


def resolve_by_name(df: DataFrame, identity: Column, name: Column, out: str = "resolved") -> DataFrame:
    """Adds ``out``: the identity, or where it is missing the one that its name mostly has elsewhere.

    Names are compared without outer white space and case; between equally frequent
    identities the smaller is taken; a name never seen with an identity gives null.
    """
    named = df.withColumns({"__identity": identity, "__name": F.lower(F.trim(name))})
    counts = named.where(F.col("__identity").isNotNull() & (F.col("__name") != "")).groupBy("__name", "__identity").agg(F.count("*").alias("__n"))
    meaning = counts.groupBy("__name").agg(F.min(F.struct((-F.col("__n")).alias("n"), F.col("__identity").alias("i"))).alias("__m")).select(F.col("__name").alias("__known"), F.col("__m.i").alias("__by_name"))
    has = named.where(F.col("__identity").isNotNull()).withColumn(out, F.col("__identity"))
    lacks = named.where(F.col("__identity").isNull()).join(meaning, F.col("__name") == F.col("__known"), "left").withColumn(out, F.col("__by_name")).drop("__known", "__by_name")
    return has.unionByName(lacks).drop("__identity", "__name")
