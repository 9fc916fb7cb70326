"""Lookups, filters, deduplication and per-group choices with explicit order."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slidemill.functions.scalars import filled
from slidemill.functions.seeded import seeded_key

#: Rows of a lookup side that are still broadcast.
BROADCAST_ROWS = 200_000


def pick(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """The required columns in order, then the optional ones that exist."""
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise KeyError(f"missing columns: {lacking}")
    return df.select(*(f"`{c}`" for c in [*required, *(c for c in optional if c in df.columns)]))


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    lacking = [c for c in required if c not in df.columns]
    if lacking:
        raise ValueError(f"missing columns: {', '.join(lacking)}")
    return df


def small_enough(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Whether a side has at most ``rows`` rows; reads no more than that."""
    return df.limit(rows + 1).count() <= rows


def join_skewed(rows: DataFrame, per_key: DataFrame, key: str, hot: Column) -> DataFrame:
    """Inner join of skewed rows with a frame that has one row per key.

    The keys for which ``hot`` (a condition on ``per_key``) holds must be few by construction, as
    those with more than a fixed share of all rows are. Their rows are joined where they are, by
    broadcast; only the other rows are shuffled. The result tells the parts apart by ``is_hot``.
    """
    few = per_key.where(hot)
    here = rows.join(F.broadcast(few), key).withColumn("is_hot", F.lit(True))
    rest = rows.join(F.broadcast(few.select(key)), key, "left_anti").join(per_key.where(~hot), key)
    return here.unionByName(rest.withColumn("is_hot", F.lit(False)))


def last_per_key(df: DataFrame, keys: Sequence[str], value: str, order: str) -> DataFrame:
    """Keys with the value of their last row in order."""
    return df.groupBy(*keys).agg(F.max_by(value, order).alias(value))


def lookup(left: DataFrame, left_key: str, right: DataFrame, right_key: str, value: str, order: str, out: str, default: str = "") -> DataFrame:
    """Adds ``out``: the value of the last right row with the key, else ``default``."""
    last = right.groupBy(F.col(f"`{right_key}`").alias("__key")).agg(F.max_by(F.col(f"`{value}`"), order).alias(out))
    joined = left.join(last, F.col(f"`{left_key}`") == F.col("__key"), "left").drop("__key")
    return joined.withColumn(out, filled(F.col(out), default))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row of every key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def keep_preferred(df: DataFrame, keys: Sequence[str], preferred: Column, order: str) -> DataFrame:
    """The first preferred row of every key, else its first row; ``position`` is where the key first stood."""
    w = Window.partitionBy(*keys)
    ranked = df.withColumns({
        "position": F.min(order).over(w),
        "__rn": F.row_number().over(w.orderBy(F.when(preferred, 0).otherwise(1), order)),
    })
    return ranked.where("__rn = 1").drop("__rn")


def resolve_duplicates(df: DataFrame, policy: str, key: str = "image_id", tissue: str = "tissue", precedence: Sequence[str] = ("Soft tissue 1",), report: Callable[[DataFrame], object] | None = None) -> DataFrame:
    """Rows with unique keys.

    ``drop`` removes every row of a repeated key; ``prefer`` keeps of it the row of a preferred
    tissue if there is exactly one; ``fail`` raises if a key is repeated, after ``report`` was given
    all rows of repeated keys. Rows without key count as one key. Keys are counted by
    themselves, so no key's rows are brought together; only repeated keys are joined back.
    """
    if policy not in ("drop", "prefer", "fail"):
        raise ValueError(f"unknown policy {policy!r}")
    if policy == "fail":
        if repeated := df.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").orderBy(key).limit(1).collect():
            if report:
                report(duplicate_report(df, key, [key, tissue]))
            raise ValueError(f"repeated {key}: {repeated[0][key]}")
        return df
    preferred = F.coalesce(F.col(tissue).isin(list(precedence)), F.lit(False))
    counts = [F.count(F.lit(1)).alias("__n"), F.sum(preferred.cast("int")).alias("__p")]
    repeated = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(*counts).where("__n > 1")
    blank = df.where(F.col(key).isNull()).agg(*counts)
    chosen = preferred if policy == "prefer" else F.lit(False)
    kept = F.col("__n").isNull() | (chosen & (F.col("__p") == 1))
    known = df.where(F.col(key).isNotNull()).join(repeated, F.col(key) == F.col("__key"), "left").where(kept).drop("__key", "__n", "__p")
    alone, one = blank.select(F.col("__n") == 1).scalar(), blank.select(F.coalesce(F.col("__p"), F.lit(0)) == 1).scalar()
    return known.unionByName(df.where(F.col(key).isNull()).where(alone | (chosen & one)))


def duplicate_report(df: DataFrame, key: str = "image_id", order: Sequence[str] = ("image_id", "tissue")) -> DataFrame:
    """All rows of repeated keys, in order; rows without key count as one key."""
    repeated = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    return df.join(repeated, F.col(key).eqNullSafe(F.col("__key")), "left_semi").orderBy(*order)


def best_per_group(df: DataFrame, group: Sequence[str], rank: Column, key: str, seed: int) -> DataFrame:
    """The row of the highest rank per group; ties in seeded order of the key, then by the key."""
    w = Window.partitionBy(*group).orderBy(rank.desc(), seeded_key(seed, F.col(key)), F.col(key))
    return df.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def first_n(df: DataFrame, group: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= n).drop("__rn")


def multi_target(antibodies: DataFrame, antibody: str = "antibody_id", gene: str = "ensembl_id") -> DataFrame:
    """Antibodies with more than one gene."""
    return antibodies.groupBy(antibody).agg(F.countDistinct(gene).alias("n_genes")).where("n_genes > 1")


def unknown_values(df: DataFrame, column: str, allowed: Sequence[str]) -> list[str]:
    """Up to 20 values outside the allowed ones, in order."""
    rows = df.select(F.col(f"`{column}`").alias("v")).where(~F.coalesce(F.col("v"), F.lit("")).isin(list(allowed))).distinct().orderBy("v").limit(20).collect()
    return [r.v for r in rows]


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """``(value, n, share)`` of a column."""
    counts = df.groupBy(F.col(f"`{column}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / df.agg(F.count(F.lit(1))).scalar())


def step_counts(df: DataFrame, stage: str, step: str) -> DataFrame:
    """One row of the step log: rows and distinct antibodies, genes and tissues, counted over their few combinations."""
    return df.groupBy("antibody_id", "ensembl_id", "tissue").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("images"),
        F.countDistinct("antibody_id").alias("antibodies"),
        F.countDistinct("ensembl_id").alias("genes"),
        F.countDistinct("tissue").alias("tissues"),
    ).select(F.lit(stage).alias("stage"), F.lit(step).alias("step"), "images", "antibodies", "genes", "tissues")


def group_pairs(df: DataFrame, key: str, value: str, top: int, separator: str = " | ") -> DataFrame:
    """The most frequent sorted combinations of values of repeated keys."""
    combos = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.array_join(F.array_sort(F.collect_list(value)), separator).alias("combination")).where("__n > 1")
    return combos.groupBy("combination").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "combination").limit(top)


def k_per_group(df: DataFrame, group: str, sizes: dict[str, int | None], key: str, seed: int) -> DataFrame:
    """A seeded sample without replacement of each group; None takes all.

    Groups of one size share a plain limit on the rank, which Spark applies before the shuffle.
    """
    w = Window.partitionBy(group).orderBy(seeded_key(seed, F.col(key)), F.col(key))
    parts = [df.where(F.col(group).isin([g for g, k in sizes.items() if k is None]))]
    for size in sorted({k for k in sizes.values() if k is not None}):
        some = df.where(F.col(group).isin([g for g, k in sizes.items() if k == size]))
        parts.append(some.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") <= size).drop("__rn"))
    return reduce(DataFrame.unionByName, parts)
