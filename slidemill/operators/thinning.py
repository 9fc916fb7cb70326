"""Thinning of replicate groups in seeded order."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slidemill.functions.seeded import seeded_key, seeded_uniform

GROUP = ("antibody_id", "tissue")


def last_of_groups(df: DataFrame, size: int, seed: int, group: Sequence[str] = GROUP, key: str = "image_id") -> DataFrame:
    """``(*group, key)`` of the last row, in seeded order, of every group of exactly ``size`` rows.

    Groups are counted by themselves first, so only rows of such groups are ranked, however large
    another group is. Null is a value of a group column like any other.
    """
    few = df.groupBy(*group).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") == size).select(*(F.col(c).alias(f"__{c}") for c in group))
    same = reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in group))
    order = F.row_number().over(Window.partitionBy(*group).orderBy(seeded_key(seed, F.col(key)), F.col(key)))
    ranked = df.select(*group, key).join(few, same).select(*group, key).withColumn("__rank", order)
    return ranked.where(F.col("__rank") == size).drop("__rank")


def without(df: DataFrame, lost: DataFrame, group: Sequence[str], key: str) -> DataFrame:
    names = [*group, key]
    other = lost.select(*(F.col(c).alias(f"__{c}") for c in names))
    return df.join(other, reduce(Column.__and__, (F.col(c).eqNullSafe(F.col(f"__{c}")) for c in names)), "left_anti")


def thin_triplets(df: DataFrame, seed: int, group: Sequence[str] = GROUP, key: str = "image_id") -> DataFrame:
    """Groups of exactly three lose the third row of the seeded order. Keys are unique in a group."""
    return without(df, last_of_groups(df, 3, seed, group, key), group, key)


def thin_pairs(df: DataFrame, seed: int, drop_probability: float = 0.4, group: Sequence[str] = GROUP, key: str = "image_id") -> DataFrame:
    """Each group of exactly two loses its second row with the given probability, drawn per group. Keys are unique in a group."""
    draw = seeded_uniform(seed, F.concat_ws("|", *(F.col(c).cast("string") for c in group)), "pair")
    return without(df, last_of_groups(df, 2, seed, group, key).where(draw < drop_probability), group, key)
