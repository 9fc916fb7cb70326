"""Reproducible sample, stable as data grows: stratified hash thresholds that are only ever raised."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.operators.relational import join_skewed, small_enough

#: Rate of a stratum that has none of its own.
DEFAULT_RATE = 0.1
#: Most strata whose thresholds are broadcast; more are joined, few hot strata apart.
BROADCAST_STRATA, HOT_STRATA = 10_000, 1000
#: Hex digits of the hash that make the number; 13 fill a double's 52 bits.
DIGITS = 13


def unit_hash(key: Column, salt: str) -> Column:
    """A number in [0, 1) that depends only on the salt and the key (52 bits of md5)."""
    head = F.substring(F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")).cast("binary")), 1, DIGITS)
    return F.conv(head, 16, 10).cast("bigint") / F.lit(float(16**DIGITS))


def rate_table(spark: SparkSession, rates: Mapping[str, float]) -> DataFrame:
    """``(stratum, threshold)`` of rates between 0 and 1."""
    if any(not 0 <= r <= 1 for r in rates.values()):
        raise ValueError("rates are between 0 and 1")
    return spark.createDataFrame(sorted((k, float(v)) for k, v in rates.items()), "stratum string, threshold double")


def raised(stored: DataFrame | None, now: DataFrame) -> DataFrame:
    """``(stratum, before, threshold)`` for this release: of each stratum the higher of the stored and the wanted threshold.

    Store ``stratum, threshold`` of it for the next release. ``before`` is null for a stratum that
    was not stored; a stored one that is wanted no more keeps its threshold; a stratum in
    several rows has its highest.
    """
    wanted = now.groupBy("stratum").agg(F.max("threshold").alias("now"))
    if stored is None:
        return wanted.select("stratum", F.lit(None).cast("double").alias("before"), F.col("now").alias("threshold"))
    earlier = stored.groupBy("stratum").agg(F.max("threshold").alias("before"))
    return wanted.join(earlier, "stratum", "full_outer").select("stratum", "before", F.greatest("now", "before").alias("threshold"))


def stable_sample(
    rows: DataFrame,
    key: Column,
    earlier: Column,
    current: Column,
    thresholds: DataFrame,
    salt: str = "sample",
    default_rate: float = DEFAULT_RATE,
) -> DataFrame:
    """One row per key: whether it is sampled, and whether what was chosen for it before is still chosen.

    ``earlier`` and ``current`` are arrays of the strata that a row names for an earlier and for
    the current release; a null among them, and a row without any, count with ``default_rate``.
    ``thresholds`` is what ``raised`` gives. A key is sampled if its salted hash is below the
    highest threshold of its strata, so neither order, partitioning nor other keys matter,
    and a further row or a raised threshold can only add keys. It was chosen in an earlier
    stratum if the hash was below the threshold stored before (the present one, if none was
    stored), and is chosen in a current one by the present threshold; a choice is not kept if
    one of the earlier differs from one of the current (``kept`` is null without both).
    Beside the choices of the sample, two faults are told of every key: ``moved``, if a stratum
    named for an earlier release differs from one named for the current, sampled or not, and
    ``lost``, if the key was chosen earlier and is not sampled now, which thresholds that were
    not raised give.

    Result: ``sample_key, unit, threshold, sampled, earlier, current, kept, moved, lost``. Rows without key
    are left out; strata without threshold use ``default_rate``; repeated rows change nothing;
    empty input gives an empty result; no column is carried, so none can clash. One aggregation
    with map-side combining, in which a key keeps its distinct strata; the hash is computed once a key.
    """
    if not 0 <= default_rate <= 1:
        raise ValueError("rates are between 0 and 1")

    def named(strata: Column, is_earlier: bool) -> Column:
        return F.transform(F.coalesce(strata, F.array().cast("array<string>")), lambda s: F.struct(s.alias("stratum"), F.lit(is_earlier).alias("earlier")))

    both = F.concat(named(earlier, True), named(current, False))
    nothing = F.array(F.struct(F.lit(None).cast("string").alias("stratum"), F.lit(False).alias("earlier")))
    long = (
        rows.select(key.cast("string").alias("sample_key"), F.explode(F.when(F.size(both) > 0, both).otherwise(nothing)).alias("c"))
        .select("sample_key", "c.stratum", "c.earlier")
        .where(F.col("sample_key").isNotNull())
    )
    if small_enough(thresholds, BROADCAST_STRATA):
        levels = long.join(F.broadcast(thresholds), "stratum", "left")
    else:
        sizes = long.groupBy("stratum").agg(F.count("*").alias("n")).where(F.col("stratum").isNotNull())
        everything = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
        per_stratum = sizes.join(thresholds, "stratum", "left")
        levels = join_skewed(long, per_stratum, "stratum", F.col("n") * HOT_STRATA > everything).drop("n", "is_hot")
        levels = levels.unionByName(long.where(F.col("stratum").isNull()).withColumns({"before": F.lit(None).cast("double"), "threshold": F.lit(None).cast("double")}))
    rate = F.lit(float(default_rate))
    choice = F.struct("stratum", F.coalesce(F.when(F.col("earlier"), F.col("before")), "threshold", rate).alias("t"))
    known = F.col("stratum").isNotNull()
    per_key = levels.groupBy("sample_key").agg(
        F.max(F.coalesce("threshold", rate)).alias("threshold"),
        F.collect_set(F.when(known & F.col("earlier"), choice)).alias("e"),
        F.collect_set(F.when(known & ~F.col("earlier"), choice)).alias("c"),
    )
    per_key = per_key.withColumn("unit", unit_hash(F.col("sample_key"), salt))

    def chosen(choices: str) -> Column:
        return F.array_sort(F.transform(F.filter(choices, lambda x: F.col("unit") < x["t"]), lambda x: x["stratum"])).alias({"e": "earlier", "c": "current"}[choices])

    strata = F.array_union(F.transform("e", lambda x: x["stratum"]), F.transform("c", lambda x: x["stratum"]))
    moved = (F.size("e") > 0) & (F.size("c") > 0) & (F.size(strata) > 1)
    out = per_key.select("sample_key", "unit", "threshold", (F.col("unit") < F.col("threshold")).alias("sampled"), chosen("e"), chosen("c"), moved.alias("moved"))
    told = (F.size("earlier") > 0) & (F.size("current") > 0)
    kept = F.when(told, F.size(F.array_union("earlier", "current")) == 1)
    return out.select("sample_key", "unit", "threshold", "sampled", "earlier", "current", kept.alias("kept"), "moved", ((F.size("earlier") > 0) & ~F.col("sampled")).alias("lost"))
