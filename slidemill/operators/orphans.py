"""References to records that do not exist, per table and period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most keys that count as heavy; they are the only broadcast.
HEAVY_KEYS = 10_000


def orphan_references(references: DataFrame, targets: DataFrame, heavy_keys: int = HEAVY_KEYS) -> DataFrame:
    """References whose target is missing, arrives in a later period, or is no longer alive.

    ``references`` has ``ref_field, key, period``, one row per reference; ``targets`` has
    ``key, first_period, alive``, one row per record version. The result has one row per
    ``(ref_field, key, period)`` with the number ``n`` of references and the ``reason``
    (missing, later or gone).

    References are first counted per key and period, so a hot key is a few rows before
    any shuffle join. Keys with more than 1/``heavy_keys`` of all references, of which
    there are fewer than ``heavy_keys``, are checked by broadcast; all other keys by a
    shuffled anti-join; both parts are united.

    Null keys refer to nothing and give no row. A null period compares with no period, so
    only missing or dead targets count for it. A target without any period has always
    existed. Repeated rows only raise ``n``. Other columns are not read, so they cannot clash.
    """
    # null keys are dropped by their count: a condition on the key would be pushed to the scan, and
    # the expression that makes the key would be computed twice for every row
    key = F.coalesce(F.col("key"), F.lit("")).alias("key")
    counted = (
        references.select("ref_field", key, "period")
        .groupBy("ref_field", "key", "period")
        .agg(F.count(F.when(F.col("key") != "", 1)).alias("n"))
        .where("n > 0")
    )
    known = targets.select(key, "first_period", "alive").groupBy("key").agg(F.min("first_period").alias("first_period"), F.max("alive").alias("alive"))
    per_key = counted.groupBy("key").agg(F.sum("n").alias("uses"))
    all_uses = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    heavy = per_key.where(F.col("uses") * heavy_keys > all_uses + heavy_keys).select("key")

    def checked(part: DataFrame, present: DataFrame, small: bool) -> DataFrame:
        there = present.withColumn("there", F.lit(True))
        joined = part.join(F.broadcast(there) if small else there, "key", "left")
        reason = (
            F.when(F.col("there").isNull(), "missing")
            .when(~F.col("alive"), "gone")
            .when(F.col("first_period") > F.col("period"), "later")
        )
        return joined.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("ref_field", "key", "period", "n", "reason")

    hot = counted.join(F.broadcast(heavy), "key", "left_semi")
    hot_targets = known.join(F.broadcast(heavy), "key", "left_semi")
    rest = counted.join(F.broadcast(heavy), "key", "left_anti")
    return checked(hot, hot_targets, True).unionByName(checked(rest, known, False))


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Per table field, period and reason: orphan references and the keys they name."""
    return orphans.groupBy("ref_field", "period", "reason").agg(
        F.sum("n").alias("n_references"), F.count("*").alias("n_keys")
    )
