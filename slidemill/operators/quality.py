"""Data-quality checks of a split dataset, as frames of ``(dataset, check, ok, detail)``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slidemill.functions.scalars import filled, id_prefix
from slidemill.operators.split import SETS, antibody_strata

TISSUE_TOLERANCE, STRATA_TOLERANCE, YEAR_DISTANCE = 0.01, 0.015, 0.10


def share_by_index(df: DataFrame, index: str = "tissue", column: str = "set", values: Sequence[str] = SETS) -> DataFrame:
    """``(index, column, share)``: the share of each value among all rows of the index; 0 where it lacks."""
    shares = [F.struct(F.lit(v).alias(column), (F.sum((F.col(column) == v).cast("int")) / F.count(F.lit(1))).alias("share")) for v in values]
    wide = df.groupBy(index).agg(F.array(*shares).alias("s"))
    return wide.select(index, F.explode("s").alias("s")).select(index, f"s.{column}", F.coalesce("s.share", F.lit(0.0)).alias("share"))


def share_by_column(df: DataFrame, index: Column, column: str = "set") -> DataFrame:
    """``(stratum, column, share)``: the share of each stratum within a value of the column."""
    counts = df.groupBy(index.alias("stratum"), column).agg(F.count(F.lit(1)).alias("n"))
    return counts.select("stratum", column, (F.col("n") / F.sum("n").over(Window.partitionBy(column))).alias("share"))


def largest_deviation(shares: DataFrame, index: str, column: str, target: Column) -> DataFrame:
    """The index and value whose share is furthest from the target, with the signed deviation."""
    deviation = F.col("share") - target
    return shares.agg(
        F.max_by(F.struct(F.col(index).alias("worst_index"), F.col(column).alias("worst_value"), deviation.alias("deviation")), F.struct(F.round(F.abs(deviation), 9), F.col(index), F.col(column))).alias("w")
    ).select("w.worst_index", "w.worst_value", "w.deviation")


def target_share(column: str, fractions: Sequence[float]) -> Column:
    out = F.lit(None).cast("double")
    for name, f in zip(SETS, fractions):
        out = F.when(F.col(column) == name, F.lit(float(f))).otherwise(out)
    return out


def variation_distance(df: DataFrame, value: Column, column: str = "set", first: str = "train", second: str = "val") -> DataFrame:
    """Half the summed difference of the value's shares in two sets; null values drop out, empty ones count."""
    rows = df.select(value.alias("v"), F.col(column).alias("s")).where(F.col("v").isNotNull() & F.col("s").isin(first, second))
    every = Window.partitionBy(F.lit(0))
    counts = rows.groupBy("v").agg(*(F.sum((F.col("s") == s).cast("int")).alias(a) for a, s in (("p", first), ("q", second))))
    shares = counts.select(*(F.coalesce(F.try_divide(F.col(c), F.sum(c).over(every)), F.lit(0.0)).alias(c) for c in ("p", "q")))
    return shares.agg((F.coalesce(F.sum(F.abs(F.col("p") - F.col("q"))), F.lit(0.0)) * 0.5).alias("distance"))


def year_share(df: DataFrame, value: Column, years: Sequence[str], column: str = "set") -> DataFrame:
    """``(column, percent)``: the percentage of each set's rows whose value is one of the years; a missing value is none of them."""
    return df.groupBy(column).agg((F.avg(F.coalesce(value.isin(list(years)), F.lit(False)).cast("int")) * 100).alias("percent"))


def disjoint_check(df: DataFrame, key: str, column: str = "set") -> DataFrame:
    """Keys in several sets."""
    return df.groupBy(key).agg(F.countDistinct(column).alias("n_sets")).agg(F.sum((F.col("n_sets") > 1).cast("int")).alias("n_shared"))


def check_dataset(
    name: str,
    df: DataFrame,
    fractions: Sequence[float] = (0.7, 0.1, 0.2),
    tissue_tolerance: float = TISSUE_TOLERANCE,
    strata_tolerance: float = STRATA_TOLERANCE,
    stained: str | None = None,
    year_distance: float = YEAR_DISTANCE,
) -> DataFrame:
    """Six checks, seven with the column ``stained`` of dates."""
    bad = df.agg(F.sum((~filled(F.col("set")).isin(*SETS)).cast("int")).alias("n"))
    present = df.where(F.col("set").isin(*SETS)).agg(F.countDistinct("set").alias("n"))
    out = [
        bad.select(F.lit("valid set").alias("check"), (filled(F.col("n"), 0) == 0).alias("ok"), F.format_string("%d rows without valid set", filled(F.col("n"), 0)).alias("detail")),
        present.select(F.lit("all sets present"), F.col("n") == len(SETS), F.format_string("%d sets", "n")),
    ]
    for key, what in (("antibody_id", "antibodies disjoint"), ("ensembl_id", "genes disjoint")):
        shared = disjoint_check(df, key)
        out.append(shared.select(F.lit(what), filled(F.col("n_shared"), 0) == 0, F.format_string("%d in several sets", filled(F.col("n_shared"), 0))))
    tissue = largest_deviation(share_by_index(df), "tissue", "set", target_share("set", fractions))
    worst = F.format_string("%s in %s: %+.2f pt", "worst_index", "worst_value", F.col("deviation") * 100)
    out.append(tissue.select(F.lit("tissue shares"), F.abs("deviation") <= tissue_tolerance, worst))
    strata = df.select("antibody_id", "set").distinct().join(antibody_strata(df), "antibody_id")
    deviations = []
    for index in (F.col("stratum"), id_prefix(F.col("antibody_id"))):
        overall = strata.groupBy(index.alias("stratum")).agg((F.count(F.lit(1))).alias("n"))
        overall = overall.select("stratum", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias("whole"))
        joined = share_by_column(strata, index).join(overall, "stratum")
        deviations.append(largest_deviation(joined, "stratum", "set", F.col("whole")))
    joint = deviations[0].unionByName(deviations[1]).agg(F.max_by(F.struct("worst_index", "worst_value", "deviation"), F.abs("deviation")).alias("w")).select("w.*")
    out.append(joint.select(F.lit("strata and source shares"), F.abs("deviation") <= strata_tolerance, worst))
    if stained is not None:
        year = F.substring(stained, 1, 4)
        far = reduce(DataFrame.union, (variation_distance(df, year, "set", "train", other) for other in SETS[1:])).agg(F.max("distance").alias("distance"))
        out.append(far.select(F.lit("staining years"), F.col("distance") <= year_distance, F.format_string("distance %.3f", "distance")))
    return reduce(DataFrame.union, out).select(F.lit(name).alias("dataset"), "check", "ok", "detail")


def gene_agreement(frames: dict[str, DataFrame]) -> DataFrame:
    """Per pair of datasets: genes in both, and those in different sets."""
    rows = reduce(DataFrame.unionByName, (df.select(F.lit(n).alias("dataset"), "ensembl_id", "set").distinct() for n, df in frames.items()))
    per_gene = rows.groupBy("dataset", "ensembl_id").agg(F.min("set").alias("set"))
    a, b = per_gene.toDF("dataset_a", "ensembl_id", "set_a"), per_gene.toDF("dataset_b", "ensembl_id", "set_b")
    return a.join(b, "ensembl_id").where("dataset_a < dataset_b").groupBy("dataset_a", "dataset_b").agg(
        F.count(F.lit(1)).alias("n_shared"), F.sum((F.col("set_a") != F.col("set_b")).cast("int")).alias("n_different")
    )


def missing_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(field, n_missing)`` of null or empty values."""
    cells = F.array(*(F.struct(F.lit(c).alias("field"), F.sum((filled(F.col(f"`{c}`").cast("string")) == "").cast("int")).alias("n_missing")) for c in columns))
    return df.agg(cells.alias("c")).select(F.explode("c").alias("c")).select("c.field", F.coalesce("c.n_missing", F.lit(0)).alias("n_missing"))


def verify_files(expected: DataFrame, files: DataFrame, path: str = "path") -> DataFrame:
    """``(path, status)``: ok, missing or corrupt; ``files`` has path and ``valid``."""
    found = files.select(F.col(path).alias("__path"), "valid")
    status = F.when(F.col("__path").isNull(), "missing").when(F.col("valid"), "ok").otherwise("corrupt")
    return expected.join(found, F.col(path) == F.col("__path"), "left").select(path, status.alias("status"))
