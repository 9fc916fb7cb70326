"""Stratified train/val/test assignment of whole antibodies, with inheritance of earlier labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slidemill.functions.scalars import filled, id_number, id_source
from slidemill.functions.seeded import seeded_key
from slidemill.operators.relational import keep_first
from slidemill.session import cut_lineage

SETS = ("train", "val", "test")
ERA_BINS, LEAST_STRATUM = 5, 10


def antibody_strata(ids: DataFrame, column: str = "antibody_id", n_bins: int = ERA_BINS, least: int = LEAST_STRATUM) -> DataFrame:
    """``(id, stratum)``: source letters and quantile bin of the number's rank within the source.

    A bin is the ceiling of (rank-1)*k/(n-1) less one, at least 0, with k = min(n_bins, max(1, n // 10)).
    Strata under ``least`` fall back to their source, then to ``all``, then to the largest stratum
    (ties by name), with sizes counted again at each level.
    """
    source = Window.partitionBy("source")
    n, rn = F.count(F.lit(1)).over(source), F.row_number().over(source.orderBy("number", column))
    bins = F.least(F.lit(n_bins), F.greatest(F.lit(1), F.floor(n / F.lit(10.0)))).cast("bigint")
    era = F.when(n == 1, F.lit(0)).otherwise(F.greatest(F.lit(0), F.ceil((rn - 1) * bins / F.greatest(n - 1, F.lit(1)).cast("double")) - 1))
    base = ids.select(column).distinct().withColumns({"source": id_source(F.col(column)), "number": id_number(F.col(column))})
    out = base.withColumn("stratum", F.when(F.col("source") == "other", F.lit("other")).otherwise(F.concat_ws("_", "source", era.cast("int").cast("string"))))
    small = F.count(F.lit(1)).over(Window.partitionBy("stratum")) < least
    out = out.withColumn("stratum", F.when(small, F.col("source")).otherwise(F.col("stratum")))
    out = out.withColumn("stratum", F.when(small, F.lit("all")).otherwise(F.col("stratum")))
    sizes = out.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    largest = sizes.agg(F.min_by("stratum", F.struct(-F.col("n"), F.col("stratum")))).scalar()
    return out.withColumn("stratum", F.when(small, F.coalesce(largest, F.col("stratum"))).otherwise(F.col("stratum"))).select(column, "stratum")


def stratified_holdout(ids: DataFrame, size: int, column: str = "antibody_id", seed: int = 42, tag: str = "test") -> DataFrame:
    """Adds ``held`` to ``(id, stratum)``: ``size`` ids taken from the strata in proportion, largest remainders first.

    Unstratified if there is one stratum, a stratum of one id, or fewer ids held or left than strata.
    Reads the ids several times, so they should be stored or cheap.
    """
    order = [seeded_key(seed, F.col(column), tag), F.col(column)]
    strata = ids.groupBy("stratum").agg(F.count(F.lit(1)).alias("c"))
    k, least, n = strata.agg(F.count(F.lit(1)), F.min("c"), F.coalesce(F.sum("c"), F.lit(0))).first()
    if size <= 0 or not n:
        return ids.withColumn("held", F.lit(False))
    if not (k > 1 and least >= 2 and size >= k and n - size >= k):
        taken = ids.orderBy(*order).limit(size).select(F.col(column).alias("__taken"))
        return ids.join(taken, F.col(column) == F.col("__taken"), "left").withColumn("held", F.col("__taken").isNotNull()).drop("__taken")
    share = F.lit(size) * F.col("c")
    every = Window.partitionBy(F.lit(0))  # over the strata, one row each
    quota = strata.withColumns({"base": F.floor(share / F.lit(float(n))).cast("bigint"), "rest": share % F.lit(n)}).withColumns({
        "spare": F.lit(size) - F.sum("base").over(every),
        "place": F.row_number().over(every.orderBy(F.desc("rest"), seeded_key(seed, F.col("stratum"), tag), F.col("stratum"))),
    })
    quota = quota.select("stratum", (F.col("base") + F.when(F.col("place") <= F.col("spare"), 1).otherwise(0)).alias("__quota"))
    ranked = ids.withColumn("__rn", F.row_number().over(Window.partitionBy("stratum").orderBy(*order)))
    return ranked.join(quota, "stratum").withColumn("held", F.col("__rn") <= F.col("__quota")).drop("__rn", "__quota")


def split_antibodies(df: DataFrame, fractions: Sequence[float] = (0.7, 0.1, 0.2), column: str = "antibody_id", seed: int = 42) -> DataFrame:
    """``(antibody, set)`` in the shares train, val, test: test is held out first, then val from the rest.

    Fewer than three antibodies all go to train; val leaves at least one for train. ``df`` is read
    more than once, so it should be stored or cheap; the distinct antibodies are stored.
    """
    if abs(sum(fractions) - 1) > 1e-8:
        raise ValueError("fractions must sum to 1")
    _, val, test = fractions
    ids = cut_lineage(antibody_strata(df.select(column).where(F.col(column).isNotNull()).distinct(), column))
    n = ids.count()
    n_test = round(n * test) if n >= 3 else 0
    tested = cut_lineage(stratified_holdout(ids, n_test, column, seed, "test"))
    rest = tested.where(~F.col("held")).drop("held")
    n_val = min(round(n * val), n - n_test - 1) if n >= 3 else 0
    validated = stratified_holdout(rest, n_val, column, seed, "val")
    name = F.when(F.col("held"), "val").otherwise("train").alias("set")
    return tested.where("held").select(column, F.lit("test").alias("set")).unionByName(validated.select(column, name))


def several_labels(df: DataFrame, key: str, label: str = "set") -> DataFrame:
    """Keys with more than one non-empty label: each is a conflict."""
    return df.where(filled(F.col(label)) != "").groupBy(key).agg(F.countDistinct(label).alias("n_labels")).where("n_labels > 1")


def guard_single_label(df: DataFrame, key: str, label: str = "set") -> DataFrame:
    found = several_labels(df, key, label).orderBy(key).limit(5).collect()
    if found:
        raise RuntimeError(f"{key} in several sets: {', '.join(str(r[key]) for r in found)}")
    return df


def check_split_version(df: DataFrame, expected: str = "v2", allow_legacy: bool = False) -> bool:
    """Whether every row has the expected split version; raises otherwise unless legacy files are allowed."""
    if "split_version" not in df.columns:
        versions: list[str] = [""]
    else:
        versions = [r[0] or "" for r in df.select("split_version").distinct().limit(5).collect()]
    if versions == [expected]:
        return True
    if not allow_legacy:
        raise ValueError(f"split versions {sorted(versions)}, expected {expected}")
    return False


def inherit_labels(df: DataFrame, earlier: DataFrame, image: str = "image_id", antibody: str = "antibody_id", gene: str = "ensembl_id", check: bool = True) -> DataFrame:
    """Adds ``set`` out of an earlier file: by image, then by the antibody and then by the gene of rows labelled so far.

    Each level fills only rows still without label. With ``check``, an image, antibody or gene with
    several labels raises, and so does a row here or there without gene, where the earlier file has
    genes. A level whose column the earlier file lacks is taken from the rows labelled here.
    """
    known = earlier.where(F.col("set").isin(*SETS))
    if check:
        guard_single_label(known, image)
        if gene in earlier.columns and gene in df.columns:
            blank = filled(F.col(gene)) == ""
            if df.where(blank).select(gene).unionByName(earlier.where(blank).select(gene)).limit(1).count():
                raise ValueError(f"empty {gene}: labels are inherited by gene, so every row needs one")
    by_image = known.groupBy(F.col(image)).agg(F.min("set").alias("__image"))
    out = df.drop("set").join(by_image, image, "left").withColumn("set", filled(F.col("__image"))).drop("__image")
    for key in (antibody, gene):
        if key not in out.columns:
            continue
        labelled = out.where((F.col("set") != "") & (filled(F.col(key)) != ""))
        if check:
            guard_single_label(labelled, key)
        by_key = labelled.groupBy(key).agg(F.min("set").alias("__label"))
        out = out.join(by_key, key, "left").withColumn("set", F.when(F.col("set") == "", filled(F.col("__label"))).otherwise(F.col("set"))).drop("__label")
    return out


def assign_sets(df: DataFrame, fractions: Sequence[float] = (0.7, 0.1, 0.2), seed: int = 42, earlier: DataFrame | None = None, version: str = "v2") -> DataFrame:
    """Adds ``set`` and ``split_version``: inherited labels first, the other antibodies split afresh."""
    if earlier is None:
        # an antibody in two sets would be a fault of the split; it raises where it is read
        one = F.when(F.min("set") == F.max("set"), F.min("set")).otherwise(F.raise_error(F.concat(F.lit("antibody in several sets: "), F.col("antibody_id"))))
        sets = split_antibodies(df, fractions, seed=seed).groupBy("antibody_id").agg(one.alias("set"))
        labelled = df.drop("set").join(sets, "antibody_id", "left")
    else:
        inherited = inherit_labels(df, earlier)
        todo = inherited.groupBy("antibody_id").agg(F.max("set").alias("__had")).where("__had = ''").select("antibody_id")
        fresh = split_antibodies(todo, fractions, seed=seed).withColumnRenamed("set", "__fresh")
        labelled = inherited.join(fresh, "antibody_id", "left").withColumn("set", F.when(F.col("set") == "", filled(F.col("__fresh"))).otherwise(F.col("set"))).drop("__fresh")
        guard_single_label(labelled, "antibody_id")
    return labelled.withColumn("split_version", F.lit(version))


def attach_legacy_set(df: DataFrame, earlier: DataFrame, order: str, image: str = "image_id") -> DataFrame:
    """Adds ``set_v1``, the label of the image's first row in an earlier file, empty if it has none."""
    first = keep_first(earlier.select(image, "set", order), [image], [order]).select(image, F.col("set").alias("set_v1"))
    return df.drop("set_v1").join(first, image, "left").withColumn("set_v1", filled(F.col("set_v1")))
