"""The dataset build: full stage, pilot stage and their step log, as one lazy plan each."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.functions.scalars import filled, mapped, tif_name, whole_number_id
from slidemill.operators.relational import best_per_group, last_per_key, multi_target, pick, resolve_duplicates, step_counts
from slidemill.operators.split import assign_sets, attach_legacy_set
from slidemill.operators.thinning import thin_pairs, thin_triplets
from slidemill.session import cut_lineage

# Fixed values of the build.
SECONDARY_TISSUES = ("Endometrium 2", "Stomach 2", "Soft tissue 2", "Skin 2")
PILOT_TISSUES = (
    "Adrenal gland", "Appendix", "Bone marrow", "Breast", "Caudate", "Cerebellum", "Cerebral cortex", "Colon", "Duodenum",
    "Gallbladder", "Heart muscle", "Hippocampus", "Lung", "Lymph node", "Parathyroid gland", "Seminal vesicle",
    "Small intestine", "Testis", "Tonsil", "Urinary bladder",
)
RELIABILITY_RANK = {"enhanced": 3, "supported": 2, "approved": 1}
UNCERTAIN = "uncertain"
OUTPUT_COLUMNS = (
    "image_id", "antibody_id", "ensembl_id", "gene_name", "tissue", "organ", "patient_id", "image_type",
    "hpa_url", "idr_available", "idr_ftp_path", "idr_url", "local_path", "set", "split_version",
)
OPTIONAL_COLUMNS = ("set_v1",)
#: Address that mirror paths are relative to; given by whoever builds a dataset.
MIRROR_URL = ""


@dataclass
class StepLog:
    """Counts after every step; evaluated together when the frame is read."""

    stage: str
    parts: list[DataFrame] = field(default_factory=list)

    def add(self, step: str, df: DataFrame) -> DataFrame:
        self.parts.append(step_counts(df, self.stage, step).withColumn("position", F.lit(len(self.parts))))
        return df

    def frame(self) -> DataFrame:
        out = self.parts[0]
        for part in self.parts[1:]:
            out = out.unionByName(part)
        return out.orderBy("position").drop("position")


def attach_mirror(images: DataFrame, mirror: DataFrame | None, base_url: str = MIRROR_URL, order: str = "row_id") -> DataFrame:
    """Adds the mirror columns; the image's name with a .tif extension is looked up, the last row wins."""
    if "hpa_url" not in images.columns:
        images = images.withColumnRenamed("image_url", "hpa_url")
    if mirror is None:
        images = images.withColumn("idr_ftp_path", F.lit(""))
    else:
        names = mirror.where(filled(F.col("ftp_path")) != "").select(F.col("`Image Name`").alias("__name"), F.col("ftp_path").alias("idr_ftp_path"), order)
        names = last_per_key(names, ["__name"], "idr_ftp_path", order)
        name = tif_name(F.concat(F.col("image_id"), F.lit(".tif")))
        images = images.drop("idr_ftp_path").join(names, name == F.col("__name"), "left").drop("__name")
    path = filled(F.col("idr_ftp_path"))
    url = F.when(path != "", F.concat(F.lit(base_url), path)).otherwise("")
    return images.withColumns({"idr_available": path != "", "idr_ftp_path": path, "idr_url": url})


def filter_source(df: DataFrame, source: str) -> DataFrame:
    if source == "idr":
        return df.where("idr_available")
    if source == "all":
        return df
    raise ValueError(f"unknown source {source!r}")


def guard_scores(antibodies: DataFrame, score: str = "Reliability score", allowed: Sequence[str] = (*RELIABILITY_RANK, UNCERTAIN)) -> DataFrame:
    """The antibodies; reading a row with a score outside the allowed ones raises."""
    value = F.col(f"`{score}`")
    checked = F.when(value.isin(list(allowed)), value).otherwise(F.raise_error(F.concat(F.lit("unknown reliability score: "), filled(value))))
    return antibodies.withColumn(score, checked)


def filter_antibodies(images: DataFrame, antibodies: DataFrame, seed: int, log: StepLog | None = None) -> DataFrame:
    """Images of the best antibody per gene.

    Uncertain antibodies go first, then those with several genes in the whole table; of the
    antibodies that still have images the best-ranked one per gene is kept.
    """
    note = log.add if log else (lambda _, df: df)
    certain = antibodies.where(filled(F.col("Reliability score")) != UNCERTAIN)
    images = note("no uncertain antibodies", images.join(certain.select("antibody_id"), "antibody_id", "left_semi"))
    images = note("no multi-target antibodies", images.join(multi_target(antibodies).select("antibody_id"), "antibody_id", "left_anti"))
    candidates = certain.join(images.select("antibody_id"), "antibody_id", "left_semi")
    best = best_per_group(candidates, ["ensembl_id"], mapped(F.col("Reliability score"), RELIABILITY_RANK), "antibody_id", seed)
    return note("one antibody per gene", images.join(best.select("antibody_id"), "antibody_id", "left_semi"))


def select_images(
    images: DataFrame,
    antibodies: DataFrame,
    mirror: DataFrame | None,
    source: str = "idr",
    seed: int = 42,
    policy: str = "prefer",
    base_url: str = MIRROR_URL,
    log: StepLog | None = None,
    report: Callable[[DataFrame], object] | None = None,
) -> DataFrame:
    """The images of a dataset, not yet split."""
    note = log.add if log else (lambda _, df: df)
    df = note("crawl", images.withColumn("patient_id", whole_number_id(F.col("patient_id"))))
    df = filter_source(attach_mirror(df, mirror, base_url), source)
    if log:
        df = cut_lineage(df)  # the steps that follow are counted from here
    df = note("source", df)
    df = note("no secondary tissues", df.where(~filled(F.col("tissue")).isin(list(SECONDARY_TISSUES))))
    df = filter_antibodies(df, antibodies, seed, log)
    return note("unique image id", resolve_duplicates(df, policy, report=report))


def build_full(
    selected: DataFrame,
    seed: int = 42,
    fractions: Sequence[float] = (0.7, 0.1, 0.2),
    earlier: DataFrame | None = None,
    set_v1_from: DataFrame | None = None,
) -> DataFrame:
    """The full dataset with labels: every column of ``OUTPUT_COLUMNS`` and the input's own, of what ``select_images`` gives."""
    df = assign_sets(cut_lineage(selected), fractions, seed, earlier)
    return df if set_v1_from is None else attach_legacy_set(df, set_v1_from, "row_id")


def build_pilot(
    selected: DataFrame,
    tissues: Sequence[str],
    seed: int = 42,
    fractions: Sequence[float] = (0.7, 0.1, 0.2),
    drop_probability: float = 0.4,
    exclude: DataFrame | None = None,
    earlier: DataFrame | None = None,
    log: StepLog | None = None,
) -> DataFrame:
    """The pilot subset of the selected images: its tissues, thinned triplets, then pairs, split by itself."""
    note = log.add if log else (lambda _, df: df)
    df = note("pilot tissues", cut_lineage(selected.where(F.col("tissue").isin(list(tissues)))))
    df = note("triplets thinned", thin_triplets(df, seed))
    df = note("pairs thinned", thin_pairs(df, seed, drop_probability))
    if exclude is not None:
        df = note("exclusions", df.join(exclude.select("image_id"), "image_id", "left_anti"))
    return assign_sets(cut_lineage(df.drop("set", "split_version")), fractions, seed, earlier)


def finalize(df: DataFrame) -> DataFrame:
    return pick(df, OUTPUT_COLUMNS, OPTIONAL_COLUMNS)
