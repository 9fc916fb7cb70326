"""Cell, patient, ontology and location annotations joined onto a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.functions.scalars import (
    INTENSITY_CODES,
    QUANTITY_CODES,
    STAINING_CODES,
    filled,
    location_code,
    ordinal_code,
    sorted_join,
)
from slidemill.operators.relational import keep_first, pick

SAMPLE_KEY = ("antibody_id", "ensembl_id", "tissue")
CARRIED = ("image_id", *SAMPLE_KEY, "gene_name", "organ", "patient_id")
SPLIT_COLUMNS = ("set", "set_v1", "split_version")
# Columns of the location table and their names in the result.
LOCATION_COLUMNS = {
    "Reliability": "subcellular_reliability",
    "Main location": "subcellular_main_location",
    "Additional location": "subcellular_additional_location",
    "Enhanced": "subcellular_enhanced",
    "Supported": "subcellular_supported",
    "Approved": "subcellular_approved",
    "Uncertain": "subcellular_uncertain",
}


def distinct_first(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Exact repeats are removed (all columns but ``order``), then the first row per key is kept."""
    values = [c for c in df.columns if c != order]
    whole = df.groupBy(*values).agg(F.min(order).alias(order))
    return keep_first(whole, key, [order]).drop(order)


def key_conflicts(df: DataFrame, key: Sequence[str], order: str) -> DataFrame:
    """Keys with several different rows."""
    values = [c for c in df.columns if c != order]
    return df.select(*values).distinct().groupBy(*key).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def cell_annotations(dataset: DataFrame, cells: DataFrame, order: str = "row_id", key: Sequence[str] = SAMPLE_KEY) -> DataFrame:
    """One row per image and cell type of its sample, with ordinal codes. Images without cells have none."""
    kept = [c for c in (*CARRIED, *SPLIT_COLUMNS) if c in dataset.columns]
    fields = ["cell_type", "staining", "intensity", "quantity", "location"]
    unique = distinct_first(cells.select(*key, *fields, order), [*key, "cell_type"], order)
    return dataset.select(*kept).join(unique, list(key)).select(
        *kept,
        *fields,
        ordinal_code(F.col("staining"), STAINING_CODES).alias("staining_code"),
        ordinal_code(F.col("intensity"), INTENSITY_CODES).alias("intensity_code"),
        ordinal_code(F.col("quantity"), QUANTITY_CODES).alias("quantity_code"),
        location_code(F.col("location")).alias("location_code"),
    )


def ontology_terms(tissues: DataFrame, key: Sequence[str] = SAMPLE_KEY) -> DataFrame:
    """The distinct non-empty terms of a sample, sorted and joined."""
    terms = F.collect_set(F.when(F.col("ontology_terms") != "", F.col("ontology_terms")))
    return tissues.groupBy(*key).agg(sorted_join(terms).alias("ontology_terms"))


def cells_per_sample(cells: DataFrame, order: str = "row_id", key: Sequence[str] = SAMPLE_KEY) -> DataFrame:
    """The number and names of a sample's cell types and its highest codes; all images of a sample have the same."""
    codes = {"staining": STAINING_CODES, "intensity": INTENSITY_CODES, "quantity": QUANTITY_CODES}
    unique = distinct_first(cells.select(*key, "cell_type", *codes, *(["location"] if "location" in cells.columns else []), order), [*key, "cell_type"], order)
    return unique.groupBy(*key).agg(
        F.count(F.lit(1)).cast("int").alias("n_cell_types"),
        sorted_join(F.collect_list("cell_type")).alias("cell_types"),
        *(F.max(ordinal_code(F.col(c), values)).alias(f"max_{c}_code") for c, values in codes.items()),
    )


def image_annotations(dataset: DataFrame, cells: DataFrame, patients: DataFrame | None, tissues: DataFrame, order: str = "row_id") -> DataFrame:
    """One row per image: patient, ontology and cell aggregates, with defaults where there is nothing.

    Cells are aggregated by sample, so an image is joined to one row of them.
    """
    out = pick(dataset, CARRIED, SPLIT_COLUMNS)
    if patients is not None:
        key = [*SAMPLE_KEY, "patient_id"]
        out = out.join(distinct_first(patients.select(*key, "sex", "age", order), key, order), key, "left")
        out = out.withColumns({c: filled(F.col(c)) for c in ("sex", "age")})
    out = out.join(ontology_terms(tissues), list(SAMPLE_KEY), "left").join(cells_per_sample(cells, order), list(SAMPLE_KEY), "left")
    return out.withColumns({
        "ontology_terms": filled(F.col("ontology_terms")),
        "n_cell_types": filled(F.col("n_cell_types"), 0),
        "cell_types": filled(F.col("cell_types")),
        **{f"max_{c}_code": filled(F.col(f"max_{c}_code"), -1) for c in ("staining", "intensity", "quantity")},
        "protein_detected": filled(F.col("max_staining_code"), -1) > 0,
    })


def cell_vocabulary(annotations: DataFrame) -> DataFrame:
    """Cell types with their numbers of images, antibodies and tissues."""
    return annotations.groupBy("cell_type").agg(
        F.countDistinct("image_id").alias("n_images"),
        F.countDistinct("antibody_id").alias("n_antibodies"),
        F.countDistinct("tissue").alias("n_tissues"),
        sorted_join(F.collect_set("tissue")).alias("tissues"),
    )


def attach_locations(images: DataFrame, locations: DataFrame, gene: str = "ensembl_id") -> DataFrame:
    """Adds the location columns of the image's gene; empty without an entry."""
    named = locations.withColumnsRenamed(LOCATION_COLUMNS).select(F.col("Gene").alias("__gene"), *LOCATION_COLUMNS.values())
    joined = images.join(keep_first(named, ["__gene"], list(LOCATION_COLUMNS.values())), F.col(gene) == F.col("__gene"), "left").drop("__gene")
    return joined.withColumns({c: filled(F.col(c)) for c in LOCATION_COLUMNS.values()})


def location_vocabulary(images: DataFrame, gene: str = "ensembl_id", main: str = "subcellular_main_location", additional: str = "subcellular_additional_location") -> DataFrame:
    """Locations with their genes and images, as main and as any location."""
    parts = [
        images.where(F.col(c) != "").select("image_id", gene, F.explode(F.split(c, ";")).alias("location"), F.lit(is_main).alias("is_main"))
        for c, is_main in ((main, True), (additional, False))
    ]
    rows = parts[0].unionByName(parts[1])
    on_main = {c: F.when(F.col("is_main"), F.col(c)) for c in (gene, "image_id")}
    return rows.groupBy("location").agg(
        F.countDistinct(on_main[gene]).alias("n_genes_main"),
        F.countDistinct(gene).alias("n_genes_any"),
        F.countDistinct(on_main["image_id"]).alias("n_images_main"),
        F.countDistinct("image_id").alias("n_images_any"),
    )


def coverage(df: DataFrame, column: str, gene: str = "ensembl_id") -> DataFrame:
    """Rows and genes with and without a non-empty value."""
    has = filled(F.col(column).cast("string")) != ""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(has.cast("int")).alias("n_filled"),
        F.countDistinct(gene).alias("n_genes"),
        F.countDistinct(F.when(has, F.col(gene))).alias("n_genes_filled"),
    )
