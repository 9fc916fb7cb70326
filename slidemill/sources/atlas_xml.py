"""The nested XML release: records split at their end tag, parsed by schema, flattened to the six tables.

The scan stays splittable: the file is read as text with the end tag as line separator,
so a file of any size is parsed by as many tasks as it has splits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.functions.scalars import segment, stem, strip
from slidemill.operators.folders import resolve_folders
from slidemill.operators.relational import keep_first, keep_preferred
from slidemill.sources.files import with_ordinal

NORMAL_CODE = "M-00100"
ENTRY_SCHEMA = """
_url string, name array<string>, synonym array<string>, identifier array<struct<_db: string, _id: string>>,
antibody array<struct<_id: string, tissueExpression: array<struct<_assayType: string,
  verification: array<struct<_VALUE: string, _type: string>>,
  data: array<struct<tissue: struct<_VALUE: string, _organ: string, _ontologyTerms: string>,
    tissueCell: array<struct<cellType: string, level: array<struct<_VALUE: string, _type: string>>, quantity: string, location: string>>,
    patient: array<struct<sex: string, age: string, patientId: string,
      sample: array<struct<snomedParameters: struct<snomed: array<struct<_snomedCode: string>>>,
        assayImage: struct<image: array<struct<imageUrl: string, imageUrlTif: string, _imageType: string>>>>>>>>>>>>>
"""


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    """``(ordinal, entry)``, one row per entry in file order. A malformed entry raises."""
    text = with_ordinal(spark.read.option("lineSep", "</entry>").text(path))
    record = F.regexp_extract("value", r"(?s)(<entry[\s>].*)", 1)
    # an empty record is no record also inside, as filters may be moved behind the parser
    whole = F.when(record != "", F.concat(record, F.lit("</entry>")))
    return parse_entries(text.select("ordinal", whole.alias("record")))


def parse_entries(records: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """``(ordinal, entry)`` of the XML texts ``record``.

    With mode FAILFAST a malformed one raises, with PERMISSIVE it is left out, as are null ones.
    """
    options = {"ignoreSurroundingSpaces": "false", "mode": mode, "attributePrefix": "_", "valueTag": "_VALUE"}
    parsed = records.where("record IS NOT NULL").select("ordinal", F.from_xml("record", ENTRY_SCHEMA, options).alias("entry"))
    return parsed.where("entry._url IS NOT NULL OR entry.antibody IS NOT NULL")


def _last_level(cell: Column, kind: str) -> Column:
    return F.try_element_at(F.filter(cell["level"], lambda x: x["_type"] == kind), F.lit(-1))["_VALUE"]


def _normal(patient: Column) -> Column:
    codes = F.flatten(F.transform(patient["sample"], lambda s: s["snomedParameters"]["snomed"]))
    return F.exists(codes, lambda c: c["_snomedCode"] == NORMAL_CODE)


def antibody_rows(entries: DataFrame) -> DataFrame:
    """One row per kept antibody: gene, reliability, and its tissue blocks with normal patients only.

    Sections of other assays, patients without the normal code, blocks without patients (with
    their cells) and antibodies without blocks drop out before anything is exploded.
    """
    e = F.col("entry")
    ensembl = F.try_element_at(F.filter(e["identifier"], lambda i: i["_db"] == "Ensembl"), F.lit(-1))["_id"]
    gene = F.struct(
        F.coalesce(ensembl, F.when(e["_url"].contains("/"), segment(e["_url"], -1)), F.lit("")).alias("ensembl_id"),
        F.coalesce(F.try_element_at(e["name"], F.lit(1)), F.lit("")).alias("name"),
        F.coalesce(F.filter(e["synonym"], lambda s: s != ""), F.array().cast("array<string>")).alias("synonyms"),
    )
    rows = entries.select("ordinal", gene.alias("gene"), e["antibody"].alias("antibodies"))
    rows = rows.select("ordinal", "gene", F.posexplode("antibodies").alias("antibody_pos", "a"))
    sections = F.filter(F.col("a")["tissueExpression"], lambda t: t["_assayType"] == "tissue")
    blocks = F.flatten(F.transform(sections, lambda t: F.coalesce(t["data"], F.array())))
    verified = F.flatten(F.transform(sections, lambda t: F.coalesce(t["verification"], F.array())))
    valid = F.filter(verified, lambda v: (v["_type"] == "validation") & (strip(v["_VALUE"]) != ""))
    rows = rows.select(
        "ordinal", "gene", "antibody_pos", F.col("a")["_id"].alias("antibody_id"), blocks.alias("blocks"),
        F.coalesce(strip(F.try_element_at(valid, F.lit(-1))["_VALUE"]), F.lit("")).alias("reliability_score"),
    )
    kept = F.transform(F.col("blocks"), lambda b: b.withField("patient", F.filter(b["patient"], _normal)))
    rows = rows.withColumn("blocks", F.filter(kept, lambda b: F.size(b["patient"]) > 0))
    return rows.where(F.size("blocks") > 0)


def atlas_tables(spark: SparkSession, path: str, mirror: DataFrame | None = None) -> dict[str, DataFrame]:
    """The tables genes, antibodies, tissues, cells, patients and images of a release."""
    return tables_of(spark, antibody_rows(read_entries(spark, path)), mirror)


def tables_of(spark: SparkSession, kept: DataFrame, mirror: DataFrame | None = None) -> dict[str, DataFrame]:
    """The six tables of what ``antibody_rows`` keeps."""
    ids = [F.col("antibody_id"), F.col("gene.ensembl_id").alias("ensembl_id")]
    genes = keep_first(kept.where("gene.ensembl_id <> ''").withColumn("ensembl_id", F.col("gene.ensembl_id")), ["ensembl_id"], ["ordinal", "antibody_pos"])
    blocks = kept.select("ordinal", "antibody_pos", *ids, F.col("gene.name").alias("gene_name"), F.posexplode("blocks").alias("block_pos", "b")).withColumns({
        "tissue": F.coalesce(F.col("b.tissue._VALUE"), F.lit("")),
        "organ": F.coalesce(F.col("b.tissue._organ"), F.lit("")),
        "terms": F.coalesce(F.col("b.tissue._ontologyTerms"), F.lit("")),
    })
    cells = blocks.select("antibody_id", "ensembl_id", "tissue", F.explode("b.tissueCell").alias("c"))
    cells = cells.select(
        "antibody_id", "ensembl_id", "tissue", F.col("c.cellType").alias("cell_type"),
        *(_last_level(F.col("c"), k).alias(k) for k in ("staining", "intensity")), "c.quantity", "c.location",
    ).na.fill("")
    patients = blocks.select("*", F.posexplode("b.patient").alias("patient_pos", "p"))
    images = patients.select(
        "antibody_id", "ensembl_id", "gene_name", "tissue", "organ", F.col("terms").alias("ontology_terms"), F.coalesce("p.patientId", F.lit("")).alias("patient_id"),
        F.struct("ordinal", "antibody_pos", "block_pos", "patient_pos").alias("place"),
        F.flatten(F.transform(F.col("p.sample"), lambda s: F.coalesce(s["assayImage"]["image"], F.array()))).alias("all"),
    )
    images = images.select("*", F.posexplode("all").alias("image_pos", "i")).drop("all")
    tif, jpg = (F.coalesce(F.col(c), F.lit("")) for c in ("i.imageUrlTif", "i.imageUrl"))
    images = images.withColumns({
        "image_type": F.when(tif != "", "tif").when(jpg != "", "jpg"),
        "image_url": F.when(tif != "", tif).otherwise(jpg),
        "place": F.struct("place.*", "image_pos"),
    }).where("image_type IS NOT NULL").drop("i", "image_pos")
    images = images.withColumn("image_id", stem(F.col("image_url")))
    images = number_rows(images, "place", "ordinal")
    if mirror is None:
        mirror = spark.createDataFrame([], "image_id string, ftp_path string")
    placed = resolve_folders(images, mirror, "ordinal")
    unique = keep_preferred(placed, ["image_id", "patient_id", "tissue"], F.col("image_type") == "tif", "ordinal")
    return {
        "genes": genes.select("ensembl_id", F.col("gene.name").alias("name"), F.array_join("gene.synonyms", ", ").alias("synonyms")),
        "antibodies": kept.select(*ids, F.col("gene.name").alias("gene_name"), F.col("reliability_score").alias("Reliability score")),
        "tissues": blocks.select("antibody_id", "ensembl_id", "tissue", "organ", F.col("terms").alias("ontology_terms")),
        "cells": cells,
        "patients": patients.select("antibody_id", "ensembl_id", "tissue", F.col("p.patientId").alias("patient_id"), "p.sex", "p.age").na.fill(""),
        "images": unique,
    }


def number_rows(df: DataFrame, order: str, out: str) -> DataFrame:
    """Replaces the order column by a number that grows with it (a sort with consecutive ids per partition)."""
    return df.sort(order).withColumn(out, F.monotonically_increasing_id()).drop(order)


def gene_trees(kept: DataFrame) -> DataFrame:
    """One nested document per gene, of what ``antibody_rows`` keeps: its antibodies in order with their tissues, cells, patients and images.

    Antibodies without gene are left out. The name and synonyms are those of the gene's first entry.
    """

    def image(i: Column) -> Column:
        tif = F.coalesce(i["imageUrlTif"], F.lit(""))
        return F.struct(F.when(tif != "", "tif").otherwise("jpg").alias("type"), F.when(tif != "", tif).otherwise(i["imageUrl"]).alias("url"))

    def patient(p: Column) -> Column:
        found = F.flatten(F.transform(p["sample"], lambda s: F.coalesce(s["assayImage"]["image"], F.array())))
        told = F.filter(found, lambda i: F.coalesce(F.when(i["imageUrlTif"] != "", i["imageUrlTif"]), i["imageUrl"], F.lit("")) != "")
        return F.struct(p["sex"].alias("sex"), p["age"].alias("age"), p["patientId"].alias("patient_id"), F.transform(told, image).alias("images"))

    def cell(c: Column) -> Column:
        return F.struct(c["cellType"].alias("cell_type"), _last_level(c, "staining").alias("staining"), _last_level(c, "intensity").alias("intensity"), c["quantity"].alias("quantity"), c["location"].alias("location"))

    def block(b: Column) -> Column:
        cells = F.coalesce(b["tissueCell"], F.array())
        return F.struct(b["tissue"]["_VALUE"].alias("tissue"), b["tissue"]["_organ"].alias("organ"), b["tissue"]["_ontologyTerms"].alias("ontology_terms"), F.transform(cells, cell).alias("tissue_cells"), F.transform(b["patient"], patient).alias("patients"))

    own = F.struct(F.col("antibody_id").alias("id"), F.col("gene"), "reliability_score", F.transform("blocks", block).alias("tissues"))
    place = F.struct("ordinal", "antibody_pos")
    docs = kept.where("gene.ensembl_id <> ''").groupBy(F.col("gene.ensembl_id").alias("ensembl_id")).agg(
        F.min_by("gene", place).alias("g"), F.array_sort(F.collect_list(F.struct(place.alias("place"), own.alias("antibody")))).alias("a")
    )
    return docs.select("ensembl_id", "g.name", "g.synonyms", F.transform("a", lambda x: x["antibody"]).alias("antibodies"))


def parse_counts(entries: DataFrame) -> DataFrame:
    """Counters of a release in one row.

    Entries, cancer sections skipped, verifications, tissue blocks seen and cells without location among
    them; kept antibodies, genes, blocks, and images by type with the TIF percentage.
    """
    cancer = F.size(F.filter(F.flatten(F.transform(F.col("entry.antibody"), lambda a: F.coalesce(a["tissueExpression"], F.array()))), lambda t: t["_assayType"] == "cancer"))
    sections = F.flatten(F.transform(F.col("entry.antibody"), lambda a: F.filter(F.coalesce(a["tissueExpression"], F.array()), lambda t: t["_assayType"] == "tissue")))
    verified = F.size(F.flatten(F.transform(sections, lambda t: F.coalesce(t["verification"], F.array()))))
    blocks = F.flatten(F.transform(sections, lambda t: F.coalesce(t["data"], F.array())))
    unplaced = F.size(F.filter(F.flatten(F.transform(blocks, lambda b: F.coalesce(b["tissueCell"], F.array()))), lambda c: F.coalesce(c["location"], F.lit("")) == ""))

    def total(size: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.greatest(size, F.lit(0))), F.lit(0)).alias(name)

    skipped = entries.agg(F.count(F.lit(1)).alias("entries"), total(cancer, "cancer_sections"), total(verified, "verifications"), total(F.size(blocks), "tissues_seen"), total(unplaced, "cells_without_location"))
    patients = F.flatten(F.transform("blocks", lambda b: b["patient"]))
    found = F.flatten(F.transform(patients, lambda p: F.flatten(F.transform(p["sample"], lambda s: F.coalesce(s["assayImage"]["image"], F.array())))))
    is_tif = lambda i: F.coalesce(i["imageUrlTif"], F.lit("")) != ""
    tif, jpg = F.size(F.filter(found, is_tif)), F.size(F.filter(found, lambda i: ~is_tif(i) & (F.coalesce(i["imageUrl"], F.lit("")) != "")))
    kept = antibody_rows(entries).agg(
        F.count(F.lit(1)).alias("antibodies"), F.countDistinct("gene.ensembl_id").alias("genes"),
        F.coalesce(F.sum(F.size("blocks")), F.lit(0)).alias("tissues"), F.coalesce(F.sum((F.col("reliability_score") == "").cast("int")), F.lit(0)).alias("without_reliability"),
        total(tif, "tif_images"), total(jpg, "jpg_images"),
    )
    kept = kept.withColumn("tif_percent", F.round(F.try_divide(F.col("tif_images") * 100.0, F.col("tif_images") + F.col("jpg_images")), 1))
    return skipped.crossJoin(F.broadcast(kept))  # one row each
