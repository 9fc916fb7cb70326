"""Storage folders of images: from the mirror path if there is one, else batches in order of first sight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slidemill.functions.scalars import antibody_digits, segment

# First batch, parents per batch, and the batch folder's name.
FIRST_BATCH, PARENTS_PER_BATCH, BATCH_PREFIX, BATCH_SUFFIX = 12, 500, "202506", "-xml"


def web_parent(url: Column, antibody: Column) -> Column:
    """The URL's last folder; without any slash the digits of the antibody."""
    return F.when(url.contains("/"), segment(url, -2)).otherwise(antibody_digits(antibody))


def assign_batches(df: DataFrame, parent: str, order: str, first: int = FIRST_BATCH, per_batch: int = PARENTS_PER_BATCH) -> DataFrame:
    """``(parent, batch)``: parents in order of first sight, ``per_batch`` to a batch.

    Ranks come from a range-partitioned sort with offsets per partition, so no task sees all parents.
    """
    firsts = df.groupBy(parent).agg(F.min(order).alias("__first"))
    ranked = ordinal(firsts, ["__first", parent])
    number = F.lit(first) + F.floor((F.col("ordinal") - 1) / F.lit(float(per_batch)))
    return ranked.select(parent, F.concat(F.lit(BATCH_PREFIX), number.cast("int").cast("string"), F.lit(BATCH_SUFFIX)).alias("batch"))


def ordinal(df: DataFrame, order: list[str], out: str = "ordinal", parts: int = 64) -> DataFrame:
    """Adds the rank from 1 in a total order: ranks within ranges of the first key plus the ranges' offsets.

    The number of ranges is fixed, so their offsets are a table of ``parts`` rows.
    """
    head = F.col(order[0]).cast("double")
    bounds = df.agg(F.percentile_approx(head, [i / parts for i in range(1, parts)], 10_000)).first()[0] or []
    bucket = F.size(F.filter(F.array(*(F.lit(float(b)) for b in sorted(set(bounds)))), lambda x: x < head)) if bounds else F.lit(0)
    cut = df.withColumn("__bucket", bucket)
    sizes = cut.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    offsets = sizes.select("__bucket", (F.sum("__n").over(Window.partitionBy(F.lit(0)).orderBy("__bucket")) - F.col("__n")).alias("__before"))
    rank = F.row_number().over(Window.partitionBy("__bucket").orderBy(*order))
    return cut.withColumn("__rank", rank).join(F.broadcast(offsets), "__bucket").withColumn(out, F.col("__rank") + F.col("__before")).drop("__bucket", "__rank", "__before")


def resolve_folders(images: DataFrame, mirror: DataFrame, order: str = "ordinal") -> DataFrame:
    """Adds ``local_path`` and ``download_status`` to images with ``image_url, image_id, antibody_id``.

    ``mirror`` has ``image_id, ftp_path``, unique. A path of three or more parts gives the folders;
    a shorter one still marks the image as available. Batches count only parents taken from the web.
    """
    path = mirror.select(F.col("image_id").alias("__id"), "ftp_path")
    joined = images.join(path, F.col("image_id") == F.col("__id"), "left").drop("__id")
    status = F.when(F.col("ftp_path").isNotNull(), "ftp_available").otherwise("pending")
    joined = joined.withColumn("download_status", status)
    deep = F.coalesce(F.size(F.split("ftp_path", "/")) >= 3, F.lit(False))
    mirrored = joined.where(deep).withColumn("local_path", F.concat_ws("/", segment(F.col("ftp_path"), -3), segment(F.col("ftp_path"), -2)))
    # only rows with a web parent are joined: the others would be one huge group without key
    web = joined.where(~deep).withColumn("__parent", web_parent(F.col("image_url"), F.col("antibody_id")))
    batches = assign_batches(web.where(F.col("__parent").isNotNull()), "__parent", order)
    placed = web.join(batches, "__parent", "left").withColumn("local_path", F.concat_ws("/", "batch", "__parent"))
    return mirrored.drop("ftp_path").unionByName(placed.drop("__parent", "batch", "ftp_path"))


def parent_folders(images: DataFrame, mirror: DataFrame, order: str = "ordinal") -> DataFrame:
    """``(parent, batch)`` of the parents that ``resolve_folders`` takes from the web."""
    deep = mirror.where(F.size(F.split("ftp_path", "/")) >= 3).select(F.col("image_id").alias("__id"))
    web = images.join(deep, F.col("image_id") == F.col("__id"), "left_anti").withColumn("parent", web_parent(F.col("image_url"), F.col("antibody_id")))
    return assign_batches(web.where(F.col("parent").isNotNull()), "parent", order)


def document_aggregate(images: DataFrame, order: str = "ordinal") -> DataFrame:
    """One document per image: the first row's scalars, the first TIF's URL if the first row is no TIF, and its distinct tissues in order."""
    scalars = ["antibody_id", "ensembl_id", "gene_name", "patient_id", "local_path"]
    seen = images.groupBy("image_id", "tissue", "organ", "ontology_terms").agg(
        F.min(order).alias("__o"),
        F.min_by(F.struct(*scalars), order).alias("__s"),
        F.min(F.struct((F.col("image_type") != "tif").alias("other"), F.col(order).alias("o"), "image_type", "image_url")).alias("__u"),
    )
    return seen.groupBy("image_id").agg(
        F.min_by("__s", "__o").alias("s"),
        F.min("__u").alias("u"),
        F.array_sort(F.collect_list(F.struct(F.col("__o").alias("o"), "tissue", "organ", "ontology_terms"))).alias("t"),
    ).select("image_id", "s.*", "u.image_type", "u.image_url", F.transform("t", lambda x: F.struct(x["tissue"].alias("tissue"), x["organ"].alias("organ"), x["ontology_terms"].alias("ontology_terms"))).alias("tissues"))


def gene_documents(antibodies: DataFrame, order: str = "ordinal") -> DataFrame:
    """One document per gene with its antibodies in order; rows without gene are left out."""
    rows = antibodies.where(F.coalesce(F.col("ensembl_id"), F.lit("")) != "")
    docs = rows.groupBy("ensembl_id").agg(
        F.min_by("gene_name", order).alias("gene_name"),
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col("antibody_id").alias("id"), F.col("`Reliability score`").alias("reliability_score")))).alias("a"),
    )
    plain = F.transform("a", lambda x: F.struct(x["id"].alias("id"), x["reliability_score"].alias("reliability_score")))
    return docs.select("ensembl_id", "gene_name", plain.alias("antibodies"))
