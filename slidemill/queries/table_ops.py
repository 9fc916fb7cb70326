"""One query per relational and scalar operator of the dataset pipeline, with its SQL.

Each binds an operator to the dataset tables (or, where those lack a shape, to the
star-schema tables), over whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.functions import scalars as S
from slidemill.functions.seeded import seeded_key
from slidemill.operators import relational as R
from slidemill.operators.thinning import thin_pairs, thin_triplets
from slidemill.plans import pipeline as P
from slidemill.plans.pipeline import PILOT_TISSUES, RELIABILITY_RANK, SECONDARY_TISSUES
from slidemill.sources.atlas_xml import NORMAL_CODE
from slidemill.sources.tables import table

SEED = 42

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):  # type: ignore[no-untyped-def]
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


def _list(values: Iterable[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_IMAGE_BASE = "SELECT row_id, image_id, antibody_id, coalesce(ensembl_id, '') AS ensembl_id, coalesce(tissue, '') AS tissue, coalesce(organ, '') AS organ FROM images"


# filters


@query("filter_source", "SELECT row_id, image_id, tissue FROM dataset WHERE idr_available")
def filter_source(spark: SparkSession, d: str) -> DataFrame:
    return P.filter_source(table(spark, d, "dataset"), "idr").select("row_id", "image_id", "tissue")


@query("exclude_in_list", f"SELECT row_id, tissue FROM images WHERE tissue NOT IN ({_list(SECONDARY_TISSUES)})")
def exclude_in_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "images").where(~F.col("tissue").isin(list(SECONDARY_TISSUES))).select("row_id", "tissue")


@query("include_in_list", f"SELECT row_id, tissue, \"set\" FROM dataset WHERE tissue IN ({_list(PILOT_TISSUES)}) AND \"set\" IN ('train', 'val', 'test')")
def include_in_list(spark: SparkSession, d: str) -> DataFrame:
    kept = F.col("tissue").isin(list(PILOT_TISSUES)) & F.col("set").isin("train", "val", "test")
    return table(spark, d, "dataset").where(kept).select("row_id", "tissue", "set")


@query("inequality_filter", """SELECT row_id, antibody_id FROM antibodies WHERE coalesce("Reliability score", '') <> 'uncertain'""")
def inequality_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "antibodies").where(S.filled(F.col("Reliability score")) != "uncertain").select("row_id", "antibody_id")


@query("contains_filter", f"""SELECT row_id, ftp_path FROM idr_ftp_paths WHERE contains("Characteristics [Pathology] Accession", '{NORMAL_CODE}')""")
def contains_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "idr_ftp_paths").where(F.col("`Characteristics [Pathology] Accession`").contains(NORMAL_CODE)).select("row_id", "ftp_path")


@query("nonempty_filter", "SELECT row_id, gene_name FROM images WHERE gene_name <> ''")
def nonempty_filter(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "images").where("gene_name <> ''").select("row_id", "gene_name")


@query("domain_guard", f"""SELECT DISTINCT "Reliability score" AS unknown FROM antibodies WHERE coalesce("Reliability score", '') NOT IN ({_list([*RELIABILITY_RANK, "uncertain"])}) AND "Reliability score" IS NOT NULL""")
def domain_guard(spark: SparkSession, d: str) -> DataFrame:
    score = F.col("Reliability score")
    return table(spark, d, "antibodies").where(~score.isin([*RELIABILITY_RANK, "uncertain"])).select(score.alias("unknown")).distinct()


# joins


@query("lookup_last_wins", """
WITH last AS (SELECT "Image Name" AS k, arg_max(ftp_path, row_id) AS p FROM idr_ftp_paths WHERE ftp_path <> '' GROUP BY 1)
SELECT i.row_id, coalesce(p, '') AS idr_ftp_path, coalesce(p, '') <> '' AS idr_available,
  CASE WHEN coalesce(p, '') <> '' THEN 'https://mirror.example/' || p ELSE '' END AS idr_url
FROM images i LEFT JOIN last ON regexp_replace(i.image_id || '.tif', '\\.(jpe?g|tif|tiff)$', '.tif') = last.k""")
def lookup_last_wins(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "images").select("row_id", S.tif_name(F.concat("image_id", F.lit(".tif"))).alias("name"))
    out = R.lookup(images, "name", table(spark, d, "idr_ftp_paths").where("ftp_path <> ''"), "Image Name", "ftp_path", "row_id", "idr_ftp_path")
    there = F.col("idr_ftp_path") != ""
    url = F.when(there, F.concat(F.lit("https://mirror.example/"), "idr_ftp_path")).otherwise("")
    return out.select("row_id", "idr_ftp_path", there.alias("idr_available"), url.alias("idr_url"))


@query("semi_join", "SELECT row_id, antibody_id FROM images WHERE antibody_id IN (SELECT antibody_id FROM antibodies WHERE \"Reliability score\" = 'enhanced')")
def semi_join(spark: SparkSession, d: str) -> DataFrame:
    good = table(spark, d, "antibodies").where("`Reliability score` = 'enhanced'").select("antibody_id")
    return table(spark, d, "images").join(good, "antibody_id", "left_semi").select("row_id", "antibody_id")


@query("anti_join", "SELECT row_id, image_id FROM images i WHERE NOT EXISTS (SELECT 1 FROM dataset x WHERE x.image_id = i.image_id)")
def anti_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "images").join(table(spark, d, "dataset").select("image_id"), "image_id", "left_anti").select("row_id", "image_id")


@query("legacy_label", """
WITH f AS (SELECT image_id, arg_min(coalesce("set", ''), row_id) AS s FROM dataset WHERE split_version = 'v1' GROUP BY 1)
SELECT d.row_id, coalesce(f.s, '') AS set_v1 FROM dataset d LEFT JOIN f USING (image_id) WHERE d.split_version = 'v2'""")
def legacy_label(spark: SparkSession, d: str) -> DataFrame:
    from slidemill.operators.split import attach_legacy_set

    data = table(spark, d, "dataset")
    old = data.where("split_version = 'v1'").withColumn("set", S.filled(F.col("set")))
    return attach_legacy_set(data.where("split_version = 'v2'"), old, "row_id").select("row_id", "set_v1")


@query("pick_by_keys", """
WITH p AS (SELECT tissue, min(image_id) AS image_id FROM dataset WHERE image_id IS NOT NULL GROUP BY tissue)
SELECT p.tissue AS picked_for, d.row_id, d.image_id FROM dataset d JOIN p ON d.image_id = p.image_id""")
def pick_by_keys(spark: SparkSession, d: str) -> DataFrame:
    data = table(spark, d, "dataset")
    picks = data.where("image_id IS NOT NULL").groupBy(F.col("tissue").alias("picked_for")).agg(F.min("image_id").alias("image_id"))
    return data.join(picks, "image_id").select("picked_for", "row_id", "image_id")


@query("outer_join_counts", """
WITH a AS (SELECT tissue, count(*) AS n_images FROM images GROUP BY 1), b AS (SELECT tissue, count(DISTINCT cell_type) AS n_types FROM cells GROUP BY 1)
SELECT coalesce(a.tissue, b.tissue) AS tissue, coalesce(n_images, 0) AS n_images, coalesce(n_types, 0) AS n_types FROM a FULL JOIN b ON a.tissue = b.tissue""")
def outer_join_counts(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "images").groupBy("tissue").agg(F.count(F.lit(1)).alias("n_images"))
    b = table(spark, d, "cells").groupBy("tissue").agg(F.countDistinct("cell_type").alias("n_types"))
    return a.join(b, "tissue", "full_outer").select("tissue", *(S.filled(F.col(c), 0).alias(c) for c in ("n_images", "n_types")))


# set operations


@query("distinct_rows", "SELECT DISTINCT antibody_id, tissue, ontology_terms FROM tissues")
def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tissues").select("antibody_id", "tissue", "ontology_terms").distinct()


@query("union_files", "SELECT tissue, 'images' AS source_file FROM images UNION ALL SELECT tissue, 'dataset' FROM dataset")
def union_files(spark: SparkSession, d: str) -> DataFrame:
    a, b = (table(spark, d, n).select("tissue", F.lit(n).alias("source_file")) for n in ("images", "dataset"))
    return a.unionByName(b)


@query("intersect_keys", "SELECT ensembl_id FROM images INTERSECT SELECT ensembl_id FROM genes")
def intersect_keys(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "images").select("ensembl_id").intersect(table(spark, d, "genes").select("ensembl_id"))


@query("except_values", "SELECT ensembl_id FROM images EXCEPT SELECT ensembl_id FROM antibodies")
def except_values(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "images").select("ensembl_id").subtract(table(spark, d, "antibodies").select("ensembl_id"))


@query("pairwise_names", "SELECT a.r_name AS name_a, b.r_name AS name_b FROM region a JOIN region b ON a.r_name < b.r_name")
def pairwise_names(spark: SparkSession, d: str) -> DataFrame:
    a, b = (table(spark, d, "region").select(F.col("r_name").alias(n)) for n in ("name_a", "name_b"))
    return a.join(b, F.col("name_a") < F.col("name_b"))


# aggregates


@query("multi_target", "SELECT antibody_id, count(DISTINCT ensembl_id) AS n_genes FROM antibodies GROUP BY 1 HAVING count(DISTINCT ensembl_id) > 1")
def multi_target(spark: SparkSession, d: str) -> DataFrame:
    return R.multi_target(table(spark, d, "antibodies"))


@query("step_counts", "SELECT 'full' AS stage, 'crawl' AS step, count(*) AS images, count(DISTINCT antibody_id) AS antibodies, count(DISTINCT ensembl_id) AS genes, count(DISTINCT tissue) AS tissues FROM images")
def step_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.step_counts(table(spark, d, "images"), "full", "crawl")


@query("value_counts", "SELECT tissue AS value, count(*) AS n, count(*) / sum(count(*)) OVER () AS share FROM images GROUP BY tissue")
def value_counts(spark: SparkSession, d: str) -> DataFrame:
    return R.value_counts(table(spark, d, "images"), "tissue")


@query("group_sizes", "SELECT antibody_id, tissue, count(*) AS n FROM images GROUP BY 1, 2")
def group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "images").groupBy("antibody_id", "tissue").agg(F.count(F.lit(1)).alias("n"))


@query("top_pairs", """
WITH c AS (SELECT image_id, string_agg(tissue, ' | ' ORDER BY tissue) AS combination, count(*) AS n FROM images WHERE image_id <> '' AND tissue IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT combination, count(*) AS n FROM c GROUP BY 1 ORDER BY n DESC, combination LIMIT 5""")
def top_pairs(spark: SparkSession, d: str) -> DataFrame:
    return R.group_pairs(table(spark, d, "images").where("image_id <> '' AND tissue IS NOT NULL"), "image_id", "tissue", 5)


@query("status_counts", "SELECT lower(trim(download_status)) AS status, count(*) AS n FROM images GROUP BY 1")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "images").groupBy(F.lower(F.trim("download_status")).alias("status")).agg(F.count(F.lit(1)).alias("n"))


@query("missing_counts", "SELECT unnest(['gene_name', 'organ', 'image_id']) AS field, unnest([count(*) FILTER (coalesce(gene_name, '') = ''), count(*) FILTER (coalesce(organ, '') = ''), count(*) FILTER (coalesce(image_id, '') = '')]) AS n_missing FROM images")
def missing_counts(spark: SparkSession, d: str) -> DataFrame:
    from slidemill.operators.quality import missing_counts as count

    return count(table(spark, d, "images"), ["gene_name", "organ", "image_id"])


@query("parser_counts", """
SELECT count(DISTINCT ensembl_id) AS genes, count(DISTINCT antibody_id) AS antibodies, count(DISTINCT tissue) AS tissues,
 count(*) FILTER (image_type = 'tif') AS tif, count(*) FILTER (image_type = 'jpg') AS jpg, round(100.0 * count(*) FILTER (image_type = 'tif') / count(*), 1) AS tif_percent FROM images""")
def parser_counts(spark: SparkSession, d: str) -> DataFrame:
    tif, jpg = (F.sum((F.col("image_type") == t).cast("int")) for t in ("tif", "jpg"))
    return table(spark, d, "images").agg(
        *(F.countDistinct(c).alias(n) for c, n in (("ensembl_id", "genes"), ("antibody_id", "antibodies"), ("tissue", "tissues"))),
        tif.alias("tif"), jpg.alias("jpg"), F.round(100.0 * tif / F.count(F.lit(1)), 1).alias("tif_percent"),
    )


@query("bounding_positions", """
SELECT vec_id, min(k) - 1 AS first_pos, max(k) - 1 AS last_pos FROM (SELECT vec_id, unnest(embedding) AS v, unnest(range(1, len(embedding) + 1)) AS k FROM embeddings) WHERE v > 0 GROUP BY 1""")
def bounding_positions(spark: SparkSession, d: str) -> DataFrame:
    cells = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("pos", "v")).where("v > 0")
    return cells.groupBy("vec_id").agg(F.min("pos").cast("long").alias("first_pos"), F.max("pos").cast("long").alias("last_pos"))


# deduplication and choices per group


@query("dedupe_first", "SELECT row_id, antibody_id, tissue, cell_type FROM cells QUALIFY row_number() OVER (PARTITION BY antibody_id, tissue, cell_type ORDER BY row_id) = 1")
def dedupe_first(spark: SparkSession, d: str) -> DataFrame:
    cells = table(spark, d, "cells").select("row_id", "antibody_id", "tissue", "cell_type")
    return R.keep_first(cells, ["antibody_id", "tissue", "cell_type"], ["row_id"])


@query("dedupe_prefer", """
SELECT row_id, image_id, image_type, min(row_id) OVER w AS position FROM images
WINDOW w AS (PARTITION BY image_id, patient_id, tissue)
QUALIFY row_number() OVER (PARTITION BY image_id, patient_id, tissue ORDER BY (CASE WHEN image_type = 'tif' THEN 0 ELSE 1 END), row_id) = 1""")
def dedupe_prefer(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "images").select("row_id", "image_id", "patient_id", "tissue", "image_type")
    kept = R.keep_preferred(images, ["image_id", "patient_id", "tissue"], F.col("image_type") == "tif", "row_id")
    return kept.select("row_id", "image_id", "image_type", "position")


@query("dup_policy_drop", "SELECT row_id, image_id FROM images QUALIFY count(*) OVER (PARTITION BY image_id) = 1")
def dup_policy_drop(spark: SparkSession, d: str) -> DataFrame:
    return R.resolve_duplicates(table(spark, d, "images").select("row_id", "image_id", "tissue"), "drop").select("row_id", "image_id")


@query("dup_policy_prefer", """
SELECT row_id, image_id FROM images QUALIFY count(*) OVER (PARTITION BY image_id) = 1
 OR (tissue = 'Soft tissue 1' AND sum(CASE WHEN tissue = 'Soft tissue 1' THEN 1 ELSE 0 END) OVER (PARTITION BY image_id) = 1)""")
def dup_policy_prefer(spark: SparkSession, d: str) -> DataFrame:
    return R.resolve_duplicates(table(spark, d, "images").select("row_id", "image_id", "tissue"), "prefer").select("row_id", "image_id")


@query("dup_report", "SELECT row_id, image_id, tissue FROM images QUALIFY count(*) OVER (PARTITION BY image_id) > 1")
def dup_report(spark: SparkSession, d: str) -> DataFrame:
    return R.duplicate_report(table(spark, d, "images").select("row_id", "image_id", "tissue"))


@query("best_per_group", f"""
SELECT row_id, ensembl_id, antibody_id FROM antibodies WHERE ensembl_id <> '' AND "Reliability score" IN ({_list(list(RELIABILITY_RANK))})
QUALIFY row_number() OVER (PARTITION BY ensembl_id ORDER BY (CASE "Reliability score" WHEN 'enhanced' THEN 3 WHEN 'supported' THEN 2 ELSE 1 END) DESC, md5('{SEED}:' || row_id), row_id) = 1""")
def best_per_group(spark: SparkSession, d: str) -> DataFrame:
    score = F.col("Reliability score")
    kept = table(spark, d, "antibodies").where((F.col("ensembl_id") != "") & score.isin(list(RELIABILITY_RANK)))
    return R.best_per_group(kept, ["ensembl_id"], S.mapped(score, RELIABILITY_RANK), "row_id", SEED).select("row_id", "ensembl_id", "antibody_id")


@query("top1_per_group", f"""
SELECT tissue, row_id, max_staining_code FROM image_annotations
QUALIFY row_number() OVER (PARTITION BY tissue ORDER BY max_staining_code DESC, n_cell_types DESC, md5('{SEED}:' || row_id), row_id) = 1""")
def top1_per_group(spark: SparkSession, d: str) -> DataFrame:
    order = [F.desc("max_staining_code"), F.desc("n_cell_types"), seeded_key(SEED, F.col("row_id")), "row_id"]
    return R.keep_first(table(spark, d, "image_annotations"), ["tissue"], order).select("tissue", "row_id", "max_staining_code")


@query("first_n_per_group", "SELECT \"set\", row_id FROM dataset QUALIFY row_number() OVER (PARTITION BY \"set\" ORDER BY row_id) <= 3")
def first_n_per_group(spark: SparkSession, d: str) -> DataFrame:
    return R.first_n(table(spark, d, "dataset"), ["set"], ["row_id"], 3).select("set", "row_id")


@query("last_wins", "SELECT \"Image Name\" AS name, arg_max(ftp_path, row_id) AS ftp_path FROM idr_ftp_paths WHERE ftp_path <> '' GROUP BY 1")
def last_wins(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "idr_ftp_paths").where("ftp_path <> ''").select(F.col("Image Name").alias("name"), "ftp_path", "row_id")
    return R.last_per_key(paths, ["name"], "ftp_path", "row_id")


@query("limit_rows", "SELECT row_id, image_id FROM dataset ORDER BY row_id LIMIT 100")
def limit_rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dataset").orderBy("row_id").limit(100).select("row_id", "image_id")


@query("mixed_sort", "SELECT row_id, tissue, n_cell_types, row_number() OVER (ORDER BY n_cell_types DESC, tissue, row_id) AS place FROM image_annotations ORDER BY place LIMIT 50")
def mixed_sort(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    top = table(spark, d, "image_annotations").orderBy(F.desc("n_cell_types"), F.asc_nulls_last("tissue"), "row_id").limit(50)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("n_cell_types"), F.asc_nulls_last("tissue"), "row_id"))
    return top.select("row_id", "tissue", "n_cell_types", place.alias("place"))


# seeded choices


@query("seeded_shuffle_topk", f"SELECT row_id, md5('{SEED}:' || row_id) AS k FROM images ORDER BY k LIMIT 20")
def seeded_shuffle_topk(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "images").select("row_id", seeded_key(SEED, F.col("row_id")).alias("k")).orderBy("k").limit(20)


@query("k_per_group", f"""
SELECT organ, row_id FROM images WHERE organ IN ('Brain', 'Skin', 'Muscle tissues')
QUALIFY organ = 'Muscle tissues' OR row_number() OVER (PARTITION BY organ ORDER BY md5('{SEED}:' || row_id), row_id) <= CASE organ WHEN 'Brain' THEN 7 ELSE 8 END""")
def k_per_group(spark: SparkSession, d: str) -> DataFrame:
    sizes = {"Brain": 7, "Skin": 8, "Muscle tissues": None}
    return R.k_per_group(table(spark, d, "images"), "organ", sizes, "row_id", SEED).select("organ", "row_id")


_RANKED = f"""WITH r AS (SELECT row_id, antibody_id, tissue, count(*) OVER (PARTITION BY antibody_id, tissue) AS n,
 row_number() OVER (PARTITION BY antibody_id, tissue ORDER BY md5('{SEED}:' || row_id), row_id) AS k FROM images) """


@query("thin_triplets", _RANKED + "SELECT row_id FROM r WHERE NOT (n = 3 AND k = 3)")
def thin_triplets_query(spark: SparkSession, d: str) -> DataFrame:
    return thin_triplets(table(spark, d, "images").select("row_id", "antibody_id", "tissue"), SEED, key="row_id").select("row_id")


@query("thin_pairs", _RANKED + f"SELECT row_id FROM r WHERE NOT (n = 2 AND k = 2 AND CAST('0x' || substr(md5('{SEED}:pair:' || concat_ws('|', antibody_id, tissue)), 1, 8) AS BIGINT) / 4294967296.0 < 0.4)")
def thin_pairs_query(spark: SparkSession, d: str) -> DataFrame:
    return thin_pairs(table(spark, d, "images").select("row_id", "antibody_id", "tissue"), SEED, key="row_id").select("row_id")


# scalar functions


@query("ordinal_codes", """
SELECT row_id, CASE lower(regexp_replace(staining, '^\\s+|\\s+$', '', 'g')) WHEN 'not detected' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 ELSE -1 END AS staining_code,
 CASE lower(regexp_replace(intensity, '^\\s+|\\s+$', '', 'g')) WHEN 'negative' THEN 0 WHEN 'weak' THEN 1 WHEN 'moderate' THEN 2 WHEN 'strong' THEN 3 ELSE -1 END AS intensity_code,
 CASE lower(regexp_replace(quantity, '^\\s+|\\s+$', '', 'g')) WHEN 'none' THEN 0 WHEN '<25%' THEN 1 WHEN '25%-75%' THEN 2 WHEN '25-75%' THEN 2 WHEN '25% - 75%' THEN 2 WHEN '>75%' THEN 3 ELSE -1 END AS quantity_code,
 CASE WHEN contains(lower(location), 'cytoplasmic/membranous') AND contains(lower(location), 'nuclear') THEN 3 WHEN contains(lower(location), 'nuclear') THEN 2
  WHEN contains(lower(location), 'cytoplasmic/membranous') THEN 1 WHEN regexp_replace(lower(location), '^\\s+|\\s+$', '', 'g') = 'none' THEN 0 ELSE -1 END AS location_code FROM cells""")
def ordinal_codes(spark: SparkSession, d: str) -> DataFrame:
    codes = {"staining": S.STAINING_CODES, "intensity": S.INTENSITY_CODES, "quantity": S.QUANTITY_CODES}
    return table(spark, d, "cells").select("row_id", *(S.ordinal_code(F.col(c), m).alias(f"{c}_code") for c, m in codes.items()), S.location_code(F.col("location")).alias("location_code"))


@query("normalize_float_ids", "SELECT row_id, CASE WHEN regexp_full_match(patient_id, '[0-9]+\\.0') THEN left(patient_id, length(patient_id) - 2) ELSE patient_id END AS patient_id FROM images")
def normalize_float_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "images").select("row_id", S.whole_number_id(F.col("patient_id")).alias("patient_id"))


@query("regex_parts", """
SELECT row_id, CASE WHEN regexp_extract(antibody_id, '^([A-Za-z]+)([0-9]+)$', 1) = '' THEN 'other' ELSE regexp_extract(antibody_id, '^([A-Za-z]+)([0-9]+)$', 1) END AS source,
 TRY_CAST(regexp_extract(antibody_id, '^([A-Za-z]+)([0-9]+)$', 2) AS BIGINT) AS number,
 CASE WHEN regexp_extract(antibody_id, '^([A-Za-z]+)', 1) = '' THEN 'other' ELSE regexp_extract(antibody_id, '^([A-Za-z]+)', 1) END AS prefix,
 CASE WHEN regexp_extract(antibody_id, '(HPA|CAB)0*([0-9]+)', 2) <> '' THEN regexp_extract(antibody_id, '(HPA|CAB)0*([0-9]+)', 2) ELSE regexp_replace(antibody_id, 'HPA|CAB', '', 'g') END AS digits
FROM images""")
def regex_parts(spark: SparkSession, d: str) -> DataFrame:
    a = F.col("antibody_id")
    return table(spark, d, "images").select("row_id", S.id_source(a).alias("source"), S.id_number(a).alias("number"), S.id_prefix(a).alias("prefix"), S.antibody_digits(a).alias("digits"))


@query("path_functions", """
SELECT row_id, regexp_extract(image_url, '([^/]*)$', 1) AS base, regexp_replace(regexp_extract(image_url, '([^/]*)$', 1), '^(\\.*[^.].*)\\.[^.]*$', '\\1') AS stem,
 string_split(image_url, '/')[-2] AS parent, regexp_replace(regexp_extract(image_url, '([^/]*)$', 1), '\\.(jpe?g|tif|tiff)$', '.tif') AS tif,
 lower(image_url) LIKE '%.tif' AS is_tif, left(download_date, 4) AS year FROM images""")
def path_functions(spark: SparkSession, d: str) -> DataFrame:
    url = F.col("image_url")
    return table(spark, d, "images").select(
        "row_id", S.basename(url).alias("base"), S.stem(url).alias("stem"), S.segment(url, -2).alias("parent"),
        S.tif_name(S.basename(url)).alias("tif"), F.lower(url).endswith(".tif").alias("is_tif"), F.substring("download_date", 1, 4).alias("year"),
    )


@query("after_marker", "SELECT row_id, CASE WHEN contains(ftp_path, 'idr9043-tissueatlas/') THEN substr(ftp_path, instr(ftp_path, 'idr9043-tissueatlas/') + 20) ELSE regexp_replace(ftp_path, '^/+', '') END AS relative FROM idr_ftp_paths")
def after_marker(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "idr_ftp_paths").select("row_id", S.after_marker(F.col("ftp_path"), "idr9043-tissueatlas/").alias("relative"))


@query("explode_list", "SELECT row_id, unnest(string_split(ontology_terms, ';')) AS term FROM tissues WHERE ontology_terms <> ''")
def explode_list(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tissues").where("ontology_terms <> ''").select("row_id", F.explode(F.split("ontology_terms", ";")).alias("term"))


@query("sorted_list_join", "SELECT antibody_id, string_agg(DISTINCT tissue, ';' ORDER BY tissue) AS tissues, string_agg(tissue, ';' ORDER BY tissue) AS all_tissues FROM tissues WHERE tissue IS NOT NULL GROUP BY 1")
def sorted_list_join(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "tissues").where("tissue IS NOT NULL").groupBy("antibody_id").agg(S.sorted_join(F.collect_set("tissue")).alias("tissues"), S.sorted_join(F.collect_list("tissue")).alias("all_tissues"))


@query("json_encode", """SELECT row_id, CAST(to_json({'antibody_id': antibody_id, 'organ': organ, 'n': row_id}) AS VARCHAR) AS doc FROM tissues""")
def json_encode(spark: SparkSession, d: str) -> DataFrame:
    doc = F.to_json(F.struct("antibody_id", "organ", F.col("row_id").alias("n")), {"ignoreNullFields": "false"})
    return table(spark, d, "tissues").select("row_id", doc.alias("doc"))


@query("bankers_round", "SELECT p_partkey, CAST(round_even(p_size * 0.5, 0) AS INTEGER) AS half FROM part")
def bankers_round(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", S.half_even(F.col("p_size") * 0.5).alias("half"))


@query("conditional_update", """SELECT row_id, CASE WHEN "set" IN ('tra', 'training') THEN 'train' ELSE "set" END AS "set", 'v2' AS split_version FROM dataset""")
def conditional_update(spark: SparkSession, d: str) -> DataFrame:
    label = F.when(F.col("set").isin("tra", "training"), "train").otherwise(F.col("set"))
    return table(spark, d, "dataset").select("row_id", label.alias("set"), F.lit("v2").alias("split_version"))


@query("source_order", """
SELECT row_id, CASE WHEN idr_url <> '' AND hpa_url <> '' THEN 'idr,hpa' WHEN idr_url <> '' THEN 'idr' WHEN hpa_url <> '' THEN 'hpa' ELSE '' END AS sources FROM dataset""")
def source_order(spark: SparkSession, d: str) -> DataFrame:
    urls = S.source_urls(["idr", "hpa"], {"idr": "idr_url", "hpa": "hpa_url"})
    return table(spark, d, "dataset").select("row_id", F.array_join(F.transform(urls, lambda u: u["source"]), ",").alias("sources"))


@query("text_formats", "SELECT tissue, printf('%.1f%%', 100.0 * n / t) AS share_text, printf('%+.2f pt', 100.0 * (n / t - 0.02)) AS off_text FROM (SELECT tissue, count(*) AS n, sum(count(*)) OVER () AS t FROM images GROUP BY tissue)")
def text_formats(spark: SparkSession, d: str) -> DataFrame:
    counts = R.value_counts(table(spark, d, "images"), "tissue")
    return counts.select(F.col("value").alias("tissue"), S.percent_text(F.col("share")).alias("share_text"), S.signed_points(F.col("share") - 0.02).alias("off_text"))


@query("destination_paths", """
WITH p AS (SELECT row_id, 'root/' || local_path || '/' || image_id || '.tif' AS p FROM dataset WHERE image_id IS NOT NULL AND local_path IS NOT NULL)
SELECT row_id, p AS image_path, regexp_extract(p, '^(.*/)', 1) || 'masks/' || regexp_extract(p, '([^/]*)\\.tif$', 1) || '_mask.npy' AS mask_path,
 regexp_extract(p, '^(.*/)', 1) || 'crops/' || regexp_extract(p, '([^/]*)\\.tif$', 1) || '_crop.npy' AS crop_path FROM p""")
def destination_paths(spark: SparkSession, d: str) -> DataFrame:
    from slidemill.images.paths import crop_path, image_path, mask_path

    rows = table(spark, d, "dataset").where("image_id IS NOT NULL AND local_path IS NOT NULL")
    path = image_path(F.lit("root"), F.col("local_path"), F.col("image_id"))
    return rows.select("row_id", path.alias("image_path"), mask_path(path).alias("mask_path"), crop_path(path).alias("crop_path"))
