"""Queries of splitting, annotation, quality and whole-pipeline operators, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.functions.scalars import id_prefix
from slidemill.operators import annotate as A
from slidemill.operators import folders as FO
from slidemill.operators import quality as Q
from slidemill.operators import split as SP
from slidemill.plans import pipeline as P
from slidemill.plans.pipeline import PILOT_TISSUES
from slidemill.queries.table_ops import SEED
from slidemill.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):  # type: ignore[no-untyped-def]
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = sql
        return f

    return register


# splits

_STRATA = """
b0 AS (SELECT id, CASE WHEN regexp_extract(id, '^([A-Za-z]+)([0-9]+)$', 1) = '' THEN 'other' ELSE regexp_extract(id, '^([A-Za-z]+)([0-9]+)$', 1) END AS source,
  TRY_CAST(regexp_extract(id, '^([A-Za-z]+)([0-9]+)$', 2) AS BIGINT) AS number FROM ids),
b1 AS (SELECT *, count(*) OVER (PARTITION BY source) AS n, row_number() OVER (PARTITION BY source ORDER BY number, id) AS rn FROM b0),
b2 AS (SELECT *, least(5, greatest(1, n // 10)) AS k FROM b1),
b3 AS (SELECT id, source, CASE WHEN source = 'other' THEN 'other' ELSE source || '_' || CASE WHEN n = 1 THEN 0 ELSE CAST(greatest(0, ceil((rn - 1) * k / (n - 1)::DOUBLE) - 1) AS INT) END END AS s FROM b2),
b4 AS (SELECT id, source, CASE WHEN count(*) OVER (PARTITION BY s) < 10 THEN source ELSE s END AS s FROM b3),
b5 AS (SELECT id, CASE WHEN count(*) OVER (PARTITION BY s) < 10 THEN 'all' ELSE s END AS s FROM b4),
big AS (SELECT s FROM b5 GROUP BY s HAVING count(*) >= 10 ORDER BY count(*) DESC, s LIMIT 1),
strata AS (SELECT id, CASE WHEN count(*) OVER (PARTITION BY s) < 10 THEN coalesce((SELECT s FROM big), s) ELSE s END AS s FROM b5)"""


def _holdout(source: str, size: str, tag: str, out: str) -> str:
    return f"""
{out}_c AS (SELECT s, count(*) AS c, (SELECT {size}) AS size, (SELECT count(*) FROM {source}) AS n FROM {source} GROUP BY s),
{out}_q AS (SELECT *, size * c // n AS base, (size * c) % n AS rest, count(*) OVER () AS k, min(c) OVER () AS least FROM {out}_c),
{out}_p AS (SELECT *, size - sum(base) OVER () AS spare, row_number() OVER (ORDER BY rest DESC, md5('{SEED}:{tag}:' || s), s) AS place FROM {out}_q),
{out}_r AS (SELECT x.id, x.s, p.*, row_number() OVER (PARTITION BY x.s ORDER BY md5('{SEED}:{tag}:' || id), id) AS i, row_number() OVER (ORDER BY md5('{SEED}:{tag}:' || id), id) AS j FROM {source} x JOIN {out}_p p ON x.s = p.s),
{out} AS (SELECT id, CASE WHEN size <= 0 THEN false WHEN k > 1 AND least >= 2 AND size >= k AND n - size >= k THEN i <= base + (CASE WHEN place <= spare THEN 1 ELSE 0 END) ELSE j <= size END AS held FROM {out}_r)"""


def _split_sql(ids: str) -> str:
    n = "(SELECT count(*) FROM ids)"
    n_test = f"CASE WHEN {n} < 3 THEN 0 ELSE round_even({n} * 0.2, 0)::BIGINT END"
    n_val = f"CASE WHEN {n} < 3 THEN 0 ELSE least(round_even({n} * 0.1, 0)::BIGINT, (SELECT count(*) FROM rest) - 1) END"
    return f"ids AS ({ids}), {_STRATA}, {_holdout('strata', n_test, 'test', 'tested')}, rest AS (SELECT * FROM strata WHERE id NOT IN (SELECT id FROM tested WHERE held)), {_holdout('rest', n_val, 'val', 'vald')}, sets AS (SELECT id, 'test' AS \"set\" FROM tested WHERE held UNION ALL SELECT id, CASE WHEN held THEN 'val' ELSE 'train' END FROM vald)"


_ANTIBODY_IDS = "SELECT DISTINCT antibody_id AS id FROM antibodies WHERE antibody_id IS NOT NULL"


@query("quantile_strata", f"WITH ids AS ({_ANTIBODY_IDS}), {_STRATA} SELECT id AS antibody_id, s AS stratum FROM strata")
def quantile_strata(spark: SparkSession, d: str) -> DataFrame:
    return SP.antibody_strata(table(spark, d, "antibodies").where("antibody_id IS NOT NULL"))


@query("stratified_holdout", f"WITH ids AS ({_ANTIBODY_IDS}), {_STRATA}, {_holdout('strata', '40', 'test', 'h')} SELECT id AS antibody_id, held FROM h")
def stratified_holdout(spark: SparkSession, d: str) -> DataFrame:
    ids = SP.antibody_strata(table(spark, d, "antibodies").where("antibody_id IS NOT NULL"))
    return SP.stratified_holdout(ids, 40, seed=SEED).select("antibody_id", "held")


@query("split_sets", f"WITH {_split_sql(_ANTIBODY_IDS)} SELECT id AS antibody_id, \"set\" FROM sets")
def split_sets(spark: SparkSession, d: str) -> DataFrame:
    return SP.split_antibodies(table(spark, d, "antibodies"), seed=SEED)


_INHERIT = """WITH e AS (SELECT image_id, min("set") AS s FROM dataset WHERE split_version = 'v1' AND "set" IN ('train', 'val', 'test') GROUP BY 1),
a AS (SELECT d.row_id, d.antibody_id, d.ensembl_id, coalesce(e.s, '') AS s FROM dataset d LEFT JOIN e USING (image_id)),
b AS (SELECT a.row_id, a.antibody_id, a.ensembl_id, CASE WHEN a.s = '' THEN coalesce(m.s, '') ELSE a.s END AS s FROM a LEFT JOIN (SELECT antibody_id, min(s) AS s FROM a WHERE s <> '' AND antibody_id <> '' GROUP BY 1) m USING (antibody_id)),
c AS (SELECT b.row_id, CASE WHEN b.s = '' THEN coalesce(m.s, '') ELSE b.s END AS s FROM b LEFT JOIN (SELECT ensembl_id, min(s) AS s FROM b WHERE s <> '' AND ensembl_id <> '' GROUP BY 1) m USING (ensembl_id))
"""


@query("inherit_labels", _INHERIT + 'SELECT row_id, s AS "set" FROM c')
def inherit_labels(spark: SparkSession, d: str) -> DataFrame:
    data = table(spark, d, "dataset")
    return SP.inherit_labels(data, data.where("split_version = 'v1'"), check=False).select("row_id", "set")


@query("span_guard", """SELECT antibody_id, count(DISTINCT "set") AS n_labels FROM dataset WHERE "set" <> '' GROUP BY 1 HAVING count(DISTINCT "set") > 1""")
def span_guard(spark: SparkSession, d: str) -> DataFrame:
    return SP.several_labels(table(spark, d, "dataset"), "antibody_id")


@query("split_versions", "SELECT DISTINCT split_version FROM dataset")
def split_versions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "dataset").select("split_version").distinct()


# folders and documents

_PARENTS = "WITH p AS (SELECT row_id, CASE WHEN contains(image_url, '/') THEN string_split(image_url, '/')[-2] ELSE antibody_id END AS parent FROM images), f AS (SELECT parent, min(row_id) AS o FROM p WHERE parent IS NOT NULL GROUP BY 1), b AS (SELECT parent, '202506' || CAST(12 + (row_number() OVER (ORDER BY o, parent) - 1) // 500 AS INT) || '-xml' AS batch FROM f) "


@query("batch_assign", _PARENTS + "SELECT parent, batch FROM b")
def batch_assign(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "images").select("row_id", FO.web_parent(F.col("image_url"), F.col("antibody_id")).alias("parent"))
    return FO.assign_batches(images.where("parent IS NOT NULL"), "parent", "row_id")


@query("folder_resolution", """
WITH m AS (SELECT regexp_replace("Image Name", '\\.tif$', '') AS image_id, arg_max(ftp_path, row_id) AS ftp_path FROM idr_ftp_paths WHERE "Image Name" IS NOT NULL AND ftp_path <> '' GROUP BY 1),
j AS (SELECT i.row_id, i.image_url, m.ftp_path, CASE WHEN m.ftp_path IS NULL OR len(string_split(m.ftp_path, '/')) < 3 THEN string_split(i.image_url, '/')[-2] END AS parent FROM images i LEFT JOIN m USING (image_id)),
f AS (SELECT parent, min(row_id) AS o FROM j WHERE parent IS NOT NULL GROUP BY 1), b AS (SELECT parent, '202506' || CAST(12 + (row_number() OVER (ORDER BY o, parent) - 1) // 500 AS INT) || '-xml' AS batch FROM f)
SELECT row_id, CASE WHEN parent IS NULL THEN string_split(ftp_path, '/')[-3] || '/' || string_split(ftp_path, '/')[-2] ELSE batch || '/' || parent END AS local_path,
 CASE WHEN ftp_path IS NULL THEN 'pending' ELSE 'ftp_available' END AS download_status FROM j LEFT JOIN b USING (parent)""")
def folder_resolution(spark: SparkSession, d: str) -> DataFrame:
    paths = table(spark, d, "idr_ftp_paths").select(F.regexp_replace("Image Name", r"\.tif$", "").alias("image_id"), "ftp_path", "row_id")
    mirror = paths.where("image_id IS NOT NULL AND ftp_path <> ''").groupBy("image_id").agg(F.max_by("ftp_path", "row_id").alias("ftp_path"))
    images = table(spark, d, "images").select("row_id", "image_url", "image_id", "antibody_id")
    return FO.resolve_folders(images, mirror, "row_id").select("row_id", "local_path", "download_status")


_IMAGES_WITH_TERMS = "SELECT i.row_id, i.image_id, i.antibody_id, i.ensembl_id, i.gene_name, i.patient_id, i.local_path, i.image_type, i.image_url, coalesce(i.tissue, '') AS tissue, coalesce(i.organ, '') AS organ FROM images i WHERE image_id <> ''"


@query("image_documents", f"""
WITH i AS ({_IMAGES_WITH_TERMS}),
t AS (SELECT image_id, tissue, organ, min(row_id) AS o FROM i GROUP BY ALL),
u AS (SELECT image_id, image_type, image_url FROM i QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY (CASE WHEN image_type <> 'tif' THEN 1 ELSE 0 END), row_id) = 1),
s AS (SELECT image_id, antibody_id, patient_id FROM i QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY row_id) = 1)
SELECT s.image_id, s.antibody_id, s.patient_id, u.image_type, u.image_url, g.tissues FROM s JOIN u USING (image_id)
JOIN (SELECT image_id, string_agg(tissue || '/' || organ, ';' ORDER BY o) AS tissues FROM t GROUP BY 1) g USING (image_id)""")
def image_documents(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "images").where("image_id <> ''").na.fill("", ["tissue", "organ"]).withColumn("ontology_terms", F.lit(""))
    docs = FO.document_aggregate(rows, "row_id")
    tissues = F.array_join(F.transform("tissues", lambda t: F.concat_ws("/", t["tissue"], t["organ"])), ";")
    return docs.select("image_id", "antibody_id", "patient_id", "image_type", "image_url", tissues.alias("tissues"))


@query("gene_documents", """
SELECT ensembl_id, arg_min(gene_name, row_id) FILTER (gene_name IS NOT NULL) AS gene_name, string_agg(antibody_id || '=' || coalesce("Reliability score", ''), ';' ORDER BY row_id) AS antibodies
FROM antibodies WHERE ensembl_id <> '' GROUP BY 1""")
def gene_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = FO.gene_documents(table(spark, d, "antibodies"), "row_id")
    listed = F.array_join(F.transform("antibodies", lambda a: F.concat(a["id"], F.lit("="), F.coalesce(a["reliability_score"], F.lit("")))), ";")
    names = table(spark, d, "antibodies").where("gene_name IS NOT NULL").groupBy("ensembl_id").agg(F.min_by("gene_name", "row_id").alias("name"))
    return docs.join(names, "ensembl_id", "left").select("ensembl_id", F.col("name").alias("gene_name"), listed.alias("antibodies"))


@query("gene_first_seen", "SELECT ensembl_id, row_id, synonyms FROM genes WHERE ensembl_id <> '' QUALIFY row_number() OVER (PARTITION BY ensembl_id ORDER BY row_id) = 1")
def gene_first_seen(spark: SparkSession, d: str) -> DataFrame:
    from slidemill.operators.relational import keep_first

    return keep_first(table(spark, d, "genes").where("ensembl_id <> ''"), ["ensembl_id"], ["row_id"]).select("ensembl_id", "row_id", "synonyms")


# annotations

_CODE = "CASE lower(regexp_replace({0}, '^\\s+|\\s+$', '', 'g')) {1} ELSE -1 END"
_CODES = {
    "staining": "WHEN 'not detected' THEN 0 WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3",
    "intensity": "WHEN 'negative' THEN 0 WHEN 'weak' THEN 1 WHEN 'moderate' THEN 2 WHEN 'strong' THEN 3",
    "quantity": "WHEN 'none' THEN 0 WHEN '<25%' THEN 1 WHEN '25%-75%' THEN 2 WHEN '25-75%' THEN 2 WHEN '25% - 75%' THEN 2 WHEN '>75%' THEN 3",
}
_CELLS = """c AS (SELECT antibody_id, ensembl_id, tissue, cell_type, staining, intensity, quantity FROM cells
  QUALIFY row_number() OVER (PARTITION BY antibody_id, ensembl_id, tissue, cell_type ORDER BY row_id) = 1),
ann AS (SELECT d.row_id, d.image_id, d.antibody_id, d.tissue, c.cell_type, """ + ", ".join(f"{_CODE.format('c.' + n, w)} AS {n}_code" for n, w in _CODES.items()) + """
  FROM v2 d JOIN c ON d.antibody_id = c.antibody_id AND d.ensembl_id = c.ensembl_id AND d.tissue = c.tissue)"""  # fmt: skip
_V2 = """v2 AS (SELECT * FROM dataset WHERE split_version = 'v2' AND image_id <> '' QUALIFY row_number() OVER (PARTITION BY image_id ORDER BY row_id) = 1)"""


def _release(spark: SparkSession, d: str) -> DataFrame:
    from slidemill.operators.relational import keep_first

    return keep_first(table(spark, d, "dataset").where("split_version = 'v2' AND image_id <> ''"), ["image_id"], ["row_id"])


def _annotations(spark: SparkSession, d: str) -> DataFrame:
    return A.cell_annotations(_release(spark, d), table(spark, d, "cells"))


@query("cell_annotations", f"WITH {_V2}, {_CELLS} SELECT image_id, cell_type, staining_code, intensity_code, quantity_code FROM ann")
def cell_annotations(spark: SparkSession, d: str) -> DataFrame:
    return _annotations(spark, d).select("image_id", "cell_type", "staining_code", "intensity_code", "quantity_code")


@query("image_annotations", f"""
WITH {_V2}, {_CELLS},
o AS (SELECT antibody_id, ensembl_id, tissue, string_agg(DISTINCT ontology_terms, ';' ORDER BY ontology_terms) AS ontology_terms FROM tissues WHERE ontology_terms <> '' GROUP BY ALL),
g AS (SELECT image_id, count(*) AS n_cell_types, string_agg(cell_type, ';' ORDER BY cell_type) AS cell_types, max(staining_code) AS ms, max(intensity_code) AS mi, max(quantity_code) AS mq FROM ann GROUP BY 1)
SELECT d.image_id, coalesce(q.sex, '') AS sex, coalesce(q.age, '') AS age, coalesce(o.ontology_terms, '') AS ontology_terms, CAST(coalesce(g.n_cell_types, 0) AS INT) AS n_cell_types, coalesce(g.cell_types, '') AS cell_types,
 coalesce(ms, -1) AS max_staining_code, coalesce(mi, -1) AS max_intensity_code, coalesce(mq, -1) AS max_quantity_code, coalesce(ms, -1) > 0 AS protein_detected
FROM v2 d LEFT JOIN o ON d.antibody_id = o.antibody_id AND d.ensembl_id = o.ensembl_id AND d.tissue = o.tissue LEFT JOIN g ON d.image_id = g.image_id
LEFT JOIN (SELECT * FROM image_annotations QUALIFY row_number() OVER (PARTITION BY antibody_id, ensembl_id, tissue, patient_id ORDER BY row_id) = 1) q
 ON d.antibody_id = q.antibody_id AND d.ensembl_id = q.ensembl_id AND d.tissue = q.tissue AND d.patient_id = q.patient_id""")
def image_annotations(spark: SparkSession, d: str) -> DataFrame:
    patients = table(spark, d, "image_annotations").select(*A.SAMPLE_KEY, "patient_id", "sex", "age", "row_id")
    out = A.image_annotations(_release(spark, d), table(spark, d, "cells"), patients, table(spark, d, "tissues"))
    return out.select("image_id", "sex", "age", "ontology_terms", "n_cell_types", "cell_types", "max_staining_code", "max_intensity_code", "max_quantity_code", "protein_detected")


@query("cell_vocabulary", f"""
WITH {_V2}, {_CELLS}
SELECT cell_type, count(DISTINCT image_id) AS n_images, count(DISTINCT antibody_id) AS n_antibodies, count(DISTINCT tissue) AS n_tissues, string_agg(DISTINCT tissue, ';' ORDER BY tissue) AS tissues FROM ann GROUP BY 1""")
def cell_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return A.cell_vocabulary(_annotations(spark, d))


_LOCATIONS = """l AS (SELECT ensembl_id, min_by(subcellular_reliability, row_id) AS r, min_by(subcellular_main_location, row_id) AS m FROM image_annotations
 WHERE ensembl_id <> '' AND subcellular_main_location IS NOT NULL AND subcellular_reliability IS NOT NULL GROUP BY 1)"""


@query("attach_attributes", f"WITH {_LOCATIONS} SELECT d.row_id, coalesce(l.r, '') AS subcellular_reliability, coalesce(l.m, '') AS subcellular_main_location FROM dataset d LEFT JOIN l USING (ensembl_id)")
def attach_attributes(spark: SparkSession, d: str) -> DataFrame:
    ann = table(spark, d, "image_annotations").where("ensembl_id <> '' AND subcellular_main_location IS NOT NULL AND subcellular_reliability IS NOT NULL")
    per_gene = ann.groupBy("ensembl_id").agg(
        F.min_by("subcellular_reliability", "row_id").alias("Reliability"), F.min_by("subcellular_main_location", "row_id").alias("Main location")
    )
    empty = {c: F.lit("") for c in A.LOCATION_COLUMNS if c not in ("Reliability", "Main location")}
    locations = per_gene.withColumnRenamed("ensembl_id", "Gene").withColumns(empty)
    return A.attach_locations(table(spark, d, "dataset"), locations).select("row_id", "subcellular_reliability", "subcellular_main_location")


@query("location_vocabulary", """
WITH x AS (SELECT image_id, ensembl_id, unnest(string_split(subcellular_main_location, ';')) AS location, true AS m FROM image_annotations WHERE subcellular_main_location <> ''
 UNION ALL SELECT image_id, ensembl_id, unnest(string_split(subcellular_additional_location, ';')), false FROM image_annotations WHERE subcellular_additional_location <> '')
SELECT location, count(DISTINCT ensembl_id) FILTER (m) AS n_genes_main, count(DISTINCT ensembl_id) AS n_genes_any, count(DISTINCT image_id) FILTER (m) AS n_images_main, count(DISTINCT image_id) AS n_images_any FROM x GROUP BY 1""")
def location_vocabulary(spark: SparkSession, d: str) -> DataFrame:
    return A.location_vocabulary(table(spark, d, "image_annotations"))


@query("coverage_counts", "SELECT count(*) AS n_rows, count(*) FILTER (subcellular_main_location <> '') AS n_filled, count(DISTINCT ensembl_id) AS n_genes, count(DISTINCT ensembl_id) FILTER (subcellular_main_location <> '') AS n_genes_filled FROM image_annotations")
def coverage_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.coverage(table(spark, d, "image_annotations"), "subcellular_main_location")


@query("key_conflicts", "SELECT antibody_id, tissue, cell_type, count(*) AS n_rows FROM (SELECT DISTINCT antibody_id, tissue, cell_type, staining FROM cells) GROUP BY ALL HAVING count(*) > 1")
def key_conflicts(spark: SparkSession, d: str) -> DataFrame:
    cells = table(spark, d, "cells").select("antibody_id", "tissue", "cell_type", "staining", "row_id")
    return A.key_conflicts(cells, ["antibody_id", "tissue", "cell_type"], "row_id")


# quality

_SHARES = """shares AS (SELECT tissue, s."set", (count(*) FILTER (d."set" = s."set")) / count(*) AS share FROM dataset d, (VALUES ('train'), ('val'), ('test')) s("set") GROUP BY ALL)"""


@query("share_by_index", f"WITH {_SHARES} SELECT * FROM shares")
def share_by_index(spark: SparkSession, d: str) -> DataFrame:
    return Q.share_by_index(table(spark, d, "dataset"))


@query("share_by_column", """SELECT stratum, "set", n / sum(n) OVER (PARTITION BY "set") AS share FROM (SELECT regexp_extract(antibody_id, '^([A-Za-z]+)', 1) AS stratum, "set", count(*) AS n FROM dataset WHERE regexp_matches(antibody_id, '^[A-Za-z]') GROUP BY 1, 2)""")
def share_by_column(spark: SparkSession, d: str) -> DataFrame:
    data = table(spark, d, "dataset").where(F.col("antibody_id").rlike("^[A-Za-z]"))
    return Q.share_by_column(data, id_prefix(F.col("antibody_id")))


@query("max_deviation", f"""
WITH {_SHARES}, e AS (SELECT tissue, "set", share - CASE "set" WHEN 'train' THEN 0.7 WHEN 'val' THEN 0.1 ELSE 0.2 END AS dev FROM shares WHERE tissue IS NOT NULL)
SELECT tissue AS worst_index, "set" AS worst_value, dev AS deviation FROM e ORDER BY round(abs(dev), 9) DESC, tissue DESC, "set" DESC LIMIT 1""")
def max_deviation(spark: SparkSession, d: str) -> DataFrame:
    shares = Q.share_by_index(table(spark, d, "dataset").where("tissue IS NOT NULL"))
    return Q.largest_deviation(shares, "tissue", "set", Q.target_share("set", (0.7, 0.1, 0.2)))


@query("tvd_month", """
WITH c AS (SELECT strftime(released_at, '%Y-%m') AS v, count(*) FILTER ("set" = 'train') AS p, count(*) FILTER ("set" = 'val') AS q FROM dataset WHERE "set" IN ('train', 'val') GROUP BY 1)
SELECT 0.5 * sum(abs(p / tp - q / tq)) AS distance FROM c, (SELECT sum(p) AS tp, sum(q) AS tq FROM c)""")
def tvd_month(spark: SparkSession, d: str) -> DataFrame:
    return Q.variation_distance(table(spark, d, "dataset"), F.date_format("released_at", "yyyy-MM"))


@query("gene_agreement", """
WITH g AS (SELECT DISTINCT CASE WHEN split_version = 'v1' THEN 'a' ELSE 'b' END AS dataset, ensembl_id, "set" FROM dataset WHERE split_version IN ('v1', 'v2') AND "set" IN ('train', 'val', 'test') AND ensembl_id <> ''),
p AS (SELECT dataset, ensembl_id, min("set") AS s FROM g GROUP BY ALL)
SELECT x.dataset AS dataset_a, y.dataset AS dataset_b, count(*) AS n_shared, sum(CASE WHEN x.s <> y.s THEN 1 ELSE 0 END) AS n_different FROM p x JOIN p y USING (ensembl_id) WHERE x.dataset < y.dataset GROUP BY ALL""")
def gene_agreement(spark: SparkSession, d: str) -> DataFrame:
    data = table(spark, d, "dataset").where(F.col("set").isin(*SP.SETS) & (F.col("ensembl_id") != ""))
    return Q.gene_agreement({"a": data.where("split_version = 'v1'"), "b": data.where("split_version = 'v2'")})


@query("disjoint_check", """SELECT sum(CASE WHEN n > 1 THEN 1 ELSE 0 END) AS n_shared FROM (SELECT antibody_id, count(DISTINCT "set") AS n FROM dataset GROUP BY 1)""")
def disjoint_check(spark: SparkSession, d: str) -> DataFrame:
    return Q.disjoint_check(table(spark, d, "dataset"), "antibody_id")


_CHECKS = f"""
WITH {_V2}, ids AS (SELECT DISTINCT antibody_id AS id FROM v2), {_STRATA},
shares AS (SELECT tissue, s."set", (count(*) FILTER (d."set" = s."set")) / count(*) AS share FROM v2 d, (VALUES ('train'), ('val'), ('test')) s("set") GROUP BY ALL),
t AS (SELECT tissue AS i, "set" AS v, share - CASE "set" WHEN 'train' THEN 0.7 WHEN 'val' THEN 0.1 ELSE 0.2 END AS dev FROM shares ORDER BY round(abs(dev), 9) DESC, tissue DESC NULLS LAST, "set" DESC LIMIT 1),
a AS (SELECT d.antibody_id, d."set", strata.s, CASE WHEN regexp_extract(d.antibody_id, '^([A-Za-z]+)', 1) = '' THEN 'other' ELSE regexp_extract(d.antibody_id, '^([A-Za-z]+)', 1) END AS p
  FROM (SELECT DISTINCT antibody_id, "set" FROM v2) d JOIN strata ON strata.id = d.antibody_id),
x AS (SELECT 's' AS kind, s AS i, "set" AS v FROM a UNION ALL SELECT 'p', p, "set" FROM a),
c AS (SELECT kind, i, v, count(*) AS n FROM x GROUP BY ALL),
o AS (SELECT kind, i, sum(n) AS n, sum(sum(n)) OVER (PARTITION BY kind) AS total FROM c GROUP BY kind, i),
e AS (SELECT c.kind, c.i, c.v, c.n / sum(c.n) OVER (PARTITION BY c.kind, c.v) - o.n / o.total AS dev FROM c JOIN o ON c.kind = o.kind AND c.i = o.i),
w AS (SELECT * FROM e QUALIFY row_number() OVER (PARTITION BY kind ORDER BY round(abs(dev), 9) DESC, i DESC NULLS LAST, v DESC NULLS LAST) = 1),
j AS (SELECT * FROM w ORDER BY abs(dev) DESC LIMIT 1)
SELECT 'release' AS dataset, 'valid set' AS "check", n = 0 AS ok, n || ' rows without valid set' AS detail FROM (SELECT count(*) AS n FROM v2 WHERE coalesce("set", '') NOT IN ('train', 'val', 'test'))
UNION ALL SELECT 'release', 'all sets present', n = 3, n || ' sets' FROM (SELECT count(DISTINCT "set") AS n FROM v2 WHERE "set" IN ('train', 'val', 'test'))
UNION ALL SELECT 'release', 'antibodies disjoint', n = 0, n || ' in several sets' FROM (SELECT count(*) AS n FROM (SELECT antibody_id FROM v2 GROUP BY 1 HAVING count(DISTINCT "set") > 1))
UNION ALL SELECT 'release', 'genes disjoint', n = 0, n || ' in several sets' FROM (SELECT count(*) AS n FROM (SELECT ensembl_id FROM v2 GROUP BY 1 HAVING count(DISTINCT "set") > 1))
UNION ALL SELECT 'release', 'tissue shares', abs(dev) <= 0.01, coalesce(i, 'null') || ' in ' || v || printf(': %+.2f pt', dev * 100) FROM t
UNION ALL SELECT 'release', 'strata and source shares', abs(dev) <= 0.015, coalesce(i, 'null') || ' in ' || coalesce(v, 'null') || printf(': %+.2f pt', dev * 100) FROM j"""


@query("check_dataset", _CHECKS)
def check_dataset(spark: SparkSession, d: str) -> DataFrame:
    return Q.check_dataset("release", _release(spark, d))


# the pipeline

_FULL = f"""
base AS (SELECT i.*, m.p AS ftp FROM images i LEFT JOIN (SELECT "Image Name" AS k, arg_max(ftp_path, row_id) AS p FROM idr_ftp_paths WHERE ftp_path <> '' GROUP BY 1) m ON i.image_id || '.tif' = m.k),
f1 AS (SELECT * FROM base WHERE coalesce(ftp, '') <> '' AND coalesce(tissue, '') NOT IN ('Endometrium 2', 'Stomach 2', 'Soft tissue 2', 'Skin 2')),
ok AS (SELECT * FROM antibodies WHERE coalesce("Reliability score", '') <> 'uncertain'),
f2 AS (SELECT * FROM f1 WHERE antibody_id IN (SELECT antibody_id FROM ok WHERE antibody_id IS NOT NULL) AND antibody_id NOT IN (SELECT antibody_id FROM antibodies WHERE antibody_id IS NOT NULL GROUP BY 1 HAVING count(DISTINCT ensembl_id) > 1)),
best AS (SELECT antibody_id FROM ok WHERE antibody_id IN (SELECT antibody_id FROM f2) QUALIFY row_number() OVER (PARTITION BY ensembl_id ORDER BY (CASE "Reliability score" WHEN 'enhanced' THEN 3 WHEN 'supported' THEN 2 WHEN 'approved' THEN 1 END) DESC NULLS LAST, md5('{SEED}:' || antibody_id), antibody_id) = 1),
f3 AS (SELECT * FROM f2 WHERE antibody_id IN (SELECT antibody_id FROM best)),
f4 AS (SELECT * FROM f3 QUALIFY count(*) OVER (PARTITION BY image_id) = 1 OR (tissue = 'Soft tissue 1' AND sum(CASE WHEN tissue = 'Soft tissue 1' THEN 1 ELSE 0 END) OVER (PARTITION BY image_id) = 1))"""
_LABELLED = f"{_FULL}, {_split_sql('SELECT DISTINCT antibody_id AS id FROM f4 WHERE antibody_id IS NOT NULL')}"


def _selected(spark: SparkSession, d: str, log: P.StepLog | None = None) -> DataFrame:
    names = ("images", "antibodies", "idr_ftp_paths")
    images, antibodies, mirror = (table(spark, d, n) for n in names)
    return P.select_images(images, antibodies, mirror, seed=SEED, base_url="https://mirror.example/", log=log)


@query("full_dataset", f"WITH {_LABELLED} SELECT f4.row_id, f4.image_id, f4.tissue, ftp AS idr_ftp_path, 'https://mirror.example/' || ftp AS idr_url, sets.\"set\", 'v2' AS split_version FROM f4 LEFT JOIN sets ON f4.antibody_id = sets.id")
def full_dataset(spark: SparkSession, d: str) -> DataFrame:
    return P.build_full(_selected(spark, d), seed=SEED).select("row_id", "image_id", "tissue", "idr_ftp_path", "idr_url", "set", "split_version")


_PILOT = f"""{_FULL}, t0 AS (SELECT * FROM f4 WHERE tissue IN ({', '.join(f"'{t}'" for t in PILOT_TISSUES)})),
t1 AS (SELECT * FROM t0 QUALIFY NOT (count(*) OVER (PARTITION BY antibody_id, tissue) = 3 AND row_number() OVER (PARTITION BY antibody_id, tissue ORDER BY md5('{SEED}:' || image_id), image_id) = 3)),
t2 AS (SELECT * FROM t1 QUALIFY NOT (count(*) OVER (PARTITION BY antibody_id, tissue) = 2 AND row_number() OVER (PARTITION BY antibody_id, tissue ORDER BY md5('{SEED}:' || image_id), image_id) = 2
  AND CAST('0x' || substr(md5('{SEED}:pair:' || concat_ws('|', antibody_id, tissue)), 1, 8) AS BIGINT) / 4294967296.0 < 0.4))"""


@query("pilot_dataset", f"WITH {_PILOT}, {_split_sql('SELECT DISTINCT antibody_id AS id FROM t2 WHERE antibody_id IS NOT NULL')} SELECT t2.row_id, t2.image_id, t2.tissue, sets.\"set\" FROM t2 LEFT JOIN sets ON t2.antibody_id = sets.id")
def pilot_dataset(spark: SparkSession, d: str) -> DataFrame:
    return P.build_pilot(_selected(spark, d), PILOT_TISSUES, seed=SEED).select("row_id", "image_id", "tissue", "set")


def _count(step: str, name: str, stage: str = "full") -> str:
    return f"SELECT '{stage}' AS stage, '{step}' AS step, count(*) AS images, count(DISTINCT antibody_id) AS antibodies, count(DISTINCT ensembl_id) AS genes, count(DISTINCT tissue) AS tissues FROM {name}"


@query("step_log", f"WITH {_FULL}, " + "src AS (SELECT * FROM base WHERE coalesce(ftp, '') <> ''), unc AS (SELECT * FROM f1 WHERE antibody_id IN (SELECT antibody_id FROM ok WHERE antibody_id IS NOT NULL)) " + " UNION ALL ".join(
    _count(step, name) for step, name in (("crawl", "images"), ("source", "src"), ("no secondary tissues", "f1"), ("no uncertain antibodies", "unc"), ("no multi-target antibodies", "f2"), ("one antibody per gene", "f3"), ("unique image id", "f4"))
))
def step_log(spark: SparkSession, d: str) -> DataFrame:
    log = P.StepLog("full")
    _selected(spark, d, log)
    return log.frame()
