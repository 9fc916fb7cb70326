"""Queries of readers and writers: tables are written as the files that a reader takes, read back, and compared by SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.operators import annotate
from slidemill.operators.folders import parent_folders
from slidemill.operators.quality import check_dataset, year_share
from slidemill.session import scratch
from slidemill.sources import atlas_xml, files, sinks
from slidemill.sources.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
CODE_COLUMN = "Characteristics [Pathology] Accession"
ROOT = "idr9043-tissueatlas/"


def query(name: str, sql: str):  # type: ignore[no-untyped-def]
    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[name], ORACLE[name] = f, sql
        return f

    return register


# tables as CSV, TSV and listings


@query("csv_round_trip", "SELECT CAST(row_id AS VARCHAR) AS row_id, coalesce(image_id, '') AS image_id, coalesce(tissue, '') AS tissue, coalesce(gene_name, '') AS gene_name, CASE WHEN idr_available THEN 'True' WHEN NOT idr_available THEN 'False' ELSE '' END AS idr_available FROM dataset")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "csv")
    sinks.write_csv(table(spark, d, "dataset").select("row_id", "image_id", "tissue", "gene_name", "idr_available"), path, compression="gzip")
    return files.read_csv(spark, path, multiline=True)


_NAMED = """n AS (SELECT row_id, "Image Name" AS name, "Antibody identifier" AS antibody, "Characteristics [Organism Part]" AS part, "Characteristics [Pathology] Accession" AS code, ftp_path FROM idr_ftp_paths)"""
_LISTED = "l AS (SELECT regexp_extract(p, '([^/]*)$', 1) AS name, arg_max(p, row_id) AS ftp_path FROM (SELECT row_id, CASE WHEN contains(ftp_path, '" + ROOT + "') THEN substr(ftp_path, instr(ftp_path, '" + ROOT + "') + 20) ELSE regexp_replace(ftp_path, '^/+', '') END AS p FROM (SELECT row_id, trim(ftp_path) AS ftp_path FROM n WHERE ftp_path IS NOT NULL AND lower(trim(ftp_path)) LIKE '%.tif')) GROUP BY 1)"


@query("mirror_table", f"""WITH {_NAMED}, {_LISTED}
SELECT coalesce(n.name, '') AS name, coalesce(antibody, '') AS antibody, coalesce(part, '') AS part, coalesce(code, '') AS code, coalesce(l.ftp_path, '') AS ftp_path, CASE WHEN row_id % 2 = 0 THEN 'run_a' ELSE 'run_b' END AS run
FROM n LEFT JOIN l ON n.name = l.name WHERE contains(code, '{files.NORMAL_CODE}')""")
def mirror_table(spark: SparkSession, d: str) -> DataFrame:
    paths, folder = table(spark, d, "idr_ftp_paths"), scratch(spark, "mirror")
    for k, name in enumerate(("run_a", "run_b")):
        run = paths.where(F.col("row_id") % 2 == k).select(*(f"`{c}`" for c in files.MIRROR_COLUMNS), F.lit(name).alias("run"), F.col("row_id").alias(f"only_in_{name}"))
        sinks.write_csv(run, f"{folder}/{name}")
    lines = paths.where("ftp_path IS NOT NULL").orderBy("row_id").select("ftp_path")
    lines.write.text(f"{folder}/listing")
    runs = files.read_mirror_runs(spark, [f"{folder}/run_a", f"{folder}/run_b"], (*files.MIRROR_COLUMNS, "run"))
    out = files.attach_listing(runs, files.read_listing(spark, f"{folder}/listing", ROOT))
    return out.select(F.col("Image Name").alias("name"), F.col("Antibody identifier").alias("antibody"), F.col("Characteristics [Organism Part]").alias("part"), F.col(CODE_COLUMN).alias("code"), "ftp_path", "run")


@query("path_map", """WITH s AS (SELECT row_id, ftp_path, regexp_extract(ftp_path, '([^/]*)$', 1) AS base FROM idr_ftp_paths WHERE ftp_path <> '')
SELECT regexp_replace(base, '^(\\.*[^.].*)\\.[^.]*$', '\\1') AS image_id, arg_max(ftp_path, row_id) AS ftp_path FROM s GROUP BY 1""")
def path_map(spark: SparkSession, d: str) -> DataFrame:
    path = scratch(spark, "paths")
    sinks.write_csv(table(spark, d, "idr_ftp_paths").orderBy("row_id").select("Image Name", "ftp_path"), path)
    return files.read_path_map(spark, path)


_LOCATED = ", ".join(f"coalesce({c}, '') AS {c}" for c in annotate.LOCATION_COLUMNS.values())


@query("location_table", f"SELECT ensembl_id, {_LOCATED} FROM image_annotations WHERE ensembl_id <> '' QUALIFY row_number() OVER (PARTITION BY ensembl_id ORDER BY row_id) = 1")
def location_table(spark: SparkSession, d: str) -> DataFrame:
    return _locations(spark, d).withColumnsRenamed({**annotate.LOCATION_COLUMNS, "Gene": "ensembl_id"})


def _locations(spark: SparkSession, d: str) -> DataFrame:
    """The location columns of the annotated images as the TSV that the reader takes."""
    path, named = scratch(spark, "locations"), {v: k for k, v in annotate.LOCATION_COLUMNS.items()}
    rows = table(spark, d, "image_annotations").where("ensembl_id <> ''").orderBy("row_id").select(F.col("ensembl_id").alias("Gene"), *named).withColumnsRenamed(named)
    sinks.write_csv(rows, path, separator="\t")
    return files.read_locations(spark, path, list(annotate.LOCATION_COLUMNS), multiline=True)


@query("attach_locations", f"""WITH g AS (SELECT ensembl_id, {_LOCATED} FROM image_annotations WHERE ensembl_id <> '' QUALIFY row_number() OVER (PARTITION BY ensembl_id ORDER BY row_id) = 1)
SELECT d.row_id, {", ".join(f"coalesce(g.{c}, '') AS {c}" for c in annotate.LOCATION_COLUMNS.values())} FROM dataset d LEFT JOIN g ON d.ensembl_id = g.ensembl_id""")
def attach_locations(spark: SparkSession, d: str) -> DataFrame:
    return annotate.attach_locations(table(spark, d, "dataset").select("row_id", "ensembl_id"), _locations(spark, d)).drop("ensembl_id")


_IN_YEARS = "CASE WHEN left(strftime(released_at, '%Y-%m-%d'), 4) IN ('2019', '2020') THEN 1 ELSE 0 END"


@query("year_share", f"""SELECT "set", 100.0 * avg({_IN_YEARS}) AS percent FROM dataset GROUP BY 1""")
def year_shares(spark: SparkSession, d: str) -> DataFrame:
    return year_share(table(spark, d, "dataset"), F.date_format("released_at", "yyyy"), ["2019", "2020"])


@query("check_years", """
WITH r AS (SELECT left(strftime(released_at, '%Y-%m-%d'), 4) AS y, "set" AS s FROM dataset WHERE "set" IN ('train', 'val', 'test')),
c AS (SELECT y, count(*) FILTER (s = 'train') AS a, count(*) FILTER (s = 'val') AS b, count(*) FILTER (s = 'test') AS c FROM r GROUP BY 1),
t AS (SELECT sum(a) AS ta, sum(b) AS tb, sum(c) AS tc FROM c),
x AS (SELECT greatest(coalesce(0.5 * sum(abs(a / ta - b / tb)), 0), coalesce(0.5 * sum(abs(a / ta - c / tc)), 0)) AS far FROM c, t)
SELECT 'release' AS dataset, 'staining years' AS "check", far <= 0.1 AS ok, printf('distance %.3f', far) AS detail FROM x""")
def check_years(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "dataset").withColumn("stained", F.date_format("released_at", "yyyy-MM-dd"))
    return check_dataset("release", rows, stained="stained").where(F.col("check") == "staining years")


# the XML release: the whole XML entries as one release, read by schema


def _release(spark: SparkSession, d: str) -> DataFrame:
    """The entries of a release that is written of all readable XML payloads in order."""
    path = scratch(spark, "release")
    text = F.rtrim("payload")
    whole = table(spark, d, "raw_entries").where((F.lower(F.trim("fmt")) == "xml") & F.regexp_replace("payload", r"\s+$", "").endswith("</entry>"))
    plain = F.regexp_replace(text, r"^\s*<\?xml.*?\?>\s*", "")
    whole.orderBy("entry_id").select(plain.alias("value")).write.text(path)
    return atlas_xml.read_entries(spark, path)


def _table(name: str, *columns: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, d: str) -> DataFrame:
        out = atlas_xml.tables_of(spark, atlas_xml.antibody_rows(_release(spark, d)))[name]
        return out.select(*(F.col(c).alias(c.lower().replace(" ", "_")) for c in columns)) if columns else out

    return run


_TEXT = "replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&apos;', chr(39)), '&amp;', '&')"


def _inner(source: str, tag: str) -> str:
    return _TEXT.format(f"regexp_extract({source}, '(?s)<{tag}(?:\\s[^>]*)?>(.*?)</{tag}>', 1)")


def _attribute(source: str, tag: str, name: str) -> str:
    return _TEXT.format(f"""regexp_extract({source}, '<{tag}\\s[^>]*?{name}="([^"]*)"', 1)""")


_XML = f"""
WITH x AS (SELECT entry_id, regexp_replace(regexp_replace(payload, '(?s)<!--.*?-->', '', 'g'), '(?s)<!\\[CDATA\\[(.*?)\\]\\]>', '\\1', 'g') AS p FROM raw_entries
  WHERE lower(trim(fmt)) = 'xml' AND regexp_matches(payload, '</entry>\\s*$')),
g AS (SELECT entry_id, p, coalesce(nullif(regexp_extract(p, '<identifier\\s[^>]*db="Ensembl"[^>]*id="([^"]*)"', 1), ''), nullif(regexp_extract(p, '<entry\\s[^>]*url="[^"]*/([^"/]*)"', 1), ''), '') AS ensembl_id,
  {_inner("p", "name")} AS gene_name, list_filter(regexp_extract_all(p, '(?s)<synonym>(.*?)</synonym>', 1), lambda s: s <> '') AS synonyms FROM x),
a0 AS (SELECT *, unnest(regexp_extract_all(p, '(?s)<antibody\\s.*?</antibody>')) AS a, unnest(range(1, 1 + len(regexp_extract_all(p, '(?s)<antibody\\s.*?</antibody>')))) AS a_pos FROM g),
a1 AS (SELECT * EXCLUDE (p), {_attribute("a", "antibody", "id")} AS antibody_id, array_to_string(regexp_extract_all(a, '(?s)<tissueExpression[^>]*assayType="tissue"[^>]*>.*?</tissueExpression>'), '') AS s FROM a0),
b0 AS (SELECT *, unnest(regexp_extract_all(s, '(?s)<data>.*?</data>')) AS b, unnest(range(1, 1 + len(regexp_extract_all(s, '(?s)<data>.*?</data>')))) AS b_pos FROM a1),
b AS (SELECT *, {_inner("b", "tissue")} AS tissue, {_attribute("b", "tissue", "organ")} AS organ, {_attribute("b", "tissue", "ontologyTerms")} AS ontology_terms,
  list_filter(regexp_extract_all(b, '(?s)<patient>.*?</patient>'), lambda p: contains(p, 'snomedCode="M-00100"')) AS ps FROM b0),
k AS (SELECT * FROM b WHERE len(ps) > 0),
ab AS (SELECT DISTINCT entry_id, a_pos, antibody_id, ensembl_id, gene_name, synonyms, s FROM k),
p AS (SELECT *, unnest(ps) AS pt, unnest(range(1, 1 + len(ps))) AS p_pos FROM k),
i0 AS (SELECT *, {_inner("pt", "patientId")} AS patient_id, unnest(regexp_extract_all(pt, '(?s)<image[\\s>].*?</image>')) AS im, unnest(range(1, 1 + len(regexp_extract_all(pt, '(?s)<image[\\s>].*?</image>')))) AS i_pos FROM p),
i AS (SELECT *, CASE WHEN {_inner("im", "imageUrlTif")} <> '' THEN 'tif' WHEN {_inner("im", "imageUrl")} <> '' THEN 'jpg' END AS image_type,
  CASE WHEN {_inner("im", "imageUrlTif")} <> '' THEN {_inner("im", "imageUrlTif")} ELSE {_inner("im", "imageUrl")} END AS image_url FROM i0)
"""
_SCORE = "coalesce(trim(list_filter(regexp_extract_all(s, '(?s)<verification type=\"validation\">(.*?)</verification>', 1), lambda v: trim(v) <> '')[-1], E' \\n\\r\\t'), '')"
_CELLS = f"c AS (SELECT *, unnest(regexp_extract_all(b, '(?s)<tissueCell>.*?</tissueCell>')) AS c FROM k)"


def _level(kind: str) -> str:
    return _TEXT.format(f"""coalesce(regexp_extract_all(c, '(?s)<level type="{kind}">(.*?)</level>', 1)[-1], '')""")


query("atlas_genes", _XML + "SELECT ensembl_id, gene_name AS name, array_to_string(synonyms, ', ') AS synonyms FROM ab WHERE ensembl_id <> '' QUALIFY row_number() OVER (PARTITION BY ensembl_id ORDER BY entry_id, a_pos) = 1")(_table("genes"))
query("atlas_antibodies", _XML + f"SELECT antibody_id, ensembl_id, gene_name, {_SCORE} AS reliability_score FROM ab")(_table("antibodies", "antibody_id", "ensembl_id", "gene_name", "Reliability score"))
query("atlas_tissues", _XML + "SELECT antibody_id, ensembl_id, tissue, organ, ontology_terms FROM k")(_table("tissues"))
query("atlas_cells", _XML + f", {_CELLS} SELECT antibody_id, ensembl_id, tissue, {_inner('c', 'cellType')} AS cell_type, {_level('staining')} AS staining, {_level('intensity')} AS intensity, {_inner('c', 'quantity')} AS quantity, {_inner('c', 'location')} AS location FROM c")(_table("cells"))
query("atlas_patients", _XML + f"SELECT antibody_id, ensembl_id, tissue, {_inner('pt', 'patientId')} AS patient_id, {_inner('pt', 'sex')} AS sex, {_inner('pt', 'age')} AS age FROM p")(_table("patients"))
query("atlas_images", _XML + """, u AS (SELECT *, regexp_replace(regexp_extract(image_url, '([^/]*)$', 1), '\\.[^.]*$', '') AS image_id FROM i WHERE image_type IS NOT NULL)
SELECT antibody_id, ensembl_id, tissue, patient_id, image_id, image_type, image_url FROM u
QUALIFY row_number() OVER (PARTITION BY image_id, patient_id, tissue ORDER BY (CASE WHEN image_type = 'tif' THEN 0 ELSE 1 END), entry_id, a_pos, b_pos, p_pos, i_pos) = 1""")(_table("images", "antibody_id", "ensembl_id", "tissue", "patient_id", "image_id", "image_type", "image_url"))


@query("atlas_folders", _XML + """, f AS (SELECT string_split(image_url, '/')[-2] AS parent, min((entry_id, a_pos, b_pos, p_pos, i_pos)) AS o FROM i WHERE image_type IS NOT NULL GROUP BY 1)
SELECT parent, '202506' || CAST(12 + (row_number() OVER (ORDER BY o, parent) - 1) // 500 AS INT) || '-xml' AS batch FROM f""")
def atlas_folders(spark: SparkSession, d: str) -> DataFrame:
    images = atlas_xml.tables_of(spark, atlas_xml.antibody_rows(_release(spark, d)))["images"]
    return parent_folders(images, spark.createDataFrame([], "image_id string, ftp_path string"))


@query("atlas_counts", _XML + f""", v AS (SELECT sum(len(regexp_extract_all(s, '<verification'))) AS n FROM a1),
l AS (SELECT count(*) AS n FROM (SELECT unnest(regexp_extract_all(b, '(?s)<tissueCell>.*?</tissueCell>')) AS c FROM b) WHERE {_inner("c", "location")} = '')
SELECT (SELECT count(*) FROM x) AS entries, (SELECT sum(len(regexp_extract_all(p, 'assayType="cancer"'))) FROM x) AS cancer_sections, (SELECT n FROM v) AS verifications, (SELECT count(*) FROM b) AS tissues_seen, (SELECT n FROM l) AS cells_without_location,
 (SELECT count(*) FROM ab) AS antibodies, (SELECT count(DISTINCT ensembl_id) FROM ab) AS genes, (SELECT count(*) FROM k) AS tissues, (SELECT count(*) FROM ab WHERE {_SCORE} = '') AS without_reliability,
 count(*) FILTER (image_type = 'tif') AS tif_images, count(*) FILTER (image_type = 'jpg') AS jpg_images, round(100.0 * count(*) FILTER (image_type = 'tif') / count(image_type), 1) AS tif_percent FROM i""")
def atlas_counts(spark: SparkSession, d: str) -> DataFrame:
    return atlas_xml.parse_counts(_release(spark, d))


@query("atlas_documents", _XML + f""", {_CELLS}, n AS (SELECT ensembl_id, count(*) AS n FROM ab GROUP BY 1)
SELECT n.ensembl_id, n.n AS n_antibodies, (SELECT count(*) FROM k WHERE k.ensembl_id = n.ensembl_id) AS n_tissues, (SELECT count(*) FROM c WHERE c.ensembl_id = n.ensembl_id) AS n_cells,
 (SELECT count(*) FROM p WHERE p.ensembl_id = n.ensembl_id) AS n_patients, (SELECT count(*) FROM i WHERE i.ensembl_id = n.ensembl_id AND image_type IS NOT NULL) AS n_images FROM n WHERE n.ensembl_id <> ''""")
def atlas_documents(spark: SparkSession, d: str) -> DataFrame:
    """The gene documents, written as JSON lines and read back, by what each of them holds."""
    path = scratch(spark, "documents")
    docs = atlas_xml.gene_trees(atlas_xml.antibody_rows(_release(spark, d)))
    sinks.write_json_lines(docs, path)
    back = spark.read.schema(docs.schema).json(path)
    tissues = F.flatten(F.transform("antibodies", lambda a: a["tissues"]))
    patients = F.flatten(F.transform(tissues, lambda t: t["patients"]))
    sizes = {
        "n_antibodies": F.col("antibodies"), "n_tissues": tissues, "n_cells": F.flatten(F.transform(tissues, lambda t: t["tissue_cells"])),
        "n_patients": patients, "n_images": F.flatten(F.transform(patients, lambda p: p["images"])),
    }
    return back.select("ensembl_id", *(F.size(v).cast("long").alias(n) for n, v in sizes.items()))


@query("xml_antibodies", _XML + f"SELECT entry_id, antibody_id, ensembl_id, gene_name, {_SCORE} AS reliability_score, (SELECT count(*) FROM k WHERE k.entry_id = ab.entry_id AND k.a_pos = ab.a_pos) AS n_tissues FROM ab")
def xml_antibodies(spark: SparkSession, d: str) -> DataFrame:
    """The XML entries read one by one, the broken ones left out: kept antibodies with their gene, reliability and tissue blocks."""
    records = table(spark, d, "raw_entries").where("fmt = 'xml'").select(F.col("entry_id").alias("ordinal"), F.col("payload").alias("record"))
    kept = atlas_xml.antibody_rows(atlas_xml.parse_entries(records, "PERMISSIVE"))
    return kept.select(F.col("ordinal").alias("entry_id"), "antibody_id", "gene.ensembl_id", F.col("gene.name").alias("gene_name"), "reliability_score", F.size("blocks").cast("long").alias("n_tissues"))
