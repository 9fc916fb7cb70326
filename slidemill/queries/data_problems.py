"""Queries of the general data problems and their SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.functions.identity import antibody_identity, image_identity, mirror_path_identity, month_of, none_if, strip_blank
from slidemill.operators.nested import array_levels, attach_parents, merged_schema, placed, shred
from slidemill.operators.orphans import orphan_references, orphan_report
from slidemill.operators.packed import split_packed
from slidemill.session import cut_lineage
from slidemill.sources.tables import table

PACKED_FIELDS = [
    ("genes", "synonyms"),
    ("tissues", "ontology_terms"),
    ("image_annotations", "cell_types"),
    ("image_annotations", "subcellular_main_location"),
]
#: Paths of an entry's children in both layouts: child, path of the level, field.
ENTRY_CHILDREN = {
    "antibodies.tissues.tissue_cells": ("cells", "cell_type"),
    "antibodies.tissues": ("tissues", "ontology_terms"),
    "antibodies.tissues.patients": ("patients", "patient_id"),
    "antibody.tissue_expression.data.tissue_cell": ("cells", "cell_type"),
    "antibody.tissue_expression.data": ("tissues", "tissue.ontology_terms"),
    "antibody.tissue_expression.data.patient": ("patients", "patient_id"),
}
ENTRY_TABLES = ["cells", "tissues", "patients"]
#: The array levels above them in both layouts; the queries take those of the merged schema.
ENTRY_LEVELS = ["antibodies", "antibody", "antibody.tissue_expression", *ENTRY_CHILDREN]
ENTRY_CARRY = {
    "antibodies.id": "antibody",
    "antibodies.tissues.tissue": "tissue",
    "antibody.id": "antibody",
    "antibody.tissue_expression.data.tissue": "tissue",
    "antibody.tissue_expression.data.tissue.text": "tissue",
}


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    parts = []
    for name, field in PACKED_FIELDS:
        rows = split_packed(table(spark, folder, name), field, ["row_id"], least=2)
        parts.append(rows.select(F.lit(name).alias("src_table"), F.lit(field).alias("field"), "row_id", "pos", "val"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def p4_unquoted(spark: SparkSession, folder: str) -> DataFrame:
    """Values with a delimiter that stand elsewhere without quotes: kept whole where another delimiter separates them, else cut."""
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(F.col("n_nationkey").cast("long").alias("key"), "n_name", "r_name")
    forms = {
        0: F.concat_ws("", F.lit('"'), "n_name", F.lit(", "), "r_name", F.lit('"')),
        100: F.concat_ws("", F.lit('"'), "n_name", F.lit("; "), "r_name", F.lit('"')),
        200: F.concat_ws("", "n_name", F.lit(", "), "r_name", F.lit("; "), F.col("key").cast("string")),
        300: F.concat_ws("; ", "n_name", "r_name", F.col("key").cast("string")),
        400: F.concat_ws(", ", "n_name", "r_name"),
    }
    rows = [places.select((F.col("key") + k).alias("row_id"), text.alias("places")) for k, text in forms.items()]
    return split_packed(reduce(DataFrame.unionByName, rows), "places", ["row_id"])


def entry_tables(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of every table of the raw entries that leads to cells, tissues and patients, with keys and own fields; stored, as it is read several times.

    Which tables there are, how deep they are and which fields stand in them is told by the
    merged schema of all entries; a level that is nowhere an array has no table, and its fields
    stand in its parent's rows.
    """
    entries = table(spark, folder, "raw_entries").withColumn("record", F.monotonically_increasing_id())
    levels = array_levels(merged_schema(entries))
    places: dict[str, list[tuple[str, str]]] = {}
    for path, name in [(f"{path}.{field}", child) for path, (child, field) in ENTRY_CHILDREN.items()] + list(ENTRY_CARRY.items()):
        places.setdefault(name, []).append(placed(path, levels))
    wanted: dict[str, list[str]] = {}
    for level, field in (p for found in places.values() for p in found):
        wanted.setdefault(level, []).append(field)
        for x in levels:
            if level.startswith(f"{x}."):
                wanted.setdefault(x, [])
    depth = F.lit(0)
    for level in wanted:
        depth = F.when(F.col("path") == level, sum(level == x or level.startswith(f"{x}.") for x in levels)).otherwise(depth)

    def own(name: str) -> Column:
        return F.coalesce(*(F.when(F.col("path") == level, F.col("fields")[field]) for level, field in places[name]))

    rows = shred(entries, levels=levels, wanted=wanted, record="record").select(
        F.col("entry").alias("entry_id"), "row_key", "parent_key", depth.alias("depth"),
        F.coalesce(antibody_identity(own("antibody")), strip_blank(own("antibody"))).alias("antibody_id"),
        strip_blank(own("tissue")).alias("tissue"),
        *(none_if(strip_blank(own(child))).alias(child) for child in ENTRY_TABLES),
    )
    return cut_lineage(rows)


def entry_children(spark: SparkSession, folder: str) -> DataFrame:
    """The flat tables cells, tissues and patients of the raw entries, in one frame with their keys; antibody and tissue come down from their parents' rows."""
    rows = entry_tables(spark, folder)
    parts: list[DataFrame] = []
    for (depth,) in sorted(rows.select("depth").distinct().collect()):
        part = rows.where(F.col("depth") == depth)
        parts.append(attach_parents(part, parts[-1], ["antibody_id", "tissue"]) if parts else part)
    out = reduce(DataFrame.unionByName, parts, rows.where("false"))
    items = F.explode(F.array(*(F.struct(F.lit(c).alias("child"), F.col(c).alias("item")) for c in ENTRY_TABLES))).alias("i")
    return out.select("entry_id", "antibody_id", "tissue", "row_key", "parent_key", items).select("i.child", "entry_id", "antibody_id", "tissue", "i.item", "row_key", "parent_key")


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    rows = entry_children(spark, folder).where(F.col("item").isNotNull())
    return rows.select("child", "entry_id", "antibody_id", "tissue", "item").distinct()


def p5_tables(spark: SparkSession, folder: str) -> DataFrame:
    """How often every row of the flat tables occurs."""
    rows = entry_children(spark, folder).where(F.col("item").isNotNull())
    return rows.groupBy("child", "entry_id", "antibody_id", "tissue", "item").agg(F.count(F.lit(1)).alias("n"))


def references(spark: SparkSession, folder: str) -> DataFrame:
    paths, data = table(spark, folder, "idr_ftp_paths"), table(spark, folder, "dataset")

    def of(df: DataFrame, field: str, key, prefix: str, moment: str) -> DataFrame:
        return df.select(F.lit(field).alias("ref_field"), F.concat(F.lit(prefix), key).alias("key"), month_of(F.col(moment)).alias("period"))

    return (
        of(paths, "idr_ftp_paths.ftp_path", image_identity(F.col("ftp_path")), "image:", "listed_at")
        .unionByName(of(data, "dataset.image_id", image_identity(F.col("image_id")), "image:", "released_at"))
        .unionByName(of(data, "dataset.idr_url", mirror_path_identity(F.col("idr_url")), "path:", "released_at"))
    )


def reference_targets(spark: SparkSession, folder: str) -> DataFrame:
    images, paths = table(spark, folder, "images"), table(spark, folder, "idr_ftp_paths")
    gone = F.lower(strip_blank(F.col("download_status"))).isin("withdrawn", "deleted")
    image = F.coalesce(image_identity(F.col("image_id")), image_identity(F.col("image_url")))
    return images.select(
        F.concat(F.lit("image:"), image).alias("key"), month_of(F.col("crawled_at")).alias("first_period"), (~F.coalesce(gone, F.lit(False))).alias("alive")
    ).unionByName(
        paths.select(F.concat(F.lit("path:"), mirror_path_identity(F.col("ftp_path"))).alias("key"), month_of(F.col("listed_at")).alias("first_period"), F.lit(True).alias("alive"))
    )


def orphans(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_references(references(spark, folder), reference_targets(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    image = F.element_at(F.split(F.regexp_replace("key", "^[a-z]+:", ""), "/"), -1)
    return orphans(spark, folder).select("ref_field", image.alias("image_id"), "period").distinct()


def p7_report(spark: SparkSession, folder: str) -> DataFrame:
    return orphan_report(orphans(spark, folder))


def p7_malformed(spark: SparkSession, folder: str) -> DataFrame:
    """References that are not empty but no id either, per field and month; they name no record, so they are no orphans."""
    paths, data = table(spark, folder, "idr_ftp_paths"), table(spark, folder, "dataset")
    parts = []
    for df, field, identity, moment in ((paths, "ftp_path", image_identity, "listed_at"), (data, "image_id", image_identity, "released_at"), (data, "idr_url", mirror_path_identity, "released_at")):
        odd = df.where((strip_blank(F.col(field)) != "") & identity(F.col(field)).isNull())
        name = ("idr_ftp_paths." if df is paths else "dataset.") + field
        parts.append(odd.groupBy(month_of(F.col(moment)).alias("period")).agg(F.lit(name).alias("ref_field"), F.count(F.lit(1)).alias("n_references")))
    return reduce(DataFrame.unionByName, parts).select("ref_field", "period", "n_references")


def p5_schema(spark: SparkSession, folder: str) -> DataFrame:
    return merged_schema(table(spark, folder, "raw_entries"))


QUERIES = {"p4_found": p4_found, "p4_unquoted": p4_unquoted, "p5_found": p5_found, "p5_tables": p5_tables, "p5_schema": p5_schema, "p7_found": p7_found, "p7_report": p7_report, "p7_malformed": p7_malformed}

_SPLIT = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS src_table, '{field}' AS field, row_id, unnest(range(1, len(v) + 1)) AS pos, unnest(v) AS val FROM (
  SELECT row_id, list_filter(list_transform(
      regexp_extract_all(regexp_replace(trim({field}, E' \\t\\n'), '^\\[(.*)\\]$', '\\1', 's'),
        '"(?:[^"\\\\]|""|\\\\.)*"|[^;,|\\n\\t；/"]+(?:/[^;,|\\n\\t；/"\\s][^;,|\\n\\t；/"]*)*'),
      lambda x: trim(regexp_replace(regexp_replace(trim(x, E' \\t\\n'), '^"(.*)"$', '\\1', 's'), '""|\\\\"', '"', 'g'), E' \\t\\n')), lambda x: x <> '') AS v
  FROM {name}) WHERE len(v) >= 2"""
    for name, field in PACKED_FIELDS
)
_IMAGE = r"upper(regexp_extract(regexp_replace({0}, '(?i)%5f', '_', 'g'), '([0-9]+_[A-Za-z]_[0-9]+_[0-9]+)(?:\.[A-Za-z]+)?(?:[?#].*)?\s*$', 1))"
_PATH = r"""(CASE WHEN regexp_matches(regexp_replace({0}, '(?i)%5f', '_', 'g'), '[0-9]+_[A-Za-z]_[0-9]+_[0-9]+') THEN
 lower(regexp_extract(regexp_replace(regexp_replace({0}, '(?i)%2d', '-', 'g'), '[/\\]+', '/', 'g'), '([^/\s]+/[^/\s]+)/[^/]*$', 1)) || '/' || """ + _IMAGE + " END)"
_ORPHANS = f"""
WITH refs AS (
  SELECT 'idr_ftp_paths.ftp_path' AS ref_field, 'image:' || nullif({_IMAGE.format("ftp_path")}, '') AS key, strftime(listed_at, '%Y-%m') AS period FROM idr_ftp_paths
  UNION ALL SELECT 'dataset.image_id', 'image:' || nullif({_IMAGE.format("image_id")}, ''), strftime(released_at, '%Y-%m') FROM dataset
  UNION ALL SELECT 'dataset.idr_url', 'path:' || nullif({_PATH.format("idr_url")}, ''), strftime(released_at, '%Y-%m') FROM dataset
), targets AS (
  SELECT key, min(p) AS first_period, bool_or(alive) AS alive FROM (
    SELECT 'image:' || coalesce(nullif({_IMAGE.format("image_id")}, ''), nullif({_IMAGE.format("image_url")}, '')) AS key, strftime(crawled_at, '%Y-%m') AS p,
      coalesce(lower(trim(download_status)), '') NOT IN ('withdrawn', 'deleted') AS alive FROM images
    UNION ALL SELECT 'path:' || nullif({_PATH.format("ftp_path")}, ''), strftime(listed_at, '%Y-%m'), true FROM idr_ftp_paths)
  WHERE key IS NOT NULL GROUP BY key
), orphans AS (
  SELECT r.*, CASE WHEN t.key IS NULL THEN 'missing' WHEN NOT t.alive THEN 'gone' ELSE 'later' END AS reason
  FROM refs r LEFT JOIN targets t USING (key)
  WHERE r.key IS NOT NULL AND (t.key IS NULL OR NOT t.alive OR t.first_period > r.period)
)"""

_STRIP = r"regexp_replace({0}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"
_SNAKE = "payload"
for _camel, _snake in (("cellType", "cell_type"), ("tissueCells", "tissue_cells"), ("ontologyTerms", "ontology_terms"), ("patientId", "patient_id")):
    _SNAKE = f"replace({_SNAKE}, '{_camel}', '{_snake}')"


def _items(x: str) -> str:
    """A JSON value as a list: an array's items, an object alone, and what a text of JSON holds."""
    plain = "CASE json_type({0}) WHEN 'ARRAY' THEN CAST({0} AS JSON[]) WHEN 'OBJECT' THEN [{0}] ELSE [] END"
    return f"CASE WHEN json_type({x}) = 'VARCHAR' THEN {plain.format(f'CAST({x} ->> chr(36) AS JSON)')} ELSE {plain.format(x)} END"


_AB = r"""CASE WHEN regexp_matches({0}, '^[^A-Za-z0-9]*[A-Za-z]{{3}}[^A-Za-z0-9]*[0-9]+[^A-Za-z0-9]*$') THEN
 upper(regexp_extract({0}, '([A-Za-z]{{3}})', 1)) || regexp_extract({0}, '[A-Za-z]{{3}}[^A-Za-z0-9]*0*([0-9]+)', 1) ELSE trim({0}) END"""
_PLAIN = "replace(replace(replace(replace(replace({0}, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&apos;', chr(39)), '&amp;', '&')"
_CHILDREN = f"""
WITH j AS (SELECT entry_id, CASE WHEN json_valid(payload) THEN CAST({_SNAKE} AS JSON) END AS d FROM raw_entries WHERE lower(trim(fmt)) = 'json'),
ja AS (SELECT entry_id, d -> '$.antibodies' AS a, json_exists(d, '$.antibodies.id') OR json_exists(d, '$.antibodies.tissues') AS alone FROM j WHERE d IS NOT NULL),
jk AS (SELECT entry_id, a, unnest(json_keys(a)) AS k FROM ja WHERE json_type(a) = 'OBJECT' AND NOT alone),
jb AS (SELECT entry_id, x ->> '$.id' AS ab, x -> '$.tissues' AS t FROM (SELECT entry_id, unnest({_items("a")}) AS x FROM ja WHERE alone OR json_type(a) <> 'OBJECT')
  UNION ALL SELECT entry_id, k, a -> ('$."' || k || '".tissues') FROM jk),
jt AS (SELECT entry_id, ab, unnest({_items("t")}) AS t FROM jb),
x AS (SELECT entry_id, regexp_replace(regexp_replace(payload, '(?s)<!--.*?-->', '', 'g'), '(?s)<!\\[CDATA\\[(.*?)\\]\\]>', '\\1', 'g') AS p FROM raw_entries
  WHERE lower(trim(fmt)) = 'xml' AND ends_with(rtrim(payload, E' \\n\\r\\t'), '</entry>')),
xa AS (SELECT entry_id, unnest(regexp_extract_all(p, '(?s)<antibody\\s.*?</antibody>')) AS a FROM x),
xd AS (SELECT entry_id, regexp_extract(a, '<antibody[^>]*?\\sid="([^"]*)"', 1) AS ab, unnest(regexp_extract_all(a, '(?s)<data[\\s>].*?</data>')) AS d FROM xa),
xt AS (SELECT *, regexp_extract(d, '(?s)<tissue(?:\\s[^>]*)?>(.*?)</tissue>', 1) AS tissue, regexp_extract(d, '<tissue\\s[^>]*?ontologyTerms="([^"]*)"', 1) AS terms FROM xd),
c AS (
  SELECT 'cells' AS child, entry_id, ab, t ->> '$.tissue' AS tissue, i ->> '$.cell_type' AS item FROM (SELECT *, unnest({_items("(t -> '$.tissue_cells')")}) AS i FROM jt)
  UNION ALL SELECT 'tissues', entry_id, ab, t ->> '$.tissue', t ->> '$.ontology_terms' FROM jt
  UNION ALL SELECT 'patients', entry_id, ab, t ->> '$.tissue', i ->> '$.patient_id' FROM (SELECT *, unnest({_items("(t -> '$.patients')")}) AS i FROM jt)
  UNION ALL SELECT 'cells', entry_id, ab, {_PLAIN.format("tissue")}, {_PLAIN.format("i")} FROM (SELECT *, unnest(regexp_extract_all(d, '(?s)<cellType>(.*?)</cellType>', 1)) AS i FROM xt)
  UNION ALL SELECT 'tissues', entry_id, ab, {_PLAIN.format("tissue")}, {_PLAIN.format("terms")} FROM xt
  UNION ALL SELECT 'patients', entry_id, ab, {_PLAIN.format("tissue")}, {_PLAIN.format("i")} FROM (SELECT *, unnest(regexp_extract_all(d, '(?s)<patientId>(.*?)</patientId>', 1)) AS i FROM xt)
), s AS (SELECT child, entry_id, {_AB.format("ab")} AS antibody_id, {_STRIP.format("tissue")} AS tissue, nullif({_STRIP.format("item")}, '') AS item FROM c)
"""

ORACLE = {
    "p5_found": _CHILDREN + "SELECT DISTINCT * FROM s WHERE item IS NOT NULL",
    "p5_tables": _CHILDREN + "SELECT child, entry_id, antibody_id, tissue, item, count(*) AS n FROM s WHERE item IS NOT NULL GROUP BY ALL",
    "p4_found": _SPLIT,
    "p4_unquoted": """
WITH p AS (SELECT CAST(n_nationkey AS BIGINT) AS k, n_name AS n, r_name AS r, CAST(n_nationkey AS VARCHAR) AS t FROM nation JOIN region ON n_regionkey = r_regionkey),
v AS (SELECT k AS row_id, [n || ', ' || r] AS v FROM p UNION ALL SELECT k + 100, [n || '; ' || r] FROM p UNION ALL SELECT k + 200, [n || ', ' || r, t] FROM p
 UNION ALL SELECT k + 300, [n, r, t] FROM p UNION ALL SELECT k + 400, [n, r] FROM p)
SELECT row_id, unnest(range(1, len(v) + 1)) AS pos, unnest(v) AS val FROM v""",
    "p7_found": _ORPHANS + " SELECT DISTINCT ref_field, regexp_extract(key, '([^/:]+)$', 1) AS image_id, period FROM orphans",
    "p7_malformed": " UNION ALL ".join(
        f"SELECT '{name}.{field}' AS ref_field, strftime({moment}, '%Y-%m') AS period, count(*) AS n_references FROM {name} WHERE {_STRIP.format(field)} <> '' AND nullif({identity.format(field)}, '') IS NULL GROUP BY 2"
        for name, field, moment, identity in (("idr_ftp_paths", "ftp_path", "listed_at", _IMAGE), ("dataset", "image_id", "released_at", _IMAGE), ("dataset", "idr_url", "released_at", _PATH))
    ),
    "p7_report": _ORPHANS + " SELECT ref_field, period, reason, count(*) AS n_references, count(DISTINCT key) AS n_keys FROM orphans GROUP BY ALL",
}
