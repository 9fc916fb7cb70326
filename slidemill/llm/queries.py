"""Queries of the training-data problems and their SQL."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.functions.identity import (
    antibody_identity,
    gene_identity,
    image_identity,
    label_identity,
    normal_value,
    version_identity,
)
from slidemill.llm.containers import TOKENIZERS, fill_containers, token_counts
from slidemill.llm.encoding import fitted_models, garbled_documents, repair_text
from slidemill.llm.frequency import mark_useless, tokens_of, value_frequencies
from slidemill.llm.leakage import leaked_passages, without_leaks
from slidemill.llm.representative import Bundle, Dependency, Representatives, best_representatives, duplicate_classes, duplicate_pairs, flat_survivors, resolve_by_name
from slidemill.llm.sampling import raised, rate_table, stable_sample
from slidemill.llm.splits import balanced_splits, related_groups, share_report
from slidemill.session import cut_lineage
from slidemill.sources.tables import table

CELL_FIELDS = ["cell_type", "intensity", "quantity"]
#: Shares of the images of a label that are sampled: those stored with the first release, and those wanted now.
FIRST_RATES = {"train": 0.05, "val": 0.2, "test": 0.2}
SAMPLE_RATES = {"train": 0.1, "val": 0.1, "test": 0.25}
SALT = "release"
#: Trust in a reliability score, higher is better.
RELIABILITY_TRUST = {"enhanced": 3, "supported": 2, "approved": 2, "uncertain": 1}
SPLIT_SHARES = {"train": 0.7, "val": 0.1, "test": 0.2}
#: How far a tissue may be off its shares, and the rows that make it large.
TISSUE_POINTS, TISSUE_ROWS = 0.01, 300
#: Capacity of a container in tokens, and the vocabulary that measures them.
CONTAINER_TOKENS = 2048
VOCABULARY = "byte_bpe_50k.tiktoken"


def p1_frequencies(spark: SparkSession, folder: str) -> DataFrame:
    cells = table(spark, folder, "cells")
    counts = value_frequencies(tokens_of(cells, {f: normal_value(F.col(f)) for f in CELL_FIELDS}, antibody_identity(F.col("antibody_id"))))
    n_rows = cells.agg(F.count("*")).scalar()
    out = mark_useless(counts, n_rows)
    return out.select("field", "val", F.col("occurrences").alias("n_rows"), F.col("records").alias("n_antibodies"), "mark")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return p1_frequencies(spark, folder).where(F.col("mark").isNotNull()).select("field", "val", "mark")


def image_choices(spark: SparkSession, folder: str) -> DataFrame:
    """The images of the dataset sampled by label, with the labels that they were chosen for before and are chosen for now."""
    data = table(spark, folder, "dataset")
    label, version = label_identity(F.col("set")), version_identity(F.col("split_version"))
    earlier = F.array_compact(F.array(label_identity(F.col("set_v1")), F.when(version == "v1", label)))
    current = F.array_compact(F.array(F.when(version == "v2", label)))
    thresholds = raised(rate_table(spark, FIRST_RATES), rate_table(spark, SAMPLE_RATES))
    out = stable_sample(data, image_identity(F.col("image_id")), earlier, current, thresholds, salt=SALT)
    return out.withColumnRenamed("sample_key", "image_id")


def p2_sample(spark: SparkSession, folder: str) -> DataFrame:
    out = image_choices(spark, folder).drop("moved", "lost")
    return out.withColumns({c: F.array_join(c, ",") for c in ("earlier", "current")})


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    # an image's choice is its label, and its place in the sample if it had one: val is wanted at a lower
    # rate than stored, so thresholds that were not raised would lose images and report them here
    return image_choices(spark, folder).where("moved OR lost").select("image_id")


def image_bundles() -> list[Bundle]:
    status = F.lower(F.trim(F.col("download_status")))
    fetched = F.when(status == "downloaded", 3).when(status == "ftp_available", 2).when(status == "pending", 1).otherwise(0)
    return [
        Bundle("target", ("antibody_id", "ensembl_id", "gene_name"), F.when(gene_identity(F.col("ensembl_id")).isNotNull(), 2)),
        Bundle("place", ("tissue", "organ")),
        Bundle("patient", ("patient_id",), F.when(F.col("patient_id").rlike("^[0-9]+$"), 1)),
        Bundle("file", ("image_type", "image_url", "local_path"), F.when(F.lower("image_type") == "tif", 2)),
        Bundle("download", ("download_status", "download_date", "file_size", "url_used"), fetched),
    ]


def image_groups(spark: SparkSession, folder: str) -> Representatives:
    images = table(spark, folder, "images")
    group = F.coalesce(image_identity(F.col("image_id")), image_identity(F.col("image_url")))
    same_file = Dependency("file", ("image_type",), "download", ("download_date", "file_size", "url_used"))
    return best_representatives(images, group, "row_id", image_bundles(), [same_file], F.col("crawled_at"))


def antibody_bundles() -> list[Bundle]:
    score = F.lower(F.trim(F.col("Reliability score")))
    trust = F.lit(0)
    for name, level in RELIABILITY_TRUST.items():
        trust = F.when(score == name, level).otherwise(trust)
    return [
        Bundle("gene", ("ensembl_id",), F.when(F.length("ensembl_id") == 15, 1)),
        Bundle("name", ("gene_name",)),
        Bundle("spelling", ("antibody_id",), F.when(F.col("antibody_id") == antibody_identity(F.col("antibody_id")), 1)),
        Bundle("reliability", ("Reliability score",), trust),
    ]


def antibody_groups(spark: SparkSession, folder: str) -> Representatives:
    antibodies = table(spark, folder, "antibodies")
    named = resolve_by_name(antibodies, gene_identity(F.col("ensembl_id")), F.col("gene_name"), "gene")
    group = F.concat_ws("/", antibody_identity(F.col("antibody_id")), F.col("gene"))
    known = antibody_identity(F.col("antibody_id")).isNotNull() & F.col("gene").isNotNull()
    of_gene = [Dependency("gene", ("ensembl_id",), "name", ("gene_name",)), Dependency("gene", ("ensembl_id",), "reliability", ("Reliability score",))]
    return best_representatives(named, F.when(known, group), "row_id", antibody_bundles(), of_gene, F.col("updated_at"))


def p3_images(spark: SparkSession, folder: str) -> DataFrame:
    return flat_survivors(image_groups(spark, folder).survivors, image_bundles(), "image_key")


def p3_antibodies(spark: SparkSession, folder: str) -> DataFrame:
    return flat_survivors(antibody_groups(spark, folder).survivors, antibody_bundles(), "antibody_gene")


def p3_classes(spark: SparkSession, folder: str) -> DataFrame:
    """One row per repeated row: its class and the number of its duplicates, the form that does not grow with their pairs."""
    parts = [duplicate_classes(groups(spark, folder)).withColumn("src_table", F.lit(name)) for name, groups in GROUPS.items()]
    return parts[0].unionByName(parts[1]).withColumnRenamed("row_key", "row_id")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    # the survivors are built and stored whole; the pairs are read from what each of them stands for
    parts = [duplicate_pairs(groups(spark, folder)).withColumn("src_table", F.lit(name)) for name, groups in GROUPS.items()]
    return parts[0].unionByName(parts[1])


GROUPS = {"images": image_groups, "antibodies": antibody_groups}


def antibody_links(spark: SparkSession, folder: str) -> DataFrame:
    """The v2 rows of the dataset, counted by canonical antibody, gene, label and tissue; stored, as it is read several times."""
    rows = table(spark, folder, "dataset").where(version_identity(F.col("split_version")) == "v2")
    named = rows.select(
        antibody_identity(F.col("antibody_id")).alias("antibody_id"),
        gene_identity(F.col("ensembl_id")).alias("ensembl_id"),
        label_identity(F.col("set")).alias("label"),
        normal_value(F.col("tissue")).alias("tissue"),
    )
    counted = named.groupBy(*named.columns).agg(F.count("*").alias("weight"))
    return cut_lineage(counted.where(F.col("antibody_id").isNotNull()))


def antibody_components(links: DataFrame) -> DataFrame:
    return related_groups(links, F.col("antibody_id"), F.col("ensembl_id")).withColumnRenamed("owner", "antibody_id")


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    links = antibody_links(spark, folder)
    groups = antibody_components(links)
    # a component needs new labels, as a whole, where its antibodies carry several
    labels = links.where(F.col("label").isNotNull()).select("antibody_id", "label").distinct().join(groups, "antibody_id")
    torn = labels.groupBy("component").agg(F.countDistinct("label").alias("n")).where("n > 1").select("component")
    return groups.join(torn, "component", "left_semi").select("antibody_id")


def split_weights(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    links = antibody_links(spark, folder)
    groups = cut_lineage(antibody_components(links))
    weights = links.groupBy("antibody_id", "tissue").agg(F.sum("weight").alias("weight")).join(groups, "antibody_id")
    return groups, weights.select("component", F.col("tissue").alias("stratum"), "weight", "antibody_id")


def p6_splits(spark: SparkSession, folder: str) -> DataFrame:
    groups, weights = split_weights(spark, folder)
    return groups.join(balanced_splits(weights, SPLIT_SHARES), "component").select("antibody_id", "component", "split")


def p6_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Per tissue: its rows, the largest deviation of its shares, the least that whole components allow, and whether it is within a point or that."""
    _, weights = split_weights(spark, folder)
    report = share_report(weights, balanced_splits(weights, SPLIT_SHARES), SPLIT_SHARES)
    return report.select(F.col("stratum").alias("tissue"), F.col("weight").cast("long").alias("n_rows"), "deviation", "bound", (F.col("deviation") <= F.greatest(F.lit(TISSUE_POINTS), F.col("bound") * (1 + 1e-9))).alias("ok"))


def p6_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Counts that prove the splits: everything has one, nothing related is torn, and no tissue of many rows is off by over a point."""
    groups, weights = split_weights(spark, folder)
    splits = cut_lineage(balanced_splits(weights, SPLIT_SHARES))
    links = antibody_links(spark, folder).join(groups, "antibody_id", "left").join(splits, "component", "left")

    def torn(key: str) -> DataFrame:
        per_key = links.where(F.col(key).isNotNull()).groupBy(key).agg(F.countDistinct("split").alias("s"))
        return per_key.agg(F.lit(f"{key} in several splits").alias("check"), F.count(F.when(F.col("s") > 1, 1)).alias("n"))

    report = share_report(weights, splits, SPLIT_SHARES)
    overall = share_report(weights.withColumn("stratum", F.lit("all")), splits, SPLIT_SHARES)
    off = F.col("deviation") > F.greatest(F.lit(TISSUE_POINTS), F.col("bound") + 1e-9)
    out = links.agg(F.lit("rows with a split").alias("check"), F.coalesce(F.sum(F.when(F.col("split").isNotNull(), F.col("weight"))), F.lit(0)).alias("n"))
    out = out.unionByName(torn("antibody_id")).unionByName(torn("ensembl_id"))
    out = out.unionByName(overall.agg(F.lit("all rows off by over a point").alias("check"), F.count(F.when(off, 1)).alias("n")))
    out = out.unionByName(report.agg(F.lit("tissues").alias("check"), F.count("*").alias("n")))
    large = F.when(off & (F.col("weight") >= TISSUE_ROWS), 1)
    return out.unionByName(report.agg(F.lit("large tissues off by over a point").alias("check"), F.count(large).alias("n")))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    sizes = token_counts(documents, "doc_id", "text", f"{TOKENIZERS}/{VOCABULARY}")
    return fill_containers(sizes, "doc_id", "tokens", CONTAINER_TOKENS, n_items=documents.count())


def p8_checks(spark: SparkSession, folder: str) -> DataFrame:
    """Counts that prove the containers: every document whole in them, none over its capacity, hardly any room left."""
    documents = table(spark, folder, "documents")
    sizes = cut_lineage(token_counts(documents, "doc_id", "text", f"{TOKENIZERS}/{VOCABULARY}"))
    pieces = cut_lineage(fill_containers(sizes, "doc_id", "tokens", CONTAINER_TOKENS))
    per_document = pieces.groupBy("doc_id").agg(F.sum("size").alias("placed"), F.count("*").alias("n_pieces"))
    least = F.greatest(F.ceil(F.col("tokens") / F.lit(CONTAINER_TOKENS)), F.lit(1))
    placed = sizes.join(per_document, "doc_id", "left")
    filled = pieces.where("size > 0").groupBy("container").agg(F.sum("size").alias("used"))
    slack = F.count("*") * CONTAINER_TOKENS - F.coalesce(F.sum("used"), F.lit(0))
    # what may be left over: a container and a fiftieth
    much = slack > CONTAINER_TOKENS + F.count("*") * CONTAINER_TOKENS / 50
    return (
        placed.agg(F.lit("documents").alias("check"), F.count("*").alias("n"))
        .unionByName(placed.agg(F.lit("documents not whole").alias("check"), F.count(F.when(~F.coalesce(F.col("tokens") == F.col("placed"), F.lit(False)), 1)).alias("n")))
        .unionByName(placed.agg(F.lit("documents cut without need").alias("check"), F.count(F.when(F.col("n_pieces") > least, 1)).alias("n")))
        .unionByName(filled.agg(F.lit("containers over capacity").alias("check"), F.count(F.when(F.col("used") > CONTAINER_TOKENS, 1)).alias("n")))
        .unionByName(filled.agg(F.lit("much room left").alias("check"), much.cast("long").alias("n")))
    )


def p9_passages(spark: SparkSession, folder: str) -> DataFrame:
    return leaked_passages(table(spark, folder, "documents"), table(spark, folder, "eval_items"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return p9_passages(spark, folder).select("doc_id", "item_id")


def p9_clean(spark: SparkSession, folder: str) -> DataFrame:
    """The documents that stay after the leaks are removed."""
    return without_leaks(table(spark, folder, "documents").select("doc_id", "lang", "source"), p9_passages(spark, folder))


QUERIES = {
    "p1_found": p1_found,
    "p1_frequencies": p1_frequencies,
    "p2_found": p2_found,
    "p2_sample": p2_sample,
    "p3_found": p3_found,
    "p3_images": p3_images,
    "p3_antibodies": p3_antibodies,
    "p3_classes": p3_classes,
    "p6_found": p6_found,
    "p6_splits": p6_splits,
    "p6_shares": p6_shares,
    "p6_checks": p6_checks,
    "p8_containers": p8_containers,
    "p8_checks": p8_checks,
    "p9_found": p9_found,
    "p9_passages": p9_passages,
    "p9_clean": p9_clean,
}

_NORMAL = r"lower(trim(regexp_replace({0}, '[\s\p{{Z}}\x{{0B}}\x{{85}}]+', ' ', 'g')))"
_ANTIBODY = r"""CASE WHEN regexp_matches({0}, '^[^A-Za-z0-9]*[A-Za-z]{{3}}[^A-Za-z0-9]*[0-9]+[^A-Za-z0-9]*$') THEN
 upper(regexp_extract({0}, '([A-Za-z]{{3}})', 1)) || regexp_extract({0}, '[A-Za-z]{{3}}[^A-Za-z0-9]*0*([0-9]+)', 1) END"""
_GENE = r"nullif(upper(regexp_extract({0}, '^\s*([Ee][Nn][Ss][Gg][0-9]{{11}})(?:\.[0-9]+)?\s*$', 1)), '')"
_IMAGE = r"nullif(upper(regexp_extract({0}, '(?:^|[^0-9A-Za-z])([0-9]+_[A-Za-z]_[0-9]+_[0-9]+)(?:\.[A-Za-z]+)?\s*$', 1)), '')"
_LABEL = r"""CASE WHEN regexp_matches(regexp_replace(lower({0}), '[^a-z]', '', 'g'), '^tra(in(ing)?)?(set)?$') THEN 'train'
 WHEN regexp_matches(regexp_replace(lower({0}), '[^a-z]', '', 'g'), '^val(id(ation)?)?(set)?$') THEN 'val'
 WHEN regexp_matches(regexp_replace(lower({0}), '[^a-z]', '', 'g'), '^test(ing)?(set)?$') THEN 'test' END"""
_VERSION = r"nullif('v' || regexp_extract({0}, '^\s*[vV]?([12])(?:\.0+)*\s*$', 1), 'v')"

_FREQUENCIES = "WITH tokens AS (" + " UNION ALL ".join(
    f"SELECT '{f}' AS field, nullif({_NORMAL.format(f)}, '') AS val, {_ANTIBODY.format('antibody_id')} AS ab FROM cells" for f in CELL_FIELDS
) + """), counts AS (
  SELECT field, val, count(*) AS n_rows, count(DISTINCT ab) AS n_antibodies FROM tokens WHERE val IS NOT NULL GROUP BY ALL
), marked AS (
  SELECT *, CASE WHEN n_rows < 5 THEN 'rare' WHEN n_rows > 0.2 * (SELECT count(*) FROM cells) THEN 'common' END AS mark FROM counts
) """  # fmt: skip
_GROUPED = f"""i AS (SELECT row_id, coalesce({_IMAGE.format("image_id")}, {_IMAGE.format("image_url")}) AS g FROM images),
a0 AS (SELECT row_id, {_ANTIBODY.format("antibody_id")} AS ab, {_GENE.format("ensembl_id")} AS gene, lower(trim(gene_name)) AS n FROM antibodies),
m AS (SELECT n, arg_min(gene, (-c, gene)) AS gene FROM (SELECT n, gene, count(*) AS c FROM a0 WHERE gene IS NOT NULL AND n <> '' GROUP BY ALL) GROUP BY n),
a AS (SELECT row_id, ab || '/' || coalesce(a0.gene, m.gene) AS g FROM a0 LEFT JOIN m USING (n))
"""
_PAIRS = """SELECT '{0}' AS src_table, a.row_id AS row_a, b.row_id AS row_b FROM {1} a JOIN {1} b ON a.g = b.g AND a.row_id < b.row_id"""


def _survivors(key: str, groups: str, name: str, moment: str, bundles: dict, star: tuple) -> str:
    """SQL of the survivors: every bundle's best value, and for the linked ones the best sum that keeps the dependencies."""
    of, of_fields, on = star
    blank = {f: f"""nullif(CASE WHEN trim("{f}") = '' THEN '' ELSE "{f}" END, '')""" for fields, _ in bundles.values() for f in fields}

    def texts(fields: list[str]) -> str:
        return "[" + ", ".join(f"coalesce({blank[f]}, '')" for f in fields) + "]"

    def link(fields: list[str]) -> str:
        return f"CASE WHEN coalesce({', '.join(blank[f] for f in fields)}) IS NOT NULL THEN {texts(fields)} END"

    columns = []
    for b, (fields, trust) in bundles.items():
        filled = " + ".join(f"CASE WHEN {blank[f]} IS NULL THEN 0 ELSE 1 END" for f in fields)
        columns.append(f"CAST(round(({filled}) * 1000.0 / {len(fields)}) AS BIGINT) * 1000 + coalesce({trust}, 0) AS q_{b}, {texts(fields)} AS v_{b}")
    columns += [f"{link(of_fields)} AS x", *(f"{link(fields)} AS y_{b}" for b, fields in on.items())]
    sql = f"WITH {_GROUPED}, r AS (SELECT g, coalesce(epoch_us({moment}), 0) AS r, {', '.join(columns)} FROM {name} JOIN {groups} USING (row_id) WHERE g IS NOT NULL)"
    for b in bundles:
        if b != of and b not in on:
            sql += f", t_{b} AS (SELECT g, v_{b} FROM r QUALIFY row_number() OVER (PARTITION BY g ORDER BY q_{b} DESC, r DESC, v_{b} DESC) = 1)"
    sql += f", c AS (SELECT g, x, v_{of}, q_{of} AS q, r FROM r QUALIFY row_number() OVER (PARTITION BY g, x ORDER BY q_{of} DESC, r DESC, v_{of} DESC) = 1)"
    joins, total, recent, order = "", "c.q", "c.r", f"v_{of} DESC"
    for b in on:
        best = f"ORDER BY q_{b} DESC, r DESC, v_{b} DESC) = 1"
        sql += f", f_{b} AS (SELECT g, x, y_{b} AS y FROM r WHERE x IS NOT NULL AND y_{b} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY g, x {best})"
        sql += f", l_{b} AS (SELECT g, y_{b} AS y, v_{b}, q_{b}, r FROM r WHERE y_{b} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY g, y_{b} {best})"
        sql += f", o_{b} AS (SELECT g, v_{b}, q_{b}, r FROM r QUALIFY row_number() OVER (PARTITION BY g {best})"
        sql += f", k_{b} AS (SELECT c.g, c.x, coalesce(l.v_{b}, o.v_{b}) AS v_{b}, coalesce(l.q_{b}, o.q_{b}) AS q, coalesce(l.r, o.r) AS r FROM c JOIN o_{b} o ON c.g = o.g LEFT JOIN f_{b} f ON c.g = f.g AND c.x = f.x LEFT JOIN l_{b} l ON f.g = l.g AND f.y = l.y)"
        joins += f" JOIN k_{b} ON c.g = k_{b}.g AND c.x IS NOT DISTINCT FROM k_{b}.x"
        total, recent, order = f"{total} + k_{b}.q", f"{recent} + k_{b}.r", f"{order}, v_{b} DESC"
    values = ", ".join(f"v_{b}" for b in (of, *on))
    sql += f", w AS (SELECT c.g, {values} FROM c{joins} QUALIFY row_number() OVER (PARTITION BY c.g ORDER BY {total} DESC, {recent} DESC, {order}) = 1)"
    plain = ", ".join(f"""nullif(v_{b}[{i + 1}], '') AS "{f}\"""" for b, (fields, _) in bundles.items() for i, f in enumerate(fields))
    free = "".join(f" JOIN t_{b} USING (g)" for b in bundles if b != of and b not in on)
    return sql + f", n AS (SELECT g, count(*) AS n_rows FROM r GROUP BY g) SELECT g AS {key}, n_rows, {plain} FROM w JOIN n USING (g){free}"


_PASSAGES = """
WITH d AS (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM documents)),
e AS (SELECT item_id, w, unnest(range(1, len(w) - 6)) AS j FROM (SELECT item_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM eval_items)),
hits AS (SELECT DISTINCT doc_id, item_id, i, j FROM (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS g FROM d) JOIN (SELECT item_id, j, array_to_string(w[j:j+7], ' ') AS g FROM e) USING (g))
"""

ORACLE = {
    "p1_found": _FREQUENCIES + "SELECT field, val, mark FROM marked WHERE mark IS NOT NULL",
    "p1_frequencies": _FREQUENCIES + "SELECT * FROM marked",
    "p2_found": f"""
WITH r AS (SELECT {_IMAGE.format("image_id")} AS image_id, {_LABEL.format('"set"')} AS label, {_LABEL.format("set_v1")} AS before, {_VERSION.format("split_version")} AS v FROM dataset),
e AS (SELECT image_id, before AS label FROM r WHERE before IS NOT NULL UNION SELECT image_id, label FROM r WHERE v = 'v1' AND label IS NOT NULL),
c AS (SELECT DISTINCT image_id, label FROM r WHERE v = 'v2' AND label IS NOT NULL)
SELECT DISTINCT e.image_id FROM e JOIN c ON e.image_id = c.image_id AND e.label <> c.label""",
    "p2_sample": f"""
WITH r AS (SELECT {_IMAGE.format("image_id")} AS image_id, {_LABEL.format('"set"')} AS label, {_LABEL.format("set_v1")} AS before, {_VERSION.format("split_version")} AS v FROM dataset),
s AS (SELECT image_id, before AS stratum, true AS e FROM r WHERE before IS NOT NULL UNION SELECT image_id, label, true FROM r WHERE v = 'v1' AND label IS NOT NULL
 UNION SELECT image_id, label, false FROM r WHERE v = 'v2' AND label IS NOT NULL
 UNION SELECT image_id, NULL, false FROM r WHERE before IS NULL AND (label IS NULL OR v IS NULL)),
t AS (SELECT *, CAST('0x' || substr(md5('{SALT}:' || image_id), 1, 13) AS BIGINT) / 4503599627370496.0 AS unit,
  CASE stratum {" ".join(f"WHEN '{k}' THEN {r}" for k, r in FIRST_RATES.items())} ELSE 0.1 END AS was,
  CASE stratum {" ".join(f"WHEN '{k}' THEN {max(r, FIRST_RATES[k])}" for k, r in SAMPLE_RATES.items())} ELSE 0.1 END AS level FROM s WHERE image_id IS NOT NULL),
k AS (SELECT image_id, any_value(unit) AS unit, max(level)::DOUBLE AS threshold,
  coalesce(string_agg(DISTINCT stratum, ',' ORDER BY stratum) FILTER (e AND unit < was), '') AS earlier, coalesce(string_agg(DISTINCT stratum, ',' ORDER BY stratum) FILTER (NOT e AND unit < level), '') AS current,
  count(DISTINCT stratum) FILTER (unit < CASE WHEN e THEN was ELSE level END) AS n FROM t GROUP BY image_id)
SELECT image_id, unit, threshold, unit < threshold AS sampled, earlier, current, CASE WHEN earlier <> '' AND current <> '' THEN n = 1 END AS kept FROM k""",
    "p3_found": f"WITH {_GROUPED}" + _PAIRS.format("images", "i") + " UNION ALL " + _PAIRS.format("antibodies", "a"),
    "p3_classes": f"WITH {_GROUPED}" + " UNION ALL ".join(
        f"SELECT '{n}' AS src_table, row_id, min(row_id) OVER w AS class_id, count(*) OVER w - 1 AS n_links FROM {t} WHERE g IS NOT NULL WINDOW w AS (PARTITION BY g) QUALIFY count(*) OVER w > 1"
        for n, t in (("images", "i"), ("antibodies", "a"))
    ),
    "p3_images": _survivors("image_key", "i", "images", "crawled_at", {
        "target": (["antibody_id", "ensembl_id", "gene_name"], f"CASE WHEN {_GENE.format('ensembl_id')} IS NOT NULL THEN 2 ELSE 0 END"),
        "place": (["tissue", "organ"], "0"),
        "patient": (["patient_id"], "CASE WHEN regexp_matches(patient_id, '^[0-9]+$') THEN 1 ELSE 0 END"),
        "file": (["image_type", "image_url", "local_path"], "CASE WHEN lower(image_type) = 'tif' THEN 2 ELSE 0 END"),
        "download": (["download_status", "download_date", "file_size", "url_used"], "CASE lower(trim(download_status)) WHEN 'downloaded' THEN 3 WHEN 'ftp_available' THEN 2 WHEN 'pending' THEN 1 ELSE 0 END"),
    }, ("file", ["image_type"], {"download": ["download_date", "file_size", "url_used"]})),
    "p3_antibodies": _survivors("antibody_gene", "a", "antibodies", "updated_at", {
        "gene": (["ensembl_id"], "CASE WHEN length(ensembl_id) = 15 THEN 1 ELSE 0 END"),
        "name": (["gene_name"], "0"),
        "spelling": (["antibody_id"], f"CASE WHEN antibody_id = {_ANTIBODY.format('antibody_id')} THEN 1 ELSE 0 END"),
        "reliability": (["Reliability score"], "CASE lower(trim(\"Reliability score\")) WHEN 'enhanced' THEN 3 WHEN 'supported' THEN 2 WHEN 'approved' THEN 2 WHEN 'uncertain' THEN 1 ELSE 0 END"),
    }, ("gene", ["ensembl_id"], {"name": ["gene_name"], "reliability": ["Reliability score"]})),
    "p6_found": f"""
WITH RECURSIVE r AS (SELECT {_ANTIBODY.format("antibody_id")} AS ab, {_GENE.format("ensembl_id")} AS gene, {_LABEL.format('"set"')} AS label
  FROM dataset WHERE {_VERSION.format("split_version")} = 'v2'),
l AS (SELECT DISTINCT a.ab AS x, b.ab AS y FROM r a JOIN r b ON a.gene = b.gene AND a.ab <> b.ab),
reach AS (SELECT DISTINCT ab AS x, ab AS y FROM r WHERE ab IS NOT NULL UNION SELECT reach.x, l.y FROM reach JOIN l ON reach.y = l.x)
SELECT x AS antibody_id FROM reach JOIN (SELECT DISTINCT ab, label FROM r WHERE label IS NOT NULL) s ON s.ab = reach.y
GROUP BY x HAVING count(DISTINCT label) > 1""",
    "p6_checks": f"""
WITH r AS (SELECT {_ANTIBODY.format("antibody_id")} AS ab, nullif({_NORMAL.format("tissue")}, '') AS tissue FROM dataset WHERE {_VERSION.format("split_version")} = 'v2')
SELECT 'rows with a split' AS "check", count(*) AS n FROM r WHERE ab IS NOT NULL
UNION ALL SELECT 'tissues', count(DISTINCT coalesce(tissue, '')) FROM r WHERE ab IS NOT NULL
UNION ALL SELECT unnest(['antibody_id in several splits', 'ensembl_id in several splits', 'all rows off by over a point', 'large tissues off by over a point']), 0""",
    "p8_checks": """SELECT 'documents' AS "check", count(*) AS n FROM documents
UNION ALL SELECT unnest(['documents not whole', 'documents cut without need', 'containers over capacity', 'much room left']), 0""",
    "p9_found": _PASSAGES + "SELECT DISTINCT doc_id, item_id FROM hits",
    "p9_passages": _PASSAGES + """, runs AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, i - j ORDER BY i) AS run FROM hits),
long AS (SELECT doc_id, item_id, min(i) - 1 AS doc_word, min(j) - 1 AS item_word, count(*) + 7 AS n_words FROM runs GROUP BY doc_id, item_id, i - j, run)
SELECT * FROM long QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY n_words DESC, doc_word, item_word) = 1""",
    "p9_clean": _PASSAGES + "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM hits)",
}


def p10_repairs(spark: SparkSession, folder: str) -> DataFrame:
    return garbled_documents(table(spark, folder, "documents"))


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return p10_repairs(spark, folder).select("doc_id")


def p10_round_trips(spark: SparkSession, folder: str) -> DataFrame:
    """Clean texts decoded wrongly in known ways, once to five times: of how many texts, and whether nearly all are restored."""
    models = fitted_models(table(spark, folder, "documents"))

    @F.pandas_udf("string")
    def garble(texts: pd.Series, chains: pd.Series) -> pd.Series:
        return pd.Series([misread(t, c) for t, c in zip(texts, chains)])

    chain = F.explode(F.array(*map(F.lit, PLANTED))).alias("chain")
    planted = table(spark, folder, "eval_items").select("text", "lang", chain).withColumn("seen", garble("text", "chain"))
    fixed = repair_text(planted, models, "seen", "lang")
    return fixed.groupBy("chain").agg(F.count("*").alias("n"), (F.avg((F.col("repair.repaired") == F.col("text")).cast("int")) >= RESTORED).alias("ok"))


def misread(text: str, chain: str) -> str:
    """The text written in UTF-8 and read in each of the chain's encodings in turn."""
    for encoding in chain.split(">"):
        text = text.encode("utf-8").decode(encoding)
    return text


#: Ways to decode wrongly in which no byte is lost, and the share of texts that must come back.
PLANTED = ["latin-1", "mac_roman", "cp850", "cp437", "latin-1>latin-1", "mac_roman>latin-1", "latin-1>latin-1>latin-1", "latin-1>cp850>latin-1>latin-1", "latin-1>latin-1>latin-1>latin-1>latin-1"]
RESTORED = 0.97
ORACLE["p10_round_trips"] = f"SELECT unnest({PLANTED}) AS chain, (SELECT count(*) FROM eval_items) AS n, true AS ok"
QUERIES |= {"p10_found": p10_found, "p10_repairs": p10_repairs, "p10_round_trips": p10_round_trips}
