"""Command line: ``python -m slidemill.cli COMMAND``. Tables are CSV files as the readers take them."""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.functions.scalars import named_paths, source_urls
from slidemill.images import work
from slidemill.images.paths import crop_path, image_path, mask_path
from slidemill.operators import annotate, quality
from slidemill.operators.folders import document_aggregate, parent_folders
from slidemill.operators.relational import keep_first, value_counts
from slidemill.operators.split import attach_legacy_set, check_split_version
from slidemill.plans import pipeline
from slidemill.session import build_session, cut_lineage
from slidemill.sources import sinks, store
from slidemill.sources.atlas_xml import antibody_rows, atlas_tables, gene_trees, parse_counts, read_entries
from slidemill.sources.files import existing_paths, exists, fetch_if_absent, files_in, list_files, mirror_table, read_csv, read_locations, read_path_map


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with ``row_id`` in the order of its files, blocks and rows."""
    return read_csv(spark, path, ordinal="row_id")


def log_rows(df: DataFrame, path: str | None) -> None:
    """Prints a small frame, also into a log file if there is one."""
    lines = ["\t".join(df.columns), *("\t".join(map(str, r)) for r in df.collect())]
    print(*lines, sep="\n")
    if path:
        store.append_text(path, "\n".join([*lines, ""]))


def crawl(spark: SparkSession, a: argparse.Namespace) -> int:
    mirror = read_path_map(spark, a.ftp_paths) if a.ftp_paths else None
    log_rows(parse_counts(read_entries(spark, a.xml_file)), a.log_file)
    tables = atlas_tables(spark, a.xml_file, mirror)
    if a.format in ("csv", "all"):
        for name, df in tables.items():
            sinks.write_csv(df, f"{a.output_dir}/metadata/{name}")
    if a.format in ("json", "all"):
        docs = gene_trees(antibody_rows(read_entries(spark, a.xml_file))).cache()
        sinks.write_json_lines(docs, f"{a.output_dir}/metadata/full_data")
        report = sinks.write_documents(docs.withColumn("folder", F.lit("metadata/gene_documents")), a.output_dir, "folder", "ensembl_id").cache()
        sinks.write_report(report, a.output_dir, "gene_json_failures", ["failed"])
    if a.format in ("img_json", "all"):
        docs = document_aggregate(tables["images"]).withColumn("folder", F.concat_ws("/", "local_path", F.lit("metadata")))
        report = sinks.write_documents(docs, a.output_dir, "folder", "image_id").cache()
        sinks.write_report(report, a.output_dir, "image_json_failures", ["failed"])
        known = mirror if mirror is not None else spark.createDataFrame([], "image_id string, ftp_path string")
        sinks.write_json_lines(parent_folders(tables["images"], known), f"{a.output_dir}/metadata/parent_folder_mapping")
    return 0


def mirror(spark: SparkSession, a: argparse.Namespace) -> int:
    sinks.write_csv(mirror_table(spark, files_in(spark, a.idr_dir, ".csv"), a.listing, a.listing_root), a.output)
    return 0


def dataset(spark: SparkSession, a: argparse.Namespace) -> int:
    fractions = (a.train_frac, a.val_frac, a.test_frac)
    if abs(sum(fractions) - 1) > 1e-8:
        raise SystemExit("the fractions must sum to 1")
    earlier = None
    if a.split_from:
        earlier = read_csv(spark, a.split_from)
        check_split_version(earlier, allow_legacy=a.allow_legacy_split_from)
    old = numbered(spark, a.set_v1_from) if a.set_v1_from else None
    images, antibodies = numbered(spark, a.images_csv), read_csv(spark, a.antibodies_csv)
    paths = numbered(spark, a.idr_table) if a.idr_table else None
    log = pipeline.StepLog("full")
    report = lambda rows: sinks.write_csv(rows, f"{a.out_dir}/duplicate_report", single=True)
    selected = pipeline.select_images(images, pipeline.guard_scores(antibodies), paths, a.source, a.seed, a.duplicate_policy, a.mirror_url, log, report)
    selected = cut_lineage(selected)
    if a.stage in ("full", "both"):
        sinks.write_csv(pipeline.finalize(pipeline.build_full(selected, a.seed, fractions, earlier, old)), f"{a.out_dir}/{a.full_output}")
    if a.stage in ("pilot", "both"):
        exclude = read_csv(spark, a.exclude_ids) if a.exclude_ids else None
        labelled = selected if old is None else attach_legacy_set(selected, old, "row_id")
        pilot = pipeline.build_pilot(labelled, pipeline.PILOT_TISSUES, a.seed, fractions, exclude=exclude, earlier=earlier, log=log)
        sinks.write_csv(pipeline.finalize(pilot), f"{a.out_dir}/{a.pilot_output}")
    log_rows(log.frame(), a.log_file)
    if a.save_plots:
        for column in ("tissue", "organ"):
            sinks.write_csv(value_counts(selected, column).orderBy(F.desc("n"), "value"), f"{a.plot_dir}/{column}_counts", single=True)
    return 0


def checks(spark: SparkSession, a: argparse.Namespace) -> int:
    frames = {n: read_csv(spark, p) for n, p in named_paths(a.dataset).items()}
    fractions = tuple(float(x) for x in a.fracs.split(","))
    stained = numbered(spark, a.metadata) if a.metadata else None
    results = []
    for name, df in frames.items():
        if stained is not None:
            df = df.join(keep_first(stained, ["image_id"], ["row_id"]).select("image_id", "stained"), "image_id", "left")
        results.append(quality.check_dataset(name, df, fractions, a.tissue_tol, a.strata_tol, "stained" if stained is not None else None, a.year_tvd))
    if len(frames) > 1:
        pairs = quality.gene_agreement(frames)
        results.append(pairs.select(F.concat_ws("/", "dataset_a", "dataset_b").alias("dataset"), F.lit("genes agree").alias("check"), (F.col("n_different") == 0).alias("ok"), F.format_string("%d of %d differ", "n_different", "n_shared").alias("detail")))
    rows = reduce(DataFrame.union, results).collect()
    for r in rows:
        print("ok " if r.ok else "BAD", r.dataset, r.check, r.detail)
    return int(not all(r.ok for r in rows))


def annotations(spark: SparkSession, a: argparse.Namespace) -> int:
    data = read_csv(spark, a.dataset_csv)
    cells, tissues = (numbered(spark, f"{a.metadata_dir}/{n}") for n in ("cells", "tissues"))
    patients = numbered(spark, f"{a.metadata_dir}/patients") if exists(spark, f"{a.metadata_dir}/patients") else None
    per_cell = annotate.cell_annotations(data, cells).cache()
    per_image = annotate.image_annotations(data, cells, patients, tissues)
    outputs = {"cell_annotations": per_cell, "cell_types": annotate.cell_vocabulary(per_cell).orderBy(F.desc("n_images"), "cell_type")}
    if a.subcellular_tsv:
        if a.subcellular_url:
            fetch_if_absent(a.subcellular_url, a.subcellular_tsv)
        per_image = annotate.attach_locations(per_image, read_locations(spark, a.subcellular_tsv, list(annotate.LOCATION_COLUMNS)))
        outputs["subcellular_locations"] = annotate.location_vocabulary(per_image).orderBy(F.desc("n_images_main"), "location")
    outputs["image_annotations"] = per_image.orderBy("image_id")
    prefix = a.prefix or os.path.basename(a.dataset_csv).removesuffix(".gz").removesuffix(".csv")
    for name, df in outputs.items():
        sinks.write_csv(df, f"{a.out_dir}/{prefix}_{name}", single=True)
    return 0


def _first(df: DataFrame, n: int) -> DataFrame:
    return df.orderBy("path").limit(n) if n else df


def download(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = read_csv(spark, a.csv)
    if a.set:
        if "set" not in rows.columns:
            raise SystemExit("the CSV has no column set")
        rows = rows.where(F.col("set") == a.set)
    rows = rows.withColumn("path", image_path(F.lit(a.root), F.col("local_path"), F.col("image_id")))
    rows = _first(rows, a.max_images)
    if a.verify:
        report = work.verify(rows, a.delete_corrupt, a.workers).cache()
        bad = ["missing", "corrupt"]
    else:
        order = a.source_order.split(",")
        urls = source_urls(order, {"idr": "idr_url", "hpa": "hpa_url"})
        report = work.download(rows.select("image_id", F.col("path").alias("target"), urls.alias("urls")), order, retries=a.retries, parts=a.workers).cache()
        bad = ["failed"]
    report.groupBy("status").count().show()
    return int(sinks.write_report(report, a.root, "download_report", bad) is not None)


def _image_paths(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The images below a folder, or those of a CSV that exist; missing ones are counted and left out."""
    if a.csv_file:
        there, missing = existing_paths(spark, a.csv_file, a.img_root)
        print(f"missing images: {missing.count()}")
        return _first(there, a.max_images)
    return _first(list_files(spark, a.root).select("path"), a.max_images)


def make_masks(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = _image_paths(spark, a)
    report = work.make_masks(rows.withColumn("target", mask_path(F.col("path"), a.output_format)), a.downsample, a.min_component_area, a.num_workers).cache()
    report.groupBy("status").count().show()
    return int(sinks.write_report(report, a.report_dir or ".", "mask_report", ["failed", "no_tissue"]) is not None)


def make_crops(spark: SparkSession, a: argparse.Namespace) -> int:
    rows = _image_paths(spark, a)

    def mask_of(path: str) -> str:
        folder, name = os.path.split(path)
        return f"{folder}/masks/{os.path.splitext(name)[0]}_mask.{a.mask_format}"

    report = work.make_crops(rows.withColumn("target", crop_path(F.col("path"), a.save_format)), mask_of, a.padding, a.num_workers).cache()
    report.groupBy("status").count().show()
    return int(bool(report.where(F.col("status").isin("failed", "missing_mask")).limit(1).collect()))


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="slidemill")
    sub = p.add_subparsers(dest="command", required=True)

    def command(name: str, run, *options: tuple) -> None:  # type: ignore[no-untyped-def]
        c = sub.add_parser(name)
        c.set_defaults(run=run)
        for flags, kw in options:
            c.add_argument(*flags.split(), **kw)

    flag, number, real = {"action": "store_true"}, {"type": int}, {"type": float}
    command("crawl", crawl, ("--xml-file", {"required": True}), ("--output-dir", {"required": True}), ("--format", {"choices": ["csv", "json", "img_json", "all"], "default": "csv"}), ("--ftp-paths", {}), ("--log-file", {}))
    command("mirror", mirror, ("--idr-dir", {"required": True}), ("--listing", {"required": True}), ("--listing-root", {"default": ""}), ("--output", {"required": True}))
    command(
        "dataset", dataset, ("--images-csv", {"required": True}), ("--antibodies-csv", {"required": True}), ("--idr-table", {}), ("--mirror-url", {"default": pipeline.MIRROR_URL}), ("--source", {"choices": ["idr", "all"], "default": "idr"}),
        ("--stage", {"choices": ["full", "pilot", "both"], "default": "both"}), ("--full-output", {"default": "full_dataset"}), ("--pilot-output", {"default": "pilot_dataset"}), ("--out-dir", {"default": "."}),
        ("--train-frac", real | {"default": 0.7}), ("--val-frac", real | {"default": 0.1}), ("--test-frac", real | {"default": 0.2}), ("--seed", number | {"default": 42}),
        ("--log-file", {}), ("--save-plots", flag), ("--plot-dir", {"default": "."}), ("--split-from", {}), ("--allow-legacy-split-from", flag), ("--set-v1-from", {}), ("--exclude-ids", {}), ("--duplicate-policy", {"choices": ["fail", "prefer", "drop"], "default": "prefer"}),
    )
    command("checks", checks, ("--dataset", {"nargs": "+", "required": True}), ("--metadata", {}), ("--fracs", {"default": "0.7,0.1,0.2"}), ("--tissue-tol", real | {"default": 0.01}), ("--strata-tol", real | {"default": 0.015}), ("--year-tvd", real | {"default": 0.1}))
    command("annotations", annotations, ("--dataset-csv", {"required": True}), ("--metadata-dir", {"required": True}), ("--out-dir", {"default": "."}), ("--prefix", {}), ("--subcellular-tsv", {}), ("--subcellular-url", {}))
    command("download", download, ("--csv", {"required": True}), ("--root", {"required": True}), ("--source-order", {"default": "idr,hpa"}), ("--set", {}), ("--workers", number | {"default": 4}), ("--max-images", number | {"default": 0}), ("--retries", number | {"default": 2}), ("--verify", flag), ("--delete-corrupt", flag))
    images = [("--root", {}), ("--csv-file", {}), ("--img-root", {"default": ""}), ("--max-images", number | {"default": 0}), ("--num-workers", number | {"default": 10})]
    command("masks", make_masks, *images, ("--downsample", real | {"default": 0.2}), ("--min-component-area", number | {"default": 1000}), ("--report-dir", {}), ("--output-format", {"choices": ["npy", "png"], "default": "npy"}))
    command("crops", make_crops, *images, ("--save-format", {"choices": ["npy", "tif", "png"], "default": "npy"}), ("--padding", number | {"default": 5}), ("--mask-format", {"choices": ["npy", "png"], "default": "npy"}))
    return p


def main(args: Sequence[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(args)
    return a.run(spark or build_session(), a)


if __name__ == "__main__":
    sys.exit(main())
