"""Readers of CSV, listings, TSV archives, maps and image folders. Every value is a string, missing ones are empty."""

from __future__ import annotations

import io
import itertools
import os
import urllib.request
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slidemill.functions.scalars import after_marker, basename, stem
from slidemill.session import scratch
from slidemill.sources import store

#: Columns of a mirror annotation file that all runs share, as far as the pipeline reads them.
MIRROR_COLUMNS = ("Image Name", "Antibody identifier", "Characteristics [Organism Part]", "Characteristics [Pathology] Accession")
NORMAL_CODE = "M-00100"
#: Folder of a listing below which paths start; empty if they are relative already.
LISTING_ROOT = ""


def _status(spark: SparkSession, pattern: str) -> list:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return list(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or [])


def exists(spark: SparkSession, path: str) -> bool:
    return len(_status(spark, path)) > 0


def header_of(spark: SparkSession, path: str, separator: str = ",") -> list[str]:
    """The columns of a CSV file; reads its first line only."""
    return _reader(spark, separator).csv(path).columns


def _reader(spark: SparkSession, separator: str = ",", multiline: bool = False):  # type: ignore[no-untyped-def]
    options = {"header": True, "inferSchema": False, "quote": '"', "escape": '"', "sep": separator, "multiLine": multiline}
    return spark.read.options(**{k: str(v).lower() if isinstance(v, bool) else v for k, v in options.items()})


def read_csv(spark: SparkSession, path: str | list[str], separator: str = ",", multiline: bool = False, columns: Sequence[str] | None = None, ordinal: str | None = None) -> DataFrame:
    """A CSV file, folder or pattern (also gzip) as strings, unquoted empty fields as empty strings.

    ``ordinal`` names a column for the arrival order, added unless the file has it.
    """
    df = _reader(spark, separator, multiline).csv(path)
    if ordinal and ordinal not in df.columns:
        df = with_ordinal(df, ordinal)
    wanted = df.columns if columns is None else [*columns, *([ordinal] if ordinal else [])]
    return df.select(*(f"`{c}`" for c in wanted)).na.fill("")


def read_optional_csv(spark: SparkSession, path: str, required: bool = False) -> DataFrame | None:
    if exists(spark, path):
        return read_csv(spark, path)
    if required:
        raise FileNotFoundError(path)
    return None


def with_ordinal(df: DataFrame, out: str = "ordinal") -> DataFrame:
    """Adds the arrival order of rows read from files: file, then block, then row."""
    place = F.struct(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("b"), F.monotonically_increasing_id().alias("r"))
    return df.select("*", place.alias(out))


def check_columns(spark: SparkSession, path: str, required: Sequence[str]) -> list[str]:
    columns = header_of(spark, path)
    lacking = [c for c in required if c not in columns]
    if lacking:
        raise ValueError(f"{os.path.basename(path)} lacks {', '.join(lacking)}")
    return columns


def read_mirror_runs(spark: SparkSession, paths: Sequence[str], columns: Sequence[str] = MIRROR_COLUMNS, code: str = NORMAL_CODE) -> DataFrame:
    """Rows of normal tissue of all run files, with the shared columns and ``source_file``.

    Files have different further columns, so each is read by itself and cut to the shared ones.
    """
    if not paths:
        raise FileNotFoundError("no run files")
    parts = []
    for path in sorted(paths):
        check_columns(spark, path, columns)
        rows = _reader(spark).csv(path)
        kept = rows.where(F.col("`Characteristics [Pathology] Accession`").contains(code))
        parts.append(kept.select(*(f"`{c}`" for c in columns), basename(F.col("_metadata.file_path")).alias("source_file")).na.fill(""))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def read_listing(spark: SparkSession, path: str, root: str = LISTING_ROOT) -> DataFrame:
    """``(name, ftp_path)`` of the TIF files of a text listing; the last line of a name wins."""
    lines = with_ordinal(spark.read.text(path))
    line = F.trim("value")
    kept = lines.where(F.lower(line).endswith(".tif")).select(after_marker(line, root).alias("ftp_path"), "ordinal")
    return kept.groupBy(basename(F.col("ftp_path")).alias("name")).agg(F.max_by("ftp_path", "ordinal").alias("ftp_path"))


def mirror_table(spark: SparkSession, run_files: Sequence[str], listing: str, root: str = LISTING_ROOT) -> DataFrame:
    """The mirror table: rows of all runs with the listed path of their image, empty if it is not listed."""
    return attach_listing(read_mirror_runs(spark, run_files), read_listing(spark, listing, root))


def attach_listing(rows: DataFrame, paths: DataFrame) -> DataFrame:
    return rows.join(paths, F.col("`Image Name`") == F.col("name"), "left").drop("name").na.fill("", ["ftp_path"])


def read_path_map(spark: SparkSession, path: str) -> DataFrame:
    """``(image_id, ftp_path)`` of a CSV with ``ftp_path``; the last row of an image wins."""
    rows = with_ordinal(_reader(spark).csv(path).where("ftp_path IS NOT NULL AND ftp_path <> ''"))
    return rows.groupBy(stem(F.col("ftp_path")).alias("image_id")).agg(F.max_by("ftp_path", "ordinal").alias("ftp_path"))


def unzipped(spark: SparkSession, path: str) -> str:
    """The lines of a zip's first file, stored in the shared folder by the task that reads the zip."""

    def lines(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z, z.open(z.namelist()[0]) as f:
                    text = io.TextIOWrapper(f, "utf-8", newline="")
                    while block := list(itertools.islice(text, 50_000)):
                        yield pd.DataFrame({"value": [x.rstrip("\r\n") for x in block]})

    out = scratch(spark, "unzipped")
    spark.read.format("binaryFile").load(path).select("content").mapInPandas(lines, "value string").write.text(out)
    return out


def files_in(spark: SparkSession, folder: str, ending: str) -> list[str]:
    """The files of a folder of any file system, by name."""
    found = _status(spark, f"{folder.rstrip('/')}/*{ending}")
    return sorted(s.getPath().toString() for s in found if s.isFile())


def read_locations(spark: SparkSession, path: str, columns: Sequence[str], multiline: bool = False) -> DataFrame:
    """The location table, a TSV or a zip of one; the first row of a gene is kept.

    ``multiline`` reads quoted values over several lines, at the price of one task a file.
    """
    from slidemill.operators.relational import keep_first

    if path.endswith(".zip"):
        path = unzipped(spark, path)
    lacking = [c for c in ("Gene", *columns) if c not in header_of(spark, path, "\t")]
    if lacking:
        raise ValueError(f"{os.path.basename(path)} lacks {', '.join(lacking)}")
    rows = with_ordinal(_reader(spark, "\t", multiline).csv(path))
    return keep_first(rows.select("Gene", *(f"`{c}`" for c in columns), "ordinal"), ["Gene"], ["ordinal"]).drop("ordinal").na.fill("")


def list_files(spark: SparkSession, root: str, pattern: str = "*.tif") -> DataFrame:
    """``(path, length)`` of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "length")


def existing_paths(spark: SparkSession, csv: str, root: str, pattern: str = "*.tif") -> tuple[DataFrame, DataFrame]:
    """The image paths of a CSV, split into those that exist below the root and those that do not.

    An absolute ``local_path`` that names a file is used as it is, any other is joined to the root.
    """
    rows = read_csv(spark, csv)
    inside = F.concat_ws("/", F.lit(root.rstrip("/")), F.col("local_path"), F.concat("image_id", F.lit(".tif")))
    path = F.when(F.col("local_path").startswith("/") & F.lower("local_path").endswith(".tif"), F.col("local_path")).when(F.lower("local_path").endswith(".tif"), F.concat_ws("/", F.lit(root.rstrip("/")), "local_path")).otherwise(inside)
    wanted = rows.select(path.alias("path")).distinct()
    there = list_files(spark, root, pattern).select("path")
    return wanted.join(there, "path", "left_semi"), wanted.join(there, "path", "left_anti")


def read_images(spark: SparkSession, root: str, pattern: str = "*.tif") -> DataFrame:
    """``(path, length, content)`` of image files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "length", "content")


def fetch_if_absent(url: str, path: str) -> bool:
    """Downloads a file unless it exists, atomically; whether it was fetched."""
    if store.size(path) is not None:
        return False
    with urllib.request.urlopen(url) as source:
        store.write(path, source.read())
    return True
