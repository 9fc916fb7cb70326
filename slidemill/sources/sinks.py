"""Writers: CSV tables as other programs read them, nested JSON, reports."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from datetime import datetime, timezone

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.sources import store


def as_text(df: DataFrame) -> DataFrame:
    """Booleans as True and False, all else as strings, missing values empty."""
    out = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`").cast("string")
        out.append(F.coalesce(F.initcap(c) if kind == "boolean" else c, F.lit("")).alias(name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str, single: bool = False, compression: str = "none", separator: str = ",") -> None:
    """A CSV folder with doubled quotes and untouched white space; ``single`` makes one file for hand-off."""
    frame = as_text(df)
    frame = frame.coalesce(1) if single else frame
    frame.write.mode("overwrite").options(header="true", sep=separator, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", compression=compression).csv(path)


def write_report(df: DataFrame, folder: str, name: str, problems: list[str], status: str = "status") -> str | None:
    """Writes the rows with a problem status; returns the folder written, None if there are none."""
    bad = df.where(F.col(status).isin(problems))
    if not bad.limit(1).collect():
        return None
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    path = os.path.join(folder, f"{name}_{stamp}")
    write_csv(bad, path, single=True)
    return path


def write_json_lines(df: DataFrame, path: str) -> None:
    """One document per line, null fields kept."""
    df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value")).write.mode("overwrite").text(path)


def write_documents(df: DataFrame, root: str, folder: str, name: str) -> DataFrame:
    """One JSON file per row at ``root/<folder column>/<name column>.json``, written by the tasks.

    Returns ``(path, status, message)``; a document that cannot be written is reported and does
    not stop the others. Files appear as a whole, so repeated tasks do no harm. ``root`` is a folder
    that all machines share, or the address of an object store.
    """
    body = F.to_json(F.struct(*(c for c in df.columns if c != folder)), {"ignoreNullFields": "false"})
    rows = df.select(F.concat_ws("/", F.lit(root), F.col(folder), F.concat(F.col(name), F.lit(".json"))).alias("path"), body.alias("body"))

    def write(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            out = []
            for path, text in zip(pdf["path"], pdf["body"]):
                try:
                    store.write(path, json.dumps(json.loads(text), indent=2).encode())
                    out.append((path, "ok", ""))
                except (OSError, ValueError, TypeError) as e:
                    out.append((path, "failed", str(e)))
            yield pd.DataFrame(out, columns=["path", "status", "message"])

    return rows.mapInPandas(write, "path string, status string, message string")
