"""Session construction and the few session settings operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings for a run on one machine; a cluster's own settings take precedence.
LOCAL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(app: str = "slidemill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC time and Arrow transfer.

    ``master`` defaults to every local core; extra settings are passed with
    underscores instead of dots (``spark_sql_shuffle_partitions="8"``).
    """
    cores = os.cpu_count() or 2
    builder = SparkSession.builder.appName(app).master(master or f"local[{cores}]")
    settings = LOCAL_DEFAULTS | {"spark.sql.shuffle.partitions": str(2 * cores)}
    settings |= {k.replace("_", "."): v for k, v in conf.items()}
    return builder.config(map=settings).getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder for stored intermediate rows, in storage that all machines share.

    ``spark.checkpoint.dir`` is read from the session. Where it is unset a temporary folder is
    set, but only on a single machine, as in tests; a cluster must name one.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        folder = context.getConf().get("spark.checkpoint.dir")
        if not folder:
            if not context.master.startswith("local[") and context.master != "local":
                raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
            folder = tempfile.mkdtemp(prefix="slidemill-")
        context.setCheckpointDir(folder)
    return context._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder, and return the stored rows; losing an executor loses nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that a step writes and reads again."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
