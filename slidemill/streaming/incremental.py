"""Incremental work: new files of a folder are processed once, as a file stream with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

BINARY = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(spark: SparkSession, folder: str, pattern: str = "*.tif", files_per_batch: int = 10_000) -> DataFrame:
    """``(path, length)`` of files as they arrive."""
    stream = spark.readStream.format("binaryFile").schema(BINARY).options(recursiveFileLookup="true", pathGlobFilter=pattern, maxFilesPerTrigger=str(files_per_batch))
    return stream.load(folder).select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "length")


def run_available(stream: DataFrame, work: Callable[[DataFrame], DataFrame], results: str, checkpoint: str) -> StreamingQuery:
    """Runs ``work`` over everything new and appends its result to a Parquet folder, then stops.

    Files seen under the same checkpoint are not seen again; a batch repeated after a failure
    overwrites its own part of the results.
    """

    def one(batch: DataFrame, number: int) -> None:
        work(batch).write.mode("overwrite").parquet(f"{results}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def pending(wanted: DataFrame, done: DataFrame, key: str = "path") -> DataFrame:
    """The batch form: rows whose result does not exist yet."""
    return wanted.join(done.select(key).distinct(), key, "left_anti")
