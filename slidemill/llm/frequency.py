"""Frequency of every distinct value: last-seen counters over hash-partitioned, record-ordered tokens."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least number of buckets over which the records of one term are spread; there are as many as shuffle partitions.
BUCKETS = 64
COUNTS = "field string, val string, occurrences bigint, records bigint"
_PARTIAL = "field string, val string, record string, n bigint"


def tokens_of(df: DataFrame, fields: dict[str, Column], record: Column) -> DataFrame:
    """``(field, val, record)``, one row per non-null value of each named expression."""
    pairs = F.explode(F.array(*(F.struct(F.lit(k).alias("field"), v.cast("string").alias("val")) for k, v in fields.items())))
    return df.select(record.cast("string").alias("record"), pairs.alias("t")).select("t.field", "t.val", "record").where(F.col("val").isNotNull())


def _precount(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal tokens of one batch become one row with their number."""
    for b in batches:
        if b.num_rows:
            t = pa.Table.from_batches([b]).group_by(["field", "val", "record"], use_threads=False).aggregate([([], "count_all")])
            t = t.rename_columns(["field", "val", "record", "n"])
            yield from t.to_batches()


def _last_seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens sorted by term and record to one counter per term: occurrences, records and the record last seen.

    Only the counter of the term being read is kept from batch to batch.
    """
    schema = pa.schema([("field", pa.string()), ("val", pa.string()), ("occurrences", pa.int64()), ("records", pa.int64())])
    term: tuple | None = None
    last: str | None = None
    occurrences = records = 0

    for b in batches:
        if not b.num_rows:
            continue
        field, val, record, n = b.columns
        new_term = np.ones(b.num_rows, bool)
        new_record = np.ones(b.num_rows, bool)
        if b.num_rows > 1:
            moved = pc.or_(pc.not_equal(field[1:], field[:-1]), pc.not_equal(val[1:], val[:-1]))
            new_term[1:] = moved.to_numpy(zero_copy_only=False)
            same = pc.fill_null(pc.equal(record[1:], record[:-1]), False).to_numpy(zero_copy_only=False)
            new_record[1:] = new_term[1:] | ~same
        missing = record.is_null().to_numpy(zero_copy_only=False)
        head = (field[0].as_py(), val[0].as_py())
        going_on = head == term
        if going_on:
            new_term[0] = False
            new_record[0] = record[0].as_py() != last
        new_record &= ~missing
        starts = np.flatnonzero(new_term)
        bounds = starts if len(starts) and starts[0] == 0 else np.concatenate(([0], starts))
        occ = np.add.reduceat(n.to_numpy(), bounds).astype(np.int64)
        rec = np.add.reduceat(new_record.astype(np.int64), bounds)
        terms = [(field[int(i)].as_py(), val[int(i)].as_py()) for i in bounds]
        if going_on:
            occ[0] += occurrences
            rec[0] += records
        elif term is not None:
            terms, occ, rec = [term, *terms], np.concatenate(([occurrences], occ)), np.concatenate(([records], rec))
        if len(terms) > 1:
            yield pa.RecordBatch.from_arrays([pa.array([t[0] for t in terms[:-1]], pa.string()), pa.array([t[1] for t in terms[:-1]], pa.string()), pa.array(occ[:-1]), pa.array(rec[:-1])], schema=schema)
        term, occurrences, records, last = terms[-1], int(occ[-1]), int(rec[-1]), record[b.num_rows - 1].as_py()
    if term is not None:
        yield pa.RecordBatch.from_arrays([pa.array([term[0]], pa.string()), pa.array([term[1]], pa.string()), pa.array([occurrences]), pa.array([records])], schema=schema)


def value_frequencies(tokens: DataFrame, buckets: int | None = None) -> DataFrame:
    """``(field, val, occurrences, records)`` for every distinct value of every field.

    ``tokens`` has ``field, val, record``. Equal tokens of an input batch are counted
    before the shuffle. Tokens are hash-partitioned by term and a bucket of the record,
    sorted by record, and scanned with one last-seen counter per term; a record falls
    into one bucket, so the buckets' counters add up. No set of records is kept anywhere,
    and a term with any share of all rows is spread over ``buckets`` tasks, by default all that
    the session's shuffles have.

    Values are compared as given. A null value is no token; a null record counts as an
    occurrence but as no record; repeated rows are further occurrences in the same record;
    an empty table gives an empty result; other columns are not read.
    """
    if buckets is None:
        buckets = max(BUCKETS, int(tokens.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    bucket = F.pmod(F.xxhash64("record"), F.lit(buckets))
    part = (
        tokens.select("field", "val", "record").where(F.col("val").isNotNull() & F.col("field").isNotNull())
        .mapInArrow(_precount, _PARTIAL)
        .repartition(F.col("field"), F.col("val"), bucket)
        .sortWithinPartitions("field", "val", "record")
    )
    return part.mapInArrow(_last_seen, COUNTS).groupBy("field", "val").agg(F.sum("occurrences").alias("occurrences"), F.sum("records").alias("records"))


def mark_useless(counts: DataFrame, n_rows: Column, rare_below: int = 5, common_above: float = 0.2) -> DataFrame:
    """Adds ``mark``: rare under ``rare_below`` occurrences, common above that share of ``n_rows``, else null.

    A value that is both (in a tiny table) is rare.
    """
    mark = F.when(F.col("occurrences") < rare_below, "rare").when(F.col("occurrences") > n_rows * common_above, "common")
    return counts.withColumn("mark", mark)
