import random
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slidemill.functions.identity import normal_value
from slidemill.llm.frequency import _last_seen, mark_useless, tokens_of, value_frequencies
from tests.conftest import rows

TOKENS = "field string, val string, record string"


def brute(data):
    occurrences, records = Counter(), defaultdict(set)
    for f, v, r in data:
        if f is not None and v is not None:
            occurrences[f, v] += 1
            records[f, v] |= {r} - {None}
    return sorted(((*k, n, len(records[k])) for k, n in occurrences.items()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force_with_a_hot_term(spark, seed):
    rng = random.Random(seed)
    data = [(rng.choice("fg"), "hot" if rng.random() < 0.4 else f"v{rng.randrange(60)}", rng.choice([None, "", *(f"r{k}" for k in range(40))])) for _ in range(4000)]
    data += [("f", None, "r1"), ("f", "", "r1"), ("f", "x" * 100_000, "r1"), ("f", "x" * 100_000, "r1")]
    df = spark.createDataFrame(data, TOKENS).withColumn("occurrences", F.lit(0))
    for buckets in (1, 64):
        assert rows(value_frequencies(df, buckets)) == brute(data)
    assert rows(value_frequencies(df.repartition(7))) == brute(data)
    assert value_frequencies(df.limit(0)).count() == 0


def test_counters_go_on_over_batches():
    data = sorted([("f", f"v{k % 5}", f"r{k % 7}") for k in range(100)] * 2)
    schema = pa.schema([("field", pa.string()), ("val", pa.string()), ("record", pa.string()), ("n", pa.int64())])
    for size in (1, 3, 50, 200):
        parts = [data[k : k + size] for k in range(0, len(data), size)]
        batches = [pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in zip(*p)), pa.array([1] * len(p), pa.int64())], schema=schema) for p in parts]
        got = [tuple(r.values()) for b in _last_seen([batches[0].slice(0, 0), *batches]) for r in b.to_pylist()]
        assert sorted(got) == brute(data)


def test_marks(spark):
    counts = spark.createDataFrame([("f", "a", 4, 1), ("f", "b", 5, 1), ("f", "c", 20, 1), ("f", "d", 21, 1)], "field string, val string, occurrences long, records long")
    assert {r.val: r.mark for r in mark_useless(counts, F.lit(100)).collect()} == {"a": "rare", "b": None, "c": None, "d": "common"}
    cells = spark.createDataFrame([("A\xa0 b ", "x"), ("a B", "y"), ("  ", "z"), (None, "z")], "cell_type string, ab string")
    tokens = tokens_of(cells, {"cell_type": normal_value(F.col("cell_type"))}, F.col("ab"))
    assert rows(value_frequencies(tokens)) == [("cell_type", "a b", 2, 2)]
