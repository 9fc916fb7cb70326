"""Queries against their SQL on the smallest tables, where the driver's tables are present."""

import os

import pytest

import __spark_entry__

FOLDER = "/root/testdata/sf0.001"
CHECKED = ["p4_found", "p7_found", "full_dataset", "split_sets", "cell_annotations", "image_documents", "folder_resolution", "thin_pairs", "best_per_group"]
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


def test_names():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, name):
    import duckdb

    db = duckdb.connect()
    db.execute("SET timezone = 'UTC'")
    for f in os.listdir(FOLDER):
        db.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    result = db.execute(__spark_entry__.oracle_sql()[name])
    columns = [c[0] for c in result.description]
    expected = sorted(map(str, result.fetchall()))
    df = __spark_entry__.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in df.select(*(f"`{c}`" for c in columns)).collect()) == expected


def test_flagship(spark):
    assert __spark_entry__.entry(spark).count() > 0
