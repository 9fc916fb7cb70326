"""The queries against their SQL on the smallest tables, where the driver's tables are present."""

import os

import pytest

from slidemill.llm.queries import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
#: Language models need more texts than the smallest tables hold.
LARGER = {"p10_round_trips": "/root/testdata/sf0.01"}
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", ORACLE)
def test_query_equals_sql(spark, name):
    import duckdb

    db, folder = duckdb.connect(), LARGER.get(name, FOLDER)
    for f in os.listdir(folder):
        db.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{folder}/{f}'")
    result = db.execute(ORACLE[name])
    columns = [c[0] for c in result.description]
    df = QUERIES[name](spark, folder)
    assert sorted(df.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in df.select(*columns).collect()) == sorted(map(str, result.fetchall()))
