import random

from pyspark.sql import functions as F

from slidemill.operators.orphans import orphan_references, orphan_report
from tests.conftest import rows


def frames(spark, references, targets):
    r = spark.createDataFrame(references, "ref_field string, key string, period string").withColumn("n", F.lit("clash"))
    return r, spark.createDataFrame(targets, "key string, first_period string, alive boolean")


def test_reasons(spark):
    refs = [("f", "a", "2025-02"), ("f", "a", "2025-02"), ("f", "b", "2025-01"), ("f", "c", "2025-05"), ("f", "d", None), ("f", None, "2025-01"), ("g", "e", None), ("f", "x", "2025-01")]
    targets = [("b", "2025-02", True), ("b", "2025-03", False), ("c", "2025-01", False), ("d", "2025-01", True), ("x", None, True), ("x", None, True), (None, "2025-01", True)]
    for heavy in (1, 2, 10_000):
        out = rows(orphan_references(*frames(spark, refs, targets), heavy_keys=heavy))
        assert out == [("f", "a", "2025-02", 2, "missing"), ("f", "b", "2025-01", 1, "later"), ("f", "c", "2025-05", 1, "gone"), ("g", "e", None, 1, "missing")]


def test_heavy_and_light_paths_agree_with_brute_force(spark):
    rng = random.Random(3)
    refs = [("f", "hot" if rng.random() < 0.4 else f"k{rng.randrange(80)}", f"2025-{rng.randrange(1, 9):02d}") for _ in range(1500)]
    targets = [(f"k{rng.randrange(100)}", f"2025-{rng.randrange(1, 9):02d}", rng.random() < 0.5) for _ in range(120)]
    first, alive = {}, {}
    for k, p, a in targets:
        first[k], alive[k] = min(first.get(k, p), p), alive.get(k, False) or a
    expected = {}
    for f, k, p in refs:
        if k not in first or not alive[k] or first[k] > p:
            expected[f, k, p] = expected.get((f, k, p), 0) + 1
    for heavy in (3, 10_000):
        found = orphan_references(*frames(spark, refs, targets), heavy_keys=heavy)
        assert {r[:3]: r[3] for r in rows(found)} == expected
    assert sum(r.n_references for r in orphan_report(found).collect()) == sum(expected.values())


def test_empty(spark):
    refs, targets = frames(spark, [("f", "a", "2025-02")], [("a", "2025-01", True)])
    assert orphan_references(refs.limit(0), targets).count() == 0
    assert orphan_references(refs, targets.limit(0)).count() == 1


def test_references_that_are_no_id(spark, tmp_path):
    from slidemill.queries.data_problems import ORACLE, p7_malformed

    at = "timestamp'2024-03-05'"
    spark.sql(f"SELECT explode(array('b/p/1_A_1_1.tif', 'b/p/notes.txt', ' ', NULL)) AS ftp_path, {at} AS listed_at").write.parquet(str(tmp_path / "idr_ftp_paths.parquet"))
    spark.sql(f"SELECT explode(array('1-A', '1_A_1_1', '')) AS image_id, 'https://x/y' AS idr_url, {at} AS released_at").write.parquet(str(tmp_path / "dataset.parquet"))
    got = rows(p7_malformed(spark, str(tmp_path)))
    assert got == [("dataset.idr_url", "2024-03", 3), ("dataset.image_id", "2024-03", 1), ("idr_ftp_paths.ftp_path", "2024-03", 1)]
    import duckdb

    db = duckdb.connect()
    for name in ("idr_ftp_paths", "dataset"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{tmp_path}/{name}.parquet/*.parquet')")
    assert sorted(db.execute(ORACLE["p7_malformed"]).fetchall()) == got
