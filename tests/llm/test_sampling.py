import pytest
from pyspark.sql import functions as F

from slidemill.llm import queries, sampling
from slidemill.llm.sampling import raised, rate_table, stable_sample
from tests.conftest import rows

SCHEMA = "id string, tissue string, old string, new string"


def sample(df, rates, default=0.1, stored=None):
    spark = df.sparkSession
    thresholds = raised(None if stored is None else rate_table(spark, stored), rate_table(spark, rates))
    return stable_sample(df, F.col("id"), F.array_compact(F.array("old")), F.array(F.coalesce("new", "tissue")), thresholds, default_rate=default)


def chosen(df, rates, stored=None):
    return {r.sample_key for r in sample(df, rates, stored=stored).where("sampled").collect()}


def data(spark, ids, tissue=lambda k: f"t{k % 3}"):
    return spark.createDataFrame([(f"i{k}", tissue(k), None, None) for k in ids], SCHEMA)


def test_stable_under_reruns_partitions_growth_and_raised_rates(spark):
    small, large = data(spark, range(3000)), data(spark, range(6000))
    rates = {"t0": 0.1, "t1": 0.3}
    one = chosen(small, rates)
    assert one == chosen(small.repartition(9).orderBy(F.rand(2)), rates)
    grown = chosen(large, rates)
    assert grown & {f"i{k}" for k in range(3000)} == one
    more = chosen(large, {"t0": 0.05, "t1": 0.5, "t2": 0.2}, stored=rates)
    assert grown <= more and len(more) > len(grown)
    per = {t: sum(int(x[1:]) % 3 == t for x in grown) / 2000 for t in range(3)}
    assert abs(per[0] - 0.1) < 0.03 and abs(per[1] - 0.3) < 0.04 and abs(per[2] - 0.1) < 0.03
    assert one <= chosen(small.unionByName(data(spark, range(3000), lambda k: "t1")), rates)  # a row in another stratum only adds
    assert one == chosen(small.union(small), rates)
    assert one == chosen(small, {"t0": 0.0}, stored=rates)  # a stored threshold is never lowered


def test_thresholds_only_rise(spark):
    table = raised(rate_table(spark, {"a": 0.5, "b": 0.1}), rate_table(spark, {"a": 0.2, "b": 0.3, "c": 1.0}))
    assert rows(table) == [("a", 0.5, 0.5), ("b", 0.1, 0.3), ("c", None, 1.0)]
    again = raised(table.select("stratum", "threshold"), rate_table(spark, {}))
    assert {r.stratum: r.threshold for r in again.collect()} == {"a": 0.5, "b": 0.3, "c": 1.0}


def test_many_strata_are_joined_to_the_same_result(spark, monkeypatch):
    df = data(spark, range(500), lambda k: "hot" if k % 3 else f"t{k}").unionByName(data(spark, range(500, 520), lambda k: None))
    rates, stored = {"hot": 0.4, "t3": 0.9, "t6": 0.9}, {"hot": 0.2, "t9": 1.0}
    few = rows(sample(df, rates, stored=stored))
    monkeypatch.setattr(sampling, "BROADCAST_STRATA", 1)
    assert rows(sample(df, rates, stored=stored)) == few


def test_a_choice_by_an_earlier_threshold(spark):
    df = spark.createDataFrame([(f"i{k}", None, "x", "y") for k in range(2000)], SCHEMA)
    out = sample(df, {"x": 1.0, "y": 1.0}, stored={"x": 0.25, "y": 0.0}).collect()
    lost = {r.sample_key for r in out if r.kept is False}
    assert lost == {r.sample_key for r in out if r.unit < 0.25} and 350 < len(lost) < 650


def test_choices_that_were_not_kept(spark):
    df = spark.createDataFrame([("a", None, "x", None), ("a", None, None, "y"), ("b", None, "x", "x"), ("c", None, "x", None), ("d", None, "x", "x"), ("d", None, "y", None), (None, None, "x", "y")], SCHEMA).withColumn("kept", F.lit(1))
    got = {r.sample_key: r.kept for r in sample(df, {"x": 1.0, "y": 1.0}, stored={"x": 1.0, "y": 1.0}).collect()}
    assert got == {"a": False, "b": True, "c": None, "d": False}


def test_edges(spark):
    assert sample(data(spark, range(3)).limit(0), {}).count() == 0
    long = spark.createDataFrame([("x" * 100_000, "t", None, None), ("", "t", None, None)], SCHEMA)
    assert sample(long, {"t": 1.0}).where("sampled").count() == 2 and sample(long, {"t": 0.0}).where("sampled").count() == 0
    assert len(rows(sample(long, {}))) == 2
    with pytest.raises(ValueError):
        sample(long, {"t": 1.5})


def test_lowered_thresholds_lose_keys_and_tell(spark):
    df = spark.createDataFrame([(f"i{k}", None, "x", "x") for k in range(1000)] + [("m", None, "x", "y")], SCHEMA)
    lowered = spark.createDataFrame([("x", 0.5, 0.2), ("y", None, 0.3)], "stratum string, before double, threshold double")
    out = stable_sample(df, F.col("id"), F.array("old"), F.array("new"), lowered).collect()
    lost = {r.sample_key for r in out if r.lost}
    assert lost == {r.sample_key for r in out if 0.2 <= r.unit < 0.5} - {r.sample_key for r in out if r.sampled} and 200 < len(lost) < 400
    assert {r.sample_key for r in out if r.moved} == {"m"}
    assert not any(r.lost for r in sample(df, {"x": 0.2, "y": 0.3}, stored={"x": 0.5}).collect())


def test_the_thresholds_decide_which_images_are_found(spark, tmp_path, monkeypatch):
    images = [(f"{k}_A_1_1", s, None, v) for k in range(400) for s, v in (("val", "v1"), ("val", "v2"))] + [("900_B_1_1", "val", "train", "v2")]
    spark.createDataFrame(images, "image_id string, set string, set_v1 string, split_version string").write.parquet(f"{tmp_path}/dataset.parquet")
    assert rows(queries.p2_found(spark, str(tmp_path))) == [("900_B_1_1",)]
    held = {r.image_id: r.unit for r in queries.p2_sample(spark, str(tmp_path)).collect()}
    # without raising, the images of val between the wanted and the stored rate fall out of the sample
    monkeypatch.setattr(queries, "raised", lambda stored, now: now.join(stored.withColumnRenamed("threshold", "before"), "stratum"))
    fallen = {k for k, unit in held.items() if 0.1 <= unit < 0.2} - {"900_B_1_1"}
    assert {r.image_id for r in queries.p2_found(spark, str(tmp_path)).collect()} == fallen | {"900_B_1_1"} and len(fallen) > 20
