import pytest
from pyspark.sql import functions as F

from slidemill.operators import quality as Q
from slidemill.operators import split as S
from tests.conftest import rows


def ids(spark, hpa, cab=0):
    return spark.createDataFrame([(f"HPA{k:06d}",) for k in range(hpa)] + [(f"CAB{k:06d}",) for k in range(cab)], "antibody_id string")


def counts(df):
    return {r["set"]: r["count"] for r in df.groupBy("set").count().collect()}


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 7])
def test_small_numbers(spark, n):
    out = S.split_antibodies(ids(spark, n))
    got = counts(out)
    assert sum(got.values()) == n
    assert n < 3 and set(got) <= {"train"} or n >= 3 and got["train"] >= 1


def test_balance_of_sources(spark):
    out = S.split_antibodies(ids(spark, 400, 100))
    assert counts(out) == {"train": 350, "val": 50, "test": 100}
    assert counts(out.where("antibody_id LIKE 'CAB%'")) == {"train": 70, "val": 10, "test": 20}
    assert rows(out) == rows(S.split_antibodies(ids(spark, 400, 100).repartition(5)))
    assert rows(out) != rows(S.split_antibodies(ids(spark, 400, 100), seed=1))


def test_quantile_bins_and_fallback(spark):
    strata = {r.antibody_id: r.stratum for r in S.antibody_strata(ids(spark, 100, 3)).collect()}
    sizes = [list(strata.values()).count(f"HPA_{k}") for k in range(5)]
    assert sum(sizes) >= 100 and all(19 <= s <= 24 for s in sizes)
    assert "CAB_0" not in strata.values()  # too small, joins the largest stratum
    few = {r.stratum for r in S.antibody_strata(ids(spark, 4)).collect()}
    assert few == {"all"}
    odd = spark.createDataFrame([("XYZ",), ("A",)], "antibody_id string")
    assert S.antibody_strata(odd).count() == 2


def test_fractions_are_checked(spark):
    with pytest.raises(ValueError):
        S.split_antibodies(ids(spark, 5), (0.5, 0.1, 0.1))


def data(spark, labelled):
    return spark.createDataFrame(labelled, "image_id string, antibody_id string, ensembl_id string, set string")


def test_inheritance_and_conflicts(spark):
    now = data(spark, [("i1", "a1", "g1", ""), ("i2", "a1", "g1", ""), ("i3", "a2", "g1", ""), ("i4", "a3", "g2", "")])
    old = data(spark, [("i1", "a1", "g1", "test"), ("i9", "a9", "g9", "bad")])
    got = {r.image_id: r.set for r in S.inherit_labels(now, old).collect()}
    assert got == {"i1": "test", "i2": "test", "i3": "test", "i4": ""}
    out = S.assign_sets(now, earlier=old)
    assert {r.split_version for r in out.collect()} == {"v2"} and out.where("set = ''").count() == 0
    for twice in ([("i1", "a1", "g1", "test"), ("i1", "a1", "g1", "val")], [("i1", "a1", "g1", "test"), ("i2", "a1", "g1", "val")], [("i1", "a1", "g1", "test"), ("i3", "a2", "g1", "val")]):
        with pytest.raises(RuntimeError):
            S.inherit_labels(now, data(spark, twice)).count()


def test_versions(spark):
    df = spark.createDataFrame([("v2",)], "split_version string")
    assert S.check_split_version(df)
    with pytest.raises(ValueError):
        S.check_split_version(df.withColumn("split_version", F.lit("v1")))
    assert not S.check_split_version(df.drop("split_version"), allow_legacy=True)


def test_checks_pass_on_a_stratified_split_and_find_an_ordered_one(spark):
    images = ids(spark, 400, 100).select("antibody_id", F.concat(F.lit("G"), "antibody_id").alias("ensembl_id"), F.explode(F.array(*(F.lit(t) for t in ("Lung", "Skin")))).alias("tissue"))
    images = images.withColumn("stained", F.when(F.rand(3) < 0.5, "2009-01-02").otherwise("2010-05-06"))
    good = images.join(S.split_antibodies(images), "antibody_id")
    assert all(r.ok for r in Q.check_dataset("good", good).collect())
    number = F.regexp_extract("antibody_id", "([0-9]+)", 1).cast("int")
    ordered = images.withColumn("set", F.when(number < 280, "train").when(number < 320, "val").otherwise("test"))
    bad = {r.check: r.ok for r in Q.check_dataset("bad", ordered, stained="stained").collect()}
    assert not bad["strata and source shares"] and bad["antibodies disjoint"] and len(bad) == 7
    shared = {r.dataset_a + r.dataset_b: (r.n_shared, r.n_different) for r in Q.gene_agreement({"a": good, "b": ordered}).collect()}
    assert shared["ab"][0] == 500 and shared["ab"][1] > 0


def test_variation_distance_and_files(spark):
    df = spark.createDataFrame([("train", "2009"), ("train", "2010"), ("val", "2009"), ("val", None), ("test", "x")], "set string, y string")
    assert Q.variation_distance(df, F.col("y")).first()[0] == 0.5
    wanted = spark.createDataFrame([("p1",), ("p2",), ("p3",)], "path string")
    files = spark.createDataFrame([("p1", True), ("p2", False)], "path string, valid boolean")
    assert rows(Q.verify_files(wanted, files)) == [("p1", "ok"), ("p2", "corrupt"), ("p3", "missing")]
    assert rows(Q.missing_counts(df, ["y", "set"])) == [("set", 0), ("y", 1)]
