import pytest
from pyspark.sql import functions as F

from slidemill.operators import relational as R
from slidemill.operators.thinning import last_of_groups, thin_pairs, thin_triplets
from tests.conftest import rows


def test_lookup_takes_the_last_row(spark):
    left = spark.createDataFrame([("a",), ("b",), ("c",), (None,)], "k string")
    right = spark.createDataFrame([("a", "old", 1), ("a", "new", 2), ("b", "", 1)], "k2 string, v string, o int")
    out = R.lookup(left, "k", right, "k2", "v", "o", "found")
    assert rows(out) == [("a", "new"), ("b", ""), ("c", ""), (None, "")]
    shuffled = R.lookup(left, "k", right.repartition(3).orderBy(F.desc("o")), "k2", "v", "o", "found")
    assert rows(shuffled) == rows(out)


DUPLICATES = [("a", "Lung"), ("a", "Colon"), ("b", "Adipose tissue"), ("b", "Soft tissue 1"), ("c", "Lung")]


def test_duplicate_policies(spark):
    df = spark.createDataFrame(DUPLICATES, "image_id string, tissue string")
    assert rows(R.resolve_duplicates(df, "prefer")) == [("b", "Soft tissue 1"), ("c", "Lung")]
    assert rows(R.resolve_duplicates(df, "drop")) == [("c", "Lung")]
    with pytest.raises(ValueError):
        R.resolve_duplicates(df, "fail")
    with pytest.raises(ValueError):
        R.resolve_duplicates(df, "other")
    assert R.duplicate_report(df).count() == 4
    twice = df.union(spark.createDataFrame([("b", "Soft tissue 1")], df.schema))
    assert rows(R.resolve_duplicates(twice, "prefer")) == [("c", "Lung")]


def test_keep_first_and_preferred(spark):
    df = spark.createDataFrame([("i", 1, "jpg"), ("i", 2, "tif"), ("i", 3, "tif"), ("j", 4, "jpg")], "k string, o int, kind string")
    assert rows(R.keep_first(df, ["k"], ["o"])) == [("i", 1, "jpg"), ("j", 4, "jpg")]
    assert rows(R.keep_preferred(df, ["k"], F.col("kind") == "tif", "o").select("k", "o", "position")) == [("i", 2, 1), ("j", 4, 4)]


def test_best_per_group_is_independent_of_order(spark):
    df = spark.createDataFrame([(g, f"a{k}", k % 3) for k, g in enumerate("xxyyzzzx" * 5)], "g string, a string, r int")
    one = rows(R.best_per_group(df, ["g"], F.col("r"), "a", 42))
    assert one == rows(R.best_per_group(df.repartition(7).orderBy(F.rand(1)), ["g"], F.col("r"), "a", 42))
    assert all(r[2] == 2 for r in one) and len(one) == 3
    assert one != rows(R.best_per_group(df, ["g"], F.col("r"), "a", 1))


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, `b c` int")
    assert R.pick(df, ["b c"], ["a", "z"]).columns == ["b c", "a"]
    with pytest.raises(KeyError):
        R.pick(df, ["z"])
    with pytest.raises(ValueError):
        R.require_columns(df, ["z"])
    assert R.small_enough(df) and not R.small_enough(df.union(df), 1)


def test_thinning(spark):
    sizes = {f"t{n}{k}": n for n in (1, 2, 3, 4) for k in range(40)}
    data = [("ab", t, f"{t}-{i}") for t, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(data, "antibody_id string, tissue string, image_id string")
    thinned = thin_triplets(df, 42)
    left = {r.tissue: r["count"] for r in thinned.groupBy("tissue").count().collect()}
    assert all(left[t] == (2 if n == 3 else n) for t, n in sizes.items())
    assert rows(thin_triplets(thinned, 42)) == rows(thinned)
    pairs = thin_pairs(thinned, 42)
    left = {r.tissue: r["count"] for r in pairs.groupBy("tissue").count().collect()}
    lost = sum(left[t] == 1 for t, n in sizes.items() if n in (2, 3))
    assert 15 < lost < 50 and all(left[t] == n for t, n in sizes.items() if n in (1, 4))
    assert rows(pairs) == rows(thin_pairs(thinned.repartition(9), 42))
    assert rows(thin_pairs(df, 42, 0.0)) == rows(df)
    lost = last_of_groups(df, 3, 42)
    assert lost.count() == sum(n == 3 for n in sizes.values()) and lost.join(thinned, ["tissue", "image_id"]).count() == 0
    # null is a group of its own
    blank = df.where(F.col("tissue").isin([t for t, n in sizes.items() if n == 3][:1])).withColumn("tissue", F.lit(None).cast("string"))
    assert thin_triplets(blank, 42).count() == 2


def test_counts(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "y"), ("c", "x")], "k string, v string")
    assert rows(R.group_pairs(df, "k", "v", 5)) == [("x | y", 2)]
    assert {r.value: r.share for r in R.value_counts(df, "v").collect()} == {"x": 0.6, "y": 0.4}
    assert R.unknown_values(df, "v", ["x"]) == ["y"]
    assert len(rows(R.k_per_group(df, "v", {"x": 2, "y": None}, "k", 1))) == 4
    assert R.first_n(df, ["k"], ["v"], 1).count() == 3


def test_skewed_join_equals_join(spark):
    big = spark.createDataFrame([("h", k) for k in range(50)] + [("a", 1), ("b", 2), ("z", 3), (None, 4)], "k string, v int")
    small = spark.createDataFrame([("h", 100), ("a", 1), ("b", 2), ("y", 0)], "k string, n int")
    out = R.join_skewed(big, small, "k", F.col("n") > 10)
    assert rows(out.drop("is_hot")) == rows(big.join(small, "k"))
    assert {r.k for r in out.where("is_hot").collect()} == {"h"}
