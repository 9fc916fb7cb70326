import pytest
from pyspark.sql import functions as F

from slidemill.functions import identity as I
from slidemill.functions import scalars as S


def values(spark, function, texts):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, v string")
    return [r[0] for r in df.orderBy("k").select(function(F.col("v"))).collect()]


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (I.image_identity, {"70000007_A_3_8": "70000007_A_3_8", " scan/7_b_3_2.jpg\t": "7_B_3_2", "http://x/y/7%5FA%5F1%5F2.TIF?a=1": "7_A_1_2", "a\\7_A_1_2.tif": "7_A_1_2", "7_A_1": None, "": None, None: None}),
        (I.antibody_identity, {"HPA_002001": "HPA2001", " hpa 12": "HPA12", "CAB-7": "CAB7", "HPA": None, "12": None, None: None}),
        (I.gene_identity, {"ensg90010000001.3": "ENSG90010000001", "\tENSG90010000001 ": "ENSG90010000001", "ENSG1": None, "": None, None: None}),
        (I.label_identity, {"Training set": "train", "tra": "train", " Validation": "val", "val\t": "val", "test-set": "test", "TESTING": "test", "unassigned": None, "-": None, None: None}),
        (I.version_identity, {"2": "v2", "v1.0": "v1", " V2 ": "v2", "v3": None, "": None, None: None}),
        (I.mirror_path_identity, {"r/b1-xml//4/7_a_1_2.TIF ": "b1-xml/4/7_A_1_2", "b1%2Dxml/4/7_A_1_2.tif#f": "b1-xml/4/7_A_1_2", "4/7_A_1_2.tif": None, "": None, None: None}),
        (I.normal_value, {" Very  \nStrong ": "very strong", "  ": None, "": None, None: None}),
    ],
)
def test_identities(spark, function, cases):
    assert values(spark, function, list(cases)) == list(cases.values())


@pytest.mark.parametrize(
    ("function", "cases"),
    [
        (S.whole_number_id, {"12.0": "12", "12.5": "12.5", "x.0": "x.0", "": ""}),
        (S.id_source, {"HPA12": "HPA", "XYZ": "other", "12": "other"}),
        (S.id_prefix, {"HPA12": "HPA", "XYZ": "XYZ", "12": "other"}),
        (S.stem, {"a/b.c.tif": "b.c", "a/.bashrc": ".bashrc", "x": "x", "a/..b.t": "..b"}),
        (S.tif_name, {"a.jpeg": "a.tif", "a.JPG": "a.JPG", "b.tiff": "b.tif"}),
        (S.location_code, {"Cytoplasmic/membranous, nuclear": 3, "nuclear": 2, "none ": 0, "x": -1, None: -1}),
        (lambda c: S.ordinal_code(c, S.QUANTITY_CODES), {" 25% - 75%": 2, "25-75%": 2, ">75%": 3, "half": -1, None: -1}),
        (S.antibody_digits, {"HPA00012": "12", "XX9": "XX9", "CAB7": "7"}),
        (lambda c: S.after_marker(c, "root/"), {"/a/root/b/root/c": "b/root/c", "//x": "x"}),
    ],
)
def test_scalars(spark, function, cases):
    assert values(spark, function, list(cases)) == list(cases.values())


def test_named_paths_and_sources(spark):
    assert S.named_paths(["a=b/c", "d=e=f"]) == {"a": "b/c", "d": "e=f"}
    with pytest.raises(ValueError):
        S.named_paths(["a"])
    with pytest.raises(ValueError):
        S.source_urls(["other"], {})
