import pytest
from pyspark.sql import functions as F

from slidemill import cli
from slidemill.plans import pipeline as P
from slidemill.sources import files, sinks
from tests.conftest import rows

IMAGES = "antibody_id string, ensembl_id string, gene_name string, tissue string, organ string, patient_id string, image_type string, image_url string, image_id string, local_path string, row_id long"


def frames(spark):
    """Nine antibodies over four tissues; each has a reason to stay or to go.

    The number of images of an antibody in a tissue runs from one to four. Odd images are on the mirror.
    """
    kinds = {
        "CAB0021": ("E10", "enhanced"), "HPA0400": ("E10", "supported"),  # the better of one gene
        "HPA0777": ("E20", "approved"),  # alone
        "HPA0555": ("E30", "uncertain"), "CAB0099": ("E30", "approved"),  # uncertain, though listed first
        "HPA0600": ("E40", "enhanced"),  # also aims at E41
        "CAB0300": ("E50", "enhanced"),  # has no images, so HPA0301 takes its gene
        "HPA0301": ("E50", "approved"), "HPA0302": ("E60", "supported"),
    }
    tissues = {"Appendix": 1, "Breast": 2, "Stomach 2": 3, "Duodenum": 4, "Gallbladder": 3}
    images, n = [], 1
    for antibody, (gene, _) in kinds.items():
        for tissue, count in tissues.items() if antibody != "CAB0300" else ():
            for _ in range(count):
                images.append((antibody, gene, f"name of {gene}", tissue, "organ", f"{n % 5}.0", "tif", f"https://pictures.example/{antibody[3:]}/{n}_B_2_3.jpg", f"{n}_B_2_3", "", n))
                n += 1
    doubled = images[0]
    images += [(*doubled[:3], "Kidney", *doubled[4:10], n)]
    scores = [(a, g, s) for a, (g, s) in kinds.items()] + [("HPA0600", "E41", "enhanced")]
    mirror = [(f"{r[8]}.tif", f"batch/{r[0]}/{r[8]}.tif", k) for k, r in enumerate(images) if r[10] % 2] + [(f"{images[1][8]}.tif", "", 9999)]
    return (
        spark.createDataFrame(images, IMAGES), spark.createDataFrame(scores, "antibody_id string, ensembl_id string, `Reliability score` string"),
        spark.createDataFrame(mirror, "`Image Name` string, ftp_path string, row_id long"),
    )


KEPT = {"CAB0021", "HPA0777", "CAB0099", "HPA0301", "HPA0302"}


def test_selection(spark):
    images, antibodies, mirror = frames(spark)
    log = P.StepLog("full")
    out = P.select_images(images, P.guard_scores(antibodies), mirror, source="all", log=log).cache()
    assert {r.antibody_id for r in out.collect()} == KEPT
    assert {r.patient_id for r in out.collect()} == {"0", "1", "2", "3", "4"}
    assert all(r.idr_available == (r.row_id % 2 == 1) == bool(r.idr_ftp_path) for r in out.collect())
    # "Stomach 2" is left out; the image in two tissues is dropped in both
    assert out.count() == len(KEPT) * (1 + 2 + 4 + 3) - 1
    steps = {r.step: (r.images, r.antibodies, r.genes) for r in log.frame().collect()}
    assert steps == {
        "crawl": (8 * 13 + 1, 8, 6), "source": (8 * 13 + 1, 8, 6), "no secondary tissues": (8 * 10 + 1, 8, 6), "no uncertain antibodies": (7 * 10 + 1, 7, 6),
        "no multi-target antibodies": (6 * 10 + 1, 6, 5), "one antibody per gene": (5 * 10 + 1, 5, 5), "unique image id": (49, 5, 5),
    }
    mirrored = P.select_images(images, antibodies, mirror, source="idr", policy="drop")
    assert mirrored.where("row_id % 2 = 0").count() == 0 and mirrored.count() > 0


def test_full_and_pilot(spark):
    images, antibodies, mirror = frames(spark)
    selected = P.select_images(images, antibodies, mirror, source="all").cache()
    full = P.build_full(selected).cache()
    sets = {r.antibody_id: r.set for r in full.collect()}
    assert set(sets) == KEPT and sorted(sets.values()) == ["test", "train", "train", "train", "train"]
    assert rows(full.select("image_id", "set")) == rows(P.build_full(P.select_images(images.repartition(5), antibodies, mirror, source="all")).select("image_id", "set"))
    pilot = P.build_pilot(selected, ["Breast", "Gallbladder"], drop_probability=1.0, exclude=selected.where("tissue = 'Breast' AND antibody_id = 'HPA0777'")).cache()
    # pairs lose one, triplets lose one and, as pairs, one more
    assert {(r.antibody_id, r.tissue): r["count"] for r in pilot.groupBy("antibody_id", "tissue").count().collect()} == {(a, t): 1 for a in KEPT for t in ("Breast", "Gallbladder") if (a, t) != ("HPA0777", "Breast")}
    assert P.finalize(pilot).columns == list(P.OUTPUT_COLUMNS)
    kept = P.build_pilot(selected, ["Breast", "Gallbladder"], drop_probability=0.0)
    assert {r["count"] for r in kept.groupBy("antibody_id", "tissue").count().collect()} == {2}


def test_repeated_images_are_reported_and_refused(spark):
    images, antibodies, mirror = frames(spark)
    seen = []
    with pytest.raises(ValueError, match="repeated image_id: 1_B_2_3"):
        P.select_images(images, antibodies, mirror, source="all", policy="fail", report=lambda df: seen.extend(df.collect()))
    assert [(r.image_id, r.tissue) for r in seen] == [("1_B_2_3", "Appendix"), ("1_B_2_3", "Kidney")]


def test_guards(spark):
    images, antibodies, mirror = frames(spark)
    with pytest.raises(Exception, match="unknown reliability score"):
        P.guard_scores(antibodies.withColumn("Reliability score", F.lit("odd"))).collect()
    with pytest.raises(ValueError):
        P.filter_source(images, "x")
    none = P.attach_mirror(images, None)
    assert none.where("idr_available OR idr_url <> ''").count() == 0


def test_command_line(spark, tmp_path):
    images, antibodies, mirror = frames(spark)
    for name, df in (("images", images), ("antibodies", antibodies), ("mirror", mirror)):
        sinks.write_csv(df, str(tmp_path / name))
    out = str(tmp_path / "out")
    common = ["--images-csv", f"{tmp_path}/images", "--antibodies-csv", f"{tmp_path}/antibodies", "--idr-table", f"{tmp_path}/mirror", "--out-dir", out, "--source", "all"]
    log = tmp_path / "log"
    assert cli.main(["dataset", *common, "--log-file", str(log), "--save-plots", "--plot-dir", out], spark) == 0
    assert "one antibody per gene" in log.read_text() and files.read_csv(spark, f"{out}/tissue_counts").columns == ["value", "n", "share"]
    full = files.read_csv(spark, f"{out}/full_dataset")
    assert full.columns == list(P.OUTPUT_COLUMNS) and full.count() > 0
    assert cli.main(["dataset", *common, "--split-from", f"{out}/full_dataset", "--full-output", "again", "--stage", "full"], spark) == 0
    assert rows(files.read_csv(spark, f"{out}/again").select("image_id", "set")) == rows(full.select("image_id", "set"))
    assert cli.main(["checks", "--dataset", f"full={out}/full_dataset", "--tissue-tol", "1", "--strata-tol", "1"], spark) in (0, 1)
    with pytest.raises(SystemExit):
        cli.main(["dataset", *common, "--train-frac", "0.9"], spark)
