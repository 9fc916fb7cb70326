from slidemill.operators import annotate as A
from tests.conftest import rows

DATASET = "image_id string, antibody_id string, ensembl_id string, gene_name string, tissue string, organ string, patient_id string, set string"
CELLS = "row_id int, antibody_id string, ensembl_id string, tissue string, cell_type string, staining string, intensity string, quantity string, location string"


def frames(spark):
    dataset = spark.createDataFrame([("i1", "a", "g", "n", "Lung", "o", "1", "train"), ("i2", "a", "g", "n", "Lung", "o", "2", "val"), ("i3", "b", "g2", "n", "Skin", "o", "1", "test")], DATASET)
    cells = spark.createDataFrame(
        [
            (1, "a", "g", "Lung", "x cells", "High ", "strong", ">75%", "nuclear"),
            (2, "a", "g", "Lung", "x cells", "High ", "strong", ">75%", "nuclear"),
            (3, "a", "g", "Lung", "x cells", "low", "weak", "<25%", "none"),
            (4, "a", "g", "Lung", "y cells", "not representative", None, "", "Cytoplasmic/membranous, nuclear"),
            (5, "a", "other", "Lung", "z cells", "low", "weak", "<25%", "none"),
        ],
        CELLS,
    )
    tissues = spark.createDataFrame([("a", "g", "Lung", "U2"), ("a", "g", "Lung", "U1"), ("a", "g", "Lung", "")], "antibody_id string, ensembl_id string, tissue string, ontology_terms string")
    patients = spark.createDataFrame([(1, "a", "g", "Lung", "1", "Male", "40"), (2, "a", "g", "Lung", "1", "Male", "41")], "row_id int, antibody_id string, ensembl_id string, tissue string, patient_id string, sex string, age string")
    return dataset, cells, tissues, patients


def test_cells_and_images(spark):
    dataset, cells, tissues, patients = frames(spark)
    ann = A.cell_annotations(dataset, cells)
    got = rows(ann.select("image_id", "cell_type", "staining_code", "intensity_code", "quantity_code", "location_code"))
    assert got == [(i, *x) for i in ("i1", "i2") for x in (("x cells", 3, 3, 3, 2), ("y cells", -1, -1, -1, 3))]
    images = {r.image_id: r for r in A.image_annotations(dataset, cells, patients, tissues).collect()}
    one, three = images["i1"], images["i3"]
    assert (one.sex, one.age, one.ontology_terms, one.n_cell_types, one.cell_types, one.max_staining_code, one.protein_detected) == ("Male", "40", "U1;U2", 2, "x cells;y cells", 3, True)
    assert (three.sex, three.n_cell_types, three.cell_types, three.max_quantity_code, three.protein_detected) == ("", 0, "", -1, False)
    assert rows(A.cell_vocabulary(ann)) == [("x cells", 2, 1, 1, "Lung"), ("y cells", 2, 1, 1, "Lung")]
    assert rows(A.key_conflicts(cells.select("row_id", "antibody_id", "cell_type", "staining"), ["antibody_id", "cell_type"], "row_id")) == [("a", "x cells", 2)]


def test_locations(spark):
    dataset, *_ = frames(spark)
    columns = ["Gene", *A.LOCATION_COLUMNS]
    table = spark.createDataFrame([("g", "Approved", "M;N", "P", "", "", "", "")], ", ".join(f"`{c}` string" for c in columns))
    out = A.attach_locations(dataset, table)
    assert {r.image_id: r.subcellular_main_location for r in out.collect()} == {"i1": "M;N", "i2": "M;N", "i3": ""}
    assert rows(A.location_vocabulary(out)) == [("M", 1, 1, 2, 2), ("N", 1, 1, 2, 2), ("P", 0, 1, 0, 2)]
    assert rows(A.coverage(out, "subcellular_main_location")) == [(3, 2, 2, 1)]
