import gzip
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from slidemill import cli
from slidemill.operators import folders as FO
from slidemill.sources import files, sinks
from slidemill.sources.atlas_xml import atlas_tables, parse_counts, read_entries
from tests.conftest import rows


def test_csv_keeps_strings_and_quotes(spark, tmp_path):
    path = tmp_path / "a.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write('id,t\n007,"x ""y"" z, w"\n1,\nNA, s \n')
    df = files.read_csv(spark, str(path))
    assert rows(df) == [("007", 'x "y" z, w'), ("1", ""), ("NA", " s ")]
    sinks.write_csv(df.withColumn("flag", F.col("id") == "1"), str(tmp_path / "out"), single=True)
    text = next((tmp_path / "out").glob("*.csv")).read_text()
    assert '007,"x ""y"" z, w",False' in text and "1,,True" in text and "NA, s ,False" in text
    assert files.read_optional_csv(spark, str(tmp_path / "none.csv")) is None
    with pytest.raises(FileNotFoundError):
        files.read_optional_csv(spark, str(tmp_path / "none.csv"), required=True)


def test_annotations_command(spark, tmp_path):
    meta = tmp_path / "meta"
    meta.mkdir()
    (tmp_path / "d.csv").write_text("image_id,antibody_id,ensembl_id,gene_name,tissue,organ,patient_id,set\ni1,a,g,n,Lung,o,1,train\n")
    (meta / "cells").write_text("antibody_id,ensembl_id,tissue,cell_type,staining,intensity,quantity,location\na,g,Lung,c,high,weak,none,nuclear\na,g,Lung,c,low,weak,none,nuclear\n")
    (meta / "tissues").write_text("antibody_id,ensembl_id,tissue,organ,ontology_terms\na,g,Lung,o,U1\n")
    (meta / "patients").write_text("antibody_id,ensembl_id,tissue,patient_id,sex,age\na,g,Lung,1,Male,40\n")
    assert cli.main(["annotations", "--dataset-csv", str(tmp_path / "d.csv"), "--metadata-dir", str(meta), "--out-dir", str(tmp_path / "o")], spark) == 0
    row = files.read_csv(spark, str(tmp_path / "o/d_image_annotations")).first()
    assert (row.sex, row.max_staining_code, row.protein_detected, row.ontology_terms) == ("Male", "3", "True", "U1")
    assert files.read_csv(spark, str(tmp_path / "o/d_cell_annotations")).count() == 1


def test_mirror_table(spark, tmp_path):
    head = ",".join(files.MIRROR_COLUMNS)
    (tmp_path / "run1.csv").write_text(f"{head},more\n1_A_1_1.tif,HPA1,Lung,M-00100;M-81403,x\n2_A_1_1.tif,HPA1,Lung,M-80003,x\n")
    (tmp_path / "run2.csv").write_text(f"other,{head}\ny,3_A_1_1.tif,HPA2,Skin,M-00100\n")
    (tmp_path / "list.txt").write_text("root/atlas/b1/4/1_A_1_1.tif\n/b0/\nroot/atlas/b2/4/1_A_1_1.tif\n//b3/5/x.TXT\n")
    out = files.mirror_table(spark, [str(tmp_path / f"run{k}.csv") for k in (1, 2)], str(tmp_path / "list.txt"), "atlas/")
    assert rows(out.select("Image Name", "source_file", "ftp_path")) == [("1_A_1_1.tif", "run1.csv", "b2/4/1_A_1_1.tif"), ("3_A_1_1.tif", "run2.csv", "")]
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        files.read_mirror_runs(spark, [str(tmp_path / "bad.csv")])


def test_zipped_locations(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "l.zip", "w") as z:
        z.writestr("l.tsv", "Gene\tReliability\tMain location\ng1\tApproved\tM\ng1\tOther\tN\n")
    assert rows(files.read_locations(spark, str(tmp_path / "l.zip"), ["Reliability", "Main location"])) == [("g1", "Approved", "M")]


def entry(gene, antibody, patient="7", snomed="M-00100", tif="http://x/4049/1_A_1_8.tif", tissue="Lung", pad="", assay="tissue", verification="enhanced"):
    image = f'<image imageType="selected"><imageUrl>http://x/4049/1_A_1_8.jpg</imageUrl>{f"<imageUrlTif>{tif}</imageUrlTif>" if tif else ""}</image>'
    return f"""<entry url="http://x/{gene}">{pad}<name>N{gene}</name><synonym>s1</synonym><synonym>s2</synonym>
<identifier db="Ensembl" id="{gene}"/><tissueExpression assayType="tissue"><data><tissue>no</tissue></data></tissueExpression>
<antibody id="{antibody}"><tissueExpression assayType="{assay}"><verification type="validation"> {verification} </verification><verification type="validation"> </verification>
<data><tissue organ="O" ontologyTerms="U">{tissue}</tissue><tissueCell><cellType>c</cellType><level type="staining">low</level><level type="staining">high</level></tissueCell>
<patient><sex>Male</sex><age>50</age><patientId>{patient}</patientId><sample><snomedParameters><snomed snomedCode="{snomed}"/></snomedParameters><assayImage>{image}</assayImage></sample></patient></data>
</tissueExpression></antibody></entry>"""


def test_xml_release(spark, tmp_path):
    path = tmp_path / "r.xml"
    entries = [entry("ENSG1", "HPA1"), entry("ENSG1", "HPA9", snomed="M-1"), entry("ENSG2", "HPA2", tif="", pad=f"<!-- {'x' * 70000} -->"), entry("ENSG3", "HPA3", assay="cancer")]
    path.write_text("<?xml version='1.0'?><release>" + "\n".join(entries) + "</release>")
    t = atlas_tables(spark, str(path))
    assert rows(t["genes"]) == [("ENSG1", "NENSG1", "s1, s2"), ("ENSG2", "NENSG2", "s1, s2")]
    assert rows(t["antibodies"]) == [("HPA1", "ENSG1", "NENSG1", "enhanced"), ("HPA2", "ENSG2", "NENSG2", "enhanced")]
    assert rows(t["cells"].select("antibody_id", "cell_type", "staining", "intensity")) == [("HPA1", "c", "high", ""), ("HPA2", "c", "high", "")]
    # the same image, patient and tissue under two antibodies: the TIF wins
    assert rows(t["images"].select("antibody_id", "image_type", "image_id", "patient_id", "download_status", "local_path")) == [("HPA1", "tif", "1_A_1_8", "7", "pending", "20250612-xml/4049")]
    assert rows(t["patients"].select("patient_id", "sex", "age")) == [("7", "Male", "50")] * 2
    counts = parse_counts(read_entries(spark, str(path))).first()
    assert (counts.entries, counts.cancer_sections, counts.antibodies, counts.genes) == (4, 1, 2, 2)
    assert cli.main(["crawl", "--xml-file", str(path), "--output-dir", str(tmp_path / "out"), "--format", "all"], spark) == 0
    assert files.read_csv(spark, str(tmp_path / "out/metadata/genes")).count() == 2
    gene = json.loads((tmp_path / "out/metadata/gene_documents/ENSG1.json").read_text())
    assert (gene["name"], gene["synonyms"], [a["id"] for a in gene["antibodies"]]) == ("NENSG1", ["s1", "s2"], ["HPA1"])
    tissue = gene["antibodies"][0]["tissues"][0]
    assert tissue["tissue_cells"][0]["cell_type"] == "c" and tissue["patients"][0]["images"] == [{"type": "tif", "url": "http://x/4049/1_A_1_8.tif"}]
    assert spark.read.json(str(tmp_path / "out/metadata/parent_folder_mapping")).collect()[0].asDict() == {"parent": "4049", "batch": "20250612-xml"}
    document = json.loads(next((tmp_path / "out").rglob("1_A_1_8.json")).read_text())
    assert document["tissues"] == [{"tissue": "Lung", "organ": "O", "ontology_terms": "U"}]


def test_malformed_xml_raises(spark, tmp_path):
    path = tmp_path / "r.xml"
    path.write_text("<p>" + entry("ENSG1", "HPA1").replace("</tissueCell>", "") + "</p>")
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        read_entries(spark, str(path)).select("entry.name").collect()


def test_batches_roll_over(spark):
    df = spark.createDataFrame([(k, f"p{k // 2}") for k in range(2400)], "ordinal long, parent string")
    got = {r.parent: r.batch for r in FO.assign_batches(df.repartition(5), "parent", "ordinal").collect()}
    assert all(got[f"p{k}"] == f"202506{12 + k // 500}-xml" for k in range(1200))


def test_folders(spark):
    images = spark.createDataFrame([(1, "http://x/77/i1.tif", "i1", "HPA1"), (2, "i2.tif", "i2", "HPA0005"), (3, "http://x/88/i3.tif", "i3", "HPA1"), (4, "http://x/99/i4.tif", "i4", "HPA1")], "ordinal long, image_url string, image_id string, antibody_id string")
    mirror = spark.createDataFrame([("i3", "20259999-xml/88/i3.tif"), ("i4", "short/i4.tif")], "image_id string, ftp_path string")
    got = rows(FO.resolve_folders(images, mirror).select("image_id", "local_path", "download_status"))
    assert got == [("i1", "20250612-xml/77", "pending"), ("i2", "20250612-xml/5", "pending"), ("i3", "20259999-xml/88", "ftp_available"), ("i4", "20250612-xml/99", "ftp_available")]


def test_documents(spark):
    schema = "ordinal int, image_id string, antibody_id string, ensembl_id string, gene_name string, patient_id string, local_path string, image_type string, image_url string, tissue string, organ string, ontology_terms string"
    data = [(k, "i", "a", "g", "n", "p", "l", kind, f"u{k}", t, "o", term) for k, kind, t, term in ((1, "jpg", "T1", "x"), (2, "tif", "T2", "x"), (3, "tif", "T1", "y"), (4, "jpg", "T1", "x"))]
    doc = FO.document_aggregate(spark.createDataFrame(data, schema)).first()
    assert doc.image_url == "u2" and [(t.tissue, t.ontology_terms) for t in doc.tissues] == [("T1", "x"), ("T2", "x"), ("T1", "y")]
