import json

import pytest
from pyspark.sql import functions as F

from slidemill.operators.nested import _UNREADABLE, _deep_json, array_levels, attach_parents, merged_schema, placed, read_payload, shred
from slidemill.queries import data_problems
from slidemill.queries.data_problems import ENTRY_CARRY, ENTRY_LEVELS
from tests.conftest import rows

XML = """<?xml version="1.0" encoding="UTF-8"?><entry url="u"><name><![CDATA[A]]></name><!-- <antibody id="no"/> -->
<antibody id="HPA1"><tissueExpression assayType="tissue"><data><tissue organ="o" ontologyTerms="U1;U2"> Liver </tissue>
<tissueCell><cellType>c1</cellType><quantity>&gt;75%</quantity></tissueCell><tissueCell><level type="x">y</level></tissueCell>
<patient><patientId>7</patientId></patient></data></tissueExpression></antibody></entry>"""
DOC = {"gene": {"name": "G"}, "antibodies": [{"id": "HPA2", "tissues": [{"tissue": "Skin", "tissueCells": [{"cellType": "k"}, {"cellType": None}], "patients": json.dumps([{"patientId": 9}])}]}]}
ONE = {"antibodies": {"id": "HPA3", "tissues": {"tissue": "Lung", "tissue_cells": {"cell_type": "s"}, "patients": None}}}
KEYED = {"antibodies": {"CAB4": {"tissues": [{"tissue": "Eye", "patients": [{"patient_id": "11"}]}]}}}


def frame(spark):
    data = [(1, "xml", XML), (2, "json", json.dumps(DOC)), (3, "json", json.dumps(ONE)), (4, "json", json.dumps(KEYED)), (5, "json", '{"a": '), (6, "xml", XML[:-20]), (7, "json", None), (8, None, "x"), (9, "json", "[1]"), (10, "json", "")]
    return spark.createDataFrame(data, "entry_id long, fmt string, payload string").withColumn("path", F.lit("clash"))


def test_every_layout_gives_the_same_tables(spark):
    out = shred(frame(spark), carry=ENTRY_CARRY, declared=ENTRY_LEVELS)
    leaf = F.element_at(F.split("path", "[.]"), -1)
    got = rows(out.where(leaf.isin("tissue_cell", "tissue_cells")).select("entry", F.upper(F.col("above")["antibody"]), F.trim(F.col("above")["tissue"]), F.col("fields")["cell_type"]))
    assert got == [(1, "HPA1", "Liver", "c1"), (1, "HPA1", "Liver", None), (2, "HPA2", "Skin", "k"), (2, "HPA2", "Skin", None), (3, "HPA3", "Lung", "s")]
    patients = rows(out.where(leaf.isin("patient", "patients")).select("entry", F.col("fields")["patient_id"]))
    assert patients == [(1, "7"), (2, "9"), (4, "11")]


def test_keys_link_children_to_parents(spark):
    out = shred(frame(spark), declared=ENTRY_LEVELS)
    keys = [r.row_key for r in out.collect()]
    assert len(keys) == len(set(keys))
    assert out.where("parent_key IS NOT NULL").join(out.select(F.col("row_key").alias("parent_key")), "parent_key", "left_anti").count() == 0
    assert {r.entry for r in out.select("entry").collect()} == {1, 2, 3, 4, 9}


def test_merged_schema(spark):
    schema = merged_schema(frame(spark))
    found = {(r.path, r.kind): r.n for r in schema.collect()}
    assert found["", "unreadable"] == 5 and found["", "array"] == 1
    assert found["antibodies", "array"] == 2 and found["antibodies", "object"] >= 1
    assert "antibodies.tissues.patients" in array_levels(schema)


def test_empty(spark):
    assert shred(frame(spark).limit(0)).count() == 0
    assert read_payload("json", '{"a": 1.50}') == {"a": "1.50"}


def shredded(spark, *payloads, fmt="json", **options):
    df = spark.createDataFrame([(k, fmt, p) for k, p in enumerate(payloads)], "entry_id long, fmt string, payload string")
    return sorted((r.path, r.row_key, r.ordinal, dict(r.fields)) for r in shred(df, **options).collect())


def test_any_depth_is_read(spark):
    for n in (150, 5_000, 200_000):
        text = '{"a": ' * n + "1" + "}" * n
        assert shredded(spark, text) == [("", "0", 0, {".".join("a" * n): "1"})] if n < 10_000 else read_payload("json", text) is not _UNREADABLE
        assert read_payload("json", text[:-1]) is _UNREADABLE
    assert len(shredded(spark, '{"a": ' + '[{"b": ' * 210 + "1" + "}]" * 210 + "}")) == 211
    assert len(shredded(spark, "<a><c/><c/>" * 300 + "</a>" * 300, fmt="xml")) == 601
    deep = read_payload("xml", "<a>" * 50_000 + "x" + "</a>" * 50_000)
    assert deep is not _UNREADABLE


@pytest.mark.parametrize("text", ['{"a": [1, -2.5e3, true, false, null, "x\\u00e9\\n", {}, []], "b": {"c": ""}}', "[]", " { } ", '"x"', "7", '[[[]], {"k": [{}]}]'])
def test_deep_parser_reads_like_the_standard_one(text):
    assert _deep_json(text) == json.loads(text, parse_int=str, parse_float=str)


@pytest.mark.parametrize("text", ["", "{", "[1,]", '{"a"}', '{"a": }', "[1] 2", '{"a": 1,}', "nul", '{a: 1}', "[1 2]", "]"])
def test_deep_parser_refuses_what_is_no_json(text):
    with pytest.raises(ValueError):
        _deep_json(text)


def test_nothing_is_dropped(spark):
    # names that would clash, ids as written, arrays and plain values at the top
    (row,) = shredded(spark, '{"aB": 1, "a_b": 2, "cD": true, "CD": 3, "cd": 4}')
    assert row[3] == {"aB": "1", "a_b": "2", "c_d": "true", "CD": "3", "cd": "4"}
    out = shredded(spark, '{"x": {"id1x": {"v": 1}, "ID2": {"v": 2}}}')
    assert [r[3] for r in out if r[0] == "x"] == [{"id": "id1x", "v": "1"}, {"id": "ID2", "v": "2"}]
    got = shredded(spark, '[{"u": 1}, {"v": [{"w": 2}]}, 3]')
    assert got == [("", "0:0", 0, {"u": "1"}), ("", "0:1", 1, {}), ("", "0:2", 2, {"text": "3"}), ("v", "0:1/v:0", 0, {"w": "2"})]
    assert shredded(spark, '"plain"') == [("", "0", 0, {"text": "plain"})]


def test_wanted_paths_only(spark):
    doc = json.dumps({"a": [{"b": [{"c": 1}], "d": [{"e": 2}]}], "f": [{"g": 3}]})
    assert [r[0] for r in shredded(spark, doc)] == ["", "a", "a.b", "a.d", "f"]
    assert shredded(spark, doc, wanted={"a.b": None}) == [r for r in shredded(spark, doc) if r[0] == "a.b"]
    assert [r[3] for r in shredded(spark, doc, wanted={"a.b": [], "f": ["g", "none"]})] == [{}, {"g": "3"}]


def test_parents_are_found_by_key(spark):
    rows_of = "row_key string, parent_key string, x string, y string"
    parents = spark.createDataFrame([("1/a:0", None, "p", "q"), ("1/a:1", None, None, "r")], rows_of)
    children = spark.createDataFrame([("1/a:0/b:0", "1/a:0", None, "c"), ("1/a:0/b:1", "1/a:0", "own", None), ("1/a:1/b:0", "1/a:1", None, "d"), ("2", None, "own", "e"), ("3/b:0", "3", None, "f")], rows_of)
    want = [("1/a:0/b:0", "p", "c"), ("1/a:0/b:1", "own", None), ("1/a:1/b:0", None, "d"), ("2", "own", "e"), ("3/b:0", None, "f")]
    assert rows(attach_parents(children, parents, ["x"]).select("row_key", "x", "y")) == want


def test_the_schema_tells_where_fields_stand():
    assert placed("a.b.c", {"a", "a.b", "d"}) == ("a.b", "c") and placed("a.b.c", {"a"}) == ("a", "b.c")
    assert placed("a.b.c", set()) == ("", "a.b.c") and placed("a.b", {"a", "a.b"}) == ("a.b", "text")


def entries(spark, folder, data):
    spark.createDataFrame(data, "entry_id long, fmt string, payload string").write.parquet(f"{folder}/raw_entries.parquet")
    return str(folder)


def test_the_flat_tables_are_linked_by_their_keys(spark, tmp_path, monkeypatch):
    # the same entry twice, and entries without id, are records of their own
    twice = [(e, f, p) for e, f, p, _ in rows(frame(spark)) if e in (1, 2, 4)] + [(2, "json", json.dumps(DOC)), (None, "json", json.dumps(ONE)), (None, "json", json.dumps(KEYED))]
    folder = entries(spark, tmp_path, twice)
    stored = data_problems.entry_tables(spark, folder)
    assert stored.select("row_key").distinct().count() == stored.count()
    want = [
        ("cells", 1, "HPA1", "Liver", "c1", 1), ("cells", 2, "HPA2", "Skin", "k", 2), ("cells", None, "HPA3", "Lung", "s", 1), ("patients", 1, "HPA1", "Liver", "7", 1),
        ("patients", 2, "HPA2", "Skin", "9", 2), ("patients", 4, "CAB4", "Eye", "11", 1), ("patients", None, "CAB4", "Eye", "11", 1), ("tissues", 1, "HPA1", "Liver", "U1;U2", 1),
    ]
    assert rows(data_problems.p5_tables(spark, folder)) == sorted(want, key=repr)
    # a child whose key leads to no parent has no antibody
    cut = stored.withColumn("parent_key", F.concat("parent_key", F.lit("?")))
    monkeypatch.setattr(data_problems, "entry_tables", lambda *_: cut)
    found = data_problems.p5_tables(spark, folder)
    assert found.where("child = 'cells'").count() > 0 and found.where("child = 'cells' AND antibody_id IS NOT NULL").count() == 0


@pytest.mark.parametrize(("fmt", "payload", "want"), [
    # levels that are nowhere an array have no table of their own
    ("xml", XML, [("cells", "HPA1", "Liver", "c1"), ("patients", "HPA1", "Liver", "7"), ("tissues", "HPA1", "Liver", "U1;U2")]),
    ("json", json.dumps(ONE), [("cells", "HPA3", "Lung", "s")]),
    ("json", "[1]", []),
])
def test_levels_come_from_the_schema(spark, tmp_path, monkeypatch, fmt, payload, want):
    folder = entries(spark, tmp_path, [(1, fmt, payload)])
    monkeypatch.setattr(data_problems, "ENTRY_LEVELS", [])
    assert rows(data_problems.p5_found(spark, folder).drop("entry_id")) == want
