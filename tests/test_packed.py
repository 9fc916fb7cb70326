import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from slidemill.operators.packed import Dictionary, Segmenter, learned, split_packed
from tests.conftest import rows

CASES = {
    "A1;B2": ["A1", "B2"],
    "YC5/C31 / YB6": ["YC5/C31", "YB6"],
    '"""YN1"" factor", YM2': ['"YN1" factor', "YM2"],
    '["a \\"x\\" b", "c"]': ['a "x" b', "c"],
    ';"x, y",, ;z;': ["x, y", "z"],
    "a；b\tc\nd|e": ["a", "b", "c", "d", "e"],
    '"open; x': ['"open', "x"],
    "": [],
    " ; ,": [],
    "[]": [],
}


@pytest.mark.parametrize("text", CASES)
def test_segments(text):
    assert list(Segmenter(Dictionary()).cut(text)) == CASES[text]


def test_known_values_protect_delimiters():
    s = Segmenter(Dictionary({"Nucleoli, rim zone": 3, "A, B": 2, "C; D": 9}, {"Nucleoli": 4, "rim zone": 1, "A": 400, "B": 300}, 1000))
    assert list(s.cut("Nucleoli, rim zone;Cytosol")) == ["Nucleoli, rim zone", "Cytosol"]
    assert list(s.cut("x; Nucleoli, rim zone | y")) == ["x", "Nucleoli, rim zone", "y"]
    assert list(s.cut("A, B; x")) == ["A", "B", "x"]  # both are common by themselves
    assert list(s.cut('Nucleoli, "rim zone"; x')) == ["Nucleoli", "rim zone", "x"]
    # nothing tells the inner delimiter from the separators
    assert list(s.cut("Nucleoli, rim zone")) == ["Nucleoli", "rim zone"]
    assert list(s.cut("C; D; E")) == ["C", "D", "E"] and list(s.cut("Nucleoli, rim zone, x; y")) == ["Nucleoli", "rim zone", "x", "y"]


def test_cover_is_the_likeliest_of_all():
    rng = random.Random(4)
    words = ["a", "b", "c"]
    for _ in range(300):
        spans = {", ".join(rng.choices(words, k=rng.randrange(2, 4))): rng.randrange(1, 30) for _ in range(3)}
        known = Dictionary(spans, {w: rng.randrange(1, 30) for w in words}, 200)
        parts = [rng.choices(words, k=rng.randrange(1, 4)) for _ in range(3)]
        text = ";".join(", ".join(p) for p in parts)
        expected = []
        for p in parts:
            whole = ", ".join(p)
            split = sum(known.cost(w) for w in p)
            expected += [whole] if len(p) > 1 and whole in spans and known.cost(whole) < split else p
        assert list(Segmenter(known).cut(text)) == expected


value = st.text(alphabet="ab -/:().,;|\"", min_size=1, max_size=8).map(str.strip).filter(lambda v: v and not v.startswith(("[", "{")))


@settings(max_examples=200, deadline=None)
@given(st.lists(value, min_size=2, max_size=5), st.sampled_from([";", ", ", " | ", "\n", ";;"]))
def test_round_trip_of_quoted_values(values, separator):
    packed = separator.join('"' + v.replace('"', '""') + '"' for v in values)
    assert list(Segmenter(Dictionary()).cut(packed)) == values


def test_frame(spark):
    data = [(1, "a;b", "x"), (1, "a;b", "x"), (2, None, "y"), (3, "", None), (4, "one", "z"), (5, '"p, q";r;' * 3000, "w")]
    df = spark.createDataFrame(data, "id long, f string, val string")
    out = rows(split_packed(df, "f", ["id"]))
    assert out[:4] == [(1, 1, "a"), (1, 1, "a"), (1, 2, "b"), (1, 2, "b")]
    assert (4, 1, "one") in out and sum(r[0] == 5 for r in out) == 6000
    assert {r[0] for r in rows(split_packed(df, "f", ["id"], least=2))} == {1, 5}
    assert learned(df, "f").spans == {"p, q": 3000} and learned(df, "f", limit=0) is None
    assert split_packed(df.limit(0), "f", ["id"]).count() == 0
    with pytest.raises(ValueError):
        split_packed(df, "f", ["id", "val"])


def test_a_dictionary_beyond_the_limit_gives_the_same(spark):
    rng = random.Random(9)
    names = [f"n{k}, s{k % 7}" for k in range(40)] + [f"u{k} / w{k}" for k in range(10)] + ["x, y"]
    data = [(k, f'"{v}"') for k, v in enumerate(names)] + [(100 + k, "x; y; z") for k in range(9)]
    data += [(200 + k, rng.choice(["; ", " | "]).join(rng.choices([*names, "plain", '"q; r"', "x", "y"], k=rng.randrange(1, 5)))) for k in range(150)]
    df = spark.createDataFrame([*data, (900, None), (901, " "), (902, "[n1, s1; x]"), (902, "[n1, s1; x]")], "id long, f string")
    one = rows(split_packed(df, "f", ["id"]))
    assert one == rows(split_packed(df, "f", ["id"], limit=3))
    kept = [v for _, _, v in one if v in names]
    assert len(kept) > 51 and any(v.startswith("u") for v in kept)
