import random

import pytest
from pyspark.sql import functions as F

from slidemill.llm import encoding as E
from tests.conftest import rows

ALPHABETS = {"de": "aeiouäöünrstlkmgdß", "fr": "aeiouéèêàçnrstlmd", "pl": "aeiouąęłńćższrtkm", "ru": "аеиоубвгдклмнпрстя"}


def words(lang, rng, n):
    letters = ALPHABETS[lang]
    book = random.Random(lang)
    vocabulary = ["".join(book.choice(letters) for _ in range(book.randrange(3, 9))) for _ in range(300)]
    return " ".join(rng.choice(vocabulary) for _ in range(n)) + rng.choice([".", " – 25 °C.", "…"])


@pytest.fixture(scope="module")
def data():
    rng = random.Random(11)
    train = [(lang, words(lang, rng, rng.randrange(8, 60))) for lang in ALPHABETS for _ in range(300)]
    return E.Repairer(E.train(train)), [(lang, words(lang, rng, rng.randrange(10, 60))) for lang in ALPHABETS for _ in range(100)]


def misread(text, written, read_as, times=1):
    for _ in range(times):
        text = "".join(E._TABLES[read_as][b] for b in text.encode(written))
    return text


WAYS = [("utf-8", "cp1252", 1), ("utf-8", "cp1252", 2), ("utf-8", "latin-1", 1), ("utf-8", "mac_roman", 1), ("utf-8", "cp1251", 1), ("cp1252", "cp850", 1), ("cp1251", "cp1252", 1), ("cp1250", "cp1252", 1)]


@pytest.mark.parametrize("way", WAYS)
def test_held_out_accuracy(data, way):
    repairer, held = data
    found = restored = n = 0
    for lang, text in held:
        try:
            bad = misread(text, *way)
        except UnicodeEncodeError:
            continue
        if bad == text:
            continue
        n += 1
        garbled, out, _ = repairer.repair(bad, lang)
        found += garbled
        restored += out == text
    assert n >= 50 and found / n > 0.97 and restored / n > 0.9


def test_clean_texts_stay(data):
    repairer, held = data
    for lang, text in held:
        for code in (lang, lang.upper(), None, "xx"):
            assert repairer.repair(text, code) == (False, text, None)


def test_partly_garbled_and_lost(data):
    repairer, held = data
    a, b = (t for lang, t in held[:2])
    bad = f"{a} {misread(b, 'utf-8', 'cp1252')}"
    assert repairer.repair(bad, "de")[:2] == (True, f"{a} {b}")
    lost = a.replace("ä", "�")
    assert repairer.repair(lost, "de") == (True, lost, None)
    assert repairer.repair("", "de")[0] is False and repairer.repair(None, None) == (False, None, None)
    long = f"{a} " * 2000 + misread(b, "utf-8", "cp1252")
    assert repairer.repair(long, "de")[0]


@pytest.mark.parametrize("sign", [" 😀", "😀", " ₽"])
@pytest.mark.parametrize("times", [1, 2])
def test_a_rare_sign_does_not_hide_a_wrong_decoding(data, sign, times):
    repairer, held = data
    for lang, text in held[:20]:
        assert repairer.repair(misread(text + sign, "utf-8", "cp1252", times), lang)[:2] == (True, text + sign)
        assert repairer.repair(text + sign, lang) == (False, text + sign, None)


def test_accidental_runs_stay(data):
    repairer, held = data
    # the last two characters are also the bytes of one that no alphabet holds
    for lang, text in held[:20]:
        assert repairer.repair(text + " Ð¶", lang) == (False, text + " Ð¶", None) or "ж" in repairer.regular
        assert repairer.repair(text + " Ò±", lang) == (False, text + " Ò±", None)


def test_languages():
    assert [E.language_of(x) for x in ("EN", "en-XX", "deu", "", None, "???")] == ["en", "en", "de", None, None, None]
    assert E.train([("de", "für")] * 3) == []
    assert E.Repairer([]).repair(misread("für", "utf-8", "cp1252"), "de")[:2] == (True, "für")


def test_frames(spark, data):
    _, held = data
    clean = [(k, lang, t) for k, (lang, t) in enumerate(held * 4)]
    bad = [(10_000 + k, lang, misread(t, "utf-8", "cp1252")) for k, (lang, t) in enumerate(held[:50])]
    extra = [(20_000, "de", None), (20_001, None, ""), (20_002, "de", "plain"), (10_000, *bad[0][1:])]
    df = spark.createDataFrame(clean + bad + extra, "doc_id long, lang string, text string").withColumn("chain", F.lit("clash"))
    out = E.garbled_documents(df)
    got = {r.doc_id: r.repaired for r in out.collect()}
    assert set(got) == {k for k, *_ in bad} and out.count() == 51
    assert sum(got[10_000 + k] == held[k][1] for k in range(50)) >= 47
    assert {r.doc_id for r in E.garbled_documents(df.repartition(5)).collect()} == set(got)
    assert E.garbled_documents(df.limit(0)).count() == 0
    added = E.repair_text(df, E.sampled_models(df), "text", "lang")
    assert added.where("repair.garbled").count() == 51 and added.where("doc_id = 20002 AND repair.repaired = 'plain'").count() == 1
    assert len(rows(added.where("text IS NULL"))) == 1
    with pytest.raises(ValueError):
        E.repair_text(df, [], "text", "lang", "chain")


def test_models_are_fitted_on_every_row(spark):
    # 45 texts of a language among 25,000: a sample of the table holds fewer than a model needs
    rng = random.Random(4)
    clean = [t for t in (words("pl", rng, 40) for _ in range(1_000)) if E.clean_sample(t)][:45]
    texts = [("pl", t) for t in clean] + [("de", words("de", rng, 3)) for _ in range(25_000)]
    long = " ".join(["aussi été frère"] * 2_000)  # over any limit of characters
    df = spark.createDataFrame([(k, *t) for k, t in enumerate(texts + [("fr", long)] * 45)], "doc_id long, lang string, text string")
    models = E.sampled_models(df)
    assert [m.name for m in models] == ["de", "fr", "pl"]
    assert models == E.sampled_models(df.repartition(7)) == E.train(texts + [("fr", long)] * 45)
    held = [words("pl", rng, 30) for _ in range(40)]
    repairer = E.Repairer(models)
    assert sum(repairer.repair(misread(t, "cp1250", "cp1252"), "pl")[1] == t for t in held if misread(t, "cp1250", "cp1252") != t) >= 36
