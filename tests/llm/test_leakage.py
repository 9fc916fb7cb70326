import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from slidemill.llm import leakage as L
from tests.conftest import rows


def test_suffix_array():
    rng = random.Random(1)
    for n in (0, 1, 2, 50, 300):
        t = [rng.randrange(4) for _ in range(n)]
        assert L.suffix_array(np.array(t, np.int64)).tolist() == sorted(range(n), key=lambda i: t[i:])
    assert L.suffix_array(np.zeros(500, np.int64)).tolist() == list(range(499, -1, -1))


def brute(docs, items, least):
    """(document, item) to the length of the longest common run of words."""
    out = {}
    for d, a in docs:
        for i, b in items:
            x, y = L.words(a), L.words(b)
            best, last = 0, [0] * (len(y) + 1)
            for p in x:
                now = [0] * (len(y) + 1)
                for k, q in enumerate(y):
                    if p == q:
                        now[k + 1] = last[k] + 1
                        best = max(best, now[k + 1])
                last = now
            if best >= least and d is not None:
                out[d, i] = max(best, out.get((d, i), 0))
    return out


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(25)] + ["Été", "x²", "a_b"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, text(rng.randrange(3, 30))) for k in range(12)] + [(90, ""), (91, "a b c")]
    docs = [(k, text(rng.randrange(0, 40))) for k in range(60)]
    for k in range(20):
        a = items[rng.randrange(12)][1].split()
        cut = rng.randrange(len(a))
        docs.append((100 + k, text(3) + " – " + ",\n".join(a[cut:]).upper() + "; " + text(3)))
    docs += [(1, docs[70][1]), (200, items[0][1]), (201, items[0][1]), (200, items[1][1]), (202, ""), (203, None), (None, items[0][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("shard", [40, 1_000_000])
def test_against_brute_force(spark, seed, shard):
    docs, items = corpus(seed)
    c = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit("clash"))
    i = spark.createDataFrame([*items, (None, "x"), (5, None)], "item_id long, text string")
    for least in (3, 8):
        found = L.leaked_passages(c, i, least, shard)
        out = found.collect()
        assert {(r.doc_id, r.item_id): r.n_words for r in out} == brute(docs, items, least)
        texts, held = {}, {k: t for k, t in items}
        for d, t in docs:
            texts.setdefault(d, []).append(t)
        for r in out:
            want = L.words(held[r.item_id])[r.item_word : r.item_word + r.n_words]
            assert any(L.words(t)[r.doc_word : r.doc_word + r.n_words] == want for t in texts[r.doc_id])
    clean = {r.doc_id for r in L.without_leaks(c, found).collect()}
    assert not clean & {r.doc_id for r in out} and 202 in clean


def test_edges(spark):
    c = spark.createDataFrame([(1, "a b c d e f g h " * 40_000), (2, "a b c d e f g")], "doc_id long, text string")
    i = spark.createDataFrame([(7, "z A, b. C d e f g h! q")], "item_id long, text string")
    assert rows(L.leaked_passages(c, i).select("doc_id", "item_id", "n_words")) == [(1, 7, 8)]
    assert L.leaked_passages(c.limit(0), i).count() == 0 and L.leaked_passages(c, i.limit(0)).count() == 0
    old, L.EVAL_LIMIT = L.EVAL_LIMIT, 5
    try:
        with pytest.raises(ValueError):
            L.leaked_passages(c, i)
    finally:
        L.EVAL_LIMIT = old
