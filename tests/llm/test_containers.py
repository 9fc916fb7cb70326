import os
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from slidemill.llm.containers import TOKENIZERS, fill_containers, fullest, pack, token_counts


def best_fill(lengths, capacity):
    sums = {0}
    for n in lengths:
        sums |= {s + n for s in sums if s + n <= capacity}
    return max(sums)


def test_fullest_combination_is_the_best():
    rng = random.Random(7)
    for _ in range(200):
        available = Counter(rng.randrange(1, 30) for _ in range(rng.randrange(1, 12)))
        capacity, first = 60, max(available)
        got = fullest(dict(available), capacity, first)
        assert all(available[n] >= c for n, c in got.items()) and got[first] >= 1
        rest = list((available - Counter([first])).elements())
        assert sum(n * c for n, c in got.items()) == first + best_fill(rest, capacity - first)


def test_pack_places_everything_once():
    rng = random.Random(1)
    sizes = Counter(min(100, int(rng.expovariate(1 / 25)) + 1) for _ in range(3000))
    placed, n = Counter(), 0
    for content, times in pack(dict(sizes), 100):
        assert sum(k * c for k, c in content.items()) <= 100
        n += times
        for k, c in content.items():
            placed[k] += c * times
    assert placed == sizes
    assert n <= -(-sum(k * c for k, c in sizes.items()) // 100) + 2


def test_frame(spark):
    rng = random.Random(3)
    data = [(k, rng.randrange(0, 120)) for k in range(2000)] + [(5000, 1050), (5001, 100), (None, 7), (6000, None), (1, 5), (1, 5), (5002, 200), (5002, 200)] + [(7000, 25)] * 1500
    df = spark.createDataFrame(data, "id long, n long").withColumn("container", F.lit("clash"))
    out = fill_containers(df, "id", "n", 100, shard=700).collect()
    used, pieces = Counter(), defaultdict(list)
    for r in out:
        used[r.container] += r.size
        pieces[r.id].append(r.size)
    assert max(used.values()) <= 100 and pieces[5002] == [100] * 4 and pieces[7000] == [25] * 1500
    assert len({r.container for r in out if r.id == 7000}) > 370
    assert sorted(pieces[5000]) == [50] + [100] * 10 and pieces[5001] == [100] and pieces[None] == [7] and pieces[6000] == [0]
    assert sum(used.values()) == sum(n or 0 for _, n in data)
    assert len(used) <= sum(used.values()) / 100 * 1.02 + 6
    again = fill_containers(df.repartition(6).orderBy(F.rand(1)), "id", "n", 100, shard=700).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, out))


def test_edges(spark):
    df = spark.createDataFrame([(1, 3)], "id long, n long")
    assert fill_containers(df.limit(0), "id", "n", 10).count() == 0
    assert fill_containers(df, "id", "n", 10).first().container == "shard/0/0"
    with pytest.raises(ValueError):
        fill_containers(df, "id", "n", 0)


@pytest.mark.skipif(not os.path.isdir(TOKENIZERS), reason="no tokenizers")
@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "piece_bpe_32k.model"])
def test_tokens(spark, name):
    df = spark.createDataFrame([(1, "the cat sat"), (2, ""), (3, None), (4, "<|endoftext|>"), (5, "word " * 50_000)], "id long, text string")
    got = {r.id: r.tokens for r in token_counts(df, "id", "text", f"{TOKENIZERS}/{name}").collect()}
    assert got[2] == got[3] == 0 and 3 <= got[1] <= 5 and got[4] > 1 and got[5] >= 50_000
