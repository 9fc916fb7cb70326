import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from slidemill.llm.representative import Bundle, Dependency, best_representatives, choose, duplicate_classes, duplicate_pairs, resolve_by_name
from tests.conftest import rows

SCHEMA = "id long, g string, street string, city string, phone string, kind string, mail string, t long, u long, at timestamp"
T0 = datetime.datetime(2025, 1, 1)


def bundles():
    return [Bundle("place", ("street", "city"), F.col("t")), Bundle("call", ("phone", "kind"), F.col("u")), Bundle("post", ("mail",))]


LINKS = [Dependency("place", ("city",), "call", ("kind",)), Dependency("place", ("city",), "post", ("mail",))]


def frame(spark, data):
    return spark.createDataFrame([(*d, *[None] * (10 - len(d))) for d in data], SCHEMA).withColumn("group_key", F.lit("clash"))


def test_bundles_come_whole_from_one_row(spark):
    data = [(1, "a", "s1", None, "1", "k", None, 1, 1), (2, "a", "s2", "c2", None, None, None, 0, 5), (3, "b", None, "", "9", "k"), (4, None, "s", "c", "1", "k")]
    found = best_representatives(frame(spark, data), F.col("g"), "id", bundles())
    got = {r.group_key: r for r in found.survivors.collect()}
    assert set(got) == {"a", "b"} and got["a"].n_rows == 2
    assert (got["a"].place.street, got["a"].place.city) == ("s2", "c2")  # the complete bundle, not a mixture
    assert (got["a"].call.phone, got["b"].place.street, got["b"].place.city) == ("1", None, None)
    assert rows(found.members) == [("a", 1), ("a", 2), ("b", 3)]
    assert rows(duplicate_pairs(found)) == [(1, 2)]
    assert rows(duplicate_classes(found)) == [(1, 1, 1), (2, 1, 1)]


def test_trust_recency_and_ties(spark):
    data = [(1, "a", "x", "c", "1", "k", None, 1), (2, "a", "y", "c", "1", "k", None, 3), (3, "b", "p", "c", "1", "k", None, 1), (4, "b", "q", "c", "1", "k", None, 1)]
    df = frame(spark, data).withColumn("at", F.expr("timestamp'2025-01-01' + make_interval(0, 0, 0, 10 - id)"))
    by_time = {r.group_key: r.place.street for r in best_representatives(df, F.col("g"), "id", bundles(), recency=F.col("at")).survivors.collect()}
    assert by_time == {"a": "y", "b": "p"}
    by_value = {r.group_key: r.place.street for r in best_representatives(df.repartition(3), F.col("g"), "id", bundles()).survivors.collect()}
    assert by_value == {"a": "y", "b": "q"}


def test_the_later_row_wins_by_a_microsecond(spark):
    data = [(k * 2 + j, f"g{k}", f"s{j}", "c", None, None, None, 1, 1, T0 + datetime.timedelta(days=k * 17, microseconds=j)) for k in range(100) for j in (0, 1)]
    out = best_representatives(frame(spark, data), F.col("g"), "id", bundles(), recency=F.col("at")).survivors.collect()
    assert {r.place.street for r in out} == {"s1"}


def score(row, fields, trust):
    full = sum(row[f] is not None for f in fields)
    return round(full * 1000 / len(fields)) * 1000 + (row[trust] or 0 if trust else 0), (row[9] - datetime.datetime(1970, 1, 1)) // datetime.timedelta(microseconds=1)


def text(values):
    return tuple((v is not None, v or "") for v in values)


def brute(group):
    """Every combination of rows' values that keeps both dependencies; the best sum, then the greatest values."""
    sides = [((2, 3), 7), ((4, 5), 8), ((6,), None)]
    links = [(3, 5), (3, 6)]
    meant = []
    for k, (x, y) in enumerate(links):
        of = {}
        for r in sorted(group, key=lambda r: (score(r, *sides[k + 1]), text(r[f] for f in sides[k + 1][0]))):
            if r[x] is not None and r[y] is not None:
                of[r[x]] = r[y]
        meant.append(of)
    distinct = [list({(tuple(r[f] for f in fields), score(r, fields, trust)) for r in group}) for fields, trust in sides]
    best = None
    for place, call, post in itertools.product(*distinct):
        if meant[0].get(place[0][1]) not in (None, call[0][1]) or meant[1].get(place[0][1]) not in (None, post[0][0]):
            continue
        total = tuple(a + b + c for a, b, c in zip(place[1], call[1], post[1]))
        best = max(best or (((-1, 0),)), (total, text(place[0]), text(call[0]), text(post[0]), place[0], call[0], post[0]), key=lambda t: t[:4])
    return best[4:]


@pytest.mark.parametrize(("limit", "hot", "few"), [(512, 100_000, 100_000), (1, 100_000, 100_000), (512, 50, 100_000), (512, 50, 10)])
def test_search_and_joins_find_the_same_best_combination(spark, limit, hot, few):
    rng = random.Random(5)
    data, groups = [], {}
    for k in range(500):
        g = "hot" if k % 7 == 0 else f"g{rng.randrange(130)}"
        pick = lambda name, n: rng.choice([None, f"{name}{rng.randrange(n)}", f"{name}{rng.randrange(n)}"])
        row = (k, g, pick("s", 9), pick("c", 4), pick("p", 9), pick("k", 4), pick("m", 3), rng.randrange(4), rng.randrange(4), T0 + datetime.timedelta(seconds=rng.randrange(3)))
        data.append(row)
        groups.setdefault(g, []).append(row)
    found = best_representatives(frame(spark, data), F.col("g"), "id", bundles(), LINKS, F.col("at"), search_limit=limit, hot_rows=hot, broadcast_rows=few)
    out = found.survivors.collect()
    assert len(out) == len(groups)
    for r in out:
        assert (tuple(r.place), tuple(r.call), tuple(r.post)) == brute(groups[r.group_key]), groups[r.group_key]
        assert r.n_rows == len(groups[r.group_key])
    pairs = sorted((a[0], b[0]) for g in groups.values() for a, b in itertools.combinations(g, 2))
    assert rows(duplicate_pairs(found)) == sorted(pairs, key=repr)


def test_branch_and_bound_stops_early():
    class Link(str):
        seen = 0

        def __eq__(self, other):
            Link.seen += 1
            return str.__eq__(self, other)

        __hash__ = str.__hash__

    determining = [((5, 0), 1, "a", "x"), ((4, 0), 0, "b", "y")] + [((0, 0), 0, f"n{k}", "x") for k in range(1000)]
    determined = [[((5, 0), 1, "c", Link("z")), ((3, 0), 0, "d", Link("y")), ((1, 0), 0, "e", Link("x"))]]
    assert choose(determining, determined, [{"x": "x", "y": "y"}]) == ("b", "d")
    assert Link.seen < 10


def test_edges(spark):
    df = frame(spark, [(1, "a", "x" * 100_000, "c", "", "k", None, 1, 1)] * 2)
    found = best_representatives(df, F.col("g"), "id", bundles(), LINKS)
    assert found.survivors.count() == 1 and found.members.count() == 2 and duplicate_pairs(found).count() == 0
    found = best_representatives(df.limit(0), F.col("g"), "id", bundles(), LINKS)
    assert found.survivors.count() == 0 and duplicate_pairs(found).count() == 0
    for wrong in ([LINKS[0], LINKS[0]], [LINKS[0], Dependency("call", ("kind",), "post", ("mail",))], [Dependency("none", ("x",), "call", ("kind",))]):
        with pytest.raises(ValueError):
            best_representatives(df, F.col("g"), "id", bundles(), wrong)


def test_names(spark):
    df = spark.createDataFrame([("e1", "Ann"), ("e1", "ann "), ("e2", "ANN"), (None, "aNN"), (None, "bob"), (None, None), ("e3", None)], "e string, n string")
    assert rows(resolve_by_name(df, F.col("e"), F.col("n")).select("n", "resolved")) == [("ANN", "e2"), ("Ann", "e1"), ("aNN", "e1"), ("ann ", "e1"), ("bob", None), (None, "e3"), (None, None)]
