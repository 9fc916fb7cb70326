"""Evaluation texts in training text: word suffix arrays of corpus shards, searched by every test suffix."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A word is a longest run of letters or digits, in lower case.
WORD = re.compile(r"[^\W_]+")
#: Consecutive words that make a leak.
LEAST_WORDS = 8
#: Words of one shard; a longer document is a shard of its own.
SHARD_WORDS = 1_000_000
#: Most characters of all evaluation texts together; they go to every task.
EVAL_LIMIT = 64_000_000
FOUND = "doc_id bigint, item_id bigint, n_words bigint, doc_word bigint, item_word bigint"


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


def suffix_array(tokens: np.ndarray) -> np.ndarray:
    """Starts of all suffixes in order, by prefix doubling; a suffix that ends comes before its extensions."""
    n = len(tokens)
    if n == 0:
        return np.zeros(0, np.int64)
    _, rank = np.unique(tokens, return_inverse=True)
    rank = rank.astype(np.int64) + 1
    width = 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] if width < n else 0
        key = rank * (n + 2) + after
        order = np.argsort(key, kind="stable")
        moved = np.ones(n, np.int64)
        ordered = key[order]
        moved[1:] = ordered[1:] != ordered[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(moved)
        if rank[order[-1]] == n or width >= n:
            return order
        width *= 2


def _narrow(tokens: np.ndarray, suffixes: np.ndarray, low: np.ndarray, high: np.ndarray, depth: int, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Binary search of all queries at once: the part of [low, high) whose word at ``depth`` is ``want``."""
    n = len(tokens)

    def bound(right: bool) -> np.ndarray:
        a, b = low.copy(), high.copy()
        while True:
            open_ = a < b
            if not open_.any():
                return a
            mid = (a + b) // 2
            at = suffixes[np.minimum(mid, len(suffixes) - 1)] + depth
            word = np.where(at < n, tokens[np.minimum(at, n - 1)], -1)
            less = (word <= want) if right else (word < want)
            a, b = np.where(open_ & less, mid + 1, a), np.where(open_ & ~less, mid, b)

    first = bound(False)
    return first, bound(True)


class TestSuffixes:
    """All evaluation words in one row, with an end after every item, and where each item's words are."""

    __test__ = False

    def __init__(self, items: list[tuple[int, str]], least: int):
        split = [(i, words(t)) for i, t in items]
        split = [(i, w) for i, w in split if len(w) >= least]
        self.vocabulary: dict[str, int] = {}
        flat: list[int] = []
        owner: list[int] = []
        left: list[int] = []
        for i, w in split:
            flat += [self.vocabulary.setdefault(x, len(self.vocabulary)) for x in w]
            owner += [i] * len(w)
            left += range(len(w), 0, -1)
        self.unknown = len(self.vocabulary)
        self.words = np.array(flat, np.int64)
        self.owner = np.array(owner, np.int64)
        self.left = np.array(left, np.int64)
        self.start = np.array([k for _, w in split for k in range(len(w))], np.int64)
        self.least = least

    def numbers(self, found: list[str]) -> np.ndarray:
        get, unknown = self.vocabulary.get, self.unknown
        return np.array([get(x, unknown) for x in found], np.int64)


def search_shard(docs: list[tuple[int, np.ndarray]], test: TestSuffixes) -> dict[tuple[int, int], tuple[int, int, int]]:
    """(document, item) to the longest verbatim match (words, place in the document, place in the item) of at least ``least`` words.

    A document is the array of its words' numbers, ``test.unknown`` for words of no item.
    """
    least, out, unknown = test.least, {}, test.unknown
    end = np.array([unknown], np.int64)
    t = np.concatenate([x for _, w in docs for x in (w, end)])
    starts = np.concatenate(([0], np.cumsum([len(w) + 1 for _, w in docs])[:-1]))
    ids = np.array([d for d, _ in docs], np.int64)
    # an unknown word or the document's end ends every match; each gets a number of its own
    stops = np.flatnonzero(t >= unknown)
    t[stops] = unknown + np.arange(len(stops))
    run = stops[np.searchsorted(stops, np.arange(len(t)))] - np.arange(len(t))
    near = np.flatnonzero(run >= least)
    if not len(near) or not len(test.words):
        return out
    suffixes = _sorted_suffixes(t, near)
    queries = np.flatnonzero(test.left >= least)
    low, high = np.zeros(len(queries), np.int64), np.full(len(queries), len(suffixes), np.int64)
    depth = 0
    while len(queries):
        go = test.left[queries] > depth
        queries, low, high = queries[go], low[go], high[go]
        if not len(queries):
            break
        low, high = _narrow(t, suffixes, low, high, depth, test.words[queries + depth])
        hit = low < high
        queries, low, high = queries[hit], low[hit], high[hit]
        depth += 1
        if depth >= least and len(queries):
            sizes = high - low
            rows = np.repeat(queries, sizes)
            places = suffixes[np.repeat(low, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)]
            which = np.searchsorted(starts, places, side="right") - 1
            pair = np.lexsort((places, test.start[rows], test.owner[rows], which))
            head = np.ones(len(pair), bool)
            head[1:] = (which[pair][1:] != which[pair][:-1]) | (test.owner[rows][pair][1:] != test.owner[rows][pair][:-1])
            for k in pair[head]:
                w = which[k]
                out[int(ids[w]), int(test.owner[rows[k]])] = (depth, int(places[k] - starts[w]), int(test.start[rows[k]]))
    return out


def _sorted_suffixes(t: np.ndarray, near: np.ndarray) -> np.ndarray:
    order = suffix_array(t)
    keep = np.zeros(len(t), bool)
    keep[near] = True
    return order[keep[order]]


def leaked_passages(corpus: DataFrame, items: DataFrame, least: int = LEAST_WORDS, shard_words: int = SHARD_WORDS, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(doc_id, item_id, n_words, doc_word, item_word)``: the longest passage that each document shares with each item.

    A passage is ``least`` or more consecutive words of the item, whatever stands between the
    words; places count words from 0. Whole documents are gathered into shards of about
    ``shard_words`` words within the tasks that read them; of each shard a word suffix array is
    built, and every suffix of every item is binary-searched in it. There is no shuffle but for
    joining the results of repeated document ids. The items, a held-out set that does not grow
    with the corpus, go to every task; more than EVAL_LIMIT characters of them are refused.

    Null, empty and shorter texts share nothing; rows without id are left out; a repeated row or
    an id in several rows gives one row with its longest passage; between equally long passages
    the first in the document wins within a shard; extra columns are ignored.
    """
    held = items.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where(F.col("i").isNotNull() & F.col("t").isNotNull())
    total = held.agg(F.coalesce(F.sum(F.length("t")), F.lit(0))).first()[0]
    if total > EVAL_LIMIT:
        raise ValueError(f"{total} characters of evaluation texts, more than {EVAL_LIMIT}; search them in parts")
    spark = corpus.sparkSession
    shared = spark.sparkContext.broadcast(sorted({(r.i, r.t) for r in held.collect()}))

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = TestSuffixes(shared.value, least)
        docs: list[tuple[int, np.ndarray]] = []
        n = 0
        for b in batches:
            for d, body in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = words(body)
                if len(w) < least:
                    continue
                if docs and n + len(w) > shard_words:
                    yield from _result(search_shard(docs, test))
                    docs, n = [], 0
                docs.append((d, test.numbers(w)))
                n += len(w)
        if docs:
            yield from _result(search_shard(docs, test))

    rows = corpus.select(F.col(doc_id).cast("long").alias("d"), F.col(text).alias("t")).where(F.col("d").isNotNull() & F.col("t").isNotNull())
    found = rows.mapInArrow(search, FOUND)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("n_words", (-F.col("doc_word")).alias("d"), (-F.col("item_word")).alias("i"))).alias("b"))
    return best.select("doc_id", "item_id", "b.n_words", (-F.col("b.d")).alias("doc_word"), (-F.col("b.i")).alias("item_word"))


def _result(found: dict) -> Iterator[pa.RecordBatch]:
    if found:
        columns = list(zip(*((d, i, *m) for (d, i), m in found.items())))
        names = ["doc_id", "item_id", "n_words", "doc_word", "item_word"]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)


def without_leaks(corpus: DataFrame, found: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents in which no passage was found."""
    return corpus.join(found.select(F.col("doc_id").alias(doc_id)).distinct(), doc_id, "left_anti")
