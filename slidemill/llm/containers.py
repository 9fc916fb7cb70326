"""Filling fixed-capacity containers with whole items: minimum bin slack."""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.session import cut_lineage

#: Folder of the public tokenizers' files; a parameter everywhere.
TOKENIZERS = os.environ.get("SLIDEMILL_TOKENIZERS", "/opt/tokenizers")
#: Items that one task packs together.
SHARD = 50_000
# Fixed value: the word pattern that belongs to the byte-level vocabularies.
WORDS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def tokenizer(path: str) -> Callable[[str], int]:
    """A function that counts the tokens of a text; the library goes by the file's ending."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        encoding = tiktoken.Encoding("own", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        return lambda text: len(encoding.encode_ordinary(text))
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda text: len(pieces.encode(text))
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return lambda text: len(t.encode(text, add_special_tokens=False).ids)


def token_counts(df: DataFrame, key: str, text: str, path: str) -> DataFrame:
    """``(key, tokens)`` of every row; null and empty texts have 0 tokens."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = tokenizer(path)
        for b in batches:
            sizes = [size(t) if t else 0 for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64())], names=[key, "tokens"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, text).mapInArrow(count, f"`{key}` {kind}, tokens bigint")


def fullest(available: dict[int, int], capacity: int, first: int) -> dict[int, int]:
    """How many items of each length make the fullest container that holds one of length ``first``.

    A bitset, a whole number whose bit s says that the sum s can be made, is extended length by
    length (multiples by powers of two); the highest bit is then traced back.
    """
    room = capacity - first
    reach, steps = 1, []
    mask = (1 << (room + 1)) - 1
    for length in sorted((n for n in available if 0 < n <= room), reverse=True):
        left = min(available[length] - (length == first), room // length)
        power = 1
        while left > 0:
            take = min(power, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left -= take
            power *= 2
        if reach >> room & 1:
            break
    rest = reach.bit_length() - 1
    out = {first: 1}
    for length, take, before in reversed(steps):
        if not before >> rest & 1:
            out[length] = out.get(length, 0) + take
            rest -= length * take
    return out


def pack(sizes: dict[int, int], capacity: int) -> Iterator[tuple[dict[int, int], int]]:
    """(content by length, how many containers) until every item of ``sizes`` (number by length) is placed.

    Each time the longest item left is put in and the fullest combination is made around it; the
    same content is repeated as often as items allow.
    """
    left = {n: c for n, c in sizes.items() if c and n > 0}
    while left:
        content = fullest(left, capacity, max(left))
        times = min(left[n] // c for n, c in content.items())
        for n, c in content.items():
            left[n] -= c * times
            if not left[n]:
                del left[n]
        yield content, times


def fill_containers(items: DataFrame, key: str, size: str, capacity: int, shard: int = SHARD, n_items: int | None = None) -> DataFrame:
    """``(key, piece, size, container)``: every item in containers of ``capacity``.

    An item that fits is one piece (0) and whole. A longer one is cut into pieces of exactly
    ``capacity``, each of which is a container at once, and a rest. Items that fit and rests, one
    an item at most, are spread by hash over shards of about ``shard``; each shard is packed by
    minimum bin slack on the number of pieces per length, so the space left over is at most
    that of a few last containers per shard. Equal items, as those of a repeated row, are counted and
    spread in parts; the counts are stored, so what makes the sizes runs once. A container's name tells its shard or its full piece; names are unique
    and equal in every rerun over the same rows. ``n_items`` saves counting items that are
    costly to make, such as token counts.

    Items of size 0 or null go into their shard's first container; a null key is an item like
    any other; repeated rows are further items; an empty table gives an empty result; no other
    column is carried.
    """
    if capacity < 1:
        raise ValueError("capacity must be positive")
    shards = max(1, -(-(items.count() if n_items is None else n_items) // shard))
    kind = items.schema[key].dataType.simpleString()
    whole = items.select(F.col(key).alias("key"), F.greatest(F.coalesce(F.col(size).cast("long"), F.lit(0)), F.lit(0)).alias("size"))
    counted = cut_lineage(whole.groupBy("key", "size").agg(F.count("*").alias("copies")).withColumn("full", F.floor(F.col("size") / F.lit(capacity)).cast("long")))
    name = F.coalesce(F.col("key").cast("string"), F.lit(""))
    full = (
        counted.where("full > 0")
        .select("key", "size", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"), "full")
        .select("key", "size", "copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full") - 1)).alias("piece"))
        .select("key", "piece", F.lit(capacity).cast("long").alias("size"), F.concat_ws("/", F.lit("full"), name, "size", "copy", "piece").alias("container"))
    )
    left = F.col("size") - F.col("full") * capacity
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / F.lit(shard)).cast("long"))
    rests = (
        counted.where((left > 0) | (F.col("size") == 0))
        .select("key", "full", left.alias("left"), "copies", F.explode(parts).alias("part"))
        .select("key", F.col("full").alias("piece"), F.col("left").alias("size"), F.least(F.lit(shard), F.col("copies") - F.col("part") * shard).alias("copies"), F.pmod(F.xxhash64("key", "full", "left", "part"), F.lit(shards)).alias("shard"))
    )

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.loc[pdf.index.repeat(pdf["copies"])]
        pdf = pdf.sort_values(["size", "key", "piece"], kind="stable", na_position="first").reset_index(drop=True)
        rows: dict[int, list[int]] = {}
        for i, n in enumerate(pdf["size"].tolist()):
            rows.setdefault(n, []).append(i)
        container, k = [0] * len(pdf), 0
        for content, times in pack({n: len(x) for n, x in rows.items()}, capacity):
            for _ in range(times):
                for n, c in content.items():
                    for _ in range(c):
                        container[rows[n].pop()] = k
                k += 1
        shard_name = f"shard/{int(pdf['shard'].iloc[0])}/"
        return pdf[["key", "piece", "size"]].assign(container=[f"{shard_name}{c}" for c in container])

    packed = rests.groupBy("shard").applyInPandas(place, f"key {kind}, piece bigint, size bigint, container string")
    return packed.unionByName(full).withColumnRenamed("key", key)
