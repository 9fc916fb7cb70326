"""Several values packed in one field: dictionary-guided segmentation.

A field is cut at delimiters that stand outside double quotes. A multi-pattern
automaton over known whole values finds where one spans delimiters, and dynamic
programming over the slots picks the likeliest cover, so that a delimiter inside a
legitimate value does not cut it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slidemill.operators.relational import join_skewed
from slidemill.session import cut_lineage

# What separates values, and the brackets around a whole field.
DELIMITERS = ";,|\n\t；"
BRACKETS = {"[": "]", "{": "}"}

_DELIMITER = rf"[{re.escape(DELIMITERS)}]|\s/(?=\s)"
_INNER = r'(?:[^"\\]|""|\\.)*'
DELIMITER = re.compile(_DELIMITER)
QUOTED = re.compile(rf'"({_INNER})"(?=\s*(?:$|[' + re.escape(DELIMITERS) + r"]|/\s))", re.S)
#: Longest field whose cut is remembered.
CACHED_CHARS = 500
#: Values with a delimiter inside that are sent to every task as one dictionary; more are joined to the fields that may hold them.
DICTIONARY_LIMIT = 20_000
#: Fields of one text, of several values without quotes, from which on the text is hot.
HOT_ROWS = 100_000


@dataclass(frozen=True)
class Dictionary:
    """How often whole values occur: those with a delimiter inside (``spans``), and the plain values between their delimiters."""

    spans: dict[str, int] = field(default_factory=dict)
    plain: dict[str, int] = field(default_factory=dict)
    total: int = 1

    def cost(self, value: str) -> float:
        """The information of a whole value: the less, the more often it occurs; a value not seen counts as one in e."""
        n = self.spans.get(value) or self.plain.get(value) or 0
        return math.log(max(self.total, 2) / n) if n else math.log(max(self.total, 2)) + 1


def unquote(inner: str) -> str:
    return re.sub(r'""|\\"', '"', inner).strip()


def slots(text: str) -> tuple[list[tuple[int, int, str | None]], list[str]]:
    """(start, end, content if quoted) of every slot between delimiters outside quotes, and the delimiters between them."""
    if '"' not in text:
        found = list(DELIMITER.finditer(text))
        cuts = [(0, 0), *(m.span() for m in found), (len(text), len(text))]
        return [(a, b, None) for (_, a), (b, _) in zip(cuts, cuts[1:])], [m[0].strip(" ") for m in found]
    out, seps, start, at, quoted = [], [], 0, 0, None
    while at <= len(text):
        if at == len(text):
            out.append((start, at, quoted))
            break
        if quoted is None and text[at] == '"' and not text[start:at].strip() and (m := QUOTED.match(text, at)):
            quoted, at = unquote(m[1]), m.end()
        elif m := DELIMITER.match(text, at):
            out.append((start, at, quoted))
            seps.append(m[0].strip(" "))
            start = at = m.end()
            quoted = None
        else:
            at += 1
    return out, seps


def inside(text: str) -> str:
    """A field without outer white space and the brackets around it."""
    text = text.strip()
    return text[1:-1] if len(text) > 1 and BRACKETS.get(text[0]) == text[-1] else text


class Segmenter:
    """Cuts fields with the help of known whole values."""

    def __init__(self, known: Dictionary):
        self.known = known
        self.automaton = None
        if known.spans:
            import ahocorasick

            self.automaton = ahocorasick.Automaton()
            for value in known.spans:
                self.automaton.add_word(value, len(value))
            self.automaton.make_automaton()
        self._cached = lru_cache(maxsize=50_000)(self._cut)

    def cut(self, text: str) -> tuple[str, ...]:
        """The values of a field; those of short fields, which recur, are remembered."""
        return self._cached(text) if len(text) <= CACHED_CHARS else self._cut(text)

    def _cut(self, text: str) -> tuple[str, ...]:
        text = inside(text)
        pieces, seps = slots(text)
        plain = [text[a:b].strip() if q is None else q for a, b, q in pieces]
        if self.automaton is not None and seps and (spans := self._spans(text, pieces, seps)):
            plain = self._cover(pieces, plain, spans)
        return tuple(v for v in plain if v)

    def _spans(self, text: str, pieces: list, seps: list[str]) -> dict[int, list[tuple[int, str]]]:
        """By last slot, the known values that lie on several slots without quotes.

        A delimiter that separates a value from the next cannot also stand inside it without quotes,
        and without any neighbour nothing tells separators from a value's own delimiters.
        """
        first = {a + len(text[a:b]) - len(text[a:b].lstrip()): i for i, (a, b, q) in enumerate(pieces) if q is None}
        last = {a + len(text[a:b].rstrip()): i for i, (a, b, q) in enumerate(pieces) if q is None}
        out: dict[int, list[tuple[int, str]]] = {}
        for end, size in self.automaton.iter(text):
            i, j = first.get(end + 1 - size), last.get(end + 1)
            if i is None or j is None or j <= i or any(q is not None for *_, q in pieces[i : j + 1]):
                continue
            own, around = set(seps[i:j]), [*seps[i - 1 : i], *seps[j : j + 1]]
            if around and not own.intersection(around):
                out.setdefault(j, []).append((i, text[end + 1 - size : end + 1]))
        return out

    def _cover(self, pieces: list, plain: list[str], spans: dict) -> list[str]:
        """The values of the likeliest cover: the least sum of what its values cost; between equal sums the more values."""
        best: list[tuple[float, int, int, str]] = [(0.0, 0, 0, "")]
        for j, value in enumerate(plain):
            cost = self.known.cost(value) if value and pieces[j][2] is None else 0.0
            options = [(best[j][0] + cost, best[j][1] - 1, j, value)]
            options += [(best[i][0] + self.known.cost(v), best[i][1] - 1, i, v) for i, v in spans.get(j, ())]
            best.append(min(options))
        out, j = [], len(plain)
        while j:
            _, _, i, value = best[j]
            out.append(value)
            j = i
        return out[::-1]


@lru_cache(maxsize=1000)
def _segmenter(known: tuple) -> Segmenter:
    """A segmenter of the few counts that one text needs."""
    spans, plain, total = known
    return Segmenter(Dictionary(dict(spans), dict(plain), total))


def span_counts(df: DataFrame, column: str) -> DataFrame:
    """``(v, n)``: the quoted values of a packed column that hold a delimiter, with how often each occurs in all rows."""
    inner = F.explode(F.regexp_extract_all(F.col(column), F.lit(f'"({_INNER})"'), F.lit(1)))
    value = F.trim(F.regexp_replace("v", r'""|\\"', '"'))
    quoted = df.where(F.col(column).contains('"')).select(inner.alias("v")).select(value.alias("v"))
    return quoted.where(F.col("v").rlike(_DELIMITER) & ~F.col("v").contains('"')).groupBy("v").agg(F.count(F.lit(1)).alias("n"))


def plain_slots(df: DataFrame, column: str) -> DataFrame:
    """``v``, a row per value without quotes between delimiters. Patterns run only over fields that hold what they look for."""
    bare = F.when(F.col(column).contains('"'), F.regexp_replace(F.col(column), f'"{_INNER}"', "")).otherwise(F.col(column))
    bracketed = bare.contains("[") | bare.contains("{")
    bare = F.when(bracketed, F.regexp_replace(bare, r"(?s)^\s*[\[{](.*)[\]}]\s*$", "$1")).otherwise(bare)
    bare = F.when(bare.contains("/"), F.regexp_replace(bare, r"\s/(?=\s)", ";")).otherwise(bare)
    values = F.explode(F.split(F.translate(bare, DELIMITERS, ";" * len(DELIMITERS)), ";"))
    return df.select(values.alias("v")).select(F.trim("v").alias("v")).where("v <> ''")


def _parts(spans: DataFrame) -> DataFrame:
    return spans.select(F.explode(F.split("v", _DELIMITER)).alias("v")).select(F.trim("v").alias("v")).where("v <> ''").distinct()


def learned(df: DataFrame, column: str, limit: int = DICTIONARY_LIMIT) -> Dictionary | None:
    """The dictionary of a column, counted over all rows; None if it holds more than ``limit`` values with a delimiter.

    Of the plain values only those between the delimiters of such a value matter.
    """
    spans = span_counts(df, column)
    found = spans.orderBy("v").limit(limit + 1).collect()
    if len(found) > limit:
        return None
    if not found:
        return Dictionary()
    parts = _parts(df.sparkSession.createDataFrame(found, "v string, n long")).withColumn("part", F.col("v"))
    told = plain_slots(df, column).join(F.broadcast(parts), "v", "left").groupBy(F.col("part").alias("v")).agg(F.count(F.lit(1)).alias("n")).collect()
    counts = {r.v: r.n for r in told if r.v is not None}
    return Dictionary({r.v: r.n for r in found}, counts, sum(r.n for r in told) + sum(r.n for r in found))


def windows(text: str | None, sizes: Sequence[int]) -> Iterator[str]:
    """What stands on some numbers of neighbouring slots without quotes."""
    text = inside(text or "")
    pieces, _ = slots(text)
    for n in sizes:
        for i in range(len(pieces) - n + 1):
            if all(q is None for *_, q in pieces[i : i + n]):
                yield text[pieces[i][0] : pieces[i + n - 1][1]].strip()


def known_by_text(df: DataFrame, column: str) -> DataFrame:
    """``(text, known, n)``: for every text on whose slots a value with a delimiter lies, the counts it needs, and its rows.

    ``known`` has ``v, n, span`` for these values and those between their delimiters, and a
    row of null ``v`` with the total. Bounded by the text's own slots.
    """
    spans = span_counts(df, column)
    sizes = sorted(r.s for r in spans.select(F.size(F.split("v", _DELIMITER)).alias("s")).distinct().collect())
    total = plain_slots(df, column).agg(F.count(F.lit(1))).scalar() + spans.agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()

    def list_windows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            pairs = [(t, w) for t in b.column(0).to_pylist() for w in set(windows(t, sizes))]
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in pairs], pa.string()), pa.array([w for _, w in pairs], pa.string())], names=["text", "v"])

    texts = df.select(F.col(column).cast("string").alias("text")).where(F.col("text").rlike(_DELIMITER)).groupBy("text").agg(F.count(F.lit(1)).alias("rows"))
    held = texts.select("text").mapInArrow(list_windows, "text string, v string").join(spans, "v").select("text", "v", "n", F.lit(True).alias("span"))
    needed = held.select("text", F.explode(F.split("v", _DELIMITER)).alias("v")).select("text", F.trim("v").alias("v")).where("v <> ''").distinct()
    counts = plain_slots(df, column).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    plain = needed.join(counts, "v").select("text", "v", "n", F.lit(False).alias("span"))
    whole = held.select("text").distinct().select("text", F.lit(None).cast("string").alias("v"), total.cast("long").alias("n"), F.lit(False).alias("span"))
    known = held.unionByName(plain).unionByName(whole).groupBy("text").agg(F.collect_list(F.struct("v", "n", "span")).alias("known"))
    return known.join(texts, "text")


def split_packed(df: DataFrame, column: str, keys: list[str], known: Dictionary | None = None, least: int = 1, limit: int = DICTIONARY_LIMIT) -> DataFrame:
    """One row ``(*keys, pos, val)`` per value of a packed column.

    ``pos`` counts from 1 and skips empty slots. ``least`` keeps only fields with that many
    values. Quotes settle what they enclose. Elsewhere a known value that holds a delimiter may
    lie on several slots, if another delimiter separates it from its neighbours; of the covers
    with and without such values the likeliest is taken, by how often whole values occur:
    common plain values are kept apart, a value known whole is kept whole. ``known`` is the
    dictionary; ``None`` learns it from all rows of the column. More than ``limit`` values with a
    delimiter are not sent to the tasks but joined to the texts on whose slots they lie, to the
    same result.

    Null, empty and blank fields and empty tables give no rows; a repeated row gives
    its values again; an unclosed quote is ordinary text; columns outside ``keys`` are
    not carried, so no name can clash (``pos`` and ``val`` must not be among ``keys``).
    Fields of any length are cut whole, in one pass.
    """
    if {"pos", "val"} & set(keys):
        raise ValueError("pos and val are names of the result")
    if known is None:
        known = learned(df, column, limit)
    own = df.select(*(F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)), F.col(f"`{column}`").cast("string").alias("text")).where(F.col("text").isNotNull())
    if known is not None:
        return _exploded(own, df, keys, known, least)
    held = cut_lineage(known_by_text(df, column))
    hot = F.col("rows") > HOT_ROWS
    with_known = join_skewed(own, held, "text", hot).select(*(c for c in own.columns), "known")
    rest = own.join(held.select("text"), "text", "left_anti").select(*own.columns).withColumn("known", F.lit(None).cast(held.schema["known"].dataType))
    return _exploded(with_known.unionByName(rest), df, keys, Dictionary(), least)


def _exploded(rows: DataFrame, df: DataFrame, keys: list[str], shared: Dictionary, least: int) -> DataFrame:
    names = [f"k{i}" for i in range(len(keys))]
    shape = "".join(f"{n} {df.schema[k].dataType.simpleString()}, " for n, k in zip(names, keys)) + "pos bigint, val string"

    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = Segmenter(shared)
        for b in batches:
            at, pos, val = [], [], []
            cuts = map(base.cut, b.column(len(names)).to_pylist())
            if b.num_columns > len(names) + 1:
                lists = b.column(len(names) + 1).to_pylist()
                cuts = ((base if k is None else _segmenter(_from_list(k))).cut(t) for t, k in zip(b.column(len(names)).to_pylist(), lists))
            for i, values in enumerate(cuts):
                if len(values) >= least:
                    at += [i] * len(values)
                    pos += range(1, len(values) + 1)
                    val += values
            places = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([*(c.take(places) for c in b.columns[: len(names)]), pa.array(pos, pa.int64()), pa.array(val, pa.string())], names=[*names, "pos", "val"])

    out = rows.mapInArrow(explode, shape)
    return out.select(*(F.col(n).alias(k) for n, k in zip(names, keys)), "pos", "val")


def _from_list(known: list[dict]) -> tuple:
    spans = tuple(sorted((r["v"], r["n"]) for r in known if r["span"]))
    plain = tuple(sorted((r["v"], r["n"]) for r in known if not r["span"] and r["v"] is not None))
    return spans, plain, next(r["n"] for r in known if r["v"] is None)
