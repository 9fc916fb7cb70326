"""Deeply nested records to related flat tables.

``merged_schema`` finds every path of a collection of JSON and XML payloads and what it
holds anywhere; ``shred`` explodes each array level into a child table whose rows carry
the surrogate key of their parent and their ordinal in it. Payloads are read and walked
without recursion, so nesting of any depth is read.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import lru_cache
from json.decoder import scanstring
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Most distinct array paths of a merged schema; more means that keys are data, and is refused.
PATH_LIMIT = 10_000
SHRED_SCHEMA = "entry bigint, path string, row_key string, parent_key string, ordinal bigint, fields map<string,string>, above map<string,string>"
#: Rows of one output batch.
BATCH_ROWS = 20_000


@lru_cache(maxsize=10_000)
def snake(name: str) -> str:
    return re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name.rpartition("}")[2]).lower()


@lru_cache(maxsize=10_000)
def snake_names(keys: tuple[str, ...]) -> tuple[str, ...]:
    """The names of an object's keys in snake_case; a key whose name is taken, by itself or by an earlier key, stays as written."""
    taken = {k for k in keys if snake(k) == k}
    out: list[str] = []
    for k in keys:
        name = snake(k)
        out.append(k if name in taken else name)
        taken.add(name)
    return tuple(out)


class _Many(list):
    """Repeated elements, told apart from a list that is one value."""


def _xml(text: str) -> dict:
    """Nested dictionaries of an XML document: attributes and children by name, ``text`` beside them; an element of text alone is that text."""
    parser = ET.XMLParser(encoding="utf-8")
    parser.feed(text.strip().encode())
    root = parser.close()
    out = dict(root.attrib)
    todo = [(root, out)]
    while todo:
        element, node = todo.pop()
        text = element.text or ""
        for child in element:
            value: Any
            if len(child) or child.attrib:
                value = dict(child.attrib)
                todo.append((child, value))
            else:
                value = child.text or ""
            if child.tail:
                text += child.tail
            tag = child.tag
            if tag not in node:
                node[tag] = value
            elif isinstance(node[tag], _Many):
                node[tag].append(value)
            else:
                node[tag] = _Many([node[tag], value])
        if text.strip():
            node["text"] = text
    return out or {"text": root.text or ""}


def _deep_json(text: str) -> Any:
    """JSON nested more deeply than the standard parser goes, with an explicit stack; numbers stay texts."""
    space, number = re.compile(r"[ \t\r\n]*"), re.compile(r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][-+]?\d+)?")
    plain = {"t": ("true", True), "f": ("false", False), "n": ("null", None)}
    root: list = []
    stack: list[tuple[Any, bool]] = [(root, False)]  # containers, and whether they are objects
    at, key = space.match(text).end(), None

    def close(at: int) -> int:
        """After a value: closes what ends here and goes on behind the comma; -1 at the text's end."""
        while True:
            at = space.match(text, at).end()
            if len(stack) == 1:
                if at != len(text):
                    raise ValueError("more behind the value")
                return -1
            if text[at : at + 1] == ",":
                return space.match(text, at + 1).end()
            if text[at : at + 1] != ("}" if stack[-1][1] else "]"):
                raise ValueError("no end of an object or array")
            stack.pop()
            at += 1

    while at >= 0:
        holder, is_object = stack[-1]
        if is_object:
            if text[at : at + 1] != '"':
                raise ValueError("no name")
            key, at = scanstring(text, at + 1)
            at = space.match(text, at).end()
            if text[at : at + 1] != ":":
                raise ValueError("no colon")
            at = space.match(text, at + 1).end()
        c = text[at : at + 1]
        if c in ("{", "["):
            value: Any = {} if c == "{" else []
            inner = space.match(text, at + 1).end()
        elif c == '"':
            value, at = scanstring(text, at + 1)
        elif c in plain and text.startswith(plain[c][0], at):
            at, value = at + len(plain[c][0]), plain[c][1]
        elif m := number.match(text, at):
            value, at = m[0], m.end()
        else:
            raise ValueError("no value")
        if is_object:
            holder[key] = value
        else:
            holder.append(value)
        if c in ("{", "["):
            stack.append((value, c == "{"))
            if text[inner : inner + 1] == ("}" if c == "{" else "]"):
                stack.pop()
                at = close(inner + 1)
            else:
                at = inner
        else:
            at = close(at)
    return root[0]


def _json(text: str) -> Any:
    try:
        return json.loads(text, parse_int=str, parse_float=str, parse_constant=str)
    except RecursionError:
        return _deep_json(text)


#: Stands for a payload that cannot be read; a singleton also where it is sent to a worker.
_UNREADABLE = ...


def read_payload(fmt: str | None, payload: str | None) -> Any:
    """The payload as nested dictionaries and lists; ``_UNREADABLE`` if it cannot be read as a whole."""
    try:
        if (fmt or "").strip().lower() == "json":
            return _json(payload)
        return _xml(payload)
    except (ValueError, TypeError, AttributeError, ET.ParseError):
        return _UNREADABLE


def opened(value: Any) -> Any:
    """A text that holds JSON objects is those objects; a list of plain values stays a text."""
    if type(value) is str and value[:1] in _MAY_OPEN and value.lstrip()[:1] in ("[", "{"):
        try:
            inner = _json(value)
        except ValueError:
            return value
        if isinstance(inner, dict) or any(isinstance(v, dict) for v in inner):
            return inner
    return value


_MAY_OPEN = frozenset("[{ \t\r\n\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0")
_DIGIT = re.compile(r"\d").search


def keyed(value: Any) -> bool:
    """A dictionary from ids to objects: every value is an object or null and every name holds a digit."""
    if not isinstance(value, dict) or not value:
        return False
    for k, v in value.items():
        if (v is not None and not isinstance(v, dict)) or not _DIGIT(k):
            return False
    return True


@lru_cache(maxsize=100_000)
def _child_paths(path: str, keys: tuple[str, ...]) -> tuple[str, ...]:
    head = f"{path}." if path else ""
    return tuple(head + n for n in snake_names(keys))


def note_paths(tree: Any, found: dict[tuple[str, str], int]) -> None:
    """Counts every path of a payload with the kind of what stands there; items of an array share its path."""
    stack = [(tree, "")]
    while stack:
        value, path = stack.pop()
        if isinstance(value, str):
            value = opened(value)
        if isinstance(value, list):
            kind = "array"
            stack += [(v, path) for v in value]
        elif isinstance(value, dict):
            if path and keyed(value):
                kind = "array"
                stack += [({} if v is None else v, path) for v in value.values()]
            else:
                kind = "object"
                for v, below in zip(value.values(), _child_paths(path, tuple(value))):
                    if type(v) is str and v[:1] not in _MAY_OPEN:
                        found[below, "scalar"] = found.get((below, "scalar"), 0) + 1
                    else:
                        stack.append((v, below))
        else:
            kind = "null" if value is None else "scalar"
        at = (path, kind)
        found[at] = found.get(at, 0) + 1


def merged_schema(df: DataFrame, fmt: str = "fmt", payload: str = "payload") -> DataFrame:
    """One row ``(path, kind, n)`` for everything that stands at a path in any record.

    ``kind`` is array, object, scalar or null; the payload itself stands at the path ``""``.
    Payloads that cannot be read as a whole count there with kind unreadable; a null payload
    is unreadable.
    """

    def seen(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, str], int] = {}
        for b in batches:
            for f, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if (tree := read_payload(f, text)) is _UNREADABLE:
                    found["", "unreadable"] = found.get(("", "unreadable"), 0) + 1
                else:
                    note_paths(tree, found)
        if found:
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in found], "kind": [k for _, k in found], "n": pa.array(list(found.values()), pa.int64())})

    return df.select(fmt, payload).mapInArrow(seen, "path string, kind string, n bigint").groupBy("path", "kind").agg(F.sum("n").alias("n"))


def array_levels(schema: DataFrame) -> frozenset[str]:
    """The paths that are an array anywhere; their number is bounded by PATH_LIMIT."""
    rows = schema.where("kind = 'array' AND path <> ''").select("path").distinct().limit(PATH_LIMIT + 1).collect()
    if len(rows) > PATH_LIMIT:
        raise ValueError(f"more than {PATH_LIMIT} array paths: field names seem to be data")
    return frozenset(r.path for r in rows)


def _items(value: Any) -> Iterable[tuple[str | None, Any]]:
    value = opened(value)
    if value is None:
        return ()
    if isinstance(value, list):
        return [(None, opened(v)) for v in value]
    if keyed(value):
        return value.items()
    return ((None, value),)


class _Rows:
    """Rows of SHRED_SCHEMA as columns; a map column is its entries in a row and where each row's begin."""

    def __init__(self) -> None:
        self.plain: list[tuple] = []
        self.maps: tuple[list, ...] = ([], [], [0], [], [], [0])

    def add(self, row: tuple, fields: dict[str, str], above: dict[str, str]) -> None:
        self.plain.append(row)
        keys, items, ends, above_keys, above_items, above_ends = self.maps
        keys.extend(fields)
        items.extend(fields.values())
        ends.append(len(keys))
        above_keys.extend(above)
        above_items.extend(above.values())
        above_ends.append(len(above_keys))

    def batch(self) -> pa.RecordBatch:
        types = (pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64())
        columns = [pa.array(c, t) for c, t in zip(zip(*self.plain), types)]
        for keys, items, ends in (self.maps[:3], self.maps[3:]):
            columns.append(pa.MapArray.from_arrays(pa.array(ends, pa.int32()), pa.array(keys, pa.string()), pa.array(items, pa.string())))
        return pa.RecordBatch.from_arrays(columns, names=["entry", "path", "row_key", "parent_key", "ordinal", "fields", "above"])


class Shredder:
    """Explodes payloads into rows; ``wanted`` limits them to some paths and their fields and skips what leads to none of them."""

    def __init__(self, levels: frozenset[str], carry: dict[str, str], wanted: Mapping[str, Sequence[str] | None] | None = None):
        self.levels, self.carry, self.wanted = levels, carry, wanted
        self._plans: dict[tuple, list] = {}

    def leads(self, path: str) -> bool:
        return self.wanted is None or any(w == path or w.startswith(f"{path}.") for w in self.wanted)

    def plan(self, path: str, prefix: str, keys: tuple[str, ...]) -> list[tuple]:
        """For each key of an object: its name in the row, its full path, whether that is an array level, and the name it is carried by."""
        if (found := self._plans.get((path, prefix, keys))) is None:
            found = []
            for name in snake_names(keys):
                short = prefix + name
                full = f"{path}.{short}" if path else short
                found.append((short, full, full in self.levels, self.carry.get(full)))
            if len(self._plans) < 100_000:
                self._plans[path, prefix, keys] = found
        return found

    def shred(self, tree: Any, entry: int, rows: _Rows, record: int | None = None) -> None:
        first = entry if record is None else record
        if isinstance(tree, list):
            todo = [(self._object(None, opened(v)), "", f"{first}:{k}", None, k, {}) for k, v in enumerate(tree)]
        else:
            todo = [(self._object(None, tree), "", str(first), None, 0, {})]
        while todo:
            node, path, key, parent, ordinal, above = todo.pop()
            fields: dict[str, str] = {}
            children: list[tuple[str, str, Any]] = []
            carried: dict[str, str] | None = None
            inner = [(node, "")]
            while inner:
                d, prefix = inner.pop()
                for v, (short, full, is_level, carry) in zip(d.values(), self.plan(path, prefix, tuple(d))):
                    if is_level:
                        children.append((full, short, v))
                        continue
                    if type(v) is str:
                        v = opened(v)
                    if type(v) is str:
                        fields[short] = v
                    elif isinstance(v, dict):
                        inner.append((v, f"{short}."))
                        continue
                    elif isinstance(v, list):
                        children.append((full, short, v))
                        continue
                    elif v is None:
                        continue
                    else:
                        fields[short] = str(v).lower()
                    if carry is not None:
                        carried = above | {carry: fields[short]} if carried is None else carried | {carry: fields[short]}
            if self.wanted is None or path in self.wanted:
                if self.wanted is not None and (kept := self.wanted[path]) is not None:
                    fields = {f: fields[f] for f in kept if f in fields}
                rows.add((entry, path, key, parent, ordinal), fields, above)
            below = above if carried is None else carried
            for full, name, v in children:
                if self.leads(full):
                    for k, (own, item) in enumerate(_items(v)):
                        todo.append((self._object(own, item), full, f"{key}/{name}:{k}", key, k, below))

    @staticmethod
    def _object(own: str | None, item: Any) -> dict:
        if not isinstance(item, dict):
            item = {} if item is None else {"text": item if isinstance(item, str) else json.dumps(item) if isinstance(item, list) else str(item).lower()}
        return item if own is None else {"id": own, **item}


def shred(
    df: DataFrame,
    entry: str = "entry_id",
    fmt: str = "fmt",
    payload: str = "payload",
    levels: frozenset[str] | None = None,
    carry: dict[str, str] | None = None,
    declared: Iterable[str] = (),
    wanted: Mapping[str, Sequence[str] | None] | None = None,
    record: str | None = None,
) -> DataFrame:
    """Every record as rows of flat tables, one table per array level (column ``path``; root is ``""``).

    ``levels`` are the array paths; None infers them from the whole input. ``declared``
    adds paths that are arrays even if every record here holds one item. ``row_key`` is
    unique in the result for unique entries, ``parent_key`` is the parent's ``row_key``,
    ``ordinal`` the position in the parent's array from 0. ``carry`` copies ancestors'
    fields into ``above`` so that children need no join; ``attach_parents`` gets them by the
    keys. ``wanted`` asks for the rows of some paths only, and of each for some fields or, with
    None, for all. ``record`` is a column of unique whole numbers that keys begin with instead
    of the entry, where entries may be repeated or missing.

    Names become snake_case; where two names of an object would become one, one of them keeps
    its spelling. An object whose names are ids is an array, and each id, as written, is the
    field ``id`` of its row. A payload that is an array has a root row per item; one that is a
    plain value a root row with the field ``text``. Unreadable and null payloads give
    no rows, an empty table gives an empty one, a payload delivered twice gives rows under
    each entry; nesting of any depth is read; extra columns are ignored.
    """
    levels = frozenset(declared) | (array_levels(merged_schema(df, fmt, payload)) if levels is None else levels)
    shredder = Shredder(levels, dict(carry or {}), None if wanted is None else dict(wanted))

    def explode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = _Rows()
            for e, f, text, *r in zip(*(c.to_pylist() for c in b.columns)):
                if (tree := read_payload(f, text)) is not _UNREADABLE:
                    shredder.shred(tree, e, rows, *r)
                if len(rows.plain) > BATCH_ROWS:
                    yield rows.batch()
                    rows = _Rows()
            if rows.plain:
                yield rows.batch()

    return df.select(entry, fmt, payload, *([] if record is None else [record])).mapInArrow(explode, SHRED_SCHEMA)


def attach_parents(children: DataFrame, parents: DataFrame, fields: Sequence[str]) -> DataFrame:
    """The children with the named fields, where they have none themselves, of their parent, found by its surrogate key.

    Keys are unique, so no child is repeated; a child without parent stays as it is.
    """
    above = parents.select(F.col("row_key").alias("parent_key"), *(F.col(f).alias(f"parent_{f}") for f in fields))
    found = children.join(above, "parent_key", "left")
    return found.withColumns({f: F.coalesce(f, f"parent_{f}") for f in fields}).select(children.columns)


def placed(path: str, levels: Iterable[str]) -> tuple[str, str]:
    """The table that a field comes to stand in, and its name there, by the array levels of the merged schema; the root table is ``""``."""
    if path in levels:
        return path, "text"
    level = max((x for x in levels if path.startswith(f"{x}.")), key=len, default="")
    return level, path[len(level) + 1 :] if level else path
