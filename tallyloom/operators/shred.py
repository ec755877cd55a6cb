"""Deeply nested records to related flat tables.

Method: columnar shredding. Every leaf path of a payload, as it is, becomes a column of entries, each with a
repetition level (at which repeated ancestor the entry repeats) and a definition level (how much of
its path is present, and whether what is there is null, empty, of another kind, or a value). The table of a repeated ancestor is rebuilt from
the level sequences alone: an entry whose repetition level is at most the ancestor's depth begins a new row of it. Records come back from
their columns without loss.

Columns are built in batches inside ``mapInArrow``; a record is shredded and rebuilt in the task
that parses it, so its parts are never shuffled and no group is gathered. Paths are found in the data: no
schema is declared, and one path may hold values of several types.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cached_property
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import WHITE_SPACE, strip
from ..session import ship
from .latest import latest_by

REPEAT = "[]"
#: Definition levels, of the node where a path ends or its content ends, added to three times the node's depth.
BITS = 20  # for a definition level
NULL, EMPTY, OTHER = 0, 1, 2  # null; a container without the next step; of another kind than the next step needs, at the full depth a value


# ---------------------------------------------------------------- shredding


class LeafColumn:
    """Entries of one leaf path: repetition levels, definition levels and values, held as one packed list of both levels and the values that
    there are. ``order``: the entries' places in the document's order, where these are wanted."""

    def __init__(self, path: tuple[str, ...]):
        self.path = path
        self.levels: list[int] = []
        self.real: list = []
        self.order: list[int] | None = None

    def ordered(self, clock: Iterator[int]) -> Callable[[int], None]:
        """A function that adds an entry and its place in the document's order."""
        self.order = []
        level, place = self.levels.append, self.order.append

        def put(code: int) -> None:
            level(code)
            place(next(clock))

        return put

    @property
    def max_def(self) -> int:
        return 3 * len(self.path) + OTHER

    @cached_property
    def _packed(self) -> np.ndarray:
        return np.array(self.levels, dtype=np.int64)

    @cached_property
    def rep(self) -> list[int]:
        return (self._packed >> BITS).tolist()

    @cached_property
    def defined(self) -> list[int]:
        return (self._packed & (1 << BITS) - 1).tolist()

    @cached_property
    def values(self) -> list:
        """The value of each entry, null where there is none."""
        out = np.full(len(self.levels), None, dtype=object)
        there = np.flatnonzero((self._packed & (1 << BITS) - 1) == self.max_def)
        for i, v in zip(there.tolist(), self.real):
            out[i] = v
        return out.tolist()


class Node:
    """A place in the union of all records' shapes: an object's key, or the elements of an array."""

    __slots__ = ("path", "rep", "leaf", "keys", "items", "column", "below", "puts")

    def __init__(self, path: tuple[str, ...] = (), rep: int = 0):
        self.path, self.rep, self.leaf = path, rep, False
        self.keys: dict[str, Node] = {}
        self.items: Node | None = None
        self.column: LeafColumn | None = None
        self.below: list[LeafColumn] = []

    def children(self) -> list[Node]:
        return [*self.keys.values(), *([self.items] if self.items else [])]

    def walk(self) -> Iterator[Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(reversed(node.children()))

    def grow(self, value: object) -> None:
        if isinstance(value, dict):
            for k, v in value.items():
                c = self.keys.get(k)
                if c is None:
                    step = "\\" + k if k[:1] == "\\" or k == REPEAT else k  # a key that is spelt like the sign of an array
                    c = self.keys[k] = Node((*self.path, step), self.rep)
                c.grow(v)
        elif isinstance(value, list):
            if self.items is None:
                self.items = Node((*self.path, REPEAT), self.rep + 1)
            for v in value:
                self.items.grow(v)
        elif value is not None:
            self.leaf = True

    def finish(self, marks: tuple[str, ...]) -> None:
        """Give each place its own column, if it has one, and the list of all columns at or below it."""
        nodes = [*self.walk()]
        for node in reversed(nodes):
            node.below = []
            if node.leaf or not (node.keys or node.items):
                node.column = LeafColumn(node.path)
                node.below.append(node.column)
            for c in node.children():
                node.below += c.below
        clock = count()
        puts: dict[int, Callable] = {}
        for node in nodes:
            for m in marks:
                if m in node.keys:
                    c = node.keys[m].below[0]
                    puts[id(c)] = c.ordered(clock)
        for node in nodes:
            node.puts = [puts.get(id(c)) or c.levels.append for c in node.below]


class Shredded:
    """A batch of parsed records in leaf columns; every record has at least one entry in each.

    ``marks`` names the keys whose first columns keep the document's order.
    """

    def __init__(self, records: list, marks: tuple[str, ...] = ()):
        self.root, self.n = Node(), len(records)
        for r in records:
            self.root.grow(r)
        self.root.finish(marks)
        self.columns = {c.path: c for c in self.root.below}
        for r in records:
            self._put(self.root, r, 0)

    def _put(self, node: Node, value: object, rep: int) -> None:
        """Add the entries of ``value``; what a record lacks below a place is one entry in each of its columns."""
        code = rep << BITS | 3 * len(node.path)
        own = node.column
        if value is None:
            for put in node.puts:
                put(code)
        elif isinstance(value, dict):
            for k, v in value.items():
                self._put(node.keys[k], v, rep)
            if len(value) < len(node.keys):
                for k, c in node.keys.items():
                    if k not in value:
                        self._lack(c, code + EMPTY)
            if node.items:
                self._lack(node.items, code + OTHER)
            if own:
                node.puts[0](code + EMPTY)
        elif isinstance(value, list):
            items = node.items
            if value:
                self._put(items, value[0], rep)
                for v in value[1:]:
                    self._put(items, v, items.rep)
            else:
                self._lack(items, code + EMPTY)
            for c in node.keys.values():
                self._lack(c, code + OTHER)
            if own:
                node.puts[0](code + EMPTY)
        else:
            for put in node.puts:
                put(code + OTHER)
            own.real.append(value)

    def _lack(self, node: Node, code: int) -> None:
        for put in node.puts:
            put(code)


def shred(records: list) -> dict[tuple[str, ...], LeafColumn]:
    """The leaf columns of a batch of parsed records."""
    with _deep():
        return Shredded(records).columns


@contextmanager
def _deep(limit: int = 20_000) -> Iterator[None]:
    """Records may be that deep."""
    old = sys.getrecursionlimit()
    sys.setrecursionlimit(max(old, limit))
    try:
        yield
    finally:
        sys.setrecursionlimit(old)


# ---------------------------------------------------------------- rebuilding


def ordinals(column: LeafColumn, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per entry: record number, and 1-based place in each of the first ``depth`` repeated ancestors.

    The third array tells which entries begin a row of the deepest of them. All come from the
    levels: an entry with repetition level r starts a new element of ancestor r and, below it,
    the first elements of the deeper ones.
    """
    rep = np.asarray(column.rep, dtype=np.int64)
    record = np.cumsum(rep == 0) - 1
    places = np.zeros((depth, len(rep)), dtype=np.int64)
    if not len(rep):
        return record, places, np.zeros(0, dtype=bool)
    index = np.arange(len(rep))
    for level in range(1, depth + 1):
        began = rep < level  # the parent row begins here
        step = (rep <= level).astype(np.int64)
        total = np.cumsum(step)
        start = np.maximum.accumulate(np.where(began, index, 0))
        places[level - 1] = total - total[start] + 1
    return record, places, rep <= depth


def table(columns: dict, ancestor: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray, dict[tuple[str, ...], list]]:
    """Rows of the repeated ``ancestor``: record number, places in its repeated ancestors, and its own leaves.

    ``ancestor`` ends with ``[]`` or is empty (the records themselves). A leaf belongs to the table if no
    further repetition lies below the ancestor. Absent elements (empty or missing arrays) give no row.
    """
    depth, n = ancestor.count(REPEAT), len(ancestor)
    own = {p: c for p, c in columns.items() if p[:n] == ancestor and REPEAT not in p[n:]}
    below = [c for p, c in columns.items() if p[:n] == ancestor]
    if not below:
        return np.zeros(0, np.int64), np.zeros((depth, 0), np.int64), {}
    spine = next(iter(own.values()), below[0])
    record, places, begins = ordinals(spine, depth)
    there = begins & (np.asarray(spine.defined) >= 3 * n)
    cells = {p: np.asarray(c.values, dtype=object)[there].tolist() if c.values else [] for p, c in own.items()}
    return record[there], places[:, there], cells


def rebuild(columns: dict, n_records: int) -> list:
    """The records again, from their leaf columns alone, without loss (the round trip)."""
    root = Node()
    for path in columns:
        node = root
        for step in path:
            if step == REPEAT:
                node.items = node.items or Node((*node.path, REPEAT), node.rep + 1)
                node = node.items
            else:
                key = step[1:] if step[:1] == "\\" else step
                node = node.keys.setdefault(key, Node((*node.path, step), node.rep))
        node.column = columns[path]
    for node in reversed([*root.walk()]):
        node.below = [*([node.column] if node.column else []), *(x for c in node.children() for x in c.below)]
    at = dict.fromkeys(columns, 0)

    def passed(leaves: list[LeafColumn]) -> None:
        for c in leaves:
            at[c.path] += 1

    def read(node: Node) -> object:
        level = 3 * len(node.path)
        seen = [c.defined[at[c.path]] for c in node.below]
        if seen[0] == level + NULL:
            return passed(node.below)
        own = node.column
        if own and own.defined[at[own.path]] == level + OTHER:
            value = own.values[at[own.path]]
            passed(node.below)
            return value
        if own:
            passed([own])
        items = node.items
        if items and items.below[0].defined[at[items.below[0].path]] != level + OTHER:
            for c in node.keys.values():
                passed(c.below)
            first = items.below[0]
            if first.defined[at[first.path]] == level + EMPTY:
                passed(items.below)
                return []
            out = [read(items)]
            while at[first.path] < len(first.rep) and first.rep[at[first.path]] == items.rep:
                out.append(read(items))
            return out
        if items:
            passed(items.below)
        found = {}
        for k, c in node.keys.items():
            if c.below[0].defined[at[c.below[0].path]] == level + EMPTY:
                passed(c.below)
            else:
                found[k] = read(c)
        return found

    with _deep():
        return [read(root) for _ in range(n_records)]


# ---------------------------------------------------------------- records of hits

_NUMBER = re.compile(r"[+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?\Z", re.ASCII)


def number(value: object) -> float | None:
    """A JSON number, or a text that reads as one, outer white space aside; truth values aren't numbers."""
    if isinstance(value, bool):
        return None
    if isinstance(value, str):
        text = value.strip(WHITE_SPACE)
        value = float(text) if _NUMBER.match(text) else None
    if isinstance(value, (int, float)):
        try:
            value = float(value)
        except OverflowError:
            return None
        return value if value == value else None
    return None


def text(value: object) -> str | None:
    """A text that isn't blank, trimmed."""
    if not isinstance(value, str):
        return None
    value = value.strip(WHITE_SPACE)
    if not value.isascii():  # a lone surrogate, which JSON can escape, has no UTF-8 form
        value = value.encode("utf-16", "surrogatepass").decode("utf-16", "replace")
    return value or None


def parse(payload: str | None) -> object:
    """The JSON value of a payload; None if it is null or no complete JSON."""
    if payload is None:
        return None
    try:
        return json.loads(payload)
    except (ValueError, RecursionError):
        return None


def decoded(payload: str | None, repeated: str) -> object:
    """The parsed payload, with a text in place of ``repeated`` read as JSON, once for each time it was encoded."""
    value = parse(payload)
    level = [value]
    while level:
        below = []
        for x in level:
            if isinstance(x, dict):
                held = x.get(repeated)
                while isinstance(held, str) and (inner := parse(held)) is not None:
                    x[repeated] = held = inner
                below.extend(x.values())
        level = below
    return value


class Records:
    """A batch of payloads in shredded form, and where its records and their hits are.

    A record is the nearest object, from the payload downwards, that has the key ``repeated``, or else ``key``. A hit is an object with
    the key ``mark``, however deep under the record's ``repeated``, but not inside another hit. All of it is read from the columns: which
    paths have such a key from the paths, whether a record has it there from the definition levels, the number of a hit
    by merging the sequences of all these paths in the document's order.
    """

    def __init__(self, payloads: list[str | None], repeated: str = "Hits", key: str = "Sequence ID", mark: str = "gene"):
        self.repeated, self.mark, self.n = repeated, mark, len(payloads)
        with _deep():
            self.shredded = Shredded([decoded(p, repeated) for p in payloads], (repeated, key, mark))
        self.columns = self.shredded.columns
        self.at: list[tuple[str, ...] | None] = [None] * self.n  # where each record lies in its payload
        for wanted in (repeated, key):
            best: list[tuple[int, int] | None] = [None] * self.n
            for node in self.shredded.root.walk():
                if wanted not in node.keys or REPEAT in node.path:
                    continue
                depth, spine = len(node.path), node.keys[wanted].below[0]
                for rep, defined, order, r in zip(spine.rep, spine.defined, spine.order, _numbers(spine)):
                    if rep == 0 and defined >= 3 * (depth + 1) and self.at[r] is None and (best[r] is None or (depth, order) < best[r][:2]):
                        best[r] = (depth, order, node.path)
            self.at = [self.at[r] or (b[2] if b else None) if self.at[r] is None else self.at[r] for r, b in enumerate(best)]
        self._find_hits()

    def _find_hits(self) -> None:
        #: ancestor path -> (rows of its table, cells of the rows); and all hits as (record, order, path, row)
        self.tables: dict[tuple[str, ...], tuple[np.ndarray, np.ndarray, dict]] = {}
        found: list[tuple[int, int, tuple[str, ...], int]] = []
        taken: dict[tuple[str, ...], set] = {}
        self.number: dict[tuple, int] = {}
        nodes = sorted((x for x in self.shredded.root.walk() if self.mark in x.keys and self.repeated in x.path), key=lambda x: len(x.path))
        for node in nodes:
            path, depth = node.path, node.path.count(REPEAT)
            spine = node.keys[self.mark].below[0]
            record, places, begins = ordinals(spine, depth)
            there = begins & (np.asarray(spine.defined) >= 3 * (len(path) + 1))
            rows = np.flatnonzero(there)
            above = [(p, p.count(REPEAT)) for p in taken if path[: len(p)] == p]
            own = taken.setdefault(path, set())
            for i, r, place in zip(rows.tolist(), record[rows].tolist(), places[:, rows].T.tolist()):
                at = self.at[r]
                if at is None or path[: len(at) + 1] != (*at, self.repeated):
                    continue
                instance = (r, *place)
                if any((r, *place[:d]) in taken[p] for p, d in above):
                    own.add(instance)  # what is inside it is inside another hit too
                    continue
                own.add(instance)
                found.append((r, spine.order[i], path, i))
                self.number[path, instance] = -len(found)
        self.hits = sorted(found)
        numbers: list[int] = []
        for k, (r, *_) in enumerate(self.hits):
            numbers.append(numbers[-1] + 1 if k and self.hits[k - 1][0] == r else 1)
        self.hit_no = numbers
        rank = {(path, i): no for (_, _, path, i), no in zip(self.hits, numbers)}
        back = {-k: (path, i) for k, (_, _, path, i) in enumerate(found, 1)}
        self.number = {x: rank[back[k]] for x, k in self.number.items()}

    def hit_values(self, name: str, read) -> list:
        """A field of every hit, in the order of ``hits``."""
        columns, mark = self.columns, self.mark
        begun: dict[tuple[str, ...], np.ndarray] = {}
        out = []
        for _, _, path, i in self.hits:
            c = columns.get((*path, name))
            if c is None:
                out.append(None)
                continue
            spine = (*path, mark)
            if spine not in columns:  # the key holds containers only: its entries aren't one to one with the objects
                if path not in begun:
                    s = next(x for p, x in columns.items() if p[: len(spine)] == spine)
                    begun[path] = np.cumsum(np.asarray(s.rep) <= path.count(REPEAT)) - 1
                i = int(begun[path][i])
            out.append(read(c.values[i]))
        return out

    def field(self, names: tuple[str, ...], read) -> list:
        """A field of every record that lies outside its arrays; null where there is no record."""
        out = []
        for r, at in enumerate(self.at):
            c = self.columns.get((*at, *names)) if at is not None else None
            out.append(read(c.values[r]) if c else None)
        return out

    def segments(self, name: str) -> Iterator[tuple[int, int, int, dict, int]]:
        """The elements of the array ``name`` of every hit: record, hit, place, own cells of the table, row."""
        for path in {p for _, _, p, _ in self.hits}:
            depth = path.count(REPEAT)
            record, places, cells = table(self.columns, (*path, name, REPEAT))
            for i, (r, place) in enumerate(zip(record.tolist(), places.T.tolist())):
                no = self.number.get((path, (r, *place[:depth])))
                if no is not None:
                    yield r, no, place[depth], {p[len(path) + 2 :]: v for p, v in cells.items()}, i


def _numbers(column: LeafColumn) -> list[int]:
    """The record of every entry."""
    return (np.cumsum(np.asarray(column.rep) == 0) - 1).tolist()


def record_batches(batches: Iterator[pa.RecordBatch], id_col: str, payload_col: str) -> Iterator[tuple[list, Records]]:
    """For each Arrow batch: ids and shredded payloads."""
    for b in batches:
        yield b.column(b.schema.names.index(id_col)).to_pylist(), Records(b.column(b.schema.names.index(payload_col)).to_pylist())


HIT_SCHEMA = "record_id bigint, hit_no int, sequence_id string, gene string, bit_score double, e_value double, gene_type string, percent_identity double, percent_fraction string, alignment_start int, alignment_end int"
SEGMENT_SCHEMA = "record_id bigint, hit_no int, segment_no int, region string, span_from int, span_to int, matches int"
RECORD_SCHEMA = "record_id bigint, is_complete boolean, sequence_id string, sequence_length int, domain string, chain_type string, productive string, cdr3_nt string, lowest_phred int, n_hits int"
LEVEL_SCHEMA = "record_id bigint, path string, entry int, rep int, def int, value string"


def _int(value: object) -> int | None:
    x = number(value)
    return int(x) if x is not None and x.is_integer() and abs(x) < 2**31 else None


def _inputs(df: DataFrame, id_col: str, payload_col: str, stamp_col: str | None) -> DataFrame:
    """One payload per record: a closed one before one that was cut off, then the newest, then the greatest text.

    Done before parsing, as an aggregate: a record delivered again and again is reduced to one state in
    each task and parsed once. Rows without a record id can't be linked and are dropped.
    """
    ship(df.sparkSession)
    payload = F.col(payload_col).cast("string")
    stamp = F.col(stamp_col) if stamp_col else F.lit(None).cast("timestamp")
    closed = F.coalesce(F.endswith(strip(payload), F.lit("}")), F.lit(False))
    return latest_by(df, {"record_id": F.col(id_col).cast("bigint")}, F.struct(closed, stamp), {"payload": payload})


def _batch(schema: str, arrays: list[list]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[k]) for v, (_, k) in zip(arrays, fields)], names=[n for n, _ in fields])


def hit_table(df: DataFrame, id_col: str = "record_id", payload_col: str = "payload", stamp_col: str | None = "loaded_at") -> DataFrame:
    """One row per hit: its record, its place in document order from 1, its record's key and its fields.

    Hits with a missing gene or score keep their number and have null fields. A repeated delivery of a
    record gives its hits once. Payloads that are null, cut off or no record give no rows. Numbers held
    as text are read as numbers; anything else in their place is null. Other columns of ``df`` are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in record_batches(batches, "record_id", "payload"):
            keys = x.field(("Sequence ID",), text)
            fields = [("gene", text), ("bit_score", number), ("e_value", number), ("gene_type", text), ("percent_identity", number), ("percent_fraction", text), ("alignment_start", _int), ("alignment_end", _int)]
            yield _batch(HIT_SCHEMA, [[ids[h[0]] for h in x.hits], x.hit_no, [keys[h[0]] for h in x.hits], *(x.hit_values(n, read) for n, read in fields)])

    return _inputs(df, id_col, payload_col, stamp_col).mapInArrow(run, HIT_SCHEMA)


def segment_table(df: DataFrame, id_col: str = "record_id", payload_col: str = "payload", stamp_col: str | None = "loaded_at") -> DataFrame:
    """One row per segment of a hit, linked by ``record_id`` and ``hit_no``. See ``hit_table`` for the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in record_batches(batches, "record_id", "payload"):
            rows = []
            for r, no, place, cells, i in x.segments("segments"):
                at = lambda read, *names: read(cells[names][i]) if names in cells else None  # noqa: B023, E731
                rows.append((ids[r], no, place, at(text, "region"), at(_int, "span", "from"), at(_int, "span", "to"), at(_int, "matches")))
            yield _batch(SEGMENT_SCHEMA, [*map(list, zip(*rows))] if rows else [[]] * 7)

    return _inputs(df, id_col, payload_col, stamp_col).mapInArrow(run, SEGMENT_SCHEMA)


def record_table(df: DataFrame, id_col: str = "record_id", payload_col: str = "payload", stamp_col: str | None = "loaded_at") -> DataFrame:
    """One row per record: the parent of the other tables. A payload without a record has ``is_complete`` false."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in record_batches(batches, "record_id", "payload"):
            hits = np.bincount([h[0] for h in x.hits], minlength=x.n) if x.hits else np.zeros(x.n, np.int64)
            fields = [(("Sequence ID",), text), (("Sequence Length",), _int), (("Domain Classification",), text), (("Chain type",), text), (("Productive",), text), (("CDR3", "NT"), text), (("CDR3", "Quality", "Lowest Phred"), _int)]
            yield _batch(RECORD_SCHEMA, [ids, [a is not None for a in x.at], *(x.field(n, read) for n, read in fields), hits.tolist()])

    return _inputs(df, id_col, payload_col, stamp_col).mapInArrow(run, RECORD_SCHEMA)


def level_table(df: DataFrame, id_col: str = "record_id", payload_col: str = "payload", stamp_col: str | None = "loaded_at") -> DataFrame:
    """The shredded form itself: one row per record, leaf path and entry, with its levels and its value as JSON.

    ``entry`` numbers a record's entries of one path from 1. Paths in which a record has nothing are left out of it.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in record_batches(batches, "record_id", "payload"):
            for path, c in x.columns.items():
                rep, record = np.asarray(c.rep), np.asarray(_numbers(c))
                index = np.arange(len(rep))
                entry = index - np.maximum.accumulate(np.where(rep == 0, index, 0)) + 1 if len(rep) else index
                kept = np.flatnonzero((np.asarray(c.defined) >= 3 * len(path)) | (rep > 0)).tolist()
                values = [None if c.values[i] is None else json.dumps(c.values[i], ensure_ascii=False).encode("utf-16", "surrogatepass").decode("utf-16", "replace") for i in kept]
                yield _batch(LEVEL_SCHEMA, [[ids[record[i]] for i in kept], [".".join(path)] * len(kept), entry[kept].tolist(), [c.rep[i] for i in kept], [c.defined[i] for i in kept], values])

    return _inputs(df, id_col, payload_col, stamp_col).mapInArrow(run, LEVEL_SCHEMA)
