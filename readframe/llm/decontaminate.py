"""Benchmark decontamination with a generalised suffix automaton over words.

The automaton of all item words is walked with each text's words; at every word it knows the longest match that ends
there. A match of at least ``window`` words, or of a whole item that is shorter, marks its last ``window`` (or item)
words as hit. Long spans of hit words are cut out of the text; a text that is mostly hit is dropped.

Items are read to the driver in lots of at most ``LOT_WORDS`` words, each lot is one automaton with its own broadcast,
and a text walks through one after the other. A usual benchmark is one lot; a larger one takes more walks, not more
memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

from readframe.llm.common import each_piece, plain_words, texts_of

WINDOW = 10
LOT_WORDS = 500_000
COVERED = 0.8  # of a text's words; a text with a larger share of hit words is dropped
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class Automaton:
    """States have the transitions, suffix link and longest length; ``found`` says what a match in a state hits."""

    def __init__(self, items: list[tuple[object, list[bytes]]], window: int) -> None:
        self.window, self.words, self.next, self.link, self.longest = window, {}, [{}], [-1], [0]
        numbered = [(name, [self.words.setdefault(w, len(self.words)) for w in words]) for name, words in items if words]
        for _, ids in numbered:
            last = 0
            for i in ids:
                last = self._extend(last, i)
        self.least = min([window, *(len(ids) for _, ids in numbered)])
        # The names of the items behind each window, at the state whose strings include it; shorter items likewise.
        self.names: dict[tuple[int, int], set] = {}
        for name, ids in numbered:
            size = min(window, len(ids))
            for state, length in self.walk(ids, 0):
                if length >= size:
                    self.names.setdefault((self.holder(state, size), size), set()).add(name)
        self.sizes: dict[int, list[int]] = {}
        for state, size in self.names:
            self.sizes.setdefault(state, []).append(size)
        self.chain: dict[int, tuple[tuple[int, int], ...]] = {}

    def _extend(self, last: int, i: int) -> int:
        known = self.next[last].get(i)
        if known is not None and self.longest[known] == self.longest[last] + 1:
            return known
        if known is not None:
            return self._clone(last, i, known)
        state = self._new(self.longest[last] + 1, {})
        at = last
        while at >= 0 and i not in self.next[at]:
            self.next[at][i] = state
            at = self.link[at]
        if at < 0:
            self.link[state] = 0
        else:
            target = self.next[at][i]
            right = self.longest[target] == self.longest[at] + 1
            self.link[state] = target if right else self._clone(at, i, target)
        return state

    def _new(self, longest: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.longest.append(longest)
        self.link.append(0)
        return len(self.next) - 1

    def _clone(self, at: int, i: int, target: int) -> int:
        copy = self._new(self.longest[at] + 1, dict(self.next[target]))
        self.link[copy], self.link[target] = self.link[target], copy
        while at >= 0 and self.next[at].get(i) == target:
            self.next[at][i] = copy
            at = self.link[at]
        return copy

    def walk(self, ids: Iterable[int], state: int) -> Iterator[tuple[int, int]]:
        """(state, longest match) at each word."""
        following, link, longest, length = self.next, self.link, self.longest, 0
        for i in ids:
            while state and i not in following[state]:
                state = link[state]
                length = longest[state]
            onward = following[state].get(i)
            if onward is not None:
                state, length = onward, length + 1
            yield state, length

    def holder(self, state: int, size: int) -> int:
        """The state on the link path whose strings include the last ``size`` words."""
        while self.longest[self.link[state]] >= size:
            state = self.link[state]
        return state

    def hits(self, state: int) -> tuple[tuple[int, int], ...]:
        """(state, size) of the windows and short items that end a match in ``state``."""
        if state not in self.chain:
            own = tuple((state, size) for size in self.sizes.get(state, ()))
            self.chain[state] = own + (self.hits(self.link[state]) if self.link[state] > 0 else ())
        return self.chain[state]

    def search(self, words: list[bytes], hit: np.ndarray, names: set) -> int:
        """Mark hit words, add the names of the items, and return the longest match of a window or more."""
        ids = np.fromiter((self.words.get(w, -1) for w in words), dtype=np.int64, count=len(words))
        known = np.concatenate([[False], ids >= 0, [False]])
        edges = np.flatnonzero(known[1:] != known[:-1])
        most = 0
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - begin < self.least:
                continue
            for at, (state, length) in enumerate(self.walk(ids[begin:end].tolist(), 0), begin + 1):
                if length >= self.least:
                    most = max(most, length if length >= self.window else 0)
                    for holder, size in self.hits(state):
                        if size <= length:
                            hit[at - size : at] = True
                            names |= self.names[holder, size]
        return most


def _lots(items: DataFrame, item_col: str, text_col: str, lot_words: int) -> list[Broadcast]:
    rows = items.selectExpr(f"CAST(`{item_col}` AS STRING) AS item", f"CAST(`{text_col}` AS STRING) AS text").toLocalIterator()
    lots, lot, size, context = [], [], 0, items.sparkSession.sparkContext
    for row in rows:
        words = plain_words(row["text"] or "")
        if lot and size + len(words) > lot_words:
            lots.append(context.broadcast(lot))
            lot, size = [], 0
        lot.append((row["item"], words))
        size += len(words)
    return [*lots, context.broadcast(lot)] if lot else lots


def _found(lots: list[Broadcast], texts: list[str], window: int, built: dict[int, Automaton]) -> list[tuple[int, np.ndarray, set, int]]:
    """(words, hit flags, item names, longest match) of each text. ``built``, a task's own, keeps the last automaton."""
    words = [plain_words(t) for t in texts]
    out = [[len(w), np.zeros(len(w), dtype=bool), set(), 0] for w in words]
    for n, lot in enumerate(lots):
        if n not in built:
            built.clear()
            built[n] = Automaton(lot.value, window)
        automaton = built[n]
        for row, own in zip(out, words):
            row[3] = max(row[3], automaton.search(own, row[1], row[2]))
    return out


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return list(zip(edges[::2].tolist(), edges[1::2].tolist()))


def matches(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    lot_words: int = LOT_WORDS,
) -> DataFrame:
    """``doc_id, n_words, n_hit, spans, items, longest`` of every whole text.

    ``spans`` are the runs of hit words as (begin, end); ``items`` are the ids, as sorted strings, of the items with
    occurring windows. Null texts and items have no words; an item with a null id hits without a name; equal ids
    count once. ``longest`` is the longest match of ``window`` words or more, else 0. No items or no documents give no hits or no rows. Repeated rows stay; other columns are not read.
    """
    lots = _lots(items, item_col, text_col, lot_words)
    source = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("begin", pa.int32()), ("end", pa.int32())])
        built: dict[int, Automaton] = {}
        for batch in each_piece(batches, "text"):
            found = _found(lots, texts_of(batch, "text"), window, built)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([n for n, *_ in found], pa.int64()),
                    pa.array([int(hit.sum()) for _, hit, *_ in found], pa.int64()),
                    pa.array([[{"begin": a, "end": b} for a, b in _spans(hit)] for _, hit, *_ in found], pa.list_(span)),
                    pa.array([sorted(x for x in names if x is not None) for *_, names, _ in found], pa.list_(pa.string())),
                    pa.array([longest for *_, longest in found], pa.int32()),
                ],
                names=["doc_id", "n_words", "n_hit", "spans", "items", "longest"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"doc_id {kind}, n_words bigint, n_hit bigint, spans array<struct<begin: int, end: int>>, items array<string>, longest int",
    )


def clean(
    docs: DataFrame,
    items: DataFrame,
    window: int = WINDOW,
    covered: float = COVERED,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    lot_words: int = LOT_WORDS,
) -> DataFrame:
    """``docs`` without hit spans: each is cut from its first to its last word; all columns and other rows stay.

    A text with more than ``covered`` of its words hit is dropped. Null texts stay.
    """
    lots = _lots(items, item_col, item_text_col, lot_words)
    columns_of, at = docs.columns, docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built: dict[int, Automaton] = {}
        for batch in each_piece(batches, text_col):
            texts = batch.column(at).to_pylist()
            kept, new = [], []
            for row, (n, hit, _, _) in enumerate(_found(lots, [t or "" for t in texts], window, built)):
                if hit.any():
                    if hit.sum() > covered * n:
                        continue
                    texts[row] = cut(texts[row], _spans(hit))
                kept.append(row)
                new.append(texts[row])
            rows = batch.take(pa.array(kept, pa.int64()))
            columns = list(rows.columns)
            columns[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=columns_of)

    return docs.mapInArrow(run, docs.schema)


def cut(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without its words ``begin .. end - 1`` of each span and what stands between them."""
    raw = text.encode()
    places = [m.span() for m in WORD.finditer(raw)]
    out, last = [], 0
    for begin, end in spans:
        out.append(raw[last : places[begin][0]])
        last = places[end - 1][1]
    return b"".join([*out, raw[last:]]).decode()


def oracle(window: int = WINDOW) -> str:
    """The digest of ``matches`` as DuckDB SQL."""
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    )
    return f"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {words} AS w FROM benchmark),
windows AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT item, w, least({window}, len(w)) AS size, unnest(range(1, len(w) - least({window}, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0)),
texts AS (SELECT doc_id, {words} AS w FROM documents),
found AS (SELECT doc_id, i, size, item FROM (
    SELECT doc_id, size, i, array_to_string(w[i:i + size - 1], ' ') AS g
    FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM texts, (SELECT DISTINCT size FROM windows)))
  JOIN windows USING (size, g)),
hit AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS i FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
