"""Substring dedup: words of every window that starts in two places or more, by prefix-partitioned suffix trees.

A suffix is a window's place in a text. Its anchor is the run of ``ANCHOR`` words with the smallest hash within the
window (the first one, if several), and its prefix, of variable length, goes from its first word to the end of its anchor: like
windows have like prefixes. Neighbouring suffixes share their anchor, so they travel together as one segment, which
costs some three words a suffix and not a whole window.

1. The anchors of all texts are counted. A window whose anchor occurs once is nobody's copy; its suffix ends here.
2. Prefixes are dealt by their anchors to groups of about ``GROUP_BYTES``. The prefixes of an anchor that alone would fill
   a group are lengthened to the whole window, each suffix travels alone then, and alike ones go to one group.
3. A group builds the subtree of its suffixes by doubling the depth, from one word to the window; a suffix leaves when its
   branch has no other leaf. The internal nodes that are as deep as a window are the repeats. A leaf of several equal
   segments counts as often as they occur.
4. The marked windows go back to their texts, and the words under them are removed.

Words are compared as words in the trees; only anchors, segments and texts are known by hashes, the latter two of 128 bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from readframe.llm.common import Numbered, each_piece, stored

WINDOW, ANCHOR = 35, 12
GROUP_BYTES = 8_000_000
WORD_BYTES = 7  # of a word and a space, about; for the number of groups only
CROWDED = 6_000  # segments of one anchor

_MIX = np.uint64(0x9E3779B97F4A7C15)


class Piece:
    """The different texts of a batch: ``rows`` of each, words, and the anchor of every window."""

    def __init__(self, texts: list[bytes], window: int, anchor: int) -> None:
        known: dict[bytes, int] = {}
        self.rows: list[list[int]] = []
        for row, text in enumerate(texts):
            at = known.setdefault(text, len(known))
            if at == len(self.rows):
                self.rows.append([])
            self.rows[at].append(row)
        self.words = [text.split() for text in known]
        number, found = Numbered(), []
        for words in self.words:
            found.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number.new), dtype=np.uint64, count=len(number.new))
        sizes = np.array([len(f) for f in found], dtype=np.int64)
        self.begins = np.cumsum(sizes) - sizes
        self.text_of = np.repeat(np.arange(len(found)), np.maximum(sizes - window + 1, 0))
        flat = hashes[np.concatenate(found)] if found else np.zeros(0, dtype=np.uint64)
        starts = np.concatenate([np.arange(b, b + n - window + 1) for b, n in zip(self.begins, sizes)] or [np.zeros(0, dtype=np.int64)])
        self.starts = starts.astype(np.int64)
        hashed = _rolled(flat, anchor)
        at = _first_smallest(hashed, window - anchor + 1)[self.starts] if len(self.starts) else self.starts
        self.anchors = hashed[at].view(np.int64) if len(at) else np.zeros(0, dtype=np.int64)
        # Segments: runs of windows with one anchor.
        cuts = np.flatnonzero(at[1:] != at[:-1]) + 1 if len(at) else np.zeros(0, dtype=np.int64)
        self.first = np.concatenate([[0], cuts]).astype(np.int64)[: len(at)]
        self.last = np.concatenate([cuts, [len(at)]]).astype(np.int64)[: len(self.first)] - 1


def _rolled(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of ``size`` words from each place on."""
    n = max(len(hashes) - size + 1, 0)
    out = np.full(n, size, dtype=np.uint64)
    for k in range(size if n else 0):
        out = (out ^ hashes[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return out


def _first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of ``width`` values from each place on."""
    best, span = np.arange(len(values)), 1
    while span < width and len(best) > 0:
        step = min(span, width - span)
        a, b = best[: max(len(best) - step, 0)], best[step:]
        best, span = np.where(values[b] < values[a], b, a), span + step
    return best


def _sampled(window: int, anchor: int):
    """(text, anchor, segments, occurrences) of each different text of a piece."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_piece(batches, "text"):
            piece = Piece(batch.column("text").to_pylist(), window, anchor)
            pair = np.zeros(len(piece.first), dtype=[("text", np.int64), ("anchor", np.int64)])
            pair["text"], pair["anchor"] = piece.text_of[piece.first], piece.anchors[piece.first]
            pair, n = np.unique(pair, return_counts=True)
            copies, key = np.array([len(r) for r in piece.rows], dtype=np.int64), np.asarray(batch.column("k1"))
            rows = np.array([r[0] for r in piece.rows], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[rows[pair["text"]]] if len(pair) else [], pa.int64()),
                    pa.array(pair["anchor"], pa.int64()),
                    pa.array(n, pa.int32()),
                    pa.array(np.minimum(n * copies[pair["text"]], 2) if len(pair) else [], pa.int32()),
                ],
                names=["k1", "anchor", "n", "seen"],
            )

    return run


def _segments(window: int, anchor: int, groups: int):
    """(grp, segment, content, seen, k1, k2, start) of the segments whose anchor occurs elsewhere."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_piece(batches, "text"):
            piece = Piece(batch.column("text").to_pylist(), window, anchor)
            keys = [batch.column(c).to_pylist() for c in ("k1", "k2")]
            wanted = [batch.column(c) for c in ("plain", "crowded")]
            out: list[list] = []
            known: dict[bytes, list] = {}

            def add(group: int, begin: int, end: int) -> None:
                content = b" ".join(words[begin - base : end - base])
                segment = xxhash.xxh3_128_digest(content)
                if group < 0:
                    group = int.from_bytes(segment[:8]) % groups
                row = known.get(segment)
                if row is None:
                    known[segment] = row = [group, segment, content, copies, *key, begin - base]
                    out.append(row)
                else:
                    row[3] += copies
                    out.append([group, segment, None, 0, *key, begin - base])

            text_of = piece.text_of[piece.first]
            bounds = np.searchsorted(text_of, np.arange(len(piece.rows) + 1))
            for text, rows in enumerate(piece.rows):
                words, base, copies = piece.words[text], int(piece.begins[text]), len(rows)
                key = [k[rows[0]] for k in keys]
                own = slice(bounds[text], bounds[text + 1])
                anchors = piece.anchors[piece.first[own]]
                first, last = piece.starts[piece.first[own]], piece.starts[piece.last[own]]
                plain, crowded = (np.isin(anchors, np.asarray(w[rows[0]].values)) for w in wanted)
                for i in np.flatnonzero(plain).tolist():
                    add(int(anchors[i]) % groups, int(first[i]), int(last[i]) + window)
                for i in np.flatnonzero(crowded).tolist():
                    for begin in range(int(first[i]), int(last[i]) + 1):
                        add(-1, begin, begin + window)
            kinds = (pa.int32(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in out], kind) for i, kind in enumerate(kinds)],
                names=["grp", "segment", "content", "seen", "k1", "k2", "start"],
            )

    return run


def repeated(ids: np.ndarray, depth: int) -> np.ndarray:
    """Whether the ``depth`` numbers from each place on occur from another place on as well.

    Nodes of the suffix tree, level by level: ``node`` is the node of a suffix at depth ``length``; a suffix that is alone
    in its node gets one that nothing else has and is not looked at again.
    """
    n = len(ids)
    node = np.zeros(n + depth, dtype=np.int64)  # nothing follows the last place
    _, child, leaves = np.unique(ids, return_inverse=True, return_counts=True)
    shared = leaves[child] > 1
    node[:n] = np.where(shared, child + 1, n + 1 + np.arange(n))
    alive, length = np.flatnonzero(shared), 1
    while length < depth and len(alive):
        step = min(length, depth - length)
        pair = node[alive] * (2 * n + 2) + node[alive + step]
        _, child, leaves = np.unique(pair, return_inverse=True, return_counts=True)
        shared = leaves[child] > 1
        node[:n] = n + 1 + np.arange(n)
        alive = alive[shared]
        node[alive] = child[shared] + 1
        length += step
    out = np.zeros(n, dtype=bool)
    out[alive] = True
    return out


def _subtree(window: int):
    """(segment, marks): one bit for each window of a segment that has a repeated one."""

    def run(group: pa.Table) -> pa.Table:
        number, flat, sizes = Numbered(), [], []
        for content in group["content"].to_pylist():
            words = content.split()
            flat.append(np.fromiter(map(number.__getitem__, words), dtype=np.int64, count=len(words)))
            sizes.append(len(words))
        # A number of its own after each segment ends its suffixes.
        ends = np.cumsum(np.array(sizes, dtype=np.int64) + 1) - 1
        ids = np.full(int(ends[-1]) + 1, -1, dtype=np.int64)
        ids[np.delete(np.arange(len(ids)), ends)] = np.concatenate(flat)
        ids[ends] = len(number) + np.arange(len(ends))
        marks, segments, bits = repeated(ids, window), [], []
        for segment, seen, size, end in zip(group["segment"].to_pylist(), group["seen"].to_pylist(), sizes, ends.tolist()):
            own = marks[end - size : end - window + 1]
            if seen > 1:
                own = np.ones_like(own)
            if own.any():
                segments.append(segment)
                bits.append(np.packbits(own).tobytes())
        return pa.table({"segment": pa.array(segments, pa.binary()), "marks": pa.array(bits, pa.binary())})

    return run


def covered(words: int, marks: list[tuple[int, bytes]], window: int) -> np.ndarray:
    """Which words lie under a marked window; marks are (first window, bits)."""
    edge = np.zeros(words + 1, dtype=np.int64)
    for start, bits in marks:
        at = start + np.flatnonzero(np.unpackbits(np.frombuffer(bits, dtype=np.uint8)))
        np.add.at(edge, at, 1)
        np.add.at(edge, at + window, -1)
    return np.cumsum(edge)[:words] > 0


def _removed(window: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.struct([("begin", pa.int32()), ("end", pa.int32())])
        for batch in each_piece(batches, "text"):
            sizes, removed, spans, kept = [], [], [], []
            for text, marks in zip(batch.column("text").to_pylist(), batch.column("marks").to_pylist()):
                words = text.split()
                sizes.append(len(words))
                if marks:
                    gone = covered(len(words), [(m["start"], m["marks"]) for m in marks], window)
                    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).tolist()
                    spans.append([{"begin": a, "end": b} for a, b in zip(edges[::2], edges[1::2])])
                    words = [w for w, g in zip(words, gone.tolist()) if not g]
                else:
                    spans.append([])
                removed.append(sizes[-1] - len(words))
                kept.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(span)),
                    pa.array(kept, pa.string()),
                ],
                names=["doc_id", "n_words", "n_removed", "spans", "kept"],
            )

    return run


def dedup(
    docs: DataFrame,
    window: int = WINDOW,
    anchor: int = ANCHOR,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_bytes: int = GROUP_BYTES,
    crowded: int = CROWDED,
) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept`` of every row.

    A word ``[^\\x20\\x09-\\x0D]+`` is removed if it lies in a window of ``window`` words whose words also stand, in that
    order, from any other place on, in the same text or another. ``spans`` are the runs of removed words as (begin, end),
    ``kept`` is the rest, joined by one space. Null and empty texts have no words; texts shorter than a window keep
    all. Repeated rows, ids or texts count as often as they stand there, and each row is returned; a null id stays null.
    No rows give no rows. Other columns are not read.
    """
    source = docs.selectExpr(f"`{id_col}` AS doc_id", f"CAST(coalesce(CAST(`{text_col}` AS STRING), '') AS BINARY) AS text")
    keyed = source.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(1), "text")})
    found = stored(
        keyed.select("k1", "text").mapInArrow(_sampled(window, anchor), "k1 bigint, anchor bigint, n int, seen int"), "anchors", "zstd"
    )
    counts = found.groupBy("anchor").agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")).filter("seen > 1")
    counts = stored(counts.select("anchor", "n"), "shared")
    total = counts.agg(F.sum("n")).first()[0] or 0
    groups = int(total * WORD_BYTES * (window + (window - anchor) // 2) // group_bytes) + 1
    own = found.select("k1", "anchor").join(counts.select("anchor", (F.col("n") > crowded).alias("many")), "anchor")
    own = own.groupBy("k1").agg(
        F.collect_set(F.when(~F.col("many"), F.col("anchor"))).alias("plain"), F.collect_set(F.when(F.col("many"), F.col("anchor"))).alias("crowded")
    )
    segments = keyed.select("k1", "k2", "text").join(own, "k1").mapInArrow(
        _segments(window, anchor, groups), "grp int, segment binary, content binary, seen bigint, k1 bigint, k2 bigint, start int"
    )
    segments = stored(segments, "segments", "zstd")
    # One shuffle: equal segments meet in their group's partition.
    contents = segments.filter("content IS NOT NULL").select("grp", "segment", "content", "seen").repartition("grp")
    contents = contents.groupBy("grp", "segment").agg(F.first("content").alias("content"), F.sum("seen").alias("seen"))
    marks = contents.groupBy("grp").applyInArrow(_subtree(window), "segment binary, marks binary")
    marks = stored(marks, "marks")
    marked = segments.select("segment", "k1", "k2", "start").join(marks, "segment").groupBy("k1", "k2")
    marked = marked.agg(F.collect_set(F.struct("start", "marks")).alias("marks"))
    kind = source.schema["doc_id"].dataType.simpleString()
    rows = keyed.join(marked, ["k1", "k2"], "left").select("doc_id", "text", "marks")
    return rows.mapInArrow(
        _removed(window), f"doc_id {kind}, n_words bigint, n_removed bigint, spans array<struct<begin: int, end: int>>, kept string"
    )


def oracle(window: int = WINDOW) -> str:
    """The digest of ``dedup`` over ``documents`` as DuckDB SQL."""
    return f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
windows AS (SELECT r, i, md5(array_to_string(w[i:i + {window} - 1], ' ')) AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - {window} + 2)) AS i FROM texts)),
hit AS (SELECT DISTINCT r, unnest(range(i, i + {window})) AS j FROM windows
  WHERE g IN (SELECT g FROM windows GROUP BY g HAVING count(*) > 1)),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS words
  FROM (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM texts) ANTI JOIN hit USING (r, j) GROUP BY r)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""
