"""Adapter tails with insertions and deletions.

``distance(s)`` is the least edit distance between the adapter and the read from offset ``s`` on, where the adapter may
hang over the read's end and the read may go on after the adapter. An offset is good when its overlap, the lesser of the
adapter's length and the letters left, is at least ``min_overlap``, and its distance at most ``error_rate`` of the overlap,
rounded down. Edits let offsets near the true one be good too, so of those within the largest number of errors of the
first good one, the cut is where overlap less twice the distance is largest (the first of equals).

Reads are walked from their ends with the adapter reversed; a column of the distance table is two machine words of
vertical differences, and one step advances all reads of a batch. A long read is several lanes that overlap by the
adapter and its errors, so steps and memory do not depend on the longest read.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

WORD_BITS = 64
LANE_LETTERS = 512
# Letters that are walked at once.
CHUNK_LETTERS = 4_000_000


def _lanes(lengths: np.ndarray, reach: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Read, first and last letter of each lane: ``width`` offsets of its own and ``reach`` letters more."""
    pieces = -(-lengths // width)
    read = np.repeat(np.arange(len(lengths)), pieces)
    first = (np.arange(len(read)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * width
    return read, first, np.minimum(first + width + reach, lengths[read])


def edit_tails(
    seqs: Sequence[str], adapter: str, error_rate: float, min_overlap: int, lane_letters: int = LANE_LETTERS
) -> np.ndarray:
    """Letters to keep of each read: the offset of its adapter, or its length."""
    lengths = np.array([len(s) for s in seqs], dtype=np.int64)
    size = len(adapter)
    if not size or not lengths.sum():
        return lengths
    if size > WORD_BITS:
        raise ValueError(f"adapters have at most {WORD_BITS} letters, not {size}")
    errors = int(np.floor(error_rate * size + 1e-9))
    letters = np.frombuffer("".join(seqs).encode("ascii", "replace"), np.uint8)
    begins = np.cumsum(lengths) - lengths

    read, first, last = _lanes(lengths, size + errors, lane_letters)
    order = np.argsort(first - last, kind="stable")  # longest lanes first, so the active ones are a prefix
    read, first, last = read[order], first[order], last[order]
    spans, length = last - first, lengths[read]

    masks = np.zeros(256, np.uint64)
    for bit, letter in enumerate(adapter.encode("ascii", "replace")[::-1]):
        masks[letter] |= np.uint64(1) << np.uint64(bit)
    one, top = np.uint64(1), np.uint64(size - 1)
    at_end = last == length  # there the adapter's last letters may be missing at no cost
    plus = np.where(at_end, np.uint64(0), ~np.uint64(0))
    minus = np.zeros(len(read), np.uint64)
    distance = np.where(at_end, 0, size)

    allowed = np.floor(error_rate * np.arange(size + 1) + 1e-9).astype(np.int64)
    allowed[: max(min_overlap, 1)] = -1
    hits = []
    for step in range(1, int(spans[0]) + 1):
        n = int(np.searchsorted(-spans, -step, side="right"))
        offset = last[:n] - step
        equal = masks[letters[begins[read[:n]] + offset]]
        up, down = plus[:n], minus[:n]
        level = (((equal & up) + up) ^ up) | equal | down
        rise, fall = down | ~(level | up), level & up
        distance[:n] += ((rise >> top) & one).astype(np.int64) - ((fall >> top) & one).astype(np.int64)
        rise, fall = rise << one, fall << one
        plus[:n], minus[:n] = fall | ~(level | rise), rise & level
        overlap = np.minimum(length[:n] - offset, size)
        good = np.flatnonzero((distance[:n] <= allowed[overlap]) & (offset < first[:n] + lane_letters))
        if len(good):
            hits.append((read[good], offset[good], overlap[good] - 2 * distance[good]))
    cut = lengths.copy()
    if not hits:
        return cut
    owner, offset, score = (np.concatenate(column) for column in zip(*hits))
    np.minimum.at(cut, owner, offset)
    near = offset <= cut[owner] + errors
    owner, offset, score = owner[near], offset[near], score[near]
    best = np.lexsort((offset, -score, owner))
    owner, offset = owner[best], offset[best]
    lead = np.append(True, owner[1:] != owner[:-1])
    cut[owner[lead]] = offset[lead]
    return cut


def edit_tail_udf(adapter: str, error_rate: float, min_overlap: int):
    """Letters to keep as a column function; a null read keeps none."""

    @F.pandas_udf("int")
    def tail(seq: pd.Series) -> pd.Series:
        texts = seq.fillna("").tolist()
        filled = np.cumsum([len(t) for t in texts])
        out, begin = [], 0
        while begin < len(texts):
            limit = (filled[begin - 1] if begin else 0) + CHUNK_LETTERS
            end = max(int(np.searchsorted(filled, limit, side="right")), begin + 1)
            out.append(edit_tails(texts[begin:end], adapter, error_rate, min_overlap))
            begin = end
        return pd.Series(np.concatenate(out) if out else [], dtype="int32")

    return tail
