"""Adapter tails with insertions and deletions against a plain distance table."""

import numpy as np
import pytest

from readframe.operators import trim
from readframe.operators.edit_tail import edit_tail_udf, edit_tails

ADAPTER = "CTGTCTCTTATACACATCTGACGCTGCCGACGA"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row


def slow(seq, adapter, rate, overlap):
    """The definition, offset by offset."""
    limit = int(np.floor(rate * len(adapter) + 1e-9))
    good = []
    for s in range(len(seq)):
        rest = seq[s : s + len(adapter) + limit + 1]
        n = min(len(adapter), len(seq) - s)
        best = min(distance(adapter, rest))
        if len(rest) == len(seq) - s:
            best = min(best, min(distance(rest, adapter)))
        if n >= max(overlap, 1) and best <= np.floor(rate * n + 1e-9):
            good.append((s, n - 2 * best))
    near = [(-score, s) for s, score in good if s <= good[0][0] + limit]
    return min(near)[1] if near else len(seq)


def reads_with_edits(rng, count, longest):
    for _ in range(count):
        body = "".join(rng.choice(list("ACGTN"), rng.integers(0, longest)))
        tail = list(ADAPTER[: rng.integers(0, len(ADAPTER) + 1)])
        for _ in range(rng.integers(0, 5)):
            if tail:
                at = int(rng.integers(0, len(tail)))
                kind = rng.integers(0, 3)
                if kind == 0:
                    tail[at] = "A"
                elif kind == 1:
                    del tail[at]
                else:
                    tail.insert(at, "G")
        yield body + "".join(tail) + "".join(rng.choice(list("ACGT"), rng.integers(0, 12)))


@pytest.mark.parametrize("rate, overlap", [(0.15, 3), (0.1, 1), (0.0, 5), (0.3, 3)])
@pytest.mark.parametrize("lane", [7, 512])
def test_equals_plain_table(rate, overlap, lane):
    reads = ["", "C", "CTG", ADAPTER, ADAPTER + ADAPTER, *reads_with_edits(np.random.default_rng(5), 120, 60)]
    want = [slow(r, ADAPTER, rate, overlap) for r in reads]
    assert edit_tails(reads, ADAPTER, rate, overlap, lane).tolist() == want


def test_deletions_insertions_and_overhang():
    assert edit_tails(["GGGG" + ADAPTER[:10] + ADAPTER[12:]], ADAPTER, 0.15, 3).tolist() == [4]
    assert edit_tails(["GGGG" + ADAPTER[:10] + "AA" + ADAPTER[10:]], ADAPTER, 0.15, 3).tolist() == [4]
    assert edit_tails(["GGGGGGGG" + ADAPTER[:15] + "A" + ADAPTER[15:25]], ADAPTER, 0.15, 3).tolist() == [8]
    assert edit_tails(["GGGG"], ADAPTER, 0.15, 3).tolist() == [4]
    assert edit_tails([], ADAPTER, 0.15, 3).tolist() == []
    assert edit_tails(["ACGT"], "", 0.15, 3).tolist() == [4]


def test_adapter_of_a_whole_word_and_beyond():
    adapter = (ADAPTER * 2)[:64]
    reads = ["GATTACA" + adapter, "GATTACA" + adapter[:30] + adapter[31:], "G" * 700 + adapter[:20]]
    assert edit_tails(reads, adapter, 0.1, 3).tolist() == [slow(r, adapter, 0.1, 3) for r in reads]
    with pytest.raises(ValueError):
        edit_tails(["A"], adapter + "A", 0.1, 3)


def test_one_very_long_read():
    body = "".join(np.random.default_rng(9).choice(list("ACG"), 2_000_000))
    assert edit_tails([body + ADAPTER[:20] + "A" + ADAPTER[20:]], ADAPTER, 0.1, 20).tolist() == [2_000_000]


def test_step_and_null(spark):
    rows = spark.createDataFrame([(1, "GGGG" + ADAPTER[:10] + ADAPTER[11:]), (2, None), (3, "")], "k int, seq string")
    got = {r.k: r.n for r in rows.select("k", edit_tail_udf(ADAPTER, 0.15, 3)("seq").alias("n")).collect()}
    assert got == {1: 4, 2: 0, 3: 0}
    assert trim.adapter_tail(ADAPTER, edits=True).cut is not None and trim.adapter_tail(edits=True).cut is None
