"""Overlap join by a plane sweep over stretches of the genome (J5 for long intervals and deep places).

Both sides are counted per cell, and a running sum of the counts cuts each chromosome into stretches of about
``stretch_rows`` intervals that begin there. An interval goes to the stretches that it touches, so one of a megabase is
copied as often as there are stretch borders in it, not once a cell. A cell too deep for a stretch is shared by a grid of
pieces: left rows are dealt to some, right rows to others, and each pair of pieces meets once.

A piece is sorted by position and walked in batches. The active lists hold the intervals that the sweep has entered and
not left; a batch meets them by binary search. A pair is given in the stretch in which its later interval begins.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructField, StructType

from readframe.operators.running import running_sum
from readframe.operators.scale import dimension_join, salt_of
from readframe.session import settle

STRETCH_ROWS = 500_000
CELL_BASES = 16_384
PAIRS_AT_ONCE = 200_000


class _Active:
    """Intervals entered by the sweep: starts, ends, whether this is their first stretch, and their rows."""

    def __init__(self, rows: pa.StructArray, start: np.ndarray, end: np.ndarray, home: np.ndarray):
        self.rows, self.start, self.end, self.home = rows, start, end, home

    def take(self, mask: np.ndarray) -> _Active:
        return _Active(self.rows.filter(pa.array(mask)), self.start[mask], self.end[mask], self.home[mask])

    def plus(self, other: _Active) -> _Active:
        joined = (np.concatenate(pair) for pair in zip((self.start, self.end, self.home), (other.start, other.end, other.home)))
        return _Active(pa.concat_arrays([self.rows, other.rows]), *joined)


def _pairs(low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All ``(i, j)`` with ``low[i] <= j < high[i]``, some at a time."""
    counts = np.maximum(high - low, 0)
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    for begin in range(0, total, PAIRS_AT_ONCE):
        place = np.arange(begin, min(begin + PAIRS_AT_ONCE, total))
        i = np.searchsorted(ends, place, "right")
        yield i, low[i] + place - (ends[i] - counts[i])


def _meet(left: _Active, right: _Active, i: np.ndarray, j: np.ndarray, names: Sequence[str]) -> pa.RecordBatch:
    keep = (left.start[i] < right.end[j]) & (right.start[j] < left.end[i]) & (left.home[i] | right.home[j])
    taken = [side.rows.take(pa.array(at[keep])) for side, at in ((left, i), (right, j))]
    return pa.RecordBatch.from_arrays([column for rows in taken for column in rows.flatten()], names=list(names))


def sweep(batches: Iterator[pa.RecordBatch], names: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """Overlapping pairs of one piece, whose rows come sorted by ``_start``."""
    active: list[_Active | None] = [None, None]
    reached = None
    for batch in batches:
        start, end = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("_start", "_end"))
        if not len(start):
            continue
        if (np.diff(start) < 0).any() or (reached is not None and start[0] < reached):
            raise RuntimeError("a sweep needs its rows sorted by start")
        reached = start[-1]
        home = batch.column("_home").to_numpy(zero_copy_only=False).astype(bool)
        on_left = batch.column("_l").is_valid().to_numpy(zero_copy_only=False)
        new = [
            _Active(batch.column(c).filter(pa.array(mask)), start[mask], end[mask], home[mask])
            for c, mask in (("_l", on_left), ("_r", ~on_left))
        ]
        # Intervals that ended before this batch meet none of it.
        old = [side.take(side.end > start[0]) if side is not None else new[k].take(np.zeros(len(new[k].start), bool))
               for k, side in enumerate(active)]
        left, right = (old[k].plus(new[k]) for k in (0, 1))
        # The right interval begins with the left one or after it.
        for i, j in _pairs(np.searchsorted(new[1].start, left.start, "left"), np.searchsorted(new[1].start, left.end, "left")):
            yield _meet(left, new[1], i, j, names)
        # The left one begins later; at the same place too where the right one came with an earlier batch.
        low = np.concatenate([
            np.searchsorted(new[0].start, old[1].start, "left"), np.searchsorted(new[0].start, new[1].start, "right")
        ])
        for j, i in _pairs(low, np.searchsorted(new[0].start, right.end, "left")):
            yield _meet(new[0], right, i, j, names)
        active = [left, right]


def stretches_of(left: DataFrame, right: DataFrame, keys: Sequence[str], stretch_rows: int, cell_bases: int) -> DataFrame:
    """``(keys, _cell, _stretch, _lefts, _rights)`` of every cell in which an interval begins or ends.

    Stretches of a chromosome are numbered without gaps; ``_lefts`` and ``_rights`` are their numbers of pieces.
    """
    def ends(side: DataFrame, name: str) -> DataFrame:
        first, last = F.expr(f"start0 div {cell_bases}"), F.expr(f"greatest(end0 - 1, start0) div {cell_bases}")
        here = F.array(F.struct(first.alias("_cell"), F.lit(1).alias(name)), F.struct(last.alias("_cell"), F.lit(0).alias(name)))
        return side.select(*keys, F.inline(here))

    counts = (
        ends(left, "_nl").unionByName(ends(right, "_nr"), allowMissingColumns=True)
        .groupBy(*keys, "_cell")
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in ("_nl", "_nr")])
        .withColumn("_weight", F.least(F.col("_nl") + F.col("_nr"), F.lit(stretch_rows)))
    )
    numbered = settle(running_sum(counts, keys, "_cell", {"_before": "_weight"}, levels=1).withColumn(
        "_stretch", F.expr(f"_before div {stretch_rows}")
    ))
    pieces = numbered.groupBy(*keys, "_stretch").agg(
        *[
            F.greatest(F.ceil(F.sum(n) / (2 * stretch_rows)), F.lit(1)).cast("int").alias(out)
            for n, out in (("_nl", "_lefts"), ("_nr", "_rights"))
        ]
    )
    return settle(numbered.select(*keys, "_cell", "_stretch").join(pieces, [*keys, "_stretch"]))


def sweep_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] = ("chrom_id",),
    stretch_rows: int = STRETCH_ROWS,
    cell_bases: int = CELL_BASES,
) -> DataFrame:
    """All pairs of overlapping intervals, the rows and columns of an inner :func:`intervals.overlap_join`.

    Positions are not negative. Rows without a key or position overlap nothing, and an interval that ends before it
    begins overlaps what the comparison of its ends says. Repeated rows each count. A table without rows gives none.
    """
    keys = list(on)
    known = " and ".join(f"{c} is not null" for c in (*keys, "start0", "end0"))
    left, right = left.filter(known), right.filter(known)
    cells = stretches_of(left, right, keys, stretch_rows, cell_bases)
    rest = [c for c in right.columns if c not in keys]
    renamed = {c: f"r_{c}" if c in ("start0", "end0") else c for c in rest}

    def placed(side: DataFrame, row, own: str, others: str, hot: str) -> DataFrame:
        """One row per piece in which the interval is needed, ``row`` being its payload."""
        spots = side.select(
            *keys, F.col("start0").cast("bigint").alias("_start"), F.col("end0").cast("bigint").alias("_end"),
            row.alias(hot), F.abs(salt_of(side, 2**31 - 1)).alias("_hash"),
            F.expr(f"start0 div {cell_bases}").alias("_cell"),
            F.expr(f"greatest(end0 - 1, start0) div {cell_bases}").alias("_last"),
        )
        begun = dimension_join(spots, cells.select(*keys, "_cell", F.col("_stretch").alias("_from")), [*keys, "_cell"])
        ended = cells.select(*keys, F.col("_cell").alias("_last"), F.col("_stretch").alias("_to"))
        touched = dimension_join(begun, ended, [*keys, "_last"]).withColumn(
            "_stretch", F.explode(F.sequence("_from", "_to"))
        )
        grid = cells.select(*keys, "_stretch", "_lefts", "_rights").distinct()
        return (
            dimension_join(touched, grid, [*keys, "_stretch"])
            .withColumn(own, (F.col("_hash") % F.col(f"{own}s")).cast("int"))
            .withColumn(others, F.explode(F.sequence(F.lit(0), F.col(f"{others}s") - 1)))
            .select(
                *keys, "_stretch", "_left", "_right", "_start", "_end", (F.col("_from") == F.col("_stretch")).alias("_home"), hot
            )
        )

    lefts = placed(left, F.struct(*left.columns), "_left", "_right", "_l")
    rights = placed(right, F.struct(*[F.col(c).alias(renamed[c]) for c in rest]), "_right", "_left", "_r")
    groups = [*keys, "_stretch", "_left", "_right"]
    # The grouping needs rows sorted by its keys, which this order gives, so it keeps the order by position within.
    walked = (
        lefts.unionByName(rights, allowMissingColumns=True)
        .repartition(*groups)
        .sortWithinPartitions(*groups, "_start")
    )
    fields = [*left.schema.fields, *[StructField(renamed[c], right.schema[c].dataType) for c in rest]]
    schema = StructType([StructField(f"c{n}", f.dataType) for n, f in enumerate(fields)])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from sweep(batches, names)

    run.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return walked.groupBy(*groups).applyInArrow(run, schema).toDF(*[f.name for f in fields])
