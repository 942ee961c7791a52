"""User functions on reads, parts and bins."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

ALIGNERS = ("star", "hisat", "hisat2", "subread")
COUNTERS = ("featurecount", "featurecounts", "htseq", "star")
ASSEMBLERS = ("stringtie", "scallop")
GATHERED_ROWS = 1_000  # rows of small results that are handed over at a time


def pick(value: str, allowed: Sequence[str], what: str) -> str:
    """U4: tool names in any case; an unknown one is an error rather than a silent default."""
    name = value.strip().lower()
    if name not in allowed:
        raise ValueError(f"unknown {what} {value!r}; use one of {tuple(allowed)}")
    return name


def map_reads(
    reads: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str | None = None
) -> DataFrame:
    """``fn`` gets batches of reads and returns their replacement. An exception fails the job."""

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield fn(batch)

    return reads.mapInPandas(run, schema or reads.schema)


def map_parts(
    rows: DataFrame,
    fn: Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: StructType | str,
    keys: Sequence[str] = ("sample", "part_no"),
) -> DataFrame:
    """``fn(key, batches)`` sees one part as a stream of batches.

    Part numbering bounds a part's bytes, and the stream keeps only a batch in memory. Parts are runs of rows in tasks that
    are dealt and sorted by ``keys``, so a small part costs its call and no Arrow stream of its own.
    """
    keys, wanted = list(keys), schema if isinstance(schema, StructType) else StructType.fromDDL(schema)

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _gathered(_per_key(batches, keys, fn), wanted.names)

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def _starts(batch: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Where the rows of a key begin in a sorted batch; nulls are equal."""
    fresh = np.zeros(len(batch), dtype=bool)
    fresh[0] = True
    for key in keys:
        column = batch[key]
        null, values = column.isna().to_numpy(), column.to_numpy()
        same = np.asarray(values[1:] == values[:-1], dtype=bool) & ~null[1:] & ~null[:-1]
        fresh[1:] |= ~(same | (null[1:] & null[:-1]))
    return np.nonzero(fresh)[0]


def _per_key(batches: Iterable[pd.DataFrame], keys: Sequence[str], fn: Callable) -> Iterator[pd.DataFrame]:
    """What ``fn`` makes of each key. Its batches are taken from the stream as it asks for them; what it leaves is passed over."""
    stream = iter(batches)
    todo: list[tuple[bool, tuple, pd.DataFrame]] = []  # runs of the batch at hand, last one first: whether one begins a key, the key, its rows
    last = None

    def fill() -> bool:
        nonlocal last
        while not todo:
            batch = next(stream, None)
            if batch is None:
                return False
            if not len(batch):
                continue
            goes_on = last is not None and len(_starts(pd.concat([last, batch.iloc[:1]]), keys)) == 1
            last, named = batch.iloc[-1:], [batch[key] for key in keys]
            edges = [*_starts(batch, keys).tolist(), len(batch)]
            for begin, end in reversed([*zip(edges, edges[1:])]):
                rows = batch.iloc[begin:end]
                rows.index = pd.RangeIndex(end - begin)
                todo.append((begin > 0 or not goes_on, tuple(column.iloc[begin] for column in named), rows))
        return True

    def own() -> Iterator[pd.DataFrame]:
        begun = False
        while fill() and not (begun and todo[-1][0]):
            begun = True
            yield todo.pop()[2]

    while fill():
        part = own()
        yield from fn(todo[-1][1], part)
        for _ in part:
            pass


def _gathered(frames: Iterable[pd.DataFrame], names: Sequence[str], rows: int = GATHERED_ROWS) -> Iterator[pd.DataFrame]:
    """Small results as fewer, larger ones; a result with other columns than ``names`` is an error."""
    held, held_kinds, size = [], [], 0
    for frame in frames:
        if not len(frame):
            continue
        if len(frame.columns) != len(names):
            raise ValueError(f"a result has the columns {[*frame.columns]}, not {[*names]}")
        if not all(isinstance(c, str) for c in frame.columns):
            frame = frame.set_axis(names, axis=1)
        elif set(frame.columns) != {*names}:
            raise ValueError(f"a result has the columns {[*frame.columns]}, not {[*names]}")
        kinds = [*frame.dtypes]
        # Columns of other types are not put together: numbers would become floats.
        if held and (size >= rows or kinds != held_kinds):
            yield pd.concat(held, ignore_index=True)
            held, size = [], 0
        held.append(frame)
        held_kinds, size = kinds, size + len(frame)
    if held:
        yield pd.concat(held, ignore_index=True)


def map_bins(
    binned: DataFrame,
    fn: Callable[[tuple, Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: StructType | str,
    minimum: int = 0,
    slice_bases: int | None = None,
) -> DataFrame:
    """``fn`` per genome bin, streamed in batches.

    ``slice_bases`` cuts a bin further by read start, for functions that work on any stretch;
    the key is then ``(chrom_id, bin, slice)`` and a deep bin is shared by several tasks.
    """
    from readframe.operators.intervals import full_bins, reads_per_bin
    from readframe.operators.scale import dimension_join

    keys = ["chrom_id", "bin"]
    if minimum:
        binned = dimension_join(binned, full_bins(reads_per_bin(binned), minimum).select(*keys), keys, "left_semi")
    if slice_bases:
        binned = binned.withColumn("slice", F.expr(f"start0 div {slice_bases}"))
        keys.append("slice")
    return map_parts(binned, fn, schema, keys)


PIECE_ROWS = 1_000_000


def map_bins_with(
    binned: DataFrame,
    exons: DataFrame,
    fn: Callable[[tuple, pa.Table, pa.Table], pa.Table],
    schema: StructType | str,
    minimum: int = 0,
    piece_rows: int = PIECE_ROWS,
    tiling: bool = True,
) -> DataFrame:
    """U3 with P6: ``fn(key, reads, exons)`` sees a bin's reads and the reference exons in that bin, as Arrow tables.

    ``key`` is ``(chrom_id, bin, piece)``. Bins are counted first; one of more than ``piece_rows`` reads is dealt, by a hash
    of the read's row, to several pieces, each with all exons of the bin, so no call holds an unbounded bin. A bin
    without reference gets an exon table without rows; a bin without reads, or with fewer than ``minimum``, gets no call.
    Rows without a chromosome belong to no bin. Both sides meet in one shuffle of the reads by bin and piece.
    """
    from readframe.operators.intervals import bins_of, full_bins, reads_per_bin
    from readframe.operators.scale import dimension_join, salt_of
    from readframe.session import settle

    keys = ["chrom_id", "bin"]
    pieces = settle(
        full_bins(reads_per_bin(binned), minimum).select(
            *keys, F.expr(f"cast((n_reads + {piece_rows - 1}) div {piece_rows} as int) as _pieces")
        )
    )
    spread = binned.withColumn("_hash", salt_of(binned, 2**31 - 1))
    reads = (
        dimension_join(spread, pieces, keys)
        .withColumn("piece", F.col("_hash") % F.col("_pieces"))
        .select(*binned.columns, "piece")
    )
    reference = (
        exons.withColumn("bin", F.explode(bins_of(tiling=tiling)))
        .join(pieces, keys)
        .withColumn("piece", F.explode(F.sequence(F.lit(0), F.col("_pieces") - 1)))
        .select(*exons.columns, "bin", "piece")
    )
    keys = [*keys, "piece"]

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        return fn(tuple(part.as_py() for part in key), left, right)

    run.__annotations__ = {"key": tuple, "left": pa.Table, "right": pa.Table, "return": pa.Table}
    return reads.groupBy(*keys).cogroup(reference.groupBy(*keys)).applyInArrow(run, schema)
