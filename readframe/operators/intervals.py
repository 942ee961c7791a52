"""Genome intervals: bins, overlap joins, depth and islands.

Intervals are 0-based and half open, in columns ``start0`` and ``end0`` of one ``chrom_id``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from readframe.operators.running import next_position, running_sum, running_sum_and_next
from readframe.operators.scale import BROADCAST_ROWS, SALTS, by_shuffle, fits, salt_of

# Fixed values of the read bins.
BIN_SIZE = 320_000
BIN_OFFSET = 64_000
BIN_STEP = BIN_SIZE - BIN_OFFSET
MIN_READS_IN_BIN = 50
CHROMOSOME_PATTERN = "^chr[0-9XY]+"

OVERLAP_WIDTH = 16_384


def main_chromosomes(chroms: DataFrame) -> DataFrame:
    """P5: dictionary rows whose name starts like a numbered or sex chromosome."""
    return chroms.filter(F.col("chrom").rlike(CHROMOSOME_PATTERN))


def add_chromosome_name(df: DataFrame, chroms: DataFrame, how: str = "inner") -> DataFrame:
    """Name of ``chrom_id``; as an inner join it is also the chromosome filter."""
    from readframe.operators.scale import dimension_join

    return dimension_join(df, chroms.select("chrom_id", "chrom"), ["chrom_id"], how)


def bins_of(start0="start0", end0="end0", tiling: bool = True):
    """Numbers of the bins a read falls into, as an array.

    The end is not reduced by one: a read that ends on a boundary is also in the next bin.
    """
    start0, end0 = (F.col(c) if isinstance(c, str) else c for c in (start0, end0))
    if tiling:
        first = F.floor(F.greatest(start0 - BIN_OFFSET, F.lit(0)) / BIN_STEP)
        last = F.floor(end0 / BIN_STEP)
    else:
        first = F.floor(start0 / BIN_SIZE)
        last = F.floor(end0 / BIN_SIZE)
    return F.sequence(first, last)


def bin_reads(alignments: DataFrame, tiling: bool = True) -> DataFrame:
    """One row per read and bin."""
    return alignments.withColumn("bin", F.explode(bins_of(tiling=tiling)))


def pair_by_parity(alignments: DataFrame, keys: Sequence[str], ordinal: str = "ordinal", numbered: bool = False) -> DataFrame:
    """Records 2i and 2i+1 of a file are mates.

    ``(keys, pair, m1, m2)`` where ``m2`` is NULL for the odd last record. With ``numbered`` the column
    ``pair`` is there already; rows that are dealt by it are not shuffled again.
    """
    rest = [c for c in alignments.columns if c not in keys and not (numbered and c == "pair")]
    mate = F.struct(*rest)
    return (
        (alignments if numbered else alignments.withColumn("pair", F.expr(f"{ordinal} div 2")))
        .groupBy(*keys, "pair")
        .agg(
            F.first(F.when(F.col(ordinal) % 2 == 0, mate), ignorenulls=True).alias("m1"),
            F.first(F.when(F.col(ordinal) % 2 == 1, mate), ignorenulls=True).alias("m2"),
        )
    )


def bin_pairs(pairs: DataFrame, keys: Sequence[str], tiling: bool = True) -> DataFrame:
    """J4 for mates: both go to every bin of their common span when they share a chromosome.

    Otherwise each is binned alone. One row per mate and bin.
    """
    same = F.col("m1.chrom_id") == F.col("m2.chrom_id")
    joint = F.coalesce(same, F.lit(False))
    mates = F.filter(F.array("m1", "m2"), lambda m: m.isNotNull())
    spans = pairs.select(
        *keys,
        "pair",
        joint.alias("paired"),
        F.explode(mates).alias("_m"),
        F.when(joint, F.least("m1.start0", "m2.start0")).alias("_s"),
        F.when(joint, F.greatest("m1.end0", "m2.end0")).alias("_e"),
    )
    bins = bins_of(F.coalesce("_s", F.col("_m.start0")), F.coalesce("_e", F.col("_m.end0")), tiling)
    return spans.filter("_m.chrom_id is not null").select(
        *keys, "pair", "paired", "_m.*", F.explode(bins).alias("bin")
    )


def reads_per_bin(binned: DataFrame) -> DataFrame:
    """A5: records per bin, counted on the map side; no row lists are built."""
    return binned.groupBy("chrom_id", "bin").agg(F.count("*").alias("n_reads"))


def full_bins(counts: DataFrame, minimum: int = MIN_READS_IN_BIN) -> DataFrame:
    """P10."""
    return counts.filter(F.col("n_reads") >= minimum)


def _with_cells(df: DataFrame, width: int, first: str, cell: str, outer: bool = False) -> DataFrame:
    """One row per cell. With ``outer`` a row without an interval stays, in a cell below zero that
    matches nothing; these cells are spread, so that such rows do not meet in one task."""
    low, high = F.expr(f"start0 div {width}"), F.expr(f"greatest(end0 - 1, start0) div {width}")
    cells = F.when(F.col("start0").isNotNull(), F.sequence(low, high))
    if outer:
        cells = F.coalesce(cells, F.array((-1 - salt_of(df, 1_000_000)).cast("bigint")))
    return df.withColumn(first, low).withColumn(cell, F.explode(cells))


def overlap_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str] = ("chrom_id",),
    how: str = "inner",
    condition=None,
    width: int = OVERLAP_WIDTH,
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """All pairs of overlapping intervals, as an equi join on genome cells.

    Both sides are cut into cells of ``width`` bases and joined on the cell. A pair that shares
    several cells is kept in the first one only. The right side (the annotation) keeps its
    columns under ``r_start0``/``r_end0``; its cells are broadcast when counted and few, otherwise
    copied to salt slices so that a cell with a large share of the reads is split. All copies together
    are at most ``salts * max_rows`` rows, or one of each; above that the adaptive skew split alone does it.

    With ``how="left"`` unmatched rows of the left side come once per cell with NULLs on the
    right, to be merged by the caller's aggregation.
    """
    cells = _with_cells(
        right.withColumnsRenamed({"start0": "r_start0", "end0": "r_end0"})
        .withColumns({"start0": F.col("r_start0"), "end0": F.col("r_end0")}),
        width,
        "_r_first",
        "_cell",
    ).drop("start0", "end0")
    reads = _with_cells(left, width, "_l_first", "_cell", outer=how == "left")
    overlap = (
        (F.col("start0") < F.col("r_end0"))
        & (F.col("r_start0") < F.col("end0"))
        & (F.col("_cell") == F.greatest("_l_first", "_r_first"))
    )
    if condition is not None:
        overlap = overlap & condition
    keys = [*on, "_cell"]
    if fits(cells, max_rows):
        keyed, cells = reads, F.broadcast(cells)
    else:
        salts = max(min(salts, salts * max_rows // max(cells.count(), 1)), 1)
        keyed = reads.withColumn("_salt", salt_of(reads, salts))
        cells = cells.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        cells, keys = by_shuffle(cells), [*keys, "_salt"]
    renamed = cells.withColumnsRenamed({key: f"_k_{key}" for key in keys})
    matches = overlap
    for key in keys:
        matches = matches & (F.col(key) == F.col(f"_k_{key}"))
    joined = keyed.join(renamed, matches, how)
    return joined.drop("_l_first", "_r_first", "_cell", "_salt", *[f"_k_{key}" for key in keys])


def overlap_bases():
    """Length of the common part of a joined pair, NULL where an outer join found none."""
    return F.when(F.col("r_start0").isNotNull(), F.least("end0", "r_end0") - F.greatest("start0", "r_start0"))


def _boundaries(intervals: DataFrame, keys: Sequence[str], weights: Sequence[str]) -> DataFrame:
    """Change of each weight at each start and end, merged on the map side."""
    # Both ends of an interval are written as one array, so the input is read once.
    ends = F.array(
        F.struct(F.col("start0").alias("pos"), *[F.col(w).cast("bigint").alias(w) for w in weights]),
        F.struct(F.col("end0").alias("pos"), *[(-F.col(w)).cast("bigint").alias(w) for w in weights]),
    )
    return (
        intervals.filter("start0 < end0")
        .select(*keys, F.inline(ends))
        .groupBy(*keys, "pos")
        .agg(*[F.sum(w).alias(w) for w in weights])
    )


def depth_segments(intervals: DataFrame, keys: Sequence[str], weights: Sequence[str] | None = None) -> DataFrame:
    """Stretches of constant depth. ``(keys, start0, end0, <depth per weight>)``.

    Without ``weights`` each interval counts once, in column ``depth``. Stretches in which
    all depths are zero are left out.
    """
    if weights is None:
        intervals, weights = intervals.withColumn("depth", F.lit(1)), ["depth"]
    changed = " or ".join(f"{w} <> 0" for w in weights)
    events = _boundaries(intervals, keys, weights).filter(changed)
    swept = running_sum_and_next(events, keys, "pos", {f"_before_{w}": w for w in weights}, "_end")
    return swept.select(
        *keys,
        F.col("pos").alias("start0"),
        F.col("_end").alias("end0"),
        *[(F.col(w) + F.col(f"_before_{w}")).alias(w) for w in weights],
    ).filter(changed)


def islands(intervals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Merged intervals (overlapping or touching), ``(keys, start0, end0)``."""
    events = _boundaries(intervals.withColumn("_w", F.lit(1)), keys, ["_w"]).filter("_w <> 0")
    summed = running_sum(events, keys, "pos", {"_before": "_w"}, levels=1)
    # Depth leaves zero and returns to zero in turn, so the next edge closes the island.
    edges = summed.filter("_before = 0 or _before + _w = 0")
    return (
        next_position(edges, keys, "pos", "_end")
        .filter("_before = 0")
        .select(*keys, F.col("pos").alias("start0"), F.col("_end").alias("end0"))
    )


def merged_features(features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """W5 for keys of few rows each, as the exons of one gene: a window per key.

    The same rows as :func:`islands`, which is the way for keys of any size, null keys included.
    """
    order = Window.partitionBy(*keys).orderBy("start0", "end0")
    seen = F.max("end0").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opened = features.filter("start0 < end0").withColumn(
        "_new", F.when(seen.isNull() | (F.col("start0") > seen), 1).otherwise(0)
    )
    numbered = opened.withColumn("_island", F.sum("_new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*keys, "_island").agg(
        F.min("start0").alias("start0"), F.max("end0").alias("end0")
    ).drop("_island")
