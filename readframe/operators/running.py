"""Running sums and next-position lookups over long axes.

A window over a whole file, sample or chromosome would sort it in one task. Positions are
cut into cells of fixed width instead: a window runs inside each cell, and the cell totals
are summed in the same way one level up. With unique positions no window ever sees more
than ``width`` rows and a head, however much data one key owns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window, functions as F

WIDTH = 65_536


def join_cells(rows: DataFrame, cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` with the columns of ``cells`` (one row per ``keys``); null keys are equal."""
    renamed = cells.withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    return rows.join(renamed, same).drop(*[f"_k_{k}" for k in keys])


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    sums: Mapping[str, str],
    width: int = WIDTH,
    levels: int = 2,
) -> DataFrame:
    """Add, for each ``out: value`` of ``sums``, the sum of ``value`` over smaller ``pos``.

    ``(keys, pos)`` must be unique and ``pos`` a non-negative integer. ``levels`` cell levels
    hold ``width ** levels`` positions before the last, coarsest window.
    """
    if levels == 0:
        order = Window.partitionBy(*keys).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
        return df.select(
            "*", *[F.coalesce(F.sum(value).over(order), F.lit(0)).alias(out) for out, value in sums.items()]
        )
    cell = f"_cell{levels}"
    celled = df.withColumn(cell, F.expr(f"{pos} div {width}"))
    totals = celled.groupBy(*keys, cell).agg(*[F.sum(value).alias(value) for value in dict.fromkeys(sums.values())])
    bases = running_sum(totals, keys, cell, {f"_base_{out}": value for out, value in sums.items()}, width, levels - 1)
    # What comes before a cell is one more row at its head, so the rows are shuffled for the window only and not for a join.
    heads = bases.select(
        *keys, cell, F.lit(-1).cast(df.schema[pos].dataType).alias(pos), *[f"_base_{out}" for out in sums], F.lit(True).alias("_head")
    )
    order = Window.partitionBy(*keys, cell).orderBy(pos).rowsBetween(Window.unboundedPreceding, -1)
    added = celled.unionByName(heads, allowMissingColumns=True).select(
        *df.columns, "_head", *[F.sum(F.coalesce(f"_base_{out}", value)).over(order).alias(out) for out, value in sums.items()]
    )
    return added.filter("_head is null").select(*df.columns, *[F.coalesce(out, F.lit(0)).alias(out) for out in sums])


def running_sum_and_next(
    df: DataFrame, keys: Sequence[str], pos: str, sums: Mapping[str, str], following: str, width: int = WIDTH
) -> DataFrame:
    """:func:`running_sum` and :func:`next_position` in one pass, for axes of bounded length.

    The window over the cells sees one row per cell, that is axis length / ``width`` rows.
    """
    celled = df.withColumn("_cell", F.expr(f"{pos} div {width}"))
    order = Window.partitionBy(*keys, "_cell").orderBy(pos)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    inside = celled.select(
        "*",
        *[F.coalesce(F.sum(value).over(before), F.lit(0)).alias(f"_in_{out}") for out, value in sums.items()],
        F.lead(pos).over(order).alias("_lead"),
    )
    cells = celled.groupBy(*keys, "_cell").agg(
        *[F.sum(value).alias(f"_total_{out}") for out, value in sums.items()], F.min(pos).alias("_first")
    )
    cell_order = Window.partitionBy(*keys).orderBy("_cell")
    earlier = cell_order.rowsBetween(Window.unboundedPreceding, -1)
    bases = cells.select(
        *keys,
        "_cell",
        *[F.coalesce(F.sum(f"_total_{out}").over(earlier), F.lit(0)).alias(f"_base_{out}") for out in sums],
        F.lead("_first").over(cell_order).alias("_after"),
    )
    return join_cells(inside, bases, [*keys, "_cell"]).select(
        *df.columns,
        *[(F.col(f"_in_{out}") + F.col(f"_base_{out}")).alias(out) for out in sums],
        F.coalesce("_lead", "_after").alias(following),
    )


def next_position(df: DataFrame, keys: Sequence[str], pos: str, out: str, width: int = WIDTH) -> DataFrame:
    """Add ``out``: the next larger ``pos`` of the same key, NULL for the last one."""
    celled = df.withColumn("_cell", F.expr(f"{pos} div {width}"))
    inside = celled.withColumn("_next", F.lead(pos).over(Window.partitionBy(*keys, "_cell").orderBy(pos)))
    firsts = celled.groupBy(*keys, "_cell").agg(F.min(pos).alias("_first"))
    following = firsts.select(
        *keys, "_cell", F.lead("_first").over(Window.partitionBy(*keys).orderBy("_cell")).alias("_after")
    )
    return join_cells(inside, following, [*keys, "_cell"]).select(
        *df.columns, F.coalesce("_next", "_after").alias(out)
    )
