"""Joins that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from readframe.session import settle

# A dimension table of at most this many rows is broadcast (narrow rows: some tens of MB).
BROADCAST_ROWS = 500_000
SALTS = 16


def fits(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows; reads no more than it must."""
    return df.limit(max_rows + 1).count() <= max_rows


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as the right side of a join that never broadcasts it.

    Spark takes a table's size from the size of its files and knows nothing of the rows that an explode adds, so it
    would hand tables many times its limit to the driver.
    """
    return df.hint("merge")


def salt_of(df: DataFrame, salts: int):
    """A repeatable salt from the row's own values, so retried tasks agree.

    Arrays and structs hash as well; maps do not and are left out.
    """
    columns = [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
    return F.pmod(F.xxhash64(*columns), F.lit(salts)).cast("int")


def dimension_join(
    facts: DataFrame,
    dimension: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join large ``facts`` with a lookup table, whatever the key skew of ``facts``.

    A lookup that was counted and found small is broadcast. A larger one is copied to
    ``salts`` key slices, and the facts are spread over the slices, so that a hot key is
    shared by ``salts`` tasks (and by more after the adaptive skew split).
    """
    if fits(dimension, max_rows):
        return facts.join(F.broadcast(dimension), list(keys), how)
    return salted_join(facts, dimension, keys, how, salts)


def salted_join(
    facts: DataFrame, dimension: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    spread = facts.withColumn("_salt", salt_of(facts, salts))
    copies = dimension.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return spread.join(by_shuffle(copies), [*keys, "_salt"], how).drop("_salt")


# Narrow rows (some ten numbers) that one task groups: some tens of MB as a hash table.
TASK_ROWS = 500_000


def dealt(df: DataFrame, keys: Sequence[str | Column], rows: int = TASK_ROWS) -> DataFrame:
    """``df`` dealt by ``keys``, names or expressions, to tasks of about ``rows`` rows, however large it is.

    The rows are counted first. Groupings by ``keys``, or by these and more, then need no shuffle of their own, and the
    memory of a task does not grow with the table. For keys of few rows each, as the hits of a read.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(df.count() // rows + 1, least), *keys)


HOT_ROWS = 1_000_000


def hot_key_join(
    facts: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Join ``facts`` with a large lookup of unique keys.

    Copying such a lookup to every salt slice would multiply its shuffle. The keys of ``facts``
    are counted first (merged on the map side), and only keys with more than ``hot_rows`` rows
    are spread, over as many slices as they fill. There are at most rows / hot_rows such keys.
    """
    counts = facts.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_rows)
    hot = settle(counts.select(*keys, F.expr(f"cast(_n div {hot_rows} + 1 as int)").alias("_slices")))
    if hot.isEmpty():
        return facts.join(lookup, list(keys), how)
    if not fits(hot):
        return salted_join(facts, lookup, keys, how)
    slices = F.coalesce("_slices", F.lit(1))
    spread = facts.withColumn("_hash", F.abs(salt_of(facts, 2**31 - 1))).join(F.broadcast(hot), list(keys), "left")
    spread = spread.withColumn("_salt", F.col("_hash") % slices).drop("_hash", "_slices")
    copies = (
        lookup.join(F.broadcast(hot), list(keys), "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_slices")
    )
    return spread.join(by_shuffle(copies), [*keys, "_salt"], how).drop("_salt")
