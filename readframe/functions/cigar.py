"""CIGAR strings as arrays."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

CIGAR_OP = r"(\d+)([MIDNSHP=X])"
INTERVALS = "array<struct<s:bigint,e:bigint>>"


def cigar_ops(cigar: Column) -> Column:
    """``array<struct<n: bigint, op: string>>``; empty for ``*``."""
    return F.transform(
        F.regexp_extract_all(cigar, F.lit(CIGAR_OP), 0),
        lambda item: F.struct(
            F.left(item, F.length(item) - 1).try_cast("bigint").alias("n"), F.right(item, F.lit(1)).alias("op")
        ),
    )


def aligned_intervals(start0: Column, ops: Column) -> Column:
    """``struct(end0, blocks, introns)``: one pass over the operations.

    Blocks are maximal runs of M/=/X; a deletion or insertion ends a run only where bases of
    the reference are skipped. Introns are the N runs.
    """
    zero = F.struct(
        start0.cast("bigint").alias("at"),
        F.array().cast(INTERVALS).alias("blocks"),
        F.array().cast(INTERVALS).alias("introns"),
    )

    def step(state: Column, item: Column) -> Column:
        at = state["at"]
        after = at + item["n"]
        piece = F.array(F.struct(at.alias("s"), after.alias("e")))
        last = F.try_element_at(state["blocks"], F.lit(-1))
        joined = F.concat(
            F.slice(state["blocks"], F.lit(1), F.greatest(F.size(state["blocks"]) - 1, F.lit(0))),
            F.array(F.struct(last["s"].alias("s"), after.alias("e"))),
        )
        matched = item["op"].isin("M", "=", "X")
        moves = matched | item["op"].isin("D", "N")
        return F.struct(
            F.when(moves, after).otherwise(at).alias("at"),
            F.when(matched & (last["e"] == at), joined)
            .when(matched, F.concat(state["blocks"], piece))
            .otherwise(state["blocks"])
            .alias("blocks"),
            F.when(item["op"] == "N", F.concat(state["introns"], piece)).otherwise(state["introns"]).alias("introns"),
        )

    return F.aggregate(
        ops,
        zero,
        step,
        lambda state: F.struct(
            state["at"].alias("end0"), state["blocks"].alias("blocks"), state["introns"].alias("introns")
        ),
    )
