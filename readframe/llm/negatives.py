"""Hard-negative mining by exact integer products of many vectors at once (Kronecker packing).

Candidates lie side by side in wide integers: each component is biased to be non-negative and takes one field of a
word; a field is wide enough for the largest sum that a product can reach. One multiplication of an anchor's
component with a word then multiplies it with all candidates in that word, sums over components never carry from
field to field, and the biases are taken off the unpacked sums. Fields of up to 32 bits are packed into 64-bit words;
wider ones into Python's unbounded integers, by the same arithmetic.

Anchors and candidates are dealt to a grid of bounded cells, so that neither side is ever whole in a task: cell
``(shard, lot)`` multiplies one shard of candidates with one lot of anchors. First the best same-label rows of each
anchor are found, then, in the score band of each of these, the best rows of other labels. Cells return only their best
rows, and a ranked window over (anchor, positive) merges them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from readframe.llm.common import stored

SCALE = 256
POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
SHARD, LOT = 4_096, 4_096  # candidates and anchors of a cell
SLAB = 64  # anchors multiplied at a time
WIDE_FIELDS = 16  # candidates in an unbounded integer


class Packed:
    """Candidates as columns of words; ``scores`` gives the exact inner products with an anchor slab."""

    def __init__(self, rows: np.ndarray, low: int, high: int) -> None:
        """``rows``: integers between ``low`` and ``high``, one candidate each."""
        n, self.dims = rows.shape
        self.bias, span = -min(low, 0), max(high, 0) - min(low, 0)
        width = max(1, int(max(self.dims, 1) * span * span).bit_length())
        small = width <= 32
        self.width, self.fields = width, 64 // width if small else WIDE_FIELDS
        self.kind = np.uint64 if small else object
        self.n, words = n, -(-n // self.fields)
        biased = np.zeros((words * self.fields, self.dims), dtype=self.kind)
        biased[:n] = (rows + self.bias).astype(self.kind)
        biased = biased.reshape(words, self.fields, self.dims)
        self.words = np.zeros((self.dims, words), dtype=self.kind)
        for field in range(self.fields):
            self.words += biased[:, field].T << self._number(field * width)
        self.sums = rows.astype(object if not small else np.int64).sum(axis=1)

    def _number(self, x: int):
        return np.uint64(x) if self.kind is np.uint64 else x

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """(anchors, candidates) inner products as 64-bit integers."""
        biased = (anchors + self.bias).astype(self.kind)
        total = np.zeros((len(anchors), self.words.shape[1]), dtype=self.kind)
        for d in range(self.dims):
            total += biased[:, d, None] * self.words[d]
        mask, out = self._number((1 << self.width) - 1), np.zeros((len(anchors), total.shape[1], self.fields), dtype=np.int64 if self.kind is np.uint64 else object)
        for field in range(self.fields):
            out[:, :, field] = (total >> self._number(field * self.width)) & mask
        out = out.reshape(len(anchors), -1)[:, : self.n]
        # sum (a + b)(c + b) = sum ac + b (sum a + sum c) + dims b b
        own = anchors.astype(self.sums.dtype).sum(axis=1)
        out = out - self.bias * (own[:, None] + self.sums[None, :]) - self.dims * self.bias * self.bias
        return out.astype(np.int64)


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest allowed scores; ties by place."""
    at = np.flatnonzero(allowed)
    if len(at) > k:
        own = scores[at]
        at = at[own >= np.partition(own, len(at) - k)[len(at) - k]]
    return at[np.argsort(-scores[at], kind="stable")[:k]]


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    column = column.combine_chunks()
    out, lens = np.zeros((len(column), dims), dtype=np.int64), np.diff(column.offsets.to_numpy())
    row = np.repeat(np.arange(len(column)), lens)
    out[row, np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)] = column.flatten().to_numpy()
    return out


def _cell(limits: tuple[int, int, int], found):
    """Runs ``found(scores, anchors, candidates)`` over the slabs of a cell; candidates ascend by id."""
    low, high, dims = limits

    def run(candidates: pa.Table, anchors: pa.Table) -> Iterator[tuple]:
        order = np.lexsort((candidates["label"].to_numpy(), candidates["vec_id"].to_numpy()))
        candidates = candidates.take(pa.array(order))
        packed = Packed(_matrix(candidates["vector"], dims), low, high)
        for begin in range(0, anchors.num_rows, SLAB):
            slab = anchors.slice(begin, SLAB)
            yield from found(packed.scores(_matrix(slab["vector"], dims)), slab, candidates)

    return run


def _positives(k: int):
    def found(scores: np.ndarray, slab: pa.Table, candidates: pa.Table) -> Iterator[tuple]:
        ids, labels = candidates["vec_id"].to_numpy(), candidates["label"].to_numpy()
        for row, (anchor, label) in enumerate(zip(slab["vec_id"].to_pylist(), slab["label"].to_pylist())):
            at = best(scores[row], (labels == label) & (ids != anchor), k)
            yield from zip([anchor] * len(at), [label] * len(at), ids[at].tolist(), scores[row, at].tolist())

    return found


def _negatives(k: int, low: int, high: int):
    def found(scores: np.ndarray, slab: pa.Table, candidates: pa.Table) -> Iterator[tuple]:
        ids, labels = candidates["vec_id"].to_numpy(), candidates["label"].to_numpy()
        given = (slab[c].to_pylist() for c in ("vec_id", "label", "positives"))
        for row, (anchor, label, positives) in enumerate(zip(*given)):
            own, other = scores[row], labels != label
            for number, p in enumerate(positives):
                score = p["score"]
                at = best(own, other & (own >= -(-low * score // 100)) & (own <= high * score // 100), k)
                yield from zip([anchor] * len(at), [label] * len(at), [number] * len(at), ids[at].tolist(), own[at].tolist())

    return found


def _grid(candidates: DataFrame, anchors: DataFrame, shards: int, lots: int, limits, found, schema: str) -> DataFrame:
    """``found`` over every cell: candidates go to each lot of anchors, anchors to each shard of candidates."""
    names = [c.split()[0] for c in schema.split(", ")]
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    rows = candidates.withColumn("shard", F.pmod(F.xxhash64("vec_id", "label"), F.lit(shards)).cast("int")).withColumn("lot", each(lots))
    asked = anchors.withColumn("lot", F.pmod(F.xxhash64("vec_id", "label", F.lit(1)), F.lit(lots)).cast("int")).withColumn("shard", each(shards))
    asked = asked.select(*[F.col(c).alias(c) for c in asked.columns])  # columns of their own: both sides come from one table
    run = _cell(limits, found)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        out = list(run(left, right)) if left.num_rows and right.num_rows else []
        return pa.table({n: pa.array([r[i] for r in out], pa.int64()) for i, n in enumerate(names)})

    keys = ("shard", "lot")
    return rows.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(cell, schema)


def mine(
    rows: DataFrame,
    anchor: str,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    shard: int = SHARD,
    lot: int = LOT,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` is an SQL condition on ``vec_id``. A component becomes ``floor(scale * x)``; a score is the integer
    inner product with the anchor. Each anchor's first ``positives`` other rows of its label are its positives; for
    each, the first ``negatives`` rows of other labels whose score lies within ``low`` to ``high`` per cent of the
    positive's are returned. Higher scores come first, ties by smaller id.

    A row with a null id, label or vector, or with a null or non-finite component takes no part. A shorter vector is
    filled up with zeros. Rows alike in id, label and vector count once; other rows with an equal id each take part, but
    never with an anchor of that id, and of two positives with equal id and score one counts. Scores beyond 64 bits are
    an error. No rows, no anchors or one label give no rows.
    """
    limit = f"floor(CAST(x AS DOUBLE) * {scale})"
    clean = rows.select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.col(label_col).cast("bigint").alias("label"), F.col(vector_col).alias("given")
    ).filter(
        "vec_id IS NOT NULL AND label IS NOT NULL AND given IS NOT NULL AND "
        "forall(given, x -> x IS NOT NULL AND NOT isnan(x) AND abs(CAST(x AS DOUBLE)) < double('inf'))"
    )
    clean = clean.select("vec_id", "label", F.expr(f"transform(given, x -> {limit})").alias("vector")).distinct()
    clean = stored(clean, "vectors")
    told = clean.agg(
        F.count("*"), F.coalesce(F.sum(F.expr(anchor).cast("bigint")), F.lit(0)), F.coalesce(F.max(F.size("vector")), F.lit(0)),
        F.coalesce(F.min(F.array_min("vector")), F.lit(0)), F.coalesce(F.max(F.array_max("vector")), F.lit(0)),
    ).first()
    n, asked, dims, least, most = told
    if dims * max(-least, most) ** 2 >= 1 << 63:
        raise ValueError("scores do not fit into 64 bits")
    shards, lots, limits = max(1, -(-n // shard)), max(1, -(-asked // lot)), (int(least), int(most), dims)
    anchors = clean.filter(anchor)

    first = _grid(
        clean, anchors, shards, lots, limits, _positives(positives), "anchor_id bigint, label bigint, positive_id bigint, positive_score bigint"
    ).distinct()
    ranked = Window.partitionBy("anchor_id", "label").orderBy(F.desc("positive_score"), "positive_id")
    first = first.withColumn("number", F.row_number().over(ranked)).filter(F.col("number") <= positives)
    first = stored(first, "positives")

    given = first.groupBy(F.col("anchor_id").alias("vec_id"), "label").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("number", "positive_id", F.col("positive_score").alias("score")))), lambda p: F.struct(p["score"].alias("score"))
        ).alias("positives")
    )
    cells = _grid(
        clean, anchors.join(given, ["vec_id", "label"]), shards, lots, limits, _negatives(negatives, low, high),
        "anchor_id bigint, label bigint, number bigint, negative_id bigint, negative_score bigint",
    )
    ranked = Window.partitionBy("anchor_id", "label", "number").orderBy(F.desc("negative_score"), "negative_id")
    cells = cells.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= negatives)
    found = cells.join(first.withColumn("number", F.col("number") - 1), ["anchor_id", "label", "number"])
    return found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def oracle() -> str:
    """The query over ``embeddings`` as DuckDB SQL."""
    return f"""
WITH vectors AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * {SCALE}) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.label AS own, c.vec_id, c.label,
    CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM vectors a JOIN vectors c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
negatives AS (SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM positives JOIN scored USING (anchor_id)
  WHERE label <> own AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM negatives WHERE rank <= {NEGATIVES}
"""
