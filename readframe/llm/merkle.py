"""Merkle manifest of a dataset: digests of all rows, one tree per part and one over the parts, and inclusion proofs.

Checkpoint and recompute: of a tree only every ``STRIDE``-th level is written, as blocks of up to ``2 ** STRIDE``
neighbouring nodes. A block holds the leaves of one aligned subtree, so a task that has it can make the levels between
by itself: going up, it yields the subtree's top node; going down, it makes the missing levels again, adds each node's
siblings to the path that its top node has to the root, and forgets them. A level has ``1 / 2 ** STRIDE`` of the rows of
the one below, and paths are joined to blocks, not to leaves.

Nodes are numbered by a range sort and a running sum over one row per partition and part; no window sees a whole part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from readframe.llm.common import stored

STRIDE = 6
BROADCAST_SPANS = 100_000  # rows of four numbers and a part's name

# A step of a proof: the side on which the sibling stands and its digest, or ALONE where the node has none.
LEFT, RIGHT, ALONE = b"L", b"R", b"-"


def digest(*fields: Column) -> Column:
    """Lower-case hex sha256 of the fields, one after another: each ``-`` if null, else byte count, ``:``, value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def parent(children: Sequence[bytes]) -> bytes:
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def climb(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The levels over neighbouring nodes: pairs from the left, the last one may be alone."""
    made = [nodes]
    for _ in range(levels):
        made.append([parent(made[-1][i : i + 2]) for i in range(0, len(made[-1]), 2)])
    return made


def height(size: int, stride: int) -> int:
    """Levels to make over a block of a level with ``size`` nodes: up to the next written level or the root."""
    return min(stride, max(size - 1, 0).bit_length())


def numbered(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """``rows`` with ``pos`` and ``size``: their places from 0 in their ``tree``, in ``order``, and the tree's rows.

    Rows that are alike in ``order`` must be alike altogether. ``rows`` should be a written table: it is read twice.
    """
    ranged = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    placed = ranged.withColumn("_row", F.monotonically_increasing_id())
    placed = stored(placed.withColumn("_part", F.shiftright("_row", 33).cast("int")), "numbered")
    spans = placed.groupBy("tree", "_part").agg(F.min("_row").alias("_low"), F.count("*").alias("_n"))
    of_tree = Window.partitionBy("tree")
    before = of_tree.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    spans = stored(
        spans.select(
            "tree", "_part", (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_low")).alias("_shift"),
            F.sum("_n").over(of_tree).alias("size"),
        ), "spans",
    )
    spans = F.broadcast(spans) if spans.count() <= BROADCAST_SPANS else spans
    return placed.join(spans, ["tree", "_part"]).withColumn("pos", F.col("_row") + F.col("_shift")).drop("_row", "_part", "_shift")


def _raise(stride: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, nodes = batch.column("size").to_pylist(), batch.column("digests").to_pylist()
            tops = [climb(own, height(size, stride))[-1][0] for own, size in zip(nodes, sizes)]
            above = [-(-size // 2**stride) for size in sizes]
            yield pa.RecordBatch.from_arrays(
                [batch.column("tree"), batch.column("block"), pa.array(above, pa.int64()), pa.array(tops, pa.binary())],
                names=["tree", "pos", "size", "digest"],
            )

    return run


def siblings(nodes: list[bytes], levels: int) -> list[list[bytes]]:
    """The steps from each node to the top of its block."""
    made, out = climb(nodes, levels), []
    for i in range(len(nodes)):
        steps = []
        for level in range(levels):
            at = i >> level
            if at ^ 1 < len(made[level]):
                steps.append((RIGHT if at % 2 == 0 else LEFT) + made[level][at ^ 1])
            else:
                steps.append(ALONE)
        out.append(steps)
    return out


def _descend(stride: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("tree", "block", "size", "digests", "steps")]
            for row, (tree, block, size, nodes, above) in enumerate(zip(*columns)):
                steps = [own + above for own in siblings(nodes, height(size, stride))]
                own = batch.column("own")
                begin, end = (own.offsets[row + k].as_py() for k in (0, 1))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([tree] * len(nodes), pa.string()),
                        pa.array(range(block << stride, (block << stride) + len(nodes)), pa.int64()),
                        pa.array(nodes, pa.binary()),
                        own.values.slice(begin, end - begin),
                        pa.array(steps, pa.list_(pa.binary())),
                    ],
                    names=["tree", "pos", "digest", "own", "steps"],
                )

    return run


@dataclass
class Trees:
    """Written levels ``0, stride, 2 * stride ...`` of all trees, as blocks, and the tops: ``tree, digest``."""

    levels: list[DataFrame]
    tops: DataFrame
    stride: int

    def proofs(self, above: DataFrame) -> DataFrame:
        """``tree, pos, digest, own, steps`` of every leaf; ``above``: the steps (``tree, steps``) from each tree's top on."""
        top = above.select("tree", F.lit(0).cast("bigint").alias("block"), "steps")
        paths = None
        for level in reversed(self.levels):
            width = 2**self.stride
            last = level.filter(f"size <= {width}").select("tree", "block").join(top, ["tree", "block"])
            known = last if paths is None else last.unionByName(paths)
            kind = level.schema["own"].dataType.elementType.simpleString()
            found = level.join(known, ["tree", "block"]).select("tree", "block", "size", "digests", "own", "steps").mapInArrow(
                _descend(self.stride), f"tree string, pos bigint, digest binary, own {kind}, steps array<binary>"
            )
            paths = None
            if level is not self.levels[0]:
                paths = stored(found.select("tree", F.col("pos").alias("block"), "steps"), "paths")
        return found


def build(leaves: DataFrame, order: Sequence[str], stride: int = STRIDE) -> Trees:
    """The trees over ``leaves(tree, digest, own, *order)``; ``own`` is a struct that travels with the leaf."""
    nodes, levels, tops = numbered(leaves, order), [], []
    while True:
        blocks = nodes.groupBy("tree", F.shiftright("pos", stride).alias("block"), "size").agg(
            F.sort_array(F.collect_list(F.struct("pos", "digest", "own"))).alias("nodes")
        )
        blocks = stored(
            blocks.select("tree", "block", "size", F.col("nodes.digest").alias("digests"), F.col("nodes.own").alias("own")), "level"
        )
        levels.append(blocks)
        most = blocks.agg(F.max("size")).first()[0] or 0
        tops.append(blocks.filter("size = 1").select("tree", F.col("digests")[0].alias("digest")))
        above = blocks.filter("size > 1").select("tree", "block", "size", "digests")
        above = above.mapInArrow(_raise(stride), "tree string, pos bigint, size bigint, digest binary")
        if most <= 2**stride:
            tops.append(above.select("tree", "digest"))
            break
        above = stored(above, "nodes")
        tops.append(above.filter("size = 1").select("tree", "digest"))
        nodes = above.filter("size > 1").withColumn("own", F.struct(F.lit(0).alias("none")))
    union = tops[0]
    for more in tops[1:]:
        union = union.union(more)
    return Trees(levels, stored(union, "tops"), stride)


def manifest(
    docs: DataFrame,
    fields: Sequence[Column],
    part: Column,
    ident: Column,
    carried: dict[str, Column] | None = None,
    stride: int = STRIDE,
) -> DataFrame:
    """``id, leaf, subroot, root, steps`` and the ``carried`` columns of every row of ``docs``; digests are lower-case hex.

    A leaf is ``digest(*fields)``. The leaves of one ``part`` (cast to string; null is a part of its own) ascend by
    ``ident``, a null one first; among equal ids the smaller leaf comes first, and rows that are alike in both may swap
    places. The parts' roots ascend by name in UTF-8 order, null first. A tree of one leaf is that leaf. ``steps`` leads
    from the leaf through its subroot to the root (see ``fold``). No rows give no rows. Long texts are hashed whole;
    columns that are not named are not read.
    """
    carried = carried or {}
    leaves = docs.select(
        # A name with a mark before it: null, as the empty string, comes first and stays apart from the empty name.
        F.coalesce(F.concat(F.lit("="), part.cast("string")), F.lit("")).alias("tree"),
        ident.alias("id"),
        F.unhex(digest(*fields)).alias("digest"),
        F.struct(ident.alias("id"), *[c.alias(name) for name, c in carried.items()]).alias("own"),
    )
    trees = build(stored(leaves, "leaves"), ["id", "digest"], stride)
    parts = trees.tops.select(
        F.lit("").alias("tree"), F.col("tree").alias("part"), "digest", F.struct(F.col("tree").alias("part")).alias("own")
    )
    over = build(parts, ["part"], stride)
    none = F.array().cast("array<binary>")
    top = over.tops.first()  # one digest, none without rows
    root = F.lit(None if top is None else bytes(top["digest"]).hex()).cast("string").alias("root")
    heads = over.proofs(over.tops.select("tree", none.alias("steps")))
    heads = stored(heads.select(F.col("own.part").alias("tree"), F.col("digest").alias("subroot"), "steps"), "heads")
    found = trees.proofs(heads.select("tree", "steps"))
    subroots = heads.select("tree", "subroot")
    subroots = F.broadcast(subroots) if subroots.count() <= BROADCAST_SPANS else subroots
    hexed = lambda c, name: F.lower(F.hex(c)).alias(name)
    return found.join(subroots, "tree").select(
        "own.id", hexed("digest", "leaf"), hexed("subroot", "subroot"), root, "steps", *[f"own.{name}" for name in carried]
    )


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf (hex) leads to by its steps."""

    def step(node: Column, s: Column) -> Column:
        side, other = F.substring(s, 1, 1), F.lower(F.hex(F.substring(s, 2, 32)))
        both = F.when(side == F.lit(LEFT), F.concat(other, node)).when(side == F.lit(RIGHT), F.concat(node, other)).otherwise(node)
        return F.sha2(both, 256)

    return F.aggregate(steps, leaf, step)


def proof_digest(steps: Column) -> Column:
    """sha256 of the siblings of a proof, in order."""
    others = F.transform(F.filter(steps, lambda s: F.length(s) > 1), lambda s: F.lower(F.hex(F.substring(s, 2, 32))))
    return F.sha2(F.array_join(others, ""), 256)


def oracle(fields: Sequence[str], part: str, ident: str, count: str) -> str:
    """The manifest of ``documents`` with proofs and tampered rows as DuckDB SQL."""
    field = lambda x: f"coalesce(concat(strlen(CAST({x} AS VARCHAR)), ':', {x}), '-')"
    told = f"{count} + CASE WHEN bad THEN 1 ELSE 0 END"
    up = "SELECT tree, lvl + 1, pos // 2, sha256(string_agg(d, '' ORDER BY pos)), (n + 1) // 2 FROM {0} WHERE n > 1 GROUP BY tree, lvl, pos // 2, n"
    return f"""
WITH RECURSIVE crc(i, c) AS (SELECT CAST(i AS UBIGINT), CAST(i AS UBIGINT) FROM range(256) t(i)),
steps(i, c, k) AS (SELECT i, c, 0 FROM crc UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8),
codes AS (SELECT list(c ORDER BY i) AS code FROM steps WHERE k = 8),
ids AS (SELECT DISTINCT {ident} AS id, CAST({ident} AS VARCHAR) AS s FROM documents WHERE {ident} IS NOT NULL),
sums AS (SELECT id, xor(list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(s, ''), lambda x: CAST(ascii(x) AS UBIGINT))),
  lambda c, x: xor(code[CAST(xor(c & 255, x) AS BIGINT) + 1], c // 256)), 4294967295) AS crc FROM ids, codes),
marked AS (SELECT d.*, coalesce(crc % 7 = 0, false) AS bad FROM documents d LEFT JOIN sums ON id = {ident}),
leaves AS (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY id NULLS FIRST, d) - 1 AS pos, count(*) OVER (PARTITION BY {part}) AS n
  FROM (SELECT {ident} AS id, {part}, coalesce('=' || {part}, '') AS tree, sha256(concat({", ".join(map(field, fields))})) AS d,
    sha256(concat({", ".join(field(f"({told})") if f == count else field(f) for f in fields)})) AS t FROM marked)),
nodes(tree, lvl, pos, d, n) AS (SELECT tree, 0, pos, d, n FROM leaves UNION ALL {up.format("nodes")}),
tops AS (SELECT tree, d AS subroot, lvl AS high, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
over_(tree, lvl, pos, d, n) AS (SELECT '', 0, pos, subroot, n FROM tops UNION ALL {up.format("over_")}),
walk(id, tree, leaf, step, pos, node, proof, rest) AS (
  SELECT id, tree, d, 0, pos, t, '', n FROM leaves
  UNION ALL
  SELECT w.id, w.tree, w.leaf, step + 1, w.pos // 2,
    sha256(CASE WHEN s.d IS NULL THEN node WHEN w.pos % 2 = 0 THEN node || s.d ELSE s.d || node END), proof || coalesce(s.d, ''), (rest + 1) // 2
  FROM walk w LEFT JOIN nodes s ON s.tree = w.tree AND s.lvl = step AND s.pos = xor(w.pos, 1) WHERE rest > 1),
climb(id, tree, leaf, step, pos, node, proof, rest) AS (
  SELECT id, w.tree, leaf, 0, t.pos, node, proof, t.n FROM walk w JOIN tops t ON w.tree = t.tree WHERE rest = 1
  UNION ALL
  SELECT w.id, w.tree, w.leaf, step + 1, w.pos // 2,
    sha256(CASE WHEN s.d IS NULL THEN node WHEN w.pos % 2 = 0 THEN node || s.d ELSE s.d || node END), proof || coalesce(s.d, ''), (rest + 1) // 2
  FROM climb w LEFT JOIN over_ s ON s.lvl = step AND s.pos = xor(w.pos, 1) WHERE rest > 1)
SELECT c.id AS doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, node AS folded_root, node = root AS verified
FROM climb c JOIN tops USING (tree), (SELECT d AS root FROM over_ WHERE n = 1) r WHERE rest = 1
"""
