"""Exact Jaccard join of word-shingle sets: documents linked at a threshold, as connected components.

1. Every document's set of hashed shingles; equal sets are one node.
2. How many of a set's shingles occur in another document: shingles are dealt by hash to buckets as packed numbers, and
   only counts per document come back. A document with too few shared shingles can link with nothing and is done.
3. The rest share one of their rarest shingles (prefix of the sorted set) with every partner. Components of that
   relation are clusters.
4. Each cluster is one signature tree: leaves are blocks of sets, nodes hold OR-combined bitmaps of the shared
   shingles and size ranges. A traversal of node pairs drops those whose largest possible overlap or sizes rule links
   out, or that already lie in one component, and compares the other leaves bit by bit.
5. A cluster beyond ``TREE_SETS`` sets or ``TREE_SHINGLES`` shingles is cut into several trees. What then may link
   across them - sets of different components that share a rare shingle - is joined and compared one by one.

Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from readframe.llm.common import Numbered, each_piece, fresh, stored, texts_of, words_of

PERCENT, WORDS = 85, 4
BUCKET_SHINGLES = 2_000_000  # occurrences in a bucket, about
TREE_SETS, TREE_SHINGLES = 4_096, 4_000_000
LEAF, FANOUT, MOST_BITS = 32, 8, 16_384
BROADCAST_IDS = 200_000

_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingles(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text; a shorter text is one shingle, one without words none."""
    number, found = Numbered(), []
    for text in texts:
        own = words_of(text.encode())
        found.append(np.fromiter(map(number.__getitem__, own), dtype=np.int64, count=len(own)))
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, number.new), dtype=np.uint64, count=len(number.new))
    out = []
    for ids in found:
        size = min(words, len(ids))
        if not size:
            out.append(np.zeros(0, dtype=np.uint64))
            continue
        h = hashes[ids]
        x = np.full(len(h) - size + 1, size, dtype=np.uint64)
        for k in range(size):
            x = (x ^ h[k : len(h) - size + 1 + k]) * _MIX
            x ^= x >> np.uint64(29)
        out.append(np.unique(x))
    return out


def digest(hashes: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(hashes.tobytes())).view(np.int64)))


def least(n: int, percent: int) -> int:
    """Shingles that a set of n must share with any partner."""
    return -(-percent * n // 100)


def _set_rows(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_piece(batches, "text"):
            sets = shingles(texts_of(batch, "text"), words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.int64()),
                ],
                names=["doc_id", "n", "node"],
            )

    return run


def _dealt(words: int, bits: int):
    """(bucket, part, piece, docs, at, counts, hashes): a piece's shingles of one bucket, in document order, 5 bytes each.

    ``at`` and ``counts`` tell which documents have how many of them: the steps from each such document to the next.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        for piece, batch in enumerate(each_piece(batches, "text")):
            sets = shingles(texts_of(batch, "text"), words)
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            flat = np.concatenate(sets)
            if not len(flat):
                continue
            doc = np.repeat(np.arange(len(sets)), sizes)
            bucket = (flat >> np.uint64(64 - bits)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            flat, doc, bucket = flat[order], doc[order], bucket[order]
            cuts = np.flatnonzero(np.diff(bucket)) + 1
            docs = np.array([digest(s) if len(s) else 0 for s in sets], dtype=np.int64).tobytes() + sizes.tobytes()
            rows = []
            for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(flat)]):
                at, counts = np.unique(doc[begin:end], return_counts=True)
                packed = flat[begin:end].view(np.uint8).reshape(-1, 8)[:, :5].tobytes()
                rows.append((int(bucket[begin]), None if rows else docs, *_sparse(at, counts), packed))
            bucket_of, docs_of, at_of, counts_of, hashes_of = zip(*rows)
            n = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bucket_of, pa.int32()),
                    pa.array([part] * n, pa.int32()),
                    pa.array([piece] * n, pa.int32()),
                    pa.array(docs_of, pa.binary()),
                    pa.array(at_of, pa.binary()),
                    pa.array(counts_of, pa.binary()),
                    pa.array(hashes_of, pa.binary()),
                ],
                names=["bucket", "part", "piece", "docs", "at", "counts", "hashes"],
            )

    return run


def _sparse(at: np.ndarray, counts: np.ndarray) -> tuple[bytes, bytes]:
    return np.diff(at, prepend=0).astype(np.uint32).tobytes(), counts.astype(np.uint32).tobytes()


def _dense(at: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.cumsum(np.frombuffer(at, dtype=np.uint32).astype(np.int64)), np.frombuffer(counts, dtype=np.uint32)


def _unpack(packed: bytes) -> np.ndarray:
    wide = np.zeros((len(packed) // 5, 8), dtype=np.uint8)
    wide[:, :5] = np.frombuffer(packed, dtype=np.uint8).reshape(-1, 5)
    return wide.view(np.uint64).ravel()


def _shared_in_bucket(table: pa.Table) -> pa.Table:
    """Replaces each piece's hashes by the number of each document's that another document has, where it has any."""
    rows = [_unpack(h) for h in table["hashes"].to_pylist()]
    _, inverse, df = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    shared, out, begin = (df >= 2)[inverse], [], 0
    for hashes, at, counts in zip(rows, table["at"].to_pylist(), table["counts"].to_pylist()):
        doc = np.repeat(*_dense(at, counts))
        out.append(_sparse(*np.unique(doc[shared[begin : begin + len(hashes)]], return_counts=True)))
        begin += len(hashes)
    told = table.select(["part", "piece", "docs"])
    for name, column in zip(("at", "counts"), zip(*out)):
        told = told.append_column(name, pa.array(column, pa.binary()))
    return told


def _linkable(percent: int):
    """Nodes of one piece with enough shared shingles."""

    def run(table: pa.Table) -> pa.Table:
        docs = np.frombuffer(next(d for d in table["docs"].to_pylist() if d), dtype=np.int64)
        node, n = docs[: len(docs) // 2], docs[len(docs) // 2 :]
        shared = np.zeros(len(n), dtype=np.int64)
        for packed in zip(table["at"].to_pylist(), table["counts"].to_pylist()):
            at, counts = _dense(*packed)
            shared[at] += counts
        return pa.table({"node": node[(n > 0) & (100 * shared >= percent * n)]})

    return run


def _hash_rows(words: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each_piece(batches, "text"):
            sets = shingles(texts_of(batch, "text"), words)
            kept = [i for i, (s, node) in enumerate(zip(sets, batch.column("node").to_pylist())) if len(s) and digest(s) == node]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("node").take(pa.array(kept, pa.int64())),
                    pa.array([len(sets[i]) for i in kept], pa.int64()),
                    pa.array([sets[i].tobytes() for i in kept], pa.binary()),
                ],
                names=["node", "n", "hashes"],
            )

    return run


def _occurrences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [np.frombuffer(h, dtype=np.int64) for h in batch.column("hashes").to_pylist()]
        if sets:
            node = np.repeat(np.asarray(batch.column("node")), [len(s) for s in sets])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.concatenate(sets))], names=["node", "h"])


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` (its smallest node) of every node of ``edges(a, b)`` with a < b or a > b, by star contraction.

    Minima are taken before joining back, so a node of any degree costs no list of its neighbours.
    """
    pairs = edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).filter("lo < hi").distinct()
    pairs, before = stored(pairs, "edges"), None
    while True:
        print_of = pairs.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(20,0)"))).first()
        if print_of == before:
            return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("component")).union(
                pairs.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
            )
        before = print_of
        both = pairs.select(F.col("lo").alias("u"), F.col("hi").alias("v")).union(pairs.select("hi", "lo"))
        low = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi"))
        large = large.filter("lo < hi").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(low, "hi")
        small = small.select(F.col("m").alias("lo"), F.col("hi")).union(small.select("m", "lo")).filter("lo < hi").distinct()
        pairs = stored(small, "edges")


class Tree:
    """Signature tree over sets of 64-bit hashes; ``links`` gives edges that span the components."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.percent, self.sets = percent, sets
        self.n = np.array([len(s) for s in sets], dtype=np.int64)
        flat = np.concatenate(sets)
        values, place, df = np.unique(flat, return_inverse=True, return_counts=True)
        number = np.cumsum(df >= 2) - 1
        shared = (df >= 2)[place]
        owner = np.repeat(np.arange(len(sets)), self.n)[shared]
        token = number[place[shared]]
        count = int((df >= 2).sum())
        self.exact = count <= MOST_BITS
        width = min(count, MOST_BITS)
        token = token % max(width, 1)
        self.bits = np.zeros((len(sets), width // 64 + 1), dtype=np.uint64)
        np.bitwise_or.at(self.bits, (owner, token // 64), np.uint64(1) << (token % 64).astype(np.uint64))
        self.common = np.bincount(owner, minlength=len(sets))  # shingles that another set here has
        self.own = np.bitwise_count(self.bits).sum(axis=1, dtype=np.int64)
        # Like sets side by side: by their first shared shingles.
        first = np.full((len(sets), 3), 2**62, dtype=np.int64)
        for k, salt in enumerate((1, 0x9E3779B1, 0x85EBCA6B)):
            np.minimum.at(first[:, k], owner, (token * salt) % (2**31 - 1))
        self.order = np.lexsort((self.n, first[:, 2], first[:, 1], first[:, 0]))
        self.parent = list(range(len(sets)))
        self.levels = self._levels()

    def _levels(self) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(bitmaps, smallest size, largest size) of the nodes, from the leaves up."""
        starts = np.arange(0, len(self.order), LEAF)
        n = self.n[self.order]
        level = (
            np.bitwise_or.reduceat(self.bits[self.order], starts, axis=0),
            np.minimum.reduceat(n, starts),
            np.maximum.reduceat(n, starts),
        )
        levels = [level]
        while len(level[1]) > 1:
            starts = np.arange(0, len(level[1]), FANOUT)
            level = tuple(f.reduceat(x, starts, axis=0) for f, x in zip((np.bitwise_or, np.minimum, np.maximum), level))
            levels.append(level)
        return levels

    def find(self, i: int) -> int:
        parent = self.parent
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def _possible(self, depth: int, a: int, b: int) -> bool:
        bits, small, large = self.levels[depth]
        if 100 * large[a] < self.percent * small[b] or 100 * large[b] < self.percent * small[a]:
            return False
        if not self.exact:
            return True  # folded bits count several shingles as one
        overlap = int(np.bitwise_count(bits[a] & bits[b]).sum())
        return (100 + self.percent) * overlap >= self.percent * int(small[a] + small[b])

    def links(self) -> list[tuple[int, int]]:
        edges: list[tuple[int, int]] = []
        top = len(self.levels) - 1
        stack = [(top, 0, 0)]
        while stack:
            depth, a, b = stack.pop()
            if not self._possible(depth, a, b):
                continue
            if depth == 0:
                self._leaves(a, b, edges)
                continue
            below = len(self.levels[depth - 1][1])
            of_a, of_b = (range(x * FANOUT, min((x + 1) * FANOUT, below)) for x in (a, b))
            pairs = [(depth - 1, x, y) for x in of_a for y in of_b if x <= y]
            pairs.sort(key=lambda p: p[1] != p[2], reverse=True)  # a node with itself comes off the stack first
            stack += pairs
        return edges

    def _leaves(self, a: int, b: int, edges: list[tuple[int, int]]) -> None:
        left, right = (self.order[x * LEAF : (x + 1) * LEAF] for x in (a, b))
        roots = [np.array([self.find(i) for i in side.tolist()]) for side in (left, right)]
        if (roots[0] == roots[0][0]).all() and (roots[1] == roots[0][0]).all():
            return
        # A bit of one set that the other lacks is at least one shingle that it lacks; exact if bits are not folded.
        missing = np.bitwise_count(self.bits[left][:, None, :] & ~self.bits[right][None, :, :]).sum(axis=2, dtype=np.int64)
        overlap = self.common[left][:, None] - missing
        total = self.n[left][:, None] + self.n[right][None, :]
        near = ((100 + self.percent) * overlap >= self.percent * total) & (roots[0][:, None] != roots[1][None, :])
        for i, j in np.argwhere(near).tolist():
            x, y = int(left[i]), int(right[j])
            root_x, root_y = self.find(x), self.find(y)
            if root_x != root_y and (self.exact or linked(self.sets[x], self.sets[y], self.percent)):
                self.parent[max(root_x, root_y)] = min(root_x, root_y)
                edges.append((x, y))


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    overlap = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * overlap >= percent * (len(a) + len(b) - overlap)


def _tree_links(percent: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table["node"].to_numpy(), kind="stable")
        nodes = table["node"].to_numpy()[order].tolist()
        packed = table["hashes"].to_pylist()
        sets = [np.frombuffer(packed[i], dtype=np.uint64) for i in order.tolist()]
        edges = Tree(sets, percent).links()
        return pa.table(
            {"a": pa.array([nodes[i] for i, _ in edges], pa.int64()), "b": pa.array([nodes[j] for _, j in edges], pa.int64())}
        )

    return run


def _pair_links(percent: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = ([np.frombuffer(h, dtype=np.uint64) for h in batch.column(c).to_pylist()] for c in ("left", "right"))
            kept = pa.array([linked(x, y, percent) for x, y in zip(*sides)], pa.bool_())
            yield batch.select(["a", "b"]).filter(kept)

    return run


def _rare(sets: DataFrame, percent: int) -> DataFrame:
    """``h, node, n``: the rarest shingles of each set that can still link, as many as every partner must share one of."""
    occurrences = sets.mapInArrow(_occurrences, "node bigint, h bigint")
    df = occurrences.groupBy("h").agg(F.count("*").alias("c")).filter("c >= 2")
    own = occurrences.join(df, "h").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("c", "h"))).alias("own"))
    own = own.join(sets.select("node", "n"), "node").filter(f"100 * size(own) >= {percent} * n")
    alone = F.col("n") - F.size("own")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("bigint") + 1 - alone
    return own.select("node", "n", F.explode(F.slice("own", F.lit(1), prefix.cast("int"))).alias("t")).select("t.h", "node", "n")


def _across(tokens: DataFrame, sets: DataFrame, cut: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Links between sets of different trees of one cluster.

    Of the sets with a rare shingle, those in its largest component need not be compared with one another.
    """
    own = tokens.join(cut, "node").join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    own = stored(own.select("h", "node", "n", "tree", "component"), "tokens")
    largest = own.groupBy("h", "component").agg(F.count("*").alias("c")).groupBy("h").agg(
        F.max_by("component", F.struct("c", "component")).alias("largest"), F.count("*").alias("parts")
    )
    several = own.join(largest.filter("parts > 1"), "h")
    few = several.filter("component <> largest").select("h", *(F.col(c).alias(f"{c}1") for c in ("node", "n", "tree", "component")))
    pairs = few.join(several, "h").filter(
        f"component <> component1 AND tree <> tree1 AND 100 * n >= {percent} * n1 AND 100 * n1 >= {percent} * n"
    )
    pairs = pairs.select(F.least("node", "node1").alias("a"), F.greatest("node", "node1").alias("b")).distinct()
    side = lambda key, name: sets.select(F.col("node").alias(key), F.col("hashes").alias(name))
    return pairs.join(side("a", "left"), "a").join(side("b", "right"), "b").mapInArrow(_pair_links(percent), "a bigint, b bigint")


def join(
    docs: DataFrame,
    percent: int = PERCENT,
    words: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    tree_sets: int = TREE_SETS,
    tree_shingles: int = TREE_SHINGLES,
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row.

    Two texts link when ``100 * intersection >= percent * union`` of their shingle sets. ``component_id`` is the
    smallest id that links lead to, the row's own included. A null text is empty; empty sets link with nothing; rows
    with a null id take no part and have a null component. Repeated rows stay. Ids are whole numbers. Other columns
    are not read.
    """
    source = docs.selectExpr(f"CAST(`{id_col}` AS BIGINT) AS doc_id", f"CAST(`{text_col}` AS STRING) AS text")
    rows = stored(source.mapInArrow(_set_rows(words), "doc_id bigint, n bigint, node bigint"), "sets")
    classes = rows.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("first"))
    bits = max(4, int(((rows.agg(F.sum("n")).first()[0] or 0) // BUCKET_SHINGLES + 1)).bit_length())

    named = source.filter("doc_id IS NOT NULL")
    dealt = named.mapInArrow(
        _dealt(words, bits), "bucket int, part int, piece int, docs binary, at binary, counts binary, hashes binary"
    )
    counted = dealt.groupBy("bucket").applyInArrow(_shared_in_bucket, "part int, piece int, docs binary, at binary, counts binary")
    nodes = counted.groupBy("part", "piece").applyInArrow(_linkable(percent), "node bigint").distinct()
    chosen = stored(nodes.join(classes, "node").select("node", F.col("first").alias("doc_id")), "linkable")
    small = chosen.count() <= BROADCAST_IDS
    texts = named.join(F.broadcast(chosen) if small else chosen, "doc_id").select("node", "text")
    sets = texts.mapInArrow(_hash_rows(words), "node bigint, n bigint, hashes binary").dropDuplicates(["node"])
    sets = stored(sets, "hashes")

    tokens = stored(_rare(sets, percent), "tokens")
    meeting = tokens.groupBy("h").agg(F.min("node").alias("b"), F.count("*").alias("c")).filter("c >= 2").select("h", "b")
    clusters = components(tokens.join(meeting, "h").select(F.col("node").alias("a"), "b").distinct())
    clusters = clusters.join(sets.select("node", "n"), "node")
    sizes = clusters.groupBy("component").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    parts = F.ceil(F.greatest(F.col("sets") / tree_sets, F.col("shingles") / tree_shingles)).cast("bigint")
    placed = clusters.join(sizes.select("component", parts.alias("parts")), "component")
    placed = stored(
        placed.select("node", F.col("component").alias("cluster"), "parts", F.pmod(F.xxhash64("node"), "parts").alias("tree")), "trees"
    )
    trees = placed.join(sets.select("node", "hashes"), "node").groupBy("cluster", "tree")
    links = stored(trees.applyInArrow(_tree_links(percent), "a bigint, b bigint"), "links")
    comps = components(links)
    cut = placed.filter("parts > 1").select("node", "tree")
    if not cut.isEmpty():
        comps = stored(comps, "components")
        comps = components(links.union(_across(tokens, sets, cut, comps, percent)))
    labels = classes.join(comps, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = labels.groupBy("component").agg(F.min("first").alias("component_id"))
    labels = labels.join(lowest, "component").select("node", "component_id")
    named = rows.filter("doc_id IS NOT NULL AND node IS NOT NULL").join(labels, "node").select("doc_id", "n", "component_id")
    others = rows.filter("doc_id IS NULL OR node IS NULL").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return named.union(others).withColumnRenamed("n", "n_shingles")


def keep_first(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, among equal ids with the smallest hash.

    Rows are told apart by id and text, hashed to 64 bits, so of rows with one id only copies of other rows go, and rows
    without an id take part; one of these stays where no copy has an id. Of rows alike in id and text one stays, whatever
    their other columns hold. Rows without words all stay. All columns are kept.
    """
    row = fresh(docs, "_row")
    named = docs.withColumn(row, F.xxhash64(F.col(id_col), F.col(id_col).isNull(), F.col(text_col), F.lit(percent)))
    found = join(named, percent, words, row, text_col).filter("n_shingles > 0")
    ids = named.select(F.col(row).alias("doc_id"), F.col(id_col).alias("id")).groupBy("doc_id").agg(F.min("id").alias("id"), F.count("*").alias("n"))
    found = stored(found.select("doc_id", "component_id").distinct().join(ids, "doc_id"), "rows")
    first = found.groupBy("component_id").agg(F.min_by("doc_id", F.struct(F.col("id").isNull(), "id", "doc_id")).alias("first"))
    gone = found.join(first, "component_id").filter("doc_id <> first").select(F.col("doc_id").alias(row))
    gone = stored(gone, "gone")
    kept = named.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, row, "left_anti")
    again = stored(found.filter("n > 1").select(F.col("doc_id").alias(row)), "again")
    n = again.count()
    if not n:
        return kept.select(docs.columns)
    again = F.broadcast(again) if n <= BROADCAST_IDS else again
    whole = F.struct(*[F.col(c) for c in docs.columns])
    hashed = F.xxhash64(*[F.col(f.name) for f in docs.schema.fields if f.dataType.typeName() not in ("map", "variant")])
    one = kept.join(again, row, "left_semi").groupBy(row).agg(F.min_by(whole, hashed).alias("whole"))
    return kept.join(again, row, "left_anti").select(docs.columns).unionByName(one.select("whole.*"))
