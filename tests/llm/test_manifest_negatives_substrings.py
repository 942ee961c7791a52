"""Merkle manifest, hard negatives and substring dedup: brute force, edge cases, and the parts of their methods."""

import hashlib
import math
import random

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from readframe.llm import merkle, negatives, substrings

LONG = " ".join(random.Random(7).choice(["alpha", "beta", "gamma", "delta"]) for _ in range(30_000))


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves):
    """(root, for each leaf its siblings in order)."""
    proofs, places, nodes = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(nodes) > 1:
        for i, at in enumerate(places):
            if at ^ 1 < len(nodes):
                proofs[i].append(nodes[at ^ 1])
            places[i] = at // 2
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
    return nodes[0], proofs


def brute_manifest(rows):
    """{(part, id): (leaf, subroot, root, siblings)} of rows (id, part, text)."""
    enc = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    parts = {}
    for i, part, text in rows:
        parts.setdefault(part, []).append((i, h(enc(i), enc(part), enc(text))))
    names = sorted(parts, key=lambda p: (p is not None, (p or "").encode()))
    trees = []
    for p in names:
        own = sorted(parts[p], key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees.append((own, *brute_tree([leaf for _, leaf in own])))
    root, above = brute_tree([t[1] for t in trees])
    out = {}
    for p, (own, subroot, proofs), up in zip(names, trees, above):
        for (i, leaf), proof in zip(own, proofs):
            out[p, i] = (leaf, subroot, root, proof + up)
    return out


@pytest.mark.parametrize("stride", [1, 2, 3, 6])
def test_manifest_is_the_plain_tree(spark, stride):
    rows = [(i, None if i % 9 == 0 else "" if i % 9 == 1 else f"p{i % 3}", None if i % 11 == 0 else f"té {i}") for i in range(150)]
    rows += [(500, "alone", "x"), (501, "pair", "y"), (502, "pair", LONG)]
    docs = spark.createDataFrame(rows, "id bigint, tree string, text string")  # ``tree`` is a name of the operator's own
    fields = [F.col(c) for c in ("id", "tree", "text")]
    found = merkle.manifest(docs, fields, F.col("tree"), F.col("id"), {"part": F.col("tree")}, stride=stride)
    found = found.withColumn("folded", merkle.fold(F.col("leaf"), F.col("steps"))).withColumn("proof", merkle.proof_digest(F.col("steps"))).collect()
    want = brute_manifest(rows)
    assert len(found) == len(rows)
    for r in found:
        leaf, subroot, root, siblings = want[r.part, r.id]
        assert (r.leaf, r.subroot, r.root, r.proof, r.folded) == (leaf, subroot, root, h(*siblings), root)


def test_manifest_edges(spark):
    docs = spark.createDataFrame([(None, None), (None, "a"), (3, "b"), (3, "b"), (3, "c")], "id bigint, text string")
    fields, part = [F.col("id"), F.col("text")], F.lit(None).cast("string")
    found = merkle.manifest(docs, fields, part, F.col("id")).withColumn("folded", merkle.fold(F.col("leaf"), F.col("steps"))).collect()
    assert len(found) == 5 and all(r.folded == r.root == r.subroot for r in found)
    assert len({r.leaf for r in found}) == 4  # repeated rows are leaves of their own, alike
    assert merkle.manifest(docs.filter("false"), fields, part, F.col("id")).count() == 0
    one = merkle.manifest(docs.filter("text = 'c'"), fields, part, F.col("id")).first()
    assert one.leaf == one.subroot == one.root and list(one.steps) == []


def test_manifest_tells_tampering(spark):
    docs = spark.range(100).withColumn("text", F.concat(F.lit("t"), "id"))
    changed = merkle.digest(F.col("id"), F.when(F.col("id") == 41, "other").otherwise(F.col("text")))
    found = merkle.manifest(docs, [F.col("id"), F.col("text")], F.col("id") % 3, F.col("id"), {"changed": changed})
    bad = found.filter(merkle.fold(F.col("changed"), F.col("steps")) != F.col("root")).collect()
    assert [r.id for r in bad] == [41]


def test_only_every_few_levels_are_written(spark):
    leaves = spark.range(5_000).select(F.lit("=a").alias("tree"), "id", F.unhex(F.sha2(F.col("id").cast("string"), 256)).alias("digest"), F.struct("id").alias("own"))
    trees = merkle.build(leaves, ["id"], stride=4)
    assert [level.agg(F.sum(F.size("digests"))).first()[0] for level in trees.levels] == [5_000, 313, 20, 2]


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 5), st.integers(1, 9), st.integers(1, 40), st.sampled_from([0, 200, 40_000, 2**29]), st.integers(0, 2**32))
def test_packed_products_are_exact(dims, anchors, candidates, reach, seed):
    rng = np.random.default_rng(seed)
    a, c = (rng.integers(-reach, reach + 1, (n, dims)) for n in (anchors, candidates))
    low, high = (int(f(np.concatenate([a.ravel(), c.ravel(), [0]]))) for f in (np.min, np.max))
    want = [[sum(int(x) * int(y) for x, y in zip(i, j)) for j in c] for i in a]
    assert negatives.Packed(c, low, high).scores(a).tolist() == want


def brute_negatives(rows, scale=256, every=100):
    vectors = []
    for i, vector, label in rows:
        if None in (i, vector, label) or any(x is None or not math.isfinite(x) for x in vector):
            continue
        vectors.append((i, label, tuple(math.floor(scale * x) for x in vector)))
    out = []
    for i, label, v in vectors:
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, other) for j, other, w in vectors if j != i)
        for score, j, _ in [s for s in scored if s[2] == label][:5]:
            near = [(n, -s) for s, n, other in scored if other != label and 30 * -score <= 100 * -s <= 90 * -score][:10]
            out += [(i, j, rank, n, -score, s) for rank, (n, s) in enumerate(near, 1)]
    return sorted(out)


def test_negatives_brute_force_and_edges(spark):
    rng = random.Random(3)
    vector = lambda: [rng.choice([-0.5, 0.1, 0.25, 0.9]) for _ in range(6)]  # noqa: E731  many ties
    rows = [(i, vector(), i % 3) for i in range(400)]
    rows += [(1000, None, 1), (1001, vector(), None), (1002, [None] * 6, 1), (1100, [math.nan] * 6, 1), (1200, [math.inf] * 6, 2), (None, vector(), 1)]
    table = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id bigint, embedding array<float>, label int, lot int, positives string")
    rows = [(i, [float(np.float32(x)) if x is not None else None for x in v] if v else v, label) for i, v, label in rows]
    names = ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    want = brute_negatives(rows)
    for shard, lot in ((4096, 4096), (37, 2)):
        found = negatives.mine(table.unionAll(table.limit(50)), "vec_id % 100 = 0", shard=shard, lot=lot)
        assert tuple(found.columns) == names and sorted(map(tuple, found.collect())) == want
    assert negatives.mine(table.filter("false"), "vec_id % 100 = 0").count() == 0
    assert negatives.mine(table.filter("label = 1"), "vec_id % 100 = 0").count() == 0
    assert negatives.mine(table, "vec_id < 0").count() == 0
    with pytest.raises(ValueError):
        negatives.mine(spark.createDataFrame([(0, [1e30], 1)], "vec_id bigint, embedding array<float>, label int"), "true")


def brute_dedup(texts, window):
    words = [(t or "").encode().split() for t in texts]
    places = {}
    for w in words:
        for i in range(len(w) - window + 1):
            places[tuple(w[i : i + window])] = places.get(tuple(w[i : i + window]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if places[tuple(w[i : i + window])] > 1:
                gone |= set(range(i, i + window))
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=60), st.integers(1, 9))
def test_deep_nodes_of_the_tree(ids, depth):
    ids = np.array(ids, dtype=np.int64)
    windows = [tuple(ids[i : i + depth]) for i in range(len(ids) - depth + 1)]
    got = substrings.repeated(ids, depth)[: max(len(windows), 0)].tolist()
    assert got == [windows.count(w) > 1 for w in windows]


def test_dedup_brute_force_and_edges(spark):
    rng = random.Random(11)
    passage = [" ".join(rng.choice("abcdefgh") for _ in range(60)) for _ in range(3)]
    noise = lambda n: " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    texts = [None, "", " \n\t ", "one", noise(34), noise(35), "same " * 200, "x y " + noise(50), LONG]
    texts += [noise(rng.randrange(80)) + " " + rng.choice(passage) + "\n" + noise(rng.randrange(80)) for _ in range(40)]
    texts += [texts[5], texts[12], texts[12], texts[13] + " more", "é 日本 " + passage[0].upper(), "Word\x0bother\x1cpart " * 30]
    rows = [(i if i % 6 else None if i % 12 else 12, t, i, "m") for i, t in enumerate(texts)]  # null and repeated ids
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, k1 bigint, marks string")
    want = sorted(((r[0] is not None, r[0], *w) for r, w in zip(rows, brute_dedup(texts, 35))), key=str)
    for group_bytes, crowded in ((8_000_000, 6_000), (3_000, 6_000), (3_000, 1)):
        found = substrings.dedup(docs, group_bytes=group_bytes, crowded=crowded).collect()
        got = sorted(((r.doc_id is not None, r.doc_id, r.n_words, r.n_removed, r.kept) for r in found), key=str)
        assert got == want
        for r in found:
            assert sum(s.end - s.begin for s in r.spans) == r.n_removed
    assert substrings.dedup(docs.filter("false")).count() == 0


def test_dedup_other_windows(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(40))) for _ in range(30)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    for window, anchor in ((12, 12), (9, 3), (5, 1)):
        found = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.dedup(docs, window, anchor).collect()}
        assert [found[i] for i in range(len(texts))] == brute_dedup(texts, window)
