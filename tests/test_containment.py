"""Contained chains by fingerprints, and abundance from shared fragments, against plain versions."""

import random

from readframe.operators import transcripts

CHAIN = "id bigint, chrom_id bigint, strand string, chain array<struct<s:bigint,e:bigint>>"


def chain(rng, n):
    cuts = sorted(rng.sample(range(1, 40), 2 * n))
    return [(cuts[2 * i] * 10, cuts[2 * i + 1] * 10) for i in range(n)]


def is_part(a, b):
    return any(b[i : i + len(a)] == a for i in range(len(b) - len(a) + 1))


def test_contained_by_brute_force(spark):
    rng = random.Random(8)
    large = [(i, i % 2, "+" if i % 3 else "-", chain(rng, rng.randrange(1, 8))) for i in range(60)]
    small = []
    for i in range(200):
        _, chrom, strand, own = rng.choice(large)
        first = rng.randrange(len(own))
        small.append((1000 + i, chrom, strand, own[first : first + rng.randrange(1, 5)]))
    small += [(2000, 0, "+", []), (2001, 0, "+", chain(rng, 3)), (2002, 1, "-", [(1, 2)])]
    frames = [spark.createDataFrame(rows, CHAIN) for rows in (small, large)]
    for proper in (False, True):
        found = {tuple(r) for r in transcripts.contained(*frames, proper=proper).collect()}
        assert found == {
            (i, j) for i, c, s, a in small for j, d, t, b in large if a and (c, s) == (d, t) and is_part(a, b) and (not proper or len(a) < len(b))
        }
    assert transcripts.contained(frames[0].filter("false"), frames[1]).count() == 0
    assert transcripts.contained(frames[0], frames[1].filter("false")).count() == 0


def test_long_chains_stay_linear(spark):
    whole = [(i * 100, i * 100 + 50) for i in range(3_000)]
    rows = [("+", whole), ("+", whole[10:2_990]), ("+", whole[5:6]), ("-", whole[5:6]), ("+", whole[2:4] + whole[5:7])]
    table = spark.createDataFrame([(0, *r) for r in rows], "chrom_id bigint, strand string, chain array<struct<s:bigint,e:bigint>>")
    left = transcripts.drop_contained(table).collect()
    assert sorted((r.strand, len(r.chain)) for r in left) == [("+", 4), ("+", 3_000), ("-", 1)]


def test_listing_and_fingerprints_agree(spark):
    rng = random.Random(5)
    base = [chain(rng, 12) for _ in range(4)]
    rows = [(i % 2, "+", own[a : a + n]) for i in range(120) for own in [rng.choice(base)] for a in [rng.randrange(12)] for n in [rng.randrange(1, 12)]]
    rows = [r for i, r in enumerate(rows) if r not in rows[:i]]
    table = spark.createDataFrame(rows, "chrom_id bigint, strand string, chain array<struct<s:bigint,e:bigint>>")
    want = sorted((c, o) for c, _, o in rows if not any(c == d and len(o) < len(p) and is_part(o, p) for d, _, p in rows))
    for listed in (0, 4, 8, 20):
        assert sorted((r.chrom_id, [tuple(i) for i in r.chain]) for r in transcripts.drop_contained(table, listed=listed).collect()) == want


def test_shared_abundance_is_plain_em(spark):
    a, b, c, d = (100, 200), (300, 400), (500, 600), (700, 800)
    table = [(0, "+", [a, b, c], 900), (0, "+", [b, c, d], 700), (0, "+", [a, c], 500), (1, "+", [a, b], 300), (0, "-", [a], 100)]
    seen = [(0, "+", [b, c], 40), (0, "+", [a, b], 10), (0, "+", [c], 25), (0, "+", [a], 5), (0, "+", [d], 3), (1, "+", [a, b], 7), (1, "+", [d], 9)]
    kind = "chrom_id bigint, strand string, chain array<struct<s:bigint,e:bigint>>"
    found = transcripts.shared_abundance(
        spark.createDataFrame(seen, f"{kind}, support bigint"), spark.createDataFrame(table, f"{kind}, length bigint"), steps=6
    ).collect()
    fits = [[t for t, (k, s, own, _) in enumerate(table) if (k, s) == (chrom, strand) and is_part(part, own)] for chrom, strand, part, _ in seen]
    reads = [1.0] * len(table)
    for _ in range(6):
        new = [0.0] * len(table)
        for (*_, n), own in zip(seen, fits):
            total = sum(reads[t] / table[t][3] for t in own)
            for t in own:
                new[t] += n * reads[t] / table[t][3] / total
        reads = new
    got = {(r.chrom_id, r.strand, r.length): r for r in found}
    for t, (chrom, strand, _, length) in enumerate(table):
        r = got[chrom, strand, length]
        assert abs(r.reads - reads[t]) < 1e-9 and abs(r.cov - reads[t] * 100 / length) < 1e-9
    assert abs(sum(r.reads for r in found) - 90) < 1e-9 and abs(sum(r.tpm for r in found) - 1e6) < 1e-6
