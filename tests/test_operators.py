"""Operators against hand-made cases, brute force and randomised invariants."""

import math
import random
import sys
import tracemalloc
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Row, functions as F

from readframe.operators import compare, counting, hooks, intervals, mapping, qc, reads, running, scale, transcripts, trim

BLOCKS = "array<struct<s:bigint,e:bigint>>"


def hits(spark, data):
    return spark.createDataFrame(
        data, f"sample string, read_id string, mate int, chrom_id int, start0 bigint, end0 bigint, strand string, mapq int, blocks {BLOCKS}"
    )


def exons(spark, data):
    return spark.createDataFrame(data, "gene string, chrom_id int, start0 bigint, end0 bigint, strand string")


def spans(df):
    return sorted((r.start0, r.end0) for r in df.collect())


def test_bins(spark):
    df = spark.createDataFrame([(0, 100), (255990, 256000), (320000, 320100), (319999, 320100)], "start0 bigint, end0 bigint")
    got = {(r.start0, r.end0): r.b for r in df.withColumn("b", intervals.bins_of()).collect()}
    assert got == {(0, 100): [0], (255990, 256000): [0, 1], (320000, 320100): [1], (319999, 320100): [0, 1]}
    df = spark.createDataFrame([(319990, 320000), (319990, 319999)], "start0 bigint, end0 bigint")
    assert [r.b for r in df.withColumn("b", intervals.bins_of(tiling=False)).orderBy("end0").collect()] == [[0], [0, 1]]


def test_bins_brute_force(spark):
    rng = random.Random(4)
    data = [(s, s + rng.randint(1, 400_000)) for s in (rng.randint(0, 2_000_000) for _ in range(200))]
    df = spark.createDataFrame(data, "start0 bigint, end0 bigint").withColumn("b", intervals.bins_of())
    for r in df.collect():
        assert r.b == list(range(max(r.start0 - 64000, 0) // 256000, r.end0 // 256000 + 1))


def test_pair_bins(spark):
    data = [("p", 0, 1, 100, 200), ("p", 1, 1, 330_000, 330_100), ("p", 2, 1, 5, 50), ("p", 3, 2, 330_000, 330_100), ("p", 4, 1, 7, 9)]
    df = spark.createDataFrame(data, "part string, ordinal bigint, chrom_id int, start0 bigint, end0 bigint")
    got = intervals.bin_pairs(intervals.pair_by_parity(df, ["part"]), ["part"], tiling=False).collect()
    assert sorted((r.ordinal, r.bin) for r in got) == [(0, 0), (0, 1), (1, 0), (1, 1), (2, 0), (3, 1), (4, 0)]


@pytest.mark.parametrize("max_rows", [10**6, 0])
def test_overlap_join_brute_force(spark, max_rows):
    rng = random.Random(max_rows)
    a = [(i, rng.randint(0, 1), s, s + rng.randint(1, 300)) for i, s in enumerate(rng.randint(0, 3000) for _ in range(150))]
    b = [(i, rng.randint(0, 1), s, s + rng.randint(1, 900)) for i, s in enumerate(rng.randint(0, 3000) for _ in range(60))]
    left = spark.createDataFrame(a, "i int, chrom_id int, start0 bigint, end0 bigint")
    right = spark.createDataFrame(b, "j int, chrom_id int, start0 bigint, end0 bigint")
    joined = intervals.overlap_join(left, right, width=128, max_rows=max_rows)
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    want = sorted((x[0], y[0]) for x in a for y in b if x[1] == y[1] and x[2] < y[3] and y[2] < x[3])
    assert sorted((r.i, r.j) for r in joined.collect()) == want


def test_islands_and_depth_brute_force(spark):
    rng = random.Random(9)
    data = [(k, s, s + rng.randint(0, 50)) for k in (0, 1) for s in (rng.randint(0, 1500) for _ in range(80))]
    df = spark.createDataFrame(data, "k int, start0 bigint, end0 bigint")
    depth = {}
    for k, s, e in data:
        for p in range(s, e):
            depth[k, p] = depth.get((k, p), 0) + 1
    got = {(r.k, p): r.depth for r in intervals.depth_segments(df, ["k"]).collect() for p in range(r.start0, r.end0)}
    assert got == depth
    small = intervals.merged_features(df, ["k"]).collect()
    large = intervals.islands(df, ["k"]).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, large))
    assert sum(r.end0 - r.start0 for r in small) == len(depth)
    unkeyed = spark.createDataFrame([(None, 5, 9), (None, 8, 12), (1, 1, 2)], df.schema)
    for way in (intervals.merged_features, intervals.islands):
        assert sorted(map(str, way(unkeyed, ["k"]).collect())) == sorted(map(str, [Row(k=None, start0=5, end0=12), Row(k=1, start0=1, end0=2)]))


def test_running_sum_brute_force(spark):
    rng = random.Random(2)
    data = [(k, p, rng.randint(-5, 9)) for k in "ab" for p in rng.sample(range(100_000), 300)]
    df = spark.createDataFrame(data, "k string, p bigint, v bigint")
    summed = running.next_position(running.running_sum(df, ["k"], "p", {"before": "v"}, width=16), ["k"], "p", "after", width=16)
    fused = running.running_sum_and_next(df, ["k"], "p", {"before": "v"}, "after", width=16)
    want = {}
    for k in "ab":
        total, mine = 0, sorted(r for r in data if r[0] == k)
        for i, (_, p, v) in enumerate(mine):
            want[k, p] = (total, mine[i + 1][1] if i + 1 < len(mine) else None)
            total += v
    for table in (summed, fused):
        assert {(r.k, r.p): (r.before, r.after) for r in table.collect()} == want


def test_row_windows_are_never_unpartitioned(spark):
    df = spark.range(10).selectExpr("concat('s', id % 2) AS sample", "id AS ordinal", "id AS row_bytes")
    plan = reads.number_parts(df)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def test_numbered_rows_are_shuffled_once(spark):
    """The bytes before a cell came by a join, for which whole rows were shuffled and sorted again."""
    df = spark.range(50).selectExpr("if(id % 2 = 0, 's', null) AS sample", "id * 40000 AS ordinal", "id AS row_bytes", "struct(id AS a) AS r1")
    numbered = reads.number_parts(df, limit=100)
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    for sample in ("s", None):
        before = 0
        for r in sorted((r for r in numbered.collect() if r.sample == sample), key=lambda r: r.ordinal):
            assert (r.bytes_before, r.part_no, r.r1.a) == (before, before // 100, r.ordinal // 40000)
            before += r.row_bytes
    assert numbered.columns == [*df.columns, "bytes_before", "part_no"]
    assert numbered.count() == 50


def test_skewed_joins(spark):
    facts = spark.range(4000).selectExpr("if(id % 3 = 0, 0, id) AS k", "id AS v")
    lookup = spark.range(4000).selectExpr("id AS k", "id * 10 AS w").filter("k % 2 = 0")
    want = facts.join(lookup, "k", "left").orderBy("v").collect()
    for joined in (
        scale.hot_key_join(facts, lookup, ["k"], "left", hot_rows=100),
        scale.dimension_join(facts, lookup, ["k"], "left"),
        scale.dimension_join(facts, lookup, ["k"], "left", max_rows=10),
    ):
        assert joined.orderBy("v").select("k", "v", "w").collect() == want


def test_tables_counted_too_large_are_never_broadcast(spark):
    """Spark's estimate does not see the rows that an explode adds; it broadcast the copies of all salts."""
    facts = spark.range(100).selectExpr("id AS k", "id AS v", "0 AS chrom_id", "id AS start0", "id + 5 AS end0")
    lookup = spark.range(100).selectExpr("id AS k", "id * 10 AS w")
    exons = spark.range(100).selectExpr("0 AS chrom_id", "id AS start0", "id + 3 AS end0", "id AS gene")
    # Few rows of many cells are a large table too.
    long = spark.range(2).selectExpr("0 AS chrom_id", "id AS start0", "id + 5000 AS end0", "id AS gene")
    for joined in (
        scale.dimension_join(facts, lookup, ["k"], "left", max_rows=10),
        scale.dimension_join(facts, lookup, ["k"], "left_semi", max_rows=10),
        intervals.overlap_join(facts, exons, max_rows=10),
        intervals.overlap_join(facts, exons, how="left", max_rows=10),
        intervals.overlap_join(facts, long, width=10, max_rows=100),
    ):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_repair(spark):
    a = spark.createDataFrame([("s", "a", 0, "1"), ("s", "b", 1, "2"), ("s", "a", 2, "3")], "sample string, key string, ordinal int, seq string")
    b = spark.createDataFrame([("s", "a", 0, "x"), ("s", "c", 1, "y"), ("s", "b", 2, "z")], "sample string, key string, ordinal int, seq string")
    got = reads.repair_pairs(a, b, fields=["seq"]).orderBy("ordinal").collect()
    assert [(r.key, r.r1.seq, r.r2.seq) for r in got] == [("a", "3", "x"), ("b", "2", "z")]


# ---- counting ------------------------------------------------------------------------------


def counts_of(df):
    return {(r.sample, r.feature): r.cnt for r in df.collect()}


def test_feature_counts_rules(spark):
    genes = exons(spark, [("A", 1, 0, 100, "+"), ("A", 1, 50, 120, "+"), ("B", 1, 110, 200, "-")])
    data = [
        ("s", "in_a", 1, 1, 10, 40, "+", 60, None),
        ("s", "both", 1, 1, 100, 130, "+", 60, None),
        ("s", "none", 1, 1, 500, 530, "+", 60, None),
        ("s", "multi", 1, 1, 10, 40, "+", 0, None),
        ("s", "multi", 1, 1, 150, 180, "+", 0, None),
        ("s", "lost", 1, None, None, None, "+", 0, None),
        ("s", "spliced", 1, 1, 90, 520, "+", 60, [(90, 95), (510, 520)]),
    ]
    got = counts_of(counting.feature_counts(hits(spark, data), genes))
    assert got == {
        ("s", "A"): 2, ("s", "unassigned_ambiguity"): 1, ("s", "unassigned_nofeatures"): 1,
        ("s", "unassigned_multimapping"): 2, ("s", "unassigned_unmapped"): 1,
    }
    stranded = counts_of(counting.feature_counts(hits(spark, data), genes, stranded="yes"))
    assert stranded[("s", "A")] == 3 and ("s", "unassigned_ambiguity") not in stranded


def test_pairs_prefer_the_gene_of_both_mates(spark):
    genes = exons(spark, [("A", 1, 0, 300, "+"), ("B", 1, 200, 260, "+")])
    data = [("s", "p", 1, 1, 10, 60, "+", 60, None), ("s", "p", 2, 1, 210, 250, "-", 60, None)]
    assert counts_of(counting.feature_counts(hits(spark, data), genes)) == {("s", "A"): 1}
    assert counts_of(counting.feature_counts(hits(spark, data), genes, stranded="yes")) == {("s", "A"): 1}


def test_htseq_modes(spark):
    genes = exons(spark, [("A", 1, 0, 100, "+"), ("B", 1, 60, 200, "+")])
    data = [("s", "r", 1, 1, 50, 90, "+", 60, None), ("s", "edge", 1, 1, 180, 220, "+", 60, None), ("s", "poor", 1, 1, 0, 9, "+", 3, None)]
    run = lambda mode: counts_of(counting.htseq_counts(hits(spark, data), genes, mode))
    low = {("s", "too_low_aQual"): 1}
    assert run("union") == low | {("s", "ambiguous"): 1, ("s", "B"): 1}
    assert run("intersection-strict") == low | {("s", "A"): 1, ("s", "no_feature"): 1}
    assert run("intersection-nonempty") == low | {("s", "A"): 1, ("s", "B"): 1}
    with pytest.raises(ValueError):
        run("other")


def test_counts_add_up_in_both_join_ways(spark, monkeypatch):
    rng = random.Random(3)
    data = [("s", f"r{rng.randint(0, 150)}", 1, 1, p, p + 40, rng.choice("+-"), 60, None) for p in (rng.randint(0, 4000) for _ in range(200))]
    genes = exons(spark, [(f"g{i}", 1, i * 150, i * 150 + 160, "+") for i in range(25)])
    table = hits(spark, data)
    small = counts_of(counting.feature_counts(table, genes))
    assert sum(small.values()) == 200
    monkeypatch.setattr(intervals, "fits", lambda df, max_rows=0: False)
    assert counts_of(counting.feature_counts(table, genes)) == small


def test_splice_motifs(spark):
    seq = "AA" + "GT" + "CCCC" + "AG" + "TT" + "CT" + "GGGG" + "AC" + "AAAA"
    sequences = spark.createDataFrame([(1, seq)], "chrom_id int, seq string")
    junctions = spark.createDataFrame([(1, 2, 10), (1, 12, 20), (1, 0, 8)], "chrom_id int, intron_s bigint, intron_e bigint")
    got = {r.intron_s: r.motif for r in qc.splice_motifs(junctions, sequences, width=4).collect()}
    assert got == {2: "GT/AG", 12: "GT/AG", 0: "Non-canonical"}


def test_ribosomal_and_ignored(spark):
    blocks = spark.createDataFrame([("s", 1, 0, 100), ("s", 2, 0, 50)], "sample string, chrom_id int, start0 bigint, end0 bigint")
    regions = spark.createDataFrame([(1, 20, 60, "coding")], "chrom_id int, start0 bigint, end0 bigint, base_class string")
    ribosomal = spark.createDataFrame([(1, 50, 70)], "chrom_id int, start0 bigint, end0 bigint")
    row = qc.base_classes(blocks, regions, ribosomal=ribosomal).collect()[0]
    assert (row.ribosomal_bases, row.coding_bases, row.intergenic_bases) == (20, 30, 100)
    assert qc.ignored_reads(blocks, spark.createDataFrame([(2,)], "chrom_id int")).collect()[0].ignored_reads == 1
    table = spark.createDataFrame([("s", "ACG"), ("s", "AC")], "sample string, seq string")
    assert qc.read_bases(table).collect()[0].pf_bases == 5


def test_base_classes_add_up(spark):
    blocks = spark.createDataFrame([("s", 1, 0, 100), ("s", 1, 50, 400)], "sample string, chrom_id int, start0 bigint, end0 bigint")
    regions = spark.createDataFrame([(1, 20, 60, "utr"), (1, 40, 80, "coding"), (1, 0, 300, "intronic")], "chrom_id int, start0 bigint, end0 bigint, base_class string")
    row = qc.base_classes(blocks, regions).collect()[0]
    assert (row.coding_bases, row.utr_bases) == (40 + 30, 20 + 0)
    assert row.coding_bases + row.utr_bases + row.intronic_bases + row.intergenic_bases == row.pf_aligned_bases == 450


# ---- cleaning ------------------------------------------------------------------------------


def pairs(spark, data):
    return spark.createDataFrame(
        data, "sample string, ordinal int, r1 struct<read_id:string,seq:string,plus:string,qual:string>, r2 struct<read_id:string,seq:string,plus:string,qual:string>"
    )


def trimmed(spark, seq, qual, *steps):
    out = trim.trim_pairs(pairs(spark, [("s", 0, ("@a", seq, "+", qual), None)]), steps).collect()[0]
    return out.r1.seq, out.r1.qual


def test_trim_steps(spark):
    assert trimmed(spark, "ACGTAC", "#!I5#\"", trim.leading(3)) == ("GTAC", "I5#\"")
    assert trimmed(spark, "ACGTAC", "#!I5#\"", trim.trailing(3)) == ("ACGT", "#!I5")
    assert trimmed(spark, "ACGTACGT", "IIII####", trim.sliding_window(4, 15)) == ("ACG", "III")
    assert trimmed(spark, "ACG", "###", trim.sliding_window(4, 15)) == ("ACG", "###")
    assert trimmed(spark, "ACGTAC", "IIIIII", trim.trim_left(4)) == ("AC", "II")
    assert trimmed(spark, "ACGTAC", "IIII55", trim.quality_right(25)) == ("ACGT", "IIII")
    adapter = "AGATGTGTATAAGAGACAG"
    assert trimmed(spark, "ACGT" + adapter, "I" * 23, trim.adapter_clip([adapter]))[0] == "ACGT"
    assert trimmed(spark, "ACGTAGATCGGAAG", "I" * 14, trim.adapter_tail(trim.STANDARD_ADAPTER, 0.1, 1))[0] == "ACGT"
    assert trimmed(spark, "ACGTA", "IIIII", trim.adapter_tail(trim.STANDARD_ADAPTER, 0.1, 1))[0] == "ACGT"
    assert trimmed(spark, "ACGTA", "IIIII", trim.adapter_tail())[0] == "ACGTA"
    scores = trim.entropy_scores(["A" * 80, "AC", "ACGTTGCATCAGGTACCATG", ""])
    assert scores[0] == scores[1] == scores[3] == 0 and scores[2] > 80
    long = trim.clip_position_udf(["CTGTCTCTTATACACATCT"]).func(pd.Series(["ACGT" * 12_500, "ACG"]), pd.Series(["I" * 50_000, "III"]))
    assert len(long) == 2


def test_survival_report(spark):
    long, short = ("@a", "A" * 40, "+", "I" * 40), ("@b", "A" * 5, "+", "I" * 5)
    table = pairs(spark, [("s", 0, long, long), ("s", 1, long, short), ("s", 2, short, long), ("s", 3, short, short)])
    steps = [trim.min_length(36)]
    out = trim.trim_pairs(table, steps)
    assert trim.survivors(out).count() == 1
    assert tuple(trim.trim_report(out, steps).drop("step_no", "step").collect()[0]) == ("s", 4, 1, 1, 1, 1)


# ---- mapping, transcripts, accuracy, hooks -------------------------------------------------


def brute_map(read, refs, seed, step, min_votes):
    best = None
    for chrom, seq in refs:
        for strand in "+-":
            bases = read if strand == "+" else read[::-1].translate(str.maketrans("ACGT", "TGCA"))
            for diagonal in range(-len(read), len(seq)):
                votes = sum(
                    diagonal + o >= 0 and seq[diagonal + o : diagonal + o + seed] == bases[o : o + seed]
                    for o in range(0, len(read) - seed + 1, step)
                )
                if votes >= min_votes and (best is None or (-votes, chrom, strand, diagonal) < best):
                    best = (-votes, chrom, strand, diagonal)
    return best and (best[1], best[2], best[3], -best[0])


@pytest.mark.parametrize("hot_places", [0, 3, 10_000])
def test_mapping_brute_force(spark, hot_places):
    rng = random.Random(11)
    unit = "".join(rng.choice("ACGT") for _ in range(60))
    refs = [(i, "".join(rng.choice("ACGT") for _ in range(40)) + unit + "".join(rng.choice("ACGT") for _ in range(30)) + "AC" * 12) for i in range(5)]
    refs += [(9, refs[1][1]), (7, "ACGTACGT" * 15)]
    texts = set()
    for _ in range(40):
        seq = rng.choice(refs)[1]
        at = rng.randint(0, len(seq) - 40)
        read = list(seq[at : at + rng.randint(20, 40)])
        if rng.random() < 0.5:
            read[rng.randrange(len(read))] = rng.choice("ACGT")
        text = "".join(read)
        texts.add(text if rng.random() < 0.5 else text[::-1].translate(str.maketrans("ACGT", "TGCA")))
    reads_df = spark.createDataFrame([(t,) for t in texts], "seq string")
    refs_df = spark.createDataFrame(refs, "chrom_id int, seq string")
    mapped = mapping.map_reads(reads_df, refs_df, seed=8, step=4, min_votes=2, hot_places=hot_places).collect()
    for r in mapped:
        want = brute_map(r.seq, refs, 8, 4, 2)
        assert (want or (None,) * 4) == (r.chrom_id, r.strand, r.diagonal, r.votes), r


def chain_table(spark, data):
    return spark.createDataFrame(data, f"chrom_id int, strand string, chain {BLOCKS}, support bigint, start0 bigint, end0 bigint")


A, B, C, D = (10, 20), (30, 40), (50, 60), (70, 80)


def test_chains(spark):
    table = chain_table(spark, [
        (1, "+", [A, B, C], 3, 0, 90), (1, "+", [B, C], 2, 25, 90), (1, "+", [A, C], 2, 0, 90), (1, "-", [B, C], 2, 25, 90),
        (1, "+", [C, D], 1, 45, 90),
    ])
    kept = transcripts.supported_chains(table)
    assert kept.count() == 4
    left = transcripts.drop_contained(kept).collect()
    assert sorted((r.strand, len(r.chain)) for r in left) == [("+", 2), ("+", 3), ("-", 2)]


def test_tile_copies_count_once(spark):
    reads_df = spark.createDataFrame(
        [(f"r{i}", 1, "+", 0, 100, [A]) for i in (1, 1, 2)] + [("s", 1, "+", 200, 240, []), ("t", 1, "+", 240, 260, [])],
        f"read_id string, chrom_id int, strand string, start0 bigint, end0 bigint, introns {BLOCKS}",
    )
    got = transcripts.transcript_candidates(reads_df).collect()
    assert sorted((r.support, r.start0, r.end0) for r in got) == [(0, 200, 260), (2, 0, 100)]


def test_support_counts_fragments(spark):
    """Two mates over one intron are one fragment; equal ids of two samples are two; the tag gives the strand."""
    rows = [("s", "r1", 1, "+", 0, 100, [A], {"XS": "-"}), ("s", "r1", 1, "-", 5, 120, [A, B], {"XS": "-"}),
            ("t", "r1", 1, "+", 0, 100, [A, B], {"XS": "-"}), ("t", "r9", 1, "+", 300, 500, [(350, 400)], {})]
    schema = (
        f"sample string, read_id string, chrom_id int, strand string, start0 bigint, end0 bigint, introns {BLOCKS}, tags map<string,string>"
    )
    got = transcripts.transcript_candidates(spark.createDataFrame(rows, schema)).collect()
    assert [(r.strand, len(r.chain), r.support, r.start0, r.end0) for r in got] == [("-", 2, 2, 0, 120)]


def test_single_exon_loci_match(spark):
    table = chain_table(spark, [(1, "+", [], 3, 0, 90), (1, "+", [(600, 700)], 2, 500, 900), (2, "-", [], 1, 5, 9)])
    locus = compare.accuracy(table, table).filter("level = 'locus'").first()
    assert (locus.tp, locus.fp, locus.fn) == (3, 0, 0)


def test_mapper_tells_ties(spark):
    rng = random.Random(3)
    one, two = ("".join(rng.choices("ACGT", k=300)) for _ in range(2))
    sequences = spark.createDataFrame([(0, one), (1, two + one[100:180]), (2, "".join(rng.choices("ACGT", k=200)))], "chrom_id int, seq string")
    table = spark.createDataFrame([("u", one[0:60]), ("m", one[110:170]), ("n", "A" * 40)], "read_id string, seq string")
    got = {r.read_id: (r.chrom_id, r.alone) for r in mapping.map_reads(table, sequences).collect()}
    assert got == {"u": (0, True), "m": (0, False), "n": (None, None)}
    tagged = {r.read_id: (r.mapq, r.tags, r.cigar) for r in mapping.as_alignments(mapping.map_reads(table, sequences)).collect()}
    assert tagged["u"][1:] == ({"NH": "1"}, "60M") and tagged["m"][:2] == (0, {"NH": "2"}) and tagged["n"] == (None, None, "*")


def test_merge_and_accuracy(spark):
    candidates = chain_table(spark, [(1, "+", [A, B], 4, 0, 50), (1, "+", [B], 2, 25, 50), (1, "+", [C], 2, 45, 90)])
    reference = chain_table(spark, [(1, "+", [A, B], 0, 0, 50), (1, "+", [A], 0, 0, 25)]).withColumn("tid", F.concat(F.lit("t"), F.size("chain")))
    merged = transcripts.merge_with_reference(candidates, reference)
    assert sorted((len(r.chain), str(r.tid), r.support) for r in merged.collect()) == [
        (1, "None", 2), (1, "t1", 0), (2, "t2", 4)
    ]
    perfect = {r.level: (r.fp, r.fn, r.sensitivity, r.precision) for r in compare.accuracy(reference, reference).collect()}
    assert set(perfect) == set(compare.LEVELS) and all(v == (0, 0, 1.0, 1.0) for v in perfect.values())
    got = {r.level: (r.tp, r.fp, r.fn) for r in compare.accuracy(candidates, reference).collect()}
    assert got["intron"] == (2, 1, 0) and got["intron_chain"] == (1, 2, 1) and got["transcript"] == (1, 2, 1)


def test_hooks(spark):
    import pandas as pd

    df = spark.range(200).selectExpr("'s' AS sample", "cast(id % 3 as int) AS part_no", "id AS v")

    def total(key, batches):
        yield pd.DataFrame({"part_no": [key[1]], "n": [sum(len(b) for b in batches)]})

    got = hooks.map_parts(df, total, "part_no int, n bigint").collect()
    assert sorted((r.part_no, r.n) for r in got) == [(0, 67), (1, 67), (2, 66)]
    binned = spark.range(120).selectExpr("1 AS chrom_id", "id div 100 AS bin", "id AS start0")

    def count(key, batches):
        yield pd.DataFrame({"bin": [key[1]], "n": [sum(len(b) for b in batches)]})

    assert [(r.bin, r.n) for r in hooks.map_bins(binned, count, "bin bigint, n bigint", minimum=50).collect()] == [(0, 100)]
    assert hooks.map_bins(binned, count, "bin bigint, n bigint", slice_bases=10).count() == 12

    def broken(batch):
        raise RuntimeError("script failed")

    with pytest.raises(Exception, match="script failed"):
        hooks.map_reads(df, broken).collect()
    assert hooks.pick("HISAT2", hooks.ALIGNERS, "aligner") == "hisat2"
    with pytest.raises(ValueError):
        hooks.pick("bwa", hooks.ALIGNERS, "aligner")


def test_adapters_are_laid_over_reads_without_a_third_axis():
    """The kernels held reads x offsets x adapter letters at once and took most of a cleaning job's time."""
    adapter = "CTGTCTCTTATACACATCTGACGCTGCCGACGA"
    seqs = ["ACGT" * 25 + adapter[: i % 34] for i in range(600)] + ["", "A"]
    quals = ["I" * len(seq) for seq in seqs]
    for kernel in (
        lambda: trim.clip_positions(seqs, quals, [adapter]),
        lambda: trim.tail_positions(seqs, adapter, 0.15, 3),
    ):
        tracemalloc.start()
        cut = kernel()
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 600 * 133 * len(adapter) * 2
        assert cut[33 + 34] == 100 and list(cut[-2:]) == [0, 1]


def test_complexity_of_reads_of_mixed_length_needs_no_work_read_by_read():
    def plain(seq):
        values = []
        for start in range(0, max(len(seq) - 64, 0) + 1, 32):
            words = [seq[i : i + 3] for i in range(start, min(start + 62, len(seq) - 2))]
            counts, n = Counter(words).values(), len(words)
            values.append((math.log(n) - sum(c * math.log(c) for c in counts) / n) / math.log(min(n, 64)) * 100 if n > 1 else 0.0)
        return sum(values) / len(values)

    rnd = random.Random(5)
    seqs = ["".join(rnd.choice("ACGTN") for _ in range(n)) for n in [0, 1, 2, 3, 4, 63, 64, 65, 95, 96, 97, 128, 300] * 20]
    calls = 0

    def profile(frame, event, arg):
        nonlocal calls
        calls += event == "c_call"

    sys.setprofile(profile)
    try:
        scores = trim.entropy_scores(seqs)
    finally:
        sys.setprofile(None)
    assert np.allclose(scores, [plain(seq) for seq in seqs])
    assert calls < 4 * len(seqs)


def test_a_splice_moves_each_block_of_the_reference_once(spark):
    """Each junction asked for four bases, and the blocks were copied to sixteen salt slices."""
    sequences = spark.createDataFrame([(0, "AAGTCCCCAGAAACTTTTACG")], "chrom_id long, seq string")
    junctions = spark.createDataFrame([(0, 2, 10), (0, 12, 20), (0, 3, 7), (0, 19, 30), (1, 2, 10)], "chrom_id long, intron_s long, intron_e long")
    for width in (3, 4, 5, 64):
        for max_rows in (0, 100):
            found = qc.splice_motifs(junctions, sequences, width=width, max_rows=max_rows)
            got = {(r.chrom_id, r.intron_s): r.motif for r in found.collect()}
            assert got == {(0, 2): "GT/AG", (0, 12): "Non-canonical", (0, 3): "Non-canonical", (0, 19): "Non-canonical", (1, 2): "Non-canonical"}
    plan = qc.splice_motifs(junctions, sequences, max_rows=0)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" not in plan and "SortMergeJoin" in plan
