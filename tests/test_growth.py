"""Work that must not be done twice, and tasks that must not grow with the table."""

import pytest
from pyspark.sql import functions as F

from checks import assembly, views
from checks.catalog import QUERIES
from readframe.functions.cigar import cigar_ops
from readframe.operators import compare, intervals, qc, scale, seed_index

SMALL = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_shared_abundance_reads_the_splices_once(spark, monkeypatch):
    calls = []
    splices = views.splices
    monkeypatch.setattr(assembly.v, "splices", lambda *a: calls.append(1) or splices(*a))
    QUERIES["shared_abundance"](spark, SMALL)
    assert len(calls) == 1


def test_features_are_intervals_not_text(spark):
    chains = "chrom_id bigint, strand string, chain array<struct<s:bigint,e:bigint>>, start0 bigint, end0 bigint"
    query = spark.createDataFrame([(1, "+", [(20, 30), (40, 50)], 10, 60), (1, "+", [], 5, 9), (1, "-", [(20, 30)], 10, 60)], chains)
    reference = spark.createDataFrame([(1, "+", [(20, 30), (40, 50)], 0, 60), (1, "+", [], 5, 9)], chains)
    features = compare._features(query)
    assert features.schema["key"].dataType.simpleString() == "array<struct<s:bigint,e:bigint>>"
    got = {r.level: (r.tp, r.fp, r.fn) for r in compare.feature_tallies(query, reference, compare.LEVELS[1:5]).collect()}
    assert got == {"exon": (3, 3, 1), "intron": (2, 1, 0), "intron_chain": (1, 1, 0), "transcript": (1, 2, 1)}


def test_cigar_is_scanned_once(spark):
    df = spark.createDataFrame([("20M100N30M2S",), ("*",), (None,), ("x5M7",), ("99999999999999999999M1=",)], "c string")
    ops = df.select("c", cigar_ops(F.col("c")).alias("ops"))
    assert plan(ops).count("regexp_extract_all") == 1
    got = {r.c: None if r.ops is None else [tuple(o) for o in r.ops] for r in ops.collect()}
    assert got == {"20M100N30M2S": [(20, "M"), (100, "N"), (30, "M"), (2, "S")], "*": [], None: None, "x5M7": [(5, "M")],
                   "99999999999999999999M1=": [(None, "M"), (1, "=")]}


@pytest.mark.parametrize("name", ["pair_bins", "mate_of"])
def test_mates_are_shuffled_once(spark, name):
    assert plan(QUERIES[name](spark, SMALL)).count("Exchange hashpartitioning") == 1


def test_mates_are_shuffled_without_what_the_read_tells(spark):
    """The pair and the end were moved with each hit."""
    (exchange,) = [line for line in plan(QUERIES["pair_bins"](spark, SMALL)).splitlines() if "Exchange hashpartitioning" in line]
    below = plan(QUERIES["pair_bins"](spark, SMALL)).split("Exchange hashpartitioning", 1)[1].splitlines()[1]
    assert exchange and "AS _len" in below and "AS pair" not in below and "AS end0" not in below


def test_a_task_has_as_many_rows_in_a_larger_table(spark):
    sizes = [scale.dealt(spark.range(n), ["id"], rows=1_000).rdd.getNumPartitions() for n in (100, 20_000, 200_000)]
    assert sizes == [8, 21, 201]


def test_pair_summary_groups_on_one_shuffle(spark):
    rows = [("s", 1, 1, 1), ("s", 1, 2, 1), ("s", 2, 1, 1), ("s", 2, 2, 2), ("s", 3, 1, None), ("s", 3, 2, 1), ("s", 4, 1, 3), ("s", 4, 1, 3), ("s", 5, 2, None), ("s", 6, None, 1)]
    df = spark.createDataFrame(rows, "sample string, read_id bigint, mate int, chrom_id int")
    found = qc.pair_summary(df)
    assert plan(found).count("Exchange hashpartitioning(sample#") == 2  # the fragments, then the samples
    r = found.first()
    assert (r.fragments, r.pairs, r.concordant_0, r.concordant_1, r.concordant_more) == (6, 3, 2, 1, 0)
    assert (r.mates_0, r.mates_1, r.mates_more) == (3, 3, 1)


def test_rows_of_seeds_carry_no_bases(spark):
    reads = spark.createDataFrame([("ACGTTGCAAGGTCCATTGACCAGTTACGGATCAT",), ("ACGTTGCAAGGTCCATTGACCAGTTACGGATCAT",), (None,)], "seq string")
    numbered = seed_index.numbered_reads(reads)
    assert numbered.count() == 1
    assert seed_index.read_seeds(numbered).columns == ["read", "strand", "at", "kmer"]


def test_shuffles_of_ended_steps_are_released(spark, monkeypatch):
    """They stayed until the driver happened to collect its garbage."""
    done = []
    monkeypatch.setattr(seed_index, "release", lambda s: done.append(s), raising=False)
    index = spark.createDataFrame([(1, 0, 5, 1)], "kmer bigint, chrom_id bigint, pos bigint, copies bigint")
    seed_index.map_indexed(spark.createDataFrame([("ACGTTGCAAGGTCCATTGACCAGTTACGGATCAT",)], "seq string"), index)
    assert len(done) == 3


def test_copies_of_a_large_annotation_are_bounded(spark, monkeypatch):
    """Sixteen copies of every cell, however many there are, were most of a gene counter's shuffle."""
    reads = spark.createDataFrame([(1, i * 10, i * 10 + 5) for i in range(300)], "chrom_id int, start0 bigint, end0 bigint")
    exons, salts, salt_of = reads.withColumn("gene", F.col("start0")), [], intervals.salt_of
    monkeypatch.setattr(intervals, "salt_of", lambda df, n: salts.append(n) or salt_of(df, n))
    joined = [intervals.overlap_join(reads, exons, width=100, max_rows=n) for n in (1_000, 299, 60, 1)]
    assert salts == [15, 3, 1]
    assert len({str(sorted(map(str, df.collect()))) for df in joined}) == 1
