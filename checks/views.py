"""Input views over the provided tables (FIXTURES.md), as DataFrames.

Each takes ``(spark, sf_dir)``. ``checks/oracle.py`` holds the same views as SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.oracle import BASES, CALLED, LETTERS, QUALITIES
from readframe.operators.scale import dimension_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def counts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "concat('cell', l_suppkey % 8) AS sample",
        "l_linenumber AS part_no",
        "CASE WHEN l_returnflag = 'R' THEN concat('QC_tool_', l_linestatus) "
        "ELSE concat('G', l_partkey % 150) END AS feature",
        "CAST(l_quantity AS BIGINT) AS cnt",
    )


def manifest(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS manifest_line",
        "concat('S', c_custkey, '_1.fastq.gz', "
        "CASE WHEN c_custkey % 3 <> 0 THEN concat('\t', 'S', c_custkey, '_2.fastq.gz') ELSE '' END, "
        "CASE WHEN c_custkey % 50 = 49 THEN '\textra.fastq.gz' ELSE '' END) AS value",
    )


def accessions(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "concat(CASE c_custkey % 3 WHEN 0 THEN 'SRR' WHEN 1 THEN 'ERR' ELSE 'DRR' END, "
        "CASE c_custkey % 4 WHEN 0 THEN 100000 + c_custkey WHEN 1 THEN 1000000 + c_custkey * 613 "
        "WHEN 2 THEN 10000000 + c_custkey * 7919 ELSE 100000000 + c_custkey * 1047 END) AS accession"
    )


def genome(spark, sf_dir) -> DataFrame:
    """Sequences of whole texts: letters and blanks are bases, all else is N."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id AS chrom_id", f"regexp_replace(translate(text, '{LETTERS}', '{BASES}'), '[^ACGT]', 'N') AS seq"
    )


def genome_reads(spark, sf_dir) -> DataFrame:
    """Windows of the sequences, every other one from the other strand and some with an N in the middle."""
    windows = genome(spark, sf_dir).selectExpr("chrom_id", "posexplode(regexp_extract_all(seq, '(.{1,100})', 1)) AS (k, seq)")
    return windows.selectExpr(
        "concat('cell', (chrom_id + k) % 8) AS sample",
        "chrom_id * 10000 + k AS ordinal",
        "CASE WHEN (chrom_id + k) % 2 = 1 THEN reverse(translate(seq, 'ACGT', 'TGCA')) WHEN (chrom_id + k) % 5 = 0 "
        "THEN concat(left(seq, 50), 'N', substring(seq, 52)) ELSE seq END AS seq",
    )


def reads1(spark, sf_dir) -> DataFrame:
    # One regular-expression pass cuts the whole text; windows by position would count from the
    # start of the text each time.
    windows = (
        genome(spark, sf_dir)
        .selectExpr("chrom_id", "posexplode(regexp_extract_all(seq, '(.{1,100})', 1)) AS (k, seq)")
        .selectExpr("chrom_id * 10000 + k AS ordinal", "(chrom_id + k) % 8 AS cell", "seq")
    )
    return windows.selectExpr(
        "concat('cell', cell) AS sample",
        "ordinal",
        "concat('@r', ordinal) AS read_id",
        "concat('k', ordinal % 300) AS dup_key",
        "seq",
        f"translate(seq, '{CALLED}', '{QUALITIES}') AS qual",
    )


def reads2(spark, sf_dir) -> DataFrame:
    return (
        reads1(spark, sf_dir)
        .filter("right(seq, 1) <> 'G'")
        .selectExpr(
            "sample", "ordinal", "read_id", "dup_key",
            "reverse(translate(seq, 'ACGT', 'TGCA')) AS seq", "reverse(qual) AS qual",
        )
    )


def pairs(spark, sf_dir) -> DataFrame:
    """``(sample, ordinal, r1, r2)``; both mates come from the same window, so no join is needed."""
    mate2 = "right(seq, 1) <> 'G'"
    return reads1(spark, sf_dir).selectExpr(
        "sample",
        "ordinal",
        "struct(read_id, seq, '+' AS plus, qual) AS r1",
        f"CASE WHEN {mate2} THEN struct(read_id, reverse(translate(seq, 'ACGT', 'TGCA')) AS seq, '+' AS plus, "
        "reverse(qual) AS qual) END AS r2",
    )


def rows(spark, sf_dir) -> DataFrame:
    return pairs(spark, sf_dir).selectExpr(
        "sample",
        "ordinal",
        "CASE WHEN sample >= 'cell4' THEN concat_ws('\t', r1.read_id, r1.seq, '+', r1.qual) "
        "WHEN ordinal % 11 = 10 THEN concat_ws('\t', r1.read_id, r1.seq, '+', r1.qual, r2.read_id, r2.seq, r2.plus) "
        "ELSE concat_ws('\t', r1.read_id, r1.seq, '+', r1.qual, r2.read_id, r2.seq, r2.plus, r2.qual) END AS value",
    )


ADAPTER = "CTGTCTCTTATACACATCTGACGCTGCCGACGA"


def adapter_reads(spark, sf_dir) -> DataFrame:
    """Mate 1 reads followed by an adapter, as sequencing past a short insert gives them.

    Whole adapters, cut ones and ones with a wrong base, by the length of the read.
    """
    tail = (
        f"CASE length(seq) % 4 WHEN 0 THEN '{ADAPTER}' WHEN 1 THEN substring('{ADAPTER}', 1, 20) "
        f"WHEN 2 THEN concat('CTGACTCTTATACACATCTG', substring('{ADAPTER}', 21, 10)) ELSE 'CTGT' END"
    )
    return (
        reads1(spark, sf_dir)
        .selectExpr("sample", "ordinal", "read_id", f"concat(seq, {tail}) AS seq")
        .withColumn("qual", F.translate("seq", CALLED, QUALITIES))
    )


def align(spark, sf_dir) -> DataFrame:
    """Reads near the gene of their part; the genome grows with the number of parts."""
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS read_id",
        "l_linenumber AS part_no",
        "1 + l_linenumber % 2 AS mate",
        "concat('cell', l_orderkey % 8) AS sample",
        "l_partkey % 10 AS chrom_id",
        "(l_partkey div 10) * 6000 + (l_orderkey * 7919 + l_suppkey * 1299709 + l_linenumber * 611953) % 9000 AS start0",
        "(l_partkey div 10) * 6000 + (l_orderkey * 7919 + l_suppkey * 1299709 + l_linenumber * 611953) % 9000 "
        "+ 50 + CAST(l_quantity AS BIGINT) AS end0",
        "CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand",
        "CAST(round(l_discount * 100) AS BIGINT) * 6 AS mapq",
    )


def pair_align(spark, sf_dir) -> DataFrame:
    """The same hits, taken as mates of fragments."""
    return align(spark, sf_dir).withColumn("read_id", F.expr("(read_id div 8) * 4 + (read_id % 8) div 2"))


def parts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "concat('G', p_partkey) AS gene",
        "p_partkey % 10 AS chrom_id",
        "(p_partkey div 10) * 6000 AS base",
        "400L + p_size * 20 AS len",
        "CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand",
    )


def exons(spark, sf_dir) -> DataFrame:
    return parts(spark, sf_dir).selectExpr(
        "gene", "chrom_id", "strand", "base", "len", "explode(array(0, 1, 2)) AS exon_no"
    ).selectExpr(
        "gene", "chrom_id", "exon_no", "base + exon_no * 3000 AS start0", "base + exon_no * 3000 + len AS end0", "strand"
    )


def introns(spark, sf_dir) -> DataFrame:
    """Reference introns: between consecutive exons of a gene."""
    return parts(spark, sf_dir).selectExpr(
        "gene", "chrom_id", "strand", "base", "len", "explode(array(0, 1)) AS k"
    ).selectExpr(
        "gene", "chrom_id", "strand", "base + k * 3000 + len AS intron_s", "base + (k + 1) * 3000 AS intron_e"
    )


def splices(spark, sf_dir) -> DataFrame:
    """Introns per read: known ones, both of a gene, and skipped exons, some of them shifted."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS read_id",
        "concat('cell', l_orderkey % 8) AS sample",
        "concat('G', l_partkey) AS gene",
        "l_linenumber % 4 AS kind",
        "(l_suppkey % 2) * 10 AS shift",
    )
    spans = (
        "CASE kind WHEN 0 THEN array(named_struct('a', 0, 'b', 1)) WHEN 1 THEN array(named_struct('a', 1, 'b', 2)) "
        "WHEN 2 THEN array(named_struct('a', 0, 'b', 1), named_struct('a', 1, 'b', 2)) "
        "ELSE array(named_struct('a', 0, 'b', 2)) END"
    )
    return (
        dimension_join(lines, parts(spark, sf_dir), ["gene"])
        .selectExpr("read_id", "sample", "gene", "chrom_id", "strand", "base", "len", "kind", "shift", f"inline({spans})")
        .selectExpr(
            "read_id", "sample", "gene", "chrom_id", "strand",
            "base + a * 3000 + len AS intron_s",
            "base + b * 3000 + CASE WHEN kind = 3 THEN shift ELSE 0 END AS intron_e",
        )
    )


def regions(spark, sf_dir) -> DataFrame:
    """Base classes: the first 100 bases of a gene are UTR, other exon bases coding."""
    gene = parts(spark, sf_dir)
    return gene.selectExpr(
        "chrom_id",
        "inline(array("
        "named_struct('start0', base, 'end0', base + 100, 'base_class', 'utr'),"
        "named_struct('start0', base + 100, 'end0', base + len, 'base_class', 'coding'),"
        "named_struct('start0', base + 3000, 'end0', base + 3000 + len, 'base_class', 'coding'),"
        "named_struct('start0', base + 6000, 'end0', base + 6000 + len, 'base_class', 'coding'),"
        "named_struct('start0', base + len, 'end0', base + 3000, 'base_class', 'intronic'),"
        "named_struct('start0', base + 3000 + len, 'end0', base + 6000, 'base_class', 'intronic')))",
    )


CHAIN = "array<struct<s:bigint,e:bigint>>"


def transcripts(spark, sf_dir) -> DataFrame:
    """One reference transcript per gene."""
    return parts(spark, sf_dir).selectExpr(
        "gene AS tid",
        "chrom_id",
        "strand",
        f"CAST(array(named_struct('s', base + len, 'e', base + 3000), "
        f"named_struct('s', base + 3000 + len, 'e', base + 6000)) AS {CHAIN}) AS chain",
        "base AS start0",
        "base + 6000 + len AS end0",
    )


def chromosomes(spark, sf_dir) -> DataFrame:
    """Chromosome dictionary of the alignment views: ids from the parts, some odd names."""
    return (
        parts(spark, sf_dir)
        .groupBy("chrom_id")
        .agg((F.max("base") + 20_000).alias("length"))
        .selectExpr(
            "chrom_id",
            "CASE chrom_id WHEN 7 THEN 'chrX' WHEN 8 THEN 'chrM' WHEN 9 THEN 'chrUn_1' WHEN 6 THEN 'chr1_alt' "
            "ELSE concat('chr', chrom_id + 1) END AS chrom",
            "length",
        )
    )
