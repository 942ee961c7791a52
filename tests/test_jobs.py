"""Jobs from part rows to counts and from alignments to transcripts, on a small made genome."""

import random

import pytest
from pyspark.sql import functions as F

from readframe.operators import intervals, trim
from readframe.plans import jobs
from readframe.sources import annotation

rng = random.Random(5)
GENOME = {f"chr{i + 1}": "".join(rng.choice("ACGT") for _ in range(3000)) for i in range(2)}
GENES = {"G1": ("chr1", 100, 900), "G2": ("chr1", 1500, 2300), "G3": ("chr2", 200, 1200)}
READS = {"G1": 12, "G2": 7, "G3": 20}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    return tmp_path_factory.mktemp("genome")


@pytest.fixture(scope="module")
def reference(spark, folder):
    (folder / "genome.fa").write_text("".join(f">{n} text\n{s[:1700]}\n{s[1700:]}\n" for n, s in GENOME.items()))
    (folder / "genes.gtf").write_text(
        "".join(f'{c}\tx\texon\t{s + 1}\t{e}\t.\t+\t.\tgene_name "{g}";\n' for g, (c, s, e) in GENES.items())
    )
    chroms = spark.createDataFrame([(0, "chr1"), (1, "chr2"), (2, "chrM")], "chrom_id int, chrom string")
    sequences = jobs.load_reference(spark, str(folder / "genome.fa"), chroms)
    exons = annotation.read_gtf(spark, str(folder / "genes.gtf"), chroms=chroms)
    return chroms, sequences, exons


@pytest.fixture(scope="module")
def pairs(spark, folder):
    """Part rows of two samples; the second has each read twice."""
    lines = []
    for gene, n in READS.items():
        chrom, start, end = GENES[gene]
        for i in range(n):
            at = rng.randint(start, end - 60)
            seq = GENOME[chrom][at : at + 60]
            lines.append(f"@{gene}_{i} x\t{seq}\t+\t{'I' * 60}")
    parts = folder / "parts"
    parts.mkdir()
    (parts / "one_part0.fastq").write_text("\n".join(lines) + "\n")
    (parts / "two_part0.fastq").write_text("\n".join(lines[:20]) + "\n")
    (parts / "two_part1.fastq").write_text("\n".join(lines[20:]) + "\n")
    from readframe.sources.parts import read_part_rows

    kept, report = jobs.preprocess(read_part_rows(spark, str(parts)), [trim.leading(3), trim.min_length(36)])
    assert [(r.sample, r.n_in, r.dropped) for r in report.orderBy("sample").collect()] == [("one", 39, 0), ("two", 39, 0)]
    return kept


def test_quantify(spark, reference, pairs):
    _, sequences, exons = reference
    alignments = jobs.align(pairs, sequences, "subread").cache()
    assert alignments.count() == 2 * sum(READS.values())
    for counter, options in (("featureCounts", {}), ("HTSeq", {"stranded": "yes"}), ("STAR", {})):
        got = jobs.quantify(alignments, exons, counter, "STAR", "NONE", **options)
        genes = {(r.sample, r.feature): r.cnt for r in got.filter("kind = 'gene'").collect()}
        assert genes == {(s, g): n for s in ("one", "two") for g, n in READS.items()}, counter
        qc = {r.feature: r.cnt for r in got.filter("kind = 'qc' and sample = 'one'").collect()}
        assert qc["QC_STAR_Uniquely_mapped_reads_number"] == sum(READS.values())
    regions = exons.select("chrom_id", "start0", "end0", F.lit("coding").alias("base_class"))
    got = jobs.quantify(alignments, exons, regions=regions)
    qc = {r.feature: r.cnt for r in got.filter("kind = 'qc' and sample = 'two'").collect()}
    assert qc["QC_picard_coding_bases"] == qc["QC_picard_pf_aligned_bases"] == 60 * sum(READS.values())
    with pytest.raises(ValueError):
        jobs.quantify(alignments, exons, "StringTie")
    with pytest.raises(ValueError):
        jobs.quantify(alignments, exons, "STAR", "hisat2")


def test_assemble(spark, reference, tmp_path):
    chroms, _, _ = reference
    introns = [(1000, 2000), (3000, 4000)]
    rows = [(f"r{i}", i % 2, "+", 255_000 + i, 260_000 + i, [(255_900, 256_500), (257_000, 258_000)]) for i in range(60)]
    rows += [(f"m{i}", 2, "+", 10, 5_000, introns) for i in range(60)]
    rows += [(f"few{i}", 0, "+", 900_000, 905_000, [(901_000, 902_000)]) for i in range(10)]
    alignments = spark.createDataFrame(
        rows, "read_id string, chrom_id int, strand string, start0 bigint, end0 bigint, introns array<struct<s:bigint,e:bigint>>"
    )
    kept = intervals.main_chromosomes(chroms)
    reference_table = spark.createDataFrame(
        [("T1", 0, "+", [(255_900, 256_500)], 255_000, 260_000)],
        "tid string, chrom_id int, strand string, chain array<struct<s:bigint,e:bigint>>, start0 bigint, end0 bigint",
    ).withColumn("support", F.lit(0).cast("bigint"))
    tables = {}
    for tiling in (True, False):
        named, merged = jobs.assemble(alignments, kept, reference_table, "scallop", tiling, min_reads=30)
        tables[tiling] = sorted((r.chrom_id, r.support, r.start0, r.end0) for r in named.collect())
        assert sorted((r.chrom_id, len(r.chain), r.tid == "T1") for r in merged.collect()) == [(0, 1, True), (0, 2, False), (1, 2, False)]
    # Bins with few records and chromosomes outside the dictionary take no part; tiling changes nothing.
    assert tables[True] == tables[False] == [(0, 30, 255_000, 260_058), (1, 30, 255_001, 260_059)]
    out = str(tmp_path / "out")
    jobs.write_assembly(named, merged, reference_table, out, analysis=True)
    lines = [r.value for r in spark.read.text(f"{out}/all_transcripts.gtf").collect()]
    assert len(lines) == 8 and lines[0].startswith("chr1\treadframe\ttranscript\t255001\t260058\t.\t+")
    assert spark.read.csv(f"{out}/gffcomp.txt", header=True).count() == 6
    with pytest.raises(ValueError):
        jobs.assemble(alignments, kept, reference_table, "cufflinks")


def test_assemble_bins_mates_together(spark, reference):
    """A mate alone in a bin makes the bin's record count of its pair."""
    chroms, _, _ = reference
    rows = []
    for i in range(20):
        rows.append(("s", 0, 2 * i, f"p{i}", 0, "+", 250_000 + i, 251_000, [(250_100, 250_200)]))
        rows.append(("s", 0, 2 * i + 1, f"p{i}", 0, "+", 322_000, 323_000 + i, [(322_100, 322_200)]))
    alignments = spark.createDataFrame(
        rows,
        "sample string, part_no int, ordinal bigint, read_id string, chrom_id int, strand string, start0 bigint, end0 bigint, "
        "introns array<struct<s:bigint,e:bigint>>",
    )
    none = spark.createDataFrame(
        [], "tid string, chrom_id int, strand string, chain array<struct<s:bigint,e:bigint>>, start0 bigint, end0 bigint, support bigint"
    )
    kept = intervals.main_chromosomes(chroms)
    found = {p: jobs.assemble(alignments, kept, none, min_reads=40, paired=p)[0].collect() for p in (False, True)}
    assert [(len(r.chain), r.support) for r in found[True]] == [(2, 20)]
    assert found[False] == []


def test_mates_and_blank_report(spark, reference):
    _, sequences, exons = reference
    chrom, start, _ = GENES["G1"]
    one = GENOME[chrom][start : start + 50]
    two = GENOME[chrom][start + 200 : start + 250][::-1].translate(str.maketrans("ACGT", "TGCA"))
    read = "struct<read_id:string,seq:string,plus:string,qual:string>"
    pairs = spark.createDataFrame(
        [("s", 0, 0, ("@p a", one, "+", "I" * 50), ("@p b", two, "+", "I" * 50))],
        f"sample string, part_no int, ordinal bigint, r1 {read}, r2 {read}",
    ).withColumn("paired", F.lit(True))
    alignments = jobs.align(pairs, sequences)
    assert sorted((r.mate, r.strand, r.start0) for r in alignments.collect()) == [(1, "+", start), (2, "-", start + 200)]
    got = jobs.quantify(alignments, exons, stranded="yes").filter("kind = 'gene'").collect()
    assert [(r.feature, r.cnt) for r in got] == [("G1", 1)]
