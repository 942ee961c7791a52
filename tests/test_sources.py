"""Scans and sinks on small files, with results worked out by hand."""

import gzip

import pytest
from pyspark.sql import functions as F

from readframe.functions.text import archive_path, part_key
from readframe.operators import intervals, matrix, reads
from readframe.plans import jobs
from readframe.sinks import files
from readframe.sources import annotation, fastq, lines, logs, manifest, parts, sam


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    if path.suffix == ".gz":
        with gzip.open(path, "wt") as f:
            f.write(text)
    else:
        path.write_text(text)
    return str(path)


def record(name, i):
    return f"@{name}{i}\n{'ACGT' * (1 + i % 3)}\n+\n{'I' * 4 * (1 + i % 3)}\n"


def test_line_numbers_over_many_splits(spark, tmp_path):
    count = {"a": 3000, "b": 1, "c": 2000}
    for name, n in count.items():
        suffix = ".fq.gz" if name == "c" else ".fq"
        write(tmp_path / f"{name}{suffix}", "".join(record(name, i) for i in range(n)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    try:
        table = fastq.read_fastq(spark, str(tmp_path))
        assert lines.numbered_lines(spark, str(tmp_path)).select("file", "ln").distinct().count() == 4 * sum(count.values())
        got = table.select("read_id", "ordinal", "seq", "qual").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len(got) == sum(count.values())
    for row in got:
        assert int(row.read_id[2:]) == row.ordinal
        assert row.seq == "ACGT" * (1 + row.ordinal % 3) and len(row.qual) == len(row.seq)


def test_cut_record(spark, tmp_path):
    write(tmp_path / "x.fq", record("a", 0) + record("a", 1) + "@a2\nACGT\n")
    assert fastq.read_fastq(spark, str(tmp_path)).count() == 2
    assert [r.n_malformed for r in fastq.malformed_records(spark, str(tmp_path)).collect()] == [1]


def test_part_names(spark):
    df = spark.createDataFrame([("d/S1_1_part0.fastq.gz",), ("a_part1_part12.fq",)], "p string")
    assert rows(df.select(part_key("p").alias("k")).select("k.*")) == [("S1_1", 0), ("a_part1", 12)]
    with pytest.raises(Exception, match="no usable part number"):
        spark.createDataFrame([("nopart.fq",)], "p string").select(part_key("p").alias("k")).select("k.*").collect()


def test_archive_paths(spark):
    names = ["SRR123456", "SRR1974616", "SRR12345678", "SRR123456789"]
    df = spark.createDataFrame([(n,) for n in names], "a string").select(archive_path(F.col("a")).alias("p"))
    assert sorted(r.p for r in df.collect()) == sorted(
        ["SRR123/SRR123456", "SRR197/006/SRR1974616", "SRR123/078/SRR12345678", "SRR123/789/SRR123456789"]
    )
    with pytest.raises(Exception, match="nine digits"):
        spark.createDataFrame([("SRR1234567890",)], "a string").select(archive_path(F.col("a"))).collect()


def test_manifest(spark, tmp_path):
    path = write(tmp_path / "m.txt", "a_1.fastq.gz\ta_2.fastq.gz\nb.fq\n\nx y z\n")
    table = manifest.read_manifest(spark, path)
    assert rows(table.select("manifest_line", "paired", "valid")) == [(0, True, True), (1, False, True), (3, False, False)]
    with pytest.raises(Exception, match="neither one file nor two"):
        manifest.manifest_files(table).collect()
    assert rows(manifest.manifest_files(table.filter("valid"))) == [("a_1", 1, "a_1.fastq.gz"), ("a_1", 2, "a_2.fastq.gz"), ("b", 1, "b.fq")]
    with pytest.raises(ValueError):
        manifest.require_input(table.filter("false"))


def test_part_rows(spark, tmp_path):
    pair = "@a\tAC\t+\tII\t@b\tGT\t+\t"
    write(tmp_path / "S_part0.fq", f"{pair}II\n{pair}\n@c\tAC\t+\tII\n")
    write(tmp_path / "T_part3.fq", "@a\tAC\t+\tII\n@b\tAC\t+\tII\n")
    table = parts.read_part_rows(spark, str(tmp_path))
    parsed = parts.parse_rows(table, ["sample", "part_no"], "fail")
    kept = parts.kept_rows(parsed)
    # An empty last field still is a field; a row of four in a paired part is dropped.
    assert rows(kept.select("sample", "part_no", "ordinal", "paired")) == [
        ("S", 0, 0, True), ("S", 0, 1, True), ("T", 3, 0, False), ("T", 3, 1, False)
    ]
    assert rows(parts.dropped_rows(parsed, ["sample"])) == [("S", 1), ("T", 0)]
    assert parts.as_reads(kept, ["sample"]).count() == 6


def test_first_row_rule(spark, tmp_path):
    write(tmp_path / "S_part0.fq", "a\tb\tc\n")
    table = parts.read_part_rows(spark, str(tmp_path))
    assert parts.kept_rows(parts.parse_rows(table, ["sample"])).count() == 1
    with pytest.raises(Exception, match="malformed part file"):
        parts.parse_rows(table, ["sample"], "fail").collect()


def test_split_job(spark, tmp_path):
    for mate in (1, 2):
        write(tmp_path / f"in/a_{mate}.fastq.gz", "".join(record("p", i) for i in range(500)))
    write(tmp_path / "in/b.fastq", "".join(record("s", i) for i in range(300)))
    write(tmp_path / "m.txt", "a_1.fastq.gz a_2.fastq.gz\nb.fastq\n")
    out = str(tmp_path / "out")
    numbered = jobs.split(spark, str(tmp_path / "m.txt"), str(tmp_path / "in"), out, limit=4_000)
    assert numbered.count() == 800
    back = jobs.read_split(spark, f"{out}/parts")
    order = [r.value.split("\t")[0] for r in back.filter("sample = 'a_1'").orderBy("part_no", "ordinal").collect()]
    assert order == [f"@p{i}" for i in range(500)]
    assert back.filter("sample = 'b'").count() == 300
    names = [r.value for r in spark.read.text(f"{out}/report").collect()]
    assert names == sorted(names) and len(names) > 4
    assert sorted(p.name for p in (tmp_path / "out/parts").glob("*.gz")) == names
    with pytest.raises(Exception, match="(?i)exists"):
        files.write_part_report(numbered, f"{out}/report")
    with pytest.raises(ValueError):
        files.write_mode("append")


def test_split_keeps_records_without_mate(spark, tmp_path):
    write(tmp_path / "in/a_1.fq", "".join(record("p", i) for i in range(3)) + "@cut\nAC\n")
    write(tmp_path / "in/a_2.fq", "".join(record("q", i) for i in range(2)))
    write(tmp_path / "m.txt", "a_1.fq a_2.fq\n")
    out = str(tmp_path / "out")
    numbered = jobs.split(spark, str(tmp_path / "m.txt"), str(tmp_path / "in"), out)
    assert sorted((r.r1.read_id, r.r2.read_id) for r in numbered.collect()) == [("@p0", "@q0"), ("@p1", "@q1"), ("@p2", "")]
    counts = spark.read.csv(f"{out}/partial", header=True).collect()
    assert [(r["sample"], r.cut_mate1, r.short_mate2) for r in counts] == [("a_1", "1", "1")]
    write(tmp_path / "m2.txt", "a_1.fq a_3.fq\n")
    with pytest.raises(FileNotFoundError, match="a_3.fq"):
        jobs.split(spark, str(tmp_path / "m2.txt"), str(tmp_path / "in"), str(tmp_path / "out2"))


def test_split_size_keeps_records(spark):
    table = spark.range(2000).selectExpr("'s' AS sample", "id * 3 AS ordinal", "id % 90 + 1 AS row_bytes")
    for limit in (100, 5_000, 10**9):
        numbered = reads.number_parts(table, limit=limit)
        got = [r.part_no for r in numbered.orderBy("ordinal").collect()]
        assert len(got) == 2000 and got == sorted(got)


def test_parts_by_sample(spark):
    df = spark.createDataFrame([("s", n, f"s_part{n}") for n in (2, 10, 1)], "sample string, part_no int, part_name string")
    assert rows(reads.parts_by_sample(df)) == [("s", ["s_part1", "s_part2", "s_part10"])]


def test_merged_alignments_in_numeric_order(spark, tmp_path):
    table = spark.createDataFrame([("s", p, o) for p in (10, 2, 1) for o in range(3)], "sample string, part_no int, ordinal int")
    files.write_sample_alignments(table, str(tmp_path / "m"))
    found = sorted(f for f in (tmp_path / "m/sample=s").iterdir() if f.suffix == ".parquet")
    got = [r for f in found for r in rows_in_order(spark, f)]
    assert got == [(p, o) for p in (1, 2, 10) for o in range(3)]


def rows_in_order(spark, path):
    return [(r.part_no, r.ordinal) for r in spark.read.parquet(str(path)).collect()]


def test_sam(spark, tmp_path):
    text = (
        "@HD\tVN:1.4\n@SQ\tSN:chr2\tLN:500\n@SQ\tSN:chr1\tLN:900\n"
        "r1\t99\tchr1\t11\t60\t50M100N50M2S\t*\t0\t0\t*\t*\tNH:i:1\tXS:A:+\n"
        "r2\t16\tchr2\t1\t30\t10S90M\t*\t0\t0\t*\t*\nr3\t4\t*\t0\t0\t*\t*\t0\t0\t*\t*\n"
        "r4\t0\tchr1\t5\t3\t5M2D5M1I5M\t*\t0\t0\t*\t*\n"
    )
    path = write(tmp_path / "S_part4.sam", text)
    assert rows(sam.read_chromosomes(spark, path)) == [(0, "chr2", 500), (1, "chr1", 900)]
    table = sam.hit_count(sam.read_sam(spark, path))
    got = {r.read_id: r for r in table.collect()}
    r1 = got["r1"]
    assert (r1.sample, r1.part_no, r1.ordinal, r1.chrom_id, r1.start0, r1.end0, r1.nh, r1.mate) == ("S", 4, 0, 1, 10, 210, 1, 1)
    assert [tuple(b) for b in r1.blocks] == [(10, 60), (160, 210)] and [tuple(i) for i in r1.introns] == [(60, 160)]
    assert (got["r2"].start0, got["r2"].end0, got["r2"].strand) == (0, 90, "-")
    assert got["r3"].chrom_id is None and got["r3"].blocks is None
    assert [tuple(b) for b in got["r4"].blocks] == [(4, 9), (11, 21)]


def test_gtf_refflat_fasta(spark, tmp_path):
    gtf = write(tmp_path / "a.gtf", '#c\nchr1\ts\texon\t1\t10\t.\t+\t.\tgene_id "i"; gene_name "G"; tag "a"; tag "b";\nchr1\ts\tCDS\t1\t5\t.\t+\t.\tgene_name "G";\n')
    got = annotation.read_gtf(spark, gtf).collect()
    assert [(r.gene, r.start0, r.end0, r.attrs["tag"]) for r in got] == [("G", 0, 10, "a")]
    chroms = spark.createDataFrame([(7, "chr1")], "chrom_id int, chrom string")
    flat = write(tmp_path / "r.txt", "G\tT\tchr1\t+\t0\t100\t5\t90\t2\t0,50,\t20,100,\n")
    regions = annotation.class_regions(annotation.read_refflat(spark, flat, chroms))
    assert rows(regions.select("base_class", "start0", "end0")) == [
        ("coding", 5, 20), ("coding", 50, 90), ("intronic", 0, 100), ("utr", 0, 5), ("utr", 90, 100)
    ]
    names = ["PrefixNX/1", "PrefixNX/2", "Trans1", "Trans1_rc", "Trans2", "Trans2_rc"]
    fa = write(tmp_path / "a.fa", "".join(f">{n}\nACGT\nAC\n" for n in names))
    adapters = annotation.read_adapters(spark, fa)
    assert sorted(r.adapter_id for r in adapters.collect()) == names
    assert set(annotation.adapter_list(adapters)) == {"ACGTAC"}
    odd = annotation.read_fasta(spark, write(tmp_path / "b.fa", ">s1 A>B change\nAC\nGT\n>s2\nTT\n"))
    assert rows(odd) == [("s1", "ACGT"), ("s2", "TT")]


def test_logs(spark, tmp_path):
    def scan(fn, name, text, *args):
        path = write(tmp_path / name / "S_part1.txt", text)
        return sorted((r.kind, r.feature, r.cnt) for r in fn(spark, path, *args).collect())

    assert scan(logs.star_log, "star", "  Number of input reads |\t100\nUniquely mapped reads % |\t90.00%\n") == [
        ("qc", "QC_STAR_Number_of_input_reads", 100)
    ]
    assert scan(logs.hisat_summary, "hisat", "100 reads; of these:\n  5 (5.00%) aligned 0 times\n95.00% overall alignment rate\n") == [
        ("qc", "QC_HISAT_aligned_0_times", 5), ("qc", "QC_HISAT_reads;_of_these:", 100)
    ]
    assert scan(logs.featurecounts_summary, "fcs", "Status\tx.sam\nAssigned\t7\n") == [("qc", "QC_featureCount_assigned", 7)]
    assert scan(logs.featurecounts_table, "fc", "# c\nGeneid\tx\ng1\tchr1\t4\n") == [("gene", "g1", 4)]
    assert scan(logs.htseq_table, "ht", "g1\t3\n__no_feature\t4\n") == [("gene", "g1", 3), ("qc", "QC_HTSeq_no_feature", 4)]
    table = "N_noFeature\t1\t2\t3\ng1\t4\t5\t6\n"
    for i, strand in enumerate(("NONE", "FIRST_READ_TRANSCRIPTION_STRAND", "SECOND_READ_TRANSCRIPTION_STRAND")):
        assert scan(logs.star_gene_table, f"sg{i}", table, strand) == [("gene", "g1", 4 + i), ("qc", "QC_STAR-count_noFeature", 1 + i)]
    picard = "x\n## METRICS CLASS\tc\nPF_BASES\tUTR_BASES\tCODING_BASES\tOTHER\n9\t\t5\t1\n"
    assert scan(logs.picard_metrics, "p", picard) == [("qc", "QC_picard_coding_bases", 5), ("qc", "QC_picard_pf_bases", 9)]


def test_matrix(spark):
    df = spark.createDataFrame([("s1", "g1", 1), ("s1", "g2", 3), ("s2", "g1", 2)], "sample string, feature string, cnt bigint")
    assert rows(matrix.count_matrix(df)) == [("g1", 1, 2), ("g2", 3, None)]
    typed = df.withColumn("kind", F.lit("gene")).withColumn("feature", F.concat(F.lit("QC_"), "feature"))
    genes, qc = matrix.split_kinds(typed)
    assert genes.count() == 3 and qc.count() == 0


def test_chromosome_filter(spark):
    names = ["chr1", "chrX", "chr1_alt", "chrM", "chrUn_1", "1"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "chrom_id int, chrom string")
    assert [r.chrom for r in intervals.main_chromosomes(df).orderBy("chrom_id").collect()] == names[:3]
