"""Checked queries over files: each writes files from the tables and scans them back."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from checks import views as v
from checks.assembly import CHAINS, _candidates
from checks.registry import SQL, query
from readframe.operators import reads, transcripts, trim
from readframe.operators.matrix import with_kind
from readframe.plans import jobs
from readframe.session import release, scratch_path
from readframe.sinks import files
from readframe.sources import annotation, blocks, fastq, logs, sam
from readframe.sources.lines import numbered_lines


def _written(spark, lines: DataFrame, label: str, *folders: str) -> str:
    """Write the ``value`` column as text below a fresh folder of the shared scratch space."""
    path = scratch_path(spark, label)
    writer = lines.select(*folders, "value").write
    (writer.partitionBy(*folders) if folders else writer).text(path)
    return path


def _fastq(spark, table: DataFrame, label: str) -> str:
    record = F.concat_ws("\n", "read_id", "seq", F.lit("+"), "qual")
    ordered = table.repartitionByRange("sample", "ordinal").sortWithinPartitions("sample", "ordinal")
    return _written(spark, ordered.select("sample", record.alias("value")), label, "sample")


@query("record_frames", "v_reads1", "SELECT sample, read_id, seq, '+' AS plus, qual FROM v_reads1")
def record_frames(spark, sf):
    path = _fastq(spark, v.reads1(spark, sf), "fastq")
    return fastq.read_fastq(spark, path).select(
        F.regexp_extract("file", "sample=([^/]+)", 1).alias("sample"), "read_id", "seq", "plus", "qual"
    )


@query(
    "line_numbers",
    "v_reads1",
    """SELECT sample, CAST(4 * count(*) AS BIGINT) AS n_lines, true AS gapless FROM v_reads1 GROUP BY sample""",
)
def line_numbers(spark, sf):
    """Per file the numbers run from 0 to the line count without a gap."""
    numbered = numbered_lines(spark, _fastq(spark, v.reads1(spark, sf), "lines"))
    per_file = numbered.groupBy("file").agg(
        F.count("*").alias("n"), F.sum("ln").alias("total"), F.min("ln").alias("low"), F.max("ln").alias("high")
    )
    good = (F.col("low") == 0) & (F.col("high") == F.col("n") - 1) & (F.col("total") == F.col("n") * (F.col("n") - 1) / 2)
    return per_file.groupBy(F.regexp_extract("file", "sample=([^/]+)", 1).alias("sample")).agg(
        F.sum("n").alias("n_lines"), F.bool_and(good).alias("gapless")
    )


@query(
    "split_parts",
    ("v_reads1", "v_reads2"),
    """SELECT a.sample, concat_ws(chr(9), a.read_id, a.seq, '+', a.qual, b.read_id, b.seq, CASE WHEN b.seq IS NOT NULL THEN '+' END, b.qual) AS value
FROM v_reads1 a LEFT JOIN v_reads2 b ON a.ordinal = b.ordinal""",
)
def split_parts(spark, sf):
    """Parts written as gzip text and read back; every record is there once."""
    pairs = v.pairs(spark, sf)
    sized = pairs.withColumn("row_bytes", F.octet_length(fastq_row()) + 1)
    numbered = reads.number_parts(sized, limit=65_536)
    path = scratch_path(spark, "parts")
    files.write_parts(numbered, path)
    return jobs.read_split(spark, path).select("sample", "value")


@query("block_frames", "v_reads1", "SELECT sample, read_id, seq, '+' AS plus, qual FROM v_reads1")
def block_frames(spark, sf):
    """Records in gzip files of many members, read back by their index; nothing is shuffled to frame them."""
    record = F.concat_ws("\n", "read_id", "seq", F.lit("+"), "qual")
    table = v.reads1(spark, sf).select("sample", "ordinal", record.alias("value"))
    index = blocks.write_blocks(table, scratch_path(spark, "blocks"), ["ordinal"], part="sample", block_bytes=1 << 16)
    return blocks.block_records(index, fastq.FIELDS, task_bytes=1 << 20).select(
        F.col("file").alias("sample"), *fastq.FIELDS
    )


@query(
    "block_parts",
    ("v_reads1", "v_reads2"),
    """WITH r AS (SELECT a.sample, a.ordinal, concat_ws(chr(9), a.read_id, a.seq, '+', a.qual, b.read_id, b.seq,
    CASE WHEN b.seq IS NOT NULL THEN '+' END, b.qual) AS value FROM v_reads1 a LEFT JOIN v_reads2 b ON a.ordinal = b.ordinal),
s AS (SELECT *, coalesce(sum(strlen(value) + 1) OVER (PARTITION BY sample ORDER BY ordinal
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bytes_before FROM r)
SELECT sample, CAST(bytes_before // 65536 AS INT) AS part_no, row_number() OVER (
    PARTITION BY sample, bytes_before // 65536 ORDER BY ordinal) - 1 AS ordinal, value FROM s""",
)
def block_parts(spark, sf):
    """Parts that tasks name and one index makes visible, read back with their numbers and the order of their lines."""
    sized = v.pairs(spark, sf).withColumn("row_bytes", F.octet_length(fastq_row()) + 1)
    path = scratch_path(spark, "parts")
    files.write_part_blocks(reads.number_parts(sized, limit=65_536), path)
    return jobs.read_split(spark, path).select("sample", "part_no", "ordinal", "value")


def fastq_row():
    from readframe.sources.parts import row_text

    return row_text()


@query(
    "preprocess_job",
    ("v_reads1", "v_reads2"),
    """SELECT a.sample, substring(a.seq, 11) AS seq1, substring(b.seq, 11) AS seq2
FROM v_reads1 a JOIN v_reads2 b ON a.ordinal = b.ordinal WHERE length(a.seq) >= 46 AND length(b.seq) >= 46""",
)
def preprocess_job(spark, sf):
    """Split, write, read and clean all pairs; a missing mate is blank and too short in the end."""
    blank = F.struct(*[F.lit("").alias(name) for name in fastq.FIELDS])
    pairs = v.pairs(spark, sf).withColumn("r2", F.coalesce("r2", blank))
    numbered = reads.number_parts(pairs.withColumn("row_bytes", F.octet_length(fastq_row()) + 1), limit=65_536)
    path = scratch_path(spark, "parts")
    files.write_parts(numbered, path)
    kept, _ = jobs.preprocess(jobs.read_split(spark, path), [trim.trim_left(10), trim.min_length(36)])
    return kept.select("sample", F.col("r1.seq").alias("seq1"), F.col("r2.seq").alias("seq2"))


# ---- alignments and annotation -------------------------------------------------------------

SAM_SQL = """WITH q AS (SELECT *, end0 - start0 AS len, row_number() OVER () AS rn FROM v_align)
"""


def _sam_table(spark, sf) -> DataFrame:
    """Hits as spliced SAM records: 20 bases, a gap of 100, the rest, and two clipped bases."""
    hits = v.align(spark, sf)
    length = F.col("end0") - F.col("start0")
    return hits.select(
        "sample",
        "part_no",
        F.concat(F.lit("r"), F.col("read_id").cast("string")).alias("read_id"),
        (F.when(F.col("strand") == "-", 16).otherwise(0) + F.when(F.col("mate") == 2, 128).otherwise(64) + 1).cast("int").alias("flag"),
        F.concat(F.lit("chr"), (F.col("chrom_id") + 1).cast("string")).alias("chrom"),
        "start0",
        "mapq",
        F.concat(F.lit("20M100N"), (length - 20).cast("string"), F.lit("M2S")).alias("cigar"),
        F.create_map(F.lit("NH"), F.lit("2"), F.lit("XS"), "strand").alias("tags"),
    )


def _sam_files(spark, sf) -> tuple[str, DataFrame]:
    table = _sam_table(spark, sf)
    # Dealt by hash: ranges would format every line once more to sample it.
    lines = sam.format_sam(table).repartition("sample", "part_no").sortWithinPartitions("sample", "part_no")
    path = _written(spark, lines, "sam", "sample", "part_no")
    header = spark.range(10).selectExpr("concat('@SQ\tSN:chr', id + 1, '\tLN:', (id + 1) * 1000000) AS value")
    return path, sam.read_chromosomes(spark, _written(spark, header.coalesce(1), "header"))


@query(
    "sam_scan",
    "v_align",
    """SELECT concat('r', CAST(read_id AS VARCHAR)) AS read_id, mate, strand, concat('chr', CAST(chrom_id + 1 AS VARCHAR)) AS chrom,
  CAST(chrom_id AS INT) AS chrom_id, start0, end0 + 100 AS end0, CAST(mapq AS INT) AS mapq,
  concat(CAST(start0 AS VARCHAR), '-', CAST(start0 + 20 AS VARCHAR), ',', CAST(start0 + 120 AS VARCHAR), '-', CAST(end0 + 100 AS VARCHAR)) AS blocks,
  concat(CAST(start0 + 20 AS VARCHAR), '-', CAST(start0 + 120 AS VARCHAR)) AS introns, 2 AS nh, strand AS xs FROM v_align""",
)
def sam_scan(spark, sf):
    from checks.assembly import text

    path, chroms = _sam_files(spark, sf)
    table = sam.hit_count(sam.read_sam_plain(spark, path, chroms))
    return table.select(
        "read_id", "mate", "strand", "chrom", "chrom_id", "start0", "end0", "mapq",
        text("blocks").alias("blocks"), text("introns").alias("introns"), "nh", F.col("tags")["XS"].alias("xs"),
    )


@query(
    "sam_header",
    (),
    """SELECT CAST(i AS INT) AS chrom_id, concat('chr', CAST(i + 1 AS VARCHAR)) AS chrom, CAST((i + 1) * 1000000 AS BIGINT) AS length
FROM (SELECT DISTINCT p_partkey % 10 AS i FROM part) p""",
)
def sam_header(spark, sf):
    """Header lines for the chromosomes of the part table."""
    ids = v.table(spark, sf, "part").selectExpr("p_partkey % 10 AS id").distinct()
    header = ids.orderBy("id").coalesce(1).selectExpr("concat('@SQ\tSN:chr', id + 1, '\tLN:', (id + 1) * 1000000) AS value")
    return sam.read_chromosomes(spark, _written(spark, header, "header"))


@query(
    "merge_parts_by_sample",
    "v_align",
    "SELECT sample, part_no, read_id, start0 FROM v_align",
)
def merge_parts_by_sample(spark, sf):
    """All parts of a sample written in order to one folder per sample, and read back."""
    path = scratch_path(spark, "merged")
    hits = v.align(spark, sf).withColumn("ordinal", F.col("read_id"))
    files.write_sample_alignments(hits, path)
    return spark.read.parquet(path).select("sample", "part_no", "read_id", "start0")


@query(
    "gtf_scan",
    "v_exon",
    """SELECT gene, concat('T', gene) AS transcript, concat('chr', CAST(chrom_id + 1 AS VARCHAR)) AS chrom, start0, end0, strand,
  CAST(exon_no AS VARCHAR) AS exon_number FROM v_exon""",
)
def gtf_scan(spark, sf):
    line = F.format_string(
        'chr%d\tsource\texon\t%d\t%d\t.\t%s\t.\tgene_id "x"; transcript_id "T%s"; exon_number %d; gene_name "%s"; tag "a"; tag "b";',
        F.col("chrom_id") + 1, F.col("start0") + 1, "end0", "strand", "gene", "exon_no", "gene",
    )
    other = F.format_string('chr%d\tsource\tCDS\t%d\t%d\t.\t%s\t.\tgene_name "%s";', F.col("chrom_id") + 1, F.col("start0") + 1, "end0", "strand", "gene")
    lines = v.exons(spark, sf).select(F.explode(F.array(F.lit("# comment"), line, other)).alias("value"))
    table = annotation.read_gtf(spark, _written(spark, lines, "gtf"))
    return table.select(
        "gene", "transcript", "chrom", "start0", "end0", "strand", F.col("attrs")["exon_number"].alias("exon_number")
    )


@query(
    "refflat_scan",
    ("v_regions", "v_exon"),
    """SELECT chrom_id, base_class, start0, end0 FROM v_regions WHERE base_class <> 'intronic'
UNION ALL SELECT chrom_id, 'intronic', min(start0), max(end0) FROM v_exon GROUP BY gene, chrom_id""",
)
def refflat_scan(spark, sf):
    """Transcripts as refFlat lines, scanned and cut into base classes; whole transcripts are intronic below the others."""
    line = F.format_string(
        "%s\tT%s\tchr%d\t%s\t%d\t%d\t%d\t%d\t3\t%d,%d,%d,\t%d,%d,%d,",
        "gene", "gene", F.col("chrom_id") + 1, "strand", "base", F.expr("base + 6000 + len"), F.expr("base + 100"),
        F.expr("base + 6000 + len"), "base", F.expr("base + 3000"), F.expr("base + 6000"),
        F.expr("base + len"), F.expr("base + 3000 + len"), F.expr("base + 6000 + len"),
    )
    path = _written(spark, v.parts(spark, sf).select(line.alias("value")), "refflat")
    chroms = spark.range(10).selectExpr("id AS chrom_id", "concat('chr', id + 1) AS chrom")
    table = annotation.class_regions(annotation.read_refflat(spark, path, chroms))
    return table.select("chrom_id", "base_class", "start0", "end0")


@query(
    "gtf_sink",
    "v_chain",
    CHAINS
    + """, t AS (SELECT chrom_id, strand, start0 - 100 AS s, end0 + 100 AS e, list_prepend(start0 - 100, list_transform(string_split(chain, ','),
    lambda x: CAST(string_split(x, '-')[2] AS BIGINT))) AS ss, list_append(list_transform(string_split(chain, ','),
    lambda x: CAST(string_split(x, '-')[1] AS BIGINT)), end0 + 100) AS es FROM top)
SELECT CAST(chrom_id AS INT) AS chrom_id, strand, unnest(ss) AS start0, unnest(es) AS end0 FROM t""",
)
def gtf_sink(spark, sf):
    """Candidates written as GTF and scanned back as exons."""
    chroms = spark.range(10).selectExpr("cast(id as int) AS chrom_id", "concat('chr', id + 1) AS chrom")
    path = scratch_path(spark, "gtf")
    files.write_gtf(transcripts.name_transcripts(_candidates(spark, sf), chroms), path)
    return annotation.read_gtf(spark, path, key="gene_id", chroms=chroms).select("chrom_id", "strand", "start0", "end0")


@query(
    "fasta_scan",
    "v_genome",
    "SELECT concat('c', CAST(chrom_id AS VARCHAR)) AS name, seq FROM v_genome WHERE length(seq) > 0",
)
def fasta_scan(spark, sf):
    """Sequences written in lines of 60 bases and read back."""
    wrapped = F.regexp_replace("seq", "(.{60})", "$1\n")
    entry = F.concat(F.lit(">c"), F.col("chrom_id").cast("string"), F.lit(" some text\n"), F.rtrim(wrapped, F.lit("\n")))
    lines = v.genome(spark, sf).filter("length(seq) > 0").select(entry.alias("value"))
    return annotation.read_fasta(spark, _written(spark, lines, "fasta"))


# ---- logs ----------------------------------------------------------------------------------

def _log_name():
    return F.regexp_extract("file", "log=([^/]+)", 1)


def _part_counts(spark, sf) -> DataFrame:
    return with_kind(v.counts(spark, sf)).groupBy("sample", "part_no", "kind", "feature").agg(F.sum("cnt").alias("cnt"))


def _logs(spark, lines: DataFrame, label: str) -> str:
    name = F.concat("sample", F.lit("_part"), F.col("part_no").cast("string"), F.lit(".txt"))
    return _written(spark, lines.select(name.alias("log"), "value"), label, "log")


LOG_SQL = """WITH p AS (SELECT sample, part_no, CASE WHEN starts_with(feature, 'QC_') THEN 'qc' ELSE 'gene' END AS kind, feature,
  CAST(sum(cnt) AS BIGINT) AS cnt FROM v_counts GROUP BY ALL),
t AS (SELECT sample, part_no, count(*) AS n, CAST(sum(cnt) AS BIGINT) AS s FROM v_counts GROUP BY ALL)
"""


def _part_totals(spark, sf) -> DataFrame:
    return v.counts(spark, sf).groupBy("sample", "part_no").agg(F.count("*").alias("n"), F.sum("cnt").alias("s"))


@query(
    "star_log_scan",
    "v_counts",
    LOG_SQL
    + """SELECT sample, part_no, 'qc' AS kind, 'QC_STAR_Number_of_input_reads' AS feature, s AS cnt FROM t
UNION ALL SELECT sample, part_no, 'qc', 'QC_STAR_Number_of_splices:_GT/AG', n FROM t""",
)
def star_log_scan(spark, sf):
    text = F.format_string(
        "                                 Started job on |\tMay 01 10:00:00\n                          Number of input reads |\t%d\n"
        "                        Uniquely mapped reads %% |\t90.00%%\n                       Number of splices: GT/AG |\t%d\n",
        "s", "n",
    )
    path = _logs(spark, _part_totals(spark, sf).withColumn("value", text), "star")
    return logs.star_log(spark, path, _log_name())


@query(
    "hisat_scan",
    "v_counts",
    LOG_SQL
    + """SELECT sample, part_no, 'qc' AS kind, 'QC_HISAT_reads;_of_these:' AS feature, s AS cnt FROM t
UNION ALL SELECT sample, part_no, 'qc', 'QC_HISAT_aligned_0_times', n FROM t""",
)
def hisat_scan(spark, sf):
    text = F.format_string(
        "%d reads; of these:\n    %d (5.00%%) aligned 0 times\n95.00%% overall alignment rate", "s", "n"
    )
    return logs.hisat_summary(spark, _logs(spark, _part_totals(spark, sf).withColumn("value", text), "hisat"), _log_name())


def _gene_lines(spark, sf, head: str, line) -> DataFrame:
    """One text per part: a head and a line per feature (a part has as many lines as features)."""
    lines = _part_counts(spark, sf).groupBy("sample", "part_no").agg(
        F.concat_ws("\n", F.lit(head) if head else F.array().cast("array<string>"), F.array_sort(F.collect_list(line))).alias("value")
    )
    return lines


GENES_SQL = LOG_SQL + "SELECT sample, part_no, kind, feature, cnt FROM p WHERE kind = 'gene'"


@query("featurecounts_scan", "v_counts", GENES_SQL)
def featurecounts_scan(spark, sf):
    line = F.when(F.col("kind") == "gene", F.format_string("%s\tchr1\t1\t9\t+\t9\t%d", "feature", "cnt"))
    text = _gene_lines(spark, sf, "# Program\nGeneid\tChr\tStart\tEnd\tStrand\tLength\tx.sam", line)
    return logs.featurecounts_table(spark, _logs(spark, text, "fc"), _log_name())


@query(
    "featurecounts_summary_scan",
    "v_counts",
    LOG_SQL
    + """SELECT sample, part_no, 'qc' AS kind, 'QC_featureCount_assigned' AS feature, s AS cnt FROM t
UNION ALL SELECT sample, part_no, 'qc', 'QC_featureCount_unassigned_ambiguity', n FROM t""",
)
def featurecounts_summary_scan(spark, sf):
    text = F.format_string("Status\tx.sam\nAssigned\t%d\nUnassigned_Ambiguity\t%d", "s", "n")
    return logs.featurecounts_summary(spark, _logs(spark, _part_totals(spark, sf).withColumn("value", text), "fcs"), _log_name())


@query(
    "htseq_scan",
    "v_counts",
    LOG_SQL
    + """SELECT sample, part_no, kind, CASE WHEN kind = 'qc' THEN concat('QC_HTSeq_', lower(feature)) ELSE feature END AS feature, cnt FROM p""",
)
def htseq_scan(spark, sf):
    name = F.when(F.col("kind") == "qc", F.concat(F.lit("__"), F.lower("feature"))).otherwise(F.col("feature"))
    text = _gene_lines(spark, sf, "", F.format_string("%s\t%d", name, "cnt"))
    return logs.htseq_table(spark, _logs(spark, text, "htseq"), _log_name())


@query(
    "star_gene_scan",
    "v_counts",
    LOG_SQL
    + """SELECT sample, part_no, kind, CASE WHEN kind = 'qc' THEN concat('QC_STAR-count_', lower(feature)) ELSE feature END AS feature,
  cnt + 1 AS cnt FROM p""",
)
def star_gene_scan(spark, sf):
    name = F.when(F.col("kind") == "qc", F.concat(F.lit("N_"), F.lower("feature"))).otherwise(F.col("feature"))
    text = _gene_lines(spark, sf, "", F.format_string("%s\t%d\t%d\t%d", name, "cnt", F.col("cnt") + 1, F.col("cnt") + 2))
    return logs.star_gene_table(spark, _logs(spark, text, "star"), "FIRST_READ_TRANSCRIPTION_STRAND", _log_name())


@query(
    "picard_scan",
    "v_counts",
    LOG_SQL
    + """SELECT sample, part_no, 'qc' AS kind, 'QC_picard_pf_bases' AS feature, s AS cnt FROM t
UNION ALL SELECT sample, part_no, 'qc', 'QC_picard_coding_bases', n FROM t""",
)
def picard_scan(spark, sf):
    text = F.format_string(
        "## htsjdk\n# command\n\n## METRICS CLASS\tRnaSeqMetrics\nPF_BASES\tRIBOSOMAL_BASES\tCODING_BASES\tPCT_CODING_BASES\n"
        "%d\t\t%d\t0.5\n\n## HISTOGRAM\nposition\tcoverage\n0\t1",
        "s", "n",
    )
    return logs.picard_metrics(spark, _logs(spark, _part_totals(spark, sf).withColumn("value", text), "picard"), _log_name())


@query(
    "matrix_csv",
    "v_counts",
    "SELECT feature, "
    + ", ".join(f"CAST(sum(CASE WHEN sample = 'cell{i}' THEN cnt END) AS VARCHAR) AS cell{i}" for i in range(8))
    + " FROM v_counts GROUP BY feature",
)
def matrix_csv(spark, sf):
    """Expression and QC matrix written as CSV and read back as text columns."""
    path = scratch_path(spark, "matrix")
    files.write_matrices(v.counts(spark, sf), path, samples=[f"cell{i}" for i in range(8)])
    both = [spark.read.csv(f"{path}/{name}.csv", header=True) for name in ("samples_expression", "samples_qc_report")]
    return both[0].unionByName(both[1])


# ---- whole jobs, from files to files -------------------------------------------------------


def _mate_files(spark, sf, folder: str) -> DataFrame:
    """One FASTQ file per sample and mate, ``<sample>_<mate>.fastq``, and the manifest that lists them."""
    for mate, table in ((1, v.reads1(spark, sf)), (2, v.reads2(spark, sf))):
        record = F.concat_ws("\n", "read_id", "seq", F.lit("+"), "qual")
        name = F.concat("sample", F.lit(f"_{mate}.fastq"))
        ordered = table.select(name.alias("name"), "sample", "ordinal", record.alias("value"))
        rows = ordered.repartition("name").sortWithinPartitions("name", "ordinal")
        rows.select("name", "value").write.mode("append").partitionBy("name").text(folder)
        release(spark)
    files.name_files(spark, folder, "name")
    samples = v.reads1(spark, sf).select("sample").distinct()
    return samples.select(F.concat("sample", F.lit("_1.fastq\t"), "sample", F.lit("_2.fastq")).alias("value"))


@query(
    "split_job",
    ("v_reads1", "v_reads2"),
    """SELECT concat(a.sample, '_1') AS sample, concat_ws(chr(9), a.read_id, a.seq, '+', a.qual, coalesce(b.read_id, ''), coalesce(b.seq, ''),
  CASE WHEN b.seq IS NULL THEN '' ELSE '+' END, coalesce(b.qual, '')) AS value
FROM (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY ordinal) AS n FROM v_reads1) a
LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY sample ORDER BY ordinal) AS n FROM v_reads2) b ON a.sample = b.sample AND a.n = b.n""",
)
def split_job(spark, sf):
    """Mate files of unequal length through the whole job; the parts are read by the names in its report."""
    folder = scratch_path(spark, "mates")
    manifest = _written(spark, _mate_files(spark, sf, folder), "manifest")
    out = scratch_path(spark, "split")
    jobs.split(spark, manifest, folder, out, limit=262_144)
    names = [f"{out}/parts/{r.value}" for r in spark.read.text(f"{out}/report").collect()]
    return jobs.read_split(spark, names).select("sample", "value")


@query(
    "quantify_job",
    ("v_align", "v_exon", "v_regions"),
    """WITH b AS (SELECT sample, read_id, mate, chrom_id, start0 AS s, start0 + 25 AS e FROM v_align
  UNION ALL SELECT sample, read_id, mate, chrom_id, end0 - 20, end0 FROM v_align),
n AS (SELECT sample, read_id, count(*) AS n FROM v_align GROUP BY ALL)
SELECT sample, 'QC_picard_pf_aligned_bases' AS feature, CAST(sum(e - s) AS BIGINT) AS cnt FROM b GROUP BY sample
UNION ALL SELECT sample, 'QC_STAR_Number_of_input_reads', count(*) FROM n GROUP BY sample
UNION ALL SELECT sample, 'QC_STAR_Uniquely_mapped_reads_number', count(*) FILTER (n = 1) FROM n GROUP BY sample
UNION ALL SELECT sample, 'QC_STAR_Number_of_reads_mapped_to_multiple_loci', count(*) FILTER (n BETWEEN 2 AND 10) FROM n GROUP BY sample
UNION ALL SELECT sample, 'QC_STAR_Number_of_reads_mapped_to_too_many_loci', count(*) FILTER (n > 10) FROM n GROUP BY sample
UNION ALL SELECT sample, 'QC_STAR_Number_of_splices:_Total', count(*) FROM v_align GROUP BY sample
UNION ALL SELECT sample, 'QC_STAR_Number_of_splices:_Annotated_(sjdb)', 0 FROM v_align GROUP BY sample""",
)
def quantify_job(spark, sf):
    """Spliced alignments (25 bases, an intron, 20 bases): introns are no aligned bases, splices are counted."""
    piece = lambda s, e: F.struct(s.cast("bigint").alias("s"), e.cast("bigint").alias("e"))
    start, end = F.col("start0"), F.col("end0")
    spliced = v.align(spark, sf).select(
        "*",
        F.array(piece(start, start + 25), piece(end - 20, end)).alias("blocks"),
        F.array(piece(start + 25, end - 20)).alias("introns"),
    )
    counts = jobs.quantify(spliced, v.exons(spark, sf), regions=v.regions(spark, sf))
    wanted = F.col("feature").startswith("QC_STAR_") | (F.col("feature") == "QC_picard_pf_aligned_bases")
    return counts.filter(wanted).select("sample", "feature", "cnt")


@query(
    "quantify_introns",
    ("v_splice", "v_intron"),
    """WITH k AS (SELECT DISTINCT chrom_id, intron_s, intron_e FROM v_intron)
SELECT sample, 'QC_STAR_Number_of_splices:_Total' AS feature, count(*) AS cnt FROM v_splice GROUP BY sample
UNION ALL SELECT sample, 'QC_STAR_Number_of_splices:_Annotated_(sjdb)', count(k.chrom_id)
FROM v_splice s LEFT JOIN k ON k.chrom_id = s.chrom_id AND k.intron_s = s.intron_s AND k.intron_e = s.intron_e GROUP BY sample""",
)
def quantify_introns(spark, sf):
    """The job knows the introns of the exons that it is given."""
    edges = F.col("intron_s"), F.col("intron_e")
    piece = lambda s, e: F.struct(s.cast("bigint").alias("s"), e.cast("bigint").alias("e"))
    hits = v.splices(spark, sf).select(
        "sample", "read_id", "chrom_id", "strand", F.lit(1).alias("mate"), F.lit(60).alias("mapq"),
        (edges[0] - 25).alias("start0"), (edges[1] + 20).alias("end0"),
        F.array(piece(edges[0] - 25, edges[0]), piece(edges[1], edges[1] + 20)).alias("blocks"),
        F.array(piece(*edges)).alias("introns"),
    )
    counts = jobs.quantify(hits, v.exons(spark, sf))
    return counts.filter(F.col("feature").startswith("QC_STAR_Number_of_splices")).select("sample", "feature", "cnt")


@query(
    "accuracy_self",
    ("v_chain", "v_intron"),
    """SELECT unnest(['base', 'exon', 'intron', 'intron_chain', 'transcript', 'locus']) AS level, CAST(0 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS fn""",
)
def accuracy_self(spark, sf):
    """A table against itself is right on every level."""
    from readframe.operators.compare import accuracy

    table = _candidates(spark, sf)
    return accuracy(table, table).select("level", "fp", "fn")


@query(
    "candidate_support",
    "v_splice",
    """WITH f AS (SELECT sample, read_id // 2 AS frag, chrom_id, strand, intron_s, intron_e FROM v_splice GROUP BY ALL),
c AS (SELECT sample, frag, chrom_id, strand, string_agg(concat(intron_s, '-', intron_e), ',' ORDER BY intron_s, intron_e) AS chain
  FROM f GROUP BY sample, frag, chrom_id, strand)
SELECT chrom_id, strand, chain, count(*) AS support FROM c GROUP BY ALL""",
)
def candidate_support(spark, sf):
    """Mates share an id; the introns of a fragment are one chain, and support counts fragments."""
    hits = v.splices(spark, sf).select(
        "sample", F.expr("read_id div 2").alias("read_id"), "chrom_id", "strand",
        F.col("intron_s").alias("start0"), F.col("intron_e").alias("end0"),
        F.array(F.struct(F.col("intron_s").alias("s"), F.col("intron_e").alias("e"))).alias("introns"),
    )
    table = transcripts.chains(transcripts.fragment_chains(hits), "start0", "end0")
    text = F.array_join(F.transform("chain", lambda i: F.concat_ws("-", i["s"], i["e"])), ",")
    return table.select("chrom_id", "strand", text.alias("chain"), "support")


@query("accuracy_sink", (), SQL["accuracy_levels"])
def accuracy_sink(spark, sf):
    """The accuracy table as written and read back: every level with its figures."""
    from readframe.operators.compare import accuracy

    path = scratch_path(spark, "accuracy")
    table = accuracy(_candidates(spark, sf), v.transcripts(spark, sf))
    files.write_accuracy(table, path)
    return spark.read.schema(table.schema).csv(path, header=True).withColumns(
        {"sensitivity": F.round("sensitivity", 6), "precision": F.round("precision", 6)}
    )


@query(
    "sam_sink",
    "v_align",
    """SELECT sample, CAST(read_id AS VARCHAR) AS read_id, concat('chr', chrom_id) AS chrom, start0, end0, strand, nh
FROM (SELECT *, CASE WHEN mapq > 20 THEN '1' ELSE '2' END AS nh FROM v_align) a""",
)
def sam_sink(spark, sf):
    """Alignments of all parts as SAM text, one folder per sample, read back."""
    hits = v.align(spark, sf).select(
        "sample", "part_no", F.col("read_id").cast("bigint").alias("ordinal"), F.col("read_id").cast("string").alias("read_id"),
        F.when(F.col("strand") == "-", 16).otherwise(0).alias("flag"), F.concat(F.lit("chr"), "chrom_id").alias("chrom"),
        "start0", "mapq", F.concat(F.col("end0") - F.col("start0"), F.lit("M")).alias("cigar"),
        F.create_map(F.lit("NH"), F.when(F.col("mapq") > 20, "1").otherwise("2")).alias("tags"),
    )
    path = scratch_path(spark, "sam")
    files.write_sample_alignments(hits, path, fmt="sam")
    chroms = spark.range(10).selectExpr("id AS chrom_id", "concat('chr', id) AS chrom")
    lines = spark.read.text(path)
    back = sam.parse_sam(lines, chroms, ["sample"])
    return back.select("sample", "read_id", "chrom", "start0", "end0", "strand", F.col("tags")["NH"].alias("nh"))
