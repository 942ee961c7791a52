"""Whole jobs from files to files, each one a chain of the operators.

A job returns the tables it wrote from, so callers can go on with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from readframe.operators import counting, qc, trim
from readframe.operators.compare import accuracy
from readframe.operators.hooks import ALIGNERS, ASSEMBLERS, COUNTERS, pick
from readframe.operators.intervals import (
    add_chromosome_name,
    bin_pairs,
    bin_reads,
    full_bins,
    pair_by_parity,
    reads_per_bin,
)
from readframe.operators.mapping import as_alignments, map_reads
from readframe.operators.matrix import sum_counts, union_counts
from readframe.operators.reads import PART_BYTES, number_parts
from readframe.operators.scale import dimension_join
from readframe.operators.transcripts import merge_with_reference, name_transcripts, transcript_candidates, with_bin
from readframe.sinks import files
from readframe.sources import annotation as ann
from readframe.sources.fastq import read_mates
from readframe.sources.manifest import manifest_files, read_manifest, require_input
from readframe.session import release, settle, store
from readframe.sources.parts import as_reads, kept_rows, parse_rows, read_part_rows, row_text


def split(
    spark: SparkSession,
    manifest: str,
    reads: str,
    out: str,
    limit: int = PART_BYTES,
    mode: str = "errorifexists",
    form: str = "files",
) -> DataFrame:
    """Manifest and FASTQ files to numbered parts, their report, and counts of partial records.

    ``<out>/parts`` holds the files that ``<out>/report`` names. Mate 1 leads: a record stays where mate 2 is missing
    or cut, with blanks in its place, and is counted in ``<out>/partial`` as ``(sample, cut_mate1, short_mate2)``. A
    record whose mate 1 is cut is only counted. Bad manifest lines and missing files stop the job.

    ``form="blocks"`` writes the parts as block files with an index, all or nothing; ``read_split`` reads both forms.
    """
    write = {"files": files.write_parts, "blocks": files.write_part_blocks}[form]
    listed = require_input(read_manifest(spark, manifest), "manifest")
    found = store(read_mates(spark, reads, manifest_files(listed)))
    release(spark)
    counted = found.filter("not complete").groupBy("sample").agg(
        F.count_if(~F.col("whole")).alias("cut_mate1"), F.count_if("whole").alias("short_mate2")
    )
    counted.write.mode(files.write_mode(mode)).csv(f"{out}/partial", header=True)
    records = found.filter("whole").drop("whole")
    sized = records.withColumn("row_bytes", F.octet_length(row_text()) + 1)
    numbered = number_parts(sized, limit=limit)
    write(numbered, f"{out}/parts", mode)
    release(spark)
    files.write_part_report(numbered, f"{out}/report", mode)
    return numbered


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """Part rows of a split job: sample and part come from the file names, order from the lines."""
    return read_part_rows(spark, path)


def preprocess(
    rows: DataFrame,
    steps: Sequence[trim.Step],
    first_row_rule: str = "fail",
) -> tuple[DataFrame, DataFrame]:
    """Part rows to surviving pairs and the survival report. Pairs never come apart here, so the
    re-pairing join is not needed; it is there for cleaning done elsewhere."""
    keys = ["sample", "part_no"]
    pairs = kept_rows(parse_rows(rows, keys, first_row_rule))
    trimmed = trim.trim_pairs(pairs, steps)
    return trim.survivors(trimmed), trim.trim_report(trimmed, steps)


def align(
    pairs: DataFrame, sequences: DataFrame, aligner: str = "STAR", chroms: DataFrame | None = None, **options
) -> DataFrame:
    """Pairs to an alignment table. All aligner names lead to the same seed-and-vote mapper.

    With ``chroms`` the table has the chromosome names and can be written as SAM.
    """
    pick(aligner, ALIGNERS, "aligner")
    keys = ["sample", "part_no"]
    reads = as_reads(pairs, keys).select(
        *keys, "ordinal", "mate", F.element_at(F.split("read_id", "[ \t]"), 1).alias("read_id"), "seq"
    )
    return as_alignments(map_reads(reads, sequences, **options), chroms)


def quantify(
    alignments: DataFrame,
    exons: DataFrame,
    counter: str = "featureCount",
    aligner: str = "STAR",
    strand_specificity: str = "NONE",
    regions: DataFrame | None = None,
    known: DataFrame | None = None,
    sequences: DataFrame | None = None,
    reads: DataFrame | None = None,
    ribosomal: DataFrame | None = None,
    ignored: DataFrame | None = None,
    **options,
) -> DataFrame:
    """Alignments to ``(sample, kind, feature, cnt)``: genes, counter QC, aligner QC, base classes.

    Aligner and counter both STAR means direct counting, and then no base-class figures. The ten figures of the STAR
    log take ``known`` introns, or else those between the exons of the annotation, and need ``sequences`` for the kinds of
    splices; the HISAT figures need nothing more. The base-class report has all ten figures when
    ``reads`` (for ``pf_bases``), ``ribosomal`` intervals and ``ignored`` chromosomes are given; without them those
    figures are 0 or left out.
    """
    tool, mapper = pick(counter, COUNTERS, "counter"), pick(aligner, ALIGNERS, "aligner")
    direct = tool == "star" and mapper == "star"
    if tool == "star" and not direct:
        raise ValueError("counter STAR needs aligner STAR")
    if direct:
        counts = counting.strand_column(counting.star_counts(alignments, exons), strand_specificity)
        counts = counting.prefix_counts(counts, "STAR-count")
    elif tool == "htseq":
        counts = counting.prefix_counts(counting.htseq_counts(alignments, exons, **options), "HTSeq")
    else:
        counts = counting.prefix_counts(counting.feature_counts(alignments, exons, **options), "featureCount")
    parts = [counts]
    spliced = alignments.filter("chrom_id is not null")
    spliced = spliced.select("sample", "chrom_id", F.inline("introns").alias("intron_s", "intron_e"))
    if mapper == "star":
        introns = known if known is not None else qc.known_introns(exons)
        parts.append(qc.aligner_summary(alignments, spliced, introns, sequences))
    elif mapper.startswith("hisat"):
        parts.append(qc.pair_records(qc.pair_summary(alignments)))
    if regions is not None and not direct:
        mapped = alignments.filter("chrom_id is not null")
        blocks = mapped.select("sample", "read_id", "mate", "strand", "chrom_id", F.inline("blocks").alias("start0", "end0"))
        figures = qc.base_classes(blocks.select("sample", "chrom_id", "start0", "end0"), regions, ribosomal=ribosomal)
        figures = figures.join(qc.strand_reads(blocks, exons, strand_specificity), "sample", "left")
        if reads is not None:
            figures = figures.join(qc.read_bases(reads), "sample", "left")
        if ignored is not None:
            figures = figures.join(qc.ignored_reads(mapped, ignored), "sample", "left")
        parts.append(qc.base_class_records(figures.fillna(0)))
    return sum_counts(union_counts(*parts), ["sample", "kind", "feature"])


def assemble(
    alignments: DataFrame,
    chroms: DataFrame,
    reference: DataFrame,
    assembler: str = "StringTie",
    tiling: bool = True,
    min_reads: int = 50,
    min_support: int = 2,
    paired: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Alignments to named candidates and the merged reference.

    Only reads of bins with enough records take part. With ``paired`` records 2i and 2i + 1 of a part are mates and go
    together to every bin of their common span; that needs ``sample, part_no, ordinal``. Both assembler names lead to the same
    evidence table.
    """
    pick(assembler, ASSEMBLERS, "assembler")
    keys = ["chrom_id", "bin"]
    # Dictionary filter before anything is shuffled.
    mapped = dimension_join(alignments.filter("chrom_id is not null"), chroms.select("chrom_id"), ["chrom_id"], "left_semi")
    if paired:
        part = ["sample", "part_no"]
        binned = bin_pairs(pair_by_parity(alignments, part), part, tiling).drop("pair", "paired")
        binned = settle(dimension_join(binned, chroms.select("chrom_id"), ["chrom_id"], "left_semi"))
    else:
        # Counted and then read again, so the table is kept.
        binned = settle(bin_reads(mapped, tiling))
    kept = dimension_join(binned, full_bins(reads_per_bin(binned), min_reads).select(*keys), keys, "left_semi")
    candidates = transcript_candidates(kept.drop("bin"), min_support)
    named = name_transcripts(candidates, chroms)
    merged = merge_with_reference(candidates, reference)
    titled = add_chromosome_name(with_bin(merged), chroms)
    generated = F.concat_ws("_", "chrom", F.col("bin"), F.col("start0"), F.col("end0"), F.hex(F.xxhash64("strand", "chain")))
    return named, titled.withColumn("tid", F.coalesce("tid", generated))


def write_assembly(
    named: DataFrame, merged: DataFrame, reference: DataFrame, out: str, analysis: bool = False, mode: str = "errorifexists"
) -> None:
    files.write_gtf(named, f"{out}/all_transcripts.gtf", mode)
    files.write_gtf(merged, f"{out}/reference.gtf", mode)
    if analysis:
        files.write_accuracy(accuracy(merged, reference), f"{out}/gffcomp.txt", mode)


def load_reference(spark: SparkSession, fasta: str, chroms: DataFrame) -> DataFrame:
    """``(chrom_id, seq)`` of a FASTA file, numbered by the chromosome dictionary."""
    return dimension_join(ann.read_fasta(spark, fasta).withColumnRenamed("name", "chrom"), chroms, ["chrom"]).select(
        "chrom_id", "seq"
    )
