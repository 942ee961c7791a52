"""Quality figures from alignments."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from readframe.operators.intervals import depth_segments, overlap_bases, overlap_join
from readframe.operators.scale import by_shuffle, dealt, dimension_join, fits
from readframe.session import settle

MAX_LOCI = 10
SPLICE_BLOCK = 4_096
CLASSES = ("coding", "utr", "intronic")

# Donor and acceptor letters of the counted splice kinds, with both strands.
MOTIFS = {
    "GT/AG": ("GTAG", "CTAC"),
    "GC/AG": ("GCAG", "CTGC"),
    "AT/AC": ("ATAC", "GTAT"),
}


def read_classes(alignments: DataFrame, max_loci: int = MAX_LOCI) -> DataFrame:
    """``(sample, input, unique, multi, too_many, unmapped)`` reads."""
    per_read = alignments.groupBy("sample", "read_id").agg(F.count("chrom_id").alias("n"))
    n = F.col("n")
    return per_read.groupBy("sample").agg(
        F.count("*").alias("input_reads"),
        F.count(F.when(n == 1, 1)).alias("unique_reads"),
        F.count(F.when((n > 1) & (n <= max_loci), 1)).alias("multi_reads"),
        F.count(F.when(n > max_loci, 1)).alias("too_many_reads"),
        F.count(F.when(n == 0, 1)).alias("unmapped_reads"),
    )


def junction_counts(splices: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Splices of equal coordinates together, so that a hot intron is one row per key."""
    return splices.groupBy(*keys, "chrom_id", "intron_s", "intron_e").agg(F.count("*").alias("n"))


def known_introns(exons: DataFrame) -> DataFrame:
    """Introns of an annotation, ``(chrom_id, intron_s, intron_e)``: the gaps between the exons of one transcript, or of one
    gene where no transcript is named. Exons that overlap or touch leave no gap; exons of no gene have none."""
    owner = F.coalesce(*[F.col(c) for c in ("transcript", "gene") if c in exons.columns])
    keys = [c for c in ("chrom_id", "strand") if c in exons.columns]
    before = Window.partitionBy(*keys, "_owner").orderBy("start0", "end0").rowsBetween(Window.unboundedPreceding, -1)
    return (
        exons.withColumn("_owner", owner)
        .filter("_owner is not null and start0 < end0")
        .withColumn("intron_s", F.max("end0").over(before))
        .filter("intron_s < start0")
        .select("chrom_id", "intron_s", F.col("start0").alias("intron_e"))
        .distinct()
    )


def annotated_junctions(junctions: DataFrame, known: DataFrame) -> DataFrame:
    """Adds ``annotated``. ``known`` holds introns as ``(chrom_id, intron_s, intron_e)``."""
    marks = known.select("chrom_id", "intron_s", "intron_e").distinct().withColumn("_known", F.lit(True))
    joined = dimension_join(junctions, marks, ["chrom_id", "intron_s", "intron_e"], "left")
    return joined.withColumn("annotated", F.coalesce("_known", F.lit(False))).drop("_known")


def sequence_blocks(sequences: DataFrame, width: int = SPLICE_BLOCK, margin: int = 0) -> DataFrame:
    """``(chrom_id, block, bases)``: a reference cut into blocks for lookups by position, each with ``margin`` bases of the next."""
    starts = F.sequence(F.lit(0), F.expr(f"(length(seq) - 1) div {width}"))
    return sequences.filter("length(seq) > 0").select(
        "chrom_id", F.col("seq").cast("binary").alias("seq"), F.explode(starts).alias("block")
    ).select("chrom_id", "block", F.substr("seq", (F.col("block") * width + 1).cast("int"), F.lit(width + margin)).alias("bases"))


def splice_motifs(junctions: DataFrame, sequences: DataFrame, width: int = SPLICE_BLOCK, max_rows: int = 20_000) -> DataFrame:
    """Adds ``motif``: the kind of a splice by its first and last two bases.

    A distinct junction asks each block that holds one of its ends once, mostly one block for both. It is looked up by
    ``(chrom_id, block)``: a block is in one row and moved once, as the distinct junctions of a block are bounded by its width.
    """
    keys = ["chrom_id", "intron_s", "intron_e"]
    ends = {"_left": F.col("intron_s"), "_right": F.col("intron_e") - 2}

    def block_of(at):
        return F.floor(at / width).cast("bigint")

    asked = junctions.select(*keys).distinct().select(
        *keys, F.explode(F.array_distinct(F.array(*[block_of(at) for at in ends.values()]))).alias("block")
    )
    blocks = sequence_blocks(sequences, width, margin=1)
    blocks = F.broadcast(blocks) if fits(blocks, max_rows) else by_shuffle(blocks)
    found = asked.join(blocks, ["chrom_id", "block"], "left")
    letters = found.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("block") == block_of(at), F.substr("bases", (at - F.col("block") * width + 1).cast("int"), F.lit(2)))).cast("string").alias(name)
            for name, at in ends.items()
        ]
    )
    pair = F.upper(F.concat(*[F.coalesce(name, F.lit("")) for name in ends]))
    kind = F.coalesce(*[F.when(pair.isin(*two), name) for name, two in MOTIFS.items()], F.lit("Non-canonical"))
    return junctions.join(letters.select(*keys, kind.alias("motif")), keys)


def aligner_summary(
    alignments: DataFrame,
    splices: DataFrame,
    known: DataFrame,
    sequences: DataFrame | None = None,
    max_loci: int = MAX_LOCI,
) -> DataFrame:
    """A11 as QC records ``(sample, kind, feature, cnt)`` under the names of the aligner's log."""
    classes = read_classes(alignments, max_loci)
    names = {
        "input_reads": "Number_of_input_reads",
        "unique_reads": "Uniquely_mapped_reads_number",
        "multi_reads": "Number_of_reads_mapped_to_multiple_loci",
        "too_many_reads": "Number_of_reads_mapped_to_too_many_loci",
    }
    reads = classes.select(
        "sample",
        F.inline(F.array(*[F.struct(F.lit(f"QC_STAR_{n}").alias("feature"), F.col(c).alias("cnt")) for c, n in names.items()])),
    )
    junctions = annotated_junctions(junction_counts(splices, ["sample"]), known)
    tests = {"Total": F.lit(True), "Annotated_(sjdb)": F.col("annotated")}
    if sequences is not None:
        junctions = splice_motifs(junctions, sequences)
        tests |= {name: F.col("motif") == name for name in (*MOTIFS, "Non-canonical")}
    sums = junctions.groupBy("sample").agg(
        *[F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0)).cast("bigint").alias(name) for name, test in tests.items()]
    )
    spliced = sums.select(
        "sample",
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(f"QC_STAR_Number_of_splices:_{n}").alias("feature"), F.col(f"`{n}`").alias("cnt"))
                    for n in tests
                ]
            )
        ),
    )
    return reads.unionByName(spliced).select("sample", F.lit("qc").alias("kind"), "feature", "cnt")


def pair_summary(alignments: DataFrame, keys: Sequence[str] = ("sample", "read_id")) -> DataFrame:
    """Pairs by the number of concordant placements, other reads by their hits.

    A concordant placement is a hit of both mates on one chromosome; a chromosome with a and b
    hits of the mates gives the lesser of a and b.
    """
    # Both groupings use the one shuffle by fragment; a task has as many rows however many there are.
    per_chrom = dealt(alignments.select(*keys, "chrom_id", "mate"), keys).groupBy(*keys, "chrom_id").agg(
        F.count_if(F.col("mate") == 1).alias("all1"), F.count_if(F.col("mate") == 2).alias("all2")
    )
    mapped = F.col("chrom_id").isNotNull()
    n1, n2 = (F.when(mapped, F.col(c)).otherwise(0) for c in ("all1", "all2"))
    frag = per_chrom.groupBy(*keys).agg(
        F.sum(n1).alias("n1"),
        F.sum(n2).alias("n2"),
        F.sum(F.least(n1, n2)).alias("together"),
        ((F.max("all1") > 0) & (F.max("all2") > 0)).alias("pair"),
    )
    pair, together = F.col("pair"), F.col("together")
    mates = F.filter(
        F.array(F.when(~pair | (together == 0), F.col("n1")), F.when(pair & (together == 0), F.col("n2"))),
        lambda n: n.isNotNull(),
    )
    alone = F.when(~pair, F.greatest("n1", "n2"))
    hits = F.coalesce(F.when(alone.isNotNull(), F.array(alone)), mates)

    def of(test):
        return F.size(F.filter(hits, test))

    return frag.groupBy("sample").agg(
        F.count("*").alias("fragments"),
        F.count(F.when(pair, 1)).alias("pairs"),
        F.count(F.when(pair & (together == 0), 1)).alias("concordant_0"),
        F.count(F.when(pair & (together == 1), 1)).alias("concordant_1"),
        F.count(F.when(pair & (together > 1), 1)).alias("concordant_more"),
        F.sum(F.when(~pair | (together == 0), of(lambda n: n == 0)).otherwise(0)).cast("bigint").alias("mates_0"),
        F.sum(F.when(~pair | (together == 0), of(lambda n: n == 1)).otherwise(0)).cast("bigint").alias("mates_1"),
        F.sum(F.when(~pair | (together == 0), of(lambda n: n > 1)).otherwise(0)).cast("bigint").alias("mates_more"),
    )


# The lines of the aligner's pair summary, as the report spells them.
PAIR_LINES = {
    "fragments": "reads;_of_these:",
    "pairs": "were_paired;_of_these:",
    "concordant_0": "aligned_concordantly_0_times",
    "concordant_1": "aligned_concordantly_exactly_1_time",
    "concordant_more": "aligned_concordantly_>1_times",
    "mates_0": "aligned_0_times",
    "mates_1": "aligned_exactly_1_time",
    "mates_more": "aligned_>1_times",
}


def pair_records(summary: DataFrame) -> DataFrame:
    """The pair summary as QC records under the names of the aligner's summary."""
    entries = F.array(
        *[F.struct(F.lit(f"QC_HISAT_{n}").alias("feature"), F.col(c).cast("bigint").alias("cnt")) for c, n in PAIR_LINES.items()]
    )
    return summary.select("sample", F.lit("qc").alias("kind"), F.inline(entries))


def class_segments(regions: DataFrame, classes: Sequence[str] = CLASSES) -> DataFrame:
    """Disjoint stretches of one base class. ``regions``: ``(chrom_id, start0, end0, base_class)``.

    Where classes overlap the first of ``classes`` counts.
    """
    weighted = regions.select(
        "chrom_id", "start0", "end0", *[(F.col("base_class") == c).cast("int").alias(c) for c in classes]
    )
    best = F.coalesce(*[F.when(F.col(c) > 0, c) for c in classes])
    return depth_segments(weighted, ["chrom_id"], classes).select("chrom_id", "start0", "end0", best.alias("base_class"))


def base_classes(
    blocks: DataFrame, regions: DataFrame, keys: Sequence[str] = ("sample",), ribosomal: DataFrame | None = None
) -> DataFrame:
    """Aligned bases per class. ``blocks``: ``(keys, chrom_id, start0, end0)``.

    Intervals in ``ribosomal`` form a class of their own that comes before all others.

    Segments are disjoint, so overlaps simply add up: sums are formed on the map side and no
    alignment is shuffled when the annotation is small enough to broadcast.
    """
    classes = CLASSES
    if ribosomal is not None:
        classes = ("ribosomal", *CLASSES)
        regions = regions.select("chrom_id", "start0", "end0", "base_class").unionByName(
            ribosomal.select("chrom_id", "start0", "end0", F.lit("ribosomal").alias("base_class"))
        )
    segments = settle(class_segments(regions, classes))
    columns = blocks.select(*keys, "chrom_id", "start0", "end0")
    overlaps = overlap_join(columns, segments).groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("base_class") == c, overlap_bases())), F.lit(0)).cast("bigint").alias(f"{c}_bases")
            for c in classes
        ]
    )
    totals = blocks.groupBy(*keys).agg(F.sum(F.col("end0") - F.col("start0")).cast("bigint").alias("pf_aligned_bases"))
    zero = F.lit(0).cast("bigint")
    joined = totals.join(overlaps, list(keys), "left").select(
        *keys, "pf_aligned_bases", *[F.coalesce(f"{c}_bases", zero).alias(f"{c}_bases") for c in classes]
    )
    rest = F.col("pf_aligned_bases")
    for c in classes:
        rest = rest - F.col(f"{c}_bases")
    return joined.withColumn("intergenic_bases", rest)


def read_bases(reads: DataFrame, keys: Sequence[str] = ("sample",)) -> DataFrame:
    """``pf_bases``: bases of all reads, aligned or not."""
    return reads.groupBy(*keys).agg(F.coalesce(F.sum(F.length("seq")), F.lit(0)).cast("bigint").alias("pf_bases"))


def ignored_reads(alignments: DataFrame, ignored: DataFrame) -> DataFrame:
    """Aligned records on sequences that are left out of the figures, given by ``chrom_id``."""
    marks = ignored.select("chrom_id").distinct().withColumn("_ignored", F.lit(True))
    marked = dimension_join(alignments.select("sample", "chrom_id"), marks, ["chrom_id"], "left")
    return marked.groupBy("sample").agg(F.count("_ignored").alias("ignored_reads"))


def strand_reads(blocks: DataFrame, exons: DataFrame, strand_specificity: str = "NONE") -> DataFrame:
    """Reads on the right and the wrong strand of the one strand whose genes they touch.

    ``blocks`` carry ``(sample, read_id, mate, chrom_id, start0, end0, strand)``. Reads that
    touch genes of both strands or none do not count; an unstranded library has none at all.
    """
    if strand_specificity == "NONE":
        zero = F.lit(0).cast("bigint")
        return blocks.select("sample").distinct().select(
            "sample", zero.alias("correct_strand_reads"), zero.alias("incorrect_strand_reads")
        )
    genes = exons.select("chrom_id", "start0", "end0", F.col("strand").alias("gene_strand"))
    same = F.col("strand") == F.col("gene_strand")
    if strand_specificity == "SECOND_READ_TRANSCRIPTION_STRAND":
        same = ~same
    right = F.when(F.col("mate") == 2, ~same).otherwise(same)
    per_read = overlap_join(blocks, genes).groupBy("sample", "read_id", "mate").agg(
        F.min(right).alias("low"), F.max(right).alias("high")
    )
    return per_read.groupBy("sample").agg(
        F.count(F.when(F.col("low"), 1)).alias("correct_strand_reads"),
        F.count(F.when(~F.col("high"), 1)).alias("incorrect_strand_reads"),
    )


def base_class_records(classes: DataFrame) -> DataFrame:
    """Base-class figures as QC records."""
    names = [c for c in classes.columns if c != "sample"]
    entries = F.array(*[F.struct(F.lit(f"QC_picard_{n}").alias("feature"), F.col(n).alias("cnt")) for n in names])
    return classes.select("sample", F.lit("qc").alias("kind"), F.inline(entries))


def qc_totals(counts: DataFrame) -> DataFrame:
    """QC records ``QC_<tool>_<figure>`` summed over samples per figure (``level`` 0), per tool (1) and in all (3).

    All levels come from one pass; records are merged on the map side, so what is shuffled is a row per figure and task.
    A record without the second underscore has a null figure; ``level`` tells it from a sum over figures.
    """
    named = counts.filter(F.col("feature").startswith("QC_")).withColumn("_part", F.split("feature", "_", 3))
    parts = [F.try_element_at("_part", F.lit(place)) for place in (2, 3)]
    return (
        named.select(parts[0].alias("tool"), parts[1].alias("figure"), "cnt")
        .rollup("tool", "figure")
        .agg(
            F.grouping_id().cast("bigint").alias("level"), F.count("*").alias("n_records"), F.sum("cnt").alias("cnt"),
            F.min("cnt").alias("least"), F.max("cnt").alias("most"),
        )
    )
