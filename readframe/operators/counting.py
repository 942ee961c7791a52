"""Gene counts under three rule sets.

Alignments: ``(sample, read_id, chrom_id, start0, end0, strand, mapq)`` and optionally ``mate``
(1 or 2) and ``blocks`` (the aligned pieces of a spliced read). ``chrom_id`` is NULL for an
unmapped read. Exons: ``(gene, chrom_id, start0, end0, strand)``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from readframe.functions.cigar import INTERVALS
from readframe.functions.text import opposite
from readframe.operators.intervals import islands, merged_features, overlap_bases, overlap_join
from readframe.session import settle

STRANDED = ("no", "yes", "reverse")
HTSEQ_MODES = ("union", "intersection-strict", "intersection-nonempty")
STRAND_COLUMNS = {"NONE": 1, "FIRST_READ_TRANSCRIPTION_STRAND": 2, "SECOND_READ_TRANSCRIPTION_STRAND": 3}
KEYS = ("sample", "read_id")


def fragments(alignments: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """One row per fragment: ``n1``/``n2`` hits of mate 1 and 2, and the pieces of one hit each.

    Only a fragment with a single hit per mate is looked up, so any one hit is enough and the
    aggregation keeps a fixed-size state, however often a read occurs.
    """
    mate = F.col("mate") if "mate" in alignments.columns else F.lit(1)
    whole = F.array(F.struct(F.col("start0").alias("s"), F.col("end0").alias("e"))).cast(INTERVALS)
    pieces = F.coalesce(F.col("blocks").cast(INTERVALS), whole) if "blocks" in alignments.columns else whole
    mapped = F.col("chrom_id").isNotNull()
    # Mate 2 is read from the other strand of the fragment.
    strand = F.when(F.col("_mate") == 2, opposite(F.col("strand"))).otherwise(F.col("strand"))
    rows = alignments.select(*keys, mate.alias("_mate"), "chrom_id", "strand", "mapq", pieces.alias("_pieces"))
    hit = F.struct("chrom_id", strand.alias("strand"), F.col("_pieces").alias("pieces"))
    return rows.groupBy(*keys).agg(
        *[F.count(F.when((F.col("_mate") == m) & mapped, 1)).alias(f"n{m}") for m in (1, 2)],
        F.min(F.when(mapped, F.col("mapq"))).alias("mapq"),
        *[F.first(F.when((F.col("_mate") == m) & mapped, hit), ignorenulls=True).alias(f"h{m}") for m in (1, 2)],
    )


STATE = ("hits", "mapq", "read_bases")


def _pieces(frags: DataFrame, keys: Sequence[str], lookup: Column) -> DataFrame:
    """One row per aligned piece of the fragments that ``lookup`` asks for, one empty row for each
    other fragment. So one pass over the fragments serves the genes and the QC rows alike."""
    mates = F.filter(
        F.array(
            F.struct(F.lit(1).alias("mate"), F.col("h1").alias("hit")),
            F.struct(F.lit(2).alias("mate"), F.col("h2").alias("hit")),
        ),
        lambda m: m["hit"].isNotNull(),
    )
    lengths = F.transform(
        F.flatten(F.transform(mates, lambda m: m["hit"]["pieces"])), lambda piece: piece["e"] - piece["s"]
    )
    total = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda sum_, n: sum_ + n)
    return (
        frags.withColumn("hits", F.greatest("n1", "n2"))
        .select(*keys, "hits", "mapq", total.alias("read_bases"), F.explode_outer(F.when(lookup, mates)).alias("_m"))
        .select(*keys, *STATE, "_m.mate", "_m.hit.chrom_id", "_m.hit.strand", F.inline_outer("_m.hit.pieces"))
        .withColumnsRenamed({"s": "start0", "e": "end0"})
    )


def _strand_test(stranded: str):
    if stranded not in STRANDED:
        raise ValueError(f"stranded must be one of {STRANDED}")
    if stranded == "no":
        return None
    wanted = F.col("strand") if stranded == "yes" else opposite(F.col("strand"))
    return wanted == F.col("r_strand")


def _features(exons: DataFrame) -> DataFrame:
    """Merged exons of each gene, so that no base counts twice (W5). Exons without a gene belong to none and are left out."""
    return merged_features(exons.filter("gene is not null"), ["gene", "chrom_id", "strand"]).withColumnRenamed("strand", "r_strand")


def _covered(exons: DataFrame, stranded: str) -> DataFrame:
    """Stretches that lie in any gene (of one strand where the library is stranded), without a gene."""
    no_gene = F.lit(None).cast("string").alias("gene")
    exons = exons.filter("gene is not null")
    if stranded == "no":
        return islands(exons, ["chrom_id"]).select(no_gene, "*", F.lit(".").alias("r_strand"))
    return islands(exons, ["chrom_id", "strand"]).select(
        no_gene, "chrom_id", F.col("strand").alias("r_strand"), "start0", "end0"
    )


def genes_per_fragment(
    frags: DataFrame,
    exons: DataFrame,
    stranded: str = "no",
    keys: Sequence[str] = KEYS,
    covered: bool = False,
    lookup: Column | None = None,
) -> DataFrame:
    """``(keys, hits, mapq, read_bases, gene, bases, mates)``.

    Only fragments that are mapped once and pass ``lookup`` meet the genes. A row with NULL gene
    stands for a piece without gene; with ``covered`` its ``bases`` are the bases that lie in
    any gene. After a broadcast lookup all of this runs on the partitioning of ``fragments``.
    """
    features = _features(exons)
    if covered:
        features = features.unionByName(_covered(exons, stranded))
    # The join counts its right side and then reads it, so the merged annotation is kept.
    features = settle(features)
    once = F.col("hits") == 1
    wanted = once if lookup is None else once & lookup
    pairs = overlap_join(_pieces(frags, keys, wanted), features, how="left", condition=_strand_test(stranded))
    return pairs.groupBy(*keys, *STATE, "gene").agg(
        F.coalesce(F.sum(overlap_bases()), F.lit(0)).alias("bases"),
        (F.max(F.when(F.col("mate") == 1, 1).otherwise(0)) + F.max(F.when(F.col("mate") == 2, 1).otherwise(0))).alias(
            "mates"
        ),
    )


def _choose(per_gene: DataFrame, keys: Sequence[str], qualifies=None) -> DataFrame:
    """``(keys, hits, mapq, n_genes, gene)``: how many genes a fragment qualifies for, and one of them."""
    gene = F.when(qualifies, F.col("gene")) if qualifies is not None else F.col("gene")
    return per_gene.groupBy(*keys, "hits", "mapq").agg(F.count(gene).alias("n_genes"), F.max(gene).alias("gene"))


def _both_mates_first(per_gene: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pairs: a gene hit by both mates beats genes hit by one."""
    hit = F.col("gene").isNotNull()
    both = hit & (F.col("mates") == 2)
    return per_gene.groupBy(*keys, "hits", "mapq").agg(
        F.count(F.when(hit, 1)).alias("_any"),
        F.max(F.col("gene")).alias("_gene"),
        F.count(F.when(both, 1)).alias("_both"),
        F.max(F.when(both, F.col("gene"))).alias("_gene2"),
    ).select(
        *keys,
        "hits",
        "mapq",
        F.when(F.col("_both") > 0, F.col("_both")).otherwise(F.col("_any")).alias("n_genes"),
        F.when(F.col("_both") > 0, F.col("_gene2")).otherwise(F.col("_gene")).alias("gene"),
    )


def _status(chosen: DataFrame, skipped, none: str, many: str) -> DataFrame:
    """Count records. ``skipped``: ``(test, status, count)`` of fragments that were not looked up."""
    label = F.coalesce(*[F.when(test, status) for test, status, _ in skipped])
    amount = F.coalesce(*[F.when(test, count) for test, _, count in skipped], F.lit(1))
    n = F.col("n_genes")
    by_genes = F.when(n == 0, none).when(n == 1, F.col("gene")).otherwise(many)
    return chosen.select(
        "sample",
        F.when(label.isNull() & (n == 1), "gene").otherwise("qc").alias("kind"),
        F.coalesce(label, by_genes).alias("feature"),
        amount.cast("bigint").alias("cnt"),
    )


def _total(rows: DataFrame) -> DataFrame:
    return rows.groupBy("sample", "kind", "feature").agg(F.sum("cnt").cast("bigint").alias("cnt"))


def feature_counts(
    alignments: DataFrame, exons: DataFrame, stranded: str = "no", keys: Sequence[str] = KEYS
) -> DataFrame:
    """``(sample, kind, feature, cnt)``. Assigned fragments count under their gene.

    Multi-mapped reads count once per hit, as records of the alignment file do.
    """
    hits = F.col("hits")
    skipped = [(hits == 0, "unassigned_unmapped", F.lit(1)), (hits > 1, "unassigned_multimapping", hits)]
    chosen = _both_mates_first(genes_per_fragment(fragments(alignments, keys), exons, stranded, keys), keys)
    return _total(_status(chosen, skipped, "unassigned_nofeatures", "unassigned_ambiguity"))


def feature_summary(counts: DataFrame) -> DataFrame:
    """The status table: assigned and every unassigned reason."""
    status = F.when(F.col("kind") == "gene", "assigned").otherwise(F.col("feature"))
    return counts.groupBy("sample", status.alias("status")).agg(F.sum("cnt").cast("bigint").alias("cnt"))


def htseq_counts(
    alignments: DataFrame,
    exons: DataFrame,
    mode: str = "union",
    stranded: str = "yes",
    min_quality: int = 10,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Union, intersection-strict or intersection-nonempty."""
    if mode not in HTSEQ_MODES:
        raise ValueError(f"mode must be one of {HTSEQ_MODES}")
    hits, poor = F.col("hits"), F.col("mapq") < min_quality
    skipped = [
        (hits == 0, "not_aligned", F.lit(1)),
        (hits > 1, "alignment_not_unique", hits),
        (poor, "too_low_aQual", F.lit(1)),
    ]
    covered = mode == "intersection-nonempty"
    per_gene = genes_per_fragment(fragments(alignments, keys), exons, stranded, keys, covered, ~poor)
    qualifies = None
    if mode == "intersection-strict":
        qualifies = F.col("bases") == F.col("read_bases")
    elif mode == "intersection-nonempty":
        # The few rows of one read; already together after the lookup.
        read = Window.partitionBy(*keys)
        per_gene = per_gene.withColumn("_covered", F.max(F.when(F.col("gene").isNull(), F.col("bases"))).over(read))
        qualifies = F.col("bases") == F.col("_covered")
    chosen = _choose(per_gene, keys, qualifies)
    return _total(_status(chosen, skipped, "no_feature", "ambiguous"))


def star_counts(alignments: DataFrame, exons: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """A10: ``(sample, kind, feature, unstranded, first_strand, second_strand)`` in one pass."""
    pieces = _pieces(fragments(alignments, keys), keys, F.col("hits") == 1)
    pairs = overlap_join(pieces, _features(exons), how="left")
    same = F.col("strand") == F.col("r_strand")
    per_gene = pairs.groupBy(*keys, "hits", "gene").agg(F.coalesce(F.max(same), F.lit(False)).alias("same"))
    gene = F.col("gene")
    tests = {
        "unstranded": gene.isNotNull(),
        "first_strand": gene.isNotNull() & F.col("same"),
        "second_strand": gene.isNotNull() & ~F.col("same"),
    }
    chosen = per_gene.groupBy(*keys, "hits").agg(
        *[F.count(F.when(t, 1)).alias(f"n_{name}") for name, t in tests.items()],
        *[F.max(F.when(t, gene)).alias(f"g_{name}") for name, t in tests.items()],
    )

    def result(name: str):
        n = F.col(f"n_{name}")
        skipped = F.when(F.col("hits") == 0, "unmapped").when(F.col("hits") > 1, "multimapping")
        by_genes = F.when(n == 0, "noFeature").when(n == 1, F.col(f"g_{name}")).otherwise("ambiguous")
        return F.struct(
            F.lit(name).alias("column"),
            F.when(n == 1, "gene").otherwise("qc").alias("kind"),
            F.coalesce(skipped, by_genes).alias("feature"),
            F.lit(1).cast("bigint").alias("cnt"),
        )

    rows = chosen.select("sample", F.inline(F.array(*[result(name) for name in tests])))
    return rows.groupBy("sample", "kind", "feature").agg(
        *[F.coalesce(F.sum(F.when(F.col("column") == name, F.col("cnt"))), F.lit(0)).cast("bigint").alias(name) for name in tests]
    )


def strand_column(counts: DataFrame, strand_specificity: str = "NONE") -> DataFrame:
    """The one of the three count columns that fits the library."""
    if strand_specificity not in STRAND_COLUMNS:
        raise ValueError(f"strand_specificity must be one of {tuple(STRAND_COLUMNS)}")
    columns = ("unstranded", "first_strand", "second_strand")
    name = columns[STRAND_COLUMNS[strand_specificity] - 1]
    return counts.select("sample", "kind", "feature", F.col(name).alias("cnt")).filter("cnt > 0")


def no_feature_reads(alignments: DataFrame, exons: DataFrame) -> DataFrame:
    """Alignments that touch no exon, from one outer overlap join.

    Equal alignments all come back, with any columns.
    """
    numbered = alignments.withColumn("_row", F.monotonically_increasing_id())
    pairs = overlap_join(numbered, _features(exons).select("gene", "chrom_id", "start0", "end0"), how="left")
    whole = F.first(F.struct(*alignments.columns)).alias("_a")
    return pairs.groupBy("_row").agg(F.count("gene").alias("_n"), whole).filter("_n = 0").select("_a.*")


def prefix_counts(counts: DataFrame, tool: str) -> DataFrame:
    """QC names of a counting tool, as the report spells them: ``QC_<tool>_<status>``."""
    name = F.when(F.col("kind") == "qc", F.concat(F.lit(f"QC_{tool}_"), F.col("feature"))).otherwise(F.col("feature"))
    return counts.withColumn("feature", name)
