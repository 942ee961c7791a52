"""Count records to a feature x sample matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

QC_PREFIX = "QC_"
FORMS = ("wide", "array", "long")


def with_kind(counts: DataFrame) -> DataFrame:
    """An explicit ``kind`` for records that carry it only in the feature name."""
    return counts.withColumn("kind", F.when(F.col("feature").startswith(QC_PREFIX), "qc").otherwise("gene"))


def sum_counts(counts: DataFrame, keys: Sequence[str] = ("sample", "feature")) -> DataFrame:
    """A1: counts of all parts of a sample together; merged on the map side."""
    return counts.groupBy(*keys).agg(F.sum("cnt").cast("bigint").alias("cnt"))


def counts_map(counts: DataFrame) -> DataFrame:
    """A2: all samples of a feature as a map, one entry per sample."""
    return (
        sum_counts(counts)
        .groupBy("feature")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("sample", "cnt")))).alias("counts"))
    )


def sample_names(counts: DataFrame) -> list[str]:
    """Sorted sample names, one column each in the wide form."""
    return sorted(row[0] for row in counts.select("sample").distinct().collect())


def count_matrix(counts: DataFrame, samples: Sequence[str] | None = None, form: str = "wide") -> DataFrame:
    """One row per feature, NULL where a sample has none.

    The form is the caller's choice: ``wide`` has one column per sample, ``array`` has the columns ``feature`` and
    ``counts`` with the values in the order of the sorted samples, ``long`` is one row per sample and feature. Counts
    of samples that are not among given ``samples`` are an error.
    """
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}")
    if form == "long":
        return sum_counts(counts)
    names = sorted(samples) if samples is not None else sample_names(counts)
    if samples is not None:
        listed = F.col("sample").isin(*names) | F.raise_error(F.concat(F.lit("sample is not listed: "), "sample")).cast("boolean")
        counts = counts.filter(listed)
    if form == "wide":
        return counts.groupBy("feature").pivot("sample", names).agg(F.sum("cnt").cast("bigint"))
    order = F.array(*[F.lit(n) for n in names])
    return counts_map(counts).select("feature", F.transform(order, lambda s: F.col("counts")[s]).alias("counts"))


def split_kinds(counts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(genes, qc)`` by the explicit kind, so a gene named ``QC_x`` stays a gene."""
    typed = counts if "kind" in counts.columns else with_kind(counts)
    return typed.filter("kind = 'gene'"), typed.filter("kind = 'qc'")


def cpm(genes: DataFrame) -> DataFrame:
    """A4: counts per million of a sample's gene counts."""
    summed = sum_counts(genes)
    totals = genes.groupBy("sample").agg(F.sum("cnt").alias("_total"))
    return summed.join(totals, "sample").select(
        "sample", "feature", "cnt", (F.col("cnt") / F.col("_total") * 1e6).alias("cpm")
    )


def union_counts(*parts: DataFrame) -> DataFrame:
    """Gene counts and QC records of all tools in one table."""
    first, *rest = parts
    for part in rest:
        first = first.unionByName(part)
    return first


def sorted_matrix(matrix: DataFrame) -> DataFrame:
    """O1: for sinks only."""
    return matrix.orderBy("feature")

