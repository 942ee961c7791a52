"""Gene models, reference bases and adapters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from readframe.operators.scale import dimension_join

GTF_COLUMNS = ("chrom", "source", "feature", "start", "end", "score", "strand", "frame", "attributes")
ATTRIBUTE = r'(\w+)\s+"?([^";]*)"?\s*;?'


def read_gtf(
    spark: SparkSession, path: str, feature: str | None = "exon", key: str = "gene_name", chroms: DataFrame | None = None
) -> DataFrame:
    """``(gene, transcript, chrom, [chrom_id,] start0, end0, strand, attrs)`` of one feature type."""
    schema = ", ".join(f"`{c}` string" for c in GTF_COLUMNS)
    rows = spark.read.csv(path, sep="\t", comment="#", quote="", schema=schema)
    if feature is not None:
        rows = rows.filter(F.col("feature") == feature)
    names = F.regexp_extract_all("attributes", F.lit(ATTRIBUTE), 1)
    values = F.regexp_extract_all("attributes", F.lit(ATTRIBUTE), 2)
    # A key may repeat (tag "x"; tag "y"); the first one stands.
    first = F.filter(F.sequence(F.lit(1), F.size("_n")), lambda i: F.array_position("_n", F.element_at("_n", i)) == i)
    attrs = F.map_from_arrays(
        F.transform(first, lambda i: F.element_at("_n", i)), F.transform(first, lambda i: F.element_at("_v", i))
    )
    table = (
        rows.filter(F.trim("attributes") != "")
        .withColumns({"_n": names, "_v": values})
        .select(
            F.try_element_at(attrs, F.lit(key)).alias("gene"),
            F.try_element_at(attrs, F.lit("transcript_id")).alias("transcript"),
            "chrom",
            (F.col("start").try_cast("bigint") - 1).alias("start0"),
            F.col("end").try_cast("bigint").alias("end0"),
            "strand",
            attrs.alias("attrs"),
        )
    )
    if chroms is None:
        return table
    return dimension_join(table, chroms.select("chrom", "chrom_id"), ["chrom"])


def exons_of_chromosome(exons: DataFrame, chrom_id: int) -> DataFrame:
    """One chromosome; the filter reaches the scan of a columnar annotation."""
    return exons.filter(F.col("chrom_id") == chrom_id)


def reference_of(binned: DataFrame, exons: DataFrame) -> DataFrame:
    """P6 for all bins at once: number of reference exons on the bin's chromosome, NULL without."""
    known = exons.groupBy("chrom_id").agg(F.count("*").alias("n_exons"))
    return binned.join(known, "chrom_id", "left")


def read_refflat(spark: SparkSession, path: str, chroms: DataFrame | None = None) -> DataFrame:
    """One row per transcript with its exon arrays; the file is 0-based already."""
    schema = (
        "gene string, transcript string, chrom string, strand string, tx_start bigint, tx_end bigint, "
        "cds_start bigint, cds_end bigint, n_exons int, starts string, ends string"
    )
    rows = spark.read.csv(path, sep="\t", comment="#", schema=schema)

    def numbers(column: str):
        return F.transform(F.filter(F.split(column, ","), lambda x: x != ""), lambda x: x.try_cast("bigint"))

    table = rows.select(
        "gene", "transcript", "chrom", "strand", "tx_start", "tx_end", "cds_start", "cds_end",
        numbers("starts").alias("exon_starts"), numbers("ends").alias("exon_ends"),
    )
    return table if chroms is None else dimension_join(table, chroms.select("chrom", "chrom_id"), ["chrom"])


def class_regions(refflat: DataFrame) -> DataFrame:
    """Base classes of transcripts: coding and UTR parts of exons, introns between them."""
    exons = F.arrays_zip(F.col("exon_starts").alias("s"), F.col("exon_ends").alias("e"))
    rows = refflat.withColumn("_x", exons)

    def region(s, e, name: str):
        return F.struct(s.alias("start0"), e.alias("end0"), F.lit(name).alias("base_class"))

    coding = F.transform(
        "_x", lambda x: region(F.greatest(x["s"], F.col("cds_start")), F.least(x["e"], F.col("cds_end")), "coding")
    )
    low = F.transform("_x", lambda x: region(x["s"], F.least(x["e"], F.col("cds_start")), "utr"))
    high = F.transform("_x", lambda x: region(F.greatest(x["s"], F.col("cds_end")), x["e"], "utr"))
    span = F.array(region(F.col("tx_start"), F.col("tx_end"), "intronic"))
    return rows.select("chrom_id", F.inline(F.concat(coding, low, high, span))).filter("start0 < end0")


def read_fasta(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(name, seq)`` of a FASTA file; an entry begins with ``>`` at the beginning of a line."""
    entries = spark.read.text(path, lineSep="\n>").filter(F.trim("value") != "")
    header = F.split(F.regexp_replace("value", "^\\s*>", ""), "\r?\n", 2)
    return entries.select(
        F.element_at(F.split(F.get(header, F.lit(0)), r"[ \t]"), 1).alias("name"),
        F.upper(F.regexp_replace(F.coalesce(F.get(header, F.lit(1)), F.lit("")), r"\s+", "")).alias("seq"),
    )


def read_adapters(spark: SparkSession, path: str) -> DataFrame:
    """``(adapter_id, seq)``."""
    return read_fasta(spark, path).withColumnRenamed("name", "adapter_id")


def adapter_list(adapters: DataFrame) -> list[str]:
    """Adapter sequences for the trimming kernels, which take a list; a set of adapters is a short table."""
    return [row.seq for row in sorted(adapters.select("adapter_id", "seq").collect())]
