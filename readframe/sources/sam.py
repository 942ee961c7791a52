"""SAM text and its header."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from readframe.functions.cigar import aligned_intervals, cigar_ops
from readframe.functions.text import part_key
from readframe.operators.running import running_sum
from readframe.operators.scale import dimension_join
from readframe.sources.lines import numbered_lines, text_lines

UNMAPPED, REVERSE, SECOND = 0x4, 0x10, 0x80


def read_chromosomes(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(chrom_id, chrom, length)`` in header order of the first file."""
    header = numbered_lines(spark, path).filter(F.col("value").startswith("@SQ\t"))
    first = header.agg(F.min("file")).scalar()
    rows = header.filter(F.col("file") == first).select(
        "file",
        "ln",
        F.regexp_extract("value", r"\tSN:([^\t]+)", 1).alias("chrom"),
        F.regexp_extract("value", r"\tLN:(\d+)", 1).try_cast("bigint").alias("length"),
        F.lit(1).alias("_one"),
    )
    numbered = running_sum(rows, ["file"], "ln", {"_before": "_one"}, levels=1)
    return numbered.select(F.col("_before").cast("int").alias("chrom_id"), "chrom", "length")


def parse_sam(lines: DataFrame, chroms: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Alignment table from SAM lines in ``value``; ``keep`` columns pass through.

    Bases and qualities are not among the columns, so they never reach a shuffle (P7).
    Positions become 0-based and half open here.
    """
    f = F.split("value", "\t")
    tag_rows = F.filter(F.slice(F.col("_f"), F.lit(12), F.greatest(F.size("_f") - 11, F.lit(0))), lambda t: t.rlike("^[A-Za-z][A-Za-z0-9]:[A-Za-z]:"))
    tags = F.map_from_entries(
        F.transform(tag_rows, lambda t: F.struct(F.substring(t, 1, 2).alias("key"), F.substr(t, F.lit(6)).alias("value")))
    )
    fields = lines.filter(~F.col("value").startswith("@")).withColumn("_f", f)
    flag = F.get("_f", F.lit(1)).try_cast("int")
    start0 = F.get("_f", F.lit(3)).try_cast("bigint") - 1
    mapped = (flag.bitwiseAND(UNMAPPED) == 0) & (F.get("_f", F.lit(2)) != "*")
    basic = fields.select(
        *keep,
        F.get("_f", F.lit(0)).alias("read_id"),
        flag.alias("flag"),
        F.when(mapped, F.get("_f", F.lit(2))).alias("chrom"),
        F.when(mapped, start0).alias("start0"),
        F.get("_f", F.lit(4)).try_cast("int").alias("mapq"),
        F.get("_f", F.lit(5)).alias("cigar"),
        F.when(mapped, aligned_intervals(start0, cigar_ops(F.get("_f", F.lit(5))))).alias("_iv"),
        tags.alias("tags"),
    )
    named = dimension_join(basic, chroms.select("chrom", "chrom_id"), ["chrom"], "left")
    return named.select(
        *keep,
        "read_id",
        "flag",
        F.when(F.col("flag").bitwiseAND(SECOND) != 0, 2).otherwise(1).alias("mate"),
        F.when(F.col("flag").bitwiseAND(REVERSE) != 0, "-").otherwise("+").alias("strand"),
        "chrom",
        "chrom_id",
        "start0",
        F.col("_iv.end0").alias("end0"),
        "mapq",
        "cigar",
        F.col("_iv.blocks").alias("blocks"),
        F.col("_iv.introns").alias("introns"),
        "tags",
    )


def read_sam(spark: SparkSession, path: str | Sequence[str], chroms: DataFrame | None = None) -> DataFrame:
    """Alignments of part files, ``(sample, part_no, ordinal, <alignment columns>)``."""
    chroms = read_chromosomes(spark, path) if chroms is None else chroms
    lines = numbered_lines(spark, path)
    # The ordinal counts records: header lines of a file come first and are taken off.
    headers = lines.groupBy("file").agg(F.count(F.when(F.col("value").startswith("@"), 1)).alias("_header"))
    keyed = dimension_join(lines, headers, ["file"]).select(
        part_key("file").alias("_key"), (F.col("ln") - F.col("_header")).alias("ordinal"), "value"
    ).select("_key.*", "ordinal", "value")
    return parse_sam(keyed, chroms, ["sample", "part_no", "ordinal"])


def read_sam_plain(spark: SparkSession, path: str | Sequence[str], chroms: DataFrame) -> DataFrame:
    """Alignments without sample, part or order, straight from the scan."""
    return parse_sam(text_lines(spark, path), chroms)


def hit_count(alignments: DataFrame) -> DataFrame:
    """Adds ``nh`` from the NH tag, NULL where the aligner wrote none."""
    return alignments.withColumn("nh", F.try_element_at("tags", F.lit("NH")).try_cast("int"))


def format_sam(alignments: DataFrame) -> DataFrame:
    """SAM lines of an alignment table, bases and qualities blanked as ``*``."""
    start = F.when(F.col("chrom").isNotNull(), F.col("start0") + 1).otherwise(0)
    tags = F.transform(F.map_entries("tags"), lambda t: F.concat(t["key"], F.lit(":Z:"), t["value"]))
    return alignments.withColumn(
        "value",
        F.concat_ws(
            "\t",
            "read_id",
            F.col("flag").cast("string"),
            F.coalesce("chrom", F.lit("*")),
            start.cast("string"),
            F.col("mapq").cast("string"),
            "cigar",
            F.lit("*"),
            F.lit("0"),
            F.lit("0"),
            F.lit("*"),
            F.lit("*"),
            tags,
        ),
    )
