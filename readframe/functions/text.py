"""Column expressions for names, bases and qualities."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PHRED_OFFSET = 33
# A part file is named <sample>_part<number>.<extension>; the last such mark of a name counts.
PART_MARK = r"^(?<sample>.+)_part(?<number>\d+)\.[^/]+$"


def base_name(path: Column | str) -> Column:
    return F.element_at(F.split(F.rtrim(F.col(path) if isinstance(path, str) else path, F.lit("/")), "/"), -1)


def part_key(path: Column | str) -> Column:
    """``struct(sample, part_no)`` of a part file name; an unusable name is an error."""
    name = base_name(path)
    sample, digits = F.regexp_extract(name, PART_MARK, 1), F.regexp_extract(name, PART_MARK, 2)
    good = digits != ""
    failure = F.raise_error(F.concat(F.lit("file name has no usable part number: "), name))
    return F.struct(
        F.when(good, sample).otherwise(failure.cast("string")).alias("sample"),
        F.when(good, digits.try_cast("int")).alias("part_no"),
    )


def part_name(sample: Column, part_no: Column, extension: str = "fastq.gz") -> Column:
    return F.concat(sample, F.lit("_part"), part_no.cast("string"), F.lit("." + extension))


def archive_path(accession: Column) -> Column:
    """Folder of an archive accession. Six digits need no extra level, seven to nine do."""
    digits = F.regexp_replace(accession, "[^0-9]", "")
    extra = F.length(digits) - 6
    folder = F.substring(accession, 1, 6)
    level = F.when(extra > 0, F.concat(F.lit("/"), F.lpad(F.substr(digits, F.lit(7)), 3, "0"))).otherwise(F.lit(""))
    path = F.concat(folder, level, F.lit("/"), accession)
    return F.when(extra <= 3, path).otherwise(
        F.raise_error(F.concat(F.lit("accession has more than nine digits: "), accession)).cast("string")
    )


def transcript_id(chrom: Column, bin_no: Column, number: Column) -> Column:
    """An id that is unique over all bins."""
    return F.concat_ws("_", chrom, bin_no.cast("string"), number.cast("string"))


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(seq, "ACGTacgt", "TGCAtgca"))


def qualities_below(limit: int) -> str:
    """All quality characters whose Phred score is under ``limit``."""
    return "".join(chr(PHRED_OFFSET + q) for q in range(max(limit, 0)))


def opposite(strand: Column) -> Column:
    return F.when(strand == "+", "-").when(strand == "-", "+").otherwise(strand)
