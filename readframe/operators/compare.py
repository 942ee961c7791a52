"""Accuracy of assembled transcripts against a reference."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from readframe.functions.cigar import INTERVALS
from readframe.operators.intervals import depth_segments
from readframe.operators.transcripts import transcript_exons
from readframe.session import settle

LEVELS = ("base", "exon", "intron", "intron_chain", "transcript", "locus")


def feature_overlap(query: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer join of distinct features; ``status`` is matched, missed or novel."""
    q = query.select(*keys).distinct().withColumn("_q", F.lit(True))
    r = reference.select(*keys).distinct().withColumn("_r", F.lit(True))
    status = F.when(F.col("_q").isNull(), "missed").when(F.col("_r").isNull(), "novel").otherwise("matched")
    return q.join(r, list(keys), "full_outer").select(*keys, status.alias("status"))


def novel(query: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    return query.select(*keys).distinct().join(reference.select(*keys).distinct(), list(keys), "left_anti")


def missed(query: DataFrame, reference: DataFrame, keys: Sequence[str]) -> DataFrame:
    return novel(reference, query, keys)


def _features(table: DataFrame) -> DataFrame:
    """``(level, chrom_id, strand, key)``: every feature of every transcript, of all levels in one table.

    A key is a list of intervals, not their text: that of a transcript is its introns and its span.
    """
    span = lambda s, e: F.struct(s.cast("bigint").alias("s"), e.cast("bigint").alias("e"))
    chain = F.col("chain").cast(INTERVALS)
    starts = F.concat(F.array(F.col("start0").cast("bigint")), chain["e"])
    ends = F.concat(chain["s"], F.array(F.col("end0").cast("bigint")))
    one_each = lambda spans: F.transform(spans, lambda i: F.array(i))
    keys = {
        "exon": one_each(F.zip_with(starts, ends, span)),
        "intron": one_each(chain),
        "intron_chain": F.when(F.size("chain") > 0, F.array(chain)).otherwise(F.array().cast(f"array<{INTERVALS}>")),
        "transcript": F.array(F.concat(chain, F.array(span(F.col("start0"), F.col("end0"))))),
    }

    def named(level: str):
        return lambda key: F.struct(F.lit(level).alias("level"), key.alias("key"))

    rows = [F.transform(of, named(level)) for level, of in keys.items()]
    return table.select("chrom_id", "strand", F.inline(F.concat(*rows)))


def feature_tallies(query: DataFrame, reference: DataFrame, levels: Sequence[str]) -> DataFrame:
    """``(level, tp, fp, fn)`` of the levels that compare equal features, from one grouping over both sides."""
    both = _features(query).withColumn("q", F.lit(1)).unionByName(_features(reference).withColumn("q", F.lit(0)))
    sides = both.groupBy("level", "chrom_id", "strand", "key").agg(F.max("q").alias("q"), F.max(1 - F.col("q")).alias("r"))

    def number(level: str, q: int, r: int):
        return F.count_if((F.col("level") == level) & (F.col("q") == q) & (F.col("r") == r))

    counts = sides.agg(
        *[number(n, q, r).alias(f"{n}_{q}{r}") for n in levels for q, r in ((1, 1), (1, 0), (0, 1))]
    )
    rows = [
        F.struct(F.lit(n).alias("level"), F.col(f"{n}_11").alias("tp"), F.col(f"{n}_10").alias("fp"), F.col(f"{n}_01").alias("fn"))
        for n in levels
    ]
    return counts.select(F.inline(F.array(*rows)))


def base_tally(query_exons: DataFrame, reference_exons: DataFrame, stranded: bool = True) -> DataFrame:
    """Bases covered by both, by the query only and by the reference only: one sweep, no join."""
    keys = ["chrom_id", "strand"] if stranded else ["chrom_id"]
    columns = [*keys, "start0", "end0"]
    marked = query_exons.select(*columns, F.lit(1).alias("q"), F.lit(0).alias("r")).unionByName(
        reference_exons.select(*columns, F.lit(0).alias("q"), F.lit(1).alias("r"))
    )
    size = F.col("end0") - F.col("start0")

    def bases(test: str, name: str):
        return F.coalesce(F.sum(F.when(F.expr(test), size)), F.lit(0)).cast("bigint").alias(name)

    return depth_segments(marked, keys, ["q", "r"]).agg(
        bases("q > 0 and r > 0", "tp"), bases("q > 0 and r = 0", "fp"), bases("q = 0 and r > 0", "fn")
    ).select(F.lit("base").alias("level"), "tp", "fp", "fn")


def locus_tally(query: DataFrame, reference: DataFrame) -> DataFrame:
    """A locus (merged span of transcripts) matches when it shares an intron chain with the other side.

    A transcript without introns is shared with one of the other side that it overlaps.
    """
    from readframe.operators.intervals import islands, overlap_join

    keys = ["chrom_id", "strand"]
    shared = (
        query.filter(F.size("chain") > 0)
        .select(*keys, "chain")
        .distinct()
        .join(reference.select(*keys, "chain").distinct(), [*keys, "chain"])
        .select(*keys, F.col("chain")[0]["s"].alias("start0"), (F.col("chain")[0]["s"] + 1).alias("end0"))
        .distinct()
    )
    singles = [t.filter(F.size("chain") == 0).select(*keys, "start0", "end0").distinct() for t in (query, reference)]
    met = overlap_join(*singles, on=tuple(keys))
    low, high = F.greatest("start0", "r_start0"), F.least("end0", "r_end0")
    shared = shared.union(met.select(*keys, low, high).distinct())

    def loci(table: DataFrame) -> tuple[DataFrame, DataFrame]:
        spans = settle(islands(table.select(*keys, "start0", "end0"), keys))
        hits = overlap_join(shared, spans, on=tuple(keys)).select(*keys, "r_start0", "r_end0").distinct()
        return spans, hits

    names = ("q_all", "q_hit", "r_all", "r_hit")
    tables = [*loci(query), *loci(reference)]
    marked = [table.select(F.lit(name).alias("what")) for name, table in zip(names, tables, strict=True)]
    total = marked[0]
    for part in marked[1:]:
        total = total.unionByName(part)
    n = {name: F.count(F.when(F.col("what") == name, 1)) for name in names}
    return total.agg(
        n["q_hit"].alias("tp"), (n["q_all"] - n["q_hit"]).alias("fp"), (n["r_all"] - n["r_hit"]).alias("fn")
    ).select(F.lit("locus").alias("level"), "tp", "fp", "fn")


def accuracy(query: DataFrame, reference: DataFrame, levels: Sequence[str] = LEVELS) -> DataFrame:
    """``(level, tp, fp, fn, sensitivity, precision)``.

    Both sides: ``(chrom_id, strand, chain, start0, end0)``.
    """
    keys = ["chrom_id", "strand"]
    columns = [*keys, "chain", "start0", "end0"]
    # Each level reads both tables; they are small next to the reads they were made from.
    query, reference = settle(query.select(*columns)), settle(reference.select(*columns))
    parts = []
    unknown = set(levels) - set(LEVELS)
    if unknown:
        raise ValueError(f"level must be one of {LEVELS}")
    if "base" in levels:
        parts.append(base_tally(transcript_exons(query), transcript_exons(reference)))
    if "locus" in levels:
        parts.append(locus_tally(query, reference))
    equal = [n for n in levels if n in ("exon", "intron", "intron_chain", "transcript")]
    if equal:
        parts.append(feature_tallies(query, reference, equal))
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)

    def share(of: str):
        whole = F.col("tp") + F.col(of)
        return F.when(whole > 0, F.col("tp") / whole)

    return total.select("*", share("fn").alias("sensitivity"), share("fp").alias("precision"))
