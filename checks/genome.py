"""Checked queries: bins, overlaps, gene counts, quality figures."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from readframe.operators import counting, hooks, intervals, mapping, matrix, qc, seed_index, sweep, transcripts
from readframe.operators.scale import dealt
from readframe.session import scratch_path
from readframe.sources import annotation

STEP, OFFSET, SIZE = intervals.BIN_STEP, intervals.BIN_OFFSET, intervals.BIN_SIZE

BINS_SQL = f"""WITH b AS (SELECT *, unnest(range(greatest(start0 - {OFFSET}, 0) // {STEP}, end0 // {STEP} + 1)) AS bin FROM v_align)
"""


@query(
    "read_bins_tiled", "v_align", BINS_SQL + "SELECT read_id, sample, chrom_id, start0, end0, bin FROM b"
)
def read_bins_tiled(spark, sf):
    return intervals.bin_reads(v.align(spark, sf)).select("read_id", "sample", "chrom_id", "start0", "end0", "bin")


@query(
    "read_bins_plain",
    "v_align",
    f"SELECT read_id, sample, chrom_id, start0, end0, unnest(range(start0 // {SIZE}, end0 // {SIZE} + 1)) AS bin FROM v_align",
)
def read_bins_plain(spark, sf):
    return intervals.bin_reads(v.align(spark, sf), tiling=False).select(
        "read_id", "sample", "chrom_id", "start0", "end0", "bin"
    )


@query("reads_per_bin", "v_align", BINS_SQL + "SELECT chrom_id, bin, count(*) AS n_reads FROM b GROUP BY ALL")
def reads_per_bin(spark, sf):
    return intervals.reads_per_bin(intervals.bin_reads(v.align(spark, sf)))


@query(
    "bin_min_reads",
    "v_align",
    BINS_SQL + "SELECT chrom_id, bin, count(*) AS n_reads FROM b GROUP BY ALL HAVING count(*) >= 50",
)
def bin_min_reads(spark, sf):
    return intervals.full_bins(intervals.reads_per_bin(intervals.bin_reads(v.align(spark, sf))))


ONE_HIT = """WITH h AS (SELECT sample, read_id, chrom_id, start0, end0 FROM v_align
  QUALIFY row_number() OVER (PARTITION BY sample, read_id ORDER BY chrom_id, start0, end0) = 1)
"""


def _mates(spark, sf):
    """Mates of one hit each. The hits are dealt by pair once; both groupings use that. What tells the rest is moved:
    the read its pair, and the start with a short length the end."""
    pair, start = F.expr("read_id div 2"), F.coalesce("start0", F.lit(0))
    hits = v.align(spark, sf).select("sample", "read_id", "chrom_id", "start0", (F.col("end0") - start).alias("_len"))
    hits = dealt(hits, ["sample", pair]).select("sample", pair.alias("pair"), "read_id", "chrom_id", "start0", (start + F.col("_len")).alias("end0"))
    best = mapping.best_hit(hits, ["sample", "pair", "read_id"], [], ["chrom_id", "start0", "end0"])
    return intervals.pair_by_parity(best.drop("n_hits"), ["sample"], "read_id", numbered=True)


@query(
    "mate_of",
    "v_align",
    ONE_HIT
    + """SELECT a.sample, a.read_id, b.read_id AS mate_id, coalesce(a.chrom_id = b.chrom_id, false) AS same_chrom
FROM h a LEFT JOIN h b ON a.sample = b.sample AND a.read_id // 2 = b.read_id // 2 AND a.read_id <> b.read_id
WHERE a.read_id % 2 = 0""",
)
def mate_of(spark, sf):
    pairs = _mates(spark, sf)
    return pairs.filter("m1 is not null").select(
        "sample",
        F.col("m1.read_id").alias("read_id"),
        F.col("m2.read_id").alias("mate_id"),
        F.coalesce(F.col("m1.chrom_id") == F.col("m2.chrom_id"), F.lit(False)).alias("same_chrom"),
    )


@query(
    "pair_bins",
    "v_align",
    ONE_HIT
    + f""", p AS (SELECT h.*, read_id // 2 AS pair, count(*) OVER w = 2 AND min(chrom_id) OVER w = max(chrom_id) OVER w AS paired,
  min(start0) OVER w AS s, max(end0) OVER w AS e FROM h WINDOW w AS (PARTITION BY sample, read_id // 2)),
q AS (SELECT *, CASE WHEN paired THEN s ELSE start0 END AS lo, CASE WHEN paired THEN e ELSE end0 END AS hi FROM p)
SELECT sample, pair, paired, read_id, chrom_id, unnest(range(greatest(lo - {OFFSET}, 0) // {STEP}, hi // {STEP} + 1)) AS bin FROM q""",
)
def pair_bins(spark, sf):
    pairs = _mates(spark, sf)
    return intervals.bin_pairs(pairs, ["sample"]).select("sample", "pair", "paired", "read_id", "chrom_id", "bin")


@query("chrom_filter", "v_chrom", "SELECT chrom_id, chrom FROM v_chrom WHERE regexp_matches(chrom, '^chr[0-9XY]+')")
def chrom_filter(spark, sf):
    return intervals.main_chromosomes(v.chromosomes(spark, sf)).select("chrom_id", "chrom")


@query(
    "chrom_lookup",
    ("v_align", "v_chrom"),
    """SELECT c.chrom, count(*) AS n_hits FROM v_align a JOIN v_chrom c USING (chrom_id)
WHERE regexp_matches(c.chrom, '^chr[0-9XY]+') GROUP BY c.chrom""",
)
def chrom_lookup(spark, sf):
    kept = intervals.main_chromosomes(v.chromosomes(spark, sf))
    named = intervals.add_chromosome_name(v.align(spark, sf), kept)
    return named.groupBy("chrom").agg(F.count("*").alias("n_hits"))


@query(
    "exons_by_chrom",
    "v_exon",
    "SELECT gene, exon_no, start0, end0 FROM v_exon WHERE chrom_id = 3",
)
def exons_by_chrom(spark, sf):
    return annotation.exons_of_chromosome(v.exons(spark, sf), 3).select("gene", "exon_no", "start0", "end0")


@query(
    "bins_with_reference",
    ("v_align", "v_exon"),
    BINS_SQL
    + """, n AS (SELECT chrom_id, bin, count(*) AS n_reads FROM b GROUP BY ALL),
k AS (SELECT chrom_id, count(*) AS n_exons FROM v_exon GROUP BY chrom_id)
SELECT n.chrom_id, bin, n_reads, n_exons FROM n LEFT JOIN k USING (chrom_id)""",
)
def bins_with_reference(spark, sf):
    return annotation.reference_of(
        intervals.reads_per_bin(intervals.bin_reads(v.align(spark, sf))), v.exons(spark, sf)
    )


@query(
    "bin_reference",
    ("v_align", "v_exon", "v_chrom"),
    BINS_SQL
    + f""", k AS (SELECT e.chrom_id, e.gene, e.start0, e.end0 FROM v_exon e JOIN v_chrom c USING (chrom_id)
  WHERE regexp_matches(chrom, '^chr[0-9XY]+')),
x AS (SELECT *, unnest(range(greatest(start0 - {OFFSET}, 0) // {STEP}, end0 // {STEP} + 1)) AS bin FROM k),
n AS (SELECT chrom_id, bin, count(*) AS n_exons, count(DISTINCT gene) AS n_genes FROM x GROUP BY ALL),
h AS (SELECT b.chrom_id, b.bin, b.sample, b.read_id, b.start0, b.end0, b.mate,
  EXISTS (SELECT 1 FROM x WHERE x.chrom_id = b.chrom_id AND x.bin = b.bin AND x.start0 < b.end0 AND b.start0 < x.end0) AS on_exon
  FROM b)
SELECT h.chrom_id, h.bin, count(*) AS n_reads, count(*) FILTER (on_exon) AS on_exons, max(n_exons) AS n_exons, max(n_genes) AS n_genes
FROM h LEFT JOIN n USING (chrom_id, bin) GROUP BY ALL""",
)
def bin_reference(spark, sf):
    """A user function over each bin's reads and the exons of that bin; chromosomes outside the reference have none."""
    import numpy as np
    import pyarrow as pa

    def compare(key, hits, known):
        lows, highs = (np.sort(known[c].to_numpy()) for c in ("start0", "end0"))
        starts, ends = (hits[c].to_numpy() for c in ("start0", "end0"))
        # Exons that began before a read's end, less those that ended at or before its start.
        depth = np.searchsorted(lows, ends, "left") - np.searchsorted(highs, starts, "right")
        genes = len(set(known["gene"].to_pylist()))
        row = [*key[:2], len(starts), int((depth > 0).sum()), len(lows) or None, genes or None]
        return pa.Table.from_arrays([pa.array([x], pa.int64()) for x in row], names=columns)

    columns = ["chrom_id", "bin", "n_reads", "on_exons", "n_exons", "n_genes"]
    chroms = intervals.main_chromosomes(v.chromosomes(spark, sf)).select("chrom_id")
    exons = v.exons(spark, sf).join(F.broadcast(chroms), "chrom_id").select("chrom_id", "gene", "start0", "end0")
    binned = intervals.bin_reads(v.align(spark, sf)).select("chrom_id", "bin", "sample", "read_id", "start0", "end0")
    per_piece = hooks.map_bins_with(binned, exons, compare, ", ".join(f"{c} bigint" for c in columns))
    return per_piece.groupBy("chrom_id", "bin").agg(
        *[F.sum(c).alias(c) for c in ("n_reads", "on_exons")], *[F.max(c).alias(c) for c in ("n_exons", "n_genes")]
    )


OVERLAP = "a.chrom_id = e.chrom_id AND a.start0 < e.end0 AND e.start0 < a.end0"


@query(
    "overlap_hits",
    ("v_align", "v_exon"),
    f"SELECT a.read_id, a.sample, a.start0, e.gene, e.exon_no FROM v_align a JOIN v_exon e ON {OVERLAP}",
)
def overlap_hits(spark, sf):
    return intervals.overlap_join(v.align(spark, sf), v.exons(spark, sf).drop("strand")).select(
        "read_id", "sample", "start0", "gene", "exon_no"
    )


@query(
    "overlap_sweep",
    ("v_align", "v_exon"),
    f"SELECT a.read_id, a.sample, a.start0, e.gene, e.exon_no FROM v_align a JOIN v_exon e ON {OVERLAP}",
)
def overlap_sweep(spark, sf):
    """The same pairs by a sweep over stretches instead of genome cells."""
    hits = v.align(spark, sf).select("read_id", "sample", "chrom_id", "start0", "end0")
    return sweep.sweep_join(hits, v.exons(spark, sf).drop("strand")).select(
        "read_id", "sample", "start0", "gene", "exon_no"
    )


SPANS_SQL = """WITH t AS (SELECT gene, chrom_id, min(start0) AS start0, max(end0) AS end0 FROM v_exon GROUP BY ALL)
SELECT a.gene, CAST(count(*) AS BIGINT) AS n_genes, CAST(sum(least(a.end0, b.end0) - greatest(a.start0, b.start0)) AS BIGINT) AS bases
FROM t a JOIN t b ON a.chrom_id = b.chrom_id AND a.start0 < b.end0 AND b.start0 < a.end0 GROUP BY a.gene"""


@query("span_sweep", "v_exon", SPANS_SQL)
def span_sweep(spark, sf):
    """Genes whose whole spans overlap, each with itself too."""
    spans = v.exons(spark, sf).groupBy("gene", "chrom_id").agg(F.min("start0").alias("start0"), F.max("end0").alias("end0"))
    pairs = sweep.sweep_join(spans, spans.withColumnRenamed("gene", "other"))
    return pairs.groupBy("gene").agg(F.count("*").alias("n_genes"), F.sum(intervals.overlap_bases()).alias("bases"))


@query(
    "overlap_bases",
    ("v_align", "v_exon"),
    f"""SELECT e.gene, count(*) AS n_pairs, CAST(sum(least(a.end0, e.end0) - greatest(a.start0, e.start0)) AS BIGINT) AS bases
FROM v_align a JOIN v_exon e ON {OVERLAP} GROUP BY e.gene""",
)
def overlap_bases(spark, sf):
    pairs = intervals.overlap_join(v.align(spark, sf).select("chrom_id", "start0", "end0"), v.exons(spark, sf))
    return pairs.groupBy("gene").agg(
        F.count("*").alias("n_pairs"), F.sum(intervals.overlap_bases()).alias("bases")
    )


DEPTH_SQL = """WITH ev AS (SELECT chrom_id, start0 AS pos, 1 AS d FROM v_align UNION ALL SELECT chrom_id, end0, -1 FROM v_align),
g AS (SELECT chrom_id, pos, sum(d) AS d FROM ev GROUP BY ALL HAVING sum(d) <> 0),
r AS (SELECT chrom_id, pos, CAST(sum(d) OVER w AS BIGINT) AS depth, lead(pos) OVER w AS nxt FROM g
  WINDOW w AS (PARTITION BY chrom_id ORDER BY pos))
"""


@query(
    "coverage_segments",
    "v_align",
    DEPTH_SQL + "SELECT chrom_id, pos AS start0, nxt AS end0, depth FROM r WHERE depth > 0",
)
def coverage_segments(spark, sf):
    return intervals.depth_segments(v.align(spark, sf).select("chrom_id", "start0", "end0"), ["chrom_id"])


ISLANDS_SQL = """WITH m AS (SELECT chrom_id, start0, end0, max(end0) OVER (PARTITION BY chrom_id ORDER BY start0, end0
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM v_{0}),
i AS (SELECT *, sum(CASE WHEN seen IS NULL OR start0 > seen THEN 1 ELSE 0 END) OVER (PARTITION BY chrom_id
  ORDER BY start0, end0 ROWS UNBOUNDED PRECEDING) AS k FROM m)
SELECT chrom_id, min(start0) AS start0, max(end0) AS end0 FROM i GROUP BY chrom_id, k"""


@query("exon_islands", "v_exon", ISLANDS_SQL.format("exon"))
def exon_islands(spark, sf):
    return intervals.islands(v.exons(spark, sf), ["chrom_id"])


@query("read_islands", "v_align", ISLANDS_SQL.format("align"))
def read_islands(spark, sf):
    return intervals.islands(v.align(spark, sf), ["chrom_id"])


@query(
    "coord_sort",
    "v_align",
    BINS_SQL + "SELECT chrom_id, bin, start0, read_id, sample FROM b ORDER BY chrom_id, bin, start0",
)
def coord_sort(spark, sf):
    binned = intervals.bin_reads(v.align(spark, sf)).select("chrom_id", "bin", "start0", "read_id", "sample")
    return transcripts.coordinate_sorted(binned)


# ---- gene counts ---------------------------------------------------------------------------


def _single_sql(strand: str = "", extra: str = "") -> str:
    return f"""WITH nh AS (SELECT sample, read_id, count(*) AS n, min(mapq) AS mq FROM v_align GROUP BY ALL),
u AS (SELECT a.* FROM v_align a JOIN nh USING (sample, read_id) WHERE n = 1 {extra}),
o AS (SELECT a.sample, a.read_id, count(DISTINCT gene) AS g, max(gene) AS gene
  FROM u a LEFT JOIN v_exon e ON {OVERLAP} {strand} GROUP BY ALL)
"""


def _tally_sql(none: str, many: str, multi: str, extra: str = "") -> str:
    return f"""SELECT sample, kind, feature, CAST(sum(c) AS BIGINT) AS cnt FROM (
  SELECT sample, CASE WHEN g = 1 THEN 'gene' ELSE 'qc' END AS kind,
    CASE WHEN g = 0 THEN '{none}' WHEN g = 1 THEN gene ELSE '{many}' END AS feature, 1 AS c FROM o
  UNION ALL SELECT sample, 'qc', '{multi}', n FROM nh WHERE n > 1 {extra}) t GROUP BY ALL"""


FEATURE_SQL = _single_sql() + _tally_sql(
    "unassigned_nofeatures", "unassigned_ambiguity", "unassigned_multimapping"
)


def _single(spark, sf):
    return v.align(spark, sf).drop("mate")


@query("feature_counts", ("v_align", "v_exon"), FEATURE_SQL)
def feature_counts(spark, sf):
    return counting.feature_counts(_single(spark, sf), v.exons(spark, sf))


@query(
    "feature_counts_stranded",
    ("v_align", "v_exon"),
    _single_sql("AND e.strand <> a.strand")
    + _tally_sql("unassigned_nofeatures", "unassigned_ambiguity", "unassigned_multimapping"),
)
def feature_counts_stranded(spark, sf):
    return counting.feature_counts(_single(spark, sf), v.exons(spark, sf), stranded="reverse")


@query(
    "feature_summary",
    ("v_align", "v_exon"),
    FEATURE_SQL.replace("SELECT sample, kind, feature, CAST", "SELECT sample, CASE WHEN kind = 'gene' THEN 'assigned' ELSE feature END AS status, CAST"),
)
def feature_summary(spark, sf):
    return counting.feature_summary(feature_counts(spark, sf))


PAIR_SQL = f"""WITH f AS (SELECT *, CASE WHEN mate = 1 THEN strand WHEN strand = '+' THEN '-' ELSE '+' END AS fstrand FROM v_pair_align),
nh AS (SELECT sample, read_id, greatest(count(*) FILTER (mate = 1), count(*) FILTER (mate = 2)) AS n FROM f GROUP BY ALL),
u AS (SELECT f.* FROM f JOIN nh USING (sample, read_id) WHERE n = 1),
h AS (SELECT a.sample, a.read_id, gene, count(DISTINCT mate) AS mates FROM u a LEFT JOIN v_exon e ON {OVERLAP} GROUP BY ALL),
b AS (SELECT *, max(CASE WHEN gene IS NOT NULL THEN mates END) OVER (PARTITION BY sample, read_id) AS best FROM h),
o AS (SELECT sample, read_id, count(gene) FILTER (mates = best) AS g, max(gene) FILTER (mates = best) AS gene FROM b GROUP BY ALL)
"""


@query(
    "pair_counts",
    ("v_pair_align", "v_exon"),
    PAIR_SQL + _tally_sql("unassigned_nofeatures", "unassigned_ambiguity", "unassigned_multimapping"),
)
def pair_counts(spark, sf):
    return counting.feature_counts(v.pair_align(spark, sf), v.exons(spark, sf))


HTSEQ_EXTRA = """
  UNION ALL SELECT sample, 'qc', 'too_low_aQual', 1 FROM nh WHERE n = 1 AND mq < 10"""


@query(
    "htseq_union",
    ("v_align", "v_exon"),
    _single_sql("AND e.strand = a.strand", "AND mq >= 10")
    + _tally_sql("no_feature", "ambiguous", "alignment_not_unique", HTSEQ_EXTRA),
)
def htseq_union(spark, sf):
    return counting.htseq_counts(_single(spark, sf), v.exons(spark, sf))


LENGTHS_SQL = f"""WITH nh AS (SELECT sample, read_id, count(*) AS n, min(mapq) AS mq FROM v_align GROUP BY ALL),
u AS (SELECT a.* FROM v_align a JOIN nh USING (sample, read_id) WHERE n = 1 AND mq >= 10),
l AS (SELECT a.sample, a.read_id, a.end0 - a.start0 AS len, e.gene,
    CAST(sum(least(a.end0, e.end0) - greatest(a.start0, e.start0)) AS BIGINT) AS bases
  FROM u a LEFT JOIN v_exon e ON {OVERLAP} AND e.strand = a.strand GROUP BY ALL),
m AS (SELECT chrom_id, strand, start0, end0, max(end0) OVER (PARTITION BY chrom_id, strand ORDER BY start0, end0
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM v_exon),
i AS (SELECT *, sum(CASE WHEN seen IS NULL OR start0 > seen THEN 1 ELSE 0 END) OVER (PARTITION BY chrom_id, strand
  ORDER BY start0, end0 ROWS UNBOUNDED PRECEDING) AS k FROM m),
s AS (SELECT chrom_id, strand, min(start0) AS start0, max(end0) AS end0 FROM i GROUP BY chrom_id, strand, k),
c AS (SELECT a.sample, a.read_id, CAST(coalesce(sum(least(a.end0, e.end0) - greatest(a.start0, e.start0)), 0) AS BIGINT) AS covered
  FROM u a LEFT JOIN s e ON {OVERLAP} AND e.strand = a.strand GROUP BY ALL),
"""


@query(
    "htseq_strict",
    ("v_align", "v_exon"),
    LENGTHS_SQL
    + """o AS (SELECT sample, read_id, count(gene) FILTER (bases = len) AS g, max(gene) FILTER (bases = len) AS gene FROM l GROUP BY ALL)
"""
    + _tally_sql("no_feature", "ambiguous", "alignment_not_unique", HTSEQ_EXTRA),
)
def htseq_strict(spark, sf):
    return counting.htseq_counts(_single(spark, sf), v.exons(spark, sf), mode="intersection-strict")


@query(
    "htseq_nonempty",
    ("v_align", "v_exon"),
    LENGTHS_SQL
    + """o AS (SELECT l.sample, l.read_id, count(gene) FILTER (bases = covered) AS g, max(gene) FILTER (bases = covered) AS gene
  FROM l JOIN c USING (sample, read_id) GROUP BY ALL)
"""
    + _tally_sql("no_feature", "ambiguous", "alignment_not_unique", HTSEQ_EXTRA),
)
def htseq_nonempty(spark, sf):
    return counting.htseq_counts(_single(spark, sf), v.exons(spark, sf), mode="intersection-nonempty")


def _star_sql(name: str, strand: str) -> str:
    return f"""SELECT a.sample, a.read_id, '{name}' AS col, count(DISTINCT gene) AS g, max(gene) AS gene
  FROM u a LEFT JOIN v_exon e ON {OVERLAP} {strand} GROUP BY ALL"""


STAR_SQL = f"""WITH nh AS (SELECT sample, read_id, count(*) AS n FROM v_align GROUP BY ALL),
u AS (SELECT a.* FROM v_align a JOIN nh USING (sample, read_id) WHERE n = 1),
o AS ({_star_sql("unstranded", "")} UNION ALL {_star_sql("first_strand", "AND e.strand = a.strand")}
  UNION ALL {_star_sql("second_strand", "AND e.strand <> a.strand")}),
t AS (SELECT sample, CASE WHEN g = 1 THEN 'gene' ELSE 'qc' END AS kind,
    CASE WHEN g = 0 THEN 'noFeature' WHEN g = 1 THEN gene ELSE 'ambiguous' END AS feature, col FROM o
  UNION ALL SELECT sample, 'qc', 'multimapping', c.col FROM nh, (SELECT unnest(['unstranded', 'first_strand', 'second_strand']) AS col) c WHERE n > 1),
r AS (SELECT sample, kind, feature, count(*) FILTER (col = 'unstranded') AS unstranded,
  count(*) FILTER (col = 'first_strand') AS first_strand, count(*) FILTER (col = 'second_strand') AS second_strand FROM t GROUP BY ALL)
"""


@query("star_counts", ("v_align", "v_exon"), STAR_SQL + "SELECT * FROM r")
def star_counts(spark, sf):
    return counting.star_counts(_single(spark, sf), v.exons(spark, sf))


@query(
    "star_strand_column",
    ("v_align", "v_exon"),
    STAR_SQL + "SELECT sample, kind, feature, second_strand AS cnt FROM r WHERE second_strand > 0",
)
def star_strand_column(spark, sf):
    return counting.strand_column(star_counts(spark, sf), "SECOND_READ_TRANSCRIPTION_STRAND")


@query(
    "no_feature_reads",
    ("v_align", "v_exon"),
    f"""SELECT read_id, sample, chrom_id, start0, end0 FROM v_align a
WHERE NOT EXISTS (SELECT 1 FROM v_exon e WHERE {OVERLAP})""",
)
def no_feature_reads(spark, sf):
    hits = v.align(spark, sf).select("read_id", "sample", "chrom_id", "start0", "end0")
    return counting.no_feature_reads(hits, v.exons(spark, sf))


# ---- quality figures -----------------------------------------------------------------------

CLASS_SQL = """WITH n AS (SELECT sample, read_id, count(*) AS n FROM v_align GROUP BY ALL)
"""


@query(
    "read_classes",
    "v_align",
    CLASS_SQL
    + """SELECT sample, count(*) AS input_reads, count(*) FILTER (n = 1) AS unique_reads,
  count(*) FILTER (n > 1 AND n <= 3) AS multi_reads, count(*) FILTER (n > 3) AS too_many_reads,
  CAST(0 AS BIGINT) AS unmapped_reads FROM n GROUP BY sample""",
)
def read_classes(spark, sf):
    return qc.read_classes(v.align(spark, sf), max_loci=3)


KNOWN_SQL = """WITH k AS (SELECT DISTINCT chrom_id, intron_s, intron_e FROM v_intron)
"""


@query(
    "known_splices",
    ("v_splice", "v_intron"),
    KNOWN_SQL
    + """SELECT s.sample, s.chrom_id, s.intron_s, s.intron_e, count(*) AS n, k.chrom_id IS NOT NULL AS annotated
FROM v_splice s LEFT JOIN k ON k.chrom_id = s.chrom_id AND k.intron_s = s.intron_s AND k.intron_e = s.intron_e GROUP BY ALL""",
)
def known_splices(spark, sf):
    counted = qc.junction_counts(v.splices(spark, sf), ["sample"])
    return qc.annotated_junctions(counted, v.introns(spark, sf))


SUMMARY_SQL = """WITH n AS (SELECT sample, read_id, count(*) AS n FROM v_align GROUP BY ALL),
k AS (SELECT DISTINCT chrom_id, intron_s, intron_e FROM v_intron),
s AS (SELECT s.sample, count(*) AS total, count(k.chrom_id) AS known FROM v_splice s
  LEFT JOIN k ON k.chrom_id = s.chrom_id AND k.intron_s = s.intron_s AND k.intron_e = s.intron_e GROUP BY s.sample),
r AS (SELECT sample, 'QC_STAR_Number_of_input_reads' AS feature, count(*) AS cnt FROM n GROUP BY ALL
  UNION ALL SELECT sample, 'QC_STAR_Uniquely_mapped_reads_number', count(*) FILTER (n = 1) FROM n GROUP BY ALL
  UNION ALL SELECT sample, 'QC_STAR_Number_of_reads_mapped_to_multiple_loci', count(*) FILTER (n > 1 AND n <= 10) FROM n GROUP BY ALL
  UNION ALL SELECT sample, 'QC_STAR_Number_of_reads_mapped_to_too_many_loci', count(*) FILTER (n > 10) FROM n GROUP BY ALL
  UNION ALL SELECT sample, 'QC_STAR_Number_of_splices:_Total', total FROM s
  UNION ALL SELECT sample, 'QC_STAR_Number_of_splices:_Annotated_(sjdb)', known FROM s)
"""


@query("aligner_summary", ("v_align", "v_splice", "v_intron"), SUMMARY_SQL + "SELECT sample, 'qc' AS kind, feature, cnt FROM r")
def aligner_summary(spark, sf):
    return qc.aligner_summary(v.align(spark, sf), v.splices(spark, sf), v.introns(spark, sf))


@query(
    "pair_summary",
    "v_pair_align",
    """WITH c AS (SELECT sample, read_id, chrom_id, count(*) FILTER (mate = 1) AS n1, count(*) FILTER (mate = 2) AS n2
  FROM v_pair_align GROUP BY ALL),
f AS (SELECT sample, read_id, CAST(sum(n1) AS BIGINT) AS n1, CAST(sum(n2) AS BIGINT) AS n2,
  CAST(sum(least(n1, n2)) AS BIGINT) AS t FROM c GROUP BY ALL),
g AS (SELECT *, n1 > 0 AND n2 > 0 AS pair FROM f),
m AS (SELECT sample, n1 AS n FROM g WHERE pair AND t = 0 UNION ALL SELECT sample, n2 FROM g WHERE pair AND t = 0
  UNION ALL SELECT sample, greatest(n1, n2) FROM g WHERE NOT pair),
a AS (SELECT sample, count(*) FILTER (n = 0) AS mates_0, count(*) FILTER (n = 1) AS mates_1, count(*) FILTER (n > 1) AS mates_more FROM m GROUP BY sample),
b AS (SELECT sample, count(*) AS fragments, count(*) FILTER (pair) AS pairs, count(*) FILTER (pair AND t = 0) AS concordant_0,
  count(*) FILTER (pair AND t = 1) AS concordant_1, count(*) FILTER (pair AND t > 1) AS concordant_more FROM g GROUP BY sample)
SELECT b.*, mates_0, mates_1, mates_more FROM b JOIN a USING (sample)""",
)
def pair_summary(spark, sf):
    return qc.pair_summary(v.pair_align(spark, sf))


# The reference classes as disjoint stretches, by a sweep over all region ends.
CLASSES_SQL = """WITH ev AS (SELECT chrom_id, start0 AS pos, base_class, 1 AS d FROM v_regions
  UNION ALL SELECT chrom_id, end0, base_class, -1 FROM v_regions),
g AS (SELECT chrom_id, pos, sum(d) FILTER (base_class = 'coding') AS c, sum(d) FILTER (base_class = 'utr') AS u,
  sum(d) FILTER (base_class = 'intronic') AS i FROM ev GROUP BY ALL),
r AS (SELECT chrom_id, pos, lead(pos) OVER w AS nxt, coalesce(sum(c) OVER w, 0) AS c, coalesce(sum(u) OVER w, 0) AS u,
  coalesce(sum(i) OVER w, 0) AS i FROM g WINDOW w AS (PARTITION BY chrom_id ORDER BY pos)),
s AS (SELECT chrom_id, pos AS start0, nxt AS end0, CASE WHEN c > 0 THEN 'coding' WHEN u > 0 THEN 'utr' ELSE 'intronic' END AS base_class
  FROM r WHERE c > 0 OR u > 0 OR i > 0),
"""
BASES_SQL = (
    CLASSES_SQL
    + f"""x AS (SELECT a.sample, base_class, CAST(sum(least(a.end0, e.end0) - greatest(a.start0, e.start0)) AS BIGINT) AS n
  FROM v_align a JOIN s e ON {OVERLAP} GROUP BY ALL),
t AS (SELECT sample, CAST(sum(end0 - start0) AS BIGINT) AS total FROM v_align GROUP BY sample),
p AS (SELECT t.sample, total AS pf_aligned_bases, coalesce(max(n) FILTER (base_class = 'coding'), 0) AS coding_bases,
  coalesce(max(n) FILTER (base_class = 'utr'), 0) AS utr_bases, coalesce(max(n) FILTER (base_class = 'intronic'), 0) AS intronic_bases
  FROM t LEFT JOIN x USING (sample) GROUP BY ALL)
"""
)


@query(
    "base_classes",
    ("v_align", "v_regions"),
    BASES_SQL + "SELECT *, pf_aligned_bases - coding_bases - utr_bases - intronic_bases AS intergenic_bases FROM p",
)
def base_classes(spark, sf):
    return qc.base_classes(v.align(spark, sf), v.regions(spark, sf))


@query(
    "strand_reads",
    ("v_align", "v_exon"),
    f"""WITH x AS (SELECT a.sample, a.read_id, a.mate, CASE WHEN a.mate = 1 THEN a.strand = e.strand ELSE a.strand <> e.strand END AS ok
  FROM v_align a JOIN v_exon e ON {OVERLAP}),
r AS (SELECT sample, read_id, mate, min(ok) AS lo, max(ok) AS hi FROM x GROUP BY ALL)
SELECT sample, count(*) FILTER (lo) AS correct_strand_reads, count(*) FILTER (NOT hi) AS incorrect_strand_reads FROM r GROUP BY sample""",
)
def strand_reads(spark, sf):
    return qc.strand_reads(v.align(spark, sf), v.exons(spark, sf), "FIRST_READ_TRANSCRIPTION_STRAND")


@query(
    "qc_union",
    ("v_counts", "v_align", "v_regions"),
    BASES_SQL
    + """, z AS (SELECT *, pf_aligned_bases - coding_bases - utr_bases - intronic_bases AS intergenic_bases FROM p)
SELECT sample, CASE WHEN starts_with(feature, 'QC_') THEN 'qc' ELSE 'gene' END AS kind, feature, CAST(sum(cnt) AS BIGINT) AS cnt
FROM v_counts GROUP BY ALL
UNION ALL SELECT sample, 'qc', concat('QC_picard_', name), value FROM (UNPIVOT z ON COLUMNS(* EXCLUDE sample)) u""",
)
def qc_union(spark, sf):
    genes = matrix.sum_counts(matrix.with_kind(v.counts(spark, sf)), ["sample", "kind", "feature"])
    return matrix.union_counts(genes, qc.base_class_records(base_classes(spark, sf)))


MOTIF_VIEW = """WITH j AS (SELECT chrom_id, seq, 100 * k + 10 AS intron_s, least(100 * k + 90, length(seq)) AS intron_e
  FROM (SELECT chrom_id, seq, unnest(range(0, (length(seq) + 99) // 100)) AS k FROM v_genome) w WHERE 100 * k + 14 <= length(seq)),
m AS (SELECT chrom_id, intron_s, intron_e, concat(substring(seq, intron_s + 1, 2), substring(seq, intron_e - 1, 2)) AS x FROM j)
"""


@query(
    "splice_motifs",
    "v_genome",
    MOTIF_VIEW
    + """SELECT chrom_id, intron_s, intron_e, CASE WHEN x IN ('GTAG', 'CTAC') THEN 'GT/AG' WHEN x IN ('GCAG', 'CTGC') THEN 'GC/AG'
  WHEN x IN ('ATAC', 'GTAT') THEN 'AT/AC' ELSE 'Non-canonical' END AS motif FROM m""",
)
def splice_motifs(spark, sf):
    sequences = v.genome(spark, sf)
    junctions = (
        sequences.filter("length(seq) > 0")
        .selectExpr("chrom_id", "length(seq) AS n", "explode(sequence(0, (length(seq) - 1) div 100)) AS k")
        .filter("100 * k + 14 <= n")
        .selectExpr("chrom_id", "cast(100 * k + 10 as bigint) AS intron_s", "cast(least(100 * k + 90, n) as bigint) AS intron_e")
    )
    return qc.splice_motifs(junctions, sequences)


# ---- mapping -------------------------------------------------------------------------------

SEED, STRIDE = mapping.SEED, mapping.STEP


@query(
    "kmer_map",
    ("v_reads1", "v_genome"),
    f"""WITH d AS (SELECT seq, min(chrom_id) AS chrom_id, count(*) AS copies FROM v_genome GROUP BY seq),
t AS (SELECT chrom_id, p AS pos, substring(seq, p + 1, {SEED}) AS kmer FROM (SELECT chrom_id, seq,
  unnest(range(0, length(seq) - {SEED} + 1)) AS p FROM d) x WHERE NOT contains(kmer, 'N')),
r AS (SELECT DISTINCT seq FROM v_reads1 WHERE length(seq) >= {SEED}),
b AS (SELECT seq, '+' AS strand, seq AS bases FROM r UNION ALL SELECT seq, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM r),
s AS (SELECT seq, strand, o, substring(bases, o + 1, {SEED}) AS kmer FROM (SELECT seq, strand, bases,
  unnest(range(0, length(seq) - {SEED} + 1, {STRIDE})) AS o FROM b) y WHERE NOT contains(kmer, 'N')),
v AS (SELECT seq, chrom_id, strand, pos - o AS diagonal, count(*) AS votes FROM s JOIN t USING (kmer) GROUP BY ALL HAVING count(*) >= 2),
w AS (SELECT v.*, count(*) OVER (PARTITION BY v.seq, votes) = 1 AND copies = 1 AS alone FROM v JOIN d USING (chrom_id)
  QUALIFY row_number() OVER (PARTITION BY v.seq ORDER BY votes DESC, chrom_id, strand, diagonal) = 1)
SELECT a.sample, a.ordinal, w.chrom_id, w.strand, w.diagonal, w.votes, w.alone FROM v_reads1 a LEFT JOIN w ON w.seq = a.seq""",
)
def kmer_map(spark, sf):
    table = v.reads1(spark, sf).select("sample", "ordinal", "seq")
    return mapping.map_reads(table, v.genome(spark, sf)).drop("seq")


@query(
    "indexed_map",
    ("v_genome", "v_greads"),
    f"""WITH d AS (SELECT seq, min(chrom_id) AS chrom_id, count(*) AS copies FROM v_genome WHERE seq IS NOT NULL GROUP BY seq),
q AS (SELECT DISTINCT seq FROM v_greads),
b AS (SELECT chrom_id AS name, '' AS read, '+' AS strand, seq AS bases FROM d
  UNION ALL SELECT -1, seq, '+', seq FROM q UNION ALL SELECT -1, seq, '-', reverse(translate(seq, 'ACGT', 'TGCA')) FROM q),
p AS (SELECT name, read, strand, p, last, CASE WHEN contains(kmer, 'N') THEN 'Z' ELSE translate(kmer, 'ACGT', 'GTAC') END AS kmer
  FROM (SELECT name, read, strand, p, length(bases) - {SEED} AS last, substring(bases, p + 1, {SEED}) AS kmer
    FROM (SELECT *, unnest(range(0, length(bases) - {SEED} + 1)) AS p FROM b))),
m AS (SELECT DISTINCT name, read, strand, best[1:{SEED}] AS kmer, CAST(best[{SEED} + 1:] AS BIGINT) AS at
  FROM (SELECT name, read, strand, p, last, min(concat(kmer, lpad(CAST(p AS VARCHAR), 12, '0'))) OVER
      (PARTITION BY name, read, strand ORDER BY p ROWS BETWEEN CURRENT ROW AND {seed_index.WINDOW - 1} FOLLOWING) AS best FROM p)
  WHERE p <= last - {seed_index.WINDOW - 1} AND best NOT LIKE 'Z%'),
v AS (SELECT a.read AS seq, r.name AS chrom_id, a.strand, r.at - a.at AS diagonal, count(*) AS votes
  FROM m a JOIN m r USING (kmer) WHERE a.name = -1 AND r.name >= 0 GROUP BY ALL HAVING count(*) >= {seed_index.MIN_VOTES}),
w AS (SELECT v.*, sum(copies) OVER (PARTITION BY v.seq, votes) AS n_places FROM v JOIN d USING (chrom_id)
  QUALIFY row_number() OVER (PARTITION BY v.seq ORDER BY votes DESC, chrom_id, strand, diagonal) = 1)
SELECT a.sample, a.ordinal, w.chrom_id, w.strand, w.diagonal, w.votes, CAST(w.n_places AS BIGINT) AS n_places
FROM v_greads a LEFT JOIN w ON w.seq = a.seq""",
)
def indexed_map(spark, sf):
    name = f"seeds_{uuid.uuid4().hex}"
    seed_index.build_index(v.genome(spark, sf), name, scratch_path(spark, "seeds"))
    return seed_index.map_reads_indexed(v.genome_reads(spark, sf), spark.table(name)).drop("seq")


@query(
    "best_hit",
    "v_align",
    """SELECT sample, read_id, chrom_id, start0, end0, mapq, count(*) OVER (PARTITION BY sample, read_id) AS n_hits FROM v_align
QUALIFY row_number() OVER (PARTITION BY sample, read_id ORDER BY mapq DESC, chrom_id, start0, end0) = 1""",
)
def best_hit(spark, sf):
    hits = v.align(spark, sf).select("sample", "read_id", "chrom_id", "start0", "end0", "mapq")
    return mapping.best_hit(hits, ["sample", "read_id"], ["mapq"], ["chrom_id", "start0", "end0"])


@query(
    "qc_totals",
    "v_counts",
    """WITH q AS (SELECT string_split(feature, '_')[2] AS tool, string_split(feature, '_')[3] AS figure, cnt FROM v_counts
  WHERE starts_with(feature, 'QC_'))
SELECT tool, figure, CAST(grouping_id(tool, figure) AS BIGINT) AS level, count(*) AS n_records, CAST(sum(cnt) AS BIGINT) AS cnt,
  min(cnt) AS least, max(cnt) AS most FROM q GROUP BY ROLLUP (tool, figure)""",
)
def qc_totals(spark, sf):
    return qc.qc_totals(v.counts(spark, sf))
