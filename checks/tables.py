"""Checked queries: counts, matrix, manifests, reads and cleaning."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from readframe.functions.text import part_key
from readframe.operators import edit_tail, hooks, matrix, reads, trim
from readframe.sources import manifest as mf
from readframe.sources import parts as pt

SAMPLES = [f"cell{i}" for i in range(8)]


@query("sum_counts", "v_counts", "SELECT sample, feature, CAST(sum(cnt) AS BIGINT) AS cnt FROM v_counts GROUP BY ALL")
def sum_counts(spark, sf):
    return matrix.sum_counts(v.counts(spark, sf))


@query(
    "count_matrix",
    "v_counts",
    "SELECT feature, "
    + ", ".join(f"CAST(sum(CASE WHEN sample = '{s}' THEN cnt END) AS BIGINT) AS {s}" for s in SAMPLES)
    + " FROM v_counts GROUP BY feature",
)
def count_matrix(spark, sf):
    return matrix.count_matrix(v.counts(spark, sf), SAMPLES)


@query(
    "counts_map",
    "v_counts",
    """SELECT feature, count(*) AS n_samples, string_agg(concat(sample, '=', CAST(cnt AS VARCHAR)), ',' ORDER BY sample) AS counts
FROM (SELECT sample, feature, CAST(sum(cnt) AS BIGINT) AS cnt FROM v_counts GROUP BY ALL) s GROUP BY feature""",
)
def counts_map(spark, sf):
    entries = F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")))
    return matrix.counts_map(v.counts(spark, sf)).select(
        "feature", F.size("counts").cast("bigint").alias("n_samples"), F.array_join(entries, ",").alias("counts")
    )


@query(
    "qc_gene_split",
    "v_counts",
    """SELECT CASE WHEN starts_with(feature, 'QC_') THEN 'qc' ELSE 'gene' END AS kind, feature, CAST(sum(cnt) AS BIGINT) AS cnt
FROM v_counts GROUP BY ALL""",
)
def qc_gene_split(spark, sf):
    genes, qc = matrix.split_kinds(v.counts(spark, sf))
    return matrix.union_counts(
        matrix.sum_counts(genes, ["kind", "feature"]), matrix.sum_counts(qc, ["kind", "feature"])
    )


@query(
    "cpm",
    "v_counts",
    """WITH g AS (SELECT sample, feature, CAST(sum(cnt) AS BIGINT) AS cnt FROM v_counts
  WHERE NOT starts_with(feature, 'QC_') GROUP BY ALL)
SELECT sample, feature, cnt, round(cnt / sum(cnt) OVER (PARTITION BY sample) * 1e6, 4) AS cpm FROM g""",
)
def cpm(spark, sf):
    genes, _ = matrix.split_kinds(v.counts(spark, sf))
    return matrix.cpm(genes).withColumn("cpm", F.round("cpm", 4))


@query(
    "sorted_features",
    "v_counts",
    "SELECT feature, CAST(sum(cnt) AS BIGINT) AS cnt FROM v_counts GROUP BY feature ORDER BY feature",
)
def sorted_features(spark, sf):
    return matrix.sorted_matrix(matrix.sum_counts(v.counts(spark, sf), ["feature"]))


MANIFEST_SQL = """WITH f AS (SELECT manifest_line, string_split_regex(trim(value), '\\s+') AS files FROM v_manifest)
"""


@query(
    "manifest_check",
    "v_manifest",
    MANIFEST_SQL
    + """SELECT manifest_line, array_to_string(files, ' ') AS files, len(files) = 2 AS paired, len(files) IN (1, 2) AS valid FROM f""",
)
def manifest_check(spark, sf):
    return mf.parse_manifest(v.manifest(spark, sf)).withColumn("files", F.array_join("files", " "))


@query(
    "input_inventory",
    "v_manifest",
    MANIFEST_SQL
    + """SELECT count(*) AS n_lines, CAST(sum(CASE WHEN len(files) <= 2 THEN len(files) ELSE 0 END) AS BIGINT) AS n_files,
  count(*) FILTER (len(files) = 2) AS n_paired, count(*) FILTER (len(files) = 1) AS n_single,
  count(*) FILTER (len(files) > 2) AS n_invalid FROM f""",
)
def input_inventory(spark, sf):
    return mf.inventory(mf.parse_manifest(v.manifest(spark, sf)))


@query(
    "manifest_files",
    "v_manifest",
    MANIFEST_SQL
    + """SELECT regexp_replace(files[1], '\\.fastq\\.gz$', '') AS sample, CAST(i AS INT) AS mate, files[i] AS file_name
FROM (SELECT files, unnest(range(1, len(files) + 1)) AS i FROM f WHERE len(files) <= 2) t""",
)
def manifest_files(spark, sf):
    """Files of the usable lines; the others, which the job refuses, are in ``manifest_check``."""
    return mf.manifest_files(mf.parse_manifest(v.manifest(spark, sf)).filter("valid"))


@query(
    "accession_files",
    "v_manifest",
    MANIFEST_SQL
    + """SELECT concat('S', CAST(manifest_line AS VARCHAR)) AS accession,
  CASE WHEN n IN (1, 2) THEN array_to_string(own, ' ') END AS files, n AS n_files, n IN (1, 2) AS valid
FROM (SELECT manifest_line, own, CAST(len(own) AS BIGINT) AS n FROM (SELECT manifest_line,
  list_sort(list_filter(files, lambda x: starts_with(x, concat('S', CAST(manifest_line AS VARCHAR))))) AS own FROM f) a) b""",
)
def accession_files(spark, sf):
    listing = mf.parse_manifest(v.manifest(spark, sf)).select(
        F.concat(F.lit("S"), F.col("manifest_line").cast("string")).alias("accession"),
        F.explode("files").alias("file_name"),
    )
    return mf.accession_files(listing).withColumn("files", F.array_join("files", " "))


@query(
    "accession_path",
    "v_acc",
    """SELECT accession, concat(substring(accession, 1, 6), CASE WHEN length(d) > 6
  THEN concat('/', lpad(substring(d, 7), 3, '0')) ELSE '' END, '/', accession) AS path
FROM (SELECT accession, regexp_replace(accession, '[^0-9]', '', 'g') AS d FROM v_acc) a""",
)
def accession_path(spark, sf):
    return mf.accession_paths(v.accessions(spark, sf))


@query(
    "part_name_key",
    "v_counts",
    "SELECT DISTINCT concat(sample, '_1') AS sample, part_no FROM v_counts",
)
def part_name_key(spark, sf):
    path = F.concat(F.lit("out/"), "sample", F.lit("_1_part"), F.col("part_no").cast("string"), F.lit(".fastq.gz"))
    return v.counts(spark, sf).select(part_key(path).alias("k")).select("k.*").distinct()


@query(
    "mate_zip",
    ("v_reads1", "v_reads2"),
    """SELECT a.sample, a.ordinal, a.seq AS seq1, coalesce(b.seq, '') AS seq2, b.ordinal IS NULL AS mate_missing
FROM v_reads1 a LEFT JOIN v_reads2 b ON a.sample = b.sample AND a.ordinal = b.ordinal""",
)
def mate_zip(spark, sf):
    zipped = reads.zip_mates(v.reads1(spark, sf), v.reads2(spark, sf))
    return zipped.select(
        "sample", "ordinal", F.col("r1.seq").alias("seq1"), F.col("r2.seq").alias("seq2"), "mate_missing"
    )


LAST_SQL = """WITH l AS (SELECT * FROM v_reads1 QUALIFY row_number() OVER (PARTITION BY sample, dup_key ORDER BY ordinal DESC) = 1)
"""


@query("last_wins", "v_reads1", LAST_SQL + "SELECT sample, dup_key, ordinal, seq, qual FROM l")
def last_wins(spark, sf):
    table = v.reads1(spark, sf).select("sample", "dup_key", "ordinal", "seq", "qual")
    return reads.last_per_key(table, ["sample", "dup_key"], "ordinal")


@query(
    "repair_pairs",
    ("v_reads1", "v_reads2"),
    LAST_SQL
    + """SELECT b.sample, b.dup_key, b.ordinal, l.read_id AS id1, b.read_id AS id2, l.seq AS seq1, b.seq AS seq2
FROM v_reads2 b JOIN l ON l.sample = b.sample AND l.dup_key = b.dup_key""",
)
def repair_pairs(spark, sf):
    joined = reads.repair_pairs(v.reads1(spark, sf), v.reads2(spark, sf), ["sample", "dup_key"])
    return joined.select(
        "sample", "dup_key", "ordinal", F.col("r1.read_id").alias("id1"), F.col("r2.read_id").alias("id2"),
        F.col("r1.seq").alias("seq1"), F.col("r2.seq").alias("seq2"),
    )


ROWS_SQL = """WITH n AS (SELECT *, len(string_split(value, chr(9))) AS w FROM v_rows),
p AS (SELECT *, first_value(w) OVER (PARTITION BY sample ORDER BY ordinal) AS first_w FROM n)
"""


@query(
    "pair_detect",
    "v_rows",
    ROWS_SQL + "SELECT DISTINCT sample, CAST(first_w AS INT) AS n_fields, first_w = 8 AS paired FROM p",
)
def pair_detect(spark, sf):
    return pt.first_rows(v.rows(spark, sf), ["sample"])


@query(
    "first_row_probe",
    "v_rows",
    "SELECT sample, ordinal, value FROM v_rows QUALIFY row_number() OVER (PARTITION BY sample ORDER BY ordinal) = 1",
)
def first_row_probe(spark, sf):
    return pt.first_lines(v.rows(spark, sf), ["sample"])


@query(
    "interleave_roundtrip",
    "v_rows",
    ROWS_SQL
    + """SELECT sample, ordinal, CASE WHEN w = 7 THEN concat(value, chr(9)) ELSE value END AS value
FROM p WHERE first_w <> 8 OR w = 8""",
)
def interleave_roundtrip(spark, sf):
    parsed = pt.parse_rows(v.rows(spark, sf), ["sample"])
    single = pt.row_text()
    return pt.kept_rows(parsed).select("sample", "ordinal", single.alias("value"))


@query(
    "deinterleaved_reads",
    "v_rows",
    ROWS_SQL
    + """, k AS (SELECT sample, ordinal, first_w, string_split(value, chr(9)) AS f FROM p WHERE first_w <> 8 OR w = 8)
SELECT sample, ordinal, 1 AS mate, f[1] AS read_id, f[2] AS seq, f[4] AS qual FROM k
UNION ALL SELECT sample, ordinal, CASE WHEN first_w = 8 THEN 2 ELSE 1 END, f[5], f[6], coalesce(f[8], '')
FROM k WHERE len(f) > 4""",
)
def deinterleaved_reads(spark, sf):
    parsed = pt.kept_rows(pt.parse_rows(v.rows(spark, sf), ["sample"]))
    return pt.as_reads(parsed, ["sample"]).drop("plus")


@query(
    "malformed_filter",
    "v_rows",
    ROWS_SQL + "SELECT sample, count(*) FILTER (first_w = 8 AND w <> 8) AS cnt FROM p GROUP BY sample",
)
def malformed_filter(spark, sf):
    return pt.dropped_rows(pt.parse_rows(v.rows(spark, sf), ["sample"]), ["sample"])


LIMIT = 4096
PARTS_SQL = f"""WITH s AS (SELECT sample, ordinal, length(read_id) + 2 * length(seq) + 5 AS row_bytes FROM v_reads1),
b AS (SELECT *, coalesce(sum(row_bytes) OVER (PARTITION BY sample ORDER BY ordinal
  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS bytes_before FROM s),
n AS (SELECT sample, ordinal, CAST(bytes_before AS BIGINT) AS bytes_before, CAST(bytes_before // {LIMIT} AS INT) AS part_no FROM b)
"""


def _numbered(spark, sf):
    size = F.expr("length(read_id) + 2 * length(seq) + 5")
    return reads.number_parts(v.reads1(spark, sf).select("sample", "ordinal", size.alias("row_bytes")), limit=LIMIT)


@query("part_numbers", "v_reads1", PARTS_SQL + "SELECT * FROM n")
def part_numbers(spark, sf):
    return _numbered(spark, sf).drop("row_bytes")


@query(
    "part_report",
    "v_reads1",
    PARTS_SQL
    + "SELECT concat(sample, '_part', CAST(part_no AS VARCHAR), '.fastq.gz') AS part_name, count(*) AS records FROM n GROUP BY ALL",
)
def part_report(spark, sf):
    return reads.part_report(_numbered(spark, sf))


@query(
    "parts_by_sample",
    "v_counts",
    """SELECT sample, string_agg(concat(sample, '_part', CAST(part_no AS VARCHAR)), ',' ORDER BY part_no) AS part_names
FROM (SELECT DISTINCT sample, part_no FROM v_counts) p GROUP BY sample""",
)
def parts_by_sample(spark, sf):
    name = F.concat("sample", F.lit("_part"), F.col("part_no").cast("string"))
    table = reads.parts_by_sample(v.counts(spark, sf).select("sample", "part_no", name.alias("part_name")).distinct())
    return table.withColumn("part_names", F.array_join("part_names", ","))


# ---- cleaning ------------------------------------------------------------------------------

TRIM_COLUMNS = ["sample", "ordinal", "seq", "qual"]


def _trimmed(spark, sf, *steps):
    pairs = v.reads1(spark, sf).select(
        "sample", "ordinal", F.struct("read_id", "seq", F.lit("+").alias("plus"), "qual").alias("r1")
    ).withColumn("r2", F.expr("if(false, r1, null)"))
    out = trim.trim_pairs(pairs, steps)
    return trim.survivors(out).select("sample", "ordinal", F.col("r1.seq").alias("seq"), F.col("r1.qual").alias("qual"))


def _trim_query(name, sql, *make):
    @query(name, "v_reads1", sql)
    def run(spark, sf):
        return _trimmed(spark, sf, *[m() for m in make])

    return run


_trim_query(
    "trim_leading",
    """SELECT sample, ordinal, substring(seq, n + 1) AS seq, substring(qual, n + 1) AS qual
FROM (SELECT *, length(qual) - length(ltrim(qual, '!"#')) AS n FROM v_reads1) t""",
    lambda: trim.leading(3),
)
_trim_query(
    "trim_trailing",
    """SELECT sample, ordinal, substring(seq, 1, n) AS seq, substring(qual, 1, n) AS qual
FROM (SELECT *, length(rtrim(qual, '!"#')) AS n FROM v_reads1) t""",
    lambda: trim.trailing(3),
)
QUALITY_SQL = "list_transform(range(1, length(qual) + 1), lambda i: ascii(substring(qual, i, 1)) - 33)"
_trim_query(
    "trim_qual_right",
    f"""WITH q AS (SELECT *, {QUALITY_SQL} AS q FROM v_reads1),
n AS (SELECT *, coalesce(list_max(list_filter(range(1, length(qual) + 1), lambda i: q[i] >= 25)), 0) AS n FROM q)
SELECT sample, ordinal, substring(seq, 1, n) AS seq, substring(qual, 1, n) AS qual FROM n""",
    lambda: trim.quality_right(25),
)
_trim_query(
    "trim_sliding",
    f"""WITH q AS (SELECT *, {QUALITY_SQL} AS q FROM v_reads1),
n AS (SELECT *, coalesce(list_min(list_filter(range(0, length(qual) - 3),
  lambda i: q[i + 1] + q[i + 2] + q[i + 3] + q[i + 4] < 60)), length(qual)) AS n FROM q)
SELECT sample, ordinal, substring(seq, 1, n) AS seq, substring(qual, 1, n) AS qual FROM n""",
    lambda: trim.sliding_window(4, 15),
)
_trim_query(
    "trim_minlen",
    "SELECT sample, ordinal, seq, qual FROM v_reads1 WHERE length(seq) >= 36",
    lambda: trim.min_length(36),
)
_trim_query(
    "trim_left",
    "SELECT sample, ordinal, substring(seq, 11) AS seq, substring(qual, 11) AS qual FROM v_reads1",
    lambda: trim.trim_left(10),
)

REPORT_STEPS = (lambda: trim.trim_left(10), lambda: trim.min_length(30), lambda: trim.quality_right(25), lambda: trim.min_length(36))


@query(
    "trim_report",
    ("v_reads1", "v_reads2"),
    f"""WITH r AS (SELECT a.sample, b.ordinal IS NOT NULL AS p, substring(a.qual, 11) AS q1, substring(b.qual, 11) AS q2
  FROM v_reads1 a LEFT JOIN v_reads2 b ON a.ordinal = b.ordinal),
l AS (SELECT sample, p, length(q1) AS a1, length(q2) AS a2,
  coalesce(list_max(list_filter(range(1, length(q1) + 1), lambda i: ascii(substring(q1, i, 1)) - 33 >= 25)), 0) AS b1,
  coalesce(list_max(list_filter(range(1, length(q2) + 1), lambda i: ascii(substring(q2, i, 1)) - 33 >= 25)), 0) AS b2 FROM r),
f AS (SELECT sample, p, a1 >= 30 AS x1, NOT p OR a2 >= 30 AS x2, b1 >= 36 AS y1, NOT p OR b2 >= 36 AS y2 FROM l),
s AS (SELECT sample, p, 1 AS step_no, x1 AS s1, x2 AS s2 FROM f
  UNION ALL SELECT sample, p, 3, y1, y2 FROM f WHERE x1 AND x2)
SELECT sample, step_no, 'min_length' AS step, count(*) AS n_in, count(*) FILTER (s1 AND s2) AS both,
  count(*) FILTER (p AND s1 AND NOT s2) AS r1_only, count(*) FILTER (p AND s2 AND NOT s1) AS r2_only,
  count(*) FILTER ((NOT s1 AND NOT s2) OR (NOT p AND NOT s1)) AS dropped FROM s GROUP BY ALL""",
)
def trim_report(spark, sf):
    steps = [make() for make in REPORT_STEPS]
    return trim.trim_report(trim.trim_pairs(v.pairs(spark, sf), steps), steps)


@query(
    "paired_minlen",
    ("v_reads1", "v_reads2"),
    """SELECT a.sample, a.ordinal, substring(a.seq, 11) AS seq1, substring(b.seq, 11) AS seq2
FROM v_reads1 a LEFT JOIN v_reads2 b ON a.ordinal = b.ordinal
WHERE length(a.seq) >= 40 AND (b.ordinal IS NULL OR length(b.seq) >= 40)""",
)
def paired_minlen(spark, sf):
    out = trim.survivors(trim.trim_pairs(v.pairs(spark, sf), [trim.trim_left(10), trim.min_length(30)]))
    return out.select("sample", "ordinal", F.col("r1.seq").alias("seq1"), F.col("r2.seq").alias("seq2"))


ADAPTERS = ["AGATGTGTATAAGAGACAG", v.ADAPTER]


@query(
    "trim_adapter",
    "v_adapter",
    """WITH a AS (SELECT unnest(['AGATGTGTATAAGAGACAG', 'CTGTCTCTTATACACATCTGACGCTGCCGACGA']) AS adapter),
o AS (SELECT sample, ordinal, seq, qual, adapter, unnest(range(0, length(seq))) AS off FROM v_adapter, a),
s AS (SELECT sample, ordinal, seq, off, least(length(adapter), length(seq) - off) AS n, adapter, qual FROM o),
w AS (SELECT *, list_filter(range(1, n + 1), lambda i: substring(adapter, i, 1) <> substring(seq, off + i, 1)) AS wrong FROM s),
g AS (SELECT sample, ordinal, min(off) AS cut FROM w
  WHERE len(list_filter(wrong, lambda i: i <= 16)) <= 2 AND 602 * (n - len(wrong))
    - 100 * coalesce(list_sum(list_transform(wrong, lambda i: ascii(substring(qual, off + i, 1)) - 33)), 0) >= 10000
  GROUP BY ALL)
SELECT v.sample, v.ordinal, substring(v.seq, 1, coalesce(cut, length(v.seq))) AS seq
FROM v_adapter v LEFT JOIN g ON g.ordinal = v.ordinal""",
)
def trim_adapter(spark, sf):
    clip = trim.clip_position_udf(ADAPTERS)
    table = v.adapter_reads(spark, sf)
    return table.select("sample", "ordinal", F.substr("seq", F.lit(1), clip("seq", "qual")).alias("seq"))


def _tail_sql(rate: float, overlap: int) -> str:
    return f"""WITH o AS (SELECT sample, ordinal, seq, unnest(range(0, length(seq))) AS off FROM v_adapter),
s AS (SELECT *, least(33, length(seq) - off) AS n FROM o),
w AS (SELECT *, len(list_filter(range(1, n + 1),
  lambda i: substring('{v.ADAPTER}', i, 1) <> substring(seq, off + i, 1))) AS wrong FROM s),
g AS (SELECT sample, ordinal, min(off) AS cut FROM w WHERE n >= {overlap} AND wrong <= floor({rate} * n + 1e-9) GROUP BY ALL)
SELECT v.sample, v.ordinal, substring(v.seq, 1, coalesce(cut, length(v.seq))) AS seq
FROM v_adapter v LEFT JOIN g ON g.ordinal = v.ordinal"""


@query("adapter_tail", "v_adapter", _tail_sql(0.15, 3))
def adapter_tail(spark, sf):
    tail = trim.tail_position_udf(v.ADAPTER, 0.15, 3)
    return v.adapter_reads(spark, sf).select("sample", "ordinal", F.substr("seq", F.lit(1), tail("seq")).alias("seq"))


@query("adapter_tail_strict", "v_adapter", _tail_sql(0.1, 1))
def adapter_tail_strict(spark, sf):
    tail = trim.tail_position_udf(v.ADAPTER, 0.1, 1)
    return v.adapter_reads(spark, sf).select("sample", "ordinal", F.substr("seq", F.lit(1), tail("seq")).alias("seq"))


# Of e + 1 disjoint pieces of one text, e edits leave a piece whole, so offsets without such a piece need no distance.
BLOCKS = [v.ADAPTER[i : i + 7] for i in range(0, len(v.ADAPTER), 7)]
EDITS_SQL = f"""WITH o AS (SELECT sample, ordinal, seq, unnest(range(0, length(seq))) AS off FROM v_adapter),
s AS (SELECT ordinal, off, least(33, length(seq) - off) AS n, substring(seq, CAST(off + 1 AS INT), 37) AS rest,
  length(seq) - off < 37 AS short FROM o),
p AS (SELECT *, CAST(floor(0.15 * n + 1e-9) AS INT) + 1 AS cuts FROM s WHERE n >= 3),
c AS (SELECT * FROM p WHERE len(list_filter({BLOCKS}, lambda b: contains(rest, b))) > 0
  OR short AND len(list_filter(range(0, cuts), lambda i: contains('{v.ADAPTER}', substring(rest,
    CAST(1 + i * length(rest) // cuts AS INT), CAST((i + 1) * length(rest) // cuts - i * length(rest) // cuts AS INT))))) > 0),
d AS (SELECT ordinal, off, n, least(list_min(list_transform(range(29, 38), lambda i: levenshtein('{v.ADAPTER}', substring(rest, 1, i)))),
  CASE WHEN short THEN list_min(list_transform(range(greatest(length(rest) - 4, 1), least(length(rest) + 4, 33) + 1),
    lambda i: levenshtein(substring('{v.ADAPTER}', 1, i), rest))) ELSE 99 END) AS dist FROM c),
g AS (SELECT ordinal, off, n - 2 * dist AS score FROM d WHERE dist <= floor(0.15 * n + 1e-9)),
f AS (SELECT ordinal, off FROM (SELECT *, min(off) OVER (PARTITION BY ordinal) AS head FROM g) h WHERE off <= head + 4
  QUALIFY row_number() OVER (PARTITION BY ordinal ORDER BY score DESC, off) = 1)
SELECT v.sample, v.ordinal, substring(v.seq, 1, CAST(coalesce(off, length(v.seq)) AS INT)) AS seq
FROM v_adapter v LEFT JOIN f ON f.ordinal = v.ordinal"""


@query("adapter_tail_edits", "v_adapter", EDITS_SQL)
def adapter_tail_edits(spark, sf):
    """Ends of the adapter with insertions and deletions: views.adapter_reads drops two of its letters in a quarter."""
    tail = edit_tail.edit_tail_udf(v.ADAPTER, 0.15, 3)
    return v.adapter_reads(spark, sf).select("sample", "ordinal", F.substr("seq", F.lit(1), tail("seq")).alias("seq"))


LOW = "'!\"#$%&''()*+,-./01234'"


@query(
    "third_cleaning",
    "v_reads1",
    f"""WITH t AS (SELECT sample, ordinal, substring(seq, 1, length(rtrim(qual, {LOW}))) AS seq, rtrim(qual, {LOW}) AS qual FROM v_reads1),
o AS (SELECT ordinal, seq, unnest(range(0, length(seq))) AS off FROM t),
s AS (SELECT *, least({len(trim.STANDARD_ADAPTER)}, length(seq) - off) AS n FROM o),
w AS (SELECT *, len(list_filter(range(1, n + 1),
  lambda i: substring('{trim.STANDARD_ADAPTER}', i, 1) <> substring(seq, off + i, 1))) AS wrong FROM s),
g AS (SELECT ordinal, min(off) AS cut FROM w WHERE wrong <= floor(0.1 * n + 1e-9) GROUP BY ALL)
SELECT t.sample, t.ordinal, substring(t.seq, 1, coalesce(cut, length(t.seq))) AS seq,
  substring(t.qual, 1, coalesce(cut, length(t.seq))) AS qual
FROM t LEFT JOIN g ON g.ordinal = t.ordinal WHERE coalesce(cut, length(t.seq)) >= 20""",
)
def third_cleaning(spark, sf):
    """The third tool's own steps, on single reads."""
    return _trimmed(spark, sf, *trim.galore_steps())


@query(
    "low_complexity",
    "v_reads1",
    """WITH s AS (SELECT sample, ordinal, seq, unnest(range(0, greatest(length(seq) - 64, 0) + 1, 32)) AS st FROM v_reads1),
w AS (SELECT sample, ordinal, st, substring(seq, i + 1, 3) AS word FROM (SELECT *,
  unnest(range(st, least(st + 62, length(seq) - 2))) AS i FROM s) x),
c AS (SELECT sample, ordinal, st, word, count(*) AS n FROM w GROUP BY ALL),
t AS (SELECT sample, ordinal, st, sum(n) AS total, sum(n * ln(n)) AS nln FROM c GROUP BY ALL),
e AS (SELECT sample, ordinal, CASE WHEN total < 2 THEN 0 ELSE (ln(total) - nln / total) / ln(least(total, 64)) * 100 END AS h FROM t),
m AS (SELECT sample, ordinal, avg(h) AS score FROM e GROUP BY ALL)
SELECT v.sample, v.ordinal, round(coalesce(score, 0), 4) AS score FROM v_reads1 v LEFT JOIN m ON m.ordinal = v.ordinal""",
)
def low_complexity(spark, sf):
    score = trim.entropy_udf()
    return v.reads1(spark, sf).select("sample", "ordinal", F.round(score("seq"), 4).alias("score"))


@query(
    "hook_map",
    "v_reads1",
    "SELECT sample, ordinal, lower(seq) AS seq, length(seq) AS n FROM v_reads1 WHERE length(seq) >= 20",
)
def hook_map(spark, sf):
    def shorten(batch):
        kept = batch[batch.seq.str.len() >= 20]
        return kept.assign(seq=kept.seq.str.lower(), n=kept.seq.str.len())

    table = v.reads1(spark, sf).select("sample", "ordinal", "seq")
    return hooks.map_reads(table, shorten, "sample string, ordinal bigint, seq string, n bigint")


@query(
    "hook_parts",
    "v_reads1",
    PARTS_SQL
    + """SELECT sample, part_no, count(*) AS n_rows, CAST(sum(row_bytes) AS BIGINT) AS n_bytes
FROM n JOIN s USING (sample, ordinal) GROUP BY ALL""",
)
def hook_parts(spark, sf):
    """A user function per part; the part numbers bound what one call sees."""
    import pandas as pd

    def totals(key, batches):
        rows = size = 0
        for batch in batches:
            rows, size = rows + len(batch), size + int(batch.row_bytes.sum())
        yield pd.DataFrame({"sample": [key[0]], "part_no": [key[1]], "n_rows": [rows], "n_bytes": [size]})

    return hooks.map_parts(
        _numbered(spark, sf), totals, "sample string, part_no int, n_rows bigint, n_bytes bigint"
    )


@query("standard_cleaning")
def standard_cleaning(spark, sf):
    """The first cleaning script as a whole chain on pairs."""
    out = trim.survivors(trim.trim_pairs(v.pairs(spark, sf), trim.trimmomatic_steps(ADAPTERS)))
    return out.select("sample", "ordinal", F.col("r1.seq").alias("seq1"), F.col("r2.seq").alias("seq2"))


@query("second_cleaning")
def second_cleaning(spark, sf):
    """The second cleaning script: all three tools in a row."""
    steps = [*trim.prinseq_steps(), *trim.cutadapt_steps(), *trim.galore_steps()]
    out = trim.survivors(trim.trim_pairs(v.pairs(spark, sf), steps))
    return out.select("sample", "ordinal", F.col("r1.seq").alias("seq1"), F.col("r2.seq").alias("seq2"))
