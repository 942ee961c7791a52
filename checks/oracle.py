"""The views and the expected results as SQL for DuckDB."""

from __future__ import annotations

# Every character of a text becomes a base: letters and blanks one of four, all else N.
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ "
BASES = ("ACGT" * 7)[:26] * 2 + "G"
# The quality of a base goes by its letter.
CALLED, QUALITIES = "ACGTN", "I5#?!"

VIEWS: dict[str, tuple[tuple[str, ...], str]] = {
    "v_counts": (
        (),
        """SELECT concat('cell', CAST(l_suppkey % 8 AS VARCHAR)) AS sample, l_linenumber AS part_no,
  CASE WHEN l_returnflag = 'R' THEN concat('QC_tool_', l_linestatus)
       ELSE concat('G', CAST(l_partkey % 150 AS VARCHAR)) END AS feature,
  CAST(l_quantity AS BIGINT) AS cnt FROM lineitem""",
    ),
    "v_manifest": (
        (),
        """SELECT c_custkey AS manifest_line,
  concat('S', CAST(c_custkey AS VARCHAR), '_1.fastq.gz',
    CASE WHEN c_custkey % 3 <> 0 THEN concat(chr(9), 'S', CAST(c_custkey AS VARCHAR), '_2.fastq.gz') ELSE '' END,
    CASE WHEN c_custkey % 50 = 49 THEN concat(chr(9), 'extra.fastq.gz') ELSE '' END) AS value FROM customer""",
    ),
    "v_acc": (
        (),
        """SELECT concat(CASE c_custkey % 3 WHEN 0 THEN 'SRR' WHEN 1 THEN 'ERR' ELSE 'DRR' END,
  CAST(CASE c_custkey % 4 WHEN 0 THEN 100000 + c_custkey WHEN 1 THEN 1000000 + c_custkey * 613
       WHEN 2 THEN 10000000 + c_custkey * 7919 ELSE 100000000 + c_custkey * 1047 END AS VARCHAR)) AS accession
FROM customer""",
    ),
    "v_genome": (
        (),
        f"""SELECT doc_id AS chrom_id, regexp_replace(translate(text, '{LETTERS}', '{BASES}'), '[^ACGT]', 'N', 'g') AS seq
FROM documents""",
    ),
    "v_greads": (
        ("v_genome",),
        """SELECT concat('cell', CAST((chrom_id + k) % 8 AS VARCHAR)) AS sample, chrom_id * 10000 + k AS ordinal,
  CASE WHEN (chrom_id + k) % 2 = 1 THEN reverse(translate(seq, 'ACGT', 'TGCA')) WHEN (chrom_id + k) % 5 = 0
    THEN concat(substring(seq, 1, 50), 'N', substring(seq, 52, 100)) ELSE seq END AS seq
FROM (SELECT chrom_id, k, substring(seq, CAST(1 + 100 * k AS INT), 100) AS seq
      FROM (SELECT chrom_id, seq, unnest(range(0, (length(seq) + 99) // 100)) AS k FROM v_genome) w) t""",
    ),
    "v_reads1": (
        ("v_genome",),
        f"""SELECT concat('cell', CAST(cell AS VARCHAR)) AS sample, ordinal, concat('@r', CAST(ordinal AS VARCHAR)) AS read_id,
  concat('k', CAST(ordinal % 300 AS VARCHAR)) AS dup_key, seq, translate(seq, '{CALLED}', '{QUALITIES}') AS qual
FROM (SELECT chrom_id * 10000 + k AS ordinal, (chrom_id + k) % 8 AS cell, substring(seq, CAST(1 + 100 * k AS INT), 100) AS seq
      FROM (SELECT chrom_id, seq, unnest(range(0, (length(seq) + 99) // 100)) AS k FROM v_genome) w) t""",
    ),
    "v_reads2": (
        ("v_reads1",),
        """SELECT sample, ordinal, read_id, dup_key, reverse(translate(seq, 'ACGT', 'TGCA')) AS seq, reverse(qual) AS qual
FROM v_reads1 WHERE right(seq, 1) <> 'G'""",
    ),
    "v_rows": (
        ("v_reads1", "v_reads2"),
        """SELECT a.sample, a.ordinal,
  CASE WHEN a.sample >= 'cell4' THEN concat_ws(chr(9), a.read_id, a.seq, '+', a.qual)
       WHEN b.ordinal IS NULL THEN concat_ws(chr(9), a.read_id, a.seq, '+', a.qual)
       WHEN a.ordinal % 11 = 10 THEN concat_ws(chr(9), a.read_id, a.seq, '+', a.qual, b.read_id, b.seq, '+')
       ELSE concat_ws(chr(9), a.read_id, a.seq, '+', a.qual, b.read_id, b.seq, '+', b.qual) END AS value
FROM v_reads1 a LEFT JOIN v_reads2 b ON a.ordinal = b.ordinal""",
    ),
    "v_adapter": (
        ("v_reads1",),
        f"""SELECT sample, ordinal, read_id, seq, translate(seq, '{CALLED}', '{QUALITIES}') AS qual FROM (
  SELECT sample, ordinal, read_id, concat(seq, CASE length(seq) % 4
    WHEN 0 THEN 'CTGTCTCTTATACACATCTGACGCTGCCGACGA' WHEN 1 THEN 'CTGTCTCTTATACACATCTG'
    WHEN 2 THEN 'CTGACTCTTATACACATCTGACGCTGCCGA' ELSE 'CTGT' END) AS seq FROM v_reads1) t""",
    ),
    "v_align": (
        (),
        """SELECT read_id, part_no, mate, sample, chrom_id, pos AS start0, pos + len AS end0, strand, mapq
FROM (SELECT l_orderkey * 8 + l_linenumber AS read_id, l_linenumber AS part_no, 1 + l_linenumber % 2 AS mate,
  concat('cell', CAST(l_orderkey % 8 AS VARCHAR)) AS sample, l_partkey % 10 AS chrom_id,
  (l_partkey // 10) * 6000 + (l_orderkey * 7919 + l_suppkey * 1299709 + l_linenumber * 611953) % 9000 AS pos,
  50 + CAST(l_quantity AS BIGINT) AS len, CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand,
  CAST(round(l_discount * 100) AS BIGINT) * 6 AS mapq FROM lineitem) t""",
    ),
    "v_pair_align": (
        ("v_align",),
        "SELECT * REPLACE ((read_id // 8) * 4 + (read_id % 8) // 2 AS read_id) FROM v_align",
    ),
    "v_exon": (
        (),
        """SELECT concat('G', CAST(p_partkey AS VARCHAR)) AS gene, p_partkey % 10 AS chrom_id, k AS exon_no,
  (p_partkey // 10) * 6000 + k * 3000 AS start0, (p_partkey // 10) * 6000 + k * 3000 + 400 + p_size * 20 AS end0,
  CASE WHEN p_size % 2 = 0 THEN '+' ELSE '-' END AS strand
FROM (SELECT *, unnest([0, 1, 2]) AS k FROM part) e""",
    ),
    "v_intron": (
        ("v_exon",),
        """SELECT a.gene, a.chrom_id, a.strand, a.end0 AS intron_s, b.start0 AS intron_e
FROM v_exon a JOIN v_exon b ON a.gene = b.gene AND b.exon_no = a.exon_no + 1""",
    ),
    "v_splice": (
        ("v_exon",),
        """SELECT l.l_orderkey * 8 + l.l_linenumber AS read_id, concat('cell', CAST(l.l_orderkey % 8 AS VARCHAR)) AS sample,
  a.gene, a.chrom_id, a.strand, a.end0 AS intron_s,
  b.start0 + CASE WHEN l.l_linenumber % 4 = 3 THEN (l.l_suppkey % 2) * 10 ELSE 0 END AS intron_e
FROM lineitem l JOIN v_exon a ON a.gene = concat('G', CAST(l.l_partkey AS VARCHAR)) JOIN v_exon b ON b.gene = a.gene
WHERE (l.l_linenumber % 4 IN (0, 2) AND a.exon_no = 0 AND b.exon_no = 1)
   OR (l.l_linenumber % 4 IN (1, 2) AND a.exon_no = 1 AND b.exon_no = 2)
   OR (l.l_linenumber % 4 = 3 AND a.exon_no = 0 AND b.exon_no = 2)""",
    ),
    "v_regions": (
        ("v_exon", "v_intron"),
        """SELECT chrom_id, start0, start0 + 100 AS end0, 'utr' AS base_class FROM v_exon WHERE exon_no = 0
UNION ALL SELECT chrom_id, CASE WHEN exon_no = 0 THEN start0 + 100 ELSE start0 END, end0, 'coding' FROM v_exon
UNION ALL SELECT chrom_id, intron_s, intron_e, 'intronic' FROM v_intron""",
    ),
    "v_chain": (
        ("v_splice",),
        """SELECT read_id, gene, chrom_id, strand,
  string_agg(concat(CAST(intron_s AS VARCHAR), '-', CAST(intron_e AS VARCHAR)), ',' ORDER BY intron_s, intron_e) AS chain,
  min(intron_s) AS start0, max(intron_e) AS end0
FROM (SELECT DISTINCT read_id, gene, chrom_id, strand, intron_s, intron_e FROM v_splice) d GROUP BY ALL""",
    ),
    "v_chrom": (
        (),
        """SELECT chrom_id, CASE chrom_id WHEN 7 THEN 'chrX' WHEN 8 THEN 'chrM' WHEN 9 THEN 'chrUn_1' WHEN 6 THEN 'chr1_alt'
  ELSE concat('chr', CAST(chrom_id + 1 AS VARCHAR)) END AS chrom, length
FROM (SELECT p_partkey % 10 AS chrom_id, max((p_partkey // 10) * 6000) + 20000 AS length FROM part GROUP BY 1) c""",
    ),
}


def with_views(names: tuple[str, ...], body: str) -> str:
    """``body`` behind the views it needs, in the order they build on each other."""
    needed: list[str] = []

    def add(name: str) -> None:
        for dep in VIEWS[name][0]:
            add(dep)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    head = ",\n".join(f"{name} AS ({VIEWS[name][1]})" for name in needed)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {head},\n{body[5:]}"
    return f"WITH {head}\n{body}"
