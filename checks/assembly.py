"""Checked queries: transcripts and their accuracy."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import views as v
from checks.registry import query
from readframe.operators import compare, transcripts
from readframe.operators.intervals import BIN_STEP
from readframe.session import settle


def text(chain="chain"):
    return F.array_join(
        F.transform(chain, lambda i: F.concat_ws("-", i["s"].cast("string"), i["e"].cast("string"))), ","
    )


def _chains(spark, sf):
    return transcripts.chains(transcripts.splice_fragments(v.splices(spark, sf), ["read_id", "gene"]))


CHAINS = """WITH c AS (SELECT chrom_id, strand, chain, count(*) AS support, min(start0) AS start0, max(end0) AS end0
  FROM v_chain GROUP BY ALL),
i AS (SELECT chrom_id, strand, chain, support, unnest(string_split(chain, ',')) AS intron FROM c),
n AS (SELECT chrom_id, strand, intron, CAST(sum(support) AS BIGINT) AS intron_support FROM i GROUP BY ALL),
weak AS (SELECT DISTINCT i.chrom_id, i.strand, i.chain FROM i JOIN n USING (chrom_id, strand, intron) WHERE intron_support < 2),
k AS (SELECT c.* FROM c ANTI JOIN weak USING (chrom_id, strand, chain)),
top AS (SELECT * FROM k a WHERE NOT EXISTS (SELECT 1 FROM k b WHERE b.chrom_id = a.chrom_id AND b.strand = a.strand
  AND b.chain <> a.chain AND contains(concat(',', b.chain, ','), concat(',', a.chain, ','))))
"""


@query("intron_chains", "v_chain", CHAINS + "SELECT * FROM c")
def intron_chains(spark, sf):
    return _chains(spark, sf).withColumn("chain", text())


@query("intron_support", "v_chain", CHAINS + "SELECT * FROM n")
def intron_support(spark, sf):
    pair = F.concat_ws("-", F.col("intron.s").cast("string"), F.col("intron.e").cast("string"))
    return transcripts.intron_support(_chains(spark, sf)).withColumn("intron", pair)


@query("supported_chains", "v_chain", CHAINS + "SELECT * FROM k")
def supported_chains(spark, sf):
    return transcripts.supported_chains(_chains(spark, sf)).withColumn("chain", text())


def _candidates(spark, sf, supported=None):
    """Maximal chains, with 100 bases of exon on both ends; ``supported`` where the caller has the supported chains already."""
    kept = transcripts.drop_contained(transcripts.supported_chains(_chains(spark, sf)) if supported is None else supported)
    return kept.withColumns({"start0": F.col("start0") - 100, "end0": F.col("end0") + 100})


@query("maximal_chains", "v_chain", CHAINS + "SELECT * FROM top")
def maximal_chains(spark, sf):
    kept = transcripts.drop_contained(transcripts.supported_chains(_chains(spark, sf)))
    return kept.withColumn("chain", text())


LENGTH = """list_sum(list_transform(string_split(chain, ','),
  lambda x: CAST(string_split(x, '-')[2] AS BIGINT) - CAST(string_split(x, '-')[1] AS BIGINT)))"""


@query(
    "abundance",
    "v_chain",
    CHAINS
    + f""", l AS (SELECT chrom_id, strand, chain, support, CAST(end0 - start0 + 200 - {LENGTH} AS BIGINT) AS length FROM top)
SELECT *, round(support * 100 / length, 6) AS cov, round(support * 1e9 / (length * sum(support) OVER ()), 4) AS fpkm,
  round(support / length / sum(support / length) OVER () * 1e6, 4) AS tpm FROM l""",
)
def abundance(spark, sf):
    table = transcripts.with_exon_length(_candidates(spark, sf)).drop("start0", "end0")
    rated = transcripts.abundance(table)
    return rated.withColumns(
        {"chain": text(), "cov": F.round("cov", 6), "fpkm": F.round("fpkm", 4), "tpm": F.round("tpm", 4)}
    )


EM_STEPS = 4
EM_STEP = """, w{n} AS (SELECT class, id, fragments, reads / length AS weight, sum(reads / length) OVER (PARTITION BY class) AS total FROM pairs JOIN r{m} USING (id)),
r{n} AS (SELECT id, sum(fragments * weight / total) AS reads FROM w{n} GROUP BY id)"""


@query(
    "shared_abundance",
    "v_chain",
    CHAINS
    + f""", l AS (SELECT chrom_id, strand, chain, CAST(end0 - start0 + 200 - {LENGTH} AS BIGINT) AS length,
    concat_ws('|', CAST(chrom_id AS VARCHAR), strand, chain) AS id FROM top),
fits AS (SELECT k.chrom_id, k.strand, k.chain, any_value(k.support) AS support, list_sort(list(l.id)) AS class FROM k JOIN l
  ON l.chrom_id = k.chrom_id AND l.strand = k.strand AND contains(concat(',', l.chain, ','), concat(',', k.chain, ',')) GROUP BY ALL),
classes AS (SELECT class, sum(support) AS fragments FROM fits GROUP BY class),
pairs AS (SELECT class, fragments, id, length FROM (SELECT class, fragments, unnest(class) AS id FROM classes) JOIN l USING (id)),
r0 AS (SELECT id, CAST(1 AS DOUBLE) AS reads FROM l)"""
    + "".join(EM_STEP.format(n=n, m=n - 1) for n in range(1, EM_STEPS + 1))
    + f""", e AS (SELECT l.*, coalesce(reads, 0) AS reads FROM l LEFT JOIN r{EM_STEPS} USING (id))
SELECT chrom_id, strand, chain, length, round(reads, 6) AS reads, round(reads * 100 / length, 6) AS cov,
  round(reads * 1e9 / (length * sum(reads) OVER ()), 4) AS fpkm, round(reads / length / sum(reads / length) OVER () * 1e6, 4) AS tpm FROM e""",
)
def shared_abundance(spark, sf):
    # The fragments' chains and the transcripts come from one pass over the splices.
    supported = settle(transcripts.supported_chains(_chains(spark, sf)))
    table = transcripts.with_exon_length(_candidates(spark, sf, supported)).select("chrom_id", "strand", "chain", "length")
    observed = supported.select("chrom_id", "strand", "chain", "support")
    rated = transcripts.shared_abundance(observed, table, EM_STEPS)
    rounded = {c: F.round(c, n) for c, n in (("reads", 6), ("cov", 6), ("fpkm", 4), ("tpm", 4))}
    return rated.withColumns({"chain": text(), **rounded})


REFERENCE = """, ref AS (SELECT gene AS tid, chrom_id, strand,
  string_agg(concat(CAST(intron_s AS VARCHAR), '-', CAST(intron_e AS VARCHAR)), ',' ORDER BY intron_s) AS chain,
  (SELECT 0) AS z FROM v_intron GROUP BY gene, chrom_id, strand),
span AS (SELECT gene AS tid, min(start0) AS start0, max(end0) AS end0 FROM v_exon GROUP BY gene),
refs AS (SELECT ref.tid, chrom_id, strand, chain, start0, end0 FROM ref JOIN span ON span.tid = ref.tid),
cand AS (SELECT chrom_id, strand, chain, support, start0 - 100 AS start0, end0 + 100 AS end0 FROM top)
"""


@query(
    "merged_transcripts",
    ("v_chain", "v_intron"),
    CHAINS
    + REFERENCE
    + """, joint AS (SELECT chrom_id, strand, chain, support, start0, end0, NULL AS tid FROM cand
  UNION ALL SELECT chrom_id, strand, chain, 0, start0, end0, tid FROM refs),
g AS (SELECT chrom_id, strand, chain, CAST(sum(support) AS BIGINT) AS support, min(start0) AS start0, max(end0) AS end0, min(tid) AS tid
  FROM joint GROUP BY ALL)
SELECT * FROM g a WHERE tid IS NOT NULL OR NOT EXISTS (SELECT 1 FROM g b WHERE b.chrom_id = a.chrom_id AND b.strand = a.strand
  AND b.chain <> a.chain AND contains(concat(',', b.chain, ','), concat(',', a.chain, ',')))""",
)
def merged_transcripts(spark, sf):
    merged = transcripts.merge_with_reference(_candidates(spark, sf), v.transcripts(spark, sf))
    return merged.withColumn("chain", text())


@query(
    "transcript_ids",
    ("v_chain", "v_chrom"),
    CHAINS
    + f"""SELECT chrom, bin, start0, end0, concat(chrom, '_', CAST(bin AS VARCHAR), '_', CAST(start0 AS VARCHAR), '_', CAST(end0 AS VARCHAR)) AS tid
FROM (SELECT c.chrom, t.start0 - 100 AS start0, t.end0 + 100 AS end0, (t.start0 - 100) // {BIN_STEP} AS bin
  FROM top t JOIN v_chrom c USING (chrom_id)) x""",
)
def transcript_ids(spark, sf):
    named = transcripts.name_transcripts(_candidates(spark, sf), v.chromosomes(spark, sf))
    # The last piece is a hash that SQL does not have.
    return named.select("chrom", "bin", "start0", "end0", F.regexp_replace("tid", "_[0-9A-F]+$", "").alias("tid"))


@query(
    "bin_order",
    "v_chain",
    CHAINS + f"SELECT chrom_id, start0 // {BIN_STEP} AS bin, start0, chain FROM top ORDER BY 1, 2, 3",
)
def bin_order(spark, sf):
    table = transcripts.drop_contained(transcripts.supported_chains(_chains(spark, sf)))
    return transcripts.bin_order(transcripts.with_bin(table)).select("chrom_id", "bin", "start0", text().alias("chain"))


@query(
    "reference_chains",
    ("v_intron", "v_exon"),
    """WITH ref AS (SELECT gene AS tid, chrom_id, strand,
  string_agg(concat(CAST(intron_s AS VARCHAR), '-', CAST(intron_e AS VARCHAR)), ',' ORDER BY intron_s) AS chain
  FROM v_intron GROUP BY gene, chrom_id, strand)
SELECT ref.*, min(start0) AS start0, max(end0) AS end0 FROM ref JOIN v_exon e ON e.gene = ref.tid GROUP BY ALL""",
)
def reference_chains(spark, sf):
    exons = v.exons(spark, sf).withColumnRenamed("gene", "tid")
    return transcripts.chains_of_exons(exons).withColumn("chain", text())


@query(
    "novel_missed",
    ("v_chain", "v_intron"),
    CHAINS
    + """, q AS (SELECT DISTINCT chrom_id, strand, unnest(string_split(chain, ',')) AS intron FROM top),
r AS (SELECT DISTINCT chrom_id, strand, concat(CAST(intron_s AS VARCHAR), '-', CAST(intron_e AS VARCHAR)) AS intron FROM v_intron)
SELECT coalesce(q.chrom_id, r.chrom_id) AS chrom_id, coalesce(q.strand, r.strand) AS strand, coalesce(q.intron, r.intron) AS intron,
  CASE WHEN q.intron IS NULL THEN 'missed' WHEN r.intron IS NULL THEN 'novel' ELSE 'matched' END AS status
FROM q FULL JOIN r ON q.chrom_id = r.chrom_id AND q.strand = r.strand AND q.intron = r.intron""",
)
def novel_missed(spark, sf):
    keys = ["chrom_id", "strand", "intron"]

    def introns(table):
        return table.select("chrom_id", "strand", F.explode("chain").alias("i")).select(
            "chrom_id", "strand", F.concat_ws("-", F.col("i.s").cast("string"), F.col("i.e").cast("string")).alias("intron")
        )

    return compare.feature_overlap(introns(_candidates(spark, sf)), introns(v.transcripts(spark, sf)), keys)


def _exons_sql(name: str, table: str) -> str:
    """Exon rows of chains given as text."""
    return f"""{name}s AS (SELECT chrom_id, strand, chain, start0, end0, list_transform(string_split(chain, ','),
    lambda x: CAST(string_split(x, '-')[1] AS BIGINT)) AS ss, list_transform(string_split(chain, ','),
    lambda x: CAST(string_split(x, '-')[2] AS BIGINT)) AS es FROM {table}),
{name} AS (SELECT chrom_id, strand, chain, unnest(list_prepend(start0, es)) AS start0, unnest(list_append(ss, end0)) AS end0 FROM {name}s)
"""


def _level_sql(level: str, q: str, r: str, keys: str) -> str:
    return f"""SELECT '{level}' AS level, (SELECT count(*) FROM (SELECT {keys} FROM {q} INTERSECT SELECT {keys} FROM {r}) a) AS tp,
  (SELECT count(*) FROM (SELECT {keys} FROM {q} EXCEPT SELECT {keys} FROM {r}) b) AS fp,
  (SELECT count(*) FROM (SELECT {keys} FROM {r} EXCEPT SELECT {keys} FROM {q}) c) AS fn"""


def _locus_sql(name: str, table: str) -> str:
    return f"""{name}m AS (SELECT chrom_id, strand, chain, start0, end0, max(end0) OVER (PARTITION BY chrom_id, strand ORDER BY start0, end0, chain
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM {table}),
{name}k AS (SELECT *, sum(CASE WHEN seen IS NULL OR start0 > seen THEN 1 ELSE 0 END) OVER (PARTITION BY chrom_id, strand
    ORDER BY start0, end0, chain ROWS UNBOUNDED PRECEDING) AS k FROM {name}m)
"""


@query(
    "accuracy_levels",
    ("v_chain", "v_intron"),
    CHAINS
    + REFERENCE
    + ", "
    + _exons_sql("qx", "cand")
    + ", "
    + _exons_sql("rx", "refs")
    + ", "
    + _locus_sql("ql", "cand")
    + ", "
    + _locus_sql("rl", "refs")
    + """, ev AS (SELECT chrom_id, strand, start0 AS pos, 1 AS q, 0 AS r FROM qx UNION ALL SELECT chrom_id, strand, end0, -1, 0 FROM qx
  UNION ALL SELECT chrom_id, strand, start0, 0, 1 FROM rx UNION ALL SELECT chrom_id, strand, end0, 0, -1 FROM rx),
eg AS (SELECT chrom_id, strand, pos, sum(q) AS q, sum(r) AS r FROM ev GROUP BY ALL),
er AS (SELECT lead(pos) OVER w - pos AS n, sum(q) OVER w AS q, sum(r) OVER w AS r FROM eg WINDOW w AS (PARTITION BY chrom_id, strand ORDER BY pos)),
qi AS (SELECT chrom_id, strand, unnest(string_split(chain, ',')) AS intron FROM cand),
ri AS (SELECT chrom_id, strand, unnest(string_split(chain, ',')) AS intron FROM refs),
sh AS (SELECT DISTINCT chrom_id, strand, chain FROM cand SEMI JOIN refs USING (chrom_id, strand, chain)),
lev AS (SELECT 'base' AS level, CAST(sum(n) FILTER (q > 0 AND r > 0) AS BIGINT) AS tp, CAST(sum(n) FILTER (q > 0 AND r = 0) AS BIGINT) AS fp,
    CAST(sum(n) FILTER (q = 0 AND r > 0) AS BIGINT) AS fn FROM er
  UNION ALL """
    + " UNION ALL ".join(
        [
            _level_sql("exon", "qx", "rx", "chrom_id, strand, start0, end0"),
            _level_sql("intron", "qi", "ri", "chrom_id, strand, intron"),
            _level_sql("intron_chain", "cand", "refs", "chrom_id, strand, chain"),
            _level_sql("transcript", "cand", "refs", "chrom_id, strand, chain, start0, end0"),
        ]
    )
    + """
  UNION ALL SELECT 'locus', (SELECT count(DISTINCT (chrom_id, strand, k)) FROM qlk SEMI JOIN sh USING (chrom_id, strand, chain)),
    (SELECT count(DISTINCT (chrom_id, strand, k)) FROM qlk) - (SELECT count(DISTINCT (chrom_id, strand, k)) FROM qlk SEMI JOIN sh USING (chrom_id, strand, chain)),
    (SELECT count(DISTINCT (chrom_id, strand, k)) FROM rlk) - (SELECT count(DISTINCT (chrom_id, strand, k)) FROM rlk SEMI JOIN sh USING (chrom_id, strand, chain)))
SELECT level, tp, coalesce(fp, 0) AS fp, coalesce(fn, 0) AS fn, round(tp / nullif(tp + coalesce(fn, 0), 0), 6) AS sensitivity,
  round(tp / nullif(tp + coalesce(fp, 0), 0), 6) AS precision FROM lev""",
)
def accuracy_levels(spark, sf):
    return compare.accuracy(_candidates(spark, sf), v.transcripts(spark, sf)).withColumns(
        {"sensitivity": F.round("sensitivity", 6), "precision": F.round("precision", 6)}
    )
