"""One query per operator, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from readframe.llm import bpe, chat, decontaminate, hmm, jaccard, langid, merkle, negatives, quality, records, substrings, toxicity, urls
from readframe.llm.catalog import query
from readframe.llm.common import fold, table
from readframe.session import scratch_path


@query("op1_bpe")
def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


OP3_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')),
judged AS (SELECT *, CASE lag(role) OVER own WHEN 'system' THEN role = 'user' WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user'
    ELSE lag(role) OVER own IS NULL AND role IN ('system', 'user') END AND (lead(role) OVER own IS NOT NULL OR role = 'assistant') AS ok
  FROM turns WINDOW own AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('### : </turn>') + 2 + length(replace(replace(replace(text, '\\', '\\b'), '#', '\\h'), '<', '\\l'))
    + length(replace(replace(replace(replace(role, '\\', '\\b'), '#', '\\h'), '<', '\\l'), ':', '\\c'))) AS BIGINT) AS formatted_chars,
  count(*) FILTER (NOT ok) AS n_bad_turns, bool_and(ok) AS valid_order
FROM judged GROUP BY conv_id
"""


@query("op3_chat", OP3_SQL)
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    chats = chat.read_back(chat.format_chats(turns.unionByName(extra)))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "n_bad_turns",
        (F.col("n_bad_turns") == 0).alias("valid_order"),
    )


@query("op5_quality", quality.oracle())
def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    base = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *base, "base_failed", "kept")


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").filter(fold("doc_id", 4) != 2)
    scored = toxicity.score(table(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


@query("op8_records")
def op8_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        definition = file.read()
    index = records.write(table(spark, sf_dir, "documents"), scratch_path(spark, "records"), definition, end_id=2)
    back = records.read(spark, index, "doc_id", "start", "n_tokens")
    return back.select("doc_id", "start", (F.length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


@query("op10_decontaminate", decontaminate.oracle())
def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op2_language")
def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.fit(docs.filter(fold("doc_id", 4) != 2))
    found = langid.identify(docs, model)
    return found.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


@query("op9_jaccard")
def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


@query("op6_hmm")
def op6_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


# Fetch days and list histories follow from the pages: each host, host with its first path part, and domain has a
# history of four entries whose days and verdicts come from the smallest page id that has it.
OP4_KEYS = """
SELECT key, min(page_id) AS m FROM (
  SELECT page_id, host AS key FROM hosts UNION ALL
  SELECT page_id, concat(host, '/', part) FROM hosts WHERE part <> '' UNION ALL
  SELECT page_id, regexp_extract(host, '([^.]+[.][^.]+)$', 1) FROM hosts) k WHERE key <> '' GROUP BY key
"""
OP4_ENTRIES = """
SELECT CASE WHEN (m + k) % 2 = 0 THEN 'ads' ELSE 'spam' END AS list, key,
  CASE (m + k) % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'allow' END AS verdict, (m * 37 + k * 251) % 1000 AS day
FROM (SELECT key, m, {each} AS k FROM keys) AS n
"""
OP4_HOSTS = """
SELECT page_id, lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host,
  regexp_extract(url, '^[^:]+://[^/?#]*/([^/?#]+)', 1) AS part FROM pages
"""
OP4_SQL = f"""
WITH hosts AS ({OP4_HOSTS}), keys AS ({OP4_KEYS}), entries AS ({OP4_ENTRIES.replace("{each}", "unnest(range(4))")}),
daily AS (SELECT list, key, day, arg_max(coalesce(verdict, 'end'), CASE verdict WHEN 'block' THEN 2 WHEN 'allow' THEN 1 ELSE 0 END) AS verdict
  FROM entries GROUP BY list, key, day),
changed AS (SELECT * FROM daily QUALIFY verdict IS DISTINCT FROM
  coalesce(lag(verdict) OVER (PARTITION BY list, key ORDER BY day), 'end')),
spans AS (SELECT list, key, verdict, day AS since, lead(day) OVER (PARTITION BY list, key ORDER BY day) AS until FROM changed),
captures AS (SELECT page_id, url, page_id * 7919 % 1000 AS day, lower(regexp_extract(url,
    '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)) AS host,
  list_filter(string_split(regexp_extract(url, '^[^:]+://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS parts FROM pages),
asked AS (
  SELECT page_id, day, array_to_string(string_split(host, '.')[i:], '.') AS key
  FROM (SELECT *, unnest(range(1, len(string_split(host, '.')) + 1)) AS i FROM captures WHERE host <> '')
  UNION SELECT page_id, day, concat(host, '/', array_to_string(parts[:i], '/'))
  FROM (SELECT *, unnest(range(1, len(parts) + 1)) AS i FROM captures WHERE host <> '')),
found AS (SELECT page_id, day, key, verdict, list FROM asked JOIN spans USING (key)
  WHERE verdict IN ('block', 'allow') AND since <= day AND (until IS NULL OR day < until)
  QUALIFY row_number() OVER (PARTITION BY page_id, day ORDER BY length(key) DESC, key DESC, verdict = 'block' DESC, list) = 1)
SELECT c.page_id, c.url, c.day, coalesce(f.verdict, 'none') AS verdict, f.key AS matched_key, f.list AS matched_list
FROM captures c LEFT JOIN found f ON c.page_id = f.page_id AND c.day = f.day
"""


@query("op4_urls", OP4_SQL)
def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hosts = spark.sql(OP4_HOSTS.replace("FROM pages", "FROM {pages}"), pages=pages)
    listed = spark.sql(OP4_KEYS.replace("FROM hosts", "FROM {hosts}"), hosts=hosts)
    entries = spark.sql(OP4_ENTRIES.replace("FROM keys", "FROM {listed}").replace("{each}", "explode(sequence(0, 3))"), listed=listed)
    captures = pages.withColumn("day", F.col("page_id") * 7919 % 1000)
    told = urls.evaluate(captures, entries)
    return told.withColumnsRenamed({"_verdict": "verdict", "_key": "matched_key", "_list": "matched_list"})


OP11_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@query("op11_manifest", merkle.oracle(OP11_FIELDS, "lang", "doc_id", "n_chars"))
def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    told = {"n_chars": F.col("n_chars") + F.when(tampered, 1).otherwise(0)}
    fields = [F.col(c) for c in OP11_FIELDS]
    changed = merkle.digest(*[told.get(c, F.col(c)) for c in OP11_FIELDS])
    found = merkle.manifest(docs, fields, F.col("lang"), F.col("doc_id"), {"changed": changed})
    folded = merkle.fold(F.col("changed"), F.col("steps"))
    found = found.select("id", "leaf", "subroot", "root", merkle.proof_digest(F.col("steps")).alias("proof_sha256"), folded.alias("folded_root"))
    return found.withColumnRenamed("id", "doc_id").withColumn("verified", F.col("folded_root") == F.col("root"))


@query("op12_negatives", negatives.oracle())
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(rows.withColumn("label", label), "vec_id % 100 = 0")


@query("op13_substrings", substrings.oracle())
def op13_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substrings.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
