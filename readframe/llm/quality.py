"""Quality rules by weak supervision, with DataFrame functions only.

Rules look at counts taken from a text and vote good, bad, or abstain. A two-class latent model (two accuracies per
rule: how often it votes rightly on good and on bad documents, among its votes) is fitted by expectation-maximisation.
Documents with equal votes are one row of a table of at most 3 ** rules rows, so each step of the fit is one small
aggregation, whatever the size of the corpus. A document is kept if its posterior probability of being good is at
least one half and it does not fail the base test.

Defined results: a null text has no words and fails the base test; an empty table gives no rows; repeated rows are
scored each; a null id stays null; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from readframe.llm.common import stored

SPACE = r"[\x20\x09-\x0D]+"
# A word of letters alone, with at most a stop or comma behind it.
PLAIN = r"(?<![^\x20\x09-\x0D])\p{L}+[.,]?(?![^\x20\x09-\x0D])"
# (name, votes good if, votes bad if), over integer counts, in SQL that any engine reads.
RULES = (
    ("long", "n_words >= 100", "n_words < 50"),
    ("word_length", "word_chars BETWEEN 3 * n_words AND 9 * n_words", "word_chars < 2 * n_words OR word_chars > 12 * n_words"),
    ("symbols", "100 * n_symbols <= 2 * n_words", "100 * n_symbols >= 20 * n_words"),
    ("lines", "n_dup_lines = 0", "100 * n_dup_lines >= 30 * n_lines"),
    ("repeats", "100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words >= 30 * n_words"),
    ("capitals", "100 * n_upper <= 15 * word_chars", "100 * n_upper >= 40 * word_chars"),
    ("shouting", "100 * n_marks <= 3 * n_words", "100 * n_marks >= 20 * n_words"),
    ("letters", "100 * n_letters >= 90 * word_chars", "100 * n_letters < 80 * word_chars"),
    ("plain", "100 * n_plain >= 85 * n_words", "100 * n_plain < 65 * n_words"),
)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_letters", "n_plain")
STEPS = 12
# Where the fit starts: share of good documents, and the share of bad votes among votes on good and on bad ones.
START = (0.9, 0.02, 0.3)
PRIOR = 1.0  # added to each vote count, so that no probability is 0


def counts(rows: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns of ``rows`` and the counts of ``text`` that the rules look at."""
    rows = rows.withColumn("text", F.coalesce("text", F.lit("")))
    lines = F.filter(F.split("text", "\n"), lambda x: F.regexp_like(x, F.lit(r"[^\x20\x09-\x0D]")))
    rows = rows.select(
        *keep,
        F.array_remove(F.split("text", SPACE), "").alias("w"),
        lines.alias("lines"),
        _matches("[#*$%&|<>]").alias("n_symbols"),
        _matches(r"\p{Lu}").alias("n_upper"),
        _matches("!!").alias("n_marks"),
        _matches(r"\p{L}").alias("n_letters"),
        _matches(PLAIN).alias("n_plain"),
    )
    rows = rows.select(
        *keep,
        "w",
        F.size("w").cast("bigint").alias("n_words"),
        F.length(F.array_join("w", "")).cast("bigint").alias("word_chars"),
        "n_symbols",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size("lines").cast("bigint").alias("n_lines"),
        "n_upper",
        "n_marks",
        "n_letters",
        "n_plain",
    )
    return repeated_words(rows).select(*keep, *COUNTS)


def _matches(pattern: str) -> Column:
    return F.regexp_count("text", F.lit(pattern)).cast("bigint")


def repeated_words(rows: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words of ``w`` in a 3-word window that occurs at least twice in it.

    Windows are hashed and sorted with their positions as single numbers; neighbours with equal hashes are candidates,
    and those are compared as text. Nothing is shuffled, and no step is quadratic in the text.
    """
    at = lambda i, n: F.get("w", i + F.lit(n))
    window = F.transform(
        F.sequence(F.lit(0), F.col("n_words").cast("int") - 3),
        lambda i: F.shiftleft(F.xxhash64(at(i, 0), at(i, 1), at(i, 2)), 31).bitwiseOR(i.cast("bigint")),
    )
    rows = rows.withColumn("keys", F.when(F.col("n_words") >= 4, F.sort_array(window)))
    same = F.zip_with(
        F.slice("keys", 1, F.size("keys") - 1),
        F.slice("keys", 2, F.size("keys") - 1),
        lambda a, b: F.when(F.shiftright(a, 31) == F.shiftright(b, 31), F.array(a, b)),
    )
    rows = rows.withColumn("near", F.array_distinct(F.flatten(F.array_compact(same)))).drop("keys")
    mask = F.lit(2**31 - 1).cast("bigint")
    spelled = F.transform(
        "near",
        lambda k: F.struct(
            F.concat_ws(" ", *(F.get("w", k.bitwiseAND(mask).cast("int") + F.lit(n)) for n in range(3))).alias("window"),
            k.bitwiseAND(mask).cast("int").alias("i"),
        ),
    )
    rows = rows.withColumn("spelled", F.when(F.size("near") > 0, F.sort_array(spelled))).drop("near")
    equal = F.zip_with(
        F.slice("spelled", 1, F.size("spelled") - 1),
        F.slice("spelled", 2, F.size("spelled") - 1),
        lambda a, b: F.when(a["window"] == b["window"], F.array(a["i"], b["i"])),
    )
    covered = F.aggregate(
        F.array_sort(F.array_distinct(F.flatten(F.array_compact(equal)))),
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda s, i: F.struct((s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"), i.alias("last")),
        lambda s: s["n"],
    )
    return rows.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("bigint"))


def vote(good: str, bad: str) -> str:
    return f"CASE WHEN {bad} THEN -1 WHEN {good} THEN 1 ELSE 0 END"


BASE_FAILED = "n_words < 50 OR 100 * n_repeat_words > 50 * n_words"


def log_odds(names: list[str], parameters: dict[str, object]) -> str:
    """SQL for the log odds of good; ``parameters`` are numbers or column names."""
    p = parameters
    terms = [f"ln({p['share']} / (1 - {p['share']}))"]
    for n in names:
        g, b = p[f"{n}_good"], p[f"{n}_bad"]
        terms.append(f"CASE v_{n} WHEN -1 THEN ln({g} / {b}) WHEN 1 THEN ln((1 - {g}) / (1 - {b})) ELSE 0 END")
    return " + ".join(terms)


def step(names: list[str]) -> dict[str, str]:
    """SQL aggregates over ``(n, v_*, good)`` that give the next parameters; ``good`` is the posterior."""
    out = {"share": f"(sum(n * good) + {PRIOR}) / (sum(n) + 2 * {PRIOR})"}
    for name in names:
        for side, weight in (("good", "n * good"), ("bad", "n * (1 - good)")):
            bad_votes = f"sum(CASE WHEN v_{name} = -1 THEN {weight} ELSE 0 END)"
            votes = f"sum(CASE WHEN v_{name} <> 0 THEN {weight} ELSE 0 END)"
            out[f"{name}_{side}"] = f"({bad_votes} + {PRIOR}) / ({votes} + 2 * {PRIOR})"
    return out


def start(names: list[str]) -> dict[str, float]:
    return {"share": START[0]} | {f"{n}_{side}": p for n in names for side, p in (("good", START[1]), ("bad", START[2]))}


def fit(votes: DataFrame, names: list[str], steps: int = STEPS) -> dict[str, float]:
    """Share of good documents and each rule's share of bad votes, for good and for bad documents."""
    patterns = stored(votes.groupBy(*(f"v_{n}" for n in names)).agg(F.count("*").cast("double").alias("n")), "votes")
    found = start(names)
    for _ in range(steps):
        posterior = F.expr(f"1D / (1D + exp(-({log_odds(names, {k: f'{v!r}D' for k, v in found.items()})})))")
        row = patterns.withColumn("good", posterior).agg(*(F.expr(s).alias(k) for k, s in step(names).items())).first()
        if row is None or row["share"] is None:
            return start(names)
        found = row.asDict()
    return found


def judge(docs: DataFrame, rules=RULES, steps: int = STEPS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``good`` (posterior probability) and ``kept``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _judged(counts(rows, "doc_id"), ["doc_id"], rules, steps)


def _judged(found: DataFrame, keep: list[str], rules, steps: int) -> DataFrame:
    names = [r[0] for r in rules]
    found = stored(found.select("*", *(F.expr(vote(g, b)).alias(f"v_{n}") for n, g, b in rules)), "counts")
    parameters = fit(found, names, steps)
    odds = F.expr(log_odds(names, {k: f"{v!r}D" for k, v in parameters.items()}))
    failed = F.expr(BASE_FAILED)
    return found.select(
        *keep,
        *COUNTS,
        failed.alias("base_failed"),
        (1 / (1 + F.exp(-odds))).alias("good"),
        (~failed & (odds >= 0)).alias("kept"),
    )


def keep(docs: DataFrame, rules=RULES, steps: int = STEPS, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.

    Rows travel with their counts in one struct column, so no name can clash and no join by id is needed.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col(text_col).cast("string").alias("text"))
    return _judged(counts(rows, "row"), ["row"], rules, steps).filter("kept").select("row.*")


def oracle(rules=RULES, steps: int = STEPS) -> str:
    """The same as DuckDB SQL, with the steps of the fit written out."""
    names = [r[0] for r in rules]
    votes = ", ".join(f"{vote(g, b)} AS v_{n}" for n, g, b in rules)
    keys = ", ".join(f"v_{n}" for n in names)
    first = ", ".join(f"CAST({v!r} AS DOUBLE) AS {k}" for k, v in start(names).items())
    odds = log_odds(names, {k: f"p.{k}" for k in start(names)})
    next_step = ", ".join(f"{s} AS {k}" for k, s in step(names).items())
    ctes = "".join(
        f", p{i + 1} AS MATERIALIZED (SELECT {next_step} FROM (SELECT t.*, 1 / (1 + exp(-({odds}))) AS good FROM patterns t, p{i} p))"
        for i in range(steps)
    )
    return f"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (SELECT *, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM texts),
windows AS (SELECT doc_id, i, concat_ws(' ', w[i], w[i + 1], w[i + 2]) AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM words)),
twice AS (SELECT doc_id, i FROM windows SEMI JOIN
  (SELECT doc_id AS d, g AS h FROM windows GROUP BY ALL HAVING count(*) > 1) ON doc_id = d AND g = h),
repeats AS (SELECT doc_id, count(DISTINCT i) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS i FROM twice) GROUP BY doc_id),
counted AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
  len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines,
  coalesce(n_repeat_words, 0) AS n_repeat_words, len(l) AS n_lines,
  len(regexp_extract_all(text, '\\p{{Lu}}')) AS n_upper, len(regexp_extract_all(text, '!!')) AS n_marks,
  len(regexp_extract_all(text, '\\p{{L}}')) AS n_letters,
  len(list_filter(w, lambda x: regexp_full_match(x, '\\p{{L}}+[.,]?'))) AS n_plain
  FROM words LEFT JOIN repeats USING (doc_id)),
voted AS MATERIALIZED (SELECT *, {votes} FROM counted),
patterns AS MATERIALIZED (SELECT {keys}, CAST(count(*) AS DOUBLE) AS n FROM voted GROUP BY ALL),
p0 AS (SELECT {first}){ctes}
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, {BASE_FAILED} AS base_failed,
  NOT ({BASE_FAILED}) AND {odds} >= 0 AS kept
FROM voted, p{steps} p
"""
