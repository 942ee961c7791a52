"""The registered queries against DuckDB or brute force, on the smallest tables."""

import base64
import hashlib
import itertools
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest

from checks.compare import differences, duck
from readframe.llm import queries  # noqa: F401
from readframe.llm.catalog import QUERIES, SQL
from readframe.llm.common import fold_of

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.fixture(scope="module")
def texts(con):
    return {d: t or "" for d, t in con.execute("SELECT doc_id, text FROM documents").fetchall()}


def rows(spark, name):
    return QUERIES[name](spark, SF_DIR).collect()


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, con, SQL[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan


def test_native_queries_run_no_python(spark):
    for name in ("op3_chat", "op4_urls", "op5_quality"):
        plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow")), name


def test_op1_is_the_library(spark, texts):
    import tiktoken

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = rows(spark, "op1_bpe")
    assert len(found) == len(texts)
    for r in found:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_op2_held_out_accuracy(spark, con):
    langs = dict(con.execute("SELECT doc_id, lang FROM documents").fetchall())
    found = rows(spark, "op2_language")
    assert all(0 <= r.score <= 1 and r.held_out == (fold_of(r.doc_id, 4) == 2) for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) >= 0.95 * len(held)


def test_op6_base_score_and_gain(spark, texts):
    counts: Counter = Counter()
    for d, t in texts.items():
        if fold_of(d, 7) != 2:
            counts.update([*t.encode().lower().split(), None])
    total, distinct = sum(counts.values()), len(counts)
    found = rows(spark, "op6_hmm")
    assert len(found) == len(texts)
    for r in found:
        words = [*texts[r.doc_id].encode().lower().split(), None]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in words)
        known = sum(counts[w] > 0 for w in words)
        assert (r.n_tokens, r.n_known, r.train_tokens, r.held_out) == (len(words), known, total, fold_of(r.doc_id, 7) == 2)
        assert r.base_score == pytest.approx(base, rel=1e-9)
    held = [r for r in found if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_op7_held_out(spark, con):
    found = rows(spark, "op7_toxicity")
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in found)
    labels = dict(con.execute("SELECT doc_id, toxic FROM labels").fetchall())
    held = [(r.score, labels[r.doc_id]) for r in found if r.held_out and r.doc_id in labels]
    assert len(found) == con.execute("SELECT count(*) FROM documents").fetchone()[0] and held


def test_op7_ranks_held_out_texts(spark):
    import duckdb

    large = SF_DIR.replace("sf0.001", "sf0.1")
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{large}/labels.parquet'").fetchall())
    found = [(r.score, labels[r.doc_id]) for r in QUERIES["op7_toxicity"](spark, large).collect() if r.held_out and labels.get(r.doc_id) is not None]
    toxic, clean = ([s for s, y in found if y == k] for k in (1, 0))
    assert sum((a > b) + (a == b) / 2 for a in toxic for b in clean) >= 0.93 * len(toxic) * len(clean)


def test_op8_is_the_library(spark, texts):
    from tokenizers import Tokenizer

    library, start = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    found = {r.doc_id: r for r in rows(spark, "op8_records")}
    for d in sorted(texts):
        ids = [*library.encode(texts[d], add_special_tokens=False).ids, 2]
        want = (start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes()))
        assert (found[d].start, found[d].n_tokens, found[d].ids_crc32) == want
        start += len(ids)


def brute_components(texts, percent=85, size=4):
    sets = {}
    for d, t in texts.items():
        w = t.encode().lower().split()
        sets[d] = set(zip(*(w[i:] for i in range(size)))) if len(w) >= size else {tuple(w)} if w else set()
    holders, common, parent = defaultdict(list), Counter(), {d: d for d in sets}
    for d, s in sets.items():
        for x in s:
            holders[x].append(d)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for own in holders.values():
        common.update(itertools.combinations(sorted(own), 2))
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: (len(s), find(d)) for d, s in sets.items()}


def test_op9_is_brute_force(spark, texts):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows(spark, "op9_jaccard")} == brute_components(texts)
