"""Every stage of the pipeline against a separate version of it, on the stage's own input."""

import base64

import duckdb
import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from readframe.llm import decontaminate, langid, quality
from readframe.llm.common import plain_words, stored, table

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF_DIR, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, SF_DIR), name)
        out[name] = (docs, result)
        docs = result
    return out


def texts(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def test_order_and_columns(stages):
    assert list(stages) == ["language", "quality_rules", "near_duplicates", "benchmark_passages", "token_ids"]
    for name, (docs, result) in stages.items():
        assert name == "token_ids" or result.columns == docs.columns


def test_language(spark, stages):
    docs, result = stages["language"]
    model = langid.fit(docs)
    assert texts(result) == {d: t for d, t in texts(docs).items() if not model.nearest(t)[2]}


def test_quality(stages):
    docs, result = stages["quality_rules"]
    con = duckdb.connect()
    con.register("documents", docs.toArrow())
    kept = {r[0] for r in con.execute(f"SELECT doc_id FROM ({quality.oracle()}) WHERE kept").fetchall()}
    assert set(texts(result)) == kept


def test_near_duplicates(stages):
    from test_queries import brute_components

    docs, result = stages["near_duplicates"]
    found = brute_components(texts(docs), percent=80, size=5)
    assert set(texts(result)) == {d for d, (_, component) in found.items() if d == component}


def test_benchmark_passages(spark, stages):
    docs, result = stages["benchmark_passages"]
    items = [plain_words(r.text or "") for r in table(spark, SF_DIR, "benchmark").collect()]
    windows = {tuple(w[i : i + min(10, len(w))]) for w in items if w for i in range(len(w) - min(10, len(w)) + 1)}
    sizes = {len(w) for w in windows}
    want = {}
    for d, t in texts(docs).items():
        words = plain_words(t)
        hit = np.zeros(len(words), dtype=bool)
        for size in sizes:
            for i in range(len(words) - size + 1):
                if tuple(words[i : i + size]) in windows:
                    hit[i : i + size] = True
        if hit.sum() <= decontaminate.COVERED * len(words):
            want[d] = decontaminate.cut(t, decontaminate._spans(hit)) if hit.any() else t
    assert texts(result) == want
    assert all(r.n_chars == len(r.text) for r in result.collect())


def test_token_ids(stages):
    import tiktoken

    docs, result = stages["token_ids"]
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: np.frombuffer(bytes(r.ids), dtype="<u4").tolist() for r in result.collect()}
    assert found == {d: library.encode_ordinary(t) for d, t in texts(docs).items()}


def test_run_is_the_stages(spark, stages):
    want = {r.doc_id: bytes(r.ids) for r in stages["token_ids"][1].collect()}
    assert {r.doc_id: bytes(r.ids) for r in corpus_pipeline.run(spark, SF_DIR).collect()} == want
