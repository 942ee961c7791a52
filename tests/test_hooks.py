"""A user function per part gets runs of a sorted stream instead of an Arrow stream of its own."""

import numpy as np
import pandas as pd
import pytest

from readframe.operators import hooks


def test_a_part_is_no_arrow_stream_of_its_own(spark):
    df = spark.range(10).selectExpr("id % 3 AS part_no", "id AS v")
    out = hooks.map_parts(df, lambda key, batches: iter([]), "n bigint", ["part_no"])
    assert "FlatMapGroups" not in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", ["3", "10000"])
def test_each_key_is_one_call_over_batches(spark, size):
    """Keys with nulls, of one row and of more rows than a batch; a function that reads all, some or no rows."""
    rows = [(s, p, i) for i, (s, p) in enumerate((s, p) for s in ("a", "b", None) for p in (0, 1, None) for _ in range(1 + 7 * (p or 0)))]
    df = spark.createDataFrame(rows, "sample string, part_no int, v bigint").repartition(5)

    def read(limit):
        def fn(key, batches):
            seen = []
            for batch in batches:
                assert list(batch.index) == list(range(len(batch))) and len(batch) <= int(size)
                seen += batch.v.tolist()
                if len(seen) >= limit:
                    break
            k = [None if pd.isna(x) else x for x in key]
            if k != ["b", 0]:
                yield pd.DataFrame({"part_no": [k[1]], "sample": [k[0]], "n": [len(seen)], "total": [sum(seen) + 2**60]})

        return fn

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    try:
        for limit in (10**9, 2, 0):
            got = hooks.map_parts(df, read(limit), "sample string, part_no int, n bigint, total bigint").collect()
            want = {}
            for s, p, v in rows:
                want.setdefault((s, p), []).append(v)
            assert {(r.sample, r.part_no) for r in got} == {*want} - {("b", 0)} and len(got) == 8
            if limit > 100:
                assert {(r.sample, r.part_no): (r.n, r.total) for r in got} == {k: (len(v), sum(v) + 2**60) for k, v in want.items() if k != ("b", 0)}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_small_results_are_put_together_and_checked():
    frames = [pd.DataFrame({"a": [2**60 + i]}) for i in range(5)] + [pd.DataFrame({"a": [np.nan]}), pd.DataFrame(), pd.DataFrame({"a": [7]})]
    got = list(hooks._gathered(frames, ["a"], rows=3))
    assert [len(f) for f in got] == [3, 2, 1, 1] and got[1].a.tolist() == [2**60 + 3, 2**60 + 4]
    with pytest.raises(ValueError, match="columns"):
        list(hooks._gathered([pd.DataFrame({"b": [1]})], ["a"]))
