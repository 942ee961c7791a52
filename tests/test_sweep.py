"""The sweep join against comparison of all pairs and against the cell join."""

from collections import Counter

import numpy as np
import pytest

from readframe.operators import sweep as sw
from readframe.operators.intervals import overlap_join

LEFT = "read_id int, chrom_id int, start0 bigint, end0 bigint"
RIGHT = "gene string, chrom_id int, start0 bigint, end0 bigint"


def tables(spark, seed, count, span, longest):
    rng = np.random.default_rng(seed)

    def rows(n, name):
        for k in range(n):
            start = int(rng.integers(0, span)) if k % 3 else 500
            length = int(rng.integers(0, longest)) if k % 20 else span
            yield (name(k), int(rng.integers(0, 3)), start, start + length)

    left = [*rows(count, int), (-1, None, 1, 9), (-2, 1, None, 9), (-3, 1, 1, None), (7, 0, 500, 600), (7, 0, 500, 600)]
    right = [*rows(count // 2, lambda k: f"G{k}"), ("N", None, 1, 9), ("G1", 0, 500, 520), ("G1", 0, 500, 520)]
    return left, right, spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT)


def all_pairs(left, right):
    return Counter(
        (a, g) for a, c, s, e in left for g, d, t, f in right
        if None not in (c, d, s, e, t, f) and c == d and s < f and t < e
    )


@pytest.mark.parametrize("stretch_rows, cell_bases", [(20, 64), (7, 1000), (100_000, 16_384)])
def test_all_pairs(spark, stretch_rows, cell_bases):
    left, right, a, b = tables(spark, 3, 300, 5_000, 300)
    got = sw.sweep_join(a, b, stretch_rows=stretch_rows, cell_bases=cell_bases)
    assert got.columns == ["read_id", "chrom_id", "start0", "end0", "gene", "r_start0", "r_end0"]
    assert Counter((r.read_id, r.gene) for r in got.collect()) == all_pairs(left, right)
    cell = overlap_join(a, b)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, cell.select(*got.columns).collect()))


def test_small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        left, right, a, b = tables(spark, 8, 120, 400, 60)
        got = sw.sweep_join(a, b, stretch_rows=50, cell_bases=32)
        assert Counter((r.read_id, r.gene) for r in got.collect()) == all_pairs(left, right)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_one_sort_and_no_nested_loop(spark):
    _, _, a, b = tables(spark, 8, 50, 400, 60)
    plan = sw.sweep_join(a, b)._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("Union")]
    assert top.count("Sort ") == 1 and "NestedLoop" not in plan and "Cartesian" not in plan


def test_long_interval_is_not_copied_per_cell(spark):
    spans = spark.createDataFrame([(1, 0, 0, 1_000_000)], LEFT)
    genes = spark.createDataFrame([(f"G{k}", 0, k * 1000, k * 1000 + 10) for k in range(1000)], RIGHT)
    cells = sw.stretches_of(spans, genes, ["chrom_id"], 400, 16_384)
    assert cells.select("_stretch").distinct().count() == 3
    assert sw.sweep_join(spans, genes, stretch_rows=400).count() == 1000


def test_far_positions_and_empty_tables(spark):
    far = 10**15
    a = spark.createDataFrame([(1, 0, far, far + 5), (2, 0, 3, far + 1)], LEFT)
    b = spark.createDataFrame([("G", 0, far + 4, far + 9), ("H", 0, far, far + 1)], RIGHT)
    got = sw.sweep_join(a, b, stretch_rows=1)
    assert sorted((r.read_id, r.gene) for r in got.collect()) == [(1, "G"), (1, "H"), (2, "H")]
    assert sw.sweep_join(a.limit(0), b).count() == 0 and sw.sweep_join(a, b.limit(0)).count() == 0


def test_bins_with_reference_in_pieces(spark):
    import pyarrow as pa

    from readframe.operators.hooks import map_bins_with

    reads = spark.createDataFrame(
        [(k, 1, 10 * k, 10 * k + 5, 0) for k in range(40)] + [(90, 2, 1, 2, 0), (91, 3, 1, 2, 7), (92, None, 1, 2, 0)],
        "read_id int, chrom_id int, start0 bigint, end0 bigint, bin bigint",
    )
    exons = spark.createDataFrame(
        [("A", 1, 0, 9), ("B", 1, 5, 9), ("far", 1, 10_000_000, 10_000_009), ("C", 4, 1, 2)],
        "gene string, chrom_id int, start0 bigint, end0 bigint",
    )

    def seen(key, hits, known):
        row = [*key, len(hits), len(known)]
        return pa.Table.from_arrays([pa.array([x], pa.int64()) for x in row], names=["c", "b", "p", "n", "m"])

    schema = "c bigint, b bigint, p bigint, n bigint, m bigint"
    got = [tuple(r) for r in map_bins_with(reads, exons, seen, schema, piece_rows=10).collect()]
    assert sum(r[3] for r in got if r[0] == 1) == 40 and {r[4] for r in got if r[0] == 1} == {2}
    assert len([r for r in got if r[0] == 1]) > 1
    assert {r for r in got if r[0] != 1} == {(2, 0, 0, 1, 0), (3, 7, 0, 1, 0)}
    full = map_bins_with(reads, exons, seen, schema, minimum=2).collect()
    assert [tuple(r) for r in full] == [(1, 0, 0, 40, 2)]
