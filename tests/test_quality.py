"""Introns of an annotation and totals of QC records."""

from readframe.operators import qc

EXONS = "gene string, transcript string, chrom_id int, start0 bigint, end0 bigint, strand string"


def test_known_introns(spark):
    exons = spark.createDataFrame(
        [
            ("A", "t1", 1, 10, 20, "+"), ("A", "t1", 1, 30, 40, "+"), ("A", "t1", 1, 60, 70, "+"),
            ("A", "t2", 1, 10, 20, "+"), ("A", "t2", 1, 60, 70, "+"),
            ("B", "t3", 1, 100, 200, "-"), ("B", "t3", 1, 120, 150, "-"), ("B", "t3", 1, 200, 210, "-"), ("B", "t3", 1, 220, 230, "-"),
            ("C", None, 2, 1, 2, "+"), ("C", None, 2, 5, 6, "+"),
            (None, None, 3, 1, 2, "+"), (None, None, 3, 5, 6, "+"), ("D", "t4", 4, 7, 9, None), ("D", "t4", 4, 7, 9, None),
        ],
        EXONS,
    )
    got = sorted(map(tuple, qc.known_introns(exons).collect()))
    assert got == [(1, 20, 30), (1, 20, 60), (1, 40, 60), (1, 210, 220), (2, 2, 5)]
    by_gene = qc.known_introns(exons.drop("transcript"))
    assert sorted(map(tuple, by_gene.collect())) == [(1, 20, 30), (1, 40, 60), (1, 210, 220), (2, 2, 5)]
    assert qc.known_introns(exons.limit(0)).count() == 0


def test_qc_totals(spark):
    rows = [("s1", "QC_star_in_put", 3), ("s2", "QC_star_in_put", 4), ("s1", "QC_star_out", 1), ("s1", "QC_x", 5), ("s1", "G", 9), ("s1", None, 2)]
    got = qc.qc_totals(spark.createDataFrame(rows, "sample string, feature string, cnt bigint")).collect()
    assert {tuple(r) for r in got} == {
        ("star", "in_put", 0, 2, 7, 3, 4), ("star", "out", 0, 1, 1, 1, 1), ("x", None, 0, 1, 5, 5, 5),
        ("star", None, 1, 3, 8, 1, 4), ("x", None, 1, 1, 5, 5, 5), (None, None, 3, 4, 13, 1, 5),
    }
