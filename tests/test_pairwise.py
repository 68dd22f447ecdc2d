"""Blocked products: packed tiles whose number does not follow the rows."""

import numpy as np
import pytest

from phenoloom.operators import pairwise


def cells(spark, x):
    found = [(int(i), int(j), float(x[i, j])) for i, j in zip(*np.nonzero(x))]
    return spark.createDataFrame(found, "row long, idx long, value double")


def columns(spark, n):
    return spark.range(n).withColumnRenamed("id", "idx")


@pytest.mark.parametrize("col_block,row_block", [(1, 7), (3, 1024), (4, 1), (1024, 50)])
def test_gram_against_numpy(spark, col_block, row_block):
    rng = np.random.default_rng(2)
    x = np.where(rng.random((120, 10)) < 0.3, rng.normal(size=(120, 10)), 0.0)
    x[:, 4] = 0  # a column without cells
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
    try:
        got = pairwise.gram(cells(spark, x), columns(spark, 10), "row", "value", row_block, col_block).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == 100
    found = np.zeros((10, 10))
    for r in got:
        found[r.i, r.j] = r.entry
    assert np.allclose(found, x.T @ x)


def test_tiles_do_not_follow_the_rows(spark, monkeypatch):
    """Ten times the rows: as many tiles, of as many bytes, are exchanged."""
    kept = []
    frame = type(spark.range(1))
    plain = frame.mapInArrow

    def watched(self, function, schema):
        made = plain(self, function, schema)
        if schema == pairwise.TILE_SCHEMA:
            kept.append(made)
        return made

    monkeypatch.setattr(frame, "mapInArrow", watched)
    rng = np.random.default_rng(3)
    for n in (200, 2000):
        x = (rng.random((n, 9)) < 0.5).astype(float)
        pairwise.gram(cells(spark, x), columns(spark, 9), "row", "value", row_block=16, col_block=4)
    few, many = (t.selectExpr("count(*) n", "sum(length(tile)) bytes").first() for t in kept)
    assert few == many and many.n <= 8 + 6


def test_no_columns(spark):
    empty = cells(spark, np.zeros((1, 1)))
    assert pairwise.gram(empty, columns(spark, 0), "row", "value").count() == 0
