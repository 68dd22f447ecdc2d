import math
import random

import pytest
from pyspark.sql import functions as F

from phenoloom import scale


def hot_rows(n=3000):
    """Two thirds of the rows belong to one key; many ties."""
    rng = random.Random(7)
    return [("hot" if rng.random() < 0.66 else f"k{rng.randrange(20)}", rng.randrange(400), i) for i in range(n)]


def test_number_rows_is_exact_when_a_group_spans_tiles(spark, many_tiles):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, v int, i int")
    got = {(r.k, r.v, r.i): r.n for r in scale.number_rows(df, ["k"], ["v", "i"], "n").collect()}
    want, seen = {}, {}
    for k, v, i in sorted(rows):
        seen[k] = seen.get(k, 0) + 1
        want[(k, v, i)] = seen[k]
    assert got == want


def test_hot_group_is_spread_over_tiles(spark, many_tiles):
    df = spark.createDataFrame(hot_rows(), "k string, v int, i int")
    tiled = scale.tiles(df, ["k", "v", "i"])
    counts = tiled.filter("k = 'hot'").groupBy(scale.TILE).count().collect()
    assert len(counts) > 3
    assert max(r["count"] for r in counts) < 1200
    bounds = tiled.groupBy(scale.TILE).agg(F.min(F.struct("k", "v", "i")).alias("lo"), F.max(F.struct("k", "v", "i")).alias("hi"))
    ordered = sorted((tuple(r.lo), tuple(r.hi)) for r in bounds.collect())
    assert all(a[1] < b[0] for a, b in zip(ordered, ordered[1:]))


def test_number_rows_without_key_and_with_null_key(spark, many_tiles):
    df = spark.range(500).select(F.when(F.col("id") % 3 > 0, F.col("id") % 5).alias("k"), "id")
    index = [r.n for r in scale.number_rows(df, [], ["id"], "n").orderBy("id").collect()]
    assert index == list(range(1, 501))
    nulls = scale.number_rows(df, ["k"], ["id"], "n").filter("k IS NULL").orderBy("id").collect()
    assert [r.n for r in nulls] == list(range(1, len(nulls) + 1))


def test_previous_row_across_tiles(spark, many_tiles):
    rows = hot_rows()
    df = spark.createDataFrame(rows, "k string, v int, i int")
    got = {(r.k, r.i): r.previous and (r.previous.v, r.previous.i) for r in scale.previous_row(df, ["k"], ["v", "i"], ["v", "i"]).collect()}
    want, last = {}, {}
    for k, v, i in sorted(rows):
        want[(k, i)] = last.get(k)
        last[k] = (v, i)
    assert got == want


def test_nested_middles_match_sorting(spark, many_tiles):
    rng = random.Random(3)
    rows = []
    for i in range(4000):
        group = "hot" if rng.random() < 0.7 else f"g{rng.randrange(5)}"
        value = rng.choice([None, math.nan, 0.25, rng.random(), rng.random() * 1e-12])
        rows.append((group, value, rng.randrange(-1, 4)))
    df = spark.createDataFrame(rows, "g string, p double, level int")
    got = {(r.g, r.j): (r.n, r.lower, r.upper) for r in scale.nested_middles(df, ["g"], "p", F.col("level"), 4).collect()}
    want = {}
    for g in {r[0] for r in rows}:
        for j in range(4):
            ps = sorted(p for gg, p, lv in rows if gg == g and lv >= j and p is not None and not math.isnan(p))
            if ps:
                want[(g, j)] = (len(ps), ps[(len(ps) + 1) // 2 - 1], ps[len(ps) // 2])
    assert got == want


def test_lookup_never_multiplies_and_is_deterministic(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "b"), (1, "a"), (3, "c")], "k int, v string")
    got = sorted((r.k or 0, r.v or "") for r in scale.lookup(left, right, ["k"]).collect())
    assert got == [(0, ""), (1, "a"), (1, "a"), (2, "")]


@pytest.mark.parametrize("block", [2, 1024])
def test_every_cell(spark, block):
    rows = spark.range(7).withColumnRenamed("id", "r")
    cols = spark.createDataFrame([(c, "x") for c in "abcde"], "c string, d string")
    entries = spark.createDataFrame([(1, "a", "x", 5.0), (6, "e", "x", None)], "r long, c string, d string, v double")
    got = {(r.r, r.c): r.v for r in scale.every_cell(rows, cols, entries, ["r"], block).collect()}
    assert len(got) == 35
    assert got[(1, "a")] == 5.0 and got[(6, "e")] is None and got[(0, "b")] is None


def test_cells_leave_the_columns_of_their_block(spark):
    """No record of a dense cell holds the block's columns, and the cells are all there."""
    rows = spark.createDataFrame([(1,), (2,)], "userId long")
    cols = spark.createDataFrame([("a", "x"), ("b", "x")], "pheno string, coding string")
    entries = spark.createDataFrame([(1, "b", "x", 2.0)], "userId long, pheno string, coding string, value double")
    cells = scale.every_cell(rows, cols, entries, ["userId"])
    plan = cells._jdf.queryExecution().optimizedPlan().toString()
    made = [line.split("inline(", 1)[1] for line in plan.splitlines() if "Generate inline(" in line]
    assert made and "_cols" not in made[0]
    got = sorted((r["userId"], r["pheno"], r["coding"], r["value"]) for r in cells.collect())
    assert got == [(1, "a", "x", None), (1, "b", "x", 2.0), (2, "a", "x", None), (2, "b", "x", None)]
