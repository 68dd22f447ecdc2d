"""Hard negatives against scores of all pairs."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenoloom.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<float>, label int, score int, block string"


def brute(rows, anchors=50, relabel=7):
    """(anchor, positive, rank, negative, scores) by scoring everything, in exact integers."""
    kept = []
    for i, v, label in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i is not None and i % relabel == 0 else label
        kept.append((i, label, [math.floor(256 * float(np.float32(x))) for x in v]))
    last = lambda i: (i is None, i or 0)
    out = []
    for i, label, v in kept:
        if i is None or i % anchors:
            continue
        scored = [(sum(a * b for a, b in zip(v, w)), j, other) for j, other, w in kept]
        same = sorted((-s, last(j), j) for s, j, other in scored if other == label and j != i)[:5]
        for minus, _, p in same:
            s_p = -minus
            inside = [(-s, last(j), j) for s, j, other in scored if other != label and 50 * s_p <= 100 * s <= 95 * s_p]
            out += [(i, p, k + 1, j, s_p, -s) for k, (s, _, j) in enumerate(sorted(inside)[:3])]
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def test_whole_table(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [tuple(r) for r in vectors.select("vec_id", "embedding", "label").collect()]
    want = brute(rows)
    assert want and got(hn.op12_hard_negatives(vectors)) == want


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(0, 1, 4).tolist(), int(rng.integers(0, 3))) for i in range(400)]
    rows += [(500, None, 1), (501, [1.0, None], 1), (502, [float("nan")] * 4, 1), (550, [float("inf")] * 4, 1)]
    rows += [(551, [1.0] * 4, None), (None, [1.0, 1.0, 1.0, 1.0], 1), (552, [], 1), (600, [2.0], 0)]
    rows += [(700 + i, [1.0, 1.0, 1.0, 1.0], i % 2) for i in range(60)]  # equal rows, many ties
    rows += [(50, [0.0, 0.0, 0.0, 0.0], 1), (2000, [-1.0, 3.0, 1.0, 1.0], 9), (2100, [3e5, 3e5, 0.0, 0.0], 0)]
    assert got(hn.op12_hard_negatives(table(spark, rows))) == brute(rows)
    assert got(hn.op12_hard_negatives(table(spark, []))) == []


@pytest.mark.parametrize("spread", [0.05, 1.0])
def test_small_nodes_against_brute_force(spark, spread):
    """A tree with many slabs, tiles and leaves, several blocks and salts; clustered rows are pruned."""
    rng = np.random.default_rng(5)
    centres = rng.normal(0, 1, (8, 3))
    rows = [(i, (centres[i % 8] + spread * rng.normal(0, 1, 3)).tolist(), int(rng.integers(0, 3))) for i in range(1500)]
    vectors = table(spark, rows).select("*", F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hn.mine_hard_negatives(
        vectors.withColumn("label", label), F.col("vec_id") % 10 == 0, tile_rows=64, leaf_rows=8, block_rows=2,
    )
    assert got(found) == brute(rows, anchors=10)


def test_leaves_are_pruned():
    rng = np.random.default_rng(8)
    vectors = np.concatenate([rng.integers(-5, 5, (64, 2)) + c for c in ([900, 0], [-900, 0], [0, 900], [0, -900])])
    labels, ids = np.zeros(256, dtype=np.int64), np.arange(256)
    query = hn.Queries(
        0, np.array([0]), vectors[:1], ids[:1], labels[:1], *(np.array([[x]]) for x in (hn.NONE + 1, hn.MOST, hn.NONE))
    )
    leaves = hn.str_leaves(vectors, labels, 16)
    assert sorted(np.concatenate(leaves)) == list(range(256)) and max(map(len, leaves)) == 16
    boxes = hn.Boxes.around(leaves, vectors, vectors, labels, labels)
    least, largest = boxes.intervals(query.vectors)
    for b, leaf in enumerate(leaves):
        exact = vectors[leaf] @ vectors[0]
        assert least[0, b] <= exact.min() and exact.max() <= largest[0, b]
    seen = []

    class Watched(np.ndarray):
        def __getitem__(self, key):
            if isinstance(key, np.ndarray):
                seen.append(key)
            return super().__getitem__(key)

    at, _, score, found = hn.search(query, vectors.view(Watched), ids, labels, leaves, True, 5)
    want = sorted((-s, i) for i, s in enumerate(vectors @ vectors[0]) if i)[:5]
    assert [(-s, i) for s, i in zip(score, found)] == want
    scored = [k for k in seen if len(k) == 16][len(leaves) * 2 :]  # boxes read every leaf twice
    assert len(scored) < len(leaves) / 2


def test_products_beyond_doubles():
    big = np.array([[1 << 40, 3]])
    score, exact = hn.products(big, big)
    assert not exact and score[0, 0] == hn.MOST - 1
    score, exact = hn.products(np.array([[(1 << 29) + 1, 1]]), np.array([[(1 << 28) + 1, 1]]))
    assert exact and score[0, 0] == ((1 << 29) + 1) * ((1 << 28) + 1) + 1
