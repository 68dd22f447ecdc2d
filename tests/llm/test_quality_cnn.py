"""The byte network: held-out accuracy, its convolution and slopes against plain ones."""

import numpy as np

from phenoloom.llm import quality_cnn as qc

BIG = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{BIG}/{t}.parquet") for t in ("documents", "labels"))
    found = qc.op11_quality_cnn(docs, labels)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").filter("held_out").collect()
    good = np.array([r["score"] for r in rows if r["quality"] == 1])
    bad = np.array([r["score"] for r in rows if r["quality"] == 0])
    assert (good[:, None] > bad).mean() + (good[:, None] == bad).mean() / 2 > 0.97
    assert (good >= 0.5).mean() > 0.98 and (bad < 0.5).mean() > 0.85


def test_chunks_cover_the_text():
    for n in (0, 1, 511, 512, 513, 1018, 1019, 1020, 5000):
        data = np.arange(n) % 100
        made = qc.chunks_of("".join(map(chr, data)))
        runs = {made[i, j : j + qc.WIDTH].tobytes() for i in range(len(made)) for j in range(qc.CHUNK - qc.WIDTH + 1)}
        assert made.shape[1] == qc.CHUNK and (n > qc.CHUNK or len(made) == 1)
        for j in range(n - qc.WIDTH + 1):
            assert data[j : j + qc.WIDTH].astype(made.dtype).tobytes() in runs


def test_convolution_against_loops():
    net = qc.Network.start(np.random.default_rng(2))
    text = "Größe! " * 150
    pooled = []
    for chunk in qc.chunks_of(text):
        response = [
            net.bias + sum(net.embed[chunk[i + w]] @ net.filters[w] for w in range(qc.WIDTH))
            for i in range(qc.CHUNK - qc.WIDTH + 1)
        ]
        pooled.append(np.maximum(np.max(response, axis=0), 0))
    want = np.concatenate([np.mean(pooled, axis=0), np.max(pooled, axis=0)]) @ net.top[:-1] + net.top[-1]
    assert np.allclose(net.logits(["x", text, None])[1], want, atol=1e-4)


def test_slopes_against_differences():
    net = qc.Network.start(np.random.default_rng(0))
    made, label = [qc.chunks_of(t) for t in ("hello world " * 120, "abc", "zz~ é" * 300)], np.array([1.0, 0, 1])
    _, slopes = net.gradient(made, label)
    for part, slope in zip(net.parts(), slopes):
        close = 0
        for flat in np.argsort(-np.abs(slope), axis=None)[:8]:
            at, step = np.unravel_index(flat, slope.shape), 1e-3
            part[at] += step
            above = net.gradient(made, label)[0]
            part[at] -= 2 * step
            below = net.gradient(made, label)[0]
            part[at] += step
            close += np.isclose(slope[at], (above - below) / (2 * step), rtol=0.02, atol=1e-5)
        assert close >= 6  # a step may change which place is the largest


def test_odd_rows(spark, make):
    good, bad = "the quick brown fox " * 8, "x#%| zq$$ ## " * 8
    rows = [(i, f"{good}{i}" if i % 2 else f"{bad}{i}") for i in range(60)]
    rows += [(100, None), (101, ""), (None, good), (102, good * 3000), (5, good), (5, good)]
    labels = spark.createDataFrame(
        [(i, i % 2, 0) for i in range(60)] + [(5, 0, 0), (100, None, 1), (999, 1, 1), (None, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    found = qc.op11_quality_cnn(make(rows), labels).collect()
    assert len(found) == len(rows) and all(0 <= r["score"] <= 1 for r in found)
    score = {r["doc_id"]: r["score"] for r in found}
    assert score[102] > 0.5 and score[7] > 0.5 > score[8]
    one = qc.op11_quality_cnn(make(rows), labels.filter("quality = 1")).collect()
    assert {round(r["score"], 6) for r in one} == {one[0]["score"].__round__(6)} and one[0]["predicted"] == 1
    assert qc.op11_quality_cnn(make([]), labels).count() == 0
    assert {r["score"] for r in qc.op11_quality_cnn(make(rows), labels.limit(0)).collect()} == {0.5}


def test_sample_is_bounded_and_keeps_labels(spark, make):
    """Many rows under one id bring no more than the bound, each with its own label once."""
    docs = make([(1, f"text {i}") for i in range(300)] + [(2, "same")] * 50)
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    pairs, size = qc.sample_texts(docs, labels, "doc_id", "text", "quality", 30)
    assert size == {True: 300, False: 1}
    assert 10 < sum(one for _, one in pairs) <= 30 and [t for t, one in pairs if not one] == ["same"]
