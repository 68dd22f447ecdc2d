"""Operators with models: held-out accuracy, edge cases, and planted copies."""

import re
from collections import Counter

import numpy as np

import corpus_pipeline
from phenoloom.llm import decontaminate, language_id, secret_scan, toxicity

BIG = "/root/testdata/sf0.01"


def test_language_model_sums_all_segmentations():
    model = language_id.SegmentModel(["▁", "a", "ab", "b", "▁a"], ["x"])
    model.prob[1:, 0] = [0.1, 0.2, 0.3, 0.15, 0.25]
    p = dict(zip(model.pieces, model.prob[1:, 0]))
    want = p["▁"] * p["a"] * p["b"] + p["▁"] * p["ab"] + p["▁a"] * p["b"]
    assert np.isclose(np.exp(model.log_prob(["ab"])[0, 0]), want)
    long = model.log_prob(["ab" * 40])
    assert np.isfinite(long).all()


def test_languages_of_letters_without_pieces():
    vocabulary = language_id.read_vocabulary(language_id.public_tokenizers.path("piece_bpe_32k.model"))
    assert max(map(len, vocabulary)) > 8 and {"▁information", "▁different"} <= set(vocabulary)
    # a letter in no piece has one way to be spelled, so its bytes factor out of the sums
    assert {c for p in vocabulary for c in p} <= set(vocabulary)
    odia, lao = ["ଓଡ଼ିଆ", "ଭାଷା", "ଲୋକ"], ["ພາສາ", "ລາວ", "ຄົນ"]
    letters = [language_id.words_of(" ".join(x)) for x in (odia, lao)]
    model = language_id.SegmentModel(vocabulary, ["lo", "or"]).fit([Counter(letters[1]), Counter(letters[0])])
    logs = [model.log_prob(x).sum(axis=0) for x in letters]
    assert logs[0][1] - logs[0][0] > 20 and logs[1][0] - logs[1][1] > 20
    assert np.allclose(model.prob.sum(axis=0) + np.exp(model.byte_log).sum(axis=0), 1)


def test_language_accuracy(spark):
    docs = spark.read.parquet(f"{BIG}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.collect()}
    found = [r for r in language_id.op9_language_id(docs).collect() if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in found]) > 0.95


def test_language_odd_rows(make, documents):
    rows = [(1, None), (2, ""), (3, "123 ..."), (4, "½ ²"), (5, "x"), (None, "the the"), (7, "ab" * 40000)]
    docs = make(rows).withColumnRenamed("score", "lang_score")
    found = language_id.identify_language(docs, documents)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in found.collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 4)) and got[5][0] != "und"
    assert found.columns == [*docs.columns, "lang_pred", "score"]
    nothing = language_id.identify_language(make(rows), documents.limit(0))
    assert {r["lang_pred"] for r in nothing.collect()} == {"und"}
    assert language_id.op9_language_id(make([])).count() == 0


def auc(score, label):
    order = np.argsort(score)
    rank = np.empty(len(score))
    rank[order] = np.arange(len(score))
    ones = label.sum()
    return (rank[label == 1].sum() - ones * (ones - 1) / 2) / (ones * (len(label) - ones))


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in toxicity.op1_toxicity(docs, labels).collect() if r["held_out"] and r["doc_id"] in toxic]
    score, label = np.array([r["score"] for r in rows]), np.array([toxic[r["doc_id"]] for r in rows])
    assert auc(score, label) > 0.9
    flagged = score >= 0.5
    assert label[flagged].mean() > 0.75 and flagged[label == 1].mean() > 0.6
    assert all(r["predicted"] == (r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in rows)


def test_toxicity_odd_rows(spark, make):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (2, 0)], "doc_id long, toxic int")
    rows = [(1, None), (2, ""), (None, "a"), (2, ""), (3, "word " * 20000)]
    assert [r["score"] for r in toxicity.op1_toxicity(make(rows), labels).collect()] == [0.0] * 5
    assert toxicity.op1_toxicity(make([]), labels.limit(0)).count() == 0


def test_network_learns_and_keeps_recall():
    rng = np.random.default_rng(0)
    texts = []
    for i in range(150):
        value = "".join(rng.choice(list("0123456789abcdef"), 32))
        texts.append(f"set token = \"{value}\" for mail{i}.example-host.com and go")
    rows = [x for t in texts for x in secret_scan.labelled(t)]
    x, y = np.array([r[0] for r in rows]), np.array([float(r[1]) for r in rows])
    cut = len(y) * 3 // 4
    network = secret_scan.CharNetwork().fit(x[:cut], y[:cut], rounds=8).calibrate(x[cut:], y[cut:], 0.95)
    score = network.predict(x[cut:])
    assert (score[y[cut:] > 0] >= network.threshold).mean() >= 0.95
    assert (score[y[cut:] == 0] >= network.threshold).mean() < 0.1
    # upper case escapes the patterns, but not the network's kind of candidate
    assert secret_scan.candidates("key 9233A8ECF7C5B09FE594") == [(4, 24)]


def test_recall_rules_the_threshold(make):
    network = secret_scan.CharNetwork()
    network.predict = lambda x: np.array(x)[:, 0] / 100
    x = np.arange(20)[:, None]
    assert network.calibrate(x, np.ones(20), 0.95).threshold == 0.01
    part = secret_scan._fit_part(np.array([0.0] * 30 + [1.0] * 4))  # the last examples are not all of one label
    assert part.sum() == 25 and part[30:].sum() == 3


def test_rare_secrets_are_sampled(make):
    rng = np.random.default_rng(2)
    rows = [(i, f"mail{i}.example-host.com says nothing") for i in range(3000)]
    rows += [(3000 + i, "set token = \"" + "".join(rng.choice(list("0123456789abcdef"), 32)) + "\" and go") for i in range(8)]
    network = secret_scan.train(make(rows), "text", 40, 0.95)
    assert network is not None and network.threshold < 1


def test_runs_beside_base_findings_are_scored():
    network = secret_scan.CharNetwork()
    network.predict, network.threshold = lambda x: np.ones(len(x)), 0.5
    text = "x xoxb-1234567890123456-AbCdEfGhIjKl token=abcdef0123456789abcdef y"
    assert secret_scan.findings(text, network) == [("learned", 2, 36), ("hex", 7, 23), ("assign", 37, 65), ("hex", 43, 65)]


def test_middle_of_a_long_run_is_seen():
    network = secret_scan.CharNetwork()  # scores the share of digits in the field
    network._scores = lambda fields: ((fields >= ord("0") - 30) & (fields <= ord("9") - 30))[:, 24:64].mean(axis=1)
    network.threshold = 0.4
    run = "static/assets/some/more/Module/4901827-30594817-2093847-120/and/more/static/assets/index.min.js"
    for text, kinds in ((run, ["learned"]), (run.replace("30594817", "vendor/styles"), [])):
        assert [k for k, *_ in secret_scan.findings(f"see {text} there", network)] == kinds
    network = secret_scan.CharNetwork()
    fields = secret_scan.encode(run, 0, len(run))
    seen = ["".join(chr(c + 30) for c in row[24:64] if c) for row in fields]
    assert all(any(run[i : i + 20] in s for s in seen) for i in range(len(run) - 19))
    assert np.isclose(network.predict([fields])[0], max(network.predict(fields[:, None])))


def brute_alignment(a, b):
    best, row = 0, [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(max(0, row[j] + (2 if x == y else -1), row[j + 1] - 2, new[j] - 2))
        best, row = max(best, *new), new
    return best


def test_alignment():
    rng = np.random.default_rng(4)
    items, windows = rng.integers(1, 6, (40, 12)), rng.integers(1, 6, (40, 30))
    items[:, 10:] = 0
    score, _ = decontaminate.smith_waterman(items, windows)
    assert score.tolist() == [brute_alignment(a[:10], b) for a, b in zip(items.tolist(), windows.tolist())]


def test_leaks_against_brute_force(spark, documents, texts):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    listed = {r["item_id"]: words(r["text"]) for r in items.collect()}
    want = set()
    for i, text in texts.items():
        doc = words(text)
        for k, item in listed.items():
            grams = {tuple(item[j : j + 3]) for j in range(len(item) - 2)}
            if sum(tuple(doc[j : j + 3]) in grams for j in range(len(doc) - 2)) > 0.3 * len(grams):
                if brute_alignment(item, doc) >= len(item):
                    want.add((i, k))
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.op5_decontaminate(documents, items).collect()}
    assert found == want and want


def test_edited_copies(spark, make):
    rng = np.random.default_rng(6)
    item = [f"item{i}" for i in range(40)]
    edited = [w if rng.random() > 0.2 else "changed" for w in item]
    filler = [f"fill{i}" for i in range(400)]
    rows = [(1, " ".join(filler[:200] + item + filler[200:])), (2, " ".join(filler[:77] + edited + filler[77:])), (3, " ".join(filler)),
            (4, None), (5, ""), (None, " ".join(item)), (6, " ".join(item[:6])), (1, "repeated id"), (7, ", ".join(item[:20] + item[22:]).upper())]
    rows += [(100 + i, " ".join(item)) for i in range(200)]  # a group of copies does not hide the rest
    items = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, ""), (4, "too short")], "item_id long, text string").selectExpr("*", "1 AS gram")
    found = {r["doc_id"]: r["similarity"] for r in decontaminate.op5_decontaminate(make(rows), items).collect()}
    assert set(found) == {1, 2, 7, None, *range(100, 300)} and found[1] == 1.0 and found[2] < 1
    kept = decontaminate.drop_leaks(make(rows), items)
    assert sorted(r["doc_id"] for r in kept.collect()) == [3, 4, 5, 6] and kept.columns == make(rows).columns
    assert decontaminate.op5_decontaminate(make([]), items).count() == 0
    assert decontaminate.op5_decontaminate(make(rows), items.limit(0)).count() == 0


def test_whole_copy_hides_no_edited_one(spark, make):
    rng = np.random.default_rng(8)
    item = [f"item{i}" for i in range(40)]
    grams = {tuple(item[i : i + 3]) for i in range(38)}
    fifth = ["changed" if i % 5 == 4 else w for i, w in enumerate(item)]
    copies = [fifth] + [["changed" if x < share else w for w, x in zip(item, rng.random(40))] for share in (0.2, 0.25, 0.3) for _ in range(60)]
    want = {
        i for i, c in enumerate(copies)
        if brute_alignment(item, c) >= 40 and any(tuple(c[k : k + 3]) in grams for k in range(38))
    }
    items = spark.createDataFrame([(1, " ".join(item))], "item_id long, text string")
    for i in sorted(want):  # each beside one whole copy, and all together beside many
        assert 0.5 <= brute_alignment(item, copies[i]) / 80 < 1
    for k in sorted(want)[:3]:
        found = decontaminate.op5_decontaminate(make([(-1, " ".join(item)), (k, " ".join(copies[k]))]), items)
        assert {r["doc_id"] for r in found.collect()} == {-1, k}
    rows = [(-1 - i, " ".join(item)) for i in range(100)] + [(i, " ".join(c)) for i, c in enumerate(copies)]
    found = {r["doc_id"]: r["similarity"] for r in decontaminate.op5_decontaminate(make(rows), items).collect()}
    assert {i for i in found if i >= 0} == want and 0 in want and len(want) > 100
    assert all(found[i] == brute_alignment(item, copies[i]) / 80 for i in want)


def test_pipeline(spark, documents):
    folder = "/root/testdata/sf0.001"
    packed = corpus_pipeline.run(spark, folder).collect()
    assert packed and {"doc_id", "sequence_id", "offset", "ids_crc32"} <= set(packed[0].asDict())
    docs, counts = documents, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == documents.columns, name
        counts.append(docs.count())
    assert counts[0] == 200 and counts[1] == counts[0] and counts[1] > counts[2] > counts[3]
    kept = {r["doc_id"] for r in docs.select("doc_id").collect()}
    assert {r["doc_id"] for r in packed} == kept


def test_pipeline_odd_rows(spark, make):
    rows = [(1, None), (2, ""), (None, "the and of"), (3, "the and of to in is"), (3, "the and of to in is"), (4, "le la " * 5000), (5, "12")]
    extra = make(rows, extra=False).selectExpr("*", "1 AS _id", "2 AS _root", "3 AS doc")
    docs = extra.withColumn("lang", extra["source"])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == extra.columns, name
    assert Counter(r["doc_id"] for r in docs.collect()) == {None: 1, 3: 1, 4: 1}
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, extra.limit(0), "/root/testdata/sf0.001").count() == 0, name


def test_common_phrase_brings_no_pairs(spark, make):
    """A phrase in all documents and all items is no seed; copies and edited copies are still found."""
    rng = np.random.default_rng(11)
    word = lambda: "".join(rng.choice(list("abcdefghij"), 7))
    phrase = "it is not the case that"
    items = [(k, " ".join([*(word() for _ in range(12)), phrase, *(word() for _ in range(12))])) for k in range(60)]
    docs = [(k, " ".join([*(word() for _ in range(40)), phrase, *(word() for _ in range(40))])) for k in range(120)]
    docs += [(1000 + k, text) for k, text in items[:5]] + [(2000 + k, " ".join(w if i % 4 else "zz" for i, w in enumerate(items[7][1].split()))) for k in range(30)]
    table = spark.createDataFrame(items, "item_id long, text string")
    met = []
    plain = decontaminate._align
    decontaminate._align = lambda pairs: met.append(pairs.count()) or plain(pairs)
    try:
        found = {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(make(docs), table).collect()}
    finally:
        decontaminate._align = plain
    assert found == {(1000 + k, k) for k in range(5)} | {(2000 + k, 7) for k in range(30)}
    assert met[0] < 3 * len(docs)  # all pairs would be 9,300


def test_open_sequences_hold_their_own_ids():
    from phenoloom.llm.packing import TokenPacker, Tokens

    packer = TokenPacker((1024, 128, 1024), 4)
    for name in range(50):
        n = 1024 * 20 + 37 * (name % 9) + 1
        list(packer.add((Tokens(name, n, 0, bytes(4 * n)), 0, n, n)))
        assert sum(len(p[0].ids) for b in packer.open for p in b.pieces) <= 4 * 4 * 1024


def test_stages_keep_columns_of_any_name(spark, make):
    """Columns named as the stages' own helpers stay as they are, through all stages but the last."""
    names = ["_leak", "_kid", "_KTH", "_row_hash", "_row_hash_", "_lang_pred", "_lang_score", "_n_lines", "_n_dropped"]
    text = "the quick brown fox jumps over the lazy dog and is it not the case that with all this"
    docs = make([(i, f"{text} {i} {'lorem ipsum ' * i}") for i in range(6)] + [(None, text)], extra=False)
    docs = docs.selectExpr("*", *[f"concat('{n}', doc_id) AS `{n}`" for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, "/root/testdata/sf0.001")
        assert kept.columns == docs.columns
        rows = kept.collect()
        assert rows and all(r[n] == (None if r["doc_id"] is None else f"{n}{r['doc_id']}") for r in rows for n in names)
    leaked = decontaminate.drop_leaks(docs, spark.createDataFrame([(1, f"{text} 3")], "item_id long, text string"))
    assert {r["doc_id"] for r in leaked.collect()} == set() and leaked.columns == docs.columns


def test_all_texts_train_the_network(make):
    """Slopes and threshold come from every candidate, however small ``most_documents`` is."""
    rng = np.random.default_rng(5)
    rows = [(i, f"mail{i}.example-host.com says nothing") for i in range(300)]
    rows += [(300 + i, "set token = \"" + "".join(rng.choice(list("0123456789abcdef"), 32)) + "\" and go") for i in range(300)]
    docs = make(rows)
    network = secret_scan.train(docs, "text", 40, 0.95, steps=4)
    examples = secret_scan._examples(docs, "text")
    found = examples.collect()
    assert len(found) == 300 + 2 * 300
    fields = lambda some: [np.frombuffer(r["codes"], dtype=np.uint8).reshape(-1, secret_scan.WIDTH) for r in some]
    scores = np.sort(network.predict(fields([r for r in found if r["aside"] and r["label"]])))
    assert len(scores) > 40 and np.isclose(network.threshold, scores[int((1 - 0.95) * len(scores))])
    y = np.array([float(r["label"]) for r in found])
    whole = network.slopes(fields(found), y, np.where(y > 0, 0.3, 0.7))
    summed = secret_scan._summed_slopes(examples, network, {1: 0.3, 0: 0.7}, 7)
    assert all(np.allclose(whole[k], summed[k]) for k in whole)


def test_passes_over_the_examples_are_dealt_to_tasks(make):
    """Every pass reads them from files of bounded size, not from one that adaptive execution merged."""
    docs = make([(i, " ".join(f"mail{i}x{j}.example-host.com" for j in range(50))) for i in range(200)])
    found = secret_scan._examples(docs, "text")
    assert found.count() == 10000 and found.select("codes").distinct().count() == 10000
    per_file = [r["count"] for r in found.groupBy(secret_scan.F.input_file_name()).count().collect()]
    assert max(per_file) < 2 * secret_scan.PER_FILE


def test_slopes_of_the_embedding():
    """Sums per class are those of adding place by place."""
    rng = np.random.default_rng(8)
    network = secret_scan.CharNetwork()
    x, y = rng.integers(0, secret_scan.N_CLASSES, (30, 1, secret_scan.WIDTH)).astype(np.uint8), rng.integers(0, 2, 30).astype(float)
    whole = network.slopes(x, y, np.ones(30))["embed"]
    step = 1e-6

    def loss():
        p = np.clip(network.predict(x), 1e-12, 1 - 1e-12)
        return -(y * np.log(p) + (1 - y) * np.log(1 - p)).sum()

    for at in [(40, 3), (0, 0), (96, 7)]:
        network.w["embed"][at] += step
        up = loss()
        network.w["embed"][at] -= 2 * step
        down = loss()
        network.w["embed"][at] += step
        assert np.isclose(whole[at], (up - down) / (2 * step), rtol=1e-3, atol=1e-3)
