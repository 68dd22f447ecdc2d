"""Facts below markers: the carry scan against a plain walk, and what it exchanges."""

import random

import pyarrow as pa
import pytest

from phenoloom.operators import logs, logscan
from phenoloom.sources import readers

MARKERS = [logscan.Marker("A", 1), logscan.Marker("B", 2), logscan.Marker("C", 0), logscan.Marker("AB", 3)]


def walk(files):
    """(file, marker's line, fact, text below) by looking down from every marker."""
    out = []
    for name, texts in files.items():
        for i, text in enumerate(texts):
            for fact, m in enumerate(MARKERS):
                if text is not None and text.startswith(m.text) and i + m.below < len(texts) and texts[i + m.below] is not None:
                    out.append((name, i, fact, texts[i + m.below]))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_lines_below_against_a_walk(spark, seed):
    """Random files in random blocks, the blocks cut over partitions and batches at random."""
    rng = random.Random(seed)
    files = {f"f{k}": [rng.choice(["A", "B", "C", "ABx", "x", "", "y1"]) for _ in range(rng.randint(1, 60))] for k in range(12)}
    rows = []
    for name, texts in files.items():
        block = start = 0
        for i, text in enumerate(texts):
            if rng.random() < 0.3:
                block, start = block + 1, i
            rows.append((name, block, i - start, text))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rng.choice([3, 7, 1000])))
    try:
        lines = spark.createDataFrame(spark.sparkContext.parallelize(rows, rng.choice([1, 2, 5])), "file string, block int, line int, value string")
        found, seen = logscan.lines_below(lines, MARKERS)
        place = {(r[0], r[1], r[2]): sum(1 for q in rows[:i] if q[0] == r[0]) for i, r in enumerate(rows)}
        got = sorted((r["file"], place[r["file"], r["at"]["block"], r["at"]["line"]], r["fact"], r["text"]) for r in found.collect())
        assert got == walk(files) and {r["file"] for r in seen.collect()} == set(files)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_long_run_is_not_held():
    """A run over many batches keeps no more lines than a marker may ask for."""
    scan = logscan.CarryScan(MARKERS)
    for k in range(50):
        batch = pa.RecordBatch.from_pydict({"file": ["f"] * 100, "block": [0] * 100, "line": list(range(100 * k, 100 * k + 100)), "value": ["A"] * 100})
        batches = list(scan.feed(batch))
        assert len(scan.held) == scan.depth
        assert sum(b.num_rows for b in batches if logscan.HEAD in b.column("kind").to_pylist()) == (k == 0)


def test_no_line_is_exchanged(spark, tmp_path, monkeypatch):
    """The pass over the lines has no exchange; what follows has the scan's few records."""
    (tmp_path / "a.log").write_text("other attached packages:\n[1] SAIGE_1\n")
    plans = []

    def watched(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return df

    monkeypatch.setattr(logscan, "stage", watched)
    facts = logs.facts_from_logs(readers.read_lines(spark, str(tmp_path)))
    assert len(plans) == 1 and "Exchange" not in plans[0] and "MapInArrow" in plans[0]
    assert facts.collect()[0]["saige_version"] == "SAIGE_1"


def test_all_facts_from_text_in_small_blocks(spark, tmp_path):
    """Every cut of the text into blocks gives the same facts."""
    body = ["Final 1 0.5 end", "other attached packages:", "[1] SAIGE_1.0", "$invNormalize", "[1] TRUE", "t_end - t_begin", " user ", "1 2 3", "Final 9 9 9"]
    (tmp_path / "one.log").write_text("\n".join(["x" * 40] * 20 + body + ["y" * 30] * 20) + "\n")
    (tmp_path / "two.log").write_text("nothing\n$invNormalize")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for size in (20, 150, 100000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            got = {r["file"][-7:]: tuple(r)[1:] for r in logs.facts_from_logs(readers.read_lines(spark, str(tmp_path))).collect()}
            assert got["two.log"] == ("NA", "Unknown", "NA", "NA", -1.0, -1.0)
            assert got["one.log"][:4] == ("SAIGE_1.0", "True", "1", "3") and got["one.log"][5] == pytest.approx(0.5 / 1.5)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_no_files(spark):
    empty = spark.createDataFrame([], "file string, block int, line int, value string")
    assert logs.facts_from_logs(empty).count() == 0


def test_lines_of_other_facts_stay_in_the_scan(spark, tmp_path, monkeypatch):
    """A fact asked for alone sends out its own lines and as much of a run's head as it may need."""
    (tmp_path / "a.log").write_text("other attached packages:\n[1] SAIGE_1\n$invNormalize\n[1] TRUE\nt_end - t_begin\nuser\n1 2 3\n")
    (tmp_path / "b.log").write_text("nothing")
    sent = []

    def watched(df):
        sent.append(df.collect())
        return df

    monkeypatch.setattr(logscan, "stage", watched)
    lines = readers.read_lines(spark, str(tmp_path))
    got = sorted((r["file"][-5:], r["saige_version"]) for r in logs.version_from_logs(lines).collect())
    assert got == [("a.log", "SAIGE_1"), ("b.log", "NA")]
    assert sorted(r["kind"] for r in sent[0]) == ["found", "head", "head"] and all(len(r["head"]) == 1 for r in sent[0] if r["head"])
    times = {r["file"][-5:]: (r["cpu"], r["wall"]) for r in logs.model_timing_from_logs(lines).collect()}
    assert times == {"a.log": ("1", "3"), "b.log": ("NA", "NA")} and len(sent[1]) == 3
    every = logs.facts_from_logs(lines)
    assert every.columns == ["file", "saige_version", "inv_normalized", "cpu", "wall", "heritability_binary", "heritability_quantitative"]
