"""Columns whose absent cells count as 0: counts, unions and exports against a dense table."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from phenoloom.model import PHENO_KEY, SEXES, MatrixFrame
from phenoloom.operators import combine, defaults, export, reshape

HOLDS = {"females": 0, "males": 1}


def made(spark, seed):
    """Three sources over different people: with a default for their rows, for all, and without."""
    rng = random.Random(seed)
    people = range(25)
    sex = {p: rng.choice([0, 1, None]) for p in people}
    frames, truth = [], {}
    for name, default in (("icd", "icd"), ("drugs", "*"), ("plain", None)):
        own = sorted(rng.sample(people, 15))
        cells = {(p, f"{name}{k}"): rng.choice([1.0, 0.0, None]) for p in own for k in range(4) if rng.random() < 0.3}
        rows = spark.createDataFrame([(p, sex[p]) for p in own], "userId int, sex int")
        cols = spark.createDataFrame([(f"{name}{k}",) for k in range(4)], "code string")
        values = [F.col("v").alias("both_sexes"), F.when(F.col("sex") == 0, F.col("v")).alias("females"), F.when(F.col("sex") == 1, F.col("v")).alias("males")]
        entries = spark.createDataFrame([(p, c, v, sex[p]) for (p, c), v in cells.items()], "userId int, code string, v double, sex int")
        frame = MatrixFrame(rows, cols, entries.select("userId", "code", *values), ["userId"], ["code"])
        frames.append(defaults.with_default(frame, 0.0, default) if default else frame)
        for k in range(4):
            truth[f"{name}{k}"] = (default, set(own), cells)
    return frames, truth, sex


def dense(truth, sex, rows):
    out = {}
    for code, (default, own, cells) in truth.items():
        for p in rows:
            for field in SEXES:
                by_sex = field not in HOLDS or sex[p] == HOLDS[field]
                if (p, code) in cells:
                    value = cells[p, code] if by_sex else None
                elif default == "*" or (default and p in own and by_sex):
                    value = 0.0
                else:
                    value = None
                out[p, code, field] = value
    return out


@pytest.mark.parametrize("how", ["outer", "left", "inner"])
def test_unions_and_counts_against_dense(spark, how):
    frames, truth, sex = made(spark, 3)
    full = reshape.union_cols(frames, how)
    own = [truth[c][1] for c in ("icd0", "drugs0", "plain0")]
    rows = own[0] | own[1] | own[2] if how == "outer" else own[0] if how == "left" else own[0] & own[1] & own[2]
    assert {r.userId for r in full.rows.collect()} == rows
    want = dense(truth, sex, rows)
    for field in SEXES:
        sums = defaultdict(lambda: [0, 0, 0])
        for (p, code, f), value in want.items():
            if f == field:
                n = sums[code, value]
                n[0], n[1], n[2] = n[0] + 1, n[1] + p, n[2] + p * p
        table = defaults.cells_by_value(full, field, {"ids": F.col("userId"), "squares": F.col("userId") ** 2})
        assert {(r.code, r.value): [r.n, r.ids, r.squares] for r in table.collect()} == dict(sums)
    cells = {(r.userId, r.code, f): r[f] for r in defaults.dense_cells(full, SEXES).collect() for f in SEXES}
    assert cells == want
    plan = defaults.cells_by_value(full, "both_sexes")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def icd_source(spark):
    codes = spark.createDataFrame([(1, "E11", True), (2, "E11", True), (1, "I10", False)], "userId int, icd_code string, any_codes boolean")
    entries = codes.select("userId", "icd_code", F.lit(True).alias("truncated"), "any_codes")
    cols = spark.createDataFrame([(c, True, "icd10", "s", "m") for c in ("E11", "I10", "Z99")], "icd_code string, truncated boolean, icd_version string, short_meaning string, meaning string")
    rows = spark.createDataFrame([(i,) for i in range(1, 5)], "userId int")
    return MatrixFrame(rows, cols, entries, ["userId"], ["icd_code", "truncated"])


@pytest.mark.parametrize("implicit", [True, False])
def test_simple_combination_counts_false_cells(spark, implicit):
    """Four people, codes of two: all four are defined in every column, also in one that nobody has."""
    full = combine.combine_sources_simple({"icd": icd_source(spark)}, implicit=implicit)
    counts = {r.pheno: (r.n_cases, r.n_defined) for r in full.cols.collect()}
    assert counts == {"E11": (2, 4), "I10": (0, 4), "Z99": (0, 4)}
    cells = defaults.cells_by_value(full, "value")
    assert {(r.pheno, r.value): r.n for r in cells.collect()} == {("E11", 1.0): 2, ("E11", 0.0): 2, ("I10", 0.0): 4, ("Z99", 0.0): 4}
    assert full.entries.count() == (3 if implicit else 12)


def test_implicit_and_stored_zeros_export_alike(spark):
    """Rows of other sources are missing, not 0; both forms write the same values."""
    covariates = spark.createDataFrame([(i, i % 2) for i in range(1, 8)], "userId int, sex int")
    measured = MatrixFrame(
        spark.createDataFrame([(5,), (1,)], "userId int"), spark.createDataFrame([("b", "f", "p")], "pheno string, Field string, Path string"),
        spark.createDataFrame([(5, "b", 1.5)], "userId int, pheno string, value double"), ["userId"], ["pheno"],
    )
    requests = spark.createDataFrame([("icd10", c, s, "", "") for c in ("E11", "Z99") for s in ("females", "both_sexes")], ", ".join(f"{k} string" for k in PHENO_KEY))
    got = []
    for implicit in (True, False):
        full = combine.combine_sources({"icd": icd_source(spark), "biomarkers": measured}, covariates, implicit=implicit)
        rows = export.export_values(full, requests).collect()
        got.append({(r.userId, r.phenocode, r.asked): r.value for r in rows if r.value is not None})
    assert got[0] == got[1] and got[0][3, "Z99", "both_sexes"] == 0.0 and got[0][2, "E11", "females"] == 1.0
    assert (5, "Z99", "both_sexes") not in got[0] and (3, "Z99", "females") not in got[0]


def test_false_cells_are_made_once(spark):
    """The zeros of prescriptions do not make the false cells of diagnosis codes again."""
    codes = spark.createDataFrame([(1, "A01"), (2, "B02")], "userId long, icd_code string")
    cols = codes.select("icd_code").distinct().withColumns({"truncated": F.lit(False), "short_meaning": F.lit("s"), "meaning": F.lit("m")})
    icd = MatrixFrame(codes.select("userId"), cols, codes.withColumns({"truncated": F.lit(False), "any_codes": F.lit(True)}), ["userId"], ["icd_code", "truncated"])
    records = spark.createDataFrame([(1, "d", "c", 1)], "eid long, Generic_Name string, Drug_Category_and_Indication string, n_records long")
    key = ["Generic_Name", "Drug_Category_and_Indication"]
    drugs = MatrixFrame(records.select("eid"), records.select(*key), records, ["eid"], key)
    sexes = spark.createDataFrame([(1, 0), (2, 1)], "userId long, sex int")
    full = combine.combine_sources({"icd": icd, "prescriptions": drugs}, sexes)
    plan = full.entries._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    made = [i for i, line in enumerate(lines) if "Generate inline(" in line and "LocalRelation <empty>" not in lines[i + 1]]
    assert len(made) == 2, plan
    cells = {(r["userId"], r["trait_type"], r["phenocode"]): (r["both_sexes"], r["females"], r["males"]) for r in full.entries.collect()}
    assert len(cells) == 8
    assert cells[1, "icd10", "A01"] == (1.0, 1.0, None) and cells[1, "icd10", "B02"] == (0.0, 0.0, None)
    assert cells[2, "icd10", "A01"] == (0.0, None, 0.0) and cells[2, "prescriptions", "d"] == (0.0, 0.0, 0.0)
