import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from phenoloom.model import PHENO_KEY, MatrixFrame
from phenoloom.operators import codings, combine, icd, munging, pairwise, reshape
from phenoloom.plans import phenotype_queries
from phenoloom.plans.views import Tables


def entries_of(spark, matrix):
    """{row: [values]} to long entries; ``...`` marks an absent cell."""
    cells = [(r, c, v) for r, values in matrix.items() for c, v in enumerate(values) if v is not ...]
    return spark.createDataFrame(cells, "s int, c int, v boolean")


def test_wide_to_matrix_picks_types_and_splits_names(spark):
    wide = spark.createDataFrame(
        [(1, 40, 0, True, 1.5, 3, 9, "t"), (2, 50, 1, None, None, None, 9, "t")],
        "userId int, age int, sex int, `20004_1095_x` boolean, `50_irnt` double, `1717` int, big long, text string",
    )
    categorical = reshape.wide_to_matrix(wide, "categorical")
    rows = {r.userId: r for r in categorical.entries.collect()}
    assert (rows[1].phenocode, rows[1].coding, rows[1].modifier, rows[1].value) == ("20004", "1095_x", "", True)
    assert rows[2].value is None and len(rows) == 2
    assert categorical.rows.columns == ["userId", "age", "sex"]
    continuous = {(r.userId, r.phenocode): (r.modifier, r.value) for r in reshape.wide_to_matrix(wide, "continuous").entries.collect()}
    assert continuous[(1, "50")] == ("irnt", 1.5) and continuous[(1, "1717")] == ("", 3.0)
    assert set(c for _, c in continuous) == {"50", "1717"}
    plain = reshape.wide_to_matrix(wide, "continuous", rekey=False, keep_missing=False)
    assert {r.phesant_pheno for r in plain.entries.collect()} == {"50_irnt", "1717"} and plain.entries.count() == 2


def test_grouping_lists_and_names(spark):
    e = entries_of(spark, {1: [False, True, True, False], 2: [None, False, True, None], 3: [..., ..., True, True]})
    by_list = {(r.s, tuple(r.grouping)): r.new_entry for r in munging.group_columns(e, ["s"], "c", "v", [[0, 1], [0, 3]]).collect()}
    assert by_list == {(1, (0, 1)): True, (1, (0, 3)): False, (2, (0, 1)): False, (2, (0, 3)): False, (3, (0, 3)): True}
    named = munging.group_columns(e, ["s"], "c", "v", {"pheno01": [0, 1], "pheno03": [0, 3]}, function=F.count_if)
    assert {(r.s, r.grouping): r.new_entry for r in named.collect()}[(1, "pheno01")] == 1


def test_conditional_truth_table(spark):
    values = [True, False, None]
    for flip in (False, True):
        matrix = {i: list(p) for i, p in enumerate(itertools.product(values, values))}
        pair = [1, 0] if flip else [0, 1]
        got = {r.s: r.new_entry for r in munging.condition_columns(entries_of(spark, matrix), ["s"], "c", "v", [pair]).collect()}
        for s, cell in matrix.items():
            first, second = cell[pair[0]], cell[pair[1]]
            want = first if second and first is not None else None
            assert got[s] is want, (cell, flip)
    with pytest.raises(ValueError):
        munging.condition_columns(entries_of(spark, {0: [True]}), ["s"], "c", "v", [[1, 2, 3]])


def test_case_counts_with_unknown_sex(spark):
    df = spark.createDataFrame([(True, 0), (True, 1), (True, None), (None, 0), (False, 1)], "v boolean, sex int")
    row = df.agg(*munging.case_counts(F.col("v"), F.col("sex"))).collect()[0]
    assert tuple(row) == (2, 3, 1, 1)


@pytest.mark.parametrize("col_block", [2, 3, 1024])
def test_pairwise_overlap_matches_numpy(spark, col_block):
    rng = np.random.default_rng(5)
    x = rng.random((300, 7)) < 0.2
    x[:, 5] = False
    x[:30, 5] = True
    x[:, 6] = False
    x[30:60, 6] = True  # never together with column 5
    x[0] = True
    x[0, 5] = x[0, 6] = False
    cells = [(int(i), f"p{j}", True) for i, j in zip(*np.nonzero(x))]
    df = spark.createDataFrame(cells, "s long, c string, v boolean")
    got = {
        (r.i_data.c, r.j_data.c): (r.entry, r.prop_overlap)
        for r in pairwise.pairwise_overlap(df, "s", ["c"], "v", min_cases=29, col_block=col_block).collect()
    }
    n = x.sum(axis=0)
    kept = [j for j in range(7) if n[j] >= 29]
    assert set(got) == {(f"p{i}", f"p{j}") for i in kept for j in kept}
    for i in kept:
        for j in kept:
            both = (x[:, i] & x[:, j]).sum()
            assert got[(f"p{i}", f"p{j}")] == (both, both / n[i])


def test_pairwise_correlation_is_mean_imputed(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(200, 4))
    x[:, 1] += x[:, 0]
    x[rng.random(x.shape) < 0.3] = np.nan
    x[:, 3] = 2.0  # no spread
    cells = [(i, j, float(x[i, j])) for i in range(200) for j in range(4) if not np.isnan(x[i, j])]
    df = spark.createDataFrame(cells, "s int, c int, v double")
    got = {(r.i_data.c, r.j_data.c): r.entry for r in pairwise.pairwise_correlation(df, "s", ["c"], "v", col_block=2).collect()}
    filled = np.where(np.isnan(x), np.nanmean(x, axis=0), x)[:, :3]
    want = np.corrcoef(filled.T)
    for i in range(3):
        for j in range(3):
            assert got[(i, j)] == pytest.approx(want[i, j], abs=1e-12)
        assert np.isnan(got[(i, 3)])


def test_icd_matrix_and_rollup(spark, tmp_path):
    wide = spark.createDataFrame(
        [(1, "I21", "I210", None, None), (2, None, "I2101", "E11", None), (3, None, None, None, None), (4, "E11", None, None, "K50")],
        "userId int, x41202_0_0 string, x41202_0_1 string, x41204_0_0 string, x40001_0_0 string",
    )
    meanings = spark.createDataFrame([("I21", "attack"), ("E11", "diabetes")], "coding string, meaning string")
    frame = icd.load_icd(wide, meanings)
    assert frame.rows.count() == 4
    cells = {(r.userId, r.icd_code, r.truncated): r for r in frame.entries.collect()}
    assert set(cells) == {
        (1, "I21", False), (1, "I210", False), (2, "I2101", False), (2, "E11", False), (4, "E11", False), (4, "K50", False), (1, "I21", True),
    }
    assert cells[(2, "E11", False)].secondary_codes and not cells[(2, "E11", False)].primary_codes
    assert cells[(4, "K50", False)].cause_of_death_codes
    cols = {(r.icd_code, r.truncated): r.meaning for r in frame.cols.collect()}
    assert cols[("I21", True)] == "attack" and cols[("K50", False)] is None
    kept = {(r.icd_code, r.truncated) for r in icd.prefer_truncated(frame).cols.collect()}
    assert kept == {("I21", True), ("E11", False), ("K50", False)}


def test_full_meanings_orphans_depth_and_cycles(spark):
    schema = "coding string, meaning string, node_id int, parent_id int, selectable string"
    rows = [("a", "A", 1, 0, "N"), ("b", "B", 2, 1, "N"), ("c", "C", 3, 2, "Y"), ("d", "D", 4, 3, "Y"), ("o", "O", 5, 99, "Y"), ("p", "P", 6, 5, "Y")]
    got = {r.coding: r for r in codings.full_meanings(spark.createDataFrame(rows, schema)).collect()}
    assert got["d"].meaning == "A | B | C | D" and got["d"].parent_id == 3 and got["d"].short_meaning == "D"
    assert got["a"].meaning == "A" and got["o"].meaning is None and got["p"].meaning is None
    loop = rows + [("x", "X", 7, 8, "Y"), ("y", "Y", 8, 7, "Y")]
    with pytest.raises(ValueError):
        codings.full_meanings(spark.createDataFrame(loop, schema))
    chain = [(f"n{i}", "m", i, i - 1, "Y") for i in range(1, 5001)]
    deep = {r.node_id: r.meaning for r in codings.full_meanings(spark.createDataFrame(chain + [("q", "Q", 9000, None, "Y"), ("r", "R", 9001, 9000, "Y")], schema)).collect()}
    assert deep[5000].count("m") == 5000 and deep[1] == "m" and deep[9000] is None and deep[9001] is None
    # A missing parent means the same whether or not other chains are in the table.
    alone = codings.full_meanings(spark.createDataFrame([("q", "Q", 9000, None, "Y"), ("r", "R", 9001, 9000, "Y")], schema))
    assert {r.meaning for r in alone.collect()} == {None}


def test_icd_controls_are_people(spark):
    rows = [(1, "primary_codes", "A01"), (2, "secondary_codes", "A01"), (3, "primary_codes", "B02"), (4, "primary_codes", "B02")]
    frame = icd.icd_matrix(spark.createDataFrame(rows, "userId long, source string, icd_code string"))
    got = {r.icd_code: r for r in munging.count_cases(frame, "icd").cols.collect()}
    assert (got["A01"].n_cases, got["A01"].n_controls, got["A01"].n_controls_all) == (1, 3, 2)


def test_reassignments_keep_own_coding(spark):
    summary = spark.createDataFrame(
        [("10_2", "x 1=2|3=NA"), ("10", "x 1=2"), ("11_5", "x 1=4"), ("12_1", None)], "FieldID string, `PHESANT.reassignments` string"
    )
    assert [tuple(r) for r in codings.reassignments(summary).collect()] == [("10", "2", "1", "2")]


def source(spark, cells, cols, row="userId", key=("pheno",), schema=""):
    entries = spark.createDataFrame(cells, schema)
    return MatrixFrame(entries.select(row).distinct(), cols, entries, [row], list(key))


def test_combine_sources_counts_fill_and_rows(spark):
    covariates = spark.createDataFrame([(1, 0), (2, 1), (3, None), (4, 1), (1, 0)], "userId int, sex int")
    phecode = source(
        spark, [(1, "401", "", True), (2, "401", "", False), (3, "401", "", True), (2, "402", "", None)],
        spark.createDataFrame([("401", "", "d", "g"), ("402", "", "d", "g")], "phecode string, phecode_sex string, phecode_description string, phecode_group string"),
        key=("phecode", "phecode_sex"), schema="userId int, phecode string, phecode_sex string, case_control boolean",
    )
    drugs = source(
        spark, [(4, "a/b,c", "cat", 2)], spark.createDataFrame([("a/b,c", "cat")], "Generic_Name string, Drug_Category_and_Indication string"),
        row="eid", key=("Generic_Name", "Drug_Category_and_Indication"),
        schema="eid int, Generic_Name string, Drug_Category_and_Indication string, n_records int",
    )
    first = source(
        spark, [(1, "icd_first_occurrence", "131494", "both_sexes", "", "", 0.0), (2, "icd_first_occurrence", "131494", "both_sexes", "", "", None)],
        spark.createDataFrame([("icd_first_occurrence", "131494", "both_sexes", "", "", "F", "N", "P")], ", ".join(f"{k} string" for k in [*PHENO_KEY, "Field", "Notes", "Path"])),
        key=tuple(PHENO_KEY), schema="userId int, " + ", ".join(f"{k} string" for k in PHENO_KEY) + ", value double",
    )
    full = combine.combine_sources({"phecode": phecode, "prescriptions": drugs, "icd_first_occurrence": first}, covariates)
    cols = {r.phenocode: r for r in full.cols.collect()}
    assert (cols["401"].n_cases_defined, cols["401"].n_cases_both_sexes, cols["401"].n_cases_females, cols["401"].n_cases_males) == (1, 2, 1, 0)
    assert cols["402"].n_cases_both_sexes == 0
    assert cols["a_b|c"].category == "cat" and cols["cat"].category is None
    assert cols["131494"].n_cases_both_sexes == 1 and cols["131494"].description_more == "N"
    cells = {(r.userId, r.phenocode): (r.both_sexes, r.females, r.males) for r in full.entries.collect()}
    assert {r.userId for r in full.rows.collect()} == {1, 2, 3, 4}
    assert cells[(1, "a_b|c")] == (0.0, 0.0, 0.0) and cells[(4, "cat")] == (1.0, 0.0, 1.0)
    assert cells[(3, "401")] == (1.0, None, None) and cells[(2, "131494")] == (0.0, None, 0.0)


def test_combine_simple_rejects_unknown_and_keeps_shared_rows(spark):
    a = source(spark, [(1, 10, "", True), (2, 10, "", False)], spark.createDataFrame([(10, "")], "pheno int, coding string"),
               key=("pheno", "coding"), schema="userId int, pheno int, coding string, value boolean")
    b = source(spark, [(2, "401", "", True), (3, "401", "", True)], spark.createDataFrame([("401", "")], "phecode string, phecode_sex string"),
               key=("phecode", "phecode_sex"), schema="userId int, phecode string, phecode_sex string, case_control boolean")
    full = combine.combine_sources_simple({"categorical": a, "phecode": b})
    assert {(r.userId, r.pheno, r.value) for r in full.entries.collect()} == {(2, "10", 0.0), (2, "401", 1.0)}
    assert {r.pheno: (r.n_cases, r.n_defined) for r in full.cols.collect()} == {"10": (1, 2), "401": (2, 2)}
    with pytest.raises(ValueError):
        combine.combine_sources_simple({"odd": a.with_(col_key=["other"])})


def test_random_and_custom_sources(spark):
    covariates = spark.createDataFrame([(1, 0), (2, 1)], "userId int, sex int")
    random_source = source(
        spark, [(1, "x_1_continuous_7", 0.5), (2, "x_2_strat_8", 0.0), (1, "x_2_strat_8", 2.0)],
        spark.createDataFrame([("x_1_continuous_7",), ("x_2_strat_8",)], "col_id string"),
        key=("col_id",), schema="userId int, col_id string, x double",
    )
    key_schema = ", ".join(f"{k} string" for k in PHENO_KEY)
    custom = source(
        spark, [(1, "categorical", "c", "both_sexes", "", "", 1.0), (2, "categorical", "c", "both_sexes", "", "", 2.0)],
        spark.createDataFrame([("categorical", "c", "both_sexes", "", "", "text")], key_schema + ", description string"),
        key=tuple(PHENO_KEY), schema=f"userId int, {key_schema}, value double",
    )
    cols = {tuple(r[k] for k in PHENO_KEY): r for r in combine.combine_sources({"random": random_source, "custom": custom}, covariates).cols.collect()}
    assert cols[("continuous", "random_continuous", "both_sexes", "7", "")].n_cases_females == 1
    assert cols[("categorical", "random_strat", "both_sexes", "8", "2")].n_cases_both_sexes == 1
    assert cols[("categorical", "c", "both_sexes", "", "")].n_cases_both_sexes == 1
    assert cols[("categorical", "c", "both_sexes", "", "")].description == "text"


def test_hoisting_query_is_dealt_to_all_partitions(spark, tmp_path):
    """The tasks that join, hoist and sum get a share of the orders each; they are not merged into larger ones."""
    orders = [(i, "OFP"[i % 3], i / 4) for i in range(400)] + [(None, "O", 1.0)]
    lines = [(i, i % 7, float(j)) for i in range(0, 500, 2) for j in range(1 + i % 3)] + [(None, 1, 1.0)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    result = phenotype_queries.p4(Tables(spark, str(tmp_path)))
    got = result.withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in got}) == 8
    want = {i: ("OFP"[i % 3], i / 4, 1 + i % 3, float(sum(range(1 + i % 3)))) for i in range(0, 400, 2)}
    assert len(got) == len(want)
    assert {r.order_id: (r.status, r.price, r.n_entries, r.quantity) for r in got} == want


def test_rolled_up_codes_are_dealt_by_person(spark):
    """All people share one code; they are grouped by all tasks, not by the one of the code."""
    records = [(i, "primary_codes" if i % 2 else None, c) for i in range(300) for c in ("A01", "A012")] + [(None, "primary_codes", "A01")]
    frame = icd.icd_matrix(spark.createDataFrame(records, "userId long, source string, icd_code string"))
    got = frame.entries.filter("truncated").withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in got}) == 8
    people = {r.userId: (r.icd_code, r.primary_codes, r.any_codes) for r in got}
    assert len(got) == 301 and people == {i: ("A01", bool(i % 2), True) for i in range(300)} | {None: ("A01", True, True)}


def test_cells_of_combined_sources_read_staged_tables(spark, tmp_path):
    """Rows, columns and cells are made once; the counts of each field read them back."""
    tables = {
        "customer": ([(i, i % 5) for i in range(1, 31)], "c_custkey long, c_nationkey int"),
        "orders": ([(i, i % 20 + 1, "OFP"[i % 3], float(i), "5-LOW") for i in range(200)],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderpriority string"),
        "lineitem": ([(i, i % 4, i % 3, j) for i in range(200) for j in range(1, 4)], "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int"),
        "events": ([(i, "view", None) for i in range(25, 41)], "user_id long, event_type string, ts timestamp"),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    t = Tables(spark, str(tmp_path))
    codes = phenotype_queries.customer_codes(t).withColumn("task", F.spark_partition_id()).collect()
    assert len(codes) == 600 and len({r.task for r in codes}) == 8
    cells = phenotype_queries.a8_cells(t)
    assert not [f for f in cells.inputFiles() if str(tmp_path) in f]
    sums = {}
    for r in cells.collect():
        key = r.trait_type, r.phenocode, r.field
        n, ids = sums.get(key, (0, 0))
        sums[key] = n + r.n, ids + r.ids
    assert set(sums.values()) == {(40, sum(range(1, 41)))} and {k[0] for k in sums} == {"icd10", "biomarkers", "prescriptions"}
