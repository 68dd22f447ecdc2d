import math
import random
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from phenoloom.functions import keys
from phenoloom.functions.normal import MEDIAN_CHI2, chi2_upper_quantile, normal_quantile
from phenoloom.model import PHENO_KEY
from phenoloom.operators import jobs, results


def test_normal_quantile_matches_library(spark):
    ps = [1e-300, 1e-30, 1e-10, 1e-5, 0.01, 0.074, 0.075, 0.3, 0.5, 0.7, 0.925, 0.99, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in [*ps, 0.0, 1.0]], "p double")
    got = [r[0] for r in df.select(normal_quantile(F.col("p"))).collect()]
    for p, z in zip(ps, got):
        assert z == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-15)
    assert got[-2:] == [None, None]
    edge = spark.createDataFrame([(1.0,), (0.5,), (0.0,)], "p double").select(chi2_upper_quantile(F.col("p"))).collect()
    assert edge[0][0] == 0.0 and edge[1][0] == pytest.approx(MEDIAN_CHI2, rel=1e-12) and math.isinf(edge[2][0])


def test_lambda_by_cutoff(spark):
    rng = random.Random(1)
    rows = [("a", rng.random(), float(rng.choice([0, 1, 2, 5, 10]))) for _ in range(501)]
    rows += [("a", None, 5.0), ("a", math.nan, 5.0), ("a", 1e-9, 100.0), ("a", 0.5, math.nan), ("b", 1e-9, None)]
    df = spark.createDataFrame(rows, "ph string, p double, x double")
    got = {(r.ph, r.cutoff): r for r in results.lambda_by_cutoff(df, ["ph"], "p", "x", [0, 5, 100, 200]).collect()}
    q = lambda p: NormalDist().inv_cdf(p / 2) ** 2
    for c in (0, 5, 100):
        chosen = [p for ph, p, x in rows if ph == "a" and x is not None and x >= c]
        ps = sorted(p for p in chosen if p is not None and not math.isnan(p))
        lam = (q(ps[(len(ps) + 1) // 2 - 1]) + q(ps[len(ps) // 2])) / 2 / MEDIAN_CHI2
        row = got[("a", float(c))]
        assert (row.n_variants, row.n_sig) == (len(chosen), 1)
        assert row.lambda_gc == pytest.approx(lam, rel=1e-9)
    assert (got[("a", 200.0)].n_variants, got[("a", 200.0)].lambda_gc) == (0, None)
    assert got[("b", 0.0)].n_variants == 0


def test_lambda_follows_log_flag(spark):
    key = dict.fromkeys(PHENO_KEY, "k")
    base = spark.createDataFrame([(math.log(0.2), 0.01, 0.3), (math.log(0.4), 0.01, 0.3)], "Pvalue double, `AF.Cases` double, AF_Allele2 double")
    entries = base.withColumns({k: F.lit(v) for k, v in key.items()})
    cols = entries.select(*PHENO_KEY).distinct().withColumn("n_cases", F.lit(500))
    logged = results.lambda_by_frequency(entries, cols.withColumn("log_pvalue", F.lit(True))).filter("ac = 10").collect()[0]
    assert logged.n_variants_by_case_ac == 2 and logged.lambda_gc_by_case_ac > 1
    raw = results.lambda_by_frequency(entries.withColumn("Pvalue", F.exp("Pvalue")), cols).filter("ac = 10").collect()[0]
    assert raw.lambda_gc_by_case_ac == pytest.approx(logged.lambda_gc_by_case_ac)
    packed = results.pack_by_cutoff(results.lambda_by_frequency(entries, cols, by="af"), PHENO_KEY, "af")
    assert results.explode_by_cutoff(packed, PHENO_KEY, "af").count() == len(results.AF_CUTOFFS)


def sumstats(spark, rows):
    schema = "pos int, phenotype string, pval double, tstat double, low_confidence_variant boolean"
    return spark.createDataFrame(rows, schema).withColumns(
        {"contig": F.lit("1"), "alleles": F.array(F.lit("A"), F.lit("T")), "rsid": F.lit("r"), "AF": F.lit(.1), "consequence": F.lit("c"), "info": F.lit(1.0)}
    )


def test_significance_thresholds_are_exact(spark):
    both = sumstats(spark, [(1, "p", 1e-6, 1.0, False), (2, "p", 1.1e-6, 1.0, False), (3, "p", 1e-9, 1.0, None), (4, "q", 5e-8, 1.0, False), (5, "q", 4e-8, 1.0, False), (6, "q", 1e-9, 1.0, True)])
    male = sumstats(spark, [(5, "p", 1e-9, 1.0, False)])
    hits = results.significant_by_sex({"both_sexes": both, "male": male})
    assert {(r.sex, r.pos) for r in hits.collect()} == {("both_sexes", 1), ("both_sexes", 4), ("both_sexes", 5), ("male", 5)}
    assert tuple(results.hit_summary(hits).collect()[0]) == (2, 2)
    assert hits.columns[:4] == ["chrom", "pos", "ref", "alt"]


def test_top_hits_ties_and_missing(spark):
    table = sumstats(spark, [(1, "b", .1, 3.0, False), (1, "a", .2, -3.0, False), (1, "c", .3, 9.0, True), (2, "a", None, 2.0, False), (3, "a", .1, None, False)])
    slim = table.select("contig", "pos", "phenotype", "pval", "tstat", "low_confidence_variant")
    top = results.top_by_sex({"both_sexes": slim}, ["contig", "pos"])
    assert [(r.pos, r.phenotype) for r in top.collect()] == [(1, "a")]
    rows = slim.select("contig", "pos").distinct()
    best = {r.pos: r.phenotype for r in results.top_hit(slim, ["contig", "pos"], F.col("pval"), rows).collect()}
    assert best == {1: "b", 2: None, 3: "a"}


def test_union_tables_unifies_types(spark):
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(1.5, "s")], "x double, z string")
    c = spark.createDataFrame([(2**40,)], "y long")
    u = results.union_tables([a, b, c, a])
    assert dict(u.dtypes) == {"x": "double", "y": "bigint", "z": "string"} and u.count() == 4
    with pytest.raises(ValueError):
        results.union_tables([a, spark.createDataFrame([(True,)], "x boolean")])


def test_load_variant_results_dedup_and_sentinels(spark):
    scan = spark.createDataFrame(
        [("chr1:100_A/G", 1, .1, 10, .5, .1, 1.0, .2), ("chr1:100_A/G", 1, .1, 10, .5, .1, 1.0, .2), ("chr1:200_A/G", 1, .1, 10, .5, .1, 1.0, None)],
        "markerID string, AC int, AF double, N int, BETA double, SE double, Tstat double, `p.value` double",
    )
    annotation = spark.createDataFrame([("chr1", 100, ["A", "G"], "g", "pLoF")], "contig string, pos int, alleles array<string>, gene string, annotation string")
    key = dict(zip(PHENO_KEY, ("icd10", "E11", "both_sexes", "", "")))
    meta = {"n_cases": -1, "n_controls": 5, "heritability": -1.0, "saige_version": "NA", "inv_normalized": "True"}
    got = {r.pos: r for r in results.load_variant_results(scan, key, meta, annotation).collect()}
    assert set(got) == {100, 200} and got[100].annotation == "pLoF" and got[200].gene is None and got[200].Pvalue is None
    assert got[100].n_cases is None and got[100].n_controls == 5 and got[100].heritability is None and got[100].saige_version is None
    assert "N" not in got[100].asDict() and "Tstat" not in got[100].asDict()
    assert results.already_annotated(results.load_variant_results(scan, key, meta, annotation)).count() == 1


def test_key_recoding_round_trip(spark):
    rows = [("icd10", "E11", "both_sexes", "", ""), ("phecode", "401", "females", "", ""), ("categorical", "20004", "both_sexes", "1095", ""),
            ("continuous", "50", "both_sexes", "", "irnt"), ("continuous", "whr", "both_sexes", "", "irnt"), ("biomarkers", "30600", "both_sexes", "", "")]
    df = spark.createDataFrame(rows, ", ".join(f"{k} string" for k in PHENO_KEY))
    legacy = {tuple(r) for r in keys.to_legacy_keys(df).select("trait_type", "phenocode", "coding").collect()}
    assert ("icd_all", "E11", "icd10") in legacy and ("biomarkers", "30600", "30600") in legacy and ("continuous", "whr", "whr") in legacy
    back = {tuple(r) for r in keys.from_legacy_keys(keys.to_legacy_keys(df)).select(*PHENO_KEY).collect()}
    assert back == set(rows)


def test_costs_and_missing_attributes(spark):
    df = spark.createDataFrame(
        [("a", "Success", "$0.12346", {"name": "a", "t": "x"}), ("a", "Failed", "$1", {"name": "a"}), ("b", "Success", "2", {"name": "b", "t": "x"})],
        "name string, state string, cost string, attributes map<string,string>",
    )
    assert {(r.t, r.cost) for r in jobs.cost_by_attributes(df, ["t"]).collect()} == {("x", 2.1235), ("", 1.0)}
    assert {r.t: r.cost for r in jobs.cost_by_attributes(df, ["t"], name="a").collect()}[""] == 1.0
    assert {(r.t, r.state): r.n_jobs for r in jobs.states_by_attributes(df, ["t"]).collect()} == {("x", "Success"): 2, ("", "Failed"): 1}
