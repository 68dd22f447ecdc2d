"""Queries over association results, logs and jobs."""

from __future__ import annotations

import re

import math

from pyspark.sql import functions as F

from phenoloom.functions import normal
from phenoloom.model import PHENO_KEY, pheno_key
from phenoloom.operators import jobs, logs, results
from phenoloom.plans.registry import query
from phenoloom.plans.views import Tables, with_views

VARIANT = ["contig", "pos", "alleles"]


def by_sex(t: Tables) -> dict:
    return {s: t.sumstats.filter(F.col("sex") == s).drop("sex") for s in ("both_sexes", "female", "male")}


def annotated(t: Tables) -> dict:
    extra = {"rsid": F.lit("rs1"), "consequence": F.lit("missense"), "info": F.lit(0.9)}
    return {s: df.withColumns(extra) for s, df in by_sex(t).items()}


@query(
    "P19_significant_entries",
    with_views(
        """SELECT contig AS chrom, pos, 'A' AS ref, 'G' AS alt, sex, "AF" AS af, phenotype, pval, tstat, order_id FROM sumstats
        WHERE pval <= 0.05::DOUBLE AND NOT low_confidence_variant""",
        "sumstats",
    ),
)
def p19(t):
    flat = results.significant_by_sex(annotated(t), threshold=0.05)
    return flat.select("chrom", "pos", "ref", "alt", "sex", F.col("AF").alias("af"), "phenotype", "pval", "tstat", "order_id")


@query(
    "A13_top_p_per_variant",
    with_views(
        """, best AS (SELECT *, row_number() OVER (PARTITION BY contig, pos ORDER BY pval, phenotype, sex, tstat, "AF") AS k
            FROM sumstats WHERE pval < 0.01::DOUBLE)
        SELECT v.contig, v.pos, phenotype, sex, pval FROM (SELECT DISTINCT contig, pos FROM sumstats) v
        LEFT JOIN (SELECT * FROM best WHERE k = 1) b USING (contig, pos)""",
        "sumstats",
    ),
)
def a13(t):
    entries = t.sumstats.select(*VARIANT, "pval", "phenotype", "sex", "tstat", "AF")
    score = F.when(F.col("pval") < 0.01, F.col("pval"))
    rows = entries.select(*VARIANT).distinct()
    return results.top_hit(entries, VARIANT, score, rows).select("contig", "pos", "phenotype", "sex", "pval")


_TOP = """, best AS (SELECT *, row_number() OVER (PARTITION BY contig, pos, sex
        ORDER BY -abs(tstat), phenotype, pval, tstat) AS k FROM sumstats WHERE NOT low_confidence_variant)"""


def _top(t: Tables):
    slim = {s: df.select(*VARIANT, "phenotype", "pval", "tstat", "low_confidence_variant") for s, df in by_sex(t).items()}
    return results.top_by_sex(slim, VARIANT)


@query(
    "A14_top_per_variant_and_sex",
    with_views(_TOP + " SELECT contig, pos, sex, phenotype, pval, tstat FROM best WHERE k = 1", "sumstats"),
)
def a14(t):
    return _top(t).select("contig", "pos", "sex", "phenotype", "pval", "tstat")


@query(
    "A14_top_summary",
    with_views(
        _TOP + """ SELECT count(*) FILTER (WHERE pval < 0.05::DOUBLE AND sex = 'both_sexes') AS n_significant,
        count(*) // 3 AS n_variants FROM best WHERE k = 1""",
        "sumstats",
    ),
)
def a14_summary(t):
    return results.top_summary(_top(t), threshold=0.05)


def hits(t: Tables):
    return results.significant_by_sex(annotated(t), threshold=0.05)


_HITS = ", hits AS (SELECT * FROM sumstats WHERE pval <= 0.05::DOUBLE AND NOT low_confidence_variant)"


@query(
    "A15_significance_summary",
    with_views(
        _HITS + """ SELECT count(*) AS total_associations, count(DISTINCT phenotype) AS unique_phenos FROM hits
        WHERE pval < 0.01::DOUBLE""",
        "sumstats",
    ),
)
def a15(t):
    return results.hit_summary(hits(t), threshold=0.01)


@query(
    "A15_hits_per_phenotype",
    with_views(_HITS + " SELECT phenotype, count(*) AS n_sig FROM hits WHERE pval < 0.01::DOUBLE GROUP BY 1", "sumstats"),
)
def a15_hits(t):
    return results.hits_per_phenotype(hits(t), threshold=0.01)


@query(
    "T1_top_phenotypes",
    with_views(
        _HITS + """ SELECT phenotype, count(*) AS n_sig FROM hits WHERE pval < 0.01::DOUBLE GROUP BY 1
        ORDER BY n_sig DESC, phenotype LIMIT 3""",
        "sumstats",
    ),
)
def t1(t):
    return results.hits_per_phenotype(hits(t), threshold=0.01).limit(3)


def _poly(x: str, coefficients: list[float]) -> str:
    text = f"{coefficients[-1]!r}::DOUBLE"
    for c in reversed(coefficients[:-1]):
        text = f"({text} * {x} + {c!r}::DOUBLE)"
    return text


def _ratio(x: str, top: list[float], bottom: list[float]) -> str:
    return f"{_poly(x, top)} / {_poly(x, bottom)}"


def _chi2_sql(p: str) -> str:
    """SQL text of the squared normal quantile at ``p / 2`` for p <= 1."""
    h = f"({p} / 2)"
    q, r = f"({h} - 0.5::DOUBLE)", f"sqrt(-ln({h}))"
    near = f"({q} * {_ratio(f'(0.180625::DOUBLE - {q} * {q})', normal.CENTRAL_NUM, normal.CENTRAL_DEN)})"
    middle = f"({_ratio(f'({r} - 1.6::DOUBLE)', normal.MIDDLE_NUM, normal.MIDDLE_DEN)})"
    far = f"({_ratio(f'({r} - 5::DOUBLE)', normal.TAIL_NUM, normal.TAIL_DEN)})"
    return f"power(CASE WHEN abs({q}) <= 0.425::DOUBLE THEN {near} WHEN {r} <= 5 THEN {middle} ELSE {far} END, 2)"


def _lambda_sql(key: str, source: str, measure: str, cutoffs, threshold: float, names: tuple[str, str, str, str]) -> str:
    values = ", ".join(f"({float(c)!r}::DOUBLE)" for c in cutoffs)
    cutoff, lam, n, sig = names
    return f""", reached AS (SELECT {key}, c AS cutoff, p FROM {source}, (VALUES {values}) cutoffs(c) WHERE {measure} >= c),
    sorted AS (SELECT {key}, cutoff, count(*) AS n, count(*) FILTER (WHERE p < {threshold!r}::DOUBLE) AS sig,
        list_sort(list(p) FILTER (WHERE p IS NOT NULL)) AS ps FROM reached GROUP BY {key}, cutoff),
    middles AS (SELECT *, ps[(len(ps) + 1) // 2] AS lo, ps[len(ps) // 2 + 1] AS hi FROM sorted)
, every_cutoff AS (SELECT DISTINCT {key}, c::DOUBLE AS cutoff FROM {source}, (VALUES {values}) cutoffs(c))
    SELECT {key}, cutoff AS {cutoff}, round(({_chi2_sql('lo')} + {_chi2_sql('hi')}) / 2 / {normal.MEDIAN_CHI2!r}::DOUBLE, 6) AS {lam},
        coalesce(n, 0) AS {n}, coalesce(sig, 0) AS {sig} FROM every_cutoff LEFT JOIN middles USING ({key}, cutoff)"""


_AF_CUTOFFS = [0, 0.01, 0.02, 0.05, 0.08, 0.1]


@query(
    "A16_lambda_by_cutoff",
    with_views(
        _lambda_sql("phenotype", "stats", "af", _AF_CUTOFFS, 0.01, ("cutoff", "lambda_gc", "n_variants", "n_sig")),
        "sumstats",
        extra="""stats AS (SELECT phenotype, "AF" AS af, CASE WHEN order_id % 13 > 0 THEN pval END AS p FROM sumstats)""",
    ),
)
def a16(t):
    stats = t.sumstats.withColumn("p", F.when(F.col("order_id") % 13 > 0, F.col("pval")))
    table = results.lambda_by_cutoff(stats, ["phenotype"], "p", "AF", _AF_CUTOFFS, threshold=0.01)
    return table.withColumn("lambda_gc", F.round("lambda_gc", 6))


def _lambda_inputs(t: Tables):
    entries = t.sumstats.select(
        *pheno_key("icd10", F.col("phenotype"), F.col("sex")),
        F.log("pval").alias("Pvalue"),
        (F.col("AF") / 10).alias("AF.Cases"),
        (F.col("quantity") / 100).alias("AF_Allele2"),
    )
    cols = entries.select(*PHENO_KEY).distinct().withColumns(
        {"n_cases": F.when(F.col("pheno_sex") == "male", 100).otherwise(500), "log_pvalue": F.lit(True)}
    )
    return entries, cols


_LAMBDA_STATS = """stats AS (SELECT phenotype AS phenocode, sex AS pheno_sex, exp(ln(pval)) AS p,
    "AF" / 10 * CASE WHEN sex = 'male' THEN 100 ELSE 500 END * 2 AS ac, quantity / 100 AS af FROM sumstats)"""


@query(
    "A17_lambda_by_case_count",
    with_views(
        _lambda_sql("phenocode, pheno_sex", "stats", "ac", results.AC_CUTOFFS, results.SIGNIFICANT,
                    ("ac", "lambda_gc_by_case_ac", "n_variants_by_case_ac", "n_sig_by_case_ac")),
        "sumstats", extra=_LAMBDA_STATS,
    ),
)
def a17(t):
    table = results.lambda_by_frequency(*_lambda_inputs(t), by="ac")
    return table.drop("trait_type", "coding", "modifier").withColumn(
        "lambda_gc_by_case_ac", F.round("lambda_gc_by_case_ac", 6)
    )


@query(
    "M4_lambda_by_frequency_exploded",
    with_views(
        _lambda_sql("phenocode, pheno_sex", "stats", "af", results.AF_CUTOFFS, results.SIGNIFICANT,
                    ("af", "lambda_gc_by_af", "n_variants_by_af", "n_sig_by_af")),
        "sumstats", extra=_LAMBDA_STATS,
    ),
)
def m4(t):
    table = results.lambda_by_frequency(*_lambda_inputs(t), by="af")
    packed = results.pack_by_cutoff(table, PHENO_KEY, "af")
    long = results.explode_by_cutoff(packed, PHENO_KEY, "af")
    return long.drop("trait_type", "coding", "modifier").withColumn("lambda_gc_by_af", F.round("lambda_gc_by_af", 6))


def _both_lambda_sql() -> str:
    heads, selects = "", []
    for by, cutoffs in (("ac", results.AC_CUTOFFS), ("af", results.AF_CUTOFFS)):
        single = _lambda_sql("phenocode, pheno_sex", "stats", by, cutoffs, results.SIGNIFICANT, ("cutoff", "lambda_gc", "n_variants", "n_sig"))
        for name in ("reached", "sorted", "middles", "every_cutoff"):
            single = re.sub(rf"\b{name}\b", f"{name}_{by}", single)
        head, select = single.rsplit("\n    SELECT ", 1)
        heads += head
        selects.append(f"SELECT '{by}' AS measure, {select}")
    return heads + "\n" + " UNION ALL ".join(selects)


@query("A17_M4_lambda_by_both", with_views(_both_lambda_sql(), "sumstats", extra=_LAMBDA_STATS))
def lambda_both(t):
    """Case counts and frequencies by the same two passes."""
    table = results.lambda_by_frequencies(*_lambda_inputs(t))
    return table.drop("trait_type", "coding", "modifier").withColumn("lambda_gc", F.round("lambda_gc", 6))


def variant_scan(t: Tables, imputed: bool):
    """Single-variant test output of many phenotypes, both shapes."""
    ident = F.concat(
        F.lit("chr"), (F.col("l_partkey") % 22 + 1).cast("string"), F.lit(":"), F.col("l_partkey").cast("string"), F.lit("_A/G")
    )
    key = pheno_key("icd10", F.concat("l_returnflag", "l_linestatus"))
    p = (F.col("l_orderkey") % 1000 + 1) / F.lit(1000.0)
    stats = [
        F.col("l_quantity").alias("BETA"), F.col("l_discount").alias("SE"), F.col("l_tax").alias("Tstat"), p.alias("p.value"),
    ]
    if imputed:
        return t.lineitem.select(
            F.lit("chr1").alias("CHR"), F.lit(1).alias("POS"), ident.alias("SNPID"), F.lit("A").alias("Allele1"),
            F.lit("G").alias("Allele2"), F.col("l_quantity").alias("AC_Allele2"), F.col("l_discount").alias("AF_Allele2"),
            F.lit(0.9).alias("imputationInfo"), F.lit(100).alias("N"), *stats, *key,
        )
    return t.lineitem.select(
        ident.alias("markerID"), F.col("l_linenumber").alias("AC"), F.col("l_discount").alias("AF"), F.lit(100).alias("N"),
        *stats, F.lit(1.0).alias("varT"), F.lit(2.0).alias("varTstar"), *key,
    )


def phenotype_metadata(t: Tables):
    codes = t.lineitem.select(F.concat("l_returnflag", "l_linestatus").alias("c")).distinct()
    first = F.col("c").startswith("A")
    return codes.select(
        *pheno_key("icd10", F.col("c")),
        F.when(first, -1).otherwise(10).alias("n_cases"), F.lit(20).alias("n_controls"),
        F.when(first, -1.0).otherwise(0.25).alias("heritability"), F.lit("NA").alias("saige_version"),
        F.lit("True").alias("inv_normalized"),
    )


def variant_annotation(t: Tables):
    contig = F.concat(F.lit("chr"), (F.col("p_partkey") % 22 + 1).cast("string"))
    return t.part.filter("p_partkey % 2 = 0").select(
        contig.alias("contig"), F.col("p_partkey").cast("int").alias("pos"), F.array(F.lit("A"), F.lit("G")).alias("alleles"),
        F.col("p_brand").alias("gene"), F.col("p_type").alias("annotation"),
    )


_SINGLE = """, single AS (SELECT 'chr' || (l_partkey % 22 + 1) AS contig, l_partkey::INTEGER AS pos, l_returnflag || l_linestatus AS phenocode,
        l_quantity, l_discount, l_tax, l_linenumber, (l_orderkey % 1000 + 1) / 1000.0::DOUBLE AS p, l_partkey FROM lineitem)"""
_NUMBERED = _SINGLE + """,
    numbered AS (SELECT *, row_number() OVER (PARTITION BY contig, pos, phenocode ORDER BY {order}) AS k FROM single)"""


@query(
    "P14_load_variant_results",
    "WITH dummy AS (SELECT 1)" + _NUMBERED.format(order="l_linenumber, l_discount, l_quantity, l_discount, p") + """
    SELECT contig, pos, phenocode, l_linenumber AS ac, l_quantity AS beta, p AS pvalue,
        CASE WHEN phenocode LIKE 'A%' THEN NULL ELSE 10 END AS n_cases, CASE WHEN phenocode LIKE 'A%' THEN NULL ELSE 0.25::DOUBLE END AS heritability,
        NULL::VARCHAR AS saige_version, p_brand AS gene, p_type AS annotation
    FROM numbered LEFT JOIN part ON p_partkey = l_partkey AND p_partkey % 2 = 0 WHERE k = 1""",
)
def p14(t):
    loaded = results.load_variant_results(variant_scan(t, False), None, phenotype_metadata(t), variant_annotation(t))
    return loaded.select(
        "contig", "pos", "phenocode", F.col("AC").alias("ac"), F.col("BETA").alias("beta"), F.col("Pvalue").alias("pvalue"),
        "n_cases", "heritability", "saige_version", "gene", "annotation",
    )


@query(
    "P11_unify_imputed_results",
    "WITH dummy AS (SELECT 1)" + _NUMBERED.format(order="l_quantity, l_discount, l_quantity, l_discount, p") + """
    SELECT contig, pos, phenocode, l_quantity AS ac_allele2, l_discount AS af_allele2, NULL::DOUBLE AS af_cases, p AS pvalue,
        '' AS gene, '' AS annotation, CASE WHEN phenocode LIKE 'A%' THEN 7 ELSE 10 END AS n_cases,
        CASE WHEN phenocode LIKE 'A%' THEN 8 ELSE 20 END AS n_controls, false AS log_pvalue FROM numbered WHERE k = 1""",
)
def p11(t):
    nothing = variant_annotation(t).withColumns(
        {"gene": F.lit(None).cast("string"), "annotation": F.lit(None).cast("string")}
    )
    loaded = results.load_variant_results(variant_scan(t, True), None, phenotype_metadata(t), nothing)
    found = phenotype_metadata(t).select(*PHENO_KEY, F.lit(7).alias("n_cases"), F.lit(8).alias("n_controls"))
    unified = results.unify_imputed(loaded.drop("log_pvalue"), patch=found)
    return unified.select(
        "contig", "pos", "phenocode", F.col("AC_Allele2").alias("ac_allele2"), F.col("AF_Allele2").alias("af_allele2"),
        F.col("`AF.Cases`").alias("af_cases"), F.col("Pvalue").alias("pvalue"), "gene", "annotation",
        "n_cases", "n_controls", "log_pvalue",
    )


@query(
    "P12_unify_exome_results",
    """SELECT l_orderkey AS order_id, l_linenumber::INTEGER AS ac, l_quantity AS se, CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE l_tax END AS af_cases,
    CASE WHEN l_partkey % 2 = 0 THEN NULL ELSE 5 END AS n_cases, 'g' AS gene FROM lineitem""",
)
def p12(t):
    base = t.lineitem.select(
        F.lit("chr1").alias("contig"), F.col("l_orderkey").alias("pos"), F.lit("m").alias("markerID"),
        F.col("l_linenumber").cast("double").alias("AC"), F.lit(0.1).alias("AF"), F.lit(0.2).alias("BETA"),
        F.col("l_quantity").cast("string").alias("SE"), F.lit(0.5).alias("Pvalue"), F.lit("g").alias("gene"),
        F.lit("a").alias("annotation"), "l_partkey", "l_tax",
    )
    old = base.filter("l_partkey % 2 = 0").withColumns({"N": F.lit(1), "Tstat": F.lit(1.0), "varT": F.lit(1.0), "varTstar": F.lit(1.0)})
    new = base.filter("l_partkey % 2 = 1").withColumns(
        {"AF.Cases": F.col("l_tax"), "AF.Controls": F.col("l_tax"), "N.Cases": F.lit(5), "N.Controls": F.lit(6)}
    )
    both = results.union_tables([results.unify_exome(old.drop("l_partkey", "l_tax")), results.unify_exome(new.drop("l_partkey", "l_tax"))])
    return both.select(
        F.col("pos").alias("order_id"), F.col("AC").alias("ac"), F.col("SE").alias("se"),
        F.col("`AF.Cases`").alias("af_cases"), F.col("`N.Cases`").alias("n_cases"), "gene",
    )


def gene_scan(t: Tables):
    brand = F.regexp_replace("p_brand", "#", "")
    ident = F.concat_ws("_", F.concat(F.lit("ENSG"), F.col("p_partkey").cast("string")), brand, F.col("p_type"))
    counts = [
        F.when(F.col("p_size") % (i + 1) != 0, (F.col("p_size") + i).cast("int")).alias(f"Nmarker_MACCate_{i}") for i in range(1, 9)
    ]
    return t.part.select(
        F.when(F.col("p_partkey") % 10 == 0, F.concat_ws("_", ident, F.lit("x"))).otherwise(ident).alias("Gene"),
        (F.col("p_size") / F.lit(100.0)).alias("Pvalue"), *counts, F.lit("m").alias("markerIDs"), F.lit("0.1").alias("markerAFs"),
        F.lit(0.1).alias("Pvalue_Burden"), F.lit(0.2).alias("Pvalue_SKAT"), F.lit(0.3).alias("BETA_Burden"),
        F.when(F.col("p_size") % 2 == 0, "text").otherwise(F.col("p_retailprice").cast("string")).alias("SE_Burden"),
    )


def gene_intervals(t: Tables):
    return t.genes.select(
        F.concat(F.lit("ENSG"), F.expr("start div 100").cast("string")).alias("gene_id"),
        F.struct("contig", "start", "end").alias("interval"),
    )


_MARKERS = " + ".join(f"CASE WHEN p_size % {i + 1} <> 0 THEN p_size + {i} ELSE 0 END" for i in range(1, 9))


@query(
    "P15_load_gene_results",
    f"""SELECT 'ENSG' || p_partkey AS gene_id, replace(p_brand, '#', '') AS gene_symbol, p_type AS annotation, ({_MARKERS})::INTEGER AS total_variants,
    p_partkey * 100 AS start, p_size / 100.0::DOUBLE AS pvalue, NULL::INTEGER AS n_cases, 12 AS n_controls FROM part WHERE p_partkey % 10 > 0""",
)
def p15(t):
    key = dict.fromkeys(PHENO_KEY, "k")
    loaded = results.load_gene_results(gene_scan(t), key, {"n_cases": -1, "n_controls": 12}, gene_intervals(t))
    return loaded.select(
        "gene_id", "gene_symbol", "annotation", "total_variants", F.col("interval.start").alias("start"),
        F.col("Pvalue").alias("pvalue"), "n_cases", "n_controls",
    )


@query(
    "P13_unify_gene_results",
    f"""SELECT 'ENSG' || p_partkey AS gene_id, CASE WHEN p_size % 2 = 0 THEN NULL ELSE p_retailprice END AS se_burden,
    NULL::DOUBLE AS se_burden_na, ({_MARKERS})::INTEGER AS total_variants FROM part WHERE p_partkey % 10 > 0""",
)
def p13(t):
    key = dict.fromkeys(PHENO_KEY, "k")
    loaded = results.load_gene_results(gene_scan(t), key, {"n_cases": -1, "n_controls": 12}, gene_intervals(t))
    return results.unify_burden(loaded).select(
        "gene_id", F.col("SE_Burden").alias("se_burden"), F.col("`SE_Burden.NA`").alias("se_burden_na"), "total_variants"
    )


@query(
    "U1_union_with_unified_schema",
    """SELECT l_orderkey AS order_id, l_quantity::DOUBLE AS value, CASE WHEN l_returnflag = 'A' THEN NULL ELSE l_linestatus END AS status
    FROM lineitem""",
)
def u1(t):
    def part(flag):
        return t.lineitem.filter(F.col("l_returnflag") == flag)

    order = F.col("l_orderkey").alias("order_id")
    tables = [
        part("A").select(order, F.col("l_quantity").cast("int").alias("value")),
        part("N").select(order, F.col("l_quantity").alias("value"), F.col("l_linestatus").alias("status")),
        part("R").select(order, F.col("l_quantity").cast("long").alias("value"), F.col("l_linestatus").alias("status")),
    ]
    return results.union_tables(tables)


@query(
    "J8_results_matrix",
    """SELECT l_partkey AS pos, phenocode, n_cases, count(*) AS n, max(l_quantity) AS top FROM (
        SELECT *, l_returnflag || l_linestatus AS phenocode, ascii(l_returnflag)::INTEGER AS n_cases FROM lineitem) GROUP BY 1, 2, 3""",
)
def j8(t):
    stats = t.lineitem.select(
        F.col("l_partkey").alias("pos"), F.concat("l_returnflag", "l_linestatus").alias("phenocode"),
        F.ascii("l_returnflag").alias("n_cases"), F.col("l_quantity"),
    ).groupBy("pos", "phenocode", "n_cases").agg(F.count("*").alias("n"), F.max("l_quantity").alias("top"))
    tables = [stats.filter(F.col("phenocode").startswith(f)) for f in "ANR"]
    matrix = results.results_matrix(tables, ["pos"], ["phenocode"], ["n_cases"])
    return matrix.entries.join(matrix.cols, "phenocode")


@query(
    "J9_union_with_phenotypes",
    """SELECT o_orderkey AS order_id, o_custkey AS cust_id, c_mktsegment AS segment FROM orders LEFT JOIN customer ON o_custkey = c_custkey""",
)
def j9(t):
    orders = t.orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("cust_id"), "o_orderstatus")
    tables = [orders.filter(F.col("o_orderstatus") == s).drop("o_orderstatus") for s in "OFP"]
    people = t.customer.select(F.col("c_custkey").alias("cust_id"), F.col("c_mktsegment").alias("segment"))
    return results.union_with_phenotypes(tables, people, ["cust_id"])


@query(
    "J9_unknown_phenotypes",
    """SELECT DISTINCT o_custkey AS cust_id FROM orders WHERE o_custkey NOT IN (
        SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')""",
)
def j9_unknown(t):
    orders = t.orders.select(F.col("o_custkey").alias("cust_id"))
    known = t.customer.filter("c_mktsegment != 'BUILDING'").select(F.col("c_custkey").alias("cust_id"))
    return results.unknown_phenotypes(orders, known, ["cust_id"])


@query(
    "L1_cases_from_logs",
    with_views(
        """, scanned AS (SELECT *, min(chrom) OVER (PARTITION BY pheno) AS first FROM log_facts WHERE chrom BETWEEN 10 AND 22),
        file1 AS (SELECT * FROM scanned WHERE chrom = first),
        picked AS (SELECT pheno, min_by(n, k) FILTER (WHERE k % 3 = 0) AS a, min(k) FILTER (WHERE k % 3 = 0) AS c, max(n) AS used
            FROM file1 GROUP BY 1)
        SELECT pheno, coalesce(a, used)::INTEGER AS n_cases, coalesce(c, -1)::INTEGER AS n_controls FROM picked""",
        "log_facts",
    ),
)
def l1(t):
    # Orders of one customer on one chromosome form one log: order its lines by order.
    order = F.regexp_extract("file", r"_(\d+)\.variant\.log$", 1).cast("long")
    lines = t.log_lines.withColumn("block", order * 10 + F.col("block"))
    return logs.case_counts_from_logs(lines, ["pheno"])


@query(
    "L2_heritability_from_logs",
    with_views(
        f"""SELECT file, CASE WHEN pheno % 2 = 0 THEN CASE WHEN k % 5 = 0 THEN 0.5::DOUBLE / (2.5::DOUBLE + 0.5::DOUBLE) ELSE price / (1.5::DOUBLE + price) END
        ELSE CASE WHEN k % 5 = 0 THEN 0.5::DOUBLE / (0.5::DOUBLE + {math.pi**2 / 3!r}::DOUBLE) ELSE price / (price + {math.pi**2 / 3!r}::DOUBLE) END END AS heritability
        FROM log_facts""",
        "log_facts",
    ),
)
def l2(t):
    return logs.heritability_from_logs(t.log_lines, F.col("pheno") % 2 == 0)


@query(
    "L3_version_from_logs",
    with_views("SELECT file, 'SAIGE_0.' || (k % 50) AS saige_version FROM log_facts", "log_facts"),
)
def l3(t):
    return logs.version_from_logs(t.log_lines)


@query(
    "L4_normalization_from_logs",
    with_views("SELECT file, CASE WHEN k % 2 = 0 THEN 'True' ELSE 'False' END AS inv_normalized FROM log_facts", "log_facts"),
)
def l4(t):
    return logs.normalization_from_logs(t.log_lines)


@query(
    "L5_test_timing_from_logs",
    with_views(
        """SELECT 'chr' || chrom || ':' || lpad(k::VARCHAR, 9, '0') AS locus, price AS seconds FROM log_facts WHERE k % 4 > 0""",
        "log_facts",
    ),
)
def l5(t):
    return logs.timing_from_logs(t.log_lines)


@query(
    "L6_model_timing_from_logs",
    with_views("SELECT file, n::VARCHAR AS cpu, k::VARCHAR AS wall FROM log_facts", "log_facts"),
)
def l6(t):
    return logs.model_timing_from_logs(t.log_lines)


@query(
    "L7_problem_files",
    with_views("SELECT count(*) FILTER (WHERE k % 6 < 2) AS n_files FROM log_facts", "log_facts"),
)
def l7(t):
    return logs.count_problem_files(t.log_lines)


def job_table(t: Tables):
    attributes = F.map_from_arrays(
        F.array(F.lit("name"), F.lit("priority")),
        F.array(F.when(F.col("o_custkey") % 2 == 0, "run").otherwise("export"), F.col("o_orderpriority")),
    )
    return t.orders.select(
        F.when(F.col("o_custkey") % 2 == 0, "run").otherwise("export").alias("name"),
        F.col("o_orderstatus").alias("state"),
        F.concat(F.lit("$"), F.col("o_totalprice").cast("string")).alias("cost"),
        attributes.alias("attributes"),
    )


@query(
    "A20_cost_by_attributes",
    """SELECT o_orderpriority AS priority, '' AS pheno, round(sum(o_totalprice), 2) AS cost FROM orders WHERE o_custkey % 2 = 0 GROUP BY 1""",
)
def a20(t):
    costs = jobs.cost_by_attributes(job_table(t), ["priority", "pheno"], name="run")
    return costs.withColumn("cost", F.round("cost", 2))


@query(
    "A20_states_by_attributes",
    """SELECT o_orderpriority AS priority, o_orderstatus AS state, count(*) AS n_jobs FROM orders GROUP BY 1, 2""",
)
def a20_states(t):
    return jobs.states_by_attributes(job_table(t), ["priority"])


@query(
    "A21_jobs_by_name",
    "SELECT CASE WHEN o_custkey % 2 = 0 THEN 'run' ELSE 'export' END AS name, count(*) AS n_jobs FROM orders GROUP BY 1",
)
def a21(t):
    return jobs.jobs_by_name(job_table(t))
