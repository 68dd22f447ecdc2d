"""Queries over phenotype operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.functions.dates import epoch_seconds, first_occurrence_seconds
from phenoloom.functions.keys import (
    from_legacy_keys,
    joined_key,
    model_family,
    path_safe,
    pheno_output_path,
    results_prefix,
    to_legacy_keys,
)
from phenoloom.model import PHENO_KEY, SEXES, MatrixFrame, pheno_key
from phenoloom.operators import codings, combine, defaults, export, icd, munging, pairwise, registry, reshape
from phenoloom.plans.registry import query
from phenoloom.plans.views import Tables, with_views
from phenoloom.scale import dealt, lookup, one_per_key
from phenoloom.session import stage

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


def wide_orders(t: Tables):
    """One row per customer: a double, an int and a boolean column per priority."""
    columns = []
    for i, p in enumerate(PRIORITIES):
        here = F.col("o_orderpriority") == p
        columns += [
            F.max(F.when(here, F.col("o_totalprice"))).alias(f"5{i}_irnt"),
            F.count_if(here).cast("int").alias(f"6{i}"),
            F.bool_or(F.when(here, F.col("o_orderstatus") == "F")).alias(f"2000{i}_10{i}_x"),
        ]
    return t.orders.groupBy(F.col("o_custkey").alias("userId")).agg(*columns, F.min("o_orderstatus").alias("text"))


_WIDE_SQL = "wide AS (SELECT o_custkey AS user_id, " + ", ".join(
    f"""max(o_totalprice) FILTER (WHERE o_orderpriority = '{p}') AS v{i},
    count(*) FILTER (WHERE o_orderpriority = '{p}') AS n{i},
    bool_or(o_orderstatus = 'F') FILTER (WHERE o_orderpriority = '{p}') AS b{i}"""
    for i, p in enumerate(PRIORITIES)
) + " FROM orders GROUP BY 1)"


@query(
    "P1_wide_to_long_continuous",
    with_views(
        " UNION ALL ".join(
            f"""SELECT user_id, 'continuous' AS trait_type, '5{i}' AS phenocode, 'both_sexes' AS pheno_sex, '' AS coding,
                'irnt' AS modifier, v{i} AS value FROM wide UNION ALL
                SELECT user_id, 'continuous', '6{i}', 'both_sexes', '', '', n{i}::DOUBLE FROM wide"""
            for i in range(5)
        ),
        extra=_WIDE_SQL,
    ),
)
def p1_continuous(t):
    return reshape.wide_to_matrix(wide_orders(t), "continuous").entries.withColumnRenamed("userId", "user_id")


@query(
    "P1_wide_to_long_categorical",
    with_views(
        " UNION ALL ".join(
            f"""SELECT user_id, 'categorical' AS trait_type, '2000{i}' AS phenocode, 'both_sexes' AS pheno_sex,
                '10{i}_x' AS coding, '' AS modifier, b{i} AS value FROM wide"""
            for i in range(5)
        ),
        extra=_WIDE_SQL,
    ),
)
def p1_categorical(t):
    return reshape.wide_to_matrix(wide_orders(t), "categorical").entries.withColumnRenamed("userId", "user_id")


@query(
    "P2_select_fields_with_dictionary",
    """WITH dict AS (SELECT n_nationkey::VARCHAR AS "FieldID", n_name AS "Field" FROM nation),
    wide AS (SELECT s_suppkey AS eid, s_nationkey AS a, s_acctbal AS b FROM supplier)
    SELECT eid, phenocode, value, "Field" AS field FROM (
        SELECT eid, '3' AS phenocode, a::DOUBLE AS value FROM wide UNION ALL SELECT eid, '99', b FROM wide) long
    LEFT JOIN dict ON phenocode = "FieldID" """,
)
def p2(t):
    wide = t.supplier.select(
        F.col("s_suppkey").alias("eid"), F.col("s_nationkey").alias("3-0.0"), F.col("s_acctbal").alias("99-0.0"), "s_name"
    )
    dictionary = t.nation.select(F.col("n_nationkey").cast("string").alias("FieldID"), F.col("n_name").alias("Field"))
    frame = reshape.select_fields(wide, ["eid"], lambda name, kind: name.endswith("-0.0"), dictionary=dictionary)
    return frame.entries.join(frame.cols, "phenocode").select("eid", "phenocode", "value", F.col("Field").alias("field"))


@query(
    "P4_hoist_constant_fields",
    """SELECT l_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS price, count(*) AS n_entries,
    sum(l_quantity) AS quantity FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2, 3""",
)
def p4(t):
    # Rows, hoisted fields and totals each join the tables, all in the same tasks.
    lines, orders = dealt(t.lineitem, ["l_orderkey"]), dealt(t.orders, ["o_orderkey"])
    entries = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("part_id"),
        F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"), "l_quantity",
    )
    frame = MatrixFrame(
        entries.select("order_id").distinct(), entries.select("part_id").distinct(), entries, ["order_id"], ["part_id"]
    )
    hoisted = reshape.hoist_fields(frame, ["status", "price"])
    totals = hoisted.entries.groupBy("order_id").agg(F.count("*").alias("n_entries"), F.sum("l_quantity").alias("quantity"))
    return hoisted.rows.join(totals, "order_id")


@query(
    "P5_values_by_sex",
    with_views(
        """SELECT user_id, pheno, value AS both_sexes, CASE WHEN sex = 0 THEN value END AS females,
        CASE WHEN sex = 1 THEN value END AS males FROM measures LEFT JOIN samples ON user_id = "userId" """,
        "measures", "samples",
    ),
)
def p5(t):
    joined = lookup(t.measures, t.samples.withColumnRenamed("userId", "user_id"), ["user_id"])
    return joined.select("user_id", "pheno", *reshape.sex_values(F.col("value"), F.col("sex")))


@query(
    "P6_joined_keys",
    with_views(
        """SELECT order_id, trait_type || '-' || phenocode || '-' || pheno_sex || '-' || coding || '-' || modifier AS plain,
        trait_type || '-' || replace(phenocode, '/', '_') || '-' || pheno_sex || '-' || coding || '-' || modifier AS safe,
        replace(phenocode, '/', '_') AS directory FROM pheno_keys""",
        "pheno_keys",
    ),
)
def p6(t):
    k = t.pheno_keys
    return k.select(
        "order_id", joined_key(k).alias("plain"), joined_key(k, True).alias("safe"),
        path_safe(F.col("phenocode")).alias("directory"),
    )


@query(
    "P7_result_paths",
    with_views(
        """SELECT order_id,
        'out/result_' || trait_type || '-' || replace(phenocode, '/', '_') || '-' || pheno_sex || '-' || coding || '-' ||
            modifier || '_chr1_' || lpad(order_id::VARCHAR, 9, '0') AS prefix,
        'out/result_' || replace(phenocode, '/', '_') || '_chr1_' || lpad(order_id::VARCHAR, 9, '0') AS legacy_prefix,
        'out/' || trait_type || '-' || replace(phenocode, '/', '_') || '-' || pheno_sex || '-' || coding || '-' ||
            modifier || '.tsv' AS output,
        'out/' || trait_type || '-' || replace(phenocode, '/', '_') || '-' || coding || '.tsv' AS legacy_output
        FROM pheno_keys""",
        "pheno_keys",
    ),
)
def p7(t):
    k, out, chrom = t.pheno_keys, F.lit("out"), F.lit("chr1")
    return k.select(
        "order_id",
        results_prefix(k, out, chrom, F.col("order_id")).alias("prefix"),
        results_prefix(k, out, chrom, F.col("order_id"), legacy=True).alias("legacy_prefix"),
        pheno_output_path(out).alias("output"),
        pheno_output_path(out, legacy=True).alias("legacy_output"),
    )


@query(
    "P8_keys_to_legacy",
    with_views(
        """SELECT order_id, CASE WHEN trait_type = 'icd10' THEN 'icd_all' ELSE trait_type END AS trait_type, phenocode,
        CASE WHEN trait_type = 'icd10' THEN 'icd10' WHEN trait_type = 'phecode' THEN pheno_sex
             WHEN trait_type = 'biomarkers' THEN phenocode WHEN phenocode = 'whr' THEN 'whr'
             WHEN coding <> '' THEN coding ELSE modifier END AS coding FROM pheno_keys""",
        "pheno_keys",
    ),
)
def p8(t):
    return to_legacy_keys(t.pheno_keys)


@query(
    "P9_keys_from_legacy",
    with_views(
        """SELECT order_id, trait_type, phenocode, CASE WHEN trait_type = 'phecode' THEN pheno_sex ELSE 'both_sexes' END AS pheno_sex,
        CASE WHEN trait_type <> 'categorical' THEN '' WHEN phenocode = 'whr' THEN 'whr' ELSE coding END AS coding,
        CASE WHEN trait_type = 'continuous' THEN 'irnt' ELSE '' END AS modifier FROM pheno_keys""",
        "pheno_keys",
    ),
)
def p9(t):
    return from_legacy_keys(to_legacy_keys(t.pheno_keys))


@query(
    "P10_export_values",
    with_views(
        """, counts AS (SELECT pheno, count(*) FILTER (WHERE sex = 0) AS f, count(*) FILTER (WHERE sex = 1) AS m
            FROM sexed GROUP BY 1),
        asks AS (SELECT pheno, asked FROM (SELECT DISTINCT pheno FROM sexed), (VALUES ('females'), ('both_sexes')) a(asked))
        SELECT user_id, s.pheno AS phenocode, asked, CASE WHEN asked = 'both_sexes' OR sex = 0 THEN 1.0::DOUBLE END AS value
        FROM sexed s JOIN counts USING (pheno) JOIN asks USING (pheno)
        WHERE CASE WHEN f + m > 0 AND f / (f + m) <= 0.48::DOUBLE THEN sex = 1
                   WHEN f + m > 0 AND f / (f + m) >= 1 - 0.48::DOUBLE THEN sex = 0 ELSE true END""",
        "cases", "samples",
        extra="""sexed AS (SELECT user_id, pheno, sex FROM cases LEFT JOIN samples ON user_id = "userId")""",
    ),
)
def p10(t):
    frame = case_matrix(t)
    asks = frame.cols.select(
        *[k for k in PHENO_KEY if k != "pheno_sex"],
        F.explode(F.array(F.lit("females"), F.lit("both_sexes"))).alias("pheno_sex"),
    )
    values = export.export_values(frame, asks, proportion_single_sex=0.48)
    return values.select(F.col("userId").alias("user_id"), "phenocode", "asked", "value")


def case_source(t: Tables) -> MatrixFrame:
    """The case cells as a phecode-like source."""
    entries = t.cases.select(
        F.col("user_id").alias("userId"), F.col("pheno").alias("phecode"), F.lit("both_sexes").alias("phecode_sex"),
        F.lit(True).alias("case_control"),
    )
    cols = entries.select("phecode", "phecode_sex").distinct().withColumns(
        {"phecode_description": F.concat(F.lit("about "), F.col("phecode")), "phecode_group": F.lit("orders")}
    )
    return MatrixFrame(t.samples.select("userId"), cols, entries, ["userId"], ["phecode", "phecode_sex"])


def case_matrix(t: Tables) -> MatrixFrame:
    return combine.combine_sources({"phecode": case_source(t)}, t.samples)


@query(
    "A1_case_counts_by_sex",
    with_views(
        """SELECT pheno, count(*) FILTER (WHERE value AND sex IS NOT NULL) AS n_cases_defined,
        count(*) FILTER (WHERE value) AS n_cases_both_sexes, count(*) FILTER (WHERE value AND sex = 0) AS n_cases_females,
        count(*) FILTER (WHERE value AND sex = 1) AS n_cases_males
        FROM flags LEFT JOIN samples ON user_id = "userId" GROUP BY 1""",
        "flags", "samples",
    ),
)
def a1(t):
    joined = lookup(t.flags, t.samples.withColumnRenamed("userId", "user_id"), ["user_id"])
    return joined.groupBy("pheno").agg(*munging.case_counts(F.col("value"), F.col("sex")))


@query(
    "A2_count_cases_categorical",
    with_views(
        """SELECT pheno, count(*) FILTER (WHERE value) AS n_cases, count(*) FILTER (WHERE NOT value) AS n_controls,
        'field ' || pheno AS field, 'meaning' AS meaning FROM flags GROUP BY 1""",
        "flags",
    ),
)
def a2_categorical(t):
    frame = three_sex(t.flags)
    return munging.count_cases(frame, "categorical").cols.select(
        "pheno", "n_cases", "n_controls", F.col("Field").alias("field"), "meaning"
    )


def three_sex(entries):
    """A matrix with one field per sex and described columns."""
    female = F.col("user_id") % 2 == 0
    split = entries.select(
        "user_id", "pheno", F.col("value").alias("both_sexes"),
        F.when(female, F.col("value")).alias("females"), F.when(~female, F.col("value")).alias("males"),
    )
    nothing = F.lit(None).cast("string")
    cols = entries.select("pheno").distinct().select(
        "pheno",
        F.struct(nothing.alias("Field"), nothing.alias("meaning")).alias("both_sexes_pheno"),
        F.struct(F.concat(F.lit("field "), "pheno").alias("Field"), nothing.alias("meaning")).alias("females_pheno"),
        F.struct(F.lit("unused").alias("Field"), F.lit("meaning").alias("meaning")).alias("males_pheno"),
    )
    return MatrixFrame(entries.select("user_id").distinct(), cols, split, ["user_id"], ["pheno"])


@query(
    "A2_count_defined_continuous",
    with_views(
        """SELECT pheno, count(value) AS n_defined, count(value) FILTER (WHERE user_id % 2 = 0) AS n_defined_females,
        count(value) FILTER (WHERE user_id % 2 = 1) AS n_defined_males FROM measures GROUP BY 1""",
        "measures",
    ),
)
def a2_continuous(t):
    return munging.count_cases(three_sex(t.measures), "continuous").cols.select(
        "pheno", "n_defined", "n_defined_females", "n_defined_males"
    )


_ICD_FLAGS = """icd AS (SELECT user_id, icd_code, bool_or(source = 'primary_codes') AS p, bool_or(source = 'secondary_codes') AS s,
    bool_or(source = 'external_codes') AS e, bool_or(source = 'cause_of_death_codes') AS d FROM codes GROUP BY 1, 2)"""


@query(
    "A2_count_cases_icd",
    with_views(
        """SELECT icd_code, count(*) FILTER (WHERE p) AS n_cases, (SELECT count(DISTINCT user_id) FROM codes) - count(*) FILTER (WHERE p) AS n_controls,
        count(*) FILTER (WHERE s) AS n_cases_secondary, count(*) FILTER (WHERE d) AS n_cases_cause_of_death,
        count(*) AS n_cases_all, (SELECT count(DISTINCT user_id) FROM codes) - count(*) AS n_controls_all FROM icd GROUP BY 1""",
        "codes", extra=_ICD_FLAGS,
    ),
)
def a2_icd(t):
    frame = icd.icd_matrix(t.codes).filter_cols("NOT truncated")
    return munging.count_cases(frame, "icd").cols.drop("truncated")


@query(
    "A3_group_columns_by_lists",
    with_views(
        """SELECT user_id, grouping, coalesce(bool_or(value), false) AS new_entry FROM flags JOIN (VALUES
        ('1-URGENT', '1-URGENT,2-HIGH'), ('2-HIGH', '1-URGENT,2-HIGH'), ('1-URGENT', '1-URGENT,5-LOW'),
        ('5-LOW', '1-URGENT,5-LOW')) g(pheno, grouping) USING (pheno) GROUP BY 1, 2""",
        "flags",
    ),
)
def a3(t):
    groups = [["1-URGENT", "2-HIGH"], ["1-URGENT", "5-LOW"]]
    return munging.group_columns(t.flags, ["user_id"], "pheno", "value", groups).withColumn(
        "grouping", F.array_join("grouping", ",")
    )


@query(
    "A4_group_columns_by_name",
    with_views(
        """SELECT user_id, grouping, count(*) FILTER (WHERE value) AS new_entry FROM flags JOIN (VALUES
        ('1-URGENT', 'top'), ('2-HIGH', 'top'), ('1-URGENT', 'ends'), ('5-LOW', 'ends')) g(pheno, grouping)
        USING (pheno) GROUP BY 1, 2""",
        "flags",
    ),
)
def a4(t):
    groups = {"top": ["1-URGENT", "2-HIGH"], "ends": ["1-URGENT", "5-LOW"]}
    return munging.group_columns(t.flags, ["user_id"], "pheno", "value", groups, function=F.count_if)


@query(
    "A5_conditional_phenotypes",
    with_views(
        """SELECT user_id, a || ',' || b AS grouping,
        CASE WHEN bool_or(value) FILTER (WHERE pheno = b) THEN bool_or(value) FILTER (WHERE pheno = a) END AS new_entry
        FROM flags JOIN (VALUES ('1-URGENT', '2-HIGH'), ('5-LOW', '2-HIGH'), ('2-HIGH', '3-MEDIUM')) pairs(a, b)
        ON pheno IN (a, b) GROUP BY user_id, a, b""",
        "flags",
    ),
)
def a5(t):
    pairs = [["1-URGENT", "2-HIGH"], ["5-LOW", "2-HIGH"], ["2-HIGH", "3-MEDIUM"]]
    return munging.condition_columns(t.flags, ["user_id"], "pheno", "value", pairs).withColumn(
        "grouping", F.array_join("grouping", ",")
    )


_ROLLUP = _ICD_FLAGS + """, short AS (SELECT DISTINCT substr(icd_code, 1, 3) AS icd_code FROM (
        SELECT DISTINCT icd_code FROM codes WHERE length(icd_code) IN (3, 4)) GROUP BY substr(icd_code, 1, 3) HAVING count(*) > 1),
    rolled AS (SELECT user_id, substr(icd_code, 1, 3) AS icd_code, bool_or(p) AS p, bool_or(s) AS s, bool_or(e) AS e, bool_or(d) AS d
        FROM icd WHERE length(icd_code) IN (3, 4) AND substr(icd_code, 1, 3) IN (SELECT icd_code FROM short) GROUP BY 1, 2)"""


@query(
    "M5_icd_matrix",
    with_views(
        """SELECT user_id, icd_code, p AS primary_codes, s AS secondary_codes, e AS external_codes, d AS cause_of_death_codes,
        true AS any_codes FROM icd""",
        "codes", extra=_ICD_FLAGS,
    ),
)
def m5(t):
    return icd.icd_matrix(t.codes).entries.filter("NOT truncated").drop("truncated").withColumnRenamed("userId", "user_id")


@query(
    "A6_icd_rollup",
    with_views(
        """SELECT user_id, icd_code, p AS primary_codes, s AS secondary_codes, e AS external_codes, d AS cause_of_death_codes,
        true AS any_codes FROM rolled""",
        "codes", extra=_ROLLUP,
    ),
)
def a6(t):
    return icd.icd_matrix(t.codes).entries.filter("truncated").drop("truncated").withColumnRenamed("userId", "user_id")


@query(
    "A10_prefer_truncated_codes",
    with_views(
        """SELECT icd_code, truncated, count(*) AS n_people FROM (
            SELECT user_id, icd_code, true AS truncated FROM rolled UNION ALL
            SELECT user_id, icd_code, false FROM icd WHERE length(icd_code) = 3 AND icd_code NOT IN (SELECT icd_code FROM short))
        GROUP BY 1, 2""",
        "codes", extra=_ROLLUP,
    ),
)
def a10(t):
    kept = icd.prefer_truncated(icd.icd_matrix(t.codes))
    return kept.entries.groupBy("icd_code", "truncated").agg(F.count("*").alias("n_people"))


@query(
    "A7_combine_simple",
    with_views(
        """, pairs AS (SELECT user_id, event_type AS drug, min(event_type) AS grp FROM events GROUP BY 1, 2),
        drugs AS (SELECT user_id, drug AS pheno, grp AS coding FROM (SELECT user_id, drug, substr(drug, 1, 1) AS grp FROM pairs)),
        both_levels AS (SELECT * FROM drugs UNION ALL SELECT DISTINCT user_id, coding, coding FROM drugs)
        SELECT 'categorical' AS data_type, pheno, '' AS coding, count(*) FILTER (WHERE value) AS n_cases, count(value) AS n_defined,
            count(value) AS n_cells FROM flags GROUP BY 2
        UNION ALL
        SELECT 'prescriptions', pheno, coding, count(*), count(*), (SELECT count(*) FROM (
            SELECT user_id FROM flags UNION SELECT user_id FROM events)) FROM both_levels GROUP BY 2, 3""",
        "flags",
    ),
)
def a7(t):
    flags = t.flags.select(F.col("user_id").alias("userId"), "pheno", F.lit("").alias("coding"), "value")
    showcase = MatrixFrame(
        flags.select("userId").distinct(), flags.select("pheno", "coding").distinct(), flags, ["userId"], ["pheno", "coding"]
    )
    full = combine.combine_sources_simple({"categorical": showcase, "prescriptions": event_drugs(t)})
    cells = full.entries.groupBy(*full.col_key).agg(F.count("value").alias("n_cells"))
    return full.cols.join(cells, list(full.col_key))


# Diagnosis codes of customers rather than of orders, to share the row key.
_CUSTOMER_CODES = """codes AS (SELECT o_custkey AS user_id, c.source, c.icd_code FROM order_codes c
    JOIN orders ON c.user_id = o_orderkey), """


def customer_codes(t: Tables) -> DataFrame:
    # Dealt, as a task joins and groups at once.
    person = dealt(t.orders.select(F.col("o_orderkey").alias("userId"), "o_custkey"), ["userId"])
    return dealt(t.codes, ["userId"]).join(person, "userId").select(F.col("o_custkey").alias("userId"), "source", "icd_code")


def customer_diagnoses(t: Tables) -> MatrixFrame:
    """Codes of customers, with every customer as a row."""
    frame = icd.icd_matrix(customer_codes(t), rows=t.samples.select("userId"))
    texts = {
        "short_meaning": F.concat(F.lit("short "), "icd_code"), "meaning": F.concat(F.lit("long "), "icd_code"),
        "icd_version": F.lit("icd10"),
    }
    return frame.with_(cols=frame.cols.withColumns(texts))


def _diagnosed() -> str:
    """The codes of customers and their roll-up."""
    order_codes = with_views("", "codes")[len("WITH "):].strip().replace("codes AS (", "order_codes AS (", 1)
    return order_codes + ", " + _CUSTOMER_CODES + _ROLLUP


def _cell_sums(frame: MatrixFrame, field: str) -> DataFrame:
    ids = F.col(frame.row_key[0])
    return defaults.cells_by_value(frame, field, {"ids": ids, "squares": ids * ids})


@query(
    "A7_combine_simple_with_diagnoses",
    with_views(
        """, drugs AS (SELECT DISTINCT user_id, event_type AS pheno, substr(event_type, 1, 1) AS coding FROM events),
        both_levels AS (SELECT * FROM drugs UNION ALL SELECT DISTINCT user_id, coding, coding FROM drugs),
        people AS (SELECT "userId" AS user_id FROM samples UNION SELECT user_id FROM events),
        cols AS (SELECT DISTINCT 'icd' AS data_type, icd_code AS pheno, 'icd10' AS coding FROM rolled
            UNION ALL SELECT DISTINCT 'prescriptions', pheno, coding FROM both_levels),
        stored AS (SELECT 'icd' AS data_type, icd_code AS pheno, 'icd10' AS coding, user_id FROM rolled
            UNION ALL SELECT 'prescriptions', pheno, coding, user_id FROM both_levels),
        counts AS (SELECT data_type, pheno, coding, count(*) AS n_cases,
            CASE WHEN data_type = 'icd' THEN (SELECT count(*) FROM samples) ELSE count(*) END AS n_defined FROM stored GROUP BY 1, 2, 3)
        SELECT c.data_type, c.pheno, c.coding, n_cases, n_defined,
            CASE WHEN s.user_id IS NOT NULL THEN 1.0 WHEN c.data_type = 'prescriptions' OR p.user_id IN (SELECT "userId" FROM samples) THEN 0.0 END::DOUBLE AS value,
            count(*) AS n, sum(p.user_id)::BIGINT AS ids, sum(p.user_id * p.user_id)::BIGINT AS squares
        FROM cols c CROSS JOIN people p JOIN counts USING (data_type, pheno, coding)
        LEFT JOIN stored s ON s.data_type = c.data_type AND s.pheno = c.pheno AND s.coding = c.coding AND s.user_id = p.user_id GROUP BY 1, 2, 3, 4, 5, 6""",
        "samples", extra=_diagnosed(),
    ),
)
def a7_icd(t):
    """Diagnoses and prescriptions, no zero stored; every cell counted by its value."""
    full = combine.combine_sources_simple({"icd": customer_diagnoses(t), "prescriptions": event_drugs(t)}, implicit=True)
    return full.cols.drop(defaults.VALUE, defaults.FOR).join(_cell_sums(full, "value"), list(full.col_key))


_ALL_CELLS = """, drugs AS (SELECT DISTINCT user_id, event_type AS pheno FROM events UNION ALL SELECT DISTINCT user_id, substr(event_type, 1, 1) FROM events),
        codes3 AS (SELECT user_id, icd_code FROM rolled
            UNION ALL SELECT user_id, icd_code FROM icd WHERE length(icd_code) = 3 AND icd_code NOT IN (SELECT icd_code FROM short)),
        stored AS (SELECT 'ICDTYPE' AS trait_type, icd_code AS phenocode, user_id, 1.0 AS v FROM codes3
            UNION ALL SELECT 'prescriptions', pheno, user_id, 1.0 FROM drugs
            UNION ALL SELECT 'biomarkers', pheno, user_id, value FROM measures),
        people AS (PEOPLE),
        cols AS (SELECT DISTINCT trait_type, phenocode FROM stored),
        cells AS (SELECT c.trait_type, c.phenocode, p.user_id, sex, s.v, s.user_id IS NOT NULL AS has, x."userId" IS NOT NULL AS person
            FROM cols c CROSS JOIN people p LEFT JOIN samples x ON x."userId" = p.user_id
            LEFT JOIN stored s ON s.trait_type = c.trait_type AND s.phenocode = c.phenocode AND s.user_id = p.user_id)
        SELECT trait_type, phenocode, field, CASE
            WHEN trait_type = 'prescriptions' THEN CASE WHEN has AND (field = 'both_sexes' OR sex = CASE field WHEN 'females' THEN 0 ELSE 1 END) THEN 1.0 ELSE 0.0 END
            WHEN field <> 'both_sexes' AND sex IS DISTINCT FROM CASE field WHEN 'females' THEN 0 ELSE 1 END THEN NULL
            WHEN has THEN v WHEN trait_type = 'ICDTYPE' AND person THEN 0.0 END::DOUBLE AS value,
            count(*) AS n, sum(user_id)::BIGINT AS ids, sum(user_id * user_id)::BIGINT AS squares
        FROM cells CROSS JOIN (SELECT unnest(['both_sexes', 'females', 'males']) AS field) GROUP BY 1, 2, 3, 4"""


def all_cells(t: Tables, legacy: bool) -> DataFrame:
    """Every cell of three sources side by side, by its value, with no zero stored."""
    measures = t.measures.withColumnRenamed("user_id", "userId")
    biomarkers = MatrixFrame(
        measures.select("userId").distinct(),
        measures.select("pheno").distinct().withColumns({"Field": F.lit("field"), "Path": F.lit("path")}),
        measures, ["userId"], ["pheno"],
    )
    sources = {"biomarkers": biomarkers, "icd": customer_diagnoses(t), "prescriptions": event_drugs(t)}
    full = combine.combine_sources(sources, t.samples, legacy=legacy, implicit=True)
    # Staged: every field joins and counts all three, and made anew the rows fill the same tasks as the cells.
    full = full.with_(rows=stage(full.rows), cols=stage(full.cols), entries=stage(full.entries))
    fields = [_cell_sums(full, s).withColumn("field", F.lit(s)) for s in SEXES]
    union = fields[0].unionByName(fields[1]).unionByName(fields[2])
    return union.drop("pheno_sex", "coding", "modifier")


def _all_cells_sql(people: str) -> str:
    return with_views(_ALL_CELLS.replace("ICDTYPE", "icd10").replace("PEOPLE", people), "samples", "measures", extra=_diagnosed())


@query(
    "A8_combine_cells",
    _all_cells_sql('SELECT "userId" AS user_id FROM samples UNION SELECT user_id FROM events UNION SELECT user_id FROM measures'),
)
def a8_cells(t):
    return all_cells(t, legacy=False)


@query("A9_combine_cells_legacy", _all_cells_sql("SELECT DISTINCT user_id FROM measures"))
def a9_cells(t):
    return all_cells(t, legacy=True)


def event_drugs(t: Tables) -> MatrixFrame:
    """Events as prescriptions: the type is the drug, its first letter the category."""
    records = t.events.select(
        F.col("user_id").alias("eid"),
        F.col("event_type").alias("Generic_Name"),
        F.substring("event_type", 1, 1).alias("Drug_Category_and_Indication"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("issue_date"),
    )
    return registry.prescription_matrix(records)


_A8_BODY = """
    UNION ALL
    SELECT 'phecode', pheno, 'both_sexes', '', '', count(*) FILTER (WHERE sex IS NOT NULL), count(*),
        count(*) FILTER (WHERE sex = 0), count(*) FILTER (WHERE sex = 1), 'about ' || pheno, NULL, NULL, 'orders',
        count(*), count(*) FILTER (WHERE sex = 0), count(*) FILTER (WHERE sex = 1)
    FROM cases LEFT JOIN samples ON user_id = "userId" GROUP BY pheno
    UNION ALL
    SELECT 'biomarkers', pheno, 'both_sexes', '', '', NULL, count(value), count(value) FILTER (WHERE sex = 0),
        count(value) FILTER (WHERE sex = 1), 'field', NULL, NULL, 'path',
        sum(value), sum(value) FILTER (WHERE sex = 0), sum(value) FILTER (WHERE sex = 1)
    FROM measures LEFT JOIN samples ON user_id = "userId" GROUP BY pheno
    UNION ALL
    SELECT 'prescriptions', pheno, 'both_sexes', '', '', count(*) FILTER (WHERE sex IS NOT NULL), count(*),
        count(*) FILTER (WHERE sex = 0), count(*) FILTER (WHERE sex = 1), NULL, NULL, NULL, max(category),
        count(*), count(*) FILTER (WHERE sex = 0), count(*) FILTER (WHERE sex = 1)
    FROM (SELECT DISTINCT user_id, event_type AS pheno, substr(event_type, 1, 1) AS category FROM events
          UNION ALL SELECT DISTINCT user_id, substr(event_type, 1, 1), NULL FROM events) drugs
    LEFT JOIN samples ON user_id = "userId" GROUP BY pheno
    UNION ALL
    SELECT CASE WHEN true THEN 'ICDTYPE' END, icd_code, 'both_sexes', '', '', count(*) FILTER (WHERE sex IS NOT NULL), count(*),
        count(*) FILTER (WHERE sex = 0), count(*) FILTER (WHERE sex = 1), 'short ' || icd_code,
        'truncated: ' || truncated, NULL, 'long ' || icd_code,
        count(*), count(*) FILTER (WHERE sex = 0), count(*) FILTER (WHERE sex = 1)
    FROM (SELECT user_id, icd_code, true AS truncated FROM rolled UNION ALL
          SELECT user_id, icd_code, false FROM icd WHERE length(icd_code) = 3 AND icd_code NOT IN (SELECT icd_code FROM short)) codes3
    LEFT JOIN samples ON user_id = "userId" GROUP BY icd_code, truncated"""

def _combined_sql(first: str, icd_type: str) -> str:
    order_codes = with_views("", "codes")[len("WITH "):].strip().replace("codes AS (", "order_codes AS (", 1)
    return with_views(
        first + _A8_BODY.replace("ICDTYPE", icd_type), "flags", "cases", "measures", "samples",
        extra=order_codes + ", " + _CUSTOMER_CODES + _ROLLUP,
    )


_A8_NAMES = """SELECT 'categorical' AS trait_type, pheno AS phenocode, 'both_sexes' AS pheno_sex, 'c' AS coding, '' AS modifier,
    {defined} AS n_cases_defined, count(*) FILTER (WHERE value) AS n_cases_both_sexes,
    count(*) FILTER (WHERE value AND {female}) AS n_cases_females,
    count(*) FILTER (WHERE value AND {male}) AS n_cases_males, 'field ' || pheno AS description,
    NULL AS description_more, 'meaning' AS coding_description, NULL AS category,
    sum(value::INTEGER)::DOUBLE AS sum_both_sexes, sum(value::INTEGER) FILTER (WHERE user_id % 2 = 0)::DOUBLE AS sum_females,
    sum(value::INTEGER) FILTER (WHERE user_id % 2 = 1)::DOUBLE AS sum_males
    FROM flags LEFT JOIN samples ON user_id = "userId" GROUP BY pheno"""


def combine_all(t: Tables, legacy: bool):
    flags = three_sex(t.flags)
    nothing = F.lit(None).cast("string").alias("n")

    def described(name):
        return F.struct(f"{name}.Field", f"{name}.meaning", nothing.alias("Notes"), nothing.alias("Path")).alias(name)

    flag_cols = flags.cols.select("pheno", *[described(f"{s}_pheno") for s in ("both_sexes", "females", "males")])
    key = ["pheno", "coding"] if legacy else PHENO_KEY

    def keyed(df, *rest):
        if legacy:
            return df.select("pheno", F.lit("c").alias("coding"), *rest)
        return df.select(*pheno_key("categorical", F.col("pheno"), coding="c"), *rest)

    values = flags.entries.withColumnRenamed("user_id", "userId")
    categorical = MatrixFrame(
        t.samples.select("userId"), keyed(flag_cols, *[f"{s}_pheno" for s in ("both_sexes", "females", "males")]),
        keyed(values, "userId", "both_sexes", "females", "males"), ["userId"], key,
    )
    measures = t.measures.withColumnRenamed("user_id", "userId")
    biomarkers = MatrixFrame(
        measures.select("userId").distinct(),
        measures.select("pheno").distinct().withColumns({"Field": F.lit("field"), "Path": F.lit("path")}),
        measures, ["userId"], ["pheno"],
    )
    diagnoses = icd.icd_matrix(customer_codes(t))
    diagnoses = diagnoses.with_(
        cols=diagnoses.cols.withColumns(
            {"short_meaning": F.concat(F.lit("short "), "icd_code"), "meaning": F.concat(F.lit("long "), "icd_code")}
        )
    )
    sources = {
        "categorical": categorical, "phecode": case_source(t), "biomarkers": biomarkers,
        "prescriptions": event_drugs(t), "icd": diagnoses,
    }
    full = combine.combine_sources(sources, t.samples, legacy=legacy)
    sums = full.entries.groupBy(*PHENO_KEY).agg(
        *[F.sum(s).alias(f"sum_{s}") for s in ("both_sexes", "females", "males")]
    )
    return full.cols.join(sums, PHENO_KEY)


@query(
    "A8_combine_sources",
    _combined_sql(
        _A8_NAMES.format(defined="count(*) FILTER (WHERE value AND sex IS NOT NULL)", female="sex = 0", male="sex = 1"),
        "icd10",
    ),
)
def a8(t):
    return combine_all(t, legacy=False)


@query(
    "A9_combine_sources_legacy",
    _combined_sql(
        _A8_NAMES.format(defined="NULL::BIGINT", female="user_id % 2 = 0", male="user_id % 2 = 1"), ""
    ),
)
def a9(t):
    return combine_all(t, legacy=True)


@query(
    "A11_prescription_records",
    with_views(
        """SELECT user_id, event_type AS generic, record, issue_date FROM (
            SELECT user_id, event_type, issue_date,
                row_number() OVER (PARTITION BY user_id, event_type ORDER BY issue_date IS NULL, issue_date, event_id) AS record
            FROM dated)""",
        extra="""dated AS (SELECT user_id, event_type, event_id, CASE WHEN event_id % 10 > 0
            THEN floor(epoch(ts) / 86400)::BIGINT * 86400 END AS issue_date FROM events WHERE event_type <> 'error')""",
    ),
)
def a11(t):
    prescriptions = t.events.select(
        F.col("user_id").alias("eid"),
        F.concat(F.lit("drug "), "event_type").alias("drug_name"),
        F.when(F.col("event_id") % 10 > 0, F.date_format("ts", "dd/MM/yyyy")).otherwise("").alias("issue_date"),
        "event_id",
    )
    types = t.events.select("event_type").distinct()
    mapping = types.select(
        F.concat(F.lit("drug "), "event_type").alias("Original_Prescription"),
        F.when(F.col("event_type") != "error", F.col("event_type")).otherwise("").alias("Generic_Name"),
        F.lit("category").alias("Drug_Category_and_Indication"),
    )
    return registry.prescription_records(prescriptions, mapping.unionByName(mapping)).select(
        F.col("eid").alias("user_id"), F.col("Generic_Name").alias("generic"), "record", "issue_date"
    )


_COVID_SQL = """tests AS (
        SELECT c_custkey AS eid, bool_or(o_orderpriority = '1-URGENT') AS origin, bool_or(o_orderstatus = 'F') AS result1,
               bool_or(o_orderpriority = '5-LOW') AS inpatient1
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal > 0 GROUP BY 1),
    visits AS (SELECT user_id AS eid, event_id, date_trunc('day', ts) AS day, event_type FROM events
        WHERE event_type IN ('signup', 'view')),
    diagnosed AS (SELECT DISTINCT eid, day FROM visits WHERE event_type = 'signup' AND event_id % 7 = 0),
    died AS (SELECT DISTINCT user_id AS eid, date_trunc('day', ts) AS day FROM events WHERE event_type = 'purchase'),
    people AS (SELECT eid FROM visits UNION SELECT eid FROM died),
    register AS (SELECT eid,
        EXISTS (SELECT 1 FROM diagnosed d JOIN visits v ON d.eid = v.eid
                WHERE d.eid = people.eid AND v.day >= d.day AND v.day < d.day + INTERVAL {days} DAY) AS inpatient2,
        EXISTS (SELECT 1 FROM diagnosed d JOIN died x ON d.eid = x.eid
                WHERE d.eid = people.eid AND x.day >= d.day AND x.day < d.day + INTERVAL {days} DAY) AS death,
        EXISTS (SELECT 1 FROM diagnosed d WHERE d.eid = people.eid) AS pcr_result FROM people),
    status AS (SELECT eid, origin, inpatient1 OR inpatient2 AS inpatient, result1 OR pcr_result AS result, death
        FROM tests FULL OUTER JOIN register USING (eid))"""


def covid_inputs(t: Tables):
    tests = t.orders.join(
        t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey")), "o_custkey", "left_semi"
    ).select(
        F.col("o_custkey").alias("eid"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("origin"),
        (F.col("o_orderstatus") == "F").cast("int").alias("result"),
        (F.col("o_orderpriority") == "5-LOW").cast("int").alias("reqorg"),
    )
    day = F.date_format("ts", "dd/MM/yyyy")
    visits = t.events.filter(F.col("event_type").isin("signup", "view"))
    hes_main = visits.select(
        F.col("user_id").alias("eid"), F.col("event_id").alias("ins_index"),
        F.lit(None).cast("string").alias("epistart"), day.alias("admidate"),
    )
    hes_diag = visits.select(
        F.col("user_id").alias("eid"), F.col("event_id").alias("ins_index"),
        F.when((F.col("event_type") == "signup") & (F.col("event_id") % 7 == 0), "U071").otherwise("J45").alias("diag_icd10"),
    )
    deaths = t.events.filter("event_type = 'purchase'").select(
        F.col("user_id").alias("eid"), day.alias("date_of_death")
    )
    return tests, hes_main, hes_diag, deaths


@query(
    "A12_any_within_window",
    """SELECT user_id, bool_or(within) AS within FROM (
        SELECT u.user_id, EXISTS (SELECT 1 FROM events s JOIN events p ON s.user_id = p.user_id
            WHERE s.user_id = u.user_id AND s.event_type = 'signup' AND p.event_type = 'purchase'
            AND floor(epoch(p.ts)) >= floor(epoch(s.ts)) AND floor(epoch(p.ts)) < floor(epoch(s.ts)) + 3600) AS within
        FROM (SELECT DISTINCT user_id FROM events WHERE event_type IN ('signup', 'purchase')) u) GROUP BY 1""",
)
def a12(t):
    timed = t.events.withColumn("second", F.unix_seconds(F.col("ts").cast("timestamp")))
    starts = timed.filter("event_type = 'signup'")
    outcomes = timed.filter("event_type = 'purchase'")
    return registry.any_within(starts, outcomes, ["user_id"], "second", "second", 3600)


@query(
    "J7_covid_status",
    f"WITH {_COVID_SQL.format(days=30)} SELECT eid, origin, inpatient, result, death FROM status",
)
def j7(t):
    return registry.covid_status(*covid_inputs(t)).select("eid", "origin", "inpatient", "result", "death")


@query(
    "C6_covid_analyses",
    f"""WITH {_COVID_SQL.format(days=5)}, people_status AS (
        SELECT c_custkey AS eid, c_nationkey AS center, origin, inpatient, result, death
        FROM customer LEFT JOIN status ON c_custkey = eid),
    analyses AS (SELECT eid, coalesce(death, false) AS a2, CASE WHEN result THEN inpatient END AS b1,
        CASE WHEN result THEN origin END AS b1o, coalesce(result, false) AS c2,
        CASE WHEN center IN (1, 2, 3, 4) THEN coalesce(result, false) END AS c2e, result AS c1,
        coalesce(result AND inpatient, false) AS b2, coalesce(result AND origin, false) AS b2o FROM people_status),
    long AS (UNPIVOT analyses ON a2, b1, b1o, c2, c2e, c1, b2, b2o INTO NAME analysis VALUE value)
    SELECT analysis, count(*) FILTER (WHERE value) AS n_cases, count(*) FILTER (WHERE NOT value) AS n_controls FROM long GROUP BY 1""",
)
def c6(t):
    status = registry.covid_status(*covid_inputs(t), window_days=5)
    people = t.customer.select(F.col("c_custkey").alias("eid"), F.col("c_nationkey").alias("recruitment_center"))
    flags = lookup(people, status, ["eid"], unique=True)
    short = dict(zip(registry.COVID_ANALYSES, ["a2", "b1", "b1o", "c2", "c2e", "c1", "b2", "b2o"]))
    analyses = registry.covid_analyses(centers=[1, 2, 3, 4])
    wide = flags.select("eid", *[c.alias(short[n]) for n, c in analyses.items()])
    frame = reshape.select_fields(wide, ["eid"], lambda n, k: True, rename=lambda n: n)
    return frame.entries.groupBy(F.col("phenocode").alias("analysis")).agg(
        F.count_if(F.col("value") == 1).alias("n_cases"), F.count_if(F.col("value") == 0).alias("n_controls")
    )


_NUMBER = "CASE c_custkey % 7 WHEN 0 THEN '1901-01-01' WHEN 1 THEN '1902-02-02' WHEN 2 THEN '1903-03-03' WHEN 3 THEN c_acctbal::VARCHAR WHEN 4 THEN NULL ELSE strftime(DATE '2000-01-01' + (c_custkey % 1000)::INTEGER, '%Y-%m-%d') END"


@query(
    "C4_first_occurrence_values",
    f"""WITH base AS (SELECT c_custkey, {_NUMBER} AS x, 1940 + c_nationkey AS y, c_custkey % 12 + 1 AS m, c_acctbal FROM customer)
    SELECT c_custkey AS eid, CASE WHEN c_custkey % 7 = 3 THEN c_acctbal WHEN x = '1901-01-01' THEN NULL WHEN x = '1902-02-02' THEN 0
        WHEN x = '1903-03-03' THEN date_diff('day', make_date(1970, m::INTEGER, 15), DATE '1970-12-31') * 86400 / 2
        ELSE date_diff('day', make_date(y, m::INTEGER, 15), x::DATE) * 86400 END::DOUBLE AS value FROM base""",
)
def c4(t):
    births = registry.birth_dates(customer_births(t), "c_custkey")
    key, text = F.col("c_custkey"), F.col("c_acctbal").cast("string")
    date = F.date_format(F.date_add(F.lit("2000-01-01").cast("date"), (key % 1000).cast("int")), "yyyy-MM-dd")
    recorded = (
        F.when(key % 7 == 0, "1901-01-01").when(key % 7 == 1, "1902-02-02").when(key % 7 == 2, "1903-03-03")
        .when(key % 7 == 3, text).when(key % 7 == 4, F.lit(None).cast("string")).otherwise(date)
    )
    dated = lookup(t.customer.select("c_custkey", recorded.alias("x")), births, ["c_custkey"])
    value = first_occurrence_seconds(F.col("x"), F.col("date_of_birth"), F.col("month_of_birth"))
    return dated.select(F.col("c_custkey").alias("eid"), value.alias("value"))


def customer_births(t: Tables):
    return t.customer.select(
        "c_custkey",
        (1940 + F.col("c_nationkey")).cast("string").alias("x34_0_0"),
        (F.col("c_custkey") % 12 + 1).cast("string").alias("x52_0_0"),
        F.col("c_nationkey").cast("string").alias("x54_0_0"),
    )


@query(
    "S5_birth_dates",
    """SELECT c_custkey AS user_id, date_diff('day', DATE '1970-01-01', make_date(1940 + c_nationkey, (c_custkey % 12 + 1)::INTEGER, 15))
        * 86400 AS date_of_birth, lpad((c_custkey % 12 + 1)::VARCHAR, 2, '0') AS month_of_birth,
        (1940 + c_nationkey)::VARCHAR AS year_of_birth, c_nationkey AS recruitment_center FROM customer""",
)
def s5(t):
    return registry.birth_dates(customer_births(t), "c_custkey").withColumnRenamed("c_custkey", "user_id").withColumn(
        "user_id", F.col("user_id").cast("long")
    )


@query(
    "C5_quality_flag",
    """SELECT s_suppkey AS eid, s_suppkey % 5 <> 0 AND s_suppkey % 2 = 1 AND s_nationkey % 3 > 0 AS hq
    FROM supplier""",
)
def c5(t):
    wide = activity_wide(t)
    return wide.select("eid", registry.high_quality(wide).alias("hq"))


def activity_wide(t: Tables):
    key, nation = F.col("s_suppkey"), F.col("s_nationkey")
    return t.supplier.select(
        key.alias("eid"),
        F.when(key % 5 == 0, 1).alias("90002-0.0"),
        (key % 2).cast("int").alias("90015-0.0"),
        F.least(nation % 3, F.lit(1)).cast("int").alias("90016-0.0"),
        F.lit(1).alias("90017-0.0"),
        F.col("s_acctbal").alias("90012-0.0"),
        F.col("s_name").alias("90099-0.0"),
    )


@query(
    "load_activity_monitor",
    """SELECT s_suppkey AS eid, '90012' AS phenocode, CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 2 = 1 AND s_nationkey % 3 > 0
        THEN s_acctbal END AS value FROM supplier""",
)
def load_activity(t):
    fields = t.region.select(
        F.concat(F.lit("9001"), F.col("r_regionkey").cast("string")).alias("FieldID"),
        F.when(F.col("r_regionkey") == 2, "Continuous").otherwise("Integer").alias("ValueType"),
    )
    return registry.activity_monitor(activity_wide(t), fields, strict=True).entries.select("eid", "phenocode", "value")


@query(
    "C7_model_family",
    with_views(
        """SELECT order_id, CASE WHEN trait_type IN ('continuous', 'biomarkers') THEN 'quantitative' ELSE 'binary' END AS family
        FROM pheno_keys""",
        "pheno_keys",
    ),
)
def c7(t):
    return t.pheno_keys.select("order_id", model_family(F.col("trait_type")).alias("family"))


@query(
    "J1_keyed_lookup",
    """SELECT c_custkey, n_name, n_regionkey FROM customer LEFT JOIN (
        SELECT n_nationkey, n_name, n_regionkey FROM nation WHERE n_nationkey % 3 > 0) n ON c_nationkey = n_nationkey""",
)
def j1(t):
    nations = t.nation.filter("n_nationkey % 3 > 0").withColumnRenamed("n_nationkey", "c_nationkey")
    return lookup(t.customer, nations.unionByName(nations), ["c_nationkey"]).select("c_custkey", "n_name", "n_regionkey")


def coding_inputs(t: Tables):
    """Columns (suppliers), codings (nations) and reassignments (nations)."""
    cols = t.supplier.select(
        F.col("s_suppkey").alias("col_id"),
        (F.col("s_suppkey") % 5).cast("int").alias("coding_id"),
        F.concat(F.lit("f"), (F.col("s_suppkey") % 4).cast("string")).alias("phenocode"),
        F.col("s_nationkey").cast("string").alias("coding"),
    )
    table = t.nation.filter("n_nationkey < 15").select(
        F.col("n_regionkey").alias("coding_id"), F.col("n_nationkey").cast("string").alias("coding"),
        F.col("n_name").alias("meaning"),
    )
    code = F.col("n_nationkey").cast("string")
    items = F.concat(
        F.lit("x "), (F.col("n_nationkey") - 10).cast("string"), F.lit("="), code, F.lit("|9=NA|7=8")
    )
    summary = t.nation.filter("n_nationkey >= 15").select(
        F.concat(F.lit("f"), (F.col("n_nationkey") % 4).cast("string"), F.lit("_"), code).alias("FieldID"),
        items.alias("PHESANT.reassignments"),
    )
    return cols, table, summary


_CODING_SQL = """cols AS (SELECT s_suppkey AS col_id, s_suppkey % 5 AS coding_id, 'f' || (s_suppkey % 4) AS phenocode,
        s_nationkey AS coding FROM supplier),
    codings AS (SELECT n_regionkey AS coding_id, n_nationkey AS coding, n_name AS meaning FROM nation WHERE n_nationkey < 15),
    moved AS (SELECT 'f' || (n_nationkey % 4) AS phenocode, n_nationkey AS coding, n_nationkey - 10 AS origin
        FROM nation WHERE n_nationkey >= 15),
    found AS (SELECT col_id, c.coding_id, c.coding, a.meaning AS direct, m.origin, b.meaning AS second FROM cols c
        LEFT JOIN codings a ON a.coding_id = c.coding_id AND a.coding = c.coding
        LEFT JOIN moved m ON m.phenocode = c.phenocode AND m.coding = c.coding AND a.meaning IS NULL
        LEFT JOIN codings b ON b.coding_id = c.coding_id AND b.coding = m.origin)"""


@query(
    "J2_add_meanings",
    f"""WITH {_CODING_SQL} SELECT col_id, origin::VARCHAR AS recoding, coalesce(direct, second) AS meaning FROM found""",
)
def j2(t):
    return codings.add_meanings(*coding_inputs(t)).select("col_id", "recoding", "meaning")


@query(
    "J3_reassignments",
    """SELECT 'f' || (n_nationkey % 4) AS pheno, n_nationkey::VARCHAR AS coding, (n_nationkey - 10)::VARCHAR AS reassign_from,
    n_nationkey::VARCHAR AS reassign_to FROM nation WHERE n_nationkey >= 15""",
)
def j3(t):
    return codings.reassignments(coding_inputs(t)[2])


@query(
    "J12_missing_codings",
    f"WITH {_CODING_SQL} SELECT DISTINCT coding_id::INTEGER AS coding_id FROM found WHERE direct IS NULL AND second IS NULL",
)
def j12(t):
    return codings.missing_codings(codings.add_meanings(*coding_inputs(t)))


def sex_matrices(t: Tables) -> dict[str, MatrixFrame]:
    """Line items as three matrices by supplier group."""
    frames = {}
    for i, sex in enumerate(("both_sexes", "females", "males")):
        entries = t.lineitem.filter(F.col("l_suppkey") % 3 == i).groupBy(
            F.col("l_partkey").alias("user_id"), F.concat("l_returnflag", "l_linestatus").alias("pheno")
        ).agg(F.max("l_quantity").alias("value"))
        cols = entries.select("pheno").distinct().filter(F.col("pheno").substr(1, 1) != "ANR"[i]).withColumn(
            "Field", F.concat(F.lit(f"{sex} "), "pheno")
        )
        entries = entries.join(cols.select("pheno"), "pheno", "left_semi").select("user_id", "pheno", "value")
        frames[sex] = MatrixFrame(entries.select("user_id").distinct(), cols, entries, ["user_id"], ["pheno"])
    return frames


@query(
    "J4_combine_by_sex",
    """WITH cells AS (SELECT l_partkey AS user_id, l_returnflag || l_linestatus AS pheno, l_suppkey % 3 AS g, max(l_quantity) AS v
        FROM lineitem WHERE NOT (l_suppkey % 3 = 0 AND l_returnflag = 'A') AND NOT (l_suppkey % 3 = 1 AND l_returnflag = 'N')
        AND NOT (l_suppkey % 3 = 2 AND l_returnflag = 'R') GROUP BY 1, 2, 3)
    SELECT user_id, pheno, max(v) FILTER (WHERE g = 0) AS both_sexes, max(v) FILTER (WHERE g = 1) AS females,
        max(v) FILTER (WHERE g = 2) AS males,
        CASE WHEN pheno LIKE 'A%' THEN NULL ELSE 'both_sexes ' || pheno END AS both_field,
        CASE WHEN pheno LIKE 'N%' THEN NULL ELSE 'females ' || pheno END AS female_field FROM cells GROUP BY 1, 2""",
)
def j4(t):
    frame = reshape.by_sex(sex_matrices(t))
    return frame.entries.join(frame.cols, "pheno").select(
        "user_id", "pheno", "both_sexes", "females", "males",
        F.col("both_sexes_pheno.Field").alias("both_field"), F.col("females_pheno.Field").alias("female_field"),
    )


@query(
    "J5_join_all_axes",
    """WITH l AS (SELECT o_custkey AS user_id, o_orderpriority AS pheno, count(*) AS n FROM orders GROUP BY 1, 2),
    r AS (SELECT o_custkey AS user_id, o_orderpriority AS pheno, max(o_totalprice) AS price FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2)
    SELECT l.user_id, l.pheno, n, price, 'about ' || l.pheno AS about, c_acctbal AS balance FROM l
    LEFT JOIN r USING (user_id, pheno) LEFT JOIN customer ON c_custkey = l.user_id""",
)
def j5(t):
    cells = t.orders.groupBy(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("pheno"))
    left_entries = cells.agg(F.count("*").alias("n"))
    left = MatrixFrame(
        left_entries.select("user_id").distinct(), left_entries.select("pheno").distinct(), left_entries, ["user_id"], ["pheno"]
    )
    closed = t.orders.filter("o_orderstatus = 'F'")
    right_entries = closed.groupBy(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("pheno")).agg(
        F.max("o_totalprice").alias("price")
    )
    right = MatrixFrame(
        t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_acctbal").alias("balance")),
        t.orders.select(F.col("o_orderpriority").alias("pheno")).distinct().withColumn("about", F.concat(F.lit("about "), "pheno")),
        right_entries, ["user_id"], ["pheno"],
    )
    joined = reshape.join_axes(left, right, rows="", cols="info", entries="")
    return (
        joined.entries.join(joined.cols, "pheno").join(joined.rows, "user_id")
        .select("user_id", "pheno", "n", "price", F.col("info.about").alias("about"), "balance")
    )


@query(
    "J6_deduplicated_dictionary",
    """SELECT o_custkey AS user_id, max(o_orderkey) AS order_id FROM orders WHERE o_custkey IN (SELECT l_suppkey FROM lineitem)
    GROUP BY 1""",
)
def j6(t):
    newest = t.orders.select(F.col("o_custkey").alias("user_id"), (-F.col("o_orderkey")).alias("order_id"))
    keys = t.lineitem.select(F.col("l_suppkey").alias("user_id")).distinct()
    return lookup(keys, newest, ["user_id"]).filter("order_id IS NOT NULL").select(
        "user_id", (-F.col("order_id")).alias("order_id")
    )


@query(
    "J11_set_membership",
    """SELECT o_orderkey AS order_id, o_orderpriority IN ('1-URGENT', '2-HIGH') AS urgent FROM orders
    WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def j11(t):
    builders = t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.join(builders, "o_custkey", "left_semi").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("urgent")
    )


@query(
    "M1_densify_zero_fill",
    with_views(
        """SELECT user_id, pheno, coalesce(hit, 0.0)::DOUBLE AS value FROM (
            SELECT c_custkey AS user_id, pheno FROM customer, (SELECT DISTINCT pheno FROM cases)) cells
        LEFT JOIN (SELECT user_id, pheno, 1.0 AS hit FROM cases) hits USING (user_id, pheno)""",
        "cases",
    ),
)
def m1(t):
    entries = t.cases.withColumn("value", F.lit(1.0))
    rows = t.customer.select(F.col("c_custkey").alias("user_id"))
    frame = MatrixFrame(rows, entries.select("pheno").distinct(), entries, ["user_id"], ["pheno"])
    return reshape.densify(frame, {"value": 0.0}).entries


@query(
    "M2_records_by_key",
    """SELECT o_custkey AS user_id, o_orderpriority AS pheno, o_orderkey AS order_id,
    row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderkey) AS record FROM orders""",
)
def m2(t):
    """Records of a key stay rows, numbered, instead of one array per key."""
    rows = t.orders.select(
        F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("pheno"), F.col("o_orderkey").alias("order_id")
    )
    return registry.order_records(rows, ["user_id", "pheno"], "order_id")


@query(
    "M3_explode_lists",
    """SELECT p_partkey AS part_id, unnest(string_split(p_name, ' ')) AS word FROM part""",
)
def m3(t):
    return t.part.select(F.col("p_partkey").alias("part_id"), F.explode(F.split("p_name", " ")).alias("word"))


def _two_matrices(t: Tables):
    def matrix(flag, keep):
        entries = t.lineitem.filter(F.col("l_returnflag") == flag).filter(keep).groupBy(
            F.col("l_suppkey").alias("row_id"), F.concat("l_returnflag", "l_linestatus").alias("col_id")
        ).agg(F.sum("l_quantity").alias("value"))
        return MatrixFrame(entries.select("row_id").distinct(), entries.select("col_id").distinct(), entries, ["row_id"], ["col_id"])

    return matrix("A", "l_suppkey % 3 > 0"), matrix("R", "l_suppkey % 2 = 0")


def _union_sql(condition: str) -> str:
    return f"""WITH a AS (SELECT l_suppkey AS row_id, l_returnflag || l_linestatus AS col_id, sum(l_quantity) AS value FROM lineitem
        WHERE l_returnflag = 'A' AND l_suppkey % 3 > 0 GROUP BY 1, 2),
    b AS (SELECT l_suppkey AS row_id, l_returnflag || l_linestatus AS col_id, sum(l_quantity) AS value FROM lineitem
        WHERE l_returnflag = 'R' AND l_suppkey % 2 = 0 GROUP BY 1, 2)
    SELECT * FROM (SELECT * FROM a UNION ALL SELECT * FROM b) WHERE {condition}"""


@query("U3_union_cols_inner", _union_sql("row_id IN (SELECT row_id FROM a) AND row_id IN (SELECT row_id FROM b)"))
def u3_inner(t):
    return reshape.union_cols(_two_matrices(t), "inner").entries


@query("U3_union_cols_left", _union_sql("row_id IN (SELECT row_id FROM a)"))
def u3_left(t):
    return reshape.union_cols(_two_matrices(t), "left").entries


@query("U2_union_cols_outer", _union_sql("true"))
def u2(t):
    return reshape.union_cols(_two_matrices(t), "outer").entries


@query(
    "U4_distinct_by_key",
    """SELECT l_orderkey AS order_id, l_linenumber AS line, min(l_quantity) AS quantity FROM lineitem GROUP BY 1, 2""",
)
def u4(t):
    rows = t.lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("quantity")
    )
    return one_per_key(rows, ["order_id", "line"])


@query(
    "LA1_pairwise_overlap",
    with_views(
        """, counts AS (SELECT pheno, count(*)::DOUBLE AS n FROM cases GROUP BY 1 HAVING count(*) >= 20),
        pairs AS (SELECT x.pheno AS i, y.pheno AS j, count(*)::DOUBLE AS entry FROM cases x JOIN cases y USING (user_id) GROUP BY 1, 2)
        SELECT a.pheno AS i_pheno, b.pheno AS j_pheno, coalesce(entry, 0) AS entry, a.n AS i_cases,
            round(coalesce(entry, 0) / a.n, 9) AS prop_overlap
        FROM counts a CROSS JOIN counts b LEFT JOIN pairs ON i = a.pheno AND j = b.pheno""",
        "cases",
    ),
)
def la1(t):
    entries = t.cases.withColumn("value", F.lit(True))
    pairs = pairwise.pairwise_overlap(entries, "user_id", ["pheno"], "value", min_cases=20)
    return pairs.select(
        F.col("i_data.pheno").alias("i_pheno"), F.col("j_data.pheno").alias("j_pheno"), "entry",
        F.col("i_data.n_cases").alias("i_cases"), F.round("prop_overlap", 9).alias("prop_overlap"),
    )


@query(
    "LA2_pairwise_correlation",
    with_views(
        """, stats AS (SELECT pheno, avg(value) AS mu, sqrt(var_pop(value) * count(value)) AS norm FROM measures GROUP BY 1),
        scaled AS (SELECT user_id, pheno, (value - mu) / norm AS x FROM measures JOIN stats USING (pheno))
        SELECT a.pheno AS i_pheno, b.pheno AS j_pheno, round(sum(a.x * b.x), 6) AS entry FROM scaled a JOIN scaled b USING (user_id)
        GROUP BY 1, 2""",
        "measures",
    ),
)
def la2(t):
    pairs = pairwise.pairwise_correlation(t.measures, "user_id", ["pheno"], "value")
    return pairs.select(
        F.col("i_data.pheno").alias("i_pheno"), F.col("j_data.pheno").alias("j_pheno"), F.round("entry", 6).alias("entry")
    )


@query(
    "R1_full_meanings",
    """WITH RECURSIVE codes AS (SELECT p_partkey + 1 AS node_id, (p_partkey + 1) // 10 AS parent_id, p_name || ' ' || p_partkey AS meaning
        FROM part WHERE (p_partkey + 1) % 97 <> 0),
    up AS (SELECT node_id, parent_id AS next, meaning FROM codes
        UNION ALL SELECT up.node_id, c.parent_id, c.meaning || ' | ' || up.meaning FROM up LEFT JOIN codes c ON c.node_id = up.next
        WHERE up.next <> 0)
    SELECT up.node_id, c.parent_id, up.meaning, c.meaning AS short_meaning FROM up JOIN codes c USING (node_id)
    WHERE up.next = 0 OR up.next IS NULL""",
)
def r1(t):
    node = F.col("p_partkey") + 1
    tree = t.part.filter(node % 97 != 0).select(
        node.alias("node_id"), F.expr("(p_partkey + 1) div 10").alias("parent_id"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("meaning"),
    )
    return codings.full_meanings(tree).select("node_id", "parent_id", "meaning", "short_meaning")


@query(
    "A22_unresolved_parents",
    "SELECT count(*) FILTER (WHERE p_size <> 0) AS remaining FROM part",
)
def a22(t):
    return t.part.agg(F.count_if(F.col("p_size") != 0).alias("remaining"))


@query(
    "P20_first_occurrence_fields",
    """SELECT c_custkey AS eid, '130000' AS phenocode, date_diff('day', make_date(1940 + c_nationkey, (c_custkey % 12 + 1)::INTEGER, 15),
        DATE '2001-05-05') * 86400.0::DOUBLE AS value FROM customer
    UNION ALL SELECT c_custkey, '131494', c_acctbal FROM customer""",
)
def p20(t):
    wide = t.customer.select(
        F.col("c_custkey").alias("eid"), F.lit("2001-05-05").alias("130000-0.0"),
        F.col("c_acctbal").cast("string").alias("131494-0.0"), F.lit("x").alias("13-0.0"), F.lit("x").alias("131494-1.0"),
    )
    births = registry.birth_dates(customer_births(t), "c_custkey").withColumnRenamed("c_custkey", "eid")
    return registry.first_occurrence(wide, births).entries.select("eid", "phenocode", "value")


@query(
    "date_parsing",
    """SELECT o_orderkey AS order_id, date_diff('day', DATE '1970-01-01', o_orderdate::DATE) * 86400 AS seconds FROM orders""",
)
def date_parsing(t):
    text = F.date_format("o_orderdate", "d/M/yyyy")
    return t.orders.select(F.col("o_orderkey").alias("order_id"), epoch_seconds(text, "d/M/yyyy").alias("seconds"))
