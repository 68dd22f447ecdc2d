"""One analysis matrix out of many phenotype sources.

Every source is brought to the five-part column key, one value per sex and a
common set of counts and descriptions; the sources are then set side by side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenoloom.model import PHENO_DESCRIPTION, PHENO_KEY, SEXES, MatrixFrame, pheno_key
from phenoloom.operators.defaults import FOR, GROUPS, VALUE, dense_cells, with_default
from phenoloom.operators.icd import prefer_truncated
from phenoloom.operators.munging import case_counts
from phenoloom.operators.reshape import densify, fill_cols, sex_values, union_cols
from phenoloom.scale import lookup, one_per_key
from phenoloom.session import stage

# Fixed value: description of simulated phenotypes.
RANDOM_DESCRIPTION = "Random pheno with GRM covariance structure"

ROW = "userId"
COUNTS = ["n_cases_defined", "n_cases_both_sexes", "n_cases_females", "n_cases_males"]


def _assemble(
    frame: MatrixFrame,
    covariates: DataFrame,
    key: list[Column],
    texts: dict[str, Column],
    values: list[Column],
    counts: list[Column],
) -> MatrixFrame:
    """Common shape: ``values`` and ``counts`` see the source's entry fields,
    its column fields that are part of the key, and the covariates."""
    col_key = list(frame.col_key)
    source = frame.entries.withColumnRenamed(frame.row_key[0], ROW)
    # Staged once per source: counts and values are two passes over it.
    with_sex = stage(lookup(source, covariates, [ROW], unique=True))
    counted = with_sex.groupBy(*col_key).agg(*counts)
    names = [c for c in counted.columns if c not in col_key]
    joined = frame.cols.join(counted, col_key, "left").fillna(0, names)
    described = [F.lit(None).cast("string").alias(n) if n not in texts else texts[n].cast("string").alias(n)
                 for n in PHENO_DESCRIPTION]
    missing = [F.lit(None).cast("long").alias(n) if n not in names else F.col(n) for n in COUNTS]
    cols = joined.select(*key, *missing, *described)
    entries = with_sex.select(ROW, *key, *values)
    rows = lookup(frame.rows.select(F.col(frame.row_key[0]).alias(ROW)), covariates, [ROW], unique=True)
    return MatrixFrame(rows, cols, entries, [ROW], PHENO_KEY)


def _per_sex(case: Callable[[Column], Column]) -> list[Column]:
    return [F.count_if(case(F.col(s))).alias(f"n_cases_{s}") for s in SEXES]


def _defined_by_sex(value: Column) -> list[Column]:
    have, sex = value.isNotNull(), F.col("sex")
    return [
        F.count_if(have).alias("n_cases_both_sexes"),
        F.count_if(have & (sex == 0)).alias("n_cases_females"),
        F.count_if(have & (sex == 1)).alias("n_cases_males"),
    ]


def _coalesced(field: str) -> Column:
    return F.coalesce(*[F.col(f"{s}_pheno.{field}") for s in SEXES])


def _five_part(frame: MatrixFrame) -> list[Column]:
    return [F.col(k) for k in PHENO_KEY]


def _custom(frame, covariates, name, legacy):
    value, sex = F.col("value").cast("double"), F.col("sex")
    case = F.when(F.col("trait_type") == "categorical", value == 1.0).otherwise(value.isNotNull())
    counts = case_counts(case, sex)[1 if legacy else 0 :]
    texts = {n: F.col(n) for n in PHENO_DESCRIPTION if n in frame.cols.columns}
    return _assemble(frame, covariates, _five_part(frame), texts, sex_values(value, sex), counts)


def _random(frame, covariates, name, legacy):
    part = F.split("col_id", "_")
    kind = F.when(part[2] == "continuous", "continuous").otherwise("categorical")
    key = pheno_key(
        kind, F.concat(F.lit("random_"), part[2]), coding=part[3],
        modifier=F.when(part[1] == "1", "").otherwise(part[1]),
    )
    x, sex = F.col("x"), F.col("sex")
    case = F.when(kind == "categorical", x != 0).otherwise(x.isNotNull())
    texts = {"description": F.lit(RANDOM_DESCRIPTION)}
    return _assemble(frame, covariates, key, texts, sex_values(x, sex), case_counts(case, sex))


def _showcase(frame, covariates, name, legacy):
    categorical = name == "categorical"

    def case(value):
        return value.cast("boolean") if categorical else value.isNotNull()

    if "pheno" in frame.col_key:
        coding = F.col("coding")
        key = pheno_key(name, F.col("pheno").cast("string"), coding=coding if categorical else "",
                        modifier="" if categorical else coding)
    else:
        key = _five_part(frame)
    counts = _per_sex(case) if legacy else case_counts(case(F.col("both_sexes")), F.col("sex"))
    texts = {"description": _coalesced("Field"), "description_more": _coalesced("Notes"),
             "category": _coalesced("Path")}
    if categorical:
        texts["coding_description"] = _coalesced("meaning")
    return _assemble(frame, covariates, key, texts, [F.col(s).cast("double").alias(s) for s in SEXES], counts)


def _icd(frame, covariates, name, legacy, truncated_codes_only=True, store_false=True, implicit=False):
    if truncated_codes_only:
        frame = prefer_truncated(frame)
    has_version = "icd_version" in frame.cols.columns
    version = F.col("icd_version") if has_version else F.lit("" if legacy else "icd10")
    if has_version and "icd_version" not in frame.col_key:
        versions = frame.cols.select(*frame.col_key, "icd_version")
        frame = frame.with_(entries=frame.entries.join(versions, list(frame.col_key)))
    key = pheno_key(version, F.col("icd_code"))
    texts = {"description": F.col("short_meaning"), "category": F.col("meaning")}
    if "truncated" in frame.cols.columns:
        texts["description_more"] = F.concat(F.lit("truncated: "), F.col("truncated").cast("string"))
    sex, case = F.col("sex"), F.col("any_codes")
    full = _assemble(frame, covariates, key, texts, sex_values(case, sex), case_counts(case, sex))
    if implicit:
        return with_default(full, 0.0, name)
    if not store_false:
        return full
    # Parts of the key that all codes share stay literals: cells carry less, and a filter on them makes no cell.
    own = ["trait_type", "phenocode"] if has_version else ["phenocode"]
    known = MatrixFrame(full.rows, full.cols.select(*own), full.entries.select(ROW, *own, "both_sexes"), [ROW], own)
    dense = densify(known, {"both_sexes": 0.0}, row_fields=["sex"]).entries
    names = [F.col(k) if k in own else shared for k, shared in zip(PHENO_KEY, key)]
    return full.with_(entries=dense.select(ROW, *names, *sex_values(F.col("both_sexes"), sex)))


def _first_occurrence(frame, covariates, name, legacy):
    sex, happened = F.col("sex"), F.col("value").isNotNull()
    texts = {"description": F.col("Field"), "description_more": F.col("Notes"), "category": F.col("Path")}
    return _assemble(frame, covariates, _five_part(frame), texts, sex_values(happened, sex), case_counts(happened, sex))


def _phecode(frame, covariates, name, legacy):
    key = pheno_key("phecode", F.col("phecode"), F.col("phecode_sex"))
    sex, case = F.col("sex"), F.col("case_control")
    texts = {"description": F.col("phecode_description"), "category": F.col("phecode_group")}
    return _assemble(frame, covariates, key, texts, sex_values(case, sex), case_counts(case, sex))


def prescription_name(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit(","), F.lit("|")), F.lit("/"), F.lit("_"))


def _prescriptions(frame, covariates, name, legacy):
    """Drug-level columns and, beside them, category-level ones."""
    sex, taken = F.col("sex"), F.col("n_records") > 0

    def level(source, field, category):
        key = pheno_key("prescriptions", prescription_name(F.col(field)))
        return _assemble(source, covariates, key, {"category": category}, sex_values(taken, sex),
                         case_counts(taken, sex))

    group = "Drug_Category_and_Indication"
    person = frame.row_key[0]
    by_category = MatrixFrame(
        frame.rows, frame.cols.select(group).distinct(),
        frame.entries.groupBy(person, group).agg(F.sum("n_records").alias("n_records")), [person], [group],
    )
    return union_cols([
        level(frame, "Generic_Name", F.col(group)),
        level(by_category, group, F.lit(None)),
    ])


def _additional(frame, covariates, name, legacy):
    key = pheno_key("continuous", F.col("pheno"), modifier=F.col("coding"))
    texts = {"description": _coalesced("meaning"), "description_more": _coalesced("description")}
    values = [F.col(s) for s in SEXES]
    return _assemble(frame, covariates, key, texts, values, _per_sex(lambda v: v.isNotNull()))


def _measured(frame, covariates, name, legacy):
    """Biomarkers, activity monitor and other plain measurements."""
    trait = F.col("trait_type") if "trait_type" in frame.col_key else F.lit(name)
    code = "pheno" if "pheno" in frame.col_key else "phenocode"
    key = pheno_key(trait, F.col(code).cast("string"))
    texts = {"description": F.col("Field"), "category": F.col("Path")}
    value, sex = F.col("value"), F.col("sex")
    return _assemble(frame, covariates, key, texts, sex_values(value, sex), _defined_by_sex(value))


NORMALISERS = {
    "custom": _custom,
    "random": _random,
    "categorical": _showcase,
    "continuous": _showcase,
    "icd_first_occurrence": _first_occurrence,
    "phecode": _phecode,
    "prescriptions": _prescriptions,
    "additional": _additional,
}


def combine_sources(
    sources: dict[str, MatrixFrame],
    covariates: DataFrame,
    truncated_codes_only: bool = True,
    legacy: bool = False,
    store_false: bool = True,
    implicit: bool = False,
) -> MatrixFrame:
    """Side by side matrix of all sources.

    ``covariates`` is keyed by userId and holds ``sex`` (0 female, 1 male). Rows
    are those of any source (``legacy``: of the first). People without any
    prescription get 0 in prescription columns.

    With ``implicit`` no zero is stored: absent cells of diagnosis codes count as
    0 for the rows of their source, those of prescriptions for all (see
    ``defaults``). Otherwise both are made, a record for every person and column;
    ``store_false=False`` just leaves out the false cells of diagnosis codes.
    """
    # Staged: the rows and the cells of every source look it up.
    unique = stage(one_per_key(covariates, [ROW]))
    parts = []
    for name, frame in sources.items():
        if "icd_code" in frame.col_key:
            part = _icd(frame, unique, name, legacy, truncated_codes_only, store_false, implicit)
        else:
            part = NORMALISERS.get(name, _measured)(frame, unique, name, legacy)
        if implicit and name == "prescriptions":
            zeros = {s: F.coalesce(s, F.lit(0.0)) for s in SEXES}
            part = with_default(part.with_(entries=part.entries.withColumns(zeros)), 0.0)
        parts.append(part)
    full = union_cols(parts, "left" if legacy else "outer")
    if "prescriptions" in sources and not implicit:
        full = fill_cols(full, F.col("trait_type") == "prescriptions", 0.0)
    return full


def _simple(name: str, frame: MatrixFrame) -> MatrixFrame:
    person = frame.row_key[0]
    entries, cols = frame.entries, frame.cols
    if "pheno" in frame.col_key:
        value = F.col("value")
        case = value.cast("boolean") if name == "categorical" else value.isNotNull()
        key = {"pheno": F.col("pheno").cast("string"), "coding": F.col("coding")}
    elif "icd_code" in frame.col_key:
        frame = frame.filter_cols("truncated")
        entries = frame.entries
        if "icd_version" not in frame.col_key:
            entries = entries.join(frame.cols.select(*frame.col_key, "icd_version"), list(frame.col_key))
        value = case = F.col("any_codes")
        key = {"pheno": F.col("icd_code"), "coding": F.col("icd_version")}
    elif "phecode" in frame.col_key:
        value = case = F.col("case_control")
        key = {"pheno": F.col("phecode"), "coding": F.col("phecode_sex")}
    elif "Generic_Name" in frame.col_key:
        group = "Drug_Category_and_Indication"
        drugs = entries.select(person, F.col("Generic_Name").alias("pheno"), F.col(group).alias("coding"), "n_records")
        groups = entries.groupBy(person, group).agg(F.sum("n_records").alias("n_records"))
        entries = drugs.unionByName(
            groups.select(person, F.col(group).alias("pheno"), F.col(group).alias("coding"), "n_records")
        )
        value = case = F.col("n_records") > 0
        key = {"pheno": F.col("pheno"), "coding": F.col("coding")}
    else:
        raise ValueError(f"source {name!r} has none of the known column keys")
    cells = entries.select(
        F.col(person).alias(ROW), *[c.alias(k) for k, c in key.items()],
        F.lit(name).alias("data_type"), value.cast("double").alias("value"), case.alias("_case"),
    )
    counted = cells.groupBy(*key, "data_type").agg(
        F.count_if("_case").alias("n_cases"), F.count("value").alias("n_defined"), F.count("*").alias("_stored")
    )
    rows = frame.rows.select(F.col(person).alias(ROW))
    names = [*key, "data_type"]
    if "icd_code" not in frame.col_key:
        return MatrixFrame(rows, counted.drop("_stored"), cells.drop("_case"), [ROW], names)
    # A person without the code does not have it: a false cell, in every column.
    total = rows.distinct().agg(F.count("*").alias("_people"))
    cols = frame.cols.select(*[c.alias(k) for k, c in key.items()]).distinct().withColumn("data_type", F.lit(name))
    cols = cols.join(counted, names, "left").fillna(0, ["n_cases", "n_defined", "_stored"])
    cols = cols.withColumn("n_defined", F.col("n_defined") + total.scalar() - F.col("_stored")).drop("_stored")
    return with_default(MatrixFrame(rows, cols, cells.drop("_case"), [ROW], names), 0.0, name)


def combine_sources_simple(sources: dict[str, MatrixFrame], implicit: bool = False) -> MatrixFrame:
    """Older combination without sexes: value, n_cases and n_defined.

    Only rows that all sources share are kept, except that prescriptions add
    their own rows and get 0 where a person has none. Absent cells of diagnosis
    codes count as 0 for the people of their source, which ``n_defined`` counts;
    with ``implicit`` none of the zeros is stored (see ``defaults``).
    """
    full = None
    for name, frame in sources.items():
        part = _simple(name, frame)
        if implicit and name == "prescriptions":
            part = with_default(part, 0.0)
        how = "outer" if name == "prescriptions" else "inner"
        full = part if full is None else union_cols([full, part], how)
    if not implicit:
        defaults = VALUE in full.cols.columns
        if defaults:  # the false cells of diagnosis codes, for the rows of their source
            having = full.with_(cols=full.cols.filter(F.col(VALUE).isNotNull()))
            codes = full.col_key
            having = having.with_(entries=full.entries.join(having.cols.select(*codes), list(codes), "left_semi"))
            others = full.entries.join(having.cols.select(*codes), list(codes), "left_anti")
            full = full.with_(
                rows=full.rows.drop(GROUPS), cols=full.cols.drop(VALUE, FOR),
                entries=others.unionByName(dense_cells(having, ["value"]).select(*others.columns)),
            )
        if "prescriptions" in sources:
            full = fill_cols(full, F.col("data_type") == "prescriptions", 0.0)
    return full
