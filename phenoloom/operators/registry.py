"""Prescriptions, dates of first occurrence, activity monitors and COVID-19."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.functions.dates import DAY, epoch_seconds, first_occurrence_seconds
from phenoloom.model import PHENO_KEY, MatrixFrame, pheno_key
from phenoloom.operators.munging import any_true
from phenoloom.operators.reshape import select_fields, unpivot
from phenoloom.scale import lookup, number_rows

# Recruitment centres in England.
ENGLAND_CENTERS = [
    10003, 11001, 11002, 11006, 11007, 11008, 11009, 11010, 11011, 11012, 11013, 11014,
    11016, 11017, 11018, 11020, 11021, 11024, 11025, 11026, 11027, 11028,
]

# COVID-19 analyses and what they compare.
COVID_ANALYSES = {
    "A2_v2": "Death vs survival (controls include everyone else)",
    "B1_v2": "Hospitalized vs non-hospitalized (among COVID-19 positive)",
    "B1_v2_origin": 'Hospitalized vs non-hospitalized (among COVID-19 positive; old definition using "origin" field)',
    "C2_v2": "COVID-19 positive (controls include untested)",
    "C2_v2_england_controls": "COVID-19 positive (controls include untested), only patients from centers in England",
    "C1_v2": "COVID-19 positive (controls only COVID-19 negative)",
    "B2_v2": "Hospitalized vs non-hospitalized (controls include untested)",
    "B2_v2_origin": 'Hospitalized vs non-hospitalized (controls include untested; old definition using "origin" field)',
}


def prescription_records(prescriptions: DataFrame, mapping: DataFrame) -> DataFrame:
    """Prescriptions with generic name and category, numbered by issue date.

    Stays long: one record per prescription with its position ``record`` within
    (eid, generic, category), dates ascending and missing dates last.
    """
    named = lookup(
        prescriptions.withColumn("issue_date", epoch_seconds(F.col("issue_date"), "d/M/yyyy")),
        mapping.withColumnRenamed("Original_Prescription", "drug_name"),
        ["drug_name"],
    ).filter(F.col("Generic_Name") != "")
    return order_records(named, ["eid", "Generic_Name", "Drug_Category_and_Indication"], "issue_date")


def order_records(df: DataFrame, keys: Sequence[str], date: str, name: str = "record") -> DataFrame:
    """Number records within ``keys`` by date, missing dates last."""
    rest = [c for c in df.columns if c not in keys and c != date]
    undated = df.withColumn("_undated", F.col(date).isNull())
    return number_rows(undated, keys, ["_undated", date, *rest], name).drop("_undated")


def prescription_matrix(records: DataFrame) -> MatrixFrame:
    """Person x generic drug, with the number of records and the date span."""
    key = ["Generic_Name", "Drug_Category_and_Indication"]
    entries = records.groupBy("eid", *key).agg(
        F.count("*").alias("n_records"),
        F.min("issue_date").alias("first_date"),
        F.max("issue_date").alias("last_date"),
    )
    return MatrixFrame(records.select("eid").distinct(), records.select(*key).distinct(), entries, ["eid"], key)


def birth_dates(
    df: DataFrame,
    key: str = "userId",
    year: str = "x34_0_0",
    month: str = "x52_0_0",
    center: str = "x54_0_0",
) -> DataFrame:
    """Date of birth (the 15th of the month), its parts and recruitment centre."""
    raw_month = df[f"`{month}`"].cast("string")
    padded = F.when(F.length(raw_month) == 1, F.concat(F.lit("0"), raw_month)).otherwise(raw_month)
    text_year = df[f"`{year}`"].cast("string")
    return df.select(
        F.col(key).cast("int").alias(key),
        epoch_seconds(F.concat(text_year, padded, F.lit("15")), "yyyyMMdd").alias("date_of_birth"),
        padded.alias("month_of_birth"),
        text_year.alias("year_of_birth"),
        df[f"`{center}`"].cast("int").alias("recruitment_center"),
    )


def is_first_occurrence_field(name: str, _type: T.DataType | None = None) -> bool:
    return name.startswith("13") and len(name) == 10 and name.endswith("-0.0")


def first_occurrence(wide: DataFrame, births: DataFrame, dictionary: DataFrame | None = None) -> MatrixFrame:
    """Seconds from birth to first occurrence per person and diagnosis field."""
    born = ["date_of_birth", "month_of_birth"]
    # People meet their birth dates once, before their fields become rows.
    dated = lookup(wide.drop(*born), births.select("eid", *born), ["eid"])
    frame = select_fields(dated, ["eid", *born], is_first_occurrence_field, "string", dictionary=dictionary)
    value = first_occurrence_seconds(F.col("value"), F.col("date_of_birth"), F.col("month_of_birth"))
    key = pheno_key("icd_first_occurrence", F.col("phenocode"))
    rest = [c for c in frame.cols.columns if c != "phenocode"]
    return MatrixFrame(
        wide.select("eid"),
        frame.cols.select(*key, *rest),
        frame.entries.select("eid", *key, value.alias("value")),
        ["eid"],
        PHENO_KEY,
    )


QUALITY_MISSING = "90002-0.0"
QUALITY_ONE = ["90015-0.0", "90016-0.0", "90017-0.0"]


def high_quality(df: DataFrame) -> Column:
    """No problem code, and all three quality fields equal to one."""
    ones = [df[f"`{c}`"] == 1 for c in QUALITY_ONE]
    return df[f"`{QUALITY_MISSING}`"].isNull() & ones[0] & ones[1] & ones[2]


def activity_monitor(wide: DataFrame, dictionary: DataFrame, strict: bool = False) -> MatrixFrame:
    """Continuous activity fields; values only where the quality flag is known
    (``strict``: where it is true)."""
    quality = high_quality(wide)
    kept = quality if strict else quality.isNotNull()

    def criteria(name, kind):
        return name.startswith("90") and name.endswith("-0.0") and isinstance(kind, (T.IntegerType, T.DoubleType))

    masked = wide.select("eid", *[wide[f"`{f.name}`"] for f in wide.schema if criteria(f.name, f.dataType)], kept.alias("_kept"))
    names = [c for c in masked.columns if c not in ("eid", "_kept")]
    frame = select_fields(wide, ["eid"], criteria, dictionary=dictionary)
    cols = frame.cols.filter("ValueType = 'Continuous'")
    long = unpivot(masked, ["eid", "_kept"], names, "double")
    codes = F.element_at(F.array(*[F.lit(n.split("-")[0]) for n in names]), F.col("position") + 1)
    entries = (
        long.select("eid", codes.alias("phenocode"), F.when(F.col("_kept"), F.col("value")).alias("value"))
        .join(cols.select("phenocode"), "phenocode", "left_semi")
    )
    key = pheno_key("continuous", F.col("phenocode"))
    rest = [c for c in cols.columns if c != "phenocode"]
    return MatrixFrame(frame.rows, cols.select(*key, *rest), entries.select("eid", *key, "value"), ["eid"], PHENO_KEY)


def any_within(
    starts: DataFrame, outcomes: DataFrame, keys: Sequence[str], start: str, outcome: str, window: int | None
) -> DataFrame:
    """Per key: does any outcome fall in [start, start + window) of any start?

    Times are cut into buckets one window wide and reduced to their extremes, so
    no start ever meets an outcome row by row: within a bucket some pair fits if
    the earliest start is no later than the latest outcome; across neighbouring
    buckets if the earliest outcome is less than a window after the latest start.
    Keys with only one side give false; ``window=None`` means no upper bound.
    """
    nothing = F.lit(None).cast("long")
    if window is None:
        bucket = lambda c: F.lit(0).cast("long")
    else:
        bucket = lambda c: F.expr(f"({c} - pmod({c}, {window})) div {window}")

    def piece(df, name, offset, **fields):
        columns = {f: nothing for f in ("s", "p", "o")} | fields
        return df.select(
            *keys, (bucket(name) + offset).alias("_bucket"), *[c.cast("long").alias(f) for f, c in columns.items()]
        )

    parts = [
        piece(starts, start, 0, s=F.col(start)),
        piece(outcomes, outcome, 0, o=F.col(outcome)),
    ]
    if window is not None:
        parts.append(piece(starts, start, 1, p=F.col(start)))
    merged = reduce(DataFrame.unionByName, parts)
    per_bucket = merged.groupBy(*keys, "_bucket").agg(
        F.min("s").alias("first_start"),
        F.max("p").alias("earlier_start"),
        F.min("o").alias("first_outcome"),
        F.max("o").alias("last_outcome"),
    )
    inside = F.col("first_start") <= F.col("last_outcome")
    if window is not None:
        inside = inside | (F.col("first_outcome") < F.col("earlier_start") + window)
    return per_bucket.groupBy(*keys).agg(any_true(inside).alias("within"))


def covid_status(
    tests: DataFrame, hes_main: DataFrame, hes_diag: DataFrame, deaths: DataFrame, window_days: int | None = 30
) -> DataFrame:
    """One row per person seen in any source: test, inpatient and death flags.

    Hospital and death follow a recorded diagnosis by less than ``window_days``
    (``None``: by any time). Flags of sources a person is absent from are NULL.
    """
    window = None if window_days is None else window_days * DAY
    visit = ["eid", "ins_index"]
    visits = hes_main.select(
        *visit,
        epoch_seconds(F.coalesce("epistart", "admidate"), "d/M/yyyy").alias("diag_date"),
        epoch_seconds(F.col("admidate"), "d/M/yyyy").alias("admi_date"),
    ).join(
        hes_diag.groupBy(*visit).agg(any_true(F.col("diag_icd10") == "U071").alias("covid")), visit
    )
    admitted = visits.select("eid", "admi_date").distinct()
    diagnosed = visits.filter("covid").select("eid", F.col("diag_date").alias("covid_diag_date")).distinct()
    died = deaths.select("eid", epoch_seconds(F.col("date_of_death"), "d/M/yyyy").alias("death_date")).distinct()
    inpatient = any_within(diagnosed, admitted, ["eid"], "covid_diag_date", "admi_date", window)
    dead = any_within(diagnosed, died, ["eid"], "covid_diag_date", "death_date", window)
    register = (
        inpatient.withColumnRenamed("within", "inpatient2")
        .join(dead.withColumnRenamed("within", "death"), "eid", "full_outer")
        .join(diagnosed.select("eid").distinct().withColumn("_pcr", F.lit(True)), "eid", "left")
        .select(
            "eid",
            *[F.coalesce(c, F.lit(False)).alias(n) for c, n in
              ((F.col("inpatient2"), "inpatient2"), (F.col("death"), "death"), (F.col("_pcr"), "pcr_result"))],
        )
    )
    tested = tests.groupBy("eid").agg(
        any_true(F.col("origin") == 1).alias("origin"),
        any_true(F.col("result") == 1).alias("result1"),
        any_true(F.col("reqorg") == 1).alias("inpatient1"),
    )
    return tested.join(register, "eid", "full_outer").withColumns(
        {
            "inpatient": F.col("inpatient1") | F.col("inpatient2"),
            "result": F.col("result1") | F.col("pcr_result"),
        }
    )


def covid_analyses(centers: Sequence[int] = ENGLAND_CENTERS) -> dict[str, Column]:
    """The analyses over status columns and ``recruitment_center``."""
    no = F.lit(False)
    result, death, origin, inpatient = (F.col(c) for c in ("result", "death", "origin", "inpatient"))
    positive = F.coalesce(result, no)
    return {
        "A2_v2": F.coalesce(death, no),
        "B1_v2": F.when(result, inpatient),
        "B1_v2_origin": F.when(result, origin),
        "C2_v2": positive,
        "C2_v2_england_controls": F.when(F.col("recruitment_center").isin(list(centers)), positive),
        "C1_v2": result,
        "B2_v2": F.coalesce(result & inpatient, no),
        "B2_v2_origin": F.coalesce(result & origin, no),
    }


def covid_matrix(samples: DataFrame, status: DataFrame, wave: str = "01") -> MatrixFrame:
    """Person x analysis matrix with case and control counts."""
    analyses = covid_analyses()
    flags = lookup(samples, status, ["eid"], unique=True).select(
        "eid", *[c.alias(name) for name, c in analyses.items()]
    )
    frame = select_fields(flags, ["eid"], lambda name, kind: True, "double", rename=lambda name: name)
    key = pheno_key("categorical", "COVID19", coding=F.col("phenocode"), modifier=wave)
    names = F.create_map(*[F.lit(x) for pair in COVID_ANALYSES.items() for x in pair])
    cols = frame.cols.select(*key, names[F.col("phenocode")].alias("description"))
    entries = frame.entries.select("eid", *key, "value")
    counts = entries.groupBy(*PHENO_KEY).agg(
        F.count_if(F.col("value") == 1.0).alias("n_cases"), F.count_if(F.col("value") == 0.0).alias("n_controls")
    )
    return MatrixFrame(frame.rows, cols.join(counts, PHENO_KEY, "left"), entries, ["eid"], PHENO_KEY)
