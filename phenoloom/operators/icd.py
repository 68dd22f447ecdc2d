"""Diagnosis codes: wide text columns to a person x code matrix."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.model import MatrixFrame
from phenoloom.operators.munging import any_true
from phenoloom.scale import dealt, lookup
from phenoloom.session import stage

# Data fields that hold the codes of each source.
ICD10_FIELDS = {
    "primary_codes": "41202",
    "secondary_codes": "41204",
    "external_codes": "41201",
    "cause_of_death_codes": "40001",
}
ICD9_FIELDS = {"primary_codes": "41203", "secondary_codes": "41205"}


def code_records(wide: DataFrame, icd9: bool = False, row_key: str = "userId") -> DataFrame:
    """(person, source, icd_code) of every filled code cell."""
    cells = []
    for source, field in (ICD9_FIELDS if icd9 else ICD10_FIELDS).items():
        columns = [c for c in wide.columns if c.startswith(f"x{field}")]
        cells += [
            F.struct(F.lit(source).alias("source"), wide[f"`{c}`"].cast("string").alias("icd_code")) for c in columns
        ]
    long = wide.select(row_key, F.inline(F.array(*cells)))
    return long.filter(F.col("icd_code").isNotNull())


def icd_matrix(
    records: DataFrame, row_key: str = "userId", sources: list[str] | None = None, rows: DataFrame | None = None
) -> MatrixFrame:
    """Person x code flags per source plus ``any_codes``, and code roll-up.

    Only true cells are stored; an absent cell means no flag is set. Codes of
    three or four characters also form three-character columns marked
    ``truncated`` where at least two codes meet.
    """
    sources = sources or list(ICD10_FIELDS)
    flags = [F.bool_or(F.col("source") == s).alias(s) for s in sources]
    # Staged: codes, roll-up and the cells themselves all read it.
    entries = stage(records.groupBy(row_key, "icd_code").agg(*flags)).withColumns(
        {"any_codes": F.lit(True), "truncated": F.lit(False)}
    )
    codes = entries.select("icd_code").distinct()
    short = F.substring("icd_code", 1, 3)
    rollup = (
        codes.filter(F.length("icd_code").isin(3, 4))
        .groupBy(short.alias("icd_code"))
        .count()
        .filter("count > 1")
        .select("icd_code")
    )
    # Dealt by person too: after the join by code a task would group all people of its codes.
    shortened = entries.filter(F.length("icd_code").isin(3, 4)).withColumn("icd_code", short)
    merged = (
        dealt(shortened.join(rollup, "icd_code", "left_semi"), [row_key, "icd_code"])
        .groupBy(row_key, "icd_code")
        .agg(*[any_true(F.col(s)).alias(s) for s in [*sources, "any_codes"]])
        .withColumn("truncated", F.lit(True))
    )
    key = ["icd_code", "truncated"]
    cols = codes.withColumn("truncated", F.lit(False)).unionByName(rollup.withColumn("truncated", F.lit(True)))
    if rows is None:
        rows = entries.select(row_key).distinct()
    return MatrixFrame(rows, cols, entries.unionByName(merged), [row_key], key)


def load_icd(wide: DataFrame, codings: DataFrame, icd9: bool = False, row_key: str = "userId") -> MatrixFrame:
    """``icd_matrix`` of a wide table, with code meanings on the columns."""
    fields = ICD9_FIELDS if icd9 else ICD10_FIELDS
    frame = icd_matrix(code_records(wide, icd9, row_key), row_key, list(fields), wide.select(row_key))
    meanings = codings.withColumnRenamed("coding", "icd_code")
    return frame.with_(cols=lookup(frame.cols, meanings, ["icd_code"]))


def prefer_truncated(frame: MatrixFrame) -> MatrixFrame:
    """Three-character codes only; the truncated column where both kinds exist."""
    cols = frame.cols.filter(F.length("icd_code") == 3)
    best = cols.groupBy("icd_code").agg(F.max("truncated").alias("truncated"))
    key = ["icd_code", "truncated"]
    return frame.with_(
        cols=cols.join(best, key, "left_semi"), entries=frame.entries.join(best, key, "left_semi")
    )
