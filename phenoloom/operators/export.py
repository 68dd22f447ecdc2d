"""Which values of which phenotype to export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenoloom.functions.keys import model_family
from phenoloom.model import PHENO_KEY, SEXES, MatrixFrame
from phenoloom.operators.defaults import VALUE, dense_cells

KEY_WITHOUT_SEX = [k for k in PHENO_KEY if k != "pheno_sex"]


def export_values(
    frame: MatrixFrame,
    requests: DataFrame,
    proportion_single_sex: float = 0.0,
    binary: Column | None = None,
) -> DataFrame:
    """Values of every requested phenotype, each row tagged with its request.

    ``requests`` holds five-part keys; its pheno_sex is the sex asked for. The
    column of that pheno_sex is used if exactly one exists, else the both_sexes
    one. The value is the entry field of the sex asked for, a whole number for
    binary traits. With a proportion p, phenotypes with at most p female cases
    keep males only and those with at least 1 - p females only.
    ``frame.rows`` holds ``sex``; ``frame.cols`` the case counts per sex. Absent
    cells of columns with a default are written with it (see ``defaults``).
    """
    binary = model_family(F.col("trait_type")) == "binary" if binary is None else binary
    wanted = requests.select(*KEY_WITHOUT_SEX, F.col("pheno_sex").alias("asked")).distinct()
    counts = ["n_cases_females", "n_cases_males"]
    cols = frame.cols.select(*PHENO_KEY, *counts).join(wanted, KEY_WITHOUT_SEX)
    exact = cols.groupBy(*KEY_WITHOUT_SEX, "asked").agg(
        F.count_if(F.col("pheno_sex") == F.col("asked")).alias("_n")
    )
    use = F.when(F.col("_n") == 1, F.col("asked")).otherwise("both_sexes")
    total = F.col("n_cases_females") + F.col("n_cases_males")
    chosen = (
        cols.join(exact, [*KEY_WITHOUT_SEX, "asked"])
        .filter(F.col("pheno_sex") == use)
        .withColumn("_female", F.col("n_cases_females") / F.nullif(total, F.lit(0)))
        .select(*PHENO_KEY, "asked", "_female")
    )
    value = F.coalesce(*[F.when(F.col("asked") == s, F.col(s)) for s in SEXES])
    entries = frame.entries
    if VALUE in frame.cols.columns:
        # The columns asked for are written with a record per row, so their defaults are made here.
        filled = frame.cols.filter(F.col(VALUE).isNotNull()).join(chosen.select(*PHENO_KEY).distinct(), PHENO_KEY, "left_semi")
        stored = entries.join(filled.select(*PHENO_KEY), PHENO_KEY, "left_semi")
        made = dense_cells(frame.with_(cols=filled, entries=stored), SEXES)
        rest = entries.join(filled.select(*PHENO_KEY), PHENO_KEY, "left_anti")
        entries = rest.select(*made.columns).unionByName(made)
    joined = (
        entries.join(chosen, PHENO_KEY)
        .join(frame.rows.select(*frame.row_key, "sex"), list(frame.row_key), "left")
        .withColumn("value", F.when(binary, F.floor(value).cast("double")).otherwise(value))
    )
    if proportion_single_sex > 0:
        mostly_male = F.coalesce(F.col("_female") <= proportion_single_sex, F.lit(False))
        mostly_female = F.coalesce(F.col("_female") >= 1 - proportion_single_sex, F.lit(False))
        joined = joined.filter(
            F.when(mostly_male, F.col("sex") == 1).when(mostly_female, F.col("sex") == 0).otherwise(True)
        )
    return joined.select(*frame.row_key, *PHENO_KEY, "asked", "value")
