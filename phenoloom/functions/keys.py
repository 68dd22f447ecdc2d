"""Phenotype keys: file names, result paths and the older three-part form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenoloom.model import PHENO_KEY


def path_safe(text: Column) -> Column:
    return F.replace(text, F.lit("/"), F.lit("_"))


def joined_key(df: DataFrame, safe_phenocode: bool = False, delimiter: str = "-") -> Column:
    """The key parts ``df`` has, in canonical order, joined."""
    parts = [
        path_safe(F.col(k)) if k == "phenocode" and safe_phenocode else F.col(k)
        for k in PHENO_KEY
        if k in df.columns
    ]
    return F.concat_ws(delimiter, *parts)


def results_prefix(df: DataFrame, directory: Column, chromosome: Column, start: Column, legacy: bool = False) -> Column:
    """``<directory>/result_<key>_<chromosome>_<start padded to nine digits>``."""
    name = path_safe(F.col("phenocode")) if legacy else joined_key(df, safe_phenocode=True)
    digits = start.cast("string")
    padded = F.when(F.length(digits) < 9, F.lpad(digits, 9, "0")).otherwise(digits)
    return F.concat(directory, F.lit("/result_"), name, F.lit("_"), chromosome, F.lit("_"), padded)


def pheno_output_path(directory: Column, extension: str = ".tsv", legacy: bool = False) -> Column:
    """Path of one phenotype's export."""
    if legacy:
        suffix = F.col("coding")
    else:
        suffix = F.concat_ws("-", F.col("pheno_sex"), F.col("coding"), F.col("modifier"))
    stem = F.concat_ws("-", F.col("trait_type"), path_safe(F.col("phenocode")), suffix)
    return F.concat(directory, F.lit("/"), stem, F.lit(extension))


def to_legacy_keys(df: DataFrame) -> DataFrame:
    """Five-part keys to (trait_type, phenocode, coding); other columns stay."""
    trait, code, coding = F.col("trait_type"), F.col("phenocode"), F.col("coding")
    recoded = (
        F.when(trait == "icd10", "icd10")
        .when(trait == "phecode", F.col("pheno_sex"))
        .when(trait == "biomarkers", code)
        .when(code == "whr", "whr")
        .when(coding != "", coding)
        .otherwise(F.col("modifier"))
    )
    return df.withColumns(
        {"coding": recoded, "trait_type": F.when(trait == "icd10", "icd_all").otherwise(trait)}
    ).drop("pheno_sex", "modifier")


def from_legacy_keys(df: DataFrame) -> DataFrame:
    """(trait_type, phenocode, coding) to five-part keys; other columns stay."""
    trait, code, coding = F.col("trait_type"), F.col("phenocode"), F.col("coding")
    continuous = trait == "continuous"
    return df.withColumns(
        {
            "trait_type": F.when(trait == "icd_all", "icd10").otherwise(trait),
            "pheno_sex": F.when(trait == "phecode", coding).otherwise("both_sexes"),
            "coding": F.when(trait == "categorical", coding).otherwise(""),
            "modifier": F.when(continuous & (code == "whr"), "irnt").when(continuous, coding).otherwise(""),
        }
    )


# Model family per trait type.
QUANTITATIVE_TRAITS = ["continuous", "biomarkers"]
BINARY_TRAITS = ["categorical", "icd", "icd10", "icd_first_occurrence", "icd_all", "phecode", "prescriptions"]


def model_family(trait_type: Column) -> Column:
    """'quantitative' or 'binary'; NULL for an unknown trait type."""
    return F.when(trait_type.isin(QUANTITATIVE_TRAITS), "quantitative").when(
        trait_type.isin(BINARY_TRAITS), "binary"
    )
