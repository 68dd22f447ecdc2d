"""Genotype slices, probabilities and imputation over long entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from phenoloom.functions.genome import diploid, genotype_probabilities, is_non_ref, variant_id
from phenoloom.operators.variants import within_intervals

VARIANT = ["contig", "pos", "alleles"]


def slice_genotypes(
    entries: DataFrame,
    intervals: DataFrame | None = None,
    adjusted_only: bool = True,
    dosages: bool = False,
    min_call_rate: float = 0.0,
    bin_width: int = 100_000,
) -> DataFrame:
    """Entries of the variants to export, with ``rsid``.

    Keeps high-quality entries, the intervals, variants with a non-reference
    call (unless ``dosages``) and with a call rate, over the entries left, of at
    least ``min_call_rate``.
    """
    kept = entries.filter("adj") if adjusted_only else entries
    if intervals is not None:
        kept = within_intervals(kept, intervals, bin_width=bin_width)
    tests = []
    if not dosages:
        tests.append(F.count_if(is_non_ref(F.col("GT"))) > 0)
    if min_call_rate:
        tests.append(F.count("GT") / F.count("*") >= min_call_rate)
    if tests:
        summary = kept.groupBy(*VARIANT).agg(*[t.alias(f"t{i}") for i, t in enumerate(tests)])
        passing = summary.filter(" AND ".join(f"t{i}" for i in range(len(tests)))).select(*VARIANT)
        kept = kept.join(passing, VARIANT, "left_semi")
    return kept.withColumn("rsid", variant_id(F.col("contig"), F.col("pos"), F.col("alleles")))


def add_probabilities(entries: DataFrame, name: str = "GP") -> DataFrame:
    """Genotype probabilities of the calls, haploid calls taken as homozygous."""
    return entries.withColumn(name, genotype_probabilities(diploid(F.col("GT")), F.size("alleles")))


def impute_probabilities(
    entries: DataFrame, name: str = "GP", mean_impute: bool = True, key: Sequence[str] = tuple(VARIANT)
) -> DataFrame:
    """Fill missing probabilities with the variant's mean, or with hom-ref.

    The mean is taken element by element, as partial sums per variant; a missing
    element counts for none. One pass finds how many elements there are at most
    (the genotype classes of the variant with most alleles); then entries and
    means share one exchange by variant, and none if the entries come in that
    way. The entries of a hot variant are its cohort, each once.
    """
    if not mean_impute:
        return entries.withColumn(name, F.coalesce(name, F.array(F.lit(1.0), F.lit(0.0), F.lit(0.0))))
    width = entries.agg(F.max(F.size(name))).first()[0]
    if not width:  # nothing to take a mean of
        return entries
    dealt = entries.repartition(*key)
    classes = [F.avg(F.get(name, F.lit(i))).alias(f"_{i}") for i in range(width)]
    means = dealt.groupBy(*key).agg(F.max(F.size(name)).alias("_n"), *classes)
    means = means.select(*key, F.when(F.col("_n") >= 0, F.slice(F.array(*[F.col(f"_{i}") for i in range(width)]), 1, F.col("_n"))).alias("_means"))
    filled = dealt.join(means, list(key), "left")
    return filled.withColumn(name, F.coalesce(F.col(name), F.col("_means"))).drop("_means")
