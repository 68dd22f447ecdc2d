"""Summaries of a table of batch jobs: name, state, cost, attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _by_attributes(jobs: DataFrame, attributes: Sequence[str], name: str | None) -> DataFrame:
    if name is not None:
        jobs = jobs.filter(F.try_element_at("attributes", F.lit("name")) == name)
    values = [F.coalesce(F.try_element_at("attributes", F.lit(a)), F.lit("")).alias(a) for a in attributes]
    return jobs.select(*values, "state", "cost")


def cost_by_attributes(jobs: DataFrame, attributes: Sequence[str], name: str | None = None) -> DataFrame:
    """Total cost per combination of attributes, to four decimals."""
    cost = F.regexp_replace("cost", r"^\$+", "").cast("double")
    return _by_attributes(jobs, attributes, name).groupBy(*attributes).agg(F.round(F.sum(cost), 4).alias("cost"))


def states_by_attributes(jobs: DataFrame, attributes: Sequence[str], name: str | None = None) -> DataFrame:
    """Number of jobs per combination of attributes and state."""
    return _by_attributes(jobs, attributes, name).groupBy(*attributes, "state").agg(F.count("*").alias("n_jobs"))


def jobs_by_name(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("name").agg(F.count("*").alias("n_jobs"))
