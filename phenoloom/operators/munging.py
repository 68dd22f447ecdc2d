"""Counting, grouping and conditioning phenotypes."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.model import SEXES, MatrixFrame


def any_true(value: Column) -> Column:
    """True if any value is true; missing values count as false."""
    return F.coalesce(F.bool_or(value), F.lit(False))


def case_counts(case: Column, sex: Column) -> list[Column]:
    """Cases with known sex, all cases, female cases, male cases."""
    return [
        F.count_if(case & sex.isNotNull()).alias("n_cases_defined"),
        F.count_if(case).alias("n_cases_both_sexes"),
        F.count_if(case & (sex == 0)).alias("n_cases_females"),
        F.count_if(case & (sex == 1)).alias("n_cases_males"),
    ]


def count_cases(frame: MatrixFrame, data_type: str) -> MatrixFrame:
    """Per-column counts for ICD, categorical or continuous matrices.

    ICD matrices store true cells only, so their controls are all people of the
    matrix who are not cases.
    """
    c = F.col
    if data_type == "icd":
        sources = [c(s) for s in ("primary_codes", "secondary_codes", "external_codes", "cause_of_death_codes")]
        anywhere = sources[0] | sources[1] | sources[2] | sources[3]
        counts = [
            F.count_if(sources[0]).alias("n_cases"),
            F.count_if(sources[1]).alias("n_cases_secondary"),
            F.count_if(sources[3]).alias("n_cases_cause_of_death"),
            F.count_if(anywhere).alias("n_cases_all"),
        ]
    elif data_type == "categorical":
        counts = [
            F.count_if(c("both_sexes")).alias("n_cases"),
            F.count_if(~c("both_sexes")).alias("n_controls"),
        ]
    else:
        counts = [
            F.count("both_sexes").alias("n_defined"),
            F.count("females").alias("n_defined_females"),
            F.count("males").alias("n_defined_males"),
        ]
    key = list(frame.col_key)
    counted = frame.entries.groupBy(*key).agg(*counts)
    names = [n for n in counted.columns if n not in key]
    cols = frame.cols.join(counted, key, "left").fillna(0, names)
    if data_type == "icd":
        people = frame.rows.agg(F.count("*")).scalar()
        cols = cols.withColumns({"n_controls": people - c("n_cases"), "n_controls_all": people - c("n_cases_all")})
    if data_type != "icd":
        cols = cols.withColumn("Field", F.coalesce(*[c(f"{s}_pheno.Field") for s in SEXES]))
        if data_type == "categorical":
            cols = cols.withColumn("meaning", F.coalesce(*[c(f"{s}_pheno.meaning") for s in SEXES]))
    return frame.with_(cols=cols)


def membership(frame_df: DataFrame, groups: Mapping | Iterable[Sequence], column: str, name: str) -> DataFrame:
    """(group, member) pairs of a user-given grouping as a table.

    Unnamed groups are labelled by their list of members.
    """
    column_type = frame_df.schema[column].dataType
    if isinstance(groups, Mapping):
        labelled = list(groups.items())
        label_type = T.StringType() if all(isinstance(k, str) for k in groups) else column_type
    else:
        labelled = [(list(g), g) for g in groups]
        label_type = T.ArrayType(column_type)
    pairs = [(label, member) for label, members in labelled for member in dict.fromkeys(members)]
    schema = T.StructType([T.StructField(name, label_type), T.StructField(column, column_type)])
    return frame_df.sparkSession.createDataFrame(pairs, schema).distinct()


def group_columns(
    entries: DataFrame,
    row_key: Sequence[str],
    column: str,
    value: str,
    groups: Mapping | Iterable[Sequence] | DataFrame,
    group_name: str = "grouping",
    value_name: str = "new_entry",
    function: Callable[[Column], Column] = any_true,
) -> DataFrame:
    """Aggregate entries over groups of columns.

    A column may be in several groups; columns in none are dropped. ``groups``
    maps labels to members, lists member lists, or is a (group, column) table.
    """
    table = groups if isinstance(groups, DataFrame) else membership(entries, groups, column, group_name)
    return (
        entries.join(table.distinct(), column)
        .groupBy(*row_key, group_name)
        .agg(function(F.col(value)).alias(value_name))
    )


def condition_columns(
    entries: DataFrame,
    row_key: Sequence[str],
    column: str,
    value: str,
    pairs: Iterable[Sequence] | DataFrame,
    group_name: str = "grouping",
    value_name: str = "new_entry",
) -> DataFrame:
    """First phenotype of each pair, given the second.

    The first one's value where the second is true, else NULL; NULL as well if
    either is missing. Rows with an entry for only one of the pair keep NULL.
    """
    if not isinstance(pairs, DataFrame):
        pairs = [list(p) for p in pairs]
        if any(len(p) != 2 for p in pairs):
            raise ValueError("each pair needs exactly two columns")
        kind = entries.schema[column].dataType
        schema = T.StructType([T.StructField("first", kind), T.StructField("second", kind)])
        pairs = entries.sparkSession.createDataFrame(pairs, schema)
    pairs = pairs.select("first", "second").distinct()
    sides = pairs.select(
        "first",
        "second",
        F.explode(
            F.array(
                F.struct(F.col("first").alias(column), F.lit(True).alias("_is_first")),
                F.struct(F.col("second").alias(column), F.lit(False).alias("_is_first")),
            )
        ).alias("_side"),
    ).select("first", "second", "_side.*")
    matched = (
        entries.join(sides, column)
        .groupBy(*row_key, "first", "second")
        .agg(
            F.bool_or(F.when(F.col("_is_first"), F.col(value))).alias("_first"),
            F.bool_or(F.when(~F.col("_is_first"), F.col(value))).alias("_second"),
        )
    )
    return matched.select(
        *row_key,
        F.array("first", "second").alias(group_name),
        F.when(F.col("_second"), F.col("_first")).alias(value_name),
    )
