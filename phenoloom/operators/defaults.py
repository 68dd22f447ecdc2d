"""Columns whose absent cells have a value, so that zeros need not be stored.

``absent_value`` in the column table is what an absent cell counts as, and
``absent_rows`` for whom: ``ALL_ROWS``, or the name of a row group listed in the
rows' ``row_groups`` (the rows of one source). For a row outside the group an
absent cell is missing, as it is in a column without a default. In a matrix with
one field per sex, a group's default holds for the fields of the row's sex, and
``ALL_ROWS`` for every field. A stored cell always counts as it is.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from phenoloom.model import MatrixFrame
from phenoloom.scale import every_cell

VALUE, FOR, GROUPS, ALL_ROWS = "absent_value", "absent_rows", "row_groups", "*"
SEX_OF_FIELD = {"females": 0, "males": 1}


def with_default(frame: MatrixFrame, value: float, group: str = ALL_ROWS) -> MatrixFrame:
    """``frame`` with absent cells of all its columns counting as ``value``, for all
    rows of whatever it becomes part of, or for its own rows under the name ``group``."""
    cols = frame.cols.withColumns({VALUE: F.lit(float(value)), FOR: F.lit(group)})
    rows = frame.rows if group == ALL_ROWS else frame.rows.withColumn(GROUPS, F.array(F.lit(group)))
    return frame.with_(rows=rows, cols=cols)


def merged_groups(rows: DataFrame, sources: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """``rows`` with the row groups that all ``sources`` list for them."""
    listed = [s.select(*key, F.explode(GROUPS).alias("_group")) for s in sources if GROUPS in s.columns]
    if not listed:
        return rows
    every = listed[0]
    for more in listed[1:]:
        every = every.unionByName(more)
    groups = every.groupBy(*key).agg(F.array_sort(F.collect_set("_group")).alias(GROUPS))
    return rows.drop(GROUPS).join(groups, list(key), "left")


def _columns(frame: MatrixFrame) -> DataFrame:
    """Column keys with their default, NULL where they have none."""
    kinds = {VALUE: "double", FOR: "string"}
    return frame.cols.select(
        *frame.col_key, *[F.col(c) if c in frame.cols.columns else F.lit(None).cast(k).alias(c) for c, k in kinds.items()]
    )


def _rows(frame: MatrixFrame, *fields: str) -> DataFrame:
    groups = F.col(GROUPS) if GROUPS in frame.rows.columns else F.lit(None).cast("array<string>")
    return frame.rows.select(*frame.row_key, *fields, F.coalesce(groups, F.array().cast("array<string>")).alias(GROUPS))


def _holds(field: str, sex: Column | None) -> Column:
    """Whether a cell's default holds for its row, given both tables' columns."""
    grouped = F.array_contains(GROUPS, F.col(FOR))
    if field in SEX_OF_FIELD and sex is not None:
        grouped = grouped & F.coalesce(sex == SEX_OF_FIELD[field], F.lit(False))
    return F.col(VALUE).isNotNull() & ((F.col(FOR) == ALL_ROWS) | grouped)


def cells_by_value(frame: MatrixFrame, field: str, measures: Mapping[str, Column] | None = None) -> DataFrame:
    """(column key, value, n, measures): how many cells of each column have a value,
    and the sums of whole-number ``measures`` of their rows.

    Every row counts for every column, without making the cells: absent ones are
    what is left of the rows when the stored ones are taken off. Cells and rows
    must be unique. ``frame.rows`` may hold ``sex``.
    """
    measures = dict(measures or {})
    has_sex = "sex" in frame.rows.columns
    rows = _rows(frame, *(["sex"] if has_sex else []))
    rows = rows.withColumns({"n": F.lit(1).cast("long"), **{n: c.cast("long") for n, c in measures.items()}})
    names = ["n", *measures]
    sex = F.col("sex") if has_sex else None
    columns = _columns(frame)
    stored = (
        frame.entries.select(*frame.row_key, *frame.col_key, F.col(field).alias("value"))
        .join(rows, list(frame.row_key)).join(columns, list(frame.col_key))
        .groupBy(*frame.col_key, "value", F.coalesce(_holds(field, sex), F.lit(False)).alias("_holds"))
        .agg(*[F.sum(x).alias(x) for x in names])
    )
    # Rows in all, and those that a group's default holds for: one record per group.
    total = rows.agg(F.struct(*[F.sum(x).alias(x) for x in names])).scalar()
    member = rows.select(F.explode(GROUPS).alias(FOR), *(["sex"] if has_sex else []), *names)
    if field in SEX_OF_FIELD and has_sex:
        member = member.filter(F.col("sex") == SEX_OF_FIELD[field])
    held = member.groupBy(FOR).agg(*[F.sum(x).alias(f"_{x}") for x in names])
    shared = columns.join(held, FOR, "left").withColumn("_all", total)
    none, every = F.col(VALUE).isNull(), F.col(FOR) == ALL_ROWS
    holding = {x: F.when(none, 0).when(every, F.col(f"_all.{x}")).otherwise(F.coalesce(f"_{x}", F.lit(0))) for x in names}
    all_cells = shared.select(
        *frame.col_key,
        F.inline(F.array(
            F.struct(F.col(VALUE).alias("value"), *[v.alias(x) for x, v in holding.items()]),
            F.struct(F.lit(None).cast("double").alias("value"), *[(F.coalesce(f"_all.{x}", F.lit(0)) - v).alias(x) for x, v in holding.items()]),
        )),
    )
    taken = stored.join(columns.select(*frame.col_key, VALUE), list(frame.col_key)).select(
        *frame.col_key, F.when(F.col("_holds"), F.col(VALUE)).alias("value"), "_holds", *[(-F.col(x)).alias(x) for x in names]
    )
    parts = all_cells.unionByName(taken.drop("_holds")).unionByName(stored.drop("_holds"))
    summed = parts.groupBy(*frame.col_key, "value").agg(*[F.sum(x).alias(x) for x in names])
    return summed.filter("n > 0")


def dense_cells(frame: MatrixFrame, fields: Sequence[str]) -> DataFrame:
    """Every cell of the matrix with its value, defaults filled in; for few columns,
    as the result has a record per row and column."""
    row_fields = ["sex"] if "sex" in frame.rows.columns else []
    rows = _rows(frame, *row_fields)
    entries = frame.entries.select(*frame.row_key, *frame.col_key, *fields, F.lit(True).alias("_stored"))
    columns = _columns(frame)
    cells = every_cell(rows, columns.select(*frame.col_key), entries, frame.row_key)
    sex = F.col("sex") if row_fields else None
    filled = {
        f: F.when(F.col("_stored").isNull() & _holds(f, sex), F.col(VALUE)).otherwise(F.col(f)) for f in fields
    }
    return cells.join(columns, list(frame.col_key)).withColumns(filled).select(*frame.row_key, *frame.col_key, *fields)
