"""Wide to long, hoisting constant fields, densifying, column-union row rules."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.model import PHENO_KEY, SEXES, MatrixFrame
from phenoloom.operators.defaults import merged_groups
from phenoloom.scale import every_cell, lookup, one_per_key

VALUE_TYPES = {
    "categorical": ((T.BooleanType,), "boolean"),
    "continuous": ((T.IntegerType, T.DoubleType), "double"),
}


def unpivot(
    df: DataFrame, ids: Sequence[str], columns: Sequence[str], cast: Column | str | Callable[[Column], Column],
    keep_missing: bool = True,
) -> DataFrame:
    """One record per (row, column): ids, ``position`` in ``columns``, ``value``.

    All columns go through one array, which stays cheap for thousands of them.
    """
    convert = cast if callable(cast) and not isinstance(cast, str) else (lambda c: c.cast(cast))
    values = F.array(*[convert(df[f"`{c}`"]) for c in columns])
    long = df.select(*ids, F.posexplode(values).alias("position", "value"))
    return long if keep_missing else long.filter(F.col("value").isNotNull())


def column_table(df: DataFrame, records: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """Driver-known column metadata as a table, numbered by ``position``."""
    fields = [T.StructField("position", T.IntegerType(), False)]
    fields += [T.StructField(n, T.StringType()) for n in names]
    rows = [(i, *record) for i, record in enumerate(records)]
    return df.sparkSession.createDataFrame(rows, T.StructType(fields))


def wide_to_matrix(
    df: DataFrame,
    data_type: str,
    row_key: Sequence[str] = ("userId",),
    special_fields: Sequence[str] = ("age", "sex"),
    rekey: bool = True,
    keep_missing: bool = True,
) -> MatrixFrame:
    """Per-person wide table to a person x phenotype matrix.

    Keeps boolean columns for categorical data, int and double columns for
    continuous data. With ``rekey`` a name ``a_b...`` becomes the five-part key
    with phenocode ``a`` and the rest as coding (categorical) or modifier
    (continuous); otherwise the name itself is the key.
    """
    kinds, value_type = VALUE_TYPES["categorical" if data_type == "categorical" else "continuous"]
    row_fields = [f for f in special_fields if f in df.columns]
    skip = {*row_key, *row_fields}
    picked = [f.name for f in df.schema if f.name not in skip and isinstance(f.dataType, kinds)]
    if rekey:
        records = []
        for name in picked:
            code, _, rest = name.partition("_")
            coding, modifier = (rest, "") if data_type == "categorical" else ("", rest)
            records.append((name, data_type, code, "both_sexes", coding, modifier if data_type == "continuous" else ""))
        names, key = ["phesant_pheno", *PHENO_KEY], list(PHENO_KEY)
    else:
        records, names, key = [(name,) for name in picked], ["phesant_pheno"], ["phesant_pheno"]
    cols = column_table(df, records, names)
    long = unpivot(df, row_key, picked, value_type, keep_missing)
    entries = long.join(cols.select("position", *key), "position").select(*row_key, *key, "value")
    return MatrixFrame(df.select(*row_key, *row_fields), cols.drop("position"), entries, list(row_key), key)


def select_fields(
    df: DataFrame,
    row_key: Sequence[str],
    criteria: Callable[[str, T.DataType], bool],
    cast: str | Callable[[Column], Column] = "double",
    rename: Callable[[str], str] = lambda name: name.split("-")[0],
    dictionary: DataFrame | None = None,
    keep_missing: bool = True,
) -> MatrixFrame:
    """Wide to long by a name/type predicate; ``dictionary`` (keyed by FieldID)
    adds the description of each phenocode to the column table."""
    picked = {rename(f.name): f.name for f in df.schema if f.name not in row_key and criteria(f.name, f.dataType)}
    cols = column_table(df, [(name,) for name in picked], ["phenocode"])
    long = unpivot(df, row_key, list(picked.values()), cast, keep_missing)
    entries = long.join(cols, "position").select(*row_key, "phenocode", "value")
    cols = cols.drop("position")
    if dictionary is not None:
        cols = lookup(cols, dictionary.withColumnRenamed("FieldID", "phenocode"), ["phenocode"])
    return MatrixFrame(df.select(*row_key), cols, entries, list(row_key), ["phenocode"])


def hoist_fields(
    frame: MatrixFrame,
    fields: Sequence[str],
    index: str = "rows",
    aggregates: Callable[[Column], Column] | Sequence[Callable[[Column], Column]] | None = None,
) -> MatrixFrame:
    """Move entry fields that are constant per row (or column) to that axis."""
    key = list(frame.row_key if index == "rows" else frame.col_key)
    if aggregates is None:
        aggregates = F.any_value
    functions = [aggregates] * len(fields) if callable(aggregates) else list(aggregates)
    hoisted = frame.entries.groupBy(*key).agg(*[f(F.col(c)).alias(c) for f, c in zip(functions, fields)])
    axis = frame.rows if index == "rows" else frame.cols
    annotated = axis.drop(*fields).join(hoisted, key, "left")
    return frame.with_(entries=frame.entries.drop(*fields), **{index: annotated})


def sex_values(value: Column, sex: Column) -> list[Column]:
    """The value for everyone, for females (0) and for males (1), as doubles."""
    number = value.cast("double")
    return [
        number.alias("both_sexes"),
        F.when(sex == 0, number).alias("females"),
        F.when(sex == 1, number).alias("males"),
    ]


def densify(
    frame: MatrixFrame, fill: dict[str, float] | None = None, row_fields: Sequence[str] = ()
) -> MatrixFrame:
    """Give every (row, column) an entry; ``fill`` replaces missing values.

    ``row_fields`` are carried along to the entries. Cells must be unique.
    """
    rows = frame.rows.select(*frame.row_key, *row_fields)
    entries = every_cell(rows, frame.cols.select(*frame.col_key), frame.entries, frame.row_key)
    filled = {f: F.coalesce(F.col(f), F.lit(v)) for f, v in (fill or {}).items()}
    return frame.with_(entries=entries.withColumns(filled) if filled else entries)


def fill_cols(frame: MatrixFrame, condition: Column, value: float = 0.0) -> MatrixFrame:
    """Densify only some columns, filling with ``value``; ``condition`` is over
    the column key."""
    chosen = frame.with_(cols=frame.cols.filter(condition), entries=frame.entries.filter(condition))
    filled = densify(chosen, {f: value for f in frame.entry_fields})
    return frame.with_(entries=frame.entries.filter(~condition).unionByName(filled.entries))


def union_cols(frames: Sequence[MatrixFrame], rows: str = "outer") -> MatrixFrame:
    """Set the columns of several matrices side by side.

    ``rows`` keeps the rows of all (``outer``), of the first (``left``) or the
    rows all matrices share (``inner``). Defaults of absent cells stay with
    their columns, and rows keep the groups of all matrices.
    """
    first = frames[0]
    key = list(first.row_key)
    keys = [f.rows.select(*key) for f in frames]
    if rows == "outer":
        kept = reduce(DataFrame.unionByName, keys).distinct()
        named = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.rows for f in frames])
        all_rows = lookup(kept, named, key) if len(named.columns) > len(key) else kept
    elif rows == "left":
        all_rows = first.rows
    else:
        all_rows = reduce(lambda a, b: a.join(b, key, "left_semi"), keys[1:], first.rows)
    all_rows = merged_groups(all_rows, [f.rows for f in frames], key)
    cols = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.cols for f in frames])
    entries = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.entries for f in frames])
    if rows != "outer":
        entries = entries.join(all_rows.select(*key), key, "left_semi")
    return MatrixFrame(all_rows, cols, entries, key, first.col_key)


def join_axes(
    left: MatrixFrame,
    right: MatrixFrame,
    rows: str | None = "",
    cols: str | None = "",
    entries: str | None = "",
) -> MatrixFrame:
    """Annotate ``left`` with ``right`` on each axis.

    ``''`` splats the fields (replacing fields of the same name), a name nests
    them in a struct, ``None`` leaves the axis alone. Constants of ``right``
    are plain columns here and travel with its axes.
    """

    def annotate(base: DataFrame, extra: DataFrame, key: Sequence[str], mode: str | None) -> DataFrame:
        fields = [c for c in extra.columns if c not in key]
        if mode is None or not fields:
            return base
        if mode:
            extra = extra.select(*key, F.struct(*fields).alias(mode))
            fields = [mode]
        return lookup(base.drop(*fields), extra, key)

    key = [*left.row_key, *left.col_key]
    return left.with_(
        rows=annotate(left.rows, right.rows, left.row_key, rows),
        cols=annotate(left.cols, right.cols, left.col_key, cols),
        entries=annotate(left.entries, right.entries, key, entries),
    )


def by_sex(frames: dict[str, MatrixFrame]) -> MatrixFrame:
    """Full outer combination of the both_sexes, females and males matrices.

    Entries get one field per sex, columns one ``<sex>_pheno`` struct per sex.
    """
    base = frames["both_sexes"]
    row_key, col_key = list(base.row_key), list(base.col_key)
    tagged = reduce(
        DataFrame.unionByName,
        [frames[s].entries.select(*row_key, *col_key, "value", F.lit(s).alias("_sex")) for s in SEXES],
    )
    entries = tagged.groupBy(*row_key, *col_key).agg(
        *[F.max(F.when(F.col("_sex") == s, F.col("value"))).alias(s) for s in SEXES]
    )
    packed = []
    for s in SEXES:
        fields = [c for c in frames[s].cols.columns if c not in col_key]
        packed.append(frames[s].cols.select(*col_key, F.struct(*fields).alias(f"{s}_pheno")))
    cols = reduce(
        lambda a, b: a.join(b, col_key, "full_outer"), [one_per_key(p, col_key) for p in packed]
    )
    rows = reduce(DataFrame.unionByName, [frames[s].rows.select(*row_key) for s in SEXES]).distinct()
    return MatrixFrame(rows, cols, entries, row_key, col_key)
