"""Phenotype x phenotype products as a blocked matrix multiplication.

Entries are cut into blocks of samples and blocks of columns; each task
multiplies two dense blocks of bounded size and sums the products in dense
tiles, which are then added up. Column blocks are replicated, single entries never meet pairwise in a
shuffle, and a sample with very many phenotypes is spread over all the column
block pairs.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.scale import number_rows

TILE_SCHEMA = "left_block int, right_block int, n_cols int, tile binary"
PRODUCT_SCHEMA = "i long, j long, entry double"
CELL_KEY = ["left_block", "right_block", "sample_block"]


def tile_functions(col_block: int):
    """The two task functions: products of blocks to tiles, and tiles to sums.

    They are made here, as local functions, so that they are shipped whole and
    workers need not have this package.
    """

    def shape(left: int, right: int, n_cols: int) -> tuple[int, int]:
        return min(col_block, n_cols - left * col_block), min(col_block, n_cols - right * col_block)

    def groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
        """Runs of records with the same values of ``names``, one at a time, over the ends of batches."""
        held: list[pa.Table] = []
        last: tuple | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            keys = np.stack([table.column(n).to_numpy() for n in names])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            for at, to in zip([0, *cuts], [*cuts, len(table)]):
                key = tuple(keys[:, at].tolist())
                if key != last and held:
                    yield last, pa.concat_tables(held)
                    held = []
                held.append(table.slice(at, to - at))
                last = key
        if held:
            yield last, pa.concat_tables(held)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Cells in order of their block pair and sample block to one tile per pair:
        the products of all sample blocks of the task, summed."""
        pair, tile, n_cols = None, None, 0

        def done() -> pa.RecordBatch:
            columns = [pa.array([x], pa.int32()) for x in (*pair, n_cols)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([tile.tobytes()], pa.binary())], ["left_block", "right_block", "n_cols", "tile"])

        for (left, right, _), cells in groups(batches, CELL_KEY):
            if (left, right) != pair:
                if pair is not None:
                    yield done()
                pair, n_cols = (left, right), cells.column("n_cols")[0].as_py()
                tile = np.zeros(shape(left, right, n_cols))
            rows = cells.column("row").combine_chunks().dictionary_encode().indices.to_numpy()
            idx, value = cells.column("idx").to_numpy(), cells.column("value").to_numpy()
            sides = []
            for block, size in zip(pair, tile.shape):
                own = idx // col_block == block
                dense = np.zeros((int(rows.max(initial=-1)) + 1, size))
                np.add.at(dense, (rows[own], idx[own] - block * col_block), value[own])
                sides.append(dense)
            tile += sides[0].T @ sides[1]
        if pair is not None:
            yield done()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Tiles in order of their block pair, summed and written out as (i, j, entry)."""
        for (left, right, n_cols), tiles in groups(batches, ["left_block", "right_block", "n_cols"]):
            total = np.zeros(shape(left, right, n_cols))
            for chunk in tiles.column("tile").chunks:
                for tile in chunk:
                    total += np.frombuffer(tile.as_buffer(), dtype=np.float64).reshape(total.shape)
            i, j = (b * col_block + np.arange(n) for b, n in zip((left, right), total.shape))
            for at in range(len(i)):
                ends = [np.full(len(j), i[at]), j]
                for pair in [ends] if left == right else [ends, ends[::-1]]:
                    yield pa.RecordBatch.from_arrays([*map(pa.array, pair), pa.array(total[at])], ["i", "j", "entry"])

    return products, sums


def gram(
    entries: DataFrame, cols: DataFrame, row_key: str, value: str, row_block: int = 1024, col_block: int = 1024
) -> DataFrame:
    """All sums over rows of ``value[i] * value[j]``, both orders, zeros included.

    ``entries`` and ``cols`` carry the column number ``idx`` (from 0, dense). The
    cells of a pair of column blocks are spread over a number of tasks that does
    not depend on the rows; each task sums its products in one dense tile of at
    most ``col_block`` squared, and the tiles of a pair are added element by
    element. So what is exchanged after the products is about a tile per task,
    however many the rows.
    """
    n_row_blocks = entries.agg((F.approx_count_distinct(row_key) / row_block).cast("int") + 1).scalar()
    n_cols = cols.agg(F.count("*").cast("int")).scalar()
    parts = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    block = F.floor(F.col("idx") / col_block).cast("int").alias("block")
    filled = entries.filter(F.col(value).isNotNull() & (F.col(value) != 0)).select(
        F.pmod(F.xxhash64(row_key), n_row_blocks).cast("int").alias("sample_block"),
        F.col(row_key).alias("row"),
        F.col("idx").cast("long"),
        block,
        F.col(value).cast("double").alias("value"),
    )
    row_type = entries.schema[row_key].dataType
    any_row = F.lit("" if isinstance(row_type, T.StringType) else 0).cast(row_type)
    seeds = cols.select(  # a zero cell for every column
        F.lit(0).alias("sample_block"), any_row.alias("row"), F.col("idx").cast("long"), block, F.lit(0.0).alias("value")
    )
    last = F.floor((F.col("n_cols") - 1) / col_block).cast("int")
    paired = (
        filled.unionByName(seeds)
        .withColumn("n_cols", n_cols)
        .withColumn("other", F.explode(F.sequence(F.lit(0), last)))
        .select(
            F.least("block", "other").alias("left_block"),
            F.greatest("block", "other").alias("right_block"),
            "sample_block", "row", "idx", "value", "n_cols",
            # As many salts as fill the tasks, given the number of block pairs.
            F.pmod("sample_block", F.greatest(F.lit(1), F.floor(2 * parts / ((last + 1) * (last + 2))).cast("int"))).alias("salt"),
        )
    )
    products, sums = tile_functions(col_block)
    tiles = (
        paired.repartition(parts, "left_block", "right_block", "salt").sortWithinPartitions(*CELL_KEY)
        .drop("salt").mapInArrow(products, TILE_SCHEMA)
    )
    key = ["left_block", "right_block", "n_cols"]
    return tiles.repartition(parts, *key).sortWithinPartitions(*key).mapInArrow(sums, PRODUCT_SCHEMA)


def _with_both_ends(products: DataFrame, cols: DataFrame) -> DataFrame:
    data = [c for c in cols.columns if c != "idx"]
    for end in ("i", "j"):
        side = cols.select(F.col("idx").alias(end), F.struct(*data).alias(f"{end}_data"))
        products = products.join(side, end)
    return products


def _numbered(cols: DataFrame, col_key: Sequence[str]) -> DataFrame:
    return number_rows(cols, [], col_key, "idx").withColumn("idx", F.col("idx") - 1)


def pairwise_overlap(
    entries: DataFrame,
    row_key: str,
    col_key: Sequence[str],
    value: str,
    cols: DataFrame | None = None,
    min_cases: int = 500,
    col_block: int = 1024,
) -> DataFrame:
    """Shared cases of every phenotype pair, and their share of the first's cases.

    Only phenotypes with at least ``min_cases`` take part.
    """
    number = F.col(value).cast("double")
    counts = entries.groupBy(*col_key).agg(F.coalesce(F.sum(number), F.lit(0.0)).alias("n_cases"))
    if cols is not None:
        counts = cols.join(counts, list(col_key), "left").fillna(0.0, ["n_cases"])
    kept = _numbered(counts.filter(F.col("n_cases") >= min_cases), col_key)
    cells = entries.withColumn("_x", number).join(kept.select(*col_key, "idx"), list(col_key))
    products = _with_both_ends(gram(cells, kept, row_key, "_x", col_block=col_block), kept)
    share = F.when(F.col("i_data.n_cases") != 0, F.col("entry") / F.col("i_data.n_cases")).otherwise(
        F.lit(float("nan"))
    )
    return products.withColumn("prop_overlap", share)


def pairwise_correlation(
    entries: DataFrame,
    row_key: str,
    col_key: Sequence[str],
    value: str,
    cols: DataFrame | None = None,
    col_block: int = 1024,
) -> DataFrame:
    """Correlation of every phenotype pair after mean imputation.

    An imputed cell is 0 once centred, so only cells with a value take part.
    Phenotypes without spread give NaN. A column table with
    ``n_cases_both_sexes`` limits the phenotypes to those with any case.
    """
    if cols is not None:
        with_cases = cols.filter("n_cases_both_sexes > 0").select(*col_key)
        entries = entries.join(with_cases, list(col_key), "left_semi")
    number = F.col(value).cast("double")
    stats = (
        entries.filter(number.isNotNull())
        .groupBy(*col_key)
        .agg(
            F.avg(number).alias("mean"),
            F.sqrt(F.var_pop(number) * F.count(number)).alias("norm"),
            F.count(number).alias("n_defined"),
        )
    )
    kept = _numbered(stats, col_key)
    scaled = (
        entries.filter(number.isNotNull())
        .join(kept.select(*col_key, "idx", "mean", "norm"), list(col_key))
        .withColumn("_x", F.when(F.col("norm") > 0, (number - F.col("mean")) / F.col("norm")))
    )
    products = _with_both_ends(gram(scaled, kept, row_key, "_x", col_block=col_block), kept)
    flat = (F.col("i_data.norm") == 0) | (F.col("j_data.norm") == 0)
    return products.withColumn("entry", F.when(flat, F.lit(float("nan"))).otherwise(F.col("entry")))
