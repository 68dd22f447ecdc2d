"""Building blocks that stay balanced when one key holds much of the data.

Ordered work is laid out in *tiles*: range partitions over the group key and
the ordering columns together, so a hot group is cut into many tiles. What
crosses a tile edge is carried by a table with at most a few rows per tile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from phenoloom.session import stage

TILE = "_tile"


def tiles(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Range-partition by ``order``, number the partitions in ``_tile``, stage.

    Staging fixes the sampled range bounds, so every later pass sees the same
    tiles.
    """
    return stage(df.repartitionByRange(*order).withColumn(TILE, F.spark_partition_id()))


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> Column:
    condition = F.lit(True)
    for name in names:
        condition = condition & left[name].eqNullSafe(right[name])
    return condition


def number_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_number"
) -> DataFrame:
    """1-based position within each ``keys`` group, exact for hot groups."""
    tiled = tiles(df, [*keys, *order])
    window = Window.partitionBy(TILE, *keys).orderBy(*order)
    local = tiled.withColumn(name, F.row_number().over(window))
    counts = tiled.groupBy(TILE, *keys).agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy(TILE).rowsBetween(Window.unboundedPreceding, -1)
    # Only the first key of a tile can have rows in earlier tiles: at most one
    # record per tile is left here, which bounds the broadcast.
    carried = (
        counts.withColumn("_before", F.sum("_n").over(earlier))
        .filter(F.col("_before").isNotNull())
        .drop("_n")
    )
    joined = local.join(F.broadcast(carried), _same(local, carried, [TILE, *keys]), "left")
    kept = [local[c] for c in df.columns]
    position = (local[name] + F.coalesce(carried["_before"], F.lit(0))).cast("long")
    return joined.select(*kept, position.alias(name))


def previous_row(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], fields: Sequence[str], name: str = "previous"
) -> DataFrame:
    """Struct of ``fields`` of the preceding row of the same ``keys`` group.

    ``order`` must be a total order within a group.
    """
    tiled = tiles(df, [*keys, *order])
    whole = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)], F.struct(*fields).alias("f"))
    window = Window.partitionBy(TILE).orderBy(*keys, *order)
    local = tiled.withColumn("_prev", F.lag(whole).over(window))
    # One record per tile: its last row, handed to the next non-empty tile.
    last = tiled.groupBy(TILE).agg(
        F.max(F.struct(*[F.col(c) for c in [*keys, *order]], whole.alias("w"))).alias("_last")
    )
    handed = last.select(TILE, F.lag("_last.w").over(Window.orderBy(TILE)).alias("_handed"))
    joined = local.join(F.broadcast(handed), TILE, "left")
    candidate = F.coalesce("_prev", "_handed")
    same_group = F.lit(True)
    for i, key in enumerate(keys):
        same_group = same_group & candidate[f"k{i}"].eqNullSafe(F.col(key))
    return joined.select(*df.columns, F.when(same_group, candidate["f"]).alias(name))


BINS = 256


def level_code(levels: Sequence[Column], n_levels: Sequence[int]) -> Column:
    """One whole number for several levels, each from -1 (in no set) up; 0 if all are -1."""
    code, stride = F.lit(0), 1
    for level, n in zip(levels, n_levels):
        code = code + (level.cast("int") + 1) * stride
        stride *= n + 1
    return code.cast("int")


def _levels(code: Column, n_levels: Sequence[int]) -> list[Column]:
    out, stride = [], 1
    for n in n_levels:
        out.append((F.floor(code / stride) % (n + 1) - 1).cast("int"))
        stride *= n + 1
    return out


def sets_of(code: Column, n_levels: Sequence[int]) -> Column:
    """Numbers of the sets a code is in: of each level the sets up to it, one level after the other."""
    parts, first = [], 0
    for level, n in zip(_levels(code, n_levels), n_levels):
        parts.append(F.when(level >= 0, F.sequence(F.lit(first), level + first)).otherwise(F.array().cast("array<int>")))
        first += n
    return F.concat(*parts)


def _members(code: Column, n_levels: Sequence[int]) -> list[Column]:
    """Whether a code is in each of the sets."""
    return [level >= j for level, n in zip(_levels(code, n_levels), n_levels) for j in range(n)]


def _ranked_sets(counts: DataFrame, part: str, outer: Sequence[str], n_levels: Sequence[int]) -> DataFrame:
    """(outer, part, j, before, inside, n) from counts per (outer, part, code).

    ``inside`` counts the values of set ``j`` in the part, ``before`` those in
    earlier parts and ``n`` all of them.
    """
    sets = (
        counts.select(*outer, part, "_c", F.explode(sets_of(F.col("_level"), n_levels)).alias("j"))
        .groupBy(*outer, part, "j")
        .agg(F.sum("_c").alias("inside"))
    )
    whole = Window.partitionBy(*outer, "j")
    earlier = whole.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return sets.withColumns(
        {"before": F.coalesce(F.sum("inside").over(earlier), F.lit(0)), "n": F.sum("inside").over(whole)}
    )


def level_histogram(df: DataFrame, group: Sequence[str], value: str, level: Column, *more: Column) -> DataFrame:
    """Rows per group, level code and bin of [0, 1], with the aggregates ``more``; staged.

    Values outside fall in the end bins, NULL and NaN in the bin NULL.
    """
    return stage(
        df.select("*", *_histogram_key(group, value, level)).groupBy("_group", "_bin", "_level").agg(F.count("*").alias("_c"), *more)
    )


def _histogram_key(group: Sequence[str], value: str, level: Column) -> list[Column]:
    # In a struct, missing parts of a key are equal to each other in joins too.
    v = F.col(value)
    binned = F.greatest(F.lit(-1.0), F.least(F.lit(float(BINS)), F.floor(v * BINS).cast("double"))).cast("int")
    return [
        F.struct(F.lit(0).alias("_all"), *group).alias("_group"),
        F.when(v.isNotNull() & ~F.isnan(v), binned).alias("_bin"),
        level.cast("int").alias("_level"),
    ]


def nested_middles(
    df: DataFrame, group: Sequence[str], value: str, level: Column, n_levels: int | Sequence[int], histogram: DataFrame | None = None
) -> DataFrame:
    """Exact middle values of nested subsets of every group.

    ``level`` is a level with ``n_levels`` sets, or the ``level_code`` of several
    with so many each; set ``j`` of a level holds the rows that reach it, and the sets of all
    levels are numbered one after the other, so several nestings take the same
    two passes.

    Returns ``group``, ``j``, ``n``, ``lower``, ``upper``: the number of values
    and the two middle ones (equal for odd ``n``). NULL and NaN values are left
    out.

    A first pass (``level_histogram``; give its result if there is one) counts
    values per bin, which tells the bins the middles lie in and ships only
    counts. A second pass ranks the values of those bins alone: equal values are merged,
    the rest is sorted over tiles, so no group or bin is gathered in one task
    however the values are spread.
    """
    if isinstance(n_levels, int):
        level, n_levels = level_code([level], [n_levels]), [n_levels]
    if histogram is None:
        histogram = level_histogram(df, group, value, level)
    used = "_bin IS NOT NULL AND _level > 0"
    narrow = df.select(F.col(value).alias("_v"), *_histogram_key(group, value, level)).filter(used)
    names, group = group, ["_group"]
    histogram = histogram.filter(used)
    # At most two bins per group and set.
    targets = (
        _ranked_sets(histogram, "_bin", group, n_levels)
        .withColumns({"lo": F.expr("(n + 1) div 2"), "hi": F.expr("n div 2 + 1")})
        .filter("before < hi AND before + inside >= lo")
        .select(*group, "_bin", "j", "n", "lo", "hi", F.col("before").alias("below"))
    )
    targets = stage(targets)
    where = [*group, "_bin"]
    weighted = (
        narrow.join(targets.select(*where).distinct(), where, "left_semi")
        .groupBy(*where, "_v", "_level")
        .agg(F.count("*").alias("_n"))
    )
    tiled = tiles(weighted, [*where, "_v", "_level"])
    sums = tiled.groupBy(TILE, *where, "_level").agg(F.sum("_n").alias("_c"))
    needs = (
        _ranked_sets(sums, TILE, where, n_levels)
        .drop("n")
        .join(targets, [*where, "j"])
        .withColumn("before", F.col("before") + F.col("below"))
        .filter("before < hi AND before + inside >= lo")
        .groupBy(TILE, *where)  # at most a small record per set, tile and bin
        .agg(F.collect_list(F.struct("j", "before", "n", "lo", "hi")).alias("_needs"))
    )
    running = Window.partitionBy(TILE, *where).orderBy("_v", "_level").rowsBetween(Window.unboundedPreceding, 0)
    sums_so_far = F.array(
        *[F.sum(F.when(member, F.col("_n"))).over(running) for member in _members(F.col("_level"), n_levels)]
    )
    # Hash the few needs against the tiles: the tiles are shuffled once, by the
    # keys the window needs as well.
    ranked = tiled.join(needs.hint("shuffle_hash"), [TILE, *where]).select(
        *group, "_v", "_level", "_n", "_needs", sums_so_far.alias("_so_far")
    )
    last = F.col("before") + F.get("_so_far", F.col("j"))
    picks = (
        ranked.select(*group, "_v", "_level", "_n", "_so_far", F.inline("_needs"))
        .filter(F.array_contains(sets_of(F.col("_level"), n_levels), F.col("j")))
        .withColumns({"last": last, "first": last - F.col("_n") + 1})
        .withColumns({"is_lower": F.expr("lo BETWEEN first AND last"), "is_upper": F.expr("hi BETWEEN first AND last")})
        .filter("is_lower OR is_upper")
    )
    return (
        picks.groupBy(*group, "j")
        .agg(
            F.max("n").alias("n"),
            F.min(F.when(F.col("is_lower"), F.col("_v"))).alias("lower"),
            F.min(F.when(F.col("is_upper"), F.col("_v"))).alias("upper"),
        )
        .withColumn("upper", F.coalesce("upper", "lower"))
        .select(*[F.col("_group").getField(g).alias(g) for g in names], "j", "n", "lower", "upper")
    )


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``df`` hashed by ``keys`` into as many partitions as shuffles have.

    The count is given, so that small partitions are not merged into ones of the
    advised size. Joins and groupings by ``keys`` need no further shuffle; where
    several meet in one task, each of them then holds a small share.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def one_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, the same one on every run (the least by its values)."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    kept = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(f"`{c}`") for c in rest])).alias("_row"))
    return kept.select(*keys, *[F.col("_row").getField(c).alias(c) for c in rest])


def lookup(left: DataFrame, right: DataFrame, on: Sequence[str], unique: bool = False) -> DataFrame:
    """Left join that never multiplies rows. ``unique`` skips the deduplication
    of a right side already known to hold one row per key. The size of the
    right side decides the join strategy at run time."""
    return left.join(right if unique else one_per_key(right, on), list(on), "left")


def every_cell(
    rows: DataFrame, cols: DataFrame, entries: DataFrame, row_key: Sequence[str], block: int = 1024
) -> DataFrame:
    """All (row, column) cells of a dense grid with their entry, if any.

    Column keys and each row's entries are packed by hashed column blocks of
    about ``block``; a row meets the blocks by an equi-join and unpacks them.
    Only row keys per block and the sparse entries are shuffled, the dense cells
    are made last.
    """
    key = cols.columns
    fields = [c for c in entries.columns if c not in (*row_key, *key)]
    n_blocks = cols.agg((F.count("*") / block).cast("int") + 1).scalar()
    packs = (
        cols.withColumn("_blocks", n_blocks)
        .groupBy(F.pmod(F.xxhash64(*key), F.col("_blocks")).cast("int").alias("_block"))
        .agg(F.array_sort(F.collect_list(F.struct(*key))).alias("_cols"))
    )
    positions = packs.select("_block", F.posexplode("_cols").alias("_at", "_col")).select("_block", "_at", "_col.*")
    filled = (
        entries.join(positions, key)
        .groupBy(*row_key, "_block")
        .agg(F.collect_list(F.struct("_at", F.struct(*fields).alias("_entry"))).alias("_cells"))
    )
    # The partition count is given, so that small row keys are not merged into
    # too few tasks before they are multiplied by the columns.
    n_partitions = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grid = (
        rows.withColumn("_blocks", n_blocks)
        .select(*rows.columns, F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)).alias("_block"))
        .repartition(n_partitions, *row_key, "_block")
        .join(filled, [*row_key, "_block"], "left")
        # There are few blocks, so rows meet copies of a block, spread by a salt.
        .withColumn("_salt", F.pmod(F.xxhash64(*row_key), F.lit(n_partitions)).cast("int"))
        .join(packs.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n_partitions - 1)))), ["_block", "_salt"], "left")
    )
    kind = filled.schema["_cells"].dataType
    present = F.coalesce("_cells", F.array().cast(kind))
    places = F.sequence(F.lit(0), F.size("_cols") - 1)
    absent = F.array_except(places, F.transform(present, lambda c: c["_at"]))
    nothing = F.lit(None).cast(kind.elementType["_entry"].dataType)

    def cell(at: Column, entry: Column) -> Column:
        return F.struct(F.get("_cols", at).alias("_col"), entry.alias("_entry"))

    # Cells take their column's key along, so no record carries the block's columns.
    every = F.concat(
        F.transform(present, lambda c: cell(c["_at"], c["_entry"])), F.transform(absent, lambda at: cell(at, nothing))
    )
    packed = grid.filter("_cols IS NOT NULL").select(*rows.columns, every.alias("_every"))
    return packed.select(*rows.columns, F.inline("_every")).select(
        *rows.columns,
        *[F.col("_col")[k].alias(k) for k in key],
        *[F.col("_entry")[f].alias(f) for f in fields],
    )
