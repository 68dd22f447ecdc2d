"""Near-duplicates by SimHash fingerprints and bit-sliced comparison."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col, free_name
from phenoloom.session import stage

SEED = 42


def fingerprint(text: bytes | None, shingle: int) -> int:
    """SimHash of the text's word shingles, as a signed 64-bit number."""
    words = (text or b"").lower().split()  # bytes: A-Z and the six ASCII blanks only
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        ends = np.cumsum(sizes + 1) - 1
        starts = ends - sizes
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[shingle - 1 :].tolist())]
    values = np.array(hashes, dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(values), 1 << 15):
        some = values[at : at + (1 << 15)]
        ones += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(values)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def add_fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """(_id, _th, _fp) per row: the id, a hash of the text and the fingerprint."""
    plain = docs.select(col(id_col).alias("_id"), F.xxhash64(col(text_col)).alias("_th"), col(text_col).cast("binary").alias("_text"))
    schema = T.StructType([plain.schema["_id"], T.StructField("_th", T.LongType()), T.StructField("_fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column("_text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_th"), pa.array(prints, pa.int64())], ["_id", "_th", "_fp"]
            )

    return plain.mapInArrow(run, schema)


# --- bit-sliced comparison -------------------------------------------------


def within_radius(planes: np.ndarray, lanes: np.ndarray, unit: np.ndarray, query: np.ndarray, radius: int) -> np.ndarray:
    """For every task, the lanes of its unit within ``radius`` bits of its query.

    ``planes[b, u]`` holds bit b of the 64 values of unit u, one per lane, and
    ``query[b, t]`` bit b of task t's value. The distances of 64 lanes grow
    together: a carry-save counter adds the differing bits of a plane in a few
    word operations. A lane is lost when its counter passes the radius, and a
    task is abandoned as soon as all its lanes are.
    """
    width = radius.bit_length()
    limit = (1 << width) - 1 - radius  # counters start here, so that passing the radius overflows
    result = np.zeros(len(unit), dtype=np.uint64)
    alive = np.arange(len(unit))
    every = np.uint64(0xFFFFFFFFFFFFFFFF)
    over = ~lanes
    counter = [np.full(len(unit), every if limit >> k & 1 else 0, dtype=np.uint64) for k in range(width)]
    for b in range(len(planes)):
        carry = planes[b, unit] ^ query[b]
        for k in range(width):
            carry, counter[k] = carry & counter[k], carry ^ counter[k]
        over = over | carry
        if b % 4 == 3:
            on = over != every
            if not on.all():
                alive, unit, over = alive[on], unit[on], over[on]
                counter = [c[on] for c in counter]
                query = query[:, on]
                if not len(alive):
                    return result
    result[alive] = ~over
    return result


def local_roots(values: np.ndarray, group: np.ndarray, side: np.ndarray, bits: list[int], radius: int) -> np.ndarray:
    """Label of every row: rows linked inside a group share the least row number.

    Rows are sorted by group. Rows with ``side`` 2 stand in both roles; else
    only rows of side 0 are compared with rows of side 1.
    """
    n = len(values)
    label = np.arange(n)
    planes_of = values.view(np.uint64)
    begin = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    size = np.diff(np.concatenate([begin, [n]]))
    group_no = np.repeat(np.arange(len(begin)), size)
    # Units of up to 64 lanes over the rows of side 0 or 2, group by group.
    left = np.flatnonzero(side != 1)
    if not len(left):
        return label
    left_group = group_no[left]
    left_begin = np.searchsorted(left_group, np.arange(len(begin)))
    place = np.arange(len(left)) - left_begin[left_group]
    n_left = np.bincount(left_group, minlength=len(begin))
    units = -(-n_left // 64)
    unit_begin = np.concatenate([[0], np.cumsum(units)])
    unit = unit_begin[left_group] + place // 64
    lane = (place % 64).astype(np.uint64)
    planes = np.zeros((len(bits), int(unit_begin[-1])), dtype=np.uint64)
    valid = np.zeros(int(unit_begin[-1]), dtype=np.uint64)
    row_of = np.zeros((int(unit_begin[-1]), 64), dtype=np.int64)
    first = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    one = np.uint64(1)
    for k, bit in enumerate(bits):
        planes[k, unit[first]] = np.bitwise_or.reduceat((planes_of[left] >> np.uint64(bit) & one) << lane, first)
    valid[unit[first]] = np.bitwise_or.reduceat(one << lane, first)
    row_of[unit, lane.astype(np.int64)] = left
    # A task is one row against one unit of its group.
    right = np.flatnonzero(side != 0)
    tasks_of = units[group_no[right]]
    ends = np.cumsum(tasks_of)
    at, most = 0, 1 << 14
    while at < len(right):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        rows = np.repeat(right[at:stop], tasks_of[at:stop])
        inside = np.arange(len(rows)) - np.repeat(np.cumsum(tasks_of[at:stop]) - tasks_of[at:stop], tasks_of[at:stop])
        target = unit_begin[group_no[rows]] + inside
        lanes = valid[target].copy()
        both = side[rows] == 2  # each pair once: lanes before the row's own place
        before = np.clip(rows - begin[group_no[rows]] - 64 * inside, 0, 64)
        mask = np.where(before >= 64, ~np.uint64(0), (one << np.minimum(before, 63).astype(np.uint64)) - one)
        lanes = np.where(both, lanes & mask, lanes)
        on = lanes != 0
        rows, target, lanes = rows[on], target[on], lanes[on]
        query = np.stack([np.uint64(0) - (planes_of[rows] >> np.uint64(bit) & one) for bit in bits])
        hit = within_radius(planes, lanes, target, query, radius)
        some = np.flatnonzero(hit)
        if len(some):
            grid = np.unpackbits(hit[some].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            task, which = np.nonzero(grid)
            label = merge(label, rows[some[task]], row_of[target[some[task]], which])
        at = stop
    return label


def merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Join the classes of the linked rows ``a`` and ``b``; labels are least row numbers."""
    while True:
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            return label
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label = further


def compare_buckets(blocks: list[tuple[int, int]], pairs: list[tuple[int, int]], radius: int):
    """Task function over rows sorted by (table, key, tiles): links inside every bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def flush(rows: np.ndarray):
            table, key, a, b, tile, value = rows.T
            for t in np.unique(table):
                on = table == t
                same_left = a[on] == b[on]
                side = np.where(same_left, 2, np.where(tile[on] == a[on], 0, 1))
                names = np.stack([key[on], a[on], b[on]], axis=1)
                change = np.concatenate([[True], (names[1:] != names[:-1]).any(axis=1)])
                # Bits of the key are equal in the bucket: only the others are compared.
                bits = [i for k, (lo, hi) in enumerate(blocks) if k not in pairs[t] for i in range(lo, hi)]
                values = np.ascontiguousarray(value[on])
                label = local_roots(values, np.cumsum(change), side, bits, radius)
                linked = label != np.arange(len(label))
                yield pa.RecordBatch.from_arrays([pa.array(values[linked]), pa.array(values[label[linked]])], ["a", "b"])

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns], axis=1))
            if sum(map(len, held)) < 1 << 16:
                continue
            rows = np.concatenate(held)
            # The last group may go on in the next batch.
            cut = int(np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(axis=1)).max(initial=-1)) + 1
            held = [rows[cut:]]
            if cut:
                yield from flush(rows[:cut])
        if held and sum(map(len, held)):
            yield from flush(np.concatenate(held))

    return run


def links(prints: DataFrame, radius: int, tile: int = 4096) -> DataFrame:
    """(a, b): links that connect the distinct fingerprints within ``radius`` bits.

    The 64 bits are cut into ``radius + 2`` blocks; two fingerprints within the
    radius agree in at least two of them, so they meet in the bucket of some
    pair of blocks. A bucket sends back one link per member to its local class,
    not its pairs. Buckets above ``tile`` members are compared tile by tile, so
    no task holds more than two tiles of one bucket.
    """
    n_blocks = radius + 2
    edges = [round(64 * k / n_blocks) for k in range(n_blocks + 1)]
    blocks = list(zip(edges, edges[1:]))
    pairs = list(combinations(range(n_blocks), 2))

    def block(k: int) -> Column:
        lo, hi = blocks[k]
        return F.shiftrightunsigned("_fp", lo).bitwiseAND((1 << (hi - lo)) - 1)

    keys = [
        F.struct(F.lit(t).alias("table"), (F.shiftleft(block(i), blocks[j][1] - blocks[j][0]).bitwiseOR(block(j))).alias("key"))
        for t, (i, j) in enumerate(pairs)
    ]
    keyed = prints.select("_fp", F.inline(F.array(*keys)))
    sizes = stage(keyed.groupBy("table", "key").count().filter("count > 1"))
    members = keyed.join(sizes, ["table", "key"]).withColumn("tiles", F.ceil(F.col("count") / tile).cast("int"))
    own = F.pmod(F.xxhash64("_fp"), F.col("tiles")).cast("int")
    placed = members.withColumn("tile", own).select(
        "table", "key", "tile", "_fp", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("other")
    )
    tasks = placed.select(
        "table", "key", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "_fp"
    )
    spread = tasks.repartition("table", "key", "a", "b").sortWithinPartitions("table", "key", "a", "b", "tile", "_fp")
    return spread.mapInArrow(compare_buckets(blocks, pairs, radius), "a long, b long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root): connected components by alternating large and small stars.

    Both steps replace the links of a node by links to the least node it knows.
    The minimum is a partial aggregate and comes back by a plain join, so a node
    with very many links is split between tasks. Every round is a staged table.
    """

    def normal(df: DataFrame) -> DataFrame:
        return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()

    def with_least(df: DataFrame) -> DataFrame:
        least = stage(df.groupBy("a").agg(F.min("b").alias("m")))
        return df.join(least, "a")

    edges = stage(normal(edges))
    state = None
    for _ in range(most_rounds):
        mirrored = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = stage(
            normal(with_least(mirrored).filter("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")))
        )
        small = with_least(large)
        edges = stage(
            normal(
                small.select(F.inline(F.array(
                    F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b"))
                )))
            )
        )
        seen = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if (seen["n"], seen["x"]) == state:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = (seen["n"], seen["x"])
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def _grouped(docs: DataFrame, id_col: str, text_col: str, shingle: int, radius: int) -> tuple[DataFrame, DataFrame]:
    prints = stage(add_fingerprints(docs, id_col, text_col, shingle))
    distinct = stage(prints.groupBy("_fp").agg(F.min("_id").alias("_least")))
    roots = components(links(distinct, radius))
    rooted = stage(
        distinct.join(roots, F.col("_fp") == F.col("node"), "left").select(
            "_fp", "_least", F.coalesce("root", "_fp").alias("_root")
        )
    )
    named = rooted.groupBy("_root").agg(F.min("_least").alias("_component"))
    return prints, stage(rooted.join(named, "_root").select("_fp", "_root", "_component"))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2,
    output: tuple[str, str, str] = ("fingerprint", "component_id", "group_key"),
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint, the smallest id reachable
    over links of at most ``radius`` bits, and a key of the group.

    Texts are compared whole. Null and empty texts have fingerprint zero and
    link like others; texts shorter than a shingle are one shingle. Repeated
    rows give repeated rows in the same group. Null ids rank last: the id of a
    group is null only if all its ids are. Extra columns are ignored and an
    empty table gives no rows.

    Copies are merged to one fingerprint before anything is compared.
    """
    prints, named = _grouped(docs, id_col, text_col, shingle, radius)
    hexed = F.lpad(F.lower(F.hex("_fp")), 16, "0")
    return prints.join(named, "_fp").select(
        F.col("_id").alias(id_col), hexed.alias(output[0]), F.col("_component").alias(output[1]),
        F.lpad(F.lower(F.hex("_root")), 16, "0").alias(output[2]),
    )


def keep_one_per_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the
    smallest id (null ids last), then the smallest hash of the text. Rows that
    repeat its id and text are dropped too, whatever their other columns hold.
    Columns of any name are kept; an empty table gives no rows."""
    prints, named = _grouped(docs, id_col, text_col, shingle, radius)
    rank = F.struct(F.col("_id").isNull(), F.col("_id").alias("id"), F.col("_th").alias("th"))
    # Partial minimum per fingerprint, then per group: no group of copies gathers.
    best = stage(prints.groupBy("_fp").agg(F.min(rank).alias("_best")))
    keepers = best.join(named, "_fp").groupBy("_root").agg(F.min("_best").alias("_best"))
    kid, kth, hashed = (free_name(n, docs) for n in ("_kid", "_kth", "_row_hash"))
    keepers = stage(keepers.select(F.col("_best.id").alias(kid), F.col("_best.th").alias(kth)).distinct())
    rows = docs.withColumn(hashed, F.xxhash64(col(text_col)))
    same = col(id_col).eqNullSafe(F.col(kid)) & (F.col(hashed) == F.col(kth))
    return rows.join(keepers, same, "left_semi").dropDuplicates([id_col, hashed]).drop(hashed)


def op6_simhash(documents: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, fingerprint, component_id."""
    return near_duplicates(documents.select("doc_id", "text")).drop("group_key")
