"""Hard negatives by inner product: rows that score somewhat below a positive but
bear another label, found in an R-tree packed by sort-tile-recursion."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col
from phenoloom.session import stage

NONE, MOST = -(1 << 62), 1 << 62  # below and above every score that is compared
NULL_ID = (1 << 63) - 1
BATCH = pa.RecordBatch.from_arrays


def products(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, bool]:
    """Inner products of all rows of two integer matrices, and whether none was clipped.

    Products that doubles hold exactly are made in doubles, others in exact integers.
    """
    size = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (a, b)]
    largest = size[0] * size[1] * max(1, a.shape[1])
    if largest < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64), True
    exact = a.astype(object) @ b.T.astype(object)
    return np.clip(exact, NONE + 1, MOST - 1).astype(np.int64), largest < 1 << 60


def str_leaves(vectors: np.ndarray, labels: np.ndarray, size: int) -> list[np.ndarray]:
    """Rows of a tile dealt into leaves of one label and at most ``size`` rows:
    sorted and cut along the two coordinates that vary most."""

    def cut(rows: np.ndarray, axes: list[int]) -> list[np.ndarray]:
        n = math.ceil(len(rows) / size)
        if n == 1 or not axes:
            return [rows[i : i + size] for i in range(0, len(rows), size)]
        rows = rows[np.argsort(vectors[rows, axes[0]], kind="stable")]
        slab = size * math.ceil(n / math.ceil(n ** (1 / len(axes))))
        return [leaf for i in range(0, len(rows), slab) for leaf in cut(rows[i : i + slab], axes[1:])]

    out = []
    for label in np.unique(labels):
        rows = np.flatnonzero(labels == label)
        axes = np.argsort(-vectors[rows].astype(np.float64).var(axis=0), kind="stable")[:2].tolist()
        out += cut(rows, axes)
    return out


@dataclass
class Boxes:
    """Minimum bounding boxes of tree nodes and the range of their labels."""

    lo: np.ndarray
    hi: np.ndarray
    label_lo: np.ndarray
    label_hi: np.ndarray

    @classmethod
    def around(cls, groups: list[np.ndarray], lo, hi, label_lo, label_hi) -> Boxes:
        return cls(
            np.array([lo[g].min(axis=0) for g in groups]), np.array([hi[g].max(axis=0) for g in groups]),
            np.array([label_lo[g].min() for g in groups]), np.array([label_hi[g].max() for g in groups]),
        )

    def intervals(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product that a point of each box can have with each
        row of ``q``: coordinate by coordinate, the box's nearer and farther side."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        parts = [products(*x) for x in ((up, self.lo), (down, self.hi), (up, self.hi), (down, self.lo))]
        if not all(exact for _, exact in parts):
            return np.full(parts[0][0].shape, NONE), np.full(parts[0][0].shape, MOST)
        return parts[0][0] + parts[1][0], parts[2][0] + parts[3][0]

    def arrays(self) -> list[pa.Array]:
        lists = [pa.array(list(x), pa.list_(pa.int64())) for x in (self.lo, self.hi)]
        return [*lists, pa.array(self.label_lo), pa.array(self.label_hi)]

    @classmethod
    def read(cls, record, prefix: str = "") -> Boxes:
        lists = [np.array(record.column(prefix + n).to_pylist(), dtype=np.int64) for n in ("lo", "hi")]
        return cls(*lists, *[_numbers(record.column(prefix + n)) for n in ("label_lo", "label_hi")])


def _numbers(column) -> np.ndarray:
    return column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False)


BOX_FIELDS = [
    T.StructField("lo", T.ArrayType(T.LongType(), False)), T.StructField("hi", T.ArrayType(T.LongType(), False)),
    T.StructField("label_lo", T.LongType()), T.StructField("label_hi", T.LongType()),
]
QUERY_FIELDS = [T.StructField("block", T.LongType()), *[
    T.StructField(n, T.BinaryType()) for n in ("rows", "vectors", "ids", "labels", "low", "high", "floor")
]]


@dataclass
class Queries:
    """Anchors of one block, with the score windows (one or more each) they search.

    ``low`` to ``high`` is a window; ``floor`` is the least score that can still
    be among the first ``k``.
    """

    block: int
    rows: np.ndarray
    vectors: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    low: np.ndarray
    high: np.ndarray
    floor: np.ndarray

    def take(self, some: np.ndarray) -> Queries:
        return Queries(self.block, *[getattr(self, f.name)[some] for f in QUERY_FIELDS[1:]])

    def values(self) -> list:
        return [self.block, *[np.ascontiguousarray(getattr(self, f.name)).tobytes() for f in QUERY_FIELDS[1:]]]

    @classmethod
    def read(cls, record: dict) -> Queries:
        flat = {f.name: np.frombuffer(record[f.name], dtype=np.int64) for f in QUERY_FIELDS[1:]}
        n = len(flat["rows"])
        wide = {k: v.reshape(n, len(v) // max(1, n)) if k in ("vectors", "low", "high", "floor") else v for k, v in flat.items()}
        return cls(record["block"], **wide)

    def alive(self, boxes: Boxes, least: np.ndarray, largest: np.ndarray, same: bool) -> np.ndarray:
        """(query, window, box): a box that may hold a wanted row. Boxes outside the
        window or strictly below the floor are not, nor those of no fitting label."""
        own = self.labels[:, None]
        if same:
            fit = (boxes.label_lo <= own) & (own <= boxes.label_hi)
        else:
            fit = (boxes.label_lo != own) | (boxes.label_hi != own)
        above = largest[:, None, :] >= np.maximum(self.low, self.floor)[:, :, None]
        return fit[:, None, :] & above & (least[:, None, :] <= self.high[:, :, None])


def search(queries: Queries, vectors: np.ndarray, ids: np.ndarray, labels: np.ndarray, leaves: list[np.ndarray], same: bool, k: int):
    """First ``k`` rows of a tile for every query and window: (query, window, score, id).

    A queue gives the leaf with the highest possible score first; a leaf is left
    out when it is below every query's k-th score so far or outside its windows.
    """
    leaves = [leaf[np.argsort(ids[leaf], kind="stable")] for leaf in leaves]
    boxes = Boxes.around(leaves, vectors, vectors, labels, labels)
    least, largest = boxes.intervals(queries.vectors)
    alive = queries.alive(boxes, least, largest, same).any(axis=1)
    queue = [(-int(largest[alive[:, b], b].max()), b) for b in range(len(leaves)) if alive[:, b].any()]
    heapq.heapify(queue)
    top = np.full((*queries.low.shape, k), NONE)  # the scores found so far
    found = []
    queries = replace(queries, floor=queries.floor.copy())
    while queue:
        b = heapq.heappop(queue)[1]
        here = Boxes(*[x[b : b + 1] for x in (boxes.lo, boxes.hi, boxes.label_lo, boxes.label_hi)])
        use = np.flatnonzero(queries.alive(here, least[:, b : b + 1], largest[:, b : b + 1], same).any(axis=(1, 2)))
        if not len(use):
            continue
        q, leaf = queries.take(use), leaves[b]
        score, _ = products(q.vectors, vectors[leaf])
        fit = (labels[leaf] == q.labels[:, None]) == same
        if same:
            fit &= ids[leaf] != q.ids[:, None]
        inside = fit[:, None, :] & (score[:, None, :] >= np.maximum(q.low, q.floor)[:, :, None]) & (score[:, None, :] <= q.high[:, :, None])
        masked = np.where(inside, score[:, None, :], NONE)
        best = np.concatenate([top[use], masked], axis=2)
        best.partition(best.shape[2] - k, axis=2)
        top[use] = best[:, :, -k:]
        floor = np.maximum(q.floor, best[:, :, -k])
        queries.floor[use] = floor
        # Rows above the k-th score, and the first k of those equal to it, in order of their ids.
        equal = masked == floor[:, :, None]
        keep = inside & ((masked > floor[:, :, None]) | (equal & (np.cumsum(equal, axis=2) <= k)))
        at, window, row = np.nonzero(keep)
        found.append((use[at], window, masked[at, window, row], ids[leaf[row]]))
    at, window, score, found_id = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, dtype=np.int64)] * 4
    order = np.lexsort((found_id, -score, window, at))
    at, window, score, found_id = (x[order] for x in (at, window, score, found_id))
    new = np.flatnonzero(np.diff(at, prepend=-1) | np.diff(window, prepend=-1))
    rank = np.arange(len(at)) - np.repeat(new, np.diff(new, append=len(at)))
    return at[rank < k], window[rank < k], score[rank < k], found_id[rank < k]


def _tiles(rows: DataFrame, width: int, slabs: int, tile_rows: int, leaf_rows: int, n_positives: int) -> DataFrame:
    """One record per tile of the tree, with the anchors in it.

    The first cuts are Spark's: ranges over label and first coordinate, ties
    broken by a hash so that equal rows spread, then order by the second
    coordinate inside a range.
    """
    axis = [F.coalesce(F.get("vector", F.lit(k)), F.lit(0)) for k in (0, 1)]
    dealt = (
        rows.select("id", "label", "vector", "anchor", axis[0].alias("_0"), axis[1].alias("_1"), F.xxhash64("id", "vector").alias("_tie"))
        .repartitionByRange(slabs, "label", "_0", "_tie").sortWithinPartitions("label", "_1", "_tie")
        .select("id", "label", "vector", "anchor")
    )
    schema = T.StructType([
        T.StructField("slab", T.IntegerType()), T.StructField("tile", T.LongType()), *BOX_FIELDS,
        T.StructField("vectors", T.BinaryType()), T.StructField("ids", T.BinaryType()), T.StructField("labels", T.BinaryType()),
        T.StructField("anchors", T.BinaryType()), T.StructField("floors", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slab, number, held = TaskContext.get().partitionId(), 0, []

        def pack(table: pa.Table) -> pa.RecordBatch:
            n, lists = len(table), table.column("vector").combine_chunks()
            ends = np.asarray(lists.offsets)
            vectors = np.zeros((n, width), dtype=np.int64)
            within = np.arange(ends[-1] - ends[0]) - np.repeat(ends[:-1] - ends[0], np.diff(ends))
            vectors[np.repeat(np.arange(n), np.diff(ends)), within] = lists.flatten().to_numpy(zero_copy_only=False)
            ids = table.column("id").combine_chunks().fill_null(NULL_ID).to_numpy(zero_copy_only=False)
            labels = _numbers(table.column("label"))
            order = np.concatenate(str_leaves(vectors, labels, leaf_rows))
            vectors, ids, labels = vectors[order], ids[order], labels[order]
            box = Boxes.around([np.arange(n)], vectors, vectors, labels, labels)
            anchors = np.flatnonzero(_numbers(table.column("anchor"))[order])
            # The anchors' own tile gives a first bound for their last positive.
            floors = np.full(len(anchors), NONE)
            for at in range(0, len(anchors), 256):
                some = anchors[at : at + 256]
                score, _ = products(vectors[some], vectors)
                score[(labels != labels[some][:, None]) | (ids == ids[some][:, None])] = NONE
                if n >= n_positives:
                    floors[at : at + 256] = np.partition(score, n - n_positives, axis=1)[:, n - n_positives]
            blobs = [pa.array([x.astype(np.int64).tobytes()]) for x in (vectors, ids, labels, anchors, floors)]
            return BATCH([pa.array([slab], pa.int32()), pa.array([slab << 32 | number]), *box.arrays(), *blobs], schema.fieldNames())

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= tile_rows:
                table = pa.Table.from_batches(held)
                yield pack(table.slice(0, tile_rows))
                number, held = number + 1, table.slice(tile_rows).to_batches()
        if sum(b.num_rows for b in held):
            yield pack(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, schema)


def _nodes(tiles: DataFrame) -> DataFrame:
    """One record per slab: its box and those of its tiles."""
    names = ["tile", *[f.name for f in BOX_FIELDS]]
    boxes = tiles.select("slab", F.struct(*names).alias("box")).groupBy("slab").agg(F.collect_list("box").alias("boxes"))
    schema = T.StructType([T.StructField("slab", T.IntegerType()), *BOX_FIELDS, boxes.schema["boxes"]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                own = Boxes.read(pa.RecordBatch.from_struct_array(row.column("boxes").flatten()))
                all_of = Boxes.around([np.arange(len(own.lo))], own.lo, own.hi, own.label_lo, own.label_hi)
                yield BATCH([row.column("slab"), *all_of.arrays(), row.column("boxes")], schema.fieldNames())

    return boxes.mapInArrow(run, schema)


def _blocks(tiles: DataFrame, width: int, block_rows: int) -> DataFrame:
    """Anchors of neighbouring tiles in blocks, each searching its positives."""
    schema = T.StructType(QUERY_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, held = TaskContext.get().partitionId(), 0, []

        def made(some: list[tuple]) -> pa.RecordBatch:
            vectors, ids, labels, floors = (np.concatenate(x) for x in zip(*some))
            n = len(ids)
            block = Queries(
                part << 32 | number, np.arange(n), vectors, ids, labels,
                np.full((n, 1), NONE + 1), np.full((n, 1), MOST), floors.reshape(n, 1),
            )
            return BATCH([pa.array([v]) for v in block.values()], schema.fieldNames())

        for batch in batches:
            for row in batch.to_pylist():
                flat = {k: np.frombuffer(row[k], dtype=np.int64) for k in ("vectors", "ids", "labels", "anchors", "floors")}
                vectors = flat["vectors"].reshape(len(flat["ids"]), width)
                for at in range(0, len(flat["anchors"]), block_rows):
                    rows = flat["anchors"][at : at + block_rows]
                    held.append((vectors[rows], flat["ids"][rows], flat["labels"][rows], flat["floors"][at : at + block_rows]))
                    if sum(len(h[1]) for h in held) >= block_rows:
                        yield made(held)
                        number, held = number + 1, []
        if held:
            yield made(held)

    return tiles.select("vectors", "ids", "labels", "anchors", "floors").mapInArrow(run, schema)


@dataclass
class Tree:
    """The packed tree as tables: ``tiles``, and ``nodes`` (slabs over tiles); the
    root is on the driver, at most ``slabs`` boxes."""

    tiles: DataFrame
    nodes: DataFrame
    root: list
    salts: int
    parts: int


def _routed(queries: Queries, boxes: Boxes, keys: list, salts: int, same: bool) -> Iterator[list]:
    """(key, salt, queries) for every box that some of the queries must look into."""
    least, largest = boxes.intervals(queries.vectors)
    alive = queries.alive(boxes, least, largest, same).any(axis=1)
    for b in np.flatnonzero(alive.any(axis=0)):
        salt = (queries.block ^ queries.block >> 32) % salts
        yield [keys[b], salt, *queries.take(np.flatnonzero(alive[:, b])).values()]


def descend(blocks: DataFrame, tree: Tree, same: bool, k: int) -> DataFrame:
    """(block, row, window, score, id): for every anchor and window the first ``k`` of each tile."""
    salts = tree.salts
    root = Boxes(*[np.array([r[f.name] for r in tree.root], dtype=np.int64) for f in BOX_FIELDS])
    slabs = [r["slab"] for r in tree.root]
    routed = lambda key, kind: T.StructType([
        T.StructField(key, kind), T.StructField("salt", T.IntegerType()), *QUERY_FIELDS
    ])
    to_slabs, to_tiles = routed("slab", T.IntegerType()), routed("tile", T.LongType())
    arrow = {T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}
    hits = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("row", T.LongType()), T.StructField("window", T.LongType()),
        T.StructField("score", T.LongType()), T.StructField("id", T.LongType()),
    ])

    def batch_of(records: list[list], schema: T.StructType) -> pa.RecordBatch:
        columns = list(zip(*records)) or [[] for _ in schema]
        return BATCH([pa.array(list(c), arrow[f.dataType]) for c, f in zip(columns, schema)], schema.fieldNames())

    def at_root(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for record in _routed(Queries.read(row), root, slabs, salts, same):
                    yield batch_of([record], to_slabs)

    def at_slab(node: pa.Table, queries: pa.Table) -> pa.Table:
        records = []
        if len(node) and len(queries):
            found = pa.RecordBatch.from_struct_array(node.column("boxes").combine_chunks().flatten())
            boxes, keys = Boxes.read(found), found.column("tile").to_pylist()
            for row in queries.to_pylist():
                records += _routed(Queries.read(row), boxes, keys, salts, same)
        return pa.Table.from_batches([batch_of(records, to_tiles)])

    def at_tile(tile: pa.Table, queries: pa.Table) -> pa.Table:
        out = []
        if len(tile) and len(queries):
            row = tile.to_pylist()[0]
            ids, labels = (np.frombuffer(row[n], dtype=np.int64) for n in ("ids", "labels"))
            vectors = np.frombuffer(row["vectors"], dtype=np.int64).reshape(len(ids), len(row["lo"]))
            leaves = str_leaves(vectors, labels, row["leaf_rows"])
            for query in queries.to_pylist():
                q = Queries.read(query)
                at, window, score, found = search(q, vectors, ids, labels, leaves, same, k)
                out.append(BATCH(
                    [pa.array(np.full(len(at), q.block)), *[pa.array(x.astype(np.int64)) for x in (q.rows[at], window, score, found)]],
                    hits.fieldNames(),
                ))
        return pa.Table.from_batches(out or [BATCH([pa.array([], pa.int64()) for _ in hits], hits.fieldNames())])

    salted = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")

    def meet(side: DataFrame, queries: DataFrame, key: str, run, schema: T.StructType) -> DataFrame:
        left = side.select("*", salted).repartition(tree.parts, key, "salt").groupBy(key, "salt")
        return left.cogroup(queries.repartition(tree.parts, key, "salt").groupBy(key, "salt")).applyInArrow(run, schema)

    down = blocks.select(*[f.name for f in QUERY_FIELDS]).mapInArrow(at_root, to_slabs)
    down = meet(tree.nodes.select("slab", "boxes"), down, "slab", at_slab, to_tiles)
    tiles = tree.tiles.select("tile", "lo", "vectors", "ids", "labels", "leaf_rows")
    return meet(tiles, down, "tile", at_tile, hits)


def _first(hits: DataFrame, k: int) -> DataFrame:
    """The first ``k`` over all tiles, ranked from 1; Spark cuts each side's groups before the exchange too."""
    order = Window.partitionBy("block", "row", "window").orderBy(F.desc("score"), F.asc("id"))
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _with_windows(blocks: DataFrame, positives: DataFrame, n_positives: int, low_pct: int, high_pct: int) -> DataFrame:
    """Blocks that search, for each positive of an anchor, the scores between two shares of its score."""
    per_block = positives.groupBy("block").agg(F.collect_list(F.struct("row", "rank", "score")).alias("positives"))
    joined = blocks.join(per_block, "block")
    schema = T.StructType(QUERY_FIELDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for record in batch.to_pylist():
                q = Queries.read(record)
                shape = (len(q.rows), n_positives)
                low, high = np.full(shape, MOST), np.full(shape, NONE)  # no window without a positive
                for p in record["positives"]:
                    # low_pct * positive <= 100 * negative <= high_pct * positive
                    at = p["row"], p["rank"] - 1
                    low[at], high[at] = -(-low_pct * p["score"] // 100), high_pct * p["score"] // 100
                q = replace(q, low=low, high=high, floor=np.full(shape, NONE))
                yield BATCH([pa.array([v]) for v in q.values()], schema.fieldNames())

    return joined.mapInArrow(run, schema)


def mine_hard_negatives(
    vectors: DataFrame, anchor: Column, id_col: str = "vec_id", vector_col: str = "vector", label_col: str = "label",
    n_positives: int = 5, n_negatives: int = 3, low_pct: int = 50, high_pct: int = 95,
    tile_rows: int = 2048, leaf_rows: int = 256, block_rows: int = 256, most_slabs: int = 1024,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``vectors`` has whole numbers as components; scores are exact inner products,
    and ties go to the smaller id. An anchor's positives are its first
    ``n_positives`` other rows of the same label; for each, the first
    ``n_negatives`` rows of another label count whose score lies between
    ``low_pct`` and ``high_pct`` percent of the positive's.

    Rows with a null label, vector or component take no part. Shorter vectors
    count as if zeros followed. Rows with the same id are never each other's
    positives; each of them is searched, found and, as an anchor, reported by
    itself. A null id counts as the largest. Scores beyond 2**62 are clipped
    there. An anchor without positives, or a positive without negatives, has no
    rows; an empty table gives none. Extra columns are ignored.

    The tree: ranges of rows over label and first coordinate (slabs), tiles of
    ``tile_rows`` in order of the second, leaves inside a tile. Anchors go down
    in blocks of neighbours; each level drops the boxes whose inner-product
    interval is outside an anchor's windows or strictly below the bound of its
    k-th score, which the anchor's own tile gives first. A block meets a node in
    one task by an equi-join on the node and a salt of the block, so neither
    side gathers; only the root, at most ``most_slabs`` boxes, is on the driver.
    Every tile's own firsts are ranked together at the end.
    """
    label = F.col("_label") if vectors.schema[label_col].dataType.typeName() in ("byte", "short", "integer", "long") else F.xxhash64("_label")
    rows = (
        vectors.select(
            col(id_col).cast("long").alias("id"), col(label_col).alias("_label"),
            col(vector_col).cast("array<bigint>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        )
        .filter(F.col("_label").isNotNull() & F.coalesce(F.forall("vector", lambda x: x.isNotNull()), F.lit(False)))
        .select("id", label.cast("long").alias("label"), "vector", "anchor")
    )
    spark = vectors.sparkSession
    n, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    slabs = max(1, min(most_slabs, math.ceil(math.sqrt(n / tile_rows))))
    tiles = stage(_tiles(rows, width or 0, slabs, tile_rows, leaf_rows, n_positives)).withColumn("leaf_rows", F.lit(leaf_rows))
    nodes = stage(_nodes(tiles))
    blocks = stage(_blocks(tiles, width or 0, block_rows))
    root = nodes.drop("boxes").collect()  # at most ``most_slabs`` boxes
    salts = max(1, math.ceil(blocks.count() / 64))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tree = Tree(tiles, nodes, root, salts, min(10_000, max(parts, math.ceil(n / tile_rows) * salts // 8)))
    positives = stage(_first(descend(blocks, tree, True, n_positives), n_positives))
    searching = _with_windows(blocks, positives, n_positives, low_pct, high_pct)
    negatives = _first(descend(searching, tree, False, n_negatives), n_negatives)
    anchors = blocks.select("block", "rows", "ids")
    named = T.StructType([T.StructField(x, T.LongType()) for x in ("block", "row", "anchor_id")])

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                at, ids = (np.frombuffer(row[x], dtype=np.int64) for x in ("rows", "ids"))
                yield BATCH([pa.array(np.full(len(at), row["block"])), pa.array(at), pa.array(ids)], named.fieldNames())

    chosen = positives.select("block", "row", (F.col("rank") - 1).alias("window"), F.col("id").alias("_p"), F.col("score").alias("positive_score"))
    chosen = chosen.join(anchors.mapInArrow(listed, named), ["block", "row"])
    real = lambda c: F.when(F.col(c) != NULL_ID, F.col(c))
    return negatives.join(chosen, ["block", "row", "window"]).select(
        real("anchor_id").alias("anchor_id"), real("_p").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
        real("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )


def op12_hard_negatives(embeddings: DataFrame) -> DataFrame:
    """Contract of the query: anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    rows = embeddings.filter(F.coalesce(whole, F.lit(False))).select(
        "vec_id", label.alias("label"), F.transform("embedding", lambda x: F.floor(x.cast("double") * 256)).alias("vector"),
    )
    return mine_hard_negatives(rows, F.col("vec_id") % 50 == 0)
