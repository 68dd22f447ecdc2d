"""Lines below marker lines, found where the logs are read.

A scan keeps lines in their partition and carries what a marker still waits for
along it. A *run* is a stretch of lines of one block in one partition; of every
run only its first lines leave the task, and of a marker only the line it asks
for.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.session import stage

FOUND, HEAD, WAITING = "found", "head", "waiting"

SCAN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("file", T.StringType()), T.StructField("block", T.LongType()),
    T.StructField("line", T.LongType()), T.StructField("fact", T.IntegerType()), T.StructField("text", T.StringType()),
    T.StructField("first", T.LongType()), T.StructField("need", T.IntegerType()),
    T.StructField("head", T.ArrayType(T.StringType())),
])


@dataclass(frozen=True)
class Marker:
    """Lines that begin with ``text`` ask for the line ``below`` lines further down (0: their own)."""

    text: str
    below: int


def _records(kind: str, table: pa.Table, rows: np.ndarray, **given: pa.Array) -> pa.RecordBatch:
    """Output records about some rows of the table; columns not given are null."""
    at = pa.array(rows)
    columns = {n: table.column(n).take(at).combine_chunks() for n in ("file", "block", "line")}
    columns |= {"kind": pa.array([kind] * len(rows), pa.string())} | given
    types = pa.schema([
        ("kind", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("line", pa.int64()), ("fact", pa.int32()),
        ("text", pa.string()), ("first", pa.int64()), ("need", pa.int32()), ("head", pa.list_(pa.string())),
    ])
    made = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(len(rows), f.type) for f in types]
    return pa.RecordBatch.from_arrays(made, schema=types)


class CarryScan:
    """The state that goes from one batch of a partition to the next: the last lines
    of an open run, whether its head has been sent, and where it began."""

    def __init__(self, markers: Sequence[Marker]):
        self.markers, self.depth = markers, max(m.below for m in markers)
        self.held: pa.Table | None = None
        self.sent, self.began = False, 0

    def feed(self, batch: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        """Records of the lines that are complete; ``None`` closes the partition."""
        new = [] if batch is None else [pa.Table.from_batches([batch])]
        table = pa.concat_tables(([self.held] if self.held is not None else []) + new) if new or self.held is not None else None
        n = 0 if table is None else len(table)
        if n == 0:
            return
        table = table.combine_chunks()
        block, file = table.column("block").to_numpy(), table.column("file")
        other = np.ones(n, dtype=bool)
        other[1:] = (block[1:] != block[:-1]) | pc.not_equal(file[1:], file[:-1]).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(other)
        ends = np.append(starts[1:], n)
        sent = np.zeros(len(starts), dtype=bool)
        sent[0] = self.sent
        line = table.column("line").to_numpy()
        began = line[starts]
        if self.sent:
            began[0] = self.began
        # Lines before ``cut`` have all they may ask for in the table, or their run has ended.
        cut = n if batch is None else max(int(starts[-1]), n - self.depth)
        open_head = batch is not None and (sent[-1] or cut > starts[-1])
        ready = ~sent if batch is None else ~sent & np.append(np.ones(len(starts) - 1, dtype=bool), open_head)
        yield self._heads(table, starts[ready], ends[ready])
        run = np.cumsum(other) - 1
        for fact, marker in enumerate(self.markers):
            hit = np.flatnonzero(pc.fill_null(pc.starts_with(table.column("value"), marker.text), False).to_numpy(zero_copy_only=False))
            hit = hit[hit < cut]
            over = hit + marker.below - ends[run[hit]]
            inside, waits = hit[over < 0], hit[over >= 0]
            facts = lambda rows: pa.array(np.full(len(rows), fact))  # noqa: B023, E731
            if len(inside):
                yield _records(FOUND, table, inside, fact=facts(inside), text=table.column("value").take(pa.array(inside + marker.below)).combine_chunks())
            if len(waits):
                yield _records(WAITING, table, waits, fact=facts(waits), first=pa.array(began[run[waits]]), need=pa.array(over[over >= 0] + 1))
        self.held, self.sent, self.began = table.slice(cut), open_head, int(began[-1])

    def _heads(self, table: pa.Table, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        size = np.minimum(ends - starts, max(1, self.depth))
        offsets = np.concatenate([[0], np.cumsum(size)])
        rows = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, size)
        lines = table.column("value").take(pa.array(rows)).combine_chunks()
        return _records(HEAD, table, starts, first=pa.array(table.column("line").to_numpy()[starts]), head=pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), lines))


def scan_markers(lines: DataFrame, markers: Sequence[Marker]) -> DataFrame:
    """The staged records of one pass over the lines: heads of runs, lines found, and markers that wait."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = CarryScan(markers)
        for batch in batches:
            if batch.num_rows:
                yield from scan.feed(batch)
        yield from scan.feed(None)

    narrow = lines.select(F.coalesce("file", F.lit("")).alias("file"), F.col("block").cast("long"), F.col("line").cast("long"), "value")
    return stage(narrow.mapInArrow(run, SCAN))


def lines_below(lines: DataFrame, markers: Sequence[Marker]) -> tuple[DataFrame, DataFrame]:
    """(file, at, fact, text) of every marker with a line below it, and all files, once per run.

    ``fact`` is the marker's place in ``markers`` and ``at`` orders the markers
    of a file. A marker may wait for lines of the next blocks: what it gets there
    comes from the heads of the runs, one record per run, ordered per file.

    The lines must be as they were read, not exchanged in between: in order
    within a block, which may be cut over partitions. Null files count as ''.
    """
    scanned = scan_markers(lines, markers)
    heads = scanned.filter(F.col("kind") == HEAD).select("file", "block", "first", "head")
    depth = max(m.below for m in markers)
    found = scanned.filter(F.col("kind") == FOUND).select("file", F.struct("block", "line").alias("at"), "fact", "text")
    if depth:
        order = Window.partitionBy("file").orderBy("block", "first")
        nothing = F.array().cast("array<string>")
        after = F.concat(*[F.coalesce(F.lead("head", i).over(order), nothing) for i in range(1, depth + 1)])
        next_lines = heads.select("file", "block", "first", after.alias("after"))
        waiting = scanned.filter(F.col("kind") == WAITING).join(next_lines, ["file", "block", "first"])
        text = F.get("after", F.col("need") - 1)
        found = found.unionByName(
            waiting.select("file", F.struct("block", "line").alias("at"), "fact", text.alias("text")).filter("text IS NOT NULL")
        )
    return found, heads.select("file")
