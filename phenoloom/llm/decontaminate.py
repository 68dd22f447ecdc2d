"""Benchmark passages in training documents: shared word n-grams find them, local
alignment measures them."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col, free_name, worker_memo
from phenoloom.session import stage

WORD = re.compile(r"[^\W_]+")
FILTER_BITS = 22  # size of the filter of n-grams sent to the tasks: half a megabyte
MATCH, MISMATCH, GAP = 2, -1, -2
MOST_BROADCAST_IDS = 1_000_000  # some tens of megabytes


def word_hashes(text: str | None, most: int = 200_000) -> np.ndarray:
    """64-bit hashes of the lower-cased words of the whole text."""
    known = worker_memo("word_hashes", dict)
    if len(known) > most:
        known.clear()
    words = WORD.findall(text.lower()) if text else []
    try:
        values = [known[w] for w in words]
    except KeyError:
        for w in words:
            if w not in known:
                known[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "surrogatepass"))
        values = [known[w] for w in words]
    return np.array(values, dtype=np.uint64)


def forget_words() -> None:
    """At the end of a task: an idle worker need not hold its words."""
    worker_memo("word_hashes", dict).clear()


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` words."""
    if len(words) < n:
        return np.zeros(0, dtype=np.uint64)
    value = np.zeros(len(words) - n + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            value = (value ^ words[k : len(words) - n + 1 + k]) * np.uint64(0x9E3779B97F4A7C15)
            value ^= value >> np.uint64(29)
    return value


def smith_waterman(items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair of rows, and the window's place
    where it ends. Zeros are padding and match nothing."""
    n_pairs, width = windows.shape
    best, where = np.zeros(n_pairs, dtype=np.int32), np.zeros(n_pairs, dtype=np.int32)
    row = np.zeros((n_pairs, width + 1), dtype=np.int32)
    slope = -GAP * np.arange(width + 1, dtype=np.int32)
    for i in range(items.shape[1]):
        word = items[:, i : i + 1]
        step = np.where((windows == word) & (word != 0), MATCH, MISMATCH)
        next_row = np.maximum(row + GAP, 0)
        next_row[:, 1:] = np.maximum(next_row[:, 1:], row[:, :-1] + step)
        # A gap in the item costs the same for every word skipped: a running maximum.
        row = np.maximum.accumulate(next_row + slope, axis=1) - slope
        at = row.argmax(axis=1)
        top = row[np.arange(n_pairs), at]
        better = top > best
        best, where = np.where(better, top, best), np.where(better, at, where)
    return best, where


def _grams(df: DataFrame, id_col: str, text_col: str, n: int, filter_bytes: bytes | None) -> DataFrame:
    """(_id, gram, at, n_words) for the n-grams of every text that pass the filter."""
    plain = df.select(col(id_col).alias("_id"), col(text_col).alias("_text"))
    schema = T.StructType([
        plain.schema["_id"], T.StructField("gram", T.LongType()), T.StructField("at", T.IntegerType()),
        T.StructField("n_words", T.IntegerType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None if filter_bytes is None else np.frombuffer(filter_bytes, dtype=np.uint8)
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                docs, grams, places, sizes = [], [], [], []
                for i, text in enumerate(part.column("_text").to_pylist()):
                    words = word_hashes(text)
                    values = gram_hashes(words, n)
                    at = np.arange(len(values))
                    if table is not None:
                        slot = values >> np.uint64(64 - FILTER_BITS)
                        at = np.flatnonzero(table[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8) & 1)
                    docs.append(np.full(len(at), i)), grams.append(values[at]), places.append(at)
                    sizes.append(np.full(len(at), len(words)))
                rows = pa.array(np.concatenate(docs).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("_id").take(rows), pa.array(np.concatenate(grams).view(np.int64)),
                     pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(sizes).astype(np.int32))],
                    schema.fieldNames(),
                )
        forget_words()

    return plain.mapInArrow(run, schema)


def _filter_of(grams: DataFrame) -> bytes:
    """A bit per hash prefix that occurs: at most 2**FILTER_BITS bits, whatever the benchmark's size."""
    slot = F.shiftrightunsigned("gram", 64 - FILTER_BITS)
    words = grams.select(slot.alias("slot")).groupBy(F.shiftright("slot", 5).cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, int(slot & 31)))").alias("bits")
    )
    table = np.zeros(1 << (FILTER_BITS - 5), dtype="<u4")
    found = words.toPandas()
    table[found["word"].to_numpy(dtype=np.int64)] = found["bits"].to_numpy(dtype=np.int64).astype(np.uint32)
    return table.tobytes()


def _rare_seeds(grams: DataFrame, met: DataFrame, stretch: int = 8) -> DataFrame:
    """The seeds of every item: (item, gram, item_at), from all meetings of its n-grams.

    A meeting stands alone if the n-grams of the item that the document has within
    about the item's length all lie within ``stretch`` places of it in the item.
    Common words and phrases mostly stand alone; a copy, whole or edited, has
    other parts of the item too, so the number of copies says nothing about a
    gram. Grams that mostly stand alone are no seeds, but of each ``stretch``
    grams of an item the one that stands alone least stays, so every part of it
    has a seed. Items of no more than two stretches keep all.
    """
    place = F.floor(F.col("at") / F.col("n_words")).alias("place")
    spread = met.groupBy("doc", "item", place).agg(F.min("item_at").alias("lo"), F.max("item_at").alias("hi"))
    along = Window.partitionBy("doc", "item").orderBy("place").rangeBetween(-1, 1)
    around = spread.select("doc", "item", "place", F.min("lo").over(along).alias("lo"), F.max("hi").over(along).alias("hi"))
    near = (F.col("item_at") - F.col("lo") <= stretch) & (F.col("hi") - F.col("item_at") <= stretch)
    counted = (
        met.withColumn("place", place).join(around, ["doc", "item", "place"])
        .groupBy("item", "gram", "item_at").agg(F.sum(near.cast("int")).alias("n_alone"), F.count("*").alias("n"))
    )
    every = grams.join(counted, ["item", "gram", "item_at"], "left").withColumn("n_alone", F.coalesce("n_alone", F.lit(0)))
    part = Window.partitionBy("item", F.floor(F.col("item_at") / stretch)).orderBy("n_alone", "item_at")
    seldom = (2 * F.col("n_alone") <= F.col("n")) | (F.col("n_words") <= 2 * stretch)
    return every.withColumn("first", F.row_number().over(part)).filter(seldom | (F.col("first") == 1)).select("item", "gram", "item_at")


def find_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", n: int = 3, min_similarity: float = 0.5,
) -> DataFrame:
    """(id, item, similarity, n_item_words, end_word): documents that hold a
    benchmark item, whole or edited.

    Words are lower-cased runs of letters and digits. Rare n-grams of an item are
    its seeds: those that seldom stand alone in a document (see ``_rare_seeds``),
    however many copies of the item there are. Around every seed of a document, a Smith-Waterman alignment of words is scored as a
    share of the item's perfect score; pairs of at least ``min_similarity`` come
    back with their best alignment. A copy without any n-gram of the item is not
    found.

    Null and empty texts and items match nothing, and so do items of fewer than
    ``n`` words, which cannot be told from chance. Rows with the same id are one
    document or item, as are all rows with a null id. Texts are read whole.
    Extra columns are ignored; an empty table on either side gives no rows.

    The documents are read twice: for the n-grams that the benchmark has (a
    bit filter of fixed size, then exact joins), and for the windows around
    seeds. Pairs are (document, item) with a shared seed, nothing else. Texts
    without a seed are dropped before the exchange by a broadcast of the others' ids,
    as long as these are at most ``MOST_BROADCAST_IDS``.
    """
    own = stage(_grams(items, item_col, item_text_col, n, None).withColumnRenamed("_id", "item"))
    hits = stage(_grams(docs, id_col, text_col, n, _filter_of(own)).select(F.struct("_id").alias("doc"), "gram", "at"))
    grams = own.select(F.struct("item").alias("item"), "gram", F.col("at").alias("item_at"), "n_words")
    met = stage(hits.join(grams, "gram"))
    seeded = met.join(_rare_seeds(grams, met), ["item", "gram", "item_at"], "left_semi")
    # Windows of an item's length, in steps of half of it, with slack on both sides.
    step = F.ceil((F.col("n_words") + 8) / 2).cast("int")
    spots = seeded.select(
        "doc", "item", step.alias("step"), "n_words", F.floor((F.col("at") - F.col("item_at")) / step).cast("int").alias("slot")
    ).distinct()
    spots = spots.select(
        "doc", "item", ((F.col("slot") - 1) * F.col("step")).alias("lo"),
        ((F.col("slot") + 2) * F.col("step") + F.col("n_words")).alias("hi"),
    )
    # A document's spots come from its seeds, one for each item that has the seed.
    wanted = stage(spots.groupBy("doc").agg(F.collect_list(F.struct("item", "lo", "hi")).alias("spots")))
    texts = docs.select(F.struct(col(id_col).alias("_id")).alias("doc"), col(text_col).alias("_text"))
    if wanted.count() <= MOST_BROADCAST_IDS:  # other texts need not be exchanged then
        texts = texts.join(F.broadcast(wanted.select("doc")), "doc", "left_semi")
    # Written, so that cutting windows and aligning them do not need two Python workers a task.
    windows = stage(_windows(texts.join(wanted, "doc")))
    words = stage(_item_words(items, item_col, item_text_col))
    pairs = windows.join(words, "item")
    scored = _align(pairs)
    best = scored.groupBy("doc", "item").agg(F.max(F.struct("similarity", "n_item_words", "end_word")).alias("best"))
    return best.filter(F.col("best.similarity") >= min_similarity).select(
        F.col("doc._id").alias(id_col), F.col("item.item").alias(item_col), "best.*"
    )


def _item_words(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    plain = items.select(F.struct(col(item_col).alias("item")).alias("item"), col(text_col).alias("_text"))
    schema = T.StructType([plain.schema["item"], T.StructField("item_words", T.ArrayType(T.LongType(), False))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [word_hashes(t).view(np.int64) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("item"), pa.array(words, pa.list_(pa.int64()))], schema.fieldNames())
        forget_words()

    return plain.mapInArrow(run, schema)


def _windows(joined: DataFrame) -> DataFrame:
    """One row per spot: the hashed words of its window and where it begins."""
    spot = joined.schema["spots"].dataType.elementType
    schema = T.StructType([
        joined.schema["doc"], spot["item"], T.StructField("begin", T.IntegerType()),
        T.StructField("window_words", T.ArrayType(T.LongType(), False)),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words = word_hashes(batch.column("_text")[i].as_py()).view(np.int64)
                spots = batch.column("spots").slice(i, 1).flatten()
                lo = np.maximum(spots.field("lo").to_numpy(), 0)
                hi = np.minimum(spots.field("hi").to_numpy(), len(words))
                docs = batch.column("doc").take(pa.array(np.full(len(spots), i)))
                cut = [words[a:b] for a, b in zip(lo, hi)]
                yield pa.RecordBatch.from_arrays(
                    [docs, spots.field("item"), pa.array(lo.astype(np.int32)), pa.array(cut, pa.list_(pa.int64()))],
                    schema.fieldNames(),
                )
        forget_words()

    return joined.select("doc", "_text", "spots").mapInArrow(run, schema)


def _align(pairs: DataFrame) -> DataFrame:
    schema = T.StructType([
        pairs.schema["doc"], pairs.schema["item"], T.StructField("similarity", T.DoubleType()),
        T.StructField("n_item_words", T.IntegerType()), T.StructField("end_word", T.IntegerType()),
    ])

    def padded(lists: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(lists), max(map(len, lists), default=0)), dtype=np.int64)
        for i, values in enumerate(lists):
            out[i, : len(values)] = values
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [np.asarray(x.values.to_numpy()) for x in batch.column("item_words")]
            windows = [np.asarray(x.values.to_numpy()) for x in batch.column("window_words")]
            score, end = np.zeros(len(items), dtype=np.int32), np.zeros(len(items), dtype=np.int32)
            size = np.array([len(i) for i in items])
            order = np.argsort(size, kind="stable")  # pairs of like size share a grid
            at = 0
            while at < len(order):
                # A grid of at most four million cells, one pair at the least.
                cells = max(1, int(size[order[min(at + 255, len(order) - 1)]]) * 4)
                some = order[at : at + max(1, min(256, (4 << 20) // cells))]
                score[some], end[some] = smith_waterman(padded([items[i] for i in some]), padded([windows[i] for i in some]))
                at += len(some)
            similarity = score / np.maximum(1, MATCH * size)
            begin = batch.column("begin").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc"), batch.column("item"), pa.array(similarity), pa.array(size.astype(np.int32)),
                 pa.array((begin + end).astype(np.int32))], schema.fieldNames(),
            )

    return pairs.select("doc", "item", "begin", "item_words", "window_words").mapInArrow(run, schema)


def drop_leaks(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item. See :func:`find_leaks`.

    All rows of a found id go, null ids count as one document, and null and empty
    texts stay. Columns of any name are kept; without documents or items ``docs``
    comes back as it is.
    """
    leaks, mark = find_leaks(docs, items, id_col, text_col, **options), free_name("_leak", docs)
    found = stage(leaks.select(F.struct(col(id_col).alias("id")).alias(mark)).distinct())
    return docs.join(found, F.struct(col(id_col).alias("id")) == F.col(mark), "left_anti")


def op5_decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_leaks(documents.select("doc_id", "text"), benchmark)
