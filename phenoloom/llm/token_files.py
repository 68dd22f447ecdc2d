"""Token ids in ORC files, in order of the document ids."""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.llm.common import col
from phenoloom.llm.tokenizing import encoder
from phenoloom.session import staging_root


def write_token_files(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", vocabulary: str | None = None,
    end_id: int = 2, stripe_bytes: int = 16 << 20, index_rows: int = 1000,
) -> None:
    """Write one record per document, in ascending order of the id, as ORC.

    The files hold ``doc_id``, ``part`` (number of the file's range of ids),
    ``part_start`` (ids of the documents before it in the part), ``n_tokens``
    and ``ids``. Integers are run-length encoded; every ``index_rows`` records
    have an index entry and a Bloom filter on the id; stripes of
    ``stripe_bytes`` can be read in parallel.

    Null and empty texts have just the end id. Null ids come first, repeated ids
    are ordered by a hash of their texts, extra columns are ignored, and an
    empty table gives files without records. Texts are shuffled by ranges of
    ids before they are encoded, so ids are never shuffled, and every task
    encodes its documents in order, a few at a time.
    """
    vocabulary = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    plain = docs.select(col(id_col).alias("doc_id"), F.coalesce(col(text_col), F.lit("")).alias("_text"))
    ordered = plain.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("_text"))
    schema = T.StructType([
        T.StructField("doc_id", plain.schema["doc_id"].dataType), T.StructField("part", T.IntegerType()),
        T.StructField("part_start", T.LongType()), T.StructField("n_tokens", T.IntegerType()),
        T.StructField("ids", T.ArrayType(T.IntegerType(), False)),
    ])
    end = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, part, before = encoder(vocabulary), TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                ids = [i + end for i in encode(some.column("_text").to_pylist())]
                sizes = np.array([len(i) // 4 for i in ids], dtype=np.int32)
                ends = np.cumsum(sizes, dtype=np.int64)
                flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]).astype(np.int32)), flat)
                yield pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), pa.array(np.full(len(ids), part, dtype=np.int32)),
                     pa.array(before + ends - sizes), pa.array(sizes), lists], schema.fieldNames(),
                )
                before += int(ends[-1])
        encode.forget()

    (
        ordered.mapInArrow(run, schema).write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01").option("orc.stripe.size", str(stripe_bytes))
        .option("orc.row.index.stride", str(index_rows)).option("orc.create.index", "true").orc(path)
    )


def read_token_files(spark: SparkSession, path: str, like: DataFrame | None = None) -> DataFrame:
    """Records of the files with ``start``, the number of ids of all documents before.

    A filter on ``doc_id`` reaches the files' statistics, indexes and Bloom
    filters. The starts of the parts come from one sum per part; the parts are
    as many as the tasks that wrote them, and that bounds what is broadcast.
    """
    records = spark.read.orc(path)
    sums = records.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = records.join(F.broadcast(starts), "part")
    return joined.withColumn("start", F.col("_before") + F.col("part_start")).drop("_before")


def op10_token_orc(documents: DataFrame) -> DataFrame:
    """Contract of the query: doc_id, start, n_tokens, ids_crc32, all from the files."""
    spark = documents.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/token-files-{uuid.uuid4().hex}"
    write_token_files(documents, path)
    read = read_token_files(spark, path).select("doc_id", "start", F.col("n_tokens").cast("long").alias("n_tokens"), "ids")
    schema = T.StructType([*read.schema.fields[:3], T.StructField("ids_crc32", T.LongType())])

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            flat, cuts = ids.values.to_numpy().astype("<u4"), ids.offsets.to_numpy()
            sums = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], schema.fieldNames())

    return read.mapInArrow(checked, schema)
