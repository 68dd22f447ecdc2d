"""Which folders are finished, and which schema each of them has, for any number of folders.

Folders are named by patterns or listed. The driver makes one call per pattern
or parent, never one per folder; footers are read in tasks, one per folder.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from phenoloom.operators.results import union_tables
from phenoloom.session import matching_paths, stage

SPARK_SCHEMA = b"org.apache.spark.sql.parquet.row.metadata"


def finished_outputs(spark: SparkSession, directories: str | Sequence[str], name: str = "variant_results") -> list[str]:
    """Paths ``<directory>/<name>`` whose write has completed, in order.

    ``directories`` is a pattern such as ``<parent>/*`` or a list; a list costs one
    call per parent.
    """
    if isinstance(directories, str):
        return sorted(p.removesuffix("/_SUCCESS") for p in matching_paths(spark, f"{directories}/{name}/_SUCCESS"))
    asked = [d.rstrip("/") for d in directories]
    found = {
        _plain(p) for parent in dict.fromkeys(d.rpartition("/")[0] for d in asked)
        for p in matching_paths(spark, f"{parent}/*/{name}/_SUCCESS")
    }
    return [f"{d}/{name}" for d in asked if _plain(f"{d}/{name}/_SUCCESS") in found]


def _plain(path: str) -> str:
    """A path without its scheme and authority if it is local, for comparison."""
    for start in ("file://", "file:"):
        if path.startswith(start):
            return path.removeprefix(start)
    return path


def _footer(uri: str) -> str | None:
    """Schema of a Parquet file as Spark's JSON, or None where only Spark can open it."""
    from pyarrow import fs, parquet
    from pyspark.sql.pandas.types import from_arrow_schema

    try:
        store, path = fs.FileSystem.from_uri(uri.replace(" ", "%20"))
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return None
    with store.open_input_file(path) as file:
        found = parquet.ParquetFile(file)
        own = (found.metadata.metadata or {}).get(SPARK_SCHEMA)
        return own.decode() if own else from_arrow_schema(found.schema_arrow).json()


def schema_catalogue(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(folder, schema) of Parquet folders, staged; ``schema`` is Spark's JSON.

    The files of a folder share a schema, so one footer is read for each, in the
    task that has the folder. Where the store cannot be opened in a task,
    ``schema`` is NULL. Folders without a data file are left out.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(paths).select("path")
    folders = files.groupBy(F.regexp_extract("path", "^(.*)/[^/]*$", 1).alias("folder")).agg(F.min("path").alias("path"))
    schema = T.StructType([T.StructField("folder", T.StringType()), T.StructField("schema", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_footer(p) for p in batch.column("path").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("folder"), pa.array(found, pa.string())], ["folder", "schema"])

    return stage(folders.mapInArrow(run, schema))


def folders_by_schema(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """The folders of each distinct schema; what reaches the driver is a path per folder.

    Folders whose footers no task could open are asked for on the driver.
    """
    found: dict[str, tuple[T.StructType, list[str]]] = {}
    for row in schema_catalogue(spark, paths).orderBy("folder").toLocalIterator():
        schema = T.StructType.fromJson(json.loads(row["schema"])) if row["schema"] else spark.read.parquet(row["folder"]).schema
        found.setdefault(schema.simpleString(), (schema, []))[1].append(row["folder"])
    return list(found.values())


def read_and_union(spark: SparkSession, paths: str | Sequence[str], fields: T.StructType | str | None = None) -> DataFrame:
    """Union of Parquet folders whose schemas differ by missing fields or by the
    width of a number; each field takes the widest type.

    There is one scan for each distinct schema, however many the folders.
    ``fields`` declares the union's schema; then nothing is looked up and there
    is one scan: a missing field is NULL, and integers are read as the wider
    type. An empty list of paths needs ``fields``.
    """
    if fields is not None:
        schema = fields if isinstance(fields, T.StructType) else T._parse_datatype_string(fields)
        if not isinstance(paths, str) and not paths:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*([paths] if isinstance(paths, str) else paths))
    groups = folders_by_schema(spark, paths)
    if not groups:
        raise ValueError(f"no Parquet files under {paths}")
    tables = [spark.read.schema(schema).parquet(*folders) for schema, folders in groups]
    return union_tables(tables)

