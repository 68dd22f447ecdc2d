"""Session settings and durable staging of intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Call-site capture costs milliseconds per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "phenoloom", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on and the time zone pinned to UTC."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: the session's checkpoint directory.

    A private temporary folder is made only on a local master without one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.getCheckpointDir():
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="phenoloom-"))
    return context.getCheckpointDir()


_staged: list[str] = []


def stage(df: DataFrame, **options) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder, with the writer's ``options``, and read it back.

    Cuts lineage so that a lost executor re-reads files instead of re-running
    the plan, and keeps column pruning for the consumers.
    """
    spark = df.sparkSession
    path = f"{staging_root(spark).rstrip('/')}/staged-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_staged(spark: SparkSession) -> None:
    """Delete the staged tables of this process once their results are written."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    while _staged:
        path = jvm.org.apache.hadoop.fs.Path(_staged.pop())
        path.getFileSystem(conf).delete(path, True)


def matching_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that a pattern matches, hidden ones too, by one call to the store's client."""
    jvm = spark._jvm
    found = jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(jvm.org.apache.hadoop.fs.Path(pattern))
    return found.mkString("\n").split("\n") if found.nonEmpty() else []
