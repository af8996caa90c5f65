"""Written intermediate tables in the folder the cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder. Only a local session without one gets a temporary folder."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="seasonstats-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/seasonstats/{uuid.uuid4().hex}/{name}"


def materialize(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` as parquet, with the writer's ``options``, and read it back.

    This cuts the lineage in a way that survives lost executors, lets several branches share one
    computation, and gives Catalyst the real file size, so that a later join broadcasts the table
    only when it is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> DataFrame:
    """Full refresh of a stored table; returns the stored rows."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)
