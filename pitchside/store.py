"""Tables in the folder that the cluster names in ``spark.checkpoint.dir``, which the driver and all executors see. A frame that is
used many times is written there once and read back, which also cuts its lineage: a lost executor costs only its running tasks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

made: list[str] = []


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system; one without a scheme is in Hadoop's default file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()


def folder(spark: SparkSession, name: str) -> str:
    """A new folder below ``spark.checkpoint.dir``, or, where that is unset, below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir") or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_checkpoints"
    made.append(f"{qualified(spark, base).rstrip('/')}/pitchside-{name}-{uuid.uuid4().hex}")
    return made[-1]


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, from a Parquet table."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Deletes what this driver has put there. Results that still read it must have been written before."""
    while made:
        remove(spark, made.pop())
