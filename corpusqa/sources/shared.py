"""Intermediate tables in the cluster's shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a
    cluster a machine-local one would be lost or unseen, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL:
        _LOCAL[context.applicationId] = tempfile.mkdtemp(prefix="corpusqa-")
    return _LOCAL[context.applicationId]


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the shared folder; one application's are together."""
    application = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/corpusqa/{application}/{uuid.uuid4().hex}/{name}"


def release(spark: SparkSession) -> None:
    """Delete what this application has written, when its results are no longer read."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/corpusqa/{spark.sparkContext.applicationId}")
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder, in a folder for each value of ``by``, and read back.

    Cuts the lineage: what was computed, a model's answers above all, is not
    computed again when several results read it or an executor is lost.
    """
    folder = new_folder(df.sparkSession, name)
    (df.write.partitionBy(*by) if by else df.write).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)
