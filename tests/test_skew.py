"""Joins in which one key holds a third of all rows are split."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusqa.operators import rates, tables


@pytest.fixture
def thresholds(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k",
    }
    kept = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def is_split(frame) -> bool:
    frame.collect()
    return "skew=true" in frame._jdf.queryExecution().executedPlan().toString()


def test_a_hot_table_is_split(spark, thresholds):
    n = F.col("id")
    rows = spark.range(0, 30_000, 1, 12).select(
        F.when(n % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), n % 97)).alias("path"), F.lit("s").alias("sheet"),
        F.when(n < 300, 0).otherwise(n).alias("row_no"), F.array(F.lit("a"), F.concat(F.lit("b"), n.cast("string"))).alias("cells"),
    ).dropDuplicates(["path", "row_no"])
    assert is_split(tables.table_lines(rows))


def test_a_hot_moment_is_split(spark, thresholds, tmp_path):
    n = F.col("id")
    spark.range(0, 60_000, 1, 12).select(
        F.lit("k").alias("key"), F.when(n % 3 == 0, 5).otherwise(n * 1000).alias("at_us"), (n % 50).alias("tokens"), F.sha2(n.cast("string"), 256).alias("note")
    ).write.parquet(str(tmp_path / "calls"))
    assert is_split(rates.audit_calls(spark.read.parquet(str(tmp_path / "calls"))))
