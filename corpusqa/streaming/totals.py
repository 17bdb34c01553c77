"""Token totals over many runs, kept batch by batch.

Sums of tokens can be added, prices can't be (they would be rounded), so a batch
leaves a row of integers for each operation. A batch has a folder of its own that a
repeated attempt replaces: it counts once, however often it is tried.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.operators.usage import SUMS, op_sums
from corpusqa.streaming.incremental import each_batch

_SCHEMA = "op string, n_calls bigint, input_tokens bigint, output_tokens bigint"


def save_totals(calls: DataFrame, folder: str, batch: int | str) -> None:
    """Add one batch's calls to the totals in ``folder``, in place of an earlier attempt at it."""
    op_sums(calls).write.mode("overwrite").json(f"{folder}/batch={batch}")


def total_new(stream: DataFrame, calls: Callable[[DataFrame], DataFrame], folder: str, checkpoint: str) -> None:
    """Add to the totals in ``folder`` what the checkpoint has not seen, ``calls`` making calls of a batch."""
    spark = stream.sparkSession
    # so that there are totals, of nothing, without any batch
    spark.createDataFrame([], _SCHEMA).write.mode("overwrite").json(f"{folder}/batch=none")
    each_batch(stream, lambda batch, name: save_totals(calls(batch), folder, name), checkpoint)


def running_totals(spark: SparkSession, folder: str) -> DataFrame:
    """``op, n_calls, input_tokens, output_tokens`` of all batches saved so far.

    ``usage_summary`` takes it as its calls and ``priced`` gives what ``usage_by_op`` does.
    A few rows a batch are read, none of the calls.
    """
    saved = spark.read.schema(_SCHEMA).json(f"{folder}/batch=*")
    return saved.groupBy("op").agg(*[F.sum(c).alias(c) for c in SUMS])
