"""A log of model answers, so that a run which ends early is continued, not paid twice.

The log is a folder of Parquet files, ``request_id, response, error``. Prompts not in it
are put to the model in waves; each wave is one job that appends its answers and
commits them, so what a crash can lose is one wave's answers at most. A run that is
started again over the same log asks what is missing and nothing else, whatever
else has changed in its requests.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.operators.exchange import apply_model, attach_responses
from corpusqa.sources.shared import written

LOG_SCHEMA = "request_id string, response string, error string"
#: Prompts that one task asks before its answers are committed.
PIECE = 1000


def answer_log(spark: SparkSession, log: str) -> DataFrame:
    """The answers committed so far; an absent folder has none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(log)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], LOG_SCHEMA)
    return spark.read.schema(LOG_SCHEMA).parquet(log)


def unanswered(requests: DataFrame, log: str, retry_errors: bool = False) -> DataFrame:
    """One row ``request_id, prompt`` for each request without an answer in the log.

    With ``retry_errors`` a logged error is no answer. Requests of one id have one prompt.
    """
    done = answer_log(requests.sparkSession, log)
    if retry_errors:
        done = done.filter(F.col("error").isNull())
    asked = requests.join(done.select("request_id"), "request_id", "left_anti")
    return asked.groupBy("request_id").agg(F.min("prompt").alias("prompt"))


def ask_logged(
    requests: DataFrame, model: Callable, log: str, *, tasks: int | None = None, piece: int = PIECE,
    batch_size: int | None = None, retry_errors: bool = False,
) -> DataFrame:
    """The requests, without their prompts, with ``response, error`` from the log, asked where missing.

    A wave has ``tasks`` tasks (as many as the cluster has cores, unless given) of about
    ``piece`` prompts; fewer prompts than that make one wave of as many tasks as they need. Prompts are
    written once, by wave, so that a wave reads its own only, and its prompts alone are
    dealt out to tasks.
    """
    spark = requests.sparkSession
    tasks = tasks or spark.sparkContext.defaultParallelism
    missing = written(unanswered(requests, log, retry_errors), "unanswered")
    count = missing.count()
    waves = -(-count // (tasks * piece))
    if waves > 1:
        wave = F.pmod(F.xxhash64("request_id"), F.lit(waves)).cast("int")
        missing = written(missing.withColumn("wave", wave), "waves", "wave")
    for n in range(waves):
        prompts = missing.filter(F.col("wave") == n).drop("wave") if waves > 1 else missing
        answers = apply_model(prompts, model, min(tasks, -(-count // piece)), batch_size)
        answers.select("request_id", "response", "error").write.mode("append").parquet(log)
    return attach_responses(requests.drop("prompt"), answer_log(spark, log))
