"""Structured Streaming over new input, saved batch by batch."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusqa.sinks.json_rows import save_batch
from corpusqa.sources.files import FILE_SCHEMA, extension_glob, supported_files


def new_files(spark: SparkSession, source_dir: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the supported files under ``source_dir``."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_SCHEMA)
        .option("pathGlobFilter", extension_glob())
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source_dir)
    )
    return supported_files(files)


def each_batch(stream: DataFrame, save: Callable[[DataFrame, str], None], checkpoint: str) -> None:
    """Give ``save`` the batches that the checkpoint has not seen, each with its name, and stop.

    A name is the same when a batch is run again, and differs between streams.
    """

    def named(batch: DataFrame, batch_id: int) -> None:
        # the id that the checkpoint gives its stream
        about = batch.sparkSession.read.text(f"{checkpoint}/metadata").first()["value"]
        save(batch, f"{json.loads(about)['id']}-{batch_id:06d}")

    query = (
        stream.writeStream.foreachBatch(named)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def save_new(
    stream: DataFrame,
    process: Callable[[DataFrame], DataFrame],
    output: str,
    checkpoint: str,
    run_id: str,
) -> None:
    """Process what the checkpoint has not seen, save it, and stop.

    ``process`` turns one batch of input into output rows; it is an ordinary
    batch plan and may call a model. Each batch of each stream has its own folder,
    written in overwrite mode: a batch that is run again after a failure replaces
    itself, so every input gives its rows exactly once, and a stream with another
    checkpoint never meets its folders.
    """
    each_batch(stream, lambda batch, name: save_batch(process(batch), output, run_id, name), checkpoint)
