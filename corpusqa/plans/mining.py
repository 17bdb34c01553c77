"""From documents to question/answer rows."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.fixed_values import CHUNK_OVERLAP, CHUNK_SIZE
from corpusqa.functions.tokens import TokenCounter, estimate_tokens
from corpusqa.operators import chunking, exchange, usage
from corpusqa.operators.answers import ask_logged
from corpusqa.sinks.json_rows import run_stamp, save_rows
from corpusqa.sources.files import documents as with_text
from corpusqa.sources.files import read_texts, rejects
from corpusqa.sources.shared import new_folder, written

Model = Callable[[str], str]


@dataclass(frozen=True)
class Mined:
    """The tables of one run; all are lazy."""

    pairs: DataFrame
    rows: DataFrame
    calls: DataFrame
    rejects: DataFrame
    summary: DataFrame


def mine(
    answered: DataFrame,
    check: Callable[[DataFrame], DataFrame] | None = None,
    verdict_mode: str = "prefix",
    count_tokens: TokenCounter = estimate_tokens,
    spelling: str = "json",
    is_written: bool = False,
) -> Mined:
    """Answered generation requests to pairs, output rows and usage.

    ``check`` switches verification on: it gets the verification requests and
    gives them back answered. The requests then need a ``chunk`` column: the
    chunk's text stays with its pairs, so verifying joins nothing. Without
    ``check`` nothing reads the text and it is pruned early. The answered requests
    are written first, as all tables of the result read them, unless they already
    are a written table.
    """
    if not is_written:
        kept = ["op", "path", "chunk_id", "response", "error", "input_tokens", *(["chunk"] if check else [])]
        answered = written(answered.select(*kept), "answered")
    found = exchange.pairs(answered, ["chunk"] if check else [], spelling)
    calls = usage.calls(answered, count_tokens)
    bad = exchange.parse_rejects(answered)
    if check is None:
        pairs = found.drop("complete")
        rows = exchange.alpaca_rows(pairs)
    else:
        checked = check(exchange.verification_requests(found, count_tokens=count_tokens))
        pairs = exchange.verified_pairs(checked, verdict_mode)
        rows = exchange.alpaca_rows(pairs, include_verification=True)
        calls = calls.unionByName(usage.calls(checked, count_tokens))
        incomplete = F.lit("pair without instruction or output")
        bad = bad.unionByName(
            found.filter(~F.col("complete")).select(
                "path", "chunk_id", F.lit("verify").alias("stage"), incomplete.alias("reason")
            )
        )
    return Mined(pairs, rows, calls, bad, usage.usage_summary(calls))


def asking(
    model: Model, log: str | None = None, parallelism: int | None = None
) -> Callable[[DataFrame], DataFrame]:
    """Requests to answered requests by calling ``model`` for each that ``log`` has no answer to.

    Without ``log`` the answers are logged in a new folder: asked once, whatever is read
    from them, but not found again by another run.
    """
    def answered(requests: DataFrame) -> DataFrame:
        folder = log or new_folder(requests.sparkSession, "answers")
        return ask_logged(requests, model, folder, tasks=parallelism)

    return answered


def process_text(
    chunks: DataFrame, model: Model, parallelism: int | None = None, log: str | None = None
) -> DataFrame:
    """Chunks to pairs by calling ``model`` once per chunk."""
    requests = exchange.generation_requests(chunks)
    return exchange.pairs(asking(model, log, parallelism)(requests))


def verify_dataset(
    pairs: DataFrame, chunks: DataFrame, model: Model,
    verdict_mode: str = "prefix", parallelism: int | None = None, log: str | None = None,
) -> DataFrame:
    """Pairs with verdicts by calling ``model`` once per pair."""
    requests = exchange.verification_requests(pairs, chunks)
    return exchange.verified_pairs(asking(model, log, parallelism)(requests), verdict_mode)


def mine_documents(
    spark: SparkSession,
    source_dir: str,
    model: Model,
    *,
    output: str = "mined_dataset.json",
    verify: bool = False,
    remove_empty_columns: bool = False,
    include_verification: bool = False,
    decoders: Mapping[str, Callable[[bytes], str]] | None = None,
    chunk_size: int = CHUNK_SIZE,
    chunk_overlap: int = CHUNK_OVERLAP,
    count_tokens: TokenCounter = estimate_tokens,
    verdict_mode: str = "prefix",
    parallelism: int | None = None,
    log: str | None = None,
) -> tuple[Mined, str]:
    """Mine a directory and append the rows to ``output``; the run's tables and its folder.

    Extracted texts are written to the shared folder and answers to ``log`` (or to the
    shared folder, too), so no file is read and no prompt is sent a second time. With
    ``log`` that also holds for a later run, above all one after a crash: files are known by
    their path, so delete the log, or name another, once a file's content has changed.
    """
    run_id = run_stamp()
    extracted = written(
        read_texts(
            spark, source_dir, decoders=decoders,
            drop_empty_columns=remove_empty_columns, raw_html=True,
        ),
        "texts",
    )
    chunks = chunking.split_documents(with_text(extracted), chunk_size, chunk_overlap)
    requests = exchange.generation_requests(chunks, count_tokens, ["chunk"] if verify else [])
    mined = mine(
        asking(model, log, parallelism)(requests),
        asking(model, log, parallelism) if verify else None,
        verdict_mode,
        count_tokens,
    )
    save_rows(mined.pairs, output, run_id, include_verification and verify)
    bad = rejects(extracted).unionByName(mined.rejects)
    return replace(mined, rejects=bad), f"{output}/run_id={run_id}"
