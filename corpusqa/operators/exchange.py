"""Model calls as a table exchange: requests go out, responses come back.

A request has an id made of its place (``generate:path#chunk`` or
``verify:path#chunk#pair``), unique by construction; a hash would collide at
this scale. Answered requests carry ``response`` and ``error``: either joined
from a table ``request_id, response, error`` or got from a function in place.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.functions.prompts import (
    generation_prompt,
    generation_tokens,
    verification_prompt,
    verification_tokens,
)
from corpusqa.functions.responses import (
    PAIR_KEYS,
    field_text,
    json_elements,
    pair_fields,
    python_spelling,
    verdict,
)
from corpusqa.functions.tokens import TokenCounter, estimate_tokens

GENERATE, VERIFY = "generate", "verify"


def _request_id(op: str, *place: str):
    return F.concat_ws("#", F.concat(F.lit(f"{op}:"), F.col(place[0])), *place[1:])


def generation_requests(
    chunks: DataFrame, count_tokens: TokenCounter = estimate_tokens, keep: Sequence[str] = ()
) -> DataFrame:
    """One request per chunk: ``request_id, op, path, chunk_id, prompt, input_tokens``."""
    return chunks.select(
        _request_id(GENERATE, "path", "chunk_id").alias("request_id"),
        F.lit(GENERATE).alias("op"),
        "path",
        "chunk_id",
        *keep,
        generation_prompt("chunk").alias("prompt"),
        generation_tokens("chunk", count_tokens).alias("input_tokens"),
    )


def apply_model(
    requests: DataFrame, model: Callable, parallelism: int | None = None, batch_size: int | None = None
) -> DataFrame:
    """Call ``model(prompt)`` for every request: the requests with ``response, error``.

    A call that raises gives its message as ``error`` and no response. The
    prompt is not kept; the other columns pass through, so no join is needed
    afterwards. Calls are slow and may not give the same answer twice: write
    the result before more than one thing is read from it. The calls are spread
    over ``parallelism`` tasks (as many as the session's shuffle partitions unless
    given) by the hash of the id, not round-robin, so a lost task is redone with the
    same rows. With ``batch_size`` the model gets a list of so many prompts at once
    and gives a list of answers, in which an exception stands for a failed one.
    """
    parallelism = parallelism or int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    kept = requests.drop("prompt")
    passed = kept.columns
    schema = T.StructType(
        [*kept.schema.fields, T.StructField("response", T.StringType()), T.StructField("error", T.StringType())]
    )

    def calls(prompts: list[str]) -> list[tuple[str | None, str | None]]:
        if batch_size is None:
            return [read(lambda p=p: model(p)) for p in prompts]
        out = []
        for i in range(0, len(prompts), batch_size):
            some = prompts[i : i + batch_size]
            try:
                answers = list(model(some))
                if len(answers) != len(some):
                    raise ValueError(f"{len(answers)} answers to {len(some)} prompts")
            except Exception as problem:  # the whole call failed
                answers = [problem] * len(some)
            out += [read(lambda a=a: a) for a in answers]
        return out

    def read(answer_of: Callable) -> tuple[str | None, str | None]:
        try:
            answer = answer_of()
            if isinstance(answer, Exception):
                raise answer
            answer.encode()  # an answer that is no text, or text no column can hold, is an error
            return answer, None
        except Exception as problem:  # the caller's model may raise anything
            return None, str(problem) or type(problem).__name__

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            answers = calls(part.column("prompt").to_pylist())
            columns = [part.column(c) for c in passed]
            columns += [pa.array([a[k] for a in answers], pa.string()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(columns, names=[*passed, "response", "error"])

    return requests.repartition(parallelism, "request_id").mapInArrow(batches, schema)


def attach_responses(requests: DataFrame, responses: DataFrame) -> DataFrame:
    """Requests with ``response`` and ``error``; no answer at all is an error, too.

    Of several answers to one request a successful one counts, the first in the order
    of texts, so that each request has one. Only ids are counted to find such
    requests; where there are few, as should be, the other answers go to the join
    untouched. Columns nothing later reads, the prompt above all, are pruned before the
    shuffle.
    """
    failed = (F.col("error").isNotNull() | F.col("response").isNull()).alias("failed")
    responses = responses.select("request_id", "response", "error").filter(F.col("request_id").isNotNull())
    several = responses.groupBy("request_id").count().filter(F.col("count") > 1).select("request_id")
    chosen = (
        responses.join(several, "request_id", "left_semi")
        .groupBy("request_id").agg(F.min(F.struct(failed, "response", "error")).alias("_r"))
        .select("request_id", "_r.response", "_r.error")
    )
    came = responses.join(several, "request_id", "left_anti").unionByName(chosen)
    came = came.withColumn("_came", F.lit(True))
    joined = requests.join(came, "request_id", "left")
    return joined.withColumn(
        "error",
        F.when(F.col("_came").isNull(), "no response")
        .when(F.col("error").isNull() & F.col("response").isNull(), "no response")
        .otherwise(F.col("error")),
    ).drop("_came")


def parsed_elements(answered: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Elements of the answers' JSON arrays: ``path, chunk_id, pair_id, element, fields``.

    ``fields`` is null for an element that is not an object. Answers without a
    valid array give no rows. Fields are parsed before the explode: a filter on
    them then stays above it and does not parse a second time.
    """
    parsed = F.transform(
        json_elements("response"),
        lambda e: F.struct(e.alias("element"), pair_fields(e).alias("fields")),
    )
    elements = answered.filter(F.col("error").isNull()).select(
        "path", "chunk_id", *keep, F.posexplode(parsed).alias("pair_id", "_e")
    )
    return elements.select("path", "chunk_id", *keep, "pair_id", "_e.element", "_e.fields")


def pairs(
    answered: DataFrame, keep: Sequence[str] = (), spelling: str = "json"
) -> DataFrame:
    """Question/answer pairs: ``path, chunk_id, pair_id, instruction, input, output, complete``.

    The three fields are text: an absent key is ``''`` and a JSON null ``None``.
    Booleans and nested values keep their JSON spelling; ``spelling="python"``
    gives Python's ``str()`` instead, at the price of an Arrow-batched UDF.
    ``complete`` tells whether both instruction and output were there.
    """
    found = parsed_elements(answered, keep).filter(F.col("fields").isNotNull())
    complete = F.map_contains_key("fields", "instruction") & F.map_contains_key("fields", "output")
    if spelling == "python":
        spelled = python_spelling(F.col("element"))
        found = found.withColumn("_spelled", spelled)
        texts = [F.col(f"_spelled.{k}").alias(k) for k in PAIR_KEYS]
    elif spelling == "json":
        texts = [field_text("fields", k).alias(k) for k in PAIR_KEYS]
    else:
        raise ValueError(f"unknown spelling: {spelling}")
    return found.select("path", "chunk_id", *keep, "pair_id", *texts, complete.alias("complete"))


def parse_rejects(answered: DataFrame) -> DataFrame:
    """What gave no pair: failed calls, answers without an array, elements not objects."""
    answers = answered.withColumn(
        "elements", F.when(F.col("error").isNull(), json_elements("response"))
    )
    bad = F.size(F.filter("elements", lambda e: ~e.startswith("{")))
    reason = (
        F.when(F.col("error").isNotNull(), F.col("error"))
        .when(F.col("elements").isNull(), "no valid JSON array")
        .when(bad > 0, F.concat(bad.cast("string"), F.lit(" elements are not objects")))
    )
    stage = F.when(F.col("error").isNotNull(), "call").otherwise("parse")
    return answers.select(
        "path", "chunk_id", stage.alias("stage"), reason.alias("reason")
    ).filter(F.col("reason").isNotNull())


def alpaca_rows(pairs: DataFrame, include_verification: bool = False) -> DataFrame:
    """The three output columns, and the verdict if asked for."""
    extra = ["verification"] if include_verification else []
    return pairs.select(*PAIR_KEYS, *extra)


def verification_requests(
    pairs: DataFrame,
    chunks: DataFrame | None = None,
    count_tokens: TokenCounter = estimate_tokens,
) -> DataFrame:
    """One request per complete pair, with the pair's chunk as context.

    The chunk's text comes from ``pairs`` if it carries a ``chunk`` column (no
    join), else by an equi-join with ``chunks`` on ``path, chunk_id``. The
    pair's columns stay, so a verdict needs no join back.
    """
    whole = pairs.filter("complete")
    if chunks is not None:
        whole = whole.join(chunks.select("path", "chunk_id", "chunk"), ["path", "chunk_id"])
    shown = ["chunk", "instruction", "output"]
    return whole.select(
        _request_id(VERIFY, "path", "chunk_id", "pair_id").alias("request_id"),
        F.lit(VERIFY).alias("op"),
        "path",
        "chunk_id",
        "pair_id",
        *PAIR_KEYS,
        verification_prompt(*shown).alias("prompt"),
        verification_tokens(*shown, count_tokens).alias("input_tokens"),
    )


def verified_pairs(answered: DataFrame, mode: str = "prefix") -> DataFrame:
    """Pairs with ``verification struct<status, explanation>``; none is left out."""
    return answered.select(
        "path", "chunk_id", "pair_id", *PAIR_KEYS,
        verdict("response", "error", mode).alias("verification"),
    )
