"""Token usage, cost and counts.

``calls`` has ``op, input_tokens, output_tokens``, one row per successful call.
Tokens are summed as integers and priced once, so totals do not depend on how
rows were partitioned. All are hash aggregates combined before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.fixed_values import INPUT_PRICE_PER_MILLION, OUTPUT_PRICE_PER_MILLION
from corpusqa.functions.money import input_cost, output_cost
from corpusqa.functions.tokens import TokenCounter, estimate_tokens
from corpusqa.operators.exchange import GENERATE, VERIFY


def calls(answered: DataFrame, count_tokens: TokenCounter = estimate_tokens) -> DataFrame:
    """Usage of answered requests; a failed call counts nothing."""
    return answered.filter(F.col("error").isNull()).select(
        "op", "input_tokens", count_tokens(F.col("response")).alias("output_tokens")
    )


def _total(tokens: str, op: str | None = None):
    value = F.col(tokens) if op is None else F.when(F.col("op") == op, F.col(tokens))
    return F.coalesce(F.sum(value), F.lit(0).cast("bigint"))


SUMS = ["n_calls", "input_tokens", "output_tokens"]


def op_sums(calls: DataFrame) -> DataFrame:
    """``op`` and ``SUMS``: calls and tokens of each operation, which can be added up further."""
    return calls.groupBy("op").agg(
        F.count("*").alias("n_calls"),
        _total("input_tokens").alias("input_tokens"),
        _total("output_tokens").alias("output_tokens"),
    )


def usage_by_op(
    calls: DataFrame,
    input_price: float = INPUT_PRICE_PER_MILLION,
    output_price: float = OUTPUT_PRICE_PER_MILLION,
) -> DataFrame:
    """Calls, tokens and cost of each operation."""
    return priced(op_sums(calls), input_price, output_price)


def priced(
    sums: DataFrame,
    input_price: float = INPUT_PRICE_PER_MILLION,
    output_price: float = OUTPUT_PRICE_PER_MILLION,
) -> DataFrame:
    """Sums by operation with their cost."""
    return sums.select(
        "op",
        "n_calls",
        "input_tokens",
        "output_tokens",
        (F.col("input_tokens") + F.col("output_tokens")).alias("total_tokens"),
        input_cost("input_tokens", input_price).alias("input_cost"),
        output_cost("output_tokens", output_price).alias("output_cost"),
        (input_cost("input_tokens", input_price) + output_cost("output_tokens", output_price)).alias("total_cost"),
    )


def usage_summary(
    calls: DataFrame,
    input_price: float = INPUT_PRICE_PER_MILLION,
    output_price: float = OUTPUT_PRICE_PER_MILLION,
) -> DataFrame:
    """One row of nine totals; verification counts only in its own and the grand total."""
    sums = calls.agg(
        _total("input_tokens", GENERATE).alias("gi"),
        _total("output_tokens", GENERATE).alias("go"),
        _total("input_tokens", VERIFY).alias("vi"),
        _total("output_tokens", VERIFY).alias("vo"),
    )
    cost_in, cost_out = input_cost("gi", input_price), output_cost("go", output_price)
    cost_verify = input_cost("vi", input_price) + output_cost("vo", output_price)
    return sums.select(
        F.col("gi").alias("total_input_tokens"),
        F.col("go").alias("total_output_tokens"),
        (F.col("gi") + F.col("go")).alias("total_tokens"),
        cost_in.alias("total_input_cost"),
        cost_out.alias("total_output_cost"),
        (cost_in + cost_out).alias("total_cost"),
        (F.col("vi") + F.col("vo")).alias("total_verification_tokens"),
        cost_verify.alias("total_verification_cost"),
        (cost_in + cost_out + cost_verify).alias("grand_total_cost"),
    )


def average_cost(summary: DataFrame, pairs: DataFrame) -> DataFrame:
    """Generation cost per pair; null when there is no pair.

    Both sides are one-row totals; they are united and summed, not crossed.
    """
    both = summary.select("total_cost", F.lit(0).cast("bigint").alias("n_pairs")).unionByName(
        pairs.agg(F.count("*").alias("n_pairs")).select(F.lit(0.0).alias("total_cost"), "n_pairs")
    )
    return both.agg(F.sum("total_cost").alias("total_cost"), F.sum("n_pairs").alias("n_pairs")).select(
        "total_cost",
        "n_pairs",
        F.try_divide("total_cost", "n_pairs").alias("average_cost"),
    )


def document_counts(documents: DataFrame) -> DataFrame:
    """Characters of each document."""
    return documents.select("path", F.length("text").cast("bigint").alias("n_chars"))


def chunk_counts(chunks: DataFrame) -> DataFrame:
    """Chunks and their characters per file."""
    return chunks.groupBy("path").agg(
        F.count("*").alias("n_chunks"),
        F.sum(F.length("chunk")).cast("bigint").alias("n_chunk_chars"),
    )


def pair_counts(pairs: DataFrame, by_chunk: bool = False) -> DataFrame:
    """Pairs per file, or per chunk."""
    keys = ["path", "chunk_id"] if by_chunk else ["path"]
    return pairs.groupBy(*keys).agg(F.count("*").alias("n_pairs"))
