"""Cost of a call and the text forms of amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusqa.fixed_values import INPUT_PRICE_PER_MILLION, OUTPUT_PRICE_PER_MILLION
from corpusqa.functions.text import col


def _cost(tokens: Column | str, price: float) -> Column:
    return col(tokens) / F.lit(1e6) * F.lit(price)


def input_cost(tokens: Column | str, price: float = INPUT_PRICE_PER_MILLION) -> Column:
    return _cost(tokens, price)


def output_cost(tokens: Column | str, price: float = OUTPUT_PRICE_PER_MILLION) -> Column:
    return _cost(tokens, price)


def currency(amount: Column | str) -> Column:
    """``$1,234.500000``; a minus sign stands after the dollar sign."""
    return F.concat(F.lit("$"), F.format_number(col(amount), 6))


def thousands(number: Column | str) -> Column:
    """``1,234,567``."""
    return F.format_number(col(number), 0)
