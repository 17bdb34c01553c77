"""Prompt rendering by concatenation.

``concat`` and not ``regexp_replace``: document text may hold ``$`` and ``\\``.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusqa.fixed_values import GENERATION_PROMPT, VERIFICATION_PROMPT
from corpusqa.functions.text import col
from corpusqa.functions.tokens import TokenCounter, estimate_tokens


def _pieces(template: str, slots: dict[str, Column | str]) -> list[Column]:
    """Literal and slot columns of a ``str.format`` template, in order."""
    pieces: list[Column] = []
    for literal, slot, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if slot is not None:
            pieces.append(col(slots[slot]))
    return pieces


def render(template: str, **slots: Column | str) -> Column:
    """Fill a ``str.format`` template's named slots with columns."""
    return F.concat(*_pieces(template, slots))


def count_rendered(template: str, count_tokens: TokenCounter, **slots: Column | str) -> Column:
    """Tokens of a rendered template.

    The estimate never joins text across blanks, and in these templates blanks
    stand around every slot, so it is the sum over the pieces: the literals'
    share is a constant, and the prompt need not be put together to be counted.
    Any other counter gets the whole prompt.
    """
    if count_tokens is not estimate_tokens:
        return count_tokens(render(template, **slots))
    total, *others = [estimate_tokens(piece) for piece in _pieces(template, slots)]
    for count in others:
        total = total + count
    return total


def generation_prompt(text: Column | str) -> Column:
    return render(GENERATION_PROMPT, text=text)


def generation_tokens(text: Column | str, count_tokens: TokenCounter) -> Column:
    return count_rendered(GENERATION_PROMPT, count_tokens, text=text)


def verification_prompt(
    context: Column | str, question: Column | str, answer: Column | str
) -> Column:
    return render(VERIFICATION_PROMPT, context=context, question=question, answer=answer)


def verification_tokens(
    context: Column | str, question: Column | str, answer: Column | str, count_tokens: TokenCounter
) -> Column:
    return count_rendered(
        VERIFICATION_PROMPT, count_tokens, context=context, question=question, answer=answer
    )
