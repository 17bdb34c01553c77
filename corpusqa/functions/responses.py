"""Reading model responses: JSON arrays of pairs, and verdicts."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.fixed_values import UNEXPECTED_VERDICT
from corpusqa.functions.text import col, py_strip

PAIR_KEYS = ["instruction", "input", "output"]

# Python's json module takes neither of these; Spark takes single quotes unless told not to.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def json_array_text(response: Column | str) -> Column:
    """The text from the first ``[`` to the last ``]``, ``''`` if there is none."""
    return F.regexp_extract(col(response), r"(?s)\[.*\]", 0)


def json_elements(response: Column | str) -> Column:
    """Elements of the response's JSON array as JSON texts; null if invalid.

    Parsed bare, text after the array would be accepted, so it is wrapped, in two
    ways: as an object's value, where it could add keys of its own, and as an
    array's element, where it could add elements. Only one JSON text alone passes
    both. A text that closes the array early needs a bracket before a comma or a brace;
    without one the first reading is enough. Going through ``array<string>`` keeps one bad element from nulling all
    the others.
    """
    array = json_array_text(response)
    value = F.from_json(F.concat(F.lit('{"r":'), array, F.lit("}")), "r array<string>", _STRICT)["r"]
    alone = F.from_json(F.concat(F.lit('{"r":['), array, F.lit("]}")), "r array<string>", _STRICT)["r"]
    return F.when(~array.rlike(r"\]\s*[,}]") | (F.size(alone) == 1), value)


def pair_fields(element: Column) -> Column:
    """One element as ``map<string,string>``; null when it is not an object."""
    return F.when(
        element.startswith("{"), F.from_json(element, "map<string,string>", _STRICT)
    )


def field_text(fields: Column | str, key: str) -> Column:
    """A field as text: absent is ``''``, a JSON null is ``None``."""
    fields = col(fields)
    return F.coalesce(
        F.try_element_at(fields, F.lit(key)),
        F.when(F.map_contains_key(fields, key), "None").otherwise(""),
    )


@F.pandas_udf(T.StructType([T.StructField(key, T.StringType()) for key in PAIR_KEYS]))
def python_spelling(elements: pd.Series) -> pd.DataFrame:
    """The three fields spelled by Python's ``str()``: ``True``, ``{'k': 1}``."""

    def read(element: str | None) -> list[str | None]:
        if element is None:
            return [None] * len(PAIR_KEYS)
        fields = json.loads(element)
        texts = [str(fields.get(key, "")) for key in PAIR_KEYS]
        # Half a surrogate pair, which JSON can spell, has no place in a column.
        return [text.encode("utf-8", "replace").decode() for text in texts]

    return pd.DataFrame([read(e) for e in elements], columns=PAIR_KEYS, dtype=object)


def verdict(response: Column | str, error: Column | str | None = None, mode: str = "prefix") -> Column:
    """Verification response to ``struct<status, explanation>``.

    ``prefix`` reads a leading CORRECT or INCORRECT. The test ignores case and
    leading blanks; the explanation is cut from the response as it came, so
    leading blanks shift the cut. ``json`` first reads an object's ``verdict``
    and ``explanation`` and falls back to the prefix rule. A call error gives
    status ERROR with the message.
    """
    response = col(response)

    def result(status: Column | str, explanation: Column) -> Column:
        status = F.lit(status) if isinstance(status, str) else status
        return F.struct(status.alias("status"), explanation.alias("explanation"))

    def after(prefix: str) -> Column:
        return py_strip(F.substring(response, len(prefix) + 1, 2**31 - 1))

    head = F.upper(py_strip(response))
    found = (
        F.when(head.startswith("CORRECT"), result("CORRECT", after("CORRECT")))
        .when(head.startswith("INCORRECT"), result("INCORRECT", after("INCORRECT")))
        .otherwise(result("UNKNOWN", F.lit(UNEXPECTED_VERDICT)))
    )
    if mode == "json":
        body = F.regexp_extract(response, r"(?s)\{.*\}", 0)
        answer = F.from_json(body, "verdict string, explanation string", _STRICT)
        status = F.upper(py_strip(answer.getField("verdict")))
        found = F.when(
            status.isin("CORRECT", "INCORRECT"),
            result(status, F.coalesce(answer.getField("explanation"), F.lit(""))),
        ).otherwise(found)
    elif mode != "prefix":
        raise ValueError(f"unknown verdict mode: {mode}")
    if error is None:
        return found
    error = col(error)
    return F.when(error.isNotNull(), result("ERROR", error)).otherwise(found)
