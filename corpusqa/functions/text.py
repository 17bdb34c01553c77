"""Text clean-up expressions."""

from __future__ import annotations

import codecs
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusqa.fixed_values import PYTHON_BLANKS


def col(c: Column | str) -> Column:
    """Accept a column or its name."""
    return F.col(c) if isinstance(c, str) else c


def literal_map(entries: dict[str, str]) -> Column:
    """A constant ``map<string,string>``, folded by the optimizer into one literal."""
    return F.from_json(F.lit(json.dumps(entries)), "map<string,string>")


def py_strip(c: Column | str) -> Column:
    """Strip both ends like Python's ``str.strip()``.

    ``trim`` alone removes only spaces. ``btrim`` with a character set stays in
    generated code and scans only the ends, where a regex would scan the text.
    """
    return F.btrim(col(c), F.lit(PYTHON_BLANKS))


def fold_newlines(c: Column | str) -> Column:
    r"""``\r\n`` and ``\r`` become ``\n``, as a text-mode read does."""
    c = col(c)
    return F.when(F.contains(c, F.lit("\r")), F.regexp_replace(c, "\r\n?", "\n")).otherwise(c)


def _decoded_by_python(content: Column, encoding: str) -> Column:
    """Strictly decoded text by Python's codec, null where the bytes do not fit it."""

    @F.pandas_udf("string")
    def decoded(contents: pd.Series) -> pd.Series:
        def read(content: bytes | None) -> str | None:
            try:
                return None if content is None else bytes(content).decode(encoding)
            except UnicodeDecodeError:
                return None

        return contents.map(read)

    return decoded(content)


def decode_text(content: Column | str, encoding: str = "utf-8") -> Column:
    """Bytes to text: ``encoding`` first, then utf-8, then latin-1.

    latin-1 accepts every byte sequence, so the result is never null for
    non-null content. The usual encodings stay in generated code; any other
    codec Python knows is tried through an Arrow-batched UDF.
    """
    content = col(content)
    as_utf8 = F.when(F.is_valid_utf8(content.cast("string")), content.cast("string"))
    as_latin1 = F.decode(content, "ISO-8859-1")
    name = codecs.lookup(encoding).name
    if name == "iso8859-1":
        return as_latin1
    # ASCII bytes are UTF-8 bytes and read the same under both.
    if name in ("utf-8", "ascii"):
        return F.coalesce(as_utf8, as_latin1)
    return F.coalesce(_decoded_by_python(content, name), as_utf8, as_latin1)
