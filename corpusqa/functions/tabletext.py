"""Cells of a table as text.

A column's cells are written the way pandas prints the dtype it would infer:
whole numbers as such (with ``.0`` if any cell is missing), decimals all to the
same number of places (1 to 6) or, where that would be too long or show nothing,
with exponents; booleans as True/False, the rest unchanged. A missing cell is
``N/A``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusqa.fixed_values import CSV_NULL_TOKENS, MISSING_CELL
from corpusqa.functions.text import col

WHOLE = r"^\s*[+-]?[0-9]+\s*$"
DECIMAL = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?\s*$"
BOOLEAN = r"^(True|TRUE|true|False|FALSE|false)$"

# A cell is quoted only if it begins with a quote: commas and line breaks up to the
# closing quote belong to it, and a doubled quote stands for one; what follows the
# closing quote is kept as it is, and so is a quote inside a bare cell. A quote that
# is never closed takes the rest of the text. Possessive, so matching never backs up.
_QUOTED = r'"(?:[^"]++|"")*+'
_RECORD = rf'(?:{_QUOTED}(?:"[^,\n]*+|\z)|[^,\n"][^,\n]*+|)(?:,(?:{_QUOTED}(?:"[^,\n]*+|\z)|[^,\n"][^,\n]*+|))*+'
_CELL = rf',({_QUOTED}(?:"[^,]*+|\z)|[^,"][^,]*+|)'
_CLOSED = rf'^{_QUOTED}"'

# Kinds of cell and column, in the order a column's kind is decided.
TEXT, BOOL, FLOAT, INT, MISSING = "text", "bool", "float", "int", "missing"
EXPONENT = "exponent"  # of a column only


def cell_kind(cell: Column) -> Column:
    """How one cell reads by itself."""
    return (
        F.when(cell.isNull(), MISSING)
        .when(cell.rlike(WHOLE), F.when(whole_number(cell).isNotNull(), INT).otherwise(TEXT))
        .when(cell.rlike(DECIMAL), FLOAT)
        .when(cell.rlike(BOOLEAN), BOOL)
        .otherwise(TEXT)
    )


def six_places(cell: Column) -> Column:
    """A number with exactly six decimal places, as text; null if beyond 32 digits."""
    return cell.try_cast("double").try_cast("decimal(38,6)").cast("string")


def with_exponent(cell: Column) -> Column:
    """A number as ``1.234568e+06``."""
    return F.format_string("%.6e", cell.try_cast("double"))


def decimals_needed(places: Column) -> Column:
    """Decimal places, 1 to 6, that show the value of a ``six_places`` text."""
    fraction = F.regexp_extract(places, r"\.([0-9]*?)0*$", 1)
    return F.greatest(F.length(fraction), F.lit(1))


def whole_number(cell: Column) -> Column:
    """A whole number as text, exactly; null beyond 64 bits, which stay text."""
    exact = cell.try_cast("decimal(38,0)")
    return F.when(exact.between(F.lit(-(2**63)).cast("decimal(38,0)"), F.lit("18446744073709551615").cast("decimal(38,0)")), exact.cast("string"))


def escaped(cell: Column) -> Column:
    r"""Line breaks and tabs as ``\n``, ``\r``, ``\t``, so a row stays one line."""
    for char, shown in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        cell = F.replace(cell, F.lit(char), F.lit(shown))
    return cell


def write_cell(cell: Column, kind: Column, decimals: Column) -> Column:
    """One cell's text, given its column's kind."""
    places = six_places(cell)
    written = (
        F.when(kind == BOOL, F.initcap(cell))
        .when(kind == INT, whole_number(cell))
        .when(kind == EXPONENT, with_exponent(cell))
        .when(kind == FLOAT, F.left(places, F.length(places) - F.lit(6) + decimals))
        .otherwise(escaped(cell))
    )
    return F.when(cell.isNull(), MISSING_CELL).otherwise(written)


def null_tokens(cell: Column) -> Column:
    """Null for the texts pandas reads as missing."""
    return F.when(~cell.isin(CSV_NULL_TOKENS), cell)


def csv_records(text: Column | str) -> Column:
    """Non-blank records of a CSV text, ``array<string>``, newlines folded; a byte order mark is no text."""
    bare = F.regexp_replace(col(text), r"\A\x{feff}", "")
    found = F.regexp_extract_all(bare, F.lit(_RECORD), F.lit(0))
    return F.filter(found, lambda r: r.rlike(r"\S"))


def unclosed(cell: Column) -> Column:
    """Whether a cell as it stands in its record opens a quote that is never closed."""
    return cell.startswith('"') & ~cell.rlike(_CLOSED)


def csv_cells(record: Column | str) -> Column:
    """Cells of one record as they stand in it, quotes and all."""
    return F.regexp_extract_all(F.concat(F.lit(","), col(record)), F.lit(_CELL), F.lit(1))


def unquoted(cell: Column) -> Column:
    """A cell's text."""
    closed = F.regexp_extract(cell, _CLOSED, 0)
    inner = F.replace(F.substring(closed, F.lit(2), F.length(closed) - 2), F.lit('""'), F.lit('"'))
    return F.when(
        closed != "", F.concat(inner, F.substring(cell, F.length(closed) + 1, F.lit(2**31 - 1)))
    ).otherwise(cell)
