"""Ordered rows to document text.

A document's text is one value, as a file's bytes already are, so its rows are
folded by document, in order, whatever their number. Who needs the text of a
table larger than a value can be takes its ordered lines from ``table_lines``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.fixed_values import HEADER_MARK, PAGE_SEPARATOR, SHEET_MARK, TABLE_MARK
from corpusqa.functions.text import py_strip
from corpusqa.operators.tables import TABLE, row_line, table_lines


def _joined(text: str, separator: str, *order: str) -> Column:
    """Aggregate: texts joined in order; nulls are left out."""
    quoted = separator.replace("\n", "\\n")
    by = ", ".join(order)
    return F.coalesce(F.expr(f"listagg({text}, '{quoted}') within group (order by {by})"), F.lit(""))


def fold_lines(
    lines: DataFrame, keys: list[str], order: str, line: str = "line", separator: str = "\n"
) -> DataFrame:
    """Lines joined in order: ``keys, text``."""
    return lines.groupBy(*keys).agg(_joined(line, separator, order).alias("text"))


def assemble_pages(pages: DataFrame) -> DataFrame:
    """``(path, page_no, page_text)`` to ``path, text``.

    Empty pages are dropped, the others joined by a blank line, the whole stripped.
    """
    filled = pages.filter(F.length("page_text") > 0)
    text = fold_lines(filled, ["path"], "page_no", "page_text", PAGE_SEPARATOR)
    return text.withColumn("text", py_strip("text"))


def assemble_blocks(blocks: DataFrame) -> DataFrame:
    """Word-document blocks ``(path, seq, kind, cells)`` to ``path, text``.

    ``kind`` is ``header`` or ``paragraph`` (one cell, its text), ``section``
    (a page header starts), ``table`` (a table starts) or ``row`` (its cells).
    Headers come first, then paragraphs, then tables, wherever they stood;
    blank paragraphs and blank rows are dropped. A section mark needs header
    paragraphs after it, but they may be blank.
    """
    kind, cells = F.col("kind"), F.col("cells")
    only = F.get(cells, F.lit(0))
    line = (
        F.when(kind == "section", HEADER_MARK)
        .when(kind == "table", TABLE_MARK)
        .when(kind == "row", row_line(cells))
        .otherwise(F.when(py_strip(only) != "", only))
    )
    rank = (
        F.when(kind.isin("section", "header"), 0).when(kind == "paragraph", 1).otherwise(2)
    )
    lines = blocks.select("path", "seq", rank.alias("rank"), line.alias("line"))
    return lines.groupBy("path").agg(_joined("line", "\n", "rank", "seq").alias("text"))


def assemble_workbook(rows: DataFrame) -> DataFrame:
    """Sheets of table rows to ``path, text, error``.

    Sheets follow each other by a column ``sheet_no`` of the rows, their place in
    the workbook; rows without that column don't tell it, and go by name. Mark,
    table lines and an ending newline of every sheet in turn are joined by
    newlines; nothing is stripped. A record longer than its header is an error.
    """
    lines = table_lines(rows)
    sheets = lines.groupBy(*TABLE).agg(
        _joined("line", "\n", "row_no").alias("body"), F.max("problem").alias("problem")
    )
    if "sheet_no" in rows.columns:
        place = rows.groupBy(*TABLE).agg(F.min("sheet_no").alias("sheet_no"))
        sheets = sheets.join(place, TABLE)
    else:
        sheets = sheets.withColumn("sheet_no", F.lit(0))
    opening, closing = SHEET_MARK.split("{sheet}")
    block = F.concat(
        F.lit("\n" + opening), F.col("sheet"), F.lit(closing + "\n\n"), F.col("body"), F.lit("\n\n")
    )
    books = sheets.select("path", "sheet_no", "sheet", "problem", block.alias("block")).groupBy("path").agg(
        _joined("block", "\n", "sheet_no", "sheet").alias("text"), F.max("problem").alias("error")
    )
    return books.select("path", F.when(F.col("error").isNull(), F.col("text")).alias("text"), "error")
