"""Tables as aligned text.

A table is kept as rows: ``path, sheet, row_no, cells array<string>``. Row 0
holds the column names. Column layout (kind, width) is a small aggregate per
table joined back to the rows, so no task ever holds a whole table and a table
may be of any size; the text stays one line per row until it is folded.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.fixed_values import CELL_SEPARATOR, MISSING_CELL
from corpusqa.functions.tabletext import (
    BOOL,
    EXPONENT,
    FLOAT,
    INT,
    MISSING,
    TEXT,
    cell_kind,
    csv_cells,
    csv_records,
    decimals_needed,
    escaped,
    null_tokens,
    six_places,
    unquoted,
    whole_number,
    with_exponent,
    write_cell,
)
from corpusqa.functions.text import col, py_strip
from corpusqa.sources.shared import written

TABLE = ["path", "sheet"]


def row_line(cells: Column | str) -> Column:
    """Cells stripped and joined by `` | ``; null when the line is blank."""
    line = F.array_join(F.transform(col(cells), py_strip), CELL_SEPARATOR, "")
    return F.when(py_strip(line) != "", line)


def table_rows(table: DataFrame, path: Column, sheet: Column, row_no: Column) -> DataFrame:
    """A typed DataFrame as table rows, the header (row 0) included once per table.

    ``path`` and ``sheet`` tell which table a row is in and ``row_no`` (from 1)
    its place there; columns used only for that should be dropped from the
    cells by naming them with a leading underscore.
    """
    shown = [f for f in table.schema.fields if not f.name.startswith("_")]
    cells = [F.col(f"`{f.name}`").cast(T.StringType()) for f in shown]
    body = table.select(
        path.alias("path"), sheet.alias("sheet"), row_no.cast("bigint").alias("row_no"),
        F.array(*cells).alias("cells"),
    )
    names = F.array(*[F.lit(f.name) for f in shown])
    header = body.select(*TABLE).distinct().select(
        *TABLE, F.lit(0).cast("bigint").alias("row_no"), names.alias("cells")
    )
    return header.unionByName(body)


def csv_names(cells: Column) -> Column:
    """Column names of a header: a blank one becomes ``Unnamed: i``, a repeated one the next free ``name.n``."""
    whole = F.transform(
        cells, lambda c, i: F.when(c == "", F.concat(F.lit("Unnamed: "), i.cast("string"))).otherwise(c)
    )

    def numbered(names: Column) -> Column:
        def one(name: Column, i: Column) -> Column:
            earlier = F.size(F.filter(F.slice(names, F.lit(1), i), lambda n: n == name))
            tries = F.transform(
                F.sequence(F.lit(1), F.size(names)), lambda n: F.concat(name, F.lit("."), n.cast("string"))
            )
            free = F.filter(tries, lambda t: ~F.array_contains(names, t))
            return F.when(earlier > 0, F.get(free, earlier - 1)).otherwise(name)

        return F.transform(names, one)

    # one element, so that the names are made once
    return F.transform(F.array(whole), numbered)[0]


def csv_rows(texts: DataFrame) -> DataFrame:
    """``(path, text)`` of whole CSV files to table rows, one sheet named ``''``.

    Records and cells are cut inside the row, then exploded: no shuffle. Blank
    lines are skipped; the texts pandas takes for missing become null.
    """
    records = texts.select("path", F.posexplode(csv_records("text")).alias("row_no", "record"))
    cut = records.select("path", "row_no", F.transform(csv_cells("record"), unquoted).alias("raw"))
    return cut.select(
        "path",
        F.lit("").alias("sheet"),
        F.col("row_no").cast("bigint").alias("row_no"),
        F.when(F.col("row_no") == 0, csv_names(F.col("raw")))
        .otherwise(F.transform("raw", null_tokens))
        .alias("cells"),
    )


def column_layout(rows: DataFrame) -> DataFrame:
    """Per table the array ``layout`` with each column's kind, width and so on.

    One aggregate over (table, column), combined map-side, so what is shuffled
    is a few numbers per column and map task, whatever the number of rows.
    """
    cells = rows.select(
        *TABLE, (F.col("row_no") == 0).alias("is_name"), F.posexplode("cells").alias("pos", "cell")
    )
    is_name, cell = F.col("is_name"), F.col("cell")
    cells = cells.withColumn("kind", F.when(~is_name, cell_kind(cell))).withColumn(
        "places", F.when(F.col("kind").isin(INT, FLOAT), six_places(cell))
    )
    kind = F.col("kind")
    number = F.when(kind.isin(INT, FLOAT), F.abs(cell.try_cast("double")))

    def has(k: str) -> Column:
        return F.coalesce(F.bool_or(kind == k), F.lit(False))

    def widest(c: Column) -> Column:
        return F.coalesce(F.max(F.length(c)), F.lit(0))

    facts = cells.groupBy(*TABLE, "pos").agg(
        *[has(k).alias(f"has_{k}") for k in (TEXT, BOOL, FLOAT, INT, MISSING)],
        F.max(decimals_needed(F.col("places"))).alias("decimals"),
        widest(F.when(is_name, cell)).alias("w_name"),
        widest(F.when(~is_name, escaped(cell))).alias("w_text"),
        widest(F.when(kind == INT, whole_number(cell))).alias("w_int"),
        # A number with no fixed text is longer than any.
        widest(F.when(number.isNotNull(), F.coalesce("places", F.repeat(F.lit("9"), F.lit(99))))).alias("w_places"),
        widest(F.when(number.isNotNull(), with_exponent(cell))).alias("w_exponent"),
        F.coalesce(F.bool_or(number > 1e6), F.lit(False)).alias("has_large"),
        F.coalesce(F.bool_or((number > 0) & (number < 1e-6)), F.lit(False)).alias("has_small"),
        F.count(F.when(~is_name, 1)).alias("n_cells"),
        F.bool_or(is_name).alias("named"),
    )
    # Short records leave cells out altogether: missing, too.
    facts = facts.withColumn(
        "has_missing",
        F.col("has_missing") | (F.col("n_cells") < F.max("n_cells").over(Window.partitionBy(*TABLE))),
    )
    entry = F.struct("pos", *_decided({c: F.col(c) for c in facts.columns}))
    return facts.groupBy(*TABLE).agg(F.sort_array(F.collect_list(entry)).alias("layout"))


def _decided(fact: dict[str, Column]) -> list[Column]:
    """``kind, decimals, named, n_cells, lead, width`` of a column from what its cells have."""
    # Whole numbers with a gap among them become decimals, as they do in pandas,
    # and decimals get exponents by its rule.
    is_number = fact["has_int"] | fact["has_float"]
    fixed_width = fact["w_places"] - 6 + fact["decimals"]
    exponents = fact["has_small"] | (fact["has_large"] & (fixed_width > 12))
    kind = (
        F.when(fact["has_text"] | (fact["has_bool"] & is_number), TEXT)
        .when(fact["has_bool"], BOOL)
        .when(~is_number, MISSING)
        .when(~fact["has_float"] & ~fact["has_missing"], INT)
        .when(exponents, EXPONENT)
        .otherwise(FLOAT)
    )
    body_width = (
        F.when(kind == FLOAT, fixed_width)
        .when(kind == EXPONENT, fact["w_exponent"])
        .when(kind == INT, fact["w_int"])
        .otherwise(fact["w_text"])
    )
    # pandas sets the name of a numeric or boolean column one place in; booleans
    # with a gap among them are objects to it.
    objects = (kind == TEXT) | ((kind == BOOL) & fact["has_missing"])
    lead = F.when(objects, "").otherwise(" ")
    width = F.greatest(
        fact["w_name"] + F.length(lead), body_width, F.when(fact["has_missing"], len(MISSING_CELL)).otherwise(0)
    )
    return [
        kind.alias("kind"), fact["decimals"].alias("decimals"), fact["named"].alias("named"),
        fact["n_cells"].alias("n_cells"), lead.alias("lead"), width.alias("width"),
    ]


def layout_in_row(names: Column, body: Column) -> Column:
    """The layout of a table that is one value: ``names array<string>``, ``body array<array<string>>``.

    The same facts as ``column_layout`` has, by functions on arrays: nothing is
    exploded, joined or shuffled.
    """
    width = F.greatest(F.size(names), F.coalesce(F.array_max(F.transform(body, F.size)), F.lit(0)))

    def longest(texts: Column) -> Column:
        return F.coalesce(F.array_max(F.transform(texts, lambda t: F.coalesce(F.length(t), F.lit(0)))), F.lit(0))

    def read(cell: Column) -> Column:
        kind = cell_kind(cell)
        number = kind.isin(INT, FLOAT)
        return F.struct(
            kind.alias("kind"),
            F.when(number, six_places(cell)).alias("places"),
            F.when(number, F.abs(cell.try_cast("double"))).alias("number"),
            F.when(number, with_exponent(cell)).alias("exponent"),
            F.when(kind == INT, whole_number(cell)).alias("int"),
            escaped(cell).alias("text"),
        )

    def column(pos: Column) -> Column:
        # only cells that are there; a short record leaves some out
        present = F.transform(F.filter(body, lambda r: F.size(r) > pos), lambda r: F.get(r, pos))

        def facts(cells: Column) -> Column:
            def has(k: str) -> Column:
                return F.exists(cells, lambda c: c["kind"] == k)

            def widest(field: str) -> Column:
                return longest(F.transform(cells, lambda c: c[field]))

            places = F.transform(
                F.filter(cells, lambda c: c["number"].isNotNull()),
                lambda c: F.coalesce(c["places"], F.repeat(F.lit("9"), F.lit(99))),
            )
            return F.struct(*_decided({
                **{f"has_{k}": has(k) for k in (TEXT, BOOL, FLOAT, INT)},
                "has_missing": has(MISSING) | (F.size(cells) < F.size(body)),
                "decimals": F.array_max(F.transform(F.filter(cells, lambda c: c["places"].isNotNull()), lambda c: decimals_needed(c["places"]))),
                "w_name": F.coalesce(F.length(F.get(names, pos)), F.lit(0)),
                "w_text": widest("text"), "w_int": widest("int"), "w_places": longest(places),
                "w_exponent": widest("exponent"),
                "has_large": F.exists(cells, lambda c: F.coalesce(c["number"] > 1e6, F.lit(False))),
                "has_small": F.exists(cells, lambda c: F.coalesce((c["number"] > 0) & (c["number"] < 1e-6), F.lit(False))),
                "n_cells": F.size(cells), "named": pos < F.size(names),
            }))

        return F.transform(F.array(F.transform(present, read)), facts)[0]

    return F.transform(F.sequence(F.lit(0), width - 1), column)


def _with_layout(rows: DataFrame) -> DataFrame:
    """Rows joined to their table's layout.

    The rows are written first, so that their source is read once. The layouts are, too: a join
    with an aggregation by the same key is not split, one with a written table is, and
    a table with very many rows is skewed on the rows' side.
    """
    rows = written(rows, "table_rows")
    return rows.join(written(column_layout(rows), "layouts"), TABLE)


def _is_empty(at: Column) -> Column:
    """Whether a column has cells and all are missing."""
    return (at["kind"] == MISSING) & (at["n_cells"] > 0)


def drop_empty_table_columns(rows: DataFrame) -> DataFrame:
    """Table rows without the columns whose every value is missing, per table.

    A table without rows keeps its columns.
    """
    placed = F.zip_with(
        "cells", "layout", lambda c, at: F.struct(c.alias("cell"), _is_empty(at).alias("empty"))
    )
    kept = F.transform(F.filter(placed, lambda x: ~x["empty"]), lambda x: x["cell"])
    return _with_layout(rows).select(*TABLE, "row_no", kept.alias("cells"))


def drop_empty_columns(table: DataFrame) -> DataFrame:
    """A typed DataFrame without its all-null columns.

    One pass of counts; the result's schema depends on it, so this is the one
    operator that runs an action. It brings back one row.
    """
    counts = table.agg(*[F.count(f"`{c}`").alias(c) for c in table.columns]).first()
    return table.select(*[f"`{c}`" for c in table.columns if counts[c] > 0])


def aligned_line(cells: Column, layout: Column, is_header: Column, drop_empty_columns: bool = False) -> Column:
    """One row of a table with this layout as text."""

    def placed(cell: Column, at: Column) -> Column:
        name = F.concat(at["lead"], F.coalesce(cell, F.lit("")))
        text = F.when(is_header, name).otherwise(write_cell(cell, at["kind"], at["decimals"]))
        padded = F.lpad(text, at["width"], F.lit(" "))
        # The join below skips nulls.
        return F.when(~_is_empty(at), padded) if drop_empty_columns else padded

    line = F.array_join(F.zip_with(cells, layout, placed), " ")
    no_rows = F.concat(
        F.lit("Empty DataFrame\nColumns: ["), F.array_join(cells, ", "), F.lit("]\nIndex: []")
    )
    return F.when(F.exists(layout, lambda at: at["n_cells"] > 0), line).otherwise(no_rows)


def too_long(layout: Column) -> Column:
    """What is wrong with a table that has records of more cells than names; else null."""
    names = F.size(F.filter(layout, lambda at: at["named"]))
    return F.when(
        names < F.size(layout),
        F.concat(
            F.lit("Expected "), names.cast("string"), F.lit(" fields, saw "), F.size(layout).cast("string")
        ),
    )


def table_lines(rows: DataFrame, drop_empty_columns: bool = False) -> DataFrame:
    """Each table row as one aligned line: ``path, sheet, row_no, line, problem``.

    Right-aligned columns with one space between, the header line first; a
    table without rows is the three lines pandas prints for one. ``problem`` is set
    on the rows of a table in which a record has more cells than there are column
    names. ``drop_empty_columns`` leaves out columns whose every value is missing,
    by the same layout and so in the same pass.
    """
    line = aligned_line(F.col("cells"), F.col("layout"), F.col("row_no") == 0, drop_empty_columns)
    problem = too_long(F.col("layout"))
    return _with_layout(rows).select(
        *TABLE, "row_no", line.alias("line"), problem.alias("problem")
    )
