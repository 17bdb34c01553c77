"""CSV files as tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.fixed_values import CSV_NULL_TOKENS
from corpusqa.functions.tabletext import (
    DECIMAL,
    WHOLE,
    csv_cells,
    csv_records,
    null_tokens,
    unclosed,
    unquoted,
)
from corpusqa.operators.tables import aligned_line, csv_names, layout_in_row, too_long
from corpusqa.sources.csv_records import csv_file_records
from corpusqa.sources.shared import written as written_rows

NO_COLUMNS = "No columns to parse from file"
UNCLOSED_QUOTE = "a quote is never closed"


def read_csv_table(
    spark: SparkSession,
    path: str,
    encoding: str = "utf-8",
    multi_line: bool = False,
    schema: str | None = None,
    fallback: str | None = "ISO-8859-1",
) -> DataFrame:
    """One large CSV table with a header line, types inferred unless given.

    Files are split over tasks, also with ``multi_line``, which is for cells that hold
    line breaks (it reads the lines once more and deals them out by split). All of pandas' missing-value texts become null. Inference reads
    the data once more, so pass ``schema`` for a large table; Spark's reader
    knows only one null text, which is why inference runs on text columns with
    the others already nulled. Data that is no UTF-8 is read in the encoding
    ``fallback`` instead; that look at the raw lines is skipped with None.
    """
    if fallback and encoding.lower() in ("utf-8", "utf8"):
        valid = spark.read.text(path).agg(F.bool_and(F.is_valid_utf8("value")).alias("v")).first()["v"]
        encoding = encoding if valid in (True, None) else fallback
    if multi_line:
        raw = record_table(csv_file_records(spark, path, encoding))
    else:
        raw = spark.read.csv(path, header=True, encoding=encoding, quote='"', escape='"')
    raw = raw.toDF(*[c.removeprefix("\ufeff") for c in raw.columns])
    nulled = raw.select(
        *[F.when(~F.col(f"`{c}`").isin(CSV_NULL_TOKENS), F.col(f"`{c}`")).alias(c) for c in raw.columns]
    )
    if schema is None:
        types = inferred_types(nulled)
    else:
        types = {f.name: f.dataType for f in T._parse_datatype_string(schema).fields}
    return nulled.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) for c in raw.columns])


def record_table(records: DataFrame) -> DataFrame:
    """Records ``path, n, record`` as a table of text columns, named by the first file's first record.

    Each file begins with a header. Blank records are none; cells beyond the header are left
    out, and missing or empty bare ones are null.
    """
    records = written_rows(records.filter(F.col("record").rlike(r"\S")), "csv_records")
    heads = written_rows(records.groupBy("path").agg(F.min("n").alias("head")), "csv_heads")
    rows = records.join(heads, "path")
    first = rows.filter(F.col("n") == F.col("head")).orderBy("path").select("record").first()
    if first is None:
        raise ValueError(NO_COLUMNS)

    def cells(record: Column) -> Column:
        return F.transform(csv_cells(record), unquoted)

    names = records.sparkSession.range(1).select(cells(F.lit(first["record"]))).first()[0]
    names = [name or f"_c{i}" for i, name in enumerate(names)]
    cut = rows.filter(F.col("n") > F.col("head")).select(cells(F.col("record")).alias("cells"))
    return cut.select(*[F.nullif(F.get("cells", F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(names)])


def inferred_types(table: DataFrame) -> dict[str, T.DataType]:
    """bigint, decimal, double, boolean or string for each text column, in one aggregate.

    Whole numbers past 64 bits with sign are decimals of 20 digits, and text beyond that:
    a double would make different ones equal.
    """

    def fits(value: Column, kind: str) -> Column:
        return value.rlike(WHOLE) & value.try_cast(kind).isNotNull()

    tests = {
        "bigint": (T.LongType(), lambda v: fits(v, "bigint")),
        "decimal": (T.DecimalType(20, 0), lambda v: fits(v, "decimal(20,0)")),
        "double": (T.DoubleType(), lambda v: v.rlike(DECIMAL) & (~v.rlike(WHOLE) | fits(v, "decimal(20,0)"))),
        "boolean": (T.BooleanType(), lambda v: v.rlike(r"^(?i:true|false)$")),
    }
    aggregates = []
    for i, c in enumerate(table.columns):
        value = F.col(f"`{c}`")
        aggregates += [F.bool_and(F.when(value.isNotNull(), test(value))).alias(f"{i}_{t}") for t, (_, test) in tests.items()]
    found = table.agg(*aggregates).first()
    return {
        c: next((kind for t, (kind, _) in tests.items() if found[f"{i}_{t}"]), T.StringType())
        for i, c in enumerate(table.columns)
    }


def csv_text(texts: DataFrame, drop_empty_columns: bool = False) -> DataFrame:
    """``(path, text)`` of CSV files, and any other columns, to the same with the aligned table as text and ``error``."""
    table = csv_table(F.col("text"), drop_empty_columns)
    out = texts.withColumn("_table", table)
    return out.withColumns({"text": F.col("_table.text"), "error": F.col("_table.error")}).drop("_table")


def csv_table(text: Column, drop_empty_columns: bool = False) -> Column:
    """A CSV text as ``struct<text, error>``: its aligned table, cut, measured and written inside the row.

    A record longer than its header, a quote that is never closed, or no record at
    all is an error.
    """

    def cut(records: Column) -> Column:
        return F.transform(records, csv_cells)

    def table(raw: Column) -> Column:
        cells = F.transform(raw, lambda r: F.transform(r, unquoted))
        names = csv_names(F.get(cells, F.lit(0)))
        body = F.transform(F.slice(cells, F.lit(2), F.size(cells)), lambda r: F.transform(r, null_tokens))
        parts = F.struct(names.alias("names"), body.alias("body"), F.exists(raw, lambda r: F.exists(r, unclosed)).alias("open"))
        return _let(parts, measured)

    def measured(t: Column) -> Column:
        layout = layout_in_row(t["names"], t["body"])
        return _let(F.struct(t["names"].alias("names"), t["body"].alias("body"), t["open"].alias("open"), layout.alias("layout")), written)

    def written(t: Column) -> Column:
        def line(cells: Column, header: bool) -> Column:
            return aligned_line(cells, t["layout"], F.lit(header), drop_empty_columns)

        lines = F.concat(F.array(line(t["names"], True)), F.transform(t["body"], lambda r: line(r, False)))
        error = F.when(t["open"], UNCLOSED_QUOTE).otherwise(too_long(t["layout"]))
        return _let(error, lambda e: F.struct(
            F.when(e.isNull(), F.array_join(lines, "\n")).alias("text"), e.alias("error")
        ))

    nothing = F.struct(F.lit(None).cast("string").alias("text"), F.lit(NO_COLUMNS).alias("error"))
    return _let(csv_records(text), lambda records: F.when(F.size(records) == 0, nothing).otherwise(_let(cut(records), table)))


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is worked out once."""
    return F.transform(F.array(value), then)[0]
