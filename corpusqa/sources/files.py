"""Reading a directory of files into documents.

``files`` has ``path`` and ``content`` (the ``binaryFile`` columns);
``documents`` has ``path, ext, text, error``, where ``error`` tells why there
is no text.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusqa.fixed_values import EXTENSION_LANGUAGES
from corpusqa.functions.filetypes import (
    SUPPORTED_EXTENSIONS,
    file_extension,
    split_extension,
)
from corpusqa.functions.html import html_text
from corpusqa.functions.text import decode_text, fold_newlines, py_strip
from corpusqa.sources.csv_files import csv_table

UNSUPPORTED = "no way to read: "
HIDDEN_FILE = "hidden file"
FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def extension_glob(extensions: Iterable[str] = tuple(SUPPORTED_EXTENSIONS)) -> str:
    """A path glob for these extensions in any case, e.g. ``*.[pP][dD][fF]``."""

    def either_case(ext: str) -> str:
        return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in ext)

    return "*{" + ",".join(either_case(e) for e in extensions) + "}"


def list_files(
    spark: SparkSession, source_dir: str, extensions: Iterable[str] = tuple(SUPPORTED_EXTENSIONS)
) -> DataFrame:
    """Supported files directly under ``source_dir``, with their bytes.

    The glob drops other files while listing, so they are never opened; select
    ``path`` alone and no content is read at all. Sub-directories are not read;
    one named like ``key=value`` would be taken for a partition.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", extension_glob(extensions))
        .load(source_dir)
    )
    return supported_files(files)


def supported_files(files: DataFrame) -> DataFrame:
    """Keep the files whose name has a supported extension."""
    return files.filter(split_extension("path").isin(SUPPORTED_EXTENSIONS))


def plain_text(content: Column | str, encoding: str = "utf-8") -> Column:
    """Text file: decoded, newlines folded, both ends stripped."""
    return py_strip(fold_newlines(decode_text(content, encoding)))


def code_text(content: Column | str) -> Column:
    """Code or markup file: decoded and newlines folded, not stripped."""
    return fold_newlines(decode_text(content))


_TEXT_OR_ERROR = T.StructType(
    [T.StructField("text", T.StringType()), T.StructField("error", T.StringType())]
)


def _texts_or_errors(
    contents: pd.Series, read: Callable[[bytes], str], expected: type[Exception] | tuple
) -> pd.DataFrame:
    """One batch of files through a reader; ``expected`` errors become messages."""

    def one(content: bytes | None) -> tuple[str | None, str | None]:
        if content is None:
            return None, None
        try:
            text = read(bytes(content))
            text.encode()  # half a surrogate pair cannot be kept in a column
            return text, None
        except expected as problem:
            return None, str(problem) or type(problem).__name__

    return pd.DataFrame([one(c) for c in contents], columns=["text", "error"], dtype=object)


@F.pandas_udf(_TEXT_OR_ERROR)
def pretty_json(contents: pd.Series) -> pd.DataFrame:
    """JSON text re-printed with indent 2 and non-ASCII kept, or the parse error.

    Spark's own pretty printer spaces and breaks lines differently, so the
    bytes come from Python's printer, one Arrow batch at a time.
    """

    def read(content: bytes) -> str:
        return json.dumps(json.loads(content.decode()), indent=2, ensure_ascii=False)

    return _texts_or_errors(contents, read, (ValueError, RecursionError))


def _decoded(decode: Callable[[bytes], str]) -> Callable[[Column], Column]:
    """A caller's ``bytes -> str`` decoder as a column function with an error field."""

    @F.pandas_udf(_TEXT_OR_ERROR)
    def run(contents: pd.Series) -> pd.DataFrame:
        return _texts_or_errors(contents, decode, Exception)

    return run


def decode_rows(
    files: DataFrame, decode: Callable[[bytes], Iterable[tuple[Any, ...]]], schema: str
) -> DataFrame:
    """Rows inside binary files (PDF pages, blocks, sheet rows) by a caller's decoder.

    ``decode`` turns one file's bytes into row tuples; ``schema`` names their
    columns. ``path`` is put in front and ``error`` at the end: a file that
    fails gives one row holding only its path and the error.
    """
    width = len(files.sparkSession.createDataFrame([], schema).columns)

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for path, content in zip(part["path"], part["content"]):
                rows: list[tuple[Any, ...]] = []
                try:
                    rows += [(path, *row, None) for row in decode(bytes(content))]
                except Exception as problem:
                    rows = [(path, *[None] * width, str(problem) or type(problem).__name__)]
                if rows:
                    yield pd.DataFrame(rows, columns=range(width + 2), dtype=object)

    return files.select("path", "content").mapInPandas(
        batches, f"path string, {schema}, error string"
    )


_CODE = [e for e in EXTENSION_LANGUAGES if e != ".html"]


def _result(text: Column, error: Column | None = None) -> Column:
    none = F.lit(None).cast("string")
    return F.struct(text.alias("text"), (none if error is None else error).alias("error"))


def extract_text(
    files: DataFrame,
    encoding: str = "utf-8",
    decoders: Mapping[str, Callable[[bytes], str]] | None = None,
    drop_empty_columns: bool = False,
    raw_html: bool = False,
) -> DataFrame:
    """Text of each file in a table of files: ``path, ext, text, error``.

    Code and markup read as they are, HTML pages as visible text (with
    ``raw_html`` as they are, for splitting at their headings), ``.txt``
    stripped, JSON re-printed, CSV as an aligned table. Other document kinds
    need a decoder from the caller (``{".pdf": fn}``, bytes to text). A file
    without text keeps its row and says why in ``error``.

    One pass, inside the row. Python functions get null for the files of other kinds.
    """
    decoders = dict(decoders or {})
    ext, content = F.col("ext"), F.col("content")
    page = code_text("content") if raw_html else html_text(decode_text("content"))
    ways = {
        **{e: _result(code_text("content")) for e in _CODE},
        ".html": _result(page),
        ".txt": _result(plain_text("content", encoding)),
        ".json": pretty_json(F.when(ext == ".json", content)),
        ".csv": csv_table(code_text("content"), drop_empty_columns),
        **{e: _decoded(decode)(F.when(ext == e, content)) for e, decode in decoders.items()},
    }
    code = [e for e in _CODE if e not in decoders]
    read = F.when(ext.isin(code), _result(code_text("content")))
    for e, way in ways.items():
        if e not in code:
            read = read.when(ext == e, way)
    unsupported = F.concat(F.lit(UNSUPPORTED), F.col("path"))
    read = read.otherwise(_result(F.lit(None).cast("string"), unsupported))
    named = files.select("path", file_extension("path").alias("ext"), "content")
    return named.select("path", "ext", read.alias("r")).select("path", "ext", "r.text", "r.error")


def unlisted_files(spark: SparkSession, source_dir: str) -> DataFrame:
    """Supported files that Spark's readers pass over, ``path, error``: hidden and empty ones.

    Only names are read, on the driver, where Spark lists directories too.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    root = hadoop.Path(source_dir)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    found = []
    for top in system.globStatus(root) or []:
        for status in system.listStatus(top.getPath()) if top.isDirectory() else [top]:
            hidden = status.getPath().getName()[:1] in ("_", ".")
            if status.isFile() and (hidden or status.getLen() == 0):
                found.append((status.getPath().toString(), HIDDEN_FILE if hidden else None))
    return supported_files(spark.createDataFrame(found, "path string, error string"))


def read_texts(
    spark: SparkSession,
    source_dir: str,
    encoding: str = "utf-8",
    decoders: Mapping[str, Callable[[bytes], str]] | None = None,
    drop_empty_columns: bool = False,
    raw_html: bool = False,
) -> DataFrame:
    """``extract_text`` over a directory's supported files, each in the result.

    Kinds without a decoder are listed by name only, so these files aren't opened.
    """
    readable = [e for e in SUPPORTED_EXTENSIONS if e in {*_CODE, ".html", ".txt", ".json", ".csv", *(decoders or {})}]
    closed = [e for e in SUPPORTED_EXTENSIONS if e not in readable]
    texts = extract_text(
        list_files(spark, source_dir, readable), encoding, decoders, drop_empty_columns, raw_html
    )
    none = F.lit(None).cast("string").alias("text")
    ext = file_extension("path").alias("ext")
    if closed:
        names = list_files(spark, source_dir, closed)
        texts = texts.unionByName(
            names.select("path", ext, none, F.concat(F.lit(UNSUPPORTED), F.col("path")).alias("error"))
        )
    return texts.unionByName(unlisted_files(spark, source_dir).select("path", ext, none, "error"))


def documents(extracted: DataFrame) -> DataFrame:
    """The files that gave text."""
    return extracted.filter(F.col("error").isNull() & (F.length("text") > 0))


def rejects(extracted: DataFrame) -> DataFrame:
    """The files that gave none, with the stage and the reason."""
    empty = F.coalesce(F.length("text"), F.lit(0)) == 0
    return extracted.filter(F.col("error").isNotNull() | empty).select(
        "path",
        F.lit(None).cast("int").alias("chunk_id"),
        F.lit("extract").alias("stage"),
        F.coalesce("error", F.lit("no text")).alias("reason"),
    )
