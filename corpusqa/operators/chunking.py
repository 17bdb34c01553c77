"""Splitting document text into chunks.

Every splitter works inside the document's row and explodes the pieces, so
chunking never shuffles. ``documents`` needs ``path`` and ``text``; the result
has ``path, chunk_id, chunk`` (and any columns named in ``keep``).
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.fixed_values import (
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    DEFAULT_SEPARATORS,
    EXTENSION_LANGUAGES,
    LANGUAGE_KEYWORDS,
    LANGUAGE_SEPARATORS,
    MARKUP_SEPARATORS,
)
from corpusqa.functions.filetypes import language, splitter
from corpusqa.functions.html import html_sections
from corpusqa.functions.text import col, fold_newlines, py_strip

#: Texts of an Arrow batch that are split together.
ROWS = 64


def _exploded(documents: DataFrame, chunks: Column, keep: Sequence[str]) -> DataFrame:
    """One row per chunk, numbered in order; blank chunks are left out first."""
    filled = F.filter(chunks, lambda c: c != "")
    return documents.select("path", *keep, F.posexplode(filled).alias("chunk_id", "chunk"))


def _checked(size: int, overlap: int) -> int:
    """The size, if chunks of it with that overlap move on."""
    if size < 1 or not 0 <= overlap < size:
        raise ValueError(f"chunks of {size} characters can't overlap by {overlap}")
    return size


# -- fixed windows ------------------------------------------------------------


def window_texts(
    text: Column | str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP
) -> tuple[Column, Callable[[Column], Column]]:
    """Steps of a text, and the function from the steps to its windows.

    A step is the part of a window before its overlap. One pass of a regex cuts
    all steps, where a ``substring`` per window would each count characters from
    the start of the text. The steps must become a column of their own before
    the second function is used, or they would be cut again for every window.
    """
    step = _checked(size, overlap) - overlap
    steps = F.regexp_extract_all(col(text), F.lit("(?s).{1,%d}" % step), F.lit(0))

    def windows(steps: Column) -> Column:
        # A window that ends with the text is the last: none starts in its overlap.
        length = (F.size(steps) - 1) * step + F.length(F.try_element_at(steps, F.lit(-1)))
        count = F.greatest(F.lit(1), F.ceil((length - overlap) / step).cast("int"))
        spanned = -(-size // step)

        def window(piece: Column, i: Column) -> Column:
            return F.left(F.array_join(F.slice(steps, i + 1, spanned), ""), F.lit(size))

        return F.slice(F.transform(steps, window), F.lit(1), count)

    return steps, windows


def char_windows(
    documents: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Windows of ``size`` characters, each starting ``size - overlap`` after the last."""
    steps, windows = window_texts("text", size, overlap)
    cut = documents.select("path", *keep, steps.alias("_steps"))
    return _exploded(cut, windows(F.col("_steps")), keep)


# -- recursive splitting --------------------------------------------------------


def separators_for(language: str | None) -> list[str]:
    """Splitting patterns of a language, coarsest first; ``None`` is plain text."""
    if language in MARKUP_SEPARATORS:
        return MARKUP_SEPARATORS[language] + DEFAULT_SEPARATORS
    if language in LANGUAGE_KEYWORDS:
        words = LANGUAGE_KEYWORDS[language].split()
        patterns = [rf"\n{re.escape(word)} " for word in words]
        return patterns + LANGUAGE_SEPARATORS.get(language, []) + DEFAULT_SEPARATORS
    return DEFAULT_SEPARATORS


def recursive_spans(
    text: str, patterns: Sequence[re.Pattern], size: int, overlap: int
) -> Iterator[tuple[int, int]]:
    """Start and end of each chunk of one text.

    The text is cut before every match of the first pattern that occurs in it.
    Neighbouring pieces under ``size`` are packed into chunks of at most
    ``size``, each new chunk starting with the pieces that end the last one, up
    to ``overlap``. A piece of ``size`` or more is cut by the patterns after
    that one, and past the last pattern into fixed windows.
    """

    def windows(start: int, end: int) -> Iterator[tuple[int, int]]:
        while end - start > size:
            yield start, start + size
            start += size - overlap
        yield start, end

    def packed(bounds: list[int]) -> Iterator[tuple[int, int]]:
        # bounds: the piece edges of one run; every piece is shorter than size.
        first, last = 0, len(bounds) - 1
        while True:
            stop = bisect_right(bounds, bounds[first] + size) - 1
            if stop >= last:
                yield bounds[first], bounds[last]
                return
            yield bounds[first], bounds[stop]
            first = max(
                bisect_left(bounds, bounds[stop] - overlap, first),
                bisect_left(bounds, bounds[stop + 1] - size, first),
            )

    def split(start: int, end: int, level: int) -> Iterator[tuple[int, int]]:
        cuts: list[int] = []
        while level < len(patterns) and not cuts:
            found = patterns[level].finditer(text, start, end)
            cuts = [m.start() for m in found]
            level += 1
        if not cuts:
            yield from windows(start, end)
            return
        edges = [start, *(c for c in cuts if c > start), end]
        run = [start]
        for a, b in zip(edges, edges[1:]):
            if b - a < size:
                run.append(b)
                continue
            if len(run) > 1:
                yield from packed(run)
            yield from split(a, b, level)
            run = [b]
        if len(run) > 1:
            yield from packed(run)

    if text:
        yield from split(0, len(text), 0)


def _compiled(separators: Sequence[str]) -> list[re.Pattern]:
    return [re.compile(s) for s in separators if s]


def _recursive_udf(size: int, overlap: int):
    """Arrow-batched splitter over (text, language); null in, null out."""
    _checked(size, overlap)
    table = {lang: separators_for(lang) for lang in EXTENSION_LANGUAGES.values()}

    @F.arrow_udf("array<string>")
    def split(texts: pa.Array, languages: pa.Array) -> pa.Array:
        compiled: dict[str | None, list[re.Pattern]] = {}

        def one(text: str | None, lang: str | None) -> list[str] | None:
            if text is None:
                return None
            if lang not in compiled:
                compiled[lang] = _compiled(table.get(lang, DEFAULT_SEPARATORS))
            spans = recursive_spans(text, compiled[lang], size, overlap)
            return [text[a:b].strip() for a, b in spans]

        # a batch's texts are Python strings a few at a time only
        parts = [pa.array([], pa.list_(pa.string()))]
        for lo in range(0, len(texts), ROWS):
            some = zip(texts.slice(lo, ROWS).to_pylist(), languages.slice(lo, ROWS).to_pylist())
            parts.append(pa.array([one(t, l) for t, l in some], pa.list_(pa.string())))
        return pa.concat_arrays(parts)

    return split


def _recursive_pieces(text: Column, lang: Column, size: int, overlap: int) -> Column:
    """Chunks of a text. One that fits a chunk is stripped natively: the UDF gets null."""
    fits = F.length(text) <= size
    long_text = F.when(~fits, text)
    return F.when(fits, F.array(py_strip(text))).otherwise(
        _recursive_udf(size, overlap)(long_text, lang)
    )


def recursive_chunks(
    documents: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Plain text: split at blank lines, lines, spaces, then anywhere."""
    pieces = _recursive_pieces(F.col("text"), F.lit(None).cast("string"), size, overlap)
    return _exploded(documents, pieces, keep)


def code_chunks(
    documents: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    lang: Column | str | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Source code: split first where the file's language starts a construct."""
    lang = language("path") if lang is None else col(lang)
    return _exploded(documents, _recursive_pieces(F.col("text"), lang, size, overlap), keep)


# -- header splitting -------------------------------------------------------------

_MD_FENCE = (
    r"(?:[ \t]*```[^`\n]*+\n(?:(?![ \t]*```)[^\n]*+\n)*+[^\n]*+(?:\n|\z)"
    r"|[ \t]*~~~[^\n]*+\n(?:(?![ \t]*~~~)[^\n]*+\n)*+[^\n]*+(?:\n|\z))"
)


def _md_header(levels: str) -> str:
    """Pattern of a header line with that many ``#``."""
    return r"[ \t]*#{%s}(?:[ \t][^\n]*+)?+(?:\n|\z)" % levels


def _md_section(levels: str) -> str:
    """Pattern of a header line and all up to the next, or of what stands before the first."""
    header = _md_header(levels)
    body = rf"(?:{_MD_FENCE}|(?!{header})[^\n]*+(?:\n|\z))"
    return rf"(?:{header}{body}*+|{body}++)"


_MD_SECTION = _md_section("1,3")
_MD_HEAD = rf"\A{_md_header('1,3')}"


def _headed(section: Column, levels: str) -> tuple[Column, Column]:
    """A section's header line (null if it has none) and its body, both stripped."""
    head = F.regexp_extract(section, rf"\A{_md_header(levels)}", 0)
    body = F.substring(section, F.length(head) + 1, F.lit(2**31 - 1))
    return F.when(head != "", py_strip(head)), py_strip(body)


def markdown_sections(
    documents: DataFrame, keep: Sequence[str] = (), max_size: int | None = None
) -> DataFrame:
    """Markdown: one chunk per ``#``, ``##`` or ``###`` section, of any length.

    The chunk is the stripped body without its header line, which is kept as
    ``header`` (null before the first one). Lines inside ``` or ~~~ fences are
    not headers. Sections are matched inside the row by a pattern that never
    backs up, so neither lines nor sections are shuffled. ``max_size`` splits
    longer sections recursively.
    """
    sections = F.regexp_extract_all(fold_newlines("text"), F.lit(_MD_SECTION), F.lit(0))

    def parts(section: Column) -> Column:
        header, body = _headed(section, "1,3")
        return F.struct(header.alias("header"), body.alias("chunk"))

    filled = F.filter(F.transform(sections, parts), lambda s: s["chunk"] != "")
    found = documents.select("path", *keep, F.posexplode(filled).alias("chunk_id", "_s"))
    return _resized(
        found.select("path", *keep, "chunk_id", "_s.header", "_s.chunk"), [*keep, "header"], max_size
    )


def markdown_header_paths(documents: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``markdown_sections`` with the headings each section stands under: ``h1, h2, h3``.

    The text is cut at ``#``, each piece at ``##``, each of those at ``###``, so
    a piece's headings come from the cuts around it; the levels are nested
    arrays of one row and nothing is shuffled or carried from row to row.
    """

    def title(header: Column) -> Column:
        return py_strip(F.regexp_replace(header, "^#+", ""))

    def cut(text: Column, level: int, above: list[Column]) -> Column:
        pattern = F.lit(_md_section(str(level)))
        pieces = F.filter(F.regexp_extract_all(text, pattern, F.lit(0)), lambda p: p != "")

        def piece(p: Column) -> Column:
            header, body = _headed(p, str(level))
            titles = [*above, title(header)]
            if level == 3:
                names = [t.alias(f"h{n}") for n, t in enumerate(titles, 1)]
                return F.struct(*names, body.alias("chunk"))
            return cut(body, level + 1, titles)

        cuts = F.transform(pieces, piece)
        return cuts if level == 3 else F.flatten(cuts)

    sections = F.filter(cut(fold_newlines("text"), 1, []), lambda s: s["chunk"] != "")
    found = documents.select("path", *keep, F.posexplode(sections).alias("chunk_id", "_s"))
    return found.select("path", *keep, "chunk_id", "_s.h1", "_s.h2", "_s.h3", "_s.chunk")


def html_header_sections(
    documents: DataFrame, keep: Sequence[str] = (), max_size: int | None = None
) -> DataFrame:
    """Raw HTML (column ``text``): one chunk of plain text per heading or section tag."""
    return _resized(_exploded(documents, html_sections("text"), keep), list(keep), max_size)


def _resized(chunks: DataFrame, keep: list[str], max_size: int | None) -> DataFrame:
    """With ``max_size``, chunks over it split further and ids paired into one number."""
    if max_size is None:
        return chunks.select("path", *keep, "chunk_id", "chunk")
    parts = recursive_chunks(
        chunks.withColumnRenamed("chunk_id", "_section_id").withColumnRenamed("chunk", "text"),
        max_size, min(CHUNK_OVERLAP, max_size // 10), ["_section_id", *keep],
    )
    # Ids only have to be unique and in order: section in the high half.
    return parts.withColumn(
        "chunk_id", F.shiftleft(F.col("_section_id").cast("bigint"), 32) + F.col("chunk_id")
    ).drop("_section_id")


# -- choice by extension --------------------------------------------------------------


def split_documents(
    documents: DataFrame,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
    html_is_raw: bool = True,
) -> DataFrame:
    """Chunks of each document by the splitter its extension asks for.

    ``.html`` goes by headings, ``.md`` by headers, other code by its language,
    everything else by the default separators. All in one pass over the
    documents: the Python splitter gets null for what the native ones take.
    With ``html_is_raw=False`` the text of a page is already plain and is one chunk.
    """
    kind = F.col("_splitter")
    text = F.col("text")
    by_size = F.when(kind.isin("code", "default"), text)
    lang = F.when(kind == "code", language("path"))
    pieces = _recursive_pieces(by_size, lang, size, overlap)
    html = html_sections(text) if html_is_raw else F.array(text)
    sections = F.regexp_extract_all(fold_newlines(text), F.lit(_MD_SECTION), F.lit(0))
    chunks = (
        F.when(kind == "html", html)
        .when(
            kind == "markdown",
            F.transform(sections, lambda s: py_strip(F.regexp_replace(s, _MD_HEAD, ""))),
        )
        .otherwise(pieces)
    )
    return _exploded(documents.withColumn("_splitter", splitter("path")), chunks, [])
