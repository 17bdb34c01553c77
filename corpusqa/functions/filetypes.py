"""File name classification: extension, kind, language."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusqa.fixed_values import DOCUMENT_EXTENSIONS, EXTENSION_LANGUAGES
from corpusqa.functions.text import col, literal_map

SUPPORTED_EXTENSIONS = [*DOCUMENT_EXTENSIONS, *EXTENSION_LANGUAGES]

# The last dot of the last path component starts the extension, unless only
# dots stand before it in that component.
_SPLIT_EXTENSION = r"(?:^|/)\.*[^./][^/]*?(\.[^./]*)$"


def split_extension(name: Column | str) -> Column:
    """Lower-cased ``os.path.splitext`` extension, ``''`` when there is none."""
    return F.lower(F.regexp_extract(col(name), _SPLIT_EXTENSION, 1))


def file_extension(name: Column | str) -> Column:
    """Extension of a name; a bare extension such as ``.py`` returns as given.

    "Bare" means: starts with a dot and holds no other dot. It keeps its case.
    """
    name = col(name)
    return F.when(name.rlike(r"^\.[^.]*$"), name).otherwise(split_extension(name))


def _dotted(ext: Column) -> Column:
    return F.lower(F.when(ext.startswith("."), ext).otherwise(F.concat(F.lit("."), ext)))


def is_supported_extension(ext: Column | str) -> Column:
    """True for a known extension, with or without its dot, in any case."""
    return _dotted(col(ext)).isin(SUPPORTED_EXTENSIONS)


def is_supported_file(name: Column | str) -> Column:
    return is_supported_extension(file_extension(name))


def is_code_file(name: Column | str) -> Column:
    """True when the extension is in the language map (exact case if bare)."""
    return file_extension(name).isin(list(EXTENSION_LANGUAGES))


def file_kind(name: Column | str) -> Column:
    """``document``, ``code`` or ``unknown``. Markup files count as code."""
    ext = _dotted(file_extension(name))
    return (
        F.when(ext.isin(DOCUMENT_EXTENSIONS), "document")
        .when(ext.isin(list(EXTENSION_LANGUAGES)), "code")
        .otherwise("unknown")
    )


def language(name: Column | str, strict: bool = False) -> Column:
    """Language of a file name; null when unknown, an error when ``strict``.

    The map has 26 fixed entries, so it is a literal in the plan: no join.
    """
    ext = _dotted(file_extension(name))
    found = F.try_element_at(literal_map(EXTENSION_LANGUAGES), ext)
    if not strict:
        return found
    problem = F.concat(F.lit("Unsupported programming language extension: "), ext)
    return F.when(found.isNull(), F.raise_error(problem)).otherwise(found)


def splitter(name: Column | str) -> Column:
    """Which splitter a file takes: ``html``, ``markdown``, ``code``, ``default``."""
    ext = file_extension(name)
    return (
        F.when(ext == ".html", "html")
        .when(ext == ".md", "markdown")
        .when(ext.isin(list(EXTENSION_LANGUAGES)), "code")
        .otherwise("default")
    )
