"""HTML to plain text with built-in expressions only."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpusqa.fixed_values import HTML_SECTION_TAGS
from corpusqa.functions.text import col, literal_map, py_strip

# What stands in a tag after its name. A ``>`` inside a quoted value is no end, and only a
# value is quoted: a quote that nothing closes, or that follows no ``=``, is a character.
ATTRIBUTES = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
_REST = rf"(?:[\s/]{ATTRIBUTES})?+>"
TAG = rf"<[/!?]?[A-Za-z]{ATTRIBUTES}>"
# Parts of a page that are not text. An unclosed one runs to the end.
HIDDEN = "|".join(
    [r"<!--.*?(?:-->|\z)"]
    + [rf"<{tag}{_REST}.*?(?:</{tag}\s*>|\z)" for tag in ("script", "style", "template", "noscript", "title")]
)
# Tags that end a block of text.
BLOCK_TAG = (
    r"</?(?:address|article|aside|blockquote|body|br|dd|details|div|dl|dt|fieldset"
    r"|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section"
    rf"|summary|table|tbody|td|tfoot|th|thead|tr|ul){_REST}"
)
# Stands before each tag once a page is scanned; no character of any text.
MARK = "\ufdd0"
# References other than the ones plain replacements below can take.
_OTHER_ENTITY = r"&(?!(?:amp|lt|gt|quot);)[A-Za-z#]"
_ENTITY = r"^(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]+);"


# The named references of HTML 4, from the standard library, and one of XML.
ENTITIES = {name: chr(code) for name, code in name2codepoint.items()} | {"apos": "'"}


def _code_point(number: Column) -> Column:
    return F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")


def unescape(c: Column | str) -> Column:
    """Named and numeric character references to characters, in one pass.

    The text is cut at each ``&``; every piece starts with at most one
    reference, so ``&amp;lt;`` gives ``&lt;`` and is not read twice. A text with
    only the four commonest takes plain replacements, ``&amp;`` last.
    """
    c = col(c)
    entities = literal_map(ENTITIES)

    def piece(p: Column) -> Column:
        name = F.regexp_extract(p, _ENTITY, 1)
        rest = F.substring(p, F.length(name) + 2, F.lit(2**31 - 1))
        # leading zeros are no digits of the value; ten are more than any valid one has
        digits = F.regexp_extract(name, "^#[xX]?0*([0-9a-fA-F]{1,10})$", 1)
        number = F.when(name.rlike("^#[xX]"), F.conv(digits, 16, 10)).otherwise(digits).try_cast("bigint")
        valid = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        char = F.when(
            name.startswith("#"), F.when(valid, _code_point(number))
        ).otherwise(F.try_element_at(entities, name))
        return F.coalesce(
            F.when(name != "", F.concat(char, rest)), F.concat(F.lit("&"), p)
        )

    pieces = F.split(c, "&", -1)
    rest = F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), piece)
    whole = F.concat(F.get(pieces, F.lit(0)), F.array_join(rest, ""))
    plain = c
    for name, char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("amp", "&")):
        plain = F.replace(plain, F.lit(f"&{name};"), F.lit(char))
    return (
        F.when(~F.contains(c, F.lit("&")), c)
        .when(~c.rlike(_OTHER_ENTITY), plain)
        .otherwise(whole)
    )


def scanned(html: Column | str) -> Column:
    """HTML with a mark before each tag, and without comments, scripts, styles and titles.

    One scan from left to right, which takes each tag, comment and hidden element whole:
    what looks like a tag inside one of them is none, and has no mark.
    """
    html = F.replace(col(html), F.lit(MARK), F.lit(""))
    return F.regexp_replace(html, f"(?is)(?:{HIDDEN})|({TAG})", MARK + "$1")


def _text(page: Column) -> Column:
    """A scanned page's text."""
    text = F.regexp_replace(page, r"\s{2,}|[\t-\r]", " ")
    text = F.regexp_replace(text, f"(?i){MARK}{BLOCK_TAG}", "\n")
    text = unescape(F.regexp_replace(text, f"{MARK}(?:{TAG})?+", ""))
    return py_strip(F.regexp_replace(text, r"[ \xa0]*\n[ \xa0\n]*", "\n\n"))


def html_text(html: Column | str) -> Column:
    """Visible text: one paragraph per block, a blank line between blocks.

    Blanks inside a block collapse to one space, as a browser shows them.
    """
    return _text(scanned(html))


def html_sections(html: Column | str) -> Column:
    """The texts before, between and after heading and sectioning tags: ``array<string>``.

    The cut is a split at a look-ahead inside the row, so no shuffle is needed.
    """
    tags = "|".join(HTML_SECTION_TAGS)
    return F.transform(F.split(scanned(html), rf"(?i)(?={MARK}<(?:{tags})[\s/>])"), _text)
