from __future__ import annotations

import html
import html.parser

import pytest
from pyspark.sql import functions as F

from corpusqa.functions.filetypes import (
    file_extension,
    file_kind,
    is_code_file,
    is_supported_extension,
    is_supported_file,
    language,
    split_extension,
    splitter,
)
from corpusqa.functions.html import html_text, unescape
from corpusqa.functions.money import currency, thousands
from corpusqa.functions.text import decode_text, py_strip
from corpusqa.functions.tokens import bpe_counter, counter_from, estimate_tokens
from corpusqa.sources.files import code_text, plain_text


def column(spark, values, expression, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression).collect()]


def test_strip_is_pythons(spark):
    blanks = [chr(c) for c in range(0x3100) if chr(c).isspace()]
    values = [b + "x" + b + "y" + b for b in blanks] + ["", " \n", "\ufeffx ", "\u200bx"]
    assert column(spark, values, py_strip("v")) == [v.strip() for v in values]


def test_decoding(spark):
    values = [b"a\r\nb\xe9", "é\r\x41".encode(), b"\xff\xfe", b"", b" x \n", b"\xed\xa0\x80"]
    got = column(spark, values, plain_text("v"), "binary")
    assert got == ["a\nbé", "é\nA", "ÿþ", "", "x", "í\xa0\x80"]
    assert column(spark, [b"  x \n"], code_text("v"), "binary") == ["  x \n"]
    assert column(spark, ["é".encode()], decode_text("v", "latin-1"), "binary") == ["Ã©"]
    values = ["aé".encode("utf-16"), "é".encode(), b"\xe9"]
    assert column(spark, values, decode_text("v", "utf_16"), "binary") == ["aé", "\ua9c3", "é"]
    assert column(spark, [b"\x81", b"\x80"], decode_text("v", "cp1252"), "binary") == ["\x81", "€"]
    with pytest.raises(LookupError):
        decode_text("v", "no-such-codec")


def test_extensions(spark):
    names = ["A.PDF", "a..txt", "README", ".PY", ".py", "..py", "d.x/a", "a.b/.c.TXT", "a.", ".tar.gz"]
    assert column(spark, names, file_extension("v")) == [
        ".pdf", ".txt", "", ".PY", ".py", "", "", ".txt", ".", ".gz",
    ]
    import os

    assert column(spark, names, split_extension("v")) == [
        os.path.splitext(n.lower())[1] for n in names
    ]


def test_kinds(spark):
    names = ["a.md", "a.csv", "a.zzz", "B.HTML", ".PY", "noext"]
    assert column(spark, names, file_kind("v")) == [
        "code", "document", "unknown", "code", "code", "unknown",
    ]
    assert column(spark, names, is_supported_file("v")) == [True, True, False, True, True, False]
    assert column(spark, names, is_code_file("v")) == [True, False, False, True, False, False]
    assert column(spark, ["PY", ".Md", "x"], is_supported_extension("v")) == [True, True, False]
    assert column(spark, names, splitter("v")) == [
        "markdown", "default", "default", "html", "default", "default",
    ]
    assert column(spark, ["a.rs", "a.zzz"], language("v")) == ["rust", None]
    with pytest.raises(Exception, match="Unsupported programming language extension"):
        column(spark, ["a.zzz"], language("v", strict=True))


def test_unescape_is_one_pass(spark):
    values = [
        "&lt;b&gt;", "&amp;lt;", "&#65;&#x42;&#38;amp;", "a & b &unknown; &", "&copy;&hellip;",
        "&amp;&amp;&quot;", "&#0;&#1114112;x", "no entities", "&apos;&nbsp;",
    ]
    got = column(spark, values, unescape("v"))
    want = [html.unescape(v) for v in values]
    want[6] = values[6]  # not characters: left as they are
    assert got == want


def test_html_text(spark):
    pages = [
        "<html><head><title>t</title></head><body><h1>A  b</h1><p>c <b>d</b><br>e</p></body></html>",
        "x<!-- <p>no</p> -->y<script>var a='<p>';</script><style>p{}</style>z",
        "<p>open <script>never closed",
        "1 < 2 and 3 > 2",
        "<head><body>kept</body>",
    ]
    assert column(spark, pages, html_text("v")) == [
        "A b\n\nc d\n\ne", "xyz", "open", "1 < 2 and 3 > 2", "kept",
    ]


class Shown(html.parser.HTMLParser):
    """The standard parser's view: text outside of hidden elements, without blanks."""

    def __init__(self):
        super().__init__()
        self.inside, self.text = [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title", "template", "noscript"):
            self.inside.append(tag)

    def handle_endtag(self, tag):
        if tag in self.inside:
            self.inside.remove(tag)

    def handle_data(self, data):
        if not self.inside:
            self.text.append(data)


ODD_PAGES = [
    '<p>a <img alt="x > y"> b</p>', '<h1>T</h1><p data-x="<h2>">q</p>', "<p a='>' b=\">\" c=d>e</p>",
    "<a href=x>it's</a> <a title='b\"c>d'>e</a>", '<p x = "1 > 2">f</p>', "<div\n class='<p>'\n>g</div>", "<br/><hr / >h",
    "<!-- <p> > --><!---->i", "<script>if (a < b) '<!--' </script>j", "<script src='</script>'>k()</script>l",
    "<title-bar>m</title-bar><titles>n</titles>", "1 < 2 > 0 <3 & <", "<!DOCTYPE html><?xml version='1'?>o",
    "<p>" + "".join(f'<i a{n}="{n} > {n}">r</i>' for n in range(300)) + "</p>", '<p t="' + "x>" * 30_000 + '">long</p>',
    "<p " + " ".join(f"a{n}=\"{n}\"" for n in range(1500)) + ">many</p>", "a\ufdd0<b>c</b>",
]


def test_html_tags_end_where_the_standard_parser_ends_them(spark):
    got = column(spark, ODD_PAGES, html_text("v"))
    for page, text in zip(ODD_PAGES, got):
        parser = Shown()
        parser.feed(page)
        parser.close()
        want = "".join("".join(parser.text).split()).replace("\ufdd0", "")
        assert "".join(text.split()) == want, page[:80]


def test_unclosed_tags_and_quotes_are_text_or_end_at_once(spark):
    pages = ['<p a="x>text</p>', "<p a='b", "<p>x<!-- open", "<style>never", '<b c=">" d="e>f</b>']
    assert column(spark, pages, html_text("v")) == ["text", "<p a='b", "x", "", "f"]


def test_amounts(spark):
    assert column(spark, [1234.5, -2.0, 0.0000005], currency("v"), "double") == [
        "$1,234.500000", "$-2.000000", "$0.000000",
    ]
    assert column(spark, [1234567], thousands("v"), "bigint") == ["1,234,567"]


def test_token_counters(spark):
    texts = ["Hello, world 12345!", "", "é—x"]
    assert column(spark, texts, estimate_tokens("v")) == [6, 0, 3]
    words = counter_from(lambda t: len(t.split()))
    assert column(spark, [*texts, None], words(F.col("v"))) == [3, 0, 1, None]


def test_bpe_counter_fails_early_without_its_tables(monkeypatch):
    tiktoken = pytest.importorskip("tiktoken")

    def missing(_):
        raise OSError("no tables")

    monkeypatch.setattr(tiktoken, "encoding_for_model", missing)
    with pytest.raises(OSError):
        bpe_counter()
