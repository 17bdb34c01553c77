from __future__ import annotations

import random
import re

import pytest

from corpusqa.fixed_values import DEFAULT_SEPARATORS, EXTENSION_LANGUAGES
from corpusqa.operators.chunking import (
    char_windows,
    code_chunks,
    html_header_sections,
    markdown_header_paths,
    markdown_sections,
    recursive_chunks,
    recursive_spans,
    separators_for,
    split_documents,
)


def by_lists(text, separators, size, overlap):
    """The splitting rule said with lists of strings, to check the spans against."""
    for at, separator in enumerate(separators):
        if separator == "" or re.search(separator, text):
            break
    if separator == "":
        pieces = list(text)
    else:
        cut = re.split(f"({separator})", text)
        pieces = [cut[0]] + [a + b for a, b in zip(cut[1::2], cut[2::2])]
        pieces = [p for p in pieces if p]
    chunks, run = [], []

    def pack():
        current, total = [], 0
        for piece in run:
            if total + len(piece) > size and current:
                chunks.append("".join(current))
                while total > overlap or (total + len(piece) > size and total > 0):
                    total -= len(current.pop(0))
            current.append(piece)
            total += len(piece)
        if current:
            chunks.append("".join(current))
        run.clear()

    for piece in pieces:
        if len(piece) < size:
            run.append(piece)
        else:
            pack()
            chunks += by_lists(piece, separators[at + 1 :], size, overlap)
    pack()
    return chunks


def random_text(rng, n):
    words = ["a", "bb", "class ", "def ", "\nclass ", "\ndef ", "\n\n", "\n", " ", "xyz" * 9, "é", "\n# h\n"]
    return "".join(rng.choice(words) for _ in range(n))


@pytest.mark.parametrize("lang", [None, "python", "java", "html", "markdown", "latex"])
def test_spans_equal_the_list_rule(lang):
    rng = random.Random(str(lang))
    separators = separators_for(lang)
    patterns = [re.compile(s) for s in separators if s]
    for _ in range(300):
        size = rng.choice([5, 20, 60])
        overlap = rng.choice([0, 1, size // 3])
        text = random_text(rng, rng.randrange(0, 80))
        spans = list(recursive_spans(text, patterns, size, overlap))
        want = by_lists(text, separators, size, overlap) if text else []
        assert [text[a:b] for a, b in spans] == want
        assert all(0 < b - a <= size for a, b in spans)
        covered = [False] * len(text)
        for a, b in spans:
            covered[a:b] = [True] * (b - a)
        assert all(covered)
        assert all(a < c <= b and b - c <= overlap for (a, b), (c, _) in zip(spans, spans[1:]))


def test_every_language_has_separators():
    for lang in EXTENSION_LANGUAGES.values():
        assert separators_for(lang)[-1] == ""
        assert len(separators_for(lang)) > len(DEFAULT_SEPARATORS)
        for s in separators_for(lang):
            re.compile(s)


def docs(spark, *rows):
    return spark.createDataFrame(list(rows), "path string, text string")


def chunks_of(df):
    return [(r.path, r.chunk_id, r.chunk) for r in df.orderBy("path", "chunk_id").collect()]


def test_recursive_chunks(spark):
    rng = random.Random(1)
    texts = {f"d{i}.txt": random_text(rng, rng.randrange(0, 2000)) for i in range(20)}
    texts |= {"blank.txt": " \n ", "edge.txt": "x" * 2000, "over.txt": "x" * 2001, "empty.txt": ""}
    got = chunks_of(recursive_chunks(docs(spark, *texts.items()), 500, 50))
    want = []
    for path in sorted(texts):
        parts = by_lists(texts[path], DEFAULT_SEPARATORS, 500, 50) if texts[path] else []
        filled = [c.strip() for c in parts if c.strip()]
        want += [(path, i, c) for i, c in enumerate(filled)]
    assert got == want


def test_code_chunks_use_the_language(spark):
    body = "".join(f"def f{i}():\n    return {i}\n\n\n" for i in range(40))
    got = chunks_of(code_chunks(docs(spark, ("a.py", body)), 200, 0))
    assert all(c.startswith("def ") for _, _, c in got)
    assert "".join(c for _, _, c in got).count("def ") == 40


def test_char_windows(spark):
    for n in [1, 200, 1999, 2000, 2001, 3800, 3801, 5601]:
        text = "".join(chr(97 + i % 26) for i in range(n - 1)) + "\U0001f600"
        got = [c for _, _, c in chunks_of(char_windows(docs(spark, ("a", text))))]
        count = max(1, -(-(n - 200) // 1800))
        assert got == [text[i * 1800 : i * 1800 + 2000] for i in range(count)]
    assert chunks_of(char_windows(docs(spark, ("a", "")))) == []


MARKDOWN = (
    "intro\nmore\n# One\nbody one\n```\n# not header\n```\n## Two\n\n### Three\nx\n"
    "#### four is text\n#nor this\n# Last\n~~~\n# open fence"
)


def test_markdown_sections(spark):
    rows = markdown_sections(docs(spark, ("a.md", MARKDOWN))).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.header, r.chunk) for r in rows] == [
        (0, None, "intro\nmore"),
        (1, "# One", "body one\n```\n# not header\n```"),
        (2, "### Three", "x\n#### four is text\n#nor this"),
        (3, "# Last", "~~~\n# open fence"),
    ]


def test_markdown_header_paths(spark):
    text = MARKDOWN + "\n~~~\n### Deep\nd\n## Side\ns\n# \n## Under\nu"
    rows = markdown_header_paths(docs(spark, ("a.md", text))).orderBy("chunk_id").collect()
    assert [(r.chunk_id, r.h1, r.h2, r.h3, r.chunk) for r in rows] == [
        (0, None, None, None, "intro\nmore"),
        (1, "One", None, None, "body one\n```\n# not header\n```"),
        (2, "One", "Two", "Three", "x\n#### four is text\n#nor this"),
        (3, "Last", None, None, "~~~\n# open fence\n~~~"),
        (4, "Last", None, "Deep", "d"),
        (5, "Last", "Side", None, "s"),
        (6, "", "Under", None, "u"),
    ]


def test_markdown_sections_of_a_very_long_document(spark):
    text = "x\n" * 300_000 + "# h\n" + "y\n" * 10
    rows = markdown_sections(docs(spark, ("a.md", text))).orderBy("chunk_id").collect()
    assert [len(r.chunk) for r in rows] == [599_999, 19]


def test_sections_can_be_split_further(spark):
    rows = markdown_sections(docs(spark, ("a.md", "# A\n" + "word " * 300 + "\n# B\nb")), max_size=100)
    got = rows.orderBy("chunk_id").collect()
    assert all(len(r.chunk) <= 100 for r in got)
    assert [r.header for r in got][0] == "# A" and got[-1].chunk == "b"
    assert len({r.chunk_id for r in got}) == len(got)


def test_html_sections(spark):
    page = (
        "<head><title>no</title></head><body>pre<nav>menu</nav><article><h1>T</h1><p>one</p>"
        "<H2 class='x'>U</H2><p>two</p><script>'<h1>'</script></article><header>h</header></body>"
    )
    got = [c for _, _, c in chunks_of(html_header_sections(docs(spark, ("p.html", page))))]
    assert got == ["pre", "menu", "T\n\none", "U\n\ntwo\n\nh"]


def test_html_sections_cut_at_tags_only(spark):
    page = "<h1>T</h1><p data-x='<h2>'>q</p><!-- <h3> --><script>'<nav>'</script><header>r</header><H2\nid=\"a>b\">U</H2>v"
    got = [c for _, _, c in chunks_of(html_header_sections(docs(spark, ("p.html", page))))]
    assert got == ["T\n\nq\n\nr", "U\n\nv"]


def test_split_documents_picks_the_splitter(spark):
    rows = [
        ("a.md", MARKDOWN), ("b.html", "<h1>A</h1>x<h2>B</h2>y"), ("c.txt", "plain " * 1000),
        ("d.py", "class A:\n    pass\n" * 300), ("e.csv", "short"),
    ]
    got = chunks_of(split_documents(docs(spark, *rows)))
    count = {p: sum(1 for q, _, _ in got if q == p) for p, _ in rows}
    assert count["a.md"] == 4 and count["b.html"] == 2 and count["e.csv"] == 1
    assert count["c.txt"] == 4 and count["d.py"] > 1
    only = {p: chunks_of(f(docs(spark, (p, t)))) for (p, t), f in zip(
        [rows[2], rows[3]], [recursive_chunks, code_chunks])}
    for path, want in only.items():
        assert [c for c in got if c[0] == path] == want


@pytest.mark.parametrize("size,overlap", [(10, 6), (10, 9), (7, 0), (5, 3), (1, 0)])
def test_windows_with_any_overlap(spark, size, overlap):
    texts = ["ABCDEFGHIJKLMNOPQRSTUVWXYZ"[:n] for n in range(1, 27)]
    df = spark.createDataFrame([(t, t) for t in texts], "path string, text string")
    got = {}
    for r in char_windows(df, size, overlap).orderBy("chunk_id").collect():
        got.setdefault(r.path, []).append(r.chunk)
    step = size - overlap
    for t in texts:
        starts = range(0, max(1, -(-(len(t) - overlap) // step)) * step, step)
        assert got[t] == [t[a : a + size] for a in starts]


def test_splitters_refuse_an_overlap_that_never_ends(spark):
    df = spark.createDataFrame([("a.txt", "x")], "path string, text string")
    for size, overlap in ((10, 10), (10, 12), (0, 0), (5, -1)):
        for split in (char_windows, recursive_chunks, code_chunks, split_documents):
            with pytest.raises(ValueError):
                split(df, size, overlap)


def test_splitter_holds_few_texts_at_once(monkeypatch):
    import pyarrow as pa

    from corpusqa.operators import chunking

    split = chunking._recursive_udf(10, 2).func
    texts, langs = ["one two three four", None, "", "five six seven"] * 40, [None] * 160
    held = []

    class Texts:
        def __init__(self, of):
            self.of = of

        def __len__(self):
            return len(self.of)

        def slice(self, lo, n):
            return Texts(self.of.slice(lo, n))

        def to_pylist(self):
            held.append(len(self.of))
            return self.of.to_pylist()

    got = split(Texts(pa.array(texts)), Texts(pa.array(langs, pa.string()))).to_pylist()
    assert 0 < max(held) <= chunking.ROWS < len(texts)
    patterns = chunking._compiled(DEFAULT_SEPARATORS)
    want = [t if t is None else [t[a:b].strip() for a, b in chunking.recursive_spans(t, patterns, 10, 2)] for t in texts]
    assert got == want
    assert len(split(pa.array([], pa.string()), pa.array([], pa.string()))) == 0
