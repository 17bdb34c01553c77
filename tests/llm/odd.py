"""A small table with every odd case: nulls, empty and long texts, copies, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    "key string, row string, fp bigint, h bigint, score double, content string, `at` int, t string, words string"
)
WORDS = "the of and to in for with that is on by this it from at as be are was has".split()


def sentence(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "x", "Y", "é", str(rng.randrange(40))]) for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(5)
    shared = sentence(rng, 70)
    texts: list[tuple[int | None, str | None]] = []
    for i in range(40):
        text = sentence(rng, rng.choice([3, 20, 60, 120]))
        if i % 5 == 0:
            text = f"{sentence(rng, 10)} {shared} {sentence(rng, 15)}"
        if i % 4 == 0:
            text += "\nAll of the same line here.\n"
        texts.append((i, text))
    texts += [
        (40, None), (41, ""), (42, "  \n\t "), (43, "one"), (44, "ONE"), (45, "Word  two\nthree"),
        (46, texts[0][1]), (47, texts[0][1]), (48, sentence(rng, 30_000)), (49, "ab " * 400),
        (None, "a null id"), (None, texts[7][1]), (51, "日本語 テキスト 😀 " * 12), (52, "?!... --"),
        (53, "a\x00b c\x01d  e f  g"), (54, "<|endoftext|> inside a text <|endoftext|>"),
    ]
    out = [
        (i, t, None if i == 3 else "en", None if i == 4 else f"src{n % 13}", None if i == 5 else len(t or ""),
         "k", "r", 1, 2, 0.9, "c", 3, "t", "w")
        for n, (i, t) in enumerate(texts)
    ]
    return [*out, out[2], out[10]]


def table(spark, some: list[tuple] | None = None):
    return spark.createDataFrame(rows() if some is None else some, SCHEMA)
