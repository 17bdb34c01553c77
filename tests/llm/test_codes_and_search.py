"""BPE, ranked search and vector codes against the library, brute force and small bounds."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusqa.llm import bpe, queries, ranked, vectorcodes
from tests.llm import odd

ROWS = odd.rows()


@pytest.fixture(scope="module")
def docs(spark):
    return odd.table(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return odd.table(spark, [])


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(queries.TOKENIZER)


# -- 11 ------------------------------------------------------------------------------

def test_words_end_where_the_vocabulary_splits(tokenizer):
    splitter = bpe.Splitter(["<|endoftext|>"])
    for c in [*map(chr, range(0x3100)), "😀", "﻿", "\U0001d7d8"]:
        text = f"a{c}b {c}{c} {c} x{c}\n{c}"
        words = splitter.words(text)
        assert "".join(words) == text
        starts = set(np.cumsum([0] + [len(w) for w in words])[:-1].tolist())
        assert starts <= {at[0] for _, at in tokenizer.pre_tokenizer.pre_tokenize_str(text)}


def test_numbers_packed():
    rng = random.Random(2)
    lists = [np.array([rng.randrange(1 << rng.randrange(1, 31)) for _ in range(rng.randrange(9))], np.int64) for _ in range(200)]
    for data, numbers in zip(bpe.packed_numbers(lists), lists):
        assert bpe.unpacked_numbers(data).tolist() == numbers.tolist()


@pytest.mark.parametrize("bounds", [{}, {"block": 500, "buckets": 7}])
def test_bpe_equals_library(docs, none, tokenizer, bounds, monkeypatch):
    monkeypatch.setattr(bpe, "BATCH", 1 << 19 if not bounds else 100)
    rows = bpe.encoded(docs.withColumn("decoded", F.lit(1)).withColumn("ids", F.lit(2)), queries.TOKENIZER, **bounds)
    assert rows.columns == [*docs.columns, "decoded", "ids"]
    got = bpe.decoded(rows.withColumn("k", F.col("ids")), queries.TOKENIZER).collect()
    assert sorted(str((r.doc_id, r.text)) for r in got) == sorted(str((r[0], r[1])) for r in ROWS)
    for r in got:
        want = tokenizer.encode(r.text or "", add_special_tokens=False).ids
        assert r.k == want
        assert r.decoded == (r.text or "") == tokenizer.decode(want, skip_special_tokens=False)
    assert bpe.decoded(bpe.encoded(none, queries.TOKENIZER), queries.TOKENIZER).count() == 0


def test_any_ids_decode_as_library(spark, tokenizer):
    rng = random.Random(1)
    some = [(i, [rng.randrange(50400) for _ in range(rng.randrange(60))]) for i in range(800)]
    some += [(-1, None), (-2, [None, 5, -7, 50256, 1 << 30])]
    rows = spark.createDataFrame(some, "n int, ids array<int>").withColumn("same", F.col("ids")).repartition(3)
    for r in bpe.decoded(rows, queries.TOKENIZER).collect():
        ids = [i for i in r.same or [] if i is not None and 0 <= i < 50257]
        assert r.decoded == tokenizer.decode(ids, skip_special_tokens=False)


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        bpe.described(queries.TOKENIZER.replace("byte_bpe_50k", "word_bpe_49k"))


def test_bpe_query(spark, tokenizer):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in queries.op11_bpe_round_trip(spark, sf_dir).collect():
        text = texts.pop(r.doc_id) or ""
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert not texts


# -- 12 ------------------------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_ranking(docs: list[tuple], items: list[tuple], top: int) -> list[tuple]:
    found = [(d, Counter(TERM.findall((t or "").translate(LOWER)))) for d, t in docs]
    sizes = [sum(c.values()) for _, c in found]
    n, total = sum(s > 0 for s in sizes), sum(sizes)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        best = []
        for (d, c), size in zip(found, sizes):
            score = 0
            for t in TERM.findall((text or "").translate(LOWER)):
                if t in c:
                    m = 100 - 25 + (25 * size * n) // total
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
            if score > 0:
                best.append((-score, d is None, d or 0, d))
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(sorted(best, key=lambda x: x[:3])[:top])]
    return out


ITEMS = [
    (1, ROWS[1][1]), (2, "The OF and, and the zzz-unknown"), (3, None), (4, ""), (5, "?!"), (6, "日本語 one ONE two"),
    (None, "three of a kind"), (2, ROWS[9][1]), (7, ROWS[0][1]),
]


def key(rows):
    return sorted(map(str, map(tuple, rows)))


@pytest.mark.parametrize("bounds", [{}, {"top": 3, "most": 2, "shard": 7, "block": 2}, {"top": 100, "shard": 5, "block": 1}])
def test_ranking_equals_brute_force(spark, docs, bounds):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    got = ranked.ranked(docs, items, **bounds).collect()
    want = brute_ranking([(r[0], r[1]) for r in ROWS], ITEMS, bounds.get("top", 20))
    assert key((r.item_id, r["rank"], r.doc_id, r.score) for r in got) == key(want)


def test_ranking_of_nothing(spark, docs, none):
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string")
    assert ranked.ranked(none, items).count() == 0
    assert ranked.ranked(docs, items.limit(0)).count() == 0
    assert ranked.ranked(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]


def test_copies_share_places_by_id(spark):
    rng = random.Random(4)
    texts = [(i, "alpha beta gamma" if i % 3 else odd.sentence(rng, 30)) for i in range(600)]
    rows = ranked.ranked(spark.createDataFrame(texts, "doc_id int, text string").repartition(5),
                         spark.createDataFrame([("q", "gamma alpha")], "item_id string, text string"), shard=50)
    assert [r.doc_id for r in rows.orderBy("rank").collect()] == [i for i in range(600) if i % 3][:20]


def test_blocks_are_skipped_and_bounds_hold():
    rng = np.random.default_rng(3)
    rows = (rng.random((300, 12)) * (rng.random((300, 12)) < 0.3) * 900_000).astype(np.float32).round()
    rows[:, 0] += 1
    weights = rng.integers(0, 9000, (12, 4)).astype(float)
    blocks = ranked.TermBlocks(np.arange(300), rows, 8)
    assert sorted(blocks.members.tolist()) == list(range(300))
    scores = rows.astype(float) @ weights
    need = np.sort(scores, axis=0)[-20]
    some, mask = blocks.candidates(weights, need)
    assert len(some) < 300
    may = np.zeros((300, 4), bool)
    may[blocks.members[some]] = mask
    assert may[scores >= need].all()
    assert mask.sum() < mask.size


# -- 13 ------------------------------------------------------------------------------

def brute_codes(rows: list[tuple]) -> tuple[list[tuple], str]:
    kept = [
        (i, [max(-(1 << 27), min(1 << 27, math.floor(256 * x))) for x in v], label) for i, v, label in rows
        if v and len(v) % 16 == 0 and all(x is not None and math.isfinite(x) for x in v)
    ]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    kept = [r for r in kept if len(r[1]) == len(kept[0][1])]
    x = np.array([r[1] for r in kept], np.int64).reshape(len(kept), 16, -1)
    books = x[:64].transpose(1, 0, 2).copy()

    def near(p):
        far = ((x[:, p, None, :] - books[p][None]) ** 2).sum(-1)
        return far.argmin(1), far.min(1)

    for _ in range(2):
        moved = books.copy()
        for p in range(16):
            which = near(p)[0]
            for e in set(which.tolist()):
                own = x[which == e, p]
                moved[p, e] = [int(s) // len(own) for s in own.sum(0)]
        books = moved
    found = [near(p) for p in range(16)]
    error = sum(far for _, far in found).tolist()
    total: dict = {}
    for r, e in zip(kept, error):
        total[r[2]] = total.get(r[2], 0) + e
    codes = ["".join(f"{found[p][0][i]:02x}" for p in range(16)) for i in range(len(kept))]
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return [(r[0], c, e, total[r[2]]) for r, c, e in zip(kept, codes, error)], digest


def odd_vectors() -> list[tuple]:
    rng = random.Random(8)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(48)], rng.choice([1, 1, 2, None])) for i in range(150)]
    rows += [(200 + i, rows[5][1], 7) for i in range(100)]  # copies
    rows += [
        (300, None, 1), (301, [], 1), (302, [0.5] * 47, 1), (303, [0.5] * 32, 1), (304, [None] + [0.1] * 47, 1),
        (305, [float("nan")] + [0.1] * 47, 1), (306, [float("-inf")] * 48, None), (307, [1e30, -1e30] * 24, 9),
        (None, [0.25] * 48, None), (3, [-0.001] * 48, 2), (308, [1.0] * 48, 3), (308, [1.0] * 48, 3),
    ]
    return rows


@pytest.mark.parametrize("n", [0, 1, 40, None])
def test_codes_equal_brute_force(spark, n):
    rows = odd_vectors()[:n]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("codes", F.lit(1))
    rounded = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    coded, books = vectorcodes.compressed(frame.repartition(3))
    got = vectorcodes.with_label_error(coded).withColumn("code", vectorcodes.hex_code(F.col("codes"))).collect()
    if not rows:
        assert got == []
        return
    want, digest = brute_codes(rounded)
    assert key((r.vec_id, r.code, r.error, r.label_error) for r in got) == key(want)
    assert vectorcodes.books_digest(books) == digest


def test_box_holds_the_nearest():
    rng = np.random.default_rng(1)
    entries, parts = rng.integers(-50, 50, (64, 4)), rng.integers(-80, 80, (3000, 4))
    entries[10], parts[0] = entries[3], entries[3]
    slices = vectorcodes.Slices(entries)
    far = ((parts[:, None, :] - entries[None]) ** 2).sum(-1)
    which, least = slices.nearest(parts)
    assert (which == far.argmin(1)).all() and (least == far.min(1)).all()
    inside = slices.inside(parts, np.full(len(parts), 20))
    want = (np.abs(parts[:, None, :] - entries[None]) <= 20).all(-1)
    assert (((inside[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(bool) == want).all()
