"""The ten operators against brute force on odd rows, empty tables and small bounds."""

from __future__ import annotations

import collections
import hashlib
import math
import pathlib
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from corpusqa.llm import (
    decontaminate, licences, linededup, packing, private, queries, sampling, shard, simhash, suffix, toxicity,
)
from corpusqa.llm.common import ALNUM, Words
from tests.llm import odd

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SOLID_WORD = re.compile(r"[^\x20\x09-\x0D]+")
ROWS = odd.rows()
TEXTS = [(r[0], r[1]) for r in ROWS]


@pytest.fixture(scope="module")
def docs(spark):
    return odd.table(spark).cache()


@pytest.fixture(scope="module")
def none(spark):
    return odd.table(spark, [])


def same(got: list[tuple], want: list[tuple]) -> None:
    def plain(rows):
        return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))

    assert plain([tuple(r) for r in got]) == plain(want)


# -- 1 -------------------------------------------------------------------------------

def test_licences(spark, docs, none):
    known = licences.known_licences(spark)
    mit = next(t for n, t in licences.KNOWN if t.startswith("MIT License"))
    texts = [
        (1, mit.replace("<year> <copyright holders>", "2020 A. Person")), (2, mit.upper().replace('"', "'")),
        (3, "Some words\nreleased under the MIT licence!\n(c) 2001 me"), (4, "All rights reserved."), (5, None), (6, ""),
        (7, "Copyright 2020 someone"), (8, mit + "\nAnd more."), (9, "Licensed under the Apache License, v. 2.0"), (9, "x"),
    ]
    rows = licences.scanned(spark.createDataFrame(texts, "doc_id bigint, text string"), known)
    got = [(r.doc_id, r.licences, r.notices) for r in rows.collect()]
    same(got, [
        (1, ["MIT"], None), (2, ["MIT"], None), (3, None, ["MIT"]), (4, ["all-rights-reserved"], ["all-rights-reserved"]),
        (5, None, None), (6, None, None), (7, None, None), (8, None, None), (9, ["Apache-2.0"], ["Apache-2.0"]), (9, None, None),
    ])
    assert licences.scanned(docs, known).count() == len(ROWS)
    assert licences.scanned(none, known).count() == 0


def test_long_licences_and_wordings(spark):
    folder = pathlib.Path("/usr/share/common-licenses")
    names = {
        "Apache-2.0": "Apache-2.0", "Artistic": "Artistic-1.0-Perl", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0",
        "GFDL-1.3": "GFDL-1.3", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0",
    }
    texts, want = [], {}
    for file, name in names.items():
        if (folder / file).exists():  # reflowed and in upper case, with a line of copyright
            words = "Copyright 2024 A. Person\n" + (folder / file).read_text()
            texts += [(len(texts), words), (len(texts) + 1, words.upper()), (len(texts) + 2, words[: len(words) // 2])]
            want |= {len(texts) - 3: [name], len(texts) - 2: [name], len(texts) - 1: None}
    bsd = [t for n, t in licences.KNOWN if t.startswith("BSD 2-Clause License")]
    lines = [
        (bsd[1], "BSD-2-Clause"), ("This work is licensed under the MIT License.", "MIT"), ("# SPDX-License-Identifier: GPL-3.0-only", "GPL-3.0"),
        ("Distributed under the GNU Lesser General Public Licence, v. 2.1", "LGPL-2.1"), ("Released under the Mozilla Public License, v. 2.0", "MPL-2.0"),
        ("Licensed under nothing", None), (bsd[0].replace("source code", "code"), None),
    ]
    for text, name in lines:
        want[len(texts)] = name and [name]
        texts.append((len(texts), text))
    got = licences.scanned(spark.createDataFrame(texts, "doc_id bigint, text string"), licences.known_licences(spark))
    assert {r.doc_id: r.licences for r in got.collect()} == want
    named = {n for n, _ in licences.KNOWN} | {n for n, _, _ in licences.DIGESTS}
    assert named - {"all-rights-reserved"} == {n for n, _, _ in licences.NAMES}


# -- 2 -------------------------------------------------------------------------------

def test_network_gradient():
    words = Words([b"a bb ccc dd idiot x yy", b"q bb zz", b""], ALNUM, True)
    lexicon, number = toxicity.Lexicon.of(words)
    at = np.append(number, -1)[toxicity.windows(words.first, 6, 3)[0]]
    net = toxicity.Network(np.sort(lexicon.h[:4]))
    net.start()
    net.p = {k: v.astype(float) for k, v in net.p.items()}
    label = (np.arange(len(at)) % 2).astype(float)
    grad = net.gradients(lexicon, at, label)[1]
    for name, values in net.p.items():
        place = {"char": (lexicon.rows[2], 3), "word": (1, 2)}.get(name, tuple(s - 1 for s in values.shape))
        kept, found = values[place], []
        for step in (1e-3, -1e-3):
            values[place] = kept + step
            found.append(net.gradients(lexicon, at, label)[0])
        values[place] = kept
        assert (found[0] - found[1]) / 2e-3 == pytest.approx(grad[name][place], rel=1e-3, abs=1e-8)


def _plain_traits(net: toxicity.Network, text: str) -> list[float]:
    """The network's four numbers, word by word and window by window in plain loops."""
    p, h, limit = net.p, toxicity.HIDDEN, 1 << 64

    def sigmoid(x):
        return 1 / (1 + np.exp(-x))

    def vector(word):
        marked, rows = f"\0{word}\0", []
        for n in toxicity.NGRAMS:
            for i in range(len(marked) - n + 1):
                code = n
                for c in marked[i : i + n]:
                    code = (code * 0x100000001B3 + ord(c)) % limit
                rows.append(int(toxicity.mixed(np.array([code], np.uint64))[0]) % toxicity.CHAR_ROWS)
        known = np.flatnonzero(net.vocabulary == Words([word.encode()], ALNUM, True).hashes()[0])
        char = sum(p["char"][r] for r in rows) / len(rows) ** 0.5
        return np.concatenate([p["word"][known[0] + 1 if len(known) else 0], char])

    def run(d, inputs):
        state, out = np.zeros(h), []
        for x in inputs:
            share = x @ p["W"][d] + p["b"][d, 0]
            past = state @ p["U"][d]
            z, r = sigmoid(share[:h] + past[:h]), sigmoid(share[h : 2 * h] + past[h : 2 * h])
            state = (1 - z) * np.tanh(share[2 * h :] + r * past[2 * h :]) + z * state
            out.append(state)
        return out

    words = ALNUM_WORD.findall(text.translate(LOWER))
    logits, at = [], 0
    while True:
        inputs = [vector(w) for w in words[at : at + toxicity.WIDTH]]
        logit = float(p["o"][0])
        if inputs:
            states = [np.concatenate(s) for s in zip(run(0, inputs), run(1, inputs[::-1])[::-1])]
            force = np.exp([np.tanh(s @ p["A"] + p["a"]) @ p["v"] for s in states])
            logit += float(sum(f * (s @ p["w"]) for f, s in zip(force, states)) / force.sum())
        logits.append(logit)
        if at + toxicity.WIDTH >= len(words):
            break
        at += toxicity.STEP
    share = sum(sigmoid(x) for x in logits) / len(logits)
    return [max(logits), 10 * share, math.log(len(logits)), 1.0]


def test_network_equals_plain_loops():
    texts = [t for _, t in TEXTS if len(t or "") < 20_000]
    words = Words([(t or "").encode() for t in texts], ALNUM, True)
    net = toxicity.Network(np.unique(words.hashes())[::3])
    net.start()
    net.p["o"][0] = 0.25
    want = np.array([_plain_traits(net, t or "") for t in texts])
    assert net.traits(texts) == pytest.approx(want, rel=1e-3, abs=1e-4)
    net.curve = np.array([0.7, 0.3, -0.2, 0.1])
    assert net.scores(texts) == pytest.approx(1 / (1 + np.exp(-want @ net.curve)), rel=1e-3, abs=1e-4)


def test_curve_is_fitted_on_all_windows(spark, monkeypatch):
    rng = __import__("random").Random(4)
    texts = [(i, odd.sentence(rng, 900 if i % 2 else 30)) for i in range(40)]
    labels = spark.createDataFrame([(i, i // 2 % 2) for i in range(40)], "doc_id bigint, toxic int")
    fitted = []
    fit = toxicity._logistic
    monkeypatch.setattr(toxicity, "_logistic", lambda x, y, weight: fitted.append(x) or fit(x, y, weight))
    network = toxicity.learned(spark.createDataFrame(texts, "doc_id bigint, text string"), labels)
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert fitted[0] == pytest.approx(network.traits([texts[i][1] for i in ids]), rel=1e-5)
    assert np.exp(fitted[0][:, 2]).max() > 2 * toxicity.SAMPLED


def test_windows_cover_and_overlap():
    at, text = toxicity.windows(np.array([0, 0, 5, 100]), 32, 24)
    assert collections.Counter(text.tolist()) == {0: 1, 1: 1, 2: 4}
    assert set(at[text == 2].ravel()) - {-1} == set(range(5, 100))
    assert (at[0] == -1).all()


def test_toxicity_learns(spark, none):
    rng = __import__("random").Random(1)
    rows = []
    for i in range(600):
        words = odd.sentence(rng, rng.choice([8, 40, 150])).split()
        if i % 3 == 0:
            for _ in range(1 + len(words) // 20):
                words.insert(rng.randrange(len(words)), rng.choice(["Rotten!", "VILE", "nastyish", "nastyer"]))
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    docs = spark.createDataFrame([*rows, (9000, None, 0), (9001, "", 0)], "doc_id bigint, text string, toxic int")
    labels = docs.select("doc_id", "toxic").union(spark.createDataFrame([(None, 1), (1, None), (77777, 1)], "doc_id bigint, toxic int"))
    network = toxicity.learned(docs.drop("toxic"), labels)
    got = docs.select("doc_id", "toxic", toxicity.held_out(F.col("doc_id")).alias("out"), toxicity.score(F.col("text"), network).alias("s")).collect()
    held = [r for r in got if r.out and r.doc_id < 9000]
    right = sum((r.s >= 0.7) == (r.toxic == 1) for r in held)
    assert right >= 0.95 * len(held)
    assert all(r.out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    empty = {r.doc_id: r.s for r in got if r.doc_id >= 9000}
    assert empty[9000] == empty[9001] < 0.7
    kept = toxicity.kept_rows(docs, labels)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if r.s < 0.7}
    assert toxicity.learned(none, labels) is None
    assert toxicity.kept_rows(none, labels).columns == none.columns


def test_toxicity_without_labels(spark, docs):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert toxicity.kept_rows(docs, labels).count() == len(ROWS)


def test_toxicity_learns_from_one_row_an_id(spark, monkeypatch):
    rng = __import__("random").Random(3)
    rows = [(i, odd.sentence(rng, 20)) for i in range(40)] + [(0, odd.sentence(rng, 20)) for _ in range(300)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id bigint, toxic int")
    collected, learned = [], []
    to_pandas = type(labels).toPandas

    def counted(frame):
        out = to_pandas(frame)
        collected.append(len(out))
        return out

    monkeypatch.setattr(type(labels), "toPandas", counted)
    monkeypatch.setattr(toxicity, "train", lambda texts, *_: learned.append(texts))
    # ids outside the held-out third; 0 is one of them
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    assert 0 in ids
    for some in (rows, rows[::-1]):
        toxicity.learned(spark.createDataFrame(some, "doc_id bigint, text string").coalesce(1), labels)
    assert collected == [len(ids)] * 2
    assert learned[0] == learned[1]


# -- 3 -------------------------------------------------------------------------------

def _windows(words: list[str], size: int) -> set[tuple]:
    n = min(size, len(words))
    return {tuple(words[a : a + n]) for a in range(len(words) - n + 1)} if words else set()


@pytest.mark.parametrize("shingle", [5, 2])
def test_decontamination(spark, docs, none, shingle):
    items = [
        (1, ROWS[0][1][20:400]), (2, "one"), (3, None), (4, ""), (5, "The OF and"), (None, ROWS[1][1]), (1, "three"), (10, ROWS[0][1][20:400]),
    ]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = collections.defaultdict(set)
    for i, text in items:
        for w in _windows(ALNUM_WORD.findall((text or "").translate(LOWER)), 13):
            found[w].add(i)
    want = []
    for d, text in TEXTS:
        words, hit, ids = ALNUM_WORD.findall((text or "").translate(LOWER)), set(), set()
        for w, named in found.items():
            for a in range(len(words) - len(w) + 1):
                if tuple(words[a : a + len(w)]) == w:
                    hit.update(range(a, a + len(w)))
                    ids |= named - {None}
        want.append((d, len(words), len(hit), sorted(ids), len(hit) > 0 and 20 * len(hit) >= len(words)))
    rows = decontaminate.measured(docs, bench, shingle=shingle).collect()
    same([(r.doc_id, r.n_words, r.n_hit, sorted(r.item_ids or []), r.contaminated) for r in rows], want)
    kept = decontaminate.clean_rows(docs, bench)
    assert kept.schema == docs.schema
    same([tuple(r) for r in kept.collect()], [r for r, w in zip(ROWS, want) if not w[4]])
    nothing = bench.limit(0)
    assert decontaminate.clean_rows(docs, nothing).count() == len(ROWS)
    assert decontaminate.measured(none, bench).count() == 0


# -- 4 -------------------------------------------------------------------------------

@pytest.mark.parametrize("sites", [2, 5])
def test_line_dedup(docs, none, sites):
    spread = collections.defaultdict(set)
    for r in ROWS:
        for line in (r[1] or "").split("\n"):
            spread[line].add(r[3])
    gone = {line for line, s in spread.items() if len(s) >= sites and line.strip(" ")}
    want, counts = [], []
    for r in ROWS:
        lines = [] if r[1] is None else r[1].split("\n")
        left = [x for x in lines if x not in gone]
        text = r[1] if len(left) == len(lines) else "\n".join(left)
        want.append((r[0], text, *r[2:4], r[4] if text == r[1] else len(text), *r[5:]))
        counts.append((r[0], len(lines), len(lines) - len(left), text))
    out = linededup.without_boilerplate(docs, sites=sites)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    same(out.collect(), want)
    same(linededup.line_counts(docs, sites=sites).collect(), counts)
    assert linededup.without_boilerplate(none).count() == 0


# -- 5 -------------------------------------------------------------------------------

def test_surrogates(spark, docs, none):
    texts = [
        (1, "Call Mr John Smith at +1 (017) 555-7713 or john.smith27@mail6.example.com. Smith is here. Mrs Smith too. MR. JOHN SMITH!"),
        (2, 'Card 4929348385146306, again 4929-3483-8514-6306; ip 233.254.104.120 token = "04dbebab91ab85687d33eeaaf9ac699e1188f962"'),
        (3, None), (4, ""), (5, "nothing here 1234 2.0"), (6, "+1 (017) 555-7713"), (6, "+1 (017) 555-7713"),
        (7, "господин Иванов и Иванов; 123-45-6789 DE89 3704 0044 0532 0130 00"), (8, "JOHN.SMITH27@MAIL6.EXAMPLE.COM"),
    ]
    rows = private.pseudonymised(spark.createDataFrame(texts, "doc_id bigint, text string"), "k").collect()
    got = {r.doc_id: r.text for r in rows}
    given, family = re.match(r"Call Mr (\w+) (\w+) at", got[1]).groups()
    assert family != "Smith" and given != "John"
    assert f". {family} is here. Mrs {family} too. MR. {given.upper()} {family.upper()}!" in got[1]
    phone = re.search(r"at (\+1 \(\d{3}\) \d{3}-\d{4}) or (\S+)\. ", got[1])
    assert got[6] == phone[1] != texts[5][1] and len(rows) == len(texts)
    assert got[8] == phone[2].upper() and re.fullmatch(r"[a-z]{4}\.[a-z]{5}\d\d@[a-z]{4}\d\.[a-z]{7}\.com", phone[2])
    a, b = re.search(r"Card (4\d{15}), again (4\d{3}-\d{4}-\d{4}-\d{4});", got[2]).groups()
    assert b.replace("-", "") == a != "4929348385146306"
    assert all(int(x) < 256 for x in re.search(r"ip ([\d.]+) ", got[2])[1].split("."))
    assert re.search(r'"[0-9a-f]{40}"', got[2]) and "04dbebab" not in got[2]
    assert re.fullmatch(r"господин ([А-Я][а-я]+) и \1; \d{3}-\d\d-\d{4} DE\w\w \w{4} \w{4} \w{4} \w{4} \w\w", got[7])
    assert (got[3], got[4], got[5]) == (None, "", "nothing here 1234 2.0")
    same([(r.doc_id, r.text) for r in private.pseudonymised(docs, "k").collect()], TEXTS)
    assert private.pseudonymised(none, "k").count() == 0


def test_surrogates_of_national_phones(spark):
    phones = [
        "(017) 555-7713", "415-555-2671", "415.555.2671", "1-415-555-2672", "030 1234567", "030/1234568", "020 7946 0958",
        "01 23 45 67 89", "+1.415.555.2671", "+49.30.1234567", "+1 415.555.2673",
    ]
    others = ["2020-01-02", "01-02-2024", "01.02.2024", "+3.14159", "(2020) 12-34", "1.415.555", "12 345 6789", "3.415-555-2671"]
    texts = [(i, f"at {t}, or") for i, t in enumerate(phones + others)]
    rows = private.pseudonymised(spark.createDataFrame(texts, "doc_id bigint, text string"), "k").collect()
    got = {r.doc_id: (r.n_entities, r.text) for r in rows}
    for i, text in texts[: len(phones)]:
        assert got[i][0] == 1 and got[i][1] != text
        assert re.sub("[0-9]", "0", got[i][1]) == re.sub("[0-9]", "0", text)
    assert [got[i] for i, _ in texts[len(phones) :]] == [(0, t) for _, t in texts[len(phones) :]]


def test_surrogates_stay_distinct(spark):
    # one letter and one digit: 26 * 10 surrogates for 120 entities, so many tries collide
    texts = [(i, f"{c}{d}@x.org") for i, (c, d) in enumerate((c, d) for c in "abcdefghijkl" for d in range(10))]
    rows = private.pseudonymised(spark.createDataFrame(texts, "doc_id bigint, text string"), "k").collect()
    made = {r.text for r in rows}
    assert len(made) == len(texts) and not made & {t for _, t in texts}


# -- 6 -------------------------------------------------------------------------------

def test_sampling_estimates_jaccard():
    rng = __import__("random").Random(2)
    pairs = [(odd.sentence(rng, 100), odd.sentence(rng, 80)) for _ in range(30)]
    pairs = [(a, sampling.edited(a, b)) for a, b in pairs]
    one, two = (sampling.signatures([p[i] for p in pairs], 512) for i in (0, 1))
    error = []
    for (a, b), near in zip(pairs, sampling.alike(one, two)):
        x, y = (collections.Counter(ALNUM_WORD.findall(t.translate(LOWER))) for t in (a, b))
        error.append(near - sum((x & y).values()) / sum((x | y).values()))
    assert abs(np.mean(error)) < 0.02 and np.abs(error).max() < 0.1


def plain_signature(text, samples):
    """Term by term, draw by draw."""
    mask, f = 2**64 - 1, np.float32

    def mixed(x):
        x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & mask
        x = (x ^ (x >> 27)) * 0x94D049BB133111EB & mask
        return x ^ (x >> 31)

    def unit(x):
        return (f(x & 0xFFFFFFFF) + f(0.5)) * f(2**-32)

    weights = collections.Counter(ALNUM_WORD.findall(text.translate(LOWER)))
    out = []
    for draw in range(samples if weights else 0):
        offers = []
        for word, weight in weights.items():
            term = int(Words([word.encode()], ALNUM, True).hashes()[0])
            one, two, three = (mixed(term ^ mixed(3 * draw + i)) for i in range(3))
            r, c = (np.maximum(-np.log(unit(x) * unit(x >> 32)), f(1e-6)) for x in (one, two))
            level = np.floor(np.log(f(weight)) / r + unit(three))
            cost = np.log(c) - r * (level - unit(three) + f(1))
            offers.append((cost, mixed(three ^ int(level)) >> 32))
        cost, sample = min(offers)
        bits = int(cost.view(np.uint32))
        order = bits ^ mask >> 32 if bits >> 31 else bits | 1 << 31
        out.append((order << 32 | sample) % 65535 + 1)
    return out or [0] * samples


@pytest.mark.parametrize("settings", [{}, {"FEW": 0}, {"FEW": 0, "REACH": 0.2}, {"FEW": 0, "REACH": 60.0, "HANDED": 50, "STEP": 7, "BLOCK": 300}, {"FEW": 10**9}])
def test_sampling_draws_as_term_by_term(settings, monkeypatch):
    for name, value in settings.items():
        monkeypatch.setattr(sampling, name, value)
    rng = __import__("random").Random(4)
    texts = [odd.sentence(rng, n) for n in (1, 2, 5, 30, 60, 150)] + ["", "ab " * 400, "?!", "日本語 ab Ab", None]
    texts += [texts[4], sampling.edited(texts[5], texts[4])]
    got = sampling.signatures(texts, 20)
    assert got.tolist() == [plain_signature(t or "", 20) for t in texts]


def test_sampling_works_out_few_offers(monkeypatch):
    worked, offers = [], sampling._offers

    def counted(*args):
        made = offers(*args)
        worked.append(made.size)
        return made

    monkeypatch.setattr(sampling, "_offers", counted)
    rng = __import__("random").Random(6)
    texts = [" ".join(f"w{int(rng.paretovariate(0.5)) % 10**9}" for _ in range(400)) for _ in range(40)]
    sampling._compared(list(range(40)), texts, 128)
    terms = {(w, n) for t in texts for w, n in collections.Counter(t.split()).items()}
    assert sum(worked) < 0.25 * 128 * len(terms)  # all of them once, before


def test_sampling_neighbours(docs, none, spark):
    order = sorted(
        TEXTS, key=lambda r: (r[0] is None, -(r[0] or 0), spark.range(1).select(F.xxhash64(F.lit(r[1] or ""))).first()[0] if r[0] in (None, 2, 10) else 0)
    )
    texts = [t or "" for _, t in order]
    prints = sampling.signatures(texts)
    want = []
    for i, (d, _) in enumerate(order):
        j = (i + 1) % len(order)
        new = sampling.edited(texts[i], texts[j])
        sign = sampling.signatures([new])
        want.append((
            d, len(texts[i]), hashlib.sha256(new.encode()).hexdigest(), sampling.packed(prints[i : i + 1])[0].hex(), sampling.packed(sign)[0].hex(),
            float(sampling.alike(prints[i : i + 1], sign)[0]), float(sampling.alike(prints[i : i + 1], prints[j : j + 1])[0]),
        ))
    same(sampling.neighbours(docs).collect(), want)
    same(sampling.neighbours(docs.repartition(3)).collect(), want)
    assert sampling.neighbours(none).count() == 0
    alone = spark.createDataFrame([(1, "a b c d e f")], "doc_id bigint, text string")
    row = sampling.neighbours(alone).first()
    assert row.near_next == 1 and row.edited_sha256 == hashlib.sha256(b"a b c d a b").hexdigest()


# -- 7 -------------------------------------------------------------------------------

def test_sharding(docs, none):
    def bid(key, s, w):
        u = (int(hashlib.md5(f"{key}:{s}".encode()).hexdigest()[:15], 16) + 1) / 2**60
        return math.log(u) / w

    weights = [1.0, 2.0, 0.5]
    rows = shard.sharded(docs, weights, extra=1.5, buckets=4).collect()
    slots = collections.defaultdict(list)
    for r in rows:
        key = "null" if r.doc_id is None else str(r.doc_id)
        assert r.shard == max(range(3), key=lambda s: bid(key, s, weights[s]))
        assert r.grown_shard == max(range(4), key=lambda s: bid(key, s, [*weights, 1.5][s]))
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    same([(r.doc_id, r.size, r.text_crc32) for r in rows], [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in TEXTS])
    assert shard.sharded(none, weights).count() == 0
    with pytest.raises(ValueError):
        shard.sharded(docs, [1.0, 0.0])


def test_sharding_of_copies(spark):
    some = [(i % 5, f"t{i % 7}") for i in range(70)] + [(3, "hot")] * 200 + [(None, None)] * 9
    docs = spark.createDataFrame(some, "doc_id bigint, text string")
    con = duckdb.connect()
    con.register("documents", docs.toPandas().astype({"doc_id": "Int64"}))
    for copies in (1, 4, shard.COPIES):
        rows = shard.sharded(docs, [1.0] * 3, extra=1.0, buckets=8, copies=copies)
        got = rows.withColumn("law", F.lit("key")).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
        same(got.collect(), con.execute(shard.key_law_sql(3, 8, copies)).fetchall())


def test_weighted_shares(spark):
    rows = shard.sharded(spark.range(20_000).selectExpr("id AS doc_id", "'' AS text"), [1.0, 3.0])
    n = {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}
    assert n[1] / n[0] == pytest.approx(3, rel=0.06)


# -- 8 -------------------------------------------------------------------------------

def _without_repeats(window: int) -> list[tuple]:
    seen = collections.Counter()
    words = [SOLID_WORD.findall(t or "") for _, t in TEXTS]
    for w in words:
        seen.update(tuple(w[a : a + window]) for a in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(TEXTS, words):
        gone = set()
        for a in range(len(w) - window + 1):
            if seen[tuple(w[a : a + window])] > 1:
                gone.update(range(a, a + window))
        out.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return out


@pytest.mark.parametrize("group", [suffix.GROUP, 3, 0])
def test_substring_dedup(docs, none, group):
    rows = suffix.without_repeats(docs, group=group).collect()
    same(rows, _without_repeats(35))
    if group:
        assert suffix.without_repeats(none).count() == 0


def test_substring_dedup_of_short_windows(docs):
    same(suffix.without_repeats(docs, window=9, lead=2, group=6).collect(), _without_repeats(9))


# -- 9 -------------------------------------------------------------------------------

def test_pack_fills_sequences():
    rng = np.random.default_rng(0)
    lengths = np.append(rng.integers(1, 700, 300), [1, 1024, 5000, 2048])
    pieces = packing.pack(lengths)
    load, spent = collections.Counter(), collections.Counter()
    for _, _, n, s, _ in pieces:
        load[s] += n
        spent[s] += packing.cost(n)
    assert all(n == 1024 or n & (n - 1) == 0 for n in load.values())
    assert sum(n < 1024 for n in load.values()) <= 10
    mixed = [spent[s] for s in load if load[s] == 1024 and spent[s] < packing.cost(1024)]
    assert max(mixed) < 2 * np.median(mixed)


def test_packing(docs, none):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    rows = packing.packed(docs, queries.TOKENIZER, group=7).collect()
    want = collections.Counter(
        (d, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])) for d, t in TEXTS
    )
    pieces, load = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length > 0
        pieces[(r.doc_id, r.doc_tokens)].append((r.start, tuple(ids.tolist())))
        load[r.sequence_id].append((r.offset, r.length))
    for spans in load.values():
        spans.sort()
        assert [o for o, _ in spans] == np.cumsum([0] + [n for _, n in spans])[:-1].tolist()
        assert sum(n for _, n in spans) <= 1024
    for (d, n), parts in pieces.items():
        texts = [ids for (e, ids), times in want.items() for _ in range(times) if e == d and len(ids) == n]
        assert sum(len(p) for _, p in parts) == n * len(texts)
        for start, part in parts:
            assert any(ids[start : start + len(part)] == part for ids in texts)
    assert len({(d, len(i)) for d, i in want}) == len(pieces)
    assert packing.packed(none, queries.TOKENIZER).count() == 0


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 3)
    encoder = packing.Encoder(queries.TOKENIZER)
    texts = [t or "" for _, t in TEXTS]
    for lo in range(0, len(texts), 5):
        some = texts[lo : lo + 5]
        for got, want in zip(encoder.encode(some), encoder.whole(some)):
            assert got.tolist() == want.tolist()


def test_encoder_merges_letters_once(monkeypatch):
    encoder = packing.Encoder(queries.TOKENIZER)
    plain, given = packing.Encoder.whole, []
    monkeypatch.setattr(packing.Encoder, "whole", lambda self, texts: given.extend(texts) or plain(self, texts))
    words = ["straße", "Überallher", "Привет", "thentionlya", "ÉLANS"]
    text = " ".join([words[0], *(w + tail for w in words for tail in ("", ".", ",", "&&&", "'s", "-a b", "\n" + w))])
    got = encoder.encode([text, text + " once"])
    assert not any(w in t for t in given for w in words)
    assert [x.tolist() for x in got] == [x.tolist() for x in plain(encoder, [text, text + " once"])]


def test_encoder_on_odd_texts():
    encoder = packing.Encoder(queries.TOKENIZER)
    parts = [
        "a", "it's", "I'LL", "é", "e\u0301t", "中文", "x中", "中x.", "²x", "x²", "x½y", "naïve-ly", "_a_", "a_b", "1a", "a1.5", "ªº",
        ".", "...", "a.b,", "(x)", "\n", "\n\n", "\na", "\n(a)", "\r\n", "a\r\n", "\t", "a\tb", "a\t", "\ta", "\xa0", "a\xa0b", "a\xa0", "\u3000",
        "<|endoftext|>", "a<|endoftext|>b", "<|endof", "😀", "x😀", "", " ", "ß", "ſ", "ĳ", "ʰ", "ʯ", "ʰx", "aʰ", "\u0483", "я\u0483", "ԯ", "Ա", "яԱ", "\x00", "a\x00b", "\x1c", "a\x1cb",
    ]
    texts = [a + s + b for a in parts for b in parts for s in ("", " ", "\n", "  ", " \n")]
    texts += [" ".join(texts[i : i + 40]) for i in range(0, len(texts), 40)]
    for lo, hi in packing.runs(texts):
        for text, got, want in zip(texts[lo:hi], encoder.encode(texts[lo:hi]), encoder.whole(texts[lo:hi])):
            assert got.tolist() == want.tolist(), text


def test_runs():
    assert list(packing.runs([])) == []
    assert list(packing.runs(["a", "b", "c"], most=2)) == [(0, 2), (2, 3)]
    assert list(packing.runs(["aaa", "b", "bb", "ccccc", ""], characters=4)) == [(0, 2), (2, 3), (3, 4), (4, 5)]


# -- 10 ------------------------------------------------------------------------------

def brute_fingerprint(text: str | None, shingle: int = 3) -> int:
    words = [w.encode() for w in SOLID_WORD.findall((text or "").translate(LOWER))]
    parts = [b" ".join(words[a : a + shingle]) for a in range(len(words) - shingle + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints: list[int], most: int) -> dict[int, int]:
    values = sorted(set(prints))
    label = {v: v for v in values}
    changed = True
    while changed:
        changed = False
        for a in values:
            for b in values:
                if (a ^ b).bit_count() <= most and label[b] < label[a]:
                    label[a] = label[b]
                    changed = True
    return label


def test_simhash(docs, none):
    prints = [brute_fingerprint(t) for _, t in TEXTS]
    label = brute_components(prints, 3)
    least = {}
    for (d, _), p in zip(TEXTS, prints):
        if d is not None:
            least[label[p]] = min(least.get(label[p], d), d)
    want = [(d, f"{p:016x}", least.get(label[p])) for (d, _), p in zip(TEXTS, prints)]
    same(simhash.near_duplicates(docs).collect(), want)
    kept = simhash.one_of_each(docs)
    assert kept.schema == docs.schema
    chosen = {least.get(label[p]) for p in prints}
    got = kept.collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(map(str, chosen))
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.one_of_each(none).count() == 0


@pytest.mark.parametrize("group", [4096, 5])
def test_links_connect_what_is_near(spark, group):
    rng = np.random.default_rng(4)
    values = []
    for _ in range(12):  # chains of near fingerprints, and crowds that share many bits
        v = int(rng.integers(0, 2**63)) * 2 + 1
        for _ in range(25):
            v ^= sum(1 << int(b) for b in rng.integers(0, 64, 2))
            values.append(v)
    crowd = int(rng.integers(0, 2**63))
    values += [crowd ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 24, (60, 2))]
    values = sorted(set(values) | {0, 2**64 - 1})
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp bigint"), group=group)
    found = {r.node: r.comp for r in simhash.components(edges).collect()}
    label = brute_components(values, 3)
    groups, want = collections.defaultdict(set), collections.defaultdict(set)
    for v, s in zip(values, signed):
        groups[found.get(s, s)].add(v)
        want[label[v]].add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))
