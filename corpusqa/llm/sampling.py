"""Document fingerprints by consistent weighted sampling.

A text's terms are its words, weighted by how often they stand in it. For each of
``SAMPLES`` draws a term has fixed random numbers (r and c from a gamma distribution
of shape 2, b uniform), made by hashing. A term of weight w offers the level
``t = floor(ln w / r + b)`` at cost ``ln c - r (t - b + 1)``; the text's sample is
the (term, level) of least cost. Two texts draw the same sample with probability
equal to their generalised Jaccard similarity, sum of minima over sum of maxima of
the weights. A sample is kept as 16 bits, so unequal ones agree once in 65,535.

Neighbours in the order of ids are compared, so rows are dealt out by ranges of the
id, in order; the last row of a range meets the first of the next one afterwards.

Cases: null and empty texts, and texts without words, have the fingerprint of zeros,
alike to each other and unlike all others; a document alone is its own successor;
rows with equal ids follow each other by a hash of the text; null ids come last;
repeated rows are rows; texts of any length are read whole; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.llm.common import ALNUM, Words, mixed, pieces
from corpusqa.sources.shared import written

SAMPLES = 128
#: Samples that are drawn side by side.
SIDE = 16
#: Pairs of term and weight whose offers are bounded at once, and offers handed to their texts at once.
STEP, HANDED = 4096, 1 << 20
#: Words for which terms are looked up together.
BLOCK = 1 << 20
#: Offers that a text expects below its limit: the least cost of one in e^REACH samples lies above.
REACH = 6.0
#: Texts with fewer terms, on average, have all their offers worked out.
FEW = 32


def _units(terms: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Two numbers above 0 and up to 1 for each term in each draw, multiplied."""
    halves = mixed(terms ^ keys).view(np.uint32).astype(np.float32)
    halves += np.float32(0.5)
    halves *= np.float32(2**-32)
    return halves[..., 0::2] * halves[..., 1::2]


def _ordered(cost: np.ndarray) -> np.ndarray:
    """32-bit numbers in the order of the costs."""
    bits = cost.astype(np.float32).view(np.uint32)
    return np.where(bits >> np.uint32(31), ~bits, bits | np.uint32(1 << 31))


def _offers(weights: np.ndarray, r: np.ndarray, c: np.ndarray, three: np.ndarray) -> np.ndarray:
    """Cost and sample of weighted terms, each in its draw, as one sortable number.

    ``r`` and ``c`` come as e^-r and e^-c, ``three`` is what b is made of.
    """
    half = np.uint64(32)
    r = np.maximum(-np.log(r), np.float32(1e-6))
    c = np.maximum(-np.log(c), np.float32(1e-6))
    b = ((three & np.uint64(0xFFFFFFFF)).astype(np.float32) + np.float32(0.5)) * np.float32(2**-32)
    level = np.floor(np.log(weights.astype(np.float32)) / r + b)
    cost = _ordered(np.log(c) - r * (level - b + 1))
    sample = mixed(three ^ level.astype(np.int64).view(np.uint64)) >> half
    return (cost.astype(np.uint64) << half) | sample


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each range, one range after the other."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


def _in_parts(size: np.ndarray) -> Iterator[slice]:
    """Consecutive ranges of about ``HANDED`` numbers together."""
    cut = (np.flatnonzero(np.diff(np.cumsum(size) // HANDED)) + 1).tolist()
    for a, b in zip([0, *cut], [*cut, len(size)] if len(size) else []):
        yield slice(a, b)


def _drawn(terms: np.ndarray, counts: np.ndarray, samples: int) -> np.ndarray:
    """Samples of texts given by their words' hashes, one text after the other; ``counts`` has their numbers.

    A text of W words expects REACH offers below a cost of ln(REACH / W). Offers
    that may be below that of a text which makes them are worked out, once for all
    texts with that term and weight. Where a text gets none below its own limit, all
    its offers for that sample are worked out.
    """
    out = np.zeros((len(counts), samples), np.uint16)
    terms, number = np.unique(terms, return_inverse=True)
    text = np.repeat(np.arange(len(counts)), counts)
    of_text, weight = np.unique(text * (len(terms) + 1) + number.reshape(-1), return_counts=True)
    text, term = np.divmod(of_text, len(terms) + 1)
    most = int(weight.max(initial=0)) + 1
    filled, first, size = np.unique(text, return_index=True, return_counts=True)
    row = np.repeat(np.arange(len(filled)), size)
    pair = term * most + weight
    order = np.argsort(pair)
    start = np.flatnonzero(np.diff(pair[order], prepend=-1))
    spread = np.diff(start, append=len(order))
    owner, offer = row[order], np.empty(len(order), np.int64)
    offer[order] = np.repeat(np.arange(len(start)), spread)
    hashes, weights = terms[term[order[start]]], weight[order[start]]
    reach = REACH / counts[filled]
    widest = np.maximum.reduceat(reach[owner], start) if len(start) else reach
    limit, pair_limit = _ordered(np.log(reach)), _ordered(np.log(widest))
    bound = (widest * weights * 1.001).astype(np.float32)[:, None]  # more than rounding may take away
    half, one = np.uint64(32), np.float32(1)
    for lo in range(0, samples if len(filled) else 0, SIDE):
        key = mixed(np.arange(3 * lo, 3 * min(lo + SIDE, samples), dtype=np.uint64)).reshape(-1, 3).T
        side = key.shape[1]
        if len(row) < FEW * len(filled):  # nearly all offers would be below some limit
            table = np.concatenate([
                _offers(weights[a : a + STEP, None], _units(h, key[0]), _units(h, key[1]), mixed(h ^ key[2]))
                for a in range(0, len(start), STEP) for h in [hashes[a : a + STEP, None]]
            ])
            for a in range(0, len(filled), 256):  # texts whose offers are compared at once
                end = first[a + 256] if a + 256 < len(filled) else len(offer)
                least = np.minimum.reduceat(table[offer[first[a] : end]], first[a : a + 256] - first[a], axis=0)
                out[filled[a : a + 256], lo : lo + SIDE] = least % np.uint64(65535) + np.uint64(1)
            continue
        least = np.full(len(filled) * side, np.uint64(2**64 - 1))
        for a in range(0, len(start), STEP):
            r, c = (_units(hashes[a : a + STEP, None], key[i]) for i in (0, 1))
            # a level's t is at most ln w / r + b, so e^cost is at least c e^-r / w, and c = -ln u at least 2 (1 - u) / (1 + u)
            p, d = np.nonzero((one - c) * (r + r) < (one + c) * bound[a : a + STEP])
            r, c, p = r[p, d], c[p, d], p + a
            made = _offers(weights[p], r, c, mixed(hashes[p] ^ key[2][d]))
            low = made >> half < pair_limit[p]
            p, d, made = p[low], d[low], made[low]
            for x in _in_parts(spread[p]):
                n = spread[p[x]]
                at = owner[_ranges(start[p[x]], n)] * side + np.repeat(d[x], n)
                np.minimum.at(least, at, np.repeat(made[x], n))
        above = np.flatnonzero(least >> half >= np.repeat(limit, side))
        t, d = np.divmod(above, side)
        for x in _in_parts(size[t]):
            n = size[t[x]]
            p, k = offer[_ranges(first[t[x]], n)], key[:, np.repeat(d[x], n)]
            term = hashes[p]
            made = _offers(weights[p], _units(term, k[0]), _units(term, k[1]), mixed(term ^ k[2]))
            least[above[x]] = np.minimum.reduceat(made, np.cumsum(n) - n)
        out[filled, lo : lo + SIDE] = (least % np.uint64(65535) + np.uint64(1)).reshape(-1, side)
    return out


def signatures(texts: list[str | None], samples: int = SAMPLES) -> np.ndarray:
    """``[texts, samples]`` 16-bit samples; zeros for a text without words."""
    parts, hashes, counts = [np.zeros((0, samples), np.uint16)], [], []
    for at, piece in pieces(texts):
        words = Words(piece, ALNUM, True)
        hashes.append(words.hashes())
        counts.append(np.diff(words.first))
        if sum(map(len, hashes)) >= BLOCK or at + len(piece) == len(texts):
            parts.append(_drawn(np.concatenate(hashes), np.concatenate(counts), samples))
            hashes, counts = [], []
    return np.concatenate(parts)


def packed(signature: np.ndarray) -> list[bytes]:
    return [row.astype(">u2").tobytes() for row in signature]


def alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal samples, row by row."""
    return (a == b).mean(axis=1)


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by as many first ones of another text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


_COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(ids: list, texts: list[str], samples: int) -> pd.DataFrame:
    """Each text but the last against its edited form and the next text."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    # a text and its edited form share most of their terms
    both = signatures([t for pair in zip(texts, [*changed, None]) for t in pair], samples)
    own, new = both[::2], both[1:-1:2]
    return pd.DataFrame({
        "doc_id": pd.Series(ids[:-1], dtype=object), "n_chars": [len(t) for t in texts[:-1]],
        "edited_sha256": [hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in changed],
        "fingerprint": packed(own[:-1]), "edited_fingerprint": packed(new),
        "near_edited": alike(own[:-1], new), "near_next": alike(own[:-1], own[1:]),
    }, columns=_COLUMNS)


def neighbours(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", samples: int = SAMPLES) -> DataFrame:
    """Fingerprints of each text, its edited form and their likeness, and likeness to the next text.

    Next is the document of the next lower id; after the last comes the first.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    fields = (
        f"doc_id {kind}, n_chars bigint, edited_sha256 binary, fingerprint binary, "
        "edited_fingerprint binary, near_edited double, near_next double"
    )
    edge = f"part int, first_text string, last_id {kind}, last_text string"

    def run(batches):
        part, first, held_id, held = TaskContext.get().partitionId(), None, None, None
        for batch in batches:
            for lo in range(0, len(batch), 2048):
                rows = batch[lo : lo + 2048]
                ids = [None if pd.isna(x) else x for x in rows["doc_id"]]
                texts = rows["text"].tolist()
                if held is None:
                    first = texts[0]
                else:
                    ids, texts = [held_id, *ids], [held, *texts]
                held_id, held = ids[-1], texts[-1]
                if len(texts) > 1:
                    yield _compared(ids, texts, samples).assign(part=None, first_text=None, last_id=None, last_text=None)
        if held is not None:
            row = dict.fromkeys(_COLUMNS) | {"part": part, "first_text": first, "last_id": held_id, "last_text": held}
            yield pd.DataFrame({k: pd.Series([v], dtype=object) for k, v in row.items()})

    def stitched(batches):
        for batch in batches:
            for last_id, last, following in zip(batch["last_id"], batch["last_text"], batch["following"]):
                yield _compared([None if pd.isna(last_id) else last_id, None], [last, following], samples)

    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = [F.desc_nulls_last("doc_id"), F.asc("x")]
    dealt = plain.withColumn("x", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = written(dealt.select("doc_id", "text").mapInPandas(run, f"{fields}, {edge}"), "neighbours")
    inner = rows.filter(F.col("part").isNull()).select(*_COLUMNS)
    # one row for each task of the step before
    edges = rows.filter(F.col("part").isNotNull()).select("part", "first_text", "last_id", "last_text")
    ring = Window.orderBy("part")
    after = F.coalesce(F.lead("part").over(ring), F.first("part").over(ring))
    following = edges.select("part").select("part", after.alias("next"))
    pairs = edges.join(following, "part").join(
        edges.select(F.col("part").alias("next"), F.col("first_text").alias("following")), "next"
    )
    whole = inner.unionByName(pairs.select("last_id", "last_text", "following").mapInPandas(stitched, fields))
    # written as bytes, shown as digits
    shown = ("edited_sha256", "fingerprint", "edited_fingerprint")
    return whole.withColumns({c: F.lower(F.hex(c)) for c in shown})
