"""What the operators of this package share: rows, keys, words as arrays.

Texts are cut into words inside Python tasks on their UTF-8 bytes. A batch is
worked on in pieces of about ``PIECE`` bytes, so memory follows one piece (or
one longer document), never the partition.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PIECE = 1 << 18

#: Bytes that may stand in a word of letters and digits: 0-9, a-z and all of a
#: multi-byte character. Upper-case A-Z is lowered first.
ALNUM = np.array([48 <= b <= 57 or 97 <= b <= 122 or b >= 128 for b in range(256)])
#: Bytes that are no white space (space, and 9 to 13).
SOLID = np.array([b != 32 and not 9 <= b <= 13 for b in range(256)])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_key(text: str | Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    return F.unhex(F.md5(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))))


class BitSet:
    """Which 64-bit hashes may be in a set, by their lower bits."""

    def __init__(self, words: np.ndarray):
        self.words = words
        self.mask = np.uint64(64 * len(words) - 1)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes & self.mask
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def bit_set(hashes: DataFrame, column: str, bits: int) -> BitSet:
    """A bit for each of a column's 64-bit hashes, modulo ``bits`` (a power of two).

    The driver receives at most ``bits / 64`` rows whatever the table's size.
    A set bit may stand for another hash too, so users verify what passes.
    """
    slot = F.col(column).bitwiseAND(F.lit(bits - 1))
    rows = (
        hashes.select(F.shiftright(slot, 6).cast("int").alias("w"), slot.bitwiseAND(F.lit(63)).cast("int").alias("b"))
        .groupBy("w")
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("b"))).alias("v"))
        .toPandas()
    )
    words = np.zeros(bits // 64, np.uint64)
    words[rows["w"].to_numpy(np.int64)] = rows["v"].to_numpy(np.int64).view(np.uint64)
    return BitSet(words)


def bits_for(count: int, most: int = 1 << 27) -> int:
    """Bits for ``count`` hashes at about one false hit in sixteen or fewer; at most 16 MB."""
    bits = 1 << 16
    while bits < 16 * count and bits < most:
        bits *= 2
    return bits


def pieces(texts: Sequence[str | None], limit: int = PIECE) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive runs of a batch's texts as UTF-8, each of about ``limit`` bytes."""
    first, run, size = 0, [], 0
    for i, text in enumerate(texts):
        data = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if run and size + len(data) > limit:
            yield first, run
            first, run, size = i, [], 0
        run.append(data)
        size += len(data)
    if run:
        yield first, run


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit integers (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


class Words:
    """The words of several texts: ``start``, ``end`` in ``data``; ``first[d]:first[d+1]`` are text d's."""

    def __init__(self, texts: list[bytes], solid: np.ndarray, lower: bool):
        data = b"\n".join(texts)  # a line feed is in no word of either kind
        self.data = data.lower() if lower else data
        inside = solid[np.frombuffer(self.data, np.uint8)]
        edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
        self.start, self.end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        opens = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.first = np.searchsorted(self.start, opens)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        """64 bits for each word, the same wherever the word stands."""
        data = np.frombuffer(self.data, np.uint8)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(_BASE, len(data)), out=total[1:])
        own = (total[self.end] - total[self.start]) * _powers(_INVERSE, len(data) + 1)[self.start]
        return mixed(own + (self.end - self.start).astype(np.uint64))

    def joined(self, a: int, b: int) -> str:
        """Words a to b (not included), with one space between."""
        cut = zip(self.start[a:b].tolist(), self.end[a:b].tolist())
        return b" ".join([self.data[s:e] for s, e in cut]).decode("utf-8", "surrogatepass")


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """64 bits for every k consecutive word hashes (also across texts)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * np.uint64(_BASE) + words[j : j + n]
    return mixed(out)
