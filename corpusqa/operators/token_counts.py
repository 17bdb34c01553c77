"""Exact byte-pair token counts, by the distinct pieces of a task's texts.

A text is cut into pieces by the vocabulary's pattern, in its row. A piece that is an entry of the
vocabulary is one token. Of the others, each distinct one is merged once in a task (again
only if the task has met too many to remember): its bytes, joined two by two in the order of
the vocabulary's ranks until no two neighbours make an entry. Nothing is shuffled: rows
of texts and pieces would be many times the texts.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.functions.text import col

#: Entries of a vocabulary that every task may hold (some 100 MB).
LARGEST = 1 << 20
#: Distinct pieces whose sizes a task keeps (some 100 bytes each) before it starts anew.
KEPT = 1_000_000
#: Texts of an Arrow batch that are counted together.
ROWS = 256


def read_ranks(spark: SparkSession, path: str) -> DataFrame:
    """``piece binary, rank bigint`` from lines of an entry in base 64, a blank and its rank."""
    parts = F.split("value", " ")
    rows = spark.read.text(path).filter(F.col("value") != "")
    return rows.select(F.unbase64(parts[0]).alias("piece"), parts[1].cast("bigint").alias("rank"))


def pieces_of(text: Column | str, pattern: str) -> Column:
    """A text's pieces; classes of the pattern are Unicode's."""
    return F.regexp_extract_all(col(text), F.lit(f"(?U){pattern}"), F.lit(0))


def merged(piece: bytes, ranks: dict[bytes, int]) -> list[bytes]:
    """The tokens of a piece.

    Neighbours wait in a heap by rank and place; a joined pair is one part from then on, and
    an entry of the heap whose parts have changed is passed over. So long pieces, too,
    take n log n steps.
    """
    parts: list[bytes | None] = [piece[i : i + 1] for i in range(len(piece))]
    after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
    waiting: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        j = after[i]
        if j < len(parts):
            rank = ranks.get(parts[i] + parts[j])
            if rank is not None:
                heapq.heappush(waiting, (rank, i, len(parts[i]), len(parts[j])))

    for i in range(len(parts)):
        offer(i)
    while waiting:
        _, i, left, right = heapq.heappop(waiting)
        j = after[i]
        if parts[i] is None or j >= len(parts) or len(parts[i]) != left or len(parts[j]) != right:
            continue
        parts[i], parts[j], after[i] = parts[i] + parts[j], None, after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p is not None]


def count_tokens(
    docs: DataFrame, vocabulary: DataFrame, pattern: str, text: str = "text", into: str = "n_tokens"
) -> DataFrame:
    """``docs`` with the number of tokens of each text (0 for none).

    ``vocabulary`` is a table ``piece binary, rank bigint`` of at most ``LARGEST`` entries;
    every byte of the texts must be one.
    """
    entries = vocabulary.limit(LARGEST + 1).collect()
    if len(entries) > LARGEST:
        raise ValueError(f"a vocabulary of over {LARGEST} entries is too large for every task")
    ranks = {bytes(r["piece"]): r["rank"] for r in entries}

    sizes: dict[str, int] = {}

    @F.arrow_udf("bigint")
    def counted(pieces: pa.Array) -> pa.Array:
        out = []
        for lo in range(0, len(pieces), ROWS):
            some = pieces.slice(lo, ROWS)
            flat = some.flatten().dictionary_encode()
            distinct = flat.dictionary.to_numpy(zero_copy_only=False).tolist()
            if len(sizes) > KEPT:
                sizes.clear()
            for piece in distinct:
                if piece not in sizes:
                    own = piece.encode()
                    sizes[piece] = 1 if own in ranks else len(merged(own, ranks))
            each = np.array([sizes[p] for p in distinct], np.int64)[flat.indices.to_numpy()]
            ends = np.cumsum(pc.list_value_length(some).to_numpy())
            out.append(np.diff(np.append(0, np.cumsum(each))[ends], prepend=0))
        return pa.array(np.concatenate(out) if out else [], pa.int64())

    pieces = pieces_of(F.coalesce(F.col(f"`{text}`"), F.lit("")), pattern)
    return docs.withColumn(into, counted(pieces))
