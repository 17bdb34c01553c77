"""Vector codes: each of 16 parts of a vector as the number of its nearest codebook entry.

Components become integers, ``floor(256 x)``. A part's codebook starts as that part of
the first vectors by id and is moved twice to the mean of what it attracts. Nearest
entries are found by slices: in each dimension the entries' coordinates are sorted,
and a prefix carries, as one bit each, the entries up to there. A radius gives a range
of coordinates in each dimension; two prefixes make it a set of entries, and the
sets of all dimensions, ANDed, are the entries inside the box. The initial radius
is the distance to a guess (the entry whose first coordinate is next to the
part's), so the box holds every entry at that distance or nearer; their distances are
compared exactly.

The driver holds codebooks only (64 entries a part, whatever the number of vectors):
tasks hand over sums and counts by entry.

Cases: null vectors, and those with a null or non-finite component, are left out; so are
vectors whose length isn't that of the first one kept or no multiple of 16; with fewer than
64 vectors the codebooks are smaller; repeated rows and ids are rows (among equal ids the
lesser vector comes first for the codebooks, null ids last); ties go to the lesser entry;
integers are held to ±2^27, where sums would leave 64 bits; an empty table has no rows.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.sources.shared import written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
LIMIT = 1 << 27
#: Vectors worked on at once in a task.
BATCH = 4096


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """A vector's components times ``scale``, rounded down; null if there is none or one isn't finite."""
    def bad(x: Column) -> Column:
        return x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))

    def number(x: Column) -> Column:
        y = F.floor(F.greatest(F.lit(-2.0 * LIMIT), F.least(F.lit(2.0 * LIMIT), x.cast("double") * scale)))
        return F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), y)).cast("int")

    return F.when(vector.isNotNull() & ~F.exists(vector, bad), F.transform(vector, number))


class Slices:
    """The entries of one part's codebook: sorted coordinates and prefix sets in each dimension."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        order = np.argsort(self.entries, axis=0, kind="stable")
        self.sorted = np.take_along_axis(self.entries, order, axis=0)
        self.order = order
        bits = np.uint64(1) << order.astype(np.uint64)
        self.prefix = np.zeros((len(entries) + 1, entries.shape[1]), np.uint64)
        self.prefix[1:] = np.bitwise_or.accumulate(bits, axis=0)

    def distance(self, parts: np.ndarray, which: np.ndarray) -> np.ndarray:
        return ((parts - self.entries[which]) ** 2).sum(axis=1)

    def inside(self, parts: np.ndarray, radius: np.ndarray) -> np.ndarray:
        """The entries within ``radius`` in every dimension, a bit each."""
        box = np.full(len(parts), np.uint64(2**64 - 1))
        for d in range(parts.shape[1]):
            low = np.searchsorted(self.sorted[:, d], parts[:, d] - radius, "left")
            high = np.searchsorted(self.sorted[:, d], parts[:, d] + radius, "right")
            box &= self.prefix[high, d] & ~self.prefix[low, d]
        return box

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry (of equal ones the first) and its squared distance."""
        parts = parts.astype(np.int64)
        near = np.minimum(np.searchsorted(self.sorted[:, 0], parts[:, 0]), len(self.entries) - 1)
        best = self.order[near, 0].astype(np.int64)
        least = self.distance(parts, best)
        radius = np.ceil(np.sqrt(least.astype(float))).astype(np.int64) + 1  # one more for what a root rounds off
        left = self.inside(parts, radius)
        rows = np.flatnonzero(left)
        while len(rows):
            lowest = left[rows] & (~left[rows] + np.uint64(1))
            entry = np.bitwise_count(lowest - np.uint64(1)).astype(np.int64)
            far = self.distance(parts[rows], entry)
            closer = (far < least[rows]) | ((far == least[rows]) & (entry < best[rows]))
            best[rows[closer]], least[rows[closer]] = entry[closer], far[closer]
            left[rows] ^= lowest
            rows = rows[left[rows] != 0]
        return best, least


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _moved(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks ``[part, entry, place]`` after each entry goes to the mean of its parts."""
    parts, entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        total, count = np.zeros(books.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for lo in range(0, len(batch), BATCH):
                rows = _matrix(batch.column("v").slice(lo, BATCH)).astype(np.int64)
                for p in range(parts):
                    own = rows[:, p * width : (p + 1) * width]
                    which, _ = slices[p].nearest(own)
                    np.add.at(total[p], which, own)
                    count[p] += np.bincount(which, minlength=entries)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p, pa.int32()), pa.array(e, pa.int32()), pa.array(count[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
            names=["part", "entry", "n", "total"],
        )

    partial = vectors.select("v").mapInArrow(sums, "part int, entry int, n bigint, total array<bigint>")
    summed = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"s{i}") for i in range(width)]
    )
    books = books.copy()
    for r in summed.collect():  # a row for each entry at most
        books[r["part"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return books


def compressed(
    rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, codes array<int>, error bigint`` of each kept vector, and the codebooks ``[part, entry, place]``."""
    if not 0 < entries <= 64:
        raise ValueError("a set of entries has 64 bits")
    plain = rows.select(
        F.col(f"`{vec_id}`").alias("vec_id"), F.col(f"`{label}`").alias("label"),
        whole_numbers(F.col(f"`{vector}`")).alias("v"),
    ).filter(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0))
    order = [F.col("vec_id").asc_nulls_last(), F.col("v")]
    first = plain.orderBy(*order).limit(1).collect()
    width = len(first[0]["v"]) if first else parts
    kept = written(plain.filter(F.size("v") == width), "vectors")
    start = [r["v"] for r in kept.orderBy(*order).limit(entries).collect()]
    books = np.array(start, np.int64).reshape(len(start), parts, width // parts).transpose(1, 0, 2)
    if start:
        for _ in range(rounds):
            books = _moved(kept, books)
    kind, kind_label = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = [Slices(b) for b in books]
        for batch in batches:
            for lo in range(0, len(batch), BATCH):
                some = batch.slice(lo, BATCH)
                own = _matrix(some.column("v")).reshape(len(some), parts, -1)
                found = [slices[p].nearest(own[:, p]) for p in range(parts)]
                codes = np.stack([which for which, _ in found], axis=1).astype(np.int32)
                error = np.sum([far for _, far in found], axis=0)
                ends = np.arange(0, codes.size + 1, parts, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [some.column("vec_id"), some.column("label"), pa.ListArray.from_arrays(ends, pa.array(codes.ravel())), pa.array(error)],
                    names=["vec_id", "label", "codes", "error"],
                )

    out = kept.mapInArrow(coded, f"vec_id {kind}, label {kind_label}, codes array<int>, error bigint")
    return out, books


def with_label_error(coded: DataFrame) -> DataFrame:
    """The rows with ``label_error``, their errors summed over equal labels (nulls are equal).

    Sums combine inside tasks; they are written, so that a label that a third of all rows
    share is a join which is split.
    """
    coded = written(coded, "codes")
    sums = written(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label_errors")
    return coded.join(sums, F.col("label").eqNullSafe(F.col("of")), "left").drop("of")


def hex_code(codes: Column) -> Column:
    """Two hex digits for each entry's number."""
    return F.lower(F.array_join(F.transform(codes, lambda c: F.lpad(F.hex(c), 2, "0")), ""))


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """DuckDB SQL for ``embeddings``: every part against every entry."""
    steps = [f"""v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  p AS (SELECT vec_id, label, CAST(part AS INTEGER) AS part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS x
    FROM v, range({parts}) t(part)),
  b0 AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, x AS c FROM p QUALIFY entry < {entries})"""]
    for r in range(rounds + 1):
        steps.append(f"""a{r} AS (SELECT vec_id, label, part, x, near % 64 AS entry, near // 64 AS far FROM (
      SELECT vec_id, label, part, any_value(x) AS x, CAST(min(64 * list_sum(list_transform(list_zip(x, c),
        lambda z: (z[1] - z[2]) * (z[1] - z[2]))) + entry) AS BIGINT) AS near FROM p JOIN b{r} USING (part) GROUP BY ALL))""")
        if r < rounds:
            steps.append(f"""m{r} AS (SELECT part, entry, list((s - (s % n + n) % n) // n ORDER BY pos) AS c FROM (
      SELECT part, entry, pos, CAST(sum(y) AS BIGINT) AS s, count(*) AS n
      FROM (SELECT part, entry, unnest(x) AS y, unnest(range(len(x))) AS pos FROM a{r}) GROUP BY ALL) GROUP BY ALL),
  b{r + 1} AS (SELECT part, entry, coalesce(m{r}.c, b{r}.c) AS c FROM b{r} LEFT JOIN m{r} USING (part, entry))""")
    return "WITH " + ",\n  ".join(steps) + f""",
  rows AS (SELECT vec_id, label, string_agg(lower(printf('%02x', entry)), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error
    FROM a{rounds} GROUP BY ALL),
  digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds})
  SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM rows, digest"""
