"""Ranked lexical search: each item's best documents, found through blocked posting lists.

Items are the queries, taken in blocks of ``ITEMS``; a block's terms are numbered and
go to all tasks (at most ``TERMS`` of them, or one longer item's). One pass over the
texts counts terms and writes each document's vector over the numbered ones. The
corpus statistics follow by aggregation.

Tasks take their documents in shards. In a shard, a term's posting list is cut into
blocks by geometry: some members stand for clusters, each document joins the one its vector
has the largest inner product with. A block keeps the coordinatewise maximum of its
vectors over the terms of the items that ask for the list. An item's weights times
this summary bound the score of every document in the block, exactly, in integers; a
block is skipped only if the bound is below what the item's last place needs. Documents
of other blocks are scored exactly.

What the last place needs: the documents of each item's rarest terms are scored first,
everywhere, and the last of the best of them is a score that the final last place can't be
below; it rises as a task finds better ones. Lists of terms that together can't
reach it need no search: a document that has none of the others is too low.

Cases: null and empty texts have no terms; an item without terms, or whose terms weigh
nothing, has no rows; each row of items is a query of its own, each row of documents a
document (equal ids share their order, null ids come last); texts of any length are
counted whole; an empty corpus gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.sources.shared import written

TOP = 20
#: Items searched together, and distinct terms after which no further item joins them.
ITEMS, TERMS = 256, 8192
#: Documents of a shard, and numbers in its matrix (4 bytes each), whichever is reached first.
SHARD, CELLS = 4096, 1 << 24
#: Documents a block has on average.
BLOCK = 16
#: An item's rarest terms are those that have so many postings together.
SEEDS = 200
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")


def terms_of(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """How much an occurrence count says in a document of size mark ``m``; below a million."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def size_marks(n: list[int], documents: int, words: int) -> np.ndarray:
    """75 plus a quarter of the length in percent of the mean; Python's integers don't overflow."""
    return np.array([75 + 25 * x * documents // max(words, 1) for x in n], np.int64)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


@dataclass
class Items:
    """A block of items: their ids, terms and, once known, weights by term and item."""

    ids: list = field(default_factory=list)
    counts: list[Counter] = field(default_factory=list)
    number: dict[bytes, int] = field(default_factory=dict)

    def add(self, item, terms: list[bytes]) -> None:
        self.ids.append(item)
        self.counts.append(Counter(terms))
        for t in terms:
            self.number.setdefault(t, len(self.number))

    def weights(self, documents: int, df: dict[int, int]) -> np.ndarray:
        """``[term, item]``: the term's weight times its occurrences in the item."""
        out = np.zeros((len(self.number), len(self.ids)), np.int64)
        for i, count in enumerate(self.counts):
            for t, n in count.items():
                at = self.number[t]
                out[at, i] = n * weight(documents, df[at]) if df.get(at) else 0
        # sums stay exact in doubles (and fast) up to 2^53
        return out.astype(float) if out.sum(axis=0).max(initial=0) * 1_000_000 < 1 << 53 else out

    def rarest(self, df: dict[int, int], postings: int = SEEDS) -> list[list[int]]:
        """For each item its rarest terms, as many as reach ``postings`` documents."""
        out = []
        for count in self.counts:
            known = sorted((df[self.number[t]], self.number[t]) for t in count if df.get(self.number[t]))
            before = np.cumsum([0] + [n for n, _ in known])
            out.append([t for (_, t), b in zip(known, before) if b < postings])
        return out


def item_blocks(items: DataFrame, item_id: str, text: str, most: int = ITEMS, terms: int = TERMS) -> Iterator[Items]:
    """The items, streamed through the driver one block after the other."""
    block = Items()
    for row in items.select(F.col(f"`{item_id}`").alias("i"), F.col(f"`{text}`").alias("t")).toLocalIterator():
        own = terms_of(row["t"])
        if not own:
            continue
        if block.ids and (len(block.ids) >= most or len(block.number) >= terms):
            yield block
            block = Items()
        block.add(row["i"], own)
    if block.ids:
        yield block


def vectors(docs: DataFrame, number: dict[bytes, int], doc_id: str, text: str) -> DataFrame:
    """``doc_id, n, terms array<int>, tfs array<int>``: each document over the numbered terms, written."""
    plain = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = plain.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, absent = number.get, itertools.repeat(-1)
        for batch in batches:
            sizes, found, counts = [], [], []
            for t in batch.column("text").to_pylist():
                words = terms_of(t)
                at, n = np.unique(np.fromiter(map(of, words, absent), np.int32, len(words)), return_counts=True)
                known = at >= 0
                sizes.append(len(words))
                found.append(at[known])
                counts.append(n[known].astype(np.int32))
            ends = np.cumsum([0] + [len(x) for x in found]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x))) for x in (found, counts)] if sizes else []
            if sizes:
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "tfs"]
                )

    return written(plain.mapInArrow(run, f"doc_id {kind}, n bigint, terms array<int>, tfs array<int>"), "vectors")


class TermBlocks:
    """A posting list in blocks of similar documents, with their coordinatewise maxima."""

    def __init__(self, members: np.ndarray, rows: np.ndarray, block: int = BLOCK):
        """``rows``: the members' vectors over the coordinates that matter for this list."""
        k = -(-len(members) // block)
        if k > 1:
            stand = rows[np.arange(k) * len(members) // k]
            cluster = np.argmax(rows @ stand.T, axis=1)
            order = np.argsort(cluster, kind="stable")
            self.opens = np.flatnonzero(np.diff(cluster[order], prepend=-1))
        else:
            order, self.opens = np.arange(len(members)), np.zeros(1, np.int64)
        self.members, self.rows = members[order], rows[order]
        self.size = np.diff(np.append(self.opens, len(members)))
        self.most = np.maximum.reduceat(self.rows, self.opens, axis=0)

    def candidates(self, weights: np.ndarray, need: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Members of blocks that may reach what some item needs, and for which items (a mask)."""
        may = self.most.astype(weights.dtype) @ weights >= need
        mask = np.repeat(may, self.size, axis=0)
        some = np.flatnonzero(mask.any(axis=1))
        return some, mask[some]


class Shard:
    """Some documents' impacts over the items' terms."""

    def __init__(self, n: list[int], terms: np.ndarray, tfs: np.ndarray, ends: np.ndarray, width: int, documents: int, words: int):
        row = np.repeat(np.arange(len(n)), np.diff(ends))
        marks = size_marks(n, documents, words)
        self.value = np.zeros((len(n), width), np.float32)  # whole numbers below 2^24 are exact
        self.value[row, terms] = impact(tfs.astype(np.int64), marks[row])
        order = np.argsort(terms, kind="stable")
        self.posted = row[order]
        self.first = np.searchsorted(terms[order], np.arange(width + 1))
        self.scored = 0

    def posting(self, term: int) -> np.ndarray:
        return self.posted[self.first[term] : self.first[term + 1]]

    def scores(self, members: np.ndarray, weights: np.ndarray, coordinates: np.ndarray) -> np.ndarray:
        return self.value[np.ix_(members, coordinates)].astype(weights.dtype) @ weights[coordinates]

    def seeds(self, weights: np.ndarray, rarest: list[list[int]]) -> np.ndarray:
        """Scores ``[document, item]`` of the documents that have one of an item's rarest terms."""
        out = np.zeros((len(self.value), weights.shape[1]), np.int64)
        for i, terms in enumerate(rarest):
            members = np.unique(np.concatenate([self.posting(t) for t in terms] or [np.zeros(0, np.int64)]))
            if len(members):
                own = np.flatnonzero(weights[:, i])
                out[members, i] = self.scores(members, weights[:, i : i + 1], own)[:, 0]
        return out

    def search(self, weights: np.ndarray, need: np.ndarray, block: int = BLOCK) -> np.ndarray:
        """Scores ``[document, item]`` of all documents that reach ``need``; others may be 0."""
        out = np.zeros((len(self.value), weights.shape[1]), np.int64)
        top = self.value.max(axis=0, initial=0).astype(weights.dtype)
        asks = np.zeros(weights.shape, bool)
        for i in range(weights.shape[1]):
            own = np.flatnonzero(weights[:, i])
            most = weights[own, i] * top[own]
            order = np.argsort(most, kind="stable")
            asks[own[order], i] = np.cumsum(most[order]) >= need[i]
        for t in np.flatnonzero(asks.any(axis=1) & (np.diff(self.first) > 0)).tolist():
            items = np.flatnonzero(asks[t])
            coordinates = np.flatnonzero(weights[:, items].any(axis=1))
            members = self.posting(t)
            blocks = TermBlocks(members, self.value[np.ix_(members, coordinates)], block)
            own = weights[np.ix_(coordinates, items)]
            some, mask = blocks.candidates(own, need[items])
            if len(some):
                self.scored += len(some)
                found = (blocks.rows[some].astype(own.dtype) @ own).astype(np.int64)
                at = np.ix_(blocks.members[some], items)
                out[at] = np.where(mask, found, out[at])
        return out


def _searched(width: int, documents: int, words: int, top: int, need: np.ndarray, scores, shard: int):
    """A task's function: for each shard, the best documents of each item by ``scores(shard, need)``."""

    def best(part: pa.Table, need: np.ndarray) -> Iterator[pa.RecordBatch]:
        part = part.combine_chunks()
        lists = part.column("terms").chunk(0) if len(part) else None
        if lists is None:
            return
        own = Shard(
            part.column("n").to_pylist(), lists.flatten().to_numpy(), part.column("tfs").chunk(0).flatten().to_numpy(),
            lists.offsets.to_numpy() - lists.offsets[0].as_py(), width, documents, words,
        )
        found = scores(own, need)
        ids = part.column("doc_id").chunk(0)
        place = np.empty(len(ids), np.int64)
        place[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
        items, rows, values = [], [], []
        for i in range(found.shape[1]):
            at = np.flatnonzero(found[:, i] >= need[i])
            at = at[np.lexsort((place[at], -found[at, i]))[:top]]
            if len(at) == top:
                need[i] = max(need[i], found[at[-1], i])
            items.append(np.full(len(at), i))
            rows.append(at)
            values.append(found[at, i])
        rows = np.concatenate(rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(items), pa.int32()), ids.take(pa.array(rows)), pa.array(np.concatenate(values), pa.int64())],
            names=["item", "doc_id", "score"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        limit, held, size, now = max(1, min(shard, CELLS // max(width, 1))), [], 0, need.copy()
        for batch in batches:
            for lo in range(0, len(batch), limit):
                some = batch.slice(lo, limit)
                if size and size + len(some) > limit:
                    yield from best(pa.Table.from_batches(held), now)
                    held, size = [], 0
                held.append(some)
                size += len(some)
        if size:
            yield from best(pa.Table.from_batches(held), now)

    return run


def _ranked(rows: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def _search(docs: DataFrame, items: Items, doc_id: str, text: str, top: int, shard: int, block: int) -> DataFrame:
    own = vectors(docs, items.number, doc_id, text)
    total = own.agg(F.count_if(F.col("n") > 0).alias("n"), F.coalesce(F.sum("n"), F.lit(0)).alias("l")).first()
    counted = own.select(F.explode("terms").alias("t")).groupBy("t").count()
    df = {r["t"]: r["count"] for r in counted.collect()}  # a row for each term of the items
    weights, rarest = items.weights(total["n"], df), items.rarest(df)
    matched = own.filter(F.size("terms") > 0)
    schema = f"item int, doc_id {own.schema['doc_id'].dataType.simpleString()}, score bigint"
    need = np.ones(len(items.ids), np.int64)
    args = (len(items.number), total["n"], total["l"], top)
    first = matched.mapInArrow(_searched(*args, need, lambda s, _: s.seeds(weights, rarest), shard), schema)
    last = _ranked(first, top).filter(F.col("rank") == top).select("item", "score").collect()  # a row for each item
    for r in last:
        need[r["item"]] = max(1, r["score"])
    found = matched.mapInArrow(_searched(*args, need, lambda s, now: s.search(weights, now, block), shard), schema)
    return _ranked(found, top)


def ranked(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", top: int = TOP, most: int = ITEMS, shard: int = SHARD, block: int = BLOCK,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` best documents with a score above 0."""
    spark = docs.sparkSession
    kind, kind_doc = (f.schema[c].dataType for f, c in ((items, item_id), (docs, doc_id)))
    out = spark.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id {kind_doc.simpleString()}, score bigint")
    for part in item_blocks(items, item_id, item_text, most):
        names = spark.createDataFrame(list(enumerate(part.ids)), f"item int, item_id {kind.simpleString()}")
        rows = _search(docs, part, doc_id, text, top, shard, block).join(F.broadcast(names), "item")
        out = out.unionByName(rows.select("item_id", "rank", "doc_id", "score"))
    return out


def ranked_sql(top: int = TOP) -> str:
    """DuckDB SQL for ``documents`` and ``benchmark``."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    terms = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""WITH d AS (SELECT doc_id, {terms} AS w FROM documents),
  whole AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
  q AS (SELECT item_id, t, count(*) AS c FROM (SELECT item_id, unnest({terms}) AS t FROM benchmark) GROUP BY ALL),
  tf AS (SELECT doc_id, len, t, count(*) AS tf FROM (SELECT doc_id, len(w) AS len, unnest(w) AS t FROM d)
         WHERE t IN (SELECT t FROM q) GROUP BY ALL),
  idf AS (SELECT t, CAST(floor(1000 * ln((2.0 * n + 2) / (2 * df + 1))) AS BIGINT) AS w
          FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), whole),
  hit AS (SELECT doc_id, t, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * len * n) // l))) AS s
          FROM tf JOIN idf USING (t), whole),
  score AS (SELECT item_id, doc_id, CAST(sum(c * s) AS BIGINT) AS score FROM q JOIN hit USING (t) GROUP BY ALL)
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
  FROM score WHERE score > 0 QUALIFY rank <= {top}"""
