"""SimHash near-duplicates: fingerprints, links within a few bits, components.

Fingerprints are 64 bits by majority over the XXH64 values of a text's
three-word shingles. Pairs at most ``most`` (3) bits apart agree in one of
``most + 1`` blocks of bits, so distinct fingerprints meet once for each block.
A block's group is an index in Gray order: sorted by Gray rank, neighbours share
bit patterns; nodes of ``FAN`` members hold the pattern (value and mask) that
all members share, nodes above hold what their nodes share. A search adds up
differences against ever longer patterns and drops a node with all its members
once they exceed the limit. Groups too large for a task meet again by a second
block of their remaining bits, which loses no pair, until they are small or no
bits remain. A search hands back links that connect what it found, not all pairs.

Cases: null and empty texts have fingerprint zero, linked as any other; texts of
fewer words than a shingle are one shingle; equal fingerprints are one member
with several rows; rows with a null id count for no component's name (null if
it has no other); repeated rows are rows; other columns are kept by ``one_of_each``.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.common import pieces
from corpusqa.sources.shared import written

SHINGLE = 3
DISTANCE = 3
SEED = 42
#: Members of a node of the index, and nodes of the node above.
FAN = 16
#: A group of more distinct fingerprints than this is divided by further bits.
GROUP = 4096


def _majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each run ``first[d]:first[d+1]`` the bits set in over half of its hashes.

    Eight bits, one of each byte, are added up side by side in one 64-bit sum;
    blocks of 128 hashes keep each byte from running over.
    """
    runs = np.diff(first)
    out = np.zeros(len(runs), np.uint64)
    if not len(hashes):
        return out
    blocks = -(-runs // 128)
    owner = np.repeat(np.arange(len(runs)), blocks)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    opens = first[owner] + 128 * nth
    full = np.flatnonzero(blocks)
    at = (np.cumsum(blocks) - blocks)[full]
    lanes = np.uint64(0x0101010101010101)
    for bit in range(8):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lanes, opens)
        each = np.add.reduceat(sums.view(np.uint8).reshape(-1, 8), at, axis=0, dtype=np.int64)
        over = 2 * each > runs[full, None]
        for byte in range(8):
            out[full] |= over[:, byte].astype(np.uint64) << np.uint64(8 * byte + bit)
    return out


def fingerprints(texts: list[str | None], shingle: int = SHINGLE) -> np.ndarray:
    """One 64-bit fingerprint for each text."""
    digest, out = xxhash.xxh64_intdigest, []
    for _, piece in pieces(texts):
        values, counts = [], [0]
        for data in piece:
            words = data.lower().split()
            if len(words) > shingle:
                values += [digest(b" ".join(s), SEED) for s in zip(*[words[j:] for j in range(shingle)])]
            elif words:
                values.append(digest(b" ".join(words), SEED))
            counts.append(len(values))
        out.append(_majority(np.array(values, np.uint64), np.array(counts)))
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """A text column's fingerprints as (signed) bigint."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series(fingerprints(texts.tolist(), shingle).view(np.int64))

    return of(F.coalesce(text, F.lit("")))


def gray_rank(values: np.ndarray) -> np.ndarray:
    """Place of a code in the Gray sequence: neighbours there differ in one bit."""
    rank = values.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Fingerprints in Gray order, group by group, under nodes of shared bit patterns.

    Many groups may lie in one index; a node knows the groups it spans, and a
    search stays in its own.
    """

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        order = np.lexsort((gray_rank(values), groups))
        self.values, self.groups = values[order], groups[order]
        ones, some, low, high = self.values, self.values, self.groups, self.groups
        self.levels = [(ones, np.full(len(values), np.uint64(2**64 - 1)), low, high)]
        while len(ones) > FAN:
            opens = np.arange(0, len(ones), FAN)
            ones, some = np.bitwise_and.reduceat(ones, opens), np.bitwise_or.reduceat(some, opens)
            low, high = low[opens], np.maximum.reduceat(high, opens)
            self.levels.append((ones, ~(some ^ ones), low, high))

    def within(self, first: int, last: int, most: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, member) at most ``most`` bits apart in one group, for queries first to last."""
        top = len(self.levels[-1][0])
        q = np.repeat(np.arange(first, last), top)
        node = np.tile(np.arange(top), last - first)
        off = np.zeros(len(q), np.int64)
        seen = np.zeros(len(q), np.uint64)  # bits compared further up
        for depth in range(len(self.levels) - 1, -1, -1):
            pattern, mask, low, high = self.levels[depth]
            off = off + np.bitwise_count((self.values[q] ^ pattern[node]) & mask[node] & ~seen)
            g = self.groups[q]
            stay = (off <= most) & (low[node] <= g) & (g <= high[node])
            q, node, off = q[stay], node[stay], off[stay]
            seen = mask[node]
            if depth:
                below = len(self.levels[depth - 1][0])
                width = np.minimum(FAN, below - node * FAN)
                step = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
                node = np.repeat(node * FAN, width) + step
                q, off, seen = np.repeat(q, width), np.repeat(off, width), np.repeat(seen, width)
        return q, node


def _roots(parent: np.ndarray) -> np.ndarray:
    while not np.array_equal(parent, parent[parent]):
        parent = parent[parent]
    return parent


def group_links(values: np.ndarray, groups: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect each group's values as all its pairs within ``most`` bits would.

    Queries go through the index in blocks; a block's pairs are merged into the
    running components, so no more than a block's pairs are held.
    """
    index = GrayIndex(values, groups)
    label = np.arange(len(values))
    for lo in range(0, len(values), 1024):
        q, member = index.within(lo, min(lo + 1024, len(values)), most)
        a, b = q[q < member], member[q < member]
        while len(a):
            la, lb = label[a], label[b]
            np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
            label = _roots(label)
            apart = label[a] != label[b]
            a, b = a[apart], b[apart]
    linked = np.flatnonzero(label != np.arange(len(label)))
    return index.values[linked], index.values[label[linked]]


def _blocks(bits: int, most: int) -> list[tuple[int, int]]:
    """``most + 1`` (low, high) ranges of about equal width out of ``bits``."""
    cuts = [bits * i // (most + 1) for i in range(most + 2)]
    return list(zip(cuts, cuts[1:]))


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def _first_keys(most: int, bits: int = 64) -> Column:
    """One key for each block: which block, and its bits."""
    keys = []
    for i, (lo, hi) in enumerate(_blocks(bits, most)):
        part = F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1))
        left = ((1 << 64) - 1) & ~(((1 << (hi - lo)) - 1) << lo)
        keys.append(F.struct(F.lit(str(i)).alias("path"), part.alias("bits"), F.lit(_signed(left)).alias("left")))
    return F.array(*keys)


def _next_keys(keyed: DataFrame, masks: list[int], most: int) -> DataFrame:
    """Divide a group's remaining bits into blocks, one key for each.

    What remains depends on the blocks chosen so far alone, so there are at most
    ``(most + 1) ** rounds`` values of ``left``; their divisions are a small table.
    """
    cuts = []
    for left in masks:
        places = [p for p in range(64) if left >> p & 1]
        for i, (lo, hi) in enumerate(_blocks(len(places), most)):
            chosen = sum(1 << p for p in places[lo:hi])
            cuts.append((_signed(left), str(i), _signed(chosen), _signed(left & ~chosen)))
    blocks = keyed.sparkSession.createDataFrame(cuts, "left bigint, block string, chosen bigint, rest bigint")
    return keyed.join(F.broadcast(blocks), "left").select(
        # the path with the value so far names the group; the new bits are its own
        F.concat("path", F.lit(":"), F.col("bits").cast("string"), F.lit("/"), "block").alias("path"),
        F.col("fp").bitwiseAND(F.col("chosen")).alias("bits"), F.col("rest").alias("left"), "fp",
    )


def links(distinct: DataFrame, most: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) that connect all near ones."""
    keyed = distinct.select("fp", F.explode(_first_keys(most)).alias("k")).select("k.*", "fp")
    parts = []
    while True:
        keyed = written(keyed, "block_keys")
        sizes = keyed.groupBy("path", "bits", "left").count()
        large = written(sizes.filter((F.col("count") > group) & (F.bit_count("left") > most)), "large_groups")
        if large.isEmpty():
            parts.append(_grouped(keyed, most))
            return functools.reduce(DataFrame.unionByName, parts)
        parts.append(_grouped(keyed.join(large, ["path", "bits"], "left_anti"), most))
        again = keyed.join(large, ["path", "bits"], "left_semi")
        masks = [r["left"] & (2**64 - 1) for r in large.select("left").distinct().collect()]
        keyed = _next_keys(again, masks, most)


def _grouped(keyed: DataFrame, most: int) -> DataFrame:
    """Links inside the groups of ``path, bits``; many small groups share one index."""

    def linked(batches):
        rest = pd.DataFrame({"path": [], "bits": [], "fp": []})
        for batch in batches:
            whole = pd.concat([rest, batch], ignore_index=True) if len(rest) else batch
            changed = (whole["path"] != whole["path"].shift()) | (whole["bits"] != whole["bits"].shift())
            number = changed.cumsum().to_numpy()
            done = number < number[-1]
            rest = whole[~done]
            yield _linked(whole["fp"].to_numpy()[done], number[done], most)
        yield _linked(rest["fp"].to_numpy(), np.ones(len(rest), np.int64), most)

    return (
        keyed.select("path", "bits", "fp").repartition("path", "bits").sortWithinPartitions("path", "bits")
        .mapInPandas(linked, "a bigint, b bigint")
    )


def _linked(fps: np.ndarray, groups: np.ndarray, most: int) -> pd.DataFrame:
    a, b = group_links(fps.astype(np.int64).view(np.uint64), groups, most)
    return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})


def components(edges: DataFrame) -> DataFrame:
    """``node, comp``: the smallest node that can be reached, for each node with a link.

    In each round every component so far joins the least one that a link of its
    nodes reaches, and then the one which that has joined, so rounds grow as the
    logarithm of a chain's length. Rounds are written, which keeps plans short
    and survives lost executors.
    """
    both = written(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    label = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp"))
    while True:
        label = written(label, "labels")
        reached = both.join(label.select(F.col("node").alias("b"), "comp"), "b").groupBy("a").agg(F.min("comp").alias("low"))
        hooked = label.join(reached, label["node"] == reached["a"])
        least = hooked.groupBy("comp").agg(F.min(F.least("low", "comp")).alias("to"))
        least = written(least, "joins")
        if least.filter(F.col("to") != F.col("comp")).isEmpty():
            return label
        onward = least.select(F.col("comp").alias("to"), F.col("to").alias("further"))
        target = least.join(onward, "to", "left").select("comp", F.coalesce("further", "to").alias("to"))
        label = label.join(target, "comp").select("node", F.col("to").alias("comp"))


def fingerprinted(docs: DataFrame, text: str, shingle: int = SHINGLE, **more: Column) -> DataFrame:
    """``fp`` and the columns ``more`` for each row, written."""
    return written(docs.select(*[c.alias(n) for n, c in more.items()], fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")


def classes(rows: DataFrame, most: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """``fp, comp``: each distinct fingerprint of ``rows`` that is linked, with its component's least one."""
    distinct = rows.select("fp").distinct()
    return components(links(distinct, most, group))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    shingle: int = SHINGLE, most: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """``doc_id, fingerprint (hex), component_id`` for each row."""
    rows = fingerprinted(docs, text, shingle, doc_id=F.col(doc_id))
    label = classes(rows, most, group)
    by_fp = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comp = by_fp.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    comp = written(comp, "classes")
    named = comp.groupBy("comp").agg(F.min("least").alias("component_id"))
    by_fp = comp.join(named, "comp").select("fp", "component_id")
    return rows.join(by_fp, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                shingle: int = SHINGLE, most: int = DISTANCE, group: int = GROUP) -> DataFrame:
    """The row of least id (nulls last, then by content) of each component, with all its columns."""
    cells = [F.col(f"`{c}`") for c in docs.columns]
    content = F.struct(F.xxhash64(F.lit(1), *cells).alias("x"), F.xxhash64(F.lit(2), *cells).alias("y"))
    rows = fingerprinted(docs, text, shingle, doc_id=F.col(doc_id), content=content)
    label = classes(rows, most, group)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "content"))
    by_fp = rows.groupBy("fp").agg(first.alias("least"))
    comp = by_fp.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn("comp", F.coalesce("comp", "fp"))
    chosen = comp.groupBy("comp").agg(F.min("least").alias("least")).select("least.content")
    kept = docs.select(F.struct("*").alias("row"), content.alias("content")).join(chosen, "content", "left_semi")
    return kept.dropDuplicates(["content"]).select("row.*")
