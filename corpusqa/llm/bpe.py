"""Byte-level BPE: ids by a table of distinct words, texts by a table of pieces.

Encoding. Tasks split their texts into words, at white space only, which is where the
vocabulary's own rule always splits, too; so a text's ids are those of its words. A
block (consecutive rows of a task, about ``BLOCK`` bytes) is kept as a list of
its distinct words, the commonest first, and each text as numbers in that list.
The lists alone meet, by a hash of the word, in the table of distinct words, where
each word is encoded once; its ids go back to the blocks that hold it, and the
numbers in each text pick them in order. Texts never travel, and a word as common
as one third of all words is one entry of each block.

Decoding. The table of pieces (as many rows as the vocabulary has, at most
``VOCABULARY``) goes to all tasks and is joined with the ids by their number, a batch of
positions at once; a text is the pieces of its positions, read as UTF-8, with U+FFFD for
what isn't. (Exploding the ids for a join outside of Python gives the same at
thirty times the cost: each position is then a row to hand over.)

Cases: null and empty texts have no ids and decode to an empty text; texts of any
length are read whole; special strings are their special ids wherever they stand;
bytes that are no UTF-8 count as U+FFFD; null ids of an array and ids beyond the
vocabulary decode to nothing, a null array to an empty text; repeated rows are rows;
other columns stay as they are, also if named like the new ones (they are replaced).
A vocabulary that isn't byte-level is a ``ValueError``.
"""

from __future__ import annotations

import itertools
import json
import os
import re
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.sources.shared import new_folder

#: Bytes of text in a block; a block ends with the Arrow batch that reaches them.
BLOCK = 1 << 25
#: Parts of the table of distinct words. Only one is in a task's memory at a time.
BUCKETS = 1 << 12
#: Ids of a vocabulary whose pieces every task may hold (some 10 MB).
VOCABULARY = 1 << 20
#: Ids in one batch of results.
BATCH = 1 << 19

#: White space as Unicode has it (Python counts four control characters more).
SPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace() and not 0x1C <= ord(c) <= 0x1F)
WORD = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")


def described(path: str) -> dict:
    """The vocabulary file's content, if it is byte-level and splits words by the usual rule."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split, marks = spec.get("pre_tokenizer") or {}, spec.get("added_tokens") or []
    plain = (
        split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
        and (spec.get("decoder") or {}).get("type") == "ByteLevel" and not spec.get("normalizer")
        and not any(m["single_word"] or m["lstrip"] or m["rstrip"] for m in marks)
    )
    if not plain:
        raise ValueError(f"not a byte-level vocabulary: {path}")
    return spec


class Splitter:
    """Words of texts; special strings are words of their own."""

    def __init__(self, special: list[str]):
        self.special = re.compile("(" + "|".join(re.escape(s) for s in sorted(special, key=len, reverse=True)) + ")") if special else None

    def words(self, text: str) -> list[str]:
        if self.special is None or not self.special.search(text):
            return WORD.findall(text)
        out: list[str] = []
        for i, part in enumerate(self.special.split(text)):
            out += [part] if i % 2 else WORD.findall(part)
        return out


def packed_numbers(lists: list[np.ndarray]) -> list[bytes]:
    """Each list's small numbers in one byte, others in as many as needed, seven bits in each."""
    values = np.concatenate(lists)
    size = np.ones(len(values), np.int8)
    for bits in (7, 14, 21, 28):
        size += values >= 1 << bits
    end = np.cumsum(size, dtype=np.int64)
    start = end - size
    out = np.zeros(end[-1] if len(end) else 0, np.uint8)
    for j in range(5):
        on = np.flatnonzero(size > j) if j else slice(None)
        more = (size[on] > j + 1).view(np.uint8) << 7
        out[start[on] + j] = (values[on] >> 7 * j & 127).astype(np.uint8) | more
    last = np.cumsum([len(x) for x in lists])
    cut = np.append(0, np.append(0, end)[last]).tolist()
    data = out.tobytes()
    return [data[a:b] for a, b in zip(cut, cut[1:])]


def unpacked_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    end = np.flatnonzero(raw < 128)
    start = np.append(0, end[:-1] + 1)[: len(end)]
    out = np.zeros(len(end), np.int64)
    for j in range(5):
        on = start + j <= end
        out[on] |= (raw[start[on] + j] & 127).astype(np.int64) << 7 * j
    return out


class Block:
    """The distinct words of some texts, and each text as numbers of words."""

    def __init__(self):
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.texts: list[np.ndarray] = []
        self.rows: list[pa.Array] = []
        self.size = 0

    def add(self, texts: pa.Array, rows: pa.Array, splitter: Splitter) -> None:
        for lo in range(0, len(texts), 256):
            for text in texts.slice(lo, 256).to_pylist():
                words = splitter.words(text or "")
                self.texts.append(np.fromiter(map(self.number.__getitem__, words), np.int32, len(words)))
                self.size += len(text or "")
        self.rows.append(rows)

    def tables(self, name: int, buckets: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        """Rows of words by bucket, then rows of texts."""
        words = [w.encode() for w in self.number]
        seen = np.bincount(np.concatenate(self.texts), minlength=len(words))
        order = np.argsort(-seen, kind="stable")
        place = np.empty(len(words), np.int64)
        place[order] = np.arange(len(words))
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        by = np.lexsort((place, bucket))
        opens = np.flatnonzero(np.diff(bucket[by], prepend=-1))
        if len(opens):
            steps = np.diff(place[by], prepend=0)
            steps[opens] = place[by][opens]
            length = np.fromiter(map(len, words), np.int64, len(words))[by]
            joined = [b"".join([words[i] for i in part.tolist()]) for part in np.split(by, opens[1:])]
            n = len(opens)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.int64()), pa.array(bucket[by][opens], pa.int32()),
                 pa.array(packed_numbers(np.split(steps, opens[1:])), pa.binary()),
                 pa.array(packed_numbers(np.split(length, opens[1:])), pa.binary()), pa.array(joined, pa.binary()),
                 pa.nulls(n, schema.field("row").type)], schema=schema,
            )
        del words
        rows, lo = pa.concat_arrays(self.rows), 0
        while lo < len(self.texts):
            hi, size = lo + 1, len(self.texts[lo])
            while hi < len(self.texts) and size < BATCH:
                size += len(self.texts[hi])
                hi += 1
            data = packed_numbers([place[t] for t in self.texts[lo:hi]])
            m = hi - lo
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * m, pa.int64()), pa.array([buckets] * m, pa.int32()), pa.array(data, pa.binary()),
                 pa.nulls(m, pa.binary()), pa.nulls(m, pa.binary()), rows.slice(lo, m)], schema=schema,
            )
            lo = hi


def _split(special: list[str], block: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, name = Splitter(special), TaskContext.get().partitionId() << 32
        current, schema = Block(), None
        for batch in batches:
            if schema is None:
                schema = pa.schema([
                    ("block", pa.int64()), ("bucket", pa.int32()), ("data", pa.binary()), ("lengths", pa.binary()),
                    ("words", pa.binary()), ("row", batch.schema.field("row").type),
                ])
            current.add(batch.column("text"), batch.column("row"), splitter)
            if current.size >= block:
                yield from current.tables(name, buckets, schema)
                current, name = Block(), name + 1
        if current.texts:
            yield from current.tables(name, buckets, schema)

    return run


class Runs:
    """Runs of ids that lie one after the other in ``flat``, to be picked by number."""

    def __init__(self, length: np.ndarray, flat: np.ndarray):
        self.start, self.length, self.flat = np.cumsum(length) - length, length, flat

    def picked(self, which: np.ndarray) -> np.ndarray:
        size = self.length[which]
        end = np.cumsum(size)
        return self.flat[np.repeat(self.start[which] - (end - size), size) + np.arange(end[-1] if len(end) else 0)]


def _encoded_words(path: str, kind: str):
    """Words by bucket to their ids; each distinct word of a bucket is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        known: dict[str, list[int]] = {}
        for batch in batches:
            for lo in range(0, len(batch), 256):
                some = batch.slice(lo, 256)
                bucket = some.column("bucket").to_numpy()
                sizes = [unpacked_numbers(x) for x in some.column("lengths").to_pylist()]
                ends = np.append(0, np.cumsum(np.concatenate(sizes))).astype(np.int32)
                data = b"".join(some.column("words").to_pylist())
                flat = pa.StringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends), pa.py_buffer(data)).dictionary_encode()
                words, number = flat.dictionary.to_pylist(), flat.indices.to_numpy()
                new = [w for w in words if w not in known]
                known.update(zip(new, (e.ids for e in tokenizer.encode_batch_fast(new, add_special_tokens=False))))
                ids = [known[w] for w in words]
                length = np.fromiter(map(len, ids), np.int64, len(ids))
                runs = Runs(length, np.fromiter(itertools.chain.from_iterable(ids), np.uint32, length.sum()).astype(kind))
                each = np.split(number, np.cumsum([len(x) for x in sizes])[:-1])
                yield pa.RecordBatch.from_arrays(
                    [some.column("block"), some.column("data"), pa.array(packed_numbers([length[x] for x in each]), pa.binary()),
                     pa.array([runs.picked(x).tobytes() for x in each], pa.binary())],
                    names=["block", "data", "lengths", "ids"],
                )
                # only the last bucket can go on
                if bucket[0] != bucket[-1]:
                    rest = int(np.concatenate([[0], np.cumsum([len(x) for x in sizes])])[np.searchsorted(bucket, bucket[-1])])
                    known = {words[i]: ids[i] for i in np.unique(number[rest:]).tolist()}

    return run


def _joined(kind: str):
    """A block's texts and the ids of its words, by number, to texts with ids."""

    def run(texts: pa.Table, words: pa.Table) -> pa.Table:
        at, length, flat = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, kind)]
        for data, lengths, ids in zip(*(words.column(c).to_pylist() for c in ("data", "lengths", "ids"))):
            at.append(np.cumsum(unpacked_numbers(data)))
            length.append(unpacked_numbers(lengths))
            flat.append(np.frombuffer(ids, kind))
        order = np.argsort(np.concatenate(at))
        lengths = np.concatenate(length)
        runs = Runs(lengths[order], Runs(lengths, np.concatenate(flat)).picked(order))
        held = [runs.picked(unpacked_numbers(x.as_py())).astype(np.int32) for x in texts.column("data")]
        ends = np.cumsum([0] + [len(x) for x in held]).astype(np.int32)
        ids = pa.ListArray.from_arrays(ends, pa.array(np.concatenate([np.zeros(0, np.int32), *held])))
        return pa.table({"row": texts.column("row"), "ids": ids})

    return run


def encoded(
    docs: DataFrame, tokenizer: str, text: str = "text", ids: str = "ids", keep: list[str] | None = None,
    block: int = BLOCK, buckets: int = BUCKETS,
) -> DataFrame:
    """The rows (their columns ``keep``, or all) with ``ids array<int>``, as the vocabulary's library gives them.

    ``tokenizer`` is the vocabulary file's path, the same on driver and executors.
    """
    spec = described(tokenizer)
    marks = spec.get("added_tokens") or []
    top = max([*spec["model"]["vocab"].values(), *(m["id"] for m in marks)])
    kind = "<u2" if top < 1 << 16 else "<u4"
    names = [c for c in (docs.columns if keep is None else keep) if c != ids]
    kept = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(True).alias("_"))
    plain = docs.select(kept.alias("row"), F.make_valid_utf8(F.col(f"`{text}`")).alias("text"))
    row = plain.schema["row"].dataType.simpleString()
    split = plain.mapInArrow(
        _split([m["content"] for m in marks], block, buckets),
        f"block bigint, bucket int, data binary, lengths binary, words binary, row {row}",
    )
    # texts stay where they are: only the words' ids are shuffled to the block's bucket
    parts = bucketed(split, "block", "blocks")
    words = parts.filter(F.col("bucket") < buckets).select("block", "bucket", "data", "lengths", "words")
    words = words.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        _encoded_words(tokenizer, kind), "block bigint, data binary, lengths binary, ids binary"
    )
    texts = parts.filter(F.col("bucket") == buckets).select("block", "data", "row")
    out = texts.groupBy("block").cogroup(words.groupBy("block")).applyInArrow(_joined(kind), f"row {row}, ids array<int>")
    return out.select(*[F.col(f"row.`{c}`") for c in names], F.col("ids").alias(ids))


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """``df`` written to the shared folder in buckets of ``key``, so that a join by it shuffles the other side only.

    The catalog's entry is needed for reading alone and is dropped; the files stay.
    """
    spark = df.sparkSession
    folder, entry = new_folder(spark, name), f"{name}_{uuid.uuid4().hex}"
    writer = df.write.format("parquet").option("path", folder).option("compression", "zstd")
    writer.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).saveAsTable(entry)
    rows = spark.table(entry)
    rows.schema  # resolved before the entry goes
    spark.sql(f"DROP TABLE {entry}")
    return rows


def byte_of_sign() -> dict[str, int]:
    """The byte that each sign of a byte-level vocabulary stands for.

    Visible characters of Latin-1 stand for themselves; the other bytes, in order, for
    the characters from 256 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def pieces(spark: SparkSession, tokenizer: str) -> DataFrame:
    """``id, piece binary``: every id of the vocabulary."""
    spec = described(tokenizer)
    byte = byte_of_sign()
    rows = {
        i: bytes(byte[c] for c in sign) if all(c in byte for c in sign) else sign.encode()
        for sign, i in [*spec["model"]["vocab"].items(), *((m["content"], m["id"]) for m in spec.get("added_tokens") or [])]
    }
    table = pa.table({"id": pa.array(rows.keys(), pa.int32()), "piece": pa.array(rows.values(), pa.binary())})
    return spark.createDataFrame(table)


def decoded(rows: DataFrame, tokenizer: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows, but for the array ``ids``, with the text that the ids spell."""
    names = [c for c in rows.columns if c not in (ids, text)]
    kept = F.struct(*[F.col(f"`{c}`") for c in names]) if names else F.struct(F.lit(True).alias("_"))
    plain = rows.select(kept.alias("row"), F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    table = pieces(rows.sparkSession, tokenizer)
    size = table.agg(F.max("id")).first()[0] + 1
    if size > VOCABULARY:
        raise ValueError(f"{size} ids are too many for every task to hold")
    spelled = [b""] * (size + 1)  # the last for whatever is no id
    for r in table.collect():
        spelled[r["id"]] = bytes(r["piece"])
    side = Runs(np.array([len(p) for p in spelled]), np.frombuffer(b"".join(spelled), np.uint8))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first = batch.column("ids").offsets.to_numpy()
            lo = 0
            while lo < len(batch):
                hi = max(lo + 1, int(np.searchsorted(first, first[lo] + BATCH, "right")) - 1)
                which = batch.column("ids").values.slice(int(first[lo]), int(first[hi] - first[lo])).fill_null(-1).to_numpy()
                which = np.where((which < 0) | (which >= size), size, which).astype(np.int64)
                data = side.picked(which).tobytes()
                ends = np.append(0, np.cumsum(side.length[which]))[first[lo : hi + 1] - first[lo]].tolist()
                texts = [data[a:b].decode("utf-8", "replace") for a, b in zip(ends, ends[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("row").slice(lo, hi - lo), pa.array(texts, pa.string())], names=["row", "decoded"]
                )
                lo = hi

    row = plain.schema["row"].dataType.simpleString()
    out = plain.mapInArrow(run, f"row {row}, decoded string")
    return out.select(*[F.col(f"row.`{c}`") for c in names], F.col("decoded").alias(text))
