"""Packing token ids into sequences of equal capacity with balanced cost.

A piece of n tokens costs ``LINEAR * n + QUADRATIC * n * n``: attention looks from
each token at the piece's earlier ones. Documents are taken in groups as they
come. In a group, whole runs of ``capacity`` tokens of long documents fill
sequences of their own; then the documents' rests, in descending cost, go to the
sequence of lowest cost with room for them, cut only if none has. A group's
sequences hold exactly its tokens: as many full ones as they fill, then one for
each power of two in what remains, which needs no padding. So a group pads
nothing, whatever its size, and rows never leave their task: no shuffle.

Cases: a null text is empty; an empty document is its end mark alone; texts of any
length are cut as often as needed; repeated rows are packed as often as they
come; a null id stays null; other columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.bpe import described

CAPACITY = 1024
LINEAR, QUADRATIC = 1.0, 1.0 / 512
#: Documents that are packed together.
GROUP = 4096
#: Distinct words whose ids a task keeps (about 200 bytes each) before it starts anew.
CACHE = 1_000_000
END = 0
#: Texts whose ids are looked up together, and their characters (one longer text is a run of its own).
TEXTS, CHARACTERS = 512, 1 << 22
#: What opens a word, letters (Latin and Cyrillic), and what follows them from a character of ASCII that is none.
OPENERS = (" ", "\n")
_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u02af\u0400-\u0481\u048a-\u052f"
STEM = re.compile(f"([ \n])?([{_LETTERS}]+)([\x00-@\\[-`{{-\x7f].*)?", re.S)
#: How byte-level vocabularies spell bytes: printable ones as they are, the others from U+0100 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = sorted(set(range(256)).difference(_PRINTED))
BYTES = [chr(256 + _OTHERS.index(b)) if b in _OTHERS else chr(b) for b in range(256)]
BLANK = BYTES[32]


class Encoder:
    """Ids of texts, encoding each distinct word once.

    The vocabulary's rule always splits before a single space or a line feed between solid
    characters, and where letters end. So a text's ids are those of its words, each with
    the space or line feed before it, and a word's those of its letters and of what
    follows them: letters, the most of all, go to the vocabulary's merges straight away.
    A text for which that isn't sure (other white space next to a space, special
    strings) is encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        described(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        # a key is a word, its space left out, or a space and what has nothing before it
        # (numbers come from a counter: a dict that referred to itself would outlive its task)
        self.number: defaultdict[str, int] = defaultdict(itertools.count().__next__)
        self.feed = self.number[" \n"]
        self.flat = self.whole(["\n"])[0]
        self.start, self.length = np.zeros(1, np.int64), np.array([len(self.flat)])
        self.sure = np.ones(1, bool)

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.int32) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _gather(self, words: np.ndarray) -> np.ndarray:
        """The ids of known words, one after the other."""
        length = self.length[words]
        first = np.cumsum(length) - length
        return self.flat[np.repeat(self.start[words] - first, length) + np.arange(length.sum())]

    def _keep(self, at: list[int] | np.ndarray, length: np.ndarray, ids: np.ndarray) -> None:
        self.start[at] = np.cumsum(length) - length + len(self.flat)
        self.length[at] = length
        self.flat = np.append(self.flat, ids)

    def _learn(self) -> None:
        """Ids of the words that were numbered since the last call."""
        plain, others, unsure = [], [], []
        ids, sizes, texts = [], [], []
        tailed, fed = [], []
        number, tokenize, known = self.number, self.model.tokenize, len(self.start)
        while known < len(number):
            new = list(itertools.islice(reversed(number), len(number) - known))[::-1]
            for at, key in enumerate(new, known):
                cut = STEM.fullmatch(key)
                opener, stem, tail = cut.groups() if cut else (key[:1] if key[:1] in OPENERS else "", None, None)
                bare = key[1:] if opener else key
                if not bare or bare[-1].isspace() or bare[0].isspace():
                    unsure.append(at)
                elif opener == "\n":
                    fed += at, self.feed, number[" " + bare]
                elif stem is None:
                    others.append(at)
                    texts.append(bare if opener else " " + bare)
                elif tail:
                    tailed += at, number[(opener or "") + stem], number[" " + tail]
                else:
                    spelled = bare if bare.isascii() else "".join(map(BYTES.__getitem__, bare.encode()))
                    own = [t.id for t in tokenize(spelled if opener else BLANK + spelled)]
                    plain.append(at)
                    ids += own
                    sizes.append(len(own))
            known += len(new)
        more = known - len(self.start)
        self.start, self.length = (np.append(x, np.zeros(more, np.int64)) for x in (self.start, self.length))
        self.sure = np.append(self.sure, np.ones(more, bool))
        self.sure[unsure] = False
        self._keep(plain, np.array(sizes, np.int64), np.array(ids, np.int32))
        rest = self.whole(texts)
        self._keep(others, np.array([len(x) for x in rest], np.int64), np.concatenate([self.flat[:0], *rest]))
        # what follows a line feed may have a tail
        for pairs in (tailed, fed):
            triples = np.array(pairs, np.int64).reshape(-1, 3)
            at, both = triples[:, 0], triples[:, 1:]
            self.sure[at] = self.sure[both].all(axis=1)
            self._keep(at, self.length[both].sum(axis=1), self._gather(both.ravel()))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not texts:
            return []
        if len(self.number) > CACHE:
            self._clear()
        fed = pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " \n")
        cut = pc.split_pattern(fed, " ")
        words, opens = cut.flatten().dictionary_encode(), cut.offsets.to_numpy().astype(np.int64)
        distinct = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        numbers = np.fromiter(map(self.number.__getitem__, distinct), np.int64, len(distinct))[words.indices.to_numpy()]
        # a text's first word has nothing before it
        numbers[opens[:-1]] = [self.number[" " + distinct[i]] for i in words.indices.to_numpy()[opens[:-1]]]
        self._learn()
        unsure = set((np.searchsorted(opens, np.flatnonzero(~self.sure[numbers]), "right") - 1).tolist())
        ends = np.append(0, np.cumsum(self.length[numbers]))[opens].tolist()
        ids = self._gather(numbers)
        out = [ids[a:b] for a, b in zip(ends, ends[1:])]
        rest = [i for i, t in enumerate(texts) if i in unsure or any(s in t for s in self.special)]
        for i, own in zip(rest, self.whole([texts[i] for i in rest]) if rest else []):
            out[i] = own
        return out


def runs(texts: list[str], most: int = TEXTS, characters: int = CHARACTERS) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive runs of a batch's texts."""
    lo = size = 0
    for hi, text in enumerate(texts):
        size += len(text)
        if hi - lo == most or (hi > lo and size > characters):
            yield lo, hi
            lo, size = hi, len(text)
    if texts:
        yield lo, len(texts)


def cost(n, linear: float = LINEAR, quadratic: float = QUADRATIC):
    return linear * n + quadratic * n * n


def pack(lengths: np.ndarray, capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """``(document, start, length, sequence, offset)`` of every piece of documents of these lengths."""
    out: list[tuple[int, int, int, int, int]] = []
    sequence = 0
    for d, n in enumerate(lengths.tolist()):
        for start in range(0, n - n % capacity, capacity):
            out.append((d, start, capacity, sequence, 0))
            sequence += 1
    rest = lengths % capacity
    total = int(rest.sum())
    left = total % capacity
    sizes = [capacity] * (total // capacity) + [1 << b for b in range(left.bit_length() - 1, -1, -1) if left >> b & 1]
    room = np.array(sizes, np.int64)
    spent, filled = np.zeros(len(room)), np.zeros(len(room), np.int64)
    for d in np.argsort(-cost(rest.astype(float)), kind="stable").tolist():
        n, start = int(rest[d]), int(lengths[d] - rest[d])
        while n:
            fits = room >= n
            s = int(np.argmin(np.where(fits if fits.any() else room > 0, spent, np.inf)))
            m = min(n, int(room[s]))
            out.append((d, start, m, sequence + s, int(filled[s])))
            room[s] -= m
            filled[s] += m
            spent[s] += cost(m)
            start, n = start + m, n - m
    return out


def packed(
    docs: DataFrame, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, group: int = GROUP,
) -> DataFrame:
    """One row for each piece: ``doc_id, start, length, ids, doc_tokens, sequence_id, offset``.

    ``tokenizer`` is the vocabulary file's path on the executors. Ids are little-endian
    unsigned 32-bit numbers. A sequence's number holds its task's number in the upper bits.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    schema = f"doc_id {kind}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"

    def rows(names: list, ids: list[np.ndarray], first: int) -> tuple[pd.DataFrame, int]:
        lengths = np.array([len(x) for x in ids])
        pieces = pack(lengths, capacity)
        frame = pd.DataFrame(
            [
                (names[d], a, n, ids[d][a : a + n].astype("<u4").tobytes(), lengths[d], first + s, at)
                for d, a, n, s, at in pieces
            ],
            columns=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
        )
        return frame, first + 1 + max(s for *_, s, _ in pieces)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, names, ids = Encoder(tokenizer), [], []
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = batch["text"].tolist()
            for lo, hi in runs(texts):
                names += [None if pd.isna(x) else x for x in batch["doc_id"][lo:hi]]
                ids += [np.append(x, np.int32(END)) for x in encoder.encode(texts[lo:hi])]
                while len(ids) >= group:
                    frame, first = rows(names[:group], ids[:group], first)
                    names, ids = names[group:], ids[group:]
                    yield frame
        if ids:
            yield rows(names, ids, first)[0]

    plain = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return plain.mapInPandas(run, schema)

