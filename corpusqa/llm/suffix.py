"""Substring dedup: words in windows of 35 that stand elsewhere too, by suffix trees in parts.

A window is the start of a suffix. It is read from its lead on: the place of its
smallest eight-word shingle (by hash, then leftmost), first rightwards to the
window's end, then leftwards to its start. Windows are equal if and only if they
are equal read so, with the lead at the same offset. That reading begins with
the lead's words, so these are a prefix that files equal windows together, and
neighbouring windows with the same lead travel as one stretch of text.

* Leads that occur once are dropped by a count over all documents; a fixed-size
  bit set tells tasks which remain (a false one only travels for nothing).
* Leads with at most ``GROUP`` stretches: a task gets the lead's stretches and
  builds the subtree of its suffixes top-down. Members of a node are compared
  with its first member; where they part from it, child nodes open. What reaches
  depth 35 with company is a deep internal node: a repeat.
* Leads with more get a longer prefix, all 35 words: a node of equal windows, whose
  company is counted by an aggregation that combines before the shuffle.

Equal texts are found by their key; every window of theirs is repeated.

Cases: a null text has no words; texts of fewer than 35 words lose nothing; all
occurrences of a repeat lose it, the first too; repeated rows are copies of each
other; ids may be null or repeated; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.common import SOLID, BitSet, Words, bit_set, bits_for, pieces, shingle_hashes, text_key
from corpusqa.sources.shared import written

WINDOW = 35
LEAD = 8
#: Stretches of one lead that a task's subtree may hold, about 5 KB each in memory.
GROUP = 1 << 15
_ALL = 2**31 - 1


class Stretches:
    """Runs of consecutive windows with the same lead in several texts."""

    def __init__(self, words: Words, window: int, lead: int):
        own, first, n = words.hashes(), words.first, len(words)
        self.hashes = own
        shingles = shingle_hashes(own, lead)
        starts = max(0, n - window + 1)
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        places = np.uint64((1 << 28) - 1)
        least = (shingles & ~places) | np.arange(len(shingles), dtype=np.uint64)
        width, span = window - lead + 1, 1
        while 2 * span <= width:
            least = np.minimum(least[:-span], least[span:]) if len(least) > span else least[:0]
            span *= 2
        if span < width:
            least = np.minimum(least[: -(width - span)], least[width - span :]) if len(least) > width - span else least[:0]
        at = (least[:starts] & places).astype(np.int64)
        start = np.arange(len(at))
        valid = start + window <= first[doc[: len(at)] + 1]
        start, at = start[valid], at[valid]
        new = np.ones(len(start), bool)
        new[1:] = (at[1:] != at[:-1]) | (doc[start[1:]] != doc[start[:-1]])
        opens = np.flatnonzero(new)
        self.start, self.lead = start[opens], at[opens]
        self.last = start[np.append(opens[1:], len(start)) - 1] if len(opens) else start[:0]
        self.doc, self.h = doc[self.start], shingles[self.lead]


def _lead_counts(docs: DataFrame, text: str, window: int, lead: int) -> DataFrame:
    """``h, n``: leads and how many stretches have them, for those with more than one."""

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [Stretches(Words(p, SOLID, False), window, lead).h for _, p in pieces(batch["t"].tolist())]
            if found:
                h, n = np.unique(np.concatenate(found), return_counts=True)
                yield pd.DataFrame({"h": h.view(np.int64), "n": n})

    each = docs.select(F.col(text).alias("t")).mapInPandas(counted, "h bigint, n bigint")
    return each.groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")


def _texts_once(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[list, list[bytes]]]:
    """Keys and texts, a text once in a task; its copies have the same stretches."""
    seen = set()
    for batch in batches:
        keys = batch["key"].tolist()
        fresh = [i for i, k in enumerate(keys) if not (k in seen or seen.add(k))]
        keys, texts = [keys[i] for i in fresh], batch["t"].iloc[fresh].tolist()
        for first, piece in pieces(texts):
            yield keys[first : first + len(piece)], piece


def _stretches(keyed: DataFrame, repeated: BitSet, crowded: BitSet, window: int, lead: int) -> DataFrame:
    """``h, key, at, lead, words``: text of the stretches whose lead is repeated but not crowded."""

    def cut(batches):
        for keys, piece in _texts_once(batches):
            words = Words(piece, SOLID, False)
            s = Stretches(words, window, lead)
            take = np.flatnonzero(repeated.has(s.h) & ~crowded.has(s.h))
            if not len(take):
                continue
            base = words.first[s.doc[take]]
            bounds = zip(s.start[take].tolist(), (s.last[take] + window).tolist())
            yield pd.DataFrame({
                "h": s.h[take].view(np.int64), "key": [keys[d] for d in s.doc[take].tolist()],
                "at": s.start[take] - base, "lead": s.lead[take] - s.start[take],
                "words": [words.joined(a, b) for a, b in bounds],
            })

    return keyed.mapInPandas(cut, "h bigint, key binary, at int, lead int, words string")


def _crowded_windows(keyed: DataFrame, crowded: BitSet, window: int, lead: int) -> DataFrame:
    """``h, g, key, at array``: each distinct window of crowded leads in a text, and where it starts; g stands for its words."""

    def cut(batches):
        for keys, piece in _texts_once(batches):
            words = Words(piece, SOLID, False)
            s = Stretches(words, window, lead)
            take = np.flatnonzero(crowded.has(s.h))
            if not len(take):
                continue
            width = s.last[take] - s.start[take] + 1
            at = np.repeat(s.start[take] - (np.cumsum(width) - width), width) + np.arange(width.sum())
            doc, h = np.repeat(s.doc[take], width), np.repeat(s.h[take], width)
            g = shingle_hashes(s.hashes, window)[at]
            order = np.lexsort((at, g, h, doc))
            at, doc, h, g = at[order], doc[order], h[order], g[order]
            new = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1]) | (g[1:] != g[:-1])
            first = np.flatnonzero(np.append(True, new))
            yield pd.DataFrame({
                "h": h[first].view(np.int64), "g": g[first].view(np.int64),
                "key": [keys[d] for d in doc[first].tolist()],
                "at": np.split((at - words.first[doc]).astype(np.int32), first[1:]),
            })

    return keyed.mapInPandas(cut, "h bigint, g bigint, key binary, at array<int>")


def repeated_windows(group: np.ndarray, lead: np.ndarray, texts: list[str], window: int = WINDOW) -> list[np.ndarray]:
    """For each stretch, the numbers of its windows that equal another window of its group.

    The suffix trees of many groups at once, top-down, down to depth ``window``.
    """
    number: dict[str, int] = {}
    cut = [t.split(" ") for t in texts]
    flat = np.array([number.setdefault(w, len(number)) for c in cut for w in c], np.int64)
    size = np.array([len(c) for c in cut])
    count = size - window + 1
    opens = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(cut)), count)
    nth = np.arange(len(owner)) - opens[owner]
    pivot = (np.cumsum(size) - size)[owner] + lead[owner]  # where each window's reading begins
    right = window - (lead[owner] - nth)  # words read rightwards
    hit = np.zeros(len(owner), bool)

    def word(w: np.ndarray, depth) -> np.ndarray:
        place = np.where(depth < right[w], pivot[w] + depth, pivot[w] - 1 - (depth - right[w]))
        return flat[place]

    member = np.arange(len(owner))
    node = group[owner] * (window + 1) + right  # root's children: the lead and where it stands
    while len(member):
        order = np.argsort(node, kind="stable")
        member, node = member[order], node[order]
        new = np.append(True, node[1:] != node[:-1])
        place = np.flatnonzero(new)
        crowd = np.diff(np.append(place, len(node)))
        shared = np.repeat(crowd > 1, crowd)
        head = np.repeat(member[place], crowd)[shared]
        member, node = member[shared], node[shared]
        depth, together = np.zeros(len(member), np.int64), np.ones(len(member), bool)
        for d in range(window):
            together &= word(head, d) == word(member, d)
            depth += together
        deep = (depth == window) & (head != member)
        hit[member[deep]] = True
        hit[head[deep]] = True
        part = depth < window
        member, node, depth = member[part], node[part], depth[part]
        if len(member):
            child = np.stack([node, depth, word(member, depth)], axis=1)
            node = np.unique(child, axis=0, return_inverse=True)[1].reshape(-1)
    return [nth[a : a + n][hit[a : a + n]] for a, n in zip(opens.tolist(), count.tolist())]


def _tree_marks(stretches: DataFrame, window: int) -> DataFrame:
    """``key, start, stop``: words under repeated windows, group by group."""
    empty = pd.DataFrame({c: [] for c in stretches.columns})

    def marks(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = rows.drop_duplicates(["h", "key", "at"])
        rows = rows[rows["h"].duplicated(keep=False)]
        if not len(rows):
            return
        group = rows["h"].rank(method="dense").to_numpy().astype(np.int64)
        found = repeated_windows(group, rows["lead"].to_numpy(np.int64), rows["words"].tolist(), window)
        out = []
        for key, at, nth in zip(rows["key"], rows["at"].tolist(), found):
            if len(nth):
                breaks = np.flatnonzero(np.diff(nth) > 1)
                first, last = nth[np.append(0, breaks + 1)], nth[np.append(breaks, len(nth) - 1)]
                out += [(key, at + a, at + b + window) for a, b in zip(first.tolist(), last.tolist())]
        if out:
            yield pd.DataFrame(out, columns=["key", "start", "stop"])

    def run(batches):
        rest = empty
        for batch in batches:
            whole = pd.concat([rest, batch], ignore_index=True) if len(rest) else batch
            done = (whole["h"] != whole["h"].iloc[-1]).to_numpy()
            rest = whole[~done]
            yield from marks(whole[done])
        yield from marks(rest)

    return stretches.repartition("h").sortWithinPartitions("h").mapInPandas(run, "key binary, start int, stop int")


def _count_marks(windows: DataFrame, window: int) -> DataFrame:
    """The same from counting equal windows; an occurrence met in several copies counts once."""
    one, other = F.xxhash64("key", F.array_min("at")), F.xxhash64("key", F.array_max("at"))
    repeated = (
        windows.groupBy("h", "g").agg(F.min(F.least(one, other)).alias("least"), F.max(F.greatest(one, other)).alias("most"))
        .filter("least <> most").select("h", "g")
    )
    found = windows.join(repeated, ["h", "g"]).select("key", F.explode(F.array_distinct("at")).alias("start"))
    return found.select("key", "start", (F.col("start") + window).alias("stop"))


def repeats(docs: DataFrame, text: str = "text", window: int = WINDOW, lead: int = LEAD, group: int = GROUP) -> DataFrame:
    """``key, spans array<struct<start, stop>>``: words under repeated windows, by text.

    Spans may overlap; the span of a text with copies goes past its end.
    """
    keyed = docs.select(text_key(text).alias("key"), F.col(text).alias("t"))
    counts = written(_lead_counts(docs, text, window, lead), "leads")
    many = counts.filter(F.col("n") > group)
    n, n_many = counts.count(), many.count()
    repeated = bit_set(counts, "h", bits_for(n))
    crowded = bit_set(many, "h", bits_for(n_many, 1 << 23))
    marks = _tree_marks(_stretches(keyed, repeated, crowded, window, lead), window)
    if n_many:
        marks = marks.unionByName(_count_marks(_crowded_windows(keyed, crowded, window, lead), window))
    copies = keyed.groupBy("key").count().filter("count > 1")
    marks = marks.unionByName(copies.select("key", F.lit(0).alias("start"), F.lit(_ALL).alias("stop")))
    return marks.groupBy("key").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW,
                    lead: int = LEAD, group: int = GROUP) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for each row; kept words are joined by one space."""

    @F.pandas_udf("n_words bigint, n_removed bigint, kept string")
    def cut(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        out = []
        for data, marked in zip(texts, spans):
            words = data.encode().split()
            n = len(words)
            if marked is not None and n >= window:
                edges = np.zeros(n + 1, np.int64)
                np.add.at(edges, [s["start"] for s in marked], 1)
                np.subtract.at(edges, [min(s["stop"], n) for s in marked], 1)
                gone = np.cumsum(edges)[:n] > 0
                words = [w for w, g in zip(words, gone.tolist()) if not g]
            out.append((n, n - len(words), b" ".join(words).decode()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])

    # written, so that a text which very many rows share is a join which is split
    found = written(repeats(docs, text, window, lead, group), "repeats")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"), text_key(text).alias("key"))
    return rows.join(found, "key", "left").select("doc_id", cut("t", "spans").alias("c")).select("doc_id", "c.*")


def without_repeats_sql(window: int = WINDOW) -> str:
    """DuckDB SQL for ``documents``, kept words as a digest."""
    return f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
  win AS (SELECT doc_id, pos, md5(array_to_string(list_slice(w, pos, pos + {window - 1}), ' ')) AS win
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - {window - 2})) AS pos FROM d WHERE len(w) >= {window})),
  twice AS (SELECT win FROM win GROUP BY win HAVING count(*) > 1),
  gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + {window})) AS pos FROM win SEMI JOIN twice USING (win)),
  kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text
    FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM d) ANTI JOIN gone USING (doc_id, pos)
    GROUP BY doc_id)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""
