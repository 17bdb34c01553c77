"""Benchmark decontamination: which document words stand inside a benchmark passage.

A prefix-filtered set join. An item's windows (13 consecutive words, or all
words of a shorter item) are sets of five-word shingles. A document contains a
window only if it contains all its shingles, so one shingle, the rarest in the
corpus, is prefix enough. Documents offer only shingles that are somebody's
prefix; an offer names the window's place, which is checked against the
document's bounds before the words themselves are compared.

Cases: null and empty texts have no words and no hits; an item without words has
no window; an item with a null id hits words but is not listed; repeated rows
and equal texts get equal results. Texts of any length are read whole. Other
columns are ignored, or kept as they are by ``clean_rows``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.common import ALNUM, BitSet, Words, bit_set, bits_for, pieces, shingle_hashes, text_key
from corpusqa.sources.shared import written

WINDOW = 13
SHINGLE = 5


def item_windows(items: DataFrame, item_id: str, text: str, window: int = WINDOW) -> DataFrame:
    """``item_id, words array<string>``: every window of every item."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.translate(F.coalesce(F.col(text), F.lit("")), upper, upper.lower())
    words = F.array_remove(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), "")
    cut = items.select(F.col(item_id).alias("item_id"), words.alias("w")).filter(F.size("w") > 0)
    at = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("w") - (window - 1))))
    return cut.select("item_id", "w", at.alias("at")).select(
        "item_id", F.slice("w", F.col("at"), window).alias("words")
    )


def _word_hashes(words: list[str]) -> np.ndarray:
    return Words([" ".join(words).encode()], ALNUM, False).hashes()


def _window_shingles(windows: DataFrame, size: int) -> DataFrame:
    """``win, n, offset, k, h``: the shingles of each distinct window; short windows are one shingle."""

    @F.pandas_udf("array<bigint>")
    def hashed(words: pd.Series) -> pd.Series:
        return pd.Series(
            [shingle_hashes(_word_hashes(list(w)), min(size, len(w))).view(np.int64) for w in words]
        )

    distinct = windows.select("words").distinct()
    return distinct.select(
        F.array_join("words", " ").alias("win"), F.size("words").alias("n"),
        F.least(F.size("words"), F.lit(size)).alias("k"), F.posexplode(hashed("words")).alias("offset", "h"),
    )


def _offers(lengths: list[int], bits: BitSet, context: tuple[int, int] | None):
    """A function of texts: word count, and shingles whose bit is set.

    With ``context`` (words before, words from) each offer carries the words around it.
    """
    def of(texts: pd.Series) -> pd.DataFrame:
        counts, found = [], []
        for _, piece in pieces(texts.tolist()):
            words = Words(piece, ALNUM, True)
            own = words.hashes()
            first = words.first
            here: list[list] = [[] for _ in piece]
            for k in lengths:
                h = shingle_hashes(own, k)
                at = np.flatnonzero(bits.has(h))
                doc = np.searchsorted(first, at, "right") - 1
                inside = at + k <= first[doc + 1]
                at, doc = at[inside], doc[inside]
                for d, a, value in zip(doc.tolist(), at.tolist(), h[at].view(np.int64).tolist()):
                    if context is None:
                        here[d].append(value)
                        continue
                    lo, hi = max(first[d], a - context[0]), min(first[d + 1], a + context[1])
                    here[d].append((k, value, a - first[d], a - lo, words.joined(lo, hi)))
            counts += np.diff(first).tolist()
            found += here
        return pd.DataFrame({"n_words": counts, "offers": found})

    return of


def _rarity(docs: DataFrame, text: str, shingles: DataFrame, lengths: list[int]) -> DataFrame:
    """How often each shingle of the windows stands in the documents: ``h, seen``."""
    known = shingles.select("h").distinct()
    of = _offers(lengths, bit_set(known, "h", bits_for(known.count())), None)

    def counted(batches):
        for batch in batches:
            offers = of(batch["t"])["offers"]
            values = np.array([v for row in offers for v in row], np.int64)
            h, n = np.unique(values, return_counts=True)
            yield pd.DataFrame({"h": h, "seen": n})

    return (
        docs.select(F.col(text).alias("t")).mapInPandas(counted, "h bigint, seen bigint")
        .groupBy("h").agg(F.sum("seen").alias("seen"))
    )


def hits(
    docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", window: int = WINDOW, shingle: int = SHINGLE,
) -> tuple[DataFrame, DataFrame]:
    """Word counts by text, and what was hit in the texts that were hit.

    First table: ``key, n_words`` for each row of ``docs``. Second: ``key,
    spans array<struct<start, stop>>, item_ids array`` for each distinct text
    with a hit, spans as word numbers in order, items distinct.
    """
    windows = written(item_windows(items, item_id, item_text, window), "item_windows")
    shingles = written(_window_shingles(windows, shingle), "item_shingles")
    lengths = sorted(r["k"] for r in shingles.select("k").distinct().collect())
    seen = _rarity(docs, text, shingles, lengths)
    ranked = shingles.join(seen, "h", "left").select(
        "win", "n", F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "h", "offset", "k").alias("s")
    )
    prefix = written(
        ranked.groupBy("win", "n").agg(F.min("s").alias("s")).select("win", "n", "s.h", "s.offset", "s.k"),
        "prefixes",
    )
    tokens = prefix.select("h").distinct()
    of = _offers(lengths, bit_set(tokens, "h", bits_for(tokens.count())), (window, window))
    offer = "n_words bigint, offers array<struct<k: int, h: bigint, at: int, before: int, around: string>>"
    offered = F.pandas_udf(of, offer)
    offers = written(
        docs.select(text_key(text).alias("key"), offered(F.coalesce(F.col(text), F.lit(""))).alias("o"))
        .select("key", "o.n_words", "o.offers"),
        "offers",
    )
    distinct = (
        offers.filter(F.size("offers") > 0)
        .groupBy("key").agg(F.first("n_words").alias("n_words"), F.first("offers").alias("offers"))
        .select("key", "n_words", F.explode("offers").alias("o")).select("key", "n_words", "o.*")
    )
    start, skip = F.col("at") - F.col("offset"), F.col("before") - F.col("offset")
    bounded = distinct.join(prefix, ["h", "k"]).filter((start >= 0) & (start + F.col("n") <= F.col("n_words")))
    same = F.array_join(F.slice(F.split("around", " "), skip + 1, F.col("n")), " ") == F.col("win")
    exact = bounded.filter(same)
    occurring = exact.select("key", "win", start.alias("start"), (start + F.col("n")).alias("stop"))
    occurring = written(occurring, "occurring")
    spans = occurring.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("start", "stop"))).alias("spans"))
    named = windows.select("item_id", F.array_join("words", " ").alias("win")).distinct()
    listed = (
        occurring.select("key", "win").distinct().join(named, "win")
        .groupBy("key").agg(F.collect_set("item_id").alias("item_ids"))
    )
    return offers.select("key", "n_words"), spans.join(listed, "key")


def covered(spans: Column) -> Column:
    """How many words sorted spans cover together."""
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).cast("bigint").alias("n"))

    def add(acc: Column, s: Column) -> Column:
        new = F.greatest(F.lit(0), s["stop"] - F.greatest(s["start"], acc["end"]))
        return F.struct(F.greatest(acc["end"], s["stop"]).alias("end"), (acc["n"] + new).alias("n"))

    return F.aggregate(spans, zero, add)["n"]


def is_contaminated(n_hit: Column, n_words: Column, one_in: int = 20) -> Column:
    return (n_hit > 0) & (one_in * n_hit >= n_words)


def measured(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``doc_id, n_words, n_hit, item_ids, contaminated`` for each row."""
    counts, found = hits(docs, items, text, **names)
    sizes = counts.groupBy("key").agg(F.first("n_words").alias("n_words"))
    by_text = sizes.join(found, "key", "left")
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_key(text).alias("key")).join(by_text, "key")
    n_hit = F.coalesce(covered(F.col("spans")), F.lit(0).cast("bigint"))
    out = rows.select("doc_id", "n_words", n_hit.alias("n_hit"), "item_ids")
    return out.withColumn("contaminated", is_contaminated(F.col("n_hit"), F.col("n_words")))


def clean_rows(docs: DataFrame, items: DataFrame, text: str = "text", **names) -> DataFrame:
    """The rows of ``docs``, with all their columns, that are not contaminated."""
    counts, found = hits(docs, items, text, **names)
    bad = (
        found.join(counts.dropDuplicates(["key"]), "key")
        .filter(is_contaminated(covered(F.col("spans")), F.col("n_words"))).select(F.col("key").alias("bad"))
    )
    rows = docs.select(F.struct("*").alias("row"), text_key(text).alias("key"))
    return rows.join(bad, F.col("key") == F.col("bad"), "left_anti").select("row.*")


def measured_sql(window: int = WINDOW) -> str:
    """DuckDB SQL for ``documents`` against ``benchmark``, item ids as a digest of their sorted list."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""WITH win AS (
    SELECT DISTINCT item_id, list_slice(w, i, i + {window - 1}) AS win FROM (
      SELECT item_id, w, unnest(range(1, greatest(1, len(w) - {window - 1}) + 1)) AS i
      FROM (SELECT item_id, {words} AS w FROM benchmark) WHERE len(w) > 0)),
  d AS (SELECT doc_id, {words} AS w FROM documents),
  hit AS (
    SELECT doc_id, pos, n, item_id FROM (
      SELECT doc_id, n, pos, list_slice(w, pos, pos + n - 1) AS win FROM (
        SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos
        FROM d, (SELECT DISTINCT len(win) AS n FROM win) WHERE len(w) >= n)) JOIN win USING (win)),
  covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM hit) GROUP BY doc_id),
  named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
      sha256(string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256 FROM hit GROUP BY doc_id)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
  FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""
