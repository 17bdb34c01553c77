"""Line dedup by distinct-site spread, in native expressions.

A line that stands on at least ``SITES`` distinct sites is boilerplate and goes, with
all its occurrences. Lines are known by 128 bits of hash. Lines too rare to qualify
leave by count alone; for the rest, HyperLogLog sketches of their sites merge by
aggregation, and lines whose estimate lies near the threshold are counted exactly.
A removed line's number is joined back by text, so hot lines meet in no task; what is
joined is written first, so that a text which very many rows share is a join which is split.

Cases: lines end at a line feed, and a carriage return before it is no part of the line that
is compared; lines of white space only are never removed; a null site is one
more site; null and empty texts stay as they are; a text may become empty, its
row stays; repeated rows and copies lose the same lines; ties with the threshold go.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusqa.llm.common import text_key
from corpusqa.sources.shared import written

SITES = 10
#: Estimates within this share of the threshold are counted exactly; many times a sketch's error.
NEAR = 0.25
#: Sketches have 2 ** this many registers.
REGISTERS = 10


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _hashes(line: Column) -> list[Column]:
    line = F.rtrim(line, F.lit("\r"))
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit(1), line).alias("h2")]


def boilerplate(docs: DataFrame, text: str = "text", site: str = "source", sites: int = SITES, near: float = NEAR) -> DataFrame:
    """``h1, h2``: hashes of the lines that stand on at least ``sites`` distinct sites."""
    lines = (
        docs.select(F.xxhash64(F.col(site)).alias("site"), F.explode(_lines(F.col(text))).alias("line"))
        .filter(F.col("line").rlike(r"[^ \t-\r]")).select(*_hashes(F.col("line")), "site")
    )
    frequent = (
        lines.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min("site").alias("a"), F.max("site").alias("b"))
        .filter((F.col("n") >= sites) & ((F.col("a") != F.col("b")) | F.lit(sites == 1))).select("h1", "h2")
    )
    frequent = written(frequent, "frequent_lines")
    spread = (
        lines.join(frequent, ["h1", "h2"], "left_semi").groupBy("h1", "h2")
        .agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(REGISTERS))).alias("estimate"))
    )
    spread = written(spread, "line_spread")
    close = F.abs(F.col("estimate") - sites) <= near * sites
    exact = (
        lines.join(spread.filter(close), ["h1", "h2"], "left_semi").distinct()
        .groupBy("h1", "h2").count().filter(F.col("count") >= sites).select("h1", "h2")
    )
    clear = spread.filter(~close & (F.col("estimate") > sites)).select("h1", "h2")
    return written(clear.unionByName(exact), "boilerplate")


def _marked(docs: DataFrame, text: str, **names) -> DataFrame:
    """``row`` (all columns), ``gone`` (numbers of lines to remove, from 0, or null)."""
    lines = boilerplate(docs, text, **names)
    each = docs.select(text_key(text).alias("key"), F.posexplode(_lines(F.col(text))).alias("at", "line"))
    gone = (
        each.select("key", "at", *_hashes(F.col("line"))).join(lines, ["h1", "h2"], "left_semi")
        .groupBy("key").agg(F.collect_set("at").alias("gone"))
    )
    rows = docs.select(F.struct("*").alias("row"), text_key(text).alias("key"))
    return rows.join(written(gone, "lines_to_remove"), "key", "left").select("row", "gone")


def _kept(text: Column, gone: Column) -> Column:
    """The text without the lines of these numbers."""
    both = F.array(F.struct(_lines(text).alias("lines"), gone.alias("gone")))

    def cut(s: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(s["lines"]) - 1), s["gone"])
        return F.array_join(F.transform(left, lambda i: s["lines"][i]), "\n")

    return F.when(gone.isNull(), text).otherwise(F.transform(both, cut)[0])


def without_boilerplate(docs: DataFrame, text: str = "text", chars: str = "n_chars", **names) -> DataFrame:
    """The rows of ``docs`` with all their columns, boilerplate lines removed and ``chars`` counted anew."""
    rows = _marked(docs, text, **names)
    new = rows.select("row", "gone", _kept(F.col("row")[text], F.col("gone")).alias("kept"))
    out = F.col("row").withField(f"`{text}`", F.col("kept"))
    if chars in docs.columns:
        kind = docs.schema[chars].dataType
        count = F.when(F.col("gone").isNull(), F.col("row")[chars]).otherwise(F.length("kept").cast(kind))
        out = out.withField(f"`{chars}`", count)
    return new.select(out.alias("row")).select("row.*")


def line_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **names) -> DataFrame:
    """``doc_id, n_lines, n_removed, text``: the remaining text of each row."""
    rows = _marked(docs, text, **names)
    body = F.col("row")[text]
    return rows.select(
        F.col("row")[doc_id].alias("doc_id"),
        F.when(body.isNull(), 0).otherwise(F.size(_lines(body))).cast("bigint").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("bigint").alias("n_removed"),
        _kept(body, F.col("gone")).alias("text"),
    )


LINE_COUNTS_SQL = rf"""
WITH lines AS (
  SELECT doc_id, text, source, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS at FROM documents),
boiler AS (
  SELECT rtrim(line, chr(13)) AS line FROM lines WHERE regexp_matches(line, '[^ \t-\r]') GROUP BY 1
  HAVING count(DISTINCT source) + max((source IS NULL)::INT) >= {SITES})
SELECT d.doc_id, len(string_split(d.text, chr(10))) AS n_lines,
  (SELECT count(*) FROM lines l WHERE l.doc_id = d.doc_id AND rtrim(l.line, chr(13)) IN (SELECT line FROM boiler)) AS n_removed,
  coalesce((SELECT string_agg(l.line, chr(10) ORDER BY l.at) FROM lines l
    WHERE l.doc_id = d.doc_id AND rtrim(l.line, chr(13)) NOT IN (SELECT line FROM boiler)), '') AS text
FROM documents d"""
