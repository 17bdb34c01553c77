"""Sharding by rendezvous hashing of record keys over weighted shards, in native expressions.

Every shard bids for a key with ``ln(u) / weight``, u being a hash of key and
shard between 0 and 1; the highest bid takes the record. A shard's bids depend
on no other shard, so one more shard takes records only into itself, and a
shard's share follows its weight. A record's slot numbers a shard without gaps:
rows are numbered within (shard, bucket), a bucket being a hash of the whole
record, and start after the shard's earlier buckets, of which there are few, so
no task has to sort a whole shard. Fully equal rows are counted before the shuffle;
every ``COPIES`` of them get a bucket of their own, so a row that is repeated
without end is spread over its shard's buckets.

Cases: a null key is a key of its own; a null text has no bytes; equal keys share
a shard, their rows have different slots; fully equal rows may swap slots; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts into which each shard is cut to number its rows.
BUCKETS = 256
#: Copies of a row that share a bucket.
COPIES = 1 << 16
_UNIT = float(1 << 60)


def _number(text: Column, digits: int) -> Column:
    """The first hexadecimal digits of a text's MD5 as a number."""
    return F.conv(F.substring(F.md5(text), 1, digits), 16, 10).cast("bigint")


def bids(key: Column, weights: Sequence[float]) -> Column:
    """``array<struct<bid, shard>>``, a bid of each shard for the key."""
    name = F.coalesce(key.cast("string"), F.lit("null"))

    def bid(weight: Column, shard: Column) -> Column:
        u = (_number(F.concat_ws(":", name, shard.cast("string")), 15) + 1) / F.lit(_UNIT)
        return F.struct((F.ln(u) / weight).alias("bid"), shard.alias("shard"))

    return F.transform(F.array(*[F.lit(float(w)) for w in weights]), bid)


def sharded(
    docs: DataFrame, weights: Sequence[float], extra: float | None = None,
    doc_id: str = "doc_id", text: str = "text", buckets: int = BUCKETS, copies: int = COPIES,
) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot``, and ``grown_shard`` with one shard more of weight ``extra``."""
    if any(w <= 0 for w in [*weights, extra or 1]):
        raise ValueError("weights must be positive")
    more = [] if extra is None else [extra]
    body = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        (F.octet_length(body).cast("bigint") + 8).alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        bids(F.col(doc_id), [*weights, *more]).alias("bids"),
    )
    best = F.array_max(F.slice("bids", 1, len(weights)))["shard"]
    grown = F.array_max("bids")["shard"] if more else F.lit(None).cast("int")
    record = ["doc_id", "text_crc32", "size"]
    equal = rows.select(*record, best.alias("shard"), grown.alias("grown_shard")).groupBy(*record, "shard", "grown_shard")
    blocks = F.sequence(F.lit(0), ((F.col("n") - 1) / copies).cast("int"))
    runs = equal.agg(F.count("*").alias("n")).withColumn("block", F.explode(blocks))
    runs = runs.select(
        *record, "shard", "grown_shard", "block",
        F.least(F.lit(copies).cast("bigint"), F.col("n") - F.col("block").cast("bigint") * copies).alias("m"),
        (_number(F.concat_ws(":", *record, F.when(F.col("block") > 0, F.col("block"))), 8) % buckets).cast("int").alias("bucket"),
    )
    counts = runs.groupBy("shard", "bucket").agg(F.sum("m").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    opens = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("opens"))
    within = Window.partitionBy("shard", "bucket").orderBy(*record, "block").rowsBetween(Window.unboundedPreceding, -1)
    numbered = runs.withColumn("earlier", F.coalesce(F.sum("m").over(within), F.lit(0)))
    # opens has at most shards x buckets rows
    placed = numbered.join(F.broadcast(opens), ["shard", "bucket"])
    return placed.withColumn("nth", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("m") - 1))).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("opens") + F.col("earlier") + F.col("nth")).alias("slot"), "grown_shard"
    )


def key_law_sql(shards: int, buckets: int = BUCKETS, copies: int = COPIES) -> str:
    """DuckDB SQL for ``documents`` in equal shards by key, and with one shard more."""
    hashed = "('0x' || substring(md5({}), 1, {}))::BIGINT"
    step = "CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    bid = hashed.format("coalesce(doc_id::VARCHAR, 'null') || ':' || s", 15)
    byte = "('0x' || substring(h, 2 * i + 1, 2))::BIGINT"
    return f"""WITH crc AS MATERIALIZED (
    SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce([n] || range(8), lambda a, b: {step}) AS c FROM range(256) r(n))),
  rows AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 8 AS size, hex(encode(coalesce(text, ''))) AS h,
      list_transform(range({shards + 1}), lambda s: {bid}) AS bids FROM documents),
  summed AS (SELECT doc_id, CAST(size AS BIGINT) AS size, bids, xor(4294967295, list_reduce(
      [4294967295::BIGINT] || list_transform(range(size - 8), lambda i: {byte}), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS text_crc32
    FROM rows, crc),
  dealt AS (SELECT *, CAST(list_position(bids[1:{shards}], list_max(bids[1:{shards}])) - 1 AS INTEGER) AS shard,
      CAST(list_position(bids, list_max(bids)) - 1 AS INTEGER) AS grown_shard,
      {hashed.format("concat_ws(':', doc_id, text_crc32, size, nullif(block, 0))", 8)} % {buckets} AS bucket
    FROM (SELECT *, (row_number() OVER (PARTITION BY doc_id, text_crc32, size) - 1) // {copies} AS block FROM summed))
  SELECT doc_id, size, CAST(text_crc32 AS BIGINT) AS text_crc32, 'key' AS law, shard,
    row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard FROM dealt"""
