"""Rolling usage per key over a log of calls.

A sliding frame re-adds its whole content for each row, which is quadratic for
a busy key, and a window over a whole key puts it into one task. Here:

1. calls of one key at one microsecond are added up (combined map-side);
2. each such moment gives two entries, one when it enters the window and one
   when it leaves, ``window`` later;
3. time is cut into buckets as long as the window. What entered in the bucket
   before leaves in this one, so the opening sum of a bucket is the total of its
   leaving entries and buckets need nothing from each other;
4. a bucket is cut into ``PARTS`` parts. Sums run only inside a part; they open with
   what the bucket's earlier parts came to, which are few numbers.

So a group is bounded by the microseconds of a part, not by the calls of a key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusqa.fixed_values import RATE_WINDOW_SECONDS, REQUESTS_PER_MINUTE, TOKENS_PER_MINUTE
from corpusqa.sources.shared import written

#: Parts of a window, each at least a second, in which running sums are made.
PARTS = 60


def rolling_usage(calls: DataFrame, window_seconds: int = RATE_WINDOW_SECONDS) -> DataFrame:
    """``(key, at_us, tokens)``, times in microseconds, to usage at each moment.

    Result, one row per key and moment: ``key, at_us, n_calls, tokens, max_tokens,
    window_calls, window_tokens``. The window is half-open: a call as old as the
    window is out. Calls at the same moment are all in each other's window.
    """
    width = F.lit(window_seconds * 1_000_000).cast("bigint")
    moments = calls.groupBy("key", "at_us").agg(
        F.count("*").alias("n_calls"),
        F.sum("tokens").cast("bigint").alias("tokens"),
        F.max("tokens").cast("bigint").alias("max_tokens"),
    )
    none = F.lit(0).cast("bigint")

    def entry(at: Column, calls_in, tokens_in, calls_out, tokens_out, largest) -> Column:
        return F.struct(
            (at - F.pmod(at, width)).alias("bucket"),
            at.alias("at_us"),
            calls_in.alias("calls_in"),
            tokens_in.alias("tokens_in"),
            calls_out.alias("calls_out"),
            tokens_out.alias("tokens_out"),
            largest.alias("max_tokens"),
        )

    at, n, tokens = F.col("at_us"), F.col("n_calls"), F.col("tokens")
    entries = moments.select(
        "key",
        F.inline(
            F.array(
                entry(at, n, tokens, none, none, F.col("max_tokens")),
                entry(at + width, none, none, n, tokens, none),
            )
        ),
    )
    part = F.lit(max(1, window_seconds // PARTS) * 1_000_000).cast("bigint")
    entries = entries.withColumn("part", F.col("at_us") - F.pmod("at_us", part))
    # What is inside at a moment: all that leaves in the bucket, what its earlier parts
    # came to, and what came less what left in its own part so far.
    totals = entries.groupBy("key", "bucket", "part").agg(
        *[F.sum(F.col(f"{x}_in") - F.col(f"{x}_out")).alias(f"{x}_net") for x in ("calls", "tokens")],
        *[F.sum(f"{x}_out").alias(f"{x}_left") for x in ("calls", "tokens")],
    )
    bucket = Window.partitionBy("key", "bucket")
    earlier = bucket.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    def opening(x: str) -> Column:
        return F.sum(f"{x}_left").over(bucket) + F.coalesce(F.sum(f"{x}_net").over(earlier), none)

    opened = totals.select("key", "bucket", "part", *[opening(x).alias(f"{x}_open") for x in ("calls", "tokens")])
    running = Window.partitionBy("key", "bucket", "part").orderBy("at_us").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    so_far = entries.withColumns({f"{x}_net": F.sum(F.col(f"{x}_in") - F.col(f"{x}_out")).over(running) for x in ("calls", "tokens")})
    return (
        so_far.filter(F.col("calls_in") > 0).join(opened, ["key", "bucket", "part"])
        .select(
            "key", "at_us", F.col("calls_in").alias("n_calls"), F.col("tokens_in").alias("tokens"), "max_tokens",
            (F.col("calls_net") + F.col("calls_open")).alias("window_calls"),
            (F.col("tokens_net") + F.col("tokens_open")).alias("window_tokens"),
        )
    )


def over_limits(
    usage: DataFrame,
    max_calls: int = REQUESTS_PER_MINUTE,
    max_tokens: int = TOKENS_PER_MINUTE,
) -> DataFrame:
    """Rolling usage with a flag per limit, one for either, and one for a single call too large."""
    return usage.withColumns(
        {
            "over_calls": F.col("window_calls") > max_calls,
            "over_tokens": F.col("window_tokens") > max_tokens,
            "over_any": (F.col("window_calls") > max_calls) | (F.col("window_tokens") > max_tokens),
            "oversized": F.col("max_tokens") > max_tokens,
        }
    )


def audit_calls(
    calls: DataFrame,
    max_calls: int = REQUESTS_PER_MINUTE,
    max_tokens: int = TOKENS_PER_MINUTE,
    window_seconds: int = RATE_WINDOW_SECONDS,
) -> DataFrame:
    """Every call with the rolling usage at its moment and its flags.

    An equi-join on (key, at_us); the usage side has one row per pair of them, so a
    moment with very many calls is skewed on one side only. That side is written: AQE
    splits a join with a written table, but none with an aggregation by the same key.
    """
    usage = rolling_usage(calls, window_seconds).select("key", "at_us", "window_calls", "window_tokens")
    usage = written(usage, "usage")
    flagged = over_limits(
        calls.join(usage, ["key", "at_us"]).withColumn("max_tokens", F.col("tokens")),
        max_calls, max_tokens,
    )
    return flagged.drop("max_tokens")
