"""Records of large CSV files whose cells may hold line breaks, read by many tasks.

Spark's reader takes such a file in one task, since only the quotes before a line tell
whether it opens a record. Here files are read line by line, in as many splits as Spark
makes. What a line does to the state (inside a quoted cell or outside) is one of four
functions: leave it, flip it, set it to inside, set it to outside. Running a line's
function needs no start state: after the last setting line the state is known, and
flips since then are counted. So each split is folded for both start states at
once, the few numbers of each split are folded in file order, and then every line knows
its state and the number of its record. Only records of several lines are put together,
by that number, wherever their lines were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusqa.sources.shared import written

_INNER = r'(?:[^"]++|"")*+'
_CELL = rf'(?:"{_INNER}"[^,]*+|[^",][^,]*+|)'
_OPENS = rf'(?:{_CELL},)*+"{_INNER}\z'
#: Lines that end inside a quoted cell: begun outside of one, and begun inside.
ENDS_INSIDE = (rf"\A{_OPENS}", rf'\A{_INNER}(?:\z|"[^,]*+,{_OPENS})')

SPLIT = ["path", "split"]


def _states(sets: Column, flips: Column, within, start: int) -> Column:
    """Whether a row begins inside, if its window begins with ``start`` (0 or 1).

    ``sets`` is the state the row sets, null if none; ``flips`` how often the rows up to and
    with this one flip it.
    """
    before = within.rowsBetween(Window.unboundedPreceding, -1)
    last = F.max(F.when(sets.isNotNull(), F.struct("id", flips.alias("flips"), sets.alias("sets")))).over(before)
    flipped = F.coalesce(F.lag(flips).over(within), F.lit(0))
    state = F.when(last.isNull(), F.lit(start) + flipped).otherwise(last["sets"] + flipped - last["flips"])
    return F.pmod(state, F.lit(2)).cast("int")


def _function(after_outside: Column, after_inside: Column) -> tuple[Column, Column]:
    """The state that a row sets (or null), and 1 if it flips it."""
    sets = F.when(after_outside == after_inside, after_outside.cast("int"))
    return sets, ((after_outside > after_inside)).cast("int")


def _folded(rows: DataFrame, within) -> DataFrame:
    """Rows with ``b0, b1``: whether each begins inside if its window begins outside, or inside."""
    sets, flip = _function(F.col("a0"), F.col("a1"))
    rows = rows.withColumns({"sets": sets, "flips": F.sum(flip).over(within.rowsBetween(Window.unboundedPreceding, 0))})
    return rows.withColumns({f"b{s}": _states(F.col("sets"), F.col("flips"), within, s) for s in (0, 1)}).drop("sets", "flips")


def csv_lines(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """``path, split, id, line``: the lines of files in the order of ``id`` within a split."""
    text = F.col("value") if encoding.lower() in ("utf-8", "utf8") else F.decode(F.col("value").cast("binary"), encoding)
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("id"), text.alias("line"),
    )


def csv_file_records(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """``path, n, record``: the records of files, numbered from 1, with their line breaks as line feeds.

    A quote that nothing closes takes the rest of its file into one record.
    """
    within = Window.partitionBy(*SPLIT).orderBy("id")
    lines = csv_lines(spark, path, encoding).withColumns(
        {f"a{s}": F.col("line").rlike(ENDS_INSIDE[s]).cast("int") for s in (0, 1)}
    )
    lines = _folded(lines, within)
    after = {f"e{s}": F.when(F.col(f"b{s}") == 0, F.col("a0")).otherwise(F.col("a1")) for s in (0, 1)}
    begun = {f"n{s}": F.sum(1 - F.col(f"b{s}")).over(within.rowsBetween(Window.unboundedPreceding, 0)) for s in (0, 1)}
    lines = written(lines.withColumns({**after, **begun}).drop("a0", "a1"), "csv_lines")
    # a row for each split: what it does to the state, and the records it begins, for both starts
    ends = lines.groupBy(*SPLIT).agg(F.max_by(F.struct("e0", "e1", "n0", "n1"), "id").alias("end"))
    ends = ends.select(*SPLIT, F.col("split").alias("id"), F.col("end.e0").alias("a0"), F.col("end.e1").alias("a1"), "end.n0", "end.n1")
    order = Window.partitionBy("path").orderBy("split")
    ends = _folded(ends, order).withColumn("records", F.when(F.col("b0") == 0, F.col("n0")).otherwise(F.col("n1")))
    earlier = F.coalesce(F.sum("records").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = written(ends.select(*SPLIT, F.col("b0").alias("start"), earlier.alias("earlier")), "csv_splits")

    def known(name: str) -> Column:
        return F.when(F.col("start") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1"))

    placed = lines.join(starts, SPLIT).select(
        "path", (F.col("earlier") + known("n")).alias("n"), *SPLIT[1:], "id", "line",
        ((known("b") == 0) & (known("e") == 0)).alias("alone"),
    )
    line = F.regexp_replace("line", r"\r\z", "")
    alone = placed.filter("alone").select("path", "n", line.alias("record"))
    parts = F.sort_array(F.collect_list(F.struct("split", "id", line.alias("line"))))
    joined = placed.filter(~F.col("alone")).groupBy("path", "n").agg(parts.alias("parts"))
    return alone.unionByName(joined.select("path", "n", F.array_join(F.col("parts.line"), "\n").alias("record")))
