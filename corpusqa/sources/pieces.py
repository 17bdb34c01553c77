"""Code and text files of any size, read by byte ranges into ordered pieces.

``read_texts`` makes one value of a file. Here a file is read in as many ranges as
Spark makes of it, line by line as bytes, so no task holds more than a line. What a
range can't know is settled by a few numbers for each: how many lines stand before it,
whether all of the file is UTF-8, whether its last line is ended, and whether it begins
with a byte order mark (Spark's line reader skips one). A code point never holds
the byte of a line feed, so none is cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusqa.functions.text import fold_newlines
from corpusqa.sources.shared import written

RANGE = ["path", "range"]
#: A byte order mark as UTF-8 text, and its bytes read as latin-1.
MARK, MARK_LATIN1 = "\ufeff", "\u00ef\u00bb\u00bf"


def byte_lines(spark: SparkSession, path: str) -> DataFrame:
    """``path, range, size, id, bytes``: lines as they are in files, ordered by ``id`` within a range."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("range"),
        F.col("_metadata.file_size").alias("size"), F.monotonically_increasing_id().alias("id"),
        F.col("value").cast("binary").alias("bytes"),
    )


def _text(valid: Column) -> Column:
    return F.when(valid, F.col("bytes").cast("string")).otherwise(F.decode("bytes", "ISO-8859-1"))


def file_pieces(spark: SparkSession, path: str) -> DataFrame:
    """``path, n, piece``: a file's pieces, numbered from 1, whatever the ranges are.

    Joined by line feeds they are the text that ``code_text`` gives of the whole file:
    UTF-8, or latin-1 if any byte of it is not; line ends folded. A piece ends at a line
    feed; a carriage return alone becomes a line feed inside its piece. A file
    that ends with a line feed ends with an empty piece. Empty files have no piece; compressed
    ones are not for this reader. The lines are written once; beside them only
    one row a range is shuffled, and joined back.
    """
    # written, as another scan might deal other ids
    lines = written(byte_lines(spark, path), "file_lines")
    ranges = lines.groupBy(*RANGE).agg(
        F.min("id").alias("first"), F.count("*").alias("lines"), F.max("size").alias("size"),
        F.sum(F.octet_length("bytes") + 1).alias("read"),
        F.min(F.is_valid_utf8(F.col("bytes").cast("string"))).alias("valid"),
    )
    of_file = Window.partitionBy("path")
    earlier = of_file.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    # bytes that the lines don't account for: 3 of a mark, and 1 less if the last line has no end
    unread = F.max("size").over(of_file) - F.sum("read").over(of_file)
    known = written(
        ranges.select(
            *RANGE, "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("earlier"),
            F.sum("lines").over(of_file).alias("total"), F.min("valid").over(of_file).alias("valid"),
            unread.isin(2, 3).alias("marked"), unread.isin(0, 3).alias("ended"),
        ),
        "file_ranges",
    )
    rows = lines.join(known, RANGE).withColumn("n", F.col("earlier") + F.col("id") - F.col("first") + 1)
    text = _text(F.col("valid"))
    bare = F.when(F.col("ended") | (F.col("n") < F.col("total")), F.regexp_replace(text, r"\r\z", "")).otherwise(text)
    mark = F.when(F.col("valid"), MARK).otherwise(MARK_LATIN1)
    marked = F.when(F.col("marked") & (F.col("n") == 1), mark).otherwise("")
    pieces = rows.select("path", "n", F.concat(marked, fold_newlines(bare)).alias("piece"))
    # the row of a file's first range stands for the file
    last = known.filter((F.col("earlier") == 0) & F.col("ended"))
    return pieces.unionByName(last.select("path", (F.col("total") + 1).alias("n"), F.lit("").alias("piece")))
