"""Question/answer rows as JSON lines, appended by run."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusqa.operators.exchange import alpaca_rows


def run_stamp(now: datetime | None = None) -> str:
    """``YYYYMMDD_HHMMSS_ffffff``, made once per run."""
    return (now or datetime.now()).strftime("%Y%m%d_%H%M%S_%f")


def stamped_name(base: str, stamp: str | None = None) -> str:
    """``dir/name.ext`` to ``dir/name_STAMP.ext``."""
    folder, slash, name = base.rpartition("/")
    stem, dot, ext = name.rpartition(".")
    if not stem:
        stem, dot, ext = name, "", ""
    return f"{folder}{slash}{stem}_{stamp or run_stamp()}{dot}{ext}"


def save_rows(
    pairs: DataFrame, path: str, run_id: str, include_verification: bool = False
) -> None:
    """Append the output rows of one run under ``path/run_id=...``.

    Earlier rows are never read or rewritten, so a run costs only its own rows.
    """
    rows = alpaca_rows(pairs, include_verification).withColumn("run_id", F.lit(run_id))
    rows.write.mode("append").partitionBy("run_id").json(path)


def save_batch(rows: DataFrame, path: str, run_id: str, batch: int | str) -> None:
    """Write one batch of a run to its own folder, replacing an unfinished attempt."""
    rows.write.mode("overwrite").json(f"{path}/run_id={run_id}/batch_id={batch}")
