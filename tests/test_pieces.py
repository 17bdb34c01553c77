"""Files by byte ranges against the whole-file reader, and totals over batches."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from corpusqa.operators import usage
from corpusqa.sources.files import code_text, list_files
from corpusqa.sources.pieces import file_pieces
from corpusqa.streaming.totals import running_totals, save_totals

FILES = {
    "plain.py": b"one\ntwo\n\nfour",
    "ended.py": b"one\ntwo\n",
    "returns.py": b"a\r\nb\r\r\nc\rd\r\n\r\n",
    "last_return.py": b"a\r\nb\r",
    "feeds.py": b"\n\n\n",
    "marked.py": b"\xef\xbb\xbfone\ntwo",
    "marked_ended.py": b"\xef\xbb\xbfone\r\ntwo\n",
    "marked_latin.py": b"\xef\xbb\xbfone\ntwo\xe9\n",
    "accents.py": "é😀日\n本 x\x00y\n".encode() * 9,
    "late_latin.py": "é\n".encode() * 40 + b"\xe9\n",
    "long.py": b"x" * 300 + b"\n" + b"y" * 300,
}


@pytest.mark.parametrize("size", [7, 1 << 20])
def test_pieces_equal_the_whole_file(spark, tmp_path, size):
    for name, content in FILES.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "empty.py").write_bytes(b"")
    whole = list_files(spark, str(tmp_path)).select("path", code_text("content").alias("text")).collect()
    want = {r.path.rsplit("/", 1)[1]: r.text for r in whole}
    assert set(want) - {"empty.py"} == set(FILES)
    settings = {"spark.sql.files.maxPartitionBytes": str(size), "spark.sql.files.openCostInBytes": "1"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = file_pieces(spark, str(tmp_path)).collect()
    finally:
        for key in settings:
            spark.conf.unset(key)
    got: dict[str, dict[int, str]] = {}
    for r in rows:
        assert got.setdefault(r.path.rsplit("/", 1)[1], {}).setdefault(r.n, r.piece) == r.piece
    assert len(rows) == sum(len(p) for p in got.values())
    assert set(got) == set(FILES)
    for name, pieces in got.items():
        assert sorted(pieces) == list(range(1, len(pieces) + 1)), name
        assert "\n".join(pieces[n] for n in sorted(pieces)) == want[name], name


def test_totals_count_each_batch_once(spark, tmp_path):
    calls = spark.range(90).selectExpr("CASE WHEN id % 3 = 0 THEN 'verify' ELSE 'generate' END AS op",
                                       "id * 7 AS input_tokens", "id AS output_tokens", "id % 4 AS batch")
    folder = str(tmp_path / "totals")
    for batch in (0, 1, 2, 2, 3, 0):
        save_totals(calls.filter(F.col("batch") == batch), folder, batch)
    save_totals(calls.limit(0), folder, "empty")
    total = running_totals(spark, folder)
    assert usage.usage_summary(total).collect() == usage.usage_summary(calls).collect()
    assert sorted(usage.priced(total).collect()) == sorted(usage.usage_by_op(calls).collect())
