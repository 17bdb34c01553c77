"""Line ends, country codes, full formats, and joins on texts that very many rows share."""

from __future__ import annotations

import itertools
import re
import string

import pytest
from pyspark.sql import functions as F

from corpusqa.llm import linededup, private, suffix
from tests.llm import odd


def test_carriage_returns_are_no_part_of_a_line(spark):
    rows = [(i, "own %d\r\n\r\nshared words\r\n \t\r\nend %d" % (i, i) if i % 2 else "own %d\nshared words\n\nend %d" % (i, i), f"s{i}") for i in range(12)]
    frame = spark.createDataFrame(rows, "doc_id int, text string, source string")
    got = {r.doc_id: (r.n_removed, r.text) for r in linededup.line_counts(frame).collect()}
    for i, text, _ in rows:
        assert got[i] == (1, re.sub(r"shared words\r?\n", "", text))


def test_phones_keep_their_country_code(spark):
    phones = ["+49 30 1234567", "+351 912 345 678", "+1 415 555 2671", "+7 495 123 4567", "+44 20 7946 0958", "030 1234567"]
    frame = spark.createDataFrame([(i, f"call {p}, or") for i, p in enumerate([*phones, "+49301234567"])], "doc_id int, text string")
    got = {r.doc_id: r.text for r in private.pseudonymised(frame, "k").collect()}
    for i, p in enumerate(phones):
        new = got[i][5:-4]
        assert new != p and re.sub(r"\d", "0", new) == re.sub(r"\d", "0", p)
        if p[0] == "+":
            assert new.split(" ")[0] == p.split(" ")[0]
    assert got[len(phones)][5:-4] == got[0][5:-4].replace(" ", "")  # the same number without blanks


def test_small_miss_is_no_title(spark):
    frame = spark.createDataFrame([(1, "I miss Paris in spring. Paris is nice."), (2, "Ask Miss Marple.")], "doc_id int, text string")
    got = {r.doc_id: (r.n_entities, r.text) for r in private.pseudonymised(frame, "k").collect()}
    assert got[1] == (0, "I miss Paris in spring. Paris is nice.")
    assert got[2][0] == 1 and "Marple" not in got[2][1]


def test_a_full_format_gets_longer(spark, monkeypatch):
    monkeypatch.setattr(private, "ROUNDS", 2)
    mails = [f"{a}@{b}.co" for a, b in itertools.product(string.ascii_lowercase, string.ascii_lowercase)][:400]
    frame = spark.createDataFrame([(i, m) for i, m in enumerate(mails)], "doc_id int, text string")
    rows = private.pseudonymised(frame, "k").collect()
    assert len({r.text for r in rows}) == 400 and not {r.text for r in rows} & set(mails)
    assert all(re.fullmatch(r"\d*[a-z]@[a-z]\.co", r.text) for r in rows)


@pytest.fixture
def hot(spark, tmp_path):
    """A third of all rows share one text, over several files; thresholds that this table passes."""
    rng = __import__("random").Random(1)
    shared = odd.sentence(rng, 60) + "\na line on all sites\nMr John Smith, +49 30 1234567\nReleased under the MIT licence\n" + odd.sentence(rng, 300)
    texts = [shared if i % 3 == 0 else odd.sentence(rng, 30) + f" {i}\na line on all sites" for i in range(2400)]
    rows = [(i, t, f"src{i % 20}") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id int, text string, source string").repartition(12).write.parquet(str(tmp_path / "docs"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "8k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "1k",
    }
    kept = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield spark.read.parquet(str(tmp_path / "docs"))
    for k, v in kept.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("run", [
    lambda docs: linededup.line_counts(docs),
    lambda docs: private.pseudonymised(docs, "k"),
    lambda docs: suffix.without_repeats(docs),
], ids=["lines", "surrogates", "substrings"])
def test_a_hot_text_is_split(hot, run):
    rows = run(hot)
    assert len(rows.collect()) == 2400
    assert "skew=true" in rows._jdf.queryExecution().executedPlan().toString()
