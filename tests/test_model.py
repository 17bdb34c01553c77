from __future__ import annotations

import base64
import json
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from corpusqa.functions.prompts import (
    generation_prompt,
    generation_tokens,
    verification_prompt,
    verification_tokens,
)
from corpusqa.functions.responses import json_elements, verdict
from corpusqa.functions.tokens import estimate_tokens
from corpusqa.operators import answers, exchange, rates, token_counts, usage
from corpusqa.plans.mining import mine, process_text, verify_dataset

GOOD = '[{"instruction": "q", "input": "", "output": "a"}]'


def answered(spark, *responses):
    rows = [(f"generate:d#{i}", "generate", "d", i, 10, r) for i, r in enumerate(responses)]
    schema = "request_id string, op string, path string, chunk_id int, input_tokens bigint, response string"
    return spark.createDataFrame(rows, schema).withColumn("error", F.lit(None).cast("string"))


@pytest.mark.parametrize(
    "response, n",
    [
        ('x [{"a":1}] y', 1), ('[{"a":1}] and [{"b":2}]', None), ('[{"a":1},]', None),
        ("[{'a':1}]", None), ('[{"a":"b\nc"}]', None), ("[]", 0), ("none", None), ("]x[", None),
        ("", None), ('[{"a":1}', None), ("[NaN]", None), ('[1, "x", null, {"a":[2]}]', 4),
    ],
)
def test_json_array_of_a_response(spark, response, n):
    got = spark.createDataFrame([(response,)], "r string").select(json_elements("r")).first()[0]
    assert (None if got is None else len(got)) == n


def test_pairs_and_rejects(spark):
    a = answered(
        spark,
        '["x",{"instruction":"q"}]',
        '[{"instruction":"q","input":null,"output":true,"verification":"no"}]',
        "nothing", "[]", GOOD,
        '[{"instruction":"$1 \\\\ \\"quoted\\"","input":{"k":1},"output":"\\u00e9"}]',
    )
    got = [
        (r.chunk_id, r.pair_id, r.instruction, r.input, r.output, r.complete)
        for r in exchange.pairs(a).orderBy("chunk_id", "pair_id").collect()
    ]
    assert got == [
        (0, 1, "q", "", "", False), (1, 0, "q", "None", "true", True), (4, 0, "q", "", "a", True),
        (5, 0, '$1 \\ "quoted"', '{"k":1}', "é", True),
    ]
    python = {r.chunk_id: (r.input, r.output) for r in exchange.pairs(a, spelling="python").collect()}
    assert python == {0: ("", ""), 1: ("None", "True"), 4: ("", "a"), 5: ("{'k': 1}", "é")}
    bad = [(r.chunk_id, r.stage, r.reason) for r in exchange.parse_rejects(a).orderBy("chunk_id").collect()]
    assert bad == [(0, "parse", "1 elements are not objects"), (2, "parse", "no valid JSON array")]


def test_prompts_keep_special_characters(spark):
    text = "cost $1 \\2 {text} 'x'"
    df = spark.createDataFrame([(text,)], "t string")
    row = df.select(generation_prompt("t").alias("g"), verification_prompt("t", F.lit("Q"), "t").alias("v")).first()
    assert row.g.endswith("Text: " + text) and row.g.startswith("Generate any number")
    assert f"Context: {text}\nQuestion: Q\nAnswer: {text}\n" in row.v
    assert '{\n    "verdict": "CORRECT" or "INCORRECT",' in row.v and "{{" not in row.v


def test_counting_by_pieces_equals_counting_the_prompt(spark):
    texts = ["", "a", " b ", "x1y2", ":", "\n", "{braces}", "…é 12345"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    pieces = df.select(
        generation_tokens("t", estimate_tokens), verification_tokens("t", "t", "t", estimate_tokens)
    )
    whole = df.select(
        estimate_tokens(generation_prompt("t")), estimate_tokens(verification_prompt("t", "t", "t"))
    )
    assert [tuple(r) for r in pieces.collect()] == [tuple(r) for r in whole.collect()]


@pytest.mark.parametrize(
    "response, error, mode, want",
    [
        ("CORRECT - ok", None, "prefix", ("CORRECT", "- ok")),
        ("  CORRECT - ok", None, "prefix", ("CORRECT", "CT - ok")),
        ("incorrect, no", None, "prefix", ("INCORRECT", ", no")),
        ("correct", None, "prefix", ("CORRECT", "")),
        ('{"verdict": "CORRECT"}', None, "prefix", ("UNKNOWN", "Unexpected verification response")),
        ('{"verdict": "CORRECT"}', None, "json", ("CORRECT", "")),
        ('ok {"verdict": "incorrect", "explanation": "e"} .', None, "json", ("INCORRECT", "e")),
        ('{"verdict": "MAYBE"}', None, "json", ("UNKNOWN", "Unexpected verification response")),
        ("CORRECT x", None, "json", ("CORRECT", "x")),
        (None, "boom", "prefix", ("ERROR", "boom")),
    ],
)
def test_verdict(spark, response, error, mode, want):
    df = spark.createDataFrame([(response, error)], "r string, e string")
    assert tuple(df.select(verdict("r", "e", mode)).first()[0]) == want


def chunk_table(spark, n=6):
    return spark.createDataFrame([("d", i, f"chunk {i}") for i in range(n)], "path string, chunk_id int, chunk string")


def model(prompt: str) -> str:
    if "chunk 3" in prompt:
        raise RuntimeError("busy")
    if prompt.startswith("You are"):
        return "CORRECT fine"
    return json.dumps([{"instruction": "What? " + prompt[-7:], "input": "", "output": "é"}])


def test_model_function_and_verification(spark):
    chunks = chunk_table(spark)
    pairs = process_text(chunks, model, parallelism=3)
    assert sorted(r.instruction for r in pairs.collect()) == [f"What? chunk {i}" for i in [0, 1, 2, 4, 5]]
    checked = verify_dataset(pairs, chunks, model)
    assert {tuple(r.verification) for r in checked.collect()} == {("CORRECT", "fine")}


def test_answers_that_are_no_text_are_errors(spark):
    def odd(prompt: str):
        return None if "chunk 0" in prompt else "\ud800"

    requests = exchange.generation_requests(chunk_table(spark, 2))
    got = exchange.apply_model(requests, odd).orderBy("chunk_id").collect()
    assert [r.response for r in got] == [None, None] and all(r.error for r in got)
    a = answered(spark, '[{"instruction":"\\ud800","output":1.50}]')
    assert [(r.instruction, r.output) for r in exchange.pairs(a, spelling="python").collect()] == [("?", "1.5")]


def test_responses_joined_from_a_table(spark):
    requests = exchange.generation_requests(chunk_table(spark))
    responses = spark.createDataFrame(
        [("generate:d#0", GOOD, None), ("generate:d#1", None, "busy"), ("generate:d#2", "none", None)],
        "request_id string, response string, error string",
    )
    joined = exchange.attach_responses(requests, responses)
    assert {r.chunk_id: r.error for r in joined.collect()} == {
        0: None, 1: "busy", 2: None, 3: "no response", 4: "no response", 5: "no response",
    }
    mined = mine(joined)
    assert [tuple(r) for r in mined.rows.collect()] == [("q", "", "a")]
    assert mined.calls.count() == 2  # the failed calls count nothing, the fruitless one does
    assert {(r.chunk_id, r.stage) for r in mined.rejects.collect()} == {
        (1, "call"), (2, "parse"), (3, "call"), (4, "call"), (5, "call"),
    }


def test_failed_verification_is_an_error_without_usage(spark):
    a = answered(spark, GOOD, '[{"instruction":"only"}]').withColumn("chunk", F.lit("c"))

    def failing(asked):
        return asked.withColumns({"response": F.lit(None).cast("string"), "error": F.lit("boom")})

    mined = mine(a, failing)
    assert [tuple(r.verification) for r in mined.pairs.collect()] == [("ERROR", "boom")]
    row = mined.summary.first()
    assert row.total_verification_tokens == 0 and row.total_input_tokens == 20
    assert [(r.stage, r.reason) for r in mined.rejects.collect()] == [
        ("verify", "pair without instruction or output")
    ]


def test_summary_of_no_calls(spark):
    none = spark.createDataFrame([], "op string, input_tokens bigint, output_tokens bigint")
    assert set(usage.usage_summary(none).first()) == {0, 0.0}
    average = usage.average_cost(usage.usage_summary(none), none).first()
    assert (average.n_pairs, average.average_cost) == (0, None)


def test_summary_fields(spark):
    rows = [("generate", 1_000_000, 500_000), ("generate", 1, 1), ("verify", 2_000_000, 1_000_000)]
    s = usage.usage_summary(spark.createDataFrame(rows, "op string, input_tokens bigint, output_tokens bigint")).first()
    assert (s.total_input_tokens, s.total_output_tokens, s.total_tokens) == (1_000_001, 500_001, 1_500_002)
    assert s.total_verification_tokens == 3_000_000
    assert s.total_cost == pytest.approx(0.45 + 0.15e-6 + 0.6e-6)
    assert s.total_verification_cost == pytest.approx(0.9)
    assert s.grand_total_cost == pytest.approx(s.total_cost + 0.9)


# -- rates ---------------------------------------------------------------------------


def by_scanning(calls, seconds):
    out = {}
    by_key = defaultdict(list)
    for key, at, tokens in calls:
        by_key[key].append((at, tokens))
    for key, entries in by_key.items():
        for at, _ in entries:
            inside = [t for a, t in entries if at - seconds * 1_000_000 < a <= at]
            out[key, at] = (len(inside), sum(inside))
    return out


@pytest.mark.parametrize("seconds", [1, 60])
def test_rolling_usage_equals_a_scan(spark, seconds):
    rng = random.Random(seconds)
    calls = [
        # one key holds most calls, many of them at the same moment
        (rng.choice("hhhhab"), rng.choice([rng.randrange(-200_000_000, 400_000_000), 7_000_000 * rng.randrange(9)]), rng.randrange(100))
        for _ in range(600)
    ]
    df = spark.createDataFrame(calls, "key string, at_us bigint, tokens bigint")
    got = {(r.key, r.at_us): (r.window_calls, r.window_tokens) for r in rates.rolling_usage(df, seconds).collect()}
    assert got == by_scanning(calls, seconds)
    audit = rates.audit_calls(df, window_seconds=seconds).collect()
    assert len(audit) == len(calls)
    assert all(got[r.key, r.at_us] == (r.window_calls, r.window_tokens) for r in audit)


def test_window_is_half_open(spark):
    calls = [("k", 0, 1), ("k", 59_999_999, 1), ("k", 60_000_000, 1)]
    df = spark.createDataFrame(calls, "key string, at_us bigint, tokens bigint")
    got = {r.at_us: r.window_calls for r in rates.rolling_usage(df).collect()}
    assert got == {0: 1, 59_999_999: 2, 60_000_000: 2}


def test_limits(spark):
    calls = [("k", i, 1) for i in range(30)] + [("big", 0, 15_000)]
    df = spark.createDataFrame(calls, "key string, at_us bigint, tokens bigint")
    got = {(r.key, r.at_us): r for r in rates.over_limits(rates.rolling_usage(df)).collect()}
    assert not got["k", 28].over_any and got["k", 29].over_calls and not got["k", 29].over_tokens
    assert got["big", 0].over_tokens and got["big", 0].oversized and not got["big", 0].over_calls


def test_of_several_answers_a_successful_one_counts(spark):
    requests = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "request_id string")
    answers = spark.createDataFrame(
        [("a", None, "boom"), ("a", "y", None), ("a", "x", None), ("b", None, "bad"), ("b", None, "bad"), ("c", "z", None)],
        "request_id string, response string, error string",
    )
    got = {r.request_id: (r.response, r.error) for r in exchange.attach_responses(requests, answers).collect()}
    assert got == {"a": ("x", None), "b": (None, "bad"), "c": ("z", None), "d": (None, "no response")}


def test_a_model_may_take_batches(spark):
    requests = spark.createDataFrame([(str(i), f"p{i}") for i in range(7)], "request_id string, prompt string")

    def model(prompts):
        assert len(prompts) <= 2
        return [ValueError("no") if p == "p3" else p.upper() for p in prompts]

    got = {r.request_id: (r.response, r.error) for r in exchange.apply_model(requests, model, 1, batch_size=2).collect()}
    assert got == {str(i): (None, "no") if i == 3 else (f"P{i}", None) for i in range(7)}


@pytest.mark.parametrize("text", ['{"pairs": [{"a": 1}], "extra": ["x"]}', '[1], "r": [2]', '[1]}, {"r": [2]', '[1]], "x": [[2]', "[1], [2]"])
def test_an_answer_must_be_one_array(spark, text):
    df = spark.createDataFrame([(text,), ("so: [1, [2]] ok",)], "t string")
    assert [r[0] for r in df.select(json_elements("t")).collect()] == [None, ["1", "[2]"]]


# -- the log of answers ------------------------------------------------------------------

def prompts(spark, n):
    return spark.range(n).select(
        F.concat(F.lit("r"), "id").alias("request_id"), F.concat(F.lit("prompt "), "id").alias("prompt"), "id"
    )


def test_a_run_that_was_killed_goes_on_without_asking_twice(spark, tmp_path):
    log, calls, dying = str(tmp_path / "log"), tmp_path / "calls", tmp_path / "dying"
    dying.touch()

    def model(prompt):
        import os

        with open(calls, "a") as file:
            file.write(prompt + "\n")
        with open(calls) as file:
            asked = len(file.readlines())
        if asked > 60 and os.path.exists(dying):
            os._exit(3)  # in the middle of a task
        return prompt.upper()

    requests = prompts(spark, 100)
    with pytest.raises(Exception):
        answers.ask_logged(requests, model, log, tasks=2, piece=5)
    kept = {r.request_id for r in answers.answer_log(spark, log).collect()}
    assert 0 < len(kept) < 100
    asked_before = calls.read_text().splitlines()
    dying.unlink()
    rows = answers.ask_logged(requests, model, log, tasks=2, piece=5).collect()
    assert sorted((r.id, r.response, r.error) for r in rows) == [(i, f"PROMPT {i}", None) for i in range(100)]
    again = calls.read_text().splitlines()[len(asked_before):]
    assert len(again) == len(set(again)) == 100 - len(kept)
    assert not {f"prompt {i[1:]}" for i in kept} & set(again)
    # a third run asks nothing
    assert answers.ask_logged(requests, model, log).count() == 100
    assert len(calls.read_text().splitlines()) == len(asked_before) + len(again)


def test_waves_and_tasks_follow_the_number_of_prompts(spark, tmp_path):
    requests = prompts(spark, 37)
    requests = requests.union(requests.limit(5))  # an id asked for by two rows has one answer
    log = str(tmp_path / "log")
    rows = answers.ask_logged(requests, lambda p: p[::-1], log, tasks=2, piece=4)
    assert rows.count() == 42 and rows.columns == ["request_id", "id", "response", "error"]
    assert answers.answer_log(spark, log).count() == 37
    folders = {r.f for r in spark.read.parquet(log).select(F.input_file_name().alias("f")).collect()}
    assert len(folders) >= 5  # as many waves of two tasks
    assert answers.ask_logged(requests.limit(0), lambda p: p, str(tmp_path / "other")).count() == 0


def test_errors_are_answers_unless_retried(spark, tmp_path):
    log, broken = str(tmp_path / "log"), tmp_path / "broken"
    broken.touch()

    def model(batch):
        import os

        return [ValueError("busy") if p.endswith("3") and os.path.exists(broken) else "ok" for p in batch]

    requests = prompts(spark, 10)
    for retry, is_broken, want in ((False, True, "busy"), (False, False, "busy"), (True, False, None)):
        if not is_broken and broken.exists():
            broken.unlink()
        rows = answers.ask_logged(requests, model, log, batch_size=4, retry_errors=retry).collect()
        assert {r.id: r.error for r in rows} == {i: want if i == 3 else None for i in range(10)}


def test_mining_continues_from_a_log(spark, tmp_path):
    chunks = spark.createDataFrame([("a", i, f"text {i}") for i in range(6)], "path string, chunk_id int, chunk string")
    log, calls = str(tmp_path / "log"), tmp_path / "calls"

    def model(prompt):
        with open(calls, "a") as file:
            file.write("x")
        return '[{"instruction": "q", "output": "a"}]'

    assert process_text(chunks.limit(2), model, log=log).count() == 2
    pairs = process_text(chunks, model, log=log)
    assert pairs.count() == 6 and len(calls.read_text()) == 6
    checked = verify_dataset(pairs, chunks, model, log=log)
    assert checked.count() == 6 and len(calls.read_text()) == 12


# -- exact token counts ------------------------------------------------------------------

@pytest.fixture(scope="module")
def vocabulary():
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    path = tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return path, tokenizers.PATTERN, tiktoken.Encoding("own", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), ranks


def test_pieces_merge_by_rank(vocabulary):
    import tiktoken

    ranks = vocabulary[3]
    whole = tiktoken.Encoding("whole", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(6)
    for n in [1, 2, 3, 10, 40, 200, 5000]:
        for letters in ("ab", "etaoin shrdlu", "aé日😀x"):
            piece = "".join(rng.choice(letters) for _ in range(n))
            tokens = token_counts.merged(piece.encode(), ranks)
            assert b"".join(tokens) == piece.encode()
            assert [ranks[t] for t in tokens] == whole.encode_ordinary(piece)


def test_counts_equal_the_librarys(spark, vocabulary):
    path, pattern, encoding, _ = vocabulary
    texts = [
        None, "", " ", "a", "don't stop", "tabs\t\tand\n\n lines \u00a0\u2003x", "1234567 ½ ² Ⅷ", "naïve café — ok", "日本語 テキスト 😀😀",
        "x" * 3000, "zqxj" * 2000, "<|endoftext|>", "same rare wordlikezz", "same rare wordlikezz", "  lead and trail  ",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "n_tokens int, text string").withColumn("key", F.lit("k"))
    ranks = token_counts.read_ranks(spark, path)
    got = token_counts.count_tokens(frame, ranks, pattern, into="size").collect()
    assert {r.n_tokens: r.size for r in got} == {i: len(encoding.encode_ordinary(t or "")) for i, t in enumerate(texts)}
    assert len(got) == len(texts) and got[0].key == "k"
    assert token_counts.count_tokens(frame.limit(0), ranks, pattern).count() == 0
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = token_counts.count_tokens(docs, ranks, pattern).collect()
    assert len(rows) == 200 and all(r.n_tokens == len(encoding.encode_ordinary(r.text or "")) for r in rows)


def test_a_vocabulary_too_large_is_refused(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(token_counts, "LARGEST", 100)
    with pytest.raises(ValueError, match="too large"):
        token_counts.count_tokens(spark.range(1).withColumn("text", F.lit("a")), token_counts.read_ranks(spark, vocabulary[0]), "a")


def test_token_counts_shuffle_nothing(spark, vocabulary, monkeypatch):
    path, pattern, encoding, _ = vocabulary
    monkeypatch.setattr(token_counts, "KEPT", 3)
    texts = [None, "", "strange qqzzxv words", "strange qqzzxv", "a", "zzqqx " * 700, "a"] * 90
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id bigint, text string").coalesce(1)
    got = token_counts.count_tokens(frame, token_counts.read_ranks(spark, path), pattern)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert {r.id: r.n_tokens for r in got.collect()} == {i: len(encoding.encode_ordinary(t or "")) for i, t in enumerate(texts)}
