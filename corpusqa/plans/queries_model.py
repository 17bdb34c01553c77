"""Registered queries: requests, responses, verification, usage, rates, whole runs."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.fixed_values import GENERATION_PROMPT, VERIFICATION_PROMPT
from corpusqa.functions.money import currency, thousands
from corpusqa.functions.tokens import estimate_tokens
from corpusqa.operators import exchange, rates, usage
from corpusqa.operators.assemble import fold_lines
from corpusqa.operators.chunking import split_documents
from corpusqa.operators.answers import ask_logged
from corpusqa.operators.token_counts import count_tokens, read_ranks
from corpusqa.plans import samples
from corpusqa.plans.mining import Mined, mine
from corpusqa.plans.samples import spread, table
from corpusqa.plans.queries_text import MARKDOWN_SQL, _DENSE_ID
from corpusqa.sinks.json_rows import save_rows, stamped_name
from corpusqa.sources.files import documents, extract_text
from corpusqa.sources.shared import new_folder
from corpusqa.streaming.incremental import save_new
from corpusqa.streaming.totals import running_totals, total_new

QUERIES, SQL = {}, {}

#: Batches of the documents as a stream, and rows in one of its files, about.
BATCHES, FILE_ROWS = 3, 20_000


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_GEN_HEAD = _quoted(GENERATION_PROMPT.replace("{text}", ""))
_TOKEN = r"\p{L}+|\p{N}{1,3}|[^\s\p{L}\p{N}]+"


def tokens_sql(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, '{_TOKEN}')) AS BIGINT)"


def verify_prompt_sql(context: str, question: str, answer: str) -> str:
    text = _quoted(VERIFICATION_PROMPT.replace("{{", "{").replace("}}", "}"))
    for slot, value in (("context", context), ("question", question), ("answer", answer)):
        text = text.replace("{" + slot + "}", f"' || {value} || '")
    return text


def _answered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.answered(samples.windows(spark, sf_dir))


# -- generation ------------------------------------------------------------------


@query(f"""SELECT 'generate:' || path || '#' || chunk_id AS request_id, path, chunk_id, {_GEN_HEAD} || chunk AS prompt,
    {tokens_sql(f"({_GEN_HEAD} || chunk)")} AS input_tokens FROM ({samples.WINDOWS_SQL})""")
def gen_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = exchange.generation_requests(samples.windows(spark, sf_dir))
    return requests.select("request_id", "path", "chunk_id", "prompt", "input_tokens")


@query(f"SELECT doc_id, {tokens_sql('text')} AS n_tokens FROM documents")
def token_est(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    return docs.select("doc_id", estimate_tokens("text").alias("n_tokens"))


@query()
def bpe_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact counts of whole documents with a public vocabulary's ranks."""
    import public_tokenizers

    ranks = read_ranks(spark, f"file://{public_tokenizers.path('byte_bpe_50k.tiktoken')}")
    docs = spread(table(spark, sf_dir, "documents"), "doc_id").select("doc_id", "text")
    return count_tokens(docs, ranks, public_tokenizers.PATTERN).select("doc_id", "n_tokens")


@query(f"""SELECT path, chunk_id, CAST(pair_id AS INTEGER) AS pair_id, json_type(e) = 'OBJECT' AS is_object,
    json_extract_string(e, '$.instruction') AS instruction, json_extract_string(e, '$.output') AS output
  FROM ({samples.ELEMENTS_SQL})""")
def parse_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every element of every valid response array, the ones that are no objects too."""
    found = exchange.parsed_elements(_answered(spark, sf_dir))
    return found.select(
        "path", "chunk_id", "pair_id",
        F.col("fields").isNotNull().alias("is_object"),
        F.try_element_at("fields", F.lit("instruction")).alias("instruction"),
        F.try_element_at("fields", F.lit("output")).alias("output"),
    )


@query(f"SELECT instruction, input, output FROM ({samples.PAIRS_SQL})")
def alpaca_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.alpaca_rows(exchange.pairs(_answered(spark, sf_dir)))


@query(f"""SELECT instruction, CASE WHEN starts_with(input, '{{') THEN '{{''k'': [1, 2]}}' ELSE input END AS input,
    CASE WHEN output = 'true' THEN 'True' ELSE output END AS output FROM ({samples.PAIRS_SQL})""")
def python_spelled_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.alpaca_rows(exchange.pairs(_answered(spark, sf_dir), spelling="python"))


@query(f"""SELECT path, chunk_id, CASE WHEN error IS NOT NULL THEN 'call' ELSE 'parse' END AS stage,
    CASE WHEN error IS NOT NULL THEN error
      WHEN (doc_id + chunk_id) % 10 IN (3, 4, 5, 8, 9) THEN 'no valid JSON array' ELSE '1 elements are not objects' END AS reason
  FROM ({samples.ANSWERED_SQL})
  WHERE error IS NOT NULL OR (doc_id + chunk_id) % 10 IN (3, 4, 5, 8, 9) OR (doc_id % 5 = 3 AND (doc_id + chunk_id) % 10 <> 7)""")
def response_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exchange.parse_rejects(_answered(spark, sf_dir))


@query(f"SELECT path, count(*) AS n_pairs FROM ({samples.PAIRS_SQL}) GROUP BY path")
def pairs_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.pair_counts(exchange.pairs(_answered(spark, sf_dir)))


@query(f"SELECT path, chunk_id, count(*) AS n_pairs FROM ({samples.PAIRS_SQL}) GROUP BY path, chunk_id")
def pairs_per_chunk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.pair_counts(exchange.pairs(_answered(spark, sf_dir)), by_chunk=True)


@query(f"""SELECT path, count(*) AS n_chunks, CAST(sum(length(chunk)) AS BIGINT) AS n_chunk_chars
  FROM ({samples.WINDOWS_SQL}) GROUP BY path""")
def chunks_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.chunk_counts(samples.windows(spark, sf_dir))


# -- verification ------------------------------------------------------------------

_TURN_PAIRS = """SELECT 'conv/' || q.conv_id AS path, CAST(0 AS INTEGER) AS chunk_id, CAST(q.turn AS INTEGER) AS pair_id,
    q.text AS instruction, '' AS input, a.text AS output, c.chunk
  FROM conversations q JOIN conversations a ON q.conv_id = a.conv_id AND a.turn = q.turn + 1
  JOIN (SELECT conv_id, string_agg(text, chr(10) || chr(10) ORDER BY turn) AS chunk
        FROM conversations GROUP BY ALL) c
    ON c.conv_id = q.conv_id
  WHERE q.role = 'user' AND a.role = 'assistant'"""


def _turn_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User turns with their answers as pairs; the conversation as context."""
    turns = table(spark, sf_dir, "conversations")
    path = F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("path")
    asked = turns.filter("role = 'user'").select(
        path, (F.col("turn") + 1).alias("turn"), F.col("text").alias("instruction")
    )
    answers = turns.filter("role = 'assistant'").select(path, "turn", F.col("text").alias("output"))
    pairs = asked.join(answers, ["path", "turn"]).select(
        "path",
        F.lit(0).alias("chunk_id"),
        (F.col("turn") - 1).cast("int").alias("pair_id"),
        "instruction", F.lit("").alias("input"), "output", F.lit(True).alias("complete"),
    )
    texts = turns.select(path, "turn", F.col("text").alias("line"))
    chunks = fold_lines(texts, ["path"], "turn", separator="\n\n").select(
        "path", F.lit(0).alias("chunk_id"), F.col("text").alias("chunk")
    )
    return exchange.verification_requests(pairs, chunks)


_TURN_PROMPT = verify_prompt_sql("chunk", "instruction", "output")


@query(f"""SELECT 'verify:' || path || '#' || chunk_id || '#' || pair_id AS request_id, {_TURN_PROMPT} AS prompt,
    {tokens_sql(f"({_TURN_PROMPT})")} AS input_tokens FROM ({_TURN_PAIRS})""")
def verify_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _turn_requests(spark, sf_dir).select("request_id", "prompt", "input_tokens")


def _flat(verified: DataFrame) -> DataFrame:
    return verified.select(
        "path", "chunk_id", "pair_id", "instruction", "input", "output",
        "verification.status", "verification.explanation",
    )


_FLAT = "path, chunk_id, pair_id, instruction, input, output, status, explanation"
_JSON_FLAT = (
    "path, chunk_id, pair_id, instruction, input, output, "
    "CASE WHEN status = 'UNKNOWN' THEN 'CORRECT' ELSE status END AS status, "
    "CASE WHEN status = 'UNKNOWN' THEN 'ok' ELSE explanation END AS explanation"
)
_TURN_VERIFIED = samples.VERIFIED_SQL.replace(f"({samples.PAIRS_SQL}) WHERE complete", f"({_TURN_PAIRS})")


@query(f"SELECT {_FLAT} FROM ({_TURN_VERIFIED})")
def verify_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = _turn_requests(spark, sf_dir)
    return _flat(exchange.verified_pairs(exchange.attach_responses(asked, samples.verdicts(asked))))


@query(f"SELECT {_JSON_FLAT} FROM ({_TURN_VERIFIED})")
def verify_rows_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same responses read for a JSON verdict first."""
    asked = _turn_requests(spark, sf_dir)
    answered = exchange.attach_responses(asked, samples.verdicts(asked))
    return _flat(exchange.verified_pairs(answered, mode="json"))


# -- whole runs --------------------------------------------------------------------


def _mined(spark: SparkSession, sf_dir: str, verify: bool = True) -> Mined:
    return mine(_answered(spark, sf_dir), samples.check if verify else None)


@query(f"SELECT {_FLAT} FROM ({samples.VERIFIED_SQL})")
def mined_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(_mined(spark, sf_dir).pairs)


_PIPE = verify_prompt_sql("chunk", "instruction", "output")
_CALLS_SQL = f"""SELECT 'generate' AS op, {tokens_sql(f"({_GEN_HEAD} || chunk)")} AS i, {tokens_sql('response')} AS o
    FROM ({samples.ANSWERED_SQL}) WHERE error IS NULL
  UNION ALL SELECT 'verify', {tokens_sql(f"({_PIPE})")}, {tokens_sql('r')}
    FROM ({samples.VERIFIED_SQL}) WHERE r IS NOT NULL"""


def summary_sql(calls: str) -> str:
    return f"""SELECT CAST(gi AS BIGINT) AS total_input_tokens, CAST(go AS BIGINT) AS total_output_tokens,
    CAST(gi + go AS BIGINT) AS total_tokens, ci AS total_input_cost, co AS total_output_cost, ci + co AS total_cost,
    CAST(vi + vo AS BIGINT) AS total_verification_tokens, cv AS total_verification_cost, ci + co + cv AS grand_total_cost
  FROM (SELECT *, gi / 1e6 * 0.15::DOUBLE AS ci, go / 1e6 * 0.6::DOUBLE AS co,
      vi / 1e6 * 0.15::DOUBLE + vo / 1e6 * 0.6::DOUBLE AS cv
    FROM (SELECT coalesce(sum(i) FILTER (op = 'generate'), 0) AS gi, coalesce(sum(o) FILTER (op = 'generate'), 0) AS go,
      coalesce(sum(i) FILTER (op = 'verify'), 0) AS vi, coalesce(sum(o) FILTER (op = 'verify'), 0) AS vo FROM ({calls})))"""


@query(summary_sql(_CALLS_SQL))
def mined_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mined(spark, sf_dir).summary


@query(f"SELECT instruction, input, output, 'check' AS run_id FROM ({samples.PAIRS_SQL})")
def saved_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of an unverified run appended as JSON and read back."""
    folder = new_folder(spark, "rows")
    save_rows(_mined(spark, sf_dir, verify=False).pairs, folder, "check")
    schema = "instruction string, input string, output string, run_id string"
    return spark.read.schema(schema).json(folder)


@query(f"SELECT instruction, input, output, status, explanation, 'rows_check.json' AS name FROM ({samples.VERIFIED_SQL})")
def saved_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows with their verdicts under a stamped name, read back."""
    name = stamped_name(new_folder(spark, "rows.json"), "check")
    save_rows(_mined(spark, sf_dir).pairs, name, "run", include_verification=True)
    schema = "instruction string, input string, output string, verification struct<status: string, explanation: string>"
    rows = spark.read.schema(schema).json(name)
    folder = F.element_at(F.split(F.input_file_name(), "/"), -3)
    return rows.select("instruction", "input", "output", "verification.*", folder.alias("name"))


_PROMPT_SQL = f"{_GEN_HEAD} || chunk"


@query(f"""{MARKDOWN_SQL} SELECT path, {_DENSE_ID}, 0 AS pair_id,
    'How long? ' || length({_PROMPT_SQL}) AS instruction, 'true' AS input, right({_PROMPT_SQL}, 50) AS output
  FROM g WHERE chunk <> ''""")
def model_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a file, read, split and put to a function for a model."""
    docs = table(spark, sf_dir, "documents")
    made = docs.select(samples.document_path(F.lit(".md")).alias("path"), F.encode("text", "UTF-8").alias("content"))
    chunks = split_documents(documents(extract_text(made)))

    def model(prompts: list[str]) -> list[str]:
        return [
            "Here: " + json.dumps([{"instruction": f"How long? {len(p)}", "input": True, "output": p[-50:]}])
            for p in prompts
        ]

    requests, log = exchange.generation_requests(chunks), new_folder(spark, "answers")
    # a run that answers even sizes only, as if it had ended early, and one that goes on
    ask_logged(requests.filter(F.length("prompt") % 2 == 0), model, log, batch_size=16)
    return exchange.pairs(ask_logged(requests, model, log, batch_size=16)).drop("complete")


@query(f"SELECT path, chunk_id, pair_id, instruction, input, output FROM ({samples.PAIRS_SQL})")
def incremental_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as a stream, mined batch by batch; a second run finds nothing new."""
    docs = table(spark, sf_dir, "documents")
    source, output, checkpoint = (new_folder(spark, n) for n in ("documents", "rows", "progress"))
    # as many files as the rows ask for, dealt to three batches
    files = max(BATCHES, -(-docs.count() // FILE_ROWS))
    docs.repartitionByRange(files, "doc_id").write.parquet(source)

    def process(batch: DataFrame) -> DataFrame:
        named = batch.withColumn("path", samples.document_path(F.lit(".txt")))
        return mine(samples.answered(samples.char_windows(named, keep=["doc_id"]))).pairs

    for _ in range(2):
        stream = (
            spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", -(-files // BATCHES)).parquet(source)
        )
        save_new(stream, process, output, checkpoint, "check")
    schema = "path string, chunk_id int, pair_id int, instruction string, input string, output string"
    return spark.read.schema(schema).json(f"{output}/run_id=*/batch_id=*")


# -- usage --------------------------------------------------------------------------

_TURN_CALLS = f"""SELECT CASE WHEN conv_id % 3 = 0 THEN 'verify' ELSE 'generate' END AS op,
    CASE WHEN role = 'assistant' THEN 0 ELSE {tokens_sql('text')} END AS i,
    CASE WHEN role = 'assistant' THEN {tokens_sql('text')} ELSE 0 END AS o FROM conversations"""


def _calls_of(turns: DataFrame) -> DataFrame:
    tokens, out = estimate_tokens("text"), F.col("role") == "assistant"
    return turns.select(
        F.when(F.col("conv_id") % 3 == 0, "verify").otherwise("generate").alias("op"),
        F.when(out, 0).otherwise(tokens).cast("bigint").alias("input_tokens"),
        F.when(out, tokens).otherwise(0).cast("bigint").alias("output_tokens"),
    )


def _turn_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls_of(table(spark, sf_dir, "conversations"))


@query(summary_sql(_TURN_CALLS))
def running_usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns as a stream of several batches, totals kept by batch; a second run finds nothing new."""
    turns = table(spark, sf_dir, "conversations")
    source, folder, checkpoint = (new_folder(spark, n) for n in ("turns", "totals", "progress"))
    turns.repartitionByRange(3, "conv_id").write.parquet(source)
    for _ in range(2):
        stream = spark.readStream.schema(turns.schema).option("maxFilesPerTrigger", 1).parquet(source)
        total_new(stream, _calls_of, folder, checkpoint)
    return usage.usage_summary(running_totals(spark, folder))


@query(summary_sql(_TURN_CALLS))
def usage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.usage_summary(_turn_calls(spark, sf_dir))


@query(f"""SELECT op, n AS n_calls, CAST(i AS BIGINT) AS input_tokens, CAST(o AS BIGINT) AS output_tokens,
    CAST(i + o AS BIGINT) AS total_tokens, i / 1e6 * 0.15::DOUBLE AS input_cost, o / 1e6 * 0.6::DOUBLE AS output_cost,
    i / 1e6 * 0.15::DOUBLE + o / 1e6 * 0.6::DOUBLE AS total_cost
  FROM (SELECT op, count(*) AS n, sum(i) AS i, sum(o) AS o FROM ({_TURN_CALLS}) GROUP BY op)""")
def usage_by_op(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.usage_by_op(_turn_calls(spark, sf_dir))


@query(f"""SELECT total_cost, n AS n_pairs, total_cost / nullif(n, 0) AS average_cost
  FROM (SELECT sum(i) FILTER (op = 'generate') / 1e6 * 0.15::DOUBLE + sum(o) FILTER (op = 'generate') / 1e6 * 0.6::DOUBLE AS total_cost
        FROM ({_CALLS_SQL})), (SELECT count(*) AS n FROM ({samples.VERIFIED_SQL}))""")
def avg_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    mined = _mined(spark, sf_dir)
    return usage.average_cost(mined.summary, mined.pairs)


@query("""SELECT o_orderkey, '$' || format('{:,.6f}', o_totalprice) AS price_text, format('{:,}', o_orderkey * 1000) AS key_text FROM orders""")
def money_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey",
        currency("o_totalprice").alias("price_text"),
        thousands(F.col("o_orderkey") * 1000).alias("key_text"),
    )


# -- rates ---------------------------------------------------------------------------


def _event_calls(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.col(key).cast("string").alias("key"),
        samples.micros("ts").alias("at_us"),
        F.round(F.col("value") * 100).cast("bigint").alias("tokens"),
    )


def _rolling_sql(key: str, seconds: int) -> str:
    frame = f"OVER (PARTITION BY key ORDER BY at_us RANGE BETWEEN {seconds * 1_000_000 - 1} PRECEDING AND CURRENT ROW)"
    return f"""SELECT event_id, key, at_us, tokens, count(*) {frame} AS window_calls,
      CAST(sum(tokens) {frame} AS BIGINT) AS window_tokens
    FROM (SELECT event_id, CAST({key} AS VARCHAR) AS key, epoch_us(ts) AS at_us,
            CAST(round(value * 100) AS BIGINT) AS tokens FROM events)"""


def _moments_sql(key: str, seconds: int) -> str:
    return f"""SELECT key, at_us, count(*) AS n_calls, CAST(sum(tokens) AS BIGINT) AS tokens, max(tokens) AS max_tokens,
      max(window_calls) AS window_calls, max(window_tokens) AS window_tokens
    FROM ({_rolling_sql(key, seconds)}) GROUP BY key, at_us"""


@query(_moments_sql("user_id", 60))
def rolling_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.rolling_usage(_event_calls(spark, sf_dir, "user_id"))


@query(_moments_sql("event_type", 3600))
def rolling_usage_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A few keys with very many calls each."""
    return rates.rolling_usage(_event_calls(spark, sf_dir, "event_type"), 3600)


@query(f"""SELECT *, window_calls > 12 AS over_calls, window_tokens > 14000 AS over_tokens,
    window_calls > 12 OR window_tokens > 14000 AS over_any, tokens > 14000 AS oversized
  FROM ({_rolling_sql('event_type', 7200)})""")
def call_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = _event_calls(spark, sf_dir, "event_type")
    return rates.audit_calls(calls, max_calls=12, window_seconds=7200)


@query(f"""SELECT *, window_calls > 29 AS over_calls, window_tokens > 14000 AS over_tokens,
    window_calls > 29 OR window_tokens > 14000 AS over_any, max_tokens > 14000 AS oversized
  FROM ({_moments_sql('event_type', 60)})""")
def rate_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rates.over_limits(rates.rolling_usage(_event_calls(spark, sf_dir, "event_type")))
