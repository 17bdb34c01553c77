"""Inputs that the registered queries derive from the given tables.

Everything here is a Spark expression over whole tables: file paths and bytes
for documents, model answers for chunks, verdicts for requests. The SQL next to
each says the same for the check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.operators.chunking import char_windows
from corpusqa.operators.exchange import attach_responses, generation_requests
from corpusqa.sources.shared import written

EXTENSIONS = [
    ".txt", ".py", ".md", ".html", ".json", ".csv", ".pdf", ".JAVA",
    ".zzz", "", ".tex", ".docx", ".Go", ".rst", ".xlsx", ".PY",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """The rows over all cores, by the hash of ``key``.

    The given tables are one row group each, which Spark reads in one task. The price is
    one exchange of the input; files of many row groups need no such step.
    """
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism, key)


def micros(ts: str) -> Column:
    """A timestamp without time zone as microseconds since 1970, in any session zone."""
    ts = F.col(ts)
    day = F.unix_date(ts.cast("date")).cast("bigint") * 86_400_000_000
    clock = F.hour(ts).cast("bigint") * 3_600_000_000 + F.minute(ts).cast("bigint") * 60_000_000
    return day + clock + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")


# -- documents as files ---------------------------------------------------------

def document_path(ext: Column) -> Column:
    return F.concat("source", F.lit("/doc"), F.col("doc_id").cast("string"), ext)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, text`` (and the source columns) with every document a ``.txt`` file."""
    return spread(table(spark, sf_dir, "documents"), "doc_id").withColumn("path", document_path(F.lit(".txt")))


DOCUMENTS_SQL = "SELECT *, source || '/doc' || doc_id || '.txt' AS path FROM documents"


def mixed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``documents`` with an extension of ``EXTENSIONS`` by document number."""
    choice = F.element_at(
        F.array(*[F.lit(e) for e in EXTENSIONS]), (F.col("doc_id") % len(EXTENSIONS) + 1).cast("int")
    )
    return spread(table(spark, sf_dir, "documents"), "doc_id").withColumn("path", document_path(choice))


_EXTENSION_LIST = "[" + ", ".join(f"'{e}'" for e in EXTENSIONS) + "]"
MIXED_SQL = f"""SELECT *, {_EXTENSION_LIST}[doc_id % {len(EXTENSIONS)} + 1] AS raw_ext,
    source || '/doc' || doc_id || {_EXTENSION_LIST}[doc_id % {len(EXTENSIONS)} + 1] AS path
  FROM documents"""


# -- windows, requests and answers -----------------------------------------------

def windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return char_windows(documents(spark, sf_dir), keep=["doc_id"])


WINDOWS_SQL = f"""SELECT path, doc_id, CAST(i AS INTEGER) AS chunk_id,
    substring(text, CAST(i AS BIGINT) * 1800 + 1, 2000) AS chunk
  FROM (SELECT *, unnest(range(greatest(1, CAST(ceil((length(text) - 200) / 1800.0) AS BIGINT)))) AS i
        FROM ({DOCUMENTS_SQL}) WHERE length(text) > 0)"""


def responses(chunks: DataFrame) -> DataFrame:
    """An answer for each chunk: good, wrapped in prose, broken, empty, or failed.

    The first pair's answer is the whole chunk's letters; the second element
    goes through missing, null, nested and non-object forms. Written, as a
    model's answers are, and read back as the table ``request_id, response, error``.
    """
    doc, n = F.col("doc_id"), F.col("chunk_id")
    clean = F.regexp_replace("chunk", "[^A-Za-z ]", " ")
    first = F.concat(
        F.lit('{"instruction": "What does part '), n.cast("string"), F.lit(" of "), F.col("path"),
        F.lit(' say?", "input": "", "output": "'), clean, F.lit('"}'),
    )
    second = (
        F.when(doc % 5 == 0, '{"instruction": "Which file?", "output": "A text file."}')
        .when(doc % 5 == 1, '{"instruction": "How long?", "input": null, "output": "Long."}')
        .when(doc % 5 == 2, '{"instruction": "Is it?", "input": {"k": [1, 2]}, "output": true}')
        .when(doc % 5 == 3, '"not an object"')
        .otherwise('{"instruction": "Only a question"}')
    )
    array = F.concat(F.lit("["), first, F.lit(", "), second, F.lit("]"))
    kind = (doc + n) % 10
    answer = (
        F.when(kind == 2, F.concat(F.lit("Here are the pairs:\n"), array, F.lit("\nDone.")))
        .when(kind == 3, F.concat(array, F.lit(" and "), array))
        .when(kind == 4, F.concat(F.lit("["), first))
        .when(kind == 5, "I cannot help with that.")
        .when(kind == 7, "[]")
        .when(kind == 8, F.concat(F.lit('{"pairs": '), array, F.lit(', "extra": ["x"]}')))
        .when(kind == 9, F.concat(array, F.lit(', "r": [2]')))
        .otherwise(array)
    )
    failed = doc % 17 == 3
    asked = generation_requests(chunks, keep=["doc_id", "chunk"])
    answers = asked.select(
        "request_id",
        F.when(~failed, answer).alias("response"),
        F.when(failed, "timeout").alias("error"),
    )
    return written(answers, "responses")


def answered(chunks: DataFrame) -> DataFrame:
    """Generation requests joined with their answers."""
    requests = generation_requests(chunks, keep=["doc_id", "chunk"])
    return attach_responses(requests, responses(chunks))


_FIRST = """'{"instruction": "What does part ' || chunk_id || ' of ' || path || ' say?", "input": "", "output": "'
      || regexp_replace(chunk, '[^A-Za-z ]', ' ', 'g') || '"}'"""
ANSWERED_SQL = f"""SELECT *, CASE WHEN doc_id % 17 = 3 THEN NULL ELSE
      CASE (doc_id + chunk_id) % 10
        WHEN 2 THEN 'Here are the pairs:' || chr(10) || arr || chr(10) || 'Done.'
        WHEN 3 THEN arr || ' and ' || arr
        WHEN 4 THEN '[' || first
        WHEN 5 THEN 'I cannot help with that.'
        WHEN 7 THEN '[]'
        WHEN 8 THEN '{{"pairs": ' || arr || ', "extra": ["x"]}}'
        WHEN 9 THEN arr || ', "r": [2]'
        ELSE arr END END AS response,
    CASE WHEN doc_id % 17 = 3 THEN 'timeout' END AS error
  FROM (SELECT *, '[' || first || ', ' || CASE doc_id % 5
          WHEN 0 THEN '{{"instruction": "Which file?", "output": "A text file."}}'
          WHEN 1 THEN '{{"instruction": "How long?", "input": null, "output": "Long."}}'
          WHEN 2 THEN '{{"instruction": "Is it?", "input": {{"k": [1, 2]}}, "output": true}}'
          WHEN 3 THEN '"not an object"'
          ELSE '{{"instruction": "Only a question"}}' END || ']' AS arr
        FROM (SELECT *, {_FIRST} AS first FROM ({WINDOWS_SQL})))"""

ELEMENTS_SQL = f"""SELECT path, doc_id, chunk_id, chunk, pair_id, json_extract(a, '$[' || pair_id || ']') AS e
  FROM (SELECT *, unnest(range(CAST(json_array_length(a) AS BIGINT))) AS pair_id
        FROM (SELECT *, regexp_extract(response, '\\[[\\s\\S]*\\]') AS a
              FROM ({ANSWERED_SQL}) WHERE error IS NULL)
        WHERE a <> '' AND json_valid(a))"""


def _field(key: str) -> str:
    return (
        f"CASE WHEN json_exists(e, '$.{key}') "
        f"THEN coalesce(json_extract_string(e, '$.{key}'), 'None') ELSE '' END AS {key}"
    )


PAIRS_SQL = f"""SELECT path, doc_id, chunk_id, chunk, CAST(pair_id AS INTEGER) AS pair_id,
    {_field('instruction')}, {_field('input')}, {_field('output')},
    json_exists(e, '$.instruction') AND json_exists(e, '$.output') AS complete
  FROM ({ELEMENTS_SQL}) WHERE json_type(e) = 'OBJECT'"""


def check(asked: DataFrame) -> DataFrame:
    """Verification requests answered in place, by the length of the pair's output."""
    kind = F.length("output") % 6
    answer = (
        F.when(kind == 0, "CORRECT - supported by the text")
        .when(kind == 1, "  correct: looks fine ")
        .when(kind == 2, "INCORRECT because it is off")
        .when(kind == 3, '{"verdict": "CORRECT", "explanation": "ok"}')
        .when(kind == 5, "CORRECT")
    )
    return asked.withColumns({"response": answer, "error": F.when(kind == 4, "boom")})


def verdicts(asked: DataFrame) -> DataFrame:
    """The same answers as a table of their own."""
    return check(asked).select("request_id", "response", "error")


VERDICT_RESPONSE_SQL = """CASE length(output) % 6
      WHEN 0 THEN 'CORRECT - supported by the text' WHEN 1 THEN '  correct: looks fine '
      WHEN 2 THEN 'INCORRECT because it is off'
      WHEN 3 THEN '{"verdict": "CORRECT", "explanation": "ok"}' WHEN 5 THEN 'CORRECT' END"""
VERIFIED_SQL = f"""SELECT *,
    CASE WHEN r IS NULL THEN 'ERROR' WHEN starts_with(upper(trim(r)), 'CORRECT') THEN 'CORRECT'
         WHEN starts_with(upper(trim(r)), 'INCORRECT') THEN 'INCORRECT' ELSE 'UNKNOWN' END AS status,
    CASE WHEN r IS NULL THEN 'boom' WHEN starts_with(upper(trim(r)), 'CORRECT') THEN trim(substring(r, 8))
         WHEN starts_with(upper(trim(r)), 'INCORRECT') THEN trim(substring(r, 10))
         ELSE 'Unexpected verification response' END AS explanation
  FROM (SELECT *, {VERDICT_RESPONSE_SQL} AS r FROM ({PAIRS_SQL}) WHERE complete)"""
