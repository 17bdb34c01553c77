"""Registered queries: files, text, tables, chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusqa.fixed_values import (
    CHUNK_OVERLAP,
    CHUNK_SIZE,
    CSV_NULL_TOKENS,
    DOCUMENT_EXTENSIONS,
    EXTENSION_LANGUAGES,
    HTML_SECTION_TAGS,
)
from corpusqa.functions import filetypes
from corpusqa.functions.html import html_text
from corpusqa.functions.text import py_strip
from corpusqa.operators import assemble, chunking, tables, usage
from corpusqa.plans import samples
from corpusqa.plans.samples import spread, table
from corpusqa.sources import csv_files, files
from corpusqa.sources.pieces import file_pieces
from corpusqa.sources.shared import new_folder

QUERIES, SQL = {}, {}

#: Makes keys of 19 digits, which a double can't tell apart.
LARGE_KEY = 1234567890123456000

_B = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}"
    r"\x{202f}\x{205f}\x{3000}]"
)


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^{_B}+|{_B}+$', '', 'g')"


def query(sql: str | None = None):
    def register(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            SQL[run.__name__] = sql
        return run

    return register


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# -- files -----------------------------------------------------------------------

_SPLIT = r"lower(regexp_extract(path, '(?:^|/)\.*[^./][^/]*?(\.[^./]*)$', 1))"
_LANGUAGES = ", ".join(f"('{e}', '{l}')" for e, l in EXTENSION_LANGUAGES.items())


@query(f"""SELECT path, ext, ext IN {_in(filetypes.SUPPORTED_EXTENSIONS)} AS supported,
    ext IN {_in(EXTENSION_LANGUAGES)} AS is_code,
    CASE WHEN ext IN {_in(DOCUMENT_EXTENSIONS)} THEN 'document'
         WHEN ext IN {_in(EXTENSION_LANGUAGES)} THEN 'code' ELSE 'unknown' END AS kind,
    m.language
  FROM (SELECT path, {_SPLIT} AS ext FROM ({samples.MIXED_SQL})) d
  LEFT JOIN (VALUES {_LANGUAGES}) m(e, language) ON d.ext = m.e""")
def file_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = samples.mixed_documents(spark, sf_dir)
    return docs.select(
        "path",
        filetypes.file_extension("path").alias("ext"),
        filetypes.is_supported_file("path").alias("supported"),
        filetypes.is_code_file("path").alias("is_code"),
        filetypes.file_kind("path").alias("kind"),
        filetypes.language("path").alias("language"),
    )


@query(f"""SELECT path, n_chars FROM (SELECT *, {_SPLIT} AS ext FROM ({samples.MIXED_SQL}))
  WHERE ext IN {_in(filetypes.SUPPORTED_EXTENSIONS)}""")
def supported_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.supported_files(samples.mixed_documents(spark, sf_dir)).select("path", "n_chars")


@query(f"SELECT doc_id, {strip_sql('text')} AS text, text AS code FROM documents")
def decoded_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text files in two encodings and two line-end styles, read back."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    ends = F.when(F.col("doc_id") % 2 == 0, "\r\n").otherwise("\r")
    shown = F.replace(F.col("text"), F.lit("\n"), ends)
    latin = (F.col("doc_id") % 3 == 0) & F.col("text").rlike(r"\A[\x00-\xff]*\z")
    content = F.when(latin, F.encode(shown, "ISO-8859-1")).otherwise(F.encode(shown, "UTF-8"))
    raw = docs.select("doc_id", content.alias("content"))
    return raw.select(
        "doc_id",
        files.plain_text("content").alias("text"),
        files.code_text("content").alias("code"),
    )


@query(r"""SELECT doc_id, i - 1 AS nth,
    replace(CASE WHEN i = len(lines) THEN regexp_replace(lines[i], '\r$', '') ELSE lines[i] END, chr(13), chr(10)) AS piece
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i FROM (SELECT doc_id,
      string_split(replace(coalesce(text, ''), '. ', '.' || chr(10)), chr(10)) AS lines FROM documents))""")
def document_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents one after the other in large files, a sentence a line, read by ranges and told apart again."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")
    begin = F.concat(F.col("doc_id").cast("string"), F.lit(":"))
    lines = F.replace(F.coalesce("text", F.lit("")), F.lit(". "), F.lit(".\n"))
    folder = new_folder(spark, "documents_text")
    docs.select(F.concat(begin, F.replace(lines, F.lit("\n"), F.concat(F.lit("\r\n"), begin)))).write.text(folder)
    # a file's last piece, after its last line feed, is empty
    pieces = file_pieces(spark, folder).filter(F.col("piece") != "").select(
        "path", "n", F.substring_index("piece", ":", 1).try_cast("bigint").alias("doc_id"),
        F.expr("substring(piece, instr(piece, ':') + 1)").alias("piece"),
    )
    first = F.min("n").over(Window.partitionBy("path", "doc_id"))
    return pieces.select("doc_id", (F.col("n") - first).alias("nth"), "piece")


_CODE = [e for e in EXTENSION_LANGUAGES if e != ".html"]


def _squeezed(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


@query(f"""SELECT path, ext,
    CASE WHEN ext IN {_in(_CODE)} THEN text
      WHEN ext = '.txt' THEN {strip_sql('text')}
      WHEN ext = '.html' THEN {_squeezed("replace(replace(text, '&', '&amp;'), '<', '(')")}
      WHEN ext = '.json' AND doc_id % 3 > 0 THEN '{{' || chr(10) || '  "id": ' || doc_id || ',' || chr(10)
        || '  "source": "' || source || '",' || chr(10) || '  "tags": [' || chr(10)
        || '    "é",' || chr(10) || '    null' || chr(10) || '  ]' || chr(10) || '}}'
      WHEN ext = '.csv' AND doc_id % 3 > 0 THEN
        lpad(' id', CAST(greatest(3, length(CAST(doc_id AS VARCHAR))) AS INTEGER), ' ') || ' ' || lpad('source', 6, ' ') || ' ' || ' size' || chr(10)
        || lpad(CAST(doc_id AS VARCHAR), CAST(greatest(3, length(CAST(doc_id AS VARCHAR))) AS INTEGER), ' ') || ' ' || lpad(source, 6, ' ') || '   N/A'
    END AS text,
    CASE WHEN ext IN {_in([*_CODE, '.txt', '.html'])} THEN 'none'
      WHEN ext = '.json' AND doc_id % 3 = 0 THEN 'bad json'
      WHEN ext = '.json' THEN 'none'
      WHEN ext = '.csv' AND doc_id % 3 = 0 THEN 'Expected 1 fields, saw 2'
      WHEN ext = '.csv' THEN 'none'
      ELSE 'no way to read: ' || path END AS problem
  FROM (SELECT *, {_SPLIT} AS ext FROM ({samples.MIXED_SQL}))""")
def extracted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each kind of file read by its extension, the broken ones included."""
    docs = samples.mixed_documents(spark, sf_dir)
    ext = filetypes.split_extension("path")
    doc, source = F.col("doc_id").cast("string"), F.col("source")
    broken = F.col("doc_id") % 3 == 0
    html = F.replace(F.replace(F.col("text"), F.lit("&"), F.lit("&amp;amp;")), F.lit("<"), F.lit("("))
    content = (
        F.when(ext == ".html", F.concat(F.lit("<html><head><title>t</title></head><body><p>"), html, F.lit("</p></body></html>")))
        .when((ext == ".json") & broken, F.concat(F.lit('{"id": '), doc, F.lit("} extra")))
        .when(ext == ".json", F.concat(F.lit('{"id":'), doc, F.lit(',"source":"'), source, F.lit('","tags":["é",null]}')))
        .when((ext == ".csv") & broken, F.concat(F.lit("id\n"), doc, F.lit("\n"), doc, F.lit(","), source, F.lit("\n")))
        .when(ext == ".csv", F.concat(F.lit("id,source,size\n"), doc, F.lit(",\""), source, F.lit("\",NA\n")))
        .otherwise(F.col("text"))
    )
    found = files.extract_text(docs.select("path", F.encode(content, "UTF-8").alias("content")))
    json_error = (F.col("ext") == ".json") & F.col("error").isNotNull()
    return found.select(
        "path", "ext", "text",
        F.when(json_error, "bad json").otherwise(F.coalesce("error", F.lit("none"))).alias("problem"),
    )


@query(f"""SELECT path, length(t) AS n_chars FROM (
    SELECT path, {strip_sql('text')} AS t FROM ({samples.DOCUMENTS_SQL})) WHERE length(t) > 0""")
def nonempty_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, and blank files beside them, which count for nothing."""
    docs = samples.documents(spark, sf_dir).select("path", "text")
    blank = docs.select(F.concat(F.lit("blank/"), "path").alias("path"), F.lit(" \n\t").alias("text"))
    read = docs.unionByName(blank).select(
        "path", F.lit(".txt").alias("ext"), py_strip("text").alias("text"),
        F.lit(None).cast("string").alias("error"),
    )
    return usage.document_counts(files.documents(read))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
    '{' || chr(10) || '  "k": ' || json_extract_string(props, '$.k') || chr(10) || '}' AS pretty
  FROM events""")
def json_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = spread(table(spark, sf_dir, "events"), "event_id")
    return events.select(
        "event_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        files.pretty_json(F.encode("props", "UTF-8"))["text"].alias("pretty"),
    )


@query("""SELECT doc_id, lang, '"' || text || chr(10) || chr(10) || '" ' || source || ',' AS text, length(text) AS n FROM documents""")
def multi_line_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents as cells of CSV files, with their line feeds, quotes and commas, read by splits."""
    docs = table(spark, sf_dir, "documents")
    text = F.concat(F.lit('"'), "text", F.lit('\n\n" '), "source", F.lit(","))
    folder = new_folder(spark, "documents_csv")
    shown = docs.select("doc_id", "lang", text.alias("text"), F.length("text").cast("bigint").alias("n"))
    shown.write.csv(folder, header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return csv_files.read_csv_table(spark, folder, multi_line=True)


@query("""SELECT CAST(p_partkey AS BIGINT) AS p_partkey, p_name, p_brand, p_type, CAST(p_size AS BIGINT) AS p_size, p_retailprice FROM part
  UNION ALL SELECT p_partkey + 1234567890123456000, p_name || ' 5" wide', p_brand, NULL, -1, p_retailprice FROM part""")
def csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` written as CSV, and again with large keys, quotes and several spellings of missing; types inferred."""
    part = table(spark, sf_dir, "part").withColumn("p_partkey", F.col("p_partkey").cast("bigint"))
    token = F.element_at(
        F.array(*[F.lit(t) for t in CSV_NULL_TOKENS]),
        (F.col("p_partkey") % len(CSV_NULL_TOKENS) + 1).cast("int"),
    )
    gaps = part.withColumns({
        "p_partkey": F.col("p_partkey") + LARGE_KEY, "p_name": F.concat("p_name", F.lit(' 5" wide')),
        "p_type": token, "p_size": token,
    })
    shown = part.withColumn("p_size", F.col("p_size").cast("string")).unionByName(gaps)
    folder = new_folder(spark, "part_csv")
    shown.write.csv(folder, header=True, escape='"')
    read = csv_files.read_csv_table(spark, folder)
    return read.withColumn("p_size", F.coalesce("p_size", F.lit(-1).cast("bigint")))


@query("""SELECT source || '/doc' || doc_id || '.csv' AS path,
    lpad('size', CAST(w AS INTEGER), ' ') || ' ' || lpad(' k', 19, ' ') || chr(10)
    || lpad(size, CAST(w AS INTEGER), ' ') || ' ' || (doc_id + 1234567890123456000) || chr(10)
    || lpad('a' || chr(92) || 'nb, "c"', CAST(w AS INTEGER), ' ') || ' ' || (doc_id + 1234567890123456001) AS text
  FROM (SELECT *, greatest(10, length(size)) AS w FROM (SELECT *, source || ' 5" pipe' AS size FROM documents))""")
def quoted_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A CSV file for each document with a quote inside a bare cell, a quoted cell, and keys of 19 digits."""
    docs = table(spark, sf_dir, "documents")
    key = F.col("doc_id") + LARGE_KEY
    content = F.concat(
        F.lit("size,k\n"), "source", F.lit(' 5" pipe,'), key.cast("string"),
        F.lit('\n"a\nb, ""c""",'), (key + 1).cast("string"), F.lit("\n"),
    )
    made = docs.select(samples.document_path(F.lit(".csv")).alias("path"), F.encode(content, "UTF-8").alias("content"))
    return files.extract_text(made).select("path", "text")


# -- HTML ----------------------------------------------------------------------------

_ATTRIBUTES = r"""(?:[^>=]|=\s*(?:"[^"]*"|''[^'']*'')?)*"""
_REST = rf"(?:[\s/]{_ATTRIBUTES})?>"
_TAG = rf"<[/!?]?[A-Za-z]{_ATTRIBUTES}>"
_HIDDEN = "|".join([r"<!--.*?-->", *(rf"<{t}{_REST}.*?</{t}\s*>" for t in ("title", "script", "style"))])
_BLOCK = (
    r"</?(?:address|article|aside|blockquote|body|br|dd|details|div|dl|dt|fieldset"
    r"|figcaption|figure|footer|form|h[1-6]|header|hr|html|li|main|nav|ol|p|pre|section"
    rf"|summary|table|tbody|td|tfoot|th|thead|tr|ul){_REST}"
)


def scanned_sql(x: str) -> str:
    """A character 1 before each tag; hidden parts out."""
    return f"regexp_replace({x}, '(?is)(?:{_HIDDEN})|({_TAG})', chr(1) || '\\1', 'g')"


def scanned_text_sql(x: str) -> str:
    x = f"regexp_replace({x}, '\\s+', ' ', 'g')"
    x = f"regexp_replace({x}, '(?i)\\x01{_BLOCK}', chr(10), 'g')"
    x = f"regexp_replace({x}, '\\x01(?:{_TAG})?', '', 'g')"
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        x = f"replace({x}, '&{name};', '{char}')"
    x = f"regexp_replace({x}, '[ \\x{{a0}}]*\\n[ \\x{{a0}}\\n]*', chr(10) || chr(10), 'g')"
    return strip_sql(x)


@query(f"SELECT page_id, {scanned_text_sql(scanned_sql('html'))} AS text FROM pages")
def page_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "pages"), "page_id").select("page_id", html_text("html").alias("text"))


_TAGS = "|".join(HTML_SECTION_TAGS)


def sections_sql(pages: str) -> str:
    return f"""SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY i) - 1 AS INTEGER) AS chunk_id, chunk
  FROM (SELECT path, i, {scanned_text_sql('piece')} AS chunk
    FROM (SELECT path, unnest(string_split(v, chr(2))) AS piece,
                 unnest(range(len(string_split(v, chr(2))))) AS i
      FROM (SELECT url || '#' || page_id AS path,
              regexp_replace({scanned_sql('html')}, '(?i)(\\x01<(?:{_TAGS})[\\s/>])', chr(2) || '\\1', 'g') AS v FROM {pages})))
  WHERE chunk <> ''"""


def _page_sections(pages: DataFrame) -> DataFrame:
    raw = pages.select(
        F.concat("url", F.lit("#"), F.col("page_id").cast("string")).alias("path"),
        F.col("html").alias("text"),
    )
    return chunking.html_header_sections(raw)


@query(sections_sql("pages"))
def html_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _page_sections(spread(table(spark, sf_dir, "pages"), "page_id"))


# Before each page: signs of tags inside values, a comment inside a script, an end inside a comment.
_ODD_HEAD = (
    "<p title=\"a > b <h2>\" data-x='<script>'>odd <img alt=\"x > y\"> one</p><!-- <h1> > --><a b=c>d's</a>"
    "<script>'<!--'</script><title-bar>bar</title-bar> 1 < 2 <H3 id=\"a'b\">Three</H3>"
)
_ODD_PAGES = f"""(SELECT page_id, url, '{_ODD_HEAD.replace("'", "''")}' || html AS html FROM pages)"""


def _odd_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages"), "page_id")
    return pages.withColumn("html", F.concat(F.lit(_ODD_HEAD), "html"))


@query(f"SELECT page_id, {scanned_text_sql(scanned_sql('html'))} AS text FROM {_ODD_PAGES}")
def quoted_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with signs of tags where there are none."""
    return _odd_pages(spark, sf_dir).select("page_id", html_text("html").alias("text"))


@query(sections_sql(_ODD_PAGES))
def quoted_page_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages cut at headings."""
    return _page_sections(_odd_pages(spark, sf_dir))


# -- rows and tables to text -----------------------------------------------------------


@query(f"""SELECT path, {strip_sql("string_agg(page_text, chr(10) || chr(10) ORDER BY turn)")} AS text
  FROM (SELECT 'conv/' || conv_id || '.pdf' AS path, turn, ' ' || text || chr(10) AS page_text FROM conversations)
  GROUP BY path""")
def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn as a page, with an empty page after each."""
    turns = table(spark, sf_dir, "conversations")
    number, text = F.col("turn") * 2, F.concat(F.lit(" "), F.col("text"), F.lit("\n"))
    pages = turns.select(
        F.concat(F.lit("conv/"), F.col("conv_id").cast("string"), F.lit(".pdf")).alias("path"),
        F.inline(
            F.array(
                F.struct(number.alias("page_no"), text.alias("page_text")),
                F.struct((number + 1).alias("page_no"), F.lit("").alias("page_text")),
            )
        ),
    )
    return assemble.assemble_pages(pages)


@query(f"""WITH b AS (
    SELECT 'conv/' || conv_id || '.docx' AS path, turn * 10 AS seq,
      CASE WHEN role = 'system' THEN 0 WHEN (conv_id + turn) % 3 = 0 THEN 2 ELSE 1 END AS rank,
      CASE WHEN role = 'system' THEN '=== Header ===' WHEN (conv_id + turn) % 3 = 0 THEN '=== Table ===' END AS mark,
      CASE WHEN role <> 'system' AND (conv_id + turn) % 3 = 0
             THEN role || ' | ' || {strip_sql('text')} ELSE text END AS line
    FROM conversations)
  SELECT path, string_agg(line, chr(10) ORDER BY rank, seq) AS text
  FROM (SELECT path, rank, seq, mark AS line FROM b WHERE mark IS NOT NULL
        UNION ALL SELECT path, rank, seq + 1, line FROM b WHERE {strip_sql('line')} <> '')
  GROUP BY path""")
def block_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System turns as page headers, every third other turn as a one-row table."""
    turns = table(spark, sf_dir, "conversations")
    system = F.col("role") == "system"
    tabular = ~system & ((F.col("conv_id") + F.col("turn")) % 3 == 0)
    seq = F.col("turn") * 10
    cells = F.when(
        tabular, F.array(F.concat(F.lit(" "), F.col("role")), F.concat(F.lit("\t"), F.col("text"), F.lit("\n")))
    ).otherwise(F.array("text"))
    kind = F.when(system, "header").when(tabular, "row").otherwise("paragraph")
    mark = F.when(system, "section").when(tabular, "table")
    none = F.array(F.lit("").cast("string"))
    blocks = turns.select(
        F.concat(F.lit("conv/"), F.col("conv_id").cast("string"), F.lit(".docx")).alias("path"),
        F.inline(
            F.array(
                F.struct(seq.alias("seq"), mark.alias("kind"), none.alias("cells")),
                F.struct((seq + 1).alias("seq"), kind.alias("kind"), cells.alias("cells")),
            )
        ),
    ).filter(F.col("kind").isNotNull())
    return assemble.assemble_blocks(blocks)


@query("""SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) || ' | ' || n_name || ' | ' || n_regionkey AS line FROM nation""")
def row_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = F.array(
        F.concat(F.lit(" "), F.col("n_nationkey").cast("string")),
        F.concat("n_name", F.lit("\t")),
        F.col("n_regionkey").cast("string"),
    )
    return table(spark, sf_dir, "nation").select("n_nationkey", tables.row_line(cells).alias("line"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``part`` as one table per brand, a row of missing cells and a 19-digit key at its end, and an empty column."""
    part = table(spark, sf_dir, "part")
    columns = ["p_name", "p_type", "p_size", "p_retailprice"]
    own = part.select(
        F.col("p_brand").alias("_brand"), (F.col("p_partkey") + 1).alias("_row"),
        F.col("p_partkey").cast("bigint").alias("p_partkey"), *columns,
    )
    last = part.groupBy(F.col("p_brand").alias("_brand")).agg(F.max("p_partkey").alias("k")).select(
        "_brand", (F.col("k") + 2).alias("_row"), (F.col("k") + LARGE_KEY).alias("p_partkey"),
        *[F.lit(None).cast(part.schema[c].dataType).alias(c) for c in columns],
    )
    whole = own.unionByName(last).withColumn("p_note", F.lit(None).cast("string"))
    return tables.table_rows(whole, F.concat("_brand", F.lit(".csv")), F.lit(""), F.col("_row"))


def _cell(col: str, width: str) -> str:
    return f"lpad({col}, CAST({width} AS INTEGER), ' ')"


_PART_ROWS = f"""SELECT p_brand || '.csv' AS path, p_partkey + 1 AS row_no, CAST(p_partkey AS VARCHAR) AS k,
      p_name AS nm, p_type AS ty, p_size AS sz, CAST(p_retailprice AS VARCHAR) AS pr FROM part
    UNION ALL SELECT p_brand || '.csv', max(p_partkey) + 2, CAST(max(p_partkey) + {LARGE_KEY} AS VARCHAR), NULL, NULL, NULL, NULL
    FROM part GROUP BY p_brand"""
_PART_LINES = f"""WITH c AS ({_PART_ROWS}),
  s AS (SELECT path, max(length(split_part(pr, '.', 2))) AS d FROM c GROUP BY path),
  w AS (SELECT path, row_no, k, coalesce(nm, 'N/A') AS nm, coalesce(ty, 'N/A') AS ty, coalesce(sz || '.0', 'N/A') AS sz,
      coalesce(split_part(pr, '.', 1) || '.' || rpad(split_part(pr, '.', 2), CAST(d AS INTEGER), '0'), 'N/A') AS pr
    FROM c JOIN s USING (path)
    UNION ALL SELECT DISTINCT path, 0, ' p_partkey', 'p_name', 'p_type', ' p_size', ' p_retailprice' FROM c),
  l AS (SELECT path, max(length(k)) AS wk, max(length(nm)) AS wn, max(length(ty)) AS wt, max(length(sz)) AS ws, max(length(pr)) AS wp
    FROM w GROUP BY path)
  SELECT path, CAST(row_no AS BIGINT) AS row_no, {_cell('k', 'wk')} || ' ' || {_cell('nm', 'wn')} || ' ' || {_cell('ty', 'wt')}
    || ' ' || {_cell('sz', 'ws')} || ' ' || {_cell('pr', 'wp')}"""


@query(_PART_LINES + """ || ' ' || CASE WHEN row_no = 0 THEN ' p_note' ELSE '    N/A' END AS line
  FROM w JOIN l USING (path)""")
def table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.table_lines(_parts(spark, sf_dir)).select("path", "row_no", "line")


@query(_PART_LINES + " AS line FROM w JOIN l USING (path)")
def filled_table_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tables without their empty columns."""
    lines = tables.table_lines(_parts(spark, sf_dir), drop_empty_columns=True)
    return lines.select("path", "row_no", "line")


@query(f"""SELECT path, CAST(row_no AS BIGINT) AS row_no, 5 AS n_cells,
    k || '|' || coalesce(nm, '') || '|' || coalesce(ty, '') || '|' || coalesce(CAST(sz AS VARCHAR), '') || '|' || coalesce(pr, '') AS cells
  FROM ({_PART_ROWS}) UNION ALL
  SELECT DISTINCT p_brand || '.csv', 0, 5, 'p_partkey|p_name|p_type|p_size|p_retailprice' FROM part""")
def filled_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Their rows without the empty columns, as cells."""
    rows = tables.drop_empty_table_columns(_parts(spark, sf_dir))
    return rows.select(
        "path", "row_no", F.size("cells").alias("n_cells"),
        F.array_join("cells", "|", "").alias("cells"),
    )


@query("SELECT n_nationkey, n_name, n_regionkey FROM nation")
def drop_empty_cols(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    padded = nation.withColumn("n_note", F.lit(None).cast("string")).withColumn(
        "n_area", F.lit(None).cast("double")
    )
    return tables.drop_empty_columns(padded)


@query(f"""WITH n AS (
    SELECT 'nation' AS sheet, CAST(n_nationkey AS VARCHAR) AS a, n_name AS b, CAST(n_regionkey AS VARCHAR) AS c, n_nationkey + 1 AS row_no FROM nation
    UNION ALL SELECT 'nation', ' n_nationkey', 'n_name', ' n_regionkey', 0),
  r AS (SELECT 'region' AS sheet, CAST(r_regionkey AS VARCHAR) AS a, r_name AS b, r_regionkey + 1 AS row_no FROM region
    UNION ALL SELECT 'region', ' r_regionkey', 'r_name', 0),
  nl AS (SELECT string_agg(line, chr(10) ORDER BY row_no) AS body FROM (
    SELECT row_no, {_cell('a', '(SELECT max(length(a)) FROM n)')} || ' ' || {_cell('b', '(SELECT max(length(b)) FROM n)')}
      || ' ' || {_cell('c', '(SELECT max(length(c)) FROM n)')} AS line FROM n)),
  rl AS (SELECT string_agg(line, chr(10) ORDER BY row_no) AS body FROM (
    SELECT row_no, {_cell('a', '(SELECT max(length(a)) FROM r)')} || ' ' || {_cell('b', '(SELECT max(length(b)) FROM r)')} AS line FROM r))
  SELECT 'book.xlsx' AS path,
    chr(10) || '=== Sheet: region ===' || chr(10) || chr(10) || (SELECT body FROM rl) || chr(10) || chr(10) || chr(10)
    || chr(10) || '=== Sheet: nation ===' || chr(10) || chr(10) || (SELECT body FROM nl) || chr(10) || chr(10) AS text""")
def workbook_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    def sheet(name: str, key: str) -> DataFrame:
        rows = table(spark, sf_dir, name)
        return tables.table_rows(rows, F.lit("book.xlsx"), F.lit(name), F.col(key) + 1)

    # places in the workbook against the order of names
    nation = sheet("nation", "n_nationkey").withColumn("sheet_no", F.lit(2))
    region = sheet("region", "r_regionkey").withColumn("sheet_no", F.lit(1))
    return assemble.assemble_workbook(nation.unionByName(region)).select("path", "text")


# -- chunks ---------------------------------------------------------------------------


_MARKED = f"""WITH l AS (
    SELECT path, i, CASE WHEN i % 7 = 5 THEN '```' WHEN i % 3 = 0 THEN repeat('#', CAST(1 + i % 4 AS INTEGER)) || ' ' || line ELSE line END AS line
    FROM (SELECT source || '/doc' || doc_id || '.md' AS path, unnest(string_split(text, chr(10))) AS line,
                 unnest(range(len(string_split(text, chr(10))))) AS i FROM documents)),
  f AS (SELECT *, sum(CASE WHEN line = '```' THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY i) % 2 = 1 AS fenced FROM l),
  h AS (SELECT *, NOT fenced AND regexp_matches(line, '^[ \\t]*#{{1,3}}([ \\t]|$)') AS is_header FROM f),
  s AS (SELECT *, sum(CASE WHEN is_header THEN 1 ELSE 0 END) OVER (PARTITION BY path ORDER BY i) AS section FROM h),
  g AS (SELECT path, section, {strip_sql("max(CASE WHEN is_header THEN line END)")} AS header,
      {strip_sql("coalesce(string_agg(CASE WHEN NOT is_header THEN line END, chr(10) ORDER BY i), '')")} AS chunk
    FROM s GROUP BY path, section)"""
# The same of the documents as they are.
MARKDOWN_SQL = _MARKED.replace(
    "CASE WHEN i % 7 = 5 THEN '```' WHEN i % 3 = 0 THEN repeat('#', CAST(1 + i % 4 AS INTEGER)) || ' ' || line ELSE line END AS line", "line"
)
_DENSE_ID = "CAST(row_number() OVER (PARTITION BY path ORDER BY section) - 1 AS INTEGER) AS chunk_id"


@query(f"SELECT path, chunk_id, chunk FROM ({samples.WINDOWS_SQL})")
def char_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.char_windows(samples.documents(spark, sf_dir))


@query(f"""SELECT CASE ext WHEN '.html' THEN 'html' WHEN '.md' THEN 'markdown' ELSE
      CASE WHEN ext IN {_in(EXTENSION_LANGUAGES)} THEN 'code' ELSE 'default' END END AS splitter,
    count(*) AS n_files, CAST(sum(length(text)) AS BIGINT) AS n_chars
  FROM (SELECT *, {_SPLIT} AS ext FROM ({samples.MIXED_SQL})) GROUP BY 1""")
def splitter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = samples.mixed_documents(spark, sf_dir)
    return docs.groupBy(filetypes.splitter("path").alias("splitter")).agg(
        F.count("*").alias("n_files"), F.sum(F.length("text")).cast("bigint").alias("n_chars")
    )


def _marked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with every third line made a header and every seventh a fence."""
    docs = spread(table(spark, sf_dir, "documents"), "doc_id")

    def mark(line, i):
        level = F.repeat(F.lit("#"), (i % 4 + 1).cast("int"))
        return (
            F.when(i % 7 == 5, "```")
            .when(i % 3 == 0, F.concat(level, F.lit(" "), line))
            .otherwise(line)
        )

    return docs.select(
        samples.document_path(F.lit(".md")).alias("path"),
        F.array_join(F.transform(F.split("text", "\n"), mark), "\n").alias("text"),
    )


@query(f"{_MARKED} SELECT path, header, {_DENSE_ID}, chunk FROM g WHERE chunk <> ''")
def md_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.markdown_sections(_marked_documents(spark, sf_dir))


def _latest(level: int) -> str:
    frame = "OVER (PARTITION BY path ORDER BY section)"
    return f"coalesce(max(CASE WHEN level = {level} THEN section END) {frame}, -1) AS s{level}"


_TITLE = strip_sql("regexp_replace(header, '^#+', '')")


@query(f"""{_MARKED},
  p AS (SELECT *, length(regexp_extract(header, '^#+')) AS level, {_TITLE} AS title FROM g),
  q AS (SELECT *, {_latest(1)}, {_latest(2)}, {_latest(3)} FROM p)
  SELECT q.path, a.title AS h1, b.title AS h2, c.title AS h3,
    {_DENSE_ID.replace('path', 'q.path').replace('BY section', 'BY q.section')}, q.chunk
  FROM q LEFT JOIN p a ON a.path = q.path AND a.section = s1
  LEFT JOIN p b ON b.path = q.path AND b.section = s2 AND s2 > s1
  LEFT JOIN p c ON c.path = q.path AND c.section = s3 AND s3 > s1 AND s3 > s2
  WHERE q.chunk <> ''""")
def md_header_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.markdown_header_paths(_marked_documents(spark, sf_dir))


def chunks_sql(source: str, size: int = CHUNK_SIZE, over: int = CHUNK_OVERLAP) -> str:
    """Recursive chunks of ``source`` (path, text, seps: patterns, coarsest first).

    ``work`` cuts spans at the next pattern that occurs, into runs of short pieces, long
    pieces to cut again, and leaves past the last pattern; ``pack`` walks along a run.
    """
    return f"""WITH RECURSIVE src AS MATERIALIZED ({source}),
  work AS (
    SELECT path, CAST(0 AS BIGINT) AS s, CAST(length(text) AS BIGINT) AS e, CAST(0 AS BIGINT) AS lvl, 'span' AS kind, [CAST(0 AS BIGINT)] AS edges
    FROM src WHERE length(text) > {size}
    UNION ALL
    SELECT path, min(a) AS s, max(b) AS e, any_value(lvl) + 1 AS lvl,
      CASE WHEN any_value(done) THEN 'leaf' WHEN bool_or(big) THEN 'span' ELSE 'run' END AS kind,
      [min(a)] || list(b ORDER BY b) AS edges
    FROM (
      SELECT *, b - a >= {size} OR n = 1 AS big,
        sum(CASE WHEN b - a >= {size} OR n = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY path, s ORDER BY a) AS run
      FROM (
        SELECT path, s, lvl, done, n, s + sum(length(piece)) OVER (PARTITION BY path, s ORDER BY i) - length(piece) AS a,
          s + sum(length(piece)) OVER (PARTITION BY path, s ORDER BY i) AS b
        FROM (
          SELECT path, s, lvl, done, len(m) AS n, unnest(m) AS piece, generate_subscripts(m, 1) AS i
          FROM (
            SELECT w.path, w.s, w.lvl, w.lvl >= len(seps) AS done,
              CASE WHEN w.lvl >= len(seps) THEN [substring(text, w.s + 1, w.e - w.s)]
                ELSE string_split(regexp_replace(substring(text, w.s + 1, w.e - w.s), '(' || seps[w.lvl + 1] || ')', chr(1) || '\\1', 'g'), chr(1)) END AS m
            FROM work w JOIN src USING (path) WHERE w.kind = 'span')))
      WHERE b > a)
    GROUP BY path, s, run, big),
  pack AS (
    SELECT path, edges, CAST(1 AS BIGINT) AS f, CAST(len(list_filter(edges, lambda x: x <= edges[1] + {size})) AS BIGINT) AS t FROM work WHERE kind = 'run'
    UNION ALL
    SELECT path, edges, g, CAST(len(list_filter(edges, lambda x: x <= edges[g] + {size})) AS BIGINT) FROM (
      SELECT path, edges, greatest(f, 1 + len(list_filter(edges, lambda x: x < edges[t] - {over})), 1 + len(list_filter(edges, lambda x: x < edges[t + 1] - {size}))) AS g
      FROM pack WHERE t < len(edges))),
  cut AS (
    SELECT path, edges[f] AS s, edges[t] AS e FROM pack
    UNION ALL SELECT path, s + {size - over} * i, least(e, s + {size - over} * i + {size}) FROM (
      SELECT *, unnest(range(1 + CAST(greatest(0, ceil((e - s - {size}) / {size - over}.0)) AS BIGINT))) AS i FROM work WHERE kind = 'leaf')
    UNION ALL SELECT path, 0, length(text) FROM src WHERE length(text) <= {size})
  SELECT path, CAST(row_number() OVER (PARTITION BY path ORDER BY s) - 1 AS INTEGER) AS chunk_id, chunk
  FROM (SELECT path, s, {strip_sql('substring(text, s + 1, e - s)')} AS chunk FROM cut JOIN src USING (path)) WHERE chunk <> ''"""



def _patterns(language: str | None) -> str:
    return "[" + ", ".join("'" + p.replace("'", "''") + "'" for p in chunking.separators_for(language) if p) + "]"


_BY_LANGUAGE = "CASE ext " + " ".join(
    f"WHEN '{e}' THEN {_patterns(lang)}" for e, lang in EXTENSION_LANGUAGES.items()
) + f" ELSE {_patterns(None)} END"
_MIXED_EXT = f"(SELECT *, {_SPLIT} AS ext FROM ({samples.MIXED_SQL}))"


@query(chunks_sql(f"SELECT path, text, {_patterns(None)} AS seps FROM ({samples.DOCUMENTS_SQL})"))
def recursive_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunking.recursive_chunks(samples.documents(spark, sf_dir))


@query(chunks_sql(f"""SELECT path, text, {_BY_LANGUAGE} AS seps FROM {_MIXED_EXT}
    WHERE ext IN {_in([e for e in EXTENSION_LANGUAGES if e not in ('.html', '.md')])}"""))
def code_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = samples.mixed_documents(spark, sf_dir)
    return chunking.code_chunks(docs.filter(filetypes.splitter("path") == "code"))


_MD_DOCUMENTS = f"(SELECT * FROM documents WHERE doc_id % {len(samples.EXTENSIONS)} = {samples.EXTENSIONS.index('.md')})"


@query(f"""SELECT * FROM ({chunks_sql(f"SELECT path, text, {_BY_LANGUAGE} AS seps FROM {_MIXED_EXT} WHERE ext NOT IN ('.html', '.md')")})
  UNION ALL SELECT path, CAST(0 AS INTEGER), text FROM {_MIXED_EXT} WHERE ext = '.html' AND text <> ''
  UNION ALL SELECT * FROM ({MARKDOWN_SQL.replace('FROM documents', 'FROM ' + _MD_DOCUMENTS)} SELECT path, {_DENSE_ID}, chunk FROM g WHERE chunk <> '')""")
def mixed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document through the splitter of its extension."""
    return chunking.split_documents(samples.mixed_documents(spark, sf_dir), html_is_raw=False)


def _kept_promises(chunks: DataFrame) -> DataFrame:
    """Per document, what must hold for its chunks; ``chunks`` carries the text."""
    stripped = py_strip("text")
    facts = chunks.groupBy("path").agg(
        F.bool_and(F.length("chunk") <= CHUNK_SIZE).alias("none_too_long"),
        F.bool_and(F.contains("text", "chunk")).alias("all_from_text"),
        F.bool_or((F.col("chunk_id") == 0) & F.startswith(stripped, F.col("chunk"))).alias("first_starts_it"),
        F.bool_or(F.endswith(stripped, F.col("chunk"))).alias("one_ends_it"),
        F.max((F.length(F.col("text")) > CHUNK_SIZE) | (F.col("chunk") == stripped)).alias("short_is_one"),
        F.count("*").alias("n"),
        F.max(F.length("text")).alias("n_chars"),
        F.sum(F.length(F.regexp_replace("chunk", r"\s", ""))).alias("n_shown"),
        F.max(F.length(F.regexp_replace("text", r"\s", ""))).alias("n_text"),
    )
    return facts.select(
        "path", "none_too_long", "all_from_text", "first_starts_it", "one_ends_it", "short_is_one",
        (F.col("n_shown") >= F.col("n_text")).alias("nothing_lost"),
        (F.col("n") >= F.ceil(F.col("n_chars") / CHUNK_SIZE)).alias("enough_chunks"),
    )


_PROMISES = """true AS none_too_long, true AS all_from_text, true AS first_starts_it, true AS one_ends_it,
    true AS short_is_one, true AS nothing_lost, true AS enough_chunks"""


@query(f"SELECT path, {_PROMISES} FROM ({samples.DOCUMENTS_SQL}) WHERE {strip_sql('text')} <> ''")
def recursive_chunk_promises(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = samples.documents(spark, sf_dir)
    return _kept_promises(chunking.recursive_chunks(docs, keep=["text"]))


@query(f"""SELECT path, {_PROMISES} FROM (SELECT *, {_SPLIT} AS ext FROM ({samples.MIXED_SQL}))
  WHERE ext IN {_in([e for e in EXTENSION_LANGUAGES if e not in ('.html', '.md')])} AND {strip_sql('text')} <> ''""")
def code_chunk_promises(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = samples.mixed_documents(spark, sf_dir)
    code = docs.filter(filetypes.splitter("path") == "code")
    return _kept_promises(chunking.code_chunks(code, keep=["text"]))


@query(f"SELECT doc_id, {strip_sql('x')} AS stripped, length(x) AS n_before FROM (SELECT doc_id, chr(160) || chr(9) || text || chr(12288) || chr(10) AS x FROM documents)")
def stripped_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    padded = F.concat(F.lit("\xa0\t"), F.col("text"), F.lit("　\n"))
    return docs.select("doc_id", py_strip(padded).alias("stripped"), F.length(padded).cast("bigint").alias("n_before"))
