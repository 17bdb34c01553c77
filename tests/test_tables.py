from __future__ import annotations

import csv
import io
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusqa.operators import assemble, tables
from corpusqa.sources import csv_records
from corpusqa.sources.csv_files import csv_text, read_csv_table

CSV_FILES = [
    "a,b\n1,x\n22,yyy\n",
    "a,b,c\n1,1.5,True\n,2.25,False\n300,,True\n",
    'n,t\n1,"he said ""hi"", ok"\n2,"two\nlines"\n',
    "a,a,,d\nNA,1e3,x,\n5,-2.125,NULL,\n",
    "x\n1.123456789\n2\n",
    "h1,h2\n",
    "q,w\n1\n2,3\n",
    "n_name,p\nNATION_0,900.0\nN,12345.678\n",
    "a,b\n007,+5\n 8,6\n",
    "a,b\ntrue,1\nFalse,0.5\n",
    "long column name,é\nx,ü\n\n\ny,z\n",
    "big,gap,small\n1234567890.25,12345678901,0.0000001\n1.5,,1\n-3,7,2\n",
    "long,e\n1234567.125,1e300\n2.5,-2\n",
    "boolean,other boolean\ntrue,False\n,True\n",
    "hash\n9527e33\n12e3\nab\n",
    "mixed,flag\n1,true\nx,\n2.5,false\n",
    'size,n\n5" pipe,1\n6" pipe,2\n',
    'size,n\n5" pipe,1\n6 pipe,2\n',
    'a,b\n"x"y,1\n"q ""z"" w"v,2\n',
    "id,k\n1234567890123456789,1\n1234567890123456788,2\n",
    "id,k\n18446744073709551615,1\n1,2\n",
    "id,k\n123456789012345678901234567890,1\n5,2\n",
    "a,a.1,a,a\n1,2,3,4\n",
    "\ufeffa,b\n1,2\n",
    'a,b\n"",x\n"1",y\n',
    "a,b\n,\n1,2\n",
    "a\nx y,\n".replace(",", ""),
]


def printed(text: str, drop: bool = False) -> str:
    frame = pd.read_csv(io.StringIO(text))
    if drop:
        frame = frame.dropna(axis=1, how="all")
    return frame.to_string(index=False, na_rep="N/A")


@pytest.mark.parametrize("drop", [False, True])
def test_csv_text_prints_as_pandas_does(spark, drop):
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(CSV_FILES)], "path string, text string")
    got = {r.path: (r.text, r.error) for r in csv_text(df, drop).collect()}
    # A table without rows keeps its columns.
    want = {
        str(i): (printed(c, drop and c != "h1,h2\n"), None) for i, c in enumerate(CSV_FILES)
    }
    assert got == want


def test_csv_quote_never_closed_is_an_error(spark):
    df = spark.createDataFrame([("a", 'x,y\n1,"2\n3,4\n'), ("b", "\n \n")], "path string, text string")
    got = {r.path: (r.text, r.error) for r in csv_text(df).collect()}
    assert got == {"a": (None, "a quote is never closed"), "b": (None, "No columns to parse from file")}


def test_csv_rows_and_text_agree(spark):
    df = spark.createDataFrame([(str(i), c) for i, c in enumerate(CSV_FILES)], "path string, text string")
    lines = tables.table_lines(tables.csv_rows(df))
    folded = {r.path: r.text for r in assemble.fold_lines(lines, ["path"], "row_no").collect()}
    assert folded == {r.path: r.text for r in csv_text(df).collect()}


def test_read_csv_table_keeps_large_numbers_and_other_encodings(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("\ufeffid,big,word\n1234567890123456789,18446744073709551615,5\n1234567890123456788,1,6".encode())
    df = read_csv_table(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["id", "big", "word"]
    assert sorted(map(tuple, df.collect())) == [(1234567890123456788, 1, 6), (1234567890123456789, 18446744073709551615, 5)]
    (tmp_path / "b.csv").write_bytes("w,n\ncafé,123456789012345678901234567890\nx,1\n".encode("latin-1"))
    assert sorted(map(tuple, read_csv_table(spark, str(tmp_path / "b.csv")).collect())) == [("café", "123456789012345678901234567890"), ("x", "1")]


def test_csv_record_longer_than_header_is_an_error(spark):
    df = spark.createDataFrame([("a", "x,y\n1,2\n1,2,3\n"), ("b", "x\n1\n")], "path string, text string")
    got = {r.path: (r.text, r.error) for r in csv_text(df).collect()}
    assert got == {"a": (None, "Expected 2 fields, saw 3"), "b": (" x\n 1", None)}


def test_read_csv_table(spark, tmp_path):
    (tmp_path / "a.csv").write_text("i,d,b,s,e\n1,1.5,true,x,\n,NA,False,NULL,n/a\n-3,2,TRUE,007x,nan\n")
    df = read_csv_table(spark, str(tmp_path))
    assert [f.dataType.simpleString() for f in df.schema] == ["bigint", "double", "boolean", "string", "string"]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(
        [(1, 1.5, True, "x", None), (None, None, False, None, None), (-3, 2.0, True, "007x", None)], key=str
    )
    given = read_csv_table(spark, str(tmp_path), schema="i int, d double, b boolean, s string, e string")
    assert given.schema["i"].dataType.simpleString() == "int"
    assert tables.drop_empty_columns(df).columns == ["i", "d", "b", "s"]


def test_row_line(spark):
    rows = [(0, [" a ", "b\t"]), (1, ["", " "]), (2, [" "]), (3, ["x", None])]
    df = spark.createDataFrame(rows, "i int, cells array<string>")
    got = [r[0] for r in df.orderBy("i").select(tables.row_line("cells")).collect()]
    assert got == ["a | b", " | ", None, "x | "]


def test_pages(spark):
    rows = [("a", 2, "two "), ("a", 1, " one"), ("a", 3, ""), ("b", 1, ""), ("a", 4, "four\n")]
    df = spark.createDataFrame(rows, "path string, page_no int, page_text string")
    assert [tuple(r) for r in assemble.assemble_pages(df).collect()] == [("a", "one\n\ntwo \n\nfour")]


def test_a_document_of_many_rows_is_one_text(spark):
    pages = spark.range(30_000).select(
        F.lit("a").alias("path"), F.col("id").alias("page_no"), F.concat(F.lit(" p"), "id", F.lit("\n")).alias("page_text")
    )
    want = "\n\n".join(f" p{i}\n" for i in range(30_000)).strip()
    assert [tuple(r) for r in assemble.assemble_pages(pages.repartition(7)).collect()] == [("a", want)]
    kind = F.when(F.col("id") == 150_000, "table").when(F.col("id") > 299_990, "paragraph").otherwise("row")
    blocks = spark.range(300_000).select(
        F.lit("a").alias("path"), F.col("id").alias("seq"), kind.alias("kind"), F.array(F.col("id").cast("string")).alias("cells")
    )
    text = assemble.assemble_blocks(blocks).first().text.split("\n")
    rows = [str(i) for i in range(299_991)]
    rows[150_000] = "=== Table ==="
    assert text == [str(i) for i in range(299_991, 300_000)] + rows


def test_blocks(spark):
    rows = [
        ("a", 0, "paragraph", ["first"]), ("a", 1, "table", [""]), ("a", 2, "row", [" x", "y "]),
        ("a", 3, "paragraph", [" "]), ("a", 4, "paragraph", ["second "]), ("a", 5, "section", [""]),
        ("a", 6, "header", ["  "]), ("a", 7, "row", [""]), ("b", 0, "paragraph", [""]),
    ]
    df = spark.createDataFrame(rows, "path string, seq int, kind string, cells array<string>")
    got = {r.path: r.text for r in assemble.assemble_blocks(df).collect()}
    assert got == {"a": "=== Header ===\nfirst\nsecond \n=== Table ===\nx | y", "b": ""}


def test_workbook(spark):
    frames = {"One": pd.DataFrame({"a": [1, 22], "b": ["x", float("nan")]}), "Two": pd.DataFrame({"c": [1.5]})}
    rows = spark.createDataFrame(
        [
            ("w", "One", 0, ["a", "b"]), ("w", "One", 1, ["1", "x"]), ("w", "One", 2, ["22", None]),
            ("w", "Two", 0, ["c"]), ("w", "Two", 1, ["1.5"]),
        ],
        "path string, sheet string, row_no bigint, cells array<string>",
    )
    parts = []
    for name, frame in frames.items():
        parts += [f"\n=== Sheet: {name} ===\n", frame.to_string(index=False, na_rep="N/A"), "\n"]
    assert [r.text for r in assemble.assemble_workbook(rows).collect()] == ["\n".join(parts)]
    placed = rows.withColumn("sheet_no", F.when(F.col("sheet") == "One", 2).otherwise(1))
    turned = "\n".join(parts[3:] + parts[:3])
    assert [tuple(r) for r in assemble.assemble_workbook(placed).collect()] == [("w", turned, None)]
    long = rows.unionByName(spark.createDataFrame([("w", "Two", 2, ["1", "2"])], rows.schema))
    assert [tuple(r) for r in assemble.assemble_workbook(long).collect()] == [("w", None, "Expected 1 fields, saw 2")]


def test_table_of_one_hot_path(spark):
    df = spark.range(0, 5000).select(
        F.col("id").alias("n"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v")
    )
    rows = tables.table_rows(df, F.lit("hot"), F.lit(""), F.col("n") + 1)
    lines = [r.line for r in tables.table_lines(rows).orderBy("row_no").collect()]
    assert "\n".join(lines) == df.toPandas().to_string(index=False)


ODD_CELLS = ["", "a", "a b", 'say "x"', '"', '""', "x,y", "line\nbreak", "\n", '\n"\n', 'q"\n,"z', ",", "5\" pipe", "é\r\nü", "long " * 40]


@pytest.mark.parametrize("split", [16, 61, 500, 1 << 20])
def test_multi_line_csv_is_equal_for_any_split(spark, tmp_path, split):
    rng = random.Random(split)
    want = []
    for name in ("a", "b"):
        rows = [[rng.choice(ODD_CELLS) for _ in range(3)] for _ in range(120)]
        with open(tmp_path / f"{name}.csv", "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file, lineterminator="\r\n" if name == "b" else "\n")
            writer.writerow(["k", "l\nm", 'n"'])
            writer.writerows([[f"{name}{i}", *r[:2]] for i, r in enumerate(rows)])
            if name == "a":
                file.write('\n\nbare,5" x,y"z\n')
        want += [(f"{name}{i}", *[c.replace("\r\n", "\n") or None for c in r[:2]]) for i, r in enumerate(rows)]
    want.append(("bare", '5" x', 'y"z'))
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", 1)
    try:
        got = read_csv_table(spark, str(tmp_path), multi_line=True)
        assert got.columns == ["k", "l\nm", 'n"']
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
        splits = csv_records.csv_lines(spark, str(tmp_path)).select("path", "split").distinct().count()
        assert splits > 20 or split > 100
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
        spark.conf.set("spark.sql.files.openCostInBytes", kept[1])


def test_lines_that_change_the_state(spark):
    def ends_inside(line, inside):
        quoted, fresh, i = inside, not inside, 0
        while i < len(line):
            c = line[i]
            if quoted:
                if c == '"' and line[i + 1 : i + 2] == '"':
                    i += 1
                elif c == '"':
                    quoted = False
            elif c == "," :
                fresh, i = True, i + 1
                continue
            elif c == '"' and fresh:
                quoted = True
            fresh = False
            i += 1
        return quoted

    rng = random.Random(4)
    lines = ["".join(rng.choice('",a ') for _ in range(rng.randrange(9))) for _ in range(3000)] + ['"' + "x\"\"" * 20_000]
    frame = spark.createDataFrame([(x,) for x in lines], "v string")
    got = frame.select("v", *[F.col("v").rlike(csv_records.ENDS_INSIDE[s]).alias(f"s{s}") for s in (0, 1)]).collect()
    for r in got:
        assert (r.s0, r.s1) == (ends_inside(r.v, False), ends_inside(r.v, True)), r.v[:20]
