from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from corpusqa import mine_documents
from corpusqa.operators.chunking import split_documents
from corpusqa.sinks.json_rows import run_stamp, save_rows, stamped_name
from corpusqa.sources import files, shared
from corpusqa.sources.files import decode_rows, list_files, read_texts
from corpusqa.streaming.incremental import new_files, save_new

FILES = {
    "a.TXT": b" hello\r\nworld \n",
    "b.py": b"  x = 1\n",
    "c.json": '{"k":[1,"é"]}'.encode(),
    "d.csv": b"a,b\n1,x\n",
    "e.html": b"<html><head><title>t</title></head><body><h1>H</h1><p>p</p></body></html>",
    "f.pdf": b"%PDF page one|page two",
    "g.json": b"{broken",
    "m.json": b'["\\ud800"]',
    "h.txt": b" \n ",
    "i.csv": b"\n",
    "j.zzz": b"not supported",
    "k.md": b"# H\nbody\n## G\nmore",
    "l.txt": b"caf\xe9",
}


@pytest.fixture
def folder(tmp_path):
    source = tmp_path / "source"
    (source / "sub").mkdir(parents=True)
    for name, content in FILES.items():
        (source / name).write_bytes(content)
    (source / "sub" / "deep.txt").write_text("not listed")
    return str(source)


def by_name(rows):
    return {r.path.rpartition("/")[2]: r for r in rows}


def test_listing(spark, folder):
    listed = by_name(list_files(spark, folder).select("path").collect())
    assert set(listed) == set(FILES) - {"j.zzz"}


def test_texts_of_a_directory(spark, folder):
    got = by_name(read_texts(spark, folder).collect())
    text = {n: r.text for n, r in got.items() if r.error is None}
    assert text == {
        "a.TXT": "hello\nworld", "b.py": "  x = 1\n", "d.csv": " a b\n 1 x", "e.html": "H\n\np",
        "c.json": json.dumps({"k": [1, "é"]}, indent=2, ensure_ascii=False), "h.txt": "",
        "k.md": "# H\nbody\n## G\nmore", "l.txt": "café",
    }
    assert set(got) - set(text) == {"f.pdf", "g.json", "m.json", "i.csv"}
    assert "no way to read" in got["f.pdf"].error
    all_rows = read_texts(spark, folder)
    kept, out = by_name(files.documents(all_rows).collect()), by_name(files.rejects(all_rows).collect())
    assert set(kept) | set(out) == set(got) and not set(kept) & set(out)
    assert out["h.txt"].reason == "no text"


def test_every_supported_name_is_a_document_or_a_reject(spark, tmp_path):
    names = ["_x.txt", ".y.txt", ".h.py", "empty.txt", "empty.csv", "empty.json", "full.txt", "other.zzz"]
    for name in names:
        (tmp_path / name).write_text("text" if name in ("full.txt", "_x.txt", ".y.txt") else "")
    rows = read_texts(spark, str(tmp_path))
    kept, out = by_name(files.documents(rows).collect()), by_name(files.rejects(rows).collect())
    assert set(kept) == {"full.txt"}
    assert {n: r.reason for n, r in out.items()} == {
        "_x.txt": "hidden file", ".y.txt": "hidden file", ".h.py": "hidden file",
        "empty.txt": "no text", "empty.csv": "no text", "empty.json": "no text",
    }


def test_streams_with_one_run_id_keep_apart(spark, tmp_path):
    from corpusqa.streaming.incremental import save_new

    for n in ("one", "two"):
        spark.range(3).selectExpr("id", f"'{n}' AS s").write.parquet(str(tmp_path / n))
        stream = spark.readStream.schema("id bigint, s string").parquet(str(tmp_path / n))
        save_new(stream, lambda batch: batch, str(tmp_path / "out"), str(tmp_path / f"progress_{n}"), "run")
    rows = spark.read.json(f"{tmp_path}/out/run_id=*/batch_id=*").collect()
    assert sorted((r.s, r.id) for r in rows) == [(s, i) for s in ("one", "two") for i in range(3)]


def test_decoders(spark, folder):
    def pdf(content: bytes) -> str:
        return content.decode().removeprefix("%PDF ")

    def failing(content: bytes) -> str:
        raise ValueError("cannot read")

    got = by_name(read_texts(spark, folder, decoders={".pdf": pdf, ".csv": failing}).collect())
    assert got["f.pdf"].text == "page one|page two"
    assert (got["d.csv"].text, got["d.csv"].error) == (None, "cannot read")

    def pages(content: bytes):
        if not content.startswith(b"%PDF"):
            raise ValueError("no pages")
        return list(enumerate(content.decode()[5:].split("|"), 1))

    listed = list_files(spark, folder, [".pdf", ".md"])
    rows = decode_rows(listed, pages, "page_no int, page_text string").collect()
    assert sorted((r.path[-5:], r.page_no, r.page_text, r.error) for r in rows if r.error is None) == [
        ("f.pdf", 1, "page one", None), ("f.pdf", 2, "page two", None),
    ]
    assert [r.error for r in rows if r.error] == ["no pages"]


def model(prompt: str) -> str:
    if prompt.startswith("You are"):
        return "INCORRECT made up"
    if "café" in prompt:
        raise RuntimeError("busy")
    return json.dumps([{"instruction": "Q", "input": "", "output": prompt.rpartition("Text: ")[2]}])


def test_mine_documents(spark, folder, tmp_path):
    output = str(tmp_path / "out")
    mined, place = mine_documents(
        spark, folder, model, output=output, verify=True, include_verification=True
    )
    saved = spark.read.json(place)
    assert saved.count() == mined.rows.count() == 7
    assert {tuple(r.verification) for r in saved.collect()} == {("made up", "INCORRECT")}
    assert {r.output for r in saved.collect()} >= {"hello\nworld", "body", "more", "H\n\np"}
    stages = {(r.path.rpartition("/")[2], r.stage) for r in mined.rejects.collect()}
    assert stages == {
        ("f.pdf", "extract"), ("g.json", "extract"), ("m.json", "extract"), ("h.txt", "extract"), ("i.csv", "extract"), ("l.txt", "call"),
    }
    summary = mined.summary.first()
    assert summary.total_input_tokens > 0 and summary.total_verification_tokens > 0
    again, other = mine_documents(spark, folder, model, output=output)
    assert other != place and spark.read.json(place).count() == 7
    assert set(again.rows.columns) == {"instruction", "input", "output"}


def test_saving_appends_by_run(spark, tmp_path):
    pairs = spark.createDataFrame([("q", "", "a", 1)], "instruction string, input string, output string, extra int")
    for run in ["one", "two", "two"]:
        save_rows(pairs, str(tmp_path / "rows"), run)
    got = spark.read.json(str(tmp_path / "rows"))
    assert {(r.run_id, r["count"]) for r in got.groupBy("run_id").count().collect()} == {("one", 1), ("two", 2)}
    assert set(got.columns) == {"instruction", "input", "output", "run_id"}


def test_stamped_names():
    stamp = run_stamp(datetime(2024, 1, 2, 3, 4, 5, 6))
    assert stamp == "20240102_030405_000006"
    assert stamped_name("out/set.json", stamp) == f"out/set_{stamp}.json"
    assert stamped_name("set", stamp) == f"set_{stamp}"


def test_only_new_files_are_processed(spark, folder, tmp_path):
    output, checkpoint = str(tmp_path / "rows"), str(tmp_path / "progress")

    def process(batch):
        chunks = split_documents(files.documents(files.extract_text(batch)))
        return chunks.select("path", "chunk_id", "chunk")

    def run():
        save_new(new_files(spark, folder, files_per_batch=4), process, output, checkpoint, "r")
        rows = spark.read.json(f"{output}/run_id=*/batch_id=*").collect()
        return sorted((r.path.rpartition("/")[2], r.chunk_id) for r in rows)

    first = run()
    assert {p for p, _ in first} == {"a.TXT", "b.py", "c.json", "d.csv", "e.html", "k.md", "l.txt"}
    assert run() == first
    with open(f"{folder}/new.txt", "w") as f:
        f.write("later")
    assert run() == sorted([*first, ("new.txt", 0)])


def test_shared_folder_comes_from_the_session(spark, monkeypatch):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default=None):
            return self.value if key == "spark.checkpoint.dir" else default

    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        def __init__(self, value):
            self.conf, self.sparkContext = Conf(value), Context()

    assert shared.shared_dir(Session("hdfs://shared/dir/")) == "hdfs://shared/dir"
    with pytest.raises(ValueError):
        shared.shared_dir(Session(None))


def test_written_keeps_rows_and_schema(spark):
    df = spark.range(10).select("id", F.array(F.lit("x")).alias("a"), F.lit(None).cast("string").alias("n"))
    back = shared.written(df, "t")
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(back.collect()) == sorted(df.collect())


def test_functions_travel_with_the_plan():
    from pyspark import cloudpickle

    assert "corpusqa" in cloudpickle.list_registry_pickle_by_value()


def test_stream_files_follow_the_rows(spark, monkeypatch):
    from corpusqa.plans import queries_model

    folders = {}

    def folder(session, name):
        folders[name] = shared.new_folder(session, name)
        return folders[name]

    monkeypatch.setattr(queries_model, "new_folder", folder)
    monkeypatch.setattr(queries_model, "FILE_ROWS", 20)
    rows = queries_model.incremental_rows(spark, "/root/testdata/sf0.001").count()
    docs = spark.read.parquet(folders["documents"]).groupBy(F.input_file_name()).count()
    sizes = [r["count"] for r in docs.collect()]
    assert sum(sizes) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count() and max(sizes) <= 40
    batches = spark.read.json(folders["rows"] + "/run_id=check/batch_id=*").groupBy(F.input_file_name()).count()
    names = {r[0].split("/")[-2] for r in batches.collect()}
    assert len(names) == queries_model.BATCHES
    monkeypatch.undo()
    assert rows == queries_model.incremental_rows(spark, "/root/testdata/sf0.001").count()
