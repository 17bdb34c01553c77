"""The pipeline's stages: columns, decisions, odd rows; and the registered queries of this subpackage."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from corpusqa.llm import queries
from tests.check_sql import difference, duck
from tests.llm import odd
from tests.llm.test_operators import brute_components, brute_fingerprint, same

SF_DIR = "/root/testdata/sf0.001"


def test_stages_are_named():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "SimHash near-dedup", "benchmark decontamination", "packing",
    ]
    assert entry.queries()["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("number", range(4))
def test_stage_keeps_columns_and_takes_odd_rows(spark, number):
    stage = corpus_pipeline.STAGES[number][1]
    docs = odd.table(spark)
    out = stage(spark, docs, SF_DIR)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert 0 < out.count() <= docs.count()
    assert stage(spark, odd.table(spark, []), SF_DIR).count() == 0


def test_pipeline_is_its_stages(spark):
    """Stage by stage on the smallest tables: near copies by brute force, the rest by the operators' own tests."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for n, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        kept = stage(spark, docs, SF_DIR).cache()
        if n == 2:
            rows = [(r.doc_id, brute_fingerprint(r.text)) for r in docs.collect()]
            label = brute_components([p for _, p in rows], 3)
            least = {}
            for d, p in rows:
                least[label[p]] = min(least.get(label[p], d), d)
            assert {r.doc_id for r in kept.collect()} == set(least.values())
        docs = kept
    pieces = corpus_pipeline.run(spark, SF_DIR).collect()
    want = queries.packed_pieces(docs).collect()
    tokens = lambda rows: sorted({(r.doc_id, r.doc_tokens) for r in rows})
    assert tokens(pieces) == tokens(want)
    assert sum(r.length for r in pieces) == sum(n for _, n in tokens(want))
    same([(r.doc_id,) for r in docs.collect()], [(d,) for d, _ in tokens(want)])


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    assert difference(spark, duck(SF_DIR), name, queries.QUERIES[name], queries.SQL[name], SF_DIR) is None
