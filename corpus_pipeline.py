"""The documents of a training run in five stages, each an operator over what the stage before kept.

``run`` applies the stages to ``documents``. Between stages the rows are written as
Parquet to the shared folder and read again, so a lost executor costs one stage's
work at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusqa.llm import decontaminate, linededup, simhash, toxicity
from corpusqa.llm.common import table
from corpusqa.llm.queries import packed_pieces
from corpusqa.sources.shared import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.7."""
    return toxicity.kept_rows(docs, table(spark, sf_dir, "labels"))


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources share."""
    return linededup.without_boilerplate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of least id, of each group of near copies."""
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no more than traces of benchmark passages."""
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids in sequences."""
    return packed_pieces(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_boilerplate),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack),
]

#: A trained network and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents that the stages keep."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
