"""The registered queries of this subpackage, over whole tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusqa.llm import bpe, decontaminate, licences, linededup, packing, private, ranked, sampling, shard, simhash, suffix, toxicity, vectorcodes
from corpusqa.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
SHARDS = 24


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licences.scanned(table(spark, sf_dir, "documents"), licences.known_licences(spark))
    return rows.select(
        "doc_id", "digest", F.array_join("licences", ",").alias("licences"), F.array_join("notices", ",").alias("notices")
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    network = toxicity.learned(docs, table(spark, sf_dir, "labels"))
    rows = docs.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), toxicity.score(F.col("text"), network).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontaminate.measured(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform(F.coalesce("item_ids", F.array().cast("array<bigint>")), lambda i: i.cast("string")))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size(ids).cast("bigint").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), "contaminated",
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_counts(table(spark, sf_dir, "documents"))


def op5_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    # a fixed key makes the check's results repeatable; real runs pass their own
    return private.pseudonymised(table(spark, sf_dir, "documents"), secret="check")


def op6_weighted_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.neighbours(table(spark, sf_dir, "documents"))


def op7_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard.sharded(table(spark, sf_dir, "documents"), [1.0] * SHARDS, extra=1.0)
    return rows.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix.without_repeats(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    rows = packing.packed(docs, TOKENIZER)
    return rows.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = bpe.encoded(table(spark, sf_dir, "documents"), TOKENIZER, keep=["doc_id"])
    spelled = F.array_join(F.col("ids").cast("array<string>"), ",")
    rows = rows.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(spelled, 256).alias("ids_sha256"), "ids")
    return bpe.decoded(rows, TOKENIZER).select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = vectorcodes.compressed(table(spark, sf_dir, "embeddings"))
    return vectorcodes.with_label_error(coded).select(
        "vec_id", vectorcodes.hex_code(F.col("codes")).alias("code"), "error", "label_error",
        F.lit(vectorcodes.books_digest(books)).alias("codebooks_sha256"),
    )


QUERIES = {
    "op1_license_scan": op1_license_scan,
    "op2_toxicity": op2_toxicity,
    "op3_decontamination": op3_decontamination,
    "op4_line_dedup": op4_line_dedup,
    "op5_surrogates": op5_surrogates,
    "op6_weighted_sampling": op6_weighted_sampling,
    "op7_rendezvous_shards": op7_rendezvous_shards,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_packing": op9_packing,
    "op10_simhash": op10_simhash,
    "op11_bpe_round_trip": op11_bpe_round_trip,
    "op12_ranked_search": op12_ranked_search,
    "op13_vector_codes": op13_vector_codes,
}
SQL: dict[str, str] = {
    "op1_license_scan": licences.scan_sql(),
    "op3_decontamination": decontaminate.measured_sql(),
    "op4_line_dedup": linededup.LINE_COUNTS_SQL,
    "op7_rendezvous_shards": shard.key_law_sql(SHARDS),
    "op8_substring_dedup": suffix.without_repeats_sql(),
    "op12_ranked_search": ranked.ranked_sql(),
    "op13_vector_codes": vectorcodes.compressed_sql(),
}
