"""Registered queries of the operators: thin calls with production
parameters over the whole intended table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import divergence, line_templates, quality, topk
from .common import documents


def op1_chained_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import repeated_passages

    return repeated_passages(documents(spark, sf_dir), both_sides=True)


def op2_deobfuscated_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import find_pii

    return find_pii(documents(spark, sf_dir))


def op3_multi_index_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import hex_fingerprint, near_duplicates

    found = near_duplicates(documents(spark, sf_dir), shingle=3, max_bits=2)
    return found.select("doc_id", hex_fingerprint().alias("fingerprint"), "component_id")


def op4_line_template_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_recurring(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", "text")


def op5_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    book = quality.ledger(documents(spark, sf_dir))
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       quality.failed("base").alias("base_failed"), (~quality.failed()).alias("kept"), "fail_bits")


def op6_entropy_balancing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op7_compression_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import fit, held_out, identify, training_rows

    docs = documents(spark, sf_dir)
    found = identify(docs.select("doc_id", "text"), fit(training_rows(docs)))
    return found.select("doc_id", held_out(found).alias("held_out"), "lang_pred", "score", "lang_rejected")


def op8_branch_and_bound_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return topk.top_k(vectors.filter(F.col("vec_id") % 100 == 0), vectors, k=10, scale=1024.0)


def op9_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    return token_counts(documents(spark, sf_dir))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(documents(spark, sf_dir))


def op12_dyadic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .periodic import digests, periodic_runs, tails_repeated

    return digests(periodic_runs(tails_repeated(documents(spark, sf_dir))))


def op13_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import round_trip

    return round_trip(documents(spark, sf_dir), "byte_bpe_multi_50k.tiktoken")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chained_passages": op1_chained_passages,
    "op2_deobfuscated_pii": op2_deobfuscated_pii,
    "op3_multi_index_simhash": op3_multi_index_simhash,
    "op4_line_template_dedup": op4_line_template_dedup,
    "op5_rule_ledger": op5_rule_ledger,
    "op6_entropy_balancing": op6_entropy_balancing,
    "op7_compression_language": op7_compression_language,
    "op8_branch_and_bound_top_k": op8_branch_and_bound_top_k,
    "op9_sum_of_squares_packing": op9_sum_of_squares_packing,
    "op10_token_counts": op10_token_counts,
    "op11_source_divergence": op11_source_divergence,
    "op12_dyadic_runs": op12_dyadic_runs,
    "op13_recursive_bpe": op13_recursive_bpe,
}

# DuckDB SQL for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op4_line_template_dedup": line_templates.ORACLE,
    "op5_rule_ledger": quality.ORACLE,
    "op8_branch_and_bound_top_k": topk.ORACLE,
    "op11_source_divergence": divergence.ORACLE,
}
