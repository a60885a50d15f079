"""The registered queries opN_<name>: each applies operator N, with production
parameters, to its whole table and derives the digest columns from its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitchhouse.llm import (decontam, fingerprints, language, lines, mixing, periodic, quality, simhash, simple8b,
                            suffixes, tokens, trie, urls)
from pitchhouse.llm.common import table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.digest(decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(table(spark, sf_dir, "documents"), tokens.library_path("byte_bpe_50k.json"))


def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.digest(lines.dedup_lines(table(spark, sf_dir, "documents")))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digest(suffixes.remove_repeats(table(spark, sf_dir, "documents")))


def op8_token_id_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple8b.token_files(table(spark, sf_dir, "documents"), tokens.library_path("word_bpe_49k.json"))


def op9_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited(table(spark, sf_dir, "documents"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op11_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.languages(docs, language.train(docs))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.periodic_runs(table(spark, sf_dir, "documents"), turn=True))


def queries() -> dict[str, QueryFn]:
    import corpus_pipeline

    own = [op1_url_filters, op2_quality_classifier, op3_benchmark_decontamination, op4_token_counts, op5_simhash_near_dedup, op6_line_dedup, op7_suffix_array_dedup,
           op8_token_id_output, op9_document_fingerprints, op10_mix_sources,
           op11_conversation_prefix_trie, op12_language_id, op13_periodic_runs]
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}
