"""The corpus pipeline: quality classifier, SimHash near-dedup, benchmark
decontamination, mixing sources to target weights, token-ID output.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs.  All but the last return the
columns of ``docs``.  Null and empty texts go through every stage: the classifier
scores them, fingerprint zero links them, they hold no benchmark window, the mix
counts them as size 0, and their tokens are the end id alone.  Tables may be
empty, and extra columns stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitchhouse.llm import decontam, mixing, quality, simhash, simple8b, tokens
from pitchhouse.llm.common import stored, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more; the model is fitted on ``docs`` themselves."""
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return simhash.drop_near_duplicates(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.mixed(docs)


def token_id_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' documents: id, place among all ids, number of ids, CRC-32."""
    return simple8b.token_files(docs, tokens.library_path("word_bpe_49k.json"), keep=KEPT_WORDS)


#: Words that the encoder keeps here, where the workers served other stages before.
KEPT_WORDS = 200_000

STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mix_sources),
    ("token-ID output", token_id_output),
]

#: The classifier and the tokenizer cannot be expressed in SQL; tests/llm/test_pipeline.py
#: holds the pipeline against plain Python, with the classifier's decisions taken as given.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.split()[0].lower())
    return STAGES[-1][1](spark, docs, sf_dir)
