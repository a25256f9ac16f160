"""Corpus pipeline: documents in, packed token sequences out.

Each stage works on what its predecessor kept; results are written as Parquet in the shared folder and
read again, so a lost executor repeats a part of one stage only. Defined results: rows without an id
pass the dedup stages unless their text is an exact copy; a table without language labels passes the
first stage whole; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordloom.llm import exact_dedup, language_id, near_dup, packing, secret_scan
from recordloom.llm.common import documents, written
from recordloom.llm.queries import tokenizer_file


#: Rows of the batches that go to Python workers and back: with texts of some kB, a few MB each way.
ARROW_ROWS = 2_000


def _small_batches(stage):
    """Run a stage in a session whose batches are small: both ends of each hold one outside of the executor's heap."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        return stage(spark, docs, sf_dir)

    return run_stage


@_small_batches
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are in none of the languages of the labelled ones."""
    model = language_id.fit(docs.filter(~language_id.held_out()), "lang", "doc_id", "text")
    if not model.languages:
        return docs
    shares = language_id.known_shares(docs.filter(language_id.held_out()), model, "lang", "text")
    return language_id.keep_learned(docs, model, shares)


@_small_batches
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the row with the smallest id of each normalised text."""
    return exact_dedup.drop_exact_duplicates(docs)


@_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near duplicates."""
    return near_dup.drop_near_duplicates(docs)


@_small_batches
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; no document goes."""
    clean = secret_scan.redact_column(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


@_small_batches
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the token sequences, as in the packing operator."""
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("minhash_near_dup", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("best_fit_packing", pack),
]

#: The trained stages and the tokenizer have no SQL; the tests hold the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
