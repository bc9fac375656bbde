"""The corpus pipeline: documents to tokens in five stages, each written as Parquet and read again by the next.

Language identification, line dedup, near-copy removal, benchmark decontamination and tokenisation. A stage works on all that
the one before kept and returns the columns of documents, further ones included; the last returns tokens.

Defined results: a document with a null or empty text, or without a letter, goes in the first stage, as it has no language;
documents with null or repeated ids are told apart by their texts; of rows repeated as a whole one stays (third stage); a text may
have any length; an empty table gives no rows, and without training labels no document has a language.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.bpe_codec import encode_documents
from tidemark.llm.decontaminate import stage_decontaminate
from tidemark.llm.language_id import stage_language_id
from tidemark.llm.line_dedup import stage_line_dedup
from tidemark.llm.ngram_join import stage_ngram_join
from tidemark.session import Scratch, durable


def stage_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every remaining document's tokens."""
    return encode_documents(docs, with_ids=True)


#: All but the last return the columns of documents.
STAGES = [
    ("language_id", stage_language_id),
    ("line_dedup", stage_line_dedup),
    ("ngram_join", stage_ngram_join),
    ("decontamination", stage_decontaminate),
    ("bpe", stage_bpe),
]

#: Trained models, SimHash, MinHash and alignments are not SQL; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other; what a stage keeps is written to the shared checkpoint folder until the next has read it."""
    with Scratch(spark) as scratch:
        docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
        kept = None
        for _, stage in STAGES[:-1]:
            docs = scratch.keep(stage(spark, docs, sf_dir))
            if kept is not None:
                scratch.drop(kept)
            kept = docs
        return durable(STAGES[-1][1](spark, docs, sf_dir))
