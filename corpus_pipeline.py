"""A corpus from documents to token files, in five stages, each written and read again before the next.

1. language ID: documents whose language can't be told go.
2. near-duplicates (five-word shingles, similarity 0.8): the smallest doc_id of each group stays.
3. benchmark decontamination: documents that hold a benchmark item go.
4. mixing: small sources are repeated, up to twice, towards even weights; every document comes at least once. The stage's files hold the
   mixture in the order of its blocks and the places in them.
5. token files: the mixture's ids in Arrow files, in that order, read back as one row for each document.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loamline.llm import decontam, langid, mixing, neardup, tokenfiles
from loamline.llm.shared import materialise

#: Its file's path is a parameter of the token stage; nothing is copied from it.
TOKENIZER = "word_bpe_49k.json"
END_ID = 2


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language. The text models are fitted on a bounded, labelled sample of docs."""
    return langid.in_known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return neardup.keep_one(docs, k=5, num=4, den=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark table."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), k=5, num=4, den=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixture, in its order: documents of small sources come up to twice, all at least once."""
    return mixing.mixed_docs(docs, evenness=0.93, most_repeats=2.0)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the token files; these follow the order of docs' files (doc_id, if docs come from none)."""
    return tokenfiles.token_output(docs, public_tokenizers.path(TOKENIZER), END_ID, order=mixing.file_order(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("near_dedup", near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix),
    ("token_output", tokens),
]

#: Trained models, hashed signatures and a tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}", "zstd")
    return STAGES[-1][1](spark, docs, sf_dir)
