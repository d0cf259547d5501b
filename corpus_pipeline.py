"""A corpus pipeline: each stage calls one operator on all that the stage before it kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowwarden.llm.bpe import Automaton, encode_decode
from flowwarden.llm.decontam import decontaminate
from flowwarden.llm.langid import identify, train
from flowwarden.llm.linededup import dedup_lines
from flowwarden.llm.minhash import drop_near_duplicates
from flowwarden.llm.queries import tokenizer_path
from flowwarden.llm.text import fresh, release
from flowwarden.session import durable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the model is sure enough of; those without a letter go."""
    names = docs.columns
    accepted = fresh(docs, "accepted")
    return identify(docs, train(docs)).filter(F.col(accepted)).select(*names)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that a document with a smaller id holds; n_chars follows the text."""
    return dedup_lines(docs, replace=True).withColumn("n_chars", F.length("text").cast("bigint"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: five-word shingles, similarity of 0.8 or more."""
    return drop_near_duplicates(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests beside each document."""
    return encode_decode(docs, Automaton.load(tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("leaks", leaks),
    ("encode", encode),
]

#: No SQL for the whole: learned models, fingerprints and the automaton are beyond it.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each result is written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for at, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at < len(STAGES) - 1:
            docs = durable(docs)
            release()
    return docs
