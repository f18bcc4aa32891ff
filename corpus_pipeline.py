"""A corpus pipeline: language ID, near dedup, decontamination, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents."""

from __future__ import annotations

from collections.abc import Callable

from newsweir.llm.base import cut, table
from newsweir.llm.decontam import clean_documents
from newsweir.llm.langid import known_language
from newsweir.llm.mixing import mixed_documents
from newsweir.llm.near_dedup import one_of_each
from newsweir.llm.token_files import token_files
from pyspark.sql import DataFrame, SparkSession


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without text or without a letter go, and those that the classifier doesn't know.

    Null texts go; null labels aren't learned from; rows that repeat a doc_id are judged on their own; of languages with equal
    scores the first by name counts; long texts are read whole; an empty table gives an empty one."""
    return known_language(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the least doc_id, of every class of near duplicates.

    Null and empty texts are near to nothing and stay, as do rows without a doc_id; of equal rows one stays, rows that repeat a
    doc_id with another text are documents of their own; long texts are compared whole; an empty table gives an empty one."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark.

    Null and empty texts hold none; rows that repeat a doc_id go together; an item that is held in exactly the least share
    counts; long texts are read whole; an empty table, of documents or items, removes nothing."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that a mix of the sources takes, as documents; one whose words are taken twice comes twice.

    A null source is one of its own; null and empty texts have no words and don't come; rows that repeat a doc_id are documents
    of their own, in order of their text's hash; long texts are cut whole; an empty table gives an empty one."""
    return mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents in order of doc_id, read back: doc_id, start, n_tokens, ids_crc32.

    Null texts are empty and have the end id alone; rows that repeat a doc_id follow each other, those without one come first;
    long texts are encoded whole; an empty table gives an empty one."""
    return token_files(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token files", tokens),
]

#: String kernels, edit similarity and the tokenizer are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = cut(docs, "stage")
    return docs


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {}
