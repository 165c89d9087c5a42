"""Corpus pipeline over documents: each stage's rows are written as Parquet and read again by the next one."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pleiad.llm import line_dedup, mixing, packing, simhash, toxicity
from pleiad.llm.common import releasing, remove, shared_dir, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below their language's threshold (one that equals it goes), with all their columns.

    Null and empty texts have the score of no words; very long ones are scored whole; repeated rows are judged alike;
    a null lang has the common threshold. Columns of any name stay as they are; an empty table gives an empty one,
    and without labels nothing is learnt: all documents have one score.
    """
    model = toxicity.fitted(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.kept(docs, model)


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that ten or more of them share; n_chars follows the text.

    A null text stays null and keeps its n_chars, an empty one is one empty line and stays. Rows that repeat a doc_id
    count as one document of a line, null doc_ids too. Texts of any length are split whole. Other columns, whatever
    their names, stay as they are; an empty table gives an empty one.
    """
    return line_dedup.without_shared_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: that of the smallest doc_id (nulls last, then the least hash of the text).

    Null and empty texts are one group, so one of them stays; so does one of rows that repeat each other. Texts count
    whole. All columns stay, whatever their names; an empty table gives an empty one.
    """
    return simhash.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it, at least once, with the columns of documents alone.

    Null and empty texts are one token, null sources a source of their own; rows that repeat each other share their
    fate. No text is cut. Columns of any name stay as they are; an empty table gives an empty one.
    """
    return mixing.repeated(docs)


def pack_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed-length sequences that cover all documents' tokens.

    Null and empty texts are their end alone, a very long text is many sequences. Repeated rows and null doc_ids are
    documents of their own. Only doc_id and text are read; an empty table gives an empty one.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_tokens),
]
#: Hashes, a trained classifier and a tokenizer are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    top = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    before = None
    for name, stage in STAGES:
        with releasing():  # what a stage has checkpointed goes once its rows are written
            stage(spark, docs, sf_dir).write.parquet(f"{top}/{name}")
        docs = spark.read.parquet(f"{top}/{name}")
        if before:
            remove(spark, before)
        before = f"{top}/{name}"
    return docs
