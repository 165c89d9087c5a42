"""Bounded samples of labelled documents for training classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: Column, folds: int) -> Column:
    return F.crc32(doc_id.cast("string")) % folds


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row is kept from training: remainder 0; a null id has no remainder and is held out."""
    return F.coalesce(fold(doc_id, folds) == 0, F.lit(True))


def sample(docs: DataFrame, labels: DataFrame, label: Column, kinds: tuple[int, ...], bound: int, folds: int = 5) -> DataFrame:
    """doc_id, label, text, lang of at most bound labelled rows of each kind that are not held out, by order of a hash.

    The bound is the only one: texts of any length are taken whole. A doc_id with several labels of the kinds counts
    by its largest, one with several texts by the least of them. The ids of the sample, at most bound a kind, are
    broadcast; nothing else is. Null ids and texts, null labels and labels of no kind take no part; without rows the
    sample is empty.
    """
    given = labels.select("doc_id", label.cast("int").alias("label")).where(F.col("label").isin(*kinds) & ~held_out(F.col("doc_id"), folds))
    given = given.groupBy("doc_id").agg(F.max("label").alias("label"))
    few = None
    for k in kinds:
        part = given.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        few = part if few is None else few.unionByName(part)
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    own = docs.select("doc_id", "text", lang.alias("lang")).where(F.col("text").isNotNull())
    found = own.join(F.broadcast(few), "doc_id").groupBy("doc_id", "label").agg(F.min(F.struct("text", "lang")).alias("x"))
    return found.select("doc_id", "label", "x.text", "x.lang")
