"""Folds and bounded training samples shared by the two classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(folds: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id's decimal text modulo ``folds``; a null id falls in no fold (-1)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds, F.lit(-1))


def sampled(df: DataFrame, rows: int, most: int, seed: int, id_col: str = "doc_id") -> DataFrame:
    """About ``most`` of the ``rows`` rows of ``df`` (one row an id), by a hash of the id:
    binomial around ``most``, so its deviation is at most the root of ``most``."""
    if rows <= most:
        return df
    share = F.shiftrightunsigned(F.xxhash64(id_col, F.lit(seed)), 11) / F.lit(float(1 << 53))
    return df.filter(share < most / rows)


def texts_of(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, y, text) of the ids in ``chosen(doc_id, y)``, a bounded sample: one row of
    each, with the greatest text, however many rows of ``docs`` share the id."""
    text = docs.select(F.col("doc_id").alias("_id"), "text")
    return (text.join(F.broadcast(chosen), text["_id"] == chosen["doc_id"])
            .groupBy("doc_id", "y").agg(F.max("text").alias("text")))


def training_labels(labels: DataFrame, label: str, folds: int, held_out: int) -> DataFrame:
    """(doc_id, y) of the rows that may be learnt from; the smallest label of an id counts
    where an id is labelled more than once."""
    return (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold(folds) != held_out))
            .groupBy("doc_id").agg(F.min(F.col(label).cast("int")).alias("y")))


def class_counts(train: DataFrame) -> tuple[int, int]:
    """(rows with label 0, rows with label 1)."""
    row = train.agg(F.count_if(F.col("y") == 0).alias("zeros"), F.count_if(F.col("y") == 1).alias("ones")).first()
    return row["zeros"], row["ones"]
