"""Helpers the operators share: table access, staging in the shared folder, text forms."""

from __future__ import annotations

import sys
import types
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

SEPARATOR_BYTES = r"\x20\x09-\x0D"
SEPARATORS = f"[{SEPARATOR_BYTES}]+"
WORD = f"[^{SEPARATOR_BYTES}]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def staged(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write ``df`` to a new folder under ``spark.checkpoint.dir``, one folder per value of
    ``by`` if named, and read it back.

    The written copy cuts the lineage, fixes row ids, and serves several readers.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").partitionBy(*([by] if by else [])).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def per_worker(key: str, make: Callable[[], object]):
    """``make()`` once per Python worker process. Module globals of this package are
    copied with every task, so the object is kept in a module that the worker
    registers itself."""
    kept = sys.modules.setdefault("_kept_by_worker", types.ModuleType("_kept_by_worker")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def slices(sizes: list, most: int) -> Iterator[tuple[int, int]]:
    """Bounds of consecutive rows whose sizes add up to ``most`` at the utmost, or one larger row."""
    start = total = 0
    for i, size in enumerate(sizes):
        if i > start and total + size > most:
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that where every character is one
    byte long; other texts are translated letter by letter."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, SEPARATORS), "")


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once per row, also when ``body``
    uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def power_of_two(n: int, least: int, most: int) -> int:
    """The smallest power of two that is ``n`` or more, held between the bounds."""
    return max(least, min(most, 1 << max(0, int(n) - 1).bit_length()))


def bucket_offsets(counts: DataFrame, bucket: str, n: str, offset: str) -> DataFrame:
    """First number of each bucket. ``counts`` holds one row per bucket, a bounded
    number, so the ordered running sum may run in one task."""
    from pyspark.sql import Window as W
    w = W.orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)
    return counts.select(bucket, F.coalesce(F.sum(n).over(w), F.lit(0)).cast("long").alias(offset))
