"""Materialised intermediate tables in the shared checkpoint folder.

A stage whose output feeds several later stages (staging rows, dimensions,
the fact) is written once as Parquet under ``spark.checkpoint.dir`` and read
back. That cuts the lineage (a lost executor recomputes from the written
files, not from the source tables), gives later plans column pruning,
predicate pushdown and exact size statistics for join planning, and avoids
recomputing the upstream plan once per consumer.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ensure_checkpoint_dir


#: Stored rows carry their JSON payload, whose field names zstd stores at about half of snappy's size.
COMPRESSION = "zstd"


def scratch_path(df: DataFrame, name: str) -> str:
    root = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    return f"{root}/tables/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder in the shared checkpoint dir; read it back."""
    path = scratch_path(df, name)
    df.write.mode("errorifexists").option("compression", COMPRESSION).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_lines(documents: DataFrame, name: str, column: str = "document") -> DataFrame:
    """Write long documents one a line (without line breaks, as JSON text is) and read them
    back a row at a time; a null is an empty line. Parquet's reader would hold the
    documents of a whole batch of rows (4,096) at once in every task."""
    path = scratch_path(documents, name)
    documents.select(column).write.option("compression", "gzip").text(path)
    return documents.sparkSession.read.text(path).select(F.nullif(F.col("value"), F.lit("")).alias(column))


def path_exists(spark, path: str) -> bool:
    """Whether ``path`` exists in the store that it names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


class SlotTable:
    """A table that a run replaces as a whole, written beside the one in use.

    Two folders take turns: ``write`` fills the one not in use, ``read`` takes
    the complete one (Spark's ``_SUCCESS``) with the higher run number. A run
    that fails while writing leaves the table as it was.
    """

    def __init__(self, spark, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _runs(self) -> dict[str, int]:
        """Complete slots and their run numbers."""
        out = {}
        for slot in ("a", "b"):
            if path_exists(self.spark, f"{self.root}/{slot}/_SUCCESS"):
                out[slot] = self.spark.read.schema("run int").parquet(f"{self.root}/{slot}/run").first().run
        return out

    def exists(self) -> bool:
        return bool(self._runs())

    def folder(self) -> str:
        runs = self._runs()
        return f"{self.root}/{max(runs, key=runs.get)}"

    def run(self) -> int:
        """Number of the run that wrote the table in use; 0 where there is none."""
        return max(self._runs().values(), default=0)

    def read(self, part: str = "rows") -> DataFrame:
        return self.spark.read.parquet(f"{self.folder()}/{part}")

    def mark(self, name: str) -> None:
        """Note on the table in use, gone with the next ``write``."""
        self._touch(f"{self.folder()}/_{name}")

    def marked(self, name: str) -> bool:
        return path_exists(self.spark, f"{self.folder()}/_{name}")

    def _touch(self, path: str) -> None:
        file = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        file.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(file, True).close()

    def write(self, **parts) -> None:
        """Replace the table; its parts (``rows=…``) are folders of their own, written in
        turn. A part may be a function that makes it of a reader of those before."""
        runs = self._runs()
        slot = "b" if runs and max(runs, key=runs.get) == "a" else "a"
        path = f"{self.root}/{slot}"
        fs = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        fs.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(fs, True)
        for name, part in parts.items():
            df = part(lambda before: self.spark.read.parquet(f"{path}/{before}")) if callable(part) else part
            df.write.mode("overwrite").option("compression", COMPRESSION).parquet(f"{path}/{name}")
        number = self.spark.range(1).selectExpr(f"{max(runs.values(), default=0) + 1} AS run")
        number.write.mode("overwrite").parquet(f"{path}/run")
        self._touch(f"{path}/_SUCCESS")


class KeyedTable:
    """A Parquet table upserted by key, bucketed so a batch rewrites only the
    buckets it touches.

    Layout: ``root/_bucket=<b>/…`` with ``b = pmod(xxhash64(keys), buckets)``.
    ``merge(batch)`` reads the touched buckets (their numbers are literals of the
    filter, so the scan lists no others) and replaces just those with a dynamic
    partition overwrite, which puts its files in place only once all are written. A
    small batch is merged with ``merge_by_key``; a larger one is dealt to the buckets
    together with the stored rows, so each row moves once (``merge_dealt``), without
    them where it replaces every one, and not at all where all of it is stored. Merges are idempotent: merging the
    same batch twice leaves the table as after the first time.
    """

    def __init__(self, spark, root: str, schema, keys: list[str], buckets: int = 64, written: bool = False):
        """``written``: batches are written tables already."""
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.keys, self.buckets, self.written = list(keys), buckets, written

    def _bucket(self):
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def exists(self) -> bool:
        return path_exists(self.spark, self.root)

    def read(self) -> DataFrame:
        if not self.exists():
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self._stored_schema()).parquet(self.root).drop("_bucket")

    def _stored_schema(self):
        return T.StructType(self.schema.fields + [T.StructField("_bucket", T.IntegerType())])

    def rows_of(self, keys: DataFrame) -> DataFrame:
        """Stored rows whose key is among ``keys`` (a written table): only their buckets are read."""
        touched = self._touched(keys.withColumn("_bucket", self._bucket()))
        return self._buckets(touched).join(keys.select(*self.keys), self.keys, "left_semi")

    def _touched(self, batch: DataFrame) -> list[int]:
        """Buckets that the batch touches: at most ``buckets`` small numbers."""
        return sorted(r._bucket for r in batch.select("_bucket").distinct().collect())

    def _buckets(self, touched: list[int]) -> DataFrame:
        if not self.exists() or not touched:
            return self.spark.createDataFrame([], self.schema)
        return (self.spark.read.schema(self._stored_schema()).parquet(self.root)
                .filter(F.col("_bucket").isin(touched)).drop("_bucket"))

    def merged(self, batch: DataFrame, touched: list[int], update_cols: list[str] | None = None,
               newer: list[str] | None = None, rows: int | None = None) -> DataFrame:
        """The touched buckets after the upsert of ``batch`` (of ``rows`` rows)."""
        from ..operators.merge import SMALL_BATCH_ROWS, merge_by_key
        return merge_by_key(self._buckets(touched), batch, self.keys, update_cols, newer=newer,
                            small_batch=rows is not None and rows <= SMALL_BATCH_ROWS)

    def merge(self, batch: DataFrame, update_cols: list[str] | None = None,
              order_by: list[str] | None = None, newer: list[str] | None = None, written: bool = False) -> int:
        """Upsert ``batch`` (last row per key by ``order_by`` wins); returns the
        number of buckets rewritten. With ``newer`` a stored row gives way only
        to an incoming one that is not the earlier by those columns. ``written``:
        the batch is a written table already."""
        from ..operators.merge import dedupe_last
        cols = [f.name for f in self.schema.fields]
        b = batch.select(*cols)
        if order_by:
            b = dedupe_last(b, self.keys, order_by).select(*cols)
        if order_by or not (written or self.written):
            b = materialize(b, "merge_batch")
        per_key = b.groupBy(*self.keys).agg(F.count(F.lit(1)).alias("n")).withColumn("_bucket", self._bucket())
        # one row of the numbers that decide: at most ``buckets`` of them
        found = per_key.agg(F.max("n").alias("most"), F.sum("n").alias("rows"), F.collect_set("_bucket").alias("touched")).first()
        if (found.most or 0) > 1:
            raise ValueError(f"the batch holds a key of {self.keys} more than once and no order to choose by")
        touched = sorted(found.touched)
        if not touched:
            return 0
        merged = self._dealt_merge(b, touched, update_cols, newer, found.rows)
        if merged is None:
            return 0
        (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", COMPRESSION)
         .partitionBy("_bucket").parquet(self.root))
        return len(touched)

    def _news(self, batch: DataFrame, current: DataFrame) -> bool:
        """Whether some row of the batch is not stored as it is; rows are compared by their keys
        and a 128-bit digest of their values and of which are null."""
        values = [F.col(f.name) for f in self.schema.fields]
        nulls = F.array(*[v.isNull() for v in values])
        digest = [F.xxhash64(nulls, *values).alias("_digest"), F.xxhash64(F.lit(1), *values, nulls).alias("_digest2")]
        seen = lambda df: df.select(*self.keys, *digest)
        return not seen(batch).join(seen(current), [*self.keys, "_digest", "_digest2"], "left_anti").isEmpty()

    def _dealt_merge(self, batch: DataFrame, touched: list[int], update_cols: list[str] | None,
                     newer: list[str] | None, rows: int) -> DataFrame | None:
        """The touched buckets after the merge, dealt to a few writers each, whatever tasks the
        merge had; None where all that a large batch holds is stored already."""
        from ..operators.merge import SMALL_BATCH_ROWS, merge_dealt
        writers = max(1, int(self.spark.conf.get("spark.sql.shuffle.partitions")) // self.buckets)
        spread = F.pmod(F.hash(*[F.col(k) for k in self.keys]), F.lit(writers))

        def deal(df: DataFrame) -> DataFrame:
            return df.withColumn("_bucket", self._bucket()).withColumn("_writer", spread).repartition("_bucket", "_writer")
        if not self.exists():
            return deal(batch).drop("_writer")
        if rows <= SMALL_BATCH_ROWS:
            return deal(self.merged(batch, touched, update_cols, newer, rows)).drop("_writer")
        current = self._buckets(touched)
        if update_cols is None and not newer:
            # stored rows of the batch's keys are replaced as a whole; the keys alone tell whether others stay
            stay = current.select(*self.keys).join(batch.select(*self.keys), self.keys, "left_anti")
            if stay.isEmpty():
                return deal(batch).drop("_writer") if self._news(batch, current) else None
        return merge_dealt(current, batch, self.keys, deal, ["_bucket", "_writer"], update_cols, newer).drop("_writer")
