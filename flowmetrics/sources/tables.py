"""Driver-provided Parquet tables (one file per table under ``sf_dir``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


# Declared schemas of the tables the staging adapter reads. With a schema the
# reader skips inference (a footer-reading job per read at planning time, and
# at scale a read of remote footers); the other tables are inferred.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "orders": ("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
               "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"),
    "lineitem": ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                 "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                 "l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_jdbc_table(spark: SparkSession, url: str, table_name: str, partition_column: str,
                    lower: int, upper: int, partitions: int, properties: dict | None = None) -> DataFrame:
    """Partitioned JDBC read (``partition_column`` between ``lower`` and
    ``upper`` split into ``partitions`` range queries). Needs the database's
    JDBC driver on the classpath; the rest of the code reads the same
    columns from Parquet."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table_name)
              .option("partitionColumn", partition_column).option("lowerBound", str(lower))
              .option("upperBound", str(upper)).option("numPartitions", str(partitions)))
    for k, v in (properties or {}).items():
        reader = reader.option(k, v)
    return reader.load()
