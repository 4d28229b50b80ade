"""Parquet table access (scan, existence check)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


#: Columns of the given tables: declared, so that reading one starts no job to look into its files.
DECLARED = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
                "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}


def table_path(base: str, name: str) -> str:
    base = base.rstrip("/")
    return f"{base}/{name}.parquet" if not base.endswith(".parquet") else base


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """``<base>/<name>.parquet`` as a pushdown-capable scan, by its declared schema if it has one."""
    reader = spark.read.schema(DECLARED[name]) if name in DECLARED else spark.read
    return reader.parquet(table_path(base, name))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether Spark's file system (the default one for paths without a scheme) has ``path``.

    Errors other than absence, such as a missing permission, are raised.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop))


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether a table's file or folder is there."""
    return path_exists(spark, path)
