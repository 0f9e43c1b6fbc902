"""Readers for the driver's parquet tables, always with an explicit schema.

An explicit schema skips footer-based inference (one footer read per file at
100 TB is a long driver-side listing job) and pins the zoneless timestamps to
``timestamp_ntz`` whatever the session's inference settings say.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(*fields: tuple[str, object]) -> StructType:
    return StructType([StructField(name, dtype, True) for name, dtype in fields])


DRIVER_SCHEMAS: dict[str, StructType] = {
    "region": _schema(("r_regionkey", IntegerType()), ("r_name", StringType())),
    "nation": _schema(
        ("n_nationkey", IntegerType()), ("n_name", StringType()), ("n_regionkey", IntegerType())
    ),
    "customer": _schema(
        ("c_custkey", LongType()),
        ("c_name", StringType()),
        ("c_nationkey", IntegerType()),
        ("c_acctbal", DoubleType()),
        ("c_mktsegment", StringType()),
    ),
    "supplier": _schema(
        ("s_suppkey", LongType()),
        ("s_name", StringType()),
        ("s_nationkey", IntegerType()),
        ("s_acctbal", DoubleType()),
    ),
    "part": _schema(
        ("p_partkey", LongType()),
        ("p_name", StringType()),
        ("p_brand", StringType()),
        ("p_type", StringType()),
        ("p_size", IntegerType()),
        ("p_retailprice", DoubleType()),
    ),
    "orders": _schema(
        ("o_orderkey", LongType()),
        ("o_custkey", LongType()),
        ("o_orderstatus", StringType()),
        ("o_totalprice", DoubleType()),
        ("o_orderdate", TimestampNTZType()),
        ("o_orderpriority", StringType()),
    ),
    "lineitem": _schema(
        ("l_orderkey", LongType()),
        ("l_partkey", LongType()),
        ("l_suppkey", LongType()),
        ("l_linenumber", IntegerType()),
        ("l_quantity", DoubleType()),
        ("l_extendedprice", DoubleType()),
        ("l_discount", DoubleType()),
        ("l_tax", DoubleType()),
        ("l_returnflag", StringType()),
        ("l_linestatus", StringType()),
        ("l_shipdate", TimestampNTZType()),
    ),
    "events": _schema(
        ("event_id", LongType()),
        ("ts", TimestampNTZType()),
        ("user_id", LongType()),
        ("event_type", StringType()),
        ("value", DoubleType()),
        ("props", StringType()),
    ),
}


class DriverTables:
    """Lazy access to ``{root}/{name}.parquet`` (a file or a directory of files)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        reader = self.spark.read
        schema = DRIVER_SCHEMAS.get(name)
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(self.path(name))

    @cached_property
    def customer(self) -> DataFrame:
        return self.read("customer")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.read("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.read("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.read("events")

    @cached_property
    def nation(self) -> DataFrame:
        return self.read("nation")
