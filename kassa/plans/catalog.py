"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key,
with the parameters the checks use, and the matching DuckDB oracle.

Registered results are in export form: dates and times as ISO text, integer
columns as bigint, money as double (what ``report_csv`` writes).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DateType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    ShortType,
    TimestampNTZType,
    TimestampType,
)

from kassa.session import configure
from kassa.sources.adapter import driver_shop, event_shop

# Fixed parameters of the registered checks: the driver's orders
# run 1995-01-01 .. 2001-08-01 and its events cover January 2024.
AS_OF = dt.date(2001, 8, 2)
EVENTS_AS_OF = dt.date(2024, 2, 1)
YEAR = 1996
DAYS = 90
SUMMARY_DAY = dt.date(2001, 7, 20)
SINCE = dt.date(1999, 1, 1)
REFRESH_SINCE = dt.datetime(2000, 6, 1)
LOOKUP_ID = 7
LOOKUP_EMAIL = "CUSTOMER.000000007@EXAMPLE.COM"

QueryFn = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, QueryFn] = {}


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return present(fn(spark, sf_dir))

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return run

    return deco


def present(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (TimestampNTZType, TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, (IntegerType, ShortType, ByteType)):
            c = c.cast(LongType())
        elif isinstance(f.dataType, DecimalType):
            c = c.cast(DoubleType())
        cols.append(c.alias(f.name))
    return df.select(cols)


def queries() -> dict[str, QueryFn]:
    _load()
    return dict(_REGISTRY)


def oracle_sql() -> dict[str, str]:
    _load()
    from kassa.plans.oracle_queries import ORACLES

    return {k: v for k, v in ORACLES.items() if k in _REGISTRY}


def _load() -> None:
    import kassa.plans.registered  # noqa: F401  (registers on import)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder for a written table, under the session's shared
    checkpoint folder (never a machine-local temporary folder)."""
    import uuid

    from kassa.session import ensure_checkpoint_dir

    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/kassa-tables/{name}-{uuid.uuid4().hex}"


def shop(spark: SparkSession, sf_dir: str):
    return driver_shop(spark, sf_dir)


def events(spark: SparkSession, sf_dir: str):
    return event_shop(spark, sf_dir)
