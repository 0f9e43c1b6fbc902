"""Skew-proof ordered numbering: row_number, rank, lag and group size per group.

Spark's window functions put a whole ``PARTITION BY`` group in one task, and a
window without ``PARTITION BY`` puts every row in one task.  When one group
(a customer, a category) may hold a third of all rows, or the window is
global (NTILE over all customers), that task is the job.  This operator
numbers ranges of the *full* sort key instead, with one plan at every size:

1. ``repartitionByRange(group, order)``: a hot group is cut into several
   contiguous ranges.  The ranges, with their number, are written once to the
   shared checkpoint folder, bucketed by that number, so every later use reads
   the same ranges, a lost executor re-reads files instead of sampling bounds
   anew, and this is the only shuffle of the rows.
2. Window functions inside (range, group), which one range bounds; the buckets
   already hold a range together.
3. A range edge can cut only the first and the last group of a range.  For
   those, at most two rows a range whatever the data: counts, totals, the rank
   key and lag values at their ends; windows over a group's ranges turn them
   into carries, which come back as one row a range.

Everything stays in the JVM, so values of any type keep their precision.  The
caller's order must be total inside a group (end it with a unique key);
``rank_by`` names the leading order columns whose ties share a rank.  Callers
pass the keys they need and join wide columns afterwards.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kassa.session import ensure_checkpoint_dir
from kassa.sources.bucketed import least_buckets, write_bucketed

ROW, RANK, SIZE = "_row", "_rank", "_size"


def _prev(c: str) -> str:
    return f"_prev_{c}"


def _total(c: str) -> str:
    return f"_total_{c}"


def _sort_exprs(order: Sequence[tuple[str, bool]]) -> list[Column]:
    return [F.col(n).asc_nulls_first() if up else F.col(n).desc_nulls_last() for n, up in order]


def materialize(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back:
    lineage is cut, column pruning and lost executors are provided for."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/kassa-tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def number_rows(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[tuple[str, bool]],
    *,
    rank_by: Sequence[str] = (),
    lag: Sequence[str] = (),
    totals: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """Add ``_row``, ``_rank``, ``_size``, ``_prev_<c>`` for ``c`` in ``lag`` and
    the group's sum ``_total_<c>`` for ``c`` in ``totals``.

    ``order`` is a list of (column, ascending); ascending sorts NULLs first,
    descending NULLs last (Spark's and PostgreSQL's defaults).  Without
    ``rank_by`` the rank is the row number.  ``partitions`` is the number of
    ranges; by default the session's shuffle partitions, which adaptive
    execution joins where they are small.  One job (the range sort) runs here.
    """
    group, rank_by, lag, totals = list(group), list(rank_by), list(lag), list(totals)
    exprs = _sort_exprs([(g, True) for g in group] + list(order))
    ranged = df.repartitionByRange(partitions, *exprs) if partitions else df.repartitionByRange(*exprs)
    buckets = max(partitions or 1, least_buckets(df.sparkSession))
    rows = write_bucketed(ranged.withColumn("_range", F.spark_partition_id()), "_range", buckets, "ranges")

    by_order = _sort_exprs(order)
    by_rank = _sort_exprs([(c, up) for c, up in order if c in rank_by]) if rank_by else by_order
    inside = Window.partitionBy("_range", *group)

    def windows(part: DataFrame) -> DataFrame:
        return part.select(
            "*",
            F.row_number().over(inside.orderBy(*by_order)).cast("long").alias("_lrow"),
            F.rank().over(inside.orderBy(*by_rank)).cast("long").alias("_lrank"),
        )

    # the groups that an edge can cut, from each range's first and last
    me = F.struct(*[F.col(g) for g in group] or [F.lit(0).alias("g")])
    bounds = rows.groupBy("_range").agg(F.min(me).alias("_low"), F.max(me).alias("_high"))
    edge = rows
    if group:
        edge = rows.join(bounds, "_range").where(me.eqNullSafe(F.col("_low")) | me.eqNullSafe(F.col("_high")))
    aggregates = [F.count("*").alias("_n"), *[F.sum(c).alias(f"_sum_{c}") for c in totals]]
    if rank_by or lag:
        edge = windows(edge)
        rank_key = F.struct(*[F.col(c) for c, _ in order if c in rank_by] or [F.lit(0)])
        aggregates += [
            F.min_by(rank_key, "_lrow").alias("_first_key"),
            F.max_by(rank_key, "_lrow").alias("_last_key"),
            F.max("_lrank").alias("_last_rank"),
            F.max_by(F.struct(*[F.col(c) for c in lag] or [F.lit(0)]), "_lrow").alias("_last_values"),
        ]
    ends = edge.groupBy("_range", *group).agg(*aggregates)
    whole = Window.partitionBy(*group)
    along = whole.orderBy("_range")
    earlier = along.rowsBetween(Window.unboundedPreceding, -1)
    cut = ends.withColumn("_size", F.sum("_n").over(whole)).where(F.col("_size") > F.col("_n"))
    cut = cut.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    carried = ["_size", "_before"]
    for c in totals:
        cut = cut.withColumn(_total(c), F.sum(f"_sum_{c}").over(whole))
        carried.append(_total(c))
    if lag:
        cut = cut.withColumn("_values", F.lag("_last_values").over(along))
        carried.append("_values")
    if rank_by:
        cut = (
            cut.withColumn(
                "_tied", F.coalesce(F.lag("_last_key").over(along).eqNullSafe(F.col("_first_key")), F.lit(False))
            )
            .withColumn("_tied", F.col("_tied") & (F.col("_before") > 0))
            # a range of one tie that began before passes the earlier rank on
            .withColumn(
                "_own_rank",
                F.when(~(F.col("_tied") & (F.col("_last_rank") == 1)), F.col("_before") + F.col("_last_rank")),
            )
            .withColumn("_tie_rank", F.last("_own_rank", ignorenulls=True).over(earlier))
        )
        carried += ["_tied", "_tie_rank"]
    # one row a range: its first and its last group with their carries
    carry = F.struct(me.alias("group"), *[F.col(c) for c in carried])
    cut = cut.groupBy("_range").agg(
        F.min_by(carry, me).alias("_head"),
        F.max_by(carry, me).alias("_tail"),
    )
    joined = windows(rows).select(
        "*",
        F.count("*").over(inside).alias("_lsize"),
        *[F.lag(c).over(inside.orderBy(*by_order)).alias(_prev(c)) for c in lag],
        *[F.sum(c).over(inside).alias(f"_lsum_{c}") for c in totals],
    ).join(cut, "_range", "left")
    mine = F.when(me.eqNullSafe(F.col("_head.group")), F.col("_head")).when(
        me.eqNullSafe(F.col("_tail.group")), F.col("_tail")
    )
    joined = joined.withColumn("_carry", mine)
    before = F.coalesce("_carry._before", F.lit(0))
    rank = F.col("_lrank") + before
    if rank_by:
        tied = F.coalesce("_carry._tied", F.lit(False)) & (F.col("_lrank") == 1)
        rank = F.when(tied, F.col("_carry._tie_rank")).otherwise(rank)
    return joined.select(
        *df.columns,
        (F.col("_lrow") + before).alias(ROW),
        rank.alias(RANK),
        F.coalesce("_carry._size", "_lsize").alias(SIZE),
        *[
            F.when(F.col("_lrow") > 1, F.col(_prev(c))).otherwise(F.col(f"_carry._values.{c}")).alias(_prev(c))
            for c in lag
        ],
        *[F.coalesce(f"_carry.{_total(c)}", f"_lsum_{c}").alias(_total(c)) for c in totals],
    )


def ntile(k: int, row: Column | str = ROW, size: Column | str = SIZE) -> Column:
    """NTILE(k) from a 1-based row number and the group size (same buckets
    as SQL NTILE: the first n mod k buckets hold one row more)."""
    r0 = (F.col(row) if isinstance(row, str) else row) - 1
    n = F.col(size) if isinstance(size, str) else size
    q = F.floor(n / k).cast("long")
    m = (n % k).cast("long")
    big = m * (q + 1)
    return (
        F.when(r0 < big, F.floor(r0 / (q + 1)) + 1)
        .otherwise(m + F.floor((r0 - big) / F.greatest(q, F.lit(1))) + 1)
        .cast("long")
    )
