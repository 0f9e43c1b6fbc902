import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from kassa.operators.sequence import ntile, number_rows


def _expected(df, group, order_cols, rank_col):
    w = Window.partitionBy(*group).orderBy(*order_cols) if group else Window.orderBy(*order_cols)
    wg = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(1))
    wr = (Window.partitionBy(*group) if group else Window).orderBy(rank_col)
    return df.select(
        "*",
        F.row_number().over(w).alias("e_row"),
        F.rank().over(wr).alias("e_rank"),
        F.count(F.lit(1)).over(wg).alias("e_size"),
        F.lag("t").over(w).alias("e_prev_t"),
    )


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_number_rows_matches_windows(spark, parts):
    rnd = random.Random(parts)
    rows = []
    for i in range(3000):
        g = 0 if i < 1200 else rnd.choice([1, 2, 3, None])  # group 0 holds 40%
        rows.append((i, g, rnd.randint(0, 40), rnd.randint(0, 10**6)))
    df = spark.createDataFrame(rows, "id long, g int, v int, t long")
    got = number_rows(df, ["g"], [("v", False), ("id", True)], rank_by=["v"], lag=["t"], partitions=parts)
    exp = _expected(df, ["g"], [F.col("v").desc(), "id"], F.col("v").desc())
    j = got.join(exp, "id")
    bad = j.filter(
        (F.col("_row") != F.col("e_row"))
        | (F.col("_rank") != F.col("e_rank"))
        | (F.col("_size") != F.col("e_size"))
        | ~F.col("_prev_t").eqNullSafe(F.col("e_prev_t"))
    )
    assert j.count() == 3000
    assert bad.count() == 0


def test_global_ntile_matches_builtin(spark):
    for n in (0, 1, 3, 5, 7, 12, 1003):
        df = spark.range(n).select(F.col("id"), ((F.col("id") * 7919) % 101).alias("m"))
        got = number_rows(df, [], [("m", True), ("id", True)], partitions=4).select(
            "id", ntile(5).alias("b")
        )
        exp = df.select("id", F.ntile(5).over(Window.orderBy("m", "id")).alias("e"))
        j = got.join(exp, "id")
        assert j.count() == n
        assert j.filter(F.col("b") != F.col("e")).count() == 0


def test_values_keep_their_precision(spark):
    """Nullable bigints above 2^53, a hot group and a NULL group; one plan at every size."""
    rows = [(i, None if i % 7 == 0 else 0 if i % 5 < 2 else i % 4, i % 9, None if i % 3 == 0 else 2**53 + i) for i in range(600)]
    df = spark.createDataFrame(rows, "id long, g long, v int, t long")
    got = number_rows(df, ["g"], [("v", False), ("id", True)], rank_by=["v"], lag=["t"], partitions=5)
    exp = _expected(df, ["g"], [F.col("v").desc(), "id"], F.col("v").desc())
    same = got.select("id", "g", "v", "t", "_row", "_rank", "_size", "_prev_t")
    assert sorted(map(repr, same.collect())) == sorted(
        map(repr, exp.toDF("id", "g", "v", "t", "_row", "_rank", "_size", "_prev_t").collect())
    )


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    n=st.integers(min_value=1, max_value=400),
    groups=st.integers(min_value=1, max_value=6),
    values=st.integers(min_value=1, max_value=8),
    parts=st.integers(min_value=1, max_value=9),
    seed=st.integers(min_value=0, max_value=10_000),
)
def test_number_rows_property(spark, n, groups, values, parts, seed):
    rnd = random.Random(seed)
    rows = [
        (i, rnd.choice(list(range(groups)) + [None]), rnd.randint(0, values), rnd.randint(0, 50))
        for i in range(n)
    ]
    df = spark.createDataFrame(rows, "id long, g int, v int, t long")
    got = number_rows(df, ["g"], [("v", True), ("id", False)], rank_by=["v"], lag=["t"], partitions=parts)
    exp = _expected(df, ["g"], [F.col("v").asc(), F.col("id").desc()], F.col("v").asc())
    j = got.join(exp, "id")
    bad = j.filter(
        (F.col("_row") != F.col("e_row"))
        | (F.col("_rank") != F.col("e_rank"))
        | (F.col("_size") != F.col("e_size"))
        | ~F.col("_prev_t").eqNullSafe(F.col("e_prev_t"))
    )
    assert j.count() == n and bad.count() == 0


def test_rows_are_shuffled_once(spark):
    """After the ranges are written, only aggregates (a few rows a range) are
    shuffled: below every exchange an aggregate comes before the scan."""
    df = spark.range(5000).select((F.col("id") % 7).alias("g"), "id", (F.col("id") % 100).alias("t"))
    for group in (["g"], []):
        got = number_rows(df, group, [("t", False), ("id", True)], rank_by=["t"], lag=["t"], totals=["t"], partitions=6)
        plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
        scans = [line for line in plan if "FileScan" in line]
        assert scans and all("Bucketed: true" in line for line in scans)
        for i, line in enumerate(plan):
            if "Exchange" in line and "Broadcast" not in line:
                below = next(x for x in plan[i + 1 :] if "Aggregate" in x or "FileScan" in x)
                assert "Aggregate" in below
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("kassa_ranges")]


@pytest.mark.parametrize("parts", [1, 4, 9])
def test_totals(spark, parts):
    df = spark.range(2000).select(
        F.when(F.col("id") % 3 > 0, F.lit(None)).otherwise(F.col("id") % 4).alias("g"),
        "id",
        F.when(F.col("id") % 5 > 0, (F.col("id") % 9).cast("decimal(10,2)")).alias("t"),
    )
    got = number_rows(df, ["g"], [("t", True), ("id", True)], totals=["t"], partitions=parts)
    want = df.groupBy(F.col("g").alias("h")).agg(F.sum("t").alias("s"))
    j = got.join(want, F.col("g").eqNullSafe(F.col("h")))
    assert j.count() == 2000 and j.where(~F.col("_total_t").eqNullSafe(F.col("s"))).count() == 0
