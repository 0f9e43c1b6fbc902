"""The stored monthly summary, refreshed by change records; layout by order."""

from __future__ import annotations

import datetime as dt
import tempfile
from decimal import Decimal as D
from pathlib import Path

import pytest
from fixtures import make_shop
from pyspark.sql import functions as F

from kassa.operators import shared
from kassa.operators import summary_table as S

CHANGE = (
    "id long, old_customer_id long, old_order_date timestamp_ntz, old_status string, old_total_amount decimal(12,2),"
    " new_customer_id long, new_order_date timestamp_ntz, new_status string, new_total_amount decimal(12,2)"
)
NONE = (None, None, None, None)


def _image(customer, day, amount, status="completed"):
    return (customer, dt.datetime.fromisoformat(f"{day}T03:00:00"), status, D(amount))


def _table(spark, rows, buckets=2):
    path = tempfile.mkdtemp(prefix="kassa-summary-") + "/table"
    orders = [(i, c, when.isoformat(" "), st, amount) for i, (c, when, st, amount) in enumerate(rows)]
    S.write_monthly_table(shared.customer_monthly_summary(make_shop(spark, orders=orders)), path, buckets)
    return path


def _rows(spark, path):
    got = S.read_monthly_table(spark, path).collect()
    return sorted((r.customer_id, str(r.order_month)[:7], r.order_count, r.revenue) for r in got)


def _files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).glob("month=*/bucket=*/*.parquet")}


def test_moved_deleted_and_redated_orders(spark):
    first = [
        _image(1, "2024-01-05", "5.00"),
        _image(1, "2024-02-05", "6.00"),
        _image(2, "2024-01-07", "7.00"),
        _image(3, "2024-03-01", "8.00"),
        _image(4, "2024-04-01", "9.00"),
    ]
    path = _table(spark, first)
    before = _files(path)
    changes = [
        (1, *first[0], *_image(2, "2024-01-05", "5.00")),  # moved to customer 2
        (2, *first[1], *_image(1, "2024-01-31", "6.00")),  # re-dated: February is left empty
        (3, *first[3], *NONE),  # deleted: so is March
        (9, *NONE, *_image(5, "2024-01-09", "1.50")),  # new
        (9, *_image(5, "2024-01-09", "1.50"), *_image(5, "2024-01-09", "2.50")),  # and re-priced in the same batch
        (10, *NONE, *_image(6, "2024-01-09", "1.00", "pending")),  # never counted
    ]
    frame = spark.createDataFrame(changes, CHANGE)
    S.apply_changes(spark, path, frame, 1)
    want = [
        (1, "2024-01", 1, D("6.00")),
        (2, "2024-01", 2, D("12.00")),
        (4, "2024-04", 1, D("9.00")),
        (5, "2024-01", 1, D("2.50")),
    ]
    assert _rows(spark, path) == want
    after = _files(path)
    april = {f: t for f, t in before.items() if "2024-04" in f}
    assert april and all(after[f] == t for f, t in april.items())  # untouched
    S.apply_changes(spark, path, frame, 1)  # run again: nothing more
    assert _rows(spark, path) == want and _files(path) == after


def test_a_broken_off_batch_is_finished_from_its_stage(spark):
    first = [_image(1, "2024-01-05", "5.00"), _image(2, "2024-01-05", "5.00")]
    path = _table(spark, first, 1)
    frame = spark.createDataFrame([(1, *first[0], *_image(1, "2024-01-06", "7.00"))], CHANGE)
    # staged and merged, but not marked as done
    S.merged_folders(spark, path, S.signed_deltas(frame)).write.parquet(f"{path}/_stage/batch=4")
    stage = spark.read.parquet(f"{path}/_stage/batch=4")
    stage.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("month", "bucket").parquet(path)
    S.apply_changes(spark, path, frame, 4)
    assert _rows(spark, path) == [(1, "2024-01", 1, D("7.00")), (2, "2024-01", 1, D("5.00"))]


def test_empty_batch_and_unknown_order(spark):
    path = _table(spark, [_image(1, "2024-01-05", "5.00")])
    before = _files(path)
    S.apply_changes(spark, path, spark.createDataFrame([], CHANGE), 1)
    assert _files(path) == before
    unknown = spark.createDataFrame([(7, *_image(9, "2024-01-05", "1.00"), *NONE)], CHANGE)
    with pytest.raises(Exception, match="does not hold"):
        S.apply_changes(spark, path, unknown, 2)
    assert _files(path) == before


def test_folders_prune_the_scan(spark):
    path = _table(spark, [_image(i, f"2024-{m:02d}-05", "5.00") for i in range(20) for m in range(1, 13)], 4)
    delta = spark.createDataFrame([(1, dt.date(2024, 5, 1), 1, D("2.00"))], "customer_id long, order_month date, order_count long, revenue decimal(38,2)")
    plan = S.merged_folders(spark, path, delta)._jdf.queryExecution().optimizedPlan().toString()
    assert "dynamicpruning" in plan and "IN (" not in plan


def test_joins_over_the_order_layout_shuffle_neither_side(spark):
    orders = [(i, i % 7, f"2024-0{1 + i % 9}-05 00:00:00", "completed", D("5.00")) for i in range(300)]
    items = [(i % 300, i % 11, 1 + i % 3, D("2.00")) for i in range(900)]
    shop = make_shop(spark, orders=orders, items=items, products=[(i, 1) for i in range(11)], categories=[(1, "c")])
    laid = shared.lay_out_by_order(shop, buckets=8)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sales = shared.product_sales(laid, as_of=dt.date(2024, 9, 1))
        plan = sales._jdf.queryExecution().executedPlan().toString()
        below = plan[plan.index("SortMergeJoin") :]
        assert "Exchange" not in below and below.count("Bucketed: true") == 2
        key = lambda r: r.product_id
        assert sorted(sales.collect(), key=key) == sorted(
            shared.product_sales(shop, as_of=dt.date(2024, 9, 1)).collect(), key=key
        )
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
