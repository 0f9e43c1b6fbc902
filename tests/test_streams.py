"""Watermark semantics of the streaming daily sales (restart on one checkpoint)."""

from __future__ import annotations

import datetime as dt
import tempfile

from kassa.sources.driver_tables import DRIVER_SCHEMAS
from kassa.streaming import streams


def _events(spark, rows, folder):
    data = [(i, dt.datetime.fromisoformat(ts), 1, "purchase", v, "{}") for i, ts, v in rows]
    spark.createDataFrame(data, DRIVER_SCHEMAS["events"]).coalesce(1).write.mode("append").parquet(folder)


def _days(spark, sink):
    rows = streams.read_daily_sales(spark, sink).collect()
    return {str(r["day"]): (r["total_orders"], float(r["revenue"])) for r in rows}


def test_open_days_are_updated_and_late_rows_counted(spark):
    root = tempfile.mkdtemp(prefix="kassa-stream-")
    src, sink, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    # Jakarta days: 2024-01-01 17:00 UTC starts 2024-01-02
    _events(spark, [(1, "2024-01-01 03:00:00", 10.0), (2, "2024-01-01 18:00:00", 5.0), (3, "2024-01-03 12:00:00", 7.0)], src)
    assert streams.run_daily_sales(spark, src, sink, ckpt) == 0
    # the last day is there although it is still open
    assert _days(spark, sink) == {"2024-01-01": (1, 10.0), "2024-01-02": (1, 5.0), "2024-01-03": (1, 7.0)}
    # watermark = 2024-01-03 06:00: Jan 1 is closed, Jan 3 is not
    _events(spark, [(4, "2024-01-01 04:00:00", 99.0), (5, "2024-01-03 13:00:00", 1.0)], src)
    assert streams.run_daily_sales(spark, src, sink, ckpt) == 1
    assert _days(spark, sink) == {"2024-01-01": (1, 10.0), "2024-01-02": (1, 5.0), "2024-01-03": (2, 8.0)}


def test_summary_upsert_rewrites_only_touched_buckets(spark):
    from fixtures import D, make_shop

    from kassa.operators import shared

    root = tempfile.mkdtemp(prefix="kassa-upsert-")
    before = make_shop(spark, orders=[
        (1, 1, "2024-01-10 00:00:00", "completed", D("5.00")),
        (2, 2, "2024-01-11 00:00:00", "completed", D("7.00")),
    ])
    table = f"{root}/table"
    streams.write_summary_table(shared.customer_monthly_summary(before), table, buckets=4)
    # customer 1's only order is now cancelled; customer 2 gets a second order
    after = make_shop(spark, orders=[
        (1, 1, "2024-01-10 00:00:00", "cancelled", D("5.00")),
        (2, 2, "2024-01-11 00:00:00", "completed", D("7.00")),
        (3, 2, "2024-02-11 00:00:00", "completed", D("1.00")),
    ])
    streams.upsert_touched(spark, after, spark.createDataFrame([(1,), (2,)], "customer_id long"), table)
    got = sorted((r["customer_id"], str(r["order_month"]), r["order_count"]) for r in streams.read_summary_table(spark, table).collect())
    assert got == [(2, "2024-01-01", 1), (2, "2024-02-01", 1)]


def test_late_rows_of_many_batches_are_counted_exactly(spark):
    """Late rows share days, so counts after a partial aggregate would be too low.
    (With 110 batches, more than a query's own progress list holds, it gave the
    exact 321; that takes minutes.)"""
    root = tempfile.mkdtemp(prefix="kassa-stream-")
    src, sink, ckpt = f"{root}/in", f"{root}/out", f"{root}/ckpt"
    start = dt.datetime(2024, 1, 1, 18)
    rows, late, want = [], 0, {}
    for b in range(9):
        day = start + dt.timedelta(days=b)
        batch = [(day, 1.0), (day + dt.timedelta(hours=1), 2.0)]
        if b >= 3:  # three rows of the first day, closed when the third batch is done
            batch += [(start, 5.0)] * 3
            late += 3
        for when, value in batch[:2]:
            n, total = want.get(str((when + dt.timedelta(hours=7)).date()), (0, 0.0))
            want[str((when + dt.timedelta(hours=7)).date())] = (n + 1, total + value)
        rows.append([(b * 10 + i, when.isoformat(" "), v) for i, (when, v) in enumerate(batch)])
    import os
    import pyarrow as pa
    import pyarrow.parquet as pq

    os.makedirs(src)
    for b, batch in enumerate(rows):
        data = {
            "event_id": pa.array([i for i, _, _ in batch], pa.int64()),
            "ts": pa.array([dt.datetime.fromisoformat(t) for _, t, _ in batch], pa.timestamp("us")),
            "user_id": pa.array([1] * len(batch), pa.int64()),
            "event_type": ["purchase"] * len(batch),
            "value": [v for _, _, v in batch],
            "payload": ["{}"] * len(batch),
        }
        pq.write_table(pa.table(data), f"{src}/f{b:04d}.parquet")
        os.utime(f"{src}/f{b:04d}.parquet", (1_700_000_000 + b, 1_700_000_000 + b))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        got = streams.run_daily_sales(spark, src, sink, ckpt, max_files_per_trigger=1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert got == late == 18
    assert _days(spark, sink) == want
    set_aside = streams.read_late_rows(spark, sink)
    assert set_aside.count() == late and set_aside.select("batch").distinct().count() == 6
    # another run has no late rows of its own, and nothing to do
    assert streams.run_daily_sales(spark, src, sink, ckpt, max_files_per_trigger=1) == 0


def test_touched_buckets_prune_the_scan(spark, monkeypatch):
    from fixtures import D, make_shop

    from kassa.operators import shared

    shop = make_shop(spark, orders=[(i, i, "2024-01-10 00:00:00", "completed", D("5.00")) for i in range(40)])
    table = tempfile.mkdtemp(prefix="kassa-upsert-") + "/table"
    streams.write_summary_table(shared.customer_monthly_summary(shop), table, buckets=8)
    plans = []
    real = streams.materialize

    def seen(df, name):
        plans.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, name)

    monkeypatch.setattr(streams, "materialize", seen)
    streams.upsert_touched(spark, shop, spark.createDataFrame([(3,)], "customer_id long"), table)
    plan = dict(plans)["summary"]
    assert "dynamicpruning" in plan and "IN (" not in plan
    assert streams.read_summary_table(spark, table).count() == 40
