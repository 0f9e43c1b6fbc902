"""Output formats, snapshot behaviour, time helpers, layout and streams."""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import tempfile

from fixtures import D, make_shop, rows
from kassa.functions import timeutil as tu
from kassa.operators import daily_summary, shared, trend
from kassa.sinks import outputs


def _tmp():
    return tempfile.mkdtemp(prefix="kassa-test-")


def test_report_key_cases():
    cases = {
        "Revenue vs Avg %": "revenue_vs_avg_pct",
        "Top 20% in Category": "top_20_pct_in_category",
        "Revenue 7d Avg": "revenue_7d_avg",
        "Days Until Stock-out": "days_until_stock_out",
        "R": "r",
    }
    for title, key in cases.items():
        assert outputs.report_key(title) == key


def test_yesterday_in_jakarta():
    assert tu.yesterday_in(dt.datetime(2026, 9, 28, 17, 30)) == dt.date(2026, 9, 28)
    assert tu.yesterday_in(dt.datetime(2026, 9, 28, 16, 59)) == dt.date(2026, 9, 27)


def _sheet(spark):
    return spark.createDataFrame(
        [(dt.date(2023, 2, 28), 7, 1234.5, 12.25, 'say "hi"; bye, then'), (dt.date(2023, 3, 1), 2, 0.005, None, None)],
        "Day date, Parcels long, `Net Weight` double, `Gain %` double, Remark string",
    )


def test_report_csv_format(spark):
    path = _tmp() + "/csv"
    outputs.report_csv(_sheet(spark).coalesce(1), path)
    text = open(glob.glob(path + "/part-*.csv")[0]).read()
    first, *lines = text.splitlines()
    assert first == "Day,Parcels,Net Weight,Gain %,Remark"
    assert lines[0].startswith("2023-02-28,7,1234.50,12.25,") and "hi" in lines[0]
    assert lines[1].startswith("2023-03-01,2,0.0") and lines[1].endswith(",,")


def test_report_json_rows_keep_nulls_and_order(spark):
    path = _tmp() + "/json"
    outputs.report_json(_sheet(spark).coalesce(1), path, "Parcels")
    lines = open(glob.glob(path + "/rows/part-*.json")[0]).read().splitlines()
    assert lines[0].startswith('{"day":"2023-02-28","parcels":7')
    assert json.loads(lines[1])["gain_pct"] is None
    header = json.loads(open(glob.glob(path + "/header/part-*.json")[0]).read())
    assert header == {"report": "Parcels", "columns": ["day", "parcels", "net_weight", "gain_pct", "remark"]}


def test_report_titles_yes_no(spark):
    df = spark.createDataFrame([(True,), (False,)], "is_top_20_pct_in_category boolean")
    cols = [("Top 20% in Category", "is_top_20_pct_in_category")]
    outputs.REPORT_SHEETS["_flag"] = ("Flag", cols)
    try:
        got = outputs.report_titles(df, "_flag")
        assert got.columns == ["Top 20% in Category"]
        assert [r[0] for r in got.collect()] == ["Yes", "No"]
    finally:
        del outputs.REPORT_SHEETS["_flag"]


def test_daily_payload_exact_money_and_null_category(spark):
    s = make_shop(spark, orders=[(1, 1, "2024-11-29 03:00:00", "completed", D("125000.50"))])
    summary = daily_summary.daily_sales_summary(s, dt.date(2024, 11, 29))
    got = outputs.daily_sales_payload(summary, dt.date(2024, 11, 29), dt.datetime(2024, 11, 30, 1, 2, 3, 999))
    doc = got.collect()[0][0]
    assert doc == (
        '{"report_type":"daily_sales","date":"2024-11-29","data":{"total_revenue":125000.50,'
        '"total_orders":1,"average_order_value":125000.50,"top_category":null},'
        '"generated_at":"2024-11-30T01:02:03Z"}'
    )


def test_empty_day_payload(spark):
    s = make_shop(spark, orders=[(1, 1, "2024-01-01 00:00:00")])
    summary = daily_summary.daily_sales_summary(s, dt.date(2024, 11, 29))
    doc = json.loads(outputs.daily_sales_payload(summary, dt.date(2024, 11, 29)).collect()[0][0])
    assert doc["data"] == {"total_revenue": 0.0, "total_orders": 0, "average_order_value": 0.0, "top_category": None}


def test_snapshot_hit_expiry_day_and_errors(spark):
    root = _tmp()
    calls = []

    def compute():
        calls.append(1)
        return spark.createDataFrame([(len(calls),)], "n int")

    now = dt.datetime(2024, 11, 29, 3, 0)
    first = outputs.report_snapshot(spark, root, "r", {"days": 7}, compute, now=now)
    assert rows(first, "n") == [(1,)]
    hit = outputs.report_snapshot(spark, root, "r", {"days": 7}, compute, now=now + dt.timedelta(minutes=5))
    assert rows(hit, "n") == [(1,)] and len(calls) == 1
    other_args = outputs.report_snapshot(spark, root, "r", {"days": 8}, compute, now=now)
    assert rows(other_args, "n") == [(2,)]
    expired = outputs.report_snapshot(spark, root, "r", {"days": 7}, compute, now=now + dt.timedelta(minutes=11))
    assert rows(expired, "n") == [(3,)]
    # 17:00 UTC is midnight in Jakarta: a new day gets a new snapshot
    next_day = outputs.report_snapshot(spark, root, "r", {"days": 7}, compute, now=dt.datetime(2024, 11, 29, 17, 1))
    assert rows(next_day, "n") == [(4,)]

    def boom():
        raise RuntimeError("failed")

    results = outputs.snapshot_many(
        spark, root, [("bad", {}, boom), ("good", {}, compute)], now=now
    )
    assert results[0][0] == "bad" and results[0][1] is None and isinstance(results[0][2], RuntimeError)
    assert results[1][2] is None and rows(results[1][1], "n") == [(5,)]
    assert not glob.glob(os.path.join(root, "report=bad", "*"))


def test_orders_by_month_prunes_partitions(spark):
    s = make_shop(spark, orders=[(1, 1, "2024-01-31 18:00:00"), (2, 1, "2024-03-05 00:00:00")])
    path = _tmp() + "/obm"
    shared.write_orders_by_month(s, path)
    assert sorted(os.path.basename(p) for p in glob.glob(path + "/order_month=*")) == [
        "order_month=2024-02",  # 18:00 UTC on Jan 31 is Feb 1 in Jakarta
        "order_month=2024-03",
    ]
    df = shared.read_orders_by_month(spark, path).filter("order_month = '2024-03'")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-03" in plan
    assert rows(df, "id") == [(2,)]


def test_a_served_snapshot_outlives_refreshes(spark):
    root = _tmp()
    now = dt.datetime(2024, 11, 29, 3, 0)
    made = iter(range(1, 9))

    def compute():
        return spark.createDataFrame([(next(made),)], "n int")

    def serve(minutes, refresh=True):
        at = now + dt.timedelta(minutes=minutes)
        return outputs.report_snapshot(spark, root, "r", {}, compute, now=at, refresh=refresh)

    first = serve(0)
    second = serve(1)
    assert [first.collect()[0].n, second.collect()[0].n] == [1, 2]
    third = serve(2)
    assert first.collect()[0].n == 1  # an old frame still reads its folder
    assert serve(3, refresh=False).collect()[0].n == 3
    # folders that the pointer left ten minutes ago are removed
    serve(13)
    folders = glob.glob(f"{root}/**/rows-*", recursive=True)
    assert len([f for f in folders if os.path.isdir(f)]) == 2 and third.collect()[0].n == 3


def test_legacy_keys_above_32_bits(spark):
    from types import SimpleNamespace

    from kassa.operators import normalise
    from kassa.sources import legacy

    raw = spark.createDataFrame(
        [(3_000_000_011, 5_000_000_000, "F", 10.5, dt.datetime(2024, 1, 1))],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
    )
    r = normalise.normalise_legacy_orders(legacy.legacy_orders(SimpleNamespace(orders=raw))).collect()[0]
    assert (r.id, r.customer_id, r.status, r.reject_reason) == (3_000_000_011, 5_000_000_000, "completed", None)


def test_rejects_are_set_aside_and_ambiguous_names_rejected(spark):
    from kassa.operators import normalise

    cats = spark.createDataFrame([(1, "Toys"), (2, "TOYS "), (3, "Books")], "id long, name string")
    rows = [(1, "a", "toys", 1.0, 1), (2, "b", " books", 2.0, None), (3, "c", "none", 3.0, 3), (4, "d", None, 4.0, 4)]
    legacy = spark.createDataFrame(rows, "id long, name string, category string, price double, stock_quantity int")
    done = normalise.normalise_legacy_products(legacy, cats)
    got = {r.id: (r.category_id, r.reject_reason) for r in done.collect()}
    assert got == {1: (None, "ambiguous category"), 2: (3, None), 3: (None, "unknown category"), 4: (None, None)}
    path = _tmp() + "/out"
    normalise.set_aside(done, path)
    assert sorted(r.id for r in normalise.read_rejects(spark, path).collect()) == [1, 3]
    assert sorted(r.id for r in normalise.read_accepted(spark, path).collect()) == [2, 4]


def test_a_moved_order_refreshes_its_former_customer(spark):
    since = dt.datetime(2024, 11, 20)
    old = [(1, 1, "2024-11-01 00:00:00"), (2, 2, "2024-11-02 00:00:00")]
    before = shared.customer_monthly_summary(make_shop(spark, orders=old))
    moved = make_shop(
        spark,
        customers=[(1,), (2,)],
        orders=[(1, 2, "2024-11-01 00:00:00", "completed", D("10.00"), "2024-11-25 00:00:00"), (2, 2, "2024-11-02 00:00:00")],
    )
    from_ = spark.createDataFrame([(1,)], "customer_id long")
    got = shared.refresh_customer_monthly_summary(moved, before, since, moved_from=from_)
    assert got.select("customer_id").distinct().collect() == [(2,)]


def test_refresh_equals_full_recompute(spark):
    since = dt.datetime(2024, 3, 1)
    s = make_shop(spark, orders=[
        (1, 1, "2024-01-10 00:00:00", "completed", D("5.00"), "2024-01-10 00:00:00"),
        (2, 1, "2024-02-10 00:00:00", "completed", D("7.00"), "2024-03-02 00:00:00"),
        (3, 2, "2024-02-11 00:00:00", "completed", D("9.00"), "2024-02-11 00:00:00"),
        (4, 3, "2024-02-12 00:00:00", "cancelled", D("9.00"), "2024-03-05 00:00:00"),
    ])
    before = shared.summary_before(s, since)
    got = shared.refresh_customer_monthly_summary(s, before, since)
    full = shared.customer_monthly_summary(s)
    cols = ("customer_id", "order_month", "order_count", "revenue")
    assert sorted(rows(got, *cols)) == sorted(rows(full, *cols))


def test_trend_ignores_session_time_zone(spark):
    s = make_shop(spark, orders=[(1, 1, "2024-11-28 17:00:00"), (2, 1, "2024-11-28 16:59:59")])
    base = rows(trend.sales_trend(s, 3, as_of=dt.date(2024, 11, 30)), "day", "total_orders")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        moved = rows(trend.sales_trend(s, 3, as_of=dt.date(2024, 11, 30)), "day", "total_orders")
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert base == moved


def test_month_layout_daily_summary_reads_one_month_of_lines(spark):
    s = make_shop(
        spark,
        categories=[(1, "Cat")],
        products=[(1, 1)],
        orders=[(1, 1, "2024-11-29 03:00:00"), (2, 1, "2024-10-02 03:00:00")],
        items=[(1, 1, 2, D("3.00")), (2, 1, 1, D("4.00"))],
    )
    laid_out = shared.lay_out_by_month(s, _tmp() + "/layout")
    df = daily_summary.daily_sales_summary(laid_out, dt.date(2024, 11, 29))
    assert rows(df, "total_orders", "top_category") == [(1, "Cat")]
    plan = laid_out.items_for_days(dt.date(2024, 11, 29), dt.date(2024, 11, 30))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-11" in plan


def test_month_layout_trend_prunes_order_months(spark):
    s = make_shop(spark, orders=[(1, 1, "2024-11-29 03:00:00"), (2, 1, "2024-06-02 03:00:00")])
    laid_out = shared.lay_out_by_month(s, _tmp() + "/layout2")
    got = rows(trend.sales_trend(laid_out, 3, as_of=dt.date(2024, 11, 30)), "day", "total_orders")
    assert got == rows(trend.sales_trend(s, 3, as_of=dt.date(2024, 11, 30)), "day", "total_orders")
    orders = laid_out.completed_orders_between(dt.date(2024, 11, 20), dt.date(2024, 11, 30))
    plan = orders._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "2024-11" in plan and "2024-06" not in plan.split("PartitionFilters")[1][:200]


def test_refreshers_and_a_reader_interleaved(spark):
    """Two refreshes that both saw the same manifests; a reader in between."""
    root = _tmp()
    now = dt.datetime(2024, 11, 29, 3, 0)
    served = []

    def frame(n):
        return spark.createDataFrame([(n,)], "n int")

    def serve(n, refresh=True):
        return outputs.report_snapshot(spark, root, "r", {}, lambda: frame(n), now=now, refresh=refresh)

    serve(1)

    def slow():
        # while the first refresh computes, another one starts, publishes and is read
        served.append(serve(3).collect()[0].n)
        served.append(serve(0, refresh=False).collect()[0].n)
        return frame(2)

    late = outputs.report_snapshot(spark, root, "r", {}, slow, now=now, refresh=True)
    assert served == [3, 3] and late.collect()[0].n == 2
    assert serve(0, refresh=False).collect()[0].n == 2
    numbers = sorted(os.path.basename(f) for f in glob.glob(f"{root}/**/*.json", recursive=True))
    assert numbers == [f"{i:012d}.json" for i in (1, 2, 3)]


def test_a_number_is_taken_once_and_half_written_manifests_are_passed_over(spark):
    path = _tmp() + "/key"
    record = {"rows": "x", "expires_at": dt.datetime(2024, 1, 1).isoformat()}
    assert [outputs._publish(spark, path, {**record, "n": i}) for i in range(3)] == [1, 2, 3]
    # another writer has put 4 since the folder was listed
    listed = outputs._manifests(spark, path)
    with open(f"{path}/_manifests/{4:012d}.json", "w") as f:
        f.write('{"rows": "y"')  # not complete yet
    assert outputs._manifests(spark, path) == listed
    assert outputs._publish(spark, path, record) == 5
    assert [n for n, _ in outputs._manifests(spark, path)] == [1, 2, 3, 5]
