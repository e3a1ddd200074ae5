"""Staging, intermediate, marts and the daily summary on hand-written rows."""

import datetime as dt

import pytest
from conftest import dicts, utc
from pyspark.sql import functions as F

from lakeline.plans import daily, intermediate, marts, staging
from lakeline.plans.models import run_models


def joined(orders, payments):
    return intermediate.int_order_payments(
        staging.stg_orders(orders), staging.stg_payments(payments)
    )


def test_newest_version_wins(rows):
    raw = rows.orders(
        {"event_timestamp": utc("2024-01-05T03:00:00")},
        {"event_timestamp": utc("2024-01-05T03:00:01"), "status": "DELIVERED"},
        {"event_timestamp": utc("2024-01-05T03:00:00")},
    )
    out = dicts(staging.stg_orders(raw))
    assert len(out) == 1 and out[0]["status"] == "delivered"


def test_newer_version_without_amount_does_not_hide_the_older(rows):
    raw = rows.orders(
        {"total_vnd": 100},
        {"total_vnd": 0, "event_timestamp": utc("2024-01-05T04:00:00")},
    )
    assert [r["total_vnd"] for r in dicts(staging.stg_orders(raw))] == [100]


def test_equal_event_times_have_one_stable_survivor(rows):
    versions = [{"total_vnd": n, "status": s} for n in (100, 300, 200) for s in ("placed", "x")]
    for order in (versions, versions[::-1]):
        out = dicts(staging.stg_orders(rows.orders(*order)))
        assert [(r["total_vnd"], r["status"]) for r in out] == [(300, "x")]


def test_local_clock_and_lake_day_differ(rows):
    from lakeline.functions import with_event_date_parts

    raw = rows.orders({"placed_at": utc("2024-01-05T17:30:00")})
    out = dicts(staging.stg_orders(raw))[0]
    assert out["placed_at_local"] == dt.datetime(2024, 1, 6, 0, 30)
    assert out["placed_date"] == dt.date(2024, 1, 6) and out["placed_hour"] == 0
    day = dicts(with_event_date_parts(raw))[0]
    assert (day["year"], day["month"], day["day"]) == (2024, 1, 5)


def test_models_do_not_follow_the_session_zone(spark, rows):
    raw = {
        "orders": rows.orders(*({"order_id": f"o{h}", "placed_at": utc("2024-03-10T00:30:00")
                                 + dt.timedelta(hours=h)} for h in range(30))),
        "payments": rows.payments(*({"payment_id": f"p{h}", "order_id": f"o{h}", "processed_at": utc(
            "2024-03-10T00:45:00") + dt.timedelta(hours=h)} for h in range(30))),
        "rider_events": rows.riders({}),
    }
    found = []
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            models = run_models(spark, raw)
            found.append({name: sorted(str([
                c for n, c in r.asDict().items() if n != "event_timestamp"])
                for r in models[name].collect()) for name in models})
            summary = daily.daily_summary_backfill(raw["orders"], raw["payments"]).drop("processed_at")
            found[-1]["daily"] = sorted(map(str, summary.collect()))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found[0] == found[1]


def test_unpaid_order_keeps_null_payment_and_delay(rows):
    out = dicts(marts.fct_orders(joined(rows.orders({}), rows.payments({"order_id": "other"}))))
    assert len(out) == 1
    assert out[0]["payment_id"] is None and out[0]["payment_delay_seconds"] is None
    assert out[0]["is_paid"] == 0


@pytest.mark.parametrize("placed, processed, delay", [
    ("2024-01-05T03:00:10", "2024-01-05T03:00:00", 0),
    ("2024-01-05T00:00:00.900", "2024-01-05T00:00:02.100", 2),
    ("2024-01-05T03:00:00", "2024-01-05T03:02:00", 120),
])
def test_payment_delay(rows, placed, processed, delay):
    out = joined(rows.orders({"placed_at": utc(placed)}),
                 rows.payments({"processed_at": utc(processed)}))
    assert dicts(out)[0]["payment_delay_seconds"] == delay


def test_two_payments_fan_out(rows):
    fct = marts.fct_orders(joined(rows.orders({}), rows.payments({}, {"payment_id": "p2"})))
    assert fct.count() == 2


def test_meal_periods_include_their_last_hour(spark):
    from lakeline.functions import meal_period

    hours = (10, 11, 13, 14, 17, 18, 20, 21)
    df = spark.createDataFrame([(h,) for h in hours], "h int").select("h", meal_period("h"))
    found = {r[0]: r[1] for r in df.collect()}
    assert [found[h] for h in hours] == [
        "off_peak", "lunch", "lunch", "off_peak", "off_peak", "dinner", "dinner", "off_peak"]


@pytest.mark.parametrize("items", [None, "", "[]", "[{bad", '{"item_id":"a"}'])
def test_unusable_item_text_yields_no_rows(rows, items):
    assert staging.stg_order_items(rows.orders({"items": items})).count() == 0


def test_items_quoted_numbers_and_missing_ids(rows):
    text = ('[{"item_id":"a","name":"Phở","price_vnd":"65000","quantity":2},'
            '{"item_id":"","name":"x","price_vnd":1,"quantity":1},'
            '{"item_id":null,"name":"x","price_vnd":1,"quantity":1},'
            '{"name":"x","price_vnd":1,"quantity":1}]')
    out = dicts(staging.stg_order_items(rows.orders({"items": text})))
    assert [(r["item_id"], r["price_vnd"], r["line_total_vnd"]) for r in out] == [
        ("a", 65000, 130000)]


def test_items_of_replayed_orders_repeat_unless_deduplicated(rows):
    text = '[{"item_id":"a","name":"n","price_vnd":1,"quantity":1}]'
    raw = rows.orders({"items": text}, {"items": text})
    assert staging.stg_order_items(raw).count() == 2
    assert staging.stg_order_items(raw, dedup=True).count() == 1


def test_unreadable_item_number_fails_or_becomes_null(rows):
    raw = rows.orders({"items": '[{"item_id":"a","name":"n","price_vnd":"?","quantity":1}]'})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_order_items(raw).collect()
    assert dicts(staging.stg_order_items(raw, lenient=True))[0]["price_vnd"] is None


def test_rider_metrics_and_unweighted_averages(rows):
    raw = rows.riders(
        {"event_id": "a", "status": "ON_DELIVERY", "speed_kmh": 30.0, "battery_pct": 80},
        {"event_id": "b", "speed_kmh": 0.0, "battery_pct": 60},
        {"event_id": "c", "speed_kmh": 10.0, "battery_pct": 40,
         "event_timestamp": utc("2024-01-06T03:00:00")},
    )
    metrics = intermediate.int_delivery_metrics(staging.stg_riders(raw))
    by_day = {r["event_date"].day: r for r in dicts(metrics)}
    assert by_day[5]["utilization_pct"] == 50.0 and by_day[5]["min_battery_pct"] == 60
    rider = dicts(marts.dim_rider(metrics))[0]
    assert rider["lifetime_pings"] == 3 and rider["active_days"] == 2
    assert rider["avg_utilization_pct"] == 25.0 and rider["avg_speed_kmh"] == 12.5


def test_bank_transfers_are_in_no_method_column(rows):
    raw = rows.orders({}, {"order_id": "o2", "payment_method": "bank_transfer"})
    rpt = dicts(marts.rpt_hourly_revenue(marts.fct_orders(joined(raw, rows.payments({})))))[0]
    counted = sum(rpt[f"{m}_orders"] for m in marts.METHOD_COLUMNS)
    assert rpt["total_orders"] == 2 and counted == 1


def test_daily_summary_counts_unpaid_as_zero_delay(rows):
    orders = rows.orders({}, {"order_id": "o2"})
    out = dicts(daily.daily_summary(orders, rows.payments({}), "2024-01-05"))[0]
    assert out["total_orders"] == 2 and out["paid_orders"] == 1
    assert out["avg_payment_delay_seconds"] == 30.0
    assert out["batch_date"] == dt.date(2024, 1, 5)


def test_payment_of_the_next_day_is_unpaid_in_the_day_but_paid_in_the_fact(rows):
    orders = rows.orders({"placed_at": utc("2024-01-05T23:59:00")})
    payments = rows.payments({"processed_at": utc("2024-01-06T00:01:00")})
    backfill = dicts(daily.daily_summary_backfill(orders, payments))
    assert [r["paid_orders"] for r in backfill] == [0]
    assert dicts(marts.fct_orders(joined(orders, payments)))[0]["is_paid"] == 1


def test_backfill_equals_single_days(rows):
    orders = rows.orders(*[
        {"order_id": f"o{i}", "event_timestamp": utc(f"2024-01-0{5 + i % 2}T03:00:00")}
        for i in range(6)])
    payments = rows.payments(*[
        {"payment_id": f"p{i}", "order_id": f"o{i}",
         "event_timestamp": utc(f"2024-01-0{5 + i % 2}T04:00:00")} for i in range(4)])
    stamp = F.lit("2024-02-01").cast("timestamp")
    whole = daily.daily_summary_backfill(orders, payments, stamp)
    for day in ("2024-01-05", "2024-01-06"):
        on = F.to_date("event_timestamp") == F.lit(day)
        one = daily.daily_summary(orders.where(on), payments.where(on), day, stamp)
        expected = whole.where(F.col("batch_date") == F.lit(day)).select(*one.columns)
        key = lambda r: str(r)
        assert sorted(one.collect(), key=key) == sorted(expected.collect(), key=key)


def test_latest_daily_summary(rows, spark):
    orders, payments = rows.orders({}), rows.payments({})
    first = daily.daily_summary(orders, payments.limit(0), "2024-01-05",
                                F.lit("2024-01-06 00:00:00").cast("timestamp"))
    second = daily.daily_summary(orders, payments, "2024-01-05",
                                 F.lit("2024-01-06 01:00:00").cast("timestamp"))
    out = dicts(daily.latest_daily_summary(second.unionByName(first)))
    assert [r["paid_orders"] for r in out] == [1]


def test_run_models_lazy_and_stored_agree(rows, spark, tmp_path):
    raw = {
        "orders": rows.orders({}, {"order_id": "o2", "city": "hcmc"}),
        "payments": rows.payments({}),
        "rider_events": rows.riders({}),
    }
    lazy, stored = run_models(spark, raw), run_models(spark, raw, str(tmp_path))
    assert list(lazy) == list(stored) and len(lazy) == 10
    for name in ("fct_orders", "dim_restaurant", "dim_rider", "rpt_hourly_revenue"):
        assert lazy[name].columns == stored[name].columns
        assert sorted(map(str, lazy[name].collect())) == sorted(map(str, stored[name].collect()))


def test_report_of_checks_reads_staged_tables_in_buckets(spark, rows, monkeypatch):
    from lakeline.catalog import queries

    raw = {"orders": rows.orders({}), "payments": rows.payments({}), "rider_events": rows.riders({})}
    monkeypatch.setattr(queries.adapters, "raw_tables", lambda spark, sf_dir: raw)
    asked, real = [], queries.run_models
    monkeypatch.setattr(queries, "run_models",
                        lambda *a, **options: asked.append(options) or real(*a, **options))
    assert queries.dq_report(spark, "").count() == 55
    assert asked[0]["buckets"] == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_fact_of_the_loads_is_made_once(spark, rows, monkeypatch):
    from lakeline.catalog import queries

    raw = {"orders": rows.orders({}), "payments": rows.payments({}), "rider_events": rows.riders({})}
    monkeypatch.setattr(queries.adapters, "raw_tables", lambda spark, sf_dir: raw)
    fact = queries._fact(spark, "")
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Window" not in plan and fact.count() == 1
