"""The whole pipeline through its command line, twice."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from lakeline.jobs.__main__ import main, parser, yesterday
from lakeline.operators.quality import ChecksFailed
from lakeline.schemas import ORDERS, PAYMENTS, TOPICS
from lakeline.sources import lake
from lakeline.sources.landing import TooManyBadRecords
from lakeline.sources.ledger import read_table
from lakeline.streaming.metrics import read_runs

DAY = "2024-01-05"


def stamp(hour):
    return f"{DAY}T{hour:02d}:00:00Z"


def write(base, topic, name, records):
    folder = f"{base}/landing/{topic}/year=2024/month=01/day=05"
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.jsonl", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in records)


def order(i, **more):
    item = '[{"item_id":"a","name":"n","price_vnd":5,"quantity":2}]'
    return {"order_id": f"o{i}", "customer_id": "c", "restaurant_id": "r", "rider_id": "d",
            "city": "hcmc", "district": "1", "status": "delivered", "items": item,
            "subtotal_vnd": 10, "delivery_fee_vnd": 0, "discount_vnd": 0, "total_vnd": 10,
            "payment_method": "momo", "platform": "web", "placed_at": stamp(i % 10),
            "event_timestamp": stamp(i % 10), "producer_ts": 1.0, **more}


def payment(i, **more):
    return {"payment_id": f"p{i}", "order_id": f"o{i}", "amount_vnd": 10, "method": "momo",
            "status": "success", "gateway_transaction_id": None, "processed_at": stamp(i % 10 + 1),
            "event_timestamp": stamp(i % 10 + 1), "producer_ts": 1.0, **more}


def ping(i):
    return {"event_id": f"e{i}", "rider_id": "d", "order_id": None, "city": "hcmc",
            "latitude": 1.0, "longitude": 2.0, "speed_kmh": 3.0, "status": "available",
            "battery_pct": 90, "event_timestamp": stamp(i % 10), "producer_ts": 1.0}


def test_pipeline(spark, tmp_path):
    base = str(tmp_path)
    write(base, "orders", "a", [order(i) for i in range(12)] + [order(3)])
    write(base, "payments", "a", [payment(i) for i in range(8)])
    write(base, "rider_events", "a", [ping(i) for i in range(5)])
    paths = ["--landing", f"{base}/landing", "--lake", f"{base}/lake"]
    for topic in TOPICS:
        for _ in range(2):
            main(["stream", topic, *paths, "--checkpoints", f"{base}/checkpoints"])
    with open(f"{base}/landing/orders/year=2024/month=01/day=05/b.jsonl", "w") as f:
        f.write("{broken\n")
    with pytest.raises(TooManyBadRecords):
        main(["stream", "orders", *paths, "--checkpoints", f"{base}/checkpoints", "--max-bad", "0"])
    os.remove(f"{base}/landing/orders/year=2024/month=01/day=05/b.jsonl")
    assert spark.read.parquet(f"{base}/lake-quarantine/orders").count() == 1
    runs = read_runs(spark, f"{base}/lake-metrics")
    assert runs.where("job = 'stream-orders'").agg(
        F.sum("input_rows"), F.sum("stored_rows"), F.sum("duplicate_rows"),
        F.sum("quarantined_rows")).first() == (14, 12, 1, 1)
    assert lake.read_lake(spark, f"{base}/lake/orders", ORDERS).count() == 12
    assert lake.read_lake(spark, f"{base}/lake/payments", PAYMENTS).count() == 8

    done = main(["compact", "--lake", f"{base}/lake", "--date", DAY])
    assert {t: r.rows for t, r in done.items()} == {"orders": 12, "payments": 8, "rider_events": 5}

    for _ in range(2):
        main(["daily-summary", "--lake", f"{base}/lake", "--output", f"{base}/daily",
              "--date", DAY])
    summary = read_table(spark, f"{base}/daily").collect()
    assert [(r.total_orders, r.paid_orders, r.gross_revenue_vnd) for r in summary] == [(12, 8, 120)]
    assert summary[0].avg_payment_delay_seconds == 8 * 3600 / 12

    load = ["load", "--landing", f"{base}/landing", "--raw", f"{base}/raw", "--date", DAY]
    assert main(load) == {"orders": 13, "payments": 8, "rider_events": 5}
    main(load)
    transform = ["transform", "--raw", f"{base}/raw", "--warehouse", f"{base}/marts"]
    # Replayed raw rows repeat items but change no mart.
    for extra in ([], [], ["--full-refresh"], []):
        assert main(transform + extra) == 55
        fct = read_table(spark, f"{base}/marts/fct_orders")
        assert fct.count() == 12 and fct.agg(F.sum("is_paid")).first()[0] == 8
    rpt = read_table(spark, f"{base}/marts/rpt_hourly_revenue")
    assert rpt.agg(F.sum("total_orders")).first()[0] == 12


def test_transform_fails_on_a_broken_check(spark, tmp_path):
    base = str(tmp_path)
    write(base, "orders", "a", [order(1, city="saigon")])
    write(base, "payments", "a", [payment(1)])
    write(base, "rider_events", "a", [ping(1)])
    main(["load", "--landing", f"{base}/landing", "--raw", f"{base}/raw", "--date", DAY])
    with pytest.raises(ChecksFailed, match="stg_orders.city accepted_values: 1"):
        main(["transform", "--raw", f"{base}/raw", "--warehouse", f"{base}/marts"])


def test_default_date_is_yesterday_in_utc():
    args = parser().parse_args(["compact", "--lake", "x"])
    assert args.date == yesterday() and args.table == "all"
    assert dt.date.fromisoformat(args.date) < dt.datetime.now(dt.timezone.utc).date()


def test_speed_layer_and_vacuum(spark, tmp_path):
    from lakeline.sources.ledger import Ledger
    from lakeline.streaming import hourly

    base = str(tmp_path)
    line = {f.name: "x" for f in ORDERS if f.dataType.typeName() == "string"}
    line |= {f.name: 7 for f in ORDERS if f.dataType.typeName() == "long"}
    line |= {"placed_at": stamp(3), "event_timestamp": stamp(3), "producer_ts": 1.0}
    os.makedirs(f"{base}/landing/orders")
    for run in range(3):
        for k in range(2):
            with open(f"{base}/landing/orders/{run}-{k}.jsonl", "w") as f:
                f.write(json.dumps(line) + "\n{broken\n")
        main(["speed", "--landing", f"{base}/landing", "--sums", f"{base}/sums",
              "--checkpoints", f"{base}/checkpoints", "--max-files", "1", "--fan", "2"])
    (row,) = hourly.read_hourly_levels(spark, f"{base}/sums").collect()
    assert (row.city, row.total_orders, row.total_revenue_vnd) == ("x", 6, 42)
    live = Ledger(spark, f"{base}/sums").latest().of()
    assert sorted(f.part for f in live) == ["level=1", "level=2"]
    assert main(["vacuum", f"{base}/sums", "--keep", "1", "--older-than-hours", "-1"]) > 0
    assert hourly.read_hourly_levels(spark, f"{base}/sums").collect() == [row]


def test_backlog_job(spark, tmp_path):
    from lakeline.operators.series import BacklogAlerts

    at = dt.datetime(2024, 1, 5, tzinfo=dt.timezone.utc)
    spark.createDataFrame([("s", at, 10)], "subscription string, ts timestamp, backlog long"
                          ).write.parquet(f"{tmp_path}/samples")
    assert main(["backlog", "--samples", f"{tmp_path}/samples"]) == 1
    with pytest.raises(BacklogAlerts):
        main(["backlog", "--samples", f"{tmp_path}/samples", "--high", "9"])
