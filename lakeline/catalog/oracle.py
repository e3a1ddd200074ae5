"""DuckDB SQL for the registered queries, written against the given tables only.

Domains, labels and the list of checks are written out here on purpose: SQL that took them from
the code under test would agree with a wrong value.
"""

from __future__ import annotations

# Fixed values of the business domain.
CITIES = ("hanoi", "hcmc", "danang")
ORDER_STATUSES = ("placed", "confirmed", "preparing", "picked_up", "delivered", "cancelled")
PAYMENT_METHODS = ("cash", "momo", "vnpay", "zalopay", "bank_transfer")
PAYMENT_STATUSES = ("success", "failed", "refunded")
PLATFORMS = ("android", "ios", "web")
RIDER_STATUSES = ("available", "on_delivery", "returning")
METHOD_COLUMNS = ("momo", "vnpay", "zalopay", "cash")
MEAL_COLUMNS = ("lunch", "dinner", "off_peak")
CITY_LABELS = (("hcmc", "HCMC"), ("hanoi", "Hanoi"), ("danang", "Danang"))
METHOD_LABELS = (
    ("MoMo", "momo_orders"), ("VNPay", "vnpay_orders"),
    ("ZaloPay", "zalopay_orders"), ("Cash", "cash_orders"),
)
MEAL_LABELS = (
    ("Lunch (11-13h)", "lunch_orders"), ("Dinner (18-20h)", "dinner_orders"),
    ("Off-peak", "off_peak_orders"),
)

#: The 55 checks: model, then its unique, its filled and its bounded columns.
CHECKS = (
    ("stg_orders", "order_id",
     "order_id customer_id restaurant_id rider_id city status payment_method platform total_vnd "
     "placed_date", "city status payment_method platform"),
    ("stg_payments", "payment_id",
     "payment_id order_id amount_vnd payment_method payment_status processed_at_local",
     "payment_method payment_status"),
    ("stg_riders", "event_id", "event_id rider_id city latitude longitude rider_status",
     "city rider_status"),
    ("stg_order_items", "", "order_id item_id item_name quantity line_total_vnd", ""),
    ("int_order_payments", "order_id", "order_id", ""),
    ("int_delivery_metrics", "", "rider_id event_date", ""),
    ("fct_orders", "order_id", "order_id city placed_date total_vnd", ""),
    ("dim_restaurant", "", "restaurant_id total_orders", ""),
    ("dim_rider", "", "rider_id", ""),
    ("rpt_hourly_revenue", "", "city hour_bucket", ""),
)


def _uuid(kind: int, key: str) -> str:
    digits = f"reverse(lpad(CAST({key} AS VARCHAR), 12, '0'))"
    return f"({digits}[1:8] || '-' || {digits}[9:12] || '-4000-8000-00000000000{kind}')"


def _placed_ms(key: str) -> str:
    return f"(1704067200000 + (({key} * 7919) % 1209600) * 1000 + ({key} % 10) * 100)"


def _ts(ms: str) -> str:
    return f"make_timestamp(CAST({ms} AS BIGINT) * 1000)"


def _city(key: str) -> str:
    return f"CASE {key} % 3 WHEN 0 THEN 'hanoi' WHEN 1 THEN 'hcmc' ELSE 'danang' END"


def _secs(ts: str) -> str:
    return f"CAST(floor(epoch({ts})) AS BIGINT)"


def _half_up_1(num: str, den: str) -> str:
    """num / den rounded half up to one decimal, in whole numbers."""
    return f"((20 * ({num}) + ({den})) // (2 * ({den}))) / 10.0"


CTE: dict[str, str] = {}

CTE["base_orders"] = f"""
SELECT o.*, n.n_name, c.c_nationkey, v.ver,
       CAST(round(o_totalprice * 100) AS BIGINT) AS subtotal_vnd,
       15000 + (o_orderkey % 5) * 1000 AS delivery_fee_vnd,
       {_placed_ms('o_orderkey')} AS placed_ms
FROM orders o LEFT JOIN customer c ON o_custkey = c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
CROSS JOIN (VALUES (0), (1)) v(ver)"""

CTE["raw_orders"] = f"""
SELECT {_uuid(1, 'o_orderkey')} AS order_id,
       {_uuid(2, 'o_custkey')} AS customer_id,
       {_uuid(3, 'o_custkey % 500')} AS restaurant_id,
       {_uuid(4, 'o_orderkey % 200')} AS rider_id,
       {_city('c_nationkey')} AS city, n_name AS district,
       CASE WHEN ver = 0 THEN 'PLACED' WHEN o_orderstatus = 'F' THEN 'delivered'
            WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'CONFIRMED' END AS status,
       '[{{"item_id":"I' || o_orderkey || '","name":"' || n_name || '","price_vnd":'
           || subtotal_vnd || ',"quantity":1}}]' AS items,
       subtotal_vnd, delivery_fee_vnd, discount_vnd,
       greatest(0, subtotal_vnd + delivery_fee_vnd - discount_vnd) AS total_vnd,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'cash' WHEN '2-HIGH' THEN 'momo'
            WHEN '3-MEDIUM' THEN 'vnpay' WHEN '5-LOW' THEN 'zalopay'
            ELSE 'bank_transfer' END AS payment_method,
       CASE o_orderkey % 3 WHEN 0 THEN 'android' WHEN 1 THEN 'ios' ELSE 'web' END AS platform,
       {_ts('placed_ms')} AS placed_at,
       {_ts('placed_ms + ver * 1200000')} AS event_timestamp,
       (placed_ms + ver * 1200000) / 1000.0 AS producer_ts,
       {_ts('placed_ms + ver * 1200000 + (o_orderkey * 31) % 9000')} AS _ingested_at,
       placed_ms + ver * 1200000 AS event_ms, (o_orderkey * 31) % 9000 AS lag_ms, ver
FROM (SELECT *, CASE WHEN o_orderkey % 97 = 0 AND ver = 1 THEN subtotal_vnd + delivery_fee_vnd
                     ELSE (o_orderkey % 7) * 500 END AS discount_vnd FROM base_orders)"""

PAY_EVENT_MS = ("(1704067200000 + ((l_orderkey * 7919) % 1209600) * 1000 "
                "+ CAST(l_linenumber AS BIGINT) * 60000)")
CTE["raw_payments"] = f"""
SELECT {_uuid(5, 'l_orderkey')} AS payment_id, {_uuid(1, 'l_orderkey')} AS order_id,
       CAST(round(l_extendedprice * 100) AS BIGINT) AS amount_vnd,
       CASE l_returnflag WHEN 'A' THEN 'momo' WHEN 'N' THEN 'cash' ELSE 'vnpay' END AS method,
       CASE WHEN l_linestatus = 'F' THEN 'SUCCESS' WHEN l_returnflag = 'R' THEN 'refunded'
            ELSE 'failed' END AS status,
       CASE WHEN l_returnflag <> 'N' THEN 'GW-' || l_suppkey END AS gateway_transaction_id,
       {_ts(_placed_ms('l_orderkey') + " + CAST(l_quantity AS BIGINT) * 10000 - 200000"
            " + (l_partkey % 10) * 100")} AS processed_at,
       {_ts(PAY_EVENT_MS)} AS event_timestamp,
       CAST({PAY_EVENT_MS} AS DOUBLE) / 1000.0 AS producer_ts,
       {_ts(PAY_EVENT_MS + " + (l_partkey * 17) % 7000")} AS _ingested_at
FROM lineitem"""

CTE["raw_riders"] = f"""
SELECT {_uuid(6, 'event_id')} AS event_id, {_uuid(4, 'user_id')} AS rider_id,
       CASE WHEN event_type = 'purchase' THEN {_uuid(1, 'event_id')} END AS order_id,
       {_city('user_id')} AS city,
       10.0::DOUBLE + user_id / 128.0::DOUBLE AS latitude,
       106.0::DOUBLE + user_id / 256.0::DOUBLE AS longitude,
       CASE WHEN event_type = 'view' THEN 0.0::DOUBLE
            ELSE floor(value * 4) / 4.0::DOUBLE END AS speed_kmh,
       CASE event_type WHEN 'purchase' THEN 'ON_DELIVERY' WHEN 'view' THEN 'available'
            WHEN 'click' THEN 'returning' ELSE event_type END AS status,
       CAST(json_extract_string(props, '$.k') AS INTEGER) - ver AS battery_pct,
       ts + to_microseconds(ver * 500000) AS event_timestamp, ver
FROM events CROSS JOIN (VALUES (0), (1)) v(ver)"""


def _newest(source: str, keys: str, order: str, where: str = "TRUE") -> str:
    ordered = ", ".join(f"{c} DESC NULLS LAST" for c in order.split())
    return (f"SELECT * FROM {source} WHERE {where} QUALIFY row_number() OVER "
            f"(PARTITION BY {keys} ORDER BY {ordered}) = 1")


ORDER_VERSIONS = "event_timestamp producer_ts placed_at total_vnd status"
PAYMENT_VERSIONS = ("event_timestamp producer_ts processed_at amount_vnd status method "
                    "gateway_transaction_id")

CTE["stg_orders"] = f"""
SELECT order_id, customer_id, restaurant_id, rider_id, city, district, lower(status) AS status,
       items, subtotal_vnd, delivery_fee_vnd, discount_vnd, total_vnd,
       CAST(total_vnd AS DOUBLE) / 1000.0::DOUBLE AS total_k_vnd, payment_method, platform,
       placed_at + INTERVAL 7 HOUR AS placed_at_local,
       CAST(placed_at + INTERVAL 7 HOUR AS DATE) AS placed_date,
       CAST(hour(placed_at + INTERVAL 7 HOUR) AS INTEGER) AS placed_hour, event_timestamp
FROM ({_newest('raw_orders', 'order_id', ORDER_VERSIONS, 'total_vnd > 0')})"""

CTE["stg_payments"] = f"""
SELECT payment_id, order_id, amount_vnd,
       CAST(amount_vnd AS DOUBLE) / 1000.0::DOUBLE AS amount_k_vnd, method AS payment_method,
       lower(status) AS payment_status, gateway_transaction_id,
       processed_at + INTERVAL 7 HOUR AS processed_at_local, event_timestamp
FROM ({_newest('raw_payments', 'payment_id', PAYMENT_VERSIONS)})"""

CTE["stg_riders"] = f"""
SELECT event_id, rider_id, order_id, city, latitude, longitude, speed_kmh,
       lower(status) AS rider_status, battery_pct, event_timestamp,
       CAST(event_timestamp + INTERVAL 7 HOUR AS DATE) AS event_date,
       CAST(hour(event_timestamp + INTERVAL 7 HOUR) AS INTEGER) AS event_hour
FROM ({_newest('raw_riders', 'event_id', 'event_timestamp')})"""

CTE["items_of_raw_orders"] = """
SELECT order_id, city, CAST(placed_at + INTERVAL 7 HOUR AS DATE) AS placed_date,
       items::JSON ->> '$[0].item_id' AS item_id, items::JSON ->> '$[0].name' AS item_name,
       subtotal_vnd AS price_vnd, CAST(1 AS BIGINT) AS quantity, subtotal_vnd AS line_total_vnd
FROM raw_orders"""

CTE["stg_order_items"] = f"""
SELECT {_uuid(1, 'l_orderkey')} AS order_id, {_city('l_orderkey')} AS city,
       CAST({_ts(_placed_ms('l_orderkey'))} + INTERVAL 7 HOUR AS DATE) AS placed_date,
       CASE WHEN part_no = 0 THEN CAST(l_partkey AS VARCHAR) ELSE 'fee' END AS item_id,
       CASE WHEN part_no = 0 THEN p_name ELSE 'packing' END AS item_name,
       CASE WHEN part_no = 0 THEN price ELSE 2000 END AS price_vnd,
       CASE WHEN part_no = 0 THEN qty ELSE 2 END AS quantity,
       CASE WHEN part_no = 0 THEN price * qty ELSE 4000 END AS line_total_vnd
FROM (SELECT *, CAST(round(p_retailprice * 100) AS BIGINT) AS price,
             CAST(l_quantity AS BIGINT) AS qty
      FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber < 5)
CROSS JOIN (VALUES (0), (1)) v(part_no)"""

CTE["int_order_payments"] = f"""
SELECT o.order_id, customer_id, restaurant_id, rider_id, city, district, status AS order_status,
       total_vnd, total_k_vnd, o.payment_method, platform,
       CASE WHEN placed_hour IN (11, 12, 13) THEN 'lunch'
            WHEN placed_hour IN (18, 19, 20) THEN 'dinner' ELSE 'off_peak' END AS meal_period,
       placed_at_local, placed_date, placed_hour, payment_id, payment_status,
       amount_vnd AS payment_amount_vnd, processed_at_local,
       CASE WHEN processed_at_local IS NULL THEN NULL
            ELSE greatest(0, {_secs('processed_at_local')} - {_secs('placed_at_local')})
            END AS payment_delay_seconds
FROM stg_orders o LEFT JOIN stg_payments p ON o.order_id = p.order_id"""

CTE["int_delivery_metrics"] = f"""
SELECT rider_id, city, event_date, count(*) AS total_pings,
       count(*) FILTER (rider_status = 'on_delivery') AS delivery_pings,
       count(*) FILTER (rider_status = 'available') AS idle_pings,
       avg(speed_kmh) AS avg_speed_kmh, max(speed_kmh) AS max_speed_kmh,
       avg(battery_pct) AS avg_battery_pct, min(battery_pct) AS min_battery_pct,
       {_half_up_1("100 * count(*) FILTER (rider_status = 'on_delivery')", "count(*)")}
           AS utilization_pct
FROM stg_riders GROUP BY rider_id, city, event_date"""

CTE["fct_orders"] = """
SELECT *, CASE WHEN order_status = 'cancelled' THEN 1 ELSE 0 END AS is_cancelled,
       CASE WHEN order_status = 'delivered' THEN 1 ELSE 0 END AS is_delivered,
       CASE WHEN payment_status = 'success' THEN 1 ELSE 0 END AS is_paid
FROM int_order_payments"""

CTE["dim_restaurant"] = f"""
SELECT restaurant_id, city, count(*) AS total_orders,
       CAST(sum(total_vnd) AS BIGINT) AS total_revenue_vnd, round(avg(total_vnd)) AS avg_order_vnd,
       CAST(sum(is_delivered) AS BIGINT) AS delivered_orders,
       CAST(sum(is_cancelled) AS BIGINT) AS cancelled_orders,
       {_half_up_1("100 * CAST(sum(is_cancelled) AS BIGINT)", "count(*)")}
           AS cancellation_rate_pct,
       min(placed_date) AS first_order_date, max(placed_date) AS last_order_date
FROM fct_orders GROUP BY restaurant_id, city"""

def _mean(column: str, digits: int) -> str:
    """Average of a daily value, rounded half up in whole numbers."""
    total = f"CAST(sum(CAST(round({column} * 1e10) AS BIGINT)) AS HUGEINT)"
    days, scale = "CAST(count(*) AS HUGEINT) * 10000000000", 10**digits
    return f"CAST((2 * {scale} * {total} + {days}) // (2 * {days}) AS DOUBLE) / {scale}"


CTE["dim_rider"] = f"""
SELECT rider_id, city, CAST(sum(total_pings) AS BIGINT) AS lifetime_pings,
       {_mean('utilization_pct', 1)} AS avg_utilization_pct,
       {_mean('avg_speed_kmh', 1)} AS avg_speed_kmh,
       {_mean('avg_battery_pct', 0)} AS avg_battery_pct,
       count(DISTINCT event_date) AS active_days
FROM int_delivery_metrics GROUP BY rider_id, city"""

_METHODS = ", ".join(
    f"count(*) FILTER (payment_method = '{m}') AS {m}_orders" for m in METHOD_COLUMNS)
_MEALS = ", ".join(f"count(*) FILTER (meal_period = '{m}') AS {m}_orders" for m in MEAL_COLUMNS)
CTE["rpt_hourly_revenue"] = f"""
SELECT city, date_trunc('hour', placed_at_local) AS hour_bucket, count(*) AS total_orders,
       CAST(sum(is_delivered) AS BIGINT) AS delivered_orders,
       CAST(sum(is_cancelled) AS BIGINT) AS cancelled_orders,
       CAST(sum(total_vnd) AS BIGINT) AS total_revenue_vnd,
       round(CAST(sum(total_vnd) AS DOUBLE) / 1000.0::DOUBLE) AS total_revenue_k_vnd,
       round(avg(total_vnd)) AS avg_order_vnd, {_METHODS}, {_MEALS}
FROM fct_orders GROUP BY 1, 2"""


def _daily(payments: str) -> str:
    orders = _newest("(SELECT *, CAST(event_timestamp AS DATE) AS batch_date FROM raw_orders)",
                     "batch_date, order_id", ORDER_VERSIONS)
    pays = _newest(f"(SELECT *, CAST(event_timestamp AS DATE) AS batch_date FROM {payments})",
                   "batch_date, payment_id", PAYMENT_VERSIONS)
    return f"""
SELECT o.batch_date, o.city, o.payment_method, o.platform, count(*) AS total_orders,
       count(*) FILTER (o.status = 'delivered') AS delivered_orders,
       count(*) FILTER (o.status = 'cancelled') AS cancelled_orders,
       CAST(sum(o.total_vnd) AS BIGINT) AS gross_revenue_vnd, avg(o.total_vnd) AS avg_order_vnd,
       count(*) FILTER (p.status = 'success') AS paid_orders,
       avg(CASE WHEN p.processed_at IS NULL THEN 0
           ELSE greatest(0, {_secs('p.processed_at')} - {_secs('o.placed_at')}) END)
           AS avg_payment_delay_seconds
FROM ({orders}) o LEFT JOIN ({pays}) p
  ON o.batch_date = p.batch_date AND o.order_id = p.order_id
GROUP BY 1, 2, 3, 4"""


CTE["daily_summary"] = _daily("raw_payments")

CTE["hourly_city"] = """
SELECT city, date_trunc('hour', placed_at) AS hour, count(*) AS total_orders,
       CAST(sum(total_vnd) AS BIGINT) AS total_revenue_vnd,
       count(*) FILTER (status = 'cancelled') AS cancelled_orders
FROM raw_orders GROUP BY 1, 2"""

RANGED = ("(SELECT * FROM rpt_hourly_revenue WHERE hour_bucket BETWEEN "
          "TIMESTAMP '2024-01-03 00:00:00' AND TIMESTAMP '2024-01-10 23:00:00')")
DAY_PARTS = ("CAST(year(event_timestamp) AS INTEGER) AS year, "
             "CAST(month(event_timestamp) AS INTEGER) AS month, "
             "CAST(day(event_timestamp) AS INTEGER) AS day")
AS_OF = "TIMESTAMP '2024-01-15 00:00:00'"

USES = {
    "raw_orders": ["base_orders"],
    "stg_orders": ["raw_orders"],
    "stg_payments": ["raw_payments"],
    "stg_riders": ["raw_riders"],
    "items_of_raw_orders": ["raw_orders"],
    "int_order_payments": ["stg_orders", "stg_payments"],
    "int_delivery_metrics": ["stg_riders"],
    "fct_orders": ["int_order_payments"],
    "dim_restaurant": ["fct_orders"],
    "dim_rider": ["int_delivery_metrics"],
    "rpt_hourly_revenue": ["fct_orders"],
    "daily_summary": ["raw_orders", "raw_payments"],
    "hourly_city": ["raw_orders"],
}


def _with(needs: list[str], body: str) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for inner in USES.get(name, []):
            add(inner)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n]})" for n in ordered) + "\n" + body


def _all(name: str) -> str:
    return _with([name], f"SELECT * FROM {name}")


def _pivot(measure: str, zero: str, cast: str) -> str:
    cities = ", ".join(
        f"CAST(sum(CASE WHEN city = '{c}' THEN {measure} ELSE {zero} END) AS {cast}) "
        f'AS "{label}"' for c, label in CITY_LABELS)
    return _with(["rpt_hourly_revenue"],
                 f"SELECT hour_bucket AS time, {cities} FROM {RANGED} GROUP BY 1")


def _labels(labels, name: str) -> str:
    branches = " UNION ALL ".join(
        f"SELECT '{label}' AS {name}, CAST(sum({c}) AS BIGINT) AS orders FROM {RANGED}"
        for label, c in labels)
    return _with(["rpt_hourly_revenue"], branches)


def _quoted(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


DOMAINS = {
    "city": CITIES, "status": ORDER_STATUSES, "payment_method": PAYMENT_METHODS,
    "platform": PLATFORMS, "payment_status": PAYMENT_STATUSES, "rider_status": RIDER_STATUSES,
}


def _dq_report() -> str:
    singular = (
        ("payment_not_exceeds_order", "payment_amount_vnd", "payment_amount_vnd > total_vnd * 1.1::DOUBLE"),
        ("positive_revenue", "total_vnd", "total_vnd < 0"),
        ("valid_order_status", "order_status",
         f"order_status NOT IN ({_quoted(ORDER_STATUSES)})"),
    )
    rows, models = [], []
    for model, unique, filled, bounded in CHECKS:
        table = "items_of_raw_orders" if model == "stg_order_items" else model
        models.append(table)

        def row(check, column, failures):
            rows.append(f"SELECT '{check}' AS check_name, '{model}' AS model, "
                        f"'{column}' AS column_name, ({failures}) AS failures")

        for c in unique.split():
            row("unique", c, f"SELECT count(*) FROM (SELECT {c} FROM {table} WHERE {c} IS NOT "
                             f"NULL GROUP BY {c} HAVING count(*) > 1)")
        for c in filled.split():
            row("not_null", c, f"SELECT count(*) FROM {table} WHERE {c} IS NULL")
        for c in bounded.split():
            row("accepted_values", c,
                f"SELECT count(*) FROM {table} WHERE {c} NOT IN ({_quoted(DOMAINS[c])})")
        if model == "fct_orders":
            for name, c, condition in singular:
                row(name, c, f"SELECT count(*) FROM {table} WHERE {condition}")
    body = "SELECT *, failures = 0 AS passed FROM (" + " UNION ALL ".join(rows) + ")"
    return _with(models, body)


_LAST_WEEK = f"placed_at >= {AS_OF} - INTERVAL 7 DAY"
_LAST_MONTH = f"placed_at >= {AS_OF} - INTERVAL 30 DAY"
_SHIFTED = "event_timestamp + INTERVAL 7 DAY"
_WATERMARK = "(SELECT max(event_timestamp) - INTERVAL 1 DAY FROM raw_orders)"
_FEW_STATUSES = _quoted(ORDER_STATUSES[1:])
_HOURLY = ("SELECT city, date_trunc('hour', placed_at) AS hour, count(*) AS total_orders, "
           "CAST(sum(total_vnd) AS BIGINT) AS revenue_vnd")
_REPLACING = {
    "orders": "SELECT city, placed_at, order_id, status, total_vnd, _ingested_at FROM ("
              + _newest("raw_orders", "city, placed_at, order_id", "_ingested_at") + ")",
    "payments": "SELECT processed_at, payment_id, amount_vnd, status, _ingested_at FROM ("
                + _newest("raw_payments", "processed_at, payment_id",
                          "_ingested_at event_timestamp amount_vnd status method "
                          "gateway_transaction_id") + ")",
    "riders": "SELECT city, event_timestamp, rider_id, event_id, status, battery_pct FROM ("
              + _newest("raw_riders", "city, event_timestamp, rider_id", "event_id") + ")",
}


def oracle() -> dict[str, str]:
    sql = {name: _all(name) for name in (
        "stg_orders", "stg_payments", "stg_riders", "stg_order_items", "int_order_payments",
        "int_delivery_metrics", "fct_orders", "dim_restaurant", "dim_rider",
        "rpt_hourly_revenue", "daily_summary")}
    sql["models_as_tables"] = sql["rpt_hourly_revenue"]
    sql["int_order_payments_split"] = sql["int_order_payments"]
    sql["int_order_payments_bucketed"] = sql["int_order_payments"]
    sql["stg_order_items_variant"] = _with(["stg_order_items"], (
        "SELECT *, CASE WHEN item_id <> 'fee' THEN '{\"gift\":true}' END AS extra "
        "FROM stg_order_items"))
    sql["item_rejects"] = f"""
SELECT {_uuid(1, 'l_orderkey')} AS order_id, reason, record
FROM (SELECT l_orderkey, 'no item_id' AS reason, unnest([
          '{{"item_id":"","name":"void","price_vnd":1,"quantity":1}}',
          '{{"name":"no id","price_vnd":1,"quantity":1}}']) AS record
      FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_linenumber < 5
      UNION ALL
      SELECT l_orderkey, CASE WHEN l_returnflag = 'A' THEN 'unreadable' ELSE 'no array' END,
             CASE WHEN l_returnflag = 'A' THEN '[{{broken' ELSE '{{"item_id":"bare"}}' END
      FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE l_linenumber = 5 AND l_returnflag IN ('A', 'N'))"""
    sql["daily_summary_split"] = sql["daily_summary"]
    sql["sink_overwrite_idempotent"] = sql["daily_summary"]
    sql["daily_summary_latest"] = _with(
        ["daily_summary"],
        "SELECT *, TIMESTAMP '2024-01-20 02:00:00' AS processed_at FROM daily_summary")

    sql["dedup_batch_exact"] = _with(["raw_orders"], (
        "SELECT order_id, status, total_vnd, event_timestamp FROM ("
        + _newest("raw_orders", "order_id", ORDER_VERSIONS) + ")"))
    sql["latest_by_key"] = _with(["raw_payments"], (
        "SELECT payment_id, order_id, amount_vnd, method, status, gateway_transaction_id, "
        "processed_at, event_timestamp, producer_ts FROM ("
        + _newest("raw_payments", "payment_id", PAYMENT_VERSIONS) + ")"))
    for name, body in _REPLACING.items():
        sql[f"replacing_{name}"] = _with([f"raw_{name}"], body)
    sql["final_vs_raw"] = _with(["raw_orders"], (
        "SELECT city, count(*) AS raw_rows, count(DISTINCT order_id) AS final_rows, "
        "count(*) - count(DISTINCT order_id) AS duplicate_rows FROM raw_orders GROUP BY city"))

    sql["stream_dedup_orders"] = _with(["raw_orders"], (
        f"SELECT order_id, status, total_vnd, event_timestamp, {DAY_PARTS} FROM raw_orders"))
    sql["stream_dedup_orders_bytes"] = sql["stream_dedup_orders"]
    sql["stream_dedup_payments"] = _with(["raw_payments"], (
        f"SELECT DISTINCT payment_id, order_id, event_timestamp, {DAY_PARTS} FROM raw_payments"))
    sql["stream_dedup_riders"] = _with(["raw_riders"], (
        f"SELECT event_id, battery_pct, event_timestamp, {DAY_PARTS} FROM raw_riders"))
    sql["stream_restart_verified"] = _with(["raw_orders"], (
        "SELECT TRUE AS died, TRUE AS one_batch_again, count(*) AS stored_rows, "
        "count(*) AS state_keys, count(*) AS rows_in_either, TRUE AS all_committed, "
        "TRUE AS one_operator FROM raw_orders"))
    sql["stream_late_drop"] = _with(["raw_orders"], (
        "SELECT order_id, event_timestamp, total_vnd FROM raw_orders UNION ALL "
        f"SELECT order_id, {_SHIFTED}, total_vnd FROM raw_orders "
        f"WHERE {_SHIFTED} > {_WATERMARK}"))
    sql["stream_progress"] = _with(["raw_orders"], (
        "SELECT 2 * count(*) AS input_rows, "
        f"count(*) FILTER ({_SHIFTED} <= {_WATERMARK}) AS late_rows, "
        f"count(*) + count(*) FILTER ({_SHIFTED} > {_WATERMARK}) AS stored_rows, "
        "true AS many_batches FROM raw_orders"))
    sql["stream_skipped_batch"] = _with(["raw_orders"], (
        "SELECT 1::BIGINT AS skipped_batches, count(*) AS stored_rows, count(*) AS in_lake, "
        "1::BIGINT AS written_batches FROM raw_orders"))
    sql["compact_outcomes"] = _with(["raw_orders"], (
        "SELECT step, CASE WHEN step = 'absent' THEN 0 ELSE n END AS total_rows, outcome "
        "FROM (VALUES ('first', 'compacted'), ('again', 'already_compact'), "
        "('absent', 'no_data')) s(step, outcome), (SELECT count(*) AS n FROM raw_orders "
        "WHERE CAST(event_timestamp AS DATE) = DATE '2024-01-05')"))
    sql["stream_accounting"] = _with(["raw_orders"], (
        "SELECT CAST(sum(2 + again) AS BIGINT) AS input_rows, count(*) FILTER (good) AS stored_rows, "
        "count(*) FILTER (good AND again = 1) AS late_rows, "
        "count(*) FILTER (good) AS duplicate_rows, "
        "CAST(sum(2 + again) FILTER (NOT good) AS BIGINT) AS quarantined_rows, "
        "count(*) FILTER (good) AS in_lake, "
        "CAST(sum(2 + again) FILTER (NOT good) AS BIGINT) AS in_quarantine, "
        "true AS over_100_batches, true AS nothing_lost FROM ("
        "SELECT status NOT IN ('cancelled', 'CONFIRMED') AS good, "
        "CASE WHEN CAST(event_timestamp AS DATE) = (SELECT min(CAST(event_timestamp AS DATE)) "
        "FROM raw_orders) THEN 1::BIGINT ELSE 0::BIGINT END AS again FROM raw_orders)"))
    for name in ("stream_hourly_city", "stream_hourly_partials", "stream_hourly_levels",
                 "hourly_city_batch"):
        sql[name] = _all("hourly_city")
    sql["stream_typed_ingest"] = _with(["raw_orders"], (
        "SELECT order_id, customer_id, status, total_vnd, placed_at, event_timestamp "
        "FROM raw_orders"))
    sql["typed_payment_ingest"] = sql["stream_typed_payments"] = _with(["raw_payments"], (
        "SELECT payment_id, order_id, amount_vnd, method, processed_at, event_timestamp "
        "FROM raw_payments"))
    sql["typed_rider_ingest"] = sql["stream_typed_riders"] = _with(["raw_riders"], (
        "SELECT event_id, rider_id, order_id, speed_kmh, battery_pct, "
        "date_trunc('milliseconds', event_timestamp) AS event_timestamp FROM raw_riders"))
    sql["stream_quarantine"] = _with(["raw_orders"], (
        "SELECT CASE status WHEN 'cancelled' THEN 'missing city' ELSE 'unreadable' END AS reason, "
        "count(*) AS records, count(*) AS kept_lines FROM raw_orders "
        "WHERE status IN ('cancelled', 'CONFIRMED') GROUP BY 1"))

    loaded = "SELECT order_id, status, total_vnd, event_timestamp FROM raw_orders"
    sql["load_day_append"] = _with(["raw_orders"], f"{loaded} UNION ALL {loaded}")
    sql["load_day_replace"] = _with(["raw_orders"], loaded)
    sql["load_day_missing"] = _with(["raw_payments"], (
        "SELECT '2024-01-20' AS load_date, count(*) AS rows_loaded FROM raw_payments "
        "UNION ALL SELECT '2024-01-21', 0"))
    sql["compact_partition"] = _with(["raw_orders"], (
        f"SELECT order_id, event_timestamp, status, total_vnd, {DAY_PARTS} FROM raw_orders"))
    sql["read_day_pruned"] = _with(["raw_orders"], (
        "SELECT order_id, event_timestamp, status FROM raw_orders "
        "WHERE CAST(event_timestamp AS DATE) = DATE '2024-01-05'"))
    sql["table_stats"] = _with(["raw_orders"], (
        f"SELECT {DAY_PARTS}, count(*) AS total_rows, TRUE AS has_files, TRUE AS has_bytes "
        "FROM raw_orders GROUP BY 1, 2, 3"))

    early = "placed_date < DATE '2024-01-08' AND order_status = 'confirmed'"
    sql["fct_upsert"] = _with(["fct_orders"], f"""
SELECT order_id, CASE WHEN {early} THEN 'delivered' ELSE order_status END AS order_status,
       CASE WHEN {early} THEN 1 ELSE is_delivered END AS is_delivered,
       CAST(CASE WHEN {early} THEN placed_date + 20 ELSE placed_date END AS DATE) AS placed_date,
       total_vnd FROM fct_orders""")
    sql["fct_incremental_lookback"] = _with(["fct_orders"], """
SELECT order_id, CASE WHEN placed_at_local < (SELECT max(placed_at_local) - INTERVAL 10 MINUTE
           FROM fct_orders WHERE placed_date < DATE '2024-01-10') THEN 'placed'
       ELSE order_status END AS order_status, placed_date FROM fct_orders""")
    sql["fct_incremental_run"] = sql["fct_incremental_lookback"]
    sql["fct_schema_evolve"] = _with(["fct_orders"], """
SELECT order_id, platform,
       CASE WHEN placed_date >= DATE '2024-01-08' THEN platform END AS channel FROM fct_orders""")

    sql["q_hourly_revenue_7d"] = _with(["raw_orders"], f"""
{_HOURLY}, avg(delivery_fee_vnd) AS avg_delivery_fee,
       CAST(count(*) FILTER (status = 'cancelled') AS DOUBLE) / count(*) AS cancellation_rate
FROM raw_orders WHERE {_LAST_WEEK} GROUP BY 1, 2""")
    sql["q_hourly_volume_7d"] = _with(
        ["raw_orders"], f"{_HOURLY} FROM raw_orders WHERE {_LAST_WEEK} GROUP BY 1, 2")
    sql["q_method_share_30d"] = _with(["raw_orders"], f"""
SELECT city, payment_method, count(*) AS orders, CAST(sum(total_vnd) AS BIGINT) AS revenue_vnd
FROM raw_orders WHERE {_LAST_MONTH} GROUP BY 1, 2""")
    sql["q_district_30d"] = _with(["raw_orders"], f"""
SELECT city, district, count(*) AS orders, avg(total_vnd) AS avg_order_value_vnd
FROM raw_orders WHERE {_LAST_MONTH} GROUP BY 1, 2""")
    sql["q_total_count"] = _with(["raw_orders"], "SELECT count(*) AS total FROM raw_orders")
    sql["q_city_count"] = _with(
        ["raw_orders"], "SELECT city, count(*) AS orders FROM raw_orders GROUP BY city")
    sql["q_join_paid_by_city"] = _with(["raw_orders", "raw_payments"], """
SELECT o.city, count(*) AS orders, CAST(sum(p.amount_vnd) AS BIGINT) AS paid
FROM raw_orders o JOIN raw_payments p ON o.order_id = p.order_id GROUP BY o.city""")
    sql["q_hour_of_day"] = _with(["raw_orders"], """
SELECT CAST(hour(placed_at + INTERVAL 7 HOUR) AS INTEGER) AS hr, count(*) AS orders
FROM raw_orders GROUP BY 1""")
    sql["q_daily_revenue_utc"] = _with(["raw_orders"], """
SELECT CAST(placed_at AS DATE) AS d, CAST(sum(total_vnd) AS BIGINT) AS rev, count(*) AS orders
FROM raw_orders GROUP BY 1""")
    sql["q_city_revenue_m"] = _with(["fct_orders"], """
SELECT city, count(*) AS orders, CAST(sum(total_vnd) AS DOUBLE) / 1e6 AS rev_m
FROM fct_orders GROUP BY city""")
    sql["q_fact_join_report"] = _with(["fct_orders", "rpt_hourly_revenue"], """
SELECT f.placed_date, count(*) AS orders, r.total_revenue_vnd
FROM fct_orders f JOIN rpt_hourly_revenue r ON f.placed_date = CAST(r.hour_bucket AS DATE)
GROUP BY f.placed_date, r.total_revenue_vnd
ORDER BY f.placed_date, r.total_revenue_vnd LIMIT 10""")
    sql["q_city_hour_pattern"] = _with(["fct_orders"], """
SELECT placed_hour, avg(total_vnd) AS avg_order, count(*) AS orders
FROM fct_orders WHERE city = 'hcmc' GROUP BY placed_hour""")
    sql["q_report_latest"] = _with(
        ["rpt_hourly_revenue"],
        "SELECT city, hour_bucket, total_revenue_vnd, total_orders FROM rpt_hourly_revenue")

    sql["d_orders_pivot"] = _pivot("total_orders", "0", "BIGINT")
    sql["d_revenue_pivot"] = _pivot("total_revenue_k_vnd", "0", "DOUBLE")
    sql["d_totals"] = _with(["rpt_hourly_revenue"], f"""
SELECT CAST(sum(total_orders) AS BIGINT) AS total_orders,
       sum(total_revenue_k_vnd) AS total_revenue_k_vnd FROM {RANGED}""")
    rate = _half_up_1("100 * CAST(sum(cancelled_orders) AS BIGINT)",
                      "CAST(sum(total_orders) AS BIGINT)")
    sql["d_cancel_rate"] = _with(["rpt_hourly_revenue"], f"""
SELECT value, CASE WHEN value >= 20 THEN 'alert' WHEN value >= 10 THEN 'warn' ELSE 'ok' END
       AS status FROM (SELECT {rate} AS value FROM {RANGED})""")
    sql["d_avg_order"] = _with(["rpt_hourly_revenue"], f"""
SELECT {_half_up_1("CAST(sum(total_revenue_k_vnd) AS BIGINT)",
                   "CAST(sum(total_orders) AS BIGINT)")} AS value FROM {RANGED}""")
    sql["d_payment_methods"] = _labels(METHOD_LABELS, "method")
    sql["d_meal_periods"] = _labels(MEAL_LABELS, "period")
    sql["d_freshness"] = _with(["fct_orders"], f"""
SELECT seconds_stale, CASE WHEN seconds_stale >= 300 THEN 'alert'
       WHEN seconds_stale >= 60 THEN 'warn' ELSE 'ok' END AS status
FROM (SELECT {_secs("TIMESTAMP '2024-01-15 07:00:00'")} - {_secs('max(placed_at_local)')}
      AS seconds_stale FROM fct_orders WHERE placed_date >= DATE '2024-01-14')""")

    sql["m_latency_percentiles"] = _with(["raw_orders"], """
SELECT city, count(*) AS samples,
       round(quantile_cont(CAST(lag_ms AS DOUBLE), 0.5) / 1000.0, 6) AS p50_seconds,
       round(quantile_cont(CAST(lag_ms AS DOUBLE), 0.95) / 1000.0, 6) AS p95_seconds
FROM raw_orders GROUP BY city""")
    sql["m_throughput_per_min"] = _with(["raw_orders"], """
SELECT city, count(*) AS minutes, CAST(sum(n) AS BIGINT) AS total_rows,
       avg(n) AS rows_per_minute, max(n) AS peak_rows,
       CAST(date_diff('minute', min(minute), max(minute)) + 1 AS BIGINT) AS elapsed_minutes,
       CAST(sum(n) AS DOUBLE) / (date_diff('minute', min(minute), max(minute)) + 1)
         AS rows_per_elapsed_minute
FROM (SELECT city, date_trunc('minute', event_timestamp) AS minute, count(*) AS n
      FROM raw_orders GROUP BY 1, 2) GROUP BY city""")
    counted = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS n FROM {cte}" for name, cte in
        (("orders", "raw_orders"), ("payments", "raw_payments"), ("rider_events", "raw_riders")))
    sql["m_readable_counts"] = _with(["raw_orders", "raw_payments", "raw_riders"], f"""
SELECT table_name, CASE WHEN n >= 1e9 THEN printf('%.2f billion', n / 1e9)
       WHEN n >= 1e6 THEN printf('%.2f million', n / 1e6)
       WHEN n >= 1e3 THEN printf('%.2f thousand', n / 1e3)
       ELSE printf('%.2f', n * 1.0::DOUBLE) END AS total_rows FROM ({counted})""")
    sql["m_backlog_alerts"] = """
WITH s AS (SELECT event_type AS subscription, ts, CAST(floor(value * 200) AS BIGINT) AS backlog,
                  event_id FROM events),
p AS (SELECT *, lag(backlog) OVER (PARTITION BY subscription ORDER BY ts, event_id)
      AS previous_backlog FROM s)
SELECT *, 'HIGH_BACKLOG' AS alert FROM p WHERE backlog > 50000
UNION ALL SELECT *, 'GROWING_BACKLOG' FROM p
WHERE previous_backlog > 5000 AND backlog > previous_backlog"""
    sql["m_counter_rate"] = """
WITH p AS (SELECT event_type AS metric, ts, CAST(event_id % 1000 AS DOUBLE) AS value,
                  lag(CAST(event_id % 1000 AS DOUBLE)) OVER
                      (PARTITION BY event_type, user_id ORDER BY ts, event_id) AS previous
           FROM events),
i AS (SELECT metric, date_trunc('hour', ts) AS window_start,
             sum(CASE WHEN value >= previous THEN value - previous ELSE value END) AS increase
      FROM p WHERE previous IS NOT NULL GROUP BY 1, 2)
SELECT metric, window_start, increase, increase / 3600.0::DOUBLE AS rate FROM i"""
    # Steps are generated and samples looked up, series by series.
    sql["m_range_rate"] = """
WITH s AS (SELECT event_type AS metric, user_id, ts, event_id,
                  CAST(event_id % 1000 AS DOUBLE) AS value FROM events),
steps AS (SELECT to_timestamp(unnest(range(
              CAST(epoch(date_trunc('day', min(ts))) AS BIGINT),
              CAST(epoch(max(ts)) AS BIGINT) + 86401, 21600))) AT TIME ZONE 'UTC' AS evaluated_at FROM s),
inside AS (
  SELECT metric, user_id, evaluated_at, ts, event_id, value,
         lag(value) OVER w AS previous, row_number() OVER w AS place,
         count(*) OVER (PARTITION BY metric, user_id, evaluated_at) AS n
  FROM steps JOIN s ON s.ts > evaluated_at - INTERVAL 24 HOURS AND s.ts <= evaluated_at
  WINDOW w AS (PARTITION BY metric, user_id, evaluated_at ORDER BY ts, event_id)),
ends AS (
  SELECT metric, user_id, evaluated_at, any_value(n) AS n,
         max(value) FILTER (place = 1) AS first, max(value) FILTER (place = n) AS last,
         epoch_us(min(ts)) / 1e6 AS first_at, epoch_us(max(ts)) / 1e6 AS last_at,
         coalesce(sum(previous) FILTER (value < previous), 0) AS lost
  FROM inside GROUP BY ALL),
spans AS (
  SELECT *, last - first + lost AS increase, last_at - first_at AS span,
         (last_at - first_at) / (n - 1) AS mean,
         first_at - (epoch_us(evaluated_at) / 1e6 - 86400) AS before, epoch_us(evaluated_at) / 1e6 - last_at AS after
  FROM ends WHERE n > 1 AND last_at > first_at),
reaches AS (
  SELECT *, CASE WHEN before < 1.1 * mean THEN before ELSE mean / 2 END AS to_start,
         CASE WHEN after < 1.1 * mean THEN after ELSE mean / 2 END AS to_end,
         CASE WHEN increase > 0 THEN span * first / increase END AS to_zero
  FROM spans)
SELECT metric, evaluated_at, count(*) AS series,
       round(sum(increase * (span + least(to_start, coalesce(to_zero, to_start)) + to_end)
                 / span / 86400), 9) AS rate
FROM reaches GROUP BY metric, evaluated_at"""
    in_range = ("placed_at >= TIMESTAMP '2024-01-03 06:00:00' "
                "AND placed_at < TIMESTAMP '2024-01-09 18:00:00'")
    millis = ("CAST(round((epoch_us(_ingested_at) - CAST(round(producer_ts * 1e6) AS BIGINT)) "
              "/ 1000.0::DOUBLE) AS BIGINT)")
    sql["m_latency_sketches"] = _with(["raw_orders"], (
        f"SELECT city, count(*) AS samples, min({millis}) AS low, max({millis}) AS high, "
        f"TRUE AS ranks_are_right FROM raw_orders WHERE {in_range} GROUP BY city"))
    sql["final_vs_raw_sketches"] = _with(["raw_orders"], (
        "SELECT city, count(*) AS raw_rows, count(DISTINCT order_id) AS final_rows, "
        f"TRUE AS estimate_is_near FROM raw_orders WHERE {in_range} GROUP BY city"))
    sql["fct_key_ranges"] = _with(["fct_orders"], (
        "SELECT CAST(placed_date AS VARCHAR) AS placed_date, count(*) AS total_rows, "
        "min(order_id) AS low_key, max(order_id) AS high_key FROM fct_orders "
        "GROUP BY placed_date"))
    days_of = "SELECT *, CAST(placed_at AS DATE) AS day FROM raw_orders"
    summed = "day, count(*) AS total_rows, CAST(sum(total_vnd) AS BIGINT) AS total_vnd"
    sql["table_versions"] = _with(["raw_orders"], f"""
SELECT 1 AS version, {summed} FROM ({days_of}) WHERE day < DATE '2024-01-08' GROUP BY day
UNION ALL SELECT 2, {summed} FROM ({days_of}) GROUP BY day
UNION ALL SELECT 3, {summed} FROM ({days_of})
WHERE day >= DATE '2024-01-08' OR status = 'PLACED' OR day NOT IN (
  SELECT day FROM ({days_of}) WHERE status = 'PLACED' AND day < DATE '2024-01-08') GROUP BY day""")
    sql["m_gauge_rollup"] = """
SELECT event_type AS metric, date_trunc('hour', ts) AS window_start,
       avg(CAST(event_id % 1000 AS DOUBLE)) AS avg_value,
       min(CAST(event_id % 1000 AS DOUBLE)) AS min_value,
       max(CAST(event_id % 1000 AS DOUBLE)) AS max_value, count(*) AS samples
FROM events GROUP BY 1, 2"""
    sql["m_lag_by_group"] = """
WITH l AS (SELECT event_type AS metric, CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start,
                  CAST(event_id % 1000 AS DOUBLE) AS value FROM events
           QUALIFY row_number() OVER (PARTITION BY event_type, user_id, date_trunc('day', ts)
                                      ORDER BY ts DESC, event_id DESC) = 1)
SELECT metric, window_start, sum(value) AS value FROM l GROUP BY 1, 2"""
    sql["m_used_percent"] = _with(["raw_riders"], """
SELECT city, round((1 - count(*) FILTER (status = 'available') / CAST(count(*) AS DOUBLE)) * 100,
                   6) AS used_pct FROM raw_riders GROUP BY city""")

    statuses = ", ".join(f"'{x}'" for x in ORDER_STATUSES[1:])
    failing = [("not_null", "payment_amount_vnd", "payment_amount_vnd IS NULL"),
               ("payment_not_exceeds_order", "payment_amount_vnd",
                "payment_amount_vnd > total_vnd * 0.5"),
               ("positive_revenue", "total_vnd", "total_vnd < 5000000"),
               ("valid_order_status", "order_status", f"order_status NOT IN ({statuses})")]
    twice = ("(SELECT * FROM fct_orders UNION ALL SELECT * FROM fct_orders WHERE "
             "placed_date < DATE '2024-01-08' AND order_status = 'confirmed')")
    sql["dq_incremental"] = _with(["fct_orders"], " UNION ALL ".join(
        [f"SELECT '{name}' AS check_name, '{column}' AS column_name, "
         f"count(*) FILTER ({fails}) AS failures FROM {twice}" for name, column, fails in failing]
        + [f"SELECT 'unique', 'order_id', count(*) FROM (SELECT order_id FROM {twice} "
           "GROUP BY order_id HAVING count(*) > 1)"]))

    def one_check(check, column, failures, needs):
        return _with(needs, f"SELECT '{check}' AS check_name, '{column}' AS column_name, "
                            f"({failures}) AS failures")

    sql["dq_unique"] = one_check(
        "unique", "payment_id",
        "SELECT count(*) FROM (SELECT payment_id FROM raw_payments GROUP BY 1 "
        "HAVING count(*) > 1)", ["raw_payments"])
    nullable = ("order_id", "payment_id", "processed_at_local", "payment_delay_seconds")
    sql["dq_not_null"] = _with(["int_order_payments"], " UNION ALL ".join(
        f"SELECT 'not_null' AS check_name, '{c}' AS column_name, "
        f"count(*) FILTER ({c} IS NULL) AS failures FROM int_order_payments" for c in nullable))
    sql["dq_accepted_values"] = one_check(
        "accepted_values", "rider_status",
        f"SELECT count(*) FROM stg_riders WHERE rider_status NOT IN ({_quoted(RIDER_STATUSES)})",
        ["stg_riders"])
    sql["dq_accepted_methods"] = one_check(
        "accepted_values", "payment_method",
        "SELECT count(*) FROM stg_orders WHERE payment_method NOT IN "
        f"({_quoted(PAYMENT_METHODS[:3])})", ["stg_orders"])
    for name, condition in (
        ("dq_payment_cap", "payment_amount_vnd > total_vnd * 0.5::DOUBLE"),
        ("dq_positive_revenue", "total_vnd < 0"),
        ("dq_revenue_floor", "total_vnd < 5000000"),
        ("dq_valid_status", f"order_status NOT IN ({_FEW_STATUSES})"),
    ):
        sql[name] = _with(["fct_orders"], (
            f"SELECT count(*) AS failures FROM fct_orders WHERE {condition} HAVING count(*) > 0"))
    sql["dq_report"] = _dq_report()
    return sql
