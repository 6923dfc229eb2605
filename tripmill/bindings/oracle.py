"""The SQL of every registered query, for DuckDB over the same tables."""

from __future__ import annotations

from tripmill.bindings.fixture import RAW, STARTS, TRIPS, sql
from tripmill.functions.keys import fraction_bound

_TRIPS = f"trips AS (SELECT {sql(TRIPS)} FROM events)"

_CLEAN = f"""{_TRIPS},
clean AS (
  SELECT * REPLACE (coalesce(passenger_count, 1) AS passenger_count) FROM trips
  WHERE trip_distance > 0 AND total_amount >= 0 AND coalesce(passenger_count, 1) > 0
)"""

_STANDARD = f"""{_CLEAN},
standard AS (
  SELECT *, md5(concat('42:', CAST(trip_id AS VARCHAR))) < '{fraction_bound(0.2)}' AS is_test
  FROM clean
  WHERE trip_distance > 0 AND trip_distance < 100 AND total_amount > 0 AND total_amount < 200
)"""

_FIT = f"""{_STANDARD},
model AS (
  SELECT regr_slope(total_amount, trip_distance) AS coef,
         regr_intercept(total_amount, trip_distance) AS intercept,
         regr_r2(total_amount, trip_distance) AS r2,
         CAST(count(*) AS BIGINT) AS n
  FROM standard WHERE NOT is_test
),
scored AS (
  SELECT trip_id, total_amount, coef * trip_distance + intercept AS prediction
  FROM standard, model WHERE is_test
),
score AS (
  SELECT sqrt(avg((total_amount - prediction) * (total_amount - prediction))) AS rmse,
         CAST(count(*) AS BIGINT) AS n
  FROM scored
)"""

# Third file without the fee, fourth with texts in place of numbers.
_MONTHS = f"""raw AS (SELECT event_id, ts, {sql(RAW)} FROM events),
months AS (
  SELECT * EXCLUDE (event_id, ts) REPLACE (
    CASE WHEN ts >= TIMESTAMP '{STARTS[1]}' AND ts < TIMESTAMP '{STARTS[2]}'
         THEN CAST(0 AS DOUBLE) ELSE airport_fee END AS airport_fee
  ), CASE WHEN ts < TIMESTAMP '{STARTS[0]}' THEN 'trips-1.parquet'
          WHEN ts < TIMESTAMP '{STARTS[1]}' THEN 'trips-2.parquet'
          WHEN ts < TIMESTAMP '{STARTS[2]}' THEN 'trips-3.parquet'
          ELSE 'trips-4.parquet' END AS batch
  FROM raw
),
lake AS (
  SELECT * EXCLUDE (batch) REPLACE (coalesce(passenger_count, 1) AS passenger_count) FROM months
  WHERE trip_distance > 0 AND total_amount >= 0 AND coalesce(passenger_count, 1) > 0
)"""

_FACT_COLUMNS = """CAST(VendorID AS INTEGER) AS vendor_id, tpep_pickup_datetime, tpep_dropoff_datetime,
         CAST(round_even(passenger_count, 0) AS INTEGER) AS passenger_count, trip_distance,
         CAST(round_even(RatecodeID, 0) AS INTEGER) AS rate_code_id, store_and_fwd_flag,
         CAST(PULocationID AS INTEGER) AS pulocationid,
         CAST(DOLocationID AS INTEGER) AS dolocationid,
         CAST(payment_type AS INTEGER) AS payment_type_id,
         fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge,
         total_amount, congestion_surcharge, airport_fee"""

_FACT = f"""{_MONTHS},
fact AS (SELECT {_FACT_COLUMNS} FROM lake)"""

# The rows of the three dimensions.
_PAYMENT_TYPES = """dim_payment_type(payment_type_id, payment_name) AS (VALUES
  (0, 'Unknown / System Error'), (1, 'Credit card'), (2, 'Cash'), (3, 'No charge'),
  (4, 'Dispute'), (5, 'Unknown'), (6, 'Voided trip'))"""
_RATE_CODES = """dim_rate_code(rate_code_id, rate_description) AS (VALUES
  (0, 'Unknown'), (1, 'Standard rate'), (2, 'JFK'), (3, 'Newark'),
  (4, 'Nassau or Westchester'), (5, 'Negotiated fare'), (6, 'Group ride'), (99, 'Unknown'))"""
_VENDORS = """dim_vendor(vendor_id, vendor_name) AS (VALUES
  (1, 'Creative Mobile Technologies, LLC'), (2, 'VeriFone Inc.'))"""
_DIMS = f"{_PAYMENT_TYPES}, {_RATE_CODES}, {_VENDORS}"

_ACCEPTED = """(payment_type_id IS NULL OR payment_type_id IN
    (SELECT payment_type_id FROM dim_payment_type))
  AND (rate_code_id IS NULL OR rate_code_id IN (SELECT rate_code_id FROM dim_rate_code))"""

# The chart's labels.
_LABEL = """CASE WHEN payment_type_id = 1 THEN 'Credit Card' WHEN payment_type_id = 2 THEN 'Cash'
  WHEN payment_type_id = 3 THEN 'No Charge' WHEN payment_type_id = 4 THEN 'Dispute'
  WHEN payment_type_id IN (0, 5) THEN 'Unknown' ELSE 'Autre' END"""

_COUNTS = "CAST(count(*) AS BIGINT) AS counts"
_BIN = "CAST(least(floor((total_amount - 0) / CAST(4 AS DOUBLE)), 49) AS BIGINT)"

_KPI = f"""WITH {_CLEAN}
SELECT round(sum(total_amount), 4) AS total_revenue, round(avg(trip_distance), 6) AS avg_distance,
       CAST(count(*) AS BIGINT) AS total_trips
FROM clean"""
_HOURLY = f"""WITH {_CLEAN}
SELECT CAST(extract(hour FROM tpep_pickup_datetime) AS BIGINT) AS hour, {_COUNTS}
FROM clean GROUP BY 1 ORDER BY 1"""
_PAYMENT_SHARE = f"""WITH {_CLEAN},
labels_ AS (SELECT {_LABEL} AS payment_name, {_COUNTS} FROM clean GROUP BY 1)
SELECT payment_name, counts,
       round(CAST(counts AS DOUBLE) / (SELECT count(*) FROM clean), 6) AS share
FROM labels_"""
_HISTOGRAM = f"""WITH {_CLEAN},
found AS (SELECT {_BIN} AS bin, {_COUNTS} FROM clean WHERE total_amount BETWEEN 0 AND 200 GROUP BY 1)
SELECT every.bin, CAST(0 AS DOUBLE) + every.bin * CAST(4 AS DOUBLE) AS bin_low,
       coalesce(found.counts, 0) AS counts
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(50)) every LEFT JOIN found USING (bin)"""
_TRAINED = f"""WITH {_FIT}
SELECT round(coef, 6) AS coef, round(intercept, 6) AS intercept, model.n AS n_train,
       score.n AS n_test, round(rmse, 6) AS rmse, rmse < 10 AS passed
FROM model, score"""


def _sample(columns: str, condition: str, n: int) -> str:
    return f"""WITH {_CLEAN}
SELECT {columns} FROM clean WHERE {condition}
ORDER BY md5(concat('42:', CAST(trip_id AS VARCHAR))), trip_id LIMIT {n}"""


_CLOSED = "total_amount BETWEEN 0 AND 200"
_OPEN = "trip_distance > 0 AND trip_distance < 100 AND total_amount > 0 AND total_amount < 200"


def _usage(dim: str, dim_cte: str, key: str) -> str:
    return f"""WITH {_CLEAN}, {dim_cte}
SELECT {dim}.*, (SELECT CAST(count(*) AS BIGINT) FROM clean WHERE clean.{key} = {dim}.{key}) AS counts
FROM {dim}"""


def _gate(threshold: int) -> str:
    return f"""WITH {_FIT}
SELECT round(rmse, 6) AS rmse, n, rmse < {threshold} AS passed FROM score"""


def _orphans(fact: str, fk: str, dim: str, pk: str, rule: str) -> str:
    return f"""SELECT '{rule}' AS rule, count(*) = 0 AS ok, CAST(count(*) AS BIGINT) AS bad_rows
FROM {fact} f WHERE f.{fk} IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{pk} = f.{fk})"""


def _keys(table: str, key: str) -> str:
    return f"""SELECT '{table}' AS rule, count(*) = 0 AS ok,
       CAST(coalesce(sum(copies), 0) AS BIGINT) AS bad_rows
FROM (SELECT count(*) AS copies FROM {table} GROUP BY {key} HAVING count(*) > 1)"""


_VALID = "CAST(0 AS BIGINT) AS bad_rows"

ORACLE: dict[str, str] = {
    "standardize_union": f"WITH {_MONTHS} SELECT * EXCLUDE (batch) FROM months",
    "read_months": f"WITH {_MONTHS} SELECT * FROM months",
    "concat_parts": f"""SELECT event_id, value,
  CASE WHEN ts >= TIMESTAMP '{STARTS[1]}' THEN event_type END AS event_type FROM events""",
    "clean_trips": f"WITH {_CLEAN} SELECT * FROM clean",
    "clean_counts": f"""WITH {_TRIPS}
SELECT CAST(count(*) AS BIGINT) AS raw_rows,
  CAST(count(*) FILTER (WHERE trip_distance > 0) AS BIGINT) AS after_distance,
  CAST(count(*) FILTER (WHERE trip_distance > 0 AND total_amount >= 0) AS BIGINT) AS after_amount,
  CAST(count(*) FILTER (WHERE trip_distance > 0 AND total_amount >= 0
    AND coalesce(passenger_count, 1) > 0) AS BIGINT) AS clean_rows
FROM trips""",
    "null_fill": f"""WITH {_TRIPS}
SELECT trip_id, coalesce(passenger_count, 1) AS passenger_count FROM trips""",
    "range_closed": f"WITH {_CLEAN} SELECT trip_id, total_amount FROM clean WHERE {_CLOSED}",
    "range_open": f"""WITH {_CLEAN}
SELECT trip_id, trip_distance, total_amount FROM clean WHERE {_OPEN}""",
    "range_lineitem": f"""SELECT l_returnflag, {_COUNTS} FROM lineitem
WHERE l_quantity BETWEEN 10 AND 40 AND l_discount > 0 AND l_discount < CAST(0.05 AS DOUBLE)
GROUP BY 1""",
    "land_files": " UNION ALL ".join(
        f"SELECT '{t}.parquet' AS file, true AS ok, CAST(count(*) AS BIGINT) AS rows,"
        f" CAST(sum({c}) AS BIGINT) AS content FROM {t}"
        for t, c in (
            ("events", "event_id"), ("orders", "o_custkey"), ("customer", "c_nationkey"),
            ("lineitem", "l_partkey"), ("nation", "n_regionkey"),
        )
    )
    + " UNION ALL SELECT 'no_such_table.parquet', false, NULL, NULL",
    "etl_roundtrip": f"WITH {_MONTHS} SELECT * FROM lake",
    "lifecycle_summary": f"""WITH {_DIMS}, {_MONTHS},
accepted AS (
  SELECT * FROM (SELECT *, payment_type AS payment_type_id, RatecodeID AS rate_code_id FROM months)
  WHERE {_ACCEPTED}
),
kept AS (
  SELECT * FROM accepted
  WHERE trip_distance > 0 AND total_amount >= 0 AND coalesce(passenger_count, 1) > 0
)
SELECT (SELECT CAST(count(*) AS BIGINT) FROM accepted) AS landed_rows,
  CAST(count(*) AS BIGINT) AS clean_rows, CAST(count(*) AS BIGINT) AS fact_rows,
  round(sum(total_amount), 4) AS total_revenue, round(avg(trip_distance), 6) AS avg_distance,
  CAST(count(*) FILTER (WHERE {_OPEN}) AS BIGINT) AS model_rows
FROM kept""",
    "warehouse_projection": f"WITH {_FACT} SELECT * FROM fact",
    "surrogate_key": f"""WITH {_CLEAN}
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS keys FROM clean""",
    "warehouse_roundtrip": f"WITH {_DIMS}, {_FACT} SELECT * FROM fact WHERE {_ACCEPTED}",
    "warehouse_source_key": f"""WITH {_DIMS}, raw AS (SELECT event_id, {sql(RAW)} FROM events),
lake AS (
  SELECT * REPLACE (coalesce(passenger_count, 1) AS passenger_count) FROM raw
  WHERE trip_distance > 0 AND total_amount >= 0 AND coalesce(passenger_count, 1) > 0
),
fact AS (SELECT CAST(event_id AS BIGINT) AS trip_id, {_FACT_COLUMNS} FROM lake)
SELECT * FROM fact WHERE {_ACCEPTED}""",
    "warehouse_status": f"""WITH {_CLEAN}
SELECT 'Star schema ready; code 0 is present.' AS status, CAST(count(*) AS BIGINT) AS counts
FROM clean WHERE payment_type_id = 0""",
    "enrich_trips": f"""WITH {_DIMS}, {_CLEAN}
SELECT clean.*, payment_name, rate_description, vendor_name FROM clean
LEFT JOIN dim_payment_type USING (payment_type_id)
LEFT JOIN dim_rate_code USING (rate_code_id)
LEFT JOIN dim_vendor USING (vendor_id)""",
    "enrich_counts": f"""WITH {_DIMS}, {_CLEAN}
SELECT payment_name, rate_description, {_COUNTS} FROM clean
LEFT JOIN dim_payment_type USING (payment_type_id)
LEFT JOIN dim_rate_code USING (rate_code_id)
GROUP BY 1, 2""",
    "dim_payment_type": _usage("dim_payment_type", _PAYMENT_TYPES, "payment_type_id"),
    "dim_rate_code": _usage("dim_rate_code", _RATE_CODES, "rate_code_id"),
    "dim_vendor": _usage("dim_vendor", _VENDORS, "vendor_id"),
    "kpi": _KPI,
    "kpi_lineitem": """SELECT round(sum(l_extendedprice), 2) AS total_revenue,
  round(avg(l_quantity), 6) AS avg_distance, CAST(count(*) AS BIGINT) AS total_trips
FROM lineitem""",
    "kpi_text": f"""WITH {_CLEAN}
SELECT format('${{:,.2f}}', sum(total_amount)) AS total_revenue,
  printf('%.2f miles', avg(trip_distance)) AS avg_distance,
  format('{{:,}}', count(*)) AS total_trips
FROM clean""",
    "hourly_counts": _HOURLY,
    "hourly_events": f"""SELECT CAST(extract(hour FROM ts) AS BIGINT) AS hour, {_COUNTS}
FROM events GROUP BY 1 ORDER BY 1""",
    "payment_counts": f"WITH {_CLEAN} SELECT payment_type_id, {_COUNTS} FROM clean GROUP BY 1",
    "priority_counts": f"SELECT o_orderpriority, {_COUNTS} FROM orders GROUP BY 1",
    "payment_names": f"""WITH {_CLEAN}
SELECT payment_type_id, {_LABEL} AS payment_name, {_COUNTS} FROM clean GROUP BY 1, 2""",
    "payment_labels": f"""WITH {_CLEAN}
SELECT {_LABEL} AS payment_name, {_COUNTS} FROM clean GROUP BY 1""",
    "payment_share": _PAYMENT_SHARE,
    "priority_share": f"""SELECT o_orderpriority, {_COUNTS},
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM orders), 6) AS share
FROM orders GROUP BY 1""",
    "amount_histogram": _HISTOGRAM,
    "quantity_histogram": f"""WITH found AS (
  SELECT CAST(least(floor(l_quantity / CAST(4 AS DOUBLE)), 15) AS BIGINT) AS bin, {_COUNTS}
  FROM lineitem WHERE l_quantity BETWEEN 0 AND 64 GROUP BY 1)
SELECT every.bin, every.bin * CAST(4 AS DOUBLE) AS bin_low, coalesce(found.counts, 0) AS counts
FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(16)) every LEFT JOIN found USING (bin)""",
    "trip_panels": f"""WITH {_CLEAN}, narrow AS (
  SELECT CAST(extract(hour FROM tpep_pickup_datetime) AS BIGINT) AS hour, payment_type_id,
    CASE WHEN {_CLOSED} THEN {_BIN} END AS bin, total_amount, trip_distance FROM clean)
SELECT hour, payment_type_id, bin,
  CASE WHEN grouping(hour) = 0 THEN 'hour' WHEN grouping(payment_type_id) = 0 THEN 'payment'
       ELSE 'bin' END AS panel, {_COUNTS},
  round(sum(total_amount), 4) AS amount_sum, round(sum(trip_distance), 4) AS distance_sum,
  CAST(count(trip_distance) AS BIGINT) AS distance_counts
FROM narrow GROUP BY GROUPING SETS ((hour), (payment_type_id), (bin))""",
    "panel_kpi": _KPI,
    "panel_hourly": _HOURLY,
    "panel_payment_labels": _PAYMENT_SHARE,
    "panel_histogram": _HISTOGRAM,
    "mart_tables": f"""WITH {_CLEAN}, narrow AS (
  SELECT CAST(extract(hour FROM tpep_pickup_datetime) AS BIGINT) AS hour, payment_type_id,
    CASE WHEN {_CLOSED} THEN {_BIN} END AS bin, total_amount, trip_distance FROM clean),
found AS (SELECT bin, count(*) AS counts FROM narrow WHERE bin IS NOT NULL GROUP BY 1),
amounts AS (SELECT total_amount FROM clean WHERE {_CLOSED}
  ORDER BY md5(concat('42:', CAST(trip_id AS VARCHAR))), trip_id LIMIT 100000),
scatter AS (SELECT total_amount, trip_distance FROM clean WHERE {_OPEN}
  ORDER BY md5(concat('42:', CAST(trip_id AS VARCHAR))), trip_id LIMIT 10000)
SELECT 'trip_panels' AS mart,
  concat_ws(':', CASE WHEN grouping(hour) = 0 THEN 'hour' WHEN grouping(payment_type_id) = 0
    THEN 'payment' ELSE 'bin' END, CAST(coalesce(hour, payment_type_id, bin) AS VARCHAR)) AS key,
  {_COUNTS}, round(sum(total_amount), 4) AS a, round(sum(trip_distance), 4) AS b
FROM narrow GROUP BY GROUPING SETS ((hour), (payment_type_id), (bin))
UNION ALL SELECT 'kpi', 'all', count(*), round(sum(total_amount), 4), round(avg(trip_distance), 6) FROM clean
UNION ALL SELECT 'hourly_counts', CAST(hour AS VARCHAR), count(*), NULL, NULL FROM narrow GROUP BY hour
UNION ALL SELECT 'payment_counts', concat_ws(':', CAST(payment_type_id AS VARCHAR), {_LABEL}),
  count(*), NULL, NULL FROM clean GROUP BY payment_type_id
UNION ALL SELECT 'payment_labels', {_LABEL}, count(*),
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM clean), 6), NULL FROM clean GROUP BY 2
UNION ALL SELECT 'amount_histogram', CAST(every.bin AS VARCHAR), coalesce(found.counts, 0),
  every.bin * CAST(4 AS DOUBLE), NULL
  FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(50)) every LEFT JOIN found USING (bin)
UNION ALL SELECT 'sample_amounts', 'row', NULL, total_amount, NULL FROM amounts
UNION ALL SELECT 'sample_scatter', 'row', NULL, total_amount, trip_distance FROM scatter
UNION ALL SELECT 'preview', 'rows', least(count(*), 5), NULL, NULL FROM clean""",
    "sample_amounts": _sample("total_amount", _CLOSED, 100_000),
    "sample_scatter": _sample("trip_distance, total_amount", _OPEN, 10_000),
    "sample_amounts_500": _sample("total_amount", _CLOSED, 500),
    "sample_scatter_500": _sample("trip_distance, total_amount", _OPEN, 500),
    "sample_lineitem": """SELECT l_quantity, l_extendedprice FROM lineitem
ORDER BY md5(concat('42:', l_orderkey, ':', l_linenumber, ':', l_partkey, ':', l_suppkey)),
  l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice LIMIT 10000""",
    "sample_fraction": f"""SELECT o_orderkey, o_totalprice FROM orders
WHERE md5(concat('42:', o_orderkey)) < '{fraction_bound(0.1)}'""",
    "preview": f"WITH {_CLEAN} SELECT * FROM clean ORDER BY trip_id LIMIT 5",
    "quality_report": f"""WITH {_CLEAN}, n AS (
  SELECT count(*) AS n, CAST(count(*) - count(trip_distance) AS BIGINT) AS d,
         CAST(count(*) - count(total_amount) AS BIGINT) AS a FROM clean)
SELECT 'not_empty' AS rule, n > 0 AS ok, {_VALID} FROM n
UNION ALL SELECT 'present:trip_distance', true, 0
UNION ALL SELECT 'present:total_amount', true, 0
UNION ALL SELECT 'not_null:trip_distance', d = 0, d FROM n
UNION ALL SELECT 'not_null:total_amount', a = 0, a FROM n
UNION ALL SELECT 'numeric:trip_distance', true, 0
UNION ALL SELECT 'numeric:total_amount', true, 0""",
    "quality_report_failing": f"""WITH {_TRIPS}, n AS (
  SELECT count(*) AS n, CAST(count(*) - count(passenger_count) AS BIGINT) AS p,
         CAST(count(*) - count(rate_code_id) AS BIGINT) AS r,
         CAST(count(*) - count(payment_type_id) AS BIGINT) AS t FROM trips)
SELECT 'not_empty' AS rule, n > 0 AS ok, {_VALID} FROM n
UNION ALL SELECT 'present:passenger_count', true, 0
UNION ALL SELECT 'present:rate_code_id', true, 0
UNION ALL SELECT 'present:fare', false, n FROM n
UNION ALL SELECT 'present:payment_type_id', true, 0
UNION ALL SELECT 'not_null:passenger_count', p = 0, p FROM n
UNION ALL SELECT 'not_null:rate_code_id', r = 0, r FROM n
UNION ALL SELECT 'not_null:payment_type_id', t = 0, t FROM n
UNION ALL SELECT 'numeric:passenger_count', true, 0
UNION ALL SELECT 'numeric:rate_code_id', true, 0
UNION ALL SELECT 'numeric:payment_type_id', true, 0""",
    "text_bounds": """SELECT 'max_length:o_orderstatus<=5' AS rule,
  count(*) FILTER (WHERE length(o_orderstatus) > 5) = 0 AS ok,
  CAST(count(*) FILTER (WHERE length(o_orderstatus) > 5) AS BIGINT) AS bad_rows FROM orders
UNION ALL
SELECT 'max_length:o_orderpriority<=8', count(*) FILTER (WHERE length(o_orderpriority) > 8) = 0,
  CAST(count(*) FILTER (WHERE length(o_orderpriority) > 8) AS BIGINT) FROM orders""",
    "fk_orphans": f"""WITH {_DIMS}, {_CLEAN}
SELECT 'fk_payment' AS rule, trip_id FROM clean
WHERE payment_type_id NOT IN (SELECT payment_type_id FROM dim_payment_type)
UNION ALL
SELECT 'fk_rate', trip_id FROM clean
WHERE rate_code_id NOT IN (SELECT rate_code_id FROM dim_rate_code)""",
    "fk_accepted": f"WITH {_DIMS}, {_CLEAN} SELECT * FROM clean WHERE {_ACCEPTED}",
    "fk_report": f"WITH {_DIMS}, {_CLEAN} "
    + _orphans("clean", "payment_type_id", "dim_payment_type", "payment_type_id", "fk_payment")
    + " UNION ALL "
    + _orphans("clean", "rate_code_id", "dim_rate_code", "rate_code_id", "fk_rate"),
    "fk_report_tables": " UNION ALL ".join(
        _orphans(fact, fk, dim, pk, f"{fact}.{fk}")
        for fact, fk, dim, pk in (
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
            ("orders", "o_custkey", "customer", "c_custkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"),
        )
    ),
    "pk_duplicates": """SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS copies
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
    "pk_report": _keys("lineitem", "l_orderkey, l_linenumber")
    + " UNION ALL "
    + _keys("orders", "o_orderkey"),
    "split_counts": f"""WITH {_STANDARD}
SELECT CASE WHEN is_test THEN 'test' ELSE 'train' END AS side, {_COUNTS} FROM standard GROUP BY 1""",
    "fit_line": f"""WITH {_FIT}
SELECT round(coef, 6) AS coef, round(intercept, 6) AS intercept, n, round(r2, 6) AS r2 FROM model""",
    "fit_lineitem": """SELECT round(regr_slope(l_extendedprice, l_quantity), 4) AS coef,
  round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept,
  CAST(count(*) AS BIGINT) AS n, round(regr_r2(l_extendedprice, l_quantity), 8) AS r2
FROM lineitem""",
    "predict_batch": f"""WITH {_FIT}
SELECT trip_id, total_amount, round(prediction, 6) AS prediction FROM scored""",
    "rmse_gate": _gate(10),
    "rmse_gate_failing": _gate(3),
    "fit_and_score": _TRAINED,
    "train_pipeline": _TRAINED,
    "model_roundtrip": f"""WITH {_FIT}
SELECT payment_type_id, round(sum(coef * trip_distance + intercept), 4) AS predicted_revenue
FROM clean, model GROUP BY 1""",
    "regression_curve": f"""WITH {_FIT},
grid AS (SELECT range * (CAST(25 AS DOUBLE) / 99) AS x FROM range(100))
SELECT round(x, 6) AS x, round(coef * x + intercept, 6) AS y FROM grid, model""",
    "predict_single": f"""WITH {_FIT}
SELECT CAST(2.5 AS DOUBLE) AS trip_distance, round(coef * 2.5 + intercept, 2) AS price FROM model""",
    "explain_model": f"""WITH {_FIT}
SELECT round(intercept, 2) AS base_price, round(coef, 2) AS price_per_mile,
  printf('%.2f x distance + %.2f', coef, intercept) AS formula FROM model""",
}

# The tables made batch by batch are those made at once.
ORACLE |= {
    "marts_incremental": ORACLE["mart_tables"],
    "sample_amounts_merged": ORACLE["sample_amounts_500"],
    "sample_scatter_merged": ORACLE["sample_scatter_500"],
    "train_incremental": _TRAINED,
    "atomic_replace": f"""WITH {_CLEAN}
SELECT phase, trip_id, total_amount FROM clean, (VALUES ('after failure'), ('replaced'), ('as it was')) AS p(phase)
WHERE phase = 'replaced' OR trip_id % 2 = 0""",
    "replace_months": f"""WITH {_CLEAN}, batched AS (
  SELECT *, CASE WHEN tpep_pickup_datetime >= TIMESTAMP '{STARTS[2]}' THEN 'trips-4'
    WHEN tpep_pickup_datetime >= TIMESTAMP '{STARTS[1]}' THEN 'trips-3'
    WHEN tpep_pickup_datetime >= TIMESTAMP '{STARTS[0]}' THEN 'trips-2' ELSE 'trips-1' END AS batch FROM clean)
SELECT batch, trip_id, total_amount + CASE WHEN batch = 'trips-2' THEN 1 ELSE 0 END AS total_amount
FROM batched WHERE batch <> 'trips-3'""",
}


def _nice(column: str, table: str, most: int) -> str:
    """Bins of the smallest width of 1, 2 or 5 times a power of ten that needs no more."""
    return f"""ends AS (
  SELECT min({column}) AS low, max({column}) AS high FROM {table}),
powers AS (SELECT *, floor(log10((high - low) / {most}.0::DOUBLE)) AS power FROM ends),
widths AS (
  SELECT low, high, CASE WHEN power >= 0 THEN step * pow(10.0::DOUBLE, power)
    ELSE step / pow(10.0::DOUBLE, -power) END AS width
  FROM powers, (VALUES (1::DOUBLE), (2::DOUBLE), (5::DOUBLE), (10::DOUBLE), (20::DOUBLE), (50::DOUBLE)) AS s(step)),
scale AS (
  SELECT min(width) AS width, min(floor(low / width)) FILTER (fits) AS unused FROM (
    SELECT *, floor(high / width) - floor(low / width) < {most} AS fits FROM widths) WHERE fits),
found AS (
  SELECT CAST(floor({column} / width) AS BIGINT) AS place, count(*) AS counts FROM {table}, scale GROUP BY 1),
every AS (
  SELECT width, CAST(floor(low / width) AS BIGINT) AS first,
    unnest(range(CAST(floor(low / width) AS BIGINT), CAST(floor(high / width) AS BIGINT) + 1)) AS place FROM ends, scale)
SELECT place - first AS bin, place * width AS bin_low, (place + 1) * width AS bin_high,
  CAST(coalesce(counts, 0) AS BIGINT) AS counts
FROM every LEFT JOIN found USING (place)"""


_JUDGED = f"""{_DIMS}, raw AS (SELECT event_id, {sql(RAW)} FROM events),
filled AS (
  SELECT * REPLACE (coalesce(passenger_count, 1) AS passenger_count,
    CASE WHEN event_id % 83 = 0 THEN 'too long' ELSE store_and_fwd_flag END AS store_and_fwd_flag) FROM raw),
judged AS (
  SELECT *, list_filter([
    CASE WHEN trip_distance > 0 THEN NULL ELSE 'distance' END,
    CASE WHEN total_amount >= 0 THEN NULL ELSE 'amount' END,
    CASE WHEN passenger_count > 0 THEN NULL ELSE 'passengers' END,
    CASE WHEN length(store_and_fwd_flag) > 5 THEN 'length:store_and_fwd_flag' END,
    CASE WHEN payment_type IS NOT NULL AND payment_type NOT IN (SELECT payment_type_id FROM dim_payment_type)
      THEN 'fk_payment' END,
    CASE WHEN RatecodeID IS NOT NULL AND RatecodeID NOT IN (SELECT rate_code_id FROM dim_rate_code)
      THEN 'fk_rate' END], lambda x: x IS NOT NULL) AS broken
  FROM filled)"""
_RULES = ("distance", "amount", "passengers", "length:store_and_fwd_flag", "fk_payment", "fk_rate")
_ACCEPTED_FACT = f"""{_DIMS}, {_FACT}, kept AS (SELECT * FROM fact WHERE {_ACCEPTED})"""
_MONTH_ROWS = f"""batched AS (SELECT event_id, CASE WHEN ts >= TIMESTAMP '{STARTS[2]}' THEN 4
  WHEN ts >= TIMESTAMP '{STARTS[1]}' THEN 3 WHEN ts >= TIMESTAMP '{STARTS[0]}' THEN 2 ELSE 1 END AS month FROM events),
sizes AS (SELECT month, count(*) AS n, count(*) FILTER (event_id % 2 + 1 = 1) AS vendor_1 FROM batched GROUP BY month)"""

ORACLE |= {
    "nice_amounts": f"WITH {_CLEAN}, " + _nice("total_amount", "clean", 50),
    "nice_prices": "WITH " + _nice("l_extendedprice", "lineitem", 50),
    "nice_discounts": "WITH " + _nice("l_discount", "lineitem", 20),
    "judged_trips": f"""WITH {_JUDGED}
SELECT event_id AS trip_id, trip_distance, total_amount, passenger_count, len(broken) = 0 AS accepted,
  array_to_string(broken, ',') AS broken FROM judged""",
    "reject_counts": f"WITH {_JUDGED} "
    + " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, CAST(count(*) FILTER (list_contains(broken, '{rule}')) AS BIGINT) AS rows FROM judged"
        for rule in _RULES
    )
    + " UNION ALL SELECT 'accepted', count(*) FILTER (len(broken) = 0) FROM judged"
    + " UNION ALL SELECT 'rejected', count(*) FILTER (len(broken) > 0) FROM judged",
    "reject_combinations": f"""WITH {_JUDGED}
SELECT array_to_string(broken, ',') AS broken, CAST(count(*) AS BIGINT) AS rows FROM judged GROUP BY 1""",
    "dense_trip_id": f"""WITH {_CLEAN}
SELECT row_number() OVER (ORDER BY tpep_pickup_datetime, total_amount DESC, trip_id) - 1 AS trip_id,
  trip_id AS source_id, tpep_pickup_datetime, total_amount FROM clean""",
    "land_incremental": f"""WITH {_MONTH_ROWS}
SELECT 1 AS run, 'trips-' || month || '.parquet' AS file, 'landed' AS action, n AS rows FROM sizes WHERE month < 4
UNION ALL SELECT 2, 'trips-' || month || '.parquet', 'skipped', n FROM sizes WHERE month < 4
UNION ALL SELECT 3, 'trips-' || month || '.parquet', CASE WHEN month IN (2, 4) THEN 'landed' ELSE 'skipped' END,
  CASE WHEN month = 2 THEN vendor_1 ELSE n END FROM sizes
UNION ALL SELECT 3, 'trips-5.parquet', 'failed', NULL
UNION ALL SELECT 4, 'all', 'there', CAST(sum(CASE WHEN month = 2 THEN vendor_1 ELSE n END) AS BIGINT) FROM sizes""",
    "sql_panels": f"""WITH {_ACCEPTED_FACT}
SELECT 'kpi' AS panel, 'all' AS key, {_COUNTS}, round(sum(total_amount), 4) AS value FROM kept
UNION ALL SELECT 'hourly_counts', CAST(extract(hour FROM tpep_pickup_datetime) AS VARCHAR), count(*), NULL
  FROM kept GROUP BY 2
UNION ALL SELECT 'payment_counts', concat_ws(':', CAST(payment_type_id AS VARCHAR), payment_name), count(*), NULL
  FROM kept LEFT JOIN dim_payment_type USING (payment_type_id) GROUP BY payment_type_id, payment_name
UNION ALL SELECT 'rate_counts', concat_ws(':', CAST(rate_code_id AS VARCHAR), rate_description), count(*),
  round(avg(total_amount), 6) FROM kept LEFT JOIN dim_rate_code USING (rate_code_id)
  GROUP BY rate_code_id, rate_description
UNION ALL SELECT 'vendor_counts', vendor_name, count(kept.vendor_id), NULL
  FROM dim_vendor LEFT JOIN kept USING (vendor_id) GROUP BY vendor_name
UNION ALL SELECT 'amount_histogram', CAST(every.bin AS VARCHAR), count(k.bin), NULL
  FROM (SELECT range AS bin FROM range(50)) every LEFT JOIN (
    SELECT CAST(least(floor(total_amount / 4), 49) AS BIGINT) AS bin FROM kept WHERE {_CLOSED}) k USING (bin)
  GROUP BY every.bin
UNION ALL SELECT 'scatter', CAST(CAST(trip_distance AS DECIMAL(18,6)) AS VARCHAR), NULL, total_amount
  FROM kept WHERE {_OPEN}
UNION ALL SELECT 'unknown_codes', 'both', 0, NULL""",
    "ml_pipeline": f"""WITH {_FIT}
SELECT round(coef, 6) AS coef, round(intercept, 6) AS intercept, round(rmse, 6) AS rmse, rmse < 10 AS passed
FROM model, score""",
    "ml_predictions": ORACLE["predict_batch"],
}

# What the life-cycle has seen: the months whose codes the dimensions know.
_LIVED = f"""{_DIMS}, {_MONTHS},
accepted AS (
  SELECT * FROM (SELECT *, payment_type AS payment_type_id, RatecodeID AS rate_code_id FROM months)
  WHERE {_ACCEPTED}
),
kept AS (
  SELECT * FROM accepted
  WHERE trip_distance > 0 AND total_amount >= 0 AND coalesce(passenger_count, 1) > 0
),
narrow AS (
  SELECT CAST(extract(hour FROM tpep_pickup_datetime) AS BIGINT) AS hour, payment_type_id,
    CASE WHEN {_CLOSED} THEN {_BIN} END AS bin, total_amount, trip_distance FROM kept),
found AS (SELECT bin, count(*) AS counts FROM narrow WHERE bin IS NOT NULL GROUP BY 1)"""
_TRIP_KEY = """concat_ws(':', CAST(PULocationID AS VARCHAR), CAST(DOLocationID AS VARCHAR),
  CAST(payment_type_id AS VARCHAR), CAST(CAST(rate_code_id AS INTEGER) AS VARCHAR))"""

# The samples hold all rows here: the test tables have fewer than a sample's size.
ORACLE["lifecycle_tables"] = f"""WITH {_LIVED}
SELECT 'landed' AS place, batch AS key, CAST(count(*) AS DOUBLE) AS a, CAST(NULL AS DOUBLE) AS b
FROM accepted GROUP BY batch
UNION ALL SELECT 'raw', concat_ws(':', batch, CAST(PULocationID AS VARCHAR), CAST(DOLocationID AS VARCHAR)),
  trip_distance, total_amount FROM accepted
UNION ALL SELECT 'lake', {_TRIP_KEY}, trip_distance, total_amount FROM kept
UNION ALL SELECT 'fact', {_TRIP_KEY}, trip_distance, total_amount FROM kept
UNION ALL SELECT 'model', 'rows:true', CAST(count(*) AS DOUBLE), NULL FROM kept WHERE {_OPEN}
UNION ALL SELECT 'dim_payment_type', concat_ws(':', CAST(payment_type_id AS VARCHAR), payment_name), NULL, NULL
  FROM dim_payment_type
UNION ALL SELECT 'dim_rate_code', concat_ws(':', CAST(rate_code_id AS VARCHAR), rate_description), NULL, NULL
  FROM dim_rate_code
UNION ALL SELECT 'dim_vendor', concat_ws(':', CAST(vendor_id AS VARCHAR), vendor_name), NULL, NULL FROM dim_vendor
UNION ALL SELECT 'mart:trip_panels', concat_ws('|', concat_ws(':', CASE WHEN grouping(hour) = 0 THEN 'hour'
    WHEN grouping(payment_type_id) = 0 THEN 'payment' ELSE 'bin' END,
    CAST(coalesce(hour, payment_type_id, bin) AS VARCHAR)), CAST(count(*) AS VARCHAR)),
  round(sum(total_amount), 4), round(sum(trip_distance), 4)
  FROM narrow GROUP BY GROUPING SETS ((hour), (payment_type_id), (bin))
UNION ALL SELECT 'mart:kpi', concat_ws('|', 'all', CAST(count(*) AS VARCHAR)), round(sum(total_amount), 4),
  round(avg(trip_distance), 6) FROM kept
UNION ALL SELECT 'mart:hourly_counts', concat_ws('|', CAST(hour AS VARCHAR), CAST(count(*) AS VARCHAR)), NULL, NULL
  FROM narrow GROUP BY hour
UNION ALL SELECT 'mart:payment_counts', concat_ws('|', concat_ws(':', CAST(payment_type_id AS VARCHAR), {_LABEL}),
  CAST(count(*) AS VARCHAR)), NULL, NULL FROM kept GROUP BY payment_type_id
UNION ALL SELECT 'mart:payment_labels', concat_ws('|', label, CAST(count(*) AS VARCHAR)),
  round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM kept), 6), NULL
  FROM (SELECT {_LABEL} AS label FROM kept) GROUP BY label
UNION ALL SELECT 'mart:amount_histogram', concat_ws('|', CAST(every.bin AS VARCHAR),
  CAST(coalesce(found.counts, 0) AS VARCHAR)), every.bin * CAST(4 AS DOUBLE), NULL
  FROM (SELECT CAST(range AS BIGINT) AS bin FROM range(50)) every LEFT JOIN found USING (bin)
UNION ALL SELECT 'mart:sample_amounts', 'row', total_amount, NULL FROM kept WHERE {_CLOSED}
UNION ALL SELECT 'mart:sample_scatter', 'row', total_amount, trip_distance FROM kept WHERE {_OPEN}
UNION ALL SELECT 'mart:preview', concat_ws('|', 'rows', CAST(least(count(*), 5) AS VARCHAR)), NULL, NULL FROM kept"""
