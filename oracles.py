"""SQL for DuckDB that says what each registered query must return."""

from __future__ import annotations

TX = """
tx AS (
  SELECT l_orderkey AS transaction_id,
         CAST(l_shipdate AS DATE) AS date,
         strftime(l_shipdate, '%a') AS day_of_week,
         printf('S%03d', l_suppkey) AS store_id,
         r_name AS region,
         printf('P%04d', l_partkey) AS product_id,
         p_type AS category,
         CAST(l_quantity AS INTEGER) AS units_sold,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
         CASE WHEN l_discount > 0 THEN 1 ELSE 0 END AS promotion_flag,
         CAST(round(l_discount * 100) AS INTEGER) AS discount_pct,
         CAST(CAST(l_quantity AS DECIMAL(10,0)) * CAST(p_retailprice AS DECIMAL(12,2))
              * (CAST(1 AS DECIMAL(4,2)) - CAST(l_discount AS DECIMAL(4,2)))
              AS DECIMAL(18,2)) AS sales_amount
  FROM lineitem
  LEFT JOIN part ON p_partkey = l_partkey
  LEFT JOIN supplier ON s_suppkey = l_suppkey
  LEFT JOIN nation ON n_nationkey = s_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
)"""

DAILY = TX + """,
daily AS (
  SELECT date,
         sum(sales_amount) AS revenue,
         CAST(sum(sales_amount) AS DOUBLE) AS daily_revenue,
         CAST(sum(units_sold) AS BIGINT) AS daily_units_sold,
         avg(promotion_flag) AS promo_rate,
         avg(discount_pct) AS avg_discount_pct,
         count(transaction_id) AS transaction_count
  FROM tx GROUP BY date
)"""

HISTORY = DAILY + """,
history AS (
  SELECT date, daily_revenue, daily_units_sold, promo_rate, avg_discount_pct,
         transaction_count,
         CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week_num,
         CAST(month(date) AS INTEGER) AS month_num,
         CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
         CASE WHEN month(date) IN (11, 12) THEN 1 ELSE 0 END AS is_holiday_season,
         lag(daily_revenue) OVER (ORDER BY date NULLS FIRST) AS prev_day_revenue,
         CAST(sum(revenue) OVER week AS DOUBLE) / nullif(count(revenue) OVER week, 0)
           AS rolling_7day_avg_revenue
  FROM daily
  WINDOW week AS (ORDER BY date NULLS FIRST ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
)"""

FEATURES = HISTORY + """,
features AS (
  SELECT * FROM history
  WHERE prev_day_revenue IS NOT NULL AND rolling_7day_avg_revenue IS NOT NULL
),
indexed AS (
  SELECT *, CAST(row_number() OVER (ORDER BY date) - 1 AS INTEGER) AS idx, count(*) OVER () AS days
  FROM features
)"""

PREDICTIONS = FEATURES + """,
predictions AS (
  SELECT date, daily_revenue AS actual_revenue,
         rolling_7day_avg_revenue AS predicted_revenue,
         day_of_week_num, is_weekend, is_holiday_season
  FROM indexed WHERE idx >= days - 180
),
errors AS (
  SELECT *, predicted_revenue - actual_revenue AS error,
         CASE WHEN actual_revenue = 0 THEN 0.0::DOUBLE
              ELSE abs(predicted_revenue - actual_revenue) / actual_revenue * 100
         END AS abs_percent_error,
         CASE WHEN predicted_revenue >= actual_revenue THEN 'over' ELSE 'under' END AS direction,
         concat_ws(', ', CASE WHEN is_weekend = 1 THEN 'Weekend' END,
                   CASE WHEN is_holiday_season = 1 THEN 'Holiday season' END) AS tags
  FROM predictions
)"""

TOTALS = TX + """,
totals AS (
  SELECT region, category, CAST(sum(sales_amount) AS DOUBLE) AS total_revenue,
         CAST(sum(units_sold) AS BIGINT) AS total_units_sold,
         sum(sales_amount) AS exact_revenue
  FROM tx GROUP BY region, category
),
top AS (
  SELECT *, region || ' / ' || category AS label
  FROM totals ORDER BY exact_revenue DESC, region, category LIMIT 15
)"""

TX_COLUMNS = """
  SELECT transaction_id, date, day_of_week, store_id, region, product_id, category,
         units_sold, CAST(unit_price AS DOUBLE) AS unit_price, promotion_flag,
         discount_pct, CAST(sales_amount AS DOUBLE) AS sales_amount
  FROM tx"""

FACTORS = """
WITH lines AS (
  SELECT l_orderkey AS transaction_id, CAST(l_shipdate AS DATE) AS date,
         CAST(l_quantity AS INTEGER) AS units_sold,
         CASE dayofweek(l_shipdate)
           WHEN 1 THEN 0.9::DOUBLE WHEN 2 THEN 0.85::DOUBLE WHEN 3 THEN 0.9::DOUBLE
           WHEN 4 THEN 0.95::DOUBLE WHEN 5 THEN 1.2::DOUBLE WHEN 6 THEN 1.5::DOUBLE
           ELSE 1.3::DOUBLE END AS weekday_factor,
         CASE WHEN month(l_shipdate) IN (11, 12) THEN 1.6::DOUBLE
              WHEN month(l_shipdate) = 7 THEN 1.15::DOUBLE ELSE 1.0::DOUBLE END AS season_factor,
         CASE WHEN l_discount > 0 THEN 1.3::DOUBLE ELSE 1.0::DOUBLE END AS promo_boost
  FROM lineitem
), scaled AS (
  SELECT *, CAST(units_sold AS DOUBLE) * weekday_factor * season_factor * promo_boost AS x
  FROM lines
)
SELECT transaction_id, date, units_sold, weekday_factor, season_factor, promo_boost,
       greatest(1, CAST(CASE
         WHEN x - floor(x) > 0.5 THEN floor(x) + 1
         WHEN x - floor(x) < 0.5 THEN floor(x)
         WHEN CAST(floor(x) AS BIGINT) % 2 = 0 THEN floor(x)
         ELSE floor(x) + 1 END AS INTEGER)) AS adjusted_units
FROM scaled"""

PAGE = """
SELECT date, actual_revenue, predicted_revenue, day_of_week_num, is_weekend,
       is_holiday_season, error, abs_percent_error, direction, tags
FROM errors"""

EVENT_MESSAGES = """
WITH messages AS (
  SELECT event_id, CAST(ts AS DATE) AS date, value,
         event_type,
         CASE event_type
           WHEN 'click' THEN '{"transaction_id":' || event_id || ',"date":"'
             || strftime(ts, '%Y-%m-%d') || '","unit_price":'
             || CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) || ',"units_sold":"click"}'
           WHEN 'view' THEN props
           WHEN 'error' THEN 'not json ' || props
         END AS message
  FROM events
)"""

SQL: dict[str, str] = {
    "transactions": "WITH" + TX + TX_COLUMNS,
    "factors": FACTORS,
    "surrogate_key": """
SELECT row_number() OVER (ORDER BY p_partkey) AS row_id, p_partkey, p_type FROM part""",
    "numbered_lines": """
SELECT row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey) AS transaction_id,
       l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey
FROM lineitem""",
    "daily_revenue": "WITH" + DAILY + """
SELECT date, daily_revenue, daily_units_sold, promo_rate, avg_discount_pct, transaction_count
FROM daily""",
    "calendar_features": """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
       CAST(dayofweek(o_orderdate) + 1 AS INTEGER) AS day_of_week_num,
       CAST(month(o_orderdate) AS INTEGER) AS month_num,
       CASE WHEN dayofweek(o_orderdate) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend,
       CASE WHEN month(o_orderdate) IN (11, 12) THEN 1 ELSE 0 END AS is_holiday_season
FROM orders""",
    "lag_rolling": "WITH" + HISTORY + """
SELECT date, daily_revenue, prev_day_revenue, rolling_7day_avg_revenue FROM history""",
    "daily_features": "WITH" + FEATURES + "\nSELECT * FROM features",
    "holdout_split": "WITH" + FEATURES + """
SELECT date, idx, CASE WHEN idx < days - 180 THEN 'train' ELSE 'test' END AS part FROM indexed""",
    "date_spine": """
WITH bounds AS (
  SELECT CAST(min(l_shipdate) AS DATE) AS first, CAST(max(l_shipdate) AS DATE) AS last FROM lineitem
)
SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds""",
    "gap_filled_daily": "WITH" + DAILY + """,
spine AS (
  SELECT CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM daily
)
SELECT spine.date, coalesce(daily_revenue, 0) AS daily_revenue,
       coalesce(daily_units_sold, 0) AS daily_units_sold, coalesce(promo_rate, 0) AS promo_rate,
       coalesce(avg_discount_pct, 0) AS avg_discount_pct,
       coalesce(transaction_count, 0) AS transaction_count
FROM spine LEFT JOIN daily ON daily.date = spine.date""",
    "baseline_predictions": "WITH" + PREDICTIONS + "\nSELECT * FROM predictions",
    "predictions_of_forest": "WITH" + PREDICTIONS + """
SELECT date, actual_revenue, day_of_week_num, is_weekend, is_holiday_season, true AS within_trained
FROM predictions""",
    "overview_of_forest": "WITH" + PREDICTIONS + """
SELECT count(*) > 0 AS has_data, count(*) AS days, min(date) AS first_date, max(date) AS last_date,
       sum(actual_revenue ORDER BY date) AS total_actual, avg(actual_revenue ORDER BY date) AS avg_actual,
       true AS has_mape, true AS as_by_mllib
FROM predictions""",
    "forecast_errors": "WITH" + PREDICTIONS + PAGE,
    "eval_metrics": "WITH" + PREDICTIONS + """
SELECT count(*) AS days,
       sqrt(avg(error * error ORDER BY date)) AS rmse,
       avg(abs(error) ORDER BY date) AS mae,
       1 - sum(error * error ORDER BY date)
         / sum((actual_revenue - centre) * (actual_revenue - centre) ORDER BY date) AS r2,
       avg(abs_percent_error ORDER BY date) AS mape,
       CASE WHEN avg(abs_percent_error ORDER BY date) < 15 THEN 'good' ELSE 'poor' END AS quality
FROM errors, (SELECT avg(actual_revenue ORDER BY date) AS centre FROM errors)""",
    "overview": "WITH" + PREDICTIONS + """,
best AS (SELECT * FROM errors ORDER BY abs_percent_error, date LIMIT 1),
worst AS (SELECT * FROM errors ORDER BY abs_percent_error DESC, date LIMIT 1),
figures AS (
  SELECT count(*) AS days, min(date) AS first_date, max(date) AS last_date,
         sum(actual_revenue ORDER BY date) AS total_actual,
         sum(predicted_revenue ORDER BY date) AS total_predicted,
         avg(actual_revenue ORDER BY date) AS avg_actual,
         avg(predicted_revenue ORDER BY date) AS avg_predicted,
         avg(abs_percent_error ORDER BY date) AS mape
  FROM errors
)
SELECT figures.*, days > 0 AS has_data,
       CASE WHEN mape < 15 THEN 'good' ELSE 'poor' END AS quality,
       best.date AS best_date, best.actual_revenue AS best_actual,
       best.predicted_revenue AS best_predicted, best.abs_percent_error AS best_percent_error,
       worst.date AS worst_date, worst.actual_revenue AS worst_actual,
       worst.predicted_revenue AS worst_predicted, worst.abs_percent_error AS worst_percent_error
FROM figures, best, worst""",
    "predictions_page_1": "WITH" + PREDICTIONS + PAGE + " ORDER BY date DESC LIMIT 30",
    "predictions_page_last": "WITH" + PREDICTIONS + """,
numbered AS (
  SELECT *, row_number() OVER (ORDER BY date DESC) AS place, count(*) OVER () AS n FROM errors
)""" + PAGE.replace("FROM errors", "FROM numbered") + " WHERE place > (n - 1) // 30 * 30",
    "page_info": "WITH" + PREDICTIONS + """,
size AS (SELECT count(*) AS rows, greatest(1, (count(*) + 29) // 30) AS pages FROM predictions),
listed AS (SELECT unnest(range(1, pages + 1)) AS page, pages, rows FROM size)
SELECT page, pages, rows, page > 1 AS has_previous, page < pages AS has_next FROM listed""",
    "weekday_profile": "WITH" + PREDICTIONS + """,
week AS (
  SELECT * FROM (VALUES (2,0,'Mon'),(3,1,'Tue'),(4,2,'Wed'),(5,3,'Thu'),(6,4,'Fri'),(7,5,'Sat'),(1,6,'Sun'))
    AS t(day_of_week_num, sort_key, day_name)
),
means AS (
  SELECT day_of_week_num, avg(actual_revenue ORDER BY date) AS avg_actual,
         avg(predicted_revenue ORDER BY date) AS avg_predicted
  FROM predictions GROUP BY day_of_week_num
)
SELECT week.day_of_week_num, coalesce(avg_actual, 0) AS avg_actual,
       coalesce(avg_predicted, 0) AS avg_predicted, sort_key, day_name
FROM week LEFT JOIN means ON means.day_of_week_num = week.day_of_week_num""",
    "error_series": "WITH" + PREDICTIONS + """
SELECT date, actual_revenue, predicted_revenue, error, direction FROM errors ORDER BY date""",
    "scatter_bounds": "WITH" + PREDICTIONS + """
SELECT min(actual_revenue) AS actual_min, max(actual_revenue) AS actual_max FROM predictions""",
    "chart_series": "WITH" + PREDICTIONS + """
SELECT count(*) > 0 AS has_data,
       string_agg(strftime(date, '%Y-%m-%d'), ',' ORDER BY date) AS dates,
       string_agg(CAST(CAST(actual_revenue AS DECIMAL(28,2)) AS VARCHAR), ',' ORDER BY date) AS actual,
       string_agg(CAST(CAST(actual_revenue AS DECIMAL(28,2)) AS VARCHAR), ',' ORDER BY date) AS scatter_x,
       string_agg(CAST(CAST(floor(predicted_revenue * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY date) AS predicted,
       string_agg(CAST(CAST(floor(predicted_revenue * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY date) AS scatter_y,
       string_agg(CAST(CAST(round(round(error, 2) * 100) AS BIGINT) AS VARCHAR), ',' ORDER BY date) AS errors
FROM errors""",
    "region_category_totals": "WITH" + TOTALS + """
SELECT region, category, total_revenue, total_units_sold FROM totals""",
    "top15_groups": "WITH" + TOTALS + """
SELECT region, category, total_revenue, total_units_sold, label FROM top""",
    "totals_text": "WITH" + TOTALS + """
SELECT region || ' / ' || category AS label, format('{:,.2f}', total_revenue) AS revenue,
       format('{:,}', total_units_sold) AS units
FROM totals""",
    "live_totals": "WITH" + TOTALS + """
SELECT CAST(coalesce(sum(exact_revenue), 0) AS DOUBLE) AS total_revenue, count(*) AS groups,
       (SELECT count(*) FROM lineitem) AS total_transactions
FROM totals""",
    "recent_events_20": """
SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 20""",
    "json_roundtrip": "WITH" + TX + TX_COLUMNS,
    "json_good_rows": EVENT_MESSAGES + """
SELECT event_id AS transaction_id, date, CAST(CAST(value AS DECIMAL(18,2)) AS DOUBLE) AS unit_price
FROM messages WHERE event_type = 'purchase'""",
    "json_dead_letter": EVENT_MESSAGES + """
SELECT event_id, message FROM messages WHERE event_type <> 'purchase'""",
    "stream_dead_letters": EVENT_MESSAGES + """
SELECT event_id, message FROM messages WHERE event_type <> 'purchase'""",
    "csv_rejects": """
SELECT event_id || ',' || CASE WHEN event_type = 'error' THEN 'bad ' ELSE '' END
  || strftime(ts, '%Y-%m-%d') || ',' || CASE WHEN event_type = 'view' THEN 'much' ELSE '1.50' END AS line
FROM events WHERE event_type IN ('error', 'view')""",
    "csv_roundtrip": "WITH" + TX + TX_COLUMNS,
    "appended_orders": "SELECT * FROM orders",
    "bounded_scan_spread": "SELECT count(*) // 2 AS rows, true AS whole FROM lineitem",
    "bounded_scan": """
SELECT event_id, ts, event_type, value FROM events ORDER BY event_id LIMIT 1000""",
    "published_messages": "WITH" + TX + """
SELECT '{"transaction_id":' || transaction_id || ',"date":"' || strftime(date, '%Y-%m-%d')
  || '","day_of_week":"' || day_of_week || '","store_id":"' || store_id || '","region":"' || region
  || '","product_id":"' || product_id || '","category":"' || category || '","units_sold":' || units_sold
  || ',"unit_price":' || unit_price || ',"promotion_flag":' || promotion_flag
  || ',"discount_pct":' || discount_pct || ',"sales_amount":' || sales_amount || '}' AS message
FROM tx""",
    "stream_totals": "WITH" + TOTALS + """
SELECT region, category, total_revenue, total_units_sold FROM totals""",
    "stream_restart": "WITH" + TOTALS + """
SELECT region, category, total_revenue, total_units_sold FROM totals""",
    "null_id_totals": "WITH" + TOTALS + """
SELECT region, category, total_revenue, total_units_sold FROM totals""",
    "stream_raw_append": "WITH" + TX + TX_COLUMNS,
    "stream_throughput": "SELECT count(*) AS input_rows FROM lineitem",
    "live_snapshot": "WITH" + TOTALS + """
SELECT (SELECT count(*) FROM lineitem) > 0 AS has_data,
       (SELECT count(*) FROM lineitem) AS total_transactions,
       CAST(coalesce(sum(exact_revenue), 0) AS DOUBLE) AS total_revenue,
       CAST(least(20, (SELECT count(*) FROM lineitem)) AS INTEGER) AS recent_rows,
       (SELECT string_agg(label, '; ' ORDER BY exact_revenue DESC, region, category) FROM top) AS top_labels
FROM totals""",
}

SQL |= {
    "stream_deduped": SQL["transactions"],
    "stream_raw_ledger": SQL["transactions"],
    "stream_daily_revenue": SQL["daily_revenue"],
    "stream_late_rows": "WITH" + TX + TX_COLUMNS + """
  WHERE transaction_id % 10 = 7
    AND date + 1 <= (SELECT max(date) FROM tx WHERE transaction_id % 10 <> 7) - 30""",
    "stream_rates": "SELECT count(*) AS input_rows, 3::BIGINT AS batches, true AS agree FROM lineitem",
    "stream_state_rows": SQL["region_category_totals"],
    "live_document": "WITH" + TX + """,
seen AS (SELECT *, date >= DATE '1997-01-01' AS of_last FROM tx WHERE date < DATE '1999-06-01'),
totals AS (
  SELECT region || ' / ' || category AS label, region, category, sum(sales_amount) AS revenue, sum(units_sold) AS units
  FROM seen GROUP BY region, category
),
top AS (SELECT * FROM totals ORDER BY revenue DESC, region, category LIMIT 15),
recent AS (
  SELECT *, row_number() OVER (ORDER BY of_last DESC, transaction_id DESC, date DESC, store_id DESC, region DESC,
    product_id DESC, category DESC, units_sold DESC, unit_price DESC, sales_amount DESC) AS place
  FROM seen QUALIFY place <= 20
)
SELECT true AS has_data, 1::BIGINT AS batch_id, true AS agrees, count(*) AS total_transactions,
       CAST(sum(sales_amount) AS DOUBLE) AS total_revenue,
       (SELECT string_agg(label || '|' || CAST(revenue * 100 AS BIGINT) || '|' || CAST(units AS BIGINT), ';'
          ORDER BY revenue DESC, region, category) FROM top) AS aggregates,
       (SELECT string_agg(transaction_id || '|' || strftime(date, '%Y-%m-%d') || '|' || store_id || '|' || product_id
          || '|' || CAST(sales_amount * 100 AS BIGINT), ';' ORDER BY place) FROM recent) AS recent
FROM seen""",
    "rolling_calendar_days": "WITH" + DAILY + """,
framed AS (
  SELECT date, daily_revenue, count(revenue) OVER week AS days_sold, CAST(sum(revenue) OVER week AS DOUBLE) AS added
  FROM daily
  WINDOW week AS (ORDER BY date RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)
)
SELECT date, daily_revenue, days_sold, coalesce(added, 0) AS window_revenue,
       CASE WHEN days_sold > 0 THEN added / days_sold END AS mean_of_days_sold,
       coalesce(added, 0) / 7 AS mean_of_days
FROM framed""",
}
