"""The same results in SQL, for DuckDB on the same tables."""

FIRST, LAST = "1997-03-01", "1998-02-28"

BARS = """
WITH raw AS (
  SELECT 's' || l_suppkey AS ticker,
         l_quantity AS volume,
         l_extendedprice AS open,
         l_extendedprice * (1 - l_discount) AS close,
         l_extendedprice * (1 + l_tax) AS high,
         l_extendedprice * (1 - l_discount) AS low,
         epoch_us(l_shipdate) * 1000 + l_linenumber AS window_start,
         l_orderkey AS transactions
  FROM lineitem
), normalized AS (
  SELECT upper(ticker) AS ticker,
         CAST(make_timestamp((window_start // 1000000000) * 1000000) AS DATE) AS trade_date,
         window_start, volume, open, close, high, low, transactions
  FROM raw
), ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY ticker, trade_date
           ORDER BY window_start DESC, transactions DESC, volume DESC,
                    high DESC, low DESC, open DESC, close DESC) AS rank
  FROM normalized
), bars AS (
  SELECT * EXCLUDE (rank) FROM ranked WHERE rank = 1
)
"""


def extremes(source, first, last):
    """52-week extremes of the rows of ``source`` between two SQL dates."""
    return f"""
SELECT ticker, trade_date, window_start, volume, open, close, high, low, transactions,
       CASE WHEN first_day <= trade_date - 364 THEN past_high END AS past_high_52_weeks,
       CASE WHEN first_day <= trade_date - 364 THEN past_low END AS past_low_52_weeks,
       future_high AS future_high_52_weeks,
       future_low AS future_low_52_weeks
FROM (
  SELECT *, min(trade_date) OVER trailing_year AS first_day,
         max(high) OVER trailing_year AS past_high, min(low) OVER trailing_year AS past_low,
         max(high) OVER leading_year AS future_high, min(low) OVER leading_year AS future_low
  FROM {source}
  WINDOW trailing_year AS (PARTITION BY ticker ORDER BY trade_date
           RANGE BETWEEN INTERVAL 364 DAYS PRECEDING AND CURRENT ROW),
         leading_year AS (PARTITION BY ticker ORDER BY trade_date
           RANGE BETWEEN INTERVAL 1 DAY FOLLOWING AND INTERVAL 364 DAYS FOLLOWING)
)
WHERE trade_date BETWEEN {first} AND {last}
"""


WHOLE = ("(SELECT min(trade_date) FROM normalized)", "(SELECT max(trade_date) FROM normalized)")
IMPACTED = (f"DATE '{FIRST}' - 364", f"DATE '{LAST}'")
ALL_BARS = BARS + "SELECT * FROM bars"
SOME_BARS = BARS + f"SELECT * FROM bars WHERE trade_date BETWEEN '{FIRST}' AND '{LAST}'"
ALL_METRICS = BARS + extremes("bars", *WHOLE)

MONTHS = """
, span AS (
  SELECT min(trade_date) AS first_day, max(trade_date) AS last_day FROM normalized
), months AS (
  SELECT CAST(unnest(generate_series(date_trunc('month', first_day), CAST(last_day AS TIMESTAMP),
                                     INTERVAL 1 MONTH)) AS DATE) AS month FROM span
), ranges AS (
  SELECT month, greatest(month, first_day) AS start_date,
         least(last_day(month), span.last_day) AS end_date
  FROM months, span
  UNION ALL SELECT DATE '2003-01-01', DATE '2003-01-01', DATE '2003-01-31'
)
"""

CALENDAR = """
WITH calendar AS (
  SELECT CAST(unnest(generate_series(TIMESTAMP '2023-12-25', TIMESTAMP '2024-02-05',
                                     INTERVAL 1 DAY)) AS DATE) AS trade_date
), available AS (
  SELECT DISTINCT CAST(ts AS DATE) AS trade_date FROM events
), manifest AS (
  SELECT c.trade_date,
         CASE WHEN a.trade_date IS NULL THEN 'MISSING' ELSE 'AVAILABLE' END AS status
  FROM calendar c LEFT JOIN available a ON a.trade_date = c.trade_date
)
"""


def _days_with(status):
    return (
        "coalesce(string_agg(CAST(trade_date AS VARCHAR), ',' ORDER BY trade_date)"
        f" FILTER (WHERE status = '{status}'), '')"
    )


ORACLE = {
    "metrics_52w": ALL_METRICS,
    "metrics_52w_repeated_days": BARS + extremes("normalized", *WHOLE),
    "metrics_52w_daily_impacted": BARS + extremes("bars", *IMPACTED),
    "metrics_52w_both_sides": BARS
    + extremes("bars", f"DATE '{FIRST}' - 364", f"DATE '{LAST}' + 364"),
    "metrics_52w_full_flag_only": BARS
    + """
SELECT ticker, trade_date FROM bars b
WHERE EXISTS (SELECT 1 FROM bars y
              WHERE y.ticker = b.ticker AND y.trade_date = b.trade_date - 364)
""",
    "metrics_upsert": BARS
    + f""", known AS (SELECT * FROM bars WHERE trade_date <= '{FIRST}'),
target AS ({extremes("known", WHOLE[0], f"DATE '{FIRST}'")}),
source AS ({extremes("bars", f"DATE '{FIRST}' - 364", WHOLE[1])})
SELECT * FROM source
UNION ALL
SELECT * FROM target t WHERE NOT EXISTS (
  SELECT 1 FROM source s WHERE s.ticker = t.ticker AND s.trade_date = t.trade_date)
""",
    "metrics_table": ALL_METRICS,
    "daily_update_metrics": BARS + extremes("bars", *IMPACTED),
    "bars_normalized": BARS + "SELECT * FROM normalized",
    "bars_dedup_latest": ALL_BARS,
    "bars_date_range": SOME_BARS,
    "bars_text_normalized": BARS
    + """
SELECT ticker, trade_date, window_start,
       CASE WHEN volume >= 5 THEN volume END AS volume,
       open, close, high, low, transactions
FROM normalized WHERE NOT open > 50000
""",
    "bars_text_load": ALL_BARS,
    "bars_text_days": SOME_BARS,
    "bars_csv_roundtrip": ALL_BARS,
    "bars_csv_pruned": SOME_BARS,
    "bars_load": ALL_BARS,
    "bars_overwrite_partitions": BARS
    + f""", changed AS (
  SELECT * REPLACE (volume * 2 AS volume) FROM bars
  WHERE trade_date BETWEEN '{FIRST}' AND '{LAST}' AND volume > 10
)
SELECT * FROM changed
UNION ALL
SELECT * FROM bars WHERE trade_date NOT IN (SELECT trade_date FROM changed)
""",
    "bars_append": BARS
    + f"""
SELECT * FROM bars
UNION ALL
SELECT * FROM bars WHERE trade_date BETWEEN '{FIRST}' AND '{LAST}'
""",
    "bars_volume_widened": BARS
    + "SELECT * REPLACE (CAST(trunc(volume) AS DOUBLE) AS volume) FROM bars",
    "bars_upsert_jdbc": ALL_BARS,
    "bars_load_counters": BARS
    + """
SELECT trade_date AS file_day, strftime(trade_date, '%Y-%m-%d') || '.csv.gz' AS path,
       count(*) AS rows_staged
FROM normalized GROUP BY trade_date
""",
    "bars_load_totals": BARS
    + """
SELECT (SELECT count(DISTINCT trade_date) FROM normalized) AS files,
       (SELECT count(DISTINCT trade_date) FROM normalized) AS file_days,
       (SELECT count(*) FROM normalized) AS rows_staged,
       (SELECT count(*) FROM bars) AS rows_upserted
""",
    "bars_incremental_stream": ALL_BARS,
    "orders_upsert": """
WITH source AS (
  SELECT o_orderkey, o_totalprice * 2 AS o_totalprice FROM orders WHERE o_totalprice > 250000
  UNION ALL
  SELECT -o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 250000
)
SELECT coalesce(s.o_orderkey, t.o_orderkey) AS o_orderkey,
       CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice
FROM source s FULL OUTER JOIN orders t ON s.o_orderkey = t.o_orderkey
""",
    "orders_duplicate_keys": """
SELECT l_orderkey, l_suppkey, count(*) AS rows FROM lineitem
GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1
""",
    "staging_manifest": CALENDAR + "SELECT trade_date, status FROM manifest",
    "staging_summary": CALENDAR
    + f"""
SELECT CASE WHEN count(*) FILTER (WHERE status = 'AVAILABLE') > 0
            THEN 'STAGED' ELSE 'NO_DATA' END AS status,
       {_days_with("AVAILABLE")} AS available_dates,
       {_days_with("MISSING")} AS missing_dates,
       count(*) FILTER (WHERE status = 'AVAILABLE') AS files,
       min(trade_date) FILTER (WHERE status = 'AVAILABLE') AS daily_start_date,
       max(trade_date) FILTER (WHERE status = 'AVAILABLE') AS daily_end_date
FROM manifest
""",
    "staging_days_by_status": CALENDAR
    + """
SELECT status, string_agg(CAST(trade_date AS VARCHAR), ',' ORDER BY trade_date) AS days
FROM manifest GROUP BY status
""",
    "raw_file_keys": BARS
    + """
SELECT DISTINCT trade_date,
       'raw/day_bars' || strftime(trade_date, '/year=%Y/month=%m/%Y-%m-%d.csv.gz') AS key
FROM normalized
""",
    "range_list": BARS
    + MONTHS
    + """
SELECT row_number() OVER (ORDER BY start_date) - 1 AS range_id,
       '/raw' || strftime(month, '/year=%Y/month=%m/') AS input_path,
       start_date, end_date
FROM ranges
""",
    "range_bar_counts": BARS
    + MONTHS
    + """
SELECT r.start_date, r.end_date, count(b.ticker) AS bars
FROM ranges r LEFT JOIN bars b ON b.trade_date BETWEEN r.start_date AND r.end_date
GROUP BY r.start_date, r.end_date
""",
    "backfill_range_counts": BARS
    + MONTHS
    + """
SELECT r.start_date, r.end_date,
       CASE WHEN count(n.ticker) > 0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
       count(n.ticker) AS bars
FROM ranges r LEFT JOIN normalized n ON n.trade_date BETWEEN r.start_date AND r.end_date
GROUP BY r.start_date, r.end_date
""",
    "backfill_table": ALL_BARS,
    "profile_count": "SELECT count(*) AS rows FROM events",
    "profile_sample": """
SELECT CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type})
            AS VARCHAR) AS row
FROM events ORDER BY event_id LIMIT 10
""",
    "profile_whole": """
SELECT 'rows' AS item, CAST(count(*) AS VARCHAR) AS value FROM events
UNION ALL SELECT 'columns', '3'
UNION ALL
SELECT 'row ' || (row_number() OVER (ORDER BY event_id) - 1),
       CAST(to_json({'event_id': event_id, 'user_id': user_id, 'event_type': event_type}) AS VARCHAR)
FROM (SELECT * FROM events ORDER BY event_id LIMIT 10)
""",
    "bars_exact_file": BARS
    + "SELECT * FROM bars WHERE trade_date = (SELECT max(trade_date) FROM normalized)",
    "bars_late_rows": SOME_BARS,
    "bars_restated": BARS + "SELECT * REPLACE (volume * 2 AS volume) FROM bars",
    "bars_late_by_ledger": ALL_BARS,
    "bars_refreshed": BARS
    + f"""
SELECT * REPLACE (CASE WHEN trade_date BETWEEN '{FIRST}' AND '{LAST}' THEN volume * 2 ELSE volume END AS volume)
FROM bars
""",
    "metrics_new_days": BARS
    + ", known AS (SELECT * FROM bars WHERE trade_date <= '1997-08-31')"
    + extremes("known", WHOLE[0], "DATE '1997-08-31'"),
    "staging_split_days": """
SELECT DISTINCT CAST(ts AS DATE) AS trade_date, CAST(2 AS BIGINT) AS files,
       strftime(ts, '%Y-%m-%d') || '-1.csv.gz,' || strftime(ts, '%Y-%m-%d') || '.csv.gz' AS names
FROM events
""",
    "backfill_bad_range": BARS
    + """
SELECT CAST(date_trunc('month', trade_date) AS DATE) AS month,
       CASE WHEN month = DATE '1997-04-01' THEN 'FAILED' ELSE 'SUCCEEDED' END AS status,
       month = DATE '1997-04-01' AS has_error,
       CASE WHEN month = DATE '1997-04-01' THEN 0 ELSE count(*) END AS loaded
FROM bars GROUP BY month
""",
    "table_properties": BARS
    + "SELECT 'barkeep.kind' AS key, 'bars' AS value, count(*) AS rows FROM bars",
    "date_requests": BARS
    + f"""
, asked AS (
  SELECT 'range' AS request, DATE '{FIRST}' AS start_date, DATE '{LAST}' AS end_date
  UNION ALL SELECT 'day', DATE '1997-03-05', DATE '1997-03-05'
  UNION ALL SELECT 'lookback', DATE '1998-02-24', DATE '1998-02-28'
  UNION ALL SELECT 'loader', DATE '1998-02-26', DATE '1998-02-28'
)
SELECT request, start_date, end_date, count(b.ticker) AS bars
FROM asked LEFT JOIN bars b ON b.trade_date BETWEEN start_date AND end_date
GROUP BY request, start_date, end_date
""",
    "profile_inferred": """
SELECT event_type, count(*) AS rows, CAST(sum(user_id) AS BIGINT) AS users
FROM events GROUP BY event_type
""",
    "metrics_bucketed": ALL_METRICS,
    "bars_keyed_stream": ALL_BARS,
    "bars_quarantined": BARS
    + """
, good AS (
  SELECT *, row_number() OVER (
           PARTITION BY ticker, trade_date
           ORDER BY window_start DESC, transactions DESC, volume DESC,
                    high DESC, low DESC, open DESC, close DESC) AS place
  FROM normalized WHERE volume >= 5 AND NOT open > 50000
)
SELECT 'GOOD' AS status, trade_date AS file_day, ticker, window_start, transactions, NULL AS reasons
FROM good WHERE place = 1
UNION ALL
SELECT 'BAD', trade_date, CASE WHEN NOT open > 50000 THEN lower(ticker) END, window_start, transactions,
       concat_ws('; ', CASE WHEN open > 50000 THEN 'ticker: missing' END,
                 CASE WHEN volume < 5 THEN 'volume: cannot read n/a' END)
FROM normalized WHERE volume < 5 OR open > 50000
""",
    "backfill_resumed": BARS
    + MONTHS
    + f"""
SELECT CAST(date_trunc('month', r.start_date) AS DATE) AS month,
       CASE WHEN count(n.ticker) > 0 THEN 'SUCCEEDED' ELSE 'FAILED' END AS status,
       count(n.ticker) AS bars,
       r.end_date < DATE '{FIRST}' AS resumed,
       count(DISTINCT n.ticker || ' ' || n.trade_date) AS loaded
FROM ranges r LEFT JOIN normalized n ON n.trade_date BETWEEN r.start_date AND r.end_date
GROUP BY r.start_date, r.end_date
""",
}
ORACLE["metrics_versions"] = ORACLE["metrics_upsert"]
