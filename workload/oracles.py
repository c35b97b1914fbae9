"""The same results as DuckDB SQL over the driver tables."""

EV = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS event_id, event_id AS source_row, ts AS event_ts,
         CAST(user_id AS VARCHAR) AS user_id,
         CAST(user_id AS VARCHAR) || '-w' || CAST((day(ts) - 1) // 7 AS VARCHAR) AS session_id,
         CASE event_type WHEN 'click' THEN 'cart' WHEN 'signup' THEN 'search' ELSE event_type END AS event_type,
         'P0' || CAST(k % 10 AS VARCHAR) AS product_id,
         'C' || CAST(k % 10 % 3 AS VARCHAR) AS category,
         1 + k % 3 AS quantity,
         CAST(round(value * 100) AS BIGINT) AS price_paise,
         'w' || CAST((day(ts) - 1) // 7 AS VARCHAR) AS period
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)
),
silver AS (SELECT * FROM ev WHERE event_type <> 'error'),
mixed AS (
  SELECT * REPLACE (
    CASE WHEN source_row % 2 = 0 THEN 'real:' ELSE '' END || product_id AS product_id,
    CASE WHEN source_row % 2 = 0 THEN 'real:' ELSE '' END || user_id AS user_id,
    CASE WHEN source_row % 2 = 0 THEN 'real:' ELSE '' END || session_id AS session_id)
  FROM silver
)"""

MEASURES = """
  count(*) AS events,
  count(*) FILTER (event_type = 'purchase') AS purchases,
  CAST(sum(CASE WHEN event_type = 'purchase' THEN quantity * price_paise ELSE 0 END) AS BIGINT) AS revenue_paise,
  count(*) FILTER (event_type = 'view') AS views,
  count(*) FILTER (event_type = 'cart') AS carts"""

TUMBLING = f"""
tumbling AS (
  SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS window_start,
         time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS window_end,
         category, product_id, {MEASURES}
  FROM silver GROUP BY ALL
)"""

SPREAD = """
spread AS (
  SELECT *, time_bucket(INTERVAL 1 MINUTE, event_ts) - g * INTERVAL 1 MINUTE AS window_start
  FROM silver, range(5) t(g)
)"""

SLIDING = f"""
sliding AS (
  SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, category, product_id, {MEASURES}
  FROM spread GROUP BY ALL
)"""

# Raw records of which some break one rule, as their parsed values and the expected reason.
BAD = """
bad AS (
  SELECT *, source_row % 50 AS c,
    CASE WHEN source_row % 50 = 4 THEN 'malformed JSON'
         WHEN source_row % 50 = 1 THEN 'unsupported schema_version'
         WHEN source_row % 50 = 3 THEN 'invalid event_id'
         WHEN source_row % 50 = 6 THEN 'invalid category'
         WHEN event_type = 'error' THEN 'invalid event_type'
         WHEN source_row % 50 = 0 THEN 'invalid quantity'
         WHEN source_row % 50 = 7 THEN 'invalid price_paise'
         WHEN source_row % 50 = 2 THEN 'timestamp must include timezone'
         WHEN source_row % 50 = 5 THEN 'event timestamp too far in the future' END AS reject_reason
  FROM ev
)"""

CSV = """
csv AS (
  SELECT *, source_row % 40 AS c,
    date_trunc('second', CASE WHEN source_row % 40 = 2 THEN event_ts - INTERVAL 31 DAY ELSE event_ts END) AS happened,
    CASE WHEN source_row % 40 = 3 THEN 'refund' ELSE event_type END AS kind,
    CASE WHEN source_row % 40 = 6 THEN 'category:90' || substr(category, 2) ELSE lower(category) END AS cat
  FROM ev
),
history_routed AS (
  SELECT *, CASE
    WHEN strftime(happened, '%Y-%b') <> '2024-Jan' THEN 'timestamp outside requested month'
    WHEN kind NOT IN ('view', 'cart', 'purchase', 'remove_from_cart') THEN 'unsupported event type'
    WHEN c = 4 THEN 'missing user_id'
    WHEN c IN (0, 1) THEN 'invalid price' END AS reason
  FROM csv
),
replay_routed AS (
  SELECT *, kind IN ('view', 'cart', 'purchase', 'remove_from_cart') AND c NOT IN (0, 1, 4) AS accepted
  FROM csv
)"""

PAIRS = """
pairs AS (
  SELECT user_id, session_id, product_id,
         min(event_ts) FILTER (event_type = 'view') AS first_view,
         min(event_ts) FILTER (event_type = 'cart') AS first_cart,
         min(event_ts) FILTER (event_type = 'purchase') AS first_purchase,
         max(event_ts) FILTER (event_type = 'purchase') AS last_purchase
  FROM silver GROUP BY ALL
)"""

PERIODS = """
periods AS (
  SELECT user_id, period, count(*) AS actions,
         count(*) FILTER (event_type = 'view') AS views,
         count(*) FILTER (event_type = 'cart') AS carts,
         count(*) FILTER (event_type = 'purchase') AS purchases,
         CAST(sum(CASE WHEN event_type = 'purchase' THEN price_paise ELSE 0 END) AS BIGINT) AS purchase_minor
  FROM silver GROUP BY ALL
),
known AS (SELECT *, min(period) OVER (PARTITION BY user_id) AS first_observed FROM periods),
summary AS (
  SELECT period, CAST(sum(actions) AS BIGINT) AS actions, count(*) AS customers,
         CAST(sum(views) AS BIGINT) AS views, CAST(sum(carts) AS BIGINT) AS carts,
         CAST(sum(purchases) AS BIGINT) AS purchases,
         CAST(sum(purchase_minor) AS DOUBLE) / 100.0 AS purchase_price_sum
  FROM periods GROUP BY period
)"""

PRODUCTS = """
totals AS (
  SELECT product_id, max(category) AS category,
         count(DISTINCT user_id) FILTER (event_type = 'view') AS viewers,
         count(DISTINCT user_id) FILTER (event_type = 'purchase') AS purchasers,
         count(*) FILTER (event_type = 'view') AS views,
         count(*) FILTER (event_type = 'purchase') AS purchases
  FROM silver GROUP BY product_id
),
buyers AS (
  SELECT product_id, count(DISTINCT CASE WHEN last_purchase >= first_view THEN user_id END) AS matched_buyers
  FROM pairs GROUP BY product_id
),
products AS (
  SELECT t.*, coalesce(matched_buyers, 0) AS matched_buyers,
         CASE WHEN viewers > 0 THEN 100.0::DOUBLE * coalesce(matched_buyers, 0) / viewers END AS observed_conversion_pct
  FROM totals t LEFT JOIN buyers USING (product_id)
)"""

TIMINGS = """
timings AS (
  SELECT user_id, session_id, product_id, first_view, min(event_ts) AS first_purchase,
         CAST(epoch(date_trunc('second', min(event_ts))) - epoch(date_trunc('second', first_view)) AS BIGINT)
           AS seconds_to_purchase
  FROM silver JOIN pairs USING (user_id, session_id, product_id)
  WHERE event_type = 'purchase' AND event_ts >= first_view
  GROUP BY user_id, session_id, product_id, first_view
)"""

VISITS = """
broken AS (
  SELECT *, CASE WHEN event_ts <= lag(event_ts) OVER w + INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b
  FROM silver WINDOW w AS (PARTITION BY user_id ORDER BY event_ts)
),
numbered AS (
  SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY event_ts RANGE UNBOUNDED PRECEDING) AS visit FROM broken
),
visits AS (
  SELECT user_id, min(event_ts) AS session_start, max(event_ts) AS last_action, count(*) AS actions
  FROM numbered GROUP BY user_id, visit
)"""

SAMPLE = """
hashed AS (SELECT *, ('0x' || substr(sha256(event_id), 1, 8))::BIGINT AS bucket FROM silver),
fractions AS (SELECT unnest([0.01, 0.05, 0.1, 0.5, 1.0]::DOUBLE[]) AS fraction),
estimates AS (
  SELECT fraction, count(*) FILTER (bucket < fraction * 4294967296) AS sample_count,
    CAST(coalesce(sum(quantity * price_paise)
      FILTER (event_type = 'purchase' AND bucket < fraction * 4294967296), 0) AS BIGINT) AS sample_revenue_paise,
    count(*) AS exact_events,
    CAST(sum(CASE WHEN event_type = 'purchase' THEN quantity * price_paise ELSE 0 END) AS BIGINT) AS exact_revenue_paise
  FROM hashed, fractions GROUP BY fraction
),
scaled AS (
  SELECT fraction, sample_count, sample_revenue_paise, sample_count / fraction AS estimated_events,
         sample_revenue_paise / fraction AS estimated_revenue_paise, exact_events, exact_revenue_paise
  FROM estimates
)"""

DELIVERED = """
delivered AS (
  SELECT *, unnest(CASE WHEN source_row % 20 = 3 THEN [least(week + 3, 4)]
                        WHEN source_row % 20 = 13 THEN [least(week + 1, 4)]
                        WHEN source_row % 10 = 9 THEN [week, least(week + 1, 4)] ELSE [week] END) AS round
  FROM (SELECT *, CAST((day(event_ts) - 1) // 7 AS INTEGER) AS week FROM ev)
),
marks AS (
  SELECT CAST(r AS INTEGER) AS round, max(epoch_ms(event_ts)) - 864000000 AS mark
  FROM range(6) t(r) LEFT JOIN delivered d ON d.round < r AND event_type <> 'error' GROUP BY r
),
judged AS (
  SELECT d.*, event_type <> 'error' AND coalesce(epoch_us(event_ts) <= mark * 1000, false) AS late
  FROM delivered d JOIN marks USING (round)
),
accepted AS (
  SELECT * FROM judged WHERE event_type <> 'error' AND NOT late
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY round) = 1
),
rounds AS (
  SELECT round, count(*) AS delivered, count(*) FILTER (late) AS late,
         count(*) FILTER (event_type <> 'error' AND NOT late) AS in_time
  FROM judged GROUP BY round
),
kept AS (SELECT round, count(*) AS accepted FROM accepted GROUP BY round)"""

# Rows of the month's file, numbered as they stand in it, and the price text of a row.
NUMBERED = """
numbered_csv AS (SELECT *, row_number() OVER (ORDER BY source_row) AS line FROM history_routed)"""

CSV_PRICE = """CASE c WHEN 0 THEN 'NaN' WHEN 1 THEN '1.001'
  ELSE CAST(price_paise // 100 AS VARCHAR) || '.' || lpad(CAST(price_paise % 100 AS VARCHAR), 2, '0') END"""

# Lines of a file are taken in a year later: no time lies in the future.
FOUND_VALID = "(reject_reason IS NULL OR reject_reason = 'event timestamp too far in the future')"

EVENT_OUT = """event_id, user_id, session_id, event_type, product_id, 'Item ' || product_id AS product_name,
  category, quantity, price_paise, source_row, event_ts"""

COORDINATES = """'t' AS topic, CAST(source_row % 3 AS INTEGER) AS partition, source_row AS "offset" """


def _with(*parts: str, select: str) -> str:
    return "WITH " + ",".join([EV, *parts]) + "\n" + select


ORACLES: dict[str, str] = {
    "scan_events": "SELECT * FROM events",
    "count_guard": _with(
        select="""SELECT count(*) AS expected_rows, count(*) FILTER (WHERE period <> 'w1') AS actual_rows,
          count(*) = count(*) FILTER (WHERE period <> 'w1') AS matched FROM silver"""
    ),
    "prefix_sample": _with(
        CSV,
        select="""SELECT kind AS event_type, count(*) AS rows,
          min(happened) AS first_event_time, max(happened) AS last_event_time
        FROM csv WHERE source_row <= 500 GROUP BY kind""",
    ),
    "json_path": _with(
        select="""SELECT CASE WHEN source_row % 2 = 0 THEN 'real' ELSE 'synthetic' END AS data_source, event_type,
          count(*) AS records FROM mixed GROUP BY ALL"""
    ),
    "recent_events": _with(
        select=f"""SELECT {COORDINATES}, event_ts + INTERVAL 1 SECOND AS ingested_at, product_id
        FROM (SELECT * FROM mixed ORDER BY event_ts DESC, source_row DESC LIMIT 200)
        WHERE source_row % 2 = 0 ORDER BY event_ts DESC, source_row DESC LIMIT 10"""
    ),
    "parse_events": _with(
        select=f"""SELECT CAST(1 AS INTEGER) AS schema_version, {EVENT_OUT}, event_type <> 'error' AS valid,
          {COORDINATES}, event_ts + INTERVAL 1 SECOND AS ingested_at FROM ev"""
    ),
    "validate_events": _with(BAD, select='SELECT source_row AS "offset", reject_reason IS NULL AS valid FROM bad'),
    "silver_valid": _with(BAD, select=f"SELECT {EVENT_OUT} FROM bad WHERE reject_reason IS NULL"),
    "quarantine": _with(
        BAD,
        select=f"""SELECT {COORDINATES}, event_ts + INTERVAL 1 SECOND AS ingested_at
        FROM bad WHERE reject_reason IS NOT NULL""",
    ),
    "reject_reasons": _with(
        BAD, select='SELECT source_row AS "offset", reject_reason FROM bad WHERE reject_reason IS NOT NULL'
    ),
    "history_normalize": _with(
        CSV,
        select="""SELECT 'shop-2024-Jan-row-' || event_id AS event_id, source_row, happened AS event_time,
          kind AS event_type, product_id, user_id, CASE WHEN c <> 5 THEN session_id END AS session_id,
          cat AS category, 'brand-' || substr(product_id, 2) AS brand, price_paise AS price_minor,
          strftime(happened, '%Y-%m-%d') AS event_date
        FROM history_routed WHERE reason IS NULL""",
    ),
    "history_rejects": _with(
        CSV,
        select="""SELECT source_row, reason, CASE c WHEN 0 THEN 'NaN' WHEN 1 THEN '1.001'
          ELSE CAST(CAST(price_paise // 100 AS VARCHAR) || '.' || lpad(CAST(price_paise % 100 AS VARCHAR), 2, '0')
          AS VARCHAR) END AS price
        FROM history_routed WHERE reason IS NOT NULL""",
    ),
    "import_manifest": _with(
        CSV,
        select="""SELECT count(*) AS source_rows, count(*) FILTER (reason IS NULL) AS accepted_rows,
          count(*) FILTER (reason IS NOT NULL) AS rejected_rows,
          count(*) FILTER (reason IS NULL AND kind = 'view') AS view_rows,
          count(*) FILTER (reason IS NULL AND kind = 'cart') AS cart_rows,
          count(*) FILTER (reason IS NULL AND kind = 'purchase') AS purchase_rows,
          count(*) FILTER (reason IS NULL AND kind = 'remove_from_cart') AS remove_from_cart_rows,
          min(happened) FILTER (reason IS NULL) AS first_event_time, max(happened) FILTER (reason IS NULL) AS last_event_time
        FROM history_routed""",
    ),
    "replay_normalize": _with(
        CSV,
        select="""SELECT CAST(1 AS INTEGER) AS schema_version, 'shop-row-' || event_id AS event_id,
          strftime(happened, '%Y-%m-%dT%H:%M:%S+00:00') AS event_time, 'real:' || user_id AS user_id,
          'real:' || CASE WHEN c = 5 THEN 'missing-row-' || event_id ELSE session_id END AS session_id,
          kind AS event_type, 'real:' || product_id AS product_id, product_id AS product_name, cat AS category,
          CAST(1 AS BIGINT) AS quantity, price_paise, 'real' AS data_source,
          strftime(happened, '%Y-%m-%dT%H:%M:%S+00:00') AS source_event_time, 'SOURCE_UNITS' AS currency,
          c <> 5 AS session_observed, false AS quantity_observed, source_row
        FROM replay_routed WHERE accepted""",
    ),
    "replay_slice": _with(
        CSV,
        select="""SELECT position, 'replay-1:shop-row-' || event_id AS event_id,
          'replay-1:real:' || CASE WHEN c = 5 THEN 'missing-row-' || event_id ELSE session_id END AS session_id,
          '2024-02-01T00:00:00+00:00' AS event_time,
          strftime(happened, '%Y-%m-%dT%H:%M:%S+00:00') AS source_event_time, source_row
        FROM (SELECT *, row_number() OVER (ORDER BY source_row) AS position FROM replay_routed WHERE accepted)
        WHERE position > 100 AND position <= 600""",
    ),
    "union_by_name": _with(
        select="""SELECT event_id, event_type,
          CASE WHEN period IN ('w1', 'w3') THEN category END AS category FROM silver"""
    ),
    "event_type_profile": _with(
        select="""SELECT event_type, count(*) AS rows, min(event_ts) AS first_event_time,
          max(event_ts) AS last_event_time FROM silver GROUP BY event_type"""
    ),
    "dedup_exact": _with(
        select='SELECT event_id, source_row AS "offset", event_type, product_id, price_paise FROM silver'
    ),
    "conflicting_ids": _with(
        select="SELECT event_id, CAST(2 AS BIGINT) AS payload_variants FROM silver WHERE source_row % 100 = 7"
    ),
    "window_tumbling": _with(TUMBLING, select="SELECT * FROM tumbling"),
    "window_sliding": _with(SPREAD, SLIDING, select="SELECT * FROM sliding"),
    "approx_users": _with(
        SPREAD,
        select="""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, category, product_id,
          count(DISTINCT user_id) AS active_users_exact, true AS within_bound FROM spread GROUP BY ALL""",
    ),
    "approx_error": _with(
        select="""SELECT count(DISTINCT user_id) AS active_users_exact, true AS within_bound, true AS close
        FROM silver"""
    ),
    "window_exact_users": _with(
        select=f"""SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS window_start,
          time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS window_end, category, product_id,
          {MEASURES}, count(DISTINCT user_id) AS active_users_exact FROM silver GROUP BY ALL"""
    ),
    "window_sliding_exact_users": _with(
        SPREAD,
        select=f"""SELECT window_start, window_start + INTERVAL 5 MINUTE AS window_end, category, product_id,
          {MEASURES}, count(DISTINCT user_id) AS active_users_exact FROM spread GROUP BY ALL""",
    ),
    "snapshot_totals": _with(
        select="""SELECT count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases,
          CAST(sum(CASE WHEN event_type = 'purchase' THEN quantity * price_paise ELSE 0 END) AS BIGINT)
            AS revenue_paise,
          count(DISTINCT user_id) AS active_users_exact FROM silver"""
    ),
    "window_rollup": _with(select=f"SELECT {MEASURES} FROM silver"),
    "source_isolation": _with(
        select="""SELECT count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases,
          CAST(sum(CASE WHEN event_type = 'purchase' THEN quantity * price_paise ELSE 0 END) AS BIGINT)
            AS revenue_paise,
          count(DISTINCT user_id) AS active_users_exact,
          CASE WHEN product_id LIKE 'real:%' THEN 'real' ELSE 'synthetic' END AS data_source
        FROM mixed GROUP BY data_source"""
    ),
    "period_totals": _with(
        select="""SELECT label AS period, count(event_id) AS events,
          count(*) FILTER (event_type = 'purchase') AS purchases,
          CAST(coalesce(sum(quantity * price_paise) FILTER (event_type = 'purchase'), 0) AS BIGINT) AS revenue_paise,
          count(*) FILTER (event_type = 'view') AS views, count(*) FILTER (event_type = 'cart') AS carts
        FROM (VALUES ('All processed events', NULL), ('Last 5 minutes', 5), ('Last 15 minutes', 15),
                     ('Last 30 minutes', 30)) p(label, minutes)
        LEFT JOIN mixed ON product_id LIKE 'real:%' AND (minutes IS NULL
          OR time_bucket(INTERVAL 1 MINUTE, event_ts) >=
             date_trunc('minute', (SELECT max(event_ts) FROM mixed)) - minutes * INTERVAL 1 MINUTE)
        GROUP BY label"""
    ),
    "action_mix": _with(
        select="""SELECT unnest(['Viewed a product', 'Added to cart', 'Purchased', 'Other actions']) AS action,
          unnest([count(*) FILTER (event_type = 'view'), count(*) FILTER (event_type = 'cart'),
                  count(*) FILTER (event_type = 'purchase'),
                  count(*) FILTER (event_type NOT IN ('view', 'cart', 'purchase'))]) AS "count"
        FROM silver"""
    ),
    "avg_purchase_value": _with(
        select="""SELECT CAST(sum(quantity * price_paise) AS DOUBLE) / 100.0 AS purchase_value,
          CAST(sum(quantity * price_paise) AS DOUBLE) / CAST(count(*) * 100 AS DOUBLE) AS avg_purchase_value
        FROM silver WHERE event_type = 'purchase'"""
    ),
    "top_by_metric": _with(
        select="""SELECT grain, metric, key, CAST(value AS BIGINT) AS value FROM (
          SELECT *, row_number() OVER (PARTITION BY grain, metric ORDER BY value DESC, key) AS r FROM (
            SELECT grain, metric, CASE grain WHEN 'product_id' THEN product_id ELSE category END AS key,
              sum(CASE WHEN metric = 'views' THEN CAST(event_type = 'view' AS BIGINT)
                       WHEN metric = 'carts' THEN CAST(event_type = 'cart' AS BIGINT)
                       WHEN metric = 'purchases' THEN CAST(event_type = 'purchase' AS BIGINT)
                       WHEN event_type = 'purchase' THEN quantity * price_paise ELSE 0 END) AS value
            FROM silver, (VALUES ('product_id'), ('category')) g(grain),
                 (VALUES ('views'), ('carts'), ('purchases'), ('revenue_paise')) m(metric)
            GROUP BY ALL))
        WHERE r <= 10"""
    ),
    "trending": _with(
        SPREAD,
        SLIDING,
        select="""SELECT product_id, views, purchases, window_start, window_end FROM sliding
        WHERE window_start = (SELECT max(window_start) FROM sliding)
        ORDER BY views DESC, product_id, category LIMIT 10""",
    ),
    "display_labels": _with(
        select="""SELECT product_id, 'home.' || category || '_goods' AS category, count(*) AS events,
          CASE product_id WHEN 'P01' THEN 'Kettle' WHEN 'P02' THEN 'Floor lamp'
            ELSE 'Product ' || replace(product_id, 'real:', '') END AS product_label,
          'Home › ' || lower(category) || ' goods' AS category_label,
          CAST(sum(CASE WHEN event_type = 'purchase' THEN quantity * price_paise ELSE 0 END) AS BIGINT)
            AS revenue_paise,
          '€' || format('{:,}', revenue_paise // 100) || '.' || lpad(CAST(revenue_paise % 100 AS VARCHAR), 2, '0')
            AS money_label
        FROM mixed GROUP BY ALL"""
    ),
    "upsert_latest_wins": _with(
        TUMBLING, select="SELECT *, 'sales-1m-v1' AS query_name, CAST(1 AS BIGINT) AS epoch_id FROM tumbling"
    ),
    "reconcile": _with(
        TUMBLING,
        """
actual AS (
  SELECT * REPLACE (CASE product_id WHEN 'P04' THEN 'PX4' ELSE product_id END AS product_id,
                    views + CAST(product_id = 'P02' AS BIGINT) AS views)
  FROM tumbling WHERE product_id <> 'P01'
)""",
        select="""SELECT coalesce(e.window_start, a.window_start) AS window_start,
          coalesce(e.window_end, a.window_end) AS window_end, coalesce(e.category, a.category) AS category,
          coalesce(e.product_id, a.product_id) AS product_id,
          CASE WHEN a.events IS NULL THEN 'missing' WHEN e.events IS NULL THEN 'unexpected' ELSE 'different' END
            AS status,
          e.events::DOUBLE AS expected_events, e.purchases::DOUBLE AS expected_purchases,
          e.revenue_paise::DOUBLE AS expected_revenue_paise, e.views::DOUBLE AS expected_views,
          e.carts::DOUBLE AS expected_carts, a.events::DOUBLE AS actual_events,
          a.purchases::DOUBLE AS actual_purchases, a.revenue_paise::DOUBLE AS actual_revenue_paise,
          a.views::DOUBLE AS actual_views, a.carts::DOUBLE AS actual_carts
        FROM tumbling e FULL JOIN actual a
          ON e.window_start = a.window_start AND e.category = a.category AND e.product_id = a.product_id
        WHERE (e.events, e.purchases, e.revenue_paise, e.views, e.carts)
          IS DISTINCT FROM (a.events, a.purchases, a.revenue_paise, a.views, a.carts)""",
    ),
    "monthly_summary": _with(PERIODS, select="SELECT * FROM summary ORDER BY period"),
    "history_overview": _with(
        select="""SELECT count(*) AS events, count(*) FILTER (event_type = 'view') AS views,
          count(*) FILTER (event_type = 'cart') AS carts, count(*) FILTER (event_type = 'purchase') AS purchases,
          CAST(sum(CASE WHEN event_type = 'purchase' THEN price_paise ELSE 0 END) AS BIGINT) AS revenue_paise
        FROM silver"""
    ),
    "customer_months": _with(PERIODS, select="SELECT * FROM known"),
    "first_observed": _with(select="SELECT user_id, min(period) AS first_observed FROM silver GROUP BY user_id"),
    "customer_behaviour": _with(
        PERIODS,
        select="""SELECT period, count(*) AS active_customers,
          count(*) FILTER (period > first_observed) AS returning_customers, count(*) FILTER (views > 0) AS viewers,
          count(*) FILTER (carts > 0) AS cart_users, count(*) FILTER (purchases > 0) AS purchasers,
          count(*) FILTER (purchases > 1) AS multiple_purchase_record_customers
        FROM known GROUP BY period ORDER BY period""",
    ),
    "category_interest": _with(
        select="""SELECT category, count(*) AS views, count(DISTINCT user_id) AS viewers
        FROM silver WHERE event_type = 'view' GROUP BY category ORDER BY views DESC, category LIMIT 20"""
    ),
    "product_totals": _with(PAIRS, PRODUCTS, select="SELECT * FROM totals"),
    "product_performance": _with(PAIRS, PRODUCTS, select="SELECT * FROM products"),
    "matched_buyers": _with(PAIRS, PRODUCTS, select="SELECT * FROM buyers"),
    "top_products": _with(
        PAIRS, PRODUCTS, select="SELECT * FROM products ORDER BY views DESC, product_id LIMIT 100"
    ),
    "rank_products": _with(
        PAIRS,
        PRODUCTS,
        select="""SELECT * FROM (SELECT * FROM products ORDER BY views DESC, product_id LIMIT 100)
        ORDER BY observed_conversion_pct DESC NULLS LAST, product_id""",
    ),
    "journey_pairs": _with(PAIRS, select="SELECT * FROM pairs"),
    "view_to_purchase": _with(PAIRS, TIMINGS, select="SELECT * FROM timings"),
    "time_to_purchase": _with(
        PAIRS,
        TIMINGS,
        select="""SELECT count(*) AS matched_session_products,
          quantile_disc(seconds_to_purchase, 0.5) AS median_seconds_to_purchase FROM timings""",
    ),
    "funnel_batch": _with(
        """
sessions AS (
  SELECT session_id, min(event_ts) FILTER (event_type = 'cart') AS first_cart,
         max(event_ts) FILTER (event_type = 'purchase') AS last_purchase
  FROM silver WHERE source_row % 5 <> 0 GROUP BY session_id
)""",
        select="""SELECT count(first_cart) AS cart_sessions,
          count(*) FILTER (last_purchase >= first_cart) AS converted_sessions,
          CAST(count(*) FILTER (last_purchase >= first_cart) AS DOUBLE) / count(first_cart) AS conversion_rate
        FROM sessions""",
    ),
    "funnel_history": _with(
        """
sessions AS (
  SELECT user_id, session_id, min(event_ts) FILTER (event_type = 'cart') AS first_cart,
         max(event_ts) FILTER (event_type = 'purchase') AS last_purchase
  FROM silver GROUP BY user_id, session_id
)""",
        select="""SELECT count(first_cart) AS cart_sessions,
          count(*) FILTER (last_purchase >= first_cart) AS converted_sessions,
          CAST(count(*) FILTER (last_purchase >= first_cart) AS DOUBLE) / count(first_cart) AS conversion_rate
        FROM sessions""",
    ),
    "inferred_sessions": _with(VISITS, select="SELECT * FROM visits"),
    "inferred_session_count": _with(VISITS, select="SELECT count(*) AS inferred_sessions FROM visits"),
    "session_timelines": _with(
        """
chosen AS (
  SELECT user_id, session_id, count(*) AS total_actions FROM silver
  GROUP BY user_id, session_id ORDER BY user_id, session_id LIMIT 10
)""",
        select="""SELECT user_id, session_id, event_ts AS event_time, source_row, event_type, product_id, category,
          price_paise AS price_minor, total_actions,
          CAST(row_number() OVER (PARTITION BY user_id, session_id ORDER BY event_ts, source_row) AS INTEGER)
            AS position,
          total_actions > 200 AS timeline_truncated
        FROM silver JOIN chosen USING (user_id, session_id) QUALIFY position <= 200""",
    ),
    "hash_sample": _with(
        SAMPLE, select="SELECT event_id, event_type, price_paise FROM hashed WHERE bucket < 0.1::DOUBLE * 4294967296"
    ),
    "sample_estimate": _with(
        SAMPLE, select="SELECT * EXCLUDE (exact_events, exact_revenue_paise) FROM scaled"
    ),
    "sampling_error": _with(
        SAMPLE,
        select="""SELECT *, (estimated_events - exact_events) / exact_events AS event_relative_error,
          (estimated_revenue_paise - exact_revenue_paise) / exact_revenue_paise AS revenue_relative_error FROM scaled""",
    ),
    "reservoir_sample": _with(
        select="SELECT event_id, product_id FROM silver ORDER BY sha256('404:' || event_id), event_id LIMIT 1000"
    ),
    "cms_estimate": _with(
        """
digests AS (SELECT user_id, sha256('0:' || user_id) AS d, count(*) AS n FROM silver GROUP BY user_id),
cells AS (
  SELECT user_id, n, seed, ('0x' || substr(d, CAST(seed * 8 + 1 AS BIGINT), 8))::BIGINT % 272 AS cell
  FROM digests, range(5) s(seed)
),
sketch AS (SELECT seed, cell, CAST(sum(n) AS BIGINT) AS hits FROM cells GROUP BY ALL)""",
        select="""SELECT user_id, n AS exact, min(hits) AS estimate, min(hits) - n AS overcount
        FROM cells JOIN sketch USING (seed, cell) GROUP BY user_id, n ORDER BY n DESC, user_id LIMIT 20""",
    ),
    "bloom_membership": _with(
        """
shape AS (
  SELECT *, CAST(ceil(bits / buckets) AS BIGINT) AS size FROM (
    SELECT bits, CAST(greatest(1, round(bits / n * ln(2))) AS BIGINT) AS hashes,
           CAST(ceil(bits / 32768) AS BIGINT) AS buckets
    FROM (SELECT count(*) AS n, CAST(ceil(-count(*) * ln(0.01) / (ln(2) * ln(2))) AS BIGINT) AS bits
          FROM silver WHERE event_type = 'purchase'))
),
digests AS (
  SELECT event_id, event_type = 'purchase' AS inserted, sha256('0:' || event_id) AS d FROM silver
),
cells AS (
  SELECT event_id, inserted, ('0x' || substr(d, 1, 8))::BIGINT % buckets AS bucket,
         ('0x' || substr(d, CAST(seed * 8 + 1 AS BIGINT), 8))::BIGINT % size AS cell
  FROM digests, shape, range(1, 8) s(seed) WHERE seed <= hashes
),
bitset AS (SELECT DISTINCT bucket, cell FROM cells WHERE inserted),
answers AS (
  SELECT event_id, inserted, bool_and(b.cell IS NOT NULL) AS present
  FROM cells c LEFT JOIN bitset b USING (bucket, cell) GROUP BY event_id, inserted
)""",
        select="""SELECT count(*) FILTER (NOT inserted) AS absent_probes,
          count(*) FILTER (NOT inserted AND present) AS false_positives,
          100.0::DOUBLE * count(*) FILTER (NOT inserted AND present) / count(*) FILTER (NOT inserted)
            AS observed_false_positive_pct,
          count(*) FILTER (inserted) AS inserted,
          count(*) FILTER (inserted AND NOT present) AS false_negatives
        FROM answers""",
    ),
    "batch_report": _with(
        SAMPLE,
        """
sessions AS (
  SELECT session_id, min(event_ts) FILTER (event_type = 'cart') AS first_cart,
         max(event_ts) FILTER (event_type = 'purchase') AS last_purchase
  FROM silver GROUP BY session_id
),
funnel AS (
  SELECT count(first_cart) AS cart_sessions, count(*) FILTER (last_purchase >= first_cart) AS converted_sessions
  FROM sessions
)""",
        select="""SELECT 'synthetic' AS data_source, 'events' AS source,
          'Generated records: every purchase is an order of one product.' AS definition, count(*) AS events,
          count(*) FILTER (event_type = 'purchase') AS purchases,
          CAST(sum(CASE WHEN event_type = 'purchase' THEN quantity * price_paise ELSE 0 END) AS BIGINT)
            AS revenue_paise,
          count(DISTINCT user_id) AS active_users_exact,
          (SELECT fraction FROM scaled WHERE fraction = 0.1::DOUBLE) AS fraction,
          (SELECT sample_count FROM scaled WHERE fraction = 0.1::DOUBLE) AS sample_count,
          (SELECT sample_revenue_paise FROM scaled WHERE fraction = 0.1::DOUBLE) AS sample_revenue_paise,
          (SELECT estimated_events FROM scaled WHERE fraction = 0.1::DOUBLE) AS estimated_events,
          (SELECT estimated_revenue_paise FROM scaled WHERE fraction = 0.1::DOUBLE) AS estimated_revenue_paise,
          (SELECT cart_sessions FROM funnel) AS cart_sessions,
          (SELECT converted_sessions FROM funnel) AS converted_sessions,
          count(*) FILTER (source_row % 100 = 7) AS conflicting_event_ids
        FROM silver""",
    ),
    "nearest_rank": _with(
        """
ranked AS (
  SELECT event_type, price_paise, row_number() OVER (PARTITION BY event_type ORDER BY price_paise) AS r,
         count(*) OVER (PARTITION BY event_type) AS n
  FROM silver
)""",
        select="""SELECT event_type, probability, n, price_paise AS percentile
        FROM ranked, (SELECT unnest([0.5, 0.95]::DOUBLE[]) AS probability)
        WHERE r = greatest(CAST(ceil(n * probability) AS BIGINT), 1)""",
    ),
    "stream_silver": _with(select=f"SELECT {EVENT_OUT} FROM silver"),
    "stream_quarantine": _with(
        select=f"""SELECT {COORDINATES}, event_ts + INTERVAL 1 SECOND AS ingested_at
        FROM ev, range(2) t(copy) WHERE event_type = 'error' AND (copy = 0 OR source_row % 10 = 9)"""
    ),
    "stream_tumbling": _with(TUMBLING, select="SELECT * FROM tumbling"),
    "stream_sliding": _with(SPREAD, SLIDING, select="SELECT * FROM sliding"),
    "stream_late_rows": _with(
        DELIVERED,
        select="""SELECT round, delivered, late, in_time - coalesce(accepted, 0) AS repeated,
          coalesce(accepted, 0) AS accepted FROM rounds LEFT JOIN kept USING (round)""",
    ),
    "stream_restart": _with(
        DELIVERED,
        select=f"""SELECT time_bucket(INTERVAL 1 MINUTE, event_ts) AS window_start,
          time_bucket(INTERVAL 1 MINUTE, event_ts) + INTERVAL 1 MINUTE AS window_end, category, product_id, {MEASURES}
        FROM accepted GROUP BY ALL""",
    ),
    "stream_state": _with(
        DELIVERED,
        select="""SELECT event_id, event_ts + INTERVAL 10 DAY AS known_until FROM accepted
        WHERE epoch_us(event_ts) + 864000000000 > (SELECT mark FROM marks WHERE round = 5) * 1000""",
    ),
    "pipeline_health": """SELECT query_name, step, 'Recent progress' AS state, CAST(0 AS BIGINT) AS seconds_since_update,
          'Idle or needs checking' AS state_later, CAST(3600 AS BIGINT) AS seconds_later
        FROM (VALUES ('bronze-v1', 'raw records'), ('silver-v1', 'valid events, once each'),
                     ('quarantine-v1', 'refused records'), ('sales-1m-v1', 'totals by minute'),
                     ('trending-5m-v1', 'activity over five minutes')) q(query_name, step)""",
    "quality_counters": _with(
        DELIVERED,
        select="""SELECT query_name,
          CASE WHEN query_name = 'silver-v1' THEN (in_time - coalesce(accepted, 0))::DOUBLE END AS repeated_events_removed,
          CASE query_name WHEN 'silver-v1' THEN late::DOUBLE WHEN 'sales-1m-v1' THEN 0::DOUBLE WHEN 'trending-5m-v1' THEN 0::DOUBLE END
            AS late_events_removed
        FROM rounds LEFT JOIN kept USING (round),
             (VALUES ('bronze-v1'), ('silver-v1'), ('quarantine-v1'), ('sales-1m-v1'), ('trending-5m-v1')) q(query_name)
        WHERE round = 4""",
    ),
    "stage_throughput": _with(
        DELIVERED,
        select="""SELECT query_name, count(*) AS batches,
          CAST(sum(CASE WHEN query_name IN ('sales-1m-v1', 'trending-5m-v1') THEN accepted ELSE delivered END) AS BIGINT)
            AS rows,
          true AS measured
        FROM rounds JOIN kept USING (round),
             (VALUES ('bronze-v1'), ('silver-v1'), ('quarantine-v1'), ('sales-1m-v1'), ('trending-5m-v1')) q(query_name)
        GROUP BY query_name""",
    ),

    "merged_users": _with(
        SPREAD,
        """
grains AS (
  SELECT 'window' AS grain, strftime(window_start, '%Y-%m-%d %H:%M') AS key, user_id FROM spread
  UNION ALL SELECT 'period', period, user_id FROM silver
  UNION ALL SELECT 'category', category, user_id FROM silver
  UNION ALL SELECT 'all', 'all', user_id FROM silver
)""",
        select="SELECT grain, key, count(DISTINCT user_id) AS active_users_exact, true AS within_bound FROM grains GROUP BY ALL",
    ),
    "price_quantiles": _with(
        select="""SELECT product_id, probability, count(price_paise) AS n, true AS within_bound
        FROM silver, (SELECT unnest([0.1, 0.5, 0.95]::DOUBLE[]) AS probability) GROUP BY ALL"""
    ),
    "purchase_time_quantiles": _with(
        PAIRS,
        TIMINGS,
        select="""SELECT product_id, probability, count(*) AS n, true AS within_bound
        FROM timings, (SELECT unnest([0.5, 0.9]::DOUBLE[]) AS probability) GROUP BY ALL""",
    ),
    "source_rows": _with(
        CSV,
        select=f"""SELECT compression, row_number() OVER (PARTITION BY compression ORDER BY source_row) AS source_row,
          strftime(happened, '%Y-%m-%d %H:%M:%S UTC') AS event_time, product_id, {CSV_PRICE} AS price
        FROM csv, (VALUES ('none'), ('gzip')) k(compression)""",
    ),
    "month_import": _with(
        CSV,
        select="""SELECT '2024-Jan' AS month, 'complete' AS status,
          count(*) AS source_rows, count(*) FILTER (reason IS NULL) AS accepted_rows,
          count(*) FILTER (reason IS NOT NULL) AS rejected_rows,
          count(*) FILTER (reason IS NULL AND kind = 'view') AS view_rows,
          count(*) FILTER (reason IS NULL AND kind = 'cart') AS cart_rows,
          count(*) FILTER (reason IS NULL AND kind = 'purchase') AS purchase_rows,
          count(*) FILTER (reason IS NULL AND kind = 'remove_from_cart') AS remove_from_cart_rows,
          min(happened) FILTER (reason IS NULL) AS first_event_time, max(happened) FILTER (reason IS NULL) AS last_event_time,
          count(*) FILTER (reason IS NULL) AS stored_rows
        FROM history_routed""",
    ),
    "month_events": _with(
        CSV,
        NUMBERED,
        select="""SELECT 'shop-2024-Jan-row-' || line AS event_id, line AS source_row, happened AS event_time,
          kind AS event_type, product_id, user_id, CASE WHEN c <> 5 THEN session_id END AS session_id,
          cat AS category, 'brand-' || substr(product_id, 2) AS brand, price_paise AS price_minor,
          strftime(happened, '%Y-%m-%d') AS event_date
        FROM numbered_csv WHERE reason IS NULL""",
    ),
    "month_rejects": _with(
        CSV,
        NUMBERED,
        select=f"SELECT line AS source_row, reason, {CSV_PRICE} AS price FROM numbered_csv WHERE reason IS NOT NULL",
    ),
    "republished_dates": _with(
        select="""SELECT event_id, event_ts AS event_time, strftime(event_ts, '%Y-%m-%d') AS event_date,
          price_paise + CASE WHEN strftime(event_ts, '%Y-%m-%d') IN ('2024-01-05', '2024-01-20') THEN 1 ELSE 0 END
            AS price_minor
        FROM silver"""
    ),
    "bucketed_customers": _with(PERIODS, select="SELECT * FROM periods"),
    "bucketed_journeys": _with(PAIRS, select="SELECT * FROM pairs"),
    "merged_scan": _with(
        select="""SELECT event_id, event_ts, price_paise, CASE WHEN source_row % 2 = 1 THEN source_row::DOUBLE END AS source_row,
          CAST(CASE WHEN source_row % 2 = 0 THEN 1 ELSE 2 END AS INTEGER) AS generation FROM silver"""
    ),
    "months_union": _with(
        select="""SELECT event_id, event_type,
          CASE WHEN period IN ('w1', 'w3') THEN category END AS category FROM silver"""
    ),
    "path_prefix_sample": _with(
        select="SELECT event_id, source_row, event_type FROM silver ORDER BY source_row LIMIT 500"
    ),
    "json_lines": _with(
        BAD,
        select=f"SELECT row_number() OVER (ORDER BY source_row) AS line, {FOUND_VALID} AS valid FROM bad",
    ),
    "nested_timelines": _with(
        """
chosen AS (
  SELECT user_id, session_id, count(*) AS total_actions FROM silver
  GROUP BY user_id, session_id ORDER BY user_id, session_id LIMIT 10
),
shown AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, session_id ORDER BY event_ts, source_row) AS position
  FROM silver JOIN chosen USING (user_id, session_id)
)""",
        select="""SELECT user_id, session_id, total_actions, CAST(count(*) AS INTEGER) AS shown,
          string_agg(event_type || ':' || product_id, ',' ORDER BY position) AS steps
        FROM shown WHERE position <= 200 GROUP BY ALL""",
    ),
    "snapshot_report": _with(
        TUMBLING,
        """
sessions AS (
  SELECT session_id, min(event_ts) FILTER (event_type = 'cart') AS first_cart,
         max(event_ts) FILTER (event_type = 'purchase') AS last_purchase
  FROM silver GROUP BY session_id
)""",
        select="""SELECT 'r' AS run_id, count(*) AS events, count(*) FILTER (event_type = 'purchase') AS purchases,
          CAST(sum(CASE WHEN event_type = 'purchase' THEN quantity * price_paise ELSE 0 END) AS BIGINT) AS revenue_paise,
          count(DISTINCT user_id) AS active_users_exact,
          (SELECT count(first_cart) FROM sessions) AS cart_sessions,
          (SELECT count(*) FILTER (last_purchase >= first_cart) FROM sessions) AS converted_sessions,
          CAST(0 AS BIGINT) AS conflicting_event_ids,
          'Generated records: every purchase is an order of one product.' AS definition,
          (SELECT count(*) FROM tumbling) AS windows, count(*) AS window_events
        FROM silver""",
    ),
    "customer_report": _with(
        CSV,
        select="""SELECT count(*) AS accepted_rows, '2024-01' AS period, count(*) AS actions,
          count(DISTINCT user_id) AS customers, count(*) FILTER (kind = 'view') AS views,
          count(*) FILTER (kind = 'cart') AS carts, count(*) FILTER (kind = 'purchase') AS purchases,
          CAST(sum(CASE WHEN kind = 'purchase' THEN price_paise ELSE 0 END) AS DOUBLE) / 100.0 AS purchase_price_sum
        FROM history_routed WHERE reason IS NULL""",
    ),
    "fixture_report": _with(
        BAD,
        select=f"""SELECT count(*) + count(*) FILTER (source_row % 10 = 9) AS input_lines,
          count(*) FILTER (source_row % 10 = 9 AND {FOUND_VALID}) AS duplicate_records,
          count(*) FILTER ({FOUND_VALID}) AS events,
          count(*) FILTER ({FOUND_VALID} AND event_type = 'purchase') AS purchases,
          CAST(sum(CASE WHEN {FOUND_VALID} AND event_type = 'purchase' THEN quantity * price_paise ELSE 0 END) AS BIGINT)
            AS revenue_paise
        FROM bad""",
    ),
}
ORACLES["recent_events_pruned"] = ORACLES["recent_events"]
