"""The same results as SQL over the given tables."""

from __future__ import annotations

from clickloom.workload.adapter import CUTOFF, HORIZON

_CUT = f"session_start_time < TIMESTAMP '{CUTOFF}'"
RETRAIN_AS_OF = "2024-01-28T00:00:00"


def _base(scope: str = "", cut: str = _CUT) -> str:
    """All layers as named subqueries; ``scope`` narrows the silver rows."""
    return f"""
WITH base AS (
  SELECT event_id, ts, user_id, value,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k,
    CASE event_type WHEN 'click' THEN 'cart' WHEN 'error' THEN 'remove_from_cart'
      ELSE event_type END AS kind
  FROM events
), shaped AS (
  SELECT
    CASE WHEN k = 77 THEN 'not a time'
      ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || ' UTC' END AS event_time,
    kind AS event_type,
    'p' || k AS product_id,
    CASE WHEN k <> 13 THEN 'c' || (k % 10) END AS category_id,
    'u' || user_id AS user_id,
    'u' || user_id || '-w' || (epoch_us(ts) // 604800000000) AS user_session,
    CASE WHEN k % 3 <> 0 THEN 'cat.' || (k % 7) END AS category_code,
    CASE WHEN k % 4 <> 0 THEN 'brand-' || (k % 5) END AS brand,
    CASE WHEN value < 1 THEN 0.0 WHEN value <= 200 THEN value END AS price,
    event_id * 2 AS input_order
  FROM base
), raw AS (
  SELECT * FROM shaped
  UNION ALL
  SELECT event_time, event_type, product_id, category_id, user_id, user_session,
    category_code, 'dup' AS brand, price, input_order + 1
  FROM shaped WHERE event_type = 'purchase'
), bronze AS (
  SELECT try_strptime(replace(event_time, ' UTC', ''), '%Y-%m-%d %H:%M:%S')
      AS source_event_time,
    event_type, product_id, category_id, user_id, user_session, category_code,
    brand, price, input_order
  FROM raw
  WHERE event_type IN ('view', 'cart', 'remove_from_cart', 'purchase')
), clean AS (
  SELECT * FROM bronze
  WHERE source_event_time IS NOT NULL AND category_id IS NOT NULL
    AND event_type IS NOT NULL AND product_id IS NOT NULL
    AND user_id IS NOT NULL AND user_session IS NOT NULL
    AND (price IS NULL OR price > 0)
), silver AS (
  SELECT source_event_time, event_type, product_id, category_id, user_id,
    user_session, category_code, brand, price
  FROM (SELECT *, row_number() OVER (
      PARTITION BY user_session, source_event_time, event_type, product_id, user_id
      ORDER BY input_order) AS rn FROM clean)
  WHERE rn = 1 {scope}
), sessions AS (
  SELECT user_session, min(source_event_time) AS session_start_time,
    max(source_event_time) AS session_end_time
  FROM silver GROUP BY user_session
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY session_start_time, user_session) - 1 AS rank,
    count(*) OVER () AS n
  FROM sessions WHERE {cut}
), split_map AS (
  SELECT user_session, session_start_time, session_end_time,
    CASE WHEN rank < CAST(floor(CAST(n AS DOUBLE) * CAST(0.8 AS DOUBLE)) AS BIGINT)
        THEN 'train'
      WHEN rank < CAST(floor(CAST(n AS DOUBLE) * CAST(0.9 AS DOUBLE)) AS BIGINT)
        THEN 'val'
      ELSE 'test' END AS split
  FROM ranked
), stated AS (
  SELECT *,
    epoch_us(source_event_time) AS us,
    coalesce(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER w, 0)
      AS views,
    coalesce(sum(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) OVER w, 0)
      AS carts,
    coalesce(sum(CASE WHEN event_type = 'remove_from_cart' THEN 1 ELSE 0 END)
      OVER w, 0) AS removes,
    count(DISTINCT product_id) OVER w AS products,
    count(DISTINCT coalesce(category_code, category_id)) OVER w AS categories,
    epoch_us(source_event_time)
      - min(epoch_us(source_event_time)) OVER (PARTITION BY user_session) AS elapsed
  FROM silver
  WINDOW w AS (PARTITION BY user_session
    ORDER BY source_event_time, event_type, product_id, user_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), gold AS (
  SELECT source_event_time, category_id, user_session, user_id, event_type,
    product_id, category_code, brand, price,
    CAST(views AS BIGINT) AS total_views, CAST(carts AS BIGINT) AS total_carts,
    CAST(carts - removes AS BIGINT) AS net_cart_count,
    CASE WHEN views = 0 THEN 0.0
      ELSE CAST(carts AS DOUBLE) / CAST(views AS DOUBLE) END AS cart_to_view_ratio,
    CAST(categories AS BIGINT) AS unique_categories,
    CAST(products AS BIGINT) AS unique_products,
    CAST(elapsed AS DOUBLE) / CAST(1000000 AS DOUBLE) AS session_duration_sec,
    CAST(coalesce(max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (
      PARTITION BY user_session ORDER BY us
      RANGE BETWEEN 1 FOLLOWING AND {HORIZON * 1_000_000} FOLLOWING), 0)
      AS TINYINT) AS label
  FROM stated
), signals AS (
  SELECT *, CAST(total_views + 2 * total_carts + 3 * unique_products AS DOUBLE)
    + coalesce(price, 0.0) / CAST(10 AS DOUBLE) AS signal
  FROM gold
), scored AS (
  SELECT * EXCLUDE (signal), signal / (signal + CAST(25 AS DOUBLE)) AS score
  FROM signals
), counts AS (
  SELECT score, sum(CAST(label AS BIGINT)) AS positives, count(*) AS n
  FROM scored GROUP BY score
), steps AS (
  SELECT score, positives, n, sum(positives) OVER w AS hits, sum(n) OVER w AS taken,
    sum(positives) OVER () AS total
  FROM counts WINDOW w AS (ORDER BY score DESC)
), curve AS (
  SELECT score, hits, taken, total, positives, n,
    CAST(hits AS DOUBLE) / CAST(taken AS DOUBLE) AS p,
    CAST(hits AS DOUBLE) / CAST(total AS DOUBLE) AS r,
    CASE WHEN taken = n THEN 1.0
      ELSE CAST(hits - positives AS DOUBLE) / CAST(taken - n AS DOUBLE) END AS p0,
    CAST(hits - positives AS DOUBLE) / CAST(total AS DOUBLE) AS r0
  FROM steps
), predictions AS (
  SELECT sha256(concat_ws('|', user_session,
      strftime(source_event_time, '%Y-%m-%dT%H:%M:%S'), event_type, product_id,
      user_id)) AS prediction_id,
    user_session,
    source_event_time + length(product_id) * INTERVAL 1 SECOND AS prediction_time,
    score AS purchase_probability,
    CASE WHEN unique_products = 0 THEN 'fallback' ELSE 'model' END AS prediction_mode,
    CASE WHEN event_type = 'view' THEN 'demo_replay' ELSE 'offline_backfill' END
      AS evaluation_mode,
    source_event_time,
    source_event_time + INTERVAL 2 SECOND AS replay_time
  FROM scored
), labelled AS (
  SELECT p.*, CASE WHEN EXISTS (
      SELECT 1 FROM silver s WHERE s.event_type = 'purchase'
        AND s.user_session = p.user_session
        AND CASE WHEN p.evaluation_mode = 'offline_backfill'
          THEN s.source_event_time > p.source_event_time
            AND s.source_event_time
              <= p.source_event_time + INTERVAL {HORIZON} SECOND
          ELSE s.source_event_time + INTERVAL 2 SECOND > p.prediction_time
            AND s.source_event_time + INTERVAL 2 SECOND
              <= p.prediction_time + INTERVAL {HORIZON} SECOND END)
    THEN 1 ELSE 0 END AS actual_purchase
  FROM predictions p
)
"""

_EVENT = (
    "source_event_time, event_type, product_id, category_id, user_id, user_session, "
    "category_code, brand, price"
)
_KEY = "user_session, source_event_time, event_type, product_id, user_id"


def _quantiles(value: str, marks: dict[str, float]) -> str:
    return ", ".join(
        f"round(quantile_cont({value}, {p}), 6) AS {name}" for name, p in marks.items()
    )


_PRICE_MARKS = {
    "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99,
}
_FIELDS = (
    "event_time", "event_type", "product_id", "category_id", "user_id",
    "user_session", "category_code", "brand", "price",
)
_NUMBERS = (
    "total_views", "total_carts", "net_cart_count", "cart_to_view_ratio",
    "unique_categories", "unique_products", "session_duration_sec", "price",
)
_CATEGORIES = ("category_id", "category_code", "brand", "event_type")

_MISSING = " UNION ALL ".join(
    f"SELECT '{c}' AS field, count(*) FILTER ({c} IS NULL) AS missing_count, "
    f"round(count(*) FILTER ({c} IS NULL) * 100.0 / count(*), 6) AS missing_pct "
    "FROM raw"
    for c in _FIELDS
)
_NUMBER_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS DOUBLE) AS value FROM gold"
    for c in _NUMBERS
)
_TEXT_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value FROM silver WHERE {c} IS NOT NULL"
    for c in (
        "event_type", "product_id", "category_id", "user_id", "user_session",
        "category_code", "brand",
    )
)
_CORRELATIONS = " UNION ALL ".join(
    f"SELECT '{a}' AS \"left\", '{b}' AS \"right\", "
    f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS correlation FROM gold"
    for a in _NUMBERS
    for b in _NUMBERS
)

_TRAIN = """, trained AS (
  SELECT g.*, m.split, row_number() OVER (ORDER BY g.user_session,
    g.source_event_time, g.event_type, g.product_id, g.user_id) AS place
  FROM gold g JOIN split_map m USING (user_session)
), pairs AS (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS value, place FROM trained "
    f"WHERE split = 'train' AND {c} IS NOT NULL"
    for c in _CATEGORIES
) + """
), vocabulary AS (
  SELECT "column", value, row_number() OVER (PARTITION BY "column"
    ORDER BY min(place)) + 1 AS code
  FROM pairs GROUP BY "column", value
  UNION ALL SELECT c, '__MISSING__', 0 FROM (VALUES ('category_id'),
    ('category_code'), ('brand'), ('event_type')) t(c)
  UNION ALL SELECT c, '__UNK__', 1 FROM (VALUES ('category_id'),
    ('category_code'), ('brand'), ('event_type')) t(c)
)
"""


def _encoded() -> str:
    columns, joins = [], []
    for c in _CATEGORIES:
        columns.append(f"CASE WHEN v_{c}.code IS NULL THEN '__UNK__' "
                       f"ELSE v_{c}.value END AS {c}")
        columns.append(f"coalesce(v_{c}.code, 1) AS {c}_code")
        joins.append(
            f"LEFT JOIN vocabulary v_{c} ON v_{c}.\"column\" = '{c}' "
            f"AND v_{c}.value = coalesce(t.{c}, '__MISSING__')"
        )
    numbers = ", ".join(f"CAST(coalesce(t.{c}, 0) AS DOUBLE) AS {c}" for c in _NUMBERS)
    return (
        f"SELECT t.split, {numbers}, {', '.join(columns)}, "
        f"CAST(t.label AS INTEGER) AS label FROM trained t {' '.join(joins)}"
    )


def _metric_select(source: str, keys: str = "", into: str = "") -> str:
    """PR-AUC and friends at 0.5 per key from (keys, score, positives, n); with
    ``into`` as one more named subquery."""
    head, tail = (f", {into} AS (", ")") if into else ("", "")
    k = f"{keys}, " if keys else ""
    part = f"PARTITION BY {keys}" if keys else ""
    group = f"GROUP BY {keys}" if keys else ""
    return f"""
, ms AS (
  SELECT {k}score, positives, n,
    sum(positives) OVER ({part} ORDER BY score DESC) AS hits,
    sum(n) OVER ({part} ORDER BY score DESC) AS taken,
    sum(positives) OVER ({part}) AS total
  FROM {source}
), mc AS (
  SELECT *, CAST(hits AS DOUBLE) / taken AS p,
    CASE WHEN total = 0 THEN 1.0 ELSE CAST(hits AS DOUBLE) / total END AS r,
    CASE WHEN taken = n THEN 1.0
      ELSE CAST(hits - positives AS DOUBLE) / (taken - n) END AS p0,
    CASE WHEN taken = n THEN 0.0 WHEN total = 0 THEN 1.0
      ELSE CAST(hits - positives AS DOUBLE) / total END AS r0
  FROM ms
), mm AS (
  SELECT {k}sum((r - r0) * (p + p0) / 2) AS pr_auc, sum((r - r0) * p) AS ap,
    coalesce(sum(positives) FILTER (score >= 0.5), 0) AS tp,
    coalesce(sum(n) FILTER (score >= 0.5), 0) AS above,
    max(total) AS total, max(taken) AS everything
  FROM mc {group}
)
{head}SELECT {k}round(pr_auc, 6) AS pr_auc, round(ap, 6) AS average_precision,
  CAST(0.5 AS DOUBLE) AS threshold, CAST(tp AS BIGINT) AS tp,
  CAST(above - tp AS BIGINT) AS fp, CAST(total - tp AS BIGINT) AS fn,
  CAST(everything - total - above + tp AS BIGINT) AS tn,
  round(CASE WHEN above = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / above END, 6)
    AS precision,
  round(CASE WHEN total = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / total END, 6) AS recall,
  round(CASE WHEN above + total = 0 THEN 0.0
    ELSE 2.0 * CAST(tp AS DOUBLE) / (above + total) END, 6) AS f1
FROM mm{tail}
"""


_HOURS = """, hourly AS (
  SELECT *, date_trunc('hour', prediction_time) AS hour FROM labelled
), wide AS (
  SELECT h.*, CAST(h.hour - i.i * INTERVAL 1 HOUR AS TIMESTAMP) AS window_start
  FROM hourly h, range(24) i(i)
)
"""
_ONLINE = _HOURS + """, online_counts AS (
  SELECT evaluation_mode, window_start, purchase_probability AS score,
    sum(actual_purchase) AS positives, count(*) AS n
  FROM wide WHERE prediction_mode = 'model' GROUP BY ALL
)
"""

# Scores of each day against those of the week before it.
_SCORE_KL = """, hist AS (
  SELECT evaluation_mode, epoch_us(prediction_time) // 3600000000 AS hour,
    greatest(0, least(9, CAST(floor(purchase_probability * 10) AS INTEGER))) AS bin,
    count(*) AS n
  FROM predictions WHERE prediction_mode = 'model' GROUP BY ALL
), starts AS (
  SELECT DISTINCT evaluation_mode, hour - i.i AS first FROM hist, range(24) i(i)
), sums AS (
  SELECT s.evaluation_mode, s.first, b.bin,
    coalesce(sum(n) FILTER (hour < first), 0) AS p,
    coalesce(sum(n) FILTER (hour >= first), 0) AS q
  FROM starts s CROSS JOIN range(10) b(bin) LEFT JOIN hist h
    ON h.evaluation_mode = s.evaluation_mode AND h.bin = b.bin
      AND h.hour BETWEEN s.first - 168 AND s.first + 23
  GROUP BY ALL
), floored AS (
  SELECT evaluation_mode, first, sum(p) OVER d AS ps, sum(q) OVER d AS qs,
    greatest(CAST(p AS DOUBLE) / sum(p) OVER d, 0.001) AS p,
    greatest(CAST(q AS DOUBLE) / sum(q) OVER d, 0.001) AS q
  FROM sums WINDOW d AS (PARTITION BY evaluation_mode, first)
), normal AS (
  SELECT evaluation_mode, first, p / sum(p) OVER d AS p, q / sum(q) OVER d AS q
  FROM floored WHERE ps > 0 AND qs > 0 WINDOW d AS (PARTITION BY evaluation_mode, first)
), shifts AS (
  SELECT evaluation_mode, make_timestamp(CAST(first AS BIGINT) * 3600000000)
      AS window_start, sum(p * ln(p / q)) AS kl
  FROM normal GROUP BY ALL
)
"""

# Sub-sessions of the stream: a gap above the time to live starts anew.
STREAM_TTL = 12 * 3600
_STREAM = f""", gaps AS (
  SELECT *, CASE WHEN epoch_us(source_event_time) - lag(epoch_us(source_event_time))
      OVER o > {STREAM_TTL * 1_000_000} THEN 1 ELSE 0 END AS fresh
  FROM silver
  WINDOW o AS (PARTITION BY user_session
    ORDER BY source_event_time, event_type, product_id, user_id)
), visits AS (
  SELECT *, sum(fresh) OVER (PARTITION BY user_session
    ORDER BY source_event_time, event_type, product_id, user_id
    ROWS UNBOUNDED PRECEDING) AS visit
  FROM gaps
), serving AS (
  SELECT *,
    CAST(coalesce(sum(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) OVER w, 0)
      AS BIGINT) AS serving_total_views,
    CAST(coalesce(sum(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) OVER w, 0)
      AS BIGINT) AS serving_total_carts,
    CAST(coalesce(sum(CASE WHEN event_type = 'remove_from_cart' THEN 1 ELSE 0 END)
      OVER w, 0) AS BIGINT) AS serving_total_removes,
    count(DISTINCT product_id) OVER w AS serving_unique_products,
    count(DISTINCT coalesce(category_code, category_id)) OVER w
      AS serving_unique_categories,
    CAST(epoch_us(source_event_time) - min(epoch_us(source_event_time)) OVER (
      PARTITION BY user_session, visit) AS DOUBLE) / 1000000
      AS serving_session_duration_sec,
    coalesce(price, 0.0) AS serving_price
  FROM visits
  WINDOW w AS (PARTITION BY user_session, visit
    ORDER BY source_event_time, event_type, product_id, user_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
)
"""
_SERVING = (
    "user_session, source_event_time, event_type, product_id, serving_total_views, "
    "serving_total_carts, serving_total_removes, serving_unique_products, "
    "serving_unique_categories, serving_session_duration_sec, serving_price"
)
_EVENT_ID = (
    "sha256(concat_ws('|', user_session, strftime(source_event_time, "
    "'%Y-%m-%dT%H:%M:%S'), event_type, product_id, user_id))"
)

_VIEWED = """, priced AS (
      SELECT *, CASE WHEN event_type = 'view' THEN price END AS viewed FROM silver),
      sums AS (
      SELECT *, count(viewed) OVER w AS n, sum(viewed) OVER w AS spent,
        var_pop(viewed) OVER w AS variance,
        coalesce(sum(CASE WHEN event_type = 'cart' THEN 1 ELSE 0 END) OVER w, 0)
          AS carts,
        CAST(coalesce(sum(CASE WHEN event_type = 'remove_from_cart' THEN 1 ELSE 0
          END) OVER w, 0) AS BIGINT) AS removes,
        count(brand) OVER w AS branded,
        epoch_us(source_event_time) - lag(epoch_us(source_event_time)) OVER (
          PARTITION BY user_session
          ORDER BY source_event_time, event_type, product_id, user_id) AS gap
      FROM priced
      WINDOW w AS (PARTITION BY user_session
        ORDER BY source_event_time, event_type, product_id, user_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), means AS (
      SELECT *, CASE WHEN n > 0 THEN spent / n END AS mean FROM sums)
"""

_PSI = _VIEWED + """, lo AS (SELECT min(session_start_time) + (max(session_start_time)
    - min(session_start_time)) / 2 AS mid FROM sessions
), sides AS (
  SELECT g.*, s.session_start_time < (SELECT mid FROM lo) AS early,
    round(m.mean + 1e-9, 6) AS avg_price_viewed
  FROM gold g JOIN sessions s USING (user_session)
  JOIN means m USING (user_session, source_event_time, event_type, product_id, user_id)
), vals AS (
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS v, early FROM sides"
    for c in ("cart_to_view_ratio", "session_duration_sec", "avg_price_viewed")
) + """
), bounds AS (
  SELECT feature, min(v) AS low, max(v) AS high FROM vals WHERE early GROUP BY feature
), binned AS (
  SELECT feature, early, greatest(0, least(9, CAST(floor((v - low) * 10.0
    / (high - low)) AS BIGINT))) AS bin
  FROM vals JOIN bounds USING (feature) WHERE v IS NOT NULL
), grid AS (
  SELECT feature, i AS bin FROM bounds, range(10) t(i)
), sized AS (
  SELECT g.feature, g.bin, count(b.bin) FILTER (b.early) AS e,
    count(b.bin) FILTER (NOT b.early) AS a
  FROM grid g LEFT JOIN binned b USING (feature, bin) GROUP BY 1, 2
), shares AS (
  SELECT feature, greatest(CAST(e AS DOUBLE) / sum(e) OVER f, 0.001) AS p,
    greatest(CAST(a AS DOUBLE) / sum(a) OVER f, 0.001) AS q
  FROM sized WINDOW f AS (PARTITION BY feature)
), mass AS (
  SELECT feature, p, q, p / sum(p) OVER f AS p1, q / sum(q) OVER f AS q1
  FROM shares WINDOW f AS (PARTITION BY feature)
), totals AS (
  SELECT feature, sum((q - p) * ln(q / p)) AS psi, sum(p1 * ln(p1 / q1)) AS kl
  FROM mass GROUP BY feature
)
SELECT feature, round(psi, 6) AS psi, round(kl, 6) AS kl,
  CASE WHEN psi >= 0.2 THEN 'retrain' WHEN psi >= 0.1 THEN 'warn' ELSE 'stable' END
    AS psi_band,
  CASE WHEN kl > 0.2 THEN 'retrain' WHEN kl > 0.1 THEN 'warn' ELSE 'stable' END
    AS kl_band
FROM totals
UNION ALL SELECT 'no_value', NULL, NULL, NULL, NULL
"""


def _histogram(source: str, bins: int) -> str:
    return f"""
, r AS (SELECT min(v) AS low, max(v) AS high FROM {source})
, filled AS (
  SELECT CAST(greatest(0, least({bins - 1}, CAST(floor((v - low) * {bins}.0
    / (high - low)) AS BIGINT))) AS INTEGER) AS bin, count(*) AS rows
  FROM {source}, r GROUP BY 1)
SELECT CAST(b AS INTEGER) AS bin, coalesce(rows, 0) AS rows,
  round(low + (high - low) * b / {bins}.0, 6) AS low,
  round(low + (high - low) * (b + 1) / {bins}.0, 6) AS high
FROM range({bins}) t(b) CROSS JOIN r LEFT JOIN filled ON filled.bin = b
"""


def build() -> dict[str, str]:
    q: dict[str, str] = {}
    q["raw_csv_scan"] = f"SELECT {', '.join(_FIELDS)} FROM raw"
    q["bronze_from_csv"] = f"SELECT {_EVENT} FROM bronze"
    q["bronze_events"] = f"SELECT {_EVENT} FROM bronze"
    q["silver_events"] = f"SELECT {_EVENT} FROM silver"
    q["silver_from_bronze"] = f"SELECT {_EVENT} FROM silver"
    q["raw_counts"] = """SELECT count(*) AS input_rows,
      count(*) FILTER (coalesce(event_type IN ('view', 'cart', 'remove_from_cart',
        'purchase'), FALSE)) AS accepted_rows,
      count(*) FILTER (NOT coalesce(event_type IN ('view', 'cart',
        'remove_from_cart', 'purchase'), FALSE)) AS rejected_rows FROM raw"""
    q["clean_counts"] = """, judged AS (
      SELECT source_event_time IS NOT NULL AND category_id IS NOT NULL AS complete,
        price IS NULL OR price > 0 AS priced FROM bronze)
      SELECT count(*) AS input_rows, count(*) FILTER (NOT complete)
        AS rejected_required,
        count(*) FILTER (complete AND NOT priced) AS rejected_price,
        count(*) FILTER (complete AND priced) AS valid_rows FROM judged"""
    q["duplicate_counts"] = f""", copies AS (
      SELECT count(*) AS n FROM clean GROUP BY {_KEY})
      SELECT CAST(sum(n) AS BIGINT) AS input_rows, count(*) AS unique_rows,
        CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM copies"""
    q["category_filled"] = f"""SELECT {_EVENT.replace(
        'category_code', "coalesce(category_code, 'unknown') AS category_code")}
      FROM clean"""
    q["replay_events"] = f"""SELECT strftime(source_event_time, '%Y-%m-%dT%H:%M:%S')
        AS source_event_time, event_type, product_id, category_id, user_id,
        user_session, category_code, brand, price,
        strftime(source_event_time, '%Y-%m-%dT%H:%M:%S') AS replay_time,
        'replay' AS source, {_EVENT_ID} AS event_id
      FROM bronze WHERE source_event_time IS NOT NULL AND category_id IS NOT NULL"""
    q["replay_messages"] = q["replay_events"]
    file = "'2024-Jan-' || lpad(CAST(input_order % 8 AS VARCHAR), 5, '0') || '.csv'"
    raw_columns = """event_time, event_type, product_id, category_id, user_id,
      user_session, category_code, brand, price"""
    q["raw_header_audit"] = f"""SELECT DISTINCT {file} AS file,
        CAST(9 AS INTEGER) AS column_count, TRUE AS complete, '' AS extra,
        '' AS missing, TRUE AS in_order FROM raw"""
    q["first_raw_rows"] = f"""SELECT {raw_columns} FROM raw
      WHERE input_order % 8 = 0 ORDER BY input_order LIMIT 200"""
    q["head_per_file"] = f"""SELECT {raw_columns}, {file} AS raw_file FROM (
        SELECT *, row_number() OVER (PARTITION BY input_order % 8
          ORDER BY input_order) AS rn FROM raw) WHERE rn <= 100"""
    q["file_time_ranges"] = f"""SELECT coalesce({file}, 'all') AS raw_file,
        count(*) AS rows, min(source_event_time) AS start_time,
        max(source_event_time) AS end_time
      FROM bronze GROUP BY GROUPING SETS (({file}), ())"""
    q["dead_letters"] = """SELECT '{broken' AS value, 'unreadable_event' AS reason,
        count(*) AS rows FROM raw WHERE event_time = 'not a time'"""
    q["replay_rejects"] = """SELECT CASE WHEN category_id IS NULL
        THEN 'category_id is missing'
        WHEN event_type NOT IN ('view', 'cart', 'remove_from_cart', 'purchase')
        THEN 'event_type not allowed' ELSE 'unreadable event_time' END AS reason,
        count(*) AS rows
      FROM raw WHERE category_id IS NULL OR event_time = 'not a time'
        OR event_type NOT IN ('view', 'cart', 'remove_from_cart', 'purchase')
      GROUP BY 1"""
    q["event_times_utc"] = """SELECT strftime(source_event_time,
        '%Y-%m-%dT%H:%M:%S') || '+00:00' AS time_text, count(*) AS rows
      FROM silver GROUP BY 1"""
    q["session_id_check"] = """SELECT regexp_full_match(user_session,
        '[A-Za-z0-9][A-Za-z0-9_.-]*') AS valid, count(*) AS rows
      FROM raw GROUP BY 1"""
    weeks = """CASE
        WHEN source_event_time >= TIMESTAMP '2024-01-01'
          AND source_event_time < TIMESTAMP '2024-01-08' THEN 'week1'
        WHEN source_event_time >= TIMESTAMP '2024-01-08'
          AND source_event_time < TIMESTAMP '2024-01-15' THEN 'week2'
        WHEN source_event_time >= TIMESTAMP '2024-01-15'
          AND source_event_time < TIMESTAMP '2024-01-22' THEN 'week3'
        WHEN source_event_time >= TIMESTAMP '2024-01-22'
          AND source_event_time < TIMESTAMP '2024-02-01' THEN 'week4' END AS slice"""
    q["time_slices"] = f"""SELECT {weeks}, count(*) AS rows,
        count(DISTINCT user_session) AS sessions FROM silver GROUP BY 1"""
    q["time_slice_csv"] = f"SELECT {_EVENT}, {weeks} FROM silver"
    q["exploration_fill"] = """SELECT coalesce(category_code, 'Unknown')
        AS category_code, coalesce(brand, 'Unknown') AS brand, count(*) AS rows
      FROM raw WHERE user_session IS NOT NULL GROUP BY 1, 2"""
    q["session_index"] = """SELECT user_session, session_start_time, session_end_time
      FROM sessions"""
    q["time_ranked_sessions"] = """SELECT user_session, session_start_time,
        session_end_time, rank FROM ranked"""
    q["session_split_map"] = "SELECT * FROM split_map"
    q["events_in_scope"] = f"""SELECT {_EVENT} FROM silver WHERE user_session IN (
        SELECT user_session FROM ranked)"""
    q["split_coverage"] = """SELECT s.user_session, 'unmapped' AS problem
      FROM sessions s WHERE s.user_session NOT IN (
        SELECT user_session FROM split_map)"""
    q["gold_snapshots"] = "SELECT * FROM gold"
    q["gold_short_horizon"] = """SELECT g.* REPLACE (CAST(coalesce((
        SELECT max(1) FROM silver s WHERE s.user_session = g.user_session
          AND s.event_type = 'purchase'
          AND s.source_event_time > g.source_event_time
          AND s.source_event_time <= g.source_event_time + INTERVAL 600 SECOND), 0)
        AS TINYINT) AS label) FROM gold g"""
    q["gold_with_split"] = """SELECT g.*, m.split FROM gold g
      JOIN split_map m USING (user_session)"""
    q["gold_tables"] = q["gold_with_split"]
    q["extended_features"] = _VIEWED + f"""
      SELECT {_KEY}, removes AS total_removes,
        CASE WHEN carts = 0 THEN 0.0 ELSE CAST(removes AS DOUBLE)
          / CAST(carts AS DOUBLE) END AS cart_remove_rate,
        round(mean + 1e-9, 6) AS avg_price_viewed,
        CAST(gap AS DOUBLE) / 1000000 AS time_since_last_event_sec,
        CAST(branded > 0 AS INTEGER) AS has_brand_info,
        CASE WHEN n > 0 THEN round(sqrt(greatest(variance, 0.0)) + 1e-9, 4) END
          AS price_std
      FROM means"""
    q["model_frame"] = f"""SELECT {', '.join(
        f'CAST(coalesce({c}, 0) AS DOUBLE) AS {c}' for c in _NUMBERS)},
        {', '.join(_CATEGORIES)}, CAST(label AS INTEGER) AS label FROM gold"""
    q["vocabulary"] = _TRAIN + 'SELECT "column", value, code FROM vocabulary'
    q["encoded_features"] = _TRAIN + _encoded()
    q["pr_curve"] = """SELECT score AS threshold, round(p, 9) AS precision,
        round(r, 9) AS recall FROM curve
      UNION ALL SELECT NULL, 1.0, 0.0"""
    q["pr_summary"] = """, f AS (SELECT *, 2 * (p * r) / (p + r + 1e-10) AS f1
      FROM curve), best AS (SELECT * FROM f ORDER BY f1 DESC, score LIMIT 1)
      SELECT round((SELECT sum((r - r0) * (p + p0) / 2) FROM curve), 6) AS pr_auc,
        round((SELECT sum((r - r0) * p) FROM curve), 6) AS average_precision,
        score AS threshold, CAST(hits AS BIGINT) AS tp,
        CAST(taken - hits AS BIGINT) AS fp, CAST(total - hits AS BIGINT) AS fn,
        CAST((SELECT sum(n) FROM counts) - total - taken + hits AS BIGINT) AS tn,
        round(CAST(hits AS DOUBLE) / taken, 6) AS precision,
        round(CAST(hits AS DOUBLE) / total, 6) AS recall,
        round(2.0 * CAST(hits AS DOUBLE) / (taken + total), 6) AS f1
      FROM best"""
    q["metrics_at_half"] = _metric_select("counts")
    q["metrics_by_type"] = """, typed AS (SELECT event_type, score,
        sum(CAST(label AS BIGINT)) AS positives, count(*) AS n
      FROM scored GROUP BY 1, 2)""" + _metric_select("typed", "event_type")
    q["best_event_type"] = ("" + q["metrics_by_type"].replace(
        "SELECT event_type, round(pr_auc", ", shown AS (SELECT event_type, "
        "round(pr_auc") + ") SELECT event_type, pr_auc FROM shown "
        "ORDER BY pr_auc DESC, event_type LIMIT 1")
    q["gate_verdicts"] = q["best_event_type"].replace(
        "SELECT event_type, pr_auc FROM shown ORDER BY pr_auc DESC, event_type LIMIT 1",
        """, asked AS (SELECT event_type, pr_auc, 0.1 AS floor,
          CASE WHEN event_type <> 'view' THEN (SELECT pr_auc FROM shown
            WHERE event_type = 'view') END AS production_pr_auc,
          event_type = 'purchase' AS forced FROM shown)
        SELECT event_type, CASE WHEN forced THEN 'override'
          WHEN production_pr_auc IS NULL THEN 'first_model'
          WHEN pr_auc < floor THEN 'below_floor'
          WHEN pr_auc >= production_pr_auc THEN 'not_worse' ELSE 'worse' END AS rule,
          forced OR production_pr_auc IS NULL
            OR (pr_auc >= floor AND pr_auc >= production_pr_auc) AS passed
        FROM asked""")
    q["missing_values"] = _MISSING
    q["type_counts"] = "SELECT event_type, count(*) AS rows FROM silver GROUP BY 1"
    q["type_shares"] = """SELECT event_type, count(*) AS rows,
        round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS share_pct
      FROM silver GROUP BY 1"""
    q["month_counts"] = """SELECT strftime(source_event_time, '%Y-%m') AS month,
        count(*) AS rows FROM silver GROUP BY 1"""
    q["top_days"] = """SELECT strftime(source_event_time, '%Y-%m-%d') AS day,
        count(*) AS rows FROM silver GROUP BY 1 ORDER BY rows DESC, day LIMIT 15"""
    q["hour_counts"] = """SELECT CAST(hour(source_event_time) AS INTEGER) AS hour,
        count(*) AS rows FROM silver GROUP BY 1"""
    q["top_brands"] = """SELECT brand, count(*) AS rows FROM silver
      WHERE brand IS NOT NULL GROUP BY 1 ORDER BY rows DESC, brand LIMIT 20"""
    q["top_categories"] = """SELECT category_code, count(*) AS rows FROM silver
      WHERE category_code IS NOT NULL GROUP BY 1
      ORDER BY rows DESC, category_code LIMIT 20"""
    q["price_stats"] = """SELECT count(price) AS price_count,
        round(avg(price), 6) AS price_mean, round(stddev_pop(price), 6) AS price_std,
        min(price) AS price_min, max(price) AS price_max,
        count(*) FILTER (price IS NULL) AS price_null,
        count(*) FILTER (price <= 0) AS price_non_positive FROM raw"""
    q["price_quantiles"] = f"SELECT {_quantiles('price', _PRICE_MARKS)} FROM silver"
    q["rows_above_p99"] = """SELECT count(*) AS rows_above FROM silver
      WHERE price > (SELECT quantile_cont(price, 0.99) FROM silver)"""
    q["time_ranges"] = """SELECT event_type, count(*) AS rows,
        min(source_event_time) AS start_time, max(source_event_time) AS end_time
      FROM silver GROUP BY 1"""
    profile = """SELECT user_session, count(*) AS event_count,
        min(source_event_time) AS first_event_time,
        max(source_event_time) AS last_event_time,
        CAST(epoch_us(max(source_event_time)) - epoch_us(min(source_event_time))
          AS DOUBLE) / 60000000 AS duration_minutes
      FROM silver GROUP BY 1"""
    q["session_profile"] = profile
    q["top_sessions"] = profile + """ ORDER BY event_count DESC,
        duration_minutes DESC, user_session LIMIT 20"""
    q["session_medians"] = f""", p AS ({profile})
      SELECT 'event_count' AS metric, round(median(CAST(event_count AS DOUBLE)), 6)
        AS median FROM p
      UNION ALL SELECT 'duration_minutes', round(median(duration_minutes), 6) FROM p"""
    q["distinct_entities"] = """SELECT count(DISTINCT user_session)
        AS unique_sessions, count(DISTINCT user_id) AS unique_users,
        count(DISTINCT product_id) AS unique_products FROM silver"""
    q["full_row_duplicates"] = f""", c AS (SELECT {_EVENT}, count(*) AS n FROM (
        SELECT {_EVENT} FROM bronze UNION ALL
        SELECT {_EVENT} FROM bronze WHERE event_type = 'cart') GROUP BY ALL)
      SELECT CAST(sum(n - 1) AS BIGINT) AS duplicate_rows FROM c"""
    q["distinct_rows"] = f"SELECT DISTINCT {_EVENT} FROM bronze"
    q["describe_numbers"] = f""", v AS ({_NUMBER_ROWS})
      SELECT "column", count(value) AS count, round(avg(value), 4) AS mean,
        round(stddev_samp(value), 4) AS std, min(value) AS min, max(value) AS max,
        round(quantile_cont(value, 0.25), 4) AS q1,
        round(quantile_cont(value, 0.5), 4) AS q2,
        round(quantile_cont(value, 0.75), 4) AS q3 FROM v GROUP BY 1"""
    q["describe_texts"] = f""", v AS ({_TEXT_ROWS}), c AS (
      SELECT "column", value, count(*) AS freq FROM v GROUP BY 1, 2)
      SELECT "column", CAST(sum(freq) AS BIGINT) AS count, count(*) AS "unique",
        first(value ORDER BY freq DESC, value) AS top, max(freq) AS top_count
      FROM c GROUP BY 1"""
    q["correlations"] = _CORRELATIONS
    q["price_histogram"] = """, v AS (SELECT price AS v FROM silver
      WHERE price IS NOT NULL)""" + _histogram("v", 50)
    q["price_histogram_clipped"] = """, v AS (SELECT least(price, (
        SELECT quantile_cont(price, 0.99) FROM silver)) AS v FROM silver
      WHERE price IS NOT NULL)""" + _histogram("v", 60)
    q["price_box"] = """, b AS (SELECT event_type, quantile_cont(price, 0.25) AS q1,
        quantile_cont(price, 0.5) AS median, quantile_cont(price, 0.75) AS q3
      FROM silver WHERE price IS NOT NULL GROUP BY 1), j AS (
      SELECT s.event_type, b.q1, b.median, b.q3, s.price,
        s.price BETWEEN b.q1 - 1.5 * (b.q3 - b.q1) AND b.q3 + 1.5 * (b.q3 - b.q1)
          AS inside FROM silver s JOIN b USING (event_type)
      WHERE s.price IS NOT NULL)
      SELECT event_type, round(q1, 6) AS q1, round(median, 6) AS median,
        round(q3, 6) AS q3, min(price) FILTER (inside) AS whisker_low,
        max(price) FILTER (inside) AS whisker_high,
        count(*) FILTER (NOT inside) AS outliers
      FROM j GROUP BY 1, 2, 3, 4"""
    q["drift"] = _PSI
    q["prediction_outcomes"] = """SELECT *,
        CAST(purchase_probability >= 0.5 AS INTEGER) = actual_purchase
          AS is_correct_prediction,
        CASE WHEN evaluation_mode = 'offline_backfill' THEN source_event_time
          ELSE prediction_time END + """ + f"""INTERVAL {HORIZON} SECOND
          AS ground_truth_time FROM labelled"""
    q["stream_outcomes"] = f""", instants AS (
        SELECT *, CASE WHEN evaluation_mode = 'offline_backfill' THEN source_event_time
          ELSE prediction_time END AS instant FROM labelled
      ), reached AS (
        SELECT least((SELECT max(instant) FROM instants), (SELECT
          max(source_event_time) + INTERVAL 2 SECOND FROM silver
          WHERE event_type = 'purchase')) - INTERVAL 600 SECOND AS until
      ), ends AS (
        SELECT i.* EXCLUDE (instant, actual_purchase),
          instant + INTERVAL {HORIZON} SECOND AS done,
          instant + INTERVAL {HORIZON} SECOND <= until AS closed, actual_purchase AS hit
        FROM instants i, reached
      )
      SELECT * EXCLUDE (done, closed, hit),
        CASE WHEN closed THEN hit END AS actual_purchase,
        CASE WHEN closed THEN done END AS ground_truth_time,
        CASE WHEN closed THEN CAST(purchase_probability >= 0.5 AS INTEGER) = hit END
          AS is_correct_prediction
      FROM ends"""
    q["online_metrics"] = _ONLINE + _metric_select(
        "online_counts", "evaluation_mode, window_start"
    )
    q["online_coverage"] = _HOURS + """SELECT evaluation_mode, window_start,
        count(*) AS predictions,
        round(CAST(count(actual_purchase) AS DOUBLE) / count(*), 6)
          AS outcome_coverage,
        round(CAST(count(*) FILTER (prediction_mode = 'fallback') AS DOUBLE)
          / count(*), 6) AS fallback_rate
      FROM wide GROUP BY 1, 2"""
    shown = _ONLINE + _metric_select(
        "online_counts", "evaluation_mode, window_start", into="shown"
    )
    q["online_metrics_as_of"] = f""", online_counts AS (
        SELECT evaluation_mode, TIMESTAMP '{CUTOFF}' - INTERVAL 24 HOUR AS window_start,
          purchase_probability AS score, sum(actual_purchase) AS positives,
          count(*) AS n
        FROM labelled WHERE prediction_mode = 'model'
          AND prediction_time >= TIMESTAMP '{CUTOFF}' - INTERVAL 24 HOUR
          AND prediction_time < TIMESTAMP '{CUTOFF}' GROUP BY ALL)
      """ + _metric_select("online_counts", "evaluation_mode, window_start")
    q["score_drift"] = _SCORE_KL + """SELECT evaluation_mode, window_start,
        round(kl, 6) AS kl FROM shifts"""
    q["degradation_alerts"] = shown + """, lagged AS (SELECT *, lag(pr_auc) OVER o AS b,
        lag(window_start) OVER o AS earlier FROM shown
      WINDOW o AS (PARTITION BY evaluation_mode ORDER BY window_start))
      SELECT evaluation_mode, window_start, pr_auc FROM lagged
      WHERE pr_auc < 0.7 AND b < 0.7
        AND earlier = window_start - INTERVAL 1 HOUR"""
    q["metric_alerts"] = shown + _SCORE_KL + """, cov AS (SELECT evaluation_mode, window_start,
        round(CAST(count(actual_purchase) AS DOUBLE) / count(*), 6) AS known,
        round(CAST(count(*) FILTER (prediction_mode = 'fallback') AS DOUBLE)
          / count(*), 6) AS fallback
      FROM wide GROUP BY 1, 2), vals AS (
      SELECT evaluation_mode, window_start, 'pr_auc' AS rule, pr_auc AS value,
        pr_auc < 0.7 AS bad, 2 AS hours FROM shown UNION ALL
      SELECT evaluation_mode, window_start, 'f1', f1, f1 < 0.5, 2 FROM shown UNION ALL
      SELECT evaluation_mode, window_start, 'outcome_coverage', known, known < 0.8, 1
      FROM cov UNION ALL
      SELECT evaluation_mode, window_start, 'fallback_rate', fallback,
        fallback > 0.05, 2 FROM cov UNION ALL
      SELECT evaluation_mode, window_start, 'kl', round(kl, 6), round(kl, 6) > 0.15, 1
      FROM shifts), lagged AS (
      SELECT *, lag(bad) OVER o AS before, lag(window_start) OVER o AS earlier
      FROM vals WINDOW o AS (PARTITION BY evaluation_mode, rule ORDER BY window_start))
      SELECT evaluation_mode, window_start, rule, value FROM lagged
      WHERE bad AND (hours = 1 OR (before AND earlier = window_start - INTERVAL 1 HOUR))"""
    q["prediction_gaps"] = """, l AS (SELECT evaluation_mode, 'latency' AS gap,
        CAST(epoch_us(prediction_time) - epoch_us(replay_time) AS DOUBLE) / 1000000
          AS s FROM predictions UNION ALL
      SELECT evaluation_mode, 'freshness',
        CAST(epoch_us(prediction_time) - epoch_us(source_event_time) AS DOUBLE)
          / 1000000 FROM predictions)
      SELECT evaluation_mode, gap, round(quantile_cont(s, 0.5), 6) AS p50,
        round(quantile_cont(s, 0.95), 6) AS p95,
        round(quantile_cont(s, 0.99), 6) AS p99 FROM l GROUP BY 1, 2"""
    q["prediction_latency"] = """, l AS (SELECT evaluation_mode,
        CAST(epoch_us(prediction_time) - epoch_us(source_event_time) AS DOUBLE)
          / 1000000 AS s FROM predictions)
      SELECT evaluation_mode, round(quantile_cont(s, 0.5), 6) AS p50,
        round(quantile_cont(s, 0.95), 6) AS p95,
        round(quantile_cont(s, 0.99), 6) AS p99 FROM l GROUP BY 1"""
    q["stream_serving_rows"] = _STREAM + f"SELECT {_SERVING} FROM serving"
    q["stream_latest_states"] = _STREAM + f""", last AS (SELECT *, row_number() OVER (
        PARTITION BY user_session ORDER BY source_event_time DESC, event_type DESC,
        product_id DESC, user_id DESC) AS rn FROM serving)
      SELECT {_SERVING} FROM last WHERE rn = 1"""
    q["stream_statuses"] = """, ids AS (SELECT row_number() OVER (PARTITION BY
        user_session, source_event_time, event_type, product_id, user_id
        ORDER BY input_order) AS rn FROM clean)
      SELECT CASE WHEN rn = 1 THEN 'accepted' ELSE 'duplicate' END AS status,
        count(*) AS rows FROM ids GROUP BY 1"""
    q["stream_replay_log"] = f"""SELECT {_EVENT_ID} AS event_id, {_EVENT},
        'replay' AS source FROM silver"""
    queries = {name: _base() + text for name, text in q.items()}
    week = f"""AND source_event_time > TIMESTAMP '{RETRAIN_AS_OF}' - INTERVAL 7 DAY
    AND source_event_time <= TIMESTAMP '{RETRAIN_AS_OF}'"""
    queries["retrain_gold"] = _base(week, "TRUE") + q["gold_with_split"]
    return queries
