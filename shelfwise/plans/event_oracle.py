"""The queries over time in plain SQL."""

from __future__ import annotations

_LINES = "SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem WHERE l_returnflag = 'R'"
_PRICES = """
SELECT l_partkey, l_shipdate, l_extendedprice / l_quantity AS price FROM lineitem WHERE l_returnflag = 'N'
QUALIFY row_number() OVER (PARTITION BY l_partkey, l_shipdate ORDER BY l_orderkey DESC, l_linenumber DESC) = 1"""


_TIMES = {
    "version_as_of": ("request_time", "create_time"), "price_as_of": ("l_shipdate", "last_l_shipdate"), "next_price": ("l_shipdate",),
    "overlapping_lines": ("a_l_shipdate", "a_until", "b_l_shipdate", "b_until"), "shipped_within": ("o_orderdate", "line_l_shipdate"),
    "event_windows": ("window_start", "window_end"),
}


def oracle_sql(price: str) -> dict[str, str]:
    """`price` is the SQL of prepared items with id and price_numeric. Times are compared as text."""
    shown = lambda name: ", ".join(f"strftime({c}, '%Y-%m-%d %H:%M:%S.%f') AS {c}" for c in _TIMES[name])
    return {n: f"SELECT * REPLACE ({shown(n)}) FROM ({q})" if n in _TIMES else q for n, q in _plain(price).items()}


def _plain(price: str) -> dict[str, str]:
    return {
        "version_as_of": """
WITH r AS (SELECT event_id, 'model-' || (event_id % 20) AS display_name, ts AS request_time FROM events WHERE event_type <> 'signup'),
v AS (SELECT 'model-' || (user_id % 20) AS display_name, event_id AS version, ts AS create_time FROM events WHERE event_type = 'signup')
SELECT r.*, coalesce(version, -1) AS version, create_time FROM r ASOF LEFT JOIN v ON r.display_name = v.display_name AND r.request_time >= v.create_time""",
        "price_as_of": f"""
WITH r AS ({_LINES}), p AS ({_PRICES}), j AS (
  SELECT r.*, p.price, p.l_shipdate AS seen FROM r ASOF LEFT JOIN p ON r.l_partkey = p.l_partkey AND r.l_shipdate >= p.l_shipdate
)
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, CASE WHEN l_shipdate - seen <= INTERVAL 90 DAY THEN price END AS last_price,
  CASE WHEN l_shipdate - seen <= INTERVAL 90 DAY THEN seen END AS last_l_shipdate
FROM j""",
        "next_price": f"""
WITH r AS ({_LINES}), p AS ({_PRICES})
SELECT r.*, p.price AS next_price FROM r ASOF LEFT JOIN p ON r.l_partkey = p.l_partkey AND r.l_shipdate < p.l_shipdate""",
        "price_bands": f"""
WITH i AS (SELECT id, price_numeric * 0.9 AS low, price_numeric * 1.1 AS high FROM ({price})),
b AS (SELECT n_name AS band, CASE WHEN n_nationkey = 24 THEN 0.0 ELSE n_nationkey * 1.0 END AS least,
  CASE WHEN n_nationkey = 24 THEN 1000.0 ELSE n_nationkey + 1.0 + n_nationkey % 5 END AS most FROM nation)
SELECT id, band FROM i JOIN b ON low <= most AND least <= high""",
        "overlapping_lines": """
WITH l AS (SELECT *, l_shipdate + to_days(l_quantity::INTEGER) AS until FROM lineitem)
SELECT a.l_partkey, a.l_orderkey AS a_l_orderkey, a.l_linenumber AS a_l_linenumber, a.l_shipdate AS a_l_shipdate, a.until AS a_until,
  b.l_orderkey AS b_l_orderkey, b.l_linenumber AS b_l_linenumber, b.l_shipdate AS b_l_shipdate, b.until AS b_until
FROM l a JOIN l b ON a.l_partkey = b.l_partkey AND a.l_shipdate < b.until AND b.l_shipdate < a.until
WHERE a.l_returnflag = 'A' AND b.l_returnflag = 'N'""",
        "shipped_within": """
SELECT o_orderkey AS orderkey, o_orderdate, coalesce(l_linenumber, 0) AS line_l_linenumber, l_shipdate AS line_l_shipdate
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_shipdate >= o_orderdate AND l_shipdate <= o_orderdate + INTERVAL 30 DAY""",
        "event_windows": """
WITH a AS (
  SELECT *, CAST(floor((date_diff('day', DATE '2024-01-01', ts::DATE) + CASE WHEN event_id % 40 = 0 THEN 3 ELSE 0 END) / 5) AS BIGINT) AS b
  FROM events
), arrived AS (
  SELECT b, row_number() OVER (ORDER BY b) - 1 AS batch_id, max(max(ts)) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 1 DAY AS mark
  FROM a GROUP BY b
), r AS (SELECT a.*, batch_id, coalesce(ts < mark, false) AS late FROM a JOIN arrived USING (b)),
ended AS (SELECT max(ts) - INTERVAL 1 DAY AS mark FROM events),
days AS (
  SELECT 'tumbling' AS kind, event_type AS key, date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, value FROM r WHERE NOT late
), halves AS (
  SELECT 'sliding' AS kind, '' AS key, time_bucket(INTERVAL 12 HOUR, ts) - to_hours(12 * k) AS window_start,
    time_bucket(INTERVAL 12 HOUR, ts) - to_hours(12 * k) + INTERVAL 1 DAY AS window_end, value
  FROM r, (VALUES (0), (1)) s(k) WHERE NOT late
), breaks AS (
  SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS new FROM r WHERE NOT late
), numbered AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM breaks),
visits AS (
  SELECT 'session' AS kind, CAST(user_id AS VARCHAR) AS key, min(ts) AS window_start, max(ts) + INTERVAL 30 MINUTE AS window_end, count(*) AS n, sum(value) AS total
  FROM numbered GROUP BY user_id, s
), every AS (
  SELECT kind, key, window_start, window_end, count(*) AS n, sum(value) AS total FROM (SELECT * FROM days UNION ALL SELECT * FROM halves) GROUP BY ALL
  UNION ALL SELECT * FROM visits
)
SELECT kind, key, window_start, window_end, n, round(total, 6) AS total FROM every, ended WHERE window_end <= mark
UNION ALL SELECT 'late', CAST(batch_id AS VARCHAR), min(ts), max(ts), count(*), round(sum(value), 6) FROM r WHERE late GROUP BY batch_id""",
        "drift_records": """
WITH d AS (
  SELECT event_type AS key, date_trunc('day', ts) AS day, count(*) AS n, avg(value) AS mean, stddev_pop(value) AS deviation, sum(value) AS t, sum(value * value) AS q
  FROM events GROUP BY ALL
), c AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY day) AS k,
    CASE WHEN row_number() OVER (PARTITION BY key ORDER BY day) <= 5 THEN 1 ELSE 0 END AS early
  FROM d WHERE day + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)
), f AS (
  SELECT *, coalesce(sum(n * early) OVER w, 0)::BIGINT AS reference_n, sum(t * early) OVER w AS rt, sum(q * early) OVER w AS rq
  FROM c WINDOW w AS (PARTITION BY key ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), z AS (
  SELECT *, rt / reference_n AS reference_mean,
    CASE WHEN k > 5 THEN (mean - rt / reference_n) / (sqrt(rq / reference_n - (rt / reference_n) ** 2) / sqrt(n)) END AS z
  FROM f
)
SELECT key, strftime(day, '%Y-%m-%d') AS day, CASE WHEN k <= 5 THEN 'reference' WHEN abs(z) > 2.0 THEN 'drift' ELSE 'ok' END AS status, n,
  round(mean, 6) AS mean, round(deviation, 6) AS deviation, reference_n, round(reference_mean, 6) AS reference_mean, round(z, 6) AS z
FROM z""",
        "outcomes_joined": """
WITH r AS (SELECT event_id, ts, user_id FROM events WHERE event_type = 'view'), o AS (SELECT event_id, ts, user_id FROM events WHERE event_type = 'click'),
ended AS (SELECT least((SELECT max(ts) FROM r), (SELECT max(ts) FROM o)) - INTERVAL 1 HOUR AS mark)
SELECT r.event_id AS request_id, coalesce(o.event_id, -1) AS outcome_id
FROM r LEFT JOIN o ON r.user_id = o.user_id AND o.ts >= r.ts AND o.ts <= r.ts + INTERVAL 1 HOUR, ended
WHERE o.event_id IS NOT NULL OR r.ts + INTERVAL 1 HOUR < mark""",
            "daily_sketches": """
SELECT event_type, count(*) AS rows, count(value) AS known, min(value) AS least, max(value) AS largest, true AS median_within_error,
  true AS distinct_within_error FROM events GROUP BY event_type""",
        "density_binned": f"""
WITH p AS (SELECT price_numeric AS v FROM ({price})),
s AS (SELECT count(v)::DOUBLE AS n, min(v) AS low, max(v) AS high, pow(count(v), -0.2) * stddev_samp(v) AS h FROM p),
d AS (SELECT (v - low) / ((high - low) / 2000) AS place FROM p, s),
w AS (
  SELECT cell, sum(weight) AS weight FROM (
    SELECT floor(place) AS cell, 1 - (place - floor(place)) AS weight FROM d UNION ALL SELECT floor(place) + 1, place - floor(place) FROM d
  ) GROUP BY cell
), g AS (SELECT range::INTEGER AS position FROM range(200)),
k AS (
  SELECT position, low + (high - low) * position / 199.0 AS x, n, low, high, h,
    sum(weight * exp(-0.5 * ((low + (high - low) * position / 199.0 - (low + cell * (high - low) / 2000)) / h) ** 2)) AS kernel
  FROM g, w, s GROUP BY ALL
)
SELECT 'price_numeric' AS feature, position, round(x, 6) AS x, round(kernel / (n * h * sqrt(2 * pi())), 6) AS density,
  round(kernel / (n * h * sqrt(2 * pi())) * n * (high - low) / 30, 6) AS curve FROM k""",
        "categories_encoded": f"""
WITH i AS (SELECT id, price_numeric, Country, Grape FROM ({price})),
c AS (
  SELECT f, v, row_number() OVER (PARTITION BY f ORDER BY count(*) DESC, v) - 1 AS position
  FROM (SELECT 'c' AS f, Country AS v FROM i WHERE price_numeric < 3 AND Country > 'NATION_12' UNION ALL SELECT 'g', Grape FROM i WHERE price_numeric < 3 AND Country > 'NATION_12')
  GROUP BY f, v
)
SELECT id, coalesce(a.position, -1) AS Country_position, coalesce(b.position, -1) AS Grape_position
FROM i LEFT JOIN c a ON a.f = 'c' AND a.v = Country LEFT JOIN c b ON b.f = 'g' AND b.v = Grape""",
        "one_hot_table": f"SELECT Type, count(*) AS n, count(*) AS n_equal FROM ({price}) GROUP BY Type",
        "target_check": f"""
SELECT unnest(['no target', 'another target', 'no such name']) AS "case", true AS refused, (SELECT count(*) FROM ({price})) AS rows""",
        "python_model_forms": f"""
SELECT id, round(price_numeric * 2 + id, 6) AS by_frame, round(price_numeric * 2 + id, 6) AS by_array, round(price_numeric * 2 + id, 6) AS by_list
FROM ({price})""",
        "rolling_week": """
SELECT event_id, count(*) OVER w AS n_rows, round(sum(value::DECIMAL(28,6)) OVER w / count(value) OVER w, 6)::DOUBLE AS mean
FROM events WINDOW w AS (PARTITION BY event_type ORDER BY ts RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW)""",
        "sales_cube": f"""
SELECT Country, Type, Style, grouping_id(Country, Type, Style)::INTEGER AS level, count(*) AS n, round(sum(price_numeric), 4) AS total,
  count(DISTINCT Grape) AS Grape_distinct, count(DISTINCT Region) AS Region_distinct, true AS ids_within_error
FROM ({price}) GROUP BY CUBE (Country, Type, Style)""",
        "sales_rollup": f"""
SELECT Region, Country, Type, grouping_id(Region, Country, Type)::INTEGER AS level, count(*) AS n, max(price_numeric) AS top, count(DISTINCT Style) AS Style_distinct
FROM ({price}) GROUP BY ROLLUP (Region, Country, Type)""",
    }
