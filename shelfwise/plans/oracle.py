"""The same answers in plain SQL, for checking the named queries."""

from __future__ import annotations

from shelfwise.plans import event_oracle

# Fixed values, written out here again so that a wrong one in the library shows.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
WORD_PATTERN = r"[\p{L}\p{N}_]{2,}"
ENGLISH_STOP_WORDS = tuple(
    """
    about above after again against all almost along already also although always am among an and any are as at
    be because been before being below between both but by can cannot could did do does doing done down during
    each either else enough etc ever every few for from further get give go had has have having he hence her here
    hers herself him himself his how however if in indeed into is it its itself keep last least less made many may
    me might more most much must my myself neither never no nor not now of off often on once one only or other our
    ours ourselves out over own per perhaps please rather same she should since so some still such than that the
    their theirs them themselves then there these they this those through to too under until up upon us very was
    we well were what when where which while who whom whose why will with within without would yet you your yours
    """.split()
)
NATION_BONUS = {"NATION_0": 0.5, "NATION_1": 0.3, "NATION_2": 0.2, "NATION_3": 0.3, "NATION_4": 0.2, "NATION_5": 0.1}
STATUS_BONUS = {"F": 0.2, "O": 0.1, "P": 0.3}
COUNTRIES = ("France", "Italy", "Spain", "USA", "Australia", "Chile", "Argentina")
KINDS = ("Red", "White", "Rosé")
GRAPES = (
    "Cabernet Sauvignon", "Merlot", "Pinot Noir", "Chardonnay", "Sauvignon Blanc",
    "Riesling", "Tempranillo", "Sangiovese", "Syrah", "Grenache",
)
STYLES = ("Rich", "Light", "Crisp", "Smooth", "Bold", "Elegant", "Fresh", "Complex")
COUNTRY_POINTS = {"France": 3, "Italy": 2, "Spain": 1, "USA": 2, "Australia": 1, "Chile": 0, "Argentina": 0}
KIND_POINTS = {"Red": 1, "White": 0, "Rosé": -1}
STYLE_POINTS = {"Complex": 3, "Elegant": 2, "Rich": 1, "Bold": 1, "Smooth": 0, "Fresh": 0, "Crisp": -1, "Light": -1}

CATEGORIES = ("Country", "Region", "Type", "Style", "Grape")


def _quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _digest(key: str, seed: str) -> str:
    return f"md5('{seed}|' || CAST({key} AS VARCHAR))"


def _draw(key: str, seed: str, index: int = 0) -> str:
    start = 8 * index + 1
    return f"((CAST('0x' || substr({_digest(key, seed)}, {start}, 8) AS BIGINT) + 0.5) / 4294967296.0)"


def _normal(key: str, seed: str, sd: str) -> str:
    return f"({sd} * sqrt(-2.0 * ln({_draw(key, seed)})) * cos(2.0 * pi() * {_draw(key, seed, 1)}))"


def _lookup(column: str, values: dict, other: float) -> str:
    cases = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in values.items())
    return f"CASE {column} {cases} ELSE CAST({other} AS DOUBLE) END"


def _choice(key: str, seed: str, values) -> str:
    return f"[{_quoted(values)}][CAST(floor({_draw(key, seed)} * {len(values)}) AS INTEGER) + 1]"


def _na(column: str) -> str:
    return f"CASE WHEN {column} NOT IN ({_quoted(NA_TOKENS)}) THEN {column} END"


def _price(default: float, column: str = "Price") -> str:
    return (
        f"coalesce(try_cast(nullif(regexp_extract({column}, '(\\d+\\.?\\d*)', 1), '') AS DOUBLE), CAST({default} AS DOUBLE))"
    )


def _encode(number: str) -> str:
    return f"replace(CAST(CAST({number} AS DECIMAL(38,4)) AS VARCHAR), '.', '-')"


def _decode(text: str) -> str:
    return f"coalesce(try_cast(replace({text}, '-', '.') AS DOUBLE), 0.0)"


_GRADE = "CASE WHEN {0} >= 4.5 THEN 'Excellent' WHEN {0} >= 4.0 THEN 'Good' ELSE 'Average' END"

_ITEMS = """items AS (
  SELECT o_orderkey AS id, o_orderpriority AS Style, c_mktsegment AS Grape, o_orderstatus AS Type,
    CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 13 = 0 THEN 'NA' ELSE n_name END AS Country,
    r_name AS Region,
    CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 19 = 0 THEN 'call us'
      WHEN o_orderkey % 23 = 0 THEN concat('€', CAST(CAST(o_totalprice/20000 AS DECIMAL(12,2)) AS VARCHAR))
      ELSE concat('$', CAST(CAST(o_totalprice/20000 AS DECIMAL(12,2)) AS VARCHAR), ' / 75cl') END AS Price
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey)"""

_EXPLORED = _ITEMS + f""",
explored AS (
  SELECT id, Style, Grape, Type, {_na('Country')} AS Country, Region, {_na('Price')} AS Price,
    {_price(0.0)} AS price_numeric, least({_price(0.0)} * 0.2 + 3.0, 5.0) AS Rating
  FROM items)"""

_PREPARED = _EXPLORED + """,
prepared AS (
  SELECT id, coalesce(Style, 'Unknown') AS Style, coalesce(Grape, 'Unknown') AS Grape, coalesce(Type, 'Unknown') AS Type,
    coalesce(Country, 'Unknown') AS Country, coalesce(Region, 'Unknown') AS Region, Price, price_numeric, Rating
  FROM explored)"""

_PREDICTED = _PREPARED + f""",
rated AS (
  SELECT * REPLACE (greatest(least(3.2 + price_numeric * 0.03 + {_lookup('Country', NATION_BONUS, 0.1)}
    + {_lookup('Type', STATUS_BONUS, 0.1)} + {_normal('id', '42', '0.2')}, 5.0), 3.0) AS Rating)
  FROM prepared),
predicted AS (SELECT *, Rating + {_normal('id', 'prediction', '0.1')} AS prediction FROM rated)"""

_METRICS = """count(*) AS n, avg((Rating - prediction) * (Rating - prediction)) AS mse,
    sqrt(avg((Rating - prediction) * (Rating - prediction))) AS rmse, avg(abs(Rating - prediction)) AS mae,
    1.0 - avg((Rating - prediction) * (Rating - prediction)) / var_pop(Rating) AS r2_score"""

_CURRENT = "least(greatest(0.7 * least(greatest(r2_score, 0), 1) + 0.3 * greatest(1.0 - rmse / 5.0, 0), 0), 1)"
_LEGACY = "0.7 * greatest(r2_score, 0) + 0.3 * greatest(1.0 - rmse, 0)"


def _split(key: str = "id") -> str:
    return f"CASE WHEN substr({_digest(key, '42')}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END"


_REGISTRY = f"""registry AS (
  SELECT 'models/' || event_id AS resource_name, 'model-' || (user_id % 20) AS display_name, event_id AS version,
    ts AS create_time, 'store/' || event_id AS uri, 'image:1' AS image,
    ['true', 'TRUE', 'false', NULL][CAST(event_id % 4 AS INTEGER) + 1] AS ready,
    CASE WHEN event_type = 'signup' THEN 'completed' ELSE event_type END AS status,
    {_encode('least(value / 100, 1.0)')} AS quality, {_encode('1.0 - least(value / 100, 1.0)')} AS rmse_label,
    CAST(user_id AS VARCHAR) AS build
  FROM events)"""

_LATEST = _REGISTRY + f""",
latest AS (
  SELECT resource_name AS model_uri, display_name, resource_name, build AS harness_build_id, status AS eval_status,
    ready AS ready_for_promotion, {_decode('quality')} AS quality_score, 0.0::DOUBLE AS mae, 0.0::DOUBLE AS mse,
    0.0::DOUBLE AS r2_score, {_decode('rmse_label')} AS rmse
  FROM (SELECT *, row_number() OVER (PARTITION BY display_name ORDER BY create_time DESC, resource_name DESC) AS place
        FROM registry WHERE lower(ready) = 'true')
  WHERE place = 1)"""

_FETCHED = _REGISTRY + f""",
fetched AS (
  SELECT resource_name AS model_uri, display_name, status AS eval_status, {_decode('quality')} AS quality_score,
    ready AS ready_for_promotion, build AS harness_build_id FROM registry)"""


def _gate(source: str, threshold: float) -> str:
    ready = "coalesce(ready_for_promotion, 'false')"
    four = "CAST(CAST({} AS DECIMAL(38,4)) AS VARCHAR)"
    return f"""
  SELECT eval_status = 'completed' AND quality_score >= {threshold} AND lower({ready}) = 'true' AS gate_passed,
    display_name AS model_name, quality_score, {threshold}::DOUBLE AS promotion_threshold, eval_status,
    {ready} AS ready_for_promotion, model_uri, display_name,
    concat_ws('; ',
      CASE WHEN eval_status <> 'completed' THEN 'eval_status is ' || eval_status || ' (required: completed)' END,
      CASE WHEN quality_score < {threshold} THEN 'quality_score ' || {four.format('quality_score')} || ' < '
        || {four.format(threshold)} END,
      CASE WHEN lower({ready}) <> 'true' THEN 'ready_for_promotion is ' || {ready} || ' (required: true)' END
    ) AS failure_reasons,
    harness_build_id
  FROM {source}"""


_TARGET = """target AS (
  SELECT 'target/' || (s_suppkey % 10) AS resource_name, 'model-' || (s_suppkey % 10) AS display_name, s_suppkey AS version
  FROM supplier),
known AS (SELECT display_name, max(version) AS last_version, max(resource_name) AS parent FROM target GROUP BY 1)"""

_SCORE_TEXT = "CAST(CAST(value / 100 AS DECIMAL(18,6)) AS VARCHAR)"
_STATUS_TEXT = "regexp_replace(lower('Status: ' || event_type || '!'), '[^a-z0-9_-]', '-', 'g')"
_LABELS = f"""'true' AS ready_for_promotion, 'build-7' AS harness_build_id, 'prd-test' AS env,
    {_encode('CAST(' + _SCORE_TEXT + ' AS DOUBLE)')} AS r2_score, CAST(NULL AS VARCHAR) AS rmse, CAST(NULL AS VARCHAR) AS mae,
    {_encode('CAST(' + _SCORE_TEXT + ' AS DOUBLE)')} AS quality_score, {_STATUS_TEXT} AS eval_status"""


def _words(text: str) -> str:
    return f"list_filter(regexp_extract_all(lower({text}), '{WORD_PATTERN}'), lambda w: w NOT IN ({_quoted(ENGLISH_STOP_WORDS)}))"


def _space(source: str, key: str, text: str) -> str:
    """Items with their sorted bag, distinct texts and normalized weights per text."""
    return f"""item AS (SELECT {key} AS id, array_to_string(list_sort({_words(text)}), ' ') AS bag FROM {source}),
textual AS (SELECT bag, min(id) AS text_id, count(*) AS copies FROM item WHERE bag <> '' GROUP BY bag),
counted AS (SELECT text_id, copies, term, count(*) AS tf
  FROM (SELECT text_id, copies, unnest(string_split(bag, ' ')) AS term FROM textual) GROUP BY ALL),
frequency AS (SELECT term, sum(copies) AS df FROM counted GROUP BY term),
raw AS (SELECT text_id, term, tf * (ln((1.0 + (SELECT count(*) FROM item)) / (1.0 + df)) + 1.0) AS w
  FROM counted JOIN frequency USING (term)),
weights AS (SELECT text_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY text_id)) AS weight FROM raw),
pairs AS (SELECT a.text_id AS left_id, b.text_id AS right_id, round(sum(a.weight * b.weight), 6) AS cosine
  FROM weights a JOIN weights b ON a.term = b.term AND a.text_id < b.text_id GROUP BY 1, 2)"""


def _top(k: int, asked: str) -> str:
    return f""",
directed AS (SELECT left_id AS text_id, right_id AS other_id, cosine FROM pairs UNION ALL SELECT right_id, left_id, cosine FROM pairs
  UNION ALL SELECT text_id, text_id, 1.0 FROM textual),
member AS (SELECT id, text_id FROM item JOIN textual USING (bag)),
ranked AS (SELECT m.id, o.id AS similar_id, cosine,
    row_number() OVER (PARTITION BY m.id ORDER BY cosine DESC, o.id) AS rank
  FROM member m JOIN directed USING (text_id) JOIN member o ON o.text_id = directed.other_id
  WHERE m.id <> o.id AND m.id IN ({asked}))
SELECT id, CAST(rank AS INTEGER) AS rank, similar_id, cosine FROM ranked WHERE rank <= {k}"""


_TEXTS = "(SELECT p_partkey AS id, lower(concat(p_name, ' ', p_brand, ' ', p_type)) AS text FROM part)"


def _coverage(extra: str = "") -> str:
    return f""",
strong AS (SELECT left_id AS text_id FROM pairs WHERE cosine > 0.5 UNION SELECT right_id FROM pairs WHERE cosine > 0.5),
covered AS (SELECT CAST(coalesce(sum(copies) FILTER (copies > 1 OR text_id IN (SELECT text_id FROM strong)), 0) AS BIGINT) AS n
  FROM textual)
SELECT (SELECT count(*) FROM item) AS items, n AS covered_items, round(n / (SELECT count(*) FROM item), 6) AS coverage_score{extra}
FROM covered"""


def _box(source: str, target: str, columns) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS category, id, {target} AS value FROM {source} WHERE {c} IS NOT NULL" for c in columns
    )
    return f"""points AS ({parts}),
quartiles AS (SELECT feature, category, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
  quantile_cont(value, 0.75) AS q3 FROM points GROUP BY ALL),
marked AS (SELECT points.*, value BETWEEN q1 - (q3 - q1) * 1.5 AND q3 + (q3 - q1) * 1.5 AS inside
  FROM points JOIN quartiles USING (feature, category)),
whiskers AS (SELECT feature, category, min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high,
  count(*) FILTER (NOT inside) AS n_outliers FROM marked GROUP BY ALL)"""


_BOX_STATS = """SELECT feature, category, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
  round(whisker_low, 6) AS whisker_low, round(whisker_high, 6) AS whisker_high, n_outliers
FROM quartiles JOIN whiskers USING (feature, category)"""


def _histogram(column: str) -> str:
    return f"""SELECT '{column}' AS feature, bin, round(lo + bin * w, 6) AS bin_start, round(lo + (bin + 1) * w, 6) AS bin_end, n
FROM (SELECT CAST(least(floor(({column} - lo) / (hi - lo) * 30), 29) AS INTEGER) AS bin, any_value(lo) AS lo,
        any_value((hi - lo) / 30.0) AS w, count(*) AS n
      FROM explored, (SELECT CAST(min({column}) AS DOUBLE) AS lo, CAST(max({column}) AS DOUBLE) AS hi FROM explored)
      GROUP BY 1)"""


def _correlations(columns) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM explored"
        for a in columns for b in columns
    )


_REQUESTS = _ITEMS + """,
raw AS (SELECT id, regexp_extract(Price, '(\\d+\\.\\d+)', 1) AS p, Country, Region, Type, Style, Grape, id % 10 AS kind FROM items),
opened AS (
  SELECT id, position, p, coalesce(Country, '') AS Country, Region, Type, Style, Grape, 'OK' AS status,
    CAST(NULL AS VARCHAR) AS error FROM raw, (VALUES (0), (1)) AS t(position) WHERE kind < 7
  UNION ALL SELECT id, 0, p, Country, Region, Type, Style, Grape, 'OK', NULL FROM raw WHERE kind = 7
  UNION ALL SELECT id, 0, NULL, NULL, NULL, NULL, NULL, NULL, 'FAILED', 'expected 6 features, got 2' FROM raw WHERE kind = 8
  UNION ALL SELECT id, 0, NULL, NULL, NULL, NULL, NULL, NULL, 'FAILED', 'no instances in document' FROM raw WHERE kind = 9),
cleaned AS (
  SELECT id, position, coalesce(try_cast(p AS DOUBLE), 0.0) AS price_numeric, coalesce(Country, 'Unknown') AS Country,
    coalesce(Region, 'Unknown') AS Region, coalesce(Type, 'Unknown') AS Type, coalesce(Style, 'Unknown') AS Style,
    coalesce(Grape, 'Unknown') AS Grape, status, error FROM opened),
scored AS (
  SELECT id, position, CASE WHEN status = 'OK' THEN least(price_numeric * 0.2 + 3.0, 5.0) END AS prediction, status, error
  FROM cleaned)"""


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    def add(name: str, ctes: str, body: str) -> None:
        sql[name] = f"WITH {ctes}\n{body}" if ctes else body

    # Sources and sinks
    add("csv_catalog", _EXPLORED, "SELECT id, Style, Grape, Type, Country, Region, Price FROM explored")
    add("jsonl_batch_input", _ITEMS, "SELECT id, Style, Grape, Type, Country, Region, Price FROM items")
    add("datasets_written", _PREPARED, f"SELECT id, price_numeric, Rating, {_split()} AS split FROM prepared")
    add("predictions_written", _PREDICTED, f"""SELECT id, 'batch_1' AS batch_run_id, 'train_1' AS training_run_id,
      round(prediction, 2) AS quality_score, {_GRADE.format('prediction')} AS quality_grade, Country AS input_Country,
      Type AS input_Type, 'store/model' AS model_path FROM predicted""")
    add("row_ids", _ITEMS, "SELECT row_number() OVER (ORDER BY id) AS id, id AS order_key, Price FROM items")
    add("row_ids_file_order", "", "SELECT row_number() OVER (ORDER BY o_orderkey) AS id, o_orderkey FROM orders")
    add("row_numbers_by_group", "", """SELECT o_orderkey, o_orderstatus, o_totalprice,
      row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders""")

    # Cleaning
    add("na_normalized", _EXPLORED, "SELECT id, Style, Grape, Type, Country, Region, Price FROM explored")
    add("categoricals_filled", _PREPARED, "SELECT id, Country, Region, Type, Style, Grape FROM prepared")
    add("categoricals_filled_batch", _PREPARED, "SELECT id, Country, Type, Grape, Style FROM prepared")
    for default in (0, 10, 15):
        add(f"price_default{default}", _ITEMS, f"SELECT id, {_price(default)} AS price_numeric FROM items")
    add("price_coerced", _ITEMS, """SELECT id, coalesce(try_cast(regexp_replace(Price, '[^0-9a-z.]', '', 'g') AS DOUBLE), 15.0)
      AS price_numeric FROM items""")
    add("linear_rating", _PREPARED, "SELECT id, round(Rating, 6) AS Rating FROM prepared")
    add("linear_rating_clamped", _ITEMS,
        f"SELECT id, round(greatest(least({_price(10)} * 0.15 + 3.0, 5.0), 3.0), 6) AS Rating FROM items")
    add("bonus_rating", _PREDICTED, "SELECT id, round(Rating, 6) AS Rating FROM predicted")
    add("seeded_noise", _ITEMS, f"SELECT id, round({_normal('id', '42', '0.2')}, 6) AS noise FROM items")
    add("combined_text", _EXPLORED, """SELECT id, CAST(id AS VARCHAR) AS name,
      trim(Grape || ' ' || Style || ' ' || Type || ' ' || coalesce(Country, '') || ' ' || Region) AS combined_features
      FROM explored""")
    drawn = f"exp(2.5 + {_normal('o_orderkey', '42-price', '0.8')})"
    add("generated_catalog", f"""drawn AS (
      SELECT o_orderkey AS id, {drawn} AS p, {_choice('o_orderkey', '42-country', COUNTRIES)} AS country,
        {_choice('o_orderkey', '42-kind', KINDS)} AS kind, {_choice('o_orderkey', '42-grape', GRAPES)} AS grape,
        {_choice('o_orderkey', '42-style', STYLES)} AS style, {_normal('o_orderkey', '42-noise', '2.0')} AS noise
      FROM orders)""", f"""SELECT id, round(p, 2) AS price, country, kind, grape, style,
      round(greatest(80.0, least(100.0, 85.0 + least(15.0, 2.0 * ln(p)) + {_lookup('country', COUNTRY_POINTS, 0)}
        + {_lookup('kind', KIND_POINTS, 0)} + {_lookup('style', STYLE_POINTS, 0)} + noise)), 1) AS rating FROM drawn""")

    # Exploration
    add("rating_by_segment", f"{_PREPARED}, {_box('prepared', 'Rating', ['Grape'])}", _BOX_STATS)
    add("shape", "", "SELECT count(*) AS n_rows, 9 AS n_columns FROM orders")
    add("head", _EXPLORED, "SELECT * FROM explored ORDER BY id LIMIT 5")
    columns = ("id", "Style", "Grape", "Type", "Country", "Region", "Price", "price_numeric", "Rating")
    add("missing_counts", _EXPLORED, "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing FROM explored" for c in columns
    ) + ") WHERE n_missing > 0")
    kinds = {"id": "bigint", "price_numeric": "double", "Rating": "double"}
    add("distinct_counts", _EXPLORED, " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{kinds.get(c, 'string')}' AS type, count(DISTINCT {c}) AS n_distinct FROM explored"
        for c in columns
    ))
    numbers = ("id", "price_numeric", "Rating")
    add("histogram30", _EXPLORED, " UNION ALL ".join(_histogram(c) for c in numbers))
    add("density_curve", _EXPLORED + """,
stats AS (SELECT CAST(count(price_numeric) AS DOUBLE) AS n, min(price_numeric) AS lo, max(price_numeric) AS hi,
  pow(count(price_numeric), -0.2) * stddev_samp(price_numeric) AS h FROM explored),
grid AS (SELECT CAST(position AS INTEGER) AS position, lo + (hi - lo) * position / 199.0 AS x
  FROM stats, range(200) AS r(position)),
sums AS (SELECT position, x, sum(exp(-0.5 * ((x - price_numeric) / h) * ((x - price_numeric) / h))) AS kernel
  FROM grid, explored, stats GROUP BY position, x)""", """SELECT 'price_numeric' AS feature, position, round(x, 6) AS x,
  round(kernel / (n * h * sqrt(2.0 * pi())), 6) AS density,
  round(kernel / (h * sqrt(2.0 * pi())) * (hi - lo) / 30.0, 6) AS curve FROM sums, stats""")
    add("correlation_matrix", _EXPLORED, _correlations(numbers))
    add("scatter_points", _EXPLORED, """SELECT id, round(Rating, 6) AS y, 'price_numeric' AS feature,
      round(price_numeric, 6) AS x FROM explored""")
    add("top10_categories", _EXPLORED, "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS category, count(*) AS n, CAST(row_number() OVER (ORDER BY count(*) DESC, {c}) AS INTEGER)"
        f" AS rank FROM explored WHERE {c} IS NOT NULL GROUP BY {c}" for c in CATEGORIES
    ) + ") WHERE rank <= 10")
    add("boxplot_stats", f"{_EXPLORED}, {_box('explored', 'Rating', CATEGORIES)}", _BOX_STATS)
    add("boxplot_outliers", f"{_PREDICTED}, {_box('predicted', 'prediction', CATEGORIES)}",
        "SELECT feature, category, id, round(value, 6) AS value FROM marked WHERE NOT inside")
    add("value_ranges", _EXPLORED, " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(CAST(min({c}) AS DOUBLE), 6) AS min_value, round(CAST(max({c}) AS DOUBLE), 6)"
        f" AS max_value FROM explored" for c in numbers
    ))

    report = {
        "shape": ("''", ("n_rows", "n_columns")), "missing_counts": ('"column"', ("n_missing",)), "distinct_counts": ('"column"', ("n_distinct",)),
        "value_ranges": ("feature", ("min_value", "max_value")), "histogram30": ("feature || '|' || bin", ("bin_start", "bin_end", "n")),
        "correlation_matrix": ("feature_a || '|' || feature_b", ("correlation",)), "top10_categories": ("feature || '|' || category", ("n", "rank")),
        "boxplot_stats": ("feature || '|' || category", ("n", "q1", "median", "q3", "whisker_low", "whisker_high", "n_outliers")),
    }
    names = {"histogram30": "histogram", "top10_categories": "top_categories"}
    sql["eda_report"] = " UNION ALL ".join(
        f"""SELECT '{names.get(t, t)}' AS "table", {item} AS item, '{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM ({sql[t]})"""
        for t, (item, measures) in report.items() for m in measures
    )

    # Split and features
    add("split_assignment", _ITEMS, f"SELECT id, {_split()} AS split FROM items")
    add("split_counts", _ITEMS, f"SELECT {_split()} AS split, count(*) AS n FROM items GROUP BY 1")
    add("split_exact", _ITEMS, f"""SELECT id, CASE WHEN row_number() OVER (ORDER BY {_digest('id', '42')})
      <= ceil(round(count(*) OVER () * 0.2, 9)) THEN 'test' ELSE 'train' END AS split FROM items""")
    add("standardized", _PREPARED, """SELECT id, round((price_numeric - avg(price_numeric) OVER ())
      / stddev_pop(price_numeric) OVER (), 6) AS price_numeric_scaled FROM prepared""")
    add("feature_order_selected", _PREPARED, "SELECT id, price_numeric, Country, Region, Type, Style, Grape FROM prepared")

    # Evaluation
    metrics = f"{_PREDICTED}, metrics AS (SELECT {_METRICS} FROM predicted)"
    by_country = f"{_PREDICTED}, metrics AS (SELECT Country, {_METRICS} FROM predicted GROUP BY Country)"
    add("regression_metrics", metrics, """SELECT n, round(mse, 6) AS mse, round(rmse, 6) AS rmse, round(mae, 6) AS mae,
      round(r2_score, 6) AS r2_score FROM metrics""")
    add("quality_score", by_country, f"SELECT Country, round({_CURRENT}, 6) AS quality_score FROM metrics")
    add("quality_score_legacy", by_country, f"SELECT Country, round({_LEGACY}, 6) AS quality_score FROM metrics")

    def text(number: str) -> str:
        return (f"regexp_replace(CAST(CAST(round({number}, 4) AS DECIMAL(38,4)) AS VARCHAR), '(\\.\\d+?)0+$', '\\1')")

    add("evaluation_record", metrics, f"""SELECT 'pyspark.ml' AS framework, {text(_CURRENT)} AS quality_score,
      {text('r2_score')} AS r2_score, {text('rmse')} AS rmse, {text('mae')} AS mae, {text('mse')} AS mse,
      {text('rmse / 5.0')} AS rmse_normalized, 'completed' AS evaluation_status, CAST(n AS VARCHAR) AS test_samples,
      CAST(NULL AS VARCHAR) AS error_message FROM metrics""")
    add("threshold_branch", by_country, f"SELECT Country, n FROM metrics WHERE {_CURRENT} >= 0.93")
    checks = ["SELECT 'empty' AS \"check\", '*' AS \"column\", 'ok' AS severity, CAST(0 AS BIGINT) AS n"]
    fields = ["price_numeric", *CATEGORIES, "Vintage", "Rating"]
    for c in fields:
        missing = c == "Vintage"
        checks.append(f"SELECT 'missing_column', '{c}', '{'error' if missing else 'ok'}', CAST({int(missing)} AS BIGINT)")
        if not missing:
            severity = "error" if c == "Rating" else "warning"
            checks.append(f"SELECT 'nulls', '{c}', CASE WHEN count({c}) < count(*) THEN '{severity}' ELSE 'ok' END, "
                          f"count(*) - count({c}) FROM explored")
    add("data_contract", _EXPLORED, " UNION ALL ".join(checks))
    add("graded_predictions", _PREDICTED, f"""SELECT id, round(prediction, 2) AS quality_score,
      {_GRADE.format('prediction')} AS quality_grade, Country AS input_Country, Type AS input_Type, Grape AS input_Grape,
      Style AS input_Style FROM predicted""")
    add("input_index", _ITEMS, "SELECT id, Price, row_number() OVER (ORDER BY id) - 1 AS input_index FROM items")
    add("result_validation", _PREDICTED, """SELECT 'batch_' || Region AS batch_run_id, 'train_1' AS training_run_id,
      count(*) AS n, min(round(prediction, 2)) AS min_score, max(round(prediction, 2)) AS max_score,
      'Batch batch_' || Region || ': ' || count(*) || ' predictions validated' AS summary, CAST(NULL AS VARCHAR) AS error
      FROM predicted GROUP BY Region""")
    add("result_validation_expected", _PREDICTED + """,
counted AS (SELECT Region, count(*) AS n, min(round(prediction, 2)) AS lo, max(round(prediction, 2)) AS hi FROM predicted
  WHERE Region <> 'ASIA' GROUP BY Region)""", """SELECT 'batch_' || r_name AS batch_run_id,
      CASE WHEN n > 0 THEN 'train_1' END AS training_run_id, coalesce(n, 0) AS n, lo AS min_score, hi AS max_score,
      'Batch batch_' || r_name || ': ' || coalesce(n, 0) || ' predictions validated' AS summary,
      CASE WHEN n IS NULL THEN 'no predictions to validate' END AS error FROM region LEFT JOIN counted ON Region = r_name""")
    add("result_validation_empty", "", """SELECT CAST(NULL AS VARCHAR) AS batch_run_id, CAST(NULL AS VARCHAR) AS training_run_id,
      CAST(0 AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS min_score, CAST(NULL AS DOUBLE) AS max_score,
      'Batch unknown: 0 predictions validated' AS summary, 'no predictions to validate' AS error
      FROM (SELECT count(*) FROM orders)""")
    add("scoring_check", _PREDICTED + """,
made AS (SELECT *, CASE WHEN Country <> 'NATION_9' THEN prediction END AS p FROM predicted)""", """
      SELECT Country, count(*) AS test_instances_count, count(p) AS predictions_count,
        round(arg_min(p, id) FILTER (p IS NOT NULL), 6) AS sample_prediction,
        CASE WHEN count(p) = count(*) THEN 'PASSED' ELSE 'FAILED' END AS status,
        CASE WHEN count(p) < count(*) THEN 'Expected predictions count : ' || count(*) END AS error
      FROM made GROUP BY Country""")
    add("fit_report", f"{_PREDICTED}, halves AS (SELECT *, {_split()} AS split FROM predicted)", """SELECT split, count(*) AS n,
      round(sqrt(avg((Rating - prediction) * (Rating - prediction))), 6) AS rmse,
      round(1.0 - avg((Rating - prediction) * (Rating - prediction)) / var_pop(Rating), 6) AS r2_score,
      round(min(Rating), 6) AS target_min, round(max(Rating), 6) AS target_max FROM halves GROUP BY split""")

    # Registry
    add("labels_encoded", "", f"SELECT event_id, {_LABELS}, 6 AS n_labels FROM events")
    add("labels_decoded", _REGISTRY, f"""SELECT resource_name, {_decode('quality')} AS quality_score,
      {_decode('rmse_label')} AS rmse, 0.0::DOUBLE AS mae FROM registry""")
    add("labels_merged", _REGISTRY, """SELECT resource_name, 'prd-test' AS env, 'prd-workload' AS forced_env, build,
      'source' AS promoted_from, CASE WHEN ready IS NULL THEN 6 ELSE 7 END AS n_labels,
      CASE WHEN ready IS NULL THEN 6 ELSE 7 END AS n_forced FROM registry""")
    add("labels_capped", "", """SELECT event_id, CAST(CASE WHEN user_id % 15 + 1 > 10 THEN 3 ELSE user_id % 15 + 1 END AS INTEGER)
      AS n_labels, CASE WHEN user_id % 15 + 1 > 10 THEN 'prd-test' END AS environment,
      CAST(CASE WHEN user_id % 15 + 1 > 10 THEN user_id % 15 + 1 ELSE 0 END AS INTEGER) AS n_overflow FROM events""")
    add("versions_newest_first", _REGISTRY, """SELECT display_name, resource_name, version,
      row_number() OVER (ORDER BY display_name, create_time DESC, resource_name DESC) AS place FROM registry""")
    add("latest_promotable", _LATEST, "SELECT * FROM latest")
    add("fetch_failures", _LATEST + """,
wanted AS (SELECT DISTINCT 'model-' || c_custkey AS display_name FROM customer),
counts AS (SELECT display_name, count(*) AS versions FROM registry GROUP BY 1)""", """
      SELECT coalesce(model_uri, '') AS model_uri, display_name, coalesce(resource_name, '') AS resource_name,
        coalesce(harness_build_id, 'unknown') AS harness_build_id, coalesce(eval_status, 'failed') AS eval_status,
        coalesce(ready_for_promotion, 'false') AS ready_for_promotion, coalesce(quality_score, 0.0) AS quality_score,
        coalesce(mae, 0.0) AS mae, coalesce(mse, 0.0) AS mse, coalesce(r2_score, 0.0) AS r2_score, coalesce(rmse, 0.0) AS rmse,
        CASE WHEN resource_name IS NULL AND versions IS NULL THEN 'No models found with display name: ' || display_name
          WHEN resource_name IS NULL THEN 'No models with ''ready-for-promotion=true'' found among ' || versions || ' models'
        END AS error_message
      FROM wanted LEFT JOIN counts USING (display_name) LEFT JOIN latest USING (display_name)""")
    add("gate", _FETCHED, """SELECT model_uri, eval_status = 'completed' AND quality_score >= 0.99
      AND coalesce(lower(ready_for_promotion) = 'true', false) AS gate_passed FROM fetched""")
    add("gate_reasons", _FETCHED, _gate("fetched", 0.95))
    unreadable = _FETCHED + f""",
texted AS (SELECT resource_name AS model_uri, CASE WHEN version % 3 = 0 THEN 'n/a' END AS shown FROM registry),
readable AS (SELECT f.* REPLACE (CASE WHEN shown IS NULL THEN quality_score ELSE 0.0 END AS quality_score), shown
  FROM fetched f JOIN texted USING (model_uri)),
judged AS (SELECT g.*, shown FROM ({_gate('readable', 0.95)}) g JOIN texted USING (model_uri))"""
    add("gate_unreadable", unreadable, """SELECT * EXCLUDE (shown) REPLACE (CASE WHEN shown IS NULL THEN failure_reasons
      WHEN eval_status <> 'completed' THEN replace(failure_reasons, '; quality_score ', '; quality_score n/a is not a number; quality_score ')
      ELSE 'quality_score n/a is not a number; ' || failure_reasons END AS failure_reasons) FROM judged""")
    add("failed_registrations", "", """SELECT CASE WHEN event_id % 5 > 0 THEN 'model-' || (user_id % 20) ELSE '' END AS display_name,
      CASE WHEN event_id % 7 > 0 THEN 'store/' || event_id ELSE '' END AS uri, '' AS resource_name, '' AS model_version,
      false AS is_new_model, 'failed' AS registration_status, 'build-7' AS harness_build_id,
      CASE WHEN event_id % 5 = 0 THEN 'candidate has no display name' ELSE 'candidate has no uri' END AS error_message
      FROM events WHERE event_id % 5 = 0 OR event_id % 7 = 0""")
    add("registered_versions", _TARGET + """,
candidate AS (SELECT 'model-' || (user_id % 20) AS display_name, ts, 'store/' || event_id AS uri, event_type, value FROM events)""",
        f"""SELECT coalesce(parent, 'models/' || display_name) AS resource_name, display_name,
      coalesce(last_version, 0) + row_number() OVER (PARTITION BY display_name ORDER BY ts, uri) AS version, uri,
      last_version IS NULL AS is_new_model, {_LABELS}, display_name AS metadata_name
      FROM candidate LEFT JOIN known USING (display_name)""")
    add("default_versions", _REGISTRY, """SELECT display_name, resource_name, version FROM registry
      QUALIFY row_number() OVER (PARTITION BY display_name ORDER BY version DESC) = 1""")
    by_user = _LATEST.replace("'model-' || (user_id % 20) AS display_name", "'model-' || user_id AS display_name")
    add("promotion_run", f"{by_user}, {_TARGET}, checked AS ({_gate('latest', 0.3)})", """
      SELECT c.model_uri AS source_model_uri, coalesce(parent, 'models/' || c.display_name) AS target_model_uri,
        c.display_name, 'source' AS source_project, 'target' AS target_project, '2025-08-07' AS promotion_date,
        '2025-08-07T10:00:00Z' AS promotion_timestamp,
        CASE WHEN uri IS NULL THEN '' ELSE CAST(coalesce(last_version, 0) + 1 AS VARCHAR) END AS model_version,
        last_version IS NULL AS is_new_model, CASE WHEN uri IS NULL THEN 'failed' ELSE 'completed' END AS promotion_status,
        CASE WHEN uri IS NULL THEN 'source has no model ' || c.model_uri END AS error_message,
        'build-7' AS harness_build_id, c.quality_score, c.eval_status,
        coalesce(image, 'unknown') AS container_image, uri, 'prd-workload' AS env, 'source' AS promoted_from,
        CASE WHEN uri IS NULL THEN 'build-7' ELSE build END AS label_build, CASE WHEN uri IS NULL THEN 4 ELSE 8 END AS n_labels,
        c.quality_score AS metadata_score, c.display_name AS metadata_name, 8 AS n_metadata
      FROM checked c LEFT JOIN (SELECT * FROM registry WHERE version % 7 > 0) r ON r.resource_name = c.model_uri
        LEFT JOIN known k ON k.display_name = c.display_name
      WHERE gate_passed""")
    add("promotion_gate_run", _LATEST, _gate("latest", 0.3))

    add("records_written", _FETCHED, f"""SELECT model_uri, gate_passed, quality_score,
      CASE WHEN failure_reasons = '' THEN 0 ELSE CAST(len(string_split(failure_reasons, '; ')) AS INTEGER) END AS n_reasons
      FROM ({_gate('fetched', 0.95)})""")

    # Similar items
    add("tokens", f"occurrence AS (SELECT doc_id, unnest({_words('text')}) AS term FROM documents)",
        "SELECT term, count(*) AS n, count(DISTINCT doc_id) AS n_docs FROM occurrence GROUP BY term")
    add("tfidf_weights", f"""occurrence AS (SELECT doc_id, unnest({_words('text')}) AS term FROM documents),
counted AS (SELECT doc_id, term, count(*) AS tf FROM occurrence GROUP BY ALL),
frequency AS (SELECT term, count(*) AS df FROM counted GROUP BY term),
raw AS (SELECT doc_id, term, tf * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS w
  FROM counted JOIN frequency USING (term))""",
        "SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw")
    similar = """SELECT left_id, right_id, cosine, l.copies AS left_copies, r.copies AS right_copies
      FROM pairs JOIN textual l ON l.text_id = left_id JOIN textual r ON r.text_id = right_id WHERE cosine > 0.5"""
    part_space = _space(_TEXTS, "id", "text")
    document_space = _space("documents", "doc_id", "text")
    add("similar_pairs", part_space, similar)
    add("similar_documents", document_space, similar)
    sql["top5_similar"] = "WITH " + part_space + _top(5, "SELECT id FROM item")
    sql["recommend_for_items"] = "WITH " + part_space + _top(5, "SELECT p_partkey FROM part WHERE p_type = 'PROMO'")
    sql["similarity_coverage"] = "WITH " + document_space + _coverage()
    add("display_names", "", """SELECT p_partkey AS id, CASE WHEN p_type <> 'PROMO' THEN p_name ELSE CAST(p_partkey AS VARCHAR) END
      AS name FROM part""")
    combined = """combined AS (SELECT id, trim(Grape || ' ' || Style || ' ' || Type || ' ' || coalesce(Country, '') || ' ' || Region)
      AS text FROM explored)"""
    sql["recommender_gate"] = (
        f"WITH {_EXPLORED}, {combined}, " + _space("combined", "id", "text")
        + _coverage(", n / (SELECT count(*) FROM item) >= 0.5 AS gate_passed")
    )

    # Many items share a text, so lists are made per text from its six lowest ids.
    sql["recommend_catalog"] = f"WITH {_EXPLORED}, {combined}, " + _space("combined", "id", "text") + """,
directed AS (SELECT left_id AS text_id, right_id AS other_id, cosine FROM pairs UNION ALL SELECT right_id, left_id, cosine FROM pairs
  UNION ALL SELECT text_id, text_id, 1.0 FROM textual),
member AS (SELECT id, text_id FROM item JOIN textual USING (bag)),
lowest AS (SELECT * FROM member QUALIFY row_number() OVER (PARTITION BY text_id ORDER BY id) <= 6),
listed AS (SELECT d.text_id, l.id AS similar_id, cosine FROM directed d JOIN lowest l ON l.text_id = d.other_id
  QUALIFY row_number() OVER (PARTITION BY d.text_id ORDER BY cosine DESC, l.id) <= 6),
ranked AS (SELECT id, similar_id, cosine, row_number() OVER (PARTITION BY id ORDER BY cosine DESC, similar_id) AS rank
  FROM member JOIN listed USING (text_id) WHERE id <> similar_id)
SELECT id, CAST(rank AS INTEGER) AS rank, similar_id, cosine FROM ranked WHERE rank <= 5"""

    # Models
    add("one_hot_unseen", _PREPARED + ", seen AS (SELECT DISTINCT Country FROM prepared WHERE Region = 'EUROPE')", """
      SELECT id, (SELECT CAST(count(*) AS INTEGER) FROM seen) AS n_slots,
        CASE WHEN Country IN (SELECT Country FROM seen) THEN 1 ELSE 0 END AS n_set FROM prepared""")
    add("features_assembled", _PREPARED, """SELECT id, (SELECT CAST(1 + count(DISTINCT Country) + count(DISTINCT Region)
      + count(DISTINCT Type) + count(DISTINCT Style) + count(DISTINCT Grape) AS INTEGER) FROM prepared) AS n_slots, 5 AS n_set FROM prepared""")
    add("rf_train_score", _ITEMS, f"""SELECT {_split()} AS split, count(*) AS n, count(*) AS n_scored, count(*) AS n_same, true AS r2_high
      FROM items GROUP BY 1""")
    add("training_run", f"{_ITEMS}, {_TARGET}, halves AS (SELECT {_split()} AS split FROM items)", """
      SELECT 'model-3' AS display_name, parent AS resource_name, last_version + 1 AS version, false AS is_new_model,
        (SELECT count(*) FROM halves WHERE split = 'test') AS n_test,
        '[''price_numeric'', ''Country'', ''Region'', ''Type'', ''Style'', ''Grape'']' AS feature_order, 'true' AS ready_for_promotion,
        'build-7' AS harness_build_id, 'prd-test' AS env, 'completed' AS eval_status, 9 AS n_labels, true AS label_holds_score,
        true AS quality_high
      FROM known WHERE display_name = 'model-3'""")
    add("stored_model_evaluated", "", """SELECT unnest(['all', 'without Grape', 'null targets', 'no rows']) AS "case", 'pyspark.ml' AS framework,
        'Rating' AS target, unnest(['completed', 'failed', 'failed', 'failed']) AS evaluation_status,
        unnest([CAST(n AS VARCHAR), '0', '0', '0']) AS test_samples,
        unnest([NULL, 'Missing columns: Grape', 'Target column ''Rating'' has ' || tenth || ' null values', 'Test dataset is empty']) AS error_message,
        unnest([true, false, false, false]) AS r2_high
      FROM (SELECT count(*) AS n, count(*) FILTER (o_orderkey % 10 = 0) AS tenth FROM orders)""")
    add("batch_scoring_run", _PREPARED, f"""SELECT id, {_price(15)} AS input_price, Country AS input_Country, Type AS input_Type,
      Grape AS input_Grape, Style AS input_Style, true AS grade_agrees, true AS in_range, true AS has_lineage FROM prepared""")
    add("request_documents_streamed", "", """SELECT CAST(floor(o_orderkey / 1000) AS BIGINT) AS doc, count(*) AS n, count(*) AS n_ok,
      count(*) AS n_same FROM orders GROUP BY 1""")
    add("python_model_score", _PREPARED, """SELECT id, round(3.0 + 0.1 * price_numeric + 0.01 * length(Country), 6)
      AS prediction FROM prepared""")

    # Streams
    add("requests_exploded", _REQUESTS, "SELECT * FROM cleaned")
    add("stream_scores", _REQUESTS, f"""SELECT id, position, round(prediction, 6) AS prediction,
      CASE WHEN status = 'OK' THEN {_GRADE.format('prediction')} END AS quality_grade, status, error FROM scored""")
    add("stream_checks", _REQUESTS, """SELECT 'FAILED' AS status, count(*) AS instances, count(prediction) AS predictions
      FROM scored""")
    return sql | event_oracle.oracle_sql(f"WITH {_PREPARED} SELECT * FROM prepared")
