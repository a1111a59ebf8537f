"""Independent SQL for the registered queries.

Common table expressions are named here once and pulled in by each statement with what they need.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

TREND_NAMES = ["urgent", "high", "medium", "not_specified", "low"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
CUSTOMER = ["retail_total_sales_qty", "retail_total_customer_purchase"]
NUMERIC = [*CUSTOMER, "price", "discount", "retail"]
WEATHER = [
    "avg_temp_C", "min_temp_C", "max_temp_C", "dew_point_C", "humidity_percent", "visibility_km", "avg_wind_kmh",
    "max_wind_kmh", "gust_kmh", "slm_pressure_mb", "avg_pressure_mb", "rain_mm",
]
CATEGORICAL = ["category", "color", "fabric", "season_category"]


def _lines(flag: str) -> str:
    return f"""SELECT substr(p_brand, 7) AS brand, CAST(l_suppkey AS INTEGER) AS retail,
      CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS qty,
      CAST(round(l_extendedprice * 100) AS BIGINT) AS cents,
      CAST(round(l_discount * 100) AS BIGINT) AS percent
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag {flag} 'R'"""


def _monday(day: str) -> str:
    return f"CAST(date_trunc('week', {day}) AS DATE)"


def _code(day: str) -> str:
    return f"brand || lpad(CAST(({day} - DATE '1990-01-01') // 84 AS VARCHAR), 3, '0')"


def _tuesday(year: str, week: str) -> str:
    jan1 = f"make_date({year}, 1, 1)"
    t = f"({jan1} + CAST(2 - dayofweek({jan1}) + ({week} - 1) * 7 AS INTEGER))"
    return f"CASE WHEN year({t}) = {year} AND year({t} + 4) = {year} THEN {t} END"


def _iso_monday(year: str, week: str) -> str:
    return f"({_monday(f'make_date({year}, 1, 4)')} + CAST(({week} - 1) * 7 AS INTEGER))"


_RELEASE_ID = (
    "external_code || CAST(retail AS VARCHAR) || season || category || color || fabric || "
    "CAST(release_date AS VARCHAR)"
)

CTES = {
    "sold": _lines("<>"),
    "delivered": _lines("="),
    "weekly": f"""SELECT external_code, retail, weekofyear(date) AS week, year(date) AS year, date, sales,
      CAST(sum(CASE WHEN n <= 12 THEN sales END) OVER (PARTITION BY external_code, retail) AS BIGINT) AS restock
    FROM (SELECT *, row_number() OVER (PARTITION BY external_code, retail ORDER BY date) AS n
      FROM (SELECT brand AS external_code, retail, {_monday('day')} AS date, CAST(sum(qty) AS BIGINT) AS sales
        FROM sold GROUP BY ALL))""",
    "weekly_restock": f"""SELECT brand AS external_code, retail, weekofyear({_monday('day')}) AS week,
      year({_monday('day')}) AS year, CAST(sum(qty) AS BIGINT) AS qty FROM delivered GROUP BY ALL""",
    "weekly_restock_iso": """SELECT brand AS external_code, retail, weekofyear(day) AS week,
      isoyear(day) AS year, CAST(sum(qty) AS BIGINT) AS qty FROM delivered GROUP BY ALL""",
    "item": """SELECT substr(p_brand, 7) AS brand, lower(arg_min(p_type, p_partkey)) AS category,
      split_part(arg_min(p_name, p_partkey), ' ', 1) AS color,
      split_part(arg_min(p_name, p_partkey), ' ', 2) AS fabric FROM part GROUP BY 1""",
    "released": f"""SELECT *, (day - release) // 7 AS off FROM (
      SELECT *, min(day) OVER (PARTITION BY external_code, retail) AS release FROM (
        SELECT brand, {_code('day')} AS external_code, retail, day, qty, cents, percent FROM sold))""",
    "release_item": """SELECT brand, external_code, retail, release,
      CASE WHEN month(release) BETWEEN 3 AND 8 THEN 'SS' ELSE 'AW' END || strftime(release, '%y') AS season,
      CAST(sum(qty) AS BIGINT) AS restock,
      ((2 * sum(cents) + sum(qty)) // (2 * sum(qty))) / 100.0 AS price
    FROM released GROUP BY ALL""",
    "offsets": "SELECT CAST(unnest(range(12)) AS INTEGER) AS week",
    "cells": """SELECT external_code, retail, off AS week, CAST(sum(qty) AS BIGINT) AS sales,
      round(sum(percent) / (count(*) * 100), 4) AS discount
    FROM released GROUP BY ALL""",
    "silver_sales": """SELECT r.external_code, r.retail, season, category, color,
      season || '/' || r.external_code || '.png' AS image_path, fabric, release AS release_date, restock, o.week,
      coalesce(c.sales, 0) AS sales, day(release) AS release_day, month(release) AS release_month,
      year(release) AS release_year, weekofyear(release) AS release_week_of_year,
      weekofyear(release) + o.week AS current_week_of_year, release + o.week * 7 AS current_date_of_week,
      substr(season, 1, 2) AS season_category
    FROM release_item r CROSS JOIN offsets o LEFT JOIN item USING (brand)
    LEFT JOIN cells c ON c.external_code = r.external_code AND c.retail = r.retail AND c.week = o.week""",
    "silver_price": """SELECT r.external_code, r.retail, CAST(price AS FLOAT) AS price, o.week,
      CAST(c.discount AS FLOAT) AS discount
    FROM release_item r CROSS JOIN offsets o
    LEFT JOIN cells c ON c.external_code = r.external_code AND c.retail = r.retail AND c.week = o.week""",
    "silver_customer": """SELECT CAST(l_suppkey AS INTEGER) AS retail, CAST(l_quantity AS BIGINT) AS qty,
      CAST(o_orderdate AS DATE) AS date, year(o_orderdate) AS year, month(o_orderdate) AS month,
      weekofyear(o_orderdate) AS weekofyear FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "silver_restock": f"""SELECT {_code('day')} AS external_code, retail,
      weekofyear(day) AS week, year(day) AS year, CAST(sum(qty) AS BIGINT) AS qty
    FROM delivered GROUP BY ALL""",
    "silver_trends": f"""SELECT *, month(date) AS month, year(date) AS year, weekofyear(date) AS week_of_year
    FROM (SELECT {_monday('o_orderdate')} AS date, {', '.join(
        f"CAST(count(*) FILTER (o_orderpriority = '{p}') AS DOUBLE) AS {c}"
        for c, p in zip(TREND_NAMES, PRIORITIES))} FROM orders GROUP BY 1)""",
    "stats": """SELECT retail, year AS current_year, weekofyear AS current_week_of_year,
      CAST(sum(qty) AS BIGINT) AS retail_total_sales_qty, count(*) AS retail_total_customer_purchase
    FROM silver_customer GROUP BY ALL""",
    "stats_iso": f"""SELECT retail, {_monday('date')} AS week_start,
      CAST(sum(qty) AS BIGINT) AS retail_total_sales_qty, count(*) AS retail_total_customer_purchase
    FROM silver_customer GROUP BY ALL""",
    "sales_rows": f"""SELECT {_RELEASE_ID} AS unique_id, current_date_of_week AS ds, sales AS y,
      year(current_date_of_week) AS current_year, month(current_date_of_week) AS current_month,
      weekofyear(current_date_of_week) AS current_week_of_year, retail, category, color, fabric,
      release_year, release_month, release_day, dayofweek(release_date) + 1 AS release_day_of_week,
      release_week_of_year, week, season_category, external_code, image_path AS img_path
    FROM silver_sales""",
    "features": """SELECT s.*, p.price, p.discount, c.retail_total_sales_qty, c.retail_total_customer_purchase,
      t.date, t.urgent, t.high, t.medium, t.not_specified, t.low
    FROM sales_rows s
    LEFT JOIN silver_price p ON s.external_code = p.external_code AND s.retail = p.retail AND s.week = p.week
    LEFT JOIN stats c ON s.retail = c.retail AND s.current_week_of_year = c.current_week_of_year
      AND s.current_year = c.current_year
    LEFT JOIN silver_trends t ON s.current_week_of_year = t.week_of_year AND s.current_month = t.month
      AND s.current_year = t.year""",
    "features_iso": f"""SELECT s.*, {_monday('ds')} AS week_start, p.price, p.discount,
      c.retail_total_sales_qty, c.retail_total_customer_purchase, t.urgent, t.high, t.medium,
      t.not_specified, t.low
    FROM sales_rows s
    LEFT JOIN silver_price p ON s.external_code = p.external_code AND s.retail = p.retail AND s.week = p.week
    LEFT JOIN stats_iso c ON s.retail = c.retail AND {_monday('s.ds')} = c.week_start
    LEFT JOIN silver_trends t ON {_monday('s.ds')} = t.date""",
    "monitored": f"""SELECT release_year, {', '.join(f'CAST({c} AS DOUBLE) AS {c}' for c in NUMERIC)},
      {', '.join(CATEGORICAL)} FROM features""",
    "panel": """SELECT external_code, retail, date AS ds, sales AS y, week AS current_week_of_year,
      year AS current_year, month(date) AS current_month FROM weekly""",
    "naive": """SELECT external_code, retail, ds, y, (y1 + y2) / 2.0 AS forecast, current_year, current_week_of_year
    FROM (SELECT *, lag(y, 1) OVER w AS y1, lag(y, 2) OVER w AS y2 FROM panel
      WINDOW w AS (PARTITION BY external_code, retail ORDER BY ds)) WHERE y2 IS NOT NULL""",
    "errors": "SELECT *, abs(y - forecast) AS e, abs(y - forecast) / nullif(y, 0) AS ape FROM naive",
    "ranked": """SELECT e, row_number() OVER (ORDER BY e) AS k, count(*) OVER () AS n
    FROM errors WHERE current_year < 2000""",
    "width": "SELECT max(e) FILTER (k = CAST(ceil((n + 1) * 85 / 100.0) AS BIGINT)) AS q FROM ranked",
    "ranked_by_store": """SELECT retail, e, row_number() OVER (PARTITION BY retail ORDER BY e) AS k,
      count(*) OVER (PARTITION BY retail) AS n FROM errors WHERE current_year < 2000""",
    "width_by_store": """SELECT retail, max(n) AS n,
      CAST(max(e) FILTER (k = CAST(ceil((n + 1) * 85 / 100.0) AS BIGINT)) AS DOUBLE) AS q
    FROM ranked_by_store GROUP BY retail""",
    "intervals": """SELECT n.*, CAST(forecast - q AS DOUBLE) AS lo_ci, CAST(forecast + q AS DOUBLE) AS hi_ci
    FROM naive n, width WHERE current_year >= 2000""",
    "rounded": """SELECT external_code, retail, ds, round(forecast, 0) AS forecast,
      round(CASE WHEN lo_ci < 0 THEN 0 ELSE lo_ci END, 0) AS lo_ci, round(hi_ci, 0) AS hi_ci FROM intervals""",
}


def _ledger(name: str, restock: str, key: str, key_sales: str, key_restock: str, order: str) -> None:
    """Join of all pairs and row_number, as the definition reads."""
    CTES[f"opening_{name}"] = """SELECT external_code, retail, week, date, restock AS qty, year
    FROM (SELECT *, row_number() OVER (PARTITION BY external_code, retail
      ORDER BY date NULLS LAST, week, restock, year) AS n FROM {src}) WHERE n = 1""".format(src=f"ledger_{name}")
    CTES[f"inflow_{name}"] = f"""SELECT external_code, retail, week, year, qty, {key_sales} AS {key}
    FROM opening_{name} UNION ALL
    SELECT external_code, retail, week, year, qty, {key_restock} AS {key} FROM {restock}"""
    CTES[f"matched_{name}"] = f"""SELECT external_code, retail, week, year, date, sales, qty, n AS row
    FROM (SELECT s.*, coalesce(i.qty, 0) AS qty, row_number() OVER (
        PARTITION BY s.external_code, s.retail, s.date
        ORDER BY coalesce(i.qty, 0), s.week NULLS LAST, s.sales NULLS LAST) AS n
      FROM (SELECT *, {key_sales} AS {key} FROM ledger_{name}) s
      LEFT JOIN inflow_{name} i USING (external_code, retail, {key})) WHERE n = 1"""
    CTES[f"balance_{name}"] = f"""SELECT *, CAST(sum(qty - sales) OVER (
      PARTITION BY external_code, retail ORDER BY {order}) AS BIGINT) AS accumulated_inventory
    FROM matched_{name}"""


CTES["ledger_weekly"] = "SELECT * FROM weekly"
CTES["ledger_iso"] = "SELECT * FROM weekly"
CTES["ledger_release"] = """SELECT external_code, retail, current_week_of_year AS week,
  year(current_date_of_week) AS year, current_date_of_week AS date, sales, restock FROM silver_sales"""
_ledger("weekly", "weekly_restock", "yw", "year * 1000 + week", "year * 1000 + week", "week")
_ledger("iso", "weekly_restock_iso", "ws", _monday("date"), _iso_monday("year", "week"), "date")
_ledger("release", "silver_restock", "yw", "year * 1000 + week", "year * 1000 + week", "week")


def _counts(columns: list[str], dtype: str) -> str:
    parts = [
        f"""SELECT '{c}' AS col, CAST({c} AS {dtype}) AS v, count(*) FILTER (release_year < 2000) AS r,
      count(*) FILTER (release_year >= 2000) AS c FROM monitored WHERE {c} IS NOT NULL GROUP BY 2"""
        for c in columns
    ]
    return "\n    UNION ALL ".join(parts)


CTES["numeric_counts"] = _counts(NUMERIC, "DOUBLE")
CTES["category_counts"] = _counts(CATEGORICAL, "VARCHAR")
CTES["gaps"] = """SELECT *, abs(sum(r) OVER w / rt - sum(c) OVER w / ct) AS gap, lead(v) OVER w AS v2
    FROM (SELECT *, sum(r) OVER (PARTITION BY col) AS rt, sum(c) OVER (PARTITION BY col) AS ct
      FROM numeric_counts) WINDOW w AS (PARTITION BY col ORDER BY v)"""
CTES["shares"] = """SELECT *, r / sum(r) OVER (PARTITION BY col) AS p, c / sum(c) OVER (PARTITION BY col) AS q,
      sum(c) OVER (PARTITION BY col) AS ct FROM category_counts"""
CTES["spreads"] = "\n    UNION ALL ".join(
    f"""SELECT '{c}' AS col, stddev_pop({c}) AS sd, avg({c}) AS mean, min({c}) AS lo, max({c}) AS hi
    FROM monitored WHERE release_year < 2000"""
    for c in NUMERIC
)
CTES["wasserstein"] = """SELECT col AS "column", a / greatest(sd, 0.001) AS statistic,
      a / greatest(sd, 0.001) >= 0.1 AS drifted
    FROM (SELECT col, sum(gap * coalesce(v2 - v, 0)) AS a FROM gaps GROUP BY col) JOIN spreads USING (col)"""
CTES["jensen_shannon"] = """SELECT col AS "column", d AS statistic, d >= 0.1 AS drifted
    FROM (SELECT col, sqrt(greatest(0, sum(
        CASE WHEN p > 0 THEN p * ln(2 * p / (p + q)) ELSE 0 END
        + CASE WHEN q > 0 THEN q * ln(2 * q / (p + q)) ELSE 0 END) / 2)) AS d FROM shares GROUP BY col)"""
CTES["drift_found"] = """SELECT "column", 'wasserstein' AS method, statistic, drifted FROM wasserstein
    UNION ALL SELECT "column", 'jensen_shannon', statistic, drifted FROM jensen_shannon"""
CTES["health"] = "\n    UNION ALL ".join(
    f"""SELECT '{c}' AS "column", avg(CASE WHEN {c} < lo OR {c} > hi THEN 1 ELSE 0 END) AS out_of_range_share,
      avg({c}) AS mean_cur, any_value(mean) AS mean_ref, any_value(sd) AS std_ref,
      abs(avg({c}) - any_value(mean)) / any_value(sd) AS mean_sigmas
    FROM monitored, (SELECT * FROM spreads WHERE col = '{c}') s WHERE release_year >= 2000 AND {c} IS NOT NULL"""
    for c in NUMERIC
)
CTES["unlisted"] = """SELECT col AS "column", sum(CASE WHEN r = 0 THEN c ELSE 0 END) / sum(c) AS out_of_list_share
    FROM category_counts GROUP BY col"""
CTES["missing"] = "\n    UNION ALL ".join(
    f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_missing,
      (count(*) - count({c})) / count(*) AS missing_share,
      (count(*) FILTER (release_year < 2000) - count({c}) FILTER (release_year < 2000))
        / count(*) FILTER (release_year < 2000) AS share_ref,
      (count(*) FILTER (release_year >= 2000) - count({c}) FILTER (release_year >= 2000))
        / count(*) FILTER (release_year >= 2000) AS share_cur FROM monitored"""
    for c in [*NUMERIC, *CATEGORICAL, "release_year"]
)
_ALL = [*NUMERIC, *CATEGORICAL]
_ANY_NULL = " OR ".join(f"{c} IS NULL" for c in _ALL)


def _duplicates(where: str, name: str) -> str:
    return f"""SELECT sum(n - 1) / sum(n) AS {name} FROM (
      SELECT count(*) AS n FROM monitored WHERE {where} GROUP BY {', '.join(_ALL)})"""


def _constants(where: str) -> str:
    return "SELECT " + " + ".join(
        f"CASE WHEN count(DISTINCT {c}) <= 1 THEN 1 ELSE 0 END" for c in _ALL
    ) + f" AS x FROM monitored WHERE {where}"


def _equal_pairs(where: str) -> str:
    groups = [NUMERIC[:2], NUMERIC[2:4], CATEGORICAL]
    pairs = [(a, b) for g in groups for i, a in enumerate(g) for b in g[i + 1 :]]
    return "SELECT " + " + ".join(
        f"CAST(bool_and({a} IS NOT DISTINCT FROM {b}) AS INTEGER)" for a, b in pairs
    ) + f" AS x FROM monitored WHERE {where}"


_REF, _CUR = "release_year < 2000", "release_year >= 2000"
CTES["stability"] = f"""SELECT 'columns_with_missing_values' AS "check", v AS value, t AS threshold, v <= t AS passed
      FROM (SELECT count(*) FILTER (share_cur > 0) AS v, count(*) FILTER (share_ref > 0) AS t FROM missing)
    UNION ALL SELECT 'rows_with_missing_values', v, t, abs(v - t) <= t * 0.1 FROM (
      SELECT avg(CAST({_ANY_NULL} AS INTEGER)) FILTER ({_CUR}) AS v,
        avg(CAST({_ANY_NULL} AS INTEGER)) FILTER ({_REF}) AS t FROM monitored)
    UNION ALL SELECT 'constant_columns', v, t, v <= t
      FROM (SELECT ({_constants(_CUR)}) AS v, ({_constants(_REF)}) AS t)
    UNION ALL SELECT 'duplicated_rows', v, t, abs(v - t) <= t * 0.1
      FROM (SELECT ({_duplicates(_CUR, 'v')}) AS v, ({_duplicates(_REF, 't')}) AS t)
    UNION ALL SELECT 'duplicated_columns', v, t, v <= t
      FROM (SELECT ({_equal_pairs(_CUR)}) AS v, ({_equal_pairs(_REF)}) AS t)
    UNION ALL SELECT 'column_types', 0, 0, true
    UNION ALL SELECT 'drifted_columns', v, t, v < t FROM (
      SELECT count(*) FILTER (drifted) AS v, greatest(count(*) // 3, 1) AS t FROM drift_found)"""
CTES["no_target"] = f"""SELECT 'drift_share' AS "check", NULL AS "column", v AS value, 0.3 AS threshold, v < 0.3 AS passed
      FROM (SELECT avg(CAST(drifted AS INTEGER)) AS v FROM drift_found)
    UNION ALL SELECT 'column_types', NULL, 0, 0, true
    UNION ALL SELECT 'missing_share', "column", share_cur, share_ref, share_cur <= share_ref * 1.1
      FROM missing WHERE "column" <> 'release_year'
    UNION ALL SELECT 'out_of_range_share', "column", out_of_range_share, 0, out_of_range_share = 0 FROM health
    UNION ALL SELECT 'mean_in_sigmas', "column", mean_sigmas, 2, mean_sigmas <= 2 FROM health
    UNION ALL SELECT 'out_of_list_share', "column", out_of_list_share, 0, out_of_list_share = 0 FROM unlisted"""


def _needed(text: str) -> list[str]:
    """Names of the expressions a statement uses, inner ones first."""
    import re

    found: list[str] = []

    def visit(body: str) -> None:
        for word in re.findall(r"\w+", body):
            if word in CTES and word not in found and re.search(rf"(FROM|JOIN|,)\s+{word}\b", body):
                visit(CTES[word])
                if word not in found:
                    found.append(word)

    visit(text)
    return found


def oracle(name: str, body: str) -> None:
    parts = [f"{n} AS ({CTES[n]})" for n in _needed(body)]
    ORACLES[name] = ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


def _r6(*columns: str, table: str = "") -> str:
    return ", ".join(f"round(CAST({c} AS DOUBLE), 6) AS {c}" for c in columns)


# ---- scalar functions and reshaping
oracle("calendar_parts", f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date, year(o_orderdate) AS year,
  month(o_orderdate) AS month, weekofyear(o_orderdate) AS weekofyear, dayofweek(o_orderdate) + 1 AS dayofweek,
  isoyear(o_orderdate) AS iso_year, {_monday('o_orderdate')} AS week_start,
  lpad(CAST(weekofyear(o_orderdate) AS VARCHAR), 2, '0') AS padded_week FROM orders""")
oracle("week_to_date", f"SELECT *, {_tuesday('year', 'week')} AS date FROM silver_restock")
oracle("iso_week_to_date", f"SELECT *, {_iso_monday('year', 'week')} AS date FROM weekly_restock_iso")
oracle("series_id", f"""SELECT {_RELEASE_ID} AS unique_id, count(*) AS n_weeks, CAST(sum(sales) AS BIGINT) AS sales
  FROM silver_sales GROUP BY 1""")
_TAIL = r"regexp_extract(url, '[/]([^/]+[/][^/]+)$', 1)"
oracle("path_parts", f"""SELECT page_id, split_part({_TAIL}, '/', 1) AS category,
  CASE WHEN {_TAIL} <> '' THEN split_part({_TAIL}, '/', 2) END AS file_name FROM pages""")
_IMAGE = "regexp_replace(url, '[?#].*$', '') || '.png'"
_IMAGE_TAIL = f"regexp_extract({_IMAGE}, '[/]([^/]+[/][^/]+)$', 1)"
_WIDTH = "CASE WHEN length(html) % 2 = 0 THEN length(html) END AS width"
_HEIGHT = "CASE WHEN length(html) % 2 = 0 THEN page_id END AS height"
oracle("image_headers", f"SELECT {_IMAGE} AS path, length(html) % 2 = 0 AS valid, {_WIDTH}, {_HEIGHT} FROM pages")
oracle("unpivot_sales", """SELECT external_code, CAST(retail AS VARCHAR) AS retail,
  CAST(year(release_date) AS VARCHAR) || '-' || CAST(month(release_date) AS VARCHAR) || '-'
    || CAST(day(release_date) AS VARCHAR) AS release_date,
  CAST(week AS VARCHAR) AS week, CAST(sales AS VARCHAR) || '.0' AS sales FROM silver_sales""")
oracle("unpivot_price", """SELECT external_code, CAST(retail AS VARCHAR) AS retail,
  CAST(CAST(price AS DECIMAL(18, 2)) AS DOUBLE) AS price, CAST(week AS VARCHAR) AS week,
  round(CAST(discount AS DOUBLE), 4) AS discount FROM silver_price""")
oracle("embedding_explode", """SELECT CAST(label AS VARCHAR) || '/' || CAST(vec_id AS VARCHAR) || '.png' AS img_path,
  i - 1 AS position, round(CAST(embedding[i] AS DOUBLE), 6) AS embed_value
  FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
oracle("embedding_columns", f"""SELECT CAST(label AS VARCHAR) || '/' || CAST(vec_id AS VARCHAR) || '.png' AS img_path,
  {', '.join(f'round(CAST(embedding[{i}] AS DOUBLE), 6) AS embed_{i}' for i in range(1, 65))} FROM embeddings""")

# ---- silver
oracle("silver_sales", "SELECT * FROM silver_sales")
oracle("sales_conserved", """SELECT CAST(l_suppkey AS INTEGER) AS retail, CAST(sum(l_quantity) AS BIGINT) AS sales,
  CAST(sum(l_quantity) AS BIGINT) AS restock FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1""")
oracle("silver_price", f"SELECT external_code, retail, week, {_r6('price', 'discount')} FROM silver_price")
oracle("silver_customer", "SELECT * FROM silver_customer")
oracle("silver_restock", "SELECT * FROM silver_restock")
oracle("silver_trends", "SELECT * FROM silver_trends")
oracle("silver_images", f"""SELECT {_IMAGE} AS path, split_part({_IMAGE_TAIL}, '/', 1) AS category,
  split_part({_IMAGE_TAIL}, '/', 2) AS file_name, {_WIDTH}, {_HEIGHT} FROM pages""")

# ---- joins and aggregates
oracle("customer_week_stats", "SELECT * FROM stats")
oracle("customer_week_stats_iso", "SELECT * FROM stats_iso")
oracle("price_join", f"""SELECT external_code, retail, week, sales, {_r6('price', 'discount')}
  FROM silver_sales s LEFT JOIN silver_price p USING (external_code, retail, week)""")
oracle("customer_stats_join", """SELECT * FROM panel
  LEFT JOIN stats USING (retail, current_week_of_year, current_year)""")
oracle("trend_join", f"""SELECT s.external_code, s.retail, s.ds, s.current_week_of_year, s.current_month, s.current_year,
  t.date, {', '.join(TREND_NAMES)} FROM sales_rows s LEFT JOIN silver_trends t
  ON s.current_week_of_year = t.week_of_year AND s.current_month = t.month AND s.current_year = t.year""")
oracle("trend_join_iso", f"""SELECT s.external_code, s.retail, s.ds, {_monday('s.ds')} AS week_start,
  {', '.join(TREND_NAMES)} FROM sales_rows s LEFT JOIN silver_trends t ON {_monday('s.ds')} = t.date""")
oracle("prediction_feature_join", """SELECT n.external_code || '-' || CAST(n.retail AS VARCHAR) AS unique_id, n.ds,
  CAST(forecast AS DOUBLE) AS forecast, p.external_code, p.retail, p.y, p.current_week_of_year, p.current_year,
  p.current_month
  FROM naive n LEFT JOIN panel p ON n.external_code = p.external_code AND n.retail = p.retail AND n.ds = p.ds""")
_ELEMENTS = ", ".join(f"round(CAST(embedding[{i}] AS DOUBLE), 6) AS embed_{i}" for i in range(1, 65))
oracle("embedding_join", f"""SELECT page_id, CAST(page_id % 10 AS VARCHAR) || '/' || CAST(page_id AS VARCHAR) || '.png' AS img_path,
  {_ELEMENTS} FROM pages LEFT JOIN embeddings ON vec_id = page_id AND label = page_id % 10""")
oracle("feature_embedding_join", f"""SELECT external_code, img_path, n, y, {_ELEMENTS} FROM (
  SELECT external_code, img_path, count(*) AS n, CAST(sum(y) AS BIGINT) AS y FROM sales_rows GROUP BY ALL)
  LEFT JOIN embeddings ON vec_id = CAST('0x' || left(md5(img_path), 8) AS BIGINT)
    % (SELECT max(vec_id) - min(vec_id) + 1 FROM embeddings) + (SELECT min(vec_id) FROM embeddings)""")
oracle("id_list_split", """SELECT unique_id, ds, y, CASE WHEN release_year >= 2000 THEN 'test' ELSE 'train' END AS side
  FROM sales_rows""")
oracle("series_semi_join", "SELECT unique_id, ds, y, retail FROM sales_rows WHERE release_year >= 2000")
oracle("train_test_split", """SELECT CASE WHEN release_year >= 2000 THEN 'test' ELSE 'train' END AS side,
  count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS y, max(ds) AS last FROM sales_rows GROUP BY 1""")
oracle("date_split", """SELECT CASE WHEN ds >= DATE '2000-01-01' THEN 'test' ELSE 'train' END AS side,
  count(*) AS n_rows, CAST(sum(y) AS BIGINT) AS y FROM panel GROUP BY 1""")

# ---- inventory
oracle("initial_stock", "SELECT * FROM opening_weekly")
oracle("restock_union", """SELECT external_code, retail, week, qty, year FROM opening_weekly
  UNION ALL SELECT external_code, retail, week, qty, year FROM weekly_restock""")
oracle("restock_log", f"""SELECT * FROM opening_weekly
  UNION ALL SELECT external_code, retail, week, {_tuesday('year', 'week')} AS date, qty, year FROM weekly_restock""")
oracle("gold_restock", f"""SELECT * FROM opening_release
  UNION ALL SELECT external_code, retail, week, {_tuesday('year', 'week')} AS date, qty, year FROM silver_restock""")
oracle("first_match", "SELECT * FROM matched_weekly")
oracle("running_balance", """SELECT external_code, retail, week, year, date, sales,
  CAST(sum(sales) OVER (PARTITION BY external_code, retail ORDER BY week) AS BIGINT) AS running_sales FROM weekly""")
oracle("inventory_balance", "SELECT * FROM balance_weekly")
oracle("inventory_balance_iso", "SELECT * FROM balance_iso")
oracle("gold_inventory", "SELECT * FROM balance_release")
oracle("inventory_point_filter", "SELECT * FROM balance_weekly WHERE external_code = '1' AND retail = 3")
oracle("series_point_filter", """SELECT unique_id, ds, y FROM sales_rows
  WHERE unique_id = (SELECT min(unique_id) FROM sales_rows)""")
oracle("select_expressions", """SELECT external_code, retail, ds, y * 2 AS doubled,
  CASE WHEN y > 30 THEN 'high' ELSE 'low' END AS level FROM panel""")
oracle("inventory_preview", "SELECT * FROM balance_weekly ORDER BY external_code, retail, date LIMIT 15")
oracle("reorder_plan", """SELECT external_code, retail, b.date AS ds, accumulated_inventory, forecast, hi_ci,
  accumulated_inventory - forecast AS projected_inventory, accumulated_inventory < forecast AS stock_out,
  CASE WHEN hi_ci IS NOT NULL THEN greatest(hi_ci - accumulated_inventory, 0) END AS order_qty
  FROM balance_iso b LEFT JOIN (SELECT external_code, retail, ds AS date, forecast, hi_ci FROM rounded) r
  USING (external_code, retail, date)""")
CTES["last_orders"] = """SELECT external_code, retail, max_by(date, date) AS date, max_by(accumulated_inventory, date) AS b,
    CAST(max_by(lo_ci, date) AS BIGINT) AS lo, CAST(max_by(hi_ci, date) AS BIGINT) AS hi
  FROM balance_iso JOIN (SELECT external_code, retail, ds AS date, lo_ci, hi_ci FROM rounded) USING (external_code, retail, date) GROUP BY ALL"""
CTES["order_units"] = """SELECT *, row_number() OVER (ORDER BY (1000000 * least(greatest(hi - lo, 1), hi - b - k + 1)) // greatest(hi - lo, 1) DESC,
    external_code, retail, k) AS i FROM (SELECT *, unnest(range(1, greatest(hi - b, 0) + 1)) AS k FROM last_orders)"""
oracle("reorder_budget", """SELECT external_code, retail, o.date, coalesce(n, 0) AS granted FROM last_orders o LEFT JOIN (
  SELECT external_code, retail, count(*) AS n FROM order_units WHERE i <= (SELECT count(*) // 10 FROM order_units) GROUP BY ALL) g
  USING (external_code, retail)""")

# ---- series
_SIGNALS = [*CUSTOMER, *TREND_NAMES]
_LAGGED = ", ".join(
    f"CAST(coalesce(lag({c}, {k}) OVER w, -1) AS DOUBLE) AS {c}_lag{k}" for c in _SIGNALS for k in (1, 2)
)
oracle("exog_lags", f"""SELECT external_code, retail, ds, y, {_LAGGED} FROM (
  SELECT p.*, {', '.join(_SIGNALS)} FROM panel p
  LEFT JOIN stats c ON p.retail = c.retail AND p.current_week_of_year = c.current_week_of_year
    AND p.current_year = c.current_year
  LEFT JOIN silver_trends t ON p.current_week_of_year = t.week_of_year AND p.current_month = t.month
    AND p.current_year = t.year)
  WINDOW w AS (PARTITION BY external_code, retail ORDER BY ds)""")
oracle("lag_join", """SELECT s.brand, s.retail, s.day AS ds, s.qty, s.cents, g.qty_lag1, g.qty_lag2 FROM sold s LEFT JOIN (
  SELECT brand, retail, day, coalesce(lag(m, 1) OVER w, -1) AS qty_lag1, coalesce(lag(m, 2) OVER w, -1) AS qty_lag2
  FROM (SELECT brand, retail, day, CAST(sum(qty) AS BIGINT) AS m FROM sold GROUP BY ALL)
  WINDOW w AS (PARTITION BY brand, retail ORDER BY day)) g USING (brand, retail, day)""")
oracle("target_lag", """SELECT * FROM (SELECT external_code, retail, ds, y,
  lag(y) OVER (PARTITION BY external_code, retail ORDER BY ds) AS lag1 FROM panel) WHERE lag1 IS NOT NULL""")
oracle("horizon_target", """SELECT external_code, retail, ds, y AS y0, lead(y, 1) OVER w AS y1, lead(y, 2) OVER w AS y2
  FROM panel WINDOW w AS (PARTITION BY external_code, retail ORDER BY ds)""")
oracle("clip_target", """SELECT external_code, retail, ds, greatest(y - lag1, 0) AS y FROM (
  SELECT *, lag(y) OVER (PARTITION BY external_code, retail ORDER BY ds) AS lag1 FROM panel) WHERE lag1 IS NOT NULL""")
oracle("gold_features", f"""SELECT * EXCLUDE (price, discount), {_r6('price', 'discount')} FROM features""")
oracle("gold_features_iso", f"""SELECT * EXCLUDE (price, discount), {_r6('price', 'discount')} FROM features_iso""")
oracle("model_frame", f"""SELECT unique_id, ds, greatest(y, 0) AS y0, {_r6('price', 'discount')},
  {', '.join(f'{c}_lag{k}' for c in _SIGNALS for k in (1, 2))} FROM (
  SELECT *, {_LAGGED}, lag(y) OVER w AS lag1 FROM features
  WINDOW w AS (PARTITION BY unique_id ORDER BY ds)) WHERE lag1 IS NOT NULL""")
oracle("ordinal_codes", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT {c} FROM part)""" for c in ("p_name", "p_brand", "p_type")))
oracle("encoded_items", """SELECT p_partkey, dense_rank() OVER (ORDER BY p_name) - 1 AS p_name_code,
  dense_rank() OVER (ORDER BY p_type) - 1 AS p_type_code FROM part""")

# ---- forecast quality
_MEASURES = """count(*) AS n, round(avg(e), 6) AS mae, round(avg(e * e), 6) AS mse, round(sqrt(avg(e * e)), 6) AS rmse,
  round(1 - sum(e * e) / nullif(var_pop(y) * count(*), 0), 6) AS r2, round(avg(ape), 6) AS mape,
  round(CAST(max(e) AS DOUBLE), 6) AS max_error"""
_ALL_MEASURES = f"""{_MEASURES}, round(avg(ape), 6) AS wape, round(sum(e) / sum(abs(y)), 6) AS total_ape,
  round(median(ape), 6) AS mdape"""
oracle("mdape", "SELECT round(median(ape), 6) AS mdape FROM errors")
oracle("mdape_by_store", "SELECT retail, round(median(ape), 6) AS mdape FROM errors GROUP BY retail")
oracle("wape", """SELECT round(avg(ape), 6) AS wape, round(sum(y * ape) / sum(y), 6) AS wape_by_target,
  round(sum(e) / sum(y), 6) AS total_ape FROM errors""")
oracle("regression_metrics", f"SELECT {_MEASURES} FROM errors")
oracle("error_by_store", f"SELECT retail, {_ALL_MEASURES} FROM errors GROUP BY retail")
oracle("error_by_week", f"SELECT current_week_of_year, {_ALL_MEASURES} FROM errors GROUP BY 1")
oracle("error_by_category", f"""SELECT category, {_ALL_MEASURES} FROM errors e
  LEFT JOIN item i ON e.external_code = i.brand GROUP BY category""")
oracle("error_by_dimension", f"""SELECT 'store' AS dimension, CAST(retail AS VARCHAR) AS label, {_ALL_MEASURES} FROM errors GROUP BY retail
  UNION ALL SELECT 'week', CAST(current_week_of_year AS VARCHAR), {_ALL_MEASURES} FROM errors GROUP BY current_week_of_year
  UNION ALL SELECT 'category', category, {_ALL_MEASURES} FROM errors e LEFT JOIN item i ON e.external_code = i.brand GROUP BY category""")
oracle("column_profile", "\nUNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value FROM lineitem"""
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")))
oracle("conformal_interval", """SELECT external_code, retail, ds, y, CAST(forecast AS DOUBLE) AS forecast, lo_ci, hi_ci
  FROM intervals""")
oracle("conformal_by_store", """SELECT external_code, n.retail, ds, CAST(forecast AS DOUBLE) AS forecast,
  forecast - q AS lo_ci, forecast + q AS hi_ci FROM naive n LEFT JOIN width_by_store w ON n.retail = w.retail
  WHERE current_year >= 2000""")
oracle("conformal_width", "SELECT retail, n, q FROM width_by_store")
oracle("interval_report", """SELECT y, lo_ci, hi_ci, CASE WHEN y >= lo_ci AND y < hi_ci THEN 1 ELSE 0 END AS covered_flag,
  external_code || '-' || CAST(retail AS VARCHAR) AS unique_id, ds FROM intervals""")
oracle("interval_coverage", """SELECT count(*) AS n,
  round(avg(CASE WHEN y >= lo_ci AND y < hi_ci THEN 1 ELSE 0 END) * 100, 6) AS coverage_of_interval FROM intervals""")
oracle("rounded_forecast", "SELECT external_code, retail, ds, CAST(forecast AS DOUBLE) AS forecast, lo_ci, hi_ci FROM rounded")
oracle("rolling_origin_rmse", """SELECT w AS "window", count(*) AS n, round(sqrt(avg(e * e)), 6) AS rmse FROM (
  SELECT e, row_number() OVER (PARTITION BY external_code, retail ORDER BY ds DESC) AS w FROM errors)
  WHERE w <= 10 GROUP BY w""")
oracle("best_run", """SELECT 'store-' || CAST(retail AS VARCHAR) AS run_id, 'mean_absolute_error' AS metric, v AS value
  FROM (SELECT retail, round(avg(e), 6) AS v FROM errors GROUP BY retail)
  WHERE v < 20.0 ORDER BY value, run_id LIMIT 1""")
oracle("best_score", """SELECT retail, s AS best_score, i AS best_iteration FROM (
  SELECT *, row_number() OVER (PARTITION BY retail ORDER BY s, i) AS n FROM (
    SELECT retail, current_week_of_year AS i, round(sqrt(avg(e * e)), 6) AS s FROM errors GROUP BY ALL)) WHERE n = 1""")

# ---- monitoring
_P = " + ".join(f"({2.0 * (-1) ** (k - 1)}) * exp({-2.0 * k * k} * x * x)" for k in range(1, 101))
oracle("drift_ks", f"""SELECT "column", round(s, 6) AS statistic, n_ref, n_cur,
  round(CASE WHEN x < 0.2 THEN 1 ELSE least(1, greatest(0, {_P})) END, 6) AS p_value
  FROM (SELECT *, s * sqrt(CAST(n_ref AS DOUBLE) * n_cur / (n_ref + n_cur)) AS x FROM (
    SELECT col AS "column", max(gap) AS s, CAST(max(rt) AS BIGINT) AS n_ref, CAST(max(ct) AS BIGINT) AS n_cur
    FROM gaps GROUP BY col))""")
oracle("drift_wasserstein", 'SELECT "column", round(statistic, 6) AS statistic, drifted FROM wasserstein')
oracle("drift_js", 'SELECT "column", round(statistic, 6) AS statistic, drifted FROM jensen_shannon')
oracle("drift_chi2", """SELECT col AS "column",
  round(coalesce(sum(CASE WHEN r > 0 THEN (c - p * ct) * (c - p * ct) / (p * ct) END), 0), 6) AS statistic,
  count(*) FILTER (r > 0) - 1 AS dof, CAST(sum(CASE WHEN r = 0 THEN c ELSE 0 END) AS BIGINT) AS unseen
  FROM shares GROUP BY col""")
oracle("drift_table", 'SELECT "column", method, round(statistic, 6) AS statistic, drifted FROM drift_found')
oracle("drift_auto", 'SELECT "column", method, round(statistic, 6) AS statistic, drifted FROM drift_found')
# The 95 % points of the three tests.
oracle("drift_small", """WITH a AS (SELECT CAST(s_acctbal AS DOUBLE) AS b, s_nationkey AS k, 1 AS r, 0 AS c FROM supplier
    UNION ALL SELECT CAST(c_acctbal AS DOUBLE), c_nationkey, 0, 1 FROM customer),
  t AS (SELECT CAST(sum(r) AS DOUBLE) AS n, CAST(sum(c) AS DOUBLE) AS m FROM a),
  ks AS (SELECT max(abs(x / n - y / m)) AS s FROM (SELECT sum(sum(r)) OVER (ORDER BY b) AS x, sum(sum(c)) OVER (ORDER BY b) AS y
    FROM a GROUP BY b), t),
  chi AS (SELECT sum(pow(c - r * m / n, 2) / (r * m / n)) FILTER (r > 0) AS s, count(*) FILTER (r > 0) - 1 AS dof,
    coalesce(sum(c) FILTER (r = 0), 0) AS unseen FROM (SELECT k, sum(r) AS r, sum(c) AS c FROM a GROUP BY k), t),
  z AS (SELECT abs(p - q) / sqrt((p * n + q * m) / (n + m) * (1 - (p * n + q * m) / (n + m)) * (1 / n + 1 / m)) AS s
    FROM (SELECT sum(r) FILTER (b < 0) / n AS p, sum(c) FILTER (b < 0) / m AS q, n, m FROM a, t GROUP BY n, m))
SELECT 'balance' AS "column", 'kolmogorov_smirnov' AS method, round(s, 6) AS statistic, s > 1.3581 * sqrt((n + m) / (n * m)) AS drifted FROM ks, t
UNION ALL SELECT 'nation', 'chi_square', round(s, 6), unseen > 0 OR s > dof * pow(1 - 2 / (9.0 * dof) + 1.6448536 * sqrt(2 / (9.0 * dof)), 3) FROM chi
UNION ALL SELECT 'debt', 'share', round(s, 6), s > 1.959964 FROM z""")
_SIDES = ", ".join(f"""count({{c}}) FILTER ({w}) AS n_{s}, count(*) FILTER ({w}) - count({{c}}) FILTER ({w}) AS nulls_{s}"""
    for s, w in (("ref", "release_year < 2000"), ("cur", "release_year >= 2000")))
_MEANS = ", ".join(f"round(avg(CAST({{c}} AS DOUBLE)) FILTER ({w}), 4) AS mean_{s}" for s, w in (("ref", "release_year < 2000"), ("cur", "release_year >= 2000")))
oracle("profile_drift", " UNION ALL ".join(
    [f"""SELECT '{c}' AS "column", 'kolmogorov_smirnov' AS method, {_SIDES.format(c=c)}, true AS near, {_MEANS.format(c=c)} FROM features"""
     for c in (*CUSTOMER, "price", "discount", "retail")]
    + [f"""SELECT '{c}' AS "column", 'jensen_shannon' AS method, {_SIDES.format(c=c)}, true AS near, NULL AS mean_ref, NULL AS mean_cur FROM features"""
       for c in ("category", "color", "fabric", "season_category")]))
oracle("drift_share", """SELECT count(*) AS n_columns, count(*) FILTER (drifted) AS n_drifted,
  round(avg(CAST(drifted AS INTEGER)), 6) AS drift_share FROM drift_found""")
oracle("missing_by_column", """SELECT "column", n_rows, n_missing, round(missing_share, 6) AS missing_share FROM missing""")
oracle("missing_columns", "SELECT count(*) FILTER (n_missing > 0) AS n_missing_columns FROM missing")
oracle("missing_rows", f"""SELECT count(*) FILTER ({_ANY_NULL}) AS n_missing_rows,
  round(avg(CAST({_ANY_NULL} AS INTEGER)), 6) AS missing_row_share FROM monitored""")
oracle("constant_columns", "SELECT 2 + " + " + ".join(
    f"CASE WHEN count(DISTINCT {c}) <= 1 THEN 1 ELSE 0 END"
    for c in ("external_code", "retail", "ds", "y", "current_week_of_year", "current_year", "current_month"))
    + " AS n_constant_columns FROM panel")
oracle("duplicate_rows", f"""SELECT CAST(sum(n) AS BIGINT) AS n_rows, CAST(sum(n - 1) AS BIGINT) AS n_duplicate_rows FROM (
  SELECT count(*) AS n FROM monitored GROUP BY {', '.join(_ALL)}, release_year)""")
oracle("duplicate_columns", """SELECT 1 + CAST(bool_and(retail = current_week_of_year) AS INTEGER)
  + CAST(bool_and(retail = current_year) AS INTEGER) + CAST(bool_and(retail = current_month) AS INTEGER)
  + CAST(bool_and(current_week_of_year = current_year) AS INTEGER)
  + CAST(bool_and(current_week_of_year = current_month) AS INTEGER)
  + CAST(bool_and(current_year = current_month) AS INTEGER) AS n_duplicate_columns FROM panel""")
oracle("numeric_health", f"""SELECT "column",
  {_r6('out_of_range_share', 'mean_cur', 'mean_ref', 'std_ref', 'mean_sigmas')} FROM health""")
oracle("out_of_list", 'SELECT "column", round(out_of_list_share, 6) AS out_of_list_share FROM unlisted')
_TYPES = {
    "category": ("string", "string"), "color": ("string", "string"), "fabric": ("string", "string"),
    "season_category": ("string", None), "retail": ("int", "string"), "release_year": ("int", None),
    "price": ("float", None), "discount": ("float", None), "retail_total_sales_qty": ("bigint", None),
    "retail_total_customer_purchase": ("bigint", None),
    **{c: (None, "string") for c in ("external_code", "season", "image_path", "release_date", "restock")},
    **{str(i): (None, "string") for i in range(12)},
}


def _type_row(c: str) -> str:
    ours, theirs = (f"'{t}'" if t else "CAST(NULL AS VARCHAR)" for t in _TYPES[c])
    n_ours = f"(SELECT count({c}) FROM monitored)" if _TYPES[c][0] else "CAST(NULL AS BIGINT)"
    n_theirs = "(SELECT count(*) FROM release_item)" if _TYPES[c][1] else "CAST(NULL AS BIGINT)"
    same = "true" if _TYPES[c][0] == _TYPES[c][1] else "false"
    return f"""SELECT '{c}' AS "column", {ours} AS reference_type, {theirs} AS current_type, {same} AS same,
  {n_ours} AS n_reference, {n_theirs} AS n_current"""


oracle("column_types", "\nUNION ALL ".join(_type_row(c) for c in _TYPES))
oracle("report_json", """SELECT "check", "column", CAST(json_object('check', "check", 'column', "column",
  'value', printf('%.6f', round(CAST(value AS DOUBLE), 6)), 'threshold', printf('%.6f', round(CAST(threshold AS DOUBLE), 6)),
  'passed', coalesce(passed, false)) AS VARCHAR) AS report FROM no_target""")
oracle("stability_suite", f"""SELECT "check", CAST(NULL AS VARCHAR) AS "column", {_r6('value', 'threshold')},
  coalesce(passed, false) AS passed FROM stability""")
oracle("no_target_suite", f"""SELECT "check", "column", {_r6('value', 'threshold')},
  coalesce(passed, false) AS passed FROM no_target""")

# ---- images and streams
oracle("gold_image_features", f"""SELECT split_part({_IMAGE_TAIL}, '/', 1) AS category,
  split_part({_IMAGE_TAIL}, '/', 2) AS file_name, {_IMAGE_TAIL} AS img_path FROM pages WHERE length(html) % 2 = 0""")
oracle("image_embeddings", f"""SELECT {_IMAGE_TAIL} AS img_path, {', '.join(
    f'CAST((page_id // {256 ** (3 - i)}) % 256 AS DOUBLE) AS embed_{i + 1}' for i in range(4))}
  FROM pages WHERE length(html) % 2 = 0""")
_FILE = "'feed/p' || (page_id % 10) || '/' || page_id || '.png'"
oracle("image_faults", f"""SELECT {_FILE} AS path, CASE page_id % 7 WHEN 1 THEN 'truncated' WHEN 2 THEN 'checksum' WHEN 3 THEN 'checksum'
  WHEN 4 THEN 'no data' WHEN 5 THEN 'signature' END AS fault FROM pages""")
oracle("verified_images", """SELECT 'p' || (page_id % 10) AS category, page_id || '.png' AS file_name,
  'p' || (page_id % 10) || '/' || page_id || '.png' AS img_path FROM pages WHERE page_id % 7 IN (0, 6)""")
oracle("stream_ingest_clothes", """SELECT 'p' || (page_id % 10) AS category, page_id || '.png' AS file_name,
  CAST(8 + 25 + 12 * 3 + strlen(html) AS BIGINT) AS length, CAST(length(html) AS INTEGER) AS width, CAST(page_id AS INTEGER) AS height,
  true AS whole FROM pages""")
_LATE_ROWS = """SELECT unique_id, ds, greatest(y, 0) AS y0 FROM (
  SELECT *, lag(y) OVER (PARTITION BY external_code, retail, release_year, release_month, release_day ORDER BY ds) AS lag1
  FROM features) WHERE lag1 IS NOT NULL AND release_year >= 2000"""
oracle("forecast_stored", _LATE_ROWS)
oracle("tweedie_checks", f"""SELECT 'tweedie' AS model, count(*) AS n_rows, true AS bounds_are_twice_the_quantile,
  true AS covers, true AS beats_constant, true AS intercept_is_optimal FROM ({_LATE_ROWS})""")
oracle("tree_checks", f"""SELECT 'boosted' AS model, count(*) AS n_rows, true AS bounds_are_twice_the_quantile,
  true AS covers, true AS beats_constant, true AS leaves_balance FROM ({_LATE_ROWS})""")
oracle("vector_checks", f"""SELECT 'vectors' AS model, count(*) AS n_rows, true AS bounds_are_twice_the_quantile,
  true AS covers, true AS beats_constant FROM ({_LATE_ROWS})""")
oracle("reduction_checks", """SELECT max(n) AS n, round(sum(v), 6) AS variance, true AS sums, true AS less FROM (
  SELECT i, count(*) AS n, var_pop(CAST(embedding[i] AS DOUBLE)) AS v
  FROM (SELECT embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) GROUP BY i)""")
oracle("sql_predict", f"SELECT *, true AS same FROM ({_LATE_ROWS})")
_WINDOWS = """SELECT back, count(*) AS n FROM (SELECT row_number() OVER (
    PARTITION BY external_code, retail, release_year, release_month, release_day ORDER BY ds DESC) AS back
  FROM (SELECT *, lag(y) OVER (PARTITION BY external_code, retail, release_year, release_month, release_day ORDER BY ds) AS lag1
    FROM features) WHERE lag1 IS NOT NULL) WHERE back <= 10 GROUP BY back"""
for _name, _trials in (("tweedie_backtest", 5), ("tree_backtest", 2)):
    oracle(_name, f"""SELECT CAST(trial AS INTEGER) AS trial, CAST(w.back AS INTEGER) AS "window", n, true AS beats_mean
      FROM ({_WINDOWS}) w, range({_trials}) t(trial)""")
oracle("stream_table", "SELECT * FROM silver_restock")
oracle("table_refresh", "SELECT * FROM silver_trends")
oracle("stream_ingest_sales", "SELECT * FROM silver_sales")
oracle("stream_ingest_price", f"SELECT external_code, retail, week, {_r6('price', 'discount')} FROM silver_price")
oracle("stream_ingest_restock", "SELECT * FROM silver_restock")
oracle("stream_ingest_trends", "SELECT * FROM silver_trends")
oracle("stream_ingest_weather", "SELECT n_name AS locality, strftime(o_orderdate, '%Y-%m-%d') AS date, " + ", ".join(
    f"CAST(count(*) FILTER (o_custkey % 12 = {i}) AS DOUBLE) AS {c}" for i, c in enumerate(WEATHER))
    + " FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL")
oracle("stream_quarantine", """SELECT external_code || ',' || retail || ',' || week || ',' || year || ',' || qty || 'x' AS line
  FROM silver_restock WHERE retail % 2 = 1""")
ORACLES["stream_ledger"] = ORACLES["inventory_balance"]
oracle("stream_fields", """SELECT external_code, retail, week, year, CASE WHEN retail % 4 <> 1 THEN qty END AS qty,
  CASE WHEN retail % 2 = 1 THEN 's' || retail END AS source, retail % 4 <> 1 AS fits, true AS has_file,
  CASE WHEN retail % 4 = 1 THEN 'qty' END AS field, CASE WHEN retail % 4 = 1 THEN qty || 'x' END AS value FROM silver_restock""")
oracle("stream_new_column", """SELECT *, CASE WHEN retail % 2 = 1 THEN 's' || retail END AS source FROM silver_restock""")
oracle("stream_ingest_customer", "SELECT * FROM silver_customer")
oracle("stream_micro_batches", "SELECT * FROM silver_restock")
