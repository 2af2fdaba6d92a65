"""DuckDB SQL oracles, written independently of the Spark operators.

The role tables, the cleaning and the consolidation are spelled out as plain
SQL over the registered views (lineitem, part, supplier, nation, region,
orders); each mart then reads the ``wide`` CTE.  Money is summed as
DECIMAL(18,4) then turned into DOUBLE, means are that sum over a count, and
an undefined correlation (DuckDB: NaN) is mapped to NULL.
"""

from __future__ import annotations

from shopline.plans.catalog import MAIN_FIGURE

# ------------------------------------------------------------------ role tables
SALES = """
sales AS (
  SELECT CAST(l.l_orderkey * 100 + l.l_linenumber AS BIGINT) AS id,
         CAST(l.l_shipdate AS DATE) AS date,
         CAST(l.l_suppkey AS BIGINT) AS store_nbr,
         p.p_brand AS family,
         CAST(l.l_extendedprice AS DOUBLE) AS sales,
         CAST(round(l.l_discount * 100) AS BIGINT) AS onpromotion
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
)"""

STORES = """
stores AS (
  SELECT CAST(s.s_suppkey AS BIGINT) AS store_nbr,
         n.n_name AS city,
         r.r_name AS state,
         substr('ABCDE', CAST(s.s_suppkey % 5 + 1 AS INTEGER), 1) AS type,
         CAST(s.s_suppkey % 17 + 1 AS BIGINT) AS cluster
  FROM supplier s
  LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

TRANSACTIONS = """
transactions AS (
  SELECT CAST(l_shipdate AS DATE) AS date,
         CAST(l_suppkey AS BIGINT) AS store_nbr,
         count(DISTINCT l_orderkey) AS transactions
  FROM lineitem
  WHERE dayofweek(CAST(l_shipdate AS DATE)) <> 0
  GROUP BY 1, 2
)"""

PRICES = """
prices AS (
  SELECT date,
         CASE WHEN day(date) IN (1, 2, 16) THEN NULL ELSE price END AS dcoilwtico
  FROM (
    SELECT CAST(o_orderdate AS DATE) AS date,
           ((2 * sum(CAST(round(o_totalprice * 100) AS BIGINT)) + count(o_totalprice))
             // (2 * count(o_totalprice))) / 100.0 AS price
    FROM orders
    WHERE dayofweek(CAST(o_orderdate AS DATE)) NOT IN (0, 6)
    GROUP BY 1
  )
)"""

HOLIDAYS = """
holiday_src AS (
  SELECT CAST(o_orderdate AS DATE) AS date,
         CASE WHEN o_orderstatus = 'F' THEN 'Holiday'
              WHEN o_orderstatus = 'O' THEN 'Event'
              WHEN o_custkey % 2 = 0 THEN 'Transfer'
              ELSE 'Work Day' END AS type,
         CASE o_custkey % 3 WHEN 0 THEN 'National' WHEN 1 THEN 'Regional' ELSE 'Local' END AS locale,
         o_custkey, o_orderkey, o_totalprice
  FROM orders
),
holiday_rows AS (
  SELECT date, type, locale,
         CASE locale WHEN 'National' THEN 'Country'
                     WHEN 'Regional' THEN 'Region ' || CAST(o_custkey % 5 AS VARCHAR)
                     ELSE 'City ' || CAST(o_custkey % 25 AS VARCHAR) END AS locale_name,
         type || ' ' || CAST(o_orderkey AS VARCHAR) AS description,
         (o_orderkey % 4 = 0) AS transferred,
         o_totalprice
  FROM holiday_src
),
holidays AS (SELECT date, type, locale, locale_name, description, transferred FROM holiday_rows)"""

# Raw feeds with defects (duplicates, blanks), as the cleaning step receives them.
RAW = """
sales_src AS (
  SELECT CAST(l.l_orderkey * 100 + l.l_linenumber AS BIGINT) AS id,
         CAST(l.l_shipdate AS DATE) AS date,
         CAST(l.l_suppkey AS BIGINT) AS store_nbr,
         CASE WHEN l.l_discount <> 0.1 THEN p.p_brand END AS family,
         CASE WHEN l.l_tax <> 0.0 THEN CAST(l.l_extendedprice AS DOUBLE) END AS sales,
         CASE WHEN l.l_quantity <> 50.0 THEN CAST(round(l.l_discount * 100) AS BIGINT) END AS onpromotion,
         (l.l_returnflag = 'R' AND l.l_linestatus = 'F') AS twice
  FROM lineitem l LEFT JOIN part p ON l.l_partkey = p.p_partkey
),
train_raw AS (
  SELECT id, date, store_nbr, family, sales, onpromotion FROM sales_src
  UNION ALL
  SELECT id, date, store_nbr, family, sales, onpromotion FROM sales_src WHERE twice
),
holidays_raw AS (
  SELECT date, type, locale,
         CASE WHEN NOT (locale = 'Local' AND o_totalprice > 400000) THEN locale_name END AS locale_name,
         description,
         CASE WHEN o_totalprice >= 20000 THEN transferred END AS transferred
  FROM holiday_rows
)"""


def _median(table: str, col: str) -> str:
    """Exact median (mean of the two middle values) of a column, as a scalar subquery."""
    return f"""(SELECT (max(CASE WHEN i = (n - 1) // 2 THEN v END) + max(CASE WHEN i = n // 2 THEN v END)) / 2
   FROM (SELECT v, row_number() OVER (ORDER BY v) - 1 AS i, count(*) OVER () AS n
         FROM (SELECT CAST({col} AS DOUBLE) AS v FROM {table} WHERE {col} IS NOT NULL)))"""


def _mode(table: str, col: str) -> str:
    return f"""(SELECT {col} FROM {table} WHERE {col} IS NOT NULL
   GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1)"""


# --------------------------------------------------------------- cleaned inputs
# Sales, stores, transactions and holidays have neither duplicates nor nulls
# here, so cleaning is a DISTINCT; prices are interpolated by row position and
# edge-filled.
CLEAN = f"""
train_d AS MATERIALIZED (SELECT DISTINCT * FROM train_raw),
train_v AS MATERIALIZED (
  SELECT {_mode('train_d', 'family')} AS family_v, {_median('train_d', 'sales')} AS sales_v,
         {_median('train_d', 'onpromotion')} AS onpromotion_v
),
sales_c AS (
  SELECT id, date, store_nbr,
         coalesce(family, family_v) AS family,
         coalesce(sales, sales_v) AS sales,
         coalesce(CAST(onpromotion AS DOUBLE), onpromotion_v) AS onpromotion
  FROM train_d, train_v
),
stores_c AS (SELECT DISTINCT * FROM stores),
transactions_c AS (SELECT DISTINCT * FROM transactions),
holidays_d AS (SELECT DISTINCT * FROM holidays_raw),
holidays_c AS (
  SELECT date, type, locale,
         coalesce(locale_name, {_mode('holidays_d', 'locale_name')}) AS locale_name,
         description,
         coalesce(transferred, {_mode('holidays_d', 'transferred')}) AS transferred
  FROM holidays_d
),
prices_pos AS (
  SELECT date, dcoilwtico AS v,
         CAST(row_number() OVER (ORDER BY date) AS DOUBLE) AS pos
  FROM (SELECT DISTINCT * FROM prices)
),
prices_nb AS (
  SELECT date, v, pos,
    last_value(v IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lv,
    last_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS)
      OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS lp,
    first_value(v IGNORE NULLS) OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nv,
    first_value(CASE WHEN v IS NOT NULL THEN pos END IGNORE NULLS)
      OVER (ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS np
  FROM prices_pos
),
prices_c AS (
  SELECT date,
    coalesce(CASE WHEN v IS NOT NULL THEN v
                  WHEN lp IS NOT NULL AND np IS NOT NULL
                  THEN lv + (nv - lv) * (pos - lp) / (np - lp) END,
             lv, nv) AS dcoilwtico
  FROM prices_nb
)"""

# ---------------------------------------------------------------- consolidation
WIDE = """
hol_ranked AS (
  SELECT *, row_number() OVER (
      PARTITION BY date
      ORDER BY (type <> 'Holiday'),
               CASE locale WHEN 'National' THEN 1 WHEN 'Regional' THEN 2 WHEN 'Local' THEN 3 ELSE 4 END,
               locale_name NULLS FIRST, description NULLS FIRST, transferred NULLS FIRST,
               type NULLS FIRST, locale NULLS FIRST) AS rn
  FROM holidays_c
),
hol_flag AS (
  SELECT date, coalesce(bool_or(locale = 'National' AND transferred = false), false) AS is_national_holiday
  FROM holidays_c GROUP BY date
),
hol_day AS (
  SELECT r.date, r.type AS holiday_type, r.locale AS holiday_locale,
         r.locale_name AS holiday_locale_name, r.description AS holiday_description,
         r.transferred AS holiday_transferred, f.is_national_holiday
  FROM hol_ranked r JOIN hol_flag f ON r.date = f.date WHERE r.rn = 1
),
wide AS (
  SELECT s.id, s.date, s.store_nbr, s.family, s.sales, s.onpromotion,
         st.city, st.state, st.type, st.cluster,
         t.transactions, p.dcoilwtico,
         h.holiday_type, h.holiday_locale, h.holiday_locale_name, h.holiday_description,
         h.holiday_transferred, coalesce(h.is_national_holiday, false) AS is_national_holiday
  FROM sales_c s
  LEFT JOIN stores_c st ON s.store_nbr = st.store_nbr
  LEFT JOIN transactions_c t ON s.store_nbr = t.store_nbr AND s.date = t.date
  LEFT JOIN prices_c p ON s.date = p.date
  LEFT JOIN hol_day h ON s.date = h.date
)"""

BASE = ",".join([SALES, STORES, TRANSACTIONS, PRICES, HOLIDAYS, RAW, CLEAN, WIDE])


def _with(body: str, *ctes: str) -> str:
    extra = "".join("," + c for c in ctes)
    return f"WITH {BASE}{extra}\n{body}"


def _sum(x: str) -> str:
    return f"CAST(sum(CAST({x} AS DECIMAL(18,4))) AS DOUBLE)"


def _avg(x: str) -> str:
    return f"({_sum(x)} / count({x}))"


def _corr(x: str, y: str) -> str:
    c = f"corr({x}, {y})"
    return f"round(CASE WHEN isnan({c}) THEN NULL ELSE {c} END, 4)"


PERIOD = ("1998-01-01", "1999-12-31")

ORACLES: dict[str, str] = {}

ORACLES["sales_by_family"] = _with(f"""
SELECT family, total_sales, avg_sales,
       round(total_sales / (SELECT {_sum('total_sales')} FROM fam) * 100, 2) AS pct_of_total
FROM fam""", f"""
fam AS (SELECT family, {_sum('sales')} AS total_sales, {_avg('sales')} AS avg_sales
        FROM wide GROUP BY family)""")

ORACLES["store_ranking"] = _with("""
SELECT store_nbr, total_sales, city, state, type,
       row_number() OVER (ORDER BY total_sales DESC, store_nbr) AS ranking
FROM per_store""", f"""
per_store AS (SELECT store_nbr, city, state, type, {_sum('sales')} AS total_sales
              FROM wide GROUP BY store_nbr, city, state, type)""")

ORACLES["sales_by_city_state"] = _with(f"""
SELECT city, state, {_avg('sales')} AS avg_sales, {_sum('sales')} AS total_sales
FROM wide GROUP BY city, state""")

ORACLES["monthly_evolution"] = _with(f"""
SELECT CAST(year(date) AS INTEGER) AS year, strftime(date, '%Y-%m') AS year_month,
       {_sum('sales')} AS total_sales
FROM wide GROUP BY 1, 2""")

ORACLES["holiday_impact"] = _with(f"""
SELECT is_national_holiday, {_avg('sales')} AS avg_sales, {_sum('sales')} AS total_sales,
       count(*) AS n_rows,
       CASE WHEN is_national_holiday THEN 'national_holiday' ELSE 'normal_day' END AS day_type
FROM wide GROUP BY is_national_holiday""")

ORACLES["holiday_window"] = _with("""
SELECT w.offset, d.family, CAST(sum(d.day_total) AS DOUBLE) / count(d.day_total) AS avg_sales
FROM daily d JOIN win w ON d.date = w.date
GROUP BY w.offset, d.family""", """
ev AS (SELECT DISTINCT date AS d FROM wide WHERE is_national_holiday),
win AS (SELECT CAST(g.k AS INTEGER) AS offset, ev.d + CAST(g.k AS INTEGER) AS date
        FROM ev CROSS JOIN generate_series(-3, 3) AS g(k)),
daily AS (SELECT date, family, sum(CAST(sales AS DECIMAL(18,4))) AS day_total
          FROM wide GROUP BY date, family)""")


def _contrast(flag: str, t: str, f: str, change: str) -> str:
    h = _avg(f"CASE WHEN {flag} THEN sales END")
    n = _avg(f"CASE WHEN NOT ({flag}) THEN sales END")
    return _with(f"""
SELECT family, {t}, {f}, round(({t} - {f}) / {f} * 100, 2) AS {change}
FROM (SELECT family, {h} AS {t}, {n} AS {f} FROM wide GROUP BY family)""")


ORACLES["holiday_sensitivity"] = _contrast("is_national_holiday", "avg_holiday", "avg_normal", "pct_change")
ORACLES["promotion_uplift"] = _contrast("onpromotion > 0", "avg_promo", "avg_no_promo", "uplift_pct")

# The mean of doubles in any order: whole parts and fractions (in units of 2**-52) summed apart as integers.
_MEAN_PRICE = """(
  CAST(sum(CAST(floor(dcoilwtico) AS BIGINT)) + sum(CAST(floor((dcoilwtico - floor(dcoilwtico)) * 4503599627370496.0::DOUBLE) AS BIGINT)) // 4503599627370496 AS DOUBLE)
  + CAST(sum(CAST(floor((dcoilwtico - floor(dcoilwtico)) * 4503599627370496.0::DOUBLE) AS BIGINT)) % 4503599627370496 AS DOUBLE) / 4503599627370496.0::DOUBLE
  ) / CAST(count(dcoilwtico) AS DOUBLE)"""

_MONTHLY = f"""SELECT strftime(date, '%Y-%m') AS year_month, {_sum('sales')} AS total_sales,
         {_MEAN_PRICE} AS avg_price"""

ORACLES["price_sales_corr"] = _with(f"""
SELECT year_month, total_sales, avg_price,
       (SELECT {_corr('total_sales', 'avg_price')} FROM monthly) AS corr
FROM monthly""", f"""
monthly AS ({_MONTHLY} FROM wide GROUP BY 1)""")

_IN_PERIOD = f"date BETWEEN DATE '{PERIOD[0]}' AND DATE '{PERIOD[1]}'"

ORACLES["lag_corr"] = _with("\nUNION ALL\n".join(
    f"SELECT CAST({k} AS BIGINT) AS lag_months, {_corr('total_sales', f'p{k}')} AS corr "
    f"FROM lagged HAVING count(*) > 0" for k in range(7)), f"""
monthly AS ({_MONTHLY} FROM wide WHERE {_IN_PERIOD} GROUP BY 1),
lagged AS (SELECT total_sales, {", ".join(f"lag(avg_price, {k}) OVER (ORDER BY year_month) AS p{k}" for k in range(7))}
           FROM monthly)""")

ORACLES["city_price_corr"] = _with(f"""
SELECT city, {_corr('total_sales', 'avg_price')} AS corr
FROM monthly GROUP BY city HAVING count(*) >= 3""", f"""
monthly AS (SELECT city, strftime(date, '%Y-%m') AS year_month, {_sum('sales')} AS total_sales,
                   {_MEAN_PRICE} AS avg_price
            FROM wide WHERE {_IN_PERIOD} GROUP BY 1, 2)""")

ORACLES["transactions_vs_sales"] = _with(f"""
SELECT store_nbr, total_sales, total_transactions,
       (SELECT {_corr('total_sales', 'total_transactions')} FROM per_store) AS corr
FROM per_store""", f"""
per_store AS (SELECT store_nbr, {_sum('sales')} AS total_sales,
                     CAST(coalesce(sum(transactions), 0) AS BIGINT) AS total_transactions
              FROM wide GROUP BY store_nbr)""")

ORACLES["average_ticket"] = _with(f"""
SELECT store_nbr, total_sales, total_transactions, total_sales / total_transactions AS avg_ticket
FROM (SELECT store_nbr, {_sum('sales')} AS total_sales,
             CAST(sum(transactions) AS BIGINT) AS total_transactions
      FROM wide GROUP BY store_nbr)
WHERE total_transactions > 0""")

ORACLES["average_ticket_store_day"] = _with(f"""
SELECT s.store_nbr, s.total_sales, t.total_transactions,
       s.total_sales / t.total_transactions AS avg_ticket
FROM (SELECT store_nbr, {_sum('sales')} AS total_sales FROM wide GROUP BY store_nbr) s
JOIN (SELECT store_nbr, CAST(sum(tr) AS BIGINT) AS total_transactions
      FROM (SELECT DISTINCT store_nbr, date, transactions AS tr FROM wide) GROUP BY store_nbr) t
  ON s.store_nbr = t.store_nbr
WHERE t.total_transactions > 0""")

ORACLES["sales_by_store_type"] = _with(f"""
SELECT type, {_sum('sales')} AS total_sales, count(DISTINCT store_nbr) AS n_stores
FROM wide GROUP BY type""")

ORACLES["top_families"] = _with(f"""
SELECT family, {_sum('sales')} AS total_sales, {_avg('sales')} AS avg_sales,
       round({_sum('sales')} / (SELECT {_sum('sales')} FROM wide) * 100, 2) AS pct_of_total
FROM wide GROUP BY family ORDER BY total_sales DESC, family LIMIT 5""")

# ------------------------------------------------------ sources, profile, clean
ORACLES["csv_repair"] = _with("""
SELECT id, date, store_nbr,
       CASE WHEN onpromotion % 2 = 1
            THEN family || ', "S' || CAST(store_nbr AS VARCHAR) || '"' ELSE family END AS family,
       sales, onpromotion
FROM sales""")

# Raw inputs and their columns with Spark type names.
RAW_TABLES = {
    "train": ("train_raw", [("id", "bigint"), ("date", "date"), ("store_nbr", "bigint"),
                            ("family", "string"), ("sales", "double"), ("onpromotion", "bigint")]),
    "stores": ("stores", [("store_nbr", "bigint"), ("city", "string"), ("state", "string"),
                          ("type", "string"), ("cluster", "bigint")]),
    "transactions": ("transactions", [("date", "date"), ("store_nbr", "bigint"),
                                      ("transactions", "bigint")]),
    "oil": ("prices", [("date", "date"), ("dcoilwtico", "double")]),
    "holidays": ("holidays_raw", [("date", "date"), ("type", "string"), ("locale", "string"),
                                  ("locale_name", "string"), ("description", "string"),
                                  ("transferred", "boolean")]),
}

ORACLES["load_audit"] = _with("\nUNION ALL\n".join(
    f"""SELECT '{name}' AS "table", count(*) AS rows, {len(cols)} AS columns,
       CAST({' + '.join(f'(count(*) - count({c}))' for c, _ in cols)} AS BIGINT) AS nulls,
       CAST({'count(CASE WHEN onpromotion % 3 = 0 THEN 1 END)' if name == 'train' else '0'} AS BIGINT) AS repaired
FROM {view}""" for name, (view, cols) in RAW_TABLES.items()))

for _query, _view in (("csv_typed_stores", "stores"), ("csv_typed_transactions", "transactions"),
                      ("csv_typed_prices", "prices"), ("csv_typed_holidays", "holidays_raw")):
    ORACLES[_query] = _with(f"SELECT * FROM {_view}")

ORACLES["cast_date"] = _with("SELECT * FROM sales")

# round(100 * nulls / rows, 3) rounded half up, in integer arithmetic.
ORACLES["profile_nulls"] = _with("\nUNION ALL\n".join(
    f"""SELECT '{name}' AS "table", '{c}' AS "column", '{t}' AS data_type, nulls,
       CASE WHEN rows > 0 THEN ((200000 * nulls + rows) // (2 * rows)) / 1000.0 ELSE 0.0 END AS null_pct
FROM (SELECT count(*) AS rows, CAST(count(*) - count({c}) AS BIGINT) AS nulls FROM {view})"""
    for name, (view, cols) in RAW_TABLES.items() for c, t in cols))

ORACLES["profile_duplicates"] = _with("\nUNION ALL\n".join(
    f"""SELECT '{name}' AS "table", count(*) AS rows, {len(cols)} AS columns,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {view})) AS duplicate_rows,
       CAST({' + '.join(f'(count(*) - count({c}))' for c, _ in cols)} AS BIGINT) AS total_nulls FROM {view}"""
    for name, (view, cols) in RAW_TABLES.items()))

ORACLES["profile_date_range"] = _with("\nUNION ALL\n".join(
    f"""SELECT '{name}' AS "table", '{c}' AS "column", min({c}) AS min_date, max({c}) AS max_date FROM {view}"""
    for name, (view, cols) in RAW_TABLES.items() for c, t in cols if t == "date"))

ORACLES["dedupe_rows"] = _with("SELECT DISTINCT * FROM train_raw")

ORACLES["dedupe_fingerprint"] = ORACLES["dedupe_rows"]

ORACLES["duplicates_fingerprint"] = _with("\nUNION ALL\n".join(
    f"""SELECT '{name}' AS "table", count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM {view})) AS duplicate_rows FROM {view}"""
    for name, (view, _) in RAW_TABLES.items()))

ORACLES["impute_median"] = _with(f"""
SELECT id, date, store_nbr, family, coalesce(sales, sales_v) AS sales,
       coalesce(CAST(onpromotion AS DOUBLE), onpromotion_v) AS onpromotion
FROM train_d, train_v""")

ORACLES["csv_multiline"] = _with("""
SELECT id, date, store_nbr,
       CASE WHEN onpromotion % 2 = 1 THEN family || chr(10) || '"' || CAST(store_nbr AS VARCHAR) || '",' || chr(10) || chr(10) || 'end' ELSE family END AS family,
       sales, onpromotion
FROM sales""")

ORACLES["impute_mode"] = _with("SELECT * FROM holidays_c")

ORACLES["interpolate_linear"] = _with("""
SELECT date, CASE WHEN v IS NOT NULL THEN v
                  WHEN lp IS NOT NULL AND np IS NOT NULL THEN lv + (nv - lv) * (pos - lp) / (np - lp)
             END AS dcoilwtico
FROM prices_nb""")

ORACLES["interpolate_edges"] = _with("SELECT * FROM prices_c")


def _calendar(table: str, column: str, key: str | None = None) -> str:
    """Every day from a series' first to its last; days without a value on the line between their neighbours."""
    of, own, using = (f"{key}, ", f"PARTITION BY {key} ", f"{key}, date") if key else ("", "", "date")
    spans = f"SELECT {of}min(date) AS lo, max(date) AS hi FROM {table}" + (f" GROUP BY {key}" if key else "")
    past = f"OVER ({own}ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = f"OVER ({own}ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    known = "CASE WHEN v IS NOT NULL THEN date END"
    return _with(f"""
SELECT {of}date, coalesce(v, lv + (nv - lv) * CAST(date - ld AS DOUBLE) / CAST(nd - ld AS DOUBLE), lv, nv) AS {column}
FROM (SELECT {of}date, v, last_value(v IGNORE NULLS) {past} AS lv, last_value({known} IGNORE NULLS) {past} AS ld,
             first_value(v IGNORE NULLS) {ahead} AS nv, first_value({known} IGNORE NULLS) {ahead} AS nd
      FROM (SELECT {of}date, CAST({column} AS DOUBLE) AS v
            FROM (SELECT {of}CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS date FROM ({spans}))
            LEFT JOIN {table} USING ({using})))""")


ORACLES["interpolate_calendar"] = _calendar("prices", "dcoilwtico")

ORACLES["interpolate_calendar_stores"] = _calendar("transactions", "transactions", "store_nbr")

ORACLES["post_conditions"] = _with("""
SELECT 'train' AS "table", 'sales' AS "column", CAST(count(*) - count(sales) AS BIGINT) AS nulls FROM sales_c
UNION ALL
SELECT 'oil', 'dcoilwtico', CAST(count(*) - count(dcoilwtico) AS BIGINT) FROM prices_c""")


def _audit_rows() -> str:
    parts = []
    counts = {
        "train": ("(SELECT count(*) FROM train_raw)", "(SELECT count(*) FROM train_d)"),
        "oil": ("(SELECT count(*) FROM prices)", "(SELECT count(*) FROM (SELECT DISTINCT * FROM prices))"),
        "holidays": ("(SELECT count(*) FROM holidays_raw)", "(SELECT count(*) FROM holidays_d)"),
    }
    imputed = {
        ("train", "family"): ("'mode'", "NULL", _mode("train_d", "family")),
        ("train", "sales"): ("'median'", _median("train_d", "sales"), "NULL"),
        ("train", "onpromotion"): ("'median'", _median("train_d", "onpromotion"), "NULL"),
        ("oil", "dcoilwtico"): ("'linear_interpolation+edge_fill'", "NULL", "NULL"),
        ("holidays", "locale_name"): ("'mode'", "NULL", _mode("holidays_d", "locale_name")),
        ("holidays", "transferred"): ("'mode'", "NULL", _mode("holidays_d", "transferred")),
    }
    for (table, col), (strategy, num, text) in imputed.items():
        view = RAW_TABLES[table][0]
        before, after = counts[table]
        parts.append(f"""SELECT '{table}' AS "table", '{col}' AS "column",
       {before} AS rows_before, {after} AS rows_after, {before} - {after} AS duplicates_removed,
       (SELECT CAST(count(*) - count({col}) AS BIGINT) FROM {view}) AS nulls_before,
       {strategy} AS strategy, CAST({num} AS DOUBLE) AS value_num, CAST({text} AS VARCHAR) AS value_text""")
    return "\nUNION ALL\n".join(parts)


ORACLES["clean_audit"] = _with(_audit_rows())

ORACLES["holiday_representative"] = _with("""
SELECT date, holiday_type, holiday_locale, holiday_locale_name, holiday_description, holiday_transferred
FROM hol_day""")

ORACLES["holiday_national_flag"] = _with("SELECT date, is_national_holiday FROM hol_flag")

ORACLES["consolidate"] = _with("SELECT * FROM wide")

ORACLES["join_fanout_audit"] = _with("""
SELECT b.n AS base_rows, w.n AS consolidated_rows, w.n - b.n AS rows_added_by_joins, 18 AS columns
FROM (SELECT count(*) AS n FROM sales_c) b, (SELECT count(*) AS n FROM wide) w""")

ORACLES["dimension_key_check"] = _with("""
SELECT 'stores' AS "table", CAST(store_nbr AS VARCHAR) AS key, count(*) AS n
FROM stores GROUP BY store_nbr HAVING count(*) > 1
UNION ALL
SELECT 'transactions', CAST(store_nbr AS VARCHAR) || '|' || CAST(date AS VARCHAR), count(*)
FROM transactions GROUP BY store_nbr, date HAVING count(*) > 1
UNION ALL
SELECT 'oil', CAST(date AS VARCHAR), count(*) FROM prices GROUP BY date HAVING count(*) > 1
UNION ALL
SELECT 'holidays', CAST(date AS VARCHAR), count(*) FROM holidays_raw GROUP BY date HAVING count(*) > 1""")

# The run over all marts: rows, and the least and the largest of each mart's main figure.
ORACLES["marts_all"] = "\nUNION ALL\n".join(
    f"""SELECT '{name}' AS mart, count(*) AS n_rows, min(CAST({figure} AS DOUBLE)) AS lowest, max(CAST({figure} AS DOUBLE)) AS highest
FROM ({ORACLES[name]}) AS {name}""" for name, figure in MAIN_FIGURE.items())

ORACLES["published_marts"] = ORACLES["marts_all"]

ORACLES["published_consolidated"] = _with("SELECT *, year(date) AS year FROM wide")
