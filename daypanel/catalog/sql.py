"""Pieces of SQL that the checks share. They follow the given tables, not the Spark code."""

from __future__ import annotations

CLIENTS = """clientes AS (
  SELECT c_custkey AS client_id, r_name AS region
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

READINGS = """consumo AS (
  SELECT user_id AS client_id, CAST(ts AS DATE) AS dt,
         CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS kwh
  FROM events GROUP BY 1, 2)"""

CLIMATE = """clima_raw AS (
  SELECT region, CAST(ts AS DATE) AS dt,
         CASE WHEN MOD(DAY(CAST(ts AS DATE)) + LENGTH(region), 7) < 3 THEN NULL
              ELSE CAST(SUM(CAST(value AS DECIMAL(18,2))) AS DOUBLE) / 10 END AS temperature,
         CAST(COUNT(*) AS DOUBLE) AS humidity
  FROM events JOIN clientes ON user_id = client_id GROUP BY 1, 2)"""

NEIGHBOURS = """around AS (
  SELECT *, MAX(CASE WHEN temperature IS NOT NULL THEN rn END)
              OVER (PARTITION BY region ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pr,
         MIN(CASE WHEN temperature IS NOT NULL THEN rn END)
              OVER (PARTITION BY region ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nr
  FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY region ORDER BY dt) AS rn FROM clima_raw)),
placed AS (
  SELECT a.region, a.dt, a.temperature, a.humidity, a.rn, a.pr, a.nr, p.temperature AS pv, n.temperature AS nv
  FROM around a LEFT JOIN around p ON p.region = a.region AND p.rn = a.pr
                LEFT JOIN around n ON n.region = a.region AND n.rn = a.nr)"""

LINEAR = """CASE WHEN temperature IS NOT NULL THEN temperature WHEN nr IS NULL THEN pv
              ELSE pv + (nv - pv) * (CAST(rn - pr AS DOUBLE) / (nr - pr)) END"""

IMPUTED = f"""clima AS (
  SELECT region, dt, humidity, COALESCE({LINEAR}, pv, nv) AS temperature FROM placed)"""

SHORT_PANEL = f"{CLIENTS}, {READINGS}"
CLIMATE_PANEL = f"{SHORT_PANEL}, {CLIMATE}, {NEIGHBOURS}, {IMPUTED}"

# The same tables over the seven years of the long panel.
LONG_CLIENTS = """clientes AS (
  SELECT s_suppkey AS client_id, r_name AS region
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
LONG_READINGS = """consumo AS (
  SELECT l_suppkey AS client_id, CAST(l_shipdate AS DATE) AS dt,
         CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS kwh
  FROM lineitem GROUP BY 1, 2)"""
LONG_CLIMATE = """clima_raw AS (
  SELECT region, CAST(l_shipdate AS DATE) AS dt,
         CASE WHEN MOD(DAY(CAST(l_shipdate AS DATE)) + LENGTH(region), 7) < 3 THEN NULL
              ELSE CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) / 10 END AS temperature,
         CAST(COUNT(*) AS DOUBLE) AS humidity
  FROM lineitem JOIN clientes ON l_suppkey = client_id GROUP BY 1, 2)"""
LONG_CLIMATE_PANEL = f"{LONG_CLIENTS}, {LONG_READINGS}, {LONG_CLIMATE}, {NEIGHBOURS}, {IMPUTED}"

JOINED = """joined AS (
  SELECT c.dt, c.client_id, c.kwh AS y, cl.temperature AS temp, cl.humidity AS hum
  FROM consumo c JOIN clientes k ON c.client_id = k.client_id
       LEFT JOIN clima cl ON cl.dt = c.dt AND cl.region = k.region)"""


def r6(expression: str) -> str:
    """Six decimals; adding zero turns a negative zero into a plain one."""
    return f"(ROUND({expression}, 6) + 0.0)"


def over(frame: str = "") -> str:
    return f"OVER (PARTITION BY client_id ORDER BY dt {frame})"


FEATURE_SQL = {
    "total_consumption": "y",
    "avg_temperature": r6("temp"),
    "avg_humidity": "hum",
    "temp_humid_interaction": r6("temp * hum"),
    "day_counter": f"ROW_NUMBER() {over()}",
    **{f"consumption_lag_{k}": f"LAG(y, {k}) {over()}" for k in (1, 2, 3, 4, 7, 15)},
    **{f"rolling_mean_{k}": r6(f"AVG(y) {over(f'ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING')}") for k in (3, 7)},
    **{f"rolling_std_{k}": r6(f"STDDEV_SAMP(y) {over(f'ROWS BETWEEN {k} PRECEDING AND 1 PRECEDING')}") for k in (3, 7)},
    "diff_lag_1": r6(f"y - LAG(y, 1) {over()}"),
}


def features(*names: str) -> str:
    """Select list of the named feature columns."""
    return ", ".join(f"{FEATURE_SQL[name]} AS {name}" for name in names)


HOLIDAY = "(MONTH(dt) * 100 + DAY(dt)) IN (101, 421, 501, 907, 1012, 1102, 1115, 1225)"
SEASON = """CASE WHEN MONTH(dt) * 100 + DAY(dt) BETWEEN 321 AND 620 THEN 'Outono'
                 WHEN MONTH(dt) * 100 + DAY(dt) BETWEEN 621 AND 920 THEN 'Inverno'
                 WHEN MONTH(dt) * 100 + DAY(dt) BETWEEN 921 AND 1220 THEN 'Primavera' ELSE 'Verao' END"""
CALENDAR_SQL = {
    "month": "CAST(MONTH(dt) AS BIGINT)",
    "week_of_year": "CAST(strftime(dt, '%W') AS BIGINT) + 1",
    "day_of_week": "CAST(DAYOFWEEK(dt) AS BIGINT)",
    "day_of_year": "CAST(DAYOFYEAR(dt) AS BIGINT)",
    "is_final_semana": "DAYOFWEEK(dt) IN (0, 6)",
    "estacao": SEASON,
    "is_feriado": HOLIDAY,
    "is_feriado_prolongado": f"{HOLIDAY} AND DAYOFWEEK(dt) IN (1, 2, 4, 5)",
    "tipo_feriado": f"CASE WHEN {HOLIDAY} THEN 'Feriado' ELSE 'Nenhum' END",
    "is_dia_util": f"NOT (DAYOFWEEK(dt) IN (0, 6) OR {HOLIDAY})",
    "day_of_week_name": "CAST(DAYOFWEEK(dt) AS BIGINT)",
}
LONG_DAYS = "d AS (SELECT DISTINCT CAST(l_shipdate AS DATE) AS dt FROM lineitem)"


def calendar(*names: str) -> str:
    """Select list of the named calendar columns."""
    return ", ".join(f"{CALENDAR_SQL[name]} AS {name}" for name in names)


LONG_PANEL = f"""{LONG_READINGS},
panel AS (
  SELECT client_id, dt, kwh AS y, LAG(kwh, 1) OVER (PARTITION BY client_id ORDER BY dt) AS p FROM consumo)"""

# Windows of the long panel: 24 months, then 6 months each, with the last 6 months held out.
FOLDS = """limits AS (
  SELECT MIN(dt) AS first_day, MAX(dt) AS last_day, CAST(MAX(dt) - INTERVAL 6 MONTH AS DATE) AS test_start
  FROM consumo),
known AS (
  SELECT first_day, last_day, test_start, (SELECT MAX(dt) FROM consumo WHERE dt < test_start) AS last_tv FROM limits),
folds(fold, train_start, train_end, val_end, last_tv) AS (
  SELECT CAST(1 AS BIGINT), first_day, CAST(first_day + INTERVAL 24 MONTH AS DATE),
         CAST(CAST(first_day + INTERVAL 24 MONTH AS DATE) + INTERVAL 6 MONTH AS DATE), last_tv FROM known
  UNION ALL
  SELECT fold + 1, train_start, val_end, CAST(val_end + INTERVAL 6 MONTH AS DATE), last_tv FROM folds
  WHERE CAST(val_end + INTERVAL 6 MONTH AS DATE) <= last_tv)"""
FOLD_PANEL = LONG_PANEL + ", " + FOLDS


def r2(y: str = "y", p: str = "p") -> str:
    unexplained, total = f"SUM(({y} - {p}) * ({y} - {p}))", f"(VAR_POP({y}) * COUNT(*))"
    return (
        f"CASE WHEN COUNT(*) < 2 THEN NULL WHEN {total} = 0 AND {unexplained} = 0 THEN 1.0 "
        f"WHEN {total} = 0 THEN 0.0 ELSE 1 - {unexplained} / {total} END"
    )


MAE = "AVG(ABS(y - p))"
RMSE = "SQRT(AVG((y - p) * (y - p)))"
MAPE = "100 * AVG(ABS((y - p) / CASE WHEN y = 0 THEN 1e-10 ELSE y END))"
ERRORS = f"{r6(MAE)} AS mae, {r6(RMSE)} AS rmse, {r6(r2())} AS r2, {r6(MAPE)} AS mape"

POOLED_STEPS = """pooled AS (
  SELECT dt, ABS(y - LAG(y, 1) OVER (ORDER BY dt, client_id)) AS step FROM panel)"""
FOLD_SCORES = f"""scales AS (
  SELECT fold, AVG(step) AS scale FROM folds JOIN pooled ON dt < train_end GROUP BY fold),
raw_scores AS (
  SELECT fold, {MAE} AS mae, {RMSE} AS rmse, {r2()} AS r2, {MAPE} AS mape
  FROM panel JOIN folds ON dt >= train_end AND dt < val_end WHERE p IS NOT NULL GROUP BY fold),
fold_scores AS (SELECT raw_scores.*, mae / scale AS mase FROM raw_scores JOIN scales USING (fold))"""

RUNS = """runs AS (
  SELECT CONCAT('r', CAST(o_orderkey AS VARCHAR)) AS run_id, CAST(NULL AS VARCHAR) AS parent_run_id,
         o_orderpriority AS name, CAST(o_orderdate AS DATE) AS start_dt, o_orderkey AS seq
  FROM orders
  UNION ALL
  SELECT CONCAT('r', CAST(l_orderkey AS VARCHAR), '_', CAST(l_linenumber AS VARCHAR)),
         CONCAT('r', CAST(l_orderkey AS VARCHAR)),
         CONCAT('Fold_', CAST(l_linenumber AS VARCHAR)), CAST(MIN(l_shipdate) AS DATE), l_orderkey
  FROM lineitem GROUP BY l_orderkey, l_linenumber)"""
