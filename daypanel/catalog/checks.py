"""SQL that gives the same rows as the registered queries."""

from __future__ import annotations

from daypanel.catalog.sql import (
    CLIENTS, CLIMATE, CLIMATE_PANEL, ERRORS, FEATURE_SQL, FOLD_PANEL, FOLD_SCORES, JOINED, LINEAR, LONG_CLIMATE_PANEL, LONG_DAYS,
    LONG_PANEL, MAE, NEIGHBOURS, POOLED_STEPS, RUNS, SHORT_PANEL, calendar, features, over, r2, r6,
)

CHECKS: dict[str, str] = {}

READINGS_OF_CLIENTS = f"{SHORT_PANEL}, joined AS (SELECT dt, client_id, kwh AS y FROM consumo JOIN clientes USING (client_id))"

CHECKS["csv_scan"] = f"WITH {SHORT_PANEL} SELECT client_id, dt, kwh AS consumption_kwh FROM consumo"
CHECKS["csv_quarantine"] = f"""
WITH {SHORT_PANEL} SELECT client_id, dt, CASE WHEN MOD(client_id, 10) <> 3 THEN kwh END AS consumption_kwh,
  CASE WHEN MOD(client_id, 10) = 3 THEN 'consumption_kwh: ''n/a'' is no double' END AS reason FROM consumo"""
CHECKS["parquet_sink_roundtrip"] = CHECKS["csv_scan"]
CHECKS["split_sink_roundtrip"] = f"""
WITH RECURSIVE {FOLD_PANEL}, last AS (SELECT * FROM folds ORDER BY fold DESC LIMIT 1)
SELECT client_id, dt, kwh AS total_consumption, 'train' AS split FROM consumo, last WHERE dt < train_end
UNION ALL SELECT client_id, dt, kwh, 'validation' FROM consumo, last WHERE dt >= train_end AND dt < val_end
UNION ALL SELECT client_id, dt, kwh, 'test' FROM consumo, limits WHERE dt >= test_start"""
CHECKS["split_csv_roundtrip"] = CHECKS["split_sink_roundtrip"]

CHECKS["readings_with_region"] = f"""
WITH {SHORT_PANEL} SELECT client_id, dt, kwh AS consumption_kwh, region FROM consumo JOIN clientes USING (client_id)"""
CHECKS["readings_with_climate"] = f"""
WITH {CLIMATE_PANEL}, {JOINED}
SELECT dt, client_id, y AS total_consumption, {r6('temp')} AS avg_temperature, hum AS avg_humidity FROM joined"""
CHECKS["interaction_feature"] = f"""
WITH {CLIMATE_PANEL}, {JOINED} SELECT dt, client_id, {r6('temp * hum')} AS temp_humid_interaction FROM joined"""

LAGS = [name for name in FEATURE_SQL if "_lag_" in name and name != "diff_lag_1"]
for key, names in {
    "day_counter": ["day_counter"],
    "lag_features": ["total_consumption", "day_counter", *LAGS],
    "rolling_mean": ["rolling_mean_3", "rolling_mean_7"],
    "rolling_std": ["rolling_std_3", "rolling_std_7"],
    "diff_feature": ["diff_lag_1"],
}.items():
    CHECKS[key] = f"WITH {READINGS_OF_CLIENTS} SELECT dt, client_id, {features(*names)} FROM joined"

RAW = "OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey"
CHECKS["history_of_raw_lines"] = f"""
SELECT l_suppkey AS client_id, l_orderkey, l_linenumber, l_partkey, ROW_NUMBER() {RAW}) AS day_counter,
       LAG(l_quantity, 1) {RAW}) AS consumption_lag_1, LAG(l_quantity, 15) {RAW}) AS consumption_lag_15,
       {r6(f"AVG(l_quantity) {RAW} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS rolling_mean_7,
       {r6(f"STDDEV_SAMP(l_quantity) {RAW} ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)")} AS rolling_std_7
FROM lineitem"""

CHECKS["feature_table"] = f"WITH {CLIMATE_PANEL}, {JOINED} SELECT dt, client_id, {features(*FEATURE_SQL)} FROM joined"

SHORT_CALENDAR = (
    f"d AS (SELECT DISTINCT dt FROM clima), "
    f"calendario AS (SELECT dt, {calendar('day_of_week_name', 'month', 'tipo_feriado')} FROM d)"
)
GLOBAL_OF = (
    f"{JOINED}, features AS (SELECT dt, client_id, {features(*FEATURE_SQL)} FROM joined), "
    f"{SHORT_CALENDAR}, globals AS (SELECT * FROM features JOIN calendario USING (dt))"
)
GLOBAL = f"{CLIMATE_PANEL}, {GLOBAL_OF}"
CHECKS["global_table"] = f"WITH {GLOBAL} SELECT * FROM globals"
CHECKS["global_table_long"] = f"WITH {LONG_CLIMATE_PANEL}, {GLOBAL_OF} SELECT * FROM globals"
CHECKS["feature_table_stored_panel"] = f"""
WITH {LONG_CLIMATE_PANEL}, {JOINED} SELECT dt, client_id, {features(*FEATURE_SQL)} FROM joined"""
CHECKS["impute_climate_long"] = f"""
WITH {LONG_CLIMATE_PANEL} SELECT dt, region, {r6('temperature')} AS temperature, humidity FROM clima"""
NUMBERS = [name for name in FEATURE_SQL if name != "day_counter"]
CHECKS["null_fill"] = f"""
WITH {GLOBAL} SELECT dt, client_id, day_counter, day_of_week_name, month, tipo_feriado,
  {', '.join(f'COALESCE({name}, 0.0) AS {name}' for name in NUMBERS)} FROM globals"""
CHECKS["key_uniqueness"] = """
SELECT o_custkey AS client_id, CAST(o_orderdate AS DATE) AS dt, COUNT(*) AS rows
FROM orders GROUP BY 1, 2 HAVING COUNT(*) > 1"""

GAPS = f"{CLIENTS}, {CLIMATE}, {NEIGHBOURS}"
CHECKS["interpolate_linear"] = f"WITH {GAPS} SELECT region, dt, {r6(LINEAR)} AS temperature_linear FROM placed"
CHECKS["forward_fill"] = f"""
WITH {GAPS} SELECT region, dt, {r6('COALESCE(temperature, pv)')} AS temperature_ffill FROM placed"""
CHECKS["backward_fill"] = f"""
WITH {GAPS} SELECT region, dt, {r6('COALESCE(temperature, nv)')} AS temperature_bfill FROM placed"""
CHECKS["impute_climate"] = f"""
WITH {CLIMATE_PANEL} SELECT dt, region, {r6('temperature')} AS temperature, humidity FROM clima"""

CHECKS["distinct_dates"] = f"WITH {CLIENTS}, {CLIMATE} SELECT DISTINCT dt FROM clima_raw"
for key, names in {
    "calendar_parts": ["month", "week_of_year", "day_of_week", "day_of_year"],
    "calendar_flags": ["is_final_semana", "is_dia_util"],
    "calendar_season": ["estacao"],
    "calendar_holiday": ["is_feriado", "is_feriado_prolongado", "tipo_feriado"],
    "calendar_table": [
        "month", "week_of_year", "day_of_week", "day_of_year", "is_final_semana", "estacao", "is_feriado",
        "is_feriado_prolongado", "tipo_feriado", "is_dia_util", "day_of_week_name",
    ],
}.items():
    CHECKS[key] = f"WITH {LONG_DAYS} SELECT dt, {calendar(*names)} FROM d"
CHECKS["calendar_holiday_long_first"] = f"""
WITH {LONG_DAYS}, marked AS (SELECT dt, {calendar('is_feriado', 'is_feriado_prolongado')} FROM d)
SELECT dt, CASE WHEN is_feriado_prolongado THEN 'Feriado Prolongado' WHEN is_feriado THEN 'Feriado'
                ELSE 'Nenhum' END AS tipo_feriado FROM marked"""
# Days are added as whole numbers: DuckDB takes INTERVAL 30 DAY for equal to INTERVAL 1 MONTH and, when both
# are added to the same column, computes only one of the two.
CHECKS["period_shift"] = """
SELECT dt, CAST(dt + INTERVAL 1 MONTH AS DATE) AS plus_1_month, CAST(dt - INTERVAL 1 MONTH AS DATE) AS minus_1_month,
       CAST(dt + INTERVAL 24 MONTH AS DATE) AS plus_2_years, dt + 30 AS plus_30_days,
       dt - 14 AS minus_2_weeks,
       strftime(dt + INTERVAL 12 HOUR, '%Y-%m-%d %H:%M:%S') AS plus_12_hours
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS dt FROM orders)"""

CHECKS["holdout_split"] = f"""
WITH RECURSIVE {FOLD_PANEL}
SELECT client_id, dt, kwh AS total_consumption, CASE WHEN dt >= test_start THEN 'test' ELSE 'train_val' END AS split
FROM consumo, limits"""
CHECKS["fold_plan"] = f"WITH RECURSIVE {FOLD_PANEL} SELECT fold, train_start, train_end, val_end FROM folds"
ASSIGNED = """assigned AS (
  SELECT fold, 'train' AS split, client_id, dt FROM consumo JOIN folds ON dt < train_end
  UNION ALL
  SELECT fold, 'validation', client_id, dt FROM consumo JOIN folds ON dt >= train_end AND dt < val_end)"""
CHECKS["walk_forward_assign"] = f"WITH RECURSIVE {FOLD_PANEL}, {ASSIGNED} SELECT fold, split, client_id, dt FROM assigned"
CHECKS["fold_bounds"] = f"""
WITH RECURSIVE {FOLD_PANEL}, {ASSIGNED}
SELECT fold, split, MIN(dt) AS first_day, MAX(dt) AS last_day, COUNT(*) AS rows FROM assigned GROUP BY fold, split"""
CHECKS["fold_counts"] = f"""
WITH RECURSIVE {FOLD_PANEL}, {ASSIGNED}, counted AS (
  SELECT f.fold, COUNT(CASE WHEN split = 'train' THEN 1 END) AS train_rows,
         COUNT(CASE WHEN split = 'validation' THEN 1 END) AS val_rows
  FROM folds f LEFT JOIN assigned a ON a.fold = f.fold GROUP BY f.fold)
SELECT fold, train_rows, val_rows, train_rows > 0 AND val_rows > 0 AS usable FROM counted"""

CHECKS["metrics_global"] = f"WITH {LONG_PANEL} SELECT {ERRORS} FROM panel WHERE p IS NOT NULL"
CHECKS["client_metrics"] = f"""
WITH {LONG_PANEL}, scored AS (
  SELECT client_id, {MAE} AS mae, SQRT(AVG((y - p) * (y - p))) AS rmse, {r2()} AS r2
  FROM panel WHERE p IS NOT NULL GROUP BY client_id)
SELECT s_suppkey AS client_id, {r6('mae')} AS mae, {r6('rmse')} AS rmse, {r6('r2')} AS r2
FROM supplier LEFT JOIN scored ON client_id = s_suppkey"""
CHECKS["mase_pooled"] = f"""
WITH RECURSIVE {FOLD_PANEL}, {POOLED_STEPS}
SELECT fold, {r6('AVG(step)')} AS scale FROM folds JOIN pooled ON dt < train_end GROUP BY fold"""
CHECKS["mase_pooled_with_gaps"] = f"""
WITH RECURSIVE {FOLD_PANEL},
holed AS (SELECT dt, client_id, CASE WHEN (client_id + DAY(dt)) % 7 <> 0 THEN y END AS y FROM panel),
pooled AS (
  SELECT dt, ABS(y - LAG(y) OVER (ORDER BY dt, client_id)) AS step FROM holed WHERE y IS NOT NULL)
SELECT fold, {r6('AVG(step)')} AS scale FROM folds JOIN pooled ON dt < train_end GROUP BY fold"""
CHECKS["mase_by_series"] = f"""
WITH RECURSIVE {FOLD_PANEL},
scales AS (SELECT client_id, AVG(ABS(y - p)) AS scale FROM panel, limits WHERE dt < test_start GROUP BY client_id),
errors AS (
  SELECT client_id, {MAE} AS mae FROM panel, limits WHERE dt >= test_start AND p IS NOT NULL GROUP BY client_id)
SELECT client_id, {r6('mae')} AS mae, {r6('scale')} AS scale, {r6('mae / scale')} AS mase
FROM errors LEFT JOIN scales USING (client_id)"""
CHECKS["mean_client_std"] = f"""
WITH {LONG_PANEL} SELECT {r6('AVG(std)')} AS y_true_std
FROM (SELECT client_id, STDDEV_SAMP(y) AS std FROM panel GROUP BY client_id)"""
CHECKS["fold_metrics_naive"] = f"""
WITH RECURSIVE {FOLD_PANEL}, {POOLED_STEPS}, {FOLD_SCORES}
SELECT fold, {r6('mae')} AS mae, {r6('rmse')} AS rmse, {r6('r2')} AS r2, {r6('mape')} AS mape, {r6('mase')} AS mase
FROM fold_scores"""
CHECKS["fold_average_metrics"] = f"""
WITH RECURSIVE {FOLD_PANEL}, {POOLED_STEPS}, {FOLD_SCORES}
SELECT {', '.join(f"{r6(f'AVG({m})')} AS avg_{m}" for m in ('mae', 'rmse', 'r2', 'mape', 'mase'))} FROM fold_scores"""
CHECKS["test_evaluation"] = f"""
WITH RECURSIVE {FOLD_PANEL}, {POOLED_STEPS},
tested AS (SELECT panel.* FROM panel, limits WHERE dt >= test_start AND p IS NOT NULL),
scale AS (SELECT AVG(step) AS scale FROM pooled WHERE dt < (SELECT MAX(train_end) FROM folds)),
spread AS (SELECT AVG(std) AS std FROM (SELECT STDDEV_SAMP(y) AS std FROM tested GROUP BY client_id)),
overall AS (SELECT {ERRORS}, {MAE} AS exact FROM tested)
SELECT mae, rmse, r2, mape, {r6('exact / scale')} AS mase, {r6('std')} AS y_true_std,
       'Global' AS client_id, 'Naive lag 1' AS model
FROM overall, scale, spread"""

CHECKS["client_list"] = f"WITH {LONG_PANEL} SELECT DISTINCT client_id FROM panel ORDER BY client_id"
CHECKS["client_series"] = f"""
WITH {LONG_PANEL} SELECT client_id, dt, y AS total_consumption FROM panel WHERE client_id = 7 ORDER BY dt"""
CHECKS["series_long"] = f"""
WITH {LONG_PANEL} SELECT client_id, dt, 'total_consumption' AS variable, y AS value FROM panel
UNION ALL SELECT client_id, dt, 'prediction', p FROM panel"""
CHECKS["client_role_series"] = f"""
WITH {LONG_PANEL},
cuts AS (
  SELECT client_id, MIN(dt) AS first_day, CAST(MAX(dt) - INTERVAL 6 MONTH AS DATE) AS cut FROM panel GROUP BY client_id),
cut_rows AS (SELECT panel.*, cut, first_day FROM panel JOIN cuts USING (client_id))
SELECT client_id, dt, 'history' AS role, y AS value FROM cut_rows WHERE dt < cut OR first_day >= cut
UNION ALL SELECT client_id, dt, 'test', y FROM cut_rows WHERE dt >= cut
UNION ALL SELECT client_id, dt, 'prediction', p FROM cut_rows WHERE dt >= cut"""
CHECKS["category_index"] = f"""
WITH {GLOBAL}
SELECT DISTINCT 'client_id' AS variable, CAST(client_id AS VARCHAR) AS value,
       DENSE_RANK() OVER (ORDER BY client_id) - 1 AS idx FROM globals
UNION ALL SELECT DISTINCT 'tipo_feriado', tipo_feriado, DENSE_RANK() OVER (ORDER BY tipo_feriado) - 1 FROM globals
UNION ALL SELECT DISTINCT 'day_of_week_name', CAST(day_of_week_name AS VARCHAR),
       DENSE_RANK() OVER (ORDER BY day_of_week_name) - 1 FROM globals
UNION ALL SELECT DISTINCT 'month', CAST(month AS VARCHAR), DENSE_RANK() OVER (ORDER BY month) - 1 FROM globals"""

_COUNTED = " UNION ALL ".join(
    f"SELECT '{name}' AS variable, CAST({name} AS VARCHAR) AS value, COUNT(*) AS n, SUM(mean - y0) AS g FROM known GROUP BY {name}"
    for name in ("client_id", "tipo_feriado", "day_of_week_name", "month")
)
_KNOWN = f"{GLOBAL}, known AS (SELECT *, COALESCE(total_consumption, 0) AS y0, AVG(COALESCE(total_consumption, 0)) OVER () AS mean FROM globals)"
CHECKS["category_bins"] = f"""
WITH {_KNOWN}, counted AS ({_COUNTED})
SELECT variable, value, ROW_NUMBER() OVER (PARTITION BY variable ORDER BY n DESC, value NULLS FIRST) AS bin FROM counted"""
CHECKS["root_splits"] = f"""
WITH {_KNOWN}, counted AS ({_COUNTED}),
cells AS (
  SELECT variable, value, n, g, n >= 10 AS usable, g / (n + 10) AS place, 10 AS l2 FROM counted
  UNION ALL
  SELECT 'day_counter', CAST(day_counter AS VARCHAR), COUNT(*), SUM(mean - y0), TRUE, day_counter, 0 FROM known GROUP BY day_counter),
ranked AS (
  SELECT variable, usable, l2, SUM(g) OVER w AS gl, SUM(n) OVER w AS nl, SUM(g) OVER (PARTITION BY variable) AS ga, SUM(n) OVER (PARTITION BY variable) AS na
  FROM cells WINDOW w AS (PARTITION BY variable ORDER BY NOT usable, place, value ROWS UNBOUNDED PRECEDING)),
told AS (
  SELECT variable, nl, na - nl AS nr, gl * gl / (nl + l2) + (ga - gl) * (ga - gl) / (na - nl + l2) - ga * ga / (na + l2) AS gain
  FROM ranked WHERE usable AND nl >= 20 AND na - nl >= 20)
SELECT variable, ROUND(MAX(gain) / (SELECT SUM((y0 - mean) * (y0 - mean)) FROM known), 6) AS gain_share,
  CAST(ARG_MAX(nl, gain) AS BIGINT) AS left_rows, CAST(ARG_MAX(nr, gain) AS BIGINT) AS right_rows
FROM told GROUP BY variable HAVING MAX(gain) > 1e-12"""

CHECKS["latest_run"] = f"""
WITH {RUNS} SELECT run_id, name, start_dt, seq FROM runs WHERE name = '5-LOW' ORDER BY start_dt DESC, seq DESC LIMIT 1"""
CHECKS["run_children"] = """
SELECT CONCAT('r', l_orderkey, '_', l_linenumber) AS run_id, CONCAT('r', l_orderkey) AS parent_run_id, o_orderpriority AS parent_name,
  CONCAT('Fold_', l_linenumber) AS name, CAST(l_linenumber AS INTEGER) AS fold, start_dt
FROM (SELECT l_orderkey, l_linenumber, CAST(MIN(l_shipdate) AS DATE) AS start_dt FROM lineitem GROUP BY l_orderkey, l_linenumber) AS lines
JOIN orders ON o_orderkey = l_orderkey"""
CHECKS["newest_child_run"] = f"""
WITH {RUNS}, placed AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY parent_run_id ORDER BY start_dt DESC, run_id DESC) AS place
  FROM runs WHERE parent_run_id IS NOT NULL)
SELECT parent_run_id, run_id, name FROM placed WHERE place = 1"""
CHECKS["run_feature_list"] = """
SELECT o_orderkey, o_orderpriority AS first_name, o_orderstatus AS second_name, CAST(2 AS BIGINT) AS listed FROM orders"""
CHECKS["run_log"] = " UNION ALL ".join(
    f"SELECT fold, 'FINISHED' AS status, '{name}' AS key, {name} AS value FROM ({CHECKS['fold_metrics_naive']}) AS s"
    for name in ("mae", "rmse", "r2", "mape", "mase")
)

ELEMENTS = {
    "client_id": r6("AVG(y0) OVER (PARTITION BY client_id)"),
    **{name: f"COALESCE({name}, 0)" for name in (
        "avg_temperature", "avg_humidity", "temp_humid_interaction", "day_counter", "consumption_lag_1",
        "consumption_lag_2", "consumption_lag_3", "consumption_lag_4", "consumption_lag_7", "consumption_lag_15",
    )},
    **{name: f"DENSE_RANK() OVER (ORDER BY {name}) - 1" for name in ("tipo_feriado", "day_of_week_name", "month")},
    **{name: f"COALESCE({name}, 0)" for name in (
        "rolling_mean_3", "rolling_std_3", "rolling_mean_7", "rolling_std_7", "diff_lag_1",
    )},
}
CHECKS["feature_vector"] = f"""
WITH {GLOBAL}, filled AS (SELECT *, COALESCE(total_consumption, 0) AS y0 FROM globals)
""" + " UNION ALL ".join(
    f"SELECT client_id, dt, CAST({position} AS BIGINT) AS position, CAST({element} AS DOUBLE) AS value FROM filled"
    for position, element in enumerate(ELEMENTS.values())
)

# Scores have no SQL, but which rows are scored does.
TESTED = f"WITH RECURSIVE {FOLD_PANEL}, tested AS (SELECT consumo.* FROM consumo, limits WHERE dt >= test_start)"
CHECKS["batch_score_complete"] = f"{TESTED} SELECT client_id, dt, kwh AS total_consumption, TRUE AS scored FROM tested"
CHECKS["batch_score"] = f"{TESTED} SELECT client_id, dt, TRUE AS scored FROM tested"
CHECKS["prediction_preview"] = f"{TESTED} SELECT client_id, dt, kwh AS total_consumption, TRUE AS scored FROM tested ORDER BY dt, client_id LIMIT 5"
CHECKS["model_roundtrip"] = f"{TESTED} SELECT client_id, dt, TRUE AS same_score FROM tested"
