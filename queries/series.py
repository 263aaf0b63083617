"""Grid, lags, rolling statistics, targets and z-score alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import (
    EV, GRID, RH, SENSORS, event_readings, query, readings_h, rounded, s6, table, with_views,
)
from sensorspark import constants as K
from sensorspark.functions.times import floor_to
from sensorspark.operators import alerts, features, grid
from sensorspark.operators.series import over_series

_LAGS, _WINDOWS = K.LAGS["hourly"], K.WINDOWS["hourly"]


def _z_sql(pollutant, window=24, threshold=2.0):
    least = max(3, window // 4)
    frame = f"OVER (PARTITION BY region ORDER BY date_time ROWS BETWEEN {window} PRECEDING AND 1 PRECEDING)"
    return f"""SELECT region, date_time, '{pollutant}' AS pollutant, {s6('v', 'value')}, {s6('(v - m) / nullif(s, 0)', 'z_score')}
FROM (SELECT region, date_time, {pollutant} AS v,
  CASE WHEN count({pollutant}) {frame} >= {least} THEN avg({pollutant}) {frame} END AS m,
  CASE WHEN count({pollutant}) {frame} >= {least} THEN stddev_samp({pollutant}) {frame} END AS s FROM readings_h)
WHERE abs((v - m) / nullif(s, 0)) >= {threshold}"""


@query("rolling_zscore_alerts", with_views(EV, RH, tail=" UNION ALL ".join(_z_sql(t) for t in K.TARGETS)))
def rolling_zscore_alerts(spark, folder):
    found = alerts.rolling_zscore_alerts(readings_h(spark, folder), K.TARGETS, window=24, threshold=2.0)
    return rounded(found, "value", "z_score")


@query("regular_grid", with_views(EV, RH, GRID, tail=f"SELECT region, date_time, 'hourly' AS granularity, observed_row, {s6('pm2_5', 'pm2_5')} FROM grid"))
def regular_grid(spark, folder):
    out = grid.regular_grid(readings_h(spark, folder), "hourly")
    return rounded(out.select("region", "date_time", "granularity", "observed_row", "pm2_5"), "pm2_5")


def _stations(spark, folder):
    ev = event_readings(table(spark, folder, "events"))
    named = F.when(F.col("event_id") % 23 == 0, F.concat(F.lit("S"), (F.col("user_id") % 3).cast("string")))
    return ev.groupBy("region", floor_to(F.col("date_time"), 3600).alias("date_time")).agg(
        F.max(named).alias("station_name"))


_STATIONS = """named AS (
  SELECT region, date_trunc('hour', date_time) AS date_time, max(CASE WHEN event_id % 23 = 0 THEN 'S' || (user_id % 3) END) AS station_name
  FROM ev GROUP BY 1, 2),
spine AS (
  SELECT region, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS date_time
  FROM (SELECT region, min(date_time) AS a, max(date_time) AS b FROM named GROUP BY 1)),
holes AS (SELECT region, date_time, station_name FROM spine LEFT JOIN named USING (region, date_time))"""


@query("station_fill", with_views(EV, _STATIONS, tail="""
SELECT region, date_time, coalesce(
  last_value(station_name IGNORE NULLS) OVER (PARTITION BY region ORDER BY date_time ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  first_value(station_name IGNORE NULLS) OVER (PARTITION BY region ORDER BY date_time ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS station_name
FROM holes"""))
def station_fill(spark, folder):
    return grid.regular_grid(_stations(spark, folder), "hourly").select("region", "date_time", "station_name")


def _on_grid(spark, folder, build, back, ahead=0):
    return over_series(grid.regular_grid(readings_h(spark, folder), "hourly"), build, step=3600, back=back, ahead=ahead)


@query("lag_features", with_views(EV, RH, GRID, tail="SELECT region, date_time, " + ", ".join(
    s6(f"lag({c}, {k}) OVER w", f"{c}_lag_{k}") for c in SENSORS for k in _LAGS)
    + " FROM grid WINDOW w AS (PARTITION BY region ORDER BY date_time)"))
def lag_features(spark, folder):
    out = _on_grid(spark, folder, lambda w: features.lag_columns(w, SENSORS, _LAGS), max(_LAGS))
    names = [f"{c}_lag_{k}" for c in SENSORS for k in _LAGS]
    return rounded(out.select("region", "date_time", *names), *names)


def _frame(w, least, f, c):
    over = f"OVER (PARTITION BY region ORDER BY date_time ROWS BETWEEN {w} PRECEDING AND 1 PRECEDING)"
    return s6(f"CASE WHEN count({c}) {over} >= {least} THEN {f}({c}) {over} END")


_ROLLED = ("pm2_5", "pm10", "so2", "temp", "hum", "ws")


@query("rolling_features", with_views(EV, RH, GRID, tail="SELECT region, date_time, " + ", ".join(
    f"{_frame(w, max(2, w // 2), f, c)} AS {c}_roll_{n}_{w}"
    for c in _ROLLED for w in _WINDOWS for n, f in (("mean", "avg"), ("std", "stddev_samp"))) + " FROM grid"))
def rolling_features(spark, folder):
    out = _on_grid(spark, folder, lambda w: features.rolling_columns(w, _ROLLED, _WINDOWS), max(_WINDOWS))
    names = [c for c in out.columns if "_roll_" in c]
    return rounded(out.select("region", "date_time", *names), *names)


@query("next_step_targets", with_views(EV, RH, GRID, tail="SELECT region, date_time, lead(observed_row, 3) OVER w AS observed_future, "
       + ", ".join(s6(f"lead({t}, 3) OVER w", f"target_{t}") for t in K.TARGETS)
       + " FROM grid WINDOW w AS (PARTITION BY region ORDER BY date_time)"))
def next_step_targets(spark, folder):
    out = _on_grid(spark, folder, lambda w: features.target_columns(w, K.TARGETS, 3), 0, 3)
    names = [f"target_{t}" for t in K.TARGETS]
    return rounded(out.select("region", "date_time", "observed_future", *names), *names)


@query("group_lag", with_views(EV, RH, tail="SELECT region, date_time, " + ", ".join(
    s6(f"lag({c}, {k}) OVER w", f"{c}_lag_{k}") for c in ("pm2_5", "pm10") for k in (1, 6))
    + " FROM readings_h WINDOW w AS (PARTITION BY region ORDER BY date_time)"))
def group_lag(spark, folder):
    out = features.add_group_lags(readings_h(spark, folder), ["pm2_5", "pm10", "absent"], [1, 6])
    names = [f"{c}_lag_{k}" for c in ("pm2_5", "pm10") for k in (1, 6)]
    return rounded(out.select("region", "date_time", *names), *names)


@query("rolling_min_max", with_views(EV, RH, tail="SELECT region, date_time, " + ", ".join(
    [s6(f"lag(ws, {k}) OVER (PARTITION BY region ORDER BY date_time)", f"ws_lag_{k}") for k in K.SHORT_LAGS]
    + [f"{_frame(w, w, f, 'ws')} AS ws_rolling_{n}_{w}" for w in K.SHORT_WINDOWS for n, f in (("mean", "avg"), ("std", "stddev_samp"))]
    + [f"{_frame(24, 24, f, 'ws')} AS ws_rolling_{f}_24" for f in ("min", "max")]) + " FROM readings_h"))
def rolling_min_max(spark, folder):
    out = features.add_short_history(readings_h(spark, folder).select("region", "date_time", "ws"), ["ws"])
    return rounded(out.drop("ws"), *[c for c in out.columns if c.startswith("ws_")])


@query("cold_start_features", with_views(EV, RH, tail=f"""
SELECT region, date_time, CAST(year(date_time) AS INT) AS year, CAST(hour(date_time) AS INT) AS hour, {s6('pm2_5', 'pm2_5')}, {s6('pm2_5', 'pm2_5_lag_24')},
  {s6('so2', 'so2_roll_mean_3')}, CASE WHEN so2 IS NOT NULL THEN 0.0::DOUBLE END AS so2_roll_std_3, {s6('sin(radians(wd))', 'wd_sin')},
  CAST(region = 'AIIMS' AS INT) AS region_AIIMS, CAST(region = 'SILTARA' AS INT) AS region_SILTARA, CAST(NULL AS DOUBLE) AS unknown_feature
FROM readings_h"""))
def cold_start_features(spark, folder):
    names = ["year", "hour", "pm2_5", "pm2_5_lag_24", "so2_roll_mean_3", "so2_roll_std_3", "wd_sin", "region_AIIMS",
             "region_SILTARA", "unknown_feature"]
    out = features.cold_start_features(readings_h(spark, folder), names, keep=("region", "date_time"))
    return rounded(out, "pm2_5", "pm2_5_lag_24", "so2_roll_mean_3", "wd_sin")


@query("trend_spike", with_views(EV, RH, """trend AS (
  SELECT region, date_time, pm10, CASE WHEN count(pm10) OVER w >= 12 THEN avg(pm10) OVER w END AS m,
         CASE WHEN count(pm10) OVER w >= 12 THEN greatest(stddev_samp(pm10) OVER w, 1e-6) END AS s
  FROM readings_h WINDOW w AS (PARTITION BY region ORDER BY date_time ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING))""", tail="""
SELECT region, date_time, pm10 > m + 2 * s AS is_spike,
  CASE WHEN pm10 > m + 3 * s THEN 'High' WHEN pm10 > m + 2 * s THEN 'Medium' ELSE 'Normal' END AS severity,
  round((CASE WHEN m > 0 THEN pm10 / m ELSE 0 END) + 1e-9, 2) AS spike_ratio,
  CASE WHEN pm10 > m + 2 * s THEN 'PM10 is significantly above recent trend. Monitor exposure and verify sensor readings.'
       ELSE 'PM10 is within the expected recent trend range.' END AS message
FROM trend WHERE pm10 IS NOT NULL AND m IS NOT NULL AND s IS NOT NULL"""))
def trend_spike(spark, folder):
    out = alerts.trend_alerts(readings_h(spark, folder), "pm10", label="PM10").where(F.col("spike").isNotNull())
    return out.select("region", "date_time", "spike.is_spike", "spike.severity",
                      F.round(F.col("spike.spike_ratio") + 1e-9, 2).alias("spike_ratio"), "spike.message")
