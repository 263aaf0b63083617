"""Risk bands, threshold alerts, rule-based forecast and report texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from queries.common import EV, RH, event_readings, query, r6, readings_h, s6, table, with_views
from sensorspark import constants as K
from sensorspark.functions import alerts, narrative, risk
from sensorspark.functions.rules import rule_forecast
from sensorspark.functions.text import target_label
from sensorspark.operators.selector import model_selector
from sensorspark.plans import flows


def _targets():
    return {t: F.col(t) for t in K.TARGETS}


_ZERO = ", ".join(f"coalesce({t}, 0) AS {t}0" for t in K.TARGETS)


def _score_sql(a="pm2_50", b="pm100", c="so20"):
    parts = " ".join(f"WHEN {a} > {x} OR {b} > {y} OR {c} > {z} THEN {level}"
                     for level, (x, y, z) in sorted(K.RISK_FLOORS.items(), reverse=True))
    return f"CASE {parts} ELSE 1 END"


def _attr_sql(score, position):
    return "CASE " + score + " " + " ".join(f"WHEN {r[0]} THEN '{r[position]}'" for r in K.RISK_LEVELS) + " END"


_SCORED = f"""zeroed AS (SELECT *, {_ZERO} FROM readings_h),
scored AS (SELECT *, {_score_sql()} AS score,
  concat_ws(',', CASE WHEN pm2_50 > 35 THEN 'PM2.5' END, CASE WHEN pm100 > 100 THEN 'PM10' END, CASE WHEN so20 > 18 THEN 'SO2' END) AS over FROM zeroed)"""


@query("risk_4_level", with_views(EV, RH, _SCORED, tail=f"""
SELECT region, date_time, score, {_attr_sql('score', 1)} AS category, {_attr_sql('score', 2)} AS risk_level, {_attr_sql('score', 3)} AS color,
  {_attr_sql('score', 4)} AS recommendation, coalesce(nullif(over, ''), 'All tracked pollutants') AS drivers FROM scored"""))
def risk_4_level(spark, folder):
    rated = readings_h(spark, folder).withColumn("risk", risk.risk_four_level(*_targets().values()))
    return rated.select("region", "date_time", "risk.score", "risk.category", "risk.risk_level", "risk.color",
                        "risk.recommendation", F.array_join("risk.drivers", ",").alias("drivers"))


def _band_sql(position):
    whens = " ".join(f"WHEN pm2_50 <= {b[0][0]} AND pm100 <= {b[0][1]} AND so20 <= {b[0][2]} THEN '{b[position]}'"
                     for b in K.RISK_BANDS if b[0])
    return f"CASE {whens} ELSE '{K.RISK_BANDS[-1][position]}' END"


@query("risk_5_level", with_views(EV, RH, _SCORED, tail=f"""
SELECT region, date_time, {_band_sql(1)} AS category, {_band_sql(2)} AS risk_level, {_band_sql(3)} AS color, {_band_sql(4)} AS message,
  '{K.RISK_DISCLAIMER}' AS disclaimer FROM scored"""))
def risk_5_level(spark, folder):
    rated = readings_h(spark, folder).withColumn("risk", risk.risk_five_level(*_targets().values()))
    return rated.select("region", "date_time", "risk.category", "risk.risk_level", "risk.color", "risk.message", "risk.disclaimer")


@query("risk_lookup", f"""
WITH s AS (SELECT event_id, CAST(event_id % 7 AS INT) - 1 AS score,
  list_extract(['good', ' MODERATE ', 'Poor', 'severe', 'strange'], CAST(event_id % 5 AS INT) + 1) AS name FROM events)
SELECT event_id, {_attr_sql('greatest(1, least(4, score))', 1)} AS category,
  CASE lower(trim(name)) WHEN 'good' THEN 'Low' WHEN 'poor' THEN 'High' WHEN 'severe' THEN 'Very High' ELSE 'Elevated' END AS risk_level,
  CASE lower(trim(name)) WHEN 'good' THEN '{K.RISK_LEVELS[0][4]}' WHEN 'poor' THEN '{K.RISK_LEVELS[2][4]}' WHEN 'severe' THEN '{K.RISK_LEVELS[3][4]}' ELSE '{K.RISK_LEVELS[1][4]}' END AS recommendation
FROM s""")
def risk_lookup(spark, folder):
    names = F.array(*[F.lit(n) for n in ("good", " MODERATE ", "Poor", "severe", "strange")])
    ev = table(spark, folder, "events").select(
        "event_id", (F.pmod("event_id", F.lit(7)) - 1).cast("int").alias("score"),
        F.element_at(names, (F.pmod("event_id", F.lit(5)) + 1).cast("int")).alias("name"))
    return ev.select("event_id", risk.category_of_score(F.col("score")).alias("category"),
                     risk.category_attribute(F.col("name"), "risk_level").alias("risk_level"),
                     risk.category_attribute(F.col("name"), "recommendation").alias("recommendation"))


def _alert_sql(thresholds, message, source="readings_h"):
    return " UNION ALL ".join(
        f"""SELECT region, date_time, '{p}' AS pollutant, round({p}, 3) AS value, {t}::DOUBLE AS threshold,
  CASE WHEN {p} >= {t} * 1.25 THEN 'high' ELSE 'elevated' END AS severity, '{message(p)}' AS message FROM {source} WHERE {p} >= {t}"""
        for p, t in thresholds.items())


@query("spike_alerts", with_views(EV, RH, tail=_alert_sql(
    {**K.SPIKE_THRESHOLDS, "so2": 60.0}, lambda p: f"{p.upper()} is unusually high for this demo threshold.")))
def spike_alerts(spark, folder):
    found = alerts.spike_alerts(_targets(), thresholds={"so2": 60.0})
    return readings_h(spark, folder).select("region", "date_time", F.inline(found))


def _rule_values():
    return {c: F.col(c) for c in (*K.TARGETS, "temp", "hum", "ws")}


def with_rule_forecast(spark, folder):
    rows = readings_h(spark, folder)
    forecast = rule_forecast(F.col("region"), _rule_values(), F.hour("date_time"), F.month("date_time"))
    return rows.withColumns({f"{t}_forecast": c for t, c in forecast.items()})


def _rule_sql(target):
    position = K.TARGETS.index(target)
    offset = "CASE region " + " ".join(f"WHEN '{r}' THEN {K.RULE_OFFSETS[r][position]}" for r in K.REGIONS) + " END"
    terms = " + ".join(f"({signal}_s) * ({w})" for signal, w in K.RULE_WEIGHTS[target].items())
    return f"CAST(greatest(0, least({K.RULE_UPPER[target]}, CAST({offset} AS DOUBLE) + {terms})) AS DOUBLE) AS {target}_forecast"


RULES = """signals AS (
  SELECT *, coalesce(pm2_5, 0) AS pm2_5_s, coalesce(pm10, 0) AS pm10_s, coalesce(so2, 0) AS so2_s,
    CAST(CASE WHEN hour(date_time) BETWEEN 17 AND 21 THEN 1.0 WHEN hour(date_time) BETWEEN 7 AND 10 THEN 0.7 ELSE 0 END AS DOUBLE) AS rush_s,
    CAST(CASE WHEN hour(date_time) >= 22 OR hour(date_time) <= 5 THEN 0.55 ELSE 0 END AS DOUBLE) AS night_s,
    CAST(CASE WHEN month(date_time) >= 11 OR month(date_time) <= 2 THEN 1 ELSE 0 END AS DOUBLE) AS winter_s,
    greatest(0, coalesce(hum, 0) - 55) / 18 AS humid_s, least(coalesce(ws, 0), 10) / 4 AS wind_s, greatest(0, coalesce(temp, 0) - 32) / 10 AS heat_s
  FROM readings_h),
ruled AS (SELECT *, """ + ", ".join(_rule_sql(t) for t in K.TARGETS) + " FROM signals)"


@query("rule_forecast", with_views(EV, RH, RULES, tail="SELECT region, date_time, " + ", ".join(
    s6(f"{t}_forecast", f"{t}_forecast") for t in K.TARGETS) + " FROM ruled"))
def rule_forecast_query(spark, folder):
    return with_rule_forecast(spark, folder).select(
        "region", "date_time", *[r6(f"{t}_forecast").alias(f"{t}_forecast") for t in K.TARGETS])


@query("combined_alert_review", with_views(EV, RH, RULES, """fa AS (SELECT region, date_time, pollutant, 1 AS priority, value, severity FROM ("""
       + _alert_sql(K.SPIKE_THRESHOLDS, str, """(SELECT region, date_time, pm2_5_forecast AS pm2_5, pm10_forecast AS pm10, so2_forecast AS so2 FROM ruled)""")
       + ")), ra AS (SELECT region, date_time, pollutant, 2 AS priority, value, severity FROM ("
       + _alert_sql(K.REVIEW_THRESHOLDS, str) + "))", tail="""
SELECT region, date_time, pollutant, CASE priority WHEN 1 THEN 'forecast' ELSE 'reading' END AS origin, round(value + 1e-9, 3) AS value, severity
FROM (SELECT *, row_number() OVER (PARTITION BY region, date_time, pollutant ORDER BY priority) AS n FROM (SELECT * FROM fa UNION ALL SELECT * FROM ra))
WHERE n = 1"""))
def combined_alert_review(spark, folder):
    rows = with_rule_forecast(spark, folder)
    forecast = alerts.spike_alerts({t: F.col(f"{t}_forecast") for t in K.TARGETS})
    merged = alerts.combined_review(forecast, alerts.review_alerts(_targets()))
    out = rows.select("region", "date_time", F.inline(merged))
    origin = F.when(F.contains("message", F.lit("review threshold")), F.lit("reading")).otherwise(F.lit("forecast"))
    return out.select("region", "date_time", "pollutant", origin.alias("origin"), F.round(F.col("value") + 1e-9, 3).alias("value"), "severity")


def _watch_sql():
    words = {"pm2_5": "PM2.5 elevated at ", "pm10": "PM10 spike watch at ", "so2": "SO2 elevated at "}
    return "concat_ws('; ', " + ", ".join(
        f"CASE WHEN greatest({t}_s, {t}_forecast) >= {limit} THEN '{words[t]}' || printf('%.1f', floor(greatest({t}_s, {t}_forecast) * 10 + 0.5) / 10) || ' ug/m3' END"
        for t, limit in K.REVIEW_THRESHOLDS.items()) + ")"


@query("rule_watch", with_views(EV, RH, RULES, tail=f"""
SELECT region, date_time, {_watch_sql()} AS watch, CASE WHEN pm10_forecast >= pm2_5_forecast * 1.8 THEN 'PM10 lag features' ELSE 'PM2.5 trend features' END AS driver,
  CASE WHEN coalesce(ws, 0) <= 2.5 THEN 'Low wind stagnation' ELSE 'Wind dispersion relief' END AS weather FROM ruled"""))
def rule_watch(spark, folder):
    rows = with_rule_forecast(spark, folder)
    forecasts = {t: F.col(f"{t}_forecast") for t in K.TARGETS}
    return rows.select("region", "date_time", F.array_join(alerts.watch_list(_targets(), forecasts), "; ").alias("watch"),
                       alerts.primary_driver(forecasts["pm2_5"], forecasts["pm10"]).alias("driver"),
                       alerts.weather_signal(F.col("ws")).alias("weather"))


# --- texts -----------------------------------------------------------------

_EVENT_SCORED = f"""ez AS (SELECT *, coalesce(value, 0) AS pm2_50, coalesce(value * 2.5, 0) AS pm100, coalesce(value * 0.4::DOUBLE, 0) AS so20 FROM ev),
es AS (SELECT *, {_score_sql()} AS score FROM ez)"""


def _event_values():
    return {"pm2_5": F.col("value"), "pm10": F.col("value") * 2.5, "so2": F.col("value") * 0.4}


@query("forecast_summary_text", with_views(EV, _EVENT_SCORED, tail=f"""
SELECT event_id, 'Predicted PM2.5 is ' || printf('%.1f', pm2_50) || ', PM10 is ' || printf('%.1f', pm100) || ', and SO2 is ' || printf('%.1f', so20)
  || '. The project AQI-style category is ' || {_attr_sql('score', 1)} || ' with ' || lower({_attr_sql('score', 2)}) || ' risk. ' || {_attr_sql('score', 4)} AS summary
FROM es"""))
def forecast_summary_text(spark, folder):
    ev = event_readings(table(spark, folder, "events"))
    return ev.select("event_id", narrative.forecast_summary(_event_values()).alias("summary"))


@query("forecast_report_text", with_views(EV, _EVENT_SCORED, tail=f"""
SELECT event_id, 'This report is generated using a rule-based NLP-style summarization template.

Today''s forecast for ' || upper(region[1]) || lower(region[2:]) || ' indicates PM2.5 at ' || printf('%.1f', pm2_50) || ' ug/m3, PM10 at ' || printf('%.1f', pm100)
  || ' ug/m3, and SO2 at ' || printf('%.1f', so20) || ' ug/m3. The AQI-style risk category is ' || {_band_sql(1)}
  || '. The hybrid model selected ' || CASE WHEN region IN ('AIIMS', 'IGKV') THEN 'Region-specific single-target' ELSE 'Global single-target fallback' END
  || ' because local pollution behavior is important for this forecast. The prediction is mainly influenced by recent PM10 history, rolling pollution averages, region-specific trends. '
  || CASE WHEN pm100 > 120 THEN 'The anomaly detection module also identified abnormal pollutant behavior compared to recent trends.'
          ELSE 'The anomaly detection module did not flag a major spike for this scenario.' END || ' ' || {_band_sql(4)} AS report
FROM es"""))
def forecast_report_text(spark, folder):
    ev = event_readings(table(spark, folder, "events"))
    values = _event_values()
    rated = risk.risk_five_level(*values.values())
    spike = alerts.trend_spike(values["pm10"], F.lit(80.0), F.lit(20.0), F.lit("PM10"))
    chosen = model_selector(F.col("region"), target_label(F.lit("pm2_5")))
    features = F.array(*[F.lit(f) for f in K.DEFAULT_REPORT_FEATURES])
    report = narrative.air_quality_report(F.col("region"), values, rated["category"], rated["message"],
                                          spike["is_spike"], features, chosen["strategy"])
    return ev.select("event_id", report.alias("report"))


@query("forecast_json", with_views(EV, RH, RULES, f"""r AS (
  SELECT region, date_time, {", ".join(f"round({t}_forecast + 1e-9, 3) AS {t}" for t in K.TARGETS)} FROM ruled)""", tail="""
SELECT region, date_time, pm2_5, pm10, so2, 'true' AS parses FROM r"""))
def forecast_json(spark, folder):
    rows = with_rule_forecast(spark, folder).select(
        "region", "date_time", *[F.round(F.col(f"{t}_forecast") + 1e-9, 3).alias(t) for t in K.TARGETS])
    text = flows.to_json(flows.present_forecast(rows, _targets()))
    schema = "region string, date_time timestamp_ntz, pm2_5 double, pm10 double, so2 double, summary string"
    back = text.select(F.from_json("json", schema).alias("j")).select("j.*")
    return back.select("region", "date_time", *K.TARGETS, F.col("summary").isNotNull().cast("string").alias("parses"))
