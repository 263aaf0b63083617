import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions import alerts, narrative, numeric, requests, risk, rules, text, times
from sensorspark.operators import selector


def one(spark, column, **values):
    frame = spark.range(1).select(*[v.alias(k) if hasattr(v, "alias") else F.lit(v).alias(k) for k, v in values.items()] or [F.lit(1)])
    return frame.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("raw", "expected"), [
    ("01-Jan-2024 10:00", "2024-01-01 10:00:00"), ("1 January 2024", "2024-01-01 00:00:00"), ("05/03/2024 02:30 PM", "2024-03-05 14:30:00"),
    ("20240305", "2024-03-05 00:00:00"), ("20240305T101530", "2024-03-05 10:15:30"), ("Feb 5, 2024 3 am", "2024-02-05 03:00:00"),
    ("3-Sept-24 12:00 AM", "2024-09-03 00:00:00"), ("31-Apr-2024", None), ("05/03/2024 13:30 PM", None), ("may", None)])
def test_dates_with_names_half_days_and_no_separators(spark, raw, expected):
    got = one(spark, times.parse_datetime(F.lit(raw)))
    assert (str(got) if got else None) == expected


@pytest.mark.parametrize("triple,category", [
    ((18, 55, 8), "Good"), ((45, 120, 22), "Moderate"), ((70, 180, 30), "Poor"), ((95, 260, 45), "Severe"),
    ((20, 60, 8), "Good"), ((45, 110, 19), "Moderate"),
])
def test_four_level_categories(spark, triple, category):
    row = one(spark, risk.risk_four_level(*[F.lit(v) for v in triple]))
    assert row["category"] == row["label"] == category and row["recommendation"]


def test_risk_edges_are_strict(spark):
    for at, above, level in ((35.0, 35.0 + 1e-9, 2), (60.0, 60.0 + 1e-9, 3), (90.0, 90.0 + 1e-9, 4)):
        assert one(spark, risk.risk_score(F.lit(at), F.lit(0), F.lit(0))) == level - 1
        assert one(spark, risk.risk_score(F.lit(above), F.lit(0), F.lit(0))) == level


@pytest.mark.parametrize("value", [None, float("nan"), "text", ""])
def test_unreadable_readings_count_as_zero(spark, value):
    bad = F.lit(value)
    assert one(spark, risk.risk_four_level(bad, bad, bad))["drivers"] == [K.NO_DRIVER_TEXT]
    assert one(spark, risk.risk_five_level(bad, bad))["category"] == "Good"


def test_five_level_ceilings_are_inclusive(spark):
    assert one(spark, risk.risk_five_level(F.lit(30), F.lit(50), F.lit(15)))["category"] == "Good"
    assert one(spark, risk.risk_five_level(F.lit(30), F.lit(50.1), F.lit(15)))["category"] == "Moderate"
    assert one(spark, risk.risk_five_level(F.lit(121), F.lit(0), F.lit(0)))["category"] == "Severe"


def test_category_lookup(spark):
    assert [one(spark, risk.category_of_score(F.lit(s))) for s in (-3, 1, 4, 9)] == ["Good", "Good", "Severe", "Severe"]
    assert one(spark, risk.category_attribute(F.lit("odd"), "recommendation")) == K.RISK_LEVELS[1][4]


@pytest.mark.parametrize("raw,name", [
    ("PM2.5 (ug/m3)", "pm2_5"), ("Pm 10", "pm10"), ("NOx", "n_ox"), ("NOX ppb", "nox"), ("DateTime", "date_time"),
    ("Date & Time", "date_time"), ("Date and Time Stamp", "date_time"), ("Temp %", "temp"), ("noise", "no"),
    ("CO2", "co2"), ("coarse", "co"), ("windSpeed", "wind_speed"), ("   ", None), (None, None), ("***", None),
    ("no2_raw", "no2"), ("Hum1", "hum1"),
])
def test_header_names(spark, raw, name):
    assert one(spark, text.normalize_header(F.lit(raw).cast("string"))) == name


def test_repeated_headers_are_numbered(spark):
    names = spark.createDataFrame([(["pm10", "x", "pm10", "", "pm10"],)], "n array<string>")
    assert names.select(text.number_repeats(F.col("n"))).first()[0] == ["pm10", "x", "pm10_2", None, "pm10_3"]


@pytest.mark.parametrize("raw,name", [("siltara", "SILTARA"), ("DCR AIIMS", "AIIMS"), (" igkv dcr", "IGKV"), ("UNKNOWN", None)])
def test_region_names(spark, raw, name):
    assert one(spark, text.normalize_region(F.lit(raw))) == name


def test_strict_region_raises(spark):
    with pytest.raises(Exception, match="unknown region"):
        one(spark, text.normalize_region(F.col("r"), strict=True), r="UNKNOWN")


def test_granularity_rules(spark):
    assert one(spark, text.granularity(F.lit("Hourly"), F.lit("y2015.xlsx"))) == "quarter_hourly"
    assert one(spark, text.granularity(F.lit("Hourly"), F.lit("y2015.xlsx"), strict=True)) == "hourly"
    assert one(spark, text.granularity(F.lit("15 Min"), F.lit("a.xlsx"), strict=True)) == "quarter_hourly"
    assert one(spark, text.granularity(F.lit(None).cast("string"), F.lit("daily.xlsx"))) == "unknown"


@pytest.mark.parametrize("sheet,kept", [("1", True), ("7.0", True), (" 31 ", True), ("32", False), ("0", False),
                                        ("01", True), ("00", False), ("Summary", False), ("1.5", False)])
def test_day_sheets(spark, sheet, kept):
    assert one(spark, text.is_day_sheet(F.lit(sheet))) is kept


def test_path_rules(spark):
    assert one(spark, text.exclusion_reason(F.lit("/a/Sample DCR/x.xlsx"))) == "Excluded by path token: sample dcr"
    assert one(spark, text.exclusion_reason(F.lit("/a/b.xlsx"))) is None
    assert one(spark, text.region_from_path(F.lit("/x/Igkv 2022/y.xlsx"))) == "IGKV"
    assert one(spark, text.region_from_path(F.lit("/x/New Town.zip"))) == "NEW_TOWN"
    assert one(spark, text.year_from_path(F.lit("/x/2021/2022.xlsx"))) == 2021
    assert one(spark, text.year_from_path(F.lit("/x/y.xlsx"))) is None
    assert one(spark, text.is_workbook(F.lit("/x/~$y.xlsx"))) is False
    assert one(spark, text.is_workbook(F.lit("/x/y.XLSB"))) is True


@pytest.mark.parametrize("raw,expected", [
    ("01-02-2024 03:04", "2024-02-01 03:04:00"), ("1/2/2024 3:4", "2024-02-01 03:04:00"),
    ("2024-02-01 03:04:05", "2024-02-01 03:04:05"), ("2024-02-01 03:04", "2024-02-01 03:04:00"),
    ("31-02-2024 00:00", None), ("45292.5", "2024-01-01 12:00:00"), ("45292", "2024-01-01 00:00:00"),
    ("01.02.2024", "2024-02-01 00:00:00"), ("01-02-24 5:06", "2024-02-01 05:06:00"), ("junk", None), ("", None),
    (None, None), ("25-12-2024 24:01", None), ("1e20", None),
])
def test_dirty_dates(spark, raw, expected):
    want = dt.datetime.fromisoformat(expected) if expected else None
    assert one(spark, times.parse_datetime(F.lit(raw).cast("string"))) == want


def test_lenient_dates_are_month_first(spark):
    assert one(spark, times.coerce_datetime(F.lit("02/01/2024 03:04"))) == dt.datetime(2024, 2, 1, 3, 4)
    assert one(spark, times.coerce_datetime(F.lit("13/02/2024 03:04"))) == dt.datetime(2024, 2, 13, 3, 4)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_rounding_is_half_even_in_any_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for raw, quarter in (("2024-01-01 00:07:30", "00:00"), ("2024-01-01 00:22:30", "00:30"),
                             ("2024-01-01 23:52:30", "00:00"), ("2024-03-10 02:30:00", "02:30")):
            got = one(spark, times.round_to(F.lit(raw).cast("timestamp_ntz"), 900))
            assert got.strftime("%H:%M") == quarter
        # 02:30 does not exist in New York on this day.
        assert one(spark, times.parse_datetime(F.lit("10-03-2024 02:30"))) == dt.datetime(2024, 3, 10, 2, 30)
        assert one(spark, times.round_to(F.lit("2024-03-10 02:20:00").cast("timestamp_ntz"), 3600)).hour == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("raw,number", [("1", 1.0), (" 2.5 ", 2.5), ("-1e3", -1000.0), ("nan", None), ("inf", None),
                                        ("1d", None), ("0x1p3", None), ("x", None), ("", None), (None, None), ("1e999", None)])
def test_numbers(spark, raw, number):
    assert one(spark, numeric.to_double(F.lit(raw).cast("string"))) == number


def test_clip_and_plausible_keep_null(spark):
    null = F.lit(None).cast("double")
    assert one(spark, numeric.clip(null, 0, 1)) is None
    assert one(spark, numeric.prediction(null)) is None
    assert one(spark, numeric.prediction(F.lit(-0.1))) == 0.0
    assert one(spark, numeric.plausible(F.lit(1_000_000.0))) is None
    assert one(spark, numeric.plausible(F.lit(-1_000_000.0))) is None
    assert one(spark, numeric.plausible(F.lit(999_999.0))) == 999_999.0
    assert one(spark, numeric.plausible(F.lit(float("nan")))) is None


def test_spike_severity(spark):
    values = {"pm2_5": F.lit(112.5), "pm10": F.lit(250.0), "so2": F.lit(39.999999999)}
    got = [(a["pollutant"], a["severity"]) for a in one(spark, alerts.spike_alerts(values))]
    assert got == [("pm2_5", "high"), ("pm10", "elevated")]


def test_review_keeps_the_forecast_alert(spark):
    forecast = alerts.spike_alerts({"pm2_5": F.lit(95.0)})
    readings = alerts.review_alerts({"pm2_5": F.lit(80.0), "pm10": F.lit(150.0)})
    got = [(a["pollutant"], a["value"]) for a in one(spark, alerts.combined_review(forecast, readings))]
    assert got == [("pm2_5", 95.0), ("pm10", 150.0)]


def test_trend_spike(spark):
    def verdict(x, std=10.0):
        return one(spark, alerts.trend_spike(F.lit(x), F.lit(100.0), F.lit(std), F.lit("PM10")))
    assert [verdict(x)["severity"] for x in (120.0, 120.1, 130.0, 130.1)] == ["Normal", "Medium", "Medium", "High"]
    assert verdict(100.1, 0.0)["severity"] == "High"
    assert one(spark, alerts.trend_spike(F.lit(1.0), F.lit(None).cast("double"), F.lit(1.0), F.lit("x"))) is None


def test_rule_forecast_clamps_and_offsets(spark):
    values = {"pm2_5": 78.0, "pm10": 145.0, "so2": 14.0, "temp": 31.0, "hum": 62.0, "ws": 3.2}
    cols = {k: F.lit(v) for k, v in values.items()}
    got = {t: one(spark, c) for t, c in rules.rule_forecast(F.lit("SILTARA"), cols, F.lit(9), F.lit(6)).items()}
    rush, humid, wind = 0.7, 7 / 18, 0.8
    assert got["pm2_5"] == pytest.approx(78 * .76 + 145 * .055 + 3.2 + rush * 4.5 + humid * 2.4 - wind * 2.8)
    assert got["pm10"] == pytest.approx(145 * .79 + 78 * .22 + 12 + rush * 9.5 + humid * 4.2 - wind * 5.6)
    assert got["so2"] == pytest.approx(14 * .82 + .9 + rush * .9 - wind * .45)
    huge = {k: F.lit(1e5) for k in values}
    assert one(spark, rules.rule_forecast(F.lit("?"), huge, F.lit(1), F.lit(1))["so2"]) == 120.0


def test_summary_sentence(spark):
    got = one(spark, narrative.forecast_summary({"pm2_5": F.lit(0.25), "pm10": F.lit(12.35), "so2": F.lit(None)}))
    assert got.startswith("Predicted PM2.5 is 0.2, PM10 is 12.3, and SO2 is 0.0. ")
    assert "Good with low risk." in got


def test_report_text(spark):
    report = narrative.air_quality_report(
        F.lit("SILTARA"), {"pm2_5": F.lit(1.0), "pm10": F.lit(2.0), "so2": F.lit(3.0)}, F.lit("Good"), F.lit("Fine."),
        F.lit(False), F.array().cast("array<string>"), F.lit("Global single-target"))
    got = one(spark, report)
    assert "Today's forecast for Siltara indicates PM2.5 at 1.0 ug/m3" in got and got.endswith("scenario. Fine.")
    assert "time-of-day patterns" in got
    wrapped = one(spark, narrative.wrapped_report(F.lit("body"), F.lit("run1")))
    assert wrapped.splitlines()[0] == "AI-Generated Air Quality Summary" and "Runtime artifact: run1" in wrapped
    assert one(spark, narrative.importance_sentence(F.array(F.lit("a"), F.lit("b")))).endswith("are a, b.")


def test_model_selector(spark):
    def pick(region, target):
        return one(spark, selector.model_selector(F.lit(region), F.lit(target)))["model"]
    assert pick("aiims", "pm2_5") == "AIIMS_PM25_Model"
    assert pick("SILTARA", "PM25") == "global_pm25_model"
    assert pick("SILTARA", "PM10") == "SILTARA_PM10_Model"
    assert pick("BHATAGAON", "PM10") == "global_pm10_model"
    assert pick("BHATAGAON", "so2") == "BHATAGAON_SO2_Model"
    assert pick("AIIMS", "ozone") == "best_available_model"


def test_request_rules(spark):
    rows = spark.createDataFrame(
        [("AIIMS", 10.0, None, -1.0, 61.0), ("X", None, 7.0, 1.0, 20.0)],
        "region string, pm2_5 double, pm25 double, pm10 double, temperature double")
    got = rows.select(requests.violations(rows).alias("v")).collect()
    assert [r["v"] for r in got] == [["pm10", "temperature"], ["region"]]
    values = requests.reading_columns(rows, coalesce_nulls=True)
    assert [r[0] for r in rows.select(values["pm2_5"]).collect()] == [10.0, 7.0]
    assert rows.select(values["wd"], values["benz"]).first()[:] == (180.0, None)
    only_null = spark.createDataFrame([(None,)], "pm2_5 double")
    assert only_null.select(requests.reading_columns(only_null)["pm2_5"]).first()[0] is None
    assert only_null.select(requests.reading_columns(only_null, coalesce_nulls=True)["pm2_5"]).first()[0] == 38.0


def test_request_time(spark):
    now = one(spark, times.request_time(F.lit("  ")))
    assert now.minute == now.second == 0
    assert one(spark, times.request_time(F.lit("2026-06-08T10:00:00"))) == dt.datetime(2026, 6, 8, 10)
    assert one(spark, times.request_time(F.lit("soon"))) is None
