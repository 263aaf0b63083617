"""Fixed values of the data model: names, thresholds, lookup rows and report texts.

Nothing here is computed. Results only agree with existing readings, models and
reports while these values stay as they are.
"""

# Stations, in report order.
REGIONS = ("AIIMS", "BHATAGAON", "IGKV", "SILTARA")
REGION_ALIASES = {
    "BHATAGAON_DCR": "BHATAGAON",
    "SILTARA_DCR": "SILTARA",
    "DCR_AIIMS": "AIIMS",
    "IGKV_DCR": "IGKV",
}

# Forecast targets and sensor columns.
TARGETS = ("pm2_5", "pm10", "so2")
SENSORS = (
    "benz", "co", "hum", "nh3", "no", "no2", "nox", "o3",
    "pm10", "pm2_5", "rg", "so2", "sr", "temp", "wd", "ws",
)
ROLLING_SENSORS = ("pm2_5", "pm10", "so2", "temp", "hum", "ws")

# Canonical column names, in matching order.
CANONICAL_NAMES = (
    "date_time", "pm2_5", "pm10", "benz", "so2", "no2", "nox", "nh3", "temp",
    "hum", "sr", "rg", "co", "o3", "wd", "ws", "no",
)

# Path fragments that exclude a workbook, in matching order.
EXCLUDED_PATH_TOKENS = (
    "sample dcr", "sampale dcr", "sample", "blank dcr", "blank", "formate",
    "format", "calibr", "celibr", "ripor", "cecb monthly dcr - copy", "~$",
)
WORKBOOK_SUFFIXES = (".xlsx", ".xls", ".xlsb")

# Column aliases accepted for sensor tables and for scoring requests.
COLUMN_ALIASES = {
    "pm25": "pm2_5",
    "pm2.5": "pm2_5",
    "temperature": "temp",
    "humidity": "hum",
    "wind_speed": "ws",
    "timestamp": "date_time",
}
READING_ALIASES = {
    "pm2_5": ("pm25", "pm2.5"),
    "pm10": (),
    "so2": (),
    "temp": ("temperature",),
    "hum": ("humidity",),
    "ws": ("wind_speed", "wind"),
    "wd": ("wind_direction",),
    "benz": ("benzene",),
    "co": (),
    "nh3": (),
    "no": (),
    "no2": (),
    "nox": (),
    "o3": (),
    "rg": ("rain_gauge",),
    "sr": ("solar_radiation",),
}

# Reading used when a request does not carry the sensor.
READING_DEFAULTS = {
    "pm2_5": 38.0,
    "pm10": 112.0,
    "so2": 18.0,
    "temp": 31.0,
    "hum": 58.0,
    "ws": 3.2,
    "wd": 180.0,
}

# Accepted range of each reading (None = open end).
READING_BOUNDS = {
    "pm2_5": (0.0, None),
    "pm10": (0.0, None),
    "so2": (0.0, None),
    "temp": (0.0, 60.0),
    "hum": (0.0, 100.0),
    "ws": (0.0, None),
    "wd": (0.0, 360.0),
}
REQUEST_STRATEGIES = ("best", "multi_output", "single_target")

# Grid step in seconds, lags and rolling windows in steps.
STEP_SECONDS = {"hourly": 3600, "quarter_hourly": 900}
LAGS = {
    "hourly": (1, 3, 6, 12, 24, 48, 168),
    "quarter_hourly": (1, 4, 12, 24, 96, 192, 672),
}
WINDOWS = {
    "hourly": (3, 6, 24, 72),
    "quarter_hourly": (4, 12, 24, 96),
}
SHORT_LAGS = (1, 3, 6, 12, 24)
SHORT_WINDOWS = (3, 6, 12, 24)

# Readings at or above this magnitude are sensor faults.
IMPOSSIBLE_MAGNITUDE = 1_000_000.0

# Chronological split and clip quantiles.
TRAIN_END = "2024-12-31 23:45:00"
VALIDATION_END = "2025-06-30 23:45:00"
MIN_DATE = "2022-01-01 00:00:00"
FEATURE_CLIP = (0.005, 0.995)
TARGET_CLIP_UPPER = 0.995

# Columns of the model frame that are never features.
NON_FEATURE_COLUMNS = (
    "date_time", "granularity", "region", "station_name", "report_type",
    "time_base", "source_workbook", "source_relative_path", "source_sheet",
    "source_month_folder", "source_year", "selected_row_non_null_score",
    "source_row_count", "source_file_count", "observed_row", "observed_future",
)

# Columns of the cleaned table that are not metrics.
LINEAGE_COLUMNS = (
    "source_workbook", "source_relative_path", "source_sheet",
    "source_month_folder", "source_year",
)
DESCRIPTION_COLUMNS = ("station_name", "report_type", "time_base")

# Alert thresholds on forecasts and on readings under review.
SPIKE_THRESHOLDS = {"pm2_5": 90.0, "pm10": 250.0, "so2": 40.0}
REVIEW_THRESHOLDS = {"pm2_5": 75.0, "pm10": 145.0, "so2": 28.0}
HIGH_SEVERITY_FACTOR = 1.25
POLLUTANT_LABELS = {"pm2_5": "PM2.5", "pm10": "PM10", "so2": "SO2"}

# Four-level risk scale. A level applies when any pollutant is above its floor.
RISK_FLOORS = {2: (35.0, 100.0, 18.0), 3: (60.0, 160.0, 28.0), 4: (90.0, 250.0, 40.0)}
RISK_LEVELS = (
    # score, category, risk level, colour, recommendation
    (1, "Good", "Low", "#207a58",
     "Air quality appears acceptable for normal outdoor activity."),
    (2, "Moderate", "Elevated", "#0f7c75",
     "Sensitive groups should monitor symptoms during prolonged outdoor activity."),
    (3, "Poor", "High", "#d58c22",
     "Sensitive groups should reduce prolonged outdoor exposure."),
    (4, "Severe", "Very High", "#c2414b",
     "Limit outdoor exposure and consider protective measures for sensitive groups."),
)
NO_DRIVER_TEXT = "All tracked pollutants"

# Five-level risk scale. A band applies when all pollutants are within its ceiling.
RISK_BANDS = (
    # ceilings (pm2_5, pm10, so2), category, risk level, colour, message
    ((30.0, 50.0, 15.0), "Good", "Low", "#22c55e",
     "Air quality appears acceptable for normal outdoor activity."),
    ((60.0, 100.0, 30.0), "Moderate", "Elevated", "#facc15",
     "Sensitive groups should monitor symptoms during prolonged outdoor activity."),
    ((90.0, 250.0, 40.0), "Poor", "High", "#f97316",
     "Sensitive groups should reduce prolonged outdoor exposure."),
    ((120.0, 350.0, 80.0), "Very Poor", "Very High", "#ef4444",
     "Limit outdoor exposure and use protective measures when possible."),
    (None, "Severe", "Severe", "#991b1b",
     "Avoid prolonged outdoor exposure and verify conditions with official monitoring sources."),
)
RISK_DISCLAIMER = (
    "This AQI interpretation is a simplified project-level risk layer and not an official "
    "regulatory AQI calculation."
)

# Published R2 of the global and the per-station forecasters.
GLOBAL_R2 = (("PM2.5", 0.978), ("PM10", 0.883), ("SO2", 0.245))
REGION_R2 = (
    ("AIIMS", "PM2.5", 0.984),
    ("IGKV", "PM2.5", 0.980),
    ("IGKV", "PM10", 0.975),
    ("AIIMS", "PM10", 0.969),
    ("SILTARA", "PM10", 0.935),
    ("BHATAGAON", "SO2", 0.836),
    ("SILTARA", "SO2", 0.683),
)

# Selector answers as (strategy, reason) per target label.
REGIONAL_STRATEGY = "Region-specific single-target"
SELECTOR_TEXTS = {
    "PM2.5": {
        "region": (REGIONAL_STRATEGY,
                   "Region-specific PM2.5 model performs better than the global PM2.5 model."),
        "global": ("Global single-target fallback",
                   "Region-specific PM2.5 model is unavailable, so the global PM2.5 model is used with caution."),
    },
    "PM10": {
        "region": (REGIONAL_STRATEGY,
                   "Region-specific PM10 result outperforms the global PM10 model."),
        "global": ("Global single-target",
                   "Global PM10 model provides the strongest available baseline for this target."),
    },
    "SO2": {
        "region": (REGIONAL_STRATEGY,
                   "Region-specific SO2 result outperforms the global SO2 model."),
        "global": ("Global single-target",
                   "Global SO2 model is the best available strategy for this input."),
    },
}
SELECTOR_FALLBACK = (
    "best_available_model", "Best available",
    "Target-specific strategy was not found, so the best available model is selected.",
)

# Rule-based forecast, additive offset per station (pm2_5, pm10, so2).
RULE_OFFSETS = {
    "AIIMS": (-1.5, -4.0, 0.2),
    "BHATAGAON": (4.6, 8.0, 0.7),
    "IGKV": (-3.8, -9.0, -0.4),
    "SILTARA": (3.2, 12.0, 0.9),
}
# Rule-based forecast, weight of every signal and the upper clamp.
RULE_WEIGHTS = {
    "pm2_5": {"pm2_5": 0.76, "pm10": 0.055, "rush": 4.5, "night": 3.2, "winter": 5.8,
              "humid": 2.4, "wind": -2.8},
    "pm10": {"pm10": 0.79, "pm2_5": 0.22, "rush": 9.5, "winter": 11.0, "humid": 4.2,
             "wind": -5.6, "heat": 3.5},
    "so2": {"so2": 0.82, "rush": 0.9, "night": 0.6, "winter": 0.8, "heat": 0.5,
            "wind": -0.45},
}
RULE_UPPER = {"pm2_5": 500.0, "pm10": 700.0, "so2": 120.0}

# Importances shown when no model offers its own.
FALLBACK_MODEL_FEATURES = (
    "pm10", "pm2_5", "so2", "temp", "hum", "ws", "hour", "month",
    "region_SILTARA", "region_BHATAGAON",
)
FALLBACK_DISPLAY_IMPORTANCE = (
    ("Previous PM2.5 level", 0.22),
    ("Previous PM10 level", 0.19),
    ("Rolling PM2.5 mean", 0.16),
    ("Rolling PM10 mean", 0.14),
    ("Hour of day", 0.10),
    ("Humidity", 0.08),
    ("Region indicator", 0.07),
    ("Wind speed", 0.04),
    ("Month", 0.03),
    ("Season", 0.02),
)
DEFAULT_REPORT_FEATURES = (
    "recent PM10 history", "rolling pollution averages", "region-specific trends",
)

# Hyper-parameters of the model families.
FOREST_PRESET = {"numTrees": 140, "maxDepth": 18, "minInstancesPerNode": 2,
                 "featureSubsetStrategy": "sqrt", "subsamplingRate": 0.35}
BOOSTED_PRESETS = {
    "lightgbm": {"maxIter": 360, "stepSize": 0.045, "maxDepth": 8, "subsamplingRate": 0.85,
                 "featureSubsetStrategy": "0.85", "minInstancesPerNode": 35},
    "xgboost": {"maxIter": 360, "stepSize": 0.045, "maxDepth": 8, "subsamplingRate": 0.85,
                "featureSubsetStrategy": "0.85", "minInstancesPerNode": 3},
}
MODEL_FAMILIES = ("random_forest", "lightgbm", "xgboost")
SEED = 42

# Report texts, with the places of their values in braces.
SUMMARY_TEXT = (
    "Predicted PM2.5 is {pm2_5}, PM10 is {pm10}, and SO2 is {so2}. The project AQI-style category is {category} with {level} risk. "
    "{advice}")
REPORT_TEXT = (
    "This report is generated using a rule-based NLP-style summarization template.\n\n"
    "Today's forecast for {region} indicates PM2.5 at {pm2_5} ug/m3, PM10 at {pm10} ug/m3, and SO2 at {so2} ug/m3. "
    "The AQI-style risk category is {category}. The hybrid model selected {strategy} because local pollution behavior is important "
    "for this forecast. The prediction is mainly influenced by {influences}. {anomaly} {message}")
WRAPPED_TEXT = (
    "AI-Generated Air Quality Summary\n\n{body}\n\nRuntime artifact: {artifact}\n"
    "Future scope: this template can be upgraded with an LLM-based report summarizer.")
SIGNALS_TEXT = "The strongest available model signals for this demo are {features}."
NO_SIGNALS_TEXT = "The model uses pollutant readings, weather context, time features, and region indicators."
DEFAULT_INFLUENCES = "recent pollutant history, rolling pollution averages, and time-of-day patterns"
SPIKE_TEXT = "The anomaly detection module also identified abnormal pollutant behavior compared to recent trends."
NO_SPIKE_TEXT = "The anomaly detection module did not flag a major spike for this scenario."
DEFAULT_CATEGORY, DEFAULT_STRATEGY = "Moderate", "hybrid forecasting strategy"
ABNORMAL_SEVERITIES = ("Medium", "High")

# Alert texts.
SPIKE_ALERT_TEXT = "{pollutant} is unusually high for this demo threshold."
REVIEW_ALERT_TEXT = "{pollutant} input is elevated for the configured review threshold."
TREND_ALERT_TEXT = " is significantly above recent trend. Monitor exposure and verify sensor readings."
TREND_NORMAL_TEXT = " is within the expected recent trend range."
WATCH_TEXTS = {"pm2_5": "PM2.5 elevated at ", "pm10": "PM10 spike watch at ", "so2": "SO2 elevated at "}
PM10_DRIVER_RATIO, PM10_DRIVER, PM2_5_DRIVER = 1.8, "PM10 lag features", "PM2.5 trend features"
CALM_WIND, CALM_TEXT, WINDY_TEXT = 2.5, "Low wind stagnation", "Wind dispersion relief"

# Signals of the rule forecast, as (from, scale) or levels.
RULE_EVENING_RUSH, RULE_MORNING_RUSH, RULE_NIGHT = 1.0, 0.7, 0.55
RULE_HUMIDITY, RULE_HEAT = (55.0, 18.0), (32.0, 10.0)
RULE_WIND_CAP, RULE_WIND_SCALE = 10.0, 4.0

# Spelling of headers.
CAMEL_SPLITS = ("([a-z0-9])([A-Z])", "([A-Z]+)([A-Z][a-z])")
HEADER_WORDS = (("&", " and "), ("%", " percent "))
HEADER_SPELLINGS = (
    ("date_and_time", "date_time"),
    ("date_time_stamp", "date_time"),
    ("pm_10", "pm10"),
    ("pm_2_5", "pm2_5"),
)
