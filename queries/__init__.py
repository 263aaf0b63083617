"""Every operator as a query over the driver tables, with its SQL twin where SQL can say it."""

from queries import clean, evaluation, forecasts, ingest, risk_alerts, series, streams
from queries.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "clean", "evaluation", "forecasts", "ingest", "risk_alerts", "series", "streams"]
