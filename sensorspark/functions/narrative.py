"""Report sentences built from forecast columns."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.numeric import to_double_or_zero
from sensorspark.functions.risk import risk_four_level


def one_decimal(col: Column) -> Column:
    return F.call_function("format_number", to_double_or_zero(col), F.lit("0.0"))


def _filled(template: str, **values: Column) -> Column:
    """The template with every {name} replaced by its column."""
    pieces = re.split(r"\{(\w+)\}", template)
    return F.concat(*[values[p] if i % 2 else F.lit(p) for i, p in enumerate(pieces) if i % 2 or p])


def forecast_summary(values: Mapping[str, Column]) -> Column:
    """One sentence per fact: forecast values, category, advice."""
    risk = risk_four_level(*[values[t] for t in K.TARGETS])
    return _filled(K.SUMMARY_TEXT, **{t: one_decimal(values[t]) for t in K.TARGETS}, category=risk["category"],
                   level=F.lower(risk["risk_level"]), advice=risk["recommendation"])


def air_quality_report(region: Column, values: Mapping[str, Column], category: Column, message: Column,
                       is_spike: Column, features: Column, strategy: Column, severity: Column | None = None) -> Column:
    """Narrative paragraph of one forecast. `features` is an array of names, most important first.

    A spike, or a severity that counts as abnormal, gives the warning sentence.
    """
    spike = F.coalesce(is_spike, F.lit(False))
    if severity is not None:
        spike = spike | F.coalesce(severity.isin(*K.ABNORMAL_SEVERITIES), F.lit(False))
    named = F.array_join(F.slice(F.coalesce(features, F.array().cast("array<string>")), 1, 3), ", ")
    return _filled(
        K.REPORT_TEXT, region=F.initcap(region), **{t: one_decimal(values[t]) for t in K.TARGETS},
        category=F.coalesce(category, F.lit(K.DEFAULT_CATEGORY)), strategy=F.coalesce(strategy, F.lit(K.DEFAULT_STRATEGY)),
        influences=F.when(named != "", named).otherwise(F.lit(K.DEFAULT_INFLUENCES)),
        anomaly=F.when(spike, F.lit(K.SPIKE_TEXT)).otherwise(F.lit(K.NO_SPIKE_TEXT)), message=F.coalesce(message, F.lit("")))


def wrapped_report(body: Column, artifact: Column) -> Column:
    """Full report text around the paragraph."""
    return _filled(K.WRAPPED_TEXT, body=body, artifact=artifact)


def importance_sentence(features: Column) -> Column:
    """Sentence naming the three strongest features of an ordered name array."""
    top = F.array_join(F.slice(features, 1, 3), ", ")
    return F.when(F.coalesce(F.size(features), F.lit(0)) > 0, _filled(K.SIGNALS_TEXT, features=top)).otherwise(F.lit(K.NO_SIGNALS_TEXT))
