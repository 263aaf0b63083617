"""Which strategy serves a region and target."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorspark import constants as K
from sensorspark.functions.text import strip, target_label


def model_selector(region: Column, target: Column) -> Column:
    """Recommended model from the published R2 tables, as a struct.

    The tables are fixed and have seven and three rows, so they are CASE
    expressions and no join is needed.
    """
    name, label = F.upper(strip(region)), target_label(target)
    out = None
    for wanted, texts in K.SELECTOR_TEXTS.items():
        general = dict(K.GLOBAL_R2)[wanted]
        # PM2.5 prefers any regional model, the others only a better one.
        regions = [r for r, t, r2 in K.REGION_R2 if t == wanted and (wanted == "PM2.5" or r2 > general)]
        code = wanted.replace(".", "")
        own = F.struct(F.concat(name, F.lit(f"_{code}_Model")).alias("model"),
                       F.lit(texts["region"][0]).alias("strategy"), F.lit(texts["region"][1]).alias("reason"))
        shared = F.struct(F.lit(f"global_{code.lower()}_model").alias("model"),
                          F.lit(texts["global"][0]).alias("strategy"), F.lit(texts["global"][1]).alias("reason"))
        answer = F.when(F.coalesce(name.isin(*regions), F.lit(False)), own).otherwise(shared)
        out = (F.when if out is None else out.when)(label == wanted, answer)
    model, strategy, reason = K.SELECTOR_FALLBACK
    return out.otherwise(F.struct(F.lit(model).alias("model"), F.lit(strategy).alias("strategy"),
                                  F.lit(reason).alias("reason")))


def resolve_strategy(strategy: Column, candidates: Sequence[str]) -> Column:
    """Stored winner to a strategy that can be served; older names map to their scope."""
    low = F.lower(strategy)
    known = low.isin(*candidates) if candidates else F.lit(False)
    return (
        F.when(known, low)
        .when(F.startswith(low, F.lit("single")), F.lit("single_target"))
        .otherwise(F.lit("multi_output"))
    )


def lookup_best(df: DataFrame, best: DataFrame, candidates: Sequence[str] = ()) -> DataFrame:
    """Add `strategy` to rows of (region, target); pairs without a winner use multi_output.

    No broadcast hint: the optimizer broadcasts the winners while they are small
    by its own size check.
    """
    winners = best.select("region", "target", F.col("strategy").alias("_strategy"))
    joined = df.join(winners, ["region", "target"], "left")
    return joined.withColumn("strategy", F.coalesce(
        resolve_strategy(F.col("_strategy"), candidates), F.lit("multi_output"))).drop("_strategy")
