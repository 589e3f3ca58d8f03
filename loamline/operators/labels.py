"""Weak labels by quantile rules."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.nulls import total_of, yes
from ..functions.stats import with_group_quantiles

# The rules' settings and the features that a negative needs.
DEFAULTS = {
    "positive_quantile": 0.8, "min_positive_hits": 3, "require_dynamic_signal": True, "literature_bonus_weight": 0.1, "max_missing_primary_for_label": 6,
    "negative_current_quantile": 0.75, "negative_abs_delta_quantile": 0.7, "negative_min_obs": 2, "negative_min_stable_share": 0.5,
    "negative_require_no_literature_hit": True, "negative_require_low_hotspot": True, "persistent_quantile": 0.75, "hotspot_quantile": 0.5,
}
READY_FEATURES = ["change_share", "texture_anomaly_share", "water_share", "persistence_water_share"]
STATIC, DYNAMIC = ["high_change", "high_texture", "high_water"], ["veg_loss", "wet_shift", "persistent_signal"]


def with_rules(df: DataFrame, settings: dict | None = None) -> DataFrame:
    """df with the boolean columns of all positive and negative rules and pos_hits.

    A rule whose feature the table lacks is false for positives; for negatives low_* are false, stable_* and low_hotspot true. All thresholds
    come from one aggregation by area.
    """
    s = DEFAULTS | (settings or {})
    has = lambda c: c in df.columns
    q = s["positive_quantile"]
    wanted: dict[str, tuple[Column, float]] = {}
    shares = [c for c in READY_FEATURES if has(c)]
    for c in shares:
        wanted |= {f"hi_{c}": (F.col(c), q), f"lo_{c}": (F.col(c), s["negative_current_quantile"])}
    for c, side in (("delta_ndvi_mean", round(1 - q, 12)), ("delta_ndwi_mean", q)):  # 1 - 0.8 would miss 0.2 by its last bits
        if has(c):
            wanted |= {f"hi_{c}": (F.col(c), side), f"abs_{c}": (F.abs(F.col(c)), s["negative_abs_delta_quantile"])}
    if has("roll2__change_share"):
        wanted["hi_roll"] = (F.col("roll2__change_share"), s["persistent_quantile"])
    if has("hotspot_share"):
        wanted["mid_hotspot"] = (F.col("hotspot_share"), s["hotspot_quantile"])
    out = with_group_quantiles(df, ["area"], {f"_q_{k}": v for k, v in wanted.items()})
    at = lambda k: F.col(f"_q_{k}")
    high = lambda c: yes(F.col(c) >= at(f"hi_{c}")) if has(c) else F.lit(False)
    low = lambda c: yes(F.col(c) <= at(f"lo_{c}")) if has(c) else F.lit(False)
    stable = lambda c: F.col(c).isNull() | yes(F.abs(F.col(c)) <= at(f"abs_{c}")) if has(c) else F.lit(True)
    persistent = has("persistence_water_share") and has("water_share")
    rules = {
        "high_change": high("change_share"),
        "high_texture": high("texture_anomaly_share"),
        "high_water": high("water_share") | high("persistence_water_share") if persistent else high("water_share"),
        "veg_loss": yes(F.col("delta_ndvi_mean") <= at("hi_delta_ndvi_mean")) if has("delta_ndvi_mean") else F.lit(False),
        "wet_shift": high("delta_ndwi_mean"),
        "persistent_signal": yes(F.col("roll2__change_share") >= at("hi_roll")) if has("roll2__change_share") else F.lit(False),
        "low_change": low("change_share"),
        "low_texture": low("texture_anomaly_share"),
        "low_water": low("water_share") & low("persistence_water_share") if persistent else low("water_share"),
        "stable_ndvi": stable("delta_ndvi_mean"),
        "stable_ndwi": stable("delta_ndwi_mean"),
        "low_hotspot": yes(F.coalesce("hotspot_share", F.lit(0.0)) <= at("mid_hotspot")) if s["negative_require_low_hotspot"] and has("hotspot_share") else F.lit(True),
        "row_ready": total_of([F.col(c).isNotNull().cast("int") for c in shares] or [F.lit(0)]) >= max(3, min(4, len(shares))),
    }
    out = out.withColumns(rules).drop(*[f"_q_{k}" for k in wanted])
    return out.withColumn("pos_hits", total_of([F.col(c).cast("int") for c in STATIC + DYNAMIC]))


def weak_labels(df: DataFrame, settings: dict | None = None) -> DataFrame:
    """df with label_is_eligible, positive_rule_hits, negative_current_stable, negative_parcel_obs, negative_parcel_stable_share, weak_target, label_type and sample_weight.

    weak_target is NULL for uncertain rows and for conflicts, where positive and negative rules both hold.
    """
    s = DEFAULTS | (settings or {})
    any_of = lambda names: reduce(lambda a, b: a | b, [F.col(n) for n in names])
    all_of = lambda names: reduce(lambda a, b: a & b, [F.col(n) for n in names])
    out = with_rules(df, s)
    out = out.withColumn("negative_current_stable", all_of(["low_change", "low_texture", "low_water", "stable_ndvi", "stable_ndwi", "low_hotspot", "row_ready"]))
    parcel = W.partitionBy("area", "parcel_id")
    out = out.withColumns({"negative_parcel_obs": F.sum(F.col("row_ready").cast("int")).over(parcel), "_stable": F.sum(F.col("negative_current_stable").cast("int")).over(parcel)})
    out = out.withColumn("negative_parcel_stable_share", F.try_divide(F.col("_stable").cast("double"), F.col("negative_parcel_obs").cast("double"))).drop("_stable")
    hit = yes(F.col("literature_mask_hit").cast("boolean")) if "literature_mask_hit" in df.columns else F.lit(False)
    most = s["max_missing_primary_for_label"]
    eligible = F.coalesce(F.col("n_missing_primary"), F.lit(most + 1)) <= most if "n_missing_primary" in df.columns else F.lit(True)
    positive = (F.col("pos_hits") >= s["min_positive_hits"]) & any_of(STATIC) & eligible
    if s["require_dynamic_signal"]:
        positive = positive & any_of(DYNAMIC)
    negative = F.col("negative_current_stable") & yes(F.col("negative_parcel_obs") >= s["negative_min_obs"]) & yes(F.col("negative_parcel_stable_share") >= s["negative_min_stable_share"]) & eligible
    if s["negative_require_no_literature_hit"]:
        negative = negative & ~hit
    out = out.withColumns({"label_is_eligible": eligible, "_pos": positive, "_neg": negative})
    kind = F.when(F.col("_pos") & F.col("_neg"), "conflict").when(F.col("_pos"), "confident_positive").when(F.col("_neg"), "confident_negative").otherwise("uncertain")
    extra = F.least(F.lit(1.0) + F.lit(0.10) * F.greatest(F.col("pos_hits") - s["min_positive_hits"], F.lit(0)), F.lit(1.5)) + F.when(hit, F.lit(s["literature_bonus_weight"])).otherwise(F.lit(0.0))
    weight = F.when(F.col("_neg"), F.lit(1.1)).when(F.col("_pos"), extra).otherwise(F.lit(1.0))
    out = out.withColumns({"label_type": kind, "weak_target": F.when(kind == "confident_positive", 1).when(kind == "confident_negative", 0), "sample_weight": weight})
    return out.withColumnRenamed("pos_hits", "positive_rule_hits").drop("_pos", "_neg")


def label_pivot(labelled: DataFrame) -> DataFrame:
    """Rows by area, a column for each label type, zero where there are none."""
    kinds = ["confident_negative", "confident_positive", "conflict", "uncertain"]
    return labelled.groupBy("area").pivot("label_type", kinds).count().fillna(0, kinds)
