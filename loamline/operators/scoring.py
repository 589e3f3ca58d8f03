"""Scores of predictions: metrics, model choice, external masks, export ranks and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.nulls import clipped_probability, mean_of, yes
from ..functions.stats import null_safe, running, with_group_quantiles, with_percent_ranks


def metrics(df: DataFrame, label: str, score: str, keys: list[str]) -> DataFrame:
    """(keys, n, n_positive, roc_auc, pr_auc, logloss, brier) over rows that have label and score.

    ROC-AUC by average ranks; PR-AUC is the step sum over distinct scores (average precision); both NULL with one class. Rows are first counted
    by score, and distinct scores are ranged over tasks.
    """
    rows = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).withColumns({"_y": F.col(label).cast("double"), "_p": F.col(score).cast("double")})
    p = clipped_probability(F.col("_p"))
    plain = rows.groupBy(*keys).agg(F.count("*").alias("n"), F.sum("_y").cast("long").alias("n_positive"), (-F.avg(F.col("_y") * F.ln(p) + (1 - F.col("_y")) * F.ln(1 - p))).alias("logloss"), F.avg((p - F.col("_y")) ** 2).alias("brier"))
    steps = rows.groupBy(*keys, "_p").agg(F.sum("_y").alias("_tp"), F.count("*").alias("_c"))
    steps = running(steps, keys, [-F.col("_p")], {"_tps": "_tp", "_cs": "_c"}).withColumns({"_tps": F.col("_tps") + F.col("_tp"), "_cs": F.col("_cs") + F.col("_c")})
    steps = null_safe(steps, steps.groupBy(*keys).agg(F.sum("_tp").alias("_pos"), F.sum("_c").alias("_all")), keys)
    # Positives above each score beat its negatives; ties count half.
    negatives = F.col("_c") - F.col("_tp")
    wins = negatives * (F.col("_tps") - F.col("_tp")) + negatives * F.col("_tp") / 2
    curve = steps.groupBy(*keys).agg(F.try_divide(F.sum(wins), F.first("_pos") * (F.first("_all") - F.first("_pos"))).alias("roc_auc"), F.sum(F.try_divide(F.col("_tp"), F.col("_pos")) * F.col("_tps") / F.col("_cs")).alias("_ap"), F.first("_pos").alias("_pos"), F.first("_all").alias("_all"))
    curve = curve.select(*keys, "roc_auc", F.when((F.col("_pos") > 0) & (F.col("_pos") < F.col("_all")), F.col("_ap")).alias("pr_auc"))
    return null_safe(plain, curve, keys).select(*keys, "n", "n_positive", "roc_auc", "pr_auc", "logloss", "brier")


def model_metrics(scored: DataFrame, label: str, predictions: list[str]) -> DataFrame:
    """metrics() for each prediction column, as rows by `model`."""
    long = scored.select(F.col(label).alias("_label"), F.explode(F.array(*[F.struct(F.lit(c).alias("model"), F.col(c).cast("double").alias("score")) for c in predictions])).alias("_m")).select("_label", "_m.*")
    return metrics(long, "_label", "score", ["model"])


def cv_summary(folds: DataFrame, columns: list[str]) -> DataFrame:
    """Mean and sample deviation of fold metrics by model."""
    return folds.groupBy("model").agg(*[f(c).alias(f"{c}_{s}") for c in columns for s, f in (("mean", F.avg), ("std", F.stddev_samp))])


def best_model(summary: DataFrame) -> DataFrame:
    """The model with the lowest log-loss, then Brier, then the highest PR-AUC, then ROC-AUC."""
    return summary.orderBy("logloss_mean", "brier_mean", F.desc("pr_auc_mean"), F.desc("roc_auc_mean"), "model").limit(1)


def combined_predictions(scored: DataFrame, models: list[str], final: str, baseline: str = "pred_baseline_risk") -> DataFrame:
    """scored with the mean of the models (over those there are), the final pick and its gap to the baseline."""
    pick = F.col(final) if final in scored.columns else F.col("pred_ml_mean")
    out = scored.withColumn("pred_ml_mean", mean_of([F.col(m) for m in models])).withColumn("pred_ml_final", pick)
    return out.withColumn("pred_ml_minus_baseline", F.col("pred_ml_final") - F.col(baseline))


def external_stats(scored: DataFrame, predictions: list[str], top: float = 0.1, least_inside: int = 3, least_outside: int = 10) -> DataFrame:
    """By area and year: rows inside and outside a mask (column inside_mask), and for each prediction both means, their difference and lift,
    the shares above the group's upper quantile and their enrichment; `thin` flags groups with too few rows on a side."""
    keys = ["area", "year"]
    rows = with_group_quantiles(scored, keys, {f"_t_{c}": (F.col(c), 1 - top) for c in predictions}) if predictions else scored
    inside = yes(F.col("inside_mask"))
    aggs: list[Column] = [F.count("*").alias("n_total"), F.sum(inside.cast("long")).alias("n_inside"), F.sum((~inside).cast("long")).alias("n_outside")]
    for c in predictions:
        above = yes(F.col(c) >= F.col(f"_t_{c}")).cast("double")
        for side, name in ((inside, "inside"), (~inside, "outside")):
            aggs += [F.avg(F.when(side, F.col(c))).alias(f"{c}_{name}_mean"), F.avg(F.when(side, above)).alias(f"{c}_topq_{name}_share")]
    out = rows.groupBy(*keys).agg(*aggs)
    for c in predictions:
        i, o, si, so = (F.col(f"{c}_{x}") for x in ("inside_mean", "outside_mean", "topq_inside_share", "topq_outside_share"))
        out = out.withColumns({f"{c}_inside_minus_outside": i - o, f"{c}_lift": F.when(o.isNotNull(), i / F.greatest(o, F.lit(1e-9))), f"{c}_topq_enrichment": F.when(so.isNotNull(), si / F.greatest(so, F.lit(1e-9)))})
    return out.withColumn("thin", (F.col("n_inside") < least_inside) | (F.col("n_outside") < least_outside))


def export_ranks(scored: DataFrame, predictions: list[str], keys: tuple[str, ...] = ("area", "year")) -> DataFrame:
    """scored with NAME_rank_pct of each prediction in its group."""
    return with_percent_ranks(scored, {f"{c}_rank_pct": c for c in predictions}, list(keys))


def attention(scored: DataFrame, model: str = "pred_ml_final", baseline: str = "pred_baseline_risk", rank: float = 0.9, gap: float = 0.15) -> DataFrame:
    """scored with ml_disagreement (absolute gap) and ml_attention_flag: either rank is high and the gap is wide."""
    wide = F.abs(F.col(model) - F.col(baseline))
    high = yes(F.col(f"{model}_rank_pct") >= rank) | yes(F.col(f"{baseline}_rank_pct") >= rank)
    return scored.withColumns({"ml_disagreement": wide, "ml_attention_flag": high & yes(wide >= gap)})


def latest_years(df: DataFrame) -> DataFrame:
    """df with is_latest: the row's year is its area's last."""
    return df.withColumn("is_latest", yes(F.col("year") == F.max("year").over(W.partitionBy("area"))))


def early_stop_rows(df: DataFrame, label: str, order: list[str], whole: int = 200, each: int = 100) -> DataFrame:
    """df with eval_row: among the first `whole` rows if these hold both classes, else among the first `each` of each class."""
    first = df.orderBy(*order).limit(whole).agg(F.count_distinct(label)).first()[0]
    if first > 1:
        head = df.orderBy(*order).limit(whole).select(*order, F.lit(True).alias("eval_row"))
        return df.join(F.broadcast(head), order, "left").fillna(False, ["eval_row"])
    return df.withColumn("eval_row", F.row_number().over(W.partitionBy(label).orderBy(*order)) <= each)
