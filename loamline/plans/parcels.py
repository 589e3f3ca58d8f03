"""Parcel-year queries: temporal features, quantile rules, labels, metrics, ranks and exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nulls, stats, text
from ..operators import features, labels, scenes, scoring
from .tables import DY, PY, SC, dynamic_years, parcel_years, scored, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


@query(f"""WITH {PY}, t AS (SELECT area, parcel_id, year, ndvi_mean, lag(ndvi_mean) OVER w AS prev1__ndvi_mean, ndvi_mean - lag(ndvi_mean) OVER w AS d1__ndvi_mean,
  CASE WHEN lag(ndvi_mean) OVER w IS NULL THEN ndvi_mean ELSE (lag(ndvi_mean) OVER w + ndvi_mean) / 2 END AS roll2__ndvi_mean FROM py WINDOW w AS (PARTITION BY area, parcel_id ORDER BY year)),
q AS (SELECT area, quantile_cont(ndvi_mean, 0.8) AS thr FROM py GROUP BY area)
SELECT t.area, parcel_id, year, round(ndvi_mean, 9) AS ndvi_mean, round(prev1__ndvi_mean, 9) AS prev1__ndvi_mean, round(d1__ndvi_mean, 9) AS d1__ndvi_mean, round(roll2__ndvi_mean, 12) AS roll2__ndvi_mean, round(thr, 6) AS threshold, coalesce(ndvi_mean >= thr, false) AS hit FROM t JOIN q ON t.area = q.area""")
def parcel_year_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: parcel-years with their change against the year before and whether they reach their area's 80 % quantile."""
    df = features.with_temporal(parcel_years(spark, sf_dir), ["ndvi_mean"])
    df = stats.with_group_quantiles(df, ["area"], {"threshold": (F.col("ndvi_mean"), 0.8)})
    r = lambda c: F.round(c, 9).alias(c)
    return df.select("area", "parcel_id", "year", r("ndvi_mean"), r("prev1__ndvi_mean"), r("d1__ndvi_mean"), F.round("roll2__ndvi_mean", 12).alias("roll2__ndvi_mean"), F.round("threshold", 6).alias("threshold"), nulls.yes(F.col("ndvi_mean") >= F.col("threshold")).alias("hit"))


@query(f"""WITH {PY} SELECT area, parcel_id, year, lag(year) OVER w AS prev_year, year - lag(year) OVER w AS year_gap, lag(change_share) OVER w AS prev1__change_share,
  round(change_share - lag(change_share) OVER w, 9) AS d1__change_share, round(CASE WHEN lag(change_share) OVER w IS NULL THEN change_share ELSE (lag(change_share) OVER w + change_share) / 2 END, 9) AS roll2__change_share,
  lag(water_share) OVER w AS prev1__water_share, round(ln(1 + n * 100), 9) AS log_area_m2, CAST((hotspot_share IS NULL)::INT AS BIGINT) AS n_missing_primary FROM py WINDOW w AS (PARTITION BY area, parcel_id ORDER BY year)""")
def temporal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcel_years(spark, sf_dir).withColumn("area_m2", F.col("n") * 100.0)
    df = features.with_temporal(df, ["change_share", "water_share"])
    return df.select("area", "parcel_id", "year", "prev_year", "year_gap", "prev1__change_share", F.round("d1__change_share", 9).alias("d1__change_share"), F.round("roll2__change_share", 9).alias("roll2__change_share"), "prev1__water_share", F.round("log_area_m2", 9).alias("log_area_m2"), F.col("n_missing_primary").cast("long").alias("n_missing_primary"))


@query(f"""WITH {DY} SELECT area, round(quantile_cont(ndvi_mean, 0.8), 6) AS q80, round(quantile_cont(change_share, 0.75), 6) AS change_q75, round(quantile_cont(delta_ndvi_mean, 0.2), 6) AS delta_q20, round(quantile_cont(abs(delta_ndvi_mean), 0.7), 6) AS abs_q70 FROM dy GROUP BY area""")
def area_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = stats.with_group_quantiles(dynamic_years(spark, sf_dir), ["area"], {"q80": (F.col("ndvi_mean"), 0.8), "change_q75": (F.col("change_share"), 0.75), "delta_q20": (F.col("delta_ndvi_mean"), 0.2), "abs_q70": (F.abs("delta_ndvi_mean"), 0.7)})
    names = ["q80", "change_q75", "delta_q20", "abs_q70"]
    return df.select("area", *[F.round(n, 6).alias(n) for n in names]).distinct()


RULES = f"""{DY}, q AS (SELECT area, quantile_cont(change_share, 0.8) AS hc, quantile_cont(texture_anomaly_share, 0.8) AS ht, quantile_cont(water_share, 0.8) AS hw, quantile_cont(persistence_water_share, 0.8) AS hp,
  quantile_cont(delta_ndvi_mean, 0.2) AS lv, quantile_cont(delta_ndwi_mean, 0.8) AS hs, quantile_cont(roll2__change_share, 0.75) AS hr, quantile_cont(change_share, 0.75) AS lc, quantile_cont(texture_anomaly_share, 0.75) AS lt,
  quantile_cont(water_share, 0.75) AS lw, quantile_cont(persistence_water_share, 0.75) AS lp, quantile_cont(abs(delta_ndvi_mean), 0.7) AS av, quantile_cont(abs(delta_ndwi_mean), 0.7) AS aw, quantile_cont(hotspot_share, 0.5) AS mh FROM dy GROUP BY area),
r AS (SELECT dy.*, coalesce(change_share >= hc, false) AS high_change, coalesce(texture_anomaly_share >= ht, false) AS high_texture, coalesce(water_share >= hw, false) OR coalesce(persistence_water_share >= hp, false) AS high_water,
  coalesce(delta_ndvi_mean <= lv, false) AS veg_loss, coalesce(delta_ndwi_mean >= hs, false) AS wet_shift, coalesce(roll2__change_share >= hr, false) AS persistent_signal, coalesce(change_share <= lc, false) AS low_change,
  coalesce(texture_anomaly_share <= lt, false) AS low_texture, coalesce(water_share <= lw, false) AND coalesce(persistence_water_share <= lp, false) AS low_water, delta_ndvi_mean IS NULL OR coalesce(abs(delta_ndvi_mean) <= av, false) AS stable_ndvi,
  delta_ndwi_mean IS NULL OR coalesce(abs(delta_ndwi_mean) <= aw, false) AS stable_ndwi, coalesce(coalesce(hotspot_share, 0) <= mh, false) AS low_hotspot,
  (change_share IS NOT NULL)::INT + (texture_anomaly_share IS NOT NULL)::INT + (water_share IS NOT NULL)::INT + (persistence_water_share IS NOT NULL)::INT >= 4 AS row_ready FROM dy JOIN q ON q.area = dy.area)"""
NAMES = ["high_change", "high_texture", "high_water", "veg_loss", "wet_shift", "persistent_signal", "low_change", "low_texture", "low_water", "stable_ndvi", "stable_ndwi", "low_hotspot", "row_ready"]
HITS = " + ".join(f"{n}::INT" for n in NAMES[:6])


@query(f"WITH {RULES} SELECT area, parcel_id, year, {', '.join(NAMES)}, CAST({HITS} AS BIGINT) AS pos_hits FROM r")
def quantile_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.with_rules(dynamic_years(spark, sf_dir)).select("area", "parcel_id", "year", *NAMES, F.col("pos_hits").cast("long").alias("pos_hits"))


LABELS = f"""{RULES}, s AS (SELECT *, low_change AND low_texture AND low_water AND stable_ndvi AND stable_ndwi AND low_hotspot AND row_ready AS stable, {HITS} AS hits FROM r),
o AS (SELECT *, CAST(sum(row_ready::INT) OVER w AS BIGINT) AS obs, CAST(sum(stable::INT) OVER w AS DOUBLE) / nullif(sum(row_ready::INT) OVER w, 0) AS share FROM s WINDOW w AS (PARTITION BY area, parcel_id)),
p AS (SELECT *, hits >= 3 AND (high_change OR high_texture OR high_water) AND (veg_loss OR wet_shift OR persistent_signal) AS pos, stable AND obs >= 2 AND coalesce(share >= 0.5, false) AS neg FROM o),
lab AS (SELECT area, parcel_id, year, CAST(hits AS BIGINT) AS positive_rule_hits, stable AS negative_current_stable, obs AS negative_parcel_obs, round(share, 9) AS negative_parcel_stable_share,
  CASE WHEN pos AND neg THEN 'conflict' WHEN pos THEN 'confident_positive' WHEN neg THEN 'confident_negative' ELSE 'uncertain' END AS label_type,
  CAST(CASE WHEN pos AND NOT neg THEN 1 WHEN neg AND NOT pos THEN 0 END AS BIGINT) AS weak_target,
  round(CASE WHEN neg THEN 1.1 WHEN pos THEN least(1.0 + 0.10 * greatest(hits - 3, 0), 1.5) ELSE 1.0 END, 6) AS sample_weight FROM p)"""


@query(f"WITH {LABELS} SELECT area, parcel_id, year, positive_rule_hits, negative_current_stable, negative_parcel_obs, negative_parcel_stable_share, label_type, weak_target, CAST(sample_weight AS DOUBLE) AS sample_weight FROM lab")
def weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labels.weak_labels(dynamic_years(spark, sf_dir))
    return df.select("area", "parcel_id", "year", F.col("positive_rule_hits").cast("long").alias("positive_rule_hits"), "negative_current_stable", "negative_parcel_obs", F.round("negative_parcel_stable_share", 9).alias("negative_parcel_stable_share"), "label_type", F.col("weak_target").cast("long").alias("weak_target"), F.round("sample_weight", 6).alias("sample_weight"))


@query(f"WITH {LABELS} SELECT area, {', '.join(f"count(*) FILTER (label_type = '{k}') AS {k}" for k in ('confident_negative', 'confident_positive', 'conflict', 'uncertain'))} FROM lab GROUP BY area")
def label_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.label_pivot(labels.weak_labels(dynamic_years(spark, sf_dir)))


@query(f"WITH {LABELS} SELECT round(median(negative_parcel_obs), 6) AS median_obs, round(median(negative_parcel_stable_share), 6) AS median_stable_share, count(*) AS n_rows, count(weak_target) AS n_labelled FROM lab")
def label_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = labels.weak_labels(dynamic_years(spark, sf_dir))
    counts = df.agg(F.count("*").alias("n_rows"), F.count("weak_target").alias("n_labelled"))
    medians = stats.quantiles(df, [], {"median_obs": (F.col("negative_parcel_obs"), 0.5), "median_stable_share": (F.col("negative_parcel_stable_share"), 0.5)})
    return stats.joined_on(counts, medians, []).select(F.round("median_obs", 6).alias("median_obs"), F.round("median_stable_share", 6).alias("median_stable_share"), "n_rows", "n_labelled")


@query(f"""WITH {PY}, l AS (SELECT c_custkey AS parcel_id, CASE WHEN c_custkey % 5 = 0 THEN 'BUILDING' WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS garea, CAST(c_nationkey AS DOUBLE) * 10 AS g_area_m2 FROM customer),
p AS (SELECT area, parcel_id, year, CASE WHEN parcel_id % 3 <> 0 THEN CAST(n AS DOUBLE) END AS area_m2 FROM py)
SELECT coalesce(garea, area) AS area, p.parcel_id, year, coalesce(area_m2, g_area_m2) AS area_m2 FROM p LEFT JOIN l ON l.parcel_id = p.parcel_id WHERE NOT (garea IS NOT NULL AND area IS DISTINCT FROM garea)""")
def area_consistency(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcel_years(spark, sf_dir).select("area", "parcel_id", "year", F.when(F.col("parcel_id") % 3 != 0, F.col("n").cast("double")).alias("area_m2"))
    known = F.when(F.col("c_custkey") % 5 == 0, "BUILDING").when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment"))
    lookup = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("parcel_id"), known.alias("area"), (F.col("c_nationkey").cast("double") * 10).alias("area_m2"))
    return features.consistent_areas(df, lookup).select("area", "parcel_id", "year", "area_m2")


@query("""SELECT d.doc_id AS parcel_id, source AS area, CAST(doc_id_year AS BIGINT) AS year, CASE WHEN quality IS NOT NULL THEN quality = 1 END AS is_valid
FROM (SELECT *, doc_id % 3 AS doc_id_year FROM documents) d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def validity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("parcel_id"), F.col("source").alias("area"), F.pmod("doc_id", F.lit(3)).cast("long").alias("year"))
    flags = docs.join(table(spark, sf_dir, "labels").withColumnRenamed("doc_id", "parcel_id"), "parcel_id").select("area", "year", "parcel_id", text.flag(F.col("quality").cast("string")).alias("is_valid"))
    return features.with_validity(docs, flags).select("parcel_id", "area", "year", "is_valid")


@query(f"""WITH {DY} SELECT 'delta_ndvi_mean' AS column, round(avg((delta_ndvi_mean IS NULL)::INT), 9) AS missing_share FROM dy UNION ALL SELECT 'ndvi_mean', round(avg((ndvi_mean IS NULL)::INT), 9) FROM dy UNION ALL SELECT 'roll2__change_share', round(avg((roll2__change_share IS NULL)::INT), 9) FROM dy""")
def missing_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.missing_shares(dynamic_years(spark, sf_dir), ["ndvi_mean", "delta_ndvi_mean", "roll2__change_share"]).withColumn("missing_share", F.round("missing_share", 9))


def _pair(a: str, b: str) -> str:
    rank = lambda c: f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"
    return f"SELECT '{a}' AS a, '{b}' AS b, count(*) AS n, round(corr(ra, rb), 6) AS rho FROM (SELECT {rank(a)} AS ra, {rank(b)} AS rb FROM dy WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"


SPEARMAN = ["ndvi_mean", "change_share", "water_share", "delta_ndvi_mean"]


@query(f"WITH {DY} " + " UNION ALL ".join(_pair(a, b) for i, a in enumerate(SPEARMAN) for b in SPEARMAN[i + 1 :]))
def spearman_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.spearman_pairs(dynamic_years(spark, sf_dir), SPEARMAN, "parcel_id").withColumn("rho", F.round("rho", 6))


@query(f"WITH {DY}, p AS (" + " UNION ALL ".join(_pair(a, b) for i, a in enumerate(SPEARMAN) for b in SPEARMAN[i + 1 :]) + ") SELECT * FROM p WHERE abs(rho) >= 0.3 ORDER BY abs(rho) DESC")
def high_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a threshold; the usual one is 0.9."""
    pairs = stats.spearman_pairs(dynamic_years(spark, sf_dir), SPEARMAN, "parcel_id").withColumn("rho", F.round("rho", 6))
    return pairs.filter(F.abs("rho") >= 0.3).orderBy(F.desc(F.abs("rho")), "a", "b")


@query(f"WITH {DY}, e AS (SELECT min(delta_ndvi_mean) AS lo, max(delta_ndvi_mean) AS hi FROM dy) SELECT area, parcel_id, year, round((delta_ndvi_mean - lo) / (hi - lo), 9) AS unit FROM dy, e")
def minmax_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.with_unit_scaled(dynamic_years(spark, sf_dir), {"unit": "delta_ndvi_mean"}).select("area", "parcel_id", "year", F.round("unit", 9).alias("unit"))


def _pct(c: str) -> str:
    return f"CASE WHEN {c} IS NOT NULL THEN (rank() OVER (PARTITION BY area, year, {c} IS NULL ORDER BY {c}) + (count(*) OVER (PARTITION BY area, year, {c}) - 1) / 2.0) / count({c}) OVER (PARTITION BY area, year) END"


@query(f"""WITH {SC}, r AS (SELECT *, {_pct("pred_boost")} AS rb, {_pct("pred_baseline_risk")} AS rr FROM sc)
SELECT area, year, parcel_id, round(rb, 9) AS pred_boost_rank_pct, round(rr, 9) AS pred_baseline_risk_rank_pct, round(abs(pred_boost - pred_baseline_risk), 9) AS ml_disagreement,
  (coalesce(rb >= 0.9, false) OR coalesce(rr >= 0.9, false)) AND coalesce(abs(pred_boost - pred_baseline_risk) >= 0.15, false) AS ml_attention_flag FROM r""")
def pct_rank_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scoring.attention(scoring.export_ranks(scored(spark, sf_dir), ["pred_boost", "pred_baseline_risk"]), model="pred_boost")
    return df.select("area", "year", "parcel_id", *[F.round(c, 9).alias(c) for c in ("pred_boost_rank_pct", "pred_baseline_risk_rank_pct", "ml_disagreement")], "ml_attention_flag")


@query(f"WITH {PY} SELECT area, parcel_id, year, year = max(year) OVER (PARTITION BY area) AS is_latest FROM py")
def latest_year_holdout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.latest_years(parcel_years(spark, sf_dir)).select("area", "parcel_id", "year", "is_latest")


def _metrics(c: str) -> str:
    return f"""SELECT '{c}' AS model, count(*) AS n, CAST(sum(y) AS BIGINT) AS n_positive, round((sum(CASE WHEN y = 1 THEN r END) - sum(y) * (sum(y) + 1) / 2) / (sum(y) * (count(*) - sum(y))), 9) AS roc_auc,
  round((SELECT sum(tp / tps_all * tps / cs) FROM (SELECT tp, sum(tp) OVER () AS tps_all, sum(tp) OVER (ORDER BY p DESC) AS tps, sum(c) OVER (ORDER BY p DESC) AS cs FROM (SELECT {c} AS p, CAST(sum(weak_target) AS DOUBLE) AS tp, CAST(count(*) AS DOUBLE) AS c FROM sc WHERE weak_target IS NOT NULL AND {c} IS NOT NULL GROUP BY 1))), 9) AS pr_auc,
  round(-avg(y * ln(q) + (1 - y) * ln(1 - q)), 9) AS logloss, round(avg((q - y) * (q - y)), 9) AS brier
FROM (SELECT CAST(weak_target AS DOUBLE) AS y, least(greatest({c}, 1e-6), 1 - 1e-6) AS q, CAST(rank() OVER (ORDER BY {c}) AS DOUBLE) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS r FROM sc WHERE weak_target IS NOT NULL AND {c} IS NOT NULL)"""


MODELS = ["pred_logit", "pred_boost", "pred_baseline_risk"]


@query(f"WITH {SC} " + " UNION ALL ".join(_metrics(c) for c in MODELS))
def auc_ap_logloss_brier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.model_metrics(scored(spark, sf_dir), "weak_target", MODELS).select("model", "n", "n_positive", *[F.round(c, 9).alias(c) for c in ("roc_auc", "pr_auc", "logloss", "brier")])


FOLDS = f"""{SC}, f AS (SELECT parcel_id % 5 AS fold, m.model, weak_target AS y, least(greatest(CASE m.model WHEN 'pred_logit' THEN pred_logit ELSE pred_baseline_risk END, 1e-6), 1 - 1e-6) AS q FROM sc, (VALUES ('pred_logit'), ('pred_baseline_risk')) m(model) WHERE weak_target IS NOT NULL),
g AS (SELECT model, fold, -avg(y * ln(q) + (1 - y) * ln(1 - q)) AS logloss, avg((q - y) * (q - y)) AS brier FROM f GROUP BY 1, 2),
s AS (SELECT model, avg(logloss) AS logloss_mean, stddev_samp(logloss) AS logloss_std, avg(brier) AS brier_mean, stddev_samp(brier) AS brier_std FROM g GROUP BY 1)"""


def _cv(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scored(spark, sf_dir).withColumn("fold", F.pmod("parcel_id", F.lit(5)))
    parts = [scoring.metrics(df, "weak_target", m, ["fold"]).withColumn("model", F.lit(m)) for m in ("pred_logit", "pred_baseline_risk")]
    return scoring.cv_summary(features.union_all(parts), ["logloss", "brier", "pr_auc", "roc_auc"])


@query(f"WITH {FOLDS} SELECT model, round(logloss_mean, 9) AS logloss_mean, round(logloss_std, 9) AS logloss_std, round(brier_mean, 9) AS brier_mean, round(brier_std, 9) AS brier_std FROM s")
def cv_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cv(spark, sf_dir).select("model", *[F.round(c, 9).alias(c) for c in ("logloss_mean", "logloss_std", "brier_mean", "brier_std")])


@query(f"WITH {FOLDS} SELECT model FROM s ORDER BY logloss_mean, brier_mean LIMIT 1")
def model_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.best_model(_cv(spark, sf_dir)).select("model")


@query(f"""WITH {SC}, q AS (SELECT *, quantile_cont(pred_boost, 1 - 0.1) OVER (PARTITION BY area, year) AS t FROM sc),
a AS (SELECT area, year, count(*) AS n_total, CAST(sum(inside_mask::INT) AS BIGINT) AS n_inside, CAST(sum((NOT inside_mask)::INT) AS BIGINT) AS n_outside, avg(pred_boost) FILTER (inside_mask) AS i, avg(pred_boost) FILTER (NOT inside_mask) AS o,
  avg(coalesce(pred_boost >= t, false)::INT) FILTER (inside_mask) AS si, avg(coalesce(pred_boost >= t, false)::INT) FILTER (NOT inside_mask) AS so FROM q GROUP BY 1, 2)
SELECT area, year, n_total, n_inside, n_outside, n_inside < 3 OR n_outside < 10 AS thin, round(i, 9) AS inside_mean, round(o, 9) AS outside_mean, round(i - o, 9) AS inside_minus_outside, round(i / greatest(o, 1e-9), 6) AS lift,
  round(si, 9) AS topq_inside_share, round(so, 9) AS topq_outside_share FROM a""")
def external_mask_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scoring.external_stats(scored(spark, sf_dir), ["pred_boost"])
    digits = {"inside_mean": 9, "outside_mean": 9, "inside_minus_outside": 9, "lift": 6, "topq_inside_share": 9, "topq_outside_share": 9}
    return df.select("area", "year", "n_total", "n_inside", "n_outside", "thin", *[F.round(f"pred_boost_{c}", n).alias(c) for c, n in digits.items()])


@query(f"""WITH {SC} SELECT parcel_id, round(CASE WHEN pred_boost IS NULL THEN pred_logit ELSE (pred_logit + pred_boost) / 2 END, 9) AS pred_ml_mean, round(pred_boost, 9) AS pred_ml_final, round(pred_boost - pred_baseline_risk, 9) AS pred_ml_minus_baseline FROM sc""")
def combined_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scoring.combined_predictions(scored(spark, sf_dir), ["pred_logit", "pred_boost"], "pred_boost")
    return df.select("parcel_id", *[F.round(c, 9).alias(c) for c in ("pred_ml_mean", "pred_ml_final", "pred_ml_minus_baseline")])


CAT = """cat AS (SELECT o_orderkey, c_mktsegment AS area, CAST(o_orderdate AS DATE) AS date, CAST(o_orderkey % 3 AS BIGINT) AS time, CASE o_orderkey % 4 WHEN 0 THEN 'PAN' WHEN 1 THEN 'PMS' ELSE 'MS' END AS product, CASE o_orderstatus WHEN 'F' THEN 'L1' WHEN 'O' THEN 'L2' ELSE 'L3' END AS level, o_orderpriority AS scene_pkg, CAST(o_orderkey AS VARCHAR) AS tif_path FROM orders JOIN customer ON c_custkey = o_custkey),
sco AS (SELECT *, CAST(CASE product WHEN 'MS' THEN 0 WHEN 'PMS' THEN 10 WHEN 'PAN' THEN 20 ELSE 50 END + CASE level WHEN 'L2' THEN 0 WHEN 'L1' THEN 1 ELSE 5 END AS BIGINT) AS score FROM cat)"""


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    df = o.join(c, o.o_custkey == c.c_custkey).select(key, F.col("c_mktsegment").alias("area"), F.to_date("o_orderdate").alias("date"), F.pmod(key, F.lit(3)).cast("long").alias("time"), F.when(key % 4 == 0, "PAN").when(key % 4 == 1, "PMS").otherwise("MS").alias("product"), F.when(F.col("o_orderstatus") == "F", "L1").when(F.col("o_orderstatus") == "O", "L2").otherwise("L3").alias("level"), F.col("o_orderpriority").alias("scene_pkg"), key.cast("string").alias("tif_path"))
    return df.withColumn("score", text.scene_score(F.col("product"), F.col("level")).cast("long"))


@query(f"WITH {CAT} SELECT area, CAST(date AS VARCHAR) AS date, time, score, scene_pkg, tif_path FROM sco WHERE product = 'MS' QUALIFY row_number() OVER (PARTITION BY area, date, time ORDER BY score, scene_pkg, tif_path) = 1")
def scene_catalog_best(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.best_scenes(_catalog(spark, sf_dir)).select("area", F.col("date").cast("string").alias("date"), "time", "score", "scene_pkg", "tif_path")


@query(f"WITH {CAT}, k AS (SELECT *, CASE WHEN o_orderkey % 2 = 0 THEN scene_pkg END AS maybe FROM sco) SELECT area, time, arg_min(maybe, (score, o_orderkey)) FILTER (maybe IS NOT NULL) AS maybe, arg_min(level, (score, o_orderkey)) AS level FROM k GROUP BY area, time")
def first_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _catalog(spark, sf_dir).withColumn("maybe", F.when(F.col("o_orderkey") % 2 == 0, F.col("scene_pkg")))
    return scenes.first_values(df, ["area", "time"], ["score", "o_orderkey"], ["maybe", "level"])


@query(f"WITH {CAT} SELECT 'area' AS dimension, area AS value, count(*) AS n FROM cat GROUP BY area UNION ALL SELECT 'product', product, count(*) FROM cat GROUP BY product UNION ALL SELECT 'level', level, count(*) FROM cat GROUP BY level")
def inventory_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scenes.inventory(_catalog(spark, sf_dir), ["area", "product", "level"])


@query(f"WITH {CAT} SELECT area, count(DISTINCT (date, time)) AS n_acquisitions, count(*) AS n_scenes FROM cat GROUP BY area")
def distinct_acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog(spark, sf_dir).groupBy("area").agg(F.count_distinct(F.struct("date", "time")).alias("n_acquisitions"), F.count("*").alias("n_scenes"))


@query(f"WITH {PY}, k AS (SELECT CASE WHEN parcel_id % 9 <> 0 THEN area END AS area, parcel_id, year FROM py) SELECT area, year, count(*) AS n, CASE WHEN area IS NOT NULL THEN count(DISTINCT parcel_id) END AS parcels FROM k GROUP BY 1, 2")
def rows_by_area_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcel_years(spark, sf_dir).withColumn("area", F.when(F.col("parcel_id") % 9 != 0, F.col("area")))
    return df.groupBy("area", "year").agg(F.count("*").alias("n"), F.when(F.col("area").isNotNull(), F.count_distinct("parcel_id")).alias("parcels"))


@query(f"WITH {PY} SELECT area, parcel_id, year, change_share, CAST(NULL AS DOUBLE) AS water_share FROM py WHERE year < 1998 UNION ALL SELECT area, parcel_id, year, NULL, water_share FROM py WHERE year >= 1998")
def heterogeneous_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = parcel_years(spark, sf_dir)
    keys = ["area", "parcel_id", "year"]
    return features.union_all([df.filter("year < 1998").select(*keys, "change_share"), df.filter("year >= 1998").select(*keys, "water_share")])


@query("SELECT o_custkey, o_orderkey, o_totalprice FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1")
def keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.keep_first(table(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query(f"WITH {SC}, k AS (SELECT * FROM sc WHERE weak_target IS NOT NULL), h AS (SELECT * FROM k ORDER BY parcel_id LIMIT 200) SELECT k.parcel_id, h.parcel_id IS NOT NULL AS eval_row FROM k LEFT JOIN h ON h.parcel_id = k.parcel_id")
def early_stop_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = scored(spark, sf_dir).filter("weak_target in (0, 1)")
    return scoring.early_stop_rows(df, "weak_target", ["parcel_id"]).select("parcel_id", "eval_row")


@query(f"WITH {SC} SELECT s.parcel_id, s.pred_logit, p.n_chars FROM (SELECT doc_id, source, n_chars FROM documents WHERE lang <> 'de') p JOIN sc s ON s.parcel_id = p.doc_id AND s.area = p.source")
def geometry_inner_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    parcels = table(spark, sf_dir, "documents").filter("lang <> 'de'").select(F.col("doc_id").alias("parcel_id"), F.col("source").alias("area"), "n_chars")
    return parcels.join(scored(spark, sf_dir), ["parcel_id", "area"], "inner").select("parcel_id", "pred_logit", "n_chars")


@query(f"WITH {SC} SELECT s.parcel_id, s.pred_logit, p.quality FROM labels p RIGHT JOIN sc s ON s.parcel_id = p.doc_id")
def geometry_right_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    parcels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("parcel_id"), "quality")
    return parcels.join(scored(spark, sf_dir), "parcel_id", "right").select("parcel_id", "pred_logit", "quality")
