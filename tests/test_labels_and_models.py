import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from loamline.functions import nulls, stats, text
from loamline.operators import clustering, features, labels, models, scoring
from loamline.plans import stages


def rows_of(spark):
    """Forty parcels over three years with a clear signal in every fourth."""
    rng = np.random.default_rng(1)
    out = []
    for p in range(40):
        for y in (2020, 2021, 2022):
            hot = p % 4 == 0
            v = lambda lo, hi: float(rng.uniform(lo, hi))
            out.append(("A" if p < 20 else "B", f"p{p}", y, v(0.6, 1) if hot else v(0, 0.4), v(0.6, 1) if hot else v(0, 0.4), v(0.5, 1) if hot else v(0, 0.3), v(-0.5, -0.2) if hot else v(-0.05, 0.05), v(0.2, 0.5) if hot else v(-0.05, 0.05), v(0, 1), v(0.5, 1) if hot else v(0, 0.5)))
    return spark.createDataFrame(out, "area string, parcel_id string, year int, change_share double, texture_anomaly_share double, water_share double, delta_ndvi_mean double, delta_ndwi_mean double, ndvi_mean double, risk_score_mean double")


def test_labels_partition_the_rows(spark):
    out, pivot = stages.labelled(features.with_temporal(rows_of(spark), features.TEMPORAL))
    kinds = {r.label_type: r for r in out.groupBy("label_type").agg(F.count("*").alias("n"), F.min("weak_target").alias("lo"), F.max("weak_target").alias("hi"), F.min("sample_weight").alias("w")).collect()}
    assert sum(r.n for r in kinds.values()) == 120 and pivot.count() == 2
    assert (kinds["confident_positive"].lo, kinds["confident_positive"].hi) == (1, 1)
    assert (kinds["confident_negative"].lo, kinds["confident_negative"].w) == (0, 1.1)
    assert kinds["uncertain"].hi is None
    assert out.filter("label_type = 'confident_positive' and not (high_change or high_texture or high_water)").count() == 0
    hit = out.select("area", "parcel_id", "year", *[c for c in out.columns if c in rows_of(spark).columns and c not in ("area", "parcel_id", "year")]).withColumn("literature_mask_hit", F.lit(True)).withColumn("n_missing_primary", F.lit(0))
    assert labels.weak_labels(hit).filter("label_type = 'confident_negative'").count() == 0
    none = labels.weak_labels(hit.withColumn("n_missing_primary", F.lit(None).cast("int")))
    assert none.filter("label_is_eligible").count() == 0 and none.filter("weak_target is not null").count() == 0


def test_rules_without_their_features(spark):
    df = labels.with_rules(spark.createDataFrame([("A", 1)], "area string, parcel_id int"))
    r = df.first()
    assert not (r.high_change or r.high_water or r.veg_loss or r.low_change) and r.stable_ndvi and r.low_hotspot and not r.row_ready


def test_a_missing_area_has_no_threshold(spark):
    df = stats.with_group_quantiles(spark.createDataFrame([("A", 1.0), ("A", None), (None, 9.0), ("B", None)], "area string, v double"), ["area"], {"q": (F.col("v"), 0.5)})
    assert sorted((str(r.area), r.v, r.q) for r in df.collect() if r.v is not None) == [("A", 1.0, 1.0), ("None", 9.0, None)] and df.count() == 4


def test_years_apart_and_single(spark):
    df = spark.createDataFrame([("A", 1, 2018, 1.0), ("A", 1, 2021, 3.0), ("A", 2, 2020, None), ("B", 1, 2019, 5.0)], "area string, parcel_id int, year int, ndvi_mean double")
    got = {(r.area, r.parcel_id, r.year): (r.prev1__ndvi_mean, r.d1__ndvi_mean, r.roll2__ndvi_mean, r.year_gap) for r in features.with_temporal(df, ["ndvi_mean", "gone"]).collect()}
    assert got == {("A", 1, 2018): (None, None, 1.0, None), ("A", 1, 2021): (1.0, 2.0, 2.0, 3), ("A", 2, 2020): (None, None, None, None), ("B", 1, 2019): (None, None, 5.0, None)}


def test_area_conflicts(spark):
    df = spark.createDataFrame([(1, "A", 5.0), (2, "B", None), (3, None, 1.0), (4, "A", 2.0)], "parcel_id int, area string, area_m2 double")
    lookup = spark.createDataFrame([(1, "A", 7.0), (2, "A", 8.0), (3, "A", 9.0)], "parcel_id int, area string, area_m2 double")
    strict = {r.parcel_id: (r.area, r.area_m2) for r in features.consistent_areas(df, lookup).collect()}
    assert strict == {1: ("A", 5.0), 4: ("A", 2.0)}  # a missing area conflicts with a known one
    lenient = {r.parcel_id: (r.area, r.area_m2) for r in features.consistent_areas(df, lookup, strict=False, prefer_geometry=True).collect()}
    assert lenient == {1: ("A", 7.0), 2: ("A", 8.0), 3: ("A", 9.0), 4: ("A", 2.0)}


def test_nulls(spark):
    df = spark.createDataFrame([(float("nan"), "x"), (float("inf"), "1e3"), (2.0, None), (None, "nan")], "v double, t string")
    got = nulls.all_finite(df).select("v", nulls.number(F.col("t")).alias("n"), nulls.log_area(F.col("v")).alias("l"), nulls.clipped_probability(F.col("v")).alias("c"), nulls.mean_of([F.col("v"), nulls.number(F.col("t"))]).alias("m")).collect()
    assert [(r.v, r.n) for r in got] == [(None, None), (None, 1000.0), (2.0, None), (None, None)]
    assert [r.l for r in got][3] is None and got[2].c == 1 - 1e-6 and [r.m for r in got] == [None, 1000.0, 2.0, None]


def test_average_ranks(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", 2.0), ("g", 5.0), ("g", None)], "k string, v double")
    assert sorted(r.p for r in stats.with_percent_ranks(df, {"p": "v"}, ["k"]).collect() if r.p) == [0.25, 0.625, 0.625, 1.0]


def test_metrics_with_ties_and_one_class(spark):
    df = spark.createDataFrame([("a", 1, 0.9), ("a", 0, 0.5), ("a", 1, 0.5), ("a", 0, 0.1), ("b", 1, 0.3), ("b", 1, 0.6), ("c", None, 0.3)], "m string, y int, p double")
    got = {r.m: r for r in scoring.metrics(df, "y", "p", ["m"]).collect()}
    assert got["a"].roc_auc == 0.875 and abs(got["a"].pr_auc - (0.5 + 0.5 * 2 / 3)) < 1e-12 and got["b"].roc_auc is None and got["b"].pr_auc is None and "c" not in got


def test_column_names():
    assert text.match_for(["x", "NDVI_avg_std", "my_ndvi_mean_v2", "ndvi_mean"], text.FEATURE_PATTERNS["ndvi_mean"]) == "ndvi_mean"
    assert text.match_for(["a_ndvi_mean_long", "b_ndvi_mean"], text.FEATURE_PATTERNS["ndvi_mean"]) == "b_ndvi_mean"
    assert text.match_for(["q"], text.FEATURE_PATTERNS["ndvi_mean"]) is None
    numeric, categorical = text.training_features(["area", "ndvi_mean", "risk_score_mean", "prev1__ndvi_mean", "prev1__hotspot_share", "log_area_m2"])
    assert numeric == ["ndvi_mean", "prev1__ndvi_mean", "log_area_m2"] and categorical == ["area"]


def test_usage_texts(spark):
    rows = [("Пашня №1", True, True), ("ПАСТБИЩА", True, True), ("лпх", True, False), ("ЛПХ (полевой участок)", True, True), ("садоводство", False, False), ("", False, False), (None, False, False), ("для ведения  крестьянского хозяйства", True, False)]
    df = spark.createDataFrame(rows, "t string, core boolean, strict boolean")
    got = df.select("t", "core", "strict", text.usage_core(F.col("t")).alias("c"), text.usage_strict(F.col("t")).alias("s")).collect()
    assert [(r.t, r.c, r.s) for r in got] == rows


def test_clusters_of_blobs():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(c, 0.3, (80, 2)) for c in ((0, 0), (5, 5), (0, 6))] + [rng.uniform(-4, 10, (15, 2))])
    found, probability, outlier = clustering.hdbscan(x, 20, 5)
    assert len(set(found) - {-1}) == 3
    for i in range(3):
        part = found[i * 80 : (i + 1) * 80]
        values, counts = np.unique(part, return_counts=True)
        assert counts.max() >= 70 and values[counts.argmax()] >= 0
    assert ((probability >= 0) & (probability <= 1)).all() and (probability[found == -1] == 0).all() and ((outlier >= 0) & (outlier <= 1)).all()
    assert outlier[240:].mean() > outlier[:240].mean()
    assert (clustering.hdbscan(x[:10], 20, 5)[0] == -1).all()


def test_clusters_beyond_one_task(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(c, 0.4, (250, 4)) for c in (0, 3, 7)] + [rng.uniform(-4, 12, (60, 4)), np.zeros((5, 4))])
    one, many = clustering.mutual_tree(x, 5), clustering.spread_tree(spark, x, 5)
    assert len(many) == len(x) - 1 and np.allclose(one[:, 2], many[:, 2], atol=1e-6)
    df = spark.createDataFrame([(i, Vectors.dense(v)) for i, v in enumerate(x)], ["i", "features"])
    want, got = (clustering.clustered(df, ["i"], "features", 20, 5, most=m).orderBy("i").toPandas() for m in (10_000, 100))
    assert (want["cluster_id"] == -1).any() and want["cluster_id"].nunique() == 4
    pairs = set(zip(want["cluster_id"], got["cluster_id"]))
    assert len(pairs) == 4 and (-1, -1) in pairs
    assert np.allclose(want["cluster_prob"], got["cluster_prob"], atol=1e-5) and np.allclose(want["cluster_outlier"], got["cluster_outlier"], atol=1e-5)


def test_training_end_to_end(spark):
    df, _ = stages.labelled(features.with_temporal(rows_of(spark), features.TEMPORAL))
    out = stages.trained(df.cache(), 3, {"iterations": 5, "depth": 3})
    scored = out["scored"].cache()
    assert scored.count() == 120 and scored.filter("pred_ml_final is null or pred_ml_final < 0 or pred_ml_final > 1").count() == 0
    summary = {r.model: r for r in out["summary"].collect()}
    assert set(summary) == {"logit", "boost", "baseline_risk"} and summary["logit"].roc_auc_mean > 0.9
    final = stages.exported(scored)
    assert final.columns[:3] == ["area", "parcel_id", "year"] and final.count() == 120
    assert {r.model for r in stages.validated(scored)["internal"].collect()} >= {"pred_logit", "pred_ml_final"}
    with pytest.raises(ValueError):
        models.check_trainable(df.limit(10), "weak_target")


def test_early_stop_and_saved_models(spark, tmp_path):
    df, _ = stages.labelled(features.with_temporal(rows_of(spark), features.TEMPORAL))
    df = df.cache()
    folder = str(tmp_path / "models")
    out = stages.trained(df, 2, {"iterations": 8, "depth": 2, "learning_rate": 0.5}, folder)
    again = {(r.parcel_id, r.year): r for r in stages.scored_by(folder, df).collect()}
    for r in out["scored"].collect():
        other = again[r.parcel_id, r.year]
        assert (r.pred_logit, r.pred_boost, r.pred_ml_final) == pytest.approx((other.pred_logit, other.pred_boost, other.pred_ml_final))
    assert {r.model for r in out["holdout"].collect()} == {"pred_baseline_risk", "pred_logit", "pred_boost", "pred_ml_mean"}
    assert out["importance"].agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_regression_and_trees_on_plain_data(spark):
    """A separable column is found by both; a regression without signal gives the balanced share."""
    rng = np.random.default_rng(6)
    rows = [(float(x), float(z), None if i % 11 == 0 else "ab"[i % 2], int(x > 0.3)) for i, (x, z) in enumerate(rng.normal(size=(300, 2)))]
    df = spark.createDataFrame(rows, "x double, z double, c string, y int")
    for fit in (models.fit_logit, lambda *a: models.fit_boost(*a, settings={"iterations": 5, "depth": 2})):
        got = models.probability(fit(df, "y", ["x", "z"], ["c"]), df, ["c"], "p").collect()
        assert np.mean([(r.p > 0.5) == bool(r.y) for r in got]) > 0.95
    # Validation rows that the trees learn nothing about end the training early.
    noise = df.withColumn("y", (F.pmod(F.xxhash64("z"), F.lit(2))).cast("int"))
    few = models.fit_boost(df, "y", ["x", "z"], [], validation=noise, settings={"iterations": 30, "depth": 2, "learning_rate": 0.5})
    assert few.stages[-1].getNumTrees < 30
    flat = models.probability(models.fit_logit(df.withColumn("z", F.lit(1.0)), "y", ["z"], []), df.withColumn("z", F.lit(1.0)), [], "p").agg(F.avg("p")).first()[0]
    assert flat == pytest.approx(0.5, abs=1e-6)
    assert scoring.early_stop_rows(df, "y", ["x"], whole=5, each=7).filter("eval_row").groupBy("y").count().filter("count = 7").count() == 2


def test_groups_stay_in_one_fold(spark):
    df = rows_of(spark).withColumn("y", (F.substring("parcel_id", 2, 5).cast("int") % 4 == 0).cast("int"))
    out = models.with_folds(df, "y", "parcel_id", 4)
    assert out.groupBy("parcel_id").agg(F.count_distinct("fold").alias("n")).filter("n > 1").count() == 0
    assert out.groupBy("fold").agg(F.count_distinct("y").alias("n")).filter("n = 2").count() == 4


@pytest.mark.parametrize("bound", [0, stats.BOUND])
def test_quantiles_are_exact_at_any_size(spark, monkeypatch, bound):
    """Far values, heavy ties, small and large groups, missing values and keys: against NumPy's linear quantiles."""
    monkeypatch.setattr(stats, "BOUND", bound)
    rng = np.random.default_rng(3)
    parts = {"wide": np.exp(rng.normal(0, 8, 60_000)), "ties": rng.integers(0, 4, 40_000).astype(float), "one": np.array([7.0]), "two": np.array([1.0, 2.0]), "same": np.full(500, 3.0)}
    rows = [(k, float(v), -float(v)) for k, vs in parts.items() for v in vs] + [(None, 1.0, 1.0), ("none", None, None), ("two", None, None)]
    df = spark.createDataFrame(rows, "k string, a double, b double").repartition(6)
    places = {"q0": 0.0, "q05": 0.05, "q5": 0.5, "q9": 0.9, "q999": 0.999, "q1": 1.0}
    got = {r.k: r for r in stats.quantiles(df, ["k"], {n: (F.col("a"), q) for n, q in places.items()} | {"other": (F.abs("b"), 0.25)}).collect()}
    assert set(got) == set(parts)
    for k, vs in parts.items():
        for n, q in places.items():
            assert np.isclose(got[k][n], np.quantile(vs, q), rtol=1e-12), (k, n)
        assert np.isclose(got[k].other, np.quantile(np.abs(vs), 0.25), rtol=1e-12)
    joined = stats.with_group_quantiles(df, ["k"], {"q": (F.col("a"), 0.5)})
    assert joined.count() == len(rows) and joined.filter("k is null and q is null").count() == 1
    assert stats.quantiles(df.filter("k = 'none'"), [], {"q": (F.col("a"), 0.5)}).collect()[0].q is None
    every = stats.quantiles(df, [], {"q": (F.col("a"), 0.75)}).first().q
    assert np.isclose(every, np.quantile([r[1] for r in rows if r[1] is not None], 0.75), rtol=1e-12)


@pytest.mark.parametrize("bound", [0, stats.BOUND])
def test_ranks_and_running_sums_over_partitions(spark, monkeypatch, bound):
    monkeypatch.setattr(stats, "BOUND", bound)
    rng = np.random.default_rng(4)
    rows = [(k, float(v), i) for i, (k, v) in enumerate(zip(rng.choice(["hot", "hot", "b", None], 30_000), np.round(rng.normal(0, 100, 30_000), 1)))] + [("b", None, -1)]
    df = spark.createDataFrame(rows, "k string, v double, _part int").repartition(5)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = stats.with_percent_ranks(df, {"p": "v"}, ["k"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(rows)
    for k in ("hot", "b", None):
        mine = [(r.v, r.p) for r in got if r.k == k and r.v is not None]
        values = np.sort([v for v, _ in mine])
        low, high = np.searchsorted(values, [v for v, _ in mine], "left"), np.searchsorted(values, [v for v, _ in mine], "right")
        assert np.allclose([p for _, p in mine], (low + high + 1) / 2 / len(mine))
    assert [r.p for r in got if r.v is None] == [None]


@pytest.mark.parametrize("bound", [0, stats.BOUND])
def test_spearman_against_ranks(spark, monkeypatch, bound):
    monkeypatch.setattr(stats, "BOUND", bound)
    rng = np.random.default_rng(5)
    a = rng.integers(0, 50, 5000).astype(float)
    b, c = a + rng.normal(0, 20, 5000), -np.round(a / 7)
    df = spark.createDataFrame([(float(x), None if i % 9 == 0 else float(y), float(z), 1.0) for i, (x, y, z) in enumerate(zip(a, b, c))], "a double, b double, c double, d double")
    got = {(r.a, r.b): (r.n, r.rho) for r in stats.spearman_pairs(df, ["a", "b", "c", "d"], "a").collect()}

    def rank(x):
        s = np.sort(x)
        return (np.searchsorted(s, x, "left") + np.searchsorted(s, x, "right") + 1) / 2

    there = np.arange(5000) % 9 != 0
    assert got["a", "b"][0] == there.sum() and np.isclose(got["a", "b"][1], np.corrcoef(rank(a[there]), rank(b[there]))[0, 1])
    assert np.isclose(got["a", "c"][1], np.corrcoef(rank(a), rank(c))[0, 1]) and got["a", "d"][1] is None
