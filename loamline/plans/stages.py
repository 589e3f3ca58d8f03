"""Whole stages: from scenes to parcel statistics, from parcel-years to exported predictions, audits, and the tools around them.

Each stage is a function of tables and settings that returns tables; files come in and go out by the sources package.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats, text
from ..functions.nulls import mean_of
from ..operators import audit, clustering, features, geometry, labels, models, raster, scoring, spatial
from ..session import written
from ..sources import files

# Order of an export's columns.
EXPORT = ["area", "parcel_id", "cad_num", "year", "area_m2", "pred_ml_final", "pred_ml_mean", "pred_logit", "pred_boost", "pred_baseline_risk", "pred_ml_minus_baseline", "ml_disagreement", "ml_attention_flag", "label_type", "weak_target", "cluster_id", "cluster_prob", "cluster_outlier"]


@dataclass
class RasterSettings:
    soil: str = "osavi"
    water_threshold: float | None = None
    texture: str = "nir_local_std"
    texture_window: int = 7
    glcm_windows: tuple[int, ...] = ()
    cell_area: float = 1.0
    dx: float = 1.0
    dy: float = 1.0
    masked: bool = True
    layers: list[str] = field(default_factory=lambda: ["ndvi", "ndwi", "brightness", "delta_ndvi", "delta_ndwi", "risk_score"])


def raster_run(pixels: DataFrame, zones: DataFrame | None, dem: DataFrame | None = None, settings: RasterSettings | None = None, prepare: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(pixel layers by area and year, zonal table by area and year).

    pixels: scene_id, area, year, row, col and the four bands of every scene; zones: zone, geometry in grid units and, where they belong to one, area
    (else a zone counts in every area), None for no table; dem: row, col, dem and, where heights differ by area, area. prepare adds layers to the composites.
    Years of an area lie on one grid. The loop over years is a window over each pixel's years.
    """
    s = settings or RasterSettings()
    keys = ["area", "year"]
    px = raster.indices(raster.composite(pixels, keys), s.soil)
    px = raster.water_mask(px, keys, s.water_threshold)
    halo, names, of = raster.local_statistics(s.texture_window)
    if prepare is not None:
        px = written(prepare(px), "prepared")
    else:
        local = raster.focal(px, keys, "nir", halo, names, of).select(*keys, "row", "col", F.col("std").alias("nir_local_std"), F.col("var").alias("nir_local_var"))
        px = px.join(local, [*keys, "row", "col"])
    for w in s.glcm_windows:
        lattice = raster.glcm(px, keys, "nir", w)
        px = px.join(raster.spread(px, lattice, keys, raster.GLCM).withColumnsRenamed({n: f"nir_glcm_{n}_w{w}" for n in raster.GLCM}), [*keys, "row", "col"])
    if dem is not None:
        own = ["area"] if "area" in dem.columns else []
        px = px.join(raster.terrain(dem, own, "dem", s.dx, s.dy), [*own, "row", "col"], "left")
    px = raster.with_dynamics(px, ["area"])
    px = raster.high_mask(px, keys, s.texture, raster.TEXTURE_QUANTILE, "texture_anomaly")
    px = raster.change_mask(px, keys)
    px = raster.risk(px, keys, s.texture, s.masked)
    px = raster.high_mask(px, keys, "risk_score", raster.HOTSPOT_QUANTILE, "hotspot")
    comps = raster.components(px, keys, "hotspot")
    px = px.join(comps, [*keys, "row", "col"], "left")
    if zones is None:
        return px, None
    layers = s.layers + [c for c in ("slope", "tpi", "curvature") if c in px.columns]
    # A zone of an area and year is one zone to the zonal table.
    per = px.select(*keys).distinct()
    owned = "area" in zones.columns
    # As many rows as the result has: a zone for each year of its area.
    wide = (zones.join(per, "area") if owned else zones.crossJoin(F.broadcast(per))).select(F.struct(*keys, "zone").alias("zone"))  # one row for each area and year
    joined = spatial.pixels_in_polygons(px, zones, own=["area"] if owned else []).withColumn("zone", F.struct(*keys, "zone"))
    sizes = comps.groupBy("comp_id").agg(F.count("*").alias("n_px"))
    table = spatial.zonal_table(joined, wide, layers, ["water", "change", "texture_anomaly", "hotspot", "persistence_water"], sizes, s.cell_area)
    return px, table.select("zone.area", "zone.year", F.col("zone.zone").alias("parcel_id"), *[c for c in table.columns if c != "zone"])


def test_scenes(spark: SparkSession, n: int = 48) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pixels, zones, dem) of the self-test: three scenes of one area in 2022 and 2023 over n x n cells, two parcels and a hill."""
    grid = spark.range(n * n).select((F.col("id") / n).cast("int").alias("row"), F.pmod("id", F.lit(n)).cast("int").alias("col"))
    x, y = F.col("col") / float(n - 1), F.col("row") / float(n - 1)
    parts = []
    for scene, year, s in (("a", 2022, 0.0), ("b", 2023, 0.03), ("c", 2023, 0.05)):
        wet = F.pow(x - 0.7, 2) + F.pow(y - 0.3, 2) < (0.12 + s / 2) ** 2
        add = lambda v, wet=wet: F.when(wet, F.lit(v)).otherwise(F.lit(0.0))
        parts.append(grid.select(F.lit(scene).alias("scene_id"), F.lit("Амга").alias("area"), F.lit(year).alias("year"), "row", "col", (0.10 + 0.02 * x + 0.01 * y).alias("blue"), (0.15 + 0.05 * x + add(0.12)).alias("green"), (0.18 + 0.05 * y + s + add(-0.04)).alias("red"), (0.35 + 0.08 * x - 0.04 * y - s + add(-0.20)).alias("nir")))
    dem = grid.select("row", "col", (150 + 10 * x + 20 * y + 2 * F.sin(10 * x) * F.cos(8 * y)).alias("dem"))
    at = lambda lon, lat: ((lon - 120.0) / 0.1 * n, (60.1 - lat) / 0.1 * n)
    boxes = [(1, *at(120.01, 60.05), *at(120.05, 60.01)), (2, *at(120.05, 60.08), *at(120.09, 60.02))]
    zones = spark.createDataFrame(boxes, "zone long, x0 double, y0 double, x1 double, y1 double").select("zone", geometry.box(F.col("x0"), F.col("y0"), F.col("x1"), F.col("y1")).alias("geometry"))
    return features.union_all(parts), zones, dem


# ---------------------------------------------------------------- parcel-years


def parcel_year_table(stats_table: DataFrame, lookup: DataFrame | None = None, strict: bool = True) -> tuple[DataFrame, dict]:
    """The feature table with temporal columns, and its report."""
    df = features.consistent_areas(stats_table, lookup, strict) if lookup is not None else stats_table
    out = features.with_temporal(df, features.TEMPORAL)
    by_area = {r[0]: r[1] for r in out.filter("area is not null").groupBy("area").agg(F.count_distinct("parcel_id")).collect()}
    return out, {"rows": out.count(), "columns": out.columns, "parcels_by_area": by_area, "feature_groups": text.feature_groups(out.columns)}


def diagnostics(df: DataFrame, columns: list[str], key: str, high: float = 0.9) -> dict[str, DataFrame]:
    pairs = stats.spearman_pairs(df, columns, key)
    return {"missing": features.missing_shares(df, columns), "spearman": pairs, "high": pairs.filter(F.abs("rho") >= high).orderBy(F.desc(F.abs("rho")), "a", "b")}


def labelled(df: DataFrame, masks: DataFrame | None = None, settings: dict | None = None, cell: float = 0.01) -> tuple[DataFrame, DataFrame]:
    """The table with weak labels, and rows by area and label; masks (gid, geometry) mark parcels by their centroids."""
    if masks is not None:
        points = df.filter("centroid_lon is not null").select("area", "parcel_id", F.col("centroid_lon").alias("x"), F.col("centroid_lat").alias("y")).distinct().withColumn("pid", F.struct("area", "parcel_id"))
        hits = spatial.points_in_polygons(points, masks, cell).select("pid.area", "pid.parcel_id")
        df = spatial.with_hit(df, ["area", "parcel_id"], hits, "literature_mask_hit")
    out = labels.weak_labels(df, settings)
    out = out.withColumn("baseline_risk", F.col("risk_score_mean")) if "risk_score_mean" in out.columns else out
    return out, labels.label_pivot(out)


def clusters(df: DataFrame, numeric: list[str], min_cluster_size: int = 40, min_samples: int = 10, components: int = 10, path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The table with clusters, and their sizes and means; with path what reduces the columns is saved there."""
    keyed = df.withColumn("_key", F.concat_ws("|", "area", F.col("parcel_id").cast("string"), F.col("year").cast("string")))
    out = clustering.clustered(models.reduced(keyed, numeric, components, path), ["_key"], "features", min_cluster_size, min_samples).drop("_key", "features", "_z")
    kept = out.select(*df.columns, "cluster_id", "cluster_prob", "cluster_outlier")
    return kept, clustering.cluster_summary(kept, numeric)


def trained(df: DataFrame, folds: int = 5, boost: dict | None = None, folder: str | None = None) -> dict[str, DataFrame]:
    """Out-of-fold predictions, fold metrics, their summary, the chosen model's name, importances, the whole table scored, and metrics of the last years held out.

    df: a labelled table. The baseline is scaled over the whole table; a model is trained on rows labelled 0 or 1. Boosted trees stop early: by the fold's or the
    held-out rows, in the end by the first labelled ones. With folder, models and what they need are saved there for scored_by().
    """
    numeric, categorical = text.training_features(df.columns)
    models.check_trainable(df, "weak_target")
    base = stats.with_unit_scaled(df, {"pred_baseline_risk": "baseline_risk"})
    known = written(models.with_folds(base.filter("weak_target in (0, 1)"), "weak_target", "parcel_id", folds), "labelled")

    def model_of(name: str, train: DataFrame, stop: DataFrame):
        if name == "logit":
            return models.fit_logit(train, "weak_target", numeric, categorical, "sample_weight")
        return models.fit_boost(train, "weak_target", numeric, categorical, "sample_weight", stop, boost)

    def fitter(name: str):
        def fit(train: DataFrame, stop: DataFrame):
            model = model_of(name, train, stop)
            return lambda test: models.probability(model, test, categorical, f"pred_{name}")

        return fit

    names = ("logit", "boost")
    fits = {n: fitter(n) for n in names} | {"baseline_risk": lambda train, stop: lambda test: test}
    oof, metrics = models.cross_validated(known, "weak_target", fits, folds)
    summary = scoring.cv_summary(metrics, ["roc_auc", "pr_auc", "logloss", "brier"])
    best = scoring.best_model(summary.filter("model <> 'baseline_risk'"))
    order = [c for c in ("area", "parcel_id", "year") if c in known.columns]
    first = scoring.early_stop_rows(known, "weak_target", order).filter("eval_row").select(*known.columns)
    final = {n: model_of(n, known, first) for n in names}
    about = {"numeric": numeric, "categorical": categorical, "final": f"pred_{best.first()['model']}"}
    if folder:
        for n, m in final.items():
            models.saved(m, f"{folder}/{n}")
        files.to_text(df.sparkSession, [json.dumps(about)], f"{folder}/schema")
    out = {"oof": oof, "fold_metrics": metrics, "summary": summary, "best": best, "importance": models.importances(final["boost"], df.sparkSession), "scored": scored_with(base, final, about)}
    last = scoring.latest_years(known)
    train, test = last.filter("not is_latest").drop("is_latest"), last.filter("is_latest").drop("is_latest")
    if test.count() >= 10 and all(d.select("weak_target").distinct().count() == 2 for d in (train, test)):
        held = test
        for n in names:
            held = fits[n](train, test)(held)
        held = held.withColumn("pred_ml_mean", mean_of([F.col(f"pred_{n}") for n in names]))
        out["holdout"] = scoring.model_metrics(held, "weak_target", ["pred_baseline_risk", "pred_logit", "pred_boost", "pred_ml_mean"])
    return out


def scored_with(df: DataFrame, fitted: dict, about: dict) -> DataFrame:
    """df with the predictions of the fitted models, their mean, the final pick and its gap to the baseline."""
    out = df if "pred_baseline_risk" in df.columns else stats.with_unit_scaled(df, {"pred_baseline_risk": "baseline_risk"})
    for n, m in fitted.items():
        out = models.probability(m, out, about["categorical"], f"pred_{n}")
    return scoring.combined_predictions(out, [f"pred_{n}" for n in fitted], about["final"])


def scored_by(folder: str, df: DataFrame) -> DataFrame:
    """df scored by the models that trained() saved in a folder."""
    about = json.loads(df.sparkSession.read.text(f"{folder}/schema").first().value)
    return scored_with(df, {n: models.loaded(f"{folder}/{n}") for n in ("logit", "boost")}, about)


def validated(scored: DataFrame, masks: DataFrame | None = None, cell: float = 0.01) -> dict[str, DataFrame]:
    """Metrics of each prediction on labelled rows, and with masks (gid, geometry) the statistics inside and outside them."""
    names = [c for c in ("pred_baseline_risk", "pred_logit", "pred_boost", "pred_ml_mean", "pred_ml_final") if c in scored.columns]
    out = {"internal": scoring.model_metrics(scored.filter("weak_target in (0, 1)"), "weak_target", names)}
    if masks is not None:
        points = scored.select("area", "parcel_id", F.col("centroid_lon").alias("x"), F.col("centroid_lat").alias("y")).distinct().withColumn("pid", F.struct("area", "parcel_id"))
        hits = spatial.points_in_polygons(points, masks, cell).select("pid.area", "pid.parcel_id")
        out["external"] = scoring.external_stats(spatial.with_hit(scored, ["area", "parcel_id"], hits, "inside_mask"), names)
    return out


def exported(scored: DataFrame, parcels: DataFrame | None = None) -> DataFrame:
    """Predictions with ranks in their area and year and attention flags, joined to parcels, in the export's order of columns."""
    names = [c for c in ("pred_ml_final", "pred_baseline_risk") if c in scored.columns]
    out = scoring.attention(scoring.export_ranks(scored, names))
    keep = [c for c in EXPORT if c in out.columns] + [f"{n}_rank_pct" for n in names]
    return out.select(*keep) if parcels is None else parcels.join(out, ["parcel_id", "area"], "inner").select(*keep, *[c for c in parcels.columns if c not in keep])


# ---------------------------------------------------------------- audits and tools


def audited(rasters: DataFrame, manifest: DataFrame, found: DataFrame, aoi: DataFrame | None = None) -> DataFrame:
    """All issues of a result folder. rasters: relpath, name, min, max, unique_preview, grid columns, bounds."""
    spark = rasters.sparkSession
    parts = text.raster_name_parts(F.col("name"))
    named = rasters.withColumns(parts).withColumn("folder", text.top_folder(F.col("relpath")))
    family = F.when(F.col("folder") == "dynamics", F.when(F.col("year2").isNotNull(), "dynamics_pair").otherwise("dynamics_year")).otherwise(F.col("folder"))
    lacking = audit.missing_of_family(named.filter("feature is not null").withColumn("family", family), ["site", "year"])
    out = audit.value_issues(rasters, audit.rules(spark)).unionByName(audit.manifest_issues(manifest, found))
    out = out.unionByName(audit.issue(lacking, "WARNING", F.concat(F.upper("family"), F.lit("_MISSING")), F.concat_ws("_", "site", F.col("year").cast("string")), "layers of this family are missing", missing=F.array_join("missing", ",")))
    uneven = audit.alignment_variants(named.filter("site is not null"), ["folder", "site", "year"], ["width", "height", "epsg"])
    out = out.unionByName(audit.issue(uneven, "WARNING", F.lit("GRID_MISALIGNED"), F.concat_ws("/", "folder", "site"), "rasters of a group lie on several grids", variants=F.col("variants")))
    if aoi is not None:
        out = out.unionByName(audit.issue(audit.outside_aoi(rasters, aoi), "WARNING", F.lit("OUTSIDE_AOI"), F.col("relpath"), "hardly any overlap with the area of interest", fraction=F.col("fraction")))
    return out


def aoi_from_footprints(footprints: DataFrame, cell: float, gap: float = 0.0, least_km2: float = 0.0, epsg: int = geometry.GEOGRAPHIC) -> dict[str, DataFrame]:
    """Zones, their outlines and areas, and the zone that each footprint (fid, geometry) overlaps most."""
    zoned = spatial.zones_of(footprints, cell, gap).join(footprints, "fid")
    outlines = spatial.dissolved(zoned, ["zone_id"]).withColumn("area_km2", geometry.area_km2(F.col("geometry"), epsg)).filter(F.col("area_km2") >= least_km2)
    sized = zoned.withColumn("footprint_km2", geometry.area_km2(F.col("geometry"), epsg))
    summary = sized.groupBy("zone_id").agg(F.count_distinct("fid").alias("scenes"), F.sum("footprint_km2").alias("footprint_km2")).join(outlines.select("zone_id", "area_km2"), "zone_id")
    return {"zones": outlines, "scene_to_zone": zoned.select("fid", "zone_id"), "summary": summary}


def compared_with_cases(px: DataFrame, masks: DataFrame, cases: DataFrame, layers: list[str], radius: float) -> DataFrame:
    """Long table (evidence, kind, year, layer, n, mean, median, p90, max) of layers under masks (zone, geometry) and within a radius of cases (zone, x, y), in grid units."""
    area = spatial.pixels_in_polygons(px, masks).withColumn("kind", F.lit("mask"))
    near = px.withColumns({"cx": F.floor((F.col("col") + 0.5) / radius), "cy": F.floor((F.col("row") + 0.5) / radius)})
    around = cases.withColumns({"cx": F.explode(F.sequence(F.floor((F.col("x") - radius) / radius), F.floor((F.col("x") + radius) / radius)))}).withColumn("cy", F.explode(F.sequence(F.floor((F.col("y") - radius) / radius), F.floor((F.col("y") + radius) / radius))))
    hit = near.join(around, ["cx", "cy"]).filter(F.pow(F.col("col") + 0.5 - F.col("x"), 2) + F.pow(F.col("row") + 0.5 - F.col("y"), 2) <= radius**2).withColumn("kind", F.lit("case"))
    both = area.select("zone", "kind", "year", *layers).unionByName(hit.select("zone", "kind", "year", *layers))
    long = both.unpivot(["zone", "kind", "year"], layers, "layer", "value")
    keys = ["zone", "kind", "year", "layer"]
    plain = long.groupBy(*keys).agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.max("value").alias("max"))
    return plain.join(stats.quantiles(long, keys, {"median": (F.col("value"), 0.5), "p90": (F.col("value"), 0.9)}), keys, "left").select(*keys, "n", "mean", "median", "p90", "max")


def parcel_context(parcels: DataFrame, number: int, metres: float, area: str | None = None) -> DataFrame:
    """The parcel whose id holds a number, its centroid, links to maps and the box `metres` around it (parcels in degrees)."""
    hit = parcels.filter(text.leading_number(F.col("parcel_id")) == number)
    hit = hit.filter(F.col("area") == area) if area is not None else hit
    b = geometry.bounds(geometry.projected(F.col("geometry"), geometry.GEOGRAPHIC, geometry.MERCATOR))
    c = geometry.centroid(geometry.projected(F.col("geometry"), geometry.GEOGRAPHIC, geometry.MERCATOR))
    x0, y0 = geometry.from_mercator(b["xmin"] - metres, b["ymin"] - metres)
    x1, y1 = geometry.from_mercator(b["xmax"] + metres, b["ymax"] + metres)
    lon, lat = geometry.from_mercator(c["x"], c["y"])
    out = hit.withColumns({"lon": F.round(lon, 6), "lat": F.round(lat, 6), "xmin": x0, "ymin": y0, "xmax": x1, "ymax": y1})
    return out.withColumn("osm", F.format_string("https://www.openstreetmap.org/?mlat=%.6f&mlon=%.6f#map=16/%.6f/%.6f", "lat", "lon", "lat", "lon"))


def crs_report(info: DataFrame) -> DataFrame:
    """info (path, epsg, error) with web_ready."""
    return info.withColumn("web_ready", F.coalesce(F.col("epsg").isin(geometry.GEOGRAPHIC, geometry.MERCATOR), F.lit(False)))


