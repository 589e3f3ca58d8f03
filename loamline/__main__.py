"""Command line: python -m loamline STAGE --in PATH --out PATH ...

Tables are Parquet folders (CSV if the path ends so). Exit codes: 2 if an audit finds errors and --fail-on-error is given, 3 if files of a batch failed.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import text
from .operators import audit, geometry, raster, scenes
from .plans import charts, runs, stages
from .session import session
from .sources import files, geotiff, vectors


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, inferSchema=True) if path.endswith(".csv") else spark.read.parquet(path)


def write(df: DataFrame, path: str, *partitions: str) -> None:
    files.to_csv(df, path, *partitions, mark=True) if path.endswith(".csv") else files.to_parquet(df, path, *partitions)


def draw(spark: SparkSession, out: str, pictures: dict[str, str]) -> None:
    for name, svg in pictures.items():
        runs.out_files(spark, runs.small_file(spark, f"charts/{name}.svg", svg), out)


def settings(path: str | None, section: str) -> dict:
    if not path:
        return {}
    with open(path, encoding="utf-8") as f:
        return json.load(f).get(section, {})


def numeric_of(df: DataFrame) -> list[str]:
    return text.training_features(df.columns)[0]


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loamline", description=__doc__)
    sub = p.add_subparsers(dest="stage", required=True)
    add = lambda name, *wanted: [s := sub.add_parser(name), *[s.add_argument(f"--{w}", required=w in ("in", "out")) for w in wanted]][0]
    add("catalog", "in", "out")
    add("parcel-year", "in", "out", "lookup").add_argument("--lenient", action="store_true")
    add("diagnose", "in", "out")
    add("label", "in", "out", "masks", "config")
    add("cluster", "in", "out", "config")
    add("train", "in", "out", "config")
    add("score", "in", "out").add_argument("--models", required=True)
    add("validate", "in", "out", "masks")
    add("export", "in", "out", "parcels")
    add("audit", "in", "out", "manifest").add_argument("--fail-on-error", action="store_true")
    add("crs", "in", "out")
    add("context", "in", "out", "number", "area").add_argument("--metres", type=float, default=1000.0)
    add("cadastre", "in", "out")
    r = add("run", "in", "out", "parcels", "dem", "inventory", "band-map")
    r.add_argument("--soil-index", choices=sorted(raster.SOIL), default="osavi")
    r.add_argument("--water-threshold", type=float)
    r.add_argument("--no-textures", action="store_true")
    for name, default in (("levels", 16), ("downsample", 2), ("stride", 2)):
        r.add_argument(f"--texture-{name}", type=int, default=default)
    z = add("aoi", "in", "out")
    z.add_argument("--merge-gap", type=float, default=0.0)
    z.add_argument("--min-zone-area-km2", type=float, default=0.0)
    add("clip", "in", "out").add_argument("--scenes", required=True)
    c = add("cases", "in", "out", "area", "points")
    c.add_argument("--masks", required=True)
    c.add_argument("--radius", type=float, default=250.0)
    for name in ("colour", "heat-map"):
        k = add(name, "in", "out", "parcels", "template", "column")
        k.add_argument("--palette", required=True)
        k.add_argument("--min", type=float, default=0.0)
        k.add_argument("--max", type=float, default=1.0)
        k.add_argument("--pattern", default="*risk_score*.tif")
    add("self-test")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = vars(parser().parse_args(argv))
    spark = spark or session()
    stage, source, out = a["stage"], a.get("in"), a.get("out")
    if stage == "self-test":
        px, table = stages.raster_run(*stages.test_scenes(spark))
        got = table.agg(F.count("*").alias("n"), F.min("risk_score_min").alias("low"), F.max("risk_score_max").alias("high")).first()
        ok = got.n == 4 and 0 <= got.low <= got.high <= 1
        print(files.report({"parcel_years": got.n, "risk": [got.low, got.high], "ok": ok}))
        return 0 if ok else 3
    if stage == "catalog":
        catalog = scenes.catalog_from_listing(files.table(spark, source))
        write(catalog, f"{out}/catalog")
        write(scenes.best_scenes(catalog), f"{out}/best")
        write(scenes.inventory(catalog, ["area", "product", "level", "year"]), f"{out}/inventory")
    elif stage == "parcel-year":
        lookup = read(spark, a["lookup"]) if a["lookup"] else None
        table, report = stages.parcel_year_table(files.parcel_stats(spark, source), lookup, not a["lenient"])
        write(table, out, "area", "year")
        print(files.report(report))
    elif stage == "diagnose":
        df = read(spark, source)
        df = df.withColumn("_row", F.xxhash64(*df.columns))
        made = stages.diagnostics(df, numeric_of(df), "_row")
        for name, t in made.items():
            write(t, f"{out}/{name}")
        draw(spark, out, {"spearman": charts.correlations(made["spearman"]), "missing": charts.bars(made["missing"], "column", "missing_share", "Missing shares")})
    elif stage == "label":
        masks = vectors.read_geojson(spark, a["masks"]).select(F.md5(F.to_json("geometry")).alias("gid"), "geometry") if a["masks"] else None
        table, pivot = stages.labelled(read(spark, source), masks, settings(a["config"], "labels"))
        write(table, f"{out}/table")
        write(pivot, f"{out}/pivot")
    elif stage == "cluster":
        s = {"min_cluster_size": 40, "min_samples": 10, "pca_components": 10} | settings(a["config"], "hdbscan")
        df = read(spark, source)
        table, summary = stages.clusters(df, numeric_of(df), s["min_cluster_size"], s["min_samples"], s["pca_components"], f"{out}/model")
        write(table, f"{out}/table")
        write(summary, f"{out}/summary")
    elif stage == "train":
        folds = settings(a["config"], "validation").get("n_splits", 5)
        boost = {k: v for k, v in settings(a["config"], "boost").items() if k in ("iterations", "learning_rate", "depth", "seed")}
        for name, t in stages.trained(read(spark, source), folds, boost or None, f"{out}/models").items():
            write(t, f"{out}/{name}")
    elif stage == "score":
        write(stages.scored_by(a["models"], read(spark, source)), out)
    elif stage == "validate":
        masks = vectors.read_geojson(spark, a["masks"]).select(F.md5(F.to_json("geometry")).alias("gid"), "geometry") if a["masks"] else None
        made = stages.validated(read(spark, source), masks)
        for name, t in made.items():
            write(t, f"{out}/{name}")
        pictures = {"roc_auc": charts.bars(made["internal"], "model", "roc_auc", "ROC-AUC by model")}
        if "external" in made:
            lifts = [c for c in made["external"].columns if c.endswith("_lift")]
            pictures |= {c: charts.series(made["external"], "year", c, "area", c) for c in lifts}
        draw(spark, out, pictures)
    elif stage == "export":
        if a["parcels"]:  # files for each area and year
            rows = vectors.read_geojson(spark, a["parcels"], "*")
            shapes = rows.select(F.element_at("properties", "parcel_id").alias("parcel_id"), F.element_at("properties", "area").alias("area"), "geometry")
            print(files.report(runs.export(spark, stages.exported(read(spark, source)).join(shapes.select("parcel_id", "area"), ["parcel_id", "area"]), shapes, out)))
        else:
            write(stages.exported(read(spark, source)), out, "area", "year")
    elif stage == "audit":
        info = geotiff.read_info(files.contents(spark, source, "*.tif"))
        listed = files.classified(files.listing(spark, source), source)
        px = geotiff.read_pixels(files.contents(spark, source, "*.tif").join(info.filter("error is null").select("path"), "path", "left_semi"), 1, ["v"])
        rasters = files.classified(info, source).join(audit.layer_inventory(px, ["path"], "v"), "path").withColumn("name", F.element_at(F.split("relpath", "/"), -1))
        manifest = files.manifest(spark, a["manifest"]) if a["manifest"] else listed.select(F.col("relpath").alias("path"))
        issues = stages.audited(rasters, manifest, listed.select(F.col("relpath").alias("path"))).unionByName(audit.issue(info.filter("error is not null"), "ERROR", F.lit("RASTER_OPEN"), F.col("path"), "the raster can't be read", error=F.col("error")))
        issues = issues.cache()
        write(issues.withColumn("details", F.to_json("details")), f"{out}/issues")
        files.to_text(spark, audit.markdown(issues).splitlines(), f"{out}/report")
        counts = {r.severity: r.n for r in audit.severity_counts(issues).collect()}
        write(files.plain(rasters), f"{out}/inventory.csv")
        write(files.plain(issues), f"{out}/issues.csv")
        summary = {"severities": counts, "files": {r.kind: r["count"] for r in listed.groupBy("kind").count().collect()}, "codes": {r.code: r["count"] for r in issues.groupBy("code").count().collect()}}
        files.to_text(spark, files.report(summary).splitlines(), f"{out}/summary.json")
        errors = counts.get("ERROR", 0)
        print(files.report({"errors": errors, "issues": sum(counts.values())}))
        return 2 if errors and a["fail_on_error"] else 0
    elif stage == "crs":
        report = stages.crs_report(geotiff.read_info(files.contents(spark, source, "*.tif"))).cache()
        write(report.withColumn("transform", F.to_json("transform")), out)
        by = lambda c: {str(r[0]): r[1] for r in report.groupBy(c).count().collect()}
        said = {"rows": report.count(), "errors": report.filter("error is not null").count(), "by_epsg": by("epsg"), "not_web_ready": report.filter("not web_ready").count()}
        files.to_text(spark, [f"{k}: {v}" for k, v in said.items()], f"{out}_summary")
        return 3 if report.filter("error is not null").count() else 0
    elif stage == "context":
        parcels = vectors.read_geojson(spark, source).select(F.element_at("properties", "parcel_id").alias("parcel_id"), F.element_at("properties", "area").alias("area"), "geometry")
        hit = stages.parcel_context(parcels, int(a["number"]), a["metres"], a["area"])
        write(hit.withColumn("geometry", geometry.to_geojson(F.col("geometry"))), out)
        if not hit.limit(1).count():
            return 3
        draw(spark, f"{out}_map", {"context": charts.context(parcels, hit, f"Parcel {a['number']}")})
        return 0
    elif stage == "cadastre":
        print(files.report(runs.cadastre(spark, source, out)))
    elif stage == "run":
        bands = json.loads(a["band_map"]) if a["band_map"] else None
        print(files.report(runs.run(spark, source, out, a["parcels"], a["dem"], a["inventory"], bands, a["soil_index"], a["water_threshold"], a["texture_levels"], a["texture_downsample"], a["texture_stride"], not a["no_textures"])))
    elif stage == "aoi":
        print(files.report(runs.aoi(spark, source, out, a["merge_gap"], a["min_zone_area_km2"])))
    elif stage == "clip":
        print(files.report(runs.clip(spark, source, a["scenes"], out)))
    elif stage == "cases":
        print(files.report(runs.cases(spark, source, a["area"], out, a["masks"], a["points"], a["radius"])))
    elif stage == "colour":
        report = runs.coloured(spark, source, a["palette"], out, a["pattern"], low=a["min"], high=a["max"])
        print(files.report(report))
        return 3 if report["failed"] else 2 if not report["ok"] else 0
    elif stage == "heat-map":
        shapes = vectors.read_geojson(spark, a["parcels"], "*").select(F.element_at("properties", "parcel_id").alias("parcel_id"), "geometry")
        print(files.report(runs.heat_map(spark, read(spark, source), shapes, a["column"], a["template"], a["palette"], out, a["min"], a["max"])))
    return 0


if __name__ == "__main__":
    sys.exit(main())
