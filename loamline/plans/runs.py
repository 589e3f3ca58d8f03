"""Whole runs, from files to files: the raster run over scene folders, areas of interest, clipped fields, comparison with known cases, colour and heat maps, exports, model folders.

Rasters are read and written by tasks, a tile or a file in each. Every run returns the report that it writes, with the paths of its outputs relative to its folder.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import features, geometry, raster, scenes, spatial
from ..session import written
from ..sources import files, geotiff, vectors
from . import stages

BANDS = {"blue": 1, "green": 2, "red": 3, "nir": 4}
# Textures that the run makes, its masks by name of their layer, and the front export's columns.
SOURCES, WINDOWS = ("nir", "red", "pc1"), (5, 7)
MASKS = {"water": "water_mask", "texture_anomaly": "texture_anomaly_mask", "persistence_water": "persistence_water_mask", "change": "change_mask", "hotspot": "hotspot_mask"}


def out_files(spark: SparkSession, made: DataFrame, out: str) -> list[str]:
    return sorted(r.path for r in files.to_files(made, out).select("path").collect())  # names of outputs, not their content


def small_file(spark: SparkSession, path: str, content: str | bytes) -> DataFrame:
    return spark.createDataFrame([(path, content.encode() if isinstance(content, str) else content)], "path string, content binary")


def one_csv(df: DataFrame, path: str, order: list[str]) -> DataFrame:
    """A table of catalogue size as one CSV with the byte-order mark."""
    flat = files.plain(df)
    return files.text_files(flat, F.lit(path), files.MARK + ",".join(flat.columns) + "\n", files.csv_line(flat.columns), order, "\n")


def csv_by(df: DataFrame, path: Column, names: list[str], order: list[str]) -> DataFrame:
    """CSV files with the byte-order mark, one for each path."""
    flat = files.plain(df.select(path.alias("_file"), *names))
    return files.text_files(flat, F.col("_file"), files.MARK + ",".join(names) + "\n", files.csv_line(names), order, "\n")


def geojson_by(df: DataFrame, path: Column, properties: list[str], order: list[str], epsg: int = 4326, shape: str = "geometry") -> DataFrame:
    """GeoJSON documents, one for each path."""
    head, tail = vectors.feature_collection(["\0"], epsg).split("\0")
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(*properties).alias("properties"), F.from_json(geometry.to_geojson(F.col(shape)), "type string, coordinates array<array<array<array<double>>>>").alias("geometry"))
    return files.text_files(df.withColumn("_line", F.to_json(feature, {"ignoreNullFields": "false"})), path, head, F.col("_line"), order, tail, ",\n")


def unwritable(name: Column) -> Column:
    """A text as part of a file's name."""
    return F.regexp_replace(name, r"(?U)[^\w.-]+", "_")


# ---------------------------------------------------------------- the raster run


def read_vector(spark: SparkSession, path: str) -> DataFrame:
    """Features of one file or folder by its ending: .geojson, .gpkg, .zip (shapefiles in it), else shapefiles; geometries in EPSG:4326."""
    low = path.lower()
    if low.endswith((".geojson", ".json")):
        rows = vectors.read_geojson(spark, path, "*")
    elif low.endswith(".gpkg"):
        rows = vectors.read_geopackages(files.contents(spark, path))
    elif low.endswith(".zip"):
        rows = vectors.read_zipped_shapefiles(files.contents(spark, path))
    else:
        rows = vectors.read_shapefiles(files.contents(spark, path, "*.{shp,dbf,prj}"))
    return in_degrees(rows)


def in_degrees(rows: DataFrame) -> DataFrame:
    """rows with geometries in EPSG:4326: those of EPSG:3857 are projected, others stay; rows without geometry or with an error are left out."""
    known = rows.filter("error is null and geometry is not null")
    return known.withColumn("geometry", F.when(F.col("epsg") == geometry.MERCATOR, geometry.projected(F.col("geometry"), geometry.MERCATOR, geometry.GEOGRAPHIC)).otherwise(F.col("geometry")))


def footprints_of(spark: SparkSession, root: str) -> DataFrame:
    """(dir, path, geometry) of the outlines of scenes below a folder: .GBD shapefiles, GeoJSON and GeoPackages; one folder may have several."""
    shp = vectors.read_shapefiles(files.contents(spark, root, "*.{shp,dbf,prj}"))
    rest = [vectors.read_geojson(spark, root, "*.geojson"), vectors.read_geopackages(files.contents(spark, root, "*.gpkg"))]
    rows = features.union_all([in_degrees(d).select("path", "geometry") for d in (shp, *rest)])
    return files.footprint_rows(rows).select(F.regexp_replace("path", r"/[^/]*$", "").alias("dir"), "path", "geometry")


def scene_catalog(spark: SparkSession, root: str) -> DataFrame:
    """Scenes below a folder that lie beside an outline, by the names of their folders."""
    listed = scenes.catalog_from_listing(files.listing(spark, root, "*.tif"), "path")
    dirs = files.footprint_rows(files.listing(spark, root, "*")).select(F.regexp_replace("path", r"/[^/]*$", "").alias("dir")).distinct()
    return listed.withColumn("dir", F.regexp_replace("tif_path", r"/[^/]*$", "")).join(dirs, "dir", "left_semi")


def grid_cells(grids: DataFrame) -> DataFrame:
    """grids (height, width) with a row for each cell (row, col): rows are dealt out before they are spread over columns, so a large grid is made by many tasks."""
    rows = grids.withColumn("row", F.explode(F.sequence(F.lit(0), F.col("height") - 1)))
    return rows.repartition("row").withColumn("col", F.explode(F.sequence(F.lit(0), F.col("width") - 1)))


def area_grids(info: DataFrame, outlines: DataFrame) -> DataFrame:
    """(area and the GRID columns): the finest scene's cells over the bounds of the area's outline. info: area, path, transform, epsg; outlines: area, geometry in degrees."""
    best = scenes.reference_scene(info.withColumns({"a": F.get("transform", F.lit(0)), "e": F.get("transform", F.lit(4))}), ["area"]).join(info.select("path", "epsg"), "path")
    of_code = lambda shape, code: geometry.projected(shape, geometry.GEOGRAPHIC, code)
    shape = F.col("geometry")
    for code in [r.epsg for r in best.select("epsg").distinct().collect() if r.epsg not in (None, geometry.GEOGRAPHIC)]:
        shape = F.when(F.col("epsg") == code, of_code(F.col("geometry"), code)).otherwise(shape)
    b = spatial.with_bounds(best.join(outlines, "area").withColumn("geometry", shape)).withColumn("cell", F.least(F.abs("a"), F.abs("e")))
    return scenes.reference_grid(b).select("area", F.col("xmin").alias("x0"), F.col("ymax").alias("y0"), F.col("cell").alias("dx"), F.col("cell").alias("dy"), F.coalesce("epsg", F.lit(geometry.GEOGRAPHIC)).alias("epsg"), "height", "width")


def on_grids(px: DataFrame, info: DataFrame, grids: DataFrame, layers: list[str]) -> DataFrame:
    """(path, area, row, col and layers) of scenes brought to their areas' grids by bilinear weights, nodata cells left out.

    px: path, row, col and layers; info: path, area, transform, epsg, width, height. A scene's cells and the grid's meet by an equi-join on cells; a grid cell
    is only asked of scenes whose box holds it. Scenes in another projection than the grid's must lie in EPSG:4326 or EPSG:3857, or share it.
    """
    t = lambda i: F.get("transform", F.lit(i))
    scene = info.select("path", "area", t(0).alias("a"), t(2).alias("c"), t(4).alias("e"), t(5).alias("f"), F.col("epsg").alias("own"), F.col("width").alias("w"), F.col("height").alias("h"))
    pairs = scene.join(grids, "area")
    codes = [(r.epsg, r.own) for r in pairs.select("epsg", "own").distinct().collect()]
    cells = grid_cells(pairs)
    gx, gy = F.col("x0") + (F.col("col") + 0.5) * F.col("dx"), F.col("y0") - (F.col("row") + 0.5) * F.col("dy")
    x, y = gx, gy
    for grid_code, own in codes:
        if own is not None and grid_code != own:
            px_, py_ = geometry.projector(grid_code, own)(gx, gy)
            x, y = F.when((F.col("epsg") == grid_code) & (F.col("own") == own), px_).otherwise(x), F.when((F.col("epsg") == grid_code) & (F.col("own") == own), py_).otherwise(y)
    # Rounded, so that grids which coincide take one cell each, whatever the last bits say.
    at = cells.select("path", "area", "row", "col", "w", "h", F.round((x - F.col("c")) / F.col("a") - 0.5, 6).alias("x"), F.round((y - F.col("f")) / F.col("e") - 0.5, 6).alias("y"))
    at = at.filter((F.col("x") > -0.5) & (F.col("y") > -0.5) & (F.col("x") < F.col("w") - 0.5) & (F.col("y") < F.col("h") - 0.5))
    x0, y0 = F.floor("x"), F.floor("y")
    fx, fy = F.col("x") - x0, F.col("y") - y0
    corner = lambda i, j: F.struct(F.least(F.greatest(y0 + i, F.lit(0)), F.col("h") - 1).cast("int").alias("sr"), F.least(F.greatest(x0 + j, F.lit(0)), F.col("w") - 1).cast("int").alias("sc"), ((fy if i else 1 - fy) * (fx if j else 1 - fx)).alias("weight"))
    near = at.withColumn("k", F.explode(F.array(*[corner(i, j) for i in (0, 1) for j in (0, 1)]))).select("path", "area", "row", "col", "k.*").filter("weight > 0")
    got = near.join(px.withColumnsRenamed({"row": "sr", "col": "sc"}), ["path", "sr", "sc"])
    known = lambda c: F.when(F.col(c).isNotNull(), F.col("weight"))
    return got.groupBy("path", "area", "row", "col").agg(*[F.try_divide(F.sum(F.col("weight") * F.col(c)), F.sum(known(c))).alias(c) for c in layers])


def in_cells_of(shapes: DataFrame, grids: DataFrame) -> DataFrame:
    """shapes (area, geometry in degrees) with the geometry in cells of their areas' grids."""
    held = shapes.join(grids, "area")
    shape = F.col("geometry")
    for code in [r.epsg for r in grids.select("epsg").distinct().collect() if r.epsg != geometry.GEOGRAPHIC]:
        shape = F.when(F.col("epsg") == code, geometry.projected(F.col("geometry"), geometry.GEOGRAPHIC, code)).otherwise(shape)
    held = held.withColumn("geometry", shape)
    cells = geometry.mapped(F.col("geometry"), lambda p: F.struct(((p["x"] - F.col("x0")) / F.col("dx")).alias("x"), ((F.col("y0") - p["y"]) / F.col("dy")).alias("y")))
    return held.withColumn("geometry", cells).drop(*geotiff.GRID)


def with_textures(px: DataFrame, keys: list[str], levels: int, sample: int, stride: int) -> tuple[DataFrame, list[str]]:
    """px with the local and co-occurrence layers of all sources and windows."""
    names = []
    held = written(raster.first_component(px, keys=keys) if "pc1" not in px.columns else px, "composites")
    out = held
    for source in SOURCES:
        for w in WINDOWS:
            halo, made, of = raster.local_statistics(w)
            local = raster.focal(held, keys, source, halo, made, of).select(*keys, "row", "col", F.col("std").alias(f"{source}_local_std_w{w}"), F.col("var").alias(f"{source}_local_var_w{w}"))
            lattice = raster.glcm(held, keys, source, w, levels, sample, stride)
            texture = raster.spread(held, lattice, keys, raster.GLCM).withColumnsRenamed({n: f"{source}_glcm_{n}_w{w}" for n in raster.GLCM})
            out = out.join(local, [*keys, "row", "col"], "left").join(texture, [*keys, "row", "col"], "left")
            names += [f"{source}_local_std_w{w}", f"{source}_local_var_w{w}", *[f"{source}_glcm_{n}_w{w}" for n in raster.GLCM]]
    return out, names


def run(spark: SparkSession, root: str, out: str, parcels: str | None = None, dem: str | None = None, inventory: str | None = None, bands: dict[str, int] | None = None, soil: str = "osavi", water_threshold: float | None = None, levels: int = 16, sample: int = 2, stride: int = 2, textures: bool = True) -> dict:
    """From scene folders to catalogues, areas of interest, composites, indices, textures, terrain, masks, dynamics, risk, parcel statistics, a report and a manifest."""
    bands = bands or BANDS
    outputs: list[str] = []
    catalog = scene_catalog(spark, root)
    if not catalog.limit(1).count():
        raise ValueError(f"no scene below {root}")
    best = scenes.best_scenes(catalog).withColumn("season", text.season_of(F.col("date")))
    made = [one_csv(catalog, "catalog/scene_catalog_scan.csv", ["tif_path"]), one_csv(best, "catalog/scene_catalog_selected_ms.csv", ["tif_path"])]
    if inventory:
        made.append(one_csv(scenes.catalog_from_listing(files.table(spark, inventory)), "catalog/scene_catalog_inventory.csv", ["tif_path"]))
    outlines = best.select("area", F.col("scene_folder"), "dir").join(footprints_of(spark, root).select("dir", "geometry"), "dir")
    prints = written(outlines.withColumn("geometry", geometry.made_valid("geometry")).filter("geometry is not null"), "outlines", "zstd")
    areas = written(spatial.dissolved(prints, ["area"]), "areas", "zstd")
    union = spatial.dissolved(areas.withColumn("all", F.lit("all")), ["all"])
    made += [geojson_by(prints, F.lit("aoi/scene_footprints.geojson"), ["area", "scene_folder"], ["scene_folder"]), geojson_by(areas, F.lit("aoi/area_aoi.geojson"), ["area"], ["area"]), geojson_by(union, F.lit("aoi/aoi_union.geojson"), ["all"], ["all"])]
    chosen = best.select(F.col("tif_path").alias("path"), "area", F.col("year").cast("int").alias("year"), "season")
    held = files.contents(spark, root, "*.tif").join(chosen.select("path"), "path", "left_semi")
    info = written(geotiff.read_info(held).filter("error is null").join(chosen, "path"), "info")
    grids = written(area_grids(info, areas), "grids")
    order = sorted(bands, key=bands.get)
    stack = on_grids(geotiff.read_pixels(held, max(bands.values()), [next((b for b in order if bands[b] == i), f"_{i}") for i in range(1, max(bands.values()) + 1)]).select("path", "row", "col", *raster.BANDS), info, grids, raster.BANDS)
    inside = spatial.pixels_in_polygons(grid_cells(grids).select("area", "row", "col"), in_cells_of(areas.withColumn("zone", F.lit(1)), grids), own=["area"])
    pixels = written(stack.join(inside.select("area", "row", "col").distinct(), ["area", "row", "col"], "left_semi").join(chosen.select("path", "year", "season"), "path").withColumnRenamed("path", "scene_id"), "pixels")
    zones = clipped = None
    if parcels:
        own = read_vector(spark, parcels)
        named = own.withColumn("parcel_id", F.element_at("properties", "parcel_id").cast("string")).withColumn("geometry", geometry.made_valid("geometry")).filter("geometry is not null")
        if not named.filter("parcel_id is not null").limit(1).count():
            named = spatial.numbered(named.withColumn("_g", F.md5(geometry.to_geojson(F.col("geometry")))), ["_g"]).withColumn("parcel_id", F.col("parcel_id").cast("string"))
        clipped = written(spatial.clipped_to(named.select("parcel_id", "geometry"), areas.select(F.col("area").alias("gid"), "geometry"), 0.05).withColumnRenamed("gid", "area"), "parcels", "zstd")
        made.append(geojson_by(clipped, F.lit("parcels/parcels_clipped.geojson"), ["parcel_id", "area"], ["parcel_id", "area"]))
        zones = in_cells_of(clipped.select("area", F.col("parcel_id").alias("zone"), "geometry"), grids)
    heights = None
    if dem:
        content = files.contents(spark, dem)
        about = geotiff.read_info(content).filter("error is null").crossJoin(F.broadcast(grids.select("area")))  # one height model, a row for each area
        heights = on_grids(geotiff.read_pixels(content, 1, ["dem"]), about, grids, ["dem"]).drop("path")
    settings = stages.RasterSettings(soil=soil, water_threshold=water_threshold, layers=["ndvi", "ndwi", soil, "brightness", "delta_ndvi", "delta_ndwi", "risk_score"], texture="nir_local_std_w7" if textures else "nir_local_std")
    prepare = (lambda px: with_textures(px, ["area", "year"], levels, sample, stride)[0]) if textures else None
    first = grids.select("dx", "dy").first()
    settings.dx, settings.dy, settings.cell_area = first.dx, first.dy, first.dx * first.dy
    layers, table = stages.raster_run(pixels, zones, heights, settings, prepare)
    layers = written(layers, "layers")
    keys = ["area", "year"]
    gridded = layers.join(grids, "area").withColumn("area", unwritable(F.col("area")))
    index = ["ndvi", "ndwi", soil, "nir_red_ratio", "red_green_ratio", "brightness"]
    named = {"composites/{area}_{year}_annual_ms_composite.tif": raster.BANDS} | {f"indices/{{area}}_{{year}}_annual_{n}.tif": [n] for n in index}
    named |= {f"masks/{{area}}_{{year}}_{name}.tif": [c] for c, name in MASKS.items()} | {f"dynamics/{{area}}_{{year}}_{n}.tif": [n] for n in ("water_occurrence", "risk_score")}
    named |= {f"textures/{{area}}_{{year}}_{n}.tif": [n] for n in layers.columns if "_local_" in n or "_glcm_" in n}
    named |= {f"terrain/{{area}}_{{year}}_{n}.tif": [n] for n in raster.TERRAIN if n in layers.columns}
    made.append(geotiff.raster_files(gridded, keys, named))
    years = layers.select(*keys).distinct()
    pairs = years.join(years.select("area", F.col("year").alias("before")), "area").filter("before < year").groupBy(*keys).agg(F.max("before").alias("before"))
    changed = gridded.join(pairs.withColumn("area", unwritable(F.col("area"))), keys)
    made.append(geotiff.raster_files(changed, [*keys, "before"], {f"dynamics/{{area}}_{{before}}_{{year}}_{n}.tif": [n] for n in ("delta_ndvi", "delta_ndwi", "water_growth")}))
    seasonal = raster.indices(raster.composite(pixels.filter("season is not null"), [*keys, "season"]), soil).join(grids, "area").withColumn("area", unwritable(F.col("area")))
    made.append(geotiff.raster_files(seasonal, [*keys, "season"], {"composites/{area}_{year}_{season}_ms_composite.tif": raster.BANDS} | {f"indices/{{area}}_{{year}}_{{season}}_{n}.tif": [n] for n in index}))
    if table is not None:
        stem = F.concat(F.lit("analytics/"), unwritable(F.col("area")), F.lit("_"), F.col("year").cast("string"), F.lit("_parcel_stats"))
        names = [c for c in table.columns if c not in keys]
        made.append(csv_by(table, F.concat(stem, F.lit(".csv")), names, ["parcel_id"]))
        made.append(geojson_by(clipped.join(table, ["area", "parcel_id"]), F.concat(stem, F.lit(".geojson")), [c for c in table.columns], ["parcel_id"]))
    for part in made:
        outputs += out_files(spark, part, out)
    report = {"areas": sorted(r.area for r in areas.select("area").collect()), "scanned_scene_rows": catalog.count(), "selected_ms_rows": best.count(), "outputs": sorted(outputs)}
    out_files(spark, small_file(spark, "run_report.json", files.report(report)).unionByName(small_file(spark, "manifest.txt", "\n".join(report["outputs"]) + "\n")), out)
    return report


# ---------------------------------------------------------------- areas of interest, clipped fields, known cases


def aoi(spark: SparkSession, root: str, out: str, gap: float = 0.0, least_km2: float = 0.0, cell: float = 0.1) -> dict:
    """Outlines of scenes below a folder, zones of those that overlap (or lie within a gap), which scene is in which, a summary of zones, and a report."""
    scene = F.regexp_extract("dir", r"([^/]*)$", 1)
    shapes = footprints_of(spark, root).withColumns({"geometry": geometry.made_valid("geometry"), "scene_id": scene}).filter("geometry is not null")
    one = written(spatial.dissolved(shapes, ["scene_id"]), "outlines", "zstd")
    numbered = written(spatial.numbered(one, ["scene_id"], "fid"), "outlines", "zstd")
    got = stages.aoi_from_footprints(numbered.select("fid", "geometry"), cell, gap, least_km2)
    zones = written(got["zones"], "zones", "zstd")
    union = spatial.dissolved(zones.withColumn("all", F.lit("all")), ["all"])
    held = got["scene_to_zone"].join(numbered.select("fid", "scene_id"), "fid").join(zones.select("zone_id"), "zone_id", "left_semi").select("scene_id", "zone_id")
    made = [
        geojson_by(numbered, F.lit("scene_footprints.geojson"), ["scene_id"], ["scene_id"]), geojson_by(zones, F.lit("aoi_zones.geojson"), ["zone_id", "area_km2"], ["zone_id"]), geojson_by(union, F.lit("aoi_union.geojson"), ["all"], ["all"]),
        one_csv(held, "scene_to_zone.csv", ["scene_id"]), one_csv(got["summary"].select("zone_id", "scenes", "footprint_km2", "area_km2"), "zone_summary.csv", ["zone_id"]),
    ]
    outputs = [p for part in made for p in out_files(spark, part, out)]
    report = {"scenes": numbered.count(), "zones": zones.count(), "area_km2": zones.agg(F.sum("area_km2")).first()[0], "outputs": sorted(outputs)}
    out_files(spark, small_file(spark, "aoi_report.json", files.report(report)), out)
    return report


def clip(spark: SparkSession, fields: str, scene_archives: str, out: str, cell: float = 0.1) -> dict:
    """Fields whose usage text is strictly agricultural, cut to the outline of each scene archive, as bundles of vector files; and counts of the layers."""
    base = read_vector(spark, fields)
    usage = F.coalesce(F.element_at("properties", "utl_doc"), F.lit(""))
    strict = base.filter(text.usage_strict(usage)).withColumn("parcel_id", F.coalesce(F.element_at("properties", "cad_num"), F.md5(geometry.to_geojson(F.col("geometry")))))
    archives = files.contents(spark, scene_archives, "*.zip")
    scenes_ = in_degrees(vectors.read_zipped_shapefiles(archives, ".gbd.shp"))
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    outlines = written(scenes_.select(text.archive_area(name).alias("gid"), name.alias("scene_zip"), "geometry"), "outlines", "zstd")
    cut = spatial.clipped_to(strict.select("parcel_id", "geometry"), outlines.select("gid", "geometry"), cell)
    layers = cut.join(strict.select("parcel_id", usage.alias("utl_doc")).dropDuplicates(["parcel_id"]), "parcel_id").select(F.concat("gid", F.lit("_strict_fields_by_scene_aoi")).alias("layer"), "parcel_id", "utl_doc", F.col("gid").alias("aoi_name"), "geometry")
    layers = written(layers, "layers", "zstd")
    made = [vectors.bundle(layers, ["layer"], ["parcel_id", "utl_doc", "aoi_name"]), vectors.bundle(outlines.withColumn("layer", F.lit("scene_aoi_footprints")), ["layer"], ["scene_zip", "gid"])]
    counts = layers.groupBy("layer").agg(F.count("*").alias("count")).unionByName(outlines.agg(F.count("*").alias("count")).withColumn("layer", F.lit("scene_aoi_footprints")))
    outputs = [p for part in (*made, one_csv(counts, "clip_summary.csv", ["layer"])) for p in out_files(spark, part.select("path", "content"), out)]
    report = {"layers": {r.layer: r["count"] for r in counts.collect()}, "outputs": sorted(outputs)}
    out_files(spark, small_file(spark, "clip_report.json", files.report(report)), out)
    return report


def cases(spark: SparkSession, results: str, area: str, out: str, masks: str, points: str | None = None, radius: float = 250.0, layers: tuple[str, ...] = ("risk_score", "delta_ndvi", "delta_ndwi")) -> dict:
    """Statistics of an area's dynamics layers by year under mask polygons and within a radius (in the rasters' units) of known points, as one long table."""
    listed = files.listing(spark, results, f"{area}_*.tif")
    parts = text.raster_name_parts(F.regexp_extract("path", r"([^/]*)$", 1))
    wanted = listed.withColumns(parts).filter(F.col("feature").isin(*layers)).withColumn("y", F.coalesce("year2", "year").cast("int"))
    content = files.contents(spark, results, f"{area}_*.tif").join(wanted.select("path"), "path", "left_semi")
    info = geotiff.read_info(content).filter("error is null")
    about = info.select("transform", "epsg").first()  # layers of an area lie on one grid
    px = geotiff.read_pixels(content, 1, ["value"]).join(wanted.select("path", F.col("y").alias("year"), "feature"), "path")
    grid = px.groupBy("year", "row", "col").pivot("feature", list(layers)).agg(F.first("value"))
    a, _, c, _, e, f = about.transform
    to_cells = lambda p: F.struct(((p["x"] - c) / a).alias("x"), ((p["y"] - f) / e).alias("y"))
    own = lambda df: df.withColumn("geometry", geometry.projected(F.col("geometry"), geometry.GEOGRAPHIC, about.epsg or geometry.GEOGRAPHIC))
    zone = F.coalesce(F.element_at("properties", "name"), F.md5(geometry.to_geojson(F.col("geometry"))))
    polygons = own(read_vector(spark, masks)).select(zone.alias("zone"), geometry.mapped(F.col("geometry"), to_cells).alias("geometry"))
    known = spark.createDataFrame([], "zone string, x double, y double")
    if points:
        rows = spark.read.option("wholetext", True).text(points).select(F.explode(F.from_json(F.get_json_object("value", "$.features"), "array<string>")).alias("v"))
        at = F.from_json(F.get_json_object("v", "$.geometry.coordinates"), "array<double>")
        x, y = geometry.projector(geometry.GEOGRAPHIC, about.epsg or geometry.GEOGRAPHIC)(at[0], at[1])
        known = rows.filter(F.get_json_object("v", "$.geometry.type") == "Point").select(F.coalesce(F.get_json_object("v", "$.properties.name"), F.md5("v")).alias("zone"), ((x - c) / a).alias("x"), ((y - f) / e).alias("y"))
    table = written(stages.compared_with_cases(grid, polygons, known, list(layers), radius / abs(a)), "cases")
    outputs = out_files(spark, one_csv(table, f"{area}_case_comparison.csv", ["zone", "kind", "year", "layer"]), out)
    return {"rows": table.count(), "outputs": outputs}


# ---------------------------------------------------------------- colours


def palette_of(png: bytes) -> np.ndarray:
    """Colours (n, 3) of a palette image, top to bottom: columns whose colour changes downwards, averaged. Eight-bit PNG, not interlaced."""
    if png[:8] != b"\x89PNG\r\n\x1a\n":
        raise ValueError("not a PNG")
    at, data, table = 8, b"", None
    while at < len(png):
        size, kind = struct.unpack_from(">I4s", png, at)
        body = png[at + 8 : at + 8 + size]
        if kind == b"IHDR":
            w, h, depth, colour, _, _, interlace = struct.unpack(">IIBBBBB", body)
        elif kind == b"PLTE":
            table = np.frombuffer(body, np.uint8).reshape(-1, 3)
        elif kind == b"IDAT":
            data += body
        at += 12 + size
    if depth != 8 or interlace or colour not in (0, 2, 3, 4, 6):
        raise ValueError("only eight-bit PNGs without interlacing are read")
    n = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[colour]
    raw = np.frombuffer(zlib.decompress(data), np.uint8).reshape(h, 1 + w * n)
    rows = np.zeros((h, w * n), np.uint8)
    above = np.zeros(w * n, np.int64)
    for i in range(h):
        kind, line = int(raw[i, 0]), raw[i, 1:].astype(np.int64)
        if kind == 2:
            line = line + above
        elif kind:
            for x in range(w * n):
                left, up, corner = (line[x - n] if x >= n else 0), above[x], (above[x - n] if x >= n else 0)
                if kind == 1:
                    add = left
                elif kind == 3:
                    add = (left + up) // 2
                else:
                    p = left + up - corner
                    add = min((left, up, corner), key=lambda v: (abs(p - v), (left, up, corner).index(v)))
                line[x] = (line[x] + add) & 255
        above = line & 255
        rows[i] = above
    pixels = rows.reshape(h, w, n)
    rgb = table[pixels[:, :, 0]] if colour == 3 else pixels[:, :, [0, 0, 0]] if n < 3 else pixels[:, :, :3]
    rgb = rgb.astype(np.float32)
    moving = np.flatnonzero(rgb.std(axis=0).mean(axis=1) > 5)
    first, last = (int(moving.min()), int(moving.max()) + 1) if len(moving) else (0, w)
    return np.round(rgb[:, first:last].mean(axis=1)).astype(np.uint8)


def png_of(colours: list, margin: int = 0, width: int = 4) -> bytes:
    """A palette image of these colours, top to bottom, between white margins."""
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    lines = b"".join(b"\0" + b"\xff" * (3 * margin) + bytes(c) * width + b"\xff" * (3 * margin) for c in colours)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width + 2 * margin, len(colours), 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(lines)) + chunk(b"IEND", b"")


def palette_table(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    (row,) = files.contents(spark, path).collect()  # one small image
    colours = palette_of(bytes(row.content))
    return spark.createDataFrame([(i, *map(int, c)) for i, c in enumerate(colours)], "idx int, r int, g int, b int"), len(colours)


def with_overviews(px: DataFrame, keys: list[str], layers: list[str], info: dict) -> DataFrame:
    """px and its overviews (`level` 2, 4, ...) by every level-th cell."""
    every = [px.withColumn("level", F.lit(1))]
    for f in raster.overview_factors(info["width"], info["height"]):
        every.append(px.filter((F.pmod("row", F.lit(f)) == 0) & (F.pmod("col", F.lit(f)) == 0)).withColumns({"row": (F.col("row") / f).cast("int"), "col": (F.col("col") / f).cast("int"), "level": F.lit(f), "dx": F.col("dx") * f, "dy": F.col("dy") * f, "height": F.ceil(F.col("height") / f).cast("int"), "width": F.ceil(F.col("width") / f).cast("int")}))
    return features.union_all(every)


def coloured(spark: SparkSession, root: str, palette: str, out: str, pattern: str = "*risk_score*.tif", suffix: str = "_colored_rgb_masked", low: float = 0.0, high: float = 1.0) -> dict:
    """Rasters as red, green, blue and opacity by a palette image, each with its overviews beside it (.ovr2.tif and on); rasters that can't be read are counted as failed."""
    table, n = palette_table(spark, palette)
    listed = files.not_coloured(files.listing(spark, root, pattern), suffix).select("path")
    content = files.contents(spark, root, pattern).join(listed, "path", "left_semi")
    info = written(geotiff.read_info(content), "info")
    good = info.filter("error is null")
    t = lambda i: F.get("transform", F.lit(i))
    about = good.select("path", F.regexp_extract("path", r"([^/]*)\.[^./]*$", 1).alias("stem"), t(2).alias("x0"), t(5).alias("y0"), t(0).alias("dx"), (-t(4)).alias("dy"), F.coalesce("epsg", F.lit(geometry.GEOGRAPHIC)).alias("epsg"), "height", "width")
    px = geotiff.read_pixels(content.join(good.select("path"), "path", "left_semi"), 1, ["v"]).join(about, "path").withColumn("v", F.col("v").cast("float"))
    high = high if high > low else low + 1e-6
    rgb = raster.colours(px, "v", table, n, low, high)
    most = about.agg(F.max("height"), F.max("width")).first()
    outputs: list[str] = []
    if most[0]:
        levels = with_overviews(rgb, ["stem"], ["r", "g", "b", "alpha"], {"height": most[0], "width": most[1]})
        named = levels.withColumn("ending", F.when(F.col("level") == 1, F.lit(".tif")).otherwise(F.concat(F.lit(".ovr"), F.col("level").cast("string"), F.lit(".tif"))))
        outputs = out_files(spark, geotiff.raster_files(named, ["stem", "ending"], {"{stem}" + suffix + "{ending}": ["r", "g", "b", "alpha"]}, "uint8", None), out)
    report = {"ok": good.count(), "failed": info.filter("error is not null").count(), "outputs": outputs}
    return report


def heat_map(spark: SparkSession, scored: DataFrame, parcels: DataFrame, column: str, template: str, palette: str, out: str, low: float = 0.0, high: float = 1.0) -> dict:
    """A scored column of an area's parcels burned into a template raster's grid, as values and as colours. scored: parcel_id and the column; parcels: parcel_id, geometry in degrees."""
    about = geotiff.read_info(files.contents(spark, template)).first()
    a, _, c, _, e, f = about.transform
    shapes = parcels.join(scored.select("parcel_id", F.col(column).cast("double").alias("value")).filter("value is not null and not isnan(value)"), "parcel_id")
    own = geometry.projected(F.col("geometry"), geometry.GEOGRAPHIC, about.epsg or geometry.GEOGRAPHIC)
    cells = shapes.select(F.col("parcel_id").alias("zone"), F.col("parcel_id").alias("ord"), "value", own.alias("geometry"))
    cells = cells.withColumn("geometry", geometry.mapped(F.col("geometry"), lambda p: F.struct(((p["x"] - c) / a).alias("x"), ((p["y"] - f) / e).alias("y"))))
    grid = spark.range(about.height).select(F.col("id").cast("int").alias("row")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(about.width - 1))))
    burned = spatial.burned(grid, cells).withColumn("burned", F.when(F.col("burned") != -9999.0, F.col("burned")))
    place = {"x0": F.lit(c), "y0": F.lit(f), "dx": F.lit(a), "dy": F.lit(-e), "epsg": F.lit(about.epsg or geometry.GEOGRAPHIC), "height": F.lit(about.height), "width": F.lit(about.width), "name": F.lit(column)}
    held = written(burned.withColumns(place), "burned")
    table, n = palette_table(spark, palette)
    outputs = out_files(spark, geotiff.raster_files(held, ["name"], {"{name}_heatmap.tif": ["burned"]}), out)
    outputs += out_files(spark, geotiff.raster_files(raster.colours(held, "burned", table, n, low, high), ["name"], {"{name}_heatmap_rgb.tif": ["r", "g", "b", "alpha"]}, "uint8", None), out)
    return {"cells": held.filter("burned is not null").count(), "outputs": sorted(outputs)}


# ---------------------------------------------------------------- exports


def export(spark: SparkSession, table: DataFrame, parcels: DataFrame, out: str) -> dict:
    """Predictions of each area and year as areas/SLUG/SLUG_YEAR_parcel_ml_scores.csv (with byte-order mark) and .geojson, and a manifest with counts.

    table: stages.exported() with parcels; parcels: parcel_id, area, geometry.
    """
    slug = text.area_slug(F.col("area"))
    stem = F.concat(F.lit("areas/"), slug, F.lit("/"), slug, F.lit("_"), F.col("year").cast("string"), F.lit("_parcel_ml_scores"))
    names = [c for c in table.columns if c not in ("area", "year", "geometry")]
    shaped = table.drop("geometry").join(parcels.select("parcel_id", "area", "geometry"), ["parcel_id", "area"])
    outputs = out_files(spark, csv_by(table, F.concat(stem, F.lit(".csv")), names, ["parcel_id"]), out)
    outputs += out_files(spark, geojson_by(shaped, F.concat(stem, F.lit(".geojson")), names, ["parcel_id"]), out)
    counts = [r.asDict() for r in table.groupBy("area", "year").agg(F.count("*").alias("rows_exported"), F.count_distinct("parcel_id").alias("unique_parcels_exported")).orderBy("area", "year").collect()]
    report = {"items": sorted(outputs), "sanity": counts}
    out_files(spark, small_file(spark, "frontend_ml_export_manifest.json", files.report(report)), out)
    return report


def cadastre(spark: SparkSession, archives: str, out: str) -> dict:
    """The two layers of the cadastre's tables as bundles of vector files, a summary of them and a text that says what they are, all of it in one archive too."""
    rows = files.zipped_tables(spark, archives)
    said = {"core": "land whose usage text names agriculture", "extended": "land of the agricultural usage code"}
    parts = [files.cadastre(rows.filter(mask)).withColumn("layer", F.lit(f"agri_{name}")) for name, mask in files.usage_masks(rows).items()]
    layers = written(features.union_all(parts), "cadastre", "zstd")
    made = written(vectors.bundle(layers, ["layer"], ["cad_num", "status", "c_cost", "area_m2", "utl_id", "utl_doc"]), "bundle", "zstd")
    counts = layers.groupBy("layer").agg(F.count("*").alias("count")).withColumns({"crs": F.lit("EPSG:4326"), "description": F.when(F.col("layer") == "agri_core", said["core"]).otherwise(said["extended"])})
    words = "\n".join(f"{k}: {v}" for k, v in sorted(said.items())) + "\n"
    outputs = [p for part in (made.select("path", "content"), one_csv(counts, "summary.csv", ["layer"]), small_file(spark, "README.txt", words)) for p in out_files(spark, part, out)]
    return {"layers": {r.layer: r["count"] for r in counts.collect()}, "outputs": sorted(outputs)}
