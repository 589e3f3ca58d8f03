from pyspark.sql import functions as F

from loamline.operators import audit
from loamline.plans import stages
from loamline.streaming import incremental


def test_arriving_rows(spark, tmp_path):
    rows = spark.createDataFrame([("A", "2024-05-03 10:00:00"), ("A", "2024-05-03 12:00:00"), ("B", "2024-07-01 00:00:00"), ("B", "2024-01-01 00:00:00")], "area string, t string").select("area", F.col("t").cast("timestamp").alias("ts"))
    rows.write.parquet(str(tmp_path / "in"))
    stream = incremental.arriving(spark, str(tmp_path / "in"), "area string, ts timestamp")
    seen = []
    incremental.on_each_batch(stream, lambda df: seen.append(df.count()), str(tmp_path / "c1")).awaitTermination()
    assert sum(seen) == 4
    q = incremental.season_counts(stream).writeStream.format("memory").queryName("seasons").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted((r.area, r.season, r.n) for r in spark.table("seasons").collect()) == [("A", "early", 2), ("B", "mid", 1), ("B", "none", 1)]


def test_audit_of_a_folder(spark):
    rows = [
        ("indices/amga_2020_annual_ndvi.tif", -1.5, 0.5, [0.1], 10, 10), ("indices/amga_2020_annual_ndwi.tif", -0.5, 0.5, [0.1], 10, 10), ("indices/amga_2020_annual_brightness.tif", 0.1, 0.5, [0.1], 11, 10),
        ("masks/amga_2020_water_mask.tif", 0.0, 2.0, [0.0, 2.0], 10, 10), ("masks/amga_2020_change_mask.tif", 0.0, 1.0, [0.0, 1.0], 10, 10), ("dynamics/amga_2020_2021_delta_ndvi.tif", -2.5, 0.0, [0.0], 10, 10),
    ]
    df = spark.createDataFrame(rows, "relpath string, min double, max double, unique_preview array<double>, width int, height int").withColumns({"name": F.element_at(F.split("relpath", "/"), -1), "epsg": F.lit(3857)})
    df = df.withColumns({"xmin": F.lit(0.0), "ymin": F.lit(0.0), "xmax": F.lit(1.0), "ymax": F.lit(1.0)})
    listed = spark.createDataFrame([("a",), ("b",)], "path string")
    found = spark.createDataFrame([("b",), ("c",)], "path string")
    aoi = spark.createDataFrame([(0.99, 0.99, 5.0, 5.0)], "xmin double, ymin double, xmax double, ymax double")
    issues = stages.audited(df, listed, found, aoi).cache()
    codes = sorted((r.code, r.path) for r in issues.collect())
    count = lambda c: sum(x[0] == c for x in codes)
    assert ("RASTER_RANGE", "amga_2020_annual_ndvi.tif") in codes and ("RASTER_NOT_BINARY", "amga_2020_water_mask.tif") in codes
    assert count("RASTER_RANGE") == 3  # a delta layer answers to the rule of its index as well
    assert count("MANIFEST_MISSING_FILE") == count("MANIFEST_EXTRA_FILE") == 1 and count("OUTSIDE_AOI") == 6 and count("GRID_MISALIGNED") == 1
    assert {c for c, _ in codes} >= {"INDICES_MISSING", "MASKS_MISSING", "DYNAMICS_PAIR_MISSING"}
    report = audit.markdown(issues)
    assert "- ERROR: 1" in report and "MANIFEST_MISSING_FILE" in report


def test_zones_and_cases(spark):
    from loamline.operators import geometry as g

    boxes = [(1, 0, 0, 2, 2), (2, 1, 1, 3, 3), (3, 10, 10, 11, 11)]
    prints = spark.createDataFrame([tuple(map(float, b)) for b in boxes], "f double, a double, b double, c double, d double").select(F.col("f").cast("long").alias("fid"), g.box(*[F.col(x) for x in "abcd"]).alias("geometry"))
    out = stages.aoi_from_footprints(prints, 2.0)
    assert {r.fid: r.zone_id for r in out["scene_to_zone"].collect()} == {1: "ZONE_001", 2: "ZONE_001", 3: "ZONE_002"}
    sizes = {r.zone_id: r.area_km2 for r in out["zones"].collect()}
    assert abs(sizes["ZONE_001"] / 12308.8 - 7) < 0.05
    px = spark.range(400).select((F.col("id") / 20).cast("int").alias("row"), F.pmod("id", F.lit(20)).cast("int").alias("col"), F.lit(2020).alias("year"), F.col("id").cast("double").alias("v"))
    masks = spark.range(1).select(F.lit("m").alias("zone"), g.box(F.lit(0.0), F.lit(0.0), F.lit(2.0), F.lit(2.0)).alias("geometry"))
    cases = spark.createDataFrame([("c", 10.5, 10.5)], "zone string, x double, y double")
    got = {(r.zone, r.kind): (r.n, r["mean"], r["max"]) for r in stages.compared_with_cases(px, masks, cases, ["v"], 1.0).collect()}
    assert got == {("m", "mask"): (4, 10.5, 21.0), ("c", "case"): (5, 210.0, 230.0)}


def test_context_of_a_parcel(spark):
    from loamline.operators import geometry as g

    df = spark.range(1).select(F.lit("parcel 17/2").alias("parcel_id"), F.lit("Амга").alias("area"), g.box(F.lit(130.0), F.lit(60.0), F.lit(130.02), F.lit(60.02)).alias("geometry"))
    r = stages.parcel_context(df, 17, 1000.0).first()
    assert abs(r.lon - 130.01) < 1e-6 and abs(r.lat - 60.01) < 1e-4 and r.xmin < 130 < 130.02 < r.xmax and "mlat=60.01" in r.osm
    assert stages.parcel_context(df, 18, 1000.0).count() == 0
