"""Whole runs over folders of files that the tests make, read back from what they write."""

import json
import struct
import zlib
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.__main__ import main
from loamline.operators import geometry, raster
from loamline.plans import runs
from loamline.sources import files, geotiff, vectors

N = 24
SCENES = {
    "102_2026_113_1111111/1111111_13.01.26_Амга/KV6_00000_00000-01_KANOPUS_20220512_014309_20.L2.MS.SCN01": 0.0,
    "102_2026_113_1111112/1111112_13.01.26_Амга/KV6_00000_00000-01_KANOPUS_20230509_013320_20.L2.MS.SCN01": 0.03,
    "102_2026_113_1111113/1111113_13.01.26_Амга/KV6_00000_00000-01_KANOPUS_20230703_013706_20.L2.MS.SCN01": 0.05,
}
CELL = 0.1 / N
TRANSFORM = (CELL, 0.0, 120.0, 0.0, -CELL, 60.1)


def bands_of(shift):
    x, y = np.meshgrid(np.linspace(0, 1, N), np.linspace(0, 1, N))
    wet = (x - 0.7) ** 2 + (y - 0.3) ** 2 < (0.12 + shift / 2) ** 2
    out = np.stack([0.10 + 0.02 * x + 0.01 * y, 0.15 + 0.05 * x + 0.12 * wet, 0.18 + 0.05 * y + shift - 0.04 * wet, 0.35 + 0.08 * x - 0.04 * y - shift - 0.20 * wet])
    return out.astype("float32")


def square(x0, y0, x1, y1):
    return [[[(x0, y0), (x0, y1), (x1, y1), (x1, y0), (x0, y0)]]]


def scene_folders(root):
    for folder, shift in SCENES.items():
        d = root / folder
        d.mkdir(parents=True)
        (d / f"{d.name}.tif").write_bytes(geotiff.encode(geotiff.Raster(bands_of(shift), TRANSFORM, 4326, -9999.0)))
        for ending, content in vectors.write_shp([square(120.0, 60.0, 120.1, 60.1)], [{"id": "1"}], ["id"]).items():
            (d / f"{d.name}.GBD{ending}").write_bytes(content)


def collection(shapes):
    return json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": p, "geometry": {"type": "MultiPolygon", "coordinates": s}} for p, s in shapes]})


@pytest.fixture(scope="module")
def ran(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("run")
    scene_folders(root / "data")
    (root / "parcels.geojson").write_text(collection([({"parcel_id": "1"}, square(120.01, 60.01, 120.05, 60.05)), ({"parcel_id": "2"}, square(120.05, 60.02, 120.09, 60.08)), ({"parcel_id": "3"}, square(10, 10, 11, 11))]))
    x, y = np.meshgrid(np.linspace(0, 1, N), np.linspace(0, 1, N))
    heights = (150 + 10 * x + 20 * y + 2 * np.sin(10 * x) * np.cos(8 * y)).astype("float32")
    (root / "dem.tif").write_bytes(geotiff.encode(geotiff.Raster(heights[None], TRANSFORM, 4326, -9999.0)))
    report = runs.run(spark, str(root / "data"), str(root / "out"), str(root / "parcels.geojson"), str(root / "dem.tif"), textures=False)
    return root, report


def test_a_run_writes_what_it_reports(ran):
    root, report = ran
    out = root / "out"
    assert report["areas"] == ["Амга"] and report["scanned_scene_rows"] == report["selected_ms_rows"] == 3
    assert all((out / p).exists() for p in report["outputs"]) and not list(out.rglob("*.tmp"))
    must = ["catalog/scene_catalog_scan.csv", "aoi/aoi_union.geojson", "composites/Амга_2022_annual_ms_composite.tif", "indices/Амга_2022_annual_ndvi.tif", "terrain/Амга_2022_slope.tif", "masks/Амга_2023_hotspot_mask.tif", "analytics/Амга_2023_parcel_stats.csv", "dynamics/Амга_2022_2023_delta_ndvi.tif", "composites/Амга_2022_early_ms_composite.tif"]
    assert set(must) <= set(report["outputs"])
    assert json.loads((out / "run_report.json").read_text()) == report and (out / "manifest.txt").read_text().split("\n")[:-1] == report["outputs"]


def test_rasters_of_a_run(ran):
    root, _ = ran
    at = lambda name: geotiff.decode((root / "out" / name).read_bytes())
    one, both = at("composites/Амга_2022_annual_ms_composite.tif"), at("composites/Амга_2023_annual_ms_composite.tif")
    assert np.allclose(one.transform, TRANSFORM) and one.epsg == 4326 and one.bands.shape == (4, N, N)
    assert np.allclose(one.bands, bands_of(0.0), atol=1e-5)
    assert np.allclose(both.bands, (bands_of(0.03).astype(float) + bands_of(0.05)) / 2, atol=1e-5)
    ndvi = lambda b: (b[3] - b[2]) / (b[3] + b[2] + 1e-6)
    assert np.allclose(at("indices/Амга_2022_annual_ndvi.tif").bands[0], ndvi(bands_of(0.0)), atol=1e-4)
    assert np.allclose(at("dynamics/Амга_2022_2023_delta_ndvi.tif").bands[0], ndvi(both.bands) - ndvi(one.bands), atol=1e-4)
    risk, hot = at("dynamics/Амга_2023_risk_score.tif").bands[0], at("masks/Амга_2023_hotspot_mask.tif").bands[0]
    assert 0 <= risk.min() <= risk.max() <= 1 and set(np.unique(hot)) == {0, 1} and 0.08 < hot.mean() < 0.15
    assert (risk[hot == 1].min() >= risk[hot == 0].max()) and at("terrain/Амга_2022_slope.tif").bands.shape == (1, N, N)


def test_parcel_tables_of_a_run(spark, ran):
    root, _ = ran
    path = root / "out/analytics/Амга_2023_parcel_stats.csv"
    assert path.read_bytes().startswith(b"\xef\xbb\xbf")
    lines = path.read_text("utf-8-sig").strip().split("\n")
    assert lines[0].startswith("parcel_id,") and sorted(x.split(",")[0] for x in lines[1:]) == ["1", "2"]
    row = dict(zip(lines[0].split(","), next(x for x in lines[1:] if x.startswith("1,")).split(",")))
    ndvi = geotiff.decode((root / "out/indices/Амга_2023_annual_ndvi.tif").read_bytes()).bands[0]
    centre = lambda i: 60.1 - (i + 0.5) * CELL
    rows, cols = [i for i in range(N) if 60.01 <= centre(i) < 60.05], [i for i in range(N) if 120.01 <= 120 + (i + 0.5) * CELL < 120.05]
    assert float(row["ndvi_mean"]) == pytest.approx(ndvi[np.ix_(rows, cols)].mean(), abs=1e-5) and int(row["n_px"]) == len(rows) * len(cols)
    table = files.parcel_stats(spark, str(root / "out/analytics"))
    assert {(r.area, r.year, r.parcel_id) for r in table.collect()} == {("Амга", y, p) for y in (2022, 2023) for p in "12"}
    union = spark.read.text(str(root / "out/aoi/aoi_union.geojson"), wholetext=True)
    assert vectors.read_geojson(spark, str(root / "out/aoi/aoi_union.geojson"), "*").select(geometry.area(F.col("geometry")).alias("a")).first().a == pytest.approx(0.01) and union.count() == 1


def png(rows):
    """A palette image with a white margin, in rows of RGB, each with another filter."""
    h, w = rows.shape[:2]
    chunk = lambda kind, body: struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))
    raw, above = b"", np.zeros(w * 3, int)
    for i in range(h):
        line = rows[i].reshape(-1).astype(int)
        left = np.concatenate([np.zeros(3, int), line[:-3]])
        corner = np.concatenate([np.zeros(3, int), above[:-3]])
        p = left + above - corner
        near = np.stack([abs(p - left), abs(p - above), abs(p - corner)])
        paeth = np.choose(near.argmin(axis=0), [left, above, corner])
        raw += bytes([i % 5]) + ((line - [0, left, above, (left + above) // 2, paeth][i % 5]) % 256).astype("u1").tobytes()
        above = line
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b"")


def ramp():
    image = np.full((11, 9, 3), 255, "u1")
    image[:, 2:7] = (np.arange(11)[:, None, None] * np.array([25, 10, 0])[None, None, :]).astype("u1")
    return image


def test_palettes():
    assert runs.palette_of(png(ramp())).tolist() == [[25 * i, 10 * i, 0] for i in range(11)]
    with pytest.raises(ValueError):
        runs.palette_of(b"GIF89a")


def test_colours_and_heat_maps(spark, ran, tmp_path):
    root, _ = ran
    (tmp_path / "palette.png").write_bytes(png(ramp()))
    (tmp_path / "in").mkdir()
    a = np.linspace(-0.1, 1.1, 300 * 600).reshape(1, 300, 600).astype("float32")
    a[0, 0, 0] = -9999
    (tmp_path / "in/x_risk_score.tif").write_bytes(geotiff.encode(geotiff.Raster(a, (1, 0, 5, 0, -1, 7), 3857, -9999.0)))
    (tmp_path / "in/y_risk_score.tif").write_bytes(b"broken")
    got = runs.coloured(spark, str(tmp_path / "in"), str(tmp_path / "palette.png"), str(tmp_path / "out"))
    assert (got["ok"], got["failed"]) == (1, 1) and got["outputs"] == ["x_risk_score_colored_rgb_masked.ovr2.tif", "x_risk_score_colored_rgb_masked.tif"]
    rgb = geotiff.decode((tmp_path / "out" / got["outputs"][1]).read_bytes())
    index = np.rint(np.clip(a[0].astype(float), 0, 1) * 10).astype(int)
    index[0, 0] = 0
    assert rgb.bands.dtype == np.uint8 and rgb.epsg == 3857 and (rgb.bands[0] == index * 25).all() and (rgb.bands[1] == index * 10).all()
    assert rgb.bands[3, 0, 0] == 0 and (rgb.bands[3].ravel()[1:] == 255).all()
    assert (geotiff.decode((tmp_path / "out" / got["outputs"][0]).read_bytes()).bands == rgb.bands[:, ::2, ::2]).all()
    parcels = vectors.read_geojson(spark, str(root / "parcels.geojson"), "*").select(F.element_at("properties", "parcel_id").alias("parcel_id"), "geometry")
    scored = spark.createDataFrame([("1", 0.5), ("2", 1.0)], "parcel_id string, score double")
    template = str(root / "out/dynamics/Амга_2023_risk_score.tif")
    got = runs.heat_map(spark, scored, parcels, "score", template, str(tmp_path / "palette.png"), str(tmp_path / "heat"))
    heat = geotiff.decode((tmp_path / "heat/score_heatmap.tif").read_bytes())
    assert (heat.bands == 0.5).sum() > 50 and (heat.bands == 1.0).sum() > 50 and got["cells"] == (heat.bands > 0).sum()


def test_areas_of_interest(spark, ran, tmp_path):
    root, _ = ran
    assert main(["aoi", "--in", str(root / "data"), "--out", str(tmp_path / "aoi")], spark) == 0
    report = json.loads((tmp_path / "aoi/aoi_report.json").read_text())
    assert report["scenes"] == 3 and report["zones"] == 1 and report["area_km2"] == pytest.approx(61.9, abs=0.5)
    pairs = (tmp_path / "aoi/scene_to_zone.csv").read_text("utf-8-sig").split("\n")
    assert len([p for p in pairs if p.endswith("ZONE_001")]) == 3 and pairs[0] == "scene_id,zone_id"


def test_clipped_fields(spark, tmp_path):
    shapes, rows = [square(0, 0, 2, 2), square(1, 1, 3, 3), square(10, 10, 11, 11)], [{"cad_num": "a", "utl_doc": "Пашня"}, {"cad_num": "b", "utl_doc": "пастбище"}, {"cad_num": "c", "utl_doc": "Пашня"}]
    rows.append({"cad_num": "d", "utl_doc": "дорога"})
    shapes.append(square(0, 0, 1, 1))
    (tmp_path / "fields.zip").write_bytes(vectors.zipped(vectors.write_shp(shapes, rows, ["cad_num", "utl_doc"]), "fields"))
    (tmp_path / "scenes").mkdir()
    with zipfile.ZipFile(tmp_path / "scenes/3926868_x.zip", "w") as z:
        for e, c in vectors.write_shp([square(0, 0, 1.5, 1.5)], [{"id": "1"}], ["id"]).items():
            z.writestr(f"s/KANOPUS.GBD{e}", c)
    assert main(["clip", "--in", str(tmp_path / "fields.zip"), "--scenes", str(tmp_path / "scenes"), "--out", str(tmp_path / "out")], spark) == 0
    stem = "amga_strict_fields_by_scene_aoi"
    assert {f"{stem}{e}" for e in (".shp", ".shx", ".dbf", ".prj", ".cpg", "_shp.zip", ".geojson", "_geojson.zip", ".gpkg")} <= {p.name for p in (tmp_path / "out").iterdir()}
    for back in (vectors.read_shapefiles(files.contents(spark, str(tmp_path / "out"), f"{stem}.*")), vectors.read_geojson(spark, str(tmp_path / "out"), f"{stem}.geojson"), vectors.read_geopackages(files.contents(spark, str(tmp_path / "out"), f"{stem}.gpkg")), vectors.read_zipped_shapefiles(files.contents(spark, str(tmp_path / "out"), f"{stem}_shp.zip"))):
        got = {r.p["parcel_id"]: r.a for r in back.select(F.col("properties").alias("p"), geometry.area(F.col("geometry")).alias("a")).collect()}
        assert got == {"a": 2.25, "b": 0.25}


def test_known_cases(spark, ran, tmp_path):
    root, _ = ran
    (tmp_path / "masks.geojson").write_text(collection([({"name": "m"}, square(120.0, 60.05, 120.05, 60.1))]))
    (tmp_path / "points.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": "p"}, "geometry": {"type": "Point", "coordinates": [120.05, 60.05]}}]}))
    got = runs.cases(spark, str(root / "out/dynamics"), "Амга", str(tmp_path / "out"), str(tmp_path / "masks.geojson"), str(tmp_path / "points.geojson"), 0.02)
    lines = (tmp_path / "out/Амга_case_comparison.csv").read_text("utf-8-sig").strip().split("\n")
    rows = [dict(zip(lines[0].split(","), x.split(","))) for x in lines[1:]]
    assert got["rows"] == len(rows) and {(r["zone"], r["kind"]) for r in rows} == {("m", "mask"), ("p", "case")}
    risk = geotiff.decode((root / "out/dynamics/Амга_2023_risk_score.tif").read_bytes()).bands[0][: N // 2, : N // 2]
    one = next(r for r in rows if r["kind"] == "mask" and r["year"] == "2023" and r["layer"] == "risk_score")
    assert float(one["mean"]) == pytest.approx(risk.mean(), abs=1e-6) and int(one["n"]) == risk.size and float(one["p90"]) == pytest.approx(np.quantile(risk, 0.9), abs=1e-6)


def test_scenes_in_another_projection(spark):
    """A scene in EPSG:3857 comes to a grid in degrees: a plane stays a plane."""
    x0, y1 = 20037508.342789244 * 120 / 180, float(np.log(np.tan(np.pi / 4 + np.radians(60.1) / 2)) * 6378137)
    px = spark.range(80 * 80).select(F.lit("s").alias("path"), (F.col("id") / 80).cast("int").alias("row"), (F.col("id") % 80).cast("int").alias("col")).withColumn("v", F.lit(x0) + (F.col("col") + 0.5) * 300.0)
    info = spark.createDataFrame([("s", "A", [300.0, 0.0, x0, 0.0, -300.0, y1], 3857, 80, 80)], "path string, area string, transform array<double>, epsg int, width int, height int")
    grids = spark.createDataFrame([("A", 120.0, 60.1, 0.01, 0.01, 4326, 8, 10)], "area string, x0 double, y0 double, dx double, dy double, epsg int, height int, width int")
    got = runs.on_grids(px, info, grids, ["v"]).collect()
    want = {c: (120.0 + (c + 0.5) * 0.01) / 180 * 20037508.342789244 for c in range(10)}
    assert len(got) == 80 and all(abs(r.v - want[r.col]) < 1e-2 for r in got)


def test_textures_of_a_run(spark, ran, tmp_path):
    root, _ = ran
    one = tmp_path / "data"
    folder = next(f for f in SCENES if "20220512" in f)
    (one / folder).parent.mkdir(parents=True)
    import shutil

    shutil.copytree(root / "data" / folder, one / folder)
    report = runs.run(spark, str(one), str(tmp_path / "out"))
    names = [p.removeprefix("textures/Амга_2022_").removesuffix(".tif") for p in report["outputs"] if p.startswith("textures/")]
    assert len(names) == 36 and {"nir_local_std_w7", "pc1_glcm_entropy_w5", "red_local_var_w5"} <= set(names)
    nir = bands_of(0.0)[3].astype(float)
    std = geotiff.decode((tmp_path / "out/textures/Амга_2022_nir_local_std_w5.tif").read_bytes()).bands[0]
    assert std[10, 10] == pytest.approx(nir[8:13, 8:13].std(), abs=1e-5)
    assert all((tmp_path / "out" / p).exists() for p in report["outputs"]) and not any(p.startswith("analytics/") for p in report["outputs"])


def test_components_of_groups(spark):
    rng = np.random.default_rng(7)
    rows = [(k, i, *map(float, v)) for k, scale in (("a", 1.0), ("b", 5.0)) for i, v in enumerate(rng.normal(size=(60, 4)) * scale + rng.normal(size=(60, 1)) * 3)]
    rows += [("few", i, 1.0, 2.0, 3.0, float(i)) for i in range(5)] + [("a", 99, None, 1.0, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, i int, blue double, green double, red double, nir double")
    got = {(r.k, r.i): r.pc1 for r in raster.first_component(df, keys=["k"]).collect()}
    assert len(got) == len(rows) and got["few", 1] is None and got["a", 99] is None
    for k in "ab":
        x = np.array([r[2:] for r in rows if r[0] == k and r[2] is not None])
        z = (x - x.mean(axis=0)) / x.std(axis=0)
        values, vectors = np.linalg.eigh(np.cov(z.T))
        v = vectors[:, -1] * np.sign(vectors[:, -1].sum())
        assert np.allclose([got[k, i] for i in range(60)], z @ v)
