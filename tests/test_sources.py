import io
import json
import struct
import zipfile
import zlib

import numpy as np
import pytest

from loamline.operators import geometry as g
from loamline.sources import files, geotiff, vectors


@pytest.mark.parametrize("dtype", ["uint8", "int16", "float32", "float64"])
@pytest.mark.parametrize("predictor", [None, 1])
def test_geotiff_round_trip(dtype, predictor):
    rng = np.random.default_rng(1)
    bands = (rng.normal(size=(3, 70, 45)) * 50 + 60).clip(0, 250).astype(dtype)
    r = geotiff.Raster(bands, (0.5, 0.0, 120.0, 0.0, -0.25, 60.0), 32652, -9999.0)
    back = geotiff.decode(geotiff.encode(r, 32, predictor))
    assert (back.bands == bands).all() and back.transform == r.transform and back.epsg == 32652 and back.nodata == -9999.0


def test_stripped_big_endian(spark):
    a = np.arange(15, dtype=">u2").reshape(5, 3)
    strips = [zlib.compress(a[:2].tobytes()), zlib.compress(a[2:4].tobytes()), zlib.compress(a[4:].tobytes())]
    tags = [(256, 4, 3), (257, 4, 5), (258, 3, 16), (259, 3, 8), (277, 3, 1), (278, 4, 2)]
    at = 8 + 2 + 12 * (len(tags) + 2) + 4
    lists = at, at + 12
    first = at + 24
    rows = [struct.pack(">HHI", t, k, 1) + (struct.pack(">I", v) if k == 4 else struct.pack(">HH", v, 0)) for t, k, v in tags]
    rows += [struct.pack(">HHII", 273, 4, 3, lists[0]), struct.pack(">HHII", 279, 4, 3, lists[1])]
    rows.sort(key=lambda r: struct.unpack(">H", r[:2])[0])
    starts = np.cumsum([first, *map(len, strips)])[:-1]
    data = b"MM\0*" + struct.pack(">IH", 8, len(rows)) + b"".join(rows) + bytes(4) + struct.pack(">3I", *starts) + struct.pack(">3I", *map(len, strips)) + b"".join(strips)
    assert (geotiff.decode(data).bands[0] == a).all()


def test_rasters_through_spark(spark, tmp_path):
    a = np.arange(20.0, dtype="float32").reshape(1, 4, 5)
    a[0, 1, 1] = -1
    (tmp_path / "x.tif").write_bytes(geotiff.encode(geotiff.Raster(a, (1, 0, 0, 0, -1, 4), 3857, -1.0)))
    (tmp_path / "bad.tif").write_bytes(b"nothing")
    info = {r.path.rsplit("/", 1)[1]: r for r in geotiff.read_info(files.contents(spark, str(tmp_path), "*.tif")).collect()}
    assert info["x.tif"].epsg == 3857 and info["x.tif"].width == 5 and info["x.tif"].error is None and info["bad.tif"].error
    px = geotiff.read_pixels(files.contents(spark, str(tmp_path), "x.tif"), 1, ["v"])
    got = {(r["row"], r["col"]): r.v for r in px.collect()}
    assert len(got) == 20 and got[1, 1] is None and got[3, 4] == 19
    content = geotiff.encoded(px.drop("path").selectExpr("1 AS k", "*"), ["k"], ["v"], (1, 0, 0, 0, -1, 4), 3857).first().content
    assert np.array_equal(geotiff.decode(bytes(content)).band(), np.where(a[0] == -1, np.nan, a[0]), equal_nan=True)


SQUARE, HOLE = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)]
SHAPES = [[[SQUARE, HOLE]], [[SQUARE], [[(x + 10, y) for x, y in SQUARE]]]]
ROWS = [{"name": "Поле", "n": "1"}, {"name": "b", "n": "22"}]


def test_shapefile_in_zip(spark, tmp_path):
    (tmp_path / "a.zip").write_bytes(vectors.zipped(vectors.write_shp(SHAPES, ROWS, ["name", "n"]), "sub/x.GBD"))
    (tmp_path / "b.zip").write_bytes(b"broken")
    df = vectors.read_zipped_shapefiles(files.contents(spark, str(tmp_path), "*.zip"))
    rows = df.select("*", g.area(df.geometry).alias("a")).orderBy("path", "a").collect()
    assert [(r.properties, r.a, r.epsg) for r in rows[:2]] == [(ROWS[0], 15.0, 4326), (ROWS[1], 32.0, 4326)] and rows[2].error
    assert [r.member for r in files.zip_members(files.contents(spark, str(tmp_path), "a.zip")).collect()] == ["sub/x.GBD.shp"]


def test_geopackage(spark, tmp_path):
    (tmp_path / "x.gpkg").write_bytes(vectors.geopackage({"one": (SHAPES, ROWS, 3857), "two": (SHAPES[:1], [{}], 4326)}))
    df = vectors.read_geopackages(files.contents(spark, str(tmp_path), "*.gpkg"))
    got = sorted((r.layer, r.epsg, r.a) for r in df.select("layer", "epsg", g.area(df.geometry).alias("a")).collect())
    assert got == [("one", 3857, 15.0), ("one", 3857, 32.0), ("two", 4326, 15.0)]


def test_geojson(spark, tmp_path):
    (tmp_path / "x.gpkg").write_bytes(vectors.geopackage({"one": (SHAPES, ROWS, 4326)}))
    df = vectors.read_geopackages(files.contents(spark, str(tmp_path), "*.gpkg")).selectExpr("properties['name'] AS name", "geometry")
    text = vectors.feature_collection([r.value for r in vectors.geojson_lines(df, ["name"]).collect()], 3857)
    assert len(json.loads(text)["features"]) == 2
    (tmp_path / "x.geojson").write_text(text)
    back = vectors.read_geojson(spark, str(tmp_path))
    assert sorted((r.name, r.a, r.epsg) for r in back.selectExpr("properties['name'] AS name", "epsg", "geometry").select("name", "epsg", g.area(back.geometry).alias("a")).collect()) == [("b", 32.0, 3857), ("Поле", 15.0, 3857)]


def test_crs_texts():
    assert vectors.epsg_of("urn:ogc:def:crs:EPSG::32652") == 32652 and vectors.epsg_of('PROJCS["WGS_1984_UTM_Zone_52N"') == 32652
    assert vectors.epsg_of('GEOGCS["GCS_WGS_1984"') == 4326 and vectors.epsg_of("no") is None and vectors.epsg_of(None) is None


def test_nested_archives_and_cadastre(spark, tmp_path):
    head = ",".join(files.CADASTRE) + ",X\n"
    rows = ['1, used, 5.5, 10, 003001000000, Пашня №1,"POLYGON ((0 0, 1 0, 1 1, 0 0))",z', '2, used, bad, , 003001000000, садоводство,"POLYGON ((0 0, 1 0, 1 1, 0 0))",z', "3, , 1, 1, 003002000000, ПАСТБИЩА,,z", '4,,1,1,003001000000, ЛПХ жилой дом,"POLYGON ((0 0, 2 0, 2 2, 0 0))",z']
    inner = io.BytesIO()
    with zipfile.ZipFile(inner, "w") as z:
        z.writestr("t.csv", "﻿" + head + "\n".join(rows))
    with zipfile.ZipFile(tmp_path / "outer.zip", "w") as z:
        z.writestr("a.csv.zip", inner.getvalue())
        z.writestr("readme.txt", "x")
    df = files.zipped_tables(spark, str(tmp_path))
    masks = files.usage_masks(df)
    got = {r.CAD_N: (r.e, r.c) for r in df.select("CAD_N", masks["extended"].alias("e"), masks["core"].alias("c")).collect()}
    assert got == {"1": (True, True), "2": (True, False), "3": (False, False), "4": (True, False)}
    land = {r.cad_num: (r.c_cost, r.area_m2, r.status) for r in files.cadastre(df).collect()}
    assert land == {"1": (5.5, 10.0, "used"), "2": (None, None, "used"), "4": (1.0, 1.0, "")}


def test_parcel_statistics(spark, tmp_path):
    (tmp_path / "amga_2020_parcel_stats.csv").write_text("id,NDVI avg,change share %\n1,0.5,0.1\n2,x,\n")
    (tmp_path / "yunkyur_2021_parcel_stats.csv").write_text("cad_num;ndwi_mean\n9;0.25\n")
    (tmp_path / "amga_2020_parcel_stats_valid.csv").write_text("id,ok\n1,Да\n1,no\n2,0\n")
    got = {(r.area, r.year, r.parcel_id): (r.ndvi_mean, r.ndwi_mean, r.is_valid) for r in files.parcel_stats(spark, str(tmp_path)).collect()}
    assert got == {("Амга", 2020, "1"): (0.5, None, True), ("Амга", 2020, "2"): (None, None, False), ("Юнкор", 2021, "9"): (None, 0.25, None)}


def test_listings(spark, tmp_path):
    for name in ("amga_2020_risk_score.tif", "amga_x_risk_score.tif", "yunkor_2021_risk_score.tif", "s/riskscore_amga_2021.tif", "a.GBD.shp", "s/m.csv", "o_colour.tif"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"x")
    every = files.listing(spark, str(tmp_path))
    assert every.count() == 7 and files.footprints(every).count() == 1
    assert [r.year for r in files.risk_years(every, "amga").collect()] == [2020]
    assert files.template_raster(every, "amga", 2021).first().path.endswith("riskscore_amga_2021.tif")
    assert files.not_coloured(every, "_colour").count() == 6
    kinds = {r.relpath: (r.folder, r.kind) for r in files.classified(every, str(tmp_path)).collect()}
    assert kinds["s/m.csv"] == ("s", "table") and kinds["a.GBD.shp"][1] == "vector"
    (tmp_path / "manifest.txt").write_text(" a\\b.tif \n\n c.tif\n")
    assert [r.path for r in files.manifest(spark, str(tmp_path / "manifest.txt")).collect()] == ["a/b.tif", "c.tif"]
    (tmp_path / "j").mkdir()
    (tmp_path / "j/a.json").write_text('{"a": 1}')
    (tmp_path / "j/b.json").write_text("{oops")
    assert sorted((r.path[-6:], r.error) for r in files.json_files(spark, str(tmp_path / "j")).collect()) == [("a.json", None), ("b.json", "not JSON")]
    assert files.merged_settings({"a": {"b": 1, "c": 2}, "d": 3}, {"a": {"c": 5}, "e": 6}) == {"a": {"b": 1, "c": 5}, "d": 3, "e": 6}
