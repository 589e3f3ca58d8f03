"""Sources, sinks and geometry repair: the driver's tables written by a sink to the shared folder, read back by a source, and held against SQL over the tables themselves."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nulls, text
from ..operators import audit, features, geometry, models, scenes, spatial
from ..session import new_dir, written
from ..sources import files, geotiff, vectors
from . import runs, stages
from .spatials import BOX, BX, PT, _boxes, _points, _polygons, _zones
from .tables import PX, PY, SC, parcel_years, pixels, scored, table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


# ---------------------------------------------------------------- rasters


def _gridded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raster of embeddings, a group for each label, on a grid of its own."""
    e = pixels(spark, sf_dir)
    size = e.agg(F.max("row") + 1).first()[0]
    place = {"x0": F.lit(500.0), "y0": F.lit(900.0), "dx": F.lit(2.0), "dy": F.lit(2.0), "epsg": F.lit(3857), "height": F.lit(size), "width": F.lit(16)}
    return e.withColumns(place)


@query(f'WITH {PX} SELECT CAST(label AS BIGINT) AS label, CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, round(nir, 5) + 0.0 AS nir, round(red, 5) + 0.0 AS red FROM px WHERE nir IS NOT NULL')
def geotiff_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bands of each label as one tiled file, read back; cells of other labels are nodata."""
    folder = new_dir(spark, "rasters")
    files.to_files(geotiff.raster_files(_gridded(spark, sf_dir), ["label"], {"{label}_bands.tif": ["red", "nir"]}), folder)
    px = geotiff.read_pixels(files.contents(spark, folder, "*.tif"), 2, ["red", "nir"]).filter("nir is not null")
    label = F.regexp_extract("path", r"(\d+)_bands", 1).cast("long")
    return px.select(label.alias("label"), *[F.col(c).cast("long").alias(c) for c in ("row", "col")], *[(F.round(c, 5) + 0.0).alias(c) for c in ("nir", "red")])


@query(f'WITH {PX} SELECT CAST(label AS BIGINT) AS label, CAST(16 AS BIGINT) AS width, CAST((SELECT max("row") + 1 FROM px) AS BIGINT) AS height, CAST(1 AS BIGINT) AS bands, CAST(3857 AS BIGINT) AS epsg, CAST(500 AS DOUBLE) AS x0, CAST(-2 AS DOUBLE) AS cell FROM px GROUP BY label')
def geotiff_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file for each layer of a group, by the names of layers; their headers."""
    folder = new_dir(spark, "rasters")
    files.to_files(geotiff.raster_files(_gridded(spark, sf_dir), ["label"], {f"layers/{{label}}_2020_{n}.tif": [n] for n in ("red", "nir")}), folder)
    listed = files.listing(spark, folder, "*_nir.tif").select("path")
    info = geotiff.read_info(files.contents(spark, folder, "*.tif").join(listed, "path", "left_semi"))
    t = lambda i: F.get("transform", F.lit(i))
    return info.select(F.regexp_extract("path", r"(\d+)_2020", 1).cast("long").alias("label"), *[F.col(c).cast("long").alias(c) for c in ("width", "height", "bands", "epsg")], t(2).alias("x0"), t(4).alias("cell"))


@query(f'WITH {PX}, k AS (SELECT "row", col, CASE WHEN nir IS NOT NULL THEN CAST(round_even(least(greatest((CAST(nir AS FLOAT) + 0.3) / 0.6, 0.0), 1.0) * 10, 0) AS BIGINT) END AS i FROM px) SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, coalesce(i * 25, 0) AS r, coalesce(i * 10, 0) AS g, CASE WHEN i IS NULL THEN 0 ELSE 255 END::BIGINT AS alpha FROM k')
def colour_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster file through a palette image to a colour file, read back."""
    source, out = new_dir(spark, "rasters"), new_dir(spark, "colours")
    files.to_files(geotiff.raster_files(_gridded(spark, sf_dir).withColumn("k", F.lit("x")), ["k"], {"{k}_risk_score.tif": ["nir"]}), source)
    files.to_files(runs.small_file(spark, "palette.png", runs.png_of([[25 * i, 10 * i, 0] for i in range(11)])), f"{source}/p")
    runs.coloured(spark, source, f"{source}/p/palette.png", out, low=-0.3, high=0.3)
    px = geotiff.read_pixels(files.contents(spark, out, "x_risk_score_colored_rgb_masked.tif"), 4, ["r", "g", "b", "alpha"])
    return px.select(*[F.col(c).cast("long").alias(c) for c in ("row", "col", "r", "g", "alpha")])


@query("SELECT CAST(i AS BIGINT) AS idx, CAST(25 * i AS BIGINT) AS r, CAST(10 * i AS BIGINT) AS g, CAST(i % 3 AS BIGINT) AS b FROM (SELECT unnest(range(11)) AS i)")
def palette_image(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Colours of an image with a white margin."""
    folder = new_dir(spark, "palette")
    files.to_files(runs.small_file(spark, "palette.png", runs.png_of([[25 * i, 10 * i, i % 3] for i in range(11)], margin=3)), folder)
    return runs.palette_table(spark, f"{folder}/palette.png")[0].select(*[F.col(c).cast("long").alias(c) for c in ("idx", "r", "g", "b")])


# ---------------------------------------------------------------- vectors

LAYERS = f"{BX} SELECT gid, CAST(gid % 3 AS BIGINT) AS layer, round((xmax - xmin) * (ymax - ymin), 6) AS area FROM bx"


def _layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three layers of boxes, as files of every kind."""
    rows = _polygons(spark, sf_dir).select(F.concat(F.lit("l"), (F.col("gid") % 3).cast("string")).alias("layer"), F.col("gid").cast("string").alias("gid"), "geometry")
    return vectors.bundle(rows, ["layer"], ["gid"])


def _measured(rows: DataFrame, layer) -> DataFrame:
    return rows.filter("error is null").select(F.element_at("properties", "gid").cast("long").alias("gid"), F.regexp_extract(layer, r"l(\d)", 1).cast("long").alias("layer"), F.round(geometry.area(F.col("geometry")), 6).alias("area"))


def _stored(spark: SparkSession, sf_dir: str, ending: str) -> str:
    folder = new_dir(spark, "vectors")
    files.to_files(_layers(spark, sf_dir).filter(F.col("path").rlike(ending)).select("path", "content"), folder)
    return folder


@query(f"WITH {LAYERS}")
def shapefiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shapefiles that lie side by side with their attributes and projection."""
    return _measured(vectors.read_shapefiles(files.contents(spark, _stored(spark, sf_dir, r"\.(shp|dbf|prj|shx|cpg)$"))), F.element_at(F.split("path", "/"), -1))


@query(f"WITH {LAYERS}")
def zipped_shapefiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, packed into archives."""
    return _measured(vectors.read_zipped_shapefiles(files.contents(spark, _stored(spark, sf_dir, r"_shp\.zip$"), "*.zip")), F.element_at(F.split("path", "/"), -1))


@query(f"WITH {LAYERS}")
def geopackages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measured(vectors.read_geopackages(files.contents(spark, _stored(spark, sf_dir, r"\.gpkg$"))), F.col("layer"))


@query(f"WITH {LAYERS}")
def geojson_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """GeoJSON documents, one for each layer, made of lines that tasks write."""
    folder = new_dir(spark, "geojson")
    rows = _polygons(spark, sf_dir).select(F.concat(F.lit("l"), (F.col("gid") % 3).cast("string"), F.lit(".geojson")).alias("file"), F.col("gid").cast("string").alias("gid"), "geometry")
    files.to_files(runs.geojson_by(rows, F.col("file"), ["gid"], ["gid"]), folder)
    return _measured(vectors.read_geojson(spark, folder), F.element_at(F.split("path", "/"), -1))


@query("WITH m AS (SELECT s_suppkey % 7 AS a, s_suppkey FROM supplier) SELECT CAST(a AS BIGINT) AS archive, concat('m', CAST(s_suppkey AS VARCHAR), '.gbd.shp') AS member FROM m WHERE s_suppkey % 2 = 0")
def archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Members of archives with an ending, in any case of letters."""

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            for k in pdf["s_suppkey"]:
                z.writestr(f"m{k}.gbd.shp" if k % 2 == 0 else f"m{k}.txt", b"x")
        return pd.DataFrame({"path": [f"{pdf['a'].iloc[0]}.zip"], "content": [out.getvalue()]})

    folder = new_dir(spark, "archives")
    made = table(spark, sf_dir, "supplier").withColumn("a", F.col("s_suppkey") % 7).groupBy("a").applyInPandas(pack, "path string, content binary")
    files.to_files(made, folder)
    return files.zip_members(files.contents(spark, folder, "*.zip")).select(F.regexp_extract("path", r"(\d+)\.zip$", 1).cast("long").alias("archive"), "member")


def _land_archives(spark: SparkSession, sf_dir: str) -> str:
    """Archives of archives of CSVs, as the cadastre comes: one for each of 5 groups of parts."""
    b = _boxes(spark, sf_dir)
    header, code = ",".join(files.CADASTRE), text.USAGE_CODE

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = [header]
        for g, x0, y0, x1, y1 in zip(*(pdf[c] for c in ("gid", "xmin", "ymin", "xmax", "ymax")), strict=True):
            wkt = "" if g % 20 == 0 else f'"POLYGON (({x0} {y0}, {x1} {y0}, {x1} {y1}, {x0} {y1}, {x0} {y0}))"'
            lines.append(f"{g},used,{g}.5,{g},{code if g % 3 else '1'},{'пашня' if g % 2 else 'дорога'},{wkt}")
        inner = io.BytesIO()
        with zipfile.ZipFile(inner, "w", zipfile.ZIP_DEFLATED) as z:
            z.writestr("t.csv", "\ufeff" + "\n".join(lines))
        outer = io.BytesIO()
        with zipfile.ZipFile(outer, "w") as z:
            z.writestr("a/t.csv.zip", inner.getvalue())
            z.writestr("readme.txt", b"no table")
        return pd.DataFrame({"path": [f"g{pdf['part'].iloc[0]}.zip"], "content": [outer.getvalue()]})

    folder = new_dir(spark, "cadastre")
    files.to_files(b.withColumn("part", F.floor(F.col("gid") / 5) % 5).groupBy("part").applyInPandas(pack, "path string, content binary"), folder)
    return folder


@query(f"WITH {BX} SELECT CAST(gid AS VARCHAR) AS cad_num, gid + CAST(0.5 AS DOUBLE) AS c_cost, gid % 3 <> 0 AND gid % 20 <> 0 AS extended, gid % 3 <> 0 AND gid % 20 <> 0 AND gid % 2 <> 0 AS core FROM bx")
def nested_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the CSVs in archives in archives, with both usage masks."""
    rows = files.zipped_tables(spark, _land_archives(spark, sf_dir))
    masks = files.usage_masks(rows)
    return rows.select(F.col("CAD_N").alias("cad_num"), nulls.number(F.col("C_COST")).alias("c_cost"), masks["extended"].alias("extended"), masks["core"].alias("core"))


@query(f"WITH {BX}, k AS (SELECT gid, (xmax - xmin) * (ymax - ymin) AS a FROM bx WHERE gid % 3 <> 0 AND gid % 20 <> 0 AND xmax > xmin) SELECT 'agri_extended' AS layer, count(*) AS n, round(sum(a), 4) AS area FROM k UNION ALL SELECT 'agri_core', count(*), round(sum(a), 4) FROM k WHERE gid % 2 <> 0")
def cadastre_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cadastre's two layers written as vector files, read back from their GeoPackages."""
    out = new_dir(spark, "layers")
    runs.cadastre(spark, _land_archives(spark, sf_dir), out)
    back = vectors.read_geopackages(files.contents(spark, out, "*.gpkg"))
    return back.groupBy("layer").agg(F.count("*").alias("n"), F.round(F.sum(geometry.area(F.col("geometry"))), 4).alias("area"))


# ---------------------------------------------------------------- tables, reports, listings


@query("SELECT s_suppkey, s_name, round(s_acctbal, 2) AS s_acctbal, concat('a \"b\", ', s_name) AS said FROM supplier")
def marked_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV that begins with the mark of UTF-8, with quotes and commas in its texts, written as one file and read back."""
    df = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal", F.concat(F.lit('a "b", '), F.col("s_name")).alias("said"))
    folder = new_dir(spark, "csv")
    files.to_files(runs.one_csv(df, "t.csv", ["s_suppkey"]), folder)
    back = spark.read.option("escape", '"').csv(f"{folder}/t.csv", header=True)
    first = back.columns[0].removeprefix(files.MARK)
    return back.toDF(first, *back.columns[1:]).select(F.col("s_suppkey").cast("long").alias("s_suppkey"), "s_name", F.round(F.col("s_acctbal").cast("double"), 2).alias("s_acctbal"), "said")


@query("SELECT o_orderkey, CAST(year(o_orderdate) AS BIGINT) AS year, o_orderstatus FROM orders")
def partitioned_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet and marked CSV by year and status, each read back by its folders; they hold the same rows."""
    df = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), "o_orderstatus")
    one, two = new_dir(spark, "parquet"), new_dir(spark, "csv")
    files.to_parquet(df, one, "year", "o_orderstatus")
    files.to_csv(df, two, "year", "o_orderstatus", mark=True)
    other = spark.read.csv(two, header=True)
    other = other.toDF(*[c.removeprefix(files.MARK) for c in other.columns]).select(F.col("o_orderkey").cast("long").alias("o_orderkey"))
    return spark.read.parquet(one).join(other, "o_orderkey").select("o_orderkey", F.col("year").cast("long").alias("year"), "o_orderstatus")


@query(f"WITH {PY}, k AS (SELECT CASE WHEN area < 'C' THEN 'Амга' ELSE 'Юнкор' END AS area, parcel_id, year, ndvi_mean, change_share FROM py WHERE parcel_id % 10 = 0) SELECT area, year, CAST(parcel_id AS VARCHAR) AS parcel_id, round(ndvi_mean, 9) AS ndvi_mean, CASE WHEN year % 2 = 0 THEN round(change_share, 9) END AS change_share, CASE WHEN year = 1995 THEN parcel_id % 20 = 0 END AS is_valid FROM k")
def parcel_stat_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics files of areas and years, some with fewer columns, and flags of one year, read as one table."""
    py = parcel_years(spark, sf_dir).filter("parcel_id % 10 = 0")  # the layer's parcels
    py = py.withColumns({"slug": F.when(F.col("area") < "C", "amga").otherwise("yunkor"), "id": F.col("parcel_id")})
    stem = F.concat("slug", F.lit("_"), F.col("year").cast("string"), F.lit("_parcel_stats"))
    folder = new_dir(spark, "stats")
    files.to_files(runs.csv_by(py.withColumnRenamed("ndvi_mean", "NDVI_avg").filter("year % 2 = 0"), F.concat(stem, F.lit(".csv")), ["id", "NDVI_avg", "change_share"], ["id"]), folder)
    files.to_files(runs.csv_by(py.filter("year % 2 <> 0"), F.concat(stem, F.lit(".csv")), ["id", "ndvi_mean"], ["id"]), folder)
    flags = py.filter("year = 1995").withColumn("ok", F.when(F.col("id") % 20 == 0, "Да").otherwise("no"))
    files.to_files(runs.csv_by(flags, F.concat(stem, F.lit("_valid.csv")), ["id", "ok"], ["id"]), folder)
    got = files.parcel_stats(spark, folder)
    return got.select("area", F.col("year").cast("long").alias("year"), "parcel_id", F.round("ndvi_mean", 9).alias("ndvi_mean"), F.round("change_share", 9).alias("change_share"), "is_valid")


@query(f"WITH {SC}, k AS (SELECT area, year, parcel_id, pred_logit FROM sc WHERE area IN ('src1', 'src2')) SELECT area, year, parcel_id, round(pred_logit, 9) AS pred_logit FROM k")
def front_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of areas by year as CSV and GeoJSON files; the rows that both hold."""
    df = scored(spark, sf_dir).filter("area in ('src1', 'src2')").withColumn("pred_ml_final", F.col("pred_logit"))
    out = new_dir(spark, "export")
    shapes = df.select("parcel_id", "area", geometry.box(F.col("parcel_id"), F.lit(0), F.col("parcel_id") + 1, F.lit(1)).alias("geometry")).distinct()
    runs.export(spark, stages.exported(df), shapes, out)
    place = F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)_(\d+)_parcel_ml_scores", 1), F.regexp_extract(F.col("_metadata.file_path"), r"_(\d+)_parcel_ml_scores", 1).cast("long")
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").csv(out, header=True).select("*", place[0].alias("area"), place[1].alias("year"))
    rows = rows.toDF(*[c.removeprefix(files.MARK) for c in rows.columns])
    drawn = vectors.read_geojson(spark, out).select(F.element_at("properties", "parcel_id").alias("parcel_id"), F.regexp_extract("path", r"/([^/]+)_(\d+)_parcel_ml_scores", 1).alias("area"))
    return rows.join(drawn, ["area", "parcel_id"]).select("area", "year", F.col("parcel_id").cast("long").alias("parcel_id"), F.round(F.col("pred_logit").cast("double"), 9).alias("pred_logit"))


@query("SELECT DISTINCT concat('masks/', CAST(s_nationkey AS VARCHAR), '.tif') AS path FROM supplier")
def manifest_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest written line by line, with blanks and Windows paths, read back."""
    paths = [r.p for r in table(spark, sf_dir, "supplier").select(F.concat(F.lit("masks\\"), F.col("s_nationkey").cast("string"), F.lit(".tif")).alias("p")).distinct().collect()]  # one for each nation
    folder = new_dir(spark, "manifest")
    files.to_text(spark, [x for p in sorted(paths) for x in (f"  {p} ", "")], folder)
    return files.manifest(spark, folder)


@query("SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'raster' WHEN 1 THEN 'vector' WHEN 2 THEN 'table' ELSE 'other' END AS kind, concat('d', CAST(n_nationkey % 3 AS VARCHAR)) AS folder FROM nation")
def classified_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder's files by kind and top folder."""
    n, k = table(spark, sf_dir, "nation"), F.col("n_nationkey") % 4
    path = F.concat(F.lit("d"), (F.col("n_nationkey") % 3).cast("string"), F.lit("/f"), F.col("n_nationkey").cast("string"), F.when(k == 0, ".tif").when(k == 1, ".geojson").when(k == 2, ".csv").otherwise(".bin"))
    folder = new_dir(spark, "listing")
    files.to_files(n.select(path.alias("path"), F.encode(F.lit("x"), "UTF-8").alias("content")), folder)
    got = files.classified(files.listing(spark, folder), folder)
    return got.select(F.regexp_extract("relpath", r"f(\d+)\.", 1).cast("int").alias("n_nationkey"), "kind", "folder")


@query("SELECT CAST(1992 + n_nationkey % 6 AS BIGINT) AS year, count(*) AS n FROM nation WHERE n_nationkey % 5 <> 0 GROUP BY 1")
def risk_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of a folder that are inputs, not outputs of the colour run, and the years that have a risk layer."""
    n = table(spark, sf_dir, "nation")
    name = F.concat(F.lit("n"), F.col("n_nationkey").cast("string"), F.lit("/amga_"), (1992 + F.col("n_nationkey") % 6).cast("string"), F.when(F.col("n_nationkey") % 5 == 0, "_risk_score_colored_rgb_masked.tif").otherwise("_risk_score.tif"))
    folder = new_dir(spark, "risk")
    files.to_files(n.select(name.alias("path"), F.encode(F.lit("x"), "UTF-8").alias("content")), folder)
    inputs = written(files.not_coloured(files.listing(spark, folder, "*.tif"), "_colored_rgb_masked"), "inputs")
    of = inputs.select(F.regexp_extract("path", r"amga_(\d{4})", 1).cast("long").alias("year")).groupBy("year").agg(F.count("*").alias("n"))
    return of.join(files.risk_years(inputs, "amga").select(F.col("year").cast("long").alias("year")), "year", "left_semi")


@query("""SELECT regexp_extract(d, 'x(\\d+)$', 1)::BIGINT AS scene, n FROM (SELECT concat('x', CAST(n_nationkey AS VARCHAR)) AS d, CAST(n_nationkey % 3 + 1 AS BIGINT) AS n FROM nation WHERE n_nationkey % 3 <> 2)""")
def footprint_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines among the files of scene folders, by the endings they have."""
    endings = ["a.GBD.shp", "b_gbd.shp"]
    n = table(spark, sf_dir, "nation").filter("n_nationkey % 3 <> 2").withColumn("k", F.explode(F.sequence(F.lit(0), (F.col("n_nationkey") % 3).cast("int"))))
    path = F.concat(F.lit("s/x"), F.col("n_nationkey").cast("string"), F.lit("/"), F.get(F.array(*[F.lit(e) for e in endings]), F.col("k")))
    other = table(spark, sf_dir, "nation").select(F.concat(F.lit("s/x"), F.col("n_nationkey").cast("string"), F.lit("/image.tif")).alias("path"))
    folder = new_dir(spark, "scenes")
    files.to_files(n.select(path.alias("path")).unionByName(other).withColumn("content", F.encode(F.lit("x"), "UTF-8")), folder)
    got = files.footprints(files.listing(spark, folder))
    return got.groupBy(F.regexp_extract("path", r"/x(\d+)/", 1).cast("long").alias("scene")).agg(F.count("*").alias("n"))


@query("SELECT p_partkey AS part, p_partkey % 4 <> 3 AS read, CASE WHEN p_partkey % 4 = 3 THEN NULL ELSE p_size::BIGINT END AS size FROM part WHERE p_partkey <= 200")
def json_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON files of a folder, those that don't parse marked."""
    p = table(spark, sf_dir, "part").filter("p_partkey <= 200")  # the folder's files
    body = F.when(F.col("p_partkey") % 4 == 3, F.lit("{broken")).otherwise(F.to_json(F.struct("p_size")))
    folder = new_dir(spark, "json")
    files.to_files(p.select(F.concat(F.col("p_partkey").cast("string"), F.lit(".json")).alias("path"), F.encode(body, "UTF-8").alias("content")), folder)
    got = files.json_files(spark, folder)
    return got.select(F.regexp_extract("path", r"(\d+)\.json$", 1).cast("long").alias("part"), F.col("error").isNull().alias("read"), F.when(F.col("error").isNull(), F.get_json_object("text", "$.p_size").cast("long")).alias("size"))


CATALOG = """SELECT replace(concat('D:/data/pkg', CAST(o_orderkey % 5 AS VARCHAR), '/', CASE WHEN o_orderkey % 2 = 0 THEN 'Съемка АМГА' ELSE 'юнкор 1' END, '/', s, '/image.TIF'), '\\', '/') AS tif_path, CASE WHEN o_orderkey % 2 = 0 THEN 'Амга' ELSE 'Юнкор' END AS area, CAST(year(d) AS BIGINT) AS year, product, level
FROM (SELECT o_orderkey, concat('KANOPUS_', strftime(o_orderdate, '%Y%m%d'), '_', lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0'), '1530_', CAST(o_orderkey % 10 AS VARCHAR), '.L2.MS.SCN01') AS s, o_orderdate AS d, 'MS' AS product, 'L2' AS level FROM orders)"""


@query(CATALOG)
def catalog_of_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scenes of an inventory with Windows paths and Cyrillic folders."""
    key = F.col("o_orderkey")
    scene = F.concat(F.lit("KANOPUS_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.lpad((key % 24).cast("string"), 2, "0"), F.lit("1530_"), (key % 10).cast("string"), F.lit(".L2.MS.SCN01"))
    path = F.concat(F.lit("D:\\data\\pkg"), (key % 5).cast("string"), F.lit("\\"), F.when(key % 2 == 0, "Съемка АМГА").otherwise("юнкор 1"), F.lit("\\"), scene, F.lit("\\image.TIF"))
    got = scenes.catalog_from_listing(table(spark, sf_dir, "orders").select(path.alias("FullName"), F.lit("FILE").alias("Type")))
    return got.select("tif_path", "area", F.col("year").cast("long").alias("year"), F.upper("product").alias("product"), F.upper("level").alias("level"))


# ---------------------------------------------------------------- geometry


@query(f"WITH {BX} SELECT gid, CASE WHEN gid % 4 = 0 THEN false ELSE true END AS valid, round(CASE WHEN gid % 4 = 0 THEN (xmax - xmin) * (ymax - ymin) / 2 ELSE (xmax - xmin) * (ymax - ymin) END, 6) AS area FROM bx")
def repaired_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines of which a quarter cross themselves: bow ties become two triangles."""
    at = lambda x, y: F.struct(F.col(x).alias("x"), F.col(y).alias("y"))
    tie = F.array(F.array(F.array(at("xmin", "ymin"), at("xmax", "ymax"), at("xmax", "ymin"), at("xmin", "ymax"), at("xmin", "ymin"))))
    df = _polygons(spark, sf_dir).withColumn("geometry", F.when(F.col("gid") % 4 == 0, tie).otherwise(F.col("geometry")))
    return df.select("gid", geometry.is_valid("geometry").alias("valid"), F.round(geometry.area(geometry.made_valid("geometry")), 6).alias("area"))


@query(f"WITH {BX} SELECT gid, round((xmax - xmin) * (ymax - ymin) - greatest(least(xmax, 600) - greatest(xmin, 300), 0) * greatest(least(ymax, 700) - greatest(ymin, 200), 0), 6) AS outside FROM bx")
def overlay_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of each box lies outside one area."""
    hole = geometry.box(F.lit(300), F.lit(200), F.lit(600), F.lit(700))
    return _polygons(spark, sf_dir).select("gid", F.round(geometry.area(geometry.difference("geometry", hole)), 6).alias("outside"))


@query(f"WITH {BX}, s AS (SELECT gid, xmin AS ax, xmax AS bx, unnest([ymin, ymax]) AS y, 0 AS up FROM bx UNION ALL SELECT gid, ymin, ymax, unnest([xmin, xmax]), 1 FROM bx) SELECT gid, round(sum(CASE WHEN up = 0 AND y BETWEEN 200 AND 700 THEN greatest(least(bx, 600) - greatest(ax, 300), 0) WHEN up = 1 AND y BETWEEN 300 AND 600 THEN greatest(least(bx, 700) - greatest(ax, 200), 0) ELSE 0 END), 6) AS inside FROM s GROUP BY gid HAVING sum(CASE WHEN up = 0 AND y BETWEEN 200 AND 700 THEN greatest(least(bx, 600) - greatest(ax, 300), 0) WHEN up = 1 AND y BETWEEN 300 AND 600 THEN greatest(least(bx, 700) - greatest(ax, 200), 0) ELSE 0 END) > 0")
def clipped_line_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The length of each outline inside a box."""
    cut = spatial.clipped_lines(spatial.line_work(_polygons(spark, sf_dir).select("gid", "geometry")), F.lit(300.0), F.lit(200.0), F.lit(600.0), F.lit(700.0))
    return cut.groupBy("gid").agg(F.round(F.sum(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))), 6).alias("inside"))


@query(f"WITH {BX}, k AS (SELECT gid // 50 AS grp, gid, xmin, ymin, xmax, ymax FROM bx), e AS (SELECT k.grp, x.x AS x0, lead(x.x) OVER (PARTITION BY k.grp ORDER BY x.x) AS x1 FROM (SELECT DISTINCT grp FROM k) k JOIN (SELECT DISTINCT grp, unnest([xmin, xmax]) AS x FROM k) x ON x.grp = k.grp), f AS (SELECT k.grp, y.y AS y0, lead(y.y) OVER (PARTITION BY k.grp ORDER BY y.y) AS y1 FROM (SELECT DISTINCT grp FROM k) k JOIN (SELECT DISTINCT grp, unnest([ymin, ymax]) AS y FROM k) y ON y.grp = k.grp) SELECT CAST(e.grp AS BIGINT) AS grp, round(sum((x1 - x0) * (y1 - y0)), 4) AS area FROM e JOIN f ON f.grp = e.grp WHERE x1 IS NOT NULL AND y1 IS NOT NULL AND EXISTS (SELECT 1 FROM k WHERE k.grp = e.grp AND k.xmin <= x0 AND k.xmax >= x1 AND k.ymin <= y0 AND k.ymax >= y1) GROUP BY e.grp")
def dissolved_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The union of each group of boxes, against the sum of the cells of the grid that their sides make."""
    df = _polygons(spark, sf_dir).withColumn("grp", F.floor(F.col("gid") / 50))
    return spatial.dissolved(df, ["grp"], fan=4).select("grp", F.round(geometry.area(F.col("geometry")), 4).alias("area"))


@query(f"WITH {BX} SELECT gid, round((xmin + xmax) / 2, 6) AS x, round((ymin + ymax) / 2, 6) AS y FROM bx")
def inner_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point inside each outline, rebuilt from exploded parts."""
    parts = _polygons(spark, sf_dir).select("gid", F.explode("geometry").alias("part")).select("gid", F.array("part").alias("geometry"))
    return parts.withColumn("p", geometry.inner_point("geometry")).select("gid", F.round("p.x", 6).alias("x"), F.round("p.y", 6).alias("y"))


@query(f"WITH {PT}, c AS (SELECT CAST(n_nationkey AS VARCHAR) AS zone, n_nationkey * CAST(40 AS DOUBLE) AS cx, (n_nationkey * 170) % 1000 + CAST(0.5 AS DOUBLE) AS cy FROM nation) SELECT zone, count(*) AS n FROM c JOIN pt ON (x - 0.25 + 0.5 - cx) * (x - 0.25 + 0.5 - cx) + (y - 0.25 + 0.5 - cy) * (y - 0.25 + 0.5 - cy) <= 900 GROUP BY zone")
def points_in_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells within a radius of known points."""
    px = _points(spark, sf_dir).select((F.col("x") - 0.25).cast("int").alias("col"), (F.col("y") - 0.25).cast("int").alias("row"), F.lit(2020).alias("year"), F.lit(1.0).alias("v"))
    points = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("zone"), (F.col("n_nationkey") * 40.0).alias("x"), (F.pmod(F.col("n_nationkey") * 170, F.lit(1000)) + 0.5).alias("y"))
    masks = _polygons(spark, sf_dir).filter("false").select(F.col("gid").cast("string").alias("zone"), "geometry")
    return stages.compared_with_cases(px, masks, points, ["v"], 30.0).select("zone", "n")


@query(f"WITH {BX} SELECT CAST(gid % 6 AS BIGINT) AS layer, count(*) AS features, CAST(sum((gid % 10 = 0)::INT) AS BIGINT) AS empty, round(min(xmin) FILTER (gid % 10 <> 0), 6) AS xmin, round(max(ymax) FILTER (gid % 10 <> 0), 6) AS ymax FROM bx GROUP BY 1")
def vector_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features, empty ones and bounds of layers."""
    df = _polygons(spark, sf_dir).drop(*BOX).withColumns({"layer": F.col("gid") % 6, "geometry": F.when(F.col("gid") % 10 != 0, F.col("geometry"))})
    return audit.vector_inventory(df, "layer").select("layer", "features", "empty", F.round("xmin", 6).alias("xmin"), F.round("ymax", 6).alias("ymax"))


@query("SELECT p_size::BIGINT AS grp, count(*) - count(DISTINCT p_partkey % 5) AS duplicates FROM part GROUP BY 1")
def duplicate_outlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometries that come twice in a layer, by their digests."""
    x = F.col("p_partkey") % 5
    df = table(spark, sf_dir, "part").select(F.col("p_size").cast("long").alias("grp"), geometry.box(x, x, x + 1, x + 1).alias("geometry"))
    return audit.vector_inventory(df, "grp").select("grp", "duplicates")


@query(f"WITH {BX}, z AS (SELECT CAST(n_nationkey AS BIGINT) AS rid, n_nationkey % 5 * CAST(200 AS DOUBLE) + 3 AS x0, n_nationkey // 5 * CAST(200 AS DOUBLE) AS y0 FROM nation), p AS (SELECT gid, rid, greatest(least(xmax, x0 + 147) - greatest(xmin, x0), 0) * greatest(least(ymax, y0 + 180) - greatest(ymin, y0), 0) AS a FROM bx, z) SELECT row_number() OVER (ORDER BY gid, rid) AS parcel_id, gid AS source, rid AS area, round(a, 6) AS size FROM p WHERE a > 0")
def clipped_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels cut to areas of interest and numbered."""
    zones = _zones(spark, sf_dir).select(F.col("rid").alias("gid"), geometry.box(*[F.col(c) for c in BOX]).alias("geometry"))
    cut = spatial.clipped_to(_polygons(spark, sf_dir).select(F.col("gid").alias("parcel_id"), "geometry"), zones, 100.0)
    rows = cut.select(F.col("parcel_id").alias("source"), F.col("gid").alias("area"), F.round(geometry.area(F.col("geometry")), 6).alias("size"))
    return spatial.numbered(rows, ["source", "area"])


@query(f"WITH {BX}, z AS (SELECT CAST(n_nationkey AS BIGINT) AS rid, n_nationkey % 5 * CAST(200 AS DOUBLE) + 3 AS x0, n_nationkey // 5 * CAST(200 AS DOUBLE) AS y0 FROM nation), c AS (SELECT gid, CAST(rid AS VARCHAR) AS area FROM bx JOIN z ON (xmin + xmax) / 2 >= x0 AND (xmin + xmax) / 2 < x0 + 147 AND (ymin + ymax) / 2 >= y0 AND (ymin + ymax) / 2 < y0 + 180), t AS (SELECT gid, min(CAST(rid AS VARCHAR)) AS area FROM bx JOIN z ON xmin < x0 + 147 AND x0 < xmax AND ymin < y0 + 180 AND y0 < ymax GROUP BY gid) SELECT bx.gid AS parcel_id, coalesce(c.area, t.area) AS area FROM bx LEFT JOIN c ON c.gid = bx.gid LEFT JOIN t ON t.gid = bx.gid")
def areas_of_parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Areas of parcels by a point inside, else by overlap."""
    zones = _zones(spark, sf_dir).select(F.col("rid").cast("string").alias("area"), geometry.box(*[F.col(c) for c in BOX]).alias("geometry"))
    return spatial.areas_of_parcels(_polygons(spark, sf_dir).select(F.col("gid").alias("parcel_id"), "geometry"), zones, 100.0).select("parcel_id", "area")


# ---------------------------------------------------------------- whole tables by stage


@query(f"WITH {SC} SELECT 'rows' AS what, CAST(count(*) AS DOUBLE) AS value FROM sc WHERE weak_target IN (0, 1) UNION ALL SELECT 'columns', 3.0 UNION ALL SELECT 'finite', CAST(count(*) AS DOUBLE) FROM sc WHERE pred_boost IS NOT NULL")
def row_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows, columns by availability, and rows with a finite value."""
    df = scored(spark, sf_dir)
    kept = nulls.only(df, ["parcel_id", "absent", "weak_target", "pred_boost", "parcel_id"])
    nan = df.withColumn("pred_boost", F.coalesce("pred_boost", F.lit(float("nan"))))
    one = lambda what, n: n.select(F.lit(what).alias("what"), F.col("n").cast("double").alias("value"))
    count = lambda d: d.agg(F.count("*").alias("n"))
    return features.union_all([one("rows", count(kept.filter("weak_target in (0, 1)"))), one("columns", spark.range(1).select(F.lit(len(kept.columns)).alias("n"))), one("finite", count(nulls.all_finite(nan).filter("pred_boost is not null")))])


@query("SELECT 'ndvi_mean' AS feature, count(*) AS n, round(sum(l_quantity), 2) AS total FROM lineitem UNION ALL SELECT 'change_share', count(*), round(sum(l_discount), 2) FROM lineitem UNION ALL SELECT 'area_m2', count(*), round(sum(l_tax), 2) FROM lineitem")
def canonical_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns under other names, found by their patterns."""
    df = table(spark, sf_dir, "lineitem").select(F.col("l_quantity").cast("double").alias(" NDVI  avg"), F.col("l_discount").cast("double").alias("change share"), F.col("l_tax").cast("double").alias("Shape_Area"))
    got, known = text.with_canonical_names(df)
    parts = [got.agg(F.count("*").alias("n"), F.round(F.sum(c), 2).alias("total")).select(F.lit(c).alias("feature"), "n", "total") for c in ("ndvi_mean", "change_share", "area_m2") if c in known]
    return features.union_all(parts)


@query(f"WITH {SC}, m AS (SELECT 'pred_logit' AS model, pred_logit AS p, weak_target AS y FROM sc UNION ALL SELECT 'pred_boost', pred_boost, weak_target FROM sc UNION ALL SELECT 'pred_baseline_risk', pred_baseline_risk, weak_target FROM sc) SELECT model, count(*) AS n, round(avg((least(greatest(p, 1e-6), 1 - 1e-6) - y) * (least(greatest(p, 1e-6), 1 - 1e-6) - y)), 9) AS brier FROM m WHERE p IS NOT NULL AND y IS NOT NULL GROUP BY 1")
def validation_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.validated(scored(spark, sf_dir))["internal"].select("model", "n", F.round("brier", 9).alias("brier"))


@query(f"WITH {SC} SELECT parcel_id, round(pred_logit, 9) AS pred_ml_final, round(pred_baseline_risk, 9) AS pred_baseline_risk, abs(pred_logit - pred_baseline_risk) >= 0.15 AND (rank() OVER (PARTITION BY area, year ORDER BY pred_logit) + (count(*) OVER (PARTITION BY area, year, pred_logit) - 1) / 2.0 >= 0.9 * count(*) OVER (PARTITION BY area, year) OR rank() OVER (PARTITION BY area, year ORDER BY pred_baseline_risk) + (count(*) OVER (PARTITION BY area, year, pred_baseline_risk) - 1) / 2.0 >= 0.9 * count(*) OVER (PARTITION BY area, year)) AS ml_attention_flag FROM sc")
def export_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stages.exported(scored(spark, sf_dir).withColumn("pred_ml_final", F.col("pred_logit")))
    return out.select("parcel_id", F.round("pred_ml_final", 9).alias("pred_ml_final"), F.round("pred_baseline_risk", 9).alias("pred_baseline_risk"), "ml_attention_flag")


@query(f"WITH {PY}, t AS (SELECT area, parcel_id, year, CASE WHEN lag(change_share) OVER w IS NULL THEN change_share ELSE (lag(change_share) OVER w + change_share) / 2 END AS roll FROM py WINDOW w AS (PARTITION BY area, parcel_id ORDER BY year)) SELECT area, count(*) AS n, count(DISTINCT parcel_id) AS parcels, round(sum(roll), 4) AS roll FROM t GROUP BY area")
def parcel_year_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, report = stages.parcel_year_table(parcel_years(spark, sf_dir))
    return out.groupBy("area").agg(F.count("*").alias("n"), F.count_distinct("parcel_id").alias("parcels"), F.round(F.sum("roll2__change_share"), 4).alias("roll"))


@query("SELECT c_mktsegment AS area, CAST(c_custkey AS VARCHAR) AS parcel_id, true AS saved FROM customer WHERE c_custkey % 2 = 0")
def saved_reduction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reduces columns, saved and loaded, gives the same components."""
    df = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_mktsegment").alias("area"), F.col("c_custkey").cast("string").alias("parcel_id"), F.col("c_acctbal").cast("double").alias("a"), (F.col("c_nationkey") * 1.5).alias("b"), F.when(F.col("c_custkey") % 7 != 0, F.length("c_name").cast("double")).alias("c"))
    path = new_dir(spark, "model")
    once = models.reduced(df, ["a", "b", "c"], 2, path).select("parcel_id", "area", "features")
    again = models.loaded(path).transform(df).select("parcel_id", F.col("features").alias("other"))
    return once.join(again, "parcel_id").select("area", "parcel_id", (F.col("features") == F.col("other")).alias("saved"))
