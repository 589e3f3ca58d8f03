"""Queries on names and texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import nulls, text
from ..operators import scenes
from ..sources import files
from .tables import table

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


SCENE = "concat('KANOPUS_', CASE WHEN o_orderkey % 17 = 0 THEN '20231340' ELSE strftime(o_orderdate, '%Y%m%d') END, '_', lpad(CAST(o_orderkey % 240000 AS VARCHAR), 6, '0'), '_', CAST(o_orderkey % 10 AS VARCHAR), '.L', CAST(o_orderkey % 3 AS VARCHAR), '.', CASE o_orderkey % 5 WHEN 0 THEN 'PAN' WHEN 1 THEN 'pms' WHEN 2 THEN 'XX' ELSE 'MS' END, '.SCN01')"


def _scene_name():
    key = F.col("o_orderkey")
    day = F.when(key % 17 == 0, "20231340").otherwise(F.date_format("o_orderdate", "yyyyMMdd"))
    product = F.when(key % 5 == 0, "PAN").when(key % 5 == 1, "pms").when(key % 5 == 2, "XX").otherwise("MS")
    return F.concat(F.lit("KANOPUS_"), day, F.lit("_"), F.lpad((key % 240000).cast("string"), 6, "0"), F.lit("_"), (key % 10).cast("string"), F.lit(".L"), (key % 3).cast("string"), F.lit("."), product, F.lit(".SCN01"))


@query(f"""WITH s AS (SELECT o_orderkey, {SCENE} AS name FROM orders), m AS (SELECT *, regexp_matches(name, '(?i)KANOPUS_(\\d{{8}})_(\\d{{6}})_\\d+\\.(L\\d)\\.(MS|PMS|PAN)\\.SCN01') AS ok, regexp_extract(name, '(?i)KANOPUS_(\\d{{8}})_(\\d{{6}})_\\d+\\.(L\\d)\\.(MS|PMS|PAN)\\.SCN01', ['d', 't', 'l', 'p']) AS g FROM s),
d AS (SELECT *, try_strptime(g.d, '%Y%m%d') AS day FROM m)
SELECT o_orderkey, CASE WHEN ok AND day IS NOT NULL THEN strftime(day, '%Y-%m-%d') END AS date, CASE WHEN ok AND day IS NOT NULL THEN g.t END AS time, CASE WHEN ok AND day IS NOT NULL THEN upper(g.l) END AS level, CASE WHEN ok AND day IS NOT NULL THEN upper(g.p) END AS product FROM d""")
def scene_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "orders").select("o_orderkey", _scene_name().alias("name"))
    parts = text.scene_parts(F.col("name"))
    return df.select("o_orderkey", parts["date"].cast("string").alias("date"), *[parts[k].alias(k) for k in ("time", "level", "product")])


RASTER = "concat('site', CAST(l_orderkey % 3 AS VARCHAR), '_', CAST(year(l_shipdate) AS VARCHAR), CASE l_linenumber % 6 WHEN 0 THEN concat('_', CAST(year(l_shipdate) + 1 AS VARCHAR), '_delta_ndvi') WHEN 1 THEN '_early_ndvi' WHEN 2 THEN '_annual_x_ms_composite' WHEN 3 THEN '_late_glcm_entropy_w5' WHEN 4 THEN '' ELSE '_risk_score' END, '.tif')"


@query(f"""WITH n AS (SELECT DISTINCT {RASTER} AS name FROM lineitem), s AS (SELECT name, regexp_replace(name, '\\.tif$', '') AS stem FROM n),
p AS (SELECT *, regexp_matches(stem, '^[^_]+_\\d{{4}}_\\d{{4}}_.+$') AS pair, regexp_matches(stem, '^[^_]+_\\d{{4}}_.+$') AS single FROM s),
e AS (SELECT *, CASE WHEN single THEN regexp_extract(stem, '^([^_]+)_(\\d{{4}})_(.+)$', 3) END AS rest FROM p)
SELECT name, CASE WHEN single THEN regexp_extract(stem, '^([^_]+)_', 1) END AS site, CASE WHEN single THEN CAST(regexp_extract(stem, '^[^_]+_(\\d{{4}})', 1) AS BIGINT) END AS year, CASE WHEN pair THEN CAST(regexp_extract(stem, '^[^_]+_\\d{{4}}_(\\d{{4}})', 1) AS BIGINT) END AS year2,
  CASE WHEN NOT pair THEN nullif(regexp_extract(rest, '^(annual|early|mid|late)_', 1), '') END AS season,
  CASE WHEN pair THEN regexp_extract(stem, '^[^_]+_\\d{{4}}_\\d{{4}}_(.+)$', 1) WHEN rest LIKE '%\\_ms\\_composite' ESCAPE '\\' THEN 'ms_composite' ELSE regexp_replace(rest, '^(annual|early|mid|late)_', '') END AS feature FROM e""")
def raster_name_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.year("l_shipdate")
    at = F.col("l_linenumber") % 6
    tail = F.when(at == 0, F.concat(F.lit("_"), (y + 1).cast("string"), F.lit("_delta_ndvi"))).when(at == 1, "_early_ndvi").when(at == 2, "_annual_x_ms_composite").when(at == 3, "_late_glcm_entropy_w5").when(at == 4, "").otherwise("_risk_score")
    names = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("site"), (F.col("l_orderkey") % 3).cast("string"), F.lit("_"), y.cast("string"), tail, F.lit(".tif")).alias("name")).distinct()
    parts = text.raster_name_parts(F.col("name"))
    return names.select("name", *[(parts[k].cast("long") if k.startswith("year") else parts[k]).alias(k) for k in ("site", "year", "year2", "season", "feature")])


AREA = "CASE c_custkey % 8 WHEN 0 THEN ' АМГА ' WHEN 1 THEN 'юнкюр' WHEN 2 THEN 'Yunkor' WHEN 3 THEN '  ' WHEN 4 THEN 'Some Place-' || c_nationkey WHEN 5 THEN 'amga' WHEN 6 THEN NULL ELSE '!!' END"


def _area():
    key = F.col("c_custkey") % 8
    return F.when(key == 0, " АМГА ").when(key == 1, "юнкюр").when(key == 2, "Yunkor").when(key == 3, "  ").when(key == 4, F.concat(F.lit("Some Place-"), F.col("c_nationkey").cast("string"))).when(key == 5, "amga").when(key == 6, F.lit(None).cast("string")).otherwise("!!")


CANON = "CASE lower(trim(a)) WHEN 'амга' THEN 'Амга' WHEN 'amga' THEN 'Амга' WHEN 'юнкор' THEN 'Юнкор' WHEN 'yunkor' THEN 'Юнкор' WHEN 'юнкюр' THEN 'Юнкор' WHEN 'yunkyur' THEN 'Юнкор' ELSE nullif(trim(a), '') END"


@query(f"""WITH a AS (SELECT c_custkey, {AREA} AS a FROM customer), c AS (SELECT *, {CANON} AS canon FROM a)
SELECT c_custkey, canon, CASE coalesce(canon, a) WHEN 'Амга' THEN 'amga' WHEN 'Юнкор' THEN 'yunkor' WHEN 'Юнкюр' THEN 'yunkyur' ELSE coalesce(nullif(lower(trim(regexp_replace(coalesce(canon, a), '[^A-Za-z0-9]+', '_', 'g'), '_')), ''), 'area') END AS slug FROM c""")
def area_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", _area().alias("a"))
    return df.select("c_custkey", text.canonical_area(F.col("a")).alias("canon"), text.area_slug(F.col("a")).alias("slug"))


@query("""SELECT event_id, coalesce(lower(trim(f)) IN ('1', 'true', 'yes', 'да', 'y'), false) AS flag, try_cast(v AS DOUBLE) AS number FROM (SELECT event_id,
  CASE event_id % 7 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'да' WHEN 2 THEN 'no' WHEN 3 THEN NULL WHEN 4 THEN '1' WHEN 5 THEN 'Y' ELSE '' END AS f, CASE event_id % 4 WHEN 0 THEN 'abc' WHEN 1 THEN CAST(event_id AS VARCHAR) WHEN 2 THEN concat(CAST(event_id AS VARCHAR), '.5') ELSE NULL END AS v FROM events)""")
def flags_and_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("event_id")
    f = F.when(k % 7 == 0, " TRUE ").when(k % 7 == 1, "да").when(k % 7 == 2, "no").when(k % 7 == 4, "1").when(k % 7 == 5, "Y").when(k % 7 == 6, "")
    v = F.when(k % 4 == 0, "abc").when(k % 4 == 1, k.cast("string")).when(k % 4 == 2, F.concat(k.cast("string"), F.lit(".5")))
    return table(spark, sf_dir, "events").select("event_id", text.flag(f).alias("flag"), nulls.number(v).alias("number"))


@query("""SELECT o_orderkey, CASE WHEN month(o_orderdate) * 100 + day(o_orderdate) BETWEEN 501 AND 615 THEN 'early' WHEN month(o_orderdate) * 100 + day(o_orderdate) BETWEEN 616 AND 731 THEN 'mid' WHEN month(o_orderdate) * 100 + day(o_orderdate) BETWEEN 801 AND 930 THEN 'late' END AS season, CAST(year(o_orderdate) AS BIGINT) AS year, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders""")
def season_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", text.season_of(F.col("o_orderdate")).alias("season"), F.year("o_orderdate").cast("long").alias("year"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


@query("""SELECT p_partkey, CAST(CASE p_partkey % 4 WHEN 0 THEN 0 WHEN 1 THEN 10 WHEN 2 THEN 20 ELSE 50 END + CASE p_size % 3 WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE 5 END AS BIGINT) AS score FROM part""")
def priority_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.when(F.col("p_partkey") % 4 == 0, "ms").when(F.col("p_partkey") % 4 == 1, "PMS").when(F.col("p_partkey") % 4 == 2, "PAN").otherwise("RGB")
    level = F.when(F.col("p_size") % 3 == 0, "L2").when(F.col("p_size") % 3 == 1, "L1").otherwise("L9")
    return table(spark, sf_dir, "part").select("p_partkey", text.scene_score(product, level).cast("long").alias("score"))


@query("SELECT doc_id, coalesce(regexp_matches(text, '(?i)released|licensed') AND NOT regexp_matches(text, '(?i)apache|general'), false) AS core FROM documents")
def text_core_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The include-and-not-exclude rule on prose; land-use patterns are the default."""
    return table(spark, sf_dir, "documents").select("doc_id", text.usage_core(F.col("text"), r"(?iU)released|licensed", r"(?iU)apache|general").alias("core"))


@query("SELECT doc_id, coalesce(regexp_matches(t, '\\bthe\\b') AND NOT (regexp_matches(t, '\\blicense\\b') AND NOT regexp_matches(t, 'mit license\\.')), false) AS strict FROM (SELECT doc_id, regexp_replace(lower(text), '\\s+', ' ', 'g') AS t FROM documents)")
def text_strict_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keep-and-not-drop with a look-ahead in what drops."""
    flat = F.regexp_replace(F.lower("text"), r"\s+", " ")
    strict = flat.rlike(r"\bthe\b") & ~(flat.rlike(r"\blicense\b") & ~flat.rlike(r"^(?=.*mit license\.)"))
    return table(spark, sf_dir, "documents").select("doc_id", F.coalesce(strict, F.lit(False)).alias("strict"))


@query("""SELECT c_custkey, CAST(try_cast(regexp_extract(c_name, '(\\d+)', 1) AS BIGINT) AS BIGINT) AS number, regexp_replace(lower(c_name), '[^a-z0-9]+', '', 'g') AS plain FROM customer WHERE try_cast(regexp_extract(c_name, '(\\d+)', 1) AS BIGINT) % 3 = 1""")
def target_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "customer").select("c_custkey", text.leading_number(F.col("c_name")).alias("number"), text.plain_name(F.col("c_name")).alias("plain"))
    return df.filter("number % 3 = 1")


@query("""WITH f AS (SELECT page_id, regexp_replace(url, '^[a-z]+://', '') AS path FROM pages) SELECT page_id, string_split(path, '/')[1] AS top, CASE WHEN page_id % 4 = 0 THEN 'raster' WHEN page_id % 4 = 1 THEN 'vector' WHEN page_id % 4 = 2 THEN 'table' ELSE 'other' END AS kind, CAST(nullif(regexp_extract(path, '(20\\d{2})', 1), '') AS BIGINT) AS year FROM f""")
def path_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.regexp_replace("url", "^[a-z]+://", "")
    ext = F.when(F.col("page_id") % 4 == 0, "x.TIF").when(F.col("page_id") % 4 == 1, "x.geojson").when(F.col("page_id") % 4 == 2, "x.csv").otherwise("x.txt")
    return table(spark, sf_dir, "pages").select("page_id", text.top_folder(path).alias("top"), text.file_kind(ext).alias("kind"), text.year_in(path).cast("long").alias("year"))


@query("""SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, round(value, 8) AS value FROM events""")
def json_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k"), F.round("value", 8).alias("value"))


def scene_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalogue from a file listing; without SQL, as the listing holds Windows paths and Cyrillic folders."""
    path = F.concat(F.lit("D:\\data\\pkg"), (F.col("o_orderkey") % 5).cast("string"), F.lit("\\"), F.when(F.col("o_orderkey") % 2 == 0, "Съемка АМГА").otherwise("юнкор 1"), F.lit("\\"), _scene_name(), F.lit("\\image.TIF"))
    files = table(spark, sf_dir, "orders").select(path.alias("FullName"), F.lit("FILE").alias("Type"))
    return scenes.catalog_from_listing(files)


QUERIES["scene_catalog"] = scene_catalog


@query("""WITH f AS (SELECT DISTINCT concat('r/', CAST(l_orderkey % 4 AS VARCHAR), CASE WHEN l_linenumber % 2 = 0 THEN concat('/', CAST(l_orderkey % 3 AS VARCHAR)) ELSE '' END) AS dir FROM lineitem WHERE l_orderkey % 4 <> 3 OR l_linenumber % 2 <> 0)
SELECT dir FROM f WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.dir LIKE concat(f.dir, '/%'))""")
def footprint_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").filter("l_orderkey % 4 <> 3 or l_linenumber % 2 <> 0")
    path = F.concat(F.lit("r/"), (F.col("l_orderkey") % 4).cast("string"), F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("/"), (F.col("l_orderkey") % 3).cast("string"))).otherwise(""), F.lit("/x.GBD.shp"))
    return scenes.shallow_dirs(rows.select(path.alias("path")).distinct())


@query("""SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN concat('KANOPUS_', CAST(o_orderkey AS VARCHAR), '.L2') WHEN 1 THEN concat('KANOPUS_x_', CAST(o_custkey AS VARCHAR)) ELSE '102_y' END AS scene_id FROM orders""")
def scene_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    source = F.when(key % 3 == 0, "root/MS").when(key % 3 == 1, F.concat(F.lit("root/KANOPUS_x_"), F.col("o_custkey").cast("string"), F.lit(".zip"))).otherwise("root/102_y.GBD")
    footprint = F.concat(F.lit("root/102_a/kanopus_0/KANOPUS_"), key.cast("string"), F.lit(".L2.MS/MS/f.GBD.shp"))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.scene_id(source, footprint).alias("scene_id"))


@query("""SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'amga' WHEN 1 THEN 'yunkor' WHEN 2 THEN 'yunkor' ELSE lower(n_name) END AS area FROM nation""")
def archive_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("n_nationkey") % 4
    name = F.when(k == 0, "Заказ_3926868_x.zip").when(k == 1, "ЮНКОР.zip").when(k == 2, "a-3927029.ZIP").otherwise(F.concat(F.col("n_name"), F.lit(".zip")))
    return table(spark, sf_dir, "nation").select("n_nationkey", text.archive_area(name).alias("area"))


@query("""SELECT concat('x/riskscore_amga_2021_', lpad(CAST(min(p_partkey) FILTER (p_partkey % 7 = 3) AS VARCHAR), 9, '0'), '.tif') AS path FROM part""")
def template_raster(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best-fitting template by name: the highest score, then the shortest path."""
    k = F.lpad(F.col("p_partkey").cast("string"), 9, "0")
    path = F.when(F.col("p_partkey") % 7 == 3, F.concat(F.lit("x/riskscore_amga_2021_"), k)).when(F.col("p_partkey") % 7 == 1, F.concat(F.lit("x/risk_2021_"), k)).otherwise(F.concat(F.lit("x/ndvi_2020_"), k))
    listed = table(spark, sf_dir, "part").select(F.concat(path, F.lit(".tif")).alias("path"))
    return files.template_raster(listed, "amga", 2021).select("path")


@query("SELECT doc_id, round(least(greatest(p, 1e-6), 1 - 1e-6), 9) AS clipped, round(ln(1 + greatest(p * 100, 0)), 9) AS logged FROM (SELECT doc_id, CAST(n_chars % 13 AS DOUBLE) / 10 - 0.1 AS p FROM documents)")
def clipped_and_logged(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.pmod("n_chars", F.lit(13)).cast("double") / 10 - 0.1
    return table(spark, sf_dir, "documents").select("doc_id", F.round(nulls.clipped_probability(p), 9).alias("clipped"), F.round(nulls.log_area(p * 100), 9).alias("logged"))
