"""Spatial queries: boxes from parts, points from customers, pixels from embeddings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import geometry, spatial
from .tables import PX, pixels, table

QUERIES, ORACLES = {}, {}
BOX = ["xmin", "ymin", "xmax", "ymax"]


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def _boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box for each part with a key divisible by 5 (that is the layer, not a sample of one)."""
    p = table(spark, sf_dir, "part").filter("p_partkey % 5 = 0")
    x, y = F.pmod(F.col("p_partkey") * 37, F.lit(1000)).cast("double"), F.pmod(F.col("p_partkey") * 91, F.lit(1000)).cast("double")
    return p.select(F.col("p_partkey").alias("gid"), x.alias("xmin"), y.alias("ymin"), (x + F.col("p_size")).alias("xmax"), (y + F.col("p_size") * 0.5).alias("ymax"))


BX = "bx AS (SELECT p_partkey AS gid, CAST((p_partkey * 37) % 1000 AS DOUBLE) AS xmin, CAST((p_partkey * 91) % 1000 AS DOUBLE) AS ymin, (p_partkey * 37) % 1000 + CAST(p_size AS DOUBLE) AS xmax, (p_partkey * 91) % 1000 + p_size * CAST(0.5 AS DOUBLE) AS ymax FROM part WHERE p_partkey % 5 = 0)"


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("pid"), (F.pmod(F.col("c_custkey") * 53, F.lit(1000)) + 0.25).alias("x"), (F.pmod(F.col("c_custkey") * 17, F.lit(1000)) + 0.25).alias("y"))


PT = "pt AS (SELECT c_custkey AS pid, (c_custkey * 53) % 1000 + CAST(0.25 AS DOUBLE) AS x, (c_custkey * 17) % 1000 + CAST(0.25 AS DOUBLE) AS y FROM customer)"


def _polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _boxes(spark, sf_dir).withColumn("geometry", geometry.box(*[F.col(c) for c in BOX]))


@query(f"WITH {BX}, {PT} SELECT pid, gid FROM pt JOIN bx ON x >= xmin AND x < xmax AND y >= ymin AND y < ymax")
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.alike_points_in_polygons(_points(spark, sf_dir), _polygons(spark, sf_dir), 50.0)


@query(f"WITH {BX}, {PT} SELECT pid, EXISTS (SELECT 1 FROM bx WHERE x >= xmin AND x < xmax AND y >= ymin AND y < ymax) AS literature_mask_hit FROM pt")
def literature_hit(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = spatial.points_in_polygons(_points(spark, sf_dir), _polygons(spark, sf_dir), 50.0)
    return spatial.with_hit(_points(spark, sf_dir), ["pid"], hits, "literature_mask_hit").select("pid", "literature_mask_hit")


OV = f"""{BX}, z AS (SELECT CAST(n_nationkey AS BIGINT) AS rid, n_nationkey % 5 * CAST(200 AS DOUBLE) + 3 AS zx0, n_nationkey // 5 * CAST(200 AS DOUBLE) AS zy0, n_nationkey % 5 * CAST(200 AS DOUBLE) + 150 AS zx1, n_nationkey // 5 * CAST(200 AS DOUBLE) + 180 AS zy1 FROM nation),
pr AS (SELECT gid AS lid, rid, greatest(least(xmax, zx1) - greatest(xmin, zx0), 0) * greatest(least(ymax, zy1) - greatest(ymin, zy0), 0) AS overlap FROM bx JOIN z ON xmin <= zx1 AND zx0 <= xmax AND ymin <= zy1 AND zy0 <= ymax),
best AS (SELECT lid, rid, overlap FROM pr QUALIFY row_number() OVER (PARTITION BY lid ORDER BY overlap DESC, rid) = 1),
asg AS (SELECT gid AS lid, rid, coalesce(overlap, 0.0) AS overlap FROM bx LEFT JOIN best ON lid = gid)"""


def _zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    x, y = F.pmod("n_nationkey", F.lit(5)) * 200.0, F.floor(F.col("n_nationkey") / 5) * 200.0
    return n.select(F.col("n_nationkey").cast("long").alias("rid"), (x + 3).alias("xmin"), y.alias("ymin"), (x + 150).alias("xmax"), (y + 180).alias("ymax"))


def _assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.most_overlapped(_boxes(spark, sf_dir).withColumnRenamed("gid", "lid"), _zones(spark, sf_dir), 100.0)


@query(f"WITH {OV} SELECT lid, rid, round(overlap, 9) AS overlap FROM asg")
def max_overlap_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _assigned(spark, sf_dir).select("lid", "rid", F.round("overlap", 9).alias("overlap"))


@query(f"WITH {OV} SELECT rid, count(DISTINCT lid) AS scenes, round(sum((xmax - xmin) * (ymax - ymin)), 6) AS footprint, round(sum(overlap), 6) AS overlap FROM asg JOIN bx ON gid = lid GROUP BY rid")
def zone_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    boxes = _boxes(spark, sf_dir).select(F.col("gid").alias("lid"), geometry.box_area({c: F.col(c) for c in BOX}).alias("size"))
    return _assigned(spark, sf_dir).join(boxes, "lid").groupBy("rid").agg(F.count_distinct("lid").alias("scenes"), F.round(F.sum("size"), 6).alias("footprint"), F.round(F.sum("overlap"), 6).alias("overlap"))


@query(f"WITH {BX} SELECT gid, round(greatest(least(xmax, 700) - greatest(xmin, 100), 0) * greatest(least(ymax, 700) - greatest(ymin, 100), 0) / ((xmax - xmin) * (ymax - ymin)), 9) AS fraction FROM bx")
def box_overlap_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, aoi = {c: F.col(c) for c in BOX}, dict(zip(BOX, (F.lit(100.0), F.lit(100.0), F.lit(700.0), F.lit(700.0)), strict=True))
    return _boxes(spark, sf_dir).select("gid", F.round(F.try_divide(geometry.box_overlap(own, aoi), geometry.box_area(own)), 9).alias("fraction"))


@query(f"WITH {BX} SELECT round(min(xmin), 9) AS xmin, round(min(ymin), 9) AS ymin, round(max(xmax), 9) AS xmax, round(max(ymax), 9) AS ymax FROM bx")
def bounds_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.with_bounds(_polygons(spark, sf_dir).drop(*BOX)).agg(*[(F.min if c.endswith("min") else F.max)(c).alias(c) for c in BOX])


@query(f"WITH {BX} SELECT gid, round((xmax - xmin) * (ymax - ymin), 6) AS area, round((xmin + xmax) / 2, 6) AS cx, round((ymin + ymax) / 2, 6) AS cy FROM bx")
def wkt_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Geometry written as text, parsed, measured."""
    at = lambda x, y: F.concat_ws(" ", F.col(x).cast("string"), F.col(y).cast("string"))
    ring = F.concat_ws(", ", at("xmin", "ymin"), at("xmax", "ymin"), at("xmax", "ymax"), at("xmin", "ymax"), at("xmin", "ymin"))
    df = _boxes(spark, sf_dir).withColumn("g", geometry.from_wkt(F.concat(F.lit("POLYGON (("), ring, F.lit("))"))))
    c = geometry.centroid(F.col("g"))
    return df.select("gid", F.round(geometry.area(F.col("g")), 6).alias("area"), F.round(c["x"], 6).alias("cx"), F.round(c["y"], 6).alias("cy"))


@query(f"WITH {PT} SELECT pid, round(radians(x / 10) * 6378137.0, 3) AS mx, round(ln(tan(pi() / 4 + radians(y / 20) / 2)) * 6378137.0, 3) AS my FROM pt")
def mercator(spark: SparkSession, sf_dir: str) -> DataFrame:
    x, y = geometry.to_mercator(F.col("x") / 10, F.col("y") / 20)
    return _points(spark, sf_dir).select("pid", F.round(x, 3).alias("mx"), F.round(y, 3).alias("my"))


@query(f"WITH {BX} SELECT a.gid AS lid, b.gid AS rid, round((least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * (least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)), 6) AS area FROM bx a JOIN bx b ON a.gid < b.gid AND a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax")
def overlay_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlines that are alike are cut once; all pairs of their parts are returned."""
    outlines, members = spatial.in_classes(_polygons(spark, sf_dir), "gid", ["geometry"])
    g = spatial.with_bounds(outlines.select("class", "geometry"))
    pairs = spatial.box_pairs(g.select(F.col("class").alias("lid"), F.col("geometry").alias("lg"), *BOX), g.select(F.col("class").alias("rid"), F.col("geometry").alias("rg"), *BOX), 50.0).filter("lid <= rid")
    cut = pairs.withColumn("shared", geometry.intersection("lg", "rg")).filter(F.size("shared") > 0)
    areas = cut.select(F.col("lid").alias("lc"), F.col("rid").alias("rc"), F.round(geometry.area(F.col("shared")), 6).alias("area"))
    # Within a class each pair comes in both orders.
    return spatial.expanded(areas, members, members).filter("lid < rid or (lc <> rc and lid > rid)").select(F.least("lid", "rid").alias("lid"), F.greatest("lid", "rid").alias("rid"), "area")


@query(f"""WITH RECURSIVE {BX}, ed AS (SELECT a.gid AS a, b.gid AS b FROM bx a JOIN bx b ON a.gid <> b.gid AND a.xmin < b.xmax AND b.xmin < a.xmax AND a.ymin < b.ymax AND b.ymin < a.ymax),
reach AS (SELECT gid AS node, gid AS hop FROM bx UNION SELECT node, ed.b FROM reach JOIN ed ON ed.a = reach.hop), lab AS (SELECT node, min(hop) AS root FROM reach GROUP BY node)
SELECT node AS fid, concat('ZONE_', lpad(CAST(dense_rank() OVER (ORDER BY root) AS VARCHAR), CAST(greatest(3, length(CAST(dense_rank() OVER (ORDER BY root) AS VARCHAR))) AS INT), '0')) AS zone_id FROM lab""")
def scene_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.zones_of(_polygons(spark, sf_dir).select(F.col("gid").alias("fid"), "geometry"), 50.0)


def _zone_boxes(spark: SparkSession) -> DataFrame:
    k = F.col("id")
    return spark.range(40).select(k.alias("zone"), (F.pmod(k * 3, F.lit(11))).cast("double").alias("xmin"), (k * 12).cast("double").alias("ymin"), (F.pmod(k * 3, F.lit(11)) + 4.0).alias("xmax"), (k * 12 + 20.5).alias("ymax"))


ZB = "zb AS (SELECT CAST(k AS BIGINT) AS zone, CAST((k * 3) % 11 AS DOUBLE) AS xmin, CAST(k * 12 AS DOUBLE) AS ymin, (k * 3) % 11 + CAST(4 AS DOUBLE) AS xmax, k * 12 + CAST(20.5 AS DOUBLE) AS ymax FROM (SELECT unnest(range(40)) AS k))"
ZJ = f'{PX}, {ZB}, zj AS (SELECT zone, nir, red, "row", col FROM px JOIN zb ON col + 0.5 >= xmin AND col + 0.5 < xmax AND "row" + 0.5 >= ymin AND "row" + 0.5 < ymax)'


@query(f"""WITH {ZJ}, a AS (SELECT zone, count(*) AS n_px, avg(nir) AS m, stddev_pop(nir) AS s, min(nir) AS lo, max(nir) AS hi, quantile_cont(nir, 0.9) AS p90, quantile_cont(nir, 0.95) AS p95, avg(coalesce(nir > 0, false)::INT) AS sh FROM zj GROUP BY 1)
SELECT zb.zone, coalesce(n_px, 0) AS n_px, round(m, 9) AS nir_mean, round(s, 9) AS nir_std, round(lo, 9) AS nir_min, round(hi, 9) AS nir_max, round(p90, 9) AS nir_p90, round(p95, 9) AS nir_p95, round(sh, 9) AS wet_share FROM zb LEFT JOIN a ON a.zone = zb.zone""")
def zonal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = pixels(spark, sf_dir).withColumn("wet", F.coalesce(F.col("nir") > 0, F.lit(False)).cast("int"))
    zones = _zone_boxes(spark)
    df = spatial.zonal_table(spatial.pixels_in_boxes(px, zones), zones, ["nir"], ["wet"])
    return df.select("zone", "n_px", *[F.round(c, 9).alias(c) for c in ("nir_mean", "nir_std", "nir_min", "nir_max", "nir_p90", "nir_p95", "wet_share")])


@query(f"WITH {ZJ} SELECT zone, count(nir) AS n, round(avg(nir), 9) AS mean, round(median(nir), 9) AS median, round(quantile_cont(nir, 0.9), 9) AS p90, round(max(nir), 9) AS max FROM zj GROUP BY 1")
def zonal_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    j = spatial.pixels_in_boxes(pixels(spark, sf_dir), _zone_boxes(spark))
    plain = j.groupBy("zone").agg(F.count("nir").alias("n"), F.round(F.avg("nir"), 9).alias("mean"), F.round(F.max("nir"), 9).alias("max"))
    places = stats.quantiles(j, ["zone"], {"median": (F.col("nir"), 0.5), "p90": (F.col("nir"), 0.9)})
    return plain.join(places, "zone", "left").select("zone", "n", "mean", F.round("median", 9).alias("median"), F.round("p90", 9).alias("p90"), "max")


@query(f'WITH {ZJ}, b AS (SELECT "row", col, max(zone) AS z FROM zj GROUP BY 1, 2) SELECT CAST(px."row" AS BIGINT) AS "row", CAST(px.col AS BIGINT) AS col, coalesce(CAST(z AS DOUBLE) * 1.5, -9999.0) AS burned FROM px LEFT JOIN b ON b."row" = px."row" AND b.col = px.col')
def burn_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = _zone_boxes(spark).select("zone", geometry.box(*[F.col(c) for c in BOX]).alias("geometry"), F.col("zone").alias("ord"), (F.col("zone").cast("double") * 1.5).alias("value"))
    return spatial.burned(pixels(spark, sf_dir).select("row", "col"), shapes).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], "burned")


@query("SELECT s_suppkey, row_number() OVER (ORDER BY s_name, s_suppkey) AS parcel_id FROM supplier")
def sequential_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.numbered(table(spark, sf_dir, "supplier").select("s_name", "s_suppkey"), ["s_name", "s_suppkey"]).select("s_suppkey", "parcel_id")


def parcel_areas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parcels assigned to AOIs by an inner point, then by overlap; held against plain code in the tests."""
    zones = _zones(spark, sf_dir).select(F.col("rid").cast("string").alias("area"), geometry.box(*[F.col(c) for c in BOX]).alias("geometry"))
    parcels = _polygons(spark, sf_dir).select(F.col("gid").alias("parcel_id"), "geometry")
    return spatial.areas_of_parcels(parcels, zones, 100.0).select("parcel_id", "area")


QUERIES["parcel_areas"] = parcel_areas
