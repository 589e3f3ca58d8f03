"""Raster queries over pixels made of embeddings: 16 columns and a row for each vector; a vector's label stands for the scene or the year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import stats
from ..operators import raster
from .tables import PX, pixels

QUERIES, ORACLES = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return keep


def r(*names: str, n: int = 9):
    """Columns rounded, as floating sums depend on their order; -0.0 becomes 0.0."""
    return [(F.round(c, n) + 0.0).alias(c) for c in names]


def s(*names: str, n: int = 9) -> str:
    return ", ".join(f"round({c}, {n}) + 0.0 AS {c}" for c in names)


def _scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight small scenes of the same 8 x 16 grid for each label."""
    return pixels(spark, sf_dir).withColumns({"year": F.col("label").cast("long"), "row": F.pmod("row", F.lit(8))})


SCN = f'{PX}, scn AS (SELECT CAST(label AS BIGINT) AS year, "row" % 8 AS "row", col, blue, green, red, nir FROM px)'
CMP = f"""{SCN}, cm AS (SELECT year, "row", col, median(blue) AS blue, median(green) AS green, median(red) AS red, median(nir) AS nir FROM scn GROUP BY 1, 2, 3),
cmp AS (SELECT year, "row", col, CASE WHEN ok THEN blue END AS blue, CASE WHEN ok THEN green END AS green, CASE WHEN ok THEN red END AS red, CASE WHEN ok THEN nir END AS nir FROM (SELECT *, blue IS NOT NULL AND green IS NOT NULL AND red IS NOT NULL AND nir IS NOT NULL AS ok FROM cm))"""


@query(f'WITH {CMP} SELECT year, CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, {s("blue", "green", "red", "nir")} FROM cmp')
def composite_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.composite(_scenes(spark, sf_dir), ["year"]).select("year", F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), *r("blue", "green", "red", "nir"))


IDX = f"""{PX}, idx AS (SELECT "row", col, label, nir, red, (nir - red) / (nir + red + 1e-6) AS ndvi, (green - nir) / (green + nir + 1e-6) AS ndwi, 1.16 * (nir - red) / (nir + red + 0.16 + 1e-6) AS osavi, nir / (red + 1e-6) AS nir_red_ratio, red / (green + 1e-6) AS red_green_ratio, (blue + green + red + nir) / 4 AS brightness FROM px)"""


@query(f'WITH {IDX} SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, {s("ndvi", "ndwi", "osavi", "nir_red_ratio", "red_green_ratio", n=4)}, {s("brightness")} FROM idx')
def spectral_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.indices(pixels(spark, sf_dir)).select(F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), *r("ndvi", "ndwi", "osavi", "nir_red_ratio", "red_green_ratio", n=4), *r("brightness"))


OTSU = f"""{PX}, v AS (SELECT label, nir AS x FROM px WHERE nir IS NOT NULL), e AS (SELECT label, min(x) AS lo, max(x) AS hi, count(*) AS n FROM v GROUP BY 1),
b AS (SELECT v.label, least(CAST(floor((x - lo) / ((hi - lo) / 256)) AS BIGINT), 255) AS bin, count(*) AS c FROM v JOIN e ON e.label = v.label GROUP BY 1, 2),
g AS (SELECT e.label, e.n, t.bin, coalesce(b.c, 0) / e.n AS p, lo + t.bin * ((hi - lo) / 256) AS edge FROM e CROSS JOIN (SELECT unnest(range(256)) AS bin) t LEFT JOIN b ON b.label = e.label AND b.bin = t.bin),
k AS (SELECT *, sum(p) OVER w AS w0, sum(p * edge) OVER w AS m0, sum(p * edge) OVER (PARTITION BY label) AS mt FROM g WINDOW w AS (PARTITION BY label ORDER BY bin)),
thr AS (SELECT label, arg_max(edge, (CASE WHEN w0 > 1e-12 AND w0 < 1 - 1e-12 THEN (mt * w0 - m0) * (mt * w0 - m0) / (w0 * (1 - w0)) ELSE 0.0 END, -bin)) AS threshold FROM k GROUP BY label)"""


@query(f"WITH {OTSU} SELECT CAST(label AS BIGINT) AS label, round(threshold, 9) AS threshold FROM thr")
def otsu_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.otsu(pixels(spark, sf_dir), "nir", ["label"]).select(F.col("label").cast("long").alias("label"), F.round("threshold", 9).alias("threshold"))


@query(f'WITH {OTSU} SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, CAST(coalesce(nir > threshold, false) AS BIGINT) AS water FROM px JOIN thr ON thr.label = px.label')
def otsu_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = raster.water_mask(pixels(spark, sf_dir).withColumn("ndwi", F.col("nir")), ["label"])
    return px.select(*[F.col(c).cast("long").alias(c) for c in ("row", "col", "water")])


def _dynamics(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = raster.composite(_scenes(spark, sf_dir), ["year"])
    px = px.withColumns({"ndvi": F.col("nir") - F.col("red"), "ndwi": F.col("green") - F.col("nir"), "area": F.lit("a")})
    px = raster.water_mask(px, ["year"], threshold=0.0)
    return raster.with_dynamics(px, ["area"])


DYN = f"""{CMP}, base AS (SELECT year, "row", col, nir - red AS ndvi, green - nir AS ndwi, coalesce(green - nir > 0, false)::INT AS water FROM cmp),
dyn AS (SELECT *, ndvi - lag(ndvi) OVER w AS delta_ndvi, ndwi - lag(ndwi) OVER w AS delta_ndwi, CAST(water - lag(water) OVER w AS DOUBLE) AS water_growth, avg(water) OVER (PARTITION BY "row", col ORDER BY year ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS water_occurrence FROM base WINDOW w AS (PARTITION BY "row", col ORDER BY year))"""


@query(f'WITH {DYN} SELECT year, CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, {s("delta_ndvi", "delta_ndwi", "water_growth", "water_occurrence")}, CAST(water_occurrence >= 0.6 AS BIGINT) AS persistence_water FROM dyn')
def year_dynamics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dynamics(spark, sf_dir).select("year", *[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r("delta_ndvi", "delta_ndwi", "water_growth", "water_occurrence"), F.col("persistence_water").cast("long").alias("persistence_water"))


CHG = f"""{DYN}, cq AS (SELECT year, quantile_cont(abs(delta_ndvi), 0.9) AS qn, quantile_cont(abs(delta_ndwi), 0.9) AS qw FROM dyn GROUP BY year),
chg AS (SELECT dyn.*, ((coalesce(abs(delta_ndvi) >= qn, false) OR coalesce(abs(delta_ndwi) >= qw, false) OR coalesce(abs(water_growth) > 0, false)) AND (qn IS NOT NULL OR qw IS NOT NULL))::INT AS change FROM dyn JOIN cq ON cq.year = dyn.year)"""


@query(f'WITH {CHG} SELECT year, CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, CAST(change AS BIGINT) AS change FROM chg')
def change_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.change_mask(_dynamics(spark, sf_dir), ["year"]).select("year", *[F.col(c).cast("long").alias(c) for c in ("row", "col", "change")])


@query(f"""WITH {PX}, q AS (SELECT label, quantile_cont(nir, 0.05) AS a, quantile_cont(nir, 0.95) AS b, min(nir) AS lo, max(nir) AS hi FROM px GROUP BY 1)
SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, round(least(greatest((nir - a) / (b - a), 0.0), 1.0), 9) + 0.0 AS unit FROM px JOIN q ON q.label = px.label WHERE nir IS NOT NULL UNION ALL SELECT CAST("row" AS BIGINT), CAST(col AS BIGINT), NULL FROM px WHERE nir IS NULL""")
def robust_minmax(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.with_robust_unit(pixels(spark, sf_dir), ["label"], {"unit": "nir"}).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r("unit"))


def _unit(c: str) -> str:
    return f"CASE WHEN {c} IS NULL THEN NULL WHEN coalesce(b_{c} - a_{c} > 1e-12, false) THEN least(greatest(({c} - a_{c}) / (b_{c} - a_{c}), 0.0), 1.0) WHEN coalesce(h_{c} - l_{c} > 1e-12, false) THEN least(greatest(({c} - l_{c}) / (h_{c} - l_{c}), 0.0), 1.0) ELSE 0.0 END"


PARTS = {"wg": 0.25, "vl": 0.20, "tx": 0.20, "ti": 0.20}
RSK = f"""{DYN}, raw AS (SELECT year, "row", col, ndvi, ndwi AS tx, CASE WHEN water_growth IS NOT NULL THEN greatest(water_growth, 0.0) END AS wg, -delta_ndvi AS vl, (abs(delta_ndvi) + abs(delta_ndwi)) / 2 AS ti FROM dyn),
lim AS (SELECT year, {", ".join(f"quantile_cont({c}, 0.05) AS a_{c}, quantile_cont({c}, 0.95) AS b_{c}, min({c}) AS l_{c}, max({c}) AS h_{c}" for c in PARTS)} FROM raw GROUP BY year),
un AS (SELECT raw.year, "row", col, ndvi, {", ".join(f"{_unit(c)} AS u_{c}" for c in PARTS)} FROM raw JOIN lim ON lim.year = raw.year),
rsk AS (SELECT year, "row", col, CASE WHEN ndvi IS NOT NULL THEN ({" + ".join(f"coalesce({w} * u_{c}, 0)" for c, w in PARTS.items())}) / ({" + ".join(f"CASE WHEN u_{c} IS NOT NULL THEN {w} ELSE 0 END" for c, w in PARTS.items())} + 0.15) END AS risk_score FROM un)"""


@query(f'WITH {RSK} SELECT year, CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, {s("risk_score", n=7)} FROM rsk')
def risk_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.risk(_dynamics(spark, sf_dir), ["year"], texture="ndwi").select("year", *[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r("risk_score", n=7))


@query(f'WITH {PX}, q AS (SELECT label, quantile_cont(nir, 0.9) AS t FROM px GROUP BY 1) SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, CAST(coalesce(nir >= t, false) AS BIGINT) AS hotspot FROM px JOIN q ON q.label = px.label')
def hotspot_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.high_mask(pixels(spark, sf_dir), ["label"], "nir", raster.HOTSPOT_QUANTILE, "hotspot").select(*[F.col(c).cast("long").alias(c) for c in ("row", "col", "hotspot")])


@query(f"""WITH RECURSIVE {PX}, m AS (SELECT "row" AS r, col AS c, "row" * 16 + col AS id FROM px WHERE nir > 0.12), ed AS (SELECT a.id AS a, b.id AS b FROM m a JOIN m b ON abs(a.r - b.r) + abs(a.c - b.c) = 1),
reach AS (SELECT id AS node, id AS hop FROM m UNION SELECT reach.node, ed.b FROM reach JOIN ed ON ed.a = reach.hop), lab AS (SELECT node, min(hop) AS root FROM reach GROUP BY node)
SELECT CAST(node // 16 AS BIGINT) AS "row", CAST(node % 16 AS BIGINT) AS col, CAST(count(*) OVER (PARTITION BY root) AS BIGINT) AS n_px FROM lab""")
def hotspot_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = pixels(spark, sf_dir).withColumn("mask", F.coalesce(F.col("nir") > 0.12, F.lit(False)).cast("int"))
    out = raster.components(px, [], "mask", tile=64)
    sizes = out.groupBy("comp_id").agg(F.count("*").alias("n_px"))
    return out.join(sizes, "comp_id").select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], "n_px")


NEAR = f"""{PX}, ext AS (SELECT max("row") AS h FROM px), off AS (SELECT a.i AS dr, b.i AS dc FROM (SELECT unnest(range(-1, 2)) AS i) a, (SELECT unnest(range(-1, 2)) AS i) b),
nb AS (SELECT p."row", p.col, p.nir AS own, dr, dc, n.nir AS v FROM px p CROSS JOIN off CROSS JOIN ext JOIN px n ON n."row" = least(greatest(p."row" + dr, 0), h) AND n.col = least(greatest(p.col + dc, 0), 15))"""


@query(f"""WITH {NEAR}, a AS (SELECT "row", col, any_value(own) AS own, avg(v) AS m, avg(v * v) AS m2, max(v) - min(v) AS span FROM nb GROUP BY 1, 2)
SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, round(m, 9) + 0.0 AS mean, round(greatest(m2 - m * m, 0.0), 9) + 0.0 AS var, CASE WHEN own IS NOT NULL THEN round(span, 9) + 0.0 END AS range FROM a""")
def focal_mean_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    halo, names, of = raster.local_statistics(3)
    return raster.focal(pixels(spark, sf_dir), [], "nir", halo, names, of, tile=64).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r("mean", "var", "range"))


@query(f"""WITH {NEAR}, z AS (SELECT "row", col, own, dr, dc, coalesce(v, 0.0) AS v FROM nb), a AS (SELECT "row", col, any_value(own) AS own, sum(CASE WHEN abs(dr) + abs(dc) = 1 THEN v WHEN dr = 0 AND dc = 0 THEN -4 * v ELSE 0 END) AS laplacian,
  sum(v * dc * (2 - abs(dr))) AS gx, sum(v * dr * (2 - abs(dc))) AS gy FROM z GROUP BY 1, 2)
SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, CASE WHEN own IS NOT NULL THEN round(laplacian, 9) + 0.0 END AS laplacian, CASE WHEN own IS NOT NULL THEN round(sqrt(gx * gx + gy * gy), 9) + 0.0 END AS gradient FROM a""")
def laplacian_sobel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.focal(pixels(spark, sf_dir), [], "nir", 1, ["laplacian", "gradient"], raster.edges_of, tile=64).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r("laplacian", "gradient"))


@query(f"""WITH {PX}, f AS (SELECT "row", col, nir AS dem, coalesce(nir, (SELECT avg(nir) FROM px)) AS z FROM px),
g AS (SELECT *, CASE WHEN lag(z) OVER r IS NULL THEN (lead(z) OVER r - z) / 20 WHEN lead(z) OVER r IS NULL THEN (z - lag(z) OVER r) / 20 ELSE (lead(z) OVER r - lag(z) OVER r) / 40 END AS gy, CASE WHEN lag(z) OVER c IS NULL THEN (lead(z) OVER c - z) / 10 WHEN lead(z) OVER c IS NULL THEN (z - lag(z) OVER c) / 10 ELSE (lead(z) OVER c - lag(z) OVER c) / 20 END AS gx
  FROM f WINDOW r AS (PARTITION BY col ORDER BY "row"), c AS (PARTITION BY "row" ORDER BY col))
SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, CASE WHEN dem IS NOT NULL THEN round(degrees(atan(sqrt(gx * gx + gy * gy))), 8) + 0.0 END AS slope, CASE WHEN dem IS NOT NULL THEN round(sin(atan2(-gx, gy)), 7) + 0.0 END AS aspect_sin, CASE WHEN dem IS NOT NULL THEN round(cos(atan2(-gx, gy)), 7) + 0.0 END AS aspect_cos FROM g""")
def terrain_slope_aspect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.terrain(pixels(spark, sf_dir), [], "nir", 10.0, 20.0).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r("slope", n=8), *r("aspect_sin", "aspect_cos", n=7))


@query(f"""WITH {PX}, q AS (SELECT quantile_cont(nir, 0.01) AS lo, quantile_cont(nir, 0.99) AS hi FROM px) SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, CAST(CASE WHEN nir IS NULL THEN 0 ELSE round_even(least(greatest((nir - lo) / (hi - lo), 0.0), 1.0) * 15, 0) END AS BIGINT) AS level FROM px, q""")
def quantised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.quantised(pixels(spark, sf_dir), [], "nir").select(*[F.col(c).cast("long").alias(c) for c in ("row", "col", "level")])


@query(f"""WITH {PX}, k AS (SELECT *, CASE WHEN nir IS NOT NULL THEN CAST(round_even(least(greatest((nir + 0.3) / 0.6, 0.0), 1.0) * 10, 0) AS BIGINT) END AS i FROM px) SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, coalesce(i * 25, 0) AS r, coalesce(255 - i * 25, 0) AS g, coalesce(i * i, 0) AS b, CAST(CASE WHEN i IS NULL THEN 0 ELSE 255 END AS BIGINT) AS alpha FROM k""")
def colorize(spark: SparkSession, sf_dir: str) -> DataFrame:
    palette = spark.range(11).select(F.col("id").cast("int").alias("idx")).select("idx", (F.col("idx") * 25).alias("r"), (255 - F.col("idx") * 25).alias("g"), (F.col("idx") * F.col("idx")).alias("b"))
    return raster.colours(pixels(spark, sf_dir), "nir", palette, 11, -0.3, 0.3).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col", "r", "g", "b", "alpha")])


@query(f'WITH {PX} SELECT CAST("row" // 4 AS BIGINT) AS "row", CAST(col // 4 AS BIGINT) AS col, round(avg(nir), 9) + 0.0 AS nir FROM px GROUP BY 1, 2')
def overviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.overview(pixels(spark, sf_dir), [], "nir", 4).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r("nir"))


@query(f"""WITH {PX}, t AS (SELECT "row" AS tr, col AS tc, "row" * 0.75 AS y, col * 0.75 AS x FROM px), k AS (SELECT tr, tc, CASE WHEN i.i = 0 THEN 1 - (y - floor(y)) ELSE y - floor(y) END * CASE WHEN j.i = 0 THEN 1 - (x - floor(x)) ELSE x - floor(x) END AS w, floor(y) + i.i AS sr, floor(x) + j.i AS sc FROM t, (VALUES (0), (1)) i(i), (VALUES (0), (1)) j(i)),
v AS (SELECT tr, tc, sum(w * nir) / sum(w) AS nir FROM k JOIN px ON px."row" = sr AND px.col = sc WHERE w > 0 AND nir IS NOT NULL GROUP BY 1, 2) SELECT CAST(t.tr AS BIGINT) AS "row", CAST(t.tc AS BIGINT) AS col, round(nir, 9) + 0.0 AS nir FROM t LEFT JOIN v ON v.tr = t.tr AND v.tc = t.tc""")
def resample_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    px = pixels(spark, sf_dir)
    return raster.resampled(px, px, "nir", (0.75, 0, 0, 0, 0.75, 0)).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r("nir"))


GLCM = f"""{PX}, sm AS (SELECT "row" // 2 AS r, col // 2 AS c, nir FROM px WHERE "row" % 2 = 0 AND col % 2 = 0), q AS (SELECT quantile_cont(nir, 0.01) AS lo, quantile_cont(nir, 0.99) AS hi FROM sm),
lv AS (SELECT r, c, CAST(CASE WHEN nir IS NULL THEN 0 ELSE round_even(least(greatest((nir - lo) / (hi - lo), 0.0), 1.0) * 15, 0) END AS BIGINT) AS v FROM sm, q), ext AS (SELECT max(r) + 1 AS h, max(c) + 1 AS w FROM lv),
wn AS (SELECT a.s AS sr, b.s AS sc FROM (SELECT unnest(range(0, (SELECT h FROM ext), 2)) AS s) a, (SELECT unnest(range(0, (SELECT w FROM ext), 2)) AS s) b, ext WHERE a.s + 5 <= h AND b.s + 5 <= w),
pr AS (SELECT sr, sc, k, x.v AS i, y.v AS j FROM wn JOIN lv x ON x.r >= sr AND x.r < sr + 5 AND x.c >= sc AND x.c < sc + 5 CROSS JOIN (VALUES (0, 0, 1), (1, -1, 1), (2, -1, 0), (3, -1, -1)) o(k, dr, dc) JOIN lv y ON y.r = x.r + dr AND y.c = x.c + dc AND y.r >= sr AND y.c < sc + 5 AND y.c >= sc),
mt AS (SELECT sr, sc, avg(con) AS contrast, avg(hom) AS homogeneity, avg(dis) AS dissimilarity FROM (SELECT sr, sc, k, avg((i - j) * (i - j)) AS con, avg(CAST(1 AS DOUBLE) / (1 + (i - j) * (i - j))) AS hom, avg(abs(i - j)) AS dis FROM pr GROUP BY 1, 2, 3) GROUP BY 1, 2),
ce AS (SELECT sr, sc, k, i, j, CAST(count(*) AS DOUBLE) AS m FROM (SELECT sr, sc, k, i, j FROM pr UNION ALL SELECT sr, sc, k, j, i FROM pr) GROUP BY 1, 2, 3, 4, 5),
en AS (SELECT sr, sc, -sum(p * log2(p)) AS entropy FROM (SELECT sr, sc, m / sum(m) OVER (PARTITION BY sr, sc, k) / 4 AS p FROM ce) GROUP BY 1, 2),
ax AS (SELECT max(sr) * 2 + 4 AS tr, max(sc) * 2 + 4 AS tc FROM wn), pl AS (SELECT "row", col, 4 + 4 * greatest(ceil(("row" - 4) / 4.0 - 0.5), 0) AS lr, 4 + 4 * greatest(ceil((col - 4) / 4.0 - 0.5), 0) AS lc FROM px)"""


@query(f"""WITH {GLCM} SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, round(contrast, 7) + 0.0 AS contrast, round(homogeneity, 7) + 0.0 AS homogeneity, round(dissimilarity, 7) + 0.0 AS dissimilarity, round(entropy, 7) + 0.0 AS entropy
FROM pl, ax, mt JOIN en ON en.sr = mt.sr AND en.sc = mt.sc WHERE (mt.sr + 2) * 2 = least(lr, tr) AND (mt.sc + 2) * 2 = least(lc, tc)""")
def glcm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texture by co-occurrence in windows of 5, brought back to every pixel."""
    px = pixels(spark, sf_dir)
    return raster.spread(px, raster.glcm(px, [], "nir", 5), [], raster.GLCM).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r(*raster.GLCM, n=7))


# The covariance matrix squared over and over (and brought to trace 1) becomes the product of its first eigenvector with itself.
BANDS4 = ("blue", "green", "red", "nir")
CELLS = [(i, j) for i in range(4) for j in range(4)]
PCA = f"""{PX}, st AS (SELECT {", ".join(f"avg({b}) AS m{i}, stddev_pop({b}) AS s{i}" for i, b in enumerate(BANDS4))}, {", ".join(f"covar_samp({BANDS4[i]}, {BANDS4[j]}) AS c{i}{j}" for i, j in CELLS)} FROM px WHERE nir IS NOT NULL),
sq AS (SELECT 0 AS k, {", ".join(f"c{i}{j} / s{i} / s{j} AS a{i}{j}" for i, j in CELLS)} FROM st UNION ALL
  SELECT k + 1, {", ".join(f"b{i}{j} / (b00 + b11 + b22 + b33)" for i, j in CELLS)} FROM (SELECT k, {", ".join(" + ".join(f"a{i}{n} * a{n}{j}" for n in range(4)) + f" AS b{i}{j}" for i, j in CELLS)} FROM sq WHERE k < 30)),
v AS (SELECT {", ".join(f"a{i}0 / sqrt(a00) * sign(a00 + a10 + a20 + a30) AS v{i}" for i in range(4))} FROM sq WHERE k = 30)"""


@query(f'WITH RECURSIVE {PCA} SELECT CAST("row" AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, round({" + ".join(f"({b} - m{i}) / s{i} * v{i}" for i, b in enumerate(BANDS4))}, 5) + 0.0 AS pc1 FROM px, st, v')
def pca_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raster.first_component(pixels(spark, sf_dir)).select(*[F.col(c).cast("long").alias(c) for c in ("row", "col")], *r("pc1", n=5))
