"""The tables that queries start from, and the same as SQL: parcel-years from orders, pixels from embeddings, scored rows from documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parcel_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A market segment is an area, a customer a parcel; features are exact ratios of counts and cents."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    share = lambda cond: F.sum(cond.cast("long")).cast("double") / F.count("*")
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    return (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .groupBy(F.col("c_mktsegment").alias("area"), F.col("o_custkey").alias("parcel_id"), F.year("o_orderdate").cast("long").alias("year"))
        .agg(
            (F.sum(cents).cast("double") / F.count("*") / F.lit(1e7)).alias("ndvi_mean"),
            share(F.col("o_orderstatus") == "F").alias("change_share"),
            share(F.substring("o_orderpriority", 1, 1).isin("1", "2")).alias("texture_anomaly_share"),
            share(F.col("o_orderstatus") == "O").alias("water_share"),
            share(F.substring("o_orderpriority", 1, 1) == "5").alias("persistence_water_share"),
            share(F.col("o_totalprice") > 300000).alias("hotspot_share"),
            F.count("*").alias("n"),
        )
    )


PY = """py AS (
  SELECT c_mktsegment AS area, o_custkey AS parcel_id, CAST(year(o_orderdate) AS BIGINT) AS year,
    CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS DOUBLE) / count(*) / 1e7 AS ndvi_mean,
    CAST(sum(CAST(o_orderstatus = 'F' AS BIGINT)) AS DOUBLE) / count(*) AS change_share,
    CAST(sum(CAST(o_orderpriority[1] IN ('1', '2') AS BIGINT)) AS DOUBLE) / count(*) AS texture_anomaly_share,
    CAST(sum(CAST(o_orderstatus = 'O' AS BIGINT)) AS DOUBLE) / count(*) AS water_share,
    CAST(sum(CAST(o_orderpriority[1] = '5' AS BIGINT)) AS DOUBLE) / count(*) AS persistence_water_share,
    CAST(sum(CAST(o_totalprice > 300000 AS BIGINT)) AS DOUBLE) / count(*) AS hotspot_share, count(*) AS n
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1, 2, 3)"""


def dynamic_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """parcel_years with deltas, so that first years have missing values."""
    by = W.partitionBy("area", "parcel_id").orderBy("year")
    return parcel_years(spark, sf_dir).withColumns({"delta_ndvi_mean": F.col("ndvi_mean") - F.lag("ndvi_mean").over(by), "delta_ndwi_mean": F.col("water_share") - F.lag("water_share").over(by), "roll2__change_share": F.avg("change_share").over(by.rowsBetween(-1, 0))})


DY = (
    PY
    + """, dy AS (SELECT *, ndvi_mean - lag(ndvi_mean) OVER w AS delta_ndvi_mean, water_share - lag(water_share) OVER w AS delta_ndwi_mean,
    CASE WHEN lag(change_share) OVER w IS NULL THEN change_share ELSE (lag(change_share) OVER w + change_share) / 2 END AS roll2__change_share
  FROM py WINDOW w AS (PARTITION BY area, parcel_id ORDER BY year))"""
)


def pixels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster with a row for each vector and 16 columns of four bands: blue, green, red, nir; every 37th pixel is nodata."""
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("int").alias("row"), F.col("label").cast("int").alias("label"), "embedding", F.explode(F.sequence(F.lit(0), F.lit(15))).alias("col"))
    band = lambda i: F.when(F.pmod(F.col("row") * 16 + F.col("col"), F.lit(37)) != 0, F.get("embedding", F.col("col") * 4 + i).cast("double"))
    return e.select("row", "col", "label", *[band(i).alias(b) for i, b in enumerate(("blue", "green", "red", "nir"))])


PX = """px AS (
  SELECT "row", col, label, CASE WHEN ok THEN CAST(embedding[col * 4 + 1] AS DOUBLE) END AS blue, CASE WHEN ok THEN CAST(embedding[col * 4 + 2] AS DOUBLE) END AS green,
    CASE WHEN ok THEN CAST(embedding[col * 4 + 3] AS DOUBLE) END AS red, CASE WHEN ok THEN CAST(embedding[col * 4 + 4] AS DOUBLE) END AS nir
  FROM (SELECT CAST(vec_id AS INT) AS "row", CAST(label AS INT) AS label, embedding, CAST(c.i AS INT) AS col, (vec_id * 16 + c.i) % 37 <> 0 AS ok
    FROM embeddings, (SELECT unnest(range(16)) AS i) c))"""


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as scored parcels: source is the area, four groups the years, quality the label, two predictions in [0, 1]."""
    d, l = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")  # noqa: E741
    p = lambda k, m: F.pmod(F.col("doc_id") * k + F.col("n_chars") * 31, F.lit(m)).cast("double") / m
    return d.join(l, "doc_id", "left").select(F.col("source").alias("area"), F.pmod("doc_id", F.lit(4)).cast("long").alias("year"), F.col("doc_id").alias("parcel_id"), F.col("quality").cast("long").alias("weak_target"), (F.col("lang") == "en").alias("inside_mask"), p(7919, 101).alias("pred_logit"), p(104729, 1009).alias("pred_baseline_risk"), F.when(F.pmod("doc_id", F.lit(11)) != 0, p(15485863, 50)).alias("pred_boost"))


SC = """sc AS (
  SELECT source AS area, CAST(d.doc_id % 4 AS BIGINT) AS year, d.doc_id AS parcel_id, CAST(quality AS BIGINT) AS weak_target, lang = 'en' AS inside_mask,
    CAST((d.doc_id * 7919 + n_chars * 31) % 101 AS DOUBLE) / 101 AS pred_logit, CAST((d.doc_id * 104729 + n_chars * 31) % 1009 AS DOUBLE) / 1009 AS pred_baseline_risk,
    CASE WHEN d.doc_id % 11 <> 0 THEN CAST((d.doc_id * 15485863 + n_chars * 31) % 50 AS DOUBLE) / 50 END AS pred_boost
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id)"""
