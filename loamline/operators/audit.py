"""Audits of result folders: inventories, rules on names and values, and issues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from . import geometry as g

# Rules on layer names, severities and the layers that belong together.
SEVERITIES = {"INFO": 0, "WARNING": 1, "ERROR": 2}
RANGES = {"ndvi": (-1.2, 1.2), "ndwi": (-1.2, 1.2), "osavi": (-1.2, 1.2), "aspect_cos": (-1.05, 1.05), "aspect_sin": (-1.05, 1.05), "delta_ndvi": (-2.0, 2.0), "delta_ndwi": (-2.0, 2.0), "glcm_homogeneity": (0.0, 1.1)}
NOT_NEGATIVE = ["brightness", "dem", "slope", "roughness", "tri", "local_std", "local_var", "glcm_entropy", "glcm_contrast", "glcm_dissimilarity", "water_occurrence", "risk_score", "water_growth"]
BINARY = ["change_mask", "hotspot_mask", "persistence_water_mask", "texture_anomaly_mask", "water_mask"]
FAMILIES = {
    "indices": ["brightness", "ndvi", "ndwi", "nir_red_ratio", "osavi", "red_green_ratio"],
    "masks": BINARY,
    "terrain": ["aspect_cos", "aspect_sin", "curvature", "dem", "roughness", "slope", "tpi", "tri"],
    "dynamics_pair": ["delta_ndvi", "delta_ndwi", "water_growth"],
    "dynamics_year": ["risk_score", "water_occurrence"],
}
TEXTURES = [f"{c}_{f}_{w}" for c in ("nir", "red", "pc1") for f in ("glcm_contrast", "glcm_dissimilarity", "glcm_entropy", "glcm_homogeneity", "local_std", "local_var") for w in ("w5", "w7")]
FOLDERS = ["analytics", "aoi", "catalog", "composites", "dynamics", "indices", "masks", "parcels", "terrain", "textures"]
AOI_ORDER = ["area_aoi", "aoi_union", "scene_footprints"]
ISSUE = ["severity", "code", "path", "message", "details"]


def named(layer: str) -> str:
    """Pattern of a file name with a part of this name; delta_x also has the part x."""
    return rf"(?i)(?:^|_){layer}(?:_|\.)"


def rules(spark: SparkSession) -> DataFrame:
    """(code, pattern, low, high): value rules as a table."""
    rows = [("RASTER_RANGE", named(k), *v) for k, v in RANGES.items()] + [("RASTER_NEGATIVE", named(k), 0.0, None) for k in NOT_NEGATIVE] + [("RASTER_NOT_BINARY", named(k), None, None) for k in BINARY]
    return spark.createDataFrame(rows, "code string, pattern string, low double, high double")


def issue(df: DataFrame, severity: str, code: Column, path: Column, message: str, **details: Column) -> DataFrame:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(F.lit(severity).alias("severity"), code.alias("code"), path.alias("path"), F.lit(message).alias("message"), (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("details"))


def value_issues(files: DataFrame, table: DataFrame) -> DataFrame:
    """Violations of the value rules by raster inventory rows (name, min, max, unique_preview); missing values break no rule."""
    met = files.join(F.broadcast(table), F.rlike(F.col("name"), F.col("pattern")))  # the rules are a table of fixed length
    values = F.transform(F.filter("unique_preview", F.isnotnull), lambda v: v.cast("double"))
    odd = F.size(F.array_except(values, F.array(*[F.lit(x) for x in (0.0, 1.0, 255.0)]))) > 0
    broken = F.when(F.col("code") == "RASTER_NOT_BINARY", odd).otherwise(F.coalesce(F.col("min") < F.col("low"), F.lit(False)) | F.coalesce(F.col("max") > F.col("high"), F.lit(False)))
    return issue(met.filter(broken), "WARNING", F.col("code"), F.col("name"), "values break the rule of this layer", min=F.col("min"), max=F.col("max"), pattern=F.col("pattern"))


def layer_inventory(px: DataFrame, keys: list[str], layer: str, preview: int = 12) -> DataFrame:
    """min, max, mean, std, finite share and the first distinct values of a layer in each group."""
    aggs = [f(layer).alias(n) for n, f in (("min", F.min), ("max", F.max), ("mean", F.avg), ("std", F.stddev_pop))]
    stats = px.groupBy(*keys).agg(*aggs, F.avg(F.col(layer).isNotNull().cast("double")).alias("finite"))
    # Distinct values are cut to the preview before any list is made.
    values = px.filter(F.col(layer).isNotNull()).select(*keys, layer).distinct().withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(layer))).filter(F.col("_n") <= preview)
    return stats.join(values.groupBy(*keys).agg(F.array_sort(F.collect_list(layer)).alias("unique_preview")), keys, "left")


def vector_inventory(layers: DataFrame, key: str, geometry: str = "geometry") -> DataFrame:
    """Features, empty, invalid and duplicate geometries and bounds of each layer; after the first, missing geometries are duplicates of each other."""
    b = g.bounds(F.col(geometry))
    rows = layers.select(key, F.md5(g.to_geojson(F.col(geometry))).alias("_h"), g.is_empty(F.col(geometry)).alias("_e"), F.coalesce(~g.is_valid(geometry), F.lit(False)).alias("_i"), *[v.alias(k) for k, v in b.items()])
    return rows.groupBy(key).agg(F.count("*").alias("features"), F.sum(F.col("_e").cast("long")).alias("empty"), F.sum(F.col("_i").cast("long")).alias("invalid"), (F.count("*") - F.count_distinct(F.coalesce("_h", F.lit("")))).alias("duplicates"), *[(F.min if k.endswith("min") else F.max)(k).alias(k) for k in b])


def table_inventory(df: DataFrame) -> DataFrame:
    """rows, cols, duplicate_rows and unnamed columns of a table."""
    names = df.columns
    row = F.md5(F.to_json(F.struct(*[F.col(f"`{c}`") for c in names]), {"ignoreNullFields": "false"}))
    return df.select(row.alias("_h")).agg(F.count("*").alias("rows"), F.count_distinct("_h").alias("_d")).select("rows", F.lit(len(names)).alias("cols"), (F.col("rows") - F.col("_d")).alias("duplicate_rows"), F.lit(sum(c.startswith("Unnamed") for c in names)).alias("unnamed"))


def manifest_issues(listed: DataFrame, found: DataFrame) -> DataFrame:
    """Paths that only the manifest or only the folder has (both as relative paths)."""
    gone = issue(listed.join(found, "path", "left_anti"), "ERROR", F.lit("MANIFEST_MISSING_FILE"), F.col("path"), "the manifest names a file that is not there")
    extra = issue(found.join(listed, "path", "left_anti"), "WARNING", F.lit("MANIFEST_EXTRA_FILE"), F.col("path"), "the manifest does not name this file")
    return gone.unionByName(extra)


def missing_of_family(layers: DataFrame, keys: list[str], family: str = "family", feature: str = "feature") -> DataFrame:
    """keys, family and the expected layers that a group lacks, sorted; whole groups don't appear. Expected are FAMILIES and, for textures, all of TEXTURES."""
    expected = F.lit(None).cast("array<string>")
    for name, wanted in (FAMILIES | {"textures": TEXTURES}).items():
        expected = F.when(F.col(family) == name, F.array(*[F.lit(x) for x in wanted])).otherwise(expected)
    have = layers.groupBy(*keys, family).agg(F.collect_set(feature).alias("have"))
    return have.withColumn("missing", F.array_sort(F.array_except(expected, F.col("have")))).filter(F.size("missing") > 0).select(*keys, family, "missing")


def alignment_variants(rasters: DataFrame, group: list[str], grid: list[str], most: int = 10) -> DataFrame:
    """Groups whose rasters lie on several grids: the number of variants, and the most frequent ones with their counts."""
    variants = rasters.groupBy(*group, *grid).agg(F.count("*").alias("n"))
    out = variants.groupBy(*group).agg(F.count("*").alias("variants"), F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("n", *grid)))), 1, most).alias("examples"))
    return out.filter("variants > 1")


def outside_aoi(rasters: DataFrame, aoi: DataFrame, least: float = 0.05) -> DataFrame:
    """Rasters whose box shares less than `least` of its area with the AOI's (one row); with the fraction."""
    both = rasters.crossJoin(F.broadcast(aoi.select(*[F.col(c).alias(f"a_{c}") for c in ("xmin", "ymin", "xmax", "ymax")])))  # the AOI is one row
    own, other = ({c: F.col(p + c) for c in ("xmin", "ymin", "xmax", "ymax")} for p in ("", "a_"))
    return both.withColumn("fraction", F.try_divide(g.box_overlap(own, other), g.box_area(own))).filter(F.col("fraction") < least).drop(*[f"a_{c}" for c in own])


def preferred_aoi(layers: DataFrame, path: str = "relpath") -> DataFrame:
    """The layer to check against: by AOI_ORDER, else the first."""
    rank = F.lit(len(AOI_ORDER))
    for i, n in reversed(list(enumerate(AOI_ORDER))):
        rank = F.when(F.col(path).contains(n), i).otherwise(rank)
    return layers.orderBy(rank, path).limit(1)


def severity_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("severity").agg(F.count("*").alias("n"))


def ranked_issues(issues: DataFrame, severity: str, most: int) -> DataFrame:
    """The first issues of a severity, for a report."""
    return issues.filter(F.col("severity") == severity).orderBy("path", "code").limit(most)


def markdown(issues: DataFrame, errors: int = 50, warnings: int = 80) -> str:
    """A report of bounded length."""
    counts = {r["severity"]: r["n"] for r in severity_counts(issues).collect()}
    lines = ["# Audit", "", *[f"- {s}: {counts.get(s, 0)}" for s in SEVERITIES]]
    for severity, most in (("ERROR", errors), ("WARNING", warnings)):
        rows = ranked_issues(issues, severity, most).collect()
        lines += ["", f"## {severity}", *[f"- `{r['code']}` {r['path']}: {r['message']}" for r in rows]]
    return "\n".join(lines) + "\n"
