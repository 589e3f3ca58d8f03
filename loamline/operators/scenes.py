"""Scene catalogues: parsing, selection and inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text


def catalog_from_listing(files: DataFrame, path: str = "FullName", kind: str = "Type") -> DataFrame:
    """Scene rows of a file listing: .tif files at least four levels deep, whose folder names a scene.

    The last parts of a path are package, work folder, scene folder and file.
    """
    flat = F.regexp_replace(F.col(path), r"\\", "/")
    rows = files.filter((F.upper(F.col(kind)) == "FILE") & F.lower(flat).endswith(".tif")) if kind in files.columns else files.filter(F.lower(flat).endswith(".tif"))
    parts = F.split(flat, "/")
    rows = rows.select(flat.alias("tif_path"), parts.alias("p")).filter(F.size("p") >= 4)
    rows = rows.select("tif_path", *[F.element_at("p", i).alias(n) for i, n in ((-4, "scene_pkg"), (-3, "work_folder"), (-2, "scene_folder"))])
    got = text.scene_parts(F.col("scene_folder"))
    rows = rows.withColumns(got).filter("date is not null")
    return rows.withColumns({"area": text.area_of_folder(F.col("work_folder")), "year": F.year("date"), "score": text.scene_score(F.col("product"), F.col("level"))}).orderBy("area", "date", "time", "score", "scene_pkg")


def top_per_group(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """The first row of each group in a total order."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def first_values(df: DataFrame, keys: list[str], order: list[Column | str], columns: list[str]) -> DataFrame:
    """For each group the first value of each column that is not missing, in that order: values may come from different rows."""
    return df.groupBy(*keys).agg(*[F.min_by(F.when(F.col(c).isNotNull(), F.col(c)), F.when(F.col(c).isNotNull(), F.struct(*order))).alias(c) for c in columns])


def best_scenes(catalog: DataFrame, product: str = "MS") -> DataFrame:
    """One scene of the product for each area, date and time: the lowest score, then package, then path."""
    only = catalog.filter(F.col("product") == product)
    if only.limit(1).count() == 0:
        raise ValueError(f"no scene of product {product}")
    return top_per_group(only, ["area", "date", "time"], ["score", "scene_pkg", "tif_path"])


def inventory(catalog: DataFrame, keys: list[str]) -> DataFrame:
    """(dimension, value, n): counts by each key, all from one pass."""
    grouped = catalog.groupingSets([[F.col(k)] for k in keys], *[F.col(k) for k in keys]).agg(F.grouping_id().alias("_g"), F.count("*").alias("n"))
    last = len(keys) - 1
    dimension = F.lit(None).cast("string")
    value = F.lit(None).cast("string")
    for i, k in enumerate(keys):
        here = F.col("_g").bitwiseAND(F.lit(1 << (last - i))) == 0
        dimension, value = F.when(here, F.lit(k)).otherwise(dimension), F.when(here, F.col(k).cast("string")).otherwise(value)
    return grouped.select(dimension.alias("dimension"), value.alias("value"), "n")


def shallow_dirs(footprints: DataFrame, path: str = "path", deepest: bool = True) -> DataFrame:
    """Folders that hold a footprint and no other such folder below them (deepest) or above them.

    A folder has at most as many ancestors as levels, so they are exploded and found by an equi-join.
    """
    dirs = footprints.select(F.regexp_replace(F.col(path), r"/[^/]*$", "").alias("dir")).distinct()
    levels = F.split("dir", "/")
    above = dirs.filter(F.size(levels) > 1).select("dir", F.explode(F.sequence(F.lit(1), F.size(levels) - 1)).alias("n")).select(F.col("dir").alias("below"), F.array_join(F.slice(levels, 1, F.col("n")), "/").alias("dir"))
    pairs = above.join(dirs, "dir")
    return dirs.join(pairs.select("dir").distinct() if deepest else pairs.select(F.col("below").alias("dir")).distinct(), "dir", "left_anti")


def reference_scene(rasters: DataFrame, keys: list[str], order: str = "path") -> DataFrame:
    """For each group the raster with the finest cells (the smaller of both sizes), the first in order on ties."""
    cell = F.least(F.abs("a"), F.abs("e"))
    return rasters.groupBy(*keys).agg(F.min_by(F.struct(order, "a", "e"), F.struct(cell, F.col(order))).alias("_r")).select(*keys, "_r.*")


def reference_grid(bounds: DataFrame, cell: str = "cell") -> DataFrame:
    """bounds (xmin, ymin, xmax, ymax, cell) with the width and height of the grid that covers them, one cell at least; a billionth of a cell too many is none."""
    cells = lambda c: F.greatest(F.lit(1), F.ceil(F.round((F.col(f"{c}max") - F.col(f"{c}min")) / F.col(cell), 9)).cast("int"))
    return bounds.withColumns({"width": cells("x"), "height": cells("y")})


def first_footprints(footprints: DataFrame, prefer: str = "dir") -> DataFrame:
    """One footprint for each scene_id: of the preferred kind (source_type) if there is one, then the first path."""
    return top_per_group(footprints, ["scene_id"], [F.when(F.col("source_type") == prefer, 0).otherwise(1), F.col("source_path"), F.col("gbd_path")])
