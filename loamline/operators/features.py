"""Parcel-year tables: validity flags, area consistency and temporal features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import nulls, text

PARCEL_YEAR = ["area", "year", "parcel_id"]
TEMPORAL = text.CURRENT + text.BASELINE


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Bag union by name of tables whose columns may differ."""
    if not parts:
        raise ValueError("nothing to unite")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def keep_first(df: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key, the first in a total order."""
    return df.withColumn("_rn", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def with_validity(stats: DataFrame, flags: DataFrame | None) -> DataFrame:
    """stats with is_valid by area, year and parcel; NULL where no flag is known."""
    if flags is None:
        return stats.withColumn("is_valid", F.lit(None).cast("boolean"))
    return stats.join(flags.select(*PARCEL_YEAR, "is_valid"), PARCEL_YEAR, "left")


def consistent_areas(df: DataFrame, lookup: DataFrame, strict: bool = True, prefer_geometry: bool = False) -> DataFrame:
    """df with area, area_m2 and cad_num settled against what parcels' geometry says (lookup: parcel_id, area, ...).

    strict drops rows whose area differs from a known geometry area (a missing area differs too). Columns that both sides have are
    taken from the table and filled from the lookup, or the other way round with prefer_geometry.
    """
    shared = [c for c in lookup.columns if c in df.columns and c not in ("parcel_id", "area")]
    side = lookup.select("parcel_id", F.col("area").alias("_area"), *[F.col(c).alias(f"_{c}") for c in shared], *[c for c in lookup.columns if c not in (*shared, "parcel_id", "area")])
    out = df.join(side, "parcel_id", "left")
    if strict:
        out = out.filter(~(F.col("_area").isNotNull() & ~F.col("area").eqNullSafe(F.col("_area"))))
    first = (lambda c: F.coalesce(f"_{c}", c)) if prefer_geometry else (lambda c: F.coalesce(c, f"_{c}"))
    return out.withColumns({"area": F.coalesce("_area", "area")} | {c: first(c) for c in shared}).drop("_area", *[f"_{c}" for c in shared])


def with_temporal(df: DataFrame, features: list[str]) -> DataFrame:
    """df with prev1__, d1__ and roll2__ of each feature it has, prev_year, year_gap, log_area_m2 and n_missing_primary.

    Rows of a parcel in an area follow each other by year, whatever lies between; one window, so one sort, serves all columns.
    """
    by = W.partitionBy("area", "parcel_id").orderBy("year")
    two = by.rowsBetween(-1, 0)
    have = [c for c in features if c in df.columns]
    new: dict[str, Column] = {"prev_year": F.lag("year").over(by), "year_gap": F.col("year") - F.lag("year").over(by)}
    for c in have:
        new |= {f"prev1__{c}": F.lag(c).over(by), f"d1__{c}": F.col(c) - F.lag(c).over(by), f"roll2__{c}": F.avg(c).over(two)}
    if "area_m2" in df.columns:
        new["log_area_m2"] = nulls.log_area(F.col("area_m2"))
    primary = [c for c in text.CURRENT if c in df.columns]
    new["n_missing_primary"] = nulls.missing_count([F.col(c) for c in primary]) if primary else F.lit(0)
    return df.withColumns(new)


def missing_shares(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, missing_share), most first: one aggregation, then one row for each column."""
    one = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "missing_share").orderBy(F.desc("missing_share"), "column")
