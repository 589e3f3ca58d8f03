"""Rasters as pixel tables: map algebra, composites, dynamics, risk, focal windows, texture, terrain and components.

A pixel table has key columns (area, year, ...), row, col and one column for each layer; NULL is nodata. Pixel-wise work is plain
expressions; thresholds of a whole grid are one aggregation joined back; neighbourhood work deals pixels out as tiles with a halo and runs NumPy on each.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nulls import EPS, mean_of, total_of, yes
from ..functions.stats import joined_on, otsu, quantiles, with_robust_unit
from ..session import checkpointed, dropped, written

BANDS = ["blue", "green", "red", "nir"]
# Weights of the risk's components, thresholds of masks, soil factors (gain, offset).
RISK_WEIGHTS = {"water_growth": 0.25, "vegetation_loss": 0.20, "texture_anomaly": 0.20, "terrain_susceptibility": 0.15, "temporal_instability": 0.20}
PERSISTENT_WATER, HOTSPOT_QUANTILE, TEXTURE_QUANTILE, CHANGE_QUANTILE = 0.6, 0.9, 0.9, 0.9
SOIL = {"savi": (1.5, 0.5), "osavi": (1.16, 0.16)}

# ---------------------------------------------------------------- pixel-wise


def composite(scenes: DataFrame, keys: list[str], bands: list[str] = BANDS) -> DataFrame:
    """Median of each band over a pixel's scenes; all bands NULL where any is."""
    out = scenes.groupBy(*keys, "row", "col").agg(*[F.median(b).alias(b) for b in bands])
    whole = F.lit(True)
    for b in bands:
        whole = whole & F.col(b).isNotNull()
    return out.withColumns({b: F.when(whole, F.col(b)) for b in bands})


def normalised_difference(a: Column, b: Column) -> Column:
    return (a - b) / (a + b + F.lit(EPS))


def indices(px: DataFrame, soil: str = "osavi") -> DataFrame:
    """px with ndvi, ndwi, the soil-adjusted index, both ratios and brightness."""
    blue, green, red, nir = (F.col(b) for b in BANDS)
    gain, offset = SOIL[soil]
    return px.withColumns({
        "ndvi": normalised_difference(nir, red), "ndwi": normalised_difference(green, nir), soil: F.lit(gain) * (nir - red) / (nir + red + F.lit(offset) + F.lit(EPS)),
        "nir_red_ratio": nir / (red + F.lit(EPS)), "red_green_ratio": red / (green + F.lit(EPS)), "brightness": mean_of([blue, green, red, nir]),
    })


def water_mask(px: DataFrame, keys: list[str], threshold: float | None = None) -> DataFrame:
    """px with water (0 or 1, 0 for nodata): ndwi above Otsu's threshold of its group, or the one given."""
    if threshold is not None:
        return px.withColumn("water", yes(F.col("ndwi") > threshold).cast("int"))
    limits = otsu(px, "ndwi", keys).withColumnRenamed("threshold", "_t")
    return joined_on(px, limits, keys).withColumn("water", yes(F.col("ndwi") > F.col("_t")).cast("int")).drop("_t")


def high_mask(px: DataFrame, keys: list[str], layer: str, quantile: float, name: str) -> DataFrame:
    """px with a mask of the values at or above their group's quantile."""
    limits = quantiles(px, keys, {"_t": (F.col(layer), quantile)})
    return joined_on(px, limits, keys).withColumn(name, yes(F.col(layer) >= F.col("_t")).cast("int")).drop("_t")


def with_dynamics(px: DataFrame, area: list[str]) -> DataFrame:
    """px (ndvi, ndwi, water by year) with delta_ndvi, delta_ndwi, water_growth (NULL in a pixel's first year), water_occurrence over the years so far, and persistence_water."""
    by = W.partitionBy(*area, "row", "col").orderBy("year")
    change = lambda c: F.col(c) - F.lag(c).over(by)
    occurrence = F.avg("water").over(by.rowsBetween(W.unboundedPreceding, 0))
    out = px.withColumns({"delta_ndvi": change("ndvi"), "delta_ndwi": change("ndwi"), "water_growth": change("water").cast("double"), "water_occurrence": occurrence})
    return out.withColumn("persistence_water", (F.col("water_occurrence") >= PERSISTENT_WATER).cast("int"))


def change_mask(px: DataFrame, keys: list[str]) -> DataFrame:
    """px with change: a top-decile absolute delta or any change of water; 0 in groups without deltas."""
    limits = quantiles(px, keys, {"_n": (F.abs("delta_ndvi"), CHANGE_QUANTILE), "_w": (F.abs("delta_ndwi"), CHANGE_QUANTILE)})
    hit = yes(F.abs("delta_ndvi") >= F.col("_n")) | yes(F.abs("delta_ndwi") >= F.col("_w")) | yes(F.abs("water_growth") > 0)
    some = F.col("_n").isNotNull() | F.col("_w").isNotNull()
    return joined_on(px, limits, keys).withColumn("change", (hit & some).cast("int")).drop("_n", "_w")


def risk(px: DataFrame, keys: list[str], texture: str | None = None, masked: bool = True) -> DataFrame:
    """px with risk_score in [0, 1]: the weighted mean of the components that a pixel has, each scaled within its group.

    Components: growth of water, loss of vegetation, texture (a layer), terrain (mean of slope and absolute tpi, slope alone, or 0), and
    the mean absolute delta. masked: only where ndvi is known.
    """
    have = px.columns
    terrain = mean_of([F.col("slope"), F.abs("tpi")]) if {"slope", "tpi"} <= set(have) else F.col("slope") if "slope" in have else None
    raw = {
        "water_growth": F.when(F.col("water_growth").isNotNull(), F.greatest("water_growth", F.lit(0.0))), "vegetation_loss": -F.col("delta_ndvi"),
        "texture_anomaly": F.col(texture) if texture else F.lit(None).cast("double"), "temporal_instability": mean_of([F.abs("delta_ndvi"), F.abs("delta_ndwi")]),
    } | ({} if terrain is None else {"terrain_susceptibility": terrain})
    out = px.withColumns({f"_{k}": v for k, v in raw.items()})
    out = with_robust_unit(out, keys, {f"c_{k}": f"_{k}" for k in raw}).drop(*[f"_{k}" for k in raw])
    if terrain is None:
        out = out.withColumn("c_terrain_susceptibility", F.lit(0.0))
    parts = [(F.col(f"c_{k}"), w) for k, w in RISK_WEIGHTS.items()]
    weight = total_of([F.when(c.isNotNull(), F.lit(w)).otherwise(F.lit(0.0)) for c, w in parts])
    score = F.try_divide(total_of([F.coalesce(c * F.lit(w), F.lit(0.0)) for c, w in parts]), weight)
    out = out.withColumn("risk_score", F.when(F.col("ndvi").isNotNull(), score) if masked and "ndvi" in have else score)
    return out.drop(*[f"c_{k}" for k in RISK_WEIGHTS])


def quantised(px: DataFrame, keys: list[str], layer: str, levels: int = 16) -> DataFrame:
    """px with `level`: the layer between its 1 and 99 % percentiles in half-even steps; 0 for nodata."""
    limits = quantiles(px, keys, {"_lo": (F.col(layer), 0.01), "_hi": (F.col(layer), 0.99)})
    hi = F.when(F.col("_hi") > F.col("_lo"), F.col("_hi")).otherwise(F.col("_lo") + 1.0)
    unit = F.least(F.greatest((F.col(layer) - F.col("_lo")) / (hi - F.col("_lo")), F.lit(0.0)), F.lit(1.0))
    level = F.when(F.col(layer).isNotNull(), F.rint(unit * (levels - 1))).otherwise(F.lit(0.0)).cast("int")
    return joined_on(px, limits, keys).withColumn("level", level).drop("_lo", "_hi")


def colours(px: DataFrame, layer: str, palette: DataFrame, n: int, low: float, high: float) -> DataFrame:
    """px with r, g, b and alpha by a palette (idx, r, g, b) of n colours; nodata is transparent black. A layer of floats is scaled in floats, any other in doubles."""
    kind = "float" if dict(px.dtypes)[layer] == "float" else "double"
    number = lambda v: F.lit(float(v)).cast(kind)
    # Spark divides floats as doubles; cast back, that is the division of floats.
    unit = F.least(F.greatest(((F.col(layer) - number(low)) / number(high - low)).cast(kind), number(0)), number(1))
    held = px.withColumn("idx", F.when(F.col(layer).isNotNull(), F.rint(unit * number(n - 1)).cast("int")))
    out = held.join(F.broadcast(palette), "idx", "left")  # a palette has n rows
    return out.withColumns({c: F.coalesce(F.col(c).cast("int"), F.lit(0)) for c in "rgb"} | {"alpha": F.when(F.col("idx").isNotNull(), 255).otherwise(0)}).drop("idx")


def overview(px: DataFrame, keys: list[str], layer: str, factor: int) -> DataFrame:
    """px averaged over factor x factor cells."""
    cell = [F.floor(F.col(c) / factor).cast("int").alias(c) for c in ("row", "col")]
    return px.groupBy(*keys, *cell).agg(F.avg(layer).alias(layer))


def overview_factors(width: int, height: int, least: int = 256) -> list[int]:
    """2, 4, 8, ... while the larger side keeps `least` pixels."""
    out, f = [], 2
    while max(width, height) / f >= least:
        out.append(f)
        f *= 2
    return out


def first_component(px: DataFrame, bands: list[str] = BANDS, keys: list[str] | None = None) -> DataFrame:
    """px with pc1, the first principal component of the standardised bands (of each group); NULL with fewer than ten whole rows. The sign is such that the loadings' sum is not negative.

    One aggregation gives means, deviations and covariances; only its rows, one a group, come to the driver, and go back as loadings.
    """
    keys = keys or []
    whole = F.lit(True)
    for b in bands:
        whole = whole & F.col(b).isNotNull()
    pairs = [(i, j) for i in range(len(bands)) for j in range(i, len(bands))]
    held = px.filter(whole).groupBy(*keys).agg(F.count("*").alias("n"), *[F.avg(b).alias(f"m{i}") for i, b in enumerate(bands)], *[F.stddev_pop(b).alias(f"s{i}") for i, b in enumerate(bands)], *[F.covar_samp(bands[i], bands[j]).alias(f"c{i}_{j}") for i, j in pairs])
    rows = []
    for got in held.filter("n >= 10").collect():
        scale = np.array([got[f"s{i}"] or 1.0 for i in range(len(bands))])
        cov = np.zeros((len(bands), len(bands)))
        for i, j in pairs:
            cov[i, j] = cov[j, i] = got[f"c{i}_{j}"] / scale[i] / scale[j]
        values, vectors = np.linalg.eigh(cov)
        v = vectors[:, int(values.argmax())]
        v = v if v.sum() >= 0 else -v
        rows.append((*[got[k] for k in keys], [float(got[f"m{i}"]) for i in range(len(bands))], [float(x) for x in scale], [float(x) for x in v]))
    kinds = {f.name: f.dataType for f in px.schema}
    numbers = T.ArrayType(T.DoubleType())
    table = px.sparkSession.createDataFrame(rows, T.StructType([T.StructField(k, kinds[k]) for k in keys] + [T.StructField(n, numbers) for n in ("_m", "_s", "_v")]))
    at = lambda c, i: F.get(c, F.lit(i))
    dot = total_of([(F.col(b) - at("_m", i)) / at("_s", i) * at("_v", i) for i, b in enumerate(bands)])
    return joined_on(px, table, keys).withColumn("pc1", F.when(whole, dot)).drop("_m", "_s", "_v")


# ---------------------------------------------------------------- neighbourhoods


def edged(a: np.ndarray, k: int) -> np.ndarray:
    return np.pad(a, k, mode="edge")


def box_sums(a: np.ndarray, size: int) -> np.ndarray:
    """Sums over size x size windows of an array padded by size // 2: one pass along each axis."""
    for axis in (0, 1):
        c = np.cumsum(a, axis=axis)
        zero = np.zeros_like(np.take(c, [0], axis=axis))
        c = np.concatenate([zero, c], axis=axis)
        n = c.shape[axis]
        a = np.take(c, range(size, n), axis=axis) - np.take(c, range(0, n - size), axis=axis)
    return a


def windows(a: np.ndarray, size: int) -> np.ndarray:
    return np.lib.stride_tricks.sliding_window_view(a, (size, size))


def local_mean(a: np.ndarray, size: int) -> np.ndarray:
    """Mean of the valid cells of a window; NaN without any. `a` is padded by size // 2."""
    ok = np.isfinite(a)
    n = box_sums(ok.astype(float), size)
    return np.divide(box_sums(np.where(ok, a, 0.0), size), n, out=np.full(n.shape, np.nan), where=n > 0.5)


def local_variance(a: np.ndarray, size: int) -> np.ndarray:
    return np.maximum(local_mean(a * a, size) - local_mean(a, size) ** 2, 0.0)


def local_extremes(a: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest valid value of a window (infinite without any)."""
    ok = np.isfinite(a)
    return windows(np.where(ok, a, np.inf), size).min(axis=(2, 3)), windows(np.where(ok, a, -np.inf), size).max(axis=(2, 3))


def laplace(a: np.ndarray) -> np.ndarray:
    """4-neighbour Laplacian of an array padded by 1; nodata counts as 0 inside the stencil."""
    f = np.where(np.isfinite(a), a, 0.0)
    return f[:-2, 1:-1] + f[2:, 1:-1] + f[1:-1, :-2] + f[1:-1, 2:] - 4 * f[1:-1, 1:-1]


def sobel(a: np.ndarray) -> np.ndarray:
    """Magnitude of the Sobel gradient of an array padded by 1."""
    f = np.where(np.isfinite(a), a, 0.0)
    smooth_rows, smooth_cols = f[:-2] + 2 * f[1:-1] + f[2:], f[:, :-2] + 2 * f[:, 1:-1] + f[:, 2:]
    return np.hypot(smooth_rows[:, 2:] - smooth_rows[:, :-2], smooth_cols[2:] - smooth_cols[:-2])


#: A focal function takes a tile with its halo (NaN is nodata), the halo, and whether each side (top, bottom, left, right) is the grid's edge.
Focal = Callable[[np.ndarray, int, tuple[bool, bool, bool, bool]], dict[str, np.ndarray]]


def focal(px: DataFrame, keys: list[str], layer: str, halo: int, names: list[str], of: Focal, tile: int = 256, keep: list[str] | None = None) -> DataFrame:
    """keys, row, col and the layers that `of` makes of a layer's neighbourhoods, for every pixel there is.

    Pixels go to their own tile and, within `halo` of its border, to its neighbours; cells beyond the grid repeat its edge. A task
    holds one tile, so memory does not grow with the grid.
    """
    extent = px.groupBy(*keys).agg(F.min("row").alias("_r0"), F.max("row").alias("_r1"), F.min("col").alias("_c0"), F.max("col").alias("_c1"))
    held = joined_on(px.select(*keys, "row", "col", F.col(layer).cast("double").alias("_v")), extent, keys)
    around = lambda c, low, high: F.sequence(F.floor((F.greatest(F.col(c) - halo, F.col(low)) - F.col(low)) / tile), F.floor((F.least(F.col(c) + halo, F.col(high)) - F.col(low)) / tile))
    dealt = held.withColumn("_tr", F.explode(around("row", "_r0", "_r1"))).withColumn("_tc", F.explode(around("col", "_c0", "_c1")))
    kinds = {f.name: f.dataType for f in px.schema}
    schema = T.StructType([T.StructField(k, kinds[k]) for k in [*keys, "row", "col"]] + [T.StructField(n, T.DoubleType()) for n in names])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[0]
        top, left = int(one._r0) + int(one._tr) * tile, int(one._c0) + int(one._tc) * tile
        bottom, right = min(top + tile, int(one._r1) + 1), min(left + tile, int(one._c1) + 1)
        a, b, c, d = max(top - halo, int(one._r0)), min(bottom + halo, int(one._r1) + 1), max(left - halo, int(one._c0)), min(right + halo, int(one._c1) + 1)
        grid = np.full((b - a, d - c), np.nan)
        rows, cols = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        grid[rows - a, cols - c] = pdf["_v"].to_numpy(float)
        grid = np.pad(grid, ((halo - (top - a), halo - (b - bottom)), (halo - (left - c), halo - (d - right))), mode="edge")
        edges = (top == int(one._r0), bottom == int(one._r1) + 1, left == int(one._c0), right == int(one._c1) + 1)
        made = of(grid, halo, edges)
        own = (rows >= top) & (rows < bottom) & (cols >= left) & (cols < right)
        out = pdf.loc[own, [*keys, "row", "col"]].copy()
        for n in names:
            v = made[n][rows[own] - top, cols[own] - left]
            out[n] = pd.Series(np.where(np.isfinite(v), v, np.nan), index=out.index)
        return out

    out = dealt.groupBy(*keys, "_tr", "_tc").applyInPandas(run, schema)
    return out.withColumns({n: F.when(~F.isnan(n), F.col(n)) for n in names})


def local_statistics(size: int) -> tuple[int, list[str], Focal]:
    """mean, var, std and range of size x size windows; nodata near valid cells gets means, but no range."""

    def of(a: np.ndarray, halo: int, edges: tuple) -> dict[str, np.ndarray]:
        k = size // 2
        a = a[halo - k : a.shape[0] - halo + k, halo - k : a.shape[1] - halo + k]
        low, high = local_extremes(a, size)
        var = local_variance(a, size)
        span = np.where(np.isfinite(a[k : a.shape[0] - k, k : a.shape[1] - k]), high - low, np.nan)
        return {"mean": local_mean(a, size), "var": var, "std": np.sqrt(var), "range": span}

    return size // 2, ["mean", "var", "std", "range"], of


def edges_of(a: np.ndarray, halo: int, edges: tuple) -> dict[str, np.ndarray]:
    """laplacian and gradient, NaN on nodata."""
    a = a[halo - 1 : a.shape[0] - halo + 1, halo - 1 : a.shape[1] - halo + 1]
    ok = np.isfinite(a[1:-1, 1:-1])
    return {"laplacian": np.where(ok, laplace(a), np.nan), "gradient": np.where(ok, sobel(a), np.nan)}


TERRAIN = ["dem", "slope", "aspect_sin", "aspect_cos", "curvature", "tpi", "roughness", "tri"]


def terrain_of(dx: float, dy: float, fill: float, tpi_size: int = 11, tri_size: int = 3) -> tuple[int, list[str], Focal]:
    """Slope in degrees, aspect, curvature, topographic position, roughness and ruggedness of a height layer; fill stands for nodata (the grid's mean)."""

    def of(a: np.ndarray, halo: int, edges: tuple) -> dict[str, np.ndarray]:
        inner = (slice(halo, -halo), slice(halo, -halo))
        dem = a[inner]
        f = np.where(np.isfinite(a), a, fill)
        one = f[halo - 1 : f.shape[0] - halo + 1, halo - 1 : f.shape[1] - halo + 1]
        gy, gx = (one[2:, 1:-1] - one[:-2, 1:-1]) / (2 * dy), (one[1:-1, 2:] - one[1:-1, :-2]) / (2 * dx)
        core = one[1:-1, 1:-1]
        # One-sided differences where the grid ends.
        if edges[0] and core.shape[0] > 1:
            gy[0] = (core[1] - core[0]) / dy
        if edges[1] and core.shape[0] > 1:
            gy[-1] = (core[-1] - core[-2]) / dy
        if edges[2] and core.shape[1] > 1:
            gx[:, 0] = (core[:, 1] - core[:, 0]) / dx
        if edges[3] and core.shape[1] > 1:
            gx[:, -1] = (core[:, -1] - core[:, -2]) / dx
        aspect = np.arctan2(-gx, gy)
        wide, k = tpi_size // 2, tri_size // 2
        around = a[halo - wide : a.shape[0] - halo + wide, halo - wide : a.shape[1] - halo + wide]
        near = f[halo - k : f.shape[0] - halo + k, halo - k : f.shape[1] - halo + k]
        low, high = local_extremes(near, tri_size)
        rugged = np.sqrt(((windows(near, tri_size) - core[:, :, None, None]) ** 2).mean(axis=(2, 3)))
        out = {
            "dem": dem, "slope": np.degrees(np.arctan(np.hypot(gx, gy))), "aspect_sin": np.sin(aspect), "aspect_cos": np.cos(aspect),
            "curvature": laplace(a[halo - 1 : a.shape[0] - halo + 1, halo - 1 : a.shape[1] - halo + 1]), "tpi": dem - local_mean(around, tpi_size), "roughness": high - low, "tri": rugged,
        }
        return {n: np.where(np.isfinite(dem), v, np.nan) for n, v in out.items()}

    return max(tpi_size // 2, tri_size // 2, 1), TERRAIN, of


def terrain(px: DataFrame, keys: list[str], layer: str, dx: float, dy: float) -> DataFrame:
    fill = px.agg(F.avg(layer)).first()[0] or 0.0
    halo, names, of = terrain_of(dx, dy, fill)
    return focal(px, keys, layer, halo, names, of)


GLCM = ["contrast", "homogeneity", "dissimilarity", "entropy"]


def cooccurrence(levels: np.ndarray, n: int) -> dict[str, np.ndarray]:
    """Metrics of the grey-level co-occurrence of windows (count x size x size): distance 1, four angles, symmetric; means over angles, entropy of all angles together."""
    h, count = levels.shape[1], levels.shape[0]
    i, j = np.mgrid[0:n, 0:n]
    sums = dict.fromkeys(GLCM[:3], 0.0)
    p_all = []
    for dr, dc in ((0, 1), (-1, 1), (-1, 0), (-1, -1)):
        a = levels[:, max(0, -dr) : h - max(0, dr), max(0, -dc) : h - max(0, dc)].reshape(count, -1)
        b = levels[:, max(0, dr) : h + min(0, dr), max(0, dc) : h + min(0, dc)].reshape(count, -1)
        flat = (np.arange(count)[:, None] * n + a) * n + b
        m = np.bincount(flat.ravel(), minlength=count * n * n).reshape(count, n, n).astype(float)
        m += m.transpose(0, 2, 1)
        m /= np.maximum(m.sum(axis=(1, 2), keepdims=True), 1)
        p_all.append(m)
        for name, w in (("contrast", (i - j) ** 2), ("homogeneity", 1 / (1 + (i - j) ** 2)), ("dissimilarity", np.abs(i - j))):
            sums[name] = sums[name] + (m * w).sum(axis=(1, 2)) / 4
    p = np.stack(p_all, axis=1)
    p = p / np.maximum(p.sum(axis=(1, 2, 3), keepdims=True), 1e-12)
    return sums | {"entropy": -(p * np.log2(np.maximum(p, 1e-12))).sum(axis=(1, 2, 3))}


def glcm(px: DataFrame, keys: list[str], layer: str, window: int, levels: int = 16, sample: int = 2, stride: int = 2, tile: int = 128) -> DataFrame:
    """Texture of a layer at its sampled window centres: keys, row, col (of the sampled pixel in the full grid) and the four metrics.

    The layer is sampled every `sample` pixels and quantised; windows start every `stride` samples. spread() brings the lattice back to every pixel.
    """
    every = px.filter((F.pmod("row", F.lit(sample)) == 0) & (F.pmod("col", F.lit(sample)) == 0))
    small = quantised(every, keys, layer, levels).select(*keys, (F.col("row") / sample).cast("int").alias("row"), (F.col("col") / sample).cast("int").alias("col"), "level")
    half = window // 2
    extent = small.groupBy(*keys).agg((F.max("row") + 1).alias("_h"), (F.max("col") + 1).alias("_w"))
    held = joined_on(small, extent, keys)
    # A window belongs to the tile of its first cell; a cell may lie in windows of the tile before its own.
    dealt = held.withColumn("_tr", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("row") - window + 1) / tile)), F.floor(F.col("row") / tile)))).withColumn("_tc", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("col") - window + 1) / tile)), F.floor(F.col("col") / tile))))
    kinds = {f.name: f.dataType for f in px.schema}
    schema = T.StructType([T.StructField(k, kinds[k]) for k in keys] + [T.StructField(k, T.IntegerType()) for k in ("row", "col")] + [T.StructField(n, T.DoubleType()) for n in GLCM])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[0]
        top, left, h, w = int(one._tr) * tile, int(one._tc) * tile, int(one._h), int(one._w)
        starts = [np.array([s for s in range(-(-a // stride) * stride, a + tile, stride) if s + window <= n], int) for a, n in ((top, h), (left, w))]
        grid = np.zeros((tile + window, tile + window), np.int64)
        grid[pdf["row"] - top, pdf["col"] - left] = pdf["level"]
        if not len(starts[0]) or not len(starts[1]):
            return pd.DataFrame(columns=schema.names)
        views = windows(grid, window)[starts[0] - top][:, starts[1] - left].reshape(-1, window, window)
        r, c = (x.ravel() for x in np.meshgrid((starts[0] + half) * sample, (starts[1] + half) * sample, indexing="ij"))
        out = pd.DataFrame({"row": r, "col": c} | cooccurrence(views, levels))
        for k in keys:
            out[k] = one[k]
        return out[schema.names]

    return dealt.groupBy(*keys, "_tr", "_tc").applyInPandas(run, schema)


def spread(px: DataFrame, lattice: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """keys, row, col and the lattice's values at every pixel, from the nearest lattice point (rows and columns are clamped to it)."""
    axes = lattice.groupBy(*keys).agg(*[x for c in ("row", "col") for x in (F.min(c).alias(f"_{c}0"), F.max(c).alias(f"_{c}1"), F.count_distinct(c).alias(f"_{c}n"))])
    held = joined_on(px.select(*keys, "row", "col"), axes, keys)

    def nearest(c: str) -> Column:
        step = F.when(F.col(f"_{c}n") > 1, (F.col(f"_{c}1") - F.col(f"_{c}0")) / (F.col(f"_{c}n") - 1)).otherwise(F.lit(1.0))
        at = F.ceil((F.col(c) - F.col(f"_{c}0")) / step - 0.5)
        return (F.col(f"_{c}0") + F.least(F.greatest(at, F.lit(0)), F.col(f"_{c}n") - 1) * step).cast("int")

    held = held.withColumns({"_lr": nearest("row"), "_lc": nearest("col")})
    return held.join(lattice.withColumnsRenamed({"row": "_lr", "col": "_lc"}), [*keys, "_lr", "_lc"], "left").select(*keys, "row", "col", *names)


# ---------------------------------------------------------------- components


def label_tile(mask: np.ndarray) -> np.ndarray:
    """4-neighbour component numbers from 1 by two passes over runs; 0 outside the mask."""
    parent = [0]

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = np.zeros(mask.shape, np.int64)
    for r in range(mask.shape[0]):
        padded = np.concatenate([[0], mask[r].astype(np.int8), [0]])
        for a, b in zip(np.flatnonzero(np.diff(padded) == 1), np.flatnonzero(np.diff(padded) == -1), strict=True):
            above = {root(int(x)) for x in np.unique(out[r - 1, a:b]) if x} if r else set()
            if above:
                best = min(above)
                for x in above:
                    parent[x] = best
            else:
                best = len(parent)
                parent.append(best)
            out[r, a:b] = best
    flat = np.array([root(i) for i in range(len(parent))])
    return flat[out]


def merged(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root): the least node that each node of the edges (a, b) is linked to; labels spread over edges and jump to their label's label until none moves."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    held = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    for _ in range(most):
        labels = held.select("node", "root")
        near = both.join(labels.select(F.col("node").alias("b"), F.col("root").alias("r")), "b").groupBy(F.col("a").alias("node")).agg(F.min("r").alias("r"))
        step = labels.join(near, "node").select("node", F.least("root", "r").alias("root"), (F.col("r") < F.col("root")).alias("moved"))
        jump = step.select(F.col("node").alias("root"), F.col("root").alias("up"))
        new = written(step.join(jump, "root", "left").select("node", F.least("root", F.coalesce("up", "root")).alias("root"), (F.col("moved") | (F.col("up") < F.col("root"))).alias("moved")), "labels")
        dropped(held)
        held = new
        if not held.filter("moved").limit(1).count():
            dropped(both)
            return held.select("node", "root")
    raise RuntimeError("components did not settle")


def components(px: DataFrame, keys: list[str], mask: str, tile: int = 256) -> DataFrame:
    """keys, row, col and comp_id of the mask's pixels: 4-neighbour components, numbered by the code of a pixel of theirs.

    Tiles are labelled each for itself; labels that touch across tile borders are merged, and only those pairs leave the tiles.
    """
    held = px.filter(F.col(mask) > 0).select(*keys, "row", "col")
    kinds = {f.name: f.dataType for f in px.schema}
    schema = T.StructType([T.StructField(k, kinds[k]) for k in [*keys, "row", "col"]] + [T.StructField("local", T.StringType())])

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        r0, c0 = int(pdf["row"].min()), int(pdf["col"].min())
        grid = np.zeros((int(pdf["row"].max()) - r0 + 1, int(pdf["col"].max()) - c0 + 1), bool)
        at = pdf["row"].to_numpy() - r0, pdf["col"].to_numpy() - c0
        grid[at] = True
        labels = label_tile(grid)
        # A component is named by its first pixel in reading order, with leading zeros so names sort as places do.
        first: dict[int, str] = {}
        for r, c in zip(*np.nonzero(labels), strict=True):
            first.setdefault(int(labels[r, c]), f"{r + r0:010d}:{c + c0:010d}")
        out = pdf[[*keys, "row", "col"]].copy()
        out["local"] = [first[int(x)] for x in labels[at]]
        return out

    labelled = checkpointed(held.withColumns({"_tr": F.floor(F.col("row") / tile), "_tc": F.floor(F.col("col") / tile)}).groupBy(*keys, "_tr", "_tc").applyInPandas(run, schema))
    node = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], "local")
    named = labelled.withColumn("node", node)
    border = named.filter((F.pmod("row", F.lit(tile)).isin(0, tile - 1)) | (F.pmod("col", F.lit(tile)).isin(0, tile - 1)))
    pairs = None
    for r, c in ((1, 0), (0, 1)):
        near = border.select(*keys, (F.col("row") - r).alias("row"), (F.col("col") - c).alias("col"), F.col("node").alias("other"))
        hit = border.join(near, [*keys, "row", "col"]).filter("node <> other").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
        pairs = hit if pairs is None else pairs.union(hit)
    roots = merged(pairs)
    return named.join(roots, "node", "left").select(*keys, "row", "col", F.coalesce("root", "node").alias("comp_id"))


# ---------------------------------------------------------------- resampling


def resampled(source: DataFrame, target: DataFrame, layer: str, to_source: tuple[float, float, float, float, float, float], method: str = "bilinear") -> DataFrame:
    """target's row and col with the source layer's value there: to_source is the affine map (a, b, c, d, e, f) from a target cell's (col, row) to the source's.

    Bilinear over the four cells around, weights of nodata cells left out; or the nearest cell. An equi-join on source cells.
    """
    a, b, c, d, e, f = to_source
    x, y = F.col("col") * a + F.col("row") * b + c, F.col("col") * d + F.col("row") * e + f
    at = target.select("row", "col", x.alias("_x"), y.alias("_y"))
    cells = source.select(F.col("row").alias("_r"), F.col("col").alias("_c"), F.col(layer).alias("_v"))
    if method == "nearest":
        near = at.withColumns({"_c": F.floor(F.col("_x") + 0.5).cast("int"), "_r": F.floor(F.col("_y") + 0.5).cast("int")})
        return near.join(cells, ["_r", "_c"], "left").select("row", "col", F.col("_v").alias(layer))
    x0, y0 = F.floor("_x"), F.floor("_y")
    fx, fy = F.col("_x") - x0, F.col("_y") - y0
    corners = F.array(*[F.struct((y0 + i).cast("int").alias("_r"), (x0 + j).cast("int").alias("_c"), ((fy if i else 1 - fy) * (fx if j else 1 - fx)).alias("_w")) for i in (0, 1) for j in (0, 1)])
    near = at.withColumn("_k", F.explode(corners)).select("row", "col", "_k.*").filter("_w > 0")
    got = near.join(cells, ["_r", "_c"]).filter("_v is not null").groupBy("row", "col").agg(F.try_divide(F.sum(F.col("_w") * F.col("_v")), F.sum("_w")).alias(layer))
    return target.select("row", "col").join(got, ["row", "col"], "left")
