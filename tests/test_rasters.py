import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.operators import raster
from loamline.plans import stages


def frame(spark, a, name="v"):
    h, w = a.shape
    r, c = np.mgrid[0:h, 0:w]
    rows = [(int(i), int(j), None if not np.isfinite(x) else float(x)) for i, j, x in zip(r.ravel(), c.ravel(), a.ravel(), strict=True)]
    return spark.createDataFrame(rows, f"row int, col int, {name} double")


def grid(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.collect():
        v = r[name]
        out[r["row"], r["col"]] = np.nan if v is None else v
    return out


def sample(seed=1, shape=(37, 29)):
    rng = np.random.default_rng(seed)
    a = np.cumsum(rng.normal(size=shape), axis=0) + 10
    a[rng.random(shape) < 0.05] = np.nan
    return a


@pytest.mark.parametrize("size", [3, 7])
def test_local_statistics_do_not_depend_on_tiles(spark, size):
    a = sample()
    halo, names, of = raster.local_statistics(size)
    k = size // 2
    p = np.pad(a, k, mode="edge")
    win = np.lib.stride_tricks.sliding_window_view(p, (size, size))
    with np.errstate(all="ignore"):
        mean, low, high = np.nanmean(win, axis=(2, 3)), np.nanmin(win, axis=(2, 3)), np.nanmax(win, axis=(2, 3))
        var = np.maximum(np.nanmean(win**2, axis=(2, 3)) - mean**2, 0)
    for tile in (8, 64):
        out = raster.focal(frame(spark, a), [], "v", halo, names, of, tile=tile)
        assert np.allclose(grid(out, "mean", a.shape), mean, equal_nan=True)
        assert np.allclose(grid(out, "var", a.shape), var, atol=1e-9, equal_nan=True)
        assert np.allclose(grid(out, "range", a.shape), np.where(np.isfinite(a), high - low, np.nan), equal_nan=True)


def test_terrain(spark):
    a = sample(2)
    fill = np.nanmean(a)
    f = np.where(np.isfinite(a), a, fill)
    gy, gx = np.gradient(f, 2.0, 3.0)
    pad = np.pad(f, 1, mode="edge")
    win = np.lib.stride_tricks.sliding_window_view(pad, (3, 3))
    wide = np.lib.stride_tricks.sliding_window_view(np.pad(a, 5, mode="edge"), (11, 11))
    zero = np.pad(np.where(np.isfinite(a), a, 0.0), 1, mode="edge")
    want = {
        "dem": a, "slope": np.degrees(np.arctan(np.hypot(gx, gy))), "aspect_sin": np.sin(np.arctan2(-gx, gy)), "aspect_cos": np.cos(np.arctan2(-gx, gy)),
        "curvature": zero[:-2, 1:-1] + zero[2:, 1:-1] + zero[1:-1, :-2] + zero[1:-1, 2:] - 4 * zero[1:-1, 1:-1], "tpi": a - np.nanmean(wide, axis=(2, 3)),
        "roughness": win.max(axis=(2, 3)) - win.min(axis=(2, 3)), "tri": np.sqrt(((win - f[:, :, None, None]) ** 2).mean(axis=(2, 3))),
    }
    halo, names, of = raster.terrain_of(3.0, 2.0, fill)
    for tile in (10, 256):
        out = raster.focal(frame(spark, a), [], "v", halo, names, of, tile=tile)
        for n, w in want.items():
            assert np.allclose(grid(out, n, a.shape), np.where(np.isfinite(a), w, np.nan), equal_nan=True), n


def test_components(spark):
    rng = np.random.default_rng(3)
    a = (rng.random((50, 45)) < 0.55).astype(float)
    labels = np.zeros(a.shape, int)
    n = 0
    for start in zip(*np.nonzero(a), strict=True):
        if not labels[start]:
            n += 1
            todo = [start]
            labels[start] = n
            while todo:
                r, c = todo.pop()
                for q in ((r + 1, c), (r - 1, c), (r, c + 1), (r, c - 1)):
                    if 0 <= q[0] < 50 and 0 <= q[1] < 45 and a[q] and not labels[q]:
                        labels[q] = n
                        todo.append(q)
    for tile in (7, 256):
        got = raster.components(frame(spark, a), [], "v", tile).collect()
        pairs = {(labels[r["row"], r["col"]], r["comp_id"]) for r in got}
        assert len(got) == int(a.sum()) and len(pairs) == n == len({p[1] for p in pairs})
    diagonal = np.eye(4)
    assert len({r["comp_id"] for r in raster.components(frame(spark, diagonal), [], "v").collect()}) == 4
    assert raster.components(frame(spark, np.zeros((3, 3))), [], "v").count() == 0


def test_glcm_against_a_loop(spark):
    a = sample(4, (40, 36))
    small = a[::2, ::2]
    lo, hi = np.nanpercentile(small, [1, 99])
    q = np.where(np.isfinite(small), np.rint(np.clip((small - lo) / (hi - lo), 0, 1) * 15), 0).astype(int)
    want = {}
    for i in range(0, q.shape[0] - 4, 2):
        for j in range(0, q.shape[1] - 4, 2):
            win = q[i : i + 5, j : j + 5]
            mats = []
            for dr, dc in ((0, 1), (-1, 1), (-1, 0), (-1, -1)):
                m = np.zeros((16, 16))
                for r in range(5):
                    for c in range(5):
                        if 0 <= r + dr < 5 and 0 <= c + dc < 5:
                            m[win[r, c], win[r + dr, c + dc]] += 1
                            m[win[r + dr, c + dc], win[r, c]] += 1
                mats.append(m / m.sum())
            d = np.subtract.outer(np.arange(16), np.arange(16))
            p = np.array(mats) / 4
            want[(i + 2) * 2, (j + 2) * 2] = [np.mean([(m * d**2).sum() for m in mats]), np.mean([(m / (1 + d**2)).sum() for m in mats]), np.mean([(m * abs(d)).sum() for m in mats]), -(p * np.log2(np.maximum(p, 1e-12))).sum()]
    for tile in (4, 128):
        got = {(r["row"], r["col"]): [r[n] for n in raster.GLCM] for r in raster.glcm(frame(spark, a), [], "v", 5, tile=tile).collect()}
        assert got.keys() == want.keys()
        assert np.allclose(np.array([got[k] for k in want]), np.array(list(want.values())))
    full = raster.spread(frame(spark, a), raster.glcm(frame(spark, a), [], "v", 5), [], raster.GLCM)
    assert full.filter("contrast is null").count() == 0 and full.count() == a.size


def test_first_component(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(300, 1)) @ rng.normal(size=(1, 4)) + rng.normal(size=(300, 4)) * 0.2
    df = spark.createDataFrame([(i, 0, *map(float, v)) for i, v in enumerate(x)] + [(300, 0, None, 1.0, 1.0, 1.0)], "row int, col int, blue double, green double, red double, nir double")
    z = (x - x.mean(0)) / x.std(0)
    w, v = np.linalg.eigh(np.cov(z.T))
    v = v[:, -1] if v[:, -1].sum() >= 0 else -v[:, -1]
    got = grid(raster.first_component(df), "pc1", (301, 1))[:, 0]
    assert np.allclose(got[:300], z @ v) and np.isnan(got[300])
    few = raster.first_component(df.limit(5))
    assert few.filter("pc1 is not null").count() == 0


def test_constant_layers_and_missing_deltas(spark):
    df = frame(spark, np.full((4, 4), 2.0)).withColumn("k", F.lit(1))
    from loamline.functions.stats import with_robust_unit

    assert {r.u for r in with_robust_unit(df, ["k"], {"u": "v"}).collect()} == {0.0}
    none = df.withColumns({"delta_ndvi": F.lit(None).cast("double"), "delta_ndwi": F.lit(None).cast("double"), "water_growth": F.lit(1.0)})
    assert {r.change for r in raster.change_mask(none, ["k"]).collect()} == {0}


def test_the_self_test_scenes(spark):
    """End to end, with values against NumPy."""
    pixels, zones, dem = stages.test_scenes(spark)
    px, table = stages.raster_run(pixels, zones, dem, stages.RasterSettings(water_threshold=0.0))
    px = px.cache()
    rows = {(r.year, r.parcel_id): r for r in table.collect()}
    assert set(rows) == {(y, z) for y in (2022, 2023) for z in (1, 2)}
    x, y = np.meshgrid(np.linspace(0, 1, 48), np.linspace(0, 1, 48))

    def bands(s):
        wet = (x - 0.7) ** 2 + (y - 0.3) ** 2 < (0.12 + s / 2) ** 2
        return np.where(wet, 0.12, 0) + 0.15 + 0.05 * x, np.where(wet, -0.04, 0) + 0.18 + 0.05 * y + s, np.where(wet, -0.20, 0) + 0.35 + 0.08 * x - 0.04 * y - s

    first = bands(0.0)
    second = [np.median([p, q], axis=0) for p, q in zip(bands(0.03), bands(0.05), strict=True)]
    ndvi = {yr: (b[2] - b[1]) / (b[2] + b[1] + 1e-6) for yr, b in ((2022, first), (2023, second))}
    water = {yr: ((b[0] - b[2]) / (b[0] + b[2] + 1e-6) > 0).astype(int) for yr, b in ((2022, first), (2023, second))}
    c, r = np.meshgrid(np.arange(48) + 0.5, np.arange(48) + 0.5)
    boxes = {1: (4.8, 24.0, 24.0, 43.2), 2: (24.0, 9.6, 43.2, 38.4)}
    for (yr, z), got in rows.items():
        x0, y0, x1, y1 = boxes[z]
        inside = (c > x0) & (c < x1) & (r > y0) & (r < y1)
        assert got.n_px == inside.sum()
        assert abs(got.ndvi_mean - ndvi[yr][inside].mean()) < 1e-9 and abs(got.ndvi_p90 - np.percentile(ndvi[yr][inside], 90)) < 1e-9
        assert abs(got.water_share - water[yr][inside].mean()) < 1e-12
        if yr == 2023:
            assert abs(got.delta_ndvi_mean - (ndvi[2023] - ndvi[2022])[inside].mean()) < 1e-9
        else:
            assert got.delta_ndvi_mean is None and got.change_share == 0
        assert 0 <= got.risk_score_min <= got.risk_score_max <= 1 and 0 <= got.hotspot_share <= 1
    spots = px.filter("comp_id is not null")
    assert spots.count() == px.filter("hotspot = 1").count()


def test_overview_factors():
    assert raster.overview_factors(2000, 100) == [2, 4] and raster.overview_factors(100, 100) == []


def test_palette_rounds_half_to_even(spark):
    df = spark.createDataFrame([(0, 0, 0.25), (0, 1, 0.75), (0, 2, None), (0, 3, 9.0)], "row int, col int, v double")
    palette = spark.createDataFrame([(i, i, i, i) for i in range(3)], "idx int, r int, g int, b int")
    got = {r["col"]: (r.r, r.alpha) for r in raster.colours(df, "v", palette, 3, 0.0, 1.0).collect()}
    assert got == {0: (0, 255), 1: (2, 255), 2: (0, 0), 3: (2, 255)}


