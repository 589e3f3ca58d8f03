"""Geometry as nested arrays: a multipolygon is an array of polygons, a polygon an array of rings, a ring an array of (x, y).

Parsing, bounds, areas, centroids, projections and point tests are expressions on those arrays; overlays of two polygons cut both into
horizontal slabs between which no edges cross, where even-odd inside and outside are plain intervals (NumPy, Arrow batches).
"""

from __future__ import annotations

import math
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
MULTI = T.ArrayType(T.ArrayType(T.ArrayType(POINT)))

# ---------------------------------------------------------------- text forms


def from_wkt(wkt: Column) -> Column:
    """Multipolygon of a POLYGON or MULTIPOLYGON text; NULL for anything else, blank or broken."""
    number = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
    text = F.upper(F.trim(wkt))
    body = F.regexp_extract(text, r"^(?:MULTI)?POLYGON\s*(?:Z\s*)?(\(.*\))$", 1)
    body = F.regexp_replace(body, rf"({number})\s+({number})(?:\s+{number})?", r'{"x":$1,"y":$2}')
    body = F.translate(body, "()", "[]")
    body = F.when(text.startswith("POLYGON"), F.concat(F.lit("["), body, F.lit("]"))).when(text.startswith("MULTIPOLYGON"), body)
    return F.from_json(body, MULTI)


def from_geojson(geometry: Column) -> Column:
    """Multipolygon of a GeoJSON geometry text of type Polygon or MultiPolygon."""
    kind = F.get_json_object(geometry, "$.type")
    raw = F.get_json_object(geometry, "$.coordinates")
    deep = F.from_json(F.when(kind == "Polygon", F.concat(F.lit("["), raw, F.lit("]"))).when(kind == "MultiPolygon", raw), "array<array<array<array<double>>>>")
    return mapped(deep, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))


def to_geojson(geometry: Column) -> Column:
    return F.to_json(F.struct(F.lit("MultiPolygon").alias("type"), mapped(geometry, lambda p: F.array(p["x"], p["y"])).alias("coordinates")))


def mapped(geometry: Column, of) -> Column:
    """Every point replaced by of(point)."""
    return F.transform(geometry, lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, of)))


def box(x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    at = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(F.array(at(x0, y0), at(x1, y0), at(x1, y1), at(x0, y1), at(x0, y0))))


# ---------------------------------------------------------------- measures


def points(geometry: Column) -> Column:
    return F.flatten(F.flatten(geometry))


def bounds(geometry: Column) -> dict[str, Column]:
    """xmin, ymin, xmax and ymax."""
    xs, ys = F.transform(points(geometry), lambda p: p["x"]), F.transform(points(geometry), lambda p: p["y"])
    return {"xmin": F.array_min(xs), "ymin": F.array_min(ys), "xmax": F.array_max(xs), "ymax": F.array_max(ys)}


def is_empty(geometry: Column) -> Column:
    return F.coalesce(F.size(points(geometry)) == 0, F.lit(True))


def steps(ring: Column) -> Column:
    """(point, next point) of a ring, closed if it isn't."""
    n = F.size(ring)
    return F.zip_with(ring, F.concat(F.slice(ring, 2, F.greatest(n - 1, F.lit(0))), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def ring_sum(ring: Column, of) -> Column:
    return F.aggregate(steps(ring), F.lit(0.0), lambda total, e: total + of(e["a"]["x"], e["a"]["y"], e["b"]["x"], e["b"]["y"]))


def ring_area(ring: Column) -> Column:
    """Signed by orientation."""
    return ring_sum(ring, lambda ax, ay, bx, by: ax * by - bx * ay) / 2


def area(geometry: Column) -> Column:
    """Outer rings less their holes, whatever the orientation."""
    polygon = lambda p: F.aggregate(F.transform(p, lambda ring, i: F.when(i == 0, F.abs(ring_area(ring))).otherwise(-F.abs(ring_area(ring)))), F.lit(0.0), lambda a, x: a + x)
    return F.aggregate(F.transform(geometry, polygon), F.lit(0.0), lambda a, x: a + x)


def centroid(geometry: Column) -> Column:
    """Area-weighted centroid as (x, y); NULL without area."""

    def moment(axis: str) -> Column:
        def of_ring(ring: Column, i: Column) -> Column:
            cross = ring_sum(ring, lambda ax, ay, bx, by: ((ax + bx) if axis == "x" else (ay + by)) * (ax * by - bx * ay))
            return cross / 6 * F.when((ring_area(ring) >= 0) == (i == 0), F.lit(1.0)).otherwise(F.lit(-1.0))

        polygon = lambda p: F.aggregate(F.transform(p, of_ring), F.lit(0.0), lambda a, x: a + x)
        return F.aggregate(F.transform(geometry, polygon), F.lit(0.0), lambda a, x: a + x)

    return F.when(area(geometry) > 0, F.struct((moment("x") / area(geometry)).alias("x"), (moment("y") / area(geometry)).alias("y")))


def contains(geometry: Column, x: Column, y: Column) -> Column:
    """Even-odd test: a ray to the right crosses the edges an odd number of times. Lower and left edges are inside, upper and right ones are not."""
    crossings = lambda ring: F.aggregate(steps(ring), F.lit(0), lambda n, e: n + F.when(((e["a"]["y"] > y) != (e["b"]["y"] > y)) & (x < (e["b"]["x"] - e["a"]["x"]) * (y - e["a"]["y"]) / F.nullif(e["b"]["y"] - e["a"]["y"], F.lit(0.0)) + e["a"]["x"]), 1).otherwise(0))
    total = F.aggregate(F.flatten(F.transform(geometry, lambda p: F.transform(p, crossings))), F.lit(0), lambda a, n: a + n)
    return F.coalesce(F.pmod(total, F.lit(2)) == 1, F.lit(False))


def boxes_intersect(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Boxes that share some area or touch are told apart: touching is not enough."""
    return (a["xmin"] < b["xmax"]) & (b["xmin"] < a["xmax"]) & (a["ymin"] < b["ymax"]) & (b["ymin"] < a["ymax"])


def box_area(a: dict[str, Column]) -> Column:
    return F.greatest(a["xmax"] - a["xmin"], F.lit(0.0)) * F.greatest(a["ymax"] - a["ymin"], F.lit(0.0))


def box_overlap(a: dict[str, Column], b: dict[str, Column]) -> Column:
    """Area that two boxes share; NULL if a bound is."""
    w, h = (F.least(a[f"{c}max"], b[f"{c}max"]) - F.greatest(a[f"{c}min"], b[f"{c}min"]) for c in "xy")
    known = F.lit(True)
    for s in (a, b):
        for c in ("xmin", "ymin", "xmax", "ymax"):
            known = known & s[c].isNotNull()
    return F.when(known, F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0)))


# ---------------------------------------------------------------- projections

# Fixed values of the ellipsoid WGS 84 and of projections (their EPSG codes).
AXIS, FLAT = 6378137.0, 1 / 298.257223563
E2 = FLAT * (2 - FLAT)
GEOGRAPHIC, MERCATOR, EQUAL_AREA = 4326, 3857, 6933


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * AXIS, F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * AXIS


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / AXIS), F.degrees(2 * F.atan(F.exp(y / AXIS)) - F.lit(math.pi / 2))


def to_equal_area(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Cylindrical equal-area with standard parallels at 30 degrees."""
    e, s30 = math.sqrt(E2), math.sin(math.radians(30))
    k0 = math.cos(math.radians(30)) / math.sqrt(1 - E2 * s30 * s30)
    s = F.sin(F.radians(lat))
    q = (1 - E2) * (s / (1 - E2 * s * s) - F.ln((1 - e * s) / (1 + e * s)) / (2 * e))
    return F.radians(lon) * (AXIS * k0), q * (AXIS / (2 * k0))


def to_utm(lon: Column, lat: Column, zone: int) -> tuple[Column, Column]:
    """Transverse Mercator of a northern UTM zone, by the usual series in the third flattening."""
    n = FLAT / (2 - FLAT)
    radius = AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    alpha = (n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16, 13 * n**2 / 48 - 3 * n**3 / 5, 61 * n**3 / 240)
    c = 2 * math.sqrt(n) / (1 + n)
    s = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(s) - c * F.atanh(c * s))
    dl = F.radians(lon - (zone * 6 - 183))
    xi, eta = F.atan2(t, F.cos(dl)), F.atanh(F.sin(dl) / F.sqrt(1 + t * t))
    east, north = eta, xi
    for j, a in enumerate(alpha, 1):
        east, north = east + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta), north + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return east * (radius * 0.9996) + 500000.0, north * (radius * 0.9996)


def projector(source: int, target: int):
    """A function of (x, y) columns between EPSG codes 4326, 3857, 6933 (target only) and UTM north (326zz, target only)."""
    if source == target:
        return lambda x, y: (x, y)
    back = {GEOGRAPHIC: lambda x, y: (x, y), MERCATOR: from_mercator}.get(source)
    out = {GEOGRAPHIC: lambda x, y: (x, y), MERCATOR: to_mercator, EQUAL_AREA: to_equal_area}.get(target)
    if out is None and 32601 <= target <= 32660:
        out = lambda x, y: to_utm(x, y, target - 32600)
    if back is None or out is None:
        raise ValueError(f"no way from EPSG:{source} to EPSG:{target}")
    return lambda x, y: out(*back(x, y))


def projected(geometry: Column, source: int, target: int) -> Column:
    to = projector(source, target)

    def of(p: Column) -> Column:
        x, y = to(p["x"], p["y"])
        return F.struct(x.alias("x"), y.alias("y"))

    return geometry if source == target else mapped(geometry, of)


def projected_bounds(b: dict[str, Column], source: int, target: int, n: int = 21) -> dict[str, Column]:
    """Bounds of a box's projected outline, each side divided by n points."""
    to = projector(source, target)
    steps_ = F.transform(F.sequence(F.lit(0), F.lit(n)), lambda i: i / F.lit(float(n)))
    along = lambda c: F.transform(steps_, lambda t: b[f"{c}min"] + (b[f"{c}max"] - b[f"{c}min"]) * t)
    xs, ys = along("x"), along("y")
    at = lambda x, y: F.struct(*[v.alias(n) for n, v in zip("xy", to(x, y), strict=True)])
    level = lambda y: F.transform(xs, lambda x: at(x, y))
    upright = lambda x: F.transform(ys, lambda y: at(x, y))
    rim = F.concat(level(b["ymin"]), level(b["ymax"]), upright(b["xmin"]), upright(b["xmax"]))
    return {"xmin": F.array_min(F.transform(rim, lambda p: p["x"])), "ymin": F.array_min(F.transform(rim, lambda p: p["y"])), "xmax": F.array_max(F.transform(rim, lambda p: p["x"])), "ymax": F.array_max(F.transform(rim, lambda p: p["y"]))}


def area_km2(geometry: Column, source: int = GEOGRAPHIC) -> Column:
    return area(projected(geometry, source, EQUAL_AREA)) / 1e6


# ---------------------------------------------------------------- overlays

Shape = list[list[list[tuple[float, float]]]]


def edges_of(shape: Shape) -> np.ndarray:
    """Edges (x0, y0, x1, y1) with y0 < y1; level ones don't matter to even-odd slabs."""
    out = [(*p, *q) if p[1] < q[1] else (*q, *p) for polygon in shape for ring in polygon for p, q in pairwise([*ring, ring[0]]) if p[1] != q[1]] if shape else []
    return np.array(out, float).reshape(-1, 4)


def crossings(edges: np.ndarray, at_once: int = 256) -> np.ndarray:
    """Heights at which edges cross. Edges are compared in blocks by their lower ends, each with those that begin below the block's top: memory grows with the edges, not their square."""
    e = edges[np.argsort(edges[:, 1], kind="stable")]
    out = [np.zeros(0)]
    for i in range(0, len(e), at_once):
        a = e[i : i + at_once]
        b = e[i : int(np.searchsorted(e[:, 1], a[:, 3].max(), "right"))]
        b = b[b[:, 3] >= a[0, 1]]
        d, f = a[:, None, 2:] - a[:, None, :2], b[None, :, 2:] - b[None, :, :2]
        cross = d[..., 0] * f[..., 1] - d[..., 1] * f[..., 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            w = b[None, :, :2] - a[:, None, :2]
            t, u = (w[..., 0] * f[..., 1] - w[..., 1] * f[..., 0]) / cross, (w[..., 0] * d[..., 1] - w[..., 1] * d[..., 0]) / cross
        ok = (cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        out.append((a[:, None, 1] + t * d[..., 1])[ok])
    return np.concatenate(out)


def overlay(shapes: list[Shape], keep) -> Shape:
    """The plane where keep([inside each shape]) holds, as trapezoids that may share borders.

    Each shape is read by the even-odd rule, so a self-crossing outline comes out valid.
    """
    edges = [edges_of(s) for s in shapes]
    every = np.concatenate(edges) if edges else np.zeros((0, 4))
    if not len(every):
        return []
    heights = np.unique(np.concatenate([every[:, 1], every[:, 3], crossings(every)]))
    out: Shape = []
    for low, high in pairwise(heights):
        mid = (low + high) / 2
        if not low < mid < high:
            continue
        cuts = []
        for k, e in enumerate(edges):
            e = e[(e[:, 1] <= low) & (e[:, 3] >= high)]
            slope = (e[:, 2] - e[:, 0]) / (e[:, 3] - e[:, 1]) if len(e) else np.zeros(0)
            at = lambda y, e=e, slope=slope: e[:, 0] + slope * (y - e[:, 1])
            cuts += [(m, k, a, b) for m, a, b in zip(at(mid), at(low), at(high), strict=True)]
        cuts.sort()
        inside = [False] * len(shapes)
        left = None
        for m, k, a, b in cuts:
            was = keep(inside)
            inside[k] = not inside[k]
            now = keep(inside)
            if now and not was:
                left = (m, a, b)
            elif was and not now and m > left[0]:
                ring = [(left[1], low), (a, low), (b, high), (left[2], high), (left[1], low)]
                out.append([ring])
    return out


def convex_ring(shape: Shape) -> list[tuple[float, float]] | None:
    """The only ring of a shape, counter-clockwise and open, if it is convex."""
    if len(shape) != 1 or len(shape[0]) != 1:
        return None
    ring = shape[0][0][:-1] if shape[0][0][0] == shape[0][0][-1] else shape[0][0]
    turns = [(b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0]) for a, b, c in zip(ring, ring[1:] + ring[:1], ring[2:] + ring[:2], strict=True)]
    # Turns of one sign wind once only if they also go up and down once.
    rises = [b[1] > a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True) if a[1] != b[1]]
    once = sum(p != q for p, q in zip(rises, rises[1:] + rises[:1], strict=True)) == 2
    if not once or not (all(t >= 0 for t in turns) or all(t <= 0 for t in turns)):
        return None
    return ring if any(t > 0 for t in turns) else ring[::-1]


def convex_intersection(a: list[tuple[float, float]], b: list[tuple[float, float]]) -> Shape:
    """What two convex rings share: a cut by each side of b."""
    for p, q in zip(b, b[1:] + b[:1], strict=True):
        side = [(q[0] - p[0]) * (y - p[1]) - (q[1] - p[1]) * (x - p[0]) for x, y in a]
        out = []
        for i, (s, t) in enumerate(zip(side, side[1:] + side[:1], strict=True)):
            (x0, y0), (x1, y1) = a[i], a[(i + 1) % len(a)]
            if s >= 0:
                out.append((x0, y0))
            if (s > 0 > t) or (s < 0 < t):
                k = s / (s - t)
                out.append((x0 + k * (x1 - x0), y0 + k * (y1 - y0)))
        a = out
        if len(a) < 3:
            return []
    flat = abs(sum(x0 * y1 - x1 * y0 for (x0, y0), (x1, y1) in zip(a, a[1:] + a[:1], strict=True))) == 0
    return [] if flat else [[[*a, a[0]]]]


def shared_part(x: Shape, y: Shape) -> Shape:
    a, b = convex_ring(x), convex_ring(y)
    return convex_intersection(a, b) if a and b else overlay([x, y], all)


class Shapes:
    """A column of multipolygons as flat coordinates and the offsets of its polygons, rings and points."""

    def __init__(self, column: pa.Array):
        column = pa.concat_arrays([column])  # whole buffers from offset 0, whatever slice came in
        self.valid = column.is_valid().to_numpy(zero_copy_only=False)
        polygons = column.values
        rings = polygons.values
        points = rings.values
        self.p, self.r, self.v = (np.asarray(c.offsets) for c in (column, polygons, rings))
        self.x, self.y = (points.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))

    def __len__(self) -> int:
        return len(self.valid)

    def shape(self, i: int) -> Shape:
        """Row i as nested lists; rings of two points or fewer are left out, a missing row is empty."""
        if not self.valid[i]:
            return []
        ring = lambda k: list(zip(self.x[self.v[k] : self.v[k + 1]].tolist(), self.y[self.v[k] : self.v[k + 1]].tolist(), strict=True))
        return [[ring(k) for k in range(self.r[j], self.r[j + 1]) if self.v[k + 1] - self.v[k] > 2] for j in range(self.p[i], self.p[i + 1])]

    def convex(self, most: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(is convex, x, y, points): rows of one convex ring of at most `most` points, open and counter-clockwise, padded to the same width."""
        n = len(self)
        one = self.valid & (np.diff(self.p) == 1)
        j = self.p[:-1][one]
        one[one] = self.r[j + 1] - self.r[j] == 1
        k = self.r[self.p[:-1][one]]
        first, count = self.v[k], self.v[k + 1] - self.v[k]
        fits = (count > 2) & (count <= most + 1)
        one[one] = fits
        first, count = first[fits], count[fits]
        last = first + count - 1
        count = count - ((self.x[first] == self.x[last]) & (self.y[first] == self.y[last]))
        width = int(count.max()) if len(count) else 0
        at = np.arange(width)[None, :]
        pad = at >= count[:, None]
        place = first[:, None] + np.where(pad, 0, at)
        x, y = self.x[place], self.y[place]
        after = np.where(at + 1 >= count[:, None], 0, at + 1)
        dx, dy = np.take_along_axis(x, after, 1) - x, np.take_along_axis(y, after, 1) - y
        turn = np.where(pad, 0.0, dx * np.take_along_axis(dy, after, 1) - dy * np.take_along_axis(dx, after, 1))
        left, right = (turn >= 0).all(axis=1), (turn <= 0).all(axis=1)
        # Turns of one sign wind once only if they also go up and down once: level sides take the direction of the side before.
        up = np.where(pad, 0, np.sign(dy)).astype(np.int8)
        for i in range(1, width):
            up[:, i] = np.where((up[:, i] == 0) & ~pad[:, i], up[:, i - 1], up[:, i])
        end = np.take_along_axis(up, np.maximum(count - 1, 0)[:, None], 1)
        for i in range(width):
            level = (up[:, i] == 0) & ~pad[:, i]
            up[:, i] = np.where(level, end[:, 0] if i == 0 else up[:, i - 1], up[:, i])
        changes = ((up != np.take_along_axis(up, after, 1)) & ~pad).sum(axis=1)
        good = (count > 2) & (changes == 2) & (left != right)
        back = np.where(pad, 0, count[:, None] - 1 - at)
        turned = right[:, None] & ~left[:, None]
        x, y = np.where(turned, np.take_along_axis(x, back, 1), x), np.where(turned, np.take_along_axis(y, back, 1), y)
        is_convex = np.zeros(n, bool)
        is_convex[one] = good
        return is_convex, x[good], y[good], count[good]


def convex_parts(x: np.ndarray, y: np.ndarray, n: np.ndarray, bx: np.ndarray, by: np.ndarray, bn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What pairs of convex rings share, all pairs at once: each first ring is cut by the sides of the second. No points where there is no area."""
    for j in range(bx.shape[1]):
        rows = np.arange(len(n))
        k = np.minimum(j + 1, bn - 1) * (j + 1 < bn)
        px, py, qx, qy = bx[:, j, None], by[:, j, None], bx[rows, k][:, None], by[rows, k][:, None]
        there = np.arange(x.shape[1])[None, :] < n[:, None]
        after = np.where(np.arange(x.shape[1])[None, :] + 1 >= n[:, None], 0, np.arange(x.shape[1])[None, :] + 1)
        side = (qx - px) * (y - py) - (qy - py) * (x - px)
        other = np.take_along_axis(side, after, 1)
        cuts = (j < bn)[:, None]
        keep = there & ((side >= 0) | ~cuts)
        cross = there & cuts & (((side > 0) & (other < 0)) | ((side < 0) & (other > 0)))
        with np.errstate(divide="ignore", invalid="ignore"):
            t = side / (side - other)
            cx, cy = x + t * (np.take_along_axis(x, after, 1) - x), y + t * (np.take_along_axis(y, after, 1) - y)
        cx, cy = np.where(cross, cx, 0.0), np.where(cross, cy, 0.0)
        mask = np.stack([keep, cross], axis=2).reshape(len(n), -1)
        order = np.argsort(~mask, axis=1, kind="stable")
        n = mask.sum(axis=1)
        order = order[:, : max(1, int(n.max(initial=0)))]
        x = np.take_along_axis(np.stack([x, cx], axis=2).reshape(len(n), -1), order, 1)
        y = np.take_along_axis(np.stack([y, cy], axis=2).reshape(len(n), -1), order, 1)
    there = np.arange(x.shape[1])[None, :] < n[:, None]
    after = np.where(np.arange(x.shape[1])[None, :] + 1 >= n[:, None], 0, np.arange(x.shape[1])[None, :] + 1)
    twice = np.where(there, x * np.take_along_axis(y, after, 1) - np.take_along_axis(x, after, 1) * y, 0.0).sum(axis=1)
    return x, y, np.where((n > 2) & (twice != 0), n, 0)


ARROW = pa.list_(pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))))


def column_of(rows: list[Shape | None], flat: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None = None) -> pa.Array:
    """A column of multipolygons from nested lists; rows that flat = (which, x, y, points) holds are single open rings, which are closed, or empty with 0 points."""
    if flat is not None and len(flat[0]) == len(rows):
        x, y, n = flat[1:]
        closed = np.where(n > 0, n + 1, 0)
        width = int(closed.max(initial=0))
        at = np.arange(width)[None, :]
        place = np.where(at < n[:, None], np.minimum(at, max(0, x.shape[1] - 1)), 0)
        inside = at < closed[:, None]
        points = pa.StructArray.from_arrays([pa.array(np.take_along_axis(v, place, 1)[inside]) for v in (x, y)], names=["x", "y"])
        rings = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(closed[closed > 0])), pa.int32()), points)
        polygons = pa.ListArray.from_arrays(pa.array(np.arange(len(rings) + 1), pa.int32()), rings)
        return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(closed > 0)), pa.int32()), polygons)
    rows = list(rows)
    for i, x, y, n in zip(*flat, strict=True) if flat is not None else ():
        ring = list(zip(x[:n].tolist(), y[:n].tolist(), strict=True))
        rows[i] = [[[*ring, ring[0]]]] if n else []
    return pa.array([None if r is None else [[[{"x": float(x), "y": float(y)} for x, y in ring] for ring in polygon] for polygon in r] for r in rows], ARROW)


def shared_shapes(a: pa.Array, b: pa.Array) -> tuple[list[Shape | None], tuple]:
    """What the rows of two columns share: convex ones all at once, the others one by one."""
    one, two = Shapes(a), Shapes(b)
    (ca, ax, ay, an), (cb, bx, by, bn) = one.convex(), two.convex()
    both = ca & cb
    ra, rb = both[ca], both[cb]
    flat = (np.flatnonzero(both), *convex_parts(ax[ra], ay[ra], an[ra], bx[rb], by[rb], bn[rb])) if both.any() else None
    rows: list[Shape | None] = [None] * len(one)
    for i in np.flatnonzero(~both):
        rows[i] = overlay([one.shape(i), two.shape(i)], all)
    return rows, flat


@F.arrow_udf(MULTI)
def intersection(a: pa.Array, b: pa.Array) -> pa.Array:
    """What two geometries share; empty if nothing."""
    return column_of(*shared_shapes(a, b))


@F.arrow_udf(MULTI)
def difference(a: pa.Array, b: pa.Array) -> pa.Array:
    one, two = Shapes(a), Shapes(b)
    return column_of([overlay([one.shape(i), two.shape(i)], lambda i: i[0] and not i[1]) for i in range(len(one))])


@F.arrow_udf(MULTI)
def union_of(many: pa.Array) -> pa.Array:
    """Union of an array of geometries."""
    many = pa.concat_arrays([many])
    held, at = Shapes(many.values), np.asarray(many.offsets)
    return column_of([overlay([held.shape(k) for k in range(at[i], at[i + 1])], any) for i in range(len(many))])


@F.arrow_udf(MULTI)
def made_valid(a: pa.Array) -> pa.Array:
    """Each polygon by the even-odd rule, all of them united; NULL for NULL or nothing left. A convex ring stays as it is."""
    held = Shapes(a)
    convex, x, y, n = held.convex()
    rows = [None if convex[i] or not held.valid[i] else overlay([[p] for p in held.shape(i)], any) or None for i in range(len(held))]
    return column_of(rows, (np.flatnonzero(convex), x, y, n) if convex.any() else None)


@F.arrow_udf(T.BooleanType())
def intersects(a: pa.Array, b: pa.Array) -> pa.Array:
    """Whether two geometries share some area."""
    rows, flat = shared_shapes(a, b)
    out = np.array([bool(r) for r in rows], bool)
    if flat is not None:
        out[flat[0]] = flat[3] > 0
    return pa.array(out)


def least_distance(a: np.ndarray, b: np.ndarray, at_once: int = 256) -> float:
    """Least distance of two sets of edges (x0, y0, x1, y1) that don't cross: of one's ends to the other's edges."""
    best = np.inf
    for one, two in ((a, b), (b, a)):
        d = two[:, 2:] - two[:, :2]
        size = np.maximum((d**2).sum(axis=1), 1e-300)
        for i in range(0, len(one), at_once):
            for ends in (one[i : i + at_once, :2], one[i : i + at_once, 2:]):
                w = ends[:, None, :] - two[None, :, :2]
                t = np.clip((w * d[None]).sum(axis=2) / size, 0.0, 1.0)
                best = min(best, float((((w - t[..., None] * d[None]) ** 2).sum(axis=2)).min(initial=np.inf)))
    return math.sqrt(best)


def sides_of(shape: Shape) -> np.ndarray:
    """All edges of a shape, level ones too."""
    return np.array([(*p, *q) for polygon in shape for ring in polygon for p, q in pairwise([*ring, ring[0]])], float).reshape(-1, 4)


def nearer_than(limit: float):
    """A function of two geometry columns: whether they share area or come as near as the limit, which is whether closing by half of it joins them."""

    @F.arrow_udf(T.BooleanType())
    def near(a: pa.Array, b: pa.Array) -> pa.Array:
        rows, flat = shared_shapes(a, b)
        hit = np.array([bool(r) for r in rows], bool)
        if flat is not None:
            hit[flat[0]] = flat[3] > 0
        one, two = Shapes(a), Shapes(b)
        for i in np.flatnonzero(~hit):
            x, y = sides_of(one.shape(i)), sides_of(two.shape(i))
            hit[i] = len(x) > 0 and len(y) > 0 and least_distance(x, y) <= limit
        return pa.array(hit)

    return near


@F.arrow_udf(POINT)
def inner_point(a: pa.Array) -> pa.Array:
    """A point inside: the middle of the widest piece at the middle height; NULL without area."""
    held = Shapes(a)
    rows: list[dict | None] = []
    for i in range(len(held)):
        e = edges_of(held.shape(i))
        if not len(e):
            rows.append(None)
            continue
        levels = np.unique(e[:, [1, 3]])
        mid = (levels[0] + levels[-1]) / 2
        at = int(np.searchsorted(levels, mid))
        y = mid if mid not in levels else (levels[at] + levels[at + 1]) / 2
        e = e[(e[:, 1] <= y) & (e[:, 3] > y)]
        x = np.sort(e[:, 0] + (e[:, 2] - e[:, 0]) * (y - e[:, 1]) / (e[:, 3] - e[:, 1]))
        widths = x[1::2] - x[::2]
        k = int(widths.argmax())
        rows.append({"x": float(x[2 * k] + widths[k] / 2), "y": float(y)})
    return pa.array(rows, pa.struct([("x", pa.float64()), ("y", pa.float64())]))


@F.arrow_udf(T.BooleanType())
def is_valid(a: pa.Array) -> pa.Array:
    """Rings of three distinct points at least whose edges cross nowhere between their ends."""
    held = Shapes(a)
    convex, *_ = held.convex()

    def ok(i: int) -> bool:
        for polygon in held.shape(i):
            rims = [edges_of([[ring]]) for ring in polygon]
            if any(len(set(ring)) < 3 for ring in polygon):
                return False
            e = np.concatenate(rims) if rims else np.zeros((0, 4))
            if len(e) and not set(np.round(crossings(e), 12)) <= set(np.round(e[:, [1, 3]].ravel(), 12)):
                return False
        return True

    return pa.array([None if not held.valid[i] else bool(convex[i]) or ok(i) for i in range(len(held))], pa.bool_())
