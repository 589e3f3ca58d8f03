import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.operators import geometry as g
from loamline.operators import spatial


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_texts(spark):
    wkt = ["POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))", "multipolygon (((0 0,1 0,1 1,0 0)),((5e0 5,6.5 5,6 6,5 5)))", "", None, "POINT (1 2)", "POLYGON ((0 0, oops))", "POLYGON Z ((0 0 9, 1 0 9, 1 1 9, 0 0 9))"]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(wkt)], "i int, w string").withColumn("g", g.from_wkt(F.col("w")))
    got = {r.i: r for r in df.select("i", g.area(F.col("g")).alias("a"), g.is_empty(F.col("g")).alias("e"), g.to_geojson(F.col("g")).alias("j")).collect()}
    assert got[0].a == 15 and got[1].a == 0.5 + 0.75 and got[6].a == 0.5
    assert [got[i].e for i in range(7)] == [False, False, True, True, True, True, False]
    back = df.filter("i < 2").select("i", g.area(g.from_geojson(g.to_geojson(F.col("g")))).alias("a")).collect()
    assert {r.i: r.a for r in back} == {0: 15.0, 1: 1.25}


def test_point_in_polygon_with_a_hole(spark):
    poly = g.from_wkt(F.lit("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))"))
    df = spark.createDataFrame([(0.5, 0.5, True), (1.5, 1.5, False), (5.0, 1.0, False), (0.0, 0.0, True), (4.0, 4.0, False), (3.0, 3.9, True)], "x double, y double, want boolean")
    assert df.filter(g.contains(poly, F.col("x"), F.col("y")) != F.col("want")).count() == 0


def star(rng, n, cx, cy, r):
    return [[[(cx + r * rng.uniform(0.3, 1) * math.cos(2 * math.pi * i / n), cy + r * rng.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)) for i in range(n)]]]


def area(shape):
    return sum(abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1]))) / 2 for polygon in shape for ring in polygon)


@pytest.mark.parametrize("seed", range(6))
def test_overlays_against_sampling(seed):
    rng = random.Random(seed)
    a, b = star(rng, 9, 0, 0, 2), star(rng, 7, 0.7, 0.4, 2)
    both, either, less = area(g.overlay([a, b], all)), area(g.overlay([a, b], any)), area(g.overlay([a, b], lambda i: i[0] and not i[1]))
    assert abs(area(a) + area(b) - both - either) < 1e-9 and abs(area(a) - both - less) < 1e-9

    def inside(shape, x, y):
        ring = shape[0][0]
        return sum((p[1] > y) != (q[1] > y) and x < (q[0] - p[0]) * (y - p[1]) / (q[1] - p[1]) + p[0] for p, q in zip(ring, ring[1:] + ring[:1])) % 2 == 1

    n = 200
    hits = sum(inside(a, x, y) and inside(b, x, y) for x in np.linspace(-2, 2, n) for y in np.linspace(-2, 2, n))
    assert abs(hits * (4 / n) ** 2 - both) < 0.12


@pytest.mark.parametrize("seed", range(8))
def test_convex_parts_are_the_same_as_slabs(seed):
    rng = random.Random(seed)
    hull = lambda n, cx: [[[(cx + 2 * math.cos(t), 1.5 * math.sin(t)) for t in sorted(rng.uniform(0, 2 * math.pi) for _ in range(n))]]]
    a, b = hull(8, 0), hull(6, rng.uniform(-1, 5))
    if seed % 2:
        a = [[a[0][0][::-1]]]
    assert g.convex_ring(a) and g.convex_ring(b)
    assert abs(area(g.shared_part(a, b)) - area(g.overlay([a, b], all))) < 1e-9
    assert g.convex_ring(star(rng, 9, 0, 0, 2)) is None
    pentagram = [[[(math.cos(4 * math.pi * i / 5), math.sin(4 * math.pi * i / 5)) for i in range(5)]]]
    assert g.convex_ring(pentagram) is None
    square = [[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]]
    assert g.shared_part(square, [[[(1, 0), (2, 0), (2, 1), (1, 1), (1, 0)]]]) == []


def test_valid_and_made_valid(spark):
    rows = [(1, "POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))"), (2, "POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0))"), (3, "POLYGON ((0 0, 1 1, 0 0))")]
    df = spark.createDataFrame(rows, "i int, w string").withColumn("g", g.from_wkt(F.col("w")))
    got = {r.i: r for r in df.select("i", g.is_valid("g").alias("ok"), g.area(g.made_valid("g")).alias("a"), g.made_valid("g").isNull().alias("gone")).collect()}
    assert not got[1].ok and got[2].ok and not got[3].ok
    assert abs(got[1].a - 2.0) < 1e-9 and got[2].a == 4 and got[3].gone


def test_projections(spark):
    x, y = one(spark, F.struct(*[c.alias(n) for n, c in zip("ab", g.to_mercator(F.lit(129.7), F.lit(62.0)), strict=True)]))
    assert abs(x - 14438138.0) < 5 and abs(y - math.log(math.tan(math.pi / 4 + math.radians(62) / 2)) * 6378137) < 1e-6
    lon, lat = one(spark, F.struct(*[c.alias(n) for n, c in zip("ab", g.from_mercator(F.lit(x), F.lit(y)), strict=True)]))
    assert abs(lon - 129.7) < 1e-9 and abs(lat - 62) < 1e-9
    # On its central meridian a UTM zone is 500 km east, and the meridian's length at 45 degrees is known.
    e, n = one(spark, F.struct(*[c.alias(n) for n, c in zip("ab", g.to_utm(F.lit(129.0), F.lit(45.0), 52), strict=True)]))
    assert abs(e - 500000) < 1e-6 and abs(n - 4982950.4 ) < 1.0
    # A one-degree cell at the equator keeps its area on the ellipsoid.
    cell = g.box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))
    assert abs(one(spark, g.area_km2(cell)) - 12308.8) < 5
    b = one(spark, F.struct(*[v.alias(k) for k, v in g.projected_bounds({"xmin": F.lit(10.0), "ymin": F.lit(50.0), "xmax": F.lit(11.0), "ymax": F.lit(51.0)}, 4326, 3857).items()]))
    assert abs(b.xmin - 1113194.9) < 1 and b.ymax > b.ymin


def test_centroid_and_inner_point(spark):
    c_shape = "POLYGON ((0 0, 6 0, 6 1, 1 1, 1 5, 6 5, 6 6, 0 6, 0 0))"
    df = spark.createDataFrame([(c_shape,)], "w string").withColumn("g", g.from_wkt(F.col("w"))).withColumns({"p": g.inner_point("g"), "c": g.centroid(F.col("g"))})
    r = df.select("p", "c", g.contains(F.col("g"), F.col("p.x"), F.col("p.y")).alias("inside")).first()
    assert r.inside and abs(r.c.x - (6 * 3 + 6 * 3 + 4 * 0.5) / 16) < 1e-9 and abs(r.c.y - 3) < 1e-9


def test_areas_by_point_then_overlap(spark):
    at = lambda *b: g.box(*[F.lit(float(x)) for x in b])
    aoi = spark.range(1).select(F.explode(F.array(F.struct(F.lit("A").alias("area"), at(0, 0, 10, 10).alias("geometry")), F.struct(F.lit("B").alias("area"), at(20, 0, 30, 10).alias("geometry")))).alias("r")).select("r.*")
    parcels = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(i).cast("long").alias("parcel_id"), at(*b).alias("geometry")) for i, b in ((1, (1, 1, 2, 2)), (2, (9, 1, 15, 2)), (3, (50, 50, 51, 51)), (4, (15, 1, 22, 2)))])).alias("r")).select("r.*")
    got = {r.parcel_id: r.area for r in spatial.areas_of_parcels(parcels, aoi, 7.0).collect()}
    assert got == {1: "A", 2: "A", 3: None, 4: "B"}


def test_numbering_is_in_order(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k")).repartition(7)
    assert all(r.k + 1 == r.parcel_id for r in spatial.numbered(df, ["k"]).collect())


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_numbering_many_rows_with_other_columns(spark, adaptive):
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(400_000).select(F.xxhash64("id").alias("k"), F.md5(F.col("id").cast("string")).alias("payload"), F.lit(1).alias("_at"), F.lit(2).alias("_part"))
        out = spatial.numbered(df, ["k"])
        assert out.columns == ["k", "payload", "_at", "_part", "parcel_id"]
        got = out.agg(F.count_distinct("parcel_id").alias("n"), F.min("parcel_id").alias("lo"), F.max("parcel_id").alias("hi"), F.min("_at").alias("a"), F.max("_part").alias("p")).first()
        assert tuple(got) == (400_000, 1, 400_000, 1, 2)
        bounds = out.groupBy(F.floor((F.col("parcel_id") - 1) / 1000).alias("g")).agg(F.min("k").alias("lo"), F.max("k").alias("hi")).orderBy("g").collect()
        assert all(a.hi < b.lo for a, b in zip(bounds, bounds[1:]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)


def test_unions_in_rounds(spark):
    box = g.box(F.col("x"), F.col("y"), F.col("x") + 1.5, F.col("y") + 1.0)
    df = spark.range(60).select(F.pmod("id", F.lit(2)).alias("k"), (F.col("id") / 2).cast("int").cast("double").alias("x"), F.pmod(F.floor(F.col("id") / 2), F.lit(3)).cast("double").alias("y")).withColumn("geometry", box)
    once = {r.k: r.a for r in spatial.dissolved(df, ["k"], fan=1000).select("k", g.area(F.col("geometry")).alias("a")).collect()}
    rounds = {r.k: r.a for r in spatial.dissolved(df, ["k"], fan=4).select("k", g.area(F.col("geometry")).alias("a")).collect()}
    assert set(once) == {0, 1} and all(abs(once[k] - rounds[k]) < 1e-9 for k in once)


def test_columns_of_uneven_shapes(spark):
    rng = random.Random(5)
    ring = lambda n, cx, r: [(cx + r * math.cos(2 * math.pi * i / n), r * math.sin(2 * math.pi * i / n)) for i in range(n)]
    closed = lambda points: "(" + ", ".join(f"{x} {y}" for x, y in [*points, points[0]]) + ")"
    rows = [(0, None, f"POLYGON ({closed(ring(5, 0, 1))})")]
    for i in range(1, 40):
        a = [ring(rng.randrange(3, 9), 0, 2)] + [ring(rng.randrange(3, 7), 0, 0.5)] * (i % 3 == 0)
        b = [ring(rng.randrange(3, 9), rng.uniform(0, 3), 2)] + [ring(4, 9, 1)] * (i % 4 == 0)
        rows.append((i, f"POLYGON ({', '.join(map(closed, a))})", f"MULTIPOLYGON ({', '.join(f'({closed(x)})' for x in b)})"))
    df = spark.createDataFrame(rows, "i int, a string, b string").select("i", g.from_wkt(F.col("a")).alias("a"), g.from_wkt(F.col("b")).alias("b"))
    size = lambda c: g.area(c)
    got = df.select("i", size(F.col("a")).alias("a"), size(F.col("b")).alias("b"), size(g.intersection("a", "b")).alias("both"), size(g.difference("a", "b")).alias("less"), size(g.union_of(F.array("a", "b"))).alias("either"), g.intersects("a", "b").alias("hit"), size(g.made_valid("a")).alias("valid"), g.is_valid("a").alias("ok")).collect()
    for r in got:
        if r.i:
            assert abs(r.a - r.both - r.less) < 1e-9 and abs(r.a + r.b - r.both - r.either) < 1e-9 and abs(r.valid - r.a) < 1e-9 and r.ok
        else:
            assert r.both == 0 and r.valid is None and r.ok is None
        assert r.hit == (r.both > 0)


def test_zones_by_closing(spark):
    """Squares in a row, one step diagonal: joined when outlines are within twice the gap, by their true distance and not their boxes'."""
    corners = [(0.0, 0.0), (1.5, 0.0), (3.2, 0.0), (4.6, 1.4)]
    tilted = "POLYGON ((20 0, 21 1, 20 2, 19 1, 20 0))"
    near_box = "POLYGON ((20.9 1.9, 21.5 1.9, 21.5 2.5, 20.9 2.5, 20.9 1.9))"  # its box touches the tilted square's, its outline is 0.57 away
    wkt = [f"POLYGON (({x} {y}, {x + 1} {y}, {x + 1} {y + 1}, {x} {y + 1}, {x} {y}))" for x, y in corners] + [tilted, near_box]
    df = spark.createDataFrame([(i, w) for i, w in enumerate(wkt)], "fid long, w string").select("fid", g.from_wkt(F.col("w")).alias("geometry"))
    zones = lambda gap: {r.fid: r.zone_id for r in spatial.zones_of(df, 2.0, gap).collect()}
    assert len(set(zones(0.0).values())) == 6
    got = zones(0.26)  # 0.5 joins the first two; 0.7, and 0.4 by 0.4 across the corner (0.566), don't
    assert got[0] == got[1] and len({got[i] for i in (1, 2, 3)}) == 3 and got[4] != got[5]
    got = zones(0.3)
    assert got[2] == got[3] != got[1] and got[4] == got[5]
    assert len({zones(0.4)[i] for i in range(4)}) == 1
