"""Queries on small tables of odd values against their SQL."""

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from loamline import plans
from loamline.operators import geometry, spatial

from .test_queries import rows


@pytest.fixture
def both(spark, tmp_path):
    """The rows of a query and of its SQL on tables that are given as columns."""

    def run(name, **tables):
        c = duckdb.connect()
        for t, columns in tables.items():
            pq.write_table(pa.table(columns), f"{tmp_path}/{t}.parquet")
            c.sql(f"create view {t} as select * from '{tmp_path}/{t}.parquet'")
        return rows(plans.QUERIES[name](spark, str(tmp_path)).toPandas()), rows(c.sql(plans.ORACLES[name]).df())

    return run


def test_values_a_rounding_error_beyond_a_range(both):
    """2.3 - 3.5 is less than -1.2 as doubles; a missing length is no value."""
    n = list(range(0, 700)) + [None]
    docs = [(8 * i + k, v) for k in range(8) for i, v in enumerate(n)]
    got, want = both("range_rules", documents={"doc_id": pa.array([d for d, _ in docs], pa.int64()), "n_chars": pa.array([v for _, v in docs], pa.int64())})
    assert got == want
    assert (float(8 * 230), "RASTER_RANGE") in [(r[1], r[0]) for r in got[1]]


def test_colours_of_floats_beside_a_step_of_the_palette(both):
    """A raster of floats is scaled in floats: beside half steps, doubles round to the other colour."""
    steps = np.float32(-0.3 + 0.6 * (np.arange(10) + 0.5) / 10)
    bits = np.arange(-24, 24)[:, None] + steps.view(np.int32)[None, :]
    values = bits.astype(np.int32).view(np.float32).ravel()
    vectors = np.resize(values, (8, 64))  # 16 columns of four bands; nir is the fourth
    spread = [np.repeat(values[i : i + 16], 4).tolist() for i in range(0, len(values), 16)]
    got, want = both("colour_raster", embeddings={"vec_id": pa.array(range(8 + len(spread)), pa.int64()), "label": pa.array([0] * (8 + len(spread)), pa.int32()), "embedding": pa.array([*vectors.tolist(), *spread], pa.list_(pa.float32()))})
    assert got == want


def copies(shift=1000, n=30):
    """20 boxes, each n times under keys that give the same place, one without area; and rows of no layer."""
    keys = [5 * b + shift * i for b in range(20) for i in range(n)]
    return {"p_partkey": pa.array([*keys, 1, 2, 3], pa.int64()), "p_size": pa.array([k % shift // 5 * 3 for k in keys] + [9, 9, 9], pa.int32())}


@pytest.fixture
def met(monkeypatch):
    """The numbers of rows that box_pairs and points_in_polygons gave."""
    seen = []

    def counted(real):
        def run(*args, **kwargs):
            out = real(*args, **kwargs)
            seen.append(out.count())
            return out

        return run

    for name in ("box_pairs", "points_in_polygons"):
        monkeypatch.setattr(spatial, name, counted(getattr(spatial, name)))
    return seen


def test_overlay_cuts_alike_outlines_once(both, met):
    got, want = both("overlay_intersection", part=copies())
    assert got == want and len(got[1]) > 5_000
    assert met[0] <= 20 * 20


def test_expanded_classes_are_all_pairs(spark):
    """Parts of few keys give what one list gives; rows with NULLs are in no class."""
    df = spark.createDataFrame([(i, float(i % 2)) for i in range(20)] + [(20, None), (None, 7.0)], "k long, v double")
    classes, members = spatial.in_classes(df, "k", ["v"], 3)
    assert members.groupBy("class").agg(F.count_distinct("part").alias("n")).filter("n > 1").count() == 2
    pairs = classes.filter("v < 7").select(F.col("class").alias("lc"), F.col("class").alias("rc"), "v")
    got = sorted(tuple(r) for r in spatial.expanded(pairs, members, members, 10).select("lid", "rid", "v").collect())
    assert got == sorted((a, b, float(a % 2)) for a in range(20) for b in range(20) if a % 2 == b % 2)
    assert spatial.expanded(pairs.filter("v > 5"), members, members).count() == 0


def test_points_at_a_place_are_tested_once(both, met):
    customers = [b + 1000 * i for b in range(40) for i in range(25)]
    got, want = both("point_in_polygon", part=copies(), customer={"c_custkey": pa.array(customers, pa.int64())})
    assert got == want and len(got[1]) > 500
    assert met[0] <= 40


def test_zones_compare_alike_footprints_once(both, met):
    got, want = both("scene_zones", part=copies())
    assert got == want
    assert met[0] <= 20 * 20


def test_zones_of_copies(spark):
    """Copies without area stay apart, copies closed by a gap don't; a fid with two outlines joins what they meet."""
    box = geometry.box(*[F.col(c).cast("double") for c in ("a", "b", "c", "d")])
    rows = [(1, 0, 0, 0, 1), (2, 0, 0, 0, 1), (3, 5, 5, 7, 7), (4, 5, 5, 7, 7), (5, 20, 20, 22, 22), (4, 20, 20, 22, 22), (6, 40, 40, 41, 41)]
    df = spark.createDataFrame(rows, "fid long, a int, b int, c int, d int").withColumn("geometry", box).select("fid", "geometry")
    df = df.union(spark.range(7, 9).select("id", F.lit(None)))
    zones = lambda gap: {r.fid: r.zone_id for r in spatial.zones_of(df, 2.0, gap).collect()}
    apart = {1: "ZONE_001", 2: "ZONE_002", 3: "ZONE_003", 4: "ZONE_003", 5: "ZONE_003", 6: "ZONE_004", 7: "ZONE_005", 8: "ZONE_006"}
    assert zones(0.0) == apart
    assert zones(0.25) == {1: "ZONE_001", 2: "ZONE_001", 3: "ZONE_002", 4: "ZONE_002", 5: "ZONE_002", 6: "ZONE_003", 7: "ZONE_004", 8: "ZONE_005"}
