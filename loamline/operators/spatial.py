"""Spatial joins, overlays, zonal statistics and zones.

A bounding box is dealt out to the cells of a square grid; candidates meet by an equi-join on the cell, so no join is a product of all rows,
and the exact test runs on what shares a cell. A cell size of about a box's keeps the number of cells for each row small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.stats import quantiles
from ..session import checkpointed, unused, written
from . import geometry as g
from .raster import merged

BOX = ["xmin", "ymin", "xmax", "ymax"]


def with_bounds(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    return df.withColumns(g.bounds(F.col(geometry)))


def in_cells(df: DataFrame, size: float, names: list[str] = BOX) -> DataFrame:
    """df with a row for each grid cell (cx, cy) that its box touches."""
    x0, y0, x1, y1 = (F.floor(F.col(c) / size) for c in names)
    return df.withColumn("cx", F.explode(F.sequence(x0, x1))).withColumn("cy", F.explode(F.sequence(y0, y1)))


def box_of(prefix: str = "") -> dict[str, Column]:
    return {c: F.col(f"{prefix}{c}") for c in BOX}


def box_pairs(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """Rows of left (lid, box) and right (rid, box) whose boxes share area or touch, each pair once: in the cell of the pair's lower left corner."""
    a, b = in_cells(left, size), in_cells(right.withColumnsRenamed({c: f"r_{c}" for c in BOX}), size, [f"r_{c}" for c in BOX])
    hit = (F.col("xmin") <= F.col("r_xmax")) & (F.col("r_xmin") <= F.col("xmax")) & (F.col("ymin") <= F.col("r_ymax")) & (F.col("r_ymin") <= F.col("ymax"))
    own = (F.col("cx") == F.floor(F.greatest("xmin", "r_xmin") / size)) & (F.col("cy") == F.floor(F.greatest("ymin", "r_ymin") / size))
    return a.join(b, ["cx", "cy"]).filter(hit & own).drop("cx", "cy")


def in_classes(df: DataFrame, key: str, same: list[str], most: int = 512) -> tuple[DataFrame, DataFrame]:
    """Rows that are alike in the columns of `same`, so that what depends on these alone is computed once: (class, low, parts, *same), one row for each class
    with its least key, and (class, part, key) of all rows but those with NULLs there. A part has about `most` keys, so no class lies in one list."""
    held = df.select(F.col(key).alias("key"), *same)
    parts = F.greatest(F.ceil(F.count("key") / most), F.lit(1)).cast("int").alias("parts")
    classes = written(held.groupBy(*same).agg(F.min("key").alias("low"), parts).withColumn("class", F.monotonically_increasing_id()), "classes", "zstd")
    rows = held.join(classes.select(*same, "class", "parts"), same)
    return classes, written(rows.select("class", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int").alias("part"), "key"), "members")


def expanded(pairs: DataFrame, left: DataFrame, right: DataFrame, rows_at_once: int = 2_000_000) -> DataFrame:
    """Pairs of classes (lc, rc and columns of their own) as all pairs of their members: lid and rid instead of a class' parts, lc and rc kept.

    Parts meet parts, and as many tasks share these as the rows ask for: the rows that come in are few, so their bytes say nothing of those that go out."""
    lists = lambda m, c, k: m.groupBy(F.col("class").alias(c), F.col("part").alias(f"{c}p")).agg(F.collect_list("key").alias(k))
    a, b = lists(left, "lc", "_l"), lists(right, "rc", "_r")
    parts = lambda t, c: t.select(c, f"{c}p", F.size(t.columns[-1]).cast("long").alias(f"{c}n"))
    blocks = written(pairs.join(parts(a, "lc"), "lc").join(parts(b, "rc"), "rc"), "blocks")
    total = blocks.agg(F.sum(F.col("lcn") * F.col("rcn"))).first()[0] or 0
    tasks = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // rows_at_once))
    met = blocks.join(a, ["lc", "lcp"]).join(b, ["rc", "rcp"]).repartition(tasks, "lc", "lcp", "rc", "rcp")
    own = [c for c in pairs.columns if c not in ("lc", "rc")]
    return met.select("lc", "rc", *own, F.explode("_l").alias("lid"), "_r").select("lc", "rc", *own, "lid", F.explode("_r").alias("rid"))


def points_in_polygons(points: DataFrame, polygons: DataFrame, size: float, pid: str = "pid", gid: str = "gid") -> DataFrame:
    """(pid, gid) of points (pid, x, y) inside polygons (gid, geometry): the even-odd rule, by grid cell. For places that rarely repeat; see alike_points_in_polygons."""
    boxes = in_cells(with_bounds(polygons.select(gid, "geometry")), size)
    at = points.select(pid, "x", "y").withColumns({"cx": F.floor(F.col("x") / size), "cy": F.floor(F.col("y") / size)})
    near = at.join(boxes, ["cx", "cy"]).filter((F.col("x") >= F.col("xmin")) & (F.col("x") <= F.col("xmax")) & (F.col("y") >= F.col("ymin")) & (F.col("y") <= F.col("ymax")))
    return near.filter(g.contains(F.col("geometry"), F.col("x"), F.col("y"))).select(pid, gid)


def alike_points_in_polygons(points: DataFrame, polygons: DataFrame, size: float, pid: str = "pid", gid: str = "gid") -> DataFrame:
    """The same for points at one place and outlines that are copies of each other: each place is tested against each outline once."""
    (places, at), (outlines, of) = in_classes(points, pid, ["x", "y"]), in_classes(polygons, gid, ["geometry"])
    hits = points_in_polygons(places.select(F.col("class").alias("lc"), "x", "y"), outlines.select(F.col("class").alias("rc"), "geometry"), size, "lc", "rc")
    return expanded(hits, at, of).select(F.col("lid").alias(pid), F.col("rid").alias(gid))


def areas_of_parcels(parcels: DataFrame, aoi: DataFrame, size: float) -> DataFrame:
    """parcels (parcel_id, geometry) with area: that of the AOI polygon around an inner point, else of one that it overlaps (the least name)."""
    inner = parcels.withColumn("_p", g.inner_point("geometry")).select(F.col("parcel_id").alias("pid"), F.col("_p.x").alias("x"), F.col("_p.y").alias("y"))
    inside = points_in_polygons(inner, aoi.select(F.col("area").alias("gid"), "geometry"), size).groupBy(F.col("pid").alias("parcel_id")).agg(F.min("gid").alias("area"))
    found = parcels.join(inside, "parcel_id", "left")
    rest = with_bounds(found.filter("area is null").select(F.col("parcel_id").alias("lid"), F.col("geometry").alias("lg"), "geometry")).drop("geometry")
    other = with_bounds(aoi.select(F.col("area").alias("rid"), F.col("geometry").alias("rg"), "geometry")).drop("geometry")
    touched = box_pairs(rest, other, size).filter(g.intersects("lg", "rg")).groupBy(F.col("lid").alias("parcel_id")).agg(F.min("rid").alias("_recovered"))
    return found.join(touched, "parcel_id", "left").withColumn("area", F.coalesce("area", "_recovered")).drop("_recovered")


def with_hit(df: DataFrame, keys: list[str], hits: DataFrame, name: str) -> DataFrame:
    """df with a flag for rows whose key is among hits: EXISTS, so several hits don't multiply rows."""
    return df.join(hits.select(*keys).distinct().withColumn(name, F.lit(True)), keys, "left").withColumn(name, F.coalesce(name, F.lit(False)))


def line_work(df: DataFrame, geometry: str = "geometry") -> DataFrame:
    """df with a row for each side of its outlines: (ax, ay) to (bx, by) instead of the geometry."""
    sides = F.flatten(F.flatten(F.transform(geometry, lambda polygon: F.transform(polygon, g.steps))))
    rows = df.withColumn("_s", F.explode(sides)).withColumns({"ax": F.col("_s.a.x"), "ay": F.col("_s.a.y"), "bx": F.col("_s.b.x"), "by": F.col("_s.b.y")}).drop("_s", geometry)
    return rows.filter("ax <> bx or ay <> by")


def clipped_lines(lines: DataFrame, x0: Column, y0: Column, x1: Column, y1: Column) -> DataFrame:
    """The parts of lines (ax, ay to bx, by) inside a box; lines outside, and those that only touch it in a point, are left out."""
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    walls = [(-dx, F.col("ax") - x0), (dx, x1 - F.col("ax")), (-dy, F.col("ay") - y0), (dy, y1 - F.col("ay"))]
    enter = F.greatest(F.lit(0.0), *[F.when(p < 0, q / p) for p, q in walls])
    leave = F.least(F.lit(1.0), *[F.when(p > 0, q / p) for p, q in walls])
    there = enter < leave
    for p, q in walls:
        there = there & ((p != 0) | (q >= 0))
    cut = lines.filter(there).withColumns({"_in": enter, "_out": leave})
    at = lambda a, b, t: F.col(a) + (F.col(b) - F.col(a)) * F.col(t)
    ends = {"_ax": at("ax", "bx", "_in"), "_ay": at("ay", "by", "_in"), "_bx": at("ax", "bx", "_out"), "_by": at("ay", "by", "_out")}
    return cut.withColumns(ends).drop("ax", "ay", "bx", "by", "_in", "_out").withColumnsRenamed({"_ax": "ax", "_ay": "ay", "_bx": "bx", "_by": "by"})


def clipped_to(parcels: DataFrame, aoi: DataFrame, size: float) -> DataFrame:
    """Parcels cut to an AOI's polygons (gid, geometry): one row for each pair that shares area, with parcel_id and the shared geometry."""
    a = with_bounds(parcels.select(F.col("parcel_id").alias("lid"), F.col("geometry").alias("lg"), "geometry")).drop("geometry")
    b = with_bounds(aoi.select(F.col("gid").alias("rid"), F.col("geometry").alias("rg"), "geometry")).drop("geometry")
    cut = box_pairs(a, b, size).withColumn("geometry", g.intersection("lg", "rg"))
    return cut.filter(F.size("geometry") > 0).select(F.col("lid").alias("parcel_id"), F.col("rid").alias("gid"), "geometry")


def most_overlapped(left: DataFrame, right: DataFrame, size: float) -> DataFrame:
    """(lid, rid, overlap): for each left box the right one it shares most area with, the least rid on ties; rid NULL and 0.0 without any."""
    pairs = box_pairs(left.select("lid", *BOX), right.select("rid", *BOX), size).withColumn("overlap", g.box_overlap(box_of(), box_of("r_")))
    best = pairs.groupBy("lid").agg(F.max_by(F.struct("rid", "overlap"), F.struct("overlap", -F.col("rid"))).alias("b")).select("lid", "b.*")
    return left.select("lid").join(best, "lid", "left").withColumn("overlap", F.coalesce("overlap", F.lit(0.0)))


def pixels_in_boxes(px: DataFrame, boxes: DataFrame, size: int = 16) -> DataFrame:
    """px joined to boxes (zone, xmin..ymax in grid units) that hold its pixel centre (col + 0.5, row + 0.5)."""
    at = px.withColumns({"cx": F.floor((F.col("col") + 0.5) / size), "cy": F.floor((F.col("row") + 0.5) / size)})
    x, y = F.col("col") + 0.5, F.col("row") + 0.5
    return at.join(in_cells(boxes, size), ["cx", "cy"]).filter((x >= F.col("xmin")) & (x < F.col("xmax")) & (y >= F.col("ymin")) & (y < F.col("ymax"))).drop("cx", "cy", *BOX)


def pixels_in_polygons(px: DataFrame, zones: DataFrame, size: int = 16, own: list[str] | None = None) -> DataFrame:
    """px joined to zones (zone, geometry in grid units) that hold its pixel centre, of the same values in the columns of `own` that both have."""
    at = px.withColumns({"cx": F.floor((F.col("col") + 0.5) / size), "cy": F.floor((F.col("row") + 0.5) / size)})
    near = at.join(in_cells(with_bounds(zones.select(*(own or []), "zone", "geometry")), size), [*(own or []), "cx", "cy"])
    return near.filter(g.contains(F.col("geometry"), F.col("col") + 0.5, F.col("row") + 0.5)).drop("cx", "cy", "geometry", *BOX)


def zonal_table(joined: DataFrame, zones: DataFrame, layers: list[str], masks: list[str], sizes: DataFrame | None = None, cell_area: float = 1.0) -> DataFrame:
    """One row for each zone, those without pixels too: statistics of layers, shares of masks, and with sizes (comp_id, n_px) hotspot_count and
    mean_hotspot_size_m2 of the components that touch the zone, each at its full size (0 and 0.0 if none)."""
    plain = (("mean", F.avg), ("std", F.stddev_pop), ("min", F.min), ("max", F.max))
    aggs = [f(c).alias(f"{c}_{n}") for c in layers for n, f in plain] + [F.avg(F.col(m).cast("double")).alias(f"{m}_share") for m in masks]
    out = zones.select("zone").join(joined.groupBy("zone").agg(*aggs, F.count("*").alias("n_px")), "zone", "left").fillna(0, ["n_px"])
    if layers:
        out = out.join(quantiles(joined, ["zone"], {f"{c}_{n}": (F.col(c), q) for c in layers for n, q in (("p90", 0.9), ("p95", 0.95))}), "zone", "left")
    if sizes is not None:
        spots = joined.filter("comp_id is not null").select("zone", "comp_id").distinct().join(sizes, "comp_id").groupBy("zone").agg(F.count("*").alias("hotspot_count"), (F.avg(F.col("n_px").cast("double")) * cell_area).alias("mean_hotspot_size_m2"))
        out = out.join(spots, "zone", "left").fillna({"hotspot_count": 0, "mean_hotspot_size_m2": 0.0})
    return out


def burned(px: DataFrame, shapes: DataFrame, size: int = 16, fill: float = -9999.0) -> DataFrame:
    """px with `burned`: the value of the last shape (zone, geometry, ord, value) that holds the pixel's centre, else fill."""
    hit = pixels_in_polygons(px.select("row", "col"), shapes, size).join(shapes.select("zone", "ord", "value"), "zone").groupBy("row", "col").agg(F.max_by("value", F.struct("ord", "zone")).alias("burned"))
    return px.join(hit, ["row", "col"], "left").withColumn("burned", F.coalesce("burned", F.lit(fill)))


def zones_of(footprints: DataFrame, size: float, gap: float = 0.0) -> DataFrame:
    """(fid, zone_id): footprints (fid, geometry) joined to zones where they overlap, or closing by `gap` (that much outwards and back) would join them: their outlines
    come as near as twice that. ZONE_001 holds the least fid."""
    classes, members = in_classes(footprints, "fid", ["geometry"])
    f = with_bounds(classes.select("class", "geometry"))
    wide = f.select(F.col("class").alias("lid"), F.col("geometry").alias("lg"), *[(F.col(c) - 2 * gap if c.endswith("min") else F.col(c) + 2 * gap).alias(c) for c in BOX])
    # Copies are one class; whether they meet is asked of the class and itself.
    pairs = box_pairs(wide, f.select(F.col("class").alias("rid"), F.col("geometry").alias("rg"), *BOX), size).filter("lid <= rid")
    hits = written(pairs.filter(g.intersects("lg", "rg") if gap == 0 else g.nearer_than(2 * gap)("lg", "rg")).select(F.col("lid").alias("a"), F.col("rid").alias("b")), "hits")
    meet = members.join(hits.select(F.col("a").alias("class")).union(hits.select("b")).distinct(), "class", "left_semi")
    # A fid with several outlines joins their classes.
    several = meet.groupBy("key").agg(F.collect_set("class").alias("all")).filter(F.size("all") > 1)
    roots = merged(hits.union(several.select(F.get("all", F.lit(0)).alias("a"), F.explode("all").alias("b"))))
    linked = classes.select(F.col("class").alias("node"), "low").join(roots, "node")
    least = linked.join(linked.groupBy("root").agg(F.min("low").alias("least")), "root").select(F.col("node").alias("class"), "least")
    held = footprints.select("fid").join(members.join(least, "class").select(F.col("key").alias("fid"), F.col("least").alias("root")).distinct(), "fid", "left")
    held = written(held.withColumn("root", F.coalesce("root", "fid")), "zones")
    numbers = numbered(held.select("root").distinct(), ["root"], "_n").select("root", F.format_string("ZONE_%03d", "_n").alias("zone_id"))
    return held.join(numbers, "root").select("fid", "zone_id")


def dissolved(df: DataFrame, keys: list[str], geometry: str = "geometry", fan: int = 64) -> DataFrame:
    """The union of each group's geometries, in rounds: neighbours along the x axis are united `fan` at a time until a group is one, so no task holds a group's outlines."""
    held = df.select(*keys, F.col(geometry).alias("_g")).filter(F.col("_g").isNotNull())
    while held.groupBy(*keys).count().filter(F.col("count") > fan).limit(1).count():
        x = g.bounds(F.col("_g"))
        ranked = numbered(held.withColumns({"_x": x["xmin"], "_y": x["ymin"], "_h": F.xxhash64(F.to_json("_g"))}), [*keys, "_x", "_y", "_h"], "_n")
        held = written(ranked.groupBy(*keys, F.floor(F.col("_n") / fan).alias("_p")).agg(F.collect_list("_g").alias("_all")).select(*keys, g.union_of("_all").alias("_g")), "outlines", "zstd")
    # Written: Spark can't plan expressions with lambdas over a Python function of an aggregate, which callers' measures would make.
    return written(held.groupBy(*keys).agg(F.collect_list("_g").alias("_all")).select(*keys, g.union_of("_all").alias(geometry)), "outlines", "zstd")


def numbered(df: DataFrame, order: list[str], name: str = "parcel_id") -> DataFrame:
    """df with ids from 1 in a total order: rows are ranged over partitions and counted, so no one task sorts them all.

    Rows are written once with their partition and place in it, and counted from there: were the ranges computed again for the counts, their bounds
    could be others. What is summed is a row for each partition.
    """
    at, part, before = (unused(n, df) for n in ("_at", "_part", "_before"))
    held = checkpointed(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id())).withColumn(part, F.shiftright(at, 33))
    counts = held.groupBy(part).agg(F.count("*").alias("n")).select(part, F.coalesce(F.sum("n").over(W.orderBy(part).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias(before))
    number = F.col(before) + F.col(at).bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return held.join(F.broadcast(counts), part).withColumn(name, number.cast("long")).drop(at, part, before)  # as many rows as partitions
