"""Vector layers: GeoJSON, shapefiles, GeoPackage; features are rows with a multipolygon and their attributes as a map of texts."""

from __future__ import annotations

import io
import json
import re
import sqlite3
import struct
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import geometry as g

SCHEMA = "path string, layer string, epsg int, properties map<string, string>, geometry array<array<array<struct<x: double, y: double>>>>, error string"
# A text in a .prj or a CRS name, and its code.
CRS_NAMES = {"CRS84": 4326, "GCS_WGS_1984": 4326, "WGS_1984_Web_Mercator": 3857, "Cylindrical_Equal_Area": 6933}


def epsg_of(text: str | None) -> int | None:
    """EPSG code of a CRS text: EPSG:n, a name in CRS_NAMES, or a UTM zone of the north."""
    if not text:
        return None
    if m := re.search(r"EPSG(?:::|:|\",\s*\"?)(\d{4,5})", text, re.I):
        return int(m[1])
    if m := re.search(r"UTM_Zone_(\d{1,2})N", text, re.I):
        return 32600 + int(m[1])
    return next((code for name, code in CRS_NAMES.items() if name.lower() in text.lower()), None)


def read_geojson(spark: SparkSession, path: str, pattern: str = "*.geojson") -> DataFrame:
    """Features of GeoJSON files; all in Spark expressions."""
    whole = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    crs = F.regexp_extract(F.get_json_object("value", "$.crs.properties.name"), r"EPSG:+(\d+)", 1).try_cast("int")
    features = F.from_json(F.get_json_object("value", "$.features"), "array<string>")
    rows = whole.select("path", F.coalesce(crs, F.lit(4326)).alias("epsg"), F.explode(features).alias("f"))
    return rows.select("path", F.lit(None).cast("string").alias("layer"), "epsg", F.from_json(F.get_json_object("f", "$.properties"), "map<string,string>").alias("properties"), g.from_geojson(F.get_json_object("f", "$.geometry")).alias("geometry"), F.lit(None).cast("string").alias("error"))


def geojson_lines(df: DataFrame, properties: list[str], geometry: str = "geometry") -> DataFrame:
    """One feature as JSON text a row (newline-delimited GeoJSON)."""
    feature = F.struct(F.lit("Feature").alias("type"), F.from_json(g.to_geojson(F.col(geometry)), "type string, coordinates array<array<array<array<double>>>>").alias("geometry"), F.struct(*properties).alias("properties"))
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def feature_collection(lines: list[str], epsg: int = 4326) -> str:
    """A GeoJSON document of features; for layers small enough for one file."""
    head = json.dumps({"type": "FeatureCollection", "crs": {"type": "name", "properties": {"name": f"urn:ogc:def:crs:EPSG::{epsg}"}}})
    return head[:-1] + ', "features": [' + ",\n".join(lines) + "]}"


# ---------------------------------------------------------------- shapefiles


def signed_area(ring: list[tuple[float, float]]) -> float:
    return sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def polygons_of(rings: list[list[tuple[float, float]]]) -> list:
    """Rings as polygons: clockwise rings are outlines; a hole goes to the outline before it that holds its first point."""
    out: list[list] = []
    for ring in rings:
        if signed_area(ring) <= 0 or not out:
            out.append([ring])
        else:
            x, y = ring[0]
            holder = next((p for p in reversed(out) if sum((a[1] > y) != (b[1] > y) and x < (b[0] - a[0]) * (y - a[1]) / (b[1] - a[1]) + a[0] for a, b in zip(p[0], p[0][1:], strict=False)) % 2), out[-1])
            holder.append(ring)
    return out


def read_shp(shp: bytes) -> list:
    """Multipolygons of a .shp's records; None for null shapes, ValueError for other kinds."""
    out, at = [], 100
    while at + 8 <= len(shp):
        _, words = struct.unpack_from(">II", shp, at)
        at += 8
        (kind,) = struct.unpack_from("<i", shp, at)
        if kind == 0:
            out.append(None)
        elif kind in (5, 15, 25):
            parts, points = struct.unpack_from("<ii", shp, at + 36)
            starts = [*struct.unpack_from(f"<{parts}i", shp, at + 44), points]
            flat = struct.unpack_from(f"<{2 * points}d", shp, at + 44 + 4 * parts)
            xy = list(zip(flat[::2], flat[1::2], strict=True))
            out.append(polygons_of([xy[a:b] for a, b in zip(starts, starts[1:], strict=False)]))
        else:
            raise ValueError(f"shapes of kind {kind} are not polygons")
        at += 2 * words
    return out


def read_dbf(dbf: bytes, encoding: str = "utf-8") -> list[dict[str, str]]:
    n, head, width = struct.unpack_from("<IHH", dbf, 4)
    fields, at = [], 32
    while dbf[at] != 0x0D:
        fields.append((dbf[at : at + 11].split(b"\0")[0].decode(encoding, "replace"), dbf[at + 16]))
        at += 32
    rows = []
    for i in range(n):
        at = head + i * width + 1
        row = {}
        for name, size in fields:
            row[name] = dbf[at : at + size].decode(encoding, "replace").strip()
            at += size
        rows.append(row)
    return rows


def write_shp(shapes: list, rows: list[dict], names: list[str]) -> dict[str, bytes]:
    """.shp, .shx, .dbf, .prj and .cpg bytes of multipolygons in EPSG:4326 with text attributes."""
    records, index, at = [], [], 50
    xs, ys = [x for s in shapes for p in s for r in p for x, _ in r] or [0.0], [y for s in shapes for p in s for r in p for _, y in r] or [0.0]
    for i, shape in enumerate(shapes):
        rings = [(r if (signed_area(r) < 0) == (k == 0) else r[::-1]) for p in shape for k, r in enumerate(p)]
        flat = [c for r in rings for xy in r for c in xy]
        starts = [sum(len(r) for r in rings[:k]) for k in range(len(rings))]
        bx, by = flat[::2] or [0.0], flat[1::2] or [0.0]
        body = struct.pack("<i4d2i", 5, min(bx), min(by), max(bx), max(by), len(rings), len(flat) // 2) + struct.pack(f"<{len(starts)}i", *starts) + struct.pack(f"<{len(flat)}d", *flat)
        records.append(struct.pack(">II", i + 1, len(body) // 2) + body)
        index.append(struct.pack(">II", at, len(body) // 2))
        at += len(records[-1]) // 2

    def head(words: int) -> bytes:
        return struct.pack(">I5II", 9994, 0, 0, 0, 0, 0, words) + struct.pack("<ii8d", 1000, 5, min(xs), min(ys), max(xs), max(ys), 0, 0, 0, 0)

    widths = [max([1, *[len(str(r.get(n, "")).encode()) for r in rows]]) for n in names]
    size = 32 + 32 * len(names) + 1
    dbf = struct.pack("<4BIHH20x", 3, 124, 1, 1, len(rows), size, 1 + sum(widths)) + b"".join(struct.pack("<11sc4xBB14x", n.encode()[:10], b"C", w, 0) for n, w in zip(names, widths, strict=True)) + b"\r"
    dbf += b"".join(b" " + b"".join(str(r.get(n, "")).encode().ljust(w) for n, w in zip(names, widths, strict=True)) for r in rows) + b"\x1a"
    prj = 'GEOGCS["GCS_WGS_1984",DATUM["D_WGS_1984",SPHEROID["WGS_1984",6378137.0,298.257223563]],PRIMEM["Greenwich",0.0],UNIT["Degree",0.0174532925199433]]'
    return {".shp": head(at) + b"".join(records), ".shx": head(50 + 4 * len(index)) + b"".join(index), ".dbf": dbf, ".prj": prj.encode(), ".cpg": b"UTF-8"}


def zipped(files: dict[str, bytes], stem: str) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for suffix, content in files.items():
            z.writestr(stem + suffix, content)
    return out.getvalue()


def read_zipped_shapefiles(files: DataFrame, ending: str = ".shp") -> DataFrame:
    """Features of the shapefiles in zip files (path, content); a file that can't be read gives a row with an error."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                try:
                    z = zipfile.ZipFile(io.BytesIO(content))
                    names = {n.lower(): n for n in z.namelist()}
                    for low in sorted(n for n in names if n.endswith(ending)):
                        side = lambda ext, low=low: z.read(names[low[:-4] + ext]) if low[:-4] + ext in names else None
                        shapes, dbf, prj = read_shp(z.read(names[low])), side(".dbf"), side(".prj")
                        table = read_dbf(dbf) if dbf else [{} for _ in shapes]
                        epsg = epsg_of(prj.decode("utf-8", "replace")) if prj else None
                        rows += [(path, names[low], epsg, t, s, None) for s, t in zip(shapes, table, strict=False)]
                except (ValueError, struct.error, zipfile.BadZipFile, IndexError) as e:
                    rows = [(path, None, None, None, None, str(e) or type(e).__name__)]
                yield frame(rows)

    return files.select("path", "content").mapInPandas(read, SCHEMA)


def read_shapefiles(files: DataFrame) -> DataFrame:
    """Features of shapefiles that lie side by side (path, content of .shp, .dbf and .prj files); one that can't be read gives a row with an error."""
    stem, ending = F.regexp_replace("path", r"(?i)\.(shp|dbf|prj)$", ""), F.lower(F.regexp_extract("path", r"\.([^.]*)$", 1))
    sides = files.select(stem.alias("stem"), ending.alias("ending"), "path", "content").filter(F.col("ending").isin("shp", "dbf", "prj"))
    one = sides.groupBy("stem").agg(*[F.max(F.when(F.col("ending") == e, F.col("content"))).alias(e) for e in ("shp", "dbf", "prj")], F.max(F.when(F.col("ending") == "shp", F.col("path"))).alias("path")).filter("shp is not null")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, shp, dbf, prj in zip(batch["path"], batch["shp"], batch["dbf"], batch["prj"], strict=True):
                try:
                    shapes = read_shp(shp)
                    table = read_dbf(dbf) if dbf is not None else [{} for _ in shapes]
                    rows = [(path, None, epsg_of(prj.decode("utf-8", "replace")) if prj is not None else None, t, s, None) for s, t in zip(shapes, table, strict=False)]
                except (ValueError, struct.error, IndexError) as e:
                    rows = [(path, None, None, None, None, str(e) or type(e).__name__)]
                yield frame(rows)

    return one.select("path", "shp", "dbf", "prj").mapInPandas(read, SCHEMA)


def bundle(rows: DataFrame, keys: list[str], properties: list[str], geometry: str = "geometry") -> DataFrame:
    """(layer, path, content) of a layer's files for each group of keys (the layer's name, which is the files' stem): .shp with its side-cars and all of them zipped, .geojson and that zipped, .gpkg.

    A shapefile or GeoPackage is one file, so a layer meets in one task. Polygons are in EPSG:4326.
    """
    kind = g.MULTI.simpleString()
    held = rows.select(F.concat_ws("_", *[F.col(k) for k in keys]).alias("layer"), F.struct(*[F.col(p).cast("string").alias(p) for p in properties]).alias("p"), F.col(geometry).cast(kind).alias("g"))

    def make(pdf: pd.DataFrame) -> pd.DataFrame:
        stem = pdf["layer"].iloc[0]
        pdf = pdf.assign(_o=[json.dumps(p, sort_keys=True, default=str) for p in pdf["p"]]).sort_values("_o", kind="stable")
        shapes = [[[[(q["x"], q["y"]) for q in ring] for ring in polygon] for polygon in v] if v is not None else [] for v in pdf["g"]]
        table = [{k: v for k, v in p.items() if v is not None} for p in pdf["p"]]
        sides = write_shp(shapes, table, properties)
        lines = [json.dumps({"type": "Feature", "properties": p, "geometry": {"type": "MultiPolygon", "coordinates": s}}, ensure_ascii=False) for p, s in zip(pdf["p"], shapes, strict=True)]
        document = feature_collection(lines).encode()
        out = {f"{stem}{e}": c for e, c in sides.items()} | {f"{stem}_shp.zip": zipped(sides, stem), f"{stem}.geojson": document, f"{stem}_geojson.zip": zipped({".geojson": document}, stem), f"{stem}.gpkg": geopackage({stem: (shapes, table, 4326)})}
        return pd.DataFrame({"layer": stem, "path": list(out), "content": list(out.values())})

    return held.groupBy("layer").applyInPandas(make, "layer string, path string, content binary")


def frame(rows: list[tuple]) -> pd.DataFrame:
    names = ["path", "layer", "epsg", "properties", "geometry", "error"]
    out = pd.DataFrame([(*r[:3], None if r[3] is None else {k: None if v is None else str(v) for k, v in r[3].items()}, None if r[4] is None else [[[{"x": x, "y": y} for x, y in ring] for ring in p] for p in r[4]], r[5]) for r in rows], columns=names)
    return out.astype({"epsg": "Int32"})


# ---------------------------------------------------------------- GeoPackage


def wkb_polygons(b: bytes) -> list:
    """Multipolygon of WKB polygons and multipolygons (2-D, or with further ordinates, which are left out)."""

    def one(at: int) -> tuple[list, int]:
        order = "<" if b[at] else ">"
        (kind,) = struct.unpack_from(order + "I", b, at + 1)
        dims = 2 + (kind // 1000 in (1, 2)) + 2 * (kind // 1000 == 3) + bool(kind & 0x80000000) + bool(kind & 0x40000000)
        base = (kind & 0xFFFF) % 1000
        (n,) = struct.unpack_from(order + "I", b, at + 5)
        at += 9
        if base == 6:
            out = []
            for _ in range(n):
                part, at = one(at)
                out += part
            return out, at
        if base != 3:
            raise ValueError(f"WKB of kind {base} is no polygon")
        rings = []
        for _ in range(n):
            (m,) = struct.unpack_from(order + "I", b, at)
            flat = struct.unpack_from(f"{order}{m * dims}d", b, at + 4)
            rings.append([(flat[i * dims], flat[i * dims + 1]) for i in range(m)])
            at += 4 + 8 * m * dims
        return [rings], at

    return one(0)[0]


def polygon_wkb(shape: list) -> bytes:
    body = b"".join(b"\x01" + struct.pack("<II", 3, len(p)) + b"".join(struct.pack("<I", len(r)) + struct.pack(f"<{2 * len(r)}d", *[c for xy in r for c in xy]) for r in p) for p in shape)
    return b"\x01" + struct.pack("<II", 6, len(shape)) + body


def read_geopackages(files: DataFrame) -> DataFrame:
    """Features of all layers of GeoPackage files (path, content)."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                rows = []
                try:
                    db = sqlite3.connect(":memory:")
                    db.deserialize(content)
                    for layer, column, srs in db.execute("SELECT table_name, column_name, srs_id FROM gpkg_geometry_columns ORDER BY 1").fetchall():
                        cursor = db.execute(f'SELECT * FROM "{layer}"')
                        names = [d[0] for d in cursor.description]
                        for values in cursor:
                            row = dict(zip(names, values, strict=True))
                            blob = row.pop(column)
                            skip = 8 + (0, 32, 48, 48, 64)[blob[3] >> 1 & 7] if blob else 0
                            rows.append((path, layer, srs, row, wkb_polygons(bytes(blob[skip:])) if blob else None, None))
                except (ValueError, struct.error, sqlite3.Error, IndexError) as e:
                    rows = [(path, None, None, None, None, str(e) or type(e).__name__)]
                yield frame(rows)

    return files.select("path", "content").mapInPandas(read, SCHEMA)


def geopackage(layers: dict[str, tuple[list, list[dict], int]]) -> bytes:
    """A GeoPackage of layers: name to (multipolygons, attributes, EPSG code)."""
    db = sqlite3.connect(":memory:")
    db.executescript("""CREATE TABLE gpkg_contents (table_name TEXT PRIMARY KEY, data_type TEXT, identifier TEXT, srs_id INTEGER);
      CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT, geometry_type_name TEXT, srs_id INTEGER, z INTEGER, m INTEGER);""")
    for name, (shapes, rows, epsg) in layers.items():
        columns = list(dict.fromkeys(k for r in rows for k in r))
        db.execute(f'CREATE TABLE "{name}" (fid INTEGER PRIMARY KEY, geom BLOB{"".join(f""", "{c}" TEXT""" for c in columns)})')
        db.execute("INSERT INTO gpkg_contents VALUES (?, 'features', ?, ?)", (name, name, epsg))
        db.execute("INSERT INTO gpkg_geometry_columns VALUES (?, 'geom', 'MULTIPOLYGON', ?, 0, 0)", (name, epsg))
        for shape, row in zip(shapes, rows, strict=True):
            blob = b"GP\x00\x01" + struct.pack("<i", epsg) + polygon_wkb(shape)
            db.execute(f'INSERT INTO "{name}" VALUES (NULL, ?{", ?" * len(columns)})', (blob, *[row.get(c) for c in columns]))
    db.commit()
    return db.serialize()


