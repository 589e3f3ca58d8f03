"""GeoTIFF: classic TIFF, strips or tiles, none or deflate compression, predictors 1 to 3, integer and float samples, several bands.

encode() and decode() work on bytes; read_pixels() and read_info() on files that Spark lists.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Tags and field types of the format.
KINDS = {1: ("B", 1), 2: ("c", 1), 3: ("H", 2), 4: ("I", 4), 5: ("II", 8), 11: ("f", 4), 12: ("d", 8), 16: ("Q", 8)}
WIDTH, HEIGHT, BITS, COMPRESSION, PHOTOMETRIC, STRIPS, SAMPLES, ROWS, STRIP_BYTES = 256, 257, 258, 259, 262, 273, 277, 278, 279
PLANAR, PREDICTOR, TILE_W, TILE_H, TILES, TILE_BYTES, EXTRA, FORMAT = 284, 317, 322, 323, 324, 325, 338, 339
SCALE, TIEPOINT, KEYS, NODATA = 33550, 33922, 34735, 42113


@dataclass
class Raster:
    bands: np.ndarray  # band, row, column
    transform: tuple[float, float, float, float, float, float]  # a, b, c, d, e, f
    epsg: int | None = None
    nodata: float | None = None

    def band(self, i: int = 0) -> np.ndarray:
        """A band as floats, NaN for nodata."""
        out = self.bands[i].astype(float)
        if self.nodata is not None:
            out[out == self.nodata] = np.nan
        return out


def forward(a: np.ndarray, predictor: int) -> bytes:
    """Bytes of a block (row, column, sample) after the predictor."""
    if predictor == 2:
        d = a.view(f"u{a.itemsize}").copy()
        d[:, 1:] -= a.view(f"u{a.itemsize}")[:, :-1]
        return d.tobytes()
    if predictor == 3:
        h, w, s = a.shape
        planes = a.astype(a.dtype.newbyteorder(">")).view("u1").reshape(h, w * s, a.itemsize).transpose(0, 2, 1).reshape(h, -1)
        d = planes.copy()
        d[:, s:] -= planes[:, :-s]
        return d.tobytes()
    return a.tobytes()


def backward(data: bytes, shape: tuple[int, int, int], dtype: np.dtype, predictor: int) -> np.ndarray:
    h, w, s = shape
    if predictor == 3:
        d = np.frombuffer(data, "u1").reshape(h, -1).copy().reshape(h, -1, s)
        planes = np.add.accumulate(d, axis=1, dtype="u1").reshape(h, dtype.itemsize, w * s).transpose(0, 2, 1)
        return np.ascontiguousarray(planes).view(dtype.newbyteorder(">")).reshape(shape).astype(dtype.newbyteorder("="))
    a = np.frombuffer(data, dtype, h * w * s).reshape(shape)
    if predictor == 2:
        a = np.add.accumulate(a.view(f"{dtype.byteorder}u{dtype.itemsize}"), axis=1, dtype=f"u{dtype.itemsize}").view(dtype.newbyteorder("="))
    return a.astype(dtype.newbyteorder("="))


def block_of(part: np.ndarray, tile: int, predictor: int) -> bytes:
    """A compressed tile (row, column, band), filled up at the grid's edges."""
    block = np.zeros((tile, tile, part.shape[2]), part.dtype)
    block[: part.shape[0], : part.shape[1]] = part
    return zlib.compress(forward(block, predictor), 6)


def predictor_of(dtype: np.dtype) -> int:
    """3 for floats, 2 for integers."""
    return 3 if np.dtype(dtype).kind == "f" else 2


def encode(r: Raster, tile: int = 256, predictor: int | None = None) -> bytes:
    """A little-endian, tiled, deflated GeoTIFF; predictor 3 for floats and 2 for integers by default."""
    bands, h, w = r.bands.shape
    a = np.ascontiguousarray(r.bands.transpose(1, 2, 0)).astype(r.bands.dtype.newbyteorder("<"))
    predictor = predictor or predictor_of(a.dtype)
    blocks = [block_of(a[y : y + tile, x : x + tile], tile, predictor) for y in range(0, h, tile) for x in range(0, w, tile)]
    return assembled(blocks, (bands, h, w), a.dtype, r.transform, r.epsg, r.nodata, tile, predictor)


def assembled(blocks: list[bytes], shape: tuple[int, int, int], dtype: np.dtype, transform: tuple, epsg: int | None, nodata: float | None, tile: int, predictor: int) -> bytes:
    """The file of a grid (bands, rows, columns) from its compressed tiles in reading order. Three bands of bytes are colours."""
    (bands, h, w), a = shape, np.dtype(dtype)
    code = {"u": 1, "i": 2, "f": 3}[a.kind]
    ta, tb, tc, td, te, tf = transform
    tags: list[tuple[int, int, list]] = [
        (WIDTH, 4, [w]), (HEIGHT, 4, [h]), (BITS, 3, [a.itemsize * 8] * bands), (COMPRESSION, 3, [8]), (PHOTOMETRIC, 3, [2 if bands in (3, 4) and a == np.uint8 else 1]), (SAMPLES, 3, [bands]), (PLANAR, 3, [1]), (PREDICTOR, 3, [predictor]),
        (TILE_W, 4, [tile]), (TILE_H, 4, [tile]), (TILES, 4, [0] * len(blocks)), (TILE_BYTES, 4, [len(b) for b in blocks]), (FORMAT, 3, [code] * bands),
        (SCALE, 12, [ta, -te, 0.0]), (TIEPOINT, 12, [0.0, 0.0, 0.0, tc, tf, 0.0]),
    ]
    if bands == 4 and a == np.uint8:
        tags.append((EXTRA, 3, [2]))  # the fourth is opacity
    if epsg:
        projected = epsg != 4326
        tags.append((KEYS, 3, [1, 1, 0, 2, 1024, 0, 1, 1 if projected else 2, 3072 if projected else 2048, 0, 1, epsg]))
    if nodata is not None:
        tags.append((NODATA, 2, [bytes([c]) for c in f"{nodata!r}".encode() + b"\0"]))
    assert tb == td == 0, "only north-up grids are written"
    size = 8 + 2 + 12 * len(tags) + 4
    extra, at = b"", size
    rows = []
    total = sum(len(v) * KINDS[k][1] for _, k, v in tags if len(v) * KINDS[k][1] > 4)
    start = size + total + total % 2
    offsets = np.cumsum([start, *[len(b) for b in blocks]])[:-1].tolist()
    for tag, kind, values in sorted(tags):
        values = offsets if tag == TILES else values
        code_, width = KINDS[kind]
        raw = struct.pack(f"<{len(values)}{code_}", *values)
        if len(raw) <= 4:
            rows.append(struct.pack("<HHI", tag, kind, len(values)) + raw.ljust(4, b"\0"))
        else:
            rows.append(struct.pack("<HHII", tag, kind, len(values), at + len(extra)))
            extra += raw
    return b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(tags)) + b"".join(rows) + bytes(4) + extra + bytes(total % 2) + b"".join(blocks)


def tags_of(data: bytes) -> tuple[str, dict[int, tuple]]:
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack(order + "H", data[2:4])[0] != 42:
        raise ValueError("not a TIFF file")
    at = struct.unpack(order + "I", data[4:8])[0]
    out = {}
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if kind in KINDS:
            code, width = KINDS[kind]
            where = at + 2 + 12 * i + 8
            if n * width > 4:
                where = struct.unpack_from(order + "I", data, where)[0]
            out[tag] = struct.unpack_from(f"{order}{n * len(code)}{code[0]}", data, where)
    return order, out


def header(data: bytes) -> dict:
    """Size, bands, type, transform, EPSG code and nodata value, without reading samples."""
    order, t = tags_of(data)
    bands = t.get(SAMPLES, (1,))[0]
    kind = {1: "u", 2: "i", 3: "f"}[t.get(FORMAT, (1,))[0]]
    scale, tie = t.get(SCALE, (1.0, 1.0, 0.0)), t.get(TIEPOINT, (0.0,) * 6)
    keys = t.get(KEYS, ())
    found = {keys[i]: keys[i + 3] for i in range(4, len(keys), 4) if keys[i + 1] == 0}
    nodata = b"".join(t[NODATA]).rstrip(b"\0 ").decode() if NODATA in t else None
    return {
        "width": t[WIDTH][0], "height": t[HEIGHT][0], "bands": bands, "dtype": np.dtype(f"{order}{kind}{t.get(BITS, (1,))[0] // 8}"), "epsg": found.get(3072) or found.get(2048),
        "transform": (scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1]), "nodata": float(nodata) if nodata else None,
    }


def decode(data: bytes) -> Raster:
    order, t = tags_of(data)
    about = header(data)
    h, w, bands, dtype = about["height"], about["width"], about["bands"], about["dtype"]
    compression, predictor, split = t.get(COMPRESSION, (1,))[0], t.get(PREDICTOR, (1,))[0], t.get(PLANAR, (1,))[0] == 2
    if compression not in (1, 8, 32946):
        raise ValueError(f"compression {compression} is not read")
    tiled = TILES in t
    bw, bh = (t[TILE_W][0], t[TILE_H][0]) if tiled else (w, min(t.get(ROWS, (h,))[0], h))
    offsets, sizes = (t[TILES], t[TILE_BYTES]) if tiled else (t[STRIPS], t[STRIP_BYTES])
    across, down = -(-w // bw), -(-h // bh)
    out = np.zeros((bands, h, w), dtype.newbyteorder("="))
    each = 1 if split else bands
    for i, (at, size) in enumerate(zip(offsets, sizes, strict=True)):
        plane, k = divmod(i, across * down) if split else (0, i)
        y, x = k // across * bh, k % across * bw
        raw = data[at : at + size]
        raw = zlib.decompress(raw) if compression != 1 else raw
        rows = bh if tiled else min(bh, h - y)
        block = backward(raw, (rows, bw, each), dtype, predictor)[: h - y, : w - x]
        part = block.transpose(2, 0, 1)
        out[plane : plane + 1 if split else bands, y : y + part.shape[1], x : x + part.shape[2]] = part
    return Raster(out, about["transform"], about["epsg"], about["nodata"])


def read_pixels(files: DataFrame, bands: int, names: list[str], rows_at_once: int = 256) -> DataFrame:
    """path, row, col and a column for each band of GeoTIFF files (path, content); NULL for nodata."""
    schema = ", ".join(["path string", "row int", "col int", *[f"`{n}` double" for n in names]])

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"], strict=True):
                r = decode(content)
                layers = [r.band(i) for i in range(bands)]
                h, w = layers[0].shape
                for y in range(0, h, rows_at_once):
                    n = min(rows_at_once, h - y)
                    out = {"path": [path] * (n * w), "row": np.repeat(np.arange(y, y + n, dtype="int32"), w), "col": np.tile(np.arange(w, dtype="int32"), n)}
                    out |= {name: pd.Series(layer[y : y + n].ravel()).where(lambda v: np.isfinite(v), None) for name, layer in zip(names, layers, strict=True)}
                    yield pd.DataFrame(out)

    return files.select("path", "content").mapInPandas(read, schema)


def read_info(files: DataFrame) -> DataFrame:
    """path, width, height, bands, epsg, nodata, transform and error of GeoTIFF files."""
    schema = "path string, width int, height int, bands int, epsg int, nodata double, transform array<double>, error string"

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                try:
                    a = header(content)
                    rows.append((path, a["width"], a["height"], a["bands"], a["epsg"], a["nodata"], list(a["transform"]), None))
                except (ValueError, KeyError, struct.error, IndexError) as e:
                    rows.append((path, None, None, None, None, None, None, str(e) or type(e).__name__))
            frame = pd.DataFrame(rows, columns=["path", "width", "height", "bands", "epsg", "nodata", "transform", "error"])
            yield frame.astype({c: "Int32" for c in ("width", "height", "bands", "epsg")})

    return files.select("path", "content").mapInPandas(read, schema)


#: Columns of a grid that rasters are written on: upper left corner, cell sizes, EPSG code and size in cells.
GRID = ["x0", "y0", "dx", "dy", "epsg", "height", "width"]


def raster_files(px: DataFrame, keys: list[str], files: dict[str, list[str]], dtype: str = "float32", nodata: float | None = -9999.0, tile: int = 256) -> DataFrame:
    """(path, content) of GeoTIFFs, one for each group of keys and each of files (template of a path, with the keys' names in braces: its bands).

    px: keys, the GRID columns, row, col and the bands. Tiles are compressed by tasks, a tile in each; what assembles a file holds its compressed tiles only.
    """
    kinds = {f.name: f.dataType.simpleString() for f in px.schema}
    group = [*keys, *[c for c in GRID if c not in keys]]
    each = F.array(*[F.struct(F.lit(name).alias("file"), F.array(*[F.col(c).cast("double") for c in bands]).alias("v")) for name, bands in files.items()])
    long = px.select(*group, "row", "col", F.explode(each).alias("e")).select(*group, "row", "col", "e.*")
    long = long.withColumns({"ty": F.floor(F.col("row") / tile), "tx": F.floor(F.col("col") / tile)})
    fixed = ", ".join(f"`{c}` {kinds[c]}" for c in group)

    def blocks(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[0]
        ty, tx, bands = int(one["ty"]), int(one["tx"]), len(one["v"])
        part = np.full((min(tile, int(one["height"]) - ty * tile), min(tile, int(one["width"]) - tx * tile), bands), 0 if nodata is None else nodata, np.dtype(dtype).newbyteorder("<"))
        v = np.stack(pdf["v"].to_numpy()).astype(float)
        part[pdf["row"].to_numpy() - ty * tile, pdf["col"].to_numpy() - tx * tile] = np.where(np.isfinite(v), v, 0 if nodata is None else nodata)
        return pd.DataFrame({**{c: [one[c]] for c in group}, "file": [one["file"]], "ty": [ty], "tx": [tx], "block": [block_of(part, tile, predictor_of(dtype))]})

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        one = pdf.iloc[0]
        h, w, bands = int(one["height"]), int(one["width"]), len(files[one["file"]])
        empty = block_of(np.full((tile, tile, bands), 0 if nodata is None else nodata, np.dtype(dtype).newbyteorder("<")), tile, predictor_of(dtype))
        held = {(int(y), int(x)): b for y, x, b in zip(pdf["ty"], pdf["tx"], pdf["block"], strict=True)}
        parts = [held.get((y, x), empty) for y in range(-(-h // tile)) for x in range(-(-w // tile))]
        transform = (float(one["dx"]), 0.0, float(one["x0"]), 0.0, -float(one["dy"]), float(one["y0"]))
        content = assembled(parts, (bands, h, w), np.dtype(dtype).newbyteorder("<"), transform, int(one["epsg"]), nodata, tile, predictor_of(dtype))
        return pd.DataFrame({"path": [one["file"].format(**{k: one[k] for k in keys})], "content": [content]})

    tiles = long.groupBy(*group, "file", "ty", "tx").applyInPandas(blocks, f"{fixed}, file string, ty int, tx int, block binary")
    return tiles.groupBy(*group, "file").applyInPandas(whole, "path string, content binary")


def encoded(px: DataFrame, keys: list[str], layers: list[str], transform: tuple, epsg: int, dtype: str = "float32", nodata: float = -9999.0) -> DataFrame:
    """keys and `content`: a GeoTIFF of each group's layers. A group is one grid and must fit a task's memory."""
    kinds = {f.name: f.dataType.simpleString() for f in px.schema}
    schema = ", ".join([*[f"`{k}` {kinds[k]}" for k in keys], "content binary"])

    def write(pdf: pd.DataFrame) -> pd.DataFrame:
        r, c = pdf["row"].to_numpy(), pdf["col"].to_numpy()
        grid = np.full((len(layers), r.max() + 1, c.max() + 1), nodata, dtype)
        for i, n in enumerate(layers):
            v = pdf[n].to_numpy(float)
            grid[i, r, c] = np.where(np.isfinite(v), v, nodata)
        return pd.DataFrame({**{k: [pdf[k].iloc[0]] for k in keys}, "content": [encode(Raster(grid, transform, epsg, nodata))]})

    return px.groupBy(*keys).applyInPandas(write, schema)
