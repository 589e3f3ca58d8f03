"""ISO media containers: boxes, sample tables and keyframe ranges, without decoding what the samples hold.

`describe` walks the nested boxes of a container, decodes the sample tables of its tracks, those of fragments too, and tells codec, duration
and the byte ranges of keyframes of each. `wrap` makes a container of bytes kept as 8-bit samples. Both work on one value of a media column.
"""

from __future__ import annotations

import hashlib
import json
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batched, materialise

#: Boxes that hold boxes.
NESTS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"dinf", b"edts", b"udta", b"mvex", b"moof", b"traf"}
#: Flags of track fragments and of their runs, and the bit of a sample's flags that says it depends on others.
BASE, DEFAULT_INDEX, DEFAULT_DURATION, DEFAULT_SIZE, DEFAULT_FLAGS, FROM_MOOF = 0x1, 0x2, 0x8, 0x10, 0x20, 0x20000
RUN_OFFSET, FIRST_FLAGS, RUN_DURATION, RUN_SIZE, RUN_FLAGS, RUN_TIME = 0x1, 0x4, 0x100, 0x200, 0x400, 0x800
DEPENDS = 0x10000
#: Bytes of a sample that wrap() makes, samples of a chunk, samples from one keyframe to the next, and samples a second.
UNIT, PER_CHUNK, PER_KEYFRAME, RATE = 64, 256, 16, 8000
IDENTITY = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


class Broken(ValueError):
    """A container that can't be read."""


def box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    return struct.pack(">I", 8 + len(body)) + kind + body if len(body) < 0xFFFFFFF0 else struct.pack(">I", 1) + kind + struct.pack(">Q", 16 + len(body)) + body


def full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return box(kind, struct.pack(">I", version << 24 | flags), *parts)


def padded(payload: bytes) -> bytes:
    """payload with zero bytes up to a positive multiple of UNIT."""
    return payload + bytes(max(UNIT, -(-len(payload) // UNIT) * UNIT) - len(payload))


def wrap(payload: bytes) -> bytes:
    """A container with one sound track of unsigned 8-bit samples ("raw ") that holds the payload, a positive multiple of UNIT bytes, as it is."""
    count = len(payload) // UNIT
    chunks = -(-count // PER_CHUNK)
    duration = len(payload)
    keyframes = np.arange(1, count + 1, PER_KEYFRAME, dtype=">u4")
    last = count - (chunks - 1) * PER_CHUNK
    in_chunks = [(1, PER_CHUNK, 1)] * (chunks > 1) + [(chunks, last, 1)] if last != PER_CHUNK and chunks > 1 else [(1, min(count, PER_CHUNK), 1)]

    def moov(base: int) -> bytes:
        offsets = base + np.arange(chunks, dtype=np.int64) * PER_CHUNK * UNIT
        large = base + len(payload) > 0xFFFFFFFF
        table = full(b"co64", struct.pack(">I", chunks), offsets.astype(">u8").tobytes()) if large else full(b"stco", struct.pack(">I", chunks), offsets.astype(">u4").tobytes())
        entry = box(b"raw ", bytes(6), struct.pack(">HII4HI", 1, 0, 0, 1, 8, 0, 0, RATE << 16))
        stbl = box(
            b"stbl", full(b"stsd", struct.pack(">I", 1), entry), full(b"stts", struct.pack(">III", 1, count, UNIT)), full(b"stss", struct.pack(">I", len(keyframes)), keyframes.tobytes()),
            full(b"stsc", struct.pack(">I", len(in_chunks)), *(struct.pack(">III", *x) for x in in_chunks)), full(b"stsz", struct.pack(">II", UNIT, count)), table,
        )
        times = struct.pack(">QQIQ", 0, 0, RATE, duration)
        mdia = box(
            b"mdia", full(b"mdhd", times, struct.pack(">HH", 0x55C4, 0), version=1), full(b"hdlr", bytes(4), b"soun", bytes(12), b"samples\0"),
            box(b"minf", full(b"smhd", bytes(4)), box(b"dinf", full(b"dref", struct.pack(">I", 1), full(b"url ", flags=1))), stbl),
        )
        tkhd = full(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, duration), bytes(8), struct.pack(">HHHH", 0, 0, 0x100, 0), IDENTITY, bytes(8), version=1, flags=7)
        mvhd = full(b"mvhd", times, struct.pack(">IH", 0x10000, 0x100), bytes(10), IDENTITY, bytes(24), struct.pack(">I", 2), version=1)
        return box(b"moov", mvhd, box(b"trak", tkhd, mdia))

    head = box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2mp41")
    size = len(moov(0))
    base = len(head) + size + (8 if len(payload) < 0xFFFFFFF0 else 16)
    size = len(moov(base))
    return head + moov(len(head) + size + (8 if len(payload) < 0xFFFFFFF0 else 16)) + box(b"mdat", payload)


def walk(data: memoryview, start: int, end: int, path: tuple[bytes, ...] = ()) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """Path, start and end of the body of every box, in order, nests opened."""
    at = start
    while at < end:
        if end - at < 8:
            if path and not any(data[at:end]):
                return  # a list of boxes may end with zeros
            raise Broken("a box is cut off")
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1:
            if end - at < 16:
                raise Broken("a box is cut off")
            size, body = struct.unpack_from(">Q", data, at + 8)[0], at + 16
        elif size == 0:
            size = end - at
        if size < body - at or at + size > end:
            raise Broken(f"box {kind!r} reaches outside its parent")
        yield (*path, kind), body, at + size
        if kind in NESTS:
            if len(path) > 16:
                raise Broken("boxes are nested too deeply")
            yield from walk(data, body, at + size, (*path, kind))
        at += size


def numbers(data: memoryview, at: int, end: int, columns: int, kind: str = ">u4") -> np.ndarray:
    """The rows of a table that follows its version, flags and count."""
    (count,) = struct.unpack_from(">I", data, at + 4)
    width = columns * np.dtype(kind).itemsize
    if at + 8 + count * width > end:
        raise Broken("a table is longer than its box")
    return np.frombuffer(data, kind, count * columns, at + 8).astype(np.int64).reshape(count, columns)


def compact_sizes(data: memoryview, at: int, end: int) -> np.ndarray:
    """Sample sizes of 4, 8 or 16 bits."""
    width, (count,) = data[at + 7], struct.unpack_from(">I", data, at + 8)
    if width not in (4, 8, 16) or at + 12 + (count * width + 7) // 8 > end:
        raise Broken("the sample sizes are cut off")
    if width == 4:
        both = np.frombuffer(data, np.uint8, (count + 1) // 2, at + 12)
        return np.stack([both >> 4, both & 15], axis=1).ravel()[:count].astype(np.int64)
    return np.frombuffer(data, ">u2" if width == 16 else np.uint8, count, at + 12).astype(np.int64)


def fragment_header(data: memoryview, at: int, moof: int, defaults: dict[int, tuple[int, int, int]]) -> dict:
    """What a track fragment says of its samples: track, where its data begin, and default duration, size and flags."""
    flags, track = struct.unpack_from(">II", data, at)
    flags &= 0xFFFFFF
    at += 8
    out = {"track": track, "base": None, "from_moof": bool(flags & FROM_MOOF), "moof": moof}
    duration, size, own = defaults.get(track, (0, 0, 0))
    if flags & BASE:
        (out["base"],) = struct.unpack_from(">Q", data, at)
        at += 8
    if flags & DEFAULT_INDEX:
        at += 4
    for flag, name, value in ((DEFAULT_DURATION, "duration", duration), (DEFAULT_SIZE, "size", size), (DEFAULT_FLAGS, "flags", own)):
        out[name] = struct.unpack_from(">I", data, at)[0] if flags & flag else value
        at += 4 if flags & flag else 0
    return out


def run_of(data: memoryview, at: int, end: int, head: dict, after: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Offsets, sizes and keys of a run's samples, and the durations' sum. `after` is where the run before it ends."""
    flags, count = struct.unpack_from(">II", data, at)
    flags &= 0xFFFFFF
    at += 8
    base = head["base"] if head["base"] is not None else head["moof"]
    start = after
    if flags & RUN_OFFSET:
        start = base + struct.unpack_from(">i", data, at)[0]
        at += 4
    first = None
    if flags & FIRST_FLAGS:
        (first,) = struct.unpack_from(">I", data, at)
        at += 4
    names = [n for flag, n in ((RUN_DURATION, "duration"), (RUN_SIZE, "size"), (RUN_FLAGS, "flags"), (RUN_TIME, "time")) if flags & flag]
    if at + 4 * len(names) * count > end or not names and count > len(data):
        raise Broken("a run of samples is cut off")
    rows = np.frombuffer(data, ">u4", count * len(names), at).astype(np.int64).reshape(count, len(names))
    column = lambda n: rows[:, names.index(n)] if n in names else np.full(count, head[n], np.int64)
    sizes, marks = column("size"), column("flags").copy()
    if first is not None and count:
        marks[0] = first
    return start + np.cumsum(sizes) - sizes, sizes, (marks & DEPENDS) == 0, int(column("duration").sum())


def tracks_of(data: memoryview) -> list[dict]:
    """What each track says: its id, handler, codec, timescale, duration, and offsets and sizes of its samples and which are keys, in its tables and then in fragments."""
    tracks: list[dict] = []
    defaults: dict[int, tuple[int, int, int]] = {}
    head: dict | None = None
    moof, after = 0, 0
    for path, at, end in walk(data, 0, len(data)):
        kind = path[-1]
        if path == (b"moov", b"trak"):
            tracks.append({"id": len(tracks) + 1, "parts": []})
        elif path == (b"moov", b"mvex", b"trex"):
            track, _, duration, size, flags = struct.unpack_from(">5I", data, at + 4)
            defaults[track] = duration, size, flags
        elif path == (b"moof",):
            moof = after = at - 8 if struct.unpack_from(">I", data, at - 8)[0] != 1 and bytes(data[at - 4 : at]) == b"moof" else at - 16
        elif path == (b"moof", b"traf", b"tfhd"):
            head = fragment_header(data, at, moof, defaults)
            after = head["base"] if head["base"] is not None else moof if head["from_moof"] else after
        elif path == (b"moof", b"traf", b"trun"):
            if head is None:
                raise Broken("a run of samples without a header")
            offsets, sizes, keys, duration = run_of(data, at, end, head, after)
            after = int(offsets[-1] + sizes[-1]) if len(offsets) else after
            t = next((t for t in tracks if t["id"] == head["track"]), None)
            if t is None:
                raise Broken("a fragment of no track")
            t["parts"].append((offsets, sizes, keys))
            t["fragments"] = t.get("fragments", 0) + duration
        elif len(path) > 2 and path[:2] == (b"moov", b"trak"):
            t = tracks[-1]
            if kind == b"tkhd":
                (t["id"],) = struct.unpack_from(">I", data, at + (20 if data[at] else 12))
            elif kind == b"mdhd":
                version = data[at]
                t["timescale"], t["duration"] = struct.unpack_from(">IQ" if version else ">II", data, at + (20 if version else 12))
            elif kind == b"hdlr":
                t["handler"] = bytes(data[at + 8 : at + 12]).decode("latin-1")
            elif kind == b"stsd":
                t["codec"] = bytes(data[at + 12 : at + 16]).decode("latin-1")
            elif kind == b"stss":
                t["stss"] = numbers(data, at, end, 1)[:, 0]
            elif kind == b"stsc":
                t["stsc"] = numbers(data, at, end, 3)
            elif kind == b"stsz":
                fixed, count = struct.unpack_from(">II", data, at + 4)
                if not fixed and at + 12 + 4 * count > end or fixed and fixed * count > len(data):
                    raise Broken("the sample sizes are cut off")
                t["sizes"] = np.full(count, fixed, np.int64) if fixed else np.frombuffer(data, ">u4", count, at + 12).astype(np.int64)
            elif kind == b"stz2":
                t["sizes"] = compact_sizes(data, at, end)
            elif kind in (b"stco", b"co64"):
                t["chunks"] = numbers(data, at, end, 1, ">u4" if kind == b"stco" else ">u8")[:, 0]
    for t in tracks:
        sizes = t.get("sizes", np.zeros(0, np.int64))
        keys = np.ones(len(sizes), bool)
        if "stss" in t and len(sizes):
            if len(t["stss"]) and (t["stss"].min() < 1 or t["stss"].max() > len(sizes)):
                raise Broken("a keyframe is no sample")
            keys[:] = False
            keys[t["stss"] - 1] = True
        parts = [(sample_offsets(t), sizes, keys), *t["parts"]]
        t["offsets"], t["sizes"], t["keys"] = (np.concatenate([p[i] for p in parts]) for i in range(3))
        t["duration"] = t.get("duration") or t.get("fragments") or t.get("duration")
        if len(t["offsets"]) and (int((t["offsets"] + t["sizes"]).max()) > len(data) or int(t["offsets"].min()) < 0):
            raise Broken("samples lie outside the file")
    return tracks


def sample_offsets(t: dict) -> np.ndarray:
    """File offset of every sample, from chunk offsets, samples for each chunk, and sizes."""
    sizes, chunks, runs = t.get("sizes", np.zeros(0, np.int64)), t.get("chunks", np.zeros(0, np.int64)), t.get("stsc", np.zeros((0, 3), np.int64))
    if not len(sizes):
        return np.zeros(0, np.int64)
    if not len(chunks) or not len(runs):
        raise Broken("samples without chunks")
    firsts = np.append(runs[:, 0], len(chunks) + 1)
    if firsts[0] != 1 or (np.diff(firsts) < 0).any():
        raise Broken("chunk runs are out of order")
    each = np.repeat(runs[:, 1], np.diff(firsts))
    if int(each.sum()) < len(sizes):
        raise Broken("chunks hold fewer samples than there are")
    ends = np.minimum(np.cumsum(each), len(sizes))
    starts = np.append(0, ends[:-1])
    chunk = np.repeat(np.arange(len(chunks)), ends - starts)
    before = np.cumsum(sizes) - sizes
    return chunks[chunk] + before - before[np.minimum(starts, len(sizes) - 1)][chunk]


def keyframe_ranges(t: dict) -> list[tuple[int, int]]:
    """Byte ranges of samples that can be decoded by themselves: those that the sync table or their fragments mark, or all if nothing does. Neighbours are joined."""
    starts, ends = t["offsets"][t["keys"]], (t["offsets"] + t["sizes"])[t["keys"]]
    if not len(starts):
        return []
    cut = np.flatnonzero(np.append(True, starts[1:] != ends[:-1]))
    return list(zip(starts[cut].tolist(), ends[np.append(cut[1:] - 1, len(ends) - 1)].tolist(), strict=True))


TRACK = ["codec", "handler", "timescale", "duration", "n_samples", "n_keyframes", "keyframes"]


def told(t: dict) -> dict:
    return {"codec": t.get("codec"), "handler": t.get("handler"), "timescale": t.get("timescale"), "duration": t.get("duration"), "n_samples": len(t["sizes"]), "n_keyframes": int(t["keys"].sum()), "keyframes": keyframe_ranges(t)}


def main_track(tracks: list[dict]) -> dict:
    """The first video track with samples, else the first with samples, else the first."""
    full_ = [t for t in tracks if len(t["sizes"])]
    return next((t for t in full_ if t.get("handler") == "vide"), (full_ or tracks)[0])


def describe(media: bytes | None) -> dict:
    """codec, handler, timescale, duration, n_samples, n_keyframes and keyframes (byte ranges) of the main track, and of each track under `tracks` with its id; error, if it can't be read."""
    empty = dict.fromkeys([*TRACK, "tracks", "error"])
    if not media:
        return empty | {"error": "no bytes"}
    try:
        tracks = tracks_of(memoryview(media))
        if not tracks:
            raise Broken("no track")
        return empty | told(main_track(tracks)) | {"tracks": [{"track_id": t["id"]} | told(t) for t in tracks]}
    except (Broken, struct.error, ValueError, IndexError, OverflowError, MemoryError) as e:
        return empty | {"error": str(e) or type(e).__name__}


def bytes_of(media: bytes, t: dict) -> bytes:
    """The bytes of all samples of a track, in order, found by its tables."""
    offsets, ends = t["offsets"], t["offsets"] + t["sizes"]
    cut = np.flatnonzero(np.append(True, offsets[1:] != ends[:-1]))
    return b"".join(media[a:b] for a, b in zip(offsets[cut].tolist(), ends[np.append(cut[1:] - 1, len(ends) - 1)].tolist(), strict=True))


def samples_of(media: bytes) -> bytes:
    """The bytes of all samples of the main track."""
    return bytes_of(media, main_track(tracks_of(memoryview(media))))


STORED = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())])


def wrapper(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                payload = (text.as_py() or "").encode("utf-8", "surrogatepass")
                yield doc, len(payload), wrap(padded(payload))

    yield from batched(made(), STORED)


def store_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, media): each whole text (null: empty) as a container. Repeated rows stay, a null doc_id stays null, extra columns are ignored."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(wrapper, "doc_id long, n_bytes long, media binary")


RANGES = "array<struct<start: long, end: long>>"
TRACK_DDL = f"codec: string, handler: string, timescale: long, duration: long, n_samples: long, n_keyframes: long, keyframes: {RANGES}"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
TRACK_FIELDS = [("codec", pa.string()), ("handler", pa.string()), ("timescale", pa.int64()), ("duration", pa.int64()), ("n_samples", pa.int64()), ("n_keyframes", pa.int64()), ("keyframes", SPANS)]
FEATURES = pa.struct([*TRACK_FIELDS, ("tracks", pa.list_(pa.struct([("track_id", pa.int64()), *TRACK_FIELDS]))), ("error", pa.string())])


def media_features(table: DataFrame, column: str = "media") -> DataFrame:
    """table with a struct column `features` from its media column: see describe(). The other columns pass as they are; a null or broken value has an error text."""
    spans = lambda about: None if about["keyframes"] is None else [{"start": a, "end": b} for a, b in about["keyframes"]]

    @F.arrow_udf(f"struct<{TRACK_DDL}, tracks: array<struct<track_id: long, {TRACK_DDL}>>, error: string>")
    def of(media: pa.Array) -> pa.Array:
        out = []
        for value in media:
            about = describe(value.as_py())
            out.append(about | {"keyframes": spans(about), "tracks": None if about["tracks"] is None else [t | {"keyframes": spans(t)} for t in about["tracks"]]})
        return pa.array(out, FEATURES)

    return table.withColumn("features", of(F.col(column)))


READ = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("keyframes", SPANS)])


def read_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        for batch in batches:
            for doc, n, media in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                media = media.as_py()
                track = main_track(tracks_of(memoryview(media)))  # each container is walked once
                payload, about = bytes_of(media, track), told(track)
                ranges = about.pop("keyframes")
                about |= {"error": None, "first_keyframe": ranges[0], "keyframe_bytes": sum(b - a for a, b in ranges), "keyframes_crc32": zlib.crc32(np.array(ranges, "<i8").tobytes())}
                yield doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(media), hashlib.sha256(media).hexdigest(), json.dumps(about), [{"start": a, "end": b} for a, b in ranges]

    yield from batched(made(), READ)


def texts_as_media(docs: DataFrame) -> DataFrame:
    """Stores each text as a container in a table of the shared folder, reads that back and tells what the stored bytes hold, with the byte ranges of their keyframes."""
    stored = materialise(store_texts(docs), "media", "zstd")
    return stored.mapInArrow(read_back, f"doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, keyframes {RANGES}")
