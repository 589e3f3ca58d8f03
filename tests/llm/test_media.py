import hashlib
import struct
import zlib

import pytest

from loamline.llm import media


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 64 * 255, 64 * 256, 64 * 256 + 1, 64 * 512, 64 * 1000 + 7])
def test_round_trip(n):
    payload = media.padded(bytes(i * 7 % 256 for i in range(n)))
    stored = media.wrap(payload)
    assert len(payload) % 64 == 0 and len(payload) >= max(64, n)
    assert media.samples_of(stored) == payload
    about = media.describe(stored)
    assert about["error"] is None and about["codec"] == "raw " and about["duration"] == len(payload) and about["n_samples"] == len(payload) // 64
    assert about["n_keyframes"] == -(-about["n_samples"] // media.PER_KEYFRAME)
    base = stored.rindex(b"mdat") + 4
    want = [(base + 64 * i, base + 64 * (i + 1)) for i in range(0, about["n_samples"], media.PER_KEYFRAME)]
    assert about["keyframes"] == want


def test_another_layout():
    """Sizes that vary, several chunk runs, 64-bit offsets, no sync table, moov last, a box of 64-bit size, an unknown box."""
    sizes, runs = [3, 5, 1, 7, 2], [(1, 2, 1), (2, 1, 1)]
    mdat = struct.pack(">I4sQ", 1, b"mdat", 16 + 30) + bytes(range(30))
    start = 8 + 16
    chunks = [start, start + 10, start + 12, start + 20]  # 2, 1, 1, 1 samples
    stbl = media.box(
        b"stbl", media.full(b"stsd", struct.pack(">I", 1), media.box(b"avc1", bytes(20))), media.full(b"stsz", struct.pack(">II", 0, 5), struct.pack(">5I", *sizes)),
        media.full(b"stsc", struct.pack(">I", 2), *(struct.pack(">III", *r) for r in runs)), media.full(b"co64", struct.pack(">I", 4), struct.pack(">4Q", *chunks)),
    )
    mdia = media.box(b"mdia", media.full(b"mdhd", struct.pack(">IIII", 0, 0, 1000, 2500), bytes(4)), media.full(b"hdlr", bytes(4), b"vide", bytes(12)), media.box(b"minf", stbl))
    data = media.box(b"free") + mdat + media.box(b"moov", media.box(b"trak", media.box(b"zzzz", b"??"), mdia))
    about = media.describe(data)
    assert about["error"] is None and about["codec"] == "avc1" and about["handler"] == "vide" and about["timescale"] == 1000 and about["duration"] == 2500
    assert media.samples_of(data) == bytes([*range(0, 8), *range(10, 11), *range(12, 19), *range(20, 22)])
    assert about["n_keyframes"] == 5 and about["keyframes"] == [(start, start + 8), (start + 10, start + 11), (start + 12, start + 19), (start + 20, start + 22)]


def test_broken_values_say_so(spark):
    good = media.wrap(media.padded(b"x" * 1000))
    rows = [(1, good), (2, None), (3, b""), (4, good[:300]), (5, b"\0\0\0\x08free"), (6, good.replace(b"stsc", b"xxxx")), (7, b"\0\0\0\x01moov"), (8, good[:-10])]
    got = {r.id: r.features for r in media.media_features(spark.createDataFrame(rows, "id long, media binary")).collect()}
    assert got[1].error is None and got[1].n_samples == 16 and got[1].keyframes[0].end - got[1].keyframes[0].start == 64
    assert all(got[i].error for i in range(2, 9))


def test_texts(spark):
    rows = [(1, "abc", "x"), (2, None, "x"), (3, "", "x"), (4, "é" * 100_000, "x"), (4, "é" * 100_000, "x"), (None, "abc", "x")]
    got = media.texts_as_media(spark.createDataFrame(rows, "doc_id long, text string, media string")).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 6 and by[2].n_bytes == by[3].n_bytes == 0 and by[2].payload_bytes == 64
    for r in got:
        text = next(t or "" for d, t, _ in rows if d == r.doc_id).encode()
        payload = media.padded(text)
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(text), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
    assert by[1].media_sha256 == by[None].media_sha256 and by[1].feature == by[None].feature
    assert media.texts_as_media(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_every_track_is_told():
    """A film whose sound track comes first: sizes of 4, 8 and 16 bits, a sync table for the video."""
    head = 8
    mdat = bytes(range(60))

    def track(number, handler, codec, sizes, offset, sync=None, width=8):
        if width == 4:
            packed = bytes((sizes[i] << 4) | (sizes[i + 1] if i + 1 < len(sizes) else 0) for i in range(0, len(sizes), 2))
        else:
            packed = struct.pack(f">{len(sizes)}{'H' if width == 16 else 'B'}", *sizes)
        parts = [media.full(b"stsd", struct.pack(">I", 1), media.box(codec, bytes(20))), media.full(b"stz2", bytes([0, 0, 0, width]), struct.pack(">I", len(sizes)), packed), media.full(b"stsc", struct.pack(">IIII", 1, 1, len(sizes), 1)), media.full(b"stco", struct.pack(">II", 1, offset))]
        if sync:
            parts.append(media.full(b"stss", struct.pack(f">I{len(sync)}I", len(sync), *sync)))
        mdia = media.box(b"mdia", media.full(b"mdhd", struct.pack(">IIII", 0, 0, 600, 1200), bytes(4)), media.full(b"hdlr", bytes(4), handler, bytes(12)), media.box(b"minf", media.box(b"stbl", *parts)))
        return media.box(b"trak", media.full(b"tkhd", struct.pack(">III", 0, 0, number), bytes(68)), mdia)

    for width in (4, 8, 16):
        data = media.box(b"mdat", mdat) + media.box(b"moov", track(7, b"soun", b"mp4a", [3, 4, 5], head, width=width), track(9, b"vide", b"avc1", [10, 2, 3, 4, 5], head + 12, [1, 4], width=width))
        about = media.describe(data)
        assert about["error"] is None and (about["codec"], about["n_samples"], about["n_keyframes"]) == ("avc1", 5, 2)
        assert about["keyframes"] == [(head + 12, head + 22), (head + 27, head + 31)]
        assert [(t["track_id"], t["codec"], t["n_samples"]) for t in about["tracks"]] == [(7, "mp4a", 3), (9, "avc1", 5)]
        assert about["tracks"][0]["keyframes"] == [(head, head + 12)]
        assert media.samples_of(data) == mdat[12:36]


def test_fragments():
    """Two fragments, the first from the container's start, the second with defaults and two runs."""
    trex = media.full(b"trex", struct.pack(">5I", 1, 1, 20, 6, 0x10000))
    mdia = media.box(b"mdia", media.full(b"mdhd", struct.pack(">IIII", 0, 0, 90, 0), bytes(4)), media.full(b"hdlr", bytes(4), b"vide", bytes(12)), media.box(b"minf", media.box(b"stbl", media.full(b"stsd", struct.pack(">I", 1), media.box(b"hvc1", bytes(20))), media.full(b"stsz", struct.pack(">II", 0, 0)))))
    start = media.box(b"ftyp", b"iso5", bytes(4)) + media.box(b"moov", media.box(b"mvex", trex), media.box(b"trak", media.full(b"tkhd", struct.pack(">III", 0, 0, 1), bytes(68)), mdia))

    def fragment(base, runs, flags=0x20000):
        tfhd = media.full(b"tfhd", struct.pack(">I", 1), struct.pack(">Q", base) if flags & 1 else b"", flags=flags)
        return media.box(b"moof", media.full(b"mfhd", struct.pack(">I", 1)), media.box(b"traf", tfhd, *runs))

    # Offsets, first sample's flags, then duration, size and flags of each sample.
    one = lambda offset: media.full(b"trun", struct.pack(">IiI", 3, offset, 0x2000000), *(struct.pack(">II", 30, n) for n in (5, 7, 2)), flags=0x1 | 0x4 | 0x100 | 0x200)
    size = len(fragment(0, [one(0)]))
    first = fragment(0, [one(size + 8)]) + media.box(b"mdat", bytes(range(14)))
    at = len(start) + len(first)
    two = lambda offset: [media.full(b"trun", struct.pack(">Ii", 2, offset), flags=0x1), media.full(b"trun", struct.pack(">I", 2), struct.pack(">4I", 4, 0x2000000, 3, 0x10000), flags=0x200 | 0x400)]
    size = len(fragment(0, two(0), 0x1))
    second = fragment(at, two(size + 8), 0x1) + media.box(b"mdat", bytes(range(100, 119)))
    data = start + first + second
    about = media.describe(data)
    assert about["error"] is None and (about["codec"], about["n_samples"], about["n_keyframes"], about["duration"]) == ("hvc1", 7, 2, 90 + 80)
    assert media.samples_of(data) == bytes(range(14)) + bytes(range(100, 119))
    here = data.index(bytes(range(14)))
    there = data.index(bytes(range(100, 119)))
    assert about["keyframes"] == [(here, here + 5), (there + 12, there + 16)]
    assert media.describe(data[:-5])["error"] and media.describe(start + first[: size - 4])["error"]


def test_keyframe_ranges_are_a_column(spark):
    rows = [(1, "x" * 5000), (2, None)]
    got = {r.doc_id: r for r in media.texts_as_media(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        stored = media.wrap(media.padded((text or "").encode()))
        assert [(r.start, r.end) for r in got[i].keyframes] == media.describe(stored)["keyframes"] and got[i].media_bytes == len(stored)
