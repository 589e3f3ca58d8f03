import base64
import hashlib
import random

from loamline.llm import warc
from loamline.llm.shared import materialise

SCHEMA = "page_id long, url string, html string, sha string, first long"


def expected(rows, least=0):
    top = {}
    for p, _, h in rows:
        if p is not None and len((h or "").encode()) >= least:
            top[h or ""] = max(top.get(h or "", p), p)
    out = []
    for p, _, h in rows:
        payload = (h or "").encode()
        first = top.get(h or "")
        refers = first if p is not None and first is not None and p < first else None
        out.append((p, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=str)


def test_round_trip_in_small_ranges(spark):
    rng = random.Random(1)
    html = ["", None, "a" * 10, "é" * 100, "\r\n\r\nWARC/1.1\r\n", "".join(chr(rng.randrange(32, 2000)) for _ in range(90_000)), *[f"<p>{i}" * rng.randrange(1, 400) for i in range(30)]]
    rows = [(i, f"http://h/{i}", rng.choice(html)) for i in range(150)] + [(None, None, "n"), (7000, "u", "same"), (7000, "u", "same"), (6999, "a\r\nb", "same")]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    for split in (997, 50_000, warc.SPLIT):
        got = warc.archived(df, split=split).collect()
        assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got), key=str) == expected(rows)
        assert all(r.valid for r in got)
    big = warc.archived(df, least=50).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in big), key=str) == expected(rows, 50)
    assert warc.archived(df.limit(0)).count() == 0


def test_magic_inside_members_is_no_record(spark, tmp_path):
    """Stored (uncompressed) members carry whole gzip members in their payload; only those that decode to a WARC header count, and none is read twice."""
    import zlib

    inner = zlib.compressobj(6, zlib.DEFLATED, 31)
    inner = inner.compress(b"not a record") + inner.flush()
    bad = warc.MAGIC + b"\0" * 30
    bodies = [inner * 3 + bad, bad * 5, inner]
    data = b""
    for i, body in enumerate(bodies):
        head = f"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: {i}\r\nContent-Length: {len(body)}\r\n\r\n".encode()
        z = zlib.compressobj(0, zlib.DEFLATED, 31)
        data += z.compress(head + body + b"\r\n\r\n") + z.flush()
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    archive = materialise(spark.createDataFrame([(f"file://{path}", len(data))], "uri string, bytes long"), "t")
    for split in (13, 64, 200, 10_000):
        got = sorted((r.page_id, bytes(r.payload)) for r in warc.read_warc(archive, split).collect())
        assert got == list(enumerate(bodies))


def member(page, body, level):
    import zlib

    head = f"WARC/1.1\r\nWARC-Type: response\r\nX-Page-Id: {page}\r\nContent-Length: {len(body)}\r\n\r\n".encode()
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(head + body + b"\r\n\r\n") + z.flush()


def read(spark, tmp_path, data, split):
    path = tmp_path / "x.warc.gz"
    path.write_bytes(data)
    archive = materialise(spark.createDataFrame([(f"file://{path}", len(data))], "uri string, bytes long"), "t")
    return warc.read_warc(archive, split).collect()


def test_records_inside_stored_payloads_are_no_records_of_the_archive(spark, tmp_path):
    """Stored payloads that hold whole WARC members, nested and side by side: every split gives what reading from the start gives."""
    rng = random.Random(3)
    noise = lambda n: bytes(rng.randrange(256) for _ in range(n))
    inside = member(100, noise(50), 6) + member(101, b"abc" * 40, 0)
    nested = member(102, inside + noise(30) + inside, 0)
    bodies = [inside, noise(400), nested + inside, b"", inside * 4, noise(100) + nested]
    data = b"".join(member(i, b, 0) for i, b in enumerate(bodies))
    for split in (64, 200, 333, 100_000):
        got = read(spark, tmp_path, data, split)
        assert sorted((r.page_id, bytes(r.payload)) for r in got) == list(enumerate(bodies)) and all(r.error is None for r in got)


def test_damage_is_told_and_passed_over(spark, tmp_path):
    whole = [member(i, bytes([65 + i]) * 500 * i, 6) for i in range(6)]
    starts = [sum(map(len, whole[:i])) for i in range(7)]
    broken = bytearray(b"".join(whole))
    broken[starts[2] + 15 : starts[2] + 25] = b"\xff" * 10
    import gzip

    data = bytes(broken) + gzip.compress(b"not a record") + whole[1] + whole[3][:-9]
    tail = len(broken) + len(gzip.compress(b"not a record")) + len(whole[1])
    for split in (40, 100, 100_000):
        got = read(spark, tmp_path, data, split)
        assert sorted(r.page_id for r in got if r.error is None) == [0, 1, 1, 3, 4, 5]
        errors = {r.offset: r.error for r in got if r.error}
        assert set(errors) == {starts[2], len(broken), tail} and str(starts[3] - starts[2]) in errors[starts[2]]
        assert not any(r.valid for r in got if r.error)


def test_several_records_in_a_member_and_no_bytes(spark, tmp_path):
    import gzip

    text = b"".join(f"WARC/1.0\r\nWARC-Type: metadata\r\nX-Page-Id: {i}\r\nContent-Length: {i}\r\n\r\n".encode() + b"x" * i + b"\r\n\r\n" for i in range(5))
    got = read(spark, tmp_path, gzip.compress(text), 10)
    assert sorted((r.page_id, len(r.payload), r.record_type) for r in got) == [(i, i, "metadata") for i in range(5)]
    assert read(spark, tmp_path, b"", 10) == []
    long = member(1, b"a" * 30_000_000, 6)
    (r,) = read(spark, tmp_path, long, 1000)
    assert r.page_id == 1 and len(r.payload) == 30_000_000
