"""WARC archives: a writer with revisit records, and a reader that splits gzipped archives by byte ranges.

Every record is a gzip member of its own. The reader deals an archive out as byte ranges: a task looks for gzip magic from the start of its
range, tests a candidate by decoding the beginning of the member, which must read as a WARC header, and owns the records that
start inside its range, read to their end wherever that is.

A payload that is stored, not compressed, may hold whole WARC members, which pass that test too. So where an archive has several ranges they
are settled first: each task follows the members from its first candidate to the first start beyond its range, and a small table of these
ends, a row for each range, is walked archive by archive from its first byte. A range whose candidate is where the ranges before it end is confirmed;
any other is followed anew from that place. Every split of an archive so gives the records that reading it from the start gives.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BROADCAST_BYTES, batched, discard, materialise, new_files, opened
from .tokenfiles import Put

MAGIC = b"\x1f\x8b\x08"
#: Bytes of an archive that a task owns.
SPLIT = 8 << 20
CHUNK = 1 << 18
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")
#: Fixed, so that equal rows give equal records.
DATE = "2024-01-01T00:00:00Z"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'page/{page}')}>"


def one_line(text: str | None) -> str:
    return " ".join((text or "").split())


def record(page: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A gzipped response record, or a revisit record of another page's payload (with that payload's length and digest, not its bytes)."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: {record_id(page)}", f"WARC-Date: {DATE}", f"WARC-Target-URI: {one_line(url)}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Page-Id: {'' if page is None else page}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    if revisit:
        head += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {record_id(refers_to)}", f"X-Refers-To-Page-Id: {refers_to}"]
    squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
    return squeeze.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n") + squeeze.compress(block) + squeeze.compress(b"\r\n\r\n") + squeeze.flush()


ARCHIVES = pa.schema([("uri", pa.string()), ("bytes", pa.int64()), ("records", pa.int64())])


def archiver(directory: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        out, uri, size, records = None, f"{directory}/pages-{context.partitionId():06d}.warc.gz", 0, 0
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                for page, url, html, refers_to in zip(*(c.to_pylist() for c in batch.slice(at, 256).columns), strict=True):
                    out = out or Put(uri, context.taskAttemptId())
                    member = record(page, url, (html or "").encode("utf-8", "surrogatepass"), refers_to)
                    out.out.write(member)
                    size += len(member)
                    records += 1
        if out:
            out.done()
            yield pa.RecordBatch.from_pylist([{"uri": uri, "bytes": size, "records": records}], schema=ARCHIVES)

    return run


def write_warc(pages: DataFrame, directory: str, least: int = 0) -> DataFrame:
    """Writes a record for each row of pages (page_id, url, html) and returns the archives (uri, bytes, records).

    Of rows with equal payloads (the html in UTF-8; null: empty) of at least `least` bytes, that with the largest page_id is the response
    and the others revisit it; rows that share that page_id are all responses, and so are those without page_id. Extra columns
    are ignored, repeated rows are written as often as they come, an empty table makes no archive.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    keyed = rows.withColumn("sha", F.sha1("html"))
    firsts = keyed.filter(F.octet_length("html") >= least).groupBy("sha").agg(F.max("page_id").alias("first"), F.min("page_id").alias("low")).filter("low < first").select("sha", "first")
    firsts = materialise(firsts, "payloads")
    most = BROADCAST_BYTES // 100
    n = firsts.limit(most + 1).count()
    # Only payloads that repeat are in this table; beyond the bound it is joined by a shuffle.
    dealt = keyed.join(F.broadcast(firsts) if n <= most else firsts, "sha", "left") if n else keyed.withColumn("first", F.lit(None).cast("long"))
    refers_to = F.when(F.col("page_id") < F.col("first"), F.col("first"))
    return materialise(dealt.select("page_id", "url", "html", refers_to.alias("refers_to")).mapInArrow(archiver(directory), "uri string, bytes long, records long"), "archives")


class Window:
    """Bytes of a file from any offset, read in chunks."""

    def __init__(self, uri: str):
        fs, path = opened(uri)
        self.file = fs.open_input_file(path)
        self.size = self.file.size()
        self.at, self.held = 0, b""

    def get(self, start: int, n: int) -> bytes:
        if not (self.at <= start and start + n <= self.at + len(self.held)):
            self.at = start
            self.held = self.file.read_at(max(0, min(max(n, CHUNK), self.size - start)), start) if start < self.size else b""
        return self.held[start - self.at : start - self.at + n]


def inflate(data: Window, start: int, most: int | None = None, hold: bool = True) -> tuple[bytes, int] | None:
    """The member at start (empty unless held) and where it ends, or (with most) its first bytes; None if there is no whole member."""
    z, out, at, size = zlib.decompressobj(31), [], start, 0
    while not z.eof:
        piece = data.get(at, CHUNK if most is None else 512)
        if not piece:
            return None
        try:
            while True:  # what a piece inflates to is bounded: a small member may hold a very long run
                got = z.decompress(piece, CHUNK * 4 if most is None else most - size)
                size += len(got)
                if hold:
                    out.append(got)
                piece_left = z.unconsumed_tail
                if most is not None and size >= most or not piece_left:
                    break
                at += len(piece) - len(piece_left)
                piece = piece_left
        except zlib.error:
            return None
        at += len(piece)
        if most is not None and size >= most:
            break
    return b"".join(out), at - len(z.unused_data)


def starts_record(data: Window, at: int) -> bool:
    head = inflate(data, at, 7)
    return head is not None and head[0].startswith(b"WARC/1.")


def next_record(data: Window, at: int) -> int:
    """The first place from `at` on where a whole member begins that reads as a WARC header; the file's size if there is none."""
    while at < data.size:
        # The next magic: the piece read overlaps the following one by the magic's length less one.
        piece = data.get(at, min(CHUNK, data.size - at))
        found = piece.find(MAGIC)
        if found < 0:
            at += max(1, len(piece) - len(MAGIC) + 1)
            continue
        at += found
        if starts_record(data, at) and inflate(data, at, hold=False):
            return at
        at += 1
    return data.size


def walked(data: Window, at: int, end: int, hold: bool = True) -> Iterator[tuple[int, int, bytes, str | None]]:
    """(offset, next offset, bytes, error) of what begins in [at, end), member by member; where none can be read, the error and how far it is to the next record."""
    while at < min(end, data.size):
        whole = inflate(data, at, hold=hold)
        if whole is not None:
            yield at, whole[1], whole[0], None
            at = whole[1]
        else:
            after = next_record(data, at + 1)
            yield at, after, b"", f"no whole gzip member in the {after - at} bytes from here"
            at = after


def end_of(data: Window, at: int, end: int) -> int:
    """The first start at or beyond `end` that walking from `at` comes to."""
    for _, at, _, _ in walked(data, at, end, hold=False):  # noqa: B007
        pass
    return at


PROBES = "uri string, size long, start long, end long, head long, exit long"


def prober(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first candidate of each range, and the first start beyond the range that it leads to."""
    schema = pa.schema([(n, pa.string() if n == "uri" else pa.int64()) for n in ("uri", "size", "start", "end", "head", "exit")])

    def made():
        for batch in batches:
            for row in batch.to_pylist():
                uri, size, start, end = (row[c] for c in ("uri", "size", "start", "end"))
                head, out = start, None
                if end < size:  # nothing follows the last range
                    data = Window(uri)
                    head = 0 if start == 0 else next_record(data, start)
                    out = end_of(data, head, end)
                yield uri, size, start, end, head, out

    yield from batched(made(), schema)


ENTRIES = "uri string, entry long, end long"


def settled(table: pa.Table) -> pa.Table:
    """(uri, entry, end) of one archive's ranges that own records, from its probes: where the first member that begins in each range does."""
    rows = sorted(table.to_pylist(), key=lambda r: r["start"])
    data, at, out = None, 0, []
    for r in rows:
        if at >= r["end"]:
            continue  # one member spans the range
        out.append({"uri": r["uri"], "entry": at, "end": r["end"]})
        if r["head"] == at and r["exit"] is not None:
            at = r["exit"]
        elif r["end"] < r["size"]:
            data = data or Window(r["uri"])
            at = end_of(data, at, r["end"])
    return pa.Table.from_pylist(out, schema=pa.schema([("uri", pa.string()), ("entry", pa.int64()), ("end", pa.int64())]))


def fields_of(raw: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields (names in lower case) and block of a member's first record, and what follows it: further records, in archives that put several into a member."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    named = dict(line.partition(":")[::2] for line in head.decode("utf-8", "replace").split("\r\n")[1:])
    named = {k.strip().lower(): v.strip() for k, v in named.items()}
    size = int(named["content-length"]) if (named.get("content-length") or "").isdigit() else 0
    return named, rest[:size], rest[size:].lstrip(b"\r\n")


RECORDS = pa.schema([("uri", pa.string()), ("offset", pa.int64()), ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("valid", pa.bool_()), ("payload", pa.binary()), ("error", pa.string())])
RECORDS_DDL = "uri string, offset long, record_type string, record_id string, target_uri string, page_id long, refers_to long, payload_digest string, payload_bytes long, valid boolean, payload binary, error string"


def record_row(uri: str, offset: int, named: dict[str, str], block: bytes) -> tuple:
    number = lambda x: int(x) if x and x.lstrip("-").isdigit() else None
    http, _, payload = block.partition(b"\r\n\r\n") if named.get("content-type", "").startswith("application/http") else (b"", b"", block)
    said = named.get("warc-payload-digest", "").rpartition(":")[2] or None
    kind = named.get("warc-type")
    length = next((number(x.partition(b":")[2].strip().decode("latin-1")) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), None)
    own = digest(payload) if kind == "response" else said
    size = len(payload) if kind == "response" else length
    return uri, offset, kind, named.get("warc-record-id"), named.get("warc-target-uri"), number(named.get("x-page-id")), number(named.get("x-refers-to-page-id")), own, size, said is None or own == said, payload if kind != "revisit" else None, None


def range_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        for batch in batches:
            for row in batch.to_pylist():
                data = Window(row["uri"])
                for offset, _, raw, error in walked(data, row["entry"], row["end"]):
                    if error is None and not raw.startswith(b"WARC/1."):
                        error = "a gzip member that is no WARC record"
                    if error is not None:
                        yield (row["uri"], offset, *[None] * 7, False, None, error)
                        continue
                    while raw.startswith(b"WARC/1."):
                        named, block, raw = fields_of(raw)
                        yield record_row(row["uri"], offset, named, block)

    yield from batched(made(), RECORDS)


def read_warc(archives: DataFrame, split: int = SPLIT) -> DataFrame:
    """All records of the archives (uri, bytes), dealt out by byte ranges of `split`; payload is null for revisits, valid says whether the digest holds.

    Bytes that are no whole member (a cut-off or damaged one) and members that are no record give a row each with their offset and an error, and
    reading goes on at the next record after them. No archives, or empty ones, give no rows; an archive that is listed twice is read twice.
    """
    last = F.greatest(F.ceil(F.col("bytes") / split).cast("long") - 1, F.lit(0).cast("long"))
    listed = archives.select("uri", F.col("bytes").cast("long").alias("bytes"))
    n = max(1, listed.agg(F.sum(last + 1)).first()[0] or 1)
    ranges = listed.distinct().select("uri", F.col("bytes").alias("size"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("i")).select("uri", "size", (F.col("i") * split).alias("start"), ((F.col("i") + 1) * split).alias("end"))
    probes = materialise(ranges.repartition(min(n, 10_000)).mapInArrow(prober, PROBES), "probes")
    entries = materialise(probes.groupBy("uri").applyInArrow(settled, ENTRIES), "entries")
    discard(probes)
    entries = entries.join(listed, "uri").select("uri", "entry", "end")
    # Dealt in turn, so that every task has the same number of ranges.
    return entries.repartition(min(n, 10_000)).mapInArrow(range_reader, RECORDS_DDL)


def archived(pages: DataFrame, directory: str | None = None, least: int = 0, split: int = SPLIT) -> DataFrame:
    """Writes pages to archives in a new folder (or the one given) and reads them back."""
    return read_warc(write_warc(pages, new_files(pages.sparkSession, "warc", directory), least), split)
