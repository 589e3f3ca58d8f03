"""Pieces that several corpus operators use: shared storage, words, graph components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import dropped, new_dir, opened, written

#: Bytes up to which a table may be broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 100 << 20


# ---------------------------------------------------------------- storage

#: Bytes and rows of an Arrow batch between Spark and Python while a table is written: JVM and worker hold several copies of one, rows of lists as Python objects too, and
#: Spark's own 64 MB or 10,000 rows are too many of them.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 1000

discard = dropped


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of at most about BATCH_BYTES and BATCH_ROWS for what runs inside; the session then has its own settings again."""
    wanted = {"spark.sql.execution.arrow.maxBytesPerBatch": BATCH_BYTES, "spark.sql.execution.arrow.maxRecordsPerBatch": BATCH_ROWS}
    before = {name: spark.conf.get(name) for name in wanted}
    for name, most in wanted.items():
        spark.conf.set(name, str(most))
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def materialise(df: DataFrame, label: str, codec: str = "uncompressed") -> DataFrame:
    """df written to the folder that driver and executors share and read back (see session.written), in small batches where Python takes part."""
    with small_batches(df.sparkSession):
        return written(df, label, codec)


def new_files(spark: SparkSession, label: str, directory: str | None = None) -> str:
    """URI of a new folder for binary files (or the one given), once it is known that they can be written there."""
    uri = directory or new_dir(spark, label)
    opened(uri)
    return uri


def bounded(df: DataFrame, row_bytes: int = 100, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """df with a broadcast hint if a count proves that its rows, of row_bytes at most, are within most_bytes; else as it is."""
    rows = most_bytes // row_bytes
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


# ---------------------------------------------------------------- words and hashes


def words_of(text: str | None) -> list[bytes]:
    """Words: runs of anything but space and \\t..\\r, with A-Z lower-cased. bytes.split() and bytes.lower() do just this."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """64-bit hash of each word seen; emptied when it holds many, so memory stays bounded."""

    most = 120_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.most:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on 64 bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def shingle_stream(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """Hash of each run of k words in order; with fewer words one hash, of them all; none without words."""
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    take = min(k, len(w))
    n = len(w) - take + 1
    out = np.full(n, take, np.uint64)
    for i in range(take):
        out = mixed(out + w[i : i + n])
    return out


def shingle_set(words: list[bytes], k: int, hashes: WordHashes) -> np.ndarray:
    """The distinct shingles of a text, as ascending 64-bit hashes."""
    return np.unique(shingle_stream(words, k, hashes))


# ---------------------------------------------------------------- Arrow helpers


def grouped_rows(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 1 << 30) -> Iterator[list[dict]]:
    """Runs of rows with equal keys in a stream sorted by them, whatever batches they fall in. A run of over `most` rows comes in pieces."""
    held: list[dict] = []
    at: tuple | None = None
    for batch in batches:
        for row in batch.to_pylist():
            key = tuple(row[k] for k in keys)
            if held and (key != at or len(held) >= most):
                yield held
                held = []
            at = key
            held.append(row)
    if held:
        yield held


def released() -> None:
    """Gives memory that a task has freed back to the system: its worker goes on to other tasks beside the JVM."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def batched(rows: Iterator[tuple], schema: pa.Schema, most_rows: int = 2000, most_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Record batches of bounded rows and bytes from row tuples."""
    held: list[tuple] = []
    weight = 0
    for row in rows:
        held.append(row)
        weight += sum(len(x) for x in row if isinstance(x, str | bytes | list))
        if len(held) >= most_rows or weight >= most_bytes:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
    released()


# ---------------------------------------------------------------- graph components


def components(edges: DataFrame, label: str = "components", most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of the undirected edges (a, b): root is the component's smallest node.

    Alternates large-star and small-star rounds until the edges stand still: each round is two partial-aggregating
    group-bys and equi-joins (a hot node's join partition is split by adaptive execution), written to the shared folder.
    The number of rounds grows with the logarithm of the longest chain. Null or looping edges are ignored.
    """
    held = materialise(edges.select(F.col("a").cast("long"), F.col("b").cast("long")).filter("a is not null and b is not null and a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    mark = None
    for _ in range(most_rounds):
        both = held.union(held.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Now every edge runs from a larger node to a smaller one.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*").filter("a <> b").distinct()
        new = materialise(small, label)
        discard(held)
        held = new
        now = held.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    roots = held.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
    out._loamline_path = held._loamline_path
    return out
