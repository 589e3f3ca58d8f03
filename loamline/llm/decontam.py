"""Benchmark decontamination: MinHash containment search in size partitions, verified on exact shingles.

A short item inside a long document has a tiny Jaccard similarity to it, so MinHash of whole documents finds nothing. Items
are put into partitions by the number of their shingles, (u/2, u] for u = 2, 4, 8, ... In partition u a document counts as
windows of 2u shingles, one every u: an item of at most u contiguous shingles lies whole in one of them, and the window is at most a
fixed factor larger than the item, so their signatures agree in a share of places that is bounded from below. Windows of all partitions are
made of the same block minima: each shingle is hashed once for each permutation, whatever the number of partitions.
A window and an item that agree in any of the permutations make a candidate, settled by exact containment in the document.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import unused
from .neardup import multipliers
from .shared import WordHashes, batched, bounded, materialise, shingle_stream, words_of

PERMUTATIONS = 64
#: Bits of a key that pick its place in the map of keys there are.
LOW = np.uint64((1 << 22) - 1)
#: Benchmarks are sent to the tasks while their shingles (8 bytes each) and their signature values (PERMUTATIONS an item, 16 bytes each with their item's place)
#: are each within these numbers, so within 80 MB in a worker; larger ones are joined.
BROADCAST_SHINGLES, BROADCAST_KEYS = 2_000_000, 4_000_000

FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_item", pa.int64()), ("n_shared", pa.int64())])


def partition_of(n: int) -> int:
    """The least power of two that is n at least."""
    return 1 << max(0, int(n - 1).bit_length())


def signatures(stream: np.ndarray, sizes: list[int], odd: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(u, windows x permutations) of minima over windows of 2u shingles, one every u, for each u in sizes, ascending."""
    if not len(stream) or not sizes:
        return
    step = sizes[0]
    blocks = np.empty((-(-len(stream) // step), len(odd)), np.uint64)
    most = max(1, 4096 // step) * step
    for i in range(0, len(stream), most):
        part = stream[i : i + most, None] * odd[None, :]
        whole = len(part) // step
        at = i // step
        blocks[at : at + whole] = part[: whole * step].reshape(whole, step, len(odd)).min(axis=1)
        if whole * step < len(part):
            blocks[at + whole] = part[whole * step :].min(axis=0)
    for u in sizes:
        while step < u:
            even = len(blocks) // 2 * 2
            blocks = np.concatenate([np.minimum(blocks[0:even:2], blocks[1:even:2]), blocks[even:]])
            step *= 2
        yield u, np.minimum(blocks[:-1], blocks[1:]) if len(blocks) > 1 else blocks


def slot(values: np.ndarray, u: int) -> np.ndarray:
    """Key of a signature value in its permutation (its column) and partition."""
    column = np.arange(values.shape[-1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return (values ^ column) + np.uint64(u)


class Index:
    """Signature keys of the items, for look-ups of many keys at once."""

    def __init__(self, items: list[tuple[int, np.ndarray]]):
        """items: item_id and distinct shingles of those that have any."""
        self.ids = [i for i, _ in items]
        self.sets = [s for _, s in items]
        self.sizes = sorted({partition_of(len(s)) for s in self.sets})
        self.odd = multipliers(PERMUTATIONS)
        keys = np.array([slot((s[:, None] * self.odd[None, :]).min(axis=0), partition_of(len(s))) for s in self.sets], np.uint64).reshape(-1)
        order = np.argsort(keys, kind="stable")
        self.keys, self.of = keys[order], np.repeat(np.arange(len(self.sets)), PERMUTATIONS)[order]
        self.seen = np.zeros(1 << 22, bool)
        self.seen[keys & LOW] = True

    def candidates(self, stream: np.ndarray) -> set[int]:
        out: set[int] = set()
        for u, windows in signatures(stream, self.sizes, self.odd):
            keys = slot(windows, u).ravel()
            keys = keys[self.seen[keys & LOW]]
            if len(keys):
                keys = np.unique(keys)
                lo, hi = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
                for a, b in zip(lo, hi, strict=True):
                    out.update(self.of[a:b].tolist())
        return out


def item_rows(items: list[tuple[int, str | None]], k: int) -> list[tuple[int, np.ndarray]]:
    hashes = WordHashes()
    out = [(i, np.unique(shingle_stream(words_of(t), k, hashes))) for i, t in items]
    return [(i, s) for i, s in out if len(s)]


def searcher(items: list[tuple[int, str | None]], k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, hashes = Index(item_rows(items, k)), WordHashes()

        def made():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    stream = shingle_stream(words_of(text.as_py()), k, hashes)
                    got = index.candidates(stream)
                    if got:
                        own = np.unique(stream)
                        for i in sorted(got):
                            s = index.sets[i]
                            at = np.minimum(np.searchsorted(own, s), len(own) - 1)
                            shared = int((own[at] == s).sum())
                            if den * shared >= num * len(s):
                                yield doc, index.ids[i], len(s), shared

        yield from batched(made(), FOUND)

    return run


KEYS = pa.schema([("id", pa.int64()), ("key", pa.int64())])


def doc_keys(sizes: list[int], k: int):
    """(doc_id, key) of every window of every partition, each key once for a document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, odd = WordHashes(), multipliers(PERMUTATIONS)
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for u, windows in signatures(shingle_stream(words_of(text.as_py()), k, hashes), sizes, odd):
                    keys = np.unique(slot(windows, u).ravel()).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array([doc] * len(keys), pa.int64()), pa.array(keys)], schema=KEYS)

    return run


def item_keys(k: int):
    schema = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("u", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd = multipliers(PERMUTATIONS)
        for batch in batches:
            for i, s in item_rows(list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)), k):
                keys = slot((s[:, None] * odd[None, :]).min(axis=0), partition_of(len(s))).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(keys), pa.int64()), pa.array(keys), pa.array([partition_of(len(s))] * len(keys), pa.int64())], schema=schema)

    return run


def verifier(k: int, num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def made():
            for batch in batches:
                for doc, text, i, item in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    own, s = (np.unique(shingle_stream(words_of(t), k, hashes)) for t in (text, item))
                    shared = len(np.intersect1d(own, s, assume_unique=True))
                    if den * shared >= num * len(s):
                        yield doc, i, len(s), shared

        yield from batched(made(), FOUND)

    return run


def contaminations(docs: DataFrame, items: DataFrame, k: int = 5, num: int = 4, den: int = 5, broadcast_shingles: int = BROADCAST_SHINGLES) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) where a document holds at least num/den of an item's distinct k-word shingles.

    docs: doc_id, text; items: item_id, text; other columns are ignored. Items or texts without words, or null, match nothing; an
    item of fewer than k words is one shingle, which only a document of just these words has. Repeated rows give repeated
    pairs once. A null doc_id or item_id is returned as null. Items whose shingles all told are within broadcast_shingles (and their signatures within
    BROADCAST_KEYS) go to the tasks with one pass over the texts and no shuffle; larger benchmarks are joined on signature keys, which reads the texts
    a second time and shuffles those of candidates.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("item")).filter("item is not null").distinct()
    size = items.agg(F.sum(F.length("item")).alias("chars"), F.count("*").alias("items")).first()
    returns = "doc_id long, item_id long, n_item long, n_shared long"
    # A shingle takes two characters at least.
    if (size.chars or 0) <= 2 * broadcast_shingles and size.items * PERMUTATIONS <= BROADCAST_KEYS:
        held = [(r.item_id, r.item) for r in items.collect()]
        return texts.mapInArrow(searcher(held, k, num, den), returns).distinct()
    keyed = materialise(items.mapInArrow(item_keys(k), "id long, key long, u long"), "item-keys")
    sizes = sorted(r.u for r in keyed.select("u").distinct().collect())  # one for each power of two
    pairs = texts.mapInArrow(doc_keys(sizes, k), "id long, key long").join(bounded(keyed.select("key", F.col("id").alias("item_id")), 40), "key").select(F.col("id").alias("doc_id"), "item_id").distinct()
    pairs = materialise(pairs, "candidates")
    some = bounded(pairs.select(F.col("doc_id").alias("d")).distinct(), 40)
    held = texts.join(some, texts.doc_id.eqNullSafe(F.col("d")), "left_semi").join(pairs.withColumnRenamed("doc_id", "d"), texts.doc_id.eqNullSafe(F.col("d"))).select("doc_id", "text", "item_id")
    return held.join(items.withColumnRenamed("item_id", "i"), F.col("i").eqNullSafe(F.col("item_id"))).select("doc_id", "text", "item_id", "item").mapInArrow(verifier(k, num, den), returns).distinct()


def clean(docs: DataFrame, items: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """docs, in their own columns, without those that hold a benchmark item. Rows with a null doc_id stay unless a row without doc_id holds one."""
    leaked = unused("leaked", docs)
    found = materialise(contaminations(docs, items, k, num, den).select(F.col("doc_id").alias(leaked)).distinct(), "leaks")
    return docs.join(bounded(found, 40), F.col("doc_id").cast("long").eqNullSafe(F.col(leaked)), "left_anti").select(*docs.columns)
