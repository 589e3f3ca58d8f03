"""Near-duplicate documents by min-max hashing.

Each permutation of the shingles is evaluated once and gives two signature values, its minimum and its maximum: both agree
between two sets with probability equal to their Jaccard similarity, so 64 evaluations make a signature of 128 values.
Bands of that signature find candidates; every link that decides a result is confirmed on the full shingle sets.

Plan, with no quadratic step inside a bucket and nothing of the corpus on the driver:

1. sketch: one pass over the texts gives a set size, a 128-bit fingerprint of the set, band keys and a signature of bytes.
2. equal sets collapse to the smallest doc_id (partial aggregation), so thousands of copies count once from here on.
3. each band bucket proposes member-to-pivot pairs (pivot: its smallest id). Of each member's pairs the one met in most bands is
   confirmed, and components are taken: this settles groups of copies, however large, with one pair a member.
4. buckets that then hold more than one component are compared in blocks, across components only: by size and signature first,
   then what may reach the threshold on full sets. A bucket has no size limit, it is dealt out as pairs of blocks over many
   tasks, by members and by the size of their sets, so that long texts make smaller blocks; and a task gives only as many links as join its components.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import WordHashes, batched, bounded, components, discard, grouped_rows, materialise, mixed, shingle_set, words_of

PERMUTATIONS = 64
#: Members of a block when a bucket with several components is compared, and bytes that the full sets of a block may take: a task holds two blocks.
BLOCK, BLOCK_BYTES = 2048, 64 << 20


def banding(similarity: float, miss: float = 1e-6) -> tuple[int, int]:
    """(bands, rows): the longest bands that lose a pair at the given similarity with at most the given probability."""
    values = 2 * PERMUTATIONS
    for rows in range(8, 1, -1):
        bands = values // rows
        if (1 - similarity**rows) ** bands <= miss:
            return bands, rows
    return values, 1


def multipliers(n: int = PERMUTATIONS) -> np.ndarray:
    """Odd 64-bit multipliers, from a rule."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)


def min_max(hashes: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """2n values: n minima, then n maxima, of the products of all hashes with each multiplier."""
    low = np.full(len(odd), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(odd), np.uint64)
    for i in range(0, len(hashes), 2048):
        x = odd[:, None] * hashes[None, i : i + 2048]
        np.minimum(low, x.min(axis=1), out=low)
        np.maximum(high, x.max(axis=1), out=high)
    return mixed(np.concatenate([low, high]))


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of successive values; a band never holds both ends of one permutation while rows divide evenly."""
    s = signature[: bands * rows].reshape(bands, rows)
    key = np.arange(bands, dtype=np.uint64)
    for j in range(rows):
        key = mixed(key + s[:, j])
    return key.view(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity from signatures cut to bytes, freed from chance agreement."""
    return ((a == b).mean(axis=-1) - 1 / 256) / (1 - 1 / 256)


def slack(similarity: float) -> float:
    """What an estimate must reach lest a pair at the threshold be lost: five and a half standard errors below it."""
    return similarity - 5.5 * sqrt(similarity * (1 - similarity) / (2 * PERMUTATIONS))


SKETCH = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.binary()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])


def sketcher(k: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, odd = WordHashes(), multipliers()

        def made():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    s = shingle_set(words_of(text.as_py()), k, hashes)
                    if not len(s):
                        yield doc, 0, None, None, None
                        continue
                    signature = min_max(s, odd)
                    yield doc, len(s), xxhash.xxh3_128_digest(s.tobytes()), signature.astype(np.uint8).tobytes(), band_keys(signature, bands, rows).tolist()

        yield from batched(made(), SKETCH)

    return run


SETS = pa.schema([("doc_id", pa.int64()), ("cls", pa.binary()), ("hashes", pa.binary())])


def setter(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()

        def made():
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                    s = shingle_set(words_of(text.as_py()), k, hashes).tobytes()
                    yield doc, xxhash.xxh3_128_digest(s), s

        yield from batched(made(), SETS)

    return run


def confirmer(num: int, den: int):
    """Keeps pairs with den * |A and B| >= num * |A or B|."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def made():
            for batch in batches:
                for a, b, x, y in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                    shared = shared_count(x, y)
                    if den * shared >= num * (len(x) + len(y) - shared):
                        yield a, b

        yield from batched(made(), schema)

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    a, b = (sets.select(F.col("doc_id").alias(n), F.col("hashes").alias(f"h{n}")) for n in "ab")
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ha", "hb").mapInArrow(confirmer(num, den), "a long, b long")


def likely(row: dict, at: int, block: dict[str, np.ndarray], floor: float, num: int, den: int) -> np.ndarray:
    """Which members from place `at` of a block may be linked to row: in another component, near enough by size and signature, and with this bucket as the first that both share."""
    comp, n, sig, bands = (block[c][at:] for c in ("comp", "n", "sig", "bands"))
    where = np.flatnonzero((comp != row["comp"]) & (den * np.minimum(n, row["n"]) >= num * np.maximum(n, row["n"])))
    where = where[estimate(sig[where], np.frombuffer(row["sig"], np.uint8)) >= floor]
    mine = np.array(row["bands"], np.int64)
    same = bands[where] == mine
    return at + where[mine[same.argmax(axis=1)] == row["key"]] if len(where) else where


def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list[dict], dict[str, np.ndarray]]]:
    """Left members, right members and the right ones' columns of each pair of blocks of a bucket, in a stream sorted by key, i and j."""
    for rows in grouped_rows(batches, ["key", "i", "j"]):
        left = [r for r in rows if r["blk"] == r["i"]]
        right = left if rows[0]["i"] == rows[0]["j"] else [r for r in rows if r["blk"] == r["j"]]
        if left and right:
            columns = {c: np.array([r[c] for r in right], np.int64) for c in ("comp", "n", "bands")}
            columns["sig"] = np.frombuffer(b"".join(r["sig"] for r in right), np.uint8).reshape(len(right), -1)
            yield left, right, columns


def parties(floor: float, num: int, den: int):
    """The members of each pair of blocks that may have a link to another component."""
    schema = pa.schema([("key", pa.int64()), ("i", pa.int64()), ("j", pa.int64()), ("id", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for left, right, columns in blocks_of(batches):
                ids: set[int] = set()
                for at, r in enumerate(left):
                    found = likely(r, at + 1 if left is right else 0, columns, floor, num, den)
                    if len(found):
                        ids.add(r["id"])
                        ids.update(right[x]["id"] for x in found)
                for x in ids:
                    yield left[0]["key"], left[0]["i"], left[0]["j"], x

        yield from batched(made(), schema)

    return run


def shared_count(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two ascending, distinct arrays: equal neighbours once they are merged."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def linker(floor: float, num: int, den: int):
    """Links confirmed on full sets between two blocks, as many as it takes to join their components: fewer than members."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            for left, right, columns in blocks_of(batches):
                root: dict[int, int] = {}

                def find(x: int, root: dict[int, int] = root) -> int:
                    while x in root:
                        x = root[x]
                    return x

                for at, r in enumerate(left):
                    mine = np.frombuffer(r["hashes"], np.uint64)
                    for x in likely(r, at + 1 if left is right else 0, columns, floor, num, den):
                        other = right[x]
                        one, two = find(r["comp"]), find(other["comp"])
                        if one != two:
                            theirs = np.frombuffer(other["hashes"], np.uint64)
                            shared = shared_count(mine, theirs)
                            if den * shared >= num * (len(mine) + len(theirs) - shared):
                                root[max(one, two)] = min(one, two)
                                yield max(r["id"], other["id"]), min(r["id"], other["id"])

        yield from batched(made(), schema)

    return run


def near_duplicates(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents linked when den * |A and B| >= num * |A or B| on sets of k-word shingles.

    component_id is the smallest doc_id reachable over links, itself included; kept marks it. Words are runs of anything but
    ASCII white space with A-Z lower-cased; a text of fewer than k words is one shingle; a text without words, or null, has
    no shingle and no link. Equal rows give one row. Rows that share a doc_id count as one document, linked by any of them.
    A null doc_id can't be ranked: such a row comes back with component_id null and is kept. Extra columns are ignored.
    """
    similarity = num / den
    bands, rows = banding(similarity)
    floor = slack(similarity)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = materialise(texts.mapInArrow(sketcher(k, bands, rows), "doc_id long, n long, cls binary, sig binary, bands array<long>"), "sketch")
    known = sketch.filter("doc_id is not null and n > 0")
    classes = materialise(known.groupBy("cls").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")
    own = sketch.select("doc_id", F.col("n").alias("n_shingles"), "cls").distinct().join(classes.select("cls", "rep"), "cls", "left")
    own = materialise(own.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("rep")), "own")
    several = own.filter("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("b"), F.max("rep").alias("top")).filter("b < top").select("doc_id", "b")
    same_id = own.join(several, "doc_id").filter("rep <> b").select(F.col("rep").alias("a"), "b")
    # One sketch for each distinct set: that of its smallest doc_id.
    reps = materialise(known.join(classes.select("cls", F.col("rep").alias("doc_id")), ["cls", "doc_id"]).select(F.col("doc_id").alias("id"), "cls", "n", "sig", "bands").dropDuplicates(["id", "cls"]), "reps")
    discard(sketch, classes)
    members = reps.select(F.explode("bands").alias("key"), "id", "cls", "n")
    pivots = members.groupBy("key").agg(F.min("id").alias("pivot"), F.max("id").alias("top")).filter("pivot < top").select("key", "pivot")
    shared = materialise(members.join(pivots, "key"), "buckets")
    # Each member's best pivot: the one it meets in most bands.
    pairs = shared.filter("id <> pivot").groupBy(F.col("id").alias("a"), F.col("pivot").alias("b")).agg(F.count("*").alias("met"))
    best = materialise(pairs.groupBy("a").agg(F.max_by("b", F.struct("met", -F.col("b"))).alias("b")), "pairs")

    def sets_of(ids: DataFrame) -> DataFrame:
        """Shingle sets of the documents named: only these texts leave their scan."""
        ids = materialise(ids.distinct(), "candidates")
        out = materialise(texts.join(bounded(ids, 40), "doc_id", "left_semi").mapInArrow(setter(k), "doc_id long, cls binary, hashes binary"), "sets")
        discard(ids)
        return out

    sets = sets_of(best.select(F.explode(F.array("a", "b")).alias("doc_id")))
    links = materialise(confirmed(best, sets, num, den).union(same_id), "links")
    discard(sets, best)
    roots = components(links)

    # Buckets that still hold several components: all their pairs across components, in blocks.
    placed = shared.select("key", "id", "cls", "n").join(roots.select(F.col("node").alias("id"), "root"), "id", "left").select("key", "id", "cls", "n", F.coalesce("root", "id").alias("comp"))
    blocks = F.greatest(F.ceil(F.col("m") / BLOCK), F.ceil(F.col("size") * 8 / BLOCK_BYTES)).cast("long")
    open_keys = placed.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("m"), F.sum("n").alias("size")).filter("lo < hi").select("key", blocks.alias("blocks"))
    dealt = placed.drop("n").join(open_keys, "key").join(reps, ["id", "cls"]).withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumns({"i": F.least("blk", "other"), "j": F.greatest("blk", "other")})
    dealt = dealt.select("key", "i", "j", "blk", "id", "cls", "comp", "n", "sig", "bands")
    among = lambda df: df.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "id")
    rest = materialise(among(dealt.drop("cls")).mapInArrow(parties(floor, num, den), "key long, i long, j long, id long"), "parties")
    if rest.limit(1).count():
        sets = sets_of(rest.select(F.col("id").alias("doc_id")))
        unique = sets.withColumnRenamed("doc_id", "id").dropDuplicates(["id", "cls"])  # an id may have several texts
        held = dealt.join(rest, ["key", "i", "j", "id"], "left_semi").join(unique, ["id", "cls"]).drop("cls")
        more = materialise(among(held).mapInArrow(linker(floor, num, den), "a long, b long"), "links")
        discard(sets)
        both = links.union(more)
        discard(roots)
        roots = components(both)
        discard(more)
    discard(rest, reps, shared, links)

    out = own.join(roots.select(F.col("node").alias("rep"), "root"), "rep", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, k: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """docs with one document of each group of near-duplicates, the smallest doc_id, in their own columns. Rows with null doc_id stay; of rows that share a kept doc_id the first by a digest of the row stays."""
    kept = materialise(near_duplicates(docs, k, num, den).filter("kept and doc_id is not null").select("doc_id").distinct(), "kept")
    out = docs.filter("doc_id is not null").join(bounded(kept, 40), "doc_id", "left_semi").select(*docs.columns)
    if docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").limit(1).count():
        row = F.struct(*docs.columns)
        out = out.groupBy("doc_id").agg(F.min_by(row, F.md5(F.to_json(row))).alias("_row")).select("_row.*")  # texts are dealt out by doc_id only where one repeats
    return out.unionByName(docs.filter("doc_id is null"))
