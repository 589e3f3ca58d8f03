"""Near-duplicates against brute force, and the rows that are odd."""

import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from loamline.llm import neardup, shared
from loamline.llm.shared import components

SCHEMA = "doc_id long, text string, sig int, bands string"


def brute(rows, k, num, den):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        sets[d] = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * both >= num * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), find(d)) for d in ids}


def test_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    want = brute(rows, 3, 85, 100)
    got = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(docs, 3, 85, 100).collect()}
    assert got == {d: (n, c, c == d) for d, (n, c) in want.items()}


@pytest.mark.parametrize("seed", [1, 2])
def test_families_around_the_threshold(spark, seed):
    """Groups whose members are linked to some and not to others: chains, stars, and groups that are alike but not enough."""
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(3000)]
    rows = []
    for family in range(6):
        base = [rng.choice(vocabulary) for _ in range(200)]
        for _ in range(25):
            own = list(base)
            for _ in range(rng.choice([1, 2, 4, 6, 8, 10, 14])):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(own)))
            if family % 2:
                base = own  # a chain
    want = brute(rows, 5, 4, 5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 4, 5).collect()}
    assert got == want
    assert len({c for _, c in got.values()}) > 6


def test_odd_rows(spark):
    rows = [
        (1, None, 1, "x"), (2, "", 1, "x"), (3, " \t\n", 1, "x"), (4, "One two", 1, "x"), (5, "one TWO", 1, "x"), (5, "one TWO", 1, "x"),
        (None, "one two", 1, "x"), (6, "word " * 50_000 + "end", 1, "x"), (7, "word " * 50_001 + "end", 1, "x"), (8, "ÉÉ two", 1, "x"), (9, "éé two", 1, "x"),
        (10, "aa bb cc dd ee", 1, "x"), (11, "qq rr ss tt uu", 1, "x"), (12, "aa bb cc dd ee", 1, "x"), (12, "qq rr ss tt uu", 1, "x"),
    ]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in neardup.near_duplicates(spark.createDataFrame(rows, SCHEMA), 3, 85, 100).collect()}
    assert got[(1, 0)] == (1, True) and got[(2, 0)] == (2, True) and got[(3, 0)] == (3, True)
    assert got[(4, 1)] == (4, True) and got[(5, 1)] == (4, False)
    assert got[(None, 1)] == (None, True)
    assert got[(6, 2)] == (6, True) and got[(7, 2)] == (6, False)
    assert got[(8, 1)] == (8, True) and got[(9, 1)] == (9, True)  # only A-Z fold
    assert got[(10, 3)] == (10, True) and got[(11, 3)] == (10, False) and got[(12, 3)] == (10, False)  # 12 is both texts
    empty = neardup.near_duplicates(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_keep_one_keeps_columns_and_null_ids(spark):
    rows = [(1, "a b c d e f", 7, "x"), (2, "a b c d e f", 8, "y"), (2, "a b c d e f", 8, "y"), (3, "z y x w v u", 9, "z"), (3, "z y x w v u", 9, "z"), (None, "a b c d e f", 1, "n")]
    out = neardup.keep_one(spark.createDataFrame(rows, SCHEMA))
    assert out.columns == ["doc_id", "text", "sig", "bands"]
    assert sorted((r.doc_id or -1, r.sig) for r in out.collect()) == [(-1, 1), (1, 7), (3, 9)]


def test_min_max_is_unbiased():
    rng = np.random.default_rng(5)
    a = rng.integers(0, 2**63, 2000, dtype=np.uint64)
    b = np.concatenate([a[:1500], rng.integers(0, 2**63, 500, dtype=np.uint64)])
    odd = neardup.multipliers(2000)
    same = neardup.min_max(a, odd) == neardup.min_max(b, odd)
    assert abs(same[:2000].mean() - 0.6) < 0.04 and abs(same[2000:].mean() - 0.6) < 0.04
    assert abs(np.corrcoef(same[:2000], same[2000:])[0, 1]) < 0.1  # both ends of a permutation agree independently


def test_banding_loses_next_to_nothing():
    for t in (0.8, 0.85, 0.95):
        bands, rows = neardup.banding(t)
        assert (1 - t**rows) ** bands <= 1e-6 and bands * rows <= 128


def test_components_of_a_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(300)] + [(1000, x) for x in range(1001, 1400)] + [(5000, 5000), (None, 3)]
    got = {r.node: r.root for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ids_with_several_texts_in_blocks(spark):
    rows = []
    for f in range(16):
        w = lambda kind, a, b: [f"{kind}{f}x{i}" for i in range(a, b)]  # noqa: E731, B023
        first = w("p", 0, 400)
        second = first[:348] + w("q", 348, 400)  # not linked to the first, but in its buckets
        third = second[:362] + w("r", 362, 400)  # linked to the second only
        other = w("z", 0, 400)
        rows += [(10 * f + 1, " ".join(first)), (10 * f + 2, " ".join(second))]
        rows += [(10 * f + 3, " ".join(t)) for t in ((third, other) if f % 2 else (other, third))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(docs, 5, 4, 5).collect()}
    assert [d for d in got if got[d] != (d - 1 if d % 10 == 3 else d)] == []
    alone = docs.filter("doc_id % 10 = 3")
    once, again = (sorted(map(tuple, neardup.keep_one(x).collect())) for x in (alone, alone.orderBy("text").repartition(3)))
    assert once == again and len(once) == 16


def test_long_near_copies_in_small_blocks(spark, monkeypatch):
    """Buckets of long texts that are alike, some linked and some not, in blocks that hold a few sets each."""
    monkeypatch.setattr(neardup, "BLOCK_BYTES", 400_000)
    rng = random.Random(7)
    base = [f"w{rng.randrange(50_000)}" for _ in range(12_000)]
    rows = []
    for i in range(40):
        own = list(base)
        at = rng.randrange(9_000)
        own[at : at + rng.choice((300, 900, 1500, 2400))] = [f"v{i}x{j}" for j in range(rng.choice((300, 900, 1500, 2400)))]
        rows.append((i, " ".join(own)))
    want = brute(rows, 5, 4, 5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 5, 4, 5).collect()}
    assert got == want and 1 < len({c for _, c in want.values()}) < 40


def test_tables_go_as_their_last_reader_is_done(spark, sf_dir):
    from loamline.session import MADE

    before = set(MADE)
    out = neardup.near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    left = {u.rsplit("/", 1)[1].rsplit("-", 1)[0] for u in set(MADE) - before}
    assert left == {"own", "components"} and out.count() > 0


def test_settings_of_the_session_stay(spark):
    name, most = "spark.sql.execution.arrow.maxBytesPerBatch", "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name), spark.conf.get(most)
    sizes = shared.materialise(spark.range(0, 60, 1, 1).selectExpr("repeat('x', 1000000) as t").mapInArrow(lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches), "n long"), "t")
    assert max(r.n for r in sizes.collect()) < 2 * shared.BATCH_BYTES
    assert (spark.conf.get(name), spark.conf.get(most)) == before
