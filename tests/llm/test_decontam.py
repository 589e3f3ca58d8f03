import random

import numpy as np
import pyarrow.parquet as pq

from loamline.llm import decontam

COLUMNS = ["doc_id", "item_id", "n_item", "n_shared"]


def brute(docs, items, k=5, num=4, den=5):
    def shingles(t):
        w = (t or "").encode().lower().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    held = {i: shingles(t) for i, t in items}
    out = set()
    for d, t in docs:
        s = shingles(t)
        for i, q in held.items():
            if q and den * len(q & s) >= num * len(q):
                out.add((d, i, len(q), len(q & s)))
    return out


def test_both_ways_against_brute_force(spark, sf_dir):
    read = lambda n, c: [(r[c], r["text"]) for r in pq.read_table(f"{sf_dir}/{n}.parquet").to_pylist()]
    want = brute(read("documents", "doc_id"), read("benchmark", "item_id"))
    docs, items = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    for limit in (decontam.BROADCAST_SHINGLES, 0):
        got = {tuple(r) for r in decontam.contaminations(docs, items, broadcast_shingles=limit).select(COLUMNS).collect()}
        assert got == want


def test_short_items_in_long_documents(spark):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(5000)]
    say = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(say(n))) for i, n in enumerate([1, 3, 5, 6, 9, 14, 30, 61, 200, 700])]
    docs = []
    for i, text in items:
        long = say(20_000)
        at = rng.randrange(len(long))
        docs.append((i, " ".join(long[:at] + text.split() + long[at:])))
        part = text.split()
        docs.append((100 + i, " ".join(long[:50] + part[: max(1, len(part) * 9 // 10)] + long[:50])))
        docs.append((200 + i, " ".join(long[:50] + part[: len(part) // 2] + long[:50])))
        docs.append((300 + i, text.upper()))
    want = brute(docs, items)
    got = decontam.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.select(COLUMNS).collect()} == want and len(want) > 20


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "", 5), (None, "a b c d e f", 5), (3, "x A B C D E F y", 5), (3, "x A B C D E F y", 5)], "doc_id long, text string, item_id long")
    items = spark.createDataFrame([(7, "a b c d e f", 1), (7, "a b c d e f", 1), (8, None, 1), (9, "", 1)], "item_id long, text string, doc_id long")
    for limit in (1000, 0):
        got = decontam.contaminations(docs, items, broadcast_shingles=limit)
        assert sorted(((r.doc_id or -1), r.item_id, r.n_shared) for r in got.collect()) == [(-1, 7, 2), (3, 7, 2)]
    assert sorted(r.doc_id for r in decontam.clean(docs, items).collect()) == [1, 2]
    assert decontam.clean(docs, items).columns == docs.columns
    assert decontam.contaminations(docs, items.limit(0)).count() == 0
    assert decontam.contaminations(docs.limit(0), items).count() == 0


def test_windows_hold_every_item():
    rng = np.random.default_rng(1)
    odd = decontam.multipliers(8)
    stream = rng.integers(0, 2**63, 1003, dtype=np.uint64)
    for u, windows in decontam.signatures(stream, [4, 8, 64], odd):
        n = len(windows)
        for i in range(n):
            assert (windows[i] == (stream[i * u : i * u + 2 * u, None] * odd).min(axis=0)).all()
        assert n * u + u >= len(stream)


def test_columns_of_any_name_keep_their_values(spark):
    names = ["_leaked", "leaked", "item_id", "d", "i", "item", "id", "key"]
    rows = [(i, "a b c d e f" if i % 3 == 0 else f"x{i} y z", *[f"{n}{i}" for n in names]) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id int, text string, " + ", ".join(f"`{n}` string" for n in names))
    items = spark.createDataFrame([(7, "a b c d e f")], "item_id long, text string")
    out = decontam.clean(df, items)
    assert out.columns == df.columns and sorted(map(tuple, out.collect())) == [r for r in rows if r[0] % 3]


def test_many_short_items_are_joined(spark, monkeypatch):
    monkeypatch.setattr(decontam, "BROADCAST_KEYS", 64 * 50)
    items = [(i, f"w{i}") for i in range(100)] + [(1000, "p q r s t u v")]
    docs = [(i, f"w{i}") for i in range(0, 300, 2)] + [(5000, "a p q r s t u v b"), (5000, "a p q r s t u v b"), (None, "w1")]
    got = decontam.contaminations(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert {tuple(r) for r in got.select(COLUMNS).collect()} == brute(docs, items)
