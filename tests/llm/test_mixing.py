import hashlib
import math
from collections import Counter, defaultdict

import pytest

from loamline.llm import mixing

SCHEMA = "doc_id long, text string, source string, block long, tokens int"


def table(spark, sizes):
    rows, at = [], 0
    for source, (n, words) in sizes.items():
        for i in range(n):
            rows.append((at, "w " * (words + i % 7), source, 1, 1))
            at += 1
    return spark.createDataFrame(rows, SCHEMA)


def brute(rows, e, seed=42, block_tokens=1_000_000):
    tokens = defaultdict(int)
    for _, s, n in rows:
        tokens[s] += n
    total = sum(t**e for t in tokens.values())
    whole = max(tokens.values()) ** (1 - e) * total
    blocks = max(1, -(-int(whole) // block_tokens))
    out = set()
    md5 = lambda s: hashlib.md5(s.encode()).hexdigest()
    for s, t in tokens.items():
        quota, end = round(t**e / total * whole), 0
        epoch = 0
        while end < quota and epoch <= quota // t:
            for d, n in sorted(((d, n) for d, x, n in rows if x == s), key=lambda r: (md5(f"{seed}:{epoch}:{r[0]}"), r)):
                end += n
                if end <= quota:
                    out.add((min((end - n) * blocks // quota, blocks - 1), d, s, epoch, n))
            epoch += 1
    return out


@pytest.mark.parametrize("options", [{}, {"evenness": 0.99, "most_repeats": 50.0}, {"evenness": None, "most_repeats": 1.5}, {"evenness": 0.5, "most_repeats": 5.0}])
def test_against_brute_force(spark, options):
    df = table(spark, {"big": (300, 40), "mid": (100, 30), "small": (30, 20), "tiny": (3, 5)})
    rows = [(r.doc_id, r.source, len(r.text.split())) for r in df.collect()]
    tokens = Counter()
    for _, s, n in rows:
        tokens[s] += n
    spark_rows = mixing.mixture(df, block_tokens=500, **options).collect()
    options = {"evenness": 0.93, "most_repeats": 2.0} | options

    def meets(e):
        w = [t**e for t in tokens.values()]
        h = -sum(x / sum(w) * math.log(x / sum(w)) for x in w)
        repeats = (max(tokens.values()) / min(tokens.values())) ** (1 - e)
        return (options["evenness"] is None or h <= options["evenness"] * math.log(len(w)) + 1e-12) and repeats <= options["most_repeats"] * (1 + 1e-12)

    low, high = 0.0, 1.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if meets(mid) else (mid, high)
    e = 0.0 if meets(0.0) else math.ceil(high * 1e6) / 1e6
    got = {(r.block, r.doc_id, r.source, r.epoch, r.tokens) for r in spark_rows}
    assert got == brute(rows, e, block_tokens=500) and len(got) == len(spark_rows)
    places = defaultdict(list)
    for r in spark_rows:
        places[r.block].append(r.place)
    assert all(sorted(p) == list(range(1, len(p) + 1)) for p in places.values())
    assert {d for d, *_ in rows} == {r.doc_id for r in spark_rows}  # without a budget every document comes


def test_slices_do_not_change_the_result(spark, monkeypatch):
    df = table(spark, {"a": (500, 9), "b": (60, 9)})
    want = {tuple(r) for r in mixing.mixture(df, block_tokens=300).collect()}
    monkeypatch.setattr(mixing, "SLICE", 16)
    assert {tuple(r) for r in mixing.mixture(df, block_tokens=300).collect()} == want


def test_a_budget_is_kept_and_blocks_are_alike(spark):
    df = table(spark, {"a": (800, 10), "b": (400, 10)})
    rows = mixing.mixture(df, evenness=None, most_repeats=10.0, budget=6000, block_tokens=1000).collect()
    assert 5900 < sum(r.tokens for r in rows) <= 6000
    share = Counter()
    for r in rows:
        share[r.block, r.source] += r.tokens
    assert all(abs(share[b, "a"] - share[b, "b"]) < 60 for b in range(6))


def test_odd_rows(spark):
    rows = [(1, None, "s", 1, 1), (2, "", "s", 1, 1), (3, "a b", None, 1, 1), (4, "c d", "", 1, 1), (None, "e f", "s", 1, 1), (5, "g h", "s", 1, 1), (5, "g h", "s", 1, 1), (6, "x " * 100_000, "s", 1, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = mixing.mixture(df).collect()
    assert {r.doc_id for r in got} == {3, 4, None, 5, 6} and Counter(r.doc_id for r in got if r.source == "s" and r.epoch == 0)[5] == 2
    out = mixing.mixed_docs(df)
    assert out.columns == df.columns and {r.doc_id for r in out.collect()} == {3, 4, None, 5, 6}
    assert mixing.mixture(df.limit(0)).count() == 0 and mixing.mixed_docs(df.limit(0)).count() == 0
    assert mixing.mixture(spark.createDataFrame([(1, None, "s", 1, 1)], SCHEMA)).count() == 0


def test_no_python_runs_on_executors(spark, sf_dir):
    df = mixing.mixture(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    plan = df._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_files_hold_the_mixture_in_its_order(spark, tmp_path):
    df = table(spark, {"big": (300, 40), "mid": (100, 30), "small": (30, 20)})
    options = {"block_tokens": 700}
    want = [r.doc_id for r in mixing.mixture(df, **options).orderBy("block", "place").collect()]
    mixing.mixed_docs(df, **options).write.parquet(f"{tmp_path}/m")
    back = spark.read.parquet(f"{tmp_path}/m")
    order = mixing.file_order(back)
    assert [r.doc_id for r in back.orderBy(*order).collect()] == want and want != sorted(want)
    assert mixing.file_order(df) is None
    # Sources alternate: no third of the order lacks one.
    sources = [r.source for r in back.orderBy(*order).collect()]
    assert all({"big", "mid", "small"} == set(sources[i : i + len(sources) // 3]) for i in (0, len(sources) // 3, len(sources) * 2 // 3 - 1))


def test_rows_that_share_an_id_come_as_often_as_the_mixture_takes_them(spark):
    rows = [(1, "a " * 10, "s"), (1, "b " * 10, "s"), (1, "c " * 10, "s"), (1, "d " * 12, "t"), (None, "e " * 10, "s"), (None, "f " * 10, "s"), (2, "g " * 10, "s"), (2, "g " * 10, "s")] + [(10 + i, "x " * 10, "s") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for options in ({}, {"budget": 250}, {"budget": 900, "most_repeats": 50.0, "evenness": 0.99}):
        took = Counter((r.doc_id, r.source, r.tokens) for r in mixing.mixture(df, **options).collect())
        got = Counter((r.doc_id, r.source, len(r.text.split())) for r in mixing.mixed_docs(df, **options).collect())
        assert got == took
    whole = Counter(r.text for r in mixing.mixed_docs(df).collect())
    assert all(whole[t] >= sum(r[1] == t for r in rows) for t in {r[1] for r in rows})


def test_columns_of_any_name_keep_their_values(spark):
    names = ["_id", "_taken", "_rows", "_copy", "row", "id", "place", "other", "tokens", "nth", "_metadata"]
    rows = [(i % 20, "w " * (5 + i % 3), "s" if i % 4 else "t", *[f"{n}{i}" for n in names]) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"`{n}` string" for n in names))
    out = mixing.mixed_docs(df)
    assert out.columns == df.columns and set(map(tuple, out.collect())) == set(rows)
