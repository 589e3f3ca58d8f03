"""Every query that has SQL against DuckDB on the same tables; the others run."""

import re

import duckdb
import numpy as np
import pandas as pd
import pytest

from loamline import plans

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck(sf_dir):
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return c


def value(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float | np.floating) and v != v):
        return None
    if isinstance(v, bool | np.bool_):
        return bool(v)
    return float(v) if isinstance(v, int | float | np.integer | np.floating) else str(v)


def rows(df):
    names = sorted(df.columns)
    out = [tuple(value(v) for v in r) for r in zip(*[df[c].tolist() for c in names], strict=True)]
    return names, sorted(out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_equals_sql(spark, sf_dir, duck, name):
    got, want = rows(plans.QUERIES[name](spark, sf_dir).toPandas()), rows(duck.sql(plans.ORACLES[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1]) > 0
    assert got[1] == want[1]


@pytest.mark.parametrize("name", sorted(set(plans.QUERIES) - set(plans.ORACLES)))
def test_runs(spark, sf_dir, name):
    df = plans.QUERIES[name](spark, sf_dir)
    assert df.count() > 0 and df.columns


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_the_rest_does_not_know_the_corpus_operators():
    import pathlib

    root = pathlib.Path(plans.__file__).parent.parent
    for p in root.rglob("*.py"):
        if "llm" not in p.relative_to(root).parts:
            assert not re.search(r"\bllm\b", p.read_text()), p


def test_plans_join_by_keys_and_push_down(spark, sf_dir):
    text = plans.QUERIES["point_in_polygon"](spark, sf_dir)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    text = plans.QUERIES["parcel_year_hits"](spark, sf_dir)._jdf.queryExecution().toString()
    scan = [x for x in text.split("\n") if "ReadSchema" in x and "c_custkey" in x]
    assert scan and all("c_acctbal" not in x.split("ReadSchema")[1] for x in scan)
