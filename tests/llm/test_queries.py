"""Each query with SQL against DuckDB on the same tables, and the columns that every query returns."""

import duckdb
import pytest

from loamline.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()
COLUMNS = {
    "op2_minmax_near_dedup": ["doc_id", "n_shingles", "component_id", "kept"],
    "op6_arrow_token_files": ["doc_id", "start", "n_tokens", "ids_crc32"],
    "op7_prefix_tree_chat": ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    "op8_automaton_secrets": ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
    "op9_iso_media": ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
    "op10_splittable_warc": ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"],
}


def rows(df):
    names = sorted(df.columns)
    plain = df[names].astype(object).where(df[names].notna(), None)
    return names, sorted((tuple(float(v) if isinstance(v, (int, float)) and not isinstance(v, bool) else v for v in r) for r in plain.itertuples(index=False)), key=str)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_equals_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got, want = rows(queries.QUERIES[name](spark, sf_dir).toPandas()), rows(duck.sql(queries.ORACLES[name]).df())
    assert got[0] == want[0] and len(got[1]) > 0 and got[1] == want[1]


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    assert set(COLUMNS[name]) <= set(df.columns)
    kinds = dict(df.dtypes)
    assert all(kinds[c] == "bigint" for c in COLUMNS[name] if c.startswith("n_") or c.endswith(("_id", "_bytes", "crc32", "chars", "refers_to", "start")))
    assert all(kinds[c] == "string" for c in COLUMNS[name] if c.endswith(("sha256", "digest", "_type", "spans", "feature")))
