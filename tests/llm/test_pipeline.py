"""The stages against brute force on a small table."""

from collections import Counter

import corpus_pipeline
import public_tokenizers
import pyarrow.parquet as pq
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loamline.llm import mixing

from .test_decontam import brute as leaks
from .test_neardup import brute as groups


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/benchmark.parquet").to_pylist()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "mixing", "token_output"]
    held = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.collect()
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), "test")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        held[name] = (before, docs.collect())
    before, after = held["language_id"]
    assert {r.doc_id for r in before if any(c.isalpha() for c in r.text)} == {r.doc_id for r in after}
    before, after = held["near_dedup"]
    assert sorted(r.doc_id for r in after) == sorted(d for d, (_, c) in groups([(r.doc_id, r.text) for r in before], 5, 4, 5).items() if c == d)
    before, after = held["decontamination"]
    bad = {d for d, *_ in leaks([(r.doc_id, r.text) for r in before], items)}
    assert bad and sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if r.doc_id not in bad)
    before, after = held["mixing"]
    assert {r.doc_id for r in before if r.text.split()} == {r.doc_id for r in after}
    rows = sorted(corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect(), key=lambda r: r.start)
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    # The token files hold the mixture in the order of its blocks and places.
    mixture = mixing.mixture(spark.createDataFrame(before, docs.schema), evenness=0.93, most_repeats=2.0).orderBy("block", "place").collect()
    text = {d.doc_id: d.text for d in after}
    at = 0
    for r, m in zip(rows, mixture, strict=True):
        n = len(t.encode(text[m.doc_id], add_special_tokens=False).ids) + 1
        assert (r.doc_id, r.start, r.n_tokens) == (m.doc_id, at, n)
        at += n
    assert Counter(d.doc_id for d in after) == Counter(m.doc_id for m in mixture)


def test_run(spark, sf_dir):
    assert corpus_pipeline.run(spark, sf_dir).count() > 0


def test_columns_of_any_name_keep_their_values(spark, sf_dir):
    names = ["_lang", "_host", "_s", "_prior", "_id", "_taken", "_rows", "_copy", "_leaked", "row", "kept", "component_id", "count"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = docs.select("*", *[F.concat(F.lit(n), F.col("doc_id").cast("string")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.materialise(stage(spark, docs, sf_dir), "test")
    rows = docs.collect()
    assert len(rows) > 100 and all(r[n] == f"{n}{r.doc_id}" for r in rows for n in names)
