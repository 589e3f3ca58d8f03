import random
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from loamline import session
from loamline.llm import shared, warc
from loamline.llm import tokenfiles as tf

WORDS = public_tokenizers.path("word_bpe_49k.json")


def expected(rows, end=2):
    t = Tokenizer.from_file(WORDS)
    out, at = [], 0
    for d, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*t.encode(text or "", add_special_tokens=False).ids, end]
        out.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_round_trip(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in pq.read_table(f"{sf_dir}/documents.parquet").to_pylist()]
    got = tf.token_output(spark.read.parquet(f"{sf_dir}/documents.parquet"), WORDS, 2)
    assert sorted(map(tuple, got.collect())) == sorted(expected(rows))


def test_odd_rows(spark):
    rows = [(3, None, 1), (1, "", 1), (2, "hello " * 30_000, 1), (2, "hello " * 30_000, 1), (None, "x", 1), (4, "<|endoftext|> it's <|start", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long")
    got = tf.token_output(docs, WORDS, 2, length=64)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, expected([r[:2] for r in rows])))
    assert tf.token_output(docs.limit(0), WORDS, 2).count() == 0


def test_files_are_read_in_place(spark, tmp_path, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    shards = tf.write_tokens(docs, f"file://{tmp_path}/t", WORDS, 2, length=128).collect()
    for s in shards:
        f = tf.TokenFile(s.seq_uri)
        assert len(f) == s.n_sequences == -(-s.n_tokens // 128)
        own = np.concatenate([f.ids(i) for i in range(len(f))])
        mask = np.concatenate([f.mask(i).to_numpy(zero_copy_only=False) for i in range(len(f))])
        assert mask[: s.n_tokens].all() and not mask[s.n_tokens :].any()
        assert {len(f.ids(i)) for i in range(len(f))} == {128}
        docs_of = [ids for _, _, ids in tf.documents_of(s.seq_uri, s.doc_uri)]
        assert (np.concatenate(docs_of) == own[mask]).all()
        a, buffers = f.ids(len(f) - 1), f.batches[(len(f) - 1) // f.most].column("ids").values.buffers()
        assert buffers[1].address <= a.__array_interface__["data"][0] < buffers[1].address + buffers[1].size  # no copy


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_words_encode_like_whole_texts(name):
    own = tf.WordTokens(public_tokenizers.path(name))
    assert own.by_word == name.startswith("word")
    rng = random.Random(4)
    signs = "abAB '<|>endoftextstar.!?-_09éÉÀßŒ́ΣσΑ\t\n\r\x0b\x0c\x1c\x85\xa0  中😀ª×÷İ&"
    for _ in range(3000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(30)))
        assert own.encode([text])[0].tolist() == own.of.encode(text, add_special_tokens=False).ids


def test_stores_that_binary_files_cannot_reach_are_refused_at_once(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    pages = spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string")
    for run in (lambda: tf.token_output(docs, WORDS, 2, directory="oss://c/x"), lambda: warc.archived(pages, "oss://c/x")):
        with pytest.raises(ValueError, match="oss"):
            run()
    asked = []
    monkeypatch.setattr(session, "pafs", SimpleNamespace(FileSystem=SimpleNamespace(from_uri=lambda uri: asked.append(uri) or (None, ""))))
    for uri in ("s3a://b/x", "hdfs://n/x", "file:///x"):
        shared.new_files(spark, "t", uri)
    assert asked == ["s3://b/x", "hdfs://n/x", "file:///x"]
