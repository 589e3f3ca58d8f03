"""Token files: Arrow streams whose batches hold fixed-size lists, so sequences and masks of equal length are read in place.

Documents are dealt out by ranges of doc_id (or of another order); each range becomes a shard of two files. `seq-*.arrow` holds the ids of its
documents one after another, cut to sequences of `length`: columns ids and mask are fixed-size lists, every batch but the last holds the
same number of sequences, and only the last sequence of a shard is padded (its mask is false there). A mapped file gives sequence i as a slice
of its batch's buffer, with no copy. `doc-*.arrow` holds doc_id, start in the shard and n_tokens.
Files are written under a name of their own and moved into place, so repeated or lost tasks leave no half files.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.ipc as ipc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .shared import batched, materialise, new_files, opened, released

LENGTH = 2048
#: Sequences in a batch.
SEQUENCES = 64


#: The splitting pattern and word end of tokenizers whose pieces are runs of letters, single digits and runs of other signs.
RUNS_PATTERN, WORD_END = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+", "</w>"
#: In words of Latin-1 letters, digits and ASCII signs but ' and < (which may begin a piece of another kind), RUN finds the pieces; SPECIAL finds what is in other words.
SPECIAL = re.compile(r"[^ \t\n\rA-Za-zÀ-ÖØ-öø-ÿ0-9!-&(-/:;=-@\[-`{-~]")
RUN = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-&(-/:;=-@\[-`{-~]+")
#: White space to any tokenizer; other kinds stay inside words and are left to it.
BETWEEN = re.compile(r"[ \t\n\r]")


def byte_signs() -> dict[int, str]:
    """The sign that stands for each byte in byte-level vocabularies: visible ones for themselves, the others for 256 and on in order."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in set(own))}


class WordTokens:
    """Ids of whole texts. Where the tokenizer drops white space and no piece spans it, pieces are encoded once and kept in a cache of two generations:
    when the younger is full it becomes the older, and what is met again moves to the younger, so frequent pieces stay."""

    def __init__(self, path: str, most: int = 800_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.of = Tokenizer.from_file(path)
        self.most, self.known, self.older = most, {}, {}
        self.dtype = np.uint16 if self.of.get_vocab_size() <= 1 << 16 else np.uint32
        ids = lambda s: self.of.encode(s, add_special_tokens=False).ids
        probes = [("a", "b"), ("don't", "'s"), ("1", "2"), ("!", "?"), ("é", "\u0301x"), ("a.", ".b")]
        self.by_word = not ids(" \t\n\r") and all(ids(a + gap + b) == ids(a) + ids(b) for a, b in probes for gap in (" ", "\n", " \t\r\n ")) and all(ids(a + " ") == ids(a) == ids(" " + a) for pair in probes for a in pair)
        about = json.loads(self.of.to_str())
        split = ((about.get("pre_tokenizer") or {}).get("pretokenizers") or [{}])[0]
        self.by_run = self.by_word and split.get("pattern") == {"Regex": RUNS_PATTERN} and about["model"].get("end_of_word_suffix") == WORD_END and ids("Ab!") == ids("ab") + ids("!")
        # Plain pieces are normal and split already: the model alone gives their ids, once their bytes are written as its signs.
        self.signs = byte_signs()
        kinds = [x.get("type") for x in (about.get("pre_tokenizer") or {}).get("pretokenizers") or []]
        self.by_model = self.by_run and kinds == ["Split", "ByteLevel"] and all(self.direct(p) == ids(p) for p in ("a", "straße", "çé", "ÿ", "7", "!?", "-", "\\", "abcdefghijklmnop" * 9))

    def pieces(self, text: str) -> list[str]:
        """Runs of plain words, and other words whole."""
        if not self.by_run:
            return BETWEEN.split(text)
        hit = SPECIAL.search(text)
        if hit is None:
            return RUN.findall(text.lower())
        out, at = [], 0
        while hit is not None:
            start = max(text.rfind(c, at, hit.start()) for c in " \t\n\r") + 1 or at
            stop = BETWEEN.search(text, hit.end())
            stop = stop.start() if stop else len(text)
            out += RUN.findall(text[at:start].lower())
            out.append(text[start:stop])
            at = stop
            hit = SPECIAL.search(text, at)
        return out + RUN.findall(text[at:].lower())

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if not self.by_word:
            return [np.array(e.ids, self.dtype) for e in self.of.encode_batch_fast(texts, add_special_tokens=False)]
        split = [self.pieces(t) for t in texts]
        if len(self.known) > self.most // 2:
            self.known, self.older = {}, self.known
        new: set[str] = set()
        for pieces in split:
            new.update(pieces)
        known, older = self.known, self.older
        unknown = [p for p in new if p not in known]
        known.update([(p, older[p]) for p in unknown if p in older])
        self.learn([p for p in unknown if p not in older])
        found = known.__getitem__
        return [np.frombuffer(b"".join(map(found, pieces)), self.dtype) for pieces in split]

    def direct(self, piece: str) -> list[int]:
        """Ids of a plain piece by the model."""
        return [t.id for t in self.of.model.tokenize(piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.signs))]

    def learn(self, pieces: list[str]) -> None:
        rest = pieces
        if self.by_model:
            tokenize, signs = self.of.model.tokenize, self.signs
            flat: list[int] = []
            cut = [0]
            plain, rest = [], []
            for p in pieces:
                if SPECIAL.search(p):
                    rest.append(p)
                    continue
                flat += [t.id for t in tokenize(p if p.isascii() else p.encode().decode("latin-1").translate(signs))]
                plain.append(p)
                cut.append(len(flat))
            raw, width = np.array(flat, self.dtype).tobytes(), np.dtype(self.dtype).itemsize
            self.known.update((p, raw[a * width : b * width]) for p, a, b in zip(plain, cut, cut[1:], strict=False))
        for p in rest:
            self.known[p] = np.array(self.of.encode(p, add_special_tokens=False).ids, self.dtype).tobytes()


def word_tokens(path: str) -> WordTokens:
    """The process's own WordTokens for a tokenizer: a Python worker keeps it from task to task."""
    store = sys.modules.setdefault("_loamline_tokens", types.ModuleType("_loamline_tokens")).__dict__
    if path not in store:
        store[path] = WordTokens(path)
    return store[path]


def sequence_schema(length: int, dtype: type) -> pa.Schema:
    return pa.schema([("ids", pa.list_(pa.from_numpy_dtype(dtype), length)), ("mask", pa.list_(pa.bool_(), length))])


DOCS = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])
SHARDS = pa.schema([("shard", pa.int64()), ("seq_uri", pa.string()), ("doc_uri", pa.string()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("n_sequences", pa.int64())])


class Put:
    """A file that appears under its name only when whole."""

    def __init__(self, uri: str, attempt: int):
        self.fs, self.path = opened(uri)
        self.temporary = f"{self.path}.{attempt}.tmp"
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.temporary)

    def done(self) -> None:
        self.out.close()
        self.fs.move(self.temporary, self.path)


def writer(directory: str, tokenizer: str, end_id: int | None, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard, attempt = context.partitionId(), context.taskAttemptId()
        tokens = None
        full = SEQUENCES * length
        seq_uri, doc_uri = (f"{directory}/{kind}-{shard:06d}.arrow" for kind in ("seq", "doc"))
        held: list[np.ndarray] = []
        waiting = n_docs = n_tokens = n_sequences = 0

        def put(ids: np.ndarray, real: int) -> None:
            nonlocal n_sequences
            mask = np.zeros(len(ids), bool)
            mask[:real] = True
            columns = [pa.FixedSizeListArray.from_arrays(pa.array(x), length) for x in (ids, mask)]
            sequences.write_batch(pa.RecordBatch.from_arrays(columns, schema=schema))
            n_sequences += len(ids) // length

        for batch in batches:
            if not batch.num_rows:
                continue
            if tokens is None:
                tokens = word_tokens(tokenizer)
                schema = sequence_schema(length, tokens.dtype)
                files = Put(seq_uri, attempt), Put(doc_uri, attempt)
                sequences, index = ipc.new_stream(files[0].out, schema), ipc.new_stream(files[1].out, DOCS)
            end = np.array([] if end_id is None else [end_id], tokens.dtype)
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                rows = []
                for doc, ids in zip(part.column(0).to_pylist(), tokens.encode([t or "" for t in part.column(1).to_pylist()]), strict=True):
                    rows.append((doc, n_tokens, len(ids) + len(end)))
                    n_tokens += len(ids) + len(end)
                    held += [ids, end]
                    waiting += len(ids) + len(end)
                    if waiting >= full:
                        ids = np.concatenate(held)
                        for i in range(0, waiting - full + 1, full):
                            put(ids[i : i + full], full)
                        held = [ids[waiting // full * full :].copy()]
                        waiting %= full
                n_docs += len(rows)
                index.write_batch(pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), DOCS, strict=True)], schema=DOCS))
        if tokens is None:
            return
        if waiting:
            ids = np.zeros(-(-waiting // length) * length, tokens.dtype)
            ids[:waiting] = np.concatenate(held)
            put(ids, waiting)
        sequences.close()
        index.close()
        for f in files:
            f.done()
        released()
        yield pa.RecordBatch.from_pylist([{"shard": shard, "seq_uri": seq_uri, "doc_uri": doc_uri, "n_docs": n_docs, "n_tokens": n_tokens, "n_sequences": n_sequences}], schema=SHARDS)

    return run


def write_tokens(docs: DataFrame, directory: str, tokenizer: str, end_id: int | None, length: int = LENGTH, order: list[Column] | None = None) -> DataFrame:
    """Writes docs (doc_id, text) in ascending doc_id order, or by the columns of `order`; returns one row for each shard, with the ids of all shards before it as `start`.

    A null text is empty, a null doc_id sorts first, repeated rows are written as often as they come, equal doc_ids in order
    of their texts and in one shard, which is written as a stream. Extra columns are ignored. An empty table makes no file.
    """
    own = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")]
    # Ranges are of doc_id alone: their bounds come from a sample sent to the driver, which holds no texts.
    keys = [f"order_{i}" for i in range(len(order or []))]
    texts = docs.select(*own, *[c.alias(k) for k, c in zip(keys, order or [], strict=True)])
    sorted_ = texts.repartitionByRange(*(keys or ["doc_id"])).sortWithinPartitions(*(keys or ["doc_id", "text"])).select("doc_id", "text")
    shards = materialise(sorted_.mapInArrow(writer(directory, tokenizer, end_id, length), "shard long, seq_uri string, doc_uri string, n_docs long, n_tokens long, n_sequences long"), "shards")
    # One row for each file: a window without a key is small.
    return shards.withColumn("start", F.coalesce(F.sum("n_tokens").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long")))


class TokenFile:
    """Random access to the sequences of one file: on a local file system it is mapped, and what is returned lies in the map."""

    def __init__(self, uri: str):
        fs, path = opened(uri)
        source = pa.memory_map(path) if fs.type_name == "local" else fs.open_input_file(path)
        self.batches = list(ipc.open_stream(source))
        self.most = self.batches[0].num_rows if self.batches else 1

    def __len__(self) -> int:
        return sum(b.num_rows for b in self.batches)

    def ids(self, i: int) -> np.ndarray:
        return self._at("ids", i).to_numpy(zero_copy_only=True)

    def mask(self, i: int) -> pa.BooleanArray:
        return self._at("mask", i)

    def _at(self, name: str, i: int) -> pa.Array:
        column = self.batches[i // self.most].column(name)
        size, row = column.type.list_size, i % self.most
        return column.values.slice((column.offset + row) * size, size)


def read_stream(uri: str) -> Iterator[pa.RecordBatch]:
    fs, path = opened(uri)
    with fs.open_input_stream(path) as f:
        yield from ipc.open_stream(f)


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def documents_of(seq_uri: str, doc_uri: str) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """doc_id, start in the shard and ids of each document of a shard, read batch by batch."""
    parts = (b.column("ids").flatten().to_numpy()[b.column("mask").flatten().to_numpy(zero_copy_only=False)] for b in read_stream(seq_uri))
    left = np.zeros(0, np.uint16)
    for batch in read_stream(doc_uri):
        for doc, start, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            pieces, have = [left], len(left)
            while have < n:
                pieces.append(next(parts))
                have += len(pieces[-1])
            ids = np.concatenate(pieces) if len(pieces) > 1 else left
            left = ids[n:]
            yield doc, start, ids[:n]


def reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        for batch in batches:
            for row in batch.to_pylist():
                for doc, start, ids in documents_of(row["seq_uri"], row["doc_uri"]):
                    yield doc, row["start"] + start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())

    yield from batched(made(), READ)


def read_tokens(shards: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files: one task reads a shard at a time."""
    n = max(1, shards.count())
    return shards.select("seq_uri", "doc_uri", "start").repartition(n).mapInArrow(reader, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, tokenizer: str, end_id: int | None, length: int = LENGTH, directory: str | None = None, order: list[Column] | None = None) -> DataFrame:
    """Writes docs to token files in a new folder (or the one given) and returns what reading them gives."""
    return read_tokens(write_tokens(docs, new_files(docs.sparkSession, "tokens", directory), tokenizer, end_id, length, order))
