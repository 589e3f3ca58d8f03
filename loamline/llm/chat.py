"""Chat formatting as prefix trees.

Conversations that share their first turns share those turns' characters: sorted by the digests of their prefixes, equal
prefixes lie side by side, and one pass over a sorted partition walks the forest depth-first, emitting each turn once. A pack is a bounded
piece of that walk: its text, one node for each turn (where it lies, its parent, the position of its first character in its own
conversation, the spans of the pack it may attend to besides itself, and its loss span) and the conversations that end at its nodes.
The order is by the digests of all turns, so any number of turns is shared. A shared prefix that crosses a pack or partition border is emitted
again there, so no group of conversations, however large, meets in one task; a pack is at least four times as long as the conversation at
its end, which keeps what is repeated below a quarter. A conversation too long for memory continues as further segments with positions that carry on.

with_tokens() gives packs their token ids: each turn is encoded by itself, so shared turns have the same ids whatever follows, and the
nodes' places, positions, attention and loss spans once more, counted in tokens.

Template: <|im_start|>ROLE newline TEXT <|im_end|> newline for each turn. Inside texts and roles "&" is written "&amp;" and "<|" is
written "&lt;|" (and a newline in a role "&#10;"), so no text can hold a control string and reading back gives it exactly.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import batched, materialise
from .tokenfiles import word_tokens

START, END = "<|im_start|>", "<|im_end|>"
#: A conversation is cut into segments of so many turns or characters at most (one longer turn makes a segment of its own).
SEGMENT_TURNS, SEGMENT_CHARS = 1024, 4_000_000
#: A pack is closed once its text is longer than this, and than PACK_SHARE times the conversation just added.
PACK_CHARS, PACK_SHARE = 1_000_000, 4
#: Bytes of a turn's chained digest in the order of conversations: should two meet, a shared turn is emitted twice, no more.
MARK = 4


def escape(text: str) -> str:
    return text.replace("&", "&amp;").replace("<|", "&lt;|")


def unescape(text: str) -> str:
    return text.replace("&lt;|", "<|").replace("&amp;", "&")


def turn_text(role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn and where its escaped text begins and ends in it."""
    head = f"{START}{escape(role).replace('\n', '&#10;')}\n"
    body = escape(text)
    return f"{head}{body}{END}\n", len(head), len(head) + len(body)


def parse_turn(formatted: str) -> tuple[str, str]:
    """Role and text of a formatted turn."""
    assert formatted.startswith(START) and formatted.endswith(END + "\n")
    role, _, text = formatted[len(START) : -len(END) - 1].partition("\n")
    return unescape(role.replace("&#10;", "\n")), unescape(text)


TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
SEGMENTS = pa.schema([("conv_id", pa.int64()), ("seg", pa.int64()), ("path", pa.binary()), ("offset", pa.int64()), ("more", pa.bool_()), ("turns", pa.list_(TURN))])


def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the conversations in a stream sorted by conversation and turn."""

    def made():
        at: object = object()
        turns: list[dict] = []
        seg = chars = offset = 0
        chain = b""
        path: list[bytes] = []

        def segment(more: bool) -> tuple:
            return at, seg, b"".join(path), offset, more, turns

        for batch in batches:
            for conv, _, role, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if conv != at:
                    if turns:
                        yield segment(False)
                    at, turns, seg, chars, offset, chain, path = conv, [], 0, 0, 0, b"", []
                elif len(turns) >= SEGMENT_TURNS or chars >= SEGMENT_CHARS:
                    yield segment(True)
                    offset += chars
                    turns, seg, chars, path = [], seg + 1, 0, [chain[:MARK]]
                chain = hashlib.sha256(chain + role.encode("utf-8", "surrogatepass") + b"\0" + text.encode("utf-8", "surrogatepass")).digest()
                path.append(chain[:MARK])
                turns.append({"role": role, "text": text})
                chars += len(turn_text(role, text)[0])
        if turns:
            yield segment(False)

    yield from batched(made(), SEGMENTS, 500)


SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
NODE = pa.struct([("parent", pa.int64()), ("start", pa.int64()), ("end", pa.int64()), ("position", pa.int64()), ("loss_start", pa.int64()), ("loss_end", pa.int64()), ("attends", pa.list_(SPAN))])
LEAF = pa.struct([("conv_id", pa.int64()), ("seg", pa.int64()), ("more", pa.bool_()), ("node", pa.int64())])
PACKS = pa.schema([("text", pa.string()), ("nodes", pa.list_(NODE)), ("leaves", pa.list_(LEAF))])
PACKS_DDL = (
    "text string, nodes array<struct<parent: long, start: long, end: long, position: long, loss_start: long, loss_end: long, attends: array<struct<start: long, end: long>>>>, "
    "leaves array<struct<conv_id: long, seg: long, more: boolean, node: long>>"
)


class Pack:
    """A pack being made; `branch` holds the turns from the root to the last node."""

    def __init__(self):
        self.pieces: list[str] = []
        self.chars = 0
        self.nodes: list[dict] = []
        self.leaves: list[dict] = []
        self.branch: list[tuple[tuple, int]] = []

    def add(self, row: dict) -> None:
        turns = [(row["seg"], row["offset"], t["role"], t["text"]) for t in row["turns"]]
        shared = 0
        for (held, _), turn in zip(self.branch, turns, strict=False):
            if held != turn:
                break
            shared += 1
        del self.branch[shared:]
        for turn in turns[shared:]:
            parent = self.branch[-1][1] if self.branch else -1
            above = self.nodes[parent] if parent >= 0 else None
            text, start, end = turn_text(turn[2], turn[3])
            loss = turn[2] == "assistant"
            attends: list[dict] = []
            if above:
                attends = [dict(s) for s in above["attends"]]
                if attends and attends[-1]["end"] == above["start"]:
                    attends[-1]["end"] = above["end"]
                else:
                    attends.append({"start": above["start"], "end": above["end"]})
            position = above["position"] + above["end"] - above["start"] if above else turn[1]
            at = self.chars
            self.nodes.append({"parent": parent, "start": at, "end": at + len(text), "position": position, "loss_start": at + start if loss else None, "loss_end": at + end if loss else None, "attends": attends})
            self.branch.append((turn, len(self.nodes) - 1))
            self.pieces.append(text)
            self.chars += len(text)
        self.leaves.append({"conv_id": row["conv_id"], "seg": row["seg"], "more": row["more"], "node": self.branch[-1][1]})


def pack_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made():
        pack = Pack()
        for batch in batches:
            for row in batch.to_pylist():
                pack.add(row)
                last = pack.nodes[pack.leaves[-1]["node"]]
                if pack.chars > max(PACK_CHARS, PACK_SHARE * (last["position"] + last["end"] - last["start"] - row["offset"])) or len(pack.leaves) >= 20_000:
                    yield "".join(pack.pieces), pack.nodes, pack.leaves
                    pack = Pack()
        if pack.leaves:
            yield "".join(pack.pieces), pack.nodes, pack.leaves

    yield from batched(made(), PACKS, 4)


def chat_packs(rows: DataFrame) -> DataFrame:
    """Packs of all conversations in rows (conv_id, turn, role, text).

    Turns come in the order of turn, then role and text where that ties; null turns first. A null role or text is empty; rows with
    a null conv_id make one conversation; repeated rows are turns of their own. Extra columns are ignored; no rows, no packs.
    A conversation's turns pass through one task, segment by segment, as each one's place depends on those before it.
    """
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    segments = own.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInArrow(assemble, "conv_id long, seg long, path binary, offset long, more boolean, turns array<struct<role: string, text: string>>")
    return segments.repartitionByRange("path", "conv_id", "seg").sortWithinPartitions("path", "conv_id", "seg").mapInArrow(pack_up, PACKS_DDL)


TOKENS_DDL = "ids array<int>, token_nodes array<struct<parent: long, start: long, end: long, position: long, loss_start: long, loss_end: long, attends: array<struct<start: long, end: long>>>>"


def encoder(tokenizer: str):
    """Adds ids and token_nodes to packs (text, nodes, leaves)."""
    schema = pa.schema([*PACKS, ("ids", pa.list_(pa.int32())), ("token_nodes", pa.list_(NODE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made():
            tokens = None
            for batch in batches:
                for pack in batch.to_pylist():
                    tokens = tokens or word_tokens(tokenizer)
                    text, nodes = pack["text"], pack["nodes"]
                    # Head, text and end of each turn, so that the loss is of whole tokens.
                    cuts = [(n["start"], n["loss_start"], n["loss_end"], n["end"]) if n["loss_start"] is not None else (n["start"], n["end"], n["end"], n["end"]) for n in nodes]
                    pieces = tokens.encode([text[a:b] for c in cuts for a, b in pairwise(c)])
                    ids, own, at = [], [], 0
                    place: dict[int, int] = {}
                    for i, n in enumerate(nodes):
                        head, body, tail = (len(p) for p in pieces[3 * i : 3 * i + 3])
                        size = head + body + tail
                        place[n["start"]], place[n["end"]] = at, at + size
                        above = own[n["parent"]] if n["parent"] >= 0 else None
                        loss = n["loss_start"] is not None
                        own.append({"parent": n["parent"], "start": at, "end": at + size, "position": above["position"] + above["end"] - above["start"] if above else 0, "loss_start": at + head if loss else None, "loss_end": at + head + body if loss else None, "attends": [{"start": place[s["start"]], "end": place[s["end"]]} for s in n["attends"]]})
                        ids += pieces[3 * i : 3 * i + 3]
                        at += size
                    yield text, nodes, pack["leaves"], np.concatenate(ids).astype(np.int32).tolist(), own

        yield from batched(made(), schema, 4)

    return run


def with_tokens(packs: DataFrame, tokenizer: str) -> DataFrame:
    """packs with `ids`, the token ids of all turns in the order of the nodes, and `token_nodes`, the nodes in tokens. Positions count from a segment's first token."""
    return packs.select("text", "nodes", "leaves").mapInArrow(encoder(tokenizer), f"{PACKS_DDL}, {TOKENS_DDL}")


def expand(text: str, nodes: list[dict]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position ids, loss mask and attention matrix (row attends to column) of a pack, one place for each character. For tests and small packs."""
    n = len(text)
    position, loss, attention = np.zeros(n, np.int64), np.zeros(n, bool), np.zeros((n, n), bool)
    for node in nodes:
        a, b = node["start"], node["end"]
        position[a:b] = node["position"] + np.arange(b - a)
        if node["loss_start"] is not None:
            loss[node["loss_start"] : node["loss_end"]] = True
        attention[a:b, a:b] = np.tri(b - a, dtype=bool)
        for s in node["attends"]:
            attention[a:b, s["start"] : s["end"]] = True
    return position, loss, attention


READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("n_packed", pa.int64()), ("seg", pa.int64()), ("more", pa.bool_()), ("all_turns", pa.binary()), ("all_loss", pa.binary())])
READ_DDL = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_packed long, seg long, more boolean, all_turns binary, all_loss binary"


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation's segment in the packs; whole conversations have their digests, pieces of longer ones their bytes."""

    def made():
        for batch in batches:
            for pack in batch.to_pylist():
                text, nodes = pack["text"], pack["nodes"]
                parsed: list[tuple[bytes, bytes, int]] = []
                states: list[tuple] = []
                for node in nodes:
                    role, body = parse_turn(text[node["start"] : node["end"]])
                    loss = unescape(text[node["loss_start"] : node["loss_end"]]) if node["loss_start"] is not None else ""
                    piece = f"{role}\n{body}\n".encode("utf-8", "surrogatepass")
                    lost = loss.encode("utf-8", "surrogatepass")
                    turns, lossy, n, chars, length, depth = states[node["parent"]] if node["parent"] >= 0 else (hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0)
                    turns, lossy = turns.copy(), lossy.copy()
                    turns.update(piece)
                    lossy.update(lost)
                    parsed.append((piece, lost, node["parent"]))
                    states.append((turns, lossy, n + 1, chars + len(loss), length + node["end"] - node["start"], depth + 1))
                for leaf in pack["leaves"]:
                    turns, lossy, n, chars, length, _ = states[leaf["node"]]
                    whole = leaf["seg"] == 0 and not leaf["more"]
                    pieces: list[tuple[bytes, bytes, int]] = []
                    at = leaf["node"]
                    while not whole and at >= 0:
                        pieces.append(parsed[at])
                        at = parsed[at][2]
                    yield (
                        leaf["conv_id"], n, turns.hexdigest() if whole else None, chars, lossy.hexdigest() if whole else None, length, len(pack["leaves"]), leaf["seg"], leaf["more"],
                        None if whole else b"".join(p[0] for p in reversed(pieces)), None if whole else b"".join(p[1] for p in reversed(pieces)),
                    )

    yield from batched(made(), READ)


def join_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole conversations from a stream of their segments, sorted by conversation and segment."""

    def made():
        at: object = object()
        state: list = []

        def done() -> tuple:
            turns, lossy, n, chars, length, packed = state
            return at, n, turns.hexdigest(), chars, lossy.hexdigest(), length, packed, 0, False, None, None

        for batch in batches:
            for row in batch.to_pylist():
                if row["conv_id"] != at:
                    if state:
                        yield done()
                    at, state = row["conv_id"], [hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0]
                state[0].update(row["all_turns"])
                state[1].update(row["all_loss"])
                for i, name in enumerate(("n_turns", "loss_chars", "formatted_chars", "n_packed"), 2):
                    state[i] += row[name]
        if state:
            yield done()

    yield from batched(made(), READ)


def read_chats(packs: DataFrame) -> DataFrame:
    """Each conversation from written packs: its turns and what its loss mask covers, as digests, and the length of its formatted text."""
    rows = materialise(packs.mapInArrow(unpack, READ_DDL), "chats", "zstd")
    whole = rows.filter("seg = 0 and not more")
    longer = rows.filter("seg > 0 or more").repartition("conv_id").sortWithinPartitions("conv_id", "seg").mapInArrow(join_segments, READ_DDL)
    return whole.unionByName(longer).drop("seg", "more", "all_turns", "all_loss")


def format_chats(rows: DataFrame) -> DataFrame:
    """Writes the packs of all conversations to the shared folder and reads them back; see chat_packs for unusual rows."""
    return read_chats(materialise(chat_packs(rows), "packs", "zstd"))
