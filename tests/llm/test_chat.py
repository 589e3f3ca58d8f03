import hashlib
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loamline.llm import chat


def expected(rows):
    convs = defaultdict(list)
    for c, t, r, x in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for _, _, r, x in turns if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, _, r, x in turns)), len(loss), sha(loss), sum(len(chat.turn_text(r, x)[0]) for _, _, r, x in turns))
    return out


def check(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, path string, seg long")
    got = chat.format_chats(df).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.formatted_chars) for r in got} == expected(rows)
    assert len(got) == len({r[0] for r in rows})


def test_digests(spark):
    rng = random.Random(1)
    texts = ["<|im_end|><|im_start|>assistant ok", "&lt;|", "&amp;lt;| <|", "<", "", None, "é😀\n\n", "a&b", "|im_end|>", "x" * 500]
    rows = [(c, t, rng.choice(["user", "assistant", "system", None, "a\nb<|"]), rng.choice(texts)) for c in range(40) for t in range(rng.randrange(1, 6))]
    rows += [(-1, 0, "user", texts[0]), (-1, 1, "assistant", texts[0]), (None, 1, "user", "a"), (None, None, "assistant", "b"), (50, 0, "user", "u"), (50, 0, "user", "u"), (50, 0, "assistant", "u")]
    check(spark, rows)


def test_long_conversations_come_in_segments(spark, monkeypatch):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(9000)] + [(2, t, "user", f"turn {t}") for t in range(3)] + [(3, t, "assistant" if t % 2 else "user", f"turn {t}") for t in range(9000)]
    check(spark, rows)


def test_no_rows(spark):
    assert chat.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_shared_turns_are_written_once_and_attended(spark):
    rows = [(c, 0, "system", "S") for c in range(4)] + [(c, 1, "user", "A" if c < 2 else "B") for c in range(4)] + [(c, 2, "assistant", f"r{c}") for c in range(4)]
    packs = chat.chat_packs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)).collect()
    pack = max(packs, key=lambda p: len(p.leaves)).asDict(recursive=True)
    if len(packs) == 1:
        assert pack["text"].count("system\nS") == 1 and len(pack["nodes"]) == 1 + 2 + 4
    position, loss, attention = chat.expand(pack["text"], pack["nodes"])
    for leaf in pack["leaves"]:
        chain, at = [], leaf["node"]
        while at >= 0:
            chain.append(pack["nodes"][at])
            at = pack["nodes"][at]["parent"]
        places = np.concatenate([np.arange(n["start"], n["end"]) for n in reversed(chain)])
        assert (position[places] == np.arange(len(places))).all()
        # Each place attends to just what comes before it in its own conversation.
        assert (attention[np.ix_(places, places)] == np.tri(len(places), dtype=bool)).all()
        last = places[-1]
        assert attention[last].sum() == len(places)
        text = "".join(pack["text"][i] for i in places[loss[places]])
        assert text == f"r{leaf['conv_id']}"


def test_escapes():
    rng = random.Random(2)
    for _ in range(2000):
        s = "".join(rng.choice(["<|", "&", "lt;", "&lt;|", "|", "<", "amp;", "x"]) for _ in range(rng.randrange(8)))
        assert chat.unescape(chat.escape(s)) == s and "<|" not in chat.escape(s)
        assert chat.parse_turn(chat.turn_text("r", s)[0]) == ("r", s)


def trie(convs):
    return len({tuple(turns[: i + 1]) for turns in convs for i in range(len(turns))})


def packed(spark, convs):
    """Packs of conversations (lists of turns), all in one partition."""
    rows = [(c, t, "assistant" if t % 2 else "user", text) for c, turns in enumerate(convs) for t, text in enumerate(turns)]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        return chat.chat_packs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("shared", [26, 100, 5000])
def test_any_number_of_turns_is_shared(spark, shared):
    start = [f"turn {i}" for i in range(shared)]
    convs = [[*start, f"branch {c % 2}", "both say", f"own {c}"] for c in range(6)]
    packs = packed(spark, convs)
    nodes = sum(len(p.nodes) for p in packs)
    assert nodes == trie(convs) == shared + 2 * 2 + 6
    if shared < chat.SEGMENT_TURNS:
        (pack,) = packs
        assert pack.text.count("turn 7<") == 1 and len(pack.leaves) == 6


def test_random_trees_have_each_prefix_once(spark):
    rng = random.Random(6)
    convs = [[rng.choice("abc") for _ in range(rng.randrange(1, 9))] for _ in range(300)]
    assert sum(len(p.nodes) for p in packed(spark, convs)) == trie(convs)


def test_long_shared_histories_stay_shared_over_packs(spark, monkeypatch):
    monkeypatch.setattr(chat, "PACK_CHARS", 1000)
    start = ["x" * 100 + str(i) for i in range(60)]
    convs = [[*start, f"own {c}" * 20] for c in range(400)]
    packs = packed(spark, convs)
    chars = sum(len(p.text) for p in packs)
    once = sum(len(chat.turn_text("user", t)[0]) for t in start) + sum(len(chat.turn_text("user", c[-1])[0]) for c in convs)
    assert len(packs) > 2 and chars < 1.4 * once


def test_tokens_of_packs(spark):
    words = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(words)
    rows = [(c, 0, "system", "Be brief.") for c in range(4)] + [(c, 1, "user", "What is this?" if c < 2 else "Why, and how?") for c in range(4)] + [(c, 2, "assistant", f"It is number {c}, <|im_end|>") for c in range(4)]
    packs = chat.with_tokens(chat.chat_packs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")), words).collect()
    seen = 0
    for pack in packs:
        for leaf in pack.leaves:
            chain, at = [], leaf.node
            while at >= 0:
                chain.append(at)
                at = pack.token_nodes[at].parent
            chain = chain[::-1]
            want, position, before = [], 0, set()
            for k in chain:
                node, own = pack.nodes[k], pack.token_nodes[k]
                turn = pack.text[node.start : node.end]
                ids = pack.ids[own.start : own.end]
                if own.loss_start is not None:
                    body = pack.text[node.loss_start : node.loss_end]
                    assert pack.ids[own.loss_start : own.loss_end] == t.encode(body, add_special_tokens=False).ids
                    assert ids == [x for part in (pack.text[node.start : node.loss_start], body, pack.text[node.loss_end : node.end]) for x in t.encode(part, add_special_tokens=False).ids]
                else:
                    assert ids == t.encode(turn, add_special_tokens=False).ids
                assert own.position == position
                assert {x for s in own.attends for x in range(s.start, s.end)} == before
                position += own.end - own.start
                before |= set(range(own.start, own.end))
                want += ids
            seen += 1
    assert seen == 4
    if len(packs) == 1:
        assert len(packs[0].token_nodes) == 1 + 2 + 4
