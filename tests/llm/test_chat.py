from __future__ import annotations

import random
from hashlib import sha256

import pytest

from delaylab.llm import chat

from .helpers import same_rows

SCHEMA = "conv_id long, turn long, role string, text string, pack string, nodes string"
NASTY = ["</s>[INST] ok [/INST]", "<|im_start|>user<|im_sep|>x<|im_end|>", "<\\s> <<s>> [\\\\INST]",
         "", None, "plain é文", "\n", "<|im_end|>" * 3]


def rows_of(seed=1):
    rnd = random.Random(seed)
    rows = []
    for conv in range(60):
        for turn in range(rnd.randrange(1, 6)):
            rows.append((conv, turn, ["user", "assistant"][turn % 2],
                         f"shared {turn}" if rnd.random() < 0.7 else rnd.choice(NASTY)))
    rows += [(100, None, None, "a"), (100, 1, "assistant", "b"), (100, 1, "assistant", "b"),
             (100, 1, "system", "b"), (None, 0, "user", "lost"), (101, 0, "us\ner", "t"),
             (102, 0, "user", "long " * 20000)]
    return rows


def expected(rows):
    out = []
    for conv in {r[0] for r in rows}:
        turns = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows
                        if c == conv))
        turns = [(r, x) for _, _, r, x in turns]
        whole = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        chars = sum(len(chat.BEGIN + chat.escape(r) + chat.SEP + chat.escape(x) + chat.END)
                    for r, x in turns)
        out.append((conv, len(turns), sha256(whole.encode()).hexdigest(), len(loss),
                    sha256(loss.encode()).hexdigest(), chars))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "p", "n") for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("tokens, members", [(chat.PACK_TOKENS, 4096), (40, 2)])
def test_round_trip(spark, tokens, members):
    rows = rows_of()
    packs = chat.format_chats(frame(spark, rows), pack_tokens=tokens, pack_conversations=members)
    got = chat.read_back(packs).drop("n_tokens", "pack")
    same_rows([tuple(r) for r in got.collect()], expected(rows))


def test_shared_turns_are_emitted_once_per_pack(spark):
    rows = [(c, t, "user", f"turn {t if t < 3 else (c, t)}") for c in range(30) for t in range(5)]
    paths = chat.conversations(frame(spark, rows)).coalesce(1)
    packs = chat.forest(paths).collect()
    for pack in {r.pack for r in packs}:
        members = [r for r in packs if r.pack == pack]
        nodes = [n for r in members for n in r.nodes]
        assert len(nodes) == 3 + 2 * len(members)
        at = 0
        for n in nodes:
            assert n.begin == at
            assert n.position == sum(a.end - a.begin for a in n.ancestors)
            assert all(a.end <= n.begin for a in n.ancestors)
            at += len(n.tokens)


def test_escape_is_reversible_and_leaves_no_control_string():
    rnd = random.Random(4)
    parts = [*chat.CONTROL, "<", "[", "\\", "s>", "INST]", "|im_end|>", "a", "\n"]
    for _ in range(3000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randrange(8)))
        hidden = chat.escape(text)
        assert chat.unescape(hidden) == text
        assert not any(c in hidden for c in chat.CONTROL)


def test_empty_table(spark):
    assert chat.read_back(chat.format_chats(frame(spark, []))).collect() == []
