from __future__ import annotations

import random
import re
from collections import Counter
from math import log2

import pytest

from delaylab.llm import fertility

from .helpers import awkward_rows, key, table


def base(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    counts, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            hit |= {i, i + 1, i + 2}
    failed = len(words) < 50 or 100 * len(hit) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(hit), failed)


def test_base_counts_and_measures(spark):
    rows = awkward_rows() + [(900, "#a *b $% &|<> <>\nb\nb\n \nb", "en", "a")]
    got = fertility.quality_rules(table(spark, rows)).collect()
    assert sorted((key((r.doc_id,)), r[1:7]) for r in got) == sorted(
        (key((r[0],)), base(r[1])) for r in rows)
    model = fertility.Fertility(fertility.VOCABULARY).model
    texts = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id is None:
            continue
        words = re.findall(r"[^\x20\x09-\x0D]+", texts[r.doc_id] or "")
        tokens = [t for w in words for t in model.encode_ordinary(" " + w)]
        assert r.n_tokens == len(tokens)
        if tokens:
            share = [n / len(tokens) for n in Counter(tokens).values()]
            most = log2(len(tokens)) or 1.0
            bits = -sum(p * log2(p) for p in share) / most if len(tokens) > 1 else 1.0
            assert abs(r.entropy - bits) < 1e-9
            assert abs(r.chars_per_token - sum(map(len, words)) / len(tokens)) < 1e-9
            broken = sum(b"\xef\xbf\xbd" in model.decode([t]).encode() for t in tokens)
            assert abs(r.byte_share - broken / len(tokens)) < 1e-9


def test_bands_reject_symbol_junk_and_keep_prose(spark):
    rows = [r for r in awkward_rows(n=200) if r[0] is not None and r[0] < 200]
    prose = [(i, " ".join([t] * 1), "en", s) for i, t, _, s in rows if len((t or "").split()) > 60]
    junk = [(1000 + i, " ".join(f"{w}{'#$%&'[k % 4] * 3}" for k, w in enumerate(t.split())), "en",
             s) for i, t, _, s in prose[:6]]
    got = {r.doc_id: r for r in fertility.quality_rules(table(spark, prose + junk)).collect()}
    kept = [got[i].kept for i, *_ in prose if not got[i].base_failed]
    assert sum(kept) >= 0.97 * len(kept)
    assert not any(got[i].kept for i, *_ in junk)


@pytest.mark.parametrize("near", [False, True])
@pytest.mark.parametrize("at", [0, 3, 7])
def test_copies_of_one_document_do_not_move_the_bands(spark, near, at):
    rnd = random.Random(at)
    words = {lang: ["".join(rnd.choice(letters) for _ in range(rnd.randrange(2, 9)))
                    for _ in range(400)] for lang, letters in (("en", "abcdehilnorst"),
                                                               ("fr", "aeéinrstuàl"))}
    prose = lambda lang: [rnd.choice(words[lang]) for _ in range(rnd.randrange(60, 200))]
    clean = [(i, prose("en" if i < 160 else "fr")) for i in range(200)]
    copies = []
    for k in range(100):
        text = list(clean[160 + at][1])
        if near:
            for _ in range(2):
                text[rnd.randrange(len(text))] = rnd.choice(words["fr"])
        copies.append((1000 + k, text))
    rows = [(i, " ".join(t), "en" if i < 160 else "fr", "a") for i, t in clean + copies]
    kept = {r.doc_id: r.kept for r in fertility.quality_rules(table(spark, rows)).collect()}
    assert sum(kept[i] for i in range(160, 200)) >= 38
    assert sum(kept[i] for i in range(160)) >= 152


def test_script_and_empty_table(spark):
    assert fertility.script("слово one".encode()) == "cyrillic"
    assert fertility.script(b"123 #") == ""
    assert fertility.quality_rules(table(spark, [])).collect() == []
