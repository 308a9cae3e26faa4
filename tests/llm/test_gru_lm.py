from __future__ import annotations

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from delaylab.llm import gru_lm

from .helpers import awkward_rows, key, table


class Small:
    head, classes, symbols = 130, 3, 130 + gru_lm.TAIL_CLASSES
    head_counts = np.arange(200, 70, -1).astype(float)
    tail_n = np.full(gru_lm.TAIL_CLASSES, 5.0)
    tail_v = np.ones(gru_lm.TAIL_CLASSES)


def small_model():
    model, rng = gru_lm.Model(Small(), 1), np.random.default_rng(0)
    model.p = {k: v + 0.1 * rng.normal(size=v.shape) for k, v in model.p.items()}
    return model, rng


def test_gradient_matches_differences(monkeypatch):
    monkeypatch.setattr(gru_lm, "RATE", 0)
    model, rng = small_model()
    symbols = rng.integers(0, Small.symbols, (6, 3))
    inputs = np.vstack([np.full((1, 3), Small.symbols), symbols[:-1]])
    inputs[3, 1] = Small.symbols
    live = np.ones((6, 3), dtype=bool)
    live[4:, 2] = False
    zero, flat = np.zeros((3, gru_lm.UNITS)), live.reshape(-1)

    def loss():
        h, _ = model.run(inputs, zero)
        return -model.outputs(h.reshape(-1, gru_lm.UNITS)[flat], symbols.reshape(-1)[flat]).sum()

    moments = {}
    model.learn(inputs, symbols, live, zero, moments, 1)
    ratios = []
    for name, p in model.p.items():
        grad, values = moments[name][0].ravel(), p.reshape(-1)
        for i in np.argsort(-np.abs(grad))[:3]:
            old = values[i]
            values[i] = old + 1e-5
            up = loss()
            values[i] = old - 1e-5
            ratios.append((up - loss()) / 2e-5 / grad[i])
            values[i] = old
    assert np.allclose(ratios, ratios[0], rtol=0.05)


def test_outputs_are_a_distribution():
    model, rng = small_model()
    h = rng.normal(size=(1, gru_lm.UNITS))
    total = sum(np.exp(model.outputs(h, np.array([s]))[0]) for s in range(Small.symbols))
    assert abs(total - 1) < 1e-9


def test_state_is_carried_over_windows():
    model, rng = small_model()
    docs = [rng.integers(0, Small.symbols, n) for n in (1, 5, 300, 77, 64, 65)]
    whole = gru_lm.score_sequences(model, docs, window=1000)
    assert np.allclose(whole, gru_lm.score_sequences(model, docs, side=2, window=16), rtol=1e-5)


def expected(rows):
    def tokens(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\n"]

    held = lambda i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2
    counts = Counter(w for r in rows if not held(r[0]) for w in tokens(r[1]))
    n, v = sum(counts.values()), len(counts)
    return [(r[0], held(r[0]), len(tokens(r[1])), sum(counts[w] > 0 for w in tokens(r[1])), n,
             round(sum(log10((counts[w] + 1) / (n + v + 1)) for w in tokens(r[1])), 6))
            for r in rows]


@pytest.mark.parametrize("known, head", [(gru_lm.KNOWN, gru_lm.HEAD), (60, 40)])
def test_base_matches_brute_force(spark, monkeypatch, known, head):
    monkeypatch.setattr(gru_lm, "KNOWN", known)
    monkeypatch.setattr(gru_lm, "HEAD", head)
    rows = awkward_rows()
    got = gru_lm.score_documents(table(spark, rows), sample=0.5, rounds=2, workers=2).collect()
    found = [(*r[:5], round(r.base_score, 6)) for r in got]
    assert sorted(map(key, found)) == sorted(map(key, expected(rows)))
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_model_beats_base_on_held_out_text(spark):
    from pyspark.sql import functions as F

    from delaylab.llm import queries

    got = queries.op9_lm(spark, "/root/testdata/sf0.01").where("held_out").agg(
        F.sum("base_score"), F.sum("score")).first()
    assert got[1] > got[0]


def test_words_of_middle_rank_have_outputs_of_their_own(spark):
    counts = spark.createDataFrame([(i, 9000 - i, i % gru_lm.TAIL_CLASSES) for i in range(4200)],
                                   "w long, c long, tail int")
    vocabulary = gru_lm.Vocabulary(spark, counts)
    assert vocabulary.head == 4096 and len(vocabulary.tail_n) == 64


@pytest.mark.parametrize("merged", [gru_lm.MERGED, 1])
def test_every_training_text_reaches_the_network(spark, monkeypatch, merged):
    from pyspark.sql import functions as F

    monkeypatch.setattr(gru_lm, "MERGED", merged)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(gru_lm.SEED)), F.lit(1 << 20))
    train = (spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a b a b a c").alias("text"))
             .where(draw >= (1 << 20) // 16).limit(8))
    vocabulary = gru_lm.Vocabulary(spark, gru_lm.count_words(train))
    assert np.abs(gru_lm.train_model(train, vocabulary, workers=2).p["ww"]).max() > 0


def test_training_carries_the_state_through_long_texts():
    model, rng = small_model()
    texts, states, starts = [rng.integers(0, Small.symbols, n) for n in (3000, 5, 1500)], [], 0

    def learn(inputs, symbols, live, state, moments, step):
        nonlocal starts
        starts += int((inputs[live] == Small.symbols).sum())
        states.append((inputs[live], symbols[live]))
        return state + 1

    model.learn = learn
    assert gru_lm._epoch(model, texts, {}, 0)[0] == 4505
    assert starts == 3
    assert sorted(np.concatenate([s for _, s in states])) == sorted(np.concatenate(texts))
    assert sorted(np.concatenate([i for i, _ in states])) == sorted(
        np.concatenate([np.r_[Small.symbols, t[:-1]] for t in texts]))


def test_empty_table(spark):
    assert gru_lm.score_documents(table(spark, [])).collect() == []


def test_outputs_far_below_their_bound():
    """Logits whose bound says nothing (huge weights) and those under a close bound: both are the
    plain softmax, in values and gradient."""
    rng = np.random.default_rng(3)
    for size in (0.1, 400.0):
        model, _ = small_model()
        model.p["wc"] = size * rng.normal(size=model.p["wc"].shape)
        model.p["ww"] = size * rng.normal(size=model.p["ww"].shape)
        h = rng.uniform(-1, 1, (2500, gru_lm.UNITS))
        symbols = rng.integers(0, Small.symbols, len(h))
        score, dh, grads = model.outputs(h, symbols, True)
        logits = h @ model.p["wc"] + model.p["bc"]
        logits -= logits.max(axis=1, keepdims=True)
        which, rows = model.classes_of(symbols), np.arange(len(h))
        wanted = logits[rows, which] - np.log(np.exp(logits).sum(axis=1))
        for i in np.flatnonzero(symbols < Small.head):
            words = slice(which[i] * gru_lm.CLASS_WORDS,
                          min((which[i] + 1) * gru_lm.CLASS_WORDS, Small.head))
            inner = model.p["ww"][words] @ h[i] + model.p["bw"][words]
            inner -= inner.max()
            wanted[i] += inner[symbols[i] % gru_lm.CLASS_WORDS] - np.log(np.exp(inner).sum())
        assert np.allclose(score, wanted, atol=1e-6)
        assert np.isfinite(dh).all() and all(np.isfinite(g).all() for g in grads.values())
        assert abs(grads["bc"].sum()) < 1e-6 * len(h)


def test_states_match_the_plain_recurrence():
    """States side by side are those of the cell written out, over gates that saturate as well."""
    model, rng = small_model()
    model.p["u"] = model.p["u"] * 300
    symbols = rng.integers(0, Small.symbols, (9, 4))
    symbols[5, 2] = Small.symbols
    h, _ = model.run(symbols, np.zeros((4, gru_lm.UNITS)))
    n, p = gru_lm.UNITS, model.p
    for j in range(4):
        state = np.zeros(n)
        for t in range(9):
            state = np.zeros(n) if symbols[t, j] == Small.symbols else state
            x, hu = p["embed"][symbols[t, j]] @ p["w"] + p["b"], state @ p["u"]
            z, r = (0.5 + 0.5 * np.tanh(0.5 * (x + hu)[a:a + n]) for a in (0, n))
            new = np.tanh(x[2 * n:] + r * hu[2 * n:])
            state = new + z * (state - new)
            assert np.allclose(h[t, j], state, atol=1e-9)


def test_window_of_uneven_sequences():
    flat, lengths = np.arange(10, 17), np.array([4, 3])
    here, live = gru_lm._window(flat, np.array([0, 4]), lengths, 2, 3)
    assert here.tolist() == [[12, 16], [13, 0], [0, 0]]
    assert live.tolist() == [[True, True], [True, False], [False, False]]


def test_a_long_text_does_not_take_windows_for_itself():
    """One text of 20,000 symbols among 2,000 short ones: few more windows than full ones, every
    symbol trained on after the one before it, in one state."""
    rng, made = np.random.default_rng(2), []
    texts = [rng.integers(0, Small.symbols, n) for n in [*[150] * 1000, 20_000, *[150] * 1000]]
    model, _ = small_model()

    def learn(inputs, symbols, live, state, moments, step):
        made.append(int(live.sum()))
        return state

    model.learn = learn
    total, steps = gru_lm._epoch(model, texts, {}, 0)
    assert total == sum(made) == 320_000 and steps == len(made)
    assert steps <= 250  # 625 when windows were of one length


def test_streams_are_even_and_keep_the_order():
    lengths = np.array([5, 900, 40, 0, 300, 310, 290, 7])
    streams = gru_lm._streams(lengths, 2)
    assert sorted(np.concatenate(streams).tolist()) == list(range(8))
    assert [int(lengths[x].sum()) for x in streams] == [940, 912]
    assert all((np.diff(x) > 0).all() for x in streams)


def test_words_of_a_column_are_those_of_its_texts():
    import pyarrow as pa
    import xxhash

    texts = ["  A b\t\x0bc. ", "", None, "   ", "x\x1cy\x85z\xa0q r!? \xc9..", "\x00 a a?", "\n",
             "a\r\nb  b \xc0Z# #", "..."]
    for column in (pa.array(texts), pa.array(texts).slice(3, 4), pa.array([None, ""]),
                   pa.array([], pa.string())):
        sizes, words, flat = gru_lm.split_words(column)
        wanted = [[*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), gru_lm.END]
                  for t in column.to_pylist()]
        assert sizes.tolist() == [len(w) for w in wanted]
        wanted = sum(wanted, [])
        assert [words[i].as_py().encode() for i in flat.tolist()] == wanted
        hashes, tails = gru_lm.word_hashes(words)[flat], gru_lm.tail_classes(words)[flat]
        assert hashes.tolist() == [xxhash.xxh64_intdigest(w) - (1 << 63) for w in wanted]
        assert tails.tolist() == [gru_lm.tail_class(w) for w in wanted]
