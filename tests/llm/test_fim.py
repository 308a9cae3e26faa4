import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from delaylab.llm import fim

from .helpers import awkward_rows, same_rows, table


def brute(doc_id, text, seed=1, rate=90, spm=20, marks=fim.SENTINELS):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in marks) or h3 % 100 >= rate:
        return (doc_id, n, "plain", None, None, text)
    p, s, m = marks
    if h4 % 100 < spm:
        return (doc_id, n, "spm", a, b - a, s + text[b:] + p + text[:a] + m + text[a:b])
    return (doc_id, n, "psm", a, b - a, p + text[:a] + s + text[b:] + m + text[a:b])


def rows():
    extra = [(500, "<P>", "en", "a"), (501, "x<S>y", "en", "a"), (502, "<<P", "en", "a"),
             (503, "🙂" * 50, "en", "a"), (504, "a\0b" * 9, "en", "a"), (505, "𝔘é文a" * 7, None, "b"),
             (506, "<S", "en", "a"), (507, "<P<S<M" * 5, "en", "a")]
    return awkward_rows() + extra + [(600 + i, "añ文🙂"[:i % 5], "en", "a") for i in range(40)]


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=200, deadline=None)
def test_rank_and_select_agree_with_decoding(texts):
    whole = "".join(texts)
    data = np.frombuffer(whole.encode("utf-8", "replace"), np.uint8)
    decoded = data.tobytes().decode()
    ends = np.cumsum([0] + [len(c.encode()) for c in decoded])
    index = fim.UnitIndex(data)
    assert index.select(np.arange(len(decoded) + 1)).tolist() == ends.tolist()
    assert index.rank(ends).tolist() == list(range(len(decoded) + 1))


@pytest.mark.parametrize("rate,spm,block", [(90, 20, 4 << 20), (100, 50, 64), (0, 0, 1)])
def test_forms_cuts_and_outputs(spark, monkeypatch, rate, spm, block):
    monkeypatch.setattr(fim, "BLOCK_BYTES", block)
    found = fim.fill_in_middle(table(spark, rows()), rate=rate, spm=spm)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    same_rows([tuple(r) for r in found.collect()],
              [brute(i, t, rate=rate, spm=spm) for i, t, *_ in rows()])


def test_restored_text_is_exact(spark):
    done = fim.fill_in_middle(table(spark, rows()), rate=100, spm=50)
    back = done.select("doc_id", fim.restore(F.col("output"), F.col("form")).alias("t"))
    same_rows([tuple(r) for r in back.collect()], [(i, t or "") for i, t, *_ in rows()])


def test_other_sentinels_and_seed(spark):
    marks = ("[a.", "[b*", "[c+")
    found = fim.fill_in_middle(table(spark, rows()), seed=9, sentinels=marks)
    same_rows([tuple(r) for r in found.collect()],
              [brute(i, t, seed=9, marks=marks) for i, t, *_ in rows()])
    back = found.select("doc_id", fim.restore(F.col("output"), F.col("form"), marks).alias("t"))
    same_rows([tuple(r) for r in back.collect()], [(i, t or "") for i, t, *_ in rows()])


def test_text_of_megabytes(spark):
    text = "é文a🙂 " * 400_000
    docs = spark.createDataFrame([(11, text), (12, "short")], "doc_id long, text string")
    found = {r.doc_id: tuple(r) for r in fim.fill_in_middle(docs, rate=100).collect()}
    assert found == {11: brute(11, text, rate=100), 12: brute(12, "short", rate=100)}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert fim.fill_in_middle(docs).collect() == []


def test_no_shuffle(spark):
    from delaylab.plans.inspect import formatted

    assert "Exchange" not in formatted(fim.fill_in_middle(table(spark, rows()[:3])
                                                          .coalesce(1))).split("RoundRobin")[-1]
