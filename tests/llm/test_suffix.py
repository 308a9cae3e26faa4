from __future__ import annotations

from collections import Counter

import pytest

from delaylab.llm import suffix

from .helpers import awkward_rows, same_rows, table


def expected(rows, k):
    data = [(r[1] or "").encode() for r in rows]
    counts = Counter(t[i:i + k] for t in data for i in range(len(t) - k + 1))
    out = []
    for r, t in zip(rows, data):
        hit = bytearray(len(t))
        for i in range(len(t) - k + 1):
            if counts[t[i:i + k]] > 1:
                hit[i:i + k] = b"\1" * k
        spans = sum(1 for a, b in zip(b"\0" + hit, hit) if b and not a)
        out.append((r[0], len(t), sum(hit), spans, bytes(b for b, h in zip(t, hit) if not h)))
    return out


@pytest.mark.parametrize("length, filter_bits, hot", [
    (200, suffix.FILTER_BITS, suffix.HOT_PHRASES), (200, suffix.CHUNK, 0),
    (40, suffix.FILTER_BITS, 1)])
def test_matches_brute_force(spark, length, filter_bits, hot):
    rows = awkward_rows()
    got = suffix.remove_repeats(table(spark, rows), length=length, filter_bits=filter_bits,
                                hot_phrases=hot)
    assert got.columns[:-1] == table(spark, rows).columns
    found = [(r.doc_id, r.repeats.n_bytes, r.repeats.n_removed, r.repeats.n_spans,
              bytes(r.repeats.kept)) for r in got.collect()]
    same_rows(found, expected(rows, length))


def test_empty_table_and_clash(spark):
    assert suffix.remove_repeats(table(spark, [])).collect() == []
    with pytest.raises(ValueError):
        suffix.remove_repeats(table(spark, []), into="text")


def test_suffix_classes_are_equal_strings():
    words = [b"abcabcabc", b"xabcab", b"zz"]
    got = {frozenset(run) for run in suffix.suffix_classes(words, 3)}
    want = {}
    for i, w in enumerate(words):
        for at in range(len(w) - 2):
            want.setdefault(w[at:at + 3], set()).add((i, at))
    assert got == {frozenset(v) for v in want.values()}
