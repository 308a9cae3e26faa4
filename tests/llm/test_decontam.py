from __future__ import annotations

import re
from hashlib import sha256

import pytest

from delaylab.llm import decontam

from .helpers import awkward_rows, same_rows, table

ITEM_SCHEMA = "item_id long, text string, body string, word string"


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(rows, items, k=13):
    windows = []
    for item, text in items:
        w = words(text)
        windows += [(item, w[i:i + k]) for i in range(max(1, len(w) - k + 1)) if w]
    out = []
    for doc, text, *_ in rows:
        w, hit, found = words(text), set(), set()
        for item, x in windows:
            for i in range(len(w) - len(x) + 1):
                if w[i:i + len(x)] == x:
                    hit |= set(range(i, i + len(x)))
                    found.add(item)
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), sha256(",".join(ids).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def items_of(rows):
    w = rows[3][1].split()
    return [(1, rows[0][1]), (2, " ".join(w[5:25]).upper()), (2, "other words here"),
            (3, rows[4][1][:30]), (4, None), (5, ""), (6, "!!"), (None, rows[5][1]),
            (7, "x"), (8, "x"), (8, "x"), (9, "a" * 900), (10, "x " * 40)]


@pytest.mark.parametrize("limit", [decontam.MAX_BROADCAST_BYTES, 0])
def test_matches_brute_force(spark, limit):
    rows = awkward_rows()
    items = spark.createDataFrame([(*i, "b", "w") for i in items_of(rows)], ITEM_SCHEMA)
    got = decontam.decontaminate(table(spark, rows), items, max_broadcast_bytes=limit)
    same_rows([tuple(r) for r in got.drop("_key").collect()], expected(rows, items_of(rows)))


def test_empty_tables(spark):
    rows = awkward_rows()
    none = spark.createDataFrame([], ITEM_SCHEMA)
    got = decontam.decontaminate(table(spark, rows), none).drop("_key").collect()
    same_rows([tuple(r) for r in got], expected(rows, []))
    items = spark.createDataFrame([(1, "a b", "b", "w")], ITEM_SCHEMA)
    assert decontam.decontaminate(table(spark, []), items).collect() == []


def test_main_path_is_native(spark):
    items = spark.createDataFrame([(1, "a b", "b", "w")], ITEM_SCHEMA)
    plan = decontam.decontaminate(table(spark, awkward_rows()), items)
    text = plan._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", text)
