"""Small tables with every awkward kind of row, shared by the tests of this folder."""

from __future__ import annotations

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _id long, "
          "_key string, word string, n double, begin string, label string, pattern string, "
          "hash string, size string, context string, h string, w string")


def awkward_rows(seed: int = 3, n: int = 40) -> list[tuple]:
    """(doc_id, text, lang, source): NULLs in every column, empty and blank texts, one long text,
    ties, repeated rows, copies, near copies and shared passages."""
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("abcdeé") for _ in range(rnd.randrange(2, 8)))
                  for _ in range(300)]

    def prose(k):
        words = [rnd.choice(vocabulary) for _ in range(k)]
        return "".join(w.title() + rnd.choice([" ", ", ", "\n"]) if rnd.random() < 0.2
                       else w + " " for w in words).strip()

    passage = prose(60)
    rows = [(i, prose(rnd.randrange(1, 150)), rnd.choice(["en", "fr", None]),
             rnd.choice(["a", "b", "é", None])) for i in range(n)]
    rows += [(n + 1, None, None, None), (n + 2, "", "en", "a"), (n + 3, " \t\n", "en", "b"),
             (None, prose(70), "en", "a"), (None, None, None, None), (n + 4, "é", None, "a"),
             (n + 5, prose(4000), "en", "b"), (n + 6, "x " * 300, "en", "a"),
             (n + 7, rows[0][1], "en", "b"), rows[1], rows[1],
             (n + 8, rows[2][1] + " tail", "en", "a"), (n + 9, "a" * 900, "en", "b"),
             (n + 10, prose(20) + " " + passage + " " + prose(20), "en", "a"),
             (n + 11, passage + prose(5), "fr", "b"), (n + 12, "Ünïcode  　文字 ok", "en", "b")]
    return rows


def table(spark, rows):
    """Rows as ``documents`` with further columns whose names the operators use themselves."""
    wide = [(i, t, lang, s, None if t is None else len(t), 7, "k", "w", 1.5, *["x"] * 8)
            for i, t, lang, s in rows]
    return spark.createDataFrame(wide, SCHEMA).repartition(3)


def key(row):
    return tuple((x is None, str(x)) for x in row)


def same_rows(found, expected):
    assert sorted(map(key, found)) == sorted(map(key, expected))
