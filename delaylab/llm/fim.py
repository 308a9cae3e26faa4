"""Fill-in-middle transformation by select over words of UTF-8 bytes.

A slice of an Arrow batch is read as 64-bit words. Bytes that end a code point are marked with a
few arithmetic operations on whole words, ``bitwise_count`` gives the marks of every word, and
their running sum is searched for the word that holds a wanted code point; its byte follows from
the prefix sums inside that one word. All cuts of a slice are found together, however long its
texts are, and no text is decoded. Rows stay where they lie: there is no shuffle.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import pieces

#: Prefix, suffix and middle sentinels.
SENTINELS = ("<P>", "<S>", "<M>")
#: Bytes of text taken out of an Arrow batch at a time.
BLOCK_BYTES = 4 << 20

_ONES = np.uint64(0x0101010101010101)
_HIGH = np.uint64(0x8080808080808080)
_TOP = np.uint64(0x80)


def unit_ends(words: np.ndarray) -> np.ndarray:
    """The high bit of every byte after which a code point ends. A byte ends one if the next byte
    is no continuation byte (10xxxxxx); what follows the last word counts as none."""
    starts = (words & ~(words << np.uint64(1)) & _HIGH) ^ _HIGH
    after = np.append(starts[1:], _HIGH) & _TOP
    return (starts >> np.uint64(8)) | (after << np.uint64(56))


class UnitIndex:
    """Rank and select of code points over one run of UTF-8 bytes."""

    def __init__(self, data: np.ndarray):
        padded = np.zeros(len(data) // 8 + 1, dtype="<u8")
        padded.view(np.uint8)[:len(data)] = data
        self.marks = unit_ends(padded)
        self.sums = np.zeros(len(padded) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.marks), out=self.sums[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Code points that end before each byte offset."""
        word, inside = at >> 3, (at & 7).astype(np.uint64) * np.uint64(8)
        below = self.marks[word] & ((np.uint64(1) << inside) - np.uint64(1))
        return self.sums[word] + np.bitwise_count(below)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """Byte offset just after the ``nth`` code point (from 1; 0 gives 0)."""
        word = np.maximum(np.searchsorted(self.sums, nth, side="left") - 1, 0)
        wanted = np.maximum(nth - self.sums[word], 1).astype(np.uint64)
        counts = (self.marks[word] >> np.uint64(7)) * _ONES  # marks up to and with each byte
        reached = ((counts | _HIGH) - wanted * _ONES) & _HIGH
        return np.where(nth > 0, 8 * word + 9 - np.bitwise_count(reached), 0)


def _spans(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the offsets of its texts in them (NULL: empty)."""
    whole = column.fill_null("").cast(pa.large_binary())
    _, offsets, data = whole.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[whole.offset:whole.offset + len(whole) + 1]
    size = int(at[-1] - at[0])
    body = np.frombuffer(data, np.uint8, size, int(at[0])) if size else np.zeros(0, np.uint8)
    return body, at - at[0]


def _transform(part: pa.RecordBatch, rate: int, spm: int, sentinels: tuple) -> pa.RecordBatch:
    body, at = _spans(part.column(1))
    index = UnitIndex(body)
    ends = index.rank(at)
    n = np.diff(ends)
    h = [part.column(i).to_numpy() for i in (2, 3, 4, 5)]
    a, b = h[0] % (n + 1), h[1] % (n + 1)
    first, last = np.minimum(a, b), np.maximum(a, b)
    # a cut before the first unit of a text is the text's own start
    cut1 = np.where(first > 0, index.select(ends[:-1] + first), at[:-1])
    cut2 = np.where(last > 0, index.select(ends[:-1] + last), at[:-1])
    marks = [s.encode() for s in sentinels]
    p, s, m = marks
    raw, forms, out = body.tobytes(), [], []
    drawn = (n > 0) & (h[2] % 100 < rate)
    swapped = h[3] % 100 < spm
    for i, (x, c, d, y) in enumerate(zip(at[:-1].tolist(), cut1.tolist(), cut2.tolist(),
                                         at[1:].tolist())):
        text = raw[x:y]
        if not drawn[i] or any(mark in text for mark in marks):
            forms.append("plain")
            out.append(text)
        elif swapped[i]:
            forms.append("spm")
            out.append(b"".join((s, raw[d:y], p, raw[x:c], m, raw[c:d])))
        else:
            forms.append("psm")
            out.append(b"".join((p, raw[x:c], s, raw[d:y], m, raw[c:d])))
    plain = np.array([f == "plain" for f in forms], dtype=bool)
    return pa.RecordBatch.from_arrays(
        [part.column(0), pa.array(n), pa.array(forms, pa.string()),
         pa.array(first, pa.int64(), mask=plain), pa.array(last - first, pa.int64(), mask=plain),
         pa.array(out, pa.binary()).cast(pa.string())],
        ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers: the first four groups of eight hex digits of the SHA-256 of
    the seed, a colon and the id in decimal (a NULL id: nothing)."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(named, 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
                   rate: int = 90, spm: int = 20,
                   sentinels: tuple[str, str, str] = SENTINELS) -> DataFrame:
    """doc_id, n (code points), form, prefix_chars, middle_chars, output: one row per row of
    ``docs``.

    Of 100 texts about ``rate`` are cut in three at two code points drawn from their id and
    written as prefix, suffix, middle (``psm``) or, ``spm`` of 100, as suffix, prefix, middle.
    All others, empty and NULL texts and texts that hold a sentinel are ``plain``: the output is
    the text (NULL: empty), prefix_chars and middle_chars are NULL. Rows with equal ids draw alike;
    a NULL id draws as an empty one; repeated rows are repeated in the result; an empty table
    gives an empty result. Other columns of ``docs`` are not read. ``sentinels`` are three
    different strings none of which starts inside another.
    """
    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1, BLOCK_BYTES):
                yield _transform(part, rate, spm, sentinels)

    drawn = [h.alias(f"h{i}") for i, h in enumerate(draws(F.col(id_col), seed))]
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *drawn)
    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, "
                                  "middle_chars long, output string")


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The exact text behind an output. Where the form is not plain the text holds no sentinel, so
    the output splits into nothing and its three parts."""
    parts = F.split(output, "|".join(re.escape(s) for s in sentinels), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
