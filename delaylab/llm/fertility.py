"""Quality rules by tokeniser fertility.

A public byte-level vocabulary for many languages is applied to every word of a text: characters per token,
the share of tokens that are single bytes of a character, and the entropy of the tokens show text that the vocabulary was
not made for (symbol runs, shouting, keyboard noise) without any labels. What is usual differs
between languages and scripts, so the bands of rejection are taken from the corpus itself: per
language (or, where none is given, script), quartiles over its different documents, widened by a
multiple of their distance, wider for short texts. Copies and near copies count once: of the rows
of a band that agree in the smallest hash of their token runs one is taken, and of those again
under a second and a third hash, so that a group of copies of any size cannot move the quartiles.
Words are tokenised one by one, so a word's tokens are computed once
per task and looked up afterwards.
"""

from __future__ import annotations

from base64 import b64decode
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators._plan import MAX_BROADCAST_BYTES, measured_bytes
from ._common import cut, pieces, process_cache, release, texts

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Bytes that a task spends on remembered words and their tokens; beyond them it starts anew.
REMEMBERED_BYTES = 16 << 20
#: Bytes of text taken out of an Arrow batch at a time.
BLOCK_BYTES = 4 << 20
# Fixed value: how this vocabulary's texts are split before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Widths of the bands below and above the quartiles, in quartile distances; a text of this many
#: tokens gets bands wider by the square root of two, as its measures scatter more.
FENCE = (2.0, 4.0)
SHORT = 100
#: Tokens in a run whose hash may be a text's smallest.
RUN = 5
# Odd multipliers of a 64-bit mixing function, and one salt per hash.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
SALTS = (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)
# Fixed value: symbol characters of the base rules.
SYMBOLS = b"#*$%&|<>"
# First code points of blocks and the script they begin ("" for no letters).
BLOCKS = [(0, ""), (0x41, "latin"), (0x5B, ""), (0x61, "latin"), (0x7B, ""), (0xC0, "latin"),
          (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"),
          (0x600, "arabic"), (0x780, "other"), (0x900, "indic"), (0xE00, "thai"),
          (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"),
          (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, ""), (0x2E80, "han"), (0x3000, ""),
          (0x3040, "kana"), (0x3100, "han"), (0xA000, "other"), (0xAC00, "hangul"),
          (0xD7B0, ""), (0xF900, "han"), (0xFB00, "other"), (0x10000, "other"),
          (0x1F000, ""), (0x20000, "han"), (0xE0000, "")]
MEASURES = ("chars_per_token", "byte_share", "entropy")
SKETCHES = ("_run0", "_run1", "_run2")


def script(text: bytes) -> str:
    """Script of most letters of a text, "" without letters (ties: the one that sorts first)."""
    codes = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), dtype="<u4")
    at = np.searchsorted(np.array([b for b, _ in BLOCKS]), codes, side="right") - 1
    counts: dict[str, int] = {}
    for i, n in enumerate(np.bincount(at, minlength=len(BLOCKS))):
        if n and BLOCKS[i][1]:
            counts[BLOCKS[i][1]] = counts.get(BLOCKS[i][1], 0) + int(n)
    return max(sorted(counts), key=counts.get, default="")


def repeated_words(words: list) -> int:
    """Words inside three-word windows that are found twice or more."""
    n = len(words) - 2
    if n < 2:
        return 0
    index: dict = {}
    ids = np.array([index.setdefault(w, len(index)) for w in words], dtype=np.int64)
    size = len(index)
    pairs = np.unique(ids[:-1] * size + ids[1:], return_inverse=True)[1]
    _, which, counts = np.unique(pairs[:-1] * size + ids[2:], return_inverse=True,
                                 return_counts=True)
    again = counts[which] > 1
    hit = np.zeros(len(words), dtype=bool)
    for k in range(3):
        hit[k:k + n] |= again
    return int(hit.sum())


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.split()]
    return len(lines) - len(set(lines))


def _broken(piece: bytes) -> bool:
    """Whether the bytes are not whole characters."""
    try:
        piece.decode("utf-8")
        return False
    except UnicodeDecodeError:
        return True


def sketches(tokens: np.ndarray) -> list[int]:
    """Smallest hash of the runs of ``RUN`` tokens under each salt (as signed longs): texts that
    share most of their runs share most of these."""
    ids, (a, b, c) = tokens.astype(np.uint64), map(np.uint64, MIX)
    width = min(RUN, len(ids))
    n = len(ids) - width + 1
    h = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        h = (h ^ ids[k:k + n]) * a
        h ^= h >> np.uint64(29)
    out = []
    for salt in SALTS:
        x = (h ^ np.uint64(salt)) * b
        x = (x ^ (x >> np.uint64(32))) * c
        out.append(int(x.min().view(np.int64)))
    return out


class Fertility:
    """Token counts of words under one vocabulary; ``lookup`` maps words to token ids."""

    def __init__(self, path: str):
        from tiktoken import Encoding

        with open(path, "rb") as lines:
            ranks = {b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.model = Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks,
                              special_tokens={})
        self.size = max(ranks.values()) + 1
        self.is_byte = np.zeros(self.size, dtype=bool)
        self.is_byte[[i for piece, i in ranks.items()
                      if not piece.isascii() and _broken(piece)]] = True
        self.known: dict[bytes, np.ndarray] = {}
        self.held = 0

    def parts(self) -> tuple:
        """What is the same in every task."""
        return self.model, self.size, self.is_byte

    @classmethod
    def of(cls, parts: tuple) -> "Fertility":
        """A vocabulary from its parts, with an empty memory of words."""
        out = cls.__new__(cls)
        out.model, out.size, out.is_byte = parts
        out.known, out.held = {}, 0
        return out

    def lookup(self, words: list[bytes]) -> list[np.ndarray]:
        known, out = self.known, []
        for w in words:
            tokens = known.get(w)
            if tokens is None:
                tokens = np.array(self.model.encode_ordinary(" " + w.decode("utf-8", "replace")),
                                  dtype=np.int32)
                size = len(w) + tokens.nbytes + 250  # objects and their place in the table
                if self.held + size > REMEMBERED_BYTES:
                    known.clear()
                    self.held = 0
                if size <= REMEMBERED_BYTES // 16:
                    known[w] = tokens
                    self.held += size
            out.append(tokens)
        return out

    def measure(self, words: list[bytes], chars: int) -> tuple:
        """n_tokens, characters per token, share of byte tokens, token entropy relative to that of
        as many different tokens, and sketches; NULL-free zeros for a text without tokens."""
        flat = np.concatenate([np.zeros(0, dtype=np.int32), *self.lookup(words)])
        if not len(flat):
            return 0, 0.0, 0.0, 0.0, *[0] * len(SALTS)
        ids, counts = np.unique(flat, return_counts=True)
        n = len(flat)
        share = counts / n
        bits = float(-(share * np.log2(share)).sum())
        most = log2(min(n, self.size))
        return (n, chars / n, float(counts[self.is_byte[ids]].sum() / n),
                bits / most if most else 1.0, *sketches(flat))


def fertility_of(path: str) -> Fertility:
    """The vocabulary of a file, loaded once per worker process."""
    cache = process_cache()
    if ("fertility", path) not in cache:
        cache["fertility", path] = Fertility(path).parts()
    return Fertility.of(cache["fertility", path])


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str | None = "lang", vocabulary: str = VOCABULARY) -> DataFrame:
    """Base counts and token measures, one row per row of ``docs``, with the ``band`` (language,
    else script) it is judged in."""
    lang = F.col(lang_col) if lang_col else F.lit(None).cast("string")
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                         lang.cast("string").alias("lang"), F.xxhash64(text_col).alias("_key"))
    kind = source.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tokens = fertility_of(vocabulary)
        for batch in (part for b in batches for part in pieces(b, 1, BLOCK_BYTES)):
            rows = []
            for text, lang in zip(texts(batch.column(1)), batch.column(2).to_pylist()):
                words = text.split()
                body = b"".join(words)
                chars = len(body) - sum(map(body.count, CONTINUATION)) if not body.isascii() \
                    else len(body)
                rows.append((len(words), chars, sum(map(text.count, SYMBOLS_EACH)),
                             duplicate_lines(text), repeated_words(words),
                             *tokens.measure(words, chars), lang or "script " + script(text)))
            columns = list(zip(*rows)) if rows else [()] * len(KINDS)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(3),
                 *[pa.array(c, type=t) for c, (_, t, _) in zip(columns, KINDS)]],
                ["doc_id", "_key", *[n for n, _, _ in KINDS]])
        release()

    return source.mapInArrow(run, f"doc_id {kind}, _key long, "
                             + ", ".join(f"{n} {t}" for n, _, t in KINDS))


KINDS = [("n_words", pa.int64(), "long"), ("word_chars", pa.int64(), "long"),
         ("n_symbols", pa.int64(), "long"), ("n_dup_lines", pa.int64(), "long"),
         ("n_repeat_words", pa.int64(), "long"), ("n_tokens", pa.int64(), "long"),
         ("chars_per_token", pa.float64(), "double"), ("byte_share", pa.float64(), "double"),
         ("entropy", pa.float64(), "double"), *[(name, pa.int64(), "long") for name in SKETCHES],
         ("band", pa.string(), "string")]
SYMBOLS_EACH = [bytes([b]) for b in SYMBOLS]
CONTINUATION = [bytes([b]) for b in range(0x80, 0xC0)]


def bands(measured: DataFrame) -> DataFrame:
    """Quartiles of each measure per language or script, over its different documents that pass
    the base rules: a group of copies or near copies counts as one, the text with the smallest
    key."""
    rows, aggregates = measured.where("not base_failed"), []
    for i, name in enumerate(SKETCHES):
        first = F.min(F.struct("_key", *MEASURES, *SKETCHES[i + 1:]))
        rows = rows.groupBy("band", name).agg(first.alias("_first")).select("band", "_first.*")
    for name in MEASURES:
        q = F.percentile_approx(name, [0.25, 0.75], 10_000)
        aggregates += [q[0].alias(f"{name}_q1"), q[1].alias(f"{name}_q3")]
    return rows.groupBy(F.col("band").alias("_band")).agg(*aggregates)


#: Narrower quartile distances count as this much, so that uniform corpora keep a band.
LEAST_WIDTH = {"chars_per_token": 0.05, "byte_share": 0.005, "entropy": 0.005}


def _inside(fence: tuple[float, float]) -> Column:
    ok, scatter = F.lit(True), F.sqrt(1 + SHORT / F.greatest("n_tokens", F.lit(1)))
    for name in MEASURES:
        q1, q3 = F.col(f"{name}_q1"), F.col(f"{name}_q3")
        width = F.greatest(q3 - q1, F.lit(LEAST_WIDTH[name])) * scatter
        ok = ok & F.col(name).between(q1 - fence[0] * width, q3 + fence[1] * width)
    return F.coalesce(ok, F.lit(True))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  lang_col: str | None = "lang", vocabulary: str = VOCABULARY,
                  fence: tuple[float, float] = FENCE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    then n_tokens, chars_per_token, byte_share, entropy, band and _key: one row per row of
    ``docs``.

    NULL and empty texts have no words and fail the base rules; rows without a language are
    judged by script; a band none of whose documents passes the base rules rejects nothing by
    itself; repeated rows are repeated in the result; an empty table gives an empty result;
    other columns are not read.
    """
    measured = measures(docs, id_col, text_col, lang_col, vocabulary).withColumn(
        "base_failed", (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))
    measured = cut(measured)
    limits = cut(bands(measured))
    if measured_bytes(limits) <= MAX_BROADCAST_BYTES:
        limits = F.broadcast(limits)
    judged = measured.join(limits, F.col("band") == F.col("_band"), "left")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", (~F.col("base_failed") & _inside(fence)).alias("kept"),
        "n_tokens", "chars_per_token", "byte_share", "entropy", "band", "_key")
