"""Toxicity by maximum-scoring segments.

Tokens are words and their beginnings (inflected words share a stem). They are scored by the
log-odds of their use in toxic and in other training texts under an informative Dirichlet prior
(their frequencies in all of these), so rare tokens move little. Clearly toxic tokens form the
lexicon and a word scores as the highest of its tokens in it; all other words share one small
negative score, which makes the expected score of clean text negative. A word counts once per
text in training, so repetition within a text weighs nothing. A linear scan finds every maximal scoring segment of a
text; by extreme-value theory the best segment of n clean words exceeds s with probability
1 - exp(-K n exp(-lambda s)), with lambda and K fitted on clean training texts. Segments above
their expected maximum are summed and a logistic curve turns the sum into a score.
"""

from __future__ import annotations

import re
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators._plan import MAX_BROADCAST_BYTES, measured_bytes
from ._common import LOWER_BYTES, crc_mod, cut, seeded_rows, texts
from .decontam import words

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Lengths of the beginnings of words that are tokens.
STEMS = range(4, 9)
#: Words whose score a task remembers; beyond it the memory starts anew.
REMEMBERED = 1_000_000
#: Weight of the prior, as a share of all training counts.
PRIOR = 0.05
#: Least significance of a lexicon token (root of twice its log-likelihood ratio).
MIN_Z = 4.5
#: Texts used to fit the three curves (lambda and K, the logistic's two numbers).
FIT_ROWS = 50_000
THRESHOLD = 0.3
SEED = 17


def segments(positions, scores, gap: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, last word, score) of a word sequence in which the
    words at ``positions`` score ``scores`` and all others ``gap`` < 0, in linear time."""
    stack: list[list] = []  # first, last, total before it, total up to its end, earlier lower one
    total, previous = 0.0, -1
    for at, score in zip(positions, scores):
        total += gap * (at - previous - 1)
        previous = at
        if score <= 0:
            total += score
            continue
        part, k = [at, at, total, total + score], len(stack) - 1
        total += score
        while True:
            while k >= 0 and stack[k][2] >= part[2]:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= part[3]:
                stack.append([*part, k])
                break
            part = [stack[k][0], part[1], stack[k][2], part[3]]
            earlier = stack[k][4]
            del stack[k:]
            k = earlier
    return [(a, b, end - begin) for a, b, begin, end, _ in stack]


def _labelled(docs: DataFrame, labels: DataFrame, label_col: str, train) -> DataFrame:
    """Texts with a training label, one row per distinct text: labels are attached to ids, and a
    text that was labelled twice counts as toxic if it was once."""
    marks = (labels.where(F.col(label_col).isNotNull()).where(train(F.col("doc_id")))
             .groupBy(F.col("doc_id").alias("_id")).agg(F.max(label_col).alias("label")))
    marks = cut(marks)
    if measured_bytes(marks) <= MAX_BROADCAST_BYTES:
        marks = F.broadcast(marks)
    keyed = docs.select(F.col("doc_id").alias("_id"), "text",
                        F.xxhash64("text").alias("_key")).join(marks, "_id")
    first = cut(keyed.groupBy("_key").agg(F.min("_id").alias("_first"),
                                          F.max("label").alias("label")))
    if measured_bytes(first) <= MAX_BROADCAST_BYTES:
        first = F.broadcast(first)
    keyed = keyed.drop("label").join(first, "_key")
    return (keyed.where("_id = _first").dropDuplicates(["_key"])
            .select("_id", "text", "label"))


def word_tokens(word: str) -> list[str]:
    """A word and its beginnings, these marked by a character that no word has."""
    return [word, *(word[:n] + "*" for n in STEMS if n <= len(word))]


def lexicon(train: DataFrame, min_z: float = MIN_Z):
    """({token: score}, score of all other words) from ``train(text, label)``. Every token of
    significance ``min_z`` or more is in the lexicon; one that is too large for every task to hold
    is an error (raise ``min_z``), never cut."""
    counts = cut(train.select(F.explode(F.array_distinct(words(F.col("text")))).alias("word"),
                              "label")
                 .groupBy("word").agg(F.sum(F.col("label").cast("long")).alias("y1"),
                                      F.count(F.lit(1)).alias("y")))
    n1, n = (x or 0 for x in counts.agg(F.sum("y1"), F.sum("y")).first())
    if not n1 or n1 == n:
        return {}, -0.01
    stems = [F.when(F.length("word") >= k, F.concat(F.substring("word", 1, k), F.lit("*")))
             for k in STEMS]
    parts = counts.select("word", "y1", "y", F.explode(
        F.array_compact(F.array(F.col("word"), *stems))).alias("token"))
    tokens = parts.groupBy("token").agg(F.sum("y1").alias("y1"), F.sum("y").alias("y"))
    n0, a0 = n - n1, PRIOR * n
    a = F.lit(a0) * F.col("y") / F.lit(n)
    in1, in0 = F.col("y1") + a, F.col("y") - F.col("y1") + a
    odds = (F.log(in1 / (F.lit(n1 + a0) - in1)) - F.log(in0 / (F.lit(n0 + a0) - in0)))
    y0, share = F.col("y") - F.col("y1"), n1 / n

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    gain = part(F.col("y1"), F.col("y") * share) + part(y0, F.col("y") * (1 - share))
    top = cut(tokens.withColumn("odds", odds)
              .where(F.col("y1") > F.col("y") * share)
              .withColumn("z", F.sqrt(F.greatest(2 * gain, F.lit(0.0))))
              .where(F.col("z") >= min_z).select("token", "odds"))
    if measured_bytes(top) > MAX_BROADCAST_BYTES:
        raise ValueError(f"the lexicon has more than {MAX_BROADCAST_BYTES} bytes: raise min_z")
    hits = (parts.join(F.broadcast(top), "token").select("word", "y1", "y").distinct()
            .agg(F.sum("y1"), F.sum("y")).first())
    hits1, hits0 = hits[0] or 0, (hits[1] or 0) - (hits[0] or 0)
    gap = log((n1 - hits1 + 1) / (n1 + 2)) - log((n0 - hits0 + 1) / (n0 + 2))
    return {r["token"]: r["odds"] for r in top.collect()}, min(gap, -0.001)


def passages(docs: DataFrame, lex: dict, gap: float) -> DataFrame:
    """doc_id, n (words), spans: the maximal scoring segments of every text."""
    source = docs.select("doc_id", "text")
    kind = source.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("first", pa.int32()), ("last", pa.int32()), ("score", pa.float64())])

    def run(batches):
        known: dict[bytes, float | None] = {}
        for batch in batches:
            sizes, found = [], []
            for text in texts(batch.column(1)):
                tokens = WORD.findall(text.translate(LOWER_BYTES))
                if len(known) > REMEMBERED:
                    known.clear()
                for w in [w for w in set(tokens) if w not in known]:
                    own = [lex[t] for t in word_tokens(w.decode("utf-8", "replace")) if t in lex]
                    known[w] = max(own, default=None)
                scores = [known[w] for w in tokens]
                at = [i for i, s in enumerate(scores) if s is not None]
                spans = segments(at, [scores[i] for i in at], gap)
                sizes.append(len(tokens))
                found.append([{"first": a, "last": b, "score": s} for a, b, s in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, type=pa.int64()),
                 pa.array(found, type=pa.list_(span))], ["doc_id", "n", "spans"])

    return source.mapInArrow(run, f"doc_id {kind}, n long, "
                                  "spans array<struct<first: int, last: int, score: double>>")


def fit_tail(n: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """lambda and K of the extreme-value law of the best segment of n clean words, by likelihood
    over texts with a segment (lambda is 1 for exact log-odds; a grid around it is searched)."""
    some = (n > 0) & (best > 0)
    n, best = n[some].astype(float), best[some]
    if not len(n):
        return 1.0, 1e-3
    result = None
    for lam in np.linspace(0.3, 2.0, 69):
        weight = n * np.exp(-lam * best)
        k = len(n) / weight.sum()
        like = len(n) * (log(lam) + log(k)) + np.log(weight).sum() - k * weight.sum()
        if result is None or like > result[0]:
            result = like, float(lam), float(k)
    return result[1], result[2]


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Intercept and slope of P(y = 1 | x) by Newton steps."""
    if not len(y) or y.min() == y.max():
        return (-2.0 if not len(y) or y.min() == 0 else 2.0), 1.0
    design = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge * beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def toxicity(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 4,
             held_out: int = 2, threshold: float = THRESHOLD,
             fit_rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted, then n_passages (significant ones), best (score of the
    best segment) and passages (first word, last word, score): one row per row of ``docs``.

    Only labels of ids outside the held-out fold are learned from; NULL labels and labels without
    a text are ignored. NULL and empty texts have no words and the lowest score; without any toxic
    training text all scores are low and equal; repeated rows are repeated in the result; an
    empty table gives an empty result; other columns are not read.
    """
    def train(doc_id):
        return crc_mod(doc_id, folds) != held_out

    docs = docs.select("doc_id", "text")
    known = _labelled(docs, labels, label_col, train)
    lex, gap = lexicon(known)
    found = cut(passages(docs, lex, gap))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["score"])), F.lit(0.0))
    fit = (found.withColumn("best", best)
           .join(F.broadcast(seeded_rows(cut(known.select(F.col("_id").alias("doc_id"), "label")),
                                         "doc_id", fit_rows, SEED)), "doc_id")
           .select("n", "best", "label", F.expr("transform(spans, s -> s.score)").alias("scores"))
           .toPandas())
    clean = fit[fit["label"] == 0]
    lam, k = fit_tail(clean["n"].to_numpy(), clean["best"].to_numpy())
    x = np.array([_sum_excess(n, np.array(s, dtype=float), lam, k)
                  for n, s in zip(fit["n"], fit["scores"])], dtype=float)
    a, b = fit_logistic(x, fit["label"].to_numpy(dtype=float))
    over = F.greatest(F.log(F.lit(k) * F.col("n")), F.lit(0.0))
    excess = F.transform("spans", lambda s: s["score"] * lam - over)
    above = F.filter(excess, lambda e: e > 0)
    stat = F.when(F.size(above) > 0, F.aggregate(above, F.lit(0.0), lambda t, e: t + e)) \
        .otherwise(F.coalesce(F.array_max(excess), -over))
    score = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * stat)))
    return (found.withColumn("score", score).select(
        "doc_id", (crc_mod(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.size(above).alias("n_passages"), best.alias("best"),
        F.filter("spans", lambda s: s["score"] * lam > over).alias("passages")))


def _sum_excess(n: int, scores: np.ndarray, lam: float, k: float) -> float:
    over = max(log(k * n), 0.0) if n > 0 else 0.0
    excess = lam * scores - over
    if (excess > 0).any():
        return float(excess[excess > 0].sum())
    return float(excess.max()) if len(excess) else -over
