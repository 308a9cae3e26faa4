"""Quality classifier by positive-unlabelled learning.

The trusted positives are labelled good texts; everything else on the web is unlabelled, good and
bad mixed. The share of good texts (the class prior) is estimated by comparing how often a
classifier of positives against unlabelled texts scores high on held-out texts of either kind. A
small network then minimises the non-negative unbiased risk: the risk of the unlabelled texts
taken as bad, less the part that their good texts account for, is kept from falling below zero,
and where it does, the step is undone instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators._plan import MAX_BROADCAST_BYTES, measured_bytes
from ._common import LOWER_BYTES, UPPER, crc_mod, cut, seeded_rows, texts

#: Bounds of the samples that the classifier is fitted on.
POSITIVES = 20_000
UNLABELLED = 40_000
HIDDEN = 24
EPOCHS = 60
BATCH = 512
RATE = 3e-3
SEED = 11
THRESHOLD = 0.3
# Characters counted one by one as shares of a text.
MARKS = b"#*$%&|<>!?.,;:-_=+/\\()[]{}\"'@~^"
NAMES = (["words", "bytes_per_word", "long_words", "upper", "digits", "high_bytes", "blanks",
          "line_words", "short_lines", "repeated_lines", "distinct_words", "distinct_pairs",
          "capital_starts", "sentence_ends", "marked_words"] + [f"mark_{chr(m)}" for m in MARKS])


def features(text: bytes) -> list[float]:
    """Numbers of one text, most of them shares between 0 and 1; zeros for a text without words."""
    tokens = text.split()
    n, size = len(tokens), len(text)
    if not n:
        return [0.0] * len(NAMES)
    lines = [x for x in text.split(b"\n") if x.strip()]
    body = b"".join(tokens)
    lowered = [w.translate(LOWER_BYTES) for w in tokens]
    pairs = set(zip(lowered, lowered[1:]))
    upper = len(body) - len(body.translate(None, UPPER.encode()))
    marked = sum(1 for w in tokens if not (w[-1:].isalnum() or w[-1] > 127 or w[-1] in b".,"))
    return [np.log1p(n), len(body) / n / 10, sum(1 for w in tokens if len(w) > 12) / n,
            upper / len(body), (len(body) - len(body.translate(None, b"0123456789"))) / len(body),
            (len(body) - len(body.translate(None, bytes(range(128, 256))))) / len(body),
            (size - len(body)) / size, np.log1p(n / len(lines)) / 5,
            sum(1 for x in lines if len(x) < 20) / len(lines),
            1 - len(set(lines)) / len(lines), len(set(lowered)) / n,
            len(pairs) / (n - 1) if n > 1 else 1.0,
            sum(1 for w in tokens if w[:1].isupper()) / n,
            sum(1 for w in tokens if w.endswith(b".")) / n, marked / n,
            *[min(1.0, text.count(bytes([m])) / n) for m in MARKS]]


def featured(docs: DataFrame) -> DataFrame:
    """(doc_id, x): the features of every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            rows = [features(t) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(rows, type=pa.list_(pa.float32()))], ["doc_id", "x"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, x array<float>")


class Network:
    """One hidden layer of rectified units; parameters are plain arrays."""

    def __init__(self, width: int, hidden: int, rng: np.random.Generator):
        self.parts = [rng.normal(0, np.sqrt(2 / width), (width, hidden)), np.zeros(hidden),
                      rng.normal(0, np.sqrt(1 / hidden), hidden), np.zeros(1)]
        self.first = [np.zeros_like(p) for p in self.parts]
        self.second = [np.zeros_like(p) for p in self.parts]
        self.steps = 0

    def forward(self, x):
        w, b, v, c = self.parts
        h = np.maximum(x @ w + b, 0)
        return h @ v + c[0], h

    def gradient(self, x, h, slope):
        """Gradient of sum(slope * output)."""
        v = self.parts[2]
        back = slope[:, None] * v * (h > 0)
        return [x.T @ back, back.sum(axis=0), h.T @ slope, np.array([slope.sum()])]

    def step(self, gradient, rate: float, decay: float = 1e-4):
        self.steps += 1
        for p, g, m, s in zip(self.parts, gradient, self.first, self.second):
            g = g + decay * p
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p -= rate * (m / (1 - 0.9 ** self.steps)) / (
                np.sqrt(s / (1 - 0.999 ** self.steps)) + 1e-8)


def _sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _softplus(z):
    return np.logaddexp(0, z)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None,
        rng: np.random.Generator, epochs: int = EPOCHS) -> Network:
    """Minimise the non-negative risk for a class prior; without one, tell positives from
    unlabelled texts."""
    net = Network(positive.shape[1], HIDDEN, rng)
    batches = max(1, max(len(positive), len(unlabelled)) // BATCH)
    for _ in range(epochs):
        order = (rng.permutation(len(positive)), rng.permutation(len(unlabelled)))
        for k in range(batches):
            p, u = (x[np.take(o, range(k * BATCH, (k + 1) * BATCH), mode="wrap")]
                    for x, o in zip((positive, unlabelled), order))
            zp, hp = net.forward(p)
            zu, hu = net.forward(u)
            sp, su = _sigmoid(zp), _sigmoid(zu)
            if prior is None:
                up, uu = (sp - 1) / len(p), su / len(u)
            else:
                bad = _softplus(zu).mean() - prior * _softplus(zp).mean()
                if bad >= 0:
                    up, uu = prior * ((sp - 1) - sp) / len(p), su / len(u)
                else:
                    up, uu = prior * sp / len(p), -su / len(u)
            grad = [a + b for a, b in zip(net.gradient(p, hp, up), net.gradient(u, hu, uu))]
            net.step(grad, RATE)
    return net


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, rng: np.random.Generator) -> float:
    """Share of positives among the unlabelled: the least ratio of the shares of either kind above
    a score, over held-out halves and thresholds that enough positives exceed."""
    if len(positive) < 4 or len(unlabelled) < 4:
        return 0.5
    p, u = rng.permutation(len(positive)), rng.permutation(len(unlabelled))
    hp, hu = len(p) // 2, len(u) // 2
    net = fit(positive[p[:hp]], unlabelled[u[:hu]], None, rng, EPOCHS // 3)
    zp = np.sort(net.forward(positive[p[hp:]])[0])
    zu = np.sort(net.forward(unlabelled[u[hu:]])[0])
    cuts = zp[: int(0.9 * len(zp)) + 1]
    above_p = 1 - np.searchsorted(zp, cuts) / len(zp)
    above_u = 1 - np.searchsorted(zu, cuts) / len(zu)
    slack = 1.36 * (np.sqrt(1 / len(zp)) + np.sqrt(1 / len(zu)))  # 90 % bounds of both shares
    ratio = (above_u + slack) / above_p
    best = int(np.argmin(ratio))
    return float(np.clip(above_u[best] / above_p[best], 0.05, 0.99))


def quality_scores(docs: DataFrame, labels: DataFrame, label_col: str = "quality",
                   folds: int = 5, held_out: int = 0, threshold: float = THRESHOLD,
                   positives: int = POSITIVES, unlabelled: int = UNLABELLED,
                   seed: int = SEED) -> DataFrame:
    """doc_id, held_out, score, predicted, and prior (the estimated share of good texts): one row
    per row of ``docs``.

    Only positive labels of ids outside the held-out fold are learned from; NULL labels and labels
    without a text are ignored. At most ``positives`` and ``unlabelled`` texts, drawn by a hash of
    their ids, fit the model; all texts are scored. NULL and empty texts are scored like any other
    by their (zero) features; without positive labels every score is 0.5; repeated rows are
    repeated in the result; an empty table gives an empty result; other columns are not read.
    """
    x = cut(featured(docs))
    good = (labels.where(F.col(label_col) == 1).where(crc_mod(F.col("doc_id"), folds) != held_out)
            .select("doc_id").distinct())
    good = cut(good)
    if measured_bytes(good) <= MAX_BROADCAST_BYTES:
        good = F.broadcast(good)

    def draw(rows: DataFrame, bound: int) -> np.ndarray:
        got = seeded_rows(rows.select("doc_id", "x"), "doc_id", bound, seed).toPandas()["x"]
        return np.array(got.tolist(), dtype=np.float64).reshape(-1, len(NAMES))

    p = draw(x.join(good, "doc_id", "left_semi"), positives)
    u = draw(x, unlabelled)
    if len(p) and len(u):
        rng = np.random.default_rng(seed)
        center, scale = u.mean(axis=0), u.std(axis=0) + 1e-3
        p, u = (np.clip((z - center) / scale, -6, 6) for z in (p, u))
        prior = class_prior(p, u, rng)
        parts = fit(p, u, prior, rng).parts
    else:
        center, scale, prior = np.zeros(len(NAMES)), np.ones(len(NAMES)), 0.5
        parts = [np.zeros((len(NAMES), 1)), np.zeros(1), np.zeros(1), np.zeros(1)]

    kind = x.schema["doc_id"].dataType.simpleString()

    def run(batches):
        w, b, v, c = parts
        for batch in batches:
            z = np.asarray(batch.column(1).flatten(), dtype=np.float64).reshape(-1, len(NAMES))
            z = np.clip((z - center) / scale, -6, 6)
            out = _sigmoid(np.maximum(z @ w + b, 0) @ v + c[0])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)],
                                             ["doc_id", "score"])

    scored = x.mapInArrow(run, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id", (crc_mod(F.col("doc_id"), folds) == held_out).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        F.lit(prior).alias("prior"))
