"""Document log-likelihood under a gated recurrent language model.

Words are counted over all training texts. The most frequent ones (the head) are predicted one by
one: a softmax over classes, then over the words of the class. All other words fall into classes
by their ending; within such a class a word has its smoothed share of the training counts, and
each class keeps room for one unknown word, so the model is a distribution over open text. The
network starts as the unigram model (output biases are log frequencies, output weights zero) and
is trained by truncated backpropagation through time in tasks that each run over a part of the
training texts and are averaged after every round; every text is trained on once. For scoring, many documents run side by side;
their states are carried from window to window, so every document is scored whole.

Counts of rare words do not fit a task's memory: the most frequent words' counts are sent to the
tasks, the rest is looked up in a join.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..session import scratch_path
from ._common import crc_mod, cut, pieces

HEAD = 4096
CLASS_WORDS = 64
TAIL_CLASSES = 64
#: Words whose counts are sent to the tasks.
KNOWN = 1 << 18
EMBED, UNITS = 16, 24
WINDOW = 32
#: How many times longer a window may be where few streams are left: once per so many symbols of
#: the run (short runs need every step), and at most.
LONGER_SYMBOLS, LONGER = 1 << 16, 32
#: Texts trained on side by side: as many as leave each run this many steps, within these bounds.
STREAMS, STEPS = (32, 256), 64
ROUNDS = 4
#: Fewest tasks of a round; there are more if each would get more than so many symbols.
WORKERS = 12
WORKER_SYMBOLS = 4 << 20
#: Symbols trained on at a time, and sets of parameters that come to the driver per round.
EPOCH_SYMBOLS = 1 << 22
MERGED = 16
#: Share of the training documents that the network is fitted on (counts are over all).
SAMPLE = 1.0
RATE = 5e-3
SEED = 5
#: Bytes of text that are cut into words at a time: to count them, and to keep their places.
COUNT_BYTES, BLOCK_BYTES = 32 << 20, 16 << 20
#: Rows of outputs worked on at a time (they stay in a core's cache), and how far the largest
#: logit may lie below its bound for the bound to take its place.
BLOCK_ROWS, SAFE = 1024, 60.0
#: Symbols whose inputs to the gates are made at a time.
BLOCK_SYMBOLS = 1 << 13
#: How symbols are stored: holds all of ``HEAD + TAIL_CLASSES``.
SYMBOL = np.dtype("<u2")
# Fixed value: stands for the end of a text; no word holds a line feed.
END = b"\n"
#: Punctuation that may follow the letters of a word.
MARKS = b".,;:!?*$%&#"


def split_words(column: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Of a column of texts: the number of tokens of each, the distinct words (the end of a text is
    the last of them; the first may be an empty one that does not occur), and the number of every
    token's word, text after text."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    sizes = pc.list_value_length(found).to_numpy().astype(np.int64)
    coded = found.flatten().dictionary_encode()
    words, flat = coded.dictionary, coded.indices.to_numpy()
    blank = pc.index(words, pa.scalar("", type=words.type)).as_py()
    if blank >= 0:  # before, between and after white space at the ends
        word = flat != blank
        sizes = np.bincount(np.repeat(np.arange(len(sizes)), sizes)[word], minlength=len(sizes))
        flat = flat[word]
    flat = np.insert(flat, np.cumsum(sizes), len(words))
    end = pa.array([END.decode()], type=words.type)
    return sizes + 1, pa.concat_arrays([words, end]), flat


def word_hashes(words: pa.Array) -> np.ndarray:
    """Hashes of ``split_words``' distinct words, as signed numbers in the order of the unsigned."""
    n = len(words) - 1
    lists = pa.ListArray.from_arrays(pa.array([0, n], type=pa.int32()), words.slice(0, n))
    joined = pc.binary_join(lists, END.decode())[0].as_buffer().to_pybytes()
    each = [*(joined.split(END) if n else []), END]
    made = np.fromiter(map(xxhash.xxh64_intdigest, each), dtype=np.uint64, count=n + 1)
    return (made ^ np.uint64(1 << 63)).view(np.int64)


def tail_class(word: bytes) -> int:
    """Class of a rare word: by its last two letters, without punctuation after them."""
    return xxhash.xxh32_intdigest(word.rstrip(MARKS)[-2:]) % TAIL_CLASSES


def tail_classes(words: pa.Array) -> np.ndarray:
    """``tail_class`` of ``split_words``' distinct words, worked out once for each ending."""
    bare = pc.ascii_rtrim(words, characters=MARKS.decode()).cast(pa.large_binary())
    ends = np.frombuffer(bare.buffers()[1], dtype=np.int64)[bare.offset:][:len(bare) + 1]
    data = np.frombuffer(bare.buffers()[2], dtype=np.uint8).astype(np.int64)
    sizes, ends = np.diff(ends), ends[1:]
    ending = np.where(sizes > 0, 1 + data[np.maximum(ends, 1) - 1], 0)
    ending += 257 * np.where(sizes > 1, 1 + data[np.maximum(ends, 2) - 2], 0)
    _, first, at = np.unique(ending, return_index=True, return_inverse=True)
    return np.array([tail_class(words[i].as_buffer().to_pybytes()) for i in first.tolist()])[at]


def count_words(train: DataFrame) -> DataFrame:
    """(w, c, tail): hash, count and tail class of every distinct token of ``train(text)``."""
    def run(batches):
        for batch in batches:
            for piece in pieces(batch, 0, COUNT_BYTES):
                _, words, flat = split_words(piece.column(0))
                c = np.bincount(flat, minlength=len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[c > 0]) for x in (
                        word_hashes(words), c, tail_classes(words).astype(np.int32))],
                    ["w", "c", "tail"])

    counted = train.select("text").mapInArrow(run, "w long, c long, tail int")
    return counted.groupBy("w").agg(F.sum("c").alias("c"), F.min("tail").alias("tail"))


class Vocabulary:
    """What tasks know of the counts: up to ``KNOWN`` most frequent words (all of one count or
    none), of which the first ``HEAD`` have outputs of their own, and totals."""

    def __init__(self, spark, counts: DataFrame):
        # the least count that at most KNOWN words reach: only these words come to the driver
        least, held = 1, 0
        for r in (counts.groupBy("c").agg(F.count(F.lit(1)).alias("n"))
                  .orderBy(F.desc("c")).limit(KNOWN).toLocalIterator()):
            if held + r["n"] > KNOWN:
                least = r["c"] + 1
                break
            held += r["n"]
        top = counts.where(F.col("c") >= least).select("w", "c", "tail").toPandas()
        top = top.sort_values(["c", "w"], ascending=[False, True], ignore_index=True)
        head = min(HEAD, len(top))
        n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
        self.n, self.v, self.head = int(n), int(v), head
        self.classes = -(-head // CLASS_WORDS)
        self.tail_n, self.tail_v = np.zeros(TAIL_CLASSES), np.zeros(TAIL_CLASSES)
        for r in counts.groupBy("tail").agg(F.sum("c").alias("n"),
                                            F.count(F.lit(1)).alias("v")).collect():
            self.tail_n[r["tail"]], self.tail_v[r["tail"]] = r["n"], r["v"]
        first = top.iloc[:head]
        np.subtract.at(self.tail_n, first["tail"].to_numpy(), first["c"].to_numpy())
        np.subtract.at(self.tail_v, first["tail"].to_numpy(), 1)
        self.head_counts = first["c"].to_numpy().astype(np.float64)
        w = top["w"].to_numpy()
        order = np.argsort(w)
        self.words, self.rank = w[order], order
        self.counts = top["c"].to_numpy()[order]

    def find(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of ``split_words``' distinct words: symbol (head rank, or ``head`` + tail class), count
        (-1 if it is not among the known words), and hash."""
        w = word_hashes(words)
        if not len(self.words):
            at, hit = np.zeros(len(w), dtype=np.int64), np.zeros(len(w), dtype=bool)
            rank, count = at, at - 1
        else:
            at = np.minimum(np.searchsorted(self.words, w), len(self.words) - 1)
            hit = self.words[at] == w
            rank, count = self.rank[at], np.where(hit, self.counts[at], -1)
        return np.where(hit & (rank < self.head), rank, self.head + tail_classes(words)), count, w

    @property
    def symbols(self) -> int:
        return self.head + TAIL_CLASSES


class Model:
    """Parameters as plain arrays (float32), by name."""

    def __init__(self, vocabulary: Vocabulary, seed: int = SEED):
        rng, v = np.random.default_rng(seed), vocabulary
        self.head, self.classes = v.head, v.classes
        normal = lambda *shape: rng.normal(0, shape[0] ** -0.5, shape).astype(np.float32)
        mass = np.array([v.head_counts[i * CLASS_WORDS:(i + 1) * CLASS_WORDS].sum()
                         for i in range(v.classes)])
        self.p = {
            "embed": 0.3 * normal(v.symbols + 1, EMBED) * (v.symbols + 1) ** 0.5,
            "w": normal(EMBED, 3 * UNITS), "u": normal(UNITS, 3 * UNITS),
            "b": np.zeros(3 * UNITS, dtype=np.float32),
            "wc": np.zeros((UNITS, v.classes + TAIL_CLASSES), dtype=np.float32),
            "bc": np.log(np.r_[mass, v.tail_n + v.tail_v + 1]).astype(np.float32),
            "ww": np.zeros((v.head, UNITS), dtype=np.float32),
            "bw": np.log(v.head_counts + 1).astype(np.float32)}

    def classes_of(self, symbols: np.ndarray) -> np.ndarray:
        return np.where(symbols < self.head, symbols // CLASS_WORDS,
                        symbols - self.head + self.classes)

    def run(self, inputs: np.ndarray, state: np.ndarray, keep: bool = False):
        """States after each of the inputs (time, stream), cleared where a text starts; with
        ``keep`` what training needs (by time, a row for each unit, a column for each stream)."""
        p, n, kind = self.p, UNITS, state.dtype
        # sigmoid(x) = 1 / (1 + exp(-x)), tanh(x) = 2 sigmoid(2 x) - 1
        sign = np.repeat([-1, -2], [2 * n, n]).astype(kind)
        into = np.ascontiguousarray((np.vstack([p["w"], p["b"]]) * sign).T)
        again = np.ascontiguousarray((p["u"] * sign).T)
        start = len(p["embed"]) - 1
        embed = np.hstack([p["embed"], np.ones((start + 1, 1), dtype=p["embed"].dtype)])
        (steps, width), fresh = inputs.shape, inputs == start
        cleared = fresh.any(axis=1)
        first = state = np.ascontiguousarray(state.T)
        out = np.empty((steps, n, width), dtype=kind)
        held = np.empty((steps if keep else 1, 3 * n, width), dtype=np.result_type(again, kind))
        part = np.empty((n, width), dtype=held.dtype)
        # inputs to the gates for a number of steps at a time (they stay in a core's cache)
        stride = steps if keep else max(1, BLOCK_SYMBOLS // max(1, width))
        with np.errstate(over="ignore"):  # 1 / (1 + inf) = 0
            for at in range(0, steps, max(1, stride)):
                rows = embed.take(inputs[at:at + stride], axis=0)
                inner = np.matmul(into, rows.transpose(0, 2, 1))
                for t, x in enumerate(inner, at):
                    if cleared[t]:
                        state = np.where(fresh[t], kind.type(0), state)
                    hu = np.matmul(again, state, out=held[t if keep else 0])
                    gates, new = x[:2 * n], x[2 * n:]
                    gates += hu[:2 * n]
                    np.exp(gates, out=gates)
                    gates += 1
                    np.divide(1, gates, out=gates)
                    new += np.multiply(gates[n:], hu[2 * n:], out=part)
                    np.exp(new, out=new)
                    new += 1
                    np.divide(2, new, out=new)
                    new -= 1
                    after = np.subtract(state, new, out=out[t])
                    after *= gates[:n]
                    after += new
                    state = after
        kept = None
        if keep:
            before = np.concatenate([first[None], out[:-1]])
            if cleared.any():
                before *= ~fresh[:, None]
            kept = rows, before, inner, held[:, 2 * n:]
        return out.transpose(0, 2, 1), kept

    def outputs(self, h: np.ndarray, symbols: np.ndarray, gradient: bool = False):
        """Log-probability of each symbol after its state; with ``gradient`` also the gradient of
        the summed negative log-probability for the states and output parameters."""
        p, which = self.p, self.classes_of(symbols)
        # classes are small numbers: numpy sorts 16 bits by radix
        order = np.argsort(which.astype(np.int16) if self.classes < 1 << 14 else which,
                           kind="stable")
        which, symbols, n, kind = which[order], symbols[order], len(h), h.dtype
        # the biases are weights of a last unit that is always one
        rows = np.ones((n, UNITS + 1), dtype=kind)
        rows[:, :-1] = h.take(order, axis=0)
        reach = np.abs(h).max(initial=0)
        wc = np.ascontiguousarray(np.vstack([p["wc"], p["bc"]]).T)
        ww = np.hstack([p["ww"], p["bw"][:, None]])
        dh, dwc, dww = np.empty_like(rows), np.zeros_like(wc), np.zeros_like(ww)
        bounds = np.searchsorted(which, np.arange(self.classes + 1)).tolist()
        starts = np.arange(0, self.head, CLASS_WORDS)
        room, word_room = _room(wc, reach, [0]), _room(ww, reach, starts)
        wide = max(wc.shape[0], CLASS_WORDS)
        space, ones = np.empty(BLOCK_ROWS * wide, dtype=kind), np.ones(wide, dtype=kind)
        own, totals = np.empty((2, n), dtype=kind), np.empty((2, n), dtype=kind)
        own[1], totals[1] = 0, 1
        number = np.arange(BLOCK_ROWS)

        def softmax(level, at, end, weights, safe, right, grads, first):
            for a in range(at, end, BLOCK_ROWS):
                b = min(a + BLOCK_ROWS, end)
                k, x = b - a, rows[a:b]
                e = space[:k * len(weights)].reshape(k, len(weights))
                np.matmul(x, weights.T, out=e)
                if not safe:
                    e -= e.max(axis=1, keepdims=True)
                pick = number[:k], right[a:b]
                own[level, a:b] = e[pick]
                np.exp(e, out=e)
                total = np.matmul(e, ones[:len(weights)], out=totals[level, a:b])
                if gradient:
                    e *= (1 / total)[:, None]
                    e[pick] -= 1
                    if first:
                        np.matmul(e, weights, out=dh[a:b])
                        grads += (x.T @ e).T
                    else:
                        dh[a:b] += e @ weights
                        grads += e.T @ x

        softmax(0, 0, n, wc, room[0], which, dwc, True)
        within = symbols % CLASS_WORDS
        for c in range(self.classes):
            if bounds[c] < bounds[c + 1]:
                words = slice(c * CLASS_WORDS, min((c + 1) * CLASS_WORDS, self.head))
                softmax(1, bounds[c], bounds[c + 1], ww[words], word_room[c], within, dww[words],
                        False)
        score = (own - np.log(totals)).sum(axis=0)
        back = np.empty_like(order)
        back[order] = np.arange(n)
        if gradient:
            return score[back], dh.take(back, axis=0)[:, :-1], {
                "wc": dwc[:, :-1].T, "bc": dwc[:, -1], "ww": dww[:, :-1], "bw": dww[:, -1]}
        return score[back]

    def learn(self, inputs, symbols, live, state, moments, step: int):
        """One window of truncated backpropagation; returns the last states."""
        p, n = self.p, UNITS
        h, kept = self.run(inputs, state, keep=True)
        steps, width = inputs.shape
        use = live.reshape(-1)
        flat = h.reshape(-1, n)
        if use.all():
            _, dh, g = self.outputs(flat, symbols.reshape(-1), True)
        else:
            dh = np.zeros((steps * width, n), dtype=h.dtype)
            _, dh[use], g = self.outputs(flat[use], symbols.reshape(-1)[use], True)
        dh = np.ascontiguousarray(dh.reshape(steps, width, n).transpose(0, 2, 1))
        start = len(p["embed"]) - 1
        fresh = inputs == start
        cleared = fresh.any(axis=1)
        rows, before, inner, hn = kept
        z, r, new = inner[:, :n], inner[:, n:2 * n], inner[:, 2 * n:]
        # by step: the candidate, both gates, and the candidate's state part; until its step has
        # its turn, each without the gradient that comes to it
        every = np.empty((steps, 4 * n, width), dtype=h.dtype)
        dn, dz, dr, dp = (every[:, i * n:(i + 1) * n] for i in range(4))
        np.subtract(1, z, out=dp)
        np.subtract(before, new, out=dz)
        dz *= z
        dz *= dp
        np.multiply(new, new, out=dn)
        np.subtract(1, dn, out=dn)
        dn *= dp
        np.subtract(1, r, out=dr)
        dr *= r
        dr *= hn  # the state's part of the candidate, times -2
        dr *= -0.5
        u, back = p["u"], np.zeros((n, width), dtype=h.dtype)
        for t in range(steps - 1, -1, -1):
            d, candidate = dh[t], dn[t]
            d += back
            candidate *= d
            dz[t] *= d
            dr[t] *= candidate
            np.multiply(candidate, r[t], out=dp[t])
            np.matmul(u, every[t, n:], out=back)
            d *= z[t]
            back += d
            if cleared[t]:
                back[:, fresh[t]] = 0
        gu = np.matmul(before, every[:, n:].transpose(0, 2, 1)).sum(axis=0)
        dx = every[:, :3 * n]
        order = np.r_[n:3 * n, :n]  # gates first, as in the parameters
        gw = np.matmul(dx, rows).sum(axis=0)[order]
        lanes = np.ascontiguousarray(np.roll(p["w"], n, axis=1))
        dembed = np.matmul(lanes, dx).transpose(1, 0, 2).reshape(EMBED, -1)
        seen = inputs.reshape(-1)
        g["u"], g["w"], g["b"] = gu, gw[:, :-1].T, gw[:, -1]
        g["embed"] = np.stack([np.bincount(seen, d, start + 1) for d in dembed], axis=1)
        g = {k: np.ascontiguousarray(x, dtype=h.dtype) for k, x in g.items()}
        scale = 1 / max(1, use.sum())
        norm = scale * np.sqrt(sum(float(np.vdot(x, x)) for x in g.values()))
        scale *= min(1.0, 1.0 / max(norm, 1e-9))
        for k, x in g.items():
            if k not in moments:
                moments[k] = np.zeros_like(x), np.zeros_like(x)
            m, s = moments[k]
            x *= np.float32(0.1 * scale)
            m *= np.float32(0.9)
            m += x
            x *= x  # a hundredth of the square
            s *= np.float32(0.99)
            s += x
            np.multiply(s, np.float32(1 / (1 - 0.99 ** step)), out=x)
            np.sqrt(x, out=x)
            x += np.float32(1e-7)
            np.divide(m, x, out=x)
            x *= np.float32(RATE / (1 - 0.9 ** step))
            p[k] -= x
        return h[-1]


def _room(weights: np.ndarray, reach: float, starts) -> list[bool]:
    """Lowers the biases (the last column) of every softmax, whose rows of ``weights`` begin at
    ``starts``, by a number that no product with a state of components up to ``reach`` is above.
    True for a softmax whose largest product is never far below that: it need not be looked for."""
    reaches = reach * np.abs(weights[:, :-1]) @ np.ones(weights.shape[1] - 1, weights.dtype)
    if not len(reaches):
        return []
    most = np.maximum.reduceat(weights[:, -1] + reaches, starts)
    least = np.maximum.reduceat(weights[:, -1] - reaches, starts)
    weights[:, -1] -= np.repeat(most, np.diff([*starts, len(weights)]))
    return (most - least < SAFE).tolist()


def _window(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray, at: int, steps: int):
    """(time, stream) symbols of the sequences that begin in ``flat`` at ``starts``, from ``at``
    on, and which of them are within their sequence (the others are 0)."""
    time = np.arange(at, at + steps)[:, None]
    live = time < lengths
    return np.where(live, flat[np.where(live, starts + time, 0)], 0), live


def _streams(lengths: np.ndarray, wide: int) -> list[np.ndarray]:
    """Numbers of texts for up to ``wide`` streams of about equal length, the longest stream
    first: the longest texts are placed first, each on the shortest stream, and follow one another
    in the order they came."""
    loads, streams = [(0, i) for i in range(wide)], [[] for _ in range(wide)]
    for k in np.argsort(-lengths, kind="stable").tolist():
        size, at = loads[0]
        streams[at].append(k)
        heapq.heapreplace(loads, (size + int(lengths[k]), at))
    streams = [np.sort(np.array(x)) for x in streams if x]
    return sorted(streams, key=lambda x: -lengths[x].sum())


def _laid(texts_: list[np.ndarray], wide: int, start: int):
    """Symbol sequences laid end to end over streams: the order they have, symbols, inputs (the
    symbol before, ``start`` where a text begins), first place and length of each stream."""
    lengths = np.array([len(t) for t in texts_], dtype=np.int64)
    streams = _streams(lengths, wide)
    order = np.concatenate([np.zeros(0, dtype=np.int64), *streams]).astype(np.int64)
    symbols = np.concatenate([np.zeros(0, np.int32), *(texts_[k] for k in order)]).astype(np.int32)
    inputs = np.concatenate([[start], symbols[:-1]]).astype(np.int32)[:len(symbols)]
    sizes = lengths[order]
    inputs[(np.cumsum(sizes) - sizes)[sizes > 0]] = start
    long = np.array([lengths[x].sum() for x in streams], dtype=np.int64)
    return order, symbols, inputs, np.cumsum(long) - long, long


def _epoch(model: Model, texts_: list[np.ndarray], moments: dict, step: int) -> tuple[int, int]:
    """Train on symbol sequences, laid end to end over a number of streams that grows with them; the
    state of a stream is carried over windows and cleared where a text begins, and streams that
    have ended are left out. Where few streams are left their windows are longer. Returns the
    number of symbols and the steps taken so far."""
    start = len(model.p["embed"]) - 1
    total = sum(map(len, texts_))
    wide = int(np.clip(total // (WINDOW * STEPS), *STREAMS))
    _, symbols, inputs, starts, lengths = _laid(texts_, wide, start)
    state = np.zeros((len(lengths), UNITS), dtype=np.float32)
    at, end = 0, int(lengths.max(initial=0))
    longer = int(np.clip(total // LONGER_SYMBOLS, 1, LONGER))
    while at < end:
        n = int((lengths > at).sum())
        steps = min(WINDOW * min(max(1, wide // n), longer), end - at)
        here, live = _window(symbols, starts[:n], lengths[:n], at, steps)
        seen = np.where(live, _window(inputs, starts[:n], lengths[:n], at, steps)[0], start)
        step += 1
        state = model.learn(seen, here, live, state[:n], moments, step)
        at += steps
    return total, step


def encode(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(row, doc_id, n_tokens, hits, base, inner, s, rest) of ``docs(doc_id, text)``: a number of
    its own for each row, the tokens and those among the known words, the base score and the rare
    words' shares of their classes (both without the words in ``rest``, hashes with numbers of
    occurrences, whose counts are not known here), and the symbols, two bytes each."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    rest_kind = [pa.field("w", pa.int64()), pa.field("m", pa.int32())]

    def run(batches):
        vocabulary = shared.value
        base_total = np.log10(vocabulary.n + vocabulary.v + 1)
        tail_total = np.log10(vocabulary.tail_n + vocabulary.tail_v + 1)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            for piece in pieces(batch, 1, BLOCK_BYTES):
                sizes, words, flat = split_words(piece.column(1))
                symbol, count, w = vocabulary.find(words)
                n, ends = len(sizes), np.cumsum(sizes)
                owner = np.repeat(np.arange(n), sizes)
                known = np.where(count >= 0, np.log10(np.maximum(count, 0) + 1.0), 0.0)
                tail = symbol >= vocabulary.head
                inner = np.where(tail, known - tail_total[np.where(
                    tail, symbol - vocabulary.head, 0)], 0.0)
                per_text = lambda x: np.bincount(owner, x[flat], n)
                place = np.flatnonzero((count < 0)[flat])
                far, m = np.unique(owner[place] * len(w) + flat[place], return_counts=True)
                begin = np.searchsorted(far, np.arange(n + 1) * len(w))
                rest = pa.ListArray.from_arrays(
                    pa.array(begin, type=pa.int32()), pa.StructArray.from_arrays(
                        [pa.array(w[far % len(w)]), pa.array(m, type=pa.int32())],
                        fields=rest_kind))
                symbols = symbol.astype(SYMBOL)[flat]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(row, row + n)), piece.column(0),
                     pa.array(sizes), pa.array(per_text(count > 0).astype(np.int64)),
                     pa.array(per_text(known) - sizes * base_total), pa.array(per_text(inner)),
                     pa.array([symbols[b - k:b].tobytes() for b, k in zip(
                         ends.tolist(), sizes.tolist())], type=pa.binary()), rest],
                    ["row", "doc_id", "n_tokens", "hits", "base", "inner", "s", "rest"])
                row += n

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"row long, doc_id {kind}, n_tokens long, hits long, base double, inner double, "
             "s binary, rest array<struct<w: long, m: int>>")


def _runs(column: pa.Array):
    """Symbol sequences of an Arrow batch, in runs of about ``EPOCH_SYMBOLS`` symbols."""
    rows, size = [], 0
    for x in column:
        rows.append(np.frombuffer(x.as_buffer(), dtype=SYMBOL))
        size += len(rows[-1])
        if size >= EPOCH_SYMBOLS:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def _mean(rows) -> tuple[int, np.ndarray | float]:
    """Total of n and mean, weighted by n, of the parameters of (n, flat) pairs."""
    total, mean = 0, 0.0
    for n, flat in rows:
        flat = np.frombuffer(flat, dtype=np.float32).astype(np.float64)
        total += n
        mean = mean + (flat - mean) * (n / total)
    return total, mean


def _flat_batch(n: int, flat: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([n], type=pa.int64()),
         pa.array([flat.astype(np.float32).tobytes()], type=pa.binary())], ["n", "flat"])


def train_model(train: DataFrame, vocabulary: Vocabulary, sample: float = SAMPLE,
                rounds: int = ROUNDS, workers: int = WORKERS) -> Model:
    """Fit on ``train(doc_id, text)`` (on a seeded share of it if ``sample`` is below 1): every
    round the current parameters go to ``workers`` tasks or more, each trains on its part of the
    round's texts, a bounded number of symbols in memory at a time, and the results (one set of
    parameters per task) are averaged by the number of symbols, in ``MERGED`` tasks first."""
    return fit_network(cut(encode(train, vocabulary).select("doc_id", "s")), vocabulary, sample,
                       rounds, workers)


def fit_network(sequences: DataFrame, vocabulary: Vocabulary, sample: float = SAMPLE,
                rounds: int = ROUNDS, workers: int = WORKERS) -> Model:
    """``train_model`` on ``sequences(doc_id, s)``, stored rows of ``encode``, which every round
    reads once."""
    spark = sequences.sparkSession
    workers = max(workers, -int(-vocabulary.n * sample // (rounds * WORKER_SYMBOLS)))
    model = Model(vocabulary)
    draw = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 20))
    sampled = sequences.where(draw < int(sample * (1 << 20))).select(
        F.xxhash64("doc_id", F.lit(SEED + 1)).alias("h"), "s")
    for r in range(rounds):
        current = spark.sparkContext.broadcast(model)

        def work(batches):
            local, n, moments, step = Model.__new__(Model), 0, {}, 0
            local.head, local.classes = current.value.head, current.value.classes
            local.p = {k: v.copy() for k, v in current.value.p.items()}
            for rows in (run for batch in batches for run in _runs(batch.column(1))):
                more, step = _epoch(local, rows, moments, step)
                n += more
            if n:
                yield _flat_batch(n, np.concatenate([v.ravel() for v in local.p.values()]))

        def merge(batches):
            n, flat = _mean((a.as_py(), b.as_py()) for batch in batches
                            for a, b in zip(batch.column(0), batch.column(1)))
            if n:
                yield _flat_batch(n, flat)

        part = (sampled.where(F.pmod("h", F.lit(rounds)) == r).select("h", "s")
                .repartition(workers, "h").sortWithinPartitions("h"))
        trained = (part.mapInArrow(work, "n long, flat binary").repartition(MERGED)
                   .sortWithinPartitions("n", "flat").mapInArrow(merge, "n long, flat binary"))
        total, mean = _mean((row["n"], row["flat"]) for row in trained.collect())
        current.destroy()
        if total:
            at = 0
            for k, v in model.p.items():
                model.p[k] = mean[at:at + v.size].reshape(v.shape).astype(np.float32)
                at += v.size
    return model


def score_sequences(model: Model, docs: list[np.ndarray], side: int = 256,
                    window: int = 2 * WINDOW) -> np.ndarray:
    """Log-probability (natural) of every symbol sequence. Sequences run end to end on ``side``
    streams; their states go from window to window."""
    start = len(model.p["embed"]) - 1
    order, symbols, inputs, starts, lengths = _laid(docs, side, start)
    state = np.zeros((len(lengths), UNITS), dtype=np.float32)
    scores = np.zeros(len(symbols))
    at, end = 0, int(lengths.max(initial=0))
    while at < end:
        n = int((lengths > at).sum())
        steps = min(window * (side // n), end - at)
        here, live = _window(symbols, starts[:n], lengths[:n], at, steps)
        seen = np.where(live, _window(inputs, starts[:n], lengths[:n], at, steps)[0], start)
        h, _ = model.run(seen, state[:n])
        state = h[-1]
        place = (starts[:n] + np.arange(at, at + steps)[:, None])[live]
        scores[place] = model.outputs(h[live], here[live])
        at += steps
    out = np.zeros(len(docs))
    sizes = np.array([len(docs[k]) for k in order], dtype=np.int64)
    owner = np.repeat(order, sizes)
    return out + np.bincount(owner, weights=scores, minlength=len(docs))


def score_documents(docs: DataFrame, folds: int = 7, held_out: int = 2, sample: float = SAMPLE,
                    rounds: int = ROUNDS, workers: int = WORKERS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row of
    ``docs``.

    Tokens are the words of the lowered text and one end. Training texts are those of ids outside
    the held-out fold (NULL ids hash as the empty text). NULL and empty texts are one end token;
    without training texts every word is unknown; repeated rows are repeated in the result and
    counted each in training; an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    train = docs.where(crc_mod(F.col("doc_id"), folds) != held_out)
    path = scratch_path(spark, "counts")
    count_words(train).write.parquet(path)
    counts = spark.read.schema("w long, c long, tail int").parquet(path)
    vocabulary = Vocabulary(spark, counts)
    path = scratch_path(spark, "symbols")
    encoded = encode(docs, vocabulary)
    encoded.write.parquet(path)
    encoded = spark.read.schema(encoded.schema).parquet(path)
    model = fit_network(encoded.where(crc_mod(F.col("doc_id"), folds) != held_out), vocabulary,
                        sample, rounds, workers)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            network = np.concatenate([score_sequences(shared.value, rows)
                                      for rows in _runs(batch.column(0))] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.array(network / np.log(10))],
                [*batch.schema.names[1:], "network"])

    kept = encoded.select("row", "doc_id", "n_tokens", "hits", "base", "inner")
    schema = StructType([*kept.schema.fields, StructField("network", DoubleType())])
    path = scratch_path(spark, "scores")
    encoded.select("s", *kept.columns).mapInArrow(run, schema).write.parquet(path)
    made = spark.read.schema(schema).parquet(path)
    far = encoded.select("row", F.explode("rest").alias("x")).select("row", "x.w", "x.m")
    looked = far.join(counts, "w").groupBy("row").agg(
        F.sum("m").alias("more"), F.sum(F.col("m") * F.log10(F.col("c") + 1)).alias("gain"))
    gain = F.coalesce("gain", F.lit(0.0))
    return made.join(looked, "row", "left").select(
        "doc_id", (crc_mod(F.col("doc_id"), folds) == held_out).alias("held_out"), "n_tokens",
        (F.col("hits") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(vocabulary.n).cast("long").alias("train_tokens"),
        (F.col("base") + gain).alias("base_score"),
        (F.col("network") + F.col("inner") + gain).alias("score"))
