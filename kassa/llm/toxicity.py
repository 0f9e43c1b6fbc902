"""Toxicity: a bidirectional gated recurrent network with attention pooling,
trained in numpy, that scores all overlapping windows of a text.

Words: ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z.  Inputs of a
word: its own log-odds of toxic documents (word input), and the largest and the
mean log-odds of its character 3- to 6-grams with word ends (character inputs);
the log-odds are hashed tables, shrunk for rare entries.  A window of ``WINDOW``
words starts at every word that has so many from it on (a shorter text is one
window); both directions of the network read each window, attention pools the
states, and a text's score is that of its highest window.  A text without words
scores as a window without words: 0.

What the network makes of a word's inputs does not depend on the window, so it is
computed once a word; step t of all windows of a block then reads one slice.

Training uses a bounded sample: of the labelled documents handed in with at most
``MAX_TEXT`` bytes of text, ``MAX_TOXIC`` toxic and ``MAX_CLEAN`` others at most,
chosen by a hash of doc_id; every text is scored whole, whatever its length.  For
training, the tables of one half of the sample are those of the other half, so
the network sees odds as strong as on new texts.  With no toxic or no other
document in the sample, every score is 0.

Null text is empty text.  Rows, also repeated ones, are scored one by one; an
empty table gives an empty result; other columns are kept out of the score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from kassa.llm import text as T

WINDOW = 24
HIDDEN = 4
GRAMS = (3, 4, 5, 6)
BITS = 18
SHRINK = 4.0
MAX_TOXIC = 2000
MAX_CLEAN = 4000
MAX_TEXT = 16 << 10
THRESHOLD = 0.7
INPUTS = 4
_SPACE = np.uint8(0x20)


# ---- inputs


def _parted(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes with one blank for everything outside words, and the words."""
    joined = T.lower(np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8))
    joined[~T.ALNUM[joined]] = _SPACE
    sizes = np.array([len(t) for t in texts], np.int64)
    starts = 1 + np.append(0, np.cumsum(sizes + 1)[:-1]).astype(np.int64)
    first, last, bounds = T.word_spans(joined, starts, starts + sizes, T.ALNUM)
    return joined, first, last, bounds


def _gram_slots(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each width: table slot of the ``width`` bytes from each position on.  A
    width's sums are carried on from those of the one before."""
    base = np.uint32(0x01000193)
    codes = T.mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint32)[data]
    total = np.zeros(len(data), np.uint32)
    for k in range(max(GRAMS)):
        n = max(len(data) - k, 0)
        total = total[:n] * base
        total += codes[k : k + n]
        width = k + 1
        if width in GRAMS:
            slots = total + np.uint32(width * pow(int(base), width, 1 << 32) % (1 << 32))
            slots ^= slots >> np.uint32(15)
            slots *= np.uint32(0x2C1B3C6D)
            yield width, (slots >> np.uint32(32 - BITS)).astype(np.int32)


def _gram_ranges(first: np.ndarray, last: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Words with a gram of this width, and (from, to) of their grams, in turn."""
    some = np.flatnonzero(last - first + 2 >= width)
    ranges = np.empty(2 * len(some), np.int64)
    ranges[::2] = first[some] - 1
    ranges[1::2] = last[some] + 2 - width
    return some, ranges


def _word_slots(hashes) -> np.ndarray:
    return (hashes >> np.uint64(64 - BITS)).astype(np.int32)


def features(data, first, last, odds: dict) -> np.ndarray:
    """INPUTS x words.  Inputs hang on the word alone, so each distinct word of the
    block is looked up once."""
    if not len(first):
        return np.zeros((INPUTS, 0), np.float32)
    hashes = T.word_hashes(data, first, last)
    order = np.argsort(hashes)
    new = np.append(True, np.diff(hashes[order]) != 0)
    which = np.empty(len(first), np.int64)
    which[order] = np.cumsum(new) - 1
    one = order[new]
    hashes = hashes[one]
    size = last[one] - first[one]
    end = np.cumsum(size + 1)  # a blank before each word, and one at the end
    at = np.arange(int(end[-1]) + 1) - np.append(np.repeat(end - size, size + 1), end[-1])
    source = np.append(np.repeat(first[one], size + 1), 0) + at
    distinct = np.where(at < 0, _SPACE, data[source])
    distinct[-1] = _SPACE
    return np.take(_word_inputs(distinct, end - size, end, hashes, odds), which, axis=1)


def _word_inputs(data, first, last, hashes, odds: dict) -> np.ndarray:
    out = np.zeros((INPUTS, len(first)), np.float32)
    out[0] = odds["word"][_word_slots(hashes)]
    count = np.zeros(len(first), np.float32)
    for width, slots in _gram_slots(data):
        some, ranges = _gram_ranges(first, last, width)
        if not len(some):
            continue
        values = odds["gram"][slots]
        values = np.append(values, np.zeros(2, np.float32))
        out[1, some] = np.maximum(out[1, some], np.maximum.reduceat(values, ranges)[::2])
        out[2, some] += np.add.reduceat(values, ranges)[::2]
        count[some] += ranges[1::2] - ranges[::2]
    out[2] /= np.maximum(count, 1)
    out[3] = 1
    return out


def _odds(texts: list[bytes], toxic: np.ndarray) -> dict:
    """Log-odds of toxic documents by word slot and by gram slot."""
    size = 1 << BITS
    counts = {"word": np.zeros((2, size), np.float32), "gram": np.zeros((2, size), np.float32)}
    for text, label in zip(texts, toxic.astype(int).tolist(), strict=True):
        data, first, last, _ = _parted([text])
        if not len(first):
            continue
        counts["word"][label, np.unique(_word_slots(T.word_hashes(data, first, last)))] += 1
        seen = []
        for width, slots in _gram_slots(data):
            some, ranges = _gram_ranges(first, last, width)
            if len(some):
                inside = np.zeros(len(data) + 1, np.int32)
                np.add.at(inside, ranges[::2], 1)
                np.add.at(inside, ranges[1::2], -1)
                seen.append(slots[np.cumsum(inside)[: len(slots)] > 0])
        if seen:
            counts["gram"][label, np.unique(np.concatenate(seen))] += 1
    n_toxic = max(float(toxic.sum()), 1.0)
    n_clean = max(float(len(toxic) - toxic.sum()), 1.0)
    out = {}
    for name, (clean, bad) in counts.items():
        odds = np.log((bad + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))
        # entries seen in few documents say little
        out[name] = (odds * (bad + clean) / (bad + clean + SHRINK) / 3).astype(np.float32)
    return out


def windows(bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of every window, and its document: a window at each word that
    has ``WINDOW`` words from it on, or one window of a shorter document."""
    n = np.diff(bounds)
    many = np.where(n > 0, np.maximum(n - WINDOW, 0) + 1, 0)
    doc = np.repeat(np.arange(len(n)), many)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
    return bounds[:-1][doc] + k, doc


# ---- network


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def new_parameters(seed: int = 7) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    p = {}
    for side in ("f", "b"):
        p["W" + side] = rng.normal(0, 0.5, (3 * HIDDEN, INPUTS))
        p["U" + side] = rng.normal(0, 0.4, (3 * HIDDEN, HIDDEN))
    p["v"] = rng.normal(0, 0.5, 2 * HIDDEN)
    p["w"] = rng.normal(0, 0.5, 2 * HIDDEN)
    p["c"] = np.array([-1.0])
    return {k: x.astype(np.float32) for k, x in p.items()}


def _gru(x: np.ndarray, live: np.ndarray, W, U, order, keep: bool):
    """x: T x INPUTS x N; live: T x N.  States T x HIDDEN x N; what backward needs."""
    steps, _, n = x.shape
    h = np.zeros((HIDDEN, n), np.float32)
    states = np.zeros((steps, HIDDEN, n), np.float32)
    tape = []
    H = HIDDEN
    for t in order:
        a = W @ x[t]
        b = U @ h
        z = _sigmoid(a[:H] + b[:H])
        r = _sigmoid(a[H : 2 * H] + b[H : 2 * H])
        g = np.tanh(a[2 * H :] + r * b[2 * H :])
        new = np.where(live[t], g + z * (h - g), h)
        if keep:
            tape.append((t, h, z, r, g, b[2 * H :]))
        h = new
        states[t] = h
    return states, tape


def forward(p: dict, x: np.ndarray, live: np.ndarray, keep: bool = False):
    steps = len(x)
    f, tape_f = _gru(x, live, p["Wf"], p["Uf"], range(steps), keep)
    b, tape_b = _gru(x, live, p["Wb"], p["Ub"], range(steps - 1, -1, -1), keep)
    h = np.concatenate([f, b], axis=1)
    s = np.where(live, np.einsum("k,tkn->tn", p["v"], h), -1e9)
    s = np.exp(s - s.max(axis=0))
    s /= s.sum(axis=0)
    pooled = np.einsum("tn,tkn->kn", s, h)
    logit = p["w"] @ pooled + p["c"][0]
    return logit, (h, s, pooled, tape_f, tape_b)


def backward(p: dict, x, live, held, d_logit) -> dict:
    h, s, pooled, tape_f, tape_b = held
    g = {"w": pooled @ d_logit, "c": np.array([d_logit.sum()], np.float32)}
    d_pooled = p["w"][:, None] * d_logit
    d_s = np.einsum("kn,tkn->tn", d_pooled, h)
    d_score = s * (d_s - (s * d_s).sum(axis=0))
    g["v"] = np.einsum("tn,tkn->k", d_score, h)
    d_h = s[:, None, :] * d_pooled[None] + d_score[:, None, :] * p["v"][None, :, None]
    H = HIDDEN
    for side, tape, part in (("f", tape_f, slice(0, H)), ("b", tape_b, slice(H, 2 * H))):
        W, U = p["W" + side], p["U" + side]
        g_w, g_u = np.zeros_like(W), np.zeros_like(U)
        carry = np.zeros((H, x.shape[2]), np.float32)
        for t, before, z, r, n, bn in reversed(tape):
            d = d_h[t, part] + carry
            own = np.where(live[t], d, 0)
            d_n = own * (1 - z) * (1 - n * n)
            d_z = own * (before - n) * z * (1 - z)
            d_r = d_n * bn * r * (1 - r)
            d_a = np.concatenate([d_z, d_r, d_n])
            d_b = np.concatenate([d_z, d_r, d_n * r])
            g_w += d_a @ x[t].T
            g_u += d_b @ before.T
            carry = U.T @ d_b + own * z + (d - own)
        g["W" + side], g["U" + side] = g_w, g_u
    return g


def _gather(x: np.ndarray, first: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of windows: T x INPUTS x N, and which steps hold a word."""
    at = first[None, :] + np.arange(WINDOW)[:, None]
    live = at < end[None, :]
    return np.ascontiguousarray(x[:, np.where(live, at, 0)].transpose(1, 0, 2)), live


def _slide(a: np.ndarray, U: np.ndarray, read: np.ndarray, order, n: int, out: np.ndarray) -> None:
    """Add ``read @ state`` (2 x n) of every step to ``out`` (WINDOW x 2 x n), for
    the windows that start at words 0 to n - 1.  Gates' rows are halved, as a
    sigmoid is a tanh of half its argument."""
    H = HIDDEN
    h = np.zeros((H, n), np.float32)
    gates, g, b = (np.empty((k, n), np.float32) for k in (2 * H, H, 3 * H + 2))
    both = np.concatenate([U, read])  # a state is read with the next step's product
    last = None
    for step, t in enumerate(order):
        at = a[:, t : t + n]
        if step == 0:  # from a state of zeros the reset gate and U have no part
            np.tanh(at[:H], out=gates[:H])
            np.tanh(at[2 * H :], out=h)
            gates[:H] *= -0.5
            gates[:H] += 0.5
            h *= gates[:H]
            last = t
            continue
        np.matmul(both, h, out=b)
        out[last] += b[3 * H :]
        np.add(at[: 2 * H], b[: 2 * H], out=gates)
        np.tanh(gates, out=gates)
        gates *= 0.5
        gates += 0.5
        np.multiply(gates[H:], b[2 * H : 3 * H], out=g)
        g += at[2 * H :]
        np.tanh(g, out=g)
        h -= g
        h *= gates[:H]
        h += g
        last = t
    out[last] += read @ h


def window_scores(p: dict, x: np.ndarray, bounds: np.ndarray, part: int = 4096) -> tuple[np.ndarray, ...]:
    """Logit, first word and document of all windows."""
    first, doc = windows(bounds)
    out = np.empty(len(first), np.float32)
    H = HIDDEN
    half = np.concatenate([np.full(2 * H, 0.5), np.ones(H)]).astype(np.float32)[:, None]
    sides = [
        (half * p["W" + d], half * p["U" + d], np.stack([p["v"][own], p["w"][own]]))
        for d, own in (("f", slice(0, H)), ("b", slice(H, 2 * H)))
    ]
    whole = first + WINDOW <= bounds[1:][doc]
    at = np.flatnonzero(whole)
    place = first[at]  # rising
    i = 0
    while i < len(place):
        # windows that start within `part` words of this one
        j = int(np.searchsorted(place, place[i] + part))
        low, n = int(place[i]), int(place[j - 1] - place[i]) + 1
        read = np.zeros((WINDOW, 2, n), np.float32)
        inputs = x[:, low : low + n + WINDOW - 1]
        for (W, U, weights), order in zip(sides, (range(WINDOW), range(WINDOW - 1, -1, -1)), strict=True):
            _slide(W @ inputs, U, weights, order, n, read)
        s = read[:, 0]
        s -= s.max(axis=0)
        np.exp(s, out=s)
        logit = (s * read[:, 1]).sum(axis=0) / s.sum(axis=0) + p["c"][0]
        out[at[i:j]] = logit[place[i:j] - low]
        i = j
    short = np.flatnonzero(~whole)
    for a in range(0, len(short), part):
        own = short[a : a + part]
        out[own] = forward(p, *_gather(x, first[own], bounds[1:][doc[own]]))[0]
    return out, first, doc


def train(texts: list[bytes], toxic: np.ndarray, rounds: int = 10, steps: int = 160, seed: int = 7) -> dict | None:
    """Model from documents and their labels; None without both kinds."""
    toxic = np.asarray(toxic, bool)
    if toxic.all() or not toxic.any():
        return None
    rng = np.random.default_rng(seed)
    half = np.zeros(len(texts), bool)
    for kind in (toxic, ~toxic):
        own = rng.permutation(np.flatnonzero(kind))
        half[own[::2]] = True
    x, bounds, labels = [], [0], []
    for mine in (half, ~half):
        odds = _odds([t for t, m in zip(texts, mine, strict=True) if not m], toxic[~mine])
        own = [t for t, m in zip(texts, mine, strict=True) if m]
        for at in range(0, len(own), 200):  # a few texts at a time, to keep the driver small
            data, first, last, b = _parted(own[at : at + 200])
            x.append(features(data, first, last, odds))
            bounds.extend((b[1:] + bounds[-1]).tolist())
        labels.append(toxic[mine])
    inputs, ends, label = np.concatenate(x, axis=1), np.array(bounds), np.concatenate(labels)
    del x
    p = new_parameters(seed)
    moment = {k: np.zeros_like(v) for k, v in p.items()}
    square = {k: np.zeros_like(v) for k, v in p.items()}
    first, doc = windows(ends)
    # before training, a window is judged by its strongest input
    peak = np.maximum(inputs[0], inputs[1])
    rank = peak[first]
    for t in range(1, WINDOW):
        at = np.minimum(first + t, ends[1:][doc] - 1)
        np.maximum(rank, peak[at], out=rank)
    step = 0
    for number in range(rounds):
        if number:
            rank = window_scores(p, inputs, ends)[0]
        order = np.lexsort((rank, doc))
        top = order[np.append(doc[order][1:] != doc[order][:-1], True)]
        # a clean document's every window is clean: some of its others too; each round
        # looks at all windows again for the highest of each document
        others = rng.permutation(np.flatnonzero(~label[doc]))[: len(top)]
        chosen = np.concatenate([top, others])
        for _ in range(steps):  # the same work for a sample of any size
            own = rng.choice(chosen, 256)
            xs, live = _gather(inputs, first[own], ends[1:][doc[own]])
            y = label[doc[own]].astype(np.float32)
            logit, held = forward(p, xs, live, keep=True)
            g = backward(p, xs, live, held, ((_sigmoid(logit) - y) / len(own)).astype(np.float32))
            step += 1
            for k in p:
                moment[k] = 0.9 * moment[k] + 0.1 * g[k]
                square[k] = 0.999 * square[k] + 0.001 * g[k] ** 2
                rate = 0.01 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                p[k] = (p[k] - rate * moment[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)
    return {"network": p, "odds": _odds(texts, toxic)}


def score_texts(model: dict, texts: list[bytes]) -> np.ndarray:
    data, first, last, bounds = _parted(texts)
    logit, _, doc = window_scores(model["network"], features(data, first, last, model["odds"]), bounds)
    best = np.full(len(texts), -np.inf)
    np.maximum.at(best, doc, logit)
    out = np.zeros(len(texts))
    some = np.isfinite(best)
    out[some] = _sigmoid(best[some])
    return out


# ---- on Spark


def training_sample(docs: DataFrame, labels: DataFrame, max_toxic: int, max_clean: int) -> tuple[list, np.ndarray]:
    """Texts and labels of at most ``max_toxic + max_clean`` labelled documents of
    at most ``MAX_TEXT`` bytes: that bounds what comes to the driver."""
    ranked = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").select("doc_id", "toxic").distinct()
    picked = [
        ranked.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
        for kind, most in ((1, max_toxic), (0, max_clean))
    ]
    # at most max_toxic + max_clean rows of two numbers: a proven bound
    small = docs.select("doc_id", "text").where(F.coalesce(F.octet_length("text"), F.lit(0)) <= MAX_TEXT)
    rows = small.join(F.broadcast(picked[0].union(picked[1])), "doc_id")
    rows = sorted((r.doc_id, r.toxic, (r.text or "").encode()) for r in rows.distinct().toLocalIterator())
    return [r[2] for r in rows], np.array([r[1] for r in rows], bool)


def fit(docs: DataFrame, labels: DataFrame, max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> dict | None:
    """Model from the labelled documents among ``labels(doc_id, toxic)``."""
    return train(*training_sample(docs, labels, max_toxic, max_clean))


def score(docs: DataFrame, model: dict | None, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` but the text, and ``score`` (double)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    held = docs.sparkSession.sparkContext.broadcast(model)
    source = docs.select(*[c for c in docs.columns if c != "score"])
    out = StructType([f for f in source.schema.fields if f.name != text_col]).add("score", DoubleType())
    schema = to_arrow_schema(out)

    def run(batches):
        for block in T.blocks(batches, text_col):
            texts = [block.text(i) for i in range(len(block))]
            values = np.zeros(len(texts)) if held.value is None else score_texts(held.value, texts)
            table = dict(zip(block.batch.schema.names, block.batch.columns, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(values) if f.name == "score" else table[f.name].cast(f.type) for f in schema], schema=schema
            )

    return source.mapInArrow(run, out)
