"""Toxicity: a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as its word vector (words known from the training sample, one shared vector for the rest), the
mean vector of its character trigrams and a vector of its first characters. Two recurrent layers read a
window of words in both directions, attention pools their states, and a logit follows. Every text is
scored over the whole of it: overlapping windows start half a window apart, the last one is flush with the
end. Its score comes from the highest window logit, the expected number of toxic windows and their share,
by a logistic curve fitted to documents the network was not trained on.

Training is on a bounded sample of labelled rows (``sample_docs`` a class, texts up to ``sample_chars``),
chosen by a hash of the id and held by the driver. Labels belong to documents, not to windows, so the
windows of a toxic document that look worst so far are the positives, chosen anew as training goes on.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from affinity.llm.shared import in_fold, received, sent, slices_of, staged

WORDS = re.compile(r"[^\W_]+")
TRIGRAMS, SLOTS, OPENING = 1 << 13, 1 << 17, 5
#: odd multipliers of the feature hashes (arbitrary, fixed)
A, B, C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
WORDS_AT_ONCE = 200_000
SCORE_PLACES = 6


@dataclass
class Words:
    """The words of a text: their hashes and, end to end, the trigram ids of each."""

    keys: np.ndarray
    grams: np.ndarray
    first: np.ndarray  # of each word's trigrams
    sizes: np.ndarray
    opening: np.ndarray  # hash of the first characters


def read_words(text: str | None) -> Words:
    """Words are runs of letters and digits of the lower-cased text; a trigram is centred on each character."""
    runs = WORDS.findall((text or "").lower())
    if not runs:
        empty = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), empty, empty, empty, empty)
    codes = np.frombuffer(f" {' '.join(runs)} ".encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    h = codes[:-2] * A + codes[1:-1] * B + codes[2:] * C
    h ^= h >> np.uint64(29)
    h *= B
    sizes = np.fromiter(map(len, runs), np.int64, len(runs))
    first = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    spot = np.arange(len(h), dtype=np.int64) - np.repeat(first, sizes + 1)[: len(h)]
    letter = np.ones(len(h), bool)
    letter[(first[1:] - 1)] = False
    spread = (h + spot.astype(np.uint64) * C) * A
    spread ^= spread >> np.uint64(32)
    own = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    start = np.zeros(len(runs), np.uint64)
    for k in range(OPENING):
        start = np.where(sizes > k, start * A + codes[np.minimum(first + 1 + k, len(codes) - 1)], start)
    start = (start ^ (start >> np.uint64(31))) * B
    return Words(
        np.add.reduceat((spread * B)[letter], own),
        ((h >> np.uint64(40)) % np.uint64(TRIGRAMS)).astype(np.int32)[letter],
        own,
        sizes,
        ((start >> np.uint64(40)) % np.uint64(TRIGRAMS)).astype(np.int32),
    )


def windows_of(n: int, size: int) -> np.ndarray:
    """First words of the overlapping windows of a text of ``n`` words: half a window apart, the last flush
    with the end; a text shorter than a window has one."""
    step = max(1, size // 2)
    if n <= size:
        return np.zeros(1, np.int64)
    return np.append(np.arange(0, n - size, step), n - size)


def product(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    """``x @ w`` in double precision, rounded to single: the last digits of a single-precision product follow the
    place of a row among the others, those of a text's score must not."""
    return (x.astype(np.float64) @ w).astype(np.float32)


def sigmoid(x):
    return 0.5 * np.tanh(0.5 * x) + 0.5


@dataclass
class Network:
    """Parameters ``p`` and the vocabulary: two tables by hash slot, the word number and the rest of its hash."""

    window: int
    hidden: int
    number: np.ndarray
    check: np.ndarray
    p: dict = field(default_factory=dict)
    scale: tuple = (1.0, 0.0, 0.0, 0.0)

    @classmethod
    def fresh(cls, keys: np.ndarray, window: int, hidden: int, word_dim: int, char_dim: int, open_dim: int, rng) -> "Network":
        number, check = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.uint64)
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        number[slot] = np.arange(1, len(keys) + 1)
        check[slot] = keys
        draw = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)
        d, h = word_dim + char_dim + open_dim, hidden
        p = {
            "word": rng.normal(0, 0.1, (len(keys) + 1, word_dim)).astype(np.float32),
            "char": rng.normal(0, 0.3, (TRIGRAMS, char_dim)).astype(np.float32),
            "open": rng.normal(0, 0.1, (TRIGRAMS, open_dim)).astype(np.float32),
            "attend": draw(2 * h, 2 * h),
            "attend_b": np.zeros(2 * h, np.float32),
            "attend_v": draw(2 * h),
            "out": draw(2 * h),
            "out_b": np.zeros(1, np.float32),
        }
        for s in "fb":
            p |= {f"in_{s}": draw(d, 3 * h), f"bias_{s}": np.zeros(3 * h, np.float32)}
            p |= {f"gate_{s}": draw(h, 2 * h), f"cand_{s}": draw(h, h)}
        return cls(window, hidden, number, check, p)

    def word_numbers(self, keys: np.ndarray) -> np.ndarray:
        slot = (keys & np.uint64(SLOTS - 1)).astype(np.int64)
        return np.where(self.check[slot] == keys, self.number[slot], 0)

    def inputs(self, words: Words, numbers: np.ndarray) -> np.ndarray:
        """Word vectors beside the mean of the trigram vectors and the vectors of the first characters."""
        if not len(words.keys):
            return np.zeros((0, len(self.p["in_f"])), np.float32)
        chars = np.add.reduceat(self.p["char"][words.grams], words.first, axis=0) / words.sizes[:, None].astype(np.float32)
        return np.concatenate([self.p["word"][numbers], chars, self.p["open"][words.opening]], axis=1)

    def _read(self, pre, mask, s, keep):
        """States of one direction; ``pre`` (time x batch x 3h) are the projected inputs."""
        h, p = self.hidden, self.p
        times = np.matmul if keep else product
        state = np.zeros((pre.shape[1], h), np.float32)
        out, tape = np.empty((*pre.shape[:2], h), np.float32), []
        for t in range(len(pre)) if s == "f" else reversed(range(len(pre))):
            gates = sigmoid(pre[t, :, : 2 * h] + times(state, p[f"gate_{s}"]))
            z, r = gates[:, :h], gates[:, h:]
            cand = np.tanh(pre[t, :, 2 * h :] + times(r * state, p[f"cand_{s}"]))
            new = state + z * (cand - state)
            if mask is not None:
                new = np.where(mask[t][:, None], new, state)
            if keep:
                tape.append((t, state, z, r, cand))
            state = out[t] = new
        return out, tape

    def forward(self, pre_f, pre_b, mask=None, keep=False):
        """Logit per window, and what a backward pass needs."""
        p = self.p
        hf, tape_f = self._read(pre_f, mask, "f", keep)
        hb, tape_b = self._read(pre_b, mask, "b", keep)
        h = np.concatenate([hf, hb], axis=2)
        times = np.matmul if keep else product
        a = np.tanh(times(h, p["attend"]) + p["attend_b"])
        e = times(a, p["attend_v"])
        if mask is not None:
            e = np.where(mask, e, np.float32(-1e4))
        e = np.exp(e - e.max(axis=0))
        weight = e / e.sum(axis=0)
        pooled = (weight[:, :, None] * h).sum(axis=0)
        return times(pooled, p["out"]) + p["out_b"][0], (h, a, weight, pooled, tape_f, tape_b, mask)

    def backward(self, x, saved, d_logit):
        """Gradients of the parameters (embeddings apart) and of the inputs ``x`` (time x batch x d)."""
        h, a, weight, pooled, tape_f, tape_b, mask = saved
        p, n = self.p, self.hidden
        g = {"out": pooled.T @ d_logit, "out_b": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["out"]
        d_h = weight[:, :, None] * d_pooled
        d_w = np.einsum("bh,tbh->tb", d_pooled, h)
        d_e = weight * (d_w - (weight * d_w).sum(axis=0))
        g["attend_v"] = np.einsum("tb,tbk->k", d_e, a)
        d_a = d_e[:, :, None] * p["attend_v"] * (1 - a * a)
        g["attend"] = np.einsum("tbh,tbk->hk", h, d_a, optimize=True)
        g["attend_b"] = d_a.sum(axis=(0, 1))
        d_h += d_a @ p["attend"].T
        d_x = np.zeros_like(x)
        for s, tape, d_out in (("f", tape_f, d_h[:, :, :n]), ("b", tape_b, d_h[:, :, n:])):
            gate, cand_w = p[f"gate_{s}"], p[f"cand_{s}"]
            g |= {f"gate_{s}": np.zeros_like(gate), f"cand_{s}": np.zeros_like(cand_w)}
            d_pre = np.zeros((*x.shape[:2], 3 * n), np.float32)
            carry = np.zeros((x.shape[1], n), np.float32)
            for t, state, z, r, cand in reversed(tape):
                d_new, skipped = carry + d_out[t], 0.0
                if mask is not None:
                    skipped = np.where(mask[t][:, None], 0, d_new)
                    d_new = np.where(mask[t][:, None], d_new, 0)
                d_cand = d_new * z * (1 - cand * cand)
                d_z = d_new * (cand - state) * z * (1 - z)
                d_rs = d_cand @ cand_w.T
                d_r = d_rs * state * r * (1 - r)
                d_gate = np.concatenate([d_z, d_r], axis=1)
                carry = d_new * (1 - z) + d_rs * r + d_gate @ gate.T + skipped
                g[f"gate_{s}"] += state.T @ d_gate
                g[f"cand_{s}"] += (r * state).T @ d_cand
                d_pre[t, :, : 2 * n], d_pre[t, :, 2 * n :] = d_gate, d_cand
            g[f"in_{s}"] = np.einsum("tbd,tbk->dk", x, d_pre, optimize=True)
            g[f"bias_{s}"] = d_pre.sum(axis=(0, 1))
            d_x += d_pre @ p[f"in_{s}"].T
        return g, d_x

    def logits(self, words: Words) -> np.ndarray:
        """Logit of every overlapping window of a text; for a text without words, that of an empty window."""
        n = len(words.keys)
        x = self.inputs(words, self.word_numbers(words.keys))
        first, size = windows_of(n, self.window), min(max(n, 1), self.window)
        pre = [product(x, self.p[f"in_{s}"]) + self.p[f"bias_{s}"] for s in "fb"]
        if not n:
            pre = [np.broadcast_to(self.p[f"bias_{s}"], (1, 3 * self.hidden)) for s in "fb"]
        found = []
        for at in range(0, len(first), 4096):
            take = first[at : at + 4096] + np.arange(size)[:, None]
            found.append(self.forward(pre[0][take], pre[1][take])[0])
        return np.concatenate(found)

    def window_logits(self, texts: list[Words]) -> list[np.ndarray]:
        """As ``logits`` for each text, for texts of ``WORDS_AT_ONCE`` words at a time."""
        found, held, size = [], [], 0
        for w in texts:
            held.append(w)
            size += len(w.keys)
            if size >= WORDS_AT_ONCE // 4:  # bounds the memory of the trigram vectors
                found += self._joint_logits(held)
                held, size = [], 0
        return found + self._joint_logits(held)

    def _joint_logits(self, texts: list[Words]) -> list[np.ndarray]:
        full = [w for w in texts if len(w.keys) >= self.window]
        result = {}
        if full:
            grams = np.concatenate([w.grams for w in full])
            count = np.array([len(w.keys) for w in full])
            n_grams = np.array([len(w.grams) for w in full])
            shift = np.concatenate(([0], np.cumsum(n_grams)[:-1]))
            joint = Words(
                np.concatenate([w.keys for w in full]),
                grams,
                np.concatenate([w.first + s for w, s in zip(full, shift)]),
                np.concatenate([w.sizes for w in full]),
                np.concatenate([w.opening for w in full]),
            )
            x = self.inputs(joint, self.word_numbers(joint.keys))
            pre = [product(x, self.p[f"in_{s}"]) + self.p[f"bias_{s}"] for s in "fb"]
            base = np.concatenate(([0], np.cumsum(count)[:-1]))
            spans = [windows_of(int(c), self.window) + b for c, b in zip(count, base)]
            first, found = np.concatenate(spans), []
            for at in range(0, len(first), 1024):
                take = first[at : at + 1024] + np.arange(self.window)[:, None]
                found.append(self.forward(pre[0][take], pre[1][take])[0])
            cuts = np.cumsum([len(s) for s in spans])[:-1]
            result = {id(w): v for w, v in zip(full, np.split(np.concatenate(found), cuts))}
        return [result[id(w)] if id(w) in result else self.logits(w) for w in texts]

    def score(self, best: float, expected: float, windows: int) -> float:
        return round(float(sigmoid(np.dot(self.scale, summary(best, expected, windows)))), SCORE_PLACES)


def summary(best: float, expected: float, windows: int) -> list[float]:
    """What the score of a text depends on: the highest window logit, the expected number of toxic windows
    and their share, and a constant."""
    return [float(best), float(np.log(expected + 0.05)), float(np.log(expected / windows + 1e-3)), 1.0]


def slices(words: Words, window: int):
    """A very long text in parts that overlap by a window, so that memory is bounded."""
    n = len(words.keys)
    if n <= WORDS_AT_ONCE:
        yield words
        return
    for at in range(0, n, WORDS_AT_ONCE):
        to = min(n, at + WORDS_AT_ONCE + window)
        a, b = words.first[at], words.first[to - 1] + words.sizes[to - 1]
        yield Words(words.keys[at:to], words.grams[a:b], words.first[at:to] - a, words.sizes[at:to], words.opening[at:to])
        if to == n:
            return


class _Adam:
    def __init__(self, p, rate):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, p, g):
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, d in g.items():
            self.m[k] += 0.1 * (d - self.m[k])
            self.v[k] += 0.001 * (d * d - self.v[k])
            p[k] -= (self.rate * fix) * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)


def _log_ratio(ids: list[np.ndarray], y: np.ndarray, size: int) -> np.ndarray:
    """Per feature, the smoothed log ratio of its document shares in toxic and clean texts."""
    n = [np.zeros(size), np.zeros(size)]
    for i, label in zip(ids, y):
        n[int(label)][np.unique(i)] += 1
    rate = [(c + 1.0) / (max(1, int((y == k).sum())) + 2.0) for k, c in enumerate(n)]
    seen = n[0] + n[1]
    return (np.log(rate[1]) - np.log(rate[0])) * seen / (seen + 5.0)


def train(
    texts: list[str],
    labels: list[int],
    window: int = 24,
    hidden: int = 8,
    word_dim: int = 8,
    char_dim: int = 8,
    open_dim: int = 4,
    epochs: int = 6,
    batch: int = 256,
    rate: float = 0.01,
    min_docs: int = 8,
    min_steps: int = 240,
    seed: int = 7,
) -> Network:
    """A network fitted to document labels; every fourth text only calibrates the score.

    An empty text counts as one more clean text. Small samples are passed more often than ``epochs``, for
    at least ``min_steps`` steps.
    """
    rng = np.random.default_rng(seed)
    y = np.asarray([*labels, 0] if len(labels) else [], np.int64)
    words = [read_words(t) for t in ([*texts, ""] if len(labels) else [])]
    part = np.arange(len(words)) % 4 != 3
    part[-1:] = True
    keys, docs_with = np.unique(
        np.concatenate([np.unique(w.keys) for w, own in zip(words, part) if own] or [np.zeros(0, np.uint64)]),
        return_counts=True,
    )
    net = Network.fresh(keys[docs_with >= min_docs], window, hidden, word_dim, char_dim, open_dim, rng)
    if not len(y[part]) or len(set(y[part].tolist())) < 2:
        rate_of_one = (y.sum() + 0.5) / (len(labels) + 1.0) if len(labels) else 0.0
        net.scale = (0.0, 0.0, 0.0, float(np.log(rate_of_one / (1 - rate_of_one))) if 0 < rate_of_one < 1 else -5.0)
        return net
    numbers = [net.word_numbers(w.keys) for w in words]
    # a first guess of what is toxic: the log ratios are one component of either vector
    train_docs = np.nonzero(part)[0]
    own_y = y[train_docs]
    word_ratio = _log_ratio([numbers[i] for i in train_docs], own_y, len(net.p["word"]))
    word_ratio[0] = 0
    char_ratio = _log_ratio([words[i].grams for i in train_docs], own_y, TRIGRAMS)
    open_ratio = _log_ratio([words[i].opening for i in train_docs], own_y, TRIGRAMS)
    net.p["word"][:, 0], net.p["char"][:, 0], net.p["open"][:, 0] = word_ratio, char_ratio, open_ratio
    guess = []
    for i in range(len(words)):
        w = words[i]
        value = np.maximum(word_ratio[numbers[i]], open_ratio[w.opening])
        if len(w.keys):
            value = np.maximum(value, np.add.reduceat(char_ratio[w.grams], w.first) / w.sizes)
        first = windows_of(len(w.keys), window)
        guess.append(np.array([value[a : a + window].max() if len(value) else -9.0 for a in first]))

    def chosen(ranks):
        """(text, first word, label): the worst windows of toxic texts; of clean ones the worst and any other."""
        rows = []
        for i in train_docs:
            first, r = windows_of(len(words[i].keys), window), ranks[i]
            top = np.argsort(-r, kind="stable")[:2]
            if y[i]:
                rows += [(i, first[j], 1) for j in top if r[j] >= r[top[0]] - 1.0]
            else:
                rows += [(i, first[j], 0) for j in {*top.tolist(), int(rng.integers(len(first)))}]
        return rows + [(len(words) - 1, 0, 0)] * (len(rows) // 50)

    optimiser = _Adam(net.p, rate)
    rows = chosen(guess)
    epochs = max(epochs, -(-min_steps * batch // max(1, len(rows))))
    for epoch in range(epochs):
        if epoch in (epochs // 3, 2 * epochs // 3):
            rows = chosen(net.window_logits(words))
        balance = max(1.0, min(8.0, sum(1 for r in rows if not r[2]) / max(1, sum(r[2] for r in rows)) / 2))
        order = rng.permutation(len(rows))
        optimiser.rate = rate * (1 - epoch / (epochs + 1))
        for at in range(0, len(order), batch):
            picked = [rows[j] for j in order[at : at + batch]]
            _train_step(net, optimiser, picked, words, numbers, balance, rng)
    # calibration on texts the network has not seen
    rest = np.nonzero(~part)[0]
    if len(set(y[rest].tolist())) < 2:
        rest = np.arange(len(y))
    found = net.window_logits([words[i] for i in rest])
    net.scale = _calibrate(np.array([summary(v.max(), sigmoid(v).sum(), len(v)) for v in found]), y[rest])
    return net


def _train_step(net, optimiser, picked, words, numbers, balance, rng) -> None:
    size, p = net.window, net.p
    word_dim, to_open = p["word"].shape[1], p["word"].shape[1] + p["char"].shape[1]
    opening = np.zeros((size, len(picked)), np.int64)
    number = np.zeros((size, len(picked)), np.int64)
    mask = np.zeros((size, len(picked)), bool)
    grams, owner, n_of = [], [], []
    for b, (i, at, _) in enumerate(picked):
        w = words[i]
        to = min(len(w.keys), at + size)
        k = to - at
        if k <= 0:
            mask[0, b] = True
            continue
        number[:k, b], mask[:k, b], opening[:k, b] = numbers[i][at:to], True, w.opening[at:to]
        grams.append(w.grams[w.first[at] : w.first[to - 1] + w.sizes[to - 1]])
        owner.append(np.repeat(np.arange(k) * len(picked) + b, w.sizes[at:to]))
        n_of.append(w.sizes[at:to])
    number[rng.random(number.shape) < 0.3] = 0  # at times only the characters speak
    x = np.zeros((size * len(picked), len(p["in_f"])), np.float32)
    x[:, to_open:] = np.where(mask[..., None], p["open"][opening], 0).reshape(len(x), -1)
    x[:, :word_dim] = np.where(mask[..., None], p["word"][number], 0).reshape(-1, word_dim)
    if grams:
        grams, owner = np.concatenate(grams), np.concatenate(owner)
        share = (1 / np.repeat(np.concatenate(n_of), np.concatenate(n_of))).astype(np.float32)[:, None]
        np.add.at(x[:, word_dim:to_open], owner, p["char"][grams] * share)
    x = x.reshape(size, len(picked), -1)
    pre = [x @ p[f"in_{s}"] + p[f"bias_{s}"] for s in "fb"]
    logit, saved = net.forward(*pre, mask=mask, keep=True)
    label = np.array([r[2] for r in picked], np.float32)
    weight = np.where(label == 1, np.float32(balance), np.float32(1))
    d_logit = (weight * (sigmoid(logit) - label) / weight.sum()).astype(np.float32)
    g, d_x = net.backward(x, saved, d_logit)
    flat = d_x.reshape(-1, d_x.shape[2])
    g["word"] = np.zeros_like(p["word"])
    np.add.at(g["word"], number.reshape(-1), np.where(mask.reshape(-1, 1), flat[:, :word_dim], 0))
    g["open"] = np.zeros_like(p["open"])
    np.add.at(g["open"], opening.reshape(-1), np.where(mask.reshape(-1, 1), flat[:, to_open:], 0))
    g["char"] = np.zeros_like(p["char"])
    if len(grams):
        np.add.at(g["char"], grams, flat[owner, word_dim:to_open] * share)
    optimiser.step(p, g)


def _calibrate(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple:
    """Weights of a logistic curve over text summaries: Newton steps, halved until the penalised loss falls."""
    start = np.array([1.0, 0.0, 0.0, 0.0])

    def loss(w):
        z = x @ w
        return float((np.logaddexp(0, z) - y * z).sum() + 0.15 * ((w - start) ** 2).sum())

    w, now = start, loss(start)
    for _ in range(rounds):
        p = sigmoid(x @ w)
        grad = x.T @ (p - y) + 0.3 * (w - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.3 * np.eye(4), grad)
        size = 1.0
        while size > 1e-6 and loss(w - size * step) > now:
            size /= 2
        new = loss(w - size * step)
        if new >= now - 1e-9:
            break
        w, now = w - size * step, new
    return tuple(w.tolist())


# ---- on tables -----------------------------------------------------------------------------------


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: Column | None = None,
    sample_docs: int = 1500,
    sample_chars: int = 20_000,
    long_docs: int = 8,
    long_chars: int = 100_000,
    **options,
) -> Network:
    """A network learnt from labelled rows: about ``sample_docs`` toxic and twice as many clean ones with at most
    ``sample_chars`` characters, and of the longer ones up to ``long_docs`` of each class with at most
    ``long_chars``, chosen by a hash of the id. Null labels are not used; several labels of an id are one (the
    largest), and so are several texts (the smallest)."""
    known = (
        labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("id"))
        .agg(F.max(F.col(label_col).cast("int")).alias("label"))
    )
    if train_rows is not None:
        known = known.withColumn(id_col, F.col("id")).where(train_rows).select("id", "label")
    known = known.where("label in (0, 1)")
    count = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    want = {0: 2 * sample_docs, 1: sample_docs}
    share = F.when(F.col("label") == 1, min(1.0, want[1] / max(1, count.get(1, 0)))).otherwise(
        min(1.0, want[0] / max(1, count.get(0, 0)))
    )
    draw = F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit(11)), F.lit(1 << 20)) / float(1 << 20)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    chosen = F.broadcast(known.where(draw < share).limit(4 * sample_docs))  # bounded by the limit, so no text is shuffled
    drawn = texts.join(chosen, "id").groupBy("id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    drawn = staged(drawn, "toxicity_sample").withColumn("size", F.length("text"))
    sample = drawn.where(F.col("size") <= sample_chars).collect()  # at most as many as ``chosen``
    longer = drawn.where((F.col("size") > sample_chars) & (F.col("size") <= long_chars))
    for label in (0, 1):
        order = F.xxhash64(F.col("id").cast("string"), F.lit(13))
        sample += longer.where(F.col("label") == label).orderBy(order, "id").limit(long_docs).collect()
    sample.sort(key=lambda r: (str(r["id"]), r["text"]))
    return train([r["text"] for r in sample], [r["label"] for r in sample], **options)


def _scores(batch: pa.RecordBatch, column: int, model: Network) -> list[float]:
    """Score of each text of a batch, scored in groups of bounded size."""
    best, held, size = [], [], 0

    def flush():
        parts = [(k, s) for k, w in enumerate(held) for s in slices(w, model.window)]
        top, expected, windows = np.full(len(held), -np.inf), np.zeros(len(held)), np.zeros(len(held), np.int64)
        for (k, _), v in zip(parts, model.window_logits([s for _, s in parts])):
            top[k], expected[k], windows[k] = max(top[k], v.max()), expected[k] + sigmoid(v.astype(np.float64)).sum(), windows[k] + len(v)
        best.extend(map(model.score, top, expected, windows))

    for t in (t for part in slices_of(batch, column) for t in part):
        held.append(read_words(t))
        size += len(held[-1].keys)
        if size > WORDS_AT_ONCE // 2:
            flush()
            held, size = [], 0
    flush()
    return best


def score(docs: DataFrame, net: Network, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` for every whole text."""
    kind = docs.schema[id_col].dataType.simpleString()
    shared = sent(docs.sparkSession, net)

    def run(batches):
        model = received(shared)
        for batch in batches:
            best = _scores(batch, 1, model)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(best, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double"
    )


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    folds: int = 5,
    held_out_fold: int = 0,
    threshold: float = 0.5,
    **options,
) -> DataFrame:
    """``(doc_id, held_out, score, predicted)``: learn on the other folds, score every whole text.

    Null and empty texts get the score of an empty window. Without labels of both classes every score is
    the smoothed share of toxic labels. Null and repeated ids are scored like any others (a null id is
    never labelled). Other columns are ignored; an empty table gives an empty result.
    """
    net = fit(docs, labels, id_col, text_col, label_col, ~in_fold(id_col, folds, held_out_fold), **options)
    found = score(docs, net, id_col, text_col)
    return found.select(
        "doc_id",
        in_fold("doc_id", folds, held_out_fold).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_clean(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows whose text (a string column) scores below ``threshold``, every column as it was (null and
    empty texts stay)."""
    shared = sent(docs.sparkSession, fit(docs, labels, id_col, text_col, "toxic", ~in_fold(id_col, 5, 0)))
    names, at = docs.columns, docs.columns.index(text_col)
    rows = docs.select(*[F.col(c).alias(f"c{i}") for i, c in enumerate(names)])

    def run(batches):
        model = received(shared)
        for batch in batches:
            yield batch.filter(pa.array([x < threshold for x in _scores(batch, at, model)], pa.bool_()))

    kept = rows.mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
