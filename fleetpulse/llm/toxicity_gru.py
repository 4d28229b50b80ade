"""Toxicity scores by a bidirectional GRU with attention over character and word inputs.

A word's input is its hashed word vector beside the mean of its hashed
character 3- to 5-gram vectors.  A text is scored in overlapping windows of
words: a gated recurrent network reads each window in both directions,
attention pools its states, and a document's score is that of its highest
window.  The network is trained in numpy by back-propagation through time on a
bounded sample of labelled documents; as labels are per document, the windows
that stand for a toxic document are chosen anew from the network's own scores
every few rounds, first by the character n-grams' class log-ratios.

Scoring reads every document once, without a shuffle, with broadcast weights.
A distinct word's gate inputs are computed once per task and kept in a bounded
cache; n-grams are looked up for ``AT_ONCE`` words at a time, as a word has
about 25 and each brings a vector.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import beside_text
from .training import fit_probability, labelled_sample, sigmoid

WINDOW, STRIDE = 64, 48
WORD_SLOTS, CHAR_SLOTS = 1 << 13, 1 << 15
WORD_DIM, CHAR_DIM, HIDDEN, ATTEND = 8, 16, 8, 8
CACHE_WORDS = 150_000
AT_ONCE = 2048
_EDGE = ".,;:!?\"'()[]{}<>#$%&*|-_/\\~`^+="


#: Characters of a word; longer ones (unspaced text) are cut into pieces of that size that overlap by half.
LONGEST = 32


def words_of(text: str) -> list[str]:
    words = text.lower().split()
    if all(len(w) <= LONGEST for w in words):
        return words
    half = LONGEST // 2
    return [w[k:k + LONGEST] for w in words for k in range(0, max(1, len(w) - half), half)]


def char_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Slots of all words' character 3- to 5-grams (edges marked), and each word's number of them."""
    parts = [_char_slots(words[k:k + AT_ONCE]) for k in range(0, max(1, len(words)), AT_ONCE)]
    return np.concatenate([slots for slots, _ in parts]), np.concatenate([counts for _, counts in parts])


def _char_slots(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    marked = [b"\x02" + w.strip(_EDGE).encode() + b"\x03" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    data = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint32)
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    slots, owners = [], []
    for n in (3, 4, 5):
        if len(data) < n:
            break
        at = np.flatnonzero(np.arange(len(data)) + n <= ends)
        code = np.full(len(at), n * 0x9E3779B1 & 0xFFFFFFFF, dtype=np.uint32)
        for k in range(n):
            code = (code ^ data[at + k]) * np.uint32(0x01000193)
        slots.append((code ^ (code >> np.uint32(15))) * np.uint32(0x85EBCA77) >> np.uint32(32 - 15))
        owners.append(owner[at])
    if not slots:
        return np.zeros(0, dtype=np.int32), np.zeros(len(words), dtype=np.int64)
    owners = np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return np.concatenate(slots)[order].astype(np.int32), np.bincount(owners, minlength=len(words))


def word_slots(words: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(w.strip(_EDGE).encode()) % WORD_SLOTS for w in words], dtype=np.int64)


def window_starts(n_words: int) -> range:
    """Starts of the overlapping windows that cover a text; an empty text has one empty window."""
    return range(0, max(1, n_words - WINDOW + STRIDE), STRIDE)


@dataclass
class Network:
    """Parameters by name; ``curve`` is the score's logistic slope and offset."""

    p: dict[str, np.ndarray]
    curve: tuple[float, float] = (1.0, 0.0)

    @classmethod
    def new(cls, seed: int = 7) -> Network:
        rng = np.random.default_rng(seed)
        size = WORD_DIM + CHAR_DIM

        def normal(*shape: int, scale: float) -> np.ndarray:
            return rng.normal(0, scale, shape).astype(np.float32)

        p = {"word": normal(WORD_SLOTS, WORD_DIM, scale=0.05), "char": normal(CHAR_SLOTS, CHAR_DIM, scale=0.1)}
        for d in ("f", "b"):
            p[f"w_{d}"] = normal(size, 3 * HIDDEN, scale=0.3)
            p[f"u_{d}"] = normal(HIDDEN, 3 * HIDDEN, scale=0.3)
            p[f"c_{d}"] = np.zeros(3 * HIDDEN, dtype=np.float32)
        p["wa"], p["ba"] = normal(2 * HIDDEN, ATTEND, scale=0.3), np.zeros(ATTEND, dtype=np.float32)
        p["va"], p["out"] = normal(ATTEND, scale=0.3), normal(2 * HIDDEN, scale=0.3)
        p["bias"] = np.zeros(1, dtype=np.float32)
        return cls(p)

    def inputs(self, words: list[str]) -> np.ndarray:
        """A row per distinct word: word vector and mean character n-gram vector."""
        slots, counts = char_slots(words)
        return word_inputs(self.p, word_slots(words), slots, counts)

    def gates(self, words: list[str]) -> np.ndarray:
        """What a word adds to both directions' gates."""
        x = self.inputs(words)
        return np.concatenate([x @ self.p[f"w_{d}"] + self.p[f"c_{d}"] for d in ("f", "b")], axis=1)


def word_inputs(p: dict[str, np.ndarray], slots: np.ndarray, chars: np.ndarray, counts: np.ndarray) -> np.ndarray:
    x = np.zeros((len(slots), WORD_DIM + CHAR_DIM), dtype=np.float32)
    x[:, :WORD_DIM] = p["word"][slots]
    some = np.flatnonzero(counts > 0)
    ends = np.cumsum(counts)
    for k in range(0, len(some), AT_ONCE):
        part = some[k:k + AT_ONCE]
        begins = ends[part] - counts[part]
        vectors = p["char"][chars[begins[0]:ends[part[-1]]]]
        x[part, WORD_DIM:] = np.add.reduceat(vectors, begins - begins[0], axis=0) / counts[part, None]
    return x


def sum_by(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Rows of ``values`` summed by their index under ``size``."""
    out = np.zeros((size, values.shape[1]), dtype=values.dtype)
    if len(index):
        order = np.argsort(index, kind="stable")
        ordered = index[order]
        begins = np.flatnonzero(np.diff(ordered, prepend=-1))
        out[ordered[begins]] = np.add.reduceat(values[order], begins, axis=0)
    return out


def _sigma(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def run_direction(x: np.ndarray, lengths: np.ndarray, u: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States (T, B, HIDDEN) over gate inputs x (T, B, 3 * HIDDEN); a window's state stays after its end."""
    steps, batch, _ = x.shape
    state = np.zeros((batch, HIDDEN), dtype=x.dtype)
    states = np.empty((steps, batch, HIDDEN), dtype=x.dtype)
    saved, shortest = [], int(lengths.min()) if batch else 0
    for t in range(steps):
        hu = state @ u
        zr = _sigma(x[t, :, :2 * HIDDEN] + hu[:, :2 * HIDDEN])
        z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
        n = np.tanh(x[t, :, 2 * HIDDEN:] + r * hu[:, 2 * HIDDEN:])
        new = n + z * (state - n)
        if t >= shortest:
            new = np.where((t < lengths)[:, None], new, state)
        if keep:
            saved.append((state, z, r, n, hu[:, 2 * HIDDEN:]))
        states[t] = state = new
    return states, saved


def _reversed(lengths: np.ndarray, steps: int) -> np.ndarray:
    """For each window and step, the step of the same word when the window is read backwards."""
    t = np.arange(steps)[:, None]
    return np.where(t < lengths[None, :], lengths[None, :] - 1 - t, t)


def forward(p: dict[str, np.ndarray], gates_f: np.ndarray, gates_b: np.ndarray, lengths: np.ndarray,
            keep: bool = False) -> tuple[np.ndarray, dict | None]:
    """Logits of windows from gate inputs (T, B, 3 * HIDDEN) in reading order."""
    steps, batch = gates_f.shape[:2]
    back = _reversed(lengths, steps)
    cols = np.arange(batch)[None, :]
    hf, saved_f = run_direction(gates_f, lengths, p["u_f"], keep)
    hb, saved_b = run_direction(gates_b[back, cols], lengths, p["u_b"], keep)
    h = np.concatenate([hf, hb[back, cols]], axis=2)
    inside = np.arange(steps)[:, None] < lengths[None, :]
    a = np.tanh(h @ p["wa"] + p["ba"])
    e = np.where(inside, a @ p["va"], -1e9)
    e = np.exp(e - e.max(axis=0, initial=-1e9)) * inside
    alpha = e / np.maximum(e.sum(axis=0), 1e-9)
    pooled = (alpha[:, :, None] * h).sum(axis=0)
    logits = pooled @ p["out"] + p["bias"][0]
    if not keep:
        return logits, None
    return logits, {"h": h, "a": a, "alpha": alpha, "pooled": pooled, "f": saved_f, "b": saved_b, "back": back,
                    "inside": inside}


def _back_direction(dh_all: np.ndarray, saved: list, u: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradients of a direction's gate inputs and its recurrent weights."""
    steps, batch, _ = dh_all.shape
    dx, du = np.zeros((steps, batch, 3 * HIDDEN), dtype=dh_all.dtype), np.zeros_like(u)
    carry = np.zeros((batch, HIDDEN), dtype=dh_all.dtype)
    for t in range(steps - 1, -1, -1):
        state, z, r, n, hn = saved[t]
        live = inside[t][:, None]
        total = carry + dh_all[t]
        g = np.where(live, total, 0)
        dn = g * (1 - z) * (1 - n * n)
        dz = g * (state - n) * z * (1 - z)
        dr = dn * hn * r * (1 - r)
        dhu = np.concatenate([dz, dr, dn * r], axis=1)
        dx[t] = np.concatenate([dz, dr, dn], axis=1)
        du += state.T @ dhu
        carry = np.where(live, g * z + dhu @ u.T, total)
    return dx, du


def backward(p: dict[str, np.ndarray], kept: dict, dlogits: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of everything above the gate inputs, and of the gate inputs (gates_f, gates_b)."""
    h, a, alpha = kept["h"], kept["a"], kept["alpha"]
    grads = {"out": kept["pooled"].T @ dlogits, "bias": np.array([dlogits.sum()], dtype=np.float32)}
    dpooled = dlogits[:, None] * p["out"]
    dh = alpha[:, :, None] * dpooled
    dalpha = (h * dpooled).sum(axis=2)
    de = alpha * (dalpha - (alpha * dalpha).sum(axis=0))
    da = de[:, :, None] * p["va"] * (1 - a * a)
    grads["va"] = np.einsum("tbk,tb->k", a, de)
    grads["wa"] = np.einsum("tbi,tbk->ik", h, da)
    grads["ba"] = da.sum(axis=(0, 1))
    dh = dh + da @ p["wa"].T
    back, cols = kept["back"], np.arange(h.shape[1])[None, :]
    grads["gates_f"], grads["u_f"] = _back_direction(dh[:, :, :HIDDEN], kept["f"], p["u_f"], kept["inside"])
    dx, grads["u_b"] = _back_direction(dh[:, :, HIDDEN:][back, cols], kept["b"], p["u_b"], kept["inside"])
    grads["gates_b"] = dx[back, cols]
    return grads


class Corpus:
    """Training documents as word numbers, with the distinct words' slots."""

    def __init__(self, texts: list[str]):
        numbers: dict[str, int] = {}
        self.docs = [np.array([numbers.setdefault(w, len(numbers)) for w in words_of(t)], dtype=np.int64) for t in texts]
        words = list(numbers)
        self.slots = word_slots(words)
        self.chars, self.counts = char_slots(words)
        self.begins = np.cumsum(self.counts) - self.counts
        self.windows = [(d, s) for d, doc in enumerate(self.docs) for s in window_starts(len(doc))]

    def batch(self, which: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers (T, B) and lengths of some windows."""
        cut = [self.docs[d][s:s + WINDOW] for d, s in which]
        lengths = np.array([len(c) for c in cut])
        ids = np.zeros((max(1, int(lengths.max())), len(cut)), dtype=np.int64)
        for k, c in enumerate(cut):
            ids[:len(c), k] = c
        return ids, lengths

    def chars_of(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.counts[words]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(self.begins[words] - (ends - counts), counts)
        return self.chars[at], counts

    def first_choice(self, labels: np.ndarray) -> np.ndarray:
        """A score per window: its highest word, by the log-ratio of its character n-grams' documents."""
        seen = np.zeros((2, CHAR_SLOTS))
        for doc, y in zip(self.docs, labels):
            seen[y, np.unique(self.chars_of(np.unique(doc))[0])] += 1
        n = np.array([(labels == 0).sum(), (labels == 1).sum()])
        ratio = np.log((seen[1] + 0.5) / (n[1] + 1)) - np.log((seen[0] + 0.5) / (n[0] + 1))
        word = np.full(len(self.slots), -10.0)
        some = self.counts > 0
        if some.any():
            word[some] = np.maximum.reduceat(ratio[self.chars], self.begins[some])
        return np.array([word[self.docs[d][s:s + WINDOW]].max(initial=-10.0) for d, s in self.windows])


class Trainer:
    """Adam for the small matrices, row-wise Adagrad for the two embedding tables."""

    def __init__(self, net: Network, rate: float = 0.01):
        self.net, self.rate, self.step = net, rate, 0
        dense = [k for k in net.p if k not in ("word", "char")]
        self.m = {k: np.zeros_like(net.p[k]) for k in dense}
        self.v = {k: np.zeros_like(net.p[k]) for k in dense}
        self.squares = {k: np.full(len(net.p[k]), 1e-6, dtype=np.float32) for k in ("word", "char")}

    def gates(self, x: np.ndarray) -> list[np.ndarray]:
        return [x @ self.net.p[f"w_{d}"] + self.net.p[f"c_{d}"] for d in ("f", "b")]

    def logits(self, corpus: Corpus, which: list[tuple[int, int]]) -> np.ndarray:
        out = np.empty(len(which), dtype=np.float32)
        x = word_inputs(self.net.p, corpus.slots, corpus.chars, corpus.counts)
        gates = self.gates(x)
        order = sorted(range(len(which)), key=lambda k: min(WINDOW, len(corpus.docs[which[k][0]]) - which[k][1]))
        for k in range(0, len(order), 2048):
            part = order[k:k + 2048]
            ids, lengths = corpus.batch([which[i] for i in part])
            out[part] = forward(self.net.p, gates[0][ids], gates[1][ids], lengths)[0]
        return out

    def learn(self, corpus: Corpus, which: list[tuple[int, int]], labels: np.ndarray, weights: np.ndarray) -> None:
        p = self.net.p
        ids, lengths = corpus.batch(which)
        words, back = np.unique(ids, return_inverse=True)
        back = back.reshape(ids.shape)
        chars, counts = corpus.chars_of(words)
        x = word_inputs(p, corpus.slots[words], chars, counts)
        gates = self.gates(x)
        logits, kept = forward(p, gates[0][back], gates[1][back], lengths, keep=True)
        dlogits = ((_sigma(logits) - labels) * weights / len(which)).astype(np.float32)
        grads = backward(p, kept, dlogits)
        dx = np.zeros_like(x)
        for k, d in enumerate(("f", "b")):
            dgates = sum_by(back.reshape(-1), grads.pop(f"gates_{d}").reshape(-1, 3 * HIDDEN).astype(np.float32), len(words))
            grads[f"w_{d}"], grads[f"c_{d}"] = x.T @ dgates, dgates.sum(axis=0)
            dx += dgates @ p[f"w_{d}"].T
        self._rows("word", corpus.slots[words], dx[:, :WORD_DIM])
        each = dx[:, WORD_DIM:] / np.maximum(counts, 1)[:, None]
        self._rows("char", chars, np.repeat(each, counts, axis=0))
        self.step += 1
        for k, g in grads.items():
            self.m[k] = 0.9 * self.m[k] + 0.1 * g
            self.v[k] = 0.999 * self.v[k] + 0.001 * g * g
            m, v = self.m[k] / (1 - 0.9 ** self.step), self.v[k] / (1 - 0.999 ** self.step)
            p[k] -= (self.rate * m / (np.sqrt(v) + 1e-8)).astype(np.float32)

    def _rows(self, name: str, rows: np.ndarray, grads: np.ndarray) -> None:
        if not len(rows):
            return
        used, back = np.unique(rows, return_inverse=True)
        total = sum_by(back, grads, len(used))
        self.squares[name][used] += (total * total).mean(axis=1)
        self.net.p[name][used] -= 5 * self.rate * total / np.sqrt(self.squares[name][used])[:, None]


def fit(texts: list[str], labels: np.ndarray, sizes: dict[int, int], rounds: int = 12, seed: int = 7) -> Network:
    """Train on labelled documents; a fifth of them is held back for the score's curve.

    With a class missing, every score is the (smoothed) share of class 1.
    """
    net = Network.new(seed)
    share = (sizes.get(1, 0) + 1) / (sizes.get(0, 0) + sizes.get(1, 0) + 2)
    if len(set(labels.tolist())) < 2:
        net.curve = (0.0, float(np.log(share / (1 - share))))
        return net
    rng = np.random.default_rng(seed)
    back = rng.random(len(texts)) < 0.2
    if any((labels[part] == y).sum() == 0 for y in (0, 1) for part in (back, ~back)):
        back[:] = False
    front = np.flatnonzero(~back)
    corpus, y = Corpus([texts[i] for i in front]), labels[front]
    owner = np.array([d for d, _ in corpus.windows])
    scores = corpus.first_choice(y)
    trainer = Trainer(net)
    for r in range(rounds):
        if r and r % 2 == 0:
            scores = trainer.logits(corpus, corpus.windows)
        best = np.lexsort((scores, owner))
        best = best[np.append(owner[best][1:] != owner[best][:-1], True)]  # each document's highest window
        chosen = [best, rng.choice(np.flatnonzero(y[owner] == 0), min(len(best), int((y[owner] == 0).sum())), replace=False)]
        if r >= 2:
            also = np.flatnonzero((y[owner] == 1) & (scores > 2))  # other clearly toxic windows
            chosen.append(rng.choice(also, min(len(also), len(best)), replace=False) if len(also) else also)
        picked = rng.permutation(np.unique(np.concatenate(chosen)))
        marks = y[owner[picked]].astype(np.float32)
        trainer.rate = 0.01 * (1 - 0.8 * r / rounds)
        balance = np.where(marks > 0, len(marks) / max(1, 2 * marks.sum()), len(marks) / max(1, 2 * (1 - marks).sum()))
        balance = balance.astype(np.float32)
        batch = min(128, max(16, len(picked) // 30))  # small corpora need as many steps
        for k in range(0, len(picked), batch):
            part = picked[k:k + batch]
            trainer.learn(corpus, [corpus.windows[i] for i in part], marks[k:k + batch], balance[k:k + batch])
    held = np.flatnonzero(back) if back.any() else front
    corpus = None  # its memory is free for the next
    check = Corpus([texts[i] for i in held])
    top = np.full(len(held), -np.inf)
    np.maximum.at(top, [d for d, _ in check.windows], trainer.logits(check, check.windows))
    net.curve = fit_probability(top, labels[held], sizes)
    return net


class Scorer:
    """Scores texts with a network; distinct words' gate inputs are kept up to ``CACHE_WORDS``."""

    def __init__(self, net: Network):
        self.net = net
        self._clear()

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((2 * CACHE_WORDS, 6 * HIDDEN), dtype=np.float32)  # memory is taken as it fills

    def _numbers(self, texts: list[str]) -> list[np.ndarray]:
        """Each text's words as rows of the table; only distinct words are held as strings."""
        if len(self.rows) > CACHE_WORDS:
            self._clear()
        first, fresh, numbers = len(self.rows), [], []
        get = self.rows.__getitem__
        for text in texts:
            words = words_of(text)
            new = list(set(words).difference(self.rows))
            self.rows.update(zip(new, range(first + len(fresh), first + len(fresh) + len(new))))
            fresh += new
            numbers.append(np.fromiter(map(get, words), np.int64, len(words)))
        if len(self.rows) > len(self.table):
            more = np.zeros((len(self.rows) - first, 6 * HIDDEN), dtype=np.float32)
            self.table = np.concatenate([self.table[:first], more])
        for k in range(0, len(fresh), AT_ONCE):
            part = fresh[k:k + AT_ONCE]
            self.table[first + k:first + k + len(part)] = self.net.gates(part)
        return numbers

    def logits(self, texts: list[str]) -> np.ndarray:
        """Each text's highest window."""
        numbers = self._numbers(texts)
        flat = np.concatenate([*numbers, np.zeros(WINDOW, dtype=np.int64)])
        begins = np.cumsum([0] + [len(x) for x in numbers])
        owner, start, length = [], [], []
        for d, x in enumerate(numbers):
            for s in window_starts(len(x)):
                owner.append(d)
                start.append(begins[d] + s)
                length.append(min(WINDOW, len(x) - s))
        owner, start, length = map(np.array, (owner, start, length))
        out = np.empty(len(owner), dtype=np.float32)
        order = np.argsort(length, kind="stable")
        for k in range(0, len(order), 1024):
            part = order[k:k + 1024]
            ids = flat[start[part] + np.arange(max(1, int(length[part].max())))[:, None]]
            gates = self.table[ids]
            out[part] = forward(self.net.p, gates[:, :, :3 * HIDDEN], gates[:, :, 3 * HIDDEN:], length[part])[0]
        top = np.full(len(texts), -np.inf)
        np.maximum.at(top, owner, out)
        return top

    def scores(self, texts: list[str]) -> np.ndarray:
        slope, offset = self.net.curve
        return sigmoid(slope * self.logits(texts) + offset)


def train(docs: DataFrame, labels: DataFrame, label_col: str, usable: Column, per_class: int = 1500,
          max_chars: int = 50_000) -> Network:
    """Fit on at most ``per_class`` usable labelled documents of each class (of ``max_chars`` at most)."""
    sample, sizes = labelled_sample(docs, labels, label_col, usable, per_class, max_chars)
    rows = sorted(sample.collect(), key=lambda r: r["id"])  # the bounded sample
    return fit([r["text"] for r in rows], np.array([r["label"] for r in rows], dtype=np.int64), sizes)


def score(docs: DataFrame, net: Network, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
          score_col: str = "score") -> DataFrame:
    """The ``keep`` columns and ``score_col`` of every row: the probability of label 1 of its highest
    window.

    Null texts are empty; an empty text is one empty window (attention has
    nothing to pool, so the output's bias decides).  Null ids pass through,
    repeated rows keep a row each, other columns are ignored, an empty table
    gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scorer = Scorer(shared.value)
        for column in texts:
            found, part, size = [], [], 0
            for k in range(len(column)):
                part.append(column[k].as_py() or "")
                size += len(part[-1])
                if size > 4 << 20 or k == len(column) - 1:  # bounded work tables
                    found.append(scorer.scores(part))
                    part, size = [], 0
            yield pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())

    return beside_text(docs, text_col, keep, score_col, "double", run)
