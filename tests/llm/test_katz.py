"""Katz backoff against a plain model over Python dictionaries."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import katz

DOCS = "doc_id long, text string"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
END = "\n"


def tokens(text):
    return [w.decode() for w in (text or "").translate(LOWER).encode().split()] + [END]


class Plain:
    """Counts by n-gram length, probabilities by recursion."""

    def __init__(self, texts, order):
        self.order, self.counts, self.followers = order, [Counter() for _ in range(order + 1)], defaultdict(Counter)
        for t in texts:
            seq = [""] * (order - 1) + t
            for i in range(order - 1, len(seq)):
                for k in range(1, order + 1):
                    gram = self.named(seq[i - k + 1:i + 1])
                    self.counts[k][gram] += 1
                    self.followers[gram[:-1], k][gram[-1]] += 1
        self.d = [None] + [katz.discounts([0] + [sum(c == r for c in self.counts[k].values()) for r in range(1, katz.CUT + 2)])
                           for k in range(1, order + 1)]
        self.weights = {}

    @staticmethod
    def named(gram):
        """Several boundaries before a text are one history."""
        gram = list(gram)
        while len(gram) > 2 and gram[0] == "" and gram[1] == "":
            gram.pop(0)
        return tuple(gram)

    def p(self, history, w):
        k = len(history) + 1
        followers = self.followers[self.named((*history, w))[:-1], k]
        lower = (lambda v: self.p(history[1:], v)) if k > 1 else (lambda v: 1.0)
        total = sum(followers.values())
        if not total:
            return lower(w)
        d = [1.0] * (max(followers.values()) + 1)
        for r in range(1, min(len(d) - 1, katz.CUT) + 1):
            d[r] = self.d[k][r]
        mass = sum(d[c] * c for c in followers.values())
        below = total + (mass >= total)
        if followers[w]:
            return d[followers[w]] * followers[w] / below
        key = (tuple(history), k)
        if key not in self.weights:
            self.weights[key] = (1 - mass / below) / (1 - (sum(lower(v) for v in followers if followers[v]) if k > 1 else 0))
        return self.weights[key] * lower(w)

    def score(self, seq):
        full = [""] * (self.order - 1) + seq
        return sum(math.log10(self.p(tuple(full[i - self.order + 1:i]), full[i])) for i in range(self.order - 1, len(full)))


def corpus(n, seed=0):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["The", "THE", "été"]
    docs = [(i, " ".join(rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=rng.randint(0, 60)))) for i in range(n)]
    docs += [(n, "rare words\tnobody\nelse\x0bhas"), (n + 1, None), (n + 2, ""), (None, docs[0][1]), (3, docs[3][1])]
    return docs + [(n + 10 + k, docs[1][1]) for k in range(20)]


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def plain(docs, order):
    seqs = [(i, tokens(t)) for i, t in docs]
    model = Plain([s for i, s in seqs if not held(i)], order)
    c = model.counts[1]
    n, v = sum(c.values()), len(c)
    return model, sorted((str(i), held(i), len(s), sum(c[(w,)] > 0 for w in s), n,
                          sum(math.log10((c[(w,)] + 1) / (n + v + 1)) for w in s), model.score(s)) for i, s in seqs)


def train():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2


def same(rows, want):
    rows = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows)
    assert [r[:5] for r in rows] == [w[:5] for w in want]
    np.testing.assert_allclose([r[5:] for r in rows], [w[5:] for w in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("order, small", [(1, False), (2, False), (2, True), (3, True)])
def test_equals_plain_model(frame, monkeypatch, order, small):
    if small:  # many chunks, pieces, buckets and parts of frequent histories
        for name, value in (("CHUNK", 300), ("PIECE", 13), ("WORDS", 30), ("BUCKET", 200), ("HOT", 40), ("BLOCK", 30)):
            monkeypatch.setattr(katz, name, value)
    docs = corpus(120)
    scores, tables = katz.score(frame([(*d, "x", 0.0) for d in docs], DOCS + ", id string, score double"), train(), order)
    model, want = plain(docs, order)
    assert len({w[6] for w in want}) > 100
    same(scores.collect(), want)
    words = {r.id: r.word for r in katz.ngrams(tables, 1).collect()}
    assert Counter({words[r.id]: r.n for r in katz.ngrams(tables, 1).collect()}) == Counter({k[0]: n for k, n in model.counts[1].items()})
    if order > 1:
        found = {("" if r.history == -1 else words[r.history], words[r.suffix]): r.n for r in katz.ngrams(tables, 2).collect()}
        assert found == {g: n for g, n in model.counts[2].items()}


@pytest.mark.parametrize("order", [1, 2, 3])
def test_probabilities_of_every_history_add_up_to_one(order):
    model, _ = plain(corpus(40), order)
    known = [g[0] for g in model.counts[1]]
    rng = random.Random(1)
    for _ in range(60):
        history = tuple(rng.choice([*known, "", "new"]) for _ in range(order - 1))
        assert sum(model.p(history, w) for w in known) + model.p(history, "never seen") == pytest.approx(1, abs=1e-9)


def test_discounts():
    d = katz.discounts([0, 1000, 400, 220, 140, 100, 75])
    common = 6 * 75 / 1000
    assert d[1] == pytest.approx((2 * 400 / 1000 - common) / (1 - common)) and all(0 < x < 1 for x in d[1:])
    assert katz.discounts([0] * 7)[1:].tolist() == [1 - 0.5 / r for r in range(1, 6)]
    assert katz.discounts([0, 10, 0, 0, 0, 0, 0])[1] == 0.25


def test_nothing_learned_and_empty(frame):
    rows = katz.score(frame([(1, "a b"), (2, None)], DOCS), F.lit(False))[0].collect()
    assert sorted((r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score, r.held_out) for r in rows) == [
        (1, 0, 0, 0.0, 0.0, True), (3, 0, 0, 0.0, 0.0, True)]
    assert katz.score(frame([], DOCS), train())[0].collect() == []


def test_packed_arrays():
    for a in (np.array([], np.int64), np.array([5, -3, 2**62], np.int64), np.array([0.5, 1e-300]), np.frombuffer(b"xyz", np.uint8)):
        back, = katz.unpack(katz.pack(a))
        assert back.dtype == a.dtype and back.tolist() == a.tolist()
    x = np.array([3, 3, 9, 1, -1], np.int64)
    assert katz.unsteps(katz.steps(x)).tolist() == x.tolist()
    big = np.array([2**40, 5, 2**40, 5], np.int64)
    first, which = katz.pairs(big, np.array([2**33, 1, 2**33, 2]))
    assert first.tolist() == [1, 3, 0] and which.tolist() == [2, 0, 2, 1]
