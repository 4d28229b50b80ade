"""Spelling variants against plain edit-distance comparison of all words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from fleetpulse.llm import spelling

DOCS = "doc_id long, text string"
LOWER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def plain_counts(docs):
    total = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                total[run] += 1
    return {w: n for w, n in total.items() if n >= 3}


def near(u, v):
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    u, v = sorted((u, v), key=len)
    return len(v) == len(u) + 1 and any(v[:k] + v[k + 1:] == u for k in range(len(v)))


def plain(docs):
    n = plain_counts(docs)
    found = {w: [v for v in n if near(w, v)] for w in n}
    form = {}
    for w, vs in found.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    rows = set()
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        rows.add((w, form[w], root, n[w], len(found[w]), n[form[w]] if form[w] else None))
    return rows


def corpus(size, seed=1):
    rng = random.Random(seed)
    parts = ["the", "in", "an", "er", "on", "at", "É", "ñe", "th"]
    words = ["".join(rng.choices(parts, k=rng.randint(2, 4))) for _ in range(60)]
    docs = []
    for i in range(size):
        out = []
        for w in rng.choices(words, weights=[1 / (k + 1) for k in range(len(words))], k=80):
            if rng.random() < 0.3:
                at, c = rng.randrange(len(w)), rng.choice("aenté")
                w = rng.choice([w[:at] + c + w[at + 1:], w[:at] + c + w[at:], w[:at] + w[at + 1:]])
            out.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((i, " ".join(out) + "1" + out[0] + "-" + out[1]))
    return docs


def got(df):
    rows = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


@pytest.mark.parametrize("cell", [16384, 25])
def test_equals_brute_force(frame, monkeypatch, cell):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "SAMPLED", 25)
    monkeypatch.setattr(spelling, "HELD", 50)
    docs = corpus(300)
    want = plain(docs)
    assert len(want) > 300 and sum(r[1] is not None for r in want) > 100 and any(r[2] not in (r[0], r[1]) for r in want)
    assert got(spelling.variants(frame(docs, DOCS))) == want


def test_large_cells_are_dealt_in_parts(frame, monkeypatch):
    monkeypatch.setattr(spelling, "CELL", 20)
    monkeypatch.setattr(spelling, "MAX_SAMPLE", 0)  # no sample: every length is one cell
    docs = corpus(100, seed=3)
    assert got(spelling.variants(frame(docs, DOCS))) == plain(docs)


def test_odd_rows(frame):
    long = "ab" * 400
    rows = [(1, None), (2, ""), (None, "Vector vector×x vectors"), (3, "vector vectors vectors 数据 vectors"), (3, "vector vectors vectors 数据 vectors"),
            (4, " ".join([long + "a"] * 6 + [long] * 3 + ["a" * 300] * 4 + ["a" * 301] * 9))]
    df = frame([(*r, "n", 1) for r in rows], DOCS + ", word string, n int")
    assert got(spelling.variants(df)) == plain(rows)
    assert {r.form for r in spelling.variants(df).collect()} >= {long + "a", "a" * 301}
    assert spelling.variants(frame([], DOCS)).collect() == []
    assert spelling.variants(frame(rows[:2], DOCS)).columns == ["word", "form", "root", "n", "n_near", "form_n"]


def test_search_meets_every_near_vector():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 3, (400, 6)).astype(np.int32)
    router = spelling.Router.__new__(spelling.Router)
    spelling.Router.__init__(router, ["".join(chr(97 + k) * int(c) for k, c in enumerate(row)) for row in base if row.sum() == 6], 90, 6)
    points = np.zeros((len(base), 256), np.int32)
    points[:, 97:103] = base
    homes = router.homes(points)
    assert router.cells > 3
    for longer in (0, 1):
        met = {(cell, int(k)) for cell, rows in router.met(points, longer) for k in rows}
        diff = points[None] - points[:, None]  # [query, data]
        up, down = np.maximum(diff, 0).sum(2), np.maximum(-diff, 0).sum(2)
        for q, d in zip(*np.nonzero((up <= 1) & (down <= 1 - longer))):
            assert (int(homes[d]), int(q)) in met
