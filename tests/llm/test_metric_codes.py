"""Vector codes against plain comparison of every part with every entry."""

import hashlib

import numpy as np
import pytest

from fleetpulse.llm import metric_codes

VECTORS = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """{position: (code, error)}, label sums and the digest, by brute force."""
    ok = [(i, v, y) for i, v, y in rows if v and all(x is not None and np.isfinite(x) for x in v)]
    pts = np.floor(256 * np.array([v for _, v, _ in ok], dtype=np.float32).astype(float)).astype(int)
    n, size = pts.shape
    pts = pts.reshape(n, parts, size // parts)
    by_id = sorted(range(n), key=lambda k: (ok[k][0], list(ok[k][1])))[:entries]
    books = [pts[by_id, p].copy() for p in range(parts)]

    def nearest(p):
        return ((pts[:, p][:, None] - books[p][None]) ** 2).sum(-1).argmin(1)

    for _ in range(rounds):
        for p in range(parts):
            a = nearest(p)
            for e in range(len(books[p])):
                if (a == e).any():
                    books[p][e] = [int(c) // int((a == e).sum()) for c in pts[a == e, p].sum(0)]
    codes, error = [""] * n, np.zeros(n, dtype=int)
    for p in range(parts):
        a = nearest(p)
        error += ((pts[:, p] - books[p][a]) ** 2).sum(1)
        codes = [c + f"{e:02x}" for c, e in zip(codes, a)]
    labels = {}
    for (_, _, y), e in zip(ok, error):
        labels[y] = labels.get(y, 0) + int(e)
    digest = hashlib.sha256(",".join(str(x) for b in books for row in b for x in row).encode()).hexdigest()
    return sorted((i, c, int(e), labels[y], digest) for (i, _, y), c, e in zip(ok, codes, error))


def vectors(n, size=64, seed=0, copies=0.3):
    rng = np.random.default_rng(seed)
    rows = [(int(i), rng.normal(0, 0.15, size).astype(np.float32).tolist(), int(rng.integers(0, 4))) for i in rng.permutation(n)]
    for k in range(int(n * copies)):  # exact copies under ids of their own
        rows.append((n + k, rows[k % 7][1], None))
    return rows


@pytest.mark.parametrize("n, chunk", [(900, 200), (40, 8192), (1, 8192)])
def test_equals_brute_force(frame, monkeypatch, n, chunk):
    monkeypatch.setattr(metric_codes, "CHUNK", chunk)
    rows = vectors(n)
    got = metric_codes.compress(frame(rows, VECTORS)).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)


def test_odd_rows(frame):
    rows = vectors(120) + [(500, None, 1), (501, [], 1), (502, [float("nan")] * 64, 1), (503, [float("inf")] + [0.0] * 63, 1),
                           (504, [None] + [0.0] * 63, 1), (3, vectors(120)[5][1], None)]
    df = frame([(*r, "x", 1) for r in rows], VECTORS + ", code string, error int")
    got = metric_codes.compress(df).collect()
    assert sorted(tuple(r) for r in got) == plain(rows)
    none = metric_codes.compress(frame(rows[-5:-1], VECTORS))
    assert none.collect() == [] and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert metric_codes.compress(frame([], VECTORS)).collect() == []
    other = frame(rows[:120] + [(600, [0.5] * 32, 2), (601, [0.5] * 63, 2)], VECTORS)  # other lengths
    assert metric_codes.compress(other).count() == 120


def test_null_ids_and_labels(frame):
    rows = [(None, [0.1] * 16, None), (None, [0.2] * 16, None), (1, [0.3] * 16, 5)]
    got = metric_codes.compress(frame(rows, VECTORS)).collect()
    assert sorted((r.vec_id is None, r.code[:2]) for r in got) == [(False, "00"), (True, "01"), (True, "02")]


def test_tree_balls_hold_their_points_and_caches():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.integers(-90, 90, (700, 4)), np.full((300, 4), 7)])
    nodes, order = metric_codes.metric_tree(points)
    assert sorted(order.tolist()) == list(range(len(points)))
    for node in nodes:
        own = points[order[node["start"]:node["end"]]]
        assert (own.sum(0) == node["sum"]).all()
        assert np.sqrt(((own - node["centre"]) ** 2).sum(1)).max() <= node["radius"] + 1e-9
        if node["children"]:
            kids = nodes[node["child"]:node["child"] + node["children"]]
            assert kids["start"][0] == node["start"] and kids["end"][-1] == node["end"]
            assert (kids["end"][:-1] == kids["start"][1:]).all()


def test_balls_are_owned_and_ties_go_to_the_lower_index():
    rng = np.random.default_rng(3)
    points = np.concatenate([rng.integers(0, 9, (400, 3)) + 1000 * k for k in range(6)])
    book = np.array([[1000 * k] * 3 for k in (5, 4, 4, 3, 2, 1, 0)])
    nodes, order = metric_codes.metric_tree(points)
    found, sums, counts, owned = metric_codes.assign(points, nodes, order, book)
    want = ((points[:, None] - book[None]) ** 2).sum(-1).argmin(1)
    assert (found == want).all() and (counts == np.bincount(want, minlength=len(book))).all()
    assert all((sums[e] == points[want == e].sum(0)).all() for e in range(len(book)))
    assert owned >= 1600  # all but the cluster with two equal entries
