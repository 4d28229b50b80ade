"""Decontamination: every placement of the allowed changes, verbatim quotes, inserted and deleted words."""

import itertools
import random

from fleetpulse.llm import decontamination

DOCS = "doc_id long, text string"
ITEMS = "item_id long, text string"


def words(n, name):
    return [f"{name}{k}" for k in range(n)]


def found(frame, docs, items, **options):
    rows = decontamination.leaks(frame(docs, DOCS), frame(items, ITEMS), **options).collect()
    assert len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    return {(r.doc_id, r.item_id) for r in rows}


def test_every_placement_of_substitutions_in_short_items(frame):
    items, docs, want = [], [], set()
    for n in (8, 9, 10, 11, 12, 15, 16):
        item = words(n, f"w{n}x")
        items.append((n, " ".join(item)))
        for gone in itertools.combinations(range(n), n // 5):
            want.add((len(docs), n))
            docs.append((len(docs), " ".join(["pre", *("other" if k in gone else w for k, w in enumerate(item)), "post"])))
        docs.append((len(docs), " ".join("other" if k <= n // 5 else w for k, w in enumerate(item))))
    assert found(frame, docs, items) == want


def test_verbatim_quotes(frame):
    long = words(40, "a")
    items = [(1, " ".join(long)), (2, "one two three four five"), (3, "only"), (4, ""), (5, None)]
    docs = [(1, " ".join(["x", *long[20:33], "y"])), (2, " ".join(["x", *long[20:32], "y"])), (3, "zero One, two three four five six"),
            (4, "one two three four six"), (5, "the only"), (6, None), (7, "")]
    assert found(frame, docs, items, verbatim=13) == {(1, 1), (3, 2), (5, 3)}
    assert found(frame, docs, items) == set()


def fewest_edits(item, doc):
    """Of any stretch of ``doc``, by the full table."""
    row = [0] * (len(doc) + 1)
    for k, w in enumerate(item):
        new = [k + 1]
        for d, x in enumerate(doc):
            new.append(min(row[d] + (w != x), row[d + 1] + 1, new[d] + 1))
        row = new
    return min(row)


def quotes(item, doc, n):
    grams = {tuple(doc[i:i + n]) for i in range(len(doc) - n + 1)}
    return any(tuple(item[i:i + n]) in grams for i in range(len(item) - n + 1))


def plain_leaks(docs, items, verbatim):
    out = set()
    for (i, t), (j, b) in itertools.product(docs, items):
        w, v = t.split(), b.split()
        n = min(24, len(v))
        near = len(v) >= 8 and any(fewest_edits(v[s:s + n], w) <= n // 5 for s in range(len(v) - n + 1))
        if near or verbatim and quotes(v, w, min(verbatim, len(v))):
            out.add((i, j))
    return out


def test_inserted_and_deleted_words(frame):
    rng = random.Random(4)
    names = words(40, "v")
    items = [(j, " ".join(rng.choices(names, k=n))) for j, n in enumerate([5, 8, 10, 13, 15, 15, 20, 24, 30, 38, 38])]
    items.append((99, "v1 v1 v1 v1 v2 v1 v1 v1 v1 v2 v1 v1"))
    docs = [(0, " ".join([*items[9][1].split()[:19], "more", *items[9][1].split()[19:]])),
            (1, " ".join([*items[4][1].split()[:7], "more", *items[4][1].split()[7:]]))]
    for i in range(2, 240):
        part = rng.choice(items)[1].split()
        for _ in range(rng.randint(0, len(part) // 4 + 1)):
            at, change = rng.randrange(len(part)), rng.choice("sid")
            part[at:at + (change != "i")] = [] if change == "d" and len(part) > 1 else [rng.choice(names)]
        docs.append((i, " ".join([*rng.choices(names, k=rng.randint(0, 9)), *part, *rng.choices(names, k=rng.randint(0, 9))])))
    for verbatim in (None, 13):
        want = plain_leaks(docs, items, verbatim)
        assert {(0, 9), (1, 4)} <= want and 100 < len(want) < 230
        assert found(frame, docs, items, **({"verbatim": verbatim} if verbatim else {})) == want
