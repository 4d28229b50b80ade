"""HTML text, personal data, line quality, decontamination, licenses: brute force and odd rows."""

import itertools
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetpulse.llm import decontamination, html_text, licenses, line_quality, pii_crf

DOCS = "doc_id long, text string, source string, id string, hashes int"


def docs_of(frame, texts, source="s"):
    return frame([(i, t, source, "clash", 1) for i, t in texts], DOCS)


# HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site of the town</h1></header><nav><ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul></nav>
<div id="cookieNotice">We use cookies so that the site is the best that it can be for you and for all of us.</div>
<div class=content><h2>Title &amp; more</h2><p>This is the first paragraph of the article and it has lots of the words that are stop words.<br>line
  two</p><p>Short.</p><p class="ad">Buy now<p>And this is the last paragraph of it, which is also rather long and has the words.</div>
<div class="comments"><p>I think that this is the best article of all that I have read in this year.</p></div>
<form><p>Subscribe to the letter of the site and get all of the news of it</p></form><footer>&copy; 2020</footer></body></html>"""


def test_page():
    assert html_text.main_text(PAGE).split("\n") == [
        "Title & more", "This is the first paragraph of the article and it has lots of the words that are stop words. line two",
        "Short.", "And this is the last paragraph of it, which is also rather long and has the words."]


def test_page_pieces():
    assert html_text.main_text("") == ""
    assert html_text.main_text("plain &lt;text&#39;s") == "plain <text's"
    assert html_text.main_text("<p>a<p>b <!-- x -->c<script>1</p>") == "a\nb c"
    assert html_text.main_text("<article><p>An</p><p>x</article><footer>y</footer>") == "An\nx"
    assert html_text.main_text("<article><p>cut of", ) == "cut of"
    assert html_text.main_text("<article><p>cut<a hre") == "cut"


def test_extract(frame):
    schema = "page_id long, url string, html string, text string, n_chars int, _html int"
    pages = frame([(1, "u", PAGE, "t", 1, 1), (2, None, None, "t", 1, 1), (None, "u", "<p>é", "t", 1, 1), (2, None, None, "t", 1, 1)], schema)
    rows = html_text.extract(pages).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in rows) == [("1", len(html_text.main_text(PAGE))), ("2", 0), ("2", 0), ("None", 1)]
    assert html_text.extract(frame([], schema)).collect() == []


# personal data

def plain_base(t):
    out = [(m.start(), m.end(), 1) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(x) <= 255 for x in m[0].split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii_crf.luhn(digits):
            out.append((m.start(), m.end(), 3))
    out += [(m.start(), m.end(), 4) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
            if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out, key=lambda s: (s[0], s[2]))


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("a1.@-+ %250(4)b_é\n")), max_size=60))
def test_base_equals_plain_patterns(text):
    assert pii_crf.base_spans(text) == plain_base(text)


def test_long_runs_are_linear():
    for c in "a1+.@-( ":
        pii_crf.find_all([c * 200_000], pii_crf.Field(np.zeros((26, 5)), np.zeros((5, 5)), np.zeros(5)), 0.9)


def exact_marginals(field, batch):
    """By enumeration of all labellings."""
    k, n = 5, len(batch.observed)
    node = batch.features @ field.node
    total = np.zeros((n, k))
    for y in itertools.product(range(k), repeat=n):
        if any(o and o != l for o, l in zip(batch.observed, y)):
            continue
        score = sum(node[i, l] for i, l in enumerate(y)) + sum(field.chain[y[a], y[b]] for a, b in batch.chain)
        score += sum(field.skip[y[a]] for a, b in batch.skip if y[a] == y[b])
        for i, l in enumerate(y):
            total[i, l] += np.exp(score)
    return total / total.sum(axis=1, keepdims=True)


def test_propagation_is_exact_on_trees():
    text = "12 34 x 567-8901 y 5678901"
    graph = pii_crf.graph_of(text, [])
    assert graph.chain == [(0, 1)] and graph.skip == [(2, 3)]
    rng = np.random.default_rng(3)
    field = pii_crf.Field(rng.normal(0, 0.5, (26, 5)), rng.normal(0, 1, (5, 5)), np.abs(rng.normal(0, 1, 5)))
    batch = pii_crf.Batch([graph])
    assert np.allclose(pii_crf.infer(field, batch, rounds=200), exact_marginals(field, batch), atol=1e-2)


TRAIN = ["mail a.b@c.example.org now", "from 10.1.2.3 and 5.6.7.8 on", "call +1 (017) 555-7713 or 12", "card 4111 1111 1111 1111 ok",
         "card 4111111111111111 or 5500005555555559", "version 3.5 of 2024 has 77 pages and id 123456", "token abc123def 9f9f9f"] * 20


def test_repeated_numbers_are_added_and_clean_text_is_not(frame):
    field = pii_crf.fit(pii_crf.Batch([pii_crf.graph_of(t, pii_crf.base_spans(t)) for t in TRAIN]))
    text = "call +1 (017) 555-7713, later 555-7713. Card 4111 1111 1111 1111 and x 4111.1111.1111.1111 in 2024 v 3.5."
    (base, spans), (none, nothing) = pii_crf.find_all([text, "In 2024 there were 12 of 3.5 and 1234567 more."], field, 0.9)
    assert set(base) <= set(spans)
    assert {text[a:b] for a, b, _ in set(spans) - set(base)} == {"555-7713", "4111.1111.1111.1111"}
    assert none == nothing == []
    assert pii_crf.redacted("a b c", [(0, 1, 1), (0, 3, 2), (4, 5, 4)]) == "[EMAIL] [PHONE]"
    docs = docs_of(frame, [(1, TRAIN[0]), (2, None), (2, None), (None, TRAIN[2])])
    rows = {r.doc_id: r for r in pii_crf.find(docs, field).collect()}
    assert rows[1].spans == "email:5:22" and rows[2].spans == "" and rows[None].n_phone == 1
    clean = pii_crf.redact(docs, field)
    assert clean.columns == docs.columns
    assert sorted(str(r.text) for r in clean.collect()) == ["None", "None", "call [PHONE] or 12", "mail [EMAIL] now"]
    assert pii_crf.find(docs_of(frame, []), pii_crf.train(docs_of(frame, []))).collect() == []


# line quality

def plain_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = {}
    for i in range(len(words) - 2):
        windows.setdefault(tuple(words[i:i + 3]), []).append(i)
    covered = {i + k for at in windows.values() if len(at) > 1 for i in at for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_measures(frame):
    rng = random.Random(5)
    texts = ["", " \n\t ", "a b c a b c a", "a a a a", "x\n\nx\nx \n#$|", "é😀 b\x0bc\x85d"]
    texts += ["".join(rng.choice("ab \n\t#.") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    rows = line_quality.with_base(docs_of(frame, list(enumerate(texts)))).collect()
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == plain_measures(texts[r.doc_id]), texts[r.doc_id]


def test_line_rules(frame):
    own = lambda i: " ".join(chr(97 + i // 10) + chr(97 + i % 10) + chr(97 + k) + "é" for k in range(60))
    texts = [(i, f"Shared  LINE {i}\n{own(i)}") for i in range(5)]
    texts += [(10 + i, "\n".join([own(99), own(98)])) for i in range(4)] + [(20, "Shared line 7\nfew"), (21, None), (None, own(4)), (None, own(4))]
    docs = docs_of(frame, texts)
    rows = line_quality.line_rules(docs, max_docs=3, with_text=True).collect()
    by = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert len(rows) == len(texts)
    assert all(by[i].kept and by[i].removed_words == 3 and by[i].text == own(i) for i in range(5))
    assert all(not by[10 + i].kept and not by[10 + i].base_failed and by[10 + i].text == "" for i in range(4))
    assert by[20].base_failed and by[21].base_failed and by[21].n_words == 0
    assert line_quality.line_rules(docs_of(frame, [])).collect() == []
    apart = docs_of(frame, [(i, own(50)) for i in range(3)], "a").unionByName(docs_of(frame, [(i, own(50)) for i in range(3)], None))
    assert all(r.kept for r in line_quality.line_rules(apart, max_docs=3).collect())


def test_line_rules_without_broadcast(frame, monkeypatch):
    monkeypatch.setattr(line_quality, "MAX_BROADCAST_LINES", 0)
    test_line_rules(frame)


def test_line_limit_is_a_share_of_the_host(frame):
    own = lambda i: " ".join(f"{i}x{k}" for k in range(60)).translate({48 + d: 97 + d for d in range(10)})
    small = docs_of(frame, [(i, f"boiler plate line\n{own(i)}") for i in range(10)], "small")
    texts = [(100 + i, ("boiler plate line\n" if i < 250 else "chance line\n" if i < 350 else "") + own(i)) for i in range(10_000)]
    rows = line_quality.line_rules(small.unionByName(docs_of(frame, texts, "large"))).collect()
    removed = {r.doc_id for r in rows if r.removed_lines}
    assert removed == {*range(10), *range(100, 350)} and all(r.kept and r.removed_words in (0, 3) for r in rows)


def test_very_long_text(frame):
    long = "\n".join(" ".join(f"{c}{i}" for c in "abcdefghi") for i in range(30_000))
    row = line_quality.line_rules(docs_of(frame, [(1, long)])).first()
    assert row.n_words == 270_000 and row.kept and row.removed_lines == 0


# decontamination

def plain_leaks(docs, items, window=24):
    out = set()
    for (i, t), (j, b) in itertools.product(docs, items):
        w, v = (re.findall(r"[^\W_]+", (x or "").lower()) for x in (t, b))
        n = min(window, len(v))
        if len(v) < 8:
            continue
        for shift in range(-len(v), len(w)):
            same = [0 <= shift + k < len(w) and w[shift + k] == v[k] for k in range(len(v))]
            if max(sum(same[s:s + n]) for s in range(len(v) - n + 1)) >= 0.8 * n - 1e-9:
                out.add((i, j))
    return out


def test_leaks(frame, monkeypatch):
    rng = random.Random(2)
    words = [f"v{k}" for k in range(300)]
    items = [(j, " ".join(rng.choices(words, k=n))) for j, n in enumerate([14, 16, 18, 24, 40, 60, 5])]
    docs = []
    for i in range(60):
        filler = rng.choices(words, k=rng.randint(0, 80))
        part = items[i % 7][1].split()
        if i % 3 == 1:
            for k in rng.sample(range(len(part)), len(part) // 6):
                part[k] = "other"
        if i % 5 == 4:
            part = part[:len(part) // 3]
        at = rng.randint(0, len(filler))
        docs.append((i, (", " if i % 2 else "  ").join([*filler[:at], *(p.upper() if i % 4 == 0 else p for p in part), *filler[at:]])))
    docs += [(100, None), (101, ""), (None, items[4][1]), (None, items[4][1])]
    bench = frame([(j, t, "x", 1) for j, t in items] + [(3, items[3][1], "x", 1), (9, None, "x", 1)], "item_id long, text string, seed string, at int")
    want = plain_leaks(docs, items)
    got = decontamination.leaks(docs_of(frame, docs), bench).collect()
    assert len(got) == len({(r.doc_id, r.item_id) for r in got})
    assert {(r.doc_id, r.item_id) for r in got} == want and (None, 4) in want and len(want) > 20
    monkeypatch.setattr(decontamination, "MAX_SEEDS", 60)  # joined by a shuffle
    assert {(r.doc_id, r.item_id) for r in decontamination.leaks(docs_of(frame, docs), bench).collect()} == want
    clean = decontamination.decontaminated(docs_of(frame, docs), bench)
    assert clean.columns == docs_of(frame, docs).columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(i for i, _ in docs if i not in {d for d, _ in want})


def test_leaks_empty_sides(frame):
    bench = frame([], "item_id long, text string")
    some = docs_of(frame, [(1, "a b c d e f g h i j")])
    assert decontamination.leaks(some, bench).collect() == []
    assert decontamination.leaks(docs_of(frame, []), frame([(1, "a b c d e f g h")], "item_id long, text string")).collect() == []


def keeps_a_seed(mask, n, gone):
    return any(not any(p + k in gone for k in mask) for p in range(n - mask[-1]))


def test_the_spaced_mask_loses_no_allowed_substitution():
    """Every way to substitute the allowed fifth of a stretch leaves a seed of the spaced mask whole."""
    assert decontamination.SPACED[-1] + 1 > len(decontamination.SPACED)
    for n in range(8, 25):
        allowed = n - -(-8 * n // 10)
        assert all(keeps_a_seed(decontamination.SPACED, n, set(gone)) for gone in itertools.combinations(range(n), allowed)), n


def test_a_very_long_text_takes_seconds(frame):
    import time

    item = " ".join(f"q{k}" for k in range(40))
    filler = " ".join(f"w{k % 9973}" for k in range(256_000))
    bench = frame([(1, item)] + [(2 + k, " ".join(f"z{k}x{j}" for j in range(30))) for k in range(50)], "item_id long, text string")
    decontamination.leaks(docs_of(frame, [(1, item)]), bench).collect()
    begun = time.time()
    got = decontamination.leaks(docs_of(frame, [(1, f"{filler} {item} {filler}"), (2, filler)]), bench).collect()
    assert [(r.doc_id, r.item_id, r.doc_token) for r in got] == [(1, 1, 256_000)]
    assert time.time() - begun < 30


# licenses

def test_licenses(frame):
    notice = licenses.NOTICES["MIT"][2].split()
    broken = [w if k % 20 != 7 else "other" for k, w in enumerate(notice)]
    filler = [f"f{k}" for k in range(90)]
    texts = [(1, "x. Released under the MIT License."), (2, " ".join([*filler, *notice, *filler])), (3, " ".join(filler)), (4, None), (5, "under the MIT"),
             (6, " ".join([*filler[:7], *notice[:12], *filler])), (None, "Licensed under CC BY-NC 4.0.\nx"), (7, "This work is licensed under the GNU General Public License, version 3."),
             (8, " ".join([*notice[:30], *filler[:1], *notice[30:]])), (9, " ".join(broken))]
    got = {(r.doc_id, r.license): r for r in licenses.license_matches(docs_of(frame, texts)).collect()}
    assert set(got) == {(1, "MIT"), (2, "MIT"), (None, "CC-BY-NC-4.0"), (7, "GPL-3.0"), (8, "MIT")}
    assert got[1, "MIT"].containment == 1.0 and got[1, "MIT"].first_token == 1
    assert 0.8 <= got[8, "MIT"].containment < 1
    assert licenses.license_matches(docs_of(frame, [])).collect() == []
    with pytest.raises(ValueError):
        licenses.license_matches(docs_of(frame, texts), {"x": ("too short",)})


MIT_TEXT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so, subject to the following conditions:"""


def plain_licenses(text, templates):
    """{license: (largest containment, first matched shingle)} by all windows of all templates."""
    def shingles(t):
        w = re.findall(r"[^\W_]+", t.lower())
        return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]

    doc, found = shingles(text), []
    for name, texts in templates.items():
        for t in texts:
            wanted = set(shingles(t))
            length, step = licenses.window_of(licenses.class_of(len(wanted)))
            for begin in range(0, len(doc), step):
                places = [i for i in range(begin, min(begin + length, len(doc))) if doc[i] in wanted]
                share = len({doc[i] for i in places}) / len(wanted)
                if share >= 0.8:
                    found.append((name, share, places))
    best = {}
    for name, share, places in found:
        if all(s <= share or not set(p) & set(places) for _, s, p in found):
            old = best.get(name, (0.0, len(doc)))
            best[name] = (max(old[0], share), min(old[1], places[0]))
    return best


def test_licenses_beside_each_other_equal_brute_force(frame):
    rng = random.Random(9)
    apache = "Licensed under the Apache License, Version 2.0."
    every = [t for texts in licenses.NOTICES.values() for t in texts]
    texts = [f"{apache} {MIT_TEXT}", f"{' '.join(['x'] * 30)} {apache}\n{MIT_TEXT}", MIT_TEXT]
    for _ in range(60):
        words = " and then ".join(rng.choices(every, k=rng.randint(1, 4))).split()
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = "other"
        texts.append(" ".join([*["pad"] * rng.randint(0, 25), *words]))
    want = {(i, name): value for i, t in enumerate(texts) for name, value in plain_licenses(t, licenses.NOTICES).items()}
    assert {(0, "MIT"), (0, "Apache-2.0"), (1, "MIT"), (1, "Apache-2.0"), (2, "MIT")} <= want.keys() and want[2, "MIT"][0] == 1
    docs = docs_of(frame, list(enumerate(texts)))
    for bound in (licenses.MAX_TEMPLATE_SHINGLES, 0):
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(licenses, "MAX_TEMPLATE_SHINGLES", bound)
            got = {(r.doc_id, r.license): (r.containment, r.first_token) for r in licenses.license_matches(docs).collect()}
        assert got.keys() == want.keys()
        assert all(got[k][0] == pytest.approx(want[k][0]) and got[k][1] == want[k][1] for k in want)


def test_license_in_a_very_long_text(frame):
    long = " ".join(f"w{i % 7001}" for i in range(200_000))
    row, = licenses.license_matches(docs_of(frame, [(1, f"{long} {MIT_TEXT} {long}")])).collect()
    assert (row.license, row.containment, row.first_token) == ("MIT", 1.0, 200_000)


def test_license_bands_rarely_miss():
    for n in range(1, 257):
        size = licenses.class_of(n)
        length, step = licenses.window_of(size)
        assert size >= n and length >= n + step - 1
        jaccard = 0.8 * n / (length + 0.2 * n)
        assert (1 - jaccard) ** licenses.BANDS < 1e-6, n
