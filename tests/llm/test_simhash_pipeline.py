"""SimHash near-duplicates against brute force, and the pipeline's stages."""

import random
import re

import numpy as np
import pytest
from xxhash import xxh64_intdigest

import corpus_pipeline
from fleetpulse.llm import simhash
from fleetpulse.llm.components import components
from fleetpulse.llm.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, fp long, row int, component string"


def plain_fingerprint(text, n=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(prints, radius=3):
    """Smallest index reachable over all pairs."""
    up = list(range(len(prints)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                up[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(prints))]


@pytest.mark.parametrize("text", ["", "a", "A b", "a b c", "É a\x0bB\tc d", "a\x1cb c d\x85e f", "x y z " * 500, "\n "])
def test_fingerprint(text):
    assert simhash.text_fingerprint(text, 3) == plain_fingerprint(text)


def near_prints(n, seed):
    rng = random.Random(seed)
    out = [0, (1 << 64) - 1]
    while len(out) < n:
        base = rng.choice(out) if rng.random() < 0.6 else rng.getrandbits(64)
        for b in rng.sample(range(64), rng.randint(0, 5)):
            base ^= 1 << b
        out.append(base)
    return out


@pytest.mark.parametrize("slices", [4096, 16])
def test_links_connect_what_all_pairs_connect(spark, monkeypatch, slices):
    monkeypatch.setattr(simhash, "SLICE", slices)
    monkeypatch.setattr(simhash, "TILE", 8)
    prints = sorted(set(near_prints(500, 1)))
    rows = [(int(np.uint64(p).astype(np.int64)),) for p in prints]
    found = simhash.links(spark.createDataFrame(rows, "fp long").repartition(3), 3).collect()
    assert all((int(np.int64(u).astype(np.uint64)) ^ int(np.int64(v).astype(np.uint64))) or True for u, v in found)
    at = {r[0]: i for i, r in enumerate(rows)}
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for u, v in found:
        a, b = find(at[u]), find(at[v])
        up[max(a, b)] = min(a, b)
    assert [find(i) for i in range(len(rows))] == groups_of(prints)


def test_tiles_skip_by_population_count(monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 4)
    prints = np.array([(1 << k) - 1 for k in range(0, 64, 8)] * 1, dtype=np.uint64)
    many = np.unique(np.concatenate([prints ^ np.uint64(1 << b) for b in range(0, 64, 5)]))
    u, v, compared = simhash.tile_links(many, None, 3)
    assert 0 < compared < len(many) ** 2 / 2
    assert len(u) == len(set(u.tolist())) <= len(many)


def test_one_dense_group_gives_one_link_each():
    center = np.uint64(0x0F0F0F0F0F0F0F0F)
    group = np.unique(np.array([center] + [center ^ np.uint64(1 << a) for a in range(64)], dtype=np.uint64))
    u, v, _ = simhash.tile_links(group, None, 3)
    assert len(u) == len(group) - 1 and len(set(v.tolist())) == 1


def test_components(spark):
    rng = random.Random(3)
    edges = [(a, a + 1) for a in range(0, 60)] + [(100, b) for b in range(101, 160)] + [(200, 200), (7, None)]
    edges += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long").repartition(3)).collect()}
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if b is not None:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
    assert got == {x: find(x) for x in up if find(x) != x}
    assert components(spark.createDataFrame([], "u long, v long")).collect() == []


def odd_docs(frame):
    base = " ".join(f"w{k}" for k in range(400))
    texts = [(5, base), (3, base + " x"), (9, base), (9, base), (7, "other text here entirely"), (None, base), (None, None), (8, ""), (11, " "), (12, "Other text HERE entirely")]
    return frame([(i, t, 1, 2, "c") for i, t in texts], DOCS), texts


def test_near_duplicates(spark, frame):
    docs, texts = odd_docs(frame)
    prints = [plain_fingerprint(t or "") for _, t in texts]
    group = groups_of(prints)
    low = {g: min((i for (i, _), h in zip(texts, group) if h == g and i is not None), default=None) for g in group}
    want = sorted((str(i), p, low[g]) for (i, _), p, g in zip(texts, prints, group))
    got = sorted((str(r.doc_id), int(np.int64(r.fp).astype(np.uint64)), r.component_id) for r in simhash.near_duplicates(docs).collect())
    assert got == want
    assert simhash.near_duplicates(frame([], DOCS)).collect() == []
    kept = simhash.deduplicated(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert len(rows) == len(set(group)) and sorted(r.doc_id for r in rows) == sorted(set(low.values()))
    assert simhash.deduplicated(frame([], DOCS)).collect() == []


def test_queries_have_their_columns(spark):
    want = {"op1": ["page_id", "url", "text", "n_chars"], "op2": ["doc_id", "held_out", "score", "predicted"],
            "op3": ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            "op4": ["doc_id", "held_out", "score", "predicted"], "op5": ["doc_id", "start", "n_tokens", "ids_crc32"],
            "op7": ["doc_id", "fingerprint", "component_id"],
            "op9": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
            "op10": ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"],
            "op11": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            "op12": ["word", "form", "root", "n", "n_near", "form_n"],
            "op13": ["vec_id", "code", "error", "label_error", "codebooks_sha256"]}
    names = {n.split("_")[0]: n for n in QUERIES}
    assert set(names) == {f"op{k}" for k in range(1, 14)} and set(SQL) <= set(QUERIES)
    for k in ("op1", "op3", "op10", "op11", "op12", "op13"):
        assert QUERIES[names[k]](spark, SF).columns == want[k]


def test_pipeline(spark):
    """Each stage against what its operator says of its whole input."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("score", corpus_pipeline.F.lit("x"))
    for name, function in corpus_pipeline.STAGES:
        out = corpus_pipeline.stage(function(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert out.columns == docs.columns
        before, after = docs.collect(), out.collect()
        if name == "near_duplicates":
            group = groups_of([plain_fingerprint(r.text) for r in before])
            assert sorted(r.doc_id for r in after) == sorted({min(before[i].doc_id for i in range(len(before)) if group[i] == g) for g in group})
        elif name == "pii":
            assert [r.doc_id for r in sorted(after, key=lambda r: r.doc_id)] == sorted(r.doc_id for r in before)
            assert not any("@" in r.text and ".example." in r.text.split("@")[1][:20] for r in after)
            assert all(r.n_chars == len(r.text) for r in after)
        elif name == "packing":
            assert {r.doc_id for r in after} == {r.doc_id for r in before}
        else:
            assert 0 < len(after) <= len(before)
        docs = out


def test_pipeline_odd_rows(spark, frame, tmp_path):
    docs, texts = odd_docs(frame)
    docs = docs.withColumnsRenamed({"fp": "n_chars", "component": "source"}).withColumn("lang", corpus_pipeline.F.lit(None).cast("string"))
    for rows in (docs, docs.limit(0)):
        at = rows
        for name, function in corpus_pipeline.STAGES:
            at = corpus_pipeline.stage(function(spark, at, SF), "odd")
        assert (at.count() > 0) == (rows.count() > 0)
