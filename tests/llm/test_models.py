"""Quality and toxicity models: gradients, accuracy on held-out rows, odd rows."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fleetpulse.llm import quality_svm, toxicity_gru, training
from fleetpulse.llm.common import beside_text, fold
from fleetpulse.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
DOCS = "doc_id long, text string, score string, id int, label int"


def test_folds_are_crc32(spark):
    rows = spark.range(50).withColumnRenamed("id", "doc_id").select("doc_id", fold("doc_id", 5).alias("f")).collect()
    assert all(r.f == zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)


def test_features_are_indicators_of_the_whole_text():
    marked = np.zeros(1 << quality_svm.BITS, dtype=bool)
    one = quality_svm.features("the cat", marked)
    assert not marked.any()
    assert set(one) == set(quality_svm.features("the cat", marked))
    assert set(quality_svm.features("the cat " * 3, marked)) > set(one) - set(quality_svm.features("zzz", marked))
    assert len(quality_svm.features("", marked)) == 0 and len(quality_svm.features(" \n ", marked)) > 0
    late = set(quality_svm.features("a " * 50_000 + "!!", marked)) - set(quality_svm.features("a " * 50_000, marked))
    assert late


def test_word_shapes():
    shapes = quality_svm._word_shapes(np.frombuffer(b" Aa aa aa bb! AA", dtype=np.uint8))
    assert len(shapes) == 5
    assert (shapes >> 6 & 1).tolist() == [0, 0, 1, 0, 0] and (shapes >> 2 & 3).tolist() == [0, 0, 0, 2, 0]


def test_dual_coordinate_descent_solves_the_hinge_problem():
    rng = np.random.default_rng(0)
    rows = [np.sort(rng.choice(40, 8, replace=False)) for _ in range(60)]
    labels = np.array([int(3 in r or 5 in r) for r in rows])
    scale = rng.normal(1, 0.3, 1 << quality_svm.BITS)
    w, b = quality_svm.dual_coordinate_descent(rows, scale, labels, rounds=2000)
    signs = np.where(labels > 0, 1, -1)
    x = np.zeros((60, 41))
    for i, r in enumerate(rows):
        x[i, r], x[i, 40] = scale[r] / np.sqrt(8), 1
    cost = np.where(labels > 0, 60 / (2 * labels.sum()), 60 / (2 * (60 - labels.sum())))

    def value(v):
        return 0.5 * v @ v + (cost * np.maximum(0, 1 - signs * (x @ v))).sum()

    best = np.append(w[:40], b)
    assert all(value(best) <= value(best + rng.normal(0, s, 41)) + 1e-4 for s in (1e-3, 1e-2, 0.1, 1) for _ in range(200))


def test_probability_curve_follows_class_sizes():
    rng = np.random.default_rng(1)
    margins = np.concatenate([rng.normal(-1, 1, 500), rng.normal(1, 1, 500)])
    labels = np.repeat([0, 1], 500)
    even, rare = (training.fit_probability(margins, labels, s) for s in ({0: 500, 1: 500}, {0: 9500, 1: 500}))
    assert even[0] == pytest.approx(2, abs=0.4) and abs(even[1]) < 0.3
    assert rare[1] < even[1] - 2


def test_gru_gradients():
    net = toxicity_gru.Network.new(3)
    p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    gates = {d: rng.normal(0, 0.5, (6, 4, 3 * toxicity_gru.HIDDEN)) for d in "fb"}
    lengths, labels = np.array([6, 3, 1, 0]), np.array([1.0, 0, 1, 0])

    def loss():
        z = toxicity_gru.forward(p, gates["f"], gates["b"], lengths)[0]
        return (np.log1p(np.exp(z)) - labels * z).sum()

    z, kept = toxicity_gru.forward(p, gates["f"], gates["b"], lengths, keep=True)
    grads = toxicity_gru.backward(p, kept, 1 / (1 + np.exp(-z)) - labels)
    for name, target in [("gates_f", gates["f"]), ("gates_b", gates["b"])] + [(k, p[k]) for k in ("u_f", "u_b", "wa", "ba", "va", "out", "bias")]:
        for _ in range(12):
            at = tuple(rng.integers(0, n) for n in target.shape)
            old, eps = target[at], 1e-5
            target[at] = old + eps
            up = loss()
            target[at] = old - eps
            down = loss()
            target[at] = old
            assert grads[name][at] == pytest.approx((up - down) / (2 * eps), abs=1e-6), (name, at)


def test_windows_cover_and_overlap():
    for n in (0, 1, 63, 64, 65, 112, 113, 1000):
        starts = list(toxicity_gru.window_starts(n))
        covered = {k for s in starts for k in range(s, min(n, s + toxicity_gru.WINDOW))}
        assert covered == set(range(n)) and starts
        assert all(b - a < toxicity_gru.WINDOW for a, b in zip(starts, starts[1:]))


def _toy(n=240):
    rng = np.random.default_rng(4)
    words = [f"w{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(200)]
    texts, labels = [], []
    for i in range(n):
        text = list(rng.choice(words, rng.integers(1, 200)))
        if i % 2:
            text[rng.integers(len(text))] = rng.choice(["zorgish", "zorgel", "blarg!!"])
        texts.append(" ".join(text))
        labels.append(i % 2)
    return texts, np.array(labels)


def test_gru_learns_and_scores_every_window():
    texts, labels = _toy()
    net = toxicity_gru.fit(texts[:200], labels[:200], {0: 100, 1: 100})
    scorer = toxicity_gru.Scorer(net)
    held = scorer.scores(texts[200:])
    assert ((held >= 0.5) == labels[200:]).mean() >= 0.9
    clean = " ".join(w for t in texts[200::2] for w in t.split())
    long = f"{clean} blarg!! {clean}"  # one word deep in a long text
    assert scorer.scores([long])[0] > scorer.scores([clean])[0]
    assert np.allclose(scorer.scores(["", "x", long]), [scorer.scores([t])[0] for t in ("", "x", long)], atol=1e-5)


def _peak_mb(work):
    tracemalloc.start()
    work()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / 1e6


def test_gru_memory_does_not_follow_the_distinct_words():
    net, words = toxicity_gru.Network.new(3), [f"longish{k:08d}" for k in range(60_000)]
    scorer, many = toxicity_gru.Scorer(net), [" ".join(words[k:k + 100]) for k in range(0, len(words), 100)]
    assert _peak_mb(lambda: scorer.scores(many)) < 70  # 39 n-grams a word; all their vectors at once are 150 MB
    corpus = toxicity_gru.Corpus(many)
    assert _peak_mb(lambda: toxicity_gru.word_inputs(net.p, corpus.slots, corpus.chars, corpus.counts)) < 40
    each = np.concatenate([net.inputs([w]) for w in words[:5000]])
    assert np.array_equal(net.inputs(words)[:5000], each)


def test_gru_scores_beyond_the_cache(monkeypatch):
    net = toxicity_gru.Network.new(3)
    texts = [" ".join(f"w{k * j}" for k in range(50 * j)) for j in range(8)]
    expected = toxicity_gru.Scorer(net).scores(texts)
    monkeypatch.setattr(toxicity_gru, "CACHE_WORDS", 60)
    monkeypatch.setattr(toxicity_gru, "AT_ONCE", 7)
    scorer = toxicity_gru.Scorer(net)
    assert np.allclose(scorer.scores(texts), expected, atol=1e-6)
    assert np.allclose([scorer.scores([t])[0] for t in texts], expected, atol=1e-6)


def test_kept_text_travels_once(frame):
    docs = frame([(1, "a b", None, 7, 8), (None, None, "x", None, None), (2, "", "y", 1, 1)], DOCS)

    def sizes(texts):
        for column in texts:
            yield pa.array([len(t or "") for t in column.to_pylist()], pa.int64())

    made = beside_text(docs, "text", ("id", "text", "doc_id"), "n", "long", sizes)
    assert made.columns == ["id", "text", "doc_id", "n"]
    assert sorted(map(tuple, made.collect()), key=str) == sorted([(7, "a b", 1, 3), (None, None, None, 0), (1, "", 2, 0)], key=str)
    sent = made._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[1]
    assert "_text#" in sent and "AS _1#" not in sent
    numbers = beside_text(docs, "id", ("id",), "n", "long", sizes)  # no string: kept as it is
    assert dict(numbers.dtypes)["id"] == "int" and sorted(r.n for r in numbers.collect()) == [0, 1, 1]


def test_models_without_a_class():
    net = toxicity_gru.fit(["a b", "c"], np.array([0, 0]), {0: 2})
    assert np.allclose(toxicity_gru.Scorer(net).scores(["a", ""]), 0.25)
    model = quality_svm.fit([np.array([1]), np.array([2])], np.array([1, 1]), {1: 2})
    assert np.allclose(model.score([model.margin(np.array([1])), model.margin(np.array([], dtype=int))]), 0.75)


def test_sample_is_bounded_and_ignores_odd_labels(spark, frame):
    docs = frame([(i, f"t{i}", "s", 1, 1) for i in range(30)] + [(3, "again", "s", 1, 1), (None, "n", "s", 1, 1), (4, None, "s", 1, 1)], DOCS)
    labels = frame([(i, i % 2) for i in range(25)] + [(26, 5), (27, None), (None, 1), (2, 1), (77, 1)], "doc_id long, y int")
    sample, sizes = training.labelled_sample(docs, labels, "y", F.col("doc_id") != 0, 5, 100)
    rows = sample.collect()
    assert len({r.id for r in rows}) == len(rows) and sum(r.label == 0 for r in rows) == 5 and sum(r.label for r in rows) <= 5
    assert sizes == {0: 11, 1: 14} and 0 not in {r.id for r in rows}
    assert training.labelled_sample(frame([], DOCS), frame([], "doc_id long, y int"), "y", F.lit(True), 5, 100)[0].collect() == []


def test_scoring_odd_rows(frame):
    docs = frame([(1, "a b", "x", 7, 8), (1, "a b", "x", 7, 8), (None, None, None, None, None), (2, "", "x", 1, 1)], DOCS)
    net = toxicity_gru.fit(*_toy(40), {0: 20, 1: 20}, rounds=2)
    model = quality_svm.fit([np.array([1]), np.array([2])], np.array([0, 1]), {0: 1, 1: 1})
    for module, fitted in ((toxicity_gru, net), (quality_svm, model)):
        rows = module.score(docs, fitted, keep=("doc_id", "score", "id"), score_col="p").collect()
        assert len(rows) == 4 and all(0 <= r.p <= 1 for r in rows)
        assert {r.p for r in rows if r.doc_id is None} == {r.p for r in rows if r.doc_id == 2}
        assert module.score(frame([], DOCS), fitted).collect() == []


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    quality = QUERIES["op2_quality_classifier"](spark, SF)
    right = quality.where("held_out").join(labels, "doc_id").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert right >= 0.95 and quality.count() == 1000


def test_held_out_toxic_documents_are_caught(spark):
    """On the larger table: about 290 toxic documents to learn from, 144 held out."""
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    toxic = QUERIES["op4_toxicity"](spark, sf)
    held = toxic.where("held_out").join(labels.where("toxic in (0, 1)"), "doc_id")
    rate = {r["toxic"]: r["p"] for r in held.groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert rate[1] >= 0.4 and rate[0] <= 0.05 and toxic.count() == 10_000
