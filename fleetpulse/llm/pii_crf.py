"""Personal data: base patterns, extended by a skip-chain conditional random field.

Base patterns find e-mail addresses, IP addresses, card and phone numbers; what
they find stays.  The field then labels the other tokens with a digit or an at
sign, each document on its own: neighbouring tokens are chained, and distant
tokens that repeat a string or its last seven digits are linked by skip edges
to the first of them, which favour one label for all.  Tokens inside base
findings are observed; loopy belief propagation gives the rest their
probabilities, and tokens that repeat a finding and are surely personal become
further spans, so a number that was found once is also found where its form is
unusual.  The form of such a token says nothing, so it has no features.

The weights are trained here, in numpy, by pseudo-likelihood on a bounded
sample of documents with the base findings as labels: of findings that repeat,
every second one hides its features, and tokens that repeat a finding without
being one have no label to learn.  Every document is read
whole, in one pass without a shuffle; words without digits or at signs are no
nodes, which bounds the work tables by a document's numbers and addresses.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside_text

#: In the order in which spans of one start are listed; label 0 is "other".
KINDS = ("email", "ip", "card", "phone")
OTHER = 0

_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL = _LOCAL + r"++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_EMAIL_HERE = re.compile(_EMAIL)
#: From the start of a run only: every later start in it meets the same at sign.
_EMAIL_NEXT = re.compile(rf"(?<!{_LOCAL}){_EMAIL}")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_NOT_DIGIT = re.compile(r"[^0-9]")
_AROUND = " .,;:!?\"'()[]{}<>#$%&*|"

Span = tuple[int, int, int]  # start, end (code points, end exclusive), label


def luhn(digits: str) -> bool:
    """Whether the check digit fits."""
    values = [int(c) for c in reversed(digits)]
    return sum(v if i % 2 == 0 else v * 2 - 9 * (v > 4) for i, v in enumerate(values)) % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    at = 0
    while m := _EMAIL_HERE.match(text, at) or _EMAIL_NEXT.search(text, at):
        yield m.start(), m.end(), 1
        at = m.end()


def _ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part[-4:]) <= 255 for part in m.groups()):
            yield m.start(), m.end(), 2


def _cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m[0])
        if 12 <= len(digits) <= 19 and luhn(digits):
            yield m.start(), m.end(), 3


def _phones(text: str) -> Iterator[Span]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
            yield m.start(), m.end(), 4


def base_spans(text: str) -> list[Span]:
    """Findings of the base patterns, leftmost and not overlapping within a kind, by start and kind."""
    found: list[Span] = []
    if "@" in text:
        found += _emails(text)
    found += _ips(text)
    found += _cards(text)
    if "+" in text:
        found += _phones(text)
    return sorted(found, key=lambda s: (s[0], s[2]))


@dataclass
class Graph:
    """Nodes of one text: token spans, features, base labels (0 where none), and its edges."""

    spans: list[tuple[int, int]]
    features: list[list[float]]
    observed: list[int]
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]


N_FEATURES = 26


def linked_groups(n: int, skip: list[tuple[int, int]]) -> list[int]:
    """The smallest node that each node is linked to, over any number of links."""
    group = list(range(n))

    def root(i: int) -> int:
        while group[i] != i:
            group[i] = group[group[i]]
            i = group[i]
        return i

    for a, b in skip:
        a, b = root(a), root(b)
        group[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def node_features(core: str, digits: str, follows: bool, leads: bool) -> list[float]:
    """What a token looks like; ``follows`` and ``leads``: the token beside it is a node as well."""
    n = len(digits)
    letters = sum(c.isalpha() for c in core)
    parts = core.split(".")
    quad = len(parts) == 4 and all(p.isdigit() for p in parts)
    sizes = [n == 0, 1 <= n <= 3, 4 <= n <= 6, 7 <= n <= 8, 9 <= n <= 11, 12 <= n <= 15, 16 <= n <= 19, n > 19]
    marks = [c in core for c in "@+-(/:=_"]
    return [float(x) for x in (
        1, *sizes, *marks, letters == 0, letters > n, quad, quad and all(len(p) < 4 and int(p) < 256 for p in parts),
        12 <= n <= 19 and letters == 0 and luhn(digits), core.isdigit(), "@" in core and "." in core.rpartition("@")[2],
        follows, leads)]


def graph_of(text: str, base: list[Span]) -> Graph:
    """Nodes are tokens with a digit or an at sign; a token overlapping a base finding is observed."""
    tokens = [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text)]
    g = Graph([], [], [], [], [])
    beside = [not text[a[1]:b[0]].strip() and b[0] - a[1] <= 2 for a, b in zip(tokens, tokens[1:])]
    hub: dict[str, int] = {}
    k = 0
    ends = np.maximum.accumulate([s[1] for s in base]).tolist() if base else []
    for i, (start, end, raw) in enumerate(tokens):
        core = raw.strip(_AROUND) or raw
        begin = start + raw.index(core)
        stop = begin + len(core)
        while k < len(base) and ends[k] <= begin:
            k += 1
        label, whole, alone = OTHER, "", True
        for s in base[k:]:
            if s[0] >= stop:
                break
            if s[1] > begin:
                label = s[2]
                alone = start <= s[0] and s[1] <= end  # the finding is within the token
                if s[1] <= stop:  # its last token stands for the finding's digits as well
                    whole = _NOT_DIGIT.sub("", text[s[0]:s[1]])
                break
        digits = _NOT_DIGIT.sub("", core)
        g.spans.append((begin, stop))
        g.observed.append(label)
        g.features.append(node_features(core, digits, i > 0 and beside[i - 1], i < len(beside) and beside[i]))
        if i and beside[i - 1]:
            g.chain.append((i - 1, i))
        # Parts of a longer finding are no entity of their own: only its last token has a key, the whole's.
        keys = [core.lower()] if len(core) >= 4 and alone else []
        keys += {"#" + d[-7:] for d in (digits if alone else "", whole) if len(d) >= 7}
        linked = set()
        for key in keys:  # to the first node alike: links grow with the nodes, and any two are two links apart
            first = hub.setdefault(key, i)
            if first != i and first not in linked:
                linked.add(first)
                g.skip.append((first, i))
    return g


@dataclass
class Field:
    """Log-potentials: of features and label, of chained labels, of a label shared over a skip edge."""

    node: np.ndarray
    chain: np.ndarray
    skip: np.ndarray


class Batch:
    """Graphs of many texts as one, with edges in both directions."""

    def __init__(self, graphs: list[Graph]):
        sizes = [len(g.spans) for g in graphs]
        self.begins = np.cumsum([0, *sizes])
        self.features = np.array([f for g in graphs for f in g.features]).reshape(-1, N_FEATURES)
        self.observed = np.array([o for g in graphs for o in g.observed], dtype=np.int64)

        def edges(of: str) -> np.ndarray:
            return np.array([(a + b0, b + b0) for g, b0 in zip(graphs, self.begins) for a, b in getattr(g, of)],
                            dtype=np.int64).reshape(-1, 2)

        self.chain, self.skip = edges("chain"), edges("skip")
        groups = [[x + b0 for x in linked_groups(len(g.spans), g.skip)] for g, b0 in zip(graphs, self.begins)]
        self.group = np.array([x for g in groups for x in g], dtype=np.int64)
        found = np.zeros(len(self.group), dtype=bool)
        found[self.group[self.observed > 0]] = True
        #: Unobserved nodes that repeat a finding.
        self.repeats = found[self.group] & (self.observed == 0)
        self.text = np.repeat(np.arange(len(sizes)), sizes)


#: Prior mean of the skip potentials: repeated tokens share a label unless training says otherwise.
SKIP_PRIOR = 5.0


def fit(batch: Batch, steps: int = 600, rate: float = 0.1, decay: float = 2e-4) -> Field:
    """Pseudo-likelihood: each node's label given its neighbours' base labels, classes weighted alike."""
    labels = batch.observed
    n, k = len(labels), len(KINDS) + 1
    field = Field(np.zeros((N_FEATURES, k)), np.zeros((k, k)), np.full(k, SKIP_PRIOR))
    if not n:
        return field
    counts = np.bincount(labels, minlength=k)
    weight = (n / (np.count_nonzero(counts) * np.maximum(counts, 1)))[labels] / n
    weight[batch.repeats] = 0
    often = np.bincount(batch.group[labels > 0], minlength=n)[batch.group] > 1
    hidden = np.flatnonzero(often & (labels > 0))[::2]
    features = batch.features.copy()
    features[hidden] = 0
    truth = np.eye(k)[labels]
    a, b = batch.chain.T
    p, q = batch.skip.T
    names = ("node", "chain", "skip")
    first, second = ({x: np.zeros_like(getattr(field, x)) for x in names} for _ in range(2))
    for step in range(1, steps + 1):
        logits = features @ field.node
        np.add.at(logits, b, field.chain[labels[a]])
        np.add.at(logits, a, field.chain[:, labels[b]].T)
        np.add.at(logits, q, truth[p] * field.skip)
        np.add.at(logits, p, truth[q] * field.skip)
        logits -= logits.max(axis=1, keepdims=True)
        prob = np.exp(logits)
        prob /= prob.sum(axis=1, keepdims=True)
        error = (prob - truth) * weight[:, None]
        chain = truth[a].T @ error[b] + error[a].T @ truth[b]
        skip = (truth[p] * error[q] + truth[q] * error[p]).sum(axis=0)
        for name, grad in zip(names, (features.T @ error, chain, skip)):
            value = getattr(field, name)
            grad = grad + decay * (value - (SKIP_PRIOR if name == "skip" else 0.0))
            first[name] = 0.9 * first[name] + 0.1 * grad
            second[name] = 0.999 * second[name] + 0.001 * grad * grad
            value -= rate * (first[name] / (1 - 0.9 ** step)) / (np.sqrt(second[name] / (1 - 0.999 ** step)) + 1e-8)
    return field


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis=axis))


def infer(field: Field, batch: Batch, rounds: int = 200, damping: float = 0.3) -> np.ndarray:
    """Label probabilities of every node by loopy sum-product; observed nodes keep their label.

    Each text's messages are passed until its own stand still, whatever texts are beside it.
    """
    k = len(KINDS) + 1
    node = np.where(batch.repeats[:, None], 0.0, batch.features @ field.node)
    seen = batch.observed > 0
    node[seen] = np.where(np.eye(k)[batch.observed[seen]] > 0, 0.0, -50.0)
    node -= _log_sum(node, 1)[:, None]
    sources = np.concatenate([batch.chain[:, 0], batch.skip[:, 0], batch.chain[:, 1], batch.skip[:, 1]])
    targets = np.concatenate([batch.chain[:, 1], batch.skip[:, 1], batch.chain[:, 0], batch.skip[:, 0]])
    n_edges, n_chain = len(sources) // 2, len(batch.chain)
    if not n_edges:
        return np.exp(node)
    twin = np.concatenate([np.arange(n_edges, 2 * n_edges), np.arange(n_edges)])
    alike = np.diag(np.maximum(field.skip, 0.0))  # skip edges favour one label, never different ones
    tables = np.concatenate([np.broadcast_to(t, (m, k, k)) for t, m in (
        (field.chain, n_chain), (alike, n_edges - n_chain), (field.chain.T, n_chain), (alike, n_edges - n_chain))])
    messages = np.full((2 * n_edges, k), -np.log(k))
    text = batch.text[sources]
    moving = np.arange(2 * n_edges)  # messages of texts that don't stand still yet
    for _ in range(rounds):
        belief = node.copy()
        np.add.at(belief, targets[moving], messages[moving])
        new = _log_sum((belief[sources[moving]] - messages[twin[moving]])[:, :, None] + tables[moving], 1)
        new -= _log_sum(new, 1)[:, None]
        change = np.zeros(len(batch.begins))
        np.maximum.at(change, text[moving], np.abs(new - messages[moving]).max(axis=1))
        messages[moving] = damping * messages[moving] + (1 - damping) * new
        moving = moving[change[text[moving]] >= 1e-3]
        if not len(moving):
            break
    belief = node.copy()
    np.add.at(belief, targets, messages)
    return np.exp(belief - _log_sum(belief, 1)[:, None])


def added_spans(graph: Graph, prob: np.ndarray, base: list[Span], sure: float, repeats: np.ndarray) -> list[Span]:
    """Unobserved tokens that repeat a base finding and surely are personal, a span each; none that overlaps a finding."""
    best = prob[:, 1:].argmax(axis=1)
    chosen = np.flatnonzero(repeats & (prob[:, 1:].max(axis=1) >= sure))
    spans = [(*graph.spans[i], int(best[i]) + 1) for i in chosen]
    return [x for x in spans if not any(s[0] < x[1] and x[0] < s[1] for s in base)]


def find_all(texts: list[str], field: Field, sure: float) -> list[tuple[list[Span], list[Span]]]:
    """Base and all spans of each text."""
    bases = [base_spans(t) for t in texts]
    graphs = [graph_of(t, b) for t, b in zip(texts, bases)]
    batch = Batch(graphs)
    prob = infer(field, batch)
    out = []
    for g, base, begin, end in zip(graphs, bases, batch.begins, batch.begins[1:]):
        more = added_spans(g, prob[begin:end], base, sure, batch.repeats[begin:end]) if end > begin else []
        out.append((base, sorted(base + more, key=lambda s: (s[0], s[2]))))
    return out


def joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[label - 1]}:{start}:{end}" for start, end, label in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span (overlapping ones together) replaced by its first kind in brackets."""
    out, at, end = [], 0, 0
    for start, stop, label in spans:
        if start >= end:
            out += [text[at:start], f"[{KINDS[label - 1].upper()}]"]
        end = max(end, stop)
        at = end
    return "".join([*out, text[at:]])


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = 4000,
          max_chars: int = 50_000) -> Field:
    """Fit on at most ``sample_docs`` documents that have a node (smallest hashes of their id, of
    ``max_chars`` at most)."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    short = source.where(F.length("text") <= max_chars)
    with_nodes = short.where(F.col("text").rlike("[0-9@]") & F.col("id").isNotNull())
    chosen = with_nodes.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample_docs)
    taken = short.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("text").alias("text"))
    texts = [r["text"] for r in sorted(taken.collect(), key=lambda r: r["id"])]  # the bounded sample
    return fit(Batch([graph_of(t, base_spans(t)) for t in texts]))


def find(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text", sure: float = 0.9) -> DataFrame:
    """A row per row of ``docs``: the id, n_email, n_ip, n_card, n_phone (base findings), base_sha256 and
    ``spans`` (all findings as kind:start:end, comma-joined).

    A null text is empty: no findings.  Null ids pass through, repeated rows
    keep a row each, an empty table gives no rows, other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    fields = [*[pa.field(f"n_{k}", pa.int64()) for k in KINDS], pa.field("base_sha256", pa.string()),
              pa.field("spans", pa.string())]

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            found = find_all([t or "" for t in column.to_pylist()], shared.value, sure)
            counts = [pa.array([sum(s[2] == k for s in base) for base, _ in found], pa.int64())
                      for k in range(1, len(KINDS) + 1)]
            sums = pa.array([hashlib.sha256(joined(base).encode()).hexdigest() for base, _ in found], pa.string())
            yield pa.StructArray.from_arrays([*counts, sums, pa.array([joined(s) for _, s in found], pa.string())],
                                             fields=fields)

    kind = "struct<" + ", ".join(f"n_{k}: bigint" for k in KINDS) + ", base_sha256: string, spans: string>"
    return beside_text(docs, text_col, (id_col,), "_found", kind, run).select(id_col, "_found.*")


def redact(docs: DataFrame, field: Field, text_col: str = "text", sure: float = 0.9) -> DataFrame:
    """``docs`` with a kind in brackets for each finding in the text; all other columns stay.

    Null texts stay null; otherwise as ``find``.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            given = column.to_pylist()
            found = find_all([t or "" for t in given], shared.value, sure)
            yield pa.array([t if t is None else redacted(t, s) for t, (_, s) in zip(given, found)], pa.string())

    others = tuple(c for c in docs.columns if c != text_col)
    return beside_text(docs, text_col, others, text_col, "string", run).select(*docs.columns)
