"""Language-model scores: Katz backoff over Good-Turing discounted n-gram counts.

An n-gram's probability is its discounted relative count if it was seen in
training, else that of the n-gram without its first token, times a weight of
its history which makes all probabilities of the history add up to one.  This
goes down to single tokens; the mass that discounts take from these belongs to
one outcome for all unknown tokens.

Texts are cut into chunks of about ``CHUNK`` tokens, written once; a longer
text goes to several chunks as pieces that begin with their last tokens
before.  A chunk asks for its *distinct* n-grams, level by level:

* asks go to buckets by a hash of the n-gram, packed to one row per chunk and
  bucket, with the chunk's training counts and the lower level's probability;
* a bucket adds up the counts of all chunks, stores its part of the n-gram
  table, and answers every chunk with the counts of what it asked and what the
  weights of its histories take: the smallest count of a follower and, where
  the chunk may back off, the number of followers seen once, twice, ... and
  the sum of their lower probabilities;
* the answers meet the chunk again, which evaluates its tokens at this level
  and asks for the next.

n-grams are named exactly, by two ids of the level below: of the n-gram without
its last token (its history) and of that without its first (what is backed off
to); an n-gram without either was never seen and isn't asked for.  Ids number
a bucket's entries.  A frequent history is dealt over as many buckets as its
count fills, so no task holds all followers of one.  Equal n-grams of a chunk
move once, whatever their number.  Only the counts of counts and totals reach
the driver.
"""

from __future__ import annotations

import struct
import zlib
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ASCII_SPACE, stage, text_or_empty

#: Tokens of a chunk, and of a piece of a text.
CHUNK, PIECE = 1 << 20, 1 << 18
#: Words and n-grams asked of a bucket, about; a history with more occurrences than HOT is dealt over several buckets.
WORDS, BUCKET, HOT = 1 << 19, 1 << 21, 1 << 20
#: Counts up to this are discounted.
CUT = 5
#: Characters of a text split at once.
BLOCK = 1 << 22
#: Local ids of the boundary before a text and of the end token; words follow.
BEFORE, END = 0, 1
#: The end token among words: no word is a line feed.
END_WORD = b"\n"
#: Ids of the boundary (as a history) and of what training hasn't seen.
START, UNSEEN = -1, 0


# ------------------------------------------------------------------ packed arrays
def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed blob, equal bytes of neighbours side by side."""
    raw = [struct.pack("<I", len(arrays))]
    for a in arrays:
        raw.append(struct.pack("<3sQ", a.dtype.str.encode(), len(a)))
        raw.append(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    joined = b"".join(raw)
    return struct.pack("<Q", len(joined)) + pa.compress(joined, codec="zstd", asbytes=True)


def unpack(blob: bytes) -> list[np.ndarray]:
    raw = pa.decompress(blob[8:], struct.unpack_from("<Q", blob)[0], codec="zstd", asbytes=True)
    arrays, at = [], 4
    for _ in range(struct.unpack_from("<I", raw)[0]):
        name, n = struct.unpack_from("<3sQ", raw, at)
        kind = np.dtype(name.decode())
        at += 11
        planes = np.frombuffer(raw[at:at + n * kind.itemsize], np.uint8).reshape(kind.itemsize, n)
        arrays.append(np.ascontiguousarray(planes.T).reshape(-1).view(kind))
        at += n * kind.itemsize
    return arrays


def steps(x: np.ndarray) -> np.ndarray:
    """Differences of neighbours, the sign in the lowest bit."""
    d = np.diff(x, prepend=0)
    return (d << 1) ^ (d >> 63)


def unsteps(z: np.ndarray) -> np.ndarray:
    return np.cumsum((z >> 1) ^ -(z & 1))


def pairs(h: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first of each distinct pair in order of (h, w), number of its pair for each row)."""
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    wide = int(w.max()) + 1
    if (int(h.max()) + 2) * wide < 1 << 62:
        _, first, which = np.unique((h + 1) * wide + w, return_index=True, return_inverse=True)
        return first, which
    order = np.lexsort((w, h))
    new = np.ones(len(h), bool)
    new[1:] = (np.diff(h[order]) != 0) | (np.diff(w[order]) != 0)
    which = np.empty(len(h), np.int64)
    which[order] = np.cumsum(new) - 1
    return order[new], which


def bucket_of(h: np.ndarray, part: np.ndarray, buckets: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = h.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + part.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(buckets)).astype(np.int64)


# ------------------------------------------------------------------------- model
def discounts(n: list[int]) -> np.ndarray:
    """d[r], what a count r of up to ``CUT`` is multiplied by; ``n[r]`` n-grams have count r (r to CUT + 1).

    Good-Turing's discounts with Katz's cut-off, or a lower one if counts of
    counts are too uneven for it (a discount outside of 0 to 1).  If none
    works: d = 1 - D / r with D = n1 / (n1 + 2 n2), 3/4 at most (1/2 if
    nothing has count 1).
    """
    d = np.ones(CUT + 1)
    for top in range(CUT, 1, -1):
        if min(n[1:top + 1]) <= 0:
            continue
        common = (top + 1) * n[top + 1] / n[1]
        if common >= 1:
            continue
        some = [((r + 1) * n[r + 1] / (r * n[r]) - common) / (1 - common) for r in range(1, top + 1)]
        if all(0 < x < 1 for x in some):
            d[1:top + 1] = some
            return d
    taken = min(0.75, n[1] / (n[1] + 2 * n[2])) if n[1] else 0.5
    d[1:] = 1 - taken / np.arange(1, CUT + 1)
    return d


@dataclass(frozen=True)
class Level:
    """What is known of all training n-grams of one length: buckets, how many have counts 1, 2, ... CUT + 1, how many
    there are, and their occurrences."""

    buckets: int
    few: tuple[int, ...]
    ngrams: int
    total: int

    @property
    def discount(self) -> np.ndarray:
        return discounts([0, *self.few])


def left_over(total: np.ndarray, few: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(denominator, mass for unseen followers) of histories with ``total`` occurrences, ``few[r - 1]`` followers of count r."""
    taken = sum((1 - d[r]) * r * few[r - 1] for r in range(1, CUT + 1))
    # Nothing discounted: one more occurrence stands for all that is unseen.
    below = total + (taken <= 0)
    return below, np.where(taken <= 0, 1.0, taken) / below


def by(which: np.ndarray, x: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``x`` by group."""
    return np.bincount(which, weights=x, minlength=n)


@dataclass
class Chunk:
    """A chunk's tokens, evaluated level by level."""

    order: int
    tokens: np.ndarray
    sizes: np.ndarray
    train: np.ndarray
    train_docs: int
    state: dict = field(default_factory=dict)

    def __post_init__(self) -> None:
        context = self.order - 1
        lengths = self.sizes + context
        self.piece = np.repeat(np.arange(len(lengths)), lengths)
        self.at = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        self.scored = self.at >= context
        self.learned = self.scored & self.train[self.piece]

    def _before(self, x: np.ndarray, none: int) -> np.ndarray:
        out = np.roll(x, 1)
        out[self.at == 0] = none
        return out

    def words(self, level: Level, answers: list[list[np.ndarray]]) -> None:
        """Level 1: ``answers`` are (places, ids, counts) of the chunk's words."""
        ids, counts = np.full(int(self.tokens.max()) + 1, START, np.int64), np.zeros(int(self.tokens.max()) + 1, np.int64)
        for places, own, n in answers:
            ids[unsteps(places) + 1], counts[unsteps(places) + 1] = own, n
        self.gram, self.count = ids[self.tokens], counts[self.tokens]
        self.count1 = self.count
        below, free = left_over(np.float64(level.total), level.few, level.discount)
        d = np.where(self.count <= CUT, level.discount[np.minimum(self.count, CUT)], 1.0)
        self.p = np.where(self.count > 0, d * self.count / below, free)

    def ask(self, k: int, buckets: int) -> dict[int, tuple]:
        """Bucket -> (history and suffix of each n-gram, its training count, its suffix's probability; the histories'
        ids, and whether the chunk may back off from each)."""
        real = (self.at >= k - 1) & (self.tokens != BEFORE)
        h, total = self._before(self.gram, UNSEEN), self._before(self.count, 0)
        total[h == START] = self.train_docs
        known = np.flatnonzero(real & (h != UNSEEN))
        history, first, of_history = np.unique(h[known], return_index=True, return_inverse=True)
        total = total[known[first]]
        parts = 1 + total // HOT
        # Training has seen every n-gram of its own texts: only other texts back off.
        backs = by(of_history, ~self.learned[known], len(history)) > 0
        keyed = np.flatnonzero(self.gram[known] > UNSEEN)
        rows = known[keyed]
        first, which = pairs(h[rows], self.gram[rows])
        kh, kg = h[rows[first]], self.gram[rows[first]]
        kc = by(which, self.learned[rows], len(first)).astype(np.int64)
        kb = bucket_of(kh, kg % parts[of_history[keyed[first]]], buckets)
        each = np.repeat(np.arange(len(history)), parts)
        part = np.arange(len(each)) - np.repeat(np.cumsum(parts) - parts, parts)
        hb = bucket_of(history[each], part, buckets)
        one, _ = pairs(hb, each)  # two parts of a history may share a bucket
        hb, hi = hb[one], each[one]
        korder = np.argsort(kb, kind="stable")
        self.state = {"known": known, "of_history": of_history, "rows": rows, "which": which, "korder": korder, "hi": hi,
                      "total": total, "backs": backs}
        kb = kb[korder]
        asks = {}
        for b in np.unique(hb):
            k0, k1 = np.searchsorted(kb, [b, b + 1])
            h0, h1 = np.searchsorted(hb, [b, b + 1])
            own, its = korder[k0:k1], hi[h0:h1]
            asks[int(b)] = (kh[own], kg[own], kc[own], self.p[rows[first[own]]], history[its], backs[its])
        return asks

    def evaluate(self, k: int, level: Level, answers: list[list[np.ndarray]]) -> None:
        """Level k, after :meth:`ask`: answers in order of bucket."""
        s = self.state
        parts = [np.concatenate(x) for x in zip(*answers, strict=True)] if answers else [np.zeros(0, np.int64)] * (4 + CUT)
        found, ids, least, *few, low = parts
        counts, grams = np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
        counts[s["korder"]], grams[s["korder"]] = found, ids
        n, total, hi = len(s["total"]), s["total"], s["hi"]
        smallest = np.full(n, CUT + 1)
        np.minimum.at(smallest, hi, least)
        d = np.append(level.discount, 1.0)
        # The denominators of left_over: something is discounted if the smallest count is.
        below = total + (d[smallest] >= 1)
        backs = hi[s["backs"][hi]]
        _, free = left_over(total, [by(backs, x, n) for x in few], level.discount)
        weight = np.where(total > 0, free / np.maximum(1 - by(backs, low, n), 1e-300), 1.0)
        self.count, self.gram = np.zeros(len(self.tokens), np.int64), np.where(self.tokens == BEFORE, START, UNSEEN)
        self.count[s["rows"]], self.gram[s["rows"]] = counts[s["which"]], grams[s["which"]]
        c, of = self.count[s["known"]], s["of_history"]
        self.p = self.p.copy()
        self.p[s["known"]] = np.where(c > 0, d[np.minimum(c, CUT + 1)] * c / np.maximum(below[of], 1), weight[of] * self.p[s["known"]])


# ------------------------------------------------------------------- the buckets
STAGED = "kind string, chunk long, bucket long, payload binary, numbers array<bigint>"


def _staged(rows: list[tuple]) -> pa.Table:
    types = (pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
    columns = list(zip(*rows, strict=True)) or [()] * len(types)
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["kind", "chunk", "bucket", "payload", "numbers"])


def _numbers(counts: np.ndarray) -> list[int]:
    """How many counts are 1, 2, ... CUT + 1; how many there are; their sum."""
    return [*(int((counts == r).sum()) for r in range(1, CUT + 2)), len(counts), int(counts.sum())]


def count_words(rows: pa.Table, buckets: int) -> pa.Table:
    """A bucket of the vocabulary: ids and counts to each chunk."""
    bucket = rows.column("bucket")[0].as_py()
    asked, total = [], defaultdict(int)
    for chunk, blob in zip(rows.column("chunk").to_pylist(), rows.column("payload").to_pylist(), strict=True):
        places, counts, text = unpack(blob)
        words = text.tobytes().split(b" ")
        asked.append((chunk, places, words))
        for w, n in zip(words, counts.tolist(), strict=True):
            total[w] += n
    seen = sorted((-n, w) for w, n in total.items() if n)
    place = {w: k * buckets + bucket + 1 for k, (_, w) in enumerate(seen)}
    counts = np.array([-n for n, _ in seen], np.int64)
    out = [("table", None, bucket, pack(np.frombuffer(b" ".join(w for _, w in seen), np.uint8), counts), None),
           ("numbers", None, bucket, None, _numbers(counts))]
    for chunk, places, words in asked:
        ids = np.array([place.get(w, UNSEEN) for w in words], np.int64)
        out.append(("answer", chunk, bucket, pack(places, ids, np.array([total[w] for w in words], np.int64)), None))
    return _staged(out)


def pack_ask(h: np.ndarray, g: np.ndarray, counts: np.ndarray, lower: np.ndarray, histories: np.ndarray, backs: np.ndarray) -> bytes:
    """n-grams in order of (h, g); a suffix and its probability are written once, and histories only where no n-gram names them."""
    suffixes, first, of = np.unique(g, return_index=True, return_inverse=True)
    values, at = np.unique(lower[first], return_inverse=True)
    bare = np.setdiff1d(histories, h, assume_unique=False)
    return pack(steps(h), of.astype(np.int64), counts, steps(suffixes), values, at.astype(np.int64), steps(bare), backs.astype(np.int64))


def unpack_ask(blob: bytes) -> tuple[np.ndarray, ...]:
    """(h, g, counts, lower probabilities, histories, whether each is backed off from)."""
    h, of, counts, suffixes, values, at, bare, backs = unpack(blob)
    h = unsteps(h)
    return h, unsteps(suffixes)[of], counts, values[at][of], np.union1d(h, unsteps(bare)), backs.astype(bool)


def count_ngrams(rows: pa.Table, buckets: int, named: bool) -> pa.Table:
    """A bucket of a table of n-grams: counts (and ids if ``named``) and the histories' sums to each chunk."""
    bucket = rows.column("bucket")[0].as_py()
    chunks, asks = rows.column("chunk").to_pylist(), [unpack_ask(b) for b in rows.column("payload").to_pylist()]
    h, g, asked, lower = (np.concatenate([a[i] for a in asks]) for i in range(4))
    first, which = pairs(h, g)
    counts = by(which, asked, len(first)).astype(np.int64)
    seen = np.flatnonzero(counts)
    ids = np.zeros(len(first), np.int64)
    ids[seen[np.argsort(-counts[seen], kind="stable")]] = np.arange(len(seen)) * buckets + bucket + 1
    histories, of = np.unique(h[first[seen]], return_inverse=True)
    n, own = len(histories), counts[seen]
    least = np.full(n + 1, CUT + 1)
    np.minimum.at(least, of, own)
    few = [np.append(by(of, own == r, n), 0).astype(np.int64) for r in range(1, CUT + 1)]
    low = np.append(by(of, lower[first[seen]], n), 0.0)
    table = [steps(h[first[seen]]), steps(g[first[seen]]), own, *([ids[seen]] if named else [])]
    out = [("table", None, bucket, pack(*table), None), ("numbers", None, bucket, None, _numbers(own))]
    start = 0
    for chunk, (ask_h, _, _, _, wanted, backs) in zip(chunks, asks, strict=True):
        mine = which[start:start + len(ask_h)]
        start += len(ask_h)
        at = np.searchsorted(histories, wanted)
        at = np.where(np.append(histories, START - 1)[at] == wanted, at, n)  # entry n: no such history
        gram = ids[mine] if named else np.zeros(0, np.int64)
        out.append(("answer", chunk, bucket, pack(counts[mine], gram, least[at], *[x[at[backs]] for x in (*few, low)]), None))
    return _staged(out)


def _counting(k: int, buckets: int, named: bool) -> Callable[[pa.Table], pa.Table]:
    def count(rows: pa.Table) -> pa.Table:
        return count_words(rows, buckets) if k == 1 else count_ngrams(rows, buckets, named)

    return count


# -------------------------------------------------------------------- the chunks
def blocks(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, A-Z lower-cased, a block of it at a time."""
    spaces, start = ASCII_SPACE.encode(), 0
    while start < len(text):
        end = start + BLOCK
        while end < len(text) and text[end] not in spaces:
            end += 1
        yield text[start:end].lower().split()
        start = end


def of_pieces(text: bytes) -> Iterator[list[bytes]]:
    """The tokens of a text, the end token last, at most ``PIECE`` at a time."""
    waiting: list[bytes] = []
    for words in blocks(text):
        waiting += words
        while len(waiting) >= PIECE:
            yield waiting[:PIECE]
            del waiting[:PIECE]
    yield [*waiting, END_WORD]


def _chunks(docs: DataFrame, id_col: str, text_col: str, train: Column, order: int) -> DataFrame:
    """A row per chunk: its pieces (row, id, train, size), its words and its tokens."""
    source = docs.select(F.col(id_col).alias("id"), F.coalesce(train, F.lit(True)).alias("train"),
                         text_or_empty(text_col).cast("string").cast("binary").alias("text"))
    context = order - 1

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, row = TaskContext.get().partitionId() << 33, 0, 0
        local: defaultdict[bytes, int] = defaultdict()
        local.default_factory = lambda: len(local) + 1
        tokens: list[int] = []
        pieces: list[tuple] = []  # row, id, train, scored tokens

        def begin() -> None:
            for held in (local, tokens, pieces):
                held.clear()
            _ = local[END_WORD]  # END

        def chunk(id_type: pa.DataType) -> pa.RecordBatch:
            rows, ids, train, sizes = zip(*pieces, strict=True)
            # Words in order of frequency (the end token first): their ids pack best.
            coded, words = np.array(tokens, "<i4"), list(local)
            order = np.argsort(-np.bincount(coded, minlength=len(words) + 1)[2:], kind="stable")
            rank = np.arange(len(words) + 1, dtype="<i4")
            rank[order + 2] = np.arange(len(order), dtype="<i4") + 2
            words = [END_WORD, *[words[i + 1] for i in order]]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(rows)], pa.int32()), pa.array(x, t)) for x, t in (
                (ids, id_type), (rows, pa.int64()), (train, pa.bool_()), (sizes, pa.int64()))]
            one = [pa.array([x], pa.int64()) for x in (base + made, len(local), sum(sizes))]
            blobs = [pa.array([pack(x)], pa.binary()) for x in (np.frombuffer(b" ".join(words), np.uint8), rank[coded])]
            return pa.RecordBatch.from_arrays([*one, *lists, *blobs], [
                "chunk", "n_words", "n_tokens", "ids", "rows", "train", "sizes", "words", "tokens"])

        begin()
        for batch in batches:
            for name, known, text in zip(*(batch.column(c).to_pylist() for c in ("id", "train", "text")), strict=True):
                last: list[bytes | None] = [None] * context
                for words in of_pieces(text):
                    tokens += [BEFORE if w is None else local[w] for w in last]
                    tokens += map(local.__getitem__, words)
                    pieces.append((base + row, name, known, len(words)))
                    last = [*last, *words][len(words):] if len(words) < context else words[len(words) - context:]
                    if len(tokens) >= CHUNK:
                        yield chunk(batch.schema.field("id").type)
                        made += 1
                        begin()
                row += 1
            id_type = batch.schema.field("id").type
        if pieces:
            yield chunk(id_type)

    name_type = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(cut, f"chunk long, n_words long, n_tokens long, ids array<{name_type}>, rows array<bigint>, "
                                  "train array<boolean>, sizes array<bigint>, words binary, tokens binary")


@dataclass(frozen=True)
class _Plan:
    """What every task needs to evaluate chunks up to the levels known so far."""

    order: int
    train_docs: int
    levels: tuple

    def chunk(self, rows: pa.Table) -> Chunk:
        tokens, = unpack(rows.column("tokens")[0].as_py())
        sizes, train = (np.array(rows.column(c)[0].values.to_numpy(zero_copy_only=False)) for c in ("sizes", "train"))
        return Chunk(self.order, tokens.astype(np.int64), sizes, train.astype(bool), self.train_docs)

    def evaluated(self, rows: pa.Table, answers: pa.Table) -> Chunk:
        chunk = self.chunk(rows)
        by_level: dict[int, list] = defaultdict(list)
        for level, bucket, blob in zip(*(answers.column(c).to_pylist() for c in ("level", "bucket", "payload")), strict=True):
            by_level[level].append((bucket, blob))
        for k, level in enumerate(self.levels, 1):
            given = [unpack(blob) for _, blob in sorted(by_level[k], key=lambda x: x[0])]
            if k == 1:
                chunk.words(level, given)
            else:
                chunk.ask(k, level.buckets)
                if k == self.order:  # ids of the longest n-grams are never asked for
                    given = [[a[0], np.zeros(len(a[0]), np.int64), *a[2:]] for a in given]
                chunk.evaluate(k, level, given)
        return chunk


ASKED = "chunk long, bucket long, payload binary"


def _asked(rows: list[tuple]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) or [()] * 3
    return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)],
                    names=["chunk", "bucket", "payload"])


def _ask_words(chunks: DataFrame, plan: _Plan, buckets: int) -> DataFrame:
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = pa.Table.from_batches([batch.slice(k, 1)])
                chunk = plan.chunk(rows)
                words = unpack(rows.column("words")[0].as_py())[0].tobytes().split(b" ")
                counts = np.bincount(chunk.tokens[chunk.learned], minlength=len(words) + 1)[1:]
                where = np.array([zlib.crc32(w) for w in words], np.int64) % buckets
                order = np.argsort(where, kind="stable")
                out = []
                for b, own in zip(np.unique(where), np.split(order, np.flatnonzero(np.diff(where[order])) + 1), strict=True):
                    text = np.frombuffer(b" ".join([words[i] for i in own]), np.uint8)
                    out.append((rows.column("chunk")[0].as_py(), int(b), pack(steps(own), counts[own], text)))
                yield from _asked(out).combine_chunks().to_batches()

    return chunks.select("chunk", "sizes", "train", "words", "tokens").mapInArrow(ask, ASKED)


def _ask_ngrams(chunks: DataFrame, answers: DataFrame, plan: _Plan, k: int, buckets: int) -> DataFrame:
    def ask(rows: pa.Table, given: pa.Table) -> pa.Table:
        chunk, number = plan.evaluated(rows, given), rows.column("chunk")[0].as_py()
        return _asked([(number, b, pack_ask(*what)) for b, what in chunk.ask(k, buckets).items()])

    return _beside(chunks.select("chunk", "sizes", "train", "tokens"), answers).applyInArrow(ask, ASKED)


def _beside(chunks: DataFrame, answers: DataFrame):
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk"))


def _level(found: DataFrame, buckets: int) -> Level:
    each = found.where("kind = 'numbers'").select(F.posexplode("numbers").alias("at", "n"))
    numbers = [0] * (CUT + 3)
    for r in each.groupBy("at").agg(F.sum("n").alias("n")).collect():
        numbers[r["at"]] = r["n"]
    *few, ngrams, total = numbers
    return Level(buckets, tuple(few), ngrams, total)


def score(docs: DataFrame, train: Column, order: int = 2, id_col: str = "doc_id", text_col: str = "text"
          ) -> tuple[DataFrame, list[DataFrame]]:
    """(scores, tables): a row per row of ``docs`` (id, held_out, n_tokens, n_known, train_tokens, base_score, score),
    and the model's tables, level by level, as packed rows of their buckets (see :func:`ngrams`).

    Tokens are words between ASCII white space, A-Z lower-cased, and one end
    token a text.  ``train`` says which rows are learned from (null: yes);
    held_out rows are the others.  score is the model's log10 probability of
    the text, base_score that of single tokens with one added to each count.

    Null texts are empty (the end token alone); repeated rows are texts of
    their own and count again; ids of any value, null too, pass through; an
    empty table gives no rows; with no training row all tokens are unknown,
    and both scores are 0.  Texts of any length are taken whole.  Other
    columns are ignored, whatever their names.
    """
    if order < 1:
        raise ValueError("order must be 1 or more")
    chunks = stage(_chunks(docs, id_col, text_col, train, order), "katz-chunks")
    # Bounds of the tables' sizes: a chunk's distinct words, and all tokens.
    sizes = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("tokens"), F.coalesce(F.sum("n_words"), F.lit(0)).alias("words")).first()
    learned = F.coalesce(train, F.lit(True))
    plan = _Plan(order, docs.where(learned).count(), ())
    tables, answers = [], None
    for k in range(1, order + 1):
        buckets = 1 + (sizes["words"] // WORDS if k == 1 else sizes["tokens"] // BUCKET)
        asked = _ask_words(chunks, plan, buckets) if k == 1 else _ask_ngrams(chunks, answers, plan, k, buckets)
        found = stage(asked.groupBy("bucket").applyInArrow(_counting(k, buckets, named=k < order), STAGED), f"katz-{k}")
        plan = _Plan(order, plan.train_docs, (*plan.levels, _level(found, buckets)))
        tables.append(found.where("kind = 'table'").select("bucket", "payload"))
        given = found.where("kind = 'answer'").select("chunk", F.lit(k).alias("level"), "bucket", "payload")
        answers = given if answers is None else answers.unionByName(given)
    id_type = chunks.schema["ids"].dataType.elementType.simpleString()
    base = plan.levels[0]

    def evaluate(rows: pa.Table, given: pa.Table) -> pa.Table:
        chunk = plan.evaluated(rows, given)
        of = chunk.piece[chunk.scored]
        n = len(chunk.sizes)

        def by_piece(x: np.ndarray) -> np.ndarray:
            return np.bincount(of, weights=x[chunk.scored], minlength=n)

        plain = np.log10((chunk.count1 + 1) / (base.total + base.ngrams + 1))
        known = by_piece(chunk.count1 > 0).astype(np.int64)
        return pa.table([rows.column("rows")[0].values, rows.column("ids")[0].values, pa.array(~chunk.train),
                         pa.array(chunk.sizes), pa.array(known), pa.array(by_piece(plain)), pa.array(by_piece(np.log10(chunk.p)))],
                        names=["row", "id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    pieces = _beside(chunks.select("chunk", "ids", "rows", "sizes", "train", "tokens"), answers).applyInArrow(
        evaluate, f"row long, id {id_type}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    summed = pieces.groupBy("row").agg(F.first("id").alias("id"), F.first("held_out").alias("held_out"),
                                       *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")])
    return summed.select(F.col("id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(base.total).cast("long").alias("train_tokens"),
                         "base_score", "score"), tables


def ngrams(tables: list[DataFrame], level: int) -> DataFrame:
    """The training n-grams of a level as rows: (id, word, n) of level 1, else (history, suffix, n).

    History and suffix are ids of n-grams of the level below (of single tokens at level 2); the history before a
    text is -1.  The end token's word is a line feed.
    """
    buckets = tables[level - 1].agg(F.coalesce(F.max("bucket"), F.lit(0))).first()[0] + 1 if level == 1 else 0

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, blob in zip(batch.column("bucket").to_pylist(), batch.column("payload").to_pylist(), strict=True):
                arrays = unpack(blob)
                if level == 1:
                    words = arrays[0].tobytes().split(b" ") if len(arrays[1]) else []
                    ids = np.arange(len(words)) * buckets + bucket + 1
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([w.decode() for w in words], pa.string()),
                                                      pa.array(arrays[1], pa.int64())], ["id", "word", "n"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(unsteps(arrays[0])), pa.array(unsteps(arrays[1])), pa.array(arrays[2])],
                                                     ["history", "suffix", "n"])

    return tables[level - 1].mapInArrow(rows, "id long, word string, n long" if level == 1 else "history long, suffix long, n long")
