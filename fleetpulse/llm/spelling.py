"""Spelling variants: words one edit apart, grouped under their most frequent forms.

Letter counts decide which words may be one edit apart: a replaced letter
takes one from one count and adds one to another, an inserted or deleted
letter changes one count by one, so the L1 distance of the count vectors is
two or one at most.  Words of each length have a k-d tree over their vectors;
words of the same length and of the length below search it with boxes: a
branch is left out if its box needs more letters added or taken away than one
edit can.  Vectors at the right distance are candidates, whose words are then
compared letter by letter.

On Spark the top of each tree is a router: thresholds from a bounded sample
of words cut it into cells of about ``CELL`` words; every word lies in one
cell of its length and is sent as a query to each cell whose region its search
meets.  Cells that come out larger (many words with the same letters) are
dealt in parts, and their queries go to every part.  A task then holds one
part and its queries, builds the rest of the tree over it and sends on one row
per word: how many near words it found and the best of them.  A pair of words
is found in exactly one cell.  Nothing grows with all words in one task or the
driver (the router has a node per cell).
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage, text_or_empty

#: Words of a cell; cells above twice this are dealt in parts.
CELL = 16384
#: Sampled words per cell, and in all, that the routers are made from.
SAMPLED, MAX_SAMPLE = 64, 200_000
#: Vectors of a leaf; word pairs compared at once; distinct words counted in a task before they are sent on.
LEAF, SLICE, HELD = 96, 1 << 20, 400_000

#: Code points A-Z, a-z and U+00C0 to U+00FF as Latin-1 bytes, A-Z lower-cased; all else separates.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


# --------------------------------------------------------------------- counting
def lower_runs(text: str) -> list[bytes]:
    """Maximal runs ``[A-Za-z\\u00C0-\\u00FF]+`` with A-Z lower-cased, as Latin-1 bytes."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def misspelt(run: bytes, id_crc: int, every: int) -> bytes:
    """The run, without one letter where ``every`` divides the crc32 of ``<id>:<run>`` (``id_crc``: of ``<id>:``)."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), id_crc)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5,
                every: int = 97) -> DataFrame:
    """(word, n): the words of all texts and their occurrences."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[bytes, int] = {}

        def sent() -> pa.RecordBatch:
            words = pa.array([w.decode("latin-1") for w in total], pa.string())
            batch = pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                id_crc = zlib.crc32(f"{name}:".encode())
                for run, n in Counter(lower_runs(text)).items():
                    if len(run) >= min_length:
                        word = misspelt(run, id_crc, every)
                        if len(word) >= min_length:
                            total[word] = total.get(word, 0) + n
                if len(total) >= HELD:
                    yield sent()
        if total:
            yield sent()

    source = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")), text_or_empty(text_col).cast("string"))
    return source.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ------------------------------------------------------------------ k-d trees
def letters_of(words: list[str]) -> np.ndarray:
    """(words, length) letters as bytes; the words have one length."""
    return np.frombuffer("".join(words).encode("latin-1"), dtype=np.uint8).reshape(len(words), -1)


def count_vectors(letters: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """(words, alphabet) letter counts; the letters are in ``alphabet``."""
    place = np.zeros(256, dtype=np.int64)
    place[alphabet] = np.arange(len(alphabet))
    rows = np.arange(len(letters))[:, None] * len(alphabet)
    counts = np.bincount((rows + place[letters]).ravel(), minlength=len(letters) * len(alphabet))
    return counts.reshape(len(letters), -1).astype(np.int32)


def _split(points: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[int, int]:
    """(letter, threshold) that halve the points along the letter of widest spread."""
    spread = points.std(0) * (high > low)
    d = int(spread.argmax())
    return d, min(int(np.median(points[:, d])), int(high[d]) - 1)


def near_vectors(data: np.ndarray, queries: np.ndarray, longer: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (query, data) of vectors one edit apart; ``longer`` is 1 if data words have one letter more, else 0.

    A k-d tree over ``data`` is built and searched by all queries at once, branch by branch.
    """
    squared = 2 - longer  # one count up and one down, or one count up
    exact = np.float32 if max(int(x.max(initial=0)) for x in (data, queries)) < 256 else np.float64
    stack = [(np.arange(len(data)), np.arange(len(queries)))]
    while stack:
        inside, asking = stack.pop()
        points, q = data[inside], queries[asking]
        low, high = points.min(0), points.max(0)
        added = np.maximum(low - q, 0).sum(1)
        taken = np.maximum(q - high, 0).sum(1)
        reach = (added <= 1) & (taken <= 1 - longer)
        if not reach.any():
            continue
        asking, q = asking[reach], q[reach]
        if len(inside) <= LEAF or not (high > low).any():
            a, b = q.astype(exact), points.astype(exact)
            away = (a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T)
            row, col = np.nonzero(away == squared)
            if len(row):
                yield asking[row], inside[col]
            continue
        d, at = _split(points, low, high)
        left = points[:, d] <= at
        stack += [(inside[left], asking), (inside[~left], asking)]


def one_edit(short: np.ndarray, long: np.ndarray) -> np.ndarray:
    """Of each pair of rows, whether they differ by one replaced letter, or by one inserted if ``long`` is wider."""
    if short.shape[1] == long.shape[1]:
        return (short != long).sum(1) == 1
    head = np.logical_and.accumulate(short == long[:, :-1], axis=1).sum(1)
    tail = np.logical_and.accumulate((short == long[:, 1:])[:, ::-1], axis=1).sum(1)
    return head + tail >= short.shape[1]


class _Found:
    """Near words counted per word, and the first of them in order of preference."""

    def __init__(self, words: list[str]) -> None:
        self.words, self.near = words, np.zeros(len(words), dtype=np.int64)
        self.best = np.full(len(words), np.iinfo(np.int64).max)

    def add(self, which: np.ndarray, rank: np.ndarray) -> None:
        np.add.at(self.near, which, 1)
        np.minimum.at(self.best, which, rank)

    def rows(self, ranked: list[tuple[int, str]]) -> list[tuple[str, int, int, str]]:
        return [(self.words[k], int(self.near[k]), -ranked[self.best[k]][0], ranked[self.best[k]][1])
                for k in np.flatnonzero(self.near)]


def near_in_cell(data: list[tuple[str, int]], queries: list[tuple[str, int]]) -> list[tuple[str, int, int, str]]:
    """(word, near words, n of the best, the best) of ``queries`` among ``data`` (word, n), of one length each.

    With data words one letter longer, the rows of data among queries too.
    """
    if not data or not queries:
        return []
    ranked = sorted({(-n, w) for w, n in data} | {(-n, w) for w, n in queries})
    place = {w: k for k, (_, w) in enumerate(ranked)}
    d_words, q_words = [w for w, _ in data], [w for w, _ in queries]
    d_rank, q_rank = (np.array([place[w] for w in ws]) for ws in (d_words, q_words))
    d_letters, q_letters = letters_of(d_words), letters_of(q_words)
    longer = d_letters.shape[1] - q_letters.shape[1]
    alphabet = np.union1d(d_letters, q_letters)
    d_vectors, d_at = np.unique(count_vectors(d_letters, alphabet), axis=0, return_inverse=True)
    q_vectors, q_at = np.unique(count_vectors(q_letters, alphabet), axis=0, return_inverse=True)
    # Words by vector: the words of vector v are order[first[v]:first[v + 1]].
    d_order, q_order = np.argsort(d_at.ravel(), kind="stable"), np.argsort(q_at.ravel(), kind="stable")
    d_first = np.concatenate([[0], np.cumsum(np.bincount(d_at.ravel(), minlength=len(d_vectors)))])
    q_first = np.concatenate([[0], np.cumsum(np.bincount(q_at.ravel(), minlength=len(q_vectors)))])
    of_query, of_data = _Found(q_words), _Found(d_words)

    def compare(qv: np.ndarray, dv: np.ndarray) -> None:
        """All word pairs of the vector pairs, in slices."""
        d_size, q_size = d_first[dv + 1] - d_first[dv], q_first[qv + 1] - q_first[qv]
        ends = np.cumsum(d_size * q_size)
        for start in range(0, int(ends[-1]), SLICE):
            k = np.arange(start, min(start + SLICE, int(ends[-1])))
            pair = np.searchsorted(ends, k, side="right")
            within = k - (ends[pair] - (d_size * q_size)[pair])
            q = q_order[q_first[qv[pair]] + within // d_size[pair]]
            d = d_order[d_first[dv[pair]] + within % d_size[pair]]
            same = one_edit(q_letters[q], d_letters[d])
            q, d = q[same], d[same]
            of_query.add(q, d_rank[d])
            if longer:
                of_data.add(d, q_rank[q])

    waiting, size = [], 0
    for qv, dv in near_vectors(d_vectors, q_vectors, longer):
        waiting.append((qv, dv))
        size += len(qv)
        if size >= SLICE // 8:
            compare(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
            waiting, size = [], 0
    if waiting:
        compare(*(np.concatenate(x) for x in zip(*waiting, strict=True)))
    return of_query.rows(ranked) + of_data.rows(ranked)


# -------------------------------------------------------------------- routers
class Router:
    """The top of one length's tree: inner nodes (letter, threshold, children) and leaves numbered as cells."""

    def __init__(self, sample: list[str], words: int, cell: int) -> None:
        self.alphabet = np.arange(256, dtype=np.uint8)
        points = count_vectors(letters_of(sample), self.alphabet) if sample else np.zeros((0, 256), np.int32)
        self.nodes: list[tuple[int, int, int, int]] = []  # letter (-1: a leaf), threshold, left, right (a leaf's cell)
        self.cells = 0
        scale = words / max(1, len(points))
        todo = [(np.arange(len(points)), None)]
        while todo:
            inside, parent = todo.pop()
            if parent is not None:
                node, side = parent
                old = list(self.nodes[node])
                old[2 + side] = len(self.nodes)
                self.nodes[node] = tuple(old)
            own = points[inside]
            low, high = (own.min(0), own.max(0)) if len(own) else (np.zeros(256), np.zeros(256))
            if len(own) * scale <= cell or len(own) < 4 or not (high > low).any():
                self.nodes.append((-1, 0, 0, self.cells))
                self.cells += 1
                continue
            d, at = _split(own, low, high)
            self.nodes.append((d, at, 0, 0))
            left = own[:, d] <= at
            todo += [(inside[left], (len(self.nodes) - 1, 0)), (inside[~left], (len(self.nodes) - 1, 1))]

    def homes(self, vectors: np.ndarray) -> np.ndarray:
        """The cell that each vector lies in."""
        cells = np.zeros(len(vectors), dtype=np.int64)
        stack = [(0, np.arange(len(vectors)))]
        while stack:
            node, which = stack.pop()
            d, at, left, right = self.nodes[node]
            if d < 0:
                cells[which] = right
            else:
                low = vectors[which, d] <= at
                stack += [(left, which[low]), (right, which[~low])]
        return cells

    def met(self, vectors: np.ndarray, longer: int) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, vectors) whose search for words of this length meets the cell's region."""
        n = len(vectors)
        # Letters that must be added or taken away, by letter, to get into the region so far.
        stack = [(0, np.arange(n), np.zeros((n, 0), np.int32), [])]
        while stack:
            node, which, needs, letters = stack.pop()
            d, at, left, right = self.nodes[node]
            if d < 0:
                yield right, which
                continue
            for child, need in ((left, np.minimum(at - vectors[which, d], 0)), (right, np.maximum(at + 1 - vectors[which, d], 0))):
                # Per letter the larger need counts, whatever its sign: a region never needs both of one letter.
                if d in letters:
                    k = letters.index(d)
                    now = needs.copy()
                    now[:, k] = np.where(np.abs(need) > np.abs(now[:, k]), need, now[:, k])
                    names = letters
                else:
                    now, names = np.column_stack([needs, need]), [*letters, d]
                reach = (np.maximum(now, 0).sum(1) <= 1) & (np.maximum(-now, 0).sum(1) <= 1 - longer)
                if reach.any():
                    stack.append((child, which[reach], now[reach], names))


def _routers(words: DataFrame) -> dict[int, Router]:
    """Of each length with more than ``CELL`` words."""
    sizes = {r["length"]: r["count"] for r in words.groupBy("length").count().where(F.col("count") > CELL).collect()}
    if not sizes:
        return {}
    share = min(SAMPLED / CELL, MAX_SAMPLE / sum(sizes.values()))
    limit = int(share * (1 << 31))
    drawn = words.where(F.col("length").isin(*sizes) & (F.pmod(F.xxhash64("word"), F.lit(1 << 31)) < limit))
    sample: dict[int, list[str]] = {length: [] for length in sizes}
    for r in drawn.select("length", "word").collect():  # at most about MAX_SAMPLE words
        sample[r["length"]].append(r["word"])
    return {length: Router(sorted(sample[length]), size, CELL) for length, size in sizes.items()}


def _routed(words: DataFrame, routers: dict[int, Router]) -> DataFrame:
    """(length, cell, query, word, n): each word where it lies (query false) and where it searches (query true)."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = np.array(batch.column("word").to_pylist(), dtype=object)
            counts, lengths = batch.column("n").to_numpy(), batch.column("length").to_numpy()
            for own in np.unique(lengths):
                mine = np.flatnonzero(lengths == own)
                vectors = None
                places = []  # (length, cell, query, rows)
                for length in (own, own + 1):
                    router = routers.get(int(length))
                    if router is None:
                        if length == own:
                            places.append((length, 0, False, mine))
                        places.append((length, 0, True, mine))
                        continue
                    if vectors is None:
                        vectors = count_vectors(letters_of(list(names[mine])), router.alphabet)
                    if length == own:
                        homes = router.homes(vectors)
                        places += [(length, int(c), False, mine[homes == c]) for c in np.unique(homes)]
                    places += [(length, c, True, mine[rows]) for c, rows in router.met(vectors, int(length - own))]
                rows = np.concatenate([p[3] for p in places])
                size = [len(p[3]) for p in places]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([int(p[0]) for p in places], size), pa.int32()),
                     pa.array(np.repeat([p[1] for p in places], size), pa.int64()),
                     pa.array(np.repeat([p[2] for p in places], size), pa.bool_()),
                     pa.array(names[rows], pa.string()), pa.array(counts[rows], pa.int64())],
                    ["length", "cell", "query", "word", "n"])

    return words.select("word", "n", "length").mapInArrow(route, "length int, cell long, query boolean, word string, n long")


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best): of the words (word, n) that have one, the number of near words and the best.

    The best has the largest n, of equal ones it comes first in code-point order.
    """
    words = words.select("word", "n", F.length("word").alias("length"))
    routed = stage(_routed(words, _routers(words)), "spelling-cells")
    large = (routed.where(~F.col("query")).groupBy("length", "cell").count().where(F.col("count") > 2 * CELL)
             .select("length", "cell", F.ceil(F.col("count") / CELL).cast("int").alias("parts")))
    # At most a row per CELL words.
    dealt = routed.join(F.broadcast(large), ["length", "cell"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    part = F.when(F.col("query"), F.sequence(F.lit(0), F.col("parts") - 1)).otherwise(
        F.array(F.pmod(F.xxhash64("word"), F.col("parts")).cast("int")))
    dealt = dealt.withColumn("part", F.explode(part)).drop("parts")

    def search(rows: pa.Table) -> pa.Table:
        names, counts = np.array(rows.column("word").to_pylist(), dtype=object), rows.column("n").to_numpy()
        asks, length = rows.column("query").to_numpy(), rows.column("length")[0].as_py()
        size = np.array([len(w) for w in names])

        def chosen(mask: np.ndarray) -> list[tuple[str, int]]:
            return list(zip(names[mask], counts[mask].tolist(), strict=True))

        data = chosen(~asks)
        found = [r for k in (length, length - 1) for r in near_in_cell(data, chosen(asks & (size == k)))]
        columns = list(zip(*found, strict=True)) or [(), (), (), ()]
        types = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["word", "n_near", "best_n", "best"])

    found = dealt.groupBy("length", "cell", "part").applyInArrow(search, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("n"), F.col("best").alias("w"))).alias("b")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.n")).alias("best_n"), F.col("b.w").alias("best"))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) from (word, form): the last word that following forms reaches.

    Every round doubles the steps taken; chains are short, as counts at least double along them.
    """
    now = stage(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(now.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 5, min_count: int = 3,
             every: int = 97, ratio: int = 2) -> DataFrame:
    """(word, form, root, n, n_near, form_n): a row per distinct word of ``min_length`` letters and ``min_count``
    occurrences or more; see the module and :func:`word_counts`.

    ``form`` is the near word with the largest n (ties: first in code-point
    order) if that is ``ratio`` times the word's n or more, else null.  Null
    and empty texts have no words; a null id is the empty text; repeated rows
    count again; an empty table gives no rows; other columns are ignored.
    Texts and words of any length are taken whole.
    """
    if ratio < 2:
        raise ValueError("ratio must be 2 or more, or forms might lead in a circle")
    words = stage(word_counts(docs, id_col, text_col, min_length, every).where(F.col("n") >= min_count), "spelling-words")
    near = near_words(words)
    known = words.join(near, "word", "left")
    has_form = F.col("best_n") >= ratio * F.col("n")
    known = stage(known.select("word", F.when(has_form, F.col("best")).alias("form"), "n",
                               F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                               F.when(has_form, F.col("best_n")).alias("form_n")), "spelling-near")
    last = roots(known.where(F.col("form").isNotNull()))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
