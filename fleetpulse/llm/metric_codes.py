"""Compression of vectors to codes: exact k-means per part, over metric trees with cached sums.

Components become integers and vectors are cut into equal parts; each part has
a codebook of its own, refined by rounds of "assign to the nearest entry, move
entries to their parts' mean".  Vectors are taken in chunks; each chunk and
part gets a metric tree from the anchors hierarchy: anchors are placed one by
one at the point farthest from its anchor and take the points nearer to them
(middle), anchors are merged pairwise into larger balls up to one root, and
split into anchors of their own down to small leaves (out).  Every ball caches
the number and the sum of its points.

A pass walks each tree from its root with the list of entries that may be
nearest to some point of the ball; children inherit the list.  An entry leaves
it when another one is nearer even at the ball's near edge.  A ball with one
entry left is wholly owned: its cached sum and count are added without looking
at its points.  Points of undecided leaves are compared with the entries left
in exact integers, ties to the lower index.  The result is the same as that of
comparing every part with every entry.

Trees are built once and written to the checkpoint folder; a round reads them
and shuffles one row per task, part and entry.  The driver holds the codebooks
only (parts x entries x components of a part).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

#: Vectors of a chunk (one tree per part), fewer if they are very long.
CHUNK, CHUNK_COMPONENTS = 8192, 1 << 22
#: Balls of so many points aren't split.
LEAF = 16
#: So many balls or more are merged pairwise; fewer become children side by side.
MERGED = 16
#: Per-label sums of at most so many labels are broadcast (about 50 bytes each).
MAX_BROADCAST_LABELS = 500_000


# ------------------------------------------------------------------ metric trees
def node_type(width: int) -> np.dtype:
    """Of a ball: its part, its points (a range of the part's order), its children (a range of nodes), and what it caches."""
    return np.dtype([("part", "i4"), ("start", "i4"), ("end", "i4"), ("child", "i4"), ("children", "i4"),
                     ("radius", "f8"), ("centre", "f8", (width,)), ("sum", "i8", (width,))])


def _distance(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(((points - centre) ** 2).sum(-1))


def anchors(points: np.ndarray, count: int) -> np.ndarray:
    """The anchor of each point: up to ``count`` anchors, each begun at the point farthest from its anchor so far."""
    owner = np.zeros(len(points), dtype=np.int64)
    far = _distance(points, points[0])
    for new in range(1, count):
        pivot = int(far.argmax())
        if far[pivot] == 0:
            break
        # Points within half the distance of two anchors from their own can't be nearer to the new one; all distances
        # at once cost less here than finding those points.
        away = _distance(points, points[pivot])
        nearer = away < far
        owner[nearer], far[nearer] = new, away[nearer]
    return owner


class _Ball:
    __slots__ = ("members", "children", "centre", "radius", "sum", "n")

    def __init__(self, members, children, centre, radius, total, n):
        self.members, self.children, self.centre, self.radius, self.sum, self.n = members, children, centre, radius, total, n


def _around(points: np.ndarray, members: np.ndarray) -> _Ball:
    own = points[members]
    total = own.sum(0)
    centre = total / len(members)
    return _Ball(members, [], centre, float(_distance(own, centre).max()), total, len(members))


def _joined(a: _Ball, b: _Ball) -> _Ball:
    total, n = a.sum + b.sum, a.n + b.n
    centre = total / n
    radius = max(float(_distance(x.centre, centre)) + x.radius for x in (a, b))
    return _Ball(None, [a, b], centre, radius, total, n)


def _merged(balls: list[_Ball]) -> _Ball:
    """One ball over ``balls``, the pair with the smallest common ball first."""
    centres = np.array([b.centre for b in balls])
    radii = np.array([b.radius for b in balls])
    balls = list(balls)

    def cost(k: int) -> np.ndarray:
        # The least ball around two balls.
        return np.maximum((_distance(centres, centres[k]) + radii + radii[k]) / 2, np.maximum(radii, radii[k]))

    costs = np.array([cost(k) for k in range(len(balls))])
    np.fill_diagonal(costs, np.inf)
    for _ in range(len(balls) - 1):
        i, j = divmod(int(costs.argmin()), len(balls))
        balls[i] = _joined(balls[i], balls[j])
        centres[i], radii[i] = balls[i].centre, balls[i].radius
        gone = np.isinf(costs[i]) & (np.arange(len(balls)) != i)
        costs[i] = cost(i)
        costs[i, gone] = np.inf
        costs[i, [i, j]] = np.inf
        costs[:, i] = costs[i]
        costs[j, :] = costs[:, j] = np.inf
        last = balls[i]
    return last


def _grown(points: np.ndarray, members: np.ndarray) -> _Ball:
    ball = _around(points, members)
    if len(members) <= LEAF or ball.radius == 0:
        return ball
    owner = anchors(points[members], int(np.ceil(np.sqrt(len(members)))))
    order = np.argsort(owner, kind="stable")
    groups = np.split(members[order], np.flatnonzero(np.diff(owner[order])) + 1)
    if len(groups) == 1:
        return ball
    children = [_grown(points, g) for g in groups]
    if len(children) >= MERGED:
        return _merged(children)
    ball.members, ball.children = None, children
    return ball


def metric_tree(points: np.ndarray, part: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, order) of integer ``points`` (n, width): the root is node 0, a ball's points are order[start:end]."""
    root = _grown(points, np.arange(len(points)))
    nodes, order = [], []
    queue = [root]
    place = {id(root): 0}
    for ball in queue:  # breadth first: children of a ball are neighbours
        for child in ball.children:
            place[id(child)] = len(queue)
            queue.append(child)
    spans: dict[int, tuple[int, int]] = {}
    at, stack = 0, [(root, False)]
    while stack:
        ball, done = stack.pop()
        if not ball.children:
            order.append(ball.members)
            spans[id(ball)] = (at, at + ball.n)
            at += ball.n
        elif done:
            spans[id(ball)] = (spans[id(ball.children[0])][0], spans[id(ball.children[-1])][1])
        else:
            stack.append((ball, True))
            stack.extend((c, False) for c in reversed(ball.children))
    for ball in queue:
        start, end = spans[id(ball)]
        first = place[id(ball.children[0])] if ball.children else 0
        nodes.append((part, start, end, first, len(ball.children), ball.radius, ball.centre, ball.sum))
    return np.array(nodes, dtype=node_type(points.shape[1])), np.concatenate(order).astype(np.int32)


def assign(points: np.ndarray, nodes: np.ndarray, order: np.ndarray, book: np.ndarray
           ) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry of each point, sums per entry, points per entry, points that lay in wholly owned balls) of one tree."""
    entries = len(book)
    sums, counts = np.zeros((entries, points.shape[1]), dtype=np.int64), np.zeros(entries, dtype=np.int64)
    found = np.zeros(len(points), dtype=np.int64)
    # Beyond rounding: distances carry relative errors of about 1e-15.
    slack = 1e-9 * (1 + float(np.abs(nodes["centre"][0]).max()) + float(nodes["radius"][0]) + float(np.abs(book).max()))
    level, wanted, owned_points = np.zeros(1, dtype=np.int64), np.ones((1, entries), dtype=bool), 0
    open_leaves, open_lists = [], []
    while len(level):
        at = nodes[level]
        away = np.sqrt(((at["centre"][:, None, :] - book[None]) ** 2).sum(-1))
        away[~wanted] = np.inf
        edge = away.min(1) + 2 * at["radius"] + slack
        wanted = away <= edge[:, None]
        owned = wanted.sum(1) == 1
        for node, entry in zip(at[owned], wanted[owned].argmax(1), strict=True):
            sums[entry] += node["sum"]
            counts[entry] += node["end"] - node["start"]
            found[order[node["start"]:node["end"]]] = entry
            owned_points += int(node["end"] - node["start"])
        leaf = ~owned & (at["children"] == 0)
        open_leaves.append(level[leaf])
        open_lists.append(wanted[leaf])
        inner = ~owned & ~leaf
        n = at["children"][inner]
        first = np.repeat(at["child"][inner] - np.concatenate([[0], np.cumsum(n)[:-1]]) if len(n) else n, n)
        level, wanted = first + np.arange(n.sum()), np.repeat(wanted[inner], n, axis=0)
    leaves, lists = np.concatenate(open_leaves), np.concatenate(open_lists)
    if len(leaves):
        at = nodes[leaves]
        n = (at["end"] - at["start"]).astype(np.int64)
        inside = np.repeat(at["start"] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        members = order[inside]
        row, entry = np.nonzero(np.repeat(lists, n, axis=0))
        squared = ((points[members[row]] - book[entry]) ** 2).sum(1)
        best = np.minimum.reduceat(squared, np.flatnonzero(np.diff(row, prepend=-1)))
        least = np.flatnonzero(squared == best[row])
        first = least[np.diff(row[least], prepend=-1) > 0]  # of equal distances the lowest index
        found[members] = entry[first]
        np.add.at(sums, entry[first], points[members])
        counts += np.bincount(entry[first], minlength=entries)
    return found, sums, counts, owned_points


# ------------------------------------------------------------------ on Spark
def integers(components: np.ndarray) -> np.ndarray:
    """floor(256 x) of each component."""
    return np.floor(256.0 * components.astype(np.float64)).astype(np.int64)


def _check_size(points: np.ndarray, width: int) -> None:
    if len(points) and int(np.abs(points).max()) >= int(np.sqrt((1 << 62) / width) / 2):
        raise ValueError("a component is too large for exact squared distances in 64 bits")


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> DataFrame:
    """(id, label, v) of rows whose vector holds finite components only, of a length that ``parts`` divides."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"),
                          F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where(v.isNotNull() & F.coalesce(finite, F.lit(False)) & (F.size(v) > 0) & (F.size(v) % parts == 0))


def _trees(kept: DataFrame, parts: int, size: int) -> DataFrame:
    """A row per chunk: its ids and labels, its integer points and the trees of all parts."""
    rows_of_chunk, width = max(1, min(CHUNK, CHUNK_COMPONENTS // size)), size // parts
    types = {c: kept.schema[c].dataType.simpleString() for c in ("id", "label")}

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def chunk() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks()
            points = integers(rows.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)).reshape(-1, size)
            _check_size(points, width)
            grown = [metric_tree(points[:, p * width:(p + 1) * width], p) for p in range(parts)]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(points)], pa.int32()), rows.column(c).combine_chunks())
                     for c in ("id", "label")]
            blobs = [points.astype("<i4"), np.concatenate([n for n, _ in grown]), np.concatenate([o for _, o in grown])]
            return pa.RecordBatch.from_arrays([*lists, *[pa.array([b.tobytes()], pa.binary()) for b in blobs]],
                                              ["ids", "labels", "points", "nodes", "orders"])

        for batch in batches:
            while batch.num_rows:
                room = rows_of_chunk - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == rows_of_chunk:
                    yield chunk()
                    held.clear()
        if held:
            yield chunk()

    return kept.mapInArrow(build, f"ids array<{types['id']}>, labels array<{types['label']}>, points binary, nodes binary, orders binary")


def _unpacked(batch: pa.RecordBatch, k: int, parts: int, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(points, nodes, order) of each part of a chunk."""
    width = size // parts
    points = np.frombuffer(batch.column("points")[k].as_py(), dtype="<i4").astype(np.int64).reshape(-1, size)
    nodes = np.frombuffer(batch.column("nodes")[k].as_py(), dtype=node_type(width))
    orders = np.frombuffer(batch.column("orders")[k].as_py(), dtype=np.int32).reshape(parts, -1)
    for p in range(parts):
        yield points[:, p * width:(p + 1) * width], nodes[nodes["part"] == p], orders[p]


def _moved(trees: DataFrame, books: np.ndarray, size: int) -> np.ndarray:
    """The codebooks after one round."""
    parts, entries, width = books.shape
    sums = [f"s{i}" for i in range(width)]

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, counts = np.zeros(books.shape, dtype=np.int64), np.zeros((parts, entries), dtype=np.int64)
        for batch in batches:
            for k in range(batch.num_rows):
                for p, (points, nodes, order) in enumerate(_unpacked(batch, k, parts, size)):
                    _, total, count, _ = assign(points, nodes, order, books[p])
                    totals[p] += total
                    counts[p] += count
        p, e = np.nonzero(counts)
        if len(p):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (p, e, counts[p, e], *totals[p, e].T)],
                                             ["part", "entry", "n", *sums])

    fields = ", ".join(f"{c} bigint" for c in ("part", "entry", "n", *sums))
    found = trees.select("points", "nodes", "orders").mapInArrow(gather, fields)
    added = found.groupBy("part", "entry").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("n", *sums)])
    books = books.copy()
    for row in added.collect():  # at most parts x entries rows
        books[row["part"], row["entry"]] = [int(row[c]) // int(row["n"]) for c in sums]
    return books


def _codes(trees: DataFrame, books: np.ndarray, size: int) -> DataFrame:
    """(id, label, code, error) of every vector."""
    parts = len(books)
    types = {c: trees.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels")}
    digits = np.array([f"{e:02x}" for e in range(books.shape[1])])

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                text, error = None, 0
                for p, (points, nodes, order) in enumerate(_unpacked(batch, k, parts, size)):
                    entry, *_ = assign(points, nodes, order, books[p])
                    error = error + ((points - books[p][entry]) ** 2).sum(1)
                    text = digits[entry] if text is None else np.char.add(text, digits[entry])
                ids, labels = (batch.column(c).slice(k, 1).flatten() for c in ("ids", "labels"))
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text.tolist(), pa.string()), pa.array(error, pa.int64())],
                                                 ["id", "label", "code", "error"])

    return trees.mapInArrow(code, f"id {types['ids']}, label {types['labels']}, code string, error bigint")


def codebook_digest(books: np.ndarray) -> str:
    """sha256 of all entries' components by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def codebooks(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
              vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame | None, np.ndarray]:
    """(trees of the kept vectors, codebooks (parts, entries, components)); no trees if no vector is kept.

    A codebook starts as its part of the vectors with the ``entries`` smallest ids (fewer vectors, fewer entries).
    """
    if entries > 256:
        raise ValueError("a code has two hex digits: at most 256 entries")
    kept = usable(vectors, id_col, vector_col, label_col, parts)
    first = kept.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()
    if not first:
        return None, np.zeros((parts, 0, 0), dtype=np.int64)
    size = len(first[0]["v"])
    if any(len(r["v"]) != size for r in first):
        kept_size = kept.where(F.size("v") == size)
        first = kept_size.orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()
    start = integers(np.array([r["v"] for r in first]))
    _check_size(start, size // parts)
    books = start.reshape(len(start), parts, size // parts).transpose(1, 0, 2).copy()
    trees = stage(_trees(kept.where(F.size("v") == size), parts, size), "metric-trees")
    for _ in range(rounds):
        books = _moved(trees, books, size)
    return trees, books


def compress(vectors: DataFrame, parts: int = 16, entries: int = 64, rounds: int = 2, id_col: str = "vec_id",
             vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256): a row per kept vector.

    A vector is kept if it isn't null, holds finite components only, is not
    empty, and has the length of the kept vector with the smallest id, which
    ``parts`` must divide.  Repeated rows are vectors of their own.  Null ids
    come last in order and pass through; null labels are one label.  Equal
    vectors get equal codes; of equally near entries the lower index is taken.
    No kept vector gives no rows.  Other columns are ignored, whatever their
    names.  Components beyond about 2^21 in size are refused with an error:
    their squared distances don't fit a long.
    """
    trees, books = codebooks(vectors, parts, entries, rounds, id_col, vector_col, label_col)
    if trees is None:
        empty = vectors.select(F.col(id_col), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                               F.lit(0).cast("long").alias("label_error"), F.lit(codebook_digest(books)).alias("codebooks_sha256"))
        return empty.where(F.lit(False))
    coded = stage(_codes(trees, books, books.shape[0] * books.shape[2]), "codes")
    # Written first, so that the join's other side is a plain exchange that adaptive execution can split.
    sums = stage(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "label-errors").withColumnRenamed("label", "_label")
    if sums.count() <= MAX_BROADCAST_LABELS:
        sums = F.broadcast(sums)
    joined = coded.join(sums, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error",
                         F.lit(codebook_digest(books)).alias("codebooks_sha256"))
