"""Near-duplicate documents by SimHash fingerprints, compared exactly in tiles.

Fingerprints are made once per document and reduced to the distinct ones
before any comparison.  Two 64-bit fingerprints at most ``d`` bits apart agree
in at least one of ``d + 1`` blocks of bits, so each fingerprint is dealt to
one group per block value; within a group all fingerprints are compared, in
tiles sorted by population count: numpy exclusive-or and bit counts over a
whole pair of tiles, and no comparison where the tiles' population counts
differ beyond the radius.  A group larger than a tile set is cut into slices,
and each pair of slices is a task's work of its own.  A tile pair gives at
most one link per fingerprint (to the smallest of its local component), never
all pairs, and components are joined from those links.

Shuffles: ``d + 1`` rows of 16 bytes per distinct fingerprint (times the number
of slices for a hot group), links, and a row per document for the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions
from .common import beside_text, stage
from .components import components

#: Fingerprints of one slice of a group, and of one tile of the comparison.
SLICE, TILE = 4096, 1024


def text_fingerprint(text: str, shingle_words: int, seed: int = 42) -> int:
    """Majority bits of the XXH64 hashes of a text's word shingles, as an unsigned integer.

    A-Z are lower-cased; words are runs without ASCII white space; a text of
    fewer words is one shingle, a text without words has fingerprint zero.
    """
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()  # bytes: only ASCII letters and white space
    if not words:
        return 0
    n = max(1, len(words) - shingle_words + 1)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 1
    ends = np.cumsum(sizes) - 1
    begins = (ends - sizes + 1)[:n].tolist()
    ends = ends[-n:].tolist()
    hashes = np.fromiter((xxh64_intdigest(joined[a:b], seed) for a, b in zip(begins, ends)), np.uint64, n)
    ones = np.zeros(64, dtype=np.int64)
    for part in np.array_split(hashes, -(-n // 65536)):
        ones += np.unpackbits(part.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: tuple[str, ...], text_col: str, shingle_words: int) -> DataFrame:
    """The ``keep`` columns and ``fp``, the fingerprint's 64 bits as a signed long, of every row."""
    def make(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in texts:
            found = [text_fingerprint(t.as_py() or "", shingle_words) for t in column]
            yield pa.array(np.array(found, dtype=np.uint64).view(np.int64))

    return beside_text(docs, text_col, keep, "_fp", "long", make)


def local_roots(left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray:
    """Smallest reachable node of each of ``size`` nodes over the links left[i] - right[i]."""
    root = np.arange(size)
    while len(left):
        a, b = root[left], root[right]
        if (a == b).all():
            break
        low = np.minimum(a, b)
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
    return root


def tile_links(first: np.ndarray, second: np.ndarray | None, radius: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Links within one set of distinct fingerprints, or between two: (fingerprint, smaller one of its
    component) and the number of fingerprint pairs compared."""
    sets, compared = [first] if second is None else [first, second], 0
    order = [s[np.argsort(np.bitwise_count(s), kind="stable")] for s in sets]
    nodes = np.concatenate(order)
    counts = np.bitwise_count(nodes).astype(np.int64)
    shift = 0 if second is None else len(first)
    left, right = [], []
    for i in range(0, len(first), TILE):
        a = slice(i, min(i + TILE, len(first)))
        for j in range(i if second is None else shift, len(nodes), TILE):
            b = slice(j, min(j + TILE, len(nodes)))
            if counts[b.start] - counts[a.stop - 1] > radius:
                break  # sorted: all later tiles are further away
            if counts[a.start] - counts[b.stop - 1] > radius:
                continue
            near = np.bitwise_count(nodes[a, None] ^ nodes[None, b]) <= radius
            compared += near.size
            x, y = np.nonzero(near)
            keep = x + a.start != y + b.start
            x, y = x[keep] + a.start, y[keep] + b.start
            if len(x):  # a dense tile pair shrinks to its components at once
                used, back = np.unique(np.concatenate((x, y)), return_inverse=True)
                root = used[local_roots(back[:len(x)], back[len(x):], len(used))]
                off = root != used
                left.append(used[off])
                right.append(root[off])
    if not left:
        return nodes[:0], nodes[:0], compared
    root = local_roots(np.concatenate(left), np.concatenate(right), len(nodes))
    off = root != np.arange(len(nodes))
    return nodes[off], nodes[root[off]], compared


def links(distinct: DataFrame, radius: int) -> DataFrame:
    """(u, v): links that connect exactly the components of all pairs at most ``radius`` bits apart."""
    spark = distinct.sparkSession
    blocks = radius + 1
    edges = [64 * k // blocks for k in range(blocks + 1)]
    keys = F.array(*[F.shiftrightunsigned(F.shiftleft("fp", 64 - hi), 64 - hi + lo) * F.lit(blocks) + F.lit(k)
                     for k, (lo, hi) in enumerate(zip(edges, edges[1:]))])
    dealt = distinct.select("fp", F.explode(keys).alias("block"))
    # The groups above a slice: at most a row per block value (at most 2**17 for a radius of 3).
    hot = dealt.groupBy("block").count().where(F.col("count") > SLICE)
    slices = hot.select("block", F.ceil(F.col("count") / F.lit(SLICE)).cast("int").alias("slices"))
    if blocks * 2 ** (64 // blocks + 1) <= 1 << 20:
        slices = F.broadcast(slices)
    dealt = dealt.join(slices, "block", "left").withColumn("slices", F.coalesce("slices", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("slices")).cast("int")
    dealt = dealt.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    tasks = dealt.select("block", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "own", "fp")
    n = max(shuffle_partitions(spark), 1)
    tasks = tasks.repartition(n, "block", "a", "b").sortWithinPartitions("block", "a", "b", "own")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def groups() -> Iterator[tuple]:
            """(a, b, own, fp) of each whole (block, a, b); a group is at most two slices."""
            rest = None
            for batch in batches:
                cols = [batch.column(c).to_numpy() for c in ("block", "a", "b", "own", "fp")]
                if rest is not None:
                    cols = [np.concatenate(pair) for pair in zip(rest, cols)]
                new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)) + 1
                starts = [0, *new.tolist()]
                for s, e in zip(starts, starts[1:]):
                    if e - s > 1:
                        yield tuple(c[s:e] for c in cols[1:])
                rest = [c[starts[-1]:] for c in cols]
            if rest is not None and len(rest[0]) > 1:
                yield tuple(c for c in rest[1:])

        us, vs, held = [], [], 0
        for a, b, own, fp in groups():
            fp = fp.view(np.uint64)
            if a[0] == b[0]:
                u, v, _ = tile_links(fp, None, radius)
            else:
                u, v, _ = tile_links(fp[own == a[0]], fp[own == b[0]], radius)
            if len(u):
                us.append(u)
                vs.append(v)
                held += len(u)
            if held > 1 << 16:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], ["u", "v"])
                us, vs, held = [], [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (us, vs)], ["u", "v"])

    return tasks.mapInArrow(compare, "u long, v long").distinct()


def _components(prints: DataFrame, max_distance: int) -> DataFrame:
    """(fp, component): the smallest fingerprint that links reach, of each distinct fingerprint."""
    distinct = stage(prints.select("fp").distinct(), "distinct-fingerprints")
    roots = components(links(distinct, max_distance))
    return distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("component"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3, max_distance: int = 3) -> DataFrame:
    """(id, fp, component_id): a row per row of ``docs``.

    Documents whose fingerprints differ in at most ``max_distance`` bits are
    linked; component_id is the smallest id that links reach.  Null texts are
    empty and empty texts have fingerprint zero, linked like any other.  Null
    ids keep their row and take part in links, but a component's id is null
    only if all its ids are.  Repeated rows each keep their row.  Other columns
    are ignored; an empty table gives no rows.
    """
    prints = stage(fingerprints(docs, (id_col,), text_col, shingle_words).toDF("id", "fp"), "fingerprints")
    low = prints.groupBy("fp").agg(F.min("id").alias("low"))
    grouped = _components(prints, max_distance).join(low, "fp")
    smallest = grouped.groupBy("component").agg(F.min("low").alias("component_id"))
    by_print = grouped.join(smallest, "component").select("fp", "component_id")
    return prints.join(by_print, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 shingle_words: int = 3, max_distance: int = 3) -> DataFrame:
    """``docs`` with one row of each group of linked documents: the one with the smallest id (null ids
    last; of repeated ids any one).  All columns stay; nulls and empty texts as in ``near_duplicates``."""
    columns = tuple(docs.columns)
    inner = docs.toDF(*[f"c{i}" for i in range(len(columns))])
    text, key = (f"c{columns.index(c)}" for c in (text_col, id_col))
    marked = fingerprints(inner.withColumn("t", F.col(text)), tuple(inner.columns), "t", shingle_words)
    marked = stage(marked.withColumn("row", F.monotonically_increasing_id()).withColumnRenamed("_fp", "fp"), "marked")
    least = F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "row")).alias("least")
    by_print = marked.groupBy("fp").agg(least).join(_components(marked, max_distance), "fp")
    kept = by_print.groupBy("component").agg(F.min("least").alias("least")).select(F.col("least.row").alias("row"))
    return marked.join(kept, "row", "left_semi").select(*inner.columns).toDF(*columns)
