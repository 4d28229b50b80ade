"""Token ids on disk: frequency-ranked ids in byte-aligned variable-length coding.

A document's ids are replaced by their rank in the corpus (0: the most
frequent) and written as two streams: a control byte for each four ranks (two
bits each: bytes of the rank less one) and the ranks' low-order bytes, so
frequent ids take one byte.  Decoding looks the control bytes up in a numpy
table of lengths and gathers all ranks at once.

On disk a folder holds two Parquet tables: ``ranks`` (rank, id, count) and
``blocks``, a row per document (part, part_offset, the id column, n_tokens,
control, data).  Parts are ranges of ids in ascending order, and rows within a
part ascend too.

Shuffles: the coded documents once, into ranges; counts of at most a
vocabulary of ids per task.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shuffle_partitions
from .common import stage
from .encoders import worker_encoder

#: Bytes of each of the four ranks that a control byte describes.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1


#: Ids coded or decoded at once.
_BLOCK_IDS = 1 << 20


def _blocks(counts: np.ndarray) -> Iterator[slice]:
    """Consecutive documents with about ``_BLOCK_IDS`` ids together."""
    ends, begin = np.cumsum(counts), 0
    while begin < len(counts):
        done = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, done + _BLOCK_IDS)))
        yield slice(begin, end)
        begin = end


def _places(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each id's place in its document's run of whole control bytes, and the control bytes up to each document."""
    padded = -(-counts // 4) * 4
    shift = (np.cumsum(padded) - padded) - (np.cumsum(counts) - counts)
    return np.arange(int(counts.sum())) + np.repeat(shift, counts), np.concatenate(([0], np.cumsum(padded) // 4))


def encode_ranks(ranks: np.ndarray, counts: np.ndarray) -> tuple[list[bytes], list[bytes]]:
    """Control and data bytes of each document; ``ranks`` are those of all documents in order."""
    ranks = ranks.astype("<u4")
    extra = (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    places, bounds = _places(counts)
    padded = np.zeros(4 * bounds[-1], dtype=np.uint8)
    padded[places] = extra
    control = (padded.reshape(-1, 4) << np.array([0, 2, 4, 6], dtype=np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()
    used = np.arange(4, dtype=np.uint8) <= extra[:, None]
    data = ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()
    sizes = np.concatenate(([0], np.cumsum(extra + np.int64(1))))[np.concatenate(([0], np.cumsum(counts)))]
    return ([control[i:j] for i, j in zip(bounds.tolist(), bounds[1:].tolist())],
            [data[i:j] for i, j in zip(sizes.tolist(), sizes[1:].tolist())])


def decode_ranks(control: list[bytes], data: list[bytes], counts: np.ndarray) -> np.ndarray:
    """Ranks of all documents in order, by table lookup of their lengths."""
    places, _ = _places(counts)
    lengths = LENGTHS[np.frombuffer(b"".join(control), dtype=np.uint8)].reshape(-1)[places]
    begins = np.cumsum(lengths) - lengths
    source = np.frombuffer(b"".join([*data, b"\0\0\0"]), dtype=np.uint8)
    ranks = source[begins].astype(np.uint32)
    for k in range(1, 4):
        more = np.flatnonzero(lengths > k)
        if len(more):
            ranks[more] |= source[begins[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return ranks


def _flat(ids: pa.Array, counts: np.ndarray) -> np.ndarray:
    """The staged ids of some documents (each has at least its end id)."""
    raw = b"".join(ids.to_pylist())
    return np.frombuffer(raw, dtype=f"<u{len(raw) // max(1, int(counts.sum()))}" if raw else "<u2")


def _encoded(docs: DataFrame, tokenizer_file: str, end_id: int) -> DataFrame:
    """id, n_tokens and ids (unsigned 16-bit where the vocabulary allows, else 32-bit), staged."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_file)
        kind = np.dtype("<u2" if encoder.vocabulary <= 1 << 16 else "<u4")
        for batch in batches:
            names, ids = batch.column("id"), []
            for codes in encoder.encode_all(batch.column("text")):
                ids.append(np.append(codes, np.uint32(end_id)).astype(kind).tobytes())
            counts = pa.array([len(x) // kind.itemsize for x in ids], pa.int64())
            yield pa.RecordBatch.from_arrays([names, counts, pa.array(ids, pa.binary())], ["id", "n_tokens", "ids"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(encode, f"id {kind}, n_tokens long, ids binary")


def _counted(encoded: DataFrame) -> DataFrame:
    """How often each id occurs in all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, dtype=np.int64)
        for batch in batches:
            counts = batch.column("n_tokens").to_numpy()
            for block in _blocks(counts):
                ids = batch.column("ids").slice(block.start, block.stop - block.start)
                found = np.bincount(_flat(ids, counts[block]))
                if len(found) > len(total):
                    found, total = total, found.astype(np.int64)
                total[:len(found)] += found
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], ["token", "count"])

    partial = encoded.select("n_tokens", "ids").mapInArrow(count, "token long, count long")
    return partial.groupBy("token").agg(F.sum("count").alias("count"))


def write(docs: DataFrame, path: str, tokenizer_file: str, id_col: str = "doc_id",
          text_col: str = "text", end_id: int = 0, parts: int | None = None) -> None:
    """Encode every document of ``docs`` (an end id after each) into a new folder ``path``.

    Null texts are empty (one id, the end id); a null id comes first; repeated
    rows are written each, rows of one id in any order.  Other columns are
    ignored.  An empty table writes empty tables.  ``parts`` (default: the
    session's shuffle partitions) ranges of ids hold about as many rows each;
    the rows of an id that is more frequent than that are dealt to several.
    """
    spark = docs.sparkSession
    parts = parts or shuffle_partitions(spark)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    source = source.withColumn("id", F.col("id").cast("long"))
    encoded = stage(_encoded(source, tokenizer_file, end_id), "encoded")

    counts = _counted(encoded).collect()  # at most a row per vocabulary entry
    counts.sort(key=lambda r: (-r["count"], r["token"]))
    spark.createDataFrame([(i, r["token"], r["count"]) for i, r in enumerate(counts)],
                          "rank long, id long, count long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(max((r["token"] for r in counts), default=0) + 1, dtype=np.uint32)
    rank_of[[r["token"] for r in counts]] = np.arange(len(counts))

    shares = [i / parts for i in range(1, parts)]
    bounds = encoded.agg(F.percentile_approx("id", shares, 10 * parts)).first()[0] if shares else []
    bounds = np.array(bounds or [], dtype=np.int64)

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part, control, data = [], [], []
            for i, key in enumerate(batch.column("id").to_pylist()):
                low = int(np.searchsorted(bounds, key, "left")) if key is not None else 0
                high = int(np.searchsorted(bounds, key, "right")) if key is not None else 0
                part.append(low + i % (high - low) if high > low + 1 else low)
            counts = batch.column("n_tokens").to_numpy()
            for block in _blocks(counts):
                ids = batch.column("ids").slice(block.start, block.stop - block.start)
                pair = encode_ranks(rank_of[_flat(ids, counts[block])], counts[block])
                control += pair[0]
                data += pair[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(part, pa.int32()), batch.column("id"), batch.column("n_tokens"),
                 pa.array(control, pa.binary()), pa.array(data, pa.binary())],
                ["part", "id", "n_tokens", "control", "data"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Ids before each document in its part; a partition holds whole parts in order."""
        at, before = None, 0
        for batch in batches:
            offsets = []
            for part, n in zip(batch.column("part").to_pylist(), batch.column("n_tokens").to_pylist()):
                if part != at:
                    at, before = part, 0
                offsets.append(before)
                before += n
            yield batch.append_column("part_offset", pa.array(offsets, pa.int64()))

    coded = encoded.mapInArrow(code, "part int, id long, n_tokens long, control binary, data binary")
    dealt = coded.repartitionById(parts, F.col("part")).sortWithinPartitions("part", F.asc_nulls_first("id"))
    placed = dealt.mapInArrow(place, "part int, id long, n_tokens long, control binary, data binary, part_offset long")
    placed.write.option("compression", "zstd").parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of a folder: doc_id, start (ids before it), n_tokens, ids_crc32 (of the ids as
    little-endian unsigned 32-bit integers), and ``ids`` if ``with_ids``."""
    blocks, ranks = spark.read.parquet(f"{path}/blocks"), spark.read.parquet(f"{path}/ranks")
    rows = ranks.orderBy("rank").select("id").collect()  # at most a row per vocabulary entry
    id_of = np.array([r["id"] for r in rows], dtype="<u4")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums, lists = [], []
            counts = batch.column("n_tokens").to_numpy()
            for block in _blocks(counts):
                control, data = (batch.column(c).slice(block.start, block.stop - block.start).to_pylist() for c in ("control", "data"))
                ids = id_of[decode_ranks(control, data, counts[block])]
                raw, ends = ids.tobytes(), np.cumsum(counts[block]).tolist()
                for begin, end in zip([0, *ends], ends):
                    sums.append(zlib.crc32(raw[4 * begin:4 * end]))
                    if with_ids:
                        lists.append(ids[begin:end].astype(np.int32))
            columns = [batch.column(c) for c in ("part", "id", "n_tokens", "part_offset")] + [pa.array(sums, pa.int64())]
            names = ["part", "id", "n_tokens", "part_offset", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    decoded = blocks.select("part", "id", "n_tokens", "part_offset", "control", "data").mapInArrow(
        decode, "part int, id long, n_tokens long, part_offset long, ids_crc32 long" + (", ids array<int>" if with_ids else ""))
    totals = blocks.groupBy("part").agg(F.sum("n_tokens").alias("part_tokens"))  # a row per part
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    begins = totals.select("part", F.coalesce(F.sum("part_tokens").over(earlier), F.lit(0)).alias("part_start"))
    out = decoded.join(F.broadcast(begins), "part")  # bounded by the number of parts
    return out.select(F.col("id").alias("doc_id"), (F.col("part_start") + F.col("part_offset")).alias("start"),
                      "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
