"""Raw sensor matrices: tab-delimited text, one 60-second cycle per line.

A matrix has no key: a line's position is its cycle id.  Positions are built
without a global sort and without Python row objects: each kept line is tagged
with its file, the start offset of the file split that holds it and
``monotonically_increasing_id`` (consecutive inside a split); a small per-split
table (first id, line count) gives each split's starting cycle by a prefix sum
in (file, split start) order.

Every reader reads the text once and writes the tagged rows as Parquet under
the checkpoint directory; positions come from that stage.  ``read_matrix``
stages the lines, the ETL's ``stage_sensor_set`` only their means.

Numbers are parsed in columns: Arrow batches of lines are split and cast as a
whole, and a line's mean is a segment sum; no line becomes a row of Python.

Text rules kept from the reference's loader: blank lines and ``#`` comments
are skipped, ``nan`` parses as NaN, an empty field or an unparsable number
raises, rows of different widths raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse import schema
from fleetpulse.session import materialize
from fleetpulse.sources.tables import path_exists


class MatrixError(ValueError):
    """A raw matrix is missing, ragged, or inconsistent with the others."""


def require_inputs(spark: SparkSession, raw_dir: str, files) -> list[str]:
    """Every input must exist before any job starts."""
    paths = [f"{raw_dir.rstrip('/')}/{f}" for f in files]
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError(f"Missing: {', '.join(missing)}")
    return paths


def _kept_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines without comments; blank ones dropped.  Rows can be tens of kB:
    the comment regex only runs on lines that contain '#', and the blank test
    stops at the first non-space character.  (The line reader already drops
    '\n', '\r\n' and '\r' endings.)"""
    value = F.col("value")
    body = F.when(value.contains("#"), F.regexp_replace(value, "#.*$", "")).otherwise(value)
    return spark.read.text(path).select(body.alias("line")).filter(F.col("line").rlike(r"\S"))


def _tagged_lines(spark: SparkSession, path: str) -> DataFrame:
    """Kept lines tagged with their file split and a split-local running id."""
    return _kept_lines(spark, path).select(
        F.input_file_name().alias("_file"),
        F.input_file_block_start().alias("_blk"),
        F.monotonically_increasing_id().alias("_mid"),
        "line",
    )


#: File splits whose start positions are broadcast (about 150 bytes each).
MAX_BROADCAST_SPLITS = 500_000


def place(staged: DataFrame, group_cols=()) -> DataFrame:
    """Turn the split tags of a staged table into 0-based positions (``cycle_id``) per ``group_cols``.

    One row per (group, file split) holds the split's first id and line count;
    a prefix sum in (file, split start) order gives each split's first
    position.  The tags were written once, so counts and rows see the same
    splits.  The split table is counted first (one small job) and broadcast
    within its bound.
    """
    group_cols = list(group_cols)
    keys = [*group_cols, "_file", "_blk"]
    splits = staged.groupBy(*keys).agg(
        F.min("_mid").alias("_first"), F.count(F.lit(1)).alias("_n"))
    # One row per file split: the prefix sum is small on purpose.
    before = (Window.partitionBy(*group_cols).orderBy("_file", "_blk")
              .rowsBetween(Window.unboundedPreceding, -1))
    starts = splits.select(*keys, "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    if splits.count() <= MAX_BROADCAST_SPLITS:
        starts = F.broadcast(starts)
    cycle = (F.col("_base") + F.col("_mid") - F.col("_first")).cast("long").alias("cycle_id")
    rest = [c for c in staged.columns if c not in ("_file", "_blk", "_mid")]
    return staged.join(starts, keys).select(cycle, *rest)


#: Characters of lines parsed at once.
PARSED_CHARS = 16 << 20


def _numbers(lines: pa.Array) -> pa.ListArray:
    """The tab-separated numbers of each line."""
    fields = pc.split_pattern(lines, "\t")
    try:
        values = pc.cast(fields.values, pa.float64())
    except pa.ArrowInvalid:
        try:  # numbers with blanks around them
            values = pc.cast(pc.utf8_trim_whitespace(fields.values), pa.float64())
        except pa.ArrowInvalid as e:
            raise ValueError(f"a field of a raw matrix cannot be cast to a number: {e}") from None
    return pa.ListArray.from_arrays(fields.offsets, values)


def _parse(tagged: DataFrame, made: Callable[[pa.ListArray], list[pa.Array]], fields: str) -> DataFrame:
    """The columns of ``tagged`` but its last, ``line``, and those that ``made`` builds from the lines' numbers."""
    kept = tagged.schema.fields[:-1]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new = [f.strip().split(" ")[0] for f in fields.split(", ")]
        for batch in batches:
            ends = np.cumsum(pc.binary_length(batch.column(len(names))).to_numpy(zero_copy_only=False))
            start = 0
            while start < batch.num_rows:
                before = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, before + PARSED_CHARS, side="right")))
                part = batch.slice(start, stop - start)
                lines = pa.concat_arrays([part.column(len(names))])  # a copy without the slice's offset
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made(_numbers(lines))], [*names, *new])
                start = stop

    return tagged.mapInArrow(run, ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in kept], fields]))


def _widths(numbers: pa.ListArray) -> np.ndarray:
    return np.diff(numbers.offsets.to_numpy())


def _means(numbers: pa.ListArray) -> pa.Array:
    """The mean of each line, null if it isn't a number (ledger V2)."""
    values, starts = numbers.values.to_numpy(zero_copy_only=False), numbers.offsets.to_numpy()[:-1]
    means = np.add.reduceat(values, starts) / _widths(numbers) if len(values) else np.zeros(0)
    return pa.array(means, pa.float64(), mask=np.isnan(means))


def _truncated(numbers: pa.ListArray) -> pa.ListArray:
    values = np.trunc(numbers.values.to_numpy(zero_copy_only=False))
    if not np.isfinite(values).all():
        raise ValueError("a label of a raw matrix cannot be cast to an integer")
    return pa.ListArray.from_arrays(numbers.offsets, pa.array(values.astype(np.int32)))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(cycle_id, line): kept lines of a text matrix with 0-based positions (read once and staged)."""
    return place(materialize(_tagged_lines(spark, path), "raw-lines"))


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """(cycle_id, samples ARRAY<DOUBLE>) of a tab-delimited matrix."""
    return _parse(read_lines(spark, path), lambda numbers: [numbers], "samples array<double>")


def read_labels(spark: SparkSession, path: str) -> DataFrame:
    """S3: (cycle_id, labels ARRAY<INT>), values truncated toward zero."""
    m = read_matrix(spark, path)
    return m.select("cycle_id", F.transform("samples", lambda x: x.cast("int")).alias("labels"))


def read_sensor_set(spark: SparkSession, raw_dir: str,
                    sensors=schema.SENSOR_FILES) -> DataFrame:
    """The named matrices as one long frame (cycle_id, sensor, samples)."""
    paths = require_inputs(spark, raw_dir, [f for f, _ in sensors] + [schema.LABEL_FILE])
    frames = [read_matrix(spark, p).withColumn("sensor", F.lit(name))
              for p, (_, name) in zip(paths, sensors)]
    return reduce(DataFrame.unionByName, frames).select("cycle_id", "sensor", "samples")


def stage_sensor_set(spark: SparkSession, raw_dir: str,
                     sensors=schema.SENSOR_FILES) -> DataFrame:
    """All matrices reduced in one pass over the raw text and staged.

    Each kept line becomes one narrow row — (sensor, split tags, width, row
    mean) or, for the label matrix, (width, labels) — written once as Parquet
    under the checkpoint directory; positions are then computed from that
    small table, so the raw text is read exactly once.  Returns (cycle_id, sensor, width,
    mean, labels).
    """
    files = [f for f, _ in sensors] + [schema.LABEL_FILE]
    paths = require_inputs(spark, raw_dir, files)
    frames = []
    for path, (_, name) in zip(paths, sensors):
        tagged = _tagged_lines(spark, path).select(F.lit(name).alias("sensor"), "_file", "_blk", "_mid", "line")
        parsed = _parse(tagged, lambda x: [pa.array(_widths(x), pa.int32()), _means(x)], "width int, mean double")
        frames.append(parsed.withColumn("labels", F.lit(None).cast("array<int>")))
    tagged = _tagged_lines(spark, paths[-1]).select(F.lit("profile").alias("sensor"), "_file", "_blk", "_mid", "line")
    parsed = _parse(tagged, lambda x: [pa.array(_widths(x), pa.int32()), _truncated(x)], "width int, labels array<int>")
    frames.append(parsed.select("sensor", "_file", "_blk", "_mid", "width", F.lit(None).cast("double").alias("mean"), "labels"))
    narrow = materialize(reduce(DataFrame.unionByName, frames), "raw-stage")
    return place(narrow, ["sensor"]).select("cycle_id", "sensor", "width", "mean", "labels")


def read_label_matrix(spark: SparkSession, raw_dir: str) -> DataFrame:
    paths = require_inputs(spark, raw_dir, [schema.LABEL_FILE])
    return read_labels(spark, paths[0])


def matrix_shape(long_df: DataFrame, labels: DataFrame | None = None,
                 expected=None) -> dict:
    """One small job: rows and widths per sensor (≤ 11 result rows).

    Takes the long frame (with ``samples``) or a staged one (with ``width``).
    Raises ``MatrixError`` on ragged rows, unequal cycle counts or an
    ``expected`` matrix without rows (it would turn into a NULL column); returns
    ``{"n_cycles": ..., "widths": {sensor: width}}``.  The cycle count is
    taken from the first sensor, as the reference does.
    """
    width = F.col("width") if "width" in long_df.columns else F.size("samples")
    shape = long_df.groupBy("sensor").agg(
        F.count(F.lit(1)).alias("rows"), F.min(width).alias("lo"), F.max(width).alias("hi"))
    if labels is not None:
        shape = shape.unionByName(labels.agg(
            F.lit("profile").alias("sensor"), F.count(F.lit(1)).alias("rows"),
            F.min(F.size("labels")).alias("lo"), F.max(F.size("labels")).alias("hi")))
    info = {r["sensor"]: (r["rows"], r["lo"], r["hi"]) for r in shape.collect()}
    missing = sorted(set(expected or ()) - set(info))
    if missing:
        raise MatrixError(f"no rows in: {', '.join(missing)}")
    ragged = sorted(s for s, (_, lo, hi) in info.items() if lo != hi)
    if ragged:
        raise MatrixError(f"rows of different widths in: {', '.join(ragged)}")
    counts = {s: n for s, (n, _, _) in info.items()}
    if len(set(counts.values())) > 1:
        raise MatrixError(f"cycle counts differ between matrices: {counts}")
    first = schema.SENSOR_NAMES[0] if schema.SENSOR_NAMES[0] in counts else next(iter(counts), None)
    return {"n_cycles": counts.get(first, 0), "widths": {s: lo for s, (_, lo, _) in info.items()}}
