"""Writing the two tables (S9) and reading them back.

A load is written to a folder of its own under ``<root>/versions``, checked
and counted there, and published by one rename of the small file
``<root>/CURRENT`` that names it.  Readers follow that file, so they see the
old pair of tables or the new one, never a mixture; a load that fails before
the rename changes nothing.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from fleetpulse import schema
from fleetpulse.functions import columns as C
from fleetpulse.operators.joins import fits_broadcast
from fleetpulse.operators.quality import assert_constraints
from fleetpulse.operators.state import UnitState, unit_state
from fleetpulse.session import conf_int, shuffle_partitions
from fleetpulse.sources.tables import path_exists

PARTITION_COLUMN = "reading_date"
ROWS_PER_FILE_KEY = "fleetpulse.write.rowsPerFile"
#: A lease older than this belongs to a load that died.
LEASE_DAYS = 7
DEFAULT_ROWS_PER_FILE = 5_000_000  # ~100 B per reading → files of a few hundred MB


class LoadError(RuntimeError):
    """The written tables don't hold what was to be written."""


def _hadoop(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def _rename(spark: SparkSession, source: str, target: str, overwrite: bool) -> None:
    """One atomic rename; without ``overwrite`` it fails if the target is there."""
    fs, path = _hadoop(spark, source)
    options = spark._jvm.org.apache.hadoop.fs.Options.Rename
    how = spark._sc._gateway.new_array(options, 1)
    how[0] = options.OVERWRITE if overwrite else options.NONE
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(path), fs.makeQualified(_hadoop(spark, target)[1]), how)


def _put(spark: SparkSession, path: str, text: str) -> None:
    fs, hadoop = _hadoop(spark, path)
    out = fs.create(hadoop, True)
    out.write(bytearray(text.encode()))
    out.close()


def _publish(spark: SparkSession, root: str, version: str, expected: str | None) -> None:
    """Make ``version`` the successor of ``expected``, or fail if another load has become that.

    The claim to follow a version is a file named after it, which only one load
    can rename into place; its holder alone then points ``CURRENT`` to its
    version.  Versions of finished loads other than the new and the last one
    are removed; a load that is still written holds a lease and stays.
    """
    draft, claim = f"{root}/.draft-{version}", f"{root}/claims/{expected or 'first'}"
    fs, _ = _hadoop(spark, root)
    fs.mkdirs(_hadoop(spark, f"{root}/claims")[1])
    _put(spark, draft, version)
    for last_try in (False, True):
        try:
            _rename(spark, draft, claim, overwrite=False)
            break
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in str(e.java_exception):
                raise
            holder = spark.read.text(claim, wholetext=True).first()[0].strip()
            if last_try or _leased(spark, root, holder) or current_version(spark, root) != expected:
                fs.delete(_hadoop(spark, draft)[1], False)
                raise LoadError(f"another load has replaced version {expected or 'none'} of {root}; this one isn't published") from e
            fs.delete(_hadoop(spark, claim)[1], False)  # its holder ended before it could publish
    _put(spark, draft, version)
    _rename(spark, draft, f"{root}/CURRENT", overwrite=True)
    for entry in fs.listStatus(_hadoop(spark, f"{root}/versions")[1]):
        name = entry.getPath().getName()
        if name not in (version, expected) and not _leased(spark, root, name):
            fs.delete(entry.getPath(), True)


def _leased(spark: SparkSession, root: str, version: str) -> bool:
    """Whether a load still writes the version: its lease is there and not older than ``LEASE_DAYS``."""
    fs, path = _hadoop(spark, f"{root}/leases/{version}")
    return bool(fs.exists(path)) and time.time() - fs.getFileStatus(path).getModificationTime() / 1000 < LEASE_DAYS * 86400


def current_version(spark: SparkSession, root: str) -> str | None:
    """The published version's folder name, or None."""
    path = f"{root.rstrip('/')}/CURRENT"
    if not path_exists(spark, path):
        return None
    return spark.read.text(path, wholetext=True).first()[0].strip()


def write_tables(units: DataFrame, readings: DataFrame, root: str, expected_rows: int | None = None,
                 num_partitions: int | None = None, check: bool = True) -> dict:
    """Full refresh of both tables (S9); returns their row counts.

    The rows are computed once, into the new version's folder; the constraint
    job and the counts read that.  A violation, or a count other than
    ``expected_rows``, raises and leaves the published tables as they are.
    Readings are range-partitioned on (date, unit, time) and written by date,
    so date filters prune folders and unit or time filters row groups.  Their
    per-unit state is part of the version.
    """
    spark, root, version = readings.sparkSession, root.rstrip("/"), uuid.uuid4().hex
    path, expected = f"{root}/versions/{version}", current_version(spark, root)
    lease = f"{root}/leases/{version}"
    _put(spark, lease, version)
    try:
        return _load(units, readings, root, version, expected, expected_rows, num_partitions, check)
    except BaseException:
        if current_version(spark, root) != version:
            fs, hadoop = _hadoop(spark, path)
            fs.delete(hadoop, True)  # nothing of a failed load stays
        raise
    finally:
        fs, hadoop = _hadoop(spark, lease)
        fs.delete(hadoop, False)


def _load(units: DataFrame, readings: DataFrame, root: str, version: str, expected: str | None,
          expected_rows: int | None, num_partitions: int | None, check: bool) -> dict:
    spark, path = readings.sparkSession, f"{root}/versions/{version}"
    if num_partitions is None and expected_rows is not None:
        num_partitions = -(-expected_rows // conf_int(spark, ROWS_PER_FILE_KEY, DEFAULT_ROWS_PER_FILE))
    (units.coalesce(1) if fits_broadcast(units) else units.repartitionByRange("unit_id")
     ).write.parquet(f"{path}/units")
    dated = C.without_nan(readings).withColumn(PARTITION_COLUMN, F.to_date("timestamp"))
    (dated.repartitionByRange(max(1, num_partitions or shuffle_partitions(spark)), PARTITION_COLUMN, "unit_id", "timestamp")
     .sortWithinPartitions(PARTITION_COLUMN, "unit_id", "timestamp")
     .write.partitionBy(PARTITION_COLUMN).parquet(f"{path}/readings"))
    written = _read(spark, path)
    unit_state(written[1]).write.parquet(f"{path}/unit_state")
    if check:
        assert_constraints(*written)
    counts = {"units": written[0].count(), "readings": written[1].count()}
    if expected_rows is not None and counts["readings"] != expected_rows:
        raise LoadError(f"{counts['readings']} readings were written, {expected_rows} were to be")
    _publish(spark, root, version, expected)
    return counts


def _read(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    dated = StructType([*schema.READINGS_SCHEMA.fields, StructField(PARTITION_COLUMN, DateType())])
    units = spark.read.parquet(f"{path}/units")
    return units, spark.read.schema(dated).parquet(f"{path}/readings").drop(PARTITION_COLUMN)


def readings_path(spark: SparkSession, root: str) -> str:
    """Folder of the published readings, partitioned by date."""
    return f"{root.rstrip('/')}/versions/{current_version(spark, root)}/readings"


def read_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The published (units, readings); an empty load reads as empty tables."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no tables at {root}; run the ETL first")
    return _read(spark, f"{root.rstrip('/')}/versions/{version}")


def read_state(spark: SparkSession, root: str) -> UnitState:
    """The per-unit state of the published readings."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no tables at {root}; run the ETL first")
    return UnitState(spark.read.parquet(f"{root.rstrip('/')}/versions/{version}/unit_state"))


def loaded_counts(spark: SparkSession, root: str) -> dict:
    """Row counts of the published tables (Parquet footers only)."""
    units, readings = read_tables(spark, root)
    return {"units": units.count(), "readings": readings.count()}
