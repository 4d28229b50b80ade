"""ETL: golden facts on a 2,205-cycle synthetic matrix set, tiny and bad inputs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fleet_fixtures import write_matrices
from fleetpulse import schema
from fleetpulse.operators import quality as Q
from fleetpulse.operators import sink
from fleetpulse.operators import transform as T
from fleetpulse.sources import matrix as M


def run_etl_steps(spark, raw, out=None, n_units=schema.NUM_UNITS):
    long = M.read_sensor_set(spark, raw)
    labels = M.read_label_matrix(spark, raw)
    shape = M.matrix_shape(long, labels)
    units, readings = T.transform(long, labels, shape["n_cycles"], n_units)
    if out is not None:
        sink.write_tables(units, readings, out)
        units, readings = sink.read_tables(spark, out)
    return shape, units, readings


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    """The production job (single-pass staging, checks, write) on 2,205 cycles."""
    from fleetpulse.plans.etl_job import run_etl

    root = tmp_path_factory.mktemp("full_shape")
    means = write_matrices(str(root / "raw"), 2205)
    counts = run_etl(spark, str(root / "raw"), str(root / "db"))
    assert counts["cycles"] == 2205 and counts["dropped_cycles"] == 5
    shape = M.matrix_shape(M.stage_sensor_set(spark, str(root / "raw")))
    units, readings = sink.read_tables(spark, str(root / "db"))
    return means, shape, units, readings


def test_staged_and_lazy_paths_agree(spark, tmp_path):
    write_matrices(str(tmp_path), 300, widths=(7, 13))
    _, _, lazy = run_etl_steps(spark, str(tmp_path))
    staged = M.stage_sensor_set(spark, str(tmp_path))
    shape = M.matrix_shape(staged)
    single = T.to_readings(T.assemble_cycles(staged, None), shape["n_cycles"])
    assert sorted(map(tuple, lazy.collect())) == sorted(map(tuple, single.collect()))


def test_golden_counts(golden):
    _, shape, units, readings = golden
    assert shape["n_cycles"] == 2205
    assert shape["widths"]["ts1"] == 6 and shape["widths"]["ts2"] == 12
    assert units.count() == 20
    assert readings.count() == 2200
    per_unit = {r[0]: r[1] for r in readings.groupBy("unit_id").count().collect()}
    assert set(per_unit.values()) == {110} and len(per_unit) == 20


def test_golden_clock(golden):
    _, _, _, readings = golden
    span = readings.groupBy("unit_id").agg(F.min("timestamp").alias("a"), F.max("timestamp").alias("b"))
    assert {(r.a, r.b) for r in span.collect()} == {
        (dt.datetime(2024, 1, 1, 0, 0), dt.datetime(2024, 1, 2, 3, 15))}
    hours = {r[0]: r[1] for r in readings.groupBy(F.hour("timestamp")).count().collect()}
    assert hours == {h: (160 if h < 3 else 120 if h == 3 else 80) for h in range(24)}


def test_golden_units(golden):
    _, _, units, _ = golden
    by_region = {r[0]: r[1] for r in units.groupBy("region").count().collect()}
    assert by_region == {"Auckland": 6, "Wellington": 4, "Christchurch": 4, "Hamilton": 4,
                         "Dunedin": 2}
    rows = {r.unit_id: r for r in units.collect()}
    assert rows[1].install_date == dt.date(2023, 7, 5)
    assert rows[2].install_date == dt.date(2023, 6, 5)
    assert rows[20].install_date == dt.date(2021, 12, 12)
    assert rows[1].unit_code == "CLR-0001" and rows[20].unit_code == "CLR-0020"
    assert rows[1].model == "SC-500" and rows[4].model == "MC-300"
    assert (rows[11].region, rows[11].site) == ("Auckland", "Rosedale")


def test_golden_values(golden):
    means, _, _, readings = golden
    rows = {r.reading_id: r for r in readings.filter(F.col("reading_id").isin(1, 111, 2200)).collect()}
    for rid in (1, 111, 2200):
        cyc = rid - 1
        temp = sum(means[s][cyc] for s in schema.TEMPERATURE_SENSORS) / 4
        assert rows[rid].avg_temp_c == pytest.approx(round(temp, 2))
        assert rows[rid].pressure_bar == pytest.approx(round(means["ps1"][cyc], 2))
        assert rows[rid].flow_rate_l_min == pytest.approx(round(means["fs1"][cyc], 2))
    assert rows[111].unit_id == 2 and rows[111].timestamp == dt.datetime(2024, 1, 1)
    assert rows[1].cooler_condition == 100 and rows[1].is_stable is True
    assert rows[2200].is_stable is False  # cycle 2199 is odd → flag 1 → not stable


def test_golden_constraints_clean(golden):
    _, _, units, readings = golden
    checks = {r["check"]: r["violations"] for r in Q.check_constraints(units, readings).collect()}
    assert all(v == 0 for v in checks.values()) and len(checks) == 13


def test_tiny_fleet_drops_remainder(spark, tmp_path):
    means = write_matrices(str(tmp_path), 45, widths=(3, 5, 7))
    shape, units, readings = run_etl_steps(spark, str(tmp_path))
    assert shape["n_cycles"] == 45
    assert readings.count() == 40
    got = {r.reading_id: r.motor_power_w for r in readings.collect()}
    assert set(got) == set(range(1, 41))
    assert got[40] == pytest.approx(round(means["eps1"][39], 1))


def test_fewer_cycles_than_units_gives_empty_readings(spark, tmp_path):
    write_matrices(str(tmp_path), 7)
    _, units, readings = run_etl_steps(spark, str(tmp_path))
    assert readings.count() == 0 and units.count() == 20


def test_comments_blank_lines_and_nan(spark, tmp_path):
    extra = {"ts1": [(0, "# header comment"), (3, ""), (5, "   ")]}
    means = write_matrices(str(tmp_path), 40, extra_lines=extra)
    path = os.path.join(tmp_path, "PS1.txt")
    lines = open(path).read().splitlines()
    fields = lines[2].split("\t")
    fields[1] = "nan"
    lines[2] = "\t".join(fields)
    open(path, "w").write("\n".join(lines) + "\n")
    shape, _, readings = run_etl_steps(spark, str(tmp_path))
    assert shape["n_cycles"] == 40
    rows = {r.reading_id: r for r in readings.collect()}
    assert rows[3].pressure_bar is None  # NaN sample → NULL metric (V2)
    assert rows[3].avg_temp_c == pytest.approx(
        round(sum(means[s][2] for s in schema.TEMPERATURE_SENSORS) / 4, 2))


def test_positions_survive_many_splits(spark, tmp_path):
    write_matrices(str(tmp_path), 3000, widths=(40,))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        m = M.read_matrix(spark, os.path.join(tmp_path, "TS1.txt"))
        assert m.rdd.getNumPartitions() > 4
        firsts = m.select("cycle_id", F.element_at("samples", 1).alias("x"))
        bad = firsts.filter(F.abs(F.col("x") - (F.col("cycle_id") + 10.0)) > 1.01).count()
        assert bad == 0
        assert m.agg(F.min("cycle_id"), F.max("cycle_id"), F.countDistinct("cycle_id")).first() == (
            0, 2999, 3000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_missing_file_raises(spark, tmp_path):
    write_matrices(str(tmp_path), 30)
    os.remove(os.path.join(tmp_path, "CE.txt"))
    with pytest.raises(FileNotFoundError):
        M.read_sensor_set(spark, str(tmp_path))


def test_ragged_row_raises(spark, tmp_path):
    write_matrices(str(tmp_path), 30)
    path = os.path.join(tmp_path, "VS1.txt")
    lines = open(path).read().splitlines()
    lines[4] += "\t1.0"
    open(path, "w").write("\n".join(lines) + "\n")
    with pytest.raises(M.MatrixError, match="widths"):
        M.matrix_shape(M.read_sensor_set(spark, str(tmp_path)))


def test_short_file_raises(spark, tmp_path):
    write_matrices(str(tmp_path), 30)
    path = os.path.join(tmp_path, "CP.txt")
    lines = open(path).read().splitlines()
    open(path, "w").write("\n".join(lines[:-1]) + "\n")
    long = M.read_sensor_set(spark, str(tmp_path))
    with pytest.raises(M.MatrixError, match="cycle counts"):
        M.matrix_shape(long, M.read_label_matrix(spark, str(tmp_path)))


def test_empty_field_raises(spark, tmp_path):
    write_matrices(str(tmp_path), 30)
    path = os.path.join(tmp_path, "FS1.txt")
    lines = open(path).read().splitlines()
    lines[1] = lines[1].split("\t", 1)[1] and "\t" + lines[1].split("\t", 1)[1]
    open(path, "w").write("\n".join(lines) + "\n")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        M.read_matrix(spark, path).collect()


def test_one_row_file_is_one_cycle(spark, tmp_path):
    path = os.path.join(tmp_path, "one.txt")
    open(path, "w").write("1.0\t2.0\t6.0\n")
    rows = M.read_matrix(spark, path).collect()
    assert [(r.cycle_id, r.samples) for r in rows] == [(0, [1.0, 2.0, 6.0])]


def test_write_refuses_constraint_violations(spark, tmp_path):
    write_matrices(str(tmp_path / "raw"), 40)
    long = M.read_sensor_set(spark, str(tmp_path / "raw"))
    labels = M.read_label_matrix(spark, str(tmp_path / "raw"))
    units, readings = T.transform(long, labels, 40)
    dup = readings.unionByName(readings.limit(1))
    with pytest.raises(Q.ConstraintViolation, match="primary key"):
        sink.write_tables(units, dup, str(tmp_path / "db"))


def test_etl_job_end_to_end(spark, tmp_path):
    from fleetpulse.plans.etl_job import run_etl

    write_matrices(str(tmp_path / "raw"), 2205, widths=(6, 60))
    counts = run_etl(spark, str(tmp_path / "raw"), str(tmp_path / "db"))
    assert counts == {"units": 20, "readings": 2200, "cycles": 2205, "dropped_cycles": 5}
    units, readings = sink.read_tables(spark, str(tmp_path / "db"))
    dates = {r[0] for r in spark.read.parquet(sink.readings_path(spark, str(tmp_path / "db")))
             .select("reading_date").distinct().collect()}
    assert dates == {dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    assert readings.filter(F.col("unit_id") == 7).count() == 110


def test_reports_on_written_tables(spark, golden, tmp_path):
    """ETL output → the runner's seven reports with the original parameters."""
    from fleetpulse.plans.runner import run_batch, table_reports

    _, _, units, readings = golden
    counts = run_batch(table_reports(readings, units), str(tmp_path))
    reports = {name: spark.read.parquet(f"{tmp_path}/{name}") if n else None for name, n in counts.items()}
    regions = {r.region: (r.units, r.readings) for r in reports["run_fleet_overview"].collect()}
    assert regions == {"Auckland": (6, 660), "Wellington": (4, 440), "Christchurch": (4, 440),
                       "Hamilton": (4, 440), "Dunedin": (2, 220)}
    dist = {r.condition_pct: r.reading_count for r in reports["run_condition_distribution"].collect()}
    assert sum(dist.values()) == 2200 and set(dist) == {100, 20, 3}
    mv = sorted(reports["run_moving_average"].collect(), key=lambda r: r.timestamp)
    assert len(mv) == 15 and {r.unit_code for r in mv} == {"CLR-0001"}
    assert mv[3].temp_moving_avg == pytest.approx(round(sum(r.temp_c for r in mv[:4]) / 4, 2), abs=0.011)
    sites = reports["run_site_failure_rate"].collect()
    assert len(sites) == 10 and sum(r.failure_readings for r in sites) == dist[3]
    # Temperatures rise linearly inside each unit: a uniform ramp never passes |z| = 2.
    assert counts["run_zscore_anomalies"] == 0 and counts["run_worst_units"] == 5


def test_failed_load_leaves_the_old_tables(spark, tmp_path, monkeypatch):
    """A fault between the tables, or a count that is off, changes nothing that readers see."""
    from fleetpulse.plans.etl_job import run_etl

    db = str(tmp_path / "db")
    write_matrices(str(tmp_path / "raw"), 40)
    run_etl(spark, str(tmp_path / "raw"), db)
    write_matrices(str(tmp_path / "more"), 80)

    def broken(*_):
        raise RuntimeError("fault")

    with monkeypatch.context() as m:
        m.setattr(sink, "assert_constraints", broken)
        with pytest.raises(RuntimeError):
            run_etl(spark, str(tmp_path / "more"), db)
    units, readings = sink.read_tables(spark, db)
    assert sink.loaded_counts(spark, db) == {"units": 20, "readings": 40}
    with pytest.raises(sink.LoadError):
        sink.write_tables(units, readings.limit(39), db, expected_rows=40)
    assert sink.loaded_counts(spark, db) == {"units": 20, "readings": 40}
    for _ in range(3):
        run_etl(spark, str(tmp_path / "more"), db)
    assert sink.loaded_counts(spark, db) == {"units": 20, "readings": 80}
    assert len(os.listdir(os.path.join(db, "versions"))) == 2


def test_empty_load_reads_back_empty(spark, tmp_path):
    from fleetpulse.plans.etl_job import run_etl

    write_matrices(str(tmp_path / "raw"), 7)
    counts = run_etl(spark, str(tmp_path / "raw"), str(tmp_path / "db"))
    assert counts == {"units": 20, "readings": 0, "cycles": 7, "dropped_cycles": 7}
    units, readings = sink.read_tables(spark, str(tmp_path / "db"))
    assert units.count() == 20 and readings.collect() == []
    assert [f.name for f in readings.schema] == [f.name for f in schema.READINGS_SCHEMA]


def test_empty_sensor_file_raises(spark, tmp_path):
    from fleetpulse.plans.etl_job import run_etl

    write_matrices(str(tmp_path / "raw"), 30)
    open(os.path.join(tmp_path, "raw", "EPS1.txt"), "w").write("# no data\n\n")
    with pytest.raises(M.MatrixError, match="no rows in: eps1"):
        run_etl(spark, str(tmp_path / "raw"), str(tmp_path / "db"))


def test_missing_store_is_refused(spark, tmp_path):
    from fleetpulse.sources.tables import table_exists

    assert not table_exists(spark, str(tmp_path / "nothing"))
    with pytest.raises(FileNotFoundError, match="run the ETL first"):
        sink.read_tables(spark, str(tmp_path / "nothing"))


def test_stages_land_under_the_checkpoint_dir(spark):
    from fleetpulse.session import ensure_checkpoint_dir, materialize

    def local(uri):  # file:/a, file:///a → /a
        return "/" + uri.split(":", 1)[-1].lstrip("/")

    base = local(ensure_checkpoint_dir(spark)).rstrip("/")
    staged = materialize(spark.range(5).withColumn("x", F.col("id") * 2), "test")
    assert staged.inputFiles() and all(local(f).startswith(base) for f in staged.inputFiles())
    assert sorted(r.x for r in staged.collect()) == [0, 2, 4, 6, 8]


def test_sql_texts_on_written_tables(spark, golden):
    """The ten SQL texts over views of the ETL output, with the original unit code."""
    from fleetpulse.plans.sql_text import SQL, run_text

    _, _, units, readings = golden
    results = {name: run_text(spark, name, readings, units, "CLR-0001").collect() for name in SQL}
    regions = {r.region: (r.units, r.readings) for r in results["sql_fleet_overview"]}
    assert regions["Auckland"] == (6, 660) and regions["Dunedin"] == (2, 220)
    assert sum(r.reading_count for r in results["sql_condition_breakdown"]) == 2200
    assert len(results["sql_worst_units"]) == 10
    assert [r.hour for r in results["sql_hourly_pattern"]] == list(range(24))
    assert [r.readings for r in results["sql_hourly_pattern"]][:4] == [160, 160, 160, 120]
    mv = results["sql_moving_average"]
    assert len(mv) == 20 and {r.unit_code for r in mv} == {"CLR-0001"}
    assert len(results["sql_site_summary"]) == 10


def test_failing_units_run_hotter_end_to_end(spark, tmp_path):
    """Failing cycles 18 °C hotter in the raw matrices show up in the A4 report."""
    from fleetpulse.operators import analytics as A
    from fleetpulse.plans.etl_job import run_etl

    def cooler(i):
        return [100, 20, 3][i % 3]

    def hotter(name, i):
        return 18.0 if name in schema.TEMPERATURE_SENSORS and cooler(i) == 3 else 0.0

    means = write_matrices(str(tmp_path / "raw"), 600, labels=lambda i: [cooler(i), 100, 0, 130, 0],
                           shift=hotter)
    run_etl(spark, str(tmp_path / "raw"), str(tmp_path / "db"))
    units, readings = sink.read_tables(spark, str(tmp_path / "db"))
    stats = {r.condition_group: r.mean_temp for r in A.condition_temperature_stats(readings).collect()}
    want = {}
    for level, label in schema.LABELS_GROUP.items():
        temps = [round(sum(means[s][i] for s in schema.TEMPERATURE_SENSORS) / 4, 2)
                 for i in range(600) if cooler(i) == level]
        want[label] = round(sum(temps) / len(temps), 2)
    assert stats == pytest.approx(want, abs=0.011)
    assert stats["Failing (3%)"] - stats["Healthy (100%)"] == pytest.approx(20.0, abs=0.02)


def test_two_writers_publish_one_after_the_other(spark, tmp_path, monkeypatch):
    """Of two loads that began from one version the first to finish wins, the other fails and changes nothing."""
    from fleet_fixtures import frames, reading, unit

    def tables(k):
        r, u = frames(spark, [reading(i, 1, i, float(k)) for i in range(1, 4)], [unit(1)])
        return u, r

    root, real = str(tmp_path), sink._publish
    sink.write_tables(*tables(0), root)
    inner = []

    def second_load_first(spark_, root_, version, expected):
        if not inner:  # a whole other load finishes while this one is about to publish
            inner.append(version)
            assert sink.path_exists(spark_, f"{root_}/leases/{version}")
            sink.write_tables(*tables(2), root)
            assert sink.path_exists(spark_, f"{root_}/versions/{version}")  # leased: the other load left it
        return real(spark_, root_, version, expected)

    monkeypatch.setattr(sink, "_publish", second_load_first)
    with pytest.raises(sink.LoadError, match="another load"):
        sink.write_tables(*tables(1), root)
    assert {r.avg_temp_c for r in sink.read_tables(spark, root)[1].collect()} == {2.0}
    assert not sink.path_exists(spark, f"{root}/versions/{inner[0]}")
    # A claim whose holder died doesn't block the next load.
    expected = sink.current_version(spark, root)
    sink._put(spark, f"{root}/claims/{expected}", "dead")
    sink.write_tables(*tables(3), root)
    assert {r.avg_temp_c for r in sink.read_tables(spark, root)[1].collect()} == {3.0}


def test_reports_from_the_stored_state(spark, tmp_path):
    """All grouped reports read the state of a load and equal those of its readings; merged parts equal the whole."""
    import random

    from fleet_fixtures import frames, reading, unit
    from fleetpulse.operators import analytics as A
    from fleetpulse.operators import marts as D
    from fleetpulse.operators import state as U
    from fleetpulse.plans.runner import table_reports

    rnd = random.Random(5)
    rows = [reading(i, 1 + i % 5, 7 * i, None if i % 11 == 0 else 1e6 + rnd.gauss(0, 3), rnd.choice([100, 20, 3]),
                    motor_power_w=rnd.gauss(900, 50)) for i in range(600)]
    r, u = frames(spark, rows, [unit(k) for k in range(1, 6)])
    sink.write_tables(u, r, str(tmp_path), check=False)
    units, readings = sink.read_tables(spark, str(tmp_path))
    state = sink.read_state(spark, str(tmp_path))
    assert state.df.count() <= 5 * 24 * 3
    plain, read = table_reports(readings, units), table_reports(readings, units, state=state)
    for name in plain:
        assert [tuple(x) for x in read[name]().collect()] == [tuple(x) for x in plain[name]().collect()], name
        scanned = read[name]()._jdf.queryExecution().executedPlan().toString().count("FileScan parquet [reading_id")
        assert scanned == (1 if name in ("run_zscore_anomalies", "run_moving_average") else 0), name
    for mart in (D.fleet_kpis, D.region_units_counts, D.condition_value_counts, D.maintenance_ranking, D.urgent_units,
                 D.site_failure_details, D.hourly_pattern_halfeven):
        assert [tuple(x) for x in mart(state, units).collect()] == [tuple(x) for x in mart(readings, units).collect()]
    assert [tuple(x) for x in A.hourly_pattern(state).collect()] == [tuple(x) for x in A.hourly_pattern(readings).collect()]
    whole = {tuple(x)[:3]: x for x in U.unit_state(readings).collect()}
    parts = [U.unit_state(readings.filter(F.col("reading_id") % 3 == k)) for k in range(3)]
    for x in U.merge(*parts).collect():
        y = whole.pop(tuple(x)[:3])
        for c in U.unit_state(readings).columns:
            assert x[c] == y[c] if isinstance(y[c], (int, type(None))) else x[c] == pytest.approx(y[c], rel=1e-9, abs=1e-6), c
    assert not whole


def test_distinct_ids_at_any_id(spark):
    from fleetpulse.operators.quality import distinct_ids

    ids = [0, 0, 1, -1, -1, 32767, 32768, 2**40, 2**40, 2**62, -(2**62), None]
    df = spark.createDataFrame([(i,) for i in ids], "id long").repartition(3)
    assert tuple(distinct_ids(df, "id").first()) == (11, 8)
    assert tuple(distinct_ids(df.limit(0), "id").first()) == (0, 0)


def test_no_job_before_a_query_runs(spark):
    """Declared schemas: building a report on the given tables starts no Spark job."""
    import __spark_entry__ as entry
    from fleet_fixtures import SF_SMALL

    tracker = spark.sparkContext.statusTracker()
    for name in ("zscore_anomalies_all", "moving_average_unit", "box_summary_by_condition", "etl_readings", "dq_constraints"):
        group = f"build-{name}"
        spark.sparkContext.setJobGroup(group, name)
        entry.queries()[name](spark, SF_SMALL)
        assert list(tracker.getJobIdsForGroup(group)) == [], name
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
