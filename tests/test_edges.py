
import pytest
from pyspark.sql import functions as F

from fleet_fixtures import frames, reading, unit
from fleetpulse.operators import analytics as A
from fleetpulse.operators import marts as D
from fleetpulse.operators import quality as Q
from fleetpulse.operators.windows import moving_mean, moving_mean_bounded


def series(uid, temps, start_id=0, cond=100):
    return [reading(start_id + i, uid, 15 * i, t, cond) for i, t in enumerate(temps)]


def test_v1_constant_unit_dropped_and_large_offset_stable(spark):
    noise = [0.1, 0.2, 0.3, 0.1, 0.2, 0.3, 0.25, 5.0]
    rows = series(1, [46.1] * 8) + series(2, [1e8 + x for x in noise], 100)
    r, u = frames(spark, rows, [unit(1), unit(2)])
    stats = {s.unit_id: s.sigma for s in A.unit_stats(r).collect()}
    assert 1 not in stats and stats[2] > 1.0
    z = A.zscore_anomalies(r, u).collect()
    assert [x.unit_code for x in z] == ["CLR-0002"]
    assert z[0].temp_c == pytest.approx(1e8 + 5.0)


def test_v3_units_sharing_model_and_site_stay_apart(spark):
    rows = series(1, [1.0, 2.0], 0, 3) + series(2, [3.0, 4.0], 10, 3)
    r, u = frames(spark, rows, [unit(1), unit(2)])
    ranked = A.rank_units(r, u).collect()
    assert [x.unit_code for x in ranked] == ["CLR-0001", "CLR-0002"]


def test_v4_v11_types(spark):
    r, u = frames(spark, series(1, [1.0, 2.0], 0, 3), [unit(1)])
    site = A.site_failure_summary(r, u)
    types = dict(site.dtypes)
    assert types["failure_pct"] == "double" and types["failure_readings"] == "bigint"
    assert dict(A.condition_breakdown(r).dtypes)["pct_of_total"] == "double"


def test_v5_unknown_and_null_conditions(spark):
    rows = series(1, [1.0], 0, 7) + series(1, [2.0], 10, None)
    r, _ = frames(spark, rows, [unit(1)])
    plain = A.condition_temperature_stats(r).collect()
    assert len(plain) == 2 and all(x.condition_group is None for x in plain)
    with_else = A.condition_temperature_stats(r, else_label="Failing").collect()
    assert [x.condition_group for x in with_else] == ["Failing", "Failing"]


def test_v6_rounding_rules(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (1.005,), (-0.5,), (2.5,)], "x double")
    from fleetpulse.functions import columns as C

    got = [tuple(r) for r in df.select(C.half_up_round("x", 2), C.even_round("x", 2),
                                       C.half_up_round("x", 0), C.even_round("x", 0)).collect()]
    assert got == [(0.13, 0.12, 0.0, 0.0), (2.68, 2.68, 3.0, 3.0), (1.01, 1.0, 1.0, 1.0),
                   (-0.5, -0.5, -1.0, -0.0), (2.5, 2.5, 3.0, 2.0)]


def test_v7_null_site_gives_null_location(spark):
    r, u = frames(spark, series(1, [1.0], 0, 3), [unit(1, site=None)])
    assert A.site_failure_summary(r, u).first().location is None


def test_v8_single_reading_unit_is_dropped_without_error(spark):
    rows = series(1, [5.0]) + series(2, [1.0] * 6 + [9.0], 10)
    r, u = frames(spark, rows, [unit(1), unit(2)])
    assert {x.unit_code for x in A.zscore_anomalies(r, u).collect()} == {"CLR-0002"}


def test_v12_null_condition_first_in_ascending_topk(spark):
    rows = series(1, [1.0], 0, None) + series(2, [1.0], 10, 3)
    r, u = frames(spark, rows, [unit(1), unit(2)])
    assert A.rank_units(r, u, k=1).first().unit_code == "CLR-0001"


def test_v13_filtered_moving_mean_equals_unfiltered(spark):
    rows = series(1, [1.0, 5.0, 9.0, 3.0, 7.0]) + series(2, [2.0, 4.0, 6.0], 10)
    r, u = frames(spark, rows, [unit(1), unit(2)])
    one = [x.temp_moving_avg for x in A.moving_average(r, u, "CLR-0001").collect()]
    everyone = [x.temp_moving_avg for x in sorted(A.moving_average(r, u).collect(),
                                                  key=lambda x: x.timestamp)
                if x.unit_code == "CLR-0001"]
    assert one == everyone == [1.0, 3.0, 5.0, 4.5, 6.0]


def test_v14_empty_inputs_do_not_raise(spark):
    r, u = frames(spark, [], [unit(1)])
    assert A.zscore_anomalies(r, u).count() == 0
    assert tuple(A.anomaly_kpis(r, u).first()) == (0, 0, 0)
    assert D.unit_kpis(r, u, "CLR-0001").first().total_readings == 0
    assert D.site_extremes(D.site_failure_details(r, u)).first().highest_location is None
    assert A.hourly_pattern(r).count() == 0


def test_v15_orphan_reading_reported_not_joined(spark):
    rows = series(1, [1.0, 2.0]) + series(9, [3.0], 10)
    r, u = frames(spark, rows, [unit(1)])
    assert A.fleet_overview_by_region(r, u).first().readings == 2
    checks = {x["check"]: x["violations"] for x in Q.check_constraints(u, r).collect()}
    assert checks["readings.unit_id references units"] == 1


def test_ties_are_ordered_by_id(spark):
    rows = [reading(5, 1, 0, 1.0), reading(3, 1, 0, 9.0), reading(4, 1, 15, 2.0)]
    r, u = frames(spark, rows, [unit(1)])
    got = [x.temp_c for x in D.unit_raw_readings(r, u, "CLR-0001").select(
        F.col("avg_temp_c").alias("temp_c")).collect()]
    assert got == [9.0, 1.0, 2.0]


def plain_mean(r, rows=4):
    return {x.reading_id: x.mv for x in moving_mean_bounded(r, "avg_temp_c", "mv", rows).collect()}


def test_moving_mean_in_buckets_equals_plain(spark, bucket_minutes):
    import random

    rnd = random.Random(7)
    rows = []
    for uid, n in [(1, 230), (2, 3), (3, 57)]:
        rows += series(uid, [rnd.uniform(0, 50) if rnd.random() < 0.9 else None for _ in range(n)], uid * 1000)
    rows += [reading(9000 + k, None, 15 * k, float(k)) for k in range(6)]  # a group of readings without a unit
    r, _ = frames(spark, rows, [unit(1), unit(2), unit(3)])
    for minutes in (10, 40, 300, 100_000):
        bucket_minutes(minutes)
        for n in (1, 2, 4, 9):
            found = {x.reading_id: x.mv for x in moving_mean(r, "avg_temp_c", "mv", n).collect()}
            assert found == plain_mean(r, n)


def test_quartiles_at_forced_small_buckets(spark, monkeypatch):
    import random

    from fleetpulse.operators import distribution

    rnd = random.Random(3)
    rows = [reading(i, 1, i, rnd.choice([float(rnd.randint(0, 40)), 10 ** rnd.uniform(-9, 9)]), rnd.choice([100, 20, 3, None]))
            for i in range(400)] + [reading(1000, 1, 5, float("nan"), 3), reading(1001, 1, 5, None, 3)]
    r, u = frames(spark, rows, [unit(1)])
    wide = sorted(map(tuple, D.box_summary_by_condition(r, u).collect()), key=str)
    for accuracy in (8, 25, 90):
        monkeypatch.setattr(distribution, "ACCURACY", accuracy)
        assert sorted(map(tuple, D.box_summary_by_condition(r, u).collect()), key=str) == wide
    assert len(wide) == 8


def test_heavy_tails_keep_few_rows_and_stay_exact(spark):
    """Values on three scales: brackets are cut by rank, so the outliers don't fill them."""
    import numpy as np

    from fleetpulse.operators import distribution

    n = 200_000
    value = F.when(F.col("id") == 0, F.lit(1e15)).when(F.col("id") == 1, F.lit(1e8)).otherwise(F.rand(5) * 100)
    df = spark.range(n, numPartitions=8).select(F.lit("g").alias("label"), value.alias("v"))
    long = distribution.stack_metrics(df, "label", ["v"])
    kept = distribution._counted(long, distribution._brackets(long)).filter(F.col("kept").isNotNull())
    assert 6 <= kept.count() <= 6 / distribution.ACCURACY * n * len(distribution.QUARTILES)
    got = distribution.quartiles(long).first()
    v = np.array([r.v for r in df.select("v").collect()])
    assert [got.q1, got.median, got.q3] == pytest.approx(np.percentile(v, [25, 50, 75]).tolist(), rel=1e-12)
    assert got.n == n and got.max == 1e15


# ------------------------------------------------------------------- properties
def test_condition_counts_sum_to_total(spark):
    rows = [reading(i, 1 + i % 3, i, float(i % 17), [100, 20, 3][i % 3]) for i in range(90)]
    r, u = frames(spark, rows, [unit(1), unit(2), unit(3)])
    b = A.condition_breakdown(r).collect()
    assert sum(x.reading_count for x in b) == 90
    assert sum(x.pct_of_total for x in b) == pytest.approx(100.0, abs=0.15)


def test_zscore_flags_nested_and_affine_invariant(spark):
    import random

    rnd = random.Random(11)
    rows = [reading(i, 1 + i % 4, i, rnd.gauss(20, 5), 100) for i in range(400)]
    r, u = frames(spark, rows, [unit(k) for k in range(1, 5)])
    at2 = {(x.unit_code, x.timestamp) for x in A.zscore_anomalies(r, u, k_sigma=2.0).collect()}
    at3 = {(x.unit_code, x.timestamp) for x in A.zscore_anomalies(r, u, k_sigma=3.0).collect()}
    assert at3 <= at2 and at2
    shifted = r.withColumn("avg_temp_c", F.col("avg_temp_c") * 3 + 7)
    again = {(x.unit_code, x.timestamp) for x in A.zscore_anomalies(shifted, u).collect()}
    assert again == at2


def test_moving_mean_within_frame_bounds(spark):
    rows = series(1, [3.0, 8.0, 1.0, 4.0, 6.0, 2.0])
    r, u = frames(spark, rows, [unit(1)])
    out = sorted(A.moving_average(r, u, round_to=None).collect(), key=lambda x: x.timestamp)
    temps = [x.temp_c for x in out]
    for i, x in enumerate(out):
        frame = temps[max(0, i - 3): i + 1]
        assert min(frame) <= x.temp_moving_avg <= max(frame)


def test_v9_text_timestamps_strict_and_tolerant(spark):
    import datetime as dt

    from fleetpulse.functions import columns as C

    df = spark.createDataFrame([("2024-01-01 03:15:00",), ("bad",)], "t string")
    tolerant = [r[0] for r in df.select(C.parse_timestamp("t", strict=False)).collect()]
    assert tolerant == [dt.datetime(2024, 1, 1, 3, 15), None]
    with pytest.raises(Exception):
        df.select(C.parse_timestamp("t", strict=True)).collect()
    good = df.filter(F.col("t") != "bad").select(C.parse_timestamp("t").alias("ts"))
    assert good.select(C.timestamp_text("ts")).first()[0] == "2024-01-01 03:15:00"
    assert good.select(C.hour_of_day("ts")).first()[0] == 3


def test_batch_runner_and_sql_views(spark, tmp_path):
    from fleetpulse.plans.runner import load_query, register_views, run_batch

    rows = series(1, [1.0, 2.0], 0, 3) + series(2, [3.0], 10, 100)
    r, u = frames(spark, rows, [unit(1), unit(2, region="Dunedin")])
    spark.range(1).createOrReplaceTempView("readings")  # a view of the user's
    register_views(spark, r, u, prefix="fleet_")
    enriched = load_query(spark, "SELECT unit_code, region, avg_temp_c FROM fleet_readings_enriched")
    assert sorted(map(tuple, enriched.collect())) == [
        ("CLR-0001", "Auckland", 1.0), ("CLR-0001", "Auckland", 2.0), ("CLR-0002", "Dunedin", 3.0)]
    assert load_query(spark, "SELECT count(1) FROM {readings} WHERE unit_id = :u", {"u": 1}, readings=r).first()[0] == 2
    assert spark.table("readings").columns == ["id"]
    many = spark.range(1500).withColumnRenamed("id", "n")
    counts = run_batch({"regions": lambda: A.fleet_overview_by_region(r, u), "nothing": lambda: r.filter(F.lit(False)),
                        "many": lambda: many}, str(tmp_path))
    assert counts == {"regions": 2, "nothing": 0, "many": 1500}
    assert spark.read.parquet(f"{tmp_path}/many").distinct().count() == 1500


def test_replaced_tables_give_new_answers(spark, tmp_path):
    """Nothing about a table is remembered between queries."""
    from fleetpulse.operators.transform import assign_blocks

    def ask():
        r, u = (spark.read.parquet(f"{tmp_path}/{n}.parquet") for n in ("readings", "units"))
        cycles = spark.read.parquet(f"{tmp_path}/cycles.parquet")
        blocks = assign_blocks(cycles, cycles.select(F.count(F.lit(1))).scalar(), 2)
        return ([x.temp_c for x in A.moving_average(r, u, "CLR-0001", top=5).collect()],
                [x.avg_temp_c for x in D.unit_raw_readings(r, u, "CLR-0001").collect()],
                D.unit_kpis(r, u, "CLR-0001").first().total_readings, D.unit_drilldown_series(r, u, "CLR-0001").count(),
                blocks.count())

    def put(units, n):
        r, u = frames(spark, series(1, [1.0, 1.0], 0) + series(2, [7.0], 10), units)
        for name, df in (("readings", r), ("units", u), ("cycles", spark.range(n).withColumnRenamed("id", "cycle_id"))):
            df.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")

    put([unit(1)], 5)
    assert ask() == ([1.0, 1.0], [1.0, 1.0], 2, 2, 4)
    put([unit(2) | {"unit_code": "CLR-0001"}], 9)
    assert ask() == ([7.0], [7.0], 1, 1, 8)


def test_nan_readings_are_no_readings(spark):
    rows = series(1, [10.0, 11.0, 9.0, 10.0, 11.0, 9.0, 10.0, 40.0], 0) + [reading(99, 1, 500, float("nan"))]
    r, u = frames(spark, rows, [unit(1)])
    assert [x.temp_c for x in A.zscore_anomalies(r, u).collect()] == [40.0]
    assert A.anomaly_kpis(r, u).first().anomalous_readings == 1
    from fleetpulse.functions.columns import without_nan

    assert A.fleet_overview_by_region(without_nan(r), u).first().avg_temp == 13.8


def test_salted_statistics_join(spark, no_broadcast):
    import random

    rnd = random.Random(11)
    rows = [reading(i, 1 if i % 3 else 1 + i % 40, i, rnd.gauss(20, 3)) for i in range(900)]
    r, u = frames(spark, rows, [unit(k) for k in range(1, 41)])
    salted = sorted(map(tuple, A.zscore_anomalies(r, u).collect()), key=str)
    assert "_salt" in A.zscore_anomalies(r, u)._jdf.queryExecution().toString()
    spark.conf.unset("fleetpulse.broadcast.maxBytes")
    import numpy as np

    want = 0
    for k in range(1, 41):
        v = np.array([x["avg_temp_c"] for x in rows if x["unit_id"] == k])
        want += int((abs(v - v.mean()) > 2 * v.std()).sum()) if len(v) and v.std() > 0 else 0
    assert len(salted) == want > 10


def test_joins_split_a_hot_unit(spark, no_broadcast):
    """One unit has a third of the rows: no task gets more than twice the median, and no other unit is repeated."""
    from fleetpulse.operators import joins

    n, units_n = 60_000, 20_000
    unit_id = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % units_n)
    fact = spark.range(n, numPartitions=8).select(F.col("id").alias("reading_id"), unit_id.alias("unit_id"))
    units = spark.range(units_n).select(F.col("id").alias("unit_id"), F.lit("c").alias("unit_code"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for joined in (joins.attach_units_splitting(fact, units, ("unit_code",)), joins.restrict_to_units_splitting(fact, units)):
            sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect())
            assert sum(sizes) == n and len(sizes) == 16 and sizes[-1] <= 2 * sizes[8]
            assert joined.select("reading_id").distinct().count() == n
        plain = fact.join(units, "unit_id").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in plain) > 5 * n / 16
    finally:
        for key, value in (("spark.sql.adaptive.enabled", "true"), ("spark.sql.shuffle.partitions", "8")):
            spark.conf.set(key, value)
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("seed", [1, 2])
def test_box_summary_against_numpy(spark, seed):
    import random

    import numpy as np

    rnd = random.Random(seed)
    rows = [reading(i, 1, i, float(rnd.choice([rnd.randint(0, 9), rnd.uniform(-50, 50)])),
                    rnd.choice([100, 20, 3]), motor_power_w=rnd.gauss(500, 80))
            for i in range(700)]
    r, u = frames(spark, rows, [unit(1)])
    labels = {100: "Healthy", 20: "Reduced", 3: "Failing"}
    for bound in (None,):
        got = {(x.condition_label, x.metric): x for x in D.box_summary_by_condition(r, u).collect()}
        for cond, label in labels.items():
            for metric in ("avg_temp_c", "motor_power_w"):
                v = np.array([x[metric] for x in rows if x["cooler_condition"] == cond])
                q1, med, q3 = np.percentile(v, [25, 50, 75])
                iqr = q3 - q1
                out = ((v < q1 - 1.5 * iqr) | (v > q3 + 1.5 * iqr)).sum()
                g = got[(label, metric)]
                assert g.n == len(v) and g.outliers == out
                for name, want in [("min", v.min()), ("q1", q1), ("median", med), ("q3", q3),
                                   ("max", v.max())]:
                    assert getattr(g, name) == pytest.approx(want, abs=1e-6), (bound, name)


def test_rounding_of_huge_values(spark):
    from fleetpulse.functions.columns import half_up_round

    row = spark.createDataFrame([(1e18, -2.5e30)], "a double, b double").select(
        half_up_round("a", 2).alias("a"), half_up_round("b", 0).alias("b")).first()
    assert tuple(row) == (1e18, -2.5e30)
