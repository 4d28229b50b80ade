"""Physical-plan checks: broadcast joins, pushdown, no Python in the plans."""

import pytest

import __spark_entry__ as entry
from fleet_fixtures import SF_SMALL
from fleetpulse.plans.catalog import all_queries


def plan(spark, name):
    df = entry.queries()[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_has_no_sort_merge_join(spark):
    p = plan(spark, "zscore_anomalies_all")
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_udf_in_plan(spark, name):
    p = plan(spark, name)
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "PythonUDF" not in p


def test_key_filter_reaches_parquet_scan(spark):
    p = plan(spark, "unit_profile")
    assert "PushedFilters: [IsNotNull(s_name), EqualTo(s_name,Supplier#000000000)" in p


def test_column_pruning_on_lineitem(spark):
    df = entry.queries()["condition_power_profile"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_extendedprice:double,l_discount:double,l_tax:double," \
           "l_returnflag:string>" in p


def test_topk_before_window_for_single_unit(spark):
    p = plan(spark, "moving_average_unit")
    assert "TakeOrderedAndProject" in p
    assert p.index("Window") < p.index("TakeOrderedAndProject")  # window above the top-k


def test_unit_drilldown_moves_only_its_unit(spark):
    p = plan(spark, "unit_drilldown_series")
    assert "LeftSemi" in p and "BroadcastHashJoin" in p
    assert p.index("Window") < p.index("LeftSemi")  # the semi-join is below the window


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]


def test_moving_average_scans_and_shuffles_the_fact_once(spark):
    p = final_plan(entry.queries()["moving_average_all_units"](spark, SF_SMALL))
    assert p.count("FileScan parquet [event_id") == 1 and "ReusedExchange" in p


def scan_line(p, column):
    return next(line for line in p.splitlines() if "FileScan parquet" in line and column in line)


def test_drilldown_bounds_are_filters_of_the_scan(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    try:
        for name in ("unit_drilldown_series", "unit_kpis", "unit_raw_readings", "moving_average_unit"):
            scan = scan_line(plan(spark, name), "user_id")
            bounds = scan[scan.index("DataFilters:"):scan.index("Format:")]
            assert ">= Subquery" in bounds and "<= Subquery" in bounds, scan
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")


def rows_read(df):
    """Rows that the scans of ``df``'s table handed on, by the first column's name."""
    df.collect()
    found, todo = {}, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if name == "FileSourceScanExec":
                found[node.output().head().name()] = node.metrics().apply("numOutputRows").value()
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return found


def test_drilldown_on_written_tables_reads_few_row_groups(spark, tmp_path):
    import datetime as dt

    from pyspark.sql import functions as F

    from fleet_fixtures import frames, unit
    from fleetpulse import schema
    from fleetpulse.operators import marts as D
    from fleetpulse.operators import sink

    units_n, per_unit = 200, 300
    _, units = frames(spark, [], [unit(k) for k in range(1, units_n + 1)])
    made = {"reading_id": F.col("id"), "unit_id": (F.col("id") % units_n + 1).cast("int"),
            "timestamp": (F.lit(dt.datetime(2024, 1, 1)) + F.make_dt_interval(secs=F.col("id") / 1.0)).cast("timestamp_ntz"),
            "cooler_condition": F.lit(100)}
    typed = {f.name: f.dataType for f in schema.READINGS_SCHEMA.fields}
    readings = spark.range(units_n * per_unit).select(*[
        made.get(c, F.rand(3) * 100).cast(typed[c]).alias(c) for c in schema.READING_COLUMNS])
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("parquet.block.size", "65536")
    conf.set("parquet.page.size", "4096")
    try:
        sink.write_tables(units, readings, str(tmp_path), num_partitions=1, check=False)
    finally:
        conf.unset("parquet.block.size")
        conf.unset("parquet.page.size")
    written_units, written = sink.read_tables(spark, str(tmp_path))
    one = D.unit_raw_readings(written, written_units, "CLR-0077")
    assert one.count() == per_unit
    assert per_unit <= rows_read(one)["reading_id"] <= units_n * per_unit / 4


def test_sql_texts_have_no_window_over_the_fact(spark):
    p = plan(spark, "sql_zscore_anomalies")
    assert "Window" not in p
    assert "l_returnflag" in scan_line(plan(spark, "sql_multi_fault"), "l_tax").split("DataFilters:")[1]
