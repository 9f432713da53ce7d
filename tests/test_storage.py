"""Layout of stored tables."""

import glob
from datetime import datetime

from pyspark.sql import functions as F

from conftest import plan_of
from gaugemill.operators import state
from gaugemill.session import materialize, scratch_path
from gaugemill.sources import observations


def raw(spark, days, rows=300):
    start = F.lit("2024-01-01 00:00:00").cast("timestamp")
    return spark.range(rows).repartition(6).select(
        "id",
        (start + F.make_dt_interval(days=(F.col("id") % days).cast("int"))).alias("observe_date"),
        F.lit("{}").alias("sensor_values"),
    )


def test_a_task_does_not_open_a_file_for_every_day(spark):
    path = scratch_path(spark, "layout")
    observations.append_raw(raw(spark, 5), path)
    assert len(glob.glob(f"{path}/obs_day=*/*.parquet")) == 5


def test_overwriting_a_day_leaves_the_others(spark):
    path = scratch_path(spark, "layout")
    observations.append_raw(raw(spark, 3), path)
    stored = observations.scan_raw(spark, path)
    day = stored.filter("obs_day = date'2024-01-02'").drop("obs_day")
    observations.overwrite_days(materialize(day.limit(1)), path)
    after = observations.scan_raw(spark, path)
    counts = {str(r[0]): r[1] for r in after.groupBy("obs_day").count().collect()}
    assert counts == {"2024-01-01": 100, "2024-01-02": 1, "2024-01-03": 100}


def test_touched_days_prune_the_scan(spark):
    path = scratch_path(spark, "layout")
    observations.append_raw(raw(spark, 3), path)
    stored = observations.scan_raw(spark, path)
    days = state.touched_days(
        observations.scan_raw(spark, path, before=datetime(2024, 1, 2)), datetime(2024, 1, 2)
    )
    affected = stored.join(F.broadcast(days), "obs_day", "left_semi")
    assert "dynamicpruning" in plan_of(affected)
    assert affected.count() == 100


def test_scan_of_one_day_reads_one_folder(spark):
    path = scratch_path(spark, "layout")
    observations.append_raw(raw(spark, 3), path)
    df = observations.scan_raw(
        spark, path, columns=["id"], since=datetime(2024, 1, 2), before=datetime(2024, 1, 2, 12)
    )
    assert df.count() == 100
    assert "GreaterThanOrEqual(observe_date" in plan_of(df)
