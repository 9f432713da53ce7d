"""Block numbering against plain row numbers, and both join forms."""

import random

from pyspark.sql import Window, functions as F

from gaugemill.operators import batching, state
from gaugemill.operators.numbering import block_columns, number_rows


def test_numbers_equal_row_number_for_gaps_and_a_hot_group(spark):
    rng = random.Random(7)
    rows = [("hot", rng.randrange(1 << 62)) for _ in range(3000)]
    rows += [(f"s{i}", rng.randrange(1 << 20)) for i in range(50) for _ in range(5)]
    df = spark.createDataFrame(sorted(set(rows)), "g string, k long").repartition(7)
    hi, lo = block_columns(F.col("k"), (31, 25))
    got = number_rows(df, ["g"], {"hi": hi, "lo": lo}, ["k"], out="n", total="t")
    window = Window.partitionBy("g")
    want = df.select(
        "g", "k", F.row_number().over(window.orderBy("k")).cast("long").alias("n"),
        F.count("k").over(window).alias("t"),
    )
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_numbers_without_groups(spark):
    df = spark.range(1000).select((F.col("id") * 37).alias("k"))
    hi, lo = block_columns(F.col("k"), (6, 4))
    got = number_rows(df, [], {"hi": hi, "lo": lo}, ["k"], out="n").orderBy("k").collect()
    assert [r.n for r in got] == list(range(1, 1001))


def test_blocks_bound_the_rows_sorted_together(spark):
    df = spark.range(100_000).select(F.lit("s").alias("g"), F.col("id").alias("k"))
    lo = block_columns(F.col("k"), (10, 10))[-1]
    assert df.groupBy("g", lo.alias("b")).count().agg(F.max("count")).first()[0] <= 1 << 10


def test_count_windows_of_interleaved_stations(spark):
    rows = [("ab"[i % 3 == 0], i, None, "x:1" if i % 5 else "") for i in range(200)]
    lines = spark.createDataFrame(rows, "station string, line_no long, arrived_at timestamp, line string")
    got = {(r.station, r.line_no): r.batch_no for r in batching.count_windows(lines, 7).collect()}
    want = {}
    for station in "ab":
        kept = [i for s, i, _, line in rows if s == station and line]
        full = len(kept) // 7 * 7
        want.update({(station, n): i // 7 for i, n in enumerate(kept[:full])})
    assert got == want


def test_null_groups_and_levels_are_keys_like_any_other(spark):
    rows = [(None, None, 1), ("a", None, 2), ("a", 1, 3), (None, None, 4), (None, 2, 5)]
    df = spark.createDataFrame(rows, "g string, level int, n int")
    got = {r.n: r.row_no for r in number_rows(df, ["g"], {"_l": F.col("level")}, ["n"]).collect()}
    assert got == {1: 1, 4: 2, 5: 3, 2: 1, 3: 2}


def test_observation_ids_are_dense_and_follow_the_start(spark):
    rows = [(f"s{i % 9}", i // 9) for i in range(90)]
    df = spark.createDataFrame(rows, "station string, batch_no long")
    ids = sorted(r.id for r in state.observation_ids(df, start=500).collect())
    assert ids == list(range(501, 591))
