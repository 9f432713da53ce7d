"""The row that stays of every group of copies, where ids clash, repeat or are missing."""

import random

from pyspark.sql import functions as F

from gaugemill.llm import copy_groups

COLUMNS = "doc_id long, text string, _key string, fp int"


def test_first_of_each_group(spark):
    rng = random.Random(3)
    one, two, three = (" ".join(f"w{rng.randrange(10**6)}" for _ in range(80)) for _ in range(3))
    near = one.replace(one.split()[40], "edited")
    rows = [
        (1, one, "x", 1), (1, two, "x", 2),            # one id, different texts: both stay
        (5, near, "x", 3), (None, one, "x", 4),        # copies of the first, one without an id
        (None, three, "x", 5), (None, three, "x", 5),  # a group without any id: one row stays
        (7, "of its own", "x", 6), (7, "of its own", "x", 6),
        (8, None, "x", 7), (9, "", "x", 8), (None, " ", "x", 9),
    ]
    df = spark.createDataFrame(rows, COLUMNS).repartition(4)
    got = sorted(((r.doc_id, r.text) for r in copy_groups.first_of_each(df).collect()), key=str)
    assert got == sorted([(1, one), (1, two), (None, three), (7, "of its own"), (8, None)], key=str)
    assert copy_groups.first_of_each(df).columns == df.columns
    assert copy_groups.first_of_each(df.limit(0)).collect() == []
    ids = copy_groups.copy_groups(df.filter(F.col("doc_id").isNotNull())).collect()
    assert {(r.doc_id, r.component_id) for r in ids} >= {(5, 1), (9, 8), (7, 7)}
