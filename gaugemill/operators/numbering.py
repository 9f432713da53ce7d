"""Consecutive numbers over ordered rows without one task per group.

``row_number`` over a hot group (one station with a third of all lines) would sort
that group in a single task.  Here the order key is cut into blocks coarse to fine;
only rows of one finest block are sorted together, and the blocks' start offsets
are prefix sums over the much smaller block counts.  Results depend on the data
alone, so a recomputed task gives the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugemill.session import materialize

BLOCK_BITS = 20


def block_columns(order: Column, bits: Sequence[int] = (BLOCK_BITS, BLOCK_BITS)) -> list[Column]:
    """Blocks of a unique non-negative integer key, coarse to fine.

    A finest block holds at most ``2**bits[-1]`` keys and every coarser block at
    most ``2**bits[i]`` blocks of the next level, whatever the gaps in the keys.
    """
    levels = []
    shift = 0
    for width in reversed(bits):
        shift += width
        levels.append(F.shiftright(order, shift))
    return list(reversed(levels))


def _same_keys(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which a NULL key equals NULL; the keys appear once."""
    renamed = right.select(
        *[F.col(k).alias(f"_r{i}") for i, k in enumerate(keys)],
        *[c for c in right.columns if c not in keys],
    )
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r{i}")) for i, k in enumerate(keys)])
    return left.join(renamed, same).drop(*[f"_r{i}" for i in range(len(keys))])


def block_offsets(
    counts: DataFrame,
    groups: Sequence[str],
    levels: Sequence[str],
    count: str = "n",
    offset: str = "offset",
) -> DataFrame:
    """Rows of the group that come before each finest block, and the group's ``total``.

    ``counts`` has one row per (groups, levels).  Level ``i`` sums over the blocks
    that share its parent block, so no window spans more than one parent.
    """
    groups, levels = list(groups), list(levels)
    keys = groups + levels
    totals = counts.select(*keys, F.col(count).alias("_n"))
    per_level = [totals]
    for depth in range(len(levels) - 1, 0, -1):
        coarser = groups + levels[:depth]
        per_level.append(
            per_level[-1].groupBy(*coarser).agg(F.sum("_n").alias("_n"))
        )
    out = None
    for depth, part in enumerate(reversed(per_level)):
        parent = groups + levels[:depth]
        before = (
            Window.partitionBy(*parent)
            .orderBy(levels[depth])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        starts = part.select(
            *parent,
            levels[depth],
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias(f"_before{depth}"),
            *([F.sum("_n").over(Window.partitionBy(*parent)).alias("total")] if depth == 0 else []),
        )
        out = starts if out is None else _same_keys(starts, out, parent)
    total = reduce(lambda a, b: a + b, [F.col(f"_before{d}") for d in range(len(levels))])
    return out.select(*keys, total.cast("long").alias(offset), "total")


def number_rows(
    df: DataFrame,
    groups: Sequence[str],
    levels: dict[str, Column],
    order_by: Sequence[str | Column],
    out: str = "row_no",
    total: str | None = None,
) -> DataFrame:
    """1-based consecutive number of each row within its group.

    A NULL group or block key is a key like any other; it comes first.

    The rows are read twice (counts, then numbers): pass a stored relation.

    ``levels`` are order-preserving block keys, coarse to fine: a row with a smaller
    block comes first, rows of one finest block are ordered by ``order_by``.  ``total`` names a column for the group's row count.
    """
    keys = [*groups, *levels]
    blocked = df.withColumns(levels)
    # Small and read once per level, so it is staged.
    counts = materialize(blocked.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), "counts")
    offsets = block_offsets(counts, groups, list(levels), offset="_offset")
    local = Window.partitionBy(*keys).orderBy(*order_by)
    numbered = blocked.withColumn("_local", F.row_number().over(local))
    return (
        _same_keys(numbered, offsets, keys)
        .withColumn(out, F.col("_offset") + F.col("_local"))
        .select(*df.columns, out, *([F.col("total").alias(total)] if total else []))
    )
