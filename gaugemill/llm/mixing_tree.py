"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

1. *Targets.*  Sources in code-point order (null last) weigh 5, 2, 1, repeating, and
   share the size of all documents; a target stops at MAX_COPIES times its source's
   size, and what is left over is shared out again by weight.
2. *Blocks.*  A source's documents are dealt by hash into blocks of about BLOCK_ROWS.  A
   target of r times the source takes every block floor(r) times, and for the rest a
   number of whole blocks in permuted order; documents of the next block fill the
   remaining gap, and one more is taken if that comes nearer to the target.
3. *Tree.*  The units to be drawn (a block, once for each time it is taken) are an urn
   with one colour per source.  The root holds each source's exact quota; every node
   draws half of its units for its left child, a multivariate-hypergeometric vector, and
   the rest goes right.  The leaves are the output shards: their quotas add up exactly.
4. *Draw.*  Each source's permuted units are cut at its quotas: disjoint runs, one per
   shard.  Within a shard rows are shuffled locally, by hash.

Only the catalogue of sources and the tree's counts, one row per source, reach the
driver.  Everything over documents is built-in column functions and joins by block; no
text is compared or moved to decide.  All draws are hashes or seeded, so reruns agree.

Defined results: a null text has size 0; a null source is a source of its own, last;
rows that repeat (doc_id, text) share one fate; sources of size 0 have target 0; an empty
table gives no rows.  The catalogue may hold MAX_SOURCES sources, else a ValueError.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugemill.llm.common import materialize

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
BLOCK_ROWS = 256
MAX_BLOCKS = 1 << 16
MAX_SOURCES = 200_000
# Rows of a decision table that are broadcast; each holds a few numbers and a source name.
BROADCAST_ROWS = 200_000
FILL_ROUNDS = 3


def n_words(text: Column) -> Column:
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), r"[ \t-\r]+")
    return F.size(F.array_remove(parts, "")).cast("long")


def _source_key(source: Column) -> Column:
    """Never null; sorts as sources by code point, null last."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit("~"))


def _row_key() -> Column:
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def water_fill(sizes: list[int], weights: tuple[int, ...] = WEIGHTS,
               max_copies: int = MAX_COPIES) -> list[float]:
    """Shares of the total by weight; a share above its cap is cut and the excess reshared."""
    total = sum(sizes)
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    open_ = list(range(len(sizes)))
    target = [0.0] * len(sizes)
    left = float(total)
    while open_:
        whole = sum(weight[i] for i in open_)
        over = [i for i in open_ if weight[i] * left / whole > max_copies * sizes[i]]
        if not over:
            for i in open_:
                target[i] = weight[i] * left / whole
            break
        for i in over:
            target[i] = float(max_copies * sizes[i])
        left -= sum(target[i] for i in over)
        gone = set(over)
        open_ = [i for i in open_ if i not in gone]
    return target


def split_quotas(units: list[int], shards: int, seed: int) -> list[list[int]]:
    """Units of each source per shard: the leaves of the splitting tree."""
    out = np.zeros((shards, len(units)), np.int64)
    pending = [(0, shards, np.array(units, np.int64))]
    while pending:
        first, n, held = pending.pop()
        if n == 1:
            out[first] = held
            continue
        left = n // 2
        draw = np.random.default_rng([seed, first, n])
        taken = draw.multivariate_hypergeometric(
            held, int(held.sum()) * left // n, method="marginals"
        ) if len(held) else held
        pending.append((first, left, taken))
        pending.append((first + left, n - left, held - taken))
    return out.T.tolist()


@dataclass
class Plan:
    """What is taken: ``catalogue`` per source, ``blocks`` per (source, block), ``rows`` of partly taken blocks."""

    catalogue: DataFrame
    blocks: DataFrame
    rows: DataFrame
    few_blocks: bool
    few_rows: bool


def _local(spark, rows: list[dict], schema: str) -> DataFrame:
    """A small table as one literal, so that no Python data source is involved."""
    text = F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")
    return spark.range(1).select(F.inline(text))


def plan(sized: DataFrame, shards: int = 8, seed: int = 0, weights: tuple[int, ...] = WEIGHTS) -> Plan:
    """Decide over ``sized`` (src, size, key), a stored table."""
    spark = sized.sparkSession
    totals = sized.groupBy("src").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("rows"))
    found = totals.limit(MAX_SOURCES + 1).collect()
    if len(found) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: not a catalogue to mix by")
    found.sort(key=lambda r: r["src"].encode())
    targets = water_fill([r["size"] for r in found], weights)
    rows = []
    for r, target in zip(found, targets):
        full = min(MAX_COPIES, int(target // r["size"])) if r["size"] else 0
        rows.append({
            "src": r["src"], "source_size": r["size"], "target": target, "full": full,
            "rest": max(0.0, target - full * r["size"]),
            "n_blocks": max(1, min(MAX_BLOCKS, -(-r["rows"] // BLOCK_ROWS))),
        })
    catalogue = F.broadcast(_local(
        spark, rows,
        "src: string, source_size: bigint, target: double, full: int, rest: double, n_blocks: int",
    ))

    placed = sized.join(catalogue, "src").withColumn("block", _block(F.col("key")))
    sums = placed.groupBy("src", "block").agg(
        F.sum("size").alias("words"), F.first("full").alias("full"), F.first("rest").alias("rest")
    )
    permuted = Window.partitionBy("src").orderBy(F.xxhash64("src", "block", F.lit(seed)), "block")
    running = permuted.rowsBetween(Window.unboundedPreceding, 0)
    drawn = materialize(
        sums.withColumn("through", F.sum("words").over(running)).select(
            "src", "block", "full", "rest",
            (F.col("through") <= F.col("rest")).alias("whole"),
            ((F.col("through") > F.col("rest")) & (F.col("through") - F.col("words") < F.col("rest"))).alias("partly"),
            (F.col("rest") - (F.col("through") - F.col("words"))).alias("gap"),
        ),
        "blocks",
    )
    taken = materialize(_fill(placed, drawn, seed), "rows")

    units = _units(drawn)
    order = Window.partitionBy("src").orderBy(F.xxhash64("src", "block", "copy", F.lit(seed + 1)), "block", "copy")
    counts = {r["src"]: r["n"] for r in units.groupBy("src").agg(F.count(F.lit(1)).alias("n")).collect()}
    quotas = split_quotas([counts.get(r["src"], 0) for r in rows], shards, seed)
    ends = _local(
        spark,
        [{"src": r["src"], "ends": np.cumsum(q).tolist()} for r, q in zip(rows, quotas)],
        "src: string, ends: array<bigint>",
    )
    blocks = (
        units.withColumn("rank", F.row_number().over(order))
        .join(F.broadcast(ends), "src")
        .withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("rank"))))
        .groupBy("src", "block")
        .agg(
            F.array_sort(F.collect_list(F.when(~F.col("part"), F.col("shard")))).alias("shards"),
            F.max(F.when(F.col("part"), F.col("shard"))).alias("part_shard"),
        )
    )
    n_blocks = sum(r["n_blocks"] for r in rows)
    return Plan(catalogue, materialize(blocks, "units"), taken,
                n_blocks <= BROADCAST_ROWS, taken.count() <= BROADCAST_ROWS)


def _block(key: Column) -> Column:
    return F.pmod(key, F.col("n_blocks").cast("long")).cast("int")


def _units(drawn: DataFrame) -> DataFrame:
    """One row for each time a block is drawn; ``part`` marks a block taken in part."""
    more = F.when(F.col("whole") | F.col("partly"), 1).otherwise(0)
    copies = F.when(
        F.col("full") + more > 0, F.sequence(F.lit(1), F.greatest(F.col("full") + more, F.lit(1)))
    ).otherwise(F.array().cast("array<int>"))
    each = drawn.select("src", "block", "full", "partly", F.explode(copies).alias("copy"))
    return each.select("src", "block", "copy", (F.col("partly") & (F.col("copy") > F.col("full"))).alias("part"))


def _fill(placed: DataFrame, drawn: DataFrame, seed: int) -> DataFrame:
    """Rows (src, key) that fill each source's gap from its partly taken block.

    The first round goes in permuted order; the next ones fit what is left, largest
    first.  Each round takes a running sum's prefix, so a source's rows are sorted, never
    looped over.
    """
    partly = drawn.filter("partly").select("src", "block", "gap")
    left = (
        placed.join(F.broadcast(partly), ["src", "block"])
        .groupBy("src", "key").agg(F.sum("size").alias("words"), F.first("gap").alias("gap"))
        .filter("words > 0").withColumn("taken", F.lit(False))
    )
    source = Window.partitionBy("src")
    for turn in range(FILL_ROUNDS):
        shuffled = [F.xxhash64("key", F.lit(seed + 2)), F.col("key")]
        order = shuffled if turn == 0 else [F.col("words").desc(), *shuffled]
        fits = ~F.col("taken") & (F.col("words") <= F.col("gap"))
        words = F.when(fits, F.col("words")).otherwise(0)
        running = source.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        left = left.withColumn("sum", F.sum(words).over(running)).withColumn(
            "now", fits & (F.col("sum") <= F.col("gap"))
        )
        spent = F.coalesce(F.sum(F.when(F.col("now"), F.col("words"))).over(source), F.lit(0))
        left = left.withColumn("gap", F.col("gap") - spent).withColumn(
            "taken", F.col("taken") | F.col("now")
        ).drop("sum", "now")
    more = ~F.col("taken") & (F.col("words") < 2 * F.col("gap"))
    nearest = [F.abs(F.col("words") - F.col("gap")), F.col("words"), F.col("key")]
    closest = F.row_number().over(Window.partitionBy("src", more).orderBy(*nearest))
    left = left.withColumn("taken", F.col("taken") | (more & (closest == 1)))
    return left.filter("taken").select("src", "key")


def _attach(rows: DataFrame, decided: Plan) -> DataFrame:
    """Add the catalogue's columns and ``shards``, one entry for each copy taken."""
    small = lambda df, few: F.broadcast(df) if few else df
    placed = rows.join(decided.catalogue, "src").withColumn("block", _block(F.col("key")))
    placed = placed.join(small(decided.blocks, decided.few_blocks), ["src", "block"], "left")
    chosen = decided.rows.withColumn("chosen", F.lit(True))
    placed = placed.join(small(chosen, decided.few_rows), ["src", "key"], "left")
    part = F.when(F.col("chosen"), F.array("part_shard")).otherwise(F.array().cast("array<int>"))
    none = F.array().cast("array<int>")
    return placed.withColumn("copies", F.concat(F.coalesce("shards", none), part))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "source"
    ).select("doc_id", _source_key(F.col("source")).alias("src"), n_words(F.col("text")).alias("size"),
             _row_key().alias("key"))


def mix_plan(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """Per row of ``docs``: doc_id, size, source_size, target, taken, and ``copies``, its output shards."""
    sized = materialize(_sized(docs), "sizes")
    out = _attach(sized, plan(sized, shards, seed))
    return out.select(
        "doc_id", "size", "source_size", "target",
        (F.size("copies") * F.col("size")).alias("taken"), "copies",
    )


def mixed(docs: DataFrame, shards: int = 8, seed: int = 0, shard_column: str | None = None) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, shuffled within each output shard."""
    sized = materialize(_sized(docs), "sizes")
    decided = plan(sized, shards, seed)
    slot = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc")
    rows = docs.select(
        slot,
        _source_key(F.col("source")).alias("src"),
        F.xxhash64(F.col("doc_id").cast("long"), F.col("text").cast("string")).alias("key"),
    )
    copies = _attach(rows, decided).select("_doc", "key", F.posexplode("copies").alias("copy", "shard"))
    order = F.xxhash64("key", "copy", F.lit(seed + 3))
    parts = F.pmod(order, F.lit(64))
    dealt = copies.repartition(F.col("shard"), parts).sortWithinPartitions("shard", order)
    more = [F.col("shard").alias(shard_column)] if shard_column else []
    return dealt.select("_doc.*", *more)
