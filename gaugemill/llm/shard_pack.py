"""Sharding by vector bin packing: bytes, tokens and rows balanced jointly.

Rows with equal texts form a group and stay together, unless the group alone holds more
than half a shard of the bytes, tokens or rows: then it is split by row hash into PIECES
units per shard's worth.  A group's vector is its bytes, tokens and rows, as shares of
the corpus.  Packing goes over units:

* a group of more than 1 / (shards x GRAIN) of the bytes, tokens or rows is a unit of its
  own.  By this definition there are at most 3 x shards x GRAIN such groups;
* all other groups are bundled by hash into shards x BUNDLES units.

So the number of units has a fixed bound, whatever the corpus, and only unit vectors
reach the driver.  Units go largest first, each into the shard whose residual capacity
has the highest dot product with the unit's vector, among the shards that have room for
it in every dimension (or, if none has, among those with the most room left).

The law that holds is ``bytes``: shard sizes are near equal.  Rows and tokens come close
too, as the vectors hold them.

Slots number a shard's rows without gaps: rows are dealt into parts by hash, the parts'
counts give offsets, and only a part is sorted in one task.

Defined results: a null text has no bytes, so its size is 1, and is a group apart from
the empty text; repeated rows each get a slot of their own; rows with a null ``doc_id``
are packed like others; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window, functions as F

from gaugemill.llm.common import materialize
from gaugemill.llm.mixing_tree import n_words

GRAIN = 128
BUNDLES = 256
PIECES = 16
PART_ROWS = 100_000
LAW = "bytes"


def vectors(docs: DataFrame) -> DataFrame:
    """(doc_id, size, tokens, text_crc32, text_hash): all that packing needs of a row."""
    text = F.col("text").cast("string")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1).alias("size"),
        n_words(text).alias("tokens"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(text, text.isNull()).alias("text_hash"),
    )


def pack(units: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every unit; ``units`` has a row of (bytes, tokens, rows) each."""
    total = np.maximum(units.sum(axis=0), 1).astype(float)
    share = units / total
    left = np.full((shards, units.shape[1]), 1.0 / shards)
    out = np.zeros(len(units), int)
    # Bytes lead, as they are what has to come out even.
    order = np.lexsort((-share[:, 0], -share.max(axis=1)))
    order = order[np.argsort(-share[order, 0], kind="stable")]
    for u in order.tolist():
        room = (left - share[u]).min(axis=1)
        fits = room >= 0
        score = left @ share[u]
        if fits.any():
            s = int(np.argmax(np.where(fits, score, -np.inf)))
        else:
            s = int(np.argmax(left[:, 0]))
        out[u] = s
        left[s] -= share[u]
    return out


def _units(rows: DataFrame, shards: int) -> DataFrame:
    """Rows with ``unit``, a text that names the unit they belong to."""
    totals = rows.agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    ).first()
    parts = shards * GRAIN
    limit = {k: max(1.0, (totals[k] or 0) / parts) for k in ("size", "tokens", "rows")}
    group = ["text_hash", "text_crc32"]
    large = (
        rows.groupBy(*group)
        .agg(F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
        .select(*group, F.greatest(*[F.col(k) / F.lit(v) for k, v in limit.items()]).alias("times"))
        .filter("times > 1")
        .select(*group, F.when(
            F.col("times") > GRAIN / 2, F.ceil(F.col("times") * PIECES / GRAIN)
        ).otherwise(1).cast("int").alias("pieces"))
    )
    # At most 3 * shards * GRAIN rows of three numbers.
    placed = rows.join(F.broadcast(materialize(large, "large")), group, "left")
    piece = F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(1)), F.col("pieces"))
    bundle = F.pmod(F.col("text_hash"), F.lit(shards * BUNDLES))
    return placed.withColumn(
        "unit",
        F.when(F.col("pieces").isNull(), F.concat(F.lit("b"), bundle)).otherwise(
            F.concat_ws(":", F.lit("g"), "text_hash", "text_crc32", piece)
        ),
    ).drop("pieces")


def placed(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard per row of ``docs``."""
    spark = docs.sparkSession
    rows = materialize(_units(materialize(vectors(docs), "vectors"), shards), "units")
    units = rows.groupBy("unit").agg(
        F.sum("size").alias("size"), F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows")
    ).collect()
    units.sort(key=lambda u: u["unit"])
    chosen = pack(np.array([[u["size"], u["tokens"], u["rows"]] for u in units], np.int64).reshape(-1, 3), shards)
    where = spark.createDataFrame(
        [(u["unit"], int(s)) for u, s in zip(units, chosen)], "unit string, shard int"
    )
    n_rows = sum(u["rows"] for u in units)
    parts = max(1, -(-n_rows // (shards * PART_ROWS)))
    dealt = rows.join(F.broadcast(where), "unit").withColumn(
        "part", F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(parts))
    )
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("n")).select(
        "shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_hash", "size", "text_crc32")
    return (
        dealt.withColumn("_row", F.row_number().over(inside))
        .join(offsets, ["shard", "part"])
        .select(
            "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard",
            (F.col("offset") + F.col("_row") - 1).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
