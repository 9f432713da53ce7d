"""Vector codes by integer k-means in equal parts, with adaptive distance bounds.

A vector's components become integers and are cut into PARTS equal parts; each part
position has a codebook of ENTRIES entries that ROUNDS rounds of k-means move.  Between
rounds each vector's row is stored with what is known of its distances (Drake and Hamerly):

* for every part its ``b`` closest entries in order: an upper bound of the distance to
  the first, which it is assigned to, lower bounds of the others, and one outer lower bound
  of all entries that are not listed;
* an entry that moved by some distance loosens its bounds by as much, the outer bound
  moves by the farthest move of all;
* a part whose upper bound stays below all its lower bounds keeps its entry unseen.  Any
  other is uncertain: the exact integer distance to its entry is taken, then, if that does
  not do, those to its listed entries, and to all entries only where the outer bound fails.
  Ties go to the lower index by the exact distances;
* ``b`` starts at a quarter of the entries and shrinks, not below an eighth, to the
  depth that all but DEEP of the parts of the last round needed.

Bounds are rounded away from certainty, so no rounding decides an assignment.  A round
reads the stored rows once and writes the next ones with its tasks' sums; the driver sees
one codebook (a bounded number of integers) a round.  No row is shuffled.

Defined results: rows whose vector is null or holds null or non-finite components are
dropped.  The dimension is that of the smallest ``vec_id`` among vectors whose length is a
positive multiple of PARTS; a kept vector of another length, or with a component so large
that a squared distance would not fit a long, has null code and error.  Starting entries
are the least vectors of the smallest distinct non-null ``vec_id``s; there are fewer than
ENTRIES where there are fewer ids, and without any id all codes are null.  Repeated rows are
coded as often as they come, rows with a null ``vec_id`` are coded like others.  Other
columns are ignored.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from gaugemill.llm.common import materialize, sha256_hex
from gaugemill.session import discard

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
DEEP = 0.01
# Totals of labels are broadcast up to this many; beyond it they are joined over SALTS.
BROADCAST_LABELS = 1 << 18
SALTS = 64
SLICE_COMPONENTS = 1 << 20

_SLACK = 1e-6


@dataclass
class Bounds:
    """What is known of one part's distances, for many rows."""

    near: np.ndarray   # (rows, b) listed entries, the assigned one first
    low: np.ndarray    # (rows, b) lower bounds of the listed entries; the first is not used
    upper: np.ndarray  # (rows,) upper bound of the assigned one
    outer: np.ndarray  # (rows,) lower bound of all that are not listed

    @staticmethod
    def unknown(rows: int, b: int) -> Bounds:
        return Bounds(np.zeros((rows, b), np.uint8), np.zeros((rows, b), np.float32),
                      np.full(rows, np.inf, np.float32), np.zeros(rows, np.float32))

    def moved(self, drift: np.ndarray) -> Bounds:
        """Bounds after every entry has moved by at most its ``drift``."""
        first = drift[self.near[:, 0]]
        return Bounds(self.near, _down(self.low - drift[self.near]),
                      _up(self.upper + first), _down(self.outer - drift.max(initial=0.0)))

    def narrowed(self, b: int) -> Bounds:
        """The same with at most ``b`` listed entries."""
        if b >= self.near.shape[1]:
            return self
        outer = np.minimum(self.outer, self.low[:, b:].min(axis=1))
        return Bounds(self.near[:, :b], self.low[:, :b], self.upper, outer)


def _up(values: np.ndarray) -> np.ndarray:
    return (np.asarray(values, np.float64) * (1 + _SLACK)).astype(np.float32)


def _down(values: np.ndarray) -> np.ndarray:
    values = np.asarray(values, np.float64)
    return (values - np.abs(values) * _SLACK).astype(np.float32)


def squared(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances (rows, entries) of integer vectors."""
    out = np.empty((len(rows), len(entries)), np.int64)
    for j, entry in enumerate(entries):
        apart = rows - entry
        out[:, j] = np.einsum("ij,ij->i", apart, apart)
    return out


def settle(rows: np.ndarray, book: np.ndarray, known: Bounds) -> np.ndarray:
    """Bring every row's nearest entry to the front of ``known``; how deep each row went.

    Depth 0: certain by its bounds; 1: by the exact distance to its entry; up to b: by
    exact distances to listed entries; otherwise all entries were measured.
    """
    n, b = known.near.shape
    depth = np.zeros(n, np.int64)
    nearest = np.minimum(known.outer, known.low[:, 1:].min(axis=1, initial=np.inf))
    todo = np.nonzero(~(known.upper < nearest))[0]
    if not len(todo):
        return depth
    apart = rows[todo] - book[known.near[todo, 0]]
    known.upper[todo] = _up(np.sqrt(np.einsum("ij,ij->i", apart, apart)))
    depth[todo] = 1
    todo = todo[~(known.upper[todo] < nearest[todo])]
    enough = known.upper[todo] < known.outer[todo]

    some = todo[enough]
    if len(some):
        listed = known.near[some]
        apart = rows[some][:, None, :] - book[listed]
        exact = np.einsum("ijk,ijk->ij", apart, apart)
        depth[some] = 1 + (known.low[some, 1:] <= known.upper[some, None]).sum(axis=1)
        order = np.lexsort((listed, exact), axis=1)
        _store(known, some, np.take_along_axis(listed, order, 1), np.take_along_axis(exact, order, 1))

    full = todo[~enough]
    if len(full):
        exact = squared(rows[full], book)
        depth[full] = len(book)
        order = np.argsort(exact, axis=1, kind="stable")
        exact = np.take_along_axis(exact, order, 1)
        _store(known, full, order[:, :b], exact[:, :b])
        known.outer[full] = _down(np.sqrt(exact[:, b])) if len(book) > b else np.inf
    return depth


def _store(known: Bounds, at: np.ndarray, near: np.ndarray, exact: np.ndarray) -> None:
    known.near[at] = near
    known.low[at] = _down(np.sqrt(exact))
    known.upper[at] = _up(np.sqrt(exact[:, 0]))


def _fixed(values: np.ndarray) -> pa.Array:
    """Rows of equal byte length as a binary column."""
    rows = np.ascontiguousarray(values).reshape(len(values), -1)
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.BinaryArray.from_buffers(
        pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(rows.tobytes())]
    )


def _rows_of(column: pa.Array, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


class Step:
    """One pass over all vectors: assign by ``book``, whose entries came from ``before``."""

    def __init__(self, book: np.ndarray, before: np.ndarray | None, b_read: int, b: int, width: str):
        self.book = book                       # (PARTS, entries, length)
        self.before = before
        self.b_read, self.b, self.width = b_read, b, width

    def slices(self, batches: Iterator[pa.RecordBatch], raw: bool) -> Iterator[tuple]:
        """(batch, rows (n, PARTS, length), bounds of every part, depth) of bounded slices."""
        parts, _, length = self.book.shape
        step = max(1, SLICE_COMPONENTS // (parts * length))
        drift = None
        if self.before is not None:
            apart = self.book - self.before
            drift = np.sqrt(np.einsum("ijk,ijk->ij", apart, apart)) * (1 + _SLACK)
        for whole in batches:
            for i in range(0, whole.num_rows, step):
                batch = whole.slice(i, step)
                n = batch.num_rows
                if raw:
                    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
                    rows = np.floor(SCALE * flat).astype(np.int64).reshape(n, parts, length)
                    bounds = [Bounds.unknown(n, self.b) for _ in range(parts)]
                else:
                    rows = _rows_of(batch.column("vector"), self.width).astype(np.int64)
                    rows = rows.reshape(n, parts, length)
                    near = _rows_of(batch.column("near"), np.uint8).reshape(n, parts, self.b_read)
                    low = _rows_of(batch.column("bounds"), np.float32).reshape(n, parts, self.b_read + 1)
                    bounds = [
                        # The first listed entry's place holds the upper bound.
                        Bounds(near[:, p].copy(), low[:, p, :-1].copy(), low[:, p, 0].copy(),
                               low[:, p, -1].copy()).moved(drift[p]).narrowed(self.b)
                        for p in range(parts)
                    ]
                depth = np.stack([settle(rows[:, p], self.book[p], bounds[p]) for p in range(parts)], 1)
                yield batch, rows, bounds, depth


def _assigning(step: Step, raw: bool, schema: pa.Schema):
    """Rows for the next round, then one row with the task's counts, sums and depths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, entries, length = step.book.shape
        counts = np.zeros((parts, entries), np.int64)
        sums = np.zeros((parts, entries, length), np.int64)
        depths = np.zeros(entries + 1, np.int64)
        for batch, rows, bounds, depth in step.slices(batches, raw):
            depths += np.bincount(depth.ravel(), minlength=entries + 1)
            for p in range(parts):
                mine = bounds[p].near[:, 0]
                counts[p] += np.bincount(mine, minlength=entries)
                for k in range(length):
                    # Exact: a slice's sums stay below 2**53.
                    sums[p, :, k] += np.bincount(mine, rows[:, p, k], entries).astype(np.int64)
            near = np.stack([x.near for x in bounds], 1)
            low = np.stack([np.column_stack([x.upper, x.low[:, 1:], x.outer]) for x in bounds], 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"), _fixed(rows.astype(step.width)),
                 _fixed(near), _fixed(low.astype(np.float32)),
                 pa.nulls(len(rows), pa.list_(pa.int64()))],
                schema=schema,
            )
        told = np.concatenate([counts.ravel(), sums.ravel(), depths])
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(1, f.type) for f in list(schema)[:-1]] + [pa.array([told], pa.list_(pa.int64()))],
            schema=schema,
        )

    return run


def _coding(step: Step, raw: bool, schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows, bounds, _ in step.slices(batches, raw):
            near = np.stack([x.near[:, 0] for x in bounds], 1)
            apart = rows - np.stack([step.book[p][near[:, p]] for p in range(len(bounds))], 1)
            codes = near.tobytes().hex()
            wide = 2 * near.shape[1]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), batch.column("label"),
                 pa.array([codes[i : i + wide] for i in range(0, len(codes), wide)], pa.string()),
                 pa.array(np.einsum("ijk,ijk->i", apart, apart))],
                schema=schema,
            )

    return run


def kept_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, vector): rows whose vector has only finite components."""
    narrow = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.col("embedding").cast("array<double>").alias("vector"),
    )
    infinite = F.lit(float("inf"))
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < infinite)
    )
    return narrow.filter(F.col("vector").isNotNull() & finite)


def _smallest_ids(vectors: DataFrame, n: int) -> list[int]:
    """The n smallest distinct ids; every task brings at most n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for batch in batches:
            held = np.unique(np.concatenate([held, batch.column(0).to_numpy()]))[:n]
        yield pa.RecordBatch.from_arrays([pa.array(held)], names=["vec_id"])

    found = vectors.select("vec_id").filter("vec_id is not null").mapInArrow(run, "vec_id long")
    return [r[0] for r in found.distinct().orderBy("vec_id").limit(n).collect()]


def _largest(vector: Column) -> Column:
    return F.array_max(F.transform(vector, lambda x: F.abs(x)))


@dataclass
class Codes:
    """``codes`` has vec_id, label, code, error of all kept rows; ``books`` the final entries.

    ``trace`` tells of every round: b, and how many parts went how deep.
    """

    codes: DataFrame
    books: np.ndarray
    trace: list[tuple[int, list[int]]]


def compress(
    embeddings: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> Codes:
    """Codes of all rows of ``embeddings`` (vec_id, label, embedding)."""
    kept = kept_vectors(embeddings)
    length = F.size("vector")
    first = kept.filter((length > 0) & (length % parts == 0) & F.col("vec_id").isNotNull()).agg(
        F.min_by(length, F.struct("vec_id", "vector"))
    ).first()[0]
    bare = kept.withColumn("code", F.lit(None).cast("string")).withColumn("error", F.lit(None).cast("long"))
    none = bare.drop("vector")
    if first is None:
        return Codes(none, np.zeros((parts, 0, 0), np.int64), [])
    bound = isqrt((2**63 - 1) // first) // 2
    fits = (length == first) & (_largest(F.col("vector")) <= bound // SCALE - 1)
    vectors = kept.filter(fits)
    ids = _smallest_ids(vectors, entries)
    if not ids:
        return Codes(none, np.zeros((parts, 0, 0), np.int64), [])
    starts = vectors.filter(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("vector").alias("v"))
    rows = {r["vec_id"]: r["v"] for r in starts.collect()}
    book = np.floor(SCALE * np.array([rows[i] for i in ids])).astype(np.int64)
    book = np.ascontiguousarray(book.reshape(len(ids), parts, -1).transpose(1, 0, 2))
    largest = vectors.agg(F.max(_largest(F.col("vector")))).first()[0]
    width = "<i2" if SCALE * largest < 2**15 - 1 else "<i4"

    row = T.StructType([
        T.StructField("vec_id", T.LongType()), T.StructField("label", kept.schema["label"].dataType),
        T.StructField("vector", T.BinaryType()), T.StructField("near", T.BinaryType()),
        T.StructField("bounds", T.BinaryType()), T.StructField("told", T.ArrayType(T.LongType())),
    ])
    coded = T.StructType([*row.fields[:2], T.StructField("code", T.StringType()),
                          T.StructField("error", T.LongType())])
    state, before, trace = vectors, None, []
    b_read = b = max(1, min(len(ids), entries // 4))
    for _ in range(rounds):
        step = Step(book, before, b_read, b, width)
        found = materialize(
            state.mapInArrow(_assigning(step, before is None, to_arrow_schema(row)), row), "codes"
        )
        if before is not None:
            discard(state)
        told = _totals(found)
        moved, depths = _moved(book, told)
        trace.append((b, depths))
        state, before, book = found.filter("told is null"), book, moved
        b_read, b = b, max(min(b, max(1, entries // 8)), min(b, _depth_needed(depths)))
        if (before == book).all():
            break
    step = Step(book, before, b_read, b, width)
    raw = before is None
    codes = materialize(state.mapInArrow(_coding(step, raw, to_arrow_schema(coded)), coded), "coded")
    if not raw:
        discard(state)
    rest = bare.filter(~F.coalesce(fits, F.lit(False))).drop("vector")
    return Codes(codes.unionByName(rest), book, trace)


def _totals(found: DataFrame) -> list[int]:
    """Sums over all tasks' told numbers, exact, by place."""
    told = found.filter("told is not null").select(F.posexplode("told").alias("at", "x"))
    rows = told.groupBy("at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect()
    return [int(x) for _, x in sorted((r["at"], r["x"]) for r in rows)]


def _moved(book: np.ndarray, told: list[int]) -> tuple[np.ndarray, list[int]]:
    """Entries at the floors of their means; unused entries stay."""
    parts, entries, length = book.shape
    new = book.copy()
    for p in range(parts):
        for e in range(entries):
            count = told[p * entries + e]
            if count:
                at = parts * entries + (p * entries + e) * length
                new[p, e] = [x // count for x in told[at : at + length]]
    return new, told[parts * entries * (1 + length) :]


def _depth_needed(depths: list[int]) -> int:
    """Listed entries that do for all but DEEP of the parts; entries beyond b count as deepest."""
    rest = sum(depths)
    for b, n in enumerate(depths):
        rest -= n
        if rest <= DEEP * sum(depths):
            return max(b, 1)
    return len(depths)


def books_text(books: np.ndarray) -> str:
    """All entries' components by part, entry and position, comma-joined."""
    return ",".join(map(str, books.ravel().tolist()))


def with_label_error(codes: DataFrame) -> DataFrame:
    """``codes`` with the sum of ``error`` over equal labels; null labels are equal."""
    total = F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error")
    totals = materialize(codes.groupBy("label").agg(total), "label_errors")
    named = totals.withColumnRenamed("label", "_label")
    same = F.col("label").eqNullSafe(F.col("_label"))
    if totals.count() <= BROADCAST_LABELS:
        return codes.join(F.broadcast(named), same, "left").drop("_label")
    salt = F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(SALTS)).cast("int")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_other")
    spread = named.select("*", salts)
    return codes.withColumn("_salt", salt).join(
        spread, same & (F.col("_salt") == F.col("_other")), "left"
    ).drop("_label", "_salt", "_other")


def vector_codes(embeddings: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of every kept row."""
    found = compress(embeddings)
    return with_label_error(found.codes).select(
        "vec_id", "code", "error", "label_error",
        F.lit(sha256_hex(books_text(found.books))).alias("codebooks_sha256"),
    )
