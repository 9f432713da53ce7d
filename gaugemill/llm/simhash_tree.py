"""Near duplicates by SimHash, linked through Hamming-distance BK-trees.

1. *Fingerprints.*  One pass over the texts; only (doc_id, fingerprint) is kept.
2. *Shards.*  Two distinct fingerprints within two bits agree on at least two of their
   four 16-bit quarters.  Each fingerprint goes to the six shards named by two quarters
   and their values, so every link lies inside some shard.  A shard of more than
   SHARD_ROWS fingerprints is dealt once more, by two of the four 8-bit parts of its
   other 32 bits; what then shares a shard shares 48 bits, so no shard can hold more
   than 2**16 distinct fingerprints, whatever the data.
3. *Trees.*  A shard's fingerprints form a BK-tree: children are keyed by their Hamming
   distance to the parent, and a search follows only edges within the radius.  Searches
   of a whole shard go down the tree together.  A shard gives the edges of a spanning
   forest of its links, not all its links: these say the same of who reaches whom.
4. *Components.*  Alternating large-star and small-star rounds over the distinct
   fingerprints that have links; each round is cut from its lineage in the shared folder.

Copies share a fingerprint and are one node, however many there are.

Defined results: a null or wordless text has fingerprint 0 and is linked like any other;
rows with a null ``doc_id`` are fingerprinted and linked but never name a component (it is
null only if no row of it has an id); repeated rows are returned as often as they come;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gaugemill.llm.common import arrow_slices, materialize

SEED = 42
RADIUS = 2
SHARD_ROWS = 4096
LEAF_ROWS = 32


def fingerprint(text: str | None, shingle_words: int = 3) -> int:
    """SimHash over word shingles, repeats included; 0 for a text without words."""
    words = (text or "").encode().lower().split()
    return majority(shingle_hashes(words, shingle_words)) if words else 0


def shingle_hashes(words: list[bytes], shingle_words: int) -> np.ndarray:
    """XXH64 of every shingle in order; of the whole sequence if that is shorter."""
    from xxhash import xxh64_intdigest

    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    starts = np.concatenate([[0], np.cumsum(lengths)]) if words else np.array([0, 1])
    span = min(shingle_words, max(1, len(words)))
    firsts = starts[: max(1, len(words)) - span + 1].tolist()
    lasts = (starts[span:] - 1).tolist()
    return np.array([xxh64_intdigest(line[a:b], SEED) for a, b in zip(firsts, lasts)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """Bits set in more than half of the hashes; counted in slices of bounded size."""
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):
        octets = hashes[i : i + (1 << 16)].astype(">u8").view(np.uint8)
        ones += np.unpackbits(octets.reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes))
    return int.from_bytes(bits.tobytes(), "big")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """(doc_id, fp): 64-bit fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch, "text"):
                found = [fingerprint(t.as_py(), shingle_words) for t in part.column("text")]
                signed = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(signed)], names=["doc_id", "fp"]
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id long, fp long")


class Tree:
    """BK-tree over 64-bit values, built and searched many values at a time.

    A node is a pivot with its children by distance; up to LEAF_ROWS values stay a list.
    """

    def __init__(self, values: np.ndarray):
        self.values = values
        self.nodes: list[tuple[np.ndarray, int, dict[int, int]]] = []
        pending = [(np.arange(len(values)), -1, 0)]
        while pending:
            rows, parent, edge = pending.pop()
            if parent >= 0:
                self.nodes[parent][2][edge] = len(self.nodes)
            if len(rows) <= LEAF_ROWS:
                self.nodes.append((rows, -1, {}))
                continue
            pivot, rest = int(rows[0]), rows[1:]
            me = len(self.nodes)
            self.nodes.append((rows[:0], pivot, {}))
            apart = np.bitwise_count(values[rest] ^ values[pivot])
            for d in np.unique(apart):
                pending.append((rest[apart == d], me, int(d)))

    def links(self, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (row, other row) of the tree's own values within the radius, both ways."""
        pending = [(0, np.arange(len(self.values)))] if len(self.values) else []
        while pending:
            node, asking = pending.pop()
            rows, pivot, children = self.nodes[node]
            if pivot < 0:
                step = max(1, (1 << 20) // max(1, len(rows)))
                for i in range(0, len(asking), step):
                    some = asking[i : i + step]
                    near = np.bitwise_count(self.values[some][:, None] ^ self.values[rows]) <= radius
                    a, b = np.nonzero(near)
                    yield some[a], rows[b]
                continue
            apart = np.bitwise_count(self.values[asking] ^ self.values[pivot]).astype(np.int64)
            hit = asking[apart <= radius]
            yield hit, np.full(len(hit), pivot)
            for edge, child in children.items():
                follow = asking[np.abs(apart - edge) <= radius]
                if len(follow):
                    pending.append((child, follow))


def forest(values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """For each linked row the smallest value it reaches within these values: star edges."""
    root = np.arange(len(values))
    for a, b in Tree(values).links(radius):
        root = _merge(root, a, b)
    order = np.full(len(values), len(values))
    rank = np.argsort(values, kind="stable")
    position = np.empty(len(values), np.int64)
    position[rank] = np.arange(len(values))
    np.minimum.at(order, root, position)
    least = rank[order[root]]
    linked = least != np.arange(len(values))
    return values[linked], values[least[linked]]


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of classes along the pairs, by repeated hooking to the smaller root."""
    while True:
        ra, rb = root[a], root[b]
        apart = ra != rb
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        high, low = np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart]
        np.minimum.at(root, high, low)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _quarter_keys(value: Column, part_bits: int, parts: int) -> list[Column]:
    """Keys of two of four parts each: which two, and both values, in one long."""
    mask = F.lit((1 << part_bits) - 1).cast("long")
    pieces = [F.shiftrightunsigned(value, part_bits * i).bitwiseAND(mask) for i in range(parts)]
    return [
        F.lit(n).cast("long") * F.lit(1 << (2 * part_bits))
        + pieces[i] * F.lit(1 << part_bits) + pieces[j]
        for n, (i, j) in enumerate(combinations(range(parts), 2))
    ]


def _other_half(fp: Column, pair: Column) -> Column:
    """The 32 bits of a fingerprint that its shard's key does not name."""
    out = None
    quarter = [F.shiftrightunsigned(fp, 16 * i).bitwiseAND(F.lit(0xFFFF).cast("long")) for i in range(4)]
    for n, (i, j) in enumerate(combinations(range(4), 2)):
        k, m = (x for x in range(4) if x not in (i, j))
        value = quarter[k] * F.lit(1 << 16) + quarter[m]
        out = F.when(pair == n, value) if out is None else out.when(pair == n, value)
    return out


def shard_edges(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (a, b) among distinct fingerprints ``fp`` whose components are those of all links."""
    if radius > 2:
        raise ValueError("two of four quarters are equal only within two bits")
    keyed = distinct.select("fp", F.posexplode(F.array(*_quarter_keys(F.col("fp"), 16, 4))).alias("pair", "shard"))
    sizes = keyed.groupBy("shard").agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")
    shared = keyed.join(sizes, "shard")
    small = shared.filter(F.col("rows") <= SHARD_ROWS).select(
        "shard", F.lit(-1).cast("long").alias("part"), "fp"
    )
    large = shared.filter(F.col("rows") > SHARD_ROWS).select(
        "shard",
        F.explode(F.array(*_quarter_keys(_other_half(F.col("fp"), F.col("pair")), 8, 4))).alias("part"),
        "fp",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [np.zeros((0, 3), np.int64)]
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.column_stack([c.to_numpy() for c in batch.columns])
            held.append(rows)
            # All but the last shard, which may go on in the next batch.
            if (rows[-1, :2] == held[0][:1, :2]).all() and len(held[0]):
                continue
            rows = np.concatenate(held)
            last = np.nonzero((rows[:, :2] != rows[-1, :2]).any(axis=1))[0]
            cut = last[-1] + 1 if len(last) else 0
            yield from _forests(rows[:cut], radius)
            held = [rows[cut:]]
        yield from _forests(np.concatenate(held), radius)

    return (
        small.unionByName(large)
        .repartition("shard", "part")
        .sortWithinPartitions("shard", "part")
        .mapInArrow(run, "a long, b long")
        .distinct()
    )


def _forests(rows: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """Star edges of every shard in rows (shard, part, fp) sorted by shard and part."""
    if not len(rows):
        return
    new = np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(axis=1)])
    starts = np.append(np.nonzero(new)[0], len(rows))
    fps = rows[:, 2].copy().view(np.uint64)
    size = np.diff(starts)
    out_a, out_b = [], []
    pairs = starts[:-1][size == 2]
    near = np.bitwise_count(fps[pairs] ^ fps[pairs + 1]) <= radius
    first, second = fps[pairs][near], fps[pairs + 1][near]
    out_a.append(np.maximum(first, second))
    out_b.append(np.minimum(first, second))
    for a, n in zip(starts[:-1][size > 2], size[size > 2]):
        x, y = forest(fps[a : a + n], radius)
        out_a.append(x)
        out_b.append(y)
    a, b = np.concatenate(out_a), np.concatenate(out_b)
    yield pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
    )


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges``; root is the smallest node reached.

    Large-star links a node's larger neighbours to its least one, small-star the
    smaller ones; together they halve distances, so rounds grow with the logarithm of
    the longest path.  A neighbourhood is only ever aggregated, never gathered.
    """
    stars = materialize(edges.select("a", "b"), "edges")
    if stars.isEmpty():
        return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
    before = None
    while True:
        both = stars.unionByName(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (
            both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        )
        large = large.filter("a <> b").distinct()
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(
            F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"),
            F.col("m").alias("b"),
        )
        stars = materialize(small.filter("a <> b").distinct(), "edges")
        now = stars.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))
        ).first()
        if now == before:
            return stars.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def near_duplicates(docs: DataFrame, shingle_words: int = 3, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id among all that the row's fingerprint reaches.
    """
    marked = materialize(fingerprints(docs, shingle_words), "fingerprints")
    nodes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    linked = components(shard_edges(nodes.select("fp"), radius))
    roots = nodes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    names = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(names, "root").select("fp", "component_id")
    return marked.join(named, "fp").select("doc_id", "fp", "component_id")


def first_of_each(docs: DataFrame, shingle_words: int = 3, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs`` that stay: the smallest doc_id of every component.

    A component without any doc_id has nothing that could name a row; its rows stay.
    Of repeated rows with one doc_id a single one stays.
    """
    found = near_duplicates(docs, shingle_words, radius)
    keep = found.filter("doc_id = component_id").select("doc_id").distinct()
    named = docs.join(keep, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return named.unionByName(docs.filter("doc_id is null"))
