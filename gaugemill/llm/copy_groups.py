"""Groups of copies and near copies for the pipeline's near-duplicate stage.

Fingerprints within two bits (``simhash_tree``) find copies with next to no edits; texts
whose five-word shingles are alike to 0.8 are five to twelve bits apart, further than any
exact Hamming search can go at scale.  The stage therefore adds links between texts whose
sets of distinct five-word shingle hashes have a Jaccard similarity of MIN_JACCARD or more:

* equal sets are one node; a node's signature holds MINIMA minima of its hashes under as
  many permutations;
* nodes that agree on one of BANDS bands of BAND_MINIMA minima meet in a bucket; two texts
  alike to 0.8 meet with a chance of 0.9996.  Nodes of a bucket with MIN_SHARE equal minima
  are candidates (a pair alike to 0.8 has fewer with a chance of 1e-5); all nodes of a
  bucket of more than BUCKET_ROWS are.  This only decides who is compared;
* the nodes of a connected set of candidates are compared by their sets.  Nodes are asked
  one after another, each against all others outside its class with MIN_SHARE equal
  minima, until only the largest class is left, so no link between classes is missed;
* a connected set of more than BUCKET_ROWS nodes (or PART_SHINGLES hashes) is dealt into
  parts, which about LEADERS shared nodes tie together.  Then every node outside the
  largest class is compared with all nodes of all parts, block against block in tasks of
  their own: what the shared nodes left apart is found there.

Defined results: null, empty and wordless texts are copies of each other; rows with a null
``doc_id`` are linked like others but never name a group that has an id; one ``doc_id`` may stand
on different texts, each of which is a row of its own; repeated rows count once; other columns are
kept as they are, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from gaugemill.llm.common import arrow_slices, materialize
from gaugemill.llm.simhash_tree import SEED, components, majority, shard_edges, shingle_hashes

SHINGLE_WORDS = 5
MINIMA = 128
BANDS = 20
BAND_MINIMA = 5
MIN_SHARE = 0.65
MIN_JACCARD = 0.8
BUCKET_ROWS = 1024
PART_SHINGLES = 1 << 21
LEADERS = 32

_DRAW = np.random.default_rng(SEED)
_FACTORS = _DRAW.integers(1, 2**63, MINIMA, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = _DRAW.integers(0, 2**63, MINIMA, dtype=np.int64).astype(np.uint64)


def signature(hashes: np.ndarray) -> np.ndarray:
    """Upper halves of the minima over all permutations, in slices of bounded size."""
    least = np.full(MINIMA, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 2048):
        mixed = hashes[i : i + 2048, None] * _FACTORS + _SHIFTS
        np.minimum(least, mixed.min(axis=0), out=least)
    return (least >> np.uint64(32)).astype("<u4")


def shingle_set(text: str | None) -> np.ndarray:
    """Distinct hashes of a text's five-word shingles, ascending."""
    return np.unique(shingle_hashes((text or "").encode().lower().split(), SHINGLE_WORDS))


def alike(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two sets of shingle hashes have a Jaccard similarity of MIN_JACCARD."""
    if min(len(one), len(other)) < MIN_JACCARD * max(len(one), len(other)):
        return False
    both = len(np.intersect1d(one, other, assume_unique=True))
    return both >= MIN_JACCARD * (len(one) + len(other) - both)


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, text, said): ``said`` is a hash of the text."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return narrow.withColumn("said", F.xxhash64("text"))


def marks(docs: DataFrame) -> DataFrame:
    """(doc_id, said, fp, node, size, minima): fingerprint over three words, the rest over five."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh64_intdigest

        for batch in batches:
            for part in arrow_slices(batch, "text"):
                prints, nodes, sizes, minima = [], [], [], []
                for text in part.column("text"):
                    words = (text.as_py() or "").encode().lower().split()
                    prints.append(majority(shingle_hashes(words, 3)) if words else 0)
                    hashes = np.unique(shingle_hashes(words, SHINGLE_WORDS))
                    nodes.append(xxh64_intdigest(hashes.tobytes(), SEED))
                    sizes.append(len(hashes))
                    minima.append(signature(hashes).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("said"),
                     pa.array(np.array(prints, np.uint64).view(np.int64)),
                     pa.array(np.array(nodes, np.uint64).view(np.int64)),
                     pa.array(np.array(sizes, np.int64)), pa.array(minima, pa.binary())],
                    names=["doc_id", "said", "fp", "node", "size", "minima"],
                )

    return _keyed(docs).mapInArrow(
        run, "doc_id long, said long, fp long, node long, size long, minima binary"
    )


def linked_classes(minima: np.ndarray, min_share: float = MIN_SHARE) -> np.ndarray:
    """Class of each row; rows with enough equal minima are in one class, by any path."""
    n = len(minima)
    need = min_share * minima.shape[1]
    label = np.arange(n)
    asked = np.zeros(n, bool)

    def ask(row: int) -> None:
        asked[row] = True
        near = np.count_nonzero(minima == minima[row], axis=1) >= need
        for other in np.unique(label[near]):
            label[label == other] = label[row]

    for row in range(n):
        if label[row] == row and not asked[row] and np.count_nonzero(label == row) == 1:
            ask(row)
    while True:
        names, sizes = np.unique(label, return_counts=True)
        largest = names[np.argmax(sizes)]
        rest = np.nonzero((label != largest) & ~asked)[0]
        if not len(rest):
            return label
        ask(int(rest[0]))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Tables of whole groups from rows sorted by their first ``keys`` columns, all longs."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        named = np.column_stack([batch.column(i).to_numpy() for i in range(keys)])
        other = np.nonzero((named != named[-1]).any(axis=1))[0]
        cut = other[-1] + 1 if len(other) else 0
        if held and not cut and [held[0].column(i)[0].as_py() for i in range(keys)] == named[0].tolist():
            held.append(batch)
            continue
        full = pa.Table.from_batches([*held, batch.slice(0, cut)])
        if full.num_rows:
            yield full
        held = [batch.slice(cut)]
    if held:
        yield pa.Table.from_batches(held)


def each_group(table: pa.Table, keys: int) -> Iterator[pa.Table]:
    named = np.column_stack([table.column(i).to_numpy() for i in range(keys)])
    starts = np.nonzero((named[1:] != named[:-1]).any(axis=1))[0] + 1
    for a, b in zip([0, *starts.tolist()], [*starts.tolist(), table.num_rows]):
        yield table.slice(a, b - a)


def _rows_of_minima(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, MINIMA)


def _stars(node: np.ndarray, label: np.ndarray) -> pa.RecordBatch:
    """Edges (a, b) from each node to the smallest of its class."""
    least = np.full(len(node), np.iinfo(np.int64).max)
    np.minimum.at(least, label, node)
    root = least[label]
    apart = root != node
    return pa.RecordBatch.from_arrays([pa.array(node[apart]), pa.array(root[apart])], names=["a", "b"])


def candidate_edges(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) among ``nodes`` (node, minima): who is connected may be alike, others are not."""
    width = 4 * BAND_MINIMA
    bands = F.array(*[
        F.xxhash64(F.lit(n), F.substring("minima", n * width + 1, width)) for n in range(BANDS)
    ])
    keyed = nodes.select("node", F.explode(bands).alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"), F.min("node").alias("least")
    ).filter("rows > 1")
    met = keyed.join(sizes, "bucket")
    hot = met.filter(F.col("rows") > BUCKET_ROWS).select(F.col("node").alias("a"), F.col("least").alias("b"))
    dealt = (
        met.filter(F.col("rows") <= BUCKET_ROWS).select("bucket", "node")
        .join(nodes, "node").select("bucket", "node", "minima")
        .repartition("bucket").sortWithinPartitions("bucket")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 1):
            bucket, node = (table.column(i).to_numpy() for i in range(2))
            minima = _rows_of_minima(table.column(2))
            starts = np.append(np.nonzero(np.append(True, bucket[1:] != bucket[:-1]))[0], len(bucket))
            label = np.arange(len(bucket))
            for a, b in zip(starts[:-1], starts[1:]):
                if b - a > 2:
                    label[a:b] = a + linked_classes(minima[a:b])
                elif (minima[a] == minima[a + 1]).mean() >= MIN_SHARE:
                    label[a + 1] = a
            yield _stars(node, label)

    return dealt.mapInArrow(run, "a long, b long").unionByName(hot).filter("a <> b").distinct()


def verified_classes(
    minima: np.ndarray, shingles: Callable[[int], np.ndarray], label: np.ndarray, may_ask: np.ndarray
) -> np.ndarray:
    """``label`` after joining classes by all links between a row of ``may_ask`` and any row.

    Where all rows may ask, links inside the largest class are not looked for.
    """
    label = label.copy()
    asked = ~may_ask
    whole = may_ask.all()
    need = MIN_SHARE * minima.shape[1]
    while True:
        rest = ~asked
        if whole:
            names, sizes = np.unique(label, return_counts=True)
            rest &= label != names[np.argmax(sizes)]
        if not rest.any():
            return label
        row = int(np.argmax(rest))
        asked[row] = True
        same = np.count_nonzero(minima == minima[row], axis=1)
        near = np.nonzero((same >= need) & (label != label[row]))[0]
        for other in near[np.argsort(-same[near], kind="stable")]:
            if label[other] != label[row] and alike(shingles(row), shingles(int(other))):
                label[label == label[other]] = label[row]


def _compare(table: pa.Table) -> pa.RecordBatch:
    """Edges of a group's links; its columns from the third on are node, class, asks, minima, text."""
    node = table.column(2).to_numpy()
    node, first = np.unique(node, return_index=True)
    asks = np.isin(node, table.column(2).filter(table.column(4)).to_numpy())
    table = table.take(pa.array(first))
    texts, sets = table.column(6), {}

    def shingles(row: int) -> np.ndarray:
        if row not in sets:
            sets[row] = shingle_set(texts[row].as_py())
        return sets[row]

    known = np.unique(table.column(3).to_numpy(), return_inverse=True)[1]
    start = np.unique(known, return_index=True)[1][known]
    return _stars(node, verified_classes(_rows_of_minima(table.column(5)), shingles, start, asks))


def _compared(rows: DataFrame) -> DataFrame:
    """Edges of all groups (one, two) of rows (one, two, node, class, asks, minima, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole_groups(batches, 2):
            for group in each_group(table, 2):
                yield _compare(group)

    ordered = rows.repartition("one", "two").sortWithinPartitions("one", "two")
    return ordered.mapInArrow(run, "a long, b long").filter("a <> b").distinct()


def _parts(rows, size):
    """How many parts of at most about BUCKET_ROWS rows and PART_SHINGLES hashes."""
    return F.greatest(
        F.ceil(rows / F.lit(BUCKET_ROWS)), F.ceil(size / F.lit(PART_SHINGLES)), F.lit(1)
    ).cast("long")


def _all(parts):
    return F.sequence(F.lit(0).cast("long"), parts - 1)


def alike_edges(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """Edges (a, b) among ``nodes`` whose components are those of all links among candidates.

    ``nodes`` has node, size, minima and one row (doc_id, said) of ``docs`` with the node's text.
    """
    linked = components(candidate_edges(nodes.select("node", "minima")))
    # The root of a component has no row of its own.
    member = linked.unionByName(linked.select(F.col("root").alias("node"), "root").distinct()).distinct()
    member = member.withColumnRenamed("root", "one").join(nodes, "node")
    sums = member.groupBy("one").agg(
        F.count(F.lit(1)).alias("rows"),
        _parts(F.count(F.lit(1)), F.sum("size")).alias("parts"),
    )
    member = materialize(member.join(sums, "one"), "candidates")
    said = _keyed(docs).withColumnRenamed("doc_id", "_doc").withColumnRenamed("said", "_said")

    def with_text(rows: DataFrame) -> DataFrame:
        return rows.join(
            said, (F.col("said") == F.col("_said")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
        ).select("one", "two", "node", "class", "asks", "minima", "text")

    own = F.pmod(F.xxhash64("node", "one", F.lit(1)), F.col("parts"))
    every = F.greatest(F.floor(F.col("rows") / F.lit(LEADERS)), F.lit(1))
    leads = F.pmod(F.xxhash64("node", "one", F.lit(2)), every) == 0
    near = materialize(_compared(with_text(member.select(
        "one", "node", F.col("node").alias("class"), F.lit(True).alias("asks"), "minima", "doc_id", "said",
        F.explode(F.when((F.col("parts") > 1) & leads, _all(F.col("parts"))).otherwise(F.array(own))).alias("two"),
    ))), "alike")

    large = member.filter("parts > 1")
    if large.isEmpty():
        return near
    found = components(near).select(F.col("node").alias("_node"), "root")
    large = materialize(large.join(found, large["node"] == found["_node"], "left").select(
        "one", "node", F.coalesce("root", "node").alias("class"), "size", "minima", "doc_id", "said", "parts"
    ), "large")
    classes = large.groupBy("one", "class").agg(F.count(F.lit(1)).alias("rows"))
    most = classes.groupBy("one").agg(F.max_by("class", F.struct("rows", "class")).alias("main"))
    rest = large.join(most, "one").filter(F.col("class") != F.col("main"))
    blocks = rest.groupBy("one").agg(_parts(F.count(F.lit(1)), F.sum("size")).alias("blocks"))
    dealt = large.join(most, "one").join(blocks, "one")
    column = F.pmod(F.xxhash64("node", "one", F.lit(3)), F.col("blocks"))
    pair = [F.col("i") * F.col("parts") + F.col("j")]
    asking = dealt.filter(F.col("class") != F.col("main")).select(
        "*", column.alias("i"), F.lit(True).alias("asks"), F.explode(_all(F.col("parts"))).alias("j"))
    answering = dealt.select(
        "*", F.explode(_all(F.col("blocks"))).alias("i"), F.lit(False).alias("asks"), own.alias("j"))
    names = ["one", "node", "class", "asks", "minima", "doc_id", "said"]
    across = asking.select(*names, *[p.alias("two") for p in pair]).unionByName(
        answering.select(*names, *[p.alias("two") for p in pair]))
    return near.unionByName(_compared(with_text(across)))


def _roots(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Marked rows, and (node, root, least, doc_id, said) of every node.

    ``least`` is the smallest doc_id of a node's rows; (doc_id, said) names the first of
    them: by id, null ids last, then by the text's hash.
    """
    marked = materialize(marks(docs), "marks")
    nodes = materialize(
        marked.groupBy("node").agg(
            F.first("minima").alias("minima"), F.first("size").alias("size"),
            F.min("doc_id").alias("least"),
            F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "said")).alias("row"),
        ).select("node", "minima", "size", "least", "row.doc_id", "row.said"),
        "nodes",
    )
    prints = materialize(marked.select("fp", "node").distinct(), "prints")
    named = materialize(prints.groupBy("fp").agg(F.min("node").alias("first")), "first")
    near = shard_edges(named.select("fp"))
    left, right = named.select(F.col("fp").alias("a"), F.col("first").alias("na")), named.select(
        F.col("fp").alias("b"), F.col("first").alias("nb"))
    close = near.join(left, "a").join(right, "b").select(F.col("na").alias("a"), F.col("nb").alias("b"))
    same = prints.join(named, "fp").select(F.col("node").alias("a"), F.col("first").alias("b"))
    edges = close.unionByName(same).unionByName(alike_edges(nodes, docs))
    linked = components(edges.filter("a <> b").distinct()).withColumnRenamed("node", "_node")
    return marked, nodes.join(linked, nodes["node"] == linked["_node"], "left").select(
        "node", F.coalesce("root", "node").alias("root"), "least", "doc_id", "said"
    )


def copy_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, component_id): the smallest doc_id among a row's copies and near copies."""
    marked, roots = _roots(docs)
    names = roots.groupBy("root").agg(F.min("least").alias("component_id"))
    return marked.join(roots.join(names, "root").select("node", "component_id"), "node").select(
        "doc_id", "component_id"
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: the first of every group, by doc_id, then by its text's hash.

    Null ids come last, so a row without an id stays only if its group has no id at all.
    Different texts under one id are judged each on its own; of repeated rows one stays.
    """
    _, roots = _roots(docs)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "said")).alias("row")
    keep = roots.groupBy("root").agg(first).select(
        F.col("row.doc_id").alias("_doc"), F.col("row.said").alias("_said")
    )
    # Any name may be taken, so the columns go by their places.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    keyed = plain.withColumns({"_key": doc.cast("long"), "_hash": F.xxhash64(text.cast("string"))})
    stays = keyed.join(
        keep, F.col("_key").eqNullSafe(F.col("_doc")) & (F.col("_hash") == F.col("_said")), "left_semi"
    )
    return stays.dropDuplicates(["_key", "_hash"]).select(*plain.columns).toDF(*docs.columns)
