"""Exact set-similarity join of documents by grouped prefixes.

A document's set are the distinct hashes of its word shingles; two documents link when the
Jaccard similarity of their sets is at least a percentage.

1. *Nodes.*  Documents with equal sets are one node, named by a 128-bit digest.
2. *Order.*  Shingles are ordered by hash, but those that occur among the lowest shingles
   of more than HOT_ROWS nodes come last, by that count.  Two sets of n and m shingles
   that link share at least v within the first n - ceil(t n) + v and m - ceil(t m) + v of any
   common order, so these prefixes are all that is indexed; the order only decides how
   selective they are.  ``v``, the votes a set asks for, is about half of n - ceil(t n) + 1;
   of two sets the smaller one counts.  The lowest shingles of a node nearly always hold its
   prefix; where too many of them are frequent, the whole text is taken.
3. *Groups.*  Nodes with the same prefix and the same size are one group: one entry in
   every posting list, however many members it has.
4. *Stars.*  In each of STAR_ROUNDS rounds a group looks at one other group, the leader
   that most of its prefix shingles name (the least by hash among those of about the same
   size), and its members are compared with the leader's first member, and with their own
   group's.  This joins families of near copies in a number of comparisons that grows with
   their members, not with their pairs.
5. *Neighbours.*  Posting lists are cut into pieces of about NEAR_ROWS groups, and a group is
   compared with the NEAR_LINKS others of its pieces whose parities are most like its own.  This
   joins families whose members link with some of the others only, so no leader reaches them;
   again the comparisons grow with the members.
6. *Rest.*  Every pair of groups that share enough prefix shingles, agree in size, pass the
   bounds their positions and parities put on the overlap and are not known to be of one class
   is expanded to its members of different classes, and these are compared.  So no link between
   classes is missed, however long a posting list is; long lists are dealt block against block.
   Pairs are formed and turned down inside a task, so only those that may link become rows.

Parities are a bit for each of PARITY_BITS buckets of hashes, set if it has an odd number of
the set's shingles.  Two sets differ by at least as many shingles as their parities by bits, so
a pair that is turned down can't link.  A group has the bits that all its members set and those
that any sets; two groups differ surely where one sets a bit always and the other never.
A comparison takes both whole texts and counts the intersection exactly (of 64-bit hashes).

Defined results: null, empty and wordless texts have an empty set, link with nothing and
are their own component; shorter texts have their whole word sequence as one shingle.  Rows
with a null ``doc_id`` are linked but never name a component (it is null only if no row of
it has an id); repeated rows are returned as often as they come; other columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugemill.llm.common import arrow_slices, bitmap, marked, materialize
from gaugemill.llm.simhash_tree import components
from gaugemill.session import discard

SHINGLE_WORDS = 3
PERCENT = 90
HOT_ROWS = 128
# At most this many frequent shingles are broadcast, the most frequent ones (16 bytes each).
HOT_ENTRIES = 1 << 20
STAR_ROUNDS = 2
NEAR_ROUNDS = 2
NEAR_ROWS = 64
NEAR_LINKS = 4
PRUNE_ROUNDS = 2
SALTS = 32
BLOCK_ROWS = 1024
# Keys of wanted texts are broadcast up to this many, joined by a shuffle beyond it.
BROADCAST_NODES = 1 << 19
PAIRS_A_BLOCK = 4096
PARITY_BITS = 1024
# Pairs of groups looked at at once; each takes two parities of memory.
PAIRS_AT_ONCE = 1 << 15

_MULTIPLIERS = np.random.default_rng(42).integers(1, 2**63, 64, dtype=np.int64).astype(np.uint64) | np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: str | None, shingle_words: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct shingle hashes of a whole text, ascending; A-Z count as lower case."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))
    span = min(shingle_words, len(words))
    total = np.full(len(words) - span + 1, span, np.uint64)
    for k in range(span):
        total += _mixed(each[k : k + len(total)] * _MULTIPLIERS[k] + np.uint64(k))
    return np.unique(_mixed(total))


def parity(found: np.ndarray) -> np.ndarray:
    """For every bucket of hashes, whether it has an odd number of them; 64 to a number."""
    odd = np.bincount((found & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def _near(one: str, other: str, size: Column, other_size: Column, percent: int) -> Column:
    """Whether sets of these parities and sizes may link."""
    bits = F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda n, x: n + x)
    return (100 + percent) * differ <= (100 - percent) * (size + other_size)


def prefix_length(size: int, percent: int = PERCENT) -> int:
    return size - (percent * size + 99) // 100 + 1


def votes_asked(size: int, percent: int = PERCENT) -> int:
    """Prefix shingles that a linked set of no smaller size shares at least."""
    return (prefix_length(size, percent) + 1) // 2


def linked(one: np.ndarray, other: np.ndarray, percent: int = PERCENT) -> bool:
    small, large = sorted((len(one), len(other)))
    if not small or 100 * small < percent * large:
        return False
    place = np.searchsorted(one, other)
    both = int(np.count_nonzero(one[np.minimum(place, len(one) - 1)] == other))
    return 100 * both >= percent * (len(one) + len(other) - both)


def _narrow(docs: DataFrame) -> DataFrame:
    """(doc_id, said, text): ``said`` is a hash of the text."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"))
    return narrow.select("doc_id", F.xxhash64("text").alias("said"), "text")


def marks(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """(doc_id, said, node, size, low, odd): ``low`` has the least shingles, twice the prefix
    and some, ``odd`` the parity of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for batch in batches:
            for part in arrow_slices(batch, "text"):
                sets = [shingle_set(t.as_py(), shingle_words) for t in part.column("text")]
                low = [s[: 2 * prefix_length(len(s), percent) + 16].view(np.int64) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("said"),
                     pa.array([xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                     pa.array([len(s) for s in sets], pa.int64()),
                     pa.array(low, pa.list_(pa.int64())),
                     pa.array([parity(s) for s in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "said", "node", "size", "low", "odd"],
                )

    return _narrow(docs).mapInArrow(
        run, "doc_id long, said long, node binary, size long, low array<long>, odd array<long>"
    )


def hot_shingles(nodes: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, ascending, and their counts; at most HOT_ENTRIES of them."""
    counted = nodes.select(F.explode("low").alias("token")).groupBy("token").agg(
        F.count(F.lit(1)).alias("rows")
    ).filter(F.col("rows") > HOT_ROWS)
    found = counted.orderBy(F.desc("rows"), "token").limit(HOT_ENTRIES).toArrow()
    tokens = found.column("token").to_numpy().astype(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], found.column("rows").to_numpy().astype(np.int64)[order]


def prefix_of(
    held: np.ndarray, size: int, hot: np.ndarray, rows: np.ndarray, percent: int
) -> tuple[np.ndarray, np.ndarray] | None:
    """First shingles in the common order and which are frequent.

    ``held`` are the least shingles of a set, or all; None where they don't decide.
    """
    need = prefix_length(size, percent) + votes_asked(size, percent) - 1
    at = np.minimum(np.searchsorted(hot, held), max(len(hot) - 1, 0))
    frequent = hot[at] == held if len(hot) else np.zeros(len(held), bool)
    cold = held[~frequent][:need]
    if len(cold) < need and len(held) < size:
        return None
    late = at[frequent]
    late = late[np.lexsort((hot[late], rows[late]))][: need - len(cold)] if len(hot) else late
    rest = hot[late] if len(hot) else held[:0]
    return np.concatenate([cold, rest]), np.repeat([False, True], [len(cold), len(rest)])


PREFIXES = "node binary, size long, grp binary, prefix array<long>, hot array<boolean>"


def _prefix_rows(nodes, sizes, found) -> pa.RecordBatch:
    from xxhash import xxh3_128_digest

    return pa.RecordBatch.from_arrays(
        [pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()),
         pa.array([f and xxh3_128_digest(n.to_bytes(8, "little") + f[0].tobytes())
                   for n, f in zip(sizes, found)], pa.binary()),
         pa.array([f and f[0].view(np.int64) for f in found], pa.list_(pa.int64())),
         pa.array([f and f[1] for f in found], pa.list_(pa.bool_()))],
        names=["node", "size", "grp", "prefix", "hot"],
    )


def prefixes(
    nodes: DataFrame, docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """Prefix and group of every node; ``hot`` tells which of its shingles are frequent."""
    held = docs.sparkSession.sparkContext.broadcast(hot_shingles(nodes))

    def from_low(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rows = held.value
        for batch in batches:
            sizes = batch.column("size").to_pylist()
            offsets = batch.column("low").offsets.to_numpy()
            low = batch.column("low").values.to_numpy().view(np.uint64)
            found = [prefix_of(low[a:b], n, hot, rows, percent)
                     for a, b, n in zip(offsets[:-1], offsets[1:], sizes)]
            yield _prefix_rows(batch.column("node").to_pylist(), sizes, found)

    def from_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, rows = held.value
        for batch in batches:
            for part in arrow_slices(batch, "text"):
                sets = [shingle_set(t.as_py(), shingle_words) for t in part.column("text")]
                found = [prefix_of(s, len(s), hot, rows, percent) for s in sets]
                yield _prefix_rows(part.column("node").to_pylist(), [len(s) for s in sets], found)

    first = materialize(nodes.select("node", "size", "low").mapInArrow(from_low, PREFIXES), "low_prefixes")
    done = first.filter("prefix is not null")
    deep = nodes.join(first.filter("prefix is null").select("node"), "node", "left_semi")
    rest = texts_of(deep, docs).mapInArrow(from_text, PREFIXES)
    found = materialize(done.unionByName(rest), "prefixes")
    discard(first)
    return found


def texts_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of ``nodes`` (node, doc_id, said), once each."""
    named = nodes.select("node", F.col("doc_id").alias("_doc"), F.col("said").alias("_said"))
    if named.count() <= BROADCAST_NODES:
        named = F.broadcast(named)
    met = _narrow(docs).join(
        named, (F.col("said") == F.col("_said")) & F.col("doc_id").eqNullSafe(F.col("_doc"))
    )
    return met.groupBy("node").agg(F.first("text").alias("text"))


def _shared(rows: DataFrame) -> DataFrame:
    """(token, rows, hot) of all prefix shingles that several groups of ``rows`` have."""
    tokens = rows.select(F.explode(F.arrays_zip("prefix", "hot")).alias("at")).select("at.prefix", "at.hot")
    return tokens.groupBy(F.col("prefix").alias("token")).agg(
        F.count(F.lit(1)).alias("rows"), F.max("hot").alias("hot")
    ).filter("rows > 1")


def _pruned(rows: DataFrame, percent: int) -> DataFrame:
    """``rows`` without shingles that one group alone has, and without groups that then have
    fewer than any link asks for.  A bitmap of hashes tells which are shared."""
    held = rows.sparkSession.sparkContext.broadcast(
        bitmap(_shared(rows).select(F.col("token").alias("g")))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column("size").to_numpy()
            lists = batch.column("prefix")
            offsets = lists.offsets.to_numpy().astype(np.int64)
            inside = slice(offsets[0], offsets[-1])
            token = lists.values.to_numpy()[inside]
            flat = [batch.column(c).values.to_numpy(zero_copy_only=False)[inside] for c in ("hot", "pos")]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(offsets))
            keep = marked(held.value, token.view(np.uint64))
            left = np.bincount(owner[keep], minlength=batch.num_rows)
            least = np.array([votes_asked(-(-percent * n // 100), percent) for n in sizes.tolist()], np.int64)
            stays = left >= least
            keep &= stays[owner]
            ends = pa.array(np.concatenate([[0], np.cumsum(left[stays])]).astype(np.int32))
            some = pa.array(np.nonzero(stays)[0])
            yield pa.RecordBatch.from_arrays(
                [batch.column("gid").take(some), batch.column("size").take(some),
                 *[pa.ListArray.from_arrays(ends, pa.array(x[keep])) for x in (token, *flat)]],
                names=["gid", "size", "prefix", "hot", "pos"],
            )

    schema = "gid long, size long, prefix array<long>, hot array<boolean>, pos array<int>"
    return materialize(rows.mapInArrow(run, schema), "pruned")


def postings(groups: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(token, salt, rows, gid, size, pos) of the prefix shingles that several groups share.

    ``groups`` has gid, size, prefix and hot.  Groups that share too few shingles for any
    link are left out, PRUNE_ROUNDS times, before lists are made.  The list of a frequent
    shingle is dealt over SALTS.
    """
    place = F.sequence(F.lit(0), F.size("prefix") - 1)
    rows = groups.select("gid", "size", "prefix", "hot", place.alias("pos"))
    for turn in range(PRUNE_ROUNDS):
        fewer = _pruned(rows, percent)
        if turn:
            discard(rows)
        rows = fewer
    index = rows.select("gid", "size", F.explode(F.arrays_zip("prefix", "hot", "pos")).alias("at")).select(
        F.col("at.prefix").alias("token"), "gid", "size", "at.pos",
        F.when(F.col("at.hot"), F.pmod(F.xxhash64("gid"), F.lit(SALTS)).cast("int")).otherwise(0).alias("salt"),
    )
    spread = _shared(rows).select("token", "rows", F.explode(_salts(F.col("hot"))).alias("salt"))
    met = materialize(index.join(spread, ["token", "salt"]), "postings")
    discard(rows)
    return met


def _salts(hot: Column) -> Column:
    return F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))


def _votes(size: Column, other: Column, percent: int) -> Column:
    """Prefix shingles that two linked sets of these sizes share at least.

    They share ``both`` or more in all, so a set of n misses at most n - both; of the two
    prefixes the one that ends first in the common order has all but these in the other.
    """
    both = F.call_function("div", (size + other) * percent + (99 + percent), F.lit(100 + percent))

    def held(n: Column) -> Column:
        prefix = n - F.call_function("div", n * percent + 99, F.lit(100)) + 1
        return prefix + F.call_function("div", prefix + 1, F.lit(2)) - 1 - n + both

    return F.greatest(F.least(held(size), held(other)), F.lit(1))


def _sizes_agree(one: Column, other: Column, percent: int) -> Column:
    return 100 * F.least(one, other) >= percent * F.greatest(one, other)


def star_pairs(met: DataFrame, classes: DataFrame, turn: int, percent: int = PERCENT) -> DataFrame:
    """(gid, leader): the group that most of a group's shingles name first among like sizes.

    Where fewer shingles name it than links share there is no leader.

    ``classes`` has gid, least and most: the smallest and largest class of its members.
    """
    step = F.floor(F.log("size") / F.lit(log(100 / percent)) + F.lit(turn / STAR_ROUNDS))
    rows = met.join(classes, "gid").withColumn("step", step)
    order = F.struct(F.xxhash64("gid", F.lit(turn)), "gid", "size", "least", "most")
    leaders = rows.groupBy("token", "step").agg(
        F.min(order).alias("first"), F.min("least").alias("from"), F.max("most").alias("to"),
        F.max("salt").alias("salts"),
    ).filter(F.col("from") < F.col("to"))
    spread = leaders.select(
        "token", "step", "first", F.explode(_salts(F.col("salts") > 0)).alias("salt")
    )
    asked = rows.join(spread, ["token", "step", "salt"]).filter(
        (F.col("gid") != F.col("first.gid"))
        & _sizes_agree(F.col("size"), F.col("first.size"), percent)
        & _may_differ("least", "most", "first.least", "first.most")
    )
    votes = asked.groupBy("gid", F.col("first.gid").alias("leader")).agg(
        F.count(F.lit(1)).alias("votes"), F.max(_votes(F.col("size"), F.col("first.size"), percent)).alias("need")
    ).filter("votes >= need")
    return votes.groupBy("gid").agg(F.max_by("leader", F.struct("votes", "leader")).alias("leader"))


def _may_differ(least: str, most: str, other_least: str, other_most: str) -> Column:
    """Whether two groups have members of different classes."""
    return F.least(F.col(least), F.col(other_least)) < F.greatest(F.col(most), F.col(other_most))


def sketches(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(gid, every, any): parity bits that all members of a group set, and those that any sets
    (null where these are the same)."""
    bits = [F.get("odd", F.lit(i)) for i in range(PARITY_BITS // 64)]
    both = members.select("node", "gid").join(nodes.select("node", "odd"), "node").groupBy("gid").agg(
        F.array(*[F.bit_and(x) for x in bits]).alias("every"), F.array(*[F.bit_or(x) for x in bits]).alias("any")
    )
    return both.select("gid", "every", F.when(F.col("every") != F.col("any"), F.col("any")).alias("any"))


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows, sorted by token, first and second, with no cell of these cut in two."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([*held, batch]).combine_chunks().to_batches()[0]
        fresh = np.nonzero(_fresh(rows))[0]
        held = [rows.slice(fresh[-1])]
        if fresh[-1]:
            yield rows.slice(0, fresh[-1])
    yield from held


def _fresh(rows: pa.RecordBatch) -> np.ndarray:
    """Whether a row begins a cell."""
    out = np.ones(rows.num_rows, bool)
    out[1:] = False
    for name in ("token", "first", "second"):
        key = rows.column(name).to_numpy()
        out[1:] |= key[1:] != key[:-1]
    return out


def _may_link(rows: pa.RecordBatch, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places of pairs of rows of a cell that may hold linked members of different classes,
    and by how many bits their parities differ.

    In a cell of two blocks those of the first are paired with those of the second.
    """
    size, pos, side, gid = (rows.column(c).to_numpy() for c in ("size", "pos", "side", "gid"))
    alone = rows.column("alone").to_numpy(zero_copy_only=False)
    least = np.frombuffer(b"".join(rows.column("least").to_pylist()), np.uint64).reshape(-1, 2)
    every = rows.column("every").flatten().to_numpy().view(np.uint64).reshape(rows.num_rows, -1)
    spread = np.nonzero(rows.column("any").is_valid().to_numpy(zero_copy_only=False))[0]
    some = every.copy() if len(spread) else every
    if len(spread):
        some[spread] = rows.column("any").flatten().to_numpy().view(np.uint64).reshape(len(spread), -1)

    fresh = _fresh(rows)
    start = np.nonzero(fresh)[0]
    cell = np.cumsum(fresh) - 1
    end = np.append(start[1:], rows.num_rows)[cell]
    middle = (start + np.add.reduceat((side == 0).astype(np.int64), start))[cell]
    diagonal = rows.column("first").to_numpy() == rows.column("second").to_numpy()
    begin = np.where(diagonal, np.arange(rows.num_rows) + 1, middle)
    count = np.where(side == 0, end - begin, 0)
    until = np.cumsum(count)
    for low in range(0, int(until[-1]), PAIRS_AT_ONCE):
        pair = np.arange(low, min(low + PAIRS_AT_ONCE, int(until[-1])))
        i = np.searchsorted(until, pair, "right")
        j = begin[i] + pair - (until[i] - count[i])
        one, other = size[i], size[j]
        both = (percent * (one + other) + 99 + percent) // (100 + percent)
        # Of the shingles before this one at most the shorter run is shared.
        most = np.minimum(pos[i], pos[j]) + 1 + np.minimum(one - pos[i], other - pos[j]) - 1
        same = alone[i] & alone[j] & (least[i] == least[j]).all(1)
        fit = (gid[i] != gid[j]) & ~same & (most >= both) & (
            100 * np.minimum(one, other) >= percent * np.maximum(one, other))
        i, j = i[fit], j[fit]
        if len(spread):
            odd = (every[i] & ~some[j]) | (every[j] & ~some[i])
        else:
            odd = every[i] ^ every[j]
        differ = np.bitwise_count(odd).sum(1, dtype=np.int64)
        near = (100 + percent) * differ <= (100 - percent) * (size[i] + size[j])
        if near.any():
            yield i[near], j[near], differ[near]


def _open(met: DataFrame, classes: DataFrame) -> DataFrame:
    """Postings of shingles whose groups are not all of one class, with their classes."""
    rows = met.drop("salt").join(classes, "gid")
    open_tokens = rows.groupBy("token").agg(
        F.min("least").alias("from"), F.max("most").alias("to")
    ).filter(F.col("from") < F.col("to")).select("token")
    return materialize(rows.join(open_tokens, "token", "left_semi"), "open")


def _compared_in_cells(cells: DataFrame, run, schema: str) -> DataFrame:
    order = ["token", "first", "second"]
    sent = cells.select(
        *order, "side", "gid", "size", "pos", "least", (F.col("least") == F.col("most")).alias("alone"), "every", "any"
    )
    return sent.repartition(*order).sortWithinPartitions(*order, "side").mapInArrow(run, schema)


def _blocks(rows: int) -> Column:
    return F.ceil(F.col("rows") / F.lit(rows)).cast("long")


def neighbour_pairs(
    rows: DataFrame, sketched: DataFrame, turn: int, percent: int = PERCENT
) -> DataFrame:
    """(one, other): for each group the NEAR_LINKS most alike by parity that it meets in the
    pieces of its posting lists, as far as they may link and are of different classes."""
    piece = F.pmod(F.xxhash64("gid", F.lit(turn)), _blocks(NEAR_ROWS))
    cells = rows.join(sketched, "gid").select(
        "*", piece.alias("first"), piece.alias("second"), F.lit(0).alias("side"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_cells(batches):
            gid = part.column("gid").to_numpy()
            for i, j, differ in _may_link(part, percent):
                order = np.lexsort((differ, i))
                i, j, differ = i[order], j[order], differ[order]
                place = np.arange(len(i))
                kept = place - np.searchsorted(i, i) < NEAR_LINKS
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x[kept]) for x in (gid[i], gid[j], differ)], names=["one", "other", "differ"])

    found = _compared_in_cells(cells, run, "one long, other long, differ long").distinct()
    first = Window.partitionBy("one").orderBy("differ", "other")
    return found.withColumn("at", F.row_number().over(first)).filter(F.col("at") <= NEAR_LINKS).select("one", "other")


def group_pairs(
    rows: DataFrame, sketched: DataFrame, percent: int = PERCENT
) -> DataFrame:
    """(one, other): pairs of groups of different classes that may hold linked members.

    ``rows`` are open postings and ``sketched`` the parities of each group.  A posting list of
    several blocks is dealt into a cell for each pair of blocks.
    """
    own = F.pmod(F.xxhash64("gid"), _blocks(BLOCK_ROWS))
    cells = rows.join(sketched, "gid").select(
        "*", own.alias("own"), F.explode(F.sequence(F.lit(0).cast("long"), _blocks(BLOCK_ROWS) - 1)).alias("with")
    ).select(
        "*", F.least("own", "with").alias("first"), F.greatest("own", "with").alias("second"),
        (F.col("own") > F.col("with")).cast("int").alias("side"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _whole_cells(batches):
            gid, size = (part.column(c).to_numpy() for c in ("gid", "size"))
            for i, j, _ in _may_link(part, percent):
                i, j = np.where(gid[i] < gid[j], i, j), np.where(gid[i] < gid[j], j, i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in (gid[i], gid[j], size[i], size[j])], names=["one", "other", "size", "_size"])

    votes = _compared_in_cells(cells, run, "one long, other long, size long, _size long").groupBy("one", "other").agg(
        F.count(F.lit(1)).alias("votes"), F.max(_votes(F.col("size"), F.col("_size"), percent)).alias("asked")
    )
    return votes.filter("votes >= asked").select("one", "other")


def compared(
    pairs: DataFrame, nodes: DataFrame, docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """The pairs (a, b) of ``nodes`` that link.

    Those whose parities tell that they don't are left out before any text is fetched.
    The first text of a block of pairs is held while the others pass by one at a time.
    """
    sides = {
        s: nodes.select(F.col("node").alias(s), F.col("odd").alias(f"odd_{s}"), F.col("size").alias(f"size_{s}"))
        for s in ("a", "b")
    }
    met = pairs.filter("a <> b").distinct().join(sides["a"], "a").join(sides["b"], "b").filter(
        _sizes_agree(F.col("size_a"), F.col("size_b"), percent)
        & _near("odd_a", "odd_b", F.col("size_a"), F.col("size_b"), percent)
    )
    pairs = materialize(met.select("a", "b"), "pairs")
    blocks = -(-pairs.count() // PAIRS_A_BLOCK)
    dealt = pairs.select("a", "b", F.pmod(F.xxhash64("b"), F.lit(max(blocks, 1))).alias("block"))
    first = dealt.select("a", "block").distinct().select("a", "block", F.lit(0).alias("side"), F.col("a").alias("node"))
    rest = dealt.select("a", "block", F.lit(1).alias("side"), F.col("b").alias("node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, held = None, None
        for batch in batches:
            for part in arrow_slices(batch, "text"):
                out = []
                for a, side, node, text in zip(*[part.column(c) for c in ("a", "side", "node", "text")]):
                    a, found = a.as_py(), shingle_set(text.as_py(), shingle_words)
                    if side.as_py() == 0:
                        name, held = a, found
                    elif name == a and linked(held, found, percent):
                        out.append((a, node.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[i] for x in out], pa.binary()) for i in range(2)], names=["a", "b"]
                )

    wanted = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    texts = texts_of(materialize(nodes.select("node", "doc_id", "said").join(wanted, "node", "left_semi"), "wanted"), docs)
    ordered = (
        first.unionByName(rest).join(texts, "node").select("a", "block", "side", "node", "text")
        .repartition("a", "block").sortWithinPartitions("a", "block", "side")
    )
    found = materialize(ordered.mapInArrow(run, "a binary, b binary"), "links")
    discard(pairs)
    return found


def node_links(
    nodes: DataFrame, docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(a, b): links among ``nodes`` whose components are those of all links."""
    members = prefixes(nodes, docs, shingle_words, percent)
    groups = materialize(members.groupBy("grp").agg(
        F.first("size").alias("size"), F.first("prefix").alias("prefix"), F.first("hot").alias("hot"),
        F.count(F.lit(1)).alias("n"), F.min("node").alias("first"),
    ).withColumn("gid", F.monotonically_increasing_id()), "groups")
    met = postings(groups, percent)
    crowded = groups.filter("n > 1").select("gid", F.col("first").alias("a"))
    in_play = met.select("gid").unionByName(crowded.select("gid")).distinct()
    named = groups.select("grp", "gid", "first").join(in_play, "gid", "left_semi")
    kept = materialize(members.select("node", "grp").join(named, "grp").select("node", "gid", "first"), "members")
    discard(members)

    links = None
    for turn in range(STAR_ROUNDS):
        named, classes = _classes(kept, links)
        firsts = kept.select(F.col("gid").alias("leader"), F.col("first").alias("a")).distinct()
        led = star_pairs(met, classes, turn, percent).join(firsts, "leader").select("gid", "a")
        if turn == 0:
            led = led.unionByName(crowded)
        pairs = led.join(kept, "gid").select("a", F.col("node").alias("b"))
        found = compared(pairs, nodes, docs, shingle_words, percent)
        links = found if links is None else materialize(links.unionByName(found), "links")

    sketched = materialize(sketches(kept, nodes), "sketches")
    firsts = [kept.select(F.col("gid").alias(g), F.col("first").alias(n)).distinct() for g, n in (("one", "a"), ("other", "b"))]
    for turn in range(NEAR_ROUNDS):
        named, classes = _classes(kept, links)
        rows = _open(met, classes)
        pairs = neighbour_pairs(rows, sketched, turn, percent).join(firsts[0], "one").join(firsts[1], "other")
        links = materialize(
            links.unionByName(compared(pairs.select("a", "b"), nodes, docs, shingle_words, percent)), "links")
        discard(rows)

    named, classes = _classes(kept, links)
    across = group_pairs(_open(met, classes), sketched, percent)
    within = classes.filter(F.col("least") < F.col("most")).select(
        F.col("gid").alias("one"), F.col("gid").alias("other"))
    left = named.select(F.col("gid").alias("one"), F.col("node").alias("a"), F.col("class").alias("ca"))
    right = named.select(F.col("gid").alias("other"), F.col("node").alias("b"), F.col("class").alias("cb"))
    pairs = across.unionByName(within).join(left, "one").join(right, "other").filter(
        (F.col("ca") != F.col("cb")) & ((F.col("one") != F.col("other")) | (F.col("a") < F.col("b")))
    ).select("a", "b")
    links = links.unionByName(compared(pairs, nodes, docs, shingle_words, percent))
    discard(met)
    discard(groups)
    return links


def _classes(members: DataFrame, links: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Members with the class their links so far give, and each group's least and largest class."""
    if links is None:
        named = members.withColumn("class", F.col("node"))
    else:
        roots = components(links).withColumnRenamed("node", "_node")
        named = members.join(roots, members["node"] == roots["_node"], "left").select(
            "node", "gid", F.coalesce("root", "node").alias("class")
        )
    named = materialize(named, "classes")
    return named, named.groupBy("gid").agg(F.min("class").alias("least"), F.max("class").alias("most"))


def similar_documents(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, percent: int = PERCENT
) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id, text)."""
    marked_rows = materialize(marks(docs, shingle_words, percent), "marks")
    row = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "said")).alias("row")
    nodes = materialize(
        marked_rows.filter("size > 0").groupBy("node").agg(
            F.first("size").alias("size"), F.first("low").alias("low"), F.first("odd").alias("odd"),
            F.min("doc_id").alias("least"), row
        ).select("node", "size", "low", "odd", "least", "row.doc_id", "row.said"),
        "nodes",
    )
    slim = materialize(marked_rows.select("doc_id", "node", "size"), "marks")
    discard(marked_rows)
    found = components(node_links(nodes, docs, shingle_words, percent)).withColumnRenamed("node", "_node")
    roots = nodes.join(found, nodes["node"] == found["_node"], "left").select(
        "node", "least", F.coalesce("root", "node").alias("root")
    )
    names = roots.groupBy("root").agg(F.min("least").alias("_least"))
    named = roots.join(names, "root").select(F.col("node").alias("_node"), "_least")
    whole = slim.filter("size > 0").join(named, F.col("node") == F.col("_node")).select(
        "doc_id", F.col("size").alias("n_shingles"), F.col("_least").alias("component_id"))
    empty = slim.filter("size = 0").select(
        "doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return whole.unionByName(empty)
