"""Phrases that stick together: level-wise candidates counted by double-array tries.

Texts are lower-cased (A-Z), split into pieces at sentence punctuation and line ends, and
pieces into words.  Everything is counted per language.

1. *Words.*  All words of all texts are counted; frequent ones are phrases of one word.
2. *Candidates.*  A phrase of k words can be frequent only if both its parts of k - 1 words
   are.  Frequent phrases of one level set bits of a bitmap of fixed size by their hash;
   tasks look both parts of every text position up in it at once.  Occurrences that pass are
   first counted by hash bucket, and those of common buckets are tallied as phrases.  A hash
   that meets a set bit or a common bucket by chance adds a candidate, it loses none.
3. *Tries.*  Candidates of all levels form double-array tries over the digits of their
   words' numbers, in blocks of about BLOCK_PHRASES phrases by hash.  One pass over the texts
   tallies what begins at every position, as long as a bitmap of fixed size marks it, and
   sends it to the block of its hash.  The block's task moves the states of all that it gets
   one word further at a time (numpy gathers, no loop over positions) and counts accepting
   states with ``bincount``.  More blocks take more tasks, neither more passes nor memory.
4. *Scores.*  Cuts, containment and ranks are joins and windows over the counted phrases.

Words are carried as 64-bit hashes; should two different words (or languages) ever share
one, another seed is taken.  Scores are exact decimals of up to 38 digits.

Defined results: a null text is empty; a null language is ``und``; rows with null or
repeated ids count like others (``doc_id`` is not used), and other columns are ignored.
Ties in rank go by the phrase's UTF-8 bytes, so a rerun agrees.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from gaugemill.llm.common import arrow_slices, bitmap, marked, materialize

MAX_WORDS = 3
MIN_COUNT = 10
TOP = 2000
CONTAINED_PERCENT = 50
NO_LANG = "und"

# A block's trie is built and used by one task.
BLOCK_PHRASES = 1 << 14
TALLY_ROWS = 1 << 18
# Tallied phrases travel packed; an Arrow batch of 10,000 bodies has about 30 MB.
PACK_ROWS = 64
GATHER_ROWS = 1 << 17
# Occurrences that a part of a level's tally has at most, on average.
PART_BITS = 19
# Hashing a slice of 4 MB took 220 MB, one of 1 MB 36 MB (measured on 20 MB of texts).
SLICE_BYTES = 1 << 20
WIDE_NODE = 24
SLOT_BITS = 16
CHUNK_BITS = 8
RANK_PARTS = 16

# What ends a piece.
ENDS = b".,;:!?\n\x0b\x0c\r"
BREAK = b";"
_TABLE = bytes.maketrans(
    bytes(range(65, 91)) + ENDS, bytes(range(97, 123)) + BREAK * len(ENDS)
)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Words:
    """Words of many texts in order; an entry without hash stands between pieces and texts."""

    octets: bytes        # the folded texts, each with BREAK behind it
    hashes: np.ndarray   # of every word; 0 for a break
    starts: np.ndarray   # where every word lies in ``octets``
    ends: np.ndarray
    langs: np.ndarray    # hash of its text's language
    names: list[str]     # language of every text
    text: np.ndarray     # number of its text


class Hasher:
    """64-bit hashes of all words of a buffer at once.

    A word's hash is a polynomial of its octets' random values, taken from running sums by
    the inverse power of its place, so no word is looked at on its own.
    """

    def __init__(self, seed: int):
        draw = np.random.default_rng([13, seed])
        self.value = draw.integers(1, 2**63, 256, dtype=np.int64).astype(np.uint64)
        self.factor = int(draw.integers(1, 2**62)) * 2 + 1
        self.powers = self.inverse = np.ones(1, np.uint64)

    def _grown(self, n: int) -> None:
        if len(self.powers) < n:
            def run(factor: int) -> np.ndarray:
                steps = np.full(n, factor % 2**64, np.uint64)
                steps[0] = 1
                return np.cumprod(steps)

            self.powers, self.inverse = run(self.factor), run(pow(self.factor, -1, 2**64))

    def hashes(self, octets: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grown(len(octets) + 1)
        sums = np.zeros(len(octets) + 1, np.uint64)
        values = self.value[np.frombuffer(octets, np.uint8)]
        values *= self.powers[: len(octets)]
        np.cumsum(values, out=sums[1:])
        found = mixed((sums[ends] - sums[starts]) * self.inverse[starts])
        found[found == 0] = 1
        return found

    def of(self, name: str) -> int:
        octets = b"\x00" + name.encode()
        return int(self.hashes(octets, np.array([0]), np.array([len(octets)]))[0])

    def words(self, texts: list[str], names: list[str]) -> Words:
        parts = [t.encode() for t in texts]
        octets = (BREAK.join(parts) + BREAK).translate(_TABLE)
        view = np.frombuffer(octets, np.uint8)
        ends_piece = view == BREAK[0]
        inside = ~(ends_piece | (view == 32) | (view == 9))
        # The last octet is a break, so every word ends before it.
        starts = np.nonzero(inside & ~np.concatenate([[False], inside[:-1]]))[0]
        ends = np.nonzero(inside[:-1] & ~inside[1:])[0] + 1
        piece = np.cumsum(ends_piece, dtype=np.int32)[starts]
        rank = np.cumsum(np.concatenate([[0], np.diff(piece) > 0])[: len(starts)])
        place = np.arange(len(starts)) + rank
        n = int(place[-1]) + 2 if len(place) else 0
        last = np.cumsum([len(x) + 1 for x in parts])
        text_of = np.searchsorted(last, starts, "right")
        own = {x: self.of(x) for x in set(names)}
        lang_of = np.array([own[x] for x in names], np.uint64)

        def spread(values: np.ndarray) -> np.ndarray:
            out = np.zeros(n, values.dtype)
            out[place] = values
            return out

        return Words(octets, spread(self.hashes(octets, starts, ends)), spread(starts), spread(ends),
                     spread(lang_of[text_of]), names, spread(text_of))


def slices(batches: Iterator[pa.RecordBatch], hasher: Hasher) -> Iterator[Words]:
    """Words of texts in bounded slices."""
    for batch in batches:
        for part in arrow_slices(batch, "text", SLICE_BYTES):
            yield hasher.words(part.column("text").to_pylist(), part.column("lang").to_pylist())


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def longer(part: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase one word longer than ``part``."""
    return mixed(part * _FACTOR + word)


def _long(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def strings(octets: bytes, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """What stands in ``octets`` between starts and ends."""
    sizes = ends - starts
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.StringArray.from_buffers(
        len(sizes), pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.frombuffer(octets, np.uint8)[at]))


def word_counts(docs: DataFrame, seed: int) -> DataFrame:
    """(lang, word, l, h, n) of all words; l and h are the hashes of lang and word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Words by arrival; ``keys`` are the ascending hashes of language and word, ``place`` where each is held.
        held: list[tuple] = []
        keys, place, total = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)

        def told() -> pa.RecordBatch:
            names, texts, own, each = zip(*held)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(names), pa.concat_arrays(texts), _long(np.concatenate(own)),
                 _long(np.concatenate(each)), pa.array(total)],
                names=["lang", "word", "l", "h", "n"],
            )

        for words in slices(batches, Hasher(seed)):
            some = np.nonzero(words.hashes)[0]
            found, first, n = np.unique(
                longer(words.langs[some], words.hashes[some]), return_index=True, return_counts=True)
            at = np.searchsorted(keys, found)
            old = at < len(keys)
            old[old] = keys[at[old]] == found[old]
            total[place[at[old]]] += n[old]
            at, fresh = at[~old], some[first[~old]]
            held.append((pa.array(words.names, pa.string()).take(pa.array(words.text[fresh])),
                         strings(words.octets, words.starts[fresh], words.ends[fresh]),
                         words.langs[fresh], words.hashes[fresh]))
            place = np.insert(place, at, len(total) + np.arange(len(at)))
            keys = np.insert(keys, at, found[~old])
            total = np.append(total, n[~old])
            if len(keys) > 2 * TALLY_ROWS:
                yield told()
                keys, place, total = keys[:0], place[:0], total[:0]
        if held:
            yield told()

    counted = docs.mapInArrow(run, "lang string, word string, l long, h long, n long")
    return counted.groupBy("lang", "word").agg(
        F.first("l").alias("l"), F.first("h").alias("h"), F.sum("n").alias("n")
    )


def _ambiguous(words: DataFrame) -> bool:
    """Whether different words or languages share a hash."""
    pairs = words.groupBy("h").agg((F.min("word") < F.max("word")).alias("twice"))
    langs = words.groupBy("l").agg((F.min("lang") < F.max("lang")).alias("twice"))
    return not pairs.unionByName(langs, allowMissingColumns=True).filter("twice").isEmpty()


class Tally:
    """Counts of rows of numbers by their hash, in bounded memory; the commonest are held longest."""

    def __init__(self, width: int):
        # Bare hashes take less room.
        self.width, self.most = width, TALLY_ROWS * (2 if width else 4)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.rows = 0

    def add(self, hashes: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Count rows (n, width); yields (hashes, rows, counts) when there are too many."""
        if not len(hashes):
            return
        g, first, n = np.unique(hashes, return_index=True, return_counts=True)
        self.held.append((g, rows[first], n))
        self.rows += len(g)
        if self.rows > self.most:
            self._merge()
            if self.rows > self.most // 2:
                hashes, rows, n = self.held[0]
                place = self.rows - self.most // 4
                stay = n > np.partition(n, place)[place]
                self.held, self.rows = [(hashes[stay], rows[stay], n[stay])], int(stay.sum())
                yield hashes[~stay], rows[~stay], n[~stay]

    def _merge(self) -> None:
        hashes, rows, n = (np.concatenate(x) for x in zip(*self.held))
        g, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        total = np.bincount(back, n, len(g)).astype(np.int64)
        self.held, self.rows = [(g, rows[first], total)], len(g)

    def flush(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        if self.held:
            self._merge()
            yield self.held[0]
        self.held, self.rows = [], 0


class Level:
    """Occurrences of phrases of k words whose parts are frequent by a bitmap of hashes."""

    def __init__(self, bits: np.ndarray, k: int):
        self.bits, self.k = bits, k

    def occurrences(self, words: Words) -> tuple[np.ndarray, Callable[[np.ndarray], np.ndarray]]:
        """Hashes of all occurrences in a slice, and a function from some of them to their rows."""
        k = self.k
        h, lang = words.hashes, words.langs
        part = longer(lang, h)
        for step in range(1, k - 1):
            part = longer(part[:-1], h[step:])
        fit = marked(self.bits, part)
        # No word of the phrase is a break.
        for i in range(k - 1):
            fit &= h[i : len(h) - (k - 2) + i] > 0
        at = np.nonzero(fit[:-1] & fit[1:])[0]

        def rows(some: np.ndarray) -> np.ndarray:
            return np.column_stack([lang[at[some]], *[h[at[some] + i] for i in range(k)]])

        return longer(part[at], h[at + k - 1]), rows


PACKED = "part long, kind int, body binary"


def phrase_hashes(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows that have k words (language first, 0 fills up) and the hash of these, k = 1, 2 .."""
    at, g = np.arange(len(rows)), rows[:, 0]
    for k in range(1, rows.shape[1]):
        some = rows[at, k] > 0
        at, g = at[some], longer(g[some], rows[at[some], k])
        yield at, g


def packed(g: np.ndarray, rows: np.ndarray, parts: int, kind: int) -> pa.RecordBatch:
    """Rows of numbers, ascending by hash, in bodies of at most PACK_ROWS rows of one part."""
    part = ((g >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    first = np.nonzero(np.diff(part, prepend=-1))[0]
    pieces = -(-np.diff(first, append=len(part)) // PACK_ROWS)
    place = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(first, pieces) + PACK_ROWS * place
    columns = np.ascontiguousarray(rows.T)
    ends = np.append(starts[1:], len(part)).tolist()
    body = [columns[:, a:b].tobytes() for a, b in zip(starts.tolist(), ends)]
    return pa.RecordBatch.from_arrays(
        [pa.array(part[starts]), pa.array(np.full(len(body), kind, np.int32)), pa.array(body, pa.binary())],
        names=["part", "kind", "body"])


def unpacked(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """(part, kind, rows) in the order of the bodies, some GATHER_ROWS rows at once."""
    name, held, n = None, [], 0
    for batch in batches:
        for part, kind, body in zip(
            batch.column("part").to_pylist(), batch.column("kind").to_pylist(), batch.column("body")
        ):
            if held and (name != (part, kind) or n >= GATHER_ROWS):
                yield *name, np.concatenate(held, axis=1).T
                held, n = [], 0
            name = part, kind
            held.append(np.frombuffer(body.as_buffer(), np.uint64).reshape(width, -1))
            n += held[-1].shape[1]
    if held:
        yield *name, np.concatenate(held, axis=1).T


def dealt(bodies: DataFrame) -> DataFrame:
    return bodies.repartition("part").sortWithinPartitions("part", "kind")


def summed_rows(g: np.ndarray, rows: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different rows, with their hashes and sums; rows that share a hash stay apart."""
    _, first, back = np.unique(g, return_index=True, return_inverse=True)
    if (rows[first][back] != rows).any():
        _, first, back = np.unique(rows, axis=0, return_index=True, return_inverse=True)
    return g[first], rows[first], np.bincount(back.ravel(), n, len(first)).astype(np.int64)


def _buckets(hashes: np.ndarray, bits: int) -> np.ndarray:
    return hashes >> np.uint64(64 - bits)


def common_buckets(docs: DataFrame, bits: np.ndarray, k: int, seed: int, min_count: int, width: int) -> np.ndarray:
    """Bitmap of the hash buckets (2**width of them) that occur min_count times in all texts.

    Tasks send counted buckets packed by their upper bits, three bytes each; counts beyond
    min_count are of no interest.  A chunk has pages of 2**16 buckets: first how many entries
    each page has, then the entries.  There are at most 2**CHUNK_BITS chunks, however many
    buckets, so the rows that a task sends grow with its texts alone.
    """
    low_bits = max(16, width - CHUNK_BITS)
    pages = 1 << (low_bits - 16)
    held = docs.sparkSession.sparkContext.broadcast(bits)
    kind = np.dtype([("low", "<u2"), ("n", "<u1" if min_count < 256 else "<u4")])

    def tallied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, tally = Level(held.value, k), Tally(0)

        def packed(at, _, n) -> pa.RecordBatch:
            entries = np.empty(len(at), kind)
            entries["low"] = at & np.uint64(0xFFFF)
            entries["n"] = np.minimum(n, min_count)
            page = (at >> np.uint64(16)).astype(np.int64)
            chunk = page // pages
            fresh = np.concatenate([[True], chunk[1:] != chunk[:-1]])
            first = np.nonzero(fresh)[0]
            place = (np.cumsum(fresh) - 1) * pages + page % pages
            sizes = np.bincount(place, minlength=len(first) * pages).astype("<u4").reshape(-1, pages)
            ends = np.append(first, len(at))
            body = [sizes[i].tobytes() + entries[ends[i] : ends[i + 1]].tobytes() for i in range(len(first))]
            return pa.RecordBatch.from_arrays(
                [pa.array(chunk[first]), pa.array(body, pa.binary())], names=["chunk", "entries"])

        for words in slices(batches, Hasher(seed)):
            at = _buckets(level.occurrences(words)[0], width)
            for found in tally.add(at, np.zeros((len(at), 0), np.uint64)):
                yield packed(*found)
        for found in tally.flush():
            yield packed(*found)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, total = -1, np.zeros(1 << low_bits, np.int64)

        def told() -> pa.RecordBatch:
            common = np.nonzero(total >= min_count)[0].astype(np.uint64) + np.uint64(max(name, 0) << low_bits)
            return pa.RecordBatch.from_arrays([_long(mixed(common))], names=["g"])

        for batch in batches:
            for chunk, entries in zip(batch.column("chunk").to_pylist(), batch.column("entries")):
                if chunk != name:
                    yield told()
                    name = chunk
                    total[:] = 0
                raw = entries.as_buffer()
                sizes = np.frombuffer(raw, "<u4", pages)
                found = np.frombuffer(raw, kind, offset=sizes.nbytes)
                total[np.repeat(np.arange(pages) << 16, sizes) + found["low"]] += found["n"]
        yield told()

    common = (
        docs.mapInArrow(tallied, "chunk long, entries binary")
        .repartition("chunk").sortWithinPartitions("chunk")
        .mapInArrow(summed, "g long")
    )
    return bitmap(common)


def next_level(
    docs: DataFrame, frequent: DataFrame, k: int, seed: int, min_count: int, width: int
) -> DataFrame:
    """(l, h1 .. hk, g): phrases of k words that occur min_count times, parts being frequent.

    ``frequent`` has the hashes ``g`` of the phrases of k - 1 words.
    """
    bits = bitmap(frequent.select("g"))
    common = common_buckets(docs, bits, k, seed, min_count, width)
    held = docs.sparkSession.sparkContext.broadcast((bits, common))
    names = ["l", *[f"h{i}" for i in range(1, k + 1)]]

    parts = 1 << max(6, width - PART_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks, buckets = held.value
        level, tally = Level(marks, k), Tally(k + 1)

        def batch_of(g, rows, n) -> pa.RecordBatch:
            return packed(g, np.column_stack([rows, n.astype(np.uint64)]), parts, 0)

        for words in slices(batches, Hasher(seed)):
            g, rows = level.occurrences(words)
            some = np.nonzero(marked(buckets, mixed(_buckets(g, width))))[0]
            for found in tally.add(g[some], rows(some)):
                yield batch_of(*found)
        for found in tally.flush():
            yield batch_of(*found)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, found in groupby(unpacked(batches, k + 2), key=lambda x: x[0]):
            table = np.concatenate([x for _, _, x in found])
            *_, (_, g) = phrase_hashes(table[:, :-1])
            g, rows, n = summed_rows(g, table[:, :-1], table[:, -1])
            some = n >= min_count
            yield pa.RecordBatch.from_arrays(
                [*[_long(rows[some, i]) for i in range(k + 1)], _long(g[some])], names=[*names, "g"])

    schema = ", ".join(f"{c} long" for c in [*names, "g"])
    return materialize(dealt(docs.mapInArrow(run, PACKED)).mapInArrow(summed, schema), "candidates")


@dataclass
class Trie:
    """Double-array trie over three-digit symbols (base 256) of languages and words.

    State 0 is dead and state 1 the root.  From a state ``s`` digit ``d`` leads to
    ``base[s] + d`` if ``check`` of that slot is ``s``.
    """

    hashes: np.ndarray   # ascending hashes of all symbols, the largest value last
    starts: np.ndarray   # place of the first hash of every slot of upper bits
    longest: int         # hashes to look at in a slot, the next one's first included
    numbers: np.ndarray  # their numbers, the commonest first
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray    # phrase of an accepting state, -1 elsewhere
    phrases: int

    @staticmethod
    def build(rows: np.ndarray) -> Trie:
        """Trie of phrases (n, 1 + words) of hashes; 0 fills up shorter ones."""
        hashes, back, uses = np.unique(rows, return_inverse=True, return_counts=True)
        uses[hashes == 0] = 0
        numbers = np.empty(len(hashes), np.int64)
        numbers[np.argsort(-uses, kind="stable")] = np.arange(len(hashes))
        symbols = numbers[back.reshape(rows.shape)]
        used = rows != 0
        node = np.ones(len(rows), np.int64)
        parents, digits, children, nodes = [], [], [], 2
        for column in range(rows.shape[1]):
            for shift in (16, 8, 0):
                live = np.nonzero(used[:, column])[0]
                key = node[live] * 256 + (symbols[live, column] >> shift & 255)
                edges, index = np.unique(key, return_inverse=True)
                parents.append(edges // 256)
                digits.append(edges % 256)
                children.append(nodes + np.arange(len(edges)))
                node[live] = nodes + index
                nodes += len(edges)
        parent, digit, child = (np.concatenate(x) for x in (parents, digits, children))
        base_of, size = _placed(parent, digit, nodes)
        place = np.zeros(nodes, np.int64)
        place[1] = 1
        place[child] = base_of[parent] + digit
        base = np.full(size, size - 256, np.int32)
        check = np.full(size, -1, np.int32)
        value = np.full(size, -1, np.int32)
        base[place[1:]] = base_of[1:]
        check[place[child]] = place[parent]
        value[place[node]] = np.arange(len(rows))
        most = np.iinfo(np.uint64).max
        upper = (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        starts = np.searchsorted(upper, np.arange(1 << SLOT_BITS)).astype(np.int32)
        longest = int(np.bincount(upper, minlength=1).max(initial=0)) + 1
        return Trie(np.append(hashes, most), starts, longest, np.append(numbers, -1).astype(np.int32),
                    base, check, value, len(rows))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Numbers of hashes, -1 for those (and breaks) that no phrase has."""
        bits = np.uint64(64 - SLOT_BITS)
        low = self.starts[(hashes >> bits).astype(np.int64)]
        out = np.full(len(hashes), -1, np.int32)
        todo = np.arange(len(hashes))
        for _ in range(self.longest):
            same = self.hashes[low] == hashes[todo]
            out[todo[same]] = self.numbers[low[same]]
            go = ~same & (self.hashes[low] < hashes[todo])
            todo, low = todo[go], low[go] + 1
        out[hashes == 0] = -1
        return out

    def advance(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        """States one symbol further, all at once."""
        states = np.where(symbols < 0, 0, states)
        for shift in (16, 8, 0):
            to = self.base[states] + (symbols >> shift & 255)
            states = np.where(self.check[to] == states, to, 0)
        return states

    def spelled(self, rows: np.ndarray) -> np.ndarray:
        """The phrase that every row of hashes is, -1 for none; 0 fills up shorter rows."""
        states = np.ones(len(rows), np.int64)
        for column in rows.T:
            live = np.nonzero((column > 0) & (states > 0))[0]
            states[live] = self.advance(states[live], self.symbols(column[live]))
        return self.value[states]

    def counts(self, symbols: np.ndarray, starts: np.ndarray, words: int) -> np.ndarray:
        """How often every phrase begins at a position of ``symbols``."""
        found = list(self.met(symbols, starts, words))
        return np.bincount(np.concatenate(found), minlength=self.phrases)

    def met(self, symbols: np.ndarray, starts: np.ndarray, words: int) -> Iterator[np.ndarray]:
        """The phrases that begin at positions of ``symbols``, those of each length in turn."""
        at, states = np.arange(len(symbols)), starts
        for step in range(words):
            inside = at + step < len(symbols)
            at, states = at[inside], states[inside]
            states = self.advance(states, symbols[at + step])
            live = states > 0
            at, states = at[live], states[live]
            found = self.value[states]
            yield found[found >= 0]


def _placed(parent: np.ndarray, digit: np.ndarray, nodes: int) -> tuple[np.ndarray, int]:
    """Bases under which no two edges share a slot, and the size of the table.

    Nodes of many edges get rows of their own.  All others draw a place, many at a time;
    who meets a taken slot or another's draws again.
    """
    order = np.argsort(parent, kind="stable")
    parent, digit = parent[order], digit[order]
    owner, first, width = np.unique(parent, return_index=True, return_counts=True)
    base = np.full(nodes, -1, np.int64)
    wide = owner[width > WIDE_NODE]
    # Slots 0 and 1 are the dead state and the root; the last 256 slots stay empty.
    room = 256 * (len(wide) + 1) + 3 * len(parent) + 1024
    taken = np.zeros(room + 256, bool)
    taken[:2] = True
    base[wide] = 256 * (1 + np.arange(len(wide)))
    mine = base[parent] >= 0
    taken[base[parent[mine]] + digit[mine]] = True
    narrow = np.nonzero(width <= WIDE_NODE)[0]
    narrow = narrow[np.argsort(-width[narrow], kind="stable")]
    draw = np.random.default_rng(1)
    claim = np.zeros(len(taken), np.int32)
    step = max(1024, room // 64)
    while len(narrow):
        some, later = narrow[:step], narrow[step:]
        n = width[some]
        edge = np.repeat(first[some] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        at = draw.integers(2, room - 256, len(some))
        slot = np.repeat(at, n) + digit[edge]
        who = np.repeat(np.arange(len(some)), n)
        claim[slot] = who
        lost = taken[slot] | (claim[slot] != who)
        won = np.bincount(who, lost, len(some)) == 0
        base[owner[some[won]]] = at[won]
        taken[slot[won[who]]] = True
        narrow = np.concatenate([some[~won], later])
    base[base < 0] = room
    return base, room + 256


def begun(words: Words, bits: np.ndarray, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes and rows of what begins at all positions, 1 to ``most`` words as long as ``bits`` marks it."""
    h = words.hashes
    at = np.nonzero(h)[0]
    g = longer(words.langs[at], h[at])
    for k in range(1, most + 1):
        fit = marked(bits, g)
        at, g = at[fit], g[fit]
        rows = np.zeros((len(at), most + 1), np.uint64)
        rows[:, 0] = words.langs[at]
        for i in range(k):
            rows[:, i + 1] = h[at + i]
        yield g, rows
        # The last entry of a slice is a break, so a word has an entry behind it.
        some = np.nonzero(h[at + k] > 0)[0] if k < most else []
        at, g = at[some], longer(g[some], h[at[some] + k])


def counted(docs: DataFrame, candidates: DataFrame, words: int, seed: int) -> DataFrame:
    """(id, f): occurrences of every candidate (id, l, h1 ..), one pass over the texts for all blocks."""
    blocks = max(1, -(-candidates.count() // BLOCK_PHRASES))
    names = ["l", *[f"h{i}" for i in range(1, words + 1)]]
    keys = candidates.select(*[F.coalesce(c, F.lit(0)).alias(c) for c in names], "id")

    def numbers(batch: pa.RecordBatch) -> np.ndarray:
        return np.column_stack([batch.column(c).to_numpy() for c in [*names, "id"]]).view(np.uint64)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, g in phrase_hashes(numbers(batch)[:, :-1]):
                yield pa.RecordBatch.from_arrays([_long(np.unique(g))], names=["g"])

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_back: list[np.ndarray] = []

        def told() -> pa.RecordBatch:
            table = np.concatenate(held_back)
            held_back.clear()
            whole = np.zeros(len(table), np.uint64)
            for at, g in phrase_hashes(table[:, :-1]):
                whole[at] = g
            order = np.argsort(whole, kind="stable")
            return packed(whole[order], table[order], blocks, 0)

        for batch in batches:
            held_back.append(numbers(batch))
            if sum(map(len, held_back)) > TALLY_ROWS:
                yield told()
        if held_back:
            yield told()

    held = docs.sparkSession.sparkContext.broadcast(bitmap(keys.mapInArrow(marks, "g long")))

    def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(words + 1)

        def batch_of(g, rows, n) -> pa.RecordBatch:
            return packed(g, np.column_stack([rows, n.astype(np.uint64)]), blocks, 1)

        for each in slices(batches, Hasher(seed)):
            for g, rows in begun(each, held.value, words):
                for found in tally.add(g, rows):
                    yield batch_of(*found)
        for found in tally.flush():
            yield batch_of(*found)

    both = keys.mapInArrow(keyed, PACKED).unionByName(docs.mapInArrow(scanned, PACKED))
    found = dealt(both).mapInArrow(lambda batches: _block_counts(batches, words), "id long, f long")
    return materialize(found, "counts")


def _block_counts(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """(id, f) of blocks, each of which has its candidates first and then what the texts have."""
    for _, tables in groupby(unpacked(batches, words + 2), key=lambda x: x[0]):
        own, trie, total = [], None, None
        for _, kind, table in tables:
            if kind == 0:
                own.append(table)
                continue
            if not own:
                continue
            if trie is None:
                keys = np.concatenate(own)
                trie, total = Trie.build(keys[:, :-1]), np.zeros(len(keys), np.int64)
            at = trie.spelled(table[:, :-1])
            met = at >= 0
            total += np.bincount(at[met], table[met, -1], len(total)).astype(np.int64)
        if trie is not None:
            some = np.nonzero(total)[0]
            yield pa.RecordBatch.from_arrays([_long(keys[some, -1]), pa.array(total[some])], names=["id", "f"])


def phrase_counts(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT
) -> tuple[DataFrame, DataFrame]:
    """(l, key, f) of all phrases of 1 to max_words words with f >= min_count, and all words.

    ``key`` is the array of the words' hashes.
    """
    texts = docs.select(
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
    )
    seed = 0
    words = materialize(word_counts(texts, seed), "words")
    while _ambiguous(words):
        seed += 1
        words = materialize(word_counts(texts, seed), "words")
    # Fewer occurrences than buckets; a chunk of buckets is summed at once.
    width = max(20, int(words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]).bit_length())
    level = words.filter(F.col("n") >= min_count).select("l", F.col("h").alias("h1"))
    levels = [level]
    frequent = level.select(_hash_of("l", "h1").alias("g"))
    for k in range(2, max_words + 1):
        level = next_level(texts, frequent, k, seed, min_count, width)
        frequent = level.select("g")
        levels.append(level.drop("g"))
    candidates = levels[0]
    for more in levels[1:]:
        candidates = candidates.unionByName(more, allowMissingColumns=True)
    candidates = materialize(candidates.withColumn("id", F.monotonically_increasing_id()), "phrases")
    key = F.array_compact(F.array(*[f"h{i}" for i in range(1, max_words + 1)])).alias("key")
    found = candidates.join(counted(texts, candidates, max_words, seed), "id").select("l", key, "f")
    return materialize(found.filter(F.col("f") >= min_count), "frequent"), words


def _hash_of(lang: str, word: str) -> Column:
    """``longer(lang, word)`` of two columns, in the tasks' own arithmetic."""

    @F.pandas_udf("long")
    def run(a, b):
        import pandas as pd

        one, other = (x.to_numpy(np.int64).view(np.uint64) for x in (a, b))
        return pd.Series(longer(one, other).view(np.int64))

    return run(lang, word)


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(10**6 a**2 / (left right)), exact for counts of up to 15 digits."""
    wide = "decimal(15,0)"
    above = a.cast(wide) * a.cast(wide) * F.lit(1_000_000).cast("decimal(7,0)")
    return F.call_function("div", above, left.cast(wide) * right.cast(wide))


def collocations(
    docs: DataFrame, max_words: int = MAX_WORDS, min_count: int = MIN_COUNT, top: int = TOP,
    contained_percent: int = CONTAINED_PERCENT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's ``top`` phrases."""
    phrases, words = phrase_counts(docs, max_words, min_count)
    size = F.size("key")
    several = phrases.filter(size > 1).select("l", "key", F.col("f").alias("a"))

    spans = F.flatten(F.transform(
        F.sequence(F.lit(2), size - 1),
        lambda n: F.transform(F.sequence(F.lit(1), size - n + 1), lambda i: F.slice("key", i, n)),
    ))
    inner = phrases.filter(size > 2).select("l", F.explode(spans).alias("key"), "f")
    covering = inner.groupBy("l", "key").agg(F.max("f").alias("outer"))
    kept = several.join(covering, ["l", "key"], "left").filter(
        F.col("outer").isNull() | (100 * F.col("outer") < contained_percent * F.col("a"))
    ).drop("outer")

    cuts = kept.select("l", "key", "a", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "l", "key", "a", "k", F.slice("key", F.lit(1), F.col("k")).alias("_first"),
        F.slice("key", F.col("k") + 1, F.size("key") - F.col("k")).alias("_rest"),
    )
    side = {
        name: phrases.select("l", F.col("key").alias(f"_{name}"), F.col("f").alias(f"{name}_f"))
        for name in ("first", "rest")
    }
    cuts = cuts.join(side["first"], ["l", "_first"]).join(side["rest"], ["l", "_rest"])
    scored = cuts.withColumn("score", score(F.col("a"), F.col("first_f"), F.col("rest_f")))
    best = scored.groupBy("l", "key", "a").agg(
        F.min(F.struct("score", "k", "first_f", "rest_f")).alias("best")
    ).select("l", "key", "a", "best.score", "best.first_f", "best.rest_f")

    # Phrases that may be among the first, ties included; only these are spelled out.  A
    # language's phrases are first ranked in RANK_PARTS parts, so no task sorts them all.
    near = best.withColumn("part", F.pmod(F.xxhash64("key"), F.lit(RANK_PARTS)))
    for keys in (["l", "part"], ["l"]):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.desc("a"))
        near = near.withColumn("at", F.rank().over(order)).filter(F.col("at") <= top).drop("at")
    near = materialize(near.drop("part"), "near")
    spelled = near.select("*", F.posexplode("key").alias("pos", "h")).join(
        words.select("l", "h", "word"), ["l", "h"]
    )
    named = spelled.groupBy("l", "key", "a", "score", "first_f", "rest_f").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ")
        .alias("phrase")
    )
    langs = words.groupBy("l").agg(F.first("lang").alias("lang"), F.sum("n").alias("n"))
    last = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = named.join(langs, "l").withColumn("rank", F.row_number().over(last)).filter(F.col("rank") <= top)
    return ranked.select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("first_f").alias("l"),
        F.col("rest_f").alias("r"), "n", "score",
    )
