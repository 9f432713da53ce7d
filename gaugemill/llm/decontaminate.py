"""Benchmark decontamination: a broadcast set of test n-grams scanned over training text.

Texts become words (A-Z in lower case, everything else in ASCII but digits and letters
is a separator).  Every item gives its windows of ``window`` consecutive words, or one
window of all its words if it has fewer.  A task turns a document's words into the
numbers of the benchmark's vocabulary, rolls a hash over them, probes the set and then
compares the words themselves, so a hash alone never makes a hit.

The set is broadcast in blocks of at most SET_BYTES of item text, as arrays: about 30 bytes
a window and a dictionary of the distinct words.  A larger benchmark takes several passes over
the unchanged documents, one set at a time, and what all sets hit in a document is put
together before anything is decided or cut.  No item is left out, and results do not depend
on the blocks.

Defined results: a null text has no words; wordless items have no windows; an item with
a null id hits but is not listed; repeated items and rows are kept as they are, an item
id is listed once; other columns are ignored; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from gaugemill.llm.common import arrow_slices, materialize, sha256_hex

WINDOW = 10
SET_BYTES = 16 << 20
FILTER_BITS = 20

# Separators become spaces, A-Z become a-z; bytes of other code points stay.
_FOLD = bytes(
    b if chr(b).isdigit() or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32
    for b in range(256)
)


def fold_words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_FOLD).split()


class WindowSet:
    """Windows of a block of items, by width; probed with the words of a text.

    Items are one array of word numbers.  A window is a place in it; the places of one width
    are sorted by the hash of their words, and equal windows of several items stand together.
    """

    def __init__(self, items: Iterable[tuple[int | None, str | None]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        ids: list[int | None] = []
        lengths: list[int] = []
        parts = []
        for item_id, text in items:
            words = fold_words(text)
            if words:
                ids.append(item_id)
                lengths.append(len(words))
                parts.append(np.array(
                    [self.number.setdefault(w, len(self.number) + 1) for w in words], np.uint32))
        self.ids = ids
        self.words = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
        self.ends = np.cumsum(np.array(lengths, np.int64))
        length = np.array(lengths, np.int64)
        width_of = np.minimum(window, length)
        self.widths: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in np.unique(width_of).tolist():
            mine = np.nonzero(width_of == width)[0]
            count = length[mine] - width + 1
            first = np.repeat((self.ends - length)[mine], count)
            place = first + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            hashes = self._rolled(self.words.astype(np.uint64), width)[place]
            order = np.argsort(hashes, kind="stable")
            slots = np.zeros(1 << FILTER_BITS, bool)
            slots[(hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
            self.widths[width] = (slots, hashes[order], place[order].astype(np.int32))

    @staticmethod
    def _rolled(numbers: np.ndarray, width: int) -> np.ndarray:
        """Hash of the ``width`` numbers from every place on."""
        rolled = np.zeros(max(0, len(numbers) - width + 1), np.uint64)
        for k in range(width):
            rolled = rolled * np.uint64(0x9E3779B97F4A7C15) + numbers[k : k + len(rolled)]
        return (rolled ^ (rolled >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)

    def probe(self, words: list[bytes]) -> tuple[np.ndarray, set[int]]:
        """Which words lie inside an occurring window, and the items that own these windows."""
        hit = np.zeros(len(words) + 1, np.int64)
        items: set[int] = set()
        known = self.number.get
        numbers = np.array([known(w, 0) for w in words], np.uint64)
        outside = np.concatenate([[0], np.cumsum(numbers == 0)])
        for width, (slots, hashes, places) in self.widths.items():
            if len(words) < width:
                continue
            # A window with a word outside the vocabulary can't occur.
            maybe = np.nonzero(outside[width:] == outside[:-width])[0]
            if not len(maybe):
                continue
            asked = self._rolled(numbers, width)[maybe]
            fit = slots[(asked >> np.uint64(64 - FILTER_BITS)).astype(np.int64)]
            maybe, asked = maybe[fit], asked[fit]
            low, high = (np.searchsorted(hashes, asked, side) for side in ("left", "right"))
            for i, a, b in zip(maybe.tolist(), low.tolist(), high.tolist()):
                if a == b:
                    continue
                at = places[a:b].astype(np.int64)
                same = (self.words[at[:, None] + np.arange(width)] == numbers[i : i + width]).all(axis=1)
                if same.any():
                    hit[i] += 1
                    hit[i + width] -= 1
                    own = np.unique(np.searchsorted(self.ends, at[same], "right")).tolist()
                    items.update(self.ids[n] for n in own if self.ids[n] is not None)
        return np.cumsum(hit)[:-1] > 0, items


def item_blocks(benchmark: DataFrame, set_bytes: int = SET_BYTES) -> list[DataFrame]:
    """Blocks of items whose texts add up to ``set_bytes`` at most (or one longer item).

    Items are dealt by hash into as many buckets as the total asks for, with room to
    spare; a bucket that still is too large is cut along its running size.
    """
    sized = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"),
        F.col("text").cast("string").alias("text"),
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 64).alias("_size"),
    )
    total = sized.agg(F.sum("_size")).first()[0] or 0
    if total <= set_bytes:
        return [sized.select("item_id", "text")]
    buckets = int(4 * total // set_bytes)
    dealt = sized.withColumn("_bucket", F.pmod(F.xxhash64("item_id", "text"), F.lit(buckets)))
    running = Window.partitionBy("_bucket").orderBy("_size", "item_id", "text").rowsBetween(
        Window.unboundedPreceding, 0
    )
    cut = materialize(
        dealt.withColumn("_cut", F.floor(F.sum("_size").over(running) / F.lit(set_bytes // 2))), "items"
    )
    names = cut.select("_bucket", "_cut").distinct().collect()
    return [
        cut.filter((F.col("_bucket") == n[0]) & (F.col("_cut") == n[1])).select("item_id", "text")
        for n in names
    ]


def _window_set(block: DataFrame, window: int):
    items = ((r[0], r[1]) for r in block.toLocalIterator())
    return block.sparkSession.sparkContext.broadcast(WindowSet(items, window))


def _scan(docs: DataFrame, schema: str, row: Callable, sets: list) -> DataFrame:
    """Apply ``row(words, probe results)`` to every document; ``schema`` starts with its columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch, "text"):
                results = []
                for text in part.column("text"):
                    words = fold_words(text.as_py())
                    results.append(row(words, *sets[0].value.probe(words)))
                columns = list(zip(*results))
                names = part.schema.names + [x.split()[0] for x in schema.split(", ")]
                kept = [part.column(n) for n in part.schema.names]
                types = [pa.list_(pa.int64()) if "array" in x else
                         {"long": pa.int64(), "string": pa.string()}[x.split()[1]]
                         for x in schema.split(", ")]
                yield pa.RecordBatch.from_arrays(
                    kept + [pa.array(c, t) for c, t in zip(columns, types)], names=names
                )

    base = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{base}, {schema}")


def _item_digest(items: set[int]) -> str:
    return sha256_hex(",".join(sorted(map(str, items))))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  set_bytes: int = SET_BYTES) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    narrow = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    blocks = item_blocks(benchmark, set_bytes)
    if len(blocks) == 1:
        found = _scan(
            narrow, "n_words long, n_hit long, n_items long, items_sha256 string",
            lambda words, hit, items: (len(words), int(hit.sum()), len(items), _item_digest(items)),
            [_window_set(blocks[0], window)],
        )
        return found.drop("text").withColumn("contaminated", F.col("n_hit") > 0)
    spans = _spans_of_blocks(narrow, blocks, window)
    keyed = narrow.withColumn("_key", F.sha2(F.coalesce("text", F.lit("")), 256)).withColumn(
        "n_words", F.size(F.filter(F.split(_folded("text"), " "), lambda w: w != "")).cast("long")
    )
    merged = spans.groupBy(F.col("doc_id").alias("_doc"), F.col("_key").alias("_text")).agg(
        F.array_distinct(F.flatten(F.collect_set("hits"))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items"))).cast("array<string>")).alias("items"),
    )
    same = keyed["doc_id"].eqNullSafe(merged["_doc"]) & (keyed["_key"] == merged["_text"])
    return keyed.drop("text").join(merged, same, "left").select(
        "doc_id",
        "n_words",
        F.coalesce(F.size("hits"), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        F.col("hits").isNotNull().alias("contaminated"),
    )


def _folded(text: str):
    return F.regexp_replace(
        F.coalesce(F.col(text), F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", " "
    )


def _spans_of_blocks(narrow: DataFrame, blocks: list[DataFrame], window: int) -> DataFrame:
    """Hit word positions and items of each (doc_id, text) and block; documents without hits give no row."""
    keyed = narrow.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("_key"))
    parts = []
    for block in blocks:
        one = _window_set(block, window)
        found = _scan(
            keyed, "hits array<long>, items array<long>",
            lambda words, hit, items: (np.nonzero(hit)[0].tolist(), sorted(items)), [one],
        )
        parts.append(materialize(found.drop("text").filter(F.size("hits") > 0).distinct(), "hits"))
        one.destroy()
    return reduce(DataFrame.unionByName, parts)


def _with_hits(docs: DataFrame, blocks: list[DataFrame], window: int) -> DataFrame:
    """``docs`` with ``_hits``: positions of the words that any block hits, null for none."""
    doc, text = F.col("doc_id").cast("long"), F.col("text").cast("string")
    narrow = docs.select(doc.alias("doc_id"), text.alias("text"))
    merged = _spans_of_blocks(narrow, blocks, window).groupBy(
        F.col("doc_id").alias("_doc"), F.col("_key").alias("_text")
    ).agg(F.array_distinct(F.flatten(F.collect_set("hits"))).alias("_hits"))
    # Any name may be taken, so the columns go by their places.
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc, text = (F.col(f"c{docs.columns.index(c)}") for c in ("doc_id", "text"))
    key = F.sha2(F.coalesce(text.cast("string"), F.lit("")), 256)
    same = doc.cast("long").eqNullSafe(F.col("_doc")) & (key == F.col("_text"))
    return plain.join(merged, same, "left").select(*plain.columns, "_hits")


def _decided(docs: DataFrame, benchmark: DataFrame, window: int, set_bytes: int, whole: Callable) -> DataFrame:
    """``docs`` after ``whole(texts, hits)`` has given (keep, text) of every row.

    ``hits`` are the words of a text that any item's window covers.
    """
    schema, at = docs.schema, docs.columns.index("text")
    blocks = item_blocks(benchmark, set_bytes)
    one = _window_set(blocks[0], window) if len(blocks) == 1 else None
    rows = docs if one else _with_hits(docs, blocks, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in arrow_slices(batch.rename_columns([f"c{i}" for i in range(batch.num_columns)]), f"c{at}"):
                keep, texts = [], []
                given = [None] * part.num_rows if one else part.column(part.num_columns - 1).to_pylist()
                for text, places in zip(part.column(at).to_pylist(), given):
                    words = fold_words(text)
                    if one:
                        hit, _ = one.value.probe(words)
                    else:
                        hit = np.zeros(len(words), bool)
                        hit[places or []] = True
                    stays, text = whole(text, hit)
                    keep.append(stays)
                    texts.append(text)
                columns = [pa.array(texts, pa.string()) if i == at else part.column(i)
                           for i in range(len(schema.names))]
                kept = pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])
                yield kept.filter(pa.array(keep, pa.bool_())).rename_columns(schema.names)

    return rows.mapInArrow(run, schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                      max_share: float = 0.0, set_bytes: int = SET_BYTES) -> DataFrame:
    """The rows of ``docs`` of which at most ``max_share`` of the words are hit."""
    return _decided(docs, benchmark, window, set_bytes,
                    lambda text, hit: (bool(hit.sum() <= max_share * len(hit)), text))


def masked_text(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                set_bytes: int = SET_BYTES) -> DataFrame:
    """``docs`` with the hit spans cut out of ``text``; a null text stays null."""
    return _decided(docs, benchmark, window, set_bytes,
                    lambda text, hit: (True, text if text is None else cut_words(text, hit)))


def cut_spans(text: str, windows: WindowSet) -> str:
    """A text without the words that ``windows`` hit and what stands between two of them."""
    return cut_words(text, windows.probe(fold_words(text))[0])


def cut_words(text: str, hit: np.ndarray) -> str:
    """A text without its hit words and what stands between two of them."""
    raw = text.encode()
    folded = raw.translate(_FOLD)
    words = folded.split()
    if not hit.any():
        return text
    kept, at, end = [], 0, 0
    cutting = False
    for word, bad in zip(words, hit):
        start = folded.index(word, end)
        if bad and not cutting:
            kept.append(raw[at:start])
        if cutting and not bad:
            at = end
        cutting, end = bool(bad), start + len(word)
    if not cutting:
        kept.append(raw[at:])
    else:
        kept.append(raw[end:])
    return b"".join(kept).decode()
