"""Token ids of documents in Simple-8b blocks.

Documents are dealt into ranges of ``doc_id``, tokenised where they lie and written
as chunks.  A chunk is one row of a Parquet file: which documents it holds, how many
ids each has, and one binary payload.  All numbers in a payload are little-endian:

====================  =====================================================
``GS8B``              magic, then u32 ids per block
u64 x 3               ids, words, escapes
u32 x (blocks + 1)    word offset of every block
u64 x words           Simple-8b words: 4-bit selector, 60 bits of ids
u64 x escapes         ids of more than 60 bits; their word holds the index here
====================  =====================================================

A word's selector names how many ids of which width it packs.  Blocks start on a word
boundary, so any block is decoded on its own and all blocks at once, without a loop
over words.

Defined results: a null text is empty; every document gets its end id, so an empty
text has one id.  Rows with a null ``doc_id`` come first; repeated ids are kept, in
order of their texts.  Other columns are ignored.  An empty table gives an empty file
set and no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from gaugemill.llm.common import arrow_slices
from gaugemill.session import scratch_path

# Fixed values of the coding: ids per word and bits per id, by selector.  Selector 0
# is the escape; selector 15 stands for a run of zeros.
COUNTS = np.array([1, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60, 120])
WIDTHS = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1, 0])

MAGIC = b"GS8B"
BLOCK_IDS = 256
# Words of a memo's generation; two generations are held.
MEMO_ENTRIES = 300_000

FILE_SCHEMA = (
    "shard int, chunk int, local_start long, n_ids long, "
    "doc_ids array<long>, n_tokens array<long>, payload binary"
)


def encode_ids(ids: np.ndarray, block_ids: int = BLOCK_IDS) -> bytes:
    """Pack unsigned 64-bit ids; greedy within each block, all blocks side by side."""
    ids = np.ascontiguousarray(ids)
    # Ids of common tokenizers fit 16 bits; they are moved about at that width.
    small = not ids.size or int(ids.max()) < len(_SMALL_BITS)
    kind = np.uint16 if small else np.uint64
    n = len(ids)
    blocks = -(-n // block_ids)
    row = block_ids + int(COUNTS.max())
    grid = np.zeros((blocks, row), kind)
    bits = np.zeros((blocks, row), np.uint8)
    fill = np.zeros(blocks * block_ids, kind)
    fill[:n] = ids
    grid[:, :block_ids] = fill.reshape(blocks, block_ids)
    bits[:, :block_ids] = _bit_length(grid[:, :block_ids])
    selector = _widest_word(bits, block_ids)

    length = np.full(blocks, block_ids)
    if n % block_ids:
        length[-1] = n % block_ids
    at = np.zeros(blocks, np.int64)
    live = np.arange(blocks)
    steps = []
    while len(live):
        chosen = selector[live, at[live]]
        steps.append((live, at[live], chosen))
        at[live] += COUNTS[chosen]
        live = live[at[live] < length[live]]

    words_per_block = np.zeros(blocks, np.int64)
    for owners, _, _ in steps:
        words_per_block[owners] += 1
    offsets = np.concatenate([[0], np.cumsum(words_per_block)])
    words = np.zeros(offsets[-1], np.uint64)
    owner = np.concatenate([owners for owners, _, _ in steps] or [live])
    first = np.concatenate([starts for _, starts, _ in steps] or [live])
    chosen = np.concatenate([picks for _, _, picks in steps] or [live])
    rank = np.repeat(np.arange(len(steps)), [len(owners) for owners, _, _ in steps])
    place = offsets[owner] + rank
    flat = grid.reshape(-1)
    first = owner * row + first
    escapes = flat[first[chosen == 0]].astype(np.uint64)
    words[place[chosen == 0]] = np.arange(len(escapes), dtype=np.uint64)
    for s in range(1, len(COUNTS)):
        mine = np.nonzero(chosen == s)[0]
        if not len(mine):
            continue
        begin = first[mine]
        packed = np.full(len(mine), s, np.uint64) << np.uint64(60)
        for lane in range(COUNTS[s] if WIDTHS[s] else 0):
            packed |= flat[begin + lane].astype(np.uint64) << np.uint64(lane * WIDTHS[s])
        words[place[mine]] = packed
    head = MAGIC + np.array([block_ids], "<u4").tobytes()
    head += np.array([n, len(words), len(escapes)], "<u8").tobytes()
    return b"".join([head, offsets.astype("<u4").tobytes(), words.astype("<u8").tobytes(),
                     escapes.astype("<u8").tobytes()])


def decode_ids(payload: bytes) -> np.ndarray:
    """All ids of a payload; one pass per selector, not per word."""
    if payload[:4] != MAGIC:
        raise ValueError("not a block payload")
    block_ids = int(np.frombuffer(payload, "<u4", 1, 4)[0])
    n, n_words, n_escapes = (int(x) for x in np.frombuffer(payload, "<u8", 3, 8))
    blocks = -(-n // block_ids)
    offsets = np.frombuffer(payload, "<u4", blocks + 1, 32).astype(np.int64)
    base = 32 + 4 * (blocks + 1)
    words = np.frombuffer(payload, "<u8", n_words, base)
    escapes = np.frombuffer(payload, "<u8", n_escapes, base + 8 * n_words)
    if not n:
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    row = block_ids + int(COUNTS.max())
    owner = np.repeat(np.arange(blocks), np.diff(offsets))
    ends = np.cumsum(COUNTS[selector])
    before = ends - COUNTS[selector]
    target = owner * row + before - before[offsets[:-1]][owner]
    out = np.zeros(blocks * row, np.uint64)
    for s in np.unique(selector):
        mine = selector == s
        if s == 0:
            index = (words[mine] & np.uint64((1 << 60) - 1)).astype(np.int64)
            out[target[mine]] = escapes[index]
        elif WIDTHS[s]:
            lanes = np.arange(COUNTS[s])
            mask = np.uint64((1 << int(WIDTHS[s])) - 1)
            values = (words[mine][:, None] >> (lanes.astype(np.uint64) * np.uint64(WIDTHS[s]))) & mask
            out[target[mine][:, None] + lanes] = values
    return out.reshape(blocks, row)[:, :block_ids].reshape(-1)[:n]


_SMALL_BITS = np.array([x.bit_length() for x in range(1 << 16)], np.uint8)


def _bit_length(values: np.ndarray) -> np.ndarray:
    if values.dtype == np.uint16:
        return _SMALL_BITS[values]
    width = np.zeros(values.shape, np.uint8)
    rest = values.copy()
    for step in (48, 32, 16):
        high = rest >> np.uint64(step) > 0
        width[high] += step
        rest[high] >>= np.uint64(step)
    return width + _SMALL_BITS[rest.astype(np.uint16)]


def _widest_word(bits: np.ndarray, block_ids: int) -> np.ndarray:
    """Selector that packs the most ids from each position on."""
    widest = int(bits.max(initial=0))
    # The narrowest word that takes every id; without escapes no wider one is of use.
    start = max(int(np.count_nonzero(WIDTHS[1:] >= widest)), 1)
    selector = np.where(bits[:, :block_ids] > 60, np.int8(0), np.int8(start if widest <= 60 else 1))
    span, most = 1, bits
    for s in range(start + 1 if widest <= 60 else 2, len(COUNTS)):
        if most.size and most.min() > WIDTHS[s]:
            break
        count = int(COUNTS[s])
        while span * 2 <= count:
            most = np.maximum(most[:, : most.shape[1] - span], most[:, span:])
            span *= 2
        window = np.maximum(most[:, :block_ids], most[:, count - span : count - span + block_ids])
        selector[window <= WIDTHS[s]] = s
    return selector


class _Memo(dict):
    """Ids by word; a word that is not held is encoded when it is asked for."""

    def __init__(self, encoded: Callable[[str], bytes]):
        super().__init__()
        self.encoded = encoded

    def __missing__(self, word: str) -> bytes:
        ids = self[word] = self.encoded(word)
        return ids


class Encoder:
    """Ids of whole texts by a ``tokenizers`` file; a distinct word is encoded once while it is held.

    The tokenizer drops white space and never joins across it, so the ids of a text
    are those of its words in order.  A word of printable ASCII and Latin-1 letters needs
    no normalising beyond lower case, and its pieces go straight to the library's model;
    any other word takes the whole of the library's path.  Ids are held as little-endian
    32-bit integers, so a text is a join of byte strings.

    Words are held in two generations.  When the younger is full the older is dropped, so
    a word stays as long as it keeps coming, and memory is bounded.
    """

    # The file's own splitting rule for such words, in lower case.
    PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")
    PIECES = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-zß-öø-ÿ0-9]+")
    # White space to str.split() but not to the file's rule.
    ODD = re.compile("[\x1c-\x1f]")

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.octets = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.words = _Memo(self._encoded)
        self.older: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        if len(self.words) > MEMO_ENTRIES:
            self.older, self.words = self.words, _Memo(self._encoded)
        known, odd = self.words.__getitem__, self.ODD.search
        return [
            self._whole([t])[0] if odd(t) else b"".join(map(known, t.split())) for t in texts
        ]

    def _encoded(self, word: str) -> bytes:
        """Ids of a word that the younger generation does not hold."""
        if (ids := self.older.get(word)) is not None:
            return ids
        if word.isascii() and word.isalpha():
            lower = word.lower()
            return self._piece(word) if lower == word else self.words[lower]
        if self.PLAIN.fullmatch(word) and "<|" not in word:
            pieces = self.PIECES.findall(word.lower())
            # A lone piece is a lower-case word like any other.
            if len(pieces) == 1:
                return self._piece(pieces[0]) if pieces[0] == word else self.words[pieces[0]]
            return b"".join(map(self.words.__getitem__, pieces))
        return self._whole([word])[0]

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _piece(self, piece: str) -> bytes:
        octets = piece if piece.isascii() else self.octets.pre_tokenize_str(piece)[0][0]
        return array("I", [t.id for t in self.model.tokenize(octets)]).tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process, kept between tasks."""
    if path not in _ENCODERS:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2) -> None:
    """Write the token ids of ``docs`` (doc_id, text), ascending in ``doc_id``.

    One shuffle deals texts into ranges of ``doc_id``; a task's chunks are written by
    Spark's own committer, so a task that is run again replaces what it left.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        shard = TaskContext.get().partitionId()
        chunk = start = 0
        for batch in batches:
            for part in arrow_slices(batch, "text"):
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = codec.ids(texts)
                counts = [len(x) // 4 + 1 for x in found]
                ids = np.frombuffer(end.join([*found, b""]), "<u4")
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([shard], pa.int32()),
                        pa.array([chunk], pa.int32()),
                        pa.array([start], pa.int64()),
                        pa.array([len(ids)], pa.int64()),
                        pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                        pa.array([counts], pa.list_(pa.int64())),
                        pa.array([encode_ids(ids)], pa.binary()),
                    ],
                    names=[x.split()[0] for x in FILE_SCHEMA.split(", ")],
                )
                chunk += 1
                start += len(ids)

    (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .repartitionByRange("doc_id")
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(chunks, FILE_SCHEMA)
        .write.mode("errorifexists")
        .option("compression", "zstd")
        .parquet(path)
    )


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written set: doc_id, start, n_tokens and ids (array)."""
    return _with_starts(spark, path, _documents(with_ids=True), "doc_id long, shard int, "
                        "local_start long, n_tokens long, ids array<long>")


def read_token_index(spark: SparkSession, path: str) -> DataFrame:
    """Documents of a written set with the crc32 of their ids instead of the ids."""
    return _with_starts(spark, path, _documents(with_ids=False), "doc_id long, shard int, "
                        "local_start long, n_tokens long, ids_crc32 long")


def _with_starts(spark: SparkSession, path: str, decode, schema: str) -> DataFrame:
    # One row per written file task: a small table, whatever the number of documents.
    stored = spark.read.schema(FILE_SCHEMA).parquet(path)
    totals = stored.groupBy("shard").agg(F.sum("n_ids").alias("_ids"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("shard", F.coalesce(F.sum("_ids").over(before), F.lit(0)).alias("_before"))
    found = stored.mapInArrow(decode, schema)
    last = found.columns[-1]
    return found.join(offsets, "shard").select(
        "doc_id", (F.col("_before") + F.col("local_start")).alias("start"), "n_tokens", last
    )


def _documents(with_ids: bool):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row] for n in batch.schema.names}
                ids = decode_ids(one["payload"].as_buffer().to_pybytes()).astype("<u4")
                counts = np.array(one["n_tokens"].as_py(), np.int64)
                ends = np.cumsum(counts)
                starts = ends - counts
                if with_ids:
                    held = pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids, pa.int64())
                    )
                else:
                    raw = memoryview(ids).cast("B")
                    held = pa.array(
                        [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends)], pa.int64()
                    )
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one["doc_ids"].as_py(), pa.int64()),
                        pa.array(np.full(len(counts), one["shard"].as_py()), pa.int32()),
                        pa.array(starts + one["local_start"].as_py(), pa.int64()),
                        pa.array(counts, pa.int64()),
                        held,
                    ],
                    names=["doc_id", "shard", "local_start", "n_tokens",
                           "ids" if with_ids else "ids_crc32"],
                )

    return decode


def token_files(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """Write ``docs`` below the shared folder and return what the files say of each document."""
    spark = docs.sparkSession
    path = scratch_path(spark, "tokens")
    write_token_files(docs, path, tokenizer_path, end_id)
    return read_token_index(spark, path)
