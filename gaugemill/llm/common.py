"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import hashlib
import shutil
import tempfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import gaugemill
from gaugemill.session import materialize

__all__ = [
    "arrow_slices", "bitmap", "joined", "marked", "materialize", "sha256_hex", "shipped", "table",
    "white_words",
]

# Rows handed to a Python loop at once hold about this many bytes of text (or one
# row, if that is longer), so that very long documents do not add up.
SLICE_BYTES = 4 << 20

# Bits of a broadcast bitmap of hashes: 16 MB, whatever it is made of.
BITMAP_BITS = 27

# The white space that separates words: space and U+0009 to U+000D.
WHITE = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipped(function: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Before ``function(spark, ...)`` runs, make this package importable for Python workers.

    Workers that start elsewhere than in the repository get it as a zip file from the
    driver, once for each session.
    """

    @functools.wraps(function)
    def run(spark: SparkSession, *args, **kwargs) -> DataFrame:
        context = spark.sparkContext
        if not getattr(context, "_gaugemill_shipped", False):
            root = Path(gaugemill.__file__).parent
            base = f"{tempfile.mkdtemp(prefix='gaugemill-')}/gaugemill"
            context.addPyFile(shutil.make_archive(base, "zip", root.parent, root.name))
            context._gaugemill_shipped = True
        return function(spark, *args, **kwargs)

    return run


def arrow_slices(
    batch: pa.RecordBatch, column: str, slice_bytes: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``slice_bytes`` of ``column`` each, in order."""
    texts = batch.column(batch.schema.get_field_index(column))
    start = held = 0
    for i, text in enumerate(texts):
        size = text.as_buffer().size if text.is_valid else 0
        if held and held + size > slice_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def sha256_hex(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def joined(spans: list[tuple[int, int, str]]) -> str:
    """``kind:start:end`` of (start, rank-sorted) spans, comma-joined."""
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def white_words(text: Column) -> Column:
    """Words between white space of a non-null text, as an array without empty entries."""
    parts = F.split(text, r"[ \t-\r]+")
    return F.filter(parts, lambda w: w != "")


def bitmap(hashes: DataFrame, bits: int = BITMAP_BITS) -> np.ndarray:
    """2**bits bits, those set that the values ``g`` name; its size does not grow with them."""
    at = F.shiftrightunsigned(F.col("g"), 64 - bits)
    one = F.expr("shiftleft(1L, cast(at & 63L as int))")
    found = hashes.select(at.alias("at")).groupBy(F.shiftright("at", 6).alias("w")).agg(
        F.bit_or(one).alias("set")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[found.column("w").to_numpy()] = found.column("set").to_numpy()
    return out


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    width = np.uint64(64 - (len(bits).bit_length() - 1 + 6))
    at = hashes >> width
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63)).astype(np.int64)) & 1 > 0
