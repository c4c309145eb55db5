"""Helpers shared by the corpus operators.

A *word* is a maximal run of characters other than space and the control
characters 9 to 13.  Column names that start with ``__`` are internal to an
operator and never leave it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickscope.session import scratch_path

# Fixed value: the white space that separates words.
WHITE = " \t\n\x0b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back.

    Cuts the lineage with files every executor can read, so that a lost
    executor costs a reread and no recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_value(spark: SparkSession, value: Any) -> tuple[Broadcast, Callable[[], Any]]:
    """A broadcast of ``value``, to be destroyed when its jobs have ended, and a function that gives the value in tasks; its size must be bounded."""
    sent, got = spark.sparkContext.broadcast(cloudpickle.dumps(value)), []

    def value_of() -> Any:
        if not got:
            got.append(cloudpickle.loads(sent.value))
        return got[0]
    return sent, value_of


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A function that gives ``value`` in tasks; it is broadcast, so its size must be bounded."""
    return broadcast_value(spark, value)[1]


def spaced(text: Column) -> Column:
    """The text with every white-space character turned into a space (null: empty)."""
    return F.translate(F.coalesce(text, F.lit("")), WHITE[1:], " " * (len(WHITE) - 1))


def words(text: Column) -> Column:
    """The words of a text column as an array (null text: no words)."""
    return F.filter(F.split(spaced(text), " "), lambda w: w != "")


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes of the text plus one (null text: one)."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def key63(*cols: Column) -> Column:
    """A hash of the columns in 0 .. 2^63 - 1 (nulls are hashed as such)."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 1)


def key_bucket(key: Column, buckets: int) -> Column:
    """Order-preserving bucket 0 .. buckets-1 of a ``key63`` column."""
    return F.floor(F.shiftrightunsigned(key, 31).cast("double") * buckets / float(1 << 32)).cast("int")


def bucket_count(rows: int, rows_per_bucket: int = 20_000) -> int:
    """Key ranges to cut one group into, so that a range fits a task whatever the group holds."""
    return max(64, -(-rows // rows_per_bucket))


def running_before(df: DataFrame, group: list[str], bucket: str, order: list[str], value: str, out: str) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows of the group that come before, in (bucket, order) order.

    ``bucket`` must not decrease along ``order``.  Two-level prefix sum: one
    sum for each (group, bucket), their running sum, and a window inside each
    bucket; no task sees more than one bucket of a group.  ``group`` columns
    must not be null.
    """
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    heads = (df.groupBy(*group, bucket).agg(F.sum(value).alias("__sum"))
             .select(*group, bucket, F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__head")))
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(heads, [*group, bucket])
            .withColumn(out, F.col("__head") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
            .drop("__head"))


# ---- word hashes inside tasks (numpy) ----

_BASE = 0x9E3779B97F4A7C15
_CHUNK = 1 << 20
_IS_WHITE = np.zeros(256, dtype=bool)
_IS_WHITE[[ord(c) for c in WHITE]] = True
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def ascii_lower(data: bytes) -> bytes:
    return data.translate(_LOWER)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (in place on a fresh array)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class Powers:
    """Powers of an odd base modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __reduce__(self):
        return Powers, (self.base,)  # the tables are cheaper made anew than sent

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            def powers(b: int) -> np.ndarray:
                a = np.full(max(n, 1024), b, dtype=np.uint64)
                a[0] = 1
                return np.multiply.accumulate(a)
            self.up, self.down = powers(self.base), powers(self.inverse)


_BYTES, _WORDS = Powers(_BASE | 1), Powers(0xC2B2AE3D27D4EB4F)


def _block_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hash and first byte of each word of one block."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = np.concatenate(([False], ~_IS_WHITE[raw], [False]))
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    start, end = edge[::2], edge[1::2]
    _BYTES.reach(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * _BYTES.up[: len(raw)], out=sums[1:])
    return mixed((sums[end] - sums[start]) * _BYTES.down[start] + (end - start).astype(np.uint64)), start


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hash and first byte of each word; blocks bound the memory for texts of any length."""
    if len(data) <= 2 * _CHUNK:
        return _block_hashes(data)
    hashes, starts, at = [], [], 0
    while at < len(data):
        stop = min(len(data), at + _CHUNK)
        while stop < len(data) and not _IS_WHITE[data[stop]]:
            stop += 1
        h, s = _block_hashes(data[at:stop])
        hashes.append(h)
        starts.append(s + at)
        at = stop
    return np.concatenate(hashes), np.concatenate(starts)


def joined_groups(texts: list[bytes | None], limit: int = _CHUNK) -> Iterator[tuple[int, int, bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Consecutive texts hashed together: (first row, end row, their bytes joined by a space, word hashes, first byte of each word, first word of each row and the end).

    A group holds ``limit`` bytes or one longer text.
    """
    lo = 0
    while lo < len(texts):
        hi, total = lo, 0
        while hi < len(texts) and (hi == lo or total + len(texts[hi] or b"") < limit):
            total += len(texts[hi] or b"") + 1
            hi += 1
        offsets = np.zeros(hi - lo + 1, dtype=np.int64)
        np.cumsum([len(t or b"") + 1 for t in texts[lo:hi]], out=offsets[1:])
        data = b" ".join(t or b"" for t in texts[lo:hi])
        hashes, starts = word_hashes(data)
        yield lo, hi, data, hashes, starts, np.searchsorted(starts, offsets)
        lo = hi


def text_groups(texts: list[bytes | None], limit: int = _CHUNK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, word hashes, first word of each row and the end) of ``joined_groups``."""
    for lo, hi, _, hashes, _, first in joined_groups(texts, limit):
        yield lo, hi, hashes, first


def gram_sums(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers: ``(sums[i + k] - sums[i]) * down[i]`` is the hash of words i .. i + k - 1."""
    _WORDS.reach(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * _WORDS.up[: len(hashes)], out=sums[1:])
    return sums, _WORDS.down


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` consecutive words (unmixed polynomial, whatever the rows)."""
    n = max(0, len(hashes) - k + 1)
    sums, down = gram_sums(hashes)
    return (sums[k:] - sums[:n]) * down[:n] if n else np.zeros(0, dtype=np.uint64)
