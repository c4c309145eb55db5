"""Benchmark decontamination: size-partitioned MinHash containment search.

Test items are the queries, the documents the indexed side.  Items fall into
partitions by their number of distinct word shingles, with upper bounds that
double.  For a partition with bound ``u`` every document is cut into blocks of
``u / 2`` shingles, and every run of three blocks is a domain: an item of the
partition that stands anywhere in a document lies within one of them, so the
size of the domain is in proportion to the item and containment ``t`` becomes
a Jaccard similarity that MinHash can see, however long the document is:

    s = t (u/2) / (3 u/2 + (1 - t) u/2)

A document is a candidate for an item if one of ``b`` MinHash values agrees in
any domain; ``b`` follows from ``s`` and the accepted chance of a miss.
Candidates are verified by exact containment: the item's distinct shingles
found anywhere in the whole document, compared as words.

Items of up to ``SHORT`` shingles are no MinHash queries: the hash of each of
their shingles is a key, and a document that holds enough keys of an item is a
candidate, so none is missed.

The items' signatures are broadcast in blocks of ``items_at_once`` items, one
pass over the documents for each block.  The result of a pass is written and
its broadcast destroyed before the next block is sent, so driver and executors
hold one block whatever the size of the benchmark (two while the driver builds
the next).  Documents are never shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickscope.llm.common import ascii_lower, broadcast_value, gram_hashes, mixed, saved, text_groups

# Fixed value: items of up to so many shingles are looked up by each of them.
SHORT = 8

MATCH = "array<struct<item_id:bigint,n_shingles:bigint,n_shared:bigint>>"


def shingles(text: bytes | None, k: int = 5) -> set[bytes]:
    """Distinct runs of ``k`` lower-cased words, joined by a space (fewer words: none)."""
    found = ascii_lower(text or b"").split()
    return {b" ".join(found[i: i + k]) for i in range(len(found) - k + 1)}


def minhash_values(threshold: float, miss: float) -> int:
    s = threshold / (3 + (1 - threshold))
    return math.ceil(math.log(miss) / math.log(1 - s))


@dataclass
class Partition:
    """Signatures of the items with more than ``bound / 2`` and up to ``bound`` shingles."""

    bound: int
    items: np.ndarray                      # index into Index.ids
    values: list[np.ndarray]               # for each hash function: sorted minima
    order: list[np.ndarray]                # the items in that order
    seen: list[np.ndarray] = field(repr=False)  # low bits of the minima that occur


@dataclass
class Keys:
    """Shingle hashes of the items of up to ``SHORT`` shingles."""

    values: np.ndarray                     # sorted, distinct
    first: np.ndarray                      # where each value's items begin, and the end
    items: np.ndarray                      # index into Index.ids
    least: np.ndarray                      # for each item of the index: keys that a candidate holds
    seen: np.ndarray = field(repr=False)   # low bits of the values that occur

    @classmethod
    def of(cls, hashes: dict[int, np.ndarray], sets: list[set[bytes]], threshold: float) -> Keys:
        least = np.zeros(len(sets), dtype=np.int64)
        for n, h in hashes.items():  # shingles of one hash are one key
            need = sum(i < threshold * len(sets[n]) for i in range(len(sets[n])))
            least[n] = max(1, need - (len(sets[n]) - len(h)))
        value, item = np.concatenate(list(hashes.values())), np.repeat(list(hashes), [len(h) for h in hashes.values()])
        order = np.argsort(value, kind="stable")
        values, first = np.unique(value[order], return_index=True)
        seen = np.zeros(1 << max(12, (64 * len(values) - 1).bit_length()), dtype=bool)
        seen[values & np.uint64(len(seen) - 1)] = True
        return cls(values, np.append(first, len(value)), item[order], least, seen)

    def candidates(self, grams: np.ndarray, row: np.ndarray) -> Iterator[tuple[int, int]]:
        """(row, item) for each item of which the row holds enough keys."""
        hit = np.flatnonzero(self.seen[grams & np.uint64(len(self.seen) - 1)])
        at = np.searchsorted(self.values, grams[hit])
        same = self.values[np.minimum(at, len(self.values) - 1)] == grams[hit]
        held = np.unique(row[hit[same]] * len(self.values) + at[same])
        row, at = np.divmod(held, len(self.values))
        n = self.first[at + 1] - self.first[at]
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        item = self.items[np.repeat(self.first[at], n) + nth]
        pairs, count = np.unique(np.repeat(row, n) * len(self.least) + item, return_counts=True)
        enough = count >= self.least[pairs % len(self.least)]
        return zip(*(x.tolist() for x in np.divmod(pairs[enough], len(self.least))), strict=True)


@dataclass
class Index:
    """MinHash index of one block of test items."""

    ids: list[int | None]
    sets: list[set[bytes]]
    partitions: list[Partition]
    keys: Keys | None
    factors: np.ndarray
    k: int
    threshold: float


def build_index(items: list[tuple[int | None, bytes | None]], k: int = 5, threshold: float = 0.8,
                miss: float = 1e-6, seed: int = 17) -> Index:
    """Items without a shingle (null, empty or fewer than ``k`` words) can't be found and are left out."""
    kept = [(i, s) for i, t in items if (s := shingles(t, k))]
    b = minhash_values(threshold, miss)
    factors = np.random.default_rng(seed).integers(1, 2**64, size=b, dtype=np.uint64) | np.uint64(1)
    least, bounds, short = [], [], {}
    for n, (_, s) in enumerate(kept):
        _, _, h, _ = next(text_groups([b" ".join(s)]))
        grams = mixed(gram_hashes(h, k)[::k])
        least.append((grams[None, :] * factors[:, None]).min(axis=1))
        bounds.append(1 << (len(s) - 1).bit_length())
        if len(s) <= SHORT:
            short[n] = np.unique(grams)
    parts = []
    for bound in sorted({x for x in bounds if x > SHORT}):
        own = np.array([n for n, x in enumerate(bounds) if x == bound])
        sig = np.array([least[n] for n in own])
        bits = max(12, (64 * len(own) - 1).bit_length())
        order = [np.argsort(sig[:, j], kind="stable") for j in range(b)]
        values = [sig[o, j] for j, o in enumerate(order)]
        seen = []
        for v in values:
            hit = np.zeros(1 << bits, dtype=bool)
            hit[v & np.uint64((1 << bits) - 1)] = True
            seen.append(hit)
        parts.append(Partition(bound, own, values, [own[o] for o in order], seen))
    sets = [s for _, s in kept]
    return Index([i for i, _ in kept], sets, parts, Keys.of(short, sets, threshold) if short else None, factors, k, threshold)


def _runs(n_grams: np.ndarray, first: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """First gram and row of each block of ``block`` grams; blocks restart with each row."""
    blocks = -(-n_grams // block)
    row = np.repeat(np.arange(len(n_grams)), blocks)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    return first[row] + nth * block, row


def candidates(index: Index, texts: list[bytes | None]) -> list[set[int]]:
    """For each text the items (positions in ``index.ids``) of which it holds enough keys or with which a domain shares a MinHash value."""
    out: list[set[int]] = [set() for _ in texts]
    for lo, hi, h, first in text_groups([t and ascii_lower(t) for t in texts], 1 << 19):
        grams = mixed(gram_hashes(h, index.k))
        n_grams = np.maximum(0, np.diff(first) - index.k + 1)
        if not n_grams.any():
            continue
        # the grams that lie within one row, side by side
        begin = np.cumsum(n_grams) - n_grams
        own = np.arange(n_grams.sum()) + np.repeat(first[:-1] - begin, n_grams)
        grams = grams[own]
        if index.keys:
            for row, n in index.keys.candidates(grams, np.repeat(np.arange(len(n_grams)), n_grams)):
                out[lo + row].add(n)
        runs = [(p, *_runs(n_grams, begin, p.bound // 2)) for p in index.partitions]
        for j, factor in enumerate(index.factors):
            x = grams * factor
            for p, start, row in runs:
                low = np.minimum.reduceat(x, start)
                domain = low.copy()
                for step in (1, 2):
                    if len(low) > step:
                        same = row[step:] == row[:-step]
                        ahead = np.where(same, low[step:], domain[:-step])
                        np.minimum(domain[:-step], ahead, out=domain[:-step])
                mask = np.uint64(len(p.seen[j]) - 1)
                hit = np.flatnonzero(p.seen[j][domain & mask])
                if not len(hit):
                    continue
                left = np.searchsorted(p.values[j], domain[hit], "left")
                right = np.searchsorted(p.values[j], domain[hit], "right")
                for at in np.flatnonzero(right > left):
                    out[lo + row[hit[at]]].update(p.order[j][left[at]: right[at]].tolist())
    return out


def matches(index: Index, texts: list[bytes | None]) -> list[list[dict]]:
    """Verified matches of each text, by item id (nulls last)."""
    out = []
    for text, near in zip(texts, candidates(index, texts), strict=True):
        found = []
        if near:
            there = shingles(text, index.k)
            for n in near:
                own = index.sets[n]
                shared = len(own & there)
                if shared >= index.threshold * len(own):
                    found.append({"item_id": index.ids[n], "n_shingles": len(own), "n_shared": shared})
        out.append(sorted(found, key=lambda m: (m["item_id"] is None, m["item_id"] or 0, m["n_shingles"], m["n_shared"])))
    return out


def item_blocks(benchmark: DataFrame, items_at_once: int, **how) -> Iterator[Index]:
    """Indexes of the benchmark, block by block in order of (item_id, text); a block holds a bounded number of items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct().orderBy("item_id", "text")
    block: list[tuple[int | None, bytes | None]] = []
    for row in items.toLocalIterator():
        block.append((row.item_id, None if row.text is None else row.text.encode()))
        if len(block) == items_at_once:
            yield build_index(block, **how)
            block = []
    if block:
        yield build_index(block, **how)


def contained_items(docs: DataFrame, benchmark: DataFrame, out: str = "matches", *, text: str = "text", k: int = 5,
                    threshold: float = 0.8, items_at_once: int = 5_000, miss: float = 1e-6) -> DataFrame:
    """``docs`` with the array column ``out`` of the test items that each whole text contains.

    An item is contained if at least ``threshold`` of its distinct shingles of
    ``k`` lower-cased words (A-Z) occur in the text.  Null and empty texts
    contain nothing; items of fewer than ``k`` words are not searched; items
    that repeat an id with another text are separate matches, exact repeats
    are one.  Rows, repeated ones too, and other columns stay as they are; a
    column ``out`` is replaced.  Empty tables give empty arrays and an empty table.
    """
    found = docs.withColumn(out, F.array().cast(MATCH))
    for find, last in _searches(docs.sparkSession, benchmark, items_at_once, k=k, threshold=threshold, miss=miss):
        found = found.withColumn(out, F.concat(F.col(out), find(F.col(text))))
        found = found if last else saved(found, "contained-items")
    return found


def _searches(spark: SparkSession, benchmark: DataFrame, items_at_once: int = 5_000, **how) -> Iterator[tuple[Callable[[Column], Column], bool]]:
    """For each block of items a function that finds them in texts, and whether it is the last.

    What a function gave must be written before the next is asked for: its
    index is then released, so that one block at a time is held.
    """
    blocks = (index for index in item_blocks(benchmark, items_at_once, **how) if index.ids)
    index = next(blocks, None)
    while index is not None:
        sent, index_of = broadcast_value(spark, index)
        index = next(blocks, None)
        yield _matcher(index_of), index is None
        if index is not None:
            sent.destroy()


def _matcher(index_of):
    @F.arrow_udf(MATCH)
    def find(texts: pa.Array) -> pa.Array:
        got = matches(index_of(), texts.cast(pa.large_binary()).to_pylist())
        return pa.array(got, type=pa.list_(pa.struct([("item_id", pa.int64()), ("n_shingles", pa.int64()),
                                                      ("n_shared", pa.int64())])))
    return find


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """One row for each (document, test item) with the counts and the containment; null ids are ids like any other."""
    pairs = None
    for find, last in _searches(docs.sparkSession, benchmark, **how):
        found = docs.select("doc_id", F.explode(find(F.col("text"))).alias("m")).select(
            "doc_id", "m.item_id", "m.n_shingles", "m.n_shared",
            (F.col("m.n_shared") / F.col("m.n_shingles")).alias("containment"))
        found = found if last else saved(found, "contaminated-pairs")
        pairs = found if pairs is None else pairs.unionByName(found)
    if pairs is None:
        return docs.where("false").select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in (
            ("item_id", "long"), ("n_shingles", "long"), ("n_shared", "long"), ("containment", "double"))])
    return pairs


def decontaminate(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The documents that contain no test item, repeated rows each on its own; all columns are kept, whatever their names."""
    for find, last in _searches(docs.sparkSession, benchmark, **how):
        docs = docs.where(F.size(find(F.col("text"))) == 0)
        docs = docs if last else saved(docs, "decontaminated")
    return docs
