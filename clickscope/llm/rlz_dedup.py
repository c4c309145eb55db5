"""Substring dedup by relative Lempel-Ziv factoring of word sequences.

What repeats is any window of ``window`` consecutive words that also starts in
a document with a smaller doc_id.  Every document is a reference for the later
ones, indexed in blocks that content defines: consecutive windows whose least
16-word gram hash is the same (their *anchor*) form a block, the words that
they cover.  Equal text is cut into equal blocks wherever it stands, one for
some eighteen words.

A document is factored greedily, block by block: a block that an earlier
document has too continues the factor, with all its windows.  A factor ends
where a block differs as a whole; there, at its boundary, the windows are
checked one by one against every block with the same anchor (a window has one
anchor, so no other block can hold it).  Only the first holder of each
distinct block has to be checked so, once, whatever the number of copies.
Runs of repeated windows are the duplicate spans.

Blocks and windows are compared by a 64-bit cryptographic digest of their
words, joined by one space, among those of one anchor: two different ones with
the same anchor are taken for equal once in 2^64 cases, and no structure of
words makes that likelier.  The rolling hash of words only chooses where to
cut.  Shuffled are three numbers for each block, and the texts by doc_id.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import gram_sums, joined_groups, mixed, saved

_GRAM = 16


def sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Least of each ``k`` consecutive values."""
    have, out = 1, x
    while have < k:
        step = min(have, k - have)
        out = np.minimum(out[:-step], out[step:]) if len(out) > step else out[:0]
        have += step
    return out


class Blocks:
    """Blocks of a group of texts: row, first word, number of windows, anchor and digest of each.

    ``hashes`` are the words of all texts, ``first`` the first word of each
    text and the end; no block reaches from one text into the next.  ``data``
    holds the words joined by one space, ``at`` the first byte of each.
    """

    def __init__(self, data: bytes, hashes: np.ndarray, at: np.ndarray, first: np.ndarray, window: int):
        gram = min(_GRAM, window)
        self._data, self._at = data, np.append(at, len(data) + 1)
        self._window, self._first = window, first
        self._sums, self._down = gram_sums(hashes)
        n = len(hashes) - window + 1
        if n <= 0:
            self.row = self.start = self.count = self.anchor = self.content = np.zeros(0, dtype=np.int64)
            return
        of = np.repeat(np.arange(len(first) - 1), np.diff(first))
        at = np.flatnonzero(of[:n] == of[window - 1:])
        least = sliding_min(mixed(self._hash(np.arange(len(hashes) - gram + 1), gram)), window - gram + 1)[at]
        of = of[at]
        cut = np.flatnonzero((least[1:] != least[:-1]) | (of[1:] != of[:-1])) + 1
        begin = np.concatenate(([0], cut)) if len(at) else cut
        size = np.diff(np.append(begin, len(at)))
        # periodic text can keep one anchor for long; blocks of bounded size, cut from their start
        most = window - gram + 1
        parts = -(-size // most)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        head = np.repeat(begin, parts) + nth * most
        self.row, self.start = of[head], at[head]
        self.count = np.minimum(np.repeat(size, parts) - nth * most, most)
        self.anchor = least[head].view(np.int64)
        self.content = self._digests(self.start, self.count + window - 1)

    def _hash(self, start: np.ndarray, length) -> np.ndarray:
        return (self._sums[start + length] - self._sums[start]) * self._down[start]

    def _digests(self, start: np.ndarray, length) -> np.ndarray:
        """Digest of the ``length`` words from each ``start``."""
        data, ends = self._data, self._at[start + length] - 1
        found = [blake2b(data[a:b], digest_size=8).digest() for a, b in zip(self._at[start].tolist(), ends.tolist(), strict=True)]
        return np.frombuffer(b"".join(found), dtype="<i8")

    def windows(self, blocks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Block, place in it and digest of each window of these blocks."""
        count = self.count[blocks]
        of = np.repeat(blocks, count)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)
        return of, nth, self._digests(self.start[of] + nth, self._window)

    def keys(self, lo: int, hi: int) -> list[tuple[int, int]]:
        return list(zip(self.anchor[lo:hi].tolist(), self.content[lo:hi].tolist(), strict=True))

    def of_row(self, row: int) -> tuple[int, int]:
        """First block of a row and the end."""
        return tuple(np.searchsorted(self.row, (row, row + 1)).tolist())


def _groups(batch: pa.RecordBatch, window: int):
    """(first row, end row, first words, blocks) of the texts of a batch."""
    texts = [b" ".join((t or b"").split()) for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
    for lo, hi, data, hashes, at, first in joined_groups(texts):
        if b"" in texts[lo:hi]:  # texts without words leave spaces of their own
            data = b" ".join(t for t in texts[lo:hi] if t)
            at = _word_starts(data)
        yield lo, hi, first, Blocks(data, hashes, at, first, window)


def _word_starts(data: bytes) -> np.ndarray:
    return np.concatenate(([0], np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 32) + 1)) if data else np.zeros(0, dtype=np.int64)


def _longs(x) -> pa.Array:
    return pa.array(np.asarray(x, dtype=np.int64))


def document_blocks(docs: DataFrame, window: int) -> DataFrame:
    """(anchor, content, doc_id): the blocks of each row."""
    def cut(batches):
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for lo, _, _, b in _groups(batch, window):
                yield pa.RecordBatch.from_arrays([_longs(b.anchor), _longs(b.content), _longs(ids[lo + b.row])],
                                                 names=["anchor", "content", "doc_id"])
    return docs.select("doc_id", "text").mapInArrow(cut, "anchor long, content long, doc_id long")


def boundary_windows(asked: DataFrame, window: int) -> DataFrame:
    """(anchor, content, doc_id, nth, hash): the windows of the blocks ``asked`` for (doc_id, text, anchors, contents)."""
    def check(batches):
        for batch in batches:
            ids, anchors, contents = (batch.column(c) for c in ("doc_id", "anchors", "contents"))
            ids = ids.to_numpy(zero_copy_only=False)
            for lo, hi, _, b in _groups(batch, window):
                found = []
                for i in range(lo, hi):
                    wanted = set(zip(anchors[i].as_py(), contents[i].as_py(), strict=True))
                    begin, end = b.of_row(i - lo)
                    for k, key in enumerate(b.keys(begin, end), begin):
                        if key in wanted:
                            wanted.discard(key)
                            found.append(k)
                of, nth, h = b.windows(np.array(found, dtype=np.int64))
                yield pa.RecordBatch.from_arrays(
                    [_longs(b.anchor[of]), _longs(b.content[of]), _longs(ids[lo + b.row[of]]), _longs(nth), _longs(h)],
                    names=["anchor", "content", "doc_id", "nth", "hash"])
    return asked.mapInArrow(check, "anchor long, content long, doc_id long, nth long, hash long")


def _covered(b: Blocks, row: int, first: int, n_words: int, window: int, whole: set, partly: dict) -> np.ndarray:
    """Which words of a row a repeated window covers."""
    edge = np.zeros(n_words + 1, dtype=np.int64)
    begin, end = b.of_row(row)
    for k, key in enumerate(b.keys(begin, end), begin):
        start = b.start[k] - first
        if key in whole:
            edge[start] += 1
            edge[start + b.count[k] + window - 1] -= 1
        elif key in partly:
            at = start + np.asarray(partly[key])
            np.add.at(edge, at, 1)
            np.add.at(edge, at + window, -1)
    return np.cumsum(edge[:-1]) > 0


def _spans(covered: np.ndarray) -> list[dict]:
    step = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
    return [{"start": a, "n_words": b - a} for a, b in zip(np.flatnonzero(step == 1).tolist(), np.flatnonzero(step == -1).tolist(), strict=True)]


def _factored(joined: DataFrame, window: int) -> DataFrame:
    span = pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64())]))

    def factor(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            whole, partly = batch.column("__whole"), batch.column("__partly")
            n, removed, spans, kept = [0] * len(texts), [0] * len(texts), [[]] * len(texts), [""] * len(texts)
            for lo, hi, first, b in _groups(batch, window):
                for i in range(lo, hi):
                    found = (texts[i] or b"").split()
                    n[i] = len(found)
                    if whole[i].is_valid or partly[i].is_valid:
                        covered = _covered(b, i - lo, int(first[i - lo]), len(found), window,
                                           {(k["anchor"], k["content"]) for k in whole[i].as_py() or ()},
                                           {(k["anchor"], k["content"]): k["nth"] for k in partly[i].as_py() or ()})
                        removed[i], spans[i] = int(covered.sum()), _spans(covered)
                        found = [w for w, gone in zip(found, covered.tolist(), strict=True) if not gone]
                    kept[i] = b" ".join(found).decode()
            own = [c for c in batch.schema.names if c not in ("text", "__whole", "__partly")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in own], _longs(n), _longs(removed), pa.array(spans, span), pa.array(kept, pa.string())],
                names=[*own, "n_words", "n_removed", "spans", "kept"])
    return joined.mapInArrow(factor, "doc_id long, n_words long, n_removed long, spans array<struct<start:long,n_words:long>>, kept string")


def dedup_substrings(docs: DataFrame, window: int = 50) -> DataFrame:
    """doc_id, n_words, n_removed, spans (start, n_words) and kept (the words left, joined by one space) of each row.

    Words covered by a window whose word sequence also starts in a document
    with a smaller doc_id are removed; windows are judged on the input.  Null
    and empty texts have no words.  Rows that repeat a doc_id are one document
    to others and never remove each other's words; rows without doc_id are
    kept whole and remove nothing.  An empty table gives an empty one.
    """
    known = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    blocks = saved(document_blocks(known, window), "rlz-blocks")
    holders = blocks.groupBy("anchor", "content").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    holders = saved(holders, "rlz-holders")
    # anchors whose blocks differ and first stand in different documents
    unlike = holders.groupBy("anchor").agg(F.min("first").alias("a"), F.max("first").alias("b")).where("a < b").select("anchor")
    asked = (holders.join(unlike, "anchor").groupBy(F.col("first").alias("doc_id"))
             .agg(F.collect_list("anchor").alias("anchors"), F.collect_list("content").alias("contents")))
    windows = saved(boundary_windows(known.join(asked, "doc_id"), window), "rlz-windows")
    earlier = windows.groupBy("anchor", "hash").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    partly = (windows.join(earlier, ["anchor", "hash"]).where("first < doc_id")
              .groupBy("doc_id", "anchor", "content").agg(F.collect_list("nth").alias("nth"))
              .groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "content", "nth")).alias("__partly")))
    whole = (blocks.join(holders.where("first < last").select("anchor", "content", "first"), ["anchor", "content"])
             .where("first < doc_id")
             .groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "content")).alias("__whole")))
    found = whole.join(partly, "doc_id", "full")
    return _factored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(found, "doc_id", "left"), window)
