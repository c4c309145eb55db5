"""Hard negatives for anchors, with angular triangle filtering.

Vectors enter as integers; the score of two rows is their integer inner
product.  For every row the index stores its norm and its angles to a few
reference directions, and lies sorted by the nearest of them and the angle to
it.  The angles of two rows to one reference give an interval for the angle
between them,

    |a - b| <= angle <= min(a + b, 2 pi - a - b),

the tightest over all references gives an interval of cosines, and the norms
turn it into bounds of the score, widened by what rounding can do.  Bounds are
taken for windows of consecutive rows of the index against windows of
anchors: only where they overlap the scores asked for are integers multiplied.

Two passes over the index for each block of anchors: the best rows of the
anchor's label, then the best rows of other labels under each of them.  A task
keeps a few rows an anchor, and begins with a bound that the anchor's own
neighbourhood in the index gives.  The anchors of a block are broadcast, a
bounded number; what a block finds is written before the next one starts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import saved
from clickscope.llm.whitening import integers, usable
from clickscope.session import scratch_path

#: Scaled vectors of this length or more take no part: their scores may not fit in 64 bits.
NORM_LIMIT = 2.0**31
_EXACT = 2.0**53        # products of norms below this: float arithmetic on integers is exact
_SLACK = 4e-6           # what rounding can do to the sum of two stored angles
_WINDOW, _ANCHOR_WINDOW = 256, 64
_LOWEST = -(2**62)
_NO_ID = 2**63 - 1      # stands for a null id, behind all others

INDEXED = "id long, label long, x array<long>, norm double, near int, angle float, angles array<float>"
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _matrix(lists: pa.Array, kind=np.float64) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1).astype(kind, copy=False)


def reference_directions(vectors: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors, each the one farthest in angle from those before it (the first: the first)."""
    norm = np.linalg.norm(vectors, axis=1)
    unit = vectors[norm > 0] / norm[norm > 0, None]
    if not len(unit):
        return np.zeros((0, vectors.shape[1] if vectors.ndim == 2 else 0))
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < count and nearest.min() < 1 - 1e-9:
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    return unit[chosen]


def build_index(rows: DataFrame, references: int = 16, sample_rows: int = 1_024) -> DataFrame:
    """The saved index of ``rows`` (id, label, x): norms and angles, sorted by nearest reference and angle.

    The references are fitted on the ``sample_rows`` distinct vectors of least
    hash; every row is indexed.  Rows equal in reference and angle are spread
    by their id, so that copies of one vector fill as many tasks as they need.
    """
    spark = rows.sparkSession
    sample = rows.select("x").distinct().orderBy(F.xxhash64("x"), "x").limit(sample_rows).collect()
    directions = reference_directions(np.array([r["x"] for r in sample], dtype=np.float64).reshape(len(sample), -1), references)

    def measure(batches):
        for batch in batches:
            x = _matrix(batch.column("x"))
            norm = np.linalg.norm(x, axis=1)
            unit = x / np.where(norm > 0, norm, 1)[:, None]
            angles = np.arccos(np.clip(unit @ directions.T, -1, 1)).astype(np.float32) if len(directions) else np.zeros((len(x), 1), np.float32)
            near = angles.argmin(axis=1)
            ends = pa.array(np.arange(len(x) + 1) * angles.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("id", "label", "x")), pa.array(norm), pa.array(near, pa.int32()),
                 pa.array(angles[np.arange(len(x)), near]), pa.ListArray.from_arrays(ends, pa.array(angles.ravel()))],
                names=["id", "label", "x", "norm", "near", "angle", "angles"])
    order = ["near", "angle", "__spread"]
    indexed = rows.select("id", "label", "x").mapInArrow(measure, INDEXED).withColumn("__spread", F.xxhash64("id"))
    return saved(indexed.repartitionByRange(*order).sortWithinPartitions(*order).drop("__spread"), "negatives-index")


@dataclass
class Rows:
    """Some rows of the index as arrays."""

    id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> Rows:
        ident, label, norm = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label", "norm"))
        return cls(ident, label, _matrix(batch.column("x"), np.int64), norm, _matrix(batch.column("angles")))

    def __getitem__(self, at) -> Rows:
        return Rows(self.id[at], self.label[at], self.x[at], self.norm[at], self.angles[at])

    def __len__(self) -> int:
        return len(self.id)

    def edges(self, size: int) -> tuple[np.ndarray, ...]:
        """Least and largest norm and angles of each window of ``size`` rows."""
        at = np.arange(0, len(self), size)
        return (np.minimum.reduceat(self.norm, at), np.maximum.reduceat(self.norm, at),
                np.minimum.reduceat(self.angles, at, axis=0), np.maximum.reduceat(self.angles, at, axis=0))


def score_bounds(anchors: tuple[np.ndarray, ...], rows: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest score that rows of each window can have with an anchor of each window (anchor x row)."""
    (an, ax, al, ah), (rn, rx, rl, rh) = anchors, rows
    shape = len(an), len(rn)
    least, most = np.zeros(shape), np.full(shape, np.pi)
    for k in range(al.shape[1]):
        apart = np.maximum(al[:, None, k] - rh[None, :, k], rl[None, :, k] - ah[:, None, k])
        np.maximum(least, apart, out=least)
        both = np.minimum(ah[:, None, k] + rh[None, :, k], 2 * np.pi - al[:, None, k] - rl[None, :, k])
        np.minimum(most, both, out=most)
    high = np.cos(np.clip(least - _SLACK, 0, np.pi))
    low = np.cos(np.clip(most + _SLACK, 0, np.pi))
    large, small = ax[:, None] * rx[None, :], an[:, None] * rn[None, :]
    high = np.where(high > 0, high * large, high * small)
    low = np.where(low > 0, low * small, low * large)
    return low - 1e-9 * large - 1, high + 1e-9 * large + 1


def scores(anchors: Rows, rows: Rows) -> np.ndarray:
    """Integer inner products (anchor x row), exact."""
    if len(rows) and anchors.norm.max() * rows.norm.max() < _EXACT:
        return (anchors.x.astype(np.float64) @ rows.x.T.astype(np.float64)).astype(np.int64)
    return anchors.x @ rows.x.T


class Best:
    """For each key the ``k`` entries (score, id) that come first: highest score, then smallest id."""

    def __init__(self, keys: int, k: int, floor: np.ndarray):
        self.k, self.floor = k, floor.copy()  # of each key: entries below this can't be among its first
        self.key = self.score = self.id = np.zeros(0, dtype=np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, ident: np.ndarray) -> None:
        if not len(key):
            return
        key, score, ident = (np.concatenate(p) for p in ((self.key, key), (self.score, score), (self.id, ident)))
        order = np.lexsort((ident, -score, key))
        key = key[order]
        nth = np.arange(len(key)) - np.searchsorted(key, key)
        order, nth, key = order[nth < self.k], nth[nth < self.k], key[nth < self.k]
        self.key, self.score, self.id = key, score[order], ident[order]
        full = nth == self.k - 1
        self.floor[key[full]] = np.maximum(self.floor[key[full]], self.score[full])


@dataclass
class Block:
    """A bounded number of anchors, in the order of the index."""

    anchors: Rows
    floor: np.ndarray                      # of each anchor: its last positive scores this at least
    positive_id: np.ndarray | None = None  # anchor x positive, as many as any has
    positive_score: np.ndarray | None = None
    known: np.ndarray | None = None        # which of them exist


def _windows(block: Block, rows: Rows, wanted_low: np.ndarray, wanted_high: np.ndarray):
    """(first anchor, end, rows): the rows of windows that may hold scores an anchor of the window wants."""
    a_edges, r_edges = block.anchors.edges(_ANCHOR_WINDOW), rows.edges(_WINDOW)
    low, high = score_bounds(a_edges, r_edges)
    at = np.arange(0, len(block.anchors), _ANCHOR_WINDOW)
    overlap = (high >= np.minimum.reduceat(wanted_low, at)[:, None]) & (low <= np.maximum.reduceat(wanted_high, at)[:, None])
    window = np.arange(len(rows)) // _WINDOW
    for n, begin in enumerate(at.tolist()):
        if overlap[n].all():
            yield begin, min(begin + _ANCHOR_WINDOW, len(block.anchors)), rows
        elif overlap[n].any():
            yield begin, min(begin + _ANCHOR_WINDOW, len(block.anchors)), rows[overlap[n][window]]


def find_positives(block: Block, batches, k: int) -> Best:
    best = Best(len(block.anchors), k, block.floor)
    for rows in batches:
        for begin, end, near in _windows(block, rows, best.floor, np.full(len(block.anchors), 2**62)):
            own = block.anchors[begin:end]
            s = scores(own, near)
            a, r = np.nonzero((s >= best.floor[begin:end, None]) & (own.label[:, None] == near.label) & (own.id[:, None] != near.id))
            best.add(a + begin, s[a, r], near.id[r])
    return best


def find_negatives(block: Block, batches, k: int, percent: tuple[int, int]) -> Best:
    """Entries by key ``anchor * positives + positive``."""
    positives = block.known.shape[1]
    hundreds, rest = np.divmod(block.positive_score, 100)  # apart, so that no product leaves 64 bits
    low = np.where(block.known, percent[0] * hundreds - (-percent[0] * rest) // 100, 2**62)
    high = np.where(block.known, percent[1] * hundreds + (percent[1] * rest) // 100, _LOWEST)
    best = Best(low.size, k, low.ravel())
    for rows in batches:
        wanted = best.floor.reshape(low.shape).min(axis=1, initial=2**62)
        for begin, end, near in _windows(block, rows, wanted, high.max(axis=1, initial=_LOWEST)):
            own = block.anchors[begin:end]
            s = scores(own, near)
            other = own.label[:, None] != near.label
            for j in range(positives):
                floor = best.floor.reshape(low.shape)[begin:end, j]
                a, r = np.nonzero(other & (s >= floor[:, None]) & (s <= high[begin:end, j][:, None]))
                best.add((a + begin) * positives + j, s[a, r], near.id[r])
    return best


def _neighbours_floor(batches, is_anchor, k: int):
    """Anchors of the index with the score that their ``k``-th positive reaches among the rows of their batch."""
    for batch in batches:
        rows = Rows.of(batch)
        at = np.flatnonzero(is_anchor(rows.id))
        floor = np.full(len(rows), _LOWEST)
        for begin in range(0, len(at), _ANCHOR_WINDOW):
            part = at[begin: begin + _ANCHOR_WINDOW]
            own = rows[part]
            s = np.where((own.label[:, None] == rows.label) & (own.id[:, None] != rows.id), scores(own, rows), _LOWEST)
            if len(rows) >= k:
                floor[part] = np.partition(s, len(rows) - k, axis=1)[:, len(rows) - k]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], names=[*batch.schema.names, "floor"]).take(pa.array(at))


def _anchor_blocks(anchors: DataFrame, at_once: int):
    """Blocks of the saved anchors; one block at a time is on the driver."""
    kinds = {"id": pa.int64(), "label": pa.int64(), "x": pa.list_(pa.int64()), "norm": pa.float64(), "angles": pa.list_(pa.float32()),
             "floor": pa.int64()}
    part: list = []

    def made() -> Block:
        t = pa.record_batch({c: pa.array([r[c] for r in part], kind) for c, kind in kinds.items()})
        return Block(Rows.of(t), t.column("floor").to_numpy())
    for row in anchors.select(*kinds).toLocalIterator():
        part.append(row)
        if len(part) == at_once:
            yield made()
            part = []
    if part:
        yield made()


def _search(index: DataFrame, block: Block, find) -> tuple[DataFrame, object]:
    """(key, score, id) of the entries that tasks keep, and the broadcast to release."""
    sent = index.sparkSession.sparkContext.broadcast(cloudpickle.dumps(block))

    def search(batches):
        best = find(cloudpickle.loads(sent.value), (Rows.of(b) for b in batches if b.num_rows))
        yield pa.RecordBatch.from_arrays([pa.array(best.key), pa.array(best.score), pa.array(best.id)], names=["key", "score", "id"])
    return index.mapInArrow(search, "key long, score long, id long"), sent


def _first(found: DataFrame, k: int) -> DataFrame:
    nth = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= k)


def _mine_block(index: DataFrame, block: Block, positives: int, negatives: int, percent: tuple[int, int], path: str) -> None:
    """Writes what the anchors of one block find."""
    n = len(block.anchors)
    found, sent = _search(index, block, lambda b, batches: find_positives(b, batches, positives))
    first = _first(found, positives).collect()  # ``positives`` rows an anchor of the block
    sent.destroy()
    block.known = np.zeros((n, positives), dtype=bool)
    block.positive_id, block.positive_score = (np.zeros((n, positives), dtype=np.int64) for _ in range(2))
    for r in first:
        at = r["key"], r["rank"] - 1
        block.known[at], block.positive_id[at], block.positive_score[at] = True, r["id"], r["score"]
    found, sent = _search(index, block, lambda b, batches: find_negatives(b, batches, negatives, percent))
    keys = pa.table({"key": np.arange(n * positives), "anchor_id": np.repeat(block.anchors.id, positives),
                     "positive_id": block.positive_id.ravel(), "positive_score": block.positive_score.ravel()})
    named = F.broadcast(index.sparkSession.createDataFrame(keys))  # as many rows as the block has positives
    (_first(found, negatives).join(named, "key")
     .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
     .write.parquet(path))
    sent.destroy()


def mine_hard_negatives(rows: DataFrame, is_anchor, *, positives: int = 5, negatives: int = 5, percent: tuple[int, int] = (80, 100),
                        scale: int = 256, references: int = 16, anchors_at_once: int = 4_096) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``rows`` (vec_id, embedding, label).

    ``is_anchor`` tells from an array of ids which rows are anchors.  An
    anchor's positives are its first ``positives`` rows of the same label and
    another id, by falling score and then by id; its negatives for a positive
    are the first ``negatives`` rows of other labels whose score lies between
    the two ``percent`` of the positive's.

    Rows with a null label, a null or empty vector or a null or non-finite
    entry take no part, nor do vectors of another length than most have (of
    equally many: the longer) or of a scaled length of ``NORM_LIMIT`` or more.  Rows with a null id
    are no anchors and come last among ties.  Repeated rows are rows of their
    own as positives and negatives, and one anchor; rows that repeat an
    anchor's id with another label or vector are anchors of their own.  No
    anchors, or an empty table, give no rows.
    """
    spark = rows.sparkSession
    ready = (rows.where(F.col("label").isNotNull() & usable(F.col("embedding")) & (F.size("embedding") > 0))
             .select(F.coalesce(F.col("vec_id").cast("long"), F.lit(_NO_ID)).alias("id"), F.col("label").cast("long").alias("label"),
                     integers(F.col("embedding"), scale, 0).alias("x")))
    square = F.aggregate("x", F.lit(0.0), lambda a, c: a + c.cast("double") * c.cast("double"))
    ready = ready.where(square < NORM_LIMIT**2)
    length = ready.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).select("d").first()
    if length is None:
        return spark.createDataFrame([], RESULT)
    index = build_index(ready.where(F.size("x") == length[0]), references)
    anchors = index.mapInArrow(lambda b: _neighbours_floor(b, lambda ids: is_anchor(ids) & (ids != _NO_ID), positives), f"{INDEXED}, floor long")
    # repeated rows are one anchor, under the best of their bounds
    once = anchors.groupBy("id", "label", "x", "norm", "near", "angle", "angles").agg(F.max("floor").alias("floor"))
    once = saved(once.repartitionByRange("near", "angle", "id").sortWithinPartitions("near", "angle", "id"), "negatives-anchors")
    root = scratch_path(spark, "negatives")
    n_blocks = 0
    for n_blocks, block in enumerate(_anchor_blocks(once, anchors_at_once), 1):
        _mine_block(index, block, positives, negatives, percent, f"{root}/block={n_blocks}")
    if not n_blocks:
        return spark.createDataFrame([], RESULT)
    null_id = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).alias(c)
    found = spark.read.schema(RESULT).parquet(root)
    return found.select("anchor_id", null_id("positive_id"), "rank", null_id("negative_id"), "positive_score", "negative_score")
