"""K-d tree sharding by UTF-8 bytes over document metadata.

A node of the tree holds a number of leaves; it is split along the metadata
dimension that is widest within it (relative to the whole table), at the
weighted median: the value up to which its rows hold half of its leaves'
share of the bytes.  Splitting goes on until each node is one leaf of the
target bytes.  All nodes of a level are split at once.

Each row's node is written with its narrow point after every level, so a pass
reads one table and joins one, however deep the tree is.  The medians are
found on the data where it lies: the weights are summed into
value ranges, the range that holds the median is divided again, until it is
one value or too light to matter; rows that tie on the value are divided by a
hash of the row in the same way.  A pass brings one row per node to the
driver; the tree itself has one node per shard, which bounds what is broadcast.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickscope.llm.common import bucket_count, key63, key_bucket, running_before, saved, utf8_size

_RANGES = 1 << 13
_HASH_TOP = (1 << 63) - 1
_CUTS = "__node int, __dim int, __v long, __h long, __left int, __right int"
_SPANS = "__node int, __dim int, __on_hash boolean, __v long, __lo long, __step long, __below long, __want double"


# Node 1 for every row (a hash has 63 bits); as a value of the row and not a literal, so that joins by node are hash joins.
_ROOT = "CAST(shiftrightunsigned(__hash, 63) + 1 AS INT)"


@dataclass
class Tree:
    """Cuts by level; the root is node 1, leaves carry their shard."""

    rows: int = 0
    levels: list[list[tuple]] = field(default_factory=list)
    shard_of: dict[int, int] = field(default_factory=dict)


def prefix_code(text: Column) -> Column:
    """A long that sorts like the first seven UTF-8 bytes of the text (null: -1, before all)."""
    head = F.rpad(F.substring(F.hex(F.encode(text, "utf-8")), 1, 14), 14, "0")
    return F.coalesce(F.conv(head, 16, 10).cast("long"), F.lit(-1).cast("long"))


def default_dimensions(docs: DataFrame) -> list[Column]:
    """The metadata of documents: source, language, length, id."""
    number = lambda c: F.coalesce(F.col(c).cast("long"), F.lit(-1).cast("long"))
    own = {"source": prefix_code, "lang": prefix_code}
    return [own[c](F.col(c)) if c in own else number(c) for c in ("source", "lang", "n_chars", "doc_id") if c in docs.columns]


def _small(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table made from driver values (Arrow, so that it is part of the plan)."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    names, types = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return spark.createDataFrame(pa.table([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=names))


def _with_points(docs: DataFrame, dims: list[Column]) -> DataFrame:
    return docs.withColumns({"__size": utf8_size(F.col("text")), "__dims": F.array(*dims),
                             "__hash": key63(F.col("doc_id"), F.crc32(F.col("text").cast("binary")), F.octet_length("text"))})


def _descend(points: DataFrame, cuts: list[tuple]) -> DataFrame:
    """Rows moved from their node to its child on their side of the cut."""
    if not cuts:
        return points
    spark = points.sparkSession
    table = F.broadcast(_small(spark, cuts, _CUTS))  # at most one row a shard
    x = F.element_at("__dims", F.col("__dim") + 1)
    left = (x < F.col("__v")) | ((x == F.col("__v")) & (F.col("__hash") <= F.col("__h")))
    node = F.when(F.col("__dim").isNull(), F.col("__node")).when(left, F.col("__left")).otherwise(F.col("__right"))
    return points.join(table, "__node", "left").withColumn("__node", node).drop(*[c.split()[0] for c in _CUTS.split(", ")[1:]])


def _medians(points: DataFrame, nodes: list[dict], slack: float) -> dict[int, tuple[int, int]]:
    """For each node the cut (value, hash) along its dimension nearest to the wanted weight."""
    spark: SparkSession = points.sparkSession
    spans = {n["node"]: dict(n, on_hash=False, v=0, lo=n["lo"], hi=n["hi"], below=0) for n in nodes}
    found: dict[int, tuple[int, int]] = {}
    while spans:
        rows = []
        for s in spans.values():
            s["step"] = max(1, -(-(s["hi"] - s["lo"] + 1) // _RANGES))
            rows.append((s["node"], s["dim"], s["on_hash"], s["v"], s["lo"], s["step"], s["below"], s["want"]))
        table = F.broadcast(_small(spark, rows, _SPANS))  # one row a node
        x = F.element_at("__dims", F.col("__dim") + 1)
        at = F.when(F.col("__on_hash"), F.col("__hash")).otherwise(x)
        hist = (points.join(table, "__node")
                .where(~F.col("__on_hash") | (x == F.col("__v")))
                .withColumn("__at", at).where("__at >= __lo")
                .withColumn("__range", F.expr("(__at - __lo) div __step"))
                .where(f"__range < {_RANGES}")
                .groupBy("__node", "__range", "__below", "__want")
                .agg(F.sum("__size").alias("__w"), F.min("__at").alias("__min"), F.max("__at").alias("__max")))
        upto = Window.partitionBy("__node").orderBy("__range")
        first = (hist.withColumn("__upto", F.col("__below") + F.sum("__w").over(upto))
                 .withColumn("__short", F.col("__upto") < F.col("__want"))
                 .groupBy("__node").agg(
                     F.min(F.when(~F.col("__short"), F.struct("__range", "__upto", "__w", "__min", "__max"))).alias("at"),
                     F.max(F.struct("__range", "__upto", "__w", "__min", "__max")).alias("end")))
        for r in first.collect():  # one row a node
            s, hit = spans[r["__node"]], r["at"] or r["end"]
            lo, hi, before = hit["__min"], hit["__max"], hit["__upto"] - hit["__w"]  # what the range really spans
            light = hit["__w"] <= slack
            if light or (lo == hi and s["on_hash"]):
                # the end of this range, or of what lies before it, whichever is nearer
                end = hi if hit["__upto"] - s["want"] <= s["want"] - before else lo - 1
                found[s["node"]] = (s["v"], end) if s["on_hash"] else (end, _HASH_TOP)
            elif lo == hi:
                s.update(on_hash=True, v=lo, lo=0, hi=_HASH_TOP, below=before)
            else:
                s.update(lo=lo, hi=hi, below=before)
        spans = {k: s for k, s in spans.items() if k not in found}
    return found


def build_tree(points: DataFrame, n_dims: int, n_shards: int | None, target_bytes: int | None, slack: float = 0.001) -> Tree:
    """The cuts over ``points`` (__size, __dims, __hash), a saved table that is read once a pass."""
    total, rows = points.agg(F.sum("__size"), F.count(F.lit(1))).first()
    total = total or 0
    if n_shards is None:
        n_shards = max(1, -(-total // target_bytes))
    tree, leaves = Tree(rows), {1: n_shards}
    placed = points.withColumn("__node", F.expr(_ROOT))
    whole: list[float] | None = None
    while any(n > 1 for n in leaves.values()):
        edges = [F.struct(F.min(F.element_at("__dims", d + 1)).alias("lo"), F.max(F.element_at("__dims", d + 1)).alias("hi")).alias(f"d{d}")
                 for d in range(n_dims)]
        inside = {r["__node"]: r for r in placed.groupBy("__node").agg(F.sum("__size").alias("w"), *edges).collect()}  # one row a node
        nodes = []
        for node, n in leaves.items():
            if n == 1 or node not in inside:
                continue
            r = inside[node]
            spans = [r[f"d{d}"]["hi"] - r[f"d{d}"]["lo"] for d in range(n_dims)]
            whole = whole or [max(1, s) for s in spans]
            dim = max(range(n_dims), key=lambda d: (spans[d] / whole[d], -d))
            nodes.append({"node": node, "dim": dim, "lo": r[f"d{dim}"]["lo"], "hi": r[f"d{dim}"]["hi"],
                          "want": r["w"] * ((n + 1) // 2) / n})
        cut = _medians(placed, nodes, slack * total / n_shards) if nodes else {}
        dims = {n["node"]: n["dim"] for n in nodes}
        cuts, below = [], {}
        for node, n in leaves.items():
            if n == 1:
                below[node] = 1
                continue
            v, h = cut.get(node, (0, 0))  # an empty node: nothing to divide
            cuts.append((node, dims.get(node, 0), v, h, 2 * node, 2 * node + 1))
            below |= {2 * node: (n + 1) // 2, 2 * node + 1: n // 2}
        tree.levels.append(cuts)
        leaves = below
        if any(n > 1 for n in leaves.values()):  # plans stay one join long
            placed = saved(_descend(placed, cuts), "shard-nodes")

    def in_order(node: int) -> tuple:
        return tuple(bin(node)[3:])
    tree.shard_of = {node: i for i, node in enumerate(sorted(leaves, key=in_order))}
    return tree


def kd_shards(docs: DataFrame, *, n_shards: int | None = None, target_bytes: int | None = None,
              dims: list[Column] | None = None) -> DataFrame:
    """``docs`` with size, text_crc32, law, shard, slot and grown_shard; columns of those names are replaced.

    Give the number of shards or the bytes that one should hold.  ``slot``
    numbers a shard's rows from 0 without gaps.  Shards come within a few
    thousandths of equal bytes, or one document's size; only rows equal in all
    dimensions, doc_id and text can't be divided.  Null metadata sorts first; a
    null text has size 1 and the checksum of no bytes (0).  An empty table
    gives an empty one.
    """
    if (n_shards is None) == (target_bytes is None):
        raise ValueError("give either n_shards or target_bytes")
    dims = dims or default_dimensions(docs)
    points = saved(_with_points(docs, dims).select("__size", "__dims", "__hash"), "shard-points")
    tree = build_tree(points, len(dims), n_shards, target_bytes)
    placed = _with_points(docs, dims).withColumn("__node", F.expr(_ROOT))
    for cuts in tree.levels:
        placed = _descend(placed, cuts)
    shards = F.broadcast(_small(docs.sparkSession, list(tree.shard_of.items()), "__node int, __shard int"))
    buckets = bucket_count(tree.rows // len(tree.shard_of) + 1)
    numbered = running_before(
        placed.join(shards, "__node").withColumns({"__one": F.lit(1), "__bucket": key_bucket(F.col("__hash"), buckets)}),
        ["__shard"], "__bucket", ["__hash", "doc_id"], "__one", "__slot")
    new = {"size": F.col("__size"), "text_crc32": F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).cast("long"),
           "law": F.lit("bytes"), "shard": F.col("__shard"), "slot": F.col("__slot").cast("long"),
           "grown_shard": F.lit(None).cast("int")}
    return numbered.select(*[c for c in docs.columns if c not in new], *[c.alias(n) for n, c in new.items()])
