"""SimHash near-duplicates over a byte-position inverted index.

A fingerprint has eight positional bytes.  Two fingerprints that differ in at
most ``d`` bits differ in at most ``d`` bytes, so they share at least ``8 - d``
positional bytes: the guaranteed minimum.  A posting of the index stands for
``8 - d`` positions and their bytes at once; two fingerprints meet in a
posting exactly if their tally of shared bytes reaches that minimum, so the
count filter acts on keys and no pair below it is ever formed (single-byte
posting lists would hold a 256th of the corpus each, and their pairs grow with
its square).  What meets is verified by its bit distance.

Only distinct fingerprints are indexed, so copies cost nothing, and a posting
list holds at most ``2^(8 d)`` entries.  Lists over ``list_pairs`` entries are
not paired: their entries are grouped by their one-bit neighbours within the
free bytes, which gives links between the same fingerprints with work linear
in the list.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import ascii_lower, saved

_SHINGLES_AT_ONCE = 1 << 16


def simhash64(text: bytes | None, shingle_words: int = 3, seed: int = 42) -> int:
    """SimHash of the lower-cased words' shingles, repeats included (no words: 0)."""
    found = ascii_lower(text or b"").split()
    if not found:
        return 0
    k = min(shingle_words, len(found))
    joined = b" ".join(found)
    size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[: len(found) - k + 1], end[k - 1:]
    ones, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(first), _SHINGLES_AT_ONCE):
        part = slice(at, at + _SHINGLES_AT_ONCE)
        h = np.array([digest(joined[a:b], seed) for a, b in zip(first[part].tolist(), last[part].tolist())],
                     dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(first), bitorder="little").view("<u8")[0])


def fingerprint(text: Column, shingle_words: int = 3) -> Column:
    """The 64-bit SimHash of a text column as a long (null text: 0)."""
    @F.arrow_udf("long")
    def of(texts: pa.Array) -> pa.Array:
        got = [simhash64(t.as_buffer().to_pybytes() if t.is_valid else None, shingle_words)
               for t in texts.cast(pa.large_binary())]
        return pa.array(np.array(got, dtype=np.uint64).view(np.int64))
    return of(text)


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _masks(max_bits: int) -> list[tuple[int, list[int]]]:
    """For each set of positions that may differ: the mask of the other bytes, and the free bits."""
    out = []
    for free in combinations(range(8), max_bits):
        bits = [8 * p + b for p in free for b in range(8)]
        out.append((~sum(1 << b for b in bits) & (2**64 - 1), bits))
    return out


def _signed(x: int) -> int:
    return x - 2**64 if x >= 2**63 else x


def links(fps: DataFrame, max_bits: int = 2, list_pairs: int = 32) -> DataFrame:
    """Links (u, v), u < v, between the distinct fingerprints of column ``fp``.

    Their connected components are those of all pairs within ``max_bits``;
    lists up to ``list_pairs`` entries give every such pair.
    """
    if not 1 <= max_bits <= 2:
        raise ValueError("max_bits must be 1 or 2: one-bit neighbours connect no farther")
    if max_bits == 1:
        list_pairs = 256  # a list has no more entries then, and one-bit neighbours would link two bits
    masks = _masks(max_bits)
    keys = F.array(*[F.struct(F.lit(i).cast("byte").alias("at"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("kept"))
                     for i, (m, _) in enumerate(masks)])
    lists = (fps.select("fp", F.explode(keys).alias("k"))
             .groupBy(F.col("k.at").alias("at"), F.col("k.kept").alias("kept"))
             .agg(F.collect_list("fp").alias("fps"))
             .where(F.size("fps") > 1))
    lists = saved(lists, "simhash-postings")
    near = F.flatten(F.transform("fps", lambda a: F.transform(
        F.filter("fps", lambda b: (a < b) & (F.bit_count(a.bitwiseXOR(b)) <= max_bits)),
        lambda b: F.struct(a.alias("u"), b.alias("v")))))
    short = lists.where(F.size("fps") <= list_pairs).select(F.explode(near).alias("p")).select("p.u", "p.v")
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in bits])
                      for _, bits in masks])
    spread = (lists.where(F.size("fps") > list_pairs)
              .select("at", F.explode("fps").alias("fp"))
              .select("at", "fp", F.explode(F.element_at(flips, F.col("at") + 1)).alias("flip"))
              .select("at", "fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("near")))
    hubs = spread.groupBy("at", "near").agg(F.min("fp").alias("u"), F.count(F.lit(1)).alias("n")).where("n > 1")
    star = spread.join(hubs, ["at", "near"]).where("u < fp").select("u", F.col("fp").alias("v"))
    return short.unionByName(star).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (u, v): root is the smallest node it can reach.

    Alternating large-star and small-star rounds; each round's edges go to the
    shared scratch folder, so lineage stays short and nothing is collected.
    """
    def stars(e: DataFrame, larger: bool) -> DataFrame:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if not larger:
            both = both.where("v < u")
        # written, so that both sides of the join are plain exchanges: then a hub's edges can be split over tasks
        low = saved(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u")), "components-least")
        seen = both.join(low, "u")
        moved = seen.where("v > u" if larger else "v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        if not larger:
            moved = moved.unionByName(low.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return (moved.where("a <> b")
                .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())

    def mark(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()

    edges = saved(edges, "components-0")
    was = mark(edges)
    while was[0]:
        edges = saved(stars(stars(edges, True), False), "components")
        now = mark(edges)
        if now == was:
            break
        was = now
    return edges.select(F.col("v").alias("node"), F.col("u").alias("root")).unionByName(
        edges.select(F.col("u").alias("node"), F.col("u").alias("root")).distinct())


def near_duplicates(prints: DataFrame, max_bits: int = 2) -> DataFrame:
    """``prints`` (columns doc_id, fp, any others) with ``component_id``.

    ``component_id`` is the smallest doc_id that chains of links within
    ``max_bits`` reach, the row's own included; equal fingerprints are linked,
    so all texts without words (null, empty, white space; fingerprint 0) are.
    Null doc_ids count only if a component has no other (then null).  Rows are
    kept as they are, repeated ones too; an empty table gives an empty one.
    ``prints`` is read several times: pass a saved table.
    """
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("__first"))
    roots = components(links(firsts.select("fp"), max_bits))
    rooted = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))
    best = saved(rooted.groupBy("root").agg(F.min("__first").alias("component_id")), "simhash-components")
    classes = saved(rooted.join(best, "root").select("fp", "component_id"), "simhash-classes")
    return prints.join(classes, "fp")  # AQE splits a fingerprint that many copies share


def one_of_each(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """The documents without near-duplicates: one row of each component stays.

    That is the row with the smallest doc_id (rows without doc_id come last);
    rows that repeat a doc_id with the same text, or the doc_id that stands for
    its component, count once.  All columns are kept.
    """
    ident = F.xxhash64("text")
    prints = saved(docs.select("doc_id", ident.alias("__text"), fingerprint(F.col("text"), shingle_words).alias("fp")),
                   "simhash-prints")
    firsts = prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "__text")).alias("__row"))
    roots = components(links(firsts.select("fp"), max_bits))
    best = (firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
            .groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("__row").alias("r"))
            .select(F.col("r.doc_id").alias("__doc"), F.col("r.__text").alias("__same")))
    marked = docs.withColumn("__text", ident)
    stay = marked.join(best, F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__text") == F.col("__same")), "left_semi")
    return stay.dropDuplicates(["doc_id", "__text"]).select(*docs.columns)
