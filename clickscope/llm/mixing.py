"""Mixing sources to target weights with exact word budgets.

Every document gets a hash-random key.  Within its source the documents are
sorted by key, a distributed prefix sum of their sizes gives each one's place,
and the source is cut at its exact budget: whole epochs first, then the
documents whose place lies before what remains, the last one cut inside.

A source's target is its weight's share of all words, at most ``max_epochs``
times its own words; what that cuts off is shared again by weight.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import bucket_count, running_before, saved, words

_KEY_SPACE = 1 << 28  # seven hex digits of the key
BROADCAST_SOURCES = 100_000


def _source_key(source: Column) -> Column:
    """Null-free text that sorts by code point, null last (no other source starts with the marker)."""
    return F.when(source.isNull(), "n").otherwise(F.concat(F.lit("a"), source))


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """``sizes`` (one row a source: __source, source_size) with ``target``.

    Sources by code point, null last, take the weights in turn.  Targets rise
    in proportion to weight until they use up all words; one that would pass
    ``max_epochs`` times its source's size stops there.  Sorted by the level
    at which they stop, the sources that stop are a prefix, so one running sum
    settles all targets.  The table has one row a source; it is sorted in one
    task.
    """
    nth = F.row_number().over(Window.orderBy("__source")) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (nth % len(weights) + 1).cast("int"))
    table = sizes.withColumn("__weight", weight).withColumn("__cap", F.col("source_size") * max_epochs)
    level = F.col("__cap") / F.col("__weight")
    by_level = Window.orderBy(level, "__source").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    as_double = lambda c: F.col(c).cast("double")
    table = (table
             .withColumn("__left", F.sum("source_size").over(everything) - F.coalesce(F.sum("__cap").over(by_level), F.lit(0)))
             .withColumn("__open", F.sum("__weight").over(everything) - F.coalesce(F.sum("__weight").over(by_level), F.lit(0))))
    # the first source whose cap lies above the level that what is left reaches: from there on none stops
    goes_on = F.when(as_double("__cap") * as_double("__open") > as_double("__left") * as_double("__weight"),
                     F.struct("__left", "__open"))
    table = table.withColumn("__level", F.first(goes_on, ignorenulls=True).over(
        Window.orderBy(level, "__source").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    share = as_double("__level.__left") * as_double("__weight")
    stops = F.col("__level").isNull() | (as_double("__cap") * as_double("__level.__open") <= share)
    target = F.when(stops, as_double("__cap")).otherwise(share / as_double("__level.__open"))
    return table.withColumn("target", target).select("__source", "source_size", "target")


def mix_plan(docs: DataFrame, *, seed: str = "mix", weights: tuple[int, ...] = (1, 2, 3), max_epochs: int = 3) -> DataFrame:
    """``docs`` with size, source_size, target, epochs and part.

    A row is taken ``epochs`` times whole and then for its first ``part`` words
    (null: not again).  Null texts have size 0; a null source is a source.
    Rows that repeat a doc_id have the same key and are placed by size and
    text; rows equal in all that are interchangeable, so reruns agree.  An
    empty table gives an empty one.
    """
    new = ["source_size", "target", "epochs", "part", *(["size"] if "text" in docs.columns else [])]
    docs = docs.drop(*new)  # columns of those names are replaced
    sized = docs.withColumn("size", F.size(words(F.col("text"))).cast("long")) if "text" in docs.columns else docs
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    keyed = (sized.withColumn("__source", _source_key(F.col("source"))).withColumn("__key", key))
    sizes = keyed.groupBy("__source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("__rows"))
    rows, n_sources = sizes.agg(F.sum("__rows"), F.count(F.lit(1))).first()
    buckets = bucket_count(rows or 0)
    at = F.floor(F.conv(F.substring("__key", 1, 7), 16, 10).cast("long") * buckets / _KEY_SPACE).cast("int")
    order = ["__key", "size", *(["__tie"] if "text" in docs.columns else [])]
    if "text" in docs.columns:
        keyed = keyed.withColumn("__tie", F.xxhash64("text"))
    placed = running_before(keyed.withColumn("__bucket", at), ["__source"], "__bucket", order, "size", "__before")
    budget = F.floor("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size")).cast("long")).otherwise(0)
    goal = saved(targets(sizes.drop("__rows"), weights, max_epochs), "mix-targets")
    # one row a source: sent to all tasks if they are few, else joined by source, where AQE splits a hot one
    planned = (placed.join(F.broadcast(goal) if n_sources <= BROADCAST_SOURCES else goal, "__source")
               .withColumn("epochs", whole)
               .withColumn("__rest", budget - F.col("epochs") * F.col("source_size"))
               .withColumn("part", F.when(F.col("__before") < F.col("__rest"),
                                          F.least("size", F.col("__rest") - F.col("__before")))))
    return planned.select(*[c for c in docs.columns if c != "size"], "size", "source_size", "target", "epochs", "part")


def taken() -> Column:
    """Words that the plan takes of a row, repeats counted."""
    return (F.col("epochs") * F.col("size") + F.coalesce("part", F.lit(0))).cast("long")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of the mix: each document once for every epoch that takes it; columns as in ``docs``.

    A document that the budget cuts inside keeps its first words, joined by one
    space, in its last epoch, and ``n_chars`` (if there) follows; all others
    are whole.
    """
    plan = mix_plan(docs.withColumns({f"__own_{i}": F.col(c) for i, c in enumerate(docs.columns)}), **how)
    again = F.col("epochs") + F.when(F.col("part").isNotNull(), 1).otherwise(0)
    copies = (plan.where(again > 0)
              .withColumn("__nth", F.explode(F.sequence(F.lit(1).cast("long"), again)))
              .withColumn("__cut", (F.col("__nth") > F.col("epochs")) & (F.col("part") < F.col("size"))))
    text = F.when(F.col("__cut"), F.array_join(F.slice(words(F.col("text")), 1, F.col("part").cast("int")), " ")).otherwise(F.col("text"))
    out = []
    for i, c in enumerate(docs.columns):
        own = F.col(f"__own_{i}")
        if c == "text":
            own = text
        elif c == "n_chars":
            own = F.when(F.col("__cut"), F.length(text)).otherwise(own).cast(docs.schema[c].dataType)
        out.append(own.alias(c))
    return copies.select(*out)
