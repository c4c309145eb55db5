"""Quality rules: base statistics and robust multivariate outliers, in DataFrame functions only.

Statistics of each document are transformed to a vector.  For each group
(language and source) the minimum-covariance-determinant estimate is found by
concentration steps: mean and covariance of the ``share`` of rows with the
smallest distances, distances anew, and so on.  Steps begin at three places:
the medians with noise as scale, the medians with the quartiles' scale, and the
plain mean and covariance; a group keeps the one that ends with the least
determinant, and takes one more step over the rows that are no outliers.  A
document whose squared Mahalanobis distance passes the chi-square quantile of
``chance`` is rejected.

Means, covariances and the ranks of distances are sums over fixed bins and
moments, so a group of any size is pre-aggregated where its rows lie; each
step joins one row per group back.  A group has its own estimate from
``2 * least_rows`` rows on (ten for each dimension); with fewer its moments
are mixed with those of its language in all sources, in shares that fall
evenly to none at ``least_rows``, and the language's with those of all rows by
the same rule.  The covariance has a floor (the variance that one would call
noise): most statistics are exactly zero in clean text.
"""

from __future__ import annotations

import math
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickscope.llm.common import WHITE, saved, words

# The symbols that count.
SYMBOLS = "#*$%&|<>"

# Vector dimensions and the standard deviation under which a difference is noise: 6 % of the mean word length, one
# symbol in a thousand characters, one word in 100 and one line in 44 repeated (the shares enter by their roots).  The
# base rules pass up to half the words repeated, so these levels must leave either repetition a distance over the cutoff.
DIMENSIONS = {"word_length": 0.06, "symbols": 0.03, "repeats": 0.10, "dup_lines": 0.15}

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(found: Column) -> Column:
    """Words in 3-word windows that occur twice or more in the text, the first included.

    The windows' hashes are sorted with their places; those that equal a
    neighbour are repeated, and their places, sorted again, cover at most
    three words each.
    """
    def covered(places: Column) -> Column:
        # each place covers up to the next one, three words at most; the last three
        gaps = F.zip_with(F.slice(places, 1, F.size(places) - 1), F.slice(places, 2, F.size(places) - 1),
                          lambda a, b: F.least(b - a, F.lit(3)))
        return F.when(F.size(places) < 2, F.size(places).cast("long") * 3).otherwise(
            F.aggregate(gaps, F.lit(3).cast("long"), lambda s, g: s + g))

    def places(sorted_windows: Column) -> Column:
        n = F.size(sorted_windows)
        same = F.zip_with(F.slice(sorted_windows, 1, n - 1), F.slice(sorted_windows, 2, n - 1),
                          lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))
        return F.array_sort(F.array_distinct(F.flatten(same)))

    def windows(w: Column) -> Column:
        n = F.size(w)
        shifted = F.zip_with(F.zip_with(F.slice(w, 1, n - 2), F.slice(w, 2, n - 2), lambda a, b: F.struct(a.alias("a"), b.alias("b"))),
                             F.slice(w, 3, n - 2), lambda ab, c: F.xxhash64(ab["a"], ab["b"], c))
        return F.sort_array(F.transform(shifted, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    some = _let(windows(found), lambda s: _let(places(s), covered))
    return F.when(F.size(found) < 4, F.lit(0).cast("long")).otherwise(some)


def base_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed of each whole text.

    A null or empty text has zeros and fails.  Columns of these names are
    replaced.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.translate(x, WHITE, "") != "")
    counted = (docs.drop(*[c for c in docs.columns if c in BASE])
               .withColumn("__words", words(F.col("text"))).withColumn("__lines", lines)
               .withColumns({
                   "n_words": F.size("__words").cast("long"),
                   "word_chars": F.length(F.translate(text, WHITE, "")).cast("long"),
                   "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
                   "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
                   "n_repeat_words": repeated_words(F.col("__words")),
                   "__n_lines": F.size("__lines").cast("long")}))
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", failed).drop("__words", "__lines")


def statistic_vector() -> list[Column]:
    """Transformed statistics: log mean word length, root shares of symbols, repeated words and repeated lines."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log1p(F.col("word_chars") / n),
            F.sqrt(F.col("n_symbols") / F.greatest(F.col("word_chars"), F.lit(1))),
            F.sqrt(F.col("n_repeat_words") / n),
            F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("__n_lines"), F.lit(1)))]


def _moments(x: list[str]) -> list[Column]:
    pairs = list(combinations_with_replacement(range(len(x)), 2))
    return [F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"s{i}") for i, c in enumerate(x)],
            *[F.sum(F.col(x[i]) * F.col(x[j])).alias(f"s{i}_{j}") for i, j in pairs]]


def _cholesky(d: int, floors: list[float]) -> dict[str, Column]:
    """Mean and Cholesky factor of the covariance (floor added to the variances) from the moments."""
    cov = lambda i, j: (F.col(f"s{i}_{j}") / F.col("n") - F.col(f"m{i}") * F.col(f"m{j}"))
    steps: dict[str, Column] = {f"m{i}": F.col(f"s{i}") / F.col("n") for i in range(d)}
    for j in range(d):
        for i in range(j, d):
            rest = cov(j, i) if i != j else F.greatest(cov(i, i), F.lit(0.0)) + floors[i] ** 2
            for k in range(j):
                rest = rest - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            steps[f"l{i}_{j}"] = F.sqrt(F.greatest(rest, F.lit(floors[i] ** 2 / 4))) if i == j else rest / F.col(f"l{j}_{j}")
    return steps


def _estimate(moments: DataFrame, d: int, floors: list[float]) -> DataFrame:
    for name, c in _cholesky(d, floors).items():
        moments = moments.withColumn(name, c)
    keep = [f"m{i}" for i in range(d)] + [f"l{i}_{j}" for j in range(d) for i in range(j, d)]
    return moments.select("__group", "__start", F.struct(*keep).alias("__at"))


def _log_determinant(d: int) -> Column:
    return sum((F.log(F.col(f"__at.l{i}_{i}")) for i in range(1, d)), F.log(F.col("__at.l0_0"))) * 2


def _distance(x: list[str]) -> Column:
    """Squared Mahalanobis distance: forward substitution with the group's factor."""
    y: list[Column] = []
    for i, c in enumerate(x):
        rest = F.col(c) - F.col(f"__at.m{i}")
        for k in range(i):
            rest = rest - F.col(f"__at.l{i}_{k}") * y[k]
        y.append(rest / F.col(f"__at.l{i}_{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _mixed(rows: str, own: str, wider: Column, least_rows: int) -> Column:
    """The value of a group, mixed with that of the wider group if its rows are few (null: the wider one's)."""
    share = F.least(F.greatest((F.col(rows) - least_rows) / F.lit(float(least_rows)), F.lit(0.0)), F.lit(1.0))
    return F.when((share == 0) | F.col(own).isNull(), wider).otherwise(share * F.col(own) + (1 - share) * wider)


def _for_all_groups(own: DataFrame, wider: DataFrame, whole: list[Column], names: list[str], sizes: DataFrame, least_rows: int,
                    key: tuple[str, ...] = ()) -> DataFrame:
    """Values of each group (``own``) and ``key``, mixed with those of ``wider`` and of all rows (``whole``)."""
    language = [_mixed("wider_rows", f"__w_{c}", v, least_rows) for c, v in zip(names, whole, strict=True)]
    values = [_mixed("rows", c, w, least_rows).alias(c) for c, w in zip(names, language, strict=True)]
    wider = wider.select("__wider", *key, *[F.col(c).alias(f"__w_{c}") for c in names])
    return (sizes.join(own, ["__group", *key], "left").join(wider, ["__wider", *key], "left")
            .select("__group", *key, *values))


def _moments_of(near: DataFrame, x: list[str], sizes: DataFrame, least_rows: int) -> DataFrame:
    """Moments of one row each (n is 1) for each group and start, so that those of groups of any size can be mixed."""
    sums = saved(near.groupBy("__start", "__wider", "__group").agg(*_moments(x)), "quality-moments")
    names = sums.columns[3:]
    each = lambda df: df.select(*[c for c in df.columns if c not in names], *[(F.col(c) / F.col("n")).alias(c) for c in names])
    total = [F.sum(c).alias(c) for c in names]  # moments add up
    whole = {start: values for start, *values in each(sums.groupBy("__start").agg(*total)).collect()}  # one row a start
    if not whole:
        return sums.drop("__wider")
    of_start = [F.create_map(*[v for start in whole for v in (F.lit(start), F.lit(whole[start][i]))])[F.col("__start")] for i in range(len(names))]
    sizes = sizes.withColumn("__start", F.explode(F.array(*[F.lit(start) for start in whole])))
    return _for_all_groups(each(sums.drop("__wider")), each(sums.groupBy("__wider", "__start").agg(*total)), of_start, names, sizes,
                           least_rows, ("__start",))


def _concentrated(rows: DataFrame, x: list[str], floors: list[float], at: DataFrame, sizes: DataFrame, share: float,
                  least_rows: int) -> DataFrame:
    """One concentration step: the estimates over the ``share`` of each group's rows that lie nearest by the estimates ``at``."""
    key = ["__group", "__start"]
    # estimates have one row a group and start; the join leaves the choice of strategy to the planner
    seen = rows.join(at, "__group").withColumn("distance", _distance(x))
    # bins a 32nd of an octave wide; the smallest distances share the first one
    seen = seen.withColumn("__bin", F.floor(32 * F.log2(F.greatest("distance", F.lit(1e-6)))).cast("int"))
    counts = seen.groupBy(*key, "__bin").agg(F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy(*key).orderBy("__bin"))
    total = F.sum("n").over(Window.partitionBy(*key))
    limit = (counts.select(*key, "__bin", (upto >= share * total).alias("__enough"))
             .groupBy(*key).agg(F.min(F.when(F.col("__enough"), F.col("__bin"))).alias("__last")))
    near = seen.join(saved(limit, "quality-limit"), key).where("__bin <= __last")
    return saved(_estimate(_moments_of(near, x, sizes, least_rows), len(x), floors), "quality-estimate")


def _starts(rows: DataFrame, x: list[str], floors: list[float], least_rows: int) -> tuple[DataFrame, DataFrame]:
    """Estimates to begin with (three for each group), and the rows of each group and of what holds it."""
    d = len(x)
    middle = [F.percentile_approx(c, 0.5, 1000).alias(f"m{i}") for i, c in enumerate(x)]
    # quartiles of the normal distribution lie 1.349 standard deviations apart
    wide = [((F.percentile_approx(c, 0.75, 1000) - F.percentile_approx(c, 0.25, 1000)) / 1.349).alias(f"q{i}") for i, c in enumerate(x)]
    own = saved(rows.groupBy("__wider", "__group").agg(F.count(F.lit(1)).alias("rows"), *middle, *wide), "quality-groups")
    wider = saved(rows.groupBy("__wider").agg(F.count(F.lit(1)).alias("wider_rows"), *middle, *wide), "quality-wider")
    names = own.columns[3:]
    whole = rows.agg(*middle, *wide).first()
    sizes = saved(own.select("__wider", "__group", "rows").join(wider.select("__wider", "wider_rows"), "__wider"), "quality-sizes")
    medians = _for_all_groups(own.drop("__wider", "rows"), wider, [F.lit(v) for v in whole], names, sizes, least_rows)

    def about_medians(start: int, scale) -> DataFrame:
        return medians.select("__group", F.lit(start).alias("__start"), F.struct(
            *[F.col(f"m{i}") for i in range(d)],
            *[(scale(i) if i == j else F.lit(0.0)).alias(f"l{i}_{j}") for j in range(d) for i in range(j, d)]).alias("__at"))
    plain = _estimate(_moments_of(rows.withColumn("__start", F.lit(2)), x, sizes, least_rows), d, floors)
    return saved(about_medians(0, lambda i: F.lit(floors[i]))
                 .unionByName(about_medians(1, lambda i: F.sqrt(F.col(f"q{i}") * F.col(f"q{i}") + floors[i] ** 2)))
                 .unionByName(plain), "quality-estimate"), sizes


def robust_distances(rows: DataFrame, x: list[str], floors: list[float], *, share: float = 0.75, steps: int = 4,
                     least_rows: int | None = None, trim: float = 25.0) -> DataFrame:
    """``rows`` (__group and the columns ``x``) with ``distance``, squared, to the group's robust centre.

    A column ``__wider`` names what holds a group and lends it moments if it
    has few rows (none: all rows do).  ``least_rows`` is five for each
    dimension unless given.  ``rows`` is read several times: pass a saved
    table.  Starts that end with equal determinants: the first one counts.
    """
    least_rows = least_rows or 5 * len(x)
    if "__wider" not in rows.columns:
        rows = rows.withColumn("__wider", F.lit(""))
    at, sizes = _starts(rows, x, floors, least_rows)
    for _ in range(steps):
        at = _concentrated(rows, x, floors, at, sizes, share, least_rows)
    best = (at.groupBy("__group").agg(F.min(F.struct(_log_determinant(len(x)).alias("size"), "__start", "__at")).alias("best"))
            .select("__group", "best.__start", "best.__at"))
    near = rows.join(saved(best, "quality-best"), "__group").withColumn("distance", _distance(x)).where(F.col("distance") <= trim)
    last = _estimate(_moments_of(near.withColumn("__start", F.lit(0)), x, sizes, least_rows), len(x), floors)
    return rows.join(saved(last, "quality-estimate"), "__group").withColumn("distance", _distance(x)).drop("__at", "__start")


def chi_square_quantile(d: int, chance: float) -> float:
    """What a sum of ``d`` squared normal values passes with that chance."""
    def passes(x: float) -> float:
        h = x / 2
        if d % 2:
            return math.erfc(math.sqrt(h)) + math.exp(-h) * sum(h ** (k - 0.5) / math.gamma(k + 0.5) for k in range(1, (d + 1) // 2))
        return math.exp(-h) * sum(h ** k / math.factorial(k) for k in range(d // 2))
    low, high = 0.0, 1.0
    while passes(high) > chance:
        high *= 2
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if passes(middle) > chance else (low, middle)
    return high


def judge(docs: DataFrame, *, chance: float = 1e-7, **how) -> DataFrame:
    """doc_id, the base statistics, distance and kept for each row of ``docs``.

    ``chance`` is that of a vector of the estimated distribution to be
    rejected, were it normal; texts have heavier tails, so it is small.  Null
    languages and sources are groups like any other; rows that repeat are
    judged alike, texts of any length as a whole; further columns are left out,
    whatever their names; an empty table gives an empty one.  Documents that fail the
    base rules are not kept and are left out of the estimates (their distance
    is null).
    """
    language = F.coalesce(F.concat(F.lit("a"), "lang"), F.lit("n"))
    group = F.concat_ws("\x00", F.length(language).cast("string"), language,
                        F.coalesce(F.concat(F.lit("a"), "source"), F.lit("n")))
    x = [f"__x{i}" for i in range(len(DIMENSIONS))]
    based = base_statistics(docs.select("doc_id", "lang", "source", "text")).withColumns({"__group": group, "__wider": language})
    rows = saved(based.withColumns(dict(zip(x, statistic_vector(), strict=True))).drop("text", "lang", "source", "__n_lines"),
                 "quality-statistics")
    sound = robust_distances(rows.where("not base_failed"), x, list(DIMENSIONS.values()), **how)
    out, cutoff = ["doc_id", *BASE], chi_square_quantile(len(DIMENSIONS), chance)
    return (sound.select(*out, "distance", (F.col("distance") <= cutoff).alias("kept"))
            .unionByName(rows.where("base_failed").select(*out, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))))
