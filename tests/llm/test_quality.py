import numpy as np
import pytest
from pyspark.sql import functions as F

from clickscope.llm import quality as Q
from clickscope.llm.queries import op10_robust_quality
from tests.conftest import SF_MID, SF_SMALL
from tests.llm.helpers import empty_docs, odd_docs


def slow_base(text):
    t = text or ""
    w = [x.decode() for x in t.encode().split()]
    lines = [x for x in t.split("\n") if x.encode().split()]
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    grams = [tuple(w[i: i + 3]) for i in range(len(w) - 2)]
    hit = set()
    for i, g in enumerate(grams):
        if grams.count(g) > 1:
            hit |= {i, i + 1, i + 2}
    n = len(w)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), dup, len(hit), n < 50 or 100 * len(hit) > 50 * n


def base(df):
    return [(r["doc_id"], *(r[c] for c in Q.BASE)) for r in df.collect()]


def test_query_base_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    short = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = op10_robust_quality(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(short)
    for r in got:
        if len(short[r["doc_id"]]) < 12_000:
            assert tuple(r[c] for c in Q.BASE) == slow_base(short[r["doc_id"]])
        assert not (r["base_failed"] and r["kept"])


@pytest.mark.parametrize("text", ["a b c a b c", "a a a a a", "a b c d", "x y z w x y z", "a b a b a b c d e a b a", "", "a", "a b c",
                                  "l1\nl1\n \n\nl1 x\nl1", "## $$ a|b <c>&", "ä ö\tü\n\nä ö ü é"])
def test_base_statistics(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    assert base(Q.base_statistics(df)) == [(1, *slow_base(text))]


def test_odd_rows(spark):
    docs, rows = odd_docs(spark, extra=("n_words", "kept"))
    got = Q.judge(docs).collect()
    assert sorted(((r["doc_id"], *(r[c] for c in Q.BASE)) for r in got), key=repr) == sorted(
        ((r[0], *slow_base(r[1])) for r in rows if r[1] is None or len(r[1]) < 9999 or True), key=repr)
    assert all(r["kept"] is not None for r in got)


def test_empty_table(spark):
    assert Q.judge(empty_docs(spark)).collect() == []


def _points(seed=3):
    rng = np.random.default_rng(seed)
    clean = rng.multivariate_normal([1, 2, 3], [[1, .6, 0], [.6, 1, .2], [0, .2, .5]], 900)
    bad = rng.multivariate_normal([9, -6, 3], np.eye(3) * .1, 180)
    return np.concatenate([clean, bad])


def _concentrated(x, floors, share=0.75, steps=4, trim=25.0):
    """The same search in numpy, over all rows: three starts, the least determinant, one step over what is no outlier."""
    x, floor = np.asarray(x), np.diag(np.square(floors))
    quartiles = np.percentile(x, [25, 75], axis=0)
    scale = np.diag(np.square((quartiles[1] - quartiles[0]) / 1.349))
    distances = lambda at, cov: np.einsum("ij,jk,ik->i", x - at, np.linalg.inv(cov), x - at)
    of = lambda rows: (rows.mean(axis=0), np.cov(rows.T, bias=True) + floor)
    ends = []
    for at, cov in ((np.median(x, axis=0), floor), (np.median(x, axis=0), scale + floor), of(x)):
        for _ in range(steps):
            d = distances(at, cov)
            at, cov = of(x[d <= np.sort(d)[int(np.ceil(share * len(x))) - 1]])
        ends.append((np.linalg.det(cov), at, cov))
    _, at, cov = min(ends, key=lambda e: e[0])
    return distances(*of(x[distances(at, cov) <= trim]))


def test_distances_follow_the_clean_rows(spark):
    pts, floors = _points(), [0.1, 0.1, 0.1]
    rows = spark.createDataFrame([("g", *map(float, p)) for p in pts], "__group string, a double, b double, c double")
    got = {(r["a"], r["b"]): r["distance"] for r in Q.robust_distances(rows, ["a", "b", "c"], floors).collect()}
    d = np.array([got[(float(p[0]), float(p[1]))] for p in pts])
    assert (d[900:] > 40).all() and (d[:900] > 40).mean() < 0.01
    want = _concentrated(pts, floors)
    assert np.corrcoef(np.log(d), np.log(want))[0, 1] > 0.995
    plain = pts - pts.mean(axis=0)
    masked = np.einsum("ij,jk,ik->i", plain, np.linalg.inv(np.cov(plain.T)), plain)
    assert (masked[900:] < 40).all()  # what the ordinary covariance would have missed


def _determinants(rows, x, floors, steps):
    """Log determinant of each (group, start) after the starts and after each step."""
    rows = rows.withColumn("__wider", F.lit(""))
    at, sizes = Q._starts(rows, x, floors, 15)
    out = []
    for step in range(steps + 1):
        out.append({(r[0], r[1]): r[2] for r in at.select("__group", "__start", Q._log_determinant(len(x))).collect()})
        if step < steps:
            at = Q._concentrated(rows, x, floors, at, sizes, 0.75, 15)
    return out


def test_determinants_do_not_rise_and_starts_differ(spark):
    # the plain start is drawn to a tight clump of outliers, where its determinant stays larger than that of the others
    rng = np.random.default_rng(8)
    clump = np.concatenate([rng.normal(0, 1, (700, 2)), rng.normal(12, 0.3, (200, 2))])
    both = [("a", *map(float, p)) for p in _points()[:, :2]] + [("b", *map(float, p)) for p in clump]
    got = _determinants(spark.createDataFrame(both, "__group string, x double, y double"), ["x", "y"], [0.05, 0.05], 4)
    for was, now in zip(got[1:], got[2:], strict=False):
        for key in was:
            assert now[key] <= was[key] + 0.02  # ranks are taken in bins, so subsets differ by a few rows
    assert {s for _, s in got[-1]} == {0, 1, 2}


def test_kept_equals_a_plain_estimate_on_a_whole_table(spark):
    """Verdicts of groups with their own estimates (languages here, all rows as of one source), against the same search in numpy with exact ranks."""
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").withColumn("source", F.lit("one"))
    rows = [r for r in Q.judge(docs).collect() if not r["base_failed"]]
    lang = {r[0]: (r[1], r[2]) for r in docs.select("doc_id", "lang", "text").collect()}
    groups = {}
    for r in rows:
        groups.setdefault(lang[r["doc_id"]][0], []).append(r)
    compared = 0
    for own in groups.values():
        if len(own) < 40:
            continue
        n = np.array([r["n_words"] for r in own])
        lines = np.array([sum(bool(x.strip(" \t\n\x0b\f\r")) for x in lang[r["doc_id"]][1].split("\n")) for r in own])
        x = np.column_stack([np.log1p(np.array([r["word_chars"] for r in own]) / n),
                             np.sqrt(np.array([r["n_symbols"] for r in own]) / np.array([r["word_chars"] for r in own])),
                             np.sqrt(np.array([r["n_repeat_words"] for r in own]) / n),
                             np.sqrt(np.array([r["n_dup_lines"] for r in own]) / np.maximum(lines, 1))])
        want = _concentrated(x, list(Q.DIMENSIONS.values()))
        cutoff = Q.chi_square_quantile(4, 1e-7)
        sure = np.abs(np.log(want / cutoff)) > 0.1  # exact and binned ranks may differ by a row or two
        assert ((want <= cutoff) == np.array([r["kept"] for r in own]))[sure].all()
        compared += sure.sum()
    assert compared > 200


def test_chi_square_quantiles():
    for d, chance, value in ((1, 0.05, 3.8415), (2, 0.01, 9.2103), (3, 0.001, 16.2662), (4, 0.05, 9.4877), (5, 0.01, 15.0863)):
        assert Q.chi_square_quantile(d, chance) == pytest.approx(value, abs=1e-3)


def test_constant_statistics_and_small_groups(spark):
    rows = spark.createDataFrame([("big", 1.0, 0.0)] * 300 + [("big", 1.0, 5.0)] + [("small", 1.0, 0.0), ("small", 9.0, 0.0)],
                                 "__group string, a double, b double")
    got = Q.robust_distances(rows, ["a", "b"], [0.1, 0.1]).groupBy("__group", "a", "b").agg(F.max("distance").alias("d")).collect()
    d = {(r[0], r[1], r[2]): r[3] for r in got}
    assert d[("big", 1.0, 0.0)] < 1 < 40 < d[("big", 1.0, 5.0)]
    assert d[("small", 1.0, 0.0)] < 1 < 40 < d[("small", 9.0, 0.0)]


def test_junk_goes_and_prose_stays(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_MID}/documents.parquet").collect()}
    got = [r for r in op10_robust_quality(spark, SF_MID).collect() if not r["base_failed"]]
    symbols = [r for r in got if r["n_symbols"] > 0.2 * r["word_chars"]]
    plain = [r for r in got if r["n_symbols"] == 0 and r["n_dup_lines"] == 0]
    assert symbols and not any(r["kept"] for r in symbols)
    assert np.mean([r["kept"] for r in plain]) > 0.98 and len(docs) == 1000


def _repeating(rng, n, repeats, lines):
    """A text of ``n`` words in lines of five; ``repeats`` words and ``lines`` lines are copies of others."""
    fresh = lambda k: [f"w{rng.integers(10**9):09d}" for _ in range(k)]
    out = [" ".join(fresh(5)) for _ in range((n - repeats) // 5)]
    phrase = " ".join(fresh(5))
    out += [phrase] * (repeats // 5)
    return "\n".join(out + ["x"] * lines)


def test_extreme_repetition_is_rejected_and_mild_stays(spark):
    rng = np.random.default_rng(4)
    rows = [(i, _repeating(rng, 200, 0, 0)) for i in range(300)]
    rows += [(1000 + i, _repeating(rng, 200, 100, 0)) for i in range(2)]   # half the words: in 20 of 40 lines
    rows += [(2000, "\n".join(["- a"] * 30 + [_repeating(rng, 200, 0, 0).replace("\n", " ")]))]  # nearly all lines
    rows += [(3000 + i, _repeating(rng, 200, 10, 0)) for i in range(3)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = {r["doc_id"]: r for r in Q.judge(docs).collect()}
    assert not any(r["base_failed"] for r in got.values())
    assert 0.45 <= got[1000]["n_repeat_words"] / got[1000]["n_words"] <= 0.5
    assert not any(got[i]["kept"] for i in (1000, 1001, 2000))
    assert all(r["kept"] for i, r in got.items() if i < 1000 or i >= 3000)


def test_a_rare_language_is_judged_by_its_own_rows(spark):
    rng = np.random.default_rng(6)
    rows = [("en|s", "en", float(v), 0.0) for v in rng.normal(1.8, 0.05, 1000)]
    rows += [("th|s", "th", float(v), 0.0) for v in rng.normal(2.8, 0.05, 150)] + [("th|s", "th", 4.0, 0.0)]  # one group under 200 rows
    rows += [(f"zh|s{i % 20}", "zh", float(v), 0.0) for i, v in enumerate(rng.normal(0.8, 0.05, 120))]  # six rows a group
    rows += [("zh|s3", "zh", 1.8, 0.0)]
    rows += [("fr|s", "fr", float(v), 0.0) for v in rng.normal(2.3, 0.05, 15)]  # between a share of its own and none
    frame = spark.createDataFrame(rows, "__group string, __wider string, a double, b double")
    got = Q.robust_distances(frame, ["a", "b"], [0.06, 0.2]).collect()
    assert len(got) == len(rows)
    far = [(r["__wider"], r["a"]) for r in got if r["distance"] > 40]
    assert sorted(far) == [("th", 4.0), ("zh", 1.8)]
