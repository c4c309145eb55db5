"""URL rules and empirical-Bayes host reputation, in DataFrame functions only.

Labelled page outcomes (bad or not) are shrunk through beta-binomial priors
along suffix, registered domain and host.  How many pages the prior of a level
is worth is estimated from the data by moments: the more the rates of siblings
differ beyond what chance explains, the less they say of each other.  The prior
of a group rests on the level above without the group's own pages, so that no
page counts twice, and is never worth more than what it rests on.  A host
without a label has its domain's reputation, and so on up.  A page is blocked if
the lower bound of the credible interval of its host's bad rate lies above
``most_bad``.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickscope.llm.common import saved

# Suffixes of two labels under which anyone can register a domain; a parameter, so that a full list can be given.
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.nz", "co.za", "co.in", "co.jp", "ne.jp", "or.jp",
            "co.kr", "com.br", "com.cn", "com.mx", "com.tr", "com.tw")

# Bounds of the pages that a prior is worth before what it rests on is counted.
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0


@dataclass(frozen=True)
class Rule:
    """``site`` is a host and the start of a path, like ``example.net/en/``."""

    site: str
    verdict: str

    @property
    def host(self) -> str:
        return self.site.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.site.partition("/")[2]


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or without ``://``: empty."""
    rest = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(rest, upper, upper.lower()), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _last_labels(host: Column, suffixes: Sequence[str], more: int) -> Column:
    """The longest of the suffixes (of two labels or more) that ends the host, else its last label; and ``more`` labels before."""
    found = F.substring_index(host, ".", -1 - more)
    for n in sorted({s.count(".") + 1 for s in suffixes}):
        same = [s for s in suffixes if s.count(".") + 1 == n]
        found = F.when(F.substring_index(host, ".", -n).isin(same), F.substring_index(host, ".", -n - more)).otherwise(found)
    return found


def suffix(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    return _last_labels(host, suffixes, 0)


def registered_domain(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The host's suffix and the label before it."""
    return _last_labels(host, suffixes, 1)


def rule_for(host: Column, path: Column, rules: list[Rule]) -> Column:
    """(rule, verdict) of the longest rule that fits, null if none does.

    A rule fits its host and all subdomains if the path starts with the
    rule's.  Rules are a parameter list of bounded length.
    """
    found: Column = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: (len(r.site), r.site)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        found = F.when(fits, F.struct(F.lit(r.site).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(found)
    return found


def _totals() -> list[Column]:
    """Pages of a parent, and what the spread of its children's rates is estimated from."""
    bad, n = F.col("bad").cast("double"), F.col("n").cast("double")
    return [F.sum("bad").alias("bad"), F.sum("n").alias("n"), F.sum(F.when(n > 0, bad * bad / n)).alias("spread"),
            F.sum(n * n).alias("square"), F.sum((n > 0).cast("long")).alias("kids")]


def prior_strength(parents: DataFrame, least: float = LEAST_STRENGTH, most: float = MOST_STRENGTH) -> float:
    """Pages that the prior of the parents' children is worth, by moments pooled over all parents.

    For a parent of rate p with N pages and k children of n pages each,
    sum(n (child's rate - p)^2) is expected to be p (1 - p) (k - 1 + rho (N -
    sum(n^2) / N - (k - 1))); the strength is 1 / rho - 1.  Without spread
    beyond chance, or siblings to see it by, it is ``most``.
    """
    p, by_chance = F.col("bad") / F.col("n"), F.col("kids") - 1
    over = F.col("spread") - F.col("bad") * p - p * (1 - p) * by_chance
    room = p * (1 - p) * (F.col("n") - F.col("square") / F.col("n") - by_chance)
    over, room = parents.where("n > 0").agg(F.sum(over), F.sum(room)).first()  # two numbers
    if not room or room <= 0 or over <= 0:
        return most
    return min(max(room / over - 1, least), most)


def _with_prior(children: DataFrame, strength: float) -> DataFrame:
    """``children`` (bad, n and their parent's __bad, __n, __mean, __weight) with mean and weight of their priors.

    The parent without the child's pages is a beta distribution of its own; the
    weight is that of the one beta with the variance of both together.
    """
    left = F.col("__n") - F.col("n") + F.col("__weight")
    mean = (F.col("__bad") - F.col("bad") + F.col("__weight") * F.col("__mean")) / left
    share = left / (left + 1) * F.lit(strength / (strength + 1))
    return children.withColumns({"mean": mean, "weight": share / (1 - share)}).drop("__bad", "__n", "__mean", "__weight")


def _as_parents(groups: DataFrame, key: list[str]) -> DataFrame:
    return groups.select(*key, *[F.col(c).alias(f"__{c}") for c in ("bad", "n", "mean", "weight")])


def host_reputation(pages: DataFrame, outcomes: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """(host, mean, weight) for every host of ``pages`` (page_id, host).

    ``outcomes`` has (page_id, bad); rows with a null in either teach nothing,
    repeated rows count as often as they are there.  ``mean`` is the posterior
    mean of the host's bad rate, ``weight`` the pages it rests on, the prior's
    included.  The suffixes' own prior is the rate of all pages, worth
    ``LEAST_STRENGTH``; without any label all rates are zero.
    """
    known = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(
        F.sum(F.col("bad").cast("long")).alias("bad"), F.count(F.lit(1)).alias("n"))
    hosts = saved(pages.select("page_id", "host").join(known, "page_id", "left").groupBy("host")
                  .agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
                  .withColumns({"domain": registered_domain(F.col("host"), suffixes), "suffix": suffix(F.col("host"), suffixes)}),
                  "host-outcomes")
    domains = saved(hosts.groupBy("suffix", "domain").agg(*_totals()), "domain-outcomes")
    tops = saved(domains.groupBy("suffix").agg(*_totals()), "suffix-outcomes")
    whole = tops.agg(*_totals())
    bad, n = (x or 0 for x in whole.select("bad", "n").first())  # two numbers
    rate = bad / n if n else 0.0
    root = {"__bad": F.lit(bad), "__n": F.lit(n), "__mean": F.lit(rate), "__weight": F.lit(LEAST_STRENGTH)}
    inner, outer = prior_strength(domains), prior_strength(tops)
    tops = _with_prior(tops.withColumns(root), prior_strength(whole))
    domains = _with_prior(domains.join(_as_parents(tops, ["suffix"]), "suffix"), outer)
    hosts = _with_prior(hosts.join(_as_parents(domains, ["suffix", "domain"]), ["suffix", "domain"]), inner)
    total = F.col("n") + F.col("weight")
    return hosts.select("host", ((F.col("bad") + F.col("weight") * F.col("mean")) / total).alias("mean"), total.alias("weight"))


def lower_bound(mean: Column, weight: Column, z: float = 1.645) -> Column:
    """Lower quantile of a beta distribution with that mean and weight (z: of the normal distribution).

    By the cube-root approximation of the F distribution, within 0.01 of the
    quantile (tested).  It needs one clean page at least: where the posterior
    holds less, it counts as one, which only lowers the bound.
    """
    a = F.greatest(mean * weight, F.lit(1e-9))
    b = F.greatest((1 - mean) * weight, F.lit(1.0))
    c, d = 1 / (9 * a), 1 / (9 * b)
    root = ((1 - c) * (1 - d) - z * F.sqrt(c * (1 - d) * (1 - d) + d * (1 - c) * (1 - c) - z * z * c * d)) / ((1 - d) * (1 - d) - z * z * d)
    ratio = F.pow(F.greatest(root, F.lit(0.0)), 3.0)
    return a * ratio / (b + a * ratio)


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], *, suffixes: Sequence[str] = SUFFIXES,
                z: float = 1.645, most_bad: float = 0.5) -> DataFrame:
    """``pages`` with host, path, rule, verdict (allow or block), bad_rate and bad_rate_low.

    A rule that fits decides; else the host's reputation does.  Null urls and
    urls without ``://`` have an empty host, a host like any other; urls are read
    whole, however long.  Rows, repeated ones too, and other columns stay;
    columns of the new names are replaced.  No pages give an empty table; without
    outcomes all that no rule blocks is allowed.
    """
    new = ("host", "path", "rule", "verdict", "bad_rate", "bad_rate_low")
    base = pages.select(*[c for c in pages.columns if c not in new], url_host(F.col("url")).alias("host"),
                        url_path(F.col("url")).alias("path"))
    known = saved(host_reputation(base, outcomes, suffixes), "host-reputation")  # so that AQE can split a hot host
    judged = base.join(known, "host").withColumn("__rule", rule_for(F.col("host"), F.col("path"), rules))
    low = lower_bound(F.col("mean"), F.col("weight"), z)
    own = F.when(low > most_bad, "block").otherwise("allow")
    return judged.select(*base.columns, F.col("__rule.rule").alias("rule"),
                         F.coalesce(F.col("__rule.verdict"), own).alias("verdict"),
                         F.col("mean").alias("bad_rate"), low.alias("bad_rate_low"))
