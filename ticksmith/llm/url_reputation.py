"""Empirical-Bayes host reputation for URL filtering (dealt operator 1).

Labelled page outcomes are counted by host, registered domain and suffix.  A
beta-binomial prior at each level is shrunk towards the level above: the
suffix towards the overall rate, the domain towards its suffix, the host
towards its domain.  How strongly is estimated from the counts (method of
moments).  A page is blocked when the lower posterior bound of its host's bad
rate exceeds a limit; explicit rules go first.

Everything is DataFrame expressions.  Counts combine map-side, so a host with
a third of all pages sends one row a task; the page join is against one row a
host, broadcast up to a checked number of hosts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ticksmith.plans.storage import materialize

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LIMIT = 0.3          # bad rate that the lower bound has to exceed
BROADCAST_HOSTS = 200_000   # some 20 MB; more hosts are joined by a shuffle that Spark splits where it is skewed
Z = 1.645            # one-sided 95 % of the normal approximation
# Suffixes of two labels under which names are registered.
DOUBLE_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "co.kr",
                   "co.in", "co.za", "co.ke", "com.br", "com.mx", "com.ar", "com.cn", "com.tr")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(_after(url), "^[^/?#]*", 0), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(_after(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _after(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + F.lit(3), F.length(url)))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*DOUBLE_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*DOUBLE_SUFFIXES),
                  F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; rules are (verdict, host, path)."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):   # the longest is tried first
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def _strength(groups: DataFrame, mean: Column) -> float:
    """Prior strength of a level, by moments: mean (1 - mean) / variance between groups - 1, from 1 to 1000."""
    rate = F.col("bad") / F.col("n")
    got = groups.agg(
        F.sum("n").alias("n"), F.count("*").alias("g"), F.sum(F.col("n") * (rate - mean) * (rate - mean)).alias("ss"),
        F.sum(mean * (1 - mean) * F.col("n")).alias("m"), F.sum(mean * (1 - mean)).alias("w")).first()
    if not got["n"]:
        return 1.0
    between = got["ss"] / got["n"] - got["w"] / got["n"]
    return min(1000.0, max(1.0, got["m"] / got["n"] / between - 1)) if between > 0 else 1000.0


def host_posteriors(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, alpha, beta) of the bad rate of every host of ``hosts`` (distinct host).

    ``outcomes`` (url, bad 0 or 1) are labelled pages; other labels and null
    urls are ignored.  Without outcomes every host has the uniform prior.
    """
    known = (outcomes.where("bad IN (0, 1) AND url IS NOT NULL").select(host_of(F.col("url")).alias("host"), "bad")
             .groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
             .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})).cache()
    total = known.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2)
    suffixes = known.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    k = _strength(suffixes, F.lit(overall))
    suffixes = suffixes.select("suffix", ((F.col("bad") + k * overall) / (F.col("n") + k)).alias("suffix_rate"))
    domains = (known.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
               .join(suffixes, "suffix"))
    k = _strength(domains, F.col("suffix_rate"))
    domains = domains.select("domain", ((F.col("bad") + k * F.col("suffix_rate")) / (F.col("n") + k)).alias("domain_rate"))
    k = _strength(known.join(domains, "domain"), F.col("domain_rate"))
    rate = F.coalesce("domain_rate", "suffix_rate", F.lit(overall))
    n, bad = F.coalesce("n", F.lit(0)), F.coalesce("bad", F.lit(0))
    return (hosts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"))
            .join(known.select("host", "n", "bad"), "host", "left").join(domains, "domain", "left")
            .join(suffixes, "suffix", "left")
            .select("host", (bad + k * rate).alias("alpha"), (n - bad + k * (1 - rate)).alias("beta")))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = (),
          limit: float = LIMIT, z: float = Z) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_rate, lower_bound) per row of ``pages`` (page_id, url).

    A null url, or one without ``://``, has an empty host and path and is
    judged by the empty host's posterior.  Repeated rows are all returned;
    other columns are ignored.
    """
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    a, b = F.col("alpha"), F.col("beta")
    mean = a / (a + b)
    bound = mean - z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    posterior = materialize(host_posteriors(rows.select("host").distinct(), outcomes).select(
        "host", mean.alias("bad_rate"), bound.alias("lower_bound")), "host-posteriors")
    if posterior.count() <= BROADCAST_HOSTS:
        posterior = F.broadcast(posterior)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.join(posterior, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("lower_bound") > limit, "block").otherwise("allow")).alias("verdict"),
        "bad_rate", "lower_bound")
