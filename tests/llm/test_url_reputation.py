"""Host posteriors against the same shrinkage in plain Python, and rows that are out of the ordinary."""

from __future__ import annotations

import collections
import random

from ticksmith.llm import url_reputation
from ticksmith.llm.url_reputation import DOUBLE_SUFFIXES, LIMIT, Z, judge


def parts(host):
    labels = host.split(".")
    two = ".".join(labels[-2:])
    if two in DOUBLE_SUFFIXES:
        return ".".join(labels[-3:]), two
    return two, labels[-1]


def rates(groups, means, strength):
    return {g: (bad + strength * means[g]) / (n + strength) for g, (n, bad) in groups.items()}


def strength(groups, means):
    total = sum(n for n, _ in groups.values())
    if not total:
        return 1.0
    between = sum(n * (bad / n - means[g]) ** 2 for g, (n, bad) in groups.items()) / total \
        - sum(means[g] * (1 - means[g]) for g in groups) / total
    spread = sum(means[g] * (1 - means[g]) * n for g, (n, _) in groups.items()) / total
    return min(1000.0, max(1.0, spread / between - 1)) if between > 0 else 1000.0


def plain_posteriors(hosts, outcomes):
    """{host: (alpha, beta)} from (host, bad) outcomes: suffix, domain and host shrunk one after another."""
    def grouped(name):
        out = collections.defaultdict(lambda: (0, 0))
        for host, bad in outcomes:
            n, b = out[name(host)]
            out[name(host)] = (n + 1, b + bad)
        return dict(out)

    overall = (sum(b for _, b in outcomes) + 1) / (len(outcomes) + 2)
    suffixes, domains, known = grouped(lambda h: parts(h)[1]), grouped(lambda h: parts(h)[0]), grouped(lambda h: h)
    to_suffix = {parts(h)[0]: parts(h)[1] for h in known}
    means = dict.fromkeys(suffixes, overall)
    suffix_rate = rates(suffixes, means, strength(suffixes, means))
    means = {d: suffix_rate[to_suffix[d]] for d in domains}
    domain_rate = rates(domains, means, strength(domains, means))
    means = {h: domain_rate[parts(h)[0]] for h in known}
    k, out = strength(known, means), {}
    for h in hosts:
        n, bad = known.get(h, (0, 0))
        rate = domain_rate.get(parts(h)[0], suffix_rate.get(parts(h)[1], overall))
        out[h] = (bad + k * rate, n - bad + k * (1 - rate))
    return out


def test_posteriors_and_verdicts_equal_plain_python(spark):
    rng = random.Random(8)
    hosts = [f"{a}.{b}.{c}" for c in ("com", "co.uk", "org") for b in ("good", "bad", "mixed") for a in ("www", "m", "x1", "x2")]
    chance = {"good": 0.02, "bad": 0.9, "mixed": 0.4}
    outcomes = [(h, int(rng.random() < chance[h.split(".")[1]])) for h in hosts[:-6] for _ in range(rng.randrange(1, 60))]
    asked = [*hosts, "new.bad.com", "never.seen.net", "localhost", ""]
    pages = spark.createDataFrame([(i, f"https://{h.upper()}/p" if h else None) for i, h in enumerate(asked)], "page_id long, url string")
    labels = spark.createDataFrame([(f"http://{h}/a", b) for h, b in outcomes] + [(None, 1), ("http://x/", 7)], "url string, bad int")
    got = {r["host"]: r for r in judge(pages, labels).collect()}
    for host, (a, b) in plain_posteriors(asked, outcomes).items():
        mean = a / (a + b)
        bound = mean - Z * (a * b / ((a + b) ** 2 * (a + b + 1))) ** 0.5
        assert abs(got[host]["bad_rate"] - mean) < 1e-9 and abs(got[host]["lower_bound"] - bound) < 1e-9
        assert got[host]["verdict"] == ("block" if bound > LIMIT else "allow")
    verdicts = {r["verdict"] for r in got.values()}
    assert verdicts == {"block", "allow"} and got["www.bad.com"]["verdict"] == "block" and got["www.good.com"]["verdict"] == "allow"


def test_empty_tables_repeated_rows_and_long_urls(spark):
    pages, labels = "page_id long, url string, host string, rule string, alpha double", "url string, bad int, host string"
    none = spark.createDataFrame([], labels)
    assert judge(spark.createDataFrame([], pages), none).collect() == []
    long = "http://a.example/" + "x" * 300_000
    rows = [(1, long, "h", "r", 1.0), (1, long, "h", "r", 1.0), (2, "no scheme", None, None, None), (3, "", None, None, None), (4, "ftp://", None, None, None)]
    got = judge(spark.createDataFrame(rows, pages), none, [("block", "example", "/x")]).collect()
    assert sorted((r["page_id"], r["host"], len(r["path"]), r["rule"], r["verdict"]) for r in got if r["rule"]) \
        == [(1, "a.example", 300_001, "example/x", "block")] * 2
    # without outcomes a host has a wide posterior around one half, whose bound blocks nothing
    assert sorted((r["page_id"], r["host"], r["path"], r["verdict"]) for r in got if not r["rule"]) == [(i, "", "", "allow") for i in (2, 3, 4)]


def test_broadcast_and_shuffled_hosts_agree(spark, monkeypatch):
    pages = spark.createDataFrame([(i, f"http://h{i % 9}.com/") for i in range(40)], "page_id long, url string")
    labels = spark.createDataFrame([(f"http://h{i % 5}.com/", i % 2) for i in range(30)], "url string, bad int")
    one = sorted(map(tuple, judge(pages, labels).collect()))
    monkeypatch.setattr(url_reputation, "BROADCAST_HOSTS", 0)
    assert sorted(map(tuple, judge(pages, labels).collect())) == one
