"""Ranked lexical search against scoring every document."""

from __future__ import annotations

import collections
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ticksmith.llm import bit_sliced

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=20):
    bags = [(d, collections.Counter(terms(t)), len(terms(t))) for d, t in docs]
    n_docs, n_terms = sum(n > 0 for *_, n in bags), sum(n for *_, n in bags)
    df = collections.Counter(t for _, bag, _ in bags for t in bag)
    asked = collections.defaultdict(collections.Counter)
    for i, t in set(items):
        asked[i].update(terms(t))
    out = []
    for i, query in asked.items():
        scores = []
        for d, bag, n in bags:
            m = 75 + (25 * n * n_docs) // n_terms if n_terms else 0
            s = sum(times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * bag[t]) // (1000 * bag[t] + 12 * m))
                    for t, times in query.items() if bag[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, rank, d, -s) for rank, (s, _, _, d) in enumerate(sorted(scores)[:top], 1)]
    return sorted(out, key=repr)


def corpus(seed, n=400):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(300)]
    draw = [min(int(rng.expovariate(0.02)), 299) for _ in range(20_000)]
    rows = [(i, " ".join(vocab[rng.choice(draw)] for _ in range(rng.choice((0, 1, 5, 40, 200))))) for i in range(n)]
    rows += [(None, "w1 w2 W3"), (7, "w1 w2 w3"), (7, "w1 w2 w3"), (9000, None), (9001, " .!"), (9002, "é w1É É9 " * 3),
             (9003, " ".join(rng.choice(vocab) for _ in range(40_000)))]
    items = [(i, " ".join(vocab[rng.choice(draw)] for _ in range(rng.choice((1, 3, 30))))) for i in range(25)]
    items += [(100, "w1 w1 w1 unseen"), (100, "w1 w1 w1 unseen"), (101, "w1"), (101, "w250"), (None, "É9 w2"), (102, None), (103, "?!"), (104, "unseen")]
    return rows, items


@pytest.mark.parametrize("seed,held", [(1, bit_sliced.QUERY_TERMS), (2, 40)])
def test_equals_scoring_every_document(spark, seed, held, monkeypatch):
    rows, items = corpus(seed)
    got = bit_sliced.search(spark.createDataFrame(rows, "doc_id long, text string").repartition(3),
                            spark.createDataFrame(items, "item_id long, text string"), query_terms_held=held).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows, items)


def test_slices_never_miss_a_term_and_leave_documents_unscored():
    rng = np.random.default_rng(3)
    vocab = rng.integers(0, 2 ** 63, 2000, dtype=np.uint64)
    docs = []
    for _ in range(500):
        u, c = np.unique(rng.choice(vocab, 60), return_counts=True)
        docs.append((u, c * rng.integers(1, 12)))
    slices = bit_sliced.Slices(docs)
    for level, least in enumerate(bit_sliced.LEVELS):
        there = slices.may_hold(vocab[:200], level)
        for i, (u, c) in enumerate(docs):
            assert there[np.isin(vocab[:200], u[c >= least]), i].all()
        assert there.mean() < 0.2
    best = bit_sliced.Best(1, 20)
    places = np.arange(12)
    scored = bit_sliced.rank_block(docs, list(range(500)), np.full(500, 60), best, [(places, np.ones(12, np.int64))],
                                   vocab, np.full(2000, 5000), 500, 30_000)
    assert len(best.rows[0]) == 20 and scored < 250


def test_empty_tables_and_clashing_columns(spark):
    docs, items = "doc_id long, text string, score string, rank int", "item_id long, text string, term string, times int"
    some, none = [(1, "a b", "x", 3)], []
    for d, i in ((some, none), (none, some), (none, none)):
        assert bit_sliced.search(spark.createDataFrame(d, docs), spark.createDataFrame(i, items)).collect() == []
    got = bit_sliced.search(spark.createDataFrame(some, docs), spark.createDataFrame([(5, "b", "t", 1)], items)).collect()
    assert [tuple(r) for r in got] == brute([(1, "a b")], [(5, "b")])


def test_string_ids(spark):
    docs = spark.createDataFrame([("d1", "a b"), ("d2", "a a")], "doc_id string, text string")
    got = bit_sliced.search(docs, docs.select(F.col("doc_id").alias("item_id"), "text")).collect()
    assert {r["item_id"] for r in got} <= {"d1", "d2"}
