"""Chosen-path join against brute force over all pairs."""

from __future__ import annotations

import random
from fractions import Fraction

import numpy as np
import pytest

from ticksmith.llm import chosen_path
from ticksmith.llm.queries import QUERIES

from .test_operators import SF, brute_components, near_group, odd_docs


def with_kept(rows):
    return sorted(((d, n, c, d is not None and d == c) for d, n, c in rows), key=repr)


@pytest.mark.parametrize("k,num,den,node", [(5, 85, 100, 256), (5, 8, 10, 4), (3, 9, 10, 8)])
def test_equals_brute_force(spark, k, num, den, node):
    docs = near_group(spark).unionByName(odd_docs(spark).select("doc_id", "text"))
    got = chosen_path.near_duplicates(docs, k, Fraction(num, den), node_size=node).collect()
    assert sorted(map(tuple, got), key=repr) == with_kept(brute_components([tuple(r) for r in docs.collect()], k, num, den))


def test_registered_query_equals_brute_force(spark):
    got = QUERIES["op11_chosen_path"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, got), key=repr) == with_kept(brute_components([tuple(r) for r in docs], 5, 85, 100))


def test_minwise_tokens_estimate_similarity():
    rng = np.random.default_rng(1)
    both, a, b = (rng.integers(0, 2 ** 63, n, dtype=np.uint64) for n in (1700, 150, 150))
    same = (chosen_path.minwise(np.r_[both, a]) == chosen_path.minwise(np.r_[both, b])).mean()
    assert abs(same - 0.85) < chosen_path.margin(0.85)


def test_pairs_at_the_threshold_survive_the_trees():
    """Share of trees' first five levels that a pair at the threshold passes, over many pairs."""
    rng, t, alive = random.Random(2), 0.85, 0
    for pair in range(300):
        x = np.array([[rng.randrange(60_000) for _ in range(128)]], np.uint32)
        y = np.where(np.array([[rng.random() < t for _ in range(128)]]), x, x + np.uint32(1)).astype(np.uint32)
        met = False
        for tree in range(chosen_path.TREES):
            nodes = {int(chosen_path.mix64(np.array([tree + 1 + 100 * pair], np.uint64))[0])}
            for _ in range(5):
                nodes = {c for n in nodes
                         for c in {int(v[0]) for s, v in chosen_path.children(np.array([n], np.uint64), x, t) if len(s)}
                         & {int(v[0]) for s, v in chosen_path.children(np.array([n], np.uint64), y, t) if len(s)}}
            met |= bool(nodes)
        alive += met
    assert alive >= 297


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, n int, digest string, key string, sig string")
    assert chosen_path.near_duplicates(docs).collect() == []
    docs = spark.createDataFrame([(1, "a b c d e f", 3, "x", "y", "z"), (1, "a b c d e f", 3, "x", "y", "z")], docs.schema)
    assert [tuple(r) for r in chosen_path.near_duplicates(docs).collect()] == [(1, 2, 1, True)] * 2
