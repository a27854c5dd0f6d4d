"""Operator 6: hot passages over many tasks, against plain Python; what a bucket is sent."""

import collections
import hashlib
import random

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from ticksmith.llm import substring_dedup


def hot_rows(n=240):
    """A passage in a third of all rows, near copies, periodic texts, exact copies and rows of their own."""
    rng = random.Random(7)
    vocabulary = [f"w{i}" for i in range(400)]
    hot = [rng.choice(vocabulary) for _ in range(90)]
    near = [rng.choice(vocabulary) for _ in range(160)]
    rows = []
    for i in range(n):
        own = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        if i % 3 == 0:
            words = own + hot + own[:5]
        elif i % 7 == 0:
            words = list(near)
            words[rng.randrange(len(words))] = f"x{i}"
        elif i % 11 == 0:
            words = ["a", "b", "c"] * rng.randint(10, 30)
        elif i % 13 == 0:
            words = hot[20:60]
        else:
            words = own
        rows.append((i if i % 17 else None, " ".join(words)))
    return rows + rows[:9] + [(1000, None), (1001, ""), (1002, " \n ")]


def brute(rows, size):
    texts = [(t or "").split() for _, t in rows]
    count = collections.Counter(tuple(w[i:i + size]) for w in texts for i in range(len(w) - size + 1))
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        gone = {j for i in range(len(w) - size + 1) if count[tuple(w[i:i + size])] > 1 for j in range(i, i + size)}
        out.append((-1 if d is None else d, len(w), len(gone),
                    hashlib.sha256(" ".join(x for j, x in enumerate(w) if j not in gone).encode()).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize(("tasks", "buckets", "flush"), [(1, 1, 16 << 20), (9, 1, 16 << 20), (9, 5, 2000), (40, 64, 1)])
def test_hot_passages_equal_brute_force(spark, monkeypatch, tasks, buckets, flush):
    monkeypatch.setattr(substring_dedup, "FLUSH_BYTES", flush)
    monkeypatch.setattr(substring_dedup, "FLUSH_PLACES", 7)
    rows = hot_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(tasks)
    got = substring_dedup.dedup_substrings(docs, buckets=buckets).select(
        F.coalesce("row.doc_id", F.lit(-1)), "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, got)) == brute(rows, 35)


def test_a_string_that_a_task_has_twice_travels_without_places(spark):
    rows = [(i, "lead%d " % i + " ".join(f"w{j}" for j in range(60))) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(2).withColumn("row_key", F.xxhash64("doc_id", "text"))
    packed = substring_dedup.pack(docs.select("doc_id", "row_key", "text"), np.zeros(0, np.uint64), 35, 4).collect()
    open_ = zstandard.ZstdDecompressor()

    def n_places(r):
        return len(open_.decompress(r["places"])) // 16

    with_strings = [r for r in packed if r["strings"] is not None]
    strings = sum(len(open_.decompress(r["strings"]).split(b"\n")) for r in with_strings)
    # each row's own lead is a string at one place, the passage's strings are at 250 a task
    assert sum(map(n_places, with_strings)) <= 500 < strings <= 520
    assert sum(n_places(r) for r in packed if r["strings"] is None) >= 500
