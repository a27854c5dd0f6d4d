"""Decontamination against plain Python: items that share windows, repeated items and rows, short items, hot windows."""

from __future__ import annotations

import hashlib
import random
import re

from pyspark.sql import functions as F

from ticksmith.llm import decontaminate

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return ALNUM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, size=10):
    grams = {}
    for name, text in items:
        w = split(text)
        n = min(size, len(w))
        for p in range(len(w) - n + 1 if n and name is not None else 0):
            grams.setdefault(tuple(w[p:p + n]), set()).add(str(name))
    lengths, out = {len(g) for g in grams}, []
    for d, text in docs:
        w, gone, ids = split(text), set(), set()
        for n in lengths:
            for p in range(len(w) - n + 1):
                found = grams.get(tuple(w[p:p + n]))
                if found:
                    gone |= set(range(p, p + n))
                    ids |= found
        out.append((d, len(w), len(gone), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(gone)))
    return sorted(out, key=repr)


def made(seed=3):
    r = random.Random(seed)
    word = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(40)]
    text = [[r.choice(word) for _ in range(r.randrange(0, 60))] for _ in range(60)]
    head = [r.choice(word) for _ in range(12)]
    items = [(i, " ".join((head if i % 3 == 0 else []) + t)) for i, t in enumerate(text[:25])]
    items += [(100, "w1 w2"), (101, "w1 w2"), (102, None), (None, " ".join(text[40])), (103, "..."), (3, items[3][1]), (3, "w3 w4 w5")]
    docs = [(i, r.choice([" ", ", ", "\n"]).join(t + (head if i % 2 else []) + text[i % 25])) for i, t in enumerate(text)]
    docs += [(70, None), (71, ""), (72, "W1-W2"), (73, " ".join(r.choice(word) for _ in range(30_000))), (None, docs[1][1])] + docs[:20] * 3
    return docs, items


def got(spark, docs, items, **more):
    found = decontaminate.decontaminate(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                                        spark.createDataFrame(items, "item_id long, text string"), **more)
    return sorted((tuple(r) for r in found.select("row.doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def test_equals_plain_python(spark):
    docs, items = made()
    assert got(spark, docs, items) == plain(docs, items)
    assert got(spark, docs, items, size=4) == plain(docs, items, 4)


def test_shuffled_hits_and_small_flushes(spark, monkeypatch):
    docs, items = made(5)
    monkeypatch.setattr(decontaminate, "BROADCAST_TEXTS", 0)
    monkeypatch.setattr(decontaminate, "FLUSH_BYTES", 2000)
    assert got(spark, docs, items, bits=1 << 17) == plain(docs, items)


def test_only_a_bitmap_of_the_benchmark_comes_to_the_driver(spark):
    _, items = made()
    windows = decontaminate.benchmark_windows(spark.createDataFrame(items, "item_id long, text string"))
    for bits in (8, 1 << 16, 1 << 20):
        bitmap = decontaminate.fingerprint_bits(windows, bits)
        slots = {r[0] for r in windows.select(F.col("mark").bitwiseAND(F.lit(bits - 1))).collect()}
        assert len(bitmap) * 8 == bits
        assert {8 * i + j for i, x in enumerate(bitmap) for j in range(8) if x >> (7 - j) & 1} == slots
    assert windows.groupBy("n", "words").count().where("count > 1").count() == 0


def test_empty_tables(spark):
    docs, items = made()
    assert got(spark, [], items) == []
    assert got(spark, docs[:5], []) == plain(docs[:5], [])
