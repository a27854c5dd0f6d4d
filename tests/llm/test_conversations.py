"""Conversation repair against a search over all edits, and the whole query against plain Python."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from ticksmith.llm import conversations
from ticksmith.llm.queries import QUERIES

from .test_operators import SF

SOLID = re.compile(r"[^\x20\x09-\x0D]")
STATE = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def plain_damage(rows):
    out = []
    for c, t, role, text in rows:
        lot = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if lot:
            text = "" if lot == 1 else re.sub("[.!?]", "", text) if lot == 2 else text
            out += [(c, t, "user" if lot == 4 else role, text)] * (2 if lot == 3 else 1)
    return out


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of (turn, role, text) rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        solid = SOLID.findall(text)
        faults.append("b" if not solid else "d" if (role, text) in seen else "t" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, *_ in rows if t is not None}
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:], strict=False))
    # cheapest first, then the least audit: the first finished search node is the answer
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(rows) and q in ("", "a"):
            break
        if (i, q) in done:
            continue
        done.add((i, q))
        new = "assistant" if q == "u" else "user"
        heapq.heappush(heap, (cost + 3, audit + "I", i, new[0], (*out, new + ":")))
        if i < len(rows):
            _, role, text = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, q, out))
            if faults[i] not in ("b", "d"):
                extra = 3 * (faults[i] == "t")
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", i + 1, new[0], (*out, f"{new}:{text}")))
                if (q, role[:1]) in STATE:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, STATE[q, role[:1]], (*out, f"{role}:{text}")))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in "bdt"), illegal, cost, audit,
            hashlib.sha256("\n".join(out).encode()).hexdigest())


def expected(rows):
    """Of (conv_id, turn, role, text) rows; equal turns must hold equal rows."""
    after, out = plain_damage(rows), []
    for c in {r[0] for r in rows}:
        own = sorted((r[1:] for r in after if r[0] == c), key=lambda r: (r[0] is not None, r[0] or 0))
        out.append((c, *plain_repair(own)))
    return sorted(out, key=repr)


def random_rows(seed, n=60):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "cut off", "Well?  \n", " ", "", "same.", "\x0b\x1f.", "ends  ", None]
    roles = ["user", "assistant", "system", "tool", "", None, "User", "ai"]
    return [(c if c else None, t if t or rng.random() < 0.5 else None, rng.choice(roles[:2] * 4 + roles), rng.choice(texts[:4] * 3 + texts))
            for c in range(n) for t in sorted(rng.sample(range(30), rng.randrange(10)))]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed,block", [(1, 1), (2, 3), (3, conversations.BLOCK)])
def test_equals_search_over_edits(spark, seed, block):
    rows = random_rows(seed)
    got = conversations.repair(conversations.damage(spark.createDataFrame(rows, SCHEMA).repartition(3)), block).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_registered_query(spark):
    got = QUERIES["op12_structure_repair"](spark, SF)
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got.columns == ["conv_id", *conversations.NAMES[1:]]
    assert sorted(map(tuple, got.collect()), key=repr) == expected(rows)


def test_repeated_rows_long_text_and_long_conversation(spark):
    rows = [(1, 0, "user", "x" * 300_000 + "."), (1, 1, "assistant", "ok.")] * 2
    rows += [(2, t, "user" if t % 2 else "assistant", f"Text {t}.") for t in range(3000)]
    rows += [(3, None, "user", "a."), (3, None, "user", "a.")]
    got = conversations.repair(conversations.damage(spark.createDataFrame(rows, SCHEMA)), 100).collect()
    assert sorted(map(tuple, got), key=repr) == expected(rows)


def test_all_rows_dropped_and_empty_table(spark):
    c = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    got = conversations.repair(conversations.damage(spark.createDataFrame([(c, 0, "user", "a.")], SCHEMA))).collect()
    assert [tuple(r) for r in got] == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    empty = spark.createDataFrame([], SCHEMA + ", gone string, mark string, lot int")
    assert conversations.repair(conversations.damage(empty)).collect() == []
