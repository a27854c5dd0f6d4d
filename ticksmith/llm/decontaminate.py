"""Benchmark decontamination by winnowing (dealt operator 4).

A window is ``size`` consecutive words of a benchmark item; an item of fewer
words is one window.  For each window length n the fingerprint of a window is
the smallest hash among its k-word grams (k at most 5), so the fingerprints of
a text are its winnowed k-grams, and two texts that share n words share the
fingerprint of that span.  Documents keep the windows whose fingerprint a
benchmark window has, and each such hit is extended to the whole window and
compared word by word.

The benchmark's windows are a table with one row for each different window, made in
Spark tasks, however large the benchmark or however often an item repeats.  Its
fingerprints set bits of a bitmap of at most MOST_BITS, which is all that is
broadcast; document windows whose fingerprint has its bit set are candidates.
Candidates are joined with the window table on fingerprint and words, so the
bitmap decides nothing but how many travel.  A task sends a window once,
with the places where it stands, whatever part of the rows holds it.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.llm.arrays import (alnum_table, blocks, gram_hashes, lower_ascii, mix64, sliding_min,
                                  text_bytes, word_hashes, words)
from ticksmith.plans.storage import materialize

WINDOW = 10
GRAM = 5
BITS_A_WINDOW = 1024       # bits of the bitmap for each window of the benchmark, up to MOST_BITS
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 29
CHUNK_BITS = 1 << 15
FLUSH_BYTES = 8 << 20
BROADCAST_TEXTS = 200_000  # more texts with hits are joined by a shuffle


def _marks(h: np.ndarray, n: int) -> np.ndarray:
    """Fingerprint of the window of n words from each position on; n is part of it."""
    k = min(GRAM, n)
    return mix64(sliding_min(gram_hashes(h, k), n - k + 1) ^ np.uint64(n))


def _blocks(column):
    """(first row, text bytes, word starts, ends, word ranges of rows) of each block, lower-cased."""
    raw, off = text_bytes(column)
    table = alnum_table()
    for a, b in blocks(off):
        part = lower_ascii(raw[off[a]:off[b]])
        yield a, part, *words(part, off[a:b + 1] - off[a], table)


WINDOWS = "n int, mark bigint, words binary, name string"


def benchmark_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(n, mark, words, names) of each different window of the items; names are the ids of those that hold it."""
    items = benchmark.select(F.col("item_id").cast("string").alias("name"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            names = batch.column("name").to_pylist()
            for a, part, start, end, first in _blocks(batch.column("text")):
                h, data = word_hashes(part, start, end), part.tobytes()
                out: dict[str, list] = {"n": [], "mark": [], "words": [], "name": []}
                for i in range(len(first) - 1):
                    f, g = int(first[i]), int(first[i + 1])
                    n = min(size, g - f)
                    if n == 0:
                        continue
                    text = [data[x:y] for x, y in zip(start[f:g].tolist(), end[f:g].tolist(), strict=True)]
                    mark = _marks(h[f:g], n).view(np.int64).tolist()
                    out["n"] += [n] * len(mark)
                    out["mark"] += mark
                    out["words"] += [b" ".join(text[p:p + n]) for p in range(len(mark))]
                    out["name"] += [names[a + i]] * len(mark)
                if out["n"]:
                    yield pa.record_batch({"n": pa.array(out["n"], pa.int32()), "mark": pa.array(out["mark"], pa.int64()),
                                           "words": pa.array(out["words"], pa.binary()), "name": pa.array(out["name"], pa.string())})

    return (items.where("name IS NOT NULL AND text IS NOT NULL").distinct().mapInArrow(run, WINDOWS)
            .groupBy("n", "mark", "words").agg(F.collect_set("name").alias("names")))


def fingerprint_bits(windows: DataFrame, bits: int) -> bytes:
    """Bitmap of ``bits`` bits (a power of two) with the bit of every window's fingerprint set."""
    chunk = min(bits, CHUNK_BITS)
    place = F.col("mark").bitwiseAND(F.lit(bits - 1))

    def run(batches):
        for batch in batches:
            rows = []
            for at in batch.column("at").to_pylist():
                on = np.zeros(chunk, bool)
                on[at] = True
                rows.append(np.packbits(on).tobytes())
            yield pa.record_batch({"chunk": batch.column("chunk"), "bits": pa.array(rows, pa.binary())})

    got = (windows.select((place / F.lit(chunk)).cast("bigint").alias("chunk"), (place % F.lit(chunk)).cast("int").alias("at"))
           .groupBy("chunk").agg(F.collect_set("at").alias("at")).mapInArrow(run, "chunk bigint, bits binary").toArrow())
    out = bytearray(bits // 8)
    for c, b in zip(got["chunk"].to_pylist(), got["bits"].to_pylist(), strict=True):
        out[c * chunk // 8:(c + 1) * chunk // 8] = b
    return bytes(out)


FOUND = "n int, mark bigint, words binary, places array<struct<a: bigint, b: bigint, at: int>>"
PLACES = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64()), ("at", pa.int32())]))


def candidates(texts: DataFrame, sizes: list[int], bitmap: bytes) -> DataFrame:
    """Windows of ``texts`` (a, b, text) whose fingerprint is in the bitmap, each once a task with its places."""
    held = texts.sparkSession.sparkContext.broadcast(bitmap)

    def run(batches):
        bit = np.frombuffer(held.value, np.uint8)
        mask = np.uint64(len(bit) * 8 - 1)
        found: dict[tuple[int, int, bytes], set] = {}
        load = 0

        def emit():
            keys = list(found)
            for i in range(0, len(keys), 10_000):
                part = keys[i:i + 10_000]
                each = [sorted(found[k]) for k in part]
                flat = [p for e in each for p in e]
                struct = pa.StructArray.from_arrays([pa.array([p[j] for p in flat], t.type) for j, t in enumerate(PLACES.value_type)],
                                                    fields=list(PLACES.value_type))
                ends = np.cumsum([0, *map(len, each)], dtype=np.int32)
                yield pa.record_batch({
                    "n": pa.array([k[0] for k in part], pa.int32()), "mark": pa.array([k[1] for k in part], pa.int64()),
                    "words": pa.array([k[2] for k in part], pa.binary()),
                    "places": pa.ListArray.from_arrays(pa.array(ends), struct)})

        for batch in batches:
            a_of, b_of = batch.column("a").to_pylist(), batch.column("b").to_pylist()
            for row0, part, start, end, first in _blocks(batch.column("text")):
                h, data = word_hashes(part, start, end), part.tobytes()
                for n in sizes:
                    if len(h) < n:
                        continue
                    mark = _marks(h, n)
                    # neighbouring windows mostly keep the same gram: look each up once
                    fresh = np.flatnonzero(np.r_[True, mark[1:] != mark[:-1]])
                    slot = mark[fresh] & mask
                    on = (bit[(slot >> np.uint64(3)).astype(np.int64)] >> (np.uint64(7) - (slot & np.uint64(7))).astype(np.uint8)) & 1
                    place = np.flatnonzero(np.repeat(on > 0, np.diff(np.r_[fresh, len(mark)])))
                    row = np.searchsorted(first, place, "right") - 1
                    ok = place + n <= first[row + 1]
                    place, row = place[ok], row[ok]
                    for p, r, m, q in zip(place.tolist(), row.tolist(), mark[place].view(np.int64).tolist(),
                                          (place - first[row]).tolist(), strict=True):
                        key = (n, m, b" ".join([data[s:e] for s, e in zip(start[p:p + n].tolist(), end[p:p + n].tolist(), strict=True)]))
                        at = found.get(key)
                        if at is None:
                            at = found[key] = set()
                            load += len(key[2]) + 300
                        at.add((a_of[row0 + r], b_of[row0 + r], q))
                        load += 250
                if load > FLUSH_BYTES:
                    yield from emit()
                    found.clear()
                    load = 0
        yield from emit()

    return texts.mapInArrow(run, FOUND)


def _covered(spans) -> int:
    total = reach = 0
    for s, e in sorted(zip(spans[::2], spans[1::2], strict=True)):
        total += max(0, e - max(s, reach))
        reach = max(reach, e)
    return total


HITS = "a bigint, b bigint, n_hit bigint, n_items bigint, items_sha256 string"


def hits(texts: DataFrame, windows: DataFrame, bits: int | None = None) -> DataFrame:
    """(a, b, n_hit, n_items, items_sha256) of the texts that hold a window."""
    windows = materialize(windows, "benchmark-windows")
    sizes = sorted(r["n"] for r in windows.select("n").distinct().collect())     # at most ``size`` numbers
    if bits is None:
        bits = min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_A_WINDOW * windows.count()).bit_length()))
    found = candidates(texts, sizes, fingerprint_bits(windows, bits)).join(windows, ["n", "mark", "words"])
    spans = (found.select("n", "names", F.explode("places").alias("p")).groupBy("p.a", "p.b")
             .agg(F.collect_set(F.struct(F.col("p.at").alias("at"), "n")).alias("spans"),
                  F.array_distinct(F.flatten(F.collect_set("names"))).alias("names")))

    def run(batches):
        for batch in batches:
            hit = [_covered([x for s in spans for x in (s["at"], s["at"] + s["n"])]) for spans in batch.column("spans").to_pylist()]
            ids = [sorted(i) for i in batch.column("names").to_pylist()]
            yield pa.record_batch({
                "a": batch.column("a"), "b": batch.column("b"), "n_hit": pa.array(hit, pa.int64()),
                "n_items": pa.array([len(i) for i in ids], pa.int64()),
                "items_sha256": pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in ids], pa.string())})

    return materialize(spans.mapInArrow(run, HITS), "benchmark-hits")


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, bits: int | None = None) -> DataFrame:
    """(row, n_words, n_hit, n_items, items_sha256, contaminated) per row of ``docs``.

    ``row`` is the whole input row as a struct, so extra columns of any name
    are kept apart; docs need a ``text``, the benchmark ``item_id`` and
    ``text``.  Null and empty texts have no words and no hits; an item without
    words or without id has no window; items that repeat count once an id.
    Repeated documents are all returned; an empty benchmark hits nothing.  A very
    long text is read whole, by one task.  Texts are named by two 64-bit
    hashes; ``bits`` sets the size of the bitmap (a power of two, 8 at least), which
    changes no result.

    Texts are read twice, once for their windows and once with their rows.  Texts with
    hits are broadcast up to BROADCAST_TEXTS, else joined by a shuffle.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text")).withColumns(
        {"a": F.xxhash64("text"), "b": F.xxhash64(F.lit(1), "text")})
    held = hits(rows.select("a", "b", "text"), benchmark_windows(benchmark, size), bits)
    if held.count() <= BROADCAST_TEXTS:
        held = F.broadcast(held)
    both = rows.join(held, ["a", "b"], "left").select("row", "n_hit", "n_items", "items_sha256")
    text_at = [c.lower() for c in docs.columns].index("text")     # the text travels once, inside its row
    none = hashlib.sha256(b"").hexdigest()

    def finish(batches):
        for batch in batches:
            n = [np.diff(first) for _, _, _, _, first in _blocks(batch.column("row").field(text_at).cast(pa.string()))]
            hit = batch.column("n_hit").fill_null(0)
            yield pa.record_batch({
                "row": batch.column("row"), "n_words": pa.array(np.concatenate(n) if n else [], pa.int64()), "n_hit": hit,
                "n_items": batch.column("n_items").fill_null(0), "items_sha256": batch.column("items_sha256").fill_null(none),
                "contaminated": pc.greater(hit, 0)})

    out = (T.StructType([rows.schema["row"]]).add("n_words", "long").add("n_hit", "long").add("n_items", "long")
           .add("items_sha256", "string").add("contaminated", "boolean"))
    return both.mapInArrow(finish, out)
