"""Exact links between sets, one group of candidates at a time.

Operators that join sets by similarity find *near* classes first, each by its
method, and hand over only which classes hang together (``(a, b)`` edges, at
most one a class and bucket), never all pairs.  ``linked_classes`` turns these
into groups, brings each class's full set once to its group's task and returns
true links, again at most one a class and task.

A group above ``limit`` shingles is cut into blocks.  Each block is joined by
itself first, with the group's centre added to every block, so the bulk of a
large group of near copies becomes one component.  The second round compares
blocks with each other, cut by component; two blocks of one component need no
comparison.  No task holds more than two blocks, no pair is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.arrays import release
from ticksmith.llm.components import components
from ticksmith.plans.storage import discard, materialize

LIMIT = 1_000_000       # shingles of a block: 8 MB
PAIRS = 200_000         # pairs compared at once
MATRIX = 32 << 20       # bytes of a group's bitmaps
STARS = 4               # members a group is compared with before its pairs
BROADCAST_IDS = 300_000 # of about 60 bytes; more are joined by a shuffle


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x).sum(axis=-1, dtype=np.int64)


class Joined:
    """Union-find over 0..n-1 with whole arrays of pairs; ``root`` is a group's smallest member."""

    def __init__(self, root: np.ndarray | int):
        self.root = np.arange(root) if isinstance(root, int) else root.copy()

    def open(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.root[x] != self.root[y]

    def join(self, x: np.ndarray, y: np.ndarray) -> None:
        while len(x):
            a, b = self.root[x], self.root[y]
            ok = a != b
            if not ok.any():
                return
            x, y, a, b = x[ok], y[ok], a[ok], b[ok]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))
            while True:
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up


def bitmap(u: np.ndarray, width: int) -> np.ndarray:
    """Token bitmap of a set as 64-bit words; ``width`` is a power of two."""
    on = np.zeros(width, np.uint8)
    on[(u & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(on, bitorder="little").view(np.uint64)


def most_overlap(p: np.ndarray, q: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Upper bounds of |A n B| from the bitmaps (rows of equal width) and sizes."""
    return np.minimum(n - popcount(p & ~q), m - popcount(q & ~p))


def reaches(overlap, n, m, num: int, den: int):
    """True where this overlap suffices: den * |A n B| >= num * |A u B|."""
    return overlap * (den + num) >= num * (n + m)


def _exact(p: np.ndarray, q: np.ndarray) -> int:
    if len(p) > len(q):
        p, q = q, p
    at = np.searchsorted(q, p)
    return int((q[np.minimum(at, len(q) - 1)] == p).sum())


def all_pairs(n: np.ndarray, bits: np.ndarray, joined: Joined, num: int, den: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Every pair of members whose sizes allow a link, in bounded portions."""
    order = np.argsort(n, kind="stable")
    size = n[order]
    upto = np.searchsorted(size, size * den // num, "right")
    begin = 0
    while begin < len(order):
        count = upto[begin:] - np.arange(begin, len(order)) - 1
        take = max(1, int(np.searchsorted(np.cumsum(count), PAIRS, "right")))
        count = count[:take]
        x = np.repeat(np.arange(begin, begin + take), count)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(count) - count, count)
        yield order[x], order[y]
        begin += take


def group_links(sets: list[np.ndarray], root: np.ndarray, num: int, den: int, pairs: Callable = all_pairs) -> np.ndarray:
    """Component of each set under exact links; ``root`` has those known before.

    ``pairs`` yields the candidate pairs; what size, bitmaps or a known
    component rule out is not intersected.
    """
    n = np.array([len(u) for u in sets], np.int64)
    joined = Joined(root)

    def settle(x, y):
        """Exact test of the pairs that bitmaps leave open, a member's pairs one after another."""
        for a in range(0, len(x), PAIRS):
            p, q = x[a:a + PAIRS], y[a:a + PAIRS]
            ok = joined.open(p, q) & (n[p] * den >= n[q] * num) & (n[q] * den >= n[p] * num)
            p, q = p[ok], q[ok]
            step = max(1, MATRIX // (8 * bits.shape[1]))
            ok = np.concatenate([reaches(most_overlap(bits[p[i:i + step]], bits[q[i:i + step]], n[p[i:i + step]], n[q[i:i + step]]),
                                         n[p[i:i + step]], n[q[i:i + step]], num, den) for i in range(0, len(p), step)] or [np.zeros(0, bool)])
            for i, j in zip(p[ok].tolist(), q[ok].tolist(), strict=True):
                if joined.root[i] != joined.root[j] and reaches(_exact(sets[i], sets[j]), len(sets[i]), len(sets[j]), num, den):
                    joined.join(np.array([i]), np.array([j]))

    if len(sets) == 2:
        if joined.root[0] != joined.root[1] and reaches(_exact(*sets), n[0], n[1], num, den):
            joined.join(np.array([0]), np.array([1]))
        return joined.root
    width = 1 << max(10, int(4 * n.max() - 1).bit_length())
    while width > 1024 and width // 8 * len(sets) > MATRIX:
        width //= 2
    bits = np.array([bitmap(u, width) for u in sets])
    for i in range(STARS if len(sets) > 8 else 0):   # cheap: most of a group of near copies is joined by these
        alone = np.flatnonzero(joined.root != np.bincount(joined.root, minlength=len(sets)).argmax()) if i else np.arange(len(sets))
        if len(alone):
            settle(np.full(len(sets), alone[len(alone) // 2]), np.arange(len(sets)))
    for x, y in pairs(n, bits, joined, num, den):
        settle(x, y)
    return joined.root


def encoded(rows: DataFrame, sets: Callable, digest: Callable, layout: str, encode: Callable, keep: tuple[str, ...] = ()) -> DataFrame:
    """(digest, ``keep`` columns, the fields of ``encode(set)``) of rows (text, digest, ...), in batches of bounded size.

    ``sets(text column)`` yields each row's set; a row whose set isn't the one
    its digest names is left out, as is one that its task has sent already.
    """

    def run(batches):
        fields = None
        for batch in batches:
            held, load, seen = [], 0, set()
            names = batch.column("digest").to_pylist()
            extra = {c: batch.column(c).to_pylist() for c in keep}
            fields = fields or pa.schema([("digest", pa.binary()), *((c, batch.schema.field(c).type) for c in keep),
                                          *((c.split()[0], {"int": pa.int32(), "binary": pa.binary()}[c.split()[1]])
                                            for c in layout.split(", "))])
            for i, u in enumerate(sets(batch.column("text"))):
                me = (names[i], *(extra[c][i] for c in keep))
                if not len(u) or me in seen or digest(u) != names[i]:
                    continue
                seen.add(me)
                held.append({"digest": names[i], **{c: extra[c][i] for c in keep}, **encode(u)})
                load += u.nbytes
                if load > 4 << 20:
                    yield pa.RecordBatch.from_pylist(held, fields)
                    held, load = [], 0
            yield pa.RecordBatch.from_pylist(held, fields)

    kinds = dict(rows.dtypes)
    return rows.mapInArrow(run, ", ".join(["digest binary", *(f"{c} {kinds[c]}" for c in keep), layout]))


def rows_of(docs: DataFrame, ids: DataFrame, *more: str) -> DataFrame:
    """(text, digest, ``more``) of the rows of ``docs`` (doc_id, key, text) that ``ids`` (low, rep, digest, ...) name.

    The ids are broadcast up to BROADCAST_IDS of them (counted first), else
    joined by a shuffle.  Null ids match each other.
    """
    ids = ids.select("low", "rep", "digest", *more)
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    same = (F.col("key") == F.col("rep")) & F.col("doc_id").eqNullSafe(F.col("low"))
    return docs.join(F.broadcast(ids) if few else ids, same).select("text", "digest", *more)


def _in_tasks(placed: DataFrame, num: int, den: int, pairs: Callable) -> DataFrame:
    """(a, b) links of each task's sets (task, digest, root, grams): a class and the first one of its component.

    Rows come sorted by task, so one group is held at a time.
    """

    def run(batches):
        task, names, roots, sets = None, {}, [], []

        def links():
            if len(sets) < 2:
                return
            first: dict = {}
            known = np.array([first.setdefault(r, i) if r is not None else i for i, r in enumerate(roots)])
            root = group_links(sets, known, num, den, pairs)
            names_ = list(names)
            new = np.flatnonzero(root != known)
            if len(new):
                yield pa.record_batch({"a": pa.array([names_[i] for i in root[new]], pa.binary()),
                                       "b": pa.array([names_[i] for i in new], pa.binary())})

        for batch in batches:
            grams = batch.column("grams")
            for i, (t, d, r) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("task", "digest", "root")), strict=True)):
                if t != task:
                    yield from links()
                    task, names, roots, sets = t, {}, [], []
                if d not in names:
                    names[d] = len(sets)
                    roots.append(r)
                    sets.append(np.frombuffer(grams[i].as_py(), np.uint64))
        yield from links()
        release()

    return placed.repartition("task").sortWithinPartitions("task").mapInArrow(run, "a binary, b binary")


def linked_classes(near: DataFrame, classes: DataFrame, docs: DataFrame, sets: Callable, digest: Callable,
                   num: int, den: int, pairs: Callable = all_pairs, limit: int = LIMIT) -> DataFrame:
    """(a, b) links between classes that connect just those which true links connect.

    ``near`` (a, b) must connect all classes that may link.  ``classes``
    (digest, n, low, rep) names a row of each in ``docs`` (doc_id, key, text);
    the sets are made anew from these texts, in which ``sets`` and ``digest`` must
    agree with the caller's.
    """
    groups = materialize(components(near).select(F.col("node").alias("digest"), F.col("root").alias("home"))
                         .join(classes.select("digest", "n", "low", "rep"), "digest"), "near-groups")
    sizes = groups.groupBy("home").agg(F.sum("n").alias("load"), F.min_by("digest", F.xxhash64("digest")).alias("centre"))
    large = materialize(sizes.where(F.col("load") > limit), "large-groups")
    cut = F.ceil(F.col("load") / limit).cast("bigint")
    block = F.pmod(F.xxhash64("digest"), cut)
    one = groups.join(large.select("home", "load"), "home", "left").select(
        "digest", "low", "rep", F.struct("home", F.coalesce(block, F.lit(0)).alias("i"), F.lit(0).cast("bigint").alias("j")).alias("task"),
        F.lit(None).cast("binary").alias("root"))
    centres = (large.join(groups.select("digest", "low", "rep"), F.col("centre") == F.col("digest"))
               .select("digest", "low", "rep", F.explode(F.sequence(F.lit(0).cast("bigint"), cut - 1)).alias("i"), "home")
               .select("digest", "low", "rep", F.struct("home", "i", F.lit(0).cast("bigint").alias("j")).alias("task"),
                       F.lit(None).cast("binary").alias("root")))

    def links(ids, name):
        task = F.concat_ws("-", F.hex("task.home"), F.col("task.i").cast("string"), F.col("task.j").cast("string"))
        rows = rows_of(docs, materialize(ids.withColumn("task", task), f"{name}-ids"), "task", "root")
        placed = encoded(rows, sets, digest, "grams binary", lambda u: {"grams": u.tobytes()}, ("task", "root"))
        return materialize(_in_tasks(placed, num, den, pairs), name)

    if large.isEmpty():
        found = links(one, "group-links")
        discard(groups, large)
        return found
    first = links(one.union(centres), "block-links")
    # second round: blocks of one component each, and mixed ones of the small components
    held = groups.join(large.select("home"), "home", "left_semi")
    named = materialize(held.join(components(first).withColumnsRenamed({"node": "digest"}), "digest", "left")
                        .withColumn("root", F.coalesce("root", "digest")), "large-members")
    parts = named.groupBy("home", "root").agg(F.sum("n").alias("own"))
    small = parts.where(F.col("own") <= limit).groupBy("home").agg(F.sum("own").alias("mixed"))
    placed = (named.join(parts, ["home", "root"]).join(small, "home", "left")
              .withColumn("pure", F.col("own") > limit)
              .withColumn("at", F.when(F.col("pure"), F.concat(F.hex("root"), F.lit(":"), F.pmod(F.xxhash64("digest"), F.ceil(F.col("own") / limit).cast("bigint")).cast("string")))
                          .otherwise(F.concat(F.lit("mixed:"), F.pmod(F.xxhash64("root"), F.ceil(F.col("mixed") / limit).cast("bigint")).cast("string")))))
    placed = materialize(placed.select("home", "digest", "low", "rep", "n", "root", "pure", "at"), "large-blocks")
    blocks = placed.groupBy("home", "at").agg(F.min("n").alias("lo"), F.max("n").alias("hi"),
                                              F.max(F.when(F.col("pure"), F.col("root"))).alias("whole"))
    x, y = (blocks.select("home", *(F.col(c).alias(f"{c}_{side}") for c in ("at", "lo", "hi", "whole"))) for side in "xy")
    meet = (x.join(y, "home").where((F.col("at_x") <= F.col("at_y")) & (F.col("hi_x") * den >= F.col("lo_y") * num)
                                    & (F.col("hi_y") * den >= F.col("lo_x") * num)
                                    & ~F.coalesce(F.col("whole_x") == F.col("whole_y"), F.lit(False))))
    sides = meet.select("home", F.col("at_x").alias("at"), "at_x", "at_y").union(
        meet.where("at_x <> at_y").select("home", F.col("at_y").alias("at"), "at_x", "at_y"))
    two = placed.join(sides, ["home", "at"]).select(
        "digest", "low", "rep", F.struct("home", F.col("at_x").alias("i"), F.col("at_y").alias("j")).alias("task"), "root")
    second = links(two, "cross-links")
    found = materialize(first.union(second), "all-links")
    discard(groups, large, named, placed, first, second)
    return found
