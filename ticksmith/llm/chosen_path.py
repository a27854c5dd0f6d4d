"""Chosen-path set similarity join for near-duplicate texts (dealt operator 11).

A document is the set of its distinct k-word shingles; two link when
``den * |A n B| >= num * |A u B|``.  Equal sets are one class.  Each class has
``POSITIONS`` minwise hashes of its set, and independent random trees branch on
them:

* a node chooses one position, or with the fractional part of ``den / num``
  another one, by a hash of its name; its children are the classes with equal
  minwise tokens there.  A pair at the threshold is then expected in one child
  of every node that holds both, so it survives a level with 0.87 and five with
  0.58; ``trees`` independent trees miss it with 0.42^8 < 0.001.
* a node of at most ``NODE`` classes is compared exhaustively, by minwise
  estimates; a class and the first one it hangs together with go on.
* a larger node compares its classes with one of them.  Those alike enough
  leave: every partner of theirs is, by the triangle inequality of the Jaccard
  distance, near that centre too, so both hang together with it.  The rest
  branch.  This holds for nodes of any size, so a group of near copies with a
  third of all rows leaves at the first level and no node is cut or capped.
* ``setlinks.linked_classes`` confirms links on full sets.

Levels go on until no large node is left.  The margins around estimates are
four standard errors of ``POSITIONS`` hashes.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.arrays import mix64, release
from ticksmith.llm.components import components
from ticksmith.llm.jaccard import _digest, shingle_sets
from ticksmith.llm.setlinks import LIMIT, Joined, linked_classes
from ticksmith.plans.storage import discard, materialize

POSITIONS = 128
TREES = 8
NODE = 1024
WIDTH = 1 << 13       # shingles hashed at once
PAIRS = 1 << 15       # pairs compared at once

_MULTIPLY = mix64(np.arange(1, POSITIONS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def minwise(u: np.ndarray) -> np.ndarray:
    """The set's minwise tokens, 32 bits each."""
    low = np.full(POSITIONS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(u), WIDTH):
        low = np.minimum(low, np.multiply.outer(_MULTIPLY, u[i:i + WIDTH]).min(axis=1))
    return (mix64(low) >> np.uint64(32)).astype(np.uint32)


def margin(share: float) -> float:
    """Four standard errors of an estimate of this similarity."""
    return 4 * (share * (1 - share) / POSITIONS) ** 0.5


def radii(t: float) -> tuple[float, float, float]:
    """(pair, leave, near): estimates from which a pair may link, a class leaves with a centre, and is near it."""
    pair = t - margin(t)
    leave = (1 + t) / 2 - 0.125
    least = leave - margin(leave)            # true similarity of one that leaves
    partner = max(least + t - 1, 0.0)        # and of any partner of it to the centre
    return pair, leave, max(partner - margin(partner), 0.0)


PROFILE = "doc_id bigint, key bigint, n bigint, digest binary, sig binary, high binary"


def profile(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, key, n, digest, sig, high) of rows (doc_id, key, text); the last two once a batch and digest.

    sig has the low halves of the minwise tokens, enough to estimate by; paths need the high ones too.
    """

    def run(batches):
        for batch in batches:
            n, digests, sigs, highs, seen = [], [], [], [], set()
            for u, _ in shingle_sets(batch.column("text"), k):
                n.append(len(u))
                d = _digest(u) if len(u) else None
                digests.append(d)
                tokens = minwise(u) if d and d not in seen else None
                sigs.append(None if tokens is None else tokens.astype(np.uint16).tobytes())
                highs.append(None if tokens is None else (tokens >> np.uint32(16)).astype(np.uint16).tobytes())
                seen.add(d)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "key": batch.column("key"), "n": pa.array(n, pa.int64()),
                                   "digest": pa.array(digests, pa.binary()), "sig": pa.array(sigs, pa.binary()), "high": pa.array(highs, pa.binary())})

    return docs.mapInArrow(run, PROFILE)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, POSITIONS)


def _tokens(batch) -> np.ndarray:
    return _matrix(batch.column("sig")).astype(np.uint32) | (_matrix(batch.column("high")).astype(np.uint32) << np.uint32(16))


def children(node: np.ndarray, tokens: np.ndarray, t: float):
    """(row, child) of the paths that each row's node chooses."""
    for j in range(int(np.ceil(1 / t))):
        lot = mix64(node ^ np.uint64(0xC0FFEE + 2 * j))
        share = 1 / t - j
        take = np.flatnonzero((lot >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 < share)
        place = (mix64(node[take] ^ np.uint64(0xC0FFEE + 2 * j + 1)) % np.uint64(POSITIONS)).astype(np.int64)
        token = tokens[take, place].astype(np.uint64) | (place.astype(np.uint64) << np.uint64(32))
        yield take, mix64(node[take] + mix64(token + np.uint64(1)))


def first_level(classes: DataFrame, trees: int, t: float) -> DataFrame:
    """(node, cid) of every tree's first chosen paths."""

    def run(batches):
        for batch in batches:
            tokens, cid = _tokens(batch), batch.column("cid").to_numpy()
            for tree in range(trees):
                node = np.full(len(cid), mix64(np.array([tree + 1], np.uint64))[0])
                for take, child in children(node, tokens, t):
                    yield pa.record_batch({"node": pa.array(child.view(np.int64)), "cid": pa.array(cid[take])})

    return classes.select("cid", "sig", "high").mapInArrow(run, "node bigint, cid bigint")


def leaf_pairs(members: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): classes of small nodes (node, digest, n, sig) and the first one of the node they hang together with."""
    pair = radii(num / den)[0] * POSITIONS

    def judge(table: pa.Table):
        node, n, sig = table["node"].to_numpy(), table["n"].to_numpy(), _matrix(table["sig"])
        begin = np.flatnonzero(np.r_[True, node[1:] != node[:-1]])
        size = np.diff(np.r_[begin, len(node)])
        last = np.repeat(begin + size, size)
        count = last - np.arange(len(node)) - 1
        upto, joined, a = np.cumsum(count), Joined(len(node)), 0
        while a < len(node):
            b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + PAIRS, "right")))
            x = np.repeat(np.arange(a, b), count[a:b])
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(count[a:b]) - count[a:b], count[a:b])
            ok = (n[x] * den >= n[y] * num) & (n[y] * den >= n[x] * num) & joined.open(x, y)
            x, y = x[ok], y[ok]
            ok = (sig[x] == sig[y]).sum(axis=1) >= pair
            joined.join(x[ok], y[ok])
            a = b
        one = np.flatnonzero(joined.root != np.arange(len(node)))
        digest = table["digest"]
        return pa.record_batch({"a": digest.take(pa.array(joined.root[one])).combine_chunks(),
                                "b": digest.take(pa.array(one)).combine_chunks()})

    def run(batches):
        held = None
        for batch in batches:   # sorted by node: the last one may go on in the next batch
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            node = held["node"].to_numpy()
            cut = int(np.searchsorted(node, node[-1], "left")) if len(node) else 0
            if cut:
                yield judge(held.slice(0, cut).combine_chunks())
                held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield judge(held.combine_chunks())
        release()

    return members.repartition("node").sortWithinPartitions("node").mapInArrow(run, "a binary, b binary")


def branch(members: DataFrame, num: int, den: int) -> DataFrame:
    """Of large nodes' rows (node, cid, digest, sig, high, centre, centre_sig): edges (a, b) to the centre, and child rows (node, cid)."""
    t = num / den
    _, leave, near = radii(t)

    def run(batches):
        for batch in batches:
            node = batch.column("node").to_numpy().view(np.uint64)
            sig, cid = _matrix(batch.column("sig")), batch.column("cid").to_numpy()
            alike = (sig == _matrix(batch.column("centre_sig"))).mean(axis=1) if len(sig) else np.zeros(0)
            there = pa.array(alike >= near)
            a, b = batch.column("centre").filter(there), batch.column("digest").filter(there)
            yield pa.record_batch({"a": a, "b": b, "node": pa.nulls(len(a), pa.int64()), "cid": pa.nulls(len(a), pa.int64())})
            go = np.flatnonzero(alike < leave)
            for take, child in children(node[go], _tokens(batch)[go], t):
                none = pa.nulls(len(take), pa.binary())
                yield pa.record_batch({"a": none, "b": none, "node": pa.array(child.view(np.int64)), "cid": pa.array(cid[go][take])})

    return members.mapInArrow(run, "a binary, b binary, node bigint, cid bigint")


def near_classes(classes: DataFrame, num: int, den: int, trees: int = TREES, node_size: int = NODE) -> DataFrame:
    """(a, b) edges that connect all classes (cid, digest, n, sig) which the trees find near."""
    own = classes.select("cid", "digest", "n", "sig", "high")
    if classes.limit(node_size + 1).count() <= node_size:   # the root is a small node
        return materialize(leaf_pairs(own.withColumn("node", F.lit(0).cast("bigint")), num, den), "path-edges")
    rows, levels, found = materialize(first_level(own, trees, num / den), "path-rows"), [], []
    while True:
        lot = F.xxhash64("cid", "node")
        sizes = materialize(rows.groupBy("node").agg(F.count(F.lit(1)).alias("size"), F.min(lot).alias("least"),
                                                     F.bit_xor(F.xxhash64("cid")).alias("members"))
                            .where("size > 1"), "path-nodes")
        levels.append((rows, sizes))
        large = sizes.where(F.col("size") > node_size).select("node", "least")
        if large.isEmpty():
            break
        members = rows.join(large, "node").withColumn("lot", lot).join(own, "cid")
        centres = (members.where("lot = least").dropDuplicates(["node"])
                   .select("node", F.col("digest").alias("centre"), F.col("sig").alias("centre_sig")))
        found.append(materialize(branch(members.select("node", "cid", "digest", "sig", "high").join(centres, "node"), num, den),
                                 "path-branch"))
        rows = found[-1].where("node IS NOT NULL").select("node", "cid").distinct()
    # near copies meet in many nodes of the same members, of any level: one of them is enough
    once = materialize(_union([s.where(F.col("size") <= node_size) for _, s in levels])
                       .groupBy("size", "members").agg(F.min("node").alias("node")).select("node"), "path-leaves")
    leaves = _union([r for r, _ in levels]).join(once, "node").join(own.drop("high"), "cid").select("node", "digest", "n", "sig")
    edges = _union([leaf_pairs(leaves, num, den), *(f.where("a IS NOT NULL AND a <> b").select("a", "b") for f in found)])
    edges = materialize(edges.distinct(), "near-edges")
    discard(levels[0][0], once, *(s for _, s in levels), *found)
    return edges


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def near_duplicates(docs: DataFrame, k: int = 5, threshold: Fraction = Fraction(8, 10), trees: int = TREES,
                    node_size: int = NODE, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable by links, itself included;
    kept says that the row is this one.  Null and empty texts have n_shingles 0,
    are linked with nothing and kept; texts of fewer than k words have one
    shingle, the whole sequence.  Very long texts are one set like any other.
    Repeated rows are all returned, all kept if one is.  A row with a null
    doc_id links like any other, gets the smallest id of its component (null if no row there has
    one) and is never kept.  Other columns are ignored; an empty table gives
    an empty result.  Links are exact; the trees find a pair at the threshold
    with more than 0.999, one above it more surely.
    """
    num, den = threshold.numerator, threshold.denominator
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("key", F.xxhash64("text"))
    thin = materialize(profile(docs, k), "minwise-profile")
    classes = materialize(thin.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("low"), F.coalesce(F.min_by("key", "doc_id"), F.min("key")).alias("rep"),
        F.max("n").alias("n"), F.max("sig").alias("sig"), F.max("high").alias("high")).withColumn("cid", F.xxhash64("digest")), "minwise-classes")
    near = near_classes(classes, num, den, trees, node_size)

    def sets(column):
        return (u for u, _ in shingle_sets(column, k))

    links = linked_classes(near, classes, docs, sets, _digest, num, den, limit=limit)
    linked = components(links).select(F.col("node").alias("digest"), "root").join(classes.select("digest", "low"), "digest")
    low = linked.groupBy("root").agg(F.min("low").alias("component_id"))
    named = materialize(linked.join(low, "root").select("digest", "component_id"), "linked-classes")
    alone = classes.join(named, "digest", "left_anti").select("digest", F.col("low").alias("component_id"))
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    found = (thin.drop("sig", "high").join(named.union(alone), "digest", "left")
             .select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
             .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))
    discard(near, links)
    return found
