"""N-gram Jaccard join with signature trees (dealt operator 9).

A document is the set of its distinct k-word shingles; two documents link when
``den * |A n B| >= num * |A u B|``.  Texts with equal sets are one class, and
the join runs between classes:

1. ``profile``: one pass gives every row its set size and set digest, and the
   shingles that many sets of a task hold (candidates for hot).
2. ``prefix_blocks``: linked sets share one of the first
   ``n - ceil(t * n) + 1`` shingles of any total order.  The order puts long
   shingles first and hot ones last, so few unrelated sets meet.  Prefix
   entries travel as flat arrays, one row per task and bucket; a hot shingle's
   entries are also split by size band.
3. ``by_members``: shingles with the same classes become one group.
4. ``near_classes``: in a bucket the entries of each group form a signature
   tree: leaves hold a set's token bitmap and size, nodes the OR of their
   children's bitmaps, size ranges and the largest number of tokens that share
   bits.  Dual traversal drops each node pair whose largest possible overlap is
   below the least needed one, or that hangs together already.  Pairs don't
   leave the bucket: a class and the first one it hangs together with are all
   that is passed on, at most one row a class.
5. ``setlinks.linked_classes``: classes that hang together over all buckets
   meet once, as a group, with their full sets; signature trees over the group
   and exact intersections give its links, again at most one row a class.
6. components of the links, joined back to every row.

Hashes of shingles are 64 bits wide; that two different shingles of compared
texts collide is not expected in any corpus (about 2^-64 a pair).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ticksmith.llm.arrays import (blocks, gram_hashes, lower_ascii, mix64, release, space_table,
                                  text_bytes, word_hashes, words)
from ticksmith.llm.components import components
from ticksmith.llm.setlinks import (LIMIT, MATRIX, Joined, bitmap, encoded, linked_classes, most_overlap, popcount,
                                    reaches, rows_of)
from ticksmith.plans.storage import discard, materialize

SIG_WORDS = 16           # bitmap of 1024 bits
FANOUT = 8
HOT_LIST = 200_000       # at most so many shingles are sorted last: 1.6 MB broadcast
HOT_LEAST = 8            # sets of one task with a shingle that make it a candidate
FLUSH = 1_000_000        # shingles a task holds before it sends them on
FRONTIER = 400_000       # node pairs held at once
PORTION = 100_000        # leaf pairs judged at once
BUCKET_ENTRIES = 400_000 # prefix entries of a bucket, about


def shingle_sets(batch_text, k: int):
    """(hashes, lengths) of each row's distinct shingles, hashes ascending.

    A length counts the bytes of the words alone, so that equal shingles have
    equal ones whatever white space stands between their words.
    """
    raw, off = text_bytes(batch_text)
    table = space_table()
    for a, b in blocks(off):
        part = lower_ascii(raw[off[a]:off[b]])
        start, end, first = words(part, off[a:b + 1] - off[a], table)
        h = word_hashes(part, start, end)
        grams = gram_hashes(h, k)
        upto = np.r_[0, np.cumsum(end - start)]
        span = upto[k:] - upto[:-k]
        for i in range(b - a):
            f, g = int(first[i]), int(first[i + 1])
            if g - f >= k:
                u, at = np.unique(grams[f:g - k + 1], return_index=True)
                yield u, span[f + at]
            elif g > f:   # fewer words: the whole sequence is one shingle
                whole = gram_hashes(h[f:g], g - f) ^ np.uint64(0xA5A5A5A5 + g - f)
                yield whole, upto[g:g + 1] - upto[f]
            else:
                yield h[:0], start[:0]


def prefix_length(n: int, num: int, den: int) -> int:
    return n + (-n * num // den) + 1


def ranks(u: np.ndarray, length: np.ndarray, hot: np.ndarray | None) -> np.ndarray:
    """Sort key of shingles: longest first, hot ones last, then by hash."""
    first = (255 - np.minimum(length, 250)).astype(np.uint64)
    key = (first << np.uint64(56)) | (u >> np.uint64(8))
    if hot is not None and len(hot) and len(key):
        at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
        key = np.where(hot[at] == key, key | np.uint64(0xFF << 56), key)
    return key


def prefix(u, length, hot, num, den) -> np.ndarray:
    key, p = ranks(u, length, hot), prefix_length(len(u), num, den)
    return np.partition(key, p - 1)[:p] if p < len(key) else key


def _digest(u: np.ndarray) -> bytes:
    return hashlib.blake2b(u.tobytes(), digest_size=16).digest()


PROFILE = "doc_id bigint, key bigint, n bigint, digest binary, shingle bigint, entries bigint"


def profile(docs: DataFrame, k: int) -> DataFrame:
    """Rows (doc_id, key, n, digest), and rows (shingle, entries) of each task's frequent shingles."""

    def run(batches):
        seen, held, last = [], 0, None

        def counted():
            keys, n = np.unique(np.concatenate(seen), return_counts=True) if seen else (np.zeros(0, np.uint64),) * 2
            keep = n >= HOT_LEAST
            m = int(keep.sum())
            return pa.record_batch({
                "doc_id": pa.nulls(m, pa.int64()), "key": pa.nulls(m, pa.int64()), "n": pa.nulls(m, pa.int64()),
                "digest": pa.nulls(m, pa.binary()),
                "shingle": pa.array(keys[keep].astype(np.uint64).view(np.int64)),
                "entries": pa.array(n[keep].astype(np.int64))})

        for batch in batches:
            n, digest = [], []
            for u, length in shingle_sets(batch.column("text"), k):
                n.append(len(u))
                if len(u):
                    last = _digest(u)
                    seen.append(ranks(u, length, None))
                    held += len(seen[-1])
                digest.append(last if len(u) else None)
            m = len(n)
            yield pa.record_batch({
                "doc_id": batch.column("doc_id"), "key": batch.column("key"), "n": pa.array(n, pa.int64()),
                "digest": pa.array(digest, pa.binary()),
                "shingle": pa.nulls(m, pa.int64()), "entries": pa.nulls(m, pa.int64())})
            if held > FLUSH:
                yield counted()
                seen, held = [], 0
        yield counted()

    return docs.mapInArrow(run, PROFILE)


def hot_shingles(profiled: DataFrame) -> np.ndarray:
    """The most frequent shingles, at most HOT_LIST; they only steer the order."""
    top = (profiled.where("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("entries").alias("n"))
           .orderBy(F.desc("n"), "shingle").limit(HOT_LIST).select("shingle"))
    table = top.toArrow()
    return np.sort(table["shingle"].to_numpy().astype(np.int64).view(np.uint64))


ENTRIES = "bucket int, shingle binary, who binary, n binary, digest binary"


def _flat_rows(key: np.ndarray, own: np.ndarray, n: np.ndarray, digest: np.ndarray, buckets: int):
    """Entries (key, owner) as ENTRIES rows, one a bucket; n and digest are the owners'."""
    to = (mix64(key) % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(to, kind="stable")
    key, own, to = key[order], own[order], to[order]
    cuts = np.flatnonzero(np.r_[True, to[1:] != to[:-1], True])
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        used, local = np.unique(own[a:b], return_inverse=True)
        yield pa.record_batch({
            "bucket": pa.array([int(to[a])], pa.int32()),
            "shingle": pa.array([key[a:b].tobytes()], pa.binary()),
            "who": pa.array([local.astype(np.int32).tobytes()], pa.binary()),
            "n": pa.array([n[used].tobytes()], pa.binary()),
            "digest": pa.array([digest[used].tobytes()], pa.binary())})


def prefix_blocks(docs: DataFrame, k: int, num: int, den: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """Prefix entries as flat arrays: one row per task (or full buffer) and bucket.

    Equal sets of one buffer are sent once.  A hot shingle's entries get a key
    per size band and go to the own and the next band, where every set of a
    linkable size meets; the other shingles keep one key.
    """
    held_hot = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        hot = held_hot.value
        known: dict[bytes, int] = {}
        keys, who, sizes = [], [], []

        def emit():
            if not keys:
                return
            key, own = np.concatenate(keys), np.repeat(np.arange(len(who)), who)
            n = np.array(sizes, np.int32)
            digest = np.frombuffer(b"".join(known), np.uint8).reshape(-1, 16)
            band = np.floor(np.log(n) / np.log(den / num) + 1e-9).astype(np.uint64) if den > num else n.astype(np.uint64)
            is_hot = (key >> np.uint64(56)) == np.uint64(255)
            salt = band[own[is_hot]]
            key, own = (np.concatenate([key[~is_hot], mix64(key[is_hot] + salt), mix64(key[is_hot] + salt + np.uint64(1))]),
                        np.concatenate([own[~is_hot], own[is_hot], own[is_hot]]))
            yield from _flat_rows(key, own, n, digest, buckets)

        total = 0
        for batch in batches:
            for u, length in shingle_sets(batch.column("text"), k):
                if not len(u):
                    continue
                d = _digest(u)
                if d in known:
                    continue
                known[d] = len(known)
                p = prefix(u, length, hot, num, den)
                keys.append(p)
                who.append(len(p))
                sizes.append(len(u))
                total += len(p)
            if total > FLUSH:
                yield from emit()
                known, keys, who, sizes, total = {}, [], [], [], 0
        yield from emit()

    return docs.select("text").mapInArrow(run, ENTRIES)


class Forest:
    """Signature trees over consecutive groups of leaves, FANOUT children a node.

    Level 0 are the leaves; a node of level l covers FANOUT^l consecutive
    leaves of its group.
    """

    def __init__(self, first: np.ndarray, n: np.ndarray, sig: np.ndarray, root: np.ndarray | None = None):
        spill = n - popcount(sig)
        root = np.arange(len(n)) if root is None else root
        self.levels = [(first, sig, n, n, spill, root, root)]
        while (np.diff(self.levels[-1][0]) > 1).any():
            f, s, lo, hi, c, r, t = self.levels[-1]
            count = -(-np.diff(f) // FANOUT)
            up = np.r_[0, np.cumsum(count)]
            at = np.repeat(f[:-1], count) + (np.arange(up[-1]) - np.repeat(up[:-1], count)) * FANOUT
            self.levels.append((up, np.bitwise_or.reduceat(s, at, axis=0), np.minimum.reduceat(lo, at),
                                np.maximum.reduceat(hi, at), np.maximum.reduceat(c, at),
                                np.minimum.reduceat(r, at), np.maximum.reduceat(t, at)))

    def keep(self, level: int, x: np.ndarray, y: np.ndarray, num: int, den: int) -> np.ndarray:
        """Node pairs that may hold a new link: by size ranges, largest possible overlap and components."""
        _, sig, lo, hi, spill, r, t = self.levels[level]
        ok = (hi[x] * den >= lo[y] * num) & (hi[y] * den >= lo[x] * num)
        ok &= (r[x] != t[x]) | (r[y] != t[y]) | (r[x] != r[y])
        x, y = x[ok], y[ok]
        most = np.minimum(np.minimum(hi[x], hi[y]), popcount(sig[x] & sig[y]) + np.minimum(spill[x], spill[y]))
        ok[ok] = most * (den + num) >= num * (lo[x] + lo[y])
        return ok

    def pairs(self, num: int, den: int):
        """Leaf pairs that survive the dual traversal, in bounded portions."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]) - 1)
        stack = [(top, roots[a:a + FRONTIER], roots[a:a + FRONTIER], roots[a:a + FRONTIER])
                 for a in range(0, len(roots), FRONTIER)]
        while stack:
            level, g, x, y = stack.pop()
            if level == 0:
                yield x, y
                continue
            up, down = self.levels[level][0], self.levels[level - 1][0]
            begin, end = down[g], down[g + 1]
            ax, ay = begin + (x - up[g]) * FANOUT, begin + (y - up[g]) * FANOUT
            nx, ny = np.minimum(end - ax, FANOUT), np.minimum(end - ay, FANOUT)
            count = nx * ny
            if len(count) > 1 and count.sum() > FRONTIER:
                half = len(g) // 2
                stack += [(level, g[:half], x[:half], y[:half]), (level, g[half:], x[half:], y[half:])]
                continue
            own = np.repeat(np.arange(len(g)), count)
            i = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
            cx, cy = ax[own] + i // ny[own], ay[own] + i % ny[own]
            ok = cx < cy if level == 1 else cx <= cy
            own, cx, cy = own[ok], cx[ok], cy[ok]
            ok = self.keep(level - 1, cx, cy, num, den)
            if ok.any():
                stack.append((level - 1, g[own[ok]], cx[ok], cy[ok]))


def _bucket(batches):
    """(shingle, who, n, names) of a bucket; equal digests are one class."""
    shingle, who, n, digest, base = [], [], [], [], 0
    for t in batches:
        for i in range(t.num_rows):
            shingle.append(np.frombuffer(t.column("shingle")[i].as_buffer(), np.uint64))
            who.append(np.frombuffer(t.column("who")[i].as_buffer(), np.int32).astype(np.int64) + base)
            n.append(np.frombuffer(t.column("n")[i].as_buffer(), np.int32))
            digest.append(np.frombuffer(t.column("digest")[i].as_buffer(), np.uint64).reshape(-1, 2))
            base += len(n[-1])
    release()
    wide = np.concatenate(digest)
    _, at, same = np.unique(np.rec.fromarrays([wide[:, 0], wide[:, 1]]), return_index=True, return_inverse=True)
    who = same.reshape(-1)[np.concatenate(who)]
    return np.concatenate(shingle), who, np.concatenate(n).astype(np.int64)[at], wide[at].tobytes()


def _groups(shingle, who, *by):
    """(shingle, who, group offsets) of the shingles that two or more classes share, like sets side by side."""
    order = np.lexsort((who, *(x[who] for x in by), shingle))
    shingle, who = shingle[order], who[order]
    fresh = np.r_[True, (shingle[1:] != shingle[:-1]) | (who[1:] != who[:-1])] if len(who) else np.zeros(0, bool)
    shingle, who = shingle[fresh], who[fresh]
    size = np.diff(np.r_[np.flatnonzero(np.r_[True, shingle[1:] != shingle[:-1]][:len(who)]), len(who)])
    many = np.repeat(size > 1, size)
    return shingle[many], who[many], np.r_[0, np.cumsum(size[size > 1])]


def by_members(entries: DataFrame, buckets: int) -> DataFrame:
    """Entries under a key of their shingle's members in place of the shingle.

    Near copies share nearly all their prefix, so most shingles have the same
    members as another; these become one group, and go to one bucket.  Two
    groups under one key would be compared as one: nothing is lost.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, who, n, names = _bucket(list(batches))
        _, who, first = _groups(shingle, who, n)
        if not len(who):
            return
        name = np.frombuffer(names, np.uint64).reshape(-1, 2)
        key = np.add.reduceat(mix64(name[:, 0] ^ mix64(name[:, 1]))[who], first[:-1])
        key, at = np.unique(key, return_index=True)
        size = np.diff(first)[at]
        who = who[np.repeat(first[at] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(size.sum())]
        yield from _flat_rows(np.repeat(key, size), who, n.astype(np.int32), name, buckets)

    return entries.groupBy("bucket").applyInArrow(run, ENTRIES)


SHARED = "bucket int, name binary, shingle binary, who binary, n binary, digest binary"


def shared_entries(entries: DataFrame) -> DataFrame:
    """Of each bucket the entries whose shingle two or more classes share, as flat arrays in one row.

    Rows with a name are the classes of these entries.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        bucket = held[0].column("bucket")[0].as_py()
        shingle, who, n, names = _bucket(held)
        shingle, who, _ = _groups(shingle, who, n)
        if not len(who):
            return
        used, local = np.unique(who, return_inverse=True)
        named = [names[16 * j:16 * j + 16] for j in used.tolist()]

        def rows(name, flat=None):
            flat = flat or {c: pa.nulls(len(name), pa.binary()) for c in ("shingle", "who", "n", "digest")}
            return pa.record_batch({"bucket": pa.array([bucket] * len(name), pa.int32()), "name": pa.array(name, pa.binary()), **flat})

        for i in range(0, len(named), 50_000):
            yield rows(named[i:i + 50_000])
        yield rows([None], {c: pa.array([v], pa.binary()) for c, v in (
            ("shingle", shingle.tobytes()), ("who", local.astype(np.int32).tobytes()),
            ("n", n[used].astype(np.int32).tobytes()), ("digest", b"".join(named)))})

    return entries.groupBy("bucket").applyInArrow(run, SHARED)


class Bitmaps:
    """Bitmaps of several widths, compared at the narrower one of a pair."""

    def __init__(self, maps: list[bytes]):
        self.words = np.array([len(m) // 8 for m in maps], np.int64)
        self.place, self.of = np.zeros(len(maps), np.int64), {}
        for w in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == w)
            self.place[at] = np.arange(len(at))
            self.of[w] = np.frombuffer(b"".join(maps[i] for i in at.tolist()), np.uint64).reshape(-1, w)

    def at(self, x: np.ndarray, wide: int, narrow: int) -> np.ndarray:
        """The bitmaps of members x, all ``wide`` words long, folded to ``narrow`` words."""
        found = self.of[wide][self.place[x]]
        return found if wide == narrow else np.bitwise_or.reduce(found.reshape(len(x), wide // narrow, narrow), axis=1)

    def folded(self, narrow: int) -> np.ndarray:
        out = np.zeros((len(self.words), narrow), np.uint64)
        for w in self.of:
            at = np.flatnonzero(self.words == w)
            out[at] = self.at(at, w, narrow)
        return out

    def may_link(self, x, y, n, num: int, den: int) -> np.ndarray:
        ok = (n[x] * den >= n[y] * num) & (n[y] * den >= n[x] * num)
        both = np.flatnonzero(ok)
        kind = self.words[x[both]] * (1 << 32) + self.words[y[both]]
        for k in np.unique(kind).tolist():
            wx, wy = k >> 32, k & 0xFFFFFFFF
            at = both[kind == k]
            step = max(1, MATRIX // (32 * max(wx, wy)))
            for i in range(0, len(at), step):
                part = at[i:i + step]
                p, q = x[part], y[part]
                most = most_overlap(self.at(p, wx, min(wx, wy)), self.at(q, wy, min(wx, wy)), n[p], n[q])
                ok[part] = reaches(most, n[p], n[q], num, den)
        return ok


def near_classes(entries: DataFrame, known: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b): each class of a bucket that its signature trees can't keep apart from another, and the first such one.

    ``known`` (place, digest, fine; place is a bucket) has the classes'
    bitmaps.  Each shingle's classes are compared with one of them first, so a
    group of near copies hangs together before its trees are traversed.
    """

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        none = pa.table({"a": pa.array([], pa.binary()), "b": pa.array([], pa.binary())})
        if left.num_rows == 0 or right.num_rows == 0:
            return none
        shingle, who, n, names = _bucket(left.to_batches())
        place = {names[16 * j:16 * j + 16]: j for j in range(len(n))}
        fine: list = [None] * len(n)
        for d, bits in zip(right.column("digest").to_pylist(), right.column("fine").to_pylist(), strict=True):
            if d in place:
                fine[place[d]] = bits
        there = np.array([f is not None for f in fine], bool)
        keep = there[who]
        maps = Bitmaps([f or bytes(8 * SIG_WORDS) for f in fine])
        del fine
        sig = maps.folded(SIG_WORDS)
        shingle, who, first = _groups(shingle[keep], who[keep], popcount(sig), n)
        if not len(who):
            return none
        joined = Joined(len(n))
        # each shingle has a centre of its own, so the stars of a group of near copies overlap
        lot = mix64(shingle ^ np.frombuffer(names, np.uint64)[::2][who])
        least = np.flatnonzero(lot == np.repeat(np.minimum.reduceat(lot, first[:-1]), np.diff(first)))
        centre = who[np.repeat(least[np.searchsorted(least, first[:-1])], np.diff(first))]
        ok = maps.may_link(centre, who, n, num, den)
        joined.join(centre[ok], who[ok])
        forest = Forest(first, n[who], sig[who], joined.root[who])
        held: list = []

        def settle():
            x, y = (np.concatenate(v) for v in zip(*held, strict=True))
            ok = joined.open(x, y)
            x, y = x[ok], y[ok]
            ok = maps.may_link(x, y, n, num, den)
            joined.join(x[ok], y[ok])
            held.clear()

        for x, y in forest.pairs(num, den):
            x, y = who[x], who[y]
            ok = joined.open(x, y)
            held.append((x[ok], y[ok]))
            if sum(len(v) for v, _ in held) > PORTION:
                settle()
        if held:
            settle()
        one = np.flatnonzero(joined.root != np.arange(len(n)))
        return pa.table({"a": pa.array([names[16 * j:16 * j + 16] for j in joined.root[one].tolist()], pa.binary()),
                         "b": pa.array([names[16 * j:16 * j + 16] for j in one.tolist()], pa.binary())})

    return (entries.groupBy("bucket").cogroup(known.groupBy("place"))
            .applyInArrow(run, "a binary, b binary").distinct())


def tree_pairs(n: np.ndarray, bits: np.ndarray, joined: Joined, num: int, den: int):
    """Pairs of a group's members that pass a signature tree over all of them."""
    sig = np.bitwise_or.reduce(bits.reshape(len(n), -1, SIG_WORDS), axis=1)
    order = np.lexsort((n, popcount(sig), joined.root))
    forest = Forest(np.array([0, len(n)]), n[order], sig[order], joined.root[order])
    for x, y in forest.pairs(num, den):
        yield order[x], order[y]


def fine_bitmap(u: np.ndarray) -> bytes:
    """Token bitmap of a set, four to eight bits a token, a power of two wide, 1024 bits at least."""
    return bitmap(u, 1 << max(10, int(4 * len(u) - 1).bit_length())).tobytes()


def linked_rows(docs: DataFrame, k: int, num: int, den: int, buckets: int | None = None,
                limit: int = LIMIT) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): rows (doc_id, key, n, digest) of ``docs`` and (digest, low, root) of its classes.

    key is the 64-bit hash of the text, digest is null for an empty set, low is
    the class's smallest doc_id, root the same for all classes of a component.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    docs = docs.withColumn("key", F.xxhash64("text"))
    profiled = materialize(profile(docs, k), "shingle-profile")
    hot = hot_shingles(profiled)
    thin = profiled.where("shingle IS NULL").select("doc_id", "key", "n", "digest")
    classes = thin.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("low"), F.coalesce(F.min_by("key", "doc_id"), F.min("key")).alias("rep"), F.max("n").alias("n"))
    if not buckets:   # a bucket is held by one task at a time: their number grows with the prefix entries
        total = thin.agg(F.sum((F.col("n") * (den - num) / den + 1).cast("bigint"))).first()[0] or 0
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_ENTRIES)
    shared = materialize(shared_entries(by_members(prefix_blocks(docs.drop("key"), k, num, den, hot, buckets), buckets)), "shared-entries")
    entries = shared.where("name IS NULL").drop("name")
    there = shared.where("name IS NOT NULL").select(F.col("bucket").alias("place"), F.col("name").alias("digest"))
    ids = materialize(classes.join(there.select("digest").distinct(), "digest"), "jaccard-ids")

    def sets(column):
        return (u for u, _ in shingle_sets(column, k))

    bitmaps = materialize(encoded(rows_of(docs, ids), sets, _digest, "fine binary", lambda u: {"fine": fine_bitmap(u)}),
                          "jaccard-bitmaps")
    near = materialize(near_classes(entries, there.join(bitmaps, "digest"), num, den), "near-classes")
    links = linked_classes(near, ids, docs, sets, _digest, num, den, tree_pairs, limit)
    named = materialize(classes.select("digest", "low").join(components(links).withColumnRenamed("node", "digest"), "digest", "left")
                        .select("digest", "low", F.coalesce("root", "digest").alias("root")), "linked-classes")
    discard(shared, ids, bitmaps, near, links)
    return thin, named


def jaccard_components(docs: DataFrame, k: int = 5, threshold: Fraction = Fraction(8, 10),
                       buckets: int | None = None, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_shingles, component_id) per row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id reachable by links, itself included.
    Rows with equal sets are one class.  Null and empty texts have n_shingles 0
    and are linked with nothing; texts with fewer than k words have one shingle,
    the whole sequence.  Very long texts are one set like any other.  Repeated
    rows are all returned.  A row with a null doc_id links like any other; it gets
    the smallest id of its component, null if no row there has one.  Other
    columns are ignored; an empty table gives an empty result.  ``limit`` is the
    number of shingles beyond which a group of near classes is cut into blocks.
    """
    rows, classes = linked_rows(docs, k, threshold.numerator, threshold.denominator, buckets, limit)
    low = classes.groupBy("root").agg(F.min("low").alias("component_id"))
    named = classes.join(low, "root").select("digest", "component_id")
    return rows.join(named, "digest", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, k: int = 5, threshold: Fraction = Fraction(8, 10)) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) without their near duplicates.

    Of each component the row of the smallest doc_id stays, null ids last, and of
    one id's texts that of the smallest 64-bit hash.  A row is known by its id and text, so
    different texts under one id are judged one by one, and rows without
    an id by their texts; of rows equal in both one stays.  Null and empty texts
    are linked with nothing.  All columns are kept.
    """
    rows, classes = linked_rows(docs, k, threshold.numerator, threshold.denominator)
    found = rows.join(classes.select("digest", "root"), "digest", "left")
    name = F.struct(F.col("doc_id").isNull().alias("_none"), F.coalesce("doc_id", F.lit(0)).alias("_id"), F.col("key").alias("_key"))
    best = (found.where("root IS NOT NULL").groupBy("root").agg(F.min(name).alias("row")).select("row.*")
            .union(found.where("root IS NULL").select(name.alias("row")).select("row.*").distinct()))
    named = docs.withColumns({"_none": F.col("doc_id").isNull(), "_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)),
                              "_key": F.xxhash64(F.col("text").cast("string"))})
    return named.join(best, ["_none", "_id", "_key"], "left_semi").dropDuplicates(["_none", "_id", "_key"]).select(*docs.columns)
