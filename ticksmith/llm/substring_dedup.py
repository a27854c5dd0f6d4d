"""Substring dedup over word windows by super-k-mer partitioning (dealt operator 6).

A window is ``size`` consecutive words of one document.  Its minimiser is the
smallest hash among its GRAM-word grams, where grams that are frequent in the
corpus sort last.  Consecutive windows with one minimiser form a super-k-mer,
which travels as one packed string to the minimiser's bucket: equal windows
have equal minimisers, so all their occurrences meet there.  In a bucket the
windows are sorted by hash, runs of equal hashes are compared byte by byte,
and windows that start at two or more places are reported back as word ranges
of their rows.

A super-k-mer that stands at two places has repeated windows only, so it needs no
comparison: a task sends a string that it has twice once and without its places,
whose word ranges travel by themselves, spread over all buckets.  A bucket holds
a string once, and its place only until the string comes again; then both
places leave.  So what a bucket holds is its distinct strings, whatever number
of rows hold them: a passage that a third of the rows hold costs each task
one string and its bucket one.  Packed strings are zstandard-compressed per task
and bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.llm.arrays import (blocks, gram_hashes, mix64, release, sliding_min, space_table,
                                  text_bytes, word_hashes, words)
from ticksmith.plans.storage import materialize

WINDOW = 35
GRAM = 8
HOT_LIST = 50_000
HOT_LEAST = 8
FLUSH_BYTES = 16 << 20
FLUSH_GRAMS = 1_000_000
FLUSH_PLACES = 100_000
BUCKET_WORDS = 400_000      # words of the corpus for each bucket, about
FAR = np.uint64(1 << 63)


def _blocks(column):
    """(first row, bytes, word starts, ends, word ranges of rows, word hashes) of each block."""
    raw, off = text_bytes(column)
    table = space_table()
    for a, b in blocks(off):
        part = raw[off[a]:off[b]]
        start, end, first = words(part, off[a:b + 1] - off[a], table)
        yield a, part, start, end, first, word_hashes(part, start, end)


def frequent_grams(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(grams that are most frequent in the corpus, at most HOT_LIST; number of its words).

    Every task counts all its grams and sends those it has HOT_LEAST times;
    the list only steers which bucket a window goes to.
    """

    def run(batches):
        held, total, n_words = [], 0, 0

        def counted():
            gram, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= HOT_LEAST
            return pa.record_batch({"gram": pa.array(gram[keep].view(np.int64)), "n": pa.array(n[keep].astype(np.int64))})

        for batch in batches:
            for _, _, _, _, _, h in _blocks(batch.column("text")):
                held.append(gram_hashes(h, GRAM) >> np.uint64(1))
                total += len(h)
                n_words += len(h)
                if total > FLUSH_GRAMS:
                    yield counted()
                    held, total = [], 0
        if held:
            yield counted()
        # the row without a gram has the words of the task
        yield pa.record_batch({"gram": pa.nulls(1, pa.int64()), "n": pa.array([n_words], pa.int64())})

    top = (docs.select("text").mapInArrow(run, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
           .orderBy(F.col("gram").isNotNull(), F.desc("n"), "gram").limit(HOT_LIST + 1).toArrow())
    gram = top["gram"].combine_chunks()
    n_words = int(top["n"][0].as_py()) if len(top) else 0
    return np.sort(gram.drop_null().to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)), n_words


def _joined(part, start, end):
    """(bytes of the words with one space after each, word starts there)."""
    size = end - start
    place = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 0x20, np.uint8)
    shift = np.repeat(place - start, size)
    source = np.arange(len(shift)) - np.repeat(np.cumsum(size) - size - start, size)
    out[source + shift] = part[source]
    return out.tobytes(), place


def _super_kmers(first, h, hot, size):
    """(row, first window, windows, minimiser) of all super-k-mers of a block."""
    key = gram_hashes(h, GRAM) >> np.uint64(1)
    if len(hot) and len(key):
        at = np.minimum(np.searchsorted(hot, key), len(hot) - 1)
        key = np.where(hot[at] == key, key | FAR, key)
    least = sliding_min(key, size - GRAM + 1)
    count = np.maximum(np.diff(first) - size + 1, 0)   # windows of each row
    row = np.repeat(np.arange(len(count)), count)
    place = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    if not len(row):
        return row, place, count[:0], least[:0]
    mine = least[place]
    cut = np.flatnonzero(np.r_[True, (row[1:] != row[:-1]) | (mine[1:] != mine[:-1])])
    return row[cut], place[cut], np.diff(np.r_[cut, len(row)]), mine[cut]


PACKED = "bucket int, strings binary, places binary, doc_id binary, row_key binary"


def pack(docs: DataFrame, hot: np.ndarray, size: int, buckets: int) -> DataFrame:
    """Super-k-mers of ``docs`` (doc_id, row_key, text), one row per task and bucket.

    ``places`` has (string number, row, first, last) of the strings that the task has
    once.  A row without strings has the word ranges of those that it has more often.
    """
    held_hot = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches):
        hot, squeeze = held_hot.value, zstandard.ZstdCompressor(level=3)
        # bucket -> ({string: number}, [string number, row, first word, last word] flat)
        held: dict[int, tuple[dict, list]] = {}
        ids, keys, load = [], [], 0

        def emit():
            doc, key, again = np.array(ids, np.int64), np.array(keys, np.int64), []

            def packed(bucket, strings, at):
                used, row = np.unique(at[:, 1], return_inverse=True)
                at = np.stack([at[:, 0], row, at[:, 2], at[:, 3]]).astype(np.int32)
                return pa.record_batch({
                    "bucket": pa.array([bucket], pa.int32()),
                    "strings": pa.array([strings and squeeze.compress(b"\n".join(strings))], pa.binary()),
                    "places": pa.array([squeeze.compress(at.tobytes())], pa.binary()),
                    "doc_id": pa.array([doc[used].tobytes()], pa.binary()),
                    "row_key": pa.array([key[used].tobytes()], pa.binary())})

            for bucket, (strings, places) in held.items():
                at = np.array(places, np.int64).reshape(-1, 4)
                once = np.bincount(at[:, 0])[at[:, 0]] == 1
                yield packed(bucket, strings, at[once])
                again.append(at[~once])
            again = np.concatenate(again) if again else np.zeros((0, 4), np.int64)
            # any bucket may pass these on: the rows' keys spread them
            for a in range(0, len(again), FLUSH_PLACES):
                part = again[a:a + FLUSH_PLACES]
                yield packed(int(key[part[0, 1]]) % buckets, None, part)

        for batch in batches:
            doc = batch.column("doc_id").fill_null(0).to_numpy(zero_copy_only=False)
            key = batch.column("row_key").to_numpy(zero_copy_only=False)
            for a, part, start, end, first, h in _blocks(batch.column("text")):
                row, place, count, mine = _super_kmers(first, h, hot, size)
                if not len(row):
                    continue
                data, at = _joined(part, start, end)
                stop = place + count + size - 2
                to = (mix64(mine) % np.uint64(buckets)).astype(np.int64).tolist()
                base = len(ids)
                own, local = np.unique(row, return_inverse=True)
                ids += doc[a + own].tolist()
                keys += key[a + own].tolist()
                low, high = at[place].tolist(), (at[stop] + end[stop] - start[stop]).tolist()
                begin, final = (place - first[row]).tolist(), (stop - first[row]).tolist()
                for b, i, j, r, p, q in zip(to, low, high, (local + base).tolist(), begin, final, strict=True):
                    here = held.get(b)
                    if here is None:
                        here = held[b] = ({}, [])
                    s = data[i:j]
                    n = here[0].get(s)
                    if n is None:
                        n = here[0][s] = len(here[0])
                        load += j - i
                    here[1].extend((n, r, p, q))
                load += 16 * len(to)
                if load > FLUSH_BYTES:
                    yield from emit()
                    held, ids, keys, load = {}, [], [], 0
        yield from emit()
        held, ids, keys = {}, [], []
        release()

    return docs.mapInArrow(run, PACKED)


def _repeats(strings: list[bytes], weight: np.ndarray, size: int):
    """(string number of each window, windows before each string, window is repeated)."""
    data = np.frombuffer(b"\n".join(strings), np.uint8)
    length = np.array([len(s) for s in strings], np.int64)
    off = np.r_[0, np.cumsum(length + 1)]
    off[-1] -= 1
    # hashing takes many times the bytes of a block, so the bucket is hashed in blocks
    table, each = space_table(), []
    for a, b in blocks(off):
        part = data[off[a]:off[b]]
        s, e, f = words(part, off[a:b + 1] - off[a], table)
        each.append((s + off[a], e + off[a], np.diff(f), word_hashes(part, s, e)))
    start, end, count, hashes = (np.concatenate(x) for x in zip(*each, strict=True))
    first = np.r_[0, np.cumsum(count)]
    grams = gram_hashes(hashes, size)
    del each, hashes
    count = count - size + 1
    before = np.r_[0, np.cumsum(count)]
    own = np.repeat(np.arange(len(strings)), count)
    place = first[own] + np.arange(len(own)) - before[own]
    order = np.argsort(grams[place], kind="stable")
    sorted_hash = grams[place][order]
    head = np.r_[True, sorted_hash[1:] != sorted_hash[:-1]]
    group = np.cumsum(head) - 1
    total = np.bincount(group, weights=weight[own[order]])
    again = np.zeros(len(own), bool)
    again[order] = total[group] >= 2
    # equal hashes of different places: compare the bytes themselves
    follow = np.flatnonzero(~head)
    if len(follow):
        raw = data.tobytes()
        low, high = start[place], end[place + size - 1]
        x, y = order[follow - 1], order[follow]
        bad = [g for g, a, b, c, d in zip(group[follow].tolist(), low[x].tolist(), high[x].tolist(),
                                          low[y].tolist(), high[y].tolist(), strict=True) if raw[a:b] != raw[c:d]]
        for g in set(bad):
            members = order[np.flatnonzero(group == g)]
            sums: dict[bytes, float] = {}
            for m in members:
                s = raw[low[m]:high[m]]
                sums[s] = sums.get(s, 0) + weight[own[m]]
            for m in members:
                again[m] = sums[raw[low[m]:high[m]]] >= 2
    return own, before, again


CUTS = "doc_id bigint, row_key bigint, first int, last int"


def repeated_ranges(packed: DataFrame, size: int) -> DataFrame:
    """(doc_id, row_key, first, last): word ranges covered by windows that start at two or more places."""

    def cuts(doc, key, low, high):
        return pa.record_batch({"doc_id": pa.array(doc, pa.int64()), "row_key": pa.array(key, pa.int64()),
                                "first": pa.array(low, pa.int32()), "last": pa.array(high, pa.int32())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        number: dict[bytes, int] = {}
        alone: dict[int, tuple[int, int, int, int]] = {}   # string seen at one place -> that place
        for batch in batches:
            for i in range(batch.num_rows):
                at = np.frombuffer(open_.decompress(batch.column("places")[i].as_py()), np.int32).reshape(4, -1)
                doc = np.frombuffer(batch.column("doc_id")[i].as_py(), np.int64)[at[1]]
                key = np.frombuffer(batch.column("row_key")[i].as_py(), np.int64)[at[1]]
                packed_strings = batch.column("strings")[i].as_py()
                if packed_strings is None:
                    yield cuts(doc, key, at[2], at[3])
                    continue
                places = dict(zip(at[0].tolist(), zip(doc.tolist(), key.tolist(), at[2].tolist(), at[3].tolist(), strict=True),
                                  strict=True))
                out = []
                for local, s in enumerate(open_.decompress(packed_strings).split(b"\n")):
                    fresh, here = len(number), places.get(local)
                    n = number.setdefault(s, fresh)
                    if n == fresh:
                        if here is not None:
                            alone[n] = here
                        continue
                    out += [p for p in (alone.pop(n, None), here) if p is not None]
                if out:
                    yield cuts(*zip(*out, strict=True))
        release()
        if not alone:
            return
        # strings seen at one place: which of their windows stand in other strings
        strings = list(number)
        del number
        weight = np.full(len(strings), 2.0)
        weight[list(alone)] = 1.0
        own, before, again = _repeats(strings, weight, size)
        again &= weight[own] == 1
        edge = np.flatnonzero(np.r_[True, (own[1:] != own[:-1]) | (again[1:] != again[:-1])])
        long = np.diff(np.r_[edge, len(own)])
        edge, long = edge[again[edge]], long[again[edge]]
        for a in range(0, len(edge), FLUSH_PLACES):
            e, of = edge[a:a + FLUSH_PLACES], own[edge[a:a + FLUSH_PLACES]]
            doc, key, begin, _ = np.array([alone[n] for n in of.tolist()], np.int64).T
            low = begin + e - before[of]
            yield cuts(doc, key, low, low + long[a:a + FLUSH_PLACES] + size - 2)

    return packed.groupBy("bucket").applyInArrow(run, CUTS)


def dedup_substrings(docs: DataFrame, size: int = WINDOW, buckets: int | None = None,
                     with_text: bool = False) -> DataFrame:
    """(row, n_words, n_removed, kept_sha256[, kept_text]) per row of ``docs`` (doc_id, text).

    A word is removed if a window that covers it starts at a second place
    anywhere in the table, judged on the input.  ``kept_sha256`` is of the kept
    words joined by one space; ``kept_text`` is the text itself without the
    removed words and the white space after each.  ``row`` is the whole input
    row as a struct.  Null and empty texts have no words (their kept_text is
    empty); texts shorter than a window keep all; repeated rows are
    occurrences like any other and are all returned; a very long text is
    hashed whole, as a block of its own, and its windows travel like any other's.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.col("text").cast("string").alias("text")).withColumn("row_key", F.xxhash64("doc_id", "text"))
    hot, total = frequent_grams(rows)
    # a bucket is held by one task at a time: their number grows with the corpus
    buckets = buckets or max(2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), total // BUCKET_WORDS)
    cuts = repeated_ranges(pack(rows.select("doc_id", "row_key", "text"), hot, size, buckets), size)
    ranges = materialize(cuts.groupBy("doc_id", "row_key").agg(F.collect_set(F.struct("first", "last")).alias("cuts")),
                         "repeated-ranges")
    both = (rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(0).cast("bigint")))
            .join(ranges.hint("shuffle_hash"), ["doc_id", "row_key"], "left").select("row", "text", "cuts"))

    def finish(batches):
        for batch in batches:
            cuts = batch.column("cuts").to_pylist()
            n, gone, digest, kept_text = [], [], [], []
            for a, part, start, end, first, _ in _plain(batch.column("text")):
                data = part.tobytes()
                for i in range(len(first) - 1):
                    f, g = int(first[i]), int(first[i + 1])
                    keep = np.ones(g - f, bool)
                    for c in cuts[a + i] or ():
                        keep[c["first"]:c["last"] + 1] = False
                    s, e = start[f:g], end[f:g]
                    n.append(g - f)
                    gone.append(int((~keep).sum()))
                    digest.append(hashlib.sha256(b" ".join([data[x:y] for x, y in zip(s[keep].tolist(), e[keep].tolist(), strict=True)])).hexdigest())
                    if with_text:
                        kept_text.append(_without(batch.column("text")[a + i], s, keep, int(s[0]) if g > f else 0))
            out = {"row": batch.column("row"), "n_words": pa.array(n, pa.int64()), "n_removed": pa.array(gone, pa.int64()),
                   "kept_sha256": pa.array(digest, pa.string())}
            if with_text:
                out["kept_text"] = pa.array(kept_text, pa.string())
            yield pa.record_batch(out)

    schema = T.StructType([rows.schema["row"]]).add("n_words", "long").add("n_removed", "long").add("kept_sha256", "string")
    return both.mapInArrow(finish, schema.add("kept_text", "string") if with_text else schema)


def _plain(column):
    """Like ``_blocks``, without hashes."""
    raw, off = text_bytes(column)
    table = space_table()
    for a, b in blocks(off):
        part = raw[off[a]:off[b]]
        start, end, first = words(part, off[a:b + 1] - off[a], table)
        yield a, part, start, end, first, None


def _without(text, start: np.ndarray, keep: np.ndarray, lead: int) -> str:
    """The text without the words not kept, each with the white space up to the next word."""
    whole = text.as_py() or ""
    if keep.all():
        return whole
    data = whole.encode()
    # word starts are offsets in the block: the first word's place in its own text anchors them
    own = len(data) - len(data.lstrip(b" \t\n\x0b\x0c\r"))
    at = (start - lead + own).tolist() + [len(data)]
    pieces = [data[at[i]:at[i + 1]] for i in np.flatnonzero(keep).tolist()]
    return (data[:own] + b"".join(pieces)).decode() if pieces else ""
