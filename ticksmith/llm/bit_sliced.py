"""Ranked lexical search with bit-sliced Bloom signatures (dealt operator 13).

A document's signature holds its terms, and for each count in ``LEVELS`` the
terms that occur so often.  A task turns a block of documents into slices, one
bitmap over the block's documents for each signature bit.  For a query term the
AND of its slices says which documents may hold it (so often); weighted sums of
these bitmaps bound every document's score from above.  Documents are then
scored exactly in order of their bounds, until the next bound is below the
query's least score that still counts; whatever isn't rescored is provably
outside the answer.  Documents of a block are sorted by their number of terms, so the
width of a block's signatures fits its documents.

Passes: ``term_table`` counts documents, terms and document frequencies of the
query terms (map-side sums, no shuffle of terms of the corpus); ``search`` makes
one pass over the documents for each block of queries, and only the best
``top`` of each task and query are shuffled.  Queries are taken in blocks of
``QUERY_TERMS`` terms, so what the driver and the broadcast hold is bounded.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.llm.arrays import alnum_table, blocks, lower_ascii, mix64, release, text_bytes, word_hashes, words
from ticksmith.plans.storage import materialize

LEVELS = (1, 2, 3, 5, 9)      # counts of a term that a signature tells apart
HASHES = 3                    # bits of a signature for a term and level
BITS = 8                      # bits of a signature for each of its entries
DOCS = 1 << 11                # documents of a block
BLOCK_TERMS = 1 << 19         # distinct terms of a block's documents, about
QUERY_TERMS = 200_000         # of a block of queries: a few MB broadcast

SCALE = 1_000_000_000


def term_table() -> np.ndarray:
    """True for bytes of terms ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` once A-Z are lower-cased."""
    return alnum_table()


def term_counts(column):
    """(terms, counts, n) of each row: distinct term hashes ascending, how often each occurs, all occurrences."""
    raw, off = text_bytes(column)
    table = term_table()
    for a, b in blocks(off):
        part = lower_ascii(raw[off[a]:off[b]])
        start, end, first = words(part, off[a:b + 1] - off[a], table)
        h = word_hashes(part, start, end)
        for i in range(b - a):
            own = h[first[i]:first[i + 1]]
            u, c = np.unique(own, return_counts=True)
            yield u, c.astype(np.int64), len(own)


def norm(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents of n terms: 75 + 25 n N div L."""
    return 75 + (25 * n * documents) // terms


def share(tf, m):
    """What a term of weight 1 adds to the score of a document."""
    return (SCALE * tf) // (1000 * tf + 12 * m)


def query_terms(items: DataFrame) -> DataFrame:
    """(item_id, term, times) of the distinct rows (item_id, text); term is a 64-bit hash."""

    def run(batches):
        for batch in batches:
            own, term, times = [], [], []
            for i, (u, c, _) in enumerate(term_counts(batch.column("text"))):
                own.append(np.full(len(u), i))
                term.append(u)
                times.append(c)
            at = np.concatenate(own) if own else np.zeros(0, np.int64)
            yield pa.record_batch({"item_id": batch.column("item_id").take(pa.array(at.astype(np.int64))),
                                   "term": pa.array(np.concatenate(term).view(np.int64) if term else np.zeros(0, np.int64)),
                                   "times": pa.array(np.concatenate(times) if times else np.zeros(0, np.int64))})

    found = items.select("item_id", "text").distinct().mapInArrow(run, f"item_id {dict(items.dtypes)['item_id']}, term bigint, times bigint")
    return found.groupBy("item_id", "term").agg(F.sum("times").alias("times"))


def corpus_counts(docs: DataFrame, wanted: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(N, L, document frequency of each wanted term) in one pass."""
    held = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches):
        wanted, n, total = held.value, 0, 0
        df = np.zeros(len(wanted) + 1, np.int64)
        for batch in batches:
            for u, _, length in term_counts(batch.column("text")):
                n += length > 0
                total += length
                at = np.searchsorted(wanted, u)
                at[at == len(wanted)] = 0
                df[at[wanted[at] == u] if len(wanted) else []] += 1
        some = np.flatnonzero(df)
        yield pa.record_batch({"place": pa.array(np.r_[-2, -1, some].astype(np.int64)),
                               "count": pa.array(np.r_[n, total, df[some]].astype(np.int64))})
        release()

    counted = docs.select("text").mapInArrow(run, "place bigint, count bigint").groupBy("place").agg(F.sum("count").alias("count")).toArrow()
    df, both = np.zeros(len(wanted), np.int64), {-2: 0, -1: 0}
    for place, count in zip(counted["place"].to_pylist(), counted["count"].to_pylist(), strict=True):
        if place < 0:
            both[place] = count
        else:
            df[place] = count
    return both[-2], both[-1], df


def weight(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


class Slices:
    """Bit slices of a block: bit b of slice s says that document b's signature has bit s."""

    def __init__(self, docs: list[tuple[np.ndarray, np.ndarray]]):
        entries = [np.concatenate([self.name(u[c >= t], j) for j, t in enumerate(LEVELS)]) for u, c in docs]
        self.n = len(docs)
        self.width = 1 << max(6, int(BITS * max(map(len, entries), default=1)).bit_length())
        grid = np.zeros((self.width, -(-self.n // 64) * 64), np.uint8)
        for i, e in enumerate(entries):
            for bit in self.bits(e):
                grid[bit, i] = 1
        self.rows = np.packbits(grid, axis=1, bitorder="little").view(np.uint64)

    @staticmethod
    def name(terms: np.ndarray, level: int) -> np.ndarray:
        return mix64(terms + mix64(np.array([level + 1], np.uint64)))

    def bits(self, entries: np.ndarray):
        for j in range(HASHES):
            yield ((entries >> np.uint64(20 * j)) & np.uint64(self.width - 1)).astype(np.int64)

    def may_hold(self, terms: np.ndarray, level: int) -> np.ndarray:
        """A row for each term: 1 for documents that may hold it LEVELS[level] times, none that does left out."""
        found = None
        for bit in self.bits(self.name(terms, level)):
            found = self.rows[bit] if found is None else found & self.rows[bit]
        return np.unpackbits(found.view(np.uint8), axis=1, bitorder="little")[:, :self.n]


class Best:
    """The best documents of each query that a task has seen: least score that counts, and rows."""

    def __init__(self, queries: int, top: int):
        self.top, self.rows = top, [[] for _ in range(queries)]

    def least(self, q: int) -> int:
        rows = self.rows[q]
        return rows[-1][0] if len(rows) >= self.top else 1

    def offer(self, q: int, found: list) -> None:
        """Adds (score, doc_id) rows; equal scores go by ascending doc_id, null ids last."""
        rows = sorted(self.rows[q] + found, key=lambda r: (-r[0], r[1] is None, r[1] or 0))
        self.rows[q] = rows[:self.top]


def total_weight(w: np.ndarray, there: np.ndarray) -> np.ndarray:
    """Weights summed over the terms that each document may hold; below 2^53, so exact in doubles."""
    return (w.astype(np.float64) @ there.astype(np.float64)).astype(np.int64)


def rank_block(docs, ids, n, best: Best, queries, terms, weights, documents: int, total: int) -> int:
    """Offers a block's documents to ``best``; returns how many were scored exactly.

    ``docs`` holds (terms, counts); ``queries`` lists (places in ``terms``, times) of each query.
    """
    slices = Slices(docs)
    m = norm(n, documents, total)
    scored = 0
    # share that a term may have at most in each document, by the highest level that it may reach
    caps = [share(t - 1, m) for t in LEVELS[1:]] + [SCALE // 1000 + 0 * m]
    for q, (places, times) in enumerate(queries):
        w, asked = weights[places] * times, terms[places]
        there = slices.may_hold(asked, 0)
        sums = total_weight(w, there)
        may = np.flatnonzero(caps[-1] * sums >= best.least(q))   # the others are out at any count of their terms
        if not len(may):
            continue
        bound = np.zeros(len(docs), np.int64)
        bound[may] = caps[0][may] * sums[may]
        there = there[:, may]
        for j in range(1, len(LEVELS)):
            there = there & slices.may_hold(asked, j)[:, may]
            if not there.any():
                break
            bound[may] += (caps[j] - caps[j - 1])[may] * total_weight(w, there)
        order = may[np.argsort(-bound[may], kind="stable")]
        at = 0
        while at < len(order) and bound[order[at]] >= best.least(q):
            found = []
            for i in order[at:at + best.top].tolist():
                if bound[i] < best.least(q):
                    break
                u, c = docs[i]
                spot = np.searchsorted(u, asked)
                spot[spot == len(u)] = 0
                tf = np.where(u[spot] == asked, c[spot], 0)
                score = int((w * share(tf, m[i])).sum())
                scored += 1
                if score > 0:
                    found.append((score, ids[i]))
            best.offer(q, found)
            at += best.top
    return scored


def search(docs: DataFrame, items: DataFrame, top: int = 20, query_terms_held: int = QUERY_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's ``top`` best documents with a score above 0.

    Null and empty texts hold no term; very long ones are documents like any other.  Every row of ``docs`` is a
    document, also repeated ones; of equal scores the smaller doc_id goes first, a
    null one last.  Equal rows of ``items`` are one; different texts of one item_id
    (null is one too) are one query.  Other columns are ignored; an empty table
    on either side gives an empty result.
    """
    spark = docs.sparkSession
    kinds = f"item_id {dict(items.dtypes)['item_id']}, doc_id {dict(docs.dtypes)['doc_id']}, score bigint"
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    asked = materialize(query_terms(items.select("item_id", F.col("text").cast("string").alias("text"))), "query-terms")
    parts = max(1, -(-asked.count() // query_terms_held))
    found = None
    for part in range(parts):   # one block of queries at a time
        table = asked.where(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part).toArrow()
        mine = _search_block(docs, table, top, kinds)
        found = mine if found is None else found.union(mine)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
            .select("item_id", "rank", "doc_id", "score"))


def _search_block(docs: DataFrame, table: pa.Table, top: int, layout: str) -> DataFrame:
    """(item_id, doc_id, score): each task's best documents for the queries of ``table``."""
    items = table["item_id"].to_pylist()
    term = table["term"].to_numpy().astype(np.int64).view(np.uint64)
    terms, place = np.unique(term, return_inverse=True)
    documents, total, df = corpus_counts(docs, terms)
    named = list(dict.fromkeys(items))
    index = {v: i for i, v in enumerate(named)}
    own = np.array([index[v] for v in items], np.int64)
    order = np.argsort(own, kind="stable")
    cuts = np.searchsorted(own[order], np.arange(len(named) + 1))
    times = table["times"].to_numpy()
    queries = [(place[order[a:b]], times[order[a:b]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    held = docs.sparkSession.sparkContext.broadcast((named, queries, terms, weight(documents, df)))

    def run(batches):
        named, queries, terms, weights = held.value
        best, waiting, load = Best(len(queries), top), [], 0

        def rank():
            waiting.sort(key=lambda d: len(d[1][0]))
            begin = 0
            while begin < len(waiting):    # documents of like size share a block
                end, widest = begin + 1, max(8, len(waiting[begin][1][0]))
                while end < len(waiting) and end - begin < DOCS and len(waiting[end][1][0]) <= 2 * widest:
                    end += 1
                part = waiting[begin:end]
                rank_block([d for _, d, _ in part], [i for i, _, _ in part], np.array([n for _, _, n in part], np.int64),
                           best, queries, terms, weights, documents, total)
                begin = end
            waiting.clear()

        doc_type = pa.null()
        for batch in batches if queries and total else ():
            doc_type = batch.schema.field("doc_id").type
            for i, (u, c, n) in zip(batch.column("doc_id").to_pylist(), term_counts(batch.column("text")), strict=True):
                keep = np.isin(u, terms, assume_unique=True)
                if keep.any():       # a document without any query term has no score
                    waiting.append((i, (u[keep], c[keep]), n))
                    load += int(keep.sum())
                if len(waiting) >= 4 * DOCS or load > BLOCK_TERMS:
                    rank()
                    load = 0
        rank()
        rows = [(named[q], d, s) for q, own in enumerate(best.rows) for s, d in own]
        if rows:
            item, doc, score = zip(*rows, strict=True)
            yield pa.record_batch({"item_id": pa.array(item, item_type), "doc_id": pa.array(doc, doc_type), "score": pa.array(score, pa.int64())})
        release()

    item_type = table.schema.field("item_id").type
    return docs.mapInArrow(run, layout)
