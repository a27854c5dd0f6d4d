"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation (dealt operator 10).

The split pattern is run as a finite-state machine over arrays: every code
point gets a symbol from its class and its next neighbours, a symbol is a
transition function on eight states, and functions compose associatively.  A
block of text is cut into columns, every column composes its functions for all
start states at once, the columns' results are chained, and a second sweep
marks where pieces begin.  No regular expression runs on the text.

Pieces are byte slices; each different one goes through pair merging once, all
new ones of a block together, and then comes from a cache bounded by its
number of pieces.  Offsets of pieces and rows are kept, so ids are decoded by
one gather over the vocabulary's bytes; the decoded block must be the text.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.llm.arrays import blocks, text_bytes, word_hashes

CACHE = 400_000          # pieces; a full cache is emptied and filled anew
COLUMN = 256             # code points that one column of the scan steps through
LONG = 64                # bytes; longer pieces merge over a heap
NONE = 1 << 40           # rank of a pair that no token joins
MAX_CODE = 0x110000
# The code points of \s in the split pattern (White_Space).
WHITE = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x1680, 0x2000, 0x2001, 0x2002, 0x2003, 0x2004,
         0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# The endings that the split pattern takes with their apostrophe.
ENDINGS_1 = "stmd"
ENDINGS_2 = ("re", "ve", "ll")

# classes of code points
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
# symbols: blank: white space that goes on a run; lone: the last one before text, not U+0020;
# lead: U+0020 before text; the apostrophe of an ending of one or two letters; edge: between rows
S_OTHER, S_LETTER, S_NUMBER, S_BLANK, S_LONE, S_LEAD, S_END1, S_END2, S_EDGE = range(9)
# states: inside blanks, letters, numbers, others; after a lead; letters still
# to come of an ending (2, 1); after an ending or an edge
Q_BLANK, Q_LETTER, Q_NUMBER, Q_OTHER, Q_LEAD, Q_TWO, Q_ONE, Q_DONE = range(8)


def code_classes() -> np.ndarray:
    """Class of every code point, from its general category."""
    table = np.zeros(MAX_CODE, np.uint8)
    letters = [i for i in range(MAX_CODE) if unicodedata.category(chr(i))[0] == "L"]
    numbers = [i for i in range(MAX_CODE) if unicodedata.category(chr(i))[0] == "N"]
    table[letters], table[numbers], table[WHITE] = LETTER, NUMBER, SPACE
    return table


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """(next state, piece begins) of [symbol, state], flat with 8 states a symbol."""
    to, new = np.zeros((9, 8), np.uint8), np.ones((9, 8), bool)
    for symbol, state in ((S_OTHER, Q_OTHER), (S_LETTER, Q_LETTER), (S_NUMBER, Q_NUMBER), (S_BLANK, Q_BLANK),
                          (S_LONE, Q_BLANK), (S_LEAD, Q_LEAD), (S_END1, Q_ONE), (S_END2, Q_TWO), (S_EDGE, Q_DONE)):
        to[symbol] = state
    for symbol, state in ((S_OTHER, Q_OTHER), (S_LETTER, Q_LETTER), (S_NUMBER, Q_NUMBER)):
        new[symbol, [state, Q_LEAD]] = False
    new[S_BLANK, Q_BLANK] = False
    to[S_LETTER, Q_TWO], to[S_LETTER, Q_ONE] = Q_ONE, Q_DONE
    new[S_LETTER, [Q_TWO, Q_ONE]] = False
    for symbol in (S_END1, S_END2):   # inside a run of others an apostrophe is one of them
        to[symbol, [Q_OTHER, Q_LEAD]] = Q_OTHER
        new[symbol, [Q_OTHER, Q_LEAD]] = False
    return to.ravel(), new.ravel()


def symbols(code: np.ndarray, edge: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbol of every code point; ``edge`` marks the separators between rows."""
    kind = classes[code]
    out = np.array([S_OTHER, S_LETTER, S_NUMBER, S_BLANK], np.uint8)[kind]
    text = np.zeros(len(code), bool)          # the next code point is text
    text[:-1] = (kind[1:] != SPACE) & ~edge[1:]
    last = (kind == SPACE) & text
    out[last] = np.where(code[last] == 0x20, S_LEAD, S_LONE)
    quote = np.flatnonzero((code == 0x27) & ~edge)
    if len(quote):
        padded = np.r_[code, 0, 0]
        one, two = padded[quote + 1], padded[quote + 2]
        short = np.isin(one, [ord(c) for c in ENDINGS_1])
        long = np.zeros(len(quote), bool)
        for a, b in ENDINGS_2:
            long |= (one == ord(a)) & (two == ord(b))
        out[quote[short]] = S_END1
        out[quote[long & ~short]] = S_END2
    out[edge] = S_EDGE
    return out


def piece_starts(symbol: np.ndarray) -> np.ndarray:
    """Positions where pieces begin, by a scan of composed transition functions."""
    to, new = transitions()
    n = len(symbol)
    if n == 0:
        return np.zeros(0, np.int64)
    columns = -(-n // COLUMN)
    grid = np.full(columns * COLUMN, S_EDGE, np.uint8)
    grid[:n] = symbol
    grid = np.ascontiguousarray(grid.reshape(columns, COLUMN).T).astype(np.uint16) * np.uint16(8)
    # each column's function: the state it ends in, for every state it may begin in
    ends = np.repeat(np.arange(8, dtype=np.uint8)[None, :], columns, axis=0)
    for step in grid:
        ends = to[step[:, None] + ends]
    # the state each column really begins in: the composition of those before it
    state, begin = 0, np.zeros(columns, np.uint8)
    for i, f in enumerate(ends.tolist()):
        begin[i] = state
        state = f[state]
    marks = np.empty((COLUMN, columns), bool)
    state = begin
    for i, step in enumerate(grid):
        at = step + state
        marks[i] = new[at]
        state = to[at]
    return np.flatnonzero(marks.T.ravel()[:n])


def spread(table: np.ndarray, place: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The slices ``table[place : place + size]`` one after another."""
    stop = np.cumsum(size)
    if not len(stop) or stop[-1] == 0:
        return table[:0]
    return table[np.arange(stop[-1]) + np.repeat(place - stop + size, size)]


class Pairs:
    """Ranks of id pairs whose joined bytes are a token."""

    def __init__(self, ranks: dict[bytes, int]):
        get, found = ranks.get, {}
        for t, r in ranks.items():
            for i in range(1, len(t)):
                a, b = get(t[:i]), get(t[i:])
                if a is not None and b is not None:
                    found[a << 20 | b] = r
        keys = np.fromiter(found, np.int64, len(found))
        order = np.argsort(keys)
        self.keys = np.r_[keys[order], np.iinfo(np.int64).max]
        self.rank = np.r_[np.fromiter(found.values(), np.int64, len(found))[order], NONE]

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a << 20 | b
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.rank[at], NONE)


def merge_all(ids: np.ndarray, size: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    """(ids, sizes) of many pieces after pair merging.

    Each round merges in every piece the leftmost adjacent pair of lowest
    rank; pieces without a ranked pair are set aside.
    """
    final_size, done = np.zeros(len(size), np.int64), []
    name = np.arange(len(size))
    rank = np.full(len(ids), NONE)
    if len(ids) > 1:
        rank[:-1] = pairs.of(ids[:-1], ids[1:])
        rank[np.cumsum(size) - 1] = NONE
    while len(size):
        head = np.cumsum(size) - size
        own = np.repeat(np.arange(len(size)), size)
        low = np.minimum.reduceat(rank, head)
        over = low == NONE
        if over.any():
            final_size[name[over]] = size[over]
            done.append((name[over], ids[over[own]], size[over]))
            stay = ~over[own]
            ids, rank, size, name, low = ids[stay], rank[stay], size[~over], name[~over], low[~over]
            if not len(size):
                break
            head = np.cumsum(size) - size
            own = np.repeat(np.arange(len(size)), size)
        at = np.flatnonzero(rank == low[own])
        at = at[np.r_[True, own[at][1:] != own[at][:-1]]]      # leftmost of each piece
        ids[at] = low
        stay = np.ones(len(ids), bool)
        stay[at + 1] = False
        ids, rank, size = ids[stay], rank[stay], size - 1
        at = at - np.arange(len(at))                            # one id before each was removed a piece
        head = np.cumsum(size) - size
        last = head + size - 1
        rank[at] = NONE
        inner = at < last
        rank[at[inner]] = pairs.of(ids[at[inner]], ids[at[inner] + 1])
        back = at[at > head] - 1
        rank[back] = pairs.of(ids[back], ids[back + 1])
    out = np.zeros(int(final_size.sum()), np.int64)
    place = np.cumsum(final_size) - final_size
    for name, ids, size in done:
        out[spread(np.arange(len(out)), place[name], size)] = ids
    return out, final_size




def merge_long(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Like ``merge``, with linked parts and a heap: for pieces of any length."""
    import heapq

    n = len(piece)
    end, before, after = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive, heap = [True] * n, []

    def offer(i):
        j = after[i]
        if j < n:
            r = ranks.get(piece[i:end[j]])
            if r is not None:
                heapq.heappush(heap, (r, i, end[i], end[j]))

    for i in range(n - 1):
        offer(i)
    while heap:
        _, i, mid, stop = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if not alive[i] or j >= n or end[i] != mid or end[j] != stop:
            continue
        alive[j], end[i], after[i] = False, stop, after[j]
        if after[i] < n:
            before[after[i]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [ranks[piece[i:end[i]]] for i in range(n) if alive[i]]


class Codec:
    """Encoder and decoder over a rank file's contents (lines of base64 bytes and rank)."""

    def __init__(self, ranks: bytes, classes: np.ndarray | None = None):
        lines = [line.split() for line in ranks.splitlines() if line]
        self.ranks = {base64.b64decode(a): int(b) for a, b in lines}
        top = max(self.ranks.values(), default=-1) + 1
        tokens = [b""] * top
        for t, r in self.ranks.items():
            tokens[r] = t
        self.size, self.place, self.bytes = self._flat(tokens)
        self.digits, self.digit_place, self.digit_bytes = self._flat([b"%d," % i for i in range(top)])
        self.classes = code_classes() if classes is None else classes
        self.single = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int64)
        self.pairs = Pairs(self.ranks)
        self.clear()

    @staticmethod
    def _flat(parts: list[bytes]):
        size = np.array([len(t) for t in parts], np.int64)
        return size, np.cumsum(size) - size, np.frombuffer(b"".join(parts), np.uint8)

    def clear(self):
        """The cache: piece hashes ascending, where their ids are, and all ids."""
        self.known, self.at, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.store = np.zeros(0, np.int32)

    def merged(self, part, start, end) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of the given pieces, by merging."""
        size = end - start
        long = np.flatnonzero(size > LONG)
        whole = np.array([self.ranks.get(part[s:e].tobytes(), -1) for s, e in zip(start.tolist(), end.tolist(), strict=True)], np.int64)
        plain = (whole < 0) & (size <= LONG)
        ids, n = merge_all(self.single[spread(part, start[plain], size[plain])], size[plain], self.pairs)
        if plain.all():
            return ids, n
        count = np.ones(len(size), np.int64)
        count[plain] = n
        heap = {}
        for i in long.tolist():
            if whole[i] < 0:
                heap[i] = merge_long(part[start[i]:end[i]].tobytes(), self.ranks)
                count[i] = len(heap[i])
        out = np.zeros(int(count.sum()), np.int64)
        place = np.cumsum(count) - count
        out[place[whole >= 0]] = whole[whole >= 0]
        out[spread(np.arange(len(out)), place[plain], n)] = ids
        for i, found in heap.items():
            out[place[i]:place[i] + count[i]] = found
        return out, count

    def ids_of(self, part, start, end) -> tuple[np.ndarray, np.ndarray]:
        """(ids, sizes) of all pieces of a block, each different piece looked up or merged once."""
        h = word_hashes(part, start, end)
        u, at, same = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(u) > CACHE:
            self.clear()
        i = np.searchsorted(self.known, u)
        there = np.zeros(len(u), bool)
        if len(self.known):
            there = self.known[np.minimum(i, len(self.known) - 1)] == u
        if not there.all():
            fresh = at[~there]
            ids, n = self.merged(part, start[fresh], end[fresh])
            keys = np.concatenate([self.known, u[~there]])
            place = np.concatenate([self.at, len(self.store) + np.cumsum(n) - n])
            count = np.concatenate([self.count, n])
            order = np.argsort(keys, kind="stable")
            self.known, self.at, self.count = keys[order], place[order], count[order]
            self.store = np.concatenate([self.store, ids.astype(np.int32)])
            i = np.searchsorted(self.known, u)
        i = i[same.reshape(-1)]
        return spread(self.store, self.at[i], self.count[i]), self.count[i]

    def pieces(self, raw: np.ndarray, offsets: np.ndarray):
        """(piece byte offsets, first piece of each row) of a block of rows."""
        lead = (raw & 0xC0) != 0x80                       # bytes that begin a code point
        at = np.flatnonzero(lead)
        first = np.searchsorted(at, offsets)               # code point number of each row's start
        code = np.frombuffer(raw.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
        edge_at = first + np.arange(len(first))            # one separator before each row, one at the end
        total = len(code) + len(first)
        edge = np.zeros(total, bool)
        edge[edge_at] = True
        whole = np.zeros(total, np.uint32)
        whole[~edge] = code
        begin = piece_starts(symbols(whole, edge, self.classes))
        begin = begin[~edge[begin]]
        row = np.searchsorted(edge_at, begin, "right") - 1
        start = at[begin - row - 1]
        return start, np.searchsorted(row, np.arange(len(offsets)))

    def encode(self, column):
        """Per row of a text column: (ids, ids as decimal text joined by commas, the decoded bytes)."""
        raw, off = text_bytes(column)
        for a, b in blocks(off):
            part, o = raw[off[a]:off[b]], off[a:b + 1] - off[a]
            start, first = self.pieces(part, o)
            end = np.r_[start[1:], len(part)][:len(start)]
            ids, n = self.ids_of(part, start, end)
            back = self.decode(ids)
            if back != part.tobytes():     # two pieces of one hash: merge every piece by itself
                ids, n = self.merged(part, start, end)
                back = self.decode(ids)
            text = spread(self.digit_bytes, self.digit_place[ids], self.digits[ids]).tobytes()
            stop = np.r_[0, np.cumsum(n)][first]
            cut = np.r_[0, np.cumsum(self.digits[ids])][stop].tolist()
            byte = np.r_[0, np.cumsum(self.size[ids])][stop].tolist()
            stop = stop.tolist()
            for i in range(b - a):
                yield (ids[stop[i]:stop[i + 1]], text[cut[i]:max(cut[i], cut[i + 1] - 1)], back[byte[i]:byte[i + 1]])

    def decode(self, ids) -> bytes:
        """Bytes of ids, gathered from the vocabulary."""
        ids = np.asarray(ids, np.int64)
        return spread(self.bytes, self.place[ids], self.size[ids]).tobytes()


def encode_documents(docs: DataFrame, vocabulary: str, with_ids: bool = False) -> DataFrame:
    """(row, n_tokens, ids_sha256, decoded_sha256[, ids]) per row of ``docs`` (text).

    ``vocabulary`` is the path of a rank file on the driver; its contents
    (under a megabyte, checked) are broadcast.  ``row`` is the whole input row
    as a struct.  Null and empty texts have no ids; repeated rows are encoded
    alike; decoding gives the text's UTF-8 bytes back.
    """
    with open(vocabulary, "rb") as f:
        data = f.read()
    if len(data) > 64 << 20:
        raise ValueError(f"{vocabulary}: {len(data)} bytes are too many to broadcast")
    held = docs.sparkSession.sparkContext.broadcast((data, code_classes()))
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches):
        codec = Codec(*held.value)
        for batch in batches:
            n, sha, decoded, kept = [], [], [], []
            for ids, joined, back in codec.encode(batch.column("text")):
                n.append(len(ids))
                sha.append(hashlib.sha256(joined).hexdigest())
                decoded.append(hashlib.sha256(back).hexdigest())
                if with_ids:
                    kept.append(ids)
            out = {"row": batch.column("row"), "n_tokens": pa.array(n, pa.int64()),
                   "ids_sha256": pa.array(sha, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())}
            if with_ids:
                out["ids"] = pa.array(kept, pa.list_(pa.int32()))
            yield pa.record_batch(out)

    schema = (T.StructType([rows.schema["row"]]).add("n_tokens", "long").add("ids_sha256", "string")
              .add("decoded_sha256", "string"))
    return rows.mapInArrow(run, schema.add("ids", T.ArrayType(T.IntegerType())) if with_ids else schema)
