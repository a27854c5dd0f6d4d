"""Document quality from a line CRF (dealt operator 7).

Every line of a text is a node of a linear chain with two labels, good and
bad.  A line's score uses its own features and those of its neighbours; two
transition weights tie neighbouring labels together.  Forward-backward gives
each line's probability of being good, and a document's quality is the
length-weighted mean of these, put through a two-parameter logistic fitted on
the same sample.

The model is fitted on a bounded sample of labelled rows (``per_class`` rows
a label, those with the smallest hash of their id); a line of a labelled
document takes the document's label.  Scoring is one narrow pass over all rows
and whole texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ticksmith.llm.arrays import blocks, space_table, text_bytes, word_hashes, words

PER_CLASS = 2000
STEPS = 150
THRESHOLD = 0.3


def line_features(column):
    """Per block: (lines of each row, line lengths, feature matrix of the lines).

    Lines are the parts between line feeds that hold a word; the matrix has a
    line's own features and those of the line before and after (zero beyond
    the text's ends).
    """
    raw, off = text_bytes(column)
    table = space_table()
    kind = np.zeros((5, 256), np.int64)
    kind[0, 0x41:0x5B] = 1                                    # capitals
    kind[1, 0x30:0x3A] = 1                                    # digits
    kind[2, 0x21:0x30] = kind[2, 0x3A:0x41] = kind[2, 0x5B:0x61] = kind[2, 0x7B:0x7F] = 1
    kind[2, [0x2C, 0x2E, 0x27, 0x2D]] = 0                     # symbols, without . , ' -
    kind[3, [0x2C, 0x2E]] = 1
    kind[4, 0x61:0x7B] = 1                                    # small letters
    for a, b in blocks(off):
        part, o = raw[off[a]:off[b]], off[a:b + 1] - off[a]
        start, end, first = words(part, o, table)
        n = len(start)
        if n == 0:
            yield np.zeros(b - a, np.int64), np.zeros(0), np.zeros((0, 34))
            continue
        feeds = np.r_[0, np.cumsum(part == 0x0A)]
        row = np.repeat(np.arange(b - a), np.diff(first))
        new = np.r_[True, (feeds[start[1:]] != feeds[start[:-1]]) | (row[1:] != row[:-1])]
        head = np.flatnonzero(new)
        stop = np.r_[head[1:], n]
        line = np.cumsum(new) - 1
        count = (stop - head).astype(float)
        low, high = start[head], end[stop - 1]
        size = (high - low).astype(float)
        share = []
        for k in range(5):
            sums = np.r_[0, np.cumsum(kind[k][part])]
            share.append((sums[high] - sums[low]) / size)
        h = word_hashes(part, start, end)
        same = np.r_[False, (h[1:] == h[:-1]) & ~new[1:]]
        marked = kind[2][part[end - 1]] > 0
        whole = np.add.reduceat(h * (np.arange(n, dtype=np.uint64) - head.astype(np.uint64)[line] + np.uint64(1)), head)
        _, which, often = np.unique(whole + row[head].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15),
                                    return_inverse=True, return_counts=True)
        own = np.stack([
            *share,
            np.bincount(line, same) / count,                  # words that repeat the one before
            np.bincount(line, marked) / count,                # words that end in a symbol
            np.bincount(line, (end - start).astype(float)) / count / 10,
            np.log1p(count) / 5,
            (count < 4).astype(float),
            (often[which.reshape(-1)] > 1).astype(float),     # the line stands elsewhere in the text
        ], axis=1)
        lrow = row[head]
        before = np.zeros_like(own)
        after = np.zeros_like(own)
        joined = lrow[1:] == lrow[:-1]
        before[1:][joined] = own[:-1][joined]
        after[:-1][joined] = own[1:][joined]
        yield np.bincount(lrow, minlength=b - a), size, np.concatenate([np.ones((len(head), 1)), own, before, after], axis=1)


@dataclass
class LineCrf:
    """weights: of the features for the label good; step: transition scores;
    slope, shift: from mean marginal to score; prior: of texts without words."""

    weights: np.ndarray
    step: np.ndarray
    slope: float
    shift: float
    prior: float


def _log_sum(x, axis):
    m = x.max(axis=axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis=axis, keepdims=True))).squeeze(axis)


def marginals(logit: np.ndarray, count: np.ndarray, step: np.ndarray, weight: np.ndarray | None = None):
    """(probability good of each line, expected transitions) by forward-backward.

    All rows of like length go through the chain together.  ``weight`` counts
    the transitions of a row so often (once if not given).
    """
    weight = np.ones(len(count)) if weight is None else weight
    good, pairs = np.zeros(len(logit)), np.zeros((2, 2))
    first = np.r_[0, np.cumsum(count)]
    order = np.argsort(-count, kind="stable")
    order = order[count[order] > 0]
    a = 0
    while a < len(order):
        longest = int(count[order[a]])
        b = min(len(order), a + max(1, 200_000 // longest))
        rows = order[a:b]
        a = b
        n = count[rows]
        live = np.arange(longest)[None, :] < n[:, None]
        unary = np.zeros((len(rows), longest, 2))
        at = (first[rows][:, None] + np.arange(longest)[None, :])[live]
        unary[live, 1] = logit[at]
        fwd, back = unary.copy(), np.zeros_like(unary)
        alive = np.searchsorted(-n, -np.arange(longest), "left")   # rows with more than t lines come first
        for t in range(1, longest):
            m = int(alive[t])
            fwd[:m, t] += _log_sum(fwd[:m, t - 1, :, None] + step, 1)
        for t in range(longest - 2, -1, -1):
            m = int(alive[t + 1])
            back[:m, t] = _log_sum(step + (unary[:m, t + 1] + back[:m, t + 1])[:, None, :], 2)
        both = fwd + back
        p = 1 / (1 + np.exp(np.clip(both[..., 0] - both[..., 1], -500, 500)))
        good[at] = p[live]
        if longest > 1:
            z = _log_sum(both[:, 0], 1)
            x = fwd[:, :-1, :, None] + step + (unary + back)[:, 1:, None, :] - z[:, None, None, None]
            pairs += np.einsum("n,ntij->ij", weight[rows], np.exp(np.where(live[:, 1:, None, None], x, -np.inf)))
    return good, pairs


def _mean_good(good, size, count):
    row = np.repeat(np.arange(len(count)), count)
    total = np.bincount(row, size, minlength=len(count))
    return np.bincount(row, size * good, minlength=len(count)) / np.maximum(total, 1)


def _logit(p):
    p = np.clip(p, 1e-4, 1 - 1e-4)
    return np.log(p / (1 - p))


# Strength of the normal priors of feature weights and transitions.
PRIOR_W, PRIOR_STEP = 1e-4, 1e-3


def gradient(w, step, count, x, label):
    """Gradient of ``mean over rows of log p(labels of its lines) / its lines``, with normal priors.

    Every row counts alike, whatever its number of lines; features and transitions of a
    row have the same weight.  ``label`` is one number a row.
    """
    each = 1 / np.maximum(count, 1)
    good, pairs = marginals(x @ w, count, step, each)
    inner = each * (count - 1).clip(0)
    seen = np.diag([inner[label == 0].sum(), inner[label == 1].sum()])
    gone = np.repeat(each, count) * (np.repeat(label, count) - good)
    return x.T @ gone / len(label) - PRIOR_W * w, (seen - pairs) / len(label) - PRIOR_STEP * step


def fit(count, size, x, label, steps: int = STEPS) -> LineCrf:
    """The chain of greatest likelihood (see ``gradient``) by Adam, then the logistic on the mean marginals."""
    label = label.astype(float)
    if not len(label) or label.min() == label.max() or not len(x):
        prior = float(label.mean()) if len(label) else 0.5
        return LineCrf(np.zeros(x.shape[1] if x.ndim == 2 else 34), np.zeros((2, 2)), 0.0, float(_logit(prior)), prior)
    w, step = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for t in range(1, steps + 1):
        of_w, of_step = gradient(w, step, count, x, label)
        g = np.r_[of_w, of_step.ravel()]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.1 * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, step = w + move[:-4], step + move[-4:].reshape(2, 2)
    good, _ = marginals(x @ w, count, step)
    f = _logit(_mean_good(good, size, count))
    slope, shift = 1.0, 0.0
    for _ in range(100):                                      # Newton, slightly regularised
        p = 1 / (1 + np.exp(-(slope * f + shift)))
        r = p * (1 - p) + 1e-6
        grad = np.array([((label - p) * f).sum() - 0.01 * (slope - 1), (label - p).sum()])
        hess = np.array([[(r * f * f).sum() + 0.01, (r * f).sum()], [(r * f).sum(), r.sum() + 1e-3]])
        d = np.linalg.solve(hess, grad)
        slope, shift = slope + float(np.clip(d[0], -1, 1)), shift + float(np.clip(d[1], -1, 1))
    return LineCrf(w, step, slope, shift, float(label.mean()))


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """(text, label) of at most ``per_class`` rows a label, by smallest hash of doc_id."""
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("label").cast("int").alias("label")) \
        .where("doc_id IS NOT NULL AND label IN (0, 1)").distinct()
    picked = [known.where(F.col("label") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    return (docs.select("doc_id", "text")
            .join(F.broadcast(picked[0].union(picked[1])), "doc_id").select("doc_id", "text", "label"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> LineCrf:
    """A LineCrf from docs (doc_id, text) and labels (doc_id, label 0 or 1; others are ignored)."""

    def run(batches):
        for batch in batches:
            i, label = 0, batch.column("label").to_numpy()
            ids = batch.column("doc_id").to_numpy()
            for count, size, x in line_features(batch.column("text")):
                cut = np.r_[0, np.cumsum(count)]
                m = len(count)
                yield pa.record_batch({
                    "doc_id": pa.array(ids[i:i + m]), "label": pa.array(label[i:i + m].astype(np.int32)),
                    "size": pa.array([size[p:q].tobytes() for p, q in zip(cut[:-1], cut[1:], strict=True)], pa.binary()),
                    "x": pa.array([x[p:q].tobytes() for p, q in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})
                i += m

    got = labelled_sample(docs, labels, per_class).mapInArrow(run, "doc_id bigint, label int, size binary, x binary").toArrow()
    got = got.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    size = [np.frombuffer(s, float) for s in got["size"].to_pylist()]
    x = [np.frombuffer(s, float).reshape(-1, 34) for s in got["x"].to_pylist()]
    keep = [i for i, s in enumerate(size) if len(s)]
    if not keep:
        return fit(np.zeros(0, int), np.zeros(0), np.zeros((0, 34)), np.zeros(0))
    return fit(np.array([len(size[i]) for i in keep]), np.concatenate([size[i] for i in keep]),
               np.concatenate([x[i] for i in keep]), got["label"].to_numpy()[keep])


def score(docs: DataFrame, model: LineCrf, threshold: float = THRESHOLD) -> DataFrame:
    """(row, score, predicted) per row of ``docs``; ``row`` is the whole input row as a struct.

    score is from 0 to 1, higher for likelier good; texts that are null, empty
    or without a word get the sample's share of good rows.  Repeated rows get
    equal scores.  A very long text goes through the chain whole, line by line.
    """
    rows = docs.select(F.struct("*").alias("row"), F.col("text").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            out = []
            for count, size, x in line_features(batch.column("text")):
                good, _ = marginals(x @ model.weights, count, model.step)
                f = model.slope * _logit(_mean_good(good, size, count)) + model.shift
                out.append(np.where(count > 0, 1 / (1 + np.exp(-f)), model.prior))
            s = np.concatenate(out) if out else np.zeros(0)
            yield pa.record_batch({"row": batch.column("row"), "score": pa.array(s),
                                   "predicted": pa.array((s >= threshold).astype(np.int32))})

    return rows.mapInArrow(run, T.StructType([rows.schema["row"]]).add("score", "double").add("predicted", "integer"))


def remainder(doc_id):
    """crc32 of the id's text, modulo 5."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5
