"""Approximate nearest neighbours by sharded HNSW graphs (dealt operator 5).

Equal vectors are one class, so copies neither crowd a graph nor cost a
search.  Classes are dealt to shards by hash; a task builds a shard's
hierarchical navigable small-world graph and stores it as flat neighbour
arrays, one table row a shard.  Queries travel in blocks to every shard; the beams
of a block advance together, and the shards' results are merged.  Scores are recomputed in double precision from the
original vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ticksmith.plans.storage import materialize

SHARD = 16_384      # classes of a shard, about
LINKS = 16          # links of a node; twice as many in the lowest layer
BUILD_BEAM = 64
SEARCH_BEAM = 128
BATCH = 1024
QUERY_BLOCK = 4096
ABREAST = 256        # beams that advance together
LAST = (1 << 31) - 1
NOTHING = np.iinfo(np.int64).min


def _packed(sims, ids, open_):
    """Integers that sort like ``sims``, of equal ones the smaller id last, and hold the id and in the lowest bit ``open_``."""
    bits = sims.view(np.int32)
    bits = (bits ^ ((bits >> 31) & 0x7FFFFFFF)).astype(np.int64)
    return (bits << 32) | (LAST - ids.astype(np.int64) << 1) | open_


def beam_search(vectors, adjacent, queries, entry, beam):
    """(ids, similarities) of the ``beam`` best nodes found for each query, best first; -1 where fewer.

    ``adjacent`` holds the neighbour array of the nodes present (-1: none).
    """
    parts = [_beam_search(vectors, adjacent, queries[a:a + ABREAST], entry[a:a + ABREAST], beam)
             for a in range(0, len(queries), ABREAST)]
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _beam_search(vectors, adjacent, queries, entry, beam):
    b, n = len(queries), len(adjacent)
    found = np.full((b, beam), NOTHING)      # each row sorted, its best last
    found[:, -1] = _packed(np.einsum("ij,ij->i", vectors[entry], queries), entry, 1)
    seen = np.zeros(b * n, bool)
    seen[np.arange(b) * n + entry] = True
    live, mine = np.arange(b), found
    while True:
        at, open_ = np.arange(len(live)), (mine & 1).astype(bool)
        best = beam - 1 - open_[:, ::-1].argmax(axis=1)
        more = open_[at, best]
        if not more.all():
            found[live] = mine
            live, mine, best, at = live[more], mine[more], best[more], at[:more.sum()]
            if not len(live):
                break
        mine[at, best] -= 1
        near = adjacent.take(LAST - (mine[at, best] >> 1 & LAST), axis=0)
        place = near + (live * n)[:, None]
        r, c = np.nonzero((near >= 0) & ~seen.take(place, mode="clip"))
        node, who = near[r, c], live[r]
        seen[place[r, c]] = True
        got = np.full(near.shape, NOTHING)
        got[r, c] = _packed(np.einsum("ij,ij->i", vectors.take(node, axis=0), queries.take(who, axis=0)), node, 1)
        both = np.concatenate([got, mine], axis=1)
        both.sort(axis=1)
        mine = both[:, near.shape[1]:]
    found = found[:, ::-1]
    there, bits = found != NOTHING, (found >> 32).astype(np.int32)
    sims = (bits ^ ((bits >> 31) & 0x7FFFFFFF)).view(np.float32)
    return np.where(there, LAST - (found >> 1 & LAST), -1), np.where(there, sims, np.float32(-np.inf))


def choose(vectors, ids, sims, links):
    """Of each row's candidates (best first) those nearer to the query than to one chosen already;
    then the best of the rest up to ``links``."""
    b, c = ids.shape
    v = vectors[np.maximum(ids, 0)]
    between = v @ v.transpose(0, 2, 1)
    taken, worst, count = np.zeros((b, c), bool), np.full((b, c), -np.inf, np.float32), np.zeros(b, np.int64)
    for j in range(c):
        ok = (ids[:, j] >= 0) & (sims[:, j] > worst[:, j]) & (count < links)
        taken[ok, j] = True
        count += ok
        worst[ok] = np.maximum(worst[ok], between[ok, j])
    rank = np.where(ids < 0, 2 * c, np.where(taken, 0, c) + np.arange(c))
    first = np.argsort(rank, axis=1, kind="stable")[:, :links]
    return np.take_along_axis(ids, first, axis=1)


def _add_back(vectors, adjacent, node, near):
    """Link each chosen neighbour back; a full list keeps the nearest."""
    width = adjacent.shape[1]
    src, to = np.repeat(node, near.shape[1]), near.ravel()
    src, to = src[to >= 0], to[to >= 0]
    touched = np.unique(to)
    old = adjacent[touched]
    a = np.concatenate([np.repeat(touched, width), to])
    b = np.concatenate([old.ravel(), src])
    a, b = a[b >= 0], b[b >= 0]
    sim = np.einsum("ij,ij->i", vectors[a], vectors[b])
    order = np.lexsort((b, -sim, a))
    a, b = a[order], b[order]
    keep = np.r_[True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])] if len(a) else np.zeros(0, bool)
    a, b = a[keep], b[keep]
    start = np.searchsorted(a, touched)
    place = np.arange(len(a)) - np.repeat(start, np.diff(np.r_[start, len(a)]))
    adjacent[touched] = -1
    keep = place < width
    adjacent[a[keep], place[keep]] = b[keep]


def build_layer(vectors, entry, links):
    """Neighbour array of a layer over ``vectors``; ``entry`` is a start node of each among the earlier ones."""
    n = len(vectors)
    adjacent = np.full((n, links * 2), -1, np.int64)
    done = min(n, 2 * BUILD_BEAM)
    sims = vectors[:done] @ vectors[:done].T
    np.fill_diagonal(sims, -np.inf)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
    found = np.take_along_axis(sims, order, axis=1)
    near = choose(vectors, np.where(found > -np.inf, order, -1), found, links)
    adjacent[:done, :near.shape[1]] = near
    _add_back(vectors, adjacent, np.arange(done), near)
    while done < n:
        stop = min(n, done + min(done, BATCH))
        node = np.arange(done, stop)
        ids, sims = beam_search(vectors, adjacent[:done], vectors[node], np.minimum(entry[node], done - 1), BUILD_BEAM)
        # nodes of one batch also see each other
        own = vectors[node] @ vectors[node].T
        np.fill_diagonal(own, -np.inf)
        k = min(BUILD_BEAM // 2, len(node))
        mate = np.argpartition(-own, k - 1, axis=1)[:, :k]
        sims = np.concatenate([sims, np.take_along_axis(own, mate, axis=1)], axis=1)
        ids = np.concatenate([ids, np.where(sims[:, -k:] > -np.inf, mate + done, -1)], axis=1)
        order = np.argsort(-sims, axis=1, kind="stable")[:, :BUILD_BEAM]
        near = choose(vectors, np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1), links)
        adjacent[node, :near.shape[1]] = near
        _add_back(vectors, adjacent, node, near)
        done = stop
    return adjacent


def build(unit: np.ndarray, links: int = LINKS) -> list[np.ndarray]:
    """Layers' neighbour arrays, lowest first; ``unit`` has unit vectors in random order.

    Layer l holds the first n / links^l nodes, so a node's number is the same
    in every layer and layers are built from the top.
    """
    sizes = [len(unit)]
    while sizes[-1] > 4 * links:
        sizes.append(-(-sizes[-1] // links))
    layers: list[np.ndarray] = []
    for size in reversed(sizes):
        entry = np.zeros(size, np.int64)
        for layer in layers:
            for a in range(0, size, BATCH):
                ids, _ = beam_search(unit, layer, unit[a:min(size, a + BATCH)], entry[a:a + BATCH], 4)
                entry[a:a + BATCH] = ids[:, 0]
        layers.append(build_layer(unit[:size], entry, links))
    return layers[::-1]


def search(unit, layers, queries, k: int, beam: int = SEARCH_BEAM):
    """(ids, similarities) of about the k nearest of each query; -1 where there are fewer."""
    entry = np.zeros(len(queries), np.int64)
    for layer in layers[:0:-1]:
        entry = beam_search(unit, layer, queries, entry, 4)[0][:, 0]
    ids, sims = beam_search(unit, layers[0], queries, entry, max(beam, k))
    return ids[:, :k], sims[:, :k]


def _unit(v):
    return (v / np.linalg.norm(v, axis=1, keepdims=True)).astype(np.float32)


INDEX = "dim int, shard int, vectors binary, ids array<array<bigint>>, sizes array<int>, links binary"


def build_index(classes: DataFrame) -> DataFrame:
    """One row a shard of ``classes`` (dim, shard, vector array<double>, ids array<bigint>)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).combine_chunks()
        dim, shard = table["dim"][0].as_py(), table["shard"][0].as_py()
        ids = table["ids"].to_pylist()
        vectors = np.asarray(pc.list_flatten(table["vector"]).to_numpy(), np.float64).reshape(-1, dim)
        order = np.random.default_rng(7).permutation(np.argsort([i[0] for i in ids], kind="stable"))
        vectors, ids = vectors[order], [ids[i] for i in order.tolist()]
        layers = build(_unit(vectors))
        yield pa.record_batch({
            "dim": pa.array([dim], pa.int32()), "shard": pa.array([shard], pa.int32()),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "ids": pa.array([ids], pa.list_(pa.list_(pa.int64()))),
            "sizes": pa.array([[len(x) for x in layers]], pa.list_(pa.int32())),
            "links": pa.array([b"".join(x.astype(np.int32).tobytes() for x in layers)], pa.binary())})

    return classes.groupBy("dim", "shard").applyInArrow(run, INDEX)


def best_of(present, ids, scores, k: int):
    """The first k columns of each row by score, of equal scores by id; those not present come last."""
    order = np.lexsort((ids, -scores, ~present), axis=1)[:, :k]
    return tuple(np.take_along_axis(x, order, axis=1) for x in (present, ids, scores))


def search_index(index: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(key, vec_id, score): the k best rows of the shards of a task for every query of ``blocks`` (dim, part, keys, queries).

    Every block meets every shard of its dimension, in tasks that each read some of the
    stored shards and blocks: nothing is broadcast, and no block is stored once a shard.
    """

    def run(batches):
        best = {}
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column("dim")[i].as_py()
                vectors = np.frombuffer(batch.column("vectors")[i].as_buffer(), np.float64).reshape(-1, dim)
                unit = _unit(vectors)
                links = np.frombuffer(batch.column("links")[i].as_buffer(), np.int32).reshape(-1, 2 * LINKS)
                cuts = np.r_[0, np.cumsum(batch.column("sizes")[i].as_py())]
                layers = [links[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                lists = batch.column("ids")[i].values
                count = pc.list_value_length(lists).to_numpy()
                has = np.arange(count.max()) < count[:, None]
                members = np.zeros(has.shape, np.int64)
                members[has] = lists.flatten().to_numpy()
                keys = batch.column("keys")[i].values.to_numpy()
                queries = batch.column("queries")[i].values.to_numpy().reshape(-1, dim)
                norm = (vectors * vectors).sum(axis=1)
                out = []
                for a in range(0, len(keys), BATCH):
                    part = queries[a:a + BATCH]
                    found, _ = search(unit, layers, _unit(part), k)
                    at = np.maximum(found, 0)
                    exact = np.einsum("ijk,ik->ij", vectors[at], part)
                    exact /= np.sqrt(norm[at] * (part * part).sum(axis=1)[:, None])
                    flat = (len(part), -1)
                    out.append(best_of((has[at] & (found >= 0)[:, :, None]).reshape(flat), members[at].reshape(flat),
                                       np.repeat(exact, has.shape[1], axis=1), k))
                out = [np.concatenate(x) for x in zip(*out, strict=True)]
                block = dim, batch.column("part")[i].as_py()
                if block in best:
                    out = best_of(*(np.concatenate(x, axis=1) for x in zip(best[block][1:], out, strict=True)), k)
                best[block] = np.array(keys), *out
        for keys, present, ids, scores in best.values():
            yield pa.record_batch({"key": pa.array(np.repeat(keys, present.sum(axis=1)), pa.int64()),
                                   "vec_id": pa.array(ids[present], pa.int64()), "score": pa.array(scores[present], pa.float64())})

    return (index.join(blocks.withColumnRenamed("dim", "of").hint("shuffle_replicate_nl"), F.col("dim") == F.col("of"))
            .select("dim", "vectors", "ids", "sizes", "links", "part", "keys", "queries")
            .mapInArrow(run, "key bigint, vec_id bigint, score double"))


def nearest(vectors: DataFrame, is_query, k: int = 5, shard_rows: int = SHARD) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest other rows found for each query row, by cosine.

    ``vectors`` has vec_id and embedding; ``is_query`` is a condition on them.
    Ties go to the smaller vec_id; a query with fewer other rows gets all.
    Rows whose id or vector is null, or whose vector is empty, zero or holds a null
    or non-finite component take no part; vectors of another length are never
    compared; repeated rows count once; other columns are ignored.
    """
    v = F.col("vector")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"),
                          F.col("embedding").cast("array<double>").alias("vector"), is_query.alias("asks")).where(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & F.coalesce(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
        & F.exists(v, lambda x: x != 0))
    # a class needs its k + 1 smallest ids only: the window limit applies before the shuffle; the hash spares
    # the sort most comparisons of whole vectors
    order = Window.partitionBy("hash", "vector").orderBy("vec_id")
    classes = materialize(
        rows.select("vec_id", "vector").distinct().withColumn("hash", F.xxhash64("vector"))
        .withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1)
        .groupBy("hash", "vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
        .select("vector", "ids", F.size("vector").alias("dim")), "ann-classes")
    shards = max(1, -(-classes.count() // shard_rows))
    classes = classes.withColumn("hash", F.xxhash64("vector")).withColumn("shard", F.pmod("hash", F.lit(shards)).cast("int"))
    index = materialize(build_index(classes.select("dim", "shard", "vector", "ids").repartitionById(shards, "shard")), "ann-index")
    # a broadcast passes through the driver, and Spark guesses its size without knowing how well parquet packed it:
    # the joins are sorted ones at any size
    asking = rows.where("asks").select(F.col("vec_id").alias("query_id"), "vector").distinct()
    asking = materialize(
        asking.withColumn("hash", F.xxhash64("vector")).hint("merge")
        .join(classes.select("hash", "vector", "dim", F.element_at("ids", 1).alias("key")), ["hash", "vector"])
        .select("query_id", "vector", "dim", "key"), "ann-queries")
    different = asking.select("dim", "key", "vector").dropDuplicates(["dim", "key"])
    parts = max(1, -(-different.count() // QUERY_BLOCK))
    blocks = (different.groupBy("dim", F.pmod(F.xxhash64("key"), F.lit(parts)).cast("int").alias("part"))
              .agg(F.collect_list("key").alias("keys"), F.flatten(F.collect_list("vector")).alias("queries"))
              .repartitionById(parts, "part"))
    found = search_index(index, blocks, k + 1)
    best = Window.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    merged = found.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).drop("n")
    own = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asking.select("query_id", "key").hint("merge").join(merged, "key").where("vec_id <> query_id")
            .withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
