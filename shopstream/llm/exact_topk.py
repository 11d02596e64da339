"""Exact top-k search by tiled matrix products (operator 3).

Candidates are dealt into shards and queries into blocks, both of bounded
size.  Each tile (block, shard) is one integer matrix product with a partial
selection per query; the lists of a block are then merged a few at a time, in
a tree, so no task ever holds more than a tile or ``FAN`` lists of a block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import materialized

BLOCK = 4096        # queries of a block
STEP = 256          # queries multiplied at a time
SHARD = 8192        # candidates of a shard
FAN = 8             # lists merged at a time
SIDE = "id long, vector binary"
LIST = "block long, shard long, query binary, ids binary, scores binary"
SMALL = 1 << 52     # below it float64 products are exact
LAST = (1 << 63) - 1


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64) -> DataFrame:
    """id and floor(scale * x) of each component as packed 64-bit integers.
    Vectors that are null, or hold a null or a non-finite component, and rows
    without an id take no part; rows of one id count once."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull() & fine)
            .select(F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(x * scale)).alias("v")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            flat, ends = np.asarray(v.flatten(), np.int64), np.append(0, np.cumsum(np.asarray(v.value_lengths(), np.int64)))
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array([flat[a:e].tobytes() for a, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary())],
                names=["id", "vector"])

    return rows.mapInArrow(run, SIDE)


def _matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    """Rows of equal width; shorter vectors count as zero beyond their end."""
    out = np.zeros((len(blobs), dim), np.int64)
    for i, b in enumerate(blobs):
        v = np.frombuffer(b, np.int64)
        out[i, :len(v)] = v
    return out


def scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows: exact, or the nearest of +-(2^63 - 1)
    where they do not fit in 64 bits."""
    most = lambda m: max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))
    bound = most(q) * most(c) * max(1, q.shape[1])
    if bound < SMALL:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 62:
        return q @ c.T
    return _saturated(q, c)


def _saturated(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Products modulo 2^64 are exact wherever the float product and its error
    bound lie within 64 bits; the few too near the end are Python integers."""
    out, ends = q @ c.T, float(1 << 63)
    qf, cf = q.astype(np.float64), c.astype(np.float64)
    near = qf @ cf.T
    error = (np.abs(qf) @ np.abs(cf).T) * ((q.shape[1] + 4) * 2.0 ** -52)
    out[near - error >= ends] = LAST
    out[near + error <= -ends] = -LAST
    unsure = (near + error >= ends) & (near - error < ends) | (near - error <= -ends) & (near + error > -ends)
    for i, j in zip(*(x.tolist() for x in np.nonzero(unsure)), strict=True):
        exact = sum(a * b for a, b in zip(q[i].tolist(), c[j].tolist(), strict=True))
        out[i, j] = max(-LAST, min(LAST, exact))
    return out


def best(score: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Per row the ids and scores of the k highest, ties to the smaller id;
    -1 ranks where there are fewer.  ``ids`` ascends; ``own`` is left out."""
    n = len(ids)
    lowest = np.iinfo(np.int64).min
    at = np.searchsorted(ids, own).clip(max=max(n - 1, 0))
    same = ids[at] == own if n else np.zeros(len(own), bool)
    score[np.flatnonzero(same), at[same]] = lowest
    take = min(k, n)
    if np.abs(score[score > lowest]).max(initial=0) < 1 << 40:
        # one key for score and position: the selection has no ties
        key = np.where(score == lowest, lowest, score * (1 << 20) + (n - np.arange(n)))
        part = np.argpartition(key, n - take, axis=1)[:, n - take:] if take < n else np.tile(np.arange(n), (len(own), 1))
        order = np.argsort(~np.take_along_axis(key, part, 1), axis=1, kind="stable")      # ~ turns the order round
        part = np.take_along_axis(part, order, 1)
    else:
        part = np.argsort(~score, axis=1, kind="stable")[:, :take]
    return ids[part], np.take_along_axis(score, part, 1)


def _packed(table: pa.Table) -> tuple[np.ndarray, list[bytes]]:
    ids = np.asarray(table.column("id").combine_chunks(), np.int64)
    order = np.argsort(ids, kind="stable")
    blobs = table.column("vector").to_pylist()
    ids = ids[order]
    first = np.append(True, ids[1:] != ids[:-1]) if len(ids) else np.zeros(0, bool)
    return ids[first], [blobs[i] for i in order[first].tolist()]


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = 64) -> DataFrame:
    """query_id, rank (from 1), vec_id and score of the ``k`` highest integer
    inner products of each query, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every``; candidates all
    rows but the query's own.  See ``quantised`` for rows that take no part;
    vectors of different lengths are compared as if the shorter one went on
    with zeros; a query with fewer candidates gets fewer rows; an empty table
    gives none.  Components beyond 64 bits count as the last 64-bit integer,
    and so do scores (see ``scores``).
    """
    rows = materialized(quantised(vectors, id_col, vector_col, scale).withColumn("is_query", F.col("id") % every == 0), "vectors")
    n = rows.agg(F.count("*").alias("n"), F.count_if("is_query").alias("q")).first()
    shards, blocks = -(-n.n // SHARD), -(-n.q // BLOCK)
    if not blocks:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # rows of one id meet in one shard, where they count once
    deal = lambda salt, m: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(m))
    numbers = lambda m: F.sequence(F.lit(0).cast("long"), F.lit(m - 1).cast("long"))
    c = (rows.select(deal(1, shards).alias("shard"), "id", "vector")
         .select("shard", F.explode(numbers(blocks)).alias("block"), "id", "vector"))
    q = (rows.where("is_query").select(deal(2, blocks).alias("block"), "id", "vector")
         .select("block", F.explode(numbers(shards)).alias("shard"), "id", "vector"))

    def tile(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        schema = pa.schema([("block", pa.int64()), ("shard", pa.int64()), ("query", pa.binary()), ("ids", pa.binary()),
                            ("scores", pa.binary())])
        if not queries.num_rows or not candidates.num_rows:
            return schema.empty_table()
        (qi, qv), (ci, cv) = _packed(queries), _packed(candidates)
        dim = max(len(x) // 8 for x in [*qv, *cv])
        q, c = _matrix(qv, dim), _matrix(cv, dim)
        got = [best(scores(q[a:a + STEP], c), ci, qi[a:a + STEP], k) for a in range(0, len(qi), STEP)]
        ids, score = (np.concatenate(x) for x in zip(*got, strict=True))
        return pa.table([[queries.column("block")[0].as_py()], [queries.column("shard")[0].as_py()], [qi.tobytes()],
                         [ids.tobytes()], [score.tobytes()]], schema=schema)

    lists = q.groupBy("block", "shard").cogroup(c.groupBy("block", "shard")).applyInArrow(tile, LIST)
    lists, left = materialized(lists, "tiles"), shards
    while left > 1:
        left = -(-left // FAN)
        lists = _merged(lists.withColumn("shard", F.floor(F.col("shard") / FAN)), k)
    return _rows(lists, k)


def _unpacked(query: bytes, ids: bytes, score: bytes):
    q = np.frombuffer(query, np.int64)
    return q, np.frombuffer(ids, np.int64).reshape(len(q), -1), np.frombuffer(score, np.int64).reshape(len(q), -1)


def _merged(lists: DataFrame, k: int) -> DataFrame:
    """One list per block and new shard out of at most FAN."""
    def run(t: pa.Table) -> pa.Table:
        parts = [_unpacked(*x) for x in zip(*(t.column(c).to_pylist() for c in ("query", "ids", "scores")), strict=True)]
        ids, score = np.concatenate([p[1] for p in parts], axis=1), np.concatenate([p[2] for p in parts], axis=1)
        by_id = np.argsort(ids, axis=1, kind="stable")
        score = np.take_along_axis(score, by_id, 1)
        ids = np.take_along_axis(ids, by_id, 1)
        order = np.argsort(~score, axis=1, kind="stable")[:, :k]
        ids, score = np.take_along_axis(ids, order, 1), np.take_along_axis(score, order, 1)
        return pa.table([t.column("block")[:1], t.column("shard")[:1], [parts[0][0].tobytes()], [ids.tobytes()], [score.tobytes()]],
                        names=["block", "shard", "query", "ids", "scores"])

    return lists.groupBy("block", "shard").applyInArrow(run, LIST)


def _rows(lists: DataFrame, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in zip(*(b.column(c).to_pylist() for c in ("query", "ids", "scores")), strict=True):
                q, ids, score = _unpacked(*x)
                there = score > np.iinfo(np.int64).min
                rank = np.broadcast_to(np.arange(1, ids.shape[1] + 1, dtype=np.int32), ids.shape)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(q, ids.shape[1]).reshape(ids.shape)[there]), pa.array(rank[there]),
                     pa.array(ids[there]), pa.array(score[there])], names=["query_id", "rank", "vec_id", "score"])

    return lists.select("query", "ids", "scores").mapInArrow(run, "query_id long, rank int, vec_id long, score long")
