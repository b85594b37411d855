"""Exact top-k search by exhaustive term-at-a-time accumulation.

Components are quantised to integers; a component position is a term and a
vector's non-zero components are its postings.  Each task turns a batch of
candidates into postings per term and scatters ``query weight x posting
weight`` into dense integer score arrays, one term after the other, then
selects the best per query by partitioning.  The task keeps the best k per
query over its batches; a window merges those of all tasks.

Queries reach the tasks in blocks of at most ``QUERY_BLOCK`` rows, one pass
over the candidates per block, so memory does not grow with the table.

Defined results: vectors that are NULL or hold NULL or non-finite components
take no part; missing trailing components count as 0; candidates with the
query's own id are skipped; equal scores go to the smaller id; repeated query
rows answer once; a NULL id takes no part.  Scores beyond BIGINT raise.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 16_384
TILE = 64


def quantised(batch: pa.RecordBatch, scale: float) -> tuple[np.ndarray, np.ndarray]:
    """(ids, floor(scale * vector) as BIGINT matrix) of the valid rows of a batch (id, vector)."""
    ids, vectors = batch.column(0), batch.column(1)
    lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    width = int(lengths.max()) if len(lengths) else 0
    flat = vectors.flatten()
    values = np.floor(scale * flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False))
    row = np.repeat(np.arange(len(lengths)), lengths)
    ok = np.asarray(vectors.is_valid()) & np.asarray(ids.is_valid())
    ok[row[~np.isfinite(values)]] = False
    if (np.abs(values[np.isfinite(values)]) >= 2.0 ** 62).any():
        raise OverflowError("a quantised component does not fit in BIGINT")
    out = np.zeros((len(lengths), width), dtype=np.int64)
    column = np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    good = ok[row]
    out[row[good], column[good]] = values[good].astype(np.int64)
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)[ok], out[ok]


def accumulate(postings: list[tuple[np.ndarray, np.ndarray]], n: int, queries: np.ndarray) -> np.ndarray:
    """Scores (n candidates x queries), one term after the other."""
    scores = np.zeros((n, len(queries)), dtype=queries.dtype)
    for term in np.flatnonzero(queries.any(axis=0)):
        if term < len(postings):
            at, weight = postings[term]
            if len(at) == n:
                scores += weight[:, None] * queries[:, term]
            else:
                scores[at] += weight[:, None] * queries[:, term]
    return scores


def _fits(a: np.ndarray, b: np.ndarray) -> type:
    """The narrowest integer type that holds every score of two blocks."""
    most = [int(max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))) for x in (a, b)]
    bound = most[0] * most[1] * max(1, min(a.shape[1], b.shape[1]))
    if bound >= 2 ** 63:
        raise OverflowError("a score may not fit in BIGINT")
    return np.int32 if bound < 2 ** 31 else np.int64


def _search(ids: np.ndarray, queries: np.ndarray, k: int, scale: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in ids]
        for batch in batches:
            vec_ids, matrix = quantised(batch, scale)
            n = len(vec_ids)
            if not n:
                continue
            kind = _fits(matrix, queries)
            postings = []
            for term in range(matrix.shape[1]):
                at = np.flatnonzero(matrix[:, term])
                postings.append((at, matrix[at, term].astype(kind)))
            for lo in range(0, len(ids), TILE):
                tile = queries[lo:lo + TILE].astype(kind)
                scores = accumulate(postings, n, tile)
                for j in range(len(tile)):
                    s, own = scores[:, j], ids[lo + j]
                    keep = min(n, k + int((vec_ids == own).sum()))
                    cut = np.partition(s, n - keep)[n - keep]  # every tie at the cut stays until ids decide
                    at = np.flatnonzero(s >= cut)
                    at = at[vec_ids[at] != own]
                    v = np.concatenate([best[lo + j][0], vec_ids[at]])
                    p = np.concatenate([best[lo + j][1], s[at].astype(np.int64)])
                    order = np.lexsort((v, -p))[:k]
                    best[lo + j] = (v[order], p[order])
        sizes = [len(v) for v, _ in best]
        if sum(sizes):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(ids, sizes)), pa.array(np.concatenate([v for v, _ in best])),
                 pa.array(np.concatenate([p for _, p in best]))], ["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id",
          vec_col: str = "embedding", query_block: int = QUERY_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` best candidates of every row where ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    asked = (vectors.filter(is_query).select(F.col(id_col).cast("long").alias("id"),
                                             F.col(vec_col).cast("array<double>").alias("v"))
             .filter(F.col("id").isNotNull() & F.col("v").isNotNull()).distinct())
    blocks = max(1, -(-asked.count() // query_block))
    shape = "query_id long, vec_id long, score long"
    found = None
    for b in range(blocks):
        block = asked.filter(F.pmod(F.xxhash64("id", "v"), F.lit(blocks)) == b)
        ids, queries = _gather(block.toLocalIterator(), scale, limit=2 * query_block)
        part = rows.mapInArrow(_search(ids, queries, k, scale), shape) if len(ids) else spark.createDataFrame([], shape)
        found = part if found is None else found.union(part)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _gather(rows: Iterator, scale: float, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """One block of queries on the driver; ``limit`` is the proven size of what the tasks receive."""
    ids, vectors = [], []
    for row in rows:
        ids.append(row["id"])
        vectors.append(row["v"])
        if len(ids) > limit:
            raise MemoryError("a query block is larger than its bound")
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(vectors, pa.list_(pa.float64()))], ["id", "v"])
    ids, matrix = quantised(batch, scale)
    order = np.argsort(ids, kind="stable")
    return ids[order], matrix[order]
