"""Embedding near-duplicates over an inverted multi-index.

Unit vectors are cut in halves; each half has its own codebook (k-means on a
bounded sample of unit vectors).  The product of the codebooks is a grid of
cells, and every vector lies in the cell of its two nearest centroids.  A
vector asks the nearest cells in the order of the multi-sequence traversal:
a heap over pairs of centroid ranks by summed distance.

When the traversal stops is learned from the sample: noisy copies of sampled
vectors at the threshold cosine, and pairs of sampled vectors over it, give
the summed distance, beyond the nearest cell's, that ``recall`` of the linked
partners need.  Every cell up to that distance is visited, so the number of
cells follows each vector.  Each meeting is verified by cosine in double
precision.

Equal vectors are one node (combined before any shuffle of vectors), with
their number as weight.  A pair is tested once, where the smaller of its two
nodes asks the other's cell.  Large cells are split in blocks of members and
every asker visits all blocks.  Tasks return link counts and a spanning forest
of links, never all pairs.

Defined results: vectors that are NULL, zero, or hold NULL or non-finite
components link with nothing and are their own component; vectors link only
with vectors of their own length, where each of the ``LENGTHS`` most common
lengths has an index of its own and any other is one cell, compared whole;
repeated ids count as one vector per row; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm import common

SAMPLE = 20_000  # vectors the codebooks and the stop are learned from
PER_CELL = 256  # vectors a cell should hold on average; fewer cells to ask cost more comparisons, which are cheap
MAX_CODES = 1024
BLOCK = 2_048  # members of a cell compared at once
LENGTHS = 8  # lengths of vectors that get an index


class Index(NamedTuple):
    codes: tuple[np.ndarray, np.ndarray]
    reach: float  # summed squared distance beyond the nearest cell's


def kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 3) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = (x @ centres.T - 0.5 * (centres ** 2).sum(axis=1)).argmax(axis=1)
        count = np.bincount(near, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, near, x)
        full = count > 0
        centres[full] = total[full] / count[full, None]
    return centres


def _halves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = x.shape[1] // 2
    return x[:, :at], x[:, at:]


def _distances(index: Index, x: np.ndarray) -> list[np.ndarray]:
    out = []
    for half, codes in zip(_halves(x), index.codes):
        d = (half ** 2).sum(axis=1)[:, None] - 2 * half @ codes.T + (codes ** 2).sum(axis=1)
        out.append(np.maximum(d, 0))
    return out


def traverse(a: np.ndarray, b: np.ndarray, reach: float) -> Iterator[tuple[int, int]]:
    """Grid cells (i, j) by rising ``a[i] + b[j]`` until ``reach`` beyond the first, multi-sequence order."""
    order_a, order_b = np.argsort(a, kind="stable"), np.argsort(b, kind="stable")
    a, b = a[order_a], b[order_b]
    heap, stop = [(a[0] + b[0], 0, 0)], a[0] + b[0] + reach
    while heap:
        d, i, j = heapq.heappop(heap)
        if d > stop:
            return
        yield int(order_a[i]), int(order_b[j])
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))


def train(x: np.ndarray, rows: int, threshold: float, recall: float, seed: int = 5) -> Index:
    """Codebooks for ``rows`` vectors in all, and the stop, from the sample ``x`` of unit vectors."""
    rng = np.random.default_rng(seed)
    k = 2
    while k * k * PER_CELL < rows and k < MAX_CODES:
        k *= 2
    index = Index(tuple(kmeans(np.ascontiguousarray(h), k) for h in _halves(x)), 0.0)
    # partners at the threshold itself, the hardest to reach, and true partners of the sample
    some = x[:2_000]
    noise = rng.standard_normal(some.shape)
    noise -= (noise * some).sum(axis=1)[:, None] * some
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    partners, askers = [threshold * some + np.sqrt(1 - threshold ** 2) * noise], [some]
    for lo in range(0, len(some), 256):
        i, j = np.nonzero(some[lo:lo + 256] @ x.T >= threshold)
        other = i + lo != j
        i, j = i[other][:20_000] + lo, j[other][:20_000]
        askers.append(x[i])
        partners.append(x[j])
    needs = []
    for a, p in zip(askers, partners):
        if len(a):
            da, dp = _distances(index, a), _distances(index, p)
            row = np.arange(len(a))
            needs.append(sum(d[row, q.argmin(axis=1)] - d.min(axis=1) for d, q in zip(da, dp)))
    # the harder of the two kinds decides
    reach = max([float(np.quantile(needs[0], recall)), float(np.quantile(np.concatenate(needs[1:]), recall)) if len(needs) > 1 else 0.0])
    return index._replace(reach=reach)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, width) if width else np.zeros((len(column), 0))


def _unit(x: np.ndarray) -> np.ndarray:
    scale = np.abs(x).max(axis=1, keepdims=True)  # keeps squares from overflowing
    x = x / scale
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, recall: float = 0.995, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors``."""
    spark = vectors.sparkSession
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v"))
    rows = rows.withColumn("v", F.transform(v, lambda x: x + F.lit(0.0)))  # -0.0 and 0.0 are one value
    usable = (F.exists(v, lambda x: x != 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    rows = rows.withColumn("usable", F.coalesce(usable, F.lit(False)))
    # one node per different vector, named by a hash of it with its smallest id; NULL ids only where there is no other
    nodes = (rows.filter("usable").groupBy("v").agg(F.count("*").alias("weight"), F.min("vec_id").alias("first_id"))
             .withColumn("width", F.size("v")).withColumn("node", F.xxhash64("v")))
    nodes = common.staged(nodes, "embedding-nodes")
    widths = nodes.groupBy("width").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "width").limit(LENGTHS).collect()
    out = "vec_id long, n_links long, component_id long, kept boolean"
    if not widths:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"),
                           F.lit(True).alias("kept"))

    def index(width: int, total: int) -> Index:
        share = min(1.0, 2 * SAMPLE / total)
        sample = (nodes.filter((F.col("width") == width) & (F.pmod("node", F.lit(1_000_000)) < int(share * 1_000_000) + 1))
                  .orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select("v").toArrow())  # bounded by SAMPLE
        return train(_unit(_matrix(sample.column(0).combine_chunks(), width)), total, threshold, recall)

    indexes = {w["width"]: index(w["width"], w["n"]) for w in widths if w["width"] > 1}
    shared = spark.sparkContext.broadcast(indexes)  # 2 x MAX_CODES centroids at most for each of LENGTHS

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = pc.list_value_length(batch.column(1)).to_numpy()
            for width in np.unique(length).tolist():
                part = batch.filter(pa.array(length == width))
                cell, asked = np.zeros(part.num_rows, np.int64), [[0]] * part.num_rows
                if width in shared.value:
                    found = shared.value[width]
                    grid = len(found.codes[1])
                    da, db = _distances(found, _unit(_matrix(part.column(1), width)))
                    cell = da.argmin(axis=1).astype(np.int64) * grid + db.argmin(axis=1)
                    asked = [[i * grid + j for i, j in traverse(a, b, found.reach)] for a, b in zip(da, db)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(cell), pa.array(asked, pa.list_(pa.int64()))],
                                                 ["node", "v", "weight", "width", "cell", "asked"])

    placed = common.staged(
        nodes.select("node", "v", "weight", "width")
        .mapInArrow(place, "node long, v array<double>, weight long, width int, cell long, asked array<long>"), "embedding-cells")
    sizes = placed.groupBy("width", "cell").agg(F.count("*").alias("n"), F.max("node").alias("last"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = placed.join(sizes, ["width", "cell"]).select("width", "cell", F.pmod(F.xxhash64("node", F.lit(1)), blocks).cast("int").alias("block"),
                                                F.lit(0).alias("kind"), "node", "v", "weight")
    # an asker goes to a cell only for members after it
    askers = (placed.select("node", "width", F.explode("asked").alias("cell")).join(sizes, ["width", "cell"]).filter(F.col("node") < F.col("last"))
              .select("node", "width", "cell", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"))
              .join(placed.select("node", "v", "weight"), "node")
              .select("width", "cell", "block", F.lit(1).alias("kind"), "node", "v", "weight"))
    meetings = (members.union(askers).repartition("width", "cell", "block")
                .sortWithinPartitions("width", "cell", "block", "kind", "node"))
    found = common.staged(meetings.mapInArrow(lambda b: _meet(b, threshold), "a long, b long, links long"), "embedding-links")

    counts = found.filter("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("others"))
    linked = common.components(found.filter("b is not null").select("a", "b"))
    named = (nodes.join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
             .join(counts, "node", "left").select("node", "weight", "component", "first_id", F.coalesce("others", F.lit(0)).alias("others")))
    named = common.staged(named, "embedding-components")
    roots = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(roots, "component").select("node", (F.col("others") + F.col("weight") - 1).alias("n_links"), "component_id")
    keyed = rows.select("vec_id", F.when(F.col("usable"), F.xxhash64("v")).alias("node"))
    return keyed.join(named, "node", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"),
    ).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).select(*[f.split()[0] for f in out.split(", ")])


def _meet(batches: Iterator[pa.RecordBatch], threshold: float) -> Iterator[pa.RecordBatch]:
    """Streams sorted (width, cell, block, kind, node, v, weight); holds one block of members at a time.

    Returns link counts ``(node, NULL, weight of its partners)`` and forest
    links ``(a, b, 0)``.
    """
    key = None
    ids = weight = label = gained = unit = None
    parts: list = []

    def rows(a, b, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(n, pa.int64())], ["a", "b", "links"])

    def close() -> Iterator[pa.RecordBatch]:
        if label is not None:
            got = np.flatnonzero(gained)
            if len(got):
                yield rows(ids[got], [None] * len(got), gained[got])
            tied = np.flatnonzero(label != np.arange(len(label)))
            if len(tied):
                yield rows(ids[tied], ids[label[tied]], np.zeros(len(tied), np.int64))

    for batch in batches:
        widths, cells, blocks, kinds, nodes = (batch.column(i).to_numpy() for i in range(5))
        weights = batch.column(6).to_numpy()
        change = np.flatnonzero(sum(np.diff(c) != 0 for c in (widths, cells, blocks, kinds))) + 1
        for lo, hi in zip([0, *change], [*change, len(nodes)]):
            if lo == hi:
                continue
            here = (int(widths[lo]), int(cells[lo]), int(blocks[lo]))
            x = _unit(_matrix(batch.column(5).slice(lo, hi - lo), here[0]))
            if here != key:
                yield from close()
                key, parts, label = here, [], None
            if kinds[lo] == 0:
                parts.append((nodes[lo:hi], x, weights[lo:hi]))
                continue
            if label is None:
                if not parts:
                    continue
                ids, unit, weight = (np.concatenate([p[i] for p in parts]) for i in range(3))
                label, gained = np.arange(len(ids)), np.zeros(len(ids), np.int64)
            for at in range(lo, hi, 512):
                to = min(hi, at + 512)
                near = (x[at - lo:to - lo] @ unit.T >= threshold) & (nodes[at:to, None] < ids[None, :])
                hit = np.flatnonzero(near.any(axis=1))
                if not len(hit):
                    continue
                gained += weights[at:to] @ near
                mine = near @ weight
                first = np.empty(len(hit), np.int64)
                for n, i in enumerate(hit):
                    partners = np.flatnonzero(near[i])
                    groups = np.unique(label[partners])
                    if len(groups) > 1:
                        label[np.isin(label, groups)] = groups[0]
                    first[n] = ids[partners[0]]
                yield rows(nodes[at:to][hit], [None] * len(hit), mine[hit])
                yield rows(nodes[at:to][hit], first, np.zeros(len(hit), np.int64))
    yield from close()
