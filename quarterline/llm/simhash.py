"""SimHash near-duplicates by multi-index hashing.

A fingerprint has one bit per position of the XXH64 (seed 42) values of the
document's word shingles.  Two fingerprints link when they differ in at most
``max_bits`` bits.  With ``segments`` equal segments, two linked fingerprints
differ in at most ``max_bits // segments`` bits in one of them, so every
fingerprint looks up all keys of that small ball around its own segment value
in the table of segment values, and the full distance of each match is checked.

Defined results: a NULL or white-space-only text has fingerprint 0 and links
like any other; fewer words than a shingle give one shingle of all words;
repeated rows share their fingerprint; a NULL ``doc_id`` never names a
component unless no other id is in it (then the component is NULL).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm import common

SEED = 42
# Slots with more members than this are compared in blocks inside tasks, which
# return a spanning forest instead of all pairs.
HOT_SLOT = 64
BLOCK = 4096


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit fingerprint of one text."""
    if text is None:
        return 0
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle))))
    digest = xxhash.xxh64_intdigest
    h = np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64)
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, fp BIGINT, row_key BIGINT)`` for every row; ``row_key`` hashes id and text."""

    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, shingle) for t in texts], dtype="int64")

    return docs.select(F.col(id_col).alias("doc_id"), fp(F.col(text_col)).alias("fp"),
                       F.xxhash64(id_col, text_col).alias("row_key"))


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(shift, width) per segment: as few as keep the lookup ball at radius 1 or less."""
    m = max(2, (max_bits + 2) // 2)
    cuts = [64 * i // m for i in range(m + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:])]


def _ball(width: int, radius: int) -> list[int]:
    return [sum(1 << i for i in bits) for r in range(radius + 1) for bits in combinations(range(width), r)]


def links(fps: DataFrame, max_bits: int = 3) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints that connect all pairs within ``max_bits``.

    ``fps(fp)`` must be distinct and cheap to read again (it is scanned a few
    times).  Cold slots return every linked pair; hot slots return a spanning
    forest of their links, so the output stays linear in the input.

    Spark sizes an exploded frame like one row of it, so the joins are told to
    merge; else all probes may be broadcast through the driver.
    """
    segments = _segments(max_bits)
    radius = max_bits // len(segments)

    def slot(i: int, key) -> F.Column:
        # segments are narrower than 58 bits, so the segment number fits above the key
        return key + F.lit(i << 58)

    def value(i: int):
        shift, width = segments[i]
        return F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))

    every = range(len(segments))
    index = fps.select("fp", F.explode(F.array(*[slot(i, value(i)) for i in every])).alias("slot"))
    keys = F.array(*[slot(i, value(i).bitwiseXOR(F.lit(m))) for i in every for m in _ball(segments[i][1], radius)])
    probes = fps.select("fp", F.explode(keys).alias("slot"))
    sizes = index.groupBy("slot").agg(F.count("*").alias("n"), F.min("fp").alias("only"))
    # a probe that meets nothing but its own fingerprint goes at once
    found = (probes.join(sizes.hint("merge"), "slot").filter((F.col("n") > 1) | (F.col("only") != F.col("fp")))
             .select("slot", "fp", "n"))
    found = common.staged(found, "simhash-found")
    hot = index.join(sizes.filter(F.col("n") > HOT_SLOT).select("slot", "n").hint("merge"), "slot")

    cold_pairs = (found.filter(F.col("n") <= HOT_SLOT).select("slot", F.col("fp").alias("a"))
                  .join(index.select("slot", F.col("fp").alias("b")).hint("merge"), "slot")
                  .filter((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits))
                  .select("a", "b"))

    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    members = hot.select("slot", F.pmod(F.xxhash64("fp"), blocks).cast("int").alias("block"), F.lit(0).alias("kind"), "fp")
    askers = (found.filter(F.col("n") > HOT_SLOT)
              .select("slot", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(1).alias("kind"), "fp"))
    hot_rows = (members.union(askers).repartition("slot", "block")
                .sortWithinPartitions("slot", "block", "kind", "fp"))
    hot_links = hot_rows.mapInArrow(lambda batches: _hot_links(batches, max_bits), "a long, b long")
    return cold_pairs.union(hot_links)


def _hot_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Streams sorted (slot, block, kind, fp); holds one block of members at a time."""
    key, members, label = None, [], None

    def out(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], ["a", "b"])

    def close() -> Iterator[pa.RecordBatch]:
        if isinstance(members, np.ndarray) and label is not None:
            tied = label != np.arange(len(label))
            if tied.any():
                yield out([members[tied]], [members[label[tied]]])

    for batch in batches:
        slots, blocks, kinds, fps = (c.to_numpy() for c in batch.columns)
        edges = np.flatnonzero((np.diff(slots) != 0) | (np.diff(blocks) != 0) | (np.diff(kinds) != 0)) + 1
        for lo, hi in zip([0, *edges], [*edges, len(fps)]):
            if lo == hi:
                continue
            here = (int(slots[lo]), int(blocks[lo]))
            if here != key:
                yield from close()
                key, members, label = here, [], None
            if kinds[lo] == 0:
                members.append(fps[lo:hi])
                continue
            if label is None:
                members = np.concatenate(members) if members else np.empty(0, np.int64)
                label = np.arange(len(members))
            if not len(members):
                continue
            a, b = [], []
            for p in fps[lo:hi]:
                near = np.flatnonzero(np.bitwise_count((members ^ p).view(np.uint64)) <= max_bits)
                near = near[members[near] != p]
                if not len(near):
                    continue
                groups = np.unique(label[near])
                if len(groups) > 1:
                    label[np.isin(label, groups)] = groups[0]
                a.append(np.array([p]))
                b.append(members[near[:1]])
            if a:
                yield out(a, b)
    yield from close()


def _grouped(docs: DataFrame, shingle: int, max_bits: int, id_col: str, text_col: str) -> DataFrame:
    """``(doc_id, fp, row_key, component, component_id)``; ``component`` is the smallest fingerprint reachable."""
    prints = common.staged(fingerprints(docs, shingle, id_col, text_col), "simhash-prints")
    groups = prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc"))
    linked = common.components(links(groups.select("fp"), max_bits))
    named = (groups.join(linked.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("component", F.coalesce("component", "fp")))
    roots = named.groupBy("component").agg(F.min("first_doc").alias("component_id"))
    whole = named.select("fp", "component").join(roots, "component")
    return prints.join(whole, "fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for every row of ``docs``."""
    found = _grouped(docs, shingle, max_bits, id_col, text_col)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, shingle: int = 3, max_bits: int = 3, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """One row of each group of near-duplicates, with the columns of ``docs``.

    The row whose id names the component stays.  If several rows of the
    component carry that id (repeated rows, or no id at all) one of them stays.
    """
    found = _grouped(docs, shingle, max_bits, id_col, text_col)
    kept = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("component").agg(F.min("row_key").alias("_row_key")).select("_row_key"))
    rows = docs.select(F.struct(*docs.columns).alias("_row"), F.xxhash64(id_col, text_col).alias("_row_key"))
    return rows.join(kept, "_row_key").dropDuplicates(["_row_key"]).select("_row.*")
