"""Document fingerprints: threshold-scaled sketches of word shingles.

Every distinct shingle of ``SHINGLE`` words has a 64-bit hash; the sketch keeps
all hashes below a fixed fraction of the range, so its size grows with the
document and the sketches of two documents sample the same shingles, however
unequal their sizes.  A sketch also keeps the ``at_least`` smallest hashes, so
that short texts have one; a text with no more shingles than that is kept
whole.  Both rules hold for unions too: the sketch of two texts together is
the same rule applied to both sketches (``merge``).

The share of the smaller text's sampled shingles that the other has too
estimates its containment; shared over all sampled ones estimates the Jaccard
likeness.  A sketch is stored as text: its hashes ascending, 16 lowercase
hexadecimal digits each.

Defined results: NULL and white-space-only texts have an empty sketch, two of
them are alike (1), one and a worded text are not (0); fewer words than a
shingle form one shingle of all words; texts are hashed whole, as they are
written (only white space between words is not told apart); repeated rows get
equal results; other columns are kept by ``sketched`` and ignored by
``against_next``.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHINGLE = 5
FRACTION = 0.25
AT_LEAST = 16
_ODD = 0x9E3779B97F4A7C15


def _mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """Distinct shingle hashes of a text, ascending."""
    words = (text or "").encode("utf-8", "surrogatepass").split()  # bytes: ASCII white space only
    if not words:
        return np.zeros(0, dtype=np.uint64)
    each = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(shingle, len(words))
    total = np.full(len(words) - width + 1, width, dtype=np.uint64)  # shorter texts hash apart
    for i in range(width):
        total = total * np.uint64(_ODD) + each[i:len(words) - width + 1 + i]
    return np.unique(_mixed(total))


def _kept(hashes: np.ndarray, fraction: float, at_least: int) -> np.ndarray:
    below = int(np.searchsorted(hashes, np.uint64(min(int(fraction * 2.0 ** 64), 2 ** 64 - 1)), side="left"))
    return hashes[:max(below, at_least)]


def sketch(text: str | None, fraction: float = FRACTION, at_least: int = AT_LEAST, shingle: int = SHINGLE) -> np.ndarray:
    """The text's kept shingle hashes, ascending."""
    return _kept(shingle_hashes(text, shingle), fraction, at_least)


def merge(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION, at_least: int = AT_LEAST) -> np.ndarray:
    """The sketch of both texts' shingles together."""
    return _kept(np.union1d(a, b), fraction, at_least)


def to_text(kept: np.ndarray) -> str:
    return kept.astype(">u8").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), dtype=">u8").astype(np.uint64)


def _sampled_to(kept: np.ndarray, fraction: float, at_least: int) -> int:
    """Up to where (exclusive) the sketch holds every shingle hash of its text."""
    if len(kept) < at_least:
        return 2 ** 64  # the whole text
    return max(int(fraction * 2.0 ** 64), int(kept[-1]) + 1)


def likeness(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION, at_least: int = AT_LEAST) -> tuple[float, float]:
    """Estimates ``(containment, jaccard)``: the smaller text's share in the other, and shared over all shingles."""
    if not len(a) or not len(b):
        same = float(len(a) == len(b))
        return same, same
    end = min(_sampled_to(a, fraction, at_least), _sampled_to(b, fraction, at_least)) - 1
    a = a[:np.searchsorted(a, np.uint64(end), side="right")]
    b = b[:np.searchsorted(b, np.uint64(end), side="right")]
    common_ = len(np.intersect1d(a, b, assume_unique=True))
    fewer, every = min(len(a), len(b)), len(a) + len(b) - common_
    return (common_ / fewer if fewer else 0.0), (common_ / every if every else 0.0)


def sketched(docs: DataFrame, text_col: str = "text", into: str = "fingerprint", fraction: float = FRACTION,
             at_least: int = AT_LEAST, shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with the fingerprint of ``text_col`` as column ``into``."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([to_text(sketch(t, fraction, at_least, shingle)) for t in texts], dtype=object)

    return docs.withColumn(into, run(F.col(text_col).cast("string")))


def merged_sizes(prints: DataFrame, by: str, into: str = "n_kept", fingerprint: str = "fingerprint",
                 fraction: float = FRACTION) -> DataFrame:
    """``(by, into)``: how many distinct hashes below the threshold the texts of each group keep together.

    Divided by ``fraction`` this estimates a group's number of distinct
    shingles.  Hashes are aggregated as rows, so a hot group is combined
    before its shuffle and never gathered.
    """
    at = F.sequence(F.lit(0), F.floor(F.length(fingerprint) / 16).cast("int") - 1)
    digits = F.when(F.length(fingerprint) > 0, F.transform(at, lambda i: F.substring(F.col(fingerprint), i * 16 + 1, F.lit(16))))
    top = f"{min(int(fraction * 2.0 ** 64), 2 ** 64 - 1):016x}"
    hashes = prints.select(F.col(by).alias("_by"), F.explode(digits).alias("_hash")).where(F.col("_hash") < top).distinct()
    return hashes.groupBy("_by").agg(F.count("*").alias("_n")).select(F.col("_by").alias(by), F.col("_n").alias(into))


_FIELDS = [("n_chars", "long", pa.int64()), ("edited_sha256", "string", pa.string()), ("fingerprint", "string", pa.string()),
           ("edited_fingerprint", "string", pa.string()), ("near_edited", "double", pa.float64()),
           ("near_next", "double", pa.float64()), ("jaccard_edited", "double", pa.float64()),
           ("jaccard_next", "double", pa.float64())]


class _Pairs:
    """Figures of texts and their next ones; keeps the sketch of the last text for its turn."""

    def __init__(self, cut: int, fraction: float, at_least: int, shingle: int):
        self.cut, self.rule, self.shingle = cut, (fraction, at_least), shingle
        self.last: tuple[str, np.ndarray] | None = None

    def _sketch(self, text: str) -> np.ndarray:
        if self.last is None or self.last[0] is not text:
            self.last = text, sketch(text, *self.rule, self.shingle)
        return self.last[1]

    def figures(self, text: str, after: str) -> tuple:
        own = self._sketch(text)
        moved = len(text) // self.cut
        edited = text[:len(text) - moved] + after[:moved]
        other = sketch(edited, *self.rule, self.shingle)
        near, near_all = likeness(own, other, *self.rule)
        following, following_all = likeness(own, self._sketch(after), *self.rule)
        return (len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_text(own), to_text(other),
                near, following, near_all, following_all)


def _key(doc: object, text_hash: int) -> tuple:
    """Place of a document in the order, NULL ids first."""
    return doc is not None, 0 if doc is None else doc, text_hash


def _range_starts(keys: DataFrame, ranges: int) -> list[tuple]:
    """The first ``(doc_id, hash)`` of at most ``ranges`` equal ranges, in order: all that the driver sees of the ids."""

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    order = [F.col("doc_id").asc_nulls_first(), F.col("hash")]
    spread = keys.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    return sorted(_key(*r) for r in spread.mapInArrow(lead, keys.schema).collect())


def against_next(docs: DataFrame, cut: int = 4, fraction: float = FRACTION, at_least: int = AT_LEAST,
                 shingle: int = SHINGLE) -> DataFrame:
    """Every document's fingerprint, that of its edited text, and its likeness to both and the next document.

    Documents follow each other by ``doc_id`` (NULL first), equal ids by a
    hash of the text; the first follows the last.  The edited text has its
    last ``n // cut`` code points replaced by the first as many of the next
    document.  Keys are cut into ranges first; then each text goes to its
    range, the first one of a range also to the range before, and a task
    streams through its ranges.  Texts move once and no result is stored.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.xxhash64(text).alias("hash"))
    kind = dict(rows.dtypes)["doc_id"]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    starts = _range_starts(rows.select("doc_id", "hash"), ranges)

    @F.arrow_udf("array<int>")
    def places(ids: pa.Array, hashes: pa.Array) -> pa.Array:
        found = []
        for key in map(_key, ids.to_pylist(), hashes.to_pylist()):
            at = bisect_right(starts, key) - 1
            # the first of a range also ends the range before; twice in its own where there is one range only
            found.append([at, (at - 1) % len(starts)] if starts[at] == key else [at])
        return pa.array(found, pa.list_(pa.int32()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = _Pairs(cut, fraction, at_least, shingle)
        within, before = None, None
        for full in batches:
            for lo in range(0, full.num_rows, 64):
                some, found = full.slice(lo, 64), []
                for at, ends, doc, text in zip(*(c.to_pylist() for c in some.columns)):
                    if before is not None and at == within:
                        found.append((before[0], *pairs.figures(before[1], text)))
                    within, before = at, None if ends else (doc, text)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*found), [some.column(2).type, *(k for _, _, k in _FIELDS)])],
                        ["doc_id", *(n for n, _, _ in _FIELDS)])

    placed = rows.select("doc_id", "text", "hash", F.posexplode(places("doc_id", "hash")).alias("ends", "range"))
    order = ["range", "ends", F.col("doc_id").asc_nulls_first(), "hash"]
    shape = f"doc_id {kind}, " + ", ".join(f"{n} {t}" for n, t, _ in _FIELDS)
    return (placed.repartition("range").sortWithinPartitions(*order).select("range", (F.col("ends") == 1).alias("ends"), "doc_id", "text")
            .mapInArrow(run, shape))
