"""Spelling variant grouping by dense prefix-suffix tiling.

Two words are near when one code point inserted, deleted or replaced turns one
into the other: their common prefix and common suffix together are then at
least one shorter than the longer word.  The words of a tile lie in padded
code-point matrices, left- and right-aligned, and every pair of its blocks is
compared column by column.

A single edit leaves the first or the last half of the shorter word as it is,
so tiles are made per length class and half word; no near pair lies outside
them.  A half shared by more than ``BLOCK`` words is cut into blocks and each
pair of blocks is a tile of its own, so no task holds a whole hot group.  Tiles
return counts and best candidates per word, never pairs.

Defined results: a NULL text has no words; a NULL id reads as an empty text in
front of the colon; repeated rows count each time; an empty table gives no
words; other columns are ignored.  Words of any length and script are compared
whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm import common

# Rows of a block; small tiles are compared together up to this many rows.
BLOCK = 256
_FOUND = "word string, n_near long, near_n long, near_word string"


def occurrences(docs: DataFrame, min_length: int = 5, drop_every: int = 97) -> DataFrame:
    """``(word)`` per run of letters, lower-cased (A-Z only), with one code point dropped in some.

    ``drop_every``: runs whose crc32 with the document's id this number
    divides lose a code point.  Runs shorter than ``min_length`` cannot give a
    word and are left out at once.
    """
    runs = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all("text", F.lit(rf"([A-Za-zÀ-ÿ]{{{min_length},}})"), 1)).alias("run"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    runs = runs.withColumn("run", F.translate("run", upper, upper.lower()))
    h, run = F.col("h"), F.col("run")
    at = (h % F.length("run")).cast("int")
    dropped = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length("run")))
    runs = runs.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    return runs.select(F.when(h % drop_every == 0, dropped).otherwise(run).alias("word"))


def vocabulary(words: DataFrame, min_length: int = 5, min_count: int = 3) -> DataFrame:
    """``(word, n)`` of the words that are long and frequent enough."""
    counts = words.where(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= min_count)


def _halves(vocab: DataFrame) -> DataFrame:
    """``(word, n, span, side, part)``: every half word under which a near word may lie.

    ``span`` is the length of the shorter word of a pair, so each word serves
    its own length and the one below.
    """
    word, size = F.col("word"), F.length("word")

    def half(span: Column, side: int) -> Column:
        cut = F.floor(span / 2).cast("int")
        part = F.substring(word, F.lit(1), cut) if side == 0 else F.substring(word, size - (span - cut) + 1, span - cut)
        return F.struct(span.cast("int").alias("span"), F.lit(side).alias("side"), part.alias("part"))

    keys = F.array(*[half(span, side) for span in (size, size - 1) for side in (0, 1)])
    return vocab.select("word", "n", F.explode(keys).alias("key")).select("word", "n", "key.*")


def tiles(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(tile, two, second, word, n, span, side)``: the rows of each tile.

    ``two``: the tile compares two blocks with each other, ``second`` marks
    the rows of its second block.
    """
    keys = _halves(vocab)
    of = ["span", "side", "part"]
    sizes = keys.groupBy(*of).agg(F.count("*").alias("rows"))
    blocks = F.ceil(F.col("rows") / block).cast("int")
    # a half that only one word has can hold no pair
    rows = keys.join(sizes.where(F.col("rows") > 1).withColumn("blocks", blocks), of)
    mine = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    rows = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    return rows.select(F.struct(*of, low.alias("i"), high.alias("j")).alias("tile"), (F.col("mine") != F.col("other")).alias("two"),
                       (F.col("mine") > F.col("other")).alias("second"), "word", "n", "span", "side")


def _matrix(words: list[str], right: bool) -> np.ndarray:
    """Code points of the words, one column per place, padded with zeros on the other side."""
    width = max(map(len, words))
    pad = str.rjust if right else str.ljust
    text = "".join(pad(w, width, "\0") for w in words)
    try:
        flat = np.frombuffer(text.encode("latin-1"), dtype=np.uint8)
    except UnicodeEncodeError:
        flat = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    grid = flat.reshape(len(words), width)
    return np.ascontiguousarray(grid[:, ::-1].T if right else grid.T)


def _shared(left: np.ndarray, rows: slice, cols: slice) -> np.ndarray:
    """Length of the common start of every pair of ``rows`` and ``cols``, by comparing one column after the other."""
    alive = np.ones((rows.stop - rows.start, cols.stop - cols.start), dtype=bool)
    count = np.zeros(alive.shape, dtype=np.int32 if len(left) > 250 else np.uint8)
    for place in left:
        alive &= place[rows, None] == place[None, cols]
        if not alive.any():
            break
        count += alive
    return count


def _near_pairs(words: list[str], span: np.ndarray, side: np.ndarray, group: np.ndarray, two: np.ndarray,
                second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indexes ``(a, b)`` of the near pairs of one batch of tiles, each pair once."""
    starts, ends = _matrix(words, False), _matrix(words, True)
    size = np.array([len(w) for w in words], dtype=np.int32)
    found_a, found_b = [], []
    step = BLOCK
    for lo in range(0, len(words), step):
        for lo2 in range(lo, len(words), step):
            if group[min(lo + step, len(words)) - 1] < group[lo2]:
                break  # rows are sorted by tile
            r, c = slice(lo, min(lo + step, len(words))), slice(lo2, min(lo2 + step, len(words)))
            longer = np.maximum(size[r, None], size[None, c])
            shorter = np.minimum(size[r, None], size[None, c])
            # the pair belongs to this tile's length class, and to its own blocks only
            ok = (group[r, None] == group[None, c]) & (shorter == span[r, None])
            ok &= (longer - shorter <= 1) & (~two[r, None] | (second[r, None] != second[None, c]))
            if lo == lo2:
                ok &= np.arange(lo, r.stop)[:, None] < np.arange(lo2, c.stop)[None, :]
            if not ok.any():
                continue
            prefix, suffix = _shared(starts, r, c).astype(np.int32), _shared(ends, r, c).astype(np.int32)
            ok &= prefix + suffix >= longer - 1
            # pairs that share the first half too were met under it
            ok &= (side[r, None] == 0) | (prefix < span[r, None] // 2)
            a, b = np.nonzero(ok)
            found_a.append(a + lo)
            found_b.append(b + lo2)
    if not found_a:
        none = np.zeros(0, dtype=np.int64)
        return none, none
    return np.concatenate(found_a), np.concatenate(found_b)


def _summed(words: list[str], n: list[int], a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    """Per word of the pairs: how many near words, and the one of largest n (ties: smallest)."""
    best: dict[str, list] = {}
    for x, y in zip(np.concatenate([a, b]).tolist(), np.concatenate([b, a]).tolist()):
        mine, rank = best.setdefault(words[x], [0, (0, "")]), (-n[y], words[y])
        mine[0] += 1
        mine[1] = min(mine[1], rank) if mine[0] > 1 else rank
    return pa.RecordBatch.from_arrays(
        [pa.array(best, pa.string()), pa.array([v[0] for v in best.values()], pa.int64()),
         pa.array([-v[1][0] for v in best.values()], pa.int64()), pa.array([v[1][1] for v in best.values()], pa.string())],
        ["word", "n_near", "near_n", "near_word"])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of the tiles, which come one after another; whole small tiles are compared together."""
    kept: list[pa.RecordBatch] = []
    rows = 0

    def run(table: pa.Table) -> pa.RecordBatch:
        code = table.column("tile").combine_chunks()
        same = np.ones(len(code), dtype=bool)
        for field in code.flatten():
            values = field.dictionary_encode().indices.to_numpy()
            same[1:] &= values[1:] == values[:-1]
        same[0] = False
        words, n = table.column("word").to_pylist(), table.column("n").to_pylist()
        flat = {c: table.column(c).to_numpy() for c in ("span", "side", "two", "second")}
        a, b = _near_pairs(words, flat["span"], flat["side"], np.cumsum(~same), flat["two"], flat["second"])
        return _summed(words, n, a, b)

    def key(batch: pa.RecordBatch, i: int) -> dict:
        return batch.column("tile")[i].as_py()

    for batch in batches:
        while batch.num_rows:
            if rows < BLOCK:  # open: take more
                take = min(batch.num_rows, BLOCK - rows)
            elif key(batch, 0) == key(kept[-1], kept[-1].num_rows - 1):  # the last tile goes on: take its rows
                last, lo, hi = key(batch, 0), 1, batch.num_rows
                while lo < hi:
                    mid = (lo + hi) // 2
                    lo, hi = (mid + 1, hi) if key(batch, mid) == last else (lo, mid)
                take = lo
            else:
                yield run(pa.Table.from_batches(kept))
                kept, rows = [], 0
                continue
            kept.append(batch.slice(0, take))
            rows += take
            batch = batch.slice(take)
    if rows:
        yield run(pa.Table.from_batches(kept))


def near_words(vocab: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(word, n_near, near_n, near_word)`` of every word that has a near one."""
    rows = tiles(vocab, block)
    found = (rows.repartition("tile").sortWithinPartitions("tile")
             .select("tile", "two", "second", "word", "n", "span", "side").mapInArrow(_compare, _FOUND))
    top = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near_word").alias("word")))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), top.alias("top"))
            .select("word", "n_near", (-F.col("top.rank")).alias("near_n"), F.col("top.word").alias("near_word")))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` for ``forms(word, form)``: the end of each chain, by doubling its steps.

    Counts at least double from word to form, so a chain has at most 63 steps
    and the loop ends after seven rounds at the latest.
    """
    current = common.staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        step = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        current = common.staged(current.join(step, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        if current.where("moved").isEmpty():
            return current.select("word", "root")


def variants(vocab: DataFrame, ratio: int = 2, block: int = BLOCK) -> DataFrame:
    """Each word of ``vocab(word, n)`` with its form, root and near-word count.

    A word's form is its near word of largest n (ties: smallest in code-point
    order) if that n is at least ``ratio`` (2 or more) times its own.
    """
    vocab = common.staged(vocab.select("word", "n"), "spelling-words")
    near = vocab.join(near_words(vocab, block), "word", "left")
    usual = F.col("near_n") >= ratio * F.col("n")
    told = common.staged(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(usual, F.col("near_word")).alias("form"),
        F.when(usual, F.col("near_n")).alias("form_n")), "spelling-forms")
    ends = roots(told.where("form is not null"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
