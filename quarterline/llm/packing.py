"""Best-fit packing of tokenised documents, certified by dual feasible functions.

Documents become token ids, closed by an end id; only longer ones are cut at
the sequence length.  Pieces go to partitions by hash.  Each partition packs
by best-fit decreasing and compares its bin count with a lower bound from
dual feasible functions (any such function of the fill sums to at most one
per bin).  A partition at its bound is certified and hands on only its
emptiest bin; one with a gap hands on all its open bins.  What was handed on
is dealt over as few groups as hold it, best-fit decreasing runs again, and a
result that needs fewer bins replaces the old one, until one group is left or
a round closes next to nothing.

Defined results: a NULL text is packed like an empty one (the end id alone);
a NULL id is kept; repeated rows are packed each; an empty table gives no
rows.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import partial, reduce
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarterline.llm import common

PIECES_PER_PARTITION = 20_000
LEAST_GAIN = 0.95  # an exchange that leaves more of the open pieces and bins than this is the last
CACHE_WORDS = 600_000  # of one generation
AT_ONCE = 128  # words in one call of the tokenizer; with more each takes longer
# The tokenizer's white space, and Python's, less the four that only Python splits at.
_PYTHON_ONLY = "\x1c\x1d\x1e\x1f"
_SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"  # an apostrophe may belong to a word
_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
# Letters that no normalizer changes and no pattern parts from each other.
_CLIP = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+")

PIECE = "doc_id long, no_id boolean, piece int, start long, length long, ids_crc32 long"


def latin_tokenizer(path: str):
    """For words of ``_LATIN`` letters with spaces between them: the ids of the tokenizer at ``path`` without its normalizers and patterns.

    None where these are not the ones known to leave such words alone.
    """
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    normal, parts = (spec.get(part) or {} for part in ("normalizer", "pre_tokenizer"))
    normal, parts = normal.get("normalizers", [normal] if normal else []), parts.get("pretokenizers", [])
    harmless = all(n["type"] in ("NFC", "Lowercase") or n == {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "} for n in normal)
    if not (harmless and [p["type"] for p in parts] == ["Split", "ByteLevel"]
            and parts[0] == {"type": "Split", "pattern": {"Regex": _CLIP}, "behavior": "Removed", "invert": True}
            and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]):
        return None
    plain = Tokenizer.from_file(path)
    plain.normalizer = None
    plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
    return plain


class Encoder:
    """Token ids of texts as little-endian 32-bit bytes.

    The tokenizer never joins characters across white space, so a text's ids
    are those of its words in order; each different word is encoded once.
    Words wait in two generations of a bounded table: when the younger is
    full it becomes the older, and words that are met again move back.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.latin = latin_tokenizer(path)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a word
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}  # of up to three signs after a word

    def _each(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _together(self, words: list[str], latin: bool = False) -> list[bytes]:
        """Words of letters in one call, cut apart at the ids that end a word."""
        tokenizer = self.latin if latin else self.tokenizer
        ids = np.array(tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (np.flatnonzero(self.closes[ids]) + 1) * 4
        if len(ends) != len(words):  # lower-casing gave some word a mark of its own
            return self._each(words)
        buffer, at = ids.tobytes(), ends.tolist()
        return [buffer[i:j] for i, j in zip([0, *at], at)]

    def _keep(self, words: set[str]) -> set[str]:
        """Moves words of the older generation to the younger; returns those of neither."""
        words = words.difference(self.known)
        new = words.difference(self.older)
        again = words - new
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        return new

    def _learn(self, words: set[str]) -> None:
        new = list(self._keep(words))
        text = "\n".join(new)
        # the tokenizer lower-cases each character alone; only a capital sigma differs in a word
        bodies = [w if "Σ" in w else w.lower() for w in new] if "Σ" in text else text.lower().split("\n")
        plain = list(map(str.isalpha, bodies))
        letters, other, marked, whole = set(compress(bodies, plain)), set(), [], []
        for w, body, is_plain in zip(new, bodies, plain):
            if is_plain:
                continue
            head = body.rstrip(_SIGNS)
            tail = body[len(head):]
            if 0 < len(tail) < 4 and head.isalpha():  # the tokenizer parts signs from letters
                if tail not in self.marks:
                    self.marks[tail] = self._each([tail])[0]
                marked.append((w, head, self.marks[tail]))
                letters.add(head)
            else:
                whole.append((w, body))
                other.add(body)
        known = self.known
        letters = self._keep(letters)
        latin = list(filter(_LATIN.fullmatch, letters)) if self.latin else []
        for all_, encode in ((latin, partial(self._together, latin=True)), (list(letters.difference(latin)), self._together),
                             (list(self._keep(other)), self._each)):
            for lo in range(0, len(all_), AT_ONCE):
                part = all_[lo:lo + AT_ONCE]
                known.update(zip(part, encode(part)))
        get = known.__getitem__
        known.update(zip(compress(new, plain), map(get, compress(bodies, plain))))
        for w, body in whole:
            known[w] = known[body]
        for w, body, mark in marked:
            known[w] = known[body] + mark

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > CACHE_WORDS:
            self.known, self.older = {}, self.known
        split = [_WORDS.findall(t) if any(c in t for c in _PYTHON_ONLY) else t.split() for t in texts]
        wanted: set[str] = set()
        for words in split:
            wanted.update(words)
        wanted = wanted.difference(self.known)
        if wanted:
            self._learn(wanted)
        get = self.known.__getitem__
        return [b"".join(map(get, words)) for words in split]


_encoders: dict[str, Encoder] = {}


def pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoders.get(tokenizer) or _encoders.setdefault(tokenizer, Encoder(tokenizer))
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                rows: list[tuple] = []
                for doc, ids in zip(part.column(0).to_pylist(),
                                    encoder.encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at:at + 4 * capacity]
                        rows.append((doc or 0, doc is None, i, at // 4, len(piece) // 4, zlib.crc32(piece)))
                if rows:
                    columns = list(zip(*rows))
                    kinds = (pa.int64(), pa.bool_(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)],
                        ["doc_id", "no_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(cut, PIECE)


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bin, offset) per item and the number of bins, by best-fit decreasing."""
    where = np.empty(len(lengths), np.int64)
    offset = np.empty(len(lengths), np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, bins = 0, 0  # bit r: some bin has r places left
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        fit = mask >> size
        if fit:
            left = size + (fit & -fit).bit_length() - 1
            b = open_bins[left].pop()
            if not open_bins[left]:
                mask ^= 1 << left
        else:
            left, b = capacity, bins
            bins += 1
        where[i], offset[i] = b, capacity - left
        left -= size
        if left:
            open_bins[left].append(b)
            mask |= 1 << left
    return where, offset, bins


def lower_bound(lengths: np.ndarray, capacity: int, stairs: int = 20) -> int:
    """No packing uses fewer bins: the best bound of two families of dual feasible functions."""
    count = np.bincount(lengths, minlength=capacity + 1).astype(np.int64)
    size = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * size).sum()) // capacity)
    for k in range(1, stairs + 1):  # floor((k+1) x) / k, and x itself where (k+1) x is whole; times k * capacity
        whole = (k + 1) * size % capacity == 0
        worth = np.where(whole, k * size, capacity * ((k + 1) * size // capacity))
        best = max(best, -(-int((count * worth).sum()) // (k * capacity)))
    half = capacity // 2
    upto = np.concatenate([[0], np.cumsum(count * size)])
    above = np.concatenate([np.cumsum(count[::-1])[::-1], [0]])
    t = np.arange(1, half + 1)  # items over capacity - t count as one, items under t as none
    bound = above[capacity - t + 1] + -(-(upto[capacity - t + 1] - upto[t]) // capacity)
    return max(best, int(bound.max())) if len(t) else best


STATE = PIECE + ", part long, sequence_id long, offset long, handed boolean, bins long, bound long"


def _packed(frame: pd.DataFrame, base: int, capacity: int) -> pd.DataFrame:
    lengths = frame["length"].to_numpy()
    where, offset, bins = best_fit(lengths, capacity)
    return _hand_on(frame.assign(sequence_id=base + where, offset=offset), capacity)


def _exchange(base: int, stride: int, capacity: int) -> Callable:
    """Packs one group of pieces; pieces that had bins before keep them unless the new packing needs fewer."""
    names = [f.split()[0] for f in STATE.split(", ")]

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        new = _packed(frame, base + int(key[0]) * stride, capacity)
        if "sequence_id" in frame and new["sequence_id"].nunique() >= frame["sequence_id"].nunique():
            new = _hand_on(frame, capacity)
        return new[names]

    return run


def _hand_on(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Marks the bins to exchange: all open ones, or the emptiest if certified."""
    fill = frame.groupby("sequence_id")["length"].sum()
    bound = lower_bound(frame["length"].to_numpy(), capacity)
    loose = fill[fill < capacity].sort_values(kind="stable")
    chosen = loose.index if len(fill) > bound else loose.index[:1]
    return frame.assign(handed=frame["sequence_id"].isin(chosen), bins=len(fill), bound=bound)


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    cut = common.staged(pieces(docs, tokenizer, capacity, end_id, id_col, text_col), "packing-pieces")
    full = cut.filter(F.col("length") == capacity)
    loose = cut.filter(F.col("length") < capacity)
    parts = max(1, -(-loose.count() // PIECES_PER_PARTITION))
    stride = 1 << 40  # sequence numbers of one group; a group never has as many bins

    # rows are numbered, so that repeated ones do not meet in one group
    spread = F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id())
    state = loose.withColumn("part", F.pmod(spread, F.lit(parts))).groupBy("part").applyInPandas(_exchange(0, stride, capacity), STATE)
    done, base, before = [], parts, None
    while parts > 1:
        state = common.staged(state, "packing-round")
        handed, bins = state.filter("handed").agg(F.count("*"), F.count_if(F.col("offset") == 0)).first()
        if before and handed + bins > LEAST_GAIN * before:
            break
        before = handed + bins
        done.append(state.filter(~F.col("handed")))
        parts = max(1, -(-handed // PIECES_PER_PARTITION))
        # bins stay whole; each round deals them anew
        state = (state.filter("handed").withColumn("part", F.pmod(F.xxhash64("sequence_id", F.lit(base)), F.lit(parts)))
                 .groupBy("part").applyInPandas(_exchange(base * stride, stride, capacity), STATE))
        base += parts
    done = reduce(DataFrame.union, done, state)
    columns = [F.when(~F.col("no_id"), F.col("doc_id")).alias("doc_id"), "piece", "start", "length", "ids_crc32"]
    alone = full.select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return done.select(*columns, "sequence_id", "offset").union(alone)
