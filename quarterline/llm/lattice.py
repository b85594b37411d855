"""Subword lattices of words in bulk: forward, backward and expected piece counts in log space.

A word is read as ``▁`` and its characters.  Every piece of the vocabulary
that matches at a place is an edge; a character without a piece of its own is
an edge of its UTF-8 bytes.  Words of one length run together in numpy.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np

START = "▁"
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>$")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_CELLS = 200_000
_SHORT = 24  # characters of a word whose probabilities need no logarithms


class Vocabulary(NamedTuple):
    """Pieces by hash; ids below 256 are bytes, piece ``i`` of the sorted hashes has id ``256 + i``."""

    hashes: np.ndarray
    maybe: np.ndarray  # 2^22 flags by the top bits of a hash
    longest: int
    scores: np.ndarray  # the vocabulary's own scores by id; NaN for bytes


def _hash(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
    return h


def vocabulary(pieces: Iterator[tuple[str, float]]) -> Vocabulary:
    """From (piece, score); byte pieces, specials and pieces that cross a word start are left out."""
    found = {}
    for piece, score in pieces:
        if piece and not _BYTE.match(piece) and START not in piece[1:] and not re.fullmatch(r"<[a-z]+>|</s>", piece):
            found[_hash(piece)] = (len(piece), score)
    hashes = np.array(sorted(found), dtype=np.uint64)
    maybe = np.zeros(1 << 22, dtype=bool)
    maybe[(hashes >> np.uint64(42)).astype(np.int64)] = True
    scores = np.concatenate([np.full(256, np.nan), [found[int(h)][1] for h in hashes]])
    return Vocabulary(hashes, maybe, max(n for n, _ in found.values()), scores)


def first_guess(vocab: Vocabulary) -> np.ndarray:
    """Log probabilities by id from the vocabulary's scores: the k-th best piece gets a share of 1 / (k + 3)."""
    rank = np.empty(len(vocab.hashes))
    rank[np.argsort(-vocab.scores[256:], kind="stable")] = np.arange(len(vocab.hashes))
    p = np.concatenate([np.full(256, 1e-6), 1 / (rank + 3)])
    return np.log(p / p.sum())


def _edges(vocab: Vocabulary, logp: np.ndarray, codes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray], dict[int, list[int]]]:
    """Per length l: piece ids (words x starts; -1 none) and their log probabilities; bytes of unknown characters."""
    n, size = codes.shape
    ids, weights, spelled = [], [], {}
    h = np.zeros((n, size), dtype=np.uint64)
    add = codes.astype(np.uint64) + np.uint64(1)
    for l in range(1, min(vocab.longest, size) + 1):
        starts = size - l + 1
        h = h[:, :starts] * _BASE + add[:, l - 1:]
        flat = h.ravel()
        at = np.flatnonzero(vocab.maybe[(flat >> np.uint64(42)).astype(np.int64)])
        slot = np.minimum(np.searchsorted(vocab.hashes, flat[at]), len(vocab.hashes) - 1)
        good = vocab.hashes[slot] == flat[at]
        piece = np.full(flat.shape, -1, dtype=np.int32)
        piece[at[good]] = slot[good] + 256
        weight = np.full(flat.shape, -np.inf)
        weight[at[good]] = logp[piece[at[good]]]
        if l == 1:
            missing = np.flatnonzero(piece < 0)
            if len(missing):
                chars, where = np.unique(codes.ravel()[missing], return_inverse=True)
                spelled = {int(c): list(chr(c).encode("utf-8", "surrogatepass")) for c in chars}
                weight[missing] = np.array([logp[spelled[int(c)]].sum() for c in chars])[where]
        ids.append(piece.reshape(n, starts))
        weights.append(weight.reshape(n, starts))
    return ids, weights, spelled


def _sum(terms: np.ndarray) -> np.ndarray:
    """log of the sum of exponentials over the last axis; every row has a finite term."""
    top = terms.max(axis=-1)
    return top + np.log(np.exp(terms - top[..., None]).sum(axis=-1))


def _forward(weights: list[np.ndarray]) -> np.ndarray:
    n, size = weights[0].shape
    alpha = np.zeros((n, size + 1))
    for j in range(1, size + 1):
        alpha[:, j] = _sum(np.stack([alpha[:, j - l] + weights[l - 1][:, j - l] for l in range(1, min(len(weights), j) + 1)], axis=1))
    return alpha


def _groups(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, code points) of words of one length, some cells at a time."""
    length = np.array([len(w) for w in words])
    order = np.argsort(length, kind="stable")
    lo = 0
    while lo < len(order):
        size = int(length[order[lo]])
        hi = min(int(np.searchsorted(length[order], size, side="right")), lo + max(1, _CELLS // (size + 1)))
        some = order[lo:hi]
        text = "".join(words[i] for i in some).encode("utf-32-le", "surrogatepass")
        codes = np.empty((len(some), size + 1), dtype=np.uint32)
        codes[:, 0] = ord(START)
        codes[:, 1:] = np.frombuffer(text, dtype="<u4").reshape(len(some), size)
        yield some, codes
        lo = hi


def marginals(vocab: Vocabulary, logp: np.ndarray, words: list[str]) -> np.ndarray:
    """Natural log of the probability of each word, summed over all its segmentations."""
    out = np.empty(len(words))
    for some, codes in _groups(words):
        _, weights, _ = _edges(vocab, logp, codes)
        out[some] = _forward(weights)[:, -1]
    return out


def _uses(weights: list[np.ndarray]) -> list[np.ndarray]:
    """Probability of every edge in a segmentation drawn at random, by length and start."""
    n, size = weights[0].shape
    if size > _SHORT:
        alpha = _forward(weights)
        beta = np.zeros((n, size + 1))
        for i in range(size - 1, -1, -1):
            beta[:, i] = _sum(np.stack([beta[:, i + l] + weights[l - 1][:, i] for l in range(1, min(len(weights), size - i) + 1)], axis=1))
        return [np.exp(alpha[:, :size - l + 1] + w + beta[:, l:] - alpha[:, -1:]) for l, w in enumerate(weights, 1)]
    # against the reading by single characters, the probabilities of short words stay within floats
    single = np.zeros((size + 1, n))
    single[1:] = np.cumsum(weights[0].T, axis=0)
    odds = [np.exp(w.T - (single[l:] - single[:size - l + 1])) for l, w in enumerate(weights, 1)]
    some = [l for l, o in enumerate(odds, 1) if o.any()]
    alpha, beta = np.zeros((size + 1, n)), np.zeros((size + 1, n))
    alpha[0] = beta[size] = 1.0
    for j in range(1, size + 1):
        for l in some:
            if l <= j:
                alpha[j] += alpha[j - l] * odds[l - 1][j - l]
    for i in range(size - 1, -1, -1):
        for l in some:
            if l <= size - i:
                beta[i] += beta[i + l] * odds[l - 1][i]
    return [(alpha[:size - l + 1] * o * beta[l:] / alpha[-1]).T for l, o in enumerate(odds, 1)]


def expected(vocab: Vocabulary, logp: np.ndarray, words: list[str], counts: np.ndarray) -> np.ndarray:
    """Expected uses of every id over ``counts`` occurrences of the words."""
    total = np.zeros(len(logp))
    for some, codes in _groups(words):
        ids, weights, spelled = _edges(vocab, logp, codes)
        times = counts[some][:, None]
        for l, (piece, share) in enumerate(zip(ids, _uses(weights)), 1):
            known = piece >= 0
            used = share * times
            total += np.bincount(piece[known], used[known], minlength=len(total))
            if l == 1 and spelled:
                for c, spelling in spelled.items():
                    part = used[(codes == c) & ~known].sum()
                    for b in spelling:
                        total[b] += part
    return total
