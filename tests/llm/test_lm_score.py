"""Lattice scores: brute-force segmentations, contract columns, held-out gain."""

import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from quarterline.llm import common, lattice, lm_score, queries

PATH = public_tokenizers.path("piece_bpe_32k.model")


def toy():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba", "▁b", "aba"]
    vocab = lattice.vocabulary((p, -float(i)) for i, p in enumerate(pieces))
    logp = lattice.first_guess(vocab)
    at = {int(h): i + 256 for i, h in enumerate(vocab.hashes)}
    return vocab, logp, {p: logp[at[lattice._hash(p)]] for p in pieces}


def segmentations(text, known, logp):
    """All (log weight, pieces) of a text; unknown characters are spelled in bytes."""
    if not text:
        return [(0.0, [])]
    out = []
    for n in range(1, len(text) + 1):
        head = text[:n]
        if head in known:
            w = known[head]
        elif n == 1:
            w = sum(logp[b] for b in head.encode())
        else:
            continue
        out += [(w + v, [head, *rest]) for v, rest in segmentations(text[n:], known, logp)]
    return out


@pytest.mark.parametrize("short", [0, 24])
def test_marginals_and_expected_counts_match_enumeration(short, monkeypatch):
    monkeypatch.setattr(lattice, "_SHORT", short)  # all words with logarithms, short ones without
    vocab, logp, known = toy()
    words = ["a", "ab", "aba", "bababa", "xa", "é漢b", "abab" * 3]
    got = lattice.marginals(vocab, logp, words)
    counts = np.arange(1.0, len(words) + 1)
    uses = np.zeros(len(logp))
    at = {int(h): i + 256 for i, h in enumerate(vocab.hashes)}
    for w, g, c in zip(words, got, counts):
        every = segmentations("▁" + w, known, logp)
        total = math.log(sum(math.exp(v) for v, _ in every))
        assert g == pytest.approx(total, rel=1e-9)
        for v, parts in every:
            for p in parts:
                for i in ([at[lattice._hash(p)]] if p in known else p.encode()):
                    uses[i] += c * math.exp(v - total)
    assert lattice.expected(vocab, logp, words, counts) == pytest.approx(uses)


def test_urn_is_exchangeable_and_normalised():
    p = np.array([0.5, 0.3, 0.2])
    total = 0.0
    for a in range(3):
        for b in range(3):
            for c in range(3):
                n = Counter((a, b, c))
                k, t = np.array(list(n)), np.array(list(n.values()))
                total += math.exp(lm_score.urn(p[k], t, np.zeros(len(k), np.int64), 1)[0])
    assert total == pytest.approx(1.0)


def test_query_matches_contract(spark):
    path = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    rows = queries.QUERIES["op9_lm_score"](spark, path).collect()
    assert len(rows) == len(docs)
    train, n_docs = Counter(), 0
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in docs}
    for d, t in docs.items():
        if not held[d]:
            train.update(t.encode().lower().split())
            n_docs += 1
    tokens, kinds = sum(train.values()) + n_docs, len(train) + 1
    under = tokens + 0.5 * (kinds + 1)
    for r in rows:
        words = docs[r["doc_id"]].encode().lower().split()
        base = sum(math.log10((train[w] + 0.5) / under) for w in words) + math.log10((n_docs + 0.5) / under)
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(words) + 1, tokens)
        assert r["n_known"] == sum(w in train for w in words) + 1
        assert math.isfinite(r["lattice_score"]) and r["lattice_score"] < 0
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_lattice_score_is_the_marginal_of_the_words(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "CHUNK_DOCS", 2)  # words in many chunks,
    monkeypatch.setattr(lm_score, "PLACES", 3)  # in more than one row
    monkeypatch.setattr(lm_score, "ROWS", 4)
    texts = ["an old tale of old tales", "an other", "of zxq tales", "old an", "", "An old", "tales " * 5, "an an"] * 3
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = lm_score.score(docs, PATH, F.col("doc_id") % 5 == 1, rounds=0).collect()
    vocab = lm_score.load_vocabulary(PATH)
    logp = lattice.first_guess(vocab)
    train = [t.lower().split() for i, t in enumerate(texts) if i % 5 != 1]
    tokens = sum(map(len, train)) + len(train)
    end = (len(train) + 0.5) / (tokens + 1)
    assert len(got) == len(texts)
    for r in got:
        words = texts[r["doc_id"]].lower().split()
        want = sum(lattice.marginals(vocab, logp, words)) + len(words) * math.log1p(-end) + math.log(end)
        assert r["train_tokens"] == tokens and r["n_tokens"] == len(words) + 1
        assert r["lattice_score"] == pytest.approx(want / math.log(10), rel=1e-9)


def test_known_text_scores_above_unknown(spark):
    common_words = "the cat sat on the mat and the dog ran to the house by the river"
    rows = [(i, common_words, "x") for i in range(60)] + [(100, None, "n"), (101, "", "e"), (102, "zq xv jk qq wz", "u"), (None, "the cat", "i"),
                                                         (103, "the " * 20_000, "l"), (104, "x" * 3000, "w"), (104, "x" * 3000, "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = F.coalesce(common.crc_mod(F.col("doc_id"), 5) == 1, F.lit(False))
    got = lm_score.score(docs, PATH, out).collect()
    assert len(got) == len(rows) and all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[100]["score"] == by[101]["score"] and by[100]["n_tokens"] == 1
    known = next(r for r in got if r["doc_id"] is not None and r["doc_id"] < 60)
    assert known["score"] / known["n_tokens"] > by[102]["score"] / by[102]["n_tokens"]
    assert lm_score.score(docs.limit(0), PATH, out).count() == 0
    assert lm_score.score(docs.filter("doc_id = 102"), PATH, F.lit(True)).collect()[0]["train_tokens"] == 0
