"""Toxicity by weak supervision: voters, a generative label model, a linear classifier.

Voters are lexicon words and patterns (word beginnings, and words restored
from digits, symbols, stretched or spaced letters).  Those beside a small
seed lexicon are mined from labelled rows.  The label model gives each voter
its rates of firing on either class by expectation maximisation over the
votes, with the label as one more voter of limited trust, and counts voters
that fire together beyond what the class explains for less (conditional
correlations).  A logistic regression over words and patterns then learns
the model's posterior labels and scores whole texts.

Training reads at most about ``train_rows`` labelled rows, chosen by a hash
of the id; everything the driver holds is bounded by that number.

Defined results: a NULL text scores like an empty one; without labelled rows
the seed lexicon alone votes; labels that repeat a document count once, toxic
if any is; NULL labels are ignored; repeated rows score alike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm import common

# Plain insults, voters even without a single labelled row.
SEED_LEXICON = ("idiot", "moron", "stupid", "scum", "loser", "pathetic", "worthless", "disgusting", "trash", "clown",
                "imbecile", "retard", "bastard", "bitch", "whore", "dumbass")
TRAIN_ROWS = 20_000
VOTERS = 400
FEATURES = 8_000
SURE, LEAST = 3.0, 0.35  # a feature's share of toxic rows, less so many standard deviations, must reach this
STARTS = (4, 5, 6, 7, 8)  # lengths of the word beginnings that serve as patterns

_WORD = re.compile(r"\w+")
_SPACED = re.compile(r"\b(?:\w[ .\-_*]){3,}\w\b")
_STRETCHED = re.compile(r"(.)\1{2,}")
_MARKED = re.compile(r"[a-z]*[@$!*0-9][@$!*0-9a-z]*[a-z]")
_LEET = str.maketrans("013457@$!", "oieastasi")


class Model(NamedTuple):
    index: dict[str, int]
    starts: frozenset[str]
    weights: np.ndarray
    bias: float


def _words(text: str) -> set[str]:
    low = text.lower()
    words = set(_WORD.findall(low))
    for m in _SPACED.findall(low):
        words.add("".join(c for c in m if c.isalnum()))
    for m in _MARKED.findall(low):
        words.add(m.translate(_LEET).replace("*", ""))
    return words


def features(words: set[str]) -> set[str]:
    """``w:word`` and ``s:beginning`` of every word, also of its stretched letters undone."""
    out = set()
    for w in words:
        out.add("w:" + w)
        if _STRETCHED.search(w):
            out.add("w:" + _STRETCHED.sub(r"\1", w))
        for n in STARTS:
            if len(w) > n:
                out.add("s:" + w[:n])
    return out


def _known(model: Model, text: str) -> list[int]:
    """Indexes of the model's features in a text; words that share no beginning with any are passed over."""
    near = [w for w in _words(text) if w[:4] in model.starts or _STRETCHED.search(w)]
    index = model.index
    return [index[f] for f in features(set(near)) if f in index]


def labelled_sample(docs: DataFrame, labels: DataFrame, use: Column, train_rows: int) -> DataFrame:
    """``(text, y)`` of about ``train_rows`` labelled documents for which ``use`` (over ``doc_id``) holds."""
    known = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & use)
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("y")))
    known = common.staged(known, "toxicity-labels")
    n = known.count()
    share = int(min(1.0, train_rows / max(1, n)) * 1_000_000)
    known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1_000_000)) < share)
    # at most about train_rows ids of a few bytes
    return common.staged(docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("text", "y"),
                         "toxicity-sample")


def _mine(sample: DataFrame) -> tuple[pd.DataFrame, int, int]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        bad: Counter = Counter()
        for batch in batches:
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = features(_words(text or "")) | {"n:"}
                seen.update(found)
                if y:
                    bad.update(found)
        keys = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[k] for k in keys], pa.int64()),
                                          pa.array([bad[k] for k in keys], pa.int64())], ["f", "n", "bad"])

    table = (sample.mapInArrow(count, "f string, n long, bad long")
             .groupBy("f").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")))
    table = common.staged(table.filter((F.col("bad") >= 3) | (F.col("f") == "n:")
                                       | F.col("f").isin(*["w:" + w for w in SEED_LEXICON])), "toxicity-counts")
    head = table.filter("f = 'n:'").first()
    rows, toxic = (head["n"], head["bad"]) if head else (0, 0)
    if not toxic or toxic == rows:
        return pd.DataFrame({"f": ["w:" + w for w in SEED_LEXICON], "n": 0, "bad": 0, "odds": 0.0}), rows, toxic
    # lower end of Wilson's interval for the share of toxic rows among those with the feature
    n, share, z2 = F.col("n"), F.col("bad") / F.col("n"), SURE ** 2
    low = (share + z2 / (2 * n) - SURE * F.sqrt(share * (1 - share) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    best = (table.filter("f <> 'n:'").withColumn("odds", low).filter(F.col("odds") >= max(LEAST, min(0.9, 2 * toxic / rows)))
            .orderBy(F.desc(F.col("odds") * F.log1p("bad")), "f").limit(FEATURES))  # a bounded top list
    return best.toPandas(), rows, toxic


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 15, trust: float = 0.97) -> np.ndarray:
    """Posterior of the toxic class per row from ``votes`` (rows x voters, 0/1) and noisy ``labels``."""
    n, m = votes.shape
    if not n:
        return np.zeros(0)
    fires = votes.astype(np.float64)
    q = np.clip(labels.astype(np.float64), 0.05, 0.95)
    for _ in range(rounds):
        prior = np.clip(q.mean(), 1e-3, 1 - 1e-3)
        on = (q @ fires + 0.5) / (q.sum() + 2)
        off = ((1 - q) @ fires + 0.05) / ((1 - q).sum() + 2)
        # what voters share beyond the class: correlation of their residuals
        rest = fires - q[:, None] * on - (1 - q)[:, None] * off
        spread = np.sqrt((rest ** 2).sum(axis=0)) + 1e-9
        together = np.clip(rest.T @ rest / np.outer(spread, spread), 0, 1)
        np.fill_diagonal(together, 1)
        count = 1 / together.sum(axis=1)
        agree = np.clip((q * labels + (1 - q) * (1 - labels)).mean(), 0.5, trust)
        log_odds = np.log(prior / (1 - prior)) + (2 * labels - 1) * np.log(agree / (1 - agree))
        log_odds = log_odds + fires @ (count * np.log(on / off)) + (1 - fires) @ (count * np.log((1 - on) / (1 - off)))
        new = 1 / (1 + np.exp(-np.clip(log_odds, -30, 30)))
        if np.abs(new - q).max() < 1e-4:
            q = new
            break
        q = new
    return q


def _regression(rows: list[np.ndarray], target: np.ndarray, m: int, steps: int = 1000, l2: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on binary features, full-batch Adam.

    Every feature was chosen as a sign of toxicity, so weights stay at or
    above zero: a long text cannot outweigh one sign by many others.
    """
    sizes = np.array([len(r) for r in rows])
    at = np.concatenate(rows).astype(np.int64) if sizes.sum() else np.zeros(0, np.int64)
    row = np.repeat(np.arange(len(rows)), sizes)
    p = np.zeros(m + 1)
    mean, square = np.zeros(m + 1), np.zeros(m + 1)
    for t in range(1, steps + 1):
        z = np.bincount(row, p[at], minlength=len(rows)) + p[m]
        err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / len(rows)
        grad = np.append(np.bincount(at, err[row], minlength=m), err.sum())
        grad[:m] += l2 * p[:m] / max(1, m)
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad ** 2
        p -= 0.1 * (1 - t / (steps + 1)) * (mean / (1 - 0.9 ** t)) / (np.sqrt(square / (1 - 0.999 ** t)) + 1e-9)
        p[:m] = np.maximum(p[:m], 0)
    return p[:m], float(p[m])


def _thinned(rows: list[np.ndarray], target: np.ndarray, copies: int = 4, keep: float = 0.35) -> tuple[list[np.ndarray], np.ndarray]:
    """The rows and copies of them with some features left out, so that one sign alone has to carry a text."""
    rng = np.random.default_rng(0)
    out, posterior = list(rows), list(target)
    for r, q in zip(rows, target):
        for _ in range(copies if len(r) > 1 else 0):
            some = r[rng.random(len(r)) < keep]
            if len(some):
                out.append(some)
                posterior.append(q)
    return out, np.array(posterior)


def fit(docs: DataFrame, labels: DataFrame, use: Column, train_rows: int = TRAIN_ROWS) -> Model:
    """The scoring model, learned from labelled rows for which ``use`` holds."""
    sample = labelled_sample(docs, labels, use, train_rows)
    table, n_rows, toxic = _mine(sample)
    names = list(dict.fromkeys([*table["f"], *("w:" + w for w in SEED_LEXICON)]))
    index = {f: i for i, f in enumerate(names)}
    starts = frozenset(f[2:6] for f in names)
    empty = Model(index, starts, np.zeros(len(names)), 0.0)
    seeds = np.array([index["w:" + w] for w in SEED_LEXICON])
    if not toxic or toxic == n_rows:  # nothing to learn from
        weights = np.zeros(len(names))
        weights[seeds] = 6.0
        return empty._replace(weights=weights, bias=-4.0)

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [_known(empty, t or "") for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), batch.column(1)], ["found", "y"])

    seen = sample.mapInArrow(vote, "found array<int>, y int").toPandas()  # a short list for each training row
    rows = [np.asarray(r, dtype=np.int64) for r in seen["found"]]
    y = seen["y"].to_numpy(dtype=np.int64)
    voters = np.unique(np.concatenate([np.arange(min(VOTERS, len(table))), seeds]))
    column = np.full(len(names), -1)
    column[voters] = np.arange(len(voters))
    votes = np.zeros((len(rows), len(voters)), dtype=np.uint8)
    for i, r in enumerate(rows):
        c = column[r]
        votes[i, c[c >= 0]] = 1
    weights, bias = _regression(*_thinned(rows, label_model(votes, y)), len(names))
    return empty._replace(weights=weights, bias=bias)


def scorer(docs: DataFrame, model: Model):
    """A column function text -> score over the session of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # at most FEATURES entries

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        m = shared.value
        z = np.array([m.weights[_known(m, t)].sum() if t else 0.0 for t in texts]) + m.bias
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))), dtype="float64")

    return score


def score(docs: DataFrame, labels: DataFrame, use: Column, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``(doc_id, score)`` for every row of ``docs``."""
    return docs.select("doc_id", scorer(docs, fit(docs, labels, use, train_rows))("text").alias("score"))


def drop_toxic(docs: DataFrame, labels: DataFrame, use: Column, reject_at: float = 0.3,
               train_rows: int = TRAIN_ROWS) -> DataFrame:
    """The rows of ``docs`` that score under ``reject_at``, with their columns."""
    return docs.filter(scorer(docs, fit(docs, labels, use, train_rows))("text") < reject_at)
