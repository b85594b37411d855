"""Toxicity: held-out accuracy, the label model, odd rows."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from quarterline.llm import queries, toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    rows = queries.QUERIES["op6_toxicity"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) == docs
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    tp = fp = fn = tn = 0
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
        if r["held_out"] and r["doc_id"] in labels:
            y = labels[r["doc_id"]]
            tp, fp = tp + (y and r["predicted"]), fp + (not y and r["predicted"])
            fn, tn = fn + (y and not r["predicted"]), tn + (not y and not r["predicted"])
    assert tp / (tp + fn) >= 0.9 and tp / (tp + fp) >= 0.85 and tn / (tn + fp) >= 0.97


def test_label_model_recovers_classes_from_noisy_voters():
    rng = np.random.default_rng(1)
    y = rng.random(4000) < 0.15
    good = [np.where(y, rng.random(4000) < 0.6, rng.random(4000) < 0.02) for _ in range(6)]
    copy = [good[0].copy() for _ in range(4)]  # voters that repeat another count once
    bad = [rng.random(4000) < 0.2 for _ in range(3)]
    noisy = np.where(rng.random(4000) < 0.05, ~y, y).astype(int)
    q = toxicity.label_model(np.stack([*good, *copy, *bad], axis=1).astype(np.uint8), noisy)
    assert ((q > 0.5) == y).mean() > 0.98


def test_odd_rows_and_patterns(spark):
    rng = np.random.default_rng(0)
    clean = lambda: " ".join(f"w{i}" for i in rng.integers(0, 400, 30))
    rows = [(i, clean() + (" grumblefoot" if i % 5 == 0 else ""), "en") for i in range(400)]
    rows += [(1000, None, "x"), (1001, "", "x"), (1002, clean() + " GRUMBLEFOOTS!", "x"), (1003, clean() + " you 1d10t", "x"), (1004, clean() + " i d i o t", "x"),
             (1005, "word " * 20_000, "x"), (None, clean(), "x"), (1006, clean(), "x"), (1006, clean(), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i in range(400)] + [(3, None), (None, 1), (4, 0), (9999, 1)], "doc_id long, toxic int")
    use = F.lit(True)
    got = {}
    for r in toxicity.score(docs, labels, use).collect():
        got.setdefault(r["doc_id"], []).append(r["score"])
    assert sum(map(len, got.values())) == len(rows)
    assert all((got[i][0] >= 0.3) == (i % 5 == 0) for i in range(400))
    assert got[1000] == got[1001] and got[1000][0] < 0.3
    assert got[1002][0] >= 0.3 and got[1005][0] < 0.3
    kept = toxicity.drop_toxic(docs, labels, use)
    assert kept.columns == docs.columns and kept.filter("doc_id % 5 = 0 and doc_id < 400").count() == 0
    # without a single label the seed lexicon decides, through digits and spaces too
    none = {r["doc_id"]: r["score"] for r in toxicity.score(docs, labels.limit(0), use).collect()}
    assert none[1003] >= 0.3 and none[1004] >= 0.3 and none[1001] < 0.3
    assert toxicity.score(docs.limit(0), labels, use).count() == 0
