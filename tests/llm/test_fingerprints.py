"""Fingerprints: edited texts and neighbours by brute force, estimates against exact shingle sets, merging."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarterline.llm import fingerprints, queries


def prose(rng, n, size=5000):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def exact(a, b):
    """(containment, jaccard) of the 5-word shingle sets."""
    def parts(text):
        words = text.split()
        return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} or ({tuple(words)} if words else set())

    x, y = parts(a), parts(b)
    if not x or not y:
        return float(x == y), float(x == y)
    return len(x & y) / min(len(x), len(y)), len(x & y) / len(x | y)


def check(rows, got):
    """Every figure that does not depend on the hashes, and the estimates against exact shares."""
    after = {d: rows[(i + 1) % len(rows)][1] or "" for i, (d, _) in enumerate(rows)}
    assert len(got) == len(rows)
    off = []
    for r in got:
        text = dict(rows)[r["doc_id"]] or ""
        moved = len(text) // 4
        edited = text[:len(text) - moved] + after[r["doc_id"]][:moved]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["fingerprint"] == fingerprints.to_text(fingerprints.sketch(text))
        assert r["edited_fingerprint"] == fingerprints.to_text(fingerprints.sketch(edited))
        for near, jaccard, other in (("near_edited", "jaccard_edited", edited), ("near_next", "jaccard_next", after[r["doc_id"]])):
            true = exact(text, other)
            assert 0 <= r[near] <= 1 and 0 <= r[jaccard] <= 1
            off += [abs(r[near] - true[0]), abs(r[jaccard] - true[1])]
            if len(text.split()) < fingerprints.AT_LEAST and len(other.split()) < fingerprints.AT_LEAST:
                assert (r[near], r[jaccard]) == pytest.approx(true)  # short texts are kept whole
    return off


def test_query_matches_brute_force(spark):
    path = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()]
    off = check(rows, queries.QUERIES["op11_fingerprint"](spark, path).collect())
    assert np.mean(off) < 0.03 and np.quantile(off, 0.99) < 0.25


def test_odd_rows_over_many_ranges(spark):
    rng = random.Random(1)
    texts = [None, "", " \t ", "one", "two words", prose(rng, 3000), prose(rng, 40), "é" * 4001, prose(rng, 17), "one"]
    rows = [(None, "first of all")] + [(i * 3 - 5, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"part": F.lit(1), "head": F.lit("x"), "_row": F.lit(2)})
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # about a row per range
    try:
        off = check(rows, fingerprints.against_next(docs.repartition(3)).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert np.mean(off) < 0.1


def test_repeated_rows_one_row_and_no_rows(spark):
    shape = "doc_id long, text string"
    same = fingerprints.against_next(spark.createDataFrame([(7, "a b c d e f g h")] * 50, shape)).collect()
    assert len(same) == 50 and len({tuple(r) for r in same}) == 1 and same[0]["near_next"] == 1.0
    one = fingerprints.against_next(spark.createDataFrame([(1, "x y z")], shape)).collect()
    assert [r["near_next"] for r in one] == [1.0]
    assert fingerprints.against_next(spark.createDataFrame([], shape)).collect() == []


def test_containment_of_a_short_text_in_a_long_one():
    rng = random.Random(2)
    off = []
    for _ in range(30):
        long_text = prose(rng, 20000)
        words = long_text.split()
        inside = " ".join(words[900:1300])
        half = " ".join(words[5000:5200]) + " " + prose(rng, 200)
        big = fingerprints.sketch(long_text)
        for text in (inside, half):
            got, jaccard = fingerprints.likeness(fingerprints.sketch(text), big)
            off.append(abs(got - exact(text, long_text)[0]))
            assert jaccard < 0.05
    assert np.mean(off) < 0.04 and max(off) < 0.2


def test_merged_sketches_equal_the_sketch_of_both():
    rng = random.Random(3)
    for sizes in ((3, 4), (10, 400), (500, 500), (0, 30), (12, 12)):
        a, b = prose(rng, sizes[0]), prose(rng, sizes[1])
        both = np.union1d(fingerprints.shingle_hashes(a), fingerprints.shingle_hashes(b))
        merged = fingerprints.merge(fingerprints.sketch(a), fingerprints.sketch(b))
        assert (merged == fingerprints._kept(both, fingerprints.FRACTION, fingerprints.AT_LEAST)).all()
        assert (fingerprints.from_text(fingerprints.to_text(merged)) == merged).all()


def test_group_sizes_and_kept_columns(spark):
    rng = random.Random(4)
    base = [prose(rng, 300) for _ in range(6)]
    rows = [(i, base[i % 6], "a" if i % 6 < 4 else "b") for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    prints = fingerprints.sketched(docs, into="print")
    assert prints.columns == ["doc_id", "text", "source", "print"]
    got = {r["source"]: r["n_kept"] for r in fingerprints.merged_sizes(prints, "source", fingerprint="print").collect()}
    for source, texts in (("a", base[:4]), ("b", base[4:])):
        hashes = np.unique(np.concatenate([fingerprints.shingle_hashes(t) for t in texts]))
        assert got[source] == int((hashes < 2 ** 62).sum())
