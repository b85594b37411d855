"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarterline.llm import queries, spelling

UPPER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(count):
    near = {w: [v for v in count if v != w and one_edit(w, v)] for w in count}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-count[v], v), default=None)
        form[w] = best if best is not None and count[best] >= 2 * count[w] else None
    out = []
    for w in count:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, count[w], len(near[w]), count[form[w]] if form[w] else None))
    return sorted(out)


def brute_words(rows):
    count = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(UPPER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                count[run] += 1
    return {w: c for w, c in count.items() if c >= 3}


@pytest.mark.parametrize("block", [3, 256])
def test_variants_match_brute_force(spark, block):
    rng = random.Random(block)
    words = set()
    for stem in ("letters", "baaaaa", "aaaaaa", "étéÿété", "日本語日本語", "wordwordword", "x" * 300):
        words.add(stem)
        for _ in range(40):
            w = list(stem)
            for _ in range(rng.randrange(1, 3)):
                i = rng.randrange(len(w))
                w[i:i + rng.randrange(2)] = rng.choice(["", "a", "b", "é", "語"])
            if len(w) >= 3:
                words.add("".join(w))
    count = {w: rng.choice([3, 3, 5, 6, 12, 50, 400]) for w in words if w}
    vocab = spark.createDataFrame(list(count.items()), "word string, n long")
    got = spelling.variants(vocab, block=block).collect()
    assert sorted(map(tuple, got)) == brute(count)


def test_words_odd_rows(spark):
    rows = [(1, "Hello HELLO hello, w0rld naïve×÷ÿ Éclair ÉCLAIR"), (1, "Hello HELLO hello, w0rld naïve×÷ÿ Éclair ÉCLAIR"),
            (None, "hello " * 300), (3, None), (4, ""), (5, "abcd" * 5000)]
    rows += [(i, "spelling speling spellings shorts short") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"word": F.lit(1), "run": F.lit("a"), "n": F.lit(2)})
    got = spelling.vocabulary(spelling.occurrences(docs)).collect()
    assert {r["word"]: r["n"] for r in got} == brute_words(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.vocabulary(spelling.occurrences(docs))).collect() == []


def test_query_matches_brute_force(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.QUERIES["op12_spelling"](spark, path).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted(map(tuple, got)) == brute(brute_words(rows))
