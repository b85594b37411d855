"""SimHash: fingerprints and components against brute force."""

import numpy as np
import pytest
import xxhash

from quarterline.llm import queries, simhash

WS = " \t\n\x0b\x0c\r"


def brute_print(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = low.translate({ord(c): " " for c in WS}).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    parts = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(ids, prints, bits=3):
    p = np.array(prints, dtype=np.uint64)
    parent = list(range(len(p)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(p)):
        for j in np.flatnonzero(np.bitwise_count(p ^ p[i]) <= bits):
            parent[top(i)] = top(int(j))
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[top(i)] = min(least.get(top(i), d), d)
    return [least.get(top(i)) for i in range(len(p))]


def test_query_matches_brute_force(spark):
    path = "/root/testdata/sf0.01"
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{path}/documents.parquet").collect()}
    got = queries.QUERIES["op8_simhash_dedup"](spark, path).collect()
    assert len(got) == len(text)
    ids = [r["doc_id"] for r in got]
    prints = [brute_print(text[d]) for d in ids]
    assert [r["fingerprint"] for r in got] == [f"{p:016x}" for p in prints]
    assert [r["component_id"] for r in got] == brute_groups(ids, prints)


@pytest.mark.parametrize("bits", [0, 1, 3, 4, 6])
@pytest.mark.parametrize("hot", [1, 64])
def test_links_connect_all_near_prints(spark, monkeypatch, bits, hot):
    monkeypatch.setattr(simhash, "HOT_SLOT", hot)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    rng = np.random.default_rng(bits)
    seeds = rng.integers(-2 ** 63, 2 ** 63 - 1, 12)
    prints = set(map(int, seeds))
    for s in seeds:  # clouds of near prints, many in one slot
        for _ in range(25):
            x = int(s)
            for b in rng.integers(0, 64, rng.integers(1, 7)):
                x ^= 1 << int(b) if b < 63 else -(1 << 63)
            prints.add(x)
    prints = sorted(prints)
    fps = spark.createDataFrame([(p,) for p in prints], "fp long")
    edges = [(r["a"], r["b"]) for r in simhash.links(fps, bits).collect()]
    u = np.array(prints, dtype=np.int64).view(np.uint64)
    for a, b in edges:
        assert bin((a ^ b) & (2 ** 64 - 1)).count("1") <= bits or hot == 1
    at = {p: i for i, p in enumerate(prints)}
    parent = list(range(len(prints)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[top(at[a])] = top(at[b])
    want = brute_groups(list(range(len(prints))), u, bits)
    mine = {}
    for i in range(len(prints)):
        mine.setdefault(top(i), []).append(i)
    assert sorted(map(tuple, mine.values())) == sorted(
        tuple(i for i in range(len(prints)) if want[i] == w) for w in sorted(set(want)))


def test_odd_rows(spark):
    rows = [(7, None, "x"), (3, "", "y"), (9, " \t ", "z"), (1, "a b", "p"), (2, "A  B", "q"), (None, "A b", "r"), (None, "only here once", "s"),
            (4, "w " * 30_000, "t"), (4, "w " * 30_000, "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(docs).collect()), key=repr)
    assert got == sorted([(7, 3), (3, 3), (9, 3), (1, 1), (2, 1), (None, 1), (None, None), (4, 4), (4, 4)], key=repr)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["fp"]) for r in kept.collect() if r["doc_id"] is not None) == [(1, "p"), (3, "y"), (4, "t")]
    assert kept.filter("doc_id is null").count() == 1
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_probes_are_not_broadcast(spark, monkeypatch):
    """Fewer bytes than the limit of broadcasts before the explode, by Spark's estimate after it too."""
    plans = []

    def staged(df, name, write=simhash.common.staged):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    monkeypatch.setattr(simhash.common, "staged", staged)
    found = simhash.links(spark.range(300).selectExpr("xxhash64(id) AS fp"))
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 2 and not [p for p in plans if "Broadcast" in p]
