"""Conversation prefix trie against a trie of plain tuples."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quarterline.llm import prefix_trie, queries

SHAPE = "conv_id long, turn long, role string, text string"


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [t[2] for t in sorted(v, key=lambda t: t[:2])] for c, v in own.items()}
    built = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(base, [])[:h] + mine[h:])
    members = {}
    for c, s in built.items():
        for d in range(len(s) + 1):
            members.setdefault(s[:d], []).append(c)
    out = []
    for p, who in members.items():
        under = [q for q in members if q[:len(p)] == p]
        kids = [q for q in under if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in under) for q in under)
        saved = sum((len(members[q]) - 1) * len(q[-1][1]) for q in under if q)
        ends = ",".join(str(c) for c in sorted(who) if built[c] == p)
        out.append((min(who), len(p), min(members[p[:-1]]) if p else None, len(who), len(kids), leaves, saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def run(spark, rows, shard_turns):
    df = spark.createDataFrame(rows, SHAPE).withColumns({"p1": F.lit("x"), "sid": F.lit(1), "shard": F.lit(2)})
    both, members = prefix_trie.borrowed(prefix_trie.turns(df))
    got = prefix_trie.nodes(both, members, shard_turns=shard_turns).collect()
    return sorted((tuple(r) for r in got), key=lambda r: r[:2])


def talk(seed, n, words=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        length = rng.choice([0, 1, 2, 3, 5, 9])
        for t in range(length):
            rows.append((c * 7 % 1000 - 20, t, rng.choice(["user", "bot", None]), rng.choice(["a", "bb", "", None][:words])))
    return rows


@pytest.mark.parametrize("shard_turns", [24, 200_000])
def test_nodes_match_brute_force(spark, shard_turns):
    rows = talk(shard_turns, 60)
    assert run(spark, rows, shard_turns) == brute(rows)


def test_hot_prefix_copies_long_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 3)
    rows = [(c, t, "user", f"shared {t}") for c in range(100, 130) for t in range(8)]  # copies
    rows += [(c, 8, "user", f"own {c % 4}") for c in range(100, 120)]
    rows += [(5000, t, "bot", f"long {t}") for t in range(120)]  # longer than a shard
    rows += [(5001, t, "bot", f"long {t}") for t in range(130)]
    rows += [(None, 0, "user", "nobody"), (42, None, None, None), (42, 1, "user", "late"), (77, 0, "x", ""), (-5, 0, "a", "b")]
    assert run(spark, rows, 40) == brute(rows)


def test_empty_table(spark):
    assert run(spark, [], 100) == []


def test_double_array_holds_all_and_nothing_else():
    rng = random.Random(5)
    seqs = sorted({tuple(rng.randrange(40) for _ in range(rng.randrange(5))) for _ in range(500)})
    trie = prefix_trie.DoubleArray([list(s) for s in seqs])
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    assert len(trie.order) == len(prefixes)
    for p in prefixes:
        for turn in range(40):
            node = 0
            for i in (*p, turn):
                node = trie.child(node, i)
                if node < 0:
                    break
            assert (node >= 0) == ((*p, turn) in prefixes)


def test_query_matches_brute_force(spark):
    path = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.QUERIES["op13_prefix_trie"](spark, path).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[:2]) == brute(rows)
