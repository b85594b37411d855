"""Embedding near-duplicates: recall and exactness against brute force."""

import duckdb
import numpy as np
import pytest

from quarterline.llm import embed_dedup, queries


def brute(rows, threshold=0.95):
    ok = [(n, np.array(v, dtype=np.float64) / max(map(abs, v))) for n, (_, v) in enumerate(rows)
          if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links, parent = [0] * len(rows), list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (a, x) in enumerate(ok):
        for b, y in ok[i + 1:]:
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a] += 1
                links[b] += 1
                parent[top(a)] = top(b)
    least = {}
    for n, (i, _) in enumerate(rows):
        if i is not None:
            least[top(n)] = min(least.get(top(n), i), i)
    return sorted(((i, links[n], least.get(top(n)), i == least.get(top(n))) for n, (i, _) in enumerate(rows)), key=repr)


def test_query_matches_oracle(spark):
    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    want = con.execute(f"SELECT vec_id, n_links, component_id, kept FROM ({queries.ORACLE['op10_embedding_dedup']})").fetchall()
    got = queries.QUERIES["op10_embedding_dedup"](spark, path)
    assert sorted(map(tuple, got.collect())) == sorted(want)


def clouds(rng, groups=20, size=40, dim=16, spread=0.05):
    out = []
    for _ in range(groups):
        centre = rng.standard_normal(dim)
        for _ in range(size):
            out.append((centre + spread * np.linalg.norm(centre) * rng.standard_normal(dim)).tolist())
    return out + rng.standard_normal((200, dim)).tolist()


def test_recall_and_hot_cells(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "BLOCK", 32)  # cells are split
    monkeypatch.setattr(embed_dedup, "PER_CELL", 200)
    rng = np.random.default_rng(2)
    vectors = clouds(rng)
    vectors += [vectors[0]] * 30  # exact copies
    rows = list(enumerate(vectors))
    want = brute(rows)
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(7)).collect()
    mine = {r["vec_id"]: r["n_links"] for r in got}
    true = {i: n for i, n, _, _ in want}
    assert all(mine[i] <= true[i] for i in true)  # none below the threshold, none twice
    assert sum(mine.values()) >= 0.98 * sum(true.values())


def test_odd_rows(spark):
    rows = [(1, [1.0, 0.0, 0.0, 0.0]), (2, [2.0, 0.001, 0.0, -0.0]), (3, None), (4, [0.0] * 4), (5, [1.0, None, 0.0, 0.0]), (6, [float("nan")] * 4),
            (7, [float("inf"), 0.0, 0.0, 0.0]), (8, [1.0, 0.0, 0.0, 0.0]), (9, [1e300, 0.0, 0.0, 0.0]), (None, [0.0, 1.0, 0.0, 0.0]),
            (11, [0.0, 1.0, 0.0, 0.0]), (12, []), (13, [0.0, 0.0, 1.0, 0.0])]
    frame = spark.createDataFrame([(*r, "z") for r in rows], "vec_id long, embedding array<double>, node string")
    got = sorted(map(tuple, embed_dedup.near_duplicates(frame).collect()), key=repr)
    assert [r[:3] for r in got] == [r[:3] for r in brute(rows)]
    assert [r[3] for r in got if r[0] is not None] == [r[3] for r in brute(rows) if r[0] is not None]
    assert embed_dedup.near_duplicates(frame.limit(0)).count() == 0
    assert embed_dedup.near_duplicates(frame.filter("vec_id = 4")).collect()[0]["n_links"] == 0


@pytest.mark.parametrize("lengths", [1, 8])
def test_vectors_of_every_length_meet_their_own(spark, monkeypatch, lengths):
    monkeypatch.setattr(embed_dedup, "LENGTHS", lengths)  # the rest without an index
    monkeypatch.setattr(embed_dedup, "BLOCK", 8)
    rng = np.random.default_rng(9)
    vectors = [[1.0, 0.0], [1.0, 0.01], [1.0, 0.0, 0.0], [0.0, 1.0, 0.0], [0.0, 1.0, 0.1], [2.0], [3.0], [-1.0]]
    for dim, n in ((5, 60), (4, 40)):
        base = rng.standard_normal((n // 4, dim))
        vectors += (np.repeat(base, 4, axis=0) + 0.05 * rng.standard_normal((n, dim))).tolist()
    rows = list(enumerate(vectors))
    got = embed_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)).collect()
    want = brute(rows)
    if lengths == 1:  # only the most common length passes an index; small ones are whole
        want, got = ([r for r in x if len(vectors[r[0]]) != 5] for x in (want, map(tuple, got)))
        assert sorted(got) == sorted(want)
    else:
        assert sum(r["n_links"] for r in got) >= 0.95 * sum(r[1] for r in want)
        assert {r["vec_id"]: r["n_links"] for r in got}[0] == 1


def test_traversal_visits_every_cell_in_order():
    rng = np.random.default_rng(4)
    a, b = rng.random(9), rng.random(7)
    cells = list(embed_dedup.traverse(a, b, 0.8))
    sums = [a[i] + b[j] for i, j in cells]
    assert sums == sorted(sums) and len(set(cells)) == len(cells)
    assert len(cells) == sum(x + y <= a.min() + b.min() + 0.8 for x in a for y in b)
