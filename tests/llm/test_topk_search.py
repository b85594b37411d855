"""Top-k search against brute force."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from quarterline.llm import queries, topk_search


def brute(rows, divisor=50, k=5):
    ok = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, qv in ok:
        if q % divisor == 0:
            scores = sorted(((-sum(a * b for a, b in zip(qv, v)), i) for i, v in ok if i != q))[:k]
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def test_query_matches_oracle(spark):
    path = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{path}/embeddings.parquet'")
    want = sorted(con.execute(queries.ORACLE["op5_topk_search"]).fetchall())
    assert sorted(map(tuple, queries.QUERIES["op5_topk_search"](spark, path).collect())) == want


def test_ties_invalid_vectors_and_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.choice([-0.5, 0.0, 0.25, 1.0], 6)], i) for i in range(300)]  # many ties
    rows += [(1000, None, 0), (1050, [0.5, None, 0.1, 0.0, 0.0, 0.0], 0), (1100, [float("nan")] * 6, 0), (1150, [float("inf")] + [0.0] * 5, 0),
             (1200, [0.0] * 6, 0), (1250, [100000.5] * 6, 0), (None, [1.0] * 6, 0), (1300, [0.5] * 4, 0), (1350, [], 0)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>, score int").repartition(5)
    want = brute([r[:2] for r in rows])
    for block in (2, 16_384):
        got = topk_search.top_k(vectors, F.col("vec_id") % 50 == 0, query_block=block).collect()
        assert sorted(map(tuple, got)) == want


def test_few_candidates_and_empty(spark):
    schema = "vec_id long, embedding array<float>"
    assert topk_search.top_k(spark.createDataFrame([], schema), F.col("vec_id") % 50 == 0).count() == 0
    one = spark.createDataFrame([(0, [1.0, 2.0])], schema)
    assert topk_search.top_k(one, F.col("vec_id") % 50 == 0).count() == 0
    two = spark.createDataFrame([(0, [1.0, 2.0]), (1, [1.0, 0.5]), (0, [1.0, 2.0])], schema)
    assert [tuple(r) for r in topk_search.top_k(two, F.col("vec_id") % 50 == 0).collect()] == [(0, 1, 1, 256 * 256 + 512 * 128)]
