"""Mixing: exact oracle, water-filled targets, cuts at the word, odd rows."""

from collections import defaultdict

import duckdb
import pytest

from quarterline.llm import mixing, queries


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_matches_oracle(spark, sf):
    path = f"/root/testdata/{sf}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/documents.parquet'")
    want = {r[0]: r[1:] for r in con.execute(f"SELECT doc_id, size, source_size, target, taken FROM ({queries.ORACLE['op3_mixing']})").fetchall()}
    got = queries.QUERIES["op3_mixing"](spark, path).collect()
    assert len(got) == len(want)
    for r in got:
        size, source_size, target, taken = want[r["doc_id"]]
        assert (r["size"], r["source_size"], r["taken"]) == (size, source_size, taken)
        assert r["target"] == pytest.approx(target, rel=1e-12)


def fill(sizes, weights, cap=3.0):
    """Targets by resharing the excess until no source is above its cap."""
    target, left, active = {}, float(sum(sizes.values())), dict(weights)
    while active:
        total = sum(active.values())
        over = [s for s in active if left * active[s] / total > cap * sizes[s]]
        if not over:
            return target | {s: left * w / total for s, w in active.items()}
        for s in over:
            target[s] = cap * sizes[s]
        left -= sum(target[s] for s in over)
        active = {s: w for s, w in active.items() if s not in over}
    return target


def test_targets_budgets_and_odd_rows(spark):
    words = lambda n: " ".join(["w"] * n)
    rows = [(i, words(50 + i % 7), "a", 0) for i in range(40)] + [(100 + i, words(900), "b", 0) for i in range(30)]
    rows += [(200, None, "c", 0), (201, "", "c", 0), (202, " \t\n", "c", 0), (203, words(3), None, 0), (None, words(5), None, 0),
             (300, words(20_000), "d", 0), (301, "x\u00a0y\u2003z", "d", 0), (5, words(55), "a", 0), (5, words(55), "a", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.taken(docs).collect()
    assert len(got) == len(rows)
    sizes, by = defaultdict(int), defaultdict(int)
    for _, t, s, _ in rows:
        sizes[s] += len((t or "").split(" ")) if t and t.strip() and "\u00a0" not in t else (1 if t and "\u00a0" in t else 0)
    order = sorted((s for s in sizes if s is not None)) + [None]
    want = fill(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)})
    targets = {r["source_size"]: r["target"] for r in got}
    assert sorted(targets.values()) == pytest.approx(sorted(want.values()))
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by[r["source_size"]] += r["taken"]
    for size, target in targets.items():
        assert abs(by[size] - target) <= 1
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, mixing.taken(docs.repartition(7)).collect()), key=repr)


def test_mix_writes_the_planned_words(spark):
    rows = [(i, "\n".join(f"w{j} \t" for j in range(10 + i)), "ab"[i % 2], "en", 0) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars int")
    plan = {r["doc_id"]: r["taken"] for r in mixing.taken(docs).collect()}
    out, text = defaultdict(int), {r[0]: r[1] for r in rows}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        out[r["doc_id"]] += len(r["text"].split())
        assert text[r["doc_id"]].startswith(r["text"])
    assert {k: v for k, v in plan.items() if v} == dict(out)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.taken(docs.limit(0)).count() == 0


def test_main_path_is_native(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert "Python" not in mixing.taken(docs)._jdf.queryExecution().toString()
