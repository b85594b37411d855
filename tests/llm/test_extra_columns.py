"""Documents with columns that bear the operators' own names pass through the pipeline's stages unharmed."""

from pyspark.sql import functions as F

from quarterline.llm import mixing, simhash, substring_dedup

NAMES = ["target", "source_size", "source_rows", "_size", "_key", "_row", "_row_key", "_text", "_cut", "_doc", "_spans", "_part",
         "_full", "_copy", "component", "fp", "row_key", "spans", "n_words"]
SHAPE = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, " ".join(f"w{i}x{j}" for j in range(40)) + (f" {passage}" if i in (3, 7) else ""), "en", "ab"[i % 2]) for i in range(12)]
    rows += [(20, rows[0][1], "en", "a"), (21, None, None, None), (22, "", "en", "b")]
    docs = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], SHAPE)
    return docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in NAMES})


def keeps_columns(docs, out):
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in NAMES)
    assert all(r["n_chars"] == len(r["text"] or "") for r in rows)
    return rows


def test_mix(spark):
    docs = documents(spark)
    rows = keeps_columns(docs, mixing.mix(docs, weights=(1, 1), cap=3.0))
    assert {r["source"] for r in rows} == {"a", "b"}


def test_keep_first(spark):
    docs = documents(spark)
    rows = keeps_columns(docs, simhash.keep_first(docs))
    assert {r["doc_id"] for r in rows} >= set(range(12)) and 20 not in {r["doc_id"] for r in rows}


def test_remove(spark):
    docs = documents(spark)
    rows = keeps_columns(docs, substring_dedup.remove(docs, k=5, window=1, min_words=50, similar=0.8))
    text = {r["doc_id"]: r["text"] for r in rows}
    assert "p5 p6" in text[3] and "p5 p6" not in text[7] and text[7].startswith("w7x0")
