"""Registered queries of the corpus operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quarterline.llm import common

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Builder], Builder]:
    def add(fn: Builder) -> Builder:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@register("op8_simhash_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm import simhash

    return simhash.near_duplicates(common.read(spark, sf_dir, "documents"), shingle=3, max_bits=3)


OP3_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15) AS BIGINT) AS k
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
weighted AS (
  SELECT source, s, [5.0, 2.0, 1.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM per),
levels AS (
  SELECT *, ((sum(s) OVER ())::DOUBLE - coalesce(sum(3.0::DOUBLE * s) OVER (ORDER BY 3.0::DOUBLE * s / w, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
    / sum(w) OVER (ORDER BY 3.0::DOUBLE * s / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighted),
goal AS (SELECT source, s, least(3.0::DOUBLE * s, (max(level) OVER ()) * w) AS target FROM levels),
placed AS (
  SELECT d.doc_id, d.size, g.s AS source_size, g.target, floor(g.target + 0.5)::BIGINT AS budget,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.k, d.doc_id NULLS FIRST, d.size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
         + greatest(0, least(size, budget % source_size - start)) END::BIGINT AS taken
FROM placed"""


@register("op3_mixing", OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm import mixing

    return mixing.taken(common.read(spark, sf_dir, "documents"), weights=(5, 2, 1), cap=3.0)


OP5_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(q.e, lambda x, i: x * c.e[i]))::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM pairs)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""


@register("op5_topk_search", OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from quarterline.llm import topk_search

    vectors = common.read(spark, sf_dir, "embeddings")
    return topk_search.top_k(vectors, F.col("vec_id") % 50 == 0, k=5, scale=256.0)


@register("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quarterline.llm import packing

    return packing.pack(common.read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@register("op1_url_filter")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm import url_filter

    rules = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
             url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"),
             url_filter.Rule("block", "net", "/fr/")]
    return url_filter.judge(common.read(spark, sf_dir, "pages"), rules)


@register("op6_toxicity")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from quarterline.llm import toxicity

    held_out = F.coalesce(common.crc_mod(F.col("doc_id"), 4) == 2, F.lit(False))
    docs, labels = common.read(spark, sf_dir, "documents"), common.read(spark, sf_dir, "labels")
    scored = toxicity.score(docs, labels, use=~held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score",
                         (F.col("score") >= 0.3).cast("int").alias("predicted"))


@register("op2_html_extract")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm import html_extract

    return html_extract.extract(common.read(spark, sf_dir, "pages"))


OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counts AS (SELECT a AS vec_id, count(*)::BIGINT AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0)::BIGINT AS n_links, l.component_id, e.vec_id = l.component_id AS kept
FROM embeddings e JOIN least l USING (vec_id) LEFT JOIN counts c USING (vec_id)"""


@register("op10_embedding_dedup", OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm import embed_dedup

    return embed_dedup.near_duplicates(common.read(spark, sf_dir, "embeddings"), threshold=0.95)


@register("op9_lm_score")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    from pyspark.sql import functions as F

    from quarterline.llm import lm_score

    held_out = F.coalesce(common.crc_mod(F.col("doc_id"), 5) == 1, F.lit(False))
    return lm_score.score(common.read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), held_out)


@register("op4_substring_dedup")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm import substring_dedup

    return substring_dedup.repeated(common.read(spark, sf_dir, "documents"), k=5, window=1, min_words=50, similar=0.8)


# crc32 of a list of byte values in SQL: the table of its 256 steps, then one lookup a byte.
CRC_TABLE = """
crc_bits(i, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS steps FROM crc_bits WHERE k = 8)"""


def crc_sql(byte_list: str) -> str:
    """crc32 of the bytes in a BIGINT list; ``steps`` of ``crc_table`` must be in scope."""
    return (f"xor(4294967295, list_reduce({byte_list}, "
            "lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295::BIGINT))")


OP13_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
         {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS base, {crc_sql("list_transform(string_split(c::VARCHAR, ''), lambda x: unicode(x)::BIGINT)")} % 6 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL), crc_table),
parts AS (
  SELECT c, 0 AS part, pos, t FROM convs JOIN own ON own.conv_id = base AND pos <= h
  UNION ALL SELECT c, 1, pos, t FROM convs JOIN own ON own.conv_id = c AND pos > h),
seqs AS (
  SELECT c, coalesce(list(t ORDER BY part, pos) FILTER (WHERE t IS NOT NULL), []) AS s
  FROM convs LEFT JOIN parts USING (c) GROUP BY c),
starts AS (SELECT c, d, s[1:d] AS p, len(s) AS n FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
node AS (
  SELECT p, d, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends_sha256
  FROM starts GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM node WHERE d > 0 GROUP BY 1, 2),
own_figures AS (
  SELECT p, d, (n_convs - 1) * coalesce(length(p[d].text), 0) AS saved, (n_children IS NULL)::INT AS leaf
  FROM node LEFT JOIN kids USING (p, d)),
below AS (
  SELECT p[1:up] AS p, up AS d, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS up FROM own_figures) GROUP BY 1, 2)
SELECT a.conv_id, a.d::BIGINT AS depth, b.conv_id AS parent_conv_id, a.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens,
       a.ends_sha256
FROM node a JOIN below USING (p, d) LEFT JOIN kids USING (p, d)
LEFT JOIN node b ON a.d > 0 AND b.d = a.d - 1 AND b.p = a.p[1:a.d - 1]"""


@register("op13_prefix_trie", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm import prefix_trie

    rows, members = prefix_trie.borrowed(prefix_trie.turns(common.read(spark, sf_dir, "conversations")))
    return prefix_trie.nodes(rows, members)


# The letters of the runs are one byte in UTF-8, or C3 and the code point less 64.
OP12_SQL = f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT coalesce(doc_id::VARCHAR, '') AS doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]{{5,}}')) AS run
        FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, n, {crc_sql("""flatten(list_transform(string_split(doc_id || ':' || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195, unicode(x)::BIGINT - 64] END))""")} AS h
  FROM runs, crc_table),
words AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, n FROM hashed),
vocab AS (
  SELECT word, sum(n)::BIGINT AS n FROM words WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cuts AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS cut
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM vocab)),
near AS (
  SELECT DISTINCT word, n, other, other_n FROM (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
    UNION ALL SELECT a.word, a.n, b.word, b.n FROM vocab a JOIN cuts b ON b.cut = a.word
    UNION ALL SELECT b.word, b.n, a.word, a.n FROM vocab a JOIN cuts b ON b.cut = a.word)),
best AS (
  SELECT word, count(*) AS n_near, arg_min({{'w': other, 'n': other_n}}, {{'k': -other_n, 'w': encode(other)}}) AS top FROM near GROUP BY word),
told AS (
  SELECT word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top.n >= 2 * v.n THEN top.w END AS form,
         CASE WHEN top.n >= 2 * v.n THEN top.n END AS form_n FROM vocab v LEFT JOIN best USING (word)),
chain AS (
  SELECT word, word AS root, form AS next FROM told
  UNION ALL SELECT c.word, t.word, t.form FROM chain c JOIN told t ON t.word = c.next)
SELECT word, form, root, n, n_near, form_n FROM told JOIN chain USING (word) WHERE next IS NULL"""


@register("op12_spelling", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm import spelling

    words = spelling.occurrences(common.read(spark, sf_dir, "documents"), min_length=5, drop_every=97)
    return spelling.variants(spelling.vocabulary(words, min_length=5, min_count=3), ratio=2)


@register("op11_fingerprint")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarterline.llm import fingerprints

    return fingerprints.against_next(common.read(spark, sf_dir, "documents"), cut=4, fraction=0.25, at_least=16, shingle=5)
