"""Mixing sources to target weights with DataFrame functions only.

Every row gets a hash-random key, made from its id and text, so reruns agree.
Keys are uniform, so equal key ranges inside a source are equal shares of its
rows: the ranges are the distributed sort, their word totals give the prefix
sum before each range, and a window inside one range gives the rest.  The
budget of a source then falls on exact word positions: whole epochs first,
and the remaining words from the front of the key order, cutting the last
document at the word.

Targets: weights share the words of all sources; a target stops at ``cap``
times its source's words and the excess is shared again by weight until no
target is above.  That is ``min(cap * size, level * weight)`` with one level
for all sources, which prefix sums over the sources give directly.

Defined results: a NULL text has 0 words; a NULL source is a source of its
own, after all others; a source without words has target 0; identical rows
are taken one after the other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarterline.llm import common

ROWS_PER_RANGE = 4096
KEY_BITS = 60
# One row per source; above this many sources the join is left to the optimizer.
BROADCAST_SOURCES = 100_000


def random_key(id_col: str, text_col: str) -> Column:
    """Uniform BIGINT below 2^60 from the row's id and text."""
    text = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit("|"),
                    F.coalesce(F.col(text_col), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """``(_source, source_rows, source_size, target)`` from ``sizes(_source, _size)``, one row per source."""
    per = sizes.groupBy("_source").agg(F.count("*").alias("source_rows"), F.sum("_size").alias("source_size"))
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("_w", pick).withColumn("_ratio", F.lit(float(cap)) * F.col("source_size") / F.col("_w"))
    full = Window.orderBy("_ratio", F.col("_source").asc_nulls_last())
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    rest = full.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    words = F.sum("source_size").over(every)
    capped = F.coalesce(F.sum(F.lit(float(cap)) * F.col("source_size")).over(before), F.lit(0.0))
    per = per.withColumn("_level", (words - capped) / F.sum("_w").over(rest))
    target = F.least(F.lit(float(cap)) * F.col("source_size"), F.max("_level").over(every) * F.col("_w"))
    return per.select("_source", "source_rows", "source_size", target.alias("target"))


def plan(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0, id_col: str = "doc_id",
         text_col: str = "text", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` of every row of ``docs`` with ``_size, source_size, target, _full, _part``.

    The mix takes ``_full`` whole copies of the row and the first ``_part``
    words of one more.
    """
    def sized(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.select(*columns, F.col(source_col).alias("_source"),
                         common.word_count(F.col(text_col)).alias("_size"), random_key(id_col, text_col).alias("_key"))

    # The narrow table decides everything; a caller that keeps more columns has them counted again.
    narrow = common.staged(sized(docs, [F.col(id_col).alias("_id")]), "mixing-sizes")
    rows = sized(docs, [F.col(id_col).alias("_id"), *keep]) if keep else narrow
    sources = common.staged(targets(narrow, weights, cap), "mixing-targets")
    few = sources.count() <= BROADCAST_SOURCES

    def ranged(df: DataFrame) -> DataFrame:
        with_source = df.join(F.broadcast(sources) if few else sources,
                              df["_source"].eqNullSafe(sources["_source"])).drop(sources["_source"])
        ranges = F.ceil(F.col("source_rows") / ROWS_PER_RANGE)
        return (with_source.withColumn("_range", F.floor(F.col("_key") / F.lit(2.0 ** KEY_BITS) * ranges))
                .withColumn("_place", F.struct(F.coalesce("_source", F.lit("")), F.col("_source").isNull(), "_range")))

    per_range = ranged(narrow).groupBy("_place").agg(F.sum("_size").alias("_words"))
    ahead = Window.partitionBy("_place.col1", "_place.col2").orderBy("_place._range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = per_range.select("_place", F.coalesce(F.sum("_words").over(ahead), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy("_place").orderBy("_key", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("_ahead") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    budget = F.floor(F.col("target") + 0.5)
    some = F.col("source_size") > 0
    return (ranged(rows).join(per_range, "_place").withColumn("_start", start).withColumn("_budget", budget)
            .withColumn("_full", F.when(some, F.floor(F.col("_budget") / F.col("source_size"))).otherwise(0))
            .withColumn("_part", F.when(some, F.greatest(F.lit(0), F.least(
                F.col("_size"), F.col("_budget") - F.col("_full") * F.col("source_size") - F.col("_start")))).otherwise(0))
            .drop("_place", "_range", "_ahead", "_key", "_start", "_budget", "source_rows"))


def taken(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` for every row of ``docs``."""
    return plan(docs, weights, cap).select(
        F.col("_id").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target",
        (F.col("_full") * F.col("_size") + F.col("_part")).cast("long").alias("taken"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """The mixed documents, with the columns of ``docs``.

    A row appears once per epoch that takes it; a cut copy keeps its first
    words with their white space, and its ``n_chars``, where there is one,
    follows the text.  Rows the mix takes no word of are left out.
    """
    # the row travels in one struct, so that no column of it meets a column of the plan
    packed = docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("_row"))
    rows = plan(packed, weights, cap, keep=["_row"])
    cut = F.col("_part") > 0
    copies = (F.col("_full") + cut.cast("long")).cast("int")
    rows = rows.filter((F.col("_size") > 0) & (copies > 0)).withColumn(
        "_copy", F.explode(F.sequence(F.lit(1), copies)))
    last = (F.col("_copy") > F.col("_full")) & (F.col("_part") < F.col("_size"))
    # each piece is the white space before a word and the word
    pieces = F.split("_row.text", r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
    rows = rows.withColumn("_last", last).withColumn("_cut", F.when(last, F.array_join(F.slice(
        pieces, F.lit(1), F.col("_part").cast("int")), "")).otherwise(F.col("_row.text")))

    def column(name: str) -> Column:
        own = F.col("_row").getField(name)
        if name == "text":
            own = F.col("_cut")
        elif name == "n_chars":
            own = F.when(F.col("_last"), F.length("_cut")).otherwise(own).cast(docs.schema[name].dataType)
        return own.alias(name)

    return rows.select(*[column(c) for c in docs.columns])
