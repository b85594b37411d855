"""Language-model scores by subword lattice likelihood.

The pieces and scores of an existing subword vocabulary weigh all
segmentations of a word (forward recursion in log space, see ``lattice.py``);
``lattice_score`` is this likelihood alone.  A vocabulary of merges has ranks
for scores, which become probabilities by Zipf's law; expectation maximisation
over the different training words, ``rounds`` times, fits them to the corpus.
``score`` gives a word's lattice one edge more, for the whole word,
weighted by its discounted count over the training documents: known words get
most of their probability there, unknown ones all of it from their pieces.
White space separates words and no piece crosses it, so the words of a
document multiply, and an end closes it.

Documents use their words again and again.  A document is therefore drawn from
an urn that starts with the lattice's probabilities, at ``URNS`` strengths in
equal shares; the strongest is close to independent words.  The order of words
does not matter in an urn, so a document's distinct words and their numbers
are enough, and the score is the log of a probability over texts.

Texts are read once: tasks cut the corpus in chunks and write each chunk as a
word list (with counts from its training documents) and documents as indexes
into that list.  The lists are sorted by word once: a word's entries come in a
row and are counted, and the word, kept with its places, meets the lattice once
a round and goes back to its chunks.  No text is shuffled and no table of the corpus is broadcast.

Defined results: a NULL or empty text has only the end token; a NULL id
counts as training; repeated rows count each; without training documents N is
0 and the vocabulary's own scores are used; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterline.llm import common, lattice

CHUNK_DOCS = 4096
CHUNK_BYTES = 16 << 20
ROWS = 1 << 17  # entries of a task's word list that are put together at once
PLACES = 4096  # chunks in one row of a word
SMOOTH = 0.05  # added to the expected count of every piece
URNS = (30.0, 100.0, 300.0, 1_000.0, 3_000.0, 10_000.0, 1e6)
_ENCODED = ("kind int, chunk long, idx int, word string, c long, doc_id long, held_out boolean, "
            "ids array<int>, times array<int>")


class _Indexes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def _encoded(docs: DataFrame, held_out: Column, id_col: str, text_col: str) -> DataFrame:
    """Chunk word lists (kind 0) and documents (kind 1)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("kind", pa.int32()), ("chunk", pa.int64()), ("idx", pa.int32()), ("word", pa.string()),
                            ("c", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                            ("ids", pa.list_(pa.int32())), ("times", pa.list_(pa.int32()))])
        base, number = TaskContext.get().partitionId() << 32, 0
        index, train, rows, size = _Indexes(), Counter(), [], 0

        def out() -> Iterator[pa.RecordBatch]:
            chunk = base + number
            words = pa.array(list(index), pa.binary()).cast(pa.string())
            for lo in range(0, len(words), 50_000):
                part = words[lo:lo + 50_000]
                n = len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, chunk)), pa.array(np.arange(lo, lo + n, dtype=np.int32)), part,
                     pa.array([train.get(i, 0) for i in range(lo, lo + n)], pa.int64()),
                     *[pa.nulls(n, f.type) for f in list(schema)[5:]]], schema=schema)
            n = len(rows)
            ids, held, lists, times = zip(*rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ones(n, np.int32)), pa.array(np.full(n, chunk)), *[pa.nulls(n, f.type) for f in list(schema)[2:5]],
                 pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(lists, pa.list_(pa.int32())),
                 pa.array(times, pa.list_(pa.int32()))], schema=schema)

        for batch in batches:
            for doc, text, held in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes: A-Z and ASCII white space only
                count = Counter(raw.split())
                ids = list(map(index.__getitem__, count))
                times = list(count.values())
                if not held:
                    for i, n in zip(ids, times):
                        train[i] += n
                rows.append((doc, held, np.array(ids, np.int32), np.array(times, np.int32)))
                size += len(raw)
                if len(rows) >= CHUNK_DOCS or size >= CHUNK_BYTES:
                    yield from out()
                    number += 1
                    index, train, rows, size = _Indexes(), Counter(), [], 0
        if rows:
            yield from out()

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string"), held_out).mapInArrow(run, _ENCODED)


def load_vocabulary(path: str) -> lattice.Vocabulary:
    """Pieces and scores of a SentencePiece model file."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    return lattice.vocabulary((sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.get_piece_size())
                              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))


def _learn(words: DataFrame, vocab: lattice.Vocabulary, rounds: int) -> np.ndarray:
    """Natural log probability by piece id after EM over the different training words of ``words(word, c)``."""
    sc = words.sparkSession.sparkContext
    logp = lattice.first_guess(vocab)
    for _ in range(rounds):
        shared = sc.broadcast((vocab, logp))  # the vocabulary, of fixed size

        def step(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            v, lp = shared.value
            total = np.zeros(len(lp))
            for b in batches:
                total += lattice.expected(v, lp, b.column(0).to_pylist(), np.ones(b.num_rows))
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["piece", "uses"])

        uses = (words.filter("c > 0").select("word").mapInArrow(step, "piece long, uses double")
                .groupBy("piece").agg(F.sum("uses").alias("uses")).toPandas())  # one row per piece at most
        if not len(uses):
            break
        count = np.full(len(logp), SMOOTH)
        count[uses["piece"].to_numpy(dtype=np.int64)] += uses["uses"].to_numpy()
        logp = np.log(count / count.sum())
    return logp


def urn(p: np.ndarray, times: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    """Natural log probability of each row's words (``times`` uses of a word of probability ``p``) under the urns."""
    token = np.repeat(np.arange(len(times)), times)
    again = np.arange(len(token)) - np.repeat(np.cumsum(times) - times, times)  # earlier uses in the document
    of = row[token]
    place = np.arange(len(token)) - np.searchsorted(of, of)  # words before it in the document
    each = np.stack([np.bincount(of, np.log((a * p[token] + again) / (a + place)), minlength=rows) for a in URNS])
    top = each.max(axis=0)
    return top + np.log(np.exp(each - top).mean(axis=0))


def _by_word(lists: DataFrame) -> DataFrame:
    """``lists(word, chunk, idx, c)`` as ``(word, c, head, chunks, idxs)``, one row per word with its whole count.

    A word of more than ``PLACES`` chunks has more rows; ``head`` marks its first.
    """
    schema = pa.schema([("word", pa.string()), ("c", pa.int64()), ("head", pa.bool_()),
                        ("chunks", pa.list_(pa.int64())), ("idxs", pa.list_(pa.int32()))])

    def out(rows: pa.Table, start: np.ndarray, end: int) -> pa.RecordBatch:
        chunk, idx, c = (rows[n].to_numpy()[:end] for n in ("chunk", "idx", "c"))
        parts = -(-np.diff(np.r_[start, end]) // PLACES)
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)  # of the word's rows
        at = np.repeat(start, parts) + nth * PLACES
        offsets = pa.array(np.r_[at, end], pa.int32())
        return pa.RecordBatch.from_arrays(
            [rows["word"].take(pa.array(at)).combine_chunks(), pa.array(np.repeat(np.add.reduceat(c, start), parts)), pa.array(nth == 0),
             pa.ListArray.from_arrays(offsets, pa.array(chunk)), pa.ListArray.from_arrays(offsets, pa.array(idx))], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < ROWS or batch["word"][0] == batch["word"][-1]:
                continue
            rows, start = _starts(held)
            yield out(rows, start[:-1], start[-1])  # the last word may go on in the next batch
            held = rows.slice(start[-1]).to_batches()
            size = sum(b.num_rows for b in held)
        if held:
            rows, start = _starts(held)
            yield out(rows, start, rows.num_rows)

    sorted_ = lists.repartition("word").sortWithinPartitions("word")
    return sorted_.mapInArrow(run, "word string, c long, head boolean, chunks array<long>, idxs array<int>")


def _starts(batches: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    """Rows in order of word, and where each word starts."""
    rows = pa.Table.from_batches(batches).combine_chunks()
    word = rows["word"]
    return rows, np.r_[0, np.flatnonzero(pc.not_equal(word.slice(1), word.slice(0, len(word) - 1)).to_numpy()) + 1]


def score(docs: DataFrame, vocabulary: str, held_out: Column, rounds: int = 4, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score)`` for every row of ``docs``.

    ``lattice_score`` is the likelihood under the lattice of the vocabulary's pieces alone.
    """
    spark = docs.sparkSession
    path = f"{common.shared_dir(spark)}/llm/lm-encoded-{common.uuid.uuid4().hex}"
    encoded = _encoded(docs, held_out, id_col, text_col)
    encoded.write.partitionBy("kind").parquet(path)
    encoded = spark.read.schema(encoded.schema).parquet(path)
    lists = encoded.filter("kind = 0").select("word", "chunk", "idx", "c")
    texts = encoded.filter("kind = 1").select("chunk", "doc_id", "held_out", "ids", "times")

    vocab = load_vocabulary(vocabulary)
    words = common.staged(_by_word(lists), "lm-words")
    logp = _learn(words.filter("head"), vocab, rounds)
    shared = spark.sparkContext.broadcast((vocab, logp))  # the vocabulary, of fixed size

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, lp = shared.value
        for b in batches:
            spelled = lattice.marginals(v, lp, b["word"].to_pylist())
            row = pc.list_parent_indices(b["chunks"]).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [b["chunks"].flatten(), b["idxs"].flatten(), pa.array(b["c"].to_numpy()[row]), pa.array(spelled[row])],
                ["chunk", "idx", "c", "lp"])

    entries = words.select("word", "c", "chunks", "idxs").mapInArrow(weigh, "chunk long, idx int, c long, lp double")
    documents = texts.filter(~F.col("held_out")).count()
    used, different, once, twice = words.filter("head").agg(
        F.coalesce(F.sum("c"), F.lit(0)), *[F.count_if(x) for x in (F.col("c") > 0, F.col("c") == 1, F.col("c") == 2)]).first()
    tokens, kinds = used + documents, different + (documents > 0)
    under = tokens + 0.5 * (kinds + 1)
    # a whole-word edge has its count less the discount; the pieces share what that sets free
    discount = once / (once + 2 * twice) if once and twice else 0.5
    free = discount * different / used if used else 1.0
    end = (documents + 0.5) / (tokens + 1)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        at, n = right["idx"].to_numpy(), left.num_rows
        c, spelled = np.zeros(len(at) + 1, np.int64), np.zeros(len(at) + 1)
        c[at], spelled[at] = right["c"].to_numpy(), right["lp"].to_numpy()
        whole = np.log(np.maximum(c - discount, 1e-300) / max(used, 1), where=c > 0, out=np.full(len(c), -np.inf))
        lp = np.logaddexp(spelled + np.log(free), whole)
        p = np.maximum(np.exp(lp), 1e-300)  # the longest words underflow; they stay possible
        base = np.log10((c + 0.5) / under)
        end_base = np.log10((documents + 0.5) / under)
        ids, times = (left[x].chunk(0) if n else pa.array([], pa.list_(pa.int32())) for x in ("ids", "times"))
        row = np.repeat(np.arange(n), np.diff(ids.offsets.to_numpy()))
        i, t = ids.flatten().to_numpy(), times.flatten().to_numpy()
        add = lambda w: np.bincount(row, w, minlength=n)
        length = add(t)
        # words too long for a float keep their log; only their first use is affected
        tiny = add(np.where(lp[i] < -690, lp[i] + 690.7755, 0.0))
        ended = length * np.log1p(-end) + np.log(end)
        return pa.table({
            "doc_id": left["doc_id"], "held_out": left["held_out"],
            "n_tokens": pa.array(length.astype(np.int64) + 1),
            "n_known": pa.array(add(t * (c[i] > 0)).astype(np.int64) + int(documents > 0)),
            "train_tokens": pa.array(np.full(n, tokens, np.int64)),
            "base_score": pa.array(add(t * base[i]) + end_base),
            "score": pa.array((urn(p[i], t, row, n) + tiny + ended) / np.log(10)),
            "lattice_score": pa.array((add(t * spelled[i]) + ended) / np.log(10))})

    # two reads of one table: another name keeps the two sides apart
    texts = spark.read.schema(encoded.schema).parquet(path).filter("kind = 1").select(
        F.col("chunk").alias("of"), "doc_id", "held_out", "ids", "times")
    return texts.groupBy("of").cogroup(entries.groupBy("chunk")).applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double, "
                "lattice_score double")
