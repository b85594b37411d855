"""Packing: pieces against the tokenizer itself, valid sequences, bounds."""

import zlib

import numpy as np
import pandas as pd
import public_tokenizers
from tokenizers import Tokenizer

from quarterline.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


def direct(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids


def test_encoder_matches_the_tokenizer():
    texts = ["", " \n\t", "Hello, World... it's 3.14 a.b,c ...,", "<|endoftext|>x<|startoftext|> end", "ΑΣ ΣΑΣ. ÉCOLE e\u0301a \u0301x",
             "a\x1cb\x1d c\x85d\u00a0e\u2003f\u200bg", "'S 'll don't DON'T.", "x" * 5000, "数字 漢字。 𝔘𝔫𝔦 İI ǅ ß ﬁ", "tab\tnl\nvt\x0bff\x0c", "a, a. ., ,. é. é,",
             "one!!! two?) three&&&& four.' five's. six_ _seven e\u0301. ΑΣ! ß... 数字--"]
    tokenizer = Tokenizer.from_file(PATH)
    got = packing.Encoder(PATH).encode(texts)
    for t, b in zip(texts, got):
        assert np.frombuffer(b, dtype="<u4").tolist() == tokenizer.encode(t, add_special_tokens=False).ids, t


def check(rows, docs, capacity=4096):
    """Pieces are the documents' ids in order; sequences are gapless and hold no more than the capacity."""
    by_seq, by_doc = {}, {}
    for r in rows:
        by_seq.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append(r)
    for parts in by_seq.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    for doc, text in docs.items():
        ids = direct(text) + [1]
        for r in by_doc[doc]:
            piece = ids[r["start"]:r["start"] + r["length"]]
            assert r["start"] == capacity * r["piece"] and r["length"] == min(capacity, len(ids) - r["start"])
            assert r["ids_crc32"] == zlib.crc32(np.array(piece, dtype="<u4").tobytes())
        assert sorted(r["piece"] for r in by_doc[doc]) == list(range(-(-len(ids) // capacity)))
    return len(by_seq)


def test_pieces_and_sequences(spark):
    rows = [(r["doc_id"], r["text"], 0) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(10_001, None, 0), (10_002, "", 0), (10_003, "word " * 9000, 0), (None, "no id", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length int")
    got = packing.pack(docs, PATH).collect()
    used = check(got, {r[0]: r[1] for r in rows})
    assert used == -(-sum(r["length"] for r in got) // 4096)
    assert packing.pack(docs.limit(0), PATH).count() == 0
    assert packing.pack(spark.createDataFrame([(1, "a")] * 3, "doc_id long, text string"), PATH).count() == 3


def test_exchange_rounds_keep_every_piece(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_PARTITION", 8)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = packing.pack(docs, PATH).collect()
    used = check(got, {r["doc_id"]: r["text"] for r in docs.collect()})
    assert used <= 1.05 * sum(r["length"] for r in got) / 4096 + 1


def test_gapped_groups_hand_on_every_open_bin():
    frame = pd.DataFrame({"length": [60] * 7 + [41] * 7, "sequence_id": range(14), "offset": 0})
    assert packing._hand_on(frame, 100)["handed"].all()  # fourteen bins, the bound is lower
    certified = packing._hand_on(pd.DataFrame({"length": [60] * 3, "sequence_id": range(3)}), 100)
    assert certified["handed"].sum() == 1


def test_repeated_rows_are_spread_over_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_PARTITION", 50)
    rows = [(1, "same words " * 40)] * 400 + [(None, "x")] * 200
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()
    assert len(got) == 600 and check(got, {}) <= -(-sum(r["length"] for r in got) // 4096) + 4


def test_best_fit_and_bounds():
    rng = np.random.default_rng(0)
    for _ in range(40):
        lengths = rng.integers(1, 101, rng.integers(1, 60))
        where, offset, bins = packing.best_fit(lengths, 100)
        fill = np.bincount(where, lengths, minlength=bins)
        assert fill.max() <= 100 and len(fill) == bins
        assert packing.lower_bound(lengths, 100) <= bins
    assert packing.lower_bound(np.array([51] * 7), 100) == 7  # the sum alone says 4
    assert packing.lower_bound(np.array([34] * 9), 100) == 5  # two fit in a bin


def test_latin_words_skip_the_normalizers_and_patterns_and_get_the_same_ids():
    import json
    import random

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzABCXYZßàéîõöøüÿÀÉÞ"
    words = ["".join(rng.choices(letters, k=rng.randint(1, 14))) for _ in range(3_000)]
    odd = ["éa", "µm", "ªº", "ſt", "K", "Å", "ŒUVRE", "straße's", "don't", "ÿ÷×", "naïve.", "日本語", "İi", "ÀÉ$$$", "x1y"]
    texts = [" ".join(words[i:i + 30] + rng.sample(odd, 4)) for i in range(0, len(words), 30)]
    whole = Tokenizer.from_file(path)
    encoder = packing.Encoder(path)
    given: list[str] = []

    class Told:
        def encode_batch_fast(self, inputs, add_special_tokens):
            given.extend(w for text in inputs for w in text.split())
            return whole.encode_batch_fast(inputs, add_special_tokens=add_special_tokens)

    encoder.tokenizer = Told()
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
    assert not {w.lower() for w in words} & set(given)

    assert packing.latin_tokenizer(path) is not None
    assert json.loads(whole.to_str())["normalizer"] is not None  # the tokenizer itself keeps them
