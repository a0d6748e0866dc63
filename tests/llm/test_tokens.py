"""SentencePiece and packing against the public libraries."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from quarry.llm import packing, sentencepiece_bpe

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
DOCS = "doc_id long, text string, ids string, length int"
ODD = [None, "", " ", "  two  spaces \n\n end ", "▁ mark", "tab\tand\r\nline", "漢字 and 😀 emoji", "naïve café, naïve café.",
       "<s> </s> <unk> <0x0A>", "a" * 5000, "word " * 40_000, "<|endoftext|> in text", "it's we'll 're", "\x00\x1c x",
       "x\x1c y \x85 z", "same", "same"]


def odd_docs(spark):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in enumerate(ODD)], DOCS)


def random_texts(n, seed):
    rng = random.Random(seed)
    alphabet = list("  \n\t▁abcdeéßñ漢😀\r.,;:()<>/sdfgh  THE'1") + ["<|endoftext|>", "'re", "the"]
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_agenda_and_decoder_equal_the_library():
    model = open(PIECES, "rb").read()
    library = sentencepiece.SentencePieceProcessor(model_proto=model)
    encoder = sentencepiece_bpe.Encoder(model, check=False)
    texts = random_texts(1500, 1) + [t for t in ODD if t]
    for text, packed in zip(texts, encoder(texts)):
        ids = np.frombuffer(packed, np.int32).tolist()
        assert ids == library.encode(text)
        assert encoder.decoder(ids) == library.decode(ids)
    rng = random.Random(2)
    for _ in range(1500):
        ids = [rng.randrange(32000) if rng.random() < 0.5 else rng.randrange(259) for _ in range(rng.randrange(8))]
        assert encoder.decoder(ids) == library.decode(ids)


def test_both_forms_of_the_agenda_agree():
    vocab = sentencepiece_bpe.Vocabulary(open(PIECES, "rb").read())
    for text in random_texts(800, 6) + ["aaaaaaaaaa", "▁▁▁▁▁the", "x"]:
        if text:
            assert vocab._merge_short(text) == vocab._merge_long(text)


def test_check_finds_no_difference():
    encoder = sentencepiece_bpe.Encoder(open(PIECES, "rb").read())
    encoder(random_texts(500, 3))
    assert encoder.differences == 0


def test_sentencepiece_digests(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r.doc_id: r for r in sentencepiece_bpe.digests(odd_docs(spark), PIECES).collect()}
    assert len(got) == len(ODD)
    for i, text in enumerate(ODD):
        ids = library.encode(text or "")
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_sentencepiece_round_trip_and_empty_table(spark):
    encoded = sentencepiece_bpe.encode(odd_docs(spark), PIECES)
    texts = {r.doc_id: r.text for r in sentencepiece_bpe.decode(encoded, PIECES).collect()}
    assert all(texts[i] == (t or "").replace("▁", " ") for i, t in enumerate(ODD) if not (t or "").startswith("▁"))
    assert sentencepiece_bpe.digests(spark.createDataFrame([], DOCS), PIECES).count() == 0


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        packing.ByteBpe(open(public_tokenizers.path("word_bpe_49k.json"), "rb").read())


def test_byte_ids_equal_the_library():
    library = Tokenizer.from_file(BYTES)
    tokenizer = packing.ByteBpe(open(BYTES, "rb").read())
    for text in random_texts(3000, 4) + [t for t in ODD if t]:
        want = library.encode(text, add_special_tokens=False).ids
        assert tokenizer(text).tolist() == want
        assert tokenizer._slow(text).tolist() == want


def check_packing(rows, texts, length=1024):
    library = Tokenizer.from_file(BYTES)
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        places[r.sequence_id].append((r.offset, r.length))
    for i, text in texts.items():
        ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        at = 0
        for k, r in enumerate(sorted(pieces[i], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.length == length or k == 0
            at += r.length
            assert r.ids_crc32 == zlib.crc32(ids[r.start:at].tobytes())
        assert at == len(ids)
    total = 0
    for place in places.values():
        at = 0
        for offset, n in sorted(place):
            assert offset == at
            at += n
        assert at <= length
        total += at
    return len(places), -(-total // length)


def test_packing_of_odd_and_real_texts(spark, sf_small):
    check_packing(packing.pack(odd_docs(spark), BYTES).collect(), dict(enumerate(ODD)))
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    used, least = check_packing(packing.pack(docs, BYTES).collect(), {r.doc_id: r.text for r in docs.collect()})
    assert used <= least * 1.02 + 2
    assert packing.pack(spark.createDataFrame([], DOCS), BYTES).count() == 0


def test_packing_of_sources_clustered_by_length(spark, monkeypatch):
    # 599 and 399 ids and the end id: one of each fills a sequence, two long ones need two
    texts = {i: "a" + " a" * (598 if i < 200 else 398) for i in range(400)}
    docs = spark.createDataFrame(spark.sparkContext.parallelize(list(texts.items()), 4), "doc_id long, text string")
    rows = packing.pack(docs, BYTES).collect()
    assert {r.length for r in rows} == {600, 400}
    assert check_packing(rows, texts)[0] == 200
    monkeypatch.setattr(packing, "GROUP", 64)                # several groups and rounds
    assert check_packing(packing.pack(docs, BYTES).collect(), texts)[0] <= 204


def test_local_search_empties_bins():
    bins = packing.Bins(10)
    bins.items = [[(4, 0), (4, 1)], [(6, 2)], [(3, 3), (3, 4)]]      # 8, 6, 6 fit into 10 + 10
    bins.fill = [8, 6, 6]
    bins.search()
    assert sorted(f for f in bins.fill if f) == [10, 10]
    rng = np.random.default_rng(5)
    for high in (60, 300, 700):
        lengths = rng.integers(1, high, 800)
        packed = packing.pack_lengths(lengths, 1024)
        assert sorted(i for b in packed for i in b) == list(range(800))
        assert max(lengths[b].sum() for b in packed) <= 1024
        first = packing.Bins(1024)
        first.best_fit(lengths)
        assert len(packed) <= len(first.items)


def test_local_search_saves_bins_where_best_fit_does_not():
    for low, high, most in ((260, 520, 1.075), (200, 700, 1.006)):
        lengths = np.random.default_rng(0).integers(low, high + 1, 4000)
        first = packing.Bins(1024)
        first.best_fit(lengths)
        packed = packing.pack_lengths(lengths, 1024)
        assert sorted(i for b in packed for i in b) == list(range(4000))
        assert len(packed) < 0.99 * len(first.items)
        assert len(packed) <= most * -(-lengths.sum() // 1024)
