"""Pieces of texts and texts of pieces, against the library the model comes from."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st

import __spark_entry__ as entry
from odd import no_docs, odd_docs, rows
from pairpulse.llm import pieces

SMALL = "/root/testdata/sf0.001"
PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES = [LIBRARY.id_to_piece(i) for i in range(259, LIBRARY.vocab_size())]


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.Vocabulary(PATH)


def own(vocabulary, texts):
    import pyarrow as pa

    data = pieces.pc.replace_substring(pa.array([t.encode() for t in texts], pa.large_binary()),
                                       pieces.SPACE.encode(), b" ")
    return [ids for _, chunk, bounds in pieces.chunks(data)
            for ids in pieces._encode_chunk(vocabulary, chunk, bounds).to_pylist()]


def agree(vocabulary, texts):
    expected = [LIBRARY.encode(t, add_eos=True) for t in texts]
    assert own(vocabulary, texts) == expected
    bounds = np.cumsum([0, *map(len, expected)])
    ids = np.array([i for x in expected for i in x], np.int64)
    assert pieces.Decoder(vocabulary).texts(ids, bounds).to_pylist() == [LIBRARY.decode(x) for x in expected]


# Texts of odd characters, of spaces and of the vocabulary's own pieces.
_ODD = st.sampled_from(["   ", " ", "▁", "a", "the", "ing", "é", "é", "\n", "\t", "==", "日", "本", "\U0001f9ff",
                        "​", "\x00", "ſ", "aaaaa", " " * 15, "</s>", "<0x41>", "'s", "-"])


@settings(max_examples=150, deadline=None, derandomize=True)
@given(st.lists(st.lists(st.one_of(_ODD, st.sampled_from(PIECES)), max_size=30).map("".join), max_size=8))
def test_ids_and_texts_equal_the_library(vocabulary, texts):
    agree(vocabulary, texts)


@settings(max_examples=100, deadline=None, derandomize=True)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_any_text_equals_the_library(vocabulary, texts):
    agree(vocabulary, [t.encode("utf-8", "ignore").decode() for t in texts])


def test_long_stretches_without_a_cut(vocabulary):
    agree(vocabulary, ["a" * 20_000 + " " * 9_000, "ab" * 6_000, "=" * 5_000 + " " * 33 + "x", "日本語" * 3_000, "", " "])


def test_a_neighbour_changes_nothing(vocabulary):
    texts = ["one  two", "", "three", "\n", " four"]
    assert own(vocabulary, texts) == [own(vocabulary, [t])[0] for t in texts]


def test_decoding_any_ids_equals_the_library(vocabulary):
    chosen = random.Random(5)
    decoder = pieces.Decoder(vocabulary)
    for _ in range(1500):
        ids = [chosen.randrange(300) if chosen.random() < 0.7 else chosen.randrange(32_000)
               for _ in range(chosen.randint(0, 20))]
        bounds = np.array([0, len(ids)])
        assert decoder.texts(np.array(ids, np.int64), bounds).to_pylist() == [LIBRARY.decode(ids)]


def test_pieces_are_found_by_compatible_pairs(vocabulary):
    coder = vocabulary.coder
    assert coder.pieces(" the") == [" the"] and not coder.compatible(" t", "he")
    found = coder.pieces(" unbelievability of it")
    assert all(coder.compatible(a, b) for a, b in zip(found, found[1:]))


def test_query_equals_the_library(spark):
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    found = entry.queries()["op11_piece_encoding"](spark, SMALL)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    for r in found.collect():
        ids = LIBRARY.encode(docs[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(LIBRARY.decode(ids).encode()).hexdigest())
    assert found.count() == len(docs)


def test_odd_rows_there_and_back(spark, vocabulary):
    docs = odd_docs(spark)
    ids = pieces.encoded(docs, vocabulary, "doc_id", "size")
    assert ids.columns == ["doc_id", "size", "ids"]
    got = Counter((r.doc_id, tuple(r.ids)) for r in ids.collect())
    assert got == Counter((r[0], tuple(LIBRARY.encode(r[1] or "", add_eos=True))) for r in rows())
    back = pieces.decoded(ids, vocabulary, "doc_id")
    assert Counter((r.doc_id, r.decoded) for r in back.collect()) == Counter((r[0], r[1] or "") for r in rows())
    assert pieces.encoded(no_docs(spark), vocabulary, "doc_id").count() == 0


def test_odd_lists_of_ids(spark, vocabulary):
    lists = spark.createDataFrame([(1, None), (2, []), (3, [2]), (4, [None, 264, None, 2]), (4, [264])],
                                  "k int, ids array<int>")
    assert Counter(r.decoded for r in pieces.decoded(lists, vocabulary, "k").collect()) == Counter(["", "", "", "a", "a"])


def test_other_models_are_refused(tmp_path, vocabulary, monkeypatch):
    monkeypatch.setattr(pieces, "_PROBES", ["a b"])
    monkeypatch.setattr(pieces.Coder, "ids", lambda self, unit: (0,))
    with pytest.raises(ValueError, match="merge-type"):
        pieces.Vocabulary(PATH)
