import random

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ratewright.llm import pieces


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_file())


@pytest.fixture(scope="module")
def model():
    return pieces.Pieces(pieces.model_file())


WORDS = ["the", "internationalisation", " ", "  ", "\n", "\t", "é", "漢字", "\U0001d11e", "ing", "tion", "1234567890", "aaaa", "\x00", "...", "=====", " ", "Ünder"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(WORDS), max_size=20).map("".join))
def test_ids_are_those_of_the_library(text):
    found = pieces.pieces(pieces.model_file()).encode(text).tolist()
    known = sentencepiece.SentencePieceProcessor(model_file=pieces.model_file())
    assert found == known.encode(text)
    assert pieces.pieces(pieces.model_file()).decode(found) == text


def test_whole_texts_and_round_trip(model, library, texts):
    for text in texts.values():
        ids = model.encode(text)
        assert ids.tolist() == library.encode(text)
        assert model.decode(ids) == text


def test_long_words_are_committed_on_the_way(model, library):
    rng = random.Random(3)
    for letters in ("ab", "the", "aeionrst", "=-", "0123456789abcdef"):
        text = "".join(rng.choices(letters, k=5000))
        assert model.search(text) == [library.piece_to_id(p) for p in library.encode("\n" + text, out_type=str)[2:]]


def test_decode_is_lenient(model):
    assert model.decode([]) == "" and model.decode([-1, 99999999, None]) == ""
    assert model.decode(np.array([1, 2])) == ""
    assert model.decode([model.bytes[0xC3]]) == "�"


def test_tables(odd, odd_rows, make):
    encoded = pieces.encode(odd, keep=("doc_id", "spans"))
    rows = encoded.collect()
    assert sorted(len(r["ids"]) for r in rows) == sorted(r["n_ids"] for r in rows)
    assert {r["doc_id"] for r in rows if not r["exact"]} == {8}  # holds the mark itself
    back = {(r["doc_id"], r["text"]) for r in pieces.decode(encoded).collect()}
    assert back == {(r[0], (r[1] or "").replace("▁", " ")) for r in odd_rows}
    assert pieces.encode(make([])).collect() == []
    digest = pieces.digest(odd).collect()
    assert len(digest) == len(odd_rows) and sum(not r["exact"] for r in digest) == 1
