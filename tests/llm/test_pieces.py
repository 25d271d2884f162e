"""The piece vocabulary against the sentencepiece library itself."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
from cases import documents, frame
from test_queries import sample

from vestibule.llm import pieces
from vestibule.llm.queries import PIECE_VOCABULARY, queries, tokenizer_path

PATH = tokenizer_path(PIECE_VOCABULARY)
PARTS = ["a", "b", "the", "ing", " ", "  ", "▁", "\n", "\t", "\r\n", "é", "é", "中", "文", "①", "\x00"]
PARTS += ["😀", "‍", "Ａ", "　", "<s>", "</s>", "<0x41>", "<unk>", "!!", "==", "    ", "xxxxx", "1", "²"]
PARTS += ["_", "²._", "ß", "İ", "‮", "﻿", "ﬁ", "한국", ".com", "'s", "½"]


@pytest.fixture(scope="module")
def model():
    return pieces.PieceModel(PATH)


@pytest.mark.parametrize("remembered", [pieces.REMEMBERED, 20])
def test_encoder_equals_the_library(model, remembered, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED", remembered)
    rng = random.Random(5)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(25))) for _ in range(4000)]
    texts += ["a" * 70000, "é" * 20000, " " * 5000, "ab" * 30000 + " x", "中文" * 9000]
    for text, want in zip(texts, model.library.encode(texts), strict=True):
        ids = model.encode(text)
        assert ids.tolist() == want, text
        assert model.decode(ids) == model.library.decode(want), text


def test_every_character_equals_the_library(model):
    some = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (c < 0x3400 or c % 97 == 0)]
    texts = [f"a{chr(c)} {chr(c)}b{chr(c)}." for c in some]
    for text, want in zip(texts, model.library.encode(texts), strict=True):
        assert model.encode(text).tolist() == want, text


def test_any_ids_read_back_as_in_the_library(model):
    """Also bytes that make no character, control ids and the unknown id."""
    rng = random.Random(6)
    odd = [0, 1, 2, 259, 29871, 3 + 0xE4, 3 + 0xB8, 3 + 0xAD, 3 + 0xF0, 3 + 0x41]
    for _ in range(6000):
        ids = rng.choices([*odd, rng.randrange(3, 259), rng.randrange(259, 32000)], k=rng.randrange(12))
        assert model.decode(np.array(ids, np.int32)) == model.library.decode(ids), ids


def test_runs_that_the_library_has_other_ids_for_are_told(monkeypatch):
    """Also runs that are too long to be remembered, and those a worker has met before."""
    model, asked = pieces.PieceModel(PATH), []

    class Other:
        def encode(self, texts, num_threads):
            asked.extend(texts)
            return [[5] if t in ("odd", " odd", "x" * 100) else model_library.encode(t) for t in texts]

    model_library = model.library
    model.library = Other()
    texts = ["an odd text", "a fine text", "odd", "a  odd", "x" * 100 + " y", "fine odd.", "", "fine"]
    for _ in range(2):
        model.encode_all(texts)
        assert [model.agrees(t) for t in texts] == [False, True, False, False, False, True, True, True]
    assert asked.count("fine") == 1 and asked.count("odd") == 1


def test_words_are_joined_best_score_first_then_leftmost():
    order = {"ab": 1, "bc": 0, "abc": 2, "aa": 3}
    assert pieces.join_symbols("abc", order) == ["abc"]
    assert pieces.join_symbols("abcd", {"ab": 1, "bc": 0}) == ["a", "bc", "d"]
    assert pieces.join_symbols("aaaaa", order) == ["aa", "aa", "a"]
    assert pieces.join_symbols("", order) == []


def test_pieces_that_reach_across_words_are_an_error():
    with pytest.raises(ValueError, match="within words"):
        pieces.word_patterns(["a▁b"])
    words, cut = pieces.word_patterns(["▁a", "m²", "²."])  # letters before punctuation count as such
    assert words.findall("▁am².▁b\nc") == ["▁a", "m².▁b", "\n", "c"]
    assert [m.start() for m in cut.finditer("▁am².▁b\nc")] == [2, 7, 8, 9]


def test_documents_with_awkward_rows(spark, model):
    rows = [*documents(5), (None, "no id"), (None, None), (7, "É" * 100_000), (8, "word " * 300_000)]
    got = pieces.encode_pieces(frame(spark, rows), PATH).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    want = [(i, model.library.encode(t or ""), model.library.decode(model.library.encode(t or "")), True) for i, t in rows]
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert pieces.encode_pieces(frame(spark, []), PATH).count() == 0


def test_the_query_over_the_sample(spark, model):
    folder = sample("0.001")
    want = []
    for doc_id, text in duckdb.sql(f"SELECT doc_id, text FROM '{folder}/documents.parquet'").fetchall():
        ids = model.library.encode(text or "")
        read = model.library.decode(ids).encode()
        digests = [hashlib.sha256(raw).hexdigest() for raw in (",".join(map(str, ids)).encode(), read)]
        want.append((doc_id, len(ids), *digests, True))
    assert sorted(map(tuple, queries()["op13_sentencepiece"](spark, folder).collect())) == sorted(want)
