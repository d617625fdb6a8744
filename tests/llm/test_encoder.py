"""Pieces whose ids are remembered: few, and the same ids as of whole texts."""

from __future__ import annotations

import random

import numpy as np
import pytest

from tributary.llm import queries, token_files

KIND = token_files.id_type(queries.WORD_BPE_VOCABULARY)
LETTERS = list("abehHtTsSKİIıéÉßẞÄäñµªº×÷ÿÀΣςσŉǰﬁK日本\x00\x0b\x85̱́̊̈ͅ‍ ’　😀")
MARKS = list("'.,!?-_<>|()\"*$%#@^`~[]{}\\/:;&+=")
PIECES = ["'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "12", "The", "can't", "o'", "e.g.", "x" * 70, "--"]


def texts_of(seed: int, n: int) -> list[str]:
    rng = random.Random(seed)
    kinds = [LETTERS, MARKS, [" ", " ", "  ", "\n", "\t", "\r\n"], PIECES]
    return ["".join(rng.choice(rng.choice(kinds)) for _ in range(rng.randrange(25))) for _ in range(n)]


@pytest.mark.parametrize("remembered", [50, 300_000])
def test_pieces_give_the_ids_of_whole_texts(monkeypatch, remembered):
    monkeypatch.setattr(token_files, "KNOWN_PIECES", remembered)
    encoder = token_files.Encoder(queries.word_bpe(), KIND)
    for seed in range(20):
        texts = texts_of(seed, 200)
        whole = encoder.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        assert list(encoder.batch(texts)) == [np.array(e.ids, KIND).tobytes() for e in whole]


def test_a_word_is_remembered_once_in_any_case_and_before_any_mark():
    encoder = token_files.Encoder(queries.word_bpe(), KIND)
    list(encoder.batch(["Table table TABLE, table. (x) Größe größe; table."]))
    assert set(encoder.known) == {"table", ",", ".", ";", "(x)", "größe"}


def test_words_of_late_stay_known(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_PIECES", 4)
    encoder = token_files.Encoder(queries.word_bpe(), KIND)
    learned = []
    learn = encoder._learn
    monkeypatch.setattr(encoder, "_learn", lambda pieces: (learned.extend(sorted(pieces)), learn(pieces)))
    for text in ("one two three four", "five one", "one six"):
        list(encoder.batch([text]))
    assert learned == ["four", "one", "three", "two", "five", "six"]
