"""Encoders that workers keep between tasks."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stateloom.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [b"One word, two words; one more.", "Zwölf Ähren 世界".encode(), b"", b"a <|endoftext|> b"]


def test_a_kept_encoder_knows_the_words_of_the_task_before():
    kept = token_files._encoder(PATH, True)
    kept.encode(TEXTS)
    assert token_files._encoder(PATH, True) is kept and "words;" in token_files._encoder(PATH, True).place
    assert token_files._encoder(PATH, False) is not kept


def test_a_kept_encoder_is_right_behind_a_task_that_broke_off(monkeypatch):
    encoder = token_files.WordEncoder(PATH)
    encoder.encode(TEXTS[:1])
    with monkeypatch.context() as patch:
        patch.setattr(encoder, "_learn", lambda: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            encoder.encode([b"never learned"])
    library = Tokenizer.from_file(PATH)
    for text, ids in zip([*TEXTS, b"learned never"], encoder.encode([*TEXTS, b"learned never"])):
        assert np.array_equal(ids, [*library.encode(text.decode(), add_special_tokens=False).ids, token_files.END_ID])


def test_words_that_differ_in_the_marks_behind_them_are_split_once(monkeypatch):
    encoder = token_files.WordEncoder(PATH)
    encoder.encode([b"zebra giraffe"])
    asked, model = [], encoder.model

    class Counting:
        def tokenize(self, part):
            asked.append(part)
            return model.tokenize(part)

    monkeypatch.setattr(encoder, "model", Counting())
    encoder.encode([b"zebra, zebra. zebra### giraffe### giraffe,"])
    assert sorted(asked) == ["###", ",", "."]


def test_marks_behind_words_leave_the_ids_of_the_library_also_behind_forgetting(monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_MARKS", 2)
    encoder = token_files.WordEncoder(PATH, kept=8)
    library = Tokenizer.from_file(PATH)
    texts = [
        "one one, one. one### one' one's one's' don't, don't one_ _one ___", "one, zwölf zwölf... Zwölf!? été« «été 世界。世界, 42, 4,2",
        "naïve, naïve; naïve naïvé naïve x,  , ʼn, x²; ½, é, one's, 'll 'll, we'll'", "one one, ... ,,, zwölf, été, été", "",
    ]
    for _ in range(3):
        for text in texts:
            (ids,) = encoder.encode([text.encode()])
            assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, token_files.END_ID], text
        together = encoder.encode([t.encode() for t in texts])
        assert [len(t) for t in together] == [len(library.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
