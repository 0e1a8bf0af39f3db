"""Encoders that go with their task, as in the pipeline."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from stateloom.llm import token_files

PATH = str(public_tokenizers.path("word_bpe_49k.json"))


def test_a_worker_reads_its_tokenizer_once():
    first, second = token_files._encoder(PATH, False), token_files._encoder(PATH, False)
    assert first is not second and first.tokenizer is second.tokenizer
    first.encode([b"zebra"])
    assert "zebra" not in second.place


def test_a_short_encoder_takes_short_pieces_and_gives_the_ids_of_the_library(monkeypatch):
    texts = ["one two " * 40_000, None, "", "Zwölf Ähren " * 50_000, "a <|endoftext|> b"] * 2
    run = {}

    class Docs:
        def select(self, *_):
            return self

        def mapInArrow(self, function, schema):
            run["function"] = function

    token_files._encoded(Docs(), PATH, False)
    sizes, encode = [], token_files.WordEncoder.encode
    monkeypatch.setattr(token_files.WordEncoder, "encode", lambda self, t: sizes.append([len(x) for x in t]) or encode(self, t))
    batch = pa.record_batch({"doc_id": pa.array(range(10), pa.int64()), "text": pa.array(texts, pa.string())})
    out = pa.Table.from_batches(run["function"](iter([batch]))).to_pylist()
    assert all(len(s) == 1 or sum(s) <= token_files.SHORT_PIECE for s in sizes) and len(sizes) > 2
    library = Tokenizer.from_file(PATH)
    for k, (row, text) in enumerate(zip(out, texts, strict=True)):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, token_files.END_ID]
        assert (row["doc_id"], row["n"], np.frombuffer(row["ids"], "<u2").tolist()) == (k, len(ids), ids)


def test_words_forgotten_within_a_task_keep_their_ids(monkeypatch):
    library, encoder = Tokenizer.from_file(PATH), token_files.WordEncoder(PATH, kept=50)
    for k in range(6):
        text = " ".join(f"word{chr(97 + j % 26)}{chr(97 + (j * k) % 26)}" for j in range(200))
        (ids,) = encoder.encode([text.encode()])
        assert ids.tolist() == [*library.encode(text, add_special_tokens=False).ids, token_files.END_ID]
