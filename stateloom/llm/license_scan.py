"""Short license notices in whole texts, with a bounded number of edits.

Each notice may differ by ``edits`` inserted, deleted or replaced characters. It is
split into one piece more than that; wherever the notice stands with so few edits,
one piece stands there unchanged (pigeonhole). The pieces are found as plain
substrings, and around each one the regex library's bounded-error matching decides,
counts the edits and gives the span. Base phrases are found through their last word,
and hold where their words stand one after the other with anything between that is
not a word.

Texts are taken without upper case. A null or empty text has no words and no labels,
and the score 0. Rows are scanned one by one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from stateloom.llm.words import ALNUM, Words, pieces

#: Phrases whose words stand consecutively, and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))


@dataclass(frozen=True)
class Notice:
    label: str
    text: str
    edits: int

    def seeds(self) -> list[tuple[int, bytes]]:
        """Offsets and bytes of the pieces: one more than there may be edits."""
        raw = self.text.encode()
        cuts = [len(raw) * k // (self.edits + 1) for k in range(self.edits + 2)]
        return [(a, raw[a:b]) for a, b in zip(cuts, cuts[1:])]

    def pattern(self):
        return regex.compile(f"(?:{regex.escape(self.text)}){{e<={self.edits}}}", regex.ENHANCEMATCH)


#: What the notices say is fixed by the licenses; lower case.
NOTICES = (
    Notice("mit", "released under the mit license", 3),
    Notice("mit", "permission is hereby granted, free of charge, to any person", 4),
    Notice("apache", "licensed under the apache license, version 2.0", 4),
    Notice("gpl", "licensed under the gnu general public license", 4),
    Notice("lgpl", "gnu lesser general public license", 3),
    Notice("agpl", "gnu affero general public license", 3),
    Notice("mpl", "mozilla public license", 2),
    Notice("bsd", "redistribution and use in source and binary forms", 4),
    Notice("cc-by", "licensed under cc by 4.0", 1),
    Notice("cc-by-sa", "licensed under cc by-sa 4.0", 1),
    Notice("cc-by-nc", "licensed under cc by-nc 4.0", 1),
    Notice("unlicense", "free and unencumbered software released into the public domain", 4),
    Notice("all-rights-reserved", "all rights reserved", 1),
)


@dataclass
class Span:
    text: int
    label: str
    start: int  # bytes of the text
    end: int
    edits: int
    similarity: float


def _places(buffer: bytes, seed: bytes) -> list[int]:
    out, at = [], buffer.find(seed)
    while at >= 0:
        out.append(at)
        at = buffer.find(seed, at + 1)
    return out


class Scanner:
    def __init__(self, notices: tuple[Notice, ...] = NOTICES, phrases: tuple[tuple[str, str], ...] = PHRASES):
        self.notices = [(n, n.seeds(), n.pattern()) for n in notices]
        self.phrases = [(p.encode().split(), label) for p, label in phrases]

    def base(self, words: Words) -> list[tuple[int, str]]:
        """The first word of every place of a phrase, and its label."""
        out = []
        for last in {p[-1] for p, _ in self.phrases}:
            at = np.array(_places(words.buffer, last), np.int64)
            k = np.searchsorted(words.starts, at)
            inside = k < len(words)
            k, at = k[inside], at[inside]
            for i in k[(words.starts[k] == at) & (words.ends[k] == at + len(last))].tolist():
                low = words.first[np.searchsorted(words.text_starts, words.starts[i], "right") - 1]
                for phrase, label in self.phrases:
                    begin = i - len(phrase) + 1
                    if begin >= low and all(words.word(begin + j) == w for j, w in enumerate(phrase)):
                        out.append((begin, label))
        return sorted(out)

    def spans(self, words: Words) -> list[Span]:
        """All notices, by text; each with the label, the span and its edits."""
        out = []
        for notice, seeds, pattern in self.notices:
            size = len(notice.text)
            near = []
            for offset, seed in seeds:
                near += [(p - offset - notice.edits, p - offset + size + notice.edits) for p in _places(words.buffer, seed)]
            windows: list[list[int]] = []
            for begin, end in sorted(near):
                if windows and begin <= windows[-1][1]:
                    windows[-1][1] = max(end, windows[-1][1])
                else:
                    windows.append([begin, end])
            for begin, end in windows:
                out += self._verified(words, notice, pattern, max(begin, 1), min(end, len(words.buffer) - 1))
        return out

    @staticmethod
    def _verified(words: Words, notice: Notice, pattern, begin: int, end: int) -> Iterator[Span]:
        """Matches in a window, which may reach over the ends of texts."""
        text = int(np.searchsorted(words.text_starts, begin, "right")) - 1
        while text < len(words.counts) and int(words.text_starts[text]) < end:
            low, high = int(words.text_starts[text]), int(words.text_starts[text + 1]) - 1
            a, b = max(begin, low), min(end, high)
            while a > low and words.buffer[a] & 0xC0 == 0x80:
                a -= 1
            while b < high and words.buffer[b] & 0xC0 == 0x80:
                b += 1
            if b > a:
                window = words.buffer[a:b].decode()
                for m in pattern.finditer(window):
                    edits = sum(m.fuzzy_counts)
                    start = a - low + len(window[: m.start()].encode())
                    yield Span(text, notice.label, start, start + len(m[0].encode()), edits, 1 - edits / len(notice.text))
            text += 1

    def digest(self, texts: list[bytes]) -> dict:
        """The contract's columns of some texts."""
        words = Words(texts, ALNUM)
        n = len(texts)
        n_base, score = [0] * n, [0.0] * n
        first: list = [None] * n
        last: list = [None] * n
        base: list[set[str]] = [set() for _ in range(n)]
        found: list[set[str]] = [set() for _ in range(n)]
        for begin, label in self.base(words):
            i = int(np.searchsorted(words.first, begin, "right")) - 1
            place = begin - int(words.first[i])
            n_base[i] += 1
            first[i] = place if first[i] is None else min(first[i], place)
            last[i] = place if last[i] is None else max(last[i], place)
            base[i].add(label)
            score[i] = 1.0
        for span in self.spans(words):
            found[span.text].add(span.label)
            score[span.text] = max(score[span.text], span.similarity)
        return {
            "n_words": pa.array(words.counts, pa.int64()),
            "n_base": pa.array(n_base, pa.int64()),
            "first_word": pa.array(first, pa.int64()),
            "last_word": pa.array(last, pa.int64()),
            "base_labels": pa.array([",".join(sorted(b)) for b in base], pa.string()),
            "labels": pa.array([",".join(sorted(b | f)) for b, f in zip(base, found)], pa.string()),
            "score": pa.array(score, pa.float64()),
        }


def license_spans(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES) -> DataFrame:
    """One row for each notice found: doc_id, label, start_byte, end_byte, edits, similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch, texts in pieces(batches):
            if spans := scanner.spans(Words(texts, ALNUM)):
                yield pa.record_batch(
                    {
                        "doc_id": batch.column("doc_id").cast(pa.int64()).take(pa.array([s.text for s in spans])),
                        "label": pa.array([s.label for s in spans]),
                        "start_byte": pa.array([s.start for s in spans], pa.int64()),
                        "end_byte": pa.array([s.end for s in spans], pa.int64()),
                        "edits": pa.array([s.edits for s in spans], pa.int32()),
                        "similarity": pa.array([s.similarity for s in spans], pa.float64()),
                    }
                )

    schema = "doc_id long, label string, start_byte long, end_byte long, edits int, similarity double"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def contract(docs: DataFrame) -> DataFrame:
    """Words, places of base phrases, labels and score of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch, texts in pieces(batches):
            yield pa.record_batch({"doc_id": batch.column("doc_id").cast(pa.int64()), **scanner.digest(texts)})

    return docs.select("doc_id", "text").mapInArrow(
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double",
    )
