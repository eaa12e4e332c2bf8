"""License notices in texts, found with a bounded number of edits.

A text is lower-cased (A-Z) and reduced to its words, joined by single spaces. A notice that may be found
with k edits is cut into k + 1 pieces; k edits leave at least one piece whole, so every place worth a look
holds one of the pieces exactly. One automaton finds the pieces of all notices in a pass over the text. Round
each piece the stretch that the notice could fill is checked by the ``regex`` library's matching with at most
k errors, which also gives the span. Overlapping stretches of a notice are joined first, so a notice repeated
a thousand times is one search over its stretch of text. Phrases with k = 0 are whole words in a row.

Edits may not fall on what tells licences apart: the words that name a notice's licence must stand in a row, unchanged
and as whole words, in the words that the match touches. Of matches that overlap and have different labels the one
with the smallest share of edits stays, the longer one of a tie. Base phrases are not part of that.

Null and empty texts have no words and no labels; texts of any length are scanned whole; repeated rows get equal
results; other columns are not read, whatever their names; an empty table gives no rows. The work is one pass per
document; nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankweave.llm import words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

# Phrases that are searched word for word, and their labels.
PHRASES = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)
# Short notices as published, searched with edits: (words, label, the words that name the licence).
NOTICES = (
    ("released under the mit license", "mit", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software", "mit", "any person obtaining"),
    ("spdx license identifier mit", "mit", "mit"),
    ("licensed under the apache license version 2 0", "apache-2", "apache license version 2"),
    ("licensed under the apache license version 1 1", "apache-1", "apache license version 1"),
    ("spdx license identifier apache 2 0", "apache-2", "apache 2"),
    ("licensed under cc by 4 0", "cc-by", "cc by"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc by nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa", "cc by sa"),
    ("licensed under cc by nd 4 0", "cc-by-nd", "cc by nd"),
    ("licensed under cc by nc sa 4 0", "cc-by-nc-sa", "cc by nc sa"),
    ("licensed under cc by nc nd 4 0", "cc-by-nc-nd", "cc by nc nd"),
    ("creative commons attribution noncommercial", "cc-by-nc", "attribution noncommercial"),
    ("creative commons attribution noncommercial sharealike", "cc-by-nc-sa", "attribution noncommercial sharealike"),
    ("creative commons attribution sharealike", "cc-by-sa", "attribution sharealike"),
    ("licensed under the gnu general public license", "gpl", "gnu general"),
    ("gnu lesser general public license", "lgpl", "lesser"),
    ("gnu affero general public license", "agpl", "affero"),
    ("released under the gpl license", "gpl", "gpl"),
    ("released under the bsd license", "bsd", "bsd"),
    ("released under the mpl license", "mpl", "mpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", "redistribution"),
    ("subject to the terms of the mozilla public license", "mpl", "mozilla"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", "permission to use"),
    ("made available under the terms of the eclipse public license", "epl", "eclipse"),
    ("distributed under the boost software license", "bsl", "boost"),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered"),
)
# One edit per so many characters of a notice, and at most so many.
CHARS_PER_EDIT = 12
MOST_EDITS = 4


@dataclass(frozen=True)
class Notice:
    words: str
    label: str
    edits: int
    base: bool
    names: str = ""

    def named_in(self, found: str) -> bool:
        """Whether the words that name the licence stand in a row in ``found``, words with one space between."""
        return f" {self.names} " in f" {found} "

    def pieces(self) -> list[tuple[int, str]]:
        """``edits`` + 1 pieces of nearly equal length with their places; a phrase is one piece with its limits."""
        if self.base:
            return [(-1, f" {self.words} ")]
        n, parts = len(self.words), self.edits + 1
        cuts = [n * k // parts for k in range(parts + 1)]
        return [(a, self.words[a:b]) for a, b in zip(cuts, cuts[1:])]


def catalogue(phrases=PHRASES, notices=NOTICES) -> list[Notice]:
    exact = [Notice(text, label, 0, True) for text, label in phrases]
    return exact + [
        Notice(text, label, max(1, min(MOST_EDITS, len(text) // CHARS_PER_EDIT)), False, names) for text, label, names in notices
    ]


class Scanner:
    """The automaton of all pieces and the compiled notices; built once per task."""

    def __init__(self, notices: list[Notice]):
        import ahocorasick
        import regex

        self.notices = notices
        self.automaton = ahocorasick.Automaton()
        held: dict[str, list[tuple[int, int]]] = {}
        for number, notice in enumerate(notices):
            for at, piece in notice.pieces():
                held.setdefault(piece, []).append((number, at))
        for piece, users in held.items():
            self.automaton.add_word(piece, (len(piece), users))
        self.automaton.make_automaton()
        self.patterns = [
            None if n.base else regex.compile(f"(?e)(?:{regex.escape(n.words)}){{e<={n.edits}}}") for n in notices
        ]

    def spans(self, plain: str) -> Iterator[tuple[int, int, int, int]]:
        """(notice, first character, end, edits) in a text of words with one space before, between and after."""
        near: dict[int, list[list[int]]] = {}
        for last, (length, users) in self.automaton.iter(plain):
            begin = last - length + 1
            for number, at in users:
                notice = self.notices[number]
                if notice.base:
                    yield number, begin + 1, last, 0
                    continue
                a = max(0, begin - at - notice.edits)
                b = min(len(plain), begin - at + len(notice.words) + notice.edits)
                stretches = near.setdefault(number, [])
                if stretches and a <= stretches[-1][1]:
                    stretches[-1][0] = min(a, stretches[-1][0])
                    stretches[-1][1] = max(b, stretches[-1][1])
                else:
                    stretches.append([a, b])
        for number, stretches in near.items():
            for a, b in stretches:
                for found in self.patterns[number].finditer(plain, a, b):
                    begin, end = found.span()
                    # the words that the match touches, to their ends
                    first, last = plain.rfind(" ", 0, begin + 1) + 1, plain.find(" ", max(end - 1, 0))
                    if self.notices[number].named_in(plain[first:last]):
                        yield number, begin, end, sum(found.fuzzy_counts)

    def closest(self, spans: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
        """``spans`` without those that overlap a closer one of another label; base phrases all stay."""
        kept = [h for h in spans if self.notices[h[0]].base]
        share = lambda h: (h[3] / len(self.notices[h[0]].words), h[1] - h[2], h[1], h[0])
        taken: list[tuple[int, int, str]] = []  # by start; those of one label may overlap
        longest = max((h[2] - h[1] for h in spans), default=0)
        for hit in sorted((h for h in spans if not self.notices[h[0]].base), key=share):
            number, begin, end, _ = hit
            label = self.notices[number].label
            low, high = bisect_left(taken, (begin - longest,)), bisect_left(taken, (end,))
            if all(b <= begin or other == label for _, b, other in taken[low:high]):
                insort(taken, (begin, end, label))
                kept.append(hit)
        return kept

    def scan(self, text: str | None) -> dict:
        found = WORD.findall((text or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
        plain = f" {' '.join(found)} "
        out, at, spaces, best = [], 0, 0, 0.0
        for number, begin, end, edits in sorted(self.closest(list(self.spans(plain))), key=lambda h: h[1]):
            begin += plain[begin] == " "
            spaces += plain.count(" ", at, begin)
            at = begin
            notice = self.notices[number]
            score = 1.0 - edits / len(notice.words)
            best = max(best, score)
            out.append((notice.label, notice.base, spaces - 1, plain[begin:end].strip().count(" ") + 1, edits, score))
        base = [h for h in out if h[1]]
        return {
            "n_words": len(found),
            "n_base": len(base),
            "first_word": base[0][2] if base else None,
            "last_word": base[-1][2] if base else None,
            "base_labels": ",".join(sorted({h[0] for h in base})),
            "labels": ",".join(sorted({h[0] for h in out})),
            "score": best,
            "spans": [dict(zip(("label", "base", "word", "n_words", "edits", "score"), h)) for h in out],
        }


SPAN = pa.struct(
    [("label", pa.string()), ("base", pa.bool_()), ("word", pa.int64()), ("n_words", pa.int64()), ("edits", pa.int32()), ("score", pa.float64())]
)
FOUND = pa.schema(
    [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(SPAN))]
)
FOUND_SQL = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label:string,base:boolean,word:bigint,n_words:bigint,edits:int,score:double>>"
)


def scanned(docs: DataFrame, id_col: str = "doc_id", text: str = "text", notices: list[Notice] | None = None) -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of every document.

    ``spans`` are all finds in order: label, base or not, first word, words, edits, score. ``score`` is that of the
    best find, 1 less its edits per character.
    """
    notices = notices or catalogue()
    source = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text"))

    def kernel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(notices)
        for batch in batches:
            for part in words.slices(batch, "text"):
                found = pa.Table.from_pylist([scanner.scan(x) for x in part.column("text").to_pylist()], FOUND)
                columns = [c.combine_chunks() for c in found.columns]
                yield pa.record_batch([part.column("id"), *columns], ["id", *FOUND.names])

    return source.mapInArrow(kernel, f"id {source.schema['id'].dataType.simpleString()}, {FOUND_SQL}")
