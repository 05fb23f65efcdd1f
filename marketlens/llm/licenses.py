"""License scan: fuzzy search for short notices.

Texts are reduced to words (a-z, digits, all beyond ASCII; A-Z lower-cased) one
space apart. A notice of n characters may differ by k = n // 10 edits, at least one. Cut into
k + 1 pieces, one piece of any such match is exact (pigeonhole); one automaton
finds the pieces of all notices in a single pass, and around each the regex
library's bounded-error matching verifies the notice and tells its edits and span.
The words that tell one license from another must stand exactly in the match, so
that a version number or a clause does not pass as an edit.

Exact phrases are counted beside it, word by word.

Defined results: null texts are empty; overlapping finds of one notice count
once, with the fewest edits; a text without words has no labels and score 0; an
empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm.common import small_batches, table

# Phrases whose places are counted, and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Notices searched for with edits, their labels, and the words that
# must stand exactly.
NOTICES = [
    ("released under the mit license", "mit", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", "granted"),
    ("licensed under the apache license version 2 0", "apache-2", "apache 2"),
    ("licensed under cc by nc 4 0", "cc-by-nc", "cc nc"),
    ("creative commons attribution noncommercial", "cc-by-nc", "noncommercial"),
    ("licensed under the gnu general public license version 3", "gpl-3", "general 3"),
    ("licensed under the gnu general public license version 2", "gpl-2", "general 2"),
    ("gnu lesser general public license", "lgpl", "lesser"),
    ("redistribution and use in source and binary forms with or without modification", "bsd", "redistribution"),
    ("mozilla public license version 2 0", "mpl-2", "mozilla 2"),
]
# The short forms, likewise. A find that overlaps one of a longer notice
# of the same label is part of it and not counted.
SHORT_NOTICES = [
    ("under the mit license", "mit", "mit"),
    ("apache license version 2", "apache-2", "apache 2"),
    ("cc by nc", "cc-by-nc", "cc nc"),
    ("gnu general public license version 3", "gpl-3", "gnu general 3"),
    ("gnu general public license version 2", "gpl-2", "gnu general 2"),
    ("gpl version 3", "gpl-3", "gpl 3"),
    ("gpl version 2", "gpl-2", "gpl 2"),
    ("lesser general public license", "lgpl", "lesser"),
    ("bsd license", "bsd", "bsd"),
    ("mozilla public license 2 0", "mpl-2", "mozilla 2"),
]
_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def text_words(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").translate(_LOWER))


def allowed_edits(notice: str) -> int:
    return max(1, len(notice) // 10)


def pieces(notice: str) -> list[tuple[int, str]]:
    """(start, piece): one more than the edits allowed."""
    count = allowed_edits(notice) + 1
    cuts = [len(notice) * k // count for k in range(count + 1)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]


class NoticeSearch:
    def __init__(self, notices: list[tuple[str, str, str]]) -> None:
        self._notices = notices
        self._automaton = ahocorasick.Automaton()
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, _, _) in enumerate(notices):
            for start, piece in pieces(notice):
                seeds.setdefault(piece, []).append((k, start))
        for piece, places in seeds.items():
            self._automaton.add_word(piece, (len(piece), places))
        self._automaton.make_automaton()
        self._patterns = [
            regex.compile(rf"(?b)(?:{regex.escape(notice)}){{e<={allowed_edits(notice)}}}") for notice, _, _ in notices
        ]

    def _windows(self, text: str) -> dict[int, list[list[int]]]:
        """By notice, where a match may lie; windows that meet are one."""
        windows: dict[int, list[list[int]]] = {}
        for end, (size, places) in self._automaton.iter(text):
            for k, start in places:
                notice, slack = self._notices[k][0], allowed_edits(self._notices[k][0])
                begin = end + 1 - size - start
                window = [max(0, begin - slack), min(len(text), begin + len(notice) + slack)]
                windows.setdefault(k, []).append(window)
        for k, found in windows.items():
            found.sort()
            merged = [found[0]]
            for window in found[1:]:
                if window[0] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], window[1])
                else:
                    merged.append(window)
            windows[k] = merged
        return windows

    def _matches(self, k: int, text: str, begin: int, end: int) -> Iterator[regex.Match]:
        """All matches in a window that do not overlap. The search gives the best one of
        the window, so what lies before it is searched as well as what lies behind."""
        open_parts = [(begin, end)]
        while open_parts:
            begin, end = open_parts.pop()
            match = self._patterns[k].search(text, begin, end)
            if match is not None and match.end() > match.start():
                yield match
                open_parts += [(begin, match.start()), (match.end(), end)]

    def find(self, text: str) -> list[tuple[str, int, int, int, float]]:
        """(label, start, end, edits, likeness) of each match in ``text``."""
        found = []
        # Longer notices come first in the list, so that short forms see their finds.
        for k, windows in sorted(self._windows(text).items()):
            notice, label, exact = self._notices[k]
            longer = list(found)
            for begin, end in windows:
                for match in self._matches(k, text, begin, end):
                    # Words cut off by the match are not those words: "20" is not "2".
                    first = text.rfind(" ", 0, match.start() + 1) + 1
                    last = text.find(" ", max(match.end() - 1, first))
                    whole = set(text[first : last if last >= 0 else len(text)].split())
                    words = set(text[match.start() : match.end()].split()) & whole
                    if set(exact.split()) <= words and not any(
                        label == other[0] and match.start() < other[2] and other[1] < match.end() for other in longer
                    ):
                        edits = sum(match.fuzzy_counts)
                        found.append((label, match.start(), match.end(), edits, 1 - edits / len(notice)))
        return sorted(found, key=lambda f: f[1:])


def phrase_places(joined: str) -> list[tuple[int, str]]:
    """(word, label) of every place of an exact phrase, words counted from 0."""
    places = []
    padded = f" {joined} "
    for phrase, label in PHRASES.items():
        at = padded.find(f" {phrase} ")
        while at >= 0:
            places.append((padded.count(" ", 0, at), label))
            at = padded.find(f" {phrase} ", at + 1)
    return sorted(places)


def scan(documents: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, n_words, ``phrases`` (word, label) of exact
    phrases, ``notices`` (label, first_word, last_word, edits, likeness) found with
    edits. Spans are in words of the text."""
    schema = (
        "doc_id {id}, n_words long, phrases array<struct<word: long, label: string>>, notices "
        "array<struct<label: string, first_word: long, last_word: long, edits: int, likeness: double>>"
    ).format(id=documents.schema[doc_id].dataType.simpleString())

    def scanned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        search = NoticeSearch(NOTICES + SHORT_NOTICES)
        for batch in batches:
            rows = []
            for text in batch["text"]:
                words = text_words(text)
                joined = " ".join(words)
                notices = [
                    (label, joined.count(" ", 0, start), joined.count(" ", 0, end), edits, likeness)
                    for label, start, end, edits, likeness in search.find(joined)
                ]
                rows.append((len(words), phrase_places(joined), notices))
            found = pd.DataFrame(rows, columns=["n_words", "phrases", "notices"], index=batch.index)
            yield pd.concat([batch[["doc_id"]], found], axis=1)

    chosen = small_batches(documents).select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInPandas(scanned, schema)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phrases and notices of every document."""
    found = scan(table(spark, sf_dir, "documents"))
    base = F.array_sort(F.array_distinct("phrases.label"))
    both = F.array_sort(F.array_distinct(F.concat("phrases.label", "notices.label")))
    best = F.coalesce(F.array_max("notices.likeness"), F.lit(0.0))
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.word").alias("first_word"),
        F.array_max("phrases.word").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0).otherwise(best).alias("score"),
    )
