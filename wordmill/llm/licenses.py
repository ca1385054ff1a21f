"""License scans by fuzzy search for short notices (operator 12).

A text becomes its words (A-Z lower-cased) with single spaces between. A notice
of at most ``k`` edits keeps at least one of its ``k + 1`` pieces unchanged
(pigeonhole), so one Aho-Corasick pass for all pieces of all notices finds
every place where a notice can be. Only there the ``regex`` library matches
the notice with at most ``k`` errors, whole words at both ends; it gives the
span and the number of edits. Words that tell a license from another (in
brackets below) take no edit: ``under the mpl license`` is no ``mit`` notice.

Texts are independent of each other: one pass, no shuffle.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import text_slices

# Fixed values of the query's contract: base phrases and their labels.
BASE: tuple[tuple[str, str], ...] = (
    ("mit", "under the [mit] license"),
    ("apache-2", "[apache] license version [2]"),
    ("cc-by-nc", "[cc by nc]"),
)
# Labels and short notices beside them; words in brackets must be exact.
NOTICES: tuple[tuple[str, str], ...] = (
    ("agpl", "gnu [affero] general public license"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("bsd", "under the [bsd] license"),
    ("cc-by-nc", "creative commons attribution [noncommercial]"),
    ("cc-by-nc", "creative commons attribution [non commercial]"),
    ("cc-by-sa", "creative commons attribution [sharealike]"),
    ("cc-by-sa", "creative commons attribution [share alike]"),
    ("cc0", "[cc0] 1 0 universal"),
    ("gpl", "gnu [general public] license"),
    ("isc", "permission to use copy modify and or distribute this software"),
    ("lgpl", "gnu [lesser] general public license"),
    ("mit", "permission is hereby granted free of charge to any person"),
    ("mpl-2", "[mozilla] public license version [2]"),
    ("mpl-2", "[mozilla] public license v [2]"),
    ("unlicense", "free and unencumbered software released into the public domain"),
)
CHARS_PER_EDIT = 10
MAX_EDITS = 4

# Bytes of a text: A-Z to a-z, every other ASCII byte that is in no word to a
# space. Bytes of other characters stay, so the text stays UTF-8.
_WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                    for c in range(256))

SPANS = "array<struct<label: string, notice: string, first_word: bigint, n_words: bigint, edits: int, found: string>>"
_SPAN_TYPE = pa.list_(pa.struct([("label", pa.string()), ("notice", pa.string()), ("first_word", pa.int64()),
                                 ("n_words", pa.int64()), ("edits", pa.int32()), ("found", pa.string())]))


def words_text(text: str) -> str:
    """The words of a text, A-Z lower-cased, each between two spaces; a single
    space if it has none."""
    words = text.encode().translate(_WORD_BYTES).split()
    return (b" " + b" ".join(words) + b" ").decode() if words else " "


@dataclass(frozen=True)
class Notice:
    """``text`` without brackets, the edits it may have, its exact pieces as
    (offset, piece), the pattern of its fuzzy form, and whether the contract
    names it as a base phrase."""
    label: str
    text: str
    edits: int
    pieces: tuple[tuple[int, str], ...]
    pattern: regex.Pattern
    base: bool


def _segments(marked: str) -> list[tuple[bool, str]]:
    """(exact, text) runs; an exact run has the spaces around it."""
    out: list[tuple[bool, str]] = []
    exact = False
    for part in regex.split(r"([\[\]])", marked):
        if part in ("[", "]"):
            exact = part == "["
        elif part:
            out.append((exact, part))
    for i, (exact, part) in enumerate(out):
        if not exact:
            cut = part[1:] if i and part.startswith(" ") else part
            out[i] = (False, cut[:-1] if i + 1 < len(out) and cut.endswith(" ") else cut)
        else:
            out[i] = (True, " " * (i > 0) + part + " " * (i + 1 < len(out)))
    return [(exact, part) for exact, part in out if part]


def make_notice(label: str, marked: str, base: bool = False) -> Notice:
    text = marked.replace("[", "").replace("]", "")
    if words_text(text) != f" {text} ":
        raise ValueError(f"not words with single spaces: {text!r}")
    k = min(len(text) // CHARS_PER_EDIT, MAX_EDITS)
    cuts = [len(text) * i // (k + 1) for i in range(k + 2)]
    pieces = tuple((a, text[a:b]) for a, b in zip(cuts, cuts[1:]))
    body = "".join(regex.escape(part, literal_spaces=True) if exact or not k else
                   f"(?:{regex.escape(part, literal_spaces=True)}){{e<={k}}}" for exact, part in _segments(marked))
    return Notice(label, text, k, pieces, regex.compile(f"(?b)(?<= )(?:{body})(?= )"), base)


class Scanner:
    """Finds all notices in a text of words; one per task."""

    def __init__(self, base: Sequence[tuple[str, str]], notices: Sequence[tuple[str, str]]):
        self.notices = [make_notice(*n, base=True) for n in base] + [make_notice(*n) for n in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, notice in enumerate(self.notices):
            for offset, piece in notice.pieces:
                seeds.setdefault(piece, []).append((i, offset + len(piece) - 1))
        self.machine = ahocorasick.Automaton()
        for piece, uses in seeds.items():
            self.machine.add_word(piece, uses)
        self.machine.make_automaton()

    def spans(self, words: str) -> list[tuple[Notice, int, int, int]]:
        """``(notice, start, end, edits)`` in order of place. A base phrase is
        given at each place where it stands unchanged; else, of overlapping
        spans of a notice, the one with the fewest edits (then the first)."""
        starts = {(i, end - back) for end, uses in self.machine.iter(words) for i, back in uses}
        found: dict[int, dict[tuple[int, int], int]] = {}
        for i, at in sorted(starts):
            notice = self.notices[i]
            n = len(notice.text)
            if words.startswith(f" {notice.text} ", at - 1):
                found.setdefault(i, {})[at, at + n] = 0
                continue
            if not notice.edits:
                continue
            k = notice.edits
            m = notice.pattern.search(words, max(0, at - k), min(len(words), at + n + k + 1))
            if m and sum(m.fuzzy_counts) <= k:
                found.setdefault(i, {})[m.span()] = sum(m.fuzzy_counts)
        out = []
        for i, places in found.items():
            notice = self.notices[i]
            whole = sorted((a, b, 0) for (a, b), edits in places.items() if notice.base and not edits)
            ranked = sorted((edits, a, b) for (a, b), edits in places.items() if edits or not notice.base)
            out += [(notice, *span) for span in whole + _apart(whole, ranked)]
        return sorted(out, key=lambda s: (s[1], s[2], s[0].label, s[0].text))


def _apart(taken: list[tuple[int, int, int]], ranked: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The spans of ``ranked`` (edits, start, end; best first) that overlap
    neither one of ``taken`` nor a better one."""
    spans, kept = list(taken), []
    for edits, a, b in ranked:
        i = bisect_left(spans, (a, b, -1))
        if (i and spans[i - 1][1] > a) or (i < len(spans) and spans[i][0] < b):
            continue
        insort(spans, (a, b, edits))
        kept.append((a, b, edits))
    return kept


def _row(scanner: Scanner, text: str) -> dict:
    words = words_text(text)
    spans, base, at, n_before = [], [], 0, -1
    best = 0.0
    for notice, start, end, edits in scanner.spans(words):
        n_before, at = n_before + words.count(" ", at, start), start
        best = max(best, 1 - edits / len(notice.text))
        if notice.base and not edits:
            base.append((notice.label, n_before))
        spans.append({"label": notice.label, "notice": notice.text, "first_word": n_before,
                      "n_words": words.count(" ", start, end) + 1, "edits": edits, "found": words[start:end]})
    places = [p for _, p in base]
    return {"n_words": words.count(" ") - 1, "n_base": len(base), "first_word": min(places, default=None),
            "last_word": max(places, default=None), "base_labels": ",".join(sorted({n for n, _ in base})),
            "labels": ",".join(sorted({s["label"] for s in spans})), "score": best, "spans": spans}


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 base: Sequence[tuple[str, str]] = BASE,
                 notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """One row per input row: ``id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans``.

    ``base`` and ``notices`` are pairs of a label and a notice: words with
    single spaces, those in brackets without edits. A notice may have one edit
    (an inserted, deleted or replaced code point) per ten code points, at most
    four. ``n_base`` counts the places where a base notice stands unchanged,
    ``first_word`` and ``last_word`` are the smallest and largest start among
    them (words from 0; null if none), ``base_labels`` their labels.
    ``labels`` has the labels of all spans, both distinct, sorted and joined
    by commas. ``score`` is the largest 1 - edits / length of a span, 0
    without one. ``spans``: label, notice, first word, number of words, edits
    and the words found; unchanged base notices all, else no two overlapping
    spans of one notice.

    A null or empty text has no words and empty labels; repeated rows are each
    returned; other columns are ignored.
    """
    fixed = [("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
             ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", _SPAN_TYPE)]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(base, notices)
        for batch in batches:
            for ids, texts in text_slices(batch.column(0), batch.column(1)):
                rows = [_row(scanner, t) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), *[pa.array([r[c] for r in rows], t) for c, t in fixed]],
                    names=["id", *[c for c, _ in fixed]])
    schema = ("id long, n_words long, n_base long, first_word long, last_word long, "
              f"base_labels string, labels string, score double, spans {SPANS}")
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, schema)
    return rows.withColumnRenamed("id", id_col)


def license_spans(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row per span of a :func:`license_scan`."""
    return scanned.select(id_col, F.explode("spans").alias("_s")).select(id_col, "_s.*")
