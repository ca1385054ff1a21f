"""Spelling variant grouping by permuterm rotations (operator 13).

A word with a terminator, ``w$``, is written in every rotation. Two words that
differ in one code point have rotations that agree in all but the last code
point: the edited one. So each rotation is keyed by what precedes that code
point (a prefix of the rotation) and rows are sorted by that key: a group holds
the words that differ by a replacement there, and the one word that lacks the
code point altogether (an insertion or deletion). A group has at most one
member per letter and that word, however large the vocabulary, and is scanned
once; no pair is written, only each member's number of neighbours and its best
one.

An insertion into a run of equal letters has several places; only the first of
the run counts, so a pair of words meets in exactly one group.

A part of a rotation of more than :data:`PLAIN` code points is written as its
length and BLAKE2b digest, taken while the word is walked through once from
each end, so a word's rows grow with its length and not with its square.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..plans.ordering import global_index
from .common import frozen, text_slices

# Fixed values of the query's contract: word characters, least length and
# count, how much more frequent a form is, and the divisor of its deletions.
LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS = 6
MIN_COUNT = 5
RATIO = 5
DELETION_DIVISOR = 199

TERMINATOR = "$"
PLAIN = 32
_HELD = 200_000  # distinct words a task holds before it passes them on
_CHUNK = 1 << 20  # code points of a text handled at once
_ROWS = 1 << 16

Edit = Callable[[object, str], str]


def deletions(divisor: int = DELETION_DIVISOR) -> Edit:
    """The contract's change of a run: with ``h`` the CRC-32 of ``<id>:<run>``,
    delete code point ``h mod length`` where ``divisor`` divides ``h``. A null
    id is written as the empty string."""
    def edit(key, run: str) -> str:
        h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
        if h % divisor:
            return run
        i = h % len(run)
        return run[:i] + run[i + 1:]
    return edit


def _chunks(text: str, letter: re.Pattern) -> Iterator[str]:
    """A text in pieces that end between runs, so that the runs of a very long
    text are never all held."""
    start = 0
    while len(text) - start > _CHUNK:
        at = start + _CHUNK
        run = letter.match(text, at)
        end = run.end() if run else at
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", letters: str = LETTERS,
                min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, edit: Edit | None = None) -> DataFrame:
    """``word, n``: maximal runs of ``letters``, A-Z lower-cased, each changed by
    ``edit(id, run)`` if given, of at least ``min_chars`` code points and
    ``min_count`` occurrences. A null text has none."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter, runs = re.compile(f"[{letters}]+"), re.compile(f"[{letters}]{{{min_chars},}}")
        total: Counter = Counter()

        def batch() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                               pa.array(list(total.values()), pa.int64())], names=["word", "n"])
        for b in batches:
            for keys, texts in text_slices(b.column(0), b.column(1)):
                for key, text in zip(keys, texts):
                    for part in _chunks(text, letter):
                        # Lower-casing the bytes touches A-Z only.
                        for word, n in Counter(runs.findall(part.encode().lower().decode())).items():
                            if edit is not None:
                                word = edit(key, word)
                                if len(word) < min_chars:
                                    continue
                            total[word] += n
                if len(total) >= _HELD:
                    yield batch()
                    total.clear()
        if total:
            yield batch()
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(run, "word string, n long")
    return rows.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def _part(text: str) -> str:
    """How :func:`_ends` writes a part (the digest of a long one)."""
    return text if len(text) <= PLAIN else f"#{len(text)}:{hashlib.blake2b(text.encode(), digest_size=16).hexdigest()}"


def _ends(word: str) -> tuple[list[str], list[str]]:
    """``heads[i]`` stands for ``word[:i]``, ``tails[i]`` for ``word[i:]``."""
    if len(word) <= PLAIN:
        return [word[:i] for i in range(len(word) + 1)], [word[i:] for i in range(len(word) + 1)]

    def walk(letters: Iterable[str], plain: Callable[[int], str]) -> list[str]:
        digest, out = hashlib.blake2b(digest_size=16), [""]
        for i, c in enumerate(letters, 1):
            digest.update(c.encode())
            out.append(plain(i) if i <= PLAIN else f"#{i}:{digest.copy().hexdigest()}")
        return out
    n = len(word)
    return walk(word, lambda i: word[:i]), walk(reversed(word), lambda i: word[n - i:])[::-1]


def rotations(word: str) -> Iterator[tuple[str, bool, bool]]:
    """``(key, skipped, first)`` of every rotation of ``word`` with a
    terminator. ``skipped``: the code point after the key is left out (the
    edited one); ``first``: it is not the same as the one before it. Else the
    key is the whole rotation, the place where another word has one more."""
    heads, tails = _ends(word)
    for i in range(len(word)):
        yield f"{tails[i + 1]}{TERMINATOR}{heads[i]}", True, i == 0 or word[i] != word[i - 1]
    for i in range(len(word) + 1):
        yield f"{tails[i]}{TERMINATOR}{heads[i]}", False, False


def _rotation_rows(words: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            keys, skipped, first, ranks = zip(*rows)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.string()), pa.array(skipped, pa.bool_()), pa.array(first, pa.bool_()),
                 pa.array(ranks, pa.int64())], names=["key", "skipped", "first", "rank"])
        rows: list = []
        for b in batches:
            for rank, word in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for key, skipped, first in rotations(word):
                    rows.append((key, skipped, first, rank))
                    if len(rows) >= _ROWS:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)
    return words.select("rank", "word").mapInArrow(run, "key string, skipped boolean, first boolean, rank long")


def neighbours(words: DataFrame) -> DataFrame:
    """``rank, n_near, best``: for each of the distinct ``words`` (``rank``,
    ``word``) with a word at one inserted, deleted or replaced code point, how
    many there are and the smallest rank among them."""
    group = Window.partitionBy("key")
    scan = group.orderBy(~F.col("skipped"), "rank")
    rank = F.col("rank")
    rows = _rotation_rows(words).select(
        "rank", "skipped", "first",
        F.count_if("skipped").over(group).alias("n_skipped"),
        F.count_if("first").over(group).alias("n_first"),
        F.min(F.when(F.col("skipped"), rank)).over(group).alias("least"),
        F.min(F.when(F.col("first"), rank)).over(group).alias("least_first"),
        F.min(F.when(~F.col("skipped"), rank)).over(group).alias("shorter"),
        F.lead(F.when(F.col("skipped"), rank)).over(scan).alias("next"))
    replaced = F.when(rank == F.col("least"), F.col("next")).otherwise(F.col("least"))
    shorter = F.when(F.col("first"), F.col("shorter"))
    found = rows.select(
        "rank",
        F.when(F.col("skipped"), F.col("n_skipped") - 1 + F.when(shorter.isNotNull(), 1).otherwise(0))
        .otherwise(F.col("n_first")).alias("n_near"),
        F.when(F.col("skipped"), F.least(replaced, shorter)).otherwise(F.col("least_first")).alias("best"))
    return (found.where("n_near > 0").groupBy("rank")
            .agg(F.sum("n_near").alias("n_near"), F.min("best").alias("best")))


def _roots(links: DataFrame) -> DataFrame:
    """``rank, root`` from ``rank, parent``: the end of each chain of parents,
    by joining the links with themselves until none grows. A parent is at least
    ``ratio`` times as frequent as its child, so chains are short."""
    links = frozen(links)
    while True:
        up = links.select(F.col("rank").alias("parent"), F.col("parent").alias("_next"))
        joined = frozen(links.join(up, "parent", "left"))
        links = joined.select("rank", F.coalesce("_next", "parent").alias("parent"))
        if joined.where(F.col("_next").isNotNull()).isEmpty():
            return links.withColumnRenamed("parent", "root")


def spelling_groups(counts: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of ``counts`` (``word, n``, words distinct): ``word,
    form, root, n, n_near, form_n``.

    Words are near if they differ by exactly one inserted, deleted or replaced
    code point; ``n_near`` counts them. ``form`` is the near word of largest
    ``n`` (ties: smallest in code-point order) if that ``n`` is at least
    ``ratio`` (2 or more) times the word's own; else null, with a null
    ``form_n``. ``root`` is the last word reached by following forms, the word
    itself if it has none. Null words are left out; an empty table gives none;
    other columns are ignored.
    """
    if ratio < 2:
        raise ValueError("a form must be more frequent than its word")
    words = counts.where(F.col("word").isNotNull()).select("word", "n")
    # Rank 1 is the largest n, ties in code-point order: the best near word is
    # the one of least rank, and rows carry eight bytes instead of texts.
    words = global_index(words, [F.col("n").desc(), F.col("word")], "rank", distinct_rows=True)
    near = frozen(neighbours(words))
    form = words.select(F.col("rank").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    judged = frozen(
        words.join(near, "rank", "left").join(form, "best", "left")
        .withColumn("kept", F.coalesce(F.col("form_n") >= F.col("n") * ratio, F.lit(False)))
        .select("rank", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                *[F.when(F.col("kept"), F.col(c)).alias(c) for c in ("best", "form", "form_n")]))
    roots = _roots(judged.where(F.col("best").isNotNull()).select("rank", F.col("best").alias("parent")))
    named = roots.join(words.select(F.col("rank").alias("root"), F.col("word").alias("root_word")), "root")
    return (judged.join(named.select("rank", "root_word"), "rank", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"))
