"""Language identification by rank-order profiles (operator 3).

A profile is a language's most frequent character n-grams (one to three
letters, white space squeezed to a blank) in order of frequency. A document is
compared to each profile by the out-of-place distance: for each of its own
most frequent n-grams, how far its rank is from the rank in the profile, and
the profile's size if it is not there.

The n-grams of a slice of texts are packed into 64-bit integers and counted
with numpy. Learning counts per task, sums the counts in Spark and ranks them
per language; only the profiles (languages x ``size`` rows) reach the driver.
"""

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_slices, worker_batches

#: N-grams in a profile.
SIZE = 400
#: Counts a task holds before it hands them on.
HELD_NGRAMS = 1 << 20
UNKNOWN = "und"
#: Below this score no learned profile fits the text (see :func:`accepted`).
MIN_SCORE = 0.05
_SHIFT = np.int64(21)


def held_out(id_col: str) -> Column:
    """Rows that are never learned from: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def _codes(text: str) -> np.ndarray:
    """Lower-cased letters as code point + 1, every other run as one blank 0;
    blanks at both ends. Empty if the text has no letter."""
    raw = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    if not len(raw):
        return raw
    letter = _letters()[raw]
    if not letter.any():
        return raw[:0]
    codes = np.concatenate([[0], np.where(letter, raw + 1, 0), [0]])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def _ngrams(codes: np.ndarray) -> np.ndarray:
    """All n-grams of one to three codes as integers (longer ones are larger);
    the lone blank is not one."""
    two = (codes[:-1] + 1 << _SHIFT) + codes[1:]
    three = (two[:-1] << _SHIFT) + codes[2:]
    return np.concatenate([codes[codes > 0], two, three])


def _ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams in order; ties by n-gram."""
    grams, n = np.unique(_ngrams(codes), return_counts=True)
    return grams[np.argsort(-n, kind="stable")[:size]]


def learn(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = SIZE) -> list[tuple]:
    """``[(language, [n-gram, ...]), ...]`` from every row of ``docs`` with a
    non-null language and a letter in its text."""
    def count(batches):
        held: dict[str, list] = {}

        def merged(parts):
            grams = np.concatenate([g for g, _ in parts])
            n = np.concatenate([c for _, c in parts])
            grams, at = np.unique(grams, return_inverse=True)
            return grams, np.bincount(at, n).astype(np.int64)

        def rows():
            for lang, parts in held.items():
                grams, n = merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(grams), pa.string()), pa.array(grams), pa.array(n)],
                    names=["lang", "gram", "n"])

        def full():
            for lang, parts in held.items():
                if len(parts) > 8:
                    held[lang] = [merged(parts)]
            return sum(len(g) for parts in held.values() for g, _ in parts) > HELD_NGRAMS

        for batch in worker_batches(batches):
            for langs, texts in text_slices(batch.column(0), batch.column(1)):
                by_lang: dict[str, list] = {}
                for lang, text in zip(langs, texts):
                    codes = _codes(text)
                    if len(codes):
                        by_lang.setdefault(lang, []).append(_ngrams(codes))
                for lang, parts in by_lang.items():
                    held.setdefault(lang, []).append(np.unique(np.concatenate(parts), return_counts=True))
                if full():
                    yield from rows()
                    held.clear()
        yield from rows()

    counts = (docs.where(F.col(lang_col).isNotNull()).select(lang_col, text_col)
              .mapInArrow(count, "lang string, gram long, n long")
              .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    profiles: dict[str, list] = {}
    for row in sorted(top.collect(), key=lambda r: (r.lang, r.rank)):  # languages x size rows
        profiles.setdefault(row.lang, []).append(row.gram)
    return sorted(profiles.items())


class Classifier:
    """Compares texts with the profiles."""

    def __init__(self, profiles: list[tuple], size: int = SIZE):
        self.size = size
        self.langs = [lang for lang, _ in profiles]
        self.grams = np.unique(np.array([g for _, grams in profiles for g in grams], np.int64))
        self.ranks = np.full((len(self.grams) + 1, len(self.langs)), -1, np.int64)
        for j, (_, grams) in enumerate(profiles):
            self.ranks[np.searchsorted(self.grams, grams), j] = np.arange(len(grams))

    def predict(self, text: str) -> tuple[str, float]:
        codes = _codes(text)
        if not len(codes) or not self.langs:
            return UNKNOWN, 0.0
        own = _ranked(codes, self.size)
        at = np.searchsorted(self.grams, own)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == own, at, len(self.grams))
        ranks = self.ranks[at]
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None]))
        distance = apart.sum(axis=0)
        best = int(np.argmin(distance))  # ties: the first language by name
        return self.langs[best], float(1 - distance[best] / (self.size * len(own)))


def verdict(profiles: list[tuple], text: Column, size: int = SIZE) -> Column:
    """``struct<lang_pred, score>`` of a text column; the rows stay in the JVM,
    only their texts are looked at."""
    @F.pandas_udf("lang_pred string, score double")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = Classifier(profiles, size)
        for texts in worker_batches(batches):
            yield pd.DataFrame([model.predict(t or "") for t in texts], columns=["lang_pred", "score"])
    return classify(text)


def identify(docs: DataFrame, profiles: list[tuple], id_col: str = "doc_id", text_col: str = "text",
             size: int = SIZE) -> DataFrame:
    """One row per input row: ``id, lang_pred, score``.

    ``score`` is one minus the distance to the nearest profile, as a share of
    the largest possible distance. A text that is null or has no letter (or
    any text if nothing was learned) is ``und`` with score 0. Only the text is
    looked at, and all of it; repeated rows are each returned.
    """
    found = docs.select(F.col(id_col), verdict(profiles, F.col(text_col), size).alias("found"))
    return found.select(id_col, "found.lang_pred", "found.score")


def accepted(verdict_col: Column) -> Column:
    """A language was found and its profile fits at all."""
    return (verdict_col["lang_pred"] != UNKNOWN) & (verdict_col["score"] >= MIN_SCORE)
