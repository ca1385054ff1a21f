"""Phrase collocation mining by best-first branch and bound (operator 11).

A phrase's score is the least of ``SCALE * a / (l + r)`` over its cuts, with
``a`` its own count and ``l``, ``r`` those of the two parts. The count of a part
is at least that of the whole, so a phrase that starts with ``p`` scores at most
``SCALE * f(p) / (f(first word of p) + f(p))``, and one that ends with ``s`` at
most ``SCALE * f(s) / (f(last word of s) + f(s))``: prefix counts give bounds
without counting what they grow to.

Words and pairs of words are counted first. Per language the search then takes
the best part of the frontier: a cut, the score of the 4000th best pair (more
in the next turn), and grows every prefix or suffix whose bound reaches it,
to three words and then to four. Whatever was not grown scores below the cut,
so if 2000 phrases at or above it survive, ties and all, the language is
settled; else the cut is lowered, in the end to nothing. Survival is exact: a
phrase at or above the cut has all its extensions by a word counted, and if any
longer phrase holds enough of its places, then one longer by a word does.

What is grown reaches the counting tasks as Bloom filters of a fixed size. They
only spare rows from the shuffle: all decisions are made on exact counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import broadcast_if_small, frozen

# Fixed values of the query's contract.
SCALE = 2_000_000
MIN_COUNT = 30
MAX_WORDS = 4
TOP = 2000
INSIDE = (80, 100)  # a phrase goes if a longer one has 80 of 100 of its places
NO_LANG = "und"

FILTER_BITS = 1 << 26  # of each Bloom filter, whatever the corpus (8 MB)
FIRST_CUT = 2  # the first cut is the score of pair number FIRST_CUT * top
CUT_STEP = 8  # the next one of pair number CUT_STEP times that, and so on

_TOKENS = 1 << 21  # tokens of a task counted at once
_WORDS = 1 << 19  # words a task knows by number before it starts anew
_CHUNK = 1 << 20  # bytes of a text split at once
_ROWS = 1 << 16
_BREAK = b"\xff"  # in no UTF-8 text: ends a piece
# A-Z to a-z, a tab to a space, piece separators to the break.
_BYTES = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 0xFF if chr(c) in ".,;:!?\n\x0b\x0c\r" else c
               for c in range(256))
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


# -- hashes and filters (pruning only, never a decision) ----------------------

def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\t" + word)


def _join_hash(h: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Hash of a phrase from that of all its words but the last, and the last."""
    h = h * _C1
    return ((h ^ (h >> np.uint64(32))) + w) * _C2


def _places(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    h = h ^ (h >> np.uint64(29))
    return h & np.uint64(bits - 1), (h >> np.uint64(32)) * _C1 >> np.uint64(64 - (bits.bit_length() - 1))


def _holds(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    out = np.ones(len(h), bool)
    for at in _places(h, len(table) * 8):
        out &= (table[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return out


def phrase_filter(phrases: DataFrame, bits: int) -> np.ndarray:
    """A Bloom filter of ``bits`` bits over ``lang, phrase``: set bits are
    combined by Spark into at most ``bits / 64`` rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = []
            for lang, phrase in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = [np.array([_word_hash(lang, w)], np.uint64) for w in phrase.encode().split(b" ")]
                h = words[0]
                for w in words[1:]:
                    h = _join_hash(h, w)
                hashes.append(h)
            if hashes:
                at = np.concatenate(_places(np.concatenate(hashes), bits))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((at >> np.uint64(6)).astype(np.int64)),
                     pa.array((np.uint64(1) << (at & np.uint64(63))).view(np.int64))], names=["slot", "mask"])
    rows = phrases.select("lang", "phrase").mapInArrow(run, "slot long, mask long")
    got = rows.groupBy("slot").agg(F.bit_or("mask").alias("mask")).toArrow()
    table = np.zeros(bits // 64, np.uint64)
    table[got.column("slot").to_numpy()] = got.column("mask").to_numpy().view(np.uint64)
    return table.view(np.uint8)


# -- counting in tasks ---------------------------------------------------------

class _Ids(dict):
    """Numbers of the words of a language; 0 is the break."""

    def __init__(self, book: _Book, lang: str):
        super().__init__({_BREAK: 0})
        self.book, self.lang = book, lang

    def __missing__(self, word: bytes) -> int:
        i = self[word] = len(self.book.words)
        self.book.words.append(word)
        self.book.langs.append(self.lang)
        return i


class _Book:
    """Word numbers of one task, and their hashes."""

    def __init__(self):
        self.words: list[bytes] = [b""]
        self.langs: list[str] = [""]
        self.ids: dict[str, _Ids] = {}
        self.hashes = np.zeros(1, np.uint64)

    def of(self, lang: str) -> _Ids:
        if lang not in self.ids:
            self.ids[lang] = _Ids(self, lang)
        return self.ids[lang]

    def hash(self) -> np.ndarray:
        n = len(self.hashes)
        new = [_word_hash(x, w) for x, w in zip(self.langs[n:], self.words[n:])]
        self.hashes = np.concatenate([self.hashes, np.array(new, np.uint64)])
        return self.hashes


def _tokens(text: str) -> Iterator[list[bytes]]:
    """Words and breaks of a text, in parts of about a megabyte, so that the
    words of a very long text are never all held."""
    data = text.encode().translate(_BYTES)
    start = 0
    while start < len(data):
        end = len(data)
        if end - start > _CHUNK:
            space = data.find(b" ", start + _CHUNK)
            piece = data.find(_BREAK, start + _CHUNK)
            end = min([i for i in (space, piece) if i >= 0], default=end)
        yield data[start:end].replace(_BREAK, b" \xff ").split()
        start = end
    yield [_BREAK]


Select = Callable[[np.ndarray, np.ndarray], np.ndarray]


def _selected(ids: np.ndarray, hashes: np.ndarray, n: int, order: int, filters: list[np.ndarray]) -> np.ndarray:
    """Which of the first ``n`` places start a phrase of ``order`` words that
    the filters let through. ``filters``: of words (order 2); of pairs, prefixes
    and suffixes of ``order - 1`` words (orders 3, 4); none (order 1)."""
    ok = ids[:n] > 0
    for j in range(1, order):
        ok &= ids[j:n + j] > 0
    if order == 1 or not filters:
        return np.flatnonzero(ok)
    if order == 2:
        known = _holds(filters[0], hashes)
        return np.flatnonzero(ok & known[ids[:n]] & known[ids[1:n + 1]])
    pairs, heads, tails = filters
    for j in range(order - 1):
        at = np.flatnonzero(ok)
        ok[at] = _holds(pairs, _join_hash(hashes[ids[at + j]], hashes[ids[at + j + 1]]))
    at = np.flatnonzero(ok)

    def part(first: int) -> np.ndarray:
        h = hashes[ids[at + first]]
        for j in range(first + 1, first + order - 1):
            h = _join_hash(h, hashes[ids[at + j]])
        return h
    return at[_holds(heads, part(0)) | _holds(tails, part(1))]


def _count(ids: np.ndarray, at: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Word numbers (one array per word) and counts of the distinct phrases at
    the places ``at``."""
    key, levels = ids[at].astype(np.int64), []
    for j in range(1, order):
        if j > 1:
            known, key = np.unique(key, return_inverse=True)
            levels.append(known)
        key = key << 32 | ids[at + j]
    key, counts = np.unique(key, return_counts=True)
    words = []
    for known in [*reversed(levels), None]:
        if order > 1:
            words.append(key & 0xFFFFFFFF)
            key = key >> 32
        if known is not None:
            key = known[key]
    return [key, *reversed(words)], counts


def phrase_counts(docs: DataFrame, order: int, filters: list | None = None, text_col: str = "text",
                  min_count: int = MIN_COUNT, totals: bool = False) -> DataFrame:
    """``lang, phrase, a``: how often each phrase of ``order`` words stands in
    the pieces of ``docs`` (``lang``, text), of at least ``min_count`` places,
    among those that the filters (broadcast variables) let through. With
    ``totals`` also a row per language with a null phrase: its number of words."""
    filters = filters or []

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [f.value for f in filters]
        book, parts, held = _Book(), [], 0

        def rows(ids: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
            at = _selected(ids, book.hash() if tables else book.hashes, n, order, tables)
            words, counts = _count(ids, at, order)
            columns = [w.tolist() for w in words]
            langs = [book.langs[i] for i in columns[0]]
            phrases: list[str | None] = [b" ".join([book.words[i] for i in p]).decode() for p in zip(*columns)]
            if totals:
                langs_of = np.array(langs, object)
                for lang in book.ids:
                    langs.append(lang)
                    phrases.append(None)
                    counts = np.append(counts, counts[:len(langs_of)][langs_of == lang].sum())
            for i in range(0, len(langs), _ROWS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(langs[i:i + _ROWS], pa.string()), pa.array(phrases[i:i + _ROWS], pa.string()),
                     pa.array(counts[i:i + _ROWS].astype(np.int64))], names=["lang", "phrase", "a"])

        for batch in batches:
            for lang, text in zip(batch.column(0), batch.column(1)):
                ids = book.of(lang.as_py())
                for tokens in _tokens(text.as_py() or ""):
                    parts.append(np.fromiter(map(ids.__getitem__, tokens), np.int64, len(tokens)).astype(np.int32))
                    held += len(tokens)
                    if held >= _TOKENS:
                        # The last words are kept back: phrases may start there.
                        whole = np.concatenate(parts)
                        yield from rows(whole, len(whole) - (MAX_WORDS - 1))
                        parts = [whole[-(MAX_WORDS - 1):]]
                        held = MAX_WORDS - 1
                if len(book.words) > _WORDS:  # only at the end of a text
                    whole = np.concatenate([*parts, np.zeros(MAX_WORDS - 1, np.int32)])
                    yield from rows(whole, len(whole) - (MAX_WORDS - 1))
                    book, parts, held = _Book(), [], 0
        if parts:
            whole = np.concatenate([*parts, np.zeros(MAX_WORDS - 1, np.int32)])
            yield from rows(whole, len(whole) - (MAX_WORDS - 1))

    found = docs.select("lang", text_col).mapInArrow(run, "lang string, phrase string, a long")
    counted = found.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))
    return counted.where((F.col("a") >= min_count) | F.col("phrase").isNull())


# -- scores, bounds, survival --------------------------------------------------

def _exact(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(19,0)")


def _score(a: str | Column, below: Column) -> Column:
    """``floor(SCALE * a / below)`` in decimals of up to 38 digits."""
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * _exact(a), below)


def _words(start: int, n: int | Column) -> Column:
    return F.array_join(F.slice(F.split("phrase", " "), start, n), " ")


def scored(phrases: DataFrame, order: int, counts: DataFrame) -> DataFrame:
    """``phrases`` (lang, phrase, a) with ``l, r, score`` of the lowest cut, and
    ``first, last``: the counts of the first and the last word. Phrases with a
    part that ``counts`` does not hold are left out."""
    n = F.lit(order)
    cuts = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(side).alias("left"),
                              (_words(1, k) if side else _words(k + 1, n - k)).alias("part"))
                     for k in range(1, order) for side in (True, False)])
    asked = phrases.select("lang", "phrase", "a", F.explode(cuts).alias("c")).select("lang", "phrase", "a", "c.*")
    known = counts.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    both = (asked.join(known, ["lang", "part"]).groupBy("lang", "phrase", "a", "k")
            .agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"),
                 F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
            .withColumn("score", _score("a", _exact("l") + _exact("r"))))
    lowest = F.min(F.struct("score", "k", "l", "r"))
    return (both.groupBy("lang", "phrase", "a")
            .agg(lowest.alias("c"), F.count_if(F.col("l").isNotNull() & F.col("r").isNotNull()).alias("n_cuts"),
                 F.max(F.when(F.col("k") == 1, F.col("l"))).alias("first"),
                 F.max(F.when(F.col("k") == order - 1, F.col("r"))).alias("last"))
            .where(F.col("n_cuts") == order - 1)
            .select("lang", "phrase", "a", "c.l", "c.r", "c.score", "first", "last"))


def _head_bound() -> Column:
    return _score("a", _exact("first") + _exact("a"))


def _tail_bound() -> Column:
    return _score("a", _exact("last") + _exact("a"))


def _containers(longer: DataFrame, order: int) -> DataFrame:
    """``lang, phrase, inside``: the largest count among the given phrases of
    ``order`` words that start or end with ``phrase``."""
    parts = F.array(_words(1, order - 1), _words(2, order - 1))
    return (longer.select("lang", F.explode(parts).alias("part"), "a").groupBy("lang", "part")
            .agg(F.max("a").alias("inside")).withColumnRenamed("part", "phrase"))


def _nth_score(phrases: DataFrame, n: int) -> DataFrame:
    """``lang, cut``: the ``n``-th best score of each language, 0 without one."""
    order = Window.partitionBy("lang").orderBy(F.col("score").desc())
    best = phrases.select("lang", "score").withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= n)
    return best.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("_n") == n, F.col("score"))), F.lit(0)).alias("cut"))


@dataclass
class _Search:
    """Counts that hold for the whole search."""
    docs: DataFrame
    text_col: str
    words: DataFrame
    pairs: DataFrame
    min_count: int
    bits: int

    def filter(self, phrases: DataFrame):
        return self.docs.sparkSession.sparkContext.broadcast(phrase_filter(phrases, self.bits))

    def survivors(self, cuts: DataFrame, known_pairs) -> DataFrame:
        """Every surviving phrase of the languages of ``cuts`` (lang, cut) that
        scores at least the cut."""
        docs = self.docs.join(cuts.select("lang"), "lang", "left_semi")

        def grown(phrases: DataFrame, order: int) -> DataFrame:
            heads = phrases.where(_head_bound() >= F.col("cut"))
            tails = phrases.where(_tail_bound() >= F.col("cut"))
            filters = [known_pairs, self.filter(heads), self.filter(tails)]
            return frozen(phrase_counts(docs, order, filters, self.text_col, self.min_count))

        pairs = self.pairs.join(cuts, "lang")
        three = grown(pairs, 3)
        counts = self.words.select("lang", "phrase", "a").unionByName(self.pairs.select("lang", "phrase", "a"))
        triples = frozen(scored(three, 3, counts).join(cuts, "lang"))
        four = grown(triples, 4)
        quads = scored(four, 4, counts.unionByName(three)).join(cuts, "lang")
        reach = F.col("score") >= F.col("cut")
        columns = ["lang", "phrase", "a", "l", "r", "score"]
        short = (pairs.where(reach).select(*columns).unionByName(triples.where(reach).select(*columns))
                 .join(_containers(three, 3).unionByName(_containers(four, 4)), ["lang", "phrase"], "left"))
        part, of = INSIDE
        inside = F.lit(of).cast("decimal(3,0)") * _exact("inside") >= F.lit(part).cast("decimal(3,0)") * _exact("a")
        alone = short.where(~F.coalesce(inside, F.lit(False))).select(*columns)
        return frozen(alone.unionByName(quads.where(reach).select(*columns)))


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP,
                 min_count: int = MIN_COUNT, filter_bits: int = FILTER_BITS, first_cut: int = FIRST_CUT) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n,
    score``.

    A-Z are lower-cased; texts end pieces at ``.,;:!?``, LF, VT, FF and CR, and
    pieces words at spaces and tabs. A phrase is two to four words of a piece.
    ``a`` is how often it stands there (overlaps included), at least
    ``min_count``; ``l`` and ``r`` are the counts of the two parts of its
    lowest-scoring cut (ties: the shortest first part), ``score`` is
    ``floor(2000000 a / (l + r))``, ``n`` the language's number of words.
    Phrases inside a longer one of ``min_count`` that has at least 80% of their
    places are left out. Order: score, then ``a`` (both descending), then the
    phrase by its UTF-8 bytes.

    A null or empty text has no words, a null language is ``und``; repeated
    rows count each; a language without such phrases gives no row; other
    columns are ignored.
    """
    docs = docs.select(F.coalesce(F.col(lang_col), F.lit(NO_LANG)).alias("lang"), F.col(text_col).alias("text"))
    counted = frozen(phrase_counts(docs, 1, None, "text", min_count, totals=True))
    totals = counted.where(F.col("phrase").isNull()).select("lang", F.col("a").alias("n"))
    words = counted.where(F.col("phrase").isNotNull())
    search = _Search(docs, "text", words, words, min_count, filter_bits)
    pairs = phrase_counts(docs, 2, [search.filter(words)], "text", min_count)
    search.pairs = frozen(scored(frozen(pairs), 2, words))
    known_pairs = search.filter(search.pairs)

    done: DataFrame | None = None
    open_langs = frozen(search.pairs.select("lang").distinct())
    n = top * first_cut
    while not open_langs.isEmpty():
        cuts = broadcast_if_small(frozen(_nth_score(search.pairs.join(open_langs, "lang", "left_semi"), n)), 64)
        found = search.survivors(cuts, known_pairs)
        enough = (cuts.join(_nth_score(found, top).withColumnRenamed("cut", "least"), "lang", "left")
                  .where((F.col("cut") == 0) | (F.col("least") > 0)).select("lang"))
        settled = frozen(enough)
        part = found.join(settled, "lang", "left_semi")
        done = part if done is None else done.unionByName(part)
        open_langs = frozen(open_langs.join(settled, "lang", "left_anti"))
        n *= CUT_STEP
    if done is None:
        done = search.pairs.select("lang", "phrase", "a", "l", "r", "score").limit(0)
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = done.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
