"""Best-fit packing with a swap-based local search (operator 9).

Only lengths matter for packing, and a piece has at most ``capacity`` tokens.
So the plan is made on the histogram of piece lengths, which has at most
``capacity`` rows however large the corpus is: equal bins are one pattern with
a multiplicity. Best fit gives the first plan; the local search then moves
tokens from the emptiest bins into others (move one or two pieces, exchange one
for one, two for one, or one for two), each step increasing the sum of squared
fills, until the lower bound is met or no exchange is left.

Spark does the rest: it tokenises, counts the lengths, numbers the pieces of
each length (per partition, with offsets; no global window) and looks up each
piece's place in the plan.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort
from collections import Counter
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import frozen, kept, text_slices, worker_batches
from .pretokens import PretokenTable

CAPACITY = 2048
END_ID = 0
#: Unknown pre-tokens that the tokenizer gets as one text.
RUN = 64
#: Part of all bins that an exchange of the local search concerns at first; at
#: last it is one bin, however many there are.
SHARE = 64


# -- tokens ----------------------------------------------------------------

def _may_split(buf: np.ndarray) -> np.ndarray:
    """Where a byte-level BPE always begins a pre-token: at a space before a
    printable ASCII byte or a lead byte of characters without white space, at
    ASCII punctuation after an ASCII letter, at a line feed after a printable
    ASCII byte, and at an ASCII letter after such a line feed."""
    printable = (buf > 32) & (buf < 127)
    letter = ((buf | 32) >= 97) & ((buf | 32) <= 122)
    mark = printable & ~letter & ((buf < 48) | (buf > 57))
    feed = buf == 10
    cut = buf == 32
    after = buf[1:]
    cut[:-1] &= printable[1:] | ((after >= 0xC3) & (after <= 0xDF)) | (after >= 0xE4)
    cut[1:] |= (mark[1:] & letter[:-1]) | (feed[1:] & printable[:-1])
    cut[2:] |= letter[2:] & feed[1:-1] & printable[:-2]
    return cut


def tokenizer(path: str):
    """``texts -> id arrays`` for one task, as the library gives them."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    special = [t.content for t in library.get_added_tokens_decoder().values()]

    # The bytes of each id: a byte-level vocabulary writes one character a byte.
    width = np.zeros(library.get_vocab_size(), np.int64)
    for token, i in library.get_vocab().items():
        width[i] = len(token)

    def encode(keys: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        # A key after whose first space the tokenizer always begins a pre-token
        # may follow any other, so runs of such keys are one text; the bytes of
        # the ids tell where each key ends.
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        ends = np.cumsum(sizes)
        buf = np.frombuffer(b"".join(keys), np.uint8)
        at = ends - sizes
        joins = (sizes > 1) & (buf[at] == 32) & _may_split(buf)[at]
        joins[::RUN] = False
        heads = np.append(np.flatnonzero(~joins), len(keys))
        texts = [b"".join(keys[a:b]).decode() for a, b in zip(heads[:-1], heads[1:])]
        coded = library.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.asarray(list(chain.from_iterable(c.ids for c in coded)), np.uint32)
        upto = np.append(np.cumsum(width[ids]), 0)
        last = np.searchsorted(upto[:-1], ends)
        if np.array_equal(upto[last], ends):
            return np.diff(last, prepend=-1), ids
        # A byte without an id: as words of one "pre-tokenised" text, each by itself.
        coded = library.encode([k.decode() for k in keys], is_pretokenized=True, add_special_tokens=False)
        return (np.bincount(np.asarray(coded.word_ids, np.int64), minlength=len(keys)),
                np.asarray(coded.ids, np.uint32))
    table = PretokenTable(encode, _may_split, strip=False)

    def ids(texts: list[str]) -> list[np.ndarray]:
        # A special string inside a text is one id of its own: such texts go whole.
        plain = [b"" if any(s in t for s in special) else t.encode() for t in texts]
        out = table.ids(plain)
        for i, t in enumerate(texts):
            if t and not plain[i]:
                out[i] = np.asarray(library.encode(t, add_special_tokens=False).ids, np.uint32)
        return out
    return ids


def pieces(docs: DataFrame, path: str, id_col: str, text_col: str, capacity: int, end_id: int) -> DataFrame:
    """``id, piece, start, length, ids_crc32``: each document's ids, then the
    end id, cut from the end into pieces of ``capacity`` (the first is shorter)."""
    names = ["id", "piece", "start", "length", "ids_crc32"]

    def run(batches):
        ids_of = kept(tokenizer, path)  # its memo goes on
        end = np.array([end_id], np.uint32)
        for batch in worker_batches(batches, keeps=True):
            for keys, texts in text_slices(batch.column(0), batch.column(1)):
                rows: list[tuple] = []
                for key, ids in zip(keys, ids_of(texts)):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    at, head = 0, len(ids) % capacity or capacity
                    cuts = [0, *range(head, len(ids) + 1, capacity)]
                    for at in range(len(cuts) - 1):
                        a, b = cuts[at], cuts[at + 1]
                        rows.append((key, at, a, b - a, zlib.crc32(ids[a:b].tobytes())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int32() if n == "piece" else pa.int64()) for n, c in zip(names, zip(*rows))],
                    names=names)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).mapInArrow(
        run, "id long, piece int, start long, length long, ids_crc32 long")


# -- plan ------------------------------------------------------------------

class _Bins:
    """Patterns (sorted tuples of lengths with counts) and how many bins have each."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.count: Counter = Counter()  # pattern -> bins

    @staticmethod
    def fill(pattern) -> int:
        return sum(n * k for n, k in pattern)

    @staticmethod
    def change(pattern, out, into):
        items = Counter(dict(pattern))
        items.subtract(out)
        items.update(into)
        return tuple(sorted((n, k) for n, k in items.items() if k))


def _best_fit(counts: dict[int, int], capacity: int) -> _Bins:
    """Best fit, longest pieces first; equal bins are filled together."""
    bins = _Bins(capacity)
    rooms: list[int] = [capacity]  # open residuals in order
    open_: dict[int, list] = {}  # residual -> [(pattern as tuple of (length, k)), bins]

    def add(room: int, pattern: tuple, n: int) -> None:
        if not n:
            return
        if room not in open_ or not open_[room]:
            open_[room] = []
            if room not in rooms:
                insort(rooms, room)
        open_[room].append((pattern, n))

    rooms.clear()
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(rooms, length)
            if i < len(rooms):
                room = rooms[i]
                pattern, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
                    del rooms[i]
            else:
                room, pattern, n = capacity, (), left  # new bins, as many as needed
            per = room // length
            full = min(n, left // per)
            rest = left - full * per
            add(room - per * length, pattern + ((length, per),), full)
            left -= full * per
            n -= full
            if n and rest:
                part = min(rest, per)  # one more bin takes what is left
                add(room - part * length, pattern + ((length, part),), 1)
                left -= part
                n -= 1
            if pattern:
                add(room, pattern, n)
    for room, groups in open_.items():
        for pattern, n in groups:
            bins.count[tuple(sorted(pattern))] += n
    return bins


def _pairs(pattern) -> list[tuple]:
    """Two pieces of a bin and their sum."""
    return [((a, b), a + b) for j, (a, k) in enumerate(pattern) for b, _ in pattern[j + (k < 2):]]


class _Search:
    """Exchanges between bins that raise the sum of squared fills.

    A target with room ``r`` that gives back pieces of total ``b`` can take
    pieces of total ``b + r``: it is filed under that size, for no piece, each
    piece and each pair of its pieces given back. A donor's piece (or pair) of
    size ``s`` fills a target filed under ``s`` exactly, and leaves ``c - s`` open
    in one filed under ``c``, so the best exchange of a donor is the next size
    in use. Filing and looking up touch the two bins only.

    Equal bins are exchanged together. Exchanges of many bins come first: a
    pass takes those of at least a share of all bins, and when it finds none
    the share goes down, from one in :data:`SHARE` to a single bin.
    """

    def __init__(self, bins: _Bins):
        self.bins, self.capacity = bins, bins.capacity
        self.n_bins = sum(bins.count.values())
        self.targets: list[dict] = [{} for _ in range(self.capacity + 1)]
        self.used = 0  # bit c: some target is filed under c
        self.queue: list[tuple] = []  # donors to try, the emptiest first
        self.least = max(self.n_bins // SHARE, 1)
        for pattern in list(bins.count):
            self._file(pattern)

    def _backs(self, pattern):
        return [((), 0), *(((b,), b) for b, _ in pattern), *_pairs(pattern)]

    def _file(self, pattern: tuple) -> None:
        room = self.capacity - _Bins.fill(pattern)
        if room:
            for back, size in self._backs(pattern):
                self.targets[size + room][pattern, back] = size
                self.used |= 1 << (size + room)
            heappush(self.queue, (self.capacity - room, pattern))

    def _unfile(self, pattern: tuple) -> None:
        room = self.capacity - _Bins.fill(pattern)
        if room:
            for back, size in self._backs(pattern):
                filed = self.targets[size + room]
                del filed[pattern, back]
                if not filed:
                    self.used &= ~(1 << (size + room))

    def _partner(self, donor: tuple):
        """``(target, out, back)`` that leaves the least open in the target
        (then moves most), or None."""
        count, least = self.bins.count, self.least
        fill, alone = _Bins.fill(donor), count[donor] < 2 * least
        best, found = (self.capacity - fill, 0), None
        for out, size in [*(((a,), a) for a, _ in donor), *_pairs(donor)]:
            more = self.used >> size
            while more:
                c = size + (more & -more).bit_length() - 1
                # The target's new fill must pass the donor's old one.
                if c - size >= best[0] + (best[1] < 0):
                    break
                for (target, back), given in self.targets[c].items():
                    if (given < size and count[target] >= least and not (alone and target == donor) and not (len(out) == 2 and len(back) == 2)
                            and (c - size, given - size) < best):
                        best, found = (c - size, given - size), (target, out, back)
                        break
                if found and best[0] == c - size:
                    break
                more &= more - 1
        return found

    def run(self) -> None:
        """Until the lower bound is met or a pass over all donors finds no
        exchange, not even of one bin."""
        count = self.bins.count
        total = sum(_Bins.fill(p) * n for p, n in count.items())
        bound = -(-total // self.capacity)
        moved = True
        while self.n_bins > bound:
            if not self.queue:
                if not moved:
                    if self.least == 1:
                        return
                    self.least = max(self.least // 4, 1)
                moved = False
                self.queue = sorted((_Bins.fill(p), p) for p in count if _Bins.fill(p) < self.capacity)
            _, donor = heappop(self.queue)
            if count[donor] < self.least:
                if not count[donor]:
                    del count[donor]
                continue
            partner = self._partner(donor)
            if partner is None:
                continue
            target, out, back = partner
            out, back = Counter(out), Counter(back)
            n = count[donor] // 2 if donor == target else min(count[donor], count[target])
            less, more = _Bins.change(donor, out, back), _Bins.change(target, back, out)
            for pattern, by in ((donor, -n), (target, -n), (less, n), (more, n)):
                before = count[pattern]
                if pattern:
                    count[pattern] = before + by
                    if not before:
                        self._file(pattern)
                    elif not count[pattern]:
                        self._unfile(pattern)
                        del count[pattern]
                else:
                    self.n_bins -= n
            if count[donor] >= self.least:
                heappush(self.queue, (_Bins.fill(donor), donor))
            moved = True


def plan(counts: dict[int, int], capacity: int) -> list[tuple]:
    """``(length, first_rank, per_bin, bins, first_sequence, offset)`` runs: the
    pieces of a length with rank ``r >= first_rank`` fill the run's bins, each
    with ``per_bin`` of them from ``offset`` on."""
    bins = _best_fit(counts, capacity)
    _Search(bins).run()
    rank: Counter = Counter()
    sequence, runs = 0, []
    for pattern, n in sorted(bins.count.items(), reverse=True):
        offset = 0
        for length, per in reversed(pattern):
            runs.append((length, rank[length], per, n, sequence, offset))
            rank[length] += per * n
            offset += per * length
        sequence += n
    assert rank == Counter({n: k for n, k in counts.items() if k})
    return runs


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: ``id, piece, start, length, ids_crc32, sequence_id,
    offset``.

    A null or empty text is the end id alone. Repeated rows and ids are packed
    as documents of their own; an empty table gives no row. Sequences are
    filled from offset 0 without gaps. The tokenizer file must exist on the
    executors.
    """
    cut = frozen(pieces(docs, tokenizer_path, id_col, text_col, capacity, end_id))
    # At most `capacity` rows, whatever the corpus holds.
    counts = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = sorted(plan(counts, capacity))

    placed = cut.withColumns({"pid": F.spark_partition_id(), "mid": F.monotonically_increasing_id()})
    sizes = placed.groupBy("pid", "length").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    first = frozen(sizes.select("pid", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")))
    here = Window.partitionBy("pid", "length").orderBy("mid")
    ranked = (placed.join(first, ["pid", "length"])
              .withColumn("rank", F.col("first") + F.row_number().over(here) - 1)
              .drop("pid", "mid", "first"))

    table = np.array(runs or [(1, 0, 1, 1, 0, 0)], np.int64)
    key = (table[:, 0] << 48) + table[:, 1]

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            run = table[np.searchsorted(key, (length << 48) + rank, "right") - 1]
            nth = rank - run[:, 1]
            sequence = run[:, 4] + nth // run[:, 2]
            offset = run[:, 5] + nth % run[:, 2] * length
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in ("id", "piece", "start", "length", "ids_crc32")),
                 pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    out = ranked.mapInArrow(place, "id long, piece int, start long, length long, ids_crc32 long, "
                                   "sequence_id long, offset long")
    return out.withColumnRenamed("id", id_col)
