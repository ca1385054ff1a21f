"""A bounded memo from pre-tokens to what a tokenizer makes of them.

Texts of one slice are cut into pre-tokens at spaces where the tokenizer never
merges across (the caller says which; numpy finds the places). Arrow numbers
the distinct ones of a block, and these are looked up by their bytes in a
dictionary. Only pre-tokens that are not in it reach the tokenizer, each once,
all of a block in one call. The memo is emptied when it is full, so a task's
memory does not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

_BLOCK = 1 << 20  # bytes looked up at once
_LONG = 1 << 12  # a longer pre-token alone in its block goes straight to the tokenizer
_HELD = 1 << 25  # bytes of pre-tokens that a memo holds


class _Slots(dict):
    """Pre-token -> slot; one that is new gets the next slot and is noted."""

    def __init__(self, known: list[bytes]):
        super().__init__(zip(known, range(len(known))))
        self.new: list[bytes] = []

    def __missing__(self, key: bytes) -> int:
        slot = self[key] = len(self)
        self.new.append(key)
        return slot


class PretokenTable:
    """``encode(pre-tokens) -> (number of ids of each, all ids)`` with a memo; a
    caller that only counts may give no ids.

    ``strip``: the first byte of a pre-token (its space) is not part of it,
    except for the first pre-token of a text. ``known``: pre-tokens of one id.
    A memo holds up to half of ``2 ** size_bits`` pre-tokens.
    """

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray | None]],
                 may_split: Callable[[np.ndarray], np.ndarray], strip: bool,
                 known: list[bytes] | None = None, size_bits: int = 20):
        self.encode, self.may_split, self.strip, self.known = encode, may_split, strip, list(dict.fromkeys(known or []))
        self.size = 1 << size_bits
        self.clear()

    def clear(self) -> None:
        self.slots = _Slots(self.known)
        self.at = np.zeros(self.size, np.int64)
        self.length = np.ones(self.size, np.int32)  # those of the known ones stay 1
        self.pool = np.zeros(1 << 16, np.uint32)
        self.used = self.held = 0

    def _learn(self) -> None:
        """What the tokenizer makes of the new pre-tokens."""
        new, self.slots.new = self.slots.new, []
        lengths, ids = self.encode(new)
        end = len(self.slots)
        if ids is not None:
            if self.used + len(ids) > len(self.pool):
                self.pool = np.concatenate([self.pool[:self.used], np.zeros(2 * (self.used + len(ids)), np.uint32)])
            self.pool[self.used:self.used + len(ids)] = ids
            self.at[end - len(new):end] = self.used + np.cumsum(lengths) - lengths
            self.used += len(ids)
        self.length[end - len(new):end] = lengths
        self.held += sum(map(len, new))

    # -- texts ------------------------------------------------------------

    def _blocks(self, starts: np.ndarray, ends: np.ndarray):
        """Runs of pre-tokens of up to :data:`_BLOCK` bytes and half a memo."""
        lo = 0
        while lo < len(starts):
            hi = int(np.searchsorted(ends, starts[lo] + _BLOCK, "right"))
            hi = max(lo + 1, min(hi, lo + self.size // 4))
            yield lo, hi
            lo = hi

    def lookup(self, texts: list[bytes], with_ids: bool):
        """Yields ``(text_index, counts, ids)`` per block of pre-tokens in text
        order: the text of each pre-token, its number of ids, and all ids."""
        buf = np.frombuffer(b"".join(texts), np.uint8)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends_of = np.cumsum(sizes)
        begin = (ends_of - sizes)[sizes > 0]
        cut = self.may_split(buf)
        last = ends_of[sizes > 0] - 1
        cut[last] &= buf[last] != 32  # a space that ends a text is not cut off
        cut[begin] = True
        starts = np.flatnonzero(cut)
        ends = np.append(starts[1:], len(buf))
        owner = np.searchsorted(ends_of, starts, "right")
        if self.strip:
            first = np.zeros(len(buf), bool)
            first[begin] = True
            spaces = ~first[starts]
            buf = np.delete(buf, starts[spaces])
            ends = ends - np.cumsum(spaces)
            starts = np.append(np.zeros(1, np.int64), ends)[:len(ends)]
        for lo, hi in self._blocks(starts, ends):
            a, b, who = starts[lo:hi], ends[lo:hi], owner[lo:hi]
            part = bytes(buf[a[0]:b[-1]])
            if hi - lo == 1 and b[0] - a[0] > _LONG:
                yield who, *self.encode([part])
                continue
            bounds = np.append(a, b[-1]) - a[0]
            coded = pa.LargeBinaryArray.from_buffers(
                pa.large_binary(), hi - lo, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(part)]
            ).dictionary_encode()
            keys = coded.dictionary.to_numpy(zero_copy_only=False)
            if len(self.slots) + len(keys) > self.size // 2 or self.held > _HELD:
                self.clear()
            slots = np.fromiter(map(self.slots.__getitem__, keys), np.int64, len(keys))[coded.indices.to_numpy()]
            if self.slots.new:
                self._learn()
            n = self.length[slots]
            yield who, n, self._gather(slots, n) if with_ids else None

    def _gather(self, slots: np.ndarray, n: np.ndarray) -> np.ndarray:
        total = int(n.sum())
        step = np.repeat(self.at[slots] - (np.cumsum(n) - n), n)
        return self.pool[step + np.arange(total)]

    def counts(self, texts: list[bytes]) -> np.ndarray:
        out = np.zeros(len(texts), np.int64)
        for who, n, _ in self.lookup(texts, False):
            out += np.bincount(who, n, len(texts)).astype(np.int64)
        return out

    def ids(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        counts = np.zeros(len(texts), np.int64)
        parts = [np.zeros(0, np.uint32)]
        for who, n, ids in self.lookup(texts, True):
            counts += np.bincount(who, n, len(texts)).astype(np.int64)
            parts.append(ids)
        return np.split(np.concatenate(parts), np.cumsum(counts)[:-1])
