"""Token counts and packing against the libraries' own results."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.helpers import HARD_TEXTS, SF, hard_docs
from wordmill.llm import packing, token_counts
from wordmill.llm.pretokens import PretokenTable
from wordmill.llm.queries import QUERIES

PIECES = public_tokenizers.path("piece_bpe_32k.model")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    odd = ["", " ", "  ", "a ", "a  ", " a", "  a  b  ", "a\n b", "a \n b", "x y z", "a 　b", "▁", "a▁b",
           " ▁ b", "a ▁", "<s> </s> <unk>", "<|endoftext|>", "x <|endoftext|> y", "it's I'LL 's", "\x00 a \x00",
           "\x1c a \x1d", "a\u0085 b", "a \u0085b", "é è " * 50, "w" * 9000 + " z", "🙂 🙂🙂 a"]
    return odd + ["".join(rng.choice(" \n\tab.é'1▁ 日 ") for _ in range(rng.randint(0, 40)))
                  for _ in range(2000)]


@pytest.mark.parametrize("size_bits", [20, 8])
def test_token_counts_are_the_library_s(texts, size_bits, monkeypatch):
    monkeypatch.setattr(PretokenTable.__init__, "__defaults__", (None, size_bits))
    if size_bits == 8:  # the proven strings do not fit so small a table
        monkeypatch.setattr(token_counts, "whole_tokens", lambda model: ["a", "b"])
    count = token_counts.counter(PIECES)
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert list(count([t.encode() for t in texts])) == [len(x) for x in model.encode(texts, num_threads=1)]


@pytest.mark.parametrize("size_bits", [20, 8])
def test_ids_are_the_library_s(texts, size_bits, monkeypatch):
    monkeypatch.setattr(PretokenTable.__init__, "__defaults__", (None, size_bits))
    library = Tokenizer.from_file(BYTES)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [list(x) for x in packing.tokenizer(BYTES)(texts)] == want


@pytest.mark.parametrize("size", [1024, 2048])
def test_words_with_equal_polynomial_hashes(spark, size):
    # Letters by the parity of the index's bits: such a word and its mirror
    # image collide in every polynomial hash modulo 2 ** 64.
    for one, two in ("ab", "er", "st", "01"):
        word = "".join((one, two)[i.bit_count() % 2] for i in range(size))
        mirror = word.translate(str.maketrans(one + two, two + one))
        texts = [f"x {word}", f"x {mirror}", f"{word} {mirror} {word}"]
        model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
        assert list(token_counts.counter(PIECES)([t.encode() for t in texts])) == [len(model.encode(t)) for t in texts]
        library = Tokenizer.from_file(BYTES)
        assert [list(x) for x in packing.tokenizer(BYTES)(texts)] == [
            library.encode(t, add_special_tokens=False).ids for t in texts]
        if size == 1024:
            docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
            got = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, PIECES).collect()}
            assert got == {i: len(model.encode(t)) for i, t in enumerate(texts)}
            check_packing(packing.pack(docs, BYTES).collect(), {i: [t] for i, t in enumerate(texts)})


def test_random_texts_are_the_library_s():
    rng = random.Random(17)
    texts = ["".join(rng.choice(" \n.,aebt'1é日") for _ in range(rng.randint(0, 60))) for _ in range(100_000)]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    count = token_counts.counter(PIECES)
    library = Tokenizer.from_file(BYTES)
    ids = packing.tokenizer(BYTES)
    for i in range(0, len(texts), 20_000):
        part = texts[i:i + 20_000]
        assert list(count([t.encode() for t in part])) == [len(x) for x in model.encode(part, num_threads=1)]
        assert [x.tolist() for x in ids(part)] == [e.ids for e in library.encode_batch(part, add_special_tokens=False)]


def test_whole_tokens_are_proven():
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    whole = token_counts.whole_tokens(model)
    assert len(whole) > 10000 and token_counts.splits_at_spaces(model)
    assert all(len(x) == 1 for x in model.encode(whole, num_threads=1))


def test_token_counts_of_hard_rows(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = [tuple(r) for r in token_counts.token_counts(hard_docs(spark), PIECES).collect()]
    want = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in HARD_TEXTS]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert token_counts.token_counts(hard_docs(spark).limit(0), PIECES).collect() == []


def check_packing(rows, texts_by_id):
    library = Tokenizer.from_file(BYTES)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for key, texts in texts_by_id.items():
        copies = []
        for text in texts:
            ids = np.array(library.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
            head = len(ids) % 2048 or 2048
            cuts = [0, *range(head, len(ids) + 1, 2048)]
            copies += [(n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in by_doc[key]) == Counter(copies)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    total = sum(r.length for r in rows)
    return len(by_sequence), -(-total // 2048)


def test_packing_of_documents(spark):
    rows = QUERIES["op9_packing"](spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    sequences, bound = check_packing(rows, {r.doc_id: [r.text] for r in docs})
    assert sequences == bound


def test_packing_of_hard_rows(spark):
    rows = packing.pack(hard_docs(spark), BYTES).collect()
    texts = defaultdict(list)
    for key, text in HARD_TEXTS:
        texts[key].append(text)
    check_packing(rows, texts)
    assert packing.pack(hard_docs(spark).limit(0), BYTES).collect() == []


def check_plan(counts, capacity):
    fill, ranks = defaultdict(list), Counter()
    for length, first, per, n, sequence, offset in packing.plan(counts, capacity):
        assert first == ranks[length]
        ranks[length] += per * n
        for s in range(sequence, sequence + n):
            fill[s] += [(offset + k * length, length) for k in range(per)]
    assert ranks == Counter({n: k for n, k in counts.items() if k})
    for items in fill.values():
        at = 0
        for offset, length in sorted(items):
            assert offset == at
            at += length
        assert at <= capacity
    return len(fill)


def exact_bins(counts, capacity):
    items = sorted((n for n, k in counts.items() for _ in range(k)), reverse=True)
    best = [len(items)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for j in {b: j for j, b in enumerate(bins)}.values():
            if bins[j] + items[i] <= capacity:
                go(i + 1, [*bins[:j], bins[j] + items[i], *bins[j + 1:]])
        go(i + 1, [*bins, items[i]])
    go(0, [])
    return best[0]


def test_plans_are_near_the_optimum():
    rng = random.Random(5)
    over = 0
    for _ in range(60):
        counts = Counter(rng.randint(1, 12) * 5 + rng.randint(0, 4) for _ in range(rng.randint(1, 11)))
        over += check_plan(dict(counts), 64) - exact_bins(counts, 64)
    assert over <= 2
    assert check_plan({}, 2048) == 0


def test_local_search_empties_bins():
    # Best fit decreasing needs three bins here; exchanges reach two.
    counts = {44: 1, 24: 2, 22: 2, 21: 2, 17: 2, 10: 0}
    counts = {n: k for n, k in counts.items() if k}
    start = packing._best_fit(counts, 106)
    found = check_plan(counts, 106)
    assert found <= sum(start.count.values())


@pytest.mark.parametrize("n, low, high, at_most", [
    (2000, 300, 1200, 740), (20000, 400, 1400, 8820), (200000, 300, 1500, 88100)])
def test_local_search_goes_on_until_no_exchange_is_left(n, low, high, at_most):
    rng = random.Random(1)
    counts = Counter(rng.randint(low, high) for _ in range(n))
    start = sum(packing._best_fit(counts, 2048).count.values())
    found = check_plan(dict(counts), 2048)
    assert found <= at_most < start
    bins = packing._best_fit(counts, 2048)
    search = packing._Search(bins)
    search.run()
    if search.n_bins > -(-sum(k * v for k, v in counts.items()) // 2048):
        search.least = 1
        assert all(search._partner(p) is None for p, k in bins.count.items() if k and bins.fill(p) < 2048)


def test_search_over_a_billion_pieces_ends():
    rng = random.Random(1)
    counts = {k: rng.randint(1, 2_000_000) for k in range(300, 1500)}
    bins = packing._best_fit(counts, 2048)
    start = sum(bins.count.values())
    packing._Search(bins).run()
    assert sum(bins.count.values()) < start
    total = Counter()
    for pattern, n in bins.count.items():
        assert bins.fill(pattern) <= 2048
        for length, k in pattern:
            total[length] += k * n
    assert total == Counter(counts)


@pytest.mark.parametrize("n", [60_000, 5_000_000])
def test_no_exchange_is_left_at_any_size(n):
    # A pass over single bins ends the search, also with far more than 100,000 of them.
    rng = np.random.default_rng(1)
    counts = dict(zip(range(300, 1500), rng.multinomial(n, [1 / 1200] * 1200).tolist()))
    bins = packing._best_fit(counts, 2048)
    search = packing._Search(bins)
    search.run()
    assert search.least == 1 and (n < 100_000 or search.n_bins > 1_000_000)
    assert all(search._partner(p) is None for p, k in bins.count.items() if k and bins.fill(p) < 2048)


def test_a_block_looks_up_each_distinct_pretoken_once():
    given, asked = [], []

    def encode(keys):
        given.extend(keys)
        return np.array([len(k) for k in keys]), np.array([c for k in keys for c in k], np.uint32)
    table = PretokenTable(encode, lambda buf: buf == 32, strip=False)
    slot_of = type(table.slots).__getitem__

    class Slots(type(table.slots)):
        def __getitem__(self, key):
            asked.append(key)
            return slot_of(self, key)
    table.slots = Slots([])
    texts = [b"ab cd cd", b"", b"cd ab ab ab", b" cd"] * 50
    assert [bytes(x.tolist()) for x in table.ids(texts)] == texts
    assert sorted(asked) == sorted(given) == [b" ab", b" cd", b"ab", b"cd"]


def test_unknown_pretokens_go_to_the_tokenizer_in_runs(monkeypatch):
    import tokenizers
    library, calls = Tokenizer.from_file(BYTES), []

    class Spy:
        def __getattr__(self, name):
            return getattr(library, name)

        def encode_batch_fast(self, texts, **options):
            calls.append(len(texts))
            return library.encode_batch_fast(texts, **options)

        def encode(self, text, **options):
            raise AssertionError("one by one")

    class Files:
        from_file = staticmethod(lambda path: Spy())
    monkeypatch.setattr(tokenizers, "Tokenizer", Files)
    text = " ".join(f"w{i}x" for i in range(1000)) + "\n a  b. c\u00e9 \u00e9d"
    ids = packing.tokenizer(BYTES)([text])
    assert ids[0].tolist() == library.encode(text, add_special_tokens=False).ids
    assert 0 < sum(calls) < 40
