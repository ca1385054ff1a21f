"""SimHash near-duplicates against a brute-force version."""

from __future__ import annotations

import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from wordmill.llm import simhash
from wordmill.llm.components import components


def slow_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, max_bits):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= max_bits:
                root[find(i)] = find(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[find(i)] = min(key, least.get(find(i), key))
    return [least.get(find(i)) for i in range(len(rows))]


def test_documents_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = [(k, slow_fingerprint(t)) for k, t in texts.items()]
    want = {k: (f"{fp:016x}", c) for (k, fp), c in zip(rows, slow_components(rows, 2))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == want


def test_hard_rows(spark):
    data = [(5, None), (3, ""), (9, " \t\n"), (1, "a"), (2, "A"), (None, "a b"), (7, "É a\x1cb c"),
            (7, "É a\x1cb c"), (4, "word " * 30000), (6, "word " * 30001)]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("fp", F.lit("x"))
    out = simhash.near_duplicates(docs).collect()
    rows = [(k, slow_fingerprint(t)) for k, t in data]
    want = sorted((str(k), f"{fp:016x}", str(c)) for (k, fp), c in zip(rows, slow_components(rows, 2)))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in out) == want
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


@pytest.mark.parametrize("max_bits", [1, 2])
@pytest.mark.parametrize("cell_pairs", [0, 24, 10 ** 6])
def test_links_of_crowded_cells(spark, monkeypatch, max_bits, cell_pairs):
    # Cells of every size, through the pair path and the point path.
    monkeypatch.setattr(simhash, "CELL_PAIRS", cell_pairs)
    rng = random.Random(7)
    fps = set()
    for _ in range(12):
        base = rng.getrandbits(64)
        for _ in range(40):
            x = base
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(f,) for f in signed], "fp long")
    got = {r.node: r.root for r in components(simhash.links(frame, max_bits)).collect()}
    want = slow_components(list(zip(signed, fps)), max_bits)
    assert [got.get(s, s) for s in signed] == want


def test_cells_hold_every_link_and_few_others(spark):
    rng = random.Random(9)
    bases = [rng.getrandbits(64) for _ in range(300)]
    near = [b ^ sum(1 << i for i in rng.sample(range(64), 2)) for b in bases]
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    frame = spark.createDataFrame([(signed(f),) for f in bases + near], "fp long")
    cells: dict = {}
    for r in simhash._cells(frame).collect():
        cells.setdefault(r.cell, set()).add(r.fp)
    assert sum(map(len, cells.values())) == 28 * 600
    shared = {frozenset((a, b)) for fps in cells.values() for a in fps for b in fps if a != b}
    assert {frozenset((signed(a), signed(b))) for a, b in zip(bases, near)} <= shared
    assert len(shared) < 320
    # No two pairs of groups share a cell, whatever the vectors are.
    odd = spark.createDataFrame([(0,), (-1,), (0x5555555555555555,), (-0x5555555555555556,)], "fp long")
    assert len({(r.cell) for r in simhash._cells(odd).where("fp = 0").collect()}) == 28
    assert simhash._cells(odd).distinct().count() == 4 * 28


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(200)] + [(1000, x) for x in range(1001, 1100)] + [(5000, 5000)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, **{x: 1000 for x in range(1001, 1100)}}
