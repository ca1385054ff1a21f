"""SimHash near-duplicates by segment-popcount embedding (operator 6).

A fingerprint is mapped to the bit counts of 32 segments of two bits. The
Manhattan distance of two such vectors is never above the number of differing
bits, so vectors within ``max_bits`` of each other hold every link. The
vectors are cut into eight groups of four segments: a distance of at most two
leaves at least six groups untouched, so two linked fingerprints share a grid
cell that leaves some pair of groups open (28 cells per fingerprint, of 48 bits
each). Pairs of a cell are kept by their Manhattan distance and verified on the
fingerprints themselves.

Unrelated fingerprints hardly share such cells (0.06 partners a cell among
10^9 random ones). Cells with many members, which large families of near copies
fill, are never expanded into pairs: their fingerprints are joined on the points at distance one, which at
most 65 fingerprints share, and linked in stars. That finds the same links up
to reachability with 65 rows per fingerprint, whatever the size of the cell.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import broadcast_if_small, frozen, map_texts, text_or_empty
from .components import components

SEED = 42
# A cell of up to this many fingerprints is compared pair by pair.
CELL_PAIRS = 24
_GROUPS = 8
_GROUP_BITS = 8
_LOW = 0x5555555555555555
_HIGH = -0x5555555555555556  # the other bits, as a signed long
_BLOCK = 1 << 16


def fingerprint(text: str, shingle_words: int) -> int:
    """The 64-bit fingerprint of one text (0 without words)."""
    words = text.encode().lower().split()  # on bytes: A-Z only, and exactly [\x20\x09-\x0D]
    if not words:
        return 0
    if len(words) < shingle_words:
        shingles = iter([words])
        n = 1
    else:
        n = len(words) - shingle_words + 1
        shingles = zip(*(words[i:i + n] for i in range(shingle_words)))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(b" ".join(s), SEED) for s in shingles), dtype="<u8", count=n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _BLOCK):
        part = hashes[at:at + _BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > n, bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle_words: int) -> DataFrame:
    """``id, text_hash, fp`` (the fingerprint as a signed long) for every row."""
    def start():
        def work(keys, texts):
            return {"id": pa.array([k["id"] for k in keys], pa.int64()),
                    "text_hash": pa.array([k["text_hash"] for k in keys], pa.int64()),
                    "fp": pa.array([fingerprint(t, shingle_words) for t in texts], pa.int64())}
        return work
    keyed = docs.select(F.struct(F.col(id_col).cast("long").alias("id"), _text_hash(text_col).alias("text_hash"))
                        .alias("key"), F.col(text_col).alias("text"))
    return map_texts(keyed, "key", "text", "id long, text_hash long, fp long", start)


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(text_or_empty(text_col), F.crc32(text_or_empty(text_col)))


def _embedding(fp: Column) -> Column:
    """Per-segment counts, each written in unary inside its own two bits: the
    Manhattan distance of two vectors is then the bit count of their XOR."""
    some = fp.bitwiseOR(F.shiftrightunsigned(fp, 1)).bitwiseAND(F.lit(_LOW))
    all_ = fp.bitwiseAND(F.shiftleft(fp, 1)).bitwiseAND(F.lit(_HIGH))
    return some.bitwiseOR(all_)


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _cells(fps: DataFrame) -> DataFrame:
    """``cell, fp``: one row per pair of groups left open. The cell is the vector
    with zeros for the pair and a tag that names it in the first of the two: no
    vector has such a byte, as its top segment would be 2 without being 1."""
    def open_(g: int, h: int) -> int:
        return ((1 << _GROUP_BITS) - 1) << g * _GROUP_BITS | ((1 << _GROUP_BITS) - 1) << h * _GROUP_BITS

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x
    pairs = [(g, h) for g in range(_GROUPS) for h in range(g + 1, _GROUPS)]
    keys = [F.col("vector").bitwiseAND(F.lit(signed(((1 << 64) - 1) & ~open_(g, h))))
            .bitwiseOR(F.lit(signed((0x80 | n) << g * _GROUP_BITS))) for n, (g, h) in enumerate(pairs)]
    return (fps.select("fp", _embedding(F.col("fp")).alias("vector"))
            .select("fp", F.explode(F.array(*keys)).alias("cell")))


def links(fps: DataFrame, max_bits: int) -> DataFrame:
    """``a, b``: links between distinct fingerprints (column ``fp``) such that
    exactly the fingerprints within ``max_bits`` steps are connected."""
    if not 1 <= max_bits <= 2:
        raise ValueError("max_bits must be 1 or 2")
    cells = frozen(_cells(fps))
    sizes = frozen(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = cells.join(sizes, "cell")

    small = (shared.where(F.col("n") <= CELL_PAIRS).groupBy("cell")
             .agg(F.sort_array(F.collect_list("fp")).alias("fps")))

    def near(a: Column, b: Column) -> Column:
        return ((a < b) & (_distance(_embedding(a), _embedding(b)) <= max_bits)
                & (_distance(a, b) <= max_bits))
    pairs = F.flatten(F.transform("fps", lambda a: F.transform(
        F.filter("fps", lambda b: near(a, b)), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    close = small.select(F.explode(pairs).alias("p")).select("p.a", "p.b")

    crowd = shared.where(F.col("n") > CELL_PAIRS).select("fp").distinct()
    flips = F.array(F.lit(0).cast("long"), *[F.lit(1 << b if b < 63 else -(1 << 63)) for b in range(64)])
    points = (crowd.select("fp", F.explode(flips).alias("flip"))
              .select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"))
              .groupBy("point").agg(F.sort_array(F.collect_list("fp")).alias("fps"))
              .where(F.size("fps") > 1))
    if max_bits == 2:
        hub = F.element_at("fps", 1)  # any two members differ in two bits at most
    else:
        points, hub = points.where(F.array_contains("fps", F.col("point"))), F.col("point")
    stars = points.select(hub.alias("a"), F.explode("fps").alias("b")).where("a <> b")
    return close.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: ``id, fingerprint, component_id``.

    ``fingerprint`` is 16 lower-case hex digits; ``component_id`` the smallest
    id reachable over links of at most ``max_bits`` differing bits, itself
    included. Fewer words than a shingle: the whole sequence is the shingle;
    no word (null, empty or white space): fingerprint zero, linked like any
    other. Rows with a null id take part and get the component of their
    fingerprint (null if no member has an id); repeated rows are each returned.
    """
    rows, of_fp = _groups(docs, id_col, text_col, shingle_words, max_bits)
    return rows.join(of_fp, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id")


def _groups(docs: DataFrame, id_col: str, text_col: str, shingle_words: int,
            max_bits: int) -> tuple[DataFrame, DataFrame]:
    """The rows (``id, text_hash, fp``) and, by fingerprint, the component
    (``fp, root, component_id``)."""
    rows = frozen(fingerprints(docs, id_col, text_col, shingle_words))
    classes = frozen(rows.groupBy("fp").agg(F.min("id").alias("first_id")))
    roots = components(links(classes.select("fp"), max_bits))
    joined = frozen(classes.join(roots, classes["fp"] == roots["node"], "left")
                    .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    least = frozen(joined.groupBy("root").agg(F.min("first_id").alias("component_id")))
    return rows, frozen(joined.join(least, "root").select("fp", "root", "component_id"))


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """The rows and columns of ``docs``, one row of each component: the one
    with the smallest id (a null id comes last); of rows that repeat the id,
    one."""
    rows, of_fp = _groups(docs, id_col, text_col, shingle_words, max_bits)
    first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash"))
    keep = frozen(rows.join(of_fp, "fp").groupBy("root").agg(first.alias("r"))
                  .select(F.col("r.id").alias("__keep_id"), F.col("r.text_hash").alias("__keep_hash")))
    same = F.col(id_col).eqNullSafe(F.col("__keep_id")) & (_text_hash(text_col) == F.col("__keep_hash"))
    kept = docs.join(broadcast_if_small(keep, 32), same, "left_semi")
    # Rows that repeat both id and text: only these few are brought together.
    repeated = frozen(rows.groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                      .select(F.col("id").alias("__keep_id"), F.col("text_hash").alias("__keep_hash")))
    if repeated.isEmpty():
        return kept
    once = kept.join(repeated, same, "left_anti")
    several = kept.join(repeated, same, "left_semi").withColumn("__keep_hash", _text_hash(text_col))
    return once.unionByName(several.dropDuplicates([id_col, "__keep_hash"]).drop("__keep_hash"))
