"""The registered queries of this subpackage (production parameters, whole
tables) and, where SQL can express one, its DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from .chaining import repeated_passages
from .collocations import collocations
from .decontaminate import leaks
from .exact_dedup import exact_dedup
from .extraction import extract, train
from .langid import held_out, identify, learn
from .licenses import license_scan
from .line_dedup import MIN_PAGES, RATIO, line_dedup
from .packing import pack
from .simhash import near_duplicates
from .spelling import deletions, spelling_groups, word_counts
from .token_counts import token_counts
from .warc import read_warc, write_warc

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "item_id", "coverage", "verbatim")


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    profiles = learn(docs.where(~held_out("doc_id")))
    return identify(docs, profiles).select(
        "doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "warc")
    write_warc(_table(spark, sf_dir, "pages"), target)
    return read_warc(spark, target).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(_table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"), digest_all=True)


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return extract(pages, train(pages))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The documents name their site in `source`.
    return line_dedup(_table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "text", "n_lines", "n_dropped")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents")).drop("spans")


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(word_counts(_table(spark, sf_dir, "documents"), edit=deletions()))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_decontamination": op2_decontamination,
    "op3_language_id": op3_language_id,
    "op4_warc": op4_warc,
    "op5_repeated_passages": op5_repeated_passages,
    "op6_simhash": op6_simhash,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_html_extraction": op8_html_extraction,
    "op9_packing": op9_packing,
    "op10_line_dedup": op10_line_dedup,
    "op11_collocations": op11_collocations,
    "op12_license_scan": op12_license_scan,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
        WITH p AS (
          SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
          FROM pages),
        m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
        FROM m""",
    "op7_exact_dedup": r"""
        WITH n AS (
          SELECT doc_id, length(coalesce(text, '')) AS n_cp,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
          FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept, text_sha256
        FROM n WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_cp DESC, doc_id)""",
    "op10_line_dedup": f"""
        WITH d AS (
          SELECT doc_id, source, text, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
        total AS (
          SELECT source, count(DISTINCT coalesce(text, '')) AS n_pages FROM d GROUP BY source),
        l AS (
          SELECT source, coalesce(text, '') AS page,
                 unnest(list_distinct([trim(x, ' ') FOR x IN lines])) AS line FROM d),
        boiler AS (
          SELECT l.source, l.line FROM l JOIN total ON l.source IS NOT DISTINCT FROM total.source
          WHERE l.line <> '' GROUP BY l.source, l.line, total.n_pages
          HAVING count(DISTINCT l.page) >= {MIN_PAGES}
             AND count(DISTINCT l.page) > {RATIO} * total.n_pages),
        marks AS (SELECT source, list(line) AS drops FROM boiler GROUP BY source),
        k AS (
          SELECT d.*, CASE WHEN m.drops IS NULL THEN d.lines ELSE
                   [x FOR x IN d.lines IF NOT list_contains(m.drops, trim(x, ' '))] END AS kept
          FROM d LEFT JOIN marks m ON d.source IS NOT DISTINCT FROM m.source)
        SELECT doc_id, source,
               CASE WHEN text IS NULL THEN NULL ELSE array_to_string(kept, chr(10)) END AS text,
               CASE WHEN text IS NULL THEN 0 ELSE len(lines) END::BIGINT AS n_lines,
               CASE WHEN text IS NULL THEN 0 ELSE len(lines) - len(kept) END::BIGINT AS n_dropped
        FROM k""",
    "op11_collocations": r"""
        WITH p AS (
          SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
          FROM documents),
        w AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS words FROM p),
        g AS (
          SELECT lang, k, unnest([array_to_string(words[i:i + k - 1], ' ') FOR i IN range(1, len(words) - k + 2)]) AS phrase
          FROM w, (VALUES (1), (2), (3), (4)) t(k)),
        c AS (SELECT lang, k, phrase, count(*) AS f FROM g GROUP BY lang, k, phrase),
        n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM c WHERE k = 1 GROUP BY lang),
        cand AS (SELECT *, string_split(phrase, ' ') AS words FROM c WHERE k >= 2 AND f >= 30),
        cuts AS (
          SELECT lang, phrase, k, f, j, array_to_string(words[1:j], ' ') AS head, array_to_string(words[j + 1:], ' ') AS tail
          FROM cand, (VALUES (1), (2), (3)) t(j) WHERE j < k),
        s AS (
          SELECT cuts.lang, cuts.phrase, cuts.k, j, cuts.f AS a, h.f AS l, t.f AS r,
                 CAST((2000000::HUGEINT * cuts.f) // (h.f + t.f) AS BIGINT) AS score
          FROM cuts JOIN c h ON h.lang = cuts.lang AND h.phrase = cuts.head
                    JOIN c t ON t.lang = cuts.lang AND t.phrase = cuts.tail),
        low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
        parts AS (
          SELECT lang, f, unnest([array_to_string(words[i:i + m - 1], ' ') FOR i IN range(1, k - m + 2)]) AS phrase
          FROM cand, (VALUES (2), (3)) t(m) WHERE m < k),
        inside AS (SELECT lang, phrase, max(f) AS longer FROM parts GROUP BY lang, phrase),
        kept AS (
          SELECT low.* FROM low LEFT JOIN inside USING (lang, phrase)
          WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000""",
}
