"""Token counts with a whole-token shortcut (operator 1).

For a sentencepiece BPE vocabulary in which no piece holds the space mark
after another character, no merge crosses the place before a run of spaces, so
a text's tokens are those of its pre-tokens. Vocabulary strings that encode
alone as one token are proved before the job by asking the tokenizer for every
one of them (a list of at most the vocabulary's size, sent with the tasks);
pre-tokens among these count one and are never merged. The rest is merged by
the tokenizer, each distinct one once per memo (bounded, keyed by the bytes).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, map_texts
from .pretokens import PretokenTable

OVER_LIMIT = 4096
_MARK = "▁"  # how the vocabulary writes a space


def whole_tokens(model) -> list[str]:
    """The vocabulary strings (without their leading space mark) that encode
    alone as that one token."""
    pieces = [(i, model.id_to_piece(i)) for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
    words = [(i, p[1:]) for i, p in pieces if p.startswith(_MARK) and len(p) > 1 and _MARK not in p[1:]]
    coded = model.encode([w for _, w in words], num_threads=1)
    return [w for (i, w), ids in zip(words, coded) if ids == [i]]


def splits_at_spaces(model) -> bool:
    """No piece holds the space mark after another character."""
    return not any(_MARK in model.id_to_piece(i).lstrip(_MARK) for i in range(model.get_piece_size()))


def _may_split(buf: np.ndarray) -> np.ndarray:
    """Before the first space of a run. The byte 0x81 may end a space mark that
    the text itself holds; no cut is made after it."""
    cut = buf == 32
    cut[1:] &= (buf[:-1] != 32) & (buf[:-1] != 0x81)
    return cut


def prove(model_path: str) -> list[bytes]:
    """The whole tokens of a vocabulary that never merges across spaces."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    if not splits_at_spaces(model):
        raise ValueError("a piece of this vocabulary crosses a space")
    return [w.encode() for w in whole_tokens(model)]


def counter(model_path: str, whole: tuple[bytes, ...] | None = None):
    """``texts -> token counts`` for one task, given its :func:`prove`."""
    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    whole = list(prove(model_path) if whole is None else whole)

    def encode(keys: list[bytes]) -> tuple[np.ndarray, None]:
        coded = model.encode([k.decode() for k in keys], num_threads=1)
        return np.fromiter(map(len, coded), np.int64, len(keys)), None

    return PretokenTable(encode, _may_split, strip=True, known=whole).counts


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = OVER_LIMIT) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_tokens, over_limit``.

    Counts are those of the library on the whole text, without begin or end
    tokens; strings of control tokens inside a text are ordinary text. A null
    or empty text has zero bytes and tokens; repeated rows are each returned;
    other columns are ignored. The tokenizer file must exist on the driver and the
    executors.
    """
    whole = tuple(prove(model_path))

    def start():
        count = kept(counter, model_path, whole)  # its memo goes on

        def work(ids, texts):
            coded = [t.encode() for t in texts]
            return {"id": pa.array(ids, pa.int64()),
                    "n_bytes": pa.array(list(map(len, coded)), pa.int64()),
                    "n_tokens": pa.array(count(coded), pa.int64())}
        return work
    rows = map_texts(docs, id_col, text_col, "id long, n_bytes long, n_tokens long", start, keeps=True)
    return rows.select(F.col("id").alias(id_col), "n_bytes", "n_tokens",
                       (F.col("n_tokens") > limit).alias("over_limit"))
