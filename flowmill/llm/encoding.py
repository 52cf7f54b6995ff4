"""Encoding whole texts to tokens of a byte-level pair vocabulary, and back.

Words are merged in batches: the symbols of many words lie in one flat array, and numpy rounds merge each word's
lowest-ranked pair (see ``bytepairs``). Tokens of a text are gathered from the merged words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowmill.llm.batches import Shared, per_text
from flowmill.llm.bytepairs import Vocabulary, WordTokens, spread


def encode_texts(words: WordTokens, texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of all texts in a row and each text's offset; null has none."""
    found = words.vocabulary.pre_tokens([t or "" for t in texts])
    starts, lengths = words.of(found, found.hashes())
    lengths[found.special >= 0] = 1
    ends = np.append(0, np.cumsum(lengths))
    tokens = words.tokens[spread(np.where(found.special >= 0, 0, starts), lengths)].astype(np.int64)
    tokens[ends[:-1][found.special >= 0]] = found.special[found.special >= 0]
    return tokens, ends[found.texts]


def encode(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per row the tokens of its text: ``ids`` array<int>. Null and empty texts have none; no text is cut.

    Strings that the vocabulary marks as special become their token wherever they stand.
    """
    shared = Shared(docs.sparkSession, Vocabulary.load(path))

    def start():
        words = WordTokens(shared.get())

        def compute(texts: pa.Array):
            tokens, ends = encode_texts(words, texts.to_pylist())
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32()))]

        return compute

    return per_text(docs, text, keep, "ids array<int>", start)


def round_trip(
    docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",), with_ids: bool = False
) -> DataFrame:
    """Encode every text and decode its tokens again: ``n_tokens``, ``ids_sha256`` of the ids as little-endian unsigned
    32-bit integers, ``decoded_sha256`` of the decoded text in UTF-8, and with ``with_ids`` the tokens as ``ids``.

    Null counts as an empty text. Bytes that are no UTF-8 decode to replacement characters. Repeated rows stay.
    """
    shared = Shared(docs.sparkSession, Vocabulary.load(path))

    def start():
        own = shared.get()
        words = WordTokens(own)

        def compute(texts: pa.Array):
            tokens, ends = encode_texts(words, texts.to_pylist())
            spans = list(zip(ends[:-1], ends[1:], strict=True))
            raw = tokens.astype("<u4")
            ids = [hashlib.sha256(raw[a:b].tobytes()).hexdigest() for a, b in spans]
            back = (own.decode(tokens[a:b]).decode("utf-8", "replace") for a, b in spans)
            decoded = [hashlib.sha256(t.encode()).hexdigest() for t in back]
            listed = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(tokens, pa.int32()))]
            return [np.diff(ends), ids, decoded, *(listed if with_ids else [])]

        return compute

    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return per_text(docs, text, keep, fields, start)
