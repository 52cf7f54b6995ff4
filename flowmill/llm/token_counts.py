"""Token counts of whole texts under a byte-level pair vocabulary.

Whole-token shortcut: before the job, every vocabulary string is encoded by itself; those that come out as one token
are proven. A pre-token that is a proven string counts 1 without merging; only the rest is merged.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from flowmill.llm.batches import Shared, per_text
from flowmill.llm.bytepairs import Vocabulary, WordTokens


def whole_tokens(vocabulary: Vocabulary) -> np.ndarray:
    """Sorted hashes of the vocabulary strings that are one pre-token and encode alone as one token."""
    ends = zip(vocabulary.spells[:-1], vocabulary.spells[1:], strict=True)
    spelled = [vocabulary.spelled[a:b].tobytes().decode("utf-8", "ignore") for a, b in ends]
    texts = [s for s in dict.fromkeys(spelled) if s and s not in vocabulary.special]
    found = vocabulary.pre_tokens(texts)
    alone = found.texts[:-1][np.diff(found.texts) == 1]
    _, offsets = vocabulary.merge_flat(*found.bytes_of(alone))
    return np.sort(found.hashes()[alone[np.diff(offsets) == 1]])


def count_tokens(
    docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",), limit: int = 512
) -> DataFrame:
    """Per row: ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens) and ``n_whole``, the
    pre-tokens that the shortcut counted.

    Null counts as an empty text: no bytes, no tokens. A special string inside a text is one token. A text of any
    length is counted whole. Repeated rows stay; a kept column named like a result gives way to it.
    """
    vocabulary = Vocabulary.load(path)
    shared = Shared(docs.sparkSession, (vocabulary, whole_tokens(vocabulary)))

    def start():
        own, proven = shared.get()
        merged = WordTokens(own)

        def compute(texts: pa.Array):
            found = own.pre_tokens(texts.fill_null("").to_pylist())
            hashes = found.hashes()
            at = np.minimum(np.searchsorted(proven, hashes), len(proven) - 1)
            direct = (proven[at] == hashes) & (found.special < 0)
            counts = np.ones(len(hashes), np.int64)
            rest = np.flatnonzero(~direct & (found.special < 0))
            _, counts[rest] = merged.of(found.only(rest), hashes[rest])
            sums = np.append(0, np.cumsum(counts))
            whole = np.append(0, np.cumsum(direct))
            totals = np.diff(sums[found.texts])
            sizes = pa.compute.binary_length(texts).fill_null(0).cast(pa.int64())
            return sizes, totals, totals > limit, np.diff(whole[found.texts])

        return compute

    fields = "n_bytes long, n_tokens long, over_limit boolean, n_whole long"
    return per_text(docs, text, keep, fields, start)

