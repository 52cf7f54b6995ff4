"""Language of whole texts: averaged embeddings of hashed subwords and a linear softmax, trained by gradient descent.

Subwords are byte n-grams within words, with the space before and behind a word counted in. A text's vector is the
mean of its subwords' embeddings. Because the classifier is linear, embeddings and classes fold into one table of
scores per subword, so a prediction is one look-up per subword and a sum per text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmill.functions.columns import q
from flowmill.llm.batches import Shared, per_text, pieces
from flowmill.llm.words import flat_bytes

UNKNOWN = "und"
#: Distinct labelled texts that a fit may gather on the driver, over all languages; and the languages it may learn.
TRAIN_ROWS, MAX_LANGUAGES = 2_000, 200
#: Share of rightly recognised calibration texts that rejection may cost.
LOST = 0.002

_SIZES = (2, 3, 4)
_BUCKETS = 1 << 14
_SEGMENT = 1 << 17
_FOLD = np.where(np.arange(256) >= 0x80, np.arange(256), 0x20).astype(np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def _spaced(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts in one array with a space around each, all but letters made spaces; and where each text starts."""
    raw, offsets = flat_bytes(texts)
    sizes = np.diff(offsets)
    flat = np.full(len(raw) + len(sizes) + 1, 0x20, np.uint8)
    flat[np.arange(len(raw)) + np.repeat(np.arange(len(sizes)) + 1, sizes)] = _FOLD[raw]
    return flat, offsets[:-1] + np.arange(len(sizes))


def _subwords(flat: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of the subword that starts at each place, and whether there is one."""
    n = max(len(flat) - size + 1, 0)
    mixed = np.full(n, 0x165667B1 * size & 0xFFFFFFFF, np.uint32)
    space = flat == 0x20
    real = ~(space[:n] & space[size - 1 : size - 1 + n])
    for k in range(size):
        mixed += flat[k : k + n] * _FACTORS[k]
        if 0 < k < size - 1:
            real &= ~space[k : k + n]
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    mixed ^= mixed >> np.uint32(13)
    return mixed & np.uint32(_BUCKETS - 1), real


def _segments(flat: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Buckets and whether they count, piece by piece, with the texts that lie in the piece and where they start."""
    for at in range(0, len(flat), _SEGMENT):
        piece = flat[at : at + _SEGMENT + max(_SIZES) - 1]
        first = max(int(np.searchsorted(starts, at, side="right")) - 1, 0)
        last = int(np.searchsorted(starts, min(at + _SEGMENT, len(flat))))
        for size in _SIZES:
            buckets, real = _subwords(piece, size)
            buckets, real = buckets[:_SEGMENT], real[:_SEGMENT]
            own = np.maximum(starts[first:last] - at, 0)
            inside = own < len(buckets)
            if inside.any():
                yield buckets, real, np.arange(first, last)[inside], own[inside]


def subword_counts(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """For every text the buckets of its subwords and their shares; nothing for texts without letters."""
    found = []
    for i in range(len(texts)):
        flat, starts = _spaced(texts.slice(i, 1))
        counts = np.zeros(_BUCKETS)
        for buckets, real, _, _ in _segments(flat, starts):
            counts += np.bincount(buckets[real], minlength=_BUCKETS)
        some = np.flatnonzero(counts)
        found.append((some.astype(np.int32), (counts[some] / max(counts.sum(), 1)).astype(np.float32)))
    return found


@dataclass(frozen=True)
class Model:
    """Scores per subword and language (a fixed 16,384 rows), the temperature, and the least score to accept."""

    languages: tuple[str, ...]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    least: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        flat, starts = _spaced(texts)
        sums, counts = np.zeros((len(starts), len(self.languages))), np.zeros(len(starts))
        columns = [np.ascontiguousarray(self.table[:, c]) for c in range(len(self.languages))]
        for buckets, real, which, own in _segments(flat, starts):
            counts[which] += np.add.reduceat(real, own, dtype=np.int64)
            for c, column in enumerate(columns):
                sums[which, c] += np.add.reduceat(column[buckets] * real, own, dtype=np.float64)
        return sums / np.maximum(counts, 1)[:, None] + self.bias

    def predict(self, texts: pa.Array) -> tuple[list[str], list[float], list[bool]]:
        """Language, score and whether it is rejected; without letters or a learned language: unknown, 0, rejected."""
        lettered = [t is not None and any(map(str.isalpha, t)) for t in texts.to_pylist()]
        if not self.languages:
            return [UNKNOWN] * len(texts), [0.0] * len(texts), [True] * len(texts)
        chances = _softmax(self.logits(texts) / self.temperature)
        best = chances.argmax(axis=1)
        scores = [float(chances[i, b]) if ok else 0.0 for i, (b, ok) in enumerate(zip(best, lettered, strict=True))]
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        return names, scores, [not ok or s < self.least for s, ok in zip(scores, lettered, strict=True)]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(
    examples: Sequence[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    n_classes: int,
    width: int = 8,
    epochs: int = 4,
    batch: int = 32,
    rate: float = 30.0,
    seed: int = 7,
) -> tuple[np.ndarray, np.ndarray]:
    """Gradient descent over (buckets, shares) examples; scores per bucket and class, and the classes' bias.

    The steps shrink linearly to nothing. Classes weigh alike, however many examples each has.
    """
    draw = np.random.default_rng(seed)
    embed = draw.normal(0, 1 / width, (_BUCKETS, width)).astype(np.float32)
    weights = draw.normal(0, 1 / width, (width, n_classes)).astype(np.float32)
    bias = np.zeros(n_classes, np.float32)
    share = np.bincount(labels, minlength=n_classes) / max(len(labels), 1)
    weigh = (1 / np.maximum(share * n_classes, 0.05)).astype(np.float32)
    steps = max(epochs * -(-len(examples) // batch), 1)
    step = 0
    for _ in range(epochs):
        order = draw.permutation(len(examples))
        for at in range(0, len(order), batch):
            now = order[at : at + batch]
            shares = np.zeros((len(now), _BUCKETS), np.float32)
            for row, i in enumerate(now):
                shares[row, examples[i][0]] = examples[i][1]
            used = np.flatnonzero(shares.any(axis=0))
            shares = shares[:, used]
            vectors = shares @ embed[used]
            slope = _softmax(vectors @ weights + bias)
            slope[np.arange(len(now)), labels[now]] -= 1
            slope *= weigh[labels[now]][:, None] / len(now)
            pace = rate * (1 - step / steps)
            back = slope @ weights.T
            weights -= np.float32(0.02 * pace) * (vectors.T @ slope)
            bias -= np.float32(0.02 * pace) * slope.sum(axis=0)
            embed[used] -= np.float32(pace) * (shares.T @ back)
            step += 1
    return embed @ weights, bias


def calibrate(logits: np.ndarray, labels: np.ndarray, whole: np.ndarray, lost: float = LOST) -> tuple[float, float]:
    """The temperature with the least log loss, and the score that costs ``lost`` of the rightly recognised whole texts.

    ``whole`` says which examples are texts and not only runs of their words; without any, all count.
    """
    if not len(logits):
        return 1.0, 0.0
    grid = np.geomspace(0.05, 20, 60)
    losses = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    chances = _softmax(logits / temperature)
    right = chances.argmax(axis=1) == labels
    right &= whole if whole.any() else True
    least = float(np.quantile(chances[right].max(axis=1), lost)) if right.any() else 0.0
    return temperature, least


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 2 modulo 4; a null id counts as an empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


_PIECES = (1, 3, 8, 24)


def _examples(texts: pa.Array) -> list[list[str]]:
    """Each text and a few runs of its words, from places that its length decides, so that short texts are learned too."""
    found = []
    for text in texts.to_pylist():
        words = (text or "").split()
        runs = [words[(7 * k * len(words)) // 50 :][:n] for k, n in enumerate(_PIECES, 1) if len(words) > n]
        found.append([text or "", *map(" ".join, runs)])
    return found


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", train_rows: int = TRAIN_ROWS) -> Model:
    """Learn from about ``train_rows`` distinct labelled texts, the same number of each language.

    Which texts are taken, and which of them are kept back with all their runs for calibration, depends on hashes, so
    neither order nor copies matter. More labels than ``MAX_LANGUAGES`` are an error. Only subword counts
    of these texts reach the driver. Rows without text or label are left out; without any, no language is learned.
    """
    labelled = docs.select(q(text).cast("string").alias("text"), q(lang).cast("string").alias("lang"))
    labelled = labelled.filter(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = labelled.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} labels to learn")
    languages = tuple(sorted(r["lang"] for r in sizes))
    if not languages:
        return Model((), np.zeros((_BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    fine = 1 << 40
    cut = F.lit(-1)
    for r in sizes:
        part = min(1.0, train_rows / len(languages) / r["count"])
        cut = F.when(F.col("lang") == r["lang"], F.lit(int(part * fine))).otherwise(cut)
    sample = labelled.filter(F.pmod(F.xxhash64("text", "lang"), F.lit(fine)) < cut).dropDuplicates(["text", "lang"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                rows = []
                for label, runs in zip(piece.column("lang").to_pylist(), _examples(piece.column("text")), strict=True):
                    back = zlib.crc32(runs[0].encode()) % 5 == 4
                    for k, (buckets, shares) in enumerate(subword_counts(pa.array(runs, pa.string()))):
                        rows.append((label, k, back, buckets.tobytes(), shares.tobytes()))
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _KINDS, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "run", "back", "buckets", "shares"])

    counted = sample.limit(2 * train_rows).mapInArrow(count, _COUNTED)
    rows = sorted(counted.collect(), key=lambda r: (r["lang"], bytes(r["buckets"]), bytes(r["shares"])))
    rows = [r for r in rows if len(r["buckets"])]
    code = {name: i for i, name in enumerate(languages)}
    examples = [(np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["shares"], np.float32)) for r in rows]
    labels = np.array([code[r["lang"]] for r in rows], np.int64)
    kept_back = np.array([r["back"] for r in rows], bool)
    whole = np.array([r["run"] == 0 for r in rows], bool)
    chosen = [x for x, back in zip(examples, kept_back, strict=True) if not back]
    table, bias = train(chosen, labels[~kept_back], len(languages))
    others = [x for x, back in zip(examples, kept_back, strict=True) if back]
    logits = np.array([s @ table[b] + bias for b, s in others]).reshape(-1, len(languages))
    return Model(languages, table, bias, *calibrate(logits, labels[kept_back], whole[kept_back]))


_KINDS = (pa.string(), pa.int32(), pa.bool_(), pa.binary(), pa.binary())
_COUNTED = "lang string, run int, back boolean, buckets binary, shares binary"


def predict(docs: DataFrame, model: Model, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Per row: ``lang_pred``, ``score`` (0 to 1) and ``rejected``, from the whole text alone.

    Null texts and texts without a letter are ``und`` with score 0 and rejected. Other texts get a learned language;
    they are rejected if their score is below the calibrated least. Texts may be of any length. Repeated rows stay;
    kept columns named like a result give way.
    """
    shared = Shared(docs.sparkSession, model)

    def start():
        return shared.get().predict

    return per_text(docs, text, keep, "lang_pred string, score double, rejected boolean", start)


def known_language(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows whose language is not rejected, with their columns."""
    shared = Shared(docs.sparkSession, model)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.get()
        for batch in batches:
            for piece in pieces(batch, text):
                rejected = own.predict(piece.column(text))[2]
                yield piece.filter(pa.array([not r for r in rejected]))

    return docs.mapInArrow(keep, docs.schema)
