"""Credentials in whole texts: three fixed patterns, and strings that learned credential formats make likely.

Probabilistic automata are learned from labelled credentials, one per format, and one from ordinary long strings.
Every candidate (a long run of credential characters) is scored by the best format's likelihood against the ordinary
one.
"""

from __future__ import annotations

import hashlib
import random
import re
import string
from bisect import bisect_right
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from flowmill.functions.columns import q
from flowmill.llm.automata import Automaton, learn
from flowmill.llm.batches import Shared, per_text
from flowmill.llm.words import flat_bytes

KINDS = ("assign", "access", "hex", "learned")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
#: A text without any of these has no span of the fixed patterns.
_MAYBE = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=])|AKIA[A-Z0-9]{16}|[0-9a-f]{24}"""

LEAST = 20  # characters of a learned span
MARGIN = 12.0  # by how much (natural logarithm) a format must beat the ordinary model

# Labelled credential formats as (label, prefix, characters, length).
_WORD = string.ascii_letters + string.digits
FORMATS = (
    ("code host token", "ghp_", _WORD, 36),
    ("code host server token", "ghs_", _WORD, 36),
    ("package index token", "pypi-", _WORD + "-_", 60),
    ("package registry token", "npm_", _WORD, 36),
    ("chat bot token", "xoxb-", string.digits + _WORD, 40),
    ("payment live key", "sk_live_", _WORD, 24),
    ("map service key", "AIza", _WORD + "-_", 35),
    ("mail service key", "SG.", _WORD + "-_.", 64),
    ("signed claim", "eyJhbGciOi", _WORD + "-_.", 90),
    ("access secret", "", _WORD + "+/", 40),
    ("random key", "", _WORD, 32),
)


def labelled_credentials(per_format: int = 300, seed: int = 20) -> dict[str, list[str]]:
    """Examples of every format, drawn by a fixed seed."""
    draw = random.Random(seed)
    return {
        label: [prefix + "".join(draw.choices(letters, k=length)) for _ in range(per_format)]
        for label, prefix, letters, length in FORMATS
    }


def ordinary_strings(n: int = 1500, seed: int = 21) -> list[str]:
    """Long runs that are no credentials: joined words in usual spellings, paths, versions, dates,
    numbers, ids, rules."""
    draw = random.Random(seed)

    def word() -> str:
        return "".join(draw.choices(string.ascii_lowercase, weights=_LETTER_WEIGHTS, k=draw.randrange(2, 11)))

    def number() -> str:
        return "".join(draw.choices(string.digits, k=draw.randrange(1, 9)))

    def make() -> str:
        parts = [number() if draw.random() < 0.25 else word() for _ in range(draw.randrange(3, 8))]
        style = draw.randrange(11)
        if style == 0:
            return "".join(p.capitalize() for p in parts)
        if style == 1:
            return "_".join(parts).upper()
        if style == 2:
            return "".join(parts)
        if style == 3:
            return "/".join(parts) + draw.choice(["", ".html", ".png", "/"])
        if style == 4:
            return "".join(draw.choices(string.digits, k=draw.randrange(16, 30)))
        if style == 5:
            day = f"{draw.randrange(1990, 2040)}-{draw.randrange(1, 13):02}-{draw.randrange(1, 29):02}"
            time = f"{draw.randrange(24):02}{draw.choice('.-')}{draw.randrange(60):02}"
            return f"{day}T{time}{draw.choice(['', 'Z'])}{draw.choice(['', '.'])}{draw.choice(['', word()])}"
        if style == 6:
            hexes = "".join(draw.choices("0123456789abcdef", k=32))
            cased = draw.choice([hexes, hexes.upper()])
            return "-".join([cased[:8], cased[8:12], cased[12:16], cased[16:20], cased[20:]])
        if style == 7:
            return draw.choice("_-.").join(p.capitalize() for p in parts)
        if style == 8:
            return draw.choice("_-").join(draw.choice([p, p.upper(), p.capitalize()]) for p in parts)
        return draw.choice("_-.").join(parts)

    def ruled() -> str:
        rule = draw.choice("_-=+./") * draw.randrange(3, 50)
        return draw.choice([rule, rule, f"+{rule}+{rule}+", rule + word() + rule, word() + rule + word()])

    return [make() for _ in range(n)] + [ruled() for _ in range(n // 10)]


# Rough shares of the letters a to z in ordinary words.
_LETTER_WEIGHTS = (8, 2, 3, 4, 12, 2, 2, 6, 7, 1, 1, 4, 2, 7, 8, 2, 1, 6, 6, 9, 3, 1, 2, 1, 2, 1)


def learn_formats(
    labelled: Mapping[str, Sequence[str]] | None = None, ordinary: Sequence[str] | None = None
) -> tuple[list[Automaton], Automaton]:
    """One automaton per label of the credentials, and one of the ordinary strings; those drawn here without any."""
    examples = labelled_credentials() if labelled is None else labelled
    return [learn(x) for x in examples.values()], learn(ordinary_strings() if ordinary is None else ordinary)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns as (start, end, kind), by start and then kind."""
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(found, key=_order)


def _order(span: tuple[int, int, str]) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


_CANDIDATE = np.zeros(256, bool)
_CANDIDATE[[ord(c) for c in _WORD + "+/_-."]] = True  # "=" parts a name from its value, or pads the end


def candidates(texts: pa.Array, least: int = LEAST) -> Iterator[tuple[int, int, int]]:
    """Runs of credential characters, at least ``least`` long: (text, first byte, end)."""
    raw, offsets = flat_bytes(texts)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = _CANDIDATE[raw]
    turns = np.diff(inside)
    cuts = np.unique(offsets[(offsets > 0) & (offsets < len(raw))])
    cuts = cuts[(inside[cuts] == 1) & (inside[cuts + 1] == 1)]  # runs that reach over the border of two texts
    starts = np.sort(np.concatenate([np.flatnonzero(turns == 1), cuts]))
    ends = np.sort(np.concatenate([np.flatnonzero(turns == -1), cuts]))
    long = ends - starts >= least
    starts, ends = starts[long], ends[long]
    owners = np.searchsorted(offsets, starts, side="right") - 1
    return zip(owners.tolist(), (starts - offsets[owners]).tolist(), (ends - offsets[owners]).tolist(), strict=True)


def _covered(spans: Sequence[tuple[int, int, str]]) -> tuple[list[int], list[int]]:
    """Starts and ends of the stretches that spans, by start, cover together."""
    starts: list[int] = []
    ends: list[int] = []
    for a, b, _ in spans:
        if ends and a <= ends[-1]:
            ends[-1] = max(ends[-1], b)
        else:
            starts.append(a)
            ends.append(b)
    return starts, ends


def find_spans(
    texts: pa.Array, formats: Sequence[Automaton], ordinary: Automaton, margin: float = MARGIN
) -> list[list[tuple[int, int, str]]]:
    """All spans of every text, in code points; learned ones where the fixed patterns do not cover all of them."""
    texts = texts.fill_null("")
    found: list[list[tuple[int, int, str]]] = [[] for _ in range(len(texts))]
    for i in pc.indices_nonzero(pc.match_substring_regex(texts, _MAYBE)).to_pylist():
        found[i] = base_spans(texts[i].as_py())
    raw, offsets = flat_bytes(texts)
    likely: dict[str, bool] = {}  # of distinct runs
    learned: dict[int, list[tuple[int, int]]] = {}  # in bytes
    for i, a, b in candidates(texts):
        whole = raw[offsets[i] + a : offsets[i] + b].tobytes().decode()
        run = whole.strip(".-/")
        if len(run) < LEAST:
            continue
        if run not in likely:
            likely[run] = max(f.log_likelihood(run) for f in formats) - ordinary.log_likelihood(run) >= margin
        if likely[run]:
            start = a + whole.index(run)
            learned.setdefault(i, []).append((start, start + len(run)))
    for i, spans in learned.items():
        first = (raw[offsets[i] : offsets[i + 1]] & 0xC0) != 0x80
        points = np.concatenate([[0], np.cumsum(first)])  # code points before a byte
        starts, ends = _covered(found[i])
        for a, b in points[np.array(spans)].tolist():
            at = bisect_right(starts, a) - 1
            if at < 0 or ends[at] < b:
                found[i].append((a, b, "learned"))
        found[i].sort(key=_order)
    return found


def spelled(spans: Sequence[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


def scan(
    docs: DataFrame,
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    labelled: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Per row: ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256``, ``spans`` (all, as kind:start:end) and
    ``n_learned``.

    ``labelled`` are known credentials by format, of which the automata are learned in place of the drawn examples.
    Null counts as empty: no spans, the hash of nothing, an empty string. Texts of any length are searched whole, in time
    that grows with their length. A learned span that fixed patterns cover in part stays whole beside them.
    Spans of one start are in the order of ``KINDS``. Repeated rows stay; kept columns named like a result give way.
    """
    models = Shared(docs.sparkSession, learn_formats(labelled))

    def start():
        formats, ordinary = models.get()

        def compute(texts: pa.Array):
            found = find_spans(texts, formats, ordinary)
            base = [[s for s in spans if s[2] != "learned"] for spans in found]
            counts = [[sum(k == kind for _, _, k in spans) for spans in found] for kind in KINDS]
            hashes = [hashlib.sha256(spelled(spans).encode()).hexdigest() for spans in base]
            return [*counts[:3], hashes, [spelled(spans) for spans in found], counts[3]]

        return compute

    fields = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_learned long"
    return per_text(docs, text, keep, fields, start)


def blanked(text: str | None, spans: Sequence[tuple[int, int, str]], mark: str) -> str | None:
    """The text with a mark in place of every stretch that spans cover."""
    if not spans or text is None:
        return text
    parts, at, open_to = [], 0, -1
    for a, b, _ in spans:
        if a >= open_to:
            parts += [text[at:a], mark]
        at = open_to = max(b, open_to)
    return "".join([*parts, text[at:]])


def redact(docs: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """The same rows and columns with credentials in ``text`` replaced by ``mark``; null texts stay null."""
    models = Shared(docs.sparkSession, learn_formats())

    def start():
        formats, ordinary = models.get()

        def compute(texts: pa.Array):
            found = find_spans(texts, formats, ordinary)
            return [[blanked(t, s, mark) for t, s in zip(texts.to_pylist(), found, strict=True)]]

        return compute

    # the result has the name of the text, which it replaces
    clean = per_text(docs, text, docs.columns, "`" + text.replace("`", "``") + "` string", start)
    return clean.select(*(q(c) for c in docs.columns))
