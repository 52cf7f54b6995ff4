"""Byte-level pair merging in batches of words, with numpy.

The merge table of a vocabulary file becomes sorted pair keys, so that the rank of any pair is found by binary
search. Many words lie in one flat array of symbols; each round finds every word's lowest-ranked pair and merges all
its occurrences, until no word has a known pair. A merge never makes a pair that ranks before it, so merging all
occurrences at once gives what merging one by one gives.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import regex
from tokenizers.pre_tokenizers import ByteLevel

from flowmill.llm.words import byte_table, run_hashes

_NO_RANK = np.int64(1) << 60
_OTHER, _LETTER, _NUMBER, _SPACE = range(4)
_HASHED_BYTES = 1 << 16
_BYTE_VALUES = byte_table(np.ones(256, bool), fold=False)


def character_kinds() -> np.ndarray:
    """Letter, number, white space or other, for every code point, by the tokenizer library's Unicode version.

    Code points newer than this Python's tables are tried in the library: a letter joins a letter before it.
    """
    kinds = np.zeros(0x110000, np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF)
    split = ByteLevel(add_prefix_space=False).pre_tokenize_str
    for kind, pattern, like in ((_LETTER, r"\p{L}+", "a"), (_NUMBER, r"\p{N}+", "1"), (_SPACE, r"\s+", "\n")):
        found = "".join(regex.findall(pattern, every))
        newer = [c for c in found if unicodedata.category(c) == "Cn"]
        kinds[[ord(c) for c in found]] = kind
        ends = {b for _, (_, b) in split("".join(f" {like}{c}" for c in newer))}
        kinds[[ord(c) for i, c in enumerate(newer) if 3 * i + 2 in ends]] = _OTHER
    return kinds


def pre_token_starts(points: np.ndarray, kinds: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pre-tokens start in the code points of texts in a row; ``texts`` has the starts of the non-empty texts.

    A pre-token is a run of letters, of numbers or of other characters, with one space before it if there is one; or
    white space: all of a run at a text's end, otherwise all but its last character, and that one if it is no space.
    An apostrophe that starts a pre-token takes the s, t, m, d, re, ve or ll behind it and ends there.
    """
    kind = kinds[points]
    start = np.empty(len(points), bool)
    start[0], start[1:] = True, kind[1:] != kind[:-1]
    first = np.zeros(len(points), bool)
    first[texts] = True
    start |= first
    after = np.flatnonzero((kind[1:] != _SPACE) & (kind[:-1] == _SPACE) & ~first[1:]) + 1
    start[after - 1] = True
    start[after[points[after - 1] == 0x20]] = False
    marks = np.flatnonzero((points == 0x27) & start)
    marks = marks[marks + 1 < len(points)]
    marks = marks[~first[marks + 1]]
    one = points[marks + 1]
    two = np.where(marks + 2 < len(points), points[np.minimum(marks + 2, len(points) - 1)], 0)
    two = np.where(first[np.minimum(marks + 2, len(points) - 1)], 0, two)
    short = np.isin(one, [ord(c) for c in "stmd"])
    long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    start[marks[short | long] + 1] = False
    ends = np.concatenate([marks[short] + 2, marks[long] + 3])
    start[ends[ends < len(points)]] = True
    return start


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, mapped to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level pair vocabulary as plain arrays, small enough to broadcast (a few MB for 50,000 tokens)."""

    symbols: np.ndarray  # token of each byte
    pairs: np.ndarray  # sorted keys left * base + right
    ranks: np.ndarray  # rank of each pair in that order
    merged: np.ndarray  # token that each pair becomes, in that order
    base: int
    spelled: np.ndarray  # bytes of all tokens in a row
    spells: np.ndarray  # offset of each token's bytes
    kinds: np.ndarray  # of every code point
    special: dict[str, int]  # strings that are tokens wherever they stand

    @staticmethod
    def load(path: str) -> Vocabulary:
        """Read a ``tokenizers`` file of the byte-level kind without normaliser, prefix space or post-processing."""
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        if content["model"]["type"] != "BPE" or content["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path} is no byte-level pair vocabulary")
        if content["normalizer"] or content["post_processor"] or content["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} changes texts before or after merging, which is not supported")
        tokens, to_byte = content["model"]["vocab"], _byte_characters()
        special = {t["content"]: t["id"] for t in content["added_tokens"] if t["special"]}
        base = max([*tokens.values(), *special.values()]) + 1
        keys, after = [], []
        for entry in content["model"]["merges"]:
            left, right = entry.split(" ") if isinstance(entry, str) else entry
            keys.append(tokens[left] * base + tokens[right])
            after.append(tokens[left + right])
        order = np.argsort(np.array(keys, np.int64), kind="stable")
        spelled = [b""] * base
        for token, i in tokens.items():
            spelled[i] = bytes(to_byte[c] for c in token)
        for token, i in special.items():
            spelled[i] = token.encode()
        symbols = np.zeros(256, np.int64)
        for character, byte in to_byte.items():
            symbols[byte] = tokens[character]
        return Vocabulary(
            symbols,
            np.array(keys, np.int64)[order],
            order.astype(np.int64),
            np.array(after, np.int64)[order],
            base,
            np.frombuffer(b"".join(spelled), np.uint8),
            np.append(0, np.cumsum([len(x) for x in spelled])),
            character_kinds(),
            special,
        )

    def pre_tokens(self, texts: Sequence[str]) -> PreTokens:
        """The pre-tokens and special strings of all texts; of special strings at one place the longest counts."""
        joined = "".join(texts)
        raw = np.frombuffer(joined.encode(), np.uint8)
        points = raw if len(raw) == len(joined) else np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))
        begins = np.append(0, ends[:-1])
        if not len(points):
            none = np.zeros(0, np.int64)
            return PreTokens(raw, none, none, np.zeros(len(texts) + 1, np.int64), none)
        found = []
        if any(s in joined for s in self.special):
            wanted = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))))
            for at, text in zip(begins.tolist(), texts, strict=True):
                found += [(at + m.start(), at + m.end(), self.special[m[0]]) for m in wanted.finditer(text)]
        cuts = {x for a, b, _ in found for x in (a, b) if x < len(points)}
        starts = np.unique(np.concatenate([begins[begins < ends], np.array(sorted(cuts), np.int64)]))
        start = pre_token_starts(points, self.kinds, starts)
        for a, b, _ in found:
            start[a + 1 : b] = False
        at = np.flatnonzero(start)
        token = np.full(len(at), -1)
        token[np.searchsorted(at, [a for a, _, _ in found])] = [t for _, _, t in found]
        owners = np.searchsorted(at, np.append(begins, len(points)))
        if points is not raw:
            widths = 1 + (points > 0x7F) + (points > 0x7FF).astype(np.int64) + (points > 0xFFFF)
            at = (np.cumsum(widths) - widths)[at]
        return PreTokens(raw, at, np.diff(np.append(at, len(raw))), owners, token)

    def merge(self, words: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of all words in a row and each word's offset among them."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        return self.merge_flat(np.frombuffer(b"".join(words), np.uint8), sizes)

    def merge_flat(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same for words that lie in a row, given the size of each."""
        flat = self.symbols[raw]
        owner = np.repeat(np.arange(len(sizes)), sizes)
        done_tokens, done_owners = [], []
        rank, after = self._look_up(flat, owner, np.arange(len(flat)))
        while len(flat):
            first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.minimum.reduceat(rank, first)
            length = np.diff(np.append(first, len(flat)))
            active = np.repeat(best < _NO_RANK, length)
            if not active.all():
                done_tokens.append(flat[~active])
                done_owners.append(owner[~active])
            spots = np.flatnonzero((rank == np.repeat(best, length)) & active)
            # where a pair overlaps itself (aaa), occurrences count from the left
            if len(spots) > 1 and (np.diff(spots) == 1).any():
                starts = np.flatnonzero(np.append(True, np.diff(spots) > 1))
                turn = np.arange(len(spots)) - np.repeat(starts, np.diff(np.append(starts, len(spots))))
                spots = spots[turn % 2 == 0]
            flat[spots] = after[spots]
            stay = active
            stay[spots + 1] = False
            place = np.cumsum(stay) - 1
            flat, owner, rank, after = flat[stay], owner[stay], rank[stay], after[stay]
            spots = place[spots]
            near = np.zeros(len(flat) + 1, bool)
            near[spots] = near[spots - 1] = True  # the place before the first is the spare one
            changed = np.flatnonzero(near[:-1])
            rank[changed], after[changed] = self._look_up(flat, owner, changed)
        if not done_tokens:
            return np.zeros(0, np.int64), np.zeros(len(sizes) + 1, np.int64)
        owner = np.concatenate(done_owners)
        order = np.argsort(owner, kind="stable")
        counts = np.bincount(owner, minlength=len(sizes))
        return np.concatenate(done_tokens)[order], np.append(0, np.cumsum(counts))

    def _look_up(self, flat: np.ndarray, owner: np.ndarray, where: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank of the pair that starts at each place, and its token; no rank at the end of a word."""
        rank, after = np.full(len(where), _NO_RANK), np.zeros(len(where), np.int64)
        inner = np.flatnonzero(where + 1 < len(flat))
        inner = inner[owner[where[inner]] == owner[where[inner] + 1]]
        if len(inner) and len(self.pairs):
            key = flat[where[inner]] * self.base + flat[where[inner] + 1]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            known = self.pairs[at] == key
            rank[inner[known]], after[inner[known]] = self.ranks[at[known]], self.merged[at[known]]
        return rank, after

    def decode(self, tokens: np.ndarray) -> bytes:
        """The bytes that the tokens spell."""
        sizes = self.spells[tokens + 1] - self.spells[tokens]
        return self.spelled[spread(self.spells[tokens], sizes)].tobytes()


def spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The positions of all ranges [start, start + size) in a row."""
    total = int(sizes.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


@dataclass(frozen=True)
class PreTokens:
    """Pre-tokens of texts in a row: their bytes, where they start and how long they are."""

    raw: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    texts: np.ndarray  # offset of each text's first pre-token
    special: np.ndarray  # the token of a special string, otherwise -1

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each one's bytes."""
        found, at = [np.zeros(0, np.uint64)], 0
        while at < len(self.starts):
            low = self.starts[at]
            to = max(int(np.searchsorted(self.starts, low + _HASHED_BYTES)), at + 1)
            high = self.starts[to] if to < len(self.starts) else len(self.raw)
            found.append(run_hashes(_BYTE_VALUES[self.raw[low:high]], self.starts[at:to] - low))
            at = to
        return np.concatenate(found)

    def only(self, which: np.ndarray) -> PreTokens:
        """Some of them, without their texts."""
        return PreTokens(self.raw, self.starts[which], self.sizes[which], self.texts[:0], self.special[which])

    def bytes_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.raw[spread(self.starts[which], self.sizes[which])], self.sizes[which]


class WordTokens:
    """The tokens of the pre-tokens met so far, at most ``most`` of them: beyond that it starts anew.

    A task's working memory, not a limit on results: a forgotten word is merged again when it returns. Words are known
    by their 64-bit hashes.
    """

    def __init__(self, vocabulary: Vocabulary, most: int = 1_000_000):
        self.vocabulary, self.most = vocabulary, most
        self._clear()

    def _clear(self) -> None:
        self.known = np.zeros(0, np.uint64)
        self.place = np.zeros(0, np.int64)
        self.tokens = np.zeros(0, np.int32)
        self.offsets = np.zeros(1, np.int64)

    def of(self, words: PreTokens, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each pre-token's tokens start in ``tokens`` and how many there are."""
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > self.most:
            self._clear()
        at = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), bool)
        inside = at < len(self.known)
        new[inside] = self.known[at[inside]] != distinct[inside]
        if new.any():
            tokens, offsets = self.vocabulary.merge_flat(*words.bytes_of(first[new]))
            self.known = np.insert(self.known, at[new], distinct[new])
            self.place = np.insert(self.place, at[new], np.arange(len(offsets) - 1) + len(self.offsets) - 1)
            self.offsets = np.concatenate([self.offsets, offsets[1:] + len(self.tokens)])
            self.tokens = np.concatenate([self.tokens, tokens.astype(np.int32)])
        place = self.place[np.searchsorted(self.known, distinct)]
        return self.offsets[place][back], (self.offsets[place + 1] - self.offsets[place])[back]
