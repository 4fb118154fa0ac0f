"""Words and lines of Arrow text columns as 64-bit hashes.

Works on the bytes of a batch with numpy, without a Python string per word: all word
classes used here are unions of byte ranges in UTF-8. Two different words share a hash
with a chance of about 2**-64.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Bytes worked on at a time, and rows in one part.
PART_BYTES = 1 << 20
PART_ROWS = 4096


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; a bijection."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def constants(n: int, seed: int) -> np.ndarray:
    """Odd pseudo-random numbers, the same on every machine."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) | np.uint64(1)


@dataclass(frozen=True)
class TokenClass:
    """Bytes that make a token, and what each byte counts in its hash."""

    member: np.ndarray
    weight: np.ndarray

    @staticmethod
    def of(outside: list[tuple[int, int]], lower: bool) -> "TokenClass":
        """Tokens are runs of bytes outside these ranges; ASCII letters lower-cased first."""
        seen = np.arange(256)
        if lower:
            seen[65:91] += 32
        member = np.ones(256, dtype=bool)
        for first, last in outside:
            member &= (seen < first) | (seen > last)
        return TokenClass(member, np.where(member, constants(256, 7)[seen], np.uint64(0)))


_SPACES = [(0x20, 0x20), (0x09, 0x0D)]
ALNUM_WORDS = TokenClass.of([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)], lower=True)
LOWER_WORDS = TokenClass.of(_SPACES, lower=True)
PLAIN_WORDS = TokenClass.of(_SPACES, lower=False)
LINES = TokenClass.of([(0x0A, 0x0A)], lower=False)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[int, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, PART_BYTES + 1)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size > PART_BYTES + 1:
            return have
        _powers[int(base)] = have
    return have


@dataclass
class Tokens:
    """Tokens of consecutive texts: those of text ``i`` are ``first[i]`` to ``first[i + 1]``.

    ``start`` and ``end`` are positions in the bytes that were given.
    """

    first: np.ndarray
    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray

    def row(self) -> np.ndarray:
        """Number of the text of each token."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def windows(self, size: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
        """First tokens of all windows of ``size`` tokens within a text, and their hashes."""
        count = len(self.hash) - size + 1
        if count <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        factors = constants(size, seed)
        h = self.hash[:count] * factors[0]
        for j in range(1, size):
            h += self.hash[j : count + j] * factors[j]
        whole = np.ones(count, dtype=bool)
        ends = self.first[1:]
        for back in range(1, size):
            at = ends - back
            whole[at[(at >= 0) & (at < count)]] = False
        at = np.flatnonzero(whole)
        return at, mixed(h[at])


def _spans(data: np.ndarray, cuts: np.ndarray, kind: TokenClass) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of tokens; no token goes over a cut."""
    member = kind.member[data]
    before = np.empty_like(member)
    before[0] = False
    before[1:] = member[:-1]
    inner = cuts[cuts < len(data)]
    before[inner] = False
    start = np.flatnonzero(member & ~before)
    after = np.empty_like(member)
    after[-1] = False
    after[:-1] = member[1:]
    after[inner[inner > 0] - 1] = False
    return start, np.flatnonzero(member & ~after) + 1


def tokens(data: np.ndarray, offsets: np.ndarray, kind: TokenClass) -> Tokens:
    """Tokens of the texts ``data[offsets[i]:offsets[i + 1]]``.

    Long input is hashed piece by piece, so that only the tokens and one piece are held.
    """
    starts, ends, hashes = [], [], []
    at, stop = int(offsets[0]), int(offsets[-1])
    while at < stop:
        until = min(stop, at + PART_BYTES)
        while until < stop:  # back to the end of a token, or on if it has no end here
            other = np.flatnonzero(~kind.member[data[max(at, until - 65536) : until]])
            if len(other):
                until = max(at, until - 65536) + int(other[-1]) + 1
                break
            until = min(stop, until + PART_BYTES)
        piece = data[at:until]
        cuts = offsets[(offsets >= at) & (offsets < until)] - at
        start, end = _spans(piece, cuts, kind)
        if len(start):
            value = kind.weight[piece] * _power(_BASE, len(piece))[: len(piece)]
            h = np.add.reduceat(value, start) * _power(_INVERSE, len(piece))[start]
            starts.append(start + at)
            ends.append(end + at)
            hashes.append(mixed(h + (end - start).astype(np.uint64) * _BASE))
        at = until
    none = np.zeros(0, dtype=np.int64)
    start = np.concatenate(starts) if starts else none
    end = np.concatenate(ends) if ends else none
    h = np.concatenate(hashes) if hashes else np.zeros(0, dtype=np.uint64)
    return Tokens(np.searchsorted(start, offsets), h, start, end)


@dataclass
class Part:
    """Some rows of a batch: ``data[offsets[i]:offsets[i + 1]]`` is text ``row + i``."""

    row: int
    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def tokens(self, kind: TokenClass) -> Tokens:
        return tokens(self.data, self.offsets, kind)

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i] : self.offsets[i + 1]].tobytes()

    def count(self, table: np.ndarray) -> np.ndarray:
        """Sum over each text of a small number for every byte."""
        sums = np.zeros(len(self), dtype=np.int64)
        full = np.flatnonzero(np.diff(self.offsets))
        if len(full):
            body = table[self.data[self.offsets[0] : self.offsets[-1]]]
            begin = self.offsets[full] - self.offsets[0]
            sums[full] = np.add.reduceat(body, begin, dtype=np.int64)
        return sums


def parts(texts: pa.Array, rows: int = PART_ROWS) -> Iterator[Part]:
    """A text column in parts of about ``PART_BYTES``; a longer text is a part of its own.

    A null text is empty.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    if not len(texts):
        return
    _, ends, values = texts.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(values or b"", dtype=np.uint8)
    at = 0
    while at < len(texts):
        until = int(np.searchsorted(offsets, offsets[at] + PART_BYTES, side="right")) - 1
        until = min(max(until, at + 1), at + rows, len(texts))
        low = offsets[at]
        yield Part(at, data[low : offsets[until]], offsets[at : until + 1] - low)
        at = until


def lowered(data: bytes) -> bytes:
    """A-Z lower-cased."""
    return data.lower()
