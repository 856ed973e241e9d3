"""Words of whole texts as 64-bit hashes, a batch at a time."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from plumbline.llm.arrow import chunks

#: Bytes of a piece of a long text.
PIECE = 1 << 20

_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_CODES = np.random.default_rng(20240229).integers(0, 1 << 64, 256, dtype=np.uint64) | np.uint64(1)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@dataclass
class Words:
    """Words of some texts: word ``i`` is ``data[starts[i]:ends[i]]``, text ``t`` owns
    words ``first[t]`` to ``first[t + 1]``."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray


class Powers:
    """Powers of the base of the hash and of its inverse; the tables grow with the longest input."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 18)
            table = []
            for base in (_BASE, _INVERSE):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                table.append(np.cumprod(steps, dtype=np.uint64))
            self.up, self.down = table
        return self.up, self.down


def words(texts: list[bytes | None], powers: Powers, blank: np.ndarray = _BLANK) -> Words:
    """Words between ASCII white space, or between the bytes that ``blank`` marks; it must mark the
    line feed. A-Z count as a-z, other characters as they are.

    The hash of a word is a polynomial over random codes of its bytes, so all words of a batch
    come from one running sum.
    """
    joined = b"\n".join(t or b"" for t in texts) + b"\n"
    data = _LOWER[np.frombuffer(joined, dtype=np.uint8)]
    edges = np.flatnonzero(np.diff(blank[data], prepend=True))
    starts, ends = edges[::2], edges[1::2]
    up, down = powers.upto(len(data) + 1)
    running = np.empty(len(data) + 1, dtype=np.uint64)
    running[0] = 0
    np.cumsum(_CODES[data] * up[: len(data)], out=running[1:])
    hashes = mixed((running[ends] - running[starts]) * down[starts])
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t or b"") + 1 for t in texts], out=bounds[1:])
    return Words(data, starts, ends, hashes, np.searchsorted(starts, bounds))


def hashes(texts: list[bytes | None], powers: Powers, blank: np.ndarray = _BLANK) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and where each text's begin; one long text is read in pieces cut between words,
    so that it costs 8 bytes a word and one piece."""
    if len(texts) == 1 and len(texts[0] or b"") > PIECE:
        found = np.concatenate([words([piece], powers, blank).hashes for piece in cut(texts[0], blank)])
        return found, np.array([0, len(found)])
    found = words(texts, powers, blank)
    return found.hashes, found.first


def parts(texts: list[bytes | None], most: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of texts that fit the processor's cache together; a longer text is alone."""
    return chunks([len(t or b"") for t in texts], most)


def cut(text: bytes, blank: np.ndarray = _BLANK, most: int = PIECE) -> Iterator[bytes]:
    """A long text in pieces of about ``most`` bytes that end between words; a longer word is whole."""
    start = 0
    while len(text) - start > most:
        stop = start + most
        while stop < len(text):
            window = np.frombuffer(text, np.uint8, min(1 << 16, len(text) - stop), stop)
            blanks = blank[window]
            if blanks.any():
                stop += int(np.argmax(blanks))
                break
            stop += len(window)
        yield text[start:stop]
        start = stop
    yield text[start:]
