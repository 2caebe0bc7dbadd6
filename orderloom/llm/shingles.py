"""Hashed word shingles of a batch of texts, in numpy.

Words are runs of other characters than blank and U+0009 to U+000D. A shingle is five
words in a row; a text of one to four words is a single shingle, and one without words
has none. Hashes have 64 bits and depend on nothing but the words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

WORDS = 5
# Texts are hashed in groups of about so many bytes, which bounds the working arrays.
GROUP_BYTES = 1 << 20

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
_BYTES = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


class _Powers:
    """Powers of the multiplier and of its inverse, as far as a batch needs them."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) < n:
            self.up = np.full(n, _MULTIPLIER)
            self.down = np.full(n, np.uint64(_inverse(int(_MULTIPLIER))))
            self.up[0] = self.down[0] = 1
            np.multiply.accumulate(self.up, out=self.up)
            np.multiply.accumulate(self.down, out=self.down)


_powers = _Powers()


def groups(texts: Sequence[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first text, UTF-8 texts) of consecutive groups of bounded size."""
    first, held, size = 0, [], 0
    for i, text in enumerate(texts):
        data = (text or "").encode()
        if held and size + len(data) > GROUP_BYTES:
            yield first, held
            first, held, size = i, [], 0
        held.append(data)
        size += len(data)
    if held:
        yield first, held


def word_hashes(data: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the number of the text it is in, in order."""
    joined = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    space = (joined == 32) | ((joined >= 9) & (joined <= 13))
    edges = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edges[::2], edges[1::2]
    _powers.reach(len(joined) + 1)
    sums = np.zeros(len(joined) + 1, np.uint64)
    np.cumsum(_BYTES[joined] * _powers.up[: len(joined)], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * _powers.down[starts])
    text_ends = np.cumsum([len(d) + 1 for d in data])
    return hashes, np.searchsorted(text_ends, starts, "right")


def shingle_sets(data: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count), sorted and distinct, of all texts of a group."""
    words, owner = word_hashes(data)
    padded = np.concatenate([words, np.zeros(WORDS, np.uint64)])
    last = np.concatenate([owner, np.full(WORDS, -1)])
    total = np.zeros(len(words), np.uint64)
    for k in range(WORDS):
        # beyond the end of its text a word counts as none
        inside = last[k : k + len(words)] == owner
        total = total * np.uint64(0xD6E8FEB86659FD93) + np.where(inside, padded[k : k + len(words)], np.uint64(k + 1))
    first_of_text = np.diff(owner, prepend=-1) != 0
    whole = (last[WORDS - 1 : WORDS - 1 + len(words)] == owner) | first_of_text
    owner, hashes = owner[whole], mix(total[whole])
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    at = np.flatnonzero(new)
    return owner[at], hashes[at], np.diff(np.append(at, len(owner)))
