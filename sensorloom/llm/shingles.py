"""Word shingles of whole texts as 64-bit hashes, taken from the UTF-8 bytes with numpy."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Words in a shingle. A text with fewer words is one shingle.
WORDS = 5
#: Bytes hashed at a time.
CHUNK = 1 << 19
#: Bytes from which a word has a cryptographic hash.
LONG_WORD = 256
_BASE = 0x9E3779B97F4A7C15
_WRAP = 1 << 64


def mixed(x: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix; spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of the rolling hash's base and their inverses modulo 2**64, as far as needed."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n >= len(self.up):
            size = max(n + 1, CHUNK + 1)
            steps = np.full(size, _BASE, np.uint64), np.full(size, pow(_BASE, -1, _WRAP), np.uint64)
            for step in steps:
                step[0] = 1
            self.up, self.down = (np.multiply.accumulate(step) for step in steps)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Running sums ``p`` such that ``(p[j] - p[i]) * down[i]`` hashes ``values[i:j]``."""
        self.reach(len(values))
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values.astype(np.uint64) * self.up[: len(values)], out=sums[1:])
        return sums


@functools.cache
def shared_powers() -> Powers:
    """One table of powers for all small groups that a worker handles one after the other."""
    return Powers()


def _is_space(data: np.ndarray) -> np.ndarray:
    return (data == 32) | ((data >= 9) & (data <= 13))


def word_hashes(data: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of the words in the bytes of one text, in order."""
    parts, at = [], 0
    while at < len(data):
        end = min(at + CHUNK, len(data))
        if end < len(data):  # cut a long text between two words
            spaces = np.flatnonzero(_is_space(data[at:end]))
            while not len(spaces) and end < len(data):
                end = min(end + CHUNK, len(data))
                spaces = np.flatnonzero(_is_space(data[at:end]))
            end = end if end == len(data) or not len(spaces) else at + int(spaces[-1]) + 1
        piece = data[at:end]
        edge = np.diff(np.concatenate(([0], (~_is_space(piece)).view(np.int8), [0])))
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = powers.prefix(piece + np.uint8(1))
        made = mixed((sums[ends] - sums[starts]) * powers.down[starts])
        # Of very long words the polynomial has known equal pairs.
        for i in np.flatnonzero(ends - starts >= LONG_WORD):
            made[i] = int.from_bytes(hashlib.blake2b(piece[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
        parts.append(made)
        at = end
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def shingle_hashes(words: np.ndarray, n: int = WORDS) -> np.ndarray:
    """Hashes of all runs of ``n`` words; of all words together if there are fewer."""
    if not len(words):
        return words
    n = min(n, len(words))
    out = words[: len(words) - n + 1].copy()
    for k in range(1, n):
        out = mixed(out * np.uint64(_BASE) + words[k : len(words) - n + 1 + k])
    return out


def texts_as_bytes(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of each text of a string column, without copying; null counts as empty."""
    offsets_at, data_at = column.buffers()[1:]
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(offsets_at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data_at, np.uint8) if data_at else np.zeros(0, np.uint8)
    valid = column.is_valid().to_numpy(zero_copy_only=False)
    for i in range(len(column)):
        yield data[offsets[i] : offsets[i + 1]] if valid[i] else data[:0]
