"""Vectorised byte-level text primitives shared by the operators of this subpackage.

Every helper works on one flat ``uint8`` buffer with document offsets, so that a block of
documents costs a few numpy passes and no Python loop over bytes or words.  Blocks are bounded
in bytes, never in content: a document longer than the bound is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 1 << 19

#: Lower-cases A-Z and leaves every other byte alone.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes that separate words: space and 0x09-0x0D.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    if not pa.types.is_large_string(column.type) and not pa.types.is_large_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[off[0] : off[-1]], off - off[0]


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold about ``limit`` bytes; at least one row each."""
    n, at = len(offsets) - 1, 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end
        at = end


def fmix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (murmur3's constants), in place."""
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


class Rolling:
    """Polynomial fingerprints modulo 2**64 of any byte range of a buffer, from prefix sums.

    Bytes are first mapped to random odd 64-bit values, so the fingerprint of a range depends
    only on its bytes.  ``of(start, end)`` is vectorised; results pass through ``fmix``.
    """

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 1):
        rng = np.random.default_rng(seed)
        table = rng.integers(0, 2**63, 256, dtype=np.uint64) * U64(2) + U64(1)
        base = int(rng.integers(2**40, 2**62)) * 8 + 5
        power, self.inverse = self._power(seed, base, len(data) + 1)
        self.sums = np.empty(len(data) + 1, U64)
        self.sums[0] = 0
        terms = table[data]
        terms *= power[: len(data)]
        np.cumsum(terms, out=self.sums[1:])

    @classmethod
    def _power(cls, seed: int, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(seed)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            size = 1 << (size - 1).bit_length()
            made = []
            for b in (base, pow(base, -1, 2**64)):
                p = np.empty(size, U64)
                p[0] = 1
                done = 1
                while done < size:
                    step = min(done, size - done)
                    np.multiply(p[:step], U64(pow(b, done, 2**64)), out=p[done : done + step])
                    done += step
                made.append(p)
            have = cls._powers[seed] = (made[0], made[1])
        return have

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = self.sums[end] - self.sums[start]
        out *= self.inverse[start]
        return fmix(out)

    def grams(self, k: int) -> np.ndarray:
        """Fingerprints of all ranges of k bytes."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, U64)
        out = self.sums[k:] - self.sums[:n]
        out *= self.inverse[:n]
        return fmix(out)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of each maximal run of bytes other than space and 0x09-0x0D; no word spans two rows."""
    solid = ~SPACE[data]
    if len(data) == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    before = np.empty_like(solid)
    before[0] = False
    before[1:] = solid[:-1]
    cut = offsets[:-1]
    before[cut[cut < len(data)]] = False
    start = np.flatnonzero(solid & ~before)
    after = np.empty_like(solid)
    after[-1] = False
    after[:-1] = solid[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    end = np.flatnonzero(solid & ~after) + 1
    row = np.searchsorted(offsets, start, side="right") - 1
    return start, end, row


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """For each start s, the position of the leftmost smallest of values[s : s + width].

    The order uses the upper bits of the value and then the position, packed in one word, so it
    is a function of the window's content alone.  Two running minima over blocks of ``width``
    give all windows in three passes.
    """
    n = len(values)
    if n < width:
        return np.zeros(0, np.int64)
    bits = max(1, int(n - 1).bit_length())
    low = U64((1 << bits) - 1)
    packed = (values & ~low) | np.arange(n, dtype=U64)
    size = -(-n // width) * width
    padded = np.full(size, U64(2**64 - 1))
    padded[:n] = packed
    grid = padded.reshape(-1, width)
    forward = np.minimum.accumulate(grid, axis=1).ravel()
    backward = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(backward[: n - width + 1], forward[width - 1 : n])
    return (least & low).astype(np.int64)
