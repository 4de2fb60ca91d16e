"""Arrow text columns as numpy bytes, 64-bit hashing of byte ranges, and bounded working blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18
#: Odd multiplier of the polynomial byte hash and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15 | 1
BASE_INV = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def blocks(off: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows that hold at most ``limit`` bytes together; a longer row stands alone, whole."""
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (a bijection with full avalanche)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[str, np.ndarray] = {}


def powers(n: int, base: int, name: str) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 4096)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[name] = have
        if size > 16 * BLOCK_BYTES:  # tables of a giant text aren't kept
            _POWERS.pop(name)
    return have[:n]


PRIME = np.uint64((1 << 31) - 1)
PRIME_BASE = 1_220_703_125


def prime_powers(n: int, base: int, name: str) -> np.ndarray:
    """``base ** i`` modulo ``PRIME``, by doubling."""
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 4096)
        have = np.ones(1, np.uint64)
        while len(have) < size:
            have = np.concatenate([have, have * np.uint64(pow(base, len(have), int(PRIME))) % PRIME])
        if size <= 16 * BLOCK_BYTES:  # tables of a giant text aren't kept
            _POWERS[name] = have
    return have[:n]


class RangeHash:
    """Hashes of byte ranges of one buffer in constant time each: equal bytes, equal hash, wherever they stand.

    Two polynomials, modulo 2**64 and modulo the prime 2**31 - 1, are mixed: texts
    built to collide under the first (such as Thue-Morse words) don't under the
    second. Different ranges have equal hashes with probability 2**-64.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        one = data.astype(np.uint64) + np.uint64(1)
        np.cumsum(one * powers(n, BASE, "up"), out=self.sums[1:])
        self.down = powers(n + 1, BASE_INV, "down")
        # sums of n numbers under 2**31 * 257 stay under 2**63 up to 2**24 bytes; longer ones are reduced first
        terms = one * prime_powers(n, PRIME_BASE, "prime-up")
        self.prime_sums = np.zeros(n + 1, np.uint64)
        np.cumsum(terms if n < 1 << 24 else terms % PRIME, out=self.prime_sums[1:])
        self.prime_down = prime_powers(n + 1, pow(PRIME_BASE, -1, int(PRIME)), "prime-down")

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        rest = (self.prime_sums[end] - self.prime_sums[start]) % PRIME * self.prime_down[start] % PRIME
        return mix(mix(raw + rest * np.uint64(0x9FB21C651E98DF25)) + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


#: Everything of ASCII but letters and digits parts words; bytes of other characters are letters.
NOT_ALNUM = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, off: np.ndarray, breaks: np.ndarray = SPACE, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word (bytes that aren't ``breaks``), the row it is of and where in ``data`` it starts."""
    n = len(off) - 1
    buf = np.full(len(data) + n + 1, 32, np.uint8)  # a blank before each row parts it from the last
    row = np.repeat(np.arange(n), np.diff(off))
    buf[np.arange(len(data)) + row + 1] = LOWER[data] if lower else data
    solid = ~breaks[buf]
    edge = np.flatnonzero(solid[1:] != solid[:-1]) + 1
    start, end = edge[0::2], edge[1::2]
    of = np.searchsorted(off[:-1] + np.arange(n) + 1, start, "right") - 1
    return RangeHash(buf)(start, end), of, start - of - 1


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return word_spans(data, off)[:2]


def shingle_hashes(words: np.ndarray, row: np.ndarray, n_rows: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a row; a row with fewer words gives its whole sequence as one."""
    odd = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    count = np.bincount(row, minlength=n_rows)
    first = np.concatenate([[0], np.cumsum(count)])[:-1]
    k = len(words) - size + 1
    if k > 0:
        whole = row[: k] == row[size - 1 :]
        acc = np.zeros(k, np.uint64)
        for i in range(size):
            acc += words[i : i + k] * odd[i]
        full, full_row = mix(acc[whole]), row[:k][whole]
    else:
        full, full_row = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((count > 0) & (count < size))
    if len(short) == 0:
        return full, full_row
    extra = np.array([mix(np.array([sum(int(words[first[r] + i]) * int(odd[i]) for i in range(count[r])) + int(count[r]) & 0xFFFFFFFFFFFFFFFF], np.uint64) ^ np.uint64(0xA5A5A5A5A5A5A5A5))[0] for r in short], np.uint64)
    both, both_row = np.concatenate([full, extra]), np.concatenate([full_row, short])
    order = np.argsort(both_row, kind="stable")
    return both[order], both_row[order]
