"""Sets of word shingles as sorted 64-bit hashes, vectorised per text."""

from __future__ import annotations

import hashlib

import numpy as np

_RANDOM = np.random.default_rng(20240607)
_BYTES = _RANDOM.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = int(_RANDOM.integers(0, 2**62)) * 4 + 3  # odd: has an inverse modulo 2**64
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, n of each at least."""
    if len(_powers[0]) < n:
        size = 1 << n.bit_length()
        for i, b in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            factors = np.full(size, b, np.uint64)
            factors[0] = 1
            _powers[i] = np.cumprod(factors, dtype=np.uint64)
    return _powers[0], _powers[1]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, k: int) -> np.ndarray:
    """Distinct hashes of the ``k``-word shingles of a UTF-8 text, ascending as
    signed numbers; words are runs without ASCII white space, A-Z lower-cased.
    Fewer words than ``k`` make one shingle, none make none.

    A shingle's hash is that of its words joined by one blank: a polynomial over
    its bytes modulo 2**64, as a difference of prefix sums, then mixed."""
    words = (text or b"").lower().split()
    if not words:
        return np.empty(0, np.int64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    power, inverse = _power_tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * power[:len(data)], dtype=np.uint64, out=sums[1:])
    blank = np.flatnonzero(data == 32)
    starts, ends = np.append(0, blank + 1), np.append(blank, len(data))
    if len(words) < k:
        starts, ends = starts[:1], ends[-1:]
    else:
        starts, ends = starts[:len(words) - k + 1], ends[k - 1:]
    hashes = (sums[ends] - sums[starts]) * inverse[starts]
    return np.unique(_mix(hashes + (ends - starts).astype(np.uint64)).view(np.int64))


def set_digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def odd_sketch(hashes: np.ndarray) -> bytes:
    """Parities of how many hashes fall on each of a power of two of bits, at least
    twice as many as there are hashes."""
    bits = 1 << max(6, len(hashes).bit_length() + 1)
    places = (_mix(hashes.view(np.uint64) ^ np.uint64(0x51ED27)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=bits) & 1, bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference of two sets, from their odd sketches:
    a parity can differ only where an element is in one set alone."""
    a, b = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    size_a, size_b = 8 * len(x), 8 * len(y)
    while size_a != size_b:  # the larger one folds onto its lower half
        if size_a > size_b:
            size_a //= 2
            a = (a >> size_a) ^ (a & ((1 << size_a) - 1))
        else:
            size_b //= 2
            b = (b >> size_b) ^ (b & ((1 << size_b) - 1))
    return (a ^ b).bit_count()
