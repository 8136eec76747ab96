"""64-bit hashes of words, of shingles and of substrings of many texts, with numpy."""

from __future__ import annotations

import numpy as np
import xxhash

_R = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_RINV = np.uint64(pow(int(_R), -1, 1 << 64))
_BYTE = np.random.default_rng(41).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LONG = 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}
#: A prime modulus: its polynomial hashes have no pairs that are equal for every base, as those modulo 2**64 have.
PRIME = 2147483647
_BASE = 1160428697
_prime_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """r**i and r**-i for i < n."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _powers:
        _powers.clear()
        up, down = np.full(size, _R), np.full(size, _RINV)
        up[0] = down[0] = 1
        _powers[size] = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
    return _powers[size]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """h with h[i] the sum of the first i bytes' hashes times r**place."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def substring_hashes(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    return mix((sums[stop] - sums[start]) * powers(len(sums))[1][start] + (stop - start).astype(np.uint64))


def prime_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo PRIME for i < n, each from those of half the length."""
    size = 1 << max(16, (n - 1).bit_length())
    if size not in _prime_powers:
        _prime_powers.clear()
        both = []
        for base in (_BASE, pow(_BASE, -1, PRIME)):
            out = np.ones(1, dtype=np.uint64)
            while len(out) < size:
                out = np.concatenate([out, out * np.uint64(pow(base, len(out), PRIME)) % np.uint64(PRIME)])
            both.append(out)
        _prime_powers[size] = tuple(both)
    return _prime_powers[size]


def prime_sums(data: np.ndarray) -> np.ndarray:
    """As prefix_sums, modulo PRIME; for fewer than 2**32 bytes no sum overflows."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * prime_powers(len(data) + 1)[0][: len(data)] % np.uint64(PRIME), out=out[1:])
    return out


def prime_hashes(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Of substrings, under PRIME."""
    return (sums[stop] - sums[start]) % np.uint64(PRIME) * prime_powers(len(sums))[1][start] % np.uint64(PRIME)


def word_hashes(text: bytes, piece: int = 1_000_000) -> np.ndarray:
    """Of each word between ASCII white space, A-Z as a-z, in order.

    Words of over LONG bytes, where a polynomial modulo 2**64 has equal pairs for every base, go through xxhash.
    """
    text = text.translate(_LOWER)
    out, at = [], 0
    while at < len(text):
        end = min(at + piece, len(text))
        while end < len(text) and not _SPACE[text[end]]:  # up to the next white space
            end += 1
        data = np.frombuffer(text, dtype=np.uint8, count=end - at, offset=at)
        edge = np.flatnonzero(np.diff(np.r_[True, _SPACE[data], True].view(np.int8)))
        start, stop = edge[::2], edge[1::2]
        found = substring_hashes(prefix_sums(data), start, stop)
        for i in np.flatnonzero(stop - start > LONG):
            found[i] = xxhash.xxh64_intdigest(text[at + start[i] : at + stop[i]])
        out.append(found)
        at = end
    return np.concatenate(out) if len(out) > 1 else out[0] if out else np.zeros(0, dtype=np.uint64)


def many_word_hashes(texts: list[str | None]) -> list[np.ndarray]:
    """word_hashes of each text; short texts are hashed together."""
    raw = [(t or "").encode() for t in texts]
    if sum(map(len, raw)) > 2_000_000:
        return [word_hashes(r) for r in raw]
    joined = word_hashes(b" ".join(raw), 1 << 62)
    counts = np.array([len(r.split()) for r in raw], dtype=np.int64)
    return np.split(joined, np.cumsum(counts)[:-1]) if raw else []


def shingle_set(ws: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of runs of size words; of the whole, if there are fewer."""
    if not len(ws):
        return ws
    size, h = min(size, len(ws)), None
    for k in range(size):
        part = ws[k : len(ws) - size + 1 + k]
        h = part.copy() if h is None else h * np.uint64(0x2545F4914F6CDD1D) + part
    h = mix(h + np.uint64(size))
    h.sort()
    new = np.ones(len(h), dtype=bool)
    np.not_equal(h[1:], h[:-1], out=new[1:])
    return h if new.all() else h[new]
