"""Whole batches of UTF-8 texts as arrays of word hashes (numpy, inside tasks)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LOWER_TABLE = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True
#: bytes outside [0-9a-z] and outside multi-byte characters (after lower-casing)
NON_ALNUM = np.array([b < 128 and not (48 <= b <= 57 or 97 <= b <= 122) for b in range(256)])
SEGMENT = 1 << 22

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
BYTE_VALUES = np.random.Generator(np.random.PCG64(7)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values (a bijection)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first ``n`` powers of the polynomial's base, or of its inverse."""
    p = np.full(n, _INVERSE if inverse else _BASE, np.uint64)
    p[:1] = 1
    return np.multiply.accumulate(p)


#: a prime; the second polynomial's base and byte values below it
PRIME = np.uint64((1 << 31) - 1)
_BASE2 = 1_103_515_245
_SMALL = np.random.Generator(np.random.PCG64(11)).integers(1, int(PRIME), 256, dtype=np.uint64)


def _reduce(x: np.ndarray) -> np.ndarray:
    """Values below 2^62 modulo ``PRIME``, or the prime itself for zero."""
    x = (x & PRIME) + (x >> np.uint64(31))
    return (x & PRIME) + (x >> np.uint64(31))


def prime_powers(n: int, base: int) -> np.ndarray:
    """The first ``n`` powers of ``base`` modulo ``PRIME``."""
    p, done = np.ones(max(n, 1), np.uint64), 1
    while done < n:
        k = min(done, n - done)
        p[done:done + k] = p[:k] * np.uint64(pow(base, done, int(PRIME))) % PRIME
        done += k
    return p[:n]


class WordHasher:
    """64-bit hashes of the words between separator bytes. A word's hash mixes
    two polynomials over its bytes, one modulo 2^64 and one modulo a prime:
    words made to collide in the first (it cannot tell some regular sequences
    apart, whatever its base) differ in the second. Each is the difference of
    two prefix sums."""

    def __init__(self, separators: np.ndarray, lower: bool = True, prefixes: tuple[int, ...] = ()):
        """``prefixes``: also hash the words' first so many bytes (whole shorter words)."""
        self.separators, self.lower, self.prefixes = separators, lower, prefixes
        self.up = self.down = np.zeros(0, np.uint64)

    def _segment(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        if len(a) > len(self.up):
            self.up, self.down = powers(len(a)), powers(len(a), inverse=True)
            self.up2, self.down2 = (prime_powers(len(a), b) for b in (_BASE2, pow(_BASE2, -1, int(PRIME))))
        sep = self.separators[a]
        edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
        edge = np.concatenate([[0] if not sep[0] else [], edge, [len(a)] if not sep[-1] else []]).astype(np.int64)
        start, end = edge[::2], edge[1::2]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(BYTE_VALUES[a] * self.up[:len(a)], dtype=np.uint64)])
        # up to 2^31 places of values up to 2^31: the sums are exact
        total2 = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_reduce(_SMALL[a] * self.up2[:len(a)]), dtype=np.uint64)])
        out = []
        for n in (None, *self.prefixes):
            stop = end if n is None else np.minimum(end, start + n)
            # the length tells a whole word from the same letters that begin a longer one
            size = (end - start if n is None else np.minimum(end - start, n + 1)).astype(np.uint64)
            second = (total2[stop] - total2[start]) % PRIME * self.down2[start] % PRIME
            out.append(mix((total[stop] - total[start]) * self.down[start] + size + mix(second)))
        return start, end, out

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of all words in order, first word of each text and the total)."""
        hashes, first = self.levels(texts)
        return hashes[0], first

    def levels(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray]:
        """As a call, with the hashes of whole words and of each prefix length.
        Leaves the joined ``text`` and where its words ``start`` and ``end``."""
        joined = b"\n".join([*texts, b""])
        if self.lower:
            joined = joined.translate(LOWER_TABLE)
        a = np.frombuffer(joined, np.uint8)
        starts, ends, hashes, at = [], [], [], 0
        while at < len(a):
            end = min(at + SEGMENT, len(a))
            while end < len(a):  # cut between words
                gap = np.flatnonzero(self.separators[a[end:end + SEGMENT]])
                end = end + int(gap[0]) if len(gap) else min(end + SEGMENT, len(a))
                if len(gap):
                    break
            s, e, h = self._segment(a[at:end])
            starts.append(s + at)
            ends.append(e + at)
            hashes.append(h)
            at = end
        first = np.cumsum([0, *(len(t) + 1 for t in texts)])
        where = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        self.text, self.start, self.end = a, where, np.concatenate(ends) if ends else where
        return [np.concatenate(h) for h in zip(*hashes)] or [where.astype(np.uint64)] * (1 + len(self.prefixes)), np.searchsorted(where, first)


def shingle_sets(words: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per text its sorted distinct ``k``-word shingles; of fewer words, the
    whole sequence is one; of none, there is none."""
    factor = mix(np.arange(1, k + 2, dtype=np.uint64))
    n = max(len(words) - k + 1, 0)
    rolled = mix(sum((words[i:i + n] * factor[i] for i in range(1, k)), words[:n] * factor[0])) if n else words[:0]
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= k:
            yield np.unique(rolled[a:b - k + 1])
        elif b > a:
            part = words[a:b] * factor[:b - a]
            yield mix(part.sum(dtype=np.uint64, keepdims=True) + factor[k:] * np.uint64(b - a))
        else:
            yield words[:0]


def groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first ``keys`` columns, across batch borders.
    The input must be sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        change = np.zeros(batch.num_rows, bool)
        for c in range(keys):
            v = batch.column(c).to_numpy(zero_copy_only=False)
            change[1:] |= v[1:] != v[:-1]
        edges = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(edges[:-1], edges[1:]):
            part = batch.slice(a, b - a)
            key = tuple(part.column(c)[0].as_py() for c in range(keys))
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(part)
            last = key
    if held:
        yield pa.Table.from_batches(held)
