"""Words, shingles and lines of a batch of texts as arrays of code points, with hashes of any stretch at once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Code points that are put into one array at a time; a longer text is an array of its own.
CHUNK = 100_000

U = np.uint64
RADIX, SHIFT = 0x9E3779B97F4A7C15, U(32)
INVERSE = pow(RADIX, -1, 2**64)
MIX = U(0xBF58476D1CE4E5B9)
#: Odd factors of the words of a shingle.
FACTORS = np.array([pow(0xD6E8FEB86659FD93, i + 1, 2**64) for i in range(16)], dtype=U)

_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of x."""
    x = (x ^ (x >> SHIFT)) * MIX
    x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
    return x ^ (x >> SHIFT)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """RADIX**i and its inverse modulo 2**64 for i up to n."""
    if len(_powers[0]) <= n:
        for k, r in enumerate((RADIX, INVERSE)):
            p = np.empty(n + CHUNK, U)
            p[0] = 1
            have = 1
            while have < len(p):
                more = min(have, len(p) - have)
                p[have : have + more] = p[:more] * U(pow(r, have, 2**64))
                have += more
            _powers[k] = p
    return _powers[0], _powers[1]


class Hasher:
    """Polynomial hashes of all stretches of one array of code points."""

    def __init__(self, points: np.ndarray):
        up, self.down = powers(len(points))
        value = mixed(points.astype(U) + U(0x632BE59BD9B4E019))
        self.sums = np.zeros(len(points) + 1, U)
        np.cumsum(value * up[: len(points)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]


def blank(points: np.ndarray) -> np.ndarray:
    return (points == 32) | ((points >= 9) & (points <= 13))


def lower(points: np.ndarray) -> np.ndarray:
    """A-Z lowered, all else as it is."""
    return points + 32 * ((points >= 65) & (points <= 90)).astype(np.uint32)


def groups(texts: Iterable[str | None], chunk: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    """(number of the first text, texts) whose lengths sum to `chunk` or that are one longer text; None counts as ''."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        t = t or ""
        if held and size + len(t) > chunk:
            yield first, held
            first, held, size = i, [], 0
        held.append(t)
        size += len(t) + 1
    if held:
        yield first, held


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def word_bounds(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of an array."""
    apart = np.ones(len(points) + 2, bool)
    apart[1:-1] = blank(points)
    edges = np.flatnonzero(apart[1:] != apart[:-1])
    return edges[::2], edges[1::2]


def shingle_sets(texts: list[str | None], width: int = 5) -> Iterator[np.ndarray]:
    """For every text the sorted distinct hashes of its shingles of `width` words, A-Z lowered.

    A text with fewer words has one, of all its words; a text without a word has none.
    """
    for _, held in groups(texts):
        points = lower(code_points("\n".join(held)))
        starts, ends = word_bounds(points)
        words = mixed(Hasher(points)(starts, ends) + (ends - starts).astype(U))
        size = np.fromiter((len(t) + 1 for t in held), np.int64, len(held))
        cuts = np.searchsorted(starts, np.concatenate(([0], np.cumsum(size))))
        n = max(0, len(words) - width + 1)
        rows = np.zeros(n, U)
        for k in range(width):
            rows += words[k : k + n] * FACTORS[k]
        rows = mixed(rows)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            if b - a >= width:
                yield np.unique(rows[a : b - width + 1])
            elif b > a:
                yield mixed((words[a:b] * FACTORS[: b - a]).sum(dtype=U, keepdims=True) + U(b - a))
            else:
                yield np.empty(0, U)


def set_id(shingles: np.ndarray) -> bytes:
    """128 bits that stand for a whole set."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def by_bytes(batches: Iterable[pa.RecordBatch], column: str, limit: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about `limit` bytes of that column, so that long texts do not pile up."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        each = max(1, int(n * limit / max(1, batch.column(column).nbytes)))
        for at in range(0, n, each):
            yield batch.slice(at, each)
