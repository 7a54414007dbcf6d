"""Vectorised text helpers for Arrow batches: words, hashes, n-grams. Numpy only, no Spark."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text that a step works on at once; a longer single text makes a step of its own.
STEP_BYTES = 1 << 20

#: Bytes of input after which a task gives freed memory back.
TRIM_BYTES = 8 << 20
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def give_back() -> None:
    """Return memory that the allocators hold but nothing uses to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def lean(run: Callable) -> Callable:
    """A mapInArrow function that gives freed memory back as it goes and at its end.

    Workers live on from stage to stage, and without this each keeps what its hungriest batch needed.
    """

    def out(batches):
        def fed():
            held = 0
            for b in batches:
                held += b.nbytes
                yield b
                if held >= TRIM_BYTES:
                    give_back()
                    held = 0

        yield from run(fed())
        give_back()

    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32

_ODD = np.uint64(0xD6E8FEB86659FD93)
#: Starting values of the two hash lanes; together they make 128 bits.
LANES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
#: Low bytes of a word that are kept.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Strings of more bytes are hashed one by one, so that a long one doesn't make a pass over all for each eight bytes.
LONG = 64


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, n+1 offsets into them) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def steps(offsets: np.ndarray, most: int = STEP_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most ``most`` bytes each; one longer text stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def slices(batch: pa.RecordBatch, column: str, most: int = 4 * STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of text each, so that working memory doesn't follow the batch size."""
    _, offsets = utf8(batch.column(column))
    for i, j in steps(offsets, most):
        yield batch.slice(i, j - i)


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, row) of every word ``[^\\x20\\x09-\\x0D]+``; no word crosses rows."""
    word = ~SPACE[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    edge = offsets[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    begins[edge] = word[edge]
    ends[edge - 1] = word[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a little-endian word, zeros past the end; a view that can be indexed."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lanes: int = 1) -> list[np.ndarray]:
    """A 64-bit hash of each span's bytes for each lane; blocks of eight bytes are mixed in one after the other.

    The first block is mixed by a bijection, so short spans never collide. A later one goes through two
    different mixes, keyed by the state before, of which the sum is taken: no block can be solved for that cancels another.
    """
    view, size = eights(data), end - start
    out = [mix(size.astype(np.uint64) * _ODD ^ seed) for seed in LANES[:lanes]]
    busy, k = np.flatnonzero(size <= LONG), 0
    while len(busy):
        block = view[start[busy] + k] & _MASKS[np.minimum(size[busy] - k, 8)]
        for h in out:
            held = h[busy]
            h[busy] = mix((held ^ block) * _ODD) if k == 0 else mix(held ^ block) + mix(block * _ODD + held)
        k += 8
        busy = busy[size[busy] > k]
    large = np.flatnonzero(size > LONG)
    if len(large):
        raw = memoryview(np.ascontiguousarray(data))
        wide = b"".join(hashlib.blake2b(raw[s:e], digest_size=16).digest() for s, e in zip(start[large].tolist(), end[large].tolist(), strict=True))
        for lane, h in enumerate(out):
            h[large] = np.frombuffer(wide, np.uint64)[lane::2]
    return out


def word_hashes(data: np.ndarray, offsets: np.ndarray, fold: bool, lane: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash in ``lane``, start, end, row) of every word; ``fold`` lower-cases A-Z."""
    start, end, row = word_bounds(data, offsets)
    return span_hashes(FOLD[data] if fold else data, start, end, lane + 1)[lane], start, end, row


def gram_hashes(words: np.ndarray, n: int, lane: int = 0) -> np.ndarray:
    """Hash of the n words from each place on; the last n-1 places have none."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(m, LANES[lane])
    for i in range(n):
        w = words[i : i + m]
        out = (out ^ w) * _ODD
        out = (out ^ (out >> np.uint64(32))) + (w ^ (w >> np.uint64(29))) * LANES[1]  # a word counts twice, so it can't be solved for
    return mix(out)


def row_grams(words: np.ndarray, row: np.ndarray, rows: int, n: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(gram, row): n-grams of words in each row; a row of 1 to n-1 words has its whole sequence as one gram."""
    counts = np.bincount(row, minlength=rows)
    m = len(words) - n + 1
    if m > 0:
        full = row[:m] == row[n - 1 :]
        grams, owner = gram_hashes(words, n, lane)[full], row[:m][full]
    else:
        grams, owner = np.zeros(0, np.uint64), np.zeros(0, row.dtype)
    short = np.flatnonzero((counts > 0) & (counts < n))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])
        whole = [gram_hashes(words[first[r] : first[r] + counts[r]], int(counts[r]), lane)[0] ^ np.uint64(counts[r]) for r in short]
        grams, owner = np.concatenate([grams, np.array(whole, np.uint64)]), np.concatenate([owner, short])
    return grams, owner


def row_sets(grams: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (gram, row), sorted by row, then gram."""
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    keep = np.ones(len(grams), bool)
    keep[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    return grams[keep], owner[keep]


def sliding(x: np.ndarray, w: int, best) -> np.ndarray:
    """best(x[i : i+w]) for each i with a whole window, in a fixed number of passes."""
    n = len(x)
    size = -(-n // w) * w
    pad = np.full(size, x[-1], x.dtype)
    pad[:n] = x
    rows = pad.reshape(-1, w)
    ahead = best.accumulate(rows, axis=1).ravel()
    back = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(back[: n - w + 1], ahead[w - 1 : n])
