"""Benchmark decontamination: benchmark items inside documents, up to a share of edits.

Item-sized windows are embedded by the CGK random walk, which turns edit distance into Hamming
distance: at each step the current symbol is written and the walk stays or moves on by a random bit
of (step, symbol). Windows and items whose embeddings agree on one of REPEATS samples of SAMPLED
places are candidates, and an exact bit-parallel edit distance decides. Windows are laid where they
can hold an item: an item is cut into more pieces than edits are allowed, so some stay whole, at about
the same offset. Pieces are looked up at every byte of a text, and that loses nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as tx
from ._store import table

#: Edits allowed, as a share of the item's bytes.
EDIT_SHARE = 0.10
#: A walk that an edit has parted comes together again only by chance, so few places agree at the edit limit: with a
#: sixth of them, a window and its item still miss each other with chance (1 - 1/36)**160, 1 %; without edits never.
SAMPLED, REPEATS = 2, 160
#: Items in one broadcast; more items go in further passes, so a broadcast has a known bound.
ITEMS_PER_PASS, MAX_ITEM_BYTES = 20_000, 4096
#: Bytes of a piece; items of under 40 bytes may have shorter ones.
PIECE = 8
#: Items of fewer words and fewer bytes are too short to tell and match nothing; many scripts, code and URLs have no spaces, so either is enough.
LEAST_WORDS, LEAST_BYTES = 3, 32
#: Times that a piece may stand in an item before its places count as one stretch.
REPEATED = 4
SPREAD = np.uint64(0x9E3779B97F4A7C15)

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
FOLD[tx.SPACE] = 32


def edit_occurrence(item: bytes, text: bytes) -> tuple[int, int]:
    """(least edit distance of ``item`` to any part of ``text``, end of that part). Bit-parallel over whole integers."""
    m = len(item)
    peq: dict[int, int] = {}
    for i, c in enumerate(item):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best, where = m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        score += bool(ph & top) - bool(mh & top)
        ph, mh = ph << 1 & full, mh << 1 & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, where = score, j + 1
    return best, where


def walk_bits(steps: int, seed: int = 17) -> np.ndarray:
    """The walk's random bits: one for each (step, symbol)."""
    x = np.arange(steps * 256, dtype=np.uint64) + np.uint64(seed << 40)
    return (tx.mix(x) >> np.uint64(63)).astype(np.int64).reshape(steps, 256)


def embed(windows: np.ndarray, lengths: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """CGK embedding of rows of bytes (zero-padded), len(bits) symbols each; past its length a row writes zeros."""
    n = len(windows)
    at, rows = np.zeros(n, np.int64), np.arange(n)
    out = np.zeros((len(bits), n), np.uint8)
    most = windows.shape[1] - 1
    for j in range(len(bits)):
        s = np.where(at < lengths, windows[rows, np.minimum(at, most)], 0)
        out[j] = s
        at += bits[j][s]
    return out.T


def sample_keys(embedded: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """One key for each row and repeat: of the item size, the repeat and the symbols at that repeat's places among the first 2*length."""
    x = tx.mix(np.arange(REPEATS * SAMPLED, dtype=np.uint64) + np.uint64(0xC6A4A793))
    share = (x >> np.uint64(11)).astype(float) / 2.0**53
    places = np.minimum((share[None, :] * 2 * lengths[:, None]).astype(np.int64), embedded.shape[1] - 1)
    symbols = np.take_along_axis(embedded, places, 1).astype(np.uint64).reshape(len(embedded), REPEATS, SAMPLED)
    key = lengths.astype(np.uint64)[:, None] * np.uint64(REPEATS) + np.arange(REPEATS, dtype=np.uint64)
    for k in range(SAMPLED):
        key = tx.mix(key * np.uint64(257) + symbols[:, :, k])
    return key


def _joined(found: np.ndarray) -> np.ndarray:
    """Rows (item, row, low, high) with those of one item and row that overlap joined."""
    if not len(found):
        return found
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    item, row, low, high = found.T
    new = np.ones(len(found), bool)
    new[1:] = (item[1:] != item[:-1]) | (row[1:] != row[:-1])
    group = np.cumsum(new) - 1
    span = int(high.max() - low.min()) + 2
    reach = np.maximum.accumulate(high - low.min() + group * span) - group * span + low.min()  # the greatest end so far, within the item and row
    new[1:] |= low[1:] > reach[:-1]
    first = np.flatnonzero(new)
    end = np.concatenate([first[1:], [len(found)]]) - 1
    return np.stack([item[first], row[first], low[first], reach[end]], 1)


class Items:
    """A pass's benchmark items, their pieces and their sample keys."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids = np.array(ids, np.int64)
        self.raw = [FOLD[np.frombuffer(t.encode(), np.uint8)].tobytes() for t in texts]
        self.lengths = np.array([len(r) for r in self.raw], np.int64)
        _, _, _, row = tx.word_hashes(*tx.utf8(pa.array(texts, pa.string())), True)
        words = np.bincount(row, minlength=len(ids))
        self.limits = (EDIT_SHARE * self.lengths).astype(np.int64)
        size = np.where(self.lengths // PIECE > self.limits, PIECE, self.lengths // (self.limits + 1))
        self.need = self.lengths // np.maximum(size, 1) - self.limits
        self.pieces = {}
        told = (words >= LEAST_WORDS) | (self.lengths >= LEAST_BYTES)
        for q in np.unique(size[told]).tolist():
            whose = np.flatnonzero((size == q) & told).tolist()
            value = np.array([int.from_bytes(self.raw[i][at : at + q], "little") for i in whose for at in range(0, len(self.raw[i]) - q + 1, q)], np.uint64)
            offset = np.array([at for i in whose for at in range(0, len(self.raw[i]) - q + 1, q)], np.int64)
            owner = np.repeat(whose, self.lengths[whose] // q)
            # A piece that an item repeats often is one entry, from its first to its last offset.
            order = np.lexsort((offset, owner, value))
            value, owner, offset = value[order], owner[order], offset[order]
            new = np.ones(len(value), bool)
            new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
            group = np.cumsum(new) - 1
            often = np.bincount(group)[group] > REPEATED
            last = offset[np.concatenate([np.flatnonzero(new)[1:], [len(value)]]) - 1][group]
            keep = new | ~often
            value, owner, offset, last = value[keep], owner[keep], offset[keep], np.where(often, last, -1)[keep]
            kinds, begin, count = np.unique(value, return_index=True, return_counts=True)
            bits = max(18, int(32 * len(kinds)).bit_length())
            near, shift = np.zeros(1 << bits, bool), np.uint64(64 - bits)
            near[(kinds * SPREAD) >> shift] = True
            self.pieces[q] = near, shift, kinds, begin, count, owner, offset, last
        self.bits = walk_bits(int(2 * self.lengths.max(initial=1)))
        wide = np.zeros((len(ids), int(self.lengths.max(initial=1))), np.uint8)
        for i, r in enumerate(self.raw):
            wide[i, : len(r)] = np.frombuffer(r, np.uint8)
        self.keys = sample_keys(embed(wide, self.lengths, self.bits), self.lengths)

    def hits(self, folded: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(item, row, place) where a piece of an item stands in a row's text, and (item, row, least, greatest place) of often repeated pieces.

        The place is that of the item's start, if nothing were inserted or deleted between. Places of a
        repeated piece are joined as they come, so a text of one character costs a few stretches, not a row for each pair of occurrences.
        """
        padded = np.concatenate([folded, np.zeros(PIECE, np.uint8)])
        single, stretches = [np.zeros((0, 3), np.int64)], [np.zeros((0, 4), np.int64)]
        for at in range(0, len(folded), 1 << 18):
            n = min(1 << 18, len(folded) - at)
            eight = np.empty(n, np.uint64)
            for i in range(min(PIECE, n)):
                eight[i::PIECE] = padded[at + i : at + i + (n - i + PIECE - 1) // PIECE * PIECE].view("<u8")
            for q, (near, shift, kinds, begin, count, owner, offset, last) in self.pieces.items():
                value = eight if q == PIECE else eight & np.uint64((1 << 8 * q) - 1)
                pos = np.flatnonzero(near[(value * SPREAD) >> shift])
                value = value[pos]
                kind = np.minimum(np.searchsorted(kinds, value), len(kinds) - 1)
                same = kinds[kind] == value
                pos, kind = pos[same] + at, kind[same]
                row = np.searchsorted(offsets, pos, "right") - 1
                inside = pos + q <= offsets[row + 1]
                pos, kind, row = pos[inside], kind[inside], row[inside]
                n_of = count[kind]
                entry = np.arange(int(n_of.sum())) - np.repeat(np.cumsum(n_of) - n_of - begin[kind], n_of)
                item, row, pos, last_of = owner[entry], np.repeat(row, n_of), np.repeat(pos, n_of), last[entry]
                one = last_of < 0
                single.append(np.stack([item[one], row[one], pos[one] - offset[entry[one]]], 1))
                many = ~one
                stretches.append(_joined(np.stack([item[many], row[many], pos[many] - last_of[many], pos[many] - offset[entry[many]]], 1)))
        return np.concatenate(single), _joined(np.concatenate(stretches))

    def segments(self, folded: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows (item, row, least start, greatest start, whether the text's edge is within the limit) between which each occurrence within the limit starts.

        Of ``count`` pieces, ``limit`` edits leave count - limit whole, and inserted and deleted bytes move
        their places apart by at most ``limit``: where that many hits lie that close, a segment begins.
        A stretch of an often repeated piece counts as enough by itself.
        """
        single, stretches = self.hits(folded, offsets)
        single = single[np.lexsort((single[:, 2], single[:, 1], single[:, 0]))]
        item, row, at = single.T
        need, limit = self.need[item], self.limits[item]
        last = np.arange(len(item)) + need - 1
        ok = last < len(item)
        last = np.minimum(last, max(len(item) - 1, 0))
        ok &= (item[last] == item) & (row[last] == row) & (at[last] - at <= limit)
        limits = self.limits[stretches[:, 0]]
        wide = np.stack([stretches[:, 0], stretches[:, 1], stretches[:, 2] - limits, stretches[:, 3] + limits], 1)
        found = _joined(np.concatenate([np.stack([item[ok], row[ok], at[last[ok]] - limit[ok], at[ok] + limit[ok]], 1), wide]))
        top, bottom = offsets[found[:, 1]], offsets[found[:, 1] + 1]
        length = self.lengths[found[:, 0]]
        edge = (found[:, 2] < top) | (found[:, 3] + length > bottom)
        inside = found[:, 2] < bottom
        return np.stack([found[:, 0], found[:, 1], np.maximum(found[:, 2], top), np.maximum(found[:, 3], top), edge], 1)[inside]

    def agree(self, folded: np.ndarray, offsets: np.ndarray, item: np.ndarray, row: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Whether the item-sized windows at ``start`` share a sample of their embedding with their item."""
        out = np.zeros(len(item), bool)
        for k in range(0, len(item), 1024):
            i, s = item[k : k + 1024], start[k : k + 1024]
            size = self.lengths[i]
            here = np.minimum(size, offsets[row[k : k + 1024] + 1] - s)
            columns = np.arange(int(size.max()))
            wide = folded[np.minimum(s[:, None] + columns, len(folded) - 1)] * (columns < here[:, None])
            keys = sample_keys(embed(wide, here, self.bits[: 2 * int(size.max())]), size)
            out[k : k + 1024] = (keys == self.keys[i]).any(1)
        return out

    def matches(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, item, distance, start, end) of the items found; bytes within the row, the least distance for each row and item."""
        folded = FOLD[data]
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        parts = []
        for i, r, lo, hi, edge in self.segments(folded, offsets).tolist():
            top, end = int(offsets[r]), min(int(offsets[r + 1]), hi + int(self.lengths[i] + self.limits[i]))
            # A whole copy shares every sample with its item.
            exact = folded[lo:end].tobytes().find(self.raw[i])
            if exact < 0:
                parts.append((i, r, lo, hi, end, edge))
            elif (r, i) not in found:
                found[r, i] = 0, lo + exact - top, lo + exact + len(self.raw[i]) - top
        parts = np.array([x for x in parts if (x[1], x[0]) not in found], np.int64).reshape(-1, 6)
        # A window at every start of a segment: the walk must begin where the item does.
        for a in range(0, len(parts), 64):
            item, row, low, high, end, edge = parts[a : a + 64].T
            n = np.minimum(high + 1, end) - low
            owner = np.repeat(np.arange(len(n)), n)
            start = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n - low, n)
            # Where an item's start or end may be cut off by the text's, no window stands for it: these few are compared at once.
            inner = np.flatnonzero(edge[owner] == 0)
            agreed = owner[inner[self.agree(folded, offsets, item[owner[inner]], row[owner[inner]], start[inner])]]
            for which in np.union1d(agreed, np.flatnonzero(edge)).tolist():
                i, r, lo, _, hi, _ = parts[a + which].tolist()
                key, top, part = (r, i), int(offsets[r]), folded[lo:hi].tobytes()
                distance, size = edit_occurrence(self.raw[i], part)
                if distance <= self.limits[i] and (key not in found or distance < found[key][0]):
                    _, back = edit_occurrence(self.raw[i][::-1], part[:size][::-1])
                    found[key] = (distance, lo + size - back - top, lo + size - top)
        return [(r, i, *v) for (r, i), v in sorted(found.items())]


def _passes(benchmark: DataFrame):
    """(item ids, item texts) of each pass: ITEMS_PER_PASS items at most, and a bounded number of bytes or one item."""
    items = benchmark.where("text is not null and item_id is not null").select(F.col("item_id").cast("bigint").alias("item_id"), "text").orderBy("item_id", "text")
    ids, texts, size = [], [], 0
    for r in items.toLocalIterator():
        if ids and (len(ids) >= ITEMS_PER_PASS or size + len(r.text) > ITEMS_PER_PASS * MAX_ITEM_BYTES // 4):
            yield ids, texts
            ids, texts, size = [], [], 0
        ids.append(r.item_id)
        texts.append(r.text)
        size += len(r.text)
    if ids:
        yield ids, texts


def _found(known: Items, batch: pa.RecordBatch) -> list[tuple[int, int, int, int, int]]:
    """(row, item, distance, start, end) of the items in a batch's texts."""
    data, offsets = tx.utf8(batch.column("text"))
    hits = []
    for i, j in tx.steps(offsets):
        hits += [(r + i, *rest) for r, *rest in known.matches(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])]
    return hits


def benchmark_matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, distance, start_byte, end_byte): the items within EDIT_SHARE of their bytes of some part of a text.

    A-Z count as a-z and each white-space character as a space. One row for each document row and item:
    the closest occurrence. Null and empty texts and items match nothing; nor do items of fewer than
    LEAST_WORDS words and LEAST_BYTES bytes, which are too short to tell. Items are cut at MAX_ITEM_BYTES only for their number in
    a pass, never in their text: longer items go in passes of their own. Repeated rows each give their
    rows. An empty side gives no rows. Other columns are ignored.
    """
    schema = "doc_id bigint, item_id bigint, distance int, start_byte bigint, end_byte bigint"
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    out = None
    for items in _passes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            known = Items(*shared.value)
            for b in batches:
                hits = _found(known, b)
                r, item, distance, start, end = (np.array(x, np.int64) for x in zip(*hits, strict=True)) if hits else [np.zeros(0, np.int64)] * 5
                yield pa.record_batch({"doc_id": b.column("doc_id").take(pa.array(r)), "item_id": known.ids[item], "distance": distance.astype(np.int32), "start_byte": start, "end_byte": end})

        scanned = docs.mapInArrow(tx.lean(run), schema)
        out = scanned if out is None else out.unionAll(scanned)
    return docs.sparkSession.createDataFrame([], schema) if out is None else out


def remove_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows whose text holds a benchmark item, as in ``benchmark_matches``.

    Each row is judged by its own text where it is scanned, whatever its doc_id, so nothing is joined
    or shuffled. All columns stay as they are.
    """
    for items in _passes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches, shared=shared):
            known = Items(*shared.value)
            for b in batches:
                clean = np.ones(b.num_rows, bool)
                clean[[r for r, *_ in _found(known, b)]] = False
                yield b.filter(pa.array(clean))

        docs = docs.mapInArrow(tx.lean(run), docs.schema)
    return docs


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of ``benchmark`` in every whole text of ``documents``. See ``benchmark_matches``."""
    return benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
