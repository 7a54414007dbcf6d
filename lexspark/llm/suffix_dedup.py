"""Deduplication of repeated byte strings with suffix arrays.

Suffixes are taken sparsely: any WINDOW equal bytes contain the same winnowed anchor, so only suffixes
around anchors that occur in two documents are sorted. They are dealt out by anchor; each shard of
them gets a suffix array by Larsson-Sadakane refinement (ranks of h bytes give ranks of 2h, and only
suffixes whose rank is shared are sorted again), neighbours' common prefixes are read off the saved
ranks, and an anchor whose suffixes fill several shards is merged across them by binary search. An
anchor with more suffixes than that is dealt out once more, window by window.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as tx
from ._anchors import ELSEWHERE, _sort, _starts, by_document, identified, packed_pair, repeated, runs
from ._store import Store, partitions, table
from .substring_dedup import names

WINDOW, GRAM = 50, 16
SPAN = WINDOW - GRAM + 1
#: A context holds every window around an anchor: REACH bytes, the anchor, REACH bytes.
REACH = WINDOW - GRAM
CONTEXT = 2 * REACH + GRAM
#: Contexts in a shard of about a megabyte: their places fit in 21 bits, so three of them sort as one 64-bit word.
SHARD_ROWS = (1 << 20) // CONTEXT
#: Contexts that a task remembers to have sent, 24 bytes each.
REMEMBERED = 4_000_000
#: Distinct windows of one anchor that are searched from shard to shard; what more it has is dealt out by whole windows.
CARRIED = 4_000_000


def minimizers(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash of the GRAM bytes at each place, least hash in the WINDOW bytes from each place; 0 where the row has fewer left)."""
    view, n = tx.eights(data), len(data) - GRAM + 1
    h = np.maximum(tx.mix((tx.mix(view[:n]) ^ view[8 : 8 + n]) * tx.LANES[0]), np.uint64(1))
    low = tx.sliding(h, SPAN, np.minimum)
    left = np.repeat(offsets[1:], np.diff(offsets))[: len(low)] - np.arange(len(low))
    low[left < WINDOW] = 0
    return h, low


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of the GRAM-byte strings that are the least of some WINDOW bytes of one row."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h, low = minimizers(data, offsets)
    edge = np.zeros(SPAN - 1, np.uint64)
    place = np.flatnonzero(h == tx.sliding(np.concatenate([edge, low, edge]), SPAN, np.maximum)[: len(h)])
    return place, h[place]


def _find(b: pa.RecordBatch):
    data, offsets = tx.utf8(b.column("text"))
    ids, ties, new = names(b)
    for i, j in tx.steps(offsets):
        off = offsets[i : j + 1] - offsets[i]
        place, key = anchors(data[offsets[i] : offsets[j]], off)
        row = np.searchsorted(off, place, "right") - 1
        place, key, row = (x[new[row + i]] for x in (place, key, row))
        yield [key], ids[row + i], ties[row + i], place - off[row], key


def suffix_ranks(text: np.ndarray, depth: int) -> tuple[np.ndarray, int]:
    """(rank of the suffix at each place by its first h bytes, h), h >= depth; at most 2**21 bytes.

    Larsson-Sadakane refinement: sort by five bytes at first, then double; suffixes that are alone at
    their rank are settled and left out of later rounds. Bytes past the end count as zeros.
    """
    n = len(text)
    at = np.arange(n, dtype=np.uint64)
    wide = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(5):
        key = key << np.uint64(8) | wide[i : i + n]
    order = np.sort(key << np.uint64(21) | at)  # 40 bits of text, 21 of place
    place = (order & np.uint64((1 << 21) - 1)).astype(np.int64)
    new = _starts(order >> np.uint64(21))
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.zeros(n + 1, np.uint64)
    rank[place] = (first + 1).astype(np.uint64)  # 0 is for what is past the end
    h = 5
    while h < depth:
        alone = new.copy()
        alone[:-1] &= new[1:]
        busy = place[~alone]
        if not len(busy):
            break
        ahead = np.minimum(busy + h, n)
        order = np.sort(rank[busy] << np.uint64(42) | rank[ahead] << np.uint64(21) | busy.astype(np.uint64))
        place = (order & np.uint64((1 << 21) - 1)).astype(np.int64)
        pair = order >> np.uint64(21)
        head = _starts(pair >> np.uint64(21))
        new = _starts(pair)
        k = np.arange(len(place))
        group, part = np.maximum.accumulate(np.where(head, k, 0)), np.maximum.accumulate(np.where(new, k, 0))
        rank[place] = (order >> np.uint64(42)) + (part - group).astype(np.uint64)
        h *= 2
    return rank, h


def contexts(data: np.ndarray, offsets: np.ndarray, anchor: np.ndarray):
    """(key, begin, end, contexts as rows of CONTEXT bytes around the anchor) of anchors in ``data``.

    A context is what the windows span whose least string is this anchor; they are neighbours. So a
    window belongs to one anchor, and equal windows have equal anchors at equal offsets.
    """
    h, low = minimizers(data, offsets)
    back = anchor[:, None] - np.arange(SPAN)[::-1]
    own = (back >= 0) & (low[np.clip(back, 0, len(low) - 1)] == h[anchor][:, None]) & (back < len(low))
    begin = anchor - (SPAN - 1) + own.argmax(1)
    end = anchor - own[:, ::-1].argmax(1) + WINDOW
    column = (anchor - REACH)[:, None] + np.arange(CONTEXT)
    whole = (column >= begin[:, None]) & (column < end[:, None])
    return h[anchor], begin, end, np.where(whole, data[np.clip(column, 0, len(data) - 1)], 0).astype(np.uint8), whole


def _marks(wide: np.ndarray, ahead: np.ndarray, size: np.ndarray) -> list[np.ndarray]:
    """128 bits, in two lanes, of each context's bytes and place around its anchor."""
    out = [(size * 128 + ahead).astype(np.uint64) ^ seed for seed in tx.LANES]
    for i in [*range(0, CONTEXT - 7, 8), CONTEXT - 8]:
        block = np.ascontiguousarray(wide[:, i : i + 8]).view(np.uint64)[:, 0]
        out = [tx.mix((x ^ block) * tx.LANES[1 - k]) for k, x in enumerate(out)]
    return out


def _window_marks(flat: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """128 bits, in two lanes, of the WINDOW bytes from each place on."""
    view, out = tx.eights(flat), [np.full(len(at), seed) for seed in tx.LANES]
    for i in [*range(0, WINDOW - 7, 8), WINDOW - 8]:
        block = view[at + i]
        out = [tx.mix((x ^ block) * tx.LANES[1 - k]) for k, x in enumerate(out)]
    return out


def _copies(marks: list[np.ndarray], doc: np.ndarray) -> np.ndarray:
    """Which contexts a smaller document has too: all of their windows repeat."""
    if not len(doc):
        return np.zeros(0, bool)
    order = _sort(marks)
    begin = np.flatnonzero(_starts(*(m[order] for m in marks)))
    low = np.minimum.reduceat(doc[order], begin)
    out = np.zeros(len(doc), bool)
    out[order] = doc[order] > np.repeat(low, np.diff(np.append(begin, len(doc))))
    return out


#: The body is a head (id, tie, pos so that bytes sort as they do; where the anchor is, how many bytes follow) and the
#: context's bytes; or, with SPAN_MARK for the anchor, the length of a span that is covered whole.
SENT = "key bigint, body binary"
HEAD, SPAN_MARK = 22, 255
SIGN = np.uint64(1 << 63)
#: Spans that are covered; or, with a window, the start of one that is still to be compared.
COVERED = "id bigint, tie bigint, start int, end int, window binary"


def _bodies(doc, tie, pos, ahead, size, wide, whole) -> pa.Array:
    """Bodies of SENT; ``whole`` tells which bytes of a row of ``wide`` follow its head."""
    head = np.empty((len(doc), HEAD), np.uint8)
    head[:, :8] = (doc.view(np.uint64) ^ SIGN).astype(">u8").reshape(-1, 1).view(np.uint8)
    head[:, 8:16] = tie.astype(">i8").reshape(-1, 1).view(np.uint8)
    head[:, 16:20] = pos.astype(">u4").reshape(-1, 1).view(np.uint8)
    head[:, 20], head[:, 21] = ahead, size
    rows = np.concatenate([head, wide], 1)
    kept = np.concatenate([np.ones((len(doc), HEAD), bool), whole], 1)
    ends = np.concatenate([[0], np.cumsum(kept.sum(1))]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(doc), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(rows[kept]))])


class _Seen:
    """Contexts that a task has sent: chunks of (marks sorted by the first lane, documents). Past REMEMBERED no more are taken in; what isn't found is sent, which is as exact."""

    def __init__(self):
        self.chunks, self.size = [], 0

    def smaller(self, marks: list[np.ndarray], doc: np.ndarray) -> np.ndarray:
        """Which contexts a smaller document of the task has too."""
        out = np.zeros(len(doc), bool)
        for (first, second), docs in self.chunks:
            at = np.minimum(np.searchsorted(first, marks[0]), len(docs) - 1)
            out |= (first[at] == marks[0]) & (second[at] == marks[1]) & (docs[at] < doc)
        return out

    def add(self, marks: list[np.ndarray], doc: np.ndarray) -> None:
        if not len(doc) or self.size >= REMEMBERED:
            return
        if len(self.chunks) == 8:
            old, docs = zip(*self.chunks, strict=True)
            marks, doc = [np.concatenate([*(o[k] for o in old), m]) for k, m in enumerate(marks)], np.concatenate([*docs, doc])
            self.chunks = []
        order = np.lexsort((doc, marks[1], marks[0]))
        order = order[_starts(*(m[order] for m in marks))]  # the least document of each
        self.chunks.append(([m[order] for m in marks], doc[order]))
        self.size = sum(len(d) for _, d in self.chunks)


def _settle(batches):
    """Contexts to rows of SENT. Of equal contexts in a task those of a smaller document than was sent before are sent; the others are covered whole: their joint spans, under a key of their document."""
    seen = _Seen()
    for whole_batch in batches:
        for b in tx.slices(whole_batch, "text", tx.STEP_BYTES):
            data, offsets = tx.utf8(b.column("text"))
            first, many, n = runs(b.column("places"))
            ids, ties, new = names(b)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((first, row))
            first, many, row = first[order], many[order], row[order]
            places = np.repeat(first, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row = np.repeat(row, many)
            places, row = places[new[row]], row[new[row]]
            if not len(places):
                continue
            doc, tie = ids[row], ties[row]
            key, begin, end, wide, whole = contexts(data, offsets, offsets[row] + places)
            pos, ahead, size = begin - offsets[row], offsets[row] + places - begin, end - begin
            marks = _marks(wide, ahead, size)
            known = _copies(marks, doc) | seen.smaller(marks, doc)
            sent = ~known
            seen.add([m[sent] for m in marks], doc[sent])
            yield pa.record_batch([pa.array(key[sent].view(np.int64) >> 16), _bodies(doc[sent], tie[sent], pos[sent], ahead[sent], size[sent], wide[sent], whole[sent])], ["key", "body"])
            if known.any():
                doc, tie, pos, stop, row = doc[known], tie[known], pos[known], (pos + size)[known], row[known]
                far = row * (int(stop.max()) + 1)  # places of a row come in order, so spans that meet are neighbours
                apart = np.ones(len(row), bool)
                apart[1:] = (far + pos)[1:] > np.maximum.accumulate(far + stop)[:-1]
                at = np.flatnonzero(apart)
                length = np.maximum.reduceat(stop, at) - pos[at]
                spread = tx.mix(doc[at].view(np.uint64) ^ tie[at].view(np.uint64)).view(np.int64) >> 16
                tail = length.astype("<u4").reshape(-1, 1).view(np.uint8)
                yield pa.record_batch([pa.array(spread), _bodies(doc[at], tie[at], pos[at], np.full(len(at), SPAN_MARK), 4, tail, np.ones(tail.shape, bool))], ["key", "body"])


def _unpack(b: pa.RecordBatch) -> tuple[dict, dict]:
    """(contexts, spans) of a batch of SENT: columns key, id, tie, pos, ahead, size, and the contexts' bytes as rows of CONTEXT."""
    body = b.column("body")
    _, ends, data = body.buffers()
    ends = np.frombuffer(ends, np.int32, len(body) + 1, body.offset * 4).astype(np.int64)
    data = np.frombuffer(data, np.uint8)
    head = data[ends[:-1, None] + np.arange(HEAD)]
    field = lambda i, j, kind: np.ascontiguousarray(head[:, i:j]).view(kind)[:, 0]
    doc = (field(0, 8, ">u8").astype(np.uint64) ^ SIGN).view(np.int64)
    c = {"key": b.column("key").to_numpy(), "id": doc, "tie": field(8, 16, ">i8").astype(np.int64), "pos": field(16, 20, ">u4").astype(np.int64), "ahead": head[:, 20].astype(np.int64), "size": head[:, 21].astype(np.int64)}
    known = c["ahead"] == SPAN_MARK
    spans, rest = {k: v[known] for k, v in c.items()}, {k: v[~known] for k, v in c.items()}
    spans["size"] = np.ascontiguousarray(data[ends[:-1][known][:, None] + HEAD + np.arange(4)]).view("<u4")[:, 0].astype(np.int64)
    column = np.arange(CONTEXT) - (REACH - rest["ahead"])[:, None]
    inside = (column >= 0) & (column < rest["size"][:, None])
    from_ = ends[:-1][~known][:, None] + HEAD + column
    rest["wide"] = np.where(inside, data[np.clip(from_, 0, max(len(data) - 1, 0))], 0).astype(np.uint8) if len(data) else np.zeros(column.shape, np.uint8)
    return rest, spans


def _spans(c: dict, rows: np.ndarray, start: np.ndarray, end: np.ndarray, windows: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows of COVERED; ``windows``: rows of WINDOW bytes."""
    n = len(rows)
    body = pa.nulls(n, pa.binary()) if windows is None else pa.array([w.tobytes() for w in windows], pa.binary())
    return pa.record_batch([pa.array(c["id"][rows]), pa.array(c["tie"][rows]), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32)), body], ["id", "tie", "start", "end", "window"])


def _cover(batches):
    """Rows of SENT sorted by (key, body) to rows of COVERED."""
    steps = np.arange(REACH + 1)
    held: list[dict] = []
    carried = None  # (key, marks of its windows sorted by the first lane, least doc of each) of an anchor that goes on in the next shard

    def shard(c):
        """Contexts that a smaller document has too are covered whole, and an anchor with one context left is done; the rest is sorted."""
        marks = _marks(c["wide"], c["ahead"], c["size"])
        copy = _copies(marks, c["id"])
        begin = np.flatnonzero(_starts(c["key"]))
        run = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(copy))))
        many = np.logical_or.reduce([np.minimum.reduceat(m, begin) != np.maximum.reduceat(m, begin) for m in marks])
        goes_on = c["key"] == c["key"][-1]
        if carried is not None:
            goes_on |= c["key"] == carried[0]
        keep = ~copy & (many[run] | goes_on)
        rows = np.flatnonzero(copy)
        yield _spans(c, rows, c["pos"][rows], (c["pos"] + c["size"])[rows])
        if keep.any():
            yield from sort_shard({k: v[keep] for k, v in c.items()})

    def sort_shard(c):
        nonlocal carried
        wide, rows = c["wide"], len(c["id"])
        flat = wide.ravel()
        rank, h = suffix_ranks(flat, WINDOW - 10)
        # A window starts at columns 0..REACH; it counts if the context's bytes hold it.
        from_, to = REACH - c["ahead"], REACH - c["ahead"] + c["size"]
        valid = (steps >= from_[:, None]) & (steps + WINDOW <= to[:, None])
        at = (np.arange(rows)[:, None] * CONTEXT + steps)[valid]
        owner = np.repeat(np.arange(rows), valid.sum(1))
        start = (c["pos"] - from_)[owner] + (at - owner * CONTEXT)
        # The first WINDOW bytes are equal where the first h and the h that end with them are.
        h = min(h, WINDOW)
        pair = rank[at] << np.uint64(32) | rank[at + WINDOW - h]
        order = np.lexsort((c["id"][owner], pair))
        run = np.maximum.accumulate(np.where(_starts(pair[order]), np.arange(len(order)), 0))
        least = np.zeros(len(at), np.int64)
        least[order] = c["id"][owner[order[run]]]
        gone = c["id"][owner] > least
        edge = (c["key"][owner] == c["key"][-1]) | (carried is not None and c["key"][owner] == carried[0])
        if edge.any():
            e = np.flatnonzero(edge)
            marks = _window_marks(flat, at[e])
            new = np.ones(len(e), bool)  # not among the carried windows
            if carried is not None and len(carried[2]):
                (first, second), docs = carried[1:]
                found = np.minimum(np.searchsorted(first, marks[0]), len(docs) - 1)
                hit = (c["key"][owner[e]] == carried[0]) & (first[found] == marks[0]) & (second[found] == marks[1])
                gone[e[hit]] |= docs[found[hit]] < c["id"][owner[e[hit]]]
                new = ~hit
            if carried is not None and len(carried[2]) >= CARRIED:
                # Too many to carry: what is not found among them is compared elsewhere, by its bytes.
                left = e[new & ~gone[e] & (c["key"][owner[e]] == carried[0])]
                if len(left):
                    yield _spans(c, owner[left], start[left], start[left] + WINDOW, flat[at[left][:, None] + np.arange(WINDOW)])
            more = carried is not None and carried[0] == c["key"][-1]
            if not more or len(carried[2]) < CARRIED:
                last = (c["key"][owner[e]] == c["key"][-1]) & new
                lanes, docs = [m[last] for m in marks], least[e[last]]
                if more:
                    lanes, docs = [np.concatenate(x) for x in zip(carried[1], lanes, strict=True)], np.concatenate([carried[2], docs])
                order = np.lexsort((docs, lanes[1], lanes[0]))
                order = order[_starts(lanes[0][order], lanes[1][order])]
                carried = c["key"][-1], [m[order] for m in lanes], docs[order]
        start, owner = start[gone], owner[gone]
        new = np.ones(len(start), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (start[1:] != start[:-1] + 1)
        first = np.flatnonzero(new)
        stop = np.concatenate([first[1:] - 1, [len(start) - 1]]) if len(first) else first
        yield _spans(c, owner[first], start[first], start[stop] + WINDOW)

    def take(rows):
        c = {k: np.concatenate([x[k] for x in held]) for k in held[0]}
        out = {k: v[:rows] for k, v in c.items()}
        held[:] = [{k: v[rows:] for k, v in c.items()}] if rows < len(c["key"]) else []
        return shard(out)

    for b in batches:
        c, spans = _unpack(b)
        if len(spans["id"]):
            yield _spans(spans, np.arange(len(spans["id"])), spans["pos"], spans["pos"] + spans["size"])
        if len(c["id"]):
            held.append(c)
        while sum(len(x["key"]) for x in held) >= 2 * SHARD_ROWS:
            keys = np.concatenate([x["key"][: SHARD_ROWS + 1] for x in held])[: SHARD_ROWS + 1]
            change = np.flatnonzero(keys[1:] != keys[:-1])  # cut between anchors where that is possible
            yield from take(int(change[-1]) + 1 if len(change) else SHARD_ROWS)
    while held:
        total = sum(len(x["key"]) for x in held)
        yield from take(min(total, SHARD_ROWS))


def _left(batches):
    """Rows of COVERED sorted by (window, id) to (id, tie, start, end): spans, and windows that a smaller document has too."""
    last = None  # the window that the rows before ended in, and its least id
    for b in batches:
        whole = b.column("window").is_null()
        if whole.true_count:
            yield b.filter(whole).select(["id", "tie", "start", "end"])
        rest = b.filter(pc.invert(whole))
        keep = []
        for window, doc in zip(rest.column("window").to_pylist(), rest.column("id").to_pylist(), strict=True):
            if last is None or window != last[0]:
                last = window, doc
            keep.append(doc > last[1])
        if any(keep):
            yield rest.filter(pa.array(keep)).select(["id", "tie", "start", "end"])


def covered_bytes(docs: DataFrame, store: Store) -> DataFrame:
    """doc_id, id, tie, text of ``docs`` with ``spans``, a list of pairs (start, end), of the bytes that repeat a smaller document; null for none."""
    docs = identified(docs, store)
    found = store.save(repeated(docs, _find, ELSEWHERE), "anchors")
    near = docs.join(by_document(found), ["id", "tie"], "left")
    sent = near.mapInArrow(_settle, SENT).repartition(partitions(docs.sparkSession), "key").sortWithinPartitions("key", "body")
    covered = sent.mapInArrow(_cover, COVERED)
    meet = F.when(F.col("window").isNull(), F.xxhash64("id", "tie")).otherwise(F.xxhash64("window"))
    spans = covered.repartition(partitions(docs.sparkSession), meet).sortWithinPartitions("window", "id").mapInArrow(_left, "id bigint, tie bigint, start int, end int")
    return docs.join(spans.groupBy("id", "tie").agg(F.collect_list(packed_pair("start", "end")).alias("spans")), ["id", "tie"], "left")


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept binary, for each row of ``docs`` (doc_id, text).

    A UTF-8 byte goes if a WINDOW-byte string covers it that also starts in a document with a smaller
    doc_id; overlaps count, and strings are judged on the input. n_spans counts maximal removed runs.
    What is kept can split a character, so it is binary. Null and empty texts have no bytes. Rows that
    share a doc_id take nothing from each other, whatever their texts; nor do rows without a doc_id,
    which sorts first. Other columns are ignored; an empty table gives no rows. Within a shard bytes
    are compared; whole contexts, and windows of an anchor that fills several shards, by 128 bits.
    """

    def cut(batches):
        for b in batches:
            data, offsets = tx.utf8(b.column("text"))
            start, end, n = runs(b.column("spans"))
            row = np.repeat(np.arange(len(n)), n)
            mark = np.zeros(len(data) + 1, np.int32)
            np.add.at(mark, offsets[row] + start, 1)
            np.add.at(mark, offsets[row] + end, -1)
            gone = np.cumsum(mark[:-1]) > 0
            begins = gone.copy()
            begins[1:] &= ~gone[:-1]
            inner = offsets[:-1][np.diff(offsets) > 0]
            begins[inner] = gone[inner]
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[offsets])
            kept = data[~gone]
            ends = np.concatenate([[0], np.cumsum(~gone)])[offsets].astype(np.int32)
            yield pa.record_batch({
                "doc_id": b.column("doc_id"), "n_bytes": np.diff(offsets).astype(np.int64), "n_removed": total(gone).astype(np.int64), "n_spans": total(begins).astype(np.int64),
                "kept": pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(kept))]),
            })

    return covered_bytes(docs, Store(docs.sparkSession)).mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, as UTF-8 bytes; kept bytes as their SHA-256. See ``remove_repeated_bytes``."""
    out = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
