"""Finding keys that occur more than once across a corpus, with as little shuffled as that needs.

A task first settles what it can alone: occurrences that another of its own occurrences decides are
passed on as known. Only one or two stand-ins of such a key, and the undecided ones, are shuffled by
key, so a key of a third of all rows costs each task two entries. Entries travel in blocks, one row
for each bucket of keys, as steps from entry to entry with equal-rank bytes side by side, which compresses well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as tx
from ._store import Store, partitions

#: Occurrences that a task holds before it settles and sends them.
HELD = 1_000_000
#: Buckets of keys in a shuffle partition: a task sorts one of them at a time.
BUCKETS = 4
#: A row is a block of entries (id null) or the known places of one document.
ROW = "bucket int, id bigint, tie bigint, n int, data binary"
#: Runs of n neighbouring places that count.
PLACES = "id bigint, tie bigint, pos int, n int"
#: Low bytes of a key that aren't sent where keys only make candidates.
SPARED = 2
#: Stands for a null doc_id; sorts first.
NO_ID = -(2**63)

#: What makes an occurrence count: one in another document, any other one, or an earlier one (in a smaller
#: document, or before it in its own).
ELSEWHERE, AGAIN, EARLIER = "elsewhere", "again", "earlier"


def identified(docs: DataFrame, store: Store) -> DataFrame:
    """doc_id, id, tie, text: (id, tie) names a text of a document, and ``id`` gives the order of documents.

    ``tie`` is 0 but for rows without a doc_id and rows whose doc_id has several texts, which it tells
    apart by a hash of the text. Rows that share both doc_id and text have one name and one result.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("hash", F.xxhash64("text"))
    shared = docs.where("doc_id is not null").groupBy("doc_id").agg(F.min("hash").alias("low"), F.max("hash").alias("high")).where("low <> high")
    shared = store.save(shared.select("doc_id", F.lit(True).alias("shared")), "shared")
    odd = F.col("doc_id").isNull() | F.col("shared").isNotNull()
    return docs.join(shared, "doc_id", "left").select(
        "doc_id", F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.when(odd, F.col("hash")).otherwise(F.lit(0).cast("bigint")).alias("tie"), "text"
    )


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows begins, in sorted columns."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = False
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
    return new


def fresh(doc: np.ndarray, tie: np.ndarray) -> np.ndarray:
    """Rows of a batch that repeat no other row of it."""
    order = np.lexsort((tie, doc))
    out = np.zeros(len(doc), bool)
    out[order[_starts(doc[order], tie[order])]] = True
    return out


def planes(x: np.ndarray) -> bytes:
    """The bytes of a column: all first bytes, then all second bytes, ..."""
    return np.ascontiguousarray(x.reshape(-1, 1).view(np.uint8).T).tobytes()


def unplanes(raw: np.ndarray, kind: type, n: int) -> np.ndarray:
    return np.ascontiguousarray(raw.reshape(np.dtype(kind).itemsize, n).T).view(kind).ravel()


def _sort(keys: list[np.ndarray]) -> np.ndarray:
    """An order that brings equal keys together. The second lane is looked at only where the first can't tell."""
    order = np.argsort(keys[0])
    if len(keys) > 1:
        first, second = keys[0][order], keys[1][order]
        if ((first[1:] == first[:-1]) & (second[1:] != second[:-1])).any():
            order = np.lexsort((keys[1], keys[0]))
    return order


def _judge(kind: str, begin: np.ndarray, of: np.ndarray, doc: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Which of the entries count, in runs of equal keys; ``of``: each entry's run."""
    if kind == AGAIN:
        return (np.diff(np.append(begin, len(of))) > 1)[of]
    low = np.minimum.reduceat(doc, begin)
    if kind == ELSEWHERE:
        return (low != np.maximum.reduceat(doc, begin))[of]
    yes = doc > low[of]
    rest = np.flatnonzero(~yes)
    rest = rest[np.bincount(of[rest], minlength=len(begin))[of[rest]] > 1]
    if len(rest):  # several places of one document, or rows that share a doc_id
        rest = rest[np.lexsort((pos[rest], tie[rest], of[rest]))]
        new = _starts(of[rest], tie[rest])
        first = rest[np.maximum.accumulate(np.where(new, np.arange(len(rest)), 0))]
        yes[rest] = pos[rest] != pos[first]
    return yes


def _steps(x: np.ndarray) -> np.ndarray:
    return np.diff(x, prepend=x.dtype.type(0))


def settle(find: Callable[[pa.RecordBatch], Iterator[tuple]], kind: str, buckets: int):
    """A mapInArrow function from batches to ROWs.

    find: a batch's (list of key lanes, id, tie, pos, deal) arrays, part by part, documents one after the
    other; ``deal`` chooses the bucket and must be equal where keys are.
    """

    spared = 0 if kind == EARLIER else SPARED

    def send(parts):
        keys = [np.concatenate(x) for x in zip(*(p[0] for p in parts), strict=True)]
        doc, tie, pos, deal = (np.concatenate([p[k] for p in parts]) for k in (1, 2, 3, 4))
        pos = pos.astype(np.int32)
        order = _sort(keys)
        lanes = [k[order] for k in keys]
        begin = np.flatnonzero(_starts(*lanes))
        of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(doc))))
        known = np.empty(len(doc), bool)
        known[order] = _judge(kind, begin, of, doc[order], tie[order], pos[order])
        yield from documents(doc[known], tie[known], pos[known])
        rest = ~known
        columns, ask, deal_ = [*(k[rest] for k in keys), doc[rest], tie[rest], pos[rest]], np.ones(rest.sum(), np.uint8), deal[rest]
        if kind != EARLIER:  # a key's least and greatest document stand for all that are known
            many = known[order[begin]]
            heads = order[begin[many]]
            low, high = (f.reduceat(doc[order], begin)[many] for f in (np.minimum, np.maximum))
            zero = np.zeros(2 * len(heads), np.int64)
            stand = [*(np.tile(k[heads], 2) for k in keys), np.concatenate([low, high]), zero, zero.astype(np.int32)]
            columns = [np.concatenate(x) for x in zip(columns, stand, strict=True)]
            ask, deal_ = np.concatenate([ask, zero.astype(np.uint8)]), np.concatenate([deal_, np.tile(deal[heads], 2)])
        bucket = ((tx.mix(deal_) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)
        order = np.argsort(bucket.astype(np.uint16) if buckets <= 1 << 16 else bucket, kind="stable")
        bucket, ask, columns = bucket[order], ask[order], [c[order] for c in columns]
        first = np.flatnonzero(_starts(bucket))
        last = np.append(first[1:], len(bucket))
        for at in range(0, len(first), 256):
            ranges = list(zip(first[at : at + 256].tolist(), last[at : at + 256].tolist(), strict=True))
            data = [b"".join([*(planes(c[i:j])[spared * (j - i) :] for c in columns[:-3]), *(planes(_steps(c[i:j])) for c in columns[-3:]), ask[i:j].tobytes()]) for i, j in ranges]
            none = pa.nulls(len(ranges), pa.int64())
            yield pa.record_batch([pa.array(bucket[first[at : at + 256]]), none, none, pa.array([j - i for i, j in ranges], pa.int32()), pa.array(data, pa.binary())], ["bucket", "id", "tie", "n", "data"])

    def documents(doc, tie, pos):
        """Known places, one row for each document."""
        first = np.flatnonzero(_starts(doc, tie))
        last = np.append(first[1:], len(doc))
        for at in range(0, len(first), 4096):
            f, e = first[at : at + 4096], last[at : at + 4096]
            data = [planes(_steps(pos[i:j])) for i, j in zip(f.tolist(), e.tolist(), strict=True)]
            bucket = (tx.mix(doc[f].view(np.uint64) ^ tie[f].view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
            yield pa.record_batch([pa.array(bucket), pa.array(doc[f]), pa.array(tie[f]), pa.array((e - f).astype(np.int32)), pa.array(data, pa.binary())], ["bucket", "id", "tie", "n", "data"])

    def run(batches):
        parts, held = [], 0
        for b in batches:
            for part in find(b):
                if len(part[1]):
                    parts.append(part)
                    held += len(part[1])
                if held >= HELD:
                    yield from send(parts)
                    parts, held = [], 0
        if parts:
            yield from send(parts)

    return run


def by_places(doc: np.ndarray, tie: np.ndarray, pos: np.ndarray) -> pa.RecordBatch:
    """Places, documents one after the other, as rows of PLACES."""
    new = _starts(doc, tie)
    new[1:] |= pos[1:] != pos[:-1] + 1
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(doc))).astype(np.int32)
    return pa.record_batch([pa.array(doc[first]), pa.array(tie[first]), pa.array(pos[first].astype(np.int32)), pa.array(n)], ["id", "tie", "pos", "n"])


def _answer(kind: str, lanes: int):
    """Over ROWs sorted by bucket: the places that count. Memory: one bucket."""
    types = [*[np.uint64] * lanes, np.int64, np.int64, np.int32, np.uint8]
    spared = 0 if kind == EARLIER else SPARED
    cuts = np.cumsum([np.dtype(t).itemsize - spared * (k < lanes) for k, t in enumerate(types)])[:-1]

    def column(raw, t, n):
        """A sent column; the bytes that weren't sent are zeros."""
        missing = np.dtype(t).itemsize * n - len(raw)
        return unplanes(np.concatenate([np.zeros(missing, np.uint8), raw]) if missing else raw, t, n)

    def decide(blocks):
        *keys, doc, tie, pos, ask = (np.concatenate(x) for x in zip(*blocks, strict=True))
        order = _sort(keys)
        begin = np.flatnonzero(_starts(*(k[order] for k in keys)))
        of = np.repeat(np.arange(len(begin)), np.diff(np.append(begin, len(doc))))
        yes = np.empty(len(doc), bool)
        yes[order] = _judge(kind, begin, of, doc[order], tie[order], pos[order])
        yes &= ask > 0
        return by_places(doc[yes], tie[yes], pos[yes])

    def run(batches):
        blocks, own = [], None
        for b in batches:
            known = b.column("id").is_valid().to_numpy(zero_copy_only=False)
            if known.any():
                part = b.filter(pa.array(known))
                n = part.column("n").to_numpy()
                pos = [np.cumsum(unplanes(np.frombuffer(x, np.uint8), np.int32, k), dtype=np.int32) for x, k in zip(part.column("data").to_pylist(), n.tolist(), strict=True)]
                yield by_places(*(np.repeat(part.column(k).to_numpy(), n) for k in ("id", "tie")), np.concatenate(pos))
            part = b.filter(pa.array(~known))
            for bucket, n, data in zip(*(part.column(k).to_pylist() for k in ("bucket", "n", "data")), strict=True):
                if blocks and bucket != own:
                    yield decide(blocks)
                    blocks = []
                own = bucket
                columns = [column(x, t, n) for x, t in zip(np.split(np.frombuffer(data, np.uint8), cuts * n), types, strict=True)]
                blocks.append([*columns[:lanes], *(np.cumsum(x, dtype=x.dtype) for x in columns[lanes:-1]), columns[-1]])
        if blocks:
            yield decide(blocks)

    return run


def repeated(rows: DataFrame, find, kind: str, lanes: int = 1) -> DataFrame:
    """PLACES of the occurrences that count; see ``settle``. find runs over the batches of ``rows``; it gives ``lanes`` key lanes."""
    n = partitions(rows.sparkSession)
    sent = rows.mapInArrow(settle(find, kind, BUCKETS * n), ROW)
    return sent.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(_answer(kind, lanes), PLACES)


def packed_pair(high: str, low: str):
    """Two small numbers as one, which takes a quarter of a struct's room in a list."""
    return F.shiftleft(F.col(high).cast("bigint"), 32).bitwiseOR(F.col(low).cast("bigint"))


def by_document(places: DataFrame) -> DataFrame:
    """One row for each (id, tie): its runs of places, about one for each token of its text at most."""
    return places.groupBy("id", "tie").agg(F.collect_list(packed_pair("pos", "n")).alias("places"))


def runs(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first numbers, second numbers, pairs in each row) of a column of lists of pairs; a null list has none."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False).astype(float)).astype(np.int64)
    both = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return both >> 32, both & 0xFFFFFFFF, sizes
