"""Substring deduplication with difference-cover anchors.

Short word sequences are hashed only at places that a difference cover modulo PERIOD holds. Any two
equal windows of words, wherever they stand, share an anchor at the same offset within them, so only
windows around an anchor that occurs twice are extended to their full length and compared.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as tx
from ._anchors import AGAIN, EARLIER, by_document, fresh, identified, repeated, runs
from ._store import Store, table

#: Every difference modulo 13 is one of two members of the cover.
PERIOD, COVER = 13, (0, 1, 3, 9)


def _words(b: pa.RecordBatch, lanes: int = 1):
    """(first row, last row, data, word hashes of each lane, starts, ends, rows, words in each row, their first) of each step of a batch."""
    data, offsets = tx.utf8(b.column("text"))
    for i, j in tx.steps(offsets):
        part, off = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        start, end, row = tx.word_bounds(part, off)
        count = np.bincount(row, minlength=j - i)
        yield i, j, part, tx.span_hashes(part, start, end, lanes), start, end, row, count, np.concatenate([[0], np.cumsum(count)])


def names(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, tie, whether no row before it has both) of each row."""
    ids, ties = b.column("id").to_numpy(), b.column("tie").to_numpy()
    return ids, ties, fresh(ids, ties)


def _anchors(window: int):
    size = window - PERIOD + 1

    def find(b):
        ids, ties, new = names(b)
        for i, _, _, (h,), _, _, row, count, first in _words(b):
            keys = tx.gram_hashes(h, size)
            place = (np.arange(len(h)) - first[row])[: len(keys)]
            at = np.flatnonzero(np.isin(np.arange(PERIOD), COVER)[place % PERIOD] & (row[: len(keys)] == row[size - 1 :][: len(keys)]) & (count[row[: len(keys)]] >= window) & new[row[: len(keys)] + i])
            yield [keys[at]], ids[row[at] + i], ties[row[at] + i], place[at], keys[at]

    return find


def window_hashes(words: list[np.ndarray], size: int, window: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(two lanes of the hash of the ``window`` words from each place on, made of those of the ``size``-grams that cover it; the least of its grams).

    Neighbouring windows mostly have the same least gram, so they are dealt to the same bucket.
    """
    out, m = [], len(words[0]) - window + 1
    for lane, w in enumerate(words):
        grams = tx.gram_hashes(w, size, lane)
        h = np.full(max(0, m), tx.LANES[lane])
        for k in (*range(0, window - size, size), window - size):
            h = tx.mix((h ^ grams[k : k + max(0, m)]) * tx.LANES[1 - lane])
        out.append(h)
        least = grams if lane == 0 else least
    return out, tx.sliding(least, window - size + 1, np.minimum) if m > 0 else np.zeros(0, np.uint64)


def _windows(window: int):
    size = window - PERIOD + 1

    def find(b):
        ids, ties, new = names(b)
        places, many, n = runs(b.column("places"))
        ends = np.concatenate([[0], np.cumsum(n)])
        for i, j, _, lanes, _, _, row, count, first in _words(b, 2):
            own = slice(ends[i], ends[j])
            if not ends[j] - ends[i]:
                continue
            owner = np.repeat(np.arange(j - i), n[i:j])
            # A window holds an anchor if it starts up to window-size words before it.
            low = np.maximum(places[own] - (window - size), 0)
            high = np.minimum(places[own] + many[own] - 1, count[owner] - window)
            mark = np.zeros(len(row) + 1, np.int64)
            good = high >= low
            np.add.at(mark, (first[owner] + low)[good], 1)
            np.add.at(mark, (first[owner] + high + 1)[good], -1)
            at = np.flatnonzero((np.cumsum(mark[:-1]) > 0) & new[row + i])
            keys, deal = window_hashes(lanes, size, window)
            yield [k[at] for k in keys], ids[row[at] + i], ties[row[at] + i], at - first[row[at]], deal[at]

    return find


def repeated_windows(docs: DataFrame, window: int, store: Store) -> DataFrame:
    """doc_id, id, tie, text of ``docs`` with the starts of repeated windows as ``places``, null for none."""
    if window < PERIOD:
        raise ValueError(f"windows of {PERIOD} words or more")
    docs = identified(docs, store)
    anchors = store.save(repeated(docs, _anchors(window), AGAIN), "anchors")
    near = docs.join(by_document(anchors), ["id", "tie"], "left")
    return docs.join(by_document(repeated(near, _windows(window), EARLIER, lanes=2)), ["id", "tie"], "left")


def remove_repeats(docs: DataFrame, window: int = 20) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text, for each row of ``docs`` (doc_id, text).

    A word goes if a window of ``window`` words covers it whose word sequence also starts earlier:
    in a smaller doc_id, or earlier in the same document. Windows are judged on the input. Kept words
    are joined by one space. Null, empty and wordless texts have no words. Rows that share doc_id and
    text are one document; each of them gets the same result. Rows that share a doc_id but not the
    text (or have none; a null doc_id sorts first) are documents of the same rank, which take nothing
    from each other. Other columns are ignored; an empty table gives no rows. Windows are compared
    by 128 bits, two lanes of independent word hashes.
    """
    found = repeated_windows(docs, window, Store(docs.sparkSession))

    def cut(batches):
        for b in batches:
            places, many, n = runs(b.column("places"))
            ends = np.concatenate([[0], np.cumsum(n)])
            data, offsets = tx.utf8(b.column("text"))
            for i, j in tx.steps(offsets):
                part = data[offsets[i] : offsets[j]]
                start, end, row = tx.word_bounds(part, offsets[i : j + 1] - offsets[i])
                count = np.bincount(row, minlength=j - i)
                first = np.concatenate([[0], np.cumsum(count)])
                own, owner = slice(ends[i], ends[j]), np.repeat(np.arange(j - i), n[i:j])
                mark = np.zeros(len(row) + 1, np.int64)
                np.add.at(mark, first[owner] + places[own], 1)
                np.add.at(mark, first[owner] + places[own] + many[own] - 1 + window, -1)
                keep = np.cumsum(mark[:-1]) == 0
                raw = part.tobytes()
                s, e = start.tolist(), end.tolist()
                kept = []
                for k in range(j - i):
                    alive = (np.flatnonzero(keep[first[k] : first[k + 1]]) + first[k]).tolist()
                    kept.append(b" ".join([raw[s[w] : e[w]] for w in alive]).decode())
                gone = np.concatenate([[0], np.cumsum(~keep)])
                ids = b.column("doc_id").slice(i, j - i)
                yield pa.record_batch({"doc_id": ids, "n_words": count.astype(np.int64), "n_removed": (gone[first[1:]] - gone[first[:-1]]).astype(np.int64), "kept_text": pa.array(kept, pa.string())})

    return found.mapInArrow(cut, "doc_id bigint, n_words bigint, n_removed bigint, kept_text string")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, windows of 20 words; kept text as its SHA-256. See ``remove_repeats``."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
