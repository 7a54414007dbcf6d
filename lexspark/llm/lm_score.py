"""Language-model scores from a log-frequency Bloom filter.

N-gram counts are quantised to powers of two; an n-gram of level q is entered q times, as
(n-gram, 1) to (n-gram, q), so membership probes that climb until one fails recover the level.
The filter is blocked by n-gram hash and grows with its entries: each block is filled by the task that
counted its n-grams. The blocks are broadcast while that is possible; past that the distinct n-grams of
each slice of documents go to their blocks and come back as levels. Probabilities are interpolated: a bigram's discounted share of its context, then the smoothed unigram.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as tx
from ._store import Store, partitions, table

#: Blocks at least, and 64-bit words in a block at most: the number of blocks follows the entries.
BLOCKS, BLOCK_WORDS = 256, 1 << 15
PROBES = 4
#: Bits for each entry, at every number of entries: the filter is a power of two of words, so 7.7 to 15.4 in effect. A filter
#: of more than BROADCAST_BYTES stays in rows, one for each block, and n-grams are brought to their block.
BITS_PER_ENTRY, BROADCAST_BYTES = 10, 64 << 20
#: Weight of the bigram's share; the rest is the unigram's.
BIGRAM_WEIGHT = 0.2
#: Words whose exact counts are broadcast, for ``base_score`` and ``n_known``: the most frequent ones, a fixed number. The others meet their counts in a join.
COMMON_WORDS = 1 << 17

END = tx.mix(np.array([0xE0D], np.uint64))[0]
BIGRAM = np.uint64(0x9FB21C651E98DF25)


def held_out(doc_id: Column, folds: int = 7, fold: int = 2) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold


def _tokens(column) -> tuple[np.ndarray, np.ndarray]:
    """(token hash, row): the words of each text, A-Z lower-cased, then one end."""
    data, offsets = tx.utf8(column)
    h, row = [], []
    for i, j in tx.steps(offsets):
        w, _, _, r = tx.word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], True)
        place = np.cumsum(np.bincount(r, minlength=j - i))
        h.append(np.insert(w, place, END))
        row.append(np.insert(r, place, np.arange(j - i)) + i)
    return (np.concatenate(h), np.concatenate(row)) if h else (np.zeros(0, np.uint64), np.zeros(0, np.int64))


def _bigrams(h: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Hash of (token before, token) for each token; a text's first token has the end before it."""
    before = np.empty_like(h)
    before[1:] = h[:-1]
    first = np.ones(len(h), bool)
    first[1:] = row[1:] != row[:-1]
    before[first] = END
    return tx.mix((before * BIGRAM) ^ h)


@dataclass
class CountFilter:
    """words: rows of 64-bit words, a power of two of them in each; one for each block from ``first`` on. bits: of a block's number."""

    words: np.ndarray
    bits: int
    first: int = 0

    def level(self, key: np.ndarray) -> np.ndarray:
        """Quantised level of each n-gram: the number of consecutive levels that answer yes."""
        out = np.zeros(len(key), np.int64)
        todo = np.arange(len(key))
        for q in range(1, 64):
            yes = np.ones(len(todo), bool)
            block, bits = place(key[todo], q, self.words.shape[1], self.bits)
            for b in bits:
                yes &= (self.words[block - self.first, b >> np.uint64(6)] >> (b & np.uint64(63))) & np.uint64(1) == 1
            todo = todo[yes]
            if not len(todo):
                break
            out[todo] = q
        return out


def block_of(key: np.ndarray, bits: int) -> np.ndarray:
    return (key >> np.uint64(64 - bits)).astype(np.int64)


def place(key: np.ndarray, q: int, words: int, bits: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(block, bit in the block for each probe) of an n-gram at a level; ``words`` of 64 bits in a block, 2**bits blocks."""
    x = tx.mix(key + np.uint64(q * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    y = tx.mix(x) | np.uint64(1)
    last = np.uint64(words * 64 - 1)
    return block_of(key, bits), [(x + np.uint64(i) * y) & last for i in range(PROBES)]


def levels(counts: np.ndarray) -> np.ndarray:
    """1 for a count of 1, 2 for 2 and 3, 3 for 4 to 7, ..."""
    return np.frexp(counts.astype(float))[1].astype(np.int64)


def count_ngrams(docs: DataFrame) -> DataFrame:
    """(kind, key, n): unigram (1) and bigram (2) counts of all rows, summed in each task before they are shuffled."""

    def squeeze(held):
        key = np.concatenate([k for k, _ in held])
        n = np.concatenate([c for _, c in held])
        order = np.argsort(key, kind="stable")
        key, n = key[order], n[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        return key[first], np.add.reduceat(n, first) if len(first) else n

    def run(batches):
        held = {1: [], 2: []}
        size = 0

        def flush():
            for kind, parts in held.items():
                if parts:
                    key, n = squeeze(parts)
                    for at in range(0, len(key), 100_000):
                        k = key[at : at + 100_000]
                        yield pa.record_batch({"kind": np.full(len(k), kind, np.int8), "key": k.view(np.int64), "n": n[at : at + 100_000]})
                held[kind] = []

        for b in (part for whole in batches for part in tx.slices(whole, "text")):
            h, row = _tokens(b.column("text"))
            for kind, keys in ((1, h), (2, _bigrams(h, row))):
                k, n = np.unique(keys, return_counts=True)
                held[kind].append((k, n.astype(np.int64)))
                size += len(k)
            if size > 2_000_000:
                before = size
                held = {kind: [squeeze(parts)] for kind, parts in held.items()}
                size = sum(len(p[0][0]) for p in held.values())
                if size > 1_500_000 or size > 0.8 * before:
                    yield from flush()
                    size = 0
        yield from flush()

    counts = docs.select("text").mapInArrow(run, "kind tinyint, key bigint, n bigint")
    return counts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


def filter_blocks(ngrams: DataFrame) -> tuple[DataFrame, int, int]:
    """(block, bits: a row for each block that has n-grams, filled where they are; 64-bit words in a block; bits of a block's number)."""
    entries = ngrams.agg(F.coalesce(F.sum(F.length(F.bin("n")).cast("bigint")), F.lit(0))).first()[0]
    wanted = max(64 * BLOCKS, entries * BITS_PER_ENTRY // 64)
    total = 1 << int(math.log2(wanted))
    total = total * 2 if wanted > 1.3 * total else total
    blocks = max(BLOCKS, total // BLOCK_WORDS)
    words, bits = total // blocks, int(math.log2(blocks))

    def fill(batches):
        blocks: dict[int, np.ndarray] = {}
        for b in batches:
            key, level = b.column("key").to_numpy().view(np.uint64), levels(b.column("n").to_numpy())
            for q in range(1, int(level.max(initial=0)) + 1):
                block, at = place(key[level >= q], q, words, bits)
                for k in np.unique(block):
                    own = blocks.setdefault(int(k), np.zeros(words, np.uint64))
                    mine = block == k
                    for x in at:
                        np.bitwise_or.at(own, (x[mine] >> np.uint64(6)).astype(np.int64), np.uint64(1) << (x[mine] & np.uint64(63)))
        for k, own in blocks.items():
            yield pa.record_batch({"block": pa.array([k], pa.int32()), "bits": pa.array([own.tobytes()], pa.binary())})

    # Four blocks in a task, so the tasks follow the entries too.
    block = F.shiftrightunsigned("key", 64 - bits).cast("int")
    placed = ngrams.select("key", "n", F.floor(block / 4).cast("int").alias("four"))
    return placed.repartition(blocks // 4, "four").select("key", "n").mapInArrow(fill, "block int, bits binary"), words, bits


def collect_filter(blocks: DataFrame, words: int, bits: int) -> CountFilter:
    out = np.zeros((1 << bits, words), np.uint64)
    for r in blocks.toLocalIterator():
        out[r.block] |= np.frombuffer(r.bits, np.uint64)
    return CountFilter(out, bits)


SENT = "slice bigint, block int, data binary"


def with_levels(docs: DataFrame, blocks: DataFrame, bits: int, store: Store, run, schema: str) -> DataFrame:
    """``run(slice of docs, levels)`` with the levels of the slice's distinct n-grams, looked up where their blocks are.

    A slice is sent as a row of its own (block -1) and a row of n-grams for each block; the blocks answer
    with a byte for each n-gram. Tasks stream sorted rows and hold one block, or one slice.
    """

    def send(batches):
        for b in (part for whole in batches for part in tx.slices(whole, "text")):
            h, row = _tokens(b.column("text"))
            keys = np.unique(np.concatenate([h, _bigrams(h, row)]))
            block = block_of(keys, bits)
            begin = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema) as out:
                out.write_batch(b)
            data = [sink.getvalue().to_pybytes(), *(k.tobytes() for k in np.split(keys, begin[1:]))]
            yield pa.record_batch({"slice": np.full(len(data), b.column("row_id")[0].as_py(), np.int64), "block": np.concatenate([[-1], block[begin]]).astype(np.int32), "data": pa.array(data, pa.binary())})

    def answer(batches):
        own, held = -1, None
        for b in batches:
            slices, out = b.column("slice"), []
            for i, (block, data) in enumerate(zip(b.column("block").to_pylist(), b.column("data"), strict=True)):
                data = np.frombuffer(data.as_buffer(), np.uint64)
                if not slices[i].is_valid:
                    own, held = block, CountFilter(data.reshape(1, -1).copy(), bits, block)
                else:
                    out.append((i, (held.level(data) if own == block else np.zeros(len(data))).astype(np.uint8).tobytes()))
            at = pa.array([i for i, _ in out], pa.int64())
            yield pa.record_batch({"slice": slices.take(at), "block": b.column("block").take(at), "data": pa.array([x for _, x in out], pa.binary())})

    def gather(batches):
        part, got = None, []

        def score():
            if part is not None:
                rows = pa.ipc.open_stream(part).read_all().combine_chunks().to_batches()[0]
                yield run(rows, np.frombuffer(b"".join(got), np.uint8).astype(np.int64))

        for b in batches:
            for block, data in zip(b.column("block").to_pylist(), b.column("data").to_pylist(), strict=True):
                if block == -1:
                    yield from score()
                    part, got = data, []
                else:
                    got.append(data)
        yield from score()

    n = max(1 << bits - 2, partitions(docs.sparkSession))
    sent = store.save(docs.withColumn("row_id", F.monotonically_increasing_id()).mapInArrow(send, SENT), "sent")
    asked = blocks.select(F.lit(None).cast("bigint").alias("slice"), "block", F.col("bits").alias("data")).unionByName(sent.where("block >= 0"))
    answers = asked.repartition(n, "block").sortWithinPartitions("block", F.asc_nulls_first("slice")).mapInArrow(answer, SENT)
    back = sent.where("block = -1").unionByName(answers).repartition(n, "slice").sortWithinPartitions("slice", "block")
    return back.mapInArrow(gather, schema)


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs`` (doc_id, text).

    Learns from the rows that are not held out. Null text is empty: its only token is the end. Rows
    are scored one by one, so repeated rows and ids are fine; a null doc_id counts as not held out.
    With no training rows, counts are 0 and N and V are 0. ``score`` is the model's log10
    probability: P(w|v) = BIGRAM_WEIGHT * c(vw)/c(v) + (1-BIGRAM_WEIGHT) * P(w), and P(w) alone after an unknown v, with
    P(w) = (c(w)+1)/(S+V+1). Its counts are the filter's at every size: c(w) the middle of the word's
    level, S the sum of these over all training words, c(vw) the least count of the bigram's level and c(v) the
    most of the context's. So the next words after a known or unknown v, and one unknown word, add up to one at most.
    """
    spark = docs.sparkSession
    store = Store(spark)
    docs = docs.select(F.col("doc_id"), F.col("text"), F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"))
    ngrams = store.save(count_ngrams(docs.where("not held_out")), "ngrams")
    words = ngrams.where("kind = 1").select("key", "n")
    middle = 1.5 * F.pow(F.lit(2.0), F.length(F.bin("n")) - 1) - 0.5  # of the level of a count, as the filter gives it
    totals = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("N"), F.count(F.lit(1)).alias("V"), F.coalesce(F.sum(middle), F.lit(0.0)).alias("S")).first()
    total, kinds, mass = int(totals.N), int(totals.V), float(totals.S)
    common = words.orderBy(F.desc("n"), "key").limit(COMMON_WORDS).toArrow().sort_by("key") if kinds else None
    keys = common["key"].to_numpy() if kinds else np.zeros(0, np.int64)
    counts = common["n"].to_numpy() if kinds else np.zeros(0, np.int64)
    exhaustive = kinds <= COMMON_WORDS
    blocks, size, bits = filter_blocks(ngrams)
    small = (size << bits) * 8 <= BROADCAST_BYTES
    shared = spark.sparkContext.broadcast((collect_filter(blocks, size, bits) if small else None, keys, counts))

    def run(b, found=None):
        """Scores of a slice; found: the levels of its distinct n-grams in order of their keys, where they were looked up."""
        lm, keys, counts = shared.value
        h, row = _tokens(b.column("text"))
        n = b.num_rows
        kind, back = np.unique(h, return_inverse=True)
        signed = kind.view(np.int64)
        at = np.minimum(np.searchsorted(keys, signed), max(len(keys) - 1, 0))
        exact = (keys[at] == signed) if len(keys) else np.zeros(len(kind), bool)
        known = np.where(exact, counts[at], 0) if len(keys) else np.zeros(len(kind), np.int64)
        pair, where = np.unique(_bigrams(h, row), return_inverse=True)
        if found is None:
            level, level2 = lm.level(kind), lm.level(pair)
        else:
            both = np.unique(np.concatenate([kind, pair]))
            level, level2 = found[np.searchsorted(both, kind)], found[np.searchsorted(both, pair)]
        estimate = np.where(level > 0, 1.5 * 2.0 ** np.maximum(level - 1, 0) - 0.5, 0)
        p_word = (estimate + 1) / (mass + kinds + 1)
        most = 2.0**level - (level > 0)
        before = np.empty_like(back)
        before[1:] = back[:-1]
        first = np.ones(len(h), bool)
        first[1:] = row[1:] != row[:-1]
        end = np.searchsorted(kind, END) if len(kind) else 0
        before[first] = end
        both = np.where(level2 > 0, 2.0 ** np.maximum(level2 - 1, 0), 0)[where]
        context = most[before]
        share = np.where(context > 0, np.minimum(both / np.maximum(context, 1), 1.0), 0.0)
        p = np.where(context > 0, BIGRAM_WEIGHT * share + (1 - BIGRAM_WEIGHT) * p_word[back], p_word[back])
        score = np.bincount(row, np.log10(p), n)
        sure = exact[back]
        logs = np.log10(known + 1.0)[back]
        # Words outside the broadcast table: (word, times in the row), for the exact join.
        rare_h, rare_row = h[~sure], row[~sure]
        order = np.lexsort((rare_h, rare_row))
        rare_h, rare_row = rare_h[order], rare_row[order]
        new = np.ones(len(rare_h), bool)
        new[1:] = (rare_h[1:] != rare_h[:-1]) | (rare_row[1:] != rare_row[:-1])
        begin = np.flatnonzero(new)
        times = np.diff(np.concatenate([begin, [len(rare_h)]])).astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(np.bincount(rare_row[begin], minlength=n))]).astype(np.int32)
        tf = pa.StructArray.from_arrays([pa.array(rare_h[begin].view(np.int64)), pa.array(times)], ["key", "tf"])
        return pa.record_batch({
            "doc_id": b.column("doc_id"), "held_out": b.column("held_out"), "n_tokens": np.bincount(row, minlength=n).astype(np.int64),
            "known": np.bincount(row, (sure & (known[back] > 0)), n).astype(np.int64), "logs": np.bincount(row, np.where(sure, logs, 0.0), n),
            "score": score, "rare": pa.ListArray.from_arrays(pa.array(ends), tf),
        })

    def here(batches):
        for whole in batches:
            yield from map(run, tx.slices(whole, "text"))

    schema = "doc_id bigint, held_out boolean, n_tokens bigint, known bigint, logs double, score double, rare array<struct<key: bigint, tf: int>>"
    ready = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "held_out", "text")
    scored = ready.mapInArrow(here, schema) if small else with_levels(ready, blocks, bits, store, run, schema)
    if not exhaustive:
        scored = store.save(scored.withColumn("row_id", F.monotonically_increasing_id()), "scored")
        rare = scored.select("row_id", F.explode("rare").alias("r")).select("row_id", "r.key", "r.tf").join(words, "key")
        rare = rare.groupBy("row_id").agg(F.sum("tf").alias("more"), F.sum(F.col("tf") * F.log10(F.col("n") + 1)).alias("more_logs"))
        scored = scored.drop("rare").join(rare, "row_id", "left")
    else:
        scored = scored.withColumns({"more": F.lit(0).cast("bigint"), "more_logs": F.lit(0.0)})
    each = math.log10(total + 1 * (kinds + 1))
    return scored.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(total).cast("bigint").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) - F.col("n_tokens") * F.lit(each)).alias("base_score"), "score",
    )


def op9_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, learning from those that are not held out. See ``score_documents``."""
    return score_documents(table(spark, sf_dir, "documents"))
