"""N-gram Jaccard join: documents whose sets of word n-grams are at least a threshold alike.

Rare-first prefix filtering: each set is put in a global order, rare n-grams first, and two sets
that are alike enough share an n-gram among their first ``n - ceil(t*n) + 1``. Sets meet on those
n-grams only, candidates pass the length filter, the positional filter and a suffix filter (a bound
on the Hamming distance of two sets from parity sketches), and each surviving pair is
verified once, on whole sets.

Hot n-grams: the order comes from a counting table of fixed size over all documents; equal sets
are folded to one representative before anything meets. In a run of more than WINDOW+1 sets with one
n-gram, each set meets the run's first and its WINDOW neighbours on either side. Links found so far give components;
afterwards only sets of such runs that are in different components still meet, so no link between
components is lost and no group's pairs are spelt out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import _text as tx
from ._graph import connected_components
from ._store import Store, partitions, table

#: Entries of the table of n-gram counts: fixed, so what is collected and broadcast is 1 MB at any input size.
FREQUENCY_BUCKETS = 1 << 18
WINDOW = 1


def _sets(batch: pa.RecordBatch, words: int, lane: int = 0) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, distinct grams, their row within the step)."""
    data, offsets = tx.utf8(batch.column("text"))
    for i, j in tx.steps(offsets):
        h, _, _, row = tx.word_hashes(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], True, lane)
        yield i, j, *tx.row_sets(*tx.row_grams(h, row, j - i, words, lane))


def gram_frequencies(docs: DataFrame, words: int) -> np.ndarray:
    """Documents per bucket of n-grams, over all documents."""

    def count(batches):
        total = np.zeros(FREQUENCY_BUCKETS, np.int64)
        for b in batches:
            for _, _, grams, _ in _sets(b, words):
                total += np.bincount((grams % np.uint64(FREQUENCY_BUCKETS)).astype(np.int64), minlength=FREQUENCY_BUCKETS)
        found = np.flatnonzero(total)
        yield pa.record_batch({"bucket": found.astype(np.int32), "n": total[found]})

    rows = docs.select("text").mapInArrow(tx.lean(count), "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(FREQUENCY_BUCKETS, np.int64)
    out[rows["bucket"].to_numpy()] = rows["n"].to_numpy()
    return np.minimum(out, 2**31 - 1).astype(np.int32)


def profiles(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, n, f1, f2 (128-bit hash of the set), sketch (parities), prefix (rare first)."""
    shared = docs.sparkSession.sparkContext.broadcast(gram_frequencies(docs, words))

    def profile(batches):
        freq = shared.value
        for b in batches:
            for i, j, grams, owner in _sets(b, words):
                m = j - i
                n = np.bincount(owner, minlength=m)
                first = np.concatenate([[0], np.cumsum(n)])
                has = np.flatnonzero(n)
                f = np.zeros((2, m), np.uint64)
                if len(has):
                    f[0][has] = np.add.reduceat(tx.mix(grams + np.uint64(1)), first[has])
                    f[1][has] = np.add.reduceat(tx.mix(grams ^ np.uint64(0x5851F42D4C957F2D)), first[has])
                bits = sketch_bits(n)
                base = np.concatenate([[0], np.cumsum(bits)])
                place = base[owner] + (grams & (bits[owner] - 1).astype(np.uint64)).astype(np.int64)
                parity = (np.bincount(place, minlength=base[-1]) & 1).astype(np.uint8)
                sketch = pa.ListArray.from_arrays(pa.array((base // 64).astype(np.int32)), pa.array(np.packbits(parity).view(np.int64)))
                order = np.lexsort((grams, freq[(grams % np.uint64(FREQUENCY_BUCKETS)).astype(np.int64)], owner))
                keep = np.where(n > 0, n - (percent * n + 99) // 100 + 1, 0)
                pos = np.arange(len(grams)) - first[owner]
                chosen = grams[order][pos < keep[owner]].view(np.int64)
                offsets = np.concatenate([[0], np.cumsum(keep)]).astype(np.int32)
                yield pa.record_batch({
                    "doc_id": b.column("doc_id").slice(i, m), "n": n.astype(np.int64), "f1": f[0].view(np.int64), "f2": f[1].view(np.int64),
                    "sketch": sketch, "prefix": pa.ListArray.from_arrays(pa.array(offsets), pa.array(chosen)),
                })

    schema = "doc_id bigint, n bigint, f1 bigint, f2 bigint, sketch array<bigint>, prefix array<bigint>"
    return docs.mapInArrow(tx.lean(profile), schema)


def _fit(percent: int, nx, ny, px, py):
    """Length and positional filter: can sets of these sizes, with a common element at these places, be alike enough?"""
    most = np.minimum(px, py) + 1 + np.minimum(nx - px, ny - py) - 1
    return (100 * np.minimum(nx, ny) >= percent * np.maximum(nx, ny)) & ((100 + percent) * most >= percent * (nx + ny))


def _meet(percent: int):
    """Over postings sorted by (gram, pos, n, id): candidate pairs (hot false) and the postings of long runs (hot true)."""
    keep = WINDOW + 1

    def out(hot, a, b, g, n, pos):
        return pa.record_batch({"hot": pa.array(np.full(len(a), hot)), "a": a, "b": b, "g": g, "n": n, "pos": pos})

    def run(batches):
        tail = {k: np.zeros(0, np.int64) for k in ("g", "id", "n", "pos", "at")}
        lead = None  # the first posting of the run that the tail ends in
        for batch in batches:
            if not batch.num_rows:
                continue
            c = {k: np.concatenate([tail[k], batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64)]) for k in ("g", "id", "n", "pos")}
            t, size = len(tail["g"]), len(c["g"])
            begin = np.ones(size, bool)
            begin[1:] = c["g"][1:] != c["g"][:-1]
            begin[:t] = False
            if t:
                begin[t] = c["g"][t] != c["g"][t - 1]
            i = np.arange(size)
            start = np.maximum.accumulate(np.where(begin, i, -1))
            at = np.where(start >= 0, i - start, i - t + (tail["at"][-1] + 1 if t else 0))
            at[:t] = tail["at"]
            pairs = []
            for d in range(1, WINDOW + 1):
                y = np.flatnonzero((at >= d) & (i >= t) & (i >= d))
                pairs.append((c["id"][y - d], c["id"][y], c["n"][y - d], c["n"][y], c["pos"][y - d], c["pos"][y]))
            y = np.flatnonzero((at > WINDOW) & (i >= t))
            if len(y):
                s = start[y]
                first = [np.where(s >= 0, c[k][s], lead[k] if lead else 0) for k in ("id", "n", "pos")]
                pairs.append((first[0], c["id"][y], first[1], c["n"][y], first[2], c["pos"][y]))
                z = y[at[y] == keep]
                hot = np.concatenate([y, *[z - d for d in range(1, keep + 1)]])
                yield out(True, c["id"][hot], c["id"][hot], c["g"][hot], c["n"][hot], c["pos"][hot])
            a, b, na, nb, pa_, pb = (np.concatenate(x) for x in zip(*pairs, strict=True))
            good = _fit(percent, na, nb, pa_, pb) & (a != b)
            if good.any():
                a, b = np.minimum(a, b)[good], np.maximum(a, b)[good]
                zero = np.zeros(len(a), np.int64)
                yield out(False, a, b, zero, zero, zero)
            if start[-1] >= 0:
                lead = {k: c[k][start[-1]] for k in ("id", "n", "pos")}
            tail = {k: v[-keep:] for k, v in c.items()} | {"at": at[-keep:]}

    return run


def sketch_bits(n: np.ndarray) -> np.ndarray:
    """Bits in the sketch of a set of n: the power of two in n/2 to n, 64 at least. Sketches of alike sets differ by one doubling at most."""
    return np.maximum(64, 1 << np.maximum(0, np.frexp(np.maximum(n, 1).astype(float))[1] - 1)).astype(np.int64)


def _suffix_filter(percent: int, x: str, y: str):
    """The sketches' Hamming distance bounds that of the sets from below. A longer sketch is folded: a shorter one's bit is the sum of those of the longer one at its place modulo the shorter size."""
    a, b = F.col(f"{x}.sketch"), F.col(f"{y}.sketch")

    def fold(s, size):
        parts = lambda i: F.aggregate(F.sequence(i, F.size(s) - 1, size), F.lit(0).cast("bigint"), lambda acc, k: acc.bitwiseXOR(F.get(s, k)))
        return F.when(F.size(s) > size, F.transform(F.sequence(F.lit(0), size - 1), parts)).otherwise(s)

    least = F.least(F.size(a), F.size(b))
    apart = F.aggregate(F.zip_with(fold(a, least), fold(b, least), lambda p, q: F.bit_count(p.bitwiseXOR(q))), F.lit(0), lambda acc, v: acc + v)
    return (100 + percent) * apart <= (100 - percent) * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets are alike enough. Texts meet their pairs in two joins."""

    def sets(batch, column):
        out = []
        for i, j, grams, owner in _sets(pa.record_batch({"text": batch.column(column)}), words, 1):  # hashes that the candidates weren't found by
            out += np.split(grams, np.cumsum(np.bincount(owner, minlength=j - i))[:-1])
        return out

    def verify(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                batch = whole.slice(at, 64)
                good = []
                for x, y in zip(sets(batch, "ta"), sets(batch, "tb"), strict=True):
                    n = len(np.intersect1d(x, y, assume_unique=True))
                    good.append(100 * n >= percent * (len(x) + len(y) - n) > 0)
                yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    # Only the texts of pairs go on: with few pairs their ids are broadcast and no text is shuffled.
    texts = docs.join(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "doc_id", "left_semi").select("doc_id", "text")
    both = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
    return both.mapInArrow(tx.lean(verify), "a bigint, b bigint").distinct()


def jaccard_components(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_shingles, class_id, component_id.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a set is the distinct n-grams, or the whole
    word sequence where there are fewer than n words. Two sets link when
    100 * intersection >= percent * union. class_id is the smallest doc_id with the same set,
    component_id the smallest reachable by links. Null and wordless texts have an empty set, link with
    nothing and keep their own id. Rows that share a doc_id are one node. A row without a doc_id takes no
    part in links; its class is that of its set, if a document has the same. Other columns of ``docs`` are ignored; an empty table gives no rows.
    Candidates are found by 64-bit hashes of n-grams and verified from their texts by other, independent ones; equal sets are told by 128 bits.
    """
    if not 1 <= percent <= 100:
        raise ValueError("a percentage from 1 to 100")
    spark = docs.sparkSession
    store = Store(spark)
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    prof = store.save(profiles(docs, words, percent), "profiles")
    sets = prof.where("n > 0 and doc_id is not null")
    classes = store.save(sets.groupBy("f1", "f2", "n").agg(F.min("doc_id").alias("class_id")), "classes")
    # One profile for each class: a class's smallest id names its rows; equal sets have equal profiles.
    heads = store.save(sets.join(classes.select("class_id", "f1", "f2", "n"), (sets.doc_id == classes.class_id) & (sets.f1 == classes.f1) & (sets.f2 == classes.f2)).select(sets.doc_id.alias("id"), sets.n, "sketch", "prefix"), "heads")
    postings = heads.select(F.posexplode("prefix").alias("pos", "g"), "id", "n").select("g", "id", "n", F.col("pos").cast("bigint").alias("pos"))
    met = postings.repartition(partitions(spark), "g").sortWithinPartitions("g", "pos", "n", "id")
    met = store.save(met.mapInArrow(tx.lean(_meet(percent)), "hot boolean, a bigint, b bigint, g bigint, n bigint, pos bigint"), "met")
    traits = heads.drop("prefix")
    pairs = met.where("not hot").select("a", "b").distinct()
    pairs = pairs.join(traits.alias("x"), F.col("a") == F.col("x.id")).join(traits.alias("y"), F.col("b") == F.col("y.id"))
    pairs = store.save(pairs.where(_suffix_filter(percent, "x", "y")).select("a", "b"), "pairs")
    links = store.save(_verified(pairs, docs, words, percent), "links")
    so_far = store.save(connected_components(links, store), "so_far")
    # Sets of long runs that are still apart.
    hot = met.where("hot").select("g", F.col("a").alias("id"), "pos")
    hot = hot.join(so_far, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = hot.groupBy("g").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("g")
    hot = store.save(hot.join(mixed, "g", "left_semi"), "hot")
    # Two sets meet on each n-gram that they share; only the first of those in the global order makes a pair.
    shared = hot.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "g"))), lambda r: r["g"]).alias("shared"))
    hot = store.save(hot.join(traits.join(shared, "id"), "id"), "hot")
    most = F.least("x.pos", "y.pos") + F.least(F.col("x.n") - F.col("x.pos"), F.col("y.n") - F.col("y.pos"))
    fit = (100 * F.least("x.n", "y.n") >= percent * F.greatest("x.n", "y.n")) & ((100 + percent) * most >= percent * (F.col("x.n") + F.col("y.n")))
    first = F.get(F.array_intersect("x.shared", "y.shared"), F.lit(0)) == F.col("x.g")
    x, y = hot.alias("x"), hot.alias("y")
    rest = x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component")) & fit & first & _suffix_filter(percent, "x", "y"))
    rest = store.save(rest.select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct(), "rest")
    more = store.save(_verified(rest, docs, words, percent), "more")
    parts = connected_components(links.union(more), store).withColumnRenamed("id", "class_id")
    member = prof.select("doc_id", "n", "f1", "f2").join(classes, ["f1", "f2", "n"], "left")
    member = member.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("class_id", "doc_id").alias("class_id"))
    return member.join(parts, "class_id", "left").select("doc_id", "n_shingles", "class_id", F.coalesce("component", "class_id").alias("component_id"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text of ``documents``, three words, 90 percent. See ``jaccard_components``."""
    return jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)
