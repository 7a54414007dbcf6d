"""Toxicity by a classifier chain.

Categories are predicted one after the other by logistic models on words; the log-odds of the
earlier categories are features of the later ones. While fitting, those come from out-of-fold
predictions, so a later model learns from probabilities of the kind it will meet.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text as tx
from ._store import Store, table

#: (category, label column, label value that means yes), in the chain's order.
CATEGORIES = (("low_quality", "quality", 0), ("toxic", "toxic", 1))
#: At most about so many labelled rows are fitted on, chosen by a hash of their id.
FIT_ROWS = 40_000
#: Words kept for each category: those whose presence tells most, by the likelihood ratio statistic.
WORDS_PER_CATEGORY, LEAST_G2 = 2048, 12.0
FOLDS = 3

_LETTER = np.zeros(256, bool)
_LETTER[128:] = _LETTER[48:58] = _LETTER[65:91] = _LETTER[97:123] = True


def _row_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of each run of letters and digits, A-Z lower-cased."""
    plain = np.where(_LETTER[data], data, np.uint8(32))
    h, _, _, row = tx.word_hashes(plain, offsets, True)
    return h, row


def _presence(column) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (word, row) of a text column, sorted by row."""
    data, offsets = tx.utf8(column)
    out = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for i, j in tx.steps(offsets):
        h, row = tx.row_sets(*_row_words(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
        out.append((h, row + i))
    return np.concatenate([x for x, _ in out]), np.concatenate([x for _, x in out])


@dataclass
class Chain:
    """words: sorted hashes; one (bias, word weights, weights of the earlier categories) for each category."""

    categories: tuple
    words: np.ndarray
    models: list[tuple[float, np.ndarray, np.ndarray]]
    #: For each category the probability from which on it counts as a yes: the best F1 of the out-of-fold predictions.
    thresholds: list[float]

    def features(self, h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(word index, row) of the words that the models know."""
        if not len(self.words):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        seen = np.zeros(1 << 16, bool)
        seen[self.words >> np.uint64(48)] = True
        near = seen[h >> np.uint64(48)]
        h, row = h[near], row[near]
        at = np.minimum(np.searchsorted(self.words, h), len(self.words) - 1)
        hit = self.words[at] == h
        return at[hit], row[hit]

    def predict(self, at: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
        """Log-odds, one row for each category."""
        out = np.zeros((len(self.models), n))
        for k, (bias, weights, earlier) in enumerate(self.models):
            out[k] = bias + np.bincount(row, weights[at], n) + (earlier @ _squash(out[:k]) if k else 0.0)
        return out


def _squash(odds: np.ndarray) -> np.ndarray:
    return np.clip(odds, -6, 6)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _fit(at, row, dense, y, words: int, steps: int = 250, ridge: float = 0.5):
    """Ridge-penalised logistic regression on word presence and dense columns, by accelerated gradient steps."""
    n = len(y)
    if not n:
        return 0.0, np.zeros(words), np.zeros(len(dense))
    per_row = np.bincount(row, minlength=n).astype(float)
    theta = np.zeros(words + len(dense) + 1)
    share = np.clip(y.mean(), 1e-4, 1 - 1e-4)
    theta[-1] = np.log(share / (1 - share))
    count = np.bincount(at, minlength=words)
    # Diagonal scaling: a rare word moves as fast as a common one.
    scale = np.concatenate([1 / (0.25 * count + ridge), [1 / (0.25 * (d**2).sum() + ridge) for d in dense], [1 / (0.25 * n)]])
    scale /= 1 + max(1.0, np.percentile(per_row, 99.9)) / 2
    last, momentum = theta.copy(), 1.0
    for _ in range(steps):
        p = _sigmoid(np.bincount(row, theta[:words][at], n) + theta[words:-1] @ dense + theta[-1]) - y
        grad = np.concatenate([np.bincount(at, p[row], words) + ridge * theta[:words], dense @ p + ridge * theta[words:-1], [p.sum()]])
        new = theta - scale * grad
        after = (1 + (1 + 4 * momentum**2) ** 0.5) / 2
        theta, last, momentum = new + (momentum - 1) / after * (new - last), new, after
    return float(last[-1]), last[:words], last[words:-1]


def _out_of_fold(at, row, dense, y, fold, words):
    out = np.zeros(len(y))
    for k in range(FOLDS):
        train = fold != k
        place = np.cumsum(train) - 1
        keep = train[row]
        bias, weights, earlier = _fit(at[keep], place[row[keep]], dense[:, train], y[train], words)
        out += np.where(train, 0.0, bias + np.bincount(row, weights[at], len(y)) + earlier @ dense)
    return out


def _best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """Where F1 is best, between 0.25 and 0.75; 0.5 without a yes to learn from."""
    if not y.sum():
        return 0.5
    cuts = np.linspace(0.25, 0.75, 51)
    yes = p[None, :] >= cuts[:, None]
    f1 = 2 * (yes * y).sum(1) / np.maximum(yes.sum(1) + y.sum(), 1)
    return float(cuts[np.flatnonzero(f1 == f1.max())].mean())


def fit_chain(docs: DataFrame, labels: DataFrame, categories=CATEGORIES, fit_rows: int = FIT_ROWS) -> Chain:
    """A chain fitted on about ``fit_rows`` labelled documents at most; null labels and texts are left out.
    Where labels of one doc_id differ, the least count.

    Only that bounded sample is broadcast, stored and, as word indices, collected. No labels at all
    give models that always answer no.
    """
    store = Store(docs.sparkSession)
    columns = [c for _, c, _ in categories]
    labels = labels.select("doc_id", *columns).dropna().groupBy("doc_id").agg(F.min(F.struct(*columns)).alias("label")).select("doc_id", "label.*")
    share = min(1.0, fit_rows / max(1, labels.count()))
    chosen = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    yes = [F.expr(f"int({c} = {v})").alias(k) for k, c, v in categories]
    sample = store.save(docs.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", *yes), "sample")
    names = [k for k, _, _ in categories]

    def count(batches):
        for b in batches:
            h, row = _presence(b.column("text"))
            hits = [b.column(k).to_numpy().astype(np.int64)[row] for k in names]
            words, back = np.unique(h, return_inverse=True)
            sums = [np.bincount(back, x, len(words)).astype(np.int64) for x in [np.ones(len(h)), *hits]]
            yield pa.record_batch([pa.array(words.view(np.int64)), *map(pa.array, sums)], ["word", "n", *names])

    totals = sample.agg(F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in names]).first()
    stats = sample.mapInArrow(tx.lean(count), f"word bigint, n bigint, {', '.join(f'{k} bigint' for k in names)}").groupBy("word").agg(*[F.sum(c).alias(c) for c in ["n", *names]])
    stats = store.save(stats.where("n >= 3"), "stats")
    words: set[int] = set()
    for k in names:
        a, n, t, y = F.col(k).cast("double"), F.col("n").cast("double"), float(totals.n), float(totals[k])
        cell = lambda o, e: F.when(o > 0, o * F.log(o / e)).otherwise(0.0)
        if 0 < y < t:
            g2 = 2 * (cell(a, n * y / t) + cell(n - a, n * (t - y) / t) + cell(y - a, (t - n) * y / t) + cell(t - n - (y - a), (t - n) * (t - y) / t))
            words |= {r.word for r in stats.select("word", g2.alias("g2")).where(F.col("g2") >= LEAST_G2).orderBy(F.desc("g2"), "word").limit(WORDS_PER_CATEGORY).collect()}
    known = np.sort(np.array(sorted(words), np.int64).view(np.uint64))
    chain = Chain(tuple(names), known, [], [])

    def index(batches):
        for b in batches:
            at, row = chain.features(*_presence(b.column("text")))
            ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b.num_rows))]).astype(np.int32)
            yield pa.record_batch([b.column("doc_id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(at.astype(np.int32))), *[b.column(k) for k in names]], ["doc_id", "at", *names])

    got = sample.mapInArrow(tx.lean(index), f"doc_id bigint, at array<int>, {', '.join(f'{k} int' for k in names)}").toArrow().sort_by("doc_id")
    lists = got["at"].combine_chunks() if got.num_rows else pa.array([], pa.list_(pa.int32()))
    sizes = np.diff(lists.offsets.to_numpy()) if got.num_rows else np.zeros(0, np.int64)
    at, row = lists.flatten().to_numpy().astype(np.int64), np.repeat(np.arange(got.num_rows), sizes)
    fold = (tx.mix(got["doc_id"].to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(int) if got.num_rows else np.zeros(0, int)
    dense = np.zeros((0, got.num_rows))
    for k in names:
        y = got[k].to_numpy().astype(float)
        chain.models.append(_fit(at, row, dense, y, len(known)) if len(y) else (-20.0, np.zeros(len(known)), np.zeros(len(dense))))
        odds = _out_of_fold(at, row, dense, y, fold, len(known))
        chain.thresholds.append(_best_threshold(_sigmoid(odds), y))
        dense = np.vstack([dense, _squash(odds)])
    store.drop(sample, stats)
    return chain


def score_chain(docs: DataFrame, chain: Chain) -> DataFrame:
    """``docs`` with one probability ``p_<category>`` for each category. Null text has no words. Same-named columns are replaced."""
    names = [f"p_{k}" for k in chain.categories]
    docs = docs.drop(*names)
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches):
        for b in batches:
            model = shared.value
            p = _sigmoid(model.predict(*model.features(*_presence(b.column("text"))), b.num_rows))
            yield pa.RecordBatch.from_arrays([*b.columns, *map(pa.array, p)], [*b.schema.names, *names])

    return docs.mapInArrow(tx.lean(run), T.StructType([*docs.schema.fields, *[T.StructField(k, T.DoubleType()) for k in names]]))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its probability of each category and whether it is rejected; the chain is fitted on ``labels``. See ``fit_chain``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    chain = fit_chain(docs, table(spark, sf_dir, "labels"))
    out = score_chain(docs, chain).drop("text")
    return out.withColumn("rejected", F.col("p_toxic") >= chain.thresholds[-1])
