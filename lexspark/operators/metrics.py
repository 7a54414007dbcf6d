"""Quality measures as aggregates."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import rules
from ..functions import text as X
from .rank import ranked


def precision_at_1(cands: DataFrame, source: str, ranker: str = "srcrank", table: dict = rules.SOURCE_RANK) -> DataFrame:
    """n, hits, precision: entries of two candidates or more, one of them from ``source``. The source's tag is removed, its term stays; a hit has a tagged term first."""
    held = cands.withColumn("_ref", F.array_contains("sources", source)).withColumn("sources", F.array_remove("sources", source))
    per = Window.partitionBy("lemma")
    held = held.withColumn("_n", F.count(F.lit(1)).over(per)).withColumn("_any", F.max(F.col("_ref").cast("int")).over(per)).where("_n >= 2 and _any = 1")
    first = ranked(held, ranker, table).where("place = 1")
    hits = F.count_if("_ref")
    return first.agg(F.count(F.lit(1)).alias("n"), hits.alias("hits"), F.round(hits / F.greatest(F.lit(1), F.count(F.lit(1))), 6).alias("precision"))


def recall(counts: DataFrame, lexicon: DataFrame, n: int) -> DataFrame:
    """Of the top n tokens that can be words: share found in lexicon (token), by type and by count. The top is taken first."""
    top = counts.orderBy(F.desc("cnt"), "token").limit(n).where(F.col("token").rlike(r"\p{L}") & ~X.is_junk_lemma(F.col("token")))
    top = top.join(lexicon.select("token").distinct().withColumn("hit", F.lit(1)), "token", "left")
    good = F.col("hit").isNotNull()
    return top.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(good).alias("found"), F.round(100 * F.count_if(good) / F.greatest(F.lit(1), F.count(F.lit(1))), 6).alias("type_recall"),
        F.round(100 * F.coalesce(F.sum(F.when(good, F.col("cnt"))), F.lit(0)) / F.greatest(F.lit(1), F.coalesce(F.sum("cnt"), F.lit(0))), 6).alias("token_recall"),
    )


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, length of each)."""
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(raw, np.uint32).astype(np.int64), np.array([len(t) for t in texts], np.int64)


def _chrf(hyp: list[str], ref: list[str], orders: int, beta: float) -> np.ndarray:
    """The score of each pair. N-grams get exact numbers: that of the (n-1)-gram and the next code point make the n-gram's."""
    n = len(hyp)
    points, sizes = _code_points(hyp + ref)
    if not len(points):
        return np.zeros(n)
    _, points = np.unique(points, return_inverse=True)
    kinds = int(points.max()) + 1
    text = np.repeat(np.arange(2 * n), sizes)
    gram, total, count = np.zeros(len(points), np.int64), np.zeros(n), np.zeros(n)
    for k in range(orders):
        here = len(points) - k
        if here <= 0:
            break
        _, gram = np.unique(gram[:here] * kinds + points[k:], return_inverse=True)
        inside = text[:here] == text[k:]
        key = (text[:here][inside] % n) * (int(gram.max()) + 1) + gram[inside]
        keys, back = np.unique(key, return_inverse=True)
        of_ref = text[:here][inside] >= n
        common = np.minimum(np.bincount(back[~of_ref], minlength=len(keys)), np.bincount(back[of_ref], minlength=len(keys)))
        o = np.bincount(keys // (int(gram.max()) + 1), common, n)
        h, r = (np.maximum(sizes[i : i + n] - k, 0) for i in (0, n))
        both = (h > 0) & (r > 0)
        p, q = o / np.maximum(h, 1), o / np.maximum(r, 1)
        total += np.where(both & (o > 0), (1 + beta**2) * p * q / np.maximum(beta**2 * p + q, 1e-300), 0)
        count += both
    return 100 * total / np.maximum(count, 1)


def chrf(pairs: DataFrame, orders: int = 6, beta: float = 2.0) -> DataFrame:
    """(id, chrf) of pairs (id, hyp, ref): the mean over n-gram orders, where both sides have some, of the clipped n-gram F score, times 100; 0 for blank texts.

    Both texts of a pair are in one row, so they are counted where they are, batch by batch; nothing is shuffled.
    """
    norm = lambda c: F.lower(F.btrim(F.regexp_replace(F.regexp_replace(F.coalesce(c, F.lit("")), "[*@#]", ""), r"\s+", " ")))

    def score(batches):
        for b in batches:
            hyp, ref = b.column("hyp").to_pylist(), b.column("ref").to_pylist()
            done = [_chrf(hyp[i : i + 256], ref[i : i + 256], orders, beta) for i in range(0, len(hyp), 256)]
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(np.concatenate(done) if done else np.zeros(0))], ["id", "chrf"])

    kind = T.StructType([pairs.schema["id"], T.StructField("chrf", T.DoubleType())])
    return pairs.select("id", norm(F.col("hyp")).alias("hyp"), norm(F.col("ref")).alias("ref")).mapInArrow(score, kind).withColumn("chrf", F.round("chrf", 6))


def score_by_tag(scores: DataFrame, tags: DataFrame, low: float = 70.0) -> DataFrame:
    """tag, n, mean, flagged of scores (id, chrf) and tags (id, tag)."""
    out = scores.join(tags, "id").groupBy("tag").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("chrf"), 4).alias("mean"))
    return out.withColumn("flagged", F.col("mean") < low)


def flagged(scores: DataFrame, low: float = 70.0) -> DataFrame:
    """The scores (id, chrf, unknown array) under ``low`` or with unknown words."""
    return scores.where((F.col("chrf") < low) | (F.size("unknown") > 0))


def _counted(docs: DataFrame) -> DataFrame:
    """docs (doc_id, token) counted; those that have ``n`` (``frequency.token_runs``) are, and shuffling them again would gain little."""
    return docs.select("doc_id", "token", "n") if "n" in docs.columns else docs.groupBy("doc_id", "token").agg(F.count(F.lit(1)).alias("n"))


def token_coverage(docs: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """doc_id, n_words, n_known, unknown (distinct, sorted) of docs (doc_id, token, maybe n): tokens with a letter, known if vocabulary (token) has them."""
    words = _counted(docs.where(F.col("token").rlike(r"\p{L}")))
    out = words.join(vocabulary.select("token").distinct().withColumn("hit", F.lit(1)), "token", "left")
    n_known = F.coalesce(F.sum(F.when(F.col("hit") == 1, F.col("n"))), F.lit(0))
    return out.groupBy("doc_id").agg(F.sum("n").alias("n_words"), n_known.alias("n_known"), F.array_sort(F.array_distinct(F.collect_list(F.when(F.col("hit").isNull(), F.col("token"))))).alias("unknown"))


def failures(counts: DataFrame, vocabulary: DataFrame, translated: DataFrame) -> DataFrame:
    """counts (token, ...) with ``kind``: unknown to vocabulary (token), untranslated if only translated (token) lacks it, else null; layout words and numbers are no failures."""
    known = vocabulary.select("token").distinct().withColumn("_v", F.lit(1))
    done = translated.select("token").distinct().withColumn("_t", F.lit(1))
    kind = F.when(X.is_junk_lemma(F.col("token")), F.lit(None)).when(F.col("_v").isNull(), "unknown").when(F.col("_t").isNull(), "untranslated")
    return counts.join(known, "token", "left").join(done, "token", "left").withColumn("kind", kind).drop("_v", "_t")


def failure_audit(tokens: DataFrame, vocabulary: DataFrame, translated: DataFrame, k: int = 30) -> DataFrame:
    """The k most frequent failures of each kind and ending class: kind, class, place, token, cnt; rows (token)."""
    cls = F.coalesce(X.pos_by_ending(F.col("token")), F.lit("other"))
    counts = failures(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("cnt")), vocabulary, translated).where("kind is not null").withColumn("class", cls)
    place = F.row_number().over(Window.partitionBy("kind", "class").orderBy(F.desc("cnt"), "token"))
    return counts.withColumn("place", place).where(F.col("place") <= k).select("kind", "class", "place", "token", "cnt")


def article_errors(docs: DataFrame, vocabulary: DataFrame, translated: DataFrame) -> DataFrame:
    """doc_id, n_words, n_unknown, n_untranslated, error_rate (percent) of docs (doc_id, token, maybe n)."""
    words = failures(_counted(docs), vocabulary, translated)
    part = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    out = words.groupBy("doc_id").agg(F.sum("n").alias("n_words"), part("unknown").alias("n_unknown"), part("untranslated").alias("n_untranslated"))
    return out.withColumn("error_rate", F.round(100 * (F.col("n_unknown") + F.col("n_untranslated")) / F.col("n_words"), 4))


def lexicon_stats(cands: DataFrame, encyclopedia: str = "wikipedia") -> DataFrame:
    """One row: entries, candidates, multi, single-source, unsourced and encyclopedia-only counts."""
    per = cands.groupBy("lemma").agg(F.count(F.lit(1)).alias("n"), F.array_distinct(F.flatten(F.collect_list("sources"))).alias("s"))
    return per.agg(
        F.count(F.lit(1)).alias("entries"), F.sum("n").alias("candidates"), F.count_if(F.col("n") > 1).alias("multi"),
        F.count_if(F.size("s") == 1).alias("single_source"), F.count_if(F.size("s") == 0).alias("unsourced"),
        F.count_if((F.size("s") > 0) & F.forall("s", lambda x: x.contains(encyclopedia))).alias("encyclopedia_only"),
    )


def gap_stats(entries: DataFrame) -> DataFrame:
    """One row over entries (lemma, n_target, n_pivot): total, without target, of those with and without a pivot."""
    none = F.col("n_target") == 0
    return entries.agg(F.count(F.lit(1)).alias("total"), F.count_if(none).alias("without_target"), F.count_if(none & (F.col("n_pivot") > 0)).alias("pivot_only"), F.count_if(none & (F.col("n_pivot") == 0)).alias("bare"))


def histogram(rows: DataFrame, column: str) -> DataFrame:
    return rows.groupBy(F.coalesce(F.col(column), F.lit("none")).alias(column)).agg(F.count(F.lit(1)).alias("n"))


def merge_stats(current: DataFrame, new: DataFrame) -> DataFrame:
    """pos, added, skipped of the rows of new (lemma, pos) against current (lemma), case aside."""
    keys = current.select(F.lower("lemma").alias("_k")).distinct().withColumn("_hit", F.lit(1))
    out = new.join(keys, F.lower("lemma") == F.col("_k"), "left")
    return out.groupBy("pos").agg(F.count_if(F.col("_hit").isNull()).alias("added"), F.count_if(F.col("_hit") == 1).alias("skipped"))


def batch_metadata(entries: DataFrame) -> DataFrame:
    """One row over entries (n_terms, paradigm): total, with_translation, with_morphology."""
    return entries.agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("n_terms") > 0).alias("with_translation"), F.count_if(F.col("paradigm").isNotNull()).alias("with_morphology"))
