"""Corpus statistics: token counts, global ranks, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..storage import saved


def tokens(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per token; the other columns of ``docs`` stay."""
    return docs.withColumn("token", F.explode(X.words(F.col(text)))).drop(text)


def token_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per distinct token of a row, with ``n``, how often the row has it; the other columns of ``docs`` stay. Counted within the row, so nothing is shuffled."""
    def runs(w):
        starts = F.filter(F.transform(w, lambda t, i: F.struct(t.alias("token"), i.alias("at"))), lambda x: (x["at"] == 0) | (F.get(w, x["at"] - 1) != x["token"]))
        size = lambda s, i: F.coalesce(F.get(s, i + 1)["at"], F.size(w)) - F.get(s, i)["at"]
        return X.let(starts, lambda s: F.transform(s, lambda x, i: F.struct(x["token"].alias("token"), size(s, i).cast("bigint").alias("n"))))

    return docs.withColumn("_r", F.explode(X.let(F.sort_array(X.words(F.col(text))), runs))).drop(text).select("*", "_r.token", "_r.n").drop("_r")


def token_counts(docs: DataFrame) -> DataFrame:
    return tokens(docs.select("text")).groupBy("token").agg(F.count(F.lit(1)).alias("cnt"))


def rank_tokens(counts: DataFrame) -> DataFrame:
    """token, cnt, rank: 1..N by count, then token.

    No task holds the global order: the tokens are dealt by range, sorted within each range and saved with
    their place in it; a range's offset is the number of tokens in the ranges before it. Only as many rows
    as ranges go through one task.
    """
    parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = (F.desc("cnt"), F.asc("token"))
    dealt = counts.select("token", "cnt").repartitionByRange(parts, *order).sortWithinPartitions(*order)
    # The number holds the range in its upper bits and the place within it in the lower 33.
    dealt = saved(dealt.withColumn("_at", F.monotonically_increasing_id()), "ranks").withColumn("_part", F.shiftright("_at", 33))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return dealt.join(sizes.select("_part", before.alias("_before")), "_part").select("token", "cnt", (F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1).alias("rank"))


def top_tokens(counts: DataFrame, n: int) -> DataFrame:
    return counts.orderBy(F.desc("cnt"), "token").limit(n)


def top_ranks(counts: DataFrame, n: int) -> DataFrame:
    """token, cnt, rank of the first n tokens; only n rows are ranked, however many tokens there are."""
    return top_tokens(counts, n).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("cnt"), "token")))


def missing_tokens(counts: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """The top n tokens that ``known`` (token) lacks."""
    return top_tokens(counts, n).join(known.select("token").distinct(), "token", "left_anti")


def coverage(counts: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """One row: n_top, n_missing, coverage."""
    top = top_tokens(counts, n).join(known.select("token").distinct().withColumn("hit", F.lit(1)), "token", "left")
    missing = F.count_if(F.col("hit").isNull())
    return top.agg(F.count(F.lit(1)).alias("n_top"), missing.alias("n_missing"), F.round(1 - missing / F.greatest(F.lit(1), F.count(F.lit(1))), 6).alias("coverage"))


def largest_documents(docs: DataFrame, k: int, least_words: int = 200) -> DataFrame:
    """The k documents with most words that are no redirects, by (words, title, text) descending; columns title, n_words."""
    docs = docs.where(~F.lower(F.btrim(F.coalesce("text", F.lit("")))).rlike("^#(redirect|alidirektilo)"))
    sized = docs.withColumn("n_words", F.size(F.filter(F.split("text", r"\s+"), lambda w: w != "")).cast("bigint"))
    return sized.where(F.col("n_words") >= least_words).orderBy(F.desc("n_words"), F.desc("title"), F.desc("text")).limit(k).select("title", "n_words")
