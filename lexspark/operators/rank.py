"""Choosing and ordering candidates. Rows: lemma, term, sources array, idx (insertion order)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as X
from ..functions.likeness import ratio


def pick_best(cands: DataFrame, table: dict = rules.SOURCE_RANK, default: int = rules.DEFAULT_RANK) -> DataFrame:
    """lemma, term: the least (source rank, position)."""
    return cands.groupBy("lemma").agg(F.min_by("term", F.struct(X.source_rank(F.col("sources"), table, default), "idx")).alias("term"))


def confidence(table: dict = rules.SOURCE_RANK, corroboration: bool = True, cognate: bool = False) -> Column:
    """A candidate's display score: reliability first, then corroboration, then likeness to the lemma."""
    score = -10.0 * X.source_rank(F.col("sources"), table)
    if corroboration:
        score = score + F.least(F.size(F.array_distinct("sources")), F.lit(4))
    if cognate:
        score = score + 6.0 * ratio(F.col("lemma"), F.col("term"))
    return score


#: Rankers give a column that orders a lemma's candidates, best first.
RANKERS = {
    "insertion": lambda table: F.lit(0.0),
    "srcrank": lambda table: X.source_rank(F.col("sources"), table).cast("double"),
    "srcrank_corr": lambda table: -confidence(table),
    "confidence": lambda table: -confidence(table, cognate=True),
}


def ranked(cands: DataFrame, ranker: str = "srcrank", table: dict = rules.SOURCE_RANK) -> DataFrame:
    """cands with ``place`` 1..n within each lemma; ties keep insertion order."""
    scored = cands.withColumn("_s", RANKERS[ranker](table))
    return scored.withColumn("place", F.row_number().over(Window.partitionBy("lemma").orderBy("_s", "idx"))).drop("_s")


def winner_diff(cands: DataFrame, old: dict, new: dict) -> DataFrame:
    """Lemmas with several candidates whose winner differs under two rank tables: one pass over the candidates."""
    win = lambda t: F.min_by("term", F.struct(X.source_rank(F.col("sources"), t), "idx"))
    out = cands.groupBy("lemma").agg(F.count(F.lit(1)).alias("n"), win(old).alias("old_term"), win(new).alias("new_term"))
    return out.where("n >= 2 and old_term != new_term").select("lemma", "old_term", "new_term")


def demote(cands: DataFrame, ending: str, base_ending: str, lemma_ends: str, lemma_not: str) -> DataFrame:
    """A term in -ending goes behind the others if the same stem in -base_ending is a candidate too.

    Only for lemmas that match ``lemma_ends`` and not ``lemma_not``. idx is numbered anew.
    """
    lemma, key = F.lower("lemma"), X.casefold(F.col("term"))
    cands = cands.withColumn("_all", F.collect_set(key).over(Window.partitionBy("lemma")))
    twin = F.concat(F.regexp_replace(key, f"{ending}$", ""), F.lit(base_ending))
    low = lemma.rlike(lemma_ends) & ~lemma.rlike(lemma_not) & key.endswith(ending) & F.array_contains("_all", twin)
    return cands.withColumn("idx", F.row_number().over(Window.partitionBy("lemma").orderBy(low.cast("int"), "idx")) - 1).drop("_all")


def best_entry(entries: DataFrame) -> DataFrame:
    """Per lemma the entry (pos, paradigm, ord) whose paradigm tells most, the first at a tie."""
    out = entries.groupBy("lemma").agg(F.max_by(F.struct("pos", "paradigm"), F.struct(X.paradigm_priority(F.col("paradigm")), -F.col("ord"))).alias("b"))
    return out.select("lemma", "b.pos", "b.paradigm")


def order_terms(cands: DataFrame, table: dict = rules.SOURCE_RANK) -> DataFrame:
    """lemma, terms: joined in display order."""
    listed = F.array_sort(F.collect_list(F.struct(X.source_rank(F.col("sources"), table).alias("r"), "idx", "term")))
    return cands.groupBy("lemma").agg(listed.alias("l")).select("lemma", F.array_join(F.transform("l", lambda x: x["term"]), ",").alias("terms"))


def entry_quality(sources: Column, embedding: tuple[str, ...] = rules.EMBEDDING_SOURCES, via: tuple[str, ...] = rules.VIA_SOURCES) -> Column:
    """0: dictionaries alone, 1: dictionaries and embeddings, 2: found by way of a third language, 3: the rest."""
    has = lambda names: F.arrays_overlap(sources, F.array(*map(F.lit, names)))
    strong = F.size(F.array_except(sources, F.array(*map(F.lit, embedding + via)))) > 0
    return F.when(strong, F.when(has(embedding), 1).otherwise(0)).when(has(via), 2).otherwise(3)


def order_entries(entries: DataFrame, **names) -> DataFrame:
    """entries (lemma, sources) with ``quality``, sorted by lower-case lemma, quality, lemma; the sort is by ranges."""
    return entries.withColumn("quality", entry_quality(F.col("sources"), **names)).orderBy(F.lower("lemma"), "quality", "lemma")
