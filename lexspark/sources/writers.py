"""Sinks: a lexicon as Parquet or JSON, and its display forms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X


def write_lexicon(df: DataFrame, path: str, form: str = "parquet") -> None:
    df.write.mode("overwrite").format(form).save(path)


def to_unified(rows: DataFrame, source: str) -> DataFrame:
    """rows (lemma, term, lang, ord) to distinct (lemma, term, lang), the first of each staying, with a confidence and the source's name."""
    first = rows.groupBy("lemma", "term", "lang").agg(F.min("ord").alias("ord"))
    return first.select("lemma", "term", "lang", F.lit(0.6).alias("confidence"), F.lit(source).alias("source"))


def display_index(cands: DataFrame) -> DataFrame:
    """lemma, labels: distinct ``term{sources}`` labels of rows (lemma, term, sources array), sorted."""
    label = F.concat("term", F.lit("{"), F.array_join(F.array_sort(F.array_distinct("sources")), ","), F.lit("}"))
    return cands.groupBy("lemma").agg(F.array_join(F.array_sort(F.collect_set(label)), " ").alias("labels"))


def display_dictionary(cands: DataFrame) -> DataFrame:
    """lemma, terms in (rank, idx) order, sources; rows (lemma, term, sources array, rank, idx). Rows, not one map: there can be any number of lemmas."""
    out = cands.groupBy("lemma").agg(F.array_sort(F.collect_list(F.struct("rank", "idx", "term"))).alias("t"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("s"))
    return out.select("lemma", F.array_join(F.transform("t", lambda x: x["term"]), ",").alias("terms"), F.array_join("s", ",").alias("sources"))


def unified_entries(entries: DataFrame, source: str, url: str, confidence: float = 1.0) -> DataFrame:
    """entries (lemma, pos, paradigm, translations array<struct<lang, term>>) in the unified form: lemma, source, pos, paradigm, translations, source_page.

    Terms are cleaned and each (term, lang) stays once, where it came first; blank lemmas go, an empty pos is none.
    """
    cleaned = F.transform(F.coalesce("translations", F.array().cast(entries.schema["translations"].dataType)), lambda t: F.struct(X.clean_term(F.btrim(t["term"])).alias("term"), t["lang"].alias("lang"), F.lit(confidence).alias("confidence"), F.lit(source).alias("source")))
    kept = F.array_distinct(F.filter(cleaned, lambda t: (F.coalesce(t["term"], F.lit("")) != "") & (F.coalesce(t["lang"], F.lit("")) != "")))
    rows = entries.withColumn("lemma", F.btrim("lemma")).where("lemma != ''")
    return rows.select("lemma", F.lit(source).alias("source"), F.nullif("pos", F.lit("")).alias("pos"), "paradigm", kept.alias("translations"), F.concat(F.lit(url), "lemma").alias("source_page"))


def index_records(cands: DataFrame) -> DataFrame:
    """l, p, t of rows (lemma, pos, term, sources array, ord): an entry's labels ``term{short sources}`` in order, each once; sources without a short name are not shown."""
    known = ("wikt_io", "wikt_eo", "wiki", "pivot_en", "pivot_fr", "ll")
    short = F.array_sort(F.array_distinct(F.filter(F.transform("sources", X.short_source), lambda s: s.isin(*known))))
    label = F.when(F.size(short) > 0, F.concat("term", F.lit("{"), F.array_join(short, ","), F.lit("}"))).otherwise(F.col("term"))
    rows = cands.select(F.btrim("lemma").alias("l"), F.nullif("pos", F.lit("")).alias("p"), F.btrim("term").alias("term"), "sources", "ord").where("l != ''")
    listed = F.array_sort(F.collect_list(F.when(F.col("term") != "", F.struct("ord", label.alias("label")))))
    return rows.groupBy("l", "p").agg(F.array_distinct(F.transform(listed, lambda x: x["label"])).alias("t"))


def dictionary_records(cands: DataFrame) -> DataFrame:
    """lemma, words, sources, paradigms of rows (lemma, term, sources array, paradigm, rank, idx): words by (rank, idx), each once, the paradigm if there is one."""
    words = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.struct("rank", "idx", "term"))), lambda x: x["term"]))
    sources = F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources"))))
    paradigm = F.array_compact(F.array(F.min_by("paradigm", F.struct("rank", "idx"))))
    return cands.where("lemma != ''").groupBy("lemma").agg(words.alias("words"), sources.alias("sources"), paradigm.alias("paradigms"))
