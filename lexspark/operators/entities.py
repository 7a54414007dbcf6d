"""Word pairs of labelled entities with their aliases, in the order in which they were seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X


def entity_entries(props: DataFrame, pages: DataFrame, labels: DataFrame, aliases: DataFrame) -> DataFrame:
    """key, lemma, entity, term, place: every lemma's terms without repetition, the first seen first.

    props (page_id, entity, ord), pages (page_id, title), labels (entity, lang, label), aliases (entity, lang, alias, ord);
    lang is 'a' (lemmas) or 'b' (terms). An entity's lemma is its label, else its page's title; its aliases are lemmas too. Its
    terms are its label, then its aliases. An entity without a valid lemma and term label gives nothing. A lemma's key is
    its lower case; entities of one key are united, its spelling and entity are those seen first. Of an entity's pages the last names it, the first places it.
    """
    at = props.join(pages, "page_id").where("coalesce(title, '') != ''").groupBy("entity").agg(F.max_by("title", "ord").alias("title"), F.min("ord").alias("ord"))
    named = labels.groupBy("entity").agg(*[F.max(F.when(F.col("lang") == x, F.col("label"))).alias(f"label_{x}") for x in "ab"])
    other = aliases.groupBy("entity").agg(*[F.array_sort(F.collect_list(F.when(F.col("lang") == x, F.struct("ord", "alias"))))["alias"].alias(f"aliases_{x}") for x in "ab"])
    none = F.array().cast("array<string>")
    rows = at.join(named, "entity").join(other, "entity", "left")
    rows = rows.withColumns({"own": F.coalesce(F.nullif("label_a", F.lit("")), "title"), "a": F.coalesce("aliases_a", none), "b": F.coalesce("aliases_b", none)})
    rows = rows.where(X.is_label_lemma(F.col("own")) & (F.length("own") >= 2) & (F.length("label_b") >= 2))
    lemmas = F.concat(F.array("own"), F.filter("a", lambda x: X.is_label_lemma(x) & (F.length(x) >= 2)))
    terms = F.array_distinct(F.concat(F.array("label_b"), F.filter("b", lambda x: F.length(x) >= 2)))
    rows = rows.select("entity", "ord", terms.alias("terms"), F.posexplode(lemmas).alias("no", "lemma")).withColumn("key", F.lower("lemma"))
    spelling = rows.groupBy("key").agg(F.min_by(F.struct("lemma", "entity"), F.struct("ord", "no")).alias("s"))
    seen = rows.select("key", "ord", "no", F.posexplode("terms").alias("k", "term")).groupBy("key", "term").agg(F.min(F.struct("ord", "no", "k")).alias("at"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("at")) - 1
    return seen.withColumn("place", place).join(spelling, "key").select("key", "s.lemma", "s.entity", "term", "place")
