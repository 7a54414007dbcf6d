"""Keyed merges that keep the provenance of every term.

Rows: lemma, pos, term, source, ord (any orderable; its minimum is what was seen first).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as X


def first_wins(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key by ``order``; a total order makes it deterministic."""
    rest = [c for c in rows.columns if c not in keys]
    out = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r"))
    return out.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(rows.columns)


def merge_translations(rows: DataFrame) -> DataFrame:
    """(lemma, term, lang): best confidence and all sources."""
    return rows.groupBy("lemma", "term", "lang").agg(F.max("confidence").alias("confidence"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"))


def canonical_lemma(rows: DataFrame) -> DataFrame:
    """Per lower-case lemma the spelling of rows (lemma, priority): lower-case first, then priority, then the larger."""
    best = F.max(F.struct((F.col("lemma") == F.lower("lemma")).alias("l"), "priority", "lemma"))
    return rows.groupBy(F.lower("lemma").alias("key")).agg(best["lemma"].alias("lemma"))


def merge_by_lemma(rows: DataFrame) -> DataFrame:
    """Per lower-case lemma: key, pos, paradigm, source (that of the pos), n; rows (lemma, pos, paradigm, source, priority, ord, encyclopedic).

    Part of speech and paradigm each come from the source with the highest priority that gives one, the first
    at a tie. A proper noun of an encyclopedia wins over all; a function word has the paradigm of its class; a missing paradigm
    is that of the class. A lemma of a single row keeps what it has.
    """
    order = F.struct("priority", -F.col("ord"))
    told = (F.coalesce("pos", F.lit("")) != "") & (F.col("priority") > 0)
    best = rows.groupBy(F.lower("lemma").alias("key")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.col("encyclopedic") & (F.col("pos") == "np")).alias("np"), F.min_by(F.struct("pos", "source"), "ord").alias("first"),
        F.max_by(F.struct("pos", "source"), F.when(told, order)).alias("best"), F.max_by("paradigm", F.when(F.col("paradigm").isNotNull() & (F.col("priority") > 0), order)).alias("par"), F.min_by("paradigm", "ord").alias("own"),
    )
    proper = F.coalesce("np", F.lit(False))
    pos = F.when(F.col("n") == 1, F.col("first.pos")).when(proper, "np").otherwise(F.coalesce("best.pos", "first.pos"))
    of_class = X.lookup(rules.POS_PARADIGM, X.short_pos(F.col("pos")))
    merged = F.when(F.col("n") == 1, F.col("own")).when(proper, "np__np").when(of_class.startswith("__"), of_class).otherwise(F.coalesce("par", of_class))
    return best.withColumn("pos", pos).select("key", "pos", merged.alias("paradigm"), F.coalesce("best.source", "first.source").alias("source"), "n")


def _union_sources():
    return F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias("sources")


def dedupe_case(cands: DataFrame, keys: tuple[str, ...] = ("lemma",)) -> DataFrame:
    """Candidates (keys with lemma, term, sources, idx) that differ by case only become one, spelt as the lemma's case asks."""
    proper = F.col("lemma").rlike(r"^\p{Lu}")
    apart = (F.col("term").rlike(r"^\p{Lu}") != proper).cast("int")
    out = cands.groupBy(*keys, X.casefold(F.col("term")).alias("_k"))
    return out.agg(F.min_by("term", F.struct(apart, "idx")).alias("term"), _union_sources(), F.min("idx").alias("idx")).drop("_k")


def fold_inflections(cands: DataFrame, keys: tuple[str, ...] = ("lemma",)) -> DataFrame:
    """A candidate ending in -jn, -j or -n goes into its base in -o or -a, if that is a candidate of the same keys too."""
    key = X.casefold(F.col("term"))
    out = cands.withColumn("_all", F.collect_set(key).over(Window.partitionBy(*keys))).withColumn("_k", key)
    base = F.lit(None).cast("string")
    for suffix in ("n", "j", "jn"):  # the longest is tried first
        cut = F.expr(f"left(_k, greatest(0, length(_k) - {len(suffix)}))")
        base = F.when(F.col("_k").endswith(suffix) & cut.rlike("[oa]$") & F.array_contains("_all", cut), cut).otherwise(base)
    out = out.withColumn("_b", F.coalesce(base, "_k"))
    first = F.min_by("term", F.struct((F.col("_k") != F.col("_b")).cast("int"), "idx"))
    return out.groupBy(*keys, "_b").agg(first.alias("term"), _union_sources(), F.min("idx").alias("idx")).drop("_b")


def merge_lexicon(rows: DataFrame, embedding: tuple[str, ...] = rules.EMBEDDING_SOURCES, overrides: list[tuple[str, str, str]] | None = None, attesting: str = "io_wiktionary", junk_verbs: bool = False, plain: bool = False) -> DataFrame:
    """One row per (key lemma, pos): lemma, pos, paradigm, candidates array<struct<idx, term, sources>>, sources.

    rows: lemma, pos, term (a list of terms in one string, or null), source, ord. Terms are split and
    cleaned, parts of speech made sane; a common word prefers its lower-case spelling; case variants
    and inflections of a term are folded; terms known from embeddings alone go if the entry has any
    other source, or if they do not share the lemma's first four letters. Embedding rows whose lemma has no
    lemma's shape are left out, and so are nouns in -o that only embeddings translate, where ``attesting`` has the
    lemma in -ino. Entries left without a term are kept, verbs whose stem is one letter or none only if asked for (``junk_verbs``). Rows from running text (``plain``) are spared the rules
    against remains of pages: lemmas may begin with a digit, and terms may hold any word. Everything is grouped and joined by (key, pos, ...), so shuffles are on high-cardinality keys.
    """
    bad_lemma = F.col("lemma").rlike(r"[(),;:!@#$%^&*\[\]{}|<>?/\\]") | ~F.col("lemma").rlike(r"^\p{L}")
    rows = rows.withColumn("lemma", F.btrim(F.coalesce("lemma", F.lit(""))))
    if not plain:
        rows = rows.where(~bad_lemma)
    rows = rows.where(~F.coalesce(F.col("source").isin(*embedding), F.lit(False)) | X.has_lemma_shape(F.col("lemma")))
    rows = rows.withColumn("pos", X.sane_pos(F.col("lemma"), X.short_pos(F.col("pos"))))
    rows = rows.withColumn("lemma", F.when(F.col("pos").isin(*rules.LOWERED_CLASS), F.lower("lemma")).otherwise(F.col("lemma")))
    rows = rows.withColumn("key", F.lower("lemma"))
    if overrides is not None:
        spark = rows.sparkSession
        forced = spark.createDataFrame(overrides, "key string, pos string, _t string")
        added = forced.select(F.col("key").alias("lemma"), "pos", F.col("_t").alias("term"), F.lit("function_word_override").alias("source"), "key")
        terms = rows.join(forced, ["key", "pos"], "left").where("_t is null or term is null or term != _t").drop("_t")
        rows = terms.select("lemma", "pos", "term", "source", "key", "ord").unionByName(added.withColumn("ord", F.lit(None).cast(rows.schema["ord"].dataType)))
    common = F.col("pos").isin("n", "adj", "adv", "vblex") & (F.col("lemma") == F.lower("lemma"))
    parts = rows.select("key", "pos", "lemma", "source", "ord", common.alias("common"), F.posexplode_outer(X.split_terms(F.col("term"), r"[|{}]") if plain else X.split_terms(F.col("term"))).alias("at", "term"))
    order = F.struct("ord", "at")
    spelling = F.struct((~F.col("common")).alias("high"), F.col("ord").alias("o"))
    terms = parts.groupBy("key", "pos", "term").agg(
        F.array_sort(F.collect_set("source")).alias("sources"), F.min(order).alias("o"), F.min_by("lemma", spelling).alias("lemma"), F.min(spelling).alias("s")
    )
    entries = terms.groupBy("key", "pos").agg(F.min_by("lemma", "s").alias("lemma"), _union_sources())
    cands = terms.where("term is not null").select("key", "pos", "term", "sources", F.col("o").alias("idx")).join(entries.select("key", "pos", "lemma"), ["key", "pos"])
    cands = fold_inflections(dedupe_case(cands, ("key", "pos", "lemma")), ("key", "pos"))
    lists = cands.groupBy("key", "pos").agg(F.array_sort(F.collect_list(F.struct(F.col("idx").alias("o"), "term", "sources"))).alias("c"))
    entries = entries.join(lists, ["key", "pos"], "left")
    paradigm = F.when(F.col("pos").isin("pr", "det", "prn", "cnjcoo", "cnjsub", "ij", "prep_art"), X.lookup(rules.POS_PARADIGM, F.col("pos")))
    encyclopedic = F.exists("sources", lambda s: s.contains("wikipedia"))
    entries = entries.withColumn("paradigm", F.coalesce(paradigm, X.infer_paradigm(F.col("lemma"), F.col("pos"), encyclopedic), X.lookup(rules.POS_PARADIGM, F.col("pos"))))
    entries = entries.where(~X.is_junk_lemma(F.col("lemma")))
    if not junk_verbs:
        entries = entries.where(~X.is_junk_verb(F.col("lemma"), F.col("pos"), F.col("paradigm")))
    entries = entries.withColumn("c", F.coalesce("c", F.array().cast(entries.schema["c"].dataType)))
    weak = F.array(*map(F.lit, embedding))
    only_weak = lambda s: F.size(F.array_except(s, weak)) == 0
    strong = F.exists("c", lambda x: ~only_weak(x["sources"]))
    longer = parts.where((F.col("source") == attesting) & F.col("key").endswith("ino") & F.col("term").isNotNull()).select(F.regexp_replace("key", "ino$", "o").alias("key"), F.lit(True).alias("_longer")).distinct()
    shadow = F.col("_longer").isNotNull() & (F.coalesce("paradigm", F.lit("")) == "o__n") & ~strong
    entries = entries.join(longer, "key", "left").where(~shadow)
    cognate = lambda t: F.lower(F.substring(t, 1, 4)) == F.substring("key", 1, 4)
    kept = F.filter("c", lambda x: ~only_weak(x["sources"]) | (~strong & cognate(x["term"])))
    return entries.select("key", "lemma", "pos", "paradigm", kept.alias("candidates"), "sources")


def find_conflicts(cands: DataFrame) -> DataFrame:
    """Lemmas with two terms or more from two sources or more: lemma, n_terms, n_sources, listing 'term{src,…}; …'."""
    flat = cands.select("lemma", "term", F.explode("sources").alias("s")).select("lemma", "term", X.short_source(F.col("s")).alias("s"))
    terms = flat.groupBy("lemma", "term").agg(F.array_sort(F.collect_set("s")).alias("ss"))
    out = terms.groupBy("lemma").agg(F.count(F.lit(1)).alias("n_terms"), F.size(F.array_distinct(F.flatten(F.collect_list("ss")))).cast("bigint").alias("n_sources"), F.array_sort(F.collect_list(F.concat("term", F.lit("{"), F.array_join("ss", ","), F.lit("}")))).alias("l"))
    return out.where("n_terms >= 2 and n_sources >= 2").select("lemma", "n_terms", "n_sources", F.array_join("l", "; ").alias("listing"))


def source_stats(cands: DataFrame) -> DataFrame:
    """Per short source: entries that have it, term rows that have it by full name, and terms that have it."""
    flat = cands.select("lemma", "term", F.explode("sources").alias("s")).withColumn("source", X.short_source(F.col("s")))
    terms = flat.groupBy("lemma", "term", "source").agg(F.count(F.lit(1)).alias("n"))
    entries = terms.groupBy("lemma", "source").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("t"))
    return entries.groupBy("source").agg(F.count(F.lit(1)).alias("n_entries"), F.sum("n").alias("n_pairs"), F.sum("t").alias("n_terms"))


def union_terms(rows: DataFrame) -> DataFrame:
    """Per lower-case lemma the first casing and its distinct terms in order of first sight; rows (lemma, term, ord)."""
    terms = rows.groupBy(F.lower("lemma").alias("key"), "term").agg(F.min("ord").alias("o"), F.min_by("lemma", "ord").alias("lemma"))
    return terms.groupBy("key").agg(F.min_by("lemma", "o").alias("lemma"), F.array_sort(F.collect_list(F.struct("o", "term"))).alias("c")).select("lemma", F.array_join(F.transform("c", lambda x: x["term"]), ",").alias("terms"))


def apply_overrides(cands: DataFrame, table: DataFrame) -> DataFrame:
    """cands (lemma, term, sources) with table (lemma, term): the term is inserted, or its sources replaced."""
    both = cands.join(table.withColumn("_o", F.lit(True)), ["lemma", "term"], "full_outer")
    return both.select("lemma", "term", F.when(F.col("_o"), F.array(F.lit("function_word_override"))).otherwise(F.col("sources")).alias("sources"))
