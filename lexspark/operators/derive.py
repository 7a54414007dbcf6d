"""Rows made by rule: derived pairs, twins, surface forms, tagged pairs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as X


def rule_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A rule table as a small DataFrame. Catalyst knows its size and broadcasts it while that is under its limit."""
    return spark.createDataFrame(rows, schema)


def derive_pairs(pairs: DataFrame, vocabulary: DataFrame, known: DataFrame) -> DataFrame:
    """New (lemma, term, pos) from suffixes on roots that a pair (lemma, term, ord) shares, if vocabulary (token) attests the lemma.

    Roots of lower-case words only; noun and adjective roots that look derived are left out. The first
    pair that gives a lemma wins, verb suffixes before noun before adjective ones. Distinct roots meet
    the suffixes, so the product is roots times a few tens.
    """
    spark = pairs.sparkSession
    kinds = [
        (1, "(ar|ir|or)$", "i$", False, rules.VERB_SUFFIXES),
        (2, "o$", "o$", True, rules.NOUN_SUFFIXES),
        (3, "a$", "a$", True, rules.ADJECTIVE_SUFFIXES),
    ]
    low = pairs.where(F.col("lemma").rlike(r"^\p{Ll}") & F.col("term").rlike(r"^\p{Ll}"))
    parts = []
    for kind, lemma_end, term_end, plain, _ in kinds:
        a, b = F.lower(F.regexp_replace("lemma", lemma_end, "")), F.lower(F.regexp_replace("term", term_end, ""))
        part = low.where(F.col("lemma").rlike(f"..{lemma_end}") & F.col("term").rlike(f"..{term_end}")).select(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"), "ord")
        parts.append(part.where(~F.col("a").rlike(rules.DERIVED_ROOT) & ~F.col("b").rlike(rules.DERIVED_ROOT)) if plain else part)
    roots = reduce(DataFrame.unionByName, parts).groupBy("kind", "a", "b").agg(F.min("ord").alias("ord"))
    suffixes = rule_frame(spark, [(k, i, *s) for k, *_, table in kinds for i, s in enumerate(table)], "kind int, at int, sa string, sb string, pos string")
    forms = roots.join(suffixes, "kind").select(F.concat("a", "sa").alias("lemma"), F.concat("b", "sb").alias("term"), "pos", "kind", "ord", "at")
    forms = forms.join(vocabulary.select(F.col("token").alias("lemma")).distinct(), "lemma", "left_semi").join(known.select("lemma").distinct(), "lemma", "left_anti")
    first = F.min_by(F.struct("term", "pos"), F.struct("kind", "ord", "at", "term"))
    return forms.groupBy("lemma").agg(first.alias("f")).select("lemma", "f.term", "f.pos")


# Twins (ending, paradigm asked, replacement, paradigm and pos given).
TWIN_RULES = [
    ("ano", "o__n", "ana", "a__adj", "adjective"), ("ana", "a__adj", "ano", "o__n", "noun"),
    ("ia", "o__n", "iana", "a__adj", "adjective"), ("iana", "a__adj", "ia", "o__n", "noun"), ("ana", "a__adj", "a", "o__n", "noun"),
]


# The rule for proper nouns of an encyclopedia, which stands before the fourth.
ENCYCLOPEDIC_TWIN = ("a", "o__n", "ana", "a__adj", "adjective")


def twin_entries(entries: DataFrame) -> DataFrame:
    """entries (lemma, pos, paradigm, ord, encyclopedic) plus twins by TWIN_RULES; a twin is made only if no earlier row has its lemma.

    Encyclopedic nouns of more than three letters in -a also have an adjective in -ana; without that column no noun is one.
    Other columns go with the twins.
    """
    if "encyclopedic" not in entries.columns:
        entries = entries.withColumn("encyclopedic", F.lit(False))

    def twin(rule):
        ending, asked, new, paradigm, pos = rule
        hit = F.lower("lemma").endswith(ending) & (F.col("paradigm") == asked)
        if rule is ENCYCLOPEDIC_TWIN:
            hit = hit & F.col("encyclopedic") & (F.length("lemma") > 3)
        return F.when(hit, F.struct(F.concat(F.expr(f"left(lemma, greatest(0, length(lemma) - {len(ending)}))"), F.lit(new)).alias("lemma"), F.lit(pos).alias("pos"), F.lit(paradigm).alias("paradigm")))

    every = F.array(F.struct("lemma", "pos", "paradigm"), *map(twin, [*TWIN_RULES[:3], ENCYCLOPEDIC_TWIN, *TWIN_RULES[3:]]))
    rest = [c for c in entries.columns if c not in ("lemma", "pos", "paradigm", "ord", "encyclopedic")]
    rows = entries.select("ord", *rest, F.posexplode(every).alias("k", "e")).where("e is not null").select("e.*", "ord", "k", *rest)
    first = F.row_number().over(Window.partitionBy("lemma").orderBy("ord", "k"))
    return rows.withColumn("_n", first).where("k = 0 or _n = 1").select("lemma", "pos", "paradigm", (F.col("k") > 0).alias("made"), *rest)


def expand_surfaces(entries: DataFrame, table: list[tuple] = rules.PARADIGMS) -> DataFrame:
    """(surface, lemma, paradigm, tags) of entries (lemma, paradigm)."""
    forms = rule_frame(entries.sparkSession, table, "paradigm string, suffix string, tags string")
    out = entries.join(forms, "paradigm")
    return out.select(F.concat(X.stem(F.col("lemma"), F.col("paradigm")), "suffix").alias("surface"), "lemma", "paradigm", "tags")


def tagged_derivations(winners: DataFrame) -> DataFrame:
    """(left, left_tags, right, right_tags) of winners (lemma, term, paradigm); single-word targets with the fitting ending."""
    table = rule_frame(winners.sparkSession, rules.TAGGED_DERIVATIONS, "paradigm string, tag string, last string, suffix string, right_tags string")
    fits = F.when(F.col("paradigm") == "ar__vblex", F.col("term").endswith("i")).when(F.col("paradigm") == "a__adj", F.col("term").endswith("a")).otherwise(F.lit(True))
    out = winners.where(~F.col("term").contains(" ") & fits).join(table, "paradigm")
    root = F.regexp_replace("term", F.when(F.col("paradigm") == "ar__vblex", F.lit("i$")).when(F.col("paradigm") == "a__adj", F.lit("a$")).otherwise(F.lit("o$")), F.lit(""))
    left_tags = F.concat_ws(".", X.tag_of(F.col("paradigm")), "tag", "last")
    return out.select(X.stem(F.col("lemma"), F.col("paradigm")).alias("left"), left_tags.alias("left_tags"), F.when(F.col("suffix") == "/", F.col("term")).otherwise(F.concat(root, "suffix")).alias("right"), "right_tags")


def possessives(winners: DataFrame, pronouns: tuple[str, ...] = rules.PERSONAL_PRONOUNS) -> DataFrame:
    """lemma+a, term+a of winners (lemma, term) that are pronouns."""
    return winners.where(F.col("lemma").isin(*pronouns)).select(F.concat("lemma", F.lit("a")).alias("lemma"), F.concat("term", F.lit("a")).alias("term"))


def feature_rows(winners: DataFrame, pronouns: tuple[str, ...], features: list[str]) -> DataFrame:
    """One reverse-only row for each pronoun winner and feature; both tables are short lists given by the caller."""
    table = rule_frame(winners.sparkSession, [(f,) for f in features], "feature string")
    return winners.where(F.col("lemma").isin(*pronouns)).join(table).select("lemma", "term", "feature", F.lit("rl").alias("direction"))


def pronoun_rows(winners: DataFrame, table: list[tuple] = rules.PERSON_FEATURES) -> DataFrame:
    """Reverse-only rows (lemma, term, tags, direction) of winners (lemma, term) whose term is a personal pronoun of the table.

    Readings as subject, nominative, accusative and object; a masculine one also as subject of any gender.
    """
    features = rule_frame(winners.sparkSession, table, "term string, person string, gender string, number string")
    core = F.concat_ws(".", "person", "gender", "number")
    any_gender = F.when(F.col("gender") == "m", F.concat_ws(".", F.lit("subj"), "person", F.lit("mf"), "number"))
    forms = F.array_compact(F.array(F.concat(F.lit("subj."), core), any_gender, F.concat(core, F.lit(".nom")), F.concat(core, F.lit(".acc")), F.concat(F.lit("obj."), core)))
    return winners.join(features, "term").select("lemma", "term", F.explode(forms).alias("tags"), F.lit("rl").alias("direction"))


def grid_pairs(cells: DataFrame, columns: list[tuple[str, str]], rows: list[tuple[str, str]]) -> DataFrame:
    """Correlatives (lemma, term): a column's prefix pair with a row's suffix pair, if cells (lemma) attests the lemma."""
    spark = cells.sparkSession
    grid = rule_frame(spark, columns, "p string, q string").join(rule_frame(spark, rows, "s string, t string"))
    return grid.select(F.concat("p", "s").alias("lemma"), F.concat("q", "t").alias("term")).join(cells.select("lemma").distinct(), "lemma", "left_semi")


def page_entries(pages: DataFrame) -> DataFrame:
    """Encyclopedia pages (title, text) as entries: lemma, pos, paradigm, text_length, n_categories, categories array."""
    cats = X.categories(F.col("text"))
    return pages.select(F.col("title").alias("lemma"), F.lit("propn").alias("pos"), F.lit("o__n").alias("paradigm"), F.length("text").cast("bigint").alias("text_length"), F.size(cats).cast("bigint").alias("n_categories"), cats.alias("categories"))


def keep_without_term(entries: DataFrame) -> DataFrame:
    """entries (lemma, pos, n_terms, n_other): those without a target term that still help to recognise words."""
    low = F.lower("lemma")
    shaped = low.rlike("(o|a|e|ar|ir)$") | F.col("pos").isin(*rules.CLOSED_POS)
    return entries.where((F.col("n_terms") == 0) & (F.col("n_other") > 0) & ~low.rlike("(as|is|os|us|ez)$") & shaped)


def align(parts: list[DataFrame]) -> DataFrame:
    """Union of (lemma, term, confidence) parts, numbered by part; pairs whose endings contradict each other go."""
    numbered = [p.select("lemma", "term", "confidence", F.lit(i).alias("part")) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, numbered).where(X.same_pos_pair(F.col("lemma"), F.col("term")))


def prepare_vocabulary(entries: DataFrame) -> DataFrame:
    """entries (lemma, pos, term, ord), one term or null in each row, to unique valid ones: lemma, pos, paradigm, terms.

    Lemmas and terms are cleaned, capitals of common words folded, invalid lemmas dropped, the first of
    equal (lemma, pos, terms) kept, paradigms inferred.
    """
    rows = entries.select("ord", X.clean_lemma(F.col("lemma")).alias("lemma"), "pos", X.clean_lemma(F.col("term")).alias("term"))
    rows = rows.groupBy("lemma", "pos").agg(F.array_sort(F.collect_set(F.when(X.is_valid_lemma(F.col("term")), F.col("term")))).alias("terms"), F.min("ord").alias("ord"))
    rows = rows.withColumn("lemma", X.fold_case(F.col("lemma"), F.col("terms"), F.col("pos"))).where(X.is_valid_lemma(F.col("lemma")))
    rows = rows.groupBy(F.lower("lemma").alias("k"), F.lower("pos").alias("p"), "terms").agg(F.min_by(F.struct("lemma", "pos"), "ord").alias("e"))
    return rows.select("e.lemma", "e.pos", X.infer_paradigm(F.col("e.lemma"), F.col("e.pos"), F.lit(False)).alias("paradigm"), F.array_join("terms", ",").alias("terms"))


def validation_errors(rows: DataFrame) -> DataFrame:
    """rows (lemma, term, source, confidence) with the names of failed checks in ``errors``; empty if all hold."""
    checks = [
        ("lemma", F.coalesce("lemma", F.lit("")) == ""), ("term", F.coalesce("term", F.lit("")) == ""), ("source", F.coalesce("source", F.lit("")) == ""),
        ("confidence", ~F.coalesce(F.col("confidence").between(0, 1), F.lit(False))),
    ]
    return rows.withColumn("errors", F.array_join(F.array_compact(F.array(*[F.when(bad, F.lit(name)) for name, bad in checks])), ","))


def split_bilingual(entries: DataFrame, lang: str = "eo") -> tuple[DataFrame, DataFrame]:
    """entries (lemma, ..., translations array<struct<lang, ...>>): those with a translation into the language, and all."""
    return entries.where(F.exists(F.coalesce("translations", F.array().cast(entries.schema["translations"].dataType)), lambda t: t["lang"] == lang)), entries
