"""Alignment joins. Entries are rows (lemma, pos, ...); order columns decide every first or last."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as X
from .skew import split_join


def identical_form(a: DataFrame, b: DataFrame) -> DataFrame:
    """lemma, pos, term, confidence of entries of a whose (lower lemma, lower pos) b has too.

    Entries: lemma, pos, pivots array (glosses in a third language), terms array<struct<term, confidence>>, ord.
    The last entry of a key counts. Pairs with glosses on both sides but none in common are dropped;
    confidence rises by 0.2 up to 1.
    """
    key = lambda d: d.where("lemma != '' and pos != ''").groupBy(F.lower("lemma").alias("k"), F.lower("pos").alias("p"))
    low = lambda c: F.transform(c, lambda x: F.lower(F.btrim(x)))
    left = key(a).agg(F.max_by(F.struct("lemma", "pos", "pivots", "terms"), "ord").alias("x"))
    right = key(b).agg(F.max_by("pivots", "ord").alias("other"))
    both = left.join(right, ["k", "p"])
    clash = (F.size("x.pivots") > 0) & (F.size("other") > 0) & ~F.arrays_overlap(low(F.col("x.pivots")), low(F.col("other")))
    return both.where(~clash).select("x.lemma", "x.pos", F.explode("x.terms").alias("t")).select("lemma", "pos", "t.term", F.least(F.lit(1.0), F.round(F.col("t.confidence") + 0.2, 6)).alias("confidence"))


def link_pairs(pages: DataFrame, links: DataFrame, confidence: float = 0.85, source_pages: bool = True) -> DataFrame:
    """(source title, target title) of pages (page_id, title) and links (page_id, target) that both look like words.

    The pages are the source language's, or, without ``source_pages``, the target's; lemmas are of the source either way.
    """
    lemma, term = ("title", "target") if source_pages else ("target", "title")
    return (
        pages.join(links, "page_id").where(X.is_link_title(F.col("title")) & X.is_link_title(F.col("target")))
        .select(F.col(lemma).alias("lemma"), F.col(term).alias("term"), F.lit(confidence).alias("confidence"))
    )


def pivot_join(a: DataFrame, b: DataFrame, confidence: float = 0.7) -> DataFrame:
    """(lemma, term, pivot, confidence, sources) of a (lemma, pivot, sources) and b (term, pivot, sources) that share a pivot word, case aside.

    Many to many by meaning; each side is folded by its word and pivot first. The sources of a come first. Pairs of a pivot that very many words share are dealt out.
    """
    side = lambda d, word: d.groupBy(word, F.lower("pivot").alias("pivot")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("sources")))).alias(f"_{word}"))
    return split_join(side(a, "lemma"), side(b, "term"), ["pivot"]).select("lemma", "term", "pivot", F.lit(confidence).alias("confidence"), F.concat("_lemma", "_term").alias("sources"))


def same_page_pairs(rows: DataFrame, by_meaning: bool = True) -> DataFrame:
    """Distinct (page, lemma, term) of rows (page, meaning, lang, term), lang 'a' or 'b', on one page and, if asked, one meaning; a page that holds very many terms is dealt out."""
    keys = ["page", "meaning"] if by_meaning else ["page"]
    left = rows.where("lang = 'a'").select(*keys, F.col("term").alias("lemma")).distinct()
    right = rows.where("lang = 'b'").select(*keys, "term").distinct()
    return split_join(left, right, keys).select("page", "lemma", "term").distinct()


def attach_pos(pairs: DataFrame, lexicon: DataFrame) -> DataFrame:
    """pairs (lemma, ...) with the first non-empty pos that lexicon (lemma, pos, ord) has for the lemma, case aside."""
    first = lexicon.where("coalesce(pos, '') != ''").groupBy(F.lower("lemma").alias("_k")).agg(F.min_by("pos", "ord").alias("pos"))
    return pairs.drop("pos").join(first, F.lower("lemma") == F.col("_k"), "left").drop("_k")


def resolve_variants(entries: DataFrame) -> DataFrame:
    """entries (lemma, form_of, terms): a variant without terms takes those of its base, one hop."""
    base = entries.where(F.size("terms") > 0).groupBy(F.lower("lemma").alias("_k")).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("terms")))).alias("_t"))
    out = entries.join(base, F.lower("form_of") == F.col("_k"), "left")
    return out.withColumn("terms", F.when((F.size("terms") == 0) & F.col("_t").isNotNull(), F.col("_t")).otherwise(F.col("terms"))).drop("_k", "_t")


def entity_label_pairs(props: DataFrame, pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(lemma, term): props (page_id, entity), pages (page_id, title), labels (entity, lang 'a'/'b', label); a missing source label falls back to the title."""
    at = props.join(pages, "page_id").select("entity", "title")
    own = labels.where("lang = 'a'").select("entity", F.col("label").alias("own"))
    out = at.join(own, "entity", "left").join(labels.where("lang = 'b'").select("entity", F.col("label").alias("term")), "entity")
    out = out.select(F.coalesce("own", "title").alias("lemma"), "term")
    return out.where(X.is_label_lemma(F.col("lemma")) & (F.length("term") >= 2)).distinct()


def frequency_gate(entries: DataFrame, ranks: DataFrame, n: int) -> DataFrame:
    """entries (lemma, encyclopedic): encyclopedic ones stay only as demonyms or with a word of rank n or better in ranks (token, rank)."""
    common = ranks.where(F.col("rank") <= n).select(F.lower("token").alias("w")).distinct()
    known = entries.select("lemma", F.explode(F.split(F.lower("lemma"), " ")).alias("w")).join(common, "w", "left_semi").select("lemma").distinct()
    out = entries.join(known.withColumn("_hit", F.lit(True)), "lemma", "left")
    return out.where(~F.col("encyclopedic") | X.is_demonym(F.col("lemma")) | F.col("_hit")).drop("_hit")


def attested_new(forms: DataFrame, vocabulary: DataFrame, known: DataFrame) -> DataFrame:
    """forms (lemma, ...) that vocabulary (token) holds and known (lemma) does not."""
    return forms.join(vocabulary.select(F.col("token").alias("lemma")).distinct(), "lemma", "left_semi").join(known.select("lemma").distinct(), "lemma", "left_anti")


def shadow_guard(entries: DataFrame, attested: DataFrame, ending: str = "o", longer: str = "ino") -> DataFrame:
    """entries (lemma, weak): a weak entry X+ending goes if attested (lemma) has X+longer."""
    keys = attested.where(F.col("lemma").endswith(longer)).select(F.concat(F.expr(f"left(lemma, length(lemma) - {len(longer)})"), F.lit(ending)).alias("lemma")).distinct()
    return entries.join(keys.withColumn("_s", F.lit(True)), "lemma", "left").where(F.col("_s").isNull() | ~F.col("weak")).drop("_s")


def supplement(main: DataFrame, extra: DataFrame) -> DataFrame:
    """main (lemma, pos, paradigm, source) with pos and paradigm filled from extra (lemma, pos, paradigm, source, authoritative), whose new lemmas are appended."""
    other = extra.groupBy("lemma").agg(F.max_by(F.struct("pos", "paradigm", "authoritative"), F.struct("authoritative", "pos", "paradigm")).alias("x"))
    both = main.join(other, "lemma", "left")
    take = F.coalesce(F.col("x.authoritative"), F.lit(False)) | (F.col("pos").isNull() & F.col("paradigm").isNull() & F.col("x").isNotNull())
    filled = both.select("lemma", F.when(take, F.col("x.pos")).otherwise(F.col("pos")).alias("pos"), F.when(take, F.col("x.paradigm")).otherwise(F.col("paradigm")).alias("paradigm"), "source")
    new = other.join(main.select("lemma").distinct(), "lemma", "left_anti").select("lemma", "x.pos", "x.paradigm", F.lit("supplement").alias("source"))
    return filled.unionByName(new)


def lexicon_diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """key, status (added, removed, changed), old_terms, new_terms of tables (key, term)."""
    sets = lambda d, name: d.groupBy("key").agg(F.array_sort(F.collect_set("term")).alias(name))
    both = sets(old, "old_terms").join(sets(new, "new_terms"), "key", "full_outer")
    status = F.when(F.col("old_terms").isNull(), "added").when(F.col("new_terms").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("old_terms").eqNullSafe(F.col("new_terms"))).select("key", status.alias("status"), F.array_join("old_terms", ",").alias("old_terms"), F.array_join("new_terms", ",").alias("new_terms"))


def existing_wins(current: DataFrame, new: DataFrame) -> DataFrame:
    """current plus the rows of new whose lower-case lemma current lacks; duplicates within new all pass."""
    keys = current.select(F.lower("lemma").alias("_k")).distinct()
    return current.unionByName(new.join(keys, F.lower("lemma") == F.col("_k"), "left_anti"))


def merge_case_twins(entries: DataFrame) -> DataFrame:
    """entries (lemma, terms, sources, paradigm): a capitalised lemma is absorbed by its lower-case twin.

    The twin's terms come first and terms that differ by case only count once; sources are united; a missing paradigm is taken over.
    Rows of one lower-case lemma (those of a lemma without letters, which no capital tells apart, too) are twins as well, the one with the lesser terms first.
    """
    own = ["terms", "sources", "paradigm"]
    row = F.struct((F.col("lemma") != F.lower("lemma")).alias("high"), "lemma", *own)
    every = entries.groupBy(F.lower("lemma").alias("_k")).agg(F.array_sort(F.collect_list(row)).alias("c"))
    of = lambda name: F.transform("c", lambda e: e[name])
    first = lambda words: X.let(F.transform(words, X.casefold), lambda keys: F.filter(words, lambda t, i: F.array_position(keys, F.get(keys, i)) == i + 1))
    merged = F.struct(
        F.lit(False).alias("high"), F.col("_k").alias("lemma"), X.let(F.flatten(of("terms")), first).alias("terms"),
        F.array_sort(F.array_distinct(F.flatten(of("sources")))).alias("sources"), F.get(F.filter(of("paradigm"), lambda p: p.isNotNull()), F.lit(0)).alias("paradigm"),
    )
    # Lower-case rows are sorted before capitals; without one the rows stay as they are.
    return every.select(F.explode(F.when(F.get("c", F.lit(0))["high"], F.col("c")).otherwise(F.array(merged))).alias("e")).select("e.lemma", *[f"e.{c}" for c in own])


def class_twin(pairs: DataFrame, members: DataFrame, tag: str) -> DataFrame:
    """pairs (lemma, term, direction) plus a one-way row for each term that members (term) holds."""
    twins = pairs.join(members.select("term").distinct(), "term", "left_semi").select(F.concat("lemma", F.lit(f"<{tag}>")).alias("lemma"), "term", F.lit("rl").alias("direction"))
    return pairs.select("lemma", "term", "direction").unionByName(twins)


def lemmatize(tokens: DataFrame, surfaces: DataFrame) -> DataFrame:
    """tokens (token, ...) with the least lemma whose surfaces (surface, lemma) hold it; unknown tokens are their own lemma."""
    best = surfaces.groupBy("surface").agg(F.min("lemma").alias("lemma"))
    return tokens.join(best, tokens.token == best.surface, "left").drop("surface").withColumn("lemma", F.coalesce("lemma", "token"))


def join_categories(words: DataFrame, pages: DataFrame, patterns: dict = rules.CATEGORY_PATTERNS) -> DataFrame:
    """words (word) with the class of the page of that title in pages (title, categories)."""
    out = words.join(pages.withColumn("_hit", F.lit(True)), words.word == pages.title, "left")
    return out.select("word", F.when(F.col("_hit"), X.classify(F.col("categories"), patterns)).otherwise("no_wikipedia_article").alias("class"))


def output_diff(old: DataFrame, new: DataFrame, error: str = r"\[(TRANSLATION )?ERROR\]") -> DataFrame:
    """Counts of same, changed, lost and gained outputs of tables (id, out), and how many of each status hold an error mark before and after."""
    both = old.select("id", F.col("out").alias("x")).join(new.select("id", F.col("out").alias("y")), "id", "full_outer")
    status = F.when(F.col("x").isNull(), "gained").when(F.col("y").isNull(), "lost").when(F.col("x") == F.col("y"), "same").otherwise("changed")
    return both.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("x").rlike(error)).alias("old_errors"), F.count_if(F.col("y").rlike(error)).alias("new_errors"))


def top_unlinked(views: DataFrame, links: DataFrame, words: DataFrame, k: int) -> DataFrame:
    """Of the k most viewed pages (page, views), those without a link (page, target) to one of the words (target)."""
    top = views.where(~F.col("page").contains(":")).orderBy(F.desc("views"), "page").limit(k)
    return top.join(links.join(words.select("target").distinct(), "target", "left_semi").select("page").distinct(), "page", "left_anti")


def flip(entries: DataFrame, confidence: float = 0.6) -> DataFrame:
    """Target-language entries (lemma, terms) turned round: one row (lemma, term, confidence) for each distinct term."""
    out = entries.select(F.explode(F.array_distinct(F.transform("terms", lambda t: F.btrim(t)))).alias("l"), F.col("lemma").alias("term"))
    return out.where("l != ''").select(F.col("l").alias("lemma"), "term", F.lit(confidence).alias("confidence"))


def key_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """(key, side): 'left', 'right' or 'both'."""
    x, y = a.select(key).distinct().withColumn("_x", F.lit(1)), b.select(key).distinct().withColumn("_y", F.lit(1))
    return x.join(y, key, "full_outer").select(key, F.when(F.col("_y").isNull(), "left").when(F.col("_x").isNull(), "right").otherwise("both").alias("side"))
