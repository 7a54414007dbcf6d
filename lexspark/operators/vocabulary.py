"""The vocabulary of a dictionary: entries aligned from their sources, then cleaned, completed and filtered, with counters and suspects.

Entries are rows: ord (what was seen first is least), lemma, pos, language, sources array<string>, translations
array<struct<sense, lang, term, ...>>; a source's translations stay in its row, so cleaning them shuffles nothing.
"""

from __future__ import annotations

from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as X
from ..storage import saved
from . import derive, joins


class Prepared(NamedTuple):
    """entries (lemma, pos, language, paradigm, made, sources, translations), suspects (reason, lemma, term), counters (one row)."""

    entries: DataFrame
    suspects: DataFrame
    counters: DataFrame


def _count(condition: Column, name: str) -> Column:
    return F.coalesce(F.sum(F.when(condition, 1).otherwise(0)), F.lit(0)).alias(name)


def _observed(of: Observation) -> dict[str, int]:
    """What was observed; nothing, where Spark saw that there are no rows and left the observation out."""
    try:
        return of.get
    except Py4JJavaError:
        return {}


def normalized(entries: DataFrame) -> DataFrame:
    """Entries with clean lemmas and terms, capitals of common words folded; ``_cleaned`` and ``_valid`` tell what became of the lemma."""
    lemma = X.clean_lemma(F.col("lemma"))
    terms = F.transform("translations", lambda t: t.withField("term", X.clean_lemma(t["term"])))
    rows = entries.withColumns({"_cleaned": lemma != F.coalesce("lemma", F.lit("")), "lemma": lemma, "translations": F.filter(F.coalesce(terms, F.array().cast(entries.schema["translations"].dataType)), lambda t: X.is_valid_lemma(t["term"]))})
    own = F.transform(F.filter("translations", lambda t: t["lang"] == "eo"), lambda t: t["term"])
    rows = rows.withColumn("lemma", X.fold_case(F.col("lemma"), own, F.col("pos")))
    return rows.withColumn("_valid", X.is_valid_lemma(F.col("lemma")))


def distinct_entries(rows: DataFrame) -> DataFrame:
    """The first row of each lemma, pos and language (case aside) and set of target terms."""
    own = F.array_sort(F.array_distinct(F.transform(F.filter("translations", lambda t: t["lang"] == "eo"), lambda t: F.btrim(t["term"]))))
    low = lambda c: F.lower(F.btrim(F.coalesce(c, F.lit(""))))
    out = rows.groupBy(low("lemma").alias("_l"), low("pos").alias("_p"), low("language").alias("_g"), own.alias("_t")).agg(F.min_by(F.struct(*rows.columns), "ord").alias("_e"))
    return out.select("_e.*")


def _checked_terms() -> Column:
    """array<struct<t, why>> of a row's translations: cleaned, with why each goes; empty ones have gone."""
    def one(t):
        term = X.clean_vocabulary_term(t["term"])
        return X.let(term, lambda x: F.struct(t.withField("term", x).alias("t"), F.when((t["lang"] == "eo") & ~X.is_valid_target(x), "bad_tr_eo").when(x.contains(","), "comma_tr").alias("why")))

    return F.filter(F.transform("translations", one), lambda x: x["t"]["term"] != "")


def prepare(entries: DataFrame, ranks: DataFrame, top: int) -> Prepared:
    """Entries, suspects and counters in one pass over ``entries``; ``ranks``: token, rank of the frequency list.

    Lemmas and terms are cleaned, invalid and repeated entries go, paradigms are inferred, demonym and toponym twins made. Entries
    that only an encyclopedia has stay as demonyms or with a word among the ``top`` ones. An entry of "io" that loses all its
    translations stays without any. The counters are observed as the pass writes its result; nothing is computed twice.
    """
    spark = entries.sparkSession
    before, after, last = Observation(), Observation(), Observation()
    rows = normalized(entries).observe(before, F.count(F.lit(1)).alias("input"), _count(F.col("_cleaned"), "cleaned"), _count(~F.col("_valid"), "invalid"))
    rows = distinct_entries(rows.where("_valid").drop("_cleaned", "_valid")).observe(after, F.count(F.lit(1)).alias("output"))
    wiki = F.exists("sources", lambda s: s.contains("wikipedia"))
    rows = rows.withColumns({
        "paradigm": X.infer_paradigm(F.col("lemma"), F.col("pos"), wiki), "pos": F.nullif(X.short_pos(F.col("pos")), F.lit("")), "encyclopedic": wiki,
        "ord": F.struct("lemma", F.coalesce("pos", F.lit("None")).alias("pos"), "ord"),
    })
    rows = derive.twin_entries(rows)
    only = F.exists("sources", lambda s: s.endswith("wikipedia")) & ~F.exists("sources", lambda s: s.endswith("wiktionary"))
    rows = rows.withColumns({"_only": only & ~X.is_demonym(F.col("lemma")), "_id": F.monotonically_increasing_id(), "_checked": _checked_terms()})
    rows = saved(rows, "vocabulary")  # ids must not change between the join's two uses of the rows
    common = ranks.where(F.col("rank") <= top).select(F.lower("token").alias("w")).distinct()
    frequent = rows.where("_only").select("_id", F.explode(F.split(F.lower("lemma"), r"\s+")).alias("w")).join(common, "w", "left_semi").select("_id").distinct()
    rows = rows.join(frequent.withColumn("_hit", F.lit(True)), "_id", "left")
    status = (
        F.when((F.coalesce("lemma", F.lit("")) == "") | (F.coalesce("language", F.lit("")) == ""), "bad_schema")
        .when(~X.is_valid_lemma(F.col("lemma")), "bad_lemma").when(F.col("_only") & F.col("_hit").isNull(), "wiki_low_freq").otherwise("kept")
    )
    rows = rows.withColumns({"_status": status, "kept_terms": F.transform(F.filter("_checked", lambda x: x["why"].isNull()), lambda x: x["t"])})
    removed = F.filter("_checked", lambda x: x["why"].isNotNull())
    low = F.array(F.struct(F.lit("wiki_low_freq").alias("reason"), F.lit(None).cast("string").alias("term")))
    bad = F.transform(removed, lambda x: F.struct(x["why"].alias("reason"), x["t"]["term"].alias("term")))
    suspects = F.when(F.col("_status") == "wiki_low_freq", low).when(F.col("_status") == "kept", bad)
    bare = (F.col("_status") == "kept") & (F.size("kept_terms") == 0)
    gone = [_count(F.col("_status") == x, x) for x in ("bad_schema", "bad_lemma", "wiki_low_freq")]
    terms = F.coalesce(F.sum(F.when(F.col("_status") == "kept", F.size(removed)).otherwise(0)), F.lit(0)).alias("tr_removed")
    seen = rows.observe(last, *gone, _count(bare, "all_tr_removed"), terms)
    stays = (F.col("_status") == "kept") & (~bare | (F.col("language") == "io"))
    done = saved(seen.select("lemma", "pos", "language", "paradigm", "made", "sources", F.col("kept_terms").alias("translations"), stays.alias("_stays"), suspects.alias("_suspects")), "prepared")
    counts = _observed(before) | _observed(after) | _observed(last)
    counts["duplicates"] = counts.get("input", 0) - counts.get("invalid", 0) - counts.get("output", 0)
    names = ["input", "cleaned", "invalid", "duplicates", "output", "bad_schema", "bad_lemma", "wiki_low_freq", "all_tr_removed", "tr_removed"]
    counters = spark.createDataFrame([tuple(int(counts.get(n, 0)) for n in names)], ", ".join(f"{n} bigint" for n in names))
    told = done.where("_suspects is not null").select("lemma", F.explode("_suspects").alias("s")).select("s.reason", "lemma", "s.term")
    return Prepared(done.where("_stays").drop("_stays", "_suspects"), told, counters)


def align(io: DataFrame, eo: DataFrame, titles: DataFrame, via: dict[str, DataFrame]) -> DataFrame:
    """part, lemma, pos, term, confidence, source, via: the union of seven parts, none of which hides another.

    ``io`` and ``eo`` are entries with ord and translations (lang, term, confidence, source); ``titles`` are entries of an
    encyclopedia; ``via``: pairs (lemma, pos, term, confidence, via) by pivot language. The parts: identical forms, io's own
    pairs, io's words without a pair, titles, eo's pairs turned round, and the pairs of each pivot whose endings do not contradict each other.
    """
    def listed(d: DataFrame, want: Column) -> Column:
        return F.filter(F.coalesce("translations", F.array().cast(d.schema["translations"].dataType)), lambda t: want(t["lang"]) & (F.coalesce(t["term"], F.lit("")) != ""))

    none = lambda kind: F.lit(None).cast(kind)
    rows = io.withColumns({"_own": listed(io, lambda g: g == "eo"), "_any": listed(io, lambda g: F.coalesce(g, F.lit("")) != "")})
    glosses = lambda d: F.transform(listed(d, lambda g: g.isin("en", "fr")), lambda t: t["term"])
    ours = rows.select("lemma", "pos", glosses(io).alias("pivots"), F.transform("_own", lambda t: F.struct(t["term"].alias("term"), F.coalesce(t["confidence"], F.lit(0.6)).alias("confidence"))).alias("terms"), "ord")
    theirs = eo.select("lemma", "pos", glosses(eo).alias("pivots"), F.array().cast("array<struct<term: string, confidence: double>>").alias("terms"), "ord")
    same = joins.identical_form(ours, theirs).select(F.lit("identical").alias("part"), "lemma", "pos", "term", "confidence", F.lit("io_wiktionary").alias("source"), none("string").alias("via"))
    own = rows.select("lemma", "pos", F.explode("_own").alias("t"))
    own = own.select(F.lit("own").alias("part"), "lemma", "pos", "t.term", F.coalesce("t.confidence", F.lit(0.5)).alias("confidence"), F.coalesce("t.source", F.lit("io_wiktionary")).alias("source"), none("string").alias("via"))
    bare = derive.keep_without_term(rows.select(F.btrim("lemma").alias("lemma"), "pos", F.size("_own").alias("n_terms"), F.size("_any").alias("n_other")).where("lemma != ''"))
    alone = lambda d, part: d.select(F.lit(part).alias("part"), "lemma", "pos", none("string").alias("term"), none("double").alias("confidence"), none("string").alias("source"), none("string").alias("via"))
    turned = eo.select("lemma", "pos", F.explode(F.array_distinct(F.transform(listed(eo, lambda g: g == "io"), lambda t: F.btrim(t["term"])))).alias("io")).where("io != ''")
    turned = turned.select(F.lit("turned").alias("part"), F.col("io").alias("lemma"), "pos", F.col("lemma").alias("term"), F.lit(0.6).alias("confidence"), F.lit("eo_wiktionary").alias("source"), none("string").alias("via"))
    out = same.unionByName(own).unionByName(alone(bare, "bare")).unionByName(alone(titles.where("language = 'io'"), "title")).unionByName(turned)
    for pivot, pairs in via.items():
        fits = pairs.where("coalesce(lemma, '') != '' and coalesce(term, '') != ''").where(X.same_pos_pair(F.col("lemma"), F.col("term")))
        out = out.unionByName(fits.select(F.lit(f"via_{pivot}").alias("part"), "lemma", "pos", "term", F.coalesce("confidence", F.lit(0.8)).alias("confidence"), F.lit(f"{pivot}_wiktionary_via").alias("source"), "via"))
    return out


def analyse(tokens: DataFrame, entries: DataFrame, table: list[tuple] = rules.PARADIGMS) -> DataFrame:
    """tokens (token, ...) with lemma, pos, n_readings and candidates, by the surfaces of entries (lemma, paradigm).

    Every reading (lemma, class) of a surface counts; the one that is the surface itself comes first, then by class and lemma.
    Candidates for a lookup: the token, its root, the root with the class's citation ending. Numbers are their own
    lemma; an unknown token is its own lemma without a class or readings.
    """
    forms = derive.expand_surfaces(entries.select("lemma", "paradigm"), table)
    readings = forms.select("surface", "lemma", F.substring_index("tags", ".", 1).alias("pos"), X.stem(F.col("lemma"), F.col("paradigm")).alias("root")).distinct()
    best = F.min(F.struct((F.col("lemma") != F.col("surface")).alias("other"), "pos", "lemma", "root"))
    index = readings.groupBy("surface").agg(best.alias("b"), F.count_distinct("lemma", "pos").alias("n"))
    out = tokens.join(index, F.col("token") == F.col("surface"), "left")
    number = F.when(F.lit(False), F.lit(""))
    for _, pattern, tags in rules.DIGIT_PARADIGMS:
        number = number.when(F.col("token").rlike(pattern), tags.split(".")[0])
    ending = X.lookup(rules.CITATION_ENDINGS, F.col("b.pos"))
    candidates = F.array_compact(F.array("token", "b.root", F.concat("b.root", ending)))
    return out.select(
        *tokens.columns, F.coalesce("b.lemma", "token").alias("lemma"), F.coalesce("b.pos", number).alias("pos"),
        F.coalesce("n", F.when(number.isNotNull(), 1), F.lit(0)).cast("bigint").alias("n_readings"), F.array_distinct(candidates).alias("candidates"),
    )


def override(entries: DataFrame, table: DataFrame, source: str = "function_word_override") -> DataFrame:
    """entries (lemma, pos, paradigm, terms map<term, sources>, sources) with table (lemma, pos, term, paradigm): forced classes, terms and provenance.

    A row of the table makes the entry if there is none (case of the lemma aside), gives it the paradigm of the table or of its
    class, adds or replaces the term's sources, and marks the entry; of rows with one lemma and class the last term in order counts last.
    """
    par = F.coalesce("paradigm", X.lookup(rules.POS_PARADIGM, F.col("pos")), F.concat(F.lit("__"), "pos"))
    forced = table.groupBy(F.lower("lemma").alias("_l"), F.col("pos").alias("_p")).agg(F.max(par).alias("_paradigm"), F.array_sort(F.collect_set("term")).alias("_terms"))
    both = entries.join(forced, (F.lower("lemma") == F.col("_l")) & (F.col("pos") == F.col("_p")), "full_outer")
    hit = F.col("_l").isNotNull()
    kept = F.map_filter(F.coalesce("terms", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<array<string>>"))), lambda k, v: ~F.array_contains("_terms", k))
    new = F.map_from_arrays("_terms", F.transform("_terms", lambda _: F.array(F.lit(source))))
    return both.select(
        F.coalesce("lemma", "_l").alias("lemma"), F.coalesce("pos", "_p").alias("pos"), F.when(hit, F.col("_paradigm")).otherwise(F.col("paradigm")).alias("paradigm"),
        F.when(hit, F.map_concat(kept, new)).otherwise(F.col("terms")).alias("terms"),
        F.when(hit, F.array_sort(F.array_union(F.coalesce("sources", F.array().cast("array<string>")), F.array(F.lit(source))))).otherwise(F.col("sources")).alias("sources"),
    )
