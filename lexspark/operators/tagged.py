"""Tables of tagged word pairs for a translation dictionary: left and right words with their tags and the direction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as X
from .derive import rule_frame

BOTH, REVERSE = "", "rl"


def pair_tag(paradigm: Column, pos: Column) -> Column:
    """The tag of a paradigm, else of a function word's part of speech, else empty."""
    return F.coalesce(X.tag_of(paradigm), F.when(pos.isin(*rules.TAG_POS), pos), F.lit(""))


def _row(left, left_tags, right, right_tags, direction: str = BOTH) -> Column:
    text = lambda x: F.lit(x) if isinstance(x, str) else x
    return F.struct(left.alias("left"), text(left_tags).alias("left_tags"), right.alias("right"), text(right_tags).alias("right_tags"), F.lit(direction).alias("direction"))


def is_symbol(lemma: Column, paradigm: Column, pos: Column) -> Column:
    """Shaped like the symbol of an element and an adjective by its ending alone."""
    return lemma.rlike(r"^\p{Lu}\p{Ll}$") & (paradigm == "a__adj") & pos.isNull()


def tagged_pairs(winners: DataFrame, reverse_verbs: DataFrame) -> DataFrame:
    """winners (lemma, pos, paradigm, term) and target verbs of another class (term) to left, left_tags, right, right_tags, direction.

    Every winner with a paradigm is a pair of stem and term under one tag, none where neither paradigm nor
    part of speech has one; a pronoun is a possessive besides; a verb that the target conjugates otherwise has a
    reverse row besides. Contractions give one row for each preposition, whatever their term. Lemmas shaped
    like symbols and winners without a paradigm give none. A null term or lemma gives none.
    """
    rows = winners.select(F.btrim("lemma").alias("lemma"), "pos", F.nullif("paradigm", F.lit("")).alias("paradigm"), "term").where("lemma != '' and term is not null and paradigm is not null")
    rows = rows.where(~F.coalesce(is_symbol(F.col("lemma"), F.col("paradigm"), F.col("pos")), F.lit(False)))
    verbs = reverse_verbs.select("term").distinct().withColumn("other", F.lit(True))
    plain = rows.where("paradigm != 'prep_art'").join(verbs, "term", "left")
    stem, tag = X.stem(F.col("lemma"), F.col("paradigm")), pair_tag(F.col("paradigm"), F.col("pos"))
    pronoun = (F.btrim("paradigm", F.lit("_")) == "prn") & F.lower("lemma").isin(*rules.PERSONAL_PRONOUNS) & (F.col("term") != "")
    pairs = F.array(
        _row(stem, tag, F.col("term"), tag),
        F.when(pronoun, _row(F.col("lemma"), "adj", F.concat("term", F.lit("a")), "adj")),
        F.when((tag == "vblex") & F.col("other"), _row(stem, "vblex", F.col("term"), "vbser", REVERSE)),
    )
    table = rule_frame(winners.sparkSession, rules.CONTRACTIONS, "contraction string, base string, target string")
    whole = rows.where("paradigm = 'prep_art'").join(table, F.lower("lemma") == F.col("contraction")).select("base", "target").distinct()
    contracted = whole.select(_row(F.col("base"), "pr.def", F.col("target"), "pr.def").alias("p"))
    return plain.select(F.explode(F.array_compact(pairs)).alias("p")).unionByName(contracted).select("p.*")


def pairs_by_confidence(terms: DataFrame, least: float = 0.0, bare: bool = False) -> DataFrame:
    """terms (lemma, pos, term, confidence, ord) to left, tag, right, place: pairs of one entry (lemma, pos), the surest first.

    Terms that are the lemma itself, in any case, go where the entry has another term; so do those below ``least``.
    Confidences that are null count as 0; equal ones stay in the order of ``ord``. Function words have no tag.
    A lemma that is nothing but its ending gives pairs only if asked for (``bare``), with an empty left word.
    """
    rows = terms.select(F.btrim("lemma").alias("lemma"), "pos", F.btrim("term").alias("term"), F.coalesce("confidence", F.lit(0.0)).alias("confidence"), "ord")
    rows = rows.where((F.col("lemma") != "") & (F.col("term") != "") & (F.col("confidence") >= least))
    same = F.lower("lemma") == F.lower("term")
    every = F.array_sort(F.collect_list(F.struct((-F.col("confidence")).alias("c"), "ord", "term", same.alias("same"))))
    entries = rows.groupBy("lemma", "pos").agg(every.alias("all"))
    kept = X.let(F.filter("all", lambda t: ~t["same"]), lambda others: F.when(F.size(others) > 0, others).otherwise(F.col("all")))
    named = X.pair_pos(F.col("pos"))
    out = entries.select(X.stem_by_pos(F.col("lemma"), F.col("pos")).alias("left"), F.coalesce(X.lookup(rules.PAIR_TAGS, F.when(~named.isin("det", "prn"), named)), F.lit("")).alias("tag"), F.posexplode(kept).alias("place", "t"))
    return (out if bare else out.where("left != ''")).select("left", "tag", F.col("t.term").alias("right"), "place")
