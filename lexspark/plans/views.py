"""Views that the registered queries share, as DataFrames and as SQL: tokens, vocabulary, and a lexicon made of the corpus.

The lexicon pairs all Spanish and French words that share their first five letters, or all of a shorter one; its
sources are those of the French word's documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import frequency
from ..operators.skew import split_join


def _number(source: Column) -> Column:
    return F.substr(source, F.lit(4)).try_cast("int")


#: Ranks of the tables' sources in the registered queries, by a source's number, however many there are.
RANKS = lambda s: _number(s) % 5
OTHER_RANKS = lambda s: (_number(s) * 3 + 1) % 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.tokens(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))


def token_runs(spark: SparkSession, sf_dir: str, together: bool = False) -> DataFrame:
    """doc_id, token, n. If asked, rows of one doc_id come together as texts, which are much smaller than their words; what groups the words by doc_id finds them in place."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # Eight parts for each split of the input: a part's words are many times its text, and should fit a task's memory.
    return frequency.token_runs(docs.repartition(8 * docs.rdd.getNumPartitions(), "doc_id") if together else docs)


def vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.token_counts(table(spark, sf_dir, "documents"))


def known_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.tokens(table(spark, sf_dir, "benchmark").select("text")).distinct()


def lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lemma, term, sources, idx."""
    word = tokens(spark, sf_dir).where("lang in ('es', 'fr')")
    word = word.groupBy("lang", "token").agg(F.array_sort(F.collect_set("source")).alias("sources")).withColumn("head", F.substring("token", 1, 5))
    a = word.where("lang = 'es'").select("head", F.col("token").alias("lemma"))
    b = word.where("lang = 'fr'").select("head", F.col("token").alias("term"), "sources")
    idx = F.row_number().over(Window.partitionBy("lemma").orderBy("term")) - 1
    return split_join(a, b, ["head"]).select("lemma", "term", "sources", idx.alias("idx"))


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lexicon as rows lemma, pos, term, source, ord: some lemmas capitalised, some without a part of speech, terms in lists."""
    lex = lexicon(spark, sf_dir)
    n = F.length("lemma")
    lemma = F.when(n % 5 == 0, X.capitalized(F.col("lemma"))).otherwise(F.col("lemma"))
    pos = F.when(n % 3 == 0, F.lit("")).when(n % 3 == 1, F.lit("noun")).otherwise(F.lit("adjective"))
    term = F.when(F.length("term") % 4 == 0, F.concat("term", F.lit(", "), "term", F.lit("n"))).otherwise(F.col("term"))
    return lex.select(lemma.alias("lemma"), pos.alias("pos"), term.alias("term"), F.explode("sources").alias("source"), F.concat("term", F.lit(" "), "source").alias("ord"))


#: Marked-up forms of a word, by the word's count.
FORMS = [
    "'''{w}'''", "[[{w}]]", "[[x{w}|{w}]]", "{{{{io}}}} {w}", "{{{{t+|eo|{w}|alt=z}}}}", "{{{{x|{w}}}}}", "1. {w}", "{w} (io)",
    "{w} ↓ ", "{w} (♀)", ": {w};", "<b>{w}</b>", "{w} [[Kategorio:Eo {w}]]", "{w} &amp; {w}", "(1) {w}, {w}a; (2) {w}o", "{w}, {w}e", "{w}; {w}i", "* {w} | }} z",
]


def marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """token, raw: every word of the vocabulary in one of the marked-up forms."""
    k = F.pmod(F.col("cnt") + F.length("token") * 7, F.lit(len(FORMS)))
    out = F.when(F.lit(False), F.lit(""))
    for i, form in enumerate(FORMS):
        parts = form.format(w="\x01").split("\x01")
        out = out.when(k == i, F.concat(*[x for p in parts for x in (F.lit(p), F.col("token"))][:-1]))
    return vocabulary(spark, sf_dir).select("token", out.alias("raw"))


# -- the same in SQL --------------------------------------------------------------------------------

TOK = r"""tok AS (SELECT doc_id, lang, source, token FROM (SELECT doc_id, lang, source, unnest(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+')) AS token FROM documents) WHERE length(token) >= 2)"""
VOC = TOK + ", voc AS (SELECT token, count(*) AS cnt FROM tok GROUP BY token)"
KNOWN = r"""known AS (SELECT DISTINCT token FROM (SELECT unnest(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}_]+')) AS token FROM benchmark) WHERE length(token) >= 2)"""
LEX = (
    VOC
    + """, word AS (SELECT lang, token, list_sort(list(DISTINCT source)) AS sources FROM tok WHERE lang IN ('es', 'fr') GROUP BY lang, token),
lex AS (SELECT a.token AS lemma, b.token AS term, b.sources, row_number() OVER (PARTITION BY a.token ORDER BY b.token) - 1 AS idx
    FROM word a JOIN word b ON a.lang = 'es' AND b.lang = 'fr' AND substr(a.token, 1, 5) = substr(b.token, 1, 5))"""
)
ENT = (
    LEX
    + """, ent AS (SELECT CASE WHEN length(lemma) % 5 = 0 THEN upper(substr(lemma, 1, 1)) || substr(lemma, 2) ELSE lemma END AS lemma,
    CASE length(lemma) % 3 WHEN 0 THEN '' WHEN 1 THEN 'noun' ELSE 'adjective' END AS pos,
    CASE WHEN length(term) % 4 = 0 THEN term || ', ' || term || 'n' ELSE term END AS term, source, term || ' ' || source AS ord
    FROM (SELECT lemma, term, unnest(sources) AS source FROM lex))"""
)
MARKED = (
    VOC
    + ", marked AS (SELECT token, CASE (cnt + length(token) * 7) % "
    + str(len(FORMS))
    + " "
    + " ".join(f"WHEN {i} THEN " + " || ".join([f"'{p.replace(chr(39), chr(39) * 2)}'" + (" || token" if j < f.format(w=chr(1)).count(chr(1)) else "") for j, p in enumerate(f.format(w=chr(1)).split(chr(1)))]) for i, f in enumerate(FORMS))
    + " END AS raw FROM voc)"
)
RANK = "coalesce(list_min(list_transform(sources, lambda s: CAST(substr(s, 4) AS INT) % 5)), 2)"
OTHER_RANK = "coalesce(list_min(list_transform(sources, lambda s: (CAST(substr(s, 4) AS INT) * 3 + 1) % 5)), 2)"


def sql_chain(expr: str, steps: list[tuple[str, str]]) -> str:
    for pattern, new in steps:
        expr = f"regexp_replace({expr}, '{pattern.replace(chr(39), chr(39) * 2)}', '{new.replace('$', chr(92)).replace(chr(39), chr(39) * 2)}', 'g')"
    return expr
