"""Queries of aligned, analysed, overridden and prepared vocabularies."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import rules
from ..functions import text as X
from ..operators import frequency, vocabulary
from . import views as V
from .catalog import _CLASS, _CLEAN, _FORMS, _PARADIGM, _VALID, QUERIES, SQL, _stems, query  # noqa: F401  (one registry)

def _translation(lang, term, confidence=None, source=None):
    c = F.lit(confidence).cast("double") if confidence is None or isinstance(confidence, float) else confidence
    return F.struct(F.lit(lang).alias("lang"), term.alias("term"), c.alias("confidence"), F.lit(source).cast("string").alias("source"))


def _sides(spark, d):
    """Entries of both languages, titles and pivot pairs, made of the lexicon."""
    lex = V.lexicon(spark, d)
    n, empty = F.length("lemma") % 4, F.array().cast("array<struct<lang: string, term: string, confidence: double, source: string>>")
    pos = F.when(F.length("lemma") % 3 == 0, "noun").when(F.length("lemma") % 3 == 1, "adv")
    one = lambda rows: rows.select(F.concat("lemma", F.lit(" "), "term").alias("ord"), "lemma", pos.alias("pos"), "translations")
    io = one(lex.withColumn("translations", F.when(n == 0, empty).when(n == 1, F.array(_translation("en", F.col("term")))).when(n == 2, F.array(_translation("eo", F.col("term"), 0.9, "s"), _translation("en", F.lit("x")))).otherwise(F.array(_translation("eo", F.col("term")), _translation("eo", F.lit(""))))))
    eo = one(lex.where("idx % 2 = 0").withColumn("translations", F.array(_translation("io", F.concat(F.lit(" "), "term")), _translation("io", F.col("term")), _translation("en", F.when(F.length("term") % 2 == 0, "x").otherwise("y")))))
    titles = lex.select("lemma", F.lit("propn").alias("pos"), F.when(n == 3, "eo").otherwise("io").alias("language")).distinct()
    via = lex.select("lemma", pos.alias("pos"), "term", F.when(F.col("idx") == 0, F.lit(0.3)).alias("confidence"), F.substring("term", 1, 5).alias("via"))
    return io, eo, titles, {"en": via, "fr": via.where("confidence is null")}


_CLASSED = "coalesce(({0}) = (CASE WHEN {1} LIKE '%i' THEN 'v' WHEN {1} LIKE '%o' THEN 'n' WHEN {1} LIKE '%a' THEN 'adj' WHEN {1} LIKE '%e' THEN 'adv' END), true)"


@query("align_parts", f"""WITH {V.LEX}, e AS (SELECT *, length(lemma) % 4 AS n, CASE length(lemma) % 3 WHEN 0 THEN 'noun' WHEN 1 THEN 'adv' END AS pos FROM lex),
    io AS (SELECT lemma, pos, n, arg_max(term, lemma || ' ' || term) AS term FROM e WHERE pos IS NOT NULL GROUP BY lemma, pos, n), eo AS (SELECT lemma, pos, arg_max(length(term) % 2, lemma || ' ' || term) AS odd FROM e WHERE idx % 2 = 0 AND pos IS NOT NULL GROUP BY lemma, pos),
    v AS (SELECT lemma, pos, term, CASE WHEN idx = 0 THEN 0.3 END AS c, substr(term, 1, 5) AS via FROM e WHERE {_CLASSED.format(_CLASS.format('lemma'), 'term')})
    SELECT 'identical' AS part, io.lemma, io.pos, io.term, CASE n WHEN 2 THEN 1.0 ELSE 0.8 END::DOUBLE AS confidence, 'io_wiktionary' AS source, NULL AS via FROM io JOIN eo ON io.lemma = eo.lemma AND io.pos = eo.pos WHERE n IN (2, 3) AND NOT (n = 2 AND odd = 1)
    UNION ALL SELECT 'own', lemma, pos, term, CASE n WHEN 2 THEN 0.9 ELSE 0.5 END, CASE n WHEN 2 THEN 's' ELSE 'io_wiktionary' END, NULL FROM e WHERE n IN (2, 3)
    UNION ALL SELECT 'bare', lemma, pos, NULL, NULL, NULL, NULL FROM e WHERE n = 1 AND NOT regexp_matches(lemma, '(as|is|os|us|ez)$') AND (coalesce(pos, '') = 'adv' OR regexp_matches(lemma, '(o|a|e|ar|ir)$'))
    UNION ALL SELECT DISTINCT 'title', lemma, 'propn', NULL, NULL, NULL, NULL FROM e WHERE n <> 3
    UNION ALL SELECT 'turned', term, pos, lemma, 0.6, 'eo_wiktionary', NULL FROM e WHERE idx % 2 = 0
    UNION ALL SELECT 'via_en', lemma, pos, term, coalesce(c, 0.8), 'en_wiktionary_via', via FROM v UNION ALL SELECT 'via_fr', lemma, pos, term, 0.8, 'fr_wiktionary_via', via FROM v WHERE c IS NULL""")
def align_parts(spark, d):
    return vocabulary.align(*_sides(spark, d))


@query("analyse", f"""WITH {V.LEX}, st AS (SELECT DISTINCT lemma, {_CLASS.format('lemma')} AS c FROM lex), rd AS (SELECT DISTINCT CASE c WHEN 'v' THEN regexp_replace(lemma, '(ar|ir|or)$', '') ELSE left(lemma, length(lemma) - 1) END AS root, s, lemma, string_split(tags, '.')[1] AS pos FROM st JOIN (VALUES {_FORMS}) p(k, par, s, tags) ON c = k),
    b AS (SELECT root || s AS surface, min((lemma <> root || s, pos, lemma, root)) AS r, count(DISTINCT (lemma, pos)) AS n FROM rd GROUP BY root || s),
    o AS (SELECT token, cnt, coalesce(r[3], token) AS lemma, r[4] AS root, coalesce(r[2], CASE WHEN regexp_matches(token, '^[0-9]+([.,][0-9]+)*$|^[0-9]+-?ma$') THEN 'num' END) AS pos, n FROM voc LEFT JOIN b ON token = surface)
    SELECT token, cnt, lemma, pos, coalesce(n, CASE WHEN pos = 'num' THEN 1 END, 0) AS n_readings,
    array_to_string(list_distinct_in_order, '|') AS candidates FROM (SELECT *, list_transform(list_filter(generate_series(1, 3), lambda i: c[i] IS NOT NULL AND list_position(c, c[i]) = i), lambda i: c[i]) AS list_distinct_in_order
        FROM (SELECT *, [token, root, root || CASE pos WHEN 'n' THEN 'o' WHEN 'vblex' THEN 'ar' WHEN 'adj' THEN 'a' WHEN 'adv' THEN 'e' END] AS c FROM o))""")
def analyse(spark, d):
    return vocabulary.analyse(V.vocabulary(spark, d), _stems(spark, d)).withColumn("candidates", F.array_join("candidates", "|"))


@query("forced_overrides", f"""WITH {V.LEX}, e AS (SELECT CASE WHEN length(lemma) % 2 = 0 THEN upper(lemma) ELSE lemma END AS lemma, CASE length(lemma) % 3 WHEN 0 THEN 'n' ELSE 'adv' END AS pos, 'o__n' AS paradigm, map_from_entries(list((term, sources) ORDER BY term)) AS terms FROM lex GROUP BY ALL),
    o AS (SELECT lemma, 'n' AS pos, CASE WHEN length(lemma) % 5 = 0 THEN '__adv' END AS paradigm, min(term) AS term FROM lex GROUP BY lemma UNION ALL SELECT DISTINCT lemma, 'x', NULL, 'z' FROM lex WHERE length(lemma) % 4 = 0),
    j AS (SELECT e.lemma AS el, e.pos AS ep, e.paradigm AS epar, e.terms, o.* FROM e FULL JOIN o ON lower(e.lemma) = o.lemma AND e.pos = o.pos)
    SELECT coalesce(el, lemma) AS lemma, coalesce(ep, pos) AS pos, CASE WHEN lemma IS NULL THEN epar ELSE coalesce(paradigm, CASE pos WHEN 'n' THEN 'o__n' ELSE '__x' END) END AS paradigm,
    CASE WHEN lemma IS NULL THEN 'seed' WHEN el IS NULL THEN 'function_word_override' ELSE 'function_word_override,seed' END AS sources,
    len(list_distinct(list_concat(coalesce(map_keys(terms), []), CASE WHEN lemma IS NULL THEN [] ELSE [term] END))) AS n_terms, CASE WHEN lemma IS NULL THEN array_to_string(map_values(terms)[1], ',') ELSE term END AS sample FROM j""")
def forced_overrides(spark, d):
    lex = V.lexicon(spark, d)
    e = lex.groupBy(F.when(F.length("lemma") % 2 == 0, X.upper(F.col("lemma"))).otherwise(F.col("lemma")).alias("lemma"), F.when(F.length("lemma") % 3 == 0, "n").otherwise("adv").alias("pos"))
    e = e.agg(F.lit("o__n").alias("paradigm"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("term", "sources")))).alias("terms"), F.array(F.lit("seed")).alias("sources"))
    o = lex.groupBy("lemma").agg(F.min("term").alias("term")).select("lemma", F.lit("n").alias("pos"), "term", F.when(F.length("lemma") % 5 == 0, "__adv").alias("paradigm"))
    o = o.unionByName(lex.where("length(lemma) % 4 = 0").select("lemma", F.lit("x").alias("pos"), F.lit("z").alias("term"), F.lit(None).cast("string").alias("paradigm")).distinct())
    out = vocabulary.override(e, o)
    forced = F.array_contains("sources", "function_word_override")
    chosen = F.map_filter("terms", lambda k, v: F.array_contains(v, "function_word_override"))
    return out.select("lemma", "pos", "paradigm", F.array_join("sources", ",").alias("sources"), F.size("terms").cast("bigint").alias("n_terms"), F.when(forced, F.get(F.map_keys(chosen), F.lit(0))).otherwise(F.array_join(F.get(F.map_values("terms"), F.lit(0)), ",")).alias("sample"))


def _raw_entries(spark, d):
    """Entries with marks, capitals, encyclopedia words and translations of every kind that preparing them tells apart."""
    lex, n = V.lexicon(spark, d), F.length("lemma") % 6
    lemma = F.when(n == 1, F.concat(F.lit("[["), "lemma", F.lit("]]"))).when(n == 2, X.capitalized(F.col("lemma"))).when(n == 3, F.concat("lemma", F.lit("ia"))).when(n == 4, F.concat("lemma", F.lit("ano"))).when(n == 5, F.lit("''")).otherwise(F.col("lemma"))
    term = lambda lang, t, k: F.struct(F.lit(k).alias("sense"), F.lit(lang).alias("lang"), t.alias("term"))
    m = F.length("term") % 4
    terms = F.when(m == 0, F.array(term("eo", F.col("term"), 0), term("en", F.concat(F.lit("2) "), "term", F.lit(" #T")), 1))).when(m == 1, F.array(term("eo", F.concat("term", F.lit(", x")), 0), term("eo", F.lit("a b c"), 1))).when(m == 2, F.array(term("eo", X.capitalized(F.col("term")), 0))).otherwise(F.array(term("en", F.lit("p, q"), 0), term("eo", F.lit("|"), 0)))
    sources = F.when(F.col("idx") % 3 == 0, F.array(F.lit("io_wikipedia"))).when(F.col("idx") % 3 == 1, F.array(F.lit("io_wikipedia"), F.lit("io_wiktionary"))).otherwise(F.array(F.lit("io_wiktionary")))
    pos = F.when(F.length("term") % 3 == 0, "noun").when(F.length("term") % 3 == 1, "adjective")
    language = F.when(F.col("idx") % 7 == 6, "").when(F.col("idx") % 5 == 4, "eo").otherwise("io")
    return lex.select(F.concat("lemma", F.lit(" "), "term").alias("ord"), lemma.alias("lemma"), pos.alias("pos"), language.alias("language"), sources.alias("sources"), terms.alias("translations"))


def _prepared(spark, d):
    return vocabulary.prepare(_raw_entries(spark, d), frequency.top_ranks(V.vocabulary(spark, d), 2000), 2000)


_FIRST = "upper(substr({0}, 1, 1)) || substr({0}, 2)"
_WIKI = "k < 2"
_STEPS = rf"""{V.LEX}, top AS (SELECT token FROM voc ORDER BY cnt DESC, token LIMIT 2000),
raw AS (SELECT lemma || ' ' || term AS ord, CASE length(lemma) % 6 WHEN 1 THEN '[[' || lemma || ']]' WHEN 2 THEN {_FIRST.format('lemma')} WHEN 3 THEN lemma || 'ia' WHEN 4 THEN lemma || 'ano' WHEN 5 THEN '''''' ELSE lemma END AS raw,
    CASE length(term) % 3 WHEN 0 THEN 'noun' WHEN 1 THEN 'adjective' END AS pos, CASE WHEN idx % 7 = 6 THEN '' WHEN idx % 5 = 4 THEN 'eo' ELSE 'io' END AS language, idx % 3 AS k,
    CASE length(term) % 4 WHEN 0 THEN [('eo', term), ('en', '2) ' || term || ' #T')] WHEN 1 THEN [('eo', term || ', x'), ('eo', 'a b c')] WHEN 2 THEN [('eo', {_FIRST.format('term')})] ELSE [('en', 'p, q'), ('eo', '|')] END AS ts FROM lex),
u AS (SELECT ord, unnest(ts) AS x, generate_subscripts(ts, 1) AS i FROM raw), c1 AS (SELECT ord, i, x[1] AS lang, {_CLEAN.format('x[2]')} AS term FROM u), c2 AS (SELECT * FROM c1 WHERE {_VALID.format('term')}),
c3 AS (SELECT ord, list((lang, term) ORDER BY i) AS ts, list_sort(list(DISTINCT term) FILTER (lang = 'eo')) AS own, bool_and(regexp_matches(term, '^\p{{Ll}}')) FILTER (lang = 'eo') AS low FROM c2 GROUP BY ord),
n1 AS (SELECT raw.* EXCLUDE (ts), coalesce(c3.ts, []) AS ts, coalesce(own, []) AS own, coalesce(low, false) AS low, {_CLEAN.format('raw')} AS l FROM raw LEFT JOIN c3 USING (ord)),
n2 AS (SELECT *, CASE WHEN regexp_matches(l, '^\p{{Lu}}') AND (low OR coalesce(pos = 'adjective', false)) THEN lower(substr(l, 1, 1)) || substr(l, 2) ELSE l END AS lemma, l <> raw AS cleaned FROM n1),
n3 AS (SELECT * FROM n2 WHERE {_VALID.format('lemma')}),
n4 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lower(lemma), lower(coalesce(pos, '')), lower(language), own ORDER BY ord) AS r FROM n3) WHERE r = 1),
n5 AS (SELECT * EXCLUDE (pos), pos AS given, CASE pos WHEN 'noun' THEN 'n' WHEN 'adjective' THEN 'adj' END AS pos FROM n4),
n6 AS (SELECT *, CASE WHEN ({_PARADIGM}) IS NOT NULL THEN ({_PARADIGM}) WHEN {_WIKI} AND (regexp_matches(lemma, '^\p{{Lu}}') OR lower(lemma) LIKE '%i') THEN 'o__n' END AS paradigm FROM n5),
tw AS (SELECT lemma AS made_of, lemma, pos, paradigm, 0 AS rule, * EXCLUDE (lemma, pos, paradigm) FROM n6
    UNION ALL SELECT lemma, left(lemma, length(lemma) - 3) || 'ana', 'adjective', 'a__adj', 1, * EXCLUDE (lemma, pos, paradigm) FROM n6 WHERE lower(lemma) LIKE '%ano' AND paradigm = 'o__n'
    UNION ALL SELECT lemma, left(lemma, length(lemma) - 3) || 'ano', 'noun', 'o__n', 2, * EXCLUDE (lemma, pos, paradigm) FROM n6 WHERE lower(lemma) LIKE '%ana' AND paradigm = 'a__adj'
    UNION ALL SELECT lemma, lemma || 'na', 'adjective', 'a__adj', 3, * EXCLUDE (lemma, pos, paradigm) FROM n6 WHERE lower(lemma) LIKE '%ia' AND paradigm = 'o__n'
    UNION ALL SELECT lemma, lemma || 'na', 'adjective', 'a__adj', 4, * EXCLUDE (lemma, pos, paradigm) FROM n6 WHERE {_WIKI} AND lower(lemma) LIKE '%a' AND paradigm = 'o__n' AND length(lemma) > 3
    UNION ALL SELECT lemma, left(lemma, length(lemma) - 2), 'noun', 'o__n', 5, * EXCLUDE (lemma, pos, paradigm) FROM n6 WHERE lower(lemma) LIKE '%iana' AND paradigm = 'a__adj'
    UNION ALL SELECT lemma, left(lemma, length(lemma) - 2), 'noun', 'o__n', 6, * EXCLUDE (lemma, pos, paradigm) FROM n6 WHERE lower(lemma) LIKE '%ana' AND paradigm = 'a__adj'),
n7 AS (SELECT *, row_number() OVER () AS id FROM (SELECT *, row_number() OVER (PARTITION BY lemma ORDER BY made_of, coalesce(given, 'None'), ord, rule) AS r2 FROM tw) WHERE rule = 0 OR r2 = 1),
n8 AS (SELECT *, CASE WHEN language = '' THEN 'bad_schema' WHEN NOT ({_VALID.format('lemma')}) THEN 'bad_lemma' WHEN k = 0 AND NOT regexp_matches(lower(regexp_replace(lemma, '^.*[ -]', '')), '(ano|ana)$') AND NOT list_has_any(string_split_regex(lower(lemma), '\s+'), (SELECT list(token) FROM top)) THEN 'wiki_low_freq' ELSE 'kept' END AS status FROM n7),
w1 AS (SELECT id, status, lemma, unnest(ts) AS x, generate_subscripts(ts, 1) AS i FROM n8),
w2 AS (SELECT *, x[1] AS lang, CASE WHEN regexp_matches(trim(x[2]), '[|{{}}]|bgcolor') THEN '' ELSE {V.sql_chain('trim(x[2])', rules.VOCABULARY_CHAIN)} END AS y FROM w1),
w3 AS (SELECT *, CASE WHEN contains(y, '*') THEN '' ELSE trim(regexp_replace(y, '\s+', ' ', 'g')) END AS term FROM w2),
w4 AS (SELECT *, CASE WHEN lang = 'eo' AND NOT regexp_matches(term, '^[A-Za-zĈĜĤĴŜŬĉĝĥĵŝŭ\-]+( [A-Za-zĈĜĤĴŜŬĉĝĥĵŝŭ\-]+)?$') THEN 'bad_tr_eo' WHEN contains(term, ',') THEN 'comma_tr' END AS why FROM w3 WHERE term <> ''),
w5 AS (SELECT id, string_agg(lang || ':' || term, '|' ORDER BY i) FILTER (why IS NULL) AS translations, count(*) FILTER (why IS NOT NULL) AS gone FROM w4 GROUP BY id)"""


@query("vocabulary_entries", f"""WITH {_STEPS} SELECT lemma, pos, language, paradigm, rule > 0 AS made, ['io_wikipedia', 'io_wikipedia,io_wiktionary', 'io_wiktionary'][k + 1] AS sources, coalesce(translations, '') AS translations
    FROM n8 LEFT JOIN w5 USING (id) WHERE status = 'kept' AND (translations IS NOT NULL OR language = 'io')""")
def vocabulary_entries(spark, d):
    listed = F.array_join(F.transform("translations", lambda t: F.concat_ws(":", t["lang"], t["term"])), "|")
    return _prepared(spark, d).entries.withColumns({"sources": F.array_join("sources", ","), "translations": listed})


@query("vocabulary_suspects", f"WITH {_STEPS} SELECT 'wiki_low_freq' AS reason, lemma, NULL AS term FROM n8 WHERE status = 'wiki_low_freq' UNION ALL SELECT why, lemma, term FROM w4 WHERE why IS NOT NULL AND status = 'kept'")
def vocabulary_suspects(spark, d):
    return _prepared(spark, d).suspects


@query("vocabulary_counters", f"""WITH {_STEPS}, a AS (SELECT count(*) AS input, count(*) FILTER (cleaned) AS cleaned FROM n2), b AS (SELECT count(*) AS n FROM n3), c AS (SELECT count(*) AS output FROM n4),
    s AS (SELECT count(*) FILTER (status = 'bad_schema') AS bad_schema, count(*) FILTER (status = 'bad_lemma') AS bad_lemma, count(*) FILTER (status = 'wiki_low_freq') AS wiki_low_freq, count(*) FILTER (status = 'kept' AND translations IS NULL) AS all_tr_removed, coalesce(sum(gone) FILTER (status = 'kept'), 0)::BIGINT AS tr_removed FROM n8 LEFT JOIN w5 USING (id))
    SELECT input, cleaned, input - n AS invalid, n - output AS duplicates, output, s.* FROM a, b, c, s""")
def vocabulary_counters(spark, d):
    return _prepared(spark, d).counters
