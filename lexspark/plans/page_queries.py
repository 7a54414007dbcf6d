"""Queries over pages: entries with pivots and variants. The pages are made of the lexicon, in layouts that reach each branch."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import wikitext as W
from ..operators import closed_class, joins
from ..sources import readers
from ..storage import saved
from . import views as V
from .catalog import _TRANSLATION, QUERIES, SQL, query  # noqa: F401  (one registry)

#: Pages of a headword ‹w› with the terms ‹t›.
LAYOUTS = [
    "== {{io}} ==\n* Semantiko: adjektivo\n* {{eo}}: ‹t›\n* Morfologio: [[‹w›]][[.o]]\n== Suomi ==\n* {{eo}}: ne\n",
    "==II {{io}} (verbo)==\n* {{eo}}: {{t+|eo|‹w›|x}}\n* Angliana: ‹t› {{x}}\n* Morfologio: ‹w›.ar\n",
    "== Ido ==\nEsperanto: ‹t›\n* Morfologio: ‹w› .a [[Kategorio:x]]\n",
    "== {{io}} ==\n* English: ‹t›\n* {{fr}}. ‹w›; ‹w›n\n",
    "== {{io}} ==\n* Semantiko: ''kurta'' formo de [[x|‹w›u]]\n",
    "{{-ido-}}\n* Semantiko: formo de [[verbo]] x\n* {{eo}}: ‹t›",
    "== English ==\n* {{eo}}: ‹t›\n",
    "== Ido ==\n===Substantivo===\n* EO - ‹t› |} z\n{{l|eo|‹w›|alt}}\n{{m|fr|‹w›}}\n{{trad+|eo|‹w›}}",
    "== {{io}} ==\nnothing\n* {{eo}}:\n* Morfologio: ‹w›.o",
    "== {{io}} ==\n* {{eo}}: (1) ‹w›, ‹w›a; (2) ‹w›o\n== X ==\n==I Ido==\n* English: ‹w›, , z\nx Franciana - ‹w›",
    "== {{io}} ==\n* Semantiko: kurta formo de ‹w›\n* {{eo}}: ‹t›",
]
LANGS = {"eo": 0.6, "en": 0.5, "fr": 0.5}


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def _layout_sql(layout: str) -> str:
    return " || ".join(_quoted(p) if k % 2 == 0 else {"w": "lemma", "t": "array_to_string(t, ', ')"}[p] for k, p in enumerate(layout.replace("›", "‹").split("‹")) if p)


def _dealt(pages):
    """Pages spread over all partitions, as a dump would be: reading wikitext costs far more than moving it, so their size is no measure of the work.

    Saved, so that the long expressions of the extraction aren't planned anew with each stage before them.
    """
    return saved(pages.repartition(int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "pages")


def entry_pages(spark, d):
    """title, text: a page for each lemma of the lexicon."""
    lex = V.lexicon(spark, d).groupBy("lemma").agg(F.array_sort(F.collect_set("term")).alias("t"))
    k = (F.length("lemma") * 7 + F.size("t")) % len(LAYOUTS)
    text = F.when(F.lit(False), F.lit(""))
    for i, layout in enumerate(LAYOUTS):
        pieces = [F.lit(p) if j % 2 == 0 else {"w": F.col("lemma"), "t": F.array_join("t", ", ")}[p] for j, p in enumerate(layout.replace("›", "‹").split("‹"))]
        text = text.when(k == i, F.concat(*pieces))
    return _dealt(lex.select(F.col("lemma").alias("title"), text.alias("text")))


_HEADERS = _quoted("(?i)(?:" + "|".join(W.SECTION_HEADERS["io"]) + ")")
_PATTERNS = ", ".join(f"({k}, '{lang}', {i}, {_quoted(p)})" for k, lang in enumerate(LANGS) for i, p in enumerate(W.translation_patterns(lang)))
_PAGES = f"""{V.LEX}, base AS (SELECT lemma, list_sort(list(DISTINCT term)) AS t FROM lex GROUP BY lemma),
pg AS (SELECT lemma AS title, CASE (length(lemma) * 7 + len(t)) % {len(LAYOUTS)} {" ".join(f"WHEN {i} THEN {_layout_sql(x)}" for i, x in enumerate(LAYOUTS))} END AS text FROM base),
cut AS (SELECT title, string_split(regexp_replace(text, {_HEADERS}, chr(1) || '\\0', 'g'), chr(1)) AS p FROM pg),
sec AS (SELECT title, array_to_string(list_transform(range(2, len(p) + 1), lambda i: regexp_extract(array_to_string(p[i:], ''), '(?s)^(.*?)(?:\\n==[^=].*)?$', 1)), chr(10)) AS s FROM cut WHERE len(p) > 1),
fact AS (SELECT title, s, lower(s) AS low, regexp_replace(s, '\\[\\[(?:[^\\]|]*\\|)?([^\\]]+)\\]\\]', '\\1', 'g') AS plain,
    regexp_replace(trim(regexp_extract(s, '\\*\\s*Morfologio\\s*:\\s*([^\\[\\n]+(?:\\[\\[[^\\]]*\\]\\][^\\n]*)?)', 1)), '\\[\\[|\\]\\]| ', '', 'g') AS line FROM sec),
kept AS (SELECT *, regexp_extract(line, '[\\p{{L}}\\p{{N}}_]+(\\.[a-z]+)', 1) AS ending, lower(regexp_extract(replace(plain, '''''', ''), '(?i)\\bform[oi]\\s+(?:de|di)\\s+(?:(?:la|l''|vorto)\\s+)*([a-z]+)(?:[^\\p{{L}}\\p{{N}}_]|$)', 1)) AS b FROM fact
    WHERE NOT regexp_matches(plain, '(?i)\\*\\s*Semantiko\\s*:[^\\n]*\\bform[oi]\\s+(de|di)\\s+(la\\s+)?(verbo|substantivo|adjektivo|adverbo|pronomo)\\b')),
blob AS (SELECT title, k, lang, i, unnest(regexp_extract_all(s, pattern, 1)) AS raw, generate_subscripts(regexp_extract_all(s, pattern, 1), 1) AS j FROM kept, (VALUES {_PATTERNS}) v(k, lang, i, pattern)),
tr AS (SELECT *, {_TRANSLATION} AS t FROM blob),
mean AS (SELECT *, regexp_extract_all(t, '\\(([0-9]+)\\)\\s*([^;()]+)', 2) AS num, list_transform(string_split(t, ','), lambda x: trim(x)) AS parts FROM tr WHERE t <> ''),
lists AS (SELECT *, CASE WHEN len(num) > 0 THEN list_transform(num, lambda x: list_filter(list_transform(string_split(x, ','), lambda y: trim(y)), lambda y: y <> ''))
    WHEN contains(t, ';') THEN list_transform(string_split(t, ';'), lambda x: list_filter(list_transform(string_split(x, ','), lambda y: trim(y)), lambda y: y <> ''))
    WHEN len(parts) BETWEEN 2 AND 8 AND len(list_filter(parts, lambda x: length(x) >= 20)) = 0 THEN [parts] ELSE [[t]] END AS ms FROM mean),
one AS (SELECT title, k, lang, i, j, unnest(ms) AS m, generate_subscripts(ms, 1) AS n FROM lists),
first AS (SELECT title, k, lang, arg_min(m, (i, j, n)) AS m, min((i, j, n)) AS seen FROM one WHERE len(m) > 0 AND len(list_filter(m, lambda x: trim(x) = '')) = 0 GROUP BY title, k, lang, list_sort(m)),
sense AS (SELECT title, lang, m, row_number() OVER (PARTITION BY title ORDER BY k, seen) - 1 AS sense_no FROM first),
ext AS (SELECT title AS lemma,
    coalesce(CASE WHEN regexp_matches(low, '\\{{\\{{io\\}}\\}}\\s*\\(verbo\\)') THEN 'verb' WHEN regexp_matches(low, '(?m)^===substantivo===$') THEN 'noun' WHEN regexp_matches(low, '\\* semantiko: adjektivo') THEN 'adjective' END,
        CASE WHEN ending IN ('.a', '.ala', '.ada', '.ade', '.ula') THEN 'adjective' WHEN ending IN ('.o', '.oi', '.ajo', '.ego', '.ujo') THEN 'noun' WHEN ending IN ('.ar', '.ir', '.or', '.esar', '.iar') THEN 'verb' WHEN ending IN ('.e', '.ime', '.en', '.ene') THEN 'adverb' END) AS pos,
    CASE WHEN b <> '' AND b <> lower(title) THEN b END AS form_of, CASE WHEN ending <> '' THEN line END AS morphology,
    CASE WHEN ending IN ('.o', '.oi', '.ajo', '.ego', '.ujo') THEN 'o__n' WHEN ending IN ('.ar', '.ir', '.or', '.esar', '.iar') THEN 'ar__vblex' END AS paradigm,
    sense_no, lang, unnest(coalesce(m, [NULL])) AS term, CASE lang WHEN 'eo' THEN 0.6::DOUBLE WHEN 'en' THEN 0.5::DOUBLE WHEN 'fr' THEN 0.5::DOUBLE END AS confidence FROM kept LEFT JOIN sense USING (title) WHERE m IS NOT NULL OR b <> '')"""


@query("extract_entries", f"WITH {_PAGES} SELECT * FROM ext")
def extract_entries(spark, d):
    return readers.extract_entries(entry_pages(spark, d), "io", "eo")


@query("variant_entries", f"""WITH {_PAGES}, e AS (SELECT lemma, form_of, list_distinct(coalesce(list(term ORDER BY sense_no, term) FILTER (lang = 'eo'), [])) AS n, count(DISTINCT term) FILTER (lang = 'eo') AS c FROM ext GROUP BY lemma, form_of),
    u AS (SELECT DISTINCT lower(lemma) AS k, term FROM ext WHERE lang = 'eo')
    SELECT lemma, form_of, CASE WHEN c > 0 THEN c ELSE (SELECT count(*) FROM u WHERE k = lower(form_of)) END AS n_terms, c = 0 AND form_of IS NOT NULL AS inherits FROM e""")
def variant_entries(spark, d):
    """Entries of pages, variants with the terms of the lemma that they are a form of."""
    e = saved(readers.entry_terms(readers.extract_entries(entry_pages(spark, d), "io", "eo"), "eo"), "entries")  # the join below has them on both sides
    out = joins.resolve_variants(e.withColumn("own", F.size("terms")))
    return out.select("lemma", "form_of", F.size("terms").cast("bigint").alias("n_terms"), ((F.col("own") == 0) & F.col("form_of").isNotNull()).alias("inherits"))


#: A page with a pronoun table, a grid and a table after them, for a headword ‹w› with the first term ‹t›.
TABLES = """a
{| class="x"
| b || ‹w›
|}
== Pronomi ==
{| class=x
|+ titolo ‹w›
! Ido !! x
|- style=y
! Ido
| il(u) || style="b" | ‹w› || eli || nova
|-

|-
! [[x|Esperanto]]
| li¹
| ''[[y|‹t›]]'' / x<sup>2</sup>ri || || / z
|}
texto Tabelo plu granda
{|
! Individuo
| ‹w› || it‹w›<br>ita, pro it‹w› || ula‹w› || nula‹w›x&lt;br&gt;Ne || - || a b c
|-
! Qualeso
| 1 || 2
|-
! nekonata
| a || b || c || d || e || f
|-
!
| ‹w› || ita || c || d || e || f
|}
{|
| [[z|q]] || a=b | c | d
|}
fino"""


def table_pages(spark, d):
    """title, text: a page with tables for each lemma of the lexicon."""
    lex = V.lexicon(spark, d).groupBy("lemma").agg(F.min("term").alias("t"))
    pieces = [F.lit(p) if j % 2 == 0 else {"w": F.col("lemma"), "t": F.col("t")}[p] for j, p in enumerate(TABLES.replace("›", "‹").split("‹"))]
    return _dealt(lex.select(F.col("lemma").alias("title"), F.concat(*pieces).alias("text")))


_WORDS = f"{V.LEX}, b AS (SELECT lemma AS w, min(term) AS t FROM lex GROUP BY lemma)"


def _cells(table: int, context: str, rows: list[list[tuple[str, str]]]) -> list[str]:
    return [f"({table}, {context}, {i}, {j}, '{kind}', {cell})" for i, row in enumerate(rows) for j, (kind, cell) in enumerate(row)]


_d = lambda *cells: [("|", c) for c in cells]
_CELLS = [
    *_cells(0, r"'a' || chr(10)", [_d("'b'", "w")]),
    *_cells(1, r"chr(10) || '== Pronomi ==' || chr(10) || '|+ titolo ' || w", [
        [("!", "'Ido'"), ("!", "'x'")], [("!", "'Ido'"), *_d("'il(u)'", "w", "'eli'", "'nova'")],
        [("!", "'[[x|Esperanto]]'"), *_d("'li¹'", "'''''[[y|' || t || ']]'''' / x<sup>2</sup>ri'", "''", "'/ z'")],
    ]),
    *_cells(2, r"chr(10) || 'texto Tabelo plu granda' || chr(10)", [
        [("!", "'Individuo'"), *_d("w", "'it' || w || '<br>ita, pro it' || w", "'ula' || w", "'nula' || w || 'x&lt;br&gt;Ne'", "'-'", "'a b c'")],
        [("!", "'Qualeso'"), *_d("'1'", "'2'")], [("!", "'nekonata'"), *_d("'a'", "'b'", "'c'", "'d'", "'e'", "'f'")], [("!", "''"), *_d("w", "'ita'", "'c'", "'d'", "'e'", "'f'")],
    ]),
    *_cells(3, "chr(10)", [_d("'[[z|q]]'", "'d'")]),
]


@query("table_cells", f"WITH {_WORDS} SELECT w AS title, c.* FROM b, LATERAL (VALUES {', '.join(_CELLS)}) c(table_no, context, row_no, cell_no, kind, cell)")
def table_cells(spark, d):
    return readers.table_cells(table_pages(spark, d))


@query("pronoun_pairs", f"""WITH {_WORDS} SELECT w AS page, c.lemma, 'prn' AS pos, c.term, c.source, c.cell FROM b, LATERAL (VALUES
    ('il', 'li', 'closed_class_tables_qualified', 'il(u)→li¹'), ('ilu', 'li', 'closed_class_tables_qualified', 'il(u)→li¹'), (w, t, 'closed_class_tables_qualified', w || '→' || t || ' / x<sup>2</sup>ri')) c(lemma, term, source, cell)""")
def pronoun_pairs(spark, d):
    return closed_class.pronoun_pairs(readers.wiki_tables(table_pages(spark, d).withColumnRenamed("title", "page")), ["page"])


@query("grid_entries", f"""WITH {_WORDS}, g AS (SELECT w AS page, c.* FROM b, LATERAL (VALUES
    (w, 'prn', 'kiu', w), ('it' || w, 'prn', 'tiu', 'it' || w), ('t' || w, 'prn', 'tiu', 'it' || w), ('ic' || w, 'prn', 'ĉi tiu', 'it' || w), ('ita', 'prn', 'tiu', 'ita'), ('ta', 'prn', 'tiu', 'ita'), ('ica', 'prn', 'ĉi tiu', 'ita'),
    ('pro it' || w, 'prn', 'tiu', 'pro it' || w), ('pro t' || w, 'prn', 'tiu', 'pro it' || w), ('ula' || w, 'prn', 'iu', 'ula' || w), (CASE WHEN length(w) > 3 THEN 'ul' || w END, 'prn', 'iu', 'ula' || w),
    ('nula' || w || 'x', 'prn', 'iu ajn', 'nula' || w || 'x'), (CASE WHEN length(w) > 2 THEN 'nul' || w || 'x' END, 'prn', 'iu ajn', 'nula' || w || 'x'),
    (w, 'adj', 'kiu', w), ('ita', 'adj', 'tiu', 'ita'), ('ta', 'adj', 'tiu', 'ita'), ('ica', 'prn', 'ĉi tiu', 'ita'), ('c', 'adj', 'iu', 'c'), ('d', 'adj', 'iu ajn', 'd'), ('e', 'adj', 'neniu', 'e'), ('f', 'adj', 'ĉiu', 'f')) c(lemma, pos, term, word))
    SELECT page, lemma, pos, term, 'closed_class_tables' AS source, word || '→' || term AS cell FROM g WHERE lemma IS NOT NULL AND regexp_matches(word, '^[a-z]+( [a-z]+)?$')""")
def grid_entries(spark, d):
    return closed_class.grid_entries(readers.wiki_tables(table_pages(spark, d).withColumnRenamed("title", "page")), ["page"])
