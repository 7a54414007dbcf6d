"""Queries of the readers and sinks: files are derived from the given tables, in the shared folder, and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import checks, entities, joins
from ..sources import readers, writers
from ..storage import new_path
from . import views as V
from .catalog import QUERIES, SQL, query  # noqa: F401  (one registry)

_ID = "CAST(doc_id AS BIGINT)"


@query("read_wiki_dump", f"SELECT 'T&' || doc_id AS title, 0 AS ns, {_ID} AS page_id, {_ID} * 10 AS rev_id, '<' || coalesce(lang, '') || '> & ' || coalesce(hex(encode(text)), '') AS text FROM documents WHERE doc_id % 3 <> 0")
def read_wiki_dump(spark, d):
    """A dump of all documents, a third of them and those without a doc_id in another namespace, which the reader leaves out.

    XML has no place for control characters and changes others, so languages are percent-encoded in the file, as texts are hex.
    """
    path = new_path(spark, "dump")
    ns = F.when(F.col("doc_id") % 3 != 0, "0").otherwise("4")
    text = F.concat(F.lit("&lt;"), F.url_encode(F.coalesce("lang", F.lit(""))), F.lit("&gt; &amp; "), F.coalesce(F.hex("text"), F.lit("")))
    page = F.format_string("<page><title>T&amp;%s</title><ns>%s</ns><id>%s</id><revision><id>%s0</id><text bytes=\"1\">%s</text></revision></page>", F.col("doc_id").cast("string"), ns, F.col("doc_id").cast("string"), F.col("doc_id").cast("string"), text)
    V.table(spark, d, "documents").select(page.alias("value")).write.text(path)
    lang = F.substring_index("text", ">", 1)
    return readers.read_wiki_dump(spark, path).withColumn("text", F.concat(F.url_decode(lang), F.substr("text", F.length(lang) + 1)))


@query("read_pages_by_title", f"SELECT coalesce(lang, '') AS title, 0 AS ns, {_ID} AS page_id, {_ID} AS rev_id, 'x' AS text FROM documents WHERE lang IN ('es', 'fr')")
def read_pages_by_title(spark, d):
    """Languages as titles, percent-encoded as XML can't hold them all; those that are asked for stay as they are."""
    path = new_path(spark, "titles")
    page = F.format_string("<page><title>%s</title><ns>0</ns><id>%s</id><revision><id>%s</id><text>x</text></revision></page>", F.url_encode(F.coalesce("lang", F.lit(""))), F.col("doc_id").cast("string"), F.col("doc_id").cast("string"))
    V.table(spark, d, "documents").select(page.alias("value")).write.text(path)
    return readers.read_pages_by_title(spark, path, ["es", "fr"])


@query("read_sql_tuples", f"SELECT {_ID} AS page_id, coalesce(lang, '') || chr(39) || 's ' || coalesce(source, '') AS value FROM documents")
def read_sql_tuples(spark, d):
    """A page table's dump, with an escaped quote and an underscore in each title."""
    path = new_path(spark, "tuples")
    row = F.concat(F.lit("INSERT INTO `page` VALUES ("), F.col("doc_id").cast("string"), F.lit(",0,'"), F.coalesce("lang", F.lit("")), F.lit("\\'s_"), F.coalesce("source", F.lit("")), F.lit("',0);"))
    V.table(spark, d, "documents").select(row.alias("value")).write.text(path)
    return readers.read_sql_tuples(spark, path, "pages")


@query("read_lexicon", f"WITH {V.LEX} SELECT lemma, 'noun' AS pos, term, array_to_string(sources, ',') AS source FROM lex")
def read_lexicon(spark, d):
    """The lexicon as JSON files, one for each initial, and a file that is missing."""
    path = new_path(spark, "lexicon")
    t = F.struct("term", F.lit("eo").alias("lang"), F.lit(0.5).alias("confidence"), F.array_join("sources", ",").alias("source"))
    entries = V.lexicon(spark, d).groupBy("lemma").agg(F.collect_list(t).alias("translations")).select(F.substring("lemma", 1, 1).alias("i"), F.struct("lemma", F.lit("noun").alias("pos"), "translations").alias("e"))
    # A file holds one JSON value, so all rows of an initial are one row; that is what the format asks.
    entries.groupBy("i").agg(F.collect_list("e").alias("entries")).select(F.hash("i").alias("bucket"), "entries").write.partitionBy("bucket").json(path)
    return readers.read_lexicon(spark, [f"{path}/*", f"{path}/missing.json"]).select("lemma", "pos", "term", "source")


@query("read_parallel_tsv", f"WITH {V.LEX} SELECT lemma AS src, term AS ref, array_to_string(sources, '|') AS tags FROM lex")
def read_parallel_tsv(spark, d):
    path = new_path(spark, "tsv")
    line = F.concat(F.lit(" "), "lemma", F.lit("\t"), "term", F.lit(" \t"), F.array_join("sources", " , "))
    lex = V.lexicon(spark, d)
    lex.select(F.explode(F.array(line, F.concat(F.lit("  # "), line), F.lit(""), F.col("lemma"))).alias("value")).write.text(path)
    return readers.read_parallel_tsv(spark, path).withColumn("tags", F.array_join("tags", "|"))


@query("read_tagged_pairs", f"WITH {V.LEX} SELECT lemma || '<n>' AS \"left\", term || ' x<adj><sg>' AS \"right\" FROM lex")
def read_tagged_pairs(spark, d):
    path = new_path(spark, "pairs")
    e = F.concat(F.lit("<e><p><l>"), "lemma", F.lit('<s n="n"/></l><r>'), "term", F.lit('<b/>x<s n="adj"/><s n="sg" /></r></p></e>'))
    V.lexicon(spark, d).select(e.alias("value")).write.text(path)
    return readers.read_tagged_pairs(spark, path)


@query("read_word_pairs", f"WITH {V.LEX} SELECT lemma AS source_word, term AS target_word, idx % 2 = 0 AS in_current_dict FROM lex")
def read_word_pairs(spark, d):
    path = new_path(spark, "words")
    V.lexicon(spark, d).select(F.col("lemma").alias("source_word"), F.col("term").alias("target_word"), (F.col("idx") % 2 == 0).alias("in_current_dict")).write.csv(path, header=True)
    return readers.read_word_pairs(spark, path)


@query("write_lexicon", f"WITH {V.LEX} SELECT lemma, term, array_to_string(sources, ',') AS sources, form FROM lex, (VALUES ('json'), ('parquet')) f(form)")
def write_lexicon(spark, d):
    """The lexicon written in both forms and read back."""
    lex = V.lexicon(spark, d).select("lemma", "term", "sources")
    out = []
    for form in ("json", "parquet"):
        path = new_path(spark, form)
        writers.write_lexicon(lex, path, form)
        out.append(spark.read.format(form).schema(lex.schema).load(path).select("lemma", "term", F.array_join("sources", ",").alias("sources"), F.lit(form).alias("form")))
    return out[0].unionByName(out[1])


@query("read_large_lexicon", f"WITH {V.LEX} SELECT lemma, 'noun' AS pos, term, array_to_string(sources, ',') AS source FROM lex")
def read_large_lexicon(spark, d):
    """The lexicon as JSON lists, one for each initial, cut between entries as they are read."""
    path = new_path(spark, "large")
    t = F.struct("term", F.lit("eo").alias("lang"), F.lit(0.5).alias("confidence"), F.array_join("sources", ",").alias("source"))
    entries = V.lexicon(spark, d).groupBy("lemma").agg(F.collect_list(t).alias("translations")).select(F.substring("lemma", 1, 1).alias("i"), F.struct("lemma", F.lit("noun").alias("pos"), "translations").alias("e"))
    entries.groupBy("i").agg(F.to_json(F.collect_list("e")).alias("value")).select(F.hash("i").alias("bucket"), "value").write.partitionBy("bucket").text(path)
    return readers.read_large_lexicon(spark, f"{path}/*").select("lemma", "pos", "term", "source")


@query("dump_provenance", "SELECT d AS dump_file, v AS dump_date, count(*) AS pages FROM documents, (VALUES ('iowiki-20251021-pages.xml', '2025-10-21'), ('20240102eo', '2024-01-02')) x(d, v) WHERE (doc_id % 2 = 0) = (d = '20240102eo') GROUP BY ALL")
def dump_provenance(spark, d):
    """Pages of two dumps by the date that the dump's name tells."""
    top = new_path(spark, "dumps")
    page = F.format_string("<page><title>x</title><ns>0</ns><id>%s</id><revision><id>1</id><text>x</text></revision></page>", F.col("doc_id").cast("string"))
    names = {0: "20240102eo", 1: "iowiki-20251021-pages.xml"}
    for rest, name in names.items():
        V.table(spark, d, "documents").where(F.abs(F.col("doc_id") % 2) == rest).select(page.alias("value")).write.text(f"{top}/{name}")
    pages = readers.read_wiki_dump(spark, [f"{top}/{name}" for name in names.values()], dump=True)
    return pages.groupBy("dump_file", "dump_date").agg(F.count(F.lit(1)).alias("pages"))


@query("schema_errors", f"""WITH {V.LEX}, r AS (SELECT lemma, term, idx % 6 AS k FROM lex)
    SELECT lemma, term, CASE k WHEN 1 THEN 'source:required' WHEN 2 THEN 'translations.0.confidence:maximum' WHEN 3 THEN 'morphology.paradigm:not of type string' WHEN 4 THEN 'translations.1:not of type object' WHEN 5 THEN ':no JSON' ELSE '' END AS errors FROM r""")
def schema_errors(spark, d):
    """Entries of the lexicon as JSON, five of six broken in one way each, against the schema of entries."""
    k = F.col("idx") % 6
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    t = F.concat(F.lit('{"term": '), quoted(F.col("term")), F.lit(', "lang": "eo", "source": "s", "confidence": '), F.when(k == 2, "1.25").otherwise("1"), F.lit("}"))
    value = F.concat(
        F.lit('{"lemma": '), quoted(F.col("lemma")), F.when(k == 1, "").otherwise(', "source": "s"'), F.when(k == 3, ', "morphology": {"paradigm": 3}').otherwise(', "morphology": {}'),
        F.lit(', "translations": ['), t, F.when(k == 4, ', "x"').otherwise(""), F.lit("]"), F.when(k == 5, "").otherwise("}"),
    )
    out = checks.entry_errors(V.lexicon(spark, d).withColumn("value", value))
    return out.select("lemma", "term", F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["path"], e["problem"])), ",").alias("errors"))


@query("entity_entries", rf"""WITH {V.LEX}, e AS (SELECT lemma AS w, max(term) AS label, list(term ORDER BY idx) AS terms FROM lex GROUP BY lemma),
    n AS (SELECT w, CASE WHEN length(w) % 3 = 0 THEN w || 'o' ELSE w END AS own, label, list_filter(list_concat([label], terms), lambda t: length(t) >= 2) AS terms, unnest([0, 1, 2]) AS no FROM e),
    l AS (SELECT w, no, terms, CASE no WHEN 0 THEN own WHEN 1 THEN left(w, 4) || 'A' ELSE 'du vorti' END AS lemma FROM n WHERE length(label) >= 2 AND regexp_matches(own, '^[a-zA-ZĈĉĜĝĤĥĴĵŜŝŬŭÀ-ÿ][a-zA-ZĈĉĜĝĤĥĴĵŜŝŬŭÀ-ÿ\-]+$')),
    v AS (SELECT *, lower(lemma) AS key FROM l WHERE regexp_matches(lemma, '^[a-zA-ZĈĉĜĝĤĥĴĵŜŝŬŭÀ-ÿ][a-zA-ZĈĉĜĝĤĥĴĵŜŝŬŭÀ-ÿ\-]+$')),
    s AS (SELECT key, arg_min((lemma, 'Q' || w), (w, no)) AS s FROM v GROUP BY key),
    t AS (SELECT key, term, min((w, no, k)) AS seen FROM (SELECT key, w, no, unnest(terms) AS term, generate_subscripts(terms, 1) AS k FROM v) GROUP BY key, term)
    SELECT key, s[1] AS lemma, s[2] AS entity, term, row_number() OVER (PARTITION BY key ORDER BY seen) - 1 AS place FROM t JOIN s USING (key)""")
def entity_entries(spark, d):
    """An entity for each lemma of the lexicon: some labelled, aliases that many share, terms as aliases of the last of them."""
    lex = V.lexicon(spark, d)
    e = lex.groupBy("lemma").agg(F.max("term").alias("label"))
    q = F.concat(F.lit("Q"), "lemma").alias("entity")
    props, pages = e.select(F.col("lemma").alias("page_id"), q, F.col("lemma").alias("ord")), e.select(F.col("lemma").alias("page_id"), F.col("lemma").alias("title"))
    labels = e.select(q, F.lit("b").alias("lang"), "label").unionByName(e.where("length(lemma) % 3 = 0").select(q, F.lit("a").alias("lang"), F.concat("lemma", F.lit("o")).alias("label")))
    short = F.posexplode(F.array(F.concat(F.left("lemma", F.lit(4)), F.lit("A")), F.lit("du vorti"))).alias("ord", "alias")
    aliases = e.select(q, F.lit("a").alias("lang"), short).unionByName(lex.select(q, F.lit("b").alias("lang"), F.col("idx").alias("ord"), F.col("term").alias("alias")))
    return entities.entity_entries(props, pages, labels, aliases)


@query("link_pairs_turned", rf"""WITH {V.LEX} SELECT lemma, term, CAST(0.85 AS DOUBLE) AS confidence FROM lex
    WHERE length(lemma) >= 3 AND length(term) >= 3 AND regexp_matches(lemma, '^[A-Za-zĉĝĥĵŝŭĈĜĤĴŜŬ][\p{{L}}_\-\s]*$') AND regexp_matches(term, '^[A-Za-zĉĝĥĵŝŭĈĜĤĴŜŬ][\p{{L}}_\-\s]*$')""")
def link_pairs_turned(spark, d):
    """Link pairs of pages that are the target language's: a page for each term, its links the lemmas."""
    lex = V.lexicon(spark, d)
    return joins.link_pairs(lex.select(F.col("term").alias("page_id"), F.col("term").alias("title")).distinct(), lex.select(F.col("term").alias("page_id"), F.col("lemma").alias("target")), source_pages=False)


@query("unified_entries", f"""WITH {V.LEX} SELECT lemma, 'corpus' AS source, CASE WHEN length(lemma) % 2 = 0 THEN 'noun' END AS pos, CAST(NULL AS VARCHAR) AS paradigm, string_agg(term || ':eo:0.9', ',' ORDER BY idx) || CASE WHEN bool_or(idx = 1) THEN ',x:en:0.9' ELSE '' END AS translations, 'https://example.org/wiki/' || lemma AS source_page FROM lex GROUP BY lemma""")
def unified_entries(spark, d):
    """The lexicon in the unified form, from terms with links and repetitions."""
    t = F.struct(F.lit("eo").alias("lang"), F.concat(F.lit("[["), "term", F.lit("]]")).alias("term"))
    lists = F.transform(F.array_sort(F.collect_list(F.struct("idx", t.alias("t")))), lambda x: x["t"])
    e = V.lexicon(spark, d).groupBy("lemma").agg(lists.alias("l"))
    more = F.when(F.size("l") > 1, F.array(F.struct(F.lit("en").alias("lang"), F.lit("x ").alias("term")), F.get("l", F.lit(0)))).otherwise(F.array(F.get("l", F.lit(0))))
    e = e.select(F.concat(F.lit(" "), "lemma").alias("lemma"), F.when(F.length("lemma") % 2 == 0, "noun").otherwise("").alias("pos"), F.lit(None).cast("string").alias("paradigm"), F.concat("l", more).alias("translations"))
    out = writers.unified_entries(e, "corpus", "https://example.org/wiki/", 0.9)
    return out.withColumn("translations", F.array_join(F.transform("translations", lambda t: F.concat_ws(":", t["term"], t["lang"], t["confidence"].cast("string"))), ","))


@query("index_records", f"""WITH {V.LEX} SELECT lemma AS l, CASE WHEN length(lemma) % 2 = 0 THEN 'n' END AS p, string_agg(CASE idx % 3 WHEN 0 THEN term || '{{pivot_en,wikt_io}}' WHEN 1 THEN term || '{{wiki}}' ELSE term END, ' ' ORDER BY idx) AS t FROM lex GROUP BY lemma""")
def index_records(spark, d):
    k = F.col("idx") % 3
    names = F.when(k == 0, F.array(F.lit("io_wiktionary"), F.lit("pivot_en_x"), F.lit("bert"))).when(k == 1, F.array(F.lit("io_wikipedia"))).otherwise(F.array(F.lit("bert")))
    rows = V.lexicon(spark, d).select("lemma", F.when(F.length("lemma") % 2 == 0, "n").otherwise("").alias("pos"), "term", names.alias("sources"), F.col("idx").alias("ord"))
    return writers.index_records(rows.unionByName(rows)).withColumn("t", F.array_join("t", " "))


@query("dictionary_records", f"""WITH {V.LEX} SELECT lemma, string_agg(term, ',' ORDER BY {V.RANK}, idx) AS words, array_to_string(list_sort(list_distinct(flatten(list(sources)))), ',') AS sources, CASE WHEN length(lemma) % 2 = 0 THEN 'o__n' ELSE '' END AS paradigms FROM lex GROUP BY lemma""")
def dictionary_records(spark, d):
    rows = V.lexicon(spark, d).withColumns({"rank": X.source_rank(F.col("sources"), V.RANKS), "paradigm": F.when(F.length("lemma") % 2 == 0, "o__n")})
    return writers.dictionary_records(rows).select("lemma", *[F.array_join(c, ",").alias(c) for c in ("words", "sources", "paradigms")])
