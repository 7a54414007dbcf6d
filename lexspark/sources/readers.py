"""Readers of wiki dumps, SQL dumps, lexicon files and word lists. Each is a lazy DataFrame; paths go to Spark's own readers."""

from __future__ import annotations

import re
import warnings
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..functions import wikitext as W

#: Numbers are cast after the parse, where one that can't be read leaves the page's other fields in place.
PAGE = "title string, ns string, id string, revision struct<id: string, text: struct<_VALUE: string>>"


def read_wiki_dump(spark: SparkSession, path: str | list[str], ns: int | None = 0, dump: bool = False) -> DataFrame:
    """MediaWiki XML, plain or compressed: title, ns, page_id, rev_id, text, and if asked dump_file, dump_date, dump_mb.

    Cut at ``</page>``, so plain and bz2 dumps are read in splits; the namespace is tested on the raw
    piece before the XML is parsed. Blanks and line breaks at either end of a text are part of it; a text of nothing else is empty.
    """
    raw = spark.read.option("lineSep", "</page>").text(path).where(F.col("value").contains("<page>"))
    if ns is not None:
        raw = raw.where(F.col("value").contains(f"<ns>{ns}</ns>"))
    xml = F.concat(F.lit("<page>"), F.regexp_extract("value", r"(?s)<page>(.*)$", 1), F.lit("</page>"))
    extra = ["dump_file", "dump_date", "dump_mb"] if dump else []
    page = (with_dump(raw) if dump else raw).select(F.from_xml(xml, PAGE, {"ignoreSurroundingSpaces": "false"}).alias("p"), *extra)
    number = lambda c, kind: F.col(c).try_cast(kind)
    ids = number("p.ns", "int").alias("ns"), number("p.id", "bigint").alias("page_id"), number("p.revision.id", "bigint").alias("rev_id")
    return page.select("p.title", *ids, F.coalesce("p.revision.text._VALUE", F.lit("")).alias("text"), *extra)


def with_dump(files: DataFrame) -> DataFrame:
    """Rows of a file scan with dump_file, dump_date and dump_mb: name, date and size of the file that each comes from.

    The date is the first eight digits of the name, or the day on which the file was last changed for a name with ``latest`` or without
    digits. A folder of part files counts as one file by its own name, with the part's size.
    """
    meta = F.col("_metadata")
    name = F.when(meta["file_name"].startswith("part-"), F.element_at(F.split(meta["file_path"], "/"), -2)).otherwise(meta["file_name"])
    digits = F.regexp_extract(name, "([0-9]{8})", 1)
    day = F.when(name.contains("latest") | (digits == ""), F.date_format(meta["file_modification_time"], "yyyy-MM-dd")).otherwise(F.concat_ws("-", F.left(digits, F.lit(4)), F.substring(digits, 5, 2), F.substring(digits, 7, 2)))
    return files.select("*", name.alias("dump_file"), day.alias("dump_date"), F.round(meta["file_size"] / (1024 * 1024), 2).alias("dump_mb"))


def read_pages_by_title(spark: SparkSession, path: str, titles: list[str]) -> DataFrame:
    return read_wiki_dump(spark, path).where(F.col("title").isin(*titles))


#: Tuples of SQL dumps: (page_id, 0, 'title'), (from, 'lang', 'title') and (page, 'wikibase_item', 'Q1').
SQL_TUPLES = {
    "pages": r"\((\d+),0,'((?:[^'\\]|\\.)*)'",
    "langlinks": r"\((\d+),'{arg}','((?:[^'\\]|\\.)*)'\)",
    "entities": r"\((\d+),'wikibase_item','((?:[^'\\]|\\.)*)'",
}


def read_sql_tuples(spark: SparkSession, path: str, kind: str, arg: str = "") -> DataFrame:
    """(page_id, value) of a dump's INSERT lines; of a repeated page_id the last, by line, wins."""
    pattern = SQL_TUPLES[kind].replace("{arg}", arg)
    lines = spark.read.text(path).where(F.col("value").startswith("INSERT INTO")).withColumn("line", F.monotonically_increasing_id())
    both = F.arrays_zip(F.regexp_extract_all("value", F.lit(pattern), F.lit(1)).alias("k"), F.regexp_extract_all("value", F.lit(pattern), F.lit(2)).alias("v"))
    rows = lines.select("line", F.posexplode(both).alias("at", "t")).select(F.col("t.k").cast("bigint").alias("page_id"), F.col("t.v").alias("value"), F.struct("line", "at").alias("ord"))
    plain = F.regexp_replace("value", r"\\(.)", "$1")
    plain = plain if kind == "entities" else F.replace(plain, F.lit("_"), F.lit(" "))
    return rows.groupBy("page_id").agg(F.max_by("value", "ord").alias("value")).select("page_id", plain.alias("value"))


_TERMS = "array<struct<term: string, lang: string, confidence: double, source: string>>"
_ENTRY = f"lemma string, pos string, language string, source string, translations {_TERMS}, senses array<struct<translations: {_TERMS}>>"


def _entry_terms(entries: DataFrame) -> DataFrame:
    """(e, ord) to lemma, pos, lang, term, confidence, source, ord: the terms of senses, then the entry's own; an entry without terms is a row of nulls."""
    none = F.array().cast(_TERMS)
    terms = F.concat(F.coalesce(F.flatten(F.transform("e.senses", lambda s: F.coalesce(s["translations"], none))), none), F.coalesce("e.translations", none))
    rows = entries.select("e", "ord", F.posexplode_outer(terms).alias("k", "t"))
    return rows.select("e.lemma", "e.pos", "t.lang", "t.term", "t.confidence", F.coalesce("t.source", "e.source").alias("source"), F.struct("ord.*", F.coalesce("k", F.lit(0)).alias("k")).alias("ord"))


def read_lexicon(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Entries of JSON files, a list or ``{metadata, entries}``, senses or top-level translations: lemma, pos, lang, term, confidence, source, ord. A missing file is warned about and left out.

    A file is one value and so one task; ``read_large_lexicon`` reads one file by many tasks.
    """
    inner = _ENTRY.replace("lemma string, pos string, language string, source string, translations ", "lemma: string, pos: string, language: string, source: string, translations: ").replace(", senses ", ", senses: ")

    def one(seq, path):
        raw = spark.read.schema(f"{_ENTRY}, entries array<struct<{inner}>>").json(path, multiLine=True).withColumn("row", F.monotonically_increasing_id())
        own = F.array(F.struct("lemma", "pos", "language", "source", "translations", "senses"))
        entries = raw.select("row", F.posexplode(F.coalesce("entries", own)).alias("at", "e"))
        return _entry_terms(entries.select("e", F.struct(F.lit(seq).alias("file"), "row", "at").alias("ord")))

    found = []
    for i, path in enumerate(paths):
        try:
            found.append(one(i, path))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            warnings.warn(f"no lexicon file {path}", stacklevel=2)
    if not found:
        raise FileNotFoundError(", ".join(paths))
    return reduce(DataFrame.unionByName, found)


def read_large_lexicon(spark: SparkSession, path: str, first_key: str = "lemma") -> DataFrame:
    """As ``read_lexicon`` for one large file, which is cut between entries and read by as many tasks as it has splits.

    The file is a list or ``{metadata, entries}``, entries last, either with every entry's braces on lines of their own, all indented
    alike, or on one line with ``first_key`` first in every entry and only there. Such a boundary can't stand within a string, where line
    breaks and quotes are escaped. Only the head of the file, 2,000 lines, is read to tell which form it has; the metadata end within it. ``ord`` holds the place by file,
    split and entry.
    """
    head = [r.value for r in spark.read.text(path).limit(2000).collect()]
    wrapped = next((x.lstrip()[0] for x in head if x.strip()), "[") == "{"
    begins = r'"entries"\s*:\s*\[\s*$' if wrapped else r"^\s*\[\s*$"
    opening = next((y for x, y in zip(head, head[1:], strict=False) if re.search(begins, x)), "").rstrip()
    indent = opening[:-1] if re.fullmatch(r"[ \t]+\{", opening) else None
    between = f'}},{{"{first_key}":' if indent is None else f"\n{indent}}},\n{indent}{{"
    start, end = (f'{{"{first_key}":' if indent is None else "{"), "}"
    pieces = spark.read.option("lineSep", between).text(path).select("value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    first = F.col("value").rlike(r"^\s*[\[{]")
    inside = (r'(?s)^.*?"entries"\s*:\s*\[\s*\{' if wrapped else r"(?s)^\s*\[\s*\{") + (r"\s*" + f'"{first_key}"' + r"\s*:" if indent is None else "")
    body = F.when(first, F.regexp_replace("value", inside, "")).otherwise(F.col("value"))
    # Outside strings, an entry's own braces are balanced without the outer pair; the last piece closes more than it opens.
    bare = F.regexp_replace(body, r'"(?:[^"\\]|\\.)*"', "")
    count = lambda c: F.length(bare) - F.length(F.replace(bare, F.lit(c), F.lit("")))
    last = count("}") > count("{")
    text = F.concat(F.lit(start), F.when(last, F.regexp_replace(body, r"\}\s*\]\s*\}?\s*$", "")).otherwise(body), F.lit(end))
    empty = first & F.col("value").rlike(r"(?s)^\s*(\{.*)?\[\s*\]\s*\}?\s*$")
    entries = pieces.where(~empty).select(F.from_json(text, _ENTRY).alias("e"), F.struct("file_path", "file_block_start", "row").alias("ord"))
    return _entry_terms(entries)


def read_parallel_tsv(spark: SparkSession, path: str) -> DataFrame:
    """src, ref, tags array; blank lines, lines whose first non-blank is #, and lines of one field are skipped."""
    line = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)"))
    parts = line.select(F.split("value", "\t").alias("p")).where(F.size("p") >= 2)
    tags = F.filter(F.transform(F.split(F.coalesce(F.get("p", F.lit(2)), F.lit("")), ","), lambda t: F.btrim(t)), lambda t: t != "")
    return parts.select(F.btrim(F.get("p", F.lit(0))).alias("src"), F.btrim(F.get("p", F.lit(1))).alias("ref"), tags.alias("tags"))


def read_tagged_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(left, right) of a bilingual XML dictionary, as ``lemma<tag>…``."""
    raw = spark.read.option("lineSep", "</e>").text(path).where(F.col("value").contains("<p>"))
    side = lambda n: F.regexp_replace(F.regexp_replace(F.regexp_extract("value", rf"(?s)<{n}>(.*?)</{n}>", 1), r'<s n="([^"]+)"\s*/>', "<$1>"), r"<b\s*/>", " ")
    return raw.select(side("l").alias("left"), side("r").alias("right")).where("left != '' and right != ''")


def read_word_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema="source_word string, target_word string, in_current_dict boolean")


def wiki_tables(pages: DataFrame) -> DataFrame:
    """pages (title, text, ...) to their other columns, table_no, context and rows of each table; see ``wikitext.tables``."""
    return pages.select(*[c for c in pages.columns if c != "text"], F.posexplode(W.tables(F.col("text"))).alias("table_no", "_t")).select("*", "_t.context", "_t.rows").drop("_t")


def table_cells(pages: DataFrame) -> DataFrame:
    """pages (title, text) to title, table_no, context, row_no, cell_no, kind, cell."""
    out = wiki_tables(pages.select("title", "text")).select("title", "table_no", "context", F.posexplode("rows").alias("row_no", "r"))
    return out.select("title", "table_no", "context", "row_no", F.posexplode("r").alias("cell_no", "c")).select("title", "table_no", "context", "row_no", "cell_no", "c.kind", "c.cell")


def extract_entries(pages: DataFrame, lang: str, target: str, pivots: bool = True) -> DataFrame:
    """pages (title, text) to lemma, pos, form_of, morphology, paradigm, sense_no, lang, term, confidence.

    One pass yields the translations into ``target`` (confidence .6) and, as senses after those, into the
    pivots: English and French for "io" and "eo" (.5), "io" and "eo" for English pages (.6). A page stays if it has any
    of them or names the lemma that it is a form of; one without terms is a row with nulls. Inflected forms go.
    A page of "eo" without a direct translation is searched in its block of translations, then as a whole.
    """
    # Sections and senses are tested after they are exploded: a filter on a computed column would compute it once more.
    found = pages.where(X.is_valid_title(F.col("title")) & W.has_section_hint(F.col("text"), lang))
    found = found.select("title", "text", F.explode(F.array_compact(F.array(W.language_section(F.col("text"), lang)))).alias("s"))
    found = found.where(~W.is_inflected_form(F.col("s"))).withColumn("direct", W.translations(F.col("s"), target))
    if lang == "eo":
        for wider in (W.block_translations(F.col("s")), W.translations(F.col("text"), target)):
            found = found.withColumn("direct", F.when(F.size("direct") > 0, F.col("direct")).otherwise(wider))
    senses = [("direct", target, 0.6)]
    for pivot, confidence in (("en", 0.5), ("fr", 0.5)) if lang in ("io", "eo") else (("io", 0.6), ("eo", 0.6)):
        if pivots:
            found = found.withColumn(f"in_{pivot}", W.translations(F.col("s"), pivot))
            senses.append((f"in_{pivot}", pivot, confidence))
    base = W.variant_base(F.col("s")) if lang == "io" else F.lit(None).cast("string")

    def told(meanings: str, lang: str, confidence: float):
        return F.transform(meanings, lambda m: F.struct(F.lit(lang).alias("lang"), F.lit(confidence).alias("confidence"), m.alias("terms")))

    found = found.withColumns({"senses": F.concat(*[told(*x) for x in senses]), "base": base, "m": W.morphology(F.col("s"))})
    out = found.select(
        F.col("title").alias("lemma"), F.coalesce(W.pos_of_section(F.col("s")), "m.pos").alias("pos"), F.when(F.col("base") != F.lower("title"), F.col("base")).alias("form_of"),
        F.col("m.raw").alias("morphology"), F.col("m.paradigm").alias("paradigm"), "base", F.posexplode_outer("senses").alias("sense_no", "sense"),
    ).where("sense is not null or base is not null")
    return out.select("lemma", "pos", "form_of", "morphology", "paradigm", "sense_no", "sense.lang", F.explode_outer("sense.terms").alias("term"), "sense.confidence")


def entry_terms(entries: DataFrame, lang: str) -> DataFrame:
    """Rows of ``extract_entries`` to lemma, form_of, terms (those in ``lang``, in order), as ``resolve_variants`` takes them."""
    own = F.when(F.col("lang") == lang, F.struct("sense_no", "term"))
    return entries.groupBy("lemma", "form_of").agg(F.array_distinct(F.sort_array(F.collect_list(own))["term"]).alias("terms"))
