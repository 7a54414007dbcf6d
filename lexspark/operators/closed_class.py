"""Pronouns and correlatives out of wiki tables: rows labelled by headers, columns by their place.

``tables`` are those of ``readers.wiki_tables``: any columns that name the page, table_no, context, rows. The work
on a table stays in its row, so nothing is shuffled but the first table of each page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import rules
from ..functions import text as X
from ..functions import wikitext as W

_IDO_WORDS = "^[a-z]+( [a-z]+)?$"


def _first_table(tables: DataFrame, of: list[str]) -> DataFrame:
    """Each page's first table; pages are told apart by ``of``."""
    rest = [c for c in tables.columns if c not in of]
    return tables.groupBy(*of).agg(F.min_by(F.struct(*rest), "table_no").alias("_t")).select(*of, "_t.*")


def _labelled(rows: Column) -> Column:
    """array<struct<label, data>>: the first header cell, null without one, and the data cells of each row, as plain text."""
    of = lambda row, kind: F.transform(F.filter(row, lambda c: c["kind"] == kind), lambda c: W.plain_cell(c["cell"]))
    return F.transform(rows, lambda r: F.struct(F.get(of(r, "!"), F.lit(0)).alias("label"), of(r, "|").alias("data")))


def pronoun_pairs(tables: DataFrame, of: list[str]) -> DataFrame:
    """``of``, lemma, pos, term, source, cell: the two labelled rows of the pronoun table, zipped by place.

    Of rows with one label the last counts. Cells without a counterpart go; of alternatives the first stays; ``il(u)`` is
    two lemmas; a footnote on the target makes the source a qualified one.
    """
    both = tables.where(F.col("context").contains(rules.PRONOUN_TABLE)).withColumn("r", _labelled(F.col("rows")))
    last = lambda label: F.try_element_at(F.filter("r", lambda x: x["label"] == label)["data"], F.lit(-1))
    left, right = rules.PRONOUN_ROWS
    both = both.withColumns({"left": last(left), "right": last(right)}).where((F.size("left") > 0) & (F.size("right") > 0))
    cells = _first_table(both.select(*of, "table_no", "left", "right"), of).select(*of, F.explode(F.arrays_zip("left", "right")).alias("c"))
    cells = cells.select(*of, "c.left", "c.right").where("left != '' and right != ''")
    term = F.btrim(F.get(F.split(F.btrim(F.regexp_replace("right", rules.FOOTNOTE, "")), r"\s*/\s*"), F.lit(0)))
    base = F.replace("left", F.lit(" "), F.lit(""))
    short, tail = (F.regexp_extract(base, r"^([a-z]+)\(([a-z]+)\)$", k) for k in (1, 2))
    lemmas = F.when(short != "", F.array(short, F.concat(short, tail))).otherwise(F.array(base))
    source = F.when(F.col("right").rlike(rules.FOOTNOTE), rules.GRID_SOURCES[1]).otherwise(rules.GRID_SOURCES[0])
    out = cells.select(*of, F.explode(lemmas).alias("lemma"), F.lit("prn").alias("pos"), term.alias("term"), source.alias("source"), F.concat_ws("→", "left", "right").alias("cell"))
    return out.where("term != ''")


def grid_entries(tables: DataFrame, of: list[str]) -> DataFrame:
    """``of``, lemma, pos, term, source, cell of the grid of correlatives: the row's label gives the suffix, the column's place the prefix.

    Rows of another width or label go. A cell may hold alternatives. The footnoted short forms of the
    second column and of ula-, nula- are lemmas too, as are the near forms (ic-) of the second column.
    """
    first = _first_table(tables.where(F.col("context").contains(rules.GRID_TABLE)).select(*of, "table_no", "rows"), of)
    rows = first.select(*of, F.explode(_labelled(F.col("rows"))).alias("r")).where(F.size("r.data") == len(rules.GRID_COLUMNS))
    label = F.btrim(F.regexp_replace(F.lower(F.coalesce("r.label", F.lit(""))), r"\s+", " "))
    suffix, pos = ({row[0]: row[k] for row in rules.GRID_ROWS} for k in (1, 2))
    rows = rows.select(*of, X.lookup(suffix, label).alias("suffix"), X.lookup(pos, label).alias("pos"), F.posexplode("r.data").alias("col", "text")).where("suffix is not null")
    words = F.transform(F.split(F.regexp_replace("text", r"&lt;br&gt;|<br\s*/?>", ","), ","), lambda x: F.btrim(x))
    rows = rows.select(*of, "suffix", "pos", "col", F.explode(words).alias("word")).where(F.col("word").rlike(_IDO_WORDS))
    column = F.get(F.array(*[F.struct(F.lit(p).alias("prefix"), F.lit(q).alias("after")) for p, q in rules.GRID_COLUMNS]), F.col("col"))
    rows = rows.withColumn("term", F.concat(column["prefix"], "suffix", column["after"]))
    short = F.regexp_replace("word", r"\bit", "t")
    made = F.array(
        F.struct(F.col("word").alias("lemma"), "pos", "term"),
        F.when((F.col("col") == 1) & (short != F.col("word")), F.struct(short.alias("lemma"), "pos", "term")),
        F.when(F.col("word").rlike(r"^n?ula\w{4,}$"), F.struct(F.regexp_replace("word", "^(n?ul)a", "$1").alias("lemma"), "pos", "term")),
        F.when((F.col("col") == 1) & F.col("word").startswith("it"), F.struct(F.concat(F.lit("ic"), F.substr("word", F.lit(3))).alias("lemma"), F.lit("prn").alias("pos"), F.concat(F.lit("ĉi "), "term").alias("term"))),
    )
    out = rows.select(*of, "word", F.explode(F.array_compact(made)).alias("e"))
    return out.select(*of, "e.lemma", "e.pos", "e.term", F.lit(rules.GRID_SOURCES[0]).alias("source"), F.concat_ws("→", "word", "e.term").alias("cell"))
