"""Registered queries against their SQL on words that the smallest tables lack: with ß, without letters, short verbs, and on repeated doc_ids."""

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lexspark.functions import text as X
from lexspark.operators import frequency, joins, merge, metrics

ES = "achß ßheitsch ßä 12 13 par dieenerßß straßo ßkeit ßkeitar hundo ß1 ar"
FR = "achß achßen ßheitach ßheitschen ßä 12 121 13 par parar dieenerßß dieenen strasso straßo ßkeit ßkeito hundon hundo ß1 ar"
DOCS = [(1, ES, "es", "src1"), (2, FR, "fr", "src3"), (2, "par hundo hundo", "fr", "src5"), (3, ES.upper().replace("SS", "ẞ"), "es", "src2"), (4, "solo solo nur", "de", "src0"), (4, "solo 7", "de", "src0"), (5, None, "en", "src7")]


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    folder = tmp_path_factory.mktemp("odd")
    cols = dict(zip(("doc_id", "text", "lang", "source"), map(list, zip(*DOCS))))
    pq.write_table(pa.table(cols | {"n_chars": [len(t or "") for t in cols["text"]]}), folder / "documents.parquet")
    pq.write_table(pa.table({"item_id": [1, 2], "text": ["hundo nur", None]}), folder / "benchmark.parquet")
    return str(folder)


@pytest.mark.parametrize("name", ["canonical_lemma", "forced_overrides", "merge_case_twins", "merge_lexicon", "merged_winners", "pairs_by_confidence", "vocabulary_suspects", "dedupe_case", "article_errors", "failure_audit", "token_coverage"])
def test_query_equals_its_sql_on_odd_words(spark, odd, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{odd}/{t}.parquet'")
    got = __spark_entry__.queries()[name](spark, odd).toArrow()
    con.register("got", got)
    con.sql(f"create table want as {__spark_entry__.oracle_sql()[name]}")
    names = ", ".join(f'"{c}"' for c in got.column_names)
    for one, other in (("want", "got"), ("got", "want")):
        assert con.sql(f"select {names} from {one} except all select {names} from {other}").fetchall() == []
    assert got.num_rows > 0


MORE = [(1, "bgcolo hundo 1abcde kato 0x1", "es", "src0"), (2, "bgcolor hundon 1abcdx katoj kato", "fr", "src21"), (3, "hundor hundoz 0x1 katob", "fr", "src4"), (4, "hundob katob", "fr", "src29"), (5, "İdoxx ΟΔΟΣ", "es", "src2"), (6, "İdoxxa οδος idoxx", "fr", "src25"), (7, "hundou hundob", "fr", "src23")]


@pytest.mark.parametrize("name", ["merged_winners", "merge_lexicon", "pick_best", "winner_diff", "order_terms"])
def test_query_equals_its_sql_on_more_sources(spark, tmp_path, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    pq.write_table(pa.table(dict(zip(("doc_id", "text", "lang", "source"), map(list, zip(*MORE))))), tmp_path / "documents.parquet")
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet'")
    got = __spark_entry__.queries()[name](spark, str(tmp_path)).toArrow()
    con.register("got", got)
    con.sql(f"create table want as {__spark_entry__.oracle_sql()[name]}")
    names = ", ".join(f'"{c}"' for c in got.column_names)
    for one, other in (("want", "got"), ("got", "want")):
        assert con.sql(f"select {names} from {one} except all select {names} from {other}").fetchall() == []
    assert got.num_rows > 0


def test_lower_is_letter_for_letter(spark):
    rows = spark.createDataFrame([("İKA",), ("ΟΔΟΣ ΣΑΣ",), ("ẞ",), ("",), (None,)], "w string")
    assert [r.l for r in rows.select(X.lower(F.col("w")).alias("l")).collect()] == ["ika", "οδοσ σασ", "ß", "", None]


def test_upper_is_letter_for_letter(spark):
    rows = spark.createDataFrame([("straße",), ("ßa",), ("ŉa éß",), ("",), (None,)], "w string")
    assert [r.u for r in rows.select(X.upper(F.col("w")).alias("u")).collect()] == ["STRAẞE", "ẞA", "ŉA Éẞ", "", None]
    assert [r.u for r in rows.select(X.capitalized(F.col("w")).alias("u")).collect()] == ["Straße", "ẞa", "ŉa éß", "", None]


def test_rows_of_one_lemma_without_letters_are_twins(spark):
    rows = [("12", ["12x"], ["cap"], "a__adj"), ("12", ["12"], ["s"], None), ("Ab", ["z"], ["s"], None), ("AB", ["z"], ["s"], None)]
    got = joins.merge_case_twins(spark.createDataFrame(rows, "lemma string, terms array<string>, sources array<string>, paradigm string")).collect()
    assert sorted(tuple(r) for r in got) == sorted([("12", ["12", "12x"], ["cap", "s"], "a__adj"), ("AB", ["z"], ["s"], None), ("Ab", ["z"], ["s"], None)])


def test_short_verbs_go_unless_asked_for(spark):
    rows = spark.createDataFrame([("par", "", "par", "io_wiktionary", 1), ("parar", "", "pari", "io_wiktionary", 2)], "lemma string, pos string, term string, source string, ord int")
    assert [r.key for r in merge.merge_lexicon(rows).collect()] == ["parar"]
    assert sorted(r.key for r in merge.merge_lexicon(rows, junk_verbs=True).collect()) == ["par", "parar"]


def test_token_runs_count_within_the_row(spark):
    docs = spark.createDataFrame([(1, "b zz xx, zz yy ZZ"), (1, "zz"), (2, None), (3, "")], "doc_id int, text string")
    assert sorted(tuple(r) for r in frequency.token_runs(docs).collect()) == [(1, "xx", 1), (1, "yy", 1), (1, "zz", 1), (1, "zz", 3)]
    done = spark.createDataFrame([("xx",)], "token string")
    assert [tuple(r) for r in metrics.token_coverage(frequency.token_runs(docs), done).collect()] == [(1, 6, 1, ["yy", "zz"])]


def _shuffles(frame, *columns):
    """How many exchanges of the plan deal rows by a column of one of the names."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return sum("hashpartitioning(" in line and any(c in line.split("hashpartitioning(")[1].split(")")[0] for c in columns) for line in plan.splitlines())


def test_words_are_not_shuffled_by_document(spark, odd):
    assert _shuffles(__spark_entry__.queries()["token_coverage"](spark, odd), "doc_id") == 1
    assert _shuffles(__spark_entry__.queries()["article_errors"](spark, odd), "doc_id") == 1
