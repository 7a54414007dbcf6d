"""Registered queries against their SQL on the smallest tables."""

import os

import pytest

import __spark_entry__

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
CHOSEN = [
    "token_frequency", "coverage", "clean_lemma", "parse_meanings", "split_terms", "entry_paradigms", "merge_lexicon", "merged_winners", "prepare_vocabulary", "shadow_guard", "fold_inflections",
    "precision_srcrank", "identical_form_join", "supplement", "merge_case_twins", "twin_entries", "tagged_derivations", "chrf", "section_facts",
    "extract_entries", "variant_entries", "tagged_pairs", "pairs_by_confidence", "classes_by_ending", "audit_text", "table_cells", "pronoun_pairs", "grid_entries",
    "align_parts", "analyse", "forced_overrides", "read_large_lexicon", "dump_provenance", "schema_errors", "entity_entries", "link_pairs_turned", "unified_entries", "index_records", "dictionary_records",
    "merge_by_lemma", "failure_audit", "article_errors", "entry_quality", "flagged_pairs", "pronoun_rows", "pivot_join", "read_wiki_dump", "read_sql_tuples", "read_lexicon", "read_tagged_pairs",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", CHOSEN)
def test_query_equals_its_sql(spark, duck, name):
    got = __spark_entry__.queries()[name](spark, DIR).toArrow()
    duck.register("got", got)
    duck.sql(f"create or replace temp table want as {__spark_entry__.oracle_sql()[name]}")
    columns = sorted(r[0] for r in duck.sql("describe want").fetchall())
    assert columns == sorted(got.column_names)
    names = ", ".join(f'"{c}"' for c in columns)
    assert duck.sql("select count(*) from want").fetchall()[0][0] == got.num_rows > 0
    assert duck.sql(f"select {names} from want except all select {names} from got").fetchall() == []


def test_every_sql_has_a_query():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_entry_runs(spark):
    assert __spark_entry__.entry(spark).columns == ["lemma", "pos", "paradigm", "term"]
