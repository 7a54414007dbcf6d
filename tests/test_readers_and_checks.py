"""Large lexicon files, dump provenance, schema checks, entities, likeness, split joins."""

import json
import random
from difflib import SequenceMatcher

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from lexspark.functions.likeness import ratios
from lexspark.operators import checks, entities, joins
from lexspark.operators.skew import hot_keys, split_join
from lexspark.sources import readers


@pytest.mark.parametrize("form", ["list", "wrapped", "compact", "compact_wrapped"])
def test_large_lexicon(spark, tmp_path, form):
    rng = random.Random(3)
    entries = []
    for i in range(400):
        terms = [{"term": rng.choice(["a}]", 'q"},{"lemma":', "{", "é\\"]) + str(k), "lang": "eo", "confidence": 0.5, "source": "s"} for k in range(i % 4)]
        entries.append({"lemma": f"w{i}", "pos": None if i % 3 else "n", **({"translations": terms} if i % 2 else {"senses": [{"translations": terms}, {"translations": []}]})})
    value = {"metadata": {"x": [{"y": 1}], "version": "1"}, "entries": entries} if "wrapped" in form else entries
    path = str(tmp_path / "big.json")
    with open(path, "w") as f:
        json.dump(value, f, ensure_ascii=False, **({"separators": (",", ":")} if "compact" in form else {"indent": 2}))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        big = readers.read_large_lexicon(spark, path)
        assert big.rdd.getNumPartitions() > 4
        got = [(r.lemma, r.pos, r.term, r.source) for r in big.orderBy("ord").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(r.lemma, r.pos, r.term, r.source) for r in readers.read_lexicon(spark, [path]).orderBy("ord").collect()] and len(got) > 600


def test_empty_large_lexicon(spark, tmp_path):
    for i, text in enumerate(["[]", '{"entries": []}', "[\n  {\n    \"lemma\": \"x\"\n  }\n]\n"]):
        (tmp_path / f"{i}.json").write_text(text)
        assert [r.lemma for r in readers.read_large_lexicon(spark, str(tmp_path / f"{i}.json")).collect()] == ["x"] * (i == 2)


def test_dump_provenance(spark, tmp_path):
    page = "<page><title>a</title><ns>0</ns><id>1</id><revision><id>2</id><text>x</text></revision></page>"
    for name in ("iowiki-20251021-pages.xml", "iowiki-latest-pages.xml", "eowiki.xml"):
        (tmp_path / name).write_text(f"<mediawiki>{page}</mediawiki>")
    got = {r.dump_file: r.dump_date for r in readers.read_wiki_dump(spark, str(tmp_path), dump=True).collect()}
    today = got.pop("eowiki.xml")
    assert got == {"iowiki-20251021-pages.xml": "2025-10-21", "iowiki-latest-pages.xml": today} and len(today) == 10


def test_wiki_dump_keeps_blanks_and_other_fields(spark, tmp_path):
    page = '<page>\n  <title>%s</title>\n  <ns>0</ns>\n  <id>%s</id>\n  <revision>\n    <id>2</id>\n    <text bytes="1" xml:space="preserve">%s</text>\n  </revision>\n</page>\n'
    rows = [("a", "1", "x "), ("b", "2", " x\n"), ("c", "", "x"), ("d", "null", "&lt;y&gt; &amp; "), ("e", " 5 ", "z"), ("f", "6", ""), ("null", "7", "null")]
    (tmp_path / "a.xml").write_text("<mediawiki>\n" + "".join(page % r for r in rows) + "</mediawiki>")
    got = sorted(tuple(r) for r in readers.read_wiki_dump(spark, str(tmp_path / "a.xml")).collect())
    ids, texts = [1, 2, None, None, 5, 6, 7], ["x ", " x\n", "x", "<y> & ", "z", "", "null"]
    assert got == [(title, 0, i, 2, text) for (title, _, _), i, text in zip(rows, ids, texts)]


@pytest.mark.parametrize("name", ["read_wiki_dump", "read_pages_by_title"])
def test_dump_queries_equal_their_sql_on_odd_documents(spark, tmp_path, name):
    duckdb = pytest.importorskip("duckdb")
    langs = ["en", None, "", " es ", "es", "fr ", "a&b", "&amp;", "<page>", "</page>", "<ns>4</ns>", "]]>", "a+b%20", "\r\n", "\x01", "é😀", "fr"]
    rows = [(3 * i + 1, text, lang) for i, lang in enumerate(langs) for text in ("x", "", None, " ")] + [(None, "x", "es"), (None, "", "en"), (-2, "", "fr"), (-3, "x", "es"), (9, "", "fr"), (10**17, "é\n", "es")]
    pq.write_table(pa.table(dict(zip(("doc_id", "text", "lang"), map(list, zip(*rows))))), tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet'")
    got = __spark_entry__.queries()[name](spark, str(tmp_path)).toArrow()
    con.register("got", got)
    con.sql(f"create table want as {__spark_entry__.oracle_sql()[name]}")
    names = ", ".join(f'"{c}"' for c in got.column_names)
    for one, other in (("want", "got"), ("got", "want")):
        assert con.sql(f"select {names} from {one} except all select {names} from {other}").fetchall() == []
    assert got.num_rows > 0


def test_schema_errors(spark):
    good = {"lemma": "kato", "source": "s", "translations": [{"term": "x", "lang": "eo", "confidence": 1, "source": "s"}], "extra": 1}
    term = good["translations"][0]
    cases = [
        (good, []), ({**good, "lemma": 5}, [("lemma", "not of type string")]), ({"lemma": "x"}, [("source", "required"), ("translations", "required")]),
        ({**good, "translations": {}}, [("translations", "not of type array")]), ({**good, "translations": []}, []), ({**good, "pos": None}, [("pos", "not of type string")]),
        ({**good, "translations": [term, {**term, "confidence": 1.5}, {**term, "confidence": "1"}, 7]}, [("translations.1.confidence", "maximum"), ("translations.2.confidence", "not of type number"), ("translations.3", "not of type object")]),
        ({**good, "translations": [{"term": "x", "confidence": -0.1}]}, [("translations.0.lang", "required"), ("translations.0.source", "required"), ("translations.0.confidence", "minimum")]),
        ({**good, "morphology": {"paradigm": 1}, "metadata": []}, [("morphology.paradigm", "not of type string"), ("metadata", "not of type object")]), ([], [("", "not of type object")]),
    ]
    rows = [(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(100, "no json"), (101, None)]
    got = {r.i: [tuple(e) for e in r.errors] for r in checks.entry_errors(spark.createDataFrame(rows, "i int, value string")).collect()}
    assert {i: sorted(e) for i, e in got.items()} == {i: sorted(e) for i, (_, e) in enumerate(cases)} | {100: [("", "no JSON")], 101: [("", "no JSON")]}


def test_entities(spark):
    props = spark.createDataFrame([(1, "Q1", 0), (2, "Q2", 1), (3, "Q3", 2), (4, "Q4", 3), (9, "Q1", 5)], "page_id int, entity string, ord int")
    pages = spark.createDataFrame([(1, "Alt"), (2, "Kato"), (3, "x y"), (4, "Domo"), (9, "Hundo")], "page_id int, title string")
    labels = spark.createDataFrame([("Q1", "b", "hundo"), ("Q2", "a", "kato"), ("Q2", "b", "kato"), ("Q3", "b", "z"), ("Q4", "b", "d")], "entity string, lang string, label string")
    aliases = spark.createDataFrame([("Q1", "a", "KATO", 1), ("Q1", "a", "du vorti", 0), ("Q1", "b", "dogo", 1), ("Q1", "b", "hundo", 2), ("Q1", "b", "x", 0), ("Q2", "b", "felo", 0), ("Q2", "b", "hundo", 1)], "entity string, lang string, alias string, ord int")
    got = {}
    for r in entities.entity_entries(props, pages, labels, aliases).orderBy("key", "place").collect():
        got.setdefault((r.key, r.lemma, r.entity), []).append(r.term)
    assert got == {("hundo", "Hundo", "Q1"): ["hundo", "dogo"], ("kato", "KATO", "Q1"): ["hundo", "dogo", "kato", "felo"]}


def test_likeness():
    rng = random.Random(5)
    word = lambda alphabet, n: "".join(rng.choices(alphabet, k=rng.randint(0, n)))
    pairs = [(word("abc", 12), word("abc", 12)) for _ in range(3000)] + [(word("aé𝒳b", 30), word("aé𝒳b", 30)) for _ in range(500)] + [(word("ab", 90), word("ab", 90)) for _ in range(50)] + [("x" * 250, "xy" * 130), ("", ""), ("a", "")]
    assert ratios(pairs).tolist() == [SequenceMatcher(None, *p).ratio() if p[0] and p[1] else 0.0 for p in pairs]


def test_split_join(spark):
    rng = random.Random(1)
    key = lambda: rng.choice(["hot", None, f"k{rng.randint(0, 200)}", f"k{rng.randint(0, 200)}"])
    left = spark.createDataFrame([(key(), f"a{i}") for i in range(3000)] + [("one", f"a{i}") for i in range(2000)], "k string, a string")
    right = spark.createDataFrame([(key(), f"b{i}") for i in range(3000)] + [("one", "b")], "k string, b string")
    out = split_join(left, right, ["k"])
    assert out.count() == out.distinct().count() == left.join(right, "k").count()
    assert sorted(out.collect()) == sorted(left.join(right, "k").select(out.columns).collect())
    assert {r.k for r in hot_keys(left.dropna(), right.dropna(), ["k"], 4).collect()} == {"hot", "one"}
    assert split_join(left.where("false"), right, ["k"]).count() == 0
    page = [("p", 0, "ab"[i % 2], f"t{i % 300}") for i in range(900)] + [("q", i, "ab"[i % 2], f"t{i}") for i in range(6)]
    rows = spark.createDataFrame(page, "page string, meaning int, lang string, term string")
    got = {tuple(r) for r in joins.same_page_pairs(rows, by_meaning=False).collect()}
    assert got == {(p, s, t) for p, _, x, s in page for q, _, y, t in page if p == q and x == "a" and y == "b"}


def test_links_of_either_side(spark):
    pages, links = spark.createDataFrame([(1, "kato")], "page_id int, title string"), spark.createDataFrame([(1, "felo")], "page_id int, target string")
    assert joins.link_pairs(pages, links).select("lemma", "term").first() == ("kato", "felo")
    assert joins.link_pairs(pages, links, source_pages=False).select("lemma", "term").first() == ("felo", "kato")
    assert joins.link_pairs(pages, links).select(F.round("confidence", 2).alias("c")).first().c == 0.85
