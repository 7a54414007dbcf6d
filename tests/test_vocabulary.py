"""Golden rows of prepared, aligned, analysed and overridden vocabularies."""

import pytest
from pyspark.sql import functions as F

from lexspark.operators import vocabulary

ENTRIES = "ord int, lemma string, pos string, language string, sources array<string>, translations array<struct<sense: int, lang: string, term: string>>"
SIDE = "ord int, lemma string, pos string, translations array<struct<lang: string, term: string, confidence: double, source: string>>"


def test_prepare(spark):
    wikt, wiki = ["io_wiktionary"], ["io_wikipedia"]
    rows = [
        (0, "[[kato]]", "noun", "io", wikt, [(0, "eo", "kato"), (0, "en", "2) cat #T"), (1, "eo", "a b c")]),
        (1, "kato", "noun", "io", wikt, [(0, "eo", "a b c"), (0, "eo", "kato")]),
        (2, "Interreto", "noun", "io", wikt, [(0, "eo", "interreto")]),
        (3, "''", "noun", "io", wikt, [(0, "eo", "x")]),
        (4, "Roma", None, "io", wiki, []),
        (5, "Homo", None, "io", wiki, None),
        (6, "Italiano", "noun", "io", wiki, [(0, "eo", "Italo")]),
        (7, "vorto", "noun", "", wikt, [(0, "eo", "vorto")]),
        (8, "domo", "noun", "eo", wikt, [(0, "eo", "p, q"), (0, "en", "{{x}}")]),
        (9, "seka", "adj", "io", ["io_wikipedia", "io_wiktionary"], [(0, "en", "p, q r")]),
    ]
    ranks = spark.createDataFrame([("homo", 3), ("roma", 90)], "token string, rank int")
    out = vocabulary.prepare(spark.createDataFrame(rows, ENTRIES), ranks, 10)
    got = {(r.lemma, r.pos, r.paradigm, r.made): [(t.sense, t.lang, t.term) for t in r.translations] for r in out.entries.collect()}
    assert got == {
        ("kato", "n", "o__n", False): [(0, "eo", "kato"), (0, "en", "cat")], ("interreto", "n", "o__n", False): [(0, "eo", "interreto")],
        ("Homo", None, "o__n", False): [], ("Italiano", "n", "o__n", False): [(0, "eo", "Italo")], ("Italiana", "adjective", "a__adj", True): [(0, "eo", "Italo")],
        ("seka", "adj", "a__adj", False): [],
    }
    assert sorted(map(tuple, out.suspects.collect()), key=str) == sorted([("bad_tr_eo", "kato", "a b c"), ("wiki_low_freq", "Roma", None), ("bad_tr_eo", "domo", "p, q"), ("comma_tr", "seka", "p, q r")], key=str)
    assert out.counters.first().asDict() == {"input": 10, "cleaned": 2, "invalid": 1, "duplicates": 1, "output": 8, "bad_schema": 1, "bad_lemma": 0, "wiki_low_freq": 1, "all_tr_removed": 3, "tr_removed": 3}
    none = vocabulary.prepare(spark.createDataFrame([], ENTRIES), ranks, 10)
    assert none.entries.count() == none.suspects.count() == 0 and set(none.counters.first()) == {0}


def test_align(spark):
    io = [
        (0, "kato", "n", [("eo", "kato", 0.9, "s"), ("en", "cat", None, None)]), (1, "dissendar", "verb", [("en", "send", None, None)]), (2, "iras", "verb", [("en", "goes", None, None)]),
        (3, "kam", "adverb", [("fr", "que", None, None)]), (4, "nul", None, [("eo", "", None, None)]), (5, "Xy", None, [("en", "x", None, None)]), (6, "dom", "n", None),
    ]
    eo = [(0, "kato", "n", [("io", " kato", None, None), ("io", "kato", None, None), ("en", "cat", None, None)]), (1, "hundo", "n", [("io", "hundo", None, None)])]
    titles = spark.createDataFrame([("Roma", "propn", "io"), ("Romo", "propn", "eo")], "lemma string, pos string, language string")
    via = spark.createDataFrame([("bona", "adj", "bona", None, "good"), ("bona", None, "bone", 0.5, "good"), ("", None, "x", 0.5, "y")], "lemma string, pos string, term string, confidence double, via string")
    got = vocabulary.align(spark.createDataFrame(io, SIDE), spark.createDataFrame(eo, SIDE), titles, {"en": via})
    assert sorted(map(tuple, got.collect()), key=str) == sorted([
        ("identical", "kato", "n", "kato", 1.0, "io_wiktionary", None), ("own", "kato", "n", "kato", 0.9, "s", None), ("bare", "dissendar", "verb", None, None, None, None), ("bare", "kam", "adverb", None, None, None, None),
        ("title", "Roma", "propn", None, None, None, None), ("turned", "kato", "n", "kato", 0.6, "eo_wiktionary", None), ("turned", "hundo", "n", "hundo", 0.6, "eo_wiktionary", None), ("via_en", "bona", "adj", "bona", 0.8, "en_wiktionary_via", "good"),
    ], key=str)


def test_analyse(spark):
    entries = spark.createDataFrame([("kato", "o__n"), ("kata", "a__adj"), ("habitar", "ar__vblex"), (None, None)], "lemma string, paradigm string")
    tokens = spark.createDataFrame([("kati",), ("habitas",), ("kata",), ("12,5",), ("7ma",), ("xyz",), (None,)], "token string")
    got = {r.token: (r.lemma, r.pos, r.n_readings, r.candidates) for r in vocabulary.analyse(tokens, entries).collect()}
    assert got["kati"] == ("kato", "n", 1, ["kati", "kat", "kato"]) and got["habitas"] == ("habitar", "vblex", 1, ["habitas", "habit", "habitar"])
    assert got["kata"][:2] == ("kata", "adj") and got["12,5"][1:3] == ("num", 1) and got["7ma"][1:3] == ("num", 1) and got["xyz"] == ("xyz", None, 0, ["xyz"]) and got[None][:3] == (None, None, 0)


@pytest.mark.parametrize("pos", ["adv", "pr"])
def test_override(spark, pos):
    entries = spark.createDataFrame([("Nur", "adv", "e__adv", {"nur": ["a"], "sole": ["b"]}, ["w"]), ("kato", "n", "o__n", {"kato": ["a"]}, ["w"])], "lemma string, pos string, paradigm string, terms map<string, array<string>>, sources array<string>")
    table = spark.createDataFrame([("nur", pos, "nur", "__adv" if pos == "adv" else None)], "lemma string, pos string, term string, paradigm string")
    got = {(r.lemma, r.pos): (r.paradigm, r.terms, r.sources) for r in vocabulary.override(entries, table).collect()}
    mark = "function_word_override"
    assert got["kato", "n"] == ("o__n", {"kato": ["a"]}, ["w"])
    if pos == "adv":
        assert got["Nur", "adv"] == ("__adv", {"nur": [mark], "sole": ["b"]}, [mark, "w"])
    else:
        assert got["nur", "pr"] == ("__pr", {"nur": [mark]}, [mark]) and got["Nur", "adv"][0] == "e__adv"
