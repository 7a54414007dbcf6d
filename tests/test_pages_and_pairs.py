"""Golden rows of page extraction, tagged pairs and classes by ending."""

from pyspark.sql import functions as F

from lexspark import rules
from lexspark.functions import text as X
from lexspark.functions import wikitext as W
from lexspark.operators import joins, tagged
from lexspark.sources import readers

PAGES = "title string, text string"


def apply(spark, values, f):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").select("i", f(F.col("v")).alias("o"))
    return [r.o for r in sorted(rows.collect())]


def test_entries_of_pages(spark):
    pages = [
        ("hundo", "== {{io}} ==\n* {{eo}}: [[hundo]], hundego\n* Morfologio: [[hund]][[.o]]\n* English: dog; hound\n"),
        ("il", "== {{io}} ==\n* Semantiko: ''kurta formo'' di [[ilu]]\n"),
        ("ilu", "== {{io}} ==\n* {{eo}}: li\n"),
        ("kato", "== Ido ==\nEsperanto: kato\n"),
        ("domo", "== {{io}} ==\n* Angliana: house\n* Morfologio: dom.o [[Kategorio:x]]\n"),
        ("bela", "== {{io}} ==\n* {{eo}}: bela {{x}}\n* {{eo}}: belega\n* Morfologio: bel.a\n"),
        ("nulo", "== {{io}} ==\n* Morfologio: nul.o\n* {{eo}}:\n"),
        ("esas", "== {{io}} ==\n* Semantiko: prezenta formo de verbo [[esar]]\n* {{eo}}: estas\n"),
        ("x", "== {{io}} ==\n* {{eo}}: x\n"), ("senparto", "* {{eo}}: x"), (None, None),
    ]
    out = readers.extract_entries(spark.createDataFrame(pages, PAGES), "io", "eo")
    got = {}
    for r in out.collect():
        got.setdefault((r.lemma, r.pos, r.form_of, r.morphology, r.paradigm), set()).add((r.sense_no, r.lang, r.term, r.confidence))
    assert got == {
        ("hundo", "noun", None, "hund.o", "o__n"): {(0, "eo", "hundo", 0.6), (0, "eo", "hundego", 0.6), (1, "en", "dog", 0.5), (2, "en", "hound", 0.5)},
        ("il", None, "ilu", None, None): {(None, None, None, None)},
        ("ilu", None, None, None, None): {(0, "eo", "li", 0.6)},
        ("kato", None, None, None, None): {(0, "eo", "kato", 0.6)},
        ("domo", "noun", None, "dom.oKategorio:x", "o__n"): {(0, "en", "house", 0.5)},
        ("bela", "adjective", None, "bel.a", None): {(0, "eo", "belega", 0.6)},
    }
    variants = joins.resolve_variants(readers.entry_terms(out, "eo"))
    assert {r.lemma: sorted(r.terms) for r in variants.collect()} == {"hundo": ["hundego", "hundo"], "il": ["li"], "ilu": ["li"], "kato": ["kato"], "domo": [], "bela": ["belega"]}
    only = readers.extract_entries(spark.createDataFrame(pages, PAGES), "io", "eo", pivots=False)
    assert {r.lemma for r in only.collect()} == {"hundo", "il", "ilu", "kato", "bela"}


def test_entries_of_other_languages(spark):
    pages = [
        ("domo", "== {{Lingvo|eo}} ==\nx\n===={{Tradukoj}}====\n* Ido = [[domo]]; dometo\n== Y ==\n* Ido: ne"),
        ("kato", "== Esperanto ==\nx\n== Z ==\n* Ido: kato"),
    ]
    got = readers.extract_entries(spark.createDataFrame(pages, PAGES), "eo", "io").collect()
    assert sorted((r.lemma, r.lang, r.term) for r in got) == [("domo", "io", "dometo"), ("domo", "io", "domo"), ("kato", "io", "kato")]
    english = [("house", "== English ==\n* {{io}}: domo\n* {{eo}}: domo, hejmo\n")]
    got = readers.extract_entries(spark.createDataFrame(english, PAGES), "en", "io").collect()
    assert sorted((r.sense_no, r.lang, r.term, r.confidence) for r in got) == [(0, "io", "domo", 0.6), (1, "io", "domo", 0.6), (2, "eo", "domo", 0.6), (2, "eo", "hejmo", 0.6)]


def test_translation_patterns(spark):
    page = "* {{eo}}: a {{x}}\n* EO - b |} c\n{{l|eo|d|alt}} {{trad+|eo|e}}\nx Esperanto: f, g\n* {{eo}}: (1) h, i; (2) j"
    assert apply(spark, [page, None], lambda c: W.translations(c, "eo")) == [[["h", "i"], ["j"], ["b"], ["f", "g"], ["e"], ["d"]], []]
    lines = ["* Morfologio: hund.o", "* Morfologio: [[bitr]] [[.a]]", "*Morfologio:[[x]]", "Morfologio: x.o", "* Morfologio: kun.xyz", None]
    got = apply(spark, lines, W.morphology)
    assert [None if r.raw is None else tuple(r) for r in got] == [("hund.o", "noun", "o__n"), ("bitr.a", "adjective", None), None, None, ("kun.xyz", None, None), None]


def test_tagged_pairs(spark):
    winners = [
        ("kato", None, "o__n", "kato"), ("Ca", None, "a__adj", "kalcio"), ("Ca", "adj", "a__adj", "ĉi"), ("CA", None, "a__adj", "x"), ("bona", None, "a__adj", "Fe"),
        ("dal", "prep_art", "prep_art", "de la"), ("Dal", "prep_art", "prep_art", "de"), ("del", None, "prep_art", "x"), ("al", None, "prep_art", "x"),
        ("me", "prn", "__prn", "mi"), ("esar", None, "ar__vblex", "esti"), ("Roma", "np", "np__np", "Romo"), ("nul", None, None, "x"), ("vana", None, "", "y"), ("kun", "pr", "np__np", "kun"), (None, None, "o__n", "x"), ("x", None, "o__n", None),
    ]
    got = tagged.tagged_pairs(spark.createDataFrame(winners, "lemma string, pos string, paradigm string, term string"), spark.createDataFrame([("esti",), ("esti",)], "term string"))
    assert sorted(tuple(r) for r in got.collect()) == sorted([
        ("kat", "n", "kato", "n", ""), ("C", "adj", "ĉi", "adj", ""), ("CA", "adj", "x", "adj", ""), ("bon", "adj", "Fe", "adj", ""), ("da", "pr.def", "de", "pr.def", ""), ("de", "pr.def", "de", "pr.def", ""),
        ("me", "prn", "mi", "prn", ""), ("me", "adj", "mia", "adj", ""), ("es", "vblex", "esti", "vblex", ""), ("es", "vblex", "esti", "vbser", "rl"), ("Roma", "", "Romo", "", ""), ("kun", "pr", "kun", "pr", ""),
    ])


def test_pairs_by_confidence(spark):
    rows = [
        ("kato", "n", "kato", 0.9, 0), ("kato", "n", "felo", 0.5, 1), ("kato", "n", "kateto", 0.7, 2), ("domo", "n", "Domo", 0.1, 0), ("Kun", "preposition", "kun", 0.4, 0), ("Kun", "preposition", "kune", None, 1),
        ("irar", None, "iri", 0.5, 0), ("irar", None, "veni", 0.5, 1), ("", "n", "x", 1.0, 0), ("x", "n", " ", 1.0, 0), (None, None, None, None, None),
    ]
    got = tagged.pairs_by_confidence(spark.createDataFrame(rows, "lemma string, pos string, term string, confidence double, ord int"))
    assert sorted(tuple(r) for r in got.collect()) == sorted([("kat", "n", "kateto", 0), ("kat", "n", "felo", 1), ("dom", "n", "Domo", 0), ("kun", "", "kune", 0), ("ir", "", "iri", 0), ("ir", "", "veni", 1)])


def test_endings(spark):
    words = ["paris", "as", "iras", "homi", "ai", "bele", "Kato ", "x-2", "", None]
    assert apply(spark, words, lambda c: X.morphology_by_ending(c, F.lit(None), F.lit(None))["pos"]) == ["vblex", None, "vblex", "n", None, "adv", "n", None, None, None]
    assert apply(spark, words[:1], lambda c: X.morphology_by_ending(c, F.lit("io_wikipedia"), F.lit(None))) == [(None, None)]
    assert apply(spark, ["Irar", "hundo", "kantos", "ke", "xyz"], lambda c: X.class_by_ending(c, rules.ENDING_LISTS["audit"])) == ["verb (inf)", "noun (-o)", "verb (conjugated)", "adv (-e)", None]
    text = "{|\n|a\n|}A [[File:x|thumb]][[b|c]] <ref>n</ref>''d''\n== h ==\n* l\n\n\n\ne{{t}}"
    assert apply(spark, [text, None], X.audit_text) == ["A c d\n\ne", ""]
