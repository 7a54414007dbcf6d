"""Rule tables. All are parameters of the functions that use them; these are the defaults."""

from __future__ import annotations

# Reliability ranks of sources, lower is better; unlisted sources have rank 2.
SOURCE_RANK = {
    "function_word_override": 0, "function_words_seed": 0, "closed_class_tables": 0,
    "io_wiktionary": 1, "eo_wiktionary": 1, "fr_wiktionary_meaning": 1,
    "fr_wiktionary_via": 2, "en_wiktionary_via": 2, "wikidata_labels": 2,
    "wikipedia_langlinks": 2, "eowiki_langlinks": 2, "morphological_expansion": 2,
    "bert_embeddings": 4,
}
DEFAULT_RANK = 2
# Sources that are known from embeddings alone.
EMBEDDING_SOURCES = ("bert_embeddings",)
# Sources that come by way of a third language.
VIA_SOURCES = ("en_wiktionary_via",)
# Person, gender and number of the target language's personal pronouns.
PERSON_FEATURES = [
    ("mi", "p1", "mf", "sg"), ("ni", "p1", "mf", "pl"), ("ci", "p2", "mf", "sp"), ("vi", "p2", "mf", "sp"),
    ("li", "p3", "m", "sg"), ("ŝi", "p3", "f", "sg"), ("ĝi", "p3", "nt", "sg"), ("ili", "p3", "mf", "pl"),
]
# Marks that a page leaves in a dictionary term, removed in this order.
TERM_MARKS = [
    (r"(?i)\s*Kategorio:.*", ""), (r"\[\[([^\]|]+)(?:\|[^\]]+)?\]\]", "$1"), (r"\s*[↓→←↑]\s*", " "), (r"\s*\([^)]*\)\s*", " "),
    (r"\s*\[[^\]]*\]\s*", " "), (r"\s+", " "), (" ,", ","), (",  ", ", "),
]

# Long part-of-speech names and their short tags.
SHORT_POS = {
    "noun": "n", "adjective": "adj", "adverb": "adv", "verb": "vblex", "preposition": "pr",
    "conjunction": "cnjcoo", "subordinating conjunction": "cnjsub", "determiner": "det",
    "pronoun": "prn", "interjection": "ij", "numeral": "num",
}

# The paradigm of each short tag.
POS_PARADIGM = {
    "n": "o__n", "adj": "a__adj", "adv": "e__adv", "vblex": "ar__vblex", "pr": "__pr",
    "det": "__det", "prn": "__prn", "cnjcoo": "__cnjcoo", "cnjsub": "__cnjsub", "ij": "__ij",
    "num": "num", "prep_art": "__prep_art",
}
# Tags of closed classes, and those whose lemmas are lower-cased.
CLOSED_CLASS = ("det", "pr", "prn", "cnjcoo", "cnjsub", "ij", "num", "np", "prep_art", "rel")
LOWERED_CLASS = ("prn", "det", "pr", "cnjcoo", "cnjsub", "ij")

# Closed-class series whose part of speech is forced.
FORCED_PRONOUNS = ("qua", "qui", "quo", "quan", "quin", "quon", "di qua", "di qui", "di quo")
FORCED_ADJECTIVES = ("ita", "ta")

# Fixed values: (lemma, part of speech, term) that override what sources say.
OVERRIDES = [
    ("e", "cnjcoo", "kaj"), ("ed", "cnjcoo", "kaj"), ("o", "cnjcoo", "aŭ"), ("od", "cnjcoo", "aŭ"),
    ("cent", "num", "cent"), ("a", "pr", "al"), ("al", "pr", "al"), ("dal", "prep_art", "de"),
    ("dil", "prep_art", "de"), ("til", "pr", "ĝis"), ("quan", "prn", "kiun"),
    ("di qua", "prn", "de kiu"), ("di qui", "prn", "de kiuj"), ("saluto", "ij", "saluton"),
]

# Fixed values: (source suffix, target suffix, tag) of derivations from verb, noun and adjective roots.
VERB_SUFFIXES = [
    ("ado", "ado", "n"), ("anto", "anto", "n"), ("into", "into", "n"), ("onto", "onto", "n"),
    ("anta", "anta", "adj"), ("inta", "inta", "adj"), ("onta", "onta", "adj"),
    ("ante", "ante", "adv"), ("inte", "inte", "adv"), ("onte", "onte", "adv"),
    ("ata", "ata", "adj"), ("ita", "ita", "adj"), ("ota", "ota", "adj"),
    ("ate", "ate", "adv"), ("ite", "ite", "adv"), ("ote", "ote", "adv"),
    ("ema", "ema", "adj"), ("emo", "emo", "n"), ("inda", "inda", "adj"), ("ilo", "ilo", "n"),
    ("ejo", "ejo", "n"), ("isto", "isto", "n"),
]
NOUN_SUFFIXES = [
    ("a", "a", "adj"), ("ala", "a", "adj"), ("oza", "a", "adj"), ("e", "e", "adv"), ("aro", "aro", "n"),
    ("ejo", "ejo", "n"), ("emo", "emo", "n"), ("eso", "eco", "n"), ("ino", "ino", "n"), ("isto", "isto", "n"),
    ("ismo", "ismo", "n"), ("ulo", "ulo", "n"), ("eto", "eto", "n"), ("ego", "ego", "n"),
]
ADJECTIVE_SUFFIXES = [("eso", "eco", "n"), ("e", "e", "adv"), ("ulo", "ulo", "n"), ("ino", "ino", "n")]
# Endings of roots that are derived themselves.
DERIVED_ROOT = "(ar|ir|or|as|is|os|us|ez|ant|int|ont|at|it|ot|em|ind)$"

# Category name parts of each class, in order of precedence.
CATEGORY_PATTERNS = {
    "geography": (
        "landi", "urbi", "citat", "komunumi", "provinc", "region", "stato", "afrika", "amerika", "europa", "oceania",
        "azia", "antarktika", "geografio", "topografio", "kapitali", "insuli", "monto", "riveri", "laki", "oceani", "mari",
    ),
    "people": (
        "person", "homo", "kompozist", "skriptist", "autor", "poeta", "biciklis", "futbalis", "prezidant", "aktris", "aktoro",
        "kantisto", "direktoro", "filozofo", "scientisto", "matematikisto", "fizikisto", "naskita", "mortinta", "biografio",
    ),
    "organization": ("organizaji", "kompanio", "firmao", "klubo", "asocio", "universitati", "skoli", "governo"),
    "temporal": ("yari", "monati", "tagi", "horai", "sekli", "eventi", "historio"),
}

# Fixed values: (paradigm, suffix, tags) of the inflection tables.
PARADIGMS = [
    ("o__n", "o", "n.sg.nom"), ("o__n", "i", "n.pl.nom"),
    ("o__n", "ala", "n.der_ala.adj.sg.nom"), ("o__n", "oza", "n.der_oz.adj.sg.nom"),
    ("o__n", "izar", "n.der_izar.vblex.inf"), ("o__n", "izas", "n.der_izar.vblex.pri"), ("o__n", "izis", "n.der_izar.vblex.pii"),
    ("o__n", "izos", "n.der_izar.vblex.fti"), ("o__n", "izus", "n.der_izar.vblex.cni"), ("o__n", "izez", "n.der_izar.vblex.imp"),
    ("o__n", "ino", "n.f.sg.nom"), ("o__n", "ini", "n.f.pl.nom"), ("o__n", "ajo", "n.der_aj.n.sg.nom"), ("o__n", "aji", "n.der_aj.n.pl.nom"),
    ("o__n", "aro", "n.der_aro.n.sg.nom"), ("o__n", "ari", "n.der_aro.n.pl.nom"),
    ("a__adj", "a", "adj"), ("a__adj", "eso", "adj.der_qual.n.sg.nom"), ("a__adj", "esi", "adj.der_qual.n.pl.nom"),
    ("a__adj", "ajo", "adj.der_aj.n.sg.nom"), ("a__adj", "aji", "adj.der_aj.n.pl.nom"),
    ("ebl__adj", "ebla", "adj"), ("e__adv", "e", "adv"),
    ("ar__vblex", "ar", "vblex.inf"), ("ar__vblex", "as", "vblex.pri"), ("ar__vblex", "is", "vblex.pii"),
    ("ar__vblex", "os", "vblex.fti"), ("ar__vblex", "us", "vblex.cni"), ("ar__vblex", "ez", "vblex.imp"),
    ("ar__vblex", "anto", "vblex.der_pres.n.sg.nom"), ("ar__vblex", "anti", "vblex.der_pres.n.pl.nom"),
    ("ar__vblex", "ado", "vblex.der_act.n.sg.nom"), ("ar__vblex", "adi", "vblex.der_act.n.pl.nom"),
    ("ar__vblex", "into", "vblex.der_past.n.sg.nom"), ("ar__vblex", "inti", "vblex.der_past.n.pl.nom"),
    ("ar__vblex", "inta", "vblex.der_ppa.adj.sg"), ("ar__vblex", "ita", "vblex.der_ppas.adj.sg.nom"), ("ar__vblex", "ata", "vblex.der_pprs.adj.sg.nom"),
    ("ar__vblex", "ota", "vblex.der_pfut.adj.sg.nom"), ("ar__vblex", "anta", "vblex.der_ppra.adj.sg.nom"),
    ("ar__vblex", "esar", "vblex.der_esar.vblex.inf"), ("ar__vblex", "esas", "vblex.der_esar.vblex.pri"), ("ar__vblex", "esis", "vblex.der_esar.vblex.pii"),
    ("ar__vblex", "esos", "vblex.der_esar.vblex.fti"), ("ar__vblex", "esus", "vblex.der_esar.vblex.cni"), ("ar__vblex", "esez", "vblex.der_esar.vblex.imp"),
    ("num", "", "num"), ("__pr", "", "pr"), ("__det", "", "det"), ("__prn", "", "prn"), ("__adv", "", "adv"),
    ("__cnjcoo", "", "cnjcoo"), ("__cnjsub", "", "cnjsub"), ("ma__ord", "ma", "num.ord"), ("ma__ord", "esma", "num.ord"),
    ("__invar_verb", "", "vblex.pri"), ("np__np", "", "np"), ("__prep_art", "", "pr.def"), ("__ij", "", "ij"),
]
# Fixed values: (paradigm, pattern of a whole word, tags) of words in digits, which have no stem.
DIGIT_PARADIGMS = [("num_regex", r"^[0-9]+([.,][0-9]+)*$", "num.ciph.sp.nom"), ("num_ord_regex", r"^[0-9]+-?ma$", "num.ord")]

# Fixed values: (paradigm, its derivation tag, the source's last tag, target suffix, target tags) of the tagged
# derivations; a slash keeps the target word whole.
TAGGED_DERIVATIONS = [
    ("ar__vblex", "der_pres", "n", "anto", "n"), ("ar__vblex", "der_act", "n", "ado", "n"), ("ar__vblex", "der_past", "n", "into", "n"),
    ("ar__vblex", "der_ppra", "adj", "anta", "adj"), ("ar__vblex", "der_pfut", "adj", "ota", "adj"), ("ar__vblex", "der_ppas", "adj", "/", "vblex.pp"),
    ("ar__vblex", "der_ppa", "adj", "/", "vblex.pp3"), ("ar__vblex", "der_pprs", "adj", "/", "vbtr.ppres"), ("a__adj", "der_qual", "n", "eco", "n"),
    ("o__n", "der_ala", "adj", "a", "adj"), ("o__n", "der_oz", "adj", "a", "adj"), ("o__n", "der_aro", "n", "aro", "n"),
]
# Personal pronouns.
PERSONAL_PRONOUNS = ("me", "tu", "vu", "lu", "elu", "ilu", "olu", "ni", "vi", "li", "su")

# Titles and words that are page furniture.
SKIPPED_TITLES = ("MediaWiki", "Help", "Category", "Template", "User", "Talk", "File", "Image", "Special", "Main", "Wikipedia", "Wiktionary")
LAYOUT_WORDS = (
    "thumb", "left", "right", "center", "centre", "displaytitle", "redirect", "colspan", "rowspan", "bgcolor", "rowcolor", "style",
    "px", "small", "big", "border", "align", "valign", "background", "font", "nbsp", "sub", "sup", "br", "hr", "ref", "nowrap",
    "width", "height", "color",
)

# Patterns that cut, clean and check words. A chain's steps are (pattern, replacement with $1 for a
# group), applied in order; the order is part of the meaning.
TRIMMED = " \t\n\r\f\x0b:;,.–-|"

# What goes from a headword.
LEMMA_CHAIN = [
    (r"'{2,}", ""),
    (r"\[\[([^|\]]+)\|([^\]]+)\]\]", "$2"),
    (r"\[\[([^\]]+)\]\]", "$1"),
    (r"\{\{[a-z]{2,3}\}\}", ""),
    (r"\{\{(?:t\+?|trad\+?|l|link|m|tr)\|[^|]+\|([^}|]+)[^}]*\}\}", "$1"),
    (r"\{\{[^|]+\|([^}]+)\}\}", "$1"),
    (r"\{\{[^}]+\}\}", ""),
    (r"[\{\}\[\]]", ""),
    (r"^'{0,3}\s*[0-9]+\.'{0,3}\s*", ""),
    (r"(?i)\s*\([a-z]{2,3}\)\s*$", ""),
    (r"\s*\(\s*[↓↑→←⇒⇐⇑⇓]+\s*\)\s*", " "),
    (r"\s*[↓↑→←⇒⇐⇑⇓]\s*", " "),
    (r"^\s*\('*[♀♂]'*\)\s*$", ""),
    (r"\s*\('*[♀♂]'*\)\s*", " "),
    (r"\('+\)", ""),
]

# What goes from a translation.
TRANSLATION_CHAIN = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;|&apos;", "'"), ("&nbsp;", " "), ("&amp;", "&"),
    (r"\s*\[[\d\s,–-]+\]\s*", " "),
    ("[↓↑]", ""),
    (r"\{\{(?:t\+?|trad\+?|l|link|m)\|[^|]+\|([^}|]+)[^}]*\}\}", "$1"),
    (r"\{\{[^}]*\}\}", ""),
    (r"\[\[(?:Category|Kategorio):[^\]]*\]\]", ""),
    (r"\[\[(?:[^\]|]*\|)?([^\]]+)\]\]", "$1"),
    (r"\s*\([^)0-9][^)]*\)\s*", " "),
    (r"<[^>]+>", ""),
    (r"\|\s*\}.*$", ""),
    (r"\s+", " "),
]

# What goes from wikitext.
WIKITEXT_CHAIN = [
    (r"(?s)<ref[^>]*>.*?</ref>", " "),
    (r"\{\{[^\}]*\}\}", " "),
    (r"(?i)\[\[(?:File|Fajlo|Dosiero|Datei|Archivo):[^\]]*\]\]", " "),
    (r"\[\[(?:[^\]|]*\|)?([^\]]+)\]\]", "$1"),
    (r"<[^>]+>", " "),
]

# The letters of a target word.
TERM_CHARS = r"^[A-Za-zĈĜĤĴŜŬĉĝĥĵŝŭ\-]+$"
# Shapes of numbers.
NUMERIC_SHAPES = r"^-?[0-9]+(\.[0-9]+)?$|^[0-9]+[,;:]|^[0-9.,%\-]+$|^[0-9]+(ma|st|nd|rd|th|ĝa|a|esma)$|^[A-Za-z0-9_]{0,3}[0-9]{2,}[A-Za-z0-9_]{0,3}$"
# Endings of conjugated verbs.
CONJUGATED = "^[a-z]{2,}(as|is|os|us|ez)$"
# A title that can be a word.
LINK_TITLE = r"^[A-Za-zĉĝĥĵŝŭĈĜĤĴŜŬ][\p{L}\p{N}_\-\s]*$"
# A label that can be a word.
LABEL = r"^[a-zA-ZĈĉĜĝĤĥĴĵŜŝŬŭÀ-ÿ][a-zA-ZĈĉĜĝĤĥĴĵŜŝŬŭÀ-ÿ\-]+$"

# Contractions of a preposition with the article, and what the preposition is in the target.
CONTRACTIONS = [("dal", "da", "de"), ("del", "de", "de"), ("dil", "di", "de"), ("el", "e", "al"), ("sil", "si", "al")]

# Parts of speech that stand for a tag where the paradigm has none.
TAG_POS = ("pr", "det", "prn", "cnjcoo", "cnjsub", "ij")

# Tags of parts of speech in the confidence-sorted pair table, names that it knows besides, and those without a tag or without an ending to cut.
PAIR_TAGS = {"n": "n", "v": "vblex", "vblex": "vblex", "adj": "adj", "adv": "adv", "num": "num", "np": "np", "ij": "ij"}
PAIR_POS = {"conjunction": "cnjcoo", "coordinating conjunction": "cnjcoo", "subordinating conjunction": "cnjsub", "preposition": "prep"}
INVARIABLE = ("pr", "prep", "cnjcoo", "cnjsub", "det", "prn", "ij", "num")
STEM_ENDINGS = {"n": "o", "v": "ar", "vblex": "ar", "adj": "a", "adv": "e"}

# Ordered endings of words, the class that each tells and the least letters of a word that it holds for.
ENDING_LISTS = {
    "source": [("ar", "vblex", 0), ("o", "n", 0), ("a", "adj", 0), ("e", "adv", 0)],
    "target": [("o", "n", 0), ("i", "vblex", 0), ("a", "adj", 0), ("e", "adv", 0)],
    "morphology": [
        ("is", "vblex", 4), ("ar", "vblex", 0), ("as", "vblex", 4), ("os", "vblex", 4), ("us", "vblex", 4), ("ez", "vblex", 4),
        ("o", "n", 0), ("i", "n", 3), ("a", "adj", 0), ("e", "adv", 3),
    ],
    "audit": [
        ("ar", "verb (inf)", 0), ("ir", "verb (inf)", 0), ("or", "verb (inf)", 0), ("o", "noun (-o)", 0), ("a", "adj (-a)", 0), ("e", "adv (-e)", 0),
        ("os", "verb (conjugated)", 0), ("as", "verb (conjugated)", 0), ("is", "verb (conjugated)", 0), ("us", "verb (conjugated)", 0), ("ez", "verb (conjugated)", 0),
    ],
}
MORPHOLOGY_CLASSES = {"vblex": "ar__vblex", "n": "o__n", "adj": "a__adj", "adv": "e__adv"}

# What the audit of articles cuts from wikitext, in this order.
AUDIT_CHAIN = [
    (r"(?s)\{\|.*?\|\}", ""), (r"(?s)<ref[^/]*/?>.*?</ref>", ""), (r"\{\{[^}]*\}\}", ""), (r"(?i)\[\[(?:File|Image|Imajo):[^\]]*\]\]", ""),
    (r"\[\[(?:[^|\]]*\|)?([^\]]*)\]\]", "$1"), ("<[^>]+>", ""), ("==+[^=]+=+", ""), ("'{2,}", ""), (r"(?m)^\*[^\n]*$", ""), (r"(?m)^\|[^\n]*$", ""), (r"(?m)^![^\n]*$", ""), (r"\n{3,}", "\n\n"),
]

# Closed-class tables: the heading that marks each, the labels of the rows, the sources of what is read from them.
PRONOUN_TABLE, PRONOUN_ROWS = "Pronomi", ("Ido", "Esperanto")
GRID_TABLE = "Tabelo plu granda"
GRID_SOURCES = ("closed_class_tables", "closed_class_tables_qualified")
# Footnote marks in cells.
FOOTNOTE = r"[¹²³⁴⁵]|&lt;sup&gt;.*?&lt;/sup&gt;|<sup>.*?</sup>"
# The columns' target prefixes and what follows the word, and the rows' suffixes and parts of speech.
GRID_COLUMNS = [("ki", ""), ("ti", ""), ("i", ""), ("i", " ajn"), ("neni", ""), ("ĉi", "")]
GRID_ROWS = [
    ("", "u", "adj"), ("individuo", "u", "prn"), ("kozo", "o", "prn"), ("pluralo", "uj", "prn"), ("motivo", "al", "adv"), ("loko", "e", "adv"),
    ("tempo", "am", "adv"), ("qualeso", "a", "adj"), ("maniero", "el", "adv"), ("quanto substantivala", "om", "prn"),
]

# What goes from a translation when a vocabulary is prepared.
VOCABULARY_CHAIN = [(r"^[0-9]+\)\s*", ""), (r"(?i)\s*kategorio:[^\s]+[^\n]*$", ""), (r"\s*#[^\s]+", "")]

# The ending of the citation form for each class of an analysis.
CITATION_ENDINGS = {"n": "o", "vblex": "ar", "vbser": "ar", "vbmod": "ar", "adj": "a", "adv": "e"}

# Parts of speech whose words need no ending.
CLOSED_POS = (
    "adv", "pr", "det", "prn", "num", "cnjcoo", "cnjsub", "ij", "prep_art", "adverb", "preposition", "determiner", "pronoun", "numeral",
    "conjunction", "interjection", "subordinating conjunction",
)
