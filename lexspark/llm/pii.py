"""Personal data: anchor expansion.

One Aho-Corasick pass finds anchors (at-signs, plus signs, digits, schemes, identifier cues); small
local parsers expand each anchor to a span and validate it. Texts without an anchor cost one pass.
"""

from __future__ import annotations

import re
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import _text as tx
from ._store import table

#: Kinds in the order that ties follow. The first four are the base kinds.
KINDS = ("email", "ip", "card", "phone", "account", "login")
CUES = ("iban", "account", "acct", "konto", "cuenta", "compte", "ssn", "passport", "customer id", "user id", "tax id")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_GROUPED = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_DIALLED = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"[\x20]?(?:no\.?|number|nr\.?|#)?[\x20]?[:=#]?[\x20]?\"?([A-Za-z0-9](?:[A-Za-z0-9-]|[\x20](?=[0-9]))*)", re.ASCII)
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?:[\x20]?[A-Z0-9]){11,30}")
_LOGIN = re.compile(r"[^\s/?#@:]+:[^\s/?#@]+(?=@)")
_WORDLIKE = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def iban_ok(text: str) -> bool:
    s = text.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


@cache
def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for c in "0123456789":
        a.add_word(c, ("digit", 1))
    for word, kind in (("@", "at"), ("+", "plus"), ("://", "scheme")):
        a.add_word(word, (kind, len(word)))
    for word in CUES:
        for form in {word, word.upper(), word.capitalize(), word.title()}:
            a.add_word(form, ("cue", len(form)))
    a.make_automaton()
    return a


def find_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind; code points, end exclusive.

    Base kinds are the leftmost non-overlapping matches of their patterns, matches that fail
    validation being dropped whole. ``account`` adds an identifier after a cue (four digits at
    least) and any valid IBAN; ``login`` adds user:password in a URL.
    """
    out: list[tuple[int, int, str]] = []
    past = dict.fromkeys(KINDS, 0)  # per kind, where the next match may start
    for last, (what, size) in _automaton().iter(text):
        at = last - size + 1
        if what == "digit":
            if at >= past["ip"]:
                m = _DOTTED.match(text, at)
                past["ip"] = m.end()
                parts = m.group().split(".")
                place = at
                for k in range(0, len(parts) - 3, 4):
                    four = parts[k : k + 4]
                    end = place + sum(map(len, four)) + 3
                    if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in four):
                        out.append((place, end, "ip"))
                    place = end + 1
            if at >= past["card"] and (m := _GROUPED.match(text, at)):
                past["card"] = m.end()
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append((at, m.end(), "card"))
            if at >= 2 and at >= past["account"] and "A" <= text[at - 1] <= "Z" and (at < 3 or text[at - 3] not in _WORDLIKE) and (m := _IBAN.match(text, at - 2)) and iban_ok(m.group()):
                out.append((at - 2, m.end(), "account"))
                past["account"] = m.end()
        elif what == "at":
            start = at
            while start > past["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                out.append((start, m.end(), "email"))
                past["email"] = m.end()
        elif what == "plus":
            if at >= past["phone"] and (m := _DIALLED.match(text, at)):
                past["phone"] = m.end()
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append((at, m.end(), "phone"))
        elif what == "scheme":
            if m := _LOGIN.match(text, last + 1):
                out.append((last + 1, m.end(), "login"))
        elif at >= past["account"] and (at == 0 or text[at - 1] not in _WORDLIKE):
            m = _NUMBER.match(text, last + 1)
            if m and (last + 1 < m.start(1)) and sum(c.isdigit() for c in m.group(1)) >= 4:
                out.append((m.start(1), m.end(1), "account"))
                past["account"] = m.end(1)
    return sorted(set(out), key=lambda s: (s[0], KINDS.index(s[2]), s[1]))


def join_spans(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redact(text: str, spans: list[tuple[int, int, str]]) -> str:
    """Each stretch of overlapping spans becomes one ``[KIND]`` of the span that starts it."""
    out, at, i = [], 0, 0
    while i < len(spans):
        start, end, kind = spans[i]
        while (i := i + 1) < len(spans) and spans[i][0] < end:
            end = max(end, spans[i][1])
        out += [text[at:start], f"[{kind.upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def pii_spans(docs: DataFrame) -> DataFrame:
    """``docs`` with ``pii array<struct<start, end, kind>>``. Null text counts as empty. Rows, ids and other columns stay as they are."""
    schema = docs.drop("pii").schema
    fields = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string())])

    def run(batches):
        for b in batches:
            found = [[dict(zip(("start", "end", "kind"), s, strict=True)) for s in find_spans(t or "")] for t in b.column("text").to_pylist()]
            yield b.append_column("pii", pa.array(found, pa.list_(fields)))

    kind = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("kind", T.StringType())]))
    return docs.drop("pii").mapInArrow(tx.lean(run), T.StructType([*schema.fields, T.StructField("pii", kind)]))


def redact_documents(docs: DataFrame) -> DataFrame:
    """``docs`` with spans in ``text`` replaced by ``[KIND]`` and ``n_chars`` (if there) set anew. Null text stays null."""
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = [t if t is None else redact(t, find_spans(t)) for t in b.column("text").to_pylist()]
            yield b.set_column(at, "text", pa.array(texts, pa.string()))

    out = docs.mapInArrow(tx.lean(run), docs.schema)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(docs.columns)
    return out


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every whole text of ``documents``: counts of the base kinds, a digest of their spans, and all spans. See ``pii_spans``."""
    found = pii_spans(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    one = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])
    base = F.filter("pii", lambda s: s["kind"].isin(*KINDS[:4]))
    count = lambda k: F.size(F.filter("pii", lambda s: s["kind"] == k)).cast("bigint").alias(f"n_{k}")
    return found.select(
        "doc_id", *map(count, KINDS[:4]),
        F.sha2(F.array_join(F.transform(base, one), ","), 256).alias("base_sha256"), F.array_join(F.transform("pii", one), ",").alias("spans"),
        *map(count, KINDS[4:]),
    )
