"""Repair of conversations whose roles must alternate: cheapest edits by aligning turns to an alternating target.

The legal orders of role initials are (s?(ua)+)?, so the targets are the strings (ua)^k and s(ua)^k. Turns are
aligned to a target as in Wagner-Fischer, with Keep, Rerole, Delete and Insert; as the shorter targets of a family are
beginnings of the longer ones, one table has the alignments to every feasible length in its columns. A
first pass in a narrow band gives a cost that can be reached; no cheaper alignment leaves the band around
the diagonal which that cost allows (Ukkonen), and the second pass fills just that band. Each cell keeps
the least letter of a cheapest way on, so walking from the start gives the least audit of the family, and
the audits of both families are compared. In conversations of more than LONG turns the columns are folded by
their period, which is exact too: beyond the first columns, two places in the target differ by nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._store import partitions, table

SPACES = " \t\n\x0b\x0c\r"
ENDS = (".", "!", "?")
INSERT, REROLE, DELETE, TRUNCATED = 2, 2, 3, 1
#: Turns of a conversation from which the target's columns are folded by their period.
LONG = 500
ROLES = {"u": "user", "a": "assistant"}

_NEVER = 1 << 60
_FACTS = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
_OUT = "key string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


# -- alignment of one conversation -----------------------------------------------------------------------
# A turn is a letter: d must be deleted; else its role's initial s, u, a or x for any other, a capital if truncated.


def _wanted(j: int, lead: int) -> str:
    """The initial at place j of the target; ``lead`` is 1 in the family that begins with s."""
    return "s" if j < lead else "ua"[(j - lead) % 2]


def _legal_end(j: int, lead: int) -> bool:
    return j % 2 == lead and j != 1  # s alone is no legal order


def _cell(turn: str, wanted: str, below: int, beyond: int, beside: int) -> tuple[int, str]:
    """(cost to the end, letter) of a cell: the cheapest of Delete, Insert, Keep, Rerole, the least letter at a tie.

    Costs are those above what every alignment pays: 3 for a turn that must go, 1 for a truncated one.
    """
    forced, cut = turn == "d", turn.isupper()
    best, letter = below + (0 if forced else DELETE - TRUNCATED * cut), "D"
    if wanted != "s" and beside + INSERT < best:
        best, letter = beside + INSERT, "I"
    if not forced:
        if turn.lower() == wanted:
            if beyond < best:
                best, letter = beyond, "K"
        elif wanted != "s" and beyond + REROLE < best:
            best, letter = beyond + REROLE, "R"
    return best, letter


def _last(j: int, lead: int, beside: int) -> tuple[int, str]:
    """A cell behind the last turn: the end, where the target may end, or an insertion."""
    if _legal_end(j, lead):
        return 0, "."
    return (beside + INSERT, "I") if j >= lead else (_NEVER, "I")


def _walk(turns: str, letter_at) -> str:
    i, j, out = 0, 0, []
    while (x := letter_at(i, j)) != ".":
        out.append(x)
        i, j = i + (x != "I"), j + (x != "D")
    return "".join(out)


def _banded(turns: str, lead: int, half: int) -> tuple[int, str | None]:
    """(cost above the unavoidable, audit) of the cheapest alignment within ``half`` columns of the diagonal."""
    live = [0]
    for t in turns:
        live.append(live[-1] + (t != "d"))
    m, letters = len(turns), []
    below: list[int] = []
    start = 0
    for i in range(m, -1, -1):
        low, high = max(0, live[i] - half), live[i] + half
        row, marks, beside = [0] * (high - low + 1), bytearray(high - low + 1), _NEVER
        for j in range(high, low - 1, -1):
            if i == m:
                cost, x = _last(j, lead, beside)
            else:
                at = j - start
                cost, x = _cell(turns[i], _wanted(j, lead), below[at] if 0 <= at < len(below) else _NEVER, below[at + 1] if 0 <= at + 1 < len(below) else _NEVER, beside)
            row[j - low], marks[j - low], beside = cost, ord(x), cost
        below, start = row, low
        letters.append((low, marks))
    if below[0] >= _NEVER:
        return _NEVER, None
    return below[0], _walk(turns, lambda i, j: chr(letters[m - i][1][j - letters[m - i][0]]))


def _folded(turns: str, lead: int) -> tuple[int, str | None]:
    """As an unbounded band, with the columns folded by their period: 0 1 0 1 ..., or 0 1 2 3 2 3 ... behind s."""
    n = 4 if lead else 2
    onward = [*range(1, n), n - 2]
    m = len(turns)
    marks = bytearray(n * (m + 1))
    below: list[int] = []
    for i in range(m, -1, -1):
        row = [_NEVER] * n
        for _ in range(3):  # an insertion leads to a column of the same row; two in a row come back and can't be cheapest
            for j in range(n - 1, -1, -1):
                beside = row[onward[j]]
                cost, x = _last(j, lead, beside) if i == m else _cell(turns[i], _wanted(j, lead), below[j], below[onward[j]], beside)
                row[j], marks[i * n + j] = cost, ord(x)
        below = row
    if below[0] >= _NEVER:
        return _NEVER, None
    fold = lambda j: j if j < n else n - 2 + (j - n) % 2
    return below[0], _walk(turns, lambda i, j: chr(marks[i * n + fold(j)]))


def align(turns: str, long: int = LONG) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair, the ASCII-least audit among equally cheap ones."""
    unavoidable = sum(DELETE if t == "d" else TRUNCATED if t.isupper() else 0 for t in turns)
    if len(turns) > long:
        found = [_folded(turns, lead) for lead in (0, 1)]
    else:
        half = 2
        found = [_banded(turns, lead, half) for lead in (0, 1)]
        incumbent = min(found)[0]
        if incumbent // 2 > half:  # each column off the diagonal costs two at least
            found = [_banded(turns, lead, incumbent // 2) for lead in (0, 1)]
    cost, audit = min(x for x in found if x[1] is not None)
    return cost + unavoidable, audit


# -- rows ------------------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, gone: the test damage, by crc32 of ``conv_id:turn``; dropped rows are marked, not left out."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    out = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    out = out.withColumn("_copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return out.select(
        "conv_id", "turn",
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", "".join(ENDS), "")).otherwise(F.col("text")).alias("text"),
        (F.col("kind") == 0).alias("gone"),
    )


def _faults(rows: DataFrame) -> DataFrame:
    """Per row, without its text: key, turn, role, digest, gone, fault (the first that it has)."""
    bare = F.rtrim("text", F.lit(SPACES))
    fault = F.when(bare == "", "b").when(~F.right(bare, F.lit(1)).isin(*ENDS), "t").otherwise("")
    light = rows.select("key", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "gone", fault.alias("fault")).repartition(partitions(rows.sparkSession), "key")
    seen = F.row_number().over(Window.partitionBy("key", "gone", "role", "digest").orderBy(F.asc_nulls_first("turn"))) > 1
    return light.withColumn("fault", F.when((F.col("fault") != "b") & seen, "d").otherwise(F.col("fault")))


class _Facts:
    """What is known of a conversation so far: a byte or two for each turn."""

    def __init__(self, key: str):
        self.key, self.initials, self.faults, self.low, self.high, self.distinct = key, [], [], None, None, 0

    def add(self, initials: np.ndarray, faults: np.ndarray, turns: np.ndarray) -> None:
        self.initials.append("".join(initials))
        self.faults.append("".join(x or "." for x in faults))
        known = turns[~pd.isna(turns)]
        if len(known):
            values = known.astype("int64")
            self.distinct += int((values[1:] != values[:-1]).sum()) + (self.high is None or int(values[0]) != self.high)
            self.low, self.high = int(values[0]) if self.low is None else self.low, int(values[-1])

    def row(self) -> tuple:
        initials, faults = "".join(self.initials), "".join(self.faults)
        turns = "".join("d" if f in "bd" else (r if r in "sua" else "x").upper() if f == "t" else r if r in "sua" else "x" for r, f in zip(initials, faults, strict=True))
        legal = sum(initials[i : i + 2] in ("su", "ua", "au") for i in range(len(initials) - 1))
        cost, audit = align(turns)
        gaps = self.high - self.low + 1 - self.distinct if self.high is not None else 0
        return self.key, gaps, faults.count("b"), faults.count("d"), faults.count("t"), max(len(initials) - 1, 0) - legal, cost, audit


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
    return zip(cuts[:-1], cuts[1:], strict=True)


def _facts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows in order in, a row for each conversation out; a conversation may go on in the next batch."""
    now, columns = None, [c.split(" ")[0] for c in _FACTS.split(", ")]
    for b in batches:
        keys, out = b["key"].to_numpy(), []
        for i, j in _runs(keys) if len(keys) else ():
            if now is None or now.key != keys[i]:
                out += [now.row()] if now else []
                now = _Facts(keys[i])
            part = b.iloc[i:j]
            part = part[~part["gone"].to_numpy(dtype=bool)]
            now.add(part["initial"].to_numpy(), part["fault"].to_numpy(), part["turn"].to_numpy())
        yield pd.DataFrame(out, columns=columns)
    if now:
        yield pd.DataFrame([now.row()], columns=columns)


class _Repaired:
    """The digest of a repaired conversation, turn by turn."""

    def __init__(self, facts: tuple):
        self.facts, self.audit, self.at, self.written, self.lead, self.hash = facts, facts[-1], 0, 0, 0, sha256()

    def _write(self, role: str, text: str) -> None:
        self.hash.update(("\n" * (self.written > 0) + f"{role}:{text}").encode())
        self.written += 1

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._write(ROLES[_wanted(self.written, self.lead)], "")
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self._inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K" and self.written == 0:
            self.lead = int(role.startswith("s"))
        if edit != "D":
            self._write(role if edit == "K" else ROLES[_wanted(self.written, self.lead)], text)

    def row(self) -> tuple:
        self._inserted()
        return *self.facts, self.hash.hexdigest()


def _digests(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Each conversation's facts, then its turns in order, in; the facts with the repaired digest out."""
    now, names = None, [c.split(" ")[0] for c in _FACTS.split(", ")]
    for b in batches:
        out = []
        for x in zip(b["is_turn"], b["role"], b["text"], *(b[c] for c in names), strict=True):
            if x[0]:
                now.turn(x[1], x[2])
            else:
                out += [now.row()] if now else []
                now = _Repaired((x[3], *map(int, x[4:10]), x[10]))
        yield pd.DataFrame(out, columns=[*names, "repaired_sha256"])
    if now:
        yield pd.DataFrame([now.row()], columns=[*names, "repaired_sha256"])


def repair(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of each conversation.

    ``rows``: conv_id, turn, role, text (neither null), gone (true for a row that only names its conversation).
    Turns are in the order of (turn, role, digest of the text), nulls first; a null conv_id is a conversation of its
    own; a role without letters matches no place. Turns stream through in order, twice: first without texts
    for the alignment, of which a byte or two for each turn are held, then with them for the digest.
    """
    parts = partitions(rows.sparkSession)
    rows = rows.withColumn("key", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
    order = [F.asc_nulls_first("turn"), "role", "digest"]
    light = _faults(rows).withColumn("initial", F.coalesce(F.nullif(F.left("role", F.lit(1)), F.lit("")), F.lit("-")))
    facts = light.sortWithinPartitions("key", *order).select("key", F.col("turn").cast("string").alias("turn"), "initial", "fault", "gone").mapInPandas(_facts, _FACTS)
    nothing = lambda kind: F.lit(None).cast(kind)
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    heads = facts.select("key", F.lit(False).alias("is_turn"), nothing("bigint").alias("turn"), nothing("string").alias("role"), nothing("string").alias("text"), *[F.col(c).cast("bigint") for c in numbers], "audit")
    turns = rows.where(~F.col("gone")).select("key", F.lit(True).alias("is_turn"), "turn", "role", "text", *[F.lit(0).cast("bigint").alias(c) for c in numbers], nothing("string").alias("audit"))
    both = heads.union(turns).withColumn("digest", F.unhex(F.sha2("text", 256))).repartition(parts, "key").sortWithinPartitions("key", "is_turn", *order)
    out = both.drop("turn", "digest").mapInPandas(_digests, _OUT)
    return out.select(F.nullif("key", F.lit("")).cast("bigint").alias("conv_id"), *[c for c in out.columns if c != "key"])


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``conversations`` damaged by a rule and repaired; see ``damaged`` and ``repair``."""
    return repair(damaged(table(spark, sf_dir, "conversations")))
