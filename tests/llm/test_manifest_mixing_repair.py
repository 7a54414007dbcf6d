"""Merkle manifest, mixing and conversation repair against brute-force versions, odd rows and empty tables included."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict
from heapq import heappop, heappush

import pytest
from pyspark.sql import functions as F

from lexspark.llm import conversation_repair, merkle, mixing
from lexspark.llm._store import Store

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
TURNS = "conv_id bigint, turn bigint, role string, text string"
CLASHING = ("key", "pos", "n", "digest", "block", "size", "h", "gone", "kind", "root", "leaf", "weight")


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def corpus():
    rng = random.Random(5)
    rows = []
    for i in range(90):
        text = rng.choice([None, "", "one", "a\nb\n\nc " * rng.randint(1, 9), "w " * rng.randint(1, 60), "é x " * 3])
        rows.append((i - 7, text, rng.choice(["en", None]), "src0" if i % 3 else rng.choice([None, "", "srcé", "src1", "solo"][: 1 + i % 5]), rng.choice([None, i])))
    rows += [(None, "no id\nat all", "en", "src0", 3), (None, None, None, None, None), (5, "twice", "en", "src0", 1), (5, "twice", "en", "src0", 1), (5, "other", "en", "src0", 1), (900, "long word " * 40000, "de", "alone", 7)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), DOCS).withColumns({c: F.lit("x") for c in CLASHING}).repartition(5)


def digest(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """(top, for each leaf the (place, others) of each level)"""
    ways, level, at = [[] for _ in nodes], nodes, list(range(len(nodes)))
    while len(level) > 1:
        runs = [level[i : i + 3] for i in range(0, len(level), 3)]
        for k, i in enumerate(at):
            ways[k].append((i % 3, [x for j, x in enumerate(runs[i // 3]) if j != i % 3]))
        level, at = [sha("".join(r)) for r in runs], [i // 3 for i in at]
    return level[0], ways


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_merkle(spark, docs, levels):
    sources = defaultdict(list)
    for row in corpus():
        text, i = row[1], row[0]
        found = text.replace("\n", "") if text is not None and i is not None and zlib.crc32(str(i).encode()) % 2 == 0 else text
        sources[row[3]].append((i is not None, i or 0, digest(row, text), digest(row, found)))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(sources[s])]) for s in names}
    root, over = tree([trees[s][0] for s in names])
    want = []
    for s, above in zip(names, over, strict=True):
        subroot, ways = trees[s]
        for (known, i, leaf, found), way in zip(sorted(sources[s]), ways, strict=True):
            folded = found
            for at, others in way + above:
                folded = sha("".join(others[:at] + [folded] + others[at:]))
            want.append((i if known else None, leaf, subroot, root, sha("".join(x for _, others in way + above for x in others)), folded, folded == root))
    store = Store(spark)
    got = [tuple(r) for r in merkle.manifest(docs, merkle.tampered(docs), store, levels).collect()]
    order = lambda r: (str(r[0]), *r[1:6])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert 0 < sum(r[-1] for r in got) < len(got)
    some = spark.createDataFrame([(1, "a", "en", "s", 1)], DOCS)
    alone = merkle.manifest(some, F.col("text"), store, levels).collect()
    assert len(alone) == 1 and alone[0].leaf == alone[0].subroot == alone[0].root == alone[0].folded_root and alone[0].proof_sha256 == sha("")
    assert merkle.manifest(some.where("false"), F.col("text"), store, levels).collect() == []


def test_mixing(spark, docs):
    rows = corpus()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    names = sorted(sizes, key=lambda s: (s is None, (s or "")))
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    for share in (0.3, 1.5):
        full, budget = set(), share * sum(sizes.values())
        while True:
            rest = budget - sum(2 * sizes[s] for s in full)
            targets = {s: 2 * sizes[s] if s in full else rest * weights[s] / sum(weights[x] for x in names if x not in full) for s in names}
            over = {s for s in names if s not in full and targets[s] > 2 * sizes[s]}
            if not over:
                break
            full |= over
        out = mixing.mix_sources(docs, Store(spark), share=share)
        got = out.collect()
        assert sorted((str(r.doc_id), str(r.source), r.size) for r in got) == sorted((str(r[0]), str(r[3]), size(r[1])) for r in rows)
        taken = defaultdict(int)
        for r in got:
            assert r.source_size == sizes[r.source] and r.target == pytest.approx(targets[r.source])
            assert r.taken == r.repeats * r.size and 0 <= r.repeats <= 2
            taken[r.source] += r.taken
        for s in names:
            largest = max(size(r[1]) for r in rows if r[3] == s)
            assert abs(taken[s] - targets[s]) <= largest / 2 + 1
        assert sum(targets.values()) == pytest.approx(budget)
        again = mixing.mix_sources(docs.repartition(3), Store(spark), share=share).collect()
        key = lambda r: (str(r.doc_id), str(r.source), r.size, r.taken)
        assert sorted(map(key, got)) == sorted(map(key, again))
    assert mixing.mix_sources(docs.where("false"), Store(spark)).collect() == []
    wordless = mixing.mix_sources(docs.where("text is null or text = ''"), Store(spark)).collect()
    assert wordless and all((r.target, r.taken) == (0, 0) for r in wordless)


def cheapest(turns):
    """(cost, audit) by Dijkstra's search over prefixes and the grammar's states."""
    heap, done, after = [(0, "", 0, 0)], set(), {0: "su", 1: "u", 2: "a", 3: "u"}
    place = {"s": 1, "u": 2, "a": 3}
    while True:
        cost, audit, i, state = heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(turns) and state in (0, 3):
            return cost, audit
        for x in after[state]:
            if x != "s":
                heappush(heap, (cost + 2, audit + "I", i, place[x]))
            if i < len(turns) and turns[i] != "d":
                extra = turns[i].isupper()
                if turns[i].lower() == x:
                    heappush(heap, (cost + extra, audit + "K", i + 1, place[x]))
                elif x != "s":
                    heappush(heap, (cost + 2 + extra, audit + "R", i + 1, place[x]))
        if i < len(turns):
            heappush(heap, (cost + 3, audit + "D", i + 1, state))


def test_alignment():
    rng = random.Random(2)
    cases = ["".join(x) for n in range(4) for x in itertools.product("dsuaxSUA", repeat=n)]
    cases += ["".join(rng.choices("dsuaxSUAX", k=rng.randint(4, 9))) for _ in range(500)]
    cases += ["".join(rng.choices("uaUAdsx", [5, 5, 1, 1, 2, 1, 1], k=rng.randint(30, 90))) for _ in range(20)]
    cases += ["s" * 30 + "a" * 30, "d" * 40, "x" * 25 + "ua" * 20, "ua" * 40 + "u"]
    for turns in cases:
        assert conversation_repair.align(turns) == conversation_repair.align(turns, long=-1) == cheapest(turns), turns


def conversations():
    rng = random.Random(9)
    rows = []
    for c in [None, *range(120)]:
        for t in range(rng.choice([1, 2, 3, 4, 7, 12])):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ("user", "assistant")[t % 2]
            role = "system" if t == 0 and rng.random() < 0.4 else rng.choice([role, role, role, role, None, "", "tool"])
            text = rng.choice(["Yes.", "Is it?", "and so", " \t\n", None, "long " * 300 + "end. \n", f"turn {c} {t}!", "é.", " "])
            rows.append((c, rng.choice([t, t, t, t, t + 3, None]), role, text))
    return rows + rows[:9]


def repaired(rows):
    convs = defaultdict(list)
    for c, t, role, text in rows:
        blank = lambda x: " " if x is None else x
        kind = zlib.crc32(f"{blank(c)}:{blank(t)}".encode()) % 20
        role, text = blank(role), blank(text)
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[c] += [(t, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    for c, turns in convs.items():
        turns.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.sha256(x[2].encode()).digest()))
        seen, faults, letters = set(), [], ""
        for _, role, text in turns:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            faults.append(fault)
            letter = role[:1] if role[:1] in ("s", "u", "a") else "x"
            letters += "d" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        cost, audit = cheapest(letters)
        known = [t for t, *_ in turns if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        out, left = [], list(turns)
        for x in audit:
            role, text = ("", "") if x == "I" else left.pop(0)[1:]
            if x != "D":
                role = role if x == "K" else "assistant" if out and out[-1].startswith("u") else "user"
                out.append(f"{role}:{text}")
        yield c, max(known) - min(known) + 1 - len(set(known)) if known else 0, *map(faults.count, ("blank", "duplicate", "truncated")), illegal, cost, audit, sha("\n".join(out))


def test_repair(spark):
    rows = conversations()
    given = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit(1) for c in CLASHING}).repartition(6)
    want = {r[0]: r for r in repaired(rows)}
    assert any(r[7] == "" for r in want.values()) and {"D", "I", "K", "R"} <= set("".join(r[7] for r in want.values()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # conversations go on in the next batch
    try:
        got = conversation_repair.repair(conversation_repair.damaged(given)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(want) and {r.conv_id: tuple(r) for r in got} == want
    assert conversation_repair.repair(conversation_repair.damaged(given.where("false"))).collect() == []
