import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from lexspark.llm import _text as tx
from lexspark.llm.decontaminate import EDIT_SHARE, Items, edit_occurrence


def plain(item: bytes, text: bytes) -> int:
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)


def test_edit_occurrence_is_exact():
    rng = random.Random(1)
    for _ in range(400):
        a, b = (bytes(rng.choices(b"abc ", k=rng.randint(1, n))) for n in (20, 40))
        assert edit_occurrence(a, b)[0] == plain(a, b)


def words(rng, n):
    return " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 8))) for _ in range(n))


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        i = rng.randrange(len(out))
        what = rng.random()
        if what < 0.4:
            out[i] = rng.choice("etaoinshrdlu")
        elif what < 0.7:
            del out[i]
        else:
            out.insert(i, rng.choice("etaoinshrdlu"))
    return "".join(out)


def test_recall_at_the_edit_limit_and_no_false_alarm():
    rng = random.Random(2)
    texts = [words(rng, rng.randint(18, 60)) for _ in range(60)]
    items = Items(list(range(60)), texts)
    docs, want = [], []
    for i, t in enumerate(texts):
        for share in (0.0, 0.03, 0.06):
            docs.append(words(rng, 80) + "\n" + edited(rng, t, int(share * len(t))) + " " + words(rng, 40))
            want.append(i)
    docs += [words(rng, 150) for _ in range(100)]
    data, offsets = tx.utf8(pa.array(docs))
    got = items.matches(data, offsets)
    found = {(r, i) for r, i, *_ in got}
    assert sum((r, i) in found for r, i in enumerate(want)) >= 0.97 * len(want)
    assert not [r for r, _ in found if r >= len(want)]
    for r, i, distance, start, end in got:
        assert plain(items.raw[i], docs[r].encode().lower()[start:end].replace(b"\n", b" ")) == distance <= EDIT_SHARE * len(texts[i])


def changed(rng, raw, places):
    out = bytearray(raw)
    for i in sorted(places, reverse=True):
        what = rng.random()
        if what < 0.4:
            out[i] = rng.choice(b"etaoinshrdlu")
        elif what < 0.7:
            del out[i]
        else:
            out.insert(i, rng.choice(b"etaoinshrdlu"))
    return bytes(out)


@pytest.mark.parametrize("how", ["random", "even", "every third word"])
def test_nothing_within_the_limit_is_lost_on_the_benchmark(how):
    rng = random.Random(4)
    texts = pq.read_table("/root/testdata/sf0.1/benchmark.parquet").column("text").to_pylist()
    items = Items(list(range(len(texts))), texts)
    docs, want = [], set()
    for i, raw in enumerate(items.raw):
        n = int(EDIT_SHARE * len(raw))
        if how == "random":
            text = changed(rng, raw, [rng.randrange(len(raw)) for _ in range(n)])
        elif how == "even":
            text = changed(rng, raw, [int((j + rng.random() / 2) * len(raw) / n) for j in range(n)])
        else:
            text = b" ".join(b"q" + w[1:] if k % 3 == 0 and w else w for k, w in enumerate(raw.split(b" ")))
        docs.append(words(rng, 30).encode() + b" " + text + b" " + words(rng, 20).encode())
        if edit_occurrence(raw, docs[-1])[0] <= n:
            want.add((i, i))
    data, offsets = np.frombuffer(b"".join(docs), np.uint8), np.cumsum([0, *map(len, docs)])
    assert len(want) >= 0.9 * len(texts)
    assert want <= {(r, i) for r, i, *_ in items.matches(data, offsets)}


def test_empty_sides():
    data, offsets = tx.utf8(pa.array(["", None, "a b c d"], pa.string()))
    assert Items([1], ["x y"]).matches(data, offsets) == []
    assert np.array_equal(offsets, [0, 0, 0, 7])
