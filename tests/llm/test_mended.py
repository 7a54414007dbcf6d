"""Inputs that earlier versions lost or mistook: items without spaces, repetitive texts, texts that begin with a cut item, colliding words."""

import random
import resource

import numpy as np
import pyarrow as pa
import pytest

from lexspark.llm import _text as tx
from lexspark.llm import jaccard_join, sentencepiece
from lexspark.llm.decontaminate import Items, _joined


def found(items, texts):
    data, offsets = tx.utf8(pa.array(texts))
    return {(r, i) for r, i, *_ in items.matches(data, offsets)}


def test_items_without_spaces():
    japanese = "吾輩は猫である。名前はまだ無い。どこで生れたかとんと見当がつかぬ。" * 4
    code = "for(int_i=0;i<n;i++){sum+=a[i]*b[i];}return_sum/(double)n;" * 3
    texts = ["前書き" + japanese + "後書き", "x=1;" + code + "//end", "何も無い文" * 30, japanese[:40]]
    assert found(Items([1, 2, 3], [japanese, code, "ab cd"]), texts) == {(0, 0), (1, 1)}


def test_repetitive_text_in_bounded_memory():
    items = Items([1, 2], ["fill in the form " + "_" * 600, "a quite plain item of some words here"])
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    assert found(items, ["_" * 400_000, "x fill in the form " + "_" * 600 + " y", "_ _ " * 5000]) >= {(1, 0)}
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 300_000


@pytest.mark.parametrize("cut", ["front", "back"])
def test_items_cut_at_the_edge_of_a_text(cut):
    rng = random.Random(3)
    words = lambda n: " ".join("".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8))) for _ in range(n))
    texts = [words(rng.randint(15, 40)) for _ in range(120)]
    items = Items(list(range(len(texts))), texts)
    lose = lambda t: int(0.09 * len(t.encode()))
    docs = [t[lose(t) :] + " " + words(30) if cut == "front" else words(30) + " " + t[: -lose(t)] for t in texts]
    docs += [t[lose(t) :] if cut == "front" else t[: -lose(t)] for t in texts]
    got = found(items, docs)
    assert sum((r, r % len(texts)) in got for r in range(len(docs))) >= 0.99 * len(docs)


def test_joined_ranges():
    rng = random.Random(4)
    for _ in range(50):
        rows = []
        for _ in range(rng.randint(1, 30)):
            low = rng.randint(-20, 60)
            rows.append((rng.randint(0, 2), rng.randint(0, 2), low, low + rng.randint(0, 12)))
        cover = {(i, r, x) for i, r, lo, hi in rows for x in range(lo, hi + 1)}
        got = [tuple(x) for x in _joined(np.array(rows)).tolist()]
        assert {(i, r, x) for i, r, lo, hi in got for x in range(lo, hi + 1)} == cover
        assert all(not (a[:2] == b[:2] and a[2] <= b[3] and b[2] <= a[3]) for k, a in enumerate(got) for b in got[:k])


def old_block(state, block):
    return tx.mix((state ^ block) * np.uint64(0xD6E8FEB86659FD93))


@pytest.mark.parametrize("lane", [0, 1])
def test_second_block_cannot_cancel_the_first(lane):
    """Pairs of sixteen bytes that an invertible mixing of blocks gives one hash: state ^ block is the same after the first block."""
    size, rng, pairs = np.uint64(16), random.Random(6), []
    state = tx.mix(np.array([size * np.uint64(0xD6E8FEB86659FD93)]) ^ tx.LANES[lane])
    for _ in range(200):
        a, b = (np.frombuffer(rng.randbytes(8), "<u8") for _ in range(2))
        x = np.frombuffer(rng.randbytes(8), "<u8")
        y = x ^ old_block(state, a) ^ old_block(state, b)
        pairs.append((a.tobytes() + x.tobytes(), b.tobytes() + y.tobytes()))
    flat = b"".join(x for p in pairs for x in p)
    start = np.arange(0, len(flat), 16)
    h = tx.span_hashes(np.frombuffer(flat, np.uint8), start, start + 16, 2)[lane]
    assert len(set(h.tolist())) == len({x for p in pairs for x in p})


def test_words_that_collided(spark):
    x, y = "tzio6ke8gm6hmwpf", "w0xideykqq9ytojs"
    df = spark.createDataFrame([(1, x), (2, y)], "doc_id bigint, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard_join.jaccard_components(df, 3, 90).collect()} == {(1, 1), (2, 2)}


def test_long_words_are_not_remembered():
    model = sentencepiece.read_model()
    encoder, _ = sentencepiece.codec(model)
    rng = random.Random(1)
    for _ in range(20):
        encoder.encode(["".join(rng.choices("abcdefgh0123456789", k=2000)) for _ in range(10)])
    assert max(map(len, encoder.words), default=0) <= sentencepiece.LONGEST_REMEMBERED
