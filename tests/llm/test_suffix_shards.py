"""Anchors whose contexts fill several shards give the same result as in one."""

import random

import numpy as np
import pyarrow as pa

from lexspark.llm import _text as tx
from lexspark.llm import suffix_dedup as S


def sent_rows():
    rng = random.Random(3)
    passage = "".join(rng.choices("abcdefgh ", k=90))
    texts = ["".join(rng.choices("abcdefgh ", k=rng.randint(0, 40))) + passage[rng.randint(0, 30) : rng.randint(60, 90)] + "".join(rng.choices("xyz", k=rng.randint(0, 60))) for _ in range(300)]
    data, offsets = tx.utf8(pa.array(texts))
    place, _ = S.anchors(data, offsets)
    row = np.searchsorted(offsets, place, "right") - 1
    lists = [(((place[row == r] - offsets[r]) << 32) + 1).tolist() for r in range(len(texts))]
    batch = pa.record_batch({"id": np.arange(len(texts)), "tie": np.zeros(len(texts), np.int64), "text": pa.array(texts), "places": pa.array(lists, pa.list_(pa.int64()))})
    # One document in each batch: nothing is settled in the task.
    parts = pa.Table.from_batches([b for k in range(len(texts)) for b in S._settle([batch.slice(k, 1)])])
    return texts, parts.sort_by([("key", "ascending"), ("body", "ascending")])


def covered(texts, batches):
    out, left = [np.zeros(len(t), bool) for t in texts], {}
    for b in batches:
        for d, s, e, w in zip(*(b.column(k).to_pylist() for k in ("id", "start", "end", "window")), strict=True):
            if w is None:
                out[d][s:e] = True
            else:
                assert texts[d][s:e].encode() == w
                left.setdefault(w, []).append((d, s, e))
    for same in left.values():
        for d, s, e in same:
            out[d][s:e] |= d > min(same)[0]
    return out


def test_shards_are_merged(monkeypatch):
    texts, table = sent_rows()
    seen, want = set(), []
    for t in texts:
        gone, new = np.zeros(len(t), bool), set()
        for k in range(len(t) - S.WINDOW + 1):
            w = t[k : k + S.WINDOW]
            new.add(w)
            if w in seen:
                gone[k : k + S.WINDOW] = True
        seen |= new
        want.append(gone)
    assert sum(map(np.sum, want))
    for rows, most in ((S.SHARD_ROWS, S.CARRIED), (37, S.CARRIED), (5, S.CARRIED), (5, 100), (5, 1)):
        monkeypatch.setattr(S, "SHARD_ROWS", rows)
        monkeypatch.setattr(S, "CARRIED", most)
        got = covered(texts, S._cover(table.to_batches(max_chunksize=64)))
        assert all((g == w).all() for g, w in zip(got, want, strict=True)), rows


def test_suffix_ranks_order_prefixes():
    rng = random.Random(1)
    text = np.frombuffer("".join(rng.choices("ab", k=500)).encode(), np.uint8)
    rank, h = S.suffix_ranks(text, 40)
    cut = lambda i: (text.tobytes() + b"\0" * 64)[i : i + h]
    order = sorted(range(500), key=lambda i: rank[i])
    assert all(cut(a) <= cut(b) for a, b in zip(order, order[1:], strict=False))
    assert len({int(r) for r in rank[:500]}) == len({cut(i) for i in range(500)})
