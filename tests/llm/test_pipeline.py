"""The pipeline's stages, each on its own input, against brute force."""

import random
import re

import pytest

import corpus_pipeline
from lexspark.llm.pii import find_spans, redact
from lexspark.llm.sentencepiece import Decoder, Model, read_model

BAD = ["vile", "scumm", "trashy"]


def corpus():
    rng = random.Random(5)
    stock = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 7))) for _ in range(500)]
    say = lambda n: " ".join(rng.choices(stock, k=n))
    items = [(i, say(30)) for i in range(5)]
    rows, toxic = [], set()
    for i in range(900):
        words = say(rng.randint(8, 80)).split(" ")
        if rng.random() < 0.15:
            toxic.add(i)
            words[rng.randrange(len(words))] = rng.choice(BAD)
            words[rng.randrange(len(words))] = rng.choice(BAD)
        rows.append([i, " ".join(words)])
    clean = [i for i in range(900) if i not in toxic]
    for k in range(40):  # near copies: one word added
        rows.append([1000 + k, rows[clean[k]][1] + " " + rng.choice(stock)])
    for k in range(10):
        rows.append([2000 + k, say(20) + " " + items[k % 5][1] + " " + say(10)])
    rows += [[3000, "mail me: a.b@c.org or +49 30 1234567"], [3001, None], [3002, ""], [3003, rows[clean[3]][1]]]
    return rows, toxic, items


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("tables"))
    rows, toxic, items = corpus()
    spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i in toxic)) for i in range(700)], "doc_id bigint, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def test_stages(spark, folder):
    rows, toxic, items = corpus()
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        kept[name] = {r.doc_id: r.text for r in docs.collect()}
    first = kept["toxicity"]
    assert len(toxic & first.keys()) <= 0.05 * len(toxic) and len([i for i, _ in rows if i not in toxic and i not in first]) <= 5
    sets = {i: shingles(t) for i, t in first.items()}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert kept["near_copies"] == {i: t for i, t in first.items() if find(i) == i}
    assert kept["decontamination"] == {i: t for i, t in kept["near_copies"].items() if not any(item in (t or "") for _, item in items)}
    assert kept["personal_data"] == {i: t if t is None else redact(t, find_spans(t)) for i, t in kept["decontamination"].items()}
    assert "[EMAIL]" in kept["personal_data"][3000]
    back = Decoder(Model(read_model()))
    last = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    import numpy as np

    assert {r.doc_id: back.decode(np.array(r.ids, np.int32).tobytes()) for r in last} == {i: t or "" for i, t in kept["personal_data"].items()}


def test_run_applies_all_stages(spark, folder):
    out = corpus_pipeline.run(spark, folder)
    assert out.columns[0] == "doc_id" and 800 > out.count() > 500 and out.where("not round_trip").count() == 0
