"""Each operator against a brute-force version on a small corpus with copies, near copies, shared passages and odd rows."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexspark.llm import decontaminate, fingerprint, jaccard_join, lm_score, pii, sentencepiece, substring_dedup, suffix_dedup, toxicity, url_filter

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def corpus():
    rng = random.Random(11)
    letters = "etaoinshrdlué"
    stock = ["".join(rng.choices(letters, k=rng.randint(1, 7))) for _ in range(300)]
    say = lambda n: " ".join(rng.choices(stock, k=n))
    line, passage = say(14), say(55)
    texts = [None, "", " \n\t", "one", "two words", "Two WORDS", "three short words", "a" * 120, "ha " * 60, "x\u2028y z", "é" * 60]
    base = say(150)
    for _ in range(40):  # near copies
        words = base.split(" ")
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(len(words))] = rng.choice(stock) + "q"
        texts.append(" ".join(words))
    texts += [base] * 12 + [say(30).upper()] * 3
    texts += [line + "\n" + say(rng.randint(1, 60)) + "\n" + line for _ in range(20)]
    texts += [say(20) + " " + passage + " " + say(25) for _ in range(10)]
    texts += [say(rng.randint(1, 200)) for _ in range(60)] + [say(6000)]
    rng.shuffle(texts)
    return [(3 * i - 20, t, "en", "src1", len(t or "")) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def rows():
    return corpus()


@pytest.fixture(scope="module")
def docs(spark, rows):
    # Columns with the names of the operators' own intermediates.
    return spark.createDataFrame(rows, SCHEMA).withColumns({"places": F.lit(1), "key": F.lit("k"), "n": F.lit(2), "component_id": F.lit(3)}).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_jaccard(docs, rows, empty):
    for words, percent in ((3, 90), (5, 80)):
        sets = {}
        for i, t, *_ in rows:
            w = split((t or "").translate(LOWER))
            sets[i] = {tuple(w)} if 0 < len(w) < words else {tuple(w[k : k + words]) for k in range(len(w) - words + 1)}
        parent = {i: i for i in sets}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        ids = sorted(sets)
        for a in ids:
            for b in ids:
                if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, words, percent).collect()}
        assert got == {i: (len(s), find(i)) for i, s in sets.items()}
    assert jaccard_join.jaccard_components(empty).count() == 0


def test_jaccard_at_any_percent(spark):
    """Low thresholds too, where sizes differ by several doublings, and hot n-grams of sets that are alike by half."""
    rng = random.Random(4)
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    base = [word() for _ in range(400)]
    texts = [" ".join(base[: rng.randint(4, 400)]) for _ in range(25)] + [" ".join(base[:5] + [word() for _ in range(rng.randint(1, 30))]) for _ in range(40)]
    texts += [" ".join(rng.sample(base, 30)) for _ in range(10)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    sets = {i: {tuple(t.split()[k : k + 2]) for k in range(len(t.split()) - 1)} for i, t in rows}
    for percent in (1, 12, 30, 55, 100):
        parent = {i: i for i in sets}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a in sets:
            for b in sets:
                if a < b and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    x, y = sorted((find(a), find(b)))
                    parent[y] = x
        got = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(df, 2, percent).collect()}
        assert got == {i: find(i) for i in sets}, percent


def test_suffix_dedup(docs, rows, empty):
    size, seen, want = 50, set(), {}
    for i, t, *_ in sorted(rows):
        b = (t or "").encode()
        gone, new = [False] * len(b), set()
        for k in range(len(b) - size + 1):
            new.add(b[k : k + size])
            if b[k : k + size] in seen:
                gone[k : k + size] = [True] * size
        seen |= new
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        want[i] = (len(b), sum(gone), spans, bytes(c for c, g in zip(b, gone, strict=True) if not g))
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(docs).collect()}
    assert got == want and any(w[1] for w in want.values())
    assert suffix_dedup.remove_repeated_bytes(empty).count() == 0


def test_substring_dedup(docs, rows, empty):
    size, seen, want = 20, set(), {}
    for i, t, *_ in sorted(rows):
        w = split(t)
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if tuple(w[k : k + size]) in seen:
                gone[k : k + size] = [True] * size
            seen.add(tuple(w[k : k + size]))
        want[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.remove_repeats(docs).collect()}
    assert got == want and any(w[1] for w in want.values())
    assert substring_dedup.remove_repeats(empty).count() == 0


def test_repeated_and_null_rows_survive(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text), (None, None)], "doc_id bigint, text string")
    for op in (substring_dedup.remove_repeats, suffix_dedup.remove_repeated_bytes):
        out = sorted((r.doc_id if r.doc_id is not None else -1, r.n_removed > 0) for r in op(df).collect())
        assert out == [(-1, False), (-1, False), (1, True), (1, True), (2, True)]
    assert jaccard_join.jaccard_components(df).count() == 5
    assert lm_score.score_documents(df).count() == 5
    assert pii.redact_documents(df).count() == 5


def test_rows_that_share_a_doc_id(spark):
    """Different texts under one doc_id, or under none, of different length: each is judged by its own text."""
    a, b, c = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("a", 60), ("b", 90), ("c", 40)))
    rows = [(None, a), (None, a + " tail " + b), (None, b), (None, "short"), (5, a), (5, c), (5, c), (7, c + " " + b), (7, "x y")]
    for parts in (1, 4):
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        words = {(r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect()}
        assert words == {(None, 60, 0), (None, 151, 0), (None, 90, 0), (None, 1, 0), (5, 60, 60), (5, 40, 0), (7, 130, 130), (7, 2, 0)}
        size = len
        kept = {(r.doc_id, r.n_bytes): r.n_removed for r in suffix_dedup.remove_repeated_bytes(df).collect()}
        assert kept[5, size(a)] == size(a) and kept[5, size(c)] == 0 and kept[None, size(a + b) + 6] == 0 and kept[7, size(c + b) + 1] >= size(c + b)


def thue_morse(n, flip):
    out = [0]
    while len(out) < n:
        out += [1 - x for x in out]
    return "".join("ab"[x ^ flip] for x in out)


def test_words_of_equal_polynomial_hash_differ(spark):
    """The two Thue-Morse words collide under a polynomial hash modulo a power of two, whatever its base."""
    x, y = thue_morse(1024, 0), thue_morse(1024, 1)
    line = " ".join(f"w{i}" for i in range(19))
    df = spark.createDataFrame([(1, f"{line} {x}"), (2, f"{line} {y}")], "doc_id bigint, text string")
    assert [r.n_removed for r in substring_dedup.remove_repeats(df).collect()] == [0, 0]
    assert {r.n_shingles for r in jaccard_join.jaccard_components(spark.createDataFrame([(1, f"{x} {y} {x}"), (2, f"{x} {x} {y}")], "doc_id bigint, text string"), 3, 90).where("component_id = doc_id").collect()} == {1}


def test_one_very_long_text(spark):
    """Ten megabytes in one row, half of it in another document."""
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(1_250_000))
    df = spark.createDataFrame([(1, text[: len(text) // 2]), (2, text)], "doc_id bigint, text string")
    got = {r.doc_id: r.n_removed for r in suffix_dedup.remove_repeated_bytes(df).select("doc_id", "n_removed").collect()}
    assert got == {1: 0, 2: len(text) // 2}
    got = {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df).select("doc_id", "n_removed").collect()}
    assert got[1] == 0 and abs(got[2] - 625_000) <= 1


def test_rows_of_one_document_are_no_earlier_copy(spark):
    text, twice = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i % 30}" for i in range(60))
    rows = [(1, text), (2, twice)] * 2
    for parts in (1, 4):  # the repeats in one task, and in several
        df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(parts)
        out = sorted((r.doc_id, r.n_words, r.n_removed) for r in substring_dedup.remove_repeats(df).collect())
        assert out == [(1, 60, 0)] * 2 + [(2, 60, 30)] * 2


def test_fingerprint(docs, rows, empty):
    pairs = fingerprint.edited_pairs(docs, 8).where("real").collect()
    order = sorted(rows, key=lambda r: -r[0])
    nxt = {r[0]: (order[(k + 1) % len(order)][1] or "") for k, r in enumerate(order)}
    for r in pairs:
        half = len(r.text) // 2
        assert r.edited == r.text[: len(r.text) - half] + nxt[r.doc_id][:half]
    assert len(pairs) == len(rows)
    prints = {r.doc_id: r.fingerprint for r in fingerprint.fingerprint(docs, ["doc_id"]).collect()}
    by_text = {}
    for i, t, *_ in rows:
        by_text.setdefault(t or "", set()).add(prints[i])
    assert all(len(v) == 1 for v in by_text.values()) and len({p for v in by_text.values() for p in v}) == len(by_text)
    assert fingerprint.edited_pairs(empty, 8).where("real").count() == 0


def test_likeness(spark, tmp_path):
    """Near one for mostly equal paragraphs, near zero for none, against the exact cosine of the paragraph multisets."""
    rng = random.Random(8)
    pool = [f"line {i} of {rng.random()}." for i in range(400)]
    texts = ["\n".join(rng.sample(pool, 120)) for _ in range(30)]
    texts += ["\n".join([*t.split("\n")[: 120 - k], *rng.sample(pool, k)]) for k, t in zip((0, 1, 5, 12, 30, 60, 90, 110), texts, strict=False)]
    order = [t for pair in zip(texts, texts[::-1], strict=True) for t in pair] + texts[:8] + texts[30:]
    spark.createDataFrame(list(enumerate(order)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    cosine = lambda a, b: sum(a[k] * b[k] for k in a) / math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
    count = lambda t: Counter(re.split(fingerprint.PARAGRAPH, t))
    off = []
    for r in fingerprint.op3_fingerprint(spark, str(tmp_path)).collect():
        own, nxt = order[r.doc_id], order[(r.doc_id - 1) % len(order)]
        edited = own[: len(own) - len(own) // 2] + nxt[: len(own) // 2]
        off += [abs(r.near_edited - cosine(count(own), count(edited))), abs(r.near_next - cosine(count(own), count(nxt)))]
        assert (r.near_next == 1.0) == (own == nxt) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    # 64 lanes: the estimate's standard deviation is about 1/8.
    assert sum(off) / len(off) < 0.12 and max(off) < 0.5


def test_fingerprint_is_a_multiset_hash(spark):
    df = spark.createDataFrame([(1, "a b.\nc d.\ne"), (2, "e\na b.\nc d."), (3, "a b.\nc d."), (4, "e"), (5, "a b.\na b.\nc d.\ne")], "doc_id bigint, text string")
    out = {r.doc_id: r for r in fingerprint.fingerprint(df, ["doc_id"]).withColumn("x", F.col("exact")).collect()}
    assert out[1].exact == out[2].exact != out[5].exact
    both = spark.createDataFrame([(out[3].exact, out[4].exact, out[1].exact)], "x array<bigint>, y array<bigint>, z array<bigint>")
    r = both.select(fingerprint.combine(F.col("x"), F.col("y")).alias("sum"), fingerprint.combine(F.col("z"), F.col("y"), -1).alias("less")).first()
    assert r["sum"] == out[1].exact and r["less"] == out[3].exact


def test_lm_score(docs, rows, empty):
    tokens = {i: [*split((t or "").translate(LOWER)), "\n"] for i, t, *_ in rows}
    out_of = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(w for i, ws in tokens.items() if not out_of[i] for w in ws)
    total, kinds = sum(counts.values()), len(counts)
    for common in (lm_score.COMMON_WORDS, 20):
        keep, lm_score.COMMON_WORDS = lm_score.COMMON_WORDS, common
        try:
            got = lm_score.score_documents(docs).collect()
        finally:
            lm_score.COMMON_WORDS = keep
        for r in got:
            base = sum(math.log10((counts[w] + 1) / (total + 1 * (kinds + 1))) for w in tokens[r.doc_id])
            assert (r.held_out, r.n_tokens, r.train_tokens) == (out_of[r.doc_id], len(tokens[r.doc_id]), total)
            assert r.n_known == sum(counts[w] > 0 for w in tokens[r.doc_id])
            assert math.isclose(r.base_score, base, rel_tol=1e-9)
            assert r.score < 0
        assert len(got) == len(rows)
    train = [r for r in got if not r.held_out]
    assert sum(r.score for r in train) > sum(r.base_score for r in train)
    assert lm_score.score_documents(empty).count() == 0


def test_lm_score_against_exact_levels(docs, rows):
    """The score from exact counts, quantised as the filter does; a false yes of the filter can only move a few tokens. Next words add up to one at most."""
    tokens = {i: [*split((t or "").translate(LOWER)), "\n"] for i, t, *_ in rows}
    train = [ws for i, ws in tokens.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    ones, twos = Counter(w for ws in train for w in ws), Counter(p for ws in train for p in zip(["\n", *ws], ws))
    level = int.bit_length
    middle = lambda w: 1.5 * 2 ** (level(ones[w]) - 1) - 0.5 if ones[w] else 0
    known = list(ones)
    mass = sum(map(middle, known))

    def probability(v, w):
        alone = (middle(w) + 1) / (mass + len(known) + 1)
        pair, most = (2 ** (level(twos[v, w]) - 1) if twos[v, w] else 0), 2 ** level(ones[v]) - 1
        return lm_score.BIGRAM_WEIGHT * min(pair / most, 1) + (1 - lm_score.BIGRAM_WEIGHT) * alone if most else alone

    for v in [*random.Random(3).sample(known, 40), "\n", "never seen"]:
        assert sum(probability(v, w) for w in [*known, "never seen either"]) <= 1 + 1e-9
    assert sum(probability("never seen", w) for w in [*known, "never seen either"]) > 1 - 1e-9

    def score(ws):
        return sum(math.log10(probability(v, w)) for v, w in zip(["\n", *ws], ws))

    got = {r.doc_id: r.score for r in lm_score.score_documents(docs).collect()}
    apart = {i: abs(got[i] - score(ws)) / len(ws) for i, ws in tokens.items()}
    assert sum(x < 1e-9 for x in apart.values()) > 0.5 * len(apart) and max(apart.values()) < 0.1


def test_lm_score_counts_come_from_the_filter(docs):
    """The same score however many exact counts are broadcast."""
    got = []
    for common in (lm_score.COMMON_WORDS, 20):
        keep, lm_score.COMMON_WORDS = lm_score.COMMON_WORDS, common
        try:
            got.append(sorted((r.doc_id, r.score) for r in lm_score.score_documents(docs).collect()))
        finally:
            lm_score.COMMON_WORDS = keep
    assert all(a[0] == b[0] and math.isclose(a[1], b[1]) for a, b in zip(*got, strict=True))


def test_lm_score_is_the_same_with_blocks_as_rows(docs, empty, monkeypatch):
    want = sorted(tuple(r) for r in lm_score.score_documents(docs).collect())
    monkeypatch.setattr(lm_score, "BROADCAST_BYTES", 0)
    got = sorted(tuple(r) for r in lm_score.score_documents(docs).collect())
    assert len(got) == len(want)
    assert all(g[:5] == w[:5] and math.isclose(g[5], w[5]) and math.isclose(g[6], w[6]) for g, w in zip(got, want, strict=True))
    assert lm_score.score_documents(empty).count() == 0


def test_lm_filter_grows_with_its_entries(spark):
    """Past 64 MB too. Ninety million entries: one and a half million n-grams of level 60."""
    ngrams = spark.range(1_500_000).select(F.lit(1).cast("tinyint").alias("kind"), F.xxhash64("id").alias("key"), F.expr("1L << 59").alias("n"))
    _, words, bits = lm_score.filter_blocks(ngrams)
    assert (words << bits) * 64 >= 7.5 * 90_000_000 and words <= lm_score.BLOCK_WORDS


def test_count_filter_recovers_levels():
    import numpy as np

    from lexspark.llm._text import mix

    keys = mix(np.arange(1, 20_001, dtype=np.uint64))
    counts = np.random.default_rng(1).zipf(1.6, 20_000).clip(1, 10**6)
    q = lm_score.levels(counts)
    words = 1 << int(np.ceil(np.log2(q.sum() * 10 / 64 / lm_score.BLOCKS)))
    f = lm_score.CountFilter(np.zeros((lm_score.BLOCKS, words), np.uint64), 8)
    for k in range(1, int(q.max()) + 1):
        block, bits = lm_score.place(keys[q >= k], k, words, 8)
        for b in bits:
            np.bitwise_or.at(f.words, (block, (b >> np.uint64(6)).astype(int)), np.uint64(1) << (b & np.uint64(63)))
    got = f.level(keys)
    assert (got >= q).all() and (got == q).mean() > 0.95
    assert (f.level(mix(np.arange(10**6, 10**6 + 20_000, dtype=np.uint64))) > 0).mean() < 0.06


def toxic_rows(n, seed):
    rng = random.Random(seed)
    stock = [f"w{i}" for i in range(400)]
    bad = ["vile", "scumm", "trashy", "ébad"]
    out = []
    for i in range(n):
        toxic = rng.random() < 0.15
        words = rng.choices(stock, k=rng.randint(5, 120)) + (rng.choices(bad, k=rng.randint(1, 3)) if toxic else [])
        rng.shuffle(words)
        out.append((seed * 100_000 + i, " ".join(words), 0 if toxic and rng.random() < 0.5 else 1, int(toxic)))
    return out


def test_toxicity_on_held_out_rows(spark, empty):
    train, test = toxic_rows(3000, 1), toxic_rows(1000, 2)
    both = spark.createDataFrame([r[:2] for r in train + test], "doc_id bigint, text string").unionByName(spark.createDataFrame([(7, None), (8, "")], "doc_id bigint, text string"))
    labels = spark.createDataFrame([(r[0], r[2], r[3]) for r in train], "doc_id bigint, quality int, toxic int")
    chain = toxicity.fit_chain(both, labels)
    got = {r.doc_id: r.p_toxic for r in toxicity.score_chain(both, chain).collect()}
    hits = sum((got[r[0]] >= 0.5) == bool(r[3]) for r in test)
    assert hits >= 0.97 * len(test) and sum(got[r[0]] >= 0.5 and not r[3] for r in test) <= 5
    assert got[7] < 0.5 and got[8] < 0.5
    assert len(chain.models) == 2 and len(chain.models[1][2]) == 1
    none = toxicity.fit_chain(both, labels.limit(0))
    assert toxicity.score_chain(both, none).where("p_toxic > 0.5").count() == 0
    assert toxicity.score_chain(empty, chain).count() == 0


def test_decontamination(spark, docs, rows, empty):
    text = next(t for _, t, *_ in rows if t and len(t.split()) > 5000)
    item = " ".join(text.split()[1000:1030])
    benchmark = spark.createDataFrame([(1, item), (2, item.upper()), (3, None), (4, ""), (5, "zz yy xx ww vv uu tt ss rr qq")], "item_id bigint, text string")
    found = decontaminate.benchmark_matches(docs, benchmark).collect()
    want = [i for i, t, *_ in rows if item in (t or "")]
    assert sorted({r.doc_id for r in found}) == want and {r.item_id for r in found} == {1, 2}
    assert decontaminate.remove_contaminated(docs, benchmark).count() == len(rows) - len(want)
    odd = spark.createDataFrame([(None, "clean text of no interest"), (None, "before " + item + " after"), (4, item), (4, "clean"), (5, None)], "doc_id bigint, text string")
    kept = decontaminate.remove_contaminated(odd, benchmark).collect()
    assert sorted(str(r.text) for r in kept) == ["None", "clean", "clean text of no interest"]
    assert decontaminate.benchmark_matches(empty, benchmark).count() == 0
    assert decontaminate.benchmark_matches(docs, benchmark.limit(0)).count() == 0


def test_sentencepiece_round_trip(docs, rows, empty):
    model = sentencepiece.read_model()
    out = sentencepiece.decode_documents(sentencepiece.encode_documents(docs, model), model).collect()
    texts = {i: t or "" for i, t, *_ in rows}
    assert all(r.decoded == texts[r.doc_id] for r in out) and len(out) == len(rows)
    assert sentencepiece.encode_documents(empty, model).count() == 0


def test_pii_documents(spark, empty):
    df = spark.createDataFrame([(1, "write to a.b@c.de or 10.0.0.1", 29), (2, None, 0), (3, "", 0)], "doc_id bigint, text string, n_chars bigint")
    out = {r.doc_id: r for r in pii.redact_documents(df).collect()}
    assert out[1].text == "write to [EMAIL] or [IP]" and out[1].n_chars == len(out[1].text) and out[2].text is None
    assert {r.doc_id: len(r.pii) for r in pii.pii_spans(df).collect()} == {1: 2, 2: 0, 3: 0}
    assert pii.pii_spans(empty).count() == 0


def test_url_filter(spark):
    urls = [
        "http://a.example.net/en/1", "http://A.EXAMPLE.NET/de/", "https://www.example.com/de/x?y", "http://x.org/fr/", "http://x.org/de/", "no scheme", None, "", "http://net", "http://net/",
        "http://badexample.com/de/", "x://example.com?/de/", "http://a.net:80/", "http://..net/", "http://example.net/en/", "http://example.net/en/",
    ]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id bigint, url string, host string")
    got = {r.page_id: r for r in url_filter.filter_urls(df, url_filter.rules_frame(spark)).collect()}

    def judge(u):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", u or "")
        host, path = (m[1].translate(LOWER), m[2]) if m else ("", "")
        fits = [(len(h + p), v, h + p) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return (host, path, *((max(fits)[2], max(fits)[1]) if fits else (None, "allow")))

    assert {i: (r.host, r.path, r.rule, r.verdict) for i, r in got.items()} == {i: judge(u) for i, u in enumerate(urls)}
    many = [("block" if i % 2 else "allow", f"{'s.' * (i % 4)}h{i % 7}.org", "/" + "p" * (i % 3)) for i in range(60)]
    assert url_filter.filter_urls(df, url_filter.rules_frame(spark, many)).count() == len(urls)


def test_hash_of_edited_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "abcd"), (2, "wxyz")], "doc_id bigint, text string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in fingerprint.op3_fingerprint(spark, str(tmp_path)).collect()}
    assert out[2].edited_sha256 == hashlib.sha256(b"wxab").hexdigest() and out[1].edited_sha256 == hashlib.sha256(b"abwx").hexdigest()
