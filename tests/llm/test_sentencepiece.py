import random
import tracemalloc

import numpy as np
import pytest

from lexspark.llm.sentencepiece import MODEL, Decoder, Encoder, Model, read_model

library = pytest.importorskip("sentencepiece")


@pytest.fixture(scope="module")
def model():
    return read_model(MODEL)


def texts():
    rng = random.Random(3)
    yield from ["", " ", "   ", "a", "\n", "Hello  world\t!", "é▁è", "日本語 text 🙂", "x" * 400, "<s> </s> <unk> <0x0A>", "the theatre thesis then  the"]
    letters = "etaoin shrdlu  éàñß.,\n0123ABC"
    for _ in range(1500):
        yield "".join(rng.choices(letters, k=rng.randint(1, 60)))


def test_ids_are_the_librarys(model):
    lib, own, back = library.SentencePieceProcessor(model_proto=model), Encoder(Model(model)), Decoder(Model(model))
    all_texts = list(texts())
    for text, ids in zip(all_texts, own.encode(all_texts), strict=True):
        assert np.frombuffer(ids, np.int32).tolist() == lib.encode(text), repr(text)
        if "▁" not in text:
            assert back.decode(ids) == text


def test_a_long_word_takes_memory_in_its_length(model):
    """A million characters without a space; back-pointers hold a few bytes for each, whole id strings would hold their square."""
    rng = random.Random(7)
    word = "".join(rng.choices("etaoinshrdlu日本0123", k=1_000_000))
    tracemalloc.start()
    own, back = Encoder(Model(model)), Decoder(Model(model))
    short = word[:20_000]
    base = tracemalloc.get_traced_memory()[0]
    tracemalloc.reset_peak()
    ids = own.encode([short])[0]
    assert tracemalloc.get_traced_memory()[1] - base < 60 << 20
    tracemalloc.stop()
    assert np.frombuffer(ids, np.int32).tolist() == library.SentencePieceProcessor(model_proto=model).encode(short)
    assert back.decode(own.encode([word])[0]) == word


def unigram(model: bytes) -> bytes:
    """The same pieces and scores as a unigram model: the trainer spec's model type set to 1 by a later field."""
    return model + bytes([0x12, 2, 0x18, 1])


def test_viterbi_finds_the_best_score(model):
    """Against every segmentation of short words."""
    m = Model(unigram(model))
    assert not m.bpe
    own = Encoder(m)

    def best(word):
        table = [0.0] + [float("-inf")] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(e):
                if word[s:e] in m.ids:
                    table[e] = max(table[e], table[s] + m.scores[m.ids[word[s:e]]])
        return table[-1]

    rng = random.Random(5)
    words = ["".join(rng.choices("▁theanrso", k=rng.randint(1, 12))) for _ in range(500)]
    own.encode_words(words)
    for w in words:
        ids = np.frombuffer(own.words[w], np.int32)
        assert "".join(m.pieces[i] for i in ids) == w
        assert abs(sum(m.scores[i] for i in ids) - best(w)) < 1e-3
