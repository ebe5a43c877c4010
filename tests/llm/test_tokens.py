import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path

from marketpulse.llm import tokens

KINDS = [("byte_bpe_50k.json", "byte", "<|endoftext|>"), ("word_bpe_49k.json", "word", "<|startoftext|>")]
PIECES = st.sampled_from([" ", "\n", "\t", "\r\n", ".", ",", "'s", "!", "The", "the", " word", "\x1f", "\xa0", " ",
                          "İ", "Σ", "́", "é", "9", "_", "<|endoftext|>", "<|startoftext|>", "\U0001f600"])


@pytest.fixture(scope="module", params=KINDS, ids=["byte", "word"])
def enc(request):
    file, kind, separator = request.param
    return tokens.Encoder(path(file), kind, separator)


def test_ids_equal_whole_text_encoding(enc):
    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.one_of(PIECES, st.text(max_size=6)), max_size=25))
    def check(parts):
        text = "".join(parts).encode("utf-8", "ignore").decode()
        assert enc.encode([text])[0].tolist() == enc.plain.encode(text, add_special_tokens=False).ids

    check()


def test_forgetting_keeps_ids(enc, monkeypatch):
    monkeypatch.setattr(tokens, "_CACHED_CHUNKS", 50)
    texts = [f"alpha beta w{i % 40} gamma{i}. delta" for i in range(300)]
    for i in range(0, 300, 20):
        want = [x.ids for x in enc.plain.encode_batch(texts[i:i + 20], add_special_tokens=False)]
        assert [x.tolist() for x in enc.encode(texts[i:i + 20])] == want
    assert enc.encode([]) == []


def test_slices_cover_all():
    texts = ["a" * n for n in (5, 0, 90, 3, 200, 1)]
    got = [(at, t) for at, part in tokens.slices(texts, 60) for at, t in zip(range(at, at + len(part)), part)]
    assert got == list(enumerate(texts))
    assert np.sum([1 for _ in tokens.slices([], 5)]) == 0


def test_one_tokenizer_and_parts_of_a_batch_at_a_time():
    import pyarrow as pa

    enc = tokens.encoder(path("byte_bpe_50k.json"), "byte", "<|endoftext|>")
    assert enc.plain is enc.split  # a second one takes 30 MB of every worker
    assert enc.plain.encode("<|endoftext|>", add_special_tokens=False).ids != [enc.separator_id]
    assert enc.split.encode("<|endoftext|>", add_special_tokens=False).ids == [enc.separator_id]
    texts = ["a" * 30, None, "é" * 30, "b" * 500, "", "c" * 50, "d" * 50, None]
    batch = pa.record_batch({"k": list(range(8)), "text": texts})
    parts = [p.to_pydict() for p in tokens.arrow_slices(batch, size=100)]
    assert [p["k"] for p in parts] == [[0, 1, 2], [3], [4, 5, 6, 7]]
    assert [t for p in parts for t in p["text"]] == texts
    assert not list(tokens.arrow_slices(batch.slice(0, 0)))


def test_score_task_leaves_no_words_in_its_worker(spark):
    from marketpulse.llm import quality_fm

    def held(frames):
        import pandas as pd

        for f in frames:
            yield pd.DataFrame({"n": [len(quality_fm._BUCKETS)]})

    model = quality_fm.fit([], np.zeros(0))
    docs = spark.createDataFrame([("some words here",), (None,), ("",)], "text string").repartition(1)
    assert quality_fm.with_score(docs, model).where("score = 0.5").count() == 3
    assert {r.n for r in spark.range(8, numPartitions=8).mapInPandas(held, "n long").collect()} == {0}
