"""Counts against the library, which is the definition."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlens.llm.token_counts import MergeCounter, count_tokens, load_pieces

tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
PATH = tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)
PIECES = load_pieces(PATH)
COUNTER = MergeCounter(PIECES)
AWKWARD = st.text("aehtion .,\n\t▁éüñ中文😀́​\xa0<s>/0x9A\x00|", max_size=40)


@settings(max_examples=1500, deadline=None)
@given(st.one_of(AWKWARD, st.text(max_size=40)))
def test_any_text(text):
    assert COUNTER.count(text) == len(LIBRARY.encode(text))


@settings(max_examples=200, deadline=None)
@given(AWKWARD)
def test_without_cutting_into_segments(text):
    whole = MergeCounter(PIECES)
    whole.segments = None
    assert whole.count(text) == len(LIBRARY.encode(text))


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr("ledgerlens.llm.token_counts.REMEMBERED", 5)
    counter = MergeCounter(PIECES)
    text = " ".join(f"word{i % 17}x" for i in range(100))
    assert counter.count(text) == len(LIBRARY.encode(text)) and len(counter) <= 5


def test_table(spark):
    texts = [None, "", "Hello world", "x" * 50_000, "a b " * 9_000, "Hello world"]
    df = spark.createDataFrame([(i if i else None, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, n_tokens int")
    rows = sorted(count_tokens(df, PIECES).collect(), key=lambda r: r["doc_id"] or 0)
    for text, row in zip(texts, rows, strict=True):
        n = len(LIBRARY.encode(text or ""))
        assert (row["n_bytes"], row["n_tokens"], row["over_limit"]) == (len((text or "").encode()), n, n > 4096)
    assert count_tokens(df.limit(0), PIECES).collect() == []
