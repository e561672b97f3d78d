import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm import encode as E

PATH = f"{E.TOKENIZER_DIR}/byte_bpe_50k.tiktoken"


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from(list("ab '’\n\t1２的，。s…é　🙂")), max_size=80), st.integers(2, 9))
def test_pieces_keep_the_encoding(text, size):
    enc = E.encoding(PATH)
    assert "".join(E.pieces(text, size)) == text
    assert E.encode_text(enc, text, size) == enc.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 200_000, "的" * 70_000 + "。" + "的" * 70_000, "word " * 40_000, "<|endoftext|>"])
def test_long_texts(text):
    enc = E.encoding(PATH)
    assert E.decode_ids(enc, E.encode_text(enc, text)) == text.encode()
    assert E.encode_text(enc, text) == enc.encode_ordinary(text)


def test_frame(spark):
    rows = [(1, "投标 bid", "x"), (2, None, "x"), (3, "", "x"), (1, "投标 bid", "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r.doc_id, tuple(r.ids)) for r in E.encode(df).collect()}
    assert (2, ()) in got and (3, ()) in got and len(got) == 3
    raw = {r.doc_id: bytes(r.raw) for r in E.decode(E.encode(df)).collect()}
    assert raw[1].decode() == "投标 bid"
    assert E.encode(df.limit(0)).count() == 0
