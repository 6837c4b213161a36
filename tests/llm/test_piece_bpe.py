"""Agenda encoding against the sentencepiece library; exact round trips."""

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

public_tokenizers = pytest.importorskip("public_tokenizers")

from jobsight.llm.piece_bpe import MergeCodec, decode_documents, encode_digests, encode_documents  # noqa: E402

MODEL = public_tokenizers.path("piece_bpe_32k.model")
CODEC = MergeCodec(MODEL)
CASES = ["", " ", "   ", "a", " a", "a ", "Hello  world", "  two  spaces  ", "tab\tline\nend", "café üß",
         "▁odd▁", "\U0001f600\U0001f601", "\x00", "<s>x</s> <0x0A>", "é", "ﬁ Å ①", "aaaaaaaaaaaaaaaaaa",
         "日本語 рус", "x" * 5000, "ab " * 3000, " " * 3000]


@pytest.mark.parametrize("text", CASES)
def test_ids_equal_the_librarys(text):
    ids = CODEC.encode(text)
    assert ids == CODEC.library.encode(text)
    assert CODEC.decode(ids) == CODEC.library.decode(ids)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    ids = CODEC.encode(text)
    assert ids == CODEC.library.encode(text)
    assert CODEC.decode(ids) == CODEC.library.decode(ids)


def test_frames(spark):
    rows = [(i, t, "x") for i, t in enumerate([*CASES, None, "a", "a"])] + [(None, "null id", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    encoded = encode_documents(docs, MODEL)
    got = {r["id"]: list(r["ids"]) for r in encoded.collect()}
    assert got == {i: CODEC.library.encode(t or "") for i, t, _ in rows}
    back = {r["id"]: r["text"] for r in decode_documents(encoded, MODEL).collect()}
    assert back == {i: CODEC.library.decode(CODEC.library.encode(t or "")) for i, t, _ in rows}
    digests = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in encode_digests(docs, MODEL).collect()}
    for i, t, _ in rows:
        ids = CODEC.library.encode(t or "")
        assert digests[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                              hashlib.sha256(CODEC.library.decode(ids).encode()).hexdigest())
    assert encode_digests(docs.limit(0), MODEL).collect() == []
