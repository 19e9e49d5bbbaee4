"""Byte-level BPE against the tiktoken library, and exact edits."""

import hashlib

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from arealytics.llm.bpe import (
    EditableText,
    PrefixEncoder,
    TextEncoder,
    decode,
    encode,
    read_ranks,
)

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXT = st.text(st.sampled_from("ab c'lrevst \n\t.!1é日ß🎉"), max_size=40)


@pytest.fixture(scope="module")
def ranks():
    return read_ranks(PATH)


@pytest.fixture(scope="module")
def ours(ranks):
    return TextEncoder(PrefixEncoder(ranks), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def theirs(ranks):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(TEXT, st.text(max_size=60)))
def test_equals_the_library(ours, theirs, text):
    assert ours.encode(text) == theirs.encode_ordinary(text)
    assert ours.encoder.decode(ours.encode(text)) == text.encode()


@settings(max_examples=100, deadline=None)
@given(text=TEXT, edits=st.lists(st.tuples(st.integers(0, 40), st.integers(0, 5), TEXT), max_size=5))
def test_edits_and_appends_are_exact(ours, theirs, text, edits):
    edited = EditableText(ours, text)
    for start, length, new in edits:
        start = min(start, len(text))
        end = min(len(text), start + length)
        text = text[:start] + new + text[end:]
        edited.edit(start, end, new)
        assert edited.ids() == theirs.encode_ordinary(text)
    edited.append("'ll it")
    assert edited.ids() == theirs.encode_ordinary(text + "'ll it")


def test_extending_keeps_stored_tokens(ours):
    encoder = ours.encoder
    stored = encoder.prefixes(b"walk")
    assert encoder.prefixes(b"walking", stored) == encoder.prefixes(b"walking")
    assert encoder.prefixes(b"walking")[:4] == stored


def test_documents(spark, theirs):
    texts = ["", None, "same", "same", "x" * 30_000, "Über  \n\n x’s 日本"]
    docs = spark.createDataFrame(
        [(i, t, 7, "n") for i, t in enumerate(texts)],
        "doc_id long, text string, n_tokens int, ids string",
    )
    found = {r.doc_id: r for r in encode(docs, PATH, public_tokenizers.PATTERN, with_ids=True).collect()}
    for i, text in enumerate(texts):
        ids = theirs.encode_ordinary(text or "")
        assert found[i].ids == ids and found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    again = decode(spark.createDataFrame([(1, found[5].ids), (2, None)], "doc_id long, ids array<int>"), PATH)
    assert {r.doc_id: r.text for r in again.collect()} == {1: texts[5], 2: None}
    assert encode(docs.where("false"), PATH, public_tokenizers.PATTERN).count() == 0
