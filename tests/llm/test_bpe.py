import hashlib

import numpy as np
import pytest
from flowframe.llm import bpe
from hypothesis import given, settings
from hypothesis import strategies as st

P = pytest.importorskip("public_tokenizers")
PATH = P.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


CODEC = bpe.Codec(open(PATH, "rb").read())
STRINGS = bpe.vocabulary_strings(open(PATH, "rb").read())
HARD = ["ΑΣ ΟΔΟΣ Σ", "İstanbul İ", "ẞ ß ﬁ ǅ ŉ", "x<|endoftext|>y <|startoftext|> <|end", "a\x1cb c d\x85e​f",
        "it's I'M we'LL 'S", "日本語 한국어", "👨‍👩‍👧 123½²", "", " \n\t ", "a" * 3000, "\x00\x01 \x7f", "á́" * 20, "́a"]


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("abAB'sS ́ͅΣσİıẞßÉé12½<|>\xa0\x1c\n!?#日"), max_size=40) | st.text(max_size=30) | st.sampled_from(HARD))
def test_text_matches_the_library(text):
    from tokenizers import Tokenizer

    test_text_matches_the_library.t = t = getattr(test_text_matches_the_library, "t", None) or Tokenizer.from_file(PATH)
    want = t.encode(text, add_special_tokens=False).ids
    got = CODEC.encode(text.encode())
    assert np.frombuffer(got, "<u4").tolist() == want
    assert bpe.decode(got, STRINGS) == t.decode(want, skip_special_tokens=False)


def test_documents_match_the_library(documents, library):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for r in bpe.round_trip_digest(documents, PATH).collect():
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_rows_beyond_the_first_slice(spark, library):
    texts = [f"Word{i} and {"x" * (i % 7)}" for i in range(1300)]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string").coalesce(1)
    for r in bpe.encode_texts(df, PATH, decoded_col="decoded").collect():
        ids = library.encode(texts[r["k"]], add_special_tokens=False).ids
        assert r["text"] == texts[r["k"]] and np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == ids
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)


def test_odd_rows(odd_documents, odd_rows, no_documents, library):
    coded = bpe.encode_texts(odd_documents, PATH)
    assert set(coded.columns) == set(odd_documents.columns)
    rows = bpe.decode_ids(coded, PATH).collect()
    assert len(rows) == len(odd_rows)
    for r in rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() == ids and r["n_tokens"] == len(ids)
        assert r["decoded"] == library.decode(ids, skip_special_tokens=False)
    again = bpe.encode_texts(odd_documents, PATH, decoded_col="decoded").select("token_ids", "decoded").collect()
    key = lambda r: (bytes(r["token_ids"]), r["decoded"])
    assert sorted(map(key, again)) == sorted(map(key, rows))
    assert bpe.round_trip_digest(no_documents, PATH).collect() == []
