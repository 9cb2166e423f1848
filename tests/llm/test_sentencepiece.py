import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import sentencepiece_codec as C
from strata.llm.queries import PIECES, op1_sentencepiece


@pytest.fixture(scope="module")
def model():
    return C.load(PIECES)


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def check(model, library, texts):
    ids = C.encode_column(model, pa.array(texts, pa.string()))
    assert ids.to_pylist() == [None if t is None else library.encode(t) for t in texts]
    back = C.decode_column(model, ids).to_pylist()
    assert back == [None if t is None else t.replace(C.SPACE, " ") for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="ab the▁ \n\tindo$%é😀日XYZ.,!01", max_size=50), max_size=8))
def test_encodes_like_the_library(model, library, texts):
    check(model, library, texts)


def test_runs_of_spaces_and_odd_signs(model, library):
    runs = [" " * r + w for r in (1, 15, 16, 17, 31, 40, 95) for w in ("", "abc", "😀", "\n")]
    check(model, library, [*runs, "", None, "a\x00b", "\n\n", "x" * 3000, "ｆｕｌｌ"])


def test_documents(model, library, documents):
    check(model, library, [r["text"] for r in documents])


def test_words_beyond_the_memory(model, library, documents, monkeypatch):
    monkeypatch.setattr(C, "REMEMBERED", 100)
    monkeypatch.setattr(C, "INDEX_CHARS", 500)
    C._memory.clear()
    check(model, library, [r["text"][:2000] for r in documents[:20]])


def test_pieces_side_by_side_by_merging(model, library):
    rng = np.random.default_rng(3)
    a, b = (rng.choice(model.searched, 4000) for _ in range(2))
    apart = C.side_by_side(model, a, b)
    texts = [model.pieces[x] + model.pieces[y] for x, y in zip(a, b, strict=True)]
    for text, x, y, got in zip(texts, a.tolist(), b.tolist(), apart.tolist(), strict=True):
        if text.startswith(C.SPACE) and C.SPACE not in text[1:]:
            assert got == (library.encode(text[1:]) == [x, y]), text


def test_cut_characters_decode_with_replacement(model):
    ids = pa.array([[model.byte_ids[0xE6]], [], None], pa.list_(pa.int32()))
    assert C.decode_column(model, ids).to_pylist() == ["�", "", None]


def test_query(spark, sf_dir, library, documents):
    rows = op1_sentencepiece(spark, sf_dir).collect()
    want = {r["doc_id"]: library.encode(r["text"]) for r in documents}
    assert {r["doc_id"]: r["token_ids"] for r in rows} == want
    assert all(r["round_trip"] and r["n_tokens"] == len(r["token_ids"]) for r in rows)


def test_odd_rows(spark, odd_documents, no_documents, library):
    rows = C.decode_ids(C.encode_texts(odd_documents, PIECES), PIECES).collect()
    assert len(rows) == odd_documents.count()
    for r in rows:
        assert r["token_ids"] == (None if r["text"] is None else library.encode(r["text"]))
        assert r["decoded"] == r["text"]
    clash = odd_documents.withColumnRenamed("features", "token_ids")
    assert C.encode_texts(clash, PIECES).columns == clash.columns
    assert C.encode_texts(no_documents, PIECES).count() == 0
