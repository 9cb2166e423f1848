import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given
from hypothesis import strategies as st

from strata.llm import words as W

TEXTS = st.lists(st.none() | st.text(alphabet="aB é\t\n日.", max_size=40), max_size=12)


def spans(texts):
    out = []
    for row, text in enumerate(texts):
        out += [(row, w) for w in (text or "").encode().lower().split()]
    return out


@given(TEXTS, st.sampled_from([3, 7, 1_000_000]))
def test_words_are_those_of_a_split(texts, block):
    before, W.BLOCK = W.BLOCK, block
    try:
        column = W.texts_of(pa.array(texts, pa.string()))
        found = W.words_of(column)
    finally:
        W.BLOCK = before
    got = [
        (int(r), column.data[b:e].tobytes().lower()) for r, b, e in zip(found.row, found.begin, found.end, strict=True)
    ]
    assert got == spans(texts)
    by_hash = {}
    for (_, word), value in zip(got, found.hash, strict=True):
        assert by_hash.setdefault(word, value) == value
    assert len(set(by_hash.values())) == len(by_hash)


@given(TEXTS)
def test_parts_hold_all_rows_in_order(texts):
    before, W.BLOCK = W.BLOCK, 5
    try:
        rows = []
        for part in W.parts(pa.array(["first", *texts], pa.string()).slice(1)):
            for a, b in zip(part.start[:-1], part.start[1:], strict=True):
                rows.append(part.data[a:b].tobytes().decode())
    finally:
        W.BLOCK = before
    assert rows == [t or "" for t in texts]


@pytest.mark.parametrize("least", [1, 3])
def test_runs_end_with_their_text(least):
    texts = W.texts_of(pa.array(["aab", "aa", None, "baaa", ""]))
    row, begin, end = W.runs(texts, W.byte_class("a"), least)
    want = [(0, 2), (1, 2), (3, 3)] if least == 1 else [(3, 3)]
    assert list(zip(row.tolist(), (end - begin).tolist(), strict=True)) == want


def test_positions_in_characters():
    texts = W.texts_of(pa.array(["é1", "日2"]))
    row, begin, _ = W.runs(texts, W.byte_class("12"), 1)
    assert W.code_points(texts, row, begin).tolist() == [1, 1]
    assert W.row_sums(texts, np.arange(256) >= 0x80).tolist() == [2, 3]
