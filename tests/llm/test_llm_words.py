import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

import llm_brute as brute
from pointstream.llm import words as w

TEXTS = st.lists(st.text(alphabet="aAzZ09 _.\n\t\x0b#é語\U0001f600\x1c\xa0", max_size=40), max_size=8)


def found(texts, kind, rows=w.PART_ROWS):
    out = []
    for part in w.parts(pa.array(texts, pa.string()), rows):
        t = part.tokens(kind)
        for r in range(len(part)):
            span = range(t.first[r], t.first[r + 1])
            out.append([part.data[t.start[i] : t.end[i]].tobytes().decode() for i in span])
    return out


@settings(max_examples=60, deadline=None)
@given(TEXTS)
def test_tokens_are_those_of_the_patterns(texts):
    assert found(texts, w.PLAIN_WORDS) == [brute.WORD.findall(t) for t in texts]
    lower = [[x.translate(brute.A_Z) for x in row] for row in found(texts, w.ALNUM_WORDS)]
    assert lower == [brute.alnum_words(t) for t in texts]
    assert found(texts, w.LINES) == [[x for x in t.split("\n") if x] for t in texts]


@pytest.mark.parametrize("size", [1, 7, 64])
def test_pieces_and_parts_change_nothing(monkeypatch, size):
    texts = ["one two  three", None, "", "fourfivesixseven eight", "a b c d e f g h i", " x "]
    whole = [t.hash.tolist() for p in w.parts(pa.array(texts)) for t in [p.tokens(w.LOWER_WORDS)]]
    monkeypatch.setattr(w, "PART_BYTES", size)
    parts = list(w.parts(pa.array(texts), rows=2))
    assert sum(map(len, parts)) == len(texts)
    split = [t.hash.tolist() for p in parts for t in [p.tokens(w.LOWER_WORDS)]]
    assert sum(whole, []) == sum(split, [])


def test_equal_words_hash_alike_and_windows_stay_in_a_text():
    (part,) = w.parts(pa.array(["A b c", "a B c", "c b a", "b"]))
    t = part.tokens(w.LOWER_WORDS)
    assert (t.hash[:3] == t.hash[3:6]).all() and t.hash[0] != t.hash[1]
    at, h = t.windows(3)
    assert at.tolist() == [0, 3, 6] and h[0] == h[1] != h[2]
    assert t.windows(4)[0].tolist() == []


def test_sliced_columns_and_counts():
    column = pa.array(["zz", "a#b", None, "", "##"]).slice(1)
    table = np.array([int(b == ord("#")) for b in range(256)], dtype=np.uint8)
    (part,) = w.parts(column)
    assert part.count(table).tolist() == [1, 0, 0, 2]
