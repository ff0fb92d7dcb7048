import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from tidelog.llm.repeated import _sliding, anchors, located, compiled, pattern_starts
from tidelog.llm.words import pieces, words_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.none() | st.text(alphabet="ab \t\n\x0b\x0c\r\x1f\xa0é中😀A", max_size=40), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    array = pa.array(texts, type=pa.string())
    words = words_of(array)
    found = [
        [w.decode() for w in words.strings(words.first[n], words.first[n + 1])] for n in range(len(texts))
    ]
    assert found == [WORD.findall(t or "") for t in texts]
    marks = {}
    for text, a, b in zip(found, words.first, words.first[1:], strict=False):
        for word, mark in zip(text, words.mark[a:b].tolist(), strict=True):
            assert marks.setdefault(word, mark) == mark
    assert len(set(marks.values())) == len(marks)


def test_lower_takes_only_ascii_letters():
    a = words_of(pa.array(["ABC éÉ"]), lower=True).mark
    b = words_of(pa.array(["abc éÉ"])).mark
    c = words_of(pa.array(["abc éé"])).mark
    assert a.tolist() == b.tolist() and a[1] != c[1]


def test_a_slice_of_a_column_has_the_same_words():
    column = pa.array(["x y", None, "z", "u v w", ""])
    whole, part = words_of(column), words_of(column.slice(2, 2))
    assert part.mark.tolist() == whole.mark[2:6].tolist()
    assert list(pieces(column, 3)) == [(0, 2), (2, 3), (3, 4), (4, 5)]


def test_runs_tell_order_and_stay_inside_a_text():
    words = words_of(pa.array(["a b c", "b a c b c"]))
    marks, inside = words.runs(2)
    assert inside.tolist() == [True, True, False, True, True, True, True]
    assert marks[1] == marks[6] and marks[0] != marks[3]


def test_sliding_minima():
    values = np.random.default_rng(1).integers(0, 100, 50)
    for n in range(1, 12):
        assert _sliding(values, n, np.minimum).tolist() == [values[i : i + n].min() for i in range(51 - n)]


def test_anchor_of_a_window_begins_in_it():
    words = words_of(pa.array([" ".join(str(n * 7 % 31) for n in range(200)), "a " * 60]))
    least, inside, begins = anchors(words, 12)
    marks = np.minimum(words.runs(4, __import__("tidelog.llm.words", fromlist=["FACTORS"]).FACTORS[100:])[0], 2**64 - 2)
    for i in np.flatnonzero(inside):
        there = [p for p in range(i, i + 9) if marks[p] + np.uint64(1) == least[i]]
        assert there and all(begins[p] for p in there)


def test_patterns_cover_a_stretch():
    starts = np.array([0, 1, 2, 3, 10, 20, 21, 22, 23, 24, 25])
    chosen = pattern_starts(starts, 3)
    assert {w for s in chosen for w in range(s, s + 3)} == {w for s in starts for w in range(s, s + 3)}


def test_automaton_finds_whole_words_only():
    automaton = compiled([" a b ", " é 😀 "])
    assert located(automaton, "a b xa b a b a b é 😀 é", 2) == [(0, 2), (4, 10)]
