import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from envlake.llm.text import ALNUM, ALNUM_WORD, BLACK, BLACK_WORD, grams, hash_words, pieces, split_words

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aBZ09 _-\n\t.é漢\x00😀", max_size=30)), max_size=6)


@given(texts)
@settings(max_examples=150, deadline=None)
def test_words_are_those_of_the_regular_expressions(values):
    for kind, pattern in ((ALNUM, ALNUM_WORD), (BLACK, BLACK_WORD)):
        words = split_words(pa.array(values, pa.string()), kind)
        want = [re.findall(pattern, (v or "").translate(LOWER)) for v in values]
        got = words.strings().to_pylist()
        assert [got[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)] == want


def test_a_word_has_one_hash_whatever_stands_beside_it():
    short = hash_words(split_words(pa.array(["ab c"])))
    long = hash_words(split_words(pa.array(["x" * 100 + " ab", "c"])))
    assert short[0] == long[1] and short[1] == long[2]
    many = split_words(pa.array([" ".join(f"w{i}" for i in range(20000))]))
    assert len(np.unique(hash_words(many))) == 20000


def test_grams_and_pieces():
    h = hash_words(split_words(pa.array(["a b c a b c"])))
    g = grams(h, 3)
    assert len(g) == 4 and g[0] == g[3] and len(set(g.tolist())) == 3
    assert len(grams(h, 7)) == 0
    rows = pa.array(["x" * 10, None, "", "y" * 300, "z"])
    found = list(pieces(rows, 100))
    assert found[0][0] == 0 and found[-1][1] == 5
    assert all(a < b for a, b in found) and [b for _, b in found[:-1]] == [a for a, _ in found[1:]]
    assert list(pieces(pa.array([], pa.string()))) == []


def test_words_of_any_length_have_the_sum_of_their_bytes(monkeypatch):
    from envlake.llm import text

    rng = np.random.default_rng(2)
    values = [" ".join("".join(rng.choice(list("abcé09"), n)) for n in (1, 3, 24, 25, 26, 100, 3000)) for _ in range(5)]
    words = text.split_words(pa.array(values))
    whole = text.hash_words(words)
    monkeypatch.setattr(text, "STRETCH", 37)
    assert (text.hash_words(words) == whole).all()
    sums = [sum(int(text._SPREAD[x]) * pow(int(text._BASE), i, 2**64) for i, x in enumerate(w.encode())) % 2**64 for w in words.strings().to_pylist()]
    want = text.mix(np.array(sums, np.uint64) ^ np.array([len(w.encode()) for w in words.strings().to_pylist()], np.uint64))
    assert (whole == want).all()
