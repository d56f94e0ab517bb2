import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import wordpiece as W
from strata.llm.queries import tokenizer_path
from tests.llm.helpers import awkward, empty

piece = st.binary(min_size=1, max_size=4).map(lambda b: tuple(97 + x % 3 for x in b))


def run(a, words):
    raw = np.frombuffer(b"".join(words), np.uint8)
    end = np.cumsum([len(w) for w in words])
    return a.counts(raw, end - np.array([len(w) for w in words]), end).tolist()


@settings(max_examples=200, deadline=None)
@given(st.lists(piece, min_size=1, max_size=9), st.lists(piece, max_size=6),
       st.lists(st.binary(min_size=1, max_size=9).map(lambda b: bytes(97 + x % 3 for x in b)), min_size=1, max_size=9))
def test_counts_equal_plain_longest_match(inner, first, words):
    pieces = [*inner, *((W.OPEN, *p) for p in first), (W.OPEN,)]
    want = [W.greedy(w, set(pieces), max(map(len, pieces))) for w in words]
    assert run(W.Automaton(pieces), words) == want


def test_public_vocabulary_and_long_words():
    pieces = W.byte_level_vocabulary(tokenizer_path())
    a, longest = W.automaton(tokenizer_path()), max(map(len, pieces))
    words = [b"the", "é😀".encode(), b"internationalisation", b"ab" * 50_000, b"\x00\xff"]
    assert run(a, words) == [W.greedy(w, set(pieces), longest) for w in words]


def test_documents(spark):
    df = awkward(spark)
    pieces = set(W.byte_level_vocabulary(tokenizer_path()))
    longest = max(map(len, pieces))
    got = sorted((r["n_words"], r["n_tokens"]) for r in W.count_tokens(df, tokenizer_path()).collect())
    want = []
    for r in df.collect():
        w = (r["text"] or "").encode().split()
        want.append((len(w), sum(W.greedy(x, pieces, longest) for x in w)))
    assert got == sorted(want)
    assert W.count_tokens(empty(spark), tokenizer_path()).count() == 0
