"""Greedy word-piece token counts with a linear longest-match automaton (operator 2).

The vocabulary is a trie with failure links.  When the character at hand has no
transition, the longest piece that is certain to be taken is popped and the
automaton goes on from the rest of what it has read: the failure link of a node
is the node of that rest, and the number of pieces popped on the way is
precomputed.  Each character is read once, so a word of any length takes linear
time, and the count needs no piece to be built.

Nodes are arrays (child table keyed by node and byte, failure, popped count).  A
batch's distinct words are found by hash; only they run through the automaton,
all at once, one byte position per step.

Defined results: null and empty texts have 0 tokens; a byte that the vocabulary
cannot spell makes its word one unknown token, as word-piece does; repeated rows
count alike; any length of word or text is counted whole; an empty table gives
no rows; extra columns pass through.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import byte_map, map_texts, utf8, words_of

#: Words are runs of anything but ASCII white space.
WORD = byte_map(lambda b: not (0x09 <= b <= 0x0D or b == 0x20), lower=False)
#: Stands before the first byte of a word, so that pieces that open a word differ
#: from pieces that go on in it.
OPEN = 256


def byte_level_vocabulary(path: str) -> list[tuple[int, ...]]:
    """Pieces of a byte-level vocabulary file: bytes, with ``OPEN`` for a leading blank."""
    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    back = {chr(b): b for b in plain}              # the file's letter for each byte
    back |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
    out = []
    for piece in vocab:
        if all(c in back for c in piece):
            raw = [back[c] for c in piece]
            out.append(tuple([OPEN, *raw[1:]] if raw[0] == 32 else raw))
    return out


class Automaton:
    """The trie with failure links and popped counts, in flat arrays."""

    def __init__(self, pieces: list[tuple[int, ...]]):
        child: list[dict[int, int]] = [{}]
        final, depth, parent = [False], [0], [(-1, -1)]
        for piece in pieces:
            at = 0
            for c in piece:
                if c not in child[at]:
                    child[at][c] = len(child)
                    child.append({})
                    final.append(False)
                    depth.append(depth[at] + 1)
                    parent.append((at, c))
                at = child[at][c]
            final[at] = bool(piece)
        n = len(child)
        fail, pops = np.full(n, -1, np.int64), np.zeros(n, np.int64)
        for v in np.argsort(np.array(depth), kind="stable")[1:]:
            up, c = parent[v]
            if final[v]:
                fail[v], pops[v] = 0, 1             # the whole string is one piece
                continue
            at, popped = int(fail[up]), int(pops[up])
            while at >= 0 and c not in child[at]:
                popped, at = popped + int(pops[at]), int(fail[at])
            if at >= 0:
                fail[v], pops[v] = child[at][c], popped
        self.fail, self.pops = fail, pops
        keys = np.array([v * 257 + c for v in range(n) for c in child[v]], np.int64)
        nodes = np.array([t for v in range(n) for t in child[v].values()], np.int64)
        order = np.argsort(keys)
        self.keys, self.nodes = keys[order], nodes[order]
        self.start = child[0].get(OPEN, -1)

    def step(self, at: np.ndarray, c: np.ndarray) -> np.ndarray:
        """The child of each node by each byte (-1: none)."""
        key = at * 257 + c
        spot = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((at >= 0) & (self.keys[spot] == key), self.nodes[spot], -1)

    def counts(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Pieces of each word ``raw[begin:end]`` (a word that cannot be spelt: 1)."""
        n = len(begin)
        at = np.full(n, self.start, np.int64)
        total = np.zeros(n, np.int64)
        if not len(self.keys):
            return np.ones(n, np.int64)
        length = end - begin
        order = np.argsort(-length, kind="stable")  # words still being read stand first
        steps = np.searchsorted(-length[order], -np.arange(1, int(length.max(initial=0)) + 1), "right")
        for pos, live in enumerate(steps):
            w = order[:live]
            c = raw[begin[w] + pos].astype(np.int64)
            self._read(at, total, w, c)
        # What is left is popped until the root; a node that leads nowhere is unknown.
        w = np.flatnonzero(at > 0)
        while len(w):
            total[w] += self.pops[at[w]]
            at[w] = self.fail[at[w]]
            w = w[at[w] > 0]
        return np.where(at < 0, 1, total)

    def _read(self, at: np.ndarray, total: np.ndarray, w: np.ndarray, c: np.ndarray) -> None:
        nxt = self.step(at[w], c)
        while True:
            done = nxt >= 0
            at[w[done]] = nxt[done]
            w, c = w[~done], c[~done]
            if not len(w):
                return
            dead = at[w] <= 0                       # the root, or already unknown
            at[w[dead]] = -1
            w, c = w[~dead], c[~dead]
            total[w] += self.pops[at[w]]
            at[w] = self.fail[at[w]]
            nxt = self.step(at[w], c)


_BUILT: dict[str, Automaton] = {}


def automaton(path: str) -> Automaton:
    """One automaton per Python worker and vocabulary file."""
    if path not in _BUILT:
        _BUILT[path] = Automaton(byte_level_vocabulary(path))
    return _BUILT[path]


def greedy(word: bytes, pieces: set[tuple[int, ...]], longest: int) -> int:
    """Pieces of a word by plain longest match (for tests)."""
    rest, n = (OPEN, *word), 0
    while rest:
        k = next((k for k in range(min(len(rest), longest), 0, -1) if rest[:k] in pieces), 0)
        if not k:
            return 1
        rest, n = rest[k:], n + 1
    return n


def count_tokens(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """Replace the text by ``n_words`` and ``n_tokens``; ``path`` names a byte-level
    vocabulary file that every machine has."""
    def run(col: pa.Array) -> dict:
        raw, offsets = utf8(col)
        h, begin, end, row = words_of(raw, offsets, WORD)
        _, first, inverse = np.unique(h, return_index=True, return_inverse=True)
        per = automaton(path).counts(raw, begin[first], end[first])
        return {"n_words": np.bincount(row, minlength=len(col)).astype(np.int64),
                "n_tokens": np.bincount(row, per[inverse], minlength=len(col)).astype(np.int64)}

    return map_texts(docs, {"n_words": "long", "n_tokens": "long"}, run, text_col)
