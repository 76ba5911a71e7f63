"""Longest-match token counts by a trie with failure links."""

from __future__ import annotations

import json

import numpy as np

from loomspark.llm import textvec as tv
from loomspark.llm.bpe import DEFAULT_TOKENIZER, _Cache, byte_chars

_loaded: dict[str, MaxMatch] = {}


def matcher(path: str = DEFAULT_TOKENIZER) -> MaxMatch:
    """The matcher of a vocabulary file, built once in each Python process."""
    if path not in _loaded:
        _loaded[path] = MaxMatch.from_file(path)
    return _loaded[path]


class MaxMatch:
    """Counts the tokens of greedy longest-match segmentation in one pass over a word.

    Every node of the vocabulary's trie stands for the text read since the last emitted token. Where no child fits the
    next byte, the tokens that are then settled are emitted at once, by a number computed beforehand for the node, and the
    node's failure link names the node of what is left. All single bytes have to be tokens, so every word can be cut.
    """

    def __init__(self, tokens: list[bytes]):
        goto: dict[int, int] = {}
        parent, byte, final = [0], [0], [False]
        for token in tokens:
            node = 0
            for b in token:
                key = node << 8 | b
                if (child := goto.get(key)) is None:
                    child = goto[key] = len(parent)
                    parent.append(node)
                    byte.append(b)
                    final.append(False)
                node = child
            final[node] = True
        if not all(final[goto[b]] if b in goto else False for b in range(256)):
            raise ValueError("every single byte has to be a token")
        depth = [0] * len(parent)
        for v in range(1, len(parent)):
            depth[v] = depth[parent[v]] + 1
        fail, emit = [0] * len(parent), [0] * len(parent)
        # By depth, as a node's link is found from its parent's.
        for v in sorted(range(1, len(parent)), key=depth.__getitem__):
            if final[v]:
                fail[v], emit[v] = 0, 1
                continue
            u, b = parent[v], byte[v]
            z, count = fail[u], emit[u]
            while (child := goto.get(z << 8 | b)) is None:
                count += emit[z]
                z = fail[z]
            fail[v], emit[v] = child, count
        self.goto, self.fail, self.emit = goto, fail, emit
        self.words = _Cache()

    @classmethod
    def from_file(cls, path: str) -> MaxMatch:
        with open(path, encoding="utf-8") as f:
            vocab = json.load(f)["model"]["vocab"]
        of = {c: b for b, c in enumerate(byte_chars())}
        return cls([bytes(of[c] for c in token) for token in vocab if all(c in of for c in token)])

    def count_word(self, word: bytes) -> int:
        goto, fail, emit = self.goto, self.fail, self.emit
        node = total = 0
        for b in word:
            while (child := goto.get(node << 8 | b)) is None:
                total += emit[node]
                node = fail[node]
            node = child
        while node:
            total += emit[node]
            node = fail[node]
        return total

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text: the words of the byte-level pattern are cut apart each for itself; known words aren't cut again."""
        pieces = [tv.safe_pieces(t) for t in texts]
        flat = [p for ps in pieces for p in ps]
        counts = np.zeros(len(flat), np.int64)
        for a, b in tv.groups([len(p) for p in flat]):
            codes, off = tv.codes_of(flat[a:b])
            starts = tv.pretoken_starts(codes, off)
            if not len(starts):
                continue
            ends = np.append(starts[1:], len(codes))
            whole = "".join(flat[a:b])

            def make(new: np.ndarray, whole: str = whole, starts: np.ndarray = starts, ends: np.ndarray = ends) -> np.ndarray:
                return np.array([self.count_word(whole[starts[i] : ends[i]].encode("utf-8", "surrogatepass")) for i in new], np.int64)

            n = self.words.counts(tv.word_hashes(codes, starts), make)
            cum = np.concatenate([[0], np.cumsum(n)])
            counts[a:b] = np.diff(cum[np.searchsorted(starts, off)])
        cum = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(cum[np.concatenate([[0], np.cumsum([len(p) for p in pieces])])])
