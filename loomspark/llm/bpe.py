"""Byte-level BPE in numpy: the words of a batch are merged together, round by round."""

from __future__ import annotations

import heapq
import json

import numpy as np

from loomspark.llm import textvec as tv

DEFAULT_TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
NONE = np.int32(2**31 - 1)
#: Words of more bytes than this are merged one by one with a heap, as a round for each of their merges would be too many.
LONG_WORD = 1024

_loaded: dict[str, ByteBPE] = {}


def tokenizer(path: str = DEFAULT_TOKENIZER) -> ByteBPE:
    """The tokenizer of a file, loaded once in each Python process."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


def byte_chars() -> list[str]:
    """The printable stand-in of each byte in a byte-level vocabulary: itself where printable, else the next free sign from 256 on."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    free = iter(range(256, 512))
    return [chr(b if b in plain else next(free)) for b in range(256)]


class ByteBPE:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab = model["vocab"]
        self.size = max(vocab.values()) + 1
        self.byte_id = np.array([vocab[c] for c in byte_chars()], np.int32)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.fromiter((vocab[a] for a, _ in pairs), np.int64, len(pairs))
        right = np.fromiter((vocab[b] for _, b in pairs), np.int64, len(pairs))
        made = np.fromiter((vocab[a + b] for a, b in pairs), np.int32, len(pairs))
        keys = left << 20 | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank, self.made = keys[order], order.astype(np.int32), made[order]
        self.pairs: dict[int, tuple[int, int]] | None = None
        self.known: dict[int, int] = {}
        self.words = _Cache()

    def _lookup(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = a.astype(np.int64) << 20 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[at] == key
        return np.where(hit, self.rank[at], NONE), self.made[at]

    def merge(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, given the bytes of all words and the offsets of each: (ids, their offsets). Words aren't empty."""
        lens = np.diff(off)
        long = np.flatnonzero(lens > LONG_WORD)
        if len(long):
            short = np.flatnonzero(lens <= LONG_WORD)
            parts: list[np.ndarray] = [np.zeros(0, np.int32)] * len(lens)
            if len(short):
                keep = np.repeat(lens <= LONG_WORD, lens)
                ids, o = self._rounds(raw[keep], np.concatenate([[0], np.cumsum(lens[short])]))
                for k, w in enumerate(short):
                    parts[w] = ids[o[k] : o[k + 1]]
            for w in long:
                parts[w] = self._heap(raw[off[w] : off[w + 1]])
            return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        return self._rounds(raw, off)

    def _rounds(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(off) - 1
        sym = self.byte_id[raw]
        word = np.repeat(np.arange(n, dtype=np.int32), np.diff(off))
        rank, made = self._pairs(sym, word)
        done_sym, done_word = [], []
        while len(sym):
            starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(starts, len(sym)))
            least = np.minimum.reduceat(rank, starts)
            over = least == NONE
            if over.any():
                drop = np.repeat(over, size)
                done_sym.append(sym[drop])
                done_word.append(word[drop])
                keep = ~drop
                sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
                least, size = least[~over], size[~over]
                if not len(sym):
                    break
            at = np.flatnonzero(rank == np.repeat(least, size))
            # Of pairs that overlap (a run of the same sign), every second one from the left.
            run = np.concatenate([[True], np.diff(at) != 1])
            k = np.arange(len(at))
            at = at[(k - np.maximum.accumulate(np.where(run, k, 0))) % 2 == 0]
            sym[at] = made[at]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = at - np.arange(len(at))  # one sign before each is gone
            sym, word, rank, made = sym[keep], word[keep], rank[keep], made[keep]
            again = np.unique(np.concatenate([moved, moved[moved > 0] - 1]))
            inside = again[(again + 1 < len(sym))]
            rank[again] = NONE
            inside = inside[word[inside] == word[inside + 1]]
            rank[inside], made[inside] = self._lookup(sym[inside], sym[inside + 1])
        ids, words = np.concatenate(done_sym), np.concatenate(done_word)
        order = np.argsort(words, kind="stable")
        return ids[order], np.concatenate([[0], np.cumsum(np.bincount(words, minlength=n))])

    def _pairs(self, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rank, made = np.full(len(sym), NONE, np.int32), np.zeros(len(sym), np.int32)
        same = np.flatnonzero(word[:-1] == word[1:])
        rank[same], made[same] = self._lookup(sym[same], sym[same + 1])
        return rank, made

    def _heap(self, raw: np.ndarray) -> np.ndarray:
        """One long word in n log n: a heap of (rank, place) over a linked list."""
        if self.pairs is None:
            self.pairs = {int(k): (int(r), int(m)) for k, r, m in zip(self.keys, self.rank, self.made, strict=True)}
        pairs, sym = self.pairs, self.byte_id[raw].tolist()
        n = len(sym)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(p[0], i, sym[i], sym[i + 1]) for i in range(n - 1) if (p := pairs.get(sym[i] << 20 | sym[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = pairs[a << 20 | b][1], -1
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
                if p := pairs.get(sym[i] << 20 | sym[right[i]]):
                    heapq.heappush(heap, (p[0], i, sym[i], sym[right[i]]))
            if left[i] >= 0 and (p := pairs.get(sym[left[i]] << 20 | sym[i])):
                heapq.heappush(heap, (p[0], left[i], sym[left[i]], sym[i]))
        return np.array([s for s in sym if s >= 0], np.int32)

    def _split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(code points, offsets of the texts, starts of the words, hash of each word)."""
        codes, off = tv.codes_of(texts)
        starts = tv.pretoken_starts(codes, off)
        return codes, off, starts, tv.word_hashes(codes, starts)

    def _bytes(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """UTF-8 bytes of some words and their offsets."""
        lens = ends - starts
        at = np.repeat(starts - np.concatenate([[0], np.cumsum(lens)[:-1]]), lens) + np.arange(lens.sum())
        own = codes[at]
        width = 1 + (own > 0x7F) + (own > 0x7FF) + (own > 0xFFFF).astype(np.int64)
        raw = np.frombuffer(own.tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"), np.uint8)
        ends_at = np.cumsum(width)
        return raw, np.concatenate([[0], ends_at[np.cumsum(lens) - 1]])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of each text). Empty texts have no ids. Long texts are cut where a word begins, which changes nothing."""
        pieces = [tv.safe_pieces(t) for t in texts]
        flat = [p for ps in pieces for p in ps]
        parts, counts = [np.zeros(0, np.int32)], np.zeros(len(flat), np.int64)
        for a, b in tv.groups([len(p) for p in flat]):
            codes, off, starts, hashes = self._split(flat[a:b])
            if not len(starts):
                continue
            _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
            ends = np.append(starts[1:], len(codes))
            ids, o = self.merge(*self._bytes(codes, starts[first], ends[first]))
            n = np.diff(o)[back]
            cum = np.concatenate([[0], np.cumsum(n)])
            parts.append(ids[np.repeat(o[:-1][back] - cum[:-1], n) + np.arange(cum[-1])])
            counts[a:b] = np.diff(cum[np.searchsorted(starts, off)])
        cum = np.concatenate([[0], np.cumsum(counts)])
        return np.concatenate(parts), cum[np.concatenate([[0], np.cumsum([len(p) for p in pieces])])]

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of ids of each text; words counted before in this process aren't merged again."""
        pieces = [tv.safe_pieces(t) for t in texts]
        flat = [p for ps in pieces for p in ps]
        counts = np.zeros(len(flat), np.int64)
        for a, b in tv.groups([len(p) for p in flat]):
            codes, off, starts, hashes = self._split(flat[a:b])
            if not len(starts):
                continue
            n = self.words.counts(hashes, lambda new, codes=codes, starts=starts: self._sizes(codes, starts, new))
            cum = np.concatenate([[0], np.cumsum(n)])
            counts[a:b] = np.diff(cum[np.searchsorted(starts, off)])
        cum = np.concatenate([[0], np.cumsum(counts)])
        return np.diff(cum[np.concatenate([[0], np.cumsum([len(p) for p in pieces])])])

    def _sizes(self, codes: np.ndarray, starts: np.ndarray, which: np.ndarray) -> np.ndarray:
        ends = np.append(starts[1:], len(codes))
        return np.diff(self.merge(*self._bytes(codes, starts[which], ends[which]))[1])


class _Cache:
    """Word hash to number of ids: sorted arrays, started anew when they grow beyond `most` words."""

    def __init__(self, most: int = 1 << 20):
        self.most, self.keys, self.values = most, np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def counts(self, hashes: np.ndarray, make) -> np.ndarray:
        own, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, own)
        known = np.zeros(len(own), bool)
        inside = at < len(self.keys)
        known[inside] = self.keys[at[inside]] == own[inside]
        out = np.zeros(len(own), np.int64)
        out[known] = self.values[at[known]]
        if not known.all():
            out[~known] = make(first[~known])
            keys, values = np.concatenate([self.keys, own[~known]]), np.concatenate([self.values, out[~known]])
            if len(keys) > self.most:
                keys, values = own, out
            order = np.argsort(keys, kind="stable")
            self.keys, self.values = keys[order], values[order]
        return out[back]
