"""Texts as sequences of word hashes: width, case, punctuation, spacing and invisible signs don't matter, each Han sign is a word."""

from __future__ import annotations

import unicodedata

import numpy as np

from loomspark.llm.textvec import mix

GAP, WORD, HAN, DROP = 0, 1, 2, 3
#: The ranges of Han signs.
HAN_RANGES = [(0x3005, 0x3007), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x3FFFF)]

#: Letters and marks that show nothing (fillers, joiners, variation selectors).
INVISIBLE_RANGES = [(0x034F, 0x034F), (0x115F, 0x1160), (0x17B4, 0x17B5), (0x180B, 0x180F), (0x3164, 0x3164), (0xFE00, 0xFE0F), (0xFFA0, 0xFFA0), (0xE0100, 0xE01EF)]

_tables: dict[str, np.ndarray] = {}


def word_classes() -> np.ndarray:
    """Class of every code point: letters, marks and numbers make words, Han signs stand alone, formats and controls drop out."""
    if "word" not in _tables:
        by = {"L": WORD, "M": WORD, "N": WORD}
        t = np.fromiter((by.get(unicodedata.category(chr(i))[0], GAP) for i in range(0x110000)), np.uint8, 0x110000)
        for i in range(0x110000):
            if unicodedata.category(chr(i)) in ("Cf", "Cc"):
                t[i] = DROP
        t[[9, 10, 11, 12, 13, 28, 29, 30, 31, 133]] = GAP
        for a, b in INVISIBLE_RANGES:
            t[a : b + 1] = DROP
        for a, b in HAN_RANGES:
            t[a : b + 1] = HAN
        _tables["word"] = t
    return _tables["word"]


def plain(text: str) -> str:
    """Compatibility form without case."""
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).casefold()


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(uint64 hash of each word of all texts, offsets of each text). A text without words has none."""
    return word_kinds(texts)[:2]


def word_kinds(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, and whether each word is a Han sign."""
    texts = [plain(t) for t in texts]
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.zeros(len(codes) + 1, bool)
    off = np.concatenate([[0], np.cumsum(lens)])
    cls = word_classes()[codes]
    doc = np.repeat(np.arange(len(texts), dtype=np.int32), lens)
    keep = cls != DROP
    if not keep.all():
        codes, cls, doc = codes[keep], cls[keep], doc[keep]
    first = np.ones(len(codes), bool)
    first[1:] = (doc[1:] != doc[:-1]) | (cls[1:] == HAN) | (cls[:-1] != WORD)
    inside = cls != GAP
    codes, first, doc = codes[inside], first[inside], doc[inside]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(len(off), np.int64), np.zeros(0, bool)
    size = np.diff(np.append(starts, len(codes)))
    pos = np.arange(len(codes)) - np.repeat(starts, size)
    with np.errstate(over="ignore"):
        h = np.add.reduceat(mix(codes, pos), starts) + size.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)
    return h, np.searchsorted(doc[starts], np.arange(len(texts) + 1)), cls[inside][starts] == HAN
