"""Texts of a batch as one flat array of code points, with vectorized classes, words and hashes."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np

#: Classes of code points for the tokenizer's split pattern.
OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: The code points of Unicode's White_Space property.
WHITE_SPACE = [*range(9, 14), 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
#: Pieces of at most so many code points are handled at once; this bounds a worker's memory.
PIECE = 1 << 19

_tables: dict[str, np.ndarray] = {}


def classes() -> np.ndarray:
    """uint8 class of every code point by Unicode's general category."""
    if "class" not in _tables:
        by = {"L": LETTER, "N": NUMBER}
        t = np.fromiter((by.get(unicodedata.category(chr(i))[0], OTHER) for i in range(0x110000)), np.uint8, 0x110000)
        t[WHITE_SPACE] = SPACE
        _tables["class"] = t
    return _tables["class"]


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(code points of all texts, offsets of each text and the end)."""
    off = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)), out=off[1:])
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32), off


def mix(codes: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """A 64-bit mix of each code point and its place in its word; the sum over a word is the word's hash."""
    with np.errstate(over="ignore"):
        x = codes.astype(np.uint64)
        x *= np.uint64(0x9E3779B97F4A7C15)
        x += pos.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(32)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return x


def pretoken_starts(codes: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sorted places where a word of the byte-level pattern begins; every non-empty text begins one."""
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.int64)
    cls = classes()[codes]
    first = np.zeros(n + 1, bool)
    first[off] = True
    begin = first[:n].copy()
    prev = np.empty(n, np.uint8)
    prev[0] = SPACE
    prev[1:] = cls[:-1]
    space = cls == SPACE
    blank = codes == 32
    after_blank = np.zeros(n, bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~first[:n]
    inner = ~first[:n]
    # Letters, numbers and other signs begin a word where the class changes, unless one blank before them belongs to it.
    begin |= inner & ~space & (cls != prev) & ~after_blank
    # White space begins a word after anything else, and its last sign is a word of its own before more text.
    ends = np.ones(n, bool)
    ends[:-1] = first[1:n]
    follows = np.zeros(n, bool)
    follows[:-1] = ~space[1:]
    follows &= ~ends
    begin |= inner & space & ((prev != SPACE) | follows)
    # Contractions.
    quote = np.flatnonzero((codes == 39) & begin)
    if len(quote):
        end = off[np.searchsorted(off, quote, "right")]
        pad = np.concatenate([codes, np.zeros(3, np.uint32)])
        a = np.where(quote + 1 < end, pad[quote + 1], 0)
        b = np.where(quote + 2 < end, pad[quote + 2], 0)
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        for hit, k in ((short, 2), (long, 3)):
            q = quote[hit]
            begin[q + 1] = False
            stop = q + k
            stop = stop[stop < n]
            # A blank or other white space there has begun a word by the rules above.
            stop = stop[cls[stop] == LETTER]
            begin[stop] = True
    return np.flatnonzero(begin)


def word_hashes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """uint64 hash of each word, given where the words begin."""
    if len(starts) == 0:
        return np.zeros(0, np.uint64)
    lens = np.diff(np.append(starts, len(codes)))
    pos = np.arange(len(codes)) - np.repeat(starts, lens)
    with np.errstate(over="ignore"):
        return np.add.reduceat(mix(codes, pos), starts) + lens.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)


def safe_pieces(text: str, size: int = PIECE) -> list[str]:
    """A long text cut where a word of the pattern surely begins: at a blank between two signs that aren't white space."""
    out, at = [], 0
    while len(text) - at > size:
        i, low = at + size, at + 1
        while True:
            i = text.rfind(" ", low, i)
            if i < 0:
                break
            if i + 1 < len(text) and not text[i - 1].isspace() and not text[i + 1].isspace():
                break
        if i < 0:  # none before the size: the first one after it
            i = at + size
            while (i := text.find(" ", i)) >= 0 and not (i + 1 < len(text) and not text[i - 1].isspace() and not text[i + 1].isspace()):
                i += 1
            if i < 0:
                break
        out.append(text[at:i])
        at = i
    out.append(text[at:])
    return out


def groups(lengths: list[int], size: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about `size` code points together, at least one text each."""
    at, total = 0, 0
    for i, n in enumerate(lengths):
        if total and total + n > size:
            yield at, i
            at, total = i, 0
        total += n
    if at < len(lengths):
        yield at, len(lengths)
