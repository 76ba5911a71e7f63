"""Problem 3: rows of the evaluation table that also occur, exactly or nearly, in the training table."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.frames import own_frames, shared_keys
from loomspark.functions.names import with_known_game
from loomspark.llm import textvec as tv
from loomspark.llm.words import word_hashes
from loomspark.operators.graph import small_broadcast, spread_join
from loomspark.session import cut, drop_unused

#: Fixed by the definition: at most one word in so many of the longer text differs.
ONE_IN = 10
#: Words of a block, and of a run in it, in texts of the training table below SHORT words, and from there on.
SHORT, SHORT_BLOCK, SHORT_RUN, BLOCK, RUN = 40, 4, 3, 6, 5
#: Counts of the evaluation table's runs lie in 2 ** TABLE_BITS cells of two bytes; parts of the table travel in SLICES.
TABLE_BITS, SLICES = 22, 64
#: Runs counted more often are hot: they meet only within a class of lengths (steps of LENGTH_STEP) and a place in the text (PLACE_SHARE of that length).
HOT, LENGTH_STEP, PLACE_SHARE = 512, 1.25, 0.25
#: Bits of a run's hash that travel; runs that agree in them by chance are only more candidates.
SEED_BITS = 47
#: Words of the context that begins with a fingerprint (at the text's end it goes on from the text's start), and bits of its signature; the other bits of 64 tell how many edits it may hold.
CONTEXT, CONTEXT_BITS = 32, 56
#: Bits of a text's hash by which its seeds and hits name it; texts that agree in them by chance are only more candidates.
NAME_BITS = 40
#: Hits, and seeds, that a task looks at in one go, and seeds of one part of them.
AT_ONCE, IN_PART = 1 << 20, 1 << 18
#: Rows of the evaluation table for which the hits of all texts lie on disk together; with more the training texts take turns.
IN_ROUND = 1 << 18
#: Buckets of a text's sketch, in which its words are counted up to 255.
SKETCH = 32
DOC = "id bigint, h bigint, g bigint, n int, sketch binary"
PACKET = "part int, side int, n int, data binary"
PLACE = (1 << 31) - 1


def spoken(messages: Column) -> Column:
    """The contents of all turns but the system's, as one text without the marks of images; empty for null messages."""
    turns = F.filter(messages, lambda m: m.isNotNull() & ~F.coalesce(F.lower(F.trim(m["role"])) == "system", F.lit(False)))
    return F.replace(F.coalesce(F.concat_ws(" ", F.transform(turns, lambda m: m["content"])), F.lit("")), F.lit("<image>"), F.lit(" "))


def rolling(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k words."""
    if len(h) < k:
        return np.zeros(0, np.uint64)
    g = np.zeros(len(h) - k + 1, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            g *= np.uint64(0x9E3779B97F4A7C15)
            g += h[j : len(h) - k + 1 + j]
        g ^= g >> np.uint64(31)
        g *= np.uint64(0xBF58476D1CE4E5B9)
        g ^= g >> np.uint64(29)
    return g


def runs(h: np.ndarray, off: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, hash) of every run of k words in the given documents."""
    g = rolling(h, k)
    n = np.maximum(np.diff(off)[docs] - k + 1, 0)
    doc = np.repeat(docs, n)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    return doc, place, g[off[doc] + place] ^ np.uint64(k * 0x632BE59BD9B4E019 % (1 << 64))


def _tiers(n: np.ndarray, docs: np.ndarray) -> list[tuple[np.ndarray, int, int]]:
    """(documents, words of a block, words of a run) of texts of the evaluation table; near SHORT a text belongs to both kinds, as a match may have fewer or more words."""
    n = n[docs]
    near = n < SHORT + SHORT // (ONE_IN - 1) + 1, n >= SHORT - SHORT // ONE_IN - 1
    return [(docs[near[0]], SHORT_BLOCK, SHORT_RUN), (docs[near[1]], BLOCK, RUN)]


def all_runs(h: np.ndarray, off: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Hashes of all runs of texts of the evaluation table."""
    return np.concatenate([runs(h, off, d, k)[2] for d, _, k in _tiers(np.diff(off), docs)])


def _order(g: np.ndarray, table: np.ndarray) -> np.ndarray:
    """By what runs are compared: the count in the table, then the hash."""
    return table[cell(g, len(table).bit_length() - 1)].astype(np.uint64) << np.uint64(48) | g >> np.uint64(16)


def winnow(doc: np.ndarray, order: np.ndarray, w: int) -> np.ndarray:
    """Which runs are the least (the first among equals) of some w neighbouring runs of one text."""
    windows = len(doc) - w + 1
    if windows < 1:
        return np.zeros(0, np.int64)
    least, at = order[:windows].copy(), np.zeros(windows, np.int64)
    for j in range(1, w):
        less = order[j : windows + j] < least
        least[less], at[less] = order[j : windows + j][less], j
    return np.unique((np.arange(windows) + at)[doc[:windows] == doc[w - 1 :]])


def asked(h: np.ndarray, off: np.ndarray, docs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, hash) of the fingerprints of texts of the evaluation table: the rarest run of every stretch as long as a block."""
    parts = []
    for d, block, k in _tiers(np.diff(off), docs):
        doc, place, g = runs(h, off, d, k)
        use = winnow(doc, _order(g, table), block - k + 1)
        parts.append((doc[use], place[use], g[use]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def most_edits(n: np.ndarray) -> np.ndarray:
    """The most edits between a text of n words and any text within the definition: a longer one has up to n // 9 words more."""
    return n // (ONE_IN - 1)


def blocks_of(n: np.ndarray) -> np.ndarray:
    """How many blocks a text of n words gives: one more than edits can break, which it always has from 9 words on."""
    return np.where(n >= ONE_IN - 1, most_edits(n) + 1, 0)


def cell(seed: np.ndarray, bits: int) -> np.ndarray:
    return (seed >> np.uint64(64 - bits)).astype(np.int64)


def signatures(h: np.ndarray, off: np.ndarray, doc: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Which of CONTEXT_BITS sets of words have an odd number of words in the CONTEXT words from each place on."""
    bits = np.uint64(1) << (h >> np.uint64(17)) % np.uint64(CONTEXT_BITS)
    before = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(bits)])
    n, a = np.diff(off)[doc], off[doc]
    rest = np.clip(place + CONTEXT - n, 0, n)
    return before[a + np.minimum(place + CONTEXT, n)] ^ before[a + place] ^ before[a + rest] ^ before[a]


def edits_in_context(doc: np.ndarray, start: np.ndarray, place: np.ndarray, n: np.ndarray) -> np.ndarray:
    """How many edits may lie in the context of each block; n: words of its text; all blocks that a text gives have to be there.

    A text's N blocks, each with the words up to the next one, the last with those up to the first, lie in a circle. With
    E < N edits at least N - E blocks are such that from each of them on, any j blocks in a row hold fewer than j edits
    (cycle lemma: steps 1 - edits have the sum N - E and none is above 1). So hits of other blocks needn't count.
    255 where a match may have fewer words than the context.
    """
    order = np.lexsort((start, doc))
    at = doc[order].astype(np.int64) << 31 | start[order]
    text = doc.astype(np.int64) << 31
    first, behind = np.searchsorted(at, text), np.searchsorted(at, text + PLACE)
    end = place + CONTEXT
    touched = np.searchsorted(at, text | np.minimum(end, n)) - np.searchsorted(at, text | start)
    touched += np.searchsorted(at, text | np.clip(end - n, 0, n)) - first
    return np.where(n - n // ONE_IN < CONTEXT, 255, np.minimum(touched, behind - first) - 1)


def chosen(h: np.ndarray, off: np.ndarray, docs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, hash, count, context) of the blocks by which texts of the training table look for near copies.

    A text is cut into blocks side by side. An edit breaks one block at most (a word put in between two breaks none), so of
    any most_edits + 1 blocks one is a stretch of every text within the definition, and the block's rarest run is one of that
    text's fingerprints (see `asked`). Those blocks are taken whose rarest runs are rarest; one whose run the evaluation table
    lacks (count 0) has its place among them, but isn't sent. Contexts are signatures with the edits allowed above them.
    """
    n = np.diff(off)
    parts = []
    for short, block, k in ((True, SHORT_BLOCK, SHORT_RUN), (False, BLOCK, RUN)):
        d = docs[(n[docs] < SHORT) == short]
        g = rolling(h, k) ^ np.uint64(k * 0x632BE59BD9B4E019 % (1 << 64))
        many = n[d] // block
        doc = np.repeat(d, many)
        start = (np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)) * block
        inside = (off[doc] + start)[:, None] + np.arange(block - k + 1)[None]
        least = _order(g[inside], table).argmin(1) if len(doc) else np.zeros(0, np.int64)
        parts.append((doc, start, start + least, g[inside[np.arange(len(doc)), least]]))
    doc, start, place, g = (np.concatenate(x) for x in zip(*parts, strict=True))
    count = table[cell(g, len(table).bit_length() - 1)]
    order = np.lexsort((g, count, doc))
    rank = np.arange(len(order)) - np.searchsorted(doc[order], doc[order])
    use = order[rank < blocks_of(n)[doc[order]]]
    room = edits_in_context(doc[use], start[use], place[use], n[doc[use]])
    sent = count[use] > 0
    use, room = use[sent], room[sent]
    context = signatures(h, off, doc[use], place[use]) | room.astype(np.uint64) << np.uint64(CONTEXT_BITS)
    return doc[use], place[use], g[use], count[use], context.view(np.int64)


_EDGES = np.unique(np.ceil((ONE_IN - 1) * LENGTH_STEP ** np.arange(90)).astype(np.int64))
_WIDTH = np.maximum(1, (np.append(_EDGES, 2 * _EDGES[-1]) * PLACE_SHARE).astype(np.int64))


def _length_class(n: np.ndarray) -> np.ndarray:
    return np.searchsorted(_EDGES, n, side="right")


def _place_class(centre: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Class of a place, as twice its distance from the middle of the text, among texts of a class of lengths."""
    return centre // _WIDTH[length]


def _within(seed: np.ndarray, length: np.ndarray, place: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = seed ^ (length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        x += place.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def _keys(seed: np.ndarray, side: int) -> np.ndarray:
    """What rows are joined and sorted by: the seed, then the side (0: evaluation table)."""
    return ((seed >> np.uint64(64 - SEED_BITS)).astype(np.int64) << 1) | side


def asked_rows(h: np.ndarray, off: np.ndarray, docs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, key, length and place, context) of the fingerprints of texts of the evaluation table."""
    doc, place, g = asked(h, off, docs, table)
    m = np.diff(off)[doc]
    hot = np.flatnonzero(table[cell(g, len(table).bit_length() - 1)] > HOT)
    length = _length_class(m[hot])
    g[hot] = _within(g[hot], length, _place_class(2 * place[hot] - m[hot], length))
    return doc, _keys(g, 0), m << 31 | place, signatures(h, off, doc, place).view(np.int64)


def chosen_rows(h: np.ndarray, off: np.ndarray, docs: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The same of the chosen blocks of texts of the training table; a hot run once for each class that may have a match."""
    doc, place, g, count, context = chosen(h, off, docs, table)
    n = np.diff(off)[doc]
    hot = count > HOT
    parts = [(doc[~hot], _keys(g[~hot], 1), (n << 31 | place)[~hot], context[~hot])]
    doc, place, g, n, context = doc[hot], place[hot], g[hot], n[hot], context[hot]
    most, centre = most_edits(n), 2 * place - n
    low, high = _length_class(n - n // ONE_IN), _length_class(n + most)
    for j in range(int((high - low).max(initial=0)) + 1):
        length = np.minimum(low + j, high)
        a, b = _place_class(centre - most, length), _place_class(centre + most, length)
        for q in range(int((b - a).max(initial=0)) + 1):
            ok = (low + j <= high) & (a + q <= b)
            parts.append((doc[ok], _keys(_within(g[ok], length[ok], (a + q)[ok]), 1), (n << 31 | place)[ok], context[ok]))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def text_hash(h: np.ndarray, off: np.ndarray, salt: int = 0x9FB21C651E98DF25) -> np.ndarray:
    """One hash of each sequence of words."""
    n = np.diff(off)
    out = np.zeros(len(n), np.uint64)
    full = np.flatnonzero(n)
    with np.errstate(over="ignore"):
        if len(full):
            pos = np.arange(len(h)) - np.repeat(off[:-1], n)
            out[full] = np.add.reduceat(tv.mix(((h >> np.uint64(32)) ^ h) & np.uint64(0xFFFFFFFF), pos) ^ (h * np.uint64(salt)), off[:-1][full])
        return out * np.uint64(0x9E3779B97F4A7C15) + n.astype(np.uint64)


def text_hashes(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each sequence of words, which together stand for it."""
    return text_hash(h, off), text_hash(h, off, 0xA24BAED4963EE407)


def _texts(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, int, list[str]]]:
    texts = [t or "" for t in batch.column(column).to_pylist()]
    for a, b in tv.groups([len(t) for t in texts], tv.PIECE):
        yield a, b, texts[a:b]


class _Fresh:
    """Which texts a task hasn't met yet; what it forgets only makes more candidates."""

    def __init__(self) -> None:
        self.seen: set[tuple[int, int]] = set()

    def of(self, a: np.ndarray, b: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        new = []
        for i, x in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
            if wanted[i] and x not in self.seen:
                self.seen.add(x)
                new.append(i)
        if len(self.seen) > 1 << 20:
            self.seen.clear()
        return np.array(new, np.int64)


def _binary(parts: np.ndarray, at: np.ndarray) -> pa.Array:
    """Binary cells that lie one after the other in an array, cut at the given bytes."""
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32).tobytes()), pa.py_buffer(parts.tobytes())])


def documents(rows: DataFrame) -> DataFrame:
    """Columns of DOC for rows (id, text): two hashes of the text's words, their number and their sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part in _texts(batch, 1):
                h, off = word_hashes(part)
                n = np.diff(off)
                counts = np.bincount(np.repeat(np.arange(b - a), n) * SKETCH + (h % np.uint64(SKETCH)).astype(np.int64), minlength=(b - a) * SKETCH)
                one, two = text_hashes(h, off)
                cells = [batch.column(0).slice(a, b - a), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(n.astype(np.int32)), _binary(np.minimum(counts, 255).astype(np.uint8), np.arange(b - a + 1) * SKETCH)]
                yield pa.RecordBatch.from_arrays(cells, names=["id", "h", "g", "n", "sketch"])

    return rows.mapInArrow(run, DOC)


def run_counts(rows: DataFrame, bits: int = TABLE_BITS) -> np.ndarray:
    """How often the runs of the evaluation table's different texts occur, added up in 2 ** bits cells up to 65535.

    A task adds up its texts and hands on its table in slices, which are summed slice by slice; the driver gets one table of
    fixed size, whatever the rows. Cells that several runs share only make some runs look less rare.
    """
    size, step = 1 << bits, (1 << bits) // SLICES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, fresh, waiting = np.zeros(size, np.uint32), _Fresh(), []

        def add() -> None:
            if waiting:
                counts[:] += np.bincount(np.concatenate(waiting), minlength=size).astype(np.uint32)
                waiting.clear()

        for batch in batches:
            for _, _, part in _texts(batch, 1):
                h, off = word_hashes(part)
                waiting.append(cell(all_runs(h, off, fresh.of(*text_hashes(h, off), np.diff(off) >= ONE_IN - 1)), bits))
                if sum(map(len, waiting)) > AT_ONCE:
                    add()
        add()
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([np.minimum(counts[i * step : (i + 1) * step], 65535).astype(np.uint16).tobytes() for i in range(SLICES)])], names=["slice", "counts"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for s, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                sums[s] = np.minimum(sums.get(s, np.zeros(step, np.uint32)) + np.frombuffer(c, np.uint16), 65535)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([x.astype(np.uint16).tobytes() for x in sums.values()], pa.binary())], names=["slice", "counts"])

    schema = "slice int, counts binary"
    out = np.zeros(size, np.uint16)
    for r in rows.mapInArrow(run, schema).repartition(8, "slice").mapInArrow(total, schema).collect():
        out[r["slice"] * step : (r["slice"] + 1) * step] = np.frombuffer(r["counts"], np.uint16)
    return out


def _packed(rows: np.ndarray) -> bytes:
    """Rows of numbers (their first two say how they are sorted) byte by byte, the first column as differences, compressed."""
    rows = np.ascontiguousarray(rows[:, np.lexsort((rows[1], rows[0]))])
    rows[0, 1:] -= rows[0, :-1].copy()
    return pa.Codec("zstd", 1).compress(rows.view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True)


def _unpacked(data: bytes, n: int, columns: int = 3) -> np.ndarray:
    planes = np.frombuffer(pa.Codec("zstd").decompress(data, n * columns * 8, asbytes=True), np.uint8)
    rows = np.ascontiguousarray(planes.reshape(8, -1).T).view(np.int64).reshape(columns, n)
    rows[0] = np.cumsum(rows[0])
    return rows


def _packets(rows: np.ndarray, part: np.ndarray, parts: int, side: int) -> pa.RecordBatch:
    """Rows as one packet for each part that has some."""
    order = np.argsort(part, kind="stable")
    at = np.searchsorted(part[order], np.arange(parts + 1))
    full = np.flatnonzero(np.diff(at))
    cells = [_packed(rows[:, order[at[i] : at[i + 1]]]) for i in full]
    return pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(np.full(len(full), side, np.int32)), pa.array(np.diff(at)[full].astype(np.int32)), pa.array(cells, pa.binary())], names=["part", "side", "n", "data"])


def seeds(rows: DataFrame, table: Broadcast, parts: int, side: int) -> DataFrame:
    """Columns of PACKET for rows (id, text): the seeds (key, meta, name of the text, context) of `asked_rows` (side 0) or `chosen_rows` (side 1), by one of `parts` parts of the keys.

    Seeds are many more than texts, so they travel packed. A text met before in the task gives none again.
    """
    find = chosen_rows if side else asked_rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh, waiting = _Fresh(), []

        def flush() -> pa.RecordBatch:
            found = np.concatenate(waiting, axis=1)
            waiting.clear()
            return _packets(found, (found[0] >> 1) % parts, parts, side)

        for batch in batches:
            for _, _, part in _texts(batch, 1):
                h, off = word_hashes(part)
                one, two = text_hashes(h, off)
                doc, key, meta, context = find(h, off, fresh.of(one, two, np.diff(off) >= ONE_IN - 1), table.value)
                waiting.append(np.stack([key, meta, (one >> np.uint64(64 - NAME_BITS)).astype(np.int64)[doc], context]))
                if sum(w.shape[1] for w in waiting) > AT_ONCE:
                    yield flush()
        if waiting:
            yield flush()

    return rows.mapInArrow(run, PACKET)


def _fitting(v: np.ndarray, t: np.ndarray) -> Iterator[np.ndarray]:
    """Rows it, iv, need for the rows of v and t, both sorted by key and meta, of one seed whose lengths, places and contexts (where they have them) fit."""
    if not t.shape[1] or not v.shape[1]:
        return
    each, at = np.unique(v[0] >> 1, return_inverse=True)
    j = np.searchsorted(each, t[0] >> 1)
    known = each[np.minimum(j, len(each) - 1)] == t[0] >> 1
    t, j = t[:, known], j[known]
    n = t[1] >> 31
    order = at << 31 | v[1] >> 31
    low = np.searchsorted(order, j << 31 | n - n // ONE_IN)
    count = np.searchsorted(order, j << 31 | n + most_edits(n), side="right") - low
    ends = np.cumsum(count)
    a = 0
    while a < len(count):
        e = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + AT_ONCE, side="right")))
        c = count[a:e]
        x = np.repeat(np.arange(a, e), c)
        y = np.arange(len(x)) - np.repeat(np.cumsum(c) - c, c) + np.repeat(low[a:e], c)
        m, before = v[1, y] >> 31, (t[1, x] & PLACE) - (v[1, y] & PLACE)
        most, apart = np.maximum(n[x], m) // ONE_IN, n[x] - m
        fit = np.flatnonzero((np.abs(apart) <= most) & (np.abs(before) + np.abs(apart - before) <= most))
        if len(t) > 3:
            # An edit changes at most two of the words that two contexts have.
            differ = np.bitwise_count((t[3, x[fit]] ^ v[3, y[fit]]) & ((1 << CONTEXT_BITS) - 1))
            fit = fit[differ <= 2 * (t[3, x[fit]] >> CONTEXT_BITS & 255)]
        x, y = x[fit], y[fit]
        yield np.stack([t[2, x], v[2, y], blocks_of(n[x]) - most[fit]])
        a = e


def hits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Rows it, iv, need for each chosen block and run of one seed that fit; rows (key, meta, id and, if wanted, context) come sorted by key and meta.

    Lengths fit where they differ by no more words than allowed, places where the words before the seed and those behind
    it together do. Of a seed's rows only those of the evaluation table are kept while its others pass by.
    """
    held = None
    for b in batches:
        rows = np.stack([np.asarray(c) for c in b.columns])
        if not rows.shape[1]:
            continue
        if held is not None:
            rows = np.concatenate([held[:, held[0] >> 1 == rows[0, 0] >> 1], rows], axis=1)
        v, t = rows[:, rows[0] & 1 == 0], rows[:, rows[0] & 1 == 1]
        held = v[:, v[0] >> 1 == rows[0, -1] >> 1]
        yield from _fitting(v, t)


def _distinct(parts: list[np.ndarray]) -> np.ndarray:
    """The different rows of some seeds, sorted by key and meta: copies of a text give the same ones."""
    rows = np.concatenate(parts, axis=1)
    rows = rows[:, np.lexsort((rows[2], rows[1], rows[0]))]
    return rows[:, np.concatenate([[True], (rows[:3, 1:] != rows[:3, :-1]).any(0)])]


def met(batches: Iterator[pa.RecordBatch], turn: int = 0, rounds: int = 1) -> Iterator[np.ndarray]:
    """The hits of packets of seeds, sorted by part and side, for the training texts of one round. A part's seeds of the evaluation table are held, the others pass by."""
    now, v, t = -1, [], []

    def hits() -> Iterator[np.ndarray]:
        if v and t:
            v[:] = [_distinct(v)] if len(v) > 1 else v
            yield from _fitting(v[0], _distinct(t))
        t.clear()

    for b in batches:
        for part, side, n, data in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if part != now:
                yield from hits()
                now = part
                v.clear()
            rows = _unpacked(data, n, 4)
            if side and rounds > 1:
                rows = rows[:, rows[2] % rounds == turn]
            if rows.shape[1]:
                (t if side else v).append(rows)
            if side and sum(x.shape[1] for x in t) > AT_ONCE:
                yield from hits()
    yield from hits()


def candidates(train: DataFrame, val: DataFrame, parts: int, rounds: int = 1) -> DataFrame:
    """Pairs (it, iv) of names of texts that share as many chosen blocks as the edits allowed must leave; train and val have the columns of PACKET.

    Hits are many more than pairs, so they travel packed, by one of `parts` parts of the training texts, and a task counts them part by part.
    In several rounds, each for some of the training texts, only the hits of one lie on disk at a time.
    """

    def meet(batches: Iterator[pa.RecordBatch], turn: int) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            hits = np.concatenate(waiting, axis=1)
            waiting.clear()
            part = (tv.mix(hits[0].astype(np.uint64) & np.uint64(0xFFFFFFFF), hits[0] >> 32) % np.uint64(parts)).astype(np.int64)
            return _packets(hits, part, parts, 1)

        for hits in met(batches, turn, rounds):
            waiting.append(hits)
            if sum(h.shape[1] for h in waiting) > AT_ONCE:
                yield flush()
        if waiting:
            yield flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = -1, []

        def pairs() -> pa.RecordBatch:
            hits = np.concatenate(held, axis=1) if held else np.zeros((3, 0), np.int64)
            hits = hits[:, np.lexsort((hits[2], hits[1], hits[0]))]
            first = np.flatnonzero(np.concatenate([[True], (hits[:2, 1:] != hits[:2, :-1]).any(0)])) if hits.shape[1] else np.zeros(0, np.int64)
            enough = first[np.diff(np.append(first, hits.shape[1])) >= hits[2, first]]
            return pa.RecordBatch.from_arrays([pa.array(hits[0, enough]), pa.array(hits[1, enough])], names=["it", "iv"])

        for b in batches:
            for part, n, data in zip(*(b.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if part != now:
                    yield pairs()
                    now, held = part, []
                held.append(_unpacked(data, n))
        yield pairs()

    def pairs_of(turn: int) -> DataFrame:
        hits = both.mapInArrow(lambda batches: meet(batches, turn), PACKET)
        return hits.repartition("part").sortWithinPartitions("part").mapInArrow(count, "it bigint, iv bigint")

    both = train.union(val).repartition("part").sortWithinPartitions("part", "side")
    if rounds == 1:
        return pairs_of(0)
    both = cut(both)
    found = []
    for turn in range(rounds):
        drop_unused(both.sparkSession)
        found.append(cut(pairs_of(turn)))
    return reduce(DataFrame.union, found)


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, SKETCH).astype(np.int16)


def plausible(pairs: DataFrame, train: DataFrame, val: DataFrame) -> DataFrame:
    """The pairs of different texts whose sketches differ by no more words than allowed: a bound on the edits from below, so no match is lost.

    pairs: of names; train, val: columns of DOC. Returns it, iv (a row of each text), ht, gt, hv, gv.
    """

    def texts(docs: DataFrame, side: str) -> DataFrame:
        named = docs.withColumn("name", F.shiftrightunsigned("h", 64 - NAME_BITS))
        wanted = named.join(small_broadcast(pairs.select(F.col(f"i{side}").alias("name")).distinct()), "name", "left_semi")
        return wanted.groupBy("name", "h", "g", "n", "sketch").agg(F.min("id").alias("id")).select(F.col("name").alias(f"i{side}"), *[F.col(c).alias(c[0] + "_" + side) for c in ("id", "h", "g", "n", "sketch")])

    both = pairs.join(small_broadcast(texts(train, "t")), "it").join(small_broadcast(texts(val, "v")), "iv").where("h_t <> h_v OR g_t <> g_v").select("i_t", "i_v", "h_t", "g_t", "h_v", "g_v", "n_t", "n_v", "s_t", "s_v")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            most = np.maximum(np.asarray(b.column(6)), np.asarray(b.column(7))) // ONE_IN
            diff = _sketches(b.column(8)) - _sketches(b.column(9))
            keep = pa.array((diff.clip(0).sum(1) <= most) & ((-diff).clip(0).sum(1) <= most))
            yield pa.RecordBatch.from_arrays([b.column(k).filter(keep) for k in range(6)], names=["it", "iv", "ht", "gt", "hv", "gv"])

    return both.mapInArrow(run, "it bigint, iv bigint, ht bigint, gt bigint, hv bigint, gv bigint")


def edits(x: list[int], y: list[int]) -> int:
    """Edit distance of two sequences, bit-parallel over the shorter one."""
    if len(x) > len(y):
        x, y = y, x
    if not x:
        return len(y)
    at: dict[int, int] = {}
    for i, word in enumerate(x):
        at[word] = at.get(word, 0) | 1 << i
    mask, top = (1 << len(x)) - 1, 1 << (len(x) - 1)
    up, down, score = mask, 0, len(x)
    for word in y:
        eq = at.get(word, 0)
        vert = eq | down
        diag = (((eq & up) + up) ^ up) | eq
        more = down | (~(diag | up) & mask)
        less = up & diag
        score += bool(more & top) - bool(less & top)
        more, less = (more << 1 | 1) & mask, less << 1 & mask
        up, down = less | (~(vert | more) & mask), more & vert
    return score


def align(x: list[int], y: list[int], k: int = 5) -> tuple[int, int] | None:
    """(edits, words of y in unchanged runs) of two texts that differ in at most a tenth of the longer one, else None.

    Runs of k words that both have once are chained in order near the diagonal, grown while words agree, and the gaps
    between them are aligned. The chain may miss the best alignment, so where it finds too many edits, the whole is aligned.
    """
    most = max(len(x), len(y)) // ONE_IN
    if abs(len(x) - len(y)) > most:
        return None
    count = Counter(x)
    count.subtract(y)
    if sum(c for c in count.values() if c > 0) > most or -sum(c for c in count.values() if c < 0) > most:
        return None
    where: dict[tuple, int] = {}
    for j in range(len(y) - k + 1):
        g = tuple(y[j : j + k])
        where[g] = -1 if g in where else j
    tails, links, chain = [], [], []
    for i in range(len(x) - k + 1):
        j = where.get(tuple(x[i : i + k]), -1)
        if j < 0 or abs(i - j) > most:
            continue
        at = bisect_left(tails, j)
        if at == len(tails):
            tails.append(j)
            chain.append(len(links))
        else:
            tails[at] = j
            chain[at] = len(links)
        links.append((i, j, chain[at - 1] if at else -1))
    path, at = [], chain[-1] if chain else -1
    while at >= 0:
        i, j, at = links[at]
        path.append((i, j))
    total, covered, px, py = 0, 0, 0, 0
    for i, j in [*reversed(path), (len(x), len(y))]:
        if i < px or j < py:
            continue
        a, b = i, j
        while a > px and b > py and x[a - 1] == y[b - 1]:
            a, b = a - 1, b - 1
        total += edits(x[px:a], y[py:b])
        if total > most:
            break
        px, py = i, j
        while px < len(x) and py < len(y) and x[px] == y[py]:
            px, py = px + 1, py + 1
        covered += px - a
    if total > most:
        total = edits(x, y)
        if total > most:
            return None
        covered = len(y) - total
    return total, covered


def same_text(train: DataFrame, val: DataFrame, table_bits: int = TABLE_BITS, in_round: int = IN_ROUND) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links, train texts, val texts) for rows (id, text) of both sides.

    links: ht, gt, hv, gv, edits, covered for each pair of different texts of which at most a tenth of the longer one's words
    differ; texts: id, h, g, n, with equal h and g for equal texts (n = 0: no words, matches nothing). Texts, not rows, are
    joined: they are named by their hashes from the seeds on, and copies' seeds are dropped where they meet, so the result
    doesn't depend on partitions. `table_bits` (of the counts by which blocks are chosen) and `in_round` bear on the work only.
    """
    table = train.sparkSession.sparkContext.broadcast(run_counts(val, table_bits))
    t, v = cut(documents(train)), cut(documents(val))
    (rows, words_t), (rows_v, words_v) = (df.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first() for df in (t, v))
    # A text of train has a seed for about 9 of its words, one of val 2 for 3.
    parts = max(128, (words_t // (ONE_IN - 1) + words_v * 2 // 3) // IN_PART)
    named = cut(plausible(cut(candidates(seeds(train, table, parts, 1), seeds(val, table, parts, 0), max(64, rows >> 16), 1 + rows_v // in_round)), t, v))

    def words(rows: DataFrame, side: str) -> DataFrame:
        """(h, g, w) of each text in `named`, from one of its rows; the names end in the side."""
        wanted = named.select(F.col(f"i{side}").alias("id")).distinct()
        text = rows.join(small_broadcast(wanted), "id", "left_semi")
        names = [x + side for x in "hgw"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, _, part in _texts(batch, 1):
                    w, off = word_hashes(part)
                    one, two = (pa.array(x.view(np.int64)) for x in text_hashes(w, off))
                    yield pa.RecordBatch.from_arrays([one, two, pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(w.view(np.int64)))], names=names)

        return text.mapInArrow(run, f"{names[0]} bigint, {names[1]} bigint, {names[2]} array<bigint>").dropDuplicates(names[:2])

    both = named.select("ht", "gt", "hv", "gv").distinct().join(words(val, "v"), ["hv", "gv"]).join(words(train, "t"), ["ht", "gt"]).select("ht", "gt", "hv", "gv", "wt", "wv")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, out = [], []
            for i, (x, y) in enumerate(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True)):
                if found := align(x, y):
                    keep.append(i)
                    out.append(found)
            new = [pa.array([f[k] for f in out], pa.int64()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k).take(pa.array(keep, pa.int64())) for k in range(4)), *new], names=["ht", "gt", "hv", "gv", "edits", "covered"])

    links = cut(both.mapInArrow(verify, "ht bigint, gt bigint, hv bigint, gv bigint, edits bigint, covered bigint"))
    return links, t.select("id", "h", "g", "n"), v.select("id", "h", "g", "n")


def same_frames(train: DataFrame, val: DataFrame) -> DataFrame:
    """(train_id, val_id, frames) of rows (id, game, frames) of the same game where the train row has at least half of the val row's frames; `frames` counts them.

    A pair that shares half of a val row's m frames has one among its m - ceil(m / 2) + 1 frames that are rarest in
    train, so only those are joined; a frame of very many rows is used only where the row has no rarer ones. Pairs found
    are checked on the whole lists. Rows without a game or frames match nothing.
    """
    key = lambda df: df.select("id", F.explode("frames").alias("f"), "game", "frames").select("id", F.xxhash64("game", "f").alias("k"), F.size("frames").alias("m"))
    train, val = (df.where("game IS NOT NULL AND size(frames) > 0") for df in (train, val))
    vk = key(val)
    # Train's other frames play no part.
    tk = cut(key(train).select("id", "k").join(small_broadcast(vk.select("k").distinct()), "k", "left_semi"))
    often = tk.groupBy("k").agg(F.count("*").alias("c"))
    ranked = vk.join(small_broadcast(often), "k").groupBy("id", "m").agg(F.array_sort(F.collect_list(F.struct("c", "k"))).alias("found"))
    # Frames that train lacks are the rarest, so they use up places of the m - ceil(m / 2) + 1.
    use = F.col("m") - F.ceil(F.col("m") / 2) + 1 - (F.col("m") - F.size("found"))
    rarest = cut(ranked.where(use > 0).select(F.col("id").alias("val_id"), F.explode(F.slice("found", F.lit(1), use.cast("int"))["k"]).alias("k")))
    pairs = cut(spread_join(tk.join(small_broadcast(rarest.select("k").distinct()), "k", "left_semi"), rarest, ["k"]).select(F.col("id").alias("train_id"), "val_id").distinct())
    train, val = (df.join(small_broadcast(pairs.select(F.col(i).alias("id")).distinct()), "id", "left_semi") for df, i in ((train, "train_id"), (val, "val_id")))
    full = pairs.join(val.select(F.col("id").alias("val_id"), F.col("game").alias("vg"), F.col("frames").alias("vf")), "val_id").join(
        train.select(F.col("id").alias("train_id"), "game", F.col("frames").alias("tf")), "train_id"
    )
    common = F.size(F.array_intersect("vf", "tf"))
    return full.where((F.col("vg") == F.col("game")) & (2 * common >= F.size("vf"))).select("train_id", "val_id", common.alias("frames"))


def overlaps(train: DataFrame, val: DataFrame, channels: DataFrame, shared_frames: DataFrame) -> DataFrame:
    """Every pair of a train row and a val row that show the same sample.

    Returns train_id, val_id, edits (words; null where the texts don't match), covered (share of the val row's words in
    unchanged runs), frames (of the val row that the train row has; null where fewer than half). Rows without text match
    nothing by text, rows without own frames or a known game nothing by frames; rows with a null id are left out. Copies
    of a text are joined as one text and only the found pairs are spread to the rows, as the result has a row for each.
    """
    shared = shared_keys(shared_frames)
    side = lambda df, i: df.where(F.col(i).isNotNull()).select(F.col(i).alias("id"), spoken(F.col("messages")).alias("text"))
    links, t, v = same_text(side(train, "train_id"), side(val, "val_id"))
    t, v = t.where("n > 0").select(F.col("id").alias("train_id"), F.col("h").alias("ht"), F.col("g").alias("gt")), v.where("n > 0").select(F.col("id").alias("val_id"), F.col("h").alias("hv"), F.col("g").alias("gv"), "n")
    same = spread_join(t, v.select("val_id", F.col("hv").alias("ht"), F.col("gv").alias("gt")), ["ht", "gt"])
    equal = same.select("train_id", "val_id", F.lit(0).cast("bigint").alias("edits"), F.lit(1.0).alias("covered"))
    near = spread_join(t, spread_join(v, links, ["hv", "gv"]), ["ht", "gt"]).select("train_id", "val_id", "edits", (F.col("covered") / F.col("n")).alias("covered"))
    named = lambda df, i: with_known_game(df.where(F.col(i).isNotNull()).select(F.col(i).alias("id"), "channel", "game", "images"), channels, "known")
    shots = lambda df, i: named(df, i).select("id", F.col("known").alias("game"), own_frames(F.col("images"), shared).alias("frames"))
    seen = same_frames(cut(shots(train, "train_id")), cut(shots(val, "val_id")))
    none = F.lit(None)
    both = equal.union(near).select("*", none.cast("int").alias("frames")).union(seen.select("train_id", "val_id", none.cast("bigint"), none.cast("double"), "frames"))
    return both.groupBy("train_id", "val_id").agg(F.min("edits").alias("edits"), F.max("covered").alias("covered"), F.max("frames").alias("frames"))


def overlap_report(found: DataFrame, val: DataFrame, channels: DataFrame) -> DataFrame:
    """By package and channel of val: rows, rows found in train by text, by frames and at all, and the mean covered share of those found by text."""
    each = found.groupBy("val_id").agg(F.count("*").alias("pairs"), F.max("covered").alias("covered"), F.max("frames").alias("frames"))
    rows = with_known_game(val.select("val_id", "package", "channel", "game"), channels, "known").select("val_id", "package", F.col("known").alias("channel"))
    return rows.join(each, "val_id", "left").groupBy("package", "channel").agg(
        F.count("*").alias("rows"), F.count("pairs").alias("found"), F.count("covered").alias("by_text"), F.count("frames").alias("by_frames"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("pairs"), F.avg("covered").alias("mean_covered"),
    )
