"""Problem 7: statistics of each text and whether it is prose, by fixed thresholds line by line."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loomspark.llm import textvec as tv
from loomspark.llm.textvec import mix
from loomspark.llm.words import HAN_RANGES
from loomspark.session import small_rows

#: Fixed thresholds of the rules. Shares are of a line's signs without white space, or of its words.
SYMBOL_SHARE, GARBLED_SHARE = 0.22, 0.05
CLOSED_COMMON_WORDS, CLOSED_SENTENCE, FIELDS, ITEM_NUMBER = 0.08, 40, 2, 4
WRAP_WIDTH, WRAP_FILL = 100, 0.7
COMMON_WORDS, COMMON_HAN, COMMON_HAN_SENTENCE = 0.17, 0.10, 0.04
SHORT_WORDS, SHORT_HAN, ITEM_WORDS, ITEM_HAN, APART_WORDS, LONG_WORD = 9, 25, 5.5, 9, 12, 20
REPEATED_RUN, REPEATED_SHARE, DISTINCT_SHARE = 12, 0.5, 0.3
NOT_PROSE_SHARE = 0.5

#: Fixed thresholds of the published rules for whole texts (Rae et al. 2021, appendix A1): words, mean word length, hashes and
#: ellipses a word, lines that begin with a bullet or end in an ellipsis, words with a letter, and function words.
WORD_COUNT, WORD_LENGTH, SIGNS_PER_WORD, BULLET_LINES, ELLIPSIS_LINES, ALPHABETIC_WORDS, STOP_WORDS = (50, 100_000), (3, 10), 0.1, 0.9, 0.3, 0.8, 2
#: Of the same appendix, on repetition: lines that repeat an earlier one, their signs, and signs of words in runs of ten words that occur before.
SAME_LINES, SAME_LINE_SIGNS, SAME_TENS, TEN = 0.3, 0.2, 0.1, 10
#: Penedo et al. 2024 (FineWeb): least share of lines that end in punctuation; most share of lines of at most so many signs.
CLOSED_LINES, SHORT_LINES, SHORT_LINE = 0.12, 0.67, 30
RULES = [
    "too_few_words", "too_many_words", "word_length", "signs_per_word", "bullet_lines", "ellipsis_lines", "alphabetic_words", "stop_words",
    "same_lines", "same_line_signs", "same_tens", "closed_lines", "short_lines",
]

REASONS = ["list", "table", "symbols", "actions", "words", "garbled", "repetition", "empty"]
LIST, TABLE, SYMBOLS, ACTIONS, WORDS, GARBLED, REPETITION, EMPTY = range(len(REASONS))

#: Kinds of code points.
GAP, SIGN, LETTER, DIGIT, HAN, END, MARK, SEPARATOR, ODD, LINE = range(10)
LINE_ENDS = [10, 11, 12, 13, 28, 29, 30, 133, 0x2028, 0x2029]
SENTENCE_ENDS, HAN_ENDS = ".!?…", "。！？｡"
SEPARATORS = ",;/|·•、，；"
BETWEEN = "/|·•"
MARKS = "'\"()-–—:：‘’“”«»¿¡（）《》「」『』～%&*#"
BULLETS = "-*•·–—‣▪◦"
SPANS = re.compile(r"<\|action_start\|>.*?(?:<\|action_end\|>|$)|<table\b.*?(?:</table>|$)", re.DOTALL | re.IGNORECASE)
MARKUP = re.compile(r"<\|(?:thought|im)_(?:start|end)\|>|<image>|<\|endoftext\|>", re.IGNORECASE)

_tables: dict[str, np.ndarray] = {}


def kinds() -> np.ndarray:
    """Kind of every code point: letters and marks, digits, Han signs, ends of sentences, usual marks, separators, white space, ends of lines, controls, and other signs."""
    if "kind" not in _tables:
        by = {"L": LETTER, "M": LETTER, "N": DIGIT, "Z": GAP}
        t = np.fromiter((by.get(unicodedata.category(chr(i))[0], SIGN) for i in range(0x110000)), np.uint8, 0x110000)
        for i in range(0x110000):
            if unicodedata.category(chr(i)) in ("Cc", "Cn", "Co", "Cs"):
                t[i] = ODD
            elif unicodedata.category(chr(i)) == "Cf":
                t[i] = GAP
        for a, b in HAN_RANGES:
            t[a : b + 1] = HAN
        for kind, signs in ((END, SENTENCE_ENDS + HAN_ENDS), (MARK, MARKS), (SEPARATOR, SEPARATORS)):
            t[[ord(c) for c in signs]] = kind
        t[[9, 31, *tv.WHITE_SPACE]] = GAP
        t[LINE_ENDS] = LINE
        t[0xFFFD] = ODD
        t[0xFE0F] = GAP
        _tables["kind"] = t
    return _tables["kind"]


class Common:
    """Function words of all languages as word hashes, and function signs among Han signs."""

    def __init__(self, words: list[str]):
        folded = [unicodedata.normalize("NFKC", w).lower() for w in words if w]
        self.han = np.unique(np.array([ord(w) for w in folded if len(w) == 1 and kinds()[ord(w)] == HAN], np.uint32))
        spaced = sorted({w for w in folded if not (len(w) == 1 and kinds()[ord(w)] == HAN)} | {strip_accents(w) for w in folded})
        flat = "".join(spaced)
        lens = np.array([len(w) for w in spaced], np.int64)
        starts = np.cumsum(lens) - lens
        codes = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
        pos = np.arange(len(codes)) - np.repeat(starts, lens)
        self.words = np.unique(np.add.reduceat(mix(codes, pos), starts)) if len(spaced) else np.zeros(0, np.uint64)


def strip_accents(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", word) if not unicodedata.combining(c))


def _sum(at: np.ndarray, weights: np.ndarray | None, n: int) -> np.ndarray:
    return np.bincount(at, weights, n) if len(at) else np.zeros(n)


def _member(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    return table[np.minimum(np.searchsorted(table, values), len(table) - 1)] == values


def measure(texts: list[str], common: Common) -> dict[str, np.ndarray]:
    """Statistics and verdict of each text; the arrays have one entry for each text."""
    # Each text ends its last line, so that no rule looks into the next one.
    texts = [MARKUP.sub(" ", unicodedata.normalize("NFC", t)) + "\n" for t in texts]
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    off = np.concatenate([[0], np.cumsum(lens)])
    n = int(off[-1])
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    lower = np.frombuffer("".join(map(_lower, texts)).encode("utf-32-le", "surrogatepass"), np.uint32)
    kind = kinds()[codes]
    doc_of = np.repeat(np.arange(len(texts)), lens)
    # Units are lines; spans of actions and of markup tables are units of their own.
    begin = np.zeros(n + 1, bool)
    begin[off] = True
    is_line = kind == LINE
    begin[1:][is_line] = True
    span = np.zeros(n, np.int8)
    for i, t in enumerate(texts):
        if "<" in t:
            for m in SPANS.finditer(t):
                a, b = off[i] + m.start(), off[i] + m.end()
                begin[[a, b]] = True
                span[a:b] = 1 if m.group().lower().startswith("<|a") else 2
    starts = np.flatnonzero(begin[:n])
    units = len(starts)
    if not units:
        return _results(texts, off, doc_of, {}, np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
    unit = np.cumsum(begin[:n]) - 1
    doc = doc_of[starts]
    count = lambda mask: _sum(unit[mask], None, units)
    solid = (kind != GAP) & (kind != LINE)
    size, letters, digits, han = count(solid), count(kind == LETTER), count(kind == DIGIT), count(kind == HAN)
    signs, odd, seps = count(kind == SIGN), count(kind == ODD), count(kind == SEPARATOR)
    # Words: runs of letters and digits; those of digits only aren't words.
    inside = (kind == LETTER) | (kind == DIGIT)
    first = inside.copy()
    first[1:] &= ~inside[:-1] | begin[1:n]
    flat = np.flatnonzero(inside)
    word_at = np.flatnonzero(first)
    wid = np.cumsum(first)[flat] - 1
    pos = flat - word_at[wid]
    has_letter = _sum(wid[kind[flat] == LETTER], None, len(word_at)) > 0
    hashes = np.zeros(len(word_at), np.uint64)
    if len(flat):
        hashes = np.add.reduceat(mix(lower[flat], pos), np.searchsorted(wid, np.arange(len(word_at))))
    word_unit = unit[word_at]
    words = _sum(word_unit[has_letter], None, units)
    common_words = _sum(word_unit[_member(hashes, common.words) & has_letter], None, units)
    common_han = count((kind == HAN) & _member(codes, common.han))
    # Ends of sentences: after a letter, a Han sign or a closing mark, not inside a word or number.
    before = np.empty(n, np.uint8)
    before[0] = GAP
    before[1:] = kind[:-1]
    after = np.full(n, LINE, np.uint8)
    after[:-1] = kind[1:]
    before[starts] = GAP  # neither side looks beyond its line, or its text
    after[starts[1:] - 1] = LINE
    end = (kind == END) & ((before == LETTER) | (before == HAN) | (before == MARK) | (before == END)) & (after != LETTER) & (after != DIGIT)
    # After a number only where it can't be the number of an item.
    end |= (kind == END) & (before == DIGIT) & ((after == GAP) | (after == LINE)) & (np.arange(n) - starts[unit] > ITEM_NUMBER)
    end |= np.isin(codes, [ord(c) for c in HAN_ENDS])
    ends = count(end)
    tab = codes == 9
    blank = kind == GAP
    gap3 = np.zeros(n, bool)
    if n > 2:
        wide = blank[:-2] & blank[1:-1] & blank[2:]
        gap3[2:] = wide
        gap3[3:] &= ~wide[:-1]
    gap2 = np.zeros(n, bool)
    if n > 2:
        gap2[2:] = blank[1:-1] & blank[:-2] & ~blank[2:]
        gap2[3:] &= ~blank[:-3]
    wide_gaps = count(gap3)
    columns = wide_gaps + np.where(wide_gaps > 0, count(gap2), 0) + 2 * count(tab)
    pipes = count(codes == ord("|"))
    fields = count(codes == ord("="))
    apart = np.isin(codes, [ord(c) for c in BETWEEN])
    if n > 2:
        apart[1:-1] &= blank[:-2] & blank[2:]
        apart[[0, -1]] = False
    items = count(apart)
    last_solid = np.full(units, -1)
    at = np.flatnonzero(solid)
    last_solid[unit[at]] = at
    first_solid = np.full(units, -1)
    first_solid[unit[at[::-1]]] = at[::-1]
    closes = np.zeros(units, bool)
    full = last_solid >= 0
    closes[full] = end[last_solid[full]] | ((kind[last_solid[full]] == MARK) & (np.where(last_solid[full] > 0, end[last_solid[full] - 1], False)))
    closes |= full & (np.where(full, kind[np.maximum(last_solid, 0)], 0) == END)
    bullet = np.zeros(units, bool)
    bullet[full] = np.isin(codes[first_solid[full]], [ord(c) for c in BULLETS])

    dots = np.isin(codes, [ord("…"), ord("#")])
    three = np.zeros(n, bool)
    if n > 2:
        dot = codes == ord(".")
        three[2:] = dot[:-2] & dot[1:-1] & dot[2:]
        three[3:] &= ~dot[:-3]
    trails = np.zeros(units, bool)
    trails[full] = (codes[last_solid[full]] == ord("…")) | ((codes[last_solid[full]] == ord(".")) & (np.where(last_solid[full] > 1, codes[last_solid[full] - 1] == ord("."), False)))

    # The rules; the first that holds gives a line's reason.
    reason = np.full(units, -1)
    safe = np.maximum(size, 1)
    chinese = han * 2 > letters
    w = np.maximum(words, 1)
    unit_span = span[starts]
    short = ~chinese & (ends == 0) & (words <= SHORT_WORDS) | chinese & (ends == 0) & (han < SHORT_HAN)
    tiny = (ends > 0) & np.where(chinese, han < 6, words < 4)
    for hit, why in (
        (unit_span == 1, ACTIONS),
        (unit_span == 2, TABLE),
        (odd > GARBLED_SHARE * safe, GARBLED),
        ((pipes >= 3) | (fields >= FIELDS) & (ends == 0) | (columns >= 2) & (words + han > 0) & (ends == 0), TABLE),
        (signs + digits > SYMBOL_SHARE * safe, SYMBOLS),
        ((words == 0) & (han == 0), SYMBOLS),
        (~chinese & (letters > LONG_WORD * w), WORDS),
        ((ends == 0) & (items > 1) & (words + han <= (items + 1) * APART_WORDS), LIST),
        (~chinese & (ends == 0) & (words > 5) & (seps > 1) & (seps * ITEM_WORDS >= words), LIST),
        (chinese & (ends == 0) & (seps > 1) & (han <= seps * ITEM_HAN), LIST),
        (~chinese & (words > 5) & (common_words < np.where(ends * CLOSED_SENTENCE >= words, CLOSED_COMMON_WORDS, COMMON_WORDS) * words), WORDS),
        (chinese & (ends > 0) & (han > 5) & (common_han < COMMON_HAN_SENTENCE * han), WORDS),
        (chinese & (ends == 0) & ~short & (common_han < COMMON_HAN * han), WORDS),
    ):
        reason[(reason < 0) & (size > 0) & hit] = why
    # Lines of one width in which sentences end are prose that is wrapped, whatever one line looks like.
    width = np.bincount(unit[kind != LINE], minlength=units)[:units]
    par = np.cumsum(np.concatenate([[True], (size[1:] == 0) | (size[:-1] == 0) | (doc[1:] != doc[:-1]) | (unit_span[1:] != unit_span[:-1])])) - 1
    pars = int(par[-1]) + 1
    widest = np.zeros(pars)
    np.maximum.at(widest, par, width)
    last_of = np.concatenate([par[1:] != par[:-1], [True]])
    narrow = _sum(par[~last_of & (width < WRAP_FILL * widest[par])], None, pars)
    par_words, par_ends, par_lines = _sum(par, words + han, pars), _sum(par, ends, pars), _sum(par[size > 0], None, pars)
    wrapped = (par_lines > 1) & (narrow == 0) & (widest <= WRAP_WIDTH) & (par_ends > 0) & (par_ends * CLOSED_SENTENCE >= par_words) & (unit_span[np.searchsorted(par, np.arange(pars))] == 0)
    rescued = wrapped[par] & ((reason == WORDS) | (reason == LIST))
    reason[rescued] = -1
    # Three short lines in a row without an end of sentence are a list, unless the text's short lines read on as sentences.
    open_ = (reason < 0) & (size > 0)
    loose = open_ & (short | tiny)
    d = len(texts)
    loose_words = _sum(doc[loose], (words + han)[loose], d)
    reads_on = (_sum(doc[loose], ends[loose], d) * 30 >= loose_words) & (_sum(doc[loose], (common_words + common_han)[loose], d) >= 0.22 * _sum(doc[loose], words[loose], d) + COMMON_HAN * _sum(doc[loose], han[loose], d))
    solid_units = np.flatnonzero(size > 0)
    s = (short & open_ & ~wrapped[par])[solid_units] & ~reads_on[doc[solid_units]]
    item = s | (reason[solid_units] >= 0)
    change = np.ones(len(solid_units), bool)
    change[1:] = (item[1:] != item[:-1]) | (doc[solid_units][1:] != doc[solid_units][:-1])
    run = np.cumsum(change) - 1
    long_run = np.bincount(run)[run] >= 3 if len(run) else np.zeros(0, bool)
    reason[solid_units[s & long_run]] = LIST
    stats = {
        "words": _sum(doc, words + han, d), "letters": _sum(doc, letters + han, d), "signs": _sum(doc, signs + odd, d), "common": _sum(doc, common_words + common_han, d),
        "lines": _sum(doc[size > 0], None, d), "closed": _sum(doc[closes], None, d), "bullets": _sum(doc[bullet], None, d), "size": _sum(doc, size, d), "trails": _sum(doc[trails], None, d),
        "numbers": _sum(doc_of[word_at[~has_letter]], None, d), "spaced": _sum(doc, words, d), "spaced_letters": _sum(doc, letters, d), "dots": _sum(doc_of[dots | three], None, d),
    }
    # Lines that say what an earlier line of their text says.
    line_of = np.cumsum(np.concatenate([[False], is_line[:-1]]) | (np.arange(n) == np.repeat(off[:-1], lens))) - 1 if n else np.zeros(0, np.int64)
    said_by = np.zeros(int(line_of[-1]) + 1 if n else 0, np.uint64)
    line_at = np.searchsorted(line_of, np.arange(len(said_by)))
    solid_at = np.flatnonzero(solid)
    with np.errstate(over="ignore"):
        place = solid_at - line_at[line_of[solid_at]]
        np.add.at(said_by, line_of[solid_at], mix(lower[solid_at], place))
    line_size, line_doc = np.bincount(line_of[solid_at], minlength=len(said_by)), doc_of[line_at]
    order = np.lexsort((np.arange(len(said_by)), said_by, line_doc))
    order = order[line_size[order] > 0]
    same = order[1:][(said_by[order][1:] == said_by[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])]
    line_width = np.bincount(line_of[kind != LINE], minlength=len(said_by))
    stats |= {
        "whole_lines": _sum(line_doc[line_size > 0], None, d), "same_lines": _sum(line_doc[same], None, d), "same_line_signs": _sum(line_doc[same], line_size[same], d),
        "short_lines": _sum(line_doc[(line_size > 0) & (line_width <= SHORT_LINE)], None, d),
    }
    # Sequences of words and Han signs, for what repeats.
    tokens = np.concatenate([hashes, codes[kind == HAN].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)])
    places = np.concatenate([word_at, np.flatnonzero(kind == HAN)])
    order = np.argsort(places, kind="stable")
    tokens, places = tokens[order], places[order]
    again, tens = _again(tokens, doc_of[places]), _again(tokens, doc_of[places], TEN)
    long = np.concatenate([np.diff(np.append(np.searchsorted(wid, np.arange(len(word_at))), len(flat))), np.ones(int((kind == HAN).sum()))])[order]
    stats["same_tens"] = _sum(doc_of[places], long * _covered(tens, len(places), TEN), d)
    # A sign that is no word goes with the word before it.
    owner = np.searchsorted(places, np.arange(n), side="right") - 1
    said = np.zeros(n, bool)
    if len(places):
        said = (owner >= 0) & (doc_of[places[owner]] == doc_of) & _covered(again, len(places))[owner]
    repeated = _sum(doc_of[solid & said & (reason[unit] < 0)], None, d)
    return _results(texts, off, doc_of, stats, doc, size, reason, tokens, doc_of[places], again, repeated)


def _lower(text: str) -> str:
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def _again(tokens: np.ndarray, doc: np.ndarray, k: int = REPEATED_RUN) -> np.ndarray:
    """Places of the runs of k words that occur before in their text."""
    if len(tokens) < k:
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        g = np.zeros(len(tokens) - k + 1, np.uint64)
        for j in range(k):
            g = g * np.uint64(0x9E3779B97F4A7C15) + tokens[j : len(tokens) - k + 1 + j]
    whole = np.flatnonzero(doc[: len(g)] == doc[k - 1 :])
    order = whole[np.lexsort((g[whole], doc[whole]))]
    same = (doc[order][1:] == doc[order][:-1]) & (g[order][1:] == g[order][:-1])
    return order[1:][same]


def _covered(again: np.ndarray, n: int, k: int = REPEATED_RUN) -> np.ndarray:
    """Which of n words are in the runs of k words at the given places."""
    change = np.bincount(again, minlength=n + 1)[: n + 1] - np.bincount(again + k, minlength=n + 1)[: n + 1]
    return np.cumsum(change)[:n] > 0


def _repeats(tokens: np.ndarray, doc: np.ndarray, places: np.ndarray, d: int) -> np.ndarray:
    """Whether a text says the same again and again: most of its runs of words occur before, or few of its words differ."""
    n = np.bincount(doc, minlength=d)
    k, again = REPEATED_RUN, _sum(doc[places], None, d)
    order = np.lexsort((tokens, doc))
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[order][1:] != tokens[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    distinct = _sum(doc[order][new], None, d)
    return (n >= k) & (again > REPEATED_SHARE * np.maximum(n - k + 1, 1)) | (n >= 6) & (n < 4 * k) & (distinct < DISTINCT_SHARE * n)


def _results(texts, off, doc_of, stats, doc, size, reason, tokens=None, token_doc=None, again=None, repeated=None) -> dict[str, np.ndarray]:  # noqa: ANN001
    d = len(texts)
    z = np.zeros(d)
    get = lambda k: stats.get(k, z)
    ratio = lambda a, b: np.divide(a, b, out=np.full(d, np.nan), where=b > 0)
    total = get("size")
    by = np.stack([_sum(doc[reason == r], size[reason == r], d) for r in range(len(REASONS))]) if len(doc) else np.zeros((len(REASONS), d))
    bad = by.sum(0)
    verdict = np.where(bad > NOT_PROSE_SHARE * total, by.argmax(0), -1)
    if tokens is not None and len(tokens):
        verdict = np.where((verdict < 0) & _repeats(tokens, token_doc, again, d), REPETITION, verdict)
        # Neither may be a half alone.
        verdict = np.where((verdict < 0) & (bad > 0) & (bad + repeated > NOT_PROSE_SHARE * total), np.where(repeated > by.max(0), REPETITION, by.argmax(0)), verdict)
    verdict = np.where(total == 0, EMPTY, verdict)
    return {
        "n_words": get("words").astype(np.int64), "mean_word_length": ratio(get("letters"), get("words")), "symbol_ratio": ratio(get("signs"), total),
        "closed_line_share": ratio(get("closed"), get("lines")), "bullet_line_share": ratio(get("bullets"), get("lines")), "common_word_share": ratio(get("common"), get("words")),
        "not_prose_share": ratio(bad, total), "verdict": verdict, "failures": _failures(get, total),
    }


def _failures(get, total: np.ndarray) -> np.ndarray:  # noqa: ANN001
    """Which of RULES each text breaks, as bits; texts of Han signs are let off the rule on word length, texts without signs break none."""
    words, lines = get("words"), np.maximum(get("lines"), 1)
    some = np.maximum(words, 1)
    length = get("spaced_letters") / np.maximum(get("spaced"), 1)
    broken = [
        words < WORD_COUNT[0], words > WORD_COUNT[1], (get("spaced") * 2 > words) & ((length < WORD_LENGTH[0]) | (length > WORD_LENGTH[1])), get("dots") > SIGNS_PER_WORD * some,
        get("bullets") > BULLET_LINES * lines, get("trails") > ELLIPSIS_LINES * lines, words < ALPHABETIC_WORDS * (words + get("numbers")), get("common") < STOP_WORDS,
        get("same_lines") > SAME_LINES * get("whole_lines"), get("same_line_signs") > SAME_LINE_SIGNS * total, get("same_tens") > SAME_TENS * total, get("closed") <= CLOSED_LINES * lines,
        get("short_lines") >= SHORT_LINES * np.maximum(get("whole_lines"), 1),
    ]
    return np.where(total > 0, sum(b.astype(np.int64) << i for i, b in enumerate(broken)), 0)


STATS = "n_words bigint, mean_word_length double, symbol_ratio double, closed_line_share double, bullet_line_share double, common_word_share double, not_prose_share double, reason string, failures array<string>"


def text_quality(df: DataFrame, common_words: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics of each text and, where it isn't prose, the reason (null for prose).

    Words are runs of letters and digits with a letter among them, and single Han signs. `not_prose_share` is the share of the signs
    (white space left aside) in lines that a rule finds to be no running sentences; above a half the text isn't prose and
    the reason is the rule with the most signs: list, table, symbols, actions, words (none of the usual function words, or
    random letters), garbled, repetition (the same run of words again and again). Signs of other lines in runs of words that
    occur before in the text count towards the half, too. Null, empty and blank texts have the
    reason 'empty', 0 words, null ratios and no failures. `failures` names the published rules for whole texts that a text breaks
    (see RULES), which don't bear on the reason: they can't tell whether more than half of a text is prose
    (README has the figures of both). Texts are measured where they lie, many at a time; there is no shuffle.
    """
    words = [r.word for r in small_rows(common_words.select("word").distinct()) if r.word]
    rows = df.select(F.col(id_col), F.col(text_col).alias("_text"))
    fields = T.StructType.fromDDL(STATS)
    schema = T.StructType([rows.schema[0], *fields.fields])
    names = [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = Common(words)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for a, e in tv.groups([len(t) for t in texts], tv.PIECE):
                m = measure(texts[a:e], common)
                cols = [pa.array(m[k], from_pandas=True) for k in names[1:-2]]
                broken = [[r for i, r in enumerate(RULES) if f >> i & 1] for f in m["failures"].tolist()]
                reasons = pa.array([REASONS[v] if v >= 0 else None for v in m["verdict"].tolist()], pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, e - a), *cols, reasons, pa.array(broken, pa.list_(pa.string()))], names=names)

    return rows.mapInArrow(run, schema)
