"""The action language: three ways to parse it, kept apart on purpose, and the scores of a prediction.

strict: the first segment of the first whole action has to be three integers. prefix: three integers behind a start tag
anywhere, whether or not the action ends. single: one blank between the integers, and an end tag.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The tags of the language, its forms, and the movement above which a step counts as moved.
START, SEP, STOP = "<|action_start|>", "<|action_sep|>", "<|action_end|>"
WHOLE = r"(?s)<\|action_start\|>(.*?)<\|action_end\|>"
PREFIX = r"<\|action_start\|>\s*(-?\d+)\s+(-?\d+)\s+(-?\d+)"
SINGLE = r"(?s)<\|action_start\|>(-?\d+) (-?\d+) (-?\d+)(.*?)<\|action_end\|>"
MOVED = 10


def strip(text: Column) -> Column:
    """Without outer white space."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def body(text: Column) -> Column:
    """What the first whole action holds; empty where there is none."""
    return F.regexp_extract(text, WHOLE, 1)


def contains_start(text: Column) -> Column:
    return F.contains(text, F.lit(START))


def contains_end(text: Column) -> Column:
    return F.contains(text, F.lit(STOP))


def well_formed(text: Column) -> Column:
    return strip(body(text)) != ""


def parses_strict(text: Column) -> Column:
    return F.split_part(body(text), F.lit(SEP), F.lit(1)).rlike(r"^\s*-?\d+\s+-?\d+\s+-?\d+\s*$")


def has_separator(text: Column) -> Column:
    return F.contains(body(text), F.lit(SEP))


def mouse(text: Column, pattern: str = PREFIX) -> Column:
    """The three integers by a pattern; null where it doesn't match."""
    parts = [F.regexp_extract(text, pattern, k) for k in (1, 2, 3)]
    return F.when(parts[0] != "", F.array(*[p.try_cast("int") for p in parts]))


def parses_prefix(text: Column) -> Column:
    return F.regexp_extract(text, PREFIX, 1) != ""


def magnitude(m: Column) -> Column:
    return F.abs(m[0]) + F.abs(m[1])


def moved_but_still(pred: Column, gt: Column) -> Column:
    """Whether the truth moved (by more than MOVED) and the prediction didn't; null where either doesn't parse."""
    return (magnitude(mouse(gt)) > MOVED) & (magnitude(mouse(pred)) == 0)


def single_parts(text: Column) -> Column:
    """The three integers and the rest of the first action of the single form, as a list of four texts; null where there is none.

    The text is searched once, and only where it has a start tag; the parts are cut from what was found.
    """
    found = F.when(contains_start(text), F.regexp_extract(text, SINGLE, 0))
    return F.when(found != "", F.split(F.regexp_replace(found, SINGLE, "$1\u0001$2\u0001$3\u0001$4"), "\u0001", 4))


def key_in(rest: Column) -> Column:
    """Whether the part of an action behind its integers has a key."""
    return strip(F.replace(rest, F.lit(SEP), F.lit(" "))) != ""


def has_key(text: Column) -> Column:
    """Whether an action of the single form has a key."""
    return key_in(F.regexp_extract(text, SINGLE, 4))


def keys(text: Column) -> Column:
    """The keys of each segment after the first, in order; null where there is no whole action."""
    parts = F.split(body(text), r"<\|action_sep\|>")
    segments = F.slice(parts, F.lit(2), F.size(parts))
    return F.when(well_formed(text), F.transform(segments, lambda s: F.filter(F.split(strip(s), r"\s+"), lambda k: k != "")))


def scores(pred: Column, gt: Column) -> list[Column]:
    """Columns of the format check of a prediction against its truth; null predictions give nulls."""
    return [
        contains_start(pred).alias("contains_start"), contains_end(pred).alias("contains_end"), well_formed(pred).alias("well_formed"), parses_strict(pred).alias("parses_xyz"),
        has_separator(pred).alias("has_action_sep"), (strip(pred) == strip(gt)).alias("exact_match"), F.levenshtein(strip(pred), strip(gt)).alias("edit_distance"),
        F.length(pred).alias("pred_len"), F.length(gt).alias("gt_len"),
    ]
