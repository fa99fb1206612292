"""License scans: fuzzy search for short notices.

A notice with at most k edits is cut into k + 1 pieces; one of them stands
unchanged in every match (pigeonhole), so exact searches for the pieces locate
all candidates.  The regex library's bounded-error matching then verifies the
edits around each candidate and gives the span.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import WORD, map_texts, words

# Exact phrases and their labels.
PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
# Notices searched with edits, and their labels.
NOTICES = (
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("released under the mit license", "mit"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("mozilla public license", "mpl"),
    ("creative commons attribution", "cc-by"),
    ("licensed under cc by", "cc-by"),
    ("creative commons zero", "cc0"),
    ("all rights reserved", "proprietary"),
)
#: One edit is allowed for so many characters of a notice, and at most MAX_EDITS.
CHARS_PER_EDIT = 9
MAX_EDITS = 4

FIELDS = ("n_words bigint, matches array<struct<label: string, notice: string, exact: boolean, edits: int, "
          "first_word: int, last_word: int, start: int, end: int>>")


def edits_allowed(notice: str) -> int:
    return min(MAX_EDITS, len(notice) // CHARS_PER_EDIT)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` parts of about equal length with their places."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


def candidates(joined: bytes, notice: str, edits: int) -> list[tuple[int, int]]:
    """Regions of ``joined`` that hold every match of the notice."""
    found = []
    for offset, piece in pieces(notice, edits):
        seed = piece.encode()
        at = joined.find(seed)
        while at >= 0:
            start = at - offset - edits - 1
            found.append((max(0, start), min(len(joined), start + len(notice) + 2 * edits + 2)))
            at = joined.find(seed, at + 1)
    merged: list[tuple[int, int]] = []
    for a, b in sorted(found):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


@lru_cache(maxsize=None)
def _pattern(notice: str, edits: int):
    import regex
    text = regex.escape(notice, literal_spaces=True)
    return regex.compile(rf"(?b)(?<= )(?:{text}){{e<={edits}}}(?= )".encode(), regex.BESTMATCH)


def find_notice(joined: bytes, notice: str, edits: int) -> list[tuple[int, int, int]]:
    """(start, end, edits) of matches in ``joined``, whole words only."""
    if edits == 0:
        seed, out = b" " + notice.encode() + b" ", []
        at = joined.find(seed)
        while at >= 0:
            out.append((at + 1, at + len(seed) - 1, 0))
            at = joined.find(seed, at + 1)
        return out
    out, pattern, room = [], _pattern(notice, edits), 3 * len(notice) + 4 * edits
    for start, end in candidates(joined, notice, edits):
        at = start
        while end - at >= len(notice) - edits:
            # a match that begins in the first half of a window ends inside it, so the
            # best one there is final, and a long stretch of notices is searched once
            stop = min(end, at + room)
            next_ = end if stop == end else at + len(notice) + edits
            own = [f for f in _in_window(pattern, joined, at, stop, len(notice) - edits) if f[0] < next_]
            out += own
            at = max([next_, *(f[1] for f in own)])
    return out


def _in_window(pattern, joined: bytes, start: int, end: int, least: int) -> list[tuple[int, int, int]]:
    """Matches between two places, in order: the best one, then what stands
    before and after it."""
    found, open_ = [], [(start, end)]
    while open_:
        a, b = open_.pop()
        m = pattern.search(joined, a, b) if b - a >= least else None
        if m:
            found.append((m.start(), m.end(), sum(m.fuzzy_counts)))
            open_ += [(a, m.start()), (m.end(), b)]
    return sorted(found)


def scan(text: bytes | None, phrases=PHRASES, notices=NOTICES) -> tuple[int, list[dict]]:
    """Number of words and all matches, by place, then label."""
    ws = words(text)
    if not ws:
        return 0, []
    joined = b" " + b" ".join(ws) + b" "
    found = []
    for notice, label in phrases:
        found += [(a, b, label, notice, True, e) for a, b, e in find_notice(joined, notice, 0)]
    for notice, label in notices:
        found += [(a, b, label, notice, False, e)
                  for a, b, e in find_notice(joined, notice, edits_allowed(notice))]
    if not found:
        return len(ws), []
    places = [m.span() for m in re.finditer(WORD.encode(), text.translate(_LOWER))]
    out = []
    seen = blanks = 0  # of joined, up to the last match
    read = points = 0  # bytes and code points of text, up to the last match's first word
    for a, b, label, notice, exact, edits in sorted(found):
        blanks += joined.count(b" ", seen, a)
        seen, first = a, blanks - 1
        last = first + joined[a:b].strip().count(b" ")
        points += len(text[read:places[first][0]].decode("utf-8", "replace"))
        read = places[first][0]
        end = points + len(text[read:places[last][1]].decode("utf-8", "replace"))
        out.append({"label": label, "notice": notice, "exact": exact, "edits": edits, "first_word": first,
                    "last_word": last, "start": points, "end": end})
    return len(ws), out


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def scan_licenses(docs: DataFrame, keep: list[str] | None = None, phrases=PHRASES, notices=NOTICES) -> DataFrame:
    """``doc`` (struct of the columns ``keep``, else of all) and :data:`FIELDS`.

    ``matches`` has every place of the exact ``phrases`` and the non-overlapping
    matches of each of the ``notices`` within its edits, on whole words (pairs
    of lower-case words joined by one space, and a label): first and last word
    (from 0) and the span of ``text`` in code points.  Null and empty texts have
    no words and no matches; very long ones are searched whole, in time linear
    in their length also where a notice repeats; repeated rows are scanned
    alike; columns of any name stay apart in ``doc``; an empty table gives no
    rows.
    """
    return map_texts(docs, lambda: lambda text: scan(text, phrases, notices), FIELDS, keep=keep)
