"""Secret scans: patterns, and a token-efficiency test for random strings.

Random strings cost a tokenizer many tokens: where a run of letters, digits
and a few signs has few characters per token under a public vocabulary, it is
reported, unless it is a digest, a UUID, dates, or words joined by signs that
have enough characters per token without the signs.
"""

from __future__ import annotations

import base64
import hashlib
import re
from functools import lru_cache

from pyspark.sql import DataFrame

from .common import map_texts

# Kinds in their order, patterns and least lengths.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Where the vocabulary lies on the driver; a parameter of the scan.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Runs of at least RUN characters with fewer than RATIO characters a token.
RUN = 20
RATIO = 2.2

# Shapes of digests (hexadecimal, by length) and identifiers.
DIGEST_LENGTHS = (32, 40, 48, 56, 64, 96, 128)
UUID = r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}"
DATE = r"\d{4}[-/_](?:0[1-9]|1[0-2])[-/_](?:0[1-9]|[12]\d|3[01])"

FIELDS = "spans array<struct<kind: string, start: int, end: int>>"

_ASSIGN, _ACCESS = re.compile(ASSIGN, re.IGNORECASE | re.ASCII), re.compile(ACCESS)
# a run that long starts where the run of any length does
_HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST["hex"])
_RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % RUN)
_DIGEST = re.compile("|".join([*(r"(?:[0-9A-Fa-f]{%d})" % n for n in DIGEST_LENGTHS), UUID]))
_DAY, _HOUR, _CLOCK = re.compile(DATE, re.ASCII), re.compile(r"[T_-]\d\d", re.ASCII), re.compile(r"[-_]?\d\d", re.ASCII)
_FRACTION = re.compile(r"[-_]?\d{1,9}", re.ASCII)
_SIGNS, _CASED = re.compile(r"[+/_=-]+"), re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_PARTS = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+|\s+"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Leftmost non-overlapping matches of each pattern that are long enough."""
    out = []
    low = text.lower()
    if any(w in low for w in ("passw", "secret", "token", "api")):
        out += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text)
                if len(m.group(2)) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)
                if m.end() - m.start() >= LEAST["access"]]
    return out + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes):
    import tiktoken
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("scan", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})


def _efficient(parts: list[str], encoding) -> bool:
    return sum(map(len, parts)) >= RATIO * sum(len(encoding.encode_ordinary(p)) for p in parts)


def _joined_words(run: str, encoding) -> bool:
    """Parts between signs, each in one case, that have enough characters per
    token without the signs (which cost a token each in names and paths)."""
    parts = [p for p in _SIGNS.split(run) if p]
    return len(parts) > 1 and all(map(_CASED.fullmatch, parts)) and _efficient([p.lower() for p in parts], encoding)


def _time_ends(run: str, at: int) -> set[int]:
    """Where a time that follows a date at ``at`` may end: an hour, up to two
    more pairs of digits, a fraction and ``Z``, all but the hour optional."""
    hour = _HOUR.match(run, at)
    if not hour:
        return {at}
    clock = [hour.end()]
    while len(clock) < 3 and (pair := _CLOCK.match(run, clock[-1])):
        clock.append(pair.end())
    ends = set(clock)
    for end in clock:
        if fraction := _FRACTION.match(run, end):
            first = end + 1 + (run[end] in "-_")
            ends.update(range(first, fraction.end() + 1))
    return ends | {e + 1 for e in ends if run[e:e + 1] == "Z"} | {at}


def _dates(run: str) -> bool:
    """Whether ``run`` is dates, with or without times, joined by one or two
    signs.  Places that a date may start at are followed from left to right,
    each once, so the time is linear in the run."""
    starts, n = {0}, len(run)
    for at in range(n):
        if at not in starts:
            continue
        starts.discard(at)
        day = _DAY.match(run, at)
        for end in _time_ends(run, day.end()) if day else ():
            if end == n:
                return True
            for signs in (1, 2):
                if all(c in "+/_=-" for c in run[end:end + signs]):
                    starts.add(end + signs)
        if not starts:
            break
    return False


def _known(run: str) -> bool:
    """A digest of a known length, a UUID or dates."""
    return bool(_DIGEST.fullmatch(run)) or _dates(run)


def random_spans(text: str, encoding) -> list[tuple[str, int, int]]:
    """Runs with few characters per token that are no known digest or
    identifier, whether or not they have letters or digits."""
    out = []
    for m in _RUN.finditer(text):
        run = m.group()
        if _known(run):
            continue
        if not _efficient([run], encoding) and not _joined_words(run, encoding):
            out.append(("random", m.start(), m.end()))
    return out


def ordered(spans: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def scan_secrets(docs: DataFrame, vocabulary: str = VOCABULARY, keep: list[str] | None = None) -> DataFrame:
    """``doc`` (struct of the columns ``keep``, else of all) and :data:`FIELDS`:
    the spans of all kinds in code points, by start, then kind.

    ``vocabulary`` is a file of tokens and ranks on the driver; its bytes (of a
    fixed, known file) go to the executors.  Null and empty texts have no
    spans; very long ones are scanned whole, in time linear in their length;
    repeated rows are scanned alike; columns of any name stay apart in ``doc``;
    an empty table gives no rows.
    """
    try:
        with open(vocabulary, "rb") as f:
            shared = docs.sparkSession.sparkContext.broadcast(f.read())
    except FileNotFoundError as missing:
        raise FileNotFoundError(f"parameter vocabulary: no file {vocabulary} on the driver") from missing

    def make():
        encoding = _encoding(shared.value)

        def of_text(data):
            text = data.decode("utf-8", "replace") if data else ""
            found = ordered(base_spans(text) + random_spans(text, encoding))
            return ([{"kind": k, "start": a, "end": b} for k, a, b in found],)
        return of_text

    return map_texts(docs, make, FIELDS, keep=keep)


def digest(spans: list[tuple[str, int, int]]) -> str:
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
