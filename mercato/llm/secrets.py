"""Secret scans: three base patterns and sliding-window entropy over candidate strings.

A candidate is a run of 20 or more characters of the base64 alphabet. It is
reported if one of its windows of 20 characters reaches the entropy that the
window's own characters set: digits, hexadecimal, letters like a word, words
joined by separators or capitals, other alphanumerics, base64. The entropy of
each window comes from the one before by the counts of the character that leaves
and the one that enters. Windows that touch a known placeholder do not count; the
rest of the candidate does. Spans are code points, end exclusive.

A threshold loses the random strings below it: the share is small for mixed
characters and larger for 20 digits or small letters alone, which words and
numbers resemble (README).

Null text counts as empty: no spans. Repeated rows are scanned each.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices, texts_of

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
#: A cheap test that each text with an assignment passes.
ASSIGN_HINT = re.compile(r"""(?:word|wd|et|en|ey)["']?\x20*[:=]""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LEAST = {"assign": 6, "access": 20, "hex": 24}

WINDOW = 20
#: Bits a character that some window must reach, by the characters of the window.
HEX_BITS, ALNUM_BITS, BASE64_BITS = 3.0, 3.7, 3.8
#: The same for digits alone, digits with letters of one case, letters like a word, and words joined by separators or capitals.
DIGIT_BITS, ONE_CASE_BITS, WORD_BITS, JOINED_BITS = 2.7, 3.5, 3.6, 4.1
#: Letters that look like a word; joined words have few changes between letters and digits.
WORD = re.compile(r"[A-Z]?[a-z]{3,}|[A-Z]{4,}")
MOST_CHANGES = 2
#: Placeholders that documentation uses instead of secrets; windows that touch one do not count.
ALLOWED = re.compile(
    r"(?i)example|sample|dummy|placeholder|changeme|your[_-]|x{4,}|0123456789|abcdefgh"
    r"|(?<![a-z0-9])(?:https?|www)(?![a-z0-9])"
)

_PART = [0.0] + [n / WINDOW * math.log2(n / WINDOW) for n in range(1, WINDOW + 1)]


def window_entropies(s: str) -> Iterator[float]:
    """The Shannon entropy, in bits a character, of each window of ``s``."""
    counts: dict[str, int] = {}
    for c in s[:WINDOW]:
        counts[c] = counts.get(c, 0) + 1
    total = -sum(_PART[n] for n in counts.values())
    yield total
    for gone, come in zip(s, s[WINDOW:]):
        if gone != come:
            n, m = counts[gone], counts.get(come, 0)
            total += _PART[n] - _PART[n - 1] + _PART[m] - _PART[m + 1]
            counts[gone], counts[come] = n - 1, m + 1
        yield total


def window_entropy(s: str, width: int = WINDOW) -> float:
    """The largest Shannon entropy, in bits a character, of the windows of ``s``."""
    if len(s) < width or width != WINDOW:
        raise ValueError(f"needs {WINDOW} characters and windows of {WINDOW}")
    return max(window_entropies(s))


def needed_bits(digits: int, letters: int, wordy: int, hexes: int, small: int, changes: int, capitals: int) -> float:
    """The entropy that a window with so many characters of each kind must reach."""
    if not letters:
        return DIGIT_BITS if digits == WINDOW else HEX_BITS
    if 2 * letters >= WINDOW and 5 * wordy >= 4 * letters and changes <= MOST_CHANGES:
        return JOINED_BITS if capitals or letters < WINDOW else WORD_BITS
    if hexes == WINDOW:
        return HEX_BITS
    if digits + letters < WINDOW:
        return BASE64_BITS
    return ONE_CASE_BITS if digits and small in (0, letters) else ALNUM_BITS


#: Windows that are looked at together, so that memory does not grow with a candidate.
BLOCK = 1 << 15


def is_random(s: str) -> bool:
    """Whether some window of a candidate looks random for its kind of characters and touches no placeholder."""
    n = len(s)
    wordy, allowed = bytearray(n), bytearray(n)
    for marks, pattern in ((wordy, WORD), (allowed, ALLOWED)):
        for m in pattern.finditer(s):
            marks[m.start() : m.end()] = b"\1" * (m.end() - m.start())
    starts = range(0, max(1, n - WINDOW + 1), BLOCK)
    return any(_random_block(*(x[a : a + BLOCK + WINDOW - 1] for x in (s, wordy, allowed))) for a in starts)


def _random_block(s: str, wordy: bytearray, allowed: bytearray) -> bool:
    digits, letters = [c.isdigit() for c in s], [c.isalpha() for c in s]
    # changes between letters and digits, and capitals after small letters, inside a window: not at its first character
    changes = [0, *(a + b == 1 == x + y for a, b, x, y in zip(digits, digits[1:], letters, letters[1:]))]
    capitals = [0, *(a.islower() and b.isupper() for a, b in zip(s, s[1:]))]
    hexes = [c in "0123456789abcdefABCDEF-" for c in s]
    small = [c.islower() for c in s]
    upto = [[0, *accumulate(x)] for x in (digits, letters, wordy, hexes, small, changes, capitals, allowed)]
    for i, bits in enumerate(window_entropies(s)):
        if bits < DIGIT_BITS:
            continue
        kinds = (x[i + WINDOW] - x[i + (k > 4)] for k, x in enumerate(upto[:7]))
        if upto[7][i + WINDOW] == upto[7][i] and bits >= needed_bits(*kinds):
            return True
    return False


def spans_of(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, by start and kind.

    Entropy spans may overlap base spans; only what these cover entirely is left out.
    """
    out, found = [], []
    if ("=" in text or ":" in text) and ASSIGN_HINT.search(text):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= LEAST["access"]]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    out.sort()
    starts = [a for a, _, _ in out]
    reach = list(accumulate((b for _, _, b in out), max))  # the furthest end so far
    assigned = [a for a, k, _ in out if k == 0]
    for m in CANDIDATE.finditer(text):
        first, last = m.span()
        # what stands before an assignment inside the candidate is its name or another candidate
        n = bisect_left(assigned, first)
        if n < len(assigned) and assigned[n] < last:
            last = assigned[n]
        if last - first < WINDOW or _covered(out, starts, reach, first, last):
            continue
        if is_random(text[first:last]):
            found.append((first, 3, last))
    return sorted(out + found)


def _covered(spans: list[tuple[int, int, int]], starts: list[int], reach: list[int], first: int, last: int) -> bool:
    """Whether sorted spans cover all of [first, last)."""
    n = bisect_left(starts, first + 1)
    at = max(first, reach[n - 1]) if n else first
    while at < last and n < len(spans) and spans[n][0] <= at:
        at = max(at, spans[n][2])
        n += 1
    return at >= last


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, spans array<struct<kind, start, end>>`` for each row of ``docs``."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            rows = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans_of(t)] for t in texts_of(batch)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(rows, pa.list_(span))], names=["doc_id", "spans"]
            )

    schema = f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def joined(spans, base_only: bool = False):
    """``kind:start:end`` of the spans, comma-joined."""
    kept = F.filter(spans, lambda s: s["kind"] != KINDS[3]) if base_only else spans
    return F.array_join(F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` for each row of ``docs``."""
    found = scan(docs)

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in KINDS[:3]),
        F.sha2(joined(F.col("spans"), True), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """``docs`` with the union of overlapping spans of ``text`` replaced by one ``mask``; all columns and rows stay, null text too."""
    bounded_batches(docs.sparkSession)
    place = [c.lower() for c in docs.columns].index("text")
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # any names may come in

    def clean(text: str | None) -> str | None:
        spans = spans_of(text) if text else []
        if not spans:
            return text
        parts, at = [], 0
        for a, _, b in spans:
            if b > at:
                if a >= at:
                    parts += [text[at:a], mask]
                at = b
        return "".join([*parts, text[at:]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, f"c{place}"):
            texts = pa.array([clean(t) for t in batch.column(place).to_pylist()], pa.string())
            yield batch.set_column(place, f"c{place}", texts)

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
