"""Spelling variants by sorted rotations of terminator-marked words.

All rotations of ``word$`` are sorted. Words that differ in one code point have
rotations ``y$xc`` and ``y$xd``: equal but for the last code point, so they stand
in the range of the prefix ``y$x``. A word with one code point less has ``y$x``
itself as a rotation and heads the same range. A scan of the sorted rotations
keeps the ranges that are open (each the prefix of the next) and, when one ends,
emits its neighbours. A range holds at most one word for each letter and one
without, so it is bounded whatever the corpus; ranges are spread by their first
code points and a task holds only the open ones.

A word's form is its most frequent neighbour if that is ten times as frequent.
Forms are followed by doubling; as each step is ten times as frequent, chains
are as short as the digits of the largest count.

Words are runs of Latin letters; a run of a document loses a code point where a
crc32 of document and run says so. Null texts have no words; a null id is empty
text in the crc32. Repeated rows count each time. Ties between forms go to the
first in code point order. A single very long word is one word like any other.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices, staged, texts_of

#: Least code points of a word, least occurrences, and how many times as frequent a form is.
LETTERS, OCCURRENCES, FORM_TIMES = 7, 2, 10
#: One crc32 of so many takes a code point away.
DROP_OF = 31
TERMINATOR = "$"
#: Words that a task counts before it passes them on.
HELD_WORDS = 200_000

_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
_RUN = re.compile(f"[a-zÀ-ÿ]{{{LETTERS},}}")


def words_of(doc_id: str, text: str) -> Counter[str]:
    """The words of a document and their occurrences."""
    lowered = text.encode("utf-8", "surrogatepass").translate(_LOWER).decode("utf-8", "surrogatepass")
    found: Counter[str] = Counter()
    start = zlib.crc32(f"{doc_id}:".encode("utf-8", "surrogatepass"))
    for run, n in Counter(_RUN.findall(lowered)).items():
        h = zlib.crc32(run.encode(), start)
        if h % DROP_OF == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LETTERS:
                continue
        found[run] += n
    return found


def counted(docs: DataFrame) -> DataFrame:
    """``word, n`` of the words that occur often enough."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for part in slices(iter([batch]), "text"):
                for doc_id, text in zip(part.column("doc_id").to_pylist(), texts_of(part)):
                    for word, n in words_of(doc_id, text).items():
                        held[word] += n
                    if len(held) > HELD_WORDS:
                        yield _batch(held)
                        held = Counter()
        yield _batch(held)

    def _batch(held: Counter[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"]
        )

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    found = rows.mapInArrow(run, "word string, n bigint")
    return found.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= OCCURRENCES)


def rotations(words: DataFrame) -> DataFrame:
    """``rotation, n``: every rotation of each marked word, those of a range together and in order."""
    turned = words.select("word", "n", F.explode(F.sequence(F.lit(0), F.length("word"))).alias("i"))
    rotation = F.concat(
        F.substring("word", F.col("i") + 1, F.length("word")), F.lit(TERMINATOR), F.substring("word", F.lit(1), F.col("i"))
    )
    # a range's prefix has at least as many code points as a word
    rows = turned.select(rotation.alias("rotation"), "n")
    return rows.repartition(F.substring("rotation", 1, LETTERS)).sortWithinPartitions("rotation")


def _word(rotation: str) -> str:
    end, _, start = rotation.partition(TERMINATOR)
    return start + end


class Range:
    """An open prefix: the word that is the prefix itself, and those with one more code point.

    A word that comes to the prefix by losing one of several equal code points in a
    row does so from each of them; only the first counts (``first``).
    """

    __slots__ = ("prefix", "bare", "more")

    def __init__(self, prefix: str) -> None:
        self.prefix = prefix
        self.bare: tuple[int, str] | None = None
        self.more: list[tuple[int, str, bool]] = []

    def neighbours(self) -> Iterator[tuple[str, list[tuple[int, str]]]]:
        """Each word with its neighbours of this range as ``(-n, word)``, best first."""
        first = [(n, w) for n, w, f in self.more if f]
        if self.bare and first:
            yield self.bare[1], sorted(first)
        if len(self.more) > 1 or self.bare:
            everyone = sorted((n, w) for n, w, _ in self.more)
            for n, word, is_first in self.more:
                others = [x for x in everyone if x[1] != word]
                if self.bare and is_first:
                    others = sorted([*others, self.bare])
                if others:
                    yield word, others


def ranges(rows: Iterator[tuple[str, int]]) -> Iterator[Range]:
    """Closed ranges of sorted rotations."""
    opened: list[Range] = []
    for rotation, n in rows:
        while opened and not rotation.startswith(opened[-1].prefix):
            yield opened.pop()
        word, last, prefix = _word(rotation), rotation[-1], rotation[:-1]
        if last != TERMINATOR:
            if not opened or len(opened[-1].prefix) != len(prefix):
                opened.append(Range(prefix))
            opened[-1].more.append((-n, word, prefix[-1] != last))
        opened.append(Range(rotation))
        opened[-1].bare = (-n, word)
    while opened:
        yield opened.pop()


def _scanned(words: DataFrame, emit: Callable[[str, list[tuple[int, str]]], list[tuple]], schema: str) -> DataFrame:
    """``emit`` for each word of each range that has neighbours."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [{"string": pa.string(), "bigint": pa.int64()}[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, int]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        held: list[tuple] = []
        for closed in ranges(rows()):
            for word, near in closed.neighbours():
                held += emit(word, near)
            if len(held) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    return rotations(words).mapInArrow(run, schema)


def neighbours(words: DataFrame) -> DataFrame:
    """``word, other, n``: every two words of ``word, n`` that are near, from both sides, with the other's count."""
    return _scanned(words, lambda word, near: [(word, w, -n) for n, w in near], "word string, other string, n bigint")


def nearest(words: DataFrame) -> DataFrame:
    """``word, n_near, best``: the number of neighbours and the most frequent one as ``(less, word)``, ``less`` being minus its count."""

    def emit(word: str, near: list[tuple[int, str]]) -> list[tuple]:
        return [(word, len(near), near[0][0], near[0][1])]

    rows = _scanned(words, emit, "word string, near bigint, less bigint, other string")
    return rows.groupBy("word").agg(
        F.sum("near").alias("n_near"), F.min(F.struct("less", F.col("other").alias("word"))).alias("best")
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of each row of ``word, form``: the last that forms lead to."""
    at = staged(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        step = at.join(ahead, "root", "left").select(
            "word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved")
        )
        step = staged(step, "roots")
        at = step.select("word", "root")
        if step.where("moved").isEmpty():
            return at


def grouped(words: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for each row of ``word, n``."""
    best = F.col("best")
    found = words.join(nearest(words), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(-best["less"] >= F.lit(FORM_TIMES) * F.col("n"), best).alias("best"),
    )
    found = staged(
        found.select("word", "n", "n_near", F.col("best.word").alias("form"), (-F.col("best.less")).alias("form_n")), "forms"
    )
    last = roots(found.where("form is not null").select("word", "form"))
    return found.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def report(docs: DataFrame) -> DataFrame:
    """The spelling variants among the words of ``docs``."""
    return grouped(staged(counted(docs), "words"))
