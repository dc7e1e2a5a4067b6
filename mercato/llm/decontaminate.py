"""Benchmark decontamination by a distributed positional inverted index.

The training text is indexed in segments. Each segment holds the postings of
its own documents (term -> ascending word positions, with a gap between
documents) and is one row of a stored table, so the index has one row for some
megabytes of text, needs no shuffle and can be searched by any number of
benchmarks. A search walks the windows of the benchmark through each segment:
the positions of the window's rarest term, moved back by its offset, are
intersected with those of the next rarest and so on. What is left are exact
phrase matches; with a tolerance on each step they are proximity matches.

Terms are compared as whole words, never as hashes. Null or wordless texts
have no words, no hits and no items. Benchmark rows that repeat an item id are
one item: any of their windows counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, merged_slices, staged

#: Words of a window.
WINDOW = 10
#: Bytes of text of one index segment (a longer document is a segment by itself).
SEGMENT_BYTES = 16 << 20
#: Free positions between two documents; larger than any tolerance.
GAP = 64
#: Bytes of benchmark text that are broadcast at a time; a larger benchmark is searched in several passes.
QUERY_BYTES = 8 << 20


def _words_table() -> bytes:
    """Lower-cases A-Z and turns what is not in a word into spaces; bytes of other code points stay."""
    table = bytearray(b" " * 256)
    for b in (*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)):
        table[b] = b
    for b in range(0x41, 0x5B):
        table[b] = b + 32
    return bytes(table)


WORDS_TABLE = _words_table()


def words_of(text: str | None) -> list[bytes]:
    """Runs of 0-9, a-z and code points from U+0080, in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").translate(WORDS_TABLE).split()


def pack(values: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(1).compress(values.astype("<i4").tobytes())


def unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), "<i4")


class Numbers(dict):
    """Numbers words by first use."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def segment_of(doc_ids: pa.Array, texts: Iterable[str | None]) -> list:
    """Doc ids, words by document, terms, postings' lengths and positions of one segment.

    The arrays over all words are changed in place: with copies they set the worker's memory.
    """
    numbers, parts, counts = Numbers(), [np.zeros(0, np.int32)], []
    for text in texts:
        words = words_of(text)
        counts.append(len(words))
        parts.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    sizes = np.array(counts, np.int64)
    order = np.concatenate(parts).astype(np.int64)
    del parts
    bases = np.concatenate([[0], np.cumsum(sizes + GAP)])[:-1]
    first = np.cumsum(sizes) - sizes
    place = np.repeat(bases - first, sizes)
    place += np.arange(len(place), dtype=np.int32)
    span = int(place[-1]) + 1 if len(place) else 1
    order *= span
    order += place
    order.sort()
    np.remainder(order, span, out=place)
    order //= span  # the terms
    lengths = np.bincount(order, minlength=len(numbers))
    del order
    # differences are small within a postings list, which is what the packing needs
    steps = np.diff(place.astype(np.int32), prepend=np.int32(0))
    del place
    return [doc_ids, sizes, b" ".join(numbers), pack(lengths), pack(steps)]


def build_index(docs: DataFrame) -> DataFrame:
    """The stored index of ``docs``: one row for each segment, written to the shared folder."""
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        # rows are numbered as they are written, so equal rows have different numbers
        first = TaskContext.get().partitionId() << 40
        for batch in merged_slices(batches, "text", SEGMENT_BYTES):
            ids, sizes, terms, lengths, steps = segment_of(batch.column("doc_id"), (t.as_py() for t in batch.column("text")))
            whole = pa.array([0, len(ids)], pa.int32())
            first += len(ids)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([first - len(ids)], pa.int64()),
                    pa.ListArray.from_arrays(whole, ids),
                    pa.ListArray.from_arrays(whole, pa.array(sizes)),
                    *(pa.array([x], pa.binary()) for x in (terms, lengths, steps)),
                ],
                names=["first", "doc_ids", "sizes", "terms", "lengths", "steps"],
            )

    schema = f"first bigint, doc_ids array<{kind}>, sizes array<bigint>, terms binary, lengths binary, steps binary"
    return staged(docs.select("doc_id", "text").mapInArrow(run, schema), "postings")


class Segment:
    """One row of the index, opened for searches."""

    def __init__(self, sizes: list[int], terms: bytes, lengths: bytes, steps: bytes):
        self.sizes = np.array(sizes, np.int64)
        self.bases = np.concatenate([[0], np.cumsum(self.sizes + GAP)])[:-1]
        self.number = {w: i for i, w in enumerate(terms.split(b" "))} if terms else {}
        counts = unpack(lengths).astype(np.int64)
        self.ends = np.cumsum(counts)
        self.starts = self.ends - counts
        self.places = np.cumsum(unpack(steps).astype(np.int64))

    def postings(self, term: int) -> np.ndarray:
        return self.places[self.starts[term] : self.ends[term]]

    def document_of(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.bases, places, "right") - 1

    def find(self, window: list[int | None], slop: int = 0) -> np.ndarray:
        """Positions at which the window's first word stands, or would with each word at most ``slop`` off."""
        if None in window:
            return np.zeros(0, np.int64)
        by_rarity = sorted(range(len(window)), key=lambda k: self.ends[window[k]] - self.starts[window[k]])
        found = self.postings(window[by_rarity[0]]) - by_rarity[0]
        for k in by_rarity[1:]:
            if not len(found):
                break
            other = self.postings(window[k]) - k
            at = np.searchsorted(other, found - slop)
            near = other[np.minimum(at, len(other) - 1)]
            found = found[(at < len(other)) & (near >= found - slop) & (near <= found + slop)]
        return found


def windows_of(words: list[bytes], size: int = WINDOW) -> list[list[bytes]]:
    """All runs of ``size`` words; fewer words, but not none, are one window."""
    if not words:
        return []
    return [words[i : i + size] for i in range(max(1, len(words) - size + 1))]


def _search(row: dict, items: list[tuple[int, list[list[bytes]]]], slop: int) -> list[tuple]:
    """(doc number, spans as bytes, items) of the documents in a segment that any window hits."""
    segment = Segment(row["sizes"], row["terms"], row["lengths"], row["steps"])
    starts, widths, owners = [], [], []
    for n, windows in items:
        for window in windows:
            found = segment.find([segment.number.get(w) for w in window], slop)
            if len(found):
                starts.append(found)
                widths.append(np.full(len(found), len(window)))
                owners.append(np.full(len(found), n))
    if not starts:
        return []
    start, width, owner = map(np.concatenate, (starts, widths, owners))
    doc = segment.document_of(np.maximum(start, 0) if slop else start)
    out = []
    for d in np.unique(doc).tolist():
        mine = doc == d
        marks = np.zeros(int(segment.sizes[d]) + 1, np.int64)
        local = start[mine] - segment.bases[d]
        np.add.at(marks, np.clip(local, 0, len(marks) - 1), 1)
        np.add.at(marks, np.clip(local + width[mine], 0, len(marks) - 1), -1)
        covered = np.flatnonzero(np.cumsum(marks)[:-1] > 0)
        out.append((d, covered, np.unique(owner[mine])))
    return out


def search(index: DataFrame, benchmark: DataFrame, window: int = WINDOW, slop: int = 0) -> DataFrame:
    """``doc_id, seq, n_words, hit array<int>, items array<string>, unnamed`` for every document of ``index``.

    ``hit``: numbers of the words inside matches; ``seq`` is the row's number in the
    index. Items without an id are searched like others; ``unnamed`` says whether one
    was found, as ``items`` cannot. ``slop`` 0 finds exact phrases, more finds windows whose words stand at
    most so many words off. Matches of a benchmark larger than ``QUERY_BYTES``
    are found pass by pass and merged by document.
    """
    spark = index.sparkSession
    bounded_batches(spark)
    kind = index.schema["doc_ids"].dataType.elementType.simpleString()
    bench = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    total = bench.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    passes = max(1, -(-total // QUERY_BYTES))
    schema = f"doc_id {kind}, seq bigint, n_words bigint, hit array<int>, items array<string>, unnamed boolean"

    def matcher(shared, report_all: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            names = [n for n, _ in shared.value]
            items = [(i, windows_of(words_of(t), window)) for i, (_, t) in enumerate(shared.value)]
            for batch in batches:
                for row in batch.to_pylist():
                    hits = {d: (covered, owners) for d, covered, owners in _search(row, items, slop)}
                    docs = range(len(row["sizes"])) if report_all else sorted(hits)
                    none = (np.zeros(0, np.int64), np.zeros(0, np.int64))
                    cols = {"doc_id": [], "seq": [], "n_words": [], "hit": [], "items": [], "unnamed": []}
                    for d in docs:
                        covered, owners = hits.get(d, none)
                        cols["doc_id"].append(row["doc_ids"][d])
                        cols["seq"].append(row["first"] + d)
                        cols["n_words"].append(row["sizes"][d])
                        cols["hit"].append(covered.tolist())
                        found = {names[i] for i in owners.tolist()}
                        cols["items"].append(sorted(found - {None}))
                        cols["unnamed"].append(None in found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(cols["doc_id"], batch.schema.field("doc_ids").type.value_type),
                            pa.array(cols["seq"], pa.int64()), pa.array(cols["n_words"], pa.int64()),
                            pa.array(cols["hit"], pa.list_(pa.int32())), pa.array(cols["items"], pa.list_(pa.string())),
                            pa.array(cols["unnamed"], pa.bool_()),
                        ],
                        names=list(cols),
                    )

        return run

    found = None
    for k in range(passes):
        part = bench if passes == 1 else bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == k)
        shared = spark.sparkContext.broadcast([(r[0], r[1]) for r in part.toLocalIterator()])
        one = index.mapInArrow(matcher(shared, k == 0), schema)
        found = one if found is None else found.unionByName(one)
    if passes > 1:
        found = found.groupBy("doc_id", "seq").agg(
            F.max("n_words").alias("n_words"),
            F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.max("unnamed").alias("unnamed"),
        )
    return found


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for each row of ``docs``.

    Items without an id count as one item and have no place in the list of ids."""
    found = search(build_index(docs), benchmark)
    return found.select(
        "doc_id",
        "n_words",
        F.size("hit").cast("long").alias("n_hit"),
        (F.size("items") + F.col("unnamed").cast("int")).cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hit") > 0).alias("contaminated"),
    )


def filtered(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without any hit, with all their columns.

    Only 128-bit digests of the contaminated rows' ids and texts are joined, so repeated
    and null ids keep their own verdict; a row's verdict depends on its text alone.
    """
    halves = F.xxhash64("doc_id", "text"), F.xxhash64(F.lit(1), "text", "doc_id")
    key = F.concat(*(F.unhex(F.lpad(F.hex(h), 16, "0")) for h in halves))
    rows = docs.select(key.alias("doc_id"), "text")
    bad = staged(decontaminate(rows, benchmark).where("contaminated").select(F.col("doc_id").alias("_bad")).distinct(), "hits")
    return docs.join(bad, key == bad["_bad"], "left_anti")
