"""Collocations by Toivonen mining: a sample proposes phrases, full passes count them exactly.

Phrases are runs of one to four words inside a piece of text, counted for each
language. A part of a frequent phrase is frequent too, so the frequent phrases
are closed downwards and a phrase is worth counting only if the phrase without
its last word and the phrase without its first word are.

1. A quarter of the documents, chosen by hash, is mined level by level with a
   lowered threshold. What it finds is the proposal.
2. A pass over all documents counts every phrase whose two shorter parts are
   proposed: the proposal itself and its negative border (the smallest phrases
   outside it). All single words are counted.
3. Frequent phrases of the border are failures of the sample. They join the
   proposal, and a further pass counts the phrases that this brings in, until
   no pass finds a failure. A pass reaches at least one word further, so there
   are at most four.
4. These passes count 62-bit hashes, which can only make a phrase look more
   frequent than it is. A last pass counts what is left by its text, exactly.

Sets of hashes travel as bit filters of ``FILTER_WORDS`` 64-bit words, a bound
that does not depend on the corpus. A phrase that a filter holds by chance is
counted needlessly; no result depends on it. The rule by which a pass counts
depends on the phrase alone, so each phrase is counted whole, in one pass.

Scores divide whole numbers in 38 digits. A language's first phrases are found
by a tournament of salted groups, so no task ranks all candidates of one.

Null texts are empty, null languages are ``und``, rows without an id take part
like any other and repeated rows count each time. Very long texts are cut into
blocks between words, with the last three words carried over. Ties end in the
order of the phrase's bytes. Other columns are not read. An empty table gives
no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, merged_slices, staged

LONGEST = 4
#: Occurrences from which a phrase is a candidate.
SUPPORT = 30
#: A candidate falls if a longer one holds it and has at least this percentage of its occurrences.
COVERED_PERCENT = 80
SCALE = 2_000_000
FIRST = 2000
#: One of so many documents is in the sample, and the occurrences there that propose a phrase.
SAMPLE_OF, SAMPLE_SUPPORT = 4, 3
#: 64-bit words of the filter (8 MiB).
FILTER_WORDS = 1 << 20
#: Bytes of text that are read together, hashes and texts that are counted together.
BLOCK_BYTES, HELD_HASHES, HELD_TEXTS = 2 << 20, 4 << 20, 700_000
#: Input splits that a task of the last pass reads, as long as each core has two tasks.
SPLITS = 4
#: Groups of the tournament's rounds.
SALTS = (256, 16, 1)

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes(
    10 if b in _SEPARATORS else 32 if b == 9 else b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)
)
_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX[1])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[2])
    return h ^ (h >> np.uint64(31))


def _seed(lang: str) -> np.uint64:
    return np.uint64(xxhash.xxh3_64_intdigest(lang.encode("utf-8", "surrogatepass")))


def _longer(h: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases that have one more word."""
    return _mix(h * np.uint64(_MIX[0]) + word)


def _coded(h: np.ndarray, size: int) -> np.ndarray:
    """The hash with the phrase's size in its two lowest bits."""
    return h & ~np.uint64(3) | np.uint64(size - 1)


def _place(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The filter's word of each coded hash and the four bits that it sets there."""
    mask = np.zeros(len(h), np.uint64)
    for k in range(4):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * k + 2)) & np.uint64(63))
    return ((h >> np.uint64(32)) % np.uint64(FILTER_WORDS)).astype(np.int64), mask


def _holds(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at, mask = _place(h)
    return (bits[at] & mask) == mask


def blocks(raw: bytes, limit: int = BLOCK_BYTES) -> Iterator[tuple[bytes, int]]:
    """Lower-cased parts of about ``limit`` bytes, and how many words at the start of each were in the one before."""
    raw, back = raw.translate(_TABLE), b""
    start = carried = 0
    while len(raw) - start > limit:
        cut = max(raw.rfind(mark, start + 1, start + limit) for mark in (b" ", b"\n"))
        if cut < 0:  # one word is longer than a block
            cut = min((p for mark in (b" ", b"\n") if (p := raw.find(mark, start + limit)) >= 0), default=len(raw))
        part = back + raw[start:cut]
        yield part, carried
        # the words after the last end of a piece may begin phrases that go on
        tail = part[part.rfind(b"\n") + 1 :].split()[1 - LONGEST :]
        carried, back, start = len(tail), b" ".join(tail), cut
    yield back + raw[start:], carried


class Reader:
    """Finds words and their hashes in lower-cased bytes, all at once.

    The hash of a word is the sum of a random number for each byte times a power
    of its place, taken from running sums over the block.
    """

    BASE = 0x9E3779B97F4A7C15

    def __init__(self, tables: int = 1) -> None:
        random = np.random.default_rng(11)
        self.tables = [random.integers(0, 1 << 64, 256, np.uint64) for _ in range(tables)]
        self.up = self.down = np.zeros(0, np.uint64)

    def words(self, raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Starts, ends, numbers of the pieces and hashes (one array for each table)."""
        data = np.frombuffer(raw, np.uint8)
        n = len(data)
        if len(self.up) < n + 1:
            self.up, self.down = (
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, k, np.uint64))])
                for k in (self.BASE, pow(self.BASE, -1, 1 << 64))
            )
        mark = data == 10
        inside = np.zeros(n + 2, bool)
        np.logical_not(mark | (data == 32), out=inside[1:-1])
        starts = np.flatnonzero(inside[1:] & ~inside[:-1])
        ends = np.flatnonzero(inside[:-1] & ~inside[1:])
        piece = np.cumsum(mark, dtype=np.int32)[starts]
        hashes = []
        for table in self.tables:
            sums = np.zeros(n + 1, np.uint64)
            np.cumsum(table[data] * self.up[:n], out=sums[1:])
            hashes.append(_mix((sums[ends] - sums[starts]) * self.down[starts]))
        return starts, ends, piece, hashes


def _joined(piece: np.ndarray, size: int, carried: int) -> np.ndarray:
    """Where phrases of ``size`` words lie in one piece and end behind the words carried over."""
    ok = piece[: len(piece) - size + 1] == piece[size - 1 :]
    ok[: max(carried - size + 1, 0)] = False
    return ok


def admitted(
    reader: Reader, raw: bytes, carried: int, lang: str, sizes: range, have: np.ndarray, before: np.ndarray | None
) -> Iterator[np.ndarray]:
    """Coded hashes of the phrases whose two shorter parts ``have`` holds, and ``before`` did not."""
    _, _, piece, (word,) = reader.words(raw)
    h = _mix(word + _seed(lang))
    for size in range(1, min(sizes.stop, len(word) + 1)):
        ok = _joined(piece, size, carried)
        if size > 1:
            parts = _coded(h, size - 1)
            known = _holds(have, parts)
            ok &= known[:-1] & known[1:]
            if before is not None:
                old = _holds(before, parts)
                ok &= ~(old[:-1] & old[1:])
            h = _longer(h[:-1], word[size - 1 :])
        if size in sizes:
            yield _coded(h[ok], size)


def spelt(reader: Reader, raw: bytes, carried: int, lang: str, wanted: np.ndarray) -> Iterator[tuple[int, list[bytes], np.ndarray]]:
    """``size, phrases, counts`` of the block's phrases whose hashes ``wanted`` holds."""
    starts, ends, piece, hashes = reader.words(raw)
    seed, n = _seed(lang), len(starts)
    h = [_mix(word + seed) for word in hashes]
    for size in range(1, min(LONGEST, n) + 1):
        if size > 1:
            h = [_longer(x[:-1], word[size - 1 :]) for x, word in zip(h, hashes)]
        at = np.flatnonzero(_joined(piece, size, carried) & _holds(wanted, _coded(h[0], size)))
        if not len(at):
            continue
        one, two = (x[at] for x in h)
        _, first, group, count = np.unique(one, return_index=True, return_inverse=True, return_counts=True)
        if (two != two[first][group]).any():  # 128 bits tell phrases apart
            both = np.stack([one, two], axis=1)
            _, first, count = np.unique(both, axis=0, return_index=True, return_counts=True)
        left, right = starts[at[first]], ends[at[first] + size - 1]
        found = [raw[a:b] for a, b in zip(left.tolist(), right.tolist())]
        if size > 1:
            found = [p if p.count(b" ") == size - 1 else b" ".join(p.split()) for p in found]
        yield size, found, count


def _sources(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, bytes]]:
    """Texts of one language, joined by line ends."""
    for batch in merged_slices(batches, "raw", BLOCK_BYTES):
        for lang in pc.unique(batch.column("lang")).to_pylist():
            texts = batch.column("raw").filter(pc.equal(batch.column("lang"), lang)).to_pylist()
            yield lang, b"\n".join(texts)


def _texts(docs: DataFrame) -> DataFrame:
    bounded_batches(docs.sparkSession)
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), text.alias("raw"))


def hashes(texts: DataFrame, sizes: range, have: np.ndarray, before: np.ndarray | None = None) -> DataFrame:
    """``hash, f`` of the admitted phrases."""
    shared = texts.sparkSession.sparkContext.broadcast((have, before))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, (now, past) = Reader(), shared.value
        held: list[np.ndarray] = []
        total = 0
        for lang, source in _sources(batches):
            for raw, carried in blocks(source):
                for found in admitted(reader, raw, carried, lang, sizes, now, past):
                    held.append(found)
                    total += len(found)
                if total > HELD_HASHES:
                    yield _batch(held)
                    held, total = [], 0
        if held:
            yield _batch(held)

    def _batch(held: list[np.ndarray]) -> pa.RecordBatch:
        found, count = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(count)], names=["hash", "f"])

    return texts.mapInArrow(run, "hash bigint, f bigint").groupBy("hash").agg(F.sum("f").alias("f"))


def phrases(texts: DataFrame, wanted: np.ndarray) -> DataFrame:
    """``lang, size, phrase, f`` of the phrases that ``wanted`` holds; size 0 has the number of all words.

    A task hands on each of its phrases once, so a few larger tasks hand on less.
    """
    splits, cores = texts.rdd.getNumPartitions(), texts.sparkSession.sparkContext.defaultParallelism
    texts = texts.coalesce(max(-(-splits // SPLITS), 2 * cores))
    shared = texts.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(2)
        held: dict[tuple[str, int], Counter[bytes]] = {}
        for lang, source in _sources(batches):
            words = held.setdefault((lang, 0), Counter())
            for raw, carried in blocks(source):
                words[b""] += len(raw.split()) - carried
                for size, found, count in spelt(reader, raw, carried, lang, shared.value):
                    counter = held.setdefault((lang, size), Counter())
                    for phrase, n in zip(found, count.tolist()):
                        counter[phrase] += n
            if sum(map(len, held.values())) > HELD_TEXTS:
                yield from map(_batch, held.items())
                held = {}
        yield from map(_batch, held.items())

    def _batch(item: tuple[tuple[str, int], Counter[bytes]]) -> pa.RecordBatch:
        (lang, size), counter = item
        n = len(counter)
        return pa.RecordBatch.from_arrays(
            [pa.array([lang]).take(pa.array(np.zeros(n, np.int64))), pa.array(np.full(n, size, np.int32)),
             pa.array(counter.keys(), pa.binary()), pa.array(counter.values(), pa.int64())],
            names=["lang", "size", "phrase", "f"],
        )

    rows = texts.mapInArrow(run, "lang string, size int, phrase binary, f bigint")
    return rows.groupBy("lang", "size", "phrase").agg(F.sum("f").alias("f"))


def gathered(found: DataFrame) -> np.ndarray:
    """The filter of all ``hash``: at most ``FILTER_WORDS`` rows come to the driver, however many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, mask = _place(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(mask.view(np.int64))], names=["at", "mask"])

    places = found.select("hash").mapInArrow(run, "at bigint, mask bigint")
    rows = places.groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    bits = np.zeros(FILTER_WORDS, np.uint64)
    bits[rows.column("at").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return bits


def proposal(docs: DataFrame, sample_of: int = SAMPLE_OF, support: int = SAMPLE_SUPPORT) -> np.ndarray:
    """The filter of the phrases that occur ``support`` times in the sample; the longest cannot be part of others."""
    keyed = docs.where(F.pmod(F.xxhash64(F.col("doc_id"), F.col("text")), F.lit(sample_of)) == 0)
    sample = staged(_texts(keyed), "sample")
    have = np.zeros(FILTER_WORDS, np.uint64)
    for size in range(1, LONGEST):
        have = have | gathered(hashes(sample, range(size, size + 1), have).where(F.col("f") >= support))
    return have


def frequent(
    docs: DataFrame, support: int = SUPPORT, sample_of: int = SAMPLE_OF, sample_support: int = SAMPLE_SUPPORT
) -> DataFrame:
    """``lang, size, phrase, f`` of every phrase of up to four words with ``f >= support``, exactly; size 0 holds all words."""
    have, before = proposal(docs, sample_of, sample_support), None
    texts, wanted = _texts(docs), np.zeros(FILTER_WORDS, np.uint64)
    while True:
        sizes = range(1 if before is None else 2, LONGEST + 1)
        often = staged(hashes(texts, sizes, have, before).where(F.col("f") >= support), "often")
        wanted = wanted | gathered(often)
        # failures of the sample: frequent, but not proposed; the longest bring nothing in
        failed = gathered(often.where(F.col("hash").bitwiseAND(3) < LONGEST - 1)) & ~have
        if not failed.any():
            break
        before, have = have, have | failed
    exact = phrases(texts, wanted)
    return staged(exact.where((F.col("f") >= support) | (F.col("size") == 0)), "phrases")


def scored(found: DataFrame) -> DataFrame:
    """``lang, size, phrase, a, l, r, score``: each candidate at its worst cut, without those that a longer one covers."""
    text = found.where("size > 0").select("lang", "size", F.col("phrase").cast("string").alias("phrase"), "f")
    split = text.where("size > 1").select("lang", "size", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    cuts = split.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "lang", "size", "phrase", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    )
    heads = text.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    rests = text.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    wide = "cast({} as decimal(19,0))".format
    score = F.expr(f"{wide('a')} * {SCALE} div ({wide('l')} + {wide('r')})")
    cuts = cuts.join(heads, ["lang", "head"]).join(rests, ["lang", "rest"]).withColumn("score", score)
    best = cuts.groupBy("lang", "size", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    inner = split.where("size > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    inner = inner.withColumn("s", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("m") + 1)))
    inner = inner.select("lang", F.array_join(F.slice("w", F.col("s"), F.col("m")), " ").alias("phrase"), "a")
    longer = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    covered = F.col("most").cast("decimal(19,0)") * 100 >= F.col("a").cast("decimal(19,0)") * COVERED_PERCENT
    kept = best.join(longer, ["lang", "phrase"], "left").where(~F.coalesce(covered, F.lit(False)))
    return kept.select("lang", "size", "phrase", "a", "cut.l", "cut.r", "cut.score")


def ranked(rows: DataFrame, first: int = FIRST) -> DataFrame:
    """The first ``first`` of each language, with ``rank``; groups shrink round by round."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    for salts in SALTS:
        group = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(salts))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(group).cast("bigint")).where(F.col("rank") <= first)
    return rows


def collocations(docs: DataFrame, support: int = SUPPORT, first: int = FIRST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first collocations of each language."""
    found = frequent(docs, support)
    total = found.where("size = 0").select("lang", F.col("f").alias("n"))
    return ranked(scored(found), first).join(total, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def report(docs: DataFrame) -> DataFrame:
    return collocations(docs)
