"""Exact substring de-duplication with suffix order and longest-previous-factor arrays.

A byte is covered if some string of ``LENGTH`` bytes over it also starts
elsewhere, in the same text or another. Comparing all texts in one suffix array
would put the corpus into one task, so Spark first brings together what can
match:

1. Every window of ``LENGTH`` bytes belongs to the smallest hash of the
   ``GRAM``-byte strings inside it, its anchor. Equal windows have equal
   anchors. Consecutive windows with one anchor form a stretch, one row of some
   180 bytes of text.
2. Stretches are counted by (anchor, digest of the whole stretch). An anchor
   seen once holds nothing repeated; a stretch seen twice is repeated as a
   whole. What is left are the different stretches of one anchor: the ends of
   repeated passages.
3. One copy of each of those goes, by anchor, to shards of bounded size. A
   shard sorts its suffixes and takes from the previous and next smaller (and
   larger) positions in suffix order the longest factor that also starts
   earlier (or later).
4. An anchor with more than ``HOT`` different stretches is not collected. Its
   windows are split into blocks and counted by the bytes that all windows of a
   block share and by all bytes of the block: a block whose shared bytes are
   unique holds nothing, one whose bytes repeat is covered, the rest is split
   again, down to single windows. No row is dropped or sampled.

Null text counts as empty. Rows are told apart by a 64-bit digest of id and text;
rows that repeat both are copies of each other. Whole stretches (at most 760 bytes)
are taken as equal if both their anchor's 64-bit hash and their own 64-bit digest
are; what is compared in shards and blocks is compared by its bytes or 128 bits.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, slices, staged

LENGTH = 400
#: Bytes of the strings whose hashes are compared within a window.
GRAM = 40
#: A longer text is cut into overlapping chunks of so many bytes.
CHUNK = 1 << 20
#: Different stretches of one anchor that a shard takes; more are split by blocks.
HOT = 1000
#: Bytes of a shard, about; a shard may hold one anchor's stretches more.
SHARD_BYTES = 1 << 20
#: Windows of a block, round by round.
BLOCKS = (64, 16, 4, 1)

_BASE = 0x9E3779B97F4A7C15
_INDEX_BITS = 22


def _mix(h: np.ndarray, seed: int = 0) -> np.ndarray:
    h = h + np.uint64(seed)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Hasher:
    """Hashes of any substrings of joined bytes, by prefix sums modulo 2 ** 64."""

    def __init__(self) -> None:
        self.powers = self.inverse = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        if len(self.powers) < len(data) + 1:
            n = len(data) + 1
            for name, base in (("powers", _BASE), ("inverse", pow(_BASE, -1, 1 << 64))):
                steps = np.full(n, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.powers[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
        return _mix((self.sums[end] - self.sums[start]) * self.inverse[start], seed)


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` values."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    shaped = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(shaped, axis=1).ravel()
    behind = np.minimum.accumulate(shaped[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def stretches(hasher: Hasher, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """First window, last window, anchor and digest of the stretches in joined chunks that end at ``ends``."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none
    hasher.load(data)
    at = np.arange(n - GRAM + 1)
    hashes = hasher.of(at, at + GRAM)
    mask = np.uint64((1 << _INDEX_BITS) - 1)
    least = sliding_least((hashes & ~mask) | at.astype(np.uint64), LENGTH - GRAM + 1)
    windows = np.arange(n - LENGTH + 1)
    end = np.repeat(ends, np.diff(ends, prepend=0))[: len(windows)]
    windows = windows[windows + LENGTH <= end]
    if not len(windows):
        return none, none, none, none
    anchor = (least[windows] & mask).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (np.diff(anchor) != 0) | (np.diff(windows) != 1)]))
    lo, hi = windows[first], windows[np.append(first[1:], len(windows)) - 1]
    digest = hasher.of(lo, hi + LENGTH, 0x5851F42D4C957F2D) + (hi - lo).astype(np.uint64)
    return lo, hi, hashes[anchor[first]].view(np.int64), digest.view(np.int64)


def _row_id(docs: DataFrame):
    return F.xxhash64("doc_id", "text")


def mark(docs: DataFrame) -> DataFrame:
    """Staged ``rid, anchor, digest, lo, hi``: the stretches of all texts (``lo``, ``hi``: first and last window)."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text", CHUNK):
            ids = batch.column("rid").to_pylist()
            parts: list[tuple[int, int, bytes]] = []
            for rid, text in zip(ids, batch.column("text").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass") if text else b""
                for at in range(0, max(len(raw) - LENGTH + 1, 0), CHUNK):
                    parts.append((rid, at, raw[at : at + CHUNK + LENGTH - 1]))
            while parts:
                total, k = 0, 0
                while k < len(parts) and (not k or total + len(parts[k][2]) <= 2 * CHUNK):
                    total += len(parts[k][2])
                    k += 1
                some, parts = parts[:k], parts[k:]
                data = np.frombuffer(b"".join(p[2] for p in some), np.uint8)
                ends = np.cumsum([len(p[2]) for p in some])
                lo, hi, anchor, digest = stretches(hasher, data, ends)
                which = np.searchsorted(ends, lo, "right")
                shift = np.array([p[1] for p in some]) - (ends - [len(p[2]) for p in some])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.array([p[0] for p in some])[which], pa.int64()), pa.array(anchor), pa.array(digest),
                        pa.array(lo + shift[which], pa.int32()), pa.array(hi + shift[which], pa.int32()),
                    ],
                    names=["rid", "anchor", "digest", "lo", "hi"],
                )

    rows = docs.select(_row_id(docs).alias("rid"), "text").mapInArrow(
        run, "rid bigint, anchor bigint, digest bigint, lo int, hi int"
    )
    return staged(rows, "stretches")


class Suffixes:
    """Order of the suffixes of joined bytes by their first ``LENGTH`` bytes."""

    STEPS = (8, 16, 32, 64, 128, 256)

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        """``starts``: the positions to order, each followed by at least ``LENGTH`` bytes."""
        self.data = np.concatenate([data, np.zeros(512, np.uint8)])
        n = len(data) + 256
        packed = np.zeros(n, np.uint64)
        for k in range(8):
            packed |= self.data[k : k + n].astype(np.uint64) << np.uint64(8 * (7 - k))
        rank = np.unique(packed, return_inverse=True)[1]
        self.ranks = {8: rank}
        for h in self.STEPS[:-1]:
            after = np.concatenate([rank[h:], np.zeros(h, rank.dtype)])
            rank = np.unique(rank * n + after, return_inverse=True)[1]
            self.ranks[2 * h] = rank
        self.starts = np.sort(starts)
        whole = rank[self.starts] * n + rank[self.starts + LENGTH - 256]
        # equal strings follow each other by position
        self.order = self.starts[np.argsort(whole, kind="stable")]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes a and b, ``LENGTH`` at most."""
        size = np.zeros(len(a), np.int64)
        for h in reversed(self.STEPS):
            at = np.minimum(size, LENGTH - h) if h > LENGTH - 256 else size
            size = np.where(self.ranks[h][a + at] == self.ranks[h][b + at], np.maximum(size, at + h), size)
        for _ in range(7):
            same = (size < LENGTH) & (self.data[a + size] == self.data[b + size])
            if not same.any():
                break
            size += same
        return np.minimum(size, LENGTH)

    def longest_factor(self, earlier: bool = True) -> np.ndarray:
        """By position in ``starts``: the longest prefix of each suffix that also starts earlier (or later)."""
        sa = self.order if earlier else -self.order
        best = np.zeros(len(sa), np.int64)
        for side in (nearest_smaller(sa), len(sa) - 1 - nearest_smaller(sa[::-1])[::-1]):
            has = np.flatnonzero((side >= 0) & (side < len(sa)))
            best[has] = np.maximum(best[has], self.common(self.order[has], self.order[side[has]]))
        out = np.empty(len(sa), np.int64)
        out[np.searchsorted(self.starts, self.order)] = best
        return out


def nearest_smaller(values: np.ndarray) -> np.ndarray:
    """Index of the nearest smaller value before each one, -1 without; all pointers jump together."""
    n = len(values)
    found = np.arange(-1, n - 1)
    todo = np.arange(n)
    while len(todo):
        at = found[todo]
        todo = todo[(at >= 0) & (values[np.maximum(at, 0)] > values[todo])]
        found[todo] = found[found[todo]]
    return found


def repeated_windows(texts: list[bytes], keep_first: bool = False) -> list[np.ndarray]:
    """For each text, which of its windows also start elsewhere in ``texts`` (with ``keep_first``: earlier)."""
    sizes = np.array([len(t) for t in texts], np.int64)
    counts = np.maximum(sizes - LENGTH + 1, 0)
    if not counts.sum():
        return [np.zeros(0, bool)] * len(texts)
    bases = np.cumsum(sizes) - sizes
    starts = np.concatenate([np.arange(b, b + c) for b, c in zip(bases.tolist(), counts.tolist())])
    suffixes = Suffixes(np.frombuffer(b"".join(texts), np.uint8), starts)
    longest = suffixes.longest_factor()
    if not keep_first:
        longest = np.maximum(longest, suffixes.longest_factor(earlier=False))
    return np.split(longest >= LENGTH, np.cumsum(counts)[:-1])


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of each run of true flags."""
    edge = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


SPANS = "rid bigint, start bigint, end bigint"


def _compare_shard(shard: pd.DataFrame) -> pd.DataFrame:
    shard = shard.sort_values(["anchor", "digest"])
    out = []
    for rid, lo, n, flags in zip(shard["rid"], shard["lo"], shard["n"], repeated_windows(list(shard["bytes"]))):
        if n == 1:
            first, last = runs(flags)
            out += [(rid, int(lo + a), int(lo + b + LENGTH)) for a, b in zip(first, last)]
    return pd.DataFrame(out, columns=["rid", "start", "end"], dtype="int64")


def _split(blocks: DataFrame, width: int) -> DataFrame:
    """Blocks of ``width`` windows with digests of the bytes shared by all windows, and of all bytes."""

    def digest(b: bytes) -> bytes:
        return hashlib.blake2b(b, digest_size=16).digest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for group, rid, lo, anchor_at, n, raw in zip(
                *(batch.column(c).to_pylist() for c in ("grp", "rid", "lo", "anchor_at", "n", "bytes"))
            ):
                count = len(raw) - LENGTH + 1
                # cut by distance to the anchor, so that the blocks of two rows agree
                cuts = [0, *range((anchor_at + 1) % width or width, count, width), count]
                for a, b in zip(cuts, cuts[1:]):
                    part = raw[a : b - 1 + LENGTH]
                    # what all windows share that a block of these distances may have, even if it has fewer here
                    near = (anchor_at - b + 1) // width * width
                    shared = raw[anchor_at - near : anchor_at - near - width + 1 + LENGTH]
                    out.append((digest(group + shared), digest(part), rid, lo + a, anchor_at - a, n, part))
            cols = list(zip(*out)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.int64()),
                    pa.array(cols[3], pa.int32()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.int64()),
                    pa.array(cols[6], pa.binary()),
                ],
                names=["grp", "whole", "rid", "lo", "anchor_at", "n", "bytes"],
            )

    return blocks.mapInArrow(
        run, "grp binary, whole binary, rid bigint, lo int, anchor_at int, n bigint, bytes binary"
    )


def _split_hot(hot: DataFrame) -> DataFrame:
    """Spans of the windows of ``hot`` stretches that repeat among them."""
    spans = None
    blocks = hot.select("grp", "rid", "lo", "anchor_at", "n", "bytes")
    for width in BLOCKS:
        rows = staged(_split(blocks, width), "blocks")
        kinds = rows.groupBy("grp", "whole").agg(F.count("*").alias("m"))
        groups = kinds.groupBy("grp").agg(F.sum("m").alias("total"), F.count("*").alias("kinds"))
        counted = kinds.join(groups, "grp").where("total > 1")
        one = rows.join(counted, ["grp", "whole"])
        covered = one.where("m > 1 and n = 1").select(
            "rid", F.col("lo").cast("long").alias("start"), (F.col("lo") + F.octet_length("bytes")).cast("long").alias("end")
        )
        spans = covered if spans is None else spans.union(covered)
        if width > 1:
            # one copy of each block that differs from others with the same shared bytes
            blocks = one.where("kinds > 1").groupBy("grp", "whole").agg(
                F.min_by(F.struct("rid", "lo", "anchor_at", "bytes"), F.struct("rid", "lo")).alias("r"),
                F.max(F.greatest("n", "m")).alias("n"),
            ).select("grp", "r.rid", "r.lo", "r.anchor_at", "n", "r.bytes")
            blocks = staged(blocks, "mixed")
    return spans


def spans_of(docs: DataFrame) -> DataFrame:
    """``rid, start, end``: byte spans of repeated windows, possibly overlapping."""
    marks = mark(docs)
    kinds = marks.groupBy("anchor", "digest").agg(F.count("*").alias("n"))
    groups = kinds.groupBy("anchor").agg(F.sum("n").alias("total"), F.count("*").alias("kinds"))
    counted = staged(kinds.join(groups, "anchor").where("total > 1").select("anchor", "digest", "n", "kinds"), "counted")
    shared = staged(marks.join(counted, ["anchor", "digest"]), "shared")
    covered = shared.where("n > 1").select(
        "rid", F.col("lo").cast("long").alias("start"), (F.col("hi") + LENGTH).cast("long").alias("end")
    )
    # one copy of each stretch whose anchor has others
    single = shared.where("kinds > 1 and n = 1").select("rid", "lo", "hi", "anchor", "digest", "n", "kinds")
    copies = shared.where("kinds > 1 and n > 1").groupBy("anchor", "digest").agg(
        F.min(F.struct("rid", "lo", "hi")).alias("r"), F.first("n").alias("n"), F.first("kinds").alias("kinds")
    )
    copies = copies.select("r.rid", "r.lo", "r.hi", "anchor", "digest", "n", "kinds")
    wanted = single.union(copies).groupBy("rid").agg(
        F.collect_list(F.struct("lo", "hi", "anchor", "digest", "n", "kinds")).alias("parts")
    )
    texts = docs.select(_row_id(docs).alias("rid"), "text").join(wanted, "rid")
    parts = staged(_cut(texts), "parts")
    total = parts.where(f"kinds <= {HOT}").agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    small = parts.where(f"kinds <= {HOT}").withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    found = small.groupBy("shard").applyInPandas(_compare_shard, SPANS)
    hot = parts.where(f"kinds > {HOT}").withColumn("grp", F.encode(F.col("anchor").cast("string"), "utf-8"))
    spans = covered.union(found)
    return spans if hot.isEmpty() else spans.union(_split_hot(hot))


def _cut(texts: DataFrame) -> DataFrame:
    """The bytes of the wanted stretches; a row that repeats id and text gives each of its stretches once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in slices(batches, "text"):
            out = []
            for rid, text, parts in zip(*(batch.column(c).to_pylist() for c in ("rid", "text", "parts"))):
                raw = text.encode("utf-8", "surrogatepass")
                for p in parts:
                    piece = raw[p["lo"] : p["hi"] + LENGTH]
                    _, _, _, at = _anchor_of(hasher, piece)
                    out.append((rid, p["lo"], at, p["anchor"], p["digest"], p["n"], p["kinds"], piece))
            cols = list(zip(*out)) or [()] * 8
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int32()),
                    pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.array(cols[5], pa.int64()),
                    pa.array(cols[6], pa.int64()), pa.array(cols[7], pa.binary()),
                ],
                names=["rid", "lo", "anchor_at", "anchor", "digest", "n", "kinds", "bytes"],
            )

    cut = texts.select("rid", "text", "parts").mapInArrow(
        run, "rid bigint, lo int, anchor_at int, anchor bigint, digest bigint, n bigint, kinds bigint, bytes binary"
    )
    return cut


def _anchor_of(hasher: Hasher, piece: bytes) -> tuple:
    """The stretch a piece is, with the anchor's place in it."""
    data = np.frombuffer(piece, np.uint8)
    hasher.load(data)
    at = np.arange(len(data) - GRAM + 1)
    hashes = hasher.of(at, at + GRAM)
    mask = np.uint64((1 << _INDEX_BITS) - 1)
    key = (hashes & ~mask) | at.astype(np.uint64)
    return 0, 0, 0, int(key[len(data) - LENGTH : LENGTH - GRAM + 1].argmin()) + len(data) - LENGTH


def removed(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept binary`` for each row of ``docs``."""
    spans = staged(spans_of(docs), "spans")
    by_row = spans.groupBy("rid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
    rows = docs.select("doc_id", "text", _row_id(docs).alias("rid")).join(by_row, "rid", "left")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            cols: list[list] = [[], [], [], []]
            for text, found in zip(batch.column("text").to_pylist(), batch.column("spans").to_pylist()):
                raw = text.encode("utf-8", "surrogatepass") if text else b""
                gone, count, at, kept = 0, 0, -1, []
                last = 0
                for s in sorted((x["start"], x["end"]) for x in found or ()):
                    if s[0] > at:
                        kept.append(raw[last : s[0]])
                        count += 1
                        gone += s[1] - s[0]
                    else:
                        gone += max(0, s[1] - at)
                    at = last = max(at, s[1])
                kept.append(raw[last:])
                for c, v in zip(cols, (len(raw), gone, count, b"".join(kept))):
                    c.append(v)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    schema = f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return rows.select("doc_id", "text", "spans").mapInArrow(run, schema)


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs``."""
    return removed(docs).withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
