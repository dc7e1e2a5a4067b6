"""Token ids in files coded by a static range asymmetric numeral system.

The texts are encoded by a tokenizer, staged once, and counted by Spark; the
counts make one frequency table that all blocks share. The documents are then
dealt into ranges by id, and every task codes its range in blocks of whole
documents. A block has ``lanes`` interleaved states, its own checkpoints (the
states and the place in the word stream from which decoding can begin) and a
checksum, so blocks, and the parts between checkpoints, decode in parallel.

The file format is a Parquet table, which gives atomic, retried writes on any
store that Spark reaches: one row for each block with its documents, checkpoints
and payload; the frequency table is written beside it.

Null text counts as empty and gives the end id alone. Rows with null ids come
first; rows that repeat an id follow each other in an order fixed by their text.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Callable, Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .bpe import PieceIds, PreTokenizer, class_table, encode_texts
from .common import bounded_batches, shared_folder, slices, staged, texts_of

#: Frequencies of the table add up to 2 ** SCALE_BITS; it has room for every id that occurs.
SCALE_BITS = 20
#: States are kept in [2 ** 31, 2 ** 63) and give off 32 bits at a time.
LOW = np.uint64(1 << 31)
LANES = 1024
#: Ids of a block, about: it ends with the document that reaches this.
BLOCK_IDS = 1 << 17
#: Steps (ids of one lane) between checkpoints.
CHECKPOINT_STEPS = 128

CHECK = {"lanes": "int", "states": "binary", "places": "array<bigint>", "crc32": "bigint"}


def frequencies(ids: np.ndarray, counts: np.ndarray, scale_bits: int = SCALE_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Frequencies (each at least 1, adding up to 2 ** scale_bits) of the ids, sorted by id."""
    order = np.argsort(ids)
    ids, counts = ids[order], counts[order].astype(np.float64)
    total = 1 << scale_bits
    if len(ids) > total:
        raise ValueError(f"{len(ids)} ids do not fit into a table of {total}")
    if not len(ids):
        return ids, np.zeros(0, np.int64)
    freq = 1 + np.floor(counts / counts.sum() * (total - len(ids))).astype(np.int64)
    freq[np.argmax(freq)] += total - freq.sum()
    return ids, freq


class Coder:
    """Codes ids by one frequency table."""

    def __init__(self, ids: np.ndarray, freq: np.ndarray, scale_bits: int = SCALE_BITS):
        self.bits = np.uint64(scale_bits)
        self.ids = ids.astype(np.int64)
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.slot = np.zeros(int(ids.max()) + 1 if len(ids) else 1, np.int64)
        self.slot[self.ids] = np.arange(len(ids))
        self.symbol = np.repeat(np.arange(len(ids), dtype=np.int32), freq)

    def encode(self, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> tuple:
        """(lanes, states at checkpoints, places of checkpoints, words) of a block."""
        n = len(ids)
        lanes = max(1, min(lanes, n // 64))
        steps = -(-n // lanes)
        symbols = self.slot[ids]
        freq, start = self.freq[symbols], self.start[symbols]
        limit, rest = freq << (np.uint64(63) - self.bits), (np.uint64(1) << self.bits) - freq
        state = np.full(lanes, LOW, np.uint64)
        quotient = np.empty(lanes, np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []
        given = 0
        for t in range(steps - 1, -1, -1):
            part = slice(t * lanes, min((t + 1) * lanes, n))
            x, q = state[: part.stop - part.start], quotient[: part.stop - part.start]
            full = np.flatnonzero(x >= limit[part])
            if len(full):
                out = x[full]
                words.append(out.astype("<u4"))
                x[full] = out >> np.uint64(32)
                given += len(out)
            # (x // f << bits) + x % f + start, in place
            np.floor_divide(x, freq[part], out=q)
            q *= rest[part]
            x += q
            x += start[part]
            if t % every == 0:
                marks.append((given, state.copy()))
        # words are read in the opposite order; a place counts from the front
        places = [given - g for g, _ in reversed(marks)]
        states = np.concatenate([m for _, m in reversed(marks)]) if marks else np.zeros(0, np.uint64)
        stream = np.concatenate(words[::-1]) if words else np.zeros(0, "<u4")
        return lanes, states.astype("<u8").tobytes(), places, stream.tobytes()

    def decode(
        self, n: int, lanes: int, states: bytes, places: list[int], payload: bytes,
        every: int = CHECKPOINT_STEPS, part: int | None = None,
    ) -> np.ndarray:
        """All ids of a block, or those from checkpoint ``part`` to the next."""
        marks = np.frombuffer(states, "<u8").reshape(-1, lanes) if states else np.zeros((0, lanes), np.uint64)
        words = np.frombuffer(payload, "<u4").astype(np.uint64)
        first = 0 if part is None else part * every
        last = -(-n // lanes) if part is None else min(first + every, -(-n // lanes))
        out = np.empty(max(0, min(n, last * lanes) - first * lanes), np.int32)
        if not len(out):
            return out
        state, at = marks[part or 0].copy(), places[part or 0]
        mask = (np.uint64(1) << self.bits) - np.uint64(1)
        for t in range(first, last):
            size = min(lanes, n - t * lanes)
            x = state[:size]
            low = x & mask
            s = self.symbol.take(low.view(np.int64))
            out[(t - first) * lanes : (t - first) * lanes + size] = s
            x >>= self.bits
            x *= self.freq.take(s)
            x += low
            x -= self.start.take(s)
            need = np.flatnonzero(x < LOW)
            if len(need):
                x[need] = (x[need] << np.uint64(32)) | words[at : at + len(need)]
                at += len(need)
        return self.ids[out]


def _pack(ids: np.ndarray) -> bytes:
    """Ids in as few bytes as their largest needs, compressed."""
    kind = "<u2" if not len(ids) or ids.max() < 1 << 16 else "<u4"
    return kind.encode() + zstandard.ZstdCompressor(1).compress(ids.astype(kind).tobytes())


def _unpack(data: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data[3:]), data[:3].decode()).astype(np.int64)


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in the vocabularies of byte-level tokenizers."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(rest)}


def added_tokens(data: str) -> list[tuple[re.Pattern, list[int]]]:
    """Patterns of the JSON file's added tokens, each group with its id; those matched before normalising come first."""
    out = []
    known = json.loads(data).get("added_tokens") or []
    for normalized in (False, True):
        found = [t for t in known if bool(t.get("normalized")) == normalized and t["content"]]
        found.sort(key=lambda t: -len(t["content"]))  # of two at one place, the longer
        parts = []
        for t in found:
            word = ("(?<!\\w)", "(?!\\w)") if t.get("single_word") else ("", "")
            left, right = ("\\s*" if t.get(k) else "" for k in ("lstrip", "rstrip"))
            parts.append(f"({left}{word[0]}{re.escape(t['content'])}{word[1]}{right})")
        if parts:
            out.append((re.compile("|".join(parts)), [t["id"] for t in found]))
    return out


def split_added(text: str, added: list[tuple[re.Pattern, list[int]]]) -> list[str | int]:
    """The text between added tokens, and their ids, in order."""
    parts: list[str | int] = [text]
    for pattern, ids in added:
        after: list[str | int] = []
        for part in parts:
            at = 0
            if isinstance(part, str):
                for m in pattern.finditer(part):
                    after += [part[at : m.start()], ids[m.lastindex - 1]]
                    at = m.end()
            after.append(part[at:] if isinstance(part, str) else part)
        parts = after
    return parts


def encode_all(texts: list[str], added: list, pre: PreTokenizer, ids_of: PieceIds) -> tuple[np.ndarray, np.ndarray]:
    """Ids of the texts one after another, and where each begins: added tokens first, then pieces of what is between."""
    split = [split_added(t, added) for t in texts]
    if all(len(parts) == 1 for parts in split):
        return encode_texts(texts, pre, ids_of)[:2]
    ids, upto, _, _ = encode_texts([x for parts in split for x in parts if isinstance(x, str)], pre, ids_of)
    bounds = iter(zip(upto[:-1].tolist(), upto[1:].tolist()))
    out, sizes = [], [0]
    for parts in split:
        mine = [[x] if isinstance(x, int) else ids[slice(*next(bounds))] for x in parts]
        out += mine
        sizes.append(sum(map(len, mine)))
    return np.concatenate(out).astype(ids.dtype), np.cumsum(sizes)


def finder(data: str) -> Callable[[list[bytes]], list[bytes]]:
    """The function for :class:`PieceIds` that asks the model of the tokenizers library."""
    from tokenizers import Tokenizer

    model, letters = Tokenizer.from_str(data).model, _byte_letters()

    def find(pieces: list[bytes]) -> list[bytes]:
        # one translation for all: each byte becomes one letter
        spelled = b"".join(pieces).decode("latin-1").translate(letters)
        ends = list(accumulate(map(len, pieces)))
        return [
            array("I", [t.id for t in model.tokenize(spelled[a:b])]).tobytes() for a, b in zip([0, *ends], ends)
        ]

    return find


def tokenized(docs: DataFrame, tokenizer_path: str, end_id: int) -> DataFrame:
    """Staged ``doc_id, tie, ids binary`` and, for each task, its counts of ids (``tie`` null).

    Added tokens of the JSON file are matched first, as the tokenizers library
    does with its default settings. Pieces of the rest come from the pre-tokenizer
    of :mod:`bpe`; each distinct piece is encoded by the library's model and kept.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    with open(tokenizer_path, encoding="utf-8") as f:
        # the list is filled by each Python worker, which keeps what it holds from task to task
        shared = spark.sparkContext.broadcast((f.read(), class_table().tobytes(), []))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data, classes, kept = shared.value
        if not kept:
            kept.append((added_tokens(data), PreTokenizer(np.frombuffer(classes, np.uint8)), PieceIds(finder(data))))
        added, pre, ids_of = kept[0]
        counts = np.zeros(1, np.int64)
        empty = None
        for batch in slices(batches, "text", 4 << 20):
            ids, upto = encode_all(texts_of(batch), added, pre, ids_of)
            found = np.bincount(np.append(ids, end_id))
            found[end_id] += len(batch) - 1
            if len(found) > len(counts):
                counts, found = found, counts
            counts[: len(found)] += found
            blobs = [_pack(np.append(ids[a:b], end_id)) for a, b in zip(upto[:-1].tolist(), upto[1:].tolist())]
            empty = batch.slice(0, 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("tie"), pa.array(blobs, pa.binary())],
                names=["doc_id", "tie", "ids"],
            )
        if empty is not None:
            used = np.flatnonzero(counts)
            row = zstandard.ZstdCompressor(3).compress(np.stack([used, counts[used]]).astype("<i8").tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(1, empty.column("doc_id").type), pa.nulls(1, pa.int64()), pa.array([row], pa.binary())],
                names=["doc_id", "tie", "ids"],
            )

    rows = docs.select("doc_id", F.xxhash64("text").alias("tie"), "text")
    return staged(rows.mapInArrow(run, f"doc_id {kind}, tie bigint, ids binary"), "ids")


def count_ids(staged_ids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all ids (at most one for each of the vocabulary), from the tasks' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.column("ids").to_pylist():
                ids, n = np.frombuffer(zstandard.ZstdDecompressor().decompress(row), "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(n)], names=["id", "n"])

    rows = staged_ids.where("tie is null").select("ids").mapInArrow(run, "id bigint, n bigint")
    found = rows.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return found["id"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2) -> None:
    """Write the ids of ``docs``, each followed by ``end_id``, in ascending doc_id order to ``path``."""
    spark = docs.sparkSession
    rows = tokenized(docs, tokenizer_path, end_id)
    ids, freq = frequencies(*count_ids(rows))
    spark.createDataFrame(zip(ids.tolist(), freq.tolist()), "id bigint, freq bigint").coalesce(1).write.parquet(f"{path}/table")
    shared = spark.sparkContext.broadcast((ids, freq))  # bounded by the vocabulary
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)
        names: list = []
        parts: list[np.ndarray] = []
        number = before = 0

        def block(id_type: pa.DataType) -> pa.RecordBatch:
            nonlocal number, before, names, parts
            every = np.concatenate(parts)
            lanes, states, places, payload = coder.encode(every)
            columns = {
                "block": pa.array([number], pa.int64()), "first": pa.array([before], pa.int64()),
                "doc_ids": pa.array([names], pa.list_(id_type)),
                "sizes": pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                "lanes": pa.array([lanes], pa.int32()), "states": pa.array([states], pa.binary()),
                "places": pa.array([places], pa.list_(pa.int64())),
                "crc32": pa.array([zlib.crc32(every.astype("<u4").tobytes())], pa.int64()),
                "payload": pa.array([payload], pa.binary()),
            }
            number, before, names, parts = number + 1, before + len(every), [], []
            return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

        held = 0
        for batch in batches:
            kind = batch.column("doc_id").type
            for name, data in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist()):
                names.append(name)
                parts.append(_unpack(data))
                held += len(parts[-1])
                if held >= BLOCK_IDS:
                    yield block(kind)
                    held = 0
        if names:
            yield block(kind)

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.where("tie is not null").repartitionByRange(partitions, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    schema = (
        f"block bigint, first bigint, doc_ids array<{kind}>, sizes array<bigint>, lanes int, states binary, "
        "places array<bigint>, crc32 bigint, payload binary"
    )
    blocks = ranged.select("doc_id", "ids").mapInArrow(run, schema).withColumn("shard", F.spark_partition_id())
    blocks.write.parquet(f"{path}/blocks")


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids binary`` (unsigned 32-bit, little-endian) of each document in the files."""
    table = spark.read.parquet(f"{path}/table").toPandas().sort_values("id")
    shared = spark.sparkContext.broadcast((table["id"].to_numpy(np.int64), table["freq"].to_numpy(np.int64)))
    blocks = spark.read.parquet(f"{path}/blocks")
    kind = blocks.schema["doc_ids"].dataType.elementType.simpleString()
    # where each range's ids begin among all: one row for each range
    totals = blocks.groupBy("shard").agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x)).alias("total"))
    rows = sorted((r["shard"], r["total"]) for r in totals.collect())
    bases, base = [], 0
    for shard, total in rows:
        bases.append((shard, base))
        base += total
    offsets = spark.createDataFrame(bases, "shard int, base bigint")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(*shared.value)
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1).to_pylist()[0]
                sizes = np.array(row["sizes"], np.int64)
                ids = coder.decode(int(sizes.sum()), row["lanes"], row["states"], row["places"], row["payload"])
                raw = ids.astype("<u4").tobytes()
                if zlib.crc32(raw) != row["crc32"]:
                    raise ValueError(f"checksum of block {row['block']} of range {row['shard']} differs")
                ends = np.cumsum(sizes)
                parts = [raw[4 * (e - n) : 4 * e] for e, n in zip(ends.tolist(), sizes.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_ids").slice(i, 1).flatten(), pa.array(row["first"] + ends - sizes),
                        pa.array(sizes), pa.array(parts, pa.binary()), pa.array(np.full(len(sizes), row["shard"]), pa.int32()),
                    ],
                    names=["doc_id", "local", "n_tokens", "ids", "shard"],
                )

    found = blocks.mapInArrow(run, f"doc_id {kind}, local bigint, n_tokens bigint, ids binary, shard int")
    return found.join(F.broadcast(offsets), "shard").select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids"
    )


def report(docs: DataFrame, tokenizer_path: str, end_id: int = 2) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from files written and read back."""
    path = shared_folder(docs.sparkSession, "rans")
    write(docs, path, tokenizer_path, end_id)
    return read(docs.sparkSession, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))
