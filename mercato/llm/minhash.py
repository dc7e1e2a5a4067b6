"""Near-duplicate documents by HyperMinHash sketches, banding and exact verification.

A document's set has its distinct shingles of five lower-cased words. The
sketch has ``REPEATS`` x ``BUCKETS`` registers: in each repeat a shingle's hash
chooses a bucket, and the bucket keeps the smallest remaining hash as its count
of leading zeros and the mantissa bits behind them. Bands are hashed to keys; documents
that share a key are candidates. Keys take the whole minima, from which the
registers are cut: a small set fills one register of a band or two, and equal
registers alone would be shared by many unrelated small sets. Rows with equal
sets are one class from the start, so copies never meet pair by pair.

Candidates of a key are not all paired. First each class is compared with the
smallest of its key (a star) and the links found make components; then only
keys that still hold several components go on. Of their classes those that
share a rare shingle are brought together, and there only classes of different
components are compared, inside blocks of bounded size. The
collision-corrected estimate from two sketches discards pairs far below the
threshold, and what is left is verified on the full sets; a block emits the
links that join components, not its pairs.
Components come from label propagation over the links.

Null or wordless texts have empty sets and are linked with nothing. Fewer
words than five are one shingle. Rows that repeat a document id count as
separate rows with the same id. A set that only rows without an id have is
linked with nothing in the report, where such rows are kept; ``filtered`` links
them too. Other columns are not read but by ``filtered``, to tell rows apart.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StructField

from .common import bounded_batches, free_names, quoted, slices, staged, texts_of

SHINGLE = 5
#: Link if 100 * |intersection| >= LEAST_PERCENT * |union|.
LEAST_PERCENT = 75
REPEATS, BUCKETS = 8, 16
REGISTERS = REPEATS * BUCKETS
#: Registers of a band: a pair at 0.75 shares none of the 32 bands with probability below 1e-5.
ROWS = 4
BANDS = REGISTERS // ROWS
#: A register of 16 bits: 6 for the leading zeros, the rest for the mantissa.
MANTISSA_BITS = 10
REGISTER = np.uint16
#: Estimates this far below the threshold are discarded (over six standard errors of 128 registers).
ESTIMATE_SLACK = 0.25
#: Classes, and bytes of their sets, of one group when different components are compared.
BLOCK, BLOCK_BYTES = 512, 2 << 20

_MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
EMPTY = REGISTER(0xFFFF)
#: The minimum of a bucket without values; others end in four zero bits.
NO_MINIMUM = np.uint64(0xFFFFFFFFFFFFFFFF)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads all bits."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX[1])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[2])
    return h ^ (h >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def shingles_of(texts: list[str | None], hashes: WordHashes, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's shingles."""
    words = [(t or "").encode("utf-8", "surrogatepass").translate(_LOWER).split() for t in texts]
    counts = [len(w) for w in words]
    flat = np.fromiter(map(hashes.__getitem__, chain.from_iterable(words)), np.uint64, sum(counts))
    del words
    whole = _windows(flat, size)  # those that reach into the next text are left out below
    out, start = [], 0
    for n in counts:
        found = whole[start : start + n - size + 1] if n >= size else _windows(flat[start : start + n], n)
        out.append(np.unique(found))
        start += n
    return out


def _windows(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` hashes."""
    if not 0 < width <= len(h):
        return np.zeros(0, np.uint64)
    out = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        out = mix(out * np.uint64(_MIX[0]) + h[k : k + len(out)])
    return out


def shingles(text: str | None, hashes: WordHashes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's shingles."""
    return shingles_of([text], hashes, size)[0]


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """For each set a row with the smallest remaining hash of each bucket, ``NO_MINIMUM`` in those without values."""
    out = np.full(len(sets) * REGISTERS, NO_MINIMUM, np.uint64)
    found = np.concatenate([*sets, np.zeros(0, np.uint64)])
    first = np.repeat(np.arange(len(sets)) * REGISTERS, [len(s) for s in sets])
    for r in range(REPEATS):
        h = found if r == 0 else mix(found + np.uint64((r * _MIX[0]) & 0xFFFFFFFFFFFFFFFF))
        np.minimum.at(out, first + ((h >> np.uint64(60)).astype(np.intp) + r * BUCKETS), h << np.uint64(4))
    return out.reshape(-1, REGISTERS)


def sketch(found: np.ndarray) -> np.ndarray:
    """Registers of a set of hashes."""
    return compress(minima([found])[0])


def compress(smallest: np.ndarray) -> np.ndarray:
    """Leading zeros and mantissa of each 64-bit minimum; ``EMPTY`` for a bucket without values."""
    empty = smallest == NO_MINIMUM
    zeros = np.zeros(len(smallest), np.uint64)
    x = smallest.copy()
    for step in (32, 16, 8, 4, 2, 1):
        small = x < (np.uint64(1) << np.uint64(64 - step))
        zeros[small] += np.uint64(step)
        x[small] <<= np.uint64(step)
    mantissa = (x << np.uint64(1)) >> np.uint64(64 - MANTISSA_BITS)
    out = ((np.minimum(zeros, np.uint64(62)) << np.uint64(MANTISSA_BITS)) | mantissa).astype(REGISTER)
    out[empty] = EMPTY
    return out


def band_keys(smallest: np.ndarray) -> list[np.ndarray]:
    """64-bit keys of the bands that hold any value, from the whole minima of each row."""
    rows = smallest.reshape(-1, BANDS, ROWS)
    used = (rows != NO_MINIMUM).any(axis=2)
    key = np.broadcast_to(np.arange(BANDS, dtype=np.uint64) * np.uint64(_MIX[0]), used.shape)
    for k in range(ROWS):
        key = mix((key + rows[:, :, k] + np.uint64(_MIX[2])) * np.uint64(_MIX[0]))
    return [k[u] for k, u in zip(key, used)]


def collision_chance(n: np.ndarray, m: np.ndarray, bits: int) -> np.ndarray:
    """Probability that registers of unrelated sets of ``n`` and ``m`` values agree."""
    n, m = np.maximum(n, 1).astype(float), np.maximum(m, 1).astype(float)
    return n * m / (n + m) ** 2 / (2 * np.log(2)) * 2.0**-bits


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Jaccard similarity of sketches row by row, corrected for registers that agree by chance.

    Minima of unrelated sets of sizes n and m agree if they fall into the same
    cell, whose width is 2 ** -bits of the power of two below it. Over all
    places of the minima that has probability n m / (n + m) ** 2 / (2 ln 2) times
    2 ** -bits, the expected share of false agreements.
    """
    used = (a != EMPTY) | (b != EMPTY)
    agree = ((a == b) & used).sum(axis=-1)
    total = np.maximum(used.sum(axis=-1), 1)
    chance = collision_chance(n, m, MANTISSA_BITS)
    raw = agree / total
    return np.clip((raw - chance) / (1 - chance), 0, 1)


def sketched(docs: DataFrame) -> DataFrame:
    """Staged ``doc_id, n_shingles, cls, registers, keys``: one row for each row of ``docs``.

    ``cls`` is a 128-bit digest of the set, null for an empty one: rows with
    equal sets have the same. ``keys`` has the bands' keys, eight bytes each.
    """
    bounded_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text"):
            sets = shingles_of(texts_of(batch), hashes)
            smallest = minima(sets)
            registers = compress(smallest.ravel()).reshape(smallest.shape)
            empty = np.array([not len(x) for x in sets])
            columns = (
                [xxhash.xxh3_128_digest(x.tobytes()) for x in sets],
                [x.tobytes() for x in registers],
                [x.tobytes() for x in band_keys(smallest)],
            )
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([len(x) for x in sets], pa.int64()),
                    *(pa.array(c, pa.binary(), mask=empty) for c in columns),
                ],
                names=["doc_id", "n_shingles", "cls", "registers", "keys"],
            )

    schema = f"doc_id {kind}, n_shingles bigint, cls binary, registers binary, keys binary"
    return staged(docs.select("doc_id", "text").mapInArrow(run, schema), "sketches")


def keyed(classes: DataFrame) -> DataFrame:
    """``key, node, n`` for each band of each class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column("keys").to_pylist()
            at = np.repeat(np.arange(len(found)), [len(k) // 8 for k in found])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.frombuffer(b"".join(found), np.int64)), batch.column("node").take(pa.array(at))],
                names=["key", "node"],
            )

    return classes.select("node", "keys").mapInArrow(run, "key bigint, node bigint")


def _estimated(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """``a, b`` whose sketches do not rule the link out."""

    @pandas_udf("boolean")
    def near(x: pd.Series, y: pd.Series, n: pd.Series, m: pd.Series) -> pd.Series:
        if not len(x):
            return pd.Series([], dtype=bool)
        left = np.frombuffer(b"".join(x), REGISTER).reshape(-1, REGISTERS)
        right = np.frombuffer(b"".join(y), REGISTER).reshape(-1, REGISTERS)
        return pd.Series(estimate(left, right, n.to_numpy(), m.to_numpy()) >= LEAST_PERCENT / 100 - ESTIMATE_SLACK)

    left = classes.select(F.col("node").alias("a"), F.col("registers").alias("x"), F.col("n_shingles").alias("n"))
    right = classes.select(F.col("node").alias("b"), F.col("registers").alias("y"), F.col("n_shingles").alias("m"))
    possible = 100 * F.least("n", "m") >= LEAST_PERCENT * F.greatest("n", "m")
    return pairs.join(left, "a").join(right, "b").where(possible).where(near("x", "y", "n", "m")).select("a", "b")


def _sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, hashes binary`` of the classes in ``nodes`` (``doc_id`` of a row with the text, ``cls``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in slices(batches, "text", 1 << 20):
            found = shingles_of(batch.column("text").to_pylist(), hashes)
            out = [(n, s) for n, x, c in zip(batch.column("node").to_pylist(), found, batch.column("cls").to_pylist())
                   if xxhash.xxh3_128_digest(s := x.tobytes()) == c]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in out], pa.int64()), pa.array([s for _, s in out], pa.binary())],
                names=["node", "hashes"],
            )

    found = docs.select("doc_id", "text").join(nodes, "doc_id")
    return found.select("node", "text", "cls").mapInArrow(run, "node bigint, hashes binary")


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets reach the threshold."""

    @pandas_udf("boolean")
    def enough(x: pd.Series, y: pd.Series) -> pd.Series:
        out = []
        for p, q in zip(x, y):
            a, b = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
            both = len(np.intersect1d(a, b, assume_unique=True))
            out.append(100 * both >= LEAST_PERCENT * (len(a) + len(b) - both))
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("node").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(left, "a").join(right, "b").where(enough("x", "y")).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """``node, comp``: the smallest node that can be reached, for the nodes of ``links``.

    Each round takes the smallest label of the neighbours, then the label of
    that label, and ends when no label changes; rounds are staged.
    """
    both = staged(links.union(links.select("b", "a")).distinct(), "links")
    ids = both.select(F.col("a").alias("node")).distinct()
    labels = staged(ids.select("node", F.col("node").alias("comp")), "labels")
    while True:
        offered = both.join(labels, both["b"] == labels["node"]).groupBy("a").agg(F.min("comp").alias("least"))
        step = labels.join(offered, labels["node"] == offered["a"]).select(
            "node", F.least("comp", "least").alias("next"), "comp"
        )
        jump = step.select(F.col("node").alias("root"), F.col("next").alias("beyond"))
        moved = step.join(jump, step["next"] == jump["root"], "left").select(
            "node", F.least("next", F.coalesce("beyond", "next")).alias("next"), "comp"
        )
        moved = staged(moved, "labels")
        labels = moved.select("node", F.col("next").alias("comp"))
        if moved.where("next < comp").isEmpty():
            return labels


def _compare(block: pd.DataFrame) -> pd.DataFrame:
    """Links that join components of a block: one row for each join, not one for each pair."""
    block = block.sort_values("node")
    regs = np.frombuffer(b"".join(block["registers"]), REGISTER).reshape(-1, REGISTERS)
    node, g, n = (block[c].to_numpy() for c in ("node", "g", "n_shingles"))
    comp = np.unique(block["comp"].to_numpy(), return_inverse=True)[1]
    sets = [np.frombuffer(h, np.uint64) for h in block["hashes"]]
    inside = int(block["i"].iloc[0]) == int(block["j"].iloc[0])
    found: list[tuple[int, int]] = []
    for k in range(len(block) - 1):
        rest = slice(k + 1, None)
        ok = (comp[rest] != comp[k]) & (inside | (g[rest] != g[k]))
        ok &= 100 * np.minimum(n[rest], n[k]) >= LEAST_PERCENT * np.maximum(n[rest], n[k])
        at = np.flatnonzero(ok) + k + 1
        if len(at):
            at = at[estimate(regs[at], regs[k], n[at], n[k]) >= LEAST_PERCENT / 100 - ESTIMATE_SLACK]
        if not len(at):
            continue
        others = np.concatenate([sets[x] for x in at])
        place = np.minimum(np.searchsorted(sets[k], others), n[k] - 1)
        both = np.add.reduceat(sets[k][place] == others, np.cumsum(n[at]) - n[at], dtype=np.int64)
        for x in at[100 * both >= LEAST_PERCENT * (n[at] + n[k] - both)].tolist():
            if comp[x] != comp[k]:
                found.append((int(node[k]), int(node[x])))
                comp[comp == comp[x]] = comp[k]
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def _narrowed(crowded: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """``key, node, comp`` of the rare shingles by which classes of different components could still be linked.

    Two sets that reach the threshold have a shingle in common among the rarest of
    each: what is left of a set without its ``LEAST_PERCENT`` most common shingles,
    and one more. So passages that many unlinked documents share bring nothing
    together, however many share them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "hashes", 1 << 20):
            found = batch.column("hashes").to_pylist()
            at = np.repeat(np.arange(len(found)), [len(h) // 8 for h in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(at)), pa.array(np.frombuffer(b"".join(found), np.int64))],
                names=["node", "key"],
            )

    nodes = staged(crowded.select("node", "comp").distinct().join(classes.select("node", "n_shingles"), "node"), "unlinked")
    held = sets.join(nodes.select("node"), "node").mapInArrow(run, "node bigint, key bigint")
    often = staged(held.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "often")
    rows = held.join(often, "key").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("found"))
    # shingles that no other of these sets has come first of all
    first = F.expr(f"cast(n_shingles - ({LEAST_PERCENT} * n_shingles + 99) div 100 + 1 - (n_shingles - size(found)) as int)")
    rows = rows.join(nodes, "node").withColumn("first", first).where("first > 0")
    rare = rows.select(F.explode(F.slice("found", F.lit(1), F.col("first"))).alias("rare"), "node", "comp")
    return staged(_mixed(rare.select("rare.key", "node", "comp")), "rare")


def _mixed(named: DataFrame) -> DataFrame:
    """The rows of ``named`` (``key, node, comp``) whose key holds several components."""
    mixed = named.groupBy("key").agg((F.min("comp") != F.max("comp")).alias("mixed")).where("mixed").select("key")
    return named.join(mixed, "key")


def _cross_links(crowded: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between different components of ``crowded`` (``key, node, comp``), verified on full sets.

    Classes that keys (rare shingles) connect are a cluster. Its classes are dealt to groups of
    bounded bytes; two groups, or one with itself, meet in one task, which
    compares sketches, then full sets of what the sketches leave, and emits at
    most one link for each join of components. Nothing is capped: a larger
    cluster makes more groups.
    """
    hubs = crowded.groupBy("key").agg(F.min("node").alias("hub"))
    edges = crowded.join(hubs, "key").where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b"))
    clusters = components(edges.distinct()).withColumnRenamed("comp", "cluster")
    nodes = crowded.select("node", "comp").distinct().join(clusters, "node")
    rows = staged(nodes.join(classes.select("node", "n_shingles", "registers"), "node"), "clusters")
    sizes = rows.groupBy("cluster").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") * 8 / BLOCK_BYTES)).cast("int").alias("groups")
    )
    rows = rows.join(sets, "node").join(sizes, "cluster")
    rows = rows.withColumn("g", F.pmod(F.xxhash64("node"), F.col("groups")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).select(
        "cluster", "node", "comp", "n_shingles", "registers", "hashes", "g",
        F.least("g", "other").alias("i"), F.greatest("g", "other").alias("j"),
    )
    return staged(rows.groupBy("cluster", "i", "j").applyInPandas(_compare, "a bigint, b bigint"), "cross")


def resolve(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs``."""
    spark = docs.sparkSession
    rows = sketched(docs)
    # one class for each distinct set, numbered as it is written: no two classes share a number
    classes = staged(
        rows.where("cls is not null").groupBy("cls").agg(
            F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"),
            F.first("registers").alias("registers"), F.first("keys").alias("keys"),
        ).withColumn("node", F.monotonically_increasing_id()),
        "classes",
    )
    keys = staged(keyed(classes), "keys")
    shared = keys.groupBy("key").agg(F.min("node").alias("hub"), F.count("*").alias("members")).where("members > 1")
    shared = staged(shared, "shared")
    crowded = staged(keys.join(shared.select("key", "hub"), "key"), "crowded")
    star = crowded.where("node <> hub").select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct()
    star = staged(_estimated(star, classes), "star")
    # full sets are made once, for the classes that share a key with any other: the texts are shuffled once
    nodes = classes.select("node", "doc_id", "cls").join(crowded.select("node").distinct(), "node")
    sets = staged(_sets(docs, nodes).dropDuplicates(["node"]), "sets")
    first = staged(_linked(star, sets), "verified")
    labels = components(first)
    named = crowded.join(labels, "node", "left").select("key", "node", F.coalesce("comp", "node").alias("comp"))
    rest = staged(_mixed(named), "mixed")
    if not rest.isEmpty():
        rest = _narrowed(rest, classes, sets)
    if not rest.isEmpty():
        labels = components(first.union(_cross_links(rest, classes, sets)))
    member = classes.select("cls", "node", "doc_id").join(labels, "node", "left")
    member = member.select("cls", F.col("doc_id").alias("least"), F.coalesce("comp", "node").alias("comp"))
    smallest = member.groupBy("comp").agg(F.min("least").alias("component_id"))
    member = member.join(smallest, "comp").select("cls", "component_id")
    return rows.join(member, "cls", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for each row of ``docs``."""
    return resolve(docs).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def row_key(docs: DataFrame) -> Column:
    """A 128-bit digest of all columns; maps and what holds them are digested as JSON."""
    def plain(field: StructField) -> Column:
        column = F.col(quoted(field.name))
        return F.to_json(F.struct(column)) if "map<" in field.dataType.simpleString() else column

    columns = [plain(f) for f in docs.schema.fields]
    halves = F.xxhash64(*columns), F.xxhash64(F.lit(1), *columns[::-1])
    return F.concat(*(F.unhex(F.lpad(F.hex(h), 16, "0")) for h in halves))


def filtered(docs: DataFrame) -> DataFrame:
    """Exactly one row of each component, with all columns: the one with the smallest id.

    Rows are known by a digest of all their columns, so repeated ids keep their own
    texts apart, rows without an id come behind those with one, and of identical
    rows one stays. Only digests and ids are grouped; whole rows are shuffled once,
    to take the chosen ones, and rows that are identical once more.
    """
    key, found = free_names(docs.columns, "_key", "_found")
    columns = [quoted(c) for c in docs.columns]
    keyed_rows = docs.withColumn(key, row_key(docs))
    narrow = keyed_rows.select(F.col(key).alias("doc_id"), F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id")).alias("place"))
    narrow = staged(narrow.groupBy("doc_id").agg(F.min("place").alias("place"), F.count("*").alias("copies")), "rows")
    member = resolve(keyed_rows.select(F.col(key).alias("doc_id"), "text")).select("doc_id", "component_id").distinct()
    chosen = member.join(narrow, "doc_id").groupBy("component_id").agg(
        F.min(F.struct("place", F.col("doc_id").alias("key"), "copies")).alias("first")
    )
    chosen = staged(chosen.select(F.col("first.key").alias(found), F.col("first.copies").alias("_copies")), "chosen")
    kept = [
        keyed_rows.join(chosen.where(c).select(found), keyed_rows[key] == F.col(found), "left_semi")
        for c in ("_copies = 1", "_copies > 1")
    ]
    return kept[0].select(*columns).unionByName(kept[1].dropDuplicates([key]).select(*columns))
